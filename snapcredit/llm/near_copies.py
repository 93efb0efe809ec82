"""Near copies by Jaccard similarity of word shingles, each link measured exactly.

SimHash fingerprints within a few bits, found by the walks of `simhash`, are candidates; MinHash bands add the
pairs of the similarity that differ in more bits."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapcredit.llm.common import checkpointed, keyed_texts, map_arrow, ship, text_chunks
from snapcredit.llm.components import connected_components
from snapcredit.llm.rolling import mix
from snapcredit.llm.simhash import BUDGET, component_ids, fingerprint_links, folded, shingle_digests

SHINGLE = 5
SIMILARITY = 0.8
SEED = 42
#: A pair of similarity s shares one of the bands with probability 1 - (1 - s ** ROWS) ** BANDS, 0.99995 at 0.8.
BANDS, ROWS = 25, 5
#: Texts and their bytes that a part of a candidate component holds; a larger one is dealt out in pairs of parts.
PART_TEXTS, PART_BYTES = 512, 1 << 20


def distinct_hashes(digests: np.ndarray) -> np.ndarray:
    """The distinct ones of `simhash.shingle_digests`, sorted."""
    return np.unique(digests.view(np.uint64).ravel())


def shingle_hashes(text: bytes, shingle: int, seed: int) -> np.ndarray:
    """XXH64 of the distinct shingles of a text in UTF-8, sorted; words and short texts as in `simhash.fingerprint`."""
    return distinct_hashes(shingle_digests(text, shingle, seed))


def band_hashes(sets: list[np.ndarray], bands: int, rows: int, seed: int) -> np.ndarray:
    """A row of `bands` hashes for each set, none of which may be empty."""
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    values = np.concatenate(sets)
    with np.errstate(over="ignore"):
        keys = mix(np.arange(1, 2 * bands * rows + 1, dtype=np.uint64) + (np.uint64(seed) << np.uint64(32)))
        out = np.empty((len(sets), bands), np.uint64)
        for band in range(bands):
            held = np.full(len(sets), np.uint64(band), np.uint64)
            for k in range(band * rows, (band + 1) * rows):
                permuted = (values ^ keys[2 * k]) * (keys[2 * k + 1] | np.uint64(1))
                held = mix(held + np.minimum.reduceat(permuted, starts))
            out[:, band] = held
    return out


def signatures(texts: DataFrame, shingle: int, seed: int, bands: int, rows: int) -> DataFrame:
    """doc_id, text_hash, fp (hash of the set of shingles), n_bytes, SimHash and bands of each row of `keyed_texts`."""

    def sign(batches):
        for batch, raw, lengths in text_chunks(batches):
            ends, data = np.cumsum(lengths), raw.tobytes()
            sets, sims = [], []
            for e, n in zip(ends, lengths, strict=True):
                digests = shingle_digests(data[e - n : e], shingle, seed)
                sets.append(distinct_hashes(digests))
                sims.append(folded(digests))
            some = [i for i, s in enumerate(sets) if len(s)]
            found: list[list[int]] = [[] for _ in sets]
            if some:
                banded = band_hashes([sets[i] for i in some], bands, rows, seed).view(np.int64)
                for i, row in zip(some, banded.tolist(), strict=True):
                    found[i] = row
            columns = [
                batch.column("doc_id"),
                batch.column("text_hash"),
                pa.array(np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)),
                pa.array(lengths.astype(np.int64)),
                pa.array(np.array(sims, np.uint64).view(np.int64)),
                pa.array(found, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "fp", "n_bytes", "sim", "bands"])

    id_type = texts.schema["doc_id"].dataType.simpleString()
    return map_arrow(texts, sign, f"doc_id {id_type}, text_hash int, fp long, n_bytes long, sim long, bands array<long>")


def linked_sets(
    sets: list[np.ndarray], bands: list[list[int]], part: list[int], similarity: float
) -> list[tuple[int, int]]:
    """Links (i, j) that connect what pairs of the similarity connect, of those that share a band.

    Of two parts only pairs from one to the other are looked at. A pair that links already connect is not
    measured, so many copies of one text take one measurement each.
    """
    root = list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    buckets: dict[int, list[int]] = {}
    for i, own in enumerate(bands):
        for b in own:
            buckets.setdefault(b, []).append(i)
    two, measured, links = len(set(part)) > 1, set(), []
    for bucket in buckets.values():
        groups: list[list[int]] = []  # members met so far, those that are connected together
        for i in bucket:
            for group in groups:
                for j in group:
                    if find(i) == find(j):
                        break
                    if (two and part[i] == part[j]) or (i, j) in measured:
                        continue
                    measured |= {(i, j), (j, i)}
                    a, b = len(sets[i]), len(sets[j])
                    if min(a, b) < similarity * max(a, b):
                        continue
                    shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if shared >= similarity * (a + b - shared):
                        root[find(i)] = find(j)
                        links.append((i, j))
                        break
            joined = [i]
            apart = []
            for group in groups:
                if find(group[0]) != find(i):
                    apart.append(group)
                elif len(group) >= len(joined):
                    group.extend(joined)
                    joined = group
                else:
                    joined.extend(group)
            groups = [*apart, joined]
    return links


def near_copies(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
    seed: int = SEED,
    bands: int = BANDS,
    rows: int = ROWS,
    part_texts: int = PART_TEXTS,
    budget: int = BUDGET,
) -> DataFrame:
    """Component of each document among those whose shingle sets have at least the Jaccard similarity.

    Words, shingles and short texts are those of `simhash.near_duplicates`; texts without words are copies
    of each other. A link is only made where the exact similarity of two sets is high enough; pairs are
    looked for among SimHash fingerprints that links of at most `budget` bits connect and in shared MinHash
    bands. The components that both make are looked through, whose texts are shuffled once. A
    component of more than `part_texts` texts (or PART_BYTES) is dealt out in pairs of parts.

    Returns the columns of `simhash.near_duplicates` for each row of `docs`, fp being a hash of the set.
    """
    texts = keyed_texts(docs, doc_id, text)
    signed = checkpointed(signatures(texts, shingle, seed, bands, rows))
    one = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "text_hash", "n_bytes", "sim", "bands"))
    classes = checkpointed(signed.groupBy("fp").agg(one.alias("one")).select("fp", "one.*"))
    alike = connected_components(fingerprint_links(classes.select(F.col("sim").alias("fp")).distinct(), budget), "a", "b")
    # What SimHash connects shares one more band.
    band = F.xxhash64(F.coalesce("root", "sim"))
    classes = classes.join(alike, classes["sim"] == alike["node"], "left").withColumn("bands", F.array_append("bands", band))
    classes = checkpointed(classes.drop("node", "root", "sim"))
    banded = classes.select("fp", F.explode("bands").alias("band"))
    hubs = banded.groupBy("band").agg(F.min("fp").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    meeting = banded.join(hubs, "band").where("fp <> hub").select("fp", "hub").distinct()
    found = connected_components(meeting, "fp", "hub")
    roots = found.select("node", "root").union(found.select(F.col("root").alias("node"), "root")).distinct()
    members = classes.join(roots, classes["fp"] == roots["node"]).drop("node", "without")
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / part_texts), F.ceil(F.sum("n_bytes") / PART_BYTES)).cast("int")
    sizes = members.groupBy("root").agg(parts.alias("parts"))
    members = members.join(sizes, "root").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "fp", "bands", "root", "parts"
    )
    whole = texts.join(members, texts["doc_id"].eqNullSafe(F.col("_id")) & (texts["text_hash"] == F.col("_hash")))
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    dealt = (
        whole.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "fp", "text", "bands",
            F.xxhash64("root", F.least("own", "other"), F.greatest("own", "other")).alias("walk"),
            F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("part"),
        )
    )

    def walk(group: pa.Table) -> pa.Table:
        fp = group.column("fp").to_numpy()
        _, first = np.unique(fp, return_index=True)  # of repeated rows one
        group, fp = group.take(pa.array(first)), fp[first]
        bodies = group.column("text").cast(pa.large_binary()).to_pylist()
        sets = [shingle_hashes(b, shingle, seed) for b in bodies]
        links = linked_sets(sets, group.column("bands").to_pylist(), group.column("part").to_pylist(), similarity)
        ends = [pa.array([int(fp[x[k]]) for x in links], pa.int64()) for k in (0, 1)]
        return pa.Table.from_arrays(ends, ["a", "b"])

    ship(docs.sparkSession)
    links = dealt.groupBy("walk").applyInArrow(walk, "a long, b long").distinct()
    return component_ids(signed.select("doc_id", "text_hash", "fp"), links)
