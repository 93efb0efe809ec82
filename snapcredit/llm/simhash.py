"""SimHash near-dedup: fingerprints of word shingles, joined by walking pairs of binary trie nodes."""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapcredit.llm.common import as_struct, checkpointed, keyed_texts, map_arrow, text_chunks
from snapcredit.llm.components import connected_components

SHINGLE = 4
SEED = 42
BUDGET = 4
#: Fingerprints of a subtree that one step walks; a larger subtree is dealt out in pairs of parts.
SUBTREE = 1_024
#: Node pairs held at once.
FRONTIER = 1 << 19

ONE = np.uint64(1)


def byte_lanes() -> np.ndarray:
    """For each byte value its eight bits, highest first, as eight bytes of one word: counters that add up."""
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1)
    return bits.view(np.uint64).ravel()


LANES = byte_lanes()


def shingle_digests(text: bytes, shingle: int, seed: int) -> np.ndarray:
    """XXH64 of every shingle of a text in UTF-8, repeats included, as rows of eight bytes, highest first."""
    words = text.lower().split()  # bytes: A-Z only, and just the ASCII blanks
    width = min(shingle, len(words))
    if not width:
        return np.empty((0, 8), np.uint8)
    grams = map(b" ".join, zip(*(words[k : len(words) - width + 1 + k] for k in range(width)), strict=True))
    return np.frombuffer(b"".join([xxhash.xxh64_digest(g, seed) for g in grams]), np.uint8).reshape(-1, 8)


def folded(digests: np.ndarray) -> int:
    """SimHash of the digests of a text, as an unsigned number; zero of none."""
    if not len(digests):
        return 0
    # A lane counts to 255 at most before it is taken out.
    lanes = np.add.reduceat(LANES[digests], np.arange(0, len(digests), 255), axis=0)
    ones = lanes.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(digests)).tobytes(), "big")


def fingerprint(text: bytes, shingle: int, seed: int) -> int:
    """SimHash of a text in UTF-8, as an unsigned number."""
    return folded(shingle_digests(text, shingle, seed))


def fingerprints(texts: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id, text_hash and the fingerprint (as a signed long) of each row of `keyed_texts`."""

    def sign(batches):
        for batch, raw, lengths in text_chunks(batches):
            ends = np.cumsum(lengths)
            data = raw.tobytes()
            value = [fingerprint(data[e - n : e], shingle, seed) for e, n in zip(ends, lengths, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array(np.array(value, np.uint64).view(np.int64)),
                ],
                ["doc_id", "text_hash", "fp"],
            )

    id_type = texts.schema["doc_id"].dataType.simpleString()
    return map_arrow(texts, sign, f"doc_id {id_type}, text_hash int, fp long")


def trie_pairs(group: np.ndarray, part: np.ndarray, value: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of one group whose values differ in at most `budget` bits; sorted by (group, part, value).

    Each group is the root of one trie, or of two that only pair with each other if it has two parts. A
    node is a range of the sorted values. Two nodes are walked together; where they part, they carry the
    differing bits so far, and a pair over the budget is left. A pair of single values is finished by a
    population count.
    """
    size = len(value)
    cut = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]) | (part[1:] != part[:-1])]))
    lo, hi = cut, np.append(cut[1:], size)
    # The second part of a group stands right after the first.
    two = np.flatnonzero(group[lo[1:]] == group[lo[:-1]])
    own = np.setdiff1d(np.arange(len(lo)), np.concatenate([two, two + 1]))
    stack = [(0, lo[own], hi[own], lo[own], hi[own], np.zeros(len(own), np.int8))]
    stack.append((0, lo[two], hi[two], lo[two + 1], hi[two + 1], np.zeros(len(two), np.int8)))
    ones: dict[int, np.ndarray] = {}
    left, right = [], []
    while stack:
        depth, a, b, c, d, bits = stack.pop()
        same = a == c
        live = ~(same & (b - a < 2))
        single = live & ~same & (b - a == 1) & (d - c == 1)
        if single.any():
            i, j = a[single], c[single]
            near = np.bitwise_count(value[i] ^ value[j]) <= budget
            left.append(i[near])
            right.append(j[near])
        live &= ~single
        a, b, c, d, bits, same = (x[live] for x in (a, b, c, d, bits, same))
        if not len(a):
            continue
        if depth == 64:  # equal values twice: any two of their rows are linked through the first ones
            left += [np.repeat(a, d - c), np.repeat(c, b - a)]
            right += [_ranges(c, d), _ranges(a, b)]
            continue
        if len(a) > FRONTIER:
            h = len(a) // 2
            stack += [(depth, *(x[s] for x in (a, b, c, d, bits))) for s in (slice(h), slice(h, None))]
            continue
        if depth not in ones:
            bit = (value >> np.uint64(63 - depth)) & ONE
            ones[depth] = np.concatenate([[0], np.cumsum(bit, dtype=np.int64)])
        count = ones[depth]
        m = b - (count[b] - count[a])  # first row of the node whose next bit is one
        n = d - (count[d] - count[c])
        cross = ~same
        children = [
            (a, m, c, n, bits),
            (m, b, n, d, bits),
            (a, m, n, d, bits + 1),
            (m[cross], b[cross], c[cross], n[cross], bits[cross] + 1),
        ]
        p, q, r, t, k = (np.concatenate(x) for x in zip(*children, strict=True))
        some = (q > p) & (t > r) & (k <= budget)
        stack.append((depth + 1, *(x[some] for x in (p, q, r, t, k))))
    none = np.empty(0, np.int64)
    return (np.concatenate(x) if x else none for x in (left, right))


def _ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    n = hi - lo
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)


def roots_of(size: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest index each index is connected to."""
    root = np.arange(size)
    while len(left):
        a, b = root[left], root[right]
        low = np.minimum(a, b)
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        while (root != root[root]).any():
            root = root[root]
        apart = root[left] != root[right]
        left, right = left[apart], right[apart]
    return root


def blocks(fp: Column, budget: int, agreed: int = 1) -> list[Column]:
    """The 64 bits in budget + agreed disjoint stretches, and of these every choice of `agreed`, end to end: two
    fingerprints within the budget differ in at most `budget` stretches, so they agree on such a choice."""
    edges = [64 * i // (budget + agreed) for i in range(budget + agreed + 1)]
    stretches = [
        (F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1)), b - a)
        for a, b in zip(edges[:-1], edges[1:], strict=True)
    ]

    def joined(chosen: tuple) -> Column:
        value = chosen[0][0]
        for bits, width in chosen[1:]:
            value = F.shiftleft(value, width).bitwiseOR(bits)
        return value

    return [joined(chosen) for chosen in combinations(stretches, agreed)]


def agreed_blocks(n: int, budget: int, subtree: int) -> int:
    """Stretches to agree on so that `n` evenly spread fingerprints fill subtrees of at most `subtree`.

    With more stretches a fingerprint stands in more subtrees, five, fifteen, thirty-five, and these are
    smaller by thousands: so its copies follow the logarithm of n and not n."""
    agreed = 1
    while agreed < 4 and n >> (64 * agreed // (budget + agreed)) > subtree:
        agreed += 1
    return agreed


def dealt_out(fps: DataFrame, budget: int, subtree: int, agreed: int) -> DataFrame:
    """(fp, walk, part): each fingerprint once for every walk that it takes part in."""
    choices = blocks(F.col("fp"), budget, agreed)
    keyed = fps.select(
        "fp",
        F.explode(
            F.array(*(F.struct(F.lit(i).alias("block"), v.alias("bits")) for i, v in enumerate(choices)))
        ).alias("node"),
    ).select("fp", "node.*")
    sizes = keyed.groupBy("block", "bits").agg(F.ceil(F.count(F.lit(1)) / subtree).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("fp", "block"), F.col("parts")).cast("int")
    return (
        keyed.join(sizes, ["block", "bits"])
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "fp",
            F.xxhash64("block", "bits", F.least("own", "other"), F.greatest("own", "other")).alias("walk"),
            # A part meets itself in the walk (own, own), there as the only part.
            F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("part"),
        )
    )


def fingerprint_links(
    fps: DataFrame, budget: int = BUDGET, subtree: int = SUBTREE, agreed: int | None = None
) -> DataFrame:
    """Links (a, b) that connect all of `fps` (column fp, distinct) within `budget` differing bits.

    The trie is cut below each choice of `agreed` stretches of bits: a pair within the budget agrees on one
    choice, so it meets in a subtree of it. By default their number follows that of the fingerprints.
    Subtrees of more than `subtree` fingerprints, of which a hot one may still be, are split in parts,
    and every pair of parts is walked on its own. A walk returns a spanning forest of the links it found,
    never all pairs.
    """
    agreed = agreed or agreed_blocks(fps.count(), budget, subtree)
    dealt = dealt_out(fps, budget, subtree, agreed)

    def walk(batches):
        held: list[pa.RecordBatch] = []

        def run() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            group, part, fp = (table.column(c).to_numpy() for c in ("walk", "part", "fp"))
            value = fp.view(np.uint64)
            order = np.lexsort((value, part, group))
            group, part, value = group[order], part[order], value[order]
            i, j = trie_pairs(group, part, value, budget)
            root = roots_of(len(value), i, j)
            moved = np.flatnonzero(value[root] != value)
            a, b = value[moved].view(np.int64), value[root[moved]].view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            walks = batch.column("walk").to_numpy()
            edges = np.flatnonzero(walks[1:] != walks[:-1]) + 1
            first = 0
            if held and len(walks) and held[-1].column("walk")[-1].as_py() != walks[0]:
                edges = np.insert(edges, 0, 0)
            # Whole subtrees only, a few thousand rows at a time.
            if len(edges) and sum(b.num_rows for b in held) + batch.num_rows >= 16 * subtree:
                last = int(edges[-1])
                held.append(batch.slice(0, last))
                yield run()
                held, first = [], last
            held.append(batch.slice(first))
        if sum(b.num_rows for b in held):
            yield run()

    return map_arrow(dealt.repartition("walk").sortWithinPartitions("walk"), walk, "a long, b long").distinct()


def component_ids(signed: DataFrame, links: DataFrame) -> DataFrame:
    """The rows of `signed` (doc_id, text_hash, fp) with the smallest doc_id that `links` (a, b) of fp reach."""
    classes = signed.groupBy("fp").agg(F.min("doc_id").alias("smallest"))
    roots = connected_components(links, "a", "b")
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "smallest", F.coalesce("root", "fp").alias("root")
    )
    component = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"))
    labels = rooted.join(component, "root").select("fp", "component_id")
    return signed.join(labels, "fp").select("doc_id", "text_hash", "fp", "component_id")


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    seed: int = SEED,
    budget: int = BUDGET,
) -> DataFrame:
    """Component of each document among those whose fingerprints differ in at most `budget` bits.

    A-Z is lower-cased; a shingle is `shingle` words joined by a blank, repeats included, and all words of
    a shorter text; a bit of the fingerprint is one if it is in more than half of the XXH64 values of the
    shingles. Texts without words (null and empty too) have fingerprint zero and link like any other.

    Returns doc_id, text_hash, fp (signed long) and component_id, the smallest doc_id that links reach;
    null ids are passed over, and a component of null ids only has null. One row per row of `docs`;
    other columns are not carried.
    """
    signed = checkpointed(fingerprints(keyed_texts(docs, doc_id, text), shingle, seed))
    return component_ids(signed, fingerprint_links(signed.select("fp").distinct(), budget))


def keep_one(docs: DataFrame, find: Callable[..., DataFrame] = near_duplicates, **options) -> DataFrame:
    """The rows of `docs` (doc_id, text and any others) whose document stays: one of each component.

    The document with the smallest doc_id stays (null last), among equal ids the one with the smallest
    text hash, and of exactly repeated rows one. `find` names the components.
    """
    found = find(docs, **options)
    # Rows without an id have no component id to meet in: their fingerprint stands for it.
    group = F.struct("component_id", F.when(F.col("component_id").isNull(), F.col("fp")))
    order = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "text_hash")
    winners = found.groupBy(group.alias("g")).agg(F.min(order).alias("winner"))
    rows = found.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("_rows"))
    rows = rows.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "_rows")
    chosen = winners.select("winner.doc_id", "winner.text_hash").join(
        rows, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    ).select("_id", "_hash", "_rows")
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    held = docs.select(F.col("doc_id").alias("id"), F.hash(body).alias("hash"), as_struct(docs).alias("row"))
    match = held["id"].eqNullSafe(chosen["_id"]) & (held["hash"] == chosen["_hash"])
    kept = held.join(chosen, match).select("id", "hash", "row", "_rows")
    once = kept.where("_rows = 1").select("row.*")
    return once.unionByName(kept.where("_rows > 1").dropDuplicates(["id", "hash"]).select("row.*"))
