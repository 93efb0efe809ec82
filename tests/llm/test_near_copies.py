"""The near-dedup stage of the pipeline against all pairs of documents."""

import corpus_pipeline as pipeline
import pytest

from snapcredit.llm.near_copies import near_copies


def shingles(text):
    words = (text or "").encode().lower().split()
    width = min(5, len(words))
    return {b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()


def components(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if (len(a & b) >= 0.8 * len(a | b)) and root[i] != root[j]:
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    smallest = {}
    for (d, _), r in zip(rows, root, strict=True):
        if d is not None:
            smallest[r] = min(d, smallest.get(r, d))
    return [smallest.get(r) for r in root]


@pytest.mark.parametrize("part_texts", [512, 2])
def test_components(hostile, hostile_rows, part_texts):
    got = near_copies(hostile, part_texts=part_texts).collect()
    key = lambda x: (str(x[0]), str(x[1]))
    expected = zip((d for d, _ in hostile_rows), components(hostile_rows), strict=True)
    assert sorted(((r.doc_id, r.component_id) for r in got), key=key) == sorted(expected, key=key)


def test_stage_drops_copies_of_similarity_above_0_8(spark):
    """A word changed in every fifty leaves a similarity of 0.82; most such pairs differ in more than four bits."""
    words = [[f"w{(k * 7_919 + i * 104_729) % 5_003}" for i in range(100)] for k in range(20)]
    rows = []
    for k, own in enumerate(words):
        near, far = list(own), list(own)
        for at in (30, 80):
            near[at] = "changed"
        for at in (10, 30, 50, 70):
            far[at] = "changed"
        rows += [(3 * k, " ".join(own)), (3 * k + 1, " ".join(near)), (3 * k + 2, " ".join(far))]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], pipeline.COLUMNS)
    kept = {r.doc_id for r in pipeline.near_dedup_stage(spark, docs, "").collect()}
    assert kept == set(components(rows)) and kept.isdisjoint(range(1, 60, 3))


def test_sample(spark, sf_dir, documents):
    got = {r.doc_id: r.component_id for r in near_copies(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()}
    assert [got[d] for d, _ in documents] == components(documents)


def test_simhash_finds_pairs(spark):
    """Without any MinHash band the fingerprints alone find copies within four bits; the similarity still decides."""
    words = [[f"w{(k * 7_919 + i * 104_729) % 5_003}" for i in range(400)] for k in range(6)]
    rows = [(2 * k, " ".join(own)) for k, own in enumerate(words)]
    rows += [(2 * k + 1, " ".join([*own[:-1], "changed"])) for k, own in enumerate(words)]
    short = "a b c d e f g"
    rows += [(100, short), (101, short + " h i j k l m n o p q r s t u v w x y z")]
    got = near_copies(spark.createDataFrame(rows, "doc_id long, text string"), bands=0).collect()
    assert {r.doc_id: r.component_id for r in got} == dict(zip((d for d, _ in rows), components(rows), strict=True))
