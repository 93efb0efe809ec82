"""Length alone rejects no text."""

from snapcredit.llm.quality import keep_good, quality_rules


def test_long_clean_line_stays(spark):
    text = " ".join(f"the w{i} of s{i * 7 % 6_007}" for i in range(1_500))
    docs = spark.createDataFrame([(1, text), (2, ""), (3, "\n ")], "doc_id long, text string")
    got = {r.doc_id: r for r in quality_rules(docs).collect()}
    assert got[1].n_words == 6_000 and got[1].n_lines == 1 and got[1].kept and got[1].failed == []
    assert "long_lines" in got[2].failed and "long_lines" in got[3].failed
    assert [r.doc_id for r in keep_good(docs).collect()] == [1]
