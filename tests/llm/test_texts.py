"""Quality rules, tokenisation, licences, HTML and packing against brute force and the libraries."""

import hashlib
import random
from collections import defaultdict

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from snapcredit.llm import bpe, html_text, licences, neighbours, packing, quality, queries, token_counts

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")


def by_id(rows, key="doc_id"):
    out = defaultdict(list)
    for r in rows:
        out[r[key]].append(r)
    return out


def test_quality_statistics(hostile, hostile_rows, spark, sf_dir, documents):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    judged = quality.quality_rules(hostile)
    got = sorted((str(r.doc_id), *(r[n] for n in names)) for r in judged.collect())
    expected = sorted((str(i), *brute.quality([(i, t)])[i]) for i, t in hostile_rows)
    assert got == expected
    assert "n_words" in judged.columns and len(judged.columns) == len(set(judged.columns))
    rows = {r.doc_id: r for r in queries.QUERIES["op4_quality_rules"](spark, sf_dir).collect()}
    expected = brute.quality(documents)
    assert {d: tuple(r[n] for n in names) for d, r in rows.items()} == expected
    assert all(not r.kept or not r.base_failed for r in rows.values())


def test_quality_keeps_good_documents(spark, sf_dir):
    rows = queries.QUERIES["op4_quality_rules"](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    met = rows.join(labels, "doc_id").where("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")))
    share = {r[0]: r[1] for r in met.collect()}
    assert share[1] > 0.99 and share.get(0, 0) < 0.2


def test_rules_are_data(hostile):
    rules = [quality.Rule("short", "n_words", high=3)]
    failed = quality.quality_rules(hostile, rules=rules).select("n_words", "failed").collect()
    assert all((r.failed == ["short"]) == (r.n_words > 3) for r in failed)


@pytest.fixture(scope="module")
def word_tokenizer():
    return bpe.WordTokenizer(bpe.Vocabulary.read(WORD))


def library(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def reference(tokenizer, text):
    ids = tokenizer.encode(text, add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes(), tokenizer.decode(ids, skip_special_tokens=False).encode()


def test_encoding_is_the_library_s(word_tokenizer):
    rng, tokenizer = random.Random(1), library(WORD)
    texts = [
        "",
        "Hello world's don't we'll <|endoftext|> x<|startoftext|>Y <|EndOfText|>",
        "ΣΑΣ İstanbul Å ﬁ ½² ٣ \x1c a\x1db \x85 　",
        "a" * 3_000,
        "ab" * 500,
        "</w> < / w > 日本語テスト 🤦‍♂️",
    ]
    letters = "abcdeilnorst '.,!?0123\n\tÀéßΣσ́̀ \x1c<|>/wendoftx日"
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(1_500)]
    for text in texts:
        assert word_tokenizer.encode(text) == reference(tokenizer, text), text


def test_unreachable_tokens_and_equal_pairs():
    merges = [("a", "a"), ("aa", "a"), ("b", "c"), ("a", "b"), ("ab", "c")]
    tokens = {t: i for i, t in enumerate(["a", "b", "c", "aa", "aaa", "bc", "ab", "abc"])}
    encoder = bpe.PrefixEncoder(bpe.Vocabulary(tokens, merges, "", {}))

    def plain(word):
        parts = list(word)
        for a, b in merges:  # a rule is applied from left to right before the next one
            out = []
            for p in parts:
                out[-1:] = [out[-1] + p] if out and (out[-1], p) == (a, b) else [*out[-1:], p]
            parts = out
        return [tokens[p] for p in parts]

    rng = random.Random(2)
    for _ in range(500):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(1, 12)))
        assert encoder.encode(word.encode()) == plain(word), word


def test_encoding_query(spark, sf_dir, documents, hostile, hostile_rows):
    tokenizer = library(WORD)

    def expected(rows):
        out = []
        for doc, text in rows:
            ids, decoded = reference(tokenizer, text or "")
            out.append((str(doc), len(ids) // 4, *(hashlib.sha256(x).hexdigest() for x in (ids, decoded))))
        return sorted(out)

    rows = queries.QUERIES["op2_bpe_encode_decode"](spark, sf_dir).collect()
    assert sorted((str(r[0]), *r[1:]) for r in rows) == expected(documents)
    done = bpe.encode_decode(hostile, WORD).collect()
    got = [(str(r[0]), r[1], *(hashlib.sha256(x).hexdigest() for x in r[2:])) for r in done]
    assert sorted(got) == expected(hostile_rows)


def test_small_caches_change_nothing(word_tokenizer, documents, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 5)
    small = bpe.WordTokenizer(bpe.Vocabulary.read(WORD))
    for _, text in documents[:20]:
        assert small.encode(text) == word_tokenizer.encode(text)


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_section_tokens(hostile, hostile_rows, rule):
    tokenizer = library(BYTE)
    expected = []
    for doc, text in hostile_rows:
        text = text or ""
        sections = [s + "\n" for s in text.split("\n")]
        sections[-1] = sections[-1][:-1]
        if len(sections) > 1 and not sections[-1]:
            sections.pop()
        owner = [i for i, s in enumerate(sections) for _ in s]
        counts = [0] * len(sections)
        for a, b in tokenizer.encode(text).offsets:
            held = owner[a:b]
            pick = {"first": held[0], "last": held[-1], "majority": min(set(held), key=lambda x: (-held.count(x), x))}
            counts[pick[rule]] += 1
        expected += [(str(doc), i, len(s), c) for i, (s, c) in enumerate(zip(sections, counts, strict=True))]
    done = token_counts.section_tokens(hostile, BYTE, rule=rule).collect()
    assert sorted((str(r.doc_id), r.section, r.n_chars, r.n_tokens) for r in done) == sorted(expected)


def test_crossing_tokens():
    start, end, cuts = np.array([0, 2, 5]), np.array([2, 5, 6]), np.array([0, 3, 4])
    assert token_counts.allocate(start, end, cuts, "first").tolist() == [0, 0, 2]
    assert token_counts.allocate(start, end, cuts, "last").tolist() == [0, 2, 2]
    assert token_counts.allocate(start, end, cuts, "majority").tolist() == [0, 0, 2]
    assert token_counts.allocate(np.array([2]), np.array([6]), cuts, "majority").tolist() == [2]


def test_licences(spark, hostile, hostile_rows, documents, sf_dir):
    mit = licences.TEMPLATES["MIT-text"]
    extra = [
        (101, mit.upper().replace(",", " ,")),
        (102, "text before\nReleased under the MIT license!\nand after\nAll rights reserved"),
        (103, mit.replace("free of charge", "for nothing") + " And one more line."),
        (104, "licensed under cc by 4.0"),
        (105, "rights reserved all rights reserved all rights reserved"),
    ]
    frame = spark.createDataFrame(extra, "doc_id long, text string")
    rows = licences.scan_licences(frame).union(licences.scan_licences(hostile.select("doc_id", "text"))).collect()
    got = sorted((str(r.doc_id), [(x.line, x.licence, round(x.dice, 9)) for x in r.licences]) for r in rows)
    expected = [
        (str(i), [(n, x, round(d, 9)) for n, x, d in brute.licences(t, licences.TEMPLATES, licences.THRESHOLD)])
        for i, t in extra + hostile_rows
    ]
    assert got == sorted(expected)
    assert dict(got)["101"][0][1:] == ("MIT-text", 1.0)
    found = {r.doc_id: r for r in queries.QUERIES["op5_licence_scan"](spark, sf_dir).collect()}
    for doc, text in documents:
        own = brute.licences(text, licences.TEMPLATES, licences.THRESHOLD)
        assert found[doc].n_passages == len(own)
        assert found[doc].licence_names == ",".join(sorted({x[1] for x in own}))
        assert found[doc].first_line == (own[0][0] if own else -2)


PAGES = [
    (
        "<!DOCTYPE html><head><title>t</title><script>var a='</p><p>no</p>';</script></head><body><nav><a href=x>Home</a>"
        "</nav><header><h1>Site</h1></header><article><header><h1>Head &amp; line</h1></header><p><b>One<br>two<p>Thr&eacute;e"
        "  \n four <a href=y>link</a>.<ul><li>item 1<li>item 2</ul><form><input>no</form><aside>no</aside>"
        "<section id='comments'><article>reader</article></section></article><footer>&copy; x</footer>",
        "Head & line\nOne two\nThrée four link.\nitem 1\nitem 2",
    ),
    (
        '<body><div class="TopMenu">no no</div><div id="cookie-notice">We use cookies on this site.</div><div>'
        "<h1>Title</h1><div class=text><p>A long first paragraph of the page, with many words in it.</p><p>Short.</p></div>"
        '</div><div class="side sidebar"><p>no</p></div></body>',
        "Title\nA long first paragraph of the page, with many words in it.\nShort.",
    ),
    (
        '<body><div class="content with-sidebar"><p>The text of the page, in a layout with a sidebar.</p></div>'
        '<ins class="adsbygoogle">no</ins></body>',
        "The text of the page, in a layout with a sidebar.",
    ),
    ("plain &lt;text&gt; only", "plain <text> only"),
    ("<p>", ""),
    ("", ""),
    (None, ""),
    ("<style>p{}</style><!-- <p>no</p> --><main><table><tr><td>a<td>b<tr><td>c</table></main", "a\nb\nc"),
    ('<main><p title="a > b">quoted</p><p class=\'x\' data-y=">">too</p></div></span></main>', "quoted\ntoo"),
]


def test_main_text(spark):
    rows = [(n, f"u{n}", page, "clash") for n, (page, _) in enumerate(PAGES)] + [(0, "u0", PAGES[0][0], "clash")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    done = html_text.extract_main_text(pages)
    assert done.columns == ["page_id", "url", "text"]
    assert sorted((r.page_id, r.text) for r in done.collect()) == sorted(
        [(n, text) for n, (_, text) in enumerate(PAGES)] + [(0, PAGES[0][1])]
    )
    assert html_text.extract_main_text(pages.limit(0)).count() == 0


def test_sample_pages(spark, sf_dir):
    rows = queries.QUERIES["op8_html_extraction"](spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/pages.parquet"), "page_id")
    for r in rows.collect():
        assert r.text and r.n_chars == len(r.text)
        assert "©" not in r.text and "track(" not in r.text and "<p>" not in r.text


def test_deep_page():
    assert html_text.main_text("<div>" * 20_000 + "x" + "</div>" * 20_000) == "x"


def test_best_fit_is_the_tightest_bin():
    rng = random.Random(4)
    for _ in range(60):
        n = rng.randint(0, 40)
        sizes = [rng.randint(0, 20) for _ in range(n)]
        sources = [rng.randint(-1, 6) for _ in range(n)]
        clusters = [rng.choice([-1, -1, 0, 1]) for _ in range(n)]
        bins, room = packing.best_fit(sizes, sources, clusters, 20)
        got = [[] for _ in room]
        for i in sorted(range(n), key=lambda i: (-sizes[i], i)):
            got[bins[i]].append(i)
        assert got == brute.best_fit(sizes, sources, clusters, 20)
        assert room == [20 - sum(sizes[i] for i in b) for b in got]


@pytest.mark.parametrize("shard", [4, 8_192])
def test_packing(hostile, hostile_rows, no_rows, shard):
    rows = packing.pack(hostile, capacity=64, shard=shard).collect()
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.piece, r.first_word, r.n_words))
        bins[r.bin_id].append(r)
    sizes = defaultdict(list)
    for doc, text in hostile_rows:
        sizes[doc].append(len(brute.WORD.findall(text or "")))
    for doc, own in sizes.items():
        assert sum(n for _, _, n in pieces[doc]) == sum(own)
        assert len(pieces[doc]) == sum(max(1, -(-n // 64)) for n in own)
    source = {doc: f"s{n % 3}" if n % 5 else None for n, (doc, _) in enumerate(hostile_rows)}
    unique = {d for d, own in sizes.items() if len(own) == 1 and d is not None}
    for own in bins.values():
        assert sum(r.n_words for r in own) == own[0].bin_words <= 64
        named = [source[r.doc_id] for r in own if r.doc_id in unique and source[r.doc_id]]
        assert len(named) == len(set(named))
        assert not {1, 4} <= {r.doc_id for r in own}
    assert packing.pack(no_rows).count() == 0


def test_packing_query_is_whole(spark, sf_dir, documents):
    rows = queries.QUERIES["op1_best_fit_packing"](spark, sf_dir)
    words = {r.doc_id: r.n for r in rows.groupBy("doc_id").agg(F.sum("n_words").alias("n")).collect()}
    assert words == {d: len(brute.WORD.findall(t)) for d, t in documents}
    assert rows.groupBy("bin_id").agg(F.sum("n_words").alias("n"), F.max("bin_words").alias("b")).where("n <> b or n > 2048").count() == 0


def test_nearest(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 7)).astype(np.float32)
    rows = [(n, [float(x) for x in v]) for n, v in enumerate(base)]
    rows += [(60, rows[4][1]), (61, rows[4][1]), (4, rows[4][1]), (62, None), (63, []), (64, [0.0] * 7), (65, [1.0] * 3)]
    rows += [(66, [float("nan")] * 7), (67, [float("inf")] * 7), (68, [1.0] * 6 + [None]), (None, rows[1][1]), (20, [9.0] * 7), (70, [2.0, 0.0, 1.0])]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, label int")
    for sizes in ({}, {"query_rows": 2, "candidate_rows": 7}):
        done = neighbours.nearest(frame, F.col("vec_id") % 10 == 0, k=5, **sizes).collect()
        got = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in done)
        use = [(i, None if v is None else [np.float32(x) if x is not None else None for x in v]) for i, v in rows]
        use = [(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in use]
        expected = brute.neighbours(use, lambda q: q % 10 == 0, 5)
        assert got == sorted((q, r, i, round(d, 9)) for q, r, i, d in expected)
    assert neighbours.nearest(frame.limit(0), F.lit(True)).count() == 0


def test_nearest_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in rows])
    vectors = np.array([r.embedding for r in rows], np.float64)
    done = by_id(queries.QUERIES["op3_nearest_neighbours"](spark, sf_dir).collect(), "query_id")
    for q in ids[ids % 100 == 0]:
        d = neighbours.distances(vectors, np.broadcast_to(vectors[ids == q], vectors.shape))
        assert np.allclose(d, np.sqrt(((vectors - vectors[ids == q]) ** 2).sum(axis=1)))
        order = [i for i in np.lexsort((ids, d)) if ids[i] != q][:10]
        own = sorted(done[q], key=lambda r: r["rank"])
        assert [r.vec_id for r in own] == ids[order].tolist()
        assert [r.score for r in own] == d[order].tolist()


def test_bounds_hold():
    rng = np.random.default_rng(9)
    a, b = rng.normal(size=(30, 16)), rng.normal(size=(40, 16)) * 50
    lower, upper = neighbours.tile_bounds(neighbours.quantise(a), neighbours.quantise(b))
    d = np.sqrt(((a[:, None] - b[None]) ** 2).sum(axis=2))
    assert (lower <= d).all() and (d <= upper).all()


def test_empty_tables(no_rows):
    assert quality.quality_rules(no_rows).count() == 0
    assert licences.scan_licences(no_rows).count() == 0
    assert bpe.encode_decode(no_rows, WORD).count() == 0
    assert token_counts.section_tokens(no_rows, BYTE).count() == 0
