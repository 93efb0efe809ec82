"""DuckDB SQL for the queries whose results SQL can state."""

from __future__ import annotations

from snapcredit.llm.licences import TEMPLATES, THRESHOLD
from snapcredit.llm.quality import RULES, STOP_WORDS, Rule
from snapcredit.llm.substring_dedup import WINDOW

BLANKS = r"[\x20\x09-\x0D]+"
#: Words of every document with their places.
WORDS = f"""
  d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
  w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '{BLANKS}'), lambda x: x <> '') AS words FROM d),
  placed AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w)"""


def _quoted(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _failed(rule: Rule) -> str:
    measure = f"{rule.field}::DOUBLE / nullif({rule.per}, 0)" if rule.per else rule.field
    bounds = [f"{measure} >= {rule.low}"] if rule.low is not None else []
    bounds += [f"{measure} <= {rule.high}"] if rule.high is not None else []
    return f"CASE WHEN NOT coalesce({' AND '.join(bounds)}, false) THEN '{rule.name}' END"


QUALITY = f"""WITH {WORDS},
  tri AS (
    SELECT doc_id, i, word || ' ' || lead(word) OVER p || ' ' || lead(word, 2) OVER p AS t
    FROM placed WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
  twice AS (SELECT doc_id, i FROM tri WHERE t IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, t) > 1),
  covered AS (
    SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM twice) GROUP BY 1),
  lined AS (
    SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM w),
  counted AS (
    SELECT lined.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
           length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
           len(list_filter(words, lambda x: list_contains({_quoted(STOP_WORDS)}, rtrim(lower(x), '.,;:!?')))) AS n_stop_words,
           len(lines) AS n_lines
    FROM lined LEFT JOIN covered USING (doc_id)),
  judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           array_to_string(list_filter([{", ".join(map(_failed, RULES))}], lambda x: x IS NOT NULL), ',') AS failed
    FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed = '' AS kept, failed
FROM judged"""

_TEMPLATES = ", ".join(f"({_quoted([name])[1:-1]}, {_quoted([body])[1:-1]})" for name, body in TEMPLATES.items())
_GRAMS = "list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))"


def _normal(text: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({text}), '[^a-z0-9]+'), lambda x: x <> '')"


LICENCES = f"""WITH
  templates AS (
    SELECT licence, {_GRAMS} AS own FROM (
      SELECT licence, {_normal("body")} AS words FROM (VALUES {_TEMPLATES}) AS t(licence, body))),
  d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
  passages AS (
    SELECT doc_id, -1 AS line, text AS passage FROM d
    UNION ALL
    SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1, unnest(string_split(text, chr(10)))
    FROM d WHERE contains(text, chr(10))),
  grams AS (SELECT doc_id, line, {_GRAMS} AS own FROM (SELECT *, {_normal("passage")} AS words FROM passages)),
  near AS (
    SELECT doc_id, line, licence, g.own AS a, t.own AS b FROM grams g JOIN templates t
      ON len(g.own) * {THRESHOLD} <= len(t.own) * {2 - THRESHOLD} AND len(t.own) * {THRESHOLD} <= len(g.own) * {2 - THRESHOLD}),
  scored AS (
    SELECT doc_id, line, licence, 2 * len(list_intersect(a, b)) / (len(a) + len(b))::DOUBLE AS dice FROM near),
  best AS (
    SELECT * FROM scored WHERE dice >= {THRESHOLD}
    QUALIFY row_number() OVER (PARTITION BY doc_id, line ORDER BY dice DESC, licence) = 1)
SELECT d.doc_id, count(line) AS n_passages,
       coalesce(array_to_string(list_sort(list(DISTINCT licence) FILTER (licence IS NOT NULL)), ','), '') AS licence_names,
       coalesce(min(line), -2)::BIGINT AS first_line, coalesce(max(dice), 0)::DOUBLE AS best_dice
FROM d LEFT JOIN best USING (doc_id) GROUP BY 1"""

_NEXT = ", ' ', ".join(f"lead(word, {k}) OVER p" if k else "word" for k in range(WINDOW))
SUBSTRINGS = f"""WITH {WORDS},
  windows AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS n,
           concat({_NEXT}) AS t
    FROM placed WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
  later AS (
    SELECT doc_id, i FROM windows WHERE n = {WINDOW}
    QUALIFY row_number() OVER (PARTITION BY t ORDER BY doc_id, i) > 1),
  gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS i FROM later),
  kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t
    FROM placed ANTI JOIN gone USING (doc_id, i) GROUP BY 1)
SELECT w.doc_id, len(words) AS n_words, len(words) - coalesce(kept.n, 0) AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""

NEAREST = """WITH
  v AS (
    SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
      AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
  pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           sqrt(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: (q.e[i] - c.e[i]) * (q.e[i] - c.e[i])))) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INT AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

COLLOCATIONS = rf"""WITH
  d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS text FROM documents),
  pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
  worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
  counted AS (
    SELECT lang, size, array_to_string(words[i:i + size - 1], ' ') AS phrase, count(*) AS a
    FROM (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM worded), (SELECT unnest([1, 2, 3, 4]) AS size)
    WHERE i + size - 1 <= len(words) GROUP BY ALL),
  sizes AS (SELECT lang, sum(a)::BIGINT AS n FROM counted WHERE size = 1 GROUP BY 1),
  known AS (SELECT * FROM counted WHERE a >= 30),
  cuts AS (
    SELECT lang, phrase, size, a, k, array_to_string(string_split(phrase, ' ')[:k], ' ') AS head,
           array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS tail
    FROM (SELECT *, unnest(range(1, size)) AS k FROM known WHERE size > 1)),
  scored AS (
    SELECT cuts.*, h.a AS l, t.a AS r, (2000000::HUGEINT * cuts.a // (h.a + t.a))::BIGINT AS score
    FROM cuts JOIN known h ON h.lang = cuts.lang AND h.phrase = head JOIN known t ON t.lang = cuts.lang AND t.phrase = tail
    QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.phrase ORDER BY score, k) = 1),
  inner_runs AS (
    SELECT lang, a, array_to_string(string_split(phrase, ' ')[i:i + m - 1], ' ') AS phrase
    FROM (SELECT *, unnest(range(1, size - m + 2)) AS i FROM known, (SELECT unnest([2, 3]) AS m) WHERE m < size)),
  longer AS (SELECT lang, phrase, max(a) AS most FROM inner_runs GROUP BY ALL),
  ranked AS (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
    FROM scored LEFT JOIN longer USING (lang, phrase) WHERE NOT coalesce(100::HUGEINT * most >= 80::HUGEINT * a, false))
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000"""

_RUNS = r"regexp_extract_all(translate(coalesce(text, ''), '{}', '{}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_RUNS = _RUNS.format(_UPPER, _LOWER)

IMPORTANCE = f"""WITH
  steps AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
             lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS step),
  d AS (SELECT doc_id, {_RUNS} AS words FROM documents),
  ours AS (SELECT doc_id, unnest(words) AS word FROM d),
  theirs AS (SELECT unnest({_RUNS}) AS word FROM benchmark),
  met AS (SELECT word, hex(encode(word)) AS h, step FROM (SELECT word FROM ours UNION SELECT word FROM theirs), steps),
  bucketed AS (
    SELECT word, xor(list_reduce(list_concat([4294967295], list_transform(range(len(h) // 2),
             lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
             lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
    FROM met),
  s AS (SELECT bucket, count(*) AS n FROM ours JOIN bucketed USING (word) GROUP BY 1),
  t AS (SELECT bucket, count(*) AS n FROM theirs JOIN bucketed USING (word) GROUP BY 1),
  gains AS (
    SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT sum(n) FROM s) + 10000)::DOUBLE
             / ((s.n + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM t), 0) + 10000)::DOUBLE)))::BIGINT AS gain
    FROM s LEFT JOIN t USING (bucket)),
  weights AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM ours JOIN bucketed USING (word) JOIN gains USING (bucket) GROUP BY 1),
  scored AS (
    SELECT d.doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
             / 4294967296::DOUBLE)))::BIGINT AS score
    FROM d LEFT JOIN weights USING (doc_id)),
  placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT 10 * count(*) // 100 FROM placed) THEN rank END AS rank
FROM scored LEFT JOIN placed USING (doc_id)"""

ORACLES = {
    "op3_nearest_neighbours": NEAREST,
    "op4_quality_rules": QUALITY,
    "op5_licence_scan": LICENCES,
    "op9_substring_dedup": SUBSTRINGS,
    "op12_collocations": COLLOCATIONS,
    "op13_importance_resampling": IMPORTANCE,
}
