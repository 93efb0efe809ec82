"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapcredit.llm.common import free_name, let

#: Common function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that for with was as are be this on by it "
    "der die das und den von zu mit ist ein nicht auch für "
    "le la les de des et un une que est dans pour qui sur pas "
    "el los las del y en se por con no una su para"
).split()

#: The pattern of a blank between words: everything but [^\x20\x09-\x0D].
BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


#: Fields of `text_statistics`.
STATISTICS = "n_words word_chars n_symbols n_dup_lines n_repeat_words n_stop_words n_lines".split()


@dataclass(frozen=True)
class Rule:
    """Keep texts whose measure lies between low and high, both included; None is no bound.

    The measure is a field of `text_statistics`, or its ratio to the field `per`.
    """

    name: str
    field: str
    per: str | None = None
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("few_words", "n_words", low=50),
    Rule("word_length", "word_chars", "n_words", low=2.5, high=12),
    Rule("symbols", "n_symbols", "n_words", high=0.1),
    Rule("stop_words", "n_stop_words", "n_words", low=0.04),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=0.5),
    Rule("repeated_words", "n_repeat_words", "n_words", high=0.5),
    # No upper bound: a clean text stays however long its lines are. Texts without lines fail.
    Rule("long_lines", "n_words", "n_lines", low=0),
)


def repeat_words(words: Column) -> Column:
    """Words in a three-word window that the text holds twice or more, the first one included.

    Windows are sorted with their places, so equal ones are neighbours; n log n in the length.
    """
    last = F.size(words) - 3
    windows = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.struct(
            F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("window"),
            i.alias("place"),
        ),
    )

    def places(ordered: Column) -> Column:
        def repeated(x: Column, i: Column) -> Column:
            near = [F.get(ordered, j)["window"] == x["window"] for j in (i - 1, i + 1)]
            return F.coalesce(near[0], F.lit(False)) | F.coalesce(near[1], F.lit(False))

        return F.transform(F.filter(ordered, repeated), lambda x: x["place"])

    def covered(ordered: Column) -> Column:
        # A window adds its three words, less those of the next repeated window.
        return F.aggregate(
            F.sort_array(places(ordered)),
            F.struct(F.lit(0).alias("n"), F.lit(-3).alias("before")),
            lambda acc, p: F.struct(
                (acc["n"] + F.least(p - acc["before"], F.lit(3))).alias("n"), p.alias("before")
            ),
        )["n"]

    return F.when(last >= 0, let(F.sort_array(windows), covered)).otherwise(0)


def text_statistics(text: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Counts of one text as a struct of longs; null counts as empty."""
    body = F.coalesce(text, F.lit(""))
    stop = F.array(*(F.lit(w) for w in stop_words))

    def of(words: Column, lines: Column) -> Column:
        plain = F.transform(words, lambda w: F.rtrim(F.lower(w), F.lit(".,;:!?")))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
            (F.char_length(body) - F.char_length(F.translate(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            repeat_words(words).cast("long").alias("n_repeat_words"),
            F.size(F.filter(plain, lambda w: F.array_contains(stop, w))).cast("long").alias("n_stop_words"),
            F.size(lines).cast("long").alias("n_lines"),
        )

    words = F.filter(F.split(body, BLANKS), lambda w: w != "")
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(F.struct(words.alias("w"), lines.alias("l")), lambda x: of(x["w"], x["l"]))


def passes(statistics: Column, rule: Rule) -> Column:
    """A measure that is not defined, as in a text without words, fails."""
    measure = statistics[rule.field]
    if rule.per:
        measure = F.try_divide(measure, statistics[rule.per])
    bounds = [measure >= rule.low] if rule.low is not None else []
    bounds += [measure <= rule.high] if rule.high is not None else []
    return F.coalesce(reduce(lambda a, b: a & b, bounds), F.lit(False))


def judged(text: Column, rules: Sequence[Rule] = RULES, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Struct of the statistics, failed, base_failed and kept, with each text counted once: a filter on one
    of its fields that is moved below a projection carries one copy of the counts."""

    def verdict(s: Column) -> Column:
        failed = F.filter(F.array(*(F.when(~passes(s, r), r.name) for r in rules)), lambda x: x.isNotNull())
        base = (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])
        kept = ~base & (F.size(failed) == 0)
        own = [s[name].alias(name) for name in STATISTICS]
        return F.struct(*own, failed.alias("failed"), base.alias("base_failed"), kept.alias("kept"))

    return let(text_statistics(text, stop_words), verdict)


def quality_rules(
    docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, stop_words: Sequence[str] = STOP_WORDS
) -> DataFrame:
    """All rows and columns of `docs`, with the statistics of the text and the verdict of the rules.

    Adds the fields of `text_statistics`, failed (names of the rules not met, in their order),
    base_failed (fewer than 50 words, or more than half of them in repeated three-word windows) and kept
    (neither base_failed nor failed). A column of `docs` with one of these names is replaced. Null and
    empty texts have zero counts and fail; each repeated row is judged alike.
    """
    added = [*STATISTICS, "failed", "base_failed", "kept"]
    own = [c for c in docs.columns if c.lower() not in added]
    held = free_name(docs, "_judged")
    found = docs.select(*own, judged(F.col(text), rules, stop_words).alias(held))
    return found.select(*own, *(F.col(f"{held}.{name}").alias(name) for name in added))


def keep_good(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of `docs` that the rules keep, with their columns."""
    return docs.where(judged(F.col(text), rules)["kept"])
