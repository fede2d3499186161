"""Quality rules: a table of thresholds compiled into one projection.

Every measure is a built-in array or string function of the row, so the job is a
scan and a projection: no shuffle, no Python, nothing that depends on other rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

SPACE = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"

# Frequent function words of the languages the rules are meant for.
STOP_WORDS = (
    "the of and to in a is that for it with as on was at by be from this or an are "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine "
    "le la les de des et un une du en que qui est dans pour par sur au plus ne "
    "el los las y un una del se que en por con para su al lo como"
).split()


@dataclass(frozen=True)
class Rule:
    """A document fails when ``measure`` lies outside [low, high]; None leaves a side open."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("words", "n_words", low=50),
    Rule("word_length", "mean_word_chars", low=2, high=15),
    Rule("symbols", "symbol_ratio", high=0.1),
    Rule("stop_words", "stop_ratio", low=0.02),
    Rule("repeated_lines", "dup_line_ratio", high=0.6),
    Rule("bullet_lines", "bullet_ratio", high=0.9),
    Rule("cut_lines", "ellipsis_ratio", high=0.3),
)


def _share(part: str, whole: str) -> Column:
    """A share is 0 where there is nothing to share."""
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


def _measured(docs: DataFrame, text: str) -> DataFrame:
    """Each row as ``__row`` with its counts beside it.

    The word list and the sorted windows are each read at several places of the next
    step, so the optimizer keeps them as columns and builds them once per row.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    lists = docs.select(
        F.struct("*").alias("__row"),
        F.array_remove(F.split(t, SPACE), "").alias("w"),
        F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD_CHAR)).alias("l"),
        F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
    )
    n, n_lines = F.size("w"), F.size("l")
    # Windows of three words with their place, sorted so that equal windows are neighbours.
    windows = F.sort_array(
        F.arrays_zip(
            F.slice("w", F.lit(1), n - 2).alias("a"),
            F.slice("w", F.lit(2), n - 2).alias("b"),
            F.slice("w", F.lit(3), n - 2).alias("c"),
            F.sequence(F.lit(0), n - 3).alias("i"),
        )
    )
    ordered = lists.withColumn("g", F.when(n >= 4, windows))

    def same(j: Column) -> Column:
        x, y = F.col("g")[j], F.col("g")[j - 1]
        return (x["c"] == y["c"]) & (x["b"] == y["b"]) & (x["a"] == y["a"])

    def covered(j: Column) -> Column:
        x, y = F.col("g")[j]["i"], F.col("g")[j - 1]["i"]
        return F.array(x, x + 1, x + 2, y, y + 1, y + 2)

    equal = F.filter(F.sequence(F.lit(1), F.size("g") - 1), same)
    counts = {
        "n_words": n,
        "word_chars": F.length(F.array_join("w", "")),
        "n_symbols": F.col("n_symbols"),
        "n_dup_lines": n_lines - F.size(F.array_distinct("l")),
        "n_repeat_words": F.when(F.col("g").isNull(), 0).otherwise(F.size(F.array_distinct(F.flatten(F.transform(equal, covered))))),
        "n_lines": n_lines,
        "n_stop": F.size(F.filter("w", lambda x: x.isin(*STOP_WORDS))),
        "n_bullets": F.size(F.filter("l", lambda x: x.rlike(r"^\s*[•‣▪*-]\s"))),
        "n_ellipsis": F.size(F.filter("l", lambda x: x.rlike(r"(…|\.\.\.)\s*$"))),
    }
    return ordered.select("__row", *(c.cast("long").alias(k) for k, c in counts.items()))


def compile_rules(rules: tuple[Rule, ...] = RULES) -> list[Column]:
    """One boolean column per rule, true where the document fails it."""
    out = []
    for rule in rules:
        m = F.col(rule.measure)
        fails = F.lit(False)
        if rule.low is not None:
            fails = fails | (m < F.lit(rule.low))
        if rule.high is not None:
            fails = fails | (m > F.lit(rule.high))
        out.append(fails.alias(f"fails_{rule.name}"))
    return out


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` plus one struct column ``quality``: counts, ratios, a flag per rule, ``base_failed`` and ``kept``.

    A null or empty text has no words and fails. Rows are judged one by one, so repeated
    rows, repeated ids and null ids stay as they are; an empty table gives an empty
    table. All results sit inside one struct, so they clash with no other column;
    an input column ``quality`` is replaced. Very long texts are measured whole.
    """
    ratios = _measured(docs.drop("quality"), text).select(
        "*",
        _share("word_chars", "n_words").alias("mean_word_chars"),
        _share("n_symbols", "n_words").alias("symbol_ratio"),
        _share("n_stop", "n_words").alias("stop_ratio"),
        _share("n_dup_lines", "n_lines").alias("dup_line_ratio"),
        _share("n_bullets", "n_lines").alias("bullet_ratio"),
        _share("n_ellipsis", "n_lines").alias("ellipsis_ratio"),
        ((F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)).alias("base_failed"),
    )
    flagged = ratios.select("*", *compile_rules(rules))
    failed = reduce(or_, (F.col(f"fails_{rule.name}") for rule in rules), F.col("base_failed"))
    measures = [c for c in flagged.columns if c != "__row"]
    # The row number keeps the optimizer from moving a filter on the verdict below the
    # measures, where it would be a copy of them all.
    kept = ~failed & (F.monotonically_increasing_id() >= 0)
    return flagged.select("__row.*", F.struct(*measures, kept.alias("kept")).alias("quality"))


def quality_filter(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns unchanged."""
    packed = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    return judge(packed, "text", rules).where("quality.kept").select("row.*")
