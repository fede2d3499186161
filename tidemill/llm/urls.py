"""URL rules: expand, join on short hash prefixes, confirm full digests, take the longest rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Characters of the hex digest that the equi-join compares; the rest is confirmed afterwards.
PREFIX = 8

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased; empty without ``://``."""
    return F.translate(_after_scheme(url, r"^([^/?#]*)"), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return _after_scheme(url, r"^[^/?#]*([^?#]*)")


def _after_scheme(url: Column, pattern: str) -> Column:
    at = F.locate("://", url)
    rest = F.substring(url, at + 3, F.length(url))
    return F.coalesce(F.when(at > 0, F.regexp_extract(rest, pattern, 1)), F.lit(""))


def _suffixes(host: Column, counts: list[int]) -> Column:
    """The host's last labels, as many as a rule has: the host itself and parent domains."""
    labels = F.split(host, r"\.")
    fitting = F.filter(_numbers(counts), lambda n: n <= F.size(labels))
    return F.transform(fitting, lambda n: F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."))


def _numbers(values: list[int]) -> Column:
    return F.lit(sorted(values)) if values else F.lit([]).cast("array<int>")


def _digest(host: Column, path: Column) -> Column:
    """The separator cannot be part of a host, so two pairs never give one text."""
    return F.sha2(F.concat(host, F.lit("/"), path), 256)


def judge(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", host: str = "host", path: str = "path", rule: str = "rule", verdict: str = "verdict"
) -> DataFrame:
    """``pages`` plus host, path, rule and verdict; same-named columns of ``pages`` are replaced.

    ``rules`` has rows (host, path, verdict). A rule fits its host and all subdomains if
    the path starts with the rule's; the longest host and path together win, then the
    longer host, then ``block``. Without a fitting rule the rule is null and the verdict
    is ``default``. A null url, or one without ``://``, has an empty host and path and
    fits only a rule that is empty itself. Repeated rows are judged each; an empty table
    or an empty rule table is no special case; rules with a null host, path or verdict
    fit nothing.

    Host and path are cut only at the numbers of labels and the lengths that rules
    have, so a url has as many expressions as there are such pairs, however long it is. No size of the rule table is
    assumed: Spark broadcasts it when its size allows and shuffles otherwise, and
    adaptive execution splits the expressions that most urls share. Each page's
    matches are combined before they are shuffled.
    """
    known = rules.where("host is not null and path is not null and verdict is not null").select(
        F.translate("host", UPPER, LOWER).alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict")
    )
    known = known.withColumn("r_digest", _digest(F.col("r_host"), F.col("r_path"))).withColumn(
        "r_key", F.substring("r_digest", 1, PREFIX)
    )
    labels = F.size(F.split("r_host", r"\."))
    seen = known.agg(F.collect_set(F.length("r_path")).alias("lengths"), F.collect_set(labels).alias("labels")).first()
    out = [c for c in pages.columns if c not in (host, path, rule, verdict)]
    # The number of a row stays the same when its scan task is repeated.
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.struct(*(pages[c] for c in out)).alias("page"),
        host_of(pages[url]).alias("host"),
        path_of(pages[url]).alias("path"),
    )
    cuts = F.filter(_numbers(seen["lengths"]), lambda n: n <= F.length("path"))
    hosts = rows.withColumn("h", F.explode_outer(_suffixes(F.col("host"), seen["labels"])))
    expressions = hosts.withColumn("n", F.explode_outer(cuts)).withColumn("p", F.expr("substring(path, 1, n)"))
    expressions = expressions.withColumn("digest", _digest(F.col("h"), F.col("p"))).withColumn("key", F.substring("digest", 1, PREFIX))
    met = expressions.join(known, expressions["key"] == known["r_key"], "left")
    fits = F.col("digest") == F.col("r_digest")
    rank = F.struct(
        F.length(F.concat("r_host", "r_path")).alias("length"),
        F.length("r_host").alias("host_length"),
        (F.col("r_verdict") == "block").alias("blocks"),
        F.concat("r_host", "r_path").alias("rule"),
        F.col("r_verdict").alias("verdict"),
    )
    best = met.groupBy("row").agg(
        F.first("page").alias("page"), F.first("host").alias("host"), F.first("path").alias("path"), F.max(F.when(fits, rank)).alias("best")
    )
    return best.select(
        "page.*",
        F.col("host").alias(host),
        F.col("path").alias(path),
        F.col("best.rule").alias(rule),
        F.coalesce("best.verdict", F.lit(default)).alias(verdict),
    )
