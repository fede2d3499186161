"""Text to rows and columns, paths and rule scans."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from tidemill.functions.labels import first_match


def split_rows(df: DataFrame, column: str, delimiter: str) -> DataFrame:
    """One row per piece with its ordinal from 1; the delimiter is plain text."""
    pieces = F.split(F.col(column), re.escape(delimiter))
    return df.select("*", F.posexplode(pieces).alias("__pos", "value")).withColumn(
        "ordinal", F.col("__pos") + 1
    ).drop("__pos")


def name_value(text: Column, name: str, pair_ends: Sequence[str] = ("&",), value_marks: Sequence[str] = ("=",), occurrence: int = 1) -> Column:
    """Value of the n-th pair that begins with the name."""
    either = lambda marks: "|".join(re.escape(m) for m in sorted(marks, key=len, reverse=True))
    pairs = F.filter(F.split(text, either(pair_ends)), lambda p: p.startswith(name))
    found = F.try_element_at(pairs, F.lit(occurrence))
    return F.try_element_at(F.split(found, either(value_marks)), F.lit(2))


def path_level(path: Column) -> Column:
    """Number of names in ``/a/b/c/``."""
    return F.size(F.filter(F.split(path, "/"), lambda p: p != ""))


def ancestor(path: Column, up: int) -> Column:
    """The path ``up`` levels higher; ``/`` at the top, null beyond it."""
    names = F.filter(F.split(path, "/"), lambda p: p != "")
    n = F.size(names)
    higher = F.concat(F.lit("/"), F.array_join(F.slice(names, F.lit(1), F.greatest(n - up, F.lit(0))), "/"), F.lit("/"))
    return F.when(n < up, F.lit(None)).when(n == up, F.lit("/")).otherwise(higher)


def hierarchy_rollup(df: DataFrame, path: str, measures: dict[str, Column], merge: dict[str, Callable] | None = None) -> DataFrame:
    """Measures for every path and all its ancestors.

    ``merge`` says how a measure of leaves becomes that of an ancestor, such as
    ``F.max``; sums and counts, which need no entry, are added up. Leaves are summed first, so a path is expanded once per leaf and not once per row.
    """
    leaves = df.groupBy(path).agg(*[m.alias(n) for n, m in measures.items()])
    names = F.filter(F.split(F.col(path), "/"), lambda p: p != "")
    above = F.transform(
        F.sequence(F.lit(1), F.size(names)),
        lambda k: F.concat(F.lit("/"), F.array_join(F.slice(names, F.lit(1), k), "/"), F.lit("/")),
    )
    each = leaves.withColumn("__path", F.explode(F.concat(F.array(F.lit("/")), above)))
    return each.groupBy(F.col("__path").alias(path)).agg(*[(merge or {}).get(n, F.sum)(n).alias(n) for n in measures])


@dataclass(frozen=True)
class Rule:
    name: str
    pattern: str
    score: int
    category: str
    literal: str = ""
    #: A line of our own that the rule is about, for checks.
    example: str = ""

    def found(self, line: Column) -> Column:
        """Matches the line; the literal every match contains is looked for first, which is far cheaper."""
        return line.contains(self.literal) & line.rlike(self.pattern) if self.literal else line.rlike(self.pattern)


# The rules a code scan must apply, as name, pattern, score, category.
_CODE_RULES = [
    Rule(".rdd", r"\.rdd\b", 100, "RDD Operation", example="x = df.rdd.map(f)"),
    Rule("sc.parallelize", r"\bsc\.parallelize\s*\(", 100, "RDD Operation", example="sc.parallelize ([1])"),
    Rule("sc.textFile", r"\bsc\.textFile\s*\(", 100, "RDD Operation", example="sc.textFile(p)"),
    Rule("dbutils", r"\bdbutils\b", 100, "Databricks Runtime", example="dbutils.fs.ls(p)"),
    Rule("DeltaTable", r"\bDeltaTable\b", 100, "Delta Lake", example="t = DeltaTable"),
    Rule("delta.tables", r"(?:from|import)\s+delta\.tables", 100, "Delta Lake", example="from delta.tables import x"),
    Rule("sparkContext._jvm", r"sparkContext\._jvm\b", 100, "JVM Interop", example="s.sparkContext._jvm.x"),
    Rule("sparkContext._jsc", r"sparkContext\._jsc\b", 100, "JVM Interop", example="s.sparkContext._jsc.y"),
    Rule("sparkContext.hadoopConfiguration", r"sparkContext\.hadoopConfiguration", 100, "JVM Interop", example="sparkContext.hadoopConfiguration"),
    Rule("pyspark.streaming", r"(?:from|import)\s+pyspark\.streaming", 100, "Structured Streaming", example="import pyspark.streaming"),
    Rule("readStream", r"\.readStream\b", 100, "Structured Streaming", example="s.readStream.load()"),
    Rule("writeStream", r"\.writeStream\b", 100, "Structured Streaming", example="df.writeStream.start()"),
    Rule("pyspark.ml", r"(?:from|import)\s+pyspark\.ml\b", 100, "ML Pipeline", example="from  pyspark.ml import z"),
    Rule(".collect()", r"\.collect\s*\(\s*\)", 80, "Memory Anti-Pattern", example="df.collect( )"),
    Rule(".count()", r"\.count\s*\(\s*\)", 80, "Memory Anti-Pattern", example="df.count()"),
    Rule("sparkContext.broadcast", r"sparkContext\.broadcast\b", 70, "SparkContext Property", example="sparkContext.broadcast(a)"),
    Rule("sparkContext.accumulator", r"sparkContext\.accumulator\b", 70, "SparkContext Property", example="sparkContext.accumulator(0)"),
    Rule(".cache()", r"\.cache\s*\(\s*\)", 60, "Memory Anti-Pattern", example="df.cache ()"),
    Rule("sparkContext.statusTracker", r"sparkContext\.statusTracker\b", 60, "SparkContext Property", example="sparkContext.statusTracker"),
    Rule(".toPandas()", r"\.toPandas\s*\(\s*\)", 50, "Memory Anti-Pattern", example="df.toPandas()"),
    Rule("applyInPandas", r"\.applyInPandas\s*\(", 50, "UDF Serialization", example="g.applyInPandas(f)"),
    Rule("mapInPandas", r"\.mapInPandas\s*\(", 50, "UDF Serialization", example="d.mapInPandas (f)"),
    Rule("unionByName", r"\.unionByName\s*\(", 40, "API Compatibility", example="a.unionByName(b)"),
    Rule("sparkContext.master", r"sparkContext\.master\b", 40, "SparkContext Property", example="sparkContext.master"),
    Rule("SparkSession.builder", r"SparkSession\.builder\b", 30, "Session Initialization", example="SparkSession.builder.x"),
    Rule("sparkContext.getConf", r"sparkContext\.getConf\b", 30, "SparkContext Property", example="sparkContext.getConf"),
    Rule(".hint(", r"\.hint\s*\(", 20, "No-Op API", example="d.hint(h)"),
    Rule(".repartition(", r"\.repartition\s*\(", 20, "No-Op API", example="d.repartition(8)"),
    Rule(".coalesce(", r"\.coalesce\s*\(", 20, "No-Op API", example="d.coalesce(1)"),
]
# The name of a code rule without its brackets is part of every match.
CODE_RULES = [replace(rule, literal=rule.name.rstrip("()")) for rule in _CODE_RULES]


def risk_level(score: Column) -> Column:
    return first_match([(score >= 70, "Critical"), (score >= 30, "High")], "Low")


def rule_matches(df: DataFrame, keys: Sequence[str], text: str, rules: Sequence[Rule], comment: str = "#") -> DataFrame:
    """One row per line and rule that matches; comment lines are skipped."""
    lines = df.select(*keys, F.posexplode(F.split(F.col(text), "\n")).alias("__pos", "line"))
    code = lines.where(~F.trim("line").startswith(comment))
    hit = lambda r: F.when(
        r.found(F.col("line")),
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.score).alias("score"), F.lit(r.category).alias("category")),
    )
    found = code.withColumn("__hit", F.explode(F.array_compact(F.array(*[hit(r) for r in rules]))))
    return found.select(*keys, (F.col("__pos") + 1).alias("line_number"), "line", "__hit.*")


def rule_scan(df: DataFrame, keys: Sequence[str], text: str, rules: Sequence[Rule], comment: str = "#") -> DataFrame:
    """Lines, matches, highest score and level per document.

    Lines are looked at inside the row, so nothing is shuffled.
    """
    lines = F.split(F.col(text), "\n")
    code = F.filter(lines, lambda line: ~F.trim(line).startswith(comment))

    def matching(rule: Rule) -> Column:
        count = F.size(F.filter(F.col("__code"), lambda line: line.rlike(rule.pattern)))
        return F.when(F.col(text).contains(rule.literal), count).otherwise(0) if rule.literal else count

    hits = {f"__r{i}": matching(r) for i, r in enumerate(rules)}
    scanned = df.select(*keys, text, F.size(lines).alias("n_lines"), code.alias("__code")).withColumns(hits)
    score = F.greatest(F.lit(0), *[F.when(F.col(h) > 0, r.score) for h, r in zip(hits, rules)])
    total = sum((F.col(h) for h in hits), F.lit(0))
    return scanned.select(*keys, "n_lines", total.alias("n_matches"), score.alias("score")).withColumn(
        "level", risk_level(F.col("score"))
    )


# Storage protocols and file endings a path may have.
PROTOCOLS = ["hdfs", "s3", "s3a", "s3n", "abfs", "abfss", "wasb", "wasbs", "adl", "gs", "file"]
ENDINGS = ["csv", "parquet", "json", "avro", "orc", "txt", "data", "tsv"]

#: What stands between two quotes without a blank, and a path below a stage, quoted or not.
QUOTED = r"""(?<=(["']))[^\s"']+(?=\1)"""
STAGED = r"""@(?:"[^"]+"|\w+)(?:/[^\s"'/]+)+/[^\s"']+"""


def storage_paths(line: Column, protocols: Sequence[str] = tuple(PROTOCOLS)) -> Column:
    """Array of the quoted paths of a line; staged paths, where there are any, go before all others.

    Every quoted word is a candidate; its kind says what else it must have: a known
    protocol, a known ending behind plain characters, or something behind the dots.
    """

    def is_path(word: Column) -> Column:
        needs = {
            "protocol": F.lower(F.substring_index(word, "://", 1)).isin(*protocols),
            "absolute": word.rlike(r"^[\w/.-]+\w$") & F.lower(F.substring_index(word, ".", -1)).isin(*ENDINGS) & word.contains("."),
            "relative": word.rlike("^[.]{1,2}/."),
        }
        return first_match([(path_kind(word) == kind, test) for kind, test in needs.items()], False)

    staged = F.regexp_extract_all(line, F.lit(STAGED), F.lit(0))
    quoted = F.filter(F.regexp_extract_all(line, F.lit(QUOTED), F.lit(0)), is_path)
    return F.when(F.size(staged) > 0, staged).otherwise(quoted)


def path_kind(path: Column) -> Column:
    return first_match(
        [(path.startswith("@"), "stage"), (path.contains("://"), "protocol"), (path.startswith("/"), "absolute")],
        "relative",
    )


def is_dynamic(path: Column) -> Column:
    """The path holds a ``{variable}``."""
    return path.rlike(r"\{[^}]+\}")


def staged_path(path: Column, prefix: str) -> Column:
    """The path below a stage: ``@prefix/protocol/rest``."""
    at = "@" + prefix.lstrip("@")
    up = F.regexp_count(path, F.lit(r"(?:^|/)\.\.(?=/|$)"))
    below = F.regexp_replace(F.regexp_replace(path, r"(?:^|(?<=/))\.\.?/", ""), "/+", "/")
    protocol = F.lower(F.regexp_extract(path, "^([A-Za-z0-9]+)://", 1))
    after = F.regexp_replace(path, "^[A-Za-z0-9]+://", "")
    return first_match(
        [
            (path.startswith("${"), None),
            (path.startswith("@"), F.regexp_replace(path, r"""^@(?:"[^"]+"|[A-Za-z0-9_]+)/""", f"{at}/")),
            (protocol == "file", F.concat(F.lit(f"{at}/local/"), F.ltrim(after, F.lit("/")))),
            (protocol != "", F.concat(F.lit(f"{at}/"), protocol, F.lit("/"), after)),
            (path.startswith("/"), F.concat(F.lit(f"{at}/local/"), F.ltrim(path, F.lit("/")))),
            (path.startswith("./"), F.concat(F.lit(f"{at}/relative/"), F.substr(path, F.lit(3)))),
            (up == 1, F.concat(F.lit(f"{at}/relative/parent/"), below)),
            (up > 1, F.concat(F.lit(f"{at}/relative/parent"), up.cast("string"), F.lit("/"), below)),
        ]
    )


def rewrite_status(path: Column, target: Column) -> Column:
    return first_match(
        [(path.startswith("${"), "needs_revision"), (target.isNull(), "skipped"), (is_dynamic(path), "needs_revision")],
        "replaced",
    )
