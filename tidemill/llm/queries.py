"""One query per operator of this package, and the SQL that checks it where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemill.llm import bpe, conversations, decontaminate, digests, lines, negatives, quality, records, simhash, suffixes, toxicity, urls, warc
from tidemill.session import scratch_path

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    def register(build: Builder) -> Builder:
        QUERIES[name] = build
        if sql:
            SQL[name] = sql
        return build

    return register


def table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path.rstrip('/')}/{name}.parquet")


STOP_LIST = ", ".join(f"'{w}'" for w in dict.fromkeys(quality.STOP_WORDS))

#: Also the first stage of the pipeline, which needs the row number.
QUALITY_SQL = rf"""
WITH rows_ AS (SELECT row_number() OVER () AS rid, * FROM {{docs}}),
d AS (
    SELECT *, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
    FROM rows_
),
g AS (
    SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i + 1], w[i + 2]) AS n
    FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d)
),
r AS (SELECT rid, count(DISTINCT p) AS n_repeat_words FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM g WHERE n > 1) GROUP BY rid),
m AS (
    SELECT d.*, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
           (length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
           (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
           len(list_filter(w, lambda x: x IN ({STOP_LIST}))) AS n_stop,
           len(list_filter(l, lambda x: regexp_matches(x, '^\s*[•‣▪*-]\s'))) AS n_bullets,
           len(list_filter(l, lambda x: regexp_matches(x, '(…|\.\.\.)\s*$'))) AS n_ellipsis
    FROM d LEFT JOIN r USING (rid)
),
judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
                OR n_symbols / n_words > 0.1 OR n_stop / n_words < 0.02 OR n_dup_lines / len(l) > 0.6
                OR n_bullets / len(l) > 0.9 OR n_ellipsis / len(l) > 0.3) AS kept
    FROM m
)
"""


@query(
    "op7_quality",
    QUALITY_SQL.format(docs="documents")
    + "SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged",
)
def op7_quality(spark: SparkSession, path: str) -> DataFrame:
    docs = table(spark, path, "documents").select("doc_id", "text")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return quality.judge(docs).select("doc_id", *(f"quality.{n}" for n in names))


@query("op3_simhash")
def op3_simhash(spark: SparkSession, path: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, path, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash.hex_digits().alias("fingerprint"), F.col("component").alias("component_id"))


# The rules of the check.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
URL_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)


@query(
    "op2_url_filter",
    rf"""
WITH r(h, p, v) AS (VALUES {URL_RULE_ROWS}),
u AS (
    SELECT row_number() OVER () AS rid, page_id,
           CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
),
s AS (
    SELECT rid, page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{urls.UPPER}', '{urls.LOWER}') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM u
),
m AS (
    SELECT s.rid, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v
    FROM s JOIN r ON (s.host = h OR ends_with(s.host, '.' || h)) AND starts_with(s.path, p) GROUP BY s.rid
)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM s LEFT JOIN m USING (rid)
""",
)
def op2_url_filter(spark: SparkSession, path: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM VALUES {URL_RULE_ROWS} AS r(host, path, verdict)")
    return urls.judge(table(spark, path, "pages").select("page_id", "url"), rules).drop("url")


@query(
    "op10_warc",
    """
WITH d AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
b AS (
    SELECT *, list_aggregate(list_transform(range(1, 41), lambda i: right('000' || bin(strpos('0123456789abcdef', substr(h, i, 1)) - 1), 4)), 'string_agg', '') AS bits
    FROM d
),
c AS (
    SELECT page_id, strlen(t)::BIGINT AS payload_bytes, max(page_id) OVER (PARTITION BY t) AS m,
           list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1
               + 16 * substr(bits, 5 * i + 1, 1)::INT + 8 * substr(bits, 5 * i + 2, 1)::INT + 4 * substr(bits, 5 * i + 3, 1)::INT
               + 2 * substr(bits, 5 * i + 4, 1)::INT + substr(bits, 5 * i + 5, 1)::INT, 1)), 'string_agg', '') AS payload_digest
    FROM b
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = m THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> m THEN m END AS refers_to
FROM c
""",
)
def op10_warc(spark: SparkSession, path: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    warc.write_archives(table(spark, path, "pages"), folder)
    return warc.read_archives(spark, folder, payload=False, verify=True).select(
        warc.key_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", warc.key_of("refers_to").alias("refers_to")
    )


@query("op8_bpe")
def op8_bpe(spark: SparkSession, path: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    tokens = bpe.encode(table(spark, path, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.decode(tokens, ranks).select(
        F.col("id").alias("doc_id"), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query("op9_records")
def op9_records(spark: SparkSession, path: str) -> DataFrame:
    folder = scratch_path(spark, "records")
    records.write_tokens(table(spark, path, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return records.read_tokens(spark, folder).select(F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op6_decontaminate")
def op6_decontaminate(spark: SparkSession, path: str) -> DataFrame:
    """One row per document and benchmark item that it holds."""
    found = decontaminate.find(table(spark, path, "documents"), table(spark, path, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), F.col("windows").alias("n_windows"), F.col("first").alias("first_token"))


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, path: str) -> DataFrame:
    def held_out(key):
        return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))

    docs = table(spark, path, "documents").select("doc_id", "text")
    labels = table(spark, path, "labels").where(~held_out(F.col("doc_id"))).select("doc_id", "toxic")
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select(
        F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query("op5_line_dedup")
def op5_line_dedup(spark: SparkSession, path: str) -> DataFrame:
    """Per document: removed lines, and the hash of the text that is left."""
    kept = lines.deduplicate(table(spark, path, "documents").select("doc_id", "text"))
    return kept.select("doc_id", F.col("removed_lines").cast("long").alias("n_removed"), F.sha2("text", 256).alias("kept_sha256"))


@query("pipeline")
def pipeline(spark: SparkSession, path: str) -> DataFrame:
    return corpus_pipeline.run(spark, path)


@query("op1_suffix_dedup")
def op1_suffix_dedup(spark: SparkSession, path: str) -> DataFrame:
    kept = suffixes.deduplicate(table(spark, path, "documents"))
    return kept.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query(
    "op11_exact_dedup",
    r"""
WITH d AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256, length(coalesce(text, '')) AS n
    FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST)
""",
)
def op11_exact_dedup(spark: SparkSession, path: str) -> DataFrame:
    index = digests.DigestIndex(spark, scratch_path(spark, "digest-index"))
    return index.add(table(spark, path, "documents"), "documents").select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def damaged(turns: DataFrame) -> DataFrame:
    """The turns with the faults of the check: dropped, emptied, cut, repeated or given the role user by a hash."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn"))) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace(word("text"), "[.!?]", "")).otherwise(word("text"))
    role = F.when(fate == 4, "user").otherwise(word("role"))
    copies = F.when(fate == 3, 2).when(fate == 0, 0).otherwise(1)
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).drop("col")


@query("op13_conversations")
def op13_conversations(spark: SparkSession, path: str) -> DataFrame:
    turns = table(spark, path, "conversations")
    found = conversations.Repair(damaged(turns)).summary().withColumnRenamed("conv", "conv_id").withColumnRenamed("sha", "repaired_sha256")
    # Conversations that lost all their rows have nothing to repair.
    ids = turns.select("conv_id").distinct().select(
        "conv_id", *(F.lit(0).cast("long").alias(c) for c in conversations.COUNTS), F.lit("").alias("audit"), F.sha2(F.lit(""), 256).alias("repaired_sha256")
    )
    both = found.withColumn("from", F.lit(1)).unionByName(ids.withColumn("from", F.lit(0)))
    columns = (*conversations.COUNTS, "audit", "repaired_sha256")
    return both.groupBy("conv_id").agg(F.max_by(F.struct(*columns), "from").alias("r")).select("conv_id", *(f"r.{c}" for c in columns))


@query(
    "op12_hard_negatives",
    """
WITH e AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
    FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)::INT AS rank,
       n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= 5
""",
)
def op12_hard_negatives(spark: SparkSession, path: str) -> DataFrame:
    rows = table(spark, path, "embeddings")
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("embedding", lambda x: F.floor(F.lit(256.0) * x.cast("double")))
    rows = rows.where(F.col("embedding").isNotNull() & finite).select("vec_id", label.alias("label"), whole.alias("vector"))
    return negatives.mine(rows, F.col("vec_id") % 100 == 0)
