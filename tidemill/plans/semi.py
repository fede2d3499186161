"""Queries over JSON, XML, delimited text, hierarchies and text corpora."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemill.functions import json as js, text as tx
from tidemill.functions.columns import dbl, money
from tidemill.plans.registry import Tables, query

JSON_SQL = """(SELECT event_id, user_id, '{"k": ' || regexp_extract(props, '([0-9]+)', 1) || ', "kind": "' || event_type || '", "big": ' || CASE WHEN value > 50 THEN 'true' ELSE 'false' END
    || ', "tags": ["' || event_type || '", "t' || (user_id % 3) || '"], "at": {"user": ' || user_id || ', "zone": "z' || (user_id % 4) || '"}, "none": null}' AS doc FROM events)"""


def event_json(t: Tables) -> DataFrame:
    """A JSON text per event with every kind of value, made of the event's own columns."""
    text = lambda c: F.col(c).cast("string")
    doc = F.concat(
        F.lit('{"k": '),
        F.regexp_extract("props", "([0-9]+)", 1),
        F.lit(', "kind": "'),
        F.col("event_type"),
        F.lit('", "big": '),
        F.when(F.col("value") > 50, "true").otherwise("false"),
        F.lit(', "tags": ["'),
        F.col("event_type"),
        F.lit('", "t'),
        (F.col("user_id") % 3).cast("string"),
        F.lit('"], "at": {"user": '),
        text("user_id"),
        F.lit(', "zone": "z'),
        (F.col("user_id") % 4).cast("string"),
        F.lit('"}, "none": null}'),
    )
    return t.wide("events", "event_id", "user_id", "props", "event_type", "value").select("event_id", "user_id", doc.alias("doc"))


@query(
    "json_open",
    f"""SELECT event_id, key, CASE WHEN type = 'NULL' THEN NULL ELSE json_extract_string(value, '$') END AS value,
               CAST(CASE type WHEN 'VARCHAR' THEN 1 WHEN 'UBIGINT' THEN 2 WHEN 'BIGINT' THEN 2 WHEN 'DOUBLE' THEN 2 WHEN 'BOOLEAN' THEN 3 WHEN 'ARRAY' THEN 4 WHEN 'OBJECT' THEN 5 ELSE 0 END AS INTEGER) AS type
        FROM (SELECT event_id, unnest(json_keys(doc)) AS key, doc FROM {JSON_SQL}) k,
             LATERAL (SELECT json_extract(doc, '$.' || key) AS value, json_type(doc, '$.' || key) AS type) v""",
)
def json_open(t: Tables) -> DataFrame:
    return js.open_json(event_json(t).select("event_id", "doc"), "doc").drop("doc")


@query(
    "json_open_array",
    f"""SELECT event_id, CAST(i AS VARCHAR) AS key, json_extract_string(doc, '$.tags[' || i || ']') AS value, CAST(1 AS INTEGER) AS type FROM {JSON_SQL}, (VALUES (0), (1)) n(i)""",
)
def json_open_array(t: Tables) -> DataFrame:
    return js.open_json(event_json(t).select("event_id", "doc"), "doc", "$.tags").drop("doc")


@query(
    "json_project",
    f"""SELECT event_id, CAST(doc->>'$.k' AS INTEGER) AS k, doc->>'$.kind' AS kind, CAST(doc->>'$.big' AS BOOLEAN) AS big,
               CAST(doc->>'$.at.user' AS BIGINT) AS user_no, doc->>'$.tags[1]' AS second_tag, CAST(NULL AS INTEGER) AS absent FROM {JSON_SQL}""",
)
def json_project(t: Tables) -> DataFrame:
    fields = [
        ("k", "$.k", "int"),
        ("kind", "$.kind", "string"),
        ("big", "$.big", "boolean"),
        ("user_no", "$.at.user", "bigint"),
        ("second_tag", "$.tags[1]", "string"),
        ("absent", "$.nowhere", "int"),
    ]
    return event_json(t).select("event_id", *js.project_json("doc", fields))


@query(
    "json_array_explode",
    f"""SELECT event_id, doc->>('$.tags[' || i || ']') AS tag, CAST(2 AS INTEGER) AS n_tags, CAST(0 AS INTEGER) AS n_kind, CAST(NULL AS VARCHAR) AS at_scalars
        FROM {JSON_SQL}, (VALUES (0), (1)) n(i)""",
)
def json_array_explode(t: Tables) -> DataFrame:
    rows = event_json(t).select(
        "event_id",
        F.size(js.json_array("doc", "$.tags")).alias("n_tags"),
        F.size(js.json_array("doc", "$.kind")).alias("n_kind"),
        F.array_join(js.json_scalars("doc", "$.at"), ",").alias("at_scalars"),
        F.explode_outer(js.json_scalars("doc", "$.tags")).alias("tag"),
    )
    return rows


@query(
    "json_keep_set",
    f"""SELECT event_id, '{{"at":{{"user":' || user_id || '}},"k":' || (doc->>'$.k') || '}}' AS kept,
               '{{"at":{{"level":' || (user_id % 2) || ',"user":' || user_id || ',"zone":"z' || (user_id % 4) || '"}},"big":' || (doc->>'$.big') || ',"k":"new","kind":"'
               || (doc->>'$.kind') || '","none":null,"tags":["' || (doc->>'$.tags[0]') || '","' || (doc->>'$.tags[1]') || '"]}}' AS changed FROM {JSON_SQL}""",
)
def json_keep_set(t: Tables) -> DataFrame:
    rows = event_json(t)
    return rows.select(
        "event_id",
        js.keep_paths("doc", ["k", "at.user", "at.gone", "away.deep"]).alias("kept"),
        js.set_paths("doc", {"k": F.lit("new"), "at.level": F.col("user_id") % 2}).alias("changed"),
    )


@query(
    "str_split_rows",
    """SELECT word, CAST(ordinal AS INTEGER) AS ordinal, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS word,
              generate_subscripts(string_split(p_name, ' '), 1) AS ordinal FROM part) GROUP BY ALL""",
)
def split_rows(t: Tables) -> DataFrame:
    words = tx.split_rows(t.part.select("p_name"), "p_name", " ")
    return words.groupBy(F.col("value").alias("word"), "ordinal").agg(F.count("*").alias("n"))


@query(
    "str_name_value",
    """SELECT page_id, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page, nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') AS ref,
              nullif(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), '') AS source, CAST(NULL AS VARCHAR) AS second_page FROM pages""",
)
def name_value(t: Tables) -> DataFrame:
    part = F.parse_url("url", F.lit("QUERY"))
    return t.pages.select(
        "page_id",
        tx.name_value(part, "page").alias("page"),
        tx.name_value(part, "ref").alias("ref"),
        tx.name_value(part, "utm_source").alias("source"),
        tx.name_value(part, "page", occurrence=2).alias("second_page"),
    )


@query(
    "xml_roundtrip",
    """SELECT c_custkey, c_name, c_acctbal, c_mktsegment, '<row><c_custkey>' || c_custkey || '</c_custkey><c_name>' || c_name || '</c_name></row>' AS short_xml FROM customer""",
)
def xml_roundtrip(t: Tables) -> DataFrame:
    """Rows to XML text and back to typed columns."""
    columns = ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"]
    flat = {"rowTag": "row", "indent": ""}
    xml = t.customer.select(
        F.to_xml(F.struct(*columns), {"rowTag": "row"}).alias("xml"),
        F.to_xml(F.struct("c_custkey", "c_name"), flat).alias("short"),
    )
    back = F.from_xml("xml", "c_custkey BIGINT, c_name STRING, c_acctbal DOUBLE, c_mktsegment STRING", {"rowTag": "row"})
    return xml.select(back.alias("r"), F.trim(F.regexp_replace("short", r">\s+(<|$)", ">$1")).alias("short_xml")).select("r.*", "short_xml")


@query(
    "hierarchy_rollup",
    """WITH l AS (SELECT r_name, n_name, c_mktsegment, CAST(c_acctbal AS DECIMAL(18,2)) AS b FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
       SELECT path, CAST(len(path) - len(replace(path, '/', '')) - 1 AS INTEGER) AS level, CAST(sum(b) AS DOUBLE) AS balance, count(*) AS n,
              CASE WHEN path = '/' THEN NULL WHEN len(path) - len(replace(path, '/', '')) = 2 THEN '/' ELSE regexp_replace(path, '[^/]+/$', '') END AS parent
       FROM (SELECT '/' AS path, b FROM l UNION ALL SELECT '/' || r_name || '/', b FROM l UNION ALL SELECT '/' || r_name || '/' || n_name || '/', b FROM l
             UNION ALL SELECT '/' || r_name || '/' || n_name || '/' || c_mktsegment || '/', b FROM l) GROUP BY path""",
)
def hierarchy(t: Tables) -> DataFrame:
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    customers = t.customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    path = F.concat(F.lit("/"), F.concat_ws("/", "r_name", "n_name", "c_mktsegment"), F.lit("/"))
    rolled = tx.hierarchy_rollup(
        customers.select(path.alias("path"), money("c_acctbal").alias("b")),
        "path",
        {"balance": F.sum("b"), "n": F.count(F.lit(1))},
    )
    here = F.col("path")
    return rolled.select(
        "path",
        tx.path_level(here).alias("level"),
        dbl("balance").alias("balance"),
        "n",
        tx.ancestor(here, 1).alias("parent"),
    )


TEXT_RULES = [
    tx.Rule("script", r"<script", 100, "Markup"),
    tx.Rule("license", r"(?i)\blicen[sc]e\b", 80, "Legal"),
    tx.Rule("mail", r"[A-Za-z0-9._]+@[A-Za-z0-9]+\.", 70, "Contact"),
    tx.Rule("link", r"https?://", 40, "Link"),
    tx.Rule("long number", r"[0-9]{6,}", 30, "Number"),
    tx.Rule("digit", r"[0-9]", 20, "Number"),
]
RULES_SQL = "(VALUES " + ", ".join(
    f"('{r.name}', '{r.pattern}', {r.score}, '{r.category}')" for r in TEXT_RULES
) + ") r(rule, pattern, score, category)"
CORPUS_SQL = "(SELECT 'doc' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'page', page_id, html FROM pages)"


def corpus(t: Tables) -> DataFrame:
    docs = t.wide("documents", "doc_id", "text").select(F.lit("doc").alias("kind"), F.col("doc_id").alias("id"), "text")
    return docs.unionByName(t.wide("pages", "page_id", "html").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("text")))


@query(
    "corpus_rule_scan",
    f"""WITH l AS (SELECT kind, id, unnest(string_split(text, chr(10))) AS line FROM {CORPUS_SQL}),
        m AS (SELECT kind, id, score FROM l, {RULES_SQL} WHERE NOT starts_with(trim(line, ' '), '#') AND regexp_matches(line, pattern)),
        s AS (SELECT kind, id, count(*) AS n, max(score) AS score FROM m GROUP BY ALL)
        SELECT c.kind, c.id, CAST(len(string_split(text, chr(10))) AS INTEGER) AS n_lines, CAST(coalesce(n, 0) AS INTEGER) AS n_matches, CAST(coalesce(score, 0) AS INTEGER) AS score,
               CASE WHEN score >= 70 THEN 'Critical' WHEN score >= 30 THEN 'High' ELSE 'Low' END AS level
        FROM {CORPUS_SQL} c LEFT JOIN s ON c.kind = s.kind AND c.id = s.id""",
)
def corpus_rule_scan(t: Tables) -> DataFrame:
    return tx.rule_scan(corpus(t), ["kind", "id"], "text", [*tx.CODE_RULES, *TEXT_RULES])


@query(
    "corpus_rule_categories",
    f"""SELECT category, rule, count(*) AS n_matches, count(DISTINCT (kind, id)) AS n_docs, CAST(max(score) AS INTEGER) AS score
        FROM (SELECT kind, id, unnest(string_split(text, chr(10))) AS line FROM {CORPUS_SQL}) l, {RULES_SQL}
        WHERE NOT starts_with(trim(line, ' '), '#') AND regexp_matches(line, pattern) GROUP BY ALL""",
)
def corpus_rule_categories(t: Tables) -> DataFrame:
    hits = tx.rule_matches(corpus(t), ["kind", "id"], "text", [*tx.CODE_RULES, *TEXT_RULES])
    return hits.groupBy("category", "rule").agg(
        F.count("*").alias("n_matches"), F.count_distinct("kind", "id").alias("n_docs"), F.max("score").alias("score")
    )


CODE_LINES = {r.name: r.example for r in tx.CODE_RULES}
PLANTED = [*CODE_LINES.values(), "# df.collect()", "df.collect().count()", "mydbutilsx = 1"]


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


PLANTED_SQL = f"(SELECT doc_id, text || chr(10) || ([{', '.join(map(_quoted, PLANTED))}])[1 + doc_id % {len(PLANTED)}] AS text FROM documents)"
EVERY_RULE_SQL = "(VALUES " + ", ".join(
    f"({_quoted(r.name)}, {_quoted(r.pattern)}, {r.score}, {_quoted(r.category)})" for r in [*tx.CODE_RULES, *TEXT_RULES]
) + ") r(rule, pattern, score, category)"


@query(
    "corpus_code_rules",
    f"""SELECT category, rule, count(*) AS n_matches, count(DISTINCT doc_id) AS n_docs, CAST(max(score) AS INTEGER) AS score
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM {PLANTED_SQL}) l, {EVERY_RULE_SQL}
        WHERE NOT starts_with(trim(line, ' '), '#') AND regexp_matches(line, pattern) GROUP BY ALL""",
)
def corpus_code_rules(t: Tables) -> DataFrame:
    """All rules over the documents, each with a line of code behind its text that one of the rules is about."""
    line = F.element_at(F.lit(PLANTED), (F.col("doc_id") % len(PLANTED) + 1).cast("int"))
    docs = t.wide("documents", "doc_id", "text").select("doc_id", F.concat("text", F.lit("\n"), line).alias("text"))
    hits = tx.rule_matches(docs, ["doc_id"], "text", [*tx.CODE_RULES, *TEXT_RULES])
    return hits.groupBy("category", "rule").agg(F.count("*").alias("n_matches"), F.count_distinct("doc_id").alias("n_docs"), F.max("score").alias("score"))


PATH_LINES_SQL = """(SELECT page_id, html || chr(10) || 'a = load("s3://' || regexp_extract(url, '//([^/]+)', 1) || '/p' || page_id % 7 || '.csv")'
    || chr(10) || 'b = load(''../../in/' || regexp_extract(url, '//([^/]+)', 1) || '/x'')' || chr(10) || 'c = load("/data/d' || page_id % 5 || '/part.parquet") + load("./local.d")'
    || chr(10) || 'd = load("@OLD/gs/n' || page_id % 3 || '/{day}.json") + load("s3://hidden/by/stage")' || chr(10) || 'e = "file:///tmp/' || page_id % 4 || '.txt"' AS text FROM pages)"""


def path_lines(t: Tables) -> DataFrame:
    """Each page followed by five lines of load calls on paths made of its address."""
    host, n = F.regexp_extract("url", "//([^/]+)", 1), F.col("page_id")
    num = lambda k: (n % k).cast("string")
    lines = [
        F.col("html"),
        F.concat(F.lit('a = load("s3://'), host, F.lit("/p"), num(7), F.lit('.csv")')),
        F.concat(F.lit("b = load('../../in/"), host, F.lit("/x')")),
        F.concat(F.lit('c = load("/data/d'), num(5), F.lit('/part.parquet") + load("./local.d")')),
        F.concat(F.lit('d = load("@OLD/gs/n'), num(3), F.lit('/{day}.json") + load("s3://hidden/by/stage")')),
        F.concat(F.lit('e = "file:///tmp/'), num(4), F.lit('.txt"')),
    ]
    return t.wide("pages").select("page_id", F.concat_ws("\n", *lines).alias("text"))


PROTO_SQL = "hdfs|s3|s3a|s3n|abfs|abfss|wasb|wasbs|adl|gs|file|https|http"


@query(
    "corpus_path_inventory",
    f"""WITH l AS (SELECT page_id, unnest(string_split(text, chr(10))) AS line FROM {PATH_LINES_SQL}),
        s AS (SELECT page_id, line, regexp_extract_all(line, '@[A-Za-z0-9_]+/[A-Za-z0-9]+/[^\\s"'']+') AS staged FROM l),
        p AS (SELECT page_id, unnest(CASE WHEN len(staged) > 0 THEN staged ELSE list_concat(list_concat(
                regexp_extract_all(line, '["'']((?:{PROTO_SQL})://[^\\s"'']+)["'']', 1),
                regexp_extract_all(line, '["''](/[a-zA-Z0-9_/.\\-]+\\.(?:csv|parquet|json|avro|orc|txt|data|tsv))["'']', 1)),
                regexp_extract_all(line, '["''](\\.\\.?/[^\\s"'']+)["'']', 1)) END) AS path FROM s),
        k AS (SELECT *, CASE WHEN path LIKE '@%' THEN 'stage' WHEN path LIKE '%://%' THEN 'protocol' WHEN path LIKE '/%' THEN 'absolute' ELSE 'relative' END AS kind FROM p)
        SELECT path, kind, count(*) AS n, count(DISTINCT page_id) AS n_pages,
               CASE WHEN kind = 'stage' THEN regexp_replace(path, '^@[A-Za-z0-9_]+/', '@lake/') WHEN path LIKE 'file://%' THEN '@lake/local/' || ltrim(substr(path, 8), '/')
                    WHEN kind = 'protocol' THEN '@lake/' || split_part(path, '://', 1) || '/' || substr(path, instr(path, '://') + 3)
                    WHEN kind = 'absolute' THEN '@lake/local/' || ltrim(path, '/') WHEN path LIKE './%' THEN '@lake/relative/' || substr(path, 3)
                    ELSE '@lake/relative/parent' || CASE WHEN path LIKE '../../%' THEN '2' ELSE '' END || '/' || replace(path, '../', '') END AS target,
               CASE WHEN path LIKE '%{{%}}%' THEN 'needs_revision' ELSE 'replaced' END AS status
        FROM k GROUP BY ALL""",
)
def path_inventory(t: Tables) -> DataFrame:
    lines = path_lines(t).select("page_id", F.explode(F.split("text", "\n")).alias("line"))
    protocols = [*tx.PROTOCOLS, "https", "http"]
    found = lines.select("page_id", F.explode(tx.storage_paths(F.col("line"), protocols)).alias("path"))
    counts = found.groupBy("path").agg(F.count("*").alias("n"), F.count_distinct("page_id").alias("n_pages"))
    path = F.col("path")
    return counts.select(
        "path", tx.path_kind(path).alias("kind"), "n", "n_pages", tx.staged_path(path, "lake").alias("target")
    ).withColumn("status", tx.rewrite_status(path, F.col("target")))
