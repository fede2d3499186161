"""Queries over synthetic data. Rows are derived from keys of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemill.operators import synthetic as syn
from tidemill.plans.registry import Tables, query

FIELDS = [
    syn.Field("amount", "decimal", (("gte", 10), ("gt", 25), ("lt", 900), ("lte", 500), ("not_null", None))),
    syn.Field("units", "int", (("between", (5, 40)), ("lte", 30))),
    syn.Field("status", "string", (("in", ["open", "done", "late"]), ("is_null", None))),
    syn.Field("currency", "string", (("equals", "USD"), ("not_null", None))),
    syn.Field("booked", "date", (("not_null", None),)),
]


def _draw(name: str, key: str = "o_orderkey") -> str:
    return f"(CAST('0x' || substr(md5('42:{name}:' || {key}), 1, 13) AS BIGINT) / 4503599627370496.0)"


@query(
    "synth_domain",
    f"""SELECT o_orderkey, CAST(round(CAST(25 + {_draw('amount')} * 475.0 AS DECIMAL(24,8)), 2) AS DOUBLE) AS amount,
        CASE WHEN {_draw('units:null')} >= 0.05 THEN CAST(5 + floor({_draw('units')} * 26) AS BIGINT) END AS units,
        CASE WHEN {_draw('status:null')} >= 0.2 THEN (['open', 'done', 'late'])[CAST(floor({_draw('status')} * 3) AS INTEGER) + 1] END AS status,
        'USD' AS currency, CAST(DATE '2024-10-01' + CAST(-365 + floor({_draw('booked')} * 366) AS INTEGER) AS DATE) AS booked FROM orders""",
)
def domain(t: Tables) -> DataFrame:
    return syn.generate(t.wide("orders", "o_orderkey"), "o_orderkey", FIELDS)


@query(
    "synth_join_aware",
    f"""WITH p AS (SELECT c_custkey, CAST(round(1e9 / pow(row_number() OVER (ORDER BY c_custkey), 0.8)) AS BIGINT) AS w FROM customer),
        c AS (SELECT c_custkey, w, sum(w) OVER (ORDER BY c_custkey) AS upto FROM p),
        d AS (SELECT o_orderkey, CAST(floor({_draw('parent')} * (SELECT sum(w) FROM p)) AS BIGINT)+ 1 AS pos, {_draw('miss')} < 0.1 AS missed FROM orders)
        SELECT o_orderkey, c_custkey FROM d JOIN c ON pos > upto - w AND pos <= upto WHERE NOT missed UNION ALL SELECT o_orderkey, -1 - o_orderkey FROM d WHERE missed""",
)
def join_aware(t: Tables) -> DataFrame:
    return syn.skewed_children(t.customer, "c_custkey", t.wide("orders", "o_orderkey"), "o_orderkey", miss_rate=0.1)


ORDER_TYPES = {"o_custkey": "int", "o_totalprice": "decimal", "o_orderdate": "date", "o_orderpriority": "string"}


def _text_sql(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _options_sql(options: list[str], u: str) -> str:
    return f"([{', '.join(options)}])[CAST(floor({u} * {len(options)}) AS INTEGER) + 1]"


def _format_sql(name: str, *values) -> str:
    """The format of the noise table as an expression on ``original``."""
    if name == "case":
        return "upper(original)" if values[0] else "lower(original)"
    a, b = map(_text_sql, values)
    if name == "replace":
        return f"replace(original, {a}, {b})"
    around = f"{a} || original || {b}"
    return f"({around})" if name == "around" else f"CASE WHEN starts_with(original, '-') THEN original ELSE {around} END"


def _noise_sql(column: str, kind_of: str, original: str) -> str:
    """The spoilt cells of one column, drawn as the operator draws them."""
    kinds = {k: syn.NOISE_WEIGHTS[k] for k in syn.KINDS_BY_TYPE[kind_of]}
    upto, cases, u = 0.0, [], _draw(f"{column}:which")
    for name, weight in list(kinds.items())[:-1]:
        upto += weight / sum(kinds.values())
        cases.append(f"WHEN {_draw(f'{column}:kind')} < {upto!r}::DOUBLE THEN '{name}'")
    number = kind_of in ("int", "decimal")
    edges = {"int": [str(v) for v in syn.INT_EDGES], "decimal": syn.DECIMAL_EDGES}.get(kind_of, [None])
    poison = {"date": syn.DATE_POISON, "string": syn.TEXT_POISON}.get(kind_of, syn.NUMBER_POISON)
    made = {
        "boundary": [_text_sql(v) for v in edges],
        "format_drift": [_format_sql(*f) for f in (syn.NUMBER_FORMATS if number else syn.TEXT_FORMATS)],
        "type_poison": [_text_sql(v) for v in poison],
        "temporal_drift": [_text_sql(v) for v in syn.WRONG_DATES],
    }
    noisy = " ".join(f"WHEN '{k}' THEN {_options_sql(v, 'u')}" for k, v in made.items())
    return f"""SELECT o_orderkey, '{column}' AS column_name, kind, original, CASE kind {noisy} END AS noisy
        FROM (SELECT o_orderkey, CASE {' '.join(cases)} ELSE '{list(kinds)[-1]}' END AS kind, CAST({original} AS VARCHAR) AS original, {u} AS u
              FROM orders WHERE {_draw(f'{column}:hit')} < 0.1)"""


NOISE_SQL = " UNION ALL ".join(
    _noise_sql(c, kind, "CAST(o_orderdate AS DATE)" if c == "o_orderdate" else c) for c, kind in ORDER_TYPES.items()
)


@query("synth_noise", NOISE_SQL)
def noise(t: Tables) -> DataFrame:
    """The log of spoilt cells, repeated by SQL draw by draw."""
    rows = t.wide("orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    return syn.add_noise(rows, "o_orderkey", ORDER_TYPES, rate=0.1).select("o_orderkey", F.inline("noise"))


@query(
    "synth_contradictions",
    """WITH c AS (SELECT p_brand AS table_name, p_name AS column_name,
             max(CASE WHEN p_partkey % 5 IN (0, 4) THEN CAST(p_size AS DOUBLE) END) AS low,
             min(CASE WHEN p_partkey % 5 = 1 THEN CAST(p_size AS DOUBLE) + 30 WHEN p_partkey % 5 = 4 THEN CAST(p_size AS DOUBLE) + 5 END) AS high,
             arg_max(CAST(p_size AS DOUBLE), p_partkey) FILTER (WHERE p_partkey % 5 = 2) AS fixed,
             arg_max([CAST(p_size AS DOUBLE), CAST(p_size AS DOUBLE) + 1], p_partkey) FILTER (WHERE p_partkey % 5 = 3) AS options FROM part GROUP BY ALL)
       SELECT table_name, column_name, 'low above high' AS fault, low, high, fixed FROM c WHERE low > high
       UNION ALL SELECT table_name, column_name, 'fixed value not in list', low, high, fixed FROM c WHERE fixed IS NOT NULL AND NOT list_contains(options, fixed)""",
)
def contradictions(t: Tables) -> DataFrame:
    """Constraints read off the parts: five kinds by part number, on brand and name."""
    slot, size = F.col("p_partkey") % 5, F.col("p_size").cast("double")
    kind = (
        F.when(slot == 0, "gte").when(slot == 1, "lte").when(slot == 2, "equals").when(slot == 3, "in").otherwise("between")
    )
    rows = t.part.select(
        F.col("p_brand").alias("table_name"),
        F.col("p_name").alias("column_name"),
        F.col("p_partkey").alias("seq"),
        kind.alias("kind"),
        F.when(slot == 1, size + 30).otherwise(size).alias("value"),
        (size + 5).alias("upper"),
        F.array(size, size + 1).alias("options"),
    )
    return syn.contradictions(rows)


@query(
    "flow_row_counts",
    """WITH s0 AS (SELECT * FROM lineitem), s1 AS (SELECT * FROM s0 WHERE l_returnflag <> 'A'), s2 AS (SELECT * FROM s1 WHERE l_quantity > 10),
            s3 AS (SELECT s2.* FROM s2 JOIN (SELECT p_partkey FROM part WHERE p_size < 20) ON l_partkey = p_partkey), s4 AS (SELECT DISTINCT l_partkey, l_suppkey FROM s3),
            n AS (SELECT (SELECT count(*) FROM s0) AS a, (SELECT count(*) FROM s1) AS b, (SELECT count(*) FROM s2) AS c, (SELECT count(*) FROM s3) AS d, (SELECT count(*) FROM s4) AS e)
       SELECT CAST(0 AS INTEGER) AS step, 'not A' AS label, a AS rows_in, b AS rows_out, a - b AS dropped, b > 0 AS reached FROM n
       UNION ALL SELECT 1, 'quantity', b, c, b - c, c > 0 FROM n UNION ALL SELECT 2, 'small parts', c, d, c - d, d > 0 FROM n UNION ALL SELECT 3, 'pairs', d, e, d - e, e > 0 FROM n""",
)
def row_counts(t: Tables) -> DataFrame:
    small = t.part.where("p_size < 20").select(F.col("p_partkey").alias("l_partkey"))
    return syn.trace(
        t.lineitem,
        [
            ("not A", lambda df: df.where("l_returnflag <> 'A'")),
            ("quantity", lambda df: df.where("l_quantity > 10")),
            ("small parts", lambda df: df.join(small, "l_partkey", "left_semi")),
            ("pairs", lambda df: df.select("l_partkey", "l_suppkey").distinct()),
        ],
    )
