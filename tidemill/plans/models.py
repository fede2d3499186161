"""Queries over clustering, scoring, lead selection and user functions."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

from tidemill.functions import labels
from tidemill.functions.columns import dbl, money, rounded
from tidemill.operators import models
from tidemill.plans.registry import Tables, query


@query(
    "ml_cluster_rank",
    """WITH c AS (SELECT avg(p_retailprice) AS m FROM part),
            g AS (SELECT p_retailprice AS x, count(*)::DOUBLE AS n, sum(p_retailprice - m) AS s, sum((p_retailprice - m) * (p_retailprice - m)) AS q FROM part, c GROUP BY 1),
            p AS (SELECT x, row_number() OVER w AS i, sum(n) OVER w AS n, sum(s) OVER w AS s, sum(q) OVER w AS q FROM g WINDOW w AS (ORDER BY x)),
            t AS (SELECT * FROM p ORDER BY i DESC LIMIT 1),
            k AS (SELECT a.x AS low, b.x AS high, a.i AS i, b.i AS j, a.q - a.s * a.s / a.n + b.q - a.q - (b.s - a.s) * (b.s - a.s) / (b.n - a.n)
                         + t.q - b.q - (t.s - b.s) * (t.s - b.s) / (t.n - b.n) AS cost, t.q - t.s * t.s / t.n AS total
                  FROM p a, p b, t WHERE a.i < b.i AND b.i < t.i),
            best AS (SELECT low, high FROM k WHERE cost <= (SELECT min(cost) FROM k) + 1e-11 * total ORDER BY i, j LIMIT 1)
       SELECT CASE WHEN p_retailprice <= low THEN 'low_Returns' WHEN p_retailprice <= high THEN 'med_Returns' ELSE 'high_Returns' END AS cluster,
              count(*) AS n, min(p_retailprice) AS least, max(p_retailprice) AS most FROM part, best GROUP BY 1""",
)
def cluster_rank(t: Tables) -> DataFrame:
    names = ["low_Returns", "med_Returns", "high_Returns"]
    out = models.named_clusters(t.part.select("p_partkey", "p_retailprice"), "p_retailprice", names, "cluster")
    return out.groupBy("cluster").agg(
        F.count("*").alias("n"), F.min("p_retailprice").alias("least"), F.max("p_retailprice").alias("most")
    )


MODEL = models.logistic({"n_chars": -0.0005, "n_lines": 0.04, "is_en": 0.8}, -0.2)


@query(
    "ml_batch_score",
    """WITH f AS (SELECT d.doc_id, quality, n_chars, length(text) - length(replace(text, chr(10), '')) + 1 AS n_lines, CASE WHEN lang = 'en' THEN 1 ELSE 0 END AS is_en
                  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
       SELECT doc_id, quality, CAST(round(CAST(1 / (1 + exp(-(n_chars * -0.0005 + n_lines * 0.04 + is_en * 0.8 - 0.2))) AS DECIMAL(24,8)), 6) AS DOUBLE) AS probability FROM f""",
)
def batch_score(t: Tables) -> DataFrame:
    rows = t.wide("documents", "doc_id", "n_chars", "text", "lang").join(t.labels, "doc_id", "left").select(
        "doc_id",
        "quality",
        "n_chars",
        F.size(F.split("text", "\n")).alias("n_lines"),
        (F.col("lang") == "en").cast("int").alias("is_en"),
    )
    return models.score_native(rows, MODEL).select("doc_id", "quality", rounded("probability", 6).alias("probability"))


def leads_of(t: Tables) -> DataFrame:
    """Candidate leads with sales measures of the orders and a model score."""
    recent = F.col("o_orderdate") > F.lit("2000-07-31").cast("timestamp_ntz")
    amount = lambda test: dbl(F.coalesce(F.sum(F.when(test, money("o_totalprice"))), F.lit(0)))
    sums = t.orders.groupBy(F.col("o_custkey").alias("cgi")).agg(
        amount(recent & (F.col("o_orderstatus") == "F")).alias("rollup_12monsales"),
        amount(recent & (F.col("o_orderstatus") == "O")).alias("proj_sales"),
        amount(recent & (F.col("o_orderpriority") == "1-URGENT")).alias("proj_sales_3mon"),
        amount(F.col("o_orderpriority") == "2-HIGH").alias("aum_0"),
    )
    who = t.customer.select(
        F.col("c_custkey").alias("cgi"), F.concat(F.lit("owner "), (F.col("c_nationkey") % 3).cast("string")).alias("psp"), "c_mktsegment", "c_acctbal"
    )
    chance = (F.col("c_acctbal") + 1000) / 11000 / 2
    return sums.join(who, "cgi").withColumn("probability", chance)


@query(
    "pipe_lead_selection",
    """WITH s AS (SELECT o_custkey AS cgi,
          CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderdate > DATE '2000-07-31' AND o_orderstatus = 'F'), 0) AS DOUBLE) AS sales,
          CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderdate > DATE '2000-07-31' AND o_orderstatus = 'O'), 0) AS DOUBLE) AS proj,
          CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderdate > DATE '2000-07-31' AND o_orderpriority = '1-URGENT'), 0) AS DOUBLE) AS proj3,
          CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderpriority = '2-HIGH'), 0) AS DOUBLE) AS aum FROM orders GROUP BY 1),
      l AS (SELECT s.*, 'owner ' || (c_nationkey % 3) AS psp, c_mktsegment, (c_acctbal + 1000) / 11000 / 2 AS probability FROM s JOIN customer ON cgi = c_custkey),
      r AS (SELECT *, CASE WHEN sales = 0 THEN 0 ELSE (rank() OVER (PARTITION BY sales = 0 ORDER BY sales) + (count(*) OVER (PARTITION BY sales) - 1) / 2) / count(nullif(sales, 0)) OVER () END AS d1,
            CASE WHEN proj = 0 THEN 0 ELSE (rank() OVER (PARTITION BY proj = 0 ORDER BY proj) + (count(*) OVER (PARTITION BY proj) - 1) / 2) / count(nullif(proj, 0)) OVER () END AS d2,
            CASE WHEN proj3 = 0 THEN 0 ELSE (rank() OVER (PARTITION BY proj3 = 0 ORDER BY proj3) + (count(*) OVER (PARTITION BY proj3) - 1) / 2) / count(nullif(proj3, 0)) OVER () END AS d3,
            CASE WHEN aum = 0 THEN 0 ELSE (rank() OVER (PARTITION BY aum = 0 ORDER BY aum) + (count(*) OVER (PARTITION BY aum) - 1) / 2) / count(nullif(aum, 0)) OVER () END AS d4 FROM l),
      i AS (SELECT *, CAST(round(CAST((d3 + d2 + d1 + d4) / 4 AS DECIMAL(24,8)), 3) AS DOUBLE) AS ia, CAST(aum >= 1000000 OR sales >= 100000 OR proj3 >= 100000 OR proj >= 100000 AS INTEGER) AS rule FROM r),
      m AS (SELECT *, CASE WHEN rule = 1 AND probability < 0.225 THEN 0.225 + 0.01 * ia ELSE probability END AS final_score, row_number() OVER (ORDER BY probability DESC, cgi) AS model_rank FROM i),
      k AS (SELECT *, CAST(model_rank <= 600 OR rule = 1 AS INTEGER) AS lead FROM m),
      f AS (SELECT *, row_number() OVER (PARTITION BY psp ORDER BY ia DESC, cgi) AS rk FROM k WHERE c_mktsegment <> 'BUILDING'),
      u AS (SELECT cgi, psp, ia, sales, aum, rule, final_score, model_rank, lead, 'new ' || psp AS final_psp, 'ownership' AS own_inc FROM k WHERE c_mktsegment = 'BUILDING'
            UNION ALL SELECT cgi, psp, ia, sales, aum, rule, final_score, model_rank, lead, CASE WHEN lead = 1 AND rk > 25 AND rk <= 35 THEN 'spare' ELSE psp END,
              CASE WHEN lead = 1 AND rk <= 35 THEN 'incremental' ELSE 'non lead' END FROM f),
      o AS (SELECT *, row_number() OVER (PARTITION BY psp ORDER BY ia + CASE WHEN own_inc <> 'non lead' THEN 1 ELSE 0 END DESC, cgi) AS original_rank FROM u)
      SELECT cgi, psp, final_psp, ia AS ia_score, CAST(round(CAST(final_score AS DECIMAL(24,8)), 5) AS DOUBLE) AS final_score, CAST(model_rank AS BIGINT) AS model_rank, lead AS lead_indicator, CAST(original_rank AS BIGINT) AS original_rank,
             CASE WHEN sales <= 0 AND aum >= 500000 THEN 'Fallen Angel' ELSE 'Active' END AS fallen_angel,
             CASE WHEN own_inc = 'non lead' AND ((sales <= 0 AND aum >= 500000) OR rule = 1) THEN 'incremental' ELSE own_inc END AS own_inc FROM o""",
)
def lead_selection(t: Tables) -> DataFrame:
    scored = models.lead_scores(leads_of(t))
    ownership = t.customer.where("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").alias("cgi"),
        F.concat(F.lit("new owner "), (F.col("c_nationkey") % 3).cast("string")).alias("final_psp"),
    )
    out = models.select_leads(scored, ownership, spare="spare")
    return out.select(
        "cgi", "psp", "final_psp", "ia_score", rounded("final_score", 5).alias("final_score"),
        F.col("model_rank").cast("bigint").alias("model_rank"), "lead_indicator",
        F.col("original_rank").cast("bigint").alias("original_rank"), "fallen_angel", "own_inc",
    )


@query(
    "udf_vs_native",
    """SELECT event_id, CASE WHEN value < 50 THEN 'small' WHEN value < 500 THEN 'medium' ELSE 'large' END AS by_function,
              CASE WHEN value < 50 THEN 'small' WHEN value < 500 THEN 'medium' ELSE 'large' END AS native, true AS same FROM events""",
)
def udf_vs_native(t: Tables) -> DataFrame:
    """The band as a vectorised user function and as an expression; both must agree."""

    def band(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import numpy

        for v in batches:
            named = numpy.select([v.isna(), v < 50, v < 500], ["unknown", "small", "medium"], "large")
            yield pd.Series(named)

    both = t.events.select(
        "event_id",
        F.pandas_udf(band, StringType())(F.col("value")).alias("by_function"),
        labels.size_band(F.col("value")).alias("native"),
    )
    return both.withColumn("same", F.col("by_function").eqNullSafe(F.col("native")))
