"""Queries over the dependency graph order -> customer -> nation -> region, supplier -> nation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemill.operators import graph
from tidemill.plans.registry import Tables, query

# The kind of a node is the last digit of its number.
EDGES_SQL = """edges AS (SELECT o_orderkey * 10 + 1 AS node, o_custkey * 10 + 2 AS parent FROM orders
    UNION ALL SELECT c_custkey * 10 + 2, CAST(c_nationkey AS BIGINT) * 10 + 3 FROM customer
    UNION ALL SELECT s_suppkey * 10 + 4, CAST(s_nationkey AS BIGINT) * 10 + 3 FROM supplier
    UNION ALL SELECT CAST(n_nationkey AS BIGINT) * 10 + 3, CAST(n_regionkey AS BIGINT) * 10 + 5 FROM nation)"""
UP_SQL = f"""{EDGES_SQL}, up(node, anc, depth) AS (SELECT node, parent, 1 FROM edges
    UNION ALL SELECT up.node, e.parent, depth + 1 FROM up JOIN edges e ON up.anc = e.node)"""


def dependencies(t: Tables) -> DataFrame:
    def edge(df: DataFrame, node: str, kind: int, parent: str, parent_kind: int) -> DataFrame:
        number = lambda c, k: (F.col(c).cast("bigint") * 10 + k)
        return df.select(number(node, kind).alias("node"), number(parent, parent_kind).alias("parent"))

    return (
        edge(t.orders, "o_orderkey", 1, "o_custkey", 2)
        .unionByName(edge(t.customer, "c_custkey", 2, "c_nationkey", 3))
        .unionByName(edge(t.supplier, "s_suppkey", 4, "s_nationkey", 3))
        .unionByName(edge(t.nation, "n_nationkey", 3, "n_regionkey", 5))
    )


@query(
    "graph_components",
    f"""WITH RECURSIVE {UP_SQL},
        r AS (SELECT node, anc AS root FROM up WHERE anc % 10 = 5 UNION SELECT anc, anc FROM up WHERE anc % 10 = 5),
        c AS (SELECT root, min(node) AS component, count(*) AS size FROM r GROUP BY 1),
        k AS (SELECT *, row_number() OVER (ORDER BY component) AS island FROM c)
        SELECT node, component, size, island FROM r JOIN k ON r.root = k.root""",
)
def graph_components(t: Tables) -> DataFrame:
    out = graph.islands(dependencies(t), "node", "parent")
    return out.select("node", "component", "size", F.col("island").cast("bigint").alias("island"))


@query(
    "graph_ancestors",
    f"""WITH RECURSIVE {UP_SQL}
        SELECT node, count(*) FILTER (WHERE depth = 1) AS direct_parents, count(*) FILTER (WHERE depth > 1) AS indirect_parents FROM up GROUP BY 1""",
)
def graph_ancestors(t: Tables) -> DataFrame:
    return graph.parent_counts(dependencies(t))


SINKS_SQL = "SELECT o_orderkey * 10 + 1 AS node FROM orders WHERE o_totalprice > 450000"


@query(
    "graph_reach_back",
    f"""WITH RECURSIVE {UP_SQL}, a AS (SELECT node FROM ({SINKS_SQL}) UNION SELECT anc FROM up WHERE node IN ({SINKS_SQL})),
        n AS (SELECT node FROM edges UNION SELECT parent FROM edges)
        SELECT n.node % 10 AS kind, count(a.node) AS active, count(*) - count(a.node) AS excluded, CAST((count(*) - count(a.node)) AS DOUBLE) / count(*) AS reduction
        FROM n LEFT JOIN a ON n.node = a.node GROUP BY 1""",
)
def graph_reach_back(t: Tables) -> DataFrame:
    sinks = t.orders.where("o_totalprice > 450000").select((F.col("o_orderkey") * 10 + 1).alias("node"))
    flagged = graph.reach_back(dependencies(t), sinks)
    return flagged.groupBy((F.col("node") % 10).alias("kind")).agg(
        F.count_if("active").alias("active"),
        F.count_if(~F.col("active")).alias("excluded"),
        (F.count_if(~F.col("active")) / F.count("*")).alias("reduction"),
    )


@query(
    "graph_topo_level",
    f"""WITH RECURSIVE {UP_SQL}
        SELECT node, CAST(max(depth) AS INTEGER) AS level FROM up GROUP BY 1
        UNION ALL SELECT DISTINCT parent, 0 FROM edges WHERE parent NOT IN (SELECT node FROM edges)""",
)
def graph_topo_level(t: Tables) -> DataFrame:
    return graph.topological_levels(dependencies(t)).select("node", "level")
