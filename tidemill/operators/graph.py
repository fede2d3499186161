"""Graph jobs on edge tables, as rounds of joins.

Every round ends with a checkpoint in the shared folder, so the plan stays
short and a lost executor costs one round. The driver sees one number per
round. No task ever holds all edges of a node: minima are aggregated before
the shuffle, and joins leave a hub's edges to be split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemill.operators.ordered import order_stats
from tidemill.session import cut_lineage


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1]


def components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Node and the least node of its connected group.

    Alternates two steps until nothing changes: every node hands its larger
    neighbours to its least neighbour, then its smaller ones. The number of
    rounds grows with the logarithm of the number of nodes, not with the
    length of the longest path.
    """
    pairs = edges.where(F.col(src).isNotNull() & F.col(dst).isNotNull()).select(
        F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")
    )
    nodes = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    links = cut_lineage(pairs.where("u <> v").distinct())
    before = None
    while before != (now := _state(links)):
        before = now
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        # every smaller neighbour, and the node itself, now hangs on the least one
        handed = large.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        links = cut_lineage(handed.where("u <> v").distinct())
    roots = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def islands(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Components numbered from 1 in the order of their least node, with their size."""
    members = cut_lineage(components(edges, src, dst))
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    numbered = order_stats(sizes, "component", tie="component", row_number="island", settle=True)
    return members.join(numbered, "component")


def ancestors(edges: DataFrame, node: str = "node", parent: str = "parent") -> DataFrame:
    """Every (node, ancestor, depth) with the least depth; a node is never its own ancestor.

    A frontier of newly found pairs moves one level up per round and stops
    where nothing new is met, so cycles end it as well.
    """
    up = cut_lineage(edges.select(F.col(node).alias("node"), F.col(parent).alias("anc")).where("node <> anc").distinct())
    frontier = up.withColumn("depth", F.lit(1))
    found, depth = frontier, 1
    step = up.select(F.col("node").alias("anc"), F.col("anc").alias("next"))
    while True:
        depth += 1
        reached = (
            frontier.join(step, "anc")
            .select("node", F.col("next").alias("anc"))
            .where("node <> anc")
            .distinct()
            .join(found.select("node", "anc"), ["node", "anc"], "left_anti")
        )
        frontier = cut_lineage(reached.withColumn("depth", F.lit(depth)))
        if frontier.isEmpty():
            return found.withColumnRenamed("anc", "ancestor")
        found = found.unionByName(frontier)


def _edges(edges: DataFrame, node: str, parent: str) -> DataFrame:
    """Distinct edges (node, anc) between different nodes, written down."""
    pairs = edges.select(F.col(node).alias("node"), F.col(parent).alias("anc"))
    return cut_lineage(pairs.where("node <> anc").distinct())


def strong_components(edges: DataFrame, node: str = "node", parent: str = "parent") -> DataFrame:
    """Nodes on cycles, with the least node of the strongly connected group they belong to.

    Every node takes the least node that reaches it; one that takes itself is the
    root of its group, whose other members are found by walking up from the root
    among nodes with its mark. Found groups leave, until no edge is left. Rounds
    grow with the length of the paths among the nodes on or between cycles.
    """
    left = _edges(edges, node, parent)
    groups: DataFrame | None = None
    while True:
        before = None
        while before != (before := left.count()):  # what has no edge in or none out lies on no cycle
            ends = left.select("node").intersect(left.select(F.col("anc").alias("node")))
            ends = cut_lineage(ends)
            left = left.join(ends, "node", "left_semi").join(ends.withColumnRenamed("node", "anc"), "anc", "left_semi")
            left = cut_lineage(left.select("node", "anc"))
        if before == 0:
            return groups if groups is not None else left.select("node", F.col("anc").alias("component"))
        marks = cut_lineage(left.select("node").distinct().withColumn("mark", F.col("node")))
        changed = marks
        while not changed.isEmpty():
            offers = left.join(changed.select(F.col("node").alias("anc"), "mark"), "anc").groupBy("node").agg(F.min("mark").alias("offer"))
            changed = cut_lineage(offers.join(marks, "node").where("offer < mark").select("node", F.col("offer").alias("mark")))
            kept = marks.join(changed.select("node"), "node", "left_anti")
            marks = cut_lineage(kept.unionByName(changed))
        found = marks.where("node = mark")
        frontier = found
        while not frontier.isEmpty():
            above = left.join(frontier, "node").select(F.col("anc").alias("node"), "mark").distinct()
            frontier = cut_lineage(above.join(marks, ["node", "mark"], "left_semi").join(found, ["node", "mark"], "left_anti"))
            found = cut_lineage(found.unionByName(frontier))
        members = found.withColumnRenamed("mark", "component")
        large = members.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("component")
        members_of = cut_lineage(members.join(large, "component", "left_semi").select("node", "component"))
        groups = members_of if groups is None else groups.unionByName(members_of)
        left = left.join(members.select("node"), "node", "left_anti").join(members.select(F.col("node").alias("anc")), "anc", "left_anti")
        left = cut_lineage(left.select("node", "anc"))


def _or(sets: DataFrame) -> DataFrame:
    return sets.groupBy("comp", "block").agg(F.bitmap_or_agg("bits").alias("bits"))


def _needed(up: DataFrame, info: DataFrame) -> DataFrame | None:
    """The groups that need a set: those with several parents, and what is above them; None without such."""
    several = info.where("parents > 1").select("comp")
    if several.isEmpty():
        return None
    return cut_lineage(reach_back(up, several, "node", "anc").where("active").select(F.col("node").alias("comp")))


def _descend(up: DataFrame, info: DataFrame, needed: DataFrame | None, own: DataFrame | None) -> DataFrame:
    """(comp, closed): how many nodes each group and all above it hold together.

    Works down the levels. A group with one parent adds its size to the parent's
    count. Only groups with several parents need sets, because what is above one
    parent may be above another: bit sets in blocks of 32,768 nodes, kept for
    these groups and for what is above them, merged by or.
    """
    depth = info.agg(F.max("level")).first()[0] or 0
    counts = cut_lineage(info.where("level = 0").select("comp", F.col("size").alias("closed")))
    sets = own.join(info.where("level = 0").select("comp"), "comp", "left_semi") if needed is not None else None
    for level in range(1, depth + 1):
        here = info.where(F.col("level") == level)
        lines = up.join(here.select(F.col("comp").alias("node"), "size", "parents"), "node")
        one = lines.where("parents = 1").join(counts.select(F.col("comp").alias("anc"), "closed"), "anc")
        grown = one.select(F.col("node").alias("comp"), (F.col("closed") + F.col("size")).alias("closed"))
        if needed is not None:
            inner = lines.join(needed.withColumnRenamed("comp", "node"), "node", "left_semi")
            passed = inner.join(sets.withColumnRenamed("comp", "anc"), "anc").select(F.col("node").alias("comp"), "block", "bits")
            mine = own.join(here.select("comp"), "comp", "left_semi")
            fresh = cut_lineage(_or(passed.unionByName(mine)))
            merged = fresh.join(here.where("parents > 1").select("comp"), "comp", "left_semi")
            grown = grown.unionByName(merged.groupBy("comp").agg(F.sum(F.bitmap_count("bits")).alias("closed")))
            sets = sets.unionByName(fresh)
        counts = counts.unionByName(cut_lineage(grown))
    return counts


def parent_counts(edges: DataFrame, node: str = "node", parent: str = "parent") -> DataFrame:
    """Direct and indirect parents per node that has any; a node is never its own parent.

    Cycles become one group first, whose members are above each other. No table of
    pairs is made: see ``_descend``.
    """
    up = short = _edges(edges, node, parent)
    levels = cut_lineage(_levels(up))
    members = levels.select("node", F.col("node").alias("comp"))
    info = levels.select(F.col("node").alias("comp"), F.lit(1).alias("size"), "level", "parents")
    stuck = levels.where("level IS NULL").select("node")
    if not stuck.isEmpty():
        # Only nodes on cycles or behind them have no level.
        behind = up.join(stuck, "node", "left_semi").join(stuck.withColumnRenamed("node", "anc"), "anc", "left_semi")
        groups = strong_components(behind, "node", "anc")
        members = cut_lineage(members.join(groups, "node", "left").select("node", F.coalesce("component", "comp").alias("comp")))
        lines = up.join(members.withColumnRenamed("comp", "low"), "node")
        lines = lines.join(members.select(F.col("node").alias("anc"), F.col("comp").alias("high")), "anc")
        short = cut_lineage(lines.where("low <> high").select(F.col("low").alias("node"), F.col("high").alias("anc")).distinct())
        sizes = members.groupBy(F.col("comp").alias("node")).agg(F.count(F.lit(1)).alias("size"))
        placed = sizes.join(_levels(short), "node", "left").fillna(0, ["level", "parents"])
        info = cut_lineage(placed.select(F.col("node").alias("comp"), "size", "level", "parents"))
    needed = _needed(short, info)
    own = None
    if needed is not None:
        wanted = members.join(needed, "comp", "left_semi")
        numbered = order_stats(wanted, "node", tie="node", row_number="id", settle=True)
        bits = numbered.groupBy("comp", F.bitmap_bucket_number("id").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))
        own = cut_lineage(bits)
    counts = _descend(short, info, needed, own)
    direct = up.groupBy("node").agg(F.count(F.lit(1)).alias("direct_parents"))
    every = direct.join(members, "node").join(counts, "comp")
    return every.select("node", "direct_parents", (F.col("closed") - 1 - F.col("direct_parents")).alias("indirect_parents"))


def reach_back(edges: DataFrame, seeds: DataFrame, node: str = "node", parent: str = "parent") -> DataFrame:
    """All nodes with a flag whether a seed depends on them, directly or not; seeds count."""
    up = cut_lineage(edges.select(F.col(node).alias("node"), F.col(parent).alias("anc")).distinct())
    frontier = cut_lineage(seeds.select(F.col(seeds.columns[0]).alias("node")).distinct())
    active = frontier
    while True:
        reached = frontier.join(up, "node").select(F.col("anc").alias("node")).distinct()
        frontier = cut_lineage(reached.join(active, "node", "left_anti"))
        if frontier.isEmpty():
            break
        active = active.unionByName(frontier)
    every = up.select(F.explode(F.array("node", "anc")).alias("node")).unionByName(active).distinct()
    return every.join(active.withColumn("active", F.lit(True)), "node", "left").select(
        "node", F.coalesce("active", F.lit(False)).alias("active")
    )


def topological_levels(edges: DataFrame, node: str = "node", parent: str = "parent") -> DataFrame:
    """Level 0 for nodes without parents, else one more than the highest parent.

    Every node has a counter of parents without a level. A round takes the nodes
    whose counter has come to zero off the counters of their children, and writes
    only the counters that changed: over all rounds at most one row per edge, after
    one per node with parents. The least counter of a node is its newest. What
    never comes to zero lies on a cycle or behind one and has a null level.
    """
    up = cut_lineage(edges.select(F.col(node).alias("node"), F.col(parent).alias("anc")).distinct())
    return _levels(up).select("node", "level")


def _levels(up: DataFrame) -> DataFrame:
    """(node, level, parents) for distinct edges."""
    counters = cut_lineage(up.groupBy("node").agg(F.count(F.lit(1)).alias("open")).withColumn("level", F.lit(None).cast("int")))
    roots = up.select(F.col("anc").alias("node")).distinct().join(counters, "node", "left_anti").withColumn("level", F.lit(0))
    ready, log, level = roots, counters, 0
    while True:
        level += 1
        closed = up.join(ready.select(F.col("node").alias("anc")), "anc").groupBy("node").agg(F.count(F.lit(1)).alias("closed"))
        # Counters are few per node; only those of touched nodes are grouped.
        newest = log.join(closed, "node").groupBy("node").agg((F.min("open") - F.first("closed")).alias("open"))
        fresh = cut_lineage(newest.withColumn("level", F.when(F.col("open") == 0, F.lit(level)).cast("int")))
        ready = fresh.where("open = 0")
        log = log.unionByName(fresh)
        if ready.isEmpty():
            break
    found = log.groupBy("node").agg(F.max("level").alias("level"), F.max("open").alias("parents"))
    return roots.withColumn("parents", F.lit(0)).unionByName(found)
