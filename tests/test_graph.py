import random

from tidemill.operators import graph


def edges_of(n, m, seed):
    rng = random.Random(seed)
    return [(rng.randint(0, n), rng.randint(0, n)) for _ in range(m)]


def test_components_equal_union_find(spark):
    pairs = edges_of(60, 40, 5) + [(i, i + 1) for i in range(200, 240)] + [(500, i) for i in range(600, 640)] + [(7, 7)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {x: find(x) for x in list(parent)}
    got = graph.components(spark.createDataFrame(pairs, "src long, dst long"))
    assert {r.node: r.component for r in got.collect()} == want


def test_ancestors_reach_and_levels_with_cycles(spark):
    pairs = edges_of(12, 16, 9) + [(100, 101), (101, 102), (102, 100), (103, 102)]
    df = spark.createDataFrame(pairs, "node long, parent long")
    up = {}
    for a, b in pairs:
        up.setdefault(a, set()).add(b)
    nodes = {x for p in pairs for x in p}

    def above(x):
        seen, level = set(), set(up.get(x, ()))
        while level:
            seen |= level
            level = {g for p in level for g in up.get(p, ())} - seen
        return seen - {x}

    got = {}
    for r in graph.ancestors(df).collect():
        got.setdefault(r.node, set()).add(r.ancestor)
    assert got == {x: above(x) for x in nodes if above(x)}
    seeds = spark.createDataFrame([(103,)], "node long")
    active = {r.node for r in graph.reach_back(df, seeds).collect() if r.active}
    assert active == above(103) | {103}
    levels = {r.node: r.level for r in graph.topological_levels(df).collect()}
    assert set(levels) == nodes and all(levels[x] is None for x in (100, 101, 102, 103))
    for a, b in pairs:
        if levels[a] is not None:
            assert levels[b] < levels[a]


def above_of(pairs):
    up = {}
    for a, b in pairs:
        up.setdefault(a, set()).add(b)

    def above(x):
        seen, level = set(), set(up.get(x, ()))
        while level:
            seen |= level
            level = {g for p in level for g in up.get(p, ())} - seen
        return seen - {x}

    return {x: (up[x] - {x}, above(x)) for x in up if up[x] - {x}}


def check_counts(spark, pairs):
    found = {r.node: (r.direct_parents, r.indirect_parents) for r in graph.parent_counts(spark.createDataFrame(pairs, "node long, parent long")).collect()}
    want = {x: (len(direct), len(every) - len(direct)) for x, (direct, every) in above_of(pairs).items()}
    assert found == want


def test_parent_counts_with_diamonds_and_cycles(spark):
    check_counts(spark, edges_of(40, 45, 3) + [(7, 7), (100, 101), (101, 102), (102, 100), (103, 102), (100, 7)])


def test_parent_counts_of_a_forest_need_no_sets(spark):
    check_counts(spark, [(i, i // 3) for i in range(1, 60)])


def test_parent_counts_of_a_chain_and_a_cycle(spark):
    check_counts(spark, [(i, i + 1) for i in range(9)] + [(100 + i, 100 + (i + 1) % 5) for i in range(5)] + [(103, 3)])


def test_parent_counts_beyond_one_block(spark):
    """Two parents that share half of some 40,000 nodes above them."""
    pairs = [(1, 2), (1, 3)] + [(2, n) for n in range(10, 30_000)] + [(3, n) for n in range(15_000, 40_000)]
    df = spark.createDataFrame(pairs, "node long, parent long")
    found = {r.node: (r.direct_parents, r.indirect_parents) for r in graph.parent_counts(df).collect()}
    assert found == {1: (2, 39_990), 2: (29_990, 0), 3: (25_000, 0)}


def test_strong_components(spark):
    pairs = [(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (5, 4), (6, 1), (5, 9), (20, 21), (21, 20), (2, 20)]
    found = {r.node: r.component for r in graph.strong_components(spark.createDataFrame(pairs, "node long, parent long")).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 20: 20, 21: 20}


def test_levels_write_only_changed_counters(spark, monkeypatch):
    pairs = sorted({(a, b) for a, b in edges_of(30, 90, 6) if a > b})
    written = []
    real = graph.cut_lineage
    monkeypatch.setattr(graph, "cut_lineage", lambda df: (written.append(real(df)), written[-1])[1])
    levels = {r.node: r.level for r in graph.topological_levels(spark.createDataFrame(pairs, "node long, parent long")).collect()}
    assert sum(w.count() for w in written[1:]) <= 2 * len(pairs)  # the first is the edges themselves
    for x in levels:
        assert levels[x] == max((levels[b] + 1 for a, b in pairs if a == x), default=0)
