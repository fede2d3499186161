"""Islands of file names: text ids in one plan for every size."""

from tidemill.operators import graph


def test_islands_of_names(spark):
    edges = spark.createDataFrame([("a.py", "b.py"), ("b.py", "c.py"), ("x.py", "y.py")], "src string, dst string")
    found = {r.node: (r.component, r.island, r["size"]) for r in graph.islands(edges).collect()}
    assert {n: v[0] for n, v in found.items()} == {"a.py": "a.py", "b.py": "a.py", "c.py": "a.py", "x.py": "x.py", "y.py": "x.py"}
    assert found["c.py"][1:] == (1, 3) and found["y.py"][1:] == (2, 2)
