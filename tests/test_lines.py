"""Reports with computed lines, exports, guards of subsets."""

import random

from pyspark.sql import functions as F

from opsledger import subset_catalog
from opsledger.operators.report_lines import REPORT, computed_lines
from opsledger.operators.subset import Edge, Graph, Node, export, subset

D = "/root/testdata/sf0.001"


def test_lines_in_order(spark, plan_of):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(3), k, rng.randrange(100), float(k)) for k in range(60)]
    df = spark.createDataFrame(rows, "g string, h int, k int, v int, w double")
    computes = [("SUM", "v", "h"), ("AVG", "w", "h"), ("MAX", "v", "g"), ("SUM", "v", REPORT), ("SUM", "w", REPORT), ("MIN", "v", REPORT)]
    out = computed_lines(df, ["g", "h"], ["k"], computes)
    got = [tuple(r)[1:] for r in out.orderBy("line").collect()]
    assert [r["line"] for r in out.orderBy("line").collect()] == list(range(1, len(got) + 1))
    want = []
    first = lambda x: (x is not None, x or "")
    for g in sorted({r[0] for r in rows}, key=first):
        mine = [r for r in rows if r[0] == g]
        for h in sorted({r[1] for r in mine}):
            own = sorted(r for r in mine if r[1] == h) if g is not None else sorted((r for r in mine if r[1] == h), key=lambda r: r[2])
            want += [(g, h, k, float(v), w, None) for _, _, k, v, w in own]
            want += [(g, h, None, float(sum(r[3] for r in own)), None, "SUM"), (g, h, None, None, sum(r[4] for r in own) / len(own), "AVG")]
        want.append((g, None, None, float(max(r[3] for r in mine)), None, "MAX"))
    want += [(None, None, None, float(sum(r[3] for r in rows)), sum(r[4] for r in rows), "SUM"), (None, None, None, float(min(r[3] for r in rows)), None, "MIN")]
    assert got == want and "SinglePartition" not in plan_of(out)
    assert [r["label"] for r in computed_lines(df.limit(0), ["g"], ["k"], computes[3:]).collect()] == ["SUM", "MIN"]


def test_exports_by_condition_without_empty_tables(spark, tmp_path):
    tables, graph = subset_catalog._graph(spark, D, ["region", "nation", "customer"], nation=Node("n_nationkey", where="n_regionkey = 2", pull_children=False))
    kept = subset(tables, graph)
    done = {r["table"]: r["rows"] for r in export(kept, str(tmp_path / "x"), {"nation": {"n_name": F.lit("m")}}, {"nation": "n_name <> 'NATION_2'"}, empty=False).collect()}
    assert set(done) == {"nation", "region"} and done["nation"] == kept["nation"].where("n_name <> 'NATION_2'").count() and not (tmp_path / "x" / "customer").exists()


def test_subsets_leave_only_what_their_results_read(spark):
    import os

    from opsledger.shared import shared_dir

    root = shared_dir(spark)
    count = lambda: sum(len(os.listdir(f"{root}/{x}")) for x in os.listdir(root) if "-" in x and not x.startswith(("table", "storage", "reports", "warc", "pipeline", "opsledger")))
    before = count()
    tables, graph = subset_catalog._graph(spark, D, ["region", "nation", "customer"], customer=Node("c_custkey", percent=10))
    kept = subset(tables, graph)
    assert count() - before == 3 and kept["nation"].count() > 0


def test_excluded_edges_and_self_references(spark):
    rows = spark.createDataFrame([(k, k // 2 if k else None, k % 5) for k in range(40)], "id int, boss int, other int")
    others = spark.createDataFrame([(k,) for k in range(5)], "oid int")
    edges = [Edge("emp", "boss", "emp", "id"), Edge("emp", "other", "dep", "oid")]
    got = subset({"emp": rows, "dep": others}, Graph({"emp": Node("id", where="id = 37"), "dep": Node("oid")}, edges))
    assert {r["id"] for r in got["emp"].collect()} == {37, 18, 9, 4, 2, 1, 0} and {r["oid"] for r in got["dep"].collect()} == {0, 1, 2, 3, 4}
    got = subset({"emp": rows, "dep": others}, Graph({"emp": Node("id", where="id = 37"), "dep": Node("oid")}, edges, excluded={("emp", "emp")}))
    assert {r["id"] for r in got["emp"].collect()} == {37} and {r["oid"] for r in got["dep"].collect()} == {2}
