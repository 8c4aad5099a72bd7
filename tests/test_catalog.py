import duckdb
import pytest

from opsledger import catalog

D = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages labels conversations benchmark embeddings".split()


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda k: cols[k])
    return sorted(tuple(str(float(r[k])) if type(r[k]).__name__ == "Decimal" else str(r[k]) for k in order) for r in data)


@pytest.mark.parametrize("name", sorted(catalog.CHECKS))
def test_same_rows_as_sql(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from '{D}/{t}.parquet'")
    want = db.execute(catalog.CHECKS[name])
    cols = [c[0] for c in want.description]
    expected = want.fetchall()
    got = catalog.QUERIES[name](spark, D)
    assert sorted(got.columns) == sorted(cols)
    assert rows(got.columns, got.collect()) == rows(cols, expected)


def test_collisions_go(spark):
    r = catalog.QUERIES["masked_without_collisions"](spark, D).first()
    assert r["n"] == r["different"] == 150


def test_ranked_keys_are_numbered_once(spark):
    from opsledger.operators.relational import ranked

    got = ranked(spark.range(5000).withColumnRenamed("id", "k"), "k").collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 5001)) and {r["k"] for r in got} == set(range(5000))


def test_hierarchies_of_any_depth(spark):
    from pyspark.sql import functions as F

    from opsledger.operators.relational import hierarchy

    chain = spark.createDataFrame([(k, k - 1 if k else None) for k in range(115)], "c long, p long")
    assert hierarchy(chain, "c", "p", F.col("node") == 0).agg(F.max("level")).first()[0] == 115
    assert hierarchy(chain, "c", "p", F.col("node") == 0, depth=8).count() == 8
    loop = spark.createDataFrame([(1, 3), (2, 1), (3, 2)], "c long, p long")
    assert {tuple(r["path"]) for r in hierarchy(loop, "c", "p", F.col("node") == 1).collect()} == {(1,), (1, 2), (1, 2, 3)}


def test_overlaps_of_very_wide_and_narrow_ranges(spark):
    from opsledger.operators.relational import overlap_join

    rows = [(0, 10**9), (5, 5), (-7, -3), (10**9, 10**9 + 3), (3, 6), (4, 2), (-100, 100), (64, 127), (128, 128)]
    a = spark.createDataFrame([(1, *r) for r in rows], "k int, alo long, ahi long")
    b = spark.createDataFrame([(1, *r) for r in rows], "k int, blo long, bhi long")
    got = sorted((r["alo"], r["ahi"], r["blo"], r["bhi"], r["lo"], r["hi"]) for r in overlap_join(a, b, ["k"], ("alo", "ahi"), ("blo", "bhi")).collect())
    assert got == sorted((x, y, u, v, max(x, u), min(y, v)) for x, y in rows for u, v in rows if x <= y and u <= v and max(x, u) <= min(y, v))
    assert overlap_join(a.limit(0), b, ["k"], ("alo", "ahi"), ("blo", "bhi")).count() == 0


def test_export_writes_what_is_kept(spark, tmp_path):
    from pyspark.sql import functions as F

    from opsledger import subset_catalog
    from opsledger.operators.subset import Node, empty_tables, export, subset

    tables, graph = subset_catalog._graph(spark, D, ["region", "nation", "customer"], nation=Node("n_nationkey", where="n_regionkey = 2", pull_children=False))
    kept = subset(tables, graph)
    done = {r["table"]: (r["rows"], r["path"]) for r in export(kept, str(tmp_path / "x"), {"nation": {"n_name": F.lit("masked")}}).collect()}
    assert done["region"][0] == 1 and done["customer"][0] == 0 and empty_tables(kept) == ["customer"]
    assert {r["n_name"] for r in spark.read.parquet(done["nation"][1]).collect()} == {"masked"}


def test_counts_of_a_stream(spark, tmp_path):
    from opsledger.streaming.alerts import counts

    e = spark.read.parquet(f"{D}/events.parquet").selectExpr("cast(ts as timestamp) as ts", "event_type")
    e.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(e.schema).parquet(str(tmp_path / "in"))
    q = counts(stream).writeStream.format("memory").queryName("seen").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    want = e.groupBy("event_type").count().collect()
    assert {(r["event_type"], r["n"]) for r in spark.sql("select event_type, sum(n) as n from seen group by event_type").collect()} == {(r["event_type"], r["count"]) for r in want}


def test_updates_from_another_table(spark):
    from opsledger.operators.relational import update_from
    from opsledger.plans.masking import sync_mismatches, synced

    a = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (3, None)], "k int, w string")
    assert {tuple(r) for r in update_from(a, b, ["k"], {"v": "w"}).collect()} == {(1, "x"), (2, "b"), (3, None)}
    with pytest.raises(ValueError):
        update_from(a, b.unionAll(b), ["k"], {"v": "w"})
    assert sync_mismatches(a, b, ["k"], "v", "w") == 1
    assert sync_mismatches(synced(a, b, ["k"], "v", "w", 10), b, ["k"], "v", "w") == 0


def test_report_sinks(spark, tmp_path):
    from opsledger.sources.reports import to_csv, to_html, to_xls

    df = spark.createDataFrame([(1, "<a>"), (2, None)], "k int, v string").coalesce(1)
    text = lambda p: "".join(r["value"] for part in sorted(x.name for x in p.iterdir()) for r in spark.read.text(str(p / part)).collect())
    to_html(df, str(tmp_path / "h"))
    assert text(tmp_path / "h") == "<table><tr><th>k</th><th>v</th></tr><tr><td>1</td><td>&lt;a&gt;</td></tr><tr><td>2</td><td></td></tr></table>"
    to_xls(spark.range(3000).selectExpr("id", "id as `a.b`"), str(tmp_path / "x"))
    assert text(tmp_path / "x").startswith("<html") and text(tmp_path / "x").count("<tr>") == 3001
    to_csv(df, str(tmp_path / "r"))
    assert sorted(r["_c0"] for r in spark.read.csv(str(tmp_path / "r")).collect()) == ["1", "2"]


def test_sections_with_other_rulers_are_left_out(spark, tmp_path):
    from opsledger.sources.reports import fixed_width, lines, tagged

    (tmp_path / "r.txt").write_text("x\nOne\n-- -- -- -- -- --\n1  2  3  4  5  6\n\n7  8  9\nTwo\n---- ----\n1 2\n")
    rows = tagged(lines(spark, str(tmp_path / "r.txt")), {"One": "one", "Two": "two"})
    assert [(r["section"], r["cells"]) for r in fixed_width(rows).collect()] == [("one", ["1", "2", "3", "4", "5", "6"])]
