"""Partitions, versions, exports and copies."""

import pytest
from pyspark.sql import functions as F

from opsledger.sources import partitioned, replica, versioned

D = "/root/testdata/sf0.001"


def test_only_named_partitions_are_read(spark, tmp_path, plan_of):
    path = str(tmp_path / "p")
    partitioned.write(spark.read.parquet(f"{D}/orders.parquet").withColumn("year", F.year("o_orderdate")), ["year", "o_orderstatus"], path)
    df = partitioned.scan(spark, path, [{"year": 1996}, {"year": 1995, "o_orderstatus": "F"}], "o_custkey > 5")
    plan = plan_of(df)
    filters = plan[plan.index("PartitionFilters") :].split("\n")[0]
    assert "1996" in filters and "1995" in filters and "o_orderstatus" in filters and "o_custkey" not in filters
    files = [r[0] for r in df.select(F.input_file_name()).distinct().collect()]
    assert {f.split("year=")[1][:4] for f in files} == {"1995", "1996"} and not any("year=1995/o_orderstatus=O" in f for f in files)
    assert partitioned.scan(spark, path, []).count() == 0
    twice = partitioned.scan(spark, path, [{"year": 1996}, {"year": 1996}, {"year": 1996, "o_orderstatus": "F"}])
    assert twice.count() == spark.read.parquet(path).where("year = 1996").count() > 0


def test_partitions_are_found_while_running(spark, tmp_path, plan_of):
    path = str(tmp_path / "p")
    partitioned.write(spark.read.parquet(f"{D}/orders.parquet").withColumn("year", F.year("o_orderdate")), ["year"], path)
    small = spark.createDataFrame([(1996, "x"), (1997, "y")], "y int, tag string").where("tag = 'x'")
    spark.conf.set("spark.sql.optimizer.dynamicPartitionPruning.reuseBroadcastOnly", "false")
    try:
        df = partitioned.scan_matching(spark, path, "year", small, "y")
        plan = plan_of(df)
    finally:
        spark.conf.unset("spark.sql.optimizer.dynamicPartitionPruning.reuseBroadcastOnly")
    assert "dynamicpruning" in plan[plan.index("PartitionFilters") :].split("\n")[0]
    assert {r["year"] for r in df.select("year").distinct().collect()} == {1996}


def test_a_rewrite_that_breaks_off_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "t")
    versioned.create(spark.range(100).withColumn("v", F.lit("old")), root)

    def crash():
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        versioned.rewrite(spark, root, lambda df: df.withColumn("v", F.lit("new")), before_switch=crash)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO|broken"):
        versioned.rewrite(spark, root, lambda df: df.withColumn("v", F.raise_error(F.lit("broken"))))
    assert versioned.read(spark, root).groupBy("v").count().collect()[0].asDict() == {"v": "old", "count": 100}
    reader = versioned.read(spark, root)
    assert versioned.survivors(spark, root, spark.range(50, 300), ["id"]) == (100, 50)
    assert reader.count() == 100 and versioned.read(spark, root).agg(F.min("id")).first()[0] == 50
    assert versioned.vacuum(spark, root) == 3 and versioned.read(spark, root).count() == 50

    def other():
        versioned.rewrite(spark, root, lambda df: df.limit(1))

    with pytest.raises(RuntimeError, match="someone else"):
        versioned.rewrite(spark, root, lambda df: df.limit(7), before_switch=other)
    assert versioned.read(spark, root).count() == 1
    assert versioned.rewrite(spark, root, lambda df: df.limit(0)) == (1, 0)
    with pytest.raises(FileNotFoundError):
        (tmp_path / "u" / "manifests").mkdir(parents=True)
        versioned.read(spark, str(tmp_path / "u"))


def test_exports_are_refused(spark, tmp_path):
    roots = {k: str(tmp_path / k) for k in ("a", "b")}
    for k, at in (("a", 5.0), ("b", 15.0)):
        versioned.create(spark.range(3), roots[k], now=lambda at=at: at)
    runs = spark.createDataFrame([(1, " App ", "MASKING", "FINISHED", 10.0), (2, "app", "ANALYSIS", "FINISHED", 99.0), (3, "app", "MASKING", "FINISHED", 20.0), (4, "app", "MASKING", "FAILED", 99.0)], "run int, schema string, phase string, state string, ended_at double")
    go = lambda n, **how: versioned.export(spark, runs, "APP", roots, str(tmp_path / n), ["a"], **how)
    assert [tuple(r) for r in go("1", run=1).collect()] == [("a", 3)] and spark.read.parquet(str(tmp_path / "1" / "a")).count() == 3
    assert sorted(tuple(r) for r in go("2", scope="C").collect()) == [("a", 3), ("b", 3)]
    for how in ({}, {"run": 2}, {"run": 4}, {"run": 9}, {"scope": "C", "run": 1}, {"scope": "X", "run": 1}):
        with pytest.raises(versioned.Refused):
            go("3", **how)
    assert not (tmp_path / "3").exists()


def test_one_changed_row_is_found(spark, tmp_path):
    a = spark.read.parquet(f"{D}/customer.parquet")
    changed = lambda c, v: a.withColumn(c, F.when(F.col("c_custkey") == 77, v).otherwise(F.col(c)))
    for b in (changed("c_name", F.lit(None)), changed("c_acctbal", F.col("c_acctbal") + 0.01)):
        assert [tuple(r) for r in replica.differences(a, b.repartition(3), "c_custkey", 10).collect()] == [(70, 79, 10, 10)]
    twice = a.unionAll(a.where("c_custkey = 12"))
    assert [tuple(r) for r in replica.differences(a, twice, "c_custkey", 10).collect()] == [(10, 19, 10, 11)]
    assert replica.differences(a, a.orderBy(F.desc("c_name")).select(*sorted(a.columns)), "c_custkey").count() == 0
    nulls = spark.createDataFrame([(1, None, ""), (None, "x", None)], "k int, a string, b string")
    other = spark.createDataFrame([(1, "", None), (None, "x", None)], "k int, a string, b string")
    assert [tuple(r)[:1] + tuple(r)[2:] for r in replica.differences(nulls, other, "k").collect()] == [(0, 1, 1)]
    assert replica.differences(nulls, nulls.where("k = 1"), "k").first()["rows_b"] == 0
    assert replica.replicate(a, str(tmp_path / "c"), "c_custkey") == a.count()
    with pytest.raises(replica.Differs):
        replica.differences(a, a.drop("c_name"), "c_custkey")


def test_a_bad_copy_is_an_error(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(replica, "differences", lambda a, b, *how, f=replica.differences: f(a, b.where("id <> 1234"), *how))
    with pytest.raises(replica.Differs, match="1000 to 1999"):
        replica.replicate(spark.range(3000), str(tmp_path / "c"), "id")
