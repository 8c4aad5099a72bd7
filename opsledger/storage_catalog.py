"""Queries over tables that are stored in partitions, versions and copies, made from the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from opsledger.plans import masking
from opsledger.registry import query, t
from opsledger.shared import dropped, shared_dir, stored
from opsledger.sources import partitioned, replica, versioned


def _folder(spark) -> str:
    return f"{shared_dir(spark).rstrip('/')}/storage-{uuid.uuid4().hex}"


def orders_by_year(spark, d) -> str:
    """Orders in partitions by year and subpartitions by status; their folder."""
    folder = _folder(spark)
    partitioned.write(t(spark, d, "orders").withColumn("year", F.year("o_orderdate")), ["year", "o_orderstatus"], folder)
    return folder


@query("""select year(o_orderdate) as year, o_orderstatus, o_orderkey from orders where (year(o_orderdate) in (1996, 1998) or (year(o_orderdate) = 1995 and o_orderstatus = 'F')) and o_orderpriority = '1-URGENT'""")
def partition_scan(spark, d):
    """Two partitions, a subpartition of a third, and one named twice."""
    folder = orders_by_year(spark, d)
    out = stored(partitioned.scan(spark, folder, [{"year": 1996}, {"year": 1998}, {"year": 1995, "o_orderstatus": "F"}, {"year": 1996, "o_orderstatus": "O"}], "o_orderpriority = '1-URGENT'").select("year", "o_orderstatus", "o_orderkey"))
    dropped(spark, [folder])
    return out


@query("select year(o_orderdate) as year, count(*) as n, min(o_orderkey) as first from orders where year(o_orderdate) in (select year(l_shipdate) from lineitem group by year(l_shipdate) having count(*) % 2 = 0) group by 1")
def matching_partitions(spark, d):
    """Partitions that another table asks for, found while the query runs."""
    folder = orders_by_year(spark, d)
    wanted = t(spark, d, "lineitem").groupBy(F.year("l_shipdate").alias("y")).count().where("count % 2 = 0")
    out = stored(partitioned.scan_matching(spark, folder, "year", wanted, "y").groupBy("year").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first")))
    dropped(spark, [folder])
    return out


@query("""select o_orderkey, o_custkey, case when o_orderstatus = 'F' then 'DONE' else o_orderpriority end as o_orderpriority from orders where o_custkey in (select c_custkey from customer where c_acctbal > 0)""")
def rewritten_in_place(spark, d):
    """Orders of customers in credit stay, then their priorities are changed: two rewrites, the second over what the first left."""
    root = _folder(spark)
    versioned.create(t(spark, d, "orders"), root)
    versioned.survivors(spark, root, t(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey")), ["o_custkey"])
    versioned.rewrite(spark, root, lambda df: df.withColumn("o_orderpriority", F.when(F.col("o_orderstatus") == "F", "DONE").otherwise(F.col("o_orderpriority"))))
    versioned.vacuum(spark, root)
    return versioned.read(spark, root).select("o_orderkey", "o_custkey", "o_orderpriority")


@query("""with n as (select count(*) as n from customer), o as (select count(*) as n from orders) select 'customer' as "table", n as rows, 'exported' as state from n union all select 'orders', n, 'tables changed' from o union all select 'orders', n, 'run not finished' from o union all select 'customer', n, 'run missing' from n""")
def guarded_export(spark, d):
    """Exports of a masked and a later changed table, of a run that hasn't ended, and without a run."""
    folder, rows = _folder(spark), []
    roots = {k: f"{folder}/{k}" for k in ("customer", "orders")}
    for k, at in (("customer", 10.0), ("orders", 30.0)):
        versioned.create(t(spark, d, k), roots[k], now=lambda at=at: at)
    runs = spark.createDataFrame([(1, "shop", "MASKING", "FINISHED", 20.0), (2, "shop", "MASKING", "RUNNING", 50.0)], "run int, schema string, phase string, state string, ended_at double")
    for tables, masked, run in ((roots, ["customer"], 1), ({"orders": roots["orders"]}, ["orders"], 1), ({"orders": roots["orders"]}, ["orders"], 2), (roots, ["customer"], None)):
        try:
            done = versioned.export(spark, runs, "SHOP", tables, f"{folder}/out{len(rows)}", masked, "S", run)
            rows.append(done.withColumn("state", F.lit("exported")))
        except versioned.Refused as e:
            state = next(s for s, part in (("run missing", "needs the run"), ("run not finished", "no finished"), ("tables changed", "changed after")) if part in str(e))
            rows.append(versioned.read(spark, roots[masked[0]]).agg(F.count("*").alias("rows")).select(F.lit(masked[0]).alias("table"), "rows", F.lit(state).alias("state")))
    out = stored(rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3]))
    dropped(spark, [folder])
    return out


@query("""with a as (select cast(floor(c_custkey / 100) * 100 as bigint) as lo, c_custkey % 500 = 7 as changed, c_custkey % 700 = 9 as gone from customer)
 select lo, lo + 99 as hi, count(*) as rows_a, count(*) - count(*) filter (gone) as rows_b from a group by lo having bool_or(changed or gone)""")
def replica_differences(spark, d):
    """A copy in which some rows were changed and some are gone, range of keys by range of keys."""
    c = t(spark, d, "customer")
    other = c.where("c_custkey % 700 <> 9").withColumn("c_name", F.when(F.col("c_custkey") % 500 == 7, F.lower("c_name")).otherwise(F.col("c_name"))).repartition(5)
    return replica.differences(c, other, "c_custkey", 100)


@query("select 'supplier' as tab, count(*) as rows from supplier union all select 'part', count(*) from part union all select 'orders', count(*) from orders")
def verified_replicas(spark, d):
    folder = _folder(spark)
    rows = [(k, replica.replicate(t(spark, d, k), f"{folder}/{k}", key)) for k, key in (("supplier", "s_suppkey"), ("part", "p_partkey"), ("orders", "o_orderkey"))]
    dropped(spark, [folder])
    return spark.createDataFrame(rows, "tab string, rows long")


_ACCOUNT = "lpad(cast(((('0x' || substr(md5('ACCOUNT|' || c_nationkey), 1, 7))::bigint % 2147483646 + 1) * 131 + 17) % 1000000000000 as varchar), 4, '0')"


@query(f"select c_custkey, 'MASKED' as c_mktsegment, cast({_ACCOUNT} as integer) as c_nationkey, cast(null as double) as c_acctbal, c_name from customer")
def masked_in_place(spark, d):
    """A stored table masked by one rewrite: texts cut to their length, numbers cast back, null where a mask is no number."""
    root = _folder(spark)
    versioned.create(t(spark, d, "customer"), root)
    masking.rebuilt(spark, root, {"c_mktsegment": ("FREE_TEXT", 6), "c_nationkey": ("ACCOUNT", None), "c_acctbal": ("FREE_TEXT", None)})
    versioned.vacuum(spark, root)
    return versioned.read(spark, root).select("c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal", "c_name")
