"""Referential subsets, as the keys kept of each table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsledger.operators.subset import Edge, Graph, Node, dangling, subset
from opsledger.registry import query, t

KEYS = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey", "lineitem": "line_key"}
EDGES = [
    Edge("nation", "n_regionkey", "region", "r_regionkey"),
    Edge("customer", "c_nationkey", "nation", "n_nationkey"),
    Edge("supplier", "s_nationkey", "nation", "n_nationkey"),
    Edge("orders", "o_custkey", "customer", "c_custkey"),
    Edge("lineitem", "l_orderkey", "orders", "o_orderkey"),
    Edge("lineitem", "l_partkey", "part", "p_partkey"),
    Edge("lineitem", "l_suppkey", "supplier", "s_suppkey"),
]
LINE = "concat(l_orderkey, '|', l_linenumber, '|', l_partkey, '|', l_suppkey)"


def _graph(spark, d, names: list[str], **rules: Node) -> tuple[dict[str, DataFrame], Graph]:
    tables = {k: t(spark, d, k) for k in names}
    if "lineitem" in tables:
        tables["lineitem"] = tables["lineitem"].withColumn("line_key", F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    return tables, Graph({k: rules.get(k) or Node(KEYS[k]) for k in names}, [e for e in EDGES if e.child in names and e.parent in names])


def _kept(tables: dict[str, DataFrame], graph: Graph) -> DataFrame:
    kept = subset(tables, graph)
    return reduce(DataFrame.unionByName, [df.select(F.lit(k).alias("tab"), F.col(graph.nodes[k].key).cast("string").alias("key")) for k, df in sorted(kept.items())])


def _sql(steps: str, **keys: str) -> str:
    return f"with {steps} " + " union all ".join(f"select '{k}' as tab, cast({v} as varchar) as key from {k}_kept" for k, v in keys.items())


WANTED = "o_orderstatus = 'F' and o_orderpriority = '1-URGENT'"


@query(_sql(f"""orders_kept as (select * from orders where {WANTED}), lineitem_kept as (select *, {LINE} as line_key from lineitem where l_orderkey in (select o_orderkey from orders_kept)),
 customer_kept as (select * from customer where c_custkey in (select o_custkey from orders_kept)), supplier_kept as (select * from supplier where s_suppkey in (select l_suppkey from lineitem_kept)),
 part_kept as (select * from part where p_partkey in (select l_partkey from lineitem_kept)), nation_kept as (select * from nation where n_nationkey in (select c_nationkey from customer_kept union select s_nationkey from supplier_kept)),
 region_kept as (select * from region where r_regionkey in (select n_regionkey from nation_kept))""", **KEYS))
def referential_subset(spark, d):
    return _kept(*_graph(spark, d, list(KEYS), orders=Node("o_orderkey", where=WANTED)))


UP = "nation_kept as (select * from nation where n_nationkey in (select {fk} from {of}_kept)), region_kept as (select * from region where r_regionkey in (select n_regionkey from nation_kept))"
GEO = {"region": "r_regionkey", "nation": "n_nationkey"}


@query(_sql(f"""wanted as (select *, count(*) over () as n from customer where c_mktsegment = 'BUILDING'), numbered as (select *, row_number() over (order by md5(cast(c_custkey as varchar)), c_custkey) as k from wanted),
 customer_kept as (select * from numbered where k <= floor(n * 0.2 + 0.5)), {UP.format(fk='c_nationkey', of='customer')}""", customer="c_custkey", **GEO))
def subset_percent_of_condition(spark, d):
    return _kept(*_graph(spark, d, ["region", "nation", "customer"], customer=Node("c_custkey", where="c_mktsegment = 'BUILDING'", percent=20)))


@query(_sql(f"""numbered as (select *, row_number() over (order by md5(cast(c_custkey as varchar)), c_custkey) as k, count(*) over () as n from customer),
 customer_kept as (select * from numbered where k <= floor(n * 0.1) + 1), {UP.format(fk='c_nationkey', of='customer')}""", customer="c_custkey", **GEO))
def subset_some_rows(spark, d):
    return _kept(*_graph(spark, d, ["region", "nation", "customer"], customer=Node("c_custkey", percent=10)))


@query(_sql("""nation_kept as (select * from nation where n_regionkey = 1), region_kept as (select * from region where r_regionkey = 1), supplier_kept as (select * from supplier where s_nationkey in (select n_nationkey from nation_kept)),
 numbered as (select *, row_number() over (order by md5(cast(c_custkey as varchar)), c_custkey) as k from customer where c_nationkey in (select n_nationkey from nation_kept)), customer_kept as (select * from numbered where k <= 7)""", customer="c_custkey", supplier="s_suppkey", **GEO))
def subset_capped_children(spark, d):
    return _kept(*_graph(spark, d, ["region", "nation", "customer", "supplier"], nation=Node("n_nationkey", where="n_regionkey = 1"), customer=Node("c_custkey", max_rows=7)))


@query(_sql(f"customer_kept as (select * from customer where c_custkey % 4 = 1), {UP.format(fk='c_nationkey', of='customer')}", customer="c_custkey", **GEO))
def subset_parents_beyond_cap(spark, d):
    return _kept(*_graph(spark, d, ["region", "nation", "customer"], customer=Node("c_custkey", where="c_custkey % 4 = 1"), nation=Node("n_nationkey", max_rows=2)))


@query(_sql(f"supplier_kept as (select * from supplier), customer_kept as (select * from customer where 1 = 2), {UP.format(fk='s_nationkey', of='supplier')}", customer="c_custkey", supplier="s_suppkey", **GEO))
def subset_whole_table_drives(spark, d):
    return _kept(*_graph(spark, d, ["region", "nation", "customer", "supplier"], supplier=Node("s_suppkey", include_all=True)))


@query(_sql("""orders_kept as (select * from orders where o_custkey % 10 = 3), customer_kept as (select * from customer where c_custkey in (select o_custkey from orders_kept)), nation_kept as (select * from nation where n_nationkey in (select c_nationkey from customer_kept)),
 region_kept as (select * from region where r_regionkey in (select n_regionkey from nation_kept)), supplier_kept as (select * from supplier where s_nationkey in (select n_nationkey from nation_kept))""", orders="o_orderkey", customer="c_custkey", supplier="s_suppkey", **GEO))
def subset_forced_children(spark, d):
    tables, graph = _graph(spark, d, ["region", "nation", "customer", "supplier", "orders"], orders=Node("o_orderkey", where="o_custkey % 10 = 3", pull_children=False))
    graph.forced.add(("supplier", "nation"))
    return _kept(tables, graph)


@query(_sql("customer_kept as (select * from customer where c_custkey <= 5), orders_kept as (select * from orders where o_custkey <= 5), nation_kept as (select * from nation where 1 = 2)", customer="c_custkey", orders="o_orderkey", nation="n_nationkey"))
def subset_flags_of_the_driver(spark, d):
    """The driving table's flags hold all the way: its orders don't pull parents though their own flag says so."""
    return _kept(*_graph(spark, d, ["nation", "customer", "orders"], customer=Node("c_custkey", where="c_custkey <= 5", pull_parents=False)))


@query("""with recursive c as (select c_custkey, case when c_custkey > 3 then c_custkey // 3 end as boss from customer), r as (select c_custkey, boss from c where c_custkey % 50 = 0 union select c.c_custkey, c.boss from c join r on c.c_custkey = r.boss)
 select 'customer' as tab, cast(c_custkey as varchar) as key from r""")
def subset_of_own_parents(spark, d):
    c = t(spark, d, "customer").withColumn("boss", F.expr("case when c_custkey > 3 then c_custkey div 3 end"))
    return _kept({"customer": c}, Graph({"customer": Node("c_custkey", where="c_custkey % 50 = 0")}, [Edge("customer", "boss", "customer", "c_custkey")]))


@query("""select 'customer' as tab, cast(c_custkey as varchar) as key from customer where c_custkey between 1 and 12""")
def subset_over_a_cycle(spark, d):
    c = t(spark, d, "customer").withColumn("boss", F.expr("case when c_custkey between 1 and 12 then c_custkey % 12 + 1 end"))
    return _kept({"customer": c}, Graph({"customer": Node("c_custkey", where="c_custkey = 5")}, [Edge("customer", "boss", "customer", "c_custkey")]))


@query("select child, parent, cast(0 as bigint) as n from (values ('nation', 'region'), ('customer', 'nation'), ('orders', 'customer')) as e(child, parent)")
def subset_without_dangling_rows(spark, d):
    tables, graph = _graph(spark, d, ["region", "nation", "customer", "orders"], orders=Node("o_orderkey", percent=5), nation=Node("n_nationkey", max_rows=1))
    return dangling(subset(tables, graph), graph)


@query(_sql(f"customer_kept as (select * from customer where c_custkey % 40 = 1), supplier_kept as (select * from supplier where 1 = 2), part_kept as (select * from part where 1 = 2), {UP.format(fk='c_nationkey', of='customer')}", customer="c_custkey", supplier="s_suppkey", part="p_partkey", **GEO))
def subset_of_applications(spark, d):
    """Only the shop's tables drive: the store's rule and its table taken whole don't count, the nations that the shop needs do."""
    tables, graph = _graph(spark, d, ["region", "nation", "customer", "supplier", "part"], customer=Node("c_custkey", where="c_custkey % 40 = 1", app="shop"), supplier=Node("s_suppkey", where="s_acctbal > 0", app="store"), part=Node("p_partkey", include_all=True, app="store"))
    kept = subset(tables, graph, ["shop"])
    return reduce(DataFrame.unionByName, [df.select(F.lit(k).alias("tab"), F.col(graph.nodes[k].key).cast("string").alias("key")) for k, df in sorted(kept.items())])
