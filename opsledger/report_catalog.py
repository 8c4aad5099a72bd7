"""Reports that are plain SQL: one text, which Spark plans over the Parquet tables and the checking engine runs too."""

from __future__ import annotations

import re

from opsledger.registry import CHECKS, QUERIES, t

REPORTS = {
    # projections and predicates
    "projection_arithmetic": """select l_orderkey, l_linenumber, l_partkey, cast(round(l_extendedprice * 100) as bigint) * (100 - cast(round(l_discount * 100) as bigint)) as revenue
 from {lineitem} where l_quantity > 10 and not (l_returnflag = 'R' or l_linestatus = 'O')""",
    "list_predicates": """select o_orderkey from {orders} where o_orderpriority in ('1-URGENT', '2-HIGH') and o_orderstatus not in ('P')
 and o_orderdate between timestamp '1996-01-01 00:00:00' and timestamp '1998-12-31 23:59:59' and not o_orderpriority like '%!_%' escape '!'""",
    "tuple_in_latest": "select o_custkey, o_orderkey, o_orderdate from {orders} where (o_custkey, o_orderdate) in (select o_custkey, max(o_orderdate) from {orders} group by o_custkey)",
    # joins
    "left_outer_extra_on": "select c_custkey, count(o_orderkey) as finished from {customer} left join {orders} on o_custkey = c_custkey and o_orderstatus = 'F' group by c_custkey",
    "right_outer_using": """select k, n_name, count(s_suppkey) as suppliers from (select n_nationkey as k, n_name from {nation} where n_regionkey < 3) n
 right join (select s_nationkey as k, s_suppkey from {supplier}) s using (k) group by k, n_name""",
    "natural_join": "select region_key, r_name, n_name from (select r_regionkey as region_key, r_name from {region}) r natural join (select n_regionkey as region_key, n_name from {nation}) n",
    "composite_key_join": """select l.l_orderkey, l.l_partkey, l.l_suppkey, count(*) as n from {lineitem} l join (select distinct l_partkey, l_suppkey from {lineitem} where l_returnflag = 'R') r
 on l.l_partkey = r.l_partkey and l.l_suppkey = r.l_suppkey group by l.l_orderkey, l.l_partkey, l.l_suppkey""",
    "key_in_name": "select c_custkey, o_orderkey from {customer} join {orders} on cast(replace(c_name, 'Customer#', '') as bigint) = o_custkey",
    "value_in_band": """select band, count(*) as n, cast(sum(cast(round(l_quantity) as bigint)) as bigint) as qty from {lineitem}
 join (values (0, 10, 'low'), (10, 30, 'middle'), (30, 51, 'high')) as b(lo, hi, band) on l_quantity >= lo and l_quantity < hi group by band""",
    "semi_exists": "select c_custkey from {customer} c where exists (select 1 from {orders} o where o.o_custkey = c.c_custkey and o.o_orderpriority = '1-URGENT')",
    "null_aware_not_in": """select 'with a null' as list, count(*) as n from {customer} where c_nationkey not in (select case when s_nationkey > 20 then null else s_nationkey end from {supplier})
 union all select 'without' as list, count(*) as n from {customer} where c_nationkey not in (select s_nationkey from {supplier} where s_nationkey <= 20)""",
    "above_own_average": "select o_orderkey, o_custkey from {orders} o where o_totalprice > (select avg(i.o_totalprice) from {orders} i where i.o_custkey = o.o_custkey)",
    "one_row_kpis": """select customers, orders, cast(floor(orders * 100 / customers) as bigint) as per_hundred from (select count(*) as customers from {customer}) c cross join (select count(*) as orders from {orders}) o""",
    "side_by_side": """with g as (select p_brand, count(*) as n from {part} group by p_brand), r as (select p_brand, n, row_number() over (order by n desc, p_brand) as k from g)
 select a.k, a.p_brand as brand, a.n, b.p_brand as other, b.n as other_n from r a left join r b on b.k = a.k + 6 where a.k <= 6""",
    # aggregation
    "group_basic": """select l_returnflag, l_linestatus, count(*) as n, min(l_shipdate) as first_ship, max(l_shipdate) as last_ship, cast(sum(cast(round(l_quantity) as bigint)) as bigint) as qty
 from {lineitem} group by l_returnflag, l_linestatus""",
    "global_aggregate": "select count(*) as n, count(distinct o_custkey) as customers, min(o_orderdate) as first_day, max(o_orderdate) as last_day from {orders}",
    "count_distinct_mix": "select l_returnflag, count(*) as n, count(distinct l_suppkey) as suppliers, max(l_quantity) as high from {lineitem} group by l_returnflag",
    "all_finished": "select o_custkey, count(*) as n from {orders} group by o_custkey having count(*) = sum(case when o_orderstatus = 'F' then 1 else 0 end)",
    "aggregate_of_aggregate": "select n, count(*) as customers from (select o_custkey, count(*) as n from {orders} group by o_custkey having count(*) > 1) g group by n",
    "privilege_matrix": """select c_nationkey, max(case when c_mktsegment = 'BUILDING' then 'X' end) as building, max(case when c_mktsegment = 'MACHINERY' then 'X' end) as machinery,
 max(case when c_mktsegment = 'FURNITURE' then 'X' end) as furniture from {customer} group by c_nationkey""",
    "high_water_mark": "select l_orderkey, max(l_linenumber + cast(round(l_quantity) as int) - 1) as top from {lineitem} group by l_orderkey",
    "guarded_ratio": """select user_id, clicks, buys, case when clicks > 0 then cast(floor(buys * 1000 / clicks) as bigint) else 0 end as per_mille
 from (select user_id, sum(case when event_type = 'click' then 1 else 0 end) as clicks, sum(case when event_type = 'purchase' then 1 else 0 end) as buys from {events} group by user_id) g""",
    "imbalance": "select cast(floor(100 * (max(n) - min(n)) / max(n)) as bigint) as pct from (select s_nationkey, count(*) as n from {supplier} group by s_nationkey) g",
    "feature_usage": """select product, kind, grouping(kind) as all_kinds, count(*) as n, sum(case when used = 'Y' then 1 else 0 end) as used_n
 from (select u.event_type as kind, m.product, case when u.value > 20 then 'Y' else 'N' end as used from {events} u
 join (values ('web', 'click'), ('web', 'view'), ('shop', 'purchase'), ('shop', 'signup')) as m(product, feature) on u.event_type = m.feature) x group by product, rollup(kind) having count(*) > 0""",
    # windows
    "aggregate_then_rank": """select c_nationkey, c_mktsegment, n, place from (select c_nationkey, c_mktsegment, n, row_number() over (partition by c_nationkey order by n desc, c_mktsegment) as place
 from (select c_nationkey, c_mktsegment, count(*) as n from {customer} group by c_nationkey, c_mktsegment) g) r where place <= 2""",
    "normalized_dedup": "select p_partkey, p_name from (select p_partkey, p_name, row_number() over (partition by upper(trim(p_name)), p_brand order by p_size desc, p_partkey) as k from {part}) r where k = 1",
    "first_value_latest": "select distinct user_id, first_value(event_type) over (partition by user_id order by ts desc nulls last, event_id) as latest from {events}",
    "lag_and_lead": """select event_id, lag(event_id, 1, event_id) over (partition by user_id order by ts, event_id) as before, lead(event_id, 1, event_id) over (partition by user_id order by ts, event_id) as after from {events}""",
    "rank_of_ordered": """select row_number() over (order by o_totalprice desc, o_orderkey) as place, o_orderkey from (select o_orderkey, o_totalprice from {orders} order by o_totalprice desc, o_orderkey limit 25) x""",
    "weekly_growth": """select week, n, cast(sum(n) over (order by week) as bigint) as so_far from (select cast(date_trunc('week', o_orderdate) as date) as week, count(*) as n from {orders} group by cast(date_trunc('week', o_orderdate) as date)) g""",
    # order, sets, chains
    "order_by_priority": """select o_orderkey, o_orderpriority from {orders} order by case o_orderpriority when '1-URGENT' then 1 when '2-HIGH' then 2 else 3 end, o_orderdate desc nulls last, o_orderkey limit 20""",
    "kpi_stack": """select 'customers' as label, cast(count(*) as varchar(20)) as value from {customer} union select 'orders', cast(count(*) as varchar(20)) from {orders} union select 'segments', cast(count(distinct c_mktsegment) as varchar(20)) from {customer}""",
    "set_order": "((select c_nationkey as k from {customer} union select s_nationkey as k from {supplier}) intersect select n_nationkey as k from {nation}) except select n_nationkey as k from {nation} where n_regionkey = 0",
    "intersect_in": "select c_custkey, c_nationkey from {customer} where (c_custkey, c_nationkey) in (select s_suppkey, s_nationkey from {supplier} intersect select c_custkey, c_nationkey from {customer})",
    "chained_steps": """with l as (select l_orderkey, cast(sum(cast(round(l_quantity) as bigint)) as bigint) as qty from {lineitem} group by l_orderkey), o as (select o_custkey, qty from {orders} join l on l_orderkey = o_orderkey),
 c as (select c_nationkey, o.qty from o join {customer} on c_custkey = o.o_custkey) select n_name, cast(sum(c.qty) as bigint) as qty, count(*) as orders from c join {nation} on n_nationkey = c_nationkey group by n_name""",
    "role_closure": """with recursive e as (select 'root' as up, r_name as node from {region} union all select r_name, n_name from {region} join {nation} on n_regionkey = r_regionkey union all select n_name, s_name from {nation} join {supplier} on s_nationkey = n_nationkey where s_acctbal > 0),
 r as (select node, 1 as level, up || '/' || node as path from e where up = 'root' union all select e.node, r.level + 1 as level, r.path || '/' || e.node as path from r join e on e.up = r.node)
 select node, level, path, repeat(' ', 2 * level) || node as shown from r where level > 1 or node = 'ASIA'""",
    # changes written anew
    "update_with_expression": "select c_custkey, case when c_mktsegment = 'BUILDING' then 'B-' || c_name else c_name end as c_name from {customer}",
    "kept_by_keys": "select l_orderkey, l_linenumber, l_partkey, l_suppkey from {lineitem} where l_orderkey in (select o_orderkey from {orders} where o_orderstatus <> 'P')",
    "clone_of_schema": "select * from {customer} where 1 = 2 union all select * from {customer} where c_nationkey = 3",
    "validation_counts": """select 'orders without customer' as rule, count(*) as n from {orders} where not exists (select 1 from {customer} where c_custkey = o_custkey)
 union all select 'lines without order' as rule, count(*) as n from {lineitem} where not exists (select 1 from {orders} where o_orderkey = l_orderkey)""",
    "progress": """select user_id, done, total, cast(floor(100 * done / total) as bigint) as pct, case when done > 0 then cast(floor(3600 * (total - done) / done) as bigint) end as left_s
 from (select user_id, sum(case when event_type <> 'error' then 1 else 0 end) as done, count(*) as total from {events} group by user_id) g""",
    "autoextend_capacity": """with used as (select c_nationkey as k, cast(sum(cast(round(c_acctbal * 100) as bigint)) as bigint) as used from {customer} group by c_nationkey),
 room as (select s_nationkey as k, cast(sum(greatest(cast(round(s_acctbal * 100) as bigint), 0)) as bigint) as bytes, max(case when s_suppkey > 5 then 'YES' else 'NO' end) as grows from {supplier} group by s_nationkey)
 select n_name, coalesce(used, 0) as used, coalesce(case when grows = 'YES' then greatest(bytes * 2, used) else bytes end, 0) as most, case when bytes is null then 'NONE' when used * 100 > bytes * 95 then 'ALERT' else 'OK' end as state
 from {nation} left join used on used.k = n_nationkey left join room on room.k = n_nationkey""",
}


def _add(name: str, sql: str) -> None:
    tables = sorted(set(re.findall(r"\{(\w+)\}", sql)))

    def run(spark, sf_dir):
        return spark.sql(sql, **{k: t(spark, sf_dir, k) for k in tables})

    QUERIES[name] = run
    CHECKS[name] = sql.format(**{k: k for k in tables})


for _name, _sql in REPORTS.items():
    _add(_name, _sql)
