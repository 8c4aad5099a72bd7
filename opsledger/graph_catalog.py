"""Queries over graphs: closures, pre-orders, blockers."""

from __future__ import annotations

from pyspark.sql import functions as F

from opsledger.operators import graphs
from opsledger.registry import query, t

LINKS = """select case when l_linenumber % 2 = 1 then concat('s', l_suppkey) else concat('p', l_partkey) end as up, case when l_linenumber % 2 = 1 then concat('p', l_partkey) else concat('s', l_suppkey) end as down
 from {lineitem} where l_quantity >= 49.5"""


@query(f"""with recursive e as ({LINKS.format(lineitem='lineitem')}), r(root, node, depth) using key (root, node) as (select concat('s', s_suppkey) as root, concat('s', s_suppkey) as node, 0 as depth from supplier where s_nationkey < 3
 union select r.root, e.down, min(r.depth) + 1 from r join e on e.up = r.node left join recurring.r as k on k.root = r.root and k.node = e.down where k.node is null group by r.root, e.down) select root, node, depth from r""")
def supply_closure(spark, d):
    """Suppliers and parts that the suppliers of three nations reach over shipments of fifty, cycles and diamonds among them."""
    edges = spark.sql(LINKS, lineitem=t(spark, d, "lineitem"))
    return graphs.closure(edges, t(spark, d, "supplier").where("s_nationkey < 3").select(F.concat(F.lit("s"), "s_suppkey").alias("root")))


STAFF = "select c.c_nationkey, c.c_custkey, c.c_mktsegment, c.c_name, b.c_nationkey as boss_nation, b.c_custkey as boss from {customer} c left join {customer} b on c.c_custkey > 3 and b.c_custkey = cast(floor(c.c_custkey / 3) as bigint)"


@query(f"""with recursive s as ({STAFF.format(customer='customer')}), r as (select c_nationkey, c_custkey, c_name, 1 as level, [{{'m': c_mktsegment, 'n': c_nationkey, 'k': c_custkey}}] as path from s where boss is null
 union all select s.c_nationkey, s.c_custkey, s.c_name, r.level + 1, list_append(r.path, {{'m': s.c_mktsegment, 'n': s.c_nationkey, 'k': s.c_custkey}}) from s join r on s.boss_nation = r.c_nationkey and s.boss = r.c_custkey),
 sizes as (select k, count(*) as size from (select unnest(list_transform(path, lambda x: x.k)) as k from r) u group by k)
 select row_number() over (order by path) as place, c_nationkey, c_custkey, cast(level as integer) as level, size, repeat('  ', cast(level - 1 as integer)) || c_name as shown from r join sizes on k = c_custkey""")
def pre_order_listing(spark, d):
    """Customers below the ones that they report to, by keys of two columns, in pre-order: siblings by segment."""
    staff = spark.sql(STAFF, customer=t(spark, d, "customer"))
    out = graphs.pre_order(staff, ["c_nationkey", "c_custkey"], ["boss_nation", "boss"], ["c_mktsegment"])
    return out.select("place", "c_nationkey", "c_custkey", "level", "size", F.concat(F.expr("repeat('  ', level - 1)"), "c_name").alias("shown"))


@query("""with recursive l as (select user_id as node, max_by(event_id, ts + to_microseconds(event_id)) as e, max_by(event_type, ts + to_microseconds(event_id)) as kind from events group by user_id),
 w as (select l.node, case when kind <> 'purchase' and b.user_id <> l.node then b.user_id end as up from l left join events b on b.event_id = l.e // 2),
 p as (select node as sid, node as at, [node] as path from w union all select p.sid, w.up, list_append(p.path, w.up) from p join w on w.node = p.at where w.up is not null and not list_contains(p.path, w.up)),
 z as (select sid, path, row_number() over (partition by sid order by len(path) desc) as k from p),
 ends as (select z.sid, z.path, w.up as again from z join w on w.node = z.path[len(z.path)] where k = 1),
 told as (select sid as node, case when again is null then path[len(path)] else list_min(path[list_position(path, again):]) end as blocker, case when again is null then len(path) end as level, again is not null as cycle from ends)
 select node, blocker, cast(level as bigint) as level, cycle, count(*) filter (node <> blocker) over (partition by blocker) as waiters from told""")
def blocker_forest(spark, d):
    """Who blocks each user in the end, if each waits for the user of the event half as far as their last, unless that was a purchase."""
    e = t(spark, d, "events")
    last = e.groupBy("user_id").agg(F.max_by(F.struct("event_id", "event_type"), F.struct("ts", "event_id")).alias("x"))
    other = e.select(F.col("event_id").alias("half"), F.col("user_id").alias("other"))
    waits = last.select("user_id", F.col("x.event_type").alias("kind"), F.expr("x.event_id div 2").alias("half")).join(other, "half", "left")
    return graphs.final_blockers(waits.select("user_id", F.when(F.col("kind") != "purchase", F.col("other")).alias("up")), "user_id", "up")
