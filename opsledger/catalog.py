"""Named queries over the test tables, each with the SQL that another engine runs to check it."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from opsledger.functions import dialect, masks
from opsledger.operators import relational as rel
from opsledger.plans.masking import masked, without_collisions
from opsledger.registry import CHECKS, QUERIES, dec, query, t  # noqa: F401

FLAGSHIP = "capacity_by_container"


@query("""select n.n_name, count(*) as suppliers, sum(cast(s_acctbal as decimal(18,2))) as balance,
 case when sum(cast(s_acctbal as decimal(18,2))) > 10000 then 'ALERT' else 'OK' end as status
 from nation n left join supplier s on s.s_nationkey = n.n_nationkey group by n.n_name""")
def capacity_by_container(spark, d):
    j = F.broadcast(t(spark, d, "nation")).join(t(spark, d, "supplier"), F.col("s_nationkey") == F.col("n_nationkey"), "right")
    used = j.groupBy("n_nationkey").agg(F.count("*").alias("suppliers"), F.sum(dec("s_acctbal")).alias("balance"))
    out = t(spark, d, "nation").join(used, "n_nationkey", "left")
    return out.select("n_name", F.coalesce("suppliers", F.lit(1)).alias("suppliers"), "balance", F.when(F.col("balance") > 10000, "ALERT").otherwise("OK").alias("status"))


@query("""select r_name, n_name, count(*) as orders, sum(cast(o_totalprice as decimal(18,2))) as total from orders
 join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by r_name, n_name""")
def star_join(spark, d):
    o = t(spark, d, "orders").join(t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey").agg(F.count("*").alias("orders"), F.sum(dec("o_totalprice")).alias("total"))
    n = t(spark, d, "nation").join(t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return o.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("r_name", "n_name", "orders", "total")


@query("""select coalesce(cast(l_returnflag as varchar), 'TOTAL') as l_returnflag, coalesce(cast(l_linestatus as varchar), 'TOTAL') as l_linestatus, count(*) as n, sum(cast(l_quantity as decimal(18,2))) as qty
 from lineitem group by rollup(l_returnflag, l_linestatus)""")
def rollup_subtotals(spark, d):
    return rel.with_subtotals(t(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], [F.count("*").alias("n"), F.sum(dec("l_quantity")).alias("qty")])


@query("""select event_type, grouping(event_type) as is_total, cast(floor(user_id / 100) as bigint) as bucket, count(*) as n from events group by floor(user_id / 100), rollup(event_type)""")
def partial_rollup(spark, d):
    return spark.sql("select event_type, cast(grouping(event_type) as bigint) is_total, cast(floor(user_id / 100) as bigint) bucket, count(*) n from {ev} group by floor(user_id / 100), rollup(event_type)", ev=t(spark, d, "events"))


@query("select cast(ts as date) as day, " + ", ".join(f"count(*) filter (where hour(ts) = {h}) as h_{h}" for h in range(24)) + " from events group by 1")
def heat_map(spark, d):
    return rel.crosstab(t(spark, d, "events").withColumn("day", F.to_date("ts")), ["day"], F.hour("ts").cast("string"), [str(h) for h in range(24)], F.count(F.lit(1)), "h")


@query("""select l_shipmode_like as brand_line, n, pct from (select p_brand as l_shipmode_like, count(*) as n, round(100.0 * count(*) / sum(count(*)) over (), 6) as pct from part group by p_brand)""")
def ratio_to_report(spark, d):
    g = t(spark, d, "part").groupBy("p_brand").agg(F.count("*").alias("n"))
    total = g.agg(F.sum("n").alias("total"))
    return g.crossJoin(F.broadcast(total)).select(F.col("p_brand").alias("brand_line"), "n", F.round(F.lit(100.0) * F.col("n") / F.col("total"), 6).alias("pct"))


@query("""select c_custkey, c_name, o_orderkey, o_orderdate from (select c_custkey, c_name, o_orderkey, o_orderdate, row_number() over (partition by c_custkey order by o_orderdate desc, o_orderkey) as n
 from customer join orders on c_custkey = o_custkey) where n = 1""")
def latest_per_group(spark, d):
    o = t(spark, d, "orders").groupBy("o_custkey").agg(F.max_by(F.struct("o_orderkey", "o_orderdate"), F.struct("o_orderdate", -F.col("o_orderkey"))).alias("x"))
    return t(spark, d, "customer").join(o, F.col("c_custkey") == F.col("o_custkey")).select("c_custkey", "c_name", "x.o_orderkey", "x.o_orderdate")


@query("select o_orderkey, o_custkey, cast(o_totalprice as decimal(18,2)) as price from orders order by o_totalprice desc, o_orderkey limit 10")
def top_n(spark, d):
    return t(spark, d, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10).select("o_orderkey", "o_custkey", dec("o_totalprice").alias("price"))


@query("""select user_id, event_id, lag_s, case when lag_s = 0 then 1 else lag_s end as guarded, size * 3600 // case when lag_s = 0 then 1 else lag_s end as per_hour
 from (select user_id, event_id, cast(round(value * 100) as bigint) as size, cast(epoch_us(ts) - epoch_us(lag(ts, 1, ts) over (partition by user_id order by ts, event_id)) as bigint) // 1000000 as lag_s from events)""")
def rate_between_rows(spark, d):
    """Size over the time since the row before, a gap of zero counted as one second."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    lag = F.floor((micros - F.coalesce(F.lag(micros).over(w), micros)) / 1000000)
    rows = t(spark, d, "events").select("user_id", "event_id", F.round(F.col("value") * 100).cast("long").alias("size"), lag.alias("lag_s")).withColumn("guarded", F.when(F.col("lag_s") == 0, 1).otherwise(F.col("lag_s")))
    return rows.select("user_id", "event_id", "lag_s", "guarded", F.floor(F.col("size") * 3600 / F.col("guarded")).alias("per_hour"))


@query("""with k as (select distinct l_linenumber as thread, l_orderkey as seq from lineitem), w as (select thread, seq, lag(seq) over (partition by thread order by seq) as prev from k)
 select thread, unnest(generate_series(prev + 1, seq - 1)) as missing from w where seq > prev + 1""")
def missing_sequences(spark, d):
    x = t(spark, d, "lineitem").select(F.col("l_linenumber").alias("thread"), F.col("l_orderkey").alias("seq"))
    return rel.missing_numbers(x, ["thread"], "seq")


RANGES = "(select l_suppkey as f, l_orderkey * 10 as lo, l_orderkey * 10 + l_linenumber * 7 as hi from lineitem)"


@query(f"""with e as {RANGES} select a.f, a.lo as alo, b.lo as blo, greatest(a.lo, b.lo) as lo, least(a.hi, b.hi) as hi from e a join e b on a.f = b.f and a.lo <= b.hi and a.hi >= b.lo and a.lo < b.lo""")
def interval_overlap(spark, d):
    e = t(spark, d, "lineitem").select(F.col("l_suppkey").alias("f"), (F.col("l_orderkey") * 10).alias("alo"), (F.col("l_orderkey") * 10 + F.col("l_linenumber") * 7).alias("ahi"))
    b = e.select("f", F.col("alo").alias("blo"), F.col("ahi").alias("bhi"))
    return rel.overlap_join(e, b, ["f"], ("alo", "ahi"), ("blo", "bhi")).where("alo < blo").select("f", "alo", "blo", "lo", "hi")


@query(f"""with e as {RANGES}, w as (select f, lo, max(hi) over (partition by f order by lo, hi rows between unbounded preceding and 1 preceding) as e from e) select f, e + 1 as gap_lo, lo - 1 as gap_hi from w where lo > e + 1""")
def interval_gaps(spark, d):
    e = t(spark, d, "lineitem").select(F.col("l_suppkey").alias("f"), (F.col("l_orderkey") * 10).alias("lo"), (F.col("l_orderkey") * 10 + F.col("l_linenumber") * 7).alias("hi"))
    return rel.gaps(e, ["f"], "lo", "hi")


@query("""with recursive r as (select c_custkey as node, 1 as level, cast(c_custkey as varchar) as path from customer where c_custkey <= 3
 union all select c.c_custkey, r.level + 1, r.path || '/' || c.c_custkey from customer c join r on c.c_custkey // 3 = r.node and c.c_custkey > 3) select * from r""")
def hierarchy_paths(spark, d):
    c = t(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") > 3, F.floor(F.col("c_custkey") / 3)).alias("up"))
    h = rel.hierarchy(c, "c_custkey", "up", F.col("node") <= 3)
    return h.select("node", "level", F.array_join(F.col("path").cast("array<string>"), "/").alias("path"))


@query("select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_custkey is not null)")
def anti_join(spark, d):
    return t(spark, d, "customer").join(t(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("select s_suppkey from supplier where (s_suppkey, s_nationkey) in (select c_custkey, c_nationkey from customer)")
def tuple_in(spark, d):
    return spark.sql("select s_suppkey from {s} where (s_suppkey, s_nationkey) in (select c_custkey, c_nationkey from {c})", s=t(spark, d, "supplier"), c=t(spark, d, "customer"))


@query("(select c_nationkey as k from customer intersect select s_nationkey from supplier) union all (select c_nationkey from customer except select s_nationkey from supplier)")
def set_operations(spark, d):
    c, s = t(spark, d, "customer").select(F.col("c_nationkey").alias("k")), t(spark, d, "supplier").select(F.col("s_nationkey").alias("k"))
    return c.intersect(s).unionByName(c.subtract(s))


@query("select o_custkey, string_agg(cast(o_orderkey as varchar), ',' order by o_orderkey) as orders, count(distinct o_orderpriority) as priorities from orders group by o_custkey having count(*) > 5")
def ordered_strings(spark, d):
    g = t(spark, d, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list("o_orderkey")).alias("x"), F.count_distinct("o_orderpriority").alias("priorities"))
    return g.where(F.size("x") > 5).select("o_custkey", F.array_join(F.col("x").cast("array<string>"), ",").alias("orders"), "priorities")


@query("select max(s) as most from (select sum(cast(l_quantity as decimal(18,2))) as s from lineitem group by l_orderkey)")
def nested_aggregate(spark, d):
    return t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum(dec("l_quantity")).alias("s")).agg(F.max("s").alias("most"))


@query("""select a.event_id as blocker, b.event_id as blocked, a.user_id from events a join events b on a.user_id = b.user_id and a.ts < b.ts and epoch_us(b.ts) - epoch_us(a.ts) <= 600000000""")
def who_blocks_whom(spark, d):
    e = t(spark, d, "events").select("event_id", "user_id", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 600_000_000).alias("slot"), F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    b = e.select(F.col("event_id").alias("blocked"), "user_id", "us", F.explode(F.array("slot", F.col("slot") - 1)).alias("slot")).withColumnRenamed("us", "us2")
    return e.join(b, ["user_id", "slot"]).where("us < us2 and us2 - us <= 600000000").select(F.col("event_id").alias("blocker"), "blocked", "user_id")


SEED = "(('0x' || substr(md5('{salt}|' || {x}), 1, 7))::bigint % 2147483646 + 1)"


def _seed(salt: str, x: str) -> str:
    return SEED.format(salt=salt, x=x)


_ID = "lpad(cast(c_custkey * 7919 % 100000000 as varchar), 8, '0') || 'A'"


@query(f"""with s as (select c_custkey, c_name, {_seed('NAME', 'upper(c_name)')} as n, {_seed('PHONE', 'cast(c_custkey as varchar)')} as p, {_seed('EMAIL', "lower(c_name)")} as e, {_seed('ACCOUNT', 'cast(c_custkey as varchar)')} as a, {_seed('ID', _ID)} as i, {_seed('IBAN', "'ES00' || lpad(cast(c_custkey as varchar), 20, '0')")} as b from customer),
 v as (select *, lpad(cast((b * 137 + 31) % 1000000000000 as varchar), 20, '0') as bban from s)
 select c_custkey, array_to_string(list_transform(range(1, length(c_name) + 1), lambda k: case when regexp_matches(substr(c_name, k, 1), '[A-Za-z]') then chr(cast(65 + (n + 17 * length(regexp_replace(substr(c_name, 1, k), '[^A-Za-z]', '', 'g'))) % 26 as integer)) else substr(c_name, k, 1) end), '') as name,
 substr('6789', cast(p % 4 + 1 as integer), 1) || lpad(cast((p * 97 + 13) % 100000000 as varchar), 8, '0') as phone,
 array_to_string(list_transform(range(1, 11), lambda k: chr(cast(97 + (e + 17 * k) % 26 as integer))), '') || ((e + 170) % 26 * 31 + 7) % 999 || case when (e + 170) % 26 % 2 = 0 then '@example.com' else '@example.org' end as email,
 lpad(cast((a * 131 + 17) % 1000000000000 as varchar), cast(greatest(length(cast(c_custkey as varchar)), 4) as integer), '0') as account,
 lpad(cast((i * 37 + 19) % 100000000 as varchar), 8, '0') || substr('TRWAGMYFPDXBNJZSQVHLCKE', cast((i * 37 + 19) % 100000000 % 23 + 1 as integer), 1) as national_id,
 'ES' || lpad(cast(98 - cast(bban || '142800' as hugeint) % 97 as varchar), 2, '0') || bban as iban, 'MASKED TEXT' as notes from v""")
def masked_people(spark, d):
    c = t(spark, d, "customer").select("c_custkey", F.col("c_name").alias("name"), F.col("c_custkey").cast("string").alias("phone"), F.col("c_name").alias("email"), F.col("c_custkey").cast("string").alias("account"), F.concat(F.lpad((F.col("c_custkey") * 7919 % 100000000).cast("string"), 8, "0"), F.lit("A")).alias("national_id"), F.concat(F.lit("ES00"), F.lpad(F.col("c_custkey").cast("string"), 20, "0")).alias("iban"), F.col("c_name").alias("notes"))
    return masked(c, {"name": ("NAME", 100), "phone": ("PHONE", None), "email": ("EMAIL", None), "account": ("ACCOUNT", None), "national_id": ("NATIONAL_ID", None), "iban": ("IBAN", None), "notes": ("OTHER", 100)})


@query(f"""with s as (select {_seed('EMAIL', "lower(c_name)")} as e from customer) select count(*) as n, count(*) as different, cast(sum(10 + length(cast(((e + 170) % 26 * 31 + 7) % 999 as varchar)) + 12) as bigint) as characters from s""")
def masked_without_collisions(spark, d):
    """Masked emails of which many are equal, told apart: all different, none longer or shorter."""
    c = without_collisions(masked(t(spark, d, "customer").select("c_custkey", "c_name"), {"c_name": ("EMAIL", None)}), "c_name", "c_custkey")
    return c.agg(F.count("*").alias("n"), F.count_distinct("c_name").alias("different"), F.sum(F.length("c_name")).alias("characters"))


@query("select c_custkey, c_custkey as back, true as inside from customer")
def format_preserving(spark, d):
    c = t(spark, d, "customer").select("c_custkey").repartition("c_custkey").withColumn("e", masks.feistel(F.col("c_custkey"), 10_000_000, "k"))
    return c.select("c_custkey", masks.feistel(F.col("e"), 10_000_000, "k", decrypt=True).alias("back"), F.col("e").between(0, 9_999_999).alias("inside"))


@query("select row_number() over () as number from customer")
def unique_numbers(spark, d):
    return rel.permutation(t(spark, d, "customer"), "c_custkey", 1, "seed").select("number")


@query("""select coalesce(s_suppkey, c_custkey) as k, case when c_custkey is null then cast(s_acctbal as decimal(18,2)) else cast(c_acctbal as decimal(18,2)) end as balance from supplier full join customer on s_suppkey = c_custkey""")
def upserted(spark, d):
    a = t(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), dec("s_acctbal").alias("balance"))
    b = t(spark, d, "customer").select(F.col("c_custkey").alias("k"), dec("c_acctbal").alias("balance"))
    return rel.upsert(a, b, ["k"])


@query("""with a as (select s_suppkey as k, s_nationkey as n, case when s_suppkey % 3 = 0 then null when s_suppkey % 3 = 1 then '' else 'a|b' end as t, 'c' as u from supplier),
 b as (select c_custkey as k, case when c_custkey % 4 = 0 then c_nationkey else coalesce((select s_nationkey from supplier where s_suppkey = c_custkey), 7) end as n, case when c_custkey % 6 < 2 then null when c_custkey % 3 = 1 then '' when c_custkey % 2 = 0 then 'a' else 'a|b' end as t,
 case when c_custkey % 3 = 2 and c_custkey % 2 = 0 then 'b|c' else 'c' end as u from customer)
 select coalesce(a.k, b.k) as k, case when a.k is null then 'INSERT' when b.k is null then 'DELETE' else 'UPDATE' end as action,
 case when a.k is not null then coalesce('''' || a.n || '''', 'NULL') || '|' || coalesce('''' || a.t || '''', 'NULL') || '|' || '''' || a.u || '''' end as old_image,
 case when b.k is not null then coalesce('''' || b.n || '''', 'NULL') || '|' || coalesce('''' || b.t || '''', 'NULL') || '|' || '''' || b.u || '''' end as new_image
 from a full join b on a.k = b.k where a.k is null or b.k is null or a.n is distinct from b.n or a.t is distinct from b.t or a.u is distinct from b.u""")
def change_capture(spark, d):
    a = spark.sql("select s_suppkey as k, s_nationkey as n, case when s_suppkey % 3 = 0 then null when s_suppkey % 3 = 1 then '' else 'a|b' end as t, 'c' as u from {s}", s=t(spark, d, "supplier"))
    b = spark.sql(
        """select c_custkey as k, case when c_custkey % 4 = 0 then c_nationkey else coalesce(s_nationkey, 7) end as n, case when c_custkey % 6 < 2 then null when c_custkey % 3 = 1 then '' when c_custkey % 2 = 0 then 'a' else 'a|b' end as t,
        case when c_custkey % 3 = 2 and c_custkey % 2 = 0 then 'b|c' else 'c' end as u from {c} left join {s} on s_suppkey = c_custkey""",
        s=t(spark, d, "supplier"),
        c=t(spark, d, "customer"),
    )
    return rel.changes(a, b, ["k"])


@query("select distinct p_type as a, p_brand as b from part where lower(p_type) like '%e%' and regexp_matches(p_brand, '^bRAND.*[0-9]$', 'i') and p_size between 5 and 20")
def predicates(spark, d):
    p = t(spark, d, "part")
    return p.where(F.lower("p_type").like("%e%") & dialect.regexp_like(F.col("p_brand"), "^bRAND.*[[:digit:]]$", "i") & F.col("p_size").between(5, 20)).select(F.col("p_type").alias("a"), F.col("p_brand").alias("b")).distinct()


@query("""select event_type, round(stddev_samp(x), 4) as deviation, round(var_samp(x), 2) as variance, round(var_pop(x), 2) as population, min(x) as low, max(x) as high, count(distinct user_id) as users
 from (select event_type, user_id, cast(value * 100 as bigint) as x from events) group by event_type""")
def spread(spark, d):
    e = t(spark, d, "events").select("event_type", "user_id", F.expr("cast(round(value * 100) as bigint)").alias("x"))
    return e.groupBy("event_type").agg(F.round(F.stddev_samp("x"), 4).alias("deviation"), F.round(F.var_samp("x"), 2).alias("variance"), F.round(F.var_pop("x"), 2).alias("population"), F.min("x").alias("low"), F.max("x").alias("high"), F.count_distinct("user_id").alias("users"))


from opsledger import dialect_catalog, graph_catalog, plan_catalog, report_catalog, storage_catalog, subset_catalog, text_catalog, value_catalog  # noqa: E402, F401 they add their queries
