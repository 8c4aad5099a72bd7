"""Queries over masking plans, whose metadata is told from the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsledger.operators import relational as rel
from opsledger.plans import dependencies, masking, precedence
from opsledger.plans.precedence import Target
from opsledger.registry import query, t
from opsledger.shared import stored

# columns of the given tables that hold texts
TEXTS = {"customer": ["c_name", "c_mktsegment"], "supplier": ["s_name"], "part": ["p_name", "p_brand", "p_type"], "nation": ["n_name"], "region": ["r_name"], "orders": ["o_orderstatus", "o_orderpriority"], "lineitem": ["l_returnflag", "l_linestatus"], "events": ["event_type", "props"], "documents": ["text", "lang", "source"]}


def text_columns(spark, d) -> DataFrame:
    """(owner, table, column, rows, longest, different): a row for each of TEXTS, from one pass over each table."""
    out = []
    for name, columns in TEXTS.items():
        told = F.array(*[F.struct(F.lit("shop").alias("owner"), F.lit(name).alias("table"), F.lit(c).alias("column"), F.count("*").alias("rows"), F.max(F.length(c)).alias("length"), F.count_distinct(c).alias("different")) for c in columns])
        out.append(t(spark, d, name).agg(told.alias("r")).select(F.inline("r")))
    return stored(reduce(DataFrame.unionByName, out))  # a row a column


_C = "c as (" + " union all ".join(f"select 'shop' as owner, '{name}' as tab, '{c}' as col, count(*) as rows, max(length({c})) as length, count(distinct {c}) as different from {name}" for name, cs in TEXTS.items() for c in cs) + ")"
# fixed metadata, as an analyst would leave it: identifiers by names and lengths, exceptions by hand
_IDENTIFIER = "case when {col} like '%name' then 'NAME' when {col} like '%type' then 'PHONE' when {len} > 100 then 'FREE_TEXT' when {len} > 9 then 'ADDRESS' else 'OTHER' end"
_X = "select * from (values ('shop', 'part', 'p_brand', 'FORCE', 'ACCOUNT', 'Y'), ('shop', 'orders', 'o_orderpriority', 'EXCLUDE', null, 'Y'), ('shop', 'orders', 'o_orderstatus', 'EXCLUDE', null, 'Y'), ('shop', 'customer', 'c_name', 'EXCLUDE', null, 'N'), ('shop', 'region', 'r_name', 'EXCLUDE', null, 'Y'), ('shop', 'none', 'nowhere', 'FORCE', 'NAME', 'Y')) as x(owner, tab, col, action, forced_identifier, active)"


def _named(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"tab": "table", "col": "column"})


def _metadata(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Columns, their history (masked if there are several values, current if the table has over a hundred rows), and exceptions."""
    c = text_columns(spark, d)
    identifier = F.expr(_IDENTIFIER.format(col="column", len="length"))
    h = c.select(*masking.KEY, identifier.alias("identifier"), F.when(F.col("different") > 3, "Y").otherwise("N").alias("mask"), F.when(F.col("rows") > 100, "Y").otherwise("N").alias("current"), "length")
    return c, h, _named(spark.sql(_X))


_H = f"h as (select owner, tab, col, {_IDENTIFIER.format(col='col', len='length')} as identifier, different > 3 as mask, rows > 100 as current, length from c)"
_SHOWN = 'owner, tab as "table", col as "column", identifier'
_SIZE = "case when identifier like '%ACCOUNT%' then 10 when identifier like '%PHONE%' then 7 when identifier like '%NAME%' then 2 when identifier like '%ADDRESS%' then 3 else 1 end"


@query(f"""with {_C}, {_H}, x as ({_X}), chosen as (select owner, tab, col, identifier from h where mask and current), f as (select * from chosen union all select x.owner, x.tab, x.col, forced_identifier from x join c using (owner, tab, col) where active = 'Y' and action = 'FORCE' and (x.owner, x.tab, x.col) not in (select owner, tab, col from chosen)),
 kept as (select f.*, length from f join h using (owner, tab, col) where (f.owner, f.tab, f.col) not in (select owner, tab, col from x where active = 'Y' and action = 'EXCLUDE'))
 select {_SHOWN.replace('identifier', 'kept.identifier')} from kept where length >= {_SIZE.replace('identifier', 'kept.identifier')}""")
def mask_plan(spark, d):
    """Columns to mask: the current history, with exceptions, without what is too short for its mask."""
    c, h, x = _metadata(spark, d)
    known = x.join(c.select(*masking.KEY), masking.KEY, "left_semi").unionByName(x.where("action = 'EXCLUDE'")).distinct()
    chosen = masking.select_columns(h, h.limit(0), known).join(h.select(*masking.KEY, "length"), masking.KEY)
    return masking.long_enough(chosen).drop("length")


@query(f"""with {_C}, {_H}, x as ({_X}), f as (select owner, tab, col, identifier, 1 as run from h where mask union all select x.owner, x.tab, x.col, forced_identifier, 1 from x join c using (owner, tab, col) where active = 'Y' and action = 'FORCE' and (x.owner, x.tab, x.col) not in (select owner, tab, col from h where mask)),
 k as (select * from f where (owner, tab, col) not in (select owner, tab, col from x where active = 'Y' and action = 'EXCLUDE'))
 select 'first' as run, {_SHOWN} from k where not (tab in ('part', 'documents')) union all select 'again', {_SHOWN} from k""")
def mask_plan_of_final_list(spark, d):
    """Without a current history the final list holds; what has been applied is left out, unless all is done again."""
    c, h, x = _metadata(spark, d)
    old, known = h.withColumn("current", F.lit("N")), x.join(c.select(*masking.KEY), masking.KEY, "left_semi")
    applied = c.where("table in ('part', 'documents')").select(*masking.KEY)
    runs = [masking.select_columns(old, h, known, applied, again).select(F.lit(n).alias("run"), *masking.KEY, "identifier") for n, again in (("first", False), ("again", True))]
    return runs[0].unionByName(runs[1])


@query(f"""with {_C}, x as ({_X}), s as (select owner, tab, col, 'EXCLUDE' as action, cast(null as varchar) as forced_identifier, 'Y' as active from c where different <= 3 or tab = 'part')
 select owner, tab as "table", col as "column", coalesce(s.action, x.action) as action, coalesce(s.forced_identifier, x.forced_identifier) as forced_identifier, coalesce(s.active, x.active) as active from x full join s using (owner, tab, col)""")
def exception_upsert(spark, d):
    """Columns of few values are excluded: known exceptions change, but keep their forced identifier."""
    c, _, x = _metadata(spark, d)
    new = c.where("different <= 3 or table = 'part'").select(*masking.KEY, F.lit("EXCLUDE").alias("action"), F.lit(None).cast("string").alias("forced_identifier"), F.lit("Y").alias("active"))
    return rel.upsert(x, new, masking.KEY, ["forced_identifier"])


@query(f"""with {_C}, x as ({_X}) select tab as "table", count(*) as columns, cast(max(rows) as bigint) as rows from c left join (select owner, tab, col, 1 as hit from x where active = 'Y' and action = 'EXCLUDE') x using (owner, tab, col) group by owner, tab having count(*) = sum(case when hit = 1 then 1 else 0 end)""")
def skipped_tables(spark, d):
    """Tables of which all text columns are excluded, with their size."""
    c, _, x = _metadata(spark, d)
    size = c.groupBy("owner", "table").agg(F.count("*").alias("columns"), F.max("rows").alias("rows"))
    return masking.fully_excluded(c.select(*masking.KEY), x).join(size, ["owner", "table"]).select("table", "columns", "rows")


@query(f"""with {_C}, x as ({_X}), hits as (select c.*, x.tab is not null as hit from c left join (select * from x where active = 'Y' and action = 'EXCLUDE') x using (owner, tab, col)), q as (select *, bool_and(hit) over (partition by tab) as all_out from hits)
 select tab as "table", col as "column", case when all_out then 'SKIP_TABLE' else 'MASK' end as state from q where tab = 'orders' or (tab in ('part', 'events') and col in ('p_name', 'props'))""")
def selective_columns(spark, d):
    """Tables and columns named in lists, all columns of a table where none are; a table is skipped if all its text columns are excluded."""
    c, _, x = _metadata(spark, d)
    return masking.selected(c.select(*masking.KEY), x, "orders, part,EVENTS", {"part": "p_name", "events": " PROPS "})


TARGETS = [
    Target("a", "customer", "c_name", "NAME", length=25, action=" exclude "),
    Target("a", "customer", "c_mktsegment", "PHONE", length=5),
    Target("b", "customer", "c_mktsegment", "PHONE", length=5, forced="NAME"),
    Target("a", "customer", "code", "ACCOUNT", length=12),
    Target("b", "customer", "code", "ACCOUNT", kind="NUMBER", length=12),
    Target("a", "orders", "o_orderpriority", "OTHER", length=15, rules=("KEEP_ENDS", "DOC_BY_TYPE")),
    Target("a", "part", "p_brand", "NAME", length=18, rules=("IBAN", "KEEP_ENDS")),
    Target("a", "events", "event_type", "IBAN", length=34, rules=("IBAN",)),
    Target("b", "nation", "n_name", "NAME", length=25),
    Target("a", "part", "p_name", "NAME", length=8, rules=("KEEP_ENDS",)),
    Target("a", "pages", "html", "FREE_TEXT", length=32000),
    Target("a", "documents", "text", "FREE_TEXT", length=99999),
    Target("b", "documents", "text", "NAME", length=400),
    Target("c", "documents", "text", "EMAIL", length=30),
    Target("d", "documents", "text", "ADDRESS", length=60),
    Target("e", "documents", "text", "PHONE", length=9),
    Target("f", "documents", "text", "FREE_TEXT", kind="CLOB"),
]


def _targets(spark, d) -> dict[str, DataFrame]:
    tables = {n: t(spark, d, n) for n in sorted({x.table for x in TARGETS})}
    tables["customer"] = tables["customer"].withColumn("code", F.col("c_custkey").cast("string"))
    return tables


_P = """select '{o}' as owner, '{t}' as tab, '{c}' as col, '{i}' as identifier, '{s}' as step, count({c}) as filled, count(distinct {c}) as different, max(length({c})) as longest from {f}"""


def _precedence_sql() -> str:
    """Steps by hand, as the order of rules has them; fallbacks from the data."""
    steps = ["SKIP_EXCLUDE", "SKIP_AUTO_LEN", "GENERIC", "GENERIC", "GENERIC", "BY_TYPE", "KEEP_ENDS", "IBAN", "GENERIC", "KEEP_ENDS", *["GENERIC"] * 7]
    code = "(select *, cast(c_custkey as varchar) as code from customer)"
    rows = " union all ".join(_P.format(o=x.owner, t=x.table, c=x.column, i=x.final, s=s, f=code if x.table == "customer" else x.table) for x, s in zip(TARGETS, steps, strict=True))
    account = "lpad(cast(((('0x' || substr(md5('ACCOUNT|' || code), 1, 7))::bigint % 2147483646 + 1) * 131 + 17) % 1000000000000 as varchar), cast(greatest(length(code), 4) as integer), '0')"
    return f"""with p as ({rows}), m as (select count(distinct {account}) as n from {code} q)
 select owner, tab, col, identifier, step, filled, different, cast(longest as integer) as longest, case when step like 'SKIP%' then null when longest > 4000 and owner = 'f' then 'SKIP_BUFFER'
 when longest > 32767 then case identifier when 'NAME' then 'CIPHER_LETTERS' when 'ADDRESS' then 'TEMPLATE_ADDRESS' when 'EMAIL' then 'TEMPLATE_EMAIL' when 'PHONE' then 'TEMPLATE_PHONE' else 'CIPHER' end when longest > 4000 then 'DISPATCHER'
 when col = 'p_name' and longest > 8 then 'SKIP_TOO_LONG' when col = 'code' and m.n < different then case when owner = 'a' then 'COLLISION' else 'SKIP_COLLISION' end end as fallback from p, m"""


@query(_precedence_sql())
def rule_precedence(spark, d):
    """What masks each column, by the order of its rules and by what its values are like."""
    return precedence.decided(_targets(spark, d), TARGETS).select("owner", "tab", "col", "identifier", "step", "filled", "different", "longest", "fallback")


@query("""with t as (select count(*) as n, max(length(text)) as longest from documents) select doc_id, case when longest > 32767 then substr(translate(upper(replace(text, 'ß', 'ss')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'QWERTYUIOPASDFGHJKLZXCVBNM'), 1, 400) end as text from documents, t where longest > 32767""")
def masked_by_fallback(spark, d):
    """Texts too long for their mask, by the cipher that is left; nothing where none is that long."""
    docs, target = t(spark, d, "documents").select("doc_id", "text"), [x for x in TARGETS if x.owner == "b" and x.table == "documents"]
    told = precedence.decided({"documents": docs}, target)
    if told.first()["fallback"] != "CIPHER_LETTERS":
        return docs.limit(0)
    return precedence.applied(docs, target, "doc_id", told)


RULES = [("region.r_name", "nation.n_name", "r_regionkey", "n_regionkey"), ("nation.n_name", "customer.c_mktsegment", "n_nationkey", "c_nationkey"), ("customer.c_mktsegment", "orders.o_orderpriority", "c_custkey", "o_custkey"), ("nation.n_name", "supplier.s_name", "n_nationkey", "s_nationkey"), ("part.p_name", "part.p_brand", "p_partkey", "p_partkey"), ("part.p_brand", "part.p_name", "p_partkey", "p_partkey"), ("part.p_brand", "part.p_type", "p_partkey", "p_partkey"), ("customer.c_name", "orders.o_orderstatus", "c_custkey", "o_custkey")]


def _rules(spark) -> DataFrame:
    return spark.createDataFrame(RULES, "parent string, child string, src_key string, dst_key string")


@query("""with o as (select o_orderkey, r_name as o_orderpriority, o_orderstatus from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey) select * from o""")
def synced_in_levels(spark, d):
    """A region's name goes down over nations and customers to orders, level by level; a status is too short for a customer's name."""
    tables = {n: t(spark, d, n) for n in ("region", "nation", "customer", "orders", "supplier", "part")}
    out, _ = dependencies.synced_in_order(tables, _rules(spark), {"orders.o_orderstatus": 1})
    return out["orders"].select("o_orderkey", "o_orderpriority", "o_orderstatus")


@query("""with n as (select count(*) as n from part) select * from (values ('region.r_name', 'nation.n_name', 1, 'SYNCED', 0), ('nation.n_name', 'customer.c_mktsegment', 2, 'SYNCED', 0), ('nation.n_name', 'supplier.s_name', 2, 'SYNCED', 0), ('customer.c_mktsegment', 'orders.o_orderpriority', 3, 'SYNCED', 0),
 ('part.p_name', 'part.p_brand', null, 'CYCLE', null), ('part.p_brand', 'part.p_name', null, 'CYCLE', null), ('part.p_brand', 'part.p_type', null, 'CYCLE', null)) as v(parent, child, level, state, differing) union all select 'customer.c_name', 'orders.o_orderstatus', 1, 'SKIPPED_LENGTH', (select count(*) from orders join customer on c_custkey = o_custkey where o_orderstatus <> c_name)""")
def sync_outcomes(spark, d):
    tables = {n: t(spark, d, n) for n in ("region", "nation", "customer", "orders", "supplier", "part")}
    _, told = dependencies.synced_in_order(tables, _rules(spark), {"orders.o_orderstatus": 1})
    return spark.createDataFrame(told, "parent string, child string, level int, state string, differing long")


FOREIGN = [("nation", "n_regionkey", "region", "r_regionkey"), ("customer", "c_nationkey", "nation", "n_nationkey"), ("supplier", "s_nationkey", "nation", "n_nationkey"), ("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"), ("lineitem", "l_suppkey", "supplier", "s_suppkey")]


def foreign_keys(spark, d) -> DataFrame:
    """(child, child_key, parent, parent_key, rows, orphans) of FOREIGN, counted in the tables."""
    out = []
    for child, ck, parent, pk in FOREIGN:
        up = t(spark, d, parent).select(F.col(pk).alias("k")).distinct().withColumn("hit", F.lit(1))
        met = t(spark, d, child).groupBy(F.col(ck).alias("c")).agg(F.count("*").alias("n")).join(up, F.col("c") == F.col("k"), "left")
        out.append(met.agg(*[F.lit(v).alias(n) for n, v in (("child", child), ("child_key", ck), ("parent", parent), ("parent_key", pk))], F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(F.col("hit").isNull() & F.col("c").isNotNull(), F.col("n"))), F.lit(0)).alias("orphans")))
    return reduce(DataFrame.unionByName, out)


_F = "f as (" + " union all ".join(f"select '{c}' as child, '{ck}' as child_key, '{p}' as parent, '{pk}' as parent_key, count(*) as rows, count(*) filter ({ck} is not null and {ck} not in (select {pk} from {p})) as orphans from {c}" for c, ck, p, pk in FOREIGN) + ")"


@query(f"""with {_F} select 'nation' as tab, 'parent' as side, parent as other, rows, 'alter table ' || child || ' enable ' || case when orphans = 0 then '' else 'novalidate ' end || 'constraint fk_' || child || '_' || parent || ';' as statement from f where child = 'nation'
 union all select 'nation', 'child', child, rows, 'alter table ' || child || ' enable ' || case when orphans = 0 then '' else 'novalidate ' end || 'constraint fk_' || child || '_' || parent || ';' from f where parent = 'nation'""")
def key_statements(spark, d):
    """Both sides of a table's foreign keys, and a statement for each, which validates only what holds in the data."""
    f = foreign_keys(spark, d)
    text = F.concat(F.lit("alter table "), "child", F.lit(" enable "), F.when(F.col("orphans") == 0, "").otherwise("novalidate "), F.lit("constraint fk_"), "child", F.lit("_"), "parent", F.lit(";"))
    side = lambda own, other: f.where(F.col(own) == "nation").select(F.lit("nation").alias("tab"), F.lit(other).alias("side"), F.col(other).alias("other"), "rows", text.alias("statement"))
    return side("child", "parent").unionByName(side("parent", "child"))


@query(f"""with {_F}, i as (select * from (values ('orders', 'o_custkey,o_orderdate'), ('lineitem', 'l_orderkey,l_linenumber'), ('lineitem', 'l_supp%'), ('supplier', 's_suppkey,s_nationkey')) as v(tab, cols))
 select f.child, f.child_key, f.parent, f.rows from f left join i on i.tab = f.child and i.cols like replace(f.child_key, '_', '!_') || '%' escape '!' where i.tab is null""")
def unindexed_keys(spark, d):
    """Foreign keys that no index starts with, and the rows that a look-up of each would read."""
    i = spark.createDataFrame([("orders", "o_custkey,o_orderdate"), ("lineitem", "l_orderkey,l_linenumber"), ("lineitem", "l_supp%"), ("supplier", "s_suppkey,s_nationkey")], "tab string, cols string")
    f = foreign_keys(spark, d)
    starts = F.expr("cols like concat(replace(child_key, '_', '!_'), '%') escape '!'")
    return f.join(F.broadcast(i), (F.col("tab") == F.col("child")) & starts, "left_anti").select("child", "child_key", "parent", "rows")


@query(f"""with {_F} select 'FK' as kind, 'SHOP' as owner, upper('fk_' || parent) as object, min(child) as "table", 2 as turn, 'INTEGRITY' as usage, 'DISABLE' as before, case when parent = 'orders' then 'DROP' else 'ENABLE_NOVALIDATE' end as after from f group by parent
 union all select 'TRIGGER', 'SHOP', upper('trg_' || child), child, 1, case when max(rows) > 1000 then 'HEAVY' else 'OPERATION' end, 'DISABLE', 'ENABLE' from f group by child union all select 'P', 'SHOP', upper('pk_' || parent), parent, 2, 'INTEGRITY', 'REPORT', 'REVIEW' from f group by parent union all select 'VIEW', 'SHOP', upper('v_' || child), child, 2, 'OPERATION', 'REPORT', 'NONE' from f group by child""")
def dependency_policies(spark, d):
    """Each constraint, trigger and view of the tables once, with what to do about it; some have instructions of their own."""
    f = foreign_keys(spark, d)
    none = F.lit(None).cast("string")
    made = lambda kind, name, by, **own: f.groupBy("child", "parent").agg(F.max("rows").alias("rows")).select(F.lit(kind).alias("kind"), F.lit(" shop").alias("owner"), F.concat(F.lit(name), by).alias("object"), F.col("child" if by == "child" or kind == "fk" else "parent").alias("table"), *[own.get(c, none).alias(c) for c in ("usage", "before", "after")])
    heavy = f.groupBy("child").agg(F.max("rows").alias("most"))
    triggers = made("Trigger ", "trg_", "child").join(heavy.withColumnRenamed("child", "table"), "table").withColumn("usage", F.when(F.col("most") > 1000, "heavy")).drop("most")
    found = made("fk", "fk_", "parent", after=F.when(F.col("parent") == "orders", "drop")).unionByName(triggers).unionByName(made("P", "pk_", "parent")).unionByName(made("view", "v_", "child"))
    return dependencies.policies(found)
