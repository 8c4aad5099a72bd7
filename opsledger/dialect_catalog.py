"""Queries over dialect functions, masks, plans and mapping tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from opsledger.functions import dialect, masks, rules
from opsledger.plans import masking
from opsledger.registry import query, t


@query("""select p_partkey, upper(p_name) as up, lpad(p_name, 20, '*') as l, rpad(p_name, 20, '*') as r, substr(p_name, 3, 4) as mid, substr(p_name, -3) as tail, replace(p_name, 'a', 'A') as rep,
 translate(p_name, 'aeiou', '12345') as tr, cast(instr(p_name, 'e') as bigint) as at, cast(ascii(p_name) as bigint) as code, cast(length(p_name) as bigint) as n,
 cast(case when instr(p_name, 'e') = 0 or instr(substr(p_name, instr(p_name, 'e') + 1), 'e') = 0 then 0 else instr(p_name, 'e') + instr(substr(p_name, instr(p_name, 'e') + 1), 'e') end as bigint) as second_e from part""")
def string_functions(spark, d):
    x = F.col("p_name")
    return t(spark, d, "part").select(
        "p_partkey", F.upper(x).alias("up"), F.lpad(x, 20, "*").alias("l"), F.rpad(x, 20, "*").alias("r"), F.substring(x, 3, 4).alias("mid"), F.substring(x, -3, 3).alias("tail"), F.replace(x, F.lit("a"), F.lit("A")).alias("rep"),
        F.translate(x, "aeiou", "12345").alias("tr"), dialect.instr(x, "e").cast("long").alias("at"), F.ascii(x).cast("long").alias("code"), F.length(x).cast("long").alias("n"), dialect.instr(x, "e", 1, 2).cast("long").alias("second_e"),
    )


@query("""select o_orderkey, cast(last_day(o_orderdate) as date) as month_end, cast(date_trunc('month', o_orderdate) as date) as month_start,
 cast(case when cast(o_orderdate as date) = last_day(o_orderdate) then last_day(cast(o_orderdate as date) + interval 1 month) else cast(o_orderdate as date) + interval 1 month end as date) as next_month,
 strftime(o_orderdate, '%Y-%m-%d %H:%M') as shown, cast(date_diff('day', timestamp '1990-01-01', o_orderdate) as bigint) as days, cast(extract(year from o_orderdate) as bigint) as y from orders""")
def date_functions(spark, d):
    x = F.col("o_orderdate").cast("timestamp")
    return t(spark, d, "orders").select(
        "o_orderkey", F.last_day(x).alias("month_end"), F.trunc(x, "month").alias("month_start"), F.to_date(dialect.add_months(x, 1)).alias("next_month"), dialect.to_char(x, "YYYY-MM-DD HH24:MI").alias("shown"),
        F.floor(dialect.days_between(x, F.lit("1990-01-01 00:00:00").cast("timestamp"))).alias("days"), F.year(x).cast("long").alias("y"),
    )


@query("""select p_partkey, cast(p_size % 7 as bigint) as m, cast(abs(p_size - 25) as bigint) as a, cast(sign(p_size - 25) as bigint) as s, cast(ceil(p_retailprice / 7) as bigint) as c, cast(floor(p_retailprice / 7) as bigint) as f,
 cast(p_size & 12 as bigint) as b, cast(p_size | 3 as bigint) as o, cast(round(sqrt(p_size) * 1000) as bigint) as q, cast(round(power(p_size, 2)) as bigint) as p, round(ln(p_size + 1), 6) as l from part""")
def math_functions(spark, d):
    n = F.col("p_size")
    return t(spark, d, "part").select(
        "p_partkey", (n % 7).cast("long").alias("m"), F.abs(n - 25).cast("long").alias("a"), F.sign(n - 25).cast("long").alias("s"), F.ceil(F.col("p_retailprice") / 7).alias("c"), F.floor(F.col("p_retailprice") / 7).alias("f"),
        n.bitwiseAND(F.lit(12)).cast("long").alias("b"), n.bitwiseOR(F.lit(3)).cast("long").alias("o"), F.round(F.sqrt(n) * 1000).cast("long").alias("q"), F.round(F.pow(n, F.lit(2))).cast("long").alias("p"), F.round(F.log(n + 1), 6).alias("l"),
    )


@query("""select c_custkey, c_name || coalesce(x, '') as joined, case when x is null then null else greatest(c_nationkey, length(x)) end as g, coalesce(x, 'none') as v, case when x is not null then 'set' else 'unset' end as w
 from (select c_custkey, c_name, c_nationkey, case when c_mktsegment = 'BUILDING' then null else nullif(c_mktsegment, 'MACHINERY') end as x from customer)""")
def null_semantics(spark, d):
    x = F.when(F.col("c_mktsegment") != "BUILDING", F.nullif("c_mktsegment", F.lit("MACHINERY")))
    return t(spark, d, "customer").withColumn("x", x).select("c_custkey", dialect.concat(F.col("c_name"), F.col("x")).alias("joined"), dialect.greatest(F.col("c_nationkey"), F.length("x")).cast("long").alias("g"), F.nvl("x", F.lit("none")).alias("v"), F.nvl2("x", F.lit("set"), F.lit("unset")).alias("w"))


@query("""select p_partkey, case when p_retailprice * 2048 >= 1048576 then round(p_retailprice * 2048 / 1048576, 1) || ' MB' else round(p_retailprice * 2048 / 1024, 1) || ' KB' end as shown from part""")
def humanized(spark, d):
    return t(spark, d, "part").select("p_partkey", dialect.humanize(F.col("p_retailprice") * 2048).alias("shown"))


@query("""with s as (select c_custkey, ('0x' || substr(md5('ADDRESS|' || upper(c_name)), 1, 7))::bigint % 2147483646 + 1 as s from customer)
 select c_custkey, ['TERRACE', 'LANE', 'WHARF', 'CRESCENT'][s % 4 + 1] || ' ' || ['ELM', 'OAK', 'RIVER', 'HILL', 'GARDEN', 'STATION', 'MARKET', 'BRIDGE'][(s // 4) % 8 + 1] || ' N ' || ((s // 17) % 999 + 1) || ', '
 || ['NORTHFIELD', 'SOUTHPORT', 'EASTON', 'WESTBURY', 'LAKEVIEW', 'STONEHAM', 'GREENDALE', 'FAIRHAVEN'][(s // 11) % 8 + 1] as address from s""")
def masked_addresses(spark, d):
    return t(spark, d, "customer").select("c_custkey", masks.address(F.col("c_name")).alias("address"))


# values of all the shapes that the masks tell apart, in words that both engines read
SHAPES = """select cast(c_custkey as bigint) as k, case cast(c_custkey as bigint) % 8 when 0 then lpad(cast(cast(c_custkey as bigint) * 7919 % 100000000 as varchar(8)), 8, '0') || 'a'
 when 1 then ' ' || substr('xYZ', cast(cast(c_custkey as bigint) % 3 as int) + 1, 1) || lpad(cast(cast(c_custkey as bigint) * 104729 % 10000000 as varchar(7)), 7, '0') || 'k '
 when 2 then 'B' || lpad(cast(c_custkey as varchar(8)), 8, '0') when 3 then '   ' when 4 then null when 5 then 'es' || lpad(cast(c_custkey as varchar(9)), 22, '1')
 when 6 then 'no digits: ' || c_mktsegment else 'ES ' || cast(c_custkey as varchar(9)) || '-' || c_name || ' 00 11 22 33 44 55 66' end as x, case when c_custkey % 5 = 0 then null else c_nationkey % 4 end as kind from {customer}"""


def _shapes(spark, d):
    return spark.sql(SHAPES, customer=t(spark, d, "customer"))


def _with_shapes(more: str) -> str:
    return f"with v as ({SHAPES.format(customer='customer')}), {more}"


def _seed(salt: str, x: str) -> str:
    return f"(('0x' || substr(md5('{salt}|' || {x}), 1, 7))::bigint % 2147483646 + 1)"


NUMBER = "lpad(cast(({s} * 37 + 19) % 100000000 as varchar), 8, '0') || substr('TRWAGMYFPDXBNJZSQVHLCKE', cast(({s} * 37 + 19) % 100000000 % 23 + 1 as integer), 1)"
FOREIGN = "['X', 'Y', 'Z'][{s} % 3 + 1] || lpad(cast(({s} * 41 + 23) % 10000000 as varchar), 7, '0') || substr('TRWAGMYFPDXBNJZSQVHLCKE', cast(cast(({s} % 3) || lpad(cast(({s} * 41 + 23) % 10000000 as varchar), 7, '0') as bigint) % 23 + 1 as integer), 1)"


@query(_with_shapes(f"""u as (select k, nullif(upper(trim(substr(x, 1, 50))), '') as u from v), s as (select k, u, {_seed("ID", "u")} as s from u),
 c as (select *, substr('ABCDEFGHJKLMNPQRSUVW', cast(s % 20 + 1 as integer), 1) as kind, lpad(cast((s * 43 + 29) % 10000000 as varchar), 7, '0') as n from s),
 d as (select *, list_transform(range(1, 8), lambda i: cast(substr(n, i, 1) as integer) * (1 + i % 2)) as parts from c), e as (select *, (10 - list_sum(list_transform(parts, lambda p: p // 10 + p % 10)) % 10) % 10 as control from d)
 select k, case when u is null then null when regexp_full_match(u, '[0-9]{{8}}[A-Z]') then {NUMBER.format(s='s')} when regexp_full_match(u, '[XYZ][0-9]{{7}}[A-Z]') then {FOREIGN.format(s='s')}
 else kind || n || case when kind in ('K', 'P', 'Q', 'S', 'N', 'W') or (kind not in ('A', 'B', 'E', 'H') and control % 2 = 1) then substr('JABCDEFGHI', cast(control + 1 as integer), 1) else cast(cast(control as integer) as varchar) end end as id from e"""))
def masked_ids(spark, d):
    return _shapes(spark, d).select("k", masks.national_id(F.col("x")).alias("id"))


@query(_with_shapes(f"""s as (select k, kind, nullif(upper(trim(x)), '') as u from v), z as (select *, {_seed("DOC", "(u || '|' || coalesce(cast(kind as varchar), '-1'))")} as s from s)
 select k, case when u is null then null when kind = 1 then {NUMBER.format(s='s')} when kind = 3 then {FOREIGN.format(s='s')} else regexp_replace(u, '[0-9]', '9', 'g') end as doc from z"""))
def masked_documents(spark, d):
    return _shapes(spark, d).select("k", masks.document(F.col("x"), F.col("kind")).alias("doc"))


@query(_with_shapes(f"""a as (select k, x, regexp_replace(substr(x, 1, 200), '[^0-9]', '', 'g') as digits, upper(trim(substr(x, 1, 50))) as u from v),
 s as (select *, least(greatest(case when digits = '' then length(x) else length(digits) end, 4), 20) as size, cast(({_seed("ACCOUNT", "digits")} * 131 + 17) % 1000000000000 as varchar) as n, lpad(cast(({_seed("IBAN", "u")} * 137 + 31) % 1000000000000 as varchar), 20, '0') as bban from a),
 i as (select *, 'ES' || lpad(cast(98 - cast(bban || '142800' as hugeint) % 97 as varchar), 2, '0') || bban as full_iban, length(replace(u, ' ', '')) as wide from s),
 b as (select k, u, case when x is null then null else lpad(n, cast(size as integer), '0') end as account, case when x is null then null when wide > 0 and wide < 24 then substr(full_iban, 1, wide) else full_iban end as iban from i)
 select k, account, iban, case when regexp_full_match(u, 'ES[0-9]{{22}}') then iban else account end as bank from b"""))
def masked_accounts(spark, d):
    x = F.col("x")
    return _shapes(spark, d).select("k", masks.account(x).alias("account"), masks.iban(x).alias("iban"), masks.mask("MY_BANK_COLUMN", x).alias("bank"))


@query(_with_shapes(f"""s as (select k, x, {_seed("EMAIL", "lower(trim(x))")} as e, {_seed("PHONE", "regexp_replace(x, '[^0-9]', '', 'g')")} as p from v),
 r as (select k, x, p, list_transform(range(1, 11), lambda i: (e + 17 * i) % 26) as steps from s)
 select k, array_to_string(list_transform(steps, lambda v: chr(cast(97 + v as integer))), '') || (steps[10] * 31 + 7) % 999 || case when steps[10] % 2 = 0 then '@example.com' else '@example.org' end as email,
 case when x is null then null else ['6', '7', '8', '9'][p % 4 + 1] || lpad(cast((p * 97 + 13) % 100000000 as varchar), 8, '0') end as phone from r"""))
def masked_contacts(spark, d):
    return _shapes(spark, d).select("k", masks.email(F.col("x")).alias("email"), masks.phone(F.col("x")).alias("phone"))


@query("with recursive " + _with_shapes(f"""s as (select k, nullif(upper(trim(x)), '') as u from v), r as (select k, u, 2 as i, {_seed("ENDS", "u")} as s, '' as mid from s where length(u) > 2
 union all select k, u, i + 1, case when regexp_full_match(c, '[0-9]') then (s * 29 + 7) % 10 when regexp_full_match(c, '[A-Z]') then (s * 131 + 17) % 26 else s end,
 mid || case when regexp_full_match(c, '[0-9]') then cast((s * 29 + 7) % 10 as varchar) when regexp_full_match(c, '[A-Z]') then chr(cast(65 + (s * 131 + 17) % 26 as integer)) else c end from (select *, substr(u, i, 1) as c from r where i < length(u)) q)
 select k, case when u is null or length(u) <= 2 then u end as ends from s where u is null or length(u) <= 2 union all select k, left(u, 1) || mid || right(u, 1) from r where i = length(u)""").removeprefix("with "))
def masked_middles(spark, d):
    return _shapes(spark, d).select("k", masks.keep_ends(F.col("x")).alias("ends"))


@query("""with m as (select o_orderkey, o_custkey, o_orderpriority from orders), b as (select c_custkey, c_name from customer)
 select o_orderkey, case when length(c_name) <= 20 and c_custkey is not null then c_name else o_orderpriority end as label from m left join b on c_custkey = o_custkey""")
def post_sync(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_orderpriority").alias("label"))
    c = t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return masking.synced(o, c, ["o_custkey"], "label", "c_name", 20).select("o_orderkey", "label")


@query("""select c_mktsegment as orig_val, 'M' || substr(md5(c_mktsegment), 1, 8) as new_val, min(c_custkey) as row_id from customer where c_mktsegment is not null group by c_mktsegment union all select null, null, null""")
def mapping_table(spark, d):
    return rules.mapping_with_rows(t(spark, d, "customer"), "c_mktsegment", F.concat(F.lit("M"), F.substring(F.md5("c_mktsegment"), 1, 8)), "c_custkey")


@query("""with m as (select c_mktsegment as orig, min(c_custkey) as rid, 'M' || substr(md5(c_mktsegment), 1, 8) as v from customer group by c_mktsegment)
 select c_custkey, m.v as c_mktsegment from customer left join m on m.orig = c_mktsegment""")
def remap_fallback(spark, d):
    c = t(spark, d, "customer")
    return rules.remapped(c, mapping_table(spark, d), "c_mktsegment", "c_custkey").select("c_custkey", "c_mktsegment")


@query("""select doc_id, regexp_replace(regexp_replace(text, '[0-9]{4,}', '####', 'g'), '[A-Za-z0-9._]+@[A-Za-z0-9.]+', 'MAIL', 'g') as text from documents""")
def regex_rules(spark, d):
    return t(spark, d, "documents").select("doc_id", rules.by_rules(F.col("text"), [("[0-9]{4,}", "####"), ("[A-Za-z0-9._]+@[A-Za-z0-9.]+", "MAIL")]).alias("text"))


@query("""select c_custkey, null as c_name, 'FIXED' as c_mktsegment, cast(7 as integer) as c_nationkey, replace(replace(c_name, 'Customer', 'test'), '#', '-') as scrubbed from customer""")
def column_rules(spark, d):
    c = t(spark, d, "customer").withColumn("scrubbed", rules.scrubbed(F.col("c_name"), [("Customer", "test"), ("#", "-")]))
    return rules.fixed(c, {"c_name": None, "c_mktsegment": "FIXED", "c_nationkey": 7}).select("c_custkey", "c_name", "c_mktsegment", "c_nationkey", "scrubbed")


@query("select o_orderkey, o_orderdate as back, true as inside from orders")
def date_round_trip(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("x"))
    e = o.withColumn("e", rules.date_fpe(F.col("x"), "1990-01-01", "2010-01-01", "k"))
    back = rules.date_fpe(F.col("e"), "1990-01-01", "2010-01-01", "k", decrypt=True).cast("timestamp_ntz")
    return e.select("o_orderkey", back.alias("back"), F.col("e").between("1990-01-01", "2010-01-01").alias("inside"))


@query("select c_custkey, 'AB' || lpad(cast(c_custkey % 100000 as varchar), 5, '0') as back from customer")
def text_round_trip(spark, d):
    x = F.concat(F.lit("AB"), F.lpad((F.col("c_custkey") % 100000).cast("string"), 5, "0"))
    form = ["ABCDEFGHIJKLMNOPQRSTUVWXYZ"] * 2 + ["0123456789"] * 5
    c = t(spark, d, "customer").select("c_custkey").repartition("c_custkey")  # a file of few bytes may be one task
    e = c.select("c_custkey", rules.text_fpe(x, form, "k").alias("e"))
    return e.select("c_custkey", rules.text_fpe(F.col("e"), form, "k", decrypt=True).alias("back"))


@query("""select p_partkey, case when p_brand = 'Brand#11' then 'eleven' when p_brand = 'Brand#12' then 'twelve' else 'other' end as decoded, case when x is null then 'none' when x = 5 then 'five' end as from_null,
 ltrim(p_name, 'abcde') as l, rtrim(p_name, 'xyzst') as r, coalesce(regexp_extract_all(p_name, '[a-z]+')[2], null) as second_word, regexp_extract_all(p_brand, '[0-9]+')[1] as digits, chr(cast(65 + p_partkey % 26 as integer)) as letter,
 lower(to_hex(p_partkey)) as hexed, cast(octet_length(encode(p_name)) as bigint) as bytes, cast(length(p_name) - length(regexp_replace(p_name, '^(.*)e[^e]*$', '\\1')) as bigint) as from_end
 from (select *, nullif(p_size % 7, 0) as x from part) p""")
def more_string_functions(spark, d):
    x = F.col("p_name")
    back = dialect.instr(x, "e", -1)
    return t(spark, d, "part").select(
        "p_partkey", dialect.decode(F.col("p_brand"), "Brand#11", "eleven", "Brand#12", "twelve", default="other").alias("decoded"), dialect.decode(F.nullif(F.col("p_size") % 7, F.lit(0)), None, "none", 5, "five").alias("from_null"),
        dialect.ltrim(x, "abcde").alias("l"), dialect.rtrim(x, "xyzst").alias("r"), dialect.regexp_substr(x, "[[:lower:]]+", 2).alias("second_word"), dialect.regexp_substr(F.col("p_brand"), "[[:digit:]]+").alias("digits"),
        F.char(65 + F.col("p_partkey") % 26).alias("letter"), dialect.to_hex(F.col("p_partkey")).alias("hexed"), F.octet_length(x).cast("long").alias("bytes"), F.when(back > 0, F.length(x) - back + 1).otherwise(0).cast("long").alias("from_end"),
    )


@query("""with w as (select c_custkey, regexp_extract_all(x, '[A-Za-z0-9]+|[^A-Za-z0-9]+') as parts from (select c_custkey, c_mktsegment || '-of ' || lower(c_name) as x from customer))
 select c_custkey, array_to_string(list_transform(parts, lambda p: upper(p[1]) || lower(p[2:])), '') as title from w""")
def title_case(spark, d):
    return t(spark, d, "customer").select("c_custkey", dialect.initcap(F.concat("c_mktsegment", F.lit("-of "), F.lower("c_name"))).alias("title"))


@query("""with x as (select o_orderkey, cast(o_orderdate as timestamp) + to_minutes(cast(o_orderkey * 37 % 1440 as integer)) as a, timestamp '1996-02-29 06:30:00' as b from orders)
 select o_orderkey, round(12.0 * (year(a) - year(b)) + month(a) - month(b) + case when day(a) = day(b) or (cast(a as date) = last_day(a) and cast(b as date) = last_day(b)) then 0
 else (day(a) - day(b) + (hour(a) * 60 + minute(a) - hour(b) * 60 - minute(b)) / 1440.0) / 31.0 end, 6) as months, cast(cast(a as date) + cast(7 - (isodow(a) - 1 + 7 - 0) % 7 as integer) as date) as monday,
 cast(case when month(a) >= 7 then date_trunc('year', a) + interval 1 year else date_trunc('year', a) end as date) as near_year, cast(case when day(a) >= 16 then date_trunc('month', a) + interval 1 month else date_trunc('month', a) end as date) as near_month,
 cast(case when hour(a) >= 12 then date_trunc('day', a) + interval 1 day else date_trunc('day', a) end as date) as near_day, cast(date_trunc('quarter', a) as date) as quarter, cast(date_trunc('week', a) as date) as week,
 strftime(a, '%Y%m%d %H%M') as round_trip from x""")
def more_date_functions(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", F.expr("cast(o_orderdate as timestamp) + make_interval(0, 0, 0, 0, 0, cast(o_orderkey * 37 % 1440 as int), 0)").alias("a"))
    a, b = F.col("a"), F.lit("1996-02-29 06:30:00").cast("timestamp")
    text = dialect.to_char(a, "DD/MM/YYYY HH24:MI:SS")
    return o.select(
        "o_orderkey", F.round(dialect.months_between(a, b), 6).alias("months"), dialect.next_day(a, "MON").alias("monday"), F.to_date(dialect.round_date(a, "YYYY")).alias("near_year"), F.to_date(dialect.round_date(a, "MM")).alias("near_month"),
        F.to_date(dialect.round_date(a, "DD")).alias("near_day"), F.to_date(dialect.trunc_date(a, "Q")).alias("quarter"), F.to_date(dialect.trunc_date(a, "IW")).alias("week"), F.date_format(dialect.to_date(text, "DD/MM/YYYY HH24:MI:SS"), "yyyyMMdd HHmm").alias("round_trip"),
    )


@query("""select l_orderkey, l_linenumber, l_partkey, l_suppkey, trunc(x / 7.0) as t, trunc(-x / 7.0 * 100) / 100 as t2, cast(round(x, -2) as bigint) as hundreds, round(exp(l_discount), 6) as e, round(ln(l_quantity) / ln(2), 6) as l2, round(sin(l_quantity) + cos(l_quantity) + tan(l_discount), 6) as trig,
 format('{:,.2f}', x * 1.0) as shown, cast(x as double) as back, case when l_linenumber = 1 then null else cast(l_linenumber as double) end as parsed from (select *, cast(round(l_extendedprice) as bigint) as x from lineitem) q""")
def more_math_functions(spark, d):
    x = F.round("l_extendedprice").cast("long")
    shown = dialect.number_text(x, 2)
    return t(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", dialect.trunc(x / 7.0).alias("t"), dialect.trunc(-x / 7.0, 2).alias("t2"), F.round(x, -2).alias("hundreds"), F.round(F.exp("l_discount"), 6).alias("e"), F.round(F.log(2.0, F.col("l_quantity")), 6).alias("l2"),
        F.round(F.sin("l_quantity") + F.cos("l_quantity") + F.tan("l_discount"), 6).alias("trig"), shown.alias("shown"), dialect.to_number(shown).alias("back"), dialect.to_number(F.when(F.col("l_linenumber") == 1, "no number").otherwise(F.concat(F.lit(" +"), F.col("l_linenumber").cast("string"), F.lit(". ")))).alias("parsed"),
    )


@query("""select 'all' as asked, c_mktsegment, count(*) as n from customer group by c_mktsegment union all select 'one', c_mktsegment, count(*) from customer where c_mktsegment = 'BUILDING' group by c_mktsegment
 union all select 'bound', c_mktsegment, count(*) from customer where c_nationkey between 3 and 9 group by c_mktsegment""")
def parameters(spark, d):
    c = t(spark, d, "customer")
    ask = lambda name, value: c.where(dialect.wanted(F.col("c_mktsegment"), value)).groupBy("c_mktsegment").agg(F.count("*").alias("n")).select(F.lit(name).alias("asked"), "c_mktsegment", "n")
    bound = spark.sql("select 'bound' as asked, c_mktsegment, count(*) as n from {c} where c_nationkey between :low and :high group by c_mktsegment", args={"low": 3, "high": 9}, c=c)
    return ask("all", "").unionByName(ask("one", "BUILDING")).unionByName(bound)


PATTERNS = "(values ('web', 'click', '[02468]}$'), ('web', 'view', '.'), ('shop', 'purchase', '\"k\": [1-4][0-9]?}'), ('shop', 'signup', '9'), ('none', 'click', '^x$'), ('gone', 'nothing', '.')) as m(product, feature, pattern)"


@query(f"select product, count(e.event_type) as n from (select * from {PATTERNS}) p left join events e on e.event_type = p.feature and regexp_matches(e.props, p.pattern) group by product")
def regex_join(spark, d):
    """Rows meet a mapping by name, and stay where they match its pattern: the mapping, six rows, is what is sent."""
    m = spark.sql(f"select * from {PATTERNS}")
    hits = t(spark, d, "events").join(F.broadcast(m), (F.col("event_type") == F.col("feature")) & F.expr("props rlike pattern")).groupBy("product").agg(F.count("*").alias("k"))
    return m.select("product").distinct().join(hits, "product", "left").select("product", F.coalesce("k", F.lit(0)).alias("n"))
