"""Reports in text, written from the tables in the layouts of three versions, and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsledger.registry import query, t
from opsledger.shared import dropped, shared_dir, stored
from opsledger.sources import report_sections as rs
from opsledger.sources import reports

VERSION = {0: 11, 1: 12, 2: 10, 3: 12}  # of the report of each fourth of the users
ELAPSED = "30.50"


def _cells(widths: list[int], *values: Column | str) -> Column:
    """One row of a table: the first value to the left, the others to the right."""
    v = [F.lit(x) if isinstance(x, str) else x for x in values]
    return F.concat_ws(" ", F.rpad(v[0], widths[0], " "), *[F.lpad(F.coalesce(x, F.lit("")), w, " ") for x, w in zip(v[1:], widths[1:], strict=True)])


def _section(version: int, title: str, skip: int, widths: list[int] | None, rows: Column) -> Column:
    """A section: title, head, row of hyphens if it is a table, rows, and the version's end."""
    head = "".join(f"head {k}\n" for k in range(skip))
    ruler = " ".join("-" * w for w in widths) + "\n" if widths else ""
    return F.concat(F.lit(f"{title}    DB/Inst: X/x\n{head}{ruler}"), rows, F.lit("\n" + " " * 10 + "-" * (54 if version == 12 else 61) + "\n\n"))


def _written(spark, d) -> str:
    """A folder of reports, one for each fourth of the users: all kinds of sections, names that wrap, titles inside of statements."""
    e = t(spark, d, "events").withColumn("r", F.col("user_id") % 4)
    by = e.groupBy("r", "event_type").agg(F.count("*").alias("waits"), (F.sum(F.col("user_id") % 50) + 1).alias("time_s"))
    shown = lambda c: F.format_number(c, 0)
    top_w, ev_w, act_w = [30, 12, 14, 8, 8, 12], [20, 12, 6, 14, 8, 8, 8], [40, 18, 16, 13]
    top = _cells(top_w, F.col("event_type"), shown("waits"), shown("time_s"), "1", F.lit("2.5"), F.concat(F.lit("class "), F.length("event_type").cast("string"))).alias("top")
    wait = lambda n, last: F.concat(_cells(ev_w[:n], F.concat(F.lit("a long name of "), F.substring("event_type", 1, 5)), shown("waits"), "0", shown("time_s"), "1", "1", *last), F.lit("\n"), F.substring("event_type", 6, 20), F.lit(" end"))
    lines = by.select("r", "event_type", "waits", "time_s", top, wait(7, [(F.col("waits") % 90).cast("string")]).alias("fg"), wait(6, []).alias("fg10"))
    ordered = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("time_s")).alias("k"), "event_type", F.col(c).alias("line")))), lambda x: x["line"]), "\n").alias(c)
    tables = lines.groupBy("r").agg(ordered("top"), ordered("fg"), ordered("fg10"))
    g = e.groupBy("r").agg(F.count("*").alias("n"), F.sum("user_id").alias("s")).join(tables, "r")
    db_time = F.concat(shown(F.expr("s div 4")), F.lit("."), F.lpad((F.col("s") % 4 * 25).cast("string"), 2, "0"))
    text: Column = F.lit(None)
    for r, v in VERSION.items():
        unit = lambda u, v=v: f" ({u})" if v == 12 else ""
        startup = "" if v == 10 else "Startup Time    "
        figure = lambda label, x: F.concat(F.lit(f"{label}:".rjust(24) + "   "), x, F.lit("    1.0\n"))
        profile = F.concat(
            F.lit(f"WORKLOAD REPORT\n\nDB Name         DB Id    Instance     Inst Num {startup}Release     RAC\n------------ ----------- ------------ --------\nSHOP  1 shop1 1\n\n   Elapsed:               {ELAPSED} (mins)\n   DB Time:               "), db_time, F.lit(" (mins)\n\nLoad Profile\n"),
            figure("Redo size" + unit("bytes"), F.concat(shown(F.col("s") * 200), F.lit(".7"))), figure("Logical read" + ("" if v == 12 else "s") + unit("blocks"), F.concat(shown("n"), F.lit(".5"))), figure("Parses" + unit("SQL"), F.lit("12.5")), figure("Hard parses" + unit("SQL"), F.lit("1,012.5")), figure("Executes" + unit("SQL"), shown("n")), figure("Transactions", F.lit("52.8")),
        )
        activity = [("physical read total IO requests", F.concat(shown("n"), F.lit(".1"))), ("physical read total bytes", shown(F.col("s") * 1000)), ("physical write total IO requests", F.concat(shown(F.col("n") * 2), F.lit(".3"))), ("physical write total bytes", F.concat(F.col("s").cast("string"), F.lit("E+3")) if v == 12 else shown(F.col("s") * 700))] + [("redo writes", F.lit("7.2"))] * (v != 11)
        titles = {10: "Top 5 Timed Events  ", 11: "Top 5 Timed Foreground Events", 12: "Top 10 Foreground Events by Total Wait Time"}
        cpu = F.concat(_cells(top_w, "CPU time" if v == 10 else "DB CPU", "", "77", "", "9.5", ""), F.lit("\n"))
        fg = "fg10" if v == 10 else "fg"
        body = [
            profile,
            _section(v, titles[v], {10: 2, 11: 4, 12: 3}[v], top_w, F.concat(cpu, "top")),
            _section(v, "Time Model Statistics  ", 6, None, F.concat(F.lit("sql execute 1.5 9\nOperating System Statistics  \nDB CPU "), shown("n"), F.lit(" 3.1"))),
            _section(v, "Operating System Statistics  ", 2 if v == 10 else 5, None, F.concat(F.lit("BUSY_TIME      "), shown(F.col("n") * 10), F.lit("\nIDLE_TIME      5,000\nNUM_CPUS           16\nOTHER 3"))),
            _section(v, "Wait Class  " if v == 10 else "Foreground Wait Class  ", 7, ev_w, _cells(ev_w, "User I/O", shown("n"), "0", shown("s"), "1", "1", "5.5")),
            _section(v, "SQL ordered by Elapsed Time", 3, None, F.lit("select 1\nWait Events  \nInstance Activity Stats  \nupdate x")),
            _section(v, "Wait Events  " if v == 10 else "Foreground Wait Events  ", 3, ev_w[:6] if v == 10 else ev_w, F.col(fg)),
            _section(v, "Background Wait Events  ", 3, ev_w[:6] if v == 10 else ev_w, F.col(fg)),
            _section(v, "Wait Event Histogram    ", 8, [26, 6, 6], _cells([26, 6, 6], "log file sync", shown("n"), "5")),
            _section(v, "Other Instance Activity Stats " if v == 12 else "Instance Activity Stats  ", 2 if v == 10 else 3, act_w, F.concat_ws("\n", *[_cells(act_w, k, "9,999", x, "1") for k, x in activity])),
            _section(v, "Instance Activity Stats - Thread Activity", 3, [32, 10, 10], _cells([32, 10, 10], "log switches (derived)", "4", "0.13")),
        ]
        text = F.when(F.col("r") == r, F.concat(*body)).otherwise(text)
    folder = f"{shared_dir(spark).rstrip('/')}/reports-{uuid.uuid4().hex}"
    g.select(text.alias("value"), "r").repartition(4, "r").write.partitionBy("r").option("lineSep", "\f").text(folder)
    return folder


def _read(spark, d) -> tuple[DataFrame, DataFrame, DataFrame, str]:
    """Lines, rows of sections, and rows of tables; and the folder, to be dropped."""
    folder = _written(spark, d)
    lines = reports.lines(spark, f"{folder}/*/*.txt").withColumn("line", F.rtrim(F.regexp_replace("line", "\f", "")))
    rows = rs.sections(lines)
    return lines, rows, rs.cells(rows.where("section not in ('time model', 'operating system')")), folder


def _named(spark, df: DataFrame, folder: str) -> DataFrame:
    out = stored(df.withColumn("r", F.regexp_extract("file", "/r=([0-9]+)/", 1).cast("long")).drop("file"))
    dropped(spark, [folder])
    return out


_G = "g as (select user_id % 4 as r, count(*) as n, cast(sum(user_id) as bigint) as s from events group by 1), v as (select *, case r when 0 then 11 when 2 then 10 else 12 end as version from g)"
_MIB = "((({x}) * 1000000 // 1048576 + 5000) // 10000 / 100.0)"


@query(f"""with {_G}, m as (select *, {_MIB.format(x='s * 1000')} as read_mib, {_MIB.format(x='case version when 12 then s * 1000 else s * 700 end')} as write_mib, ((s * 200 * 10 + 7) * 1000000 // 10485760 + 5000) // 10000 / 100.0 as redo_mib, (s * 25 * 10 // 3050) / 10.0 as aas from v)
 select r, s / 4 as db_time, cast(30.5 as double) as elapsed, cast(16 as double) as cpus, n + 0.5::double as logical_reads, cast(12.5 as double) as parses, cast(1012.5 as double) as hard_parses, cast(n as double) as executes, cast(52.8 as double) as transactions, cast(n * 10 as double) as busy_time, cast(aas as double) as aas, aas > 16 as busy,
 cast(read_mib as double) as read_mib, cast(write_mib as double) as write_mib, cast(redo_mib as double) as redo_mib, round(read_mib + write_mib, 2) as total_mib, round(write_mib - redo_mib, 2) as data_mib, round(n * 3 + 0.4::double, 1) as total_iops, case when version <> 11 then round(n * 2 + 0.3 - 7.2::double, 1) end as data_iops from m""")
def report_load(spark, d):
    lines, rows, table, folder = _read(spark, d)
    return _named(spark, rs.figures(rs.fields(lines, rows, table)), folder)


EVENTS = f"""with {_G}, k as (select user_id % 4 as r, event_type as event, count(*) as waits, cast(sum(user_id % 50) as bigint) + 1 as time_s from events group by 1, 2),
 a as (select r, event, 'class ' || length(event) as class, cast(waits as double) as waits, cast(time_s as double) as time_s, ((time_s * 10000000 // waits) + 5) // 10 / 1000 as avg_ms, cast(2.5 as double) as pct, time_s as o from k union all select r, 'DB CPU', null, null, 77, null, 9.5, 9000000000000 from v),
 e as (select r, cast(row_number() over (partition by r order by o desc, event) as integer) as rank, event, class, waits, time_s, avg_ms, pct from a)"""


@query(f"{EVENTS} select * from e where rank <= 5")
def report_events(spark, d):
    *_, table, folder = _read(spark, d)
    return _named(spark, rs.top_events(table), folder)


@query(f"{EVENTS} select r, " + ", ".join(f"max(case when rank = {k} then {f} end) as top{k}_{f}" for k in range(1, 6) for f in ("event", "class", "waits", "time_s", "avg_ms", "pct")) + " from e group by r")
def report_wide(spark, d):
    *_, table, folder = _read(spark, d)
    return _named(spark, reports.wide(rs.top_events(table)), folder)


@query(f"""with {_G}, k as (select user_id % 4 as r, event_type, count(*) as waits, cast(sum(user_id % 50) as bigint) + 1 as time_s from events group by 1, 2), b as (select * from (values ('foreground events'), ('background events')) as b(section))
 select r, version, section, 'a long name of ' || substr(event_type, 1, 5) || ' ' || substr(event_type, 6) || ' end' as event, cast(waits as double) as waits, cast(time_s as double) as time_s, ((time_s * 10000000 // waits) + 5) // 10 / 1000 as avg_ms,
 case when version > 10 then cast(waits % 90 as double) when section = 'foreground events' then (time_s * 400000 // (s * 60) + 50) // 100 / 10 end as pct from k join v using (r), b""".replace("' ' || substr(event_type, 6) || ' end'", "case when length(event_type) > 5 then ' ' || substr(event_type, 6) else '' end || ' end'"))
def report_waits(spark, d):
    lines, rows, table, folder = _read(spark, d)
    return _named(spark, rs.waits(table, rs.fields(lines, rows, table)).drop("at"), folder)


@query(f"""with {_G}, k as (select user_id % 4 as r, count(distinct event_type) as kinds from events group by 1) select r, version, section, cast(lines as bigint) as lines from v join k using (r),
 lateral (values ('top events', kinds + 2), ('time model', case when version = 10 then 3 end), ('operating system', 4), ('wait class', 2), ('foreground events', 2 * kinds + 1), ('background events', 2 * kinds + 1), ('histogram', 2), ('activity', case when version = 11 then 5 else 6 end), ('threads', 2)) as x(section, lines) where lines is not null""")
def report_sections(spark, d):
    """Lines of each section, with the row of hyphens where there is one."""
    _, rows, _, folder = _read(spark, d)
    return _named(spark, rows.where("trim(line) <> ''").groupBy("file", "version", "section").agg(F.count("*").alias("lines")), folder)
