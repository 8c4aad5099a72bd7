"""Sections of performance reports by a dictionary: where each starts, how many lines its head has, where it ends, in which versions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsledger.sources.reports import key_values

VERSIONS = (10, 11, 12)


@dataclass(frozen=True)
class Section:
    """A kind of section: lines that start like ``starts`` open it, in ``versions``; ``skip`` lines of head follow, by version. A section without a name is passed over."""

    name: str | None
    starts: tuple[str, ...]
    skip: tuple[int, int, int]
    versions: tuple[int, ...] = VERSIONS


# fixed values: the titles of the report's sections, and the lines of head after them
SECTIONS = [
    Section("top events", ("Top 5 Timed Events  ",), (2, 2, 2), (10,)),
    Section("top events", ("Top 5 Timed Foreground Events",), (4, 4, 4)),
    Section("top events", ("Top 10 Foreground Events by Total Wait T",), (3, 3, 3)),
    Section("time model", ("Time Model Statistics  ",), (6, 6, 6), (10,)),
    Section("operating system", ("Operating System Statistics  ",), (2, 5, 5)),
    Section("wait class", ("Wait Class  ",), (7, 7, 7), (10,)),
    Section("wait class", ("Foreground Wait Class  ",), (7, 7, 7)),
    Section("foreground events", ("Wait Events  ", "Foreground Wait Events  "), (3, 3, 3)),
    Section("background events", ("Background Wait Events  ",), (3, 3, 3)),
    Section("histogram", ("Wait Event Histogram    ",), (8, 8, 8)),
    Section("activity", ("Instance Activity Stats  ", "Other Instance Activity Stats "), (2, 3, 3)),
    Section("threads", ("Instance Activity Stats - Thread Activit",), (3, 3, 3)),
    Section(None, ("SQL ordered by",), (0, 0, 0)),
    Section(None, ("Time Model Statistics  ",), (0, 0, 0), (11, 12)),
]
# fixed values: labels of the report's profile, per second; versions from 12 on add a unit in brackets
PROFILE = {"Elapsed": "elapsed", "DB Time": "db_time", "Redo size": "redo_bytes", "Logical read": "logical_reads", "Block changes": "block_changes", "User calls": "user_calls", "Parses": "parses", "Hard parses": "hard_parses", "Logons": "logons", "Executes": "executes", "Transactions": "transactions"}
OS = {"BUSY_TIME": "busy_time", "IDLE_TIME": "idle_time", "IOWAIT_TIME": "iowait_time", "SYS_TIME": "sys_time", "USER_TIME": "user_time", "NUM_CPUS": "cpus"}
ACTIVITY = {"physical read total IO requests": "read_iops", "physical read total bytes": "read_bytes", "physical write total IO requests": "write_iops", "physical write total bytes": "write_bytes", "redo writes": "redo_iops"}


def versions(lines: DataFrame) -> DataFrame:
    """(file, version): 12 where redo comes with its unit, else 11 where the database's line has a startup time, else 10; null where there is no such line."""
    has = lambda c: F.max(c.cast("int"))
    g = lines.groupBy("file").agg(has(F.col("line").rlike(r"^\s*Redo size \(")).alias("unit"), has(F.col("line").rlike(r"^DB Name\s.*Startup")).alias("startup"), has(F.col("line").startswith("DB Name")).alias("name"))
    return g.select("file", F.when(F.col("name") == 1, F.when(F.col("unit") == 1, 12).when(F.col("startup") == 1, 11).otherwise(10)).alias("version"))


def sections(lines: DataFrame) -> DataFrame:
    """(file, version, section, at, line) of the lines in named sections, without titles, heads and ends; ``at`` counts from 0.

    A title counts only outside of sections, so what a section passed over holds can't open another;
    a section ends at a line of hyphens alone, 61 of them, from version 12 on 54. A report is small:
    its lines are one window.
    """
    rows = lines.join(F.broadcast(versions(lines)), "file").where("version is not null")
    place = Window.partitionBy("file").orderBy("line_no")
    opens: Column = F.lit(None)
    for k, s in reversed(list(enumerate(SECTIONS))):
        hit = F.col("version").isin(list(s.versions)) & F.lit(False)
        for start in s.starts:
            hit = hit | (F.col("version").isin(list(s.versions)) & F.col("line").startswith(start))
        opens = F.when(hit, k).otherwise(opens)
    # the right blanks of a title may be gone
    rows = rows.withColumn("line", F.rpad("line", F.lit(200), F.lit(" "))).withColumn("opens", opens).withColumn("line", F.rtrim("line"))
    width = F.when(F.col("version") == 12, 54).otherwise(61)
    ends = F.trim("line").rlike("^-+$") & (F.length(F.trim("line")) == width)
    rows = rows.withColumn("event", F.when(ends, -1).otherwise(F.col("opens")))
    before = F.last("event", ignorenulls=True).over(place.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("before", F.coalesce(before, F.lit(-1)))
    # of titles and ends, a title after an end is one; others before the next end aren't
    rows = rows.withColumn("turn", F.when(F.col("event") == -1, -1).when(F.col("event").isNotNull() & (F.col("before") == -1), F.col("event")))
    upto = place.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("kind", F.last("turn", ignorenulls=True).over(upto)).withColumn("from", F.last(F.when(F.col("turn").isNotNull(), F.col("line_no")), ignorenulls=True).over(upto)).where("kind >= 0")
    name, skip = F.element_at(F.lit([s.name or "" for s in SECTIONS]), F.col("kind") + 1), F.element_at(F.element_at(F.lit([list(s.skip) for s in SECTIONS]), F.col("kind") + 1), F.col("version") - 9)
    rows = rows.withColumn("section", name).withColumn("at", (F.col("line_no") - F.col("from") - 1 - skip).cast("int"))
    return rows.where("section <> '' and at >= 0").select("file", "version", "section", "at", "line")


def cells(rows: DataFrame) -> DataFrame:
    """(file, version, section, at, cells) of the table rows of sections, by the places of their row of hyphens; a row that has only a first cell goes on the row above."""
    w = Window.partitionBy("file", "section").orderBy("at")
    ruler = F.when(F.col("line").rlike(r"^\s*-[- ]*$"), F.col("line"))
    m = rows.withColumn("own", ruler).withColumn("ruler", F.last("own", ignorenulls=True).over(w)).where("ruler is not null and own is null and trim(line) <> ''")
    groups = F.expr("regexp_extract_all(ruler, '-+', 0)")
    starts = F.expr("transform(sequence(1, size(groups)), k -> length(regexp_extract(ruler, concat('^ *(-+ +){', k - 1, '}'), 0)) + 1)")
    m = m.withColumn("groups", groups).withColumn("starts", starts)
    m = m.withColumn("cells", F.expr("transform(sequence(1, size(groups)), k -> trim(substr(line, starts[k - 1], if(k = size(groups), 1000, starts[k] - starts[k - 1]))))"))
    more = F.expr("size(cells) > 1 and forall(slice(cells, 2, size(cells) - 1), c -> c = '')")
    m = m.withColumn("row", F.sum(F.when(more, 0).otherwise(1)).over(w))
    one = m.groupBy("file", "version", "section", "row").agg(F.min("at").alias("at"), F.array_sort(F.collect_list(F.struct("at", "cells"))).alias("x"))
    name = F.expr("array_join(transform(x, y -> y.cells[0]), ' ')")
    return one.where("row > 0").select("file", "version", "section", "at", F.expr("transform(x[0].cells, (c, k) -> if(k = 0, '', c))").alias("rest"), name.alias("name")).select("file", "version", "section", "at", F.concat(F.array("name"), F.expr("slice(rest, 2, size(rest))")).alias("cells"))


def number(text: Column) -> Column:
    """A figure of the report: commas out, and powers of ten where it is very large."""
    return F.regexp_replace(text, ",", "").try_cast("double").try_cast("decimal(24,4)")


def ratio(a: Column, b: Column, digits: int) -> Column:
    """a / b, cut off after ``digits`` decimals, exactly; null for a divisor of zero."""
    whole = lambda x: (x * F.lit(10**7).cast("decimal(8,0)")).cast("decimal(31,0)")
    q = F.call_function("div", (whole(a) * F.lit(10**digits).cast("decimal(8,0)")).cast("decimal(38,0)"), F.when(b != 0, whole(b).cast("decimal(38,0)")))
    return (q.cast("decimal(24,0)") / F.lit(10**digits).cast("decimal(8,0)")).cast(f"decimal(24,{digits})")


def rounded(x: Column, digits: int) -> Column:
    """Half a unit of the last place is added, then the rest cut off."""
    return ratio(x.cast("decimal(24,7)") * 1 + F.lit(5 * 10 ** -(digits + 1)).cast("decimal(8,4)"), F.lit(1).cast("decimal(4,0)"), digits)


def mib(x: Column) -> Column:
    return rounded(ratio(x, F.lit(1048576).cast("decimal(8,0)"), 6), 2)


def fields(lines: DataFrame, rows: DataFrame, table: DataFrame) -> DataFrame:
    """A row a file: figures of PROFILE from its ``lines``, of OS from the ``rows`` of its sections, of ACTIVITY, per second, from their ``table``."""
    profile = F.create_map(*[x for k, v in PROFILE.items() for x in (F.lit(k), F.lit(v))])
    label = F.regexp_replace("key", r"\s*\(.*\)$", "")
    label = F.when(label == "Logical reads", "Logical read").otherwise(label)
    a = key_values(lines).select("file", profile[label].alias("field"), F.col("value").try_cast("decimal(24,4)").alias("value"))
    words = F.split(F.trim("line"), r"\s+")
    b = rows.where("section = 'operating system'").select("file", F.create_map(*[x for k, v in OS.items() for x in (F.lit(k), F.lit(v))])[words[0]].alias("field"), number(F.get(words, F.lit(1))).alias("value"))
    c = table.where("section = 'activity'").select("file", F.create_map(*[x for k, v in ACTIVITY.items() for x in (F.lit(k), F.lit(v))])[F.col("cells")[0]].alias("field"), number(F.get("cells", F.lit(2))).alias("value"))
    found = a.unionByName(b).unionByName(c).where("field is not null and value is not null")
    names = [*PROFILE.values(), *OS.values(), *ACTIVITY.values()]
    return found.groupBy("file").agg(*[F.max(F.when(F.col("field") == n, F.col("value"))).alias(n) for n in names])


def figures(f: DataFrame) -> DataFrame:
    """Figures worked out from ``fields``: average active sessions, cut to one decimal, whether they are more than the CPUs, throughputs in MiB/s and IOs/s.

    Each throughput is rounded first. Totals are of what is read and written; what is written as data
    is without redo, and unknown where redo is. Totals of nothing are null.
    """
    aas = ratio(F.col("db_time"), F.col("elapsed"), 1)
    read, write, redo = (mib(F.col(c)) for c in ("read_bytes", "write_bytes", "redo_bytes"))
    zero = F.lit(0).cast("decimal(24,2)")
    some = lambda a, b: F.nullif(F.coalesce(a, zero) + F.coalesce(b, zero), zero)
    iops = lambda c: F.col(c).cast("decimal(24,1)")
    return f.select(
        "file", *[F.col(c).cast("double").alias(c) for c in ("db_time", "elapsed", "cpus", "logical_reads", "parses", "hard_parses", "executes", "transactions", "busy_time")], aas.cast("double").alias("aas"), (aas > F.col("cpus")).alias("busy"),
        *[x.cast("double").alias(n) for n, x in (("read_mib", read), ("write_mib", write), ("redo_mib", redo), ("total_mib", some(read, write)), ("data_mib", F.nullif(write - redo, zero)), ("total_iops", some(iops("read_iops"), iops("write_iops"))), ("data_iops", F.nullif(iops("write_iops") - iops("redo_iops"), zero)))],
    )


def waits(table: DataFrame, f: DataFrame) -> DataFrame:
    """(file, version, section, at, event, waits, time_s, avg_ms, pct) of events in the foreground and background: the mean in milliseconds to three decimals, and the share of the database's time to one, which version 10 doesn't print and is worked out."""
    c = F.col("cells")
    rows = table.where("section in ('foreground events', 'background events')").select("file", "version", "section", "at", c[0].alias("event"), number(c[1]).alias("waits"), number(F.get(c, F.lit(3))).alias("time_s"), number(F.get(c, F.lit(6))).alias("printed"))
    rows = rows.join(f.select("file", "db_time"), "file")
    avg = rounded(ratio(F.col("time_s"), F.col("waits"), 7) * 1000, 3)
    share = rounded(ratio(F.col("time_s"), F.col("db_time") * 60, 5) * 100, 1)
    pct = F.when(F.col("version") > 10, F.col("printed")).when(F.col("section") == "foreground events", share)
    return rows.select("file", "version", "section", "at", "event", F.col("waits").cast("double").alias("waits"), F.col("time_s").cast("double").alias("time_s"), avg.cast("double").alias("avg_ms"), pct.cast("double").alias("pct"))


def top_events(table: DataFrame, most: int = 5) -> DataFrame:
    """(file, rank, event, class, waits, time_s, avg_ms, pct): the first rows of the section of top events. A line of CPU time has no waits, mean or class."""
    rank = F.row_number().over(Window.partitionBy("file").orderBy("at"))
    c, cpu = F.col("cells"), F.col("cells")[0].startswith("DB CPU") | F.col("cells")[0].startswith("CPU tim")
    unless = lambda x: F.when(~cpu, x)
    rows = table.where("section = 'top events'").withColumn("rank", rank).where(F.col("rank") <= most)
    n, s = number(c[1]), number(c[2])
    avg = F.when(n > 0, rounded(ratio(s, n, 7) * 1000, 3)).otherwise(number(c[3]))
    return rows.select("file", "rank", F.when(cpu, "DB CPU").otherwise(c[0]).alias("event"), unless(c[5]).alias("class"), unless(n).cast("double").alias("waits"), s.cast("double").alias("time_s"), unless(avg).cast("double").alias("avg_ms"), number(c[4]).cast("double").alias("pct"))
