"""Text performance reports as rows, and report sinks."""

from __future__ import annotations

import html

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line) of every report under ``path``; a report is small and read whole."""
    t = spark.read.text(path, wholetext=True).withColumn("file", F.input_file_name())
    return t.select("file", F.posexplode(F.split("value", r"\r?\n")).alias("line_no", "line")).withColumn("line", F.rtrim("line"))


def tagged(report: DataFrame, headers: dict[str, str]) -> DataFrame:
    """``report`` with the section that each line is in: that of the last line before it that starts as a key of ``headers`` does; its own line is left out."""
    tag: Column = F.lit(None)
    for start, name in headers.items():
        tag = F.when(F.col("line").startswith(start), F.lit(name)).otherwise(tag)
    w = Window.partitionBy("file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    return report.withColumn("tag", tag).withColumn("section", F.last("tag", ignorenulls=True).over(w)).where("tag is null").drop("tag")


def key_values(rows: DataFrame, *by: str) -> DataFrame:
    """(file, by..., key, value) of 'key: value' lines, a value the first number after the colon; thousands separators are taken out, powers of ten understood, what follows is left."""
    m = rows.where(F.col("line").rlike(r"^\s*[^:]+:\s*-?\d[\d,]*(\.\d+)?(E\+\d+)?(\s|$)"))
    value = F.regexp_extract("line", r":\s*(-?\d[\d,]*(?:\.\d+)?(?:E\+\d+)?)", 1)
    return m.select("file", *by, F.trim(F.regexp_extract("line", r"^\s*([^:]+):", 1)).alias("key"), F.regexp_replace(value, ",", "").cast("double").alias("value"))


def fixed_width(rows: DataFrame, least: int = 6, most: int = 10) -> DataFrame:
    """(file, section, line_no, cells) of the lines under a section's row of hyphens, up to the first empty line.

    The groups of hyphens give the columns' places. A section whose row has fewer than ``least`` or
    more than ``most`` groups is left out.
    """
    ruler = F.when(F.col("line").rlike(r"^-[- ]*$") & (F.size(F.split(F.trim("line"), " +")) > 1), F.col("line"))
    w = Window.partitionBy("file", "section").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    m = rows.where("section is not null").withColumn("own", ruler).withColumn("ruler", F.last("own", ignorenulls=True).over(w)).withColumn("ended", F.max(F.col("ruler").isNotNull() & (F.trim("line") == "")).over(w))
    m = m.where("ruler is not null and own is null and not ended").withColumn("widths", F.expr("transform(split(trim(ruler), ' +'), g -> length(g))")).where(F.size("widths").between(least, most))
    cell = "transform(sequence(1, size(widths)), k -> trim(substr(line, 1 + aggregate(slice(widths, 1, k - 1), 0, (s, n) -> s + n + 1), widths[k - 1])))"
    return m.select("file", "section", "line_no", F.expr(cell).alias("cells"))


def wide(events: DataFrame, top: int = 5) -> DataFrame:
    """One row a file: the fields of its first ``top`` events side by side."""
    fields = ["event", "class", "waits", "time_s", "avg_ms", "pct"]
    return events.groupBy("file").agg(*[F.max(F.when(F.col("rank") == k, F.col(f))).alias(f"top{k}_{f}") for k in range(1, top + 1) for f in fields])


def to_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, sep=",", header=False)


def to_html(df: DataFrame, path: str) -> None:
    """All rows of a report as an HTML table: a folder of parts, in order, between a head and a foot; nothing comes to the driver."""
    cell = lambda c, tag: F.concat(F.lit(f"<{tag}>"), F.coalesce(F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit("")), F.lit(f"</{tag}>"))
    body = df.select(F.concat(F.lit("<tr>"), *[cell(F.col(f"`{c}`").cast("string"), "td") for c in df.columns], F.lit("</tr>")).alias("value"))
    body.write.mode("overwrite").text(f"{path}/1-rows")
    head = "<table><tr>" + "".join(f"<th>{html.escape(c, quote=False)}</th>" for c in df.columns) + "</tr>"
    for name, line in (("0-head", head), ("2-foot", "</table>")):
        df.sparkSession.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{name}")


def to_xls(df: DataFrame, path: str) -> None:
    """The same table under the name that spreadsheets open, with the sheet's head before it."""
    to_html(df, path)
    line = '<html xmlns:x="urn:schemas-microsoft-com:office:excel"><meta charset="utf-8">'
    df.sparkSession.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/0-a-sheet")
