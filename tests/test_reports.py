"""Sections of reports against a plain reader that goes line by line."""

import re

import pytest

from opsledger import text_catalog
from opsledger.sources import report_sections as rs
from opsledger.sources import reports
from opsledger.shared import dropped

D = "/root/testdata/sf0.001"


def plain(text):
    """{section: lines} by a loop over states."""
    lines = [x.rstrip() for x in text.split("\n")]
    if not any(x.startswith("DB Name") for x in lines):
        return None, {}
    version = 12 if any(re.match(r"\s*Redo size \(", x) for x in lines) else 11 if any(re.match(r"DB Name\s.*Startup", x) for x in lines) else 10
    end = "-" * (54 if version == 12 else 61)
    out, now, skip = {}, None, 0
    for x in lines:
        if now is None:
            for s in rs.SECTIONS:
                if version in s.versions and any((x + " " * 40).startswith(t) for t in s.starts):
                    now, skip = s, s.skip[version - 10]
                    break
        elif x.strip() == end:
            now = None
        elif skip:
            skip -= 1
        elif now.name:
            out.setdefault(now.name, []).append(x)
    return version, out


def read(spark, path):
    lines = reports.lines(spark, path)
    return lines, rs.sections(lines)


def test_generated_reports_as_a_plain_reader_has_them(spark):
    folder = text_catalog._written(spark, D)
    texts = {r["r"]: r["value"].rstrip("\f") for r in spark.read.text(folder, wholetext=True).collect() if r["value"]}
    lines, rows = read(spark, f"{folder}/*/*.txt")
    got = {}
    for r in rows.orderBy("file", "at").collect():
        got.setdefault(int(re.search(r"r=(\d)", r["file"])[1]), {}).setdefault(r["section"], []).append(r["line"].replace("\f", "").rstrip())
    assert len(texts) == 4 and {plain(t)[0] for t in texts.values()} == {10, 11, 12}
    for k, t in texts.items():
        version, want = plain(t)
        assert version == text_catalog.VERSION[k] and got[k] == want
        assert set(want) >= {"top events", "operating system", "wait class", "foreground events", "background events", "histogram", "activity", "threads"} and ("time model" in want) == (version == 10)
    dropped(spark, [folder])


END = {10: "-" * 61, 12: "-" * 54}


def test_states_of_odd_reports(spark, tmp_path):
    head = "DB Name  DB Id\nx\n"
    (tmp_path / "a.txt").write_text(head + f"Wait Events  \nh\nh\nh\na\nBackground Wait Events  \nb\n{END[12]}\nc\n{END[10]}\nlost\nSQL ordered by\nWait Class  \n{END[10]}\nWait Event Histogram    \n" + "h\n" * 8 + "last")
    (tmp_path / "b.txt").write_text(f"Wait Events  \nh\nh\nh\na\n{END[10]}\n")
    (tmp_path / "c.txt").write_text(head + f"Wait Events  \n{END[10]}\nWait Events  \nh\nh\nh\n\n{END[10]}\nBackground Wait Events  \n{END[10]}")
    for name in "abc":
        version, want = plain((tmp_path / f"{name}.txt").read_text())
        got = {}
        for r in read(spark, str(tmp_path / f"{name}.txt"))[1].orderBy("at").collect():
            got.setdefault(r["section"], []).append(r["line"])
        assert got == want and (name != "b" or (version, got) == (None, {}))
    assert read(spark, str(tmp_path / "a.txt"))[1].where("section = 'foreground events'").count() == 5


def test_wrapped_names_and_offset_columns(spark):
    rows = [("f", 10, "background events", k, x) for k, x in enumerate(["  ------ --- ---", "  a long  12  34", "  name", "  end", "  b      1,5", "", "  c       1   2"])]
    df = spark.createDataFrame(rows, "file string, version int, section string, at int, line string")
    assert [r["cells"] for r in rs.cells(df).orderBy("at").collect()] == [["a long name end", "12", "34"], ["b", "1,5", ""], ["c", "1", "2"]]


@pytest.mark.parametrize(("db", "elapsed", "cpus", "aas", "busy"), [("32.19", "2.00", "16", 16.0, False), ("33.99", "2", "16", 16.9, True), ("1,000.00", "3.00", None, 333.3, None), ("5.0", "0.00", "1", None, None)])
def test_sessions_are_cut_not_rounded(spark, db, elapsed, cpus, aas, busy):
    f = spark.sql(f"select 'x' as file, {', '.join(f'cast(null as decimal(24,4)) as {c}' for c in [*rs.PROFILE.values(), *rs.OS.values(), *rs.ACTIVITY.values()])}")
    num = lambda x: rs.number(__import__("pyspark.sql.functions", fromlist=["lit"]).lit(x))
    out = rs.figures(f.withColumns({"db_time": num(db), "elapsed": num(elapsed), "cpus": num(cpus)})).first()
    assert (out["aas"], out["busy"]) == (aas, busy) and out["total_mib"] is None


def test_throughputs_are_rounded_each(spark):
    from pyspark.sql import functions as F

    one = spark.range(1).select(rs.mib(F.lit(5242).cast("decimal(24,4)")).cast("double"), rs.mib(F.lit(5243).cast("decimal(24,4)")).cast("double"), rs.mib(rs.number(F.lit("1.5E+10"))).cast("double")).first()
    assert tuple(one) == (0.0, 0.01, 14305.11)
    # cut off after six decimals, then half a hundredth is added: 5,242.88 bytes are 0.005 MiB
    assert spark.range(1).select(rs.rounded(rs.ratio(F.lit(2).cast("decimal(24,4)"), F.lit(3).cast("decimal(24,4)"), 7) * 1000, 3).cast("double")).first()[0] == 666.667


def test_keys_and_values(spark):
    lines = ["Elapsed:    30.50 (mins)", " Redo size (bytes):  1,200.7   3", "Big: 1.5E+10", "Minus: -3", "no number: x", "time 10:20", "a:b: 1", "x: 1.2.3"]
    df = spark.createDataFrame([("f", x) for x in lines], "file string, line string")
    assert sorted((r["key"], r["value"]) for r in reports.key_values(df).collect()) == [("Big", 1.5e10), ("Elapsed", 30.5), ("Minus", -3.0), ("Redo size (bytes)", 1200.7), ("time 10", 20.0)]
