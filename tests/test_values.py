"""Dialect formats, random values and encodings on hand-picked values."""

import pytest
from pyspark.sql import functions as F

from opsledger.functions import dialect, random_values, rules


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_truncation_goes_by_decimals(spark):
    for x, digits, want in ((0.29, 2, 0.29), (1.15, 2, 1.15), (-1.157, 2, -1.15), (1234.5, -2, 1200.0), (-0.5, 0, 0.0), (2.999999, 3, 2.999)):
        assert one(spark, dialect.trunc(F.lit(x), digits)) == want


@pytest.mark.parametrize(
    ("pattern", "want"),
    [
        ("DAY", "TUESDAY  "), ("Day", "Tuesday  "), ("day", "tuesday  "), ("FMDay", "Tuesday"), ("DY", "TUE"), ("MON", "FEB"), ("Mon", "Feb"), ("MONTH", "FEBRUARY "), ("DD/MM/YYYY HH24:MI:SS", "03/02/2004 00:05:09"), ("FMDD.MM.FMMM", "3.2.02"),
        ("HH:MI am", "12:05 am"), ("HH12", "12"), ("RR", "04"), ("YYYY\"T\"Q", "2004T1"), ("DDD", "034"), ("IW", "06"), ("SSSSS", "00309"), ("\"DAY\" DD", "DAY 03"), ("", ""),
    ],
)
def test_dates_by_pattern(spark, pattern, want):
    assert one(spark, dialect.to_char(F.lit("2004-02-03 00:05:09").cast("timestamp"), pattern)) == want


def test_dates_from_texts(spark):
    for text, pattern, want in (("03-feb-04", "DD-MON-RR", "2004-02-03"), ("03-FEB-75", "DD-MON-RR", "1975-02-03"), ("2004T03", 'YYYY"T"MM', "2004-03-01"), ("12:30 PM 1/5/2001", "HH12:MI AM D/M", None)):
        got = one(spark, dialect.to_date(F.lit(text), pattern))
        assert (got and str(got)[:10]) == want


@pytest.mark.parametrize(
    ("x", "pattern", "want"),
    [(-12.5, "999.9", " -12.5"), (454, "999", " 454"), (12, "0999", " 0012"), (12454.8, "99G999D90", " 12,454.80"), (1234, "999", "####"), (0, "990", "   0"), (-5, "990.00MI", "  5.00-"), (12.5, "FM999.99", "12.5"), (7, "FM990", "7"), (12, "S999", " +12"), (None, "999", None)],
)
def test_numbers_by_pattern(spark, x, pattern, want):
    assert one(spark, dialect.number_char(F.lit(x).cast("decimal(18,4)"), pattern)) == want


def test_bytes(spark):
    x = F.lit("aéz日b")
    assert [one(spark, dialect.substrb(x, a, n)) for a, n in ((1, 3), (1, 2), (2, 3), (-1, 5), (5, 3))] == ["aé", "a", "éz", "b", "日"]
    assert [one(spark, dialect.instrb(x, w)) for w in ("z", "b", "q", "é")] == [4, 8, 0, 2] and one(spark, dialect.soundex(F.lit("Robert"))) == "R163"


def test_random_values_hang_on_key_and_column_alone(spark):
    df = spark.range(4000).select("id", random_values.text(F.col("id"), "a", 11).alias("a"), random_values.number(F.col("id"), "n", -2, 2).alias("n"))
    rows = {r["id"]: (r["a"], r["n"]) for r in df.collect()}
    again = df.sparkSession.range(4000).repartition(13, F.col("id") % 3).select("id", random_values.text(F.col("id"), "a", 11).alias("a"), random_values.number(F.col("id"), "n", -2, 2).alias("n"))
    assert rows == {r["id"]: (r["a"], r["n"]) for r in again.collect()}
    from collections import Counter

    letters = Counter(c for a, _ in rows.values() for c in a)
    mean = 11 * 4000 / 26
    assert set(letters) == set("abcdefghijklmnopqrstuvwxyz") and sum((n - mean) ** 2 / mean for n in letters.values()) < 60  # chi-square of 25 degrees
    tenths = Counter(int((n + 2) / 0.4) for _, n in rows.values())
    assert all(-2 <= n < 2 for _, n in rows.values()) and sum((n - 400) ** 2 / 400 for n in tenths.values()) < 35 and len({a for a, _ in rows.values()}) == 4000
    other = spark.range(4000).select(random_values.text(F.col("id"), "b", 11).alias("a")).collect()
    assert not {r["a"] for r in other} & {a for a, _ in rows.values()} and one(spark, random_values.text(F.lit(None).cast("long"), "a", 0)) == ""


def plain_code(n, width):
    out = ""
    while n is not None:
        out += "abcdefghijklmnopqrstuvwxyz"[n % 25 + 1]
        n = int(n / 25 + 0.5) if n >= 25 else 0
        if n == 0:
            break
    return out.rjust(width, "a")[:width]


def test_letter_codes(spark):
    for n in (None, 0, 1, 24, 25, 37, 38, 624, 625, 99999, 10**12):
        assert one(spark, random_values.encoded(F.lit(n).cast("long"), 6)) == plain_code(n, 6)


def plain_number(x, form):
    if x is None:
        return None
    total, unit = 0, 1
    for k in range(min(len(x), len(form)) - 1, -1, -1):
        if x[k] not in form[k]:
            return total
        total, unit = total + form[k].index(x[k]) * unit, unit * len(form[k])
    return total


def test_numbers_of_forms(spark):
    form = ["BC", "xyz", "0123456789", "0123456789"]
    for x in ("Bx07", "Cz99", "C?12", "Cz9-", "Cz", "C", "", None, "Cz991", "Bx00"):
        assert one(spark, rules.form_number(F.lit(x).cast("string"), form)) == plain_number(x, form)
    back = spark.range(600).select("id", rules.form_number(rules.number_form(F.col("id"), form), form).alias("n"), rules.number_form(F.col("id"), form).alias("x")).collect()
    assert all(r["id"] == r["n"] for r in back) and back[0]["x"] == "Bx00" and back[599]["x"] == "Cz99"


def test_ciphers_over_whole_small_domains(spark):
    from opsledger.functions.masks import feistel

    got = spark.range(1000).select("id", feistel(F.col("id"), 1000, "k").alias("e"), feistel(F.col("id"), 1000, "j").alias("f")).collect()
    assert sorted(r["e"] for r in got) == sorted(r["f"] for r in got) == list(range(1000))
    assert sum(r["e"] == r["id"] for r in got) < 20 and sum(r["e"] == r["f"] for r in got) < 20
    form = ["AB", "0123456789", "xyz"]
    got = spark.range(60).select(rules.number_form(F.col("id"), form).alias("x")).select("x", rules.text_fpe(F.col("x"), form, "k").alias("e"))
    assert {r["e"] for r in got.collect()} == {r["x"] for r in got.collect()} and got.where("x = e").count() < 10


def test_identifiers_find_their_masks(spark):
    """Exact names, names that hold one, bank columns by their value, free text for the rest."""
    from opsledger.functions import masks

    df = spark.createDataFrame([("12345678Z",), ("ES9121000418450200051332",), ("Some Name 7",), (None,), ("",)], "x string")
    x = F.col("x")
    pairs = [(f"{a}{k}{b}", f) for k, f in masks.EXACT.items() for a, b in (("", ""), ("MY_", ""), ("", "_2"), ("old ", " x"))] + [("THE_BANK", masks.bank), ("unknown", masks.free_text), ("", masks.free_text)]
    rows = df.select(*[masks.mask(i.lower(), x).eqNullSafe(f(x)).alias(str(n)) for n, (i, f) in enumerate(pairs)]).collect()
    assert all(all(r) for r in rows)
    assert df.select(masks.bank(x).eqNullSafe(masks.iban(x)).alias("b")).collect()[1]["b"] and [r[0] for r in df.select(masks.fit(masks.free_text(x), 3)).collect()] == ["MAS", "MAS", "MAS", None, "MAS"]


def checked(spark, name, folder, tables):
    """Rows of a query over ``tables`` (name: (rows, schema)), and those of its SQL."""
    import duckdb

    from opsledger import catalog

    db = duckdb.connect()
    for table, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{table}.parquet")
        db.execute(f"create view {table} as select * from '{folder}/{table}.parquet/*.parquet'")
    want = db.execute(catalog.CHECKS[name])
    cols = [c[0] for c in want.description]
    return sorted(tuple(r[c] for c in cols) for r in catalog.QUERIES[name](spark, str(folder)).collect()), sorted(want.fetchall())


def test_numbers_between_minus_one_and_zero_keep_their_sign(spark, tmp_path):
    rows = [(k, x) for k, x in enumerate((-0.5, -0.99, -0.01, -0.001, 0.0, 0.5, -1.0, -12.34, 9999.99))]
    got, want = checked(spark, "number_formats", tmp_path, {"customer": (rows, "c_custkey long, c_acctbal double")})
    assert got == want and "-0" in {r[2] for r in got}


def test_anti_join_sees_every_order(spark, tmp_path):
    orders = [(1, "O", "5-LOW"), (2, "F", "1-URGENT"), (None, "F", "1-URGENT")]
    got, want = checked(spark, "anti_join", tmp_path, {"customer": ([(1,), (2,), (3,)], "c_custkey long"), "orders": (orders, "o_custkey long, o_orderstatus string, o_orderpriority string")})
    assert got == want == [(3,)]


def test_spread_counts_customers_beyond_five_digits(spark, tmp_path):
    from datetime import datetime

    keys = [*range(40), *range(100_000, 100_040), 5_400_000]
    got, want = checked(spark, "encryption_spread", tmp_path, {"customer": ([(k,) for k in keys], "c_custkey long"), "orders": ([(datetime(1995, 1, d),) for d in range(1, 31)], "o_orderdate timestamp_ntz"), "part": ([(k,) for k in range(500)], "p_partkey long")})
    assert [r[:3] for r in got] == [r[:3] for r in want]
