"""Precedence, fallbacks and dependencies of masking plans."""

import pytest
from pyspark.sql import functions as F

from opsledger.plans import dependencies, masking, precedence
from opsledger.plans.precedence import Target


@pytest.fixture(scope="module")
def people(spark):
    rows = [(k, f"Person {k}", "x" * n, f"{k % 7:08d}Z", k) for k, n in ((1, 5), (2, 9), (3, 5000), (4, 40000))] + [(5, None, None, None, 5)]
    return spark.createDataFrame(rows, "id int, name string, notes string, doc string, code int").withColumn("short", F.col("code").cast("string"))


def decide(people, *targets):
    return [(r["step"], r["fallback"]) for r in precedence.decided({"people": people}, list(targets)).collect()]


def test_order_of_rules(people):
    every = ("IBAN", "KEEP_ENDS", "DOC_BY_TYPE")
    target = lambda **how: Target("o", "people", "doc", **({"identifier": "NATIONAL_ID", "length": 30} | how))
    got = decide(people, target(action="EXCLUDE", length=1, rules=every), target(length=7, rules=every), target(rules=every), target(rules=("IBAN", "KEEP_ENDS")), target(rules=("IBAN",)), target(), target(length=None), target(length=None, kind="CLOB"), target(length=7, forced=" name "))
    assert [x for x, _ in got] == ["SKIP_EXCLUDE", "SKIP_AUTO_LEN", "BY_TYPE", "KEEP_ENDS", "IBAN", "GENERIC", "SKIP_AUTO_LEN", "GENERIC", "GENERIC"]


def test_fallbacks(people):
    target = lambda c, i, **how: Target("o", "people", c, i, **how)
    got = decide(
        people, target("notes", "FREE_TEXT", kind="CLOB"), target("notes", "CUSTOMER_NAME", length=50), target("notes", "EMAIL", length=50), target("notes", "PHONE", length=50), target("notes", "ADDRESS", length=50), target("notes", "OTHER", length=50),
        target("name", "NAME", length=5, rules=("KEEP_ENDS",)), target("name", "FREE_TEXT", length=20), target("short", "FREE_TEXT", kind="NUMBER"), target("name", "NAME", length=40),
    )
    assert [y for _, y in got] == ["SKIP_BUFFER", "CIPHER_LETTERS", "TEMPLATE_EMAIL", "TEMPLATE_PHONE", "TEMPLATE_ADDRESS", "CIPHER", "SKIP_TOO_LONG", "COLLISION", "SKIP_COLLISION", None]
    less = people.where("id <> 4")
    assert decide(less, target("notes", "OTHER", length=50)) == [("GENERIC", "DISPATCHER")]


def test_masks_are_applied_as_decided(people):
    targets = [Target("o", "people", "notes", "OTHER", length=50), Target("o", "people", "name", "FREE_TEXT", length=20), Target("o", "people", "doc", "NATIONAL_ID", length=3), Target("o", "people", "short", "NAME", length=9, action="EXCLUDE")]
    told = precedence.decided({"people": people}, targets)
    out = {r["id"]: r for r in precedence.applied(people, targets, "id", told).collect()}
    assert out[4]["notes"] == "B" * 50 and out[1]["notes"] == "BBBBB" and out[5]["notes"] is None
    names = [out[k]["name"] for k in range(1, 5)]
    assert len(set(names)) == 4 and all(x.startswith("MASKE") and len(x) == 11 for x in names)
    assert out[1]["doc"] == "00000001Z" and out[1]["short"] == "1"


@pytest.mark.parametrize(("name", "pattern"), [("EMAIL", r"user\d+@example\.com"), ("PHONE", r"6\d{8}"), ("ADDRESS", r"TERRACE ELM N \d+, NORTHFIELD"), ("NAME", "B+")])
def test_last_fallbacks(people, name, pattern):
    import re

    target = [Target("o", "people", "notes", name, length=60)]
    out = precedence.applied(people, target, "id", precedence.decided({"people": people}, target)).where("notes is not null").collect()
    assert len(out) == 4 and all(re.fullmatch(pattern, r["notes"]) for r in out)


def test_levels_of_rules(spark):
    edges = [("a", "b"), ("b", "c"), ("a", "c"), ("c", "d"), ("x", "y"), ("y", "x"), ("y", "z"), ("s", "s"), ("a", "z2")]
    got = {(r["parent"], r["child"]): r["level"] for r in dependencies.levels(spark.createDataFrame(edges, "parent string, child string")).collect()}
    assert got == {("a", "b"): 1, ("b", "c"): 2, ("a", "c"): 1, ("c", "d"): 3, ("x", "y"): None, ("y", "x"): None, ("y", "z"): None, ("s", "s"): None, ("a", "z2"): 1}
    assert dependencies.levels(spark.createDataFrame([], "parent string, child string")).count() == 0


def test_policies_come_once(spark):
    rows = [(" fk", "o", "X ", "t2", None, None, None), ("FK", "O", "x", "t1", None, "leave", None), ("trigger", "o", "x", "t1", None, None, None), ("U", "o", "x", "t1", None, None, None), ("odd", "o", "x", "t1", " own ", None, None)]
    out = dependencies.policies(spark.createDataFrame(rows, "kind string, owner string, object string, table string, usage string, before string, after string")).collect()
    assert sorted(tuple(r) for r in out) == sorted([("FK", "O", "X", "t1", 2, "INTEGRITY", "LEAVE", "ENABLE_NOVALIDATE"), ("TRIGGER", "O", "X", "t1", 1, "OPERATION", "DISABLE", "ENABLE"), ("U", "O", "X", "t1", 2, "INTEGRITY", "REPORT", "REVIEW"), ("ODD", "O", "X", "t1", 2, "OWN", "REPORT", "NONE")])


def test_selected_columns(spark):
    c = spark.createDataFrame([("o", t, x) for t in ("A", "b", "c") for x in ("k", "v")], "owner string, table string, column string")
    x = spark.createDataFrame([("o", "A", v, "EXCLUDE", "Y") for v in ("k", "v")] + [("o", "b", "k", "EXCLUDE", "N")], "owner string, table string, column string, action string, active string")
    assert sorted(tuple(r) for r in masking.selected(c, x, "a, B,", {"b": " V ,none"}).collect()) == [("A", "k", "SKIP_TABLE"), ("A", "v", "SKIP_TABLE"), ("b", "v", "MASK")]
    assert masking.selected(c, x, "", {}).count() == 0


def test_profiles_count_in_narrow_rows(spark, plan_of):
    df = spark.createDataFrame([("a", None), ("b", None), ("a", None)], "x string, y string")
    got = precedence.profile(df, [Target("o", "t", "x", "FREE_TEXT", length=30), Target("o", "t", "y", "NAME", length=30)])
    assert "Expand" not in plan_of(got)  # a row for each distinct count, as wide as all of them
    told = sorted((r["col"], r["filled"], r["different"], r["longest"], r["masked_different"], r["masked_longest"]) for r in got.collect())
    assert told == [("x", 3, 2, 1, 1, 11), ("y", 0, 0, None, 0, None)]
    assert [r["filled"] for r in precedence.profile(df.limit(0), [Target("o", "t", "x", "NAME", length=30)]).collect()] == [0]
