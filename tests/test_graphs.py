"""Closures, pre-orders, blockers, ranges and collisions against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from opsledger.operators import graphs, ranges


def plain_closure(edges, roots):
    out = {}
    for r in roots:
        level, k = {r}, 0
        while level:
            out |= {(r, n): k for n in level}
            level = {b for a, b in edges if a in level and (r, b) not in out}
            k += 1
    return out


@pytest.mark.parametrize("seed", range(3))
def test_closures_of_random_graphs(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(40), rng.randrange(40)) for _ in range(60)]
    df = spark.createDataFrame([*edges, (None, 3), (5, None)], "up int, down int")
    roots = spark.createDataFrame([(1,), (2,), (2,), (99,), (None,)], "root int")
    got = {(r["root"], r["node"]): r["depth"] for r in graphs.closure(df, roots).collect()}
    assert got == plain_closure(edges, [1, 2, 99])


def test_closures_count_nodes_not_paths(spark):
    """Eleven nodes with doubled edges have 2,047 paths, a ring has one of any length."""
    edges = [x for k in range(5) for x in ((f"a{k}", f"b{k}"), (f"a{k}", f"c{k}"), (f"b{k}", f"a{k + 1}"), (f"c{k}", f"a{k + 1}"))]
    out = graphs.closure(spark.createDataFrame(edges, "up string, down string"), spark.createDataFrame([("a0",)], "root string"))
    assert out.count() == 16 and out.where("node = 'a5'").first()["depth"] == 10
    ring = spark.createDataFrame([(k, (k + 1) % 12) for k in range(12)], "up int, down int")
    assert sorted(r["depth"] for r in graphs.closure(ring, spark.createDataFrame([(4,)], "root int")).collect()) == list(range(12))
    assert graphs.closure(ring, spark.createDataFrame([(4,)], "root int"), depth=3).count() == 4
    assert graphs.closure(ring, spark.createDataFrame([], "root int")).count() == 0


def test_long_closures_take_few_rounds(spark, monkeypatch):
    """A chain of 100 edges with rings and diamonds on it: rounds go several edges at once, and give each node's least depth."""
    edges = [(k, k + 1) for k in range(100)] + [(k + 5, k) for k in range(0, 90, 10)] + [(k, 1000 + k) for k in range(0, 100, 7)] + [(1000 + k, k + 2) for k in range(0, 100, 7)] + [(3, 3)]
    made, plain = [], graphs.stored
    monkeypatch.setattr(graphs, "stored", lambda df, *a: made.append(1) or plain(df, *a))
    got = graphs.closure(spark.createDataFrame(edges, "up int, down int"), spark.createDataFrame([(0,), (50,)], "root int"))
    assert {(r["root"], r["node"]): r["depth"] for r in got.collect()} == plain_closure(edges, [0, 50])
    assert len(made) < 30
    limited = graphs.closure(spark.createDataFrame(edges, "up int, down int"), spark.createDataFrame([(0,)], "root int"), depth=13)
    assert {(r["root"], r["node"]): r["depth"] for r in limited.collect()} == {k: v for k, v in plain_closure(edges, [0]).items() if v <= 13}


@pytest.mark.parametrize("reach", [0, 3])
def test_closures_where_strides_are_short(spark, monkeypatch, reach):
    """Hubs whose doubled edges would be too many: the rest goes edge by edge, with the same result."""
    rng = random.Random(reach)
    edges = [(0, k) for k in range(1, 9)] + [(k, 9) for k in range(1, 9)] + [(9, k) for k in range(10, 40)] + [(rng.randrange(40), rng.randrange(60)) for _ in range(20)]
    monkeypatch.setattr(graphs, "REACH", reach)
    got = graphs.closure(spark.createDataFrame(edges, "up int, down int"), spark.createDataFrame([(0,), (9,)], "root int"))
    assert {(r["root"], r["node"]): r["depth"] for r in got.collect()} == plain_closure(edges, [0, 9])


def test_closures_keep_once_what_roots_share(spark, monkeypatch):
    """130 roots lead to one chain that 300 nodes end: the rows of all tables on the way grow with nodes and edges, not with the 43,160 pairs."""
    edges = [(1000 + k, 0) for k in range(130)] + [(k, k + 1) for k in range(30)] + [(30, 2000 + k) for k in range(300)]
    rows, plain = [], graphs.stored

    def counted(df, *a):
        out = plain(df, *a)
        rows.append(out.count())
        return out

    monkeypatch.setattr(graphs, "stored", counted)
    got = graphs.closure(spark.createDataFrame(edges, "up int, down int"), spark.createDataFrame([(1000 + k,) for k in range(130)], "root int"))
    assert {(r["root"], r["node"]): r["depth"] for r in got.collect()} == plain_closure(edges, range(1000, 1130))
    assert got.count() == 43_160 and sum(rows) < 12_000


@pytest.mark.parametrize("depth", [None, 0, 1, 5])
def test_closures_of_more_roots_than_a_set_holds(spark, depth):
    """150 of 200 nodes are roots, among them some on cycles, some without edges of their own, some without any; all pairs once."""
    rng = random.Random(5)
    edges = [(rng.randrange(160), rng.randrange(200)) for _ in range(220)]
    roots = rng.sample(range(200), 149) + [-7]
    got = graphs.closure(spark.createDataFrame([(f"n{a}", f"n{b}") for a, b in edges], "up string, down string"), spark.createDataFrame([(f"n{r}",) for r in roots], "root string"), depth).collect()
    want = {(f"n{a}", f"n{b}"): k for (a, b), k in plain_closure(edges, roots).items() if depth is None or k <= depth}
    assert {(r["root"], r["node"]): r["depth"] for r in got} == want and len(got) == len(want)


def plain_order(rows):
    kids = {}
    for key, up, by in rows:
        kids.setdefault(up, []).append((by, key))
    out, place = {}, 0

    def walk(key, level):
        nonlocal place
        place += 1
        mine = place
        size = 1 + sum(walk(k, level + 1) for _, k in sorted(kids.get(key, [])))
        out[key] = (level, size, mine)
        return size

    for _, key in sorted(kids.get(None, [])):
        walk(key, 1)
    return out


def test_pre_orders(spark):
    rng = random.Random(7)
    rows = [((f"o{k % 3}", k), None if k < 4 else (f"o{(p := rng.randrange(k)) % 3}", p), rng.choice("abc")) for k in range(200)]
    rows += [(("loop", 1), ("loop", 2), "a"), (("loop", 2), ("loop", 1), "a"), (("below", 1), ("loop", 1), "a"), (("lost", 1), ("none", 1), "a"), (("a.b", 300), None, "z"), (("b", 301), ("a", 300), "z")]
    df = spark.createDataFrame([(*k, *(u or (None, None)), by) for k, u, by in rows], "owner string, name int, up_owner string, up_name int, b string")
    got = graphs.pre_order(df, ["owner", "name"], ["up_owner", "up_name"], ["b"])
    assert {(r["owner"], r["name"]): (r["level"], r["size"], r["place"]) for r in got.collect()} == plain_order(rows)
    assert graphs.pre_order(df.limit(0), ["owner", "name"], ["up_owner", "up_name"], ["b"]).count() == 0
    with pytest.raises(ValueError):
        graphs.pre_order(df.unionAll(df.where("name = 1")), ["owner", "name"], ["up_owner", "up_name"], ["b"])


def test_running_sums_need_no_single_place(spark, plan_of):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), (F.col("id") % 5).alias("v"))
    out = ranges.running_sum(df, ["k"], "v", "before", [])
    want, total = {}, 0
    for k, v in sorted((i * 7919 % 1000, i % 5) for i in range(1000)):
        want[k] = total
        total += v
    assert {r["k"]: r["before"] for r in out.collect()} == want
    assert "SinglePartition" not in plan_of(out) and "SinglePartition" not in plan_of(ranges.gaps(df.withColumn("g", F.lit(1)), ["g"], "k", "v"))


def test_gaps_across_ranges(spark):
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 1, 2, None]), a := rng.randrange(4000), a + rng.choice([0, 3, 9, 400 if rng.random() < 0.05 else 2])) for _ in range(700)]
    want = set()
    for key in {r[0] for r in rows}:
        end = None
        for lo, hi in sorted(r[1:] for r in rows if r[0] == key):
            if end is not None and lo > end + 1:
                want.add((key, end + 1, lo - 1))
            end = hi if end is None else max(end, hi)
    df = spark.createDataFrame([*rows, (1, None, 5), (1, 5, None)], "k int, lo long, hi long")
    assert {tuple(r) for r in ranges.gaps(df, ["k"], "lo", "hi").collect()} == want
    one = spark.createDataFrame([(1, 5), (1, 25_007), (2, 1), (1, 5)], "k int, n long")
    assert sorted(r["missing"] for r in ranges.missing_numbers(one, ["k"], "n").collect()) == list(range(6, 25_007))


def plain_blockers(waits):
    up = {n: (None if u == n else u) for n, u in waits}
    out = {}
    for n in up:
        path = [n]
        while up.get(path[-1]) is not None and up[path[-1]] not in path:
            path.append(up[path[-1]])
        again = up.get(path[-1])
        out[n] = (path[-1], len(path), False) if again is None else (min(path[path.index(again) :]), None, True)
    return {n: (*v, sum(m != v[0] and w[0] == v[0] for m, w in out.items())) for n, v in out.items()}


@pytest.mark.parametrize("seed", range(3))
def test_final_blockers(spark, seed):
    rng = random.Random(seed)
    waits = [(k, rng.choice([None, k, 900, *[rng.randrange(60)] * 9])) for k in range(60)]
    waits += [(100 + k, 100 + (k + 1) % 7) for k in range(7)] + [(200, 103), (201, 200)] + [(300 + k, 299 + k if k else None) for k in range(70)]
    got = graphs.final_blockers(spark.createDataFrame(waits, "sid int, blocking int"), "sid", "blocking")
    assert {r["node"]: tuple(r)[1:] for r in got.collect()} == plain_blockers(waits)
    assert graphs.final_blockers(got.limit(0).select(F.col("node").alias("a"), F.col("blocker").alias("b")), "a", "b").count() == 0
    with pytest.raises(ValueError):
        graphs.final_blockers(spark.createDataFrame([(1, 2), (1, 3)], "a int, b int"), "a", "b")


def test_collisions_go_until_none_is_left(spark):
    from opsledger.plans.masking import without_collisions

    rows = [(k, ["abc", "a", None, "longer-text", f"one{k}", "abc7"][k % 6]) for k in range(60)] + [(99, "abc")]
    got = {r["k"]: r["v"] for r in without_collisions(spark.createDataFrame(rows, "k int, v string"), "v", "k").collect()}
    held = [v for v in got.values() if v is not None]
    assert len(held) == len(set(held)) and {k: v and len(v) for k, v in got.items()} == {k: v and len(v) for k, v in rows}
    assert all(got[k] == v for k, v in rows if v and v.startswith("one"))
    # 40 rows of one character, 10 digits: no way
    with pytest.raises(ValueError):
        without_collisions(spark.createDataFrame([(k, "x") for k in range(11)], "k int, v string"), "v", "k")
