"""Filter audits, whitening and neighbour search against plain versions."""

import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsledger.llm import interactions, multiindex, whitening

D = "/root/testdata/sf0.001"
GOOD = " ".join(f"word{i}" for i in range(120))
DOCS = [
    (1, None, "en", 1), (2, "", "en", 1), (3, GOOD, None, 1), (4, GOOD, "", 1), (5, GOOD + " #", "en", 1), (5, GOOD + " #", "en", 1), (6, GOOD + " #", "de", 1), (None, GOOD, "en", 1), (None, None, "de", 1),
    (7, "a " * 300, "en", 1), (8, GOOD.upper(), "fr", 1), (9, "Ünï\x0b\x0c\r\t$ 日本", "fr", 1), (10, "x" * 3_000_000, "en", 1),
]
LABELS = [(3, 1, 0), (4, 1, 1), (4, 0, 0), (5, 0, 1), (7, 1, None), (None, 1, 1), (99, 1, 1)]


def plain_audit(docs, labels):
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, x in labels if x == 1 and i is not None}
    least = {}
    for i, x, _ in docs:
        if i is not None:
            least[x or ""] = min(least.get(x or "", i), i)
    rows = []
    for i, x, lang in docs:
        x = x or ""
        words = re.findall("[^\x20\x09-\x0d]+", x)
        fails = (len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", x)) > 10 * len(x), bool(re.search("[#$%&*|]", x)), i is not None and least[x] < i)
        rows.append((lang or "", dict(zip("ABCDE", fails, strict=True)), i in good, i in toxic))
    out, shares = {}, {}
    for part in {r[0] for r in rows}:
        for order in permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            for k, f in enumerate(order):
                gone, kept = [r for r in left if r[1][f]], [r for r in left if not r[1][f]]
                mine = [r for r in rows if r[0] == part and r[1][f]]
                shares[part, f] = shares.get((part, f), 0) + len(gone)
                out[part, "".join(order), k + 1] = [len(kept), len(gone), len(mine) - len(gone), sum(sum(r[1].values()) == 1 for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone)]
                left = kept
    return {k: (*v, shares[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


@pytest.mark.parametrize("name", ["small", "odd", "empty"])
def test_audit(spark, name):
    if name == "small":
        docs, labels = (spark.read.parquet(f"{D}/{t}.parquet") for t in ("documents", "labels"))
    else:
        docs = spark.createDataFrame(DOCS if name == "odd" else [], "doc_id long, text string, lang string, n int").withColumn("part", F.lit("clash")).withColumn("digest", F.lit(1))
        labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").withColumn("n", F.lit(1))
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.select("doc_id", "text", "lang").collect()]
    got = {tuple(r)[:3]: tuple(r)[3:] for r in interactions.audited(docs, labels).collect()}
    assert got == plain_audit(rows, [tuple(r)[:3] for r in labels.select("doc_id", "quality", "toxic").collect()])
    if name == "small":
        assert len(got) == 600 * len({r[2] for r in rows})


def test_shapley_values_share_what_all_filters_remove(spark):
    out = interactions.audited(spark.read.parquet(f"{D}/documents.parquet"), spark.read.parquet(f"{D}/labels.parquet")).where("filter_order = 'ABCDE'").groupBy("part").agg(F.sum("shapley").alias("s"), F.sum("removed").alias("r")).collect()
    assert out and all(r["s"] == 120 * r["r"] for r in out)


def test_rotations_agree_with_a_library_and_keep_small_eigenvalues():
    rng = np.random.RandomState(1)
    for n in (1, 2, 7, 40):
        a = rng.randn(n, n)
        a = a @ a.T
        values, vectors = whitening.jacobi(a)
        assert np.allclose(values, np.linalg.eigvalsh(a)[::-1], rtol=1e-9, atol=1e-12 * values[0]) and np.allclose(vectors.T @ vectors, np.eye(n), atol=1e-13)
        assert np.allclose(a @ vectors, vectors * values, atol=1e-12 * values[0])
    scale = np.diag([1.0, 1e-6, 1e-12])
    a = scale @ np.array([[1, 0.5, 0.2], [0.5, 1, 0.3], [0.2, 0.3, 1]]) @ scale
    smallest = np.linalg.det(np.array([[1, 0.5, 0.2], [0.5, 1, 0.3], [0.2, 0.3, 1]])) / np.linalg.det(np.array([[1, 0.5], [0.5, 1]])) * 1e-24
    assert whitening.jacobi(a)[0][2] == pytest.approx(smallest, rel=1e-9)
    assert np.array_equal(whitening.jacobi(np.zeros((3, 3)))[0], np.zeros(3))


def plain_whitening(x, k=4):
    once = np.unique(x, axis=0)
    n, s = len(once), once.sum(axis=0)
    c = (once - s / n).astype(float)
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    return n, ((n * x - s) ** 2).sum(axis=1), ((x - s / n).astype(float) @ vectors) / np.sqrt(values), values / np.trace(c.T @ c / n)


def test_whitening(spark):
    r = whitening.op12_whitening(spark, D).toPandas()
    e = spark.read.parquet(f"{D}/embeddings.parquet").toPandas()
    x = np.floor(256 * np.array(e["embedding"].tolist(), float)).astype(np.int64)
    n, deviation, want, explained = plain_whitening(x)
    assert len(r) == 4 * len(e) and (r["n"] == n).all() and r["identity_error"].nunique() == 1 and r["identity_error"].max() < 1e-9
    got = r.pivot(index="vec_id", columns="component", values="whitened").loc[e["vec_id"]].to_numpy()
    assert np.allclose(got * np.sign((got * want).sum(axis=0)), want, atol=1e-9)
    assert (r[r["component"] == 2].set_index("vec_id").loc[e["vec_id"], "deviation"].to_numpy() == deviation).all()
    assert np.allclose(r.groupby("component")["explained"].first(), explained, rtol=1e-12)


ODD = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (2, [3.0, -1.0]), (None, [0.5, 0.25]), (4, None), (5, [None, 1.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, [1.0]), (9, []), (10, [-0.0, 0.0]), (11, [2.0, 4.0]), (12, [1e30, -1e30])]


def test_whitening_of_odd_rows(spark):
    df = spark.createDataFrame([(i, v, "e", i) for i, v in ODD], "vec_id long, embedding array<double>, whitened string, x long")
    out, w = whitening.whitened(df)
    rows = out.collect()
    assert out.columns == ["vec_id", "embedding", "x", "whitened", "deviation"] and len(rows) == 7 and w.n == 6
    assert {r["deviation"] for r in rows if r["vec_id"] == 12} == {None} and all(len(r["whitened"]) == 2 for r in rows)
    out, w = whitening.whitened(spark.createDataFrame([(i, v) for i, v in ODD if i != 12], "vec_id long, embedding array<double>"))
    x = np.array([[256, 512], [256, 512], [768, -256], [128, 64], [0, 0], [512, 1024]])
    n, deviation, want, _ = plain_whitening(x)
    got = sorted((r["deviation"], *np.abs(r["whitened"]).round(9)) for r in out.collect())
    assert n == w.n and np.allclose(got, sorted((d, *np.abs(v).round(9)) for d, v in zip(deviation, want, strict=True)), atol=1e-6)
    same, w = whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>"))
    assert [(r["whitened"], r["deviation"]) for r in same.collect()] == [([None, None], 0)] * 2 and w.identity_error is None
    flat, w = whitening.whitened(spark.createDataFrame([(i, [float(i), 0.0, 2.0 * i]) for i in range(9)], "vec_id long, embedding array<double>"))
    assert all(r["whitened"][0] is not None and r["whitened"][1:] == [None, None] for r in flat.collect()) and w.identity_error < 1e-12
    empty, w = whitening.whitened(df.limit(0))
    assert empty.count() == 0 and w is None


def plain_nearest(rows, asked, k=5):
    """(query_id, rank) -> rows of equal rank values: exact search."""
    good = [(i, np.array(v, float)) for i, v in rows if v is not None and len(v) == 2 and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    out = []
    for a, (i, v) in enumerate(good):
        if i is not None and i % asked == 0:
            others = [(-(float(v @ u) / np.linalg.norm(v) / np.linalg.norm(u)), j is None, j) for b, (j, u) in enumerate(good) if a != b]
            out += [(i, n + 1, j, -s) for n, (s, _, j) in enumerate(sorted(others, key=lambda x: (round(x[0], 12), x[1], x[2] or 0))[:k])]
    return out


def test_neighbours_of_odd_rows(spark):
    rows = [*ODD, (14, [1.0, 2.0]), (16, [2.0, 4.0]), (16, [2.0, 4.0]), (18, [1.0, 2.0]), (20, [1.0, 2.0]), (22, [1.0, 2.0]), (24, [1.0, 2.0]), (26, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, rank int, score int")
    got = sorted((tuple(r) for r in multiindex.nearest(df, "vec_id % 2 = 0").collect()), key=lambda r: (*r[:2], -r[3]))
    want = sorted(plain_nearest(rows, 2), key=lambda r: (*r[:2], -r[3]))
    assert [(a[0], a[1], round(a[3], 9)) for a in got] == [(a[0], a[1], round(a[3], 9)) for a in want]
    # equal rows tie exactly, so their ids come in order; of vectors that differ by a factor rounding decides
    assert [a[2] for a in got if a[0] == 26] == [a[2] for a in want if a[0] == 26]
    assert multiindex.nearest(df.limit(0), "vec_id % 2 = 0").count() == 0
    assert multiindex.nearest(df.where("vec_id = 18"), "vec_id % 2 = 0").count() == 0


@pytest.mark.parametrize("clustered", [False, True])
def test_neighbours_reach_the_recall(spark, clustered, monkeypatch):
    monkeypatch.setattr(multiindex, "BLOCK", 200)
    rng = np.random.RandomState(5)
    x = rng.randn(3000, 12)
    if clustered:
        x = rng.randn(300, 12)[rng.randint(0, 300, 3000)] + 0.02 * x
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = multiindex.nearest(df, "vec_id % 10 = 0").collect()
    u = x / np.linalg.norm(x, axis=1)[:, None]
    q = np.arange(0, 3000, 10)
    s = u[q] @ u.T
    s[np.arange(300), q] = -9
    exact = {(int(i), int(j)) for i, o in zip(q, np.argsort(-s, axis=1)[:, :5], strict=True) for j in o}
    assert len(got) == 1500 and len({(r["query_id"], r["vec_id"]) for r in got} & exact) >= 0.93 * 1500
    assert all(abs(r["score"] - s[r["query_id"] // 10, r["vec_id"]]) < 1e-12 for r in got)
    for i in q.tolist():
        mine = sorted((r for r in got if r["query_id"] == i), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5] and [r["score"] for r in mine] == sorted((r["score"] for r in mine), reverse=True)


def test_walks_go_by_summed_distance_and_end_early_where_neighbours_are_close():
    rng = np.random.RandomState(2)
    x = rng.randn(40, 8)[rng.randint(0, 40, 2000)] + 0.01 * rng.randn(2000, 8)
    index = multiindex.Index(multiindex.codebook(x[:, :4], 16), multiindex.codebook(x[:, 4:], 16))
    a, b = index.cells(x)
    index.sizes = np.zeros((len(index.first), len(index.second)), np.int64)
    np.add.at(index.sizes, (a, b), 1)
    da, db = index.halves(x[:3])
    for k in range(3):
        cells = list(index.walk(da[k], db[k], index.sizes.tolist()))
        sums = [da[k][i] + db[k][j] for i, j, _ in cells]
        assert sums == sorted(sums) and len({c[:2] for c in cells}) == len(cells) == (index.sizes > 0).sum() and sum(c[2] for c in cells) == 2000
    own = [np.array([c]) for c in (a * len(index.second) + b)[:200]]
    assert np.quantile(index.reach(x[:200], own), 0.9) < 400
