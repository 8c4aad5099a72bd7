"""The training-data operators against brute force, on the small tables and on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from opsledger.llm import bpe, chaining, covertree, extract, packing, quality, queries, sharding, simhash, suffix, warc

D = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i}" for i in range(30_000))
PROSE = " ".join(f"tale{i % 97}x{i}" for i in range(120))
ODD = [(1, None), (2, ""), (3, "one"), (4, "one"), (5, " \n\t "), (6, LONG), (7, LONG), (8, "a" * 5000), (9, PROSE + " end"), (10, "other start " + PROSE), (None, "no id"), (4, "one"), (11, "naïve <|endoftext|> ½ 日本 ́x  y\n z ")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "text").cache()


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, x, "extra") for i, x in ODD], "doc_id long, text string, size string").cache()


@pytest.fixture(params=["docs", "odd", "empty"])
def both(request, docs, odd):
    return {"docs": docs, "odd": odd, "empty": odd.limit(0)}[request.param]


def held(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def roots(n, pairs):
    up = list(range(n))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in pairs:
        a, b = sorted((find(i), find(j)))
        up[b] = a
    return [find(i) for i in range(n)]


def test_suffix_arrays():
    for n, top in ((1, 1), (40, 2), (3000, 3), (3000, 200)):
        a = np.random.RandomState(n).randint(0, top, n).astype(np.uint8)
        b = a.tobytes()
        assert suffix.suffix_array(a).tolist() == sorted(range(n), key=lambda i: b[i:])


@pytest.mark.parametrize("most", [2048, 2])
def test_suffix_dedup(both, most, monkeypatch):
    monkeypatch.setattr(suffix, "MOST", most)
    texts = [(x or "").encode() for _, x in held(both)]
    seen = Counter(b[i : i + 200] for b in texts for i in range(len(b) - 199))
    want = []
    for b in texts:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = True
        spans = int((np.diff(np.r_[0, gone.astype(int), 0]) == 1).sum())
        want.append((len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    got = suffix.deduplicated(both, with_text=False).select("n_bytes", "cut.n_removed", "cut.n_spans", "cut.kept_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_fingerprints_and_components(both):
    rows = held(both)

    def plain(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        if not words:
            return 0
        parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in parts]
        return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))

    f = [plain(x) for _, x in rows]
    root = roots(len(f), [(i, j) for i in range(len(f)) for j in range(i) if (f[i] ^ f[j]).bit_count() <= 2])
    least = {}
    for r, (i, _) in zip(root, rows):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    want = [(str(i), x, least.get(r)) for (i, _), x, r in zip(rows, f, root)]
    got = [(str(r["id"]), r["fingerprint"] % (1 << 64), r["component_id"]) for r in simhash.components(both).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_golay_keys_meet_within_two_bits():
    rng = np.random.RandomState(0)
    a = rng.randint(-(1 << 62), 1 << 62, 300)
    for _ in range(5):
        b = a ^ (1 << rng.randint(0, 63, 300)) ^ (1 << rng.randint(0, 63, 300))
        ka, kb = ({(r, k) for r, k in zip(*map(np.ndarray.tolist, simhash.fuzzy_keys(x)))} for x in (a, b))
        assert {r for r, _ in ka & kb} == set(range(300))


def test_full_keys_link_as_pairs_do(spark):
    rng = np.random.RandomState(1)
    base = int(rng.randint(0, 1 << 62))
    f = sorted({base ^ (1 << int(i)) ^ (1 << int(j)) for i, j in rng.randint(0, 62, (200, 2))})
    df = spark.createDataFrame([(x,) for x in f], "fp long")
    pairs = {(r["a"], r["b"]) for r in simhash.linked(df, [], small=4).collect()}
    at = {x: k for k, x in enumerate(f)}
    got = roots(len(f), [(at[a], at[b]) for a, b in pairs])
    assert got == roots(len(f), [(i, j) for i in range(len(f)) for j in range(i) if (f[i] ^ f[j]).bit_count() <= 2])


def test_quality(both, spark):
    labels = spark.read.parquet(f"{D}/labels.parquet")
    rows = held(both)
    ratio = quality.fit(both, labels)
    got = [tuple(r) for r in quality.score(both, ratio).select("doc_id", "quality_rules.*").drop("score").collect()]
    want = []
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        three = Counter(zip(w, w[1:], w[2:]))
        twice = {k + d for k in range(len(w) - 2) if three[tuple(w[k : k + 3])] > 1 for d in range(3)}
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        failed = len(w) < 50 or 100 * len(twice) > 50 * len(w)
        want.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(twice), failed))
    assert sorted((g[:7] for g in got), key=str) == sorted(want, key=str)
    assert not any(g[6] and g[7] for g in got)


def test_quality_tells_labelled_rows_apart(spark):
    d = "/root/testdata/sf0.01"
    q = quality.op3_quality_rules(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("not base_failed")
    n = {(r["quality"], r["kept"]): r["count"] for r in q.groupBy("quality", "kept").count().collect()}
    assert n[1, True] >= 0.99 * (n[1, True] + n.get((1, False), 0))
    assert n.get((0, False), 0) >= 0.9 * (n.get((0, False), 0) + n.get((0, True), 0))


def test_shards(both):
    rows = sharding.sharded(both).collect()
    assert sorted(map(str, ((r["id"], r["size"], r["text_crc32"]) for r in rows))) == sorted(map(str, ((i, len((x or "").encode()) + 1, zlib.crc32((x or "").encode())) for i, x in held(both))))
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
    assert all(sorted(r["slot"] for r in v) == list(range(len(v))) for v in by.values())
    total, texts = sum(r["size"] for r in rows), {}
    for r in rows:
        texts.setdefault((r["size"], r["text_crc32"]), []).append(r["shard"])
    assert all(len(set(v)) == 1 or size * len(v) > 0.01 * total / 8 for (size, _), v in texts.items())


def test_splitters(spark, monkeypatch):
    """Against byte counts over all rows, sorted plainly: each boundary is as near its target as its tolerance, and cuts no group that it needn't."""
    rng = np.random.RandomState(2)
    rows = [(int(h), int(g), int(n)) for h, g, n in zip(rng.randint(-(1 << 62), 1 << 62, 3000) * 2, rng.randint(-(1 << 62), 1 << 62, 3000) * 2, rng.randint(1, 500, 3000))]
    hot, small = rows[0][0], rows[1][0]
    rows += [(hot, int(g) * 2, 300) for g in rng.randint(-(1 << 62), 1 << 62, 1500)] + [(small, int(g), 60) for g in range(8)] + [rows[5]] * 4
    df = spark.createDataFrame(rows, "h long, g long, size long").cache()
    total = sum(n for *_, n in rows)
    group = 0.01 * total / 8
    got = sorted(sharding._split(df, [total * k // 8 for k in range(1, 8)], 0.001 * total / 8, group))
    low = lambda x: x + (1 << 63)
    by = Counter()
    for h, _, n in rows:
        by[low(h)] += n
    for k, cut in enumerate(got, 1):
        below = sum(n for h, g, n in rows if (low(h), low(g)) < cut)
        assert abs(below - total * k // 8) <= max(group / 2 + 500, 0.001 * total / 8)
        if any(low(h) == cut[0] and (low(h), low(g)) < cut for h, g, _ in rows):
            assert by[cut[0]] > group
    parts = df.withColumn("p", sharding._range(got)).groupBy("h").agg(F.count_distinct("p").alias("n")).where("n > 1").collect()
    assert [r["h"] for r in parts] == [hot]


def test_shards_are_even_beside_a_hot_group(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.expr("if(id % 3 = 0, 'the same text', concat('text ', id * 7919))").alias("text"))
    got = [r["s"] for r in sharding.sharded(df).groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert len(got) == 8 and max(got) - min(got) <= 0.01 * max(got)


def test_archives(spark, tmp_path):
    page = "<p>" + "x" * 1200 + "</p>"
    rows = [(1, "u1", page), (2, None, page), (3, "u\r\n3 é", page), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (None, "u", page), (3, "again", page), (7, "u", "é" * 200_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    archives = warc.write(warc.decide(df), str(tmp_path / "w"))
    for span in (1 << 20, 300):
        got = sorted(((r["page_id"], r["url"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.read(archives, span).collect()), key=str)
        want = []
        for i, u, h in rows:
            b = (h or "").encode()
            copy = h == page and i != 3
            want.append((i, u, len(b), hashlib.sha1(b).hexdigest(), "revisit" if copy else "response", 3 if copy else None))
        assert got == sorted(want, key=str)
    named = df.withColumn("digest", F.lit("mine")).withColumn("response", F.lit(7))
    assert warc.read(warc.write(warc.decide(named), str(tmp_path / "n"))).count() == len(rows)
    empty = warc.write(warc.decide(df.limit(0)), str(tmp_path / "e"))
    assert warc.read(empty).count() == 0


def test_packing(both):
    T = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    rows = packing.packed(both, P.path("word_bpe_49k.json"), window=64).collect()
    ids = [(i, [*T.encode(x or "", add_special_tokens=False).ids, 1]) for i, x in held(both)]
    want = [(str(i), s, len(p := v[s : s + 2048]), zlib.crc32(np.array(p, "<u4").tobytes()), len(v)) for i, v in ids for s in range(0, len(v), 2048)]
    assert sorted((str(r["doc_id"]), *tuple(r)[1:5]) for r in rows) == sorted(want)
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for v in by.values():
        at = 0
        for offset, n in sorted(v):
            assert offset == at
            at += n
        assert at <= 2048


def test_plain_words_need_no_pre_tokens_of_the_library():
    """Latin-1 words are told apart once, by one pass; which texts are plain is told by bytes."""
    old = re.compile("[^\\x01-\\x0a\\x0c-\\x1b\\x20-\\x7f\\xa1-\\xff]|<\\|")
    assert all(packing.plain(x) == (not old.search(x)) for x in [*map(chr, range(0x300)), "", "a<|b", "a< |b", "\ud800", "\U0001f600", "a\u0300"])
    tokenizer, ids = Tokenizer.from_file(P.path("word_bpe_49k.json")), packing.Ids(P.path("word_bpe_49k.json"))
    rng = random.Random(4)
    letters = [chr(k) for k in range(1, 0x100) if packing.plain(chr(k))]
    texts = ["".join(rng.choice(letters if rng.random() < 0.5 else "abcSTRElmdv'  .9") for _ in range(rng.randrange(60))) for _ in range(3000)]
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b, "<u4").tolist() for b in ids.encode(texts)] == want
    assert "tokenizer" not in vars(ids)  # no text went to the library whole



def test_ids_of_texts_with_control_characters():
    tokenizer, ids = Tokenizer.from_file(P.path("word_bpe_49k.json")), packing.Ids(P.path("word_bpe_49k.json"))
    marks = [*map(chr, range(256))]
    texts = [x for c in marks for x in (c, f"one{c}two", f"one {c} two", f"{c}{c}x", f"!{c}?", f"a {c}", f"1{c}'s", f"x .{c}'s {c} y")]
    for batch in (texts, *([x] for x in texts)):
        want = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(batch, add_special_tokens=False)]
        assert ids.encode(batch) == want


def test_closest_sum():
    rng = np.random.RandomState(3)
    for _ in range(50):
        lengths = rng.randint(1, 60, rng.randint(1, 12)).tolist()
        room = int(rng.randint(1, 150))
        sums = {0}
        for x in lengths:
            sums |= {s + x for s in sums if s + x <= room}
        got = packing.closest(dict(Counter(lengths)), room)
        assert sum(k * n for k, n in got.items()) == max(sums)
        assert all(n <= Counter(lengths)[k] for k, n in got.items())


def test_cover_trees(spark, monkeypatch):
    rng = np.random.RandomState(0)
    centres = rng.randn(20, 16)
    rows = [(k, (centres[rng.randint(20)] + 0.15 * rng.randn(16)).tolist(), int(k % 2)) for k in range(300)]
    rows += [(300, rows[0][1], 0), (301, None, 0), (302, [0.0] * 16, 0), (303, rows[0][1], None), (304, [float("nan")] * 16, 0), (305, [None] * 16, 0), (306, [], 1), (None, rows[2][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    rows = [tuple(r) for r in df.collect()]
    x = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if v and None not in v and np.isfinite(v).all() and any(v) and lab is not None else None for _, v, lab in rows]
    pairs = [(i, j) for i in range(len(x)) for j in range(i) if x[i] is not None and x[j] is not None and rows[i][2] == rows[j][2] and x[i] @ x[j] >= 0.93]
    n = Counter(k for p in pairs for k in p)
    root, least = roots(len(x), pairs), {}
    for r, row in zip(root, rows):
        if row[0] is not None:
            least[r] = min(least.get(r, row[0]), row[0])
    want = [(row[0], n[k], least.get(root[k]), row[0] == least.get(root[k])) for k, row in enumerate(rows)]
    for block in (covertree.BLOCK, 12):
        monkeypatch.setattr(covertree, "BLOCK", block)
        got = [(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in covertree.linked(df).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    named = df.select("*", *[F.lit("mine").alias(c) for c in ("x", "good", "k1", "n", "name", "g", "kept")])
    got = covertree.linked(named)
    assert got.columns == ["vec_id", "embedding", "label", "x", "good", "k1", "n", "name", "g", "n_links", "component_id", "kept"]
    assert {tuple(r) for r in got.select("x", "good", "k1", "n", "name", "g").collect()} == {("mine",) * 6}
    assert covertree.linked(df.limit(0)).count() == 0


def test_trees_drop_far_nodes_and_count_near_ones_whole():
    rng = np.random.RandomState(1)
    x = np.concatenate([np.repeat(rng.randn(40, 3), 20, 0) + 0.02 * rng.randn(800, 3), np.ones((600, 3)) + 0.01 * rng.randn(600, 3)])
    x /= np.linalg.norm(x, axis=1)[:, None]
    w, r, tree = rng.randint(1, 4, len(x)).astype(float), np.arange(len(x)), covertree.Tree(x)
    found = covertree.Links(tree, tree, w, w, 0.93)
    n, a, b = found.result(r, r, len(x))
    near = x @ x.T >= 0.93
    np.fill_diagonal(near, False)
    assert (n == near @ w).all() and (covertree._roots(len(x), a, b) == covertree._roots(len(x), *np.nonzero(near))).all()
    assert found.compared < near.sum() / 4  # fewer distances than links
    for k in np.flatnonzero(tree.past):
        kids = np.arange(tree.child[k], tree.past[k])
        assert tree.centre[kids[0]] == tree.centre[k] and tree.first[kids[0]] == tree.first[k] and tree.last[kids[-1]] == tree.last[k]
        assert (tree.radius[kids] <= max(1e-9, tree.radius[k])).all()


def test_bpe(both):
    T = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rows = bpe.encoded(both, P.path("byte_bpe_50k.json")).select("doc_id", "bpe.*").collect()
    want = []
    for i, x in held(both):
        ids = T.encode(x or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(T.decode(ids, skip_special_tokens=False).encode()).hexdigest(), ids))
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))
    assert bpe.encoded(both.withColumn("ids", F.lit("mine")), P.path("byte_bpe_50k.json")).columns == [*both.columns, "ids", "bpe"]


def test_main_text(spark):
    p = extract.main_text("<html><head><title>T</title></head><body><nav><a href=x>Home</a></nav><div class='cookie-notice'>We use cookies on this site to be of help.</div><main><h1>Title &amp; more</h1><p>The first of the paragraphs is long enough to be good by itself, as it is in the text.<p>Short.<ul><li>one<li>two</ul><script>var a='</p>'</script><div class=comments><p>Nice post, this is the best that I have read in all of the year.</div></main><aside>More</aside><footer>&copy; x</footer></body>")
    assert p == "Title & more\n\nThe first of the paragraphs is long enough to be good by itself, as it is in the text.\n\nShort.\n\none\n\ntwo"
    assert extract.main_text(None) == extract.main_text("") == extract.main_text("<") .replace("<", "") == ""
    df = spark.createDataFrame([(1, "u", None, "t"), (2, None, "<article><p>é\n x</p></article>", "t")], "page_id long, url string, html string, size string")
    assert [(r["text"], r["n_chars"]) for r in extract.extracted(df).orderBy("page_id").collect()] == [("", 0), ("é x", 3)]


def test_stop_words_of_a_whole_block_count():
    names = " ".join(f"Name{i}" for i in range(400))
    prose = " ".join(["it is the end of the day and all of them are here"] * 60)
    assert extract.main_text(f"<div><a href=x>{'Home ' * 30}</a></div><div>{names}<br>{prose}</div><div><a href=x>{'More ' * 30}</a></div>") == f"{names} {prose}"


@pytest.mark.parametrize("name", ["content-sidebar-wrap", "layout with-sidebar", "shareholder-letter", "legal-opinion", "research search-results", "legal", "page-header"])
def test_class_names_do_not_drop_the_text(name):
    prose = "This is the text of the page and it is long enough to be good by itself, as all of it is here."
    for inner in (f"<main><p>{prose}</p></main>", f"<article><p>{prose}</p></article>", f"<p>{prose}</p>"):
        assert extract.main_text(f"<body><nav>Home</nav><div class='{name}'>{inner}</div></body>") == prose
    page = f"<body><div class='{name}'><main><article><p>{prose}</p><div class='post-comments'><p>{prose} No.</p></div></article></main></div><div class='site-footer'>{prose}</div></body>"
    assert extract.main_text(page) == prose


def test_marked_blocks_beside_the_text_go():
    prose = "This is the text of the page and it is long enough to be good by itself, as all of it is here."
    for name in ("cookie-notice", "site-footer", "main-nav", "comments", "related-posts", "sidebar_left", "newsletter-signup"):
        assert extract.main_text(f"<body><div>{prose}</div><div id='{name}'>{prose}</div></body>") == prose
    assert extract.main_text(f"<body><article>{prose}</article><div class=related-posts><article>{prose} Other.</article></div></body>") == prose


def test_an_unclosed_head_ends_before_a_header():
    prose = "This is the text of the page and it is long enough to be good by itself, as all of it is here."
    assert extract.main_text(f"<html><head><title>T</title><body><article><header><h1>Heading</h1></header><p>{prose}</p></article></body>") == "Heading\n\n" + prose


def articles(spark, name="sf0.001"):
    """(page, its article's blocks)."""
    import html

    for r in spark.read.parquet(f"/root/testdata/{name}/pages.parquet").where("html is not null").select("html").collect():
        a = r["html"][r["html"].index("<article>") : r["html"].index("</article>")]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1|article)>", a)]
        yield r["html"], "\n\n".join(x for x in parts if x)


def test_pages_are_their_articles(spark):
    for page, text in articles(spark, "sf0.01"):
        assert extract.main_text(page) == text


def test_pages_without_their_article_tags(spark, monkeypatch):
    pages = [(re.sub("</?article>", "", page), text) for page, text in articles(spark, "sf0.01")]
    right = sum(extract.main_text(page) == text for page, text in pages)
    assert right >= 0.85 * len(pages)
    bare = [re.sub("</?nav>", "", page) for page, _ in pages]
    ruled = [*map(extract.main_text, bare)]
    monkeypatch.setattr(extract, "LINKED", 9)
    assert sum(extract.main_text(page) != was for page, was in zip(bare, ruled)) > 0.01 * len(pages)
    monkeypatch.setattr(extract, "LINKED", 0.4)
    monkeypatch.setattr(extract.density, "__defaults__", (frozenset(),))
    assert sum(extract.main_text(page) != was for page, was in zip(bare, ruled)) > 0.5 * len(pages)


def test_blocks_beside_an_article_are_judged_too():
    prose = "This is the text of the page and it is long enough to be good by itself, as all of it is here."
    page = lambda beside: f"<body><article><p>{prose}</p></article><div><p>{beside}</p></div></body>"
    assert extract.main_text(page("A few words")) == prose
    assert extract.main_text(page(prose)) == prose  # a notice or so
    assert extract.main_text(page(prose * 3)) == prose + "\n\n" + prose * 3
    assert extract.main_text(page("Lorem ipsum dolor sit amet " * 20)) == prose
    assert extract.main_text(page("".join(f"<a href=x>{prose}</a>" for _ in range(3)))) == prose


def test_two_passes():
    """Against a plain telling of the two passes, with ties, over random blocks."""
    rng = np.random.RandomState(4)
    dense, sparse, some = "it is the end of the day and all of them are here as it was in the days of old, for all", "Lorem-ipsum dolor sit-amet consectetur adipiscing elit sed eiusmod tempor incididunt", "the lorem ipsum dolor sit amet consectetur adipiscing elit sed of eiusmod tempor incididunt"
    for _ in range(400):
        found = [(t, len(t) if rng.rand() < 0.2 else 0, bool(rng.rand() < 0.15), bool(rng.rand() < 0.1)) for t in (["short", dense, sparse, some][k] for k in rng.randint(0, 4, rng.randint(0, 14)))]
        article = any(i and not b for _, _, b, i in found)
        first = []
        for t, linked, bad, inside in found:
            if bad or linked:
                first.append(False)
            elif article and not inside:  # none of these is long enough there
                first.append(None)
            else:
                first.append({"short": None, dense: True, sparse: None if inside else False, some: None}[t])
        want = []
        for k, (_, _, bad, inside) in enumerate(found):
            if first[k] is not None:
                want.append(first[k])
                continue
            near = {}
            for step in (-1, 1):
                j = k + step
                while 0 <= j < len(found) and found[j][2:] == (bad, inside):
                    if first[j] is not None:
                        near.setdefault(abs(j - k), set()).add(first[j])
                        break
                    j += step
            closest = near[min(near)] if near else set()
            want.append(closest.pop() if len(closest) == 1 else inside or not (article or any(first)))
        assert extract.labels(found) == want


def test_extraction_of_odd_tables(spark):
    prose = "This is the text of the page and it is long enough to be good by itself, as all of it is here. "
    page = f"<body><nav>{'<a href=x>Home</a>' * 20}</nav><div>{prose * 5000}</div></body>"
    rows = [(1, page, "mine", "a"), (1, page, "mine", "a"), (None, "", "mine", "b"), (2, "<p>" + "日本語の文章はここにあります。" * 9, "mine", "c")]
    df = spark.createDataFrame(rows, "page_id long, html string, _in0 string, text string")
    out = extract.extracted(df)
    assert out.columns == ["page_id", "html", "_in0", "text", "n_chars"]
    assert sorted((r["text"], r["n_chars"]) for r in out.collect()) == sorted([((prose * 5000).strip(), len(prose) * 5000 - 1)] * 2 + [("", 0), ("日本語の文章はここにあります。" * 9, 135)])
    assert extract.extracted(df.limit(0)).count() == 0


def test_passages(odd, spark):
    got = {(r["doc_id"], r["match_doc_id"], r["n_words"]) for r in chaining.shared(odd).collect()}
    assert (10, 9, 120) in got and ({(7, 6, 30_000), (6, 7, 30_000)} & got)
    assert not {i for r in got for i in r[:2]} & {1, 2, 3, 4, 5, 11, None}
    kept = {r["doc_id"]: r["text"] for r in chaining.without_passages(odd).collect()}
    assert kept[10].split() == ["other", "start"] and kept[9] == PROSE + " end" and len({6, 7} & set(kept)) == 1 and 1 in kept
    assert chaining.shared(odd.limit(0)).count() == 0
    words = [f"w{i}" for i in range(200)]
    fuzzy = [*words[:60], "changed", *words[61:110], "new", *words[110:170]]
    df = spark.createDataFrame([(1, " ".join(["x", *words])), (2, " ".join(["y", *fuzzy])), (3, " ".join(f"z{i}" for i in range(300)))], "doc_id long, text string")
    assert {(r["doc_id"], r["match_doc_id"]) for r in chaining.shared(df).collect()} == {(2, 1)}


def test_passages_find_shared_windows(docs):
    got = {i for r in chaining.shared(docs).collect() for i in (r["doc_id"], r["match_doc_id"])}
    seen = {}
    for i, x in held(docs):
        w = (x or "").split()
        for k in range(len(w) - 54):
            if len(set(w[k : k + 55])) > 25:
                seen.setdefault(tuple(w[k : k + 55]), set()).add(i)
    assert {i for s in seen.values() if len(s) > 1 for i in s} <= got


def uncovered(rows, found, least=50):
    """(id, place) of the windows of ``least`` words that a row with a smaller id has too and that no found passage holds."""
    first = {}
    for i, x in sorted(rows):
        w = (x or "").split()
        for k in range(len(w) - least + 1):
            first.setdefault(tuple(w[k : k + least]), i)
    out = []
    for i, x in rows:
        w = (x or "").split()
        own = [(r["first_word"], r["last_word"]) for r in found if r["doc_id"] == i]
        out += [(i, k) for k in range(len(w) - least + 1) if first[tuple(w[k : k + least])] != i and not any(a <= k and k + least <= b for a, b in own)]
    return out


def test_passages_whose_seeds_have_other_first_documents(spark):
    rng = np.random.RandomState(5)
    fill = lambda n: [f"f{x}" for x in rng.randint(0, 1 << 40, n)]
    rows, at = [], 100
    for n in (50, 51, 60, 75, 90):
        p = [f"p{n}x{i}" for i in range(n)]
        half = n // 2
        for part in (p[: half + 4], p[half - 4 :], p, p):
            rows.append((at, " ".join([*fill(30), *part, *fill(40)])))
            at += 1
    cycle = [f"c{i}" for i in range(7)] * 20
    rows += [(at, " ".join([*fill(9), *cycle])), (at + 1, " ".join([*cycle[3:], *fill(20)]))]
    found = chaining.shared(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert uncovered(rows, found) == []
    words = {i: x.split() for i, x in rows}
    for r in found:
        assert r["match_doc_id"] < r["doc_id"]
        if r["similarity"] == 1.0:
            assert words[r["doc_id"]][r["first_word"] : r["last_word"]] == words[r["match_doc_id"]][r["match_first_word"] : r["match_last_word"]]


def test_passages_hold_every_shared_window(docs):
    assert uncovered(held(docs), chaining.shared(docs).collect()) == []


def test_passages_reach_past_an_edit_beyond_the_last_seed(spark):
    k, e = 1379, 181  # 34 words of the passage lie beyond its last seed
    p = [f"t{k}x{i}" for i in range(200)]
    a = [*(f"a{k}x{i}" for i in range(30)), *p, *(f"b{k}x{i}" for i in range(200))]
    c = [*(f"c{k}x{i}" for i in range(30)), *p[:e], "edit", *p[e + 1 :], *(f"d{k}x{i}" for i in range(200))]
    df = spark.createDataFrame([(1, " ".join(a)), (2, " ".join(c))], "doc_id long, text string")
    got = chaining.shared(df).collect()
    assert [(r["first_word"], r["last_word"]) for r in got] == [(30, 230)]


def plain_ratio(rows, good):
    """Log ratio of each bucket, and the buckets of a text, with plain loops."""
    mask = (1 << 64) - 1

    def buckets(text):
        h = [xxhash.xxh3_64_intdigest(w.encode()) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
        pairs = [(a * 0x9E3779B97F4A7C15 + b) & mask for a, b in zip(h, h[1:])]
        return [x % quality.BUCKETS for x in [*h, *(p ^ (p >> 29) for p in pairs)]]

    raw, target = Counter(), Counter()
    for i, text in rows:
        raw.update(buckets(text))
        if i in good:
            target.update(buckets(text))
    n, m = sum(raw.values()) + quality.BUCKETS, sum(target.values()) + quality.BUCKETS
    return (lambda b: np.log((target[b] + 1) / m) - np.log((raw[b] + 1) / n)) if target else (lambda b: 0.0), buckets


def test_quality_scores(both, spark):
    labels = spark.read.parquet(f"{D}/labels.parquet")
    good = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    rows = held(both)
    ratio, buckets = plain_ratio(rows, good)
    want = []
    for i, text in rows:
        b = buckets(text)
        want.append((str(i), np.mean([*map(ratio, b)]) if b else 0.0))
    got = [(str(r["doc_id"]), r["score"], r["kept"], r["base_failed"]) for r in quality.judged(both, labels).select("doc_id", "quality_rules.*").collect()]
    for (i, x), (j, y, kept, failed) in zip(sorted(want), sorted(got), strict=True):
        assert i == j and abs(x - y) < 1e-9 and kept == (not failed and y >= quality.THRESHOLD)
    assert quality.judged(both.withColumn("n_words", F.lit("mine")), labels).columns == [*both.columns, "n_words", "quality_rules"]


def test_chains_are_the_best():
    rng = np.random.RandomState(8)
    for n in (1, 2, 15, 60):
        for _ in range(20):
            x, y = rng.randint(0, 80, n), rng.randint(0, 80, n)
            p = sorted(zip(x.tolist(), y.tolist()))
            score, back = [], []
            for i, (a, b) in enumerate(p):
                best = max(((score[j] + chaining.GAP * (c + d), j) for j, (c, d) in enumerate(p[:i]) if c < a and d < b), default=(-1e18, -1))
                gain = best[0] - chaining.GAP * (a + b)
                score.append(chaining.SEED + gain if gain > 0 else float(chaining.SEED))
                back.append(best[1] if gain > 0 else -1)
            want, used = [], set()
            for i in sorted(range(n), key=lambda i: (-score[i], i)):
                if i not in used:
                    j = first = i
                    while j >= 0 and j not in used:
                        used.add(j)
                        first, j = j, back[j]
                    want.append((p[first][0], p[i][0] + chaining.SEED, p[first][1], p[i][1] + chaining.SEED))
            assert chaining.chains(x, y) == want


def alike(a, b):
    u, v = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a, b))
    return len(u & v) / max(1, len(u | v))


def test_alignments_find_edited_passages():
    rng = np.random.RandomState(9)
    for n in (50, 60, 120, 400):
        for _ in range(15):
            p = rng.randint(0, 1 << 30, n)
            q = p.copy()
            for k in rng.choice(np.arange(24, n - 24, 50), (n - 4) // 46 - 1, replace=False) if n > 100 else ():
                q[k] = -1
            a, b = (np.concatenate([rng.randint(1 << 31, 1 << 40, 30), x, rng.randint(1 << 31, 1 << 40, 30)]).astype(np.uint64) for x in (p, q))
            found, runs = chaining.align(a, b)
            assert any(f <= 30 and e >= 30 + n for f, e, *_ in found)
            for f, e, g, h, like in found:
                assert e - f >= 50 and like >= 0.8 and abs(like - alike(a[f:e].tolist(), b[g:h].tolist())) < 1e-9
            assert all((a[f:e] == b[f:e]).all() for f, e in runs)


def check_passages(rows, found):
    """Each reported passage is one: equal windows, or alike by its five-word shingles, and in an earlier document."""
    words = {i: (x or "").split() for i, x in rows}
    for r in found:
        a = words[r["doc_id"]][r["first_word"] : r["last_word"]]
        b = words[r["match_doc_id"]][r["match_first_word"] : r["match_last_word"]]
        assert r["n_words"] == len(a) >= 50 and r["match_doc_id"] < r["doc_id"]
        windows = {tuple(b[k : k + 50]) for k in range(len(b) - 49)}
        if r["similarity"] == 1.0:
            assert all(tuple(a[k : k + 50]) in windows for k in range(len(a) - 49))
        else:
            assert abs(alike(a, b) - r["similarity"]) < 1e-9 and r["similarity"] >= 0.8


def test_passages_are_passages(docs):
    check_passages(held(docs), chaining.shared(docs).collect())


def test_fuzzy_passages_of_all_places(spark):
    """A passage of 50 to 140 words with an edit in every 50 words or so, anywhere in it."""
    rng = np.random.RandomState(11)
    fill = lambda n: [f"f{x}" for x in rng.randint(0, 1 << 40, n)]
    rows, planted = [], {}
    for k in range(120):
        n = int(rng.randint(50, 141))
        p = [f"p{k}x{i}" for i in range(n)]
        q = list(p)
        for at in range(int(rng.randint(5, 45)), n - 4, 60):
            q[at] = f"edit{k}"
        if alike(p, q) < 0.8:
            continue
        rows += [(k, " ".join([*fill(40), *p, *fill(35)])), (1000 + k, " ".join([*fill(25), *q, *fill(60)]))]
        planted[1000 + k] = (25, 25 + n)
    found = chaining.shared(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check_passages(rows, found)
    by = {}
    for r in found:
        by.setdefault(r["doc_id"], []).append((r["first_word"], r["last_word"]))
    assert all(any(a <= f + 5 and b >= e - 5 for a, b in by.get(i, [])) for i, (f, e) in planted.items())


@pytest.mark.parametrize("parts", [[(0, 33), (34, 66), (67, 100)], [(0, 50), (50, 100)], [(0, 66), (34, 100)], [(10, 60), (0, 33), (67, 100)]])
def test_fuzzy_passages_whose_parts_have_other_first_documents(spark, parts):
    """Two documents share 100 words but for two of them; every run of those is in an earlier document too."""
    rng = np.random.RandomState(3)
    fill = lambda n: [f"f{x}" for x in rng.randint(0, 1 << 40, n)]
    rows = []
    for k in range(60):
        p = [f"p{k}x{i}" for i in range(100)]
        q = [f"edit{k}x{i}" if i in (33, 66) else w for i, w in enumerate(p)]
        rows += [(10 * k + n, " ".join([*fill(30), *p[a:b], *fill(30)])) for n, (a, b) in enumerate(parts)]
        rows += [(1000 + 2 * k, " ".join([*fill(40), *p, *fill(20)])), (1001 + 2 * k, " ".join([*fill(25), *q, *fill(35)]))]
    found = chaining.shared(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check_passages(rows, found)
    held = {}
    for r in found:
        held.setdefault(r["doc_id"], set()).update(range(r["first_word"], r["last_word"]))
    whole = sum(set(range(30, 120)) <= held.get(1001 + 2 * k, set()) for k in range(60))
    assert whole >= 57


def test_crossings():
    run = lambda p, n, src, off: [(p + 9 * i, 1000 * src + p + 9 * i, src, p + 9 * i + off) for i in range(n)]
    rows = [*run(0, 4, 1, 5), *run(36, 3, 2, 40), *run(70, 1, 1, 5), *run(200, 2, 3, 0)]
    pairs = {(a, b) for _, a, b in chaining.crossings(*np.array(rows, np.int64).T)}
    assert pairs == {(a, b) for a in (18, 27) for b in (36, 45, 70)} | {(a, 70) for a in (45, 54)}
    assert len({k for k, _, _ in chaining.crossings(*np.array(rows, np.int64).T)}) == len(pairs)
    assert chaining.crossings(*np.array(run(0, 9, 1, 3), np.int64).T) == []


def test_crossings_of_many_short_runs():
    """All seeds of different runs within MARGIN words are paired, however many runs lie between them and whatever their places in them."""
    rng = random.Random(5)
    for k in range(40):
        pos = sorted(rng.sample(range(400), 60))
        rows = [(p, 7000 + p, src := rng.choice([1, 1, 1, 2, 3] if k % 2 else range(60)), p + 100 * src) for p in pos]
        run = [0]
        for a, b in zip(rows, rows[1:]):
            run.append(run[-1] + (a[2] != b[2]))
        want = {(a[0], b[0]) for i, a in enumerate(rows) for j, b in enumerate(rows) if i < j and run[i] != run[j] and b[0] - a[0] <= chaining.MARGIN}
        got = {(a, b) for _, a, b in chaining.crossings(*np.array(rows, np.int64).T, whole=True)}
        assert want <= got
        ends = {(a[0], b[0]) for i, a in enumerate(rows) for j, b in enumerate(rows) if i < j and run[i] != run[j] and run[i + 1 : j].count(run[i]) < 2 and run[i:j].count(run[j]) < 2 and rows[run.index(run[j])][0] - max(r[0] for r, n in zip(rows, run) if n == run[i]) <= chaining.MARGIN}
        assert got == want | ends
        assert {(a, b) for _, a, b in chaining.crossings(*np.array(rows, np.int64).T)} == ends


def test_one_of_each_group_stays(odd, docs):
    named = odd.withColumn("id", F.lit("mine")).withColumn("place", F.lit("too"))
    kept = simhash.keep_one(named)
    assert kept.columns == named.columns
    prints = {(str(r["id"]), r["fingerprint"], r["component_id"]) for r in simhash.components(odd).collect()}
    assert kept.count() == len({c for _, _, c in prints})
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(str(c) for c in {c for _, _, c in prints})
    assert simhash.keep_one(odd.limit(0)).count() == 0
    assert {r["doc_id"] for r in simhash.keep_one(docs).collect()} == {r["component_id"] for r in simhash.components(docs).collect()}


def plain_without(rows, found):
    out = {}
    for i, text in rows:
        b = text or ""
        at = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", b)]
        gone = np.zeros(len(b), bool)
        for r in found:
            if r["doc_id"] == i:
                gone[at[r["first_word"]][0] : at[r["last_word"] - 1][1]] = True
        out[i] = "".join(c for c, x in zip(b, gone) if not x)
    return out


# names that the stages use inside
CLASHES = "quality_rules kept _kept kept_key _place place name of id fp fingerprint component component_id d key src salt cuts held blocks salts hs first last similarity _in0 _in1 _in_d _in_text _in_spans _in_chars _d h pos row".split()


@pytest.mark.parametrize("name", ["small", "odd", "empty"])
def test_pipeline(spark, odd, name, tmp_path):
    """Each stage against its plain version, on what its predecessor kept."""
    import corpus_pipeline

    d = D
    if name != "small":
        d = str(tmp_path / name)
        full = spark.read.parquet(f"{D}/documents.parquet").where("doc_id < 40").select((F.col("doc_id") + 100).alias("doc_id"), "text")
        rows = full.unionAll(odd.select("doc_id", "text"))
        rows = rows.selectExpr("doc_id", "text", "'en' as lang", "cast(null as string) as source", "length(text) as n_chars", "'mine' as k", *[f"'mine' as {c}" for c in CLASHES])
        (rows if name == "odd" else rows.limit(0)).write.parquet(f"{d}/documents.parquet")
        spark.read.parquet(f"{D}/labels.parquet").write.parquet(f"{d}/labels.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    assert [x for x, _ in corpus_pipeline.STAGES] == ["quality rules", "near duplicates", "substring dedup", "packing"]
    columns, kept = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, d)
        assert k == 3 or out.columns == columns
        out.write.parquet(str(tmp_path / f"stage{k}"))
        kept.append(docs)
        docs = spark.read.parquet(str(tmp_path / f"stage{k}"))
    rows = held(kept[0])
    good = {r["doc_id"] for r in spark.read.parquet(f"{D}/labels.parquet").where("quality = 1").collect()}
    ratio, buckets = plain_ratio(rows, good)
    want = []
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        three = Counter(zip(w, w[1:], w[2:]))
        twice = {k + e for k in range(len(w) - 2) if three[tuple(w[k : k + 3])] > 1 for e in range(3)}
        if len(w) >= 50 and 100 * len(twice) <= 50 * len(w) and np.mean([*map(ratio, buckets(text))]) >= quality.THRESHOLD:
            want.append((i, text))
    assert sorted(held(kept[1]), key=str) == sorted(want, key=str)
    ids = {r["component_id"] for r in simhash.components(kept[1]).collect()}
    after = held(kept[2])
    assert len(after) == len(ids) and {i for i, _ in after} == ids
    cut = plain_without(after, chaining.shared(kept[2].select("doc_id", "text")).collect())
    assert sorted(held(kept[3])) == sorted((i, x) for i, x in cut.items() if x.split() or not dict(after)[i])
    assert all(r["n_chars"] == len(r["text"]) for r in kept[3].collect())
    T = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    sizes = {i: len(T.encode(x or "", add_special_tokens=False).ids) + 1 for i, x in held(kept[3])}
    packed = docs.collect()
    total = Counter()
    for r in packed:
        total[r["doc_id"]] += r["length"]
    assert total == sizes
    assert corpus_pipeline.run(spark, d).count() == len(packed)
    n = len({r["sequence_id"] for r in packed})
    assert n <= -(-sum(sizes.values()) // 2048) * 1.05 + 1  # little padding


@pytest.mark.parametrize("name", sorted(queries.CHECKS))
def test_same_rows_as_sql(spark, name):
    import duckdb

    d, db = "/root/testdata/sf0.01", duckdb.connect()
    for t in ("documents", "embeddings", "labels", "pages"):
        db.execute(f"create view {t} as select * from '{d}/{t}.parquet'")
    want = db.execute(queries.CHECKS[name])
    cols = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, d)
    assert sorted(got.columns) == sorted(cols)
    assert sorted(map(str, (tuple(r) for r in got.select(*cols).collect()))) == sorted(map(str, want.fetchall()))
