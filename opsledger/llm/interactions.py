"""How filters interact: what each removes, alone and in every order, by inclusion-exclusion.

Of k filters only 2^k numbers a part are counted: for each set of filters, how many documents
fail all of it, as sums of products of their failure flags. Everything else follows without
another look at the documents. The Möbius inversion of those counts gives the survivors of each
set, and so what is left after each step of any order; the counts of the sets that hold a filter,
with alternating signs, give what it alone removes. The Harsanyi dividend of a set in the game
"how many do these filters remove" is its joint count, with the sign of its size; a filter's
Shapley value is the sum of its sets' dividends, each shared among the set's members.
"""

from __future__ import annotations

import json
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsledger.llm.common import table

FILTERS = "ABCDE"
WEIGHTS = ("n", "good", "toxic")
WORDS = "[^ \\t-\\r]+"


def text_flags(text: str) -> list[Column]:
    """Failures A to D of a text and its digest, as columns; a null text counts as an empty one."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.regexp_extract_all(t, F.lit(WORDS), F.lit(0))
    n = F.size(words)
    return [
        (n < 100).alias("a"),
        (100 * F.size(F.array_distinct(words)) < 80 * n).alias("b"),
        (100 * F.regexp_count(t, F.lit("[A-Z]")) > 10 * F.char_length(t)).alias("c"),
        t.rlike("[#$%&*|]").alias("d"),
        F.unhex(F.sha2(t, 256)).alias("digest"),
    ]


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, a, b, c, d, and n, good, toxic with repeat_n, repeat_good, repeat_toxic): documents counted by language, equal texts as one row a language.

    ``repeat_``: those of them that fail E, as a smaller id anywhere has the text. An id is
    looked up in ``labels`` once, whatever its rows there: good if one has quality 1, toxic if
    one has toxic 1. Rows that repeat an id count each, and don't make each other repeats; a row
    without an id is never a repeat, makes none, and has no label.
    """
    part = F.coalesce("lang", F.lit("")).alias("part")
    rows = docs.select("doc_id", part, *text_flags("text"))
    # rows of one id and text first, so that neither a hot text nor a hot id reaches a join
    rows = rows.groupBy("doc_id", "digest", "part", "a", "b", "c", "d").agg(F.count("*").alias("n"))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("of")).agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    spread = F.coalesce("doc_id", F.xxhash64("digest"))  # null ids would meet in one task
    rows = rows.join(marks, (spread == F.col("of")) & F.col("doc_id").isNotNull(), "left")
    rows = rows.select("doc_id", "digest", "part", "a", "b", "c", "d", "n", *[F.when(F.col(w), F.col("n")).otherwise(0).alias(w) for w in ("good", "toxic")])
    known = F.col("doc_id").isNotNull()
    same = rows.groupBy("digest", "part", "a", "b", "c", "d").agg(
        F.min(F.when(known, F.struct("doc_id", *WEIGHTS))).alias("first"),
        *[F.sum(w).alias(w) for w in WEIGHTS],
        *[F.sum(F.when(known, F.col(w)).otherwise(0)).alias(f"known_{w}") for w in WEIGHTS],
    )
    # a digest has one row a language by now
    least = same.groupBy("digest").agg(F.min("first.doc_id").alias("least"))
    same = same.join(least, "digest")
    own = F.col("first.doc_id") == F.col("least")
    return same.select("part", "a", "b", "c", "d", *WEIGHTS, *[(F.col(f"known_{w}") - F.when(own, F.col(f"first.{w}")).otherwise(0)).alias(f"repeat_{w}") for w in WEIGHTS])


def joint_failures(rows: DataFrame, flags: list[str], repeat: str | None = None) -> DataFrame:
    """(part, and for each of WEIGHTS an array): at place s, how much weight fails all filters of the set s, whose bits are ``flags`` in order.

    ``repeat`` names a last filter, which isn't a flag but a share of each row's weights.
    """
    sums = {w: [] for w in WEIGHTS}
    for s in range(1 << (len(flags) + bool(repeat))):
        product = F.lit(1)
        for k, f in enumerate(flags):
            if s >> k & 1:
                product = product * F.col(f).cast("int")
        for w in WEIGHTS:
            sums[w].append(F.sum(product * F.col(f"{repeat}_{w}" if repeat and s >> len(flags) & 1 else w)))
    return rows.groupBy("part").agg(*[F.array(*x).alias(w) for w, x in sums.items()])


def signed_sum(joint: str, sets: dict[int, int]) -> Column:
    """Sum of the entries of ``joint`` at ``sets``, each times its factor."""
    out = F.lit(0).cast("long")
    for s, times in sets.items():
        out = out + F.col(joint)[s] * times
    return out


def audit(joint: DataFrame, filters: str = FILTERS) -> DataFrame:
    """A row per part, order of the filters and step: filter_order, step, and what the step's filter does there, from the counts of ``joint_failures``.

    kept: left after the step; removed: by it; redundant: failing it, but removed earlier;
    unique_fails: failing it only; good_lost and toxic_lost: labelled ones among the removed;
    shapley: what the filter removes, summed over all orders.
    """
    k = len(filters)
    sets = range(1 << k)
    sign = lambda s: (-1) ** s.bit_count()
    left = {w: F.array(*[signed_sum(w, {s: sign(s) for s in sets if s & u == s}) for u in sets]) for w in WEIGHTS}
    dividends = [{s: -sign(s) for s in sets if s >> b & 1} for b in range(k)]
    unique = F.array(*[signed_sum("n", d) for d in dividends])
    shapley = F.array(*[signed_sum("n", {s: x * (factorial(k) // s.bit_count()) for s, x in d.items()}) for d in dividends])
    steps = []
    for order in permutations(range(k)):
        before = 0
        for step, b in enumerate(order, 1):
            steps.append({"filter_order": "".join(filters[i] for i in order), "step": step, "b": b, "own": 1 << b, "before": before, "after": before | 1 << b})
            before |= 1 << b
    orders = F.inline(F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order: string, step: int, b: int, own: int, before: int, after: int>>"))
    parts = joint.select("part", F.col("n").alias("failing"), *[x.alias(f"left_{w}") for w, x in left.items()], unique.alias("unique"), shapley.alias("shares"))
    gone = lambda w: F.col(f"left_{w}")[F.col("before")] - F.col(f"left_{w}")[F.col("after")]
    return parts.select("*", orders).select(
        "part", "filter_order", "step", F.col("left_n")[F.col("after")].alias("kept"), gone("n").alias("removed"), (F.col("failing")[F.col("own")] - gone("n")).alias("redundant"),
        F.col("unique")[F.col("b")].alias("unique_fails"), gone("good").alias("good_lost"), gone("toxic").alias("toxic_lost"), F.col("shares")[F.col("b")].alias("shapley"),
    )


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of filters A to E over ``docs`` (doc_id, text, lang), a part per language, null and empty ones as one.

    Null texts count as empty ones; an empty table has no parts; columns besides those and the
    labels' quality and toxic play no part. Equal texts are told by SHA-256.
    """
    return audit(joint_failures(failures(docs, labels), ["a", "b", "c", "d"], "repeat"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
