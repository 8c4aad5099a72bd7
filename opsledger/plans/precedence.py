"""Which rule masks a column, and what it falls back to, told from a profile of the data.

A column's rules go in a fixed order: an exclusion, the least length of its identifier, a document
by type, kept ends, an IBAN, else the identifier's mask. Where a database would run into an error
and try something else, the profile tells beforehand: masked values that collide in a column whose
values are all different, masked values too long for the column, inputs too long for a mask.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsledger.functions import masks
from opsledger.plans.masking import without_collisions

TEXT = ("CHAR", "VARCHAR", "NCHAR", "NVARCHAR")
PLAIN, MOST = 4000, 32767  # characters that a mask takes in a statement, and by the dispatcher
# what the last fallback maps letters and digits to: fixed values
LETTERS, KEYS, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "QWERTYUIOPASDFGHJKLZXCVBNM", "0123456789"


@dataclass(frozen=True)
class Target:
    """A column to mask: its identifier, the one that an exception forces, an exception's action, special rules, declared kind and length. ``by``: the column that holds a document's type."""

    owner: str
    table: str
    column: str
    identifier: str
    kind: str = "VARCHAR"
    length: int | None = None
    forced: str | None = None
    action: str | None = None
    rules: tuple[str, ...] = field(default=())
    by: str | None = None

    @property
    def final(self) -> str:
        return (self.forced or self.identifier).strip().upper()


def least_length(identifier: Column) -> Column:
    return F.coalesce(*[F.when(F.upper(identifier).contains(k), v) for k, v in masks.LEAST_LENGTH.items()], F.lit(1))


def rule_of(t: Target) -> Column:
    """The step that masks the column, or says that it isn't masked."""
    text, length = F.lit(t.kind in TEXT), F.lit(t.length or 0)
    out = F.when(F.lit((t.action or "").strip().upper() == "EXCLUDE"), "SKIP_EXCLUDE").when(text & (length < least_length(F.lit(t.final))), "SKIP_AUTO_LEN")
    for name, step in (("DOC_BY_TYPE", "BY_TYPE"), ("KEEP_ENDS", "KEEP_ENDS"), ("IBAN", "IBAN")):
        out = out.when(F.lit(name in t.rules), step)
    return out.otherwise("GENERIC")


def first_mask(t: Target, x: Column) -> Column:
    """The value by the target's own rule, before any fallback."""
    if "DOC_BY_TYPE" in t.rules:
        return masks.document(x, F.col(t.by) if t.by else F.lit(None).cast("int"))
    if "KEEP_ENDS" in t.rules:
        return masks.keep_ends(x)
    limit = t.length if t.kind in TEXT else None
    if "IBAN" in t.rules:
        return masks.fit(masks.iban(x, "IBAN_SPECIAL"), limit)
    return masks.fit(masks.mask(t.final, x), limit)


def _told(x: Column) -> Column:
    """128 bits for a value, so that no long text is shuffled to be counted; null for null."""
    return F.when(x.isNotNull(), F.struct(F.xxhash64(x).alias("h"), F.xxhash64(F.lit(1), x).alias("g")))


def profile(df: DataFrame, targets: list[Target]) -> DataFrame:
    """A row for each of one table's ``targets``, from one pass over ``df``: filled and different values, the longest, and how many different and how long masked ones are."""
    raw = {c: f"x{k}" for k, c in enumerate(dict.fromkeys(t.column for t in targets))}
    values = df.select(*[F.col(c).cast("string").alias(x) for c, x in raw.items()], *[first_mask(t, F.col(t.column).cast("string")).alias(f"y{k}") for k, t in enumerate(targets)])
    # each value is worked out once, and goes on as a narrow row of its column, a hash and a length; equal ones meet before any is counted
    names = [*raw.values(), *[f"y{k}" for k in range(len(targets))]]
    values = values.select(*[_told(F.col(n)).alias(n) for n in names], *[F.length(n).alias(f"n_{n}") for n in names])
    cells = values.select(F.inline(F.array(*[F.struct(F.lit(k).alias("c"), F.col(f"{n}.h").alias("h"), F.col(f"{n}.g").alias("g"), F.col(f"n_{n}").alias("size")) for k, n in enumerate(names)]))).where("h is not null")
    each = cells.groupBy("c", "h", "g").agg(F.count("*").alias("n"), F.max("size").alias("size"))
    counts = each.groupBy("c").agg(F.sum("n").alias("filled"), F.count("*").alias("different"), F.max("size").alias("longest"))
    sides = [F.struct(F.lit(k).alias("k"), F.lit(own).alias("own"), F.lit(names.index(n)).alias("c")) for k, t in enumerate(targets) for own, n in ((True, raw[t.column]), (False, f"y{k}"))]
    told = df.sparkSession.range(1).select(F.inline(F.array(*sides))).join(counts, "c", "left")
    of = lambda own, n: F.max(F.when(F.col("own") == own, F.col(n)))
    told = told.groupBy("k").agg(of(True, "filled").alias("filled"), of(True, "different").alias("different"), of(True, "longest").alias("longest"), of(False, "different").alias("masked_different"), of(False, "longest").alias("masked_longest"))
    known = lambda t: F.struct(*[F.lit(v).alias(n) for n, v in (("owner", t.owner), ("tab", t.table), ("col", t.column), ("identifier", t.final), ("kind", t.kind))], F.lit(t.length).cast("int").alias("length"), rule_of(t).alias("step"))
    some = lambda n: F.coalesce(n, F.lit(0).cast("long")).alias(n)
    return told.sort("k").withColumn("t", F.array(*map(known, targets))[F.col("k")]).select("t.*", some("filled"), some("different"), "longest", some("masked_different"), "masked_longest")


def fallback() -> Column:
    """Over rows of ``profile``: what happens instead of the step's own rule, null where it holds.

    An input too long for the mask goes by the dispatcher, or, beyond what that takes, by a cipher
    or a constant template, as the identifier says; a masked value too long for the column excludes
    it, and so do collisions, but in texts, which get ends of their own.
    """
    text = F.col("kind").isin(*TEXT) & (F.coalesce("length", F.lit(0)) > 0)
    has = lambda *names: reduce(lambda a, b: a | b, [F.col("identifier").contains(n) for n in names])
    last = F.when(has("NAME", "PERSONAL"), "CIPHER_LETTERS").when(has("ADDRESS"), "TEMPLATE_ADDRESS").when(has("EMAIL"), "TEMPLATE_EMAIL").when(has("PHONE"), "TEMPLATE_PHONE").otherwise("CIPHER")
    return (
        F.when(F.col("step").startswith("SKIP"), None)
        .when((F.col("longest") > PLAIN) & ~text, "SKIP_BUFFER")
        .when(F.col("longest") > MOST, last)
        .when(F.col("longest") > PLAIN, "DISPATCHER")
        .when(text & (F.col("masked_longest") > F.col("length")), "SKIP_TOO_LONG")
        .when((F.col("filled") == F.col("different")) & (F.col("masked_different") < F.col("different")), F.when(text, "COLLISION").otherwise("SKIP_COLLISION"))
    )


def decided(tables: dict[str, DataFrame], targets: list[Target]) -> DataFrame:
    """Profiles of all ``targets`` with ``fallback``; a table is read once."""
    per = {n: [t for t in targets if t.table == n] for n in sorted({t.table for t in targets})}
    return reduce(DataFrame.unionByName, [profile(tables[n], ts) for n, ts in per.items()]).withColumn("fallback", fallback())


def applied(df: DataFrame, targets: list[Target], key: str, decisions: DataFrame) -> DataFrame:
    """``df``, one table, masked as ``decisions`` say: a row a target comes to the driver. ``key`` tells rows apart; no target may name it."""
    told = {(r["owner"], r["tab"], r["col"]): r for r in decisions.collect()}
    h = lambda n: F.pmod(F.xxhash64(key), F.lit(n))
    new, apart = {}, []
    for t in targets:
        r, x = told[t.owner, t.table, t.column], F.col(t.column).cast("string")
        fb = r["fallback"] or ""
        if r["step"].startswith("SKIP") or fb.startswith("SKIP"):
            continue
        if fb == "DISPATCHER":
            y = masks.mask(t.final, x)
        elif fb.startswith("CIPHER"):
            more = DIGITS if fb == "CIPHER" else ""
            y = F.translate(F.upper(x), LETTERS + more, KEYS + more[::-1])
        elif fb == "TEMPLATE_ADDRESS":
            y = F.concat(F.lit(f"{masks.STREETS[0]} {masks.NAMES[0]} N "), h(999).cast("string"), F.lit(f", {masks.CITIES[0]}"))
        elif fb == "TEMPLATE_EMAIL":
            y = F.concat(F.lit("user"), h(1_000_000).cast("string"), F.lit("@example.com"))
        elif fb == "TEMPLATE_PHONE":
            y = F.concat(F.lit("6"), F.lpad(h(100_000_000).cast("string"), 8, "0"))
        else:
            y = first_mask(t, x)
        if fb == "COLLISION":
            apart.append(t.column)
        new[t.column] = F.when(x.isNotNull(), masks.fit(y, t.length if t.kind in TEXT else None))
    out = df.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])
    for c in apart:
        out = without_collisions(out, c, key)
    return out
