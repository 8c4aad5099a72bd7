"""Rule masks: mapping tables, ordered regular expressions, fixed values, and format-preserving encryption of texts and dates."""

from __future__ import annotations

from functools import reduce
from math import prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsledger.functions.masks import feistel


def mapping_with_rows(df: DataFrame, column: str, masked: Column, row_id: str) -> DataFrame:
    """(orig_val, new_val, row_id): a row per distinct pair with its smallest row id, and one row of nulls."""
    m = df.where(F.col(column).isNotNull()).select(F.col(column).alias("orig_val"), masked.alias("new_val"), F.col(row_id).alias("row_id")).groupBy("orig_val", "new_val").agg(F.min("row_id").alias("row_id"))
    nulls = df.sparkSession.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in m.schema])
    return m.unionByName(nulls)


def remapped(df: DataFrame, mapping: DataFrame, column: str, row_id: str) -> DataFrame:
    """``column`` by the mapping's row of the same value and row id, else by the smallest new value of that value; null where there is none."""
    exact = mapping.where("orig_val is not null").groupBy("orig_val", "row_id").agg(F.min("new_val").alias("_exact"))
    anyrow = exact.groupBy("orig_val").agg(F.min("_exact").alias("_any"))
    a = exact.select(F.col("orig_val").alias(column), F.col("row_id").alias(row_id), "_exact")
    b = anyrow.select(F.col("orig_val").alias(column), "_any")
    out = df.join(a, [column, row_id], "left").join(b, column, "left")
    return out.withColumn(column, F.coalesce("_exact", "_any")).select(*df.columns)


def by_rules(x: Column, rules: list[tuple[str, str]]) -> Column:
    """Replaces by each (pattern, replacement) in turn."""
    return reduce(lambda c, r: F.regexp_replace(c, r[0], r[1]), rules, x)


def scrubbed(x: Column, pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda c, r: F.replace(c, F.lit(r[0]), F.lit(r[1])), pairs, x)


def fixed(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Columns set to null or to a value, in their declared types."""
    return df.select(*[F.lit(values[f.name]).cast(f.dataType).alias(f.name) if f.name in values else F.col(f.name) for f in df.schema])


def date_fpe(ts: Column, start: str, end: str, key: str, decrypt: bool = False) -> Column:
    """Seconds since ``start`` go through the bijection; a time outside [start, end] counts as the nearer end."""
    lo, hi = F.unix_timestamp(F.lit(start).cast("timestamp")), F.unix_timestamp(F.lit(end).cast("timestamp"))
    from datetime import datetime

    seconds = int((datetime.fromisoformat(end) - datetime.fromisoformat(start)).total_seconds()) + 1
    offset = F.least(F.greatest(F.unix_timestamp(ts), lo), hi) - lo
    return F.when(ts.isNotNull(), F.timestamp_seconds(feistel(offset, seconds, key, decrypt) + lo))


def text_fpe(x: Column, form: list[str], key: str, decrypt: bool = False) -> Column:
    """A text with a letter of ``form[k]`` at each place k, as a mixed-radix number through the bijection; null for a text of another form."""
    at = lambda k: F.instr(F.lit(form[k]), F.substring(x, k + 1, 1))
    fits = F.length(x) == len(form)
    number: Column = F.lit(0).cast("long")
    for k, letters in enumerate(form):
        fits = fits & (at(k) > 0)
        number = number * len(letters) + (at(k) - 1)
    coded = feistel(number, prod(map(len, form)), key, decrypt)
    # the digits are told from one evaluation of the bijection
    digits = F.transform(F.array(coded), lambda v: F.concat(*[F.substr(F.lit(s), (F.floor(v / w) % len(s) + 1).cast("int"), F.lit(1)) for s, w in zip(form, _weights(form), strict=True)]))
    return F.when(fits, digits[0])


def _weights(form: list[str]) -> list[int]:
    return [prod(map(len, form[k + 1 :])) for k in range(len(form))]


def form_number(x: Column, form: list[str]) -> Column:
    """A text as a number whose digits are the places of its letters in ``form[k]``, the last the lowest.

    As many places count as the shorter of text and form has. The first letter from the end that
    isn't in its place's alphabet ends it: those behind it count.
    """
    letters = F.array(*map(F.lit, form))
    n = F.least(F.length(x), F.lit(len(form)))
    start = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(1).cast("long").alias("unit"), F.lit(True).alias("on"))

    def step(acc: Column, k: Column) -> Column:
        own = F.element_at(letters, k)
        at = F.call_function("locate", F.substr(x, k, F.lit(1)), own)
        go = acc["on"] & (at > 0)
        return F.struct(F.when(go, acc["sum"] + (at - 1) * acc["unit"]).otherwise(acc["sum"]).alias("sum"), F.when(go, acc["unit"] * F.length(own)).otherwise(acc["unit"]).alias("unit"), go.alias("on"))

    places = F.when(n > 0, F.sequence(n, F.lit(1), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    return F.when(x.isNotNull(), F.aggregate(places, start, step)["sum"])


def number_form(n: Column, form: list[str]) -> Column:
    """A number as a text of the form: what ``form_number`` reads back, with a place's first letter where the number has no more digits."""
    digits = [F.substr(F.lit(s), (F.call_function("div", n.cast("long"), F.lit(w).cast("long")) % len(s) + 1).cast("int"), F.lit(1)) for s, w in zip(form, _weights(form), strict=True)]
    return F.when(n.isNotNull(), F.concat(*digits))


def masked_columns(tables: dict[str, DataFrame], rules: list[tuple[str, str, str]]) -> DataFrame:
    """(tab, col, kind, precision, length, rule, rows) of the columns that ``rules`` (table, column, rule) mask: their types as a database has them, their longest text, their rows. A table is read once."""
    out = []
    for name in dict.fromkeys(n for n, _, _ in rules):
        df, told = tables[name], []
        for n, c, rule in rules:
            if n != name:
                continue
            kind = df.schema[c].dataType.simpleString()
            text = kind == "string"
            known = {"tab": n, "col": c, "kind": "VARCHAR" if text else "NUMBER" if kind in ("bigint", "int", "smallint", "tinyint") or kind.startswith("decimal") else "FLOAT" if kind in ("double", "float") else "DATE" if kind.startswith(("date", "timestamp")) else kind.upper(), "rule": rule}
            precision = {"bigint": 19, "int": 10, "smallint": 5, "tinyint": 3}.get(kind) or (int(kind[8:].split(",")[0]) if kind.startswith("decimal") else None)
            told.append(F.struct(*[F.lit(v).alias(k) for k, v in known.items()], F.lit(precision).cast("int").alias("precision"), (F.max(F.length(c)) if text else F.lit(None).cast("int")).alias("length"), F.count("*").alias("rows")))
        out.append(df.agg(F.array(*told).alias("r")).select(F.inline("r")))
    return reduce(DataFrame.unionByName, out)
