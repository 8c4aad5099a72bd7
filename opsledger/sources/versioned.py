"""Tables that are rewritten in place: versions beside each other, and a manifest that says which one holds.

A rewrite writes what stays as a version of its own, counts what was written, and only then puts a
new manifest in the old one's place. Readers follow the manifest, so until that one step they see
the old version whole, whatever becomes of the rewrite. Exports are refused for tables that have
changed since the masking that they should show.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _place(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def manifest(spark: SparkSession, root: str) -> dict:
    """The newest manifest of the table under ``root``: version, rows, at (seconds), number. Manifests are numbered files, of which the highest holds."""
    fs, folder = _place(spark, f"{root}/manifests")
    names = sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.getPath().getName().endswith(".json"))
    if not names:
        raise FileNotFoundError(f"{root} has no manifest")
    stream = fs.open(_place(spark, f"{root}/manifests/{names[-1]}")[1])
    try:
        return json.loads(bytes(stream.readAllBytes()).decode()) | {"number": int(names[-1].split(".")[0])}
    finally:
        stream.close()


def _switch(spark: SparkSession, root: str, number: int, what: dict) -> None:
    """Puts manifest ``number`` in place by a rename, which fails if another writer was first."""
    fs, draft = _place(spark, f"{root}/drafts/{uuid.uuid4().hex}.json")
    stream = fs.create(draft, True)
    stream.write(json.dumps(what).encode())
    stream.close()
    _, final = _place(spark, f"{root}/manifests/{number:012d}.json")
    fs.mkdirs(final.getParent())
    if fs.exists(final) or not fs.rename(draft, final):
        raise RuntimeError(f"{root} was rewritten by someone else meanwhile")


def _written(df: DataFrame, root: str) -> tuple[str, int]:
    """The version that ``df`` is written as, and its rows, counted in what was written."""
    version = f"{root}/versions/{uuid.uuid4().hex}"
    df.write.parquet(version)
    return version, df.sparkSession.read.parquet(version).count()


def create(df: DataFrame, root: str, now: Callable[[], float] = time.time) -> None:
    """The first version of a table."""
    version, n = _written(df, root)
    _switch(df.sparkSession, root, 1, {"version": version, "rows": n, "at": now()})


def read(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(manifest(spark, root)["version"])


def rewrite(spark: SparkSession, root: str, change: Callable[[DataFrame], DataFrame], now: Callable[[], float] = time.time, before_switch: Callable[[], None] | None = None) -> tuple[int, int]:
    """Replaces the table under ``root`` by ``change`` of it; (rows before, rows after).

    ``before_switch`` runs once the new version is written and counted; if it, or anything before
    it, fails, the table stays as it was. The old version's files stay for readers that are at it, until ``vacuum``.
    """
    old = manifest(spark, root)
    version, n = _written(change(spark.read.parquet(old["version"])), root)
    if before_switch:
        before_switch()
    _switch(spark, root, old["number"] + 1, {"version": version, "rows": n, "at": now()})
    return old["rows"], n


def survivors(spark: SparkSession, root: str, keys: DataFrame, on: list[str], **how: Callable) -> tuple[int, int]:
    """Deletes the rows whose key isn't among ``keys``, by a rewrite."""
    return rewrite(spark, root, lambda df: df.join(keys.select(*on), on, "left_semi").select(*df.columns), **how)


def vacuum(spark: SparkSession, root: str) -> int:
    """Deletes the versions that don't hold, and drafts; how many versions went."""
    fs, folder = _place(spark, f"{root}/versions")
    holds = manifest(spark, root)["version"].rstrip("/").split("/")[-1]
    gone = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName() != holds]
    for p in gone:
        fs.delete(p, True)
    fs.delete(_place(spark, f"{root}/drafts")[1], True)
    return len(gone)


class Refused(Exception):
    """An export that must not be."""


def export(spark: SparkSession, runs: DataFrame, schema: str, tables: dict[str, str], folder: str, masked: list[str], scope: str = "S", run: int | None = None) -> DataFrame:
    """Writes ``tables`` (name -> root) under ``folder``, and returns (table, rows); only as they were when a masking had ended.

    ``runs``: (run, schema, phase, state, ended_at), ended_at in seconds. Scope S takes the
    tables in ``masked`` only and needs a ``run``; C takes all, and the schema's last finished run if
    none is given. The run must be a finished masking of the schema; a table whose manifest is
    newer than its end refuses the whole export, before anything is written.
    """
    if scope not in ("S", "C"):
        raise Refused(f"no scope {scope}")
    if scope == "S" and run is None:
        raise Refused("an export of masked tables needs the run")
    done = runs.where((F.upper(F.trim("schema")) == schema.upper().strip()) & (F.col("phase") == "MASKING") & (F.col("state") == "FINISHED"))
    found = (done.where(F.col("run") == run) if run is not None else done).orderBy(F.desc("run")).select("ended_at").first()
    if not found:
        raise Refused(f"no finished masking of {schema}" + (f" is run {run}" if run is not None else ""))
    chosen = {k: v for k, v in tables.items() if scope == "C" or k in masked}
    held = {k: manifest(spark, root) for k, root in sorted(chosen.items())}
    late = [k for k, m in held.items() if m["at"] > found["ended_at"]]
    if late:
        raise Refused(f"{len(late)} tables changed after the masking: {', '.join(late)}")
    rows = []
    for k, m in held.items():
        spark.read.parquet(m["version"]).write.parquet(f"{folder}/{k}")
        rows.append((k, spark.read.parquet(f"{folder}/{k}").count()))
    return spark.createDataFrame(rows, "table string, rows long")
