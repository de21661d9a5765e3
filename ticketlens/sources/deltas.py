"""Keyed delta log with merge on read, for tables that streams keep current.

Layout below ``root``::

    log.json                  keys and schema of the table, written once
    deltas/seq=<n>/           the rows of micro-batch n, with their input position
    base/seq=<n>/             all deltas up to n folded into one table

A micro-batch appends only its own rows, so what a batch writes follows the batch, not the table.
Readers take the newest complete base and every complete delta after it and keep, per key, the row
of the latest batch (the latest in input order within a batch). Compaction writes that merge as a
new base and then deletes the deltas and bases it made redundant. Each folder counts once its job's
success marker exists; a batch that is replayed after a failure finds its delta complete and writes
nothing, so replays change nothing. One writer per table.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ticketlens.operators.skew import one_per_key

SEQ, POS = "_seq", "_pos"


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _complete(spark: SparkSession, root: str, kind: str) -> list[int]:
    pattern, fs = _fs(spark, f"{root}/{kind}/seq=*/_SUCCESS")
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in fs.globStatus(pattern) or [])


def is_log(spark: SparkSession, root: str) -> bool:
    path, fs = _fs(spark, f"{root}/log.json")
    return bool(fs.exists(path))


def _described(spark: SparkSession, root: str) -> tuple[list[str], StructType]:
    path, fs = _fs(spark, f"{root}/log.json")
    stream = fs.open(path)
    try:
        reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        described = json.loads("\n".join(iter(reader.readLine, None)))
    finally:
        stream.close()
    return described["keys"], StructType.fromJson(described["schema"])


def _describe(spark: SparkSession, root: str, keys: list[str], schema: StructType) -> None:
    path, fs = _fs(spark, f"{root}/log.json")
    if fs.exists(path):
        known, _ = _described(spark, root)
        if known != list(keys):
            raise ValueError(f"{root} is keyed by {known}, not {keys}")
        return
    out = fs.create(path, False)
    try:
        out.write(bytearray(json.dumps({"keys": list(keys), "schema": json.loads(schema.json())}).encode()))
    finally:
        out.close()


def append(batch: DataFrame, root: str, seq: int, keys: list[str], schema: StructType) -> bool:
    """Write micro-batch ``seq`` as a delta; False when that delta is complete already (a replay)."""
    spark = batch.sparkSession
    _describe(spark, root, keys, schema)
    if seq in _complete(spark, root, "deltas"):
        return False
    rows = batch.select(*schema.fieldNames()).withColumn(POS, F.monotonically_increasing_id()).withColumn(SEQ, F.lit(seq).cast("long"))
    rows.write.mode("overwrite").parquet(f"{root}/deltas/seq={seq}")
    return True


def _with_order(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(POS, LongType()), StructField(SEQ, LongType())])


def read_merged(spark: SparkSession, root: str) -> DataFrame:
    """The table: newest base and the deltas after it, one row per key, the latest batch winning."""
    keys, schema = _described(spark, root)
    bases = _complete(spark, root, "base")
    base_seq = bases[-1] if bases else -1
    parts = []
    if bases:
        parts.append(spark.read.schema(schema).parquet(f"{root}/base/seq={base_seq}").withColumns({POS: F.lit(0).cast("long"), SEQ: F.lit(-1).cast("long")}))
    after = [s for s in _complete(spark, root, "deltas") if s > base_seq]
    if after:
        parts.append(spark.read.schema(_with_order(schema)).parquet(*[f"{root}/deltas/seq={s}" for s in after]))
    if not parts:
        return spark.createDataFrame([], schema)
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    if not after:
        return rows.drop(POS, SEQ)
    return one_per_key(rows, keys, [F.col(SEQ).desc(), F.col(POS).desc()]).drop(POS, SEQ)


def pending(spark: SparkSession, root: str) -> int:
    """Complete deltas that no base holds yet."""
    bases = _complete(spark, root, "base")
    return sum(s > (bases[-1] if bases else -1) for s in _complete(spark, root, "deltas"))


def compact(spark: SparkSession, root: str, keep: int = 2) -> int | None:
    """Fold all complete deltas into a new base; returns its sequence, None when nothing was pending.

    Deltas the new base holds are deleted, and all but the newest ``keep`` bases.
    """
    deltas = _complete(spark, root, "deltas")
    bases = _complete(spark, root, "base")
    if not deltas or (bases and deltas[-1] <= bases[-1]):
        return None
    upto = deltas[-1]
    read_merged(spark, root).write.mode("overwrite").parquet(f"{root}/base/seq={upto}")
    for s in deltas:
        path, fs = _fs(spark, f"{root}/deltas/seq={s}")
        fs.delete(path, True)
    for s in [*bases, upto][:-keep]:
        path, fs = _fs(spark, f"{root}/base/seq={s}")
        fs.delete(path, True)
    return upto
