import os

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ticketlens.sources import deltas, tables

SCHEMA = StructType([StructField("k", LongType()), StructField("v", StringType())])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def local(path):
    return path.split(":", 1)[-1] if path.startswith("file:") else path


def rows_written(spark, folder):
    return spark.read.parquet(folder).count()


def test_batches_write_their_own_rows_and_merge_on_read(spark, scratch):
    root = scratch("deltas")
    base = spark.range(2000).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"))
    assert deltas.append(base, root, 0, ["k"], SCHEMA)
    small = spark.createDataFrame([(1, "a"), (1, "b"), (5000, "new"), (None, "n")], SCHEMA).coalesce(1)
    assert deltas.append(small, root, 1, ["k"], SCHEMA)
    assert rows_written(spark, f"{root}/deltas/seq=1") == 4  # the batch, not the table
    merged = rows(tables.read_version(spark, root))
    want = sorted([(k, f"v{k}") for k in range(2000) if k != 1] + [(1, "b"), (5000, "new"), (None, "n")], key=repr)
    assert merged == want
    # a replayed batch adds nothing
    assert not deltas.append(spark.createDataFrame([(1, "replayed")], SCHEMA), root, 1, ["k"], SCHEMA)
    assert rows(tables.read_version(spark, root)) == want


def test_compaction_folds_and_deletes(spark, scratch):
    root = scratch("compact")
    for seq, batch in enumerate([[(1, "a"), (2, "b")], [(2, "c")], [(3, "d"), (1, "e")]]):
        deltas.append(spark.createDataFrame(batch, SCHEMA), root, seq, ["k"], SCHEMA)
    before = rows(deltas.read_merged(spark, root))
    assert before == [(1, "e"), (2, "c"), (3, "d")]
    assert deltas.pending(spark, root) == 3
    assert deltas.compact(spark, root) == 2
    assert deltas.pending(spark, root) == 0 and deltas.compact(spark, root) is None
    assert not os.path.exists(local(f"{root}/deltas/seq=0"))
    assert rows(deltas.read_merged(spark, root)) == before
    deltas.append(spark.createDataFrame([(3, "f")], SCHEMA), root, 3, ["k"], SCHEMA)
    assert rows(deltas.read_merged(spark, root)) == [(1, "e"), (2, "c"), (3, "f")]
    # a batch replayed after compaction is older than the base and changes nothing
    deltas.append(spark.createDataFrame([(1, "old")], SCHEMA), root, 0, ["k"], SCHEMA)
    assert rows(deltas.read_merged(spark, root)) == [(1, "e"), (2, "c"), (3, "f")]


def test_an_unfinished_delta_is_invisible(spark, scratch):
    root = scratch("unfinished")
    deltas.append(spark.createDataFrame([(1, "a")], SCHEMA), root, 0, ["k"], SCHEMA)
    deltas.append(spark.createDataFrame([(1, "b")], SCHEMA), root, 1, ["k"], SCHEMA)
    os.remove(os.path.join(local(f"{root}/deltas/seq=1"), "_SUCCESS"))  # as if the job died before its commit
    assert rows(deltas.read_merged(spark, root)) == [(1, "a")]
    assert deltas.append(spark.createDataFrame([(1, "c")], SCHEMA), root, 1, ["k"], SCHEMA)  # the retry writes it
    assert rows(deltas.read_merged(spark, root)) == [(1, "c")]
