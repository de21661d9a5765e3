import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ticketlens.sources import buckets, tables
from ticketlens.sources import upsert as up

SCHEMA = StructType([StructField("k", LongType()), StructField("v", StringType()), StructField("n", LongType())])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def local(path):
    return path.split(":", 1)[-1] if path.startswith("file:") else path


def files_under(path):
    found = []
    for folder, _, names in os.walk(local(path)):
        found += [os.path.join(folder, n) for n in names if n.endswith(".parquet")]
    return found


def test_only_touched_buckets_are_rewritten(spark, scratch):
    root = scratch("buckets")
    base = spark.range(2000).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"), F.col("id").alias("n"))
    assert up.upsert_table(spark, root, base, ["k"], SCHEMA) == 0
    before = buckets.read_manifest(spark, root)
    assert before.buckets == 2  # the test session's shuffle partitions

    root16 = scratch("buckets16")
    buckets.upsert(spark, root16, base, ["k"], SCHEMA, buckets=16)
    first = buckets.read_manifest(spark, root16)
    assert len(first.files) == 16
    changes = spark.createDataFrame([(k, "new", -k) for k in (3, 500, 1001, 1500, 1999)], SCHEMA)
    version = buckets.upsert(spark, root16, changes, ["k"], SCHEMA)
    after = buckets.read_manifest(spark, root16)
    assert version == after.version == 1
    touched = {b for b in after.files if after.files[b] != first.files[b]}
    assert 1 <= len(touched) <= 5
    new_ids = {after.files[b].split("/")[1] for b in touched}
    assert len(new_ids) == 1
    written = files_under(f"{root16}/data/{new_ids.pop()}")
    assert len(written) == len(touched)  # one file per rewritten bucket, none for the other buckets
    expected = {(k, f"v{k}", k) for k in range(2000)} - {(k, f"v{k}", k) for k in (3, 500, 1001, 1500, 1999)}
    expected |= {(k, "new", -k) for k in (3, 500, 1001, 1500, 1999)}
    assert set(rows(buckets.read_table(spark, root16))) == expected
    assert rows(buckets.read_table(spark, root16, version=0)) == rows(base)


def test_last_in_input_wins_and_newest_rule(spark, scratch):
    root = scratch("order")
    batch = spark.createDataFrame([(1, "first", 5), (1, "zzz-largest", 4), (1, "last", 3), (2, "x", 1)], SCHEMA).coalesce(1)
    buckets.upsert(spark, root, batch, ["k"], SCHEMA)
    assert rows(tables.read_version(spark, root)) == [(1, "last", 3), (2, "x", 1)]
    newest = [F.col("n").desc()]
    buckets.upsert(spark, root, spark.createDataFrame([(1, "old", 1), (2, "newer", 9)], SCHEMA), ["k"], SCHEMA, newest)
    assert rows(tables.read_version(spark, root)) == [(1, "last", 3), (2, "newer", 9)]
    # a replayed batch changes nothing
    buckets.upsert(spark, root, spark.createDataFrame([(1, "old", 1), (2, "newer", 9)], SCHEMA), ["k"], SCHEMA, newest)
    assert rows(tables.read_version(spark, root)) == [(1, "last", 3), (2, "newer", 9)]


def test_null_keys_empty_batches_and_wrong_keys(spark, scratch):
    root = scratch("nulls")
    buckets.upsert(spark, root, spark.createDataFrame([(None, "a", 1), (5, "b", 2)], SCHEMA), ["k"], SCHEMA)
    buckets.upsert(spark, root, spark.createDataFrame([(None, "c", 3)], SCHEMA), ["k"], SCHEMA)
    assert {r for r in rows(buckets.read_table(spark, root))} == {(None, "c", 3), (5, "b", 2)}
    version = buckets.read_manifest(spark, root).version
    assert buckets.upsert(spark, root, spark.createDataFrame([], SCHEMA), ["k"], SCHEMA) == version
    with pytest.raises(ValueError):
        buckets.upsert(spark, root, spark.createDataFrame([], SCHEMA), ["v"], SCHEMA)


def test_a_crash_before_the_manifest_leaves_the_old_version(spark, scratch, monkeypatch):
    root = scratch("crash")
    buckets.upsert(spark, root, spark.createDataFrame([(1, "a", 1), (2, "b", 2)], SCHEMA), ["k"], SCHEMA)

    def dies(*_):
        raise OSError("executor lost while publishing")

    monkeypatch.setattr(buckets, "_publish", dies)
    with pytest.raises(OSError):
        buckets.upsert(spark, root, spark.createDataFrame([(1, "changed", 9)], SCHEMA), ["k"], SCHEMA)
    monkeypatch.undo()
    assert rows(tables.read_version(spark, root)) == [(1, "a", 1), (2, "b", 2)]
    assert len(os.listdir(local(f"{root}/data"))) == 2  # the dead write is there, unreferenced
    buckets.upsert(spark, root, spark.createDataFrame([(1, "changed", 9)], SCHEMA), ["k"], SCHEMA)
    assert rows(tables.read_version(spark, root)) == [(1, "changed", 9), (2, "b", 2)]
    gone = buckets.expire(spark, root, keep=1)
    assert any(g.startswith("manifest/") for g in gone) and any(g.startswith("data/") for g in gone)
    assert rows(tables.read_version(spark, root)) == [(1, "changed", 9), (2, "b", 2)]
