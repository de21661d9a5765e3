"""Keyed tables stored in hash buckets, upserted by rewriting only the buckets that change.

Layout below ``root``::

    data/<write id>/_b=<bucket>/part-*.parquet   one file set per bucket and write
    manifest/<version>.json                      which file set each bucket has in that version

A row's bucket is ``pmod(xxhash64(keys), buckets)``, fixed when the table is made. An upsert reads
only the file sets of the buckets its updates fall into, merges there, writes the merged buckets
under a new write id and publishes a new manifest that names the new file sets for those buckets
and the old ones for all others. The manifest is written under a temporary name and renamed, so a
reader sees either the old version or the new one, never half; a job that dies before the rename
leaves an unreferenced write id that :func:`expire` removes. One writer per table.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ticketlens.operators.skew import join_on_keys, one_per_key

BUCKET = "_b"
SEQUENCE = "_input_order"


@dataclass
class Manifest:
    version: int
    buckets: int
    keys: list[str]
    schema: str  # JSON of the table's StructType
    files: dict[int, str] = field(default_factory=dict)  # bucket -> file set, relative to root

    def dump(self) -> str:
        described = {**self.__dict__, "files": {str(b): p for b, p in sorted(self.files.items())}}
        return json.dumps(described, sort_keys=True)

    @classmethod
    def load(cls, text: str) -> Manifest:
        described = json.loads(text)
        described["files"] = {int(b): p for b, p in described["files"].items()}
        return cls(**described)


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _manifest_versions(spark: SparkSession, root: str) -> list[int]:
    pattern, fs = _fs(spark, f"{root}/manifest/*.json")
    found = fs.globStatus(pattern) or []
    return sorted(int(s.getPath().getName()[: -len(".json")]) for s in found)


def is_bucketed(spark: SparkSession, root: str) -> bool:
    return bool(_manifest_versions(spark, root))


def read_manifest(spark: SparkSession, root: str, version: int | None = None) -> Manifest | None:
    versions = _manifest_versions(spark, root)
    if not versions:
        return None
    number = versions[-1] if version is None else version
    path, fs = _fs(spark, f"{root}/manifest/{number}.json")
    stream = fs.open(path)
    try:
        reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        text = "\n".join(iter(reader.readLine, None))
    finally:
        stream.close()
    return Manifest.load(text)


def _publish(spark: SparkSession, root: str, manifest: Manifest) -> None:
    """Write the manifest under a temporary name, then rename it to its version: the commit."""
    final, fs = _fs(spark, f"{root}/manifest/{manifest.version}.json")
    if fs.exists(final):
        raise RuntimeError(f"version {manifest.version} of {root} exists: another writer was first")
    temp, _ = _fs(spark, f"{root}/manifest/.{manifest.version}-{uuid.uuid4().hex}.tmp")
    out = fs.create(temp, False)
    try:
        out.write(bytearray(manifest.dump().encode()))
    finally:
        out.close()
    if not fs.rename(temp, final):
        fs.delete(temp, False)
        raise RuntimeError(f"could not publish version {manifest.version} of {root}")


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def read_table(spark: SparkSession, root: str, version: int | None = None, buckets: list[int] | None = None) -> DataFrame:
    """The table as of a version (default: newest), or only some of its buckets."""
    manifest = read_manifest(spark, root, version)
    if manifest is None:
        raise FileNotFoundError(f"no bucketed table under {root}")
    schema = StructType.fromJson(json.loads(manifest.schema))
    wanted = manifest.files if buckets is None else {b: manifest.files[b] for b in buckets if b in manifest.files}
    if not wanted:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/{p}" for p in wanted.values()])


def upsert(
    spark: SparkSession,
    root: str,
    updates: DataFrame,
    keys: list[str],
    schema: StructType,
    newest_first: list[Column] | None = None,
    buckets: int | None = None,
) -> int:
    """Merge ``updates`` into the bucketed table at ``root``; returns the new version.

    Without ``newest_first`` the update that comes last in the input wins over the stored row and
    over earlier updates of its key (input order: file, then row, as the source reads them). With
    it, the newest of the stored and updated rows stays, so a replayed old batch changes nothing.
    Only buckets that receive an update are read and written again. An empty batch publishes no
    version. ``buckets`` sets the number of buckets of a new table (default: the session's shuffle
    partitions) and is ignored afterwards.
    """
    current = read_manifest(spark, root)
    if current is None:
        count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        current = Manifest(-1, count, list(keys), schema.json(), {})
    elif current.keys != list(keys):
        raise ValueError(f"{root} is keyed by {current.keys}, not {keys}")
    names = schema.fieldNames()
    staged = updates.select(*names).withColumn(SEQUENCE, F.monotonically_increasing_id())
    staged = staged.withColumn(BUCKET, bucket_of(keys, current.buckets))
    touched = sorted(r[0] for r in staged.select(BUCKET).distinct().collect())  # at most `buckets` numbers
    if not touched:
        return current.version
    stored = read_table(spark, root, buckets=touched) if current.files else spark.createDataFrame([], schema)
    stored = stored.withColumn(SEQUENCE, F.lit(-1).cast("long")).withColumn(BUCKET, bucket_of(keys, current.buckets))
    changed = staged.select(*keys).distinct()
    untouched = join_on_keys(stored, changed, keys, "left_anti")
    if newest_first is None:
        latest = one_per_key(staged, keys, [F.col(SEQUENCE).desc()])
    else:
        candidates = join_on_keys(stored, changed, keys, "left_semi").unionByName(staged)
        rest = [F.col(c).desc_nulls_last() for c in names if c not in keys]
        latest = one_per_key(candidates, keys, [*newest_first, *rest, F.col(SEQUENCE).desc()])
    merged = untouched.unionByName(latest).drop(SEQUENCE)
    write_id = uuid.uuid4().hex
    (
        merged.repartition(len(touched), BUCKET)
        .write.partitionBy(BUCKET)
        .parquet(f"{root}/data/{write_id}")
    )
    files = dict(current.files)
    for b in touched:
        files[b] = f"data/{write_id}/{BUCKET}={b}"
    written, fs = _fs(spark, f"{root}/data/{write_id}")
    present = {int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(written) if s.getPath().getName().startswith(f"{BUCKET}=")}
    for b in touched:
        if b not in present:  # every row of the bucket went (cannot happen for an upsert, kept for safety)
            files.pop(b, None)
    _publish(spark, root, Manifest(current.version + 1, current.buckets, list(keys), current.schema, files))
    return current.version + 1


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of temporary files, if there is one."""
    folder, fs = _fs(spark, path)
    fs.delete(folder, True)


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete manifests but the newest ``keep`` and every file set none of them names; returns what went."""
    if keep < 1:
        raise ValueError("the newest version is always kept")
    versions = _manifest_versions(spark, root)
    kept = [read_manifest(spark, root, v) for v in versions[-keep:]]
    live = reduce(lambda a, m: a | set(m.files.values()), kept, set())
    live_ids = {p.split("/")[1] for p in live}
    gone = []
    for v in versions[:-keep]:
        path, fs = _fs(spark, f"{root}/manifest/{v}.json")
        fs.delete(path, False)
        gone.append(f"manifest/{v}.json")
    data, fs = _fs(spark, f"{root}/data")
    if fs.exists(data):
        for status in fs.listStatus(data):
            write_id = status.getPath().getName()
            if write_id not in live_ids:
                fs.delete(status.getPath(), True)
                gone.append(f"data/{write_id}")
                continue
            for part in fs.listStatus(status.getPath()):
                name = f"data/{write_id}/{part.getPath().getName()}"
                if part.isDirectory() and name not in live:
                    fs.delete(part.getPath(), True)
                    gone.append(name)
    return gone
