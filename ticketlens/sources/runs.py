"""Incremental runs whose outputs and mark are published in one commit.

Layout below ``root/<job>``::

    out/<run id>/<name>/     the outputs of one run, written before its record
    runs/<n>.json            record of run n: window (mark, upper), outputs, input versions

A run reads the newest record's upper bound as its mark, computes its outputs for the window
``mark < t <= upper``, writes them under a fresh run id and then publishes record n + 1 by renaming
a temporary file. Before the rename nothing of the run is visible: its outputs are named by no
record and the mark stays, so a run that dies anywhere is repeated whole and no window is lost or
seen twice. Readers find outputs through the records only. One writer per job.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from ticketlens.semantics import Moment, as_moment


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, root: str, job: str) -> list[int]:
    pattern, fs = _fs(spark, f"{root}/{job}/runs/*.json")
    return sorted(int(s.getPath().getName()[: -len(".json")]) for s in fs.globStatus(pattern) or [])


def _read(spark: SparkSession, path: str) -> dict:
    target, fs = _fs(spark, path)
    stream = fs.open(target)
    try:
        reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return json.loads("\n".join(iter(reader.readLine, None)))
    finally:
        stream.close()


def records(spark: SparkSession, root: str, job: str) -> list[dict]:
    """All published records of a job, oldest first."""
    return [_read(spark, f"{root}/{job}/runs/{n}.json") for n in _numbers(spark, root, job)]


def read_mark(spark: SparkSession, root: str, job: str, default: Moment) -> datetime:
    numbers = _numbers(spark, root, job)
    if not numbers:
        return as_moment(default)
    return datetime.fromisoformat(_read(spark, f"{root}/{job}/runs/{numbers[-1]}.json")["upper"])


def _publish(spark: SparkSession, root: str, job: str, number: int, record: dict) -> None:
    final, fs = _fs(spark, f"{root}/{job}/runs/{number}.json")
    if fs.exists(final):
        raise RuntimeError(f"run {number} of {job} exists: another writer was first")
    temp, _ = _fs(spark, f"{root}/{job}/runs/.{number}-{uuid.uuid4().hex}.tmp")
    out = fs.create(temp, False)
    try:
        out.write(bytearray(json.dumps(record, sort_keys=True).encode()))
    finally:
        out.close()
    if not fs.rename(temp, final):
        fs.delete(temp, False)
        raise RuntimeError(f"could not publish run {number} of {job}")


def run_job(
    spark: SparkSession,
    root: str,
    job: str,
    upper: Moment,
    work: Callable[[datetime, datetime], dict[str, DataFrame]],
    default: Moment = "1970-01-01",
    inputs: dict[str, int] | None = None,
) -> dict:
    """Compute ``work(mark, upper)``, write its outputs and publish them with the new mark; returns the record.

    ``inputs`` (table name -> version read) is kept in the record, so that a run can be traced.
    An upper bound at or before the mark publishes nothing and returns the last record.
    """
    numbers = _numbers(spark, root, job)
    mark, bound = read_mark(spark, root, job, default), as_moment(upper)
    if bound <= mark:
        return _read(spark, f"{root}/{job}/runs/{numbers[-1]}.json") if numbers else {}
    run_id = uuid.uuid4().hex
    outputs = {}
    for name, df in work(mark, bound).items():
        relative = f"out/{run_id}/{name}"
        df.write.mode("overwrite").parquet(f"{root}/{job}/{relative}")
        outputs[name] = relative
    number = numbers[-1] + 1 if numbers else 0
    record = {"run": number, "mark": mark.isoformat(), "upper": bound.isoformat(), "outputs": outputs, "inputs": inputs or {}}
    _publish(spark, root, job, number, record)
    return record


def read_output(spark: SparkSession, root: str, job: str, name: str, all_runs: bool = False) -> DataFrame | None:
    """A named output of the newest run, or of all published runs together; None if no run wrote it."""
    chosen = records(spark, root, job)
    chosen = chosen if all_runs else chosen[-1:]
    paths = [f"{root}/{job}/{r['outputs'][name]}" for r in chosen if name in r["outputs"]]
    if not paths:
        return None
    return reduce(DataFrame.unionByName, [spark.read.parquet(p) for p in paths])


def unpublished(spark: SparkSession, root: str, job: str) -> list[str]:
    """Run ids whose outputs no record names: left by runs that died before their commit."""
    named = {p.split("/")[1] for r in records(spark, root, job) for p in r["outputs"].values()}
    folder, fs = _fs(spark, f"{root}/{job}/out")
    if not fs.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.getPath().getName() not in named)


def clean(spark: SparkSession, root: str, job: str) -> list[str]:
    """Delete the outputs of runs that died before their commit."""
    gone = unpublished(spark, root, job)
    for run_id in gone:
        path, fs = _fs(spark, f"{root}/{job}/out/{run_id}")
        fs.delete(path, True)
    return gone
