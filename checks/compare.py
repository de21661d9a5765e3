"""Run every query and its DuckDB twin and compare rows, names and types.

    python -m checks.compare [sf_dir] [name …]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.queries import queries
from checks.twins import oracle_sql

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def local_session(cores: int = 8, **conf: str) -> SparkSession:
    """A local session; further settings by name with ``__`` for dots."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ticketlens")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def canonical(rows, names: list[str]) -> list[tuple[str, ...]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def compare(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> dict[str, str]:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    twins, outcome = oracle_sql(), {}
    for name, build in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = build(spark, sf_dir)
            mine, columns = [tuple(row) for row in df.collect()], df.columns
            seconds = time.time() - start
            if name not in twins:
                outcome[name] = f"no twin, {len(mine)} rows"
                continue
            result = connection.execute(twins[name])
            their_columns = [d[0] for d in result.description]
            theirs = result.fetchall()
            types = {d[0]: str(d[1]) for d in result.description}
            left, right = canonical(mine, columns), canonical(theirs, their_columns)
            if sorted(columns) != sorted(their_columns):
                outcome[name] = f"COLUMNS {sorted(set(columns) ^ set(their_columns))}"
            elif left != right:
                only = [row for row in left if row not in set(right)][:2]
                other = [row for row in right if row not in set(left)][:2]
                outcome[name] = f"DIFFERS {len(left)} vs {len(right)}\n   {sorted(columns)}\n   {only}\n   {other}"
            else:
                kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
                clash = [f"{c}: {kinds[c]}/{types[c]}" for c in columns if _family(kinds[c]) != _family(types[c])]
                outcome[name] = f"ok {len(left)} rows {seconds:.2f}s" + (f" TYPES {clash}" if clash else "")
        except Exception as error:  # noqa: BLE001 - one failing query must not hide the others
            outcome[name] = f"ERROR {type(error).__name__}: {str(error)[:600]}"
    return outcome


def _family(kind: str) -> str:
    kind = kind.lower()
    known = {"varchar": "string", "integer": "int", "hugeint": "HUGEINT"}
    return known.get(kind, kind)


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = local_session(int(os.environ.get("BENCH_CPUS", "8")))
    results = compare(session, folder, sys.argv[2:] or None)
    for key, text in results.items():
        print(f"{key}: {text}")
    missing = set(oracle_sql()) - set(queries())
    good = sum(text.startswith("ok") for text in results.values())
    print(f"{good} of {len(results)} equal; twins without query: {sorted(missing)}")
