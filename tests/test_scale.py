"""Steps that must do their work once, and outputs that must stay small."""

from __future__ import annotations

import re
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ticketlens import functions as fn
from ticketlens.operators import increments as inc
from ticketlens.sources import buckets, json_api

ORDERS = "email string, id string, order_number string, show_id string, purchase_date_formatted date, phone string, not_comped int"


@pytest.fixture(scope="module")
def given(spark, tmp_path_factory):
    """A few rows of the given tables, some keys missing."""
    from checks.bindings import TestTables

    root = tmp_path_factory.mktemp("given")
    key = "CASE WHEN id <> 7 THEN id END AS o_orderkey"
    day = "timestamp_ntz'1997-01-01 10:00:00' + make_dt_interval(cast(id % 900 AS int)) AS o_orderdate"
    tables = {
        "customer": (20, ["id AS c_custkey", "concat('Customer#', id) AS c_name", "1 AS c_nationkey"]),
        "nation": (25, ["cast(id AS int) AS n_nationkey", "concat('N', id) AS n_name"]),
        "part": (12, ["id + 1 AS p_partkey", "'large' AS p_name", "'b' AS p_brand", "'promo' AS p_type", "cast(id AS int) AS p_size"]),
        "orders": (200, [key, "id % 20 AS o_custkey", "'F' AS o_orderstatus", "10.5D AS o_totalprice", day, "'5-LOW' AS o_orderpriority"]),
        "lineitem": (600, ["id DIV 3 AS l_orderkey", "id % 12 + 1 AS l_partkey", "cast(id % 3 AS int) AS l_linenumber",
                           "10.25D AS l_extendedprice", "'R' AS l_returnflag", "'F' AS l_linestatus"]),
        "events": (5, ["id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' AS ts", "id AS user_id", "'view' AS event_type"]),
    }
    for name, (rows, columns) in tables.items():
        spark.range(rows).selectExpr(*columns).write.parquet(f"{root}/{name}.parquet")
    return lambda: TestTables(spark, str(root))


def _dims(table):
    shows = table("id string, event_id string, start_date_formatted date, day_of_week int", ("s1", "e1", date(2020, 3, 2), 1))
    events = table("id string, venue_id string, name string, special_event int, presents_event int", ("e1", "v1", "a", 1, 0))
    counts = table("order_number string, tickets long, paid_tickets long, comp_tickets long", ("n1", 2, 2, None))
    lines = table("order_number string, ticket_price long", ("n1", 500), ("n1", 250))
    return shows, events, counts, lines


def test_an_increment_reads_its_fact_rows_once(spark, table, scratch):
    shows, events, counts, lines = _dims(table)
    orders = table(ORDERS, *[(f"c{i}@", str(i), "n1", "s1", date(2020, 1, 1), f"p{i}", 1) for i in range(40)])
    kept = scratch("facts")
    inc.order_facts(orders, shows, events, counts, lines).write.parquet(kept)
    facts = spark.read.parquet(kept)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    def never(keys):
        raise AssertionError("no customer lost a maximum")

    root = scratch("states")
    inc.apply_changes(spark, root, None, facts.mapInArrow(counted, facts.schema), never, buckets_count=4)
    assert read.value == 40
    assert buckets.read_table(spark, root).count() == 40
    folder, files = buckets._fs(spark, f"{root}/staged")
    assert not files.exists(folder) or not files.listStatus(folder)


def test_facts_from_kept_totals_equal_those_from_lines(table):
    from ticketlens.operators.marts import line_totals

    shows, events, counts, lines = _dims(table)
    orders = table(ORDERS, ("x@", "1", "n1", "s1", date(2020, 1, 1), "p", 1), (None, "2", "n2", None, None, None, 0))
    from_lines = inc.order_facts(orders, shows, events, counts, lines)
    from_totals = inc.order_facts(orders, shows, events, counts, totals=line_totals(lines))
    assert sorted(map(repr, from_lines.collect())) == sorted(map(repr, from_totals.collect()))


def test_changed_rows_of_kept_facts(table):
    before = table("id string, v int", *[(None, 1)] * 50, ("a", 1), ("b", 1), ("gone", 1))
    after = table("id string, v int", *[(None, 1)] * 50, ("a", 1), ("b", 2), ("new", 1))
    facts = [df.select("id", (F.col("v") * 10).alias("fact")) for df in (before, after)]
    gone, came = inc.changed_orders(before, after, rows=tuple(facts))
    assert sorted(map(tuple, gone.collect())) == [("b", 10), ("gone", 10)]
    assert sorted(map(tuple, came.collect())) == [("b", 20), ("new", 10)]


def test_landed_orders_are_compressed(given, tmp_path, monkeypatch):
    from checks import queries as q

    monkeypatch.setattr(q, "_scratch", lambda t, name: f"{tmp_path}/{name}")
    given_json = sum(len(r.value) for r in given().order_json().collect())
    rows = q._QUERIES["read_orders_json"](given()).count()
    assert rows == given().order_json().count() > 0
    landed = sum(p.stat().st_size for p in Path(tmp_path, "orders-json").glob("part-*"))
    assert landed < given_json / 3


def test_quarantine_is_written_unsorted_and_compressed(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.json").write_text('{"a": 1}\n{"a": \n{"a": 3}\n')
    conf = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(conf)
    good, bad = json_api.read_quarantined(
        spark, str(landing), spark.createDataFrame([], "a int").schema, f"{tmp_path}/out", lines=True
    )
    assert sorted(r.a for r in good.collect()) == [1, 3] and bad.count() == 1
    files = [p.name for p in Path(tmp_path, "out").rglob("part-*")]
    assert files and all(name.endswith(".zstd.parquet") for name in files)
    assert spark.conf.get(conf) == before


def test_a_form_is_parsed_once(table):
    form = table("body string", ("contact[email]=a%2B@x&b",)).select(fn.webhook_fields(F.col("body")).alias("f")).select("f.*")
    plan = form._jdf.queryExecution().optimizedPlan().toString().lower()
    assert len(re.findall(r"url_?decode|urlcodec", plan)) <= 4
    assert form.first()["email"] == "a+@x"


def test_space_is_stripped_as_by_the_patterns(table):
    texts = ["", " ", "a", " a b\t", "\r\na\r\n", "a \u0085", "a  ", "\u0085 a", "  ", "a\x0b\f", " a ", "a \n\u0085", None]
    by_pattern = F.regexp_replace(F.regexp_replace("t", r"^\s+", ""), r"\s+$", "")
    rows = table("t string", *[(t,) for t in texts]).select(by_pattern.alias("want"), fn.strip_space(F.col("t")).alias("got")).collect()
    assert [r.got for r in rows] == [r.want for r in rows]


def test_contacts_are_backfilled_from_the_customer_alone(given):
    from checks import queries as q
    from ticketlens.operators import ingest

    found = q._QUERIES["backfill_contacts"](given())
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json(StructField(customer" in plan and "from_json(StructField(venue_id" not in plan
    whole = ingest.backfill_contacts(given().order_sightings()).distinct()
    assert sorted(map(repr, found.collect())) == sorted(map(repr, whole.collect()))


def test_features_read_orders_and_counts_that_are_kept(given):
    from checks import queries as q

    plan = q._QUERIES["customer_360_from_features"](given())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1  # the line revenue; orders and counts come from the kept tables


def test_a_rebuild_writes_orders_and_customers_side_by_side(spark, given, scratch, monkeypatch):
    from threading import Barrier

    from checks.bindings import AS_OF, OPTIONS
    from ticketlens.plans import rebuild

    both, write = Barrier(2, timeout=60), rebuild.write_version

    def write_together(df, root, partition_by=()):
        if root.endswith(("/orders_mv", "/customer_features")):
            both.wait()
        return write(df, root, partition_by)

    monkeypatch.setattr(rebuild, "write_version", write_together)
    assert len(rebuild.rebuild_all(spark, given().base(), scratch("side-by-side"), AS_OF, OPTIONS)) == 20
