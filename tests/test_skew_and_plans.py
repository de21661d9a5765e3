import contextlib
import io
import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from checks.bindings import AS_OF, OPTIONS, TestTables
from ticketlens.operators import features as ft
from ticketlens.operators import marts, payloads, selection, skew, tags
from ticketlens.operators.batches import with_batch_id
from ticketlens.plans.rebuild import wide_table
from ticketlens.sources import tables as store
from ticketlens.sources import upsert as up

SMALLEST = "/root/testdata/sf0.001"


def plan(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@contextlib.contextmanager
def settings(spark, **values):
    names = {key.replace("__", "."): value for key, value in values.items()}
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


# --- orders of any size ---------------------------------------------------------------


def test_an_order_of_30000_lines_is_one_payload(spark):
    lines = spark.range(30_000).selectExpr(
        "concat('9-', id) AS unique_id", "'5' AS venue_id", "'a@x' AS email", "'9' AS orderNumber",
        "'s1' AS orderproduct_category", "'Night' AS event_name", "concat('Tier ', id % 3) AS orderproduct_name",
        "id AS orderproduct_price", "'x9' AS externalid", "'7' AS customerid", "date'2018-04-01' AS orderDate",
        "'card' AS shippingMethod", "100 AS totalPrice",
    )
    grouped = payloads.group_order_lines(lines)
    known = grouped.withColumns({"connection": F.lit("4"), "crm_customer_id": F.lit("77")})
    rows = payloads.order_payloads(known, numeric=True).collect()
    assert len(rows) == 1
    order = json.loads(rows[0]["payload"])["ecomOrder"]
    assert order["externalid"] == "x9"
    assert sorted(p["price"] for p in order["orderProducts"]) == list(range(30_000))
    connections = spark.createDataFrame([("5", "4")], "venue_id string, connection string")
    assert payloads.customer_payloads(grouped, connections).count() == 1


def test_tag_sets_of_a_contact_with_many_tags(spark):
    many = spark.range(900).select(F.lit("a@x").alias("email"), F.col("id").cast("string").alias("tag"))
    assert tags.tag_sets(many.union(many)).count() == 900


# --- batches --------------------------------------------------------------------------


def test_batches_of_one_venue(table):
    rows = table("venue string, number string", *[("5", str(n)) for n in range(12)], ("6", "1"))
    out = with_batch_id(rows, "venue", ["number"], size=5)
    sizes = {(r["venue"], r["batch_id"]): r["count"] for r in out.groupBy("venue", "batch_id").count().collect()}
    assert sizes == {("5", 0): 5, ("5", 1): 5, ("5", 2): 2, ("6", 0): 1}


def test_batches_keep_rows_with_missing_keys(table):
    rows = table("venue string, number string", ("5", "1"), ("5", None), ("5", None), (None, "1"), (None, None))
    out = with_batch_id(rows, "venue", ["number"], size=1).collect()
    assert len(out) == 5
    assert {r["venue"]: sorted(x["batch_id"] for x in out if x["venue"] == r["venue"]) for r in out} in (
        {"5": [0, 0, 1], None: [0, 1]}, {"5": [0, 1, 1], None: [0, 1]})


def test_batches_of_a_hot_venue_are_numbered_bucket_by_bucket(spark):
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("venue"), F.col("id").alias("number")
    )
    rows = rows.union(rows.where("number < 500"))  # several rows of one order share a batch
    out = with_batch_id(rows, "venue", ["number"], size=700)
    keys = out.select("venue", "number", "batch_id").distinct()
    assert keys.count() == 20_000 and out.count() == 20_500
    sizes = keys.groupBy("venue", "batch_id").count().orderBy("venue", "batch_id").collect()
    for venue, total in (("hot", 18_000), ("cold", 2_000)):
        counts = [r["count"] for r in sizes if r["venue"] == venue]
        assert counts == [700] * (total // 700) + ([total % 700] if total % 700 else [])
    # The window over the keys themselves is partitioned by venue and bucket.
    text = plan(out)
    windows = [line for line in text.splitlines() if "row_number()" in line and "Window" not in line]
    assert windows and "_bucket" in text


# --- hot keys in joins and windows ----------------------------------------------------


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
@pytest.mark.parametrize("hot_rows", [100, 10**6])
def test_lookup_join_routes_hot_and_null_keys(spark, monkeypatch, how, hot_rows):
    monkeypatch.setattr(skew, "HOT_ROWS", hot_rows)
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None)).otherwise((F.col("id") % 50).cast("string"))
    left = spark.range(3000).select(key.alias("k"), "id")
    right = spark.range(25).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
    right = right.union(spark.createDataFrame([("hot", 2), ("unused", 3)], "k string, v int"))
    assert sorted(skew.hot_keys(left, "k"), key=str) == ([None, "hot"] if hot_rows == 100 else [])
    joined, plain = skew.lookup_join(left, right, "k", how), left.join(right, "k", how)
    assert joined.columns == plain.columns
    assert joined.exceptAll(plain).count() == 0 and plain.exceptAll(joined).count() == 0


def test_hot_keys_of_an_empty_table(spark, table):
    assert skew.hot_keys(table("k string").limit(0), "k") == []


def test_hot_join_keys_are_split_at_run_time(spark, table, scratch):
    """A third of all lines belong to one order; the merge join of the mart is split."""
    n = 60_000
    lines = spark.range(n).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 5000).cast("string")).alias("order_number"),
        F.md5(F.col("id").cast("string")).alias("ticket_name"),
        F.lit(1).cast("bigint").alias("ticket_price"),
    )
    numbers = lines.select("order_number").distinct()
    columns = "id email cust_id payment_method booking_type new_customer addons".split()
    orders = numbers.select(
        "order_number", F.lit("s").alias("show_id"), *[F.lit("x").alias(c) for c in columns],
        F.lit(1).cast("bigint").alias("order_total"), F.lit(0).alias("comped"), F.lit(1).alias("not_comped"),
        F.lit(date(2018, 1, 1)).alias("purchase_date_formatted"),
        F.lit("2018-01-01").cast("timestamp_ntz").alias("sys_entry_date"),
    )
    shows = table("id string, event_id string, start_date_formatted date, day_of_week int",
                  ("s", "e", date(2018, 1, 1), 0))
    events = table("id string, venue_id string, name string, special_event int, presents_event int",
                   ("e", "v", "n", None, None))
    stored = {}
    for name, df in (("orders", orders), ("lines", lines.repartition(8))):
        path = scratch(name)
        store.full_refresh(df, path)
        stored[name] = store.load_table(spark, path)
    with settings(
        spark,
        spark__sql__adaptive__enabled="true",
        spark__sql__shuffle__partitions="4",
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="50KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
    ):
        mart = marts.orders_mart(stored["orders"], stored["lines"], shows, events, table("id string", ("v",)))
        assert len(mart.collect()) == n
        assert "skew=true" in mart._jdf.queryExecution().executedPlan().toString()


def test_newest_per_key_limits_each_key_before_the_shuffle(spark):
    rows = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    text = plan(up.newest_per_key(rows, ["k"], [F.col("id").desc()]))
    assert text.count("WindowGroupLimit") >= 2
    partial = text.index("Partial") if "Partial" in text else -1
    assert partial >= 0


def test_semi_join_sides_are_reduced_first(spark, table):
    wide = table("email_address string", ("a",))
    mart = table("email string, venue_id string", ("a", "5"))
    text = plan(selection.contacts_at_venues(wide, mart, ["5"]))
    assert "HashAggregate" in text and "LeftSemi" in text


# --- whole plans ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def given(spark):
    return TestTables(spark, SMALLEST)


def test_wide_table_plan(spark, given):
    wide = wide_table(given.base(), given.processed(), AS_OF, OPTIONS)
    text = plan(wide)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython"):
        assert bad not in text
    exchanges = [line for line in plan(wide, "simple").splitlines() if "Exchange hashpartitioning(email" in line]
    assert len(exchanges) == 1  # all features share one shuffle by customer
    scan = next(part for part in text.split("\n\n") if "lineitem" in part and "l_extendedprice" in part)
    assert "l_quantity" not in scan and "l_discount" not in scan


def test_show_dimension_is_broadcast_only_when_counted_small(spark, given, monkeypatch):
    p = given.processed()
    args = (p["orders_processed"], p["shows_processed"], p["events_processed"], given.venues())
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        small = plan(marts.visits(*args), "simple")
        monkeypatch.setattr(marts, "is_small", lambda df: False)
        large = plan(marts.visits(*args), "simple")
        monkeypatch.setattr(skew, "HOT_ROWS", 1)
        split = plan(marts.visits(*args), "simple")
    assert "BroadcastHashJoin [show_id" in small
    assert "BroadcastHashJoin [show_id" not in large and "SortMergeJoin [show_id" in large
    assert "Union" in split and "BroadcastHashJoin [show_id" in split and "SortMergeJoin [show_id" in split


def test_filters_and_columns_reach_the_scan(spark, given):
    orders = given.raw("orders")
    recent = orders.where("o_orderdate >= timestamp_ntz'1998-01-01 00:00:00'").select("o_custkey")
    text = plan(recent)
    assert "GreaterThanOrEqual(o_orderdate" in text
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_total_spend_sums_lines_before_the_join(spark, given):
    p = given.processed()
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(ft.total_spend(p["orders_processed"], p["orderlines_processed"]), "simple")
    join = text.index("SortMergeJoin")
    assert "partial_sum(ticket_price" in text[join:]


def test_unchanged_rows_of_an_upsert_are_not_shuffled(spark, scratch):
    """With few update keys the stored table is only scanned and anti-joined."""
    root = scratch("target")
    spark.range(1000).select("id", F.lit(datetime(2018, 1, 1)).alias("t")).write.parquet(root)
    target = spark.read.parquet(root)
    updates = spark.range(5).select("id", F.lit(datetime(2019, 1, 1)).alias("t"))
    text = plan(up.upsert(target, updates, ["id"]), "simple")
    anti = text[: text.index("Window ")] if "Window " in text else text
    assert "BroadcastHashJoin" in anti and "LeftAnti" in anti
    assert "Exchange hashpartitioning" not in anti[: anti.index("FileScan")]


def test_colocated_orders_and_lines_meet_without_a_shuffle(spark, table):
    from ticketlens.operators import marts
    from ticketlens.sources.colocated import write_colocated

    orders = table(
        "id string, order_number string, show_id string, email string, not_comped int, comped int",
        ("1", "n1", "s1", "a@", 1, 0),
        ("2", "n1", "s1", "b@", 0, 1),
        ("3", "n2", "s1", "a@", 1, 0),
        ("4", None, "s1", "c@", 1, 0),
    )
    lines = table("order_number string, ticket_price long", ("n1", 100), ("n1", 50), ("n2", 7), ("n3", 1), (None, 2))
    shows = table("id string, event_id string, start_date_formatted date, day_of_week int", ("s1", "e1", None, 1))
    events = table("id string, venue_id string, name string, special_event int, presents_event int", ("e1", "v1", "x", 0, 0))
    venues = table("id string", ("v1",))
    plain = marts.order_number_totals(marts.place_orders(orders, shows, events, venues), lines)
    stored = marts.order_number_totals(
        marts.place_orders(write_colocated(orders, "t_orders", "order_number", 4), shows, events, venues),
        write_colocated(lines, "t_lines", "order_number", 4),
    )
    plan = stored._jdf.queryExecution().executedPlan().toString()
    # Only the small dimension join (then broadcast) shuffles; orders and lines do not.
    assert "Exchange hashpartitioning(order_number" not in plan and "SortMergeJoin" in plan, plan
    assert sorted(map(tuple, stored.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
