import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ticketlens.operators import ingest
from ticketlens.plans.ingest import ingest_catalog, ingest_contact_names, ingest_orders, ingest_shows
from ticketlens.schemas import CONTACTS, EVENTS, ORDER_LINK, ORDERLINES, ORDERS, SHOWS
from ticketlens.sources import export, json_api, marks, tables
from ticketlens.sources import upsert as up


def land(root, files):
    for name, content in files.items():
        path = os.path.join(root, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", encoding="utf-8") as out:
            json.dump(content, out)


def order(number, tickets, email="Ann@X.co\r", **over):
    doc = {
        "id": int(number) * 10,
        "order_number": number,
        "purchase_at": "2018-04-01T20:00:00.000-05:00",
        "booking_type": "web",
        "customer": {"id": 7, "email": email, "name": "O'Neil, \"Ann\"", "phone": "555", "new_customer": True},
        "payments": [{"payment_method": "card"}, {"payment_method": "later"}],
        "addons": [],
        "tickets": tickets,
    }
    return doc | over


def ticket(tid, price=500):
    return {"id": tid, "price": price, "printed": True, "promo_code_id": None, "checked_in": False}


@pytest.fixture
def landing(tmp_path):
    first = [
        order("1", {"GA, front": [ticket(1), ticket(2)]}, addons=[{"name": "parking"}, {"name": "drink"}]),
        order("2", {"GA": [ticket(9, "n/a"), ticket(10, 5.0)]}, email=None, payments=[]),
        order("3", {}, email="None"),
    ]
    second = [order("1", {"VIP": [ticket(3)]}, email="other@x.co", payments=[])]
    elsewhere = [order("1", {"GA": [ticket(4)]}, email="third@x.co")]
    land(str(tmp_path), {
        "venue_id=5/show_id=70/orders.json": first,
        "venue_id=5/show_id=71/orders.json": second,
        "venue_id=6/show_id=80/orders.json": elsewhere,
    })
    return str(tmp_path)


def test_orders_from_json(spark, landing, scratch):
    raw = json_api.read_orders_json(spark, landing)
    flat = ingest.flatten_orders(raw, "2018-05-01")
    merged = {(r["venue_id"], r["order_number"]): r for r in ingest.merge_order_sightings(flat).collect()}
    assert set(merged) == {("5", "1"), ("5", "2"), ("5", "3"), ("6", "1")}
    one, two, three = (merged["5", n] for n in "123")
    assert (one["order_total"], one["show_id"], one["email"], one["payment_method"]) == (1500, "70", "ann@x.co", "card")
    assert one["addons"] == "parking\tdrink"
    assert one["purchase_date"] == datetime(2018, 4, 1, 20)
    assert one["new_customer"] == "True"
    assert (two["order_total"], two["bad_prices"], two["payment_method"]) == (5, 1, "")
    assert (three["order_total"], three["addons"]) == (0, "")
    bad = ingest.bad_price_report(ingest.merge_order_sightings(flat)).collect()
    assert [(r["venue_id"], r["order_number"], r["bad_prices"]) for r in bad] == [("5", "2", 1)]

    lines = {r["id"]: r for r in ingest.flatten_orderlines(raw).collect()}
    assert set(lines) == {"1-1", "1-2", "1-3", "1-4", "2-9", "2-10"}
    assert (lines["1-1"]["ticket_name"], lines["1-1"]["printed"], lines["1-1"]["checked_in"]) == (
        "GA  front", "True", "False",
    )
    assert (lines["2-9"]["ticket_price"], lines["2-10"]["ticket_price"]) == (None, 5)

    contacts = ingest.flatten_contacts(ingest.first_sightings(raw), "2018-05-01").collect()
    assert sorted((r["email_address"], r["name"], r["name_first"]) for r in contacts) == [
        ("ann@x.co", "O`Neil  Ann", ""), ("third@x.co", "O`Neil  Ann", ""),
    ]

    root = scratch("base")
    for _ in range(2):
        ingest_orders(spark, raw, root, "2018-05-01")
    ingest_contact_names(spark, raw, root)
    stored = {n: tables.read_version(spark, f"{root}/{n}") for n in ("orders", "orderlines", "contacts")}
    assert [stored[n].schema.names for n in stored] == [s.names for s in (ORDERS, ORDERLINES, CONTACTS)]
    assert stored["orderlines"].count() == 6
    assert stored["orders"].count() == 3  # both venues' order 1 has the id 10
    dates = {r["sys_entry_date"] for r in stored["contacts"].where("email_address = 'ann@x.co'").collect()}
    assert dates == {datetime(1999, 12, 31, 23, 59, 59)}


def test_show_9_is_seen_before_show_10(spark, tmp_path):
    for show, email in (("10", "late@x.co"), ("9", "first@x.co")):
        land(str(tmp_path), {f"venue_id=5/show_id={show}/orders.json": [order("1", {"GA": [ticket(1)]}, email=email)]})
    raw = json_api.read_orders_json(spark, str(tmp_path))
    merged = ingest.merge_order_sightings(ingest.flatten_orders(raw, "2018-05-01")).collect()
    assert [(r["show_id"], r["email"]) for r in merged] == [("9", "first@x.co")]
    assert [r["show_id"] for r in ingest.first_sightings(raw).collect()] == ["9"]


def test_catalog_and_shows_from_json(spark, tmp_path, scratch):
    starts = {"1": "2018-05-10T19:30:00.000-05:00", "2": "2018-04-26 00:00:00", "3": "2018-04-25T23:59:59Z"}
    land(str(tmp_path), {
        "catalog/venue_id=5/c.json": {"data": [
            {"id": 3, "name": "Bob's \"Night\"", "image_url": "u", "shows": [
                {"id": int(k), "start_date_time": v} for k, v in starts.items()]},
            {"id": 4, "name": "Empty", "image_url": None, "shows": []},
        ]},
        "shows/show_id=1/s.json": {"data": {
            "event_id": 3, "start_date_time": starts["1"], "sold_out": False, "event": {"cancelled_at": None}}},
        "shows/show_id=2/s.json": {"data": {
            "event_id": 3, "start_date_time": starts["2"], "sold_out": True,
            "event": {"cancelled_at": "2018-04-01T10:00:00Z"}}},
    })
    catalog = json_api.read_catalog_json(spark, f"{tmp_path}/catalog")
    events = sorted(tuple(r) for r in ingest.flatten_events(catalog).collect())
    assert events == [("3", "5", "Bob`s Night", "u"), ("4", "5", "Empty", None)]

    def recent(**options):
        return sorted(r["show_id"] for r in ingest.recent_shows(catalog, "2018-04-30", **options).collect())

    assert recent() == ["1"]
    assert recent(strict=False) == ["1", "2"]
    assert recent(lookback_days=5) == ["1", "2", "3"]

    details = json_api.read_show_json(spark, f"{tmp_path}/shows")
    root = scratch("catalog")
    ingest_catalog(spark, catalog, root)
    ingest_shows(spark, details, root)
    shows = {r["id"]: r for r in tables.read_version(spark, f"{root}/shows", SHOWS).collect()}
    assert (shows["1"]["start_date_time"], shows["1"]["sold_out"], shows["1"]["cancelled_at"]) == (
        datetime(2018, 5, 10, 19, 30), "False", None,
    )
    assert shows["2"]["cancelled_at"] == datetime(2018, 4, 1, 10)
    assert tables.read_version(spark, f"{root}/events", EVENTS).count() == 2


def test_upsert_rules(table):
    target = table("k string, n int, v string", ("a", 1, "old"), ("b", 5, "keep"), (None, 1, "null key"))
    updates = table("k string, n int, v string", ("a", 2, "new"), ("a", 2, "next"), ("c", 1, "add"), ("b", 4, "late"))

    def rows(df):
        return sorted((tuple(r) for r in df.collect()), key=str)

    last_wins = up.upsert(target, updates, ["k"])
    assert rows(last_wins) == rows(up.upsert(last_wins, updates, ["k"]))
    assert {r["k"]: r["v"] for r in last_wins.collect()} == {"a": "next", "b": "late", "c": "add", None: "null key"}
    newest = up.upsert(target, updates, ["k"], [F.col("n").desc()])
    assert {r["k"]: r["v"] for r in newest.collect()} == {"a": "next", "b": "keep", "c": "add", None: "null key"}
    known = up.update_existing(target, updates, ["k"], [F.col("n").desc()])
    assert {r["k"]: r["v"] for r in known.collect()} == {"a": "next", "b": "keep", None: "null key"}
    # Updates taken from the target itself join without ambiguity.
    self_update = up.upsert(target, target.withColumn("v", F.lit("x")), ["k"])
    assert {r["v"] for r in self_update.collect()} == {"x"}


def test_links(spark):
    frame = spark.createDataFrame
    link = frame([("1", "3", "x"), ("1", "4", "y")], ORDER_LINK)
    out = up.upsert_links(link, frame([("1", "4", "z"), ("2", "3", "w")], ORDER_LINK))
    assert sorted(tuple(r) for r in out.collect()) == [("1", "3", "x"), ("1", "4", "z"), ("2", "3", "w")]


def test_versions_hide_unfinished_writes(spark, table, scratch):
    root = scratch("versions")
    with pytest.raises(FileNotFoundError):
        tables.read_version(spark, root)
    assert tables.read_version(spark, root, EVENTS).count() == 0
    assert tables.write_version(table("a int", (1,)), root) == 0
    assert tables.write_version(tables.read_version(spark, root).union(table("a int", (2,))), root) == 1
    # A job that died in version 2 left rows but no success marker.
    tables.full_refresh(table("a int", (9,)), f"{root}/version=2")
    spark._jvm.org.apache.hadoop.fs.FileSystem.getLocal(spark._jsc.hadoopConfiguration()).delete(
        spark._jvm.org.apache.hadoop.fs.Path(f"{root}/version=2/_SUCCESS"), False
    )
    assert sorted(r["a"] for r in tables.read_version(spark, root).collect()) == [1, 2]
    assert tables.write_version(table("a int", (3,)), root) == 2
    assert [r["a"] for r in tables.read_version(spark, root).collect()] == [3]
    assert tables.expire_versions(spark, root, keep=2) == [0]
    assert tables.expire_versions(spark, root, keep=2) == []
    assert [r["a"] for r in tables.read_version(spark, root).collect()] == [3]
    with pytest.raises(ValueError):
        tables.expire_versions(spark, root, keep=0)


def test_marks_never_move_back_and_stay_on_failure(spark, scratch):
    root = scratch("marks")
    assert marks.read_mark(spark, root, "a", "2018-01-01") == datetime(2018, 1, 1)
    marks.advance_mark(spark, root, "a", "2018-02-01T10:00:00")
    marks.advance_mark(spark, root, "b", "2018-03-01")
    marks.advance_mark(spark, root, "a", "2018-01-15")
    assert marks.read_mark(spark, root, "a", "2000-01-01") == datetime(2018, 2, 1, 10)

    def fail(mark, upper):
        raise RuntimeError

    with pytest.raises(RuntimeError):
        marks.run_incremental(spark, root, "a", "2018-06-01", fail)
    seen = []
    marks.run_incremental(spark, root, "a", "2018-06-01", lambda *bounds: seen.append(bounds), advance=False)
    marks.run_incremental(spark, root, "a", "2018-06-01", lambda *bounds: seen.append(bounds))
    assert seen == [(datetime(2018, 2, 1, 10), datetime(2018, 6, 1))] * 2
    assert marks.read_mark(spark, root, "a", "2000-01-01") == datetime(2018, 6, 1)
    assert marks.read_mark(spark, root, "b", "2000-01-01") == datetime(2018, 3, 1)


def test_csv_chunks(spark, tmp_path):
    export.export_csv_chunks(spark.range(25).coalesce(1), f"{tmp_path}/out", rows_per_file=10)
    files = sorted(f for f in os.listdir(f"{tmp_path}/out") if f.endswith(".csv"))
    contents = [open(f"{tmp_path}/out/{f}", encoding="utf-8").read().split() for f in files]
    assert [len(c) for c in contents] == [11, 11, 6]
    assert all(c[0] == "id" for c in contents)
    export.export_csv_chunks(spark.range(2), f"{tmp_path}/bare", header=False, sep=";")
    assert spark.read.csv(f"{tmp_path}/bare").count() == 2


def test_quarantine_keeps_unreadable_records_of_both_forms(spark, scratch, tmp_path):
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    from ticketlens.sources import json_api

    schema = StructType([StructField("id", LongType()), StructField("name", StringType())])
    lines = tmp_path / "lines"
    lines.mkdir()
    (lines / "a.json").write_text('{"id": 1, "name": "x"}\n{"id": 2, "na\n{"id": 3, "name": null}\n')
    good, bad = json_api.read_quarantined(spark, str(lines), schema, scratch("q-lines"), lines=True)
    assert sorted(r["id"] for r in good.collect()) == [1, 3]
    assert [r[json_api.CORRUPT] for r in bad.collect()] == ['{"id": 2, "na']
    report = json_api.quarantine_report(good, bad).collect()
    assert [(r["good"], r["bad"]) for r in report] == [(2, 1)] and report[0][json_api.SOURCE].endswith("a.json")

    arrays = tmp_path / "arrays"
    arrays.mkdir()
    (arrays / "ok.json").write_text('[{"id": 4, "name": "y"}, {"id": 5, "name": "z"}]')
    (arrays / "broken.json").write_text('[{"id": 6, "name": "y"}, {"id": ')
    good, bad = json_api.read_quarantined(spark, str(arrays), schema, scratch("q-arrays"))
    assert sorted(r["id"] for r in good.collect()) == [4, 5]
    assert [r[json_api.SOURCE].rsplit("/", 1)[-1] for r in bad.collect()] == ["broken.json"]


def test_exact_csv_pieces_equal_a_plain_split(spark, table, scratch):
    import csv
    import io

    from ticketlens.sources import export

    rows = [(f"r{i}", "a;b" if i == 3 else ' "q" ' if i == 5 else "" if i == 7 else None if i == 8 else f"v{i}") for i in range(23)]
    df = table("k string, v string", *rows).repartition(3).sortWithinPartitions("k")
    expected_order = [tuple(r) for r in df.collect()]
    path = scratch("split")
    assert export.split_csv_exact(df, path, rows_per_file=5) == 5
    for k in range(1, 6):
        want = io.StringIO()
        writer = csv.writer(want, delimiter=";", lineterminator="\n")
        writer.writerow(["k", "v"])
        writer.writerows([[x if x is not None else "" for x in r] for r in expected_order[(k - 1) * 5 : k * 5]])
        with open(f"{path.split(':', 1)[-1]}/split_{k}.csv") as file:
            assert file.read() == want.getvalue(), k
    empty = scratch("split-empty")
    assert export.split_csv_exact(df.limit(0), empty, rows_per_file=5) == 1
    with open(f"{empty.split(':', 1)[-1]}/split_1.csv") as file:
        assert file.read() == "k;v\n"


def test_sorted_files_with_bloom_filters_skip_row_groups(spark, scratch):
    from pyspark.sql import functions as F

    from ticketlens.sources import tables

    rows = spark.range(0, 40000).select(
        F.format_string("c%06d@x", (F.col("id") * 7919) % 40000).alias("email"), F.col("id").cast("string").alias("order_number")
    )
    path = scratch("skippable")
    tables.write_skippable(rows, path, "email", files=8, bloom=["order_number"], group_bytes=1 << 14)
    stored = spark.read.parquet(path)
    found = stored.where(F.col("email") == "c012345@x")
    assert found.count() == 1
    found = stored.where(F.col("email") == "c012345@x")
    assert len(found.collect()) == 1 and tables.scan_rows(found) < 40000 // 4
    by_number = stored.where(F.col("order_number") == "777")
    assert [r["email"] for r in by_number.collect()] == [f"c{777 * 7919 % 40000:06d}@x"]
