from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ticketlens.operators import features as ft
from ticketlens.operators import marts
from ticketlens.operators import processed as pr
from ticketlens.operators.customer360 import (
    customer_360,
    customer_360_from_features,
    customer_features,
    split_features,
)
from ticketlens.plans.rebuild import BaseTables, feature_tables, processed_tables
from ticketlens.schemas import CONTACTS, EVENTS, ORDERLINES, ORDERS, SHOWS, VENUES

AS_OF = "2018-04-30"


def order(number, email, show, bought="2018-04-01", pay="card", total=1000, phone="1", oid=None):
    stamp = datetime.fromisoformat(bought)
    return (oid or f"o{number}", show, number, "7", email, phone, stamp, pay, "web", total, "True", stamp, "")


def line(number, ticket, price=500):
    return (f"{number}-{ticket}", number, "GA", price, "True", None, "False")


@pytest.fixture
def world(spark):
    """Shows: s1 Mon 2018-04-23, s2 Sat 2018-04-28, s3 and s4 both 2018-04-10, s5 ahead, s6 today."""

    def show(sid, event, day):
        return (sid, event, datetime.fromisoformat(f"{day} 19:30:00"), "False", None)

    shows = [
        show("s1", "e1", "2018-04-23"),
        show("s2", "e1", "2018-04-28"),
        show("s3", "eB", "2018-04-10"),
        show("s4", "eA", "2018-04-10"),
        show("s5", "e1", "2018-05-10"),
        show("s6", "eA", "2018-04-30"),
        show("s7", "gone", "2018-04-10"),
    ]
    events = [
        ("e1", "v1", "Club special EVENT", ""),
        ("eA", "v2", "A", ""),
        ("eB", "v1", "B presents", ""),
        ("eX", "nowhere", "X", ""),
    ]
    emails = ["mon@x", "sat@x", "tie@x", "today@x", "idle@x", "two@x"]
    orders = [
        order("1", "mon@x", "s1"),
        order("2", "sat@x", "s2", pay="COMP ticket"),
        order("3", "tie@x", "s3"),
        order("4", "tie@x", "s4", bought="2018-04-02", phone="2"),
        order("5", "today@x", "s6"),
        order("6", "today@x", "s5", pay=""),
        order("7", "two@x", "s1"),
        order("8", "two@x", "s1", bought="2018-04-03"),
        order("9", "none", "s1"),
        order("10", "two@x", "s7"),
        order("11", "stranger@x", "s1"),
        order("12", "two@x", "missing"),
    ]
    lines = [line(str(n), t) for n in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12) for t in range(1 + n % 2)]
    frame = spark.createDataFrame
    return BaseTables(
        contacts=frame([(e, e[:3], e[:1], "", datetime(2018, 1, 1)) for e in emails], CONTACTS),
        venues=frame([("v1", "One", None, None, "10"), ("v2", "Two", None, None, None)], VENUES),
        events=frame(events, EVENTS),
        shows=frame(shows, SHOWS),
        orders=frame(orders, ORDERS),
        orderlines=frame(lines, ORDERLINES),
    )


def by_key(df, key="subscriber_key"):
    return {row[key]: row.asDict() for row in df.collect()}


def test_weekday_modes(world):
    p = processed_tables(world)
    orders, shows = p["orders_processed"], p["shows_processed"]
    week = "MTWRFSU"

    def cells(mode, count_mode, email):
        row = by_key(ft.weekday_attendance(orders, shows, mode, count_mode))[email]
        return {d: row[f"shows_attended_{d}"] for d in week if row[f"shows_attended_{d}"]}

    assert cells("corrected", "orders", "mon@x") == {"M": 1}
    assert cells("corrected", "orders", "two@x") == {"M": 2, "T": 1}
    assert cells("corrected", "reference", "two@x") == {"M": 1, "T": 1}
    assert cells("reference", "orders", "mon@x") == {"W": 1}
    assert cells("reference", "reference", "sat@x") == {}
    with pytest.raises(ValueError):
        ft.weekday_columns(F.col("x"), "other", "orders")


def test_flags(world):
    rows = by_key(processed_tables(world)["orders_processed"], "order_number")
    assert (rows["2"]["comped"], rows["2"]["not_comped"]) == (1, 0)
    assert (rows["6"]["comped"], rows["6"]["not_comped"]) == (0, 1)
    unknown = pr.orders_processed(world.orders.withColumn("payment_method", F.lit(None).cast("string")))
    assert {(r["comped"], r["not_comped"]) for r in unknown.collect()} == {(0, 0)}
    events = by_key(processed_tables(world)["events_processed"], "id")
    assert (events["e1"]["special_event"], events["e1"]["presents_event"]) == (1, None)
    assert (events["eB"]["special_event"], events["eB"]["presents_event"]) == (None, 1)


def test_first_last_next(world):
    p = processed_tables(world)
    visited = marts.visits(p["orders_processed"], p["shows_processed"], p["events_processed"], world.venues)
    rows = by_key(ft.for_all_contacts(ft.first_last_next(visited, AS_OF), world.contacts))
    tie = rows["tie@x"]
    assert (tie["first_event_title"], tie["first_event_venue"]) == ("A", "v2")
    assert (tie["last_event_title"], tie["last_event_venue"]) == ("A", "v2")
    today = rows["today@x"]
    assert today["last_show_attended"] == date(2018, 4, 30)
    assert today["next_show_attending"] == date(2018, 5, 10)
    assert rows["idle@x"]["first_show_attended"] is None
    assert "stranger@x" not in rows


def test_recency_edges(table):
    rows = [
        ("a", date(2018, 1, 30), 1, 0, 250),  # exactly 90 days
        ("b", date(2018, 1, 29), 1, 0, 100),  # 91 days
        ("c", date(2018, 4, 30), 1, 0, 249),
        ("d", date(2018, 4, 30), 0, 1, 700),
        ("e", date(2018, 5, 1), 1, 0, 100),  # after as_of
    ]
    orders = table(
        "email string, purchase_date_formatted date, not_comped int, comped int, order_total bigint", *rows
    )
    out = by_key(ft.recency_spend(orders, AS_OF))

    def cell(email):
        row = out[email]
        revenue = row["paid_orders_revenue_90"]
        return (None if revenue is None else int(revenue), row["paid_orders_count_90"], row["comp_orders_count_90"])

    assert [cell(k) for k in "abcde"] == [(3, 1, 0), (None, 0, 0), (2, 1, 0), (None, 0, 1), (None, 0, 0)]
    assert out["b"]["paid_orders_count_180"] == 1
    # Later on the 90-day-old day's midnight lies before the bound.
    noon = by_key(ft.recency_spend(orders, f"{AS_OF}T12:00:00"))
    assert noon["a"]["paid_orders_count_90"] == 0


def test_special_events_take_the_newest_phone(world):
    p = processed_tables(world)
    stats = by_key(ft.special_event_stats(p["orders_processed"], p["shows_processed"], p["events_processed"]))
    assert stats["tie@x"]["phone"] == "2"
    assert stats["tie@x"]["last_ordered_date"] == date(2018, 4, 2)
    assert (stats["tie@x"]["count_shows_special"], stats["tie@x"]["count_shows_persents"]) == (0, 1)
    assert stats["two@x"]["count_shows_special"] == 2


def wide_fused(world, **modes):
    p = processed_tables(world)
    args = [p[f"{n}_processed"] for n in ("orders", "orderlines", "shows", "events")]
    return customer_360(world.contacts, *args, world.venues, AS_OF, **modes)


def wide_joined(world):
    p = processed_tables(world)
    args = [p[f"{n}_processed"] for n in ("orders", "orderlines", "shows", "events")]
    mart = marts.orders_mart(*args, world.venues)
    tables = feature_tables(world, p, marts.ticket_counts(mart), AS_OF)
    del tables["attended_event_dates"]
    return customer_360_from_features(world.contacts, list(tables.values()))


def test_wide_table_equals_joined_features(world):
    fused, joined = wide_fused(world), wide_joined(world)
    assert len(fused.columns) == 45
    assert by_key(fused, "email_address") == by_key(joined, "email_address")
    rows = by_key(fused, "email_address")
    assert len(rows) == fused.count() == 6
    idle = rows["idle@x"]
    assert idle["total_orders"] == 0
    assert all(v is None for k, v in idle.items() if k not in ("email_address", "total_orders", "sys_entry_date")
               and not k.startswith("cust_name"))
    # Order 10's event and order 12's show are unknown: no tickets counted, but both are revenue.
    two = rows["two@x"]
    assert (two["total_lifetime_paid_orders"], two["total_lifetime_paid_tickets"]) == (2, 3)
    assert int(two["total_revenue"]) == 25
    assert two["shows_attended_M"] == 2 and two["shows_attended_T"] == 1


def test_wide_table_with_repeated_order_numbers(world, spark):
    """Two orders with one number multiply its lines, in both forms alike."""
    extra = spark.createDataFrame(
        [order("1", "tie@x", "s2", oid="o1b", pay="comp"), order("7", "mon@x", "s7", oid="o7b")], ORDERS
    )
    doubled = BaseTables(**{**world.__dict__, "orders": world.orders.unionByName(extra)})
    fused, joined = wide_fused(doubled), wide_joined(doubled)
    assert by_key(fused, "email_address") == by_key(joined, "email_address")
    numbers = marts.duplicate_order_numbers(doubled.orders)
    assert sorted(r["order_number"] for r in numbers.collect()) == ["1", "7"]


def test_unique_order_numbers_shortcut(world):
    short = wide_fused(world, unique_order_numbers=True)
    assert by_key(wide_fused(world), "email_address") == by_key(short, "email_address")


def test_orphans_and_mart(world):
    p = processed_tables(world)
    args = [p[f"{n}_processed"] for n in ("orders", "orderlines", "shows", "events")]
    mart = marts.orders_mart(*args, world.venues)
    assert len(mart.columns) == 19
    numbers = {r["orderNumber"] for r in mart.select("orderNumber").distinct().collect()}
    assert numbers == {str(n) for n in range(1, 12) if n != 10}
    bare = world.orderlines.where("order_number <> '3'")
    orphans = marts.order_orphans(args[0], pr.orderlines_processed(bare), args[2], args[3], world.venues)
    assert {r["order_number"]: r["missing"] for r in orphans.collect()} == {"3": "line", "10": "event", "12": "show"}


def test_attended_events_are_known_contacts_only(world):
    p = processed_tables(world)
    out = marts.attended_events(
        world.contacts, p["orders_processed"], p["shows_processed"], p["events_processed"], world.venues
    )
    assert sorted(r["subscriber_key"] for r in out.collect()) == sorted(
        ["mon@x", "sat@x", "tie@x", "tie@x", "today@x", "today@x", "two@x", "two@x"]
    )


def test_clean_phones(table):
    rows = table("p string", ("(1) 2",), ("",), (None,))
    kept = [r["p"] for r in pr.clean_phones(rows, "p", keep_missing=True).collect()]
    assert kept == ["12", "", None]
    assert [r["p"] for r in pr.clean_phones(rows, "p").collect()] == ["12", "", ""]


def test_feature_tables_are_projections_of_one_aggregate(world):
    """Apart from placeholder emails, which the one aggregate leaves out."""
    p = processed_tables(world)
    args = [p[f"{n}_processed"] for n in ("orders", "orderlines", "shows", "events")]
    separate = feature_tables(world, p, marts.ticket_counts(marts.orders_mart(*args, world.venues)), AS_OF)
    del separate["attended_event_dates"]
    together = split_features(customer_features(*args, world.venues, AS_OF), world.contacts)
    assert set(separate) == set(together)
    for name, table in separate.items():
        expected = {k: v for k, v in by_key(table).items() if k != "none"}
        assert by_key(together[name]) == expected, name


def test_rebuild_all(world, spark, scratch):
    from ticketlens.plans.rebuild import rebuild_all
    from ticketlens.schemas import CRM_CONTACTS, MESSAGES

    sent = datetime(2018, 4, 1)
    messages = spark.createDataFrame([("2", "k", "s", "c", "Stop", None, sent), ("9", "k", "s", "c", "hi", None, sent)], MESSAGES)
    crm = spark.createDataFrame([("crm@x", "(9)", "Yes", sent)], CRM_CONTACTS)
    full = BaseTables(**{**world.__dict__, "messages": messages, "crm_contacts": crm})
    tables = rebuild_all(spark, full, scratch("rebuild"), AS_OF)
    assert by_key(tables["contacts_mv"], "email_address") == by_key(wide_fused(world), "email_address")
    subscribers = {r["mobile_number"]: (r["email_address"], r["mobile_status"])
                   for r in tables["contacts_mobile_mv"].collect()}
    assert subscribers == {"2": ("tie@x", "Unsubscribed"), "9": ("crm@x", "Subscribed")}


def test_runs_read_only_the_days_they_need_and_a_failed_rebuild_leaves_the_tables(world, spark, scratch):
    from ticketlens.operators import selection
    from ticketlens.plans.rebuild import by_entry_day
    from ticketlens.sources.tables import read_version, write_version

    p = processed_tables(world)
    mart = marts.orders_mart(*[p[f"{n}_processed"] for n in ("orders", "orderlines", "shows", "events")], world.venues)
    root = scratch("mart")
    write_version(by_entry_day(mart), root, ["entry_day"])
    stored = read_version(spark, root)
    assert stored.count() == mart.count()
    runs = [lambda m: selection.changed_orders(m, "2018-03-01", "2018-04-02"), lambda m: selection.historical_orders(m, "2018-04-01")]
    for run in runs:
        assert sorted(map(str, run(stored).select(*mart.columns).collect())) == sorted(map(str, run(mart).collect()))
        plan = run(stored)._jdf.queryExecution().executedPlan().toString()
        filters = next(part for part in plan.split("PartitionFilters: [")[1:])
        assert filters.startswith(("isnotnull(entry_day", "((entry_day", "(isnull(entry_day", "isnull(entry_day")), filters[:80]
    with pytest.raises(Exception, match="planned"):
        write_version(mart.withColumn("x", F.raise_error(F.lit("planned"))), root)
    assert read_version(spark, root).count() == stored.count()
