from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ticketlens.operators import features as ft
from ticketlens.operators import increments as inc
from ticketlens.sources import buckets

ORDERS = "email string, id string, order_number string, show_id string, purchase_date_formatted date, phone string, not_comped int"


def _dims(table):
    shows = table(
        "id string, event_id string, start_date_formatted date, day_of_week int",
        ("s1", "e1", date(2020, 3, 2), 1),
        ("s2", "e2", date(2020, 3, 7), 6),
        ("s3", "e9", date(2020, 4, 1), 3),  # its event is missing: no place
    )
    events = table(
        "id string, venue_id string, name string, special_event int, presents_event int",
        ("e1", "v1", "a", 1, 0),
        ("e2", "v1", "b", 0, 1),
    )
    counts = table(
        "order_number string, tickets long, paid_tickets long, comp_tickets long",
        ("n1", 2, 2, None),
        ("n2", 3, None, 3),
        ("n3", 1, 1, None),
        ("n4", None, None, 4),
    )
    lines = table("order_number string, ticket_price long", ("n1", 500), ("n1", 250), ("n3", None), ("n4", 100))
    return shows, events, counts, lines


def _full(orders, shows, events, counts, lines):
    return {
        "ticket_lead_stats": ft.ticket_lead_stats(orders, shows, counts),
        "lifetime_stats_paid": ft.paid_lifetime(orders, counts),
        "lifetime_stats_comp": ft.comp_lifetime(orders, shows, counts),
        "weekday_attendance": ft.weekday_attendance(orders, shows),
        "special_event_stats": ft.special_event_stats(orders, shows, events),
        "total_spend": ft.total_spend(orders, lines),
    }


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_increments_equal_a_full_rebuild_with_retractions(spark, table, scratch):
    shows, events, counts, lines = _dims(table)
    v1 = table(
        ORDERS,
        ("x@", "1", "n1", "s1", date(2020, 1, 1), "p1", 1),
        ("x@", "2", "n2", "s2", date(2020, 2, 1), "p2", 0),
        ("y@", "3", "n3", "s1", date(2020, 1, 5), None, 1),
        (None, "4", "n4", "s3", None, "p4", 1),
    )
    v2 = table(  # x's newest order gone (dirty), y's changed, z new with an unknown show, x older order
        ORDERS,
        ("x@", "1", "n1", "s1", date(2020, 1, 1), "p1", 1),
        ("x@", "5", "n3", "s2", date(2019, 12, 1), "p5", 1),
        ("y@", "3", "n3", "s2", date(2020, 1, 6), "q3", 1),
        (None, "4", "n4", "s3", None, "p4", 1),
        ("z@", "6", "n1", "s8", date(2020, 1, 9), "p6", 1),
    )
    v3 = v2.where(F.col("email") != "y@")  # every order of y goes: y keeps zeros and no feature row
    facts = lambda o: inc.order_facts(o, shows, events, counts, lines)
    of = lambda now: lambda keys: facts(now.join(keys.select(F.col(inc.KEY).alias("email")), "email", "left_semi"))
    root = scratch("states")
    inc.apply_changes(spark, root, None, facts(v1), of(v1), buckets_count=4)
    for before, after in ((v1, v2), (v2, v3)):
        gone, came = inc.changed_orders(before, after)
        inc.apply_changes(spark, root, facts(gone), facts(came), of(after))
        got = inc.lifetime_features(buckets.read_table(spark, root))
        for name, want in _full(after, shows, events, counts, lines).items():
            assert _rows(got[name].select(*want.columns)) == _rows(want), name
    assert all(r["lead"] == 0 and r["placed"] == 0 for r in buckets.read_table(spark, root).where("subscriber_key = 'y@'").collect())


def test_an_increment_rewrites_only_the_buckets_of_its_customers(spark, table, scratch):
    shows, events, counts, lines = _dims(table)
    many = table(ORDERS, *[(f"c{i}@", str(i), "n1", "s1", date(2020, 1, 1), None, 1) for i in range(40)])
    facts = lambda o: inc.order_facts(o, shows, events, counts, lines)
    root = scratch("touched")
    inc.apply_changes(spark, root, None, facts(many), lambda keys: facts(many), buckets_count=16)
    before = buckets.read_manifest(spark, root)
    one = table(ORDERS, ("c7@", "100", "n2", "s2", date(2020, 5, 1), "p", 0))
    inc.apply_changes(spark, root, None, facts(one), lambda keys: facts(one))
    after = buckets.read_manifest(spark, root)
    assert sum(before.files[b] != after.files[b] for b in before.files) == 1
    assert inc.apply_changes(spark, root, None, None, lambda keys: keys) == -1


def test_windows_from_the_day_rollup_equal_recency_spend(spark, table):
    from ticketlens.operators import rollups

    orders = table(
        "email string, purchase_date_formatted date, not_comped int, comped int, order_total long",
        ("x@", date(2020, 1, 1), 1, 0, 1050),
        ("x@", date(2020, 1, 1), 1, 0, None),
        ("x@", date(2019, 11, 3), 0, 1, 70),
        ("x@", date(2019, 3, 3), 1, 0, 250),
        ("x@", None, 1, 0, 990),
        ("y@", date(2020, 6, 30), 1, 0, 10),
        (None, date(2019, 12, 31), 1, 0, 5),
        ("z@", None, 0, 1, None),
    )
    rollup = rollups.day_rollup(orders)
    for as_of in ("2020-01-01", "2020-06-30 12:00:00", "2019-12-31"):
        got = rollups.recency_from_rollup(rollup, as_of)
        want = ft.recency_spend(orders, as_of)
        assert _rows(got.select(*want.columns)) == _rows(want), as_of
