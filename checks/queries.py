"""One query per operator over the given test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.bindings import (
    AS_OF,
    CUTOFF,
    MARK,
    MESSAGES_AS_OF,
    MESSAGES_MARK,
    OPTIONS,
    TestTables,
    parsed,
)
from ticketlens import functions as fn
from ticketlens.functions.sqlfuncs import register_functions
from ticketlens.operators import features as ft
from ticketlens.operators import ingest, marts, optin, payloads, quality, selection, sms, tags
from ticketlens.operators import processed as pr
from ticketlens.operators import batches, lookups, skew
from ticketlens.operators import customer360
from ticketlens.operators import increments as inc
from ticketlens.operators import rollups
from ticketlens.plans import rebuild
from ticketlens.schemas import CONTACTS, CRM_CONTACTS, EVENTS, MESSAGES, ORDERLINES, ORDERS, SHOWS
from ticketlens.sources import export, json_api
from ticketlens.sources import tables as store
from ticketlens.sources import marks as mk
from ticketlens.sources import runs
from ticketlens.sources import buckets as bk
from ticketlens.sources.colocated import write_colocated
from ticketlens.sources.scratch import scratch_dir
from ticketlens.sources import upsert as up
from ticketlens.streaming import messages as sm
from ticketlens.streaming import webhooks as wh

Query = Callable[[TestTables], DataFrame]
_QUERIES: dict[str, Query] = {}

ENTRY = "1998-07-01"
# Landed order documents are long and alike: compressed they take a fraction of the disk.
LANDING_CODEC = "snappy"


def query(build: Query) -> Query:
    _QUERIES[build.__name__] = build
    return build


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bound(build) for name, build in _QUERIES.items()}


def _bound(build: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: comparable(build(TestTables(spark, sf_dir)))


def comparable(df: DataFrame) -> DataFrame:
    """Dates and times as text and whole amounts as BIGINT, as in the twins."""
    casts = {}
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        if kind in ("date", "timestamp", "timestamp_ntz"):
            casts[field.name] = F.col(field.name).cast("string")
        elif kind == "decimal":
            casts[field.name] = F.col(field.name).cast("bigint")
    return df.withColumns(casts) if casts else df


# --- inputs shared by several queries -------------------------------------------------


def _places(t: TestTables) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    p = t.processed()
    return p["orders_processed"], p["shows_processed"], p["events_processed"], t.venues()


def _mart(t: TestTables) -> DataFrame:
    orders, shows, events, venues = _places(t)
    return marts.orders_mart(orders, t.processed()["orderlines_processed"], shows, events, venues)


def _counts(t: TestTables) -> DataFrame:
    return marts.ticket_counts(_mart(t))


def _wide(t: TestTables) -> DataFrame:
    return rebuild.wide_table(rebuild.BaseTables(contacts=t.contacts(), venues=t.venues()), t.processed(), AS_OF, OPTIONS)


def _messages(t: TestTables) -> DataFrame:
    return sms.enrich_message_email(t.messages(), t.crm_contacts(), _wide(t))


def _subscribers(t: TestTables) -> DataFrame:
    return sms.sms_subscribers(_messages(t))


def _conflicts(t: TestTables) -> DataFrame:
    return optin.optin_conflicts(_subscribers(t), t.crm_contacts())


def _backlog(t: TestTables) -> DataFrame:
    return tags.backlog_tags(_subscribers(t), t.messages(), t.tag_map())


def _daily(t: TestTables) -> DataFrame:
    return tags.daily_tags(_subscribers(t), t.messages(), t.tag_map(), MESSAGES_MARK, MESSAGES_AS_OF)


def _changed(t: TestTables) -> DataFrame:
    return selection.changed_orders(_mart(t), MARK, AS_OF)


def _selected(t: TestTables) -> DataFrame:
    return selection.changed_contacts(_wide(t), _mart(t), t.processed()["shows_processed"], MARK, AS_OF)


def _grouped(t: TestTables) -> DataFrame:
    return payloads.group_order_lines(_changed(t))


def _pushed(t: TestTables) -> DataFrame:
    placed = lookups.with_venue_lookup(_grouped(t), t.connections(), "venue_id", "connection").where("mapped")
    known = placed.join(t.crm_customers(_changed(t)), ["connection", "email"])
    return lookups.plan_order_push(known, t.order_link())


def _results(t: TestTables) -> DataFrame:
    outcome = quality.classify_response(F.col("status"), F.col("body"))
    return t.responses().select("venue_id", F.lit("order").alias("entity"), "key", outcome.alias("outcome"))


def _scratch(t: TestTables, name: str) -> str:
    return scratch_dir(t.spark, name)


def _kept(t: TestTables, name: str, df: DataFrame) -> DataFrame:
    """A table that many steps read, written once and read back as a rebuild keeps it."""
    path = _scratch(t, name)
    df.write.parquet(path)
    return t.spark.read.schema(df.schema).parquet(path)


def _stamped(messages: DataFrame) -> DataFrame:
    return messages.withColumn("stamp", fn.to_second(F.col("timestamp"))).drop("timestamp")


# --- sources and sinks ----------------------------------------------------------------


@query
def load_table(t: TestTables) -> DataFrame:
    wanted = "o_orderdate >= timestamp_ntz'1998-01-01 00:00:00' AND o_orderpriority = '5-LOW'"
    return store.load_table(t.spark, f"{t.sf_dir}/orders.parquet", where=wanted).select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@query
def full_refresh(t: TestTables) -> DataFrame:
    path = _scratch(t, "orders_processed")
    store.full_refresh(t.processed()["orders_processed"], path)
    return store.load_table(t.spark, path)


def _upserted(t: TestTables, name: str, table: DataFrame, keys: list[str], schema, change: dict, new_key) -> DataFrame:
    """A third of the table changed and added again under new keys, applied twice."""
    root = _scratch(t, name)
    up.upsert_table(t.spark, root, table, keys, schema)
    third = store.read_version(t.spark, root).where(change.pop("where")).withColumns(change)
    updates = third.unionByName(third.withColumn(new_key, F.concat(F.lit("new-"), F.col(new_key))))
    for _ in range(2):
        up.upsert_table(t.spark, root, updates, keys, schema)
    return store.read_version(t.spark, root)


@query
def upsert_contacts(t: TestTables) -> DataFrame:
    change = {
        "where": "cast(name_last AS bigint) % 3 = 0",
        "name": F.concat("name", F.lit(" (new)")),
        "sys_entry_date": F.expr("timestamp_ntz'1998-07-02 00:00:00'"),
    }
    return _upserted(t, "contacts", t.contacts(), ["email_address"], CONTACTS, change, "email_address")


@query
def upsert_events(t: TestTables) -> DataFrame:
    change = {"where": "cast(id AS int) % 3 = 0", "name": F.concat("name", F.lit(" (new)"))}
    return _upserted(t, "events", t.events(), ["id"], EVENTS, change, "id")


@query
def upsert_shows(t: TestTables) -> DataFrame:
    change = {"where": "cast(id AS bigint) % 3 = 0", "sold_out": F.lit("sold")}
    return _upserted(t, "shows", t.shows(), ["id"], SHOWS, change, "id")


@query
def upsert_orders(t: TestTables) -> DataFrame:
    change = {"where": "cast(id AS bigint) % 3 = 0", "order_total": F.col("order_total") + 1}
    return _upserted(t, "orders", t.orders(), ["id"], ORDERS, change, "id").select(
        "id", "order_number", "email", "order_total"
    )


@query
def upsert_orderlines(t: TestTables) -> DataFrame:
    """Line ids repeat in the given tables; the dearest line of each id is kept."""
    root = _scratch(t, "orderlines")
    up.upsert_table(
        t.spark, root, t.orderlines(), ["id"], ORDERLINES, [F.col("ticket_price").desc_nulls_last()]
    )
    return store.read_version(t.spark, root).select("id", "order_number", "ticket_price")


@query
def upsert_links(t: TestTables) -> DataFrame:
    link = t.order_link()
    changed = link.withColumn("crm_id", F.concat(F.lit("y"), "order_number"))
    eighth = F.col("order_number").cast("bigint") % 8
    new = changed.where(eighth == 4).withColumn("connection", F.lit("99"))
    return up.upsert_links(link, changed.where(eighth == 0).unionByName(new))


@query
def append_messages(t: TestTables) -> DataFrame:
    path = _scratch(t, "messages")
    for half in ("security_code < '5'", "security_code >= '5'"):
        store.append_rows(t.messages().where(half), path)
    return _stamped(store.load_table(t.spark, path, MESSAGES))


@query
def export_csv_chunks(t: TestTables) -> DataFrame:
    path = _scratch(t, "contacts-csv")
    export.export_csv_chunks(t.contacts().drop("sys_entry_date"), path, rows_per_file=100, sep=";")
    schema = "email_address string, name string, name_first string, name_last string"
    return t.spark.read.schema(schema).csv(path, sep=";", header=True)


@query
def split_contacts_csv_exact(t: TestTables) -> DataFrame:
    """Contacts in files of exactly 100 rows, read back from all files."""
    path = _scratch(t, "contacts-split")
    export.split_csv_exact(t.contacts().drop("sys_entry_date"), path, rows_per_file=100, sep=";")
    schema = "email_address string, name string, name_first string, name_last string"
    return t.spark.read.schema(schema).csv(path, sep=";", header=True)


@query
def write_payloads(t: TestTables) -> DataFrame:
    path = _scratch(t, "payloads")
    export.write_payloads(payloads.order_payloads(_pushed(t)), path)
    order = "value", "struct<ecomOrder:struct<externalid:string,email:string,orderNumber:string," \
        "totalPrice:string,connectionid:int,customerid:bigint>>"
    read = t.spark.read.schema("value string, venue_id string").text(path)
    return read.select("venue_id", F.from_json(*order).alias("o")).select(
        "venue_id",
        "o.ecomOrder.externalid",
        "o.ecomOrder.email",
        "o.ecomOrder.orderNumber",
        F.col("o.ecomOrder.totalPrice").alias("total_price"),
        F.col("o.ecomOrder.connectionid").alias("connection"),
        F.col("o.ecomOrder.customerid").alias("crm_customer_id"),
    )


@query
def run_incremental(t: TestTables) -> DataFrame:
    """Two runs from one mark to the next; together they see every row once."""
    marks, sink = _scratch(t, "marks"), _scratch(t, "orders-seen")

    def work(mark, upper) -> None:
        fresh = selection.after_mark(F.col("sys_entry_date"), mark, upper)
        store.append_rows(t.orders().where(fresh).select("id", "sys_entry_date"), sink)

    for upper in (MARK, AS_OF):
        mk.run_incremental(t.spark, marks, "orders", upper, work, default=CUTOFF)
    return store.load_table(t.spark, sink)


@query
def run_job_windows(t: TestTables) -> DataFrame:
    """Two runs whose output and mark are one commit each; all published outputs see every row once."""
    root = _scratch(t, "runs")

    def work(mark, upper) -> dict[str, DataFrame]:
        fresh = selection.after_mark(F.col("sys_entry_date"), mark, upper)
        return {"orders_seen": t.orders().where(fresh).select("id", "sys_entry_date")}

    for upper in (MARK, AS_OF, MARK):  # the last run lies before the mark and publishes nothing
        runs.run_job(t.spark, root, "orders", upper, work, default=CUTOFF)
    return runs.read_output(t.spark, root, "orders", "orders_seen", all_runs=True)


@query
def read_orders_json(t: TestTables) -> DataFrame:
    path = _scratch(t, "orders-json")
    t.order_json().write.text(path, compression=LANDING_CODEC)
    flat = ingest.flatten_orders(json_api.read_orders_json(t.spark, path, lines=True), ENTRY)
    return flat.drop("order_total", "bad_prices", "phone")


@query
def read_orders_json_quarantined(t: TestTables) -> DataFrame:
    """Every order landed whole and once more cut in half: the halves go to quarantine, the rest as usual."""
    path = _scratch(t, "orders-json-damaged")
    t.order_json().write.text(path, compression=LANDING_CODEC)
    half = F.expr("substring(value, 1, length(value) DIV 2)").alias("value")
    t.order_json().select(half).write.mode("append").text(path, compression=LANDING_CODEC)
    good, bad = json_api.read_quarantined(t.spark, path, json_api.LANDED_ORDER_JSON, _scratch(t, "orders-read"), lines=True)
    flat = ingest.flatten_orders(good.drop(json_api.SOURCE), ENTRY)
    return flat.drop("order_total", "bad_prices", "phone")


@query
def read_catalog_json(t: TestTables) -> DataFrame:
    path = _scratch(t, "catalog-json")
    t.catalog_json().write.text(path)
    catalog = json_api.read_catalog_json(t.spark, path, lines=True)
    shows = ingest.recent_shows(catalog, "1990-01-01")
    events = ingest.flatten_events(catalog).distinct()
    return shows.drop("venue_id").join(events.withColumnRenamed("id", "event_id"), "event_id")


@query
def read_show_json(t: TestTables) -> DataFrame:
    path = _scratch(t, "show-json")
    t.show_json().write.text(path)
    return ingest.flatten_shows(json_api.read_show_json(t.spark, path, lines=True))


# --- ingest ---------------------------------------------------------------------------


def _catalog(t: TestTables) -> DataFrame:
    return parsed(t.catalog_json(), json_api.CATALOG_JSON)


@query
def flatten_orders(t: TestTables) -> DataFrame:
    return ingest.flatten_orders(t.order_sightings(), ENTRY).drop("phone")


@query
def merge_order_sightings(t: TestTables) -> DataFrame:
    flat = ingest.flatten_orders(t.order_sightings(), ENTRY)
    return ingest.merge_order_sightings(
        flat, F.col("show_id").cast("bigint"), keys=["order_number"]
    ).drop("venue_id", "phone")


@query
def flatten_orderlines(t: TestTables) -> DataFrame:
    return ingest.flatten_orderlines(t.order_sightings())


@query
def flatten_contacts(t: TestTables) -> DataFrame:
    return ingest.flatten_contacts(ingest.first_sightings(t.order_sightings()), ENTRY).distinct()


@query
def backfill_contacts(t: TestTables) -> DataFrame:
    return ingest.backfill_contacts(t.order_sightings("customer")).distinct()


@query
def flatten_events(t: TestTables) -> DataFrame:
    return ingest.flatten_events(_catalog(t)).distinct()


@query
def recent_shows(t: TestTables) -> DataFrame:
    return ingest.recent_shows(_catalog(t), MARK)


@query
def flatten_shows(t: TestTables) -> DataFrame:
    return ingest.flatten_shows(parsed(t.show_json(), json_api.SHOW_JSON))


@query
def bad_price_report(t: TestTables) -> DataFrame:
    flat = ingest.flatten_orders(t.order_sightings(), ENTRY)
    merged = ingest.merge_order_sightings(flat, keys=["order_number"])
    return ingest.bad_price_report(merged).drop("venue_id")


# --- cleaned copies -------------------------------------------------------------------


@query
def orderlines_processed(t: TestTables) -> DataFrame:
    return t.processed()["orderlines_processed"]


@query
def orders_processed(t: TestTables) -> DataFrame:
    return t.processed()["orders_processed"]


@query
def shows_processed(t: TestTables) -> DataFrame:
    return t.processed()["shows_processed"]


@query
def events_processed(t: TestTables) -> DataFrame:
    return t.processed()["events_processed"]


@query
def clean_phones(t: TestTables) -> DataFrame:
    return pr.clean_phones(t.crm_contacts().select("email", "mobile_number"), "mobile_number")


# --- filters and selections -----------------------------------------------------------


@query
def valid_email(t: TestTables) -> DataFrame:
    mixed = t.raw("customer").selectExpr(
        "CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'None' WHEN 3 THEN 'none'"
        " ELSE concat('c', c_custkey, '@example.com') END AS email"
    )
    return selection.valid_email(mixed, "email").groupBy("email").agg(F.count(F.lit(1)).alias("n"))


@query
def shows_to_repull(t: TestTables) -> DataFrame:
    shows = selection.shows_to_repull(t.shows(), t.events(), ["1", "5", "6", "7"], MARK)
    return shows.select("id", "event_id", "start_date_time")


@query
def changed_orders(t: TestTables) -> DataFrame:
    return _changed(t)


@query
def historical_orders(t: TestTables) -> DataFrame:
    return selection.historical_orders(_mart(t), CUTOFF, ["5", "6", "7", "23"])


@query
def changed_contacts(t: TestTables) -> DataFrame:
    return _selected(t)


def _brief(wide: DataFrame) -> DataFrame:
    return wide.select("email_address", "phone", "total_orders")


@query
def extra_push_contacts(t: TestTables) -> DataFrame:
    shows = t.processed()["shows_processed"]
    return _brief(selection.extra_push_contacts(_wide(t), _mart(t), shows, MARK, AS_OF))


@query
def boundary_contacts(t: TestTables) -> DataFrame:
    return _brief(selection.boundary_contacts(_wide(t), _mart(t), AS_OF))


@query
def contacts_at_venues(t: TestTables) -> DataFrame:
    return _brief(selection.contacts_at_venues(_wide(t), _mart(t), ["3", "23"]))


@query
def contacts_with_entry_date(t: TestTables) -> DataFrame:
    return selection.contacts_with_entry_date(t.contacts(), "1998-03-01").select("email_address", "name")


@query
def distinct_emails(t: TestTables) -> DataFrame:
    return selection.distinct_emails(_mart(t))


@query
def optin_conflicts(t: TestTables) -> DataFrame:
    return optin.in_conflict_order(_conflicts(t))


@query
def optin_conflicts_since_mark(t: TestTables) -> DataFrame:
    conflicts = optin.optin_conflicts(_subscribers(t), t.crm_contacts(), MESSAGES_MARK, MESSAGES_AS_OF)
    return conflicts.select("email_address", "mobile_number", "mobile_status")


# --- joins ----------------------------------------------------------------------------


@query
def orders_mart(t: TestTables) -> DataFrame:
    return _mart(t)


@query
def order_orphans(t: TestTables) -> DataFrame:
    orders, shows, events, venues = _places(t)
    return marts.order_orphans(orders, t.processed()["orderlines_processed"], shows, events, venues)


@query
def attended_events(t: TestTables) -> DataFrame:
    return marts.attended_events(t.contacts(), *_places(t))


@query
def customer_360(t: TestTables) -> DataFrame:
    return _wide(t)


@query
def customer_360_from_features(t: TestTables) -> DataFrame:
    orders = _kept(t, "orders_processed", t.processed()["orders_processed"])
    processed = t.processed() | {"orders_processed": orders}
    lines, shows, events = (processed[f"{name}_processed"] for name in ("orderlines", "shows", "events"))
    mart = marts.orders_mart(orders, lines, shows, events, t.venues())
    counts = _kept(t, "ticket_counts", marts.ticket_counts(mart))
    features = rebuild.feature_tables(t.base(), processed, counts, AS_OF, OPTIONS)
    del features["attended_event_dates"]
    wide = customer360.customer_360_from_features(t.contacts(), list(features.values()))
    return pr.clean_phones(wide, "phone", keep_missing=True)


@query
def enrich_message_email(t: TestTables) -> DataFrame:
    return _stamped(_messages(t)).select("mobile_number", "campaign", "email", "stamp")


@query
def missing_tags(t: TestTables) -> DataFrame:
    return tags.missing_tags(_daily(t), t.tag_dim())


@query
def with_venue_lookup(t: TestTables) -> DataFrame:
    lines = _mart(t).select("orderNumber", "unique_id", "venue_id")
    return lookups.with_venue_lookup(lines, t.connections(), "venue_id", "connection")


@query
def plan_order_push(t: TestTables) -> DataFrame:
    return _pushed(t).select(
        "venue_id", "email", "orderNumber", "connection", "crm_customer_id", "crm_id", "action"
    )


# --- aggregations ---------------------------------------------------------------------


@query
def ticket_counts(t: TestTables) -> DataFrame:
    return _counts(t)


@query
def order_number_totals(t: TestTables) -> DataFrame:
    orders, shows, events, venues = _places(t)
    placed = marts.place_orders(orders, shows, events, venues)
    return marts.order_number_totals(placed, t.processed()["orderlines_processed"])


@query
def order_number_totals_colocated(t: TestTables) -> DataFrame:
    """As :func:`order_number_totals`, from orders and lines stored in the same buckets of the order number."""
    orders, shows, events, venues = _places(t)
    n = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    stored_orders = write_colocated(orders, "colocated_orders", "order_number", n)
    stored_lines = write_colocated(t.processed()["orderlines_processed"], "colocated_lines", "order_number", n)
    placed = marts.place_orders(stored_orders, shows, events, venues)
    return marts.order_number_totals(placed, stored_lines)


@query
def duplicate_order_numbers(t: TestTables) -> DataFrame:
    """Line ids stand in for order numbers, which never repeat in the given tables."""
    return marts.duplicate_order_numbers(t.orderlines().select(F.col("id").alias("order_number")))


@query
def first_last_next(t: TestTables) -> DataFrame:
    return ft.for_all_contacts(ft.first_last_next(marts.visits(*_places(t)), AS_OF), t.contacts())


@query
def ticket_lead_stats(t: TestTables) -> DataFrame:
    orders, shows, _, _ = _places(t)
    return ft.of_contacts(ft.ticket_lead_stats(orders, shows, _counts(t)), t.contacts())


@query
def lifetime_stats_paid(t: TestTables) -> DataFrame:
    return ft.of_contacts(ft.lifetime_stats(_places(t)[0], _counts(t), "not_comped"), t.contacts())


@query
def lifetime_stats_comp(t: TestTables) -> DataFrame:
    orders, shows, _, _ = _places(t)
    return ft.of_contacts(ft.lifetime_stats(orders, _counts(t), "comped", shows), t.contacts())


@query
def weekday_attendance_corrected(t: TestTables) -> DataFrame:
    orders, shows, _, _ = _places(t)
    return ft.weekday_attendance(orders, shows)


@query
def weekday_attendance_reference(t: TestTables) -> DataFrame:
    orders, shows, _, _ = _places(t)
    return ft.weekday_attendance(orders, shows, "reference", "reference")


@query
def recency_spend(t: TestTables) -> DataFrame:
    return ft.recency_spend(_places(t)[0], AS_OF)


@query
def recency_spend_from_rollup(t: TestTables) -> DataFrame:
    """The day rollup is written once, as a job would keep it, and the windows are looked up in it."""
    path = _scratch(t, "day_rollup")
    rollups.day_rollup(_places(t)[0]).write.parquet(path)
    return rollups.recency_from_rollup(t.spark.read.parquet(path), AS_OF)


@query
def special_event_stats(t: TestTables) -> DataFrame:
    orders, shows, events, _ = _places(t)
    return ft.special_event_stats(orders, shows, events)


@query
def total_spend(t: TestTables) -> DataFrame:
    return ft.total_spend(_places(t)[0], t.processed()["orderlines_processed"])


# Purchase days at which orders arrive: before the first, then up to the second, then the rest.
INCREMENT_DAYS = ("1997-08-23", "1999-08-27")


def _lifetime_states(t: TestTables) -> DataFrame:
    """Lifetime states kept by increments: a first load with phones missing, then two increments.

    The second part restores the phones of the first (a retraction of every newest order that had
    one) and adds orders up to the second day; the third adds the rest. The result must equal the
    full features over all orders.
    """
    _, shows, events, venues = _places(t)
    lines = t.processed()["orderlines_processed"]
    orders = _kept(t, "orders_processed", t.processed()["orders_processed"])
    counts = _kept(t, "ticket_counts", marts.ticket_counts(marts.orders_mart(orders, lines, shows, events, venues)))
    totals = _kept(t, "line_totals", marts.line_totals(lines))
    day = F.col("purchase_date_formatted")
    first, second = (F.lit(d).cast("date") for d in INCREMENT_DAYS)
    parts = [
        orders.where(day < first).withColumn("phone", F.lit(None).cast(orders.schema["phone"].dataType)),
        orders.where((day < second) | day.isNull()),
        orders,
    ]
    root = _scratch(t, "lifetime_states")
    facts = [_kept(t, "order_facts", inc.order_facts(part, shows, events, counts, totals=totals)) for part in parts]
    # A dirty customer without an email is not summed again.
    of = lambda now: lambda keys: now.where(F.col(inc.KEY).isNotNull())
    inc.apply_changes(t.spark, root, None, facts[0], of(facts[0]))
    for i in (1, 2):
        gone, came = inc.changed_orders(parts[i - 1], parts[i], rows=(facts[i - 1], facts[i]))
        inc.apply_changes(t.spark, root, gone, came, of(facts[i]))
    return bk.read_table(t.spark, root)


@query
def incremental_ticket_lead_stats(t: TestTables) -> DataFrame:
    return ft.of_contacts(inc.lifetime_features(_lifetime_states(t))["ticket_lead_stats"], t.contacts())


@query
def incremental_lifetime_stats_paid(t: TestTables) -> DataFrame:
    return ft.of_contacts(inc.lifetime_features(_lifetime_states(t))["lifetime_stats_paid"], t.contacts())


@query
def incremental_lifetime_stats_comp(t: TestTables) -> DataFrame:
    return ft.of_contacts(inc.lifetime_features(_lifetime_states(t))["lifetime_stats_comp"], t.contacts())


@query
def incremental_weekday_attendance(t: TestTables) -> DataFrame:
    return inc.lifetime_features(_lifetime_states(t))["weekday_attendance"]


@query
def incremental_special_event_stats(t: TestTables) -> DataFrame:
    return inc.lifetime_features(_lifetime_states(t))["special_event_stats"]


@query
def incremental_total_spend(t: TestTables) -> DataFrame:
    return inc.lifetime_features(_lifetime_states(t))["total_spend"]


@query
def sms_subscribers(t: TestTables) -> DataFrame:
    return _subscribers(t)


@query
def group_order_lines(t: TestTables) -> DataFrame:
    line = lambda row: F.concat_ws(":", row["unique_id"], row["orderproduct_price"].cast("string"))
    cents = F.aggregate("lines", F.lit(0).cast("bigint"), lambda total, row: total + row["orderproduct_price"])
    ordered = F.array_sort(
        F.transform(
            "lines",
            lambda row: F.struct(
                row["unique_id"], row["orderproduct_name"], row["orderproduct_price"]
            ),
        )
    )
    return _grouped(t).select(
        "venue_id",
        "email",
        "orderNumber",
        "externalid",
        F.size("lines").cast("bigint").alias("n_lines"),
        cents.alias("line_total"),
        F.array_join(F.transform(ordered, line), ",").alias("lines"),
    )


@query
def tag_sets(t: TestTables) -> DataFrame:
    return tags.tag_sets(_daily(t))


@query
def all_tags(t: TestTables) -> DataFrame:
    return tags.all_tags(_daily(t))


@query
def push_report(t: TestTables) -> DataFrame:
    return quality.push_report(_results(t))


@query
def push_report_keys(t: TestTables) -> DataFrame:
    return quality.push_report_keys(_results(t))


# --- windows and sets -----------------------------------------------------------------


@query
def pick_row(t: TestTables) -> DataFrame:
    newest = [F.col("purchase_date").desc(), F.col("id")]
    return skew.pick_row(t.orders(), ["email"], newest, 3).select("email", "id", "purchase_date")


@query
def newest_per_key(t: TestTables) -> DataFrame:
    rows = t.messages().select("mobile_number", "timestamp", "campaign")
    return _stamped(up.newest_per_key(rows, ["mobile_number"], [F.col("timestamp").desc()]))


@query
def with_batch_id(t: TestTables) -> DataFrame:
    orders = _mart(t).select("venue_id", "orderNumber").distinct()
    return batches.with_batch_id(orders, "venue_id", ["orderNumber"], size=50)


@query
def one_link_per_order(t: TestTables) -> DataFrame:
    return lookups.one_link_per_order(t.order_link())


@query
def union_tags(t: TestTables) -> DataFrame:
    return tags.union_tags(_backlog(t), _daily(t))


# --- scalar functions -----------------------------------------------------------------


@query
def clean_name(t: TestTables) -> DataFrame:
    raw = F.expr("""concat(' "Customer" ', c_custkey, " O'Neil, Jr\\t\\n")""")
    return t.raw("customer").select("c_custkey", fn.clean_name(raw).alias("cleaned"))


@query
def clean_email(t: TestTables) -> DataFrame:
    raw = F.expr("concat('\\t C', c_custkey, '@Example\\r.COM \\n')")
    return t.raw("customer").select("c_custkey", fn.clean_email(raw).alias("cleaned"))


@query
def digits_only(t: TestTables) -> DataFrame:
    return t.orders().select("id", fn.digits_only(F.col("phone")).alias("cleaned"))


@query
def ilike_flags(t: TestTables) -> DataFrame:
    return t.raw("part").select(
        "p_partkey",
        F.col("p_type").ilike("%promo%").cast("int").alias("special"),
        F.col("p_name").ilike("SMALL%").cast("int").alias("small"),
    )


@query
def to_second(t: TestTables) -> DataFrame:
    return t.raw("events").select(
        "event_id", fn.to_second(F.col("ts")).alias("moment"), fn.date_part(F.col("ts")).alias("day")
    )


@query
def wall_clock(t: TestTables) -> DataFrame:
    raw = F.expr(
        "CASE WHEN o_orderkey % 5 = 0 THEN '0000-00-00 00:00:00'"
        " ELSE concat(left(cast(o_orderdate AS string), 10), 'T19:30:00.000-05:00') END"
    )
    return t.raw("orders").select("o_orderkey", fn.wall_clock(raw).alias("moment"))


@query
def weekday_numbers(t: TestTables) -> DataFrame:
    day = fn.date_part(F.col("start_date_time"))
    return t.shows().select("id", F.weekday(day).alias("weekday"), F.dayofweek(day).alias("dayofweek"))


@query
def date_arithmetic(t: TestTables) -> DataFrame:
    from ticketlens.semantics import in_last_days

    orders, shows, _, _ = _places(t)
    starts = shows.select(F.col("id").alias("show_id"), "start_date_formatted")
    return orders.join(starts, "show_id").select(
        "id",
        F.datediff("start_date_formatted", "purchase_date_formatted").alias("lead_days"),
        in_last_days(F.col("purchase_date_formatted"), AS_OF, 90).alias("in_90"),
    )


@query
def null_handling(t: TestTables) -> DataFrame:
    fast = F.col("payment_method").isin("1-URGENT", "2-HIGH")
    return t.orders().select(
        "id",
        F.coalesce("show_id", F.lit("none")).alias("show_id"),
        F.col("show_id").isNull().alias("no_show"),
        F.when(fast, "fast").otherwise("slow").alias("speed"),
    )


@query
def whole_units(t: TestTables) -> DataFrame:
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return t.raw("lineitem").groupBy("l_orderkey").agg(fn.whole_units(F.sum(cents)).alias("units"))


@query
def home_venue(t: TestTables) -> DataFrame:
    return _wide(t).select("email_address", payloads.home_venue().alias("home_venue"))


@query
def repair_quotes(t: TestTables) -> DataFrame:
    raw = F.concat("c_name", F.lit("’s 9 o\u0092clock"))
    return t.raw("customer").select("c_custkey", fn.repair_quotes(raw).alias("repaired"))


@query
def capitalise(t: TestTables) -> DataFrame:
    return t.crm_contacts().select("email", fn.capitalise(F.upper("optin_status")).alias("status"))


@query
def parse_form(t: TestTables) -> DataFrame:
    body = F.expr(
        "concat('contact%5Bemail%5D=old%40x.co&contact%5Bemail%5D=a%2B', c_custkey, '%40x.co',"
        " '&contact%5Bfields%5D%5Bmobile_number%5D=', c_custkey,"
        " '&contact[fields][mobile_optin]=Yes%20%26%20more&empty')"
    )
    return t.raw("customer").select("c_custkey", fn.webhook_fields(body).alias("form")).select("c_custkey", "form.*")


@query
def product_name(t: TestTables) -> DataFrame:
    names = [F.col(c) for c in ("orderproduct_category", "event_name", "orderproduct_name")]
    return _mart(t).select("unique_id", fn.product_name(*names).alias("product"))


@query
def array_functions(t: TestTables) -> DataFrame:
    pair = F.array(F.struct(F.col("l_returnflag").alias("name")), F.struct(F.col("l_linestatus").alias("name")))
    names = F.transform(pair, lambda entry: entry["name"])
    return t.raw("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.array_join(names, "\t").alias("joined"),
        F.get(names, F.lit(0)).alias("first"),
        F.get(names, F.lit(9)).alias("tenth"),
    )


@query
def classify_response(t: TestTables) -> DataFrame:
    return _results(t).select("key", "outcome")


@query
def classify_contact_response(t: TestTables) -> DataFrame:
    columns = [F.col(c) for c in ("status", "body", "action", "venue_id")]
    return t.contact_responses().select("key", quality.classify_contact_response(*columns).alias("outcome"))


@query
def order_outcome(t: TestTables) -> DataFrame:
    """Every third duplicate has no CRM id; every other update is accepted."""
    pushed = t.responses().withColumns(
        {
            "first": quality.classify_response(F.col("status"), F.col("body")),
            "crm_id": F.expr("CASE WHEN key % 3 <> 0 THEN concat('x', key) END"),
            "again": quality.classify_response(F.expr("CASE WHEN key % 2 = 0 THEN 201 ELSE 500 END"), F.lit("{}")),
        }
    )
    outcome = quality.order_outcome(F.col("first"), F.col("crm_id"), F.col("again"))
    return pushed.select("key", outcome.alias("outcome"))


@query
def only_numbers(t: TestTables) -> DataFrame:
    register_functions(t.spark)
    return t.orders().selectExpr("id", "only_numbers(phone) AS cleaned")


# --- payloads, opt-in, tags -----------------------------------------------------------


def _customer_fields(rows: DataFrame, keys: list[str]) -> DataFrame:
    doc = F.from_json(
        "payload", "struct<ecomCustomer:struct<connectionid:string,externalid:string,email:string>>"
    )["ecomCustomer"]
    return rows.withColumn("doc", doc).select(
        *keys,
        "doc.email",
        F.col("doc.connectionid").alias("connection"),
        F.col("doc.externalid").alias("external_id"),
    )


@query
def customer_payloads(t: TestTables) -> DataFrame:
    return _customer_fields(
        payloads.customer_payloads(_grouped(t), t.connections()), ["venue_id", "orderNumber"]
    )


@query
def customer_payloads_distinct(t: TestTables) -> DataFrame:
    return _customer_fields(payloads.customer_payloads(_grouped(t), t.connections(), distinct=True), ["venue_id"])


@query
def order_payloads(t: TestTables) -> DataFrame:
    product = "struct<name:string,price:bigint,quantity:int,category:string>"
    doc = F.from_json(
        "payload",
        "struct<ecomOrder:struct<externalid:string,email:string,orderNumber:string,orderDate:string,"
        "shippingMethod:string,totalPrice:string,connectionid:int,customerid:bigint,"
        f"orderProducts:array<{product}>>>",
    )["ecomOrder"]
    fields = lambda row: F.concat_ws("|", row["name"], row["price"], row["quantity"], row["category"])
    return (
        payloads.order_payloads(_pushed(t), numeric=True)
        .select("action", doc.alias("doc"))
        .select(
            "doc.externalid",
            "doc.email",
            "doc.orderNumber",
            F.col("doc.orderDate").alias("order_date"),
            F.col("doc.shippingMethod").alias("shipping_method"),
            F.col("doc.totalPrice").alias("total_price"),
            F.col("doc.connectionid").alias("connection"),
            F.col("doc.customerid").alias("customer_id"),
            "action",
            F.size("doc.orderProducts").alias("products"),
            F.array_join(F.transform("doc.orderProducts", fields), ",").alias("product_list"),
        )
    )


@query
def contact_payloads(t: TestTables) -> DataFrame:
    pushed = payloads.contact_payloads(_selected(t), t.lists(), null_text="None")

    def field(name: str):
        return F.try_element_at("doc", F.lit(f"field[%{name}%,0]"))

    return pushed.withColumn("doc", F.from_json("payload", "map<string,string>")).select(
        "email_address",
        "home_venue",
        F.try_element_at("doc", F.concat(F.lit("p["), "list_id", F.lit("]"))).alias("list_id"),
        F.try_element_at("doc", F.lit("first_name")).alias("first_name"),
        field("TICKETING_NAME").alias("name"),
        field("TICKETING_PHONE").alias("phone"),
        field("TICKETING_TOTAL_ORDERS").alias("total_orders"),
        field("NEXT_SHOW_ATTENDING_DATE").alias("next_date"),
        field("TOTAL_REVENUE_LAST_90_DAYS").alias("revenue_90"),
        F.size("doc").alias("n_fields"),
    )


@query
def contact_push_plan(t: TestTables) -> DataFrame:
    plan = payloads.contact_push_plan(_selected(t), t.lists())
    return plan.select("email_address", "home_venue", "list_id", "plan")


@query
def plan_contact_push(t: TestTables) -> DataFrame:
    return lookups.plan_contact_push(_selected(t), t.crm_lists()).select("email_address", "crm_id", "action")


@query
def contact_payloads_add_or_edit(t: TestTables) -> DataFrame:
    doc = F.from_json("payload", "map<string,string>")
    pushed = payloads.contact_payloads(_selected(t), t.lists(), crm_ids=t.crm_lists()).withColumn("doc", doc)
    return pushed.select("email_address", F.col("doc")["api_action"].alias("action"), F.col("doc")["id"].alias("crm_id"))


@query
def mobile_push_plan(t: TestTables) -> DataFrame:
    plan = payloads.mobile_push_plan(optin.resolve_optin(_conflicts(t)), t.crm_lists())
    return plan.select("email_address", "mobile_number", "mobile_optin", "crm_id", "list_id", "plan")


@query
def mobile_payloads_with_list(t: TestTables) -> DataFrame:
    pushed = payloads.mobile_payloads(optin.resolve_optin(_conflicts(t)), t.crm_lists())
    return pushed.select(
        "mobile_number",
        F.get_json_object("payload", "$.id").alias("crm_id"),
        F.regexp_extract("payload", r'"p\[(\d+)\]":"\1"', 1).alias("list_id"),
    )


@query
def resolve_optin(t: TestTables) -> DataFrame:
    return optin.resolve_optin(_conflicts(t)).select("email_address", "mobile_number", "mobile_optin")


@query
def mobile_payloads(t: TestTables) -> DataFrame:
    doc = F.from_json("payload", "map<string,string>")
    pushed = payloads.mobile_payloads(optin.resolve_optin(_conflicts(t))).withColumn("doc", doc)
    return pushed.select(
        F.col("doc")["email"].alias("email"),
        F.col("doc")["field[%MOBILE_NUMBER%,0]"].alias("mobile_number"),
        F.col("doc")["field[%MOBILE_OPTIN%,0]"].alias("mobile_optin"),
    )


@query
def backlog_tags(t: TestTables) -> DataFrame:
    return _backlog(t)


@query
def daily_tags(t: TestTables) -> DataFrame:
    return _daily(t)


@query
def tag_assignments(t: TestTables) -> DataFrame:
    return tags.tag_assignments(_daily(t), t.tag_dim())


# --- streaming, final state -----------------------------------------------------------


@query
def stream_messages(t: TestTables) -> DataFrame:
    root = _scratch(t, "message-stream")
    requests = t.messages().selectExpr(
        "mobile_number AS m", "keyword AS k", "security_code AS s", "campaign AS c", "body AS b",
        "email AS e", "cast(timestamp AS string) AS t",
    )
    requests.write.json(f"{root}/landing")
    incoming = sm.read_message_requests(t.spark, f"{root}/landing")
    sm.stream_messages(incoming, f"{root}/log", f"{root}/checkpoint").awaitTermination()
    return _stamped(store.load_table(t.spark, f"{root}/log"))


@query
def stream_sms_subscribers(t: TestTables) -> DataFrame:
    root = _scratch(t, "subscriber-stream")
    log = f"{root}/log"
    for half in ("security_code < '5'", "security_code >= '5'"):
        store.append_rows(t.messages().where(half), log)
        query_ = sm.stream_sms_subscribers(sm.message_log(t.spark, log), f"{root}/table", f"{root}/checkpoint")
        query_.awaitTermination()
    return store.read_version(t.spark, f"{root}/table")


@query
def stream_optin_webhooks(t: TestTables) -> DataFrame:
    """Even customers sign up, every fourth then opts out; changes of the others hit nobody."""
    root = _scratch(t, "webhook-stream")
    requests = t.raw("customer").selectExpr(
        "c_custkey",
        "concat('contact%5Bemail%5D=c', c_custkey, '%40example.com&contact%5Bfields%5D%5Bmobile_number%5D=%2B',"
        " lpad(cast(c_custkey AS string), 9, '0'), '&contact[fields][mobile_optin]=') AS start",
    )
    signups = requests.where("c_custkey % 2 = 0").selectExpr(
        "'/webhooks/new-contact' AS path", "'POST' AS httpMethod", "concat(start, 'Yes') AS body",
        "'2024-02-01T00:00:00' AS received_at",
    )
    changes = requests.where("c_custkey % 4 IN (0, 1)").selectExpr(
        "'/webhooks/mobile-chng' AS path", "'POST' AS httpMethod", "concat(start, 'No') AS body",
        "'2024-02-02T00:00:00' AS received_at",
    )
    for batch in (signups, changes):
        batch.write.mode("append").json(f"{root}/landing")
        incoming = wh.read_webhooks(t.spark, f"{root}/landing")
        wh.stream_optin_webhooks(incoming, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return store.read_version(t.spark, f"{root}/table", CRM_CONTACTS)


@query
def rebuild_all(t: TestTables) -> DataFrame:
    """Every table written in order; the last one depends on all others."""
    tables = rebuild.rebuild_all(t.spark, t.base(), _scratch(t, "rebuild"), AS_OF, OPTIONS)
    return tables["contacts_mobile_mv"]
