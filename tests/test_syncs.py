import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ticketlens.operators import optin, payloads, selection, sms, tags
from ticketlens.operators import quality
from ticketlens.operators.lookups import plan_order_push
from ticketlens.plans import syncs
from ticketlens.schemas import CRM_CONTACTS, MESSAGES, ORDER_LINK, TAG_MAP

WIDE = "email_address string, phone string, last_ordered_date date, sys_entry_date timestamp_ntz"
MART = """unique_id string, externalid string, email string, orderNumber string, orderDate date, totalPrice bigint,
    customerid string, shippingMethod string, orderproduct_name string, orderproduct_price bigint,
    orderproduct_category string, venue_id string, event_name string, sys_entry_date timestamp_ntz"""


def at(text):
    return datetime.fromisoformat(text)


def mart_line(uid, email, number, venue="5", day="2018-04-01", show="s1", entered="2018-04-02", price=500, name="GA"):
    stamp = at(entered) if entered else None
    return (uid, f"x{number}", email, number, date.fromisoformat(day), 1500, "7", "card", name, price, show, venue,
            "Night", stamp)


@pytest.fixture
def mart(table):
    return table(
        MART,
        mart_line("1-1", "a1@x", "23", day="2017-05-05"),
        mart_line("2-1", "a1@x2", "3", day="2018-01-30", venue="6", show="s2"),
        mart_line("3-1", "mid@x", "4", day="2017-10-12", entered="2018-04-20"),
        mart_line("4-1", "zero@x", "5", entered=None),
        mart_line("5-1", "none", "6", entered="2018-04-20"),
    )


@pytest.fixture
def wide(table):
    rows = [(e, None, None, at("2017-01-01")) for e in ("a1@x", "a1@x2", "mid@x", "zero@x", "none")]
    return table(WIDE, *rows, ("fresh@x", None, None, at("2018-04-20")))


def emails(df, column="email_address"):
    return sorted(r[column] for r in df.select(column).collect())


def test_contact_selections(table, mart, wide):
    shows = table("id string, start_date_formatted date", ("s1", date(2018, 4, 10)), ("s2", date(2018, 5, 1)))
    as_of = "2018-04-30T12:00:00"
    assert emails(selection.changed_contacts(wide, mart, shows, "2018-04-09", as_of)) == [
        "a1@x", "fresh@x", "mid@x", "zero@x",
    ]
    assert emails(selection.changed_contacts(wide, mart, shows, "2018-04-11", as_of)) == ["fresh@x"]
    assert emails(selection.extra_push_contacts(wide, mart, shows, "2018-04-11", as_of)) == [
        "a1@x", "fresh@x", "mid@x", "zero@x",
    ]
    assert emails(selection.boundary_contacts(wide, mart, as_of)) == ["a1@x", "a1@x2"]
    assert emails(selection.contacts_at_venues(wide, mart, ["6"])) == ["a1@x2"]
    assert emails(selection.contacts_with_entry_date(wide, "2018-04-20")) == ["fresh@x"]
    for mode in syncs.CONTACT_MODES:
        syncs.contact_selection(mode, wide, mart, shows, "2018-04-09", as_of, ["5"])
    with pytest.raises(ValueError):
        syncs.contact_selection("weekly", wide, mart, shows, "2018-04-09", as_of)


def test_order_selections(mart):
    assert emails(selection.changed_orders(mart, "2018-04-02", "2018-04-20"), "email") == ["mid@x"]
    assert emails(selection.changed_orders(mart, "2018-04-01", "2018-04-02", ["6"]), "email") == ["a1@x2"]
    assert emails(selection.historical_orders(mart, "2018-04-10"), "email") == ["a1@x", "a1@x2", "zero@x"]


def test_shows_to_repull(table):
    shows = table("id string, event_id string, start_date_time timestamp_ntz",
                  ("1", "e", at("2018-04-27")), ("2", "e", at("2018-04-28")), ("3", "other", at("2018-05-01")))
    events = table("id string, venue_id string", ("e", "5"), ("other", "6"))
    strict = selection.shows_to_repull(shows, events, ["5"], "2018-04-30")
    assert emails(strict, "id") == ["2"]
    assert emails(selection.shows_to_repull(shows, events, ["5"], "2018-04-30", strict=False), "id") == ["1", "2"]


def message(number, body, stamp, email=None, campaign="c1"):
    return (number, "k", "s", campaign, body, email, at(stamp))


def test_email_enrichment(table):
    messages = table(MESSAGES, message("555", "hi", "2018-01-01"), message("", "hi", "2018-01-01"),
                     message("(7)77", "hi", "2018-01-01"), message("888", "hi", "2018-01-01", "own@x"))
    crm = table(CRM_CONTACTS, ("old@x", "5-55", None, at("2017-01-01")), ("new@x", "555", None, at("2018-01-01")),
                ("blank@x", "", None, None), ("other@x", "888", None, None))
    wide = table(WIDE, ("wide@x", "7 77", date(2018, 1, 1), None), ("none@x", None, None, None),
                 ("late@x", "555", date(2019, 1, 1), None))
    out = {r["mobile_number"]: r["email"] for r in sms.enrich_message_email(messages, crm, wide).collect()}
    # A missing number stays missing, so that it becomes nobody's.
    assert out == {"555": "new@x", None: None, "777": "wide@x", "888": "own@x"}


def test_subscriber_status(table):
    messages = table(
        MESSAGES,
        message("1", "hi", "2018-01-01 00:00:00.5", "a@x"), message("1", "please stop", "2018-01-02", None),
        message("2", "STOP", "2018-01-01"), message("2", "hi", "2018-01-02", "b@x"),
        message("3", "STOP", "2018-01-01"), message("3", "hi", "2018-01-01", "c@x"),
        message("4", None, "2018-01-01"),
    )
    rows = {r["mobile_number"]: r for r in sms.sms_subscribers(messages).collect()}
    assert {k: r["mobile_status"] for k, r in rows.items()} == {
        "1": "Unsubscribed", "2": "Subscribed", "3": "Unsubscribed", "4": "Subscribed",
    }
    assert (rows["1"]["email_address"], rows["1"]["join_date"]) == ("a@x", at("2018-01-01"))


def test_optin_resolution(table):
    subs = "email_address string, mobile_number string, mobile_status string, last_message_date timestamp_ntz"
    day = at("2018-04-10")
    subscribers = table(
        subs,
        ("null@x", "1", "Subscribed", day), ("newer@x", "2", "Unsubscribed", day),
        ("older@x", "3", "Unsubscribed", day), ("same@x", "4", "Unsubscribed", day),
        ("undated@x", "5", "Unsubscribed", day), ("agree@x", "6", "Subscribed", day),
        ("back@x", "7", "Subscribed", day), (None, "8", "Subscribed", day),
    )
    crm = table(
        CRM_CONTACTS,
        ("null@x", None, None, None), ("newer@x", None, "YES", at("2018-05-01")),
        ("older@x", None, "Yes", at("2018-04-01")), ("same@x", None, "Yes", day), ("undated@x", None, "Yes", None),
        ("agree@x", None, "yes", day), ("back@x", None, "No", at("2018-04-01")),
    )
    conflicts = optin.optin_conflicts(subscribers, crm)
    assert emails(conflicts) == ["back@x", "newer@x", "null@x", "older@x", "same@x", "undated@x"]
    resolved = {r["email_address"]: r["mobile_optin"] for r in optin.resolve_optin(conflicts).collect()}
    assert resolved == {"null@x": "Yes", "newer@x": "Yes", "older@x": "No", "back@x": "Yes"}
    assert optin.optin_conflicts(subscribers, crm, "2018-04-10", "2018-05-01").count() == 0
    assert syncs.mobile_sync(subscribers, crm, "2018-04-09", "2018-05-01").count() == 4
    with pytest.raises(ValueError):
        optin.optin_conflicts(subscribers, crm, "2018-04-09")


def test_tags(table):
    subs = table(
        "mobile_number string, email_address string, last_message_date timestamp_ntz",
        ("1", "a@x", at("2018-04-10")), ("2", "b@x", at("2018-01-01")), ("3", None, at("2018-04-10")),
    )
    messages = table(MESSAGES, *[message("1", "hi", "2018-04-10", campaign=c) for c in ("c1", "c2", "c9", "c5")],
                     message("1", "again", "2018-04-10"), message("2", "hi", "2018-01-01"),
                     message("3", "hi", "2018-04-10"))
    tag_map = table(TAG_MAP, ("c1", "T1"), ("c2", "IGNORE-x"), ("c5", "None"))
    pair = lambda df: sorted((r["email"], r["tag"]) for r in df.collect())
    backlog, missing = syncs.tag_sync(subs, messages, tag_map, table("tag string", ("T1",)))
    assert pair(backlog) == [("a@x", "None"), ("a@x", "T1"), ("b@x", "T1")]
    daily, missing = syncs.tag_sync(
        subs, messages, tag_map, table("tag string", ("T1",)), "2018-04-01", "2018-05-01"
    )
    assert pair(daily) == [("a@x", "IGNORE-x"), ("a@x", "T1"), ("a@x", "c5"), ("a@x", "c9")]
    assert sorted(r["tag"] for r in missing.collect()) == ["IGNORE-x", "c5", "c9"]
    assert sorted(r["tag"] for r in tags.tag_sets(daily).collect()) == ["IGNORE-x", "T1", "c5", "c9"]
    dim = table("tag string, tag_id string", ("T1", "1"), ("c9", "2"))
    assigned = tags.tag_assignments(daily, dim)
    assert sorted((r["tag"], r["tag_id"]) for r in assigned.collect()) == [("T1", "1"), ("c9", "2")]
    pushed = payloads.tag_payloads(assigned, table("email string, crm_id string", ("a@x", "77"))).collect()
    assert json.loads(pushed[0]["payload"])["contactTag"]["contact"] == "77"
    assert pair(tags.union_tags(backlog, daily))[0] == ("a@x", "IGNORE-x")


def test_order_payloads(table, spark):
    lines = table(MART, mart_line("9-2", " a@x ", "9", name="Bo’s", price=700), mart_line("9-1", "a@x", "9"),
                  mart_line("8-1", "a@x", "8", venue="99"), mart_line("7-1", "b@x", "7", venue="6"))
    connections = table("venue_id string, connection string", ("5", "4"), ("6", "5"))
    customers = table("connection string, email string, crm_customer_id string", ("4", "a@x", "77"))
    link = spark.createDataFrame([("9", "4", "crm9"), ("9", "4", "crm8"), ("9", "5", "other")], ORDER_LINK)
    rows = syncs.order_push(lines, link, connections, customers).collect()
    assert [(r["orderNumber"], r["action"], r["crm_id"]) for r in rows] == [("9", "update", "crm8")]
    assert json.loads(rows[0]["payload"]) == {"ecomOrder": {
        "externalid": "x9", "source": 0, "email": "a@x", "orderNumber": "9",
        "orderProducts": [
            {"name": "s1 - Night - GA", "price": "500", "quantity": "1", "category": "GA"},
            {"name": "s1 - Night - Bo’s", "price": "700", "quantity": "1", "category": "Bo's"},
        ],
        "orderDate": "2018-04-01", "shippingMethod": "card", "totalPrice": "1500", "currency": "USD",
        "connectionid": 4, "customerid": 77,
    }}
    numeric = json.loads(syncs.order_push(lines, link, connections, customers, numeric=True).first()["payload"])
    assert numeric["ecomOrder"]["orderProducts"][0]["price"] == 500
    customer = payloads.customer_payloads(payloads.group_order_lines(lines), connections).orderBy("orderNumber")
    assert [json.loads(r["payload"])["ecomCustomer"] for r in customer.collect()] == [
        {"connectionid": "5", "externalid": "7", "email": "b@x"},
        {"connectionid": "4", "externalid": "7", "email": "a@x"},
    ]
    unlinked = plan_order_push(table("orderNumber string, connection string", ("1", "4")), link)
    assert unlinked.first()["action"] == "add"
    batched = syncs.order_resync(lines, link, connections, customers, "2018-05-01").collect()
    assert [r["batch_id"] for r in batched] == [0]


def test_groups_keep_email_and_number_apart(mart):
    grouped = payloads.group_order_lines(mart.where("email LIKE 'a1%'")).collect()
    assert sorted((r["email"], r["orderNumber"]) for r in grouped) == [("a1@x", "23"), ("a1@x2", "3")]


def test_contact_payloads(spark, table):
    from ticketlens.operators.payloads import contact_fields

    columns = ["email_address", "cust_name_first", "cust_name_last", "next_event_venue", "last_event_venue"]
    columns += [c for c in contact_fields().values() if c not in columns]
    wide = table("email_address string, cust_name_first string, next_event_venue string, last_event_venue string",
                 ("last@x\r", "Ann", None, "7"), ("next@x", "Bo", "8", "7"), ("nowhere@x", "Cy", None, None),
                 ("unmapped@x", "Di", "9", None))
    wide = wide.withColumns({c: F.lit(None).cast("string") for c in columns if c not in wide.columns})
    wide = wide.withColumn("last_ordered_date", F.lit(date(2018, 4, 1)))
    lists = table("venue_id string, list_id string", ("7", "107"), ("8", "108"), ("9", None))
    plan = {r["email_address"].strip(): r["plan"] for r in payloads.contact_push_plan(wide, lists).collect()}
    assert plan == {"last@x": "ready", "next@x": "ready", "nowhere@x": "err_list", "unmapped@x": "err_other"}
    rows = {r["email_address"].strip(): json.loads(r["payload"])
            for r in payloads.contact_payloads(wide, lists, null_text="None").collect()}
    last = rows["last@x"]
    assert (last["email"], last["first_name"], last["last_name"], last["p[107]"]) == ("last@x", "Ann", "None", "107")
    assert last["field[%LAST_ORDER_DATE%,0]"] == "2018-04-01"
    assert last["field[%FIRST_SHOW_ATTENDED_DATE%,0]"] == ""
    assert last["field[%TICKETING_PHONE%,0]"] == "None"
    assert len([k for k in last if k.startswith("field[")]) == 35
    assert "p[108]" in rows["next@x"]
    boundary = payloads.contact_payloads(wide, lists, with_list=False)
    assert emails(boundary) == sorted(["last@x\r", "next@x", "unmapped@x"])
    assert not any("p[" in r["payload"] for r in boundary.collect())


def test_push_report(table):
    results = table("venue_id string, entity string, key string, outcome string",
                    ("5", "order", "1", "success"), ("5", "order", "2", "err-other"), ("5", "order", "3", "err-other"))
    report = {r["outcome"]: r["n"] for r in quality.push_report(results).collect()}
    assert report == {"success": 1, "err-other": 2}
    assert sorted(r["key"] for r in quality.push_report_keys(results).collect()) == ["2", "3"]
