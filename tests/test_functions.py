from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ticketlens import functions as fn
from ticketlens import semantics as sem
from ticketlens.functions.forms import parse_form
from ticketlens.functions.sqlfuncs import register_functions
from ticketlens.operators.quality import classify_contact_response, classify_response, order_outcome


def apply(spark, function, *values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["out"] for r in rows.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]


def test_names(spark):
    assert apply(spark, fn.clean_name, 'O\'Neil, "Bo"', " Ann\t\r\n", None) == ["O`Neil  Bo", "Ann", None]
    assert apply(spark, fn.clean_ticket_name, ' GA, "front" ') == ['GA  "front"']


def test_emails(spark):
    assert apply(spark, fn.clean_email, " Bo@X.Co\r\n", "A\rb@x.co", None) == ["bo@x.co", "ab@x.co", None]
    assert apply(spark, fn.is_valid_email, "a@x", "", "None", "none", "NONE", None) == [
        True, False, False, False, False, False,
    ]


def test_digits(spark):
    values = ["(555) 123-4567", None, "1" * 25, "no digits", "٣4"]
    assert apply(spark, fn.digits_only, *values) == ["5551234567", "", "1" * 20, "", "4"]
    register_functions(spark)
    assert spark.sql("SELECT only_numbers('(555) 1'), only_numbers(NULL)").first()[:] == ("5551", "")


def test_wall_clock_keeps_local_time_in_any_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            parsed = apply(
                spark,
                lambda c: fn.wall_clock(c).cast("string"),
                "2018-05-10T19:30:00.000-05:00",
                "2018-03-11 02:30:00",
                "0000-00-00 00:00:00",
                "soon",
                None,
            )
            assert parsed == ["2018-05-10 19:30:00", "2018-03-11 02:30:00", None, None, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_to_second(spark):
    out = apply(spark, lambda c: fn.to_second(c.cast("timestamp_ntz")), "2024-01-01 00:00:07.179575")
    assert out == [datetime(2024, 1, 1, 0, 0, 7)]


def test_money(spark):
    whole = apply(spark, lambda c: fn.whole_units(c.cast("bigint")), "250", "249", "-250", None, "9" * 18)
    assert [None if v is None else int(v) for v in whole] == [3, 2, -3, None, 10**16]
    assert apply(spark, fn.parse_cents, "500", "5.9", "n/a", "", None) == [500, 5, None, None, None]


def test_forms(spark):
    body = "contact%5Bemail%5D=old%40x.co&contact%5Bemail%5D=a%2Bb%40x.co&contact%5Bfields%5D%5Bmobile_number%5D=555"
    fields = apply(spark, fn.webhook_fields, body)[0]
    assert (fields["email"], fields["mobile_number"], fields["optin_status"]) == ("a+b@x.co", "555", None)
    assert apply(spark, parse_form, "a=1+2&b=x%26y&c&a=%zz&d=1=2") == [{"b": "x&y", "c": "", "a": None, "d": "1=2"}]


def test_small_text_functions(spark):
    assert apply(spark, fn.repair_quotes, "Bo’s \u0092til") == ["Bo's 'til"]
    assert apply(spark, fn.capitalise, "yES", "", None) == ["Yes", "", None]
    assert apply(spark, fn.flag_text, "true", "false", None) == ["True", "False", None]


def test_response_classes(spark, table):
    rows = table(
        "i int, status int, body string",
        (0, 201, ""),
        (1, 422, '{"errors":[{"code":"duplicate"}]}'),
        (2, 422, '{"errors":[{"code":"invalid"},{"code":"duplicate"}]}'),
        (3, 422, "not json"),
        (4, 500, '{"errors":[{"code":"duplicate"}]}'),
        (5, 422, None),
    )
    out = rows.select("i", classify_response(F.col("status"), F.col("body")).alias("c")).orderBy("i")
    assert [r["c"] for r in out.collect()] == ["success", "duplicate", "other", "other", "other", "other"]


def test_contact_and_order_outcomes(table):
    rows = table(
        "i int, status int, body string, action string, venue string",
        (0, 200, '{"result_code":1}', "contact_edit", "5"),
        (1, 200, '{"result_code":0}', "contact_edit", "5"),
        (2, 200, '{"result_code":0}', "contact_add", "5"),
        (3, 200, "not json", "contact_add", "5"),
        (4, 500, None, "contact_add", "5"),
        (5, 200, '{"result_code":1}', "contact_add", None),
        (6, None, None, None, "5"),
    )
    found = classify_contact_response(*[F.col(c) for c in ("status", "body", "action", "venue")])
    out = [r["c"] for r in rows.select("i", found.alias("c")).orderBy("i").collect()]
    assert out == ["success", "err_update", "err_add", "err_other", "err_add", "err_list", "err_add"]
    orders = table(
        "i int, first string, crm_id string, again string",
        (0, "success", None, None), (1, "other", "x", "success"), (2, "duplicate", None, None),
        (3, "duplicate", "x", "success"), (4, "duplicate", "x", "other"), (5, "duplicate", "x", None),
    )
    outcome = order_outcome(F.col("first"), F.col("crm_id"), F.col("again"))
    out = [r["c"] for r in orders.select("i", outcome.alias("c")).orderBy("i").collect()]
    assert out == ["success", "err-other", "success", "success", "err-update", "err-update"]


@pytest.mark.parametrize(
    ("as_of", "days", "first", "last"),
    [
        ("1998-06-30", 90, date(1998, 4, 1), date(1998, 6, 30)),
        ("1998-06-30T12:00:00", 90, date(1998, 4, 2), date(1998, 6, 30)),
        ("1999-12-31T23:59:59", 1, date(1999, 12, 31), date(1999, 12, 31)),
    ],
)
def test_window_bounds_carry_the_time_of_day(as_of, days, first, last):
    assert sem.first_day_from(sem.days_before(as_of, days)) == first
    assert sem.last_day_until(as_of) == last
