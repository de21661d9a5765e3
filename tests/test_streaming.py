import json
import os
from datetime import datetime

import pytest

from ticketlens.operators.sms import sms_subscribers
from ticketlens.schemas import CRM_CONTACTS, MESSAGES, SUBSCRIBERS
from ticketlens.sources.tables import read_version, write_version
from ticketlens.streaming import messages as sm
from ticketlens.streaming import webhooks as wh


def land(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as out:
        out.writelines(json.dumps(row) + "\n" for row in rows)


def request(number, body, stamp, email=""):
    return {"m": number, "k": "JOIN", "s": "1", "c": "c1", "b": body, "e": email, "t": stamp}


def test_messages_and_subscribers_in_three_runs(spark, tmp_path, scratch):
    landing, log, root = f"{tmp_path}/in", f"{tmp_path}/log", scratch("subs")

    def run():
        incoming = sm.read_message_requests(spark, landing)
        sm.stream_messages(incoming, log, f"{tmp_path}/c1").awaitTermination()
        stream = sm.message_log(spark, log)
        sm.stream_sms_subscribers(stream, root, f"{tmp_path}/c2").awaitTermination()

    land(landing, "1.json", [request("1", "hi", "2018-01-01 10:00:00", "a@x"), request("2", "STOP", "2018-01-01")])
    run()
    land(landing, "2.json", [request("1", "stop", "2018-01-03 00:00:00"), request("2", "x", "2017-12-01 00:00:00")])
    run()
    run()  # nothing new
    log_rows = spark.read.schema(MESSAGES).parquet(log)
    assert log_rows.count() == 4
    final = read_version(spark, root, SUBSCRIBERS)
    batch = sms_subscribers(log_rows)
    assert sorted(map(tuple, final.collect())) == sorted(map(tuple, batch.collect()))
    status = {r["mobile_number"]: (r["mobile_status"], r["email_address"]) for r in final.collect()}
    assert status["1"] == ("Unsubscribed", "a@x")


def test_messy_numbers_are_one_subscriber_in_stream_and_batch(spark, tmp_path, scratch):
    landing, log, root = f"{tmp_path}/in", f"{tmp_path}/log", scratch("messy")
    land(landing, "1.json", [
        request("+1 (555) 1", "hi", "2018-01-01", " B@X.co"), request("15551", "stop", "2018-01-02", "None"),
        request("", "hi", "2018-01-01", "c@x"), request(None, "hi", "2018-01-01", "d@x"),
    ])
    sm.stream_messages(sm.read_message_requests(spark, landing), log, f"{tmp_path}/c1").awaitTermination()
    sm.stream_sms_subscribers(sm.message_log(spark, log), root, f"{tmp_path}/c2").awaitTermination()
    final = read_version(spark, root, SUBSCRIBERS).collect()
    assert [(r["mobile_number"], r["mobile_status"], r["email_address"]) for r in final] == [
        ("15551", "Unsubscribed", "b@x.co")
    ]
    assert final == sms_subscribers(spark.read.schema(MESSAGES).parquet(log)).collect()


def hook(kind, email, optin, stamp, method="POST"):
    body = f"contact%5Bemail%5D={email}&contact%5Bfields%5D%5Bmobile_number%5D=%2B1555&contact[fields][mobile_optin]={optin}"
    return {"path": f"/webhooks/{kind}", "httpMethod": method, "body": body, "received_at": stamp}


def test_webhooks(spark, tmp_path, scratch):
    landing, root = f"{tmp_path}/in", scratch("crm")
    old = [("old@x", "1", "No", datetime(2018, 1, 1)), ("kept@x", "2", "No", datetime(2018, 1, 1))]
    write_version(spark.createDataFrame(old, CRM_CONTACTS), root)
    land(landing, "1.json", [
        hook("new-contact", "New%40x", "Yes", "2018-02-01T00:00:00"),
        hook("mobile-chng", "old%40x", "Yes", "2018-02-01T00:00:00"),
        hook("mobile-chng", "stranger%40x", "Yes", "2018-02-01T00:00:00"),
        hook("mobile-chng", "kept%40x", "Yes", "2017-02-01T00:00:00"),
        hook("new-contact", "get%40x", "Yes", "2018-02-01T00:00:00", method="GET"),
        hook("other", "other%40x", "Yes", "2018-02-01T00:00:00"),
        {"path": "/", "httpMethod": "POST", "body": "x", "received_at": None},
    ])
    requests = wh.read_webhooks(spark, landing)
    wh.stream_optin_webhooks(requests, root, f"{tmp_path}/c").awaitTermination()
    expected = {"old@x": ("1555", "Yes"), "kept@x": ("2", "No"), "new@x": ("1555", "Yes")}

    def state():
        rows = read_version(spark, root, CRM_CONTACTS).collect()
        return {r["email"]: (r["mobile_number"], r["optin_status"]) for r in rows}

    assert state() == expected
    # A replay from the start, as after a lost checkpoint, changes nothing.
    wh.stream_optin_webhooks(requests, root, f"{tmp_path}/c-again").awaitTermination()
    assert state() == expected
    # Requests without a route do not rewrite the table.
    versions = sorted(os.listdir(root))
    land(landing, "2.json", [hook("other", "x%40x", "Yes", "2018-02-01T00:00:00")])
    wh.stream_optin_webhooks(requests, root, f"{tmp_path}/c").awaitTermination()
    assert sorted(os.listdir(root)) == versions


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    from ticketlens.sources import scratch

    class Conf:
        def get(self, name, default=None):
            return None

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        scratch.shared_root(Session())
    Context.master = "local[2]"
    assert scratch.shared_root(Session())
    if spark.conf.get("spark.checkpoint.dir", None):
        assert scratch.scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
