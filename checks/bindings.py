"""The given test tables shaped as ticketing tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ticketlens.plans.rebuild import BaseTables, Options, processed_tables
from ticketlens.schemas import LANDED_ORDER_JSON
from ticketlens.sources.tables import load_table

AS_OF = "1998-06-30"
MARK = "1998-06-01"
CUTOFF = "1996-06-01"
MESSAGES_AS_OF = "2024-01-30 20:00:00"
MESSAGES_MARK = "2024-01-30 00:00:00"

OPTIONS = Options(comp_pattern="%low%", special_pattern="%promo%", presents_pattern="%large%")

TAG_MAP = [("click", "Clicker"), ("purchase", "Buyer"), ("error", "IGNORE-errors"), ("view", "None")]
TAG_DIM = [("Clicker", "11"), ("signup", "12"), ("Buyer", "13")]


# Schemas found so far by path: finding one takes a job, so each file is asked once.
_SCHEMAS: dict[str, StructType] = {}


def parsed(json_text: DataFrame, schema: StructType) -> DataFrame:
    """Documents as columns. ``inline`` parses each once; a struct would be parsed per field read."""
    return json_text.select(F.inline(F.array(F.from_json("value", schema))))


def once(build: Callable[..., Any]) -> Callable[..., Any]:
    """Build each lazy table once per TestTables; opening a file costs a small job."""

    @wraps(build)
    def cached(self, *args):
        key = (build.__name__, *args)
        if key not in self._built:
            self._built[key] = build(self, *args)
        return self._built[key]

    return cached


class TestTables:
    """Lazy tables over one scale-factor folder."""

    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._built: dict[tuple, Any] = {}

    @once
    def raw(self, name: str) -> DataFrame:
        path = f"{self.sf_dir}/{name}.parquet"
        df = load_table(self.spark, path, _SCHEMAS.get(path))
        _SCHEMAS[path] = df.schema
        return df

    @once
    def contacts(self) -> DataFrame:
        return self.raw("customer").selectExpr(
            "concat('c', c_custkey, '@example.com') AS email_address",
            "c_name AS name",
            "split_part(c_name, '#', 1) AS name_first",
            "split_part(c_name, '#', 2) AS name_last",
            "timestamp_ntz'1998-01-01 00:00:00' + make_dt_interval(cast(c_custkey % 365 AS int))"
            " AS sys_entry_date",
        )

    @once
    def venues(self) -> DataFrame:
        return self.raw("nation").selectExpr(
            "cast(n_nationkey AS string) AS id",
            "n_name AS name",
            "cast(null AS string) AS city",
            "cast(null AS string) AS state",
            "CASE WHEN n_nationkey % 7 <> 0 THEN cast(100 + n_nationkey AS string) END AS insider_crm_id",
        )

    @once
    def events(self) -> DataFrame:
        return self.raw("part").selectExpr(
            "cast(p_partkey AS string) AS id",
            "cast(p_partkey % 25 AS string) AS venue_id",
            "concat(p_name, ' ', p_type) AS name",
            "p_brand AS logo_url",
        )

    @once
    def shows(self) -> DataFrame:
        return self.raw("part").selectExpr(
            "cast(p_partkey AS string) AS id",
            # Four shows an event; the events of some shows are unknown.
            "cast(CASE WHEN p_partkey % 40 = 3 THEN -p_partkey ELSE p_partkey - p_partkey % 4 + 1 END AS string)"
            " AS event_id",
            "timestamp_ntz'1995-01-01 19:30:00' + make_dt_interval(cast((p_partkey * 37) % 2500 AS int))"
            " AS start_date_time",
            "CASE WHEN p_size % 2 = 0 THEN 'True' ELSE 'False' END AS sold_out",
            "cast(null AS timestamp_ntz) AS cancelled_at",
        )

    @once
    def orders(self) -> DataFrame:
        show = self.raw("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
            F.min("l_partkey").alias("show_key")
        )
        return self.raw("orders").join(show, "o_orderkey", "left").selectExpr(
            "cast(o_orderkey AS string) AS id",
            "cast(show_key AS string) AS show_id",
            "cast(o_orderkey AS string) AS order_number",
            "cast(o_custkey AS string) AS cust_id",
            "concat('c', o_custkey, '@example.com') AS email",
            "concat('(', substr(lpad(cast(o_custkey AS string), 9, '0'), 1, 3), ') ',"
            " substr(lpad(cast(o_custkey AS string), 9, '0'), 4, 3), '-',"
            " substr(lpad(cast(o_custkey AS string), 9, '0'), 7, 3)) AS phone",
            "o_orderdate AS purchase_date",
            "o_orderpriority AS payment_method",
            "o_orderstatus AS booking_type",
            "cast(round(o_totalprice * 100) AS bigint) AS order_total",
            "CASE WHEN o_orderkey % 10 = 0 THEN 'True' ELSE 'False' END AS new_customer",
            "CASE WHEN o_orderkey % 97 <> 0 THEN o_orderdate + make_dt_interval(1) END AS sys_entry_date",
            "'' AS addons",
        )

    @once
    def orderlines(self) -> DataFrame:
        return self.raw("lineitem").selectExpr(
            "concat(l_orderkey, '-', l_linenumber) AS id",
            "cast(l_orderkey AS string) AS order_number",
            "concat('Tier ', l_returnflag) AS ticket_name",
            "cast(round(l_extendedprice * 100) AS bigint) AS ticket_price",
            "l_linestatus AS printed",
            "cast(null AS string) AS promo_code_id",
            "l_returnflag AS checked_in",
        )

    @once
    def messages(self) -> DataFrame:
        """Numbers as people write them, some missing; emails and campaigns in mixed case."""
        number = "lpad(cast(user_id AS string), 9, '0')"
        return self.raw("events").selectExpr(
            f"CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 'unknown' WHEN event_id % 7 = 0"
            f" THEN concat('+(', substr({number}, 1, 3), ') ', substr({number}, 4)) ELSE {number} END AS mobile_number",
            "'JOIN' AS keyword",
            "cast(event_id % 1000 AS string) AS security_code",
            "CASE WHEN event_id % 4 = 0 THEN upper(event_type) ELSE event_type END AS campaign",
            "CASE WHEN event_type = 'error' THEN 'please Stop' ELSE event_type END AS body",
            "CASE WHEN event_id % 50 = 0 AND user_id % 3 = 0 THEN concat(CASE WHEN event_id % 100 = 0 THEN ' U'"
            " ELSE 'u' END, user_id, '@Sms.example') WHEN event_id % 50 = 1 THEN 'None' END AS email",
            "ts AS timestamp",
        )

    @once
    def crm_contacts(self) -> DataFrame:
        return self.raw("customer").selectExpr(
            "concat('c', c_custkey, '@example.com') AS email",
            "CASE WHEN c_custkey % 2 = 0 THEN concat('+', lpad(cast(c_custkey AS string), 9, '0')) END"
            " AS mobile_number",
            "CASE c_custkey % 3 WHEN 0 THEN 'yes' WHEN 1 THEN 'No' END AS optin_status",
            "CASE WHEN c_custkey % 11 = 10 THEN NULL WHEN c_custkey % 4 < 2 THEN timestamp_ntz'2024-01-15 00:00:00'"
            " ELSE timestamp_ntz'2024-02-01 00:00:00' END AS date_last_updated",
        )

    @once
    def tag_map(self) -> DataFrame:
        return self.spark.createDataFrame(TAG_MAP, "campaign string, tag string")

    @once
    def tag_dim(self) -> DataFrame:
        return self.spark.createDataFrame(TAG_DIM, "tag string, tag_id string")

    @once
    def lists(self) -> DataFrame:
        return self.venues().selectExpr("id AS venue_id", "insider_crm_id AS list_id")

    @once
    def connections(self) -> DataFrame:
        return self.raw("nation").where("n_nationkey % 5 <> 4").selectExpr(
            "cast(n_nationkey AS string) AS venue_id", "cast(n_nationkey + 1 AS string) AS connection"
        )

    def crm_customers(self, lines: DataFrame) -> DataFrame:
        """CRM ids the connections gave to every third customer of these order lines."""
        placed = lines.join(self.connections(), "venue_id").where("cast(customerid AS bigint) % 3 = 0")
        return placed.select("connection", "email", "customerid").distinct().selectExpr(
            "connection",
            "email",
            "cast(cast(connection AS bigint) * 1000000 + cast(customerid AS bigint) AS string)"
            " AS crm_customer_id",
        )

    @once
    def order_json(self) -> DataFrame:
        """Order documents as JSON text, one sighting per line item."""
        # A merge join spreads the documents over tasks; a broadcast would keep the scan's split. The
        # number of tasks is given: sized by their narrow rows, few tasks would write the long documents.
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        lines = self.raw("lineitem").repartition(tasks, "l_orderkey").join(
            self.raw("orders").repartition(tasks, "o_orderkey").hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")
        )
        bad = "o_orderkey % 17 = 0 AND l_linenumber = 1"
        return lines.selectExpr(
            f"""to_json(named_struct(
                'venue_id', cast(l_partkey % 25 AS string),
                'show_id', cast(l_partkey AS string),
                'id', o_orderkey,
                'order_number', cast(o_orderkey AS string),
                'purchase_at', concat(translate(cast(o_orderdate AS string), ' ', 'T'), '.000-05:00'),
                'booking_type', o_orderstatus,
                'customer', named_struct(
                    'id', o_custkey,
                    'email', concat(' C', o_custkey, '@Example.com\r'),
                    'name', concat(' "Customer" ', o_custkey, " O'Neil\t"),
                    'first_name', 'Customer',
                    'phone', lpad(cast(o_custkey AS string), 9, '0'),
                    'new_customer', o_orderkey % 10 = 0),
                'payments', CASE WHEN o_orderkey % 13 = 0
                    THEN cast(array() AS array<struct<payment_method:string>>)
                    ELSE array(named_struct('payment_method', o_orderpriority)) END,
                'addons', CASE WHEN o_orderkey % 5 = 0
                    THEN array(named_struct('name', 'parking'), named_struct('name', 'drink'))
                    ELSE cast(array() AS array<struct<name:string>>) END,
                'tickets', map(concat('Tier ', l_returnflag), array(named_struct(
                    'id', l_linenumber,
                    'price', CASE WHEN {bad} THEN 'n/a'
                        ELSE cast(cast(round(l_extendedprice * 100) AS bigint) AS string) END,
                    'printed', l_linestatus = 'F',
                    'promo_code_id', CASE WHEN l_returnflag = 'R' THEN 'P1' END,
                    'checked_in', l_returnflag = 'A')))
            )) AS value"""
        )

    @once
    def order_sightings(self, *fields: str) -> DataFrame:
        """The order documents as columns, or only these fields of them (Spark cannot prune ``inline``)."""
        wanted = StructType([f for f in LANDED_ORDER_JSON.fields if not fields or f.name in fields])
        return parsed(self.order_json(), wanted)

    @once
    def catalog_json(self) -> DataFrame:
        """Catalogue documents, one event and show each."""
        events = self.events().withColumnRenamed("id", "event_id")
        return self.shows().join(events, "event_id").selectExpr(
            """to_json(named_struct('venue_id', venue_id, 'data', array(named_struct(
                'id', cast(event_id AS bigint), 'name', name, 'image_url', logo_url,
                'shows', array(named_struct('id', cast(id AS bigint), 'start_date_time',
                    concat(translate(cast(start_date_time AS string), ' ', 'T'), '.000-05:00'))))))) AS value"""
        )

    @once
    def show_json(self) -> DataFrame:
        start = "concat(translate(cast(start_date_time AS string), ' ', 'T'), 'Z')"
        return self.shows().selectExpr(
            f"""to_json(named_struct('show_id', id, 'data', named_struct(
                'event_id', cast(event_id AS bigint), 'start_date_time', {start},
                'sold_out', sold_out = 'True',
                'event', named_struct('cancelled_at',
                    CASE WHEN cast(id AS bigint) % 9 = 0 THEN {start} END)))) AS value"""
        )

    @once
    def order_link(self) -> DataFrame:
        return self.raw("orders").where("o_orderkey % 4 = 0").selectExpr(
            "cast(o_orderkey AS string) AS order_number",
            "cast(o_orderkey % 5 + 1 AS string) AS connection",
            "concat('x', o_orderkey) AS crm_id",
        )

    @once
    def crm_lists(self) -> DataFrame:
        """CRM ids of two of three customers, in messy emails, and the lists of some of them."""
        return self.raw("customer").where("c_custkey % 3 <> 0").selectExpr(
            "concat(' C', c_custkey, '@Example.com') AS email",
            "concat('k', c_custkey) AS crm_id",
            "CASE WHEN c_custkey % 4 < 2 THEN cast(c_custkey % 25 AS string) END AS list_id",
        )

    @once
    def contact_responses(self) -> DataFrame:
        """A log of responses to contact pushes, one per order."""
        return self.raw("orders").selectExpr(
            "cast(o_orderkey AS string) AS key",
            "CASE WHEN o_orderkey % 13 = 0 THEN '' WHEN o_orderkey % 13 > 1 THEN cast(o_custkey % 25 AS string) END"
            " AS venue_id",
            "CASE WHEN o_custkey % 2 = 0 THEN 'contact_edit' ELSE 'contact_add' END AS action",
            "CASE WHEN o_orderkey % 7 = 0 THEN 500 ELSE 200 END AS status",
            "CASE o_orderkey % 5 WHEN 0 THEN '{\"result_code\":0}' WHEN 1 THEN 'gateway' WHEN 2 THEN '{}'"
            " ELSE '{\"result_code\":1}' END AS body",
        )

    @once
    def responses(self) -> DataFrame:
        """A log of push responses, one per order."""
        return self.raw("orders").selectExpr(
            "cast(o_orderkey AS string) AS key",
            "cast(o_custkey % 25 AS string) AS venue_id",
            "CASE o_orderkey % 11 WHEN 0 THEN 422 WHEN 1 THEN 422 WHEN 2 THEN 500 ELSE 201 END AS status",
            "CASE o_orderkey % 11 WHEN 0 THEN '{\"errors\":[{\"code\":\"duplicate\"}]}'"
            " WHEN 1 THEN '{\"errors\":[{\"code\":\"invalid\"}]}' WHEN 2 THEN 'gateway' ELSE '{}' END AS body",
        )

    @once
    def base(self) -> BaseTables:
        return BaseTables(
            contacts=self.contacts(),
            venues=self.venues(),
            events=self.events(),
            shows=self.shows(),
            orders=self.orders(),
            orderlines=self.orderlines(),
            messages=self.messages(),
            crm_contacts=self.crm_contacts(),
        )

    @once
    def processed(self) -> dict[str, DataFrame]:
        used = BaseTables(
            events=self.events(), shows=self.shows(), orders=self.orders(), orderlines=self.orderlines()
        )
        return processed_tables(used, OPTIONS)
