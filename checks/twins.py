"""DuckDB twins of the registered queries.

Each twin is a SELECT over common table expressions; ``twin`` adds the ones it needs. The
expressions are written the relational textbook way (self joins, one table per
feature), so they check the engine's single-pass forms independently.
"""

from __future__ import annotations

import re

from checks.bindings import AS_OF, CUTOFF, MARK, MESSAGES_AS_OF, MESSAGES_MARK, TAG_DIM, TAG_MAP


def _values(rows: list[tuple[str, ...]]) -> str:
    return ", ".join("(" + ", ".join(f"'{value}'" for value in row) + ")" for row in rows)


def _digits(column: str) -> str:
    return f"coalesce(left(regexp_replace({column}, '[^0-9]', '', 'g'), 20), '')"


def _weekday(mode: str, count_mode: str) -> str:
    number = "isodow(s.start_date_formatted) - 1" if mode == "corrected" else "dayofweek(s.start_date_formatted) + 1"
    cells = ", ".join(
        f"coalesce(sum(CASE WHEN d = {i} THEN {'n' if count_mode == 'orders' else '1'} END), 0)::BIGINT"
        f" AS shows_attended_{letter}"
        for i, letter in enumerate("MTWRFSU")
    )
    return (
        f"SELECT k AS subscriber_key, {cells} FROM (SELECT o.email AS k, {number} AS d, count(*) AS n"
        " FROM orders_p o JOIN shows_p s ON o.show_id = s.id GROUP BY 1, 2) GROUP BY k"
    )


def _recency() -> str:
    columns = []
    for days in (360, 180, 90):
        recent = f"purchase_date_formatted BETWEEN DATE '{AS_OF}' - {days} AND DATE '{AS_OF}'"
        columns += [
            f"round(sum(CASE WHEN not_comped = 1 AND {recent} THEN order_total END)::DECIMAL(30,2) / 100)::BIGINT"
            f" AS paid_orders_revenue_{days}",
            f"count(CASE WHEN not_comped = 1 AND {recent} THEN 1 END) AS paid_orders_count_{days}",
            f"count(CASE WHEN comped = 1 AND {recent} THEN 1 END) AS comp_orders_count_{days}",
        ]
    return f"SELECT email AS subscriber_key, {', '.join(columns)} FROM orders_p GROUP BY 1"


def _pick(name: str, bound: str, extreme: str) -> str:
    """First / last / next by self join; ties on the date go to the lowest (title, venue)."""
    return (
        f"SELECT a.subscriber_key AS k, a.start_date_formatted AS {name}_day,"
        f" min((event_title, event_venue)) AS {name}_pick FROM attended a JOIN (SELECT subscriber_key AS k,"
        f" {extreme}(start_date_formatted) AS day FROM attended WHERE start_date_formatted {bound} DATE '{AS_OF}'"
        " GROUP BY 1) x ON x.k = a.subscriber_key AND x.day = a.start_date_formatted GROUP BY 1, 2"
    )


_EMAIL = "CASE WHEN lower(trim(email)) NOT IN ('', 'none') THEN lower(trim(email)) END"

# The CRM knows two of three customers, half of them with a list.
_CUSTOMER = r"TRY_CAST(regexp_extract(email_address, '^c(\d+)@', 1) AS BIGINT)"
_CRM_ID = f"CASE WHEN {_CUSTOMER} % 3 <> 0 THEN 'k' || {_CUSTOMER} END"
_ACTION = f"CASE WHEN {_CUSTOMER} % 3 <> 0 THEN 'contact_edit' ELSE 'contact_add' END"
_LIST_ID = f"CASE WHEN {_CUSTOMER} % 3 <> 0 AND {_CUSTOMER} % 4 < 2 THEN ({_CUSTOMER} % 25)::VARCHAR END"

_CTES: dict[str, str] = {
    # The given tables as ticketing tables.
    "t_contacts": """SELECT 'c' || c_custkey || '@example.com' AS email_address, c_name AS name,
        split_part(c_name, '#', 1) AS name_first, split_part(c_name, '#', 2) AS name_last,
        TIMESTAMP '1998-01-01' + to_days((c_custkey % 365)::INT) AS sys_entry_date FROM customer""",
    "t_venues": """SELECT n_nationkey::VARCHAR AS id, n_name AS name,
        CASE WHEN n_nationkey % 7 <> 0 THEN (100 + n_nationkey)::VARCHAR END AS insider_crm_id FROM nation""",
    "t_events": """SELECT p_partkey::VARCHAR AS id, (p_partkey % 25)::VARCHAR AS venue_id,
        p_name || ' ' || p_type AS name, p_brand AS logo_url FROM part""",
    "t_shows": """SELECT p_partkey::VARCHAR AS id, (CASE WHEN p_partkey % 40 = 3 THEN -p_partkey ELSE p_partkey - p_partkey % 4 + 1 END)::VARCHAR AS event_id,
        TIMESTAMP '1995-01-01 19:30:00' + to_days(((p_partkey * 37) % 2500)::INT) AS start_date_time,
        CASE WHEN p_size % 2 = 0 THEN 'True' ELSE 'False' END AS sold_out FROM part""",
    "t_orders": """SELECT o_orderkey::VARCHAR AS id, show_key::VARCHAR AS show_id,
        o_orderkey::VARCHAR AS order_number, o_custkey::VARCHAR AS cust_id,
        'c' || o_custkey || '@example.com' AS email,
        '(' || lpad(o_custkey::VARCHAR, 9, '0')[1:3] || ') ' || lpad(o_custkey::VARCHAR, 9, '0')[4:6]
            || '-' || lpad(o_custkey::VARCHAR, 9, '0')[7:9] AS phone,
        o_orderdate AS purchase_date, o_orderpriority AS payment_method, o_orderstatus AS booking_type,
        round(o_totalprice * 100)::BIGINT AS order_total,
        CASE WHEN o_orderkey % 10 = 0 THEN 'True' ELSE 'False' END AS new_customer,
        CASE WHEN o_orderkey % 97 <> 0 THEN o_orderdate + INTERVAL 1 DAY END AS sys_entry_date, '' AS addons
        FROM orders LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS show_key FROM lineitem GROUP BY 1)
        ON l_orderkey = o_orderkey""",
    "t_lines": """SELECT l_orderkey || '-' || l_linenumber AS id, l_orderkey::VARCHAR AS order_number,
        'Tier ' || l_returnflag AS ticket_name, round(l_extendedprice * 100)::BIGINT AS ticket_price,
        l_linestatus AS printed, NULL::VARCHAR AS promo_code_id, l_returnflag AS checked_in FROM lineitem""",
    "t_messages": """SELECT CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 'unknown'
        WHEN event_id % 7 = 0 THEN '+(' || lpad(user_id::VARCHAR, 9, '0')[1:3] || ') '
            || lpad(user_id::VARCHAR, 9, '0')[4:] ELSE lpad(user_id::VARCHAR, 9, '0') END AS mobile_number,
        'JOIN' AS keyword, (event_id % 1000)::VARCHAR AS security_code,
        CASE WHEN event_id % 4 = 0 THEN upper(event_type) ELSE event_type END AS campaign,
        CASE WHEN event_type = 'error' THEN 'please Stop' ELSE event_type END AS body,
        CASE WHEN event_id % 50 = 0 AND user_id % 3 = 0 THEN CASE WHEN event_id % 100 = 0 THEN ' U' ELSE 'u' END
            || user_id || '@Sms.example' WHEN event_id % 50 = 1 THEN 'None' END AS email,
        ts AS stamp FROM events""",
    "c_messages": f"""SELECT nullif({_digits('mobile_number')}, '') AS mobile_number, keyword, security_code, campaign,
        body, {_EMAIL} AS email, stamp FROM t_messages""",
    "t_crm": """SELECT 'c' || c_custkey || '@example.com' AS email,
        CASE WHEN c_custkey % 2 = 0 THEN '+' || lpad(c_custkey::VARCHAR, 9, '0') END AS mobile_number,
        CASE c_custkey % 3 WHEN 0 THEN 'yes' WHEN 1 THEN 'No' END AS optin_status,
        CASE WHEN c_custkey % 11 = 10 THEN NULL WHEN c_custkey % 4 < 2 THEN TIMESTAMP '2024-01-15'
        ELSE TIMESTAMP '2024-02-01' END AS date_last_updated FROM customer""",
    "t_tag_map": f"SELECT * FROM (VALUES {_values(TAG_MAP)}) AS v(campaign, tag)",
    "t_tag_dim": f"SELECT * FROM (VALUES {_values(TAG_DIM)}) AS v(tag, tag_id)",
    "t_connections": """SELECT n_nationkey::VARCHAR AS venue_id, (n_nationkey + 1)::VARCHAR AS connection
        FROM nation WHERE n_nationkey % 5 <> 4""",
    "t_lists": "SELECT id AS venue_id, insider_crm_id AS list_id FROM t_venues",
    "t_link": """SELECT o_orderkey::VARCHAR AS order_number, (o_orderkey % 5 + 1)::VARCHAR AS connection,
        'x' || o_orderkey AS crm_id FROM orders WHERE o_orderkey % 4 = 0""",
    "t_responses": """SELECT o_orderkey::VARCHAR AS key, (o_custkey % 25)::VARCHAR AS venue_id,
        CASE o_orderkey % 11 WHEN 0 THEN 'duplicate' WHEN 1 THEN 'other' WHEN 2 THEN 'other' ELSE 'success' END
        AS outcome FROM orders""",
    # Order JSON, one sighting per line item.
    "t_sightings": """SELECT (l_partkey % 25)::VARCHAR AS venue_id, l_partkey AS show_key, l_orderkey, l_linenumber,
        l_returnflag, l_linestatus, o_custkey, o_orderdate, o_orderstatus,
        CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE o_orderpriority END AS payment_method,
        CASE WHEN o_orderkey % 17 = 0 AND l_linenumber = 1 THEN NULL ELSE round(l_extendedprice * 100)::BIGINT END
            AS price,
        CASE WHEN o_orderkey % 5 = 0 THEN 'parking' || chr(9) || 'drink' ELSE '' END AS addons
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    # Cleaned copies.
    "orders_p": """SELECT *, purchase_date::DATE AS purchase_date_formatted,
        CASE WHEN payment_method ILIKE '%low%' THEN 1 ELSE 0 END AS comped,
        CASE WHEN payment_method NOT ILIKE '%low%' THEN 1 ELSE 0 END AS not_comped FROM t_orders""",
    "shows_p": """SELECT *, start_date_time::DATE AS start_date_formatted,
        (isodow(start_date_time::DATE) - 1)::INT AS day_of_week FROM t_shows""",
    "events_p": """SELECT *, CASE WHEN name ILIKE '%promo%' THEN 1 END AS special_event,
        CASE WHEN name ILIKE '%large%' THEN 1 END AS presents_event FROM t_events""",
    # Marts.
    "mart": """SELECT l.id AS unique_id, o.id AS externalid, o.email, o.order_number AS orderNumber,
        o.purchase_date_formatted AS orderDate, o.order_total AS totalPrice, o.cust_id AS customerid,
        o.payment_method AS shippingMethod, l.ticket_name AS orderproduct_name,
        l.ticket_price AS orderproduct_price, o.show_id AS orderproduct_category, o.comped, o.not_comped,
        o.booking_type, o.new_customer, v.id AS venue_id, e.name AS event_name, o.sys_entry_date, o.addons
        FROM orders_p o JOIN t_lines l ON l.order_number = o.order_number JOIN shows_p s ON s.id = o.show_id
        JOIN events_p e ON e.id = s.event_id JOIN t_venues v ON v.id = e.venue_id""",
    "attended": """SELECT c.email_address AS subscriber_key, s.start_date_formatted, e.name AS event_title,
        v.id AS event_venue FROM t_contacts c JOIN orders_p o ON o.email = c.email_address
        JOIN shows_p s ON s.id = o.show_id JOIN events_p e ON e.id = s.event_id
        JOIN t_venues v ON v.id = e.venue_id""",
    "counts_all": "SELECT orderNumber, count(*) AS n FROM mart GROUP BY 1",
    "counts_paid": "SELECT orderNumber, count(*) AS n FROM mart WHERE not_comped = 1 GROUP BY 1",
    "counts_comp": "SELECT orderNumber, count(*) AS n FROM mart WHERE comped = 1 GROUP BY 1",
    # Features.
    "pick_first": _pick("first", "<=", "min"),
    "pick_last": _pick("last", "<=", "max"),
    "pick_next": _pick("next", ">", "min"),
    "f_fln": """SELECT c.email_address AS subscriber_key, first_day::VARCHAR AS first_show_attended,
        first_pick[1] AS first_event_title, first_pick[2] AS first_event_venue,
        last_day::VARCHAR AS last_show_attended, last_pick[1] AS last_event_title,
        last_pick[2] AS last_event_venue, next_day::VARCHAR AS next_show_attending,
        next_pick[1] AS next_event_title, next_pick[2] AS next_event_venue
        FROM t_contacts c LEFT JOIN pick_first f ON f.k = c.email_address
        LEFT JOIN pick_last l ON l.k = c.email_address LEFT JOIN pick_next x ON x.k = c.email_address""",
    "f_lead": """SELECT c.email_address AS subscriber_key,
        avg(date_diff('day', o.purchase_date_formatted, s.start_date_formatted)) AS avg_purchase_to_show_days,
        sum(t.n)::DOUBLE / count(o.order_number) AS avg_tickets_per_order
        FROM t_contacts c JOIN orders_p o ON o.email = c.email_address JOIN shows_p s ON s.id = o.show_id
        JOIN counts_all t ON t.orderNumber = o.order_number GROUP BY 1""",
    "f_paid": """SELECT c.email_address AS subscriber_key, count(o.order_number) AS total_lifetime_paid_orders,
        sum(t.n)::BIGINT AS total_lifetime_paid_tickets,
        sum(t.n)::DOUBLE / count(o.order_number) AS avg_tickets_per_paid_order
        FROM t_contacts c JOIN orders_p o ON o.email = c.email_address
        JOIN counts_paid t ON t.orderNumber = o.order_number GROUP BY 1""",
    "f_comp": """SELECT c.email_address AS subscriber_key, max(s.start_date_formatted)::VARCHAR AS last_comp_show_date,
        count(o.order_number) AS total_lifetime_comp_orders, sum(t.n)::BIGINT AS total_lifetime_comp_tickets,
        sum(t.n)::DOUBLE / count(o.order_number) AS avg_tickets_per_comp_order
        FROM t_contacts c JOIN orders_p o ON o.email = c.email_address JOIN shows_p s ON s.id = o.show_id
        JOIN counts_comp t ON t.orderNumber = o.order_number GROUP BY 1""",
    "f_week": _weekday("corrected", "orders"),
    "f_recency": _recency(),
    "f_special": """SELECT o.email AS subscriber_key, arg_max(o.phone, (o.purchase_date_formatted, o.id)) AS phone,
        max(o.purchase_date_formatted)::VARCHAR AS last_ordered_date,
        count(CASE WHEN e.special_event = 1 THEN 1 END) AS count_shows_special,
        count(CASE WHEN e.presents_event = 1 THEN 1 END) AS count_shows_persents
        FROM orders_p o JOIN shows_p s ON s.id = o.show_id JOIN events_p e ON e.id = s.event_id GROUP BY 1""",
    "f_spend": """SELECT o.email AS subscriber_key,
        round(sum(l.ticket_price)::DECIMAL(30,2) / 100)::BIGINT AS total_revenue
        FROM orders_p o JOIN t_lines l ON l.order_number = o.order_number WHERE o.not_comped = 1 GROUP BY 1""",
    "wide": f"""SELECT c.email_address, c.name AS cust_name, c.name_first AS cust_name_first,
        c.name_last AS cust_name_last,
        CASE WHEN sp.phone IS NULL OR sp.phone = '' THEN sp.phone ELSE {_digits('sp.phone')} END AS phone, total_revenue, last_ordered_date,
        first_show_attended, first_event_title, first_event_venue, last_show_attended, last_event_title,
        last_event_venue, next_show_attending, next_event_title, next_event_venue, avg_tickets_per_order,
        round(avg_purchase_to_show_days)::INT AS avg_purchase_to_show_days,
        coalesce(total_lifetime_paid_orders, 0) + coalesce(total_lifetime_comp_orders, 0) AS total_orders,
        total_lifetime_paid_orders, total_lifetime_paid_tickets, avg_tickets_per_paid_order,
        total_lifetime_comp_orders, total_lifetime_comp_tickets, avg_tickets_per_comp_order, last_comp_show_date,
        shows_attended_M, shows_attended_T, shows_attended_W, shows_attended_R, shows_attended_F,
        shows_attended_S, shows_attended_U,
        paid_orders_revenue_360, paid_orders_count_360, comp_orders_count_360,
        paid_orders_revenue_180, paid_orders_count_180, comp_orders_count_180,
        paid_orders_revenue_90, paid_orders_count_90, comp_orders_count_90,
        count_shows_special, count_shows_persents, c.sys_entry_date
        FROM t_contacts c LEFT JOIN f_fln ON f_fln.subscriber_key = c.email_address
        LEFT JOIN f_lead ON f_lead.subscriber_key = c.email_address
        LEFT JOIN f_paid ON f_paid.subscriber_key = c.email_address
        LEFT JOIN f_comp ON f_comp.subscriber_key = c.email_address
        LEFT JOIN f_week ON f_week.subscriber_key = c.email_address
        LEFT JOIN f_recency ON f_recency.subscriber_key = c.email_address
        LEFT JOIN f_spend ON f_spend.subscriber_key = c.email_address
        LEFT JOIN f_special sp ON sp.subscriber_key = c.email_address""",
    # Text messages.
    "crm_by_number": f"""SELECT {_digits('mobile_number')} AS number, min(email) AS email FROM t_crm
        WHERE {_digits('mobile_number')} <> '' GROUP BY 1""",
    "wide_by_number": """SELECT phone AS number, min(email_address) AS email FROM wide WHERE phone <> '' GROUP BY 1""",
    "enriched": """SELECT m.mobile_number, keyword, security_code, campaign, body,
        coalesce(m.email, a.email, w.email) AS email, stamp FROM c_messages m
        LEFT JOIN crm_by_number a ON a.number = m.mobile_number
        LEFT JOIN wide_by_number w ON w.number = m.mobile_number""",
    "subs": """SELECT mobile_number,
        CASE WHEN max(CASE WHEN body ILIKE '%STOP%' THEN stamp END) = max(stamp) THEN 'Unsubscribed'
            ELSE 'Subscribed' END AS mobile_status,
        max((stamp, email)) FILTER (email IS NOT NULL) AS pick,
        date_trunc('second', min(stamp)) AS join_date, date_trunc('second', max(stamp)) AS last_message_date
        FROM enriched WHERE mobile_number IS NOT NULL GROUP BY 1""",
    "subscribers": """SELECT mobile_number, mobile_status, pick[2] AS email_address, join_date, last_message_date
        FROM subs""",
    "conflicts": """SELECT email_address, mobile_number, mobile_status, last_message_date AS mobile_date,
        optin_status AS ac_status, date_last_updated AS ac_date
        FROM subscribers JOIN (SELECT email, optin_status, date_last_updated FROM t_crm) ON email = email_address
        WHERE optin_status IS NULL OR (lower(optin_status) = 'yes' AND mobile_status <> 'Subscribed')
        OR (lower(optin_status) = 'no' AND mobile_status = 'Subscribed')""",
    "resolved": """SELECT * FROM (SELECT *, CASE WHEN ac_status IS NULL OR ac_status = '' THEN sms
        WHEN lower(ac_status) = lower(sms) THEN NULL WHEN ac_date > mobile_date THEN upper(ac_status[1]) ||
        lower(ac_status[2:]) WHEN mobile_date > ac_date THEN sms END AS mobile_optin FROM (SELECT *,
        CASE WHEN mobile_status = 'Subscribed' THEN 'Yes' ELSE 'No' END AS sms FROM conflicts))
        WHERE mobile_optin IS NOT NULL""",
    "backlog": """SELECT DISTINCT s.email_address AS email, t.tag FROM subscribers s
        JOIN c_messages m ON m.mobile_number = s.mobile_number JOIN t_tag_map t ON lower(t.campaign) = lower(m.campaign)
        WHERE s.email_address IS NOT NULL AND t.tag NOT ILIKE 'IGNORE%'""",
    "daily": f"""SELECT DISTINCT s.email_address AS email,
        CASE WHEN t.tag IS NULL OR t.tag IN ('', 'None') THEN m.campaign ELSE t.tag END AS tag
        FROM subscribers s JOIN c_messages m ON m.mobile_number = s.mobile_number
        LEFT JOIN t_tag_map t ON lower(t.campaign) = lower(m.campaign) WHERE s.email_address IS NOT NULL
        AND s.last_message_date > TIMESTAMP '{MESSAGES_MARK}' AND s.last_message_date <= TIMESTAMP '{MESSAGES_AS_OF}'""",
    # Pushes.
    "changed": f"""SELECT * FROM mart WHERE sys_entry_date > TIMESTAMP '{MARK}'
        AND sys_entry_date <= TIMESTAMP '{AS_OF}'""",
    "changed_orders": """SELECT DISTINCT venue_id, email, orderNumber, externalid, customerid,
        orderDate, shippingMethod, totalPrice FROM changed""",
    "customers": """SELECT DISTINCT connection, email, (connection::BIGINT * 1000000 + customerid::BIGINT)::VARCHAR
        AS crm_customer_id FROM changed JOIN t_connections USING (venue_id) WHERE customerid::BIGINT % 3 = 0""",
    "pushed": """SELECT o.*, connection, crm_customer_id, crm_id,
        CASE WHEN crm_id IS NULL THEN 'add' ELSE 'update' END AS action
        FROM changed_orders o JOIN t_connections USING (venue_id) JOIN customers USING (connection, email)
        LEFT JOIN (SELECT order_number AS orderNumber, connection, min(crm_id) AS crm_id FROM t_link GROUP BY 1, 2)
        USING (orderNumber, connection)""",
    "selected": f"""SELECT * FROM wide WHERE (sys_entry_date > TIMESTAMP '{MARK}'
        AND sys_entry_date <= TIMESTAMP '{AS_OF}') OR email_address IN (SELECT email FROM mart
        WHERE orderproduct_category IN (SELECT id FROM shows_p
        WHERE start_date_formatted BETWEEN DATE '{MARK}' AND DATE '{AS_OF}'))""",
    "planned": """SELECT w.*, coalesce(next_event_venue, last_event_venue, '') AS home_venue, list_id,
        CASE WHEN coalesce(next_event_venue, last_event_venue, '') = '' THEN 'err_list'
        WHEN list_id IS NULL THEN 'err_other' ELSE 'ready' END AS plan
        FROM selected w LEFT JOIN t_lists ON venue_id = coalesce(next_event_venue, last_event_venue, '')""",
}

_WORD = re.compile(r"\b(" + "|".join(_CTES) + r")\b")


def twin(select: str) -> str:
    """The SELECT with the CTEs it refers to, in dependency order."""
    needed: set[str] = set()
    queue = _WORD.findall(select)
    while queue:
        name = queue.pop()
        if name not in needed:
            needed.add(name)
            queue += _WORD.findall(_CTES[name])
    ctes = ", ".join(f"{name} AS ({body})" for name, body in _CTES.items() if name in needed)
    return f"WITH {ctes} {select}" if ctes else select


_ORDER_COLUMNS = """id, show_id, order_number, cust_id, email, phone, purchase_date::VARCHAR AS purchase_date,
    payment_method, booking_type, order_total, new_customer, sys_entry_date::VARCHAR AS sys_entry_date, addons"""
_MART_COLUMNS = "* REPLACE (orderDate::VARCHAR AS orderDate, sys_entry_date::VARCHAR AS sys_entry_date)"
_WIDE_COLUMNS = "* REPLACE (sys_entry_date::VARCHAR AS sys_entry_date)"
_SUBS_COLUMNS = "* REPLACE (join_date::VARCHAR AS join_date, last_message_date::VARCHAR AS last_message_date)"
_SIGHTING_ORDER = """l_orderkey::VARCHAR AS id, l_orderkey::VARCHAR AS order_number, o_custkey::VARCHAR AS cust_id,
    'c' || o_custkey || '@example.com' AS email, o_orderdate::VARCHAR AS purchase_date, payment_method,
    o_orderstatus AS booking_type, CASE WHEN l_orderkey % 10 = 0 THEN 'True' ELSE 'False' END AS new_customer,
    '1998-07-01 00:00:00' AS sys_entry_date, addons"""
_SIGHTING_CONTACT = """'c' || o_custkey || '@example.com' AS email_address,
    'Customer ' || o_custkey || ' O`Neil' AS name, 'Customer' AS name_first, '' AS name_last"""


TWINS: dict[str, str] = {
    # Sources and sinks
    "load_table": """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderpriority = '5-LOW'""",
    "full_refresh": f"""SELECT {_ORDER_COLUMNS}, purchase_date_formatted::VARCHAR AS purchase_date_formatted,
        comped, not_comped FROM orders_p""",
    "upsert_contacts": """SELECT email_address, CASE WHEN k % 3 = 0 THEN name || ' (new)' ELSE name END AS name,
        name_first, name_last, CASE WHEN k % 3 = 0 THEN '1998-07-02 00:00:00' ELSE sys_entry_date::VARCHAR END
        AS sys_entry_date FROM (SELECT *, name_last::BIGINT AS k FROM t_contacts) UNION ALL
        SELECT 'new-' || email_address, name || ' (new)', name_first, name_last, '1998-07-02 00:00:00'
        FROM (SELECT *, name_last::BIGINT AS k FROM t_contacts) WHERE k % 3 = 0""",
    "upsert_events": """SELECT id, venue_id, CASE WHEN id::INT % 3 = 0 THEN name || ' (new)' ELSE name END AS name,
        logo_url FROM t_events UNION ALL SELECT 'new-' || id, venue_id, name || ' (new)', logo_url FROM t_events
        WHERE id::INT % 3 = 0""",
    "upsert_shows": """SELECT id, event_id, start_date_time::VARCHAR AS start_date_time,
        CASE WHEN id::BIGINT % 3 = 0 THEN 'sold' ELSE sold_out END AS sold_out, NULL::VARCHAR AS cancelled_at
        FROM t_shows UNION ALL SELECT 'new-' || id, event_id, start_date_time::VARCHAR, 'sold', NULL
        FROM t_shows WHERE id::BIGINT % 3 = 0""",
    "upsert_orders": """SELECT id, order_number, email, CASE WHEN id::BIGINT % 3 = 0 THEN order_total + 1
        ELSE order_total END AS order_total FROM t_orders UNION ALL
        SELECT 'new-' || id, order_number, email, order_total + 1 FROM t_orders WHERE id::BIGINT % 3 = 0""",
    "upsert_orderlines": """SELECT id, order_number, max(ticket_price) AS ticket_price FROM t_lines GROUP BY 1, 2""",
    "upsert_links": """SELECT order_number, connection, CASE WHEN order_number::BIGINT % 8 = 0 THEN 'y' || order_number
        ELSE crm_id END AS crm_id FROM t_link UNION ALL SELECT order_number, '99', 'y' || order_number FROM t_link
        WHERE order_number::BIGINT % 8 = 4""",
    "append_messages": """SELECT mobile_number, keyword, security_code, campaign, body, email,
        date_trunc('second', stamp)::VARCHAR AS stamp FROM t_messages""",
    "export_csv_chunks": "SELECT email_address, name, name_first, name_last FROM t_contacts",
    "write_payloads": """SELECT venue_id, externalid, email, orderNumber, totalPrice::VARCHAR AS total_price,
        connection::INT AS connection, crm_customer_id::BIGINT AS crm_customer_id FROM pushed""",
    "run_incremental": f"""SELECT id, sys_entry_date::VARCHAR AS sys_entry_date FROM t_orders
        WHERE sys_entry_date > TIMESTAMP '{CUTOFF}' AND sys_entry_date <= TIMESTAMP '{AS_OF}'""",
    "run_job_windows": f"""SELECT id, sys_entry_date::VARCHAR AS sys_entry_date FROM t_orders
        WHERE sys_entry_date > TIMESTAMP '{CUTOFF}' AND sys_entry_date <= TIMESTAMP '{AS_OF}'""",
    "read_orders_json": f"SELECT venue_id, show_key::VARCHAR AS show_id, {_SIGHTING_ORDER} FROM t_sightings",
    "read_catalog_json": """SELECT s.id AS show_id, e.id AS event_id, e.venue_id, e.name, e.logo_url
        FROM t_shows s JOIN t_events e ON e.id = s.event_id""",
    "read_show_json": """SELECT id, event_id, start_date_time::VARCHAR AS start_date_time, sold_out,
        CASE WHEN id::BIGINT % 9 = 0 THEN start_date_time::VARCHAR END AS cancelled_at FROM t_shows""",
    # Ingest
    "flatten_orders": f"""SELECT venue_id, show_key::VARCHAR AS show_id, {_SIGHTING_ORDER},
        coalesce(price, 0) AS order_total, (price IS NULL)::INT AS bad_prices FROM t_sightings""",
    "merge_order_sightings": f"""SELECT show_id, order_total, bad_prices, first.* EXCLUDE (l_orderkey)
        FROM (SELECT l_orderkey AS k,
        min(show_key)::VARCHAR AS show_id, sum(coalesce(price, 0))::BIGINT AS order_total,
        count(*) FILTER (price IS NULL) AS bad_prices FROM t_sightings GROUP BY 1)
        JOIN (SELECT DISTINCT l_orderkey, {_SIGHTING_ORDER} FROM t_sightings) first ON k = first.l_orderkey""",
    "flatten_orderlines": """SELECT l_orderkey || '-' || l_linenumber AS id, l_orderkey::VARCHAR AS order_number,
        'Tier ' || l_returnflag AS ticket_name, price AS ticket_price,
        CASE WHEN l_linestatus = 'F' THEN 'True' ELSE 'False' END AS printed,
        CASE WHEN l_returnflag = 'R' THEN 'P1' END AS promo_code_id,
        CASE WHEN l_returnflag = 'A' THEN 'True' ELSE 'False' END AS checked_in FROM t_sightings""",
    "flatten_contacts": f"""SELECT DISTINCT {_SIGHTING_CONTACT}, '1998-07-01 00:00:00' AS sys_entry_date
        FROM t_sightings""",
    "backfill_contacts": f"""SELECT DISTINCT {_SIGHTING_CONTACT}, '1999-12-31 23:59:59' AS sys_entry_date
        FROM t_sightings""",
    "flatten_events": """SELECT DISTINCT e.id, e.venue_id, e.name, e.logo_url FROM t_events e
        JOIN t_shows s ON s.event_id = e.id""",
    "recent_shows": f"""SELECT e.venue_id, e.id AS event_id, s.id AS show_id FROM t_events e
        JOIN t_shows s ON s.event_id = e.id WHERE s.start_date_time > TIMESTAMP '{MARK}' - INTERVAL 4 DAY""",
    "flatten_shows": """SELECT id, event_id, start_date_time::VARCHAR AS start_date_time, sold_out,
        CASE WHEN id::BIGINT % 9 = 0 THEN start_date_time::VARCHAR END AS cancelled_at FROM t_shows""",
    "bad_price_report": """SELECT l_orderkey::VARCHAR AS order_number, count(*) AS bad_prices FROM t_sightings
        WHERE price IS NULL GROUP BY 1""",
    # Cleaned copies
    "orderlines_processed": "SELECT * FROM t_lines",
    "orders_processed": f"""SELECT {_ORDER_COLUMNS}, purchase_date_formatted::VARCHAR AS purchase_date_formatted,
        comped, not_comped FROM orders_p""",
    "shows_processed": """SELECT id, event_id, start_date_time::VARCHAR AS start_date_time, sold_out,
        NULL::VARCHAR AS cancelled_at, start_date_formatted::VARCHAR AS start_date_formatted, day_of_week FROM shows_p""",
    "events_processed": "SELECT * FROM events_p",
    "clean_phones": f"SELECT email, {_digits('mobile_number')} AS mobile_number FROM t_crm",
    # Filters and selections
    "valid_email": """SELECT email, count(*) AS n FROM (SELECT CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN ''
        WHEN 2 THEN 'None' WHEN 3 THEN 'none' ELSE 'c' || c_custkey || '@example.com' END AS email FROM customer)
        WHERE email IS NOT NULL AND email <> '' AND lower(email) <> 'none' GROUP BY 1""",
    "shows_to_repull": f"""SELECT id, event_id, start_date_time::VARCHAR AS start_date_time FROM t_shows
        WHERE event_id IN (SELECT id FROM t_events WHERE venue_id IN ('1', '5', '6', '7'))
        AND start_date_time > TIMESTAMP '{MARK}' - INTERVAL 3 DAY""",
    "changed_orders": f"SELECT {_MART_COLUMNS} FROM changed",
    "historical_orders": f"""SELECT {_MART_COLUMNS} FROM mart
        WHERE (sys_entry_date < TIMESTAMP '{CUTOFF}' OR sys_entry_date IS NULL) AND venue_id IN ('5', '6', '7', '23')""",
    "changed_contacts": f"SELECT {_WIDE_COLUMNS} FROM selected",
    "extra_push_contacts": f"""SELECT email_address, phone, total_orders FROM wide
        WHERE (sys_entry_date > TIMESTAMP '{MARK}' - INTERVAL 1 DAY AND sys_entry_date <= TIMESTAMP '{AS_OF}')
        OR email_address IN (SELECT email FROM mart WHERE orderproduct_category IN (SELECT id FROM shows_p
        WHERE start_date_formatted BETWEEN DATE '{MARK}' - 1 AND DATE '{AS_OF}'))""",
    "boundary_contacts": f"""SELECT email_address, phone, total_orders FROM wide WHERE email_address IN
        (SELECT DISTINCT email FROM mart WHERE orderDate BETWEEN DATE '{AS_OF}' - 361 AND DATE '{AS_OF}' - 359
        OR orderDate BETWEEN DATE '{AS_OF}' - 91 AND DATE '{AS_OF}' - 89)""",
    "contacts_at_venues": """SELECT email_address, phone, total_orders FROM wide WHERE email_address IN
        (SELECT DISTINCT email FROM mart WHERE venue_id IN ('3', '23'))""",
    "contacts_with_entry_date": """SELECT email_address, name FROM t_contacts
        WHERE sys_entry_date = TIMESTAMP '1998-03-01'""",
    "distinct_emails": "SELECT DISTINCT email FROM mart",
    "optin_conflicts": """SELECT * REPLACE (mobile_date::VARCHAR AS mobile_date, ac_date::VARCHAR AS ac_date)
        FROM conflicts ORDER BY email_address, mobile_number, mobile_date""",
    "optin_conflicts_since_mark": f"""SELECT email_address, mobile_number, mobile_status FROM conflicts
        WHERE mobile_date > TIMESTAMP '{MESSAGES_MARK}' AND mobile_date <= TIMESTAMP '{MESSAGES_AS_OF}'""",
    # Joins
    "orders_mart": f"SELECT {_MART_COLUMNS} FROM mart",
    "order_orphans": """SELECT o.id, o.order_number, o.email, CASE WHEN l.order_number IS NULL THEN 'line'
        WHEN s.id IS NULL THEN 'show' WHEN e.id IS NULL THEN 'event' ELSE 'venue' END AS missing
        FROM t_orders o LEFT JOIN (SELECT DISTINCT order_number FROM t_lines) l ON l.order_number = o.order_number
        LEFT JOIN t_shows s ON s.id = o.show_id LEFT JOIN t_events e ON e.id = s.event_id
        LEFT JOIN t_venues v ON v.id = e.venue_id
        WHERE l.order_number IS NULL OR s.id IS NULL OR e.id IS NULL OR v.id IS NULL""",
    "attended_events": """SELECT subscriber_key, start_date_formatted::VARCHAR AS start_date_formatted, event_title,
        event_venue FROM attended""",
    "customer_360": f"SELECT {_WIDE_COLUMNS} FROM wide",
    "customer_360_from_features": f"SELECT {_WIDE_COLUMNS} FROM wide",
    "enrich_message_email": """SELECT mobile_number, campaign, email, date_trunc('second', stamp)::VARCHAR AS stamp
        FROM enriched""",
    "missing_tags": "SELECT DISTINCT tag FROM daily WHERE tag NOT IN (SELECT tag FROM t_tag_dim)",
    "with_venue_lookup": """SELECT orderNumber, unique_id, m.venue_id, connection, connection IS NOT NULL AS mapped
        FROM mart m LEFT JOIN t_connections c ON c.venue_id = m.venue_id""",
    "plan_order_push": "SELECT venue_id, email, orderNumber, connection, crm_customer_id, crm_id, action FROM pushed",
    # Aggregations
    "ticket_counts": """SELECT orderNumber AS order_number, count(*) AS tickets,
        nullif(sum(not_comped), 0)::BIGINT AS paid_tickets, nullif(sum(comped), 0)::BIGINT AS comp_tickets
        FROM mart GROUP BY 1""",
    "order_number_totals": """SELECT l.order_number, tickets, paid_tickets, comp_tickets, line_cents FROM
        (SELECT order_number, sum(ticket_price)::BIGINT AS line_cents FROM t_lines GROUP BY 1) l LEFT JOIN
        (SELECT orderNumber, count(*) AS tickets, nullif(sum(not_comped), 0)::BIGINT AS paid_tickets,
        nullif(sum(comped), 0)::BIGINT AS comp_tickets FROM mart GROUP BY 1) ON orderNumber = l.order_number""",
    "duplicate_order_numbers": """SELECT l_orderkey || '-' || l_linenumber AS order_number, count(*) AS orders
        FROM lineitem GROUP BY 1 HAVING count(*) > 1""",
    "first_last_next": "SELECT * FROM f_fln",
    "ticket_lead_stats": "SELECT * FROM f_lead",
    "lifetime_stats_paid": "SELECT * FROM f_paid",
    "lifetime_stats_comp": "SELECT * FROM f_comp",
    "weekday_attendance_corrected": _weekday("corrected", "orders"),
    "weekday_attendance_reference": _weekday("reference", "reference"),
    "recency_spend": "SELECT * FROM f_recency",
    "recency_spend_from_rollup": "SELECT * FROM f_recency",
    "special_event_stats": "SELECT * FROM f_special",
    "total_spend": "SELECT * FROM f_spend",
    "incremental_ticket_lead_stats": "SELECT * FROM f_lead",
    "incremental_lifetime_stats_paid": "SELECT * FROM f_paid",
    "incremental_lifetime_stats_comp": "SELECT * FROM f_comp",
    "incremental_weekday_attendance": _weekday("corrected", "orders"),
    "incremental_special_event_stats": "SELECT * FROM f_special",
    "incremental_total_spend": "SELECT * FROM f_spend",
    "sms_subscribers": f"SELECT {_SUBS_COLUMNS} FROM subscribers",
    "group_order_lines": """SELECT venue_id, email, orderNumber, min(externalid) AS externalid, count(*) AS n_lines,
        sum(orderproduct_price)::BIGINT AS line_total,
        string_agg(unique_id || ':' || orderproduct_price, ',' ORDER BY unique_id, orderproduct_name,
        orderproduct_price) AS lines FROM changed GROUP BY 1, 2, 3""",
    "tag_sets": "SELECT DISTINCT email, tag FROM daily",
    "all_tags": "SELECT DISTINCT tag FROM daily",
    "push_report": """SELECT venue_id, 'order' AS entity, outcome, count(*) AS n FROM t_responses GROUP BY 1, 3""",
    "push_report_keys": """SELECT venue_id, 'order' AS entity, outcome, key FROM t_responses
        WHERE outcome <> 'success'""",
    # Windows and sets
    "pick_row": """SELECT email, id, purchase_date::VARCHAR AS purchase_date FROM (SELECT *, row_number() OVER
        (PARTITION BY email ORDER BY purchase_date DESC, id) AS r FROM t_orders) WHERE r <= 3""",
    "newest_per_key": """SELECT mobile_number, campaign, stamp FROM (SELECT mobile_number, campaign,
        date_trunc('second', stamp)::VARCHAR AS stamp, row_number() OVER (PARTITION BY mobile_number
        ORDER BY stamp DESC, campaign DESC) AS r FROM t_messages) WHERE r = 1""",
    "with_batch_id": """SELECT venue_id, orderNumber, ((row_number() OVER (PARTITION BY venue_id
        ORDER BY md5(orderNumber)) - 1) // 50)::BIGINT AS batch_id
        FROM (SELECT DISTINCT venue_id, orderNumber FROM mart)""",
    "one_link_per_order": "SELECT order_number, connection, min(crm_id) AS crm_id FROM t_link GROUP BY 1, 2",
    "union_tags": "SELECT email, tag FROM backlog UNION SELECT email, tag FROM daily",
    # Scalar functions
    "clean_name": """SELECT c_custkey, 'Customer ' || c_custkey || ' O`Neil  Jr' AS cleaned FROM customer""",
    "clean_email": "SELECT c_custkey, 'c' || c_custkey || '@example.com' AS cleaned FROM customer",
    "digits_only": f"SELECT id, {_digits('phone')} AS cleaned FROM t_orders",
    "ilike_flags": """SELECT p_partkey, (p_type ILIKE '%promo%')::INT AS special, (p_name ILIKE 'small%')::INT AS small
        FROM part""",
    "to_second": """SELECT event_id, date_trunc('second', ts)::VARCHAR AS moment, ts::DATE::VARCHAR AS day FROM events""",
    "wall_clock": """SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN
        (o_orderdate + INTERVAL 70200 SECOND)::VARCHAR END AS moment FROM orders""",
    "weekday_numbers": """SELECT id, (isodow(start_date_time) - 1)::INT AS weekday,
        (dayofweek(start_date_time) + 1)::INT AS dayofweek FROM t_shows""",
    "date_arithmetic": f"""SELECT o.id, date_diff('day', o.purchase_date_formatted, s.start_date_formatted)::INT
        AS lead_days, (o.purchase_date_formatted BETWEEN DATE '{AS_OF}' - 90 AND DATE '{AS_OF}') AS in_90
        FROM orders_p o JOIN shows_p s ON s.id = o.show_id""",
    "null_handling": """SELECT id, coalesce(show_id, 'none') AS show_id, show_id IS NULL AS no_show,
        CASE WHEN payment_method IN ('1-URGENT', '2-HIGH') THEN 'fast' ELSE 'slow' END AS speed FROM t_orders""",
    "whole_units": """SELECT l_orderkey, round(sum(round(l_extendedprice * 100)::BIGINT)::DECIMAL(30,2) / 100)::BIGINT
        AS units FROM lineitem GROUP BY 1""",
    "home_venue": """SELECT email_address, coalesce(next_event_venue, last_event_venue, '') AS home_venue FROM wide""",
    "repair_quotes": "SELECT c_custkey, c_name || '''s 9 o''clock' AS repaired FROM customer",
    "capitalise": """SELECT email, upper(optin_status[1]) || lower(optin_status[2:]) AS status FROM t_crm""",
    "parse_form": """SELECT c_custkey, 'a+' || c_custkey || '@x.co' AS email, c_custkey::VARCHAR AS mobile_number,
        'Yes & more' AS optin_status FROM customer""",
    "product_name": """SELECT unique_id, orderproduct_category || ' - ' || event_name || ' - ' || orderproduct_name
        AS product FROM mart""",
    "array_functions": """SELECT l_orderkey, l_linenumber, l_returnflag || chr(9) || l_linestatus AS joined,
        l_returnflag AS first, NULL::VARCHAR AS tenth FROM lineitem""",
    "classify_response": "SELECT key, outcome FROM t_responses",
    "classify_contact_response": """SELECT o_orderkey::VARCHAR AS key, CASE WHEN o_orderkey % 13 IN (0, 1)
        THEN 'err_list' WHEN o_orderkey % 7 <> 0 AND o_orderkey % 5 IN (1, 2) THEN 'err_other'
        WHEN o_orderkey % 7 <> 0 AND o_orderkey % 5 > 2 THEN 'success'
        WHEN o_custkey % 2 = 0 THEN 'err_update' ELSE 'err_add' END AS outcome FROM orders""",
    "order_outcome": """SELECT o_orderkey::VARCHAR AS key, CASE WHEN o_orderkey % 11 > 2 THEN 'success'
        WHEN o_orderkey % 11 > 0 THEN 'err-other' WHEN o_orderkey % 3 = 0 OR o_orderkey % 2 = 0 THEN 'success'
        ELSE 'err-update' END AS outcome FROM orders""",
    "only_numbers": f"SELECT id, {_digits('phone')} AS cleaned FROM t_orders",
    # Payloads, opt-in, tags
    "customer_payloads": """SELECT o.venue_id, email, orderNumber, connection, customerid AS external_id
        FROM changed_orders o JOIN t_connections USING (venue_id)""",
    "customer_payloads_distinct": """SELECT DISTINCT o.venue_id, email, connection, customerid AS external_id
        FROM changed_orders o JOIN t_connections USING (venue_id)""",
    "order_payloads": """SELECT p.externalid, p.email, p.orderNumber, p.orderDate::VARCHAR AS order_date,
        p.shippingMethod AS shipping_method, p.totalPrice::VARCHAR AS total_price, connection::INT AS connection,
        crm_customer_id::BIGINT AS customer_id, action, count(*)::INT AS products,
        string_agg(orderproduct_category || ' - ' || event_name || ' - ' || orderproduct_name || '|' ||
        orderproduct_price || '|1|' || orderproduct_name, ',' ORDER BY unique_id, orderproduct_category, event_name,
        orderproduct_name, orderproduct_price) AS product_list FROM pushed p JOIN changed c
        ON c.orderNumber = p.orderNumber AND c.email = p.email AND c.venue_id = p.venue_id
        GROUP BY ALL""",
    "contact_payloads": """SELECT email_address, home_venue, list_id, cust_name_first AS first_name, cust_name AS name,
        phone, total_orders::VARCHAR AS total_orders, coalesce(next_show_attending, '') AS next_date,
        coalesce(paid_orders_revenue_90::VARCHAR, 'None') AS revenue_90, 42 AS n_fields
        FROM planned WHERE plan = 'ready'""",
    "contact_push_plan": "SELECT email_address, home_venue, list_id, plan FROM planned",
    "plan_contact_push": f"SELECT email_address, {_CRM_ID} AS crm_id, {_ACTION} AS action FROM selected",
    "contact_payloads_add_or_edit": f"""SELECT email_address, {_ACTION} AS action, {_CRM_ID} AS crm_id
        FROM planned WHERE plan = 'ready'""",
    "mobile_push_plan": f"""SELECT email_address, mobile_number, mobile_optin, {_CRM_ID} AS crm_id, {_LIST_ID} AS list_id,
        CASE WHEN {_CRM_ID} IS NULL THEN 'err_other' WHEN {_LIST_ID} IS NULL THEN 'err_list' ELSE 'ready' END AS plan
        FROM resolved""",
    "mobile_payloads_with_list": f"""SELECT mobile_number, {_CRM_ID} AS crm_id, {_LIST_ID} AS list_id
        FROM resolved WHERE {_LIST_ID} IS NOT NULL""",
    "resolve_optin": "SELECT email_address, mobile_number, mobile_optin FROM resolved",
    "mobile_payloads": """SELECT email_address AS email, mobile_number, mobile_optin FROM resolved""",
    "backlog_tags": "SELECT email, tag FROM backlog",
    "daily_tags": "SELECT email, tag FROM daily",
    "tag_assignments": "SELECT email, tag, tag_id FROM daily JOIN t_tag_dim USING (tag)",
    # Streaming, final state
    "stream_messages": f"""SELECT mobile_number, keyword, security_code, campaign, body, {_EMAIL} AS email,
        date_trunc('second', stamp)::VARCHAR AS stamp FROM t_messages""",
    "stream_sms_subscribers": """SELECT mobile_number,
        CASE WHEN max(CASE WHEN body ILIKE '%STOP%' THEN stamp END) = max(stamp) THEN 'Unsubscribed'
            ELSE 'Subscribed' END AS mobile_status,
        (max((stamp, email)) FILTER (email IS NOT NULL))[2] AS email_address,
        date_trunc('second', min(stamp))::VARCHAR AS join_date,
        date_trunc('second', max(stamp))::VARCHAR AS last_message_date FROM c_messages
        WHERE mobile_number IS NOT NULL GROUP BY 1""",
    "stream_optin_webhooks": """SELECT 'c' || c_custkey || '@example.com' AS email,
        lpad(c_custkey::VARCHAR, 9, '0') AS mobile_number, CASE WHEN c_custkey % 4 = 0 THEN 'No' ELSE 'Yes' END
        AS optin_status, '2024-02-0' || CASE WHEN c_custkey % 4 = 0 THEN 2 ELSE 1 END || ' 00:00:00' AS date_last_updated
        FROM customer WHERE c_custkey % 2 = 0""",
    "rebuild_all": f"SELECT {_SUBS_COLUMNS} FROM subscribers",
}


TWINS["order_number_totals_colocated"] = TWINS["order_number_totals"]
TWINS["read_orders_json_quarantined"] = TWINS["read_orders_json"]
TWINS["split_contacts_csv_exact"] = TWINS["export_csv_chunks"]


def oracle_sql() -> dict[str, str]:
    return {name: twin(select) for name, select in TWINS.items()}
