"""SQL for the registered queries, written on the flat tables and independent of the operators."""

from __future__ import annotations

MONEY = "DECIMAL(18,2)"

POSTED = f"""
posted AS (
  SELECT *, CAST(l_extendedprice AS {MONEY}) AS amount,
    CAST(round(CAST(l_extendedprice AS {MONEY}) * CAST(l_tax AS DECIMAL(4,2)), 2) AS {MONEY}) AS tax,
    concat_ws('-', o_orderkey, l_linenumber, l_partkey, l_suppkey) AS _id,
    coalesce(l_shipdate, o_orderdate) AS ingest_ts
  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey)"""

LINES = f"""{POSTED},
sides AS (
  SELECT *,
    CASE n WHEN 1 THEN 'P' || l_partkey WHEN 2 THEN 'S' || l_suppkey ELSE 'TAX' END AS account_id,
    CAST(CASE n WHEN 1 THEN amount ELSE 0 END AS {MONEY}) AS dr,
    CAST(CASE n WHEN 2 THEN amount WHEN 3 THEN tax ELSE 0 END AS {MONEY}) AS cr
  FROM posted, (VALUES (1), (2), (3)) AS v(n)
  WHERE l_orderkey IS NOT NULL AND (n < 3 OR tax > 0)),
lines AS (
  SELECT _id, 'JE' || o_orderkey AS entry_id, CAST(o_orderdate AS DATE) AS entry_date,
    o_orderpriority AS description, CAST(n AS BIGINT) AS line_no, account_id,
    CASE WHEN l_returnflag = 'R' THEN cr ELSE dr END AS debit,
    CASE WHEN l_returnflag = 'R' THEN dr ELSE cr END AS credit, ingest_ts
  FROM sides)"""


def _latest_lines(name: str, where: str = "true", by_line: bool = False) -> str:
    keys = "entry_id, account_id" + (", _id, line_no" if by_line else "")
    extra = "line_no, " if by_line else ""
    return f"""
{name} AS (
  SELECT _id, entry_id, entry_date, description, ingest_ts, {extra}account_id, debit, credit FROM (
    SELECT *, row_number() OVER (PARTITION BY {keys}
      ORDER BY ingest_ts DESC, _id DESC, debit DESC, credit DESC) AS rn FROM lines WHERE {where})
  WHERE rn = 1)"""


ACCOUNTS = """
accounts AS (
  SELECT 'P' || p_partkey AS account_id, p_name AS name, p_type AS type FROM part
  UNION ALL SELECT 'S' || s_suppkey, s_name, 'SUPPLIER' FROM supplier)"""

RAW_ACCOUNTS = """
SELECT 'P' || p_partkey AS account_id, p_type AS type, prefix || p_name AS name, ts
FROM part, (VALUES ('old ', TIMESTAMP '1994-01-01'), ('', TIMESTAMP '1995-01-01')) AS v(prefix, ts)
UNION ALL
SELECT 'S' || s_suppkey, 'SUPPLIER', prefix || s_name, ts
FROM supplier, (VALUES ('old ', TIMESTAMP '1994-01-01'), ('', TIMESTAMP '1995-01-01')) AS v(prefix, ts)"""

TASKS = """
tasks AS (
  SELECT CAST(event_id AS VARCHAR) AS _id,
    CASE WHEN event_id % 97 <> 0 THEN 'T' || user_id END AS task_id, event_type AS name,
    'user ' || (event_id % 7) AS assigned_to,
    CASE WHEN event_type = 'purchase' THEN 'Complete' ELSE 'In Progress' END AS status,
    CASE WHEN event_id % 50 <> 0 THEN CAST(ts AS DATE) END AS due_date,
    CASE WHEN event_id % 31 <> 0 THEN ts ELSE TIMESTAMP '2024-02-01 00:00:00' END AS ingest_ts,
    event_id % 31 = 0 AS unstamped, ts AS arrived_at
  FROM events)"""


def _latest_tasks(name: str, where: str = "true") -> str:
    # backfilled rows tie on their load time; the tie falls to the document id as text
    return f"""
{name} AS (
  SELECT _id, task_id, name, assigned_to, status, due_date, ingest_ts FROM (
    SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY ingest_ts DESC, _id DESC) AS rn
    FROM tasks WHERE task_id IS NOT NULL AND {where}) WHERE rn = 1)"""


BEFORE, AFTER = "arrived_at < TIMESTAMP '2024-01-16'", "arrived_at >= TIMESTAMP '2024-01-16'"
SOLD_BEFORE, SOLD_AFTER = "ingest_ts < TIMESTAMP '1998-06-01'", "ingest_ts >= TIMESTAMP '1998-06-01'"

DOCS = f"""{POSTED},
docs AS (
  SELECT _id, 'O' || o_orderkey AS order_id, 'C' || o_custkey AS customer_id,
    CAST(o_orderdate AS DATE) AS order_date, o_orderstatus AS status, ingest_ts, amount, l_quantity,
    l_partkey, l_suppkey, l_linenumber, CAST(o_totalprice AS {MONEY}) AS total_amount
  FROM posted)"""

# the lines of a load are a function of its row, so the row's own fields break ties as its lines would
LATEST_DOCS = """
{name} AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_id
    ORDER BY ingest_ts DESC, _id DESC, CAST(l_quantity AS INT) DESC, CAST(amount AS VARCHAR) DESC) AS rn
    FROM docs WHERE {where}) WHERE rn = 1)"""

METRICS = """
{name} AS (
  SELECT order_id, customer_id, order_date, status, ingest_ts,
    CAST(sum(line_total) AS DECIMAL(18,2)) AS total_amount, count(*) AS line_count,
    count(DISTINCT product_id) AS distinct_product_count,
    array_to_string(list_sort(list(DISTINCT product_id))[1:5], ',') AS first_product_ids
  FROM (
    SELECT *, 'P' || (l_partkey + (i % 3) * l_suppkey) AS product_id,
      CASE WHEN (l_partkey + i) % 41 <> 0 THEN CAST(amount * i AS DECIMAL(18,2)) END AS line_total
    FROM (SELECT *, unnest(generate_series(1, l_linenumber)) AS i FROM {source} WHERE l_linenumber IS NOT NULL))
  GROUP BY ALL)"""


def _metrics(name: str, where: str = "true") -> str:
    return LATEST_DOCS.format(name=f"{name}_docs", where=where) + "," + METRICS.format(name=name, source=f"{name}_docs")


METRICS = METRICS.replace("GROUP BY ALL", "GROUP BY order_id, customer_id, order_date, status, ingest_ts")

CRATES = """
owner_names AS (
  SELECT *, list_value('Owner ' || (o_custkey % 89), 'Owner ' || ((o_custkey + o_orderkey) % 83),
    'Owner ' || (o_orderkey % 79), 'Owner ' || ((o_orderkey + 1) % 79))[1:(o_orderkey % 4) + 1] AS owners,
    'Ann' || c_nationkey AS first_name, 'Lee' || (o_custkey % 10) AS last_name,
    'City ' || c_nationkey AS city_name, lpad(CAST(o_custkey % 100000 AS VARCHAR), 5, '0') AS postcode,
    o_orderkey % 6 AS contact_case
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey),
crates AS (
  SELECT 'CO' || o_orderkey AS order_id, strftime(o_orderdate + INTERVAL 20 YEAR, '%d.%m.%y') AS date,
    CAST(o_orderdate + INTERVAL 20 YEAR AS DATE) AS formatted_date, 'K' || o_custkey AS company_id,
    CASE WHEN o_orderkey % 2 = 1 THEN c_name || ' Co' ELSE c_name END AS company_name,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Plastic' WHEN '2-HIGH' THEN 'Wood' ELSE 'Metal' END AS crate_type,
    CASE contact_case
      WHEN 0 THEN ''
      WHEN 1 THEN '[{"contact_name":"' || first_name || '","city":"' || city_name || '","cp":"' || postcode || '"}]'
      WHEN 2 THEN '[{"contact_name":"' || first_name || '","contact_surname":"' || last_name || '"}]'
      WHEN 3 THEN 'not json'
      WHEN 4 THEN '[{"contact_name":"' || first_name || '","contact_surname":"' || last_name || '","city":"'
        || city_name || '","cp":"' || postcode || '"},{"contact_name":"' || last_name || '","contact_surname":"'
        || first_name || '","city":"' || city_name || '","cp":"' || postcode || '"}]'
      ELSE '[{"contact_name":"' || first_name || '","contact_surname":"' || last_name || '","city":"'
        || city_name || '","cp":"' || postcode || '"}]' END AS contact_data,
    CASE WHEN o_orderkey % 3 = 0 THEN array_to_string(owners, ',') ELSE array_to_string(owners, ', ') END
      AS salesowners, owners,
    CASE WHEN contact_case NOT IN (0, 3) THEN first_name END AS contact_name,
    CASE WHEN contact_case NOT IN (0, 1, 3) THEN last_name END AS contact_surname,
    CASE WHEN contact_case NOT IN (0, 2, 3) THEN city_name END AS contact_city,
    CASE WHEN contact_case NOT IN (0, 2, 3) THEN postcode END AS contact_cp,
    CASE WHEN contact_case = 4 THEN last_name END AS second_contact_name,
    CASE WHEN contact_case = 4 THEN first_name END AS second_contact_surname,
    CASE WHEN contact_case = 4 THEN city_name END AS second_contact_city,
    CASE WHEN contact_case = 4 THEN postcode END AS second_contact_cp
  FROM owner_names)"""

CONTACTS = f"""{CRATES},
contacts AS (
  SELECT order_id, date, formatted_date, company_id, company_name, crate_type, contact_name, contact_surname,
    coalesce(contact_name || ' ' || contact_surname, 'John Doe') AS contact_full_name,
    coalesce(contact_city, 'Unknown') AS contact_city, coalesce(contact_cp, 'UNK00') AS contact_cp,
    salesowners, owners
  FROM crates)"""

SALES = f"""{CONTACTS},
sales AS (
  SELECT DISTINCT order_id, formatted_date, month(formatted_date) AS month, company_id, company_name, crate_type,
    contact_name, contact_surname, contact_full_name, contact_city, contact_cp, unnest(owners) AS salesowner
  FROM contacts)"""

LAST_YEAR = "formatted_date >= DATE '2020-08-01'"


def _monthly(where: str = "true") -> str:
    return f"""{SALES},
monthly AS (
  SELECT salesowner, CAST(date_trunc('month', formatted_date) AS DATE) AS sales_month, count(order_id) AS total_sales
  FROM sales WHERE crate_type = 'Plastic' AND {where} GROUP BY 1, 2),
rolling AS (
  SELECT a.salesowner, a.sales_month, a.total_sales, CAST(sum(b.total_sales) AS BIGINT) AS rolling_sales
  FROM monthly a JOIN monthly b ON a.salesowner = b.salesowner
    AND b.sales_month BETWEEN a.sales_month - INTERVAL 2 MONTH AND a.sales_month
  GROUP BY 1, 2, 3)"""


INVOICES = f"""
cents AS (SELECT *, CAST(CAST(o_totalprice AS {MONEY}) * 100 AS BIGINT) AS c FROM orders),
invoices AS (
  SELECT 'I' || o_orderkey || '-1' AS invoice_id, 'CO' || o_orderkey AS order_id, 'K' || o_custkey AS company_id,
    c AS gross_value, CAST(CASE WHEN o_orderstatus = 'F' THEN 19 ELSE 0 END AS BIGINT) AS vat FROM cents
  UNION ALL
  SELECT 'I' || o_orderkey || '-2', 'CO' || o_orderkey, 'K' || o_custkey, c % 100000,
    CAST(CASE WHEN o_orderstatus = 'F' THEN 19 ELSE 0 END AS BIGINT) FROM cents WHERE o_orderkey % 3 = 0)"""


def _share(i: int, rate: str) -> str:
    return f"""CAST(CASE WHEN len(owners) >= {i}
      THEN round(gross_value * CAST({rate} AS DECIMAL(7,6)), 2) ELSE 0 END AS {MONEY})"""


COMMISSIONS = f"""{CRATES},{INVOICES},
commissions AS (
  SELECT crates.order_id, crates.company_id, company_name, owners[1] AS primary_owner, owners[2] AS co_owner_1,
    owners[3] AS co_owner_2, invoice_id, gross_value, vat, {_share(1, '0.0006')} AS primary_commission_euro,
    {_share(2, '0.00025')} AS co_owner_1_commission_euro, {_share(3, '0.000095')} AS co_owner_2_commission_euro
  FROM crates JOIN invoices ON crates.order_id = invoices.order_id)"""

# by part: 1 no JSON, 2 no date, 3 text for lines, 4 a fraction of a second
EXTENDED = """
SELECT CASE WHEN l_partkey % 40 <> 1 THEN concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) END AS _id, {columns}
FROM lineitem"""
EXTENDED_AT = """CASE WHEN l_partkey % 40 = 4 THEN l_shipdate + INTERVAL 678 MILLISECOND
  WHEN l_partkey % 40 NOT IN (1, 2) THEN l_shipdate END"""
EXTENDED_TOTAL = f"CASE WHEN l_partkey % 40 <> 1 THEN CAST(l_extendedprice AS {MONEY}) END"
EXTENDED_LINES = (
    "CASE WHEN l_partkey % 40 NOT IN (1, 3) THEN "
    "(SELECT string_agg('P' || (l_partkey + i) || ':' || (CAST(l_quantity AS INT) + i), ',' ORDER BY i) "
    "FROM generate_series(1, l_linenumber) AS g(i)) END AS lines"
)

FLAT = f"""
flat AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS _id, 'F' || l_orderkey AS order_id,
    'buyer' || l_suppkey || '@mail.test' AS customer_email, 'P' || l_partkey AS product,
    CASE WHEN l_linenumber = 7 THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS quantity,
    CASE WHEN l_linenumber <> 6 THEN CAST(l_extendedprice AS {MONEY}) END AS price, l_shipdate AS order_date,
    l_linestatus AS status, 'City ' || l_suppkey AS shipping_city, l_returnflag AS shipping_state,
    'DRIVE-' || l_linenumber AS campaign_id, l_linenumber
  FROM lineitem)"""

TEXT_LINES = f"""
text_lines AS (
  SELECT 'O' || l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS line_no,
    CASE WHEN l_linenumber <> 7 THEN CAST(l_quantity AS BIGINT) END AS quantity,
    CASE WHEN l_partkey % 50 <> 0 THEN CAST(l_shipdate AS DATE) END AS shipped_on, CAST(NULL AS VARCHAR) AS note,
    'P' || l_partkey AS product_id,
    CASE WHEN l_suppkey % 30 <> 0 THEN CAST(l_extendedprice AS {MONEY}) END AS line_total,
    concat_ws(',', CASE WHEN l_linenumber = 7 THEN 'quantity' END, CASE WHEN l_partkey % 50 = 0 THEN 'shipped_on' END,
      CASE WHEN l_suppkey % 30 = 0 THEN 'lines' END) AS problems
  FROM lineitem)"""

FEED = f"""
feed AS (
  SELECT user_id, event_id AS seq, CASE WHEN event_type = 'error' THEN 'delete' ELSE 'upsert' END AS op,
    event_type AS last_event, CAST(value AS {MONEY}) AS last_value, ts AS changed_at FROM events)"""
LAST_CHANGES = f"""
WITH {FEED}
SELECT user_id, seq, last_event, last_value, changed_at FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seq DESC) AS rn FROM feed)
WHERE rn = 1 AND op <> 'delete'"""

LISTING = f"""
listing AS (
  SELECT 'data/day=' || CAST(ts AS DATE) || '/' || event_id || '.parquet' AS path, CAST(ts AS DATE) AS day,
    CAST(CAST(value AS {MONEY}) * 1000000 AS BIGINT) AS bytes, ts AS modified_at, event_type FROM events)"""

_TASK_COLUMNS = "_id, task_id, name, assigned_to, status, due_date, ingest_ts"
_MERGED_TASKS = f"""
SELECT * FROM new_tasks UNION ALL SELECT * FROM old_tasks WHERE task_id NOT IN (SELECT task_id FROM new_tasks)"""
_MERGED_LINES = """
SELECT * FROM new_lines UNION ALL
SELECT * FROM old_lines o WHERE NOT EXISTS (
  SELECT 1 FROM new_lines n WHERE n.entry_id = o.entry_id AND n.account_id = o.account_id)"""
_PROFILE = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS row_count, round(avg({c}), 4) AS mean,
  round(stddev_samp({c}), 4) AS stddev, min({c}) AS min, max({c}) AS max FROM lineitem"""
    for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
)
_PROFILE_TEXT = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS row_count, {mean} AS mean, {stddev} AS stddev,
  CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max FROM orders"""
    for c, mean, stddev in (
        ("o_orderkey", "round(avg(o_orderkey), 4)", "round(stddev_samp(o_orderkey), 4)"),
        ("o_orderstatus", "CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)"),
        ("o_orderdate", "CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)"),
    )
)
_COUNTED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _merged_orders(old: str, new: str) -> str:
    """Newer wins: of the two candidates per order the later, the stored one on a tie."""
    columns = (
        "order_id, customer_id, order_date, status, ingest_ts, total_amount, line_count, distinct_product_count, "
        "first_product_ids, ingest_ts AS last_update_ts"
    )
    return f"""
WITH {DOCS},{_metrics("target", old)},{_metrics("source", new)}
SELECT {columns} FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY ingest_ts DESC, side) AS place FROM (
    SELECT *, 1 AS side FROM target UNION ALL SELECT *, 2 FROM source))
WHERE place = 1"""


_CRC = """list_reduce(list_prepend(4294967295, list_transform(string_split(account_id, ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda h, b: list_reduce(list_prepend(xor(h, b), range(8)), lambda c, k: xor(c >> 1, 3988292384 * (c & 1))))"""
RENAMED = f"""
renamed AS (
  SELECT account_id, prefix || name AS name, type, TIMESTAMP '1995-01-01' + to_days(n) AS ts
  FROM accounts, (VALUES ('', 0), ('', 900), ('new ', 1500), ('', 2000)) AS v(prefix, n)
  WHERE n = 0 OR xor({_CRC}, 4294967295) % 4 > 0),
versions AS (
  SELECT account_id, name, type, ts AS valid_from, lead(ts) OVER (PARTITION BY account_id ORDER BY ts) AS valid_to
  FROM (SELECT *, lag(name) OVER (PARTITION BY account_id ORDER BY ts) AS before FROM renamed) WHERE before IS DISTINCT FROM name)"""

ENTRY_SUMMARY = f"""
WITH {LINES}
SELECT p._id, 'JE' || p.o_orderkey AS entry_id, strftime(p.o_orderdate, '%Y-%m-%d') AS date,
  p.o_orderpriority AS description,
  CAST(CASE WHEN p.l_orderkey IS NULL THEN CASE WHEN p.o_orderkey % 2 = 1 THEN 0 ELSE NULL END
    WHEN p.tax > 0 THEN 3 ELSE 2 END AS BIGINT) AS line_count,
  CAST(CASE WHEN p.l_orderkey IS NULL THEN CASE WHEN p.o_orderkey % 2 = 1 THEN 0 ELSE NULL END
    WHEN p.l_returnflag = 'R' THEN p.amount + p.tax ELSE p.amount END AS {MONEY}) AS total_debit
FROM posted p"""

ORACLES: dict[str, str] = {
    # sources
    "read_dump_range": """
SELECT c_custkey, c_name, c_mktsegment, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal FROM customer WHERE c_custkey >= 100 AND c_custkey < 900""",
    "scan_json_docs": ENTRY_SUMMARY,
    "scan_json_array": ENTRY_SUMMARY,
    "scan_json_inferred": f"WITH {INVOICES} SELECT * FROM invoices",
    "invoices_flatten": f"WITH {INVOICES} SELECT * FROM invoices",
    "scan_csv_orders": f"""
WITH {CRATES}
SELECT order_id, date, company_id, company_name, crate_type, nullif(contact_data, '') AS contact_data, salesowners
FROM crates""",
    "read_collection": "SELECT c_custkey, c_name, c_mktsegment FROM customer",
    "incremental_since_mark": """
SELECT event_id, ts, user_id, event_type FROM events
WHERE event_id > (SELECT max(event_id) FROM events WHERE ts < TIMESTAMP '2024-01-16')""",
    "point_lookup": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey = 7 LIMIT 1",
    "row_counts": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _COUNTED),
    # document normalisation
    "normalize_documents": EXTENDED.format(
        columns=f"{EXTENDED_AT} AS shipped_at, {EXTENDED_TOTAL} AS total, {EXTENDED_LINES}"
    ),
    "normalize_documents_str": EXTENDED.format(
        columns="CASE l_partkey % 40 WHEN 1 THEN NULL "
        "WHEN 2 THEN CASE WHEN l_linenumber % 4 = 3 THEN '{\"$date\":{\"$numberLong\":\"not a date\"}}' ELSE 'not a date' END "
        "WHEN 4 THEN strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') || '.678' "
        "ELSE strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') END AS shipped_at, "
        f"CAST({EXTENDED_TOTAL} AS VARCHAR) AS total, {EXTENDED_LINES}"
    ),
    "raw_ingest": EXTENDED.format(
        columns=f"{EXTENDED_AT} AS shipped_at, {EXTENDED_TOTAL} AS total, "
        "CAST(l_linenumber AS BIGINT) AS line_count, TIMESTAMP '2024-02-01 00:00:00' AS ingest_ts"
    )
    + " WHERE l_partkey % 40 NOT IN (1, 2, 3)",
    "ingest_rejects": EXTENDED.format(
        columns=f"{EXTENDED_AT} AS shipped_at, {EXTENDED_TOTAL} AS total, "
        "CASE WHEN l_partkey % 40 = 2 THEN CAST(l_linenumber AS BIGINT) END AS line_count, "
        "CASE WHEN l_partkey % 40 = 2 THEN 'shipped_at' ELSE '_document' END AS problems, "
        "CASE WHEN l_partkey % 40 = 1 THEN 'not json ' || concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) END "
        "AS source_text, l_partkey % 40 = 2 AS source_has_date"
    )
    + " WHERE l_partkey % 40 IN (1, 2, 3)",
    "conform_good": f"""
WITH {TEXT_LINES} SELECT order_id, line_no, quantity, shipped_on, note, product_id, line_total
FROM text_lines WHERE problems = ''""",
    "conform_rejects": f"WITH {TEXT_LINES} SELECT * FROM text_lines WHERE problems <> ''",
    "schema_drift": """
SELECT y AS load_year, path, declared, observed, drift
FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS y FROM orders WHERE o_orderkey % 50 <> 49), (VALUES
  ('lines[].line_total', 'string', NULL, 'missing', 0), ('lines[].rebate', NULL, 'bigint', 'new', 1997),
  ('lines[].quantity', 'int', NULL, 'missing', 1998), ('origin', NULL, 'object', 'new', 1999),
  ('customer_id', 'string', NULL, 'missing', 2000), ('status', 'string', 'mixed', 'retyped', 2000),
  ('total_amount', 'string', 'boolean', 'retyped', 2001)) AS v(path, declared, observed, drift, since)
WHERE y >= since""",
    "observed_documents": """
SELECT CAST(year(o_orderdate) AS INT) AS load_year, count(*) AS documents, count(*) FILTER (WHERE o_orderkey % 50 = 49) AS unreadable,
  year(o_orderdate) >= 1999 AS has_origin FROM orders GROUP BY ALL""",
    "nested_to_json": """
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS _id,
  '{"street":"' || l_linenumber || ' Quay","city":"City ' || l_suppkey || '","state":"' || l_returnflag || '"}'
    AS shipping_address,
  '{"source":"kiosk","campaign_id":"DRIVE-' || l_linenumber || '"}' AS metadata
FROM lineitem""",
    "raw_with_ingest_ts": f"""
SELECT account_id, type, name, TIMESTAMP '2024-02-01 00:00:00' AS ingest_ts FROM ({RAW_ACCOUNTS})""",
    "backfill_ingest_ts": f"WITH {TASKS} SELECT _id, task_id, ingest_ts FROM tasks",
    "quality_filter": f"WITH {FLAT} SELECT _id, order_id, quantity, price FROM flat WHERE quantity > 0 AND price > 0",
    "quality_rejects": f"""
WITH {FLAT} SELECT _id, order_id, quantity, price FROM flat WHERE l_linenumber IN (6, 7) OR quantity <= 0 OR price <= 0""",
    "json_extract": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "quote_repair": f"WITH {CRATES} SELECT order_id, contact_data FROM crates",
    # ledger
    "journal_lines": f"""
WITH {LINES}
SELECT _id, entry_id, entry_date, description, account_id, debit, credit, ingest_ts FROM lines""",
    "journal_lines_outer": f"""
WITH {LINES}
SELECT _id, entry_id, entry_date, description, line_no, account_id, debit, credit, ingest_ts FROM lines
UNION ALL
SELECT _id, 'JE' || o_orderkey, CAST(o_orderdate AS DATE), o_orderpriority, NULL, NULL, NULL, NULL, ingest_ts
FROM posted WHERE l_orderkey IS NULL""",
    "latest_close_tasks": f"WITH {TASKS},{_latest_tasks('latest')} SELECT * FROM latest",
    "journal_enriched": f"""
WITH {LINES},{ACCOUNTS}
SELECT _id, entry_id, entry_date, description, account_id, debit, credit, ingest_ts,
  name AS account_name, type AS account_type
FROM lines LEFT JOIN accounts USING (account_id)""",
    "journal_silver": f"""
WITH {LINES},{_latest_lines('latest')},{ACCOUNTS}
SELECT latest.*, name AS account_name, type AS account_type FROM latest LEFT JOIN accounts USING (account_id)""",
    "journal_silver_by_line": f"""
WITH {LINES},{_latest_lines('latest', by_line=True)},{ACCOUNTS}
SELECT latest.*, name AS account_name, type AS account_type FROM latest LEFT JOIN accounts USING (account_id)""",
    "journal_gold": f"""
WITH {LINES},{_latest_lines('latest')}
SELECT entry_id, entry_date, CAST(sum(credit) AS {MONEY}) AS total_credit, CAST(sum(debit) AS {MONEY}) AS total_debit
FROM latest GROUP BY entry_id, entry_date""",
    "journal_gold_by_line": f"""
WITH {LINES},{_latest_lines('latest', by_line=True)}
SELECT entry_id, entry_date, CAST(sum(credit) AS {MONEY}) AS total_credit, CAST(sum(debit) AS {MONEY}) AS total_debit
FROM latest GROUP BY entry_id, entry_date""",
    "account_versions": f"WITH {ACCOUNTS},{RENAMED} SELECT * FROM versions",
    "journal_as_loaded": f"""
WITH {LINES},{_latest_lines('latest')},{ACCOUNTS},{RENAMED}
SELECT latest.*, name AS account_name, type AS account_type FROM latest LEFT JOIN versions v
  ON v.account_id = latest.account_id AND ingest_ts >= valid_from AND (valid_to IS NULL OR ingest_ts < valid_to)""",
    "journal_gold_revised": f"""
WITH {LINES},{_latest_lines('latest', by_line=True)}
SELECT entry_id, entry_date, CAST(sum(credit) AS {MONEY}) AS total_credit, CAST(sum(debit) AS {MONEY}) AS total_debit
FROM latest GROUP BY entry_id, entry_date""",
    "load_counts": """
SELECT CASE WHEN first THEN 'one' ELSE 'two' END AS load_id, 'extended_orders' AS collection, count(*) AS documents,
  count(*) FILTER (WHERE ok) AS "rows", count(*) FILTER (WHERE NOT ok) AS rejects,
  count(*) FILTER (WHERE ok) AS rows_found, count(*) FILTER (WHERE NOT ok) AS rejects_found
FROM (SELECT l_partkey % 40 NOT IN (1, 2, 3) AS ok,
  concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) LIKE '%-1-%' AS first FROM lineitem) GROUP BY first""",
    "journal_entry_detail": f"""
WITH {LINES},{ACCOUNTS}
SELECT _id, entry_id, entry_date, description, account_id, debit, credit,
  name AS account_name, type AS account_type
FROM lines JOIN accounts USING (account_id)""",
    "entry_account_totals": f"""
WITH {LINES},
once AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY _id, entry_id, account_id
    ORDER BY debit DESC, credit DESC) AS rn FROM lines WHERE account_id <> 'TAX') WHERE rn = 1)
SELECT entry_id, account_id, CAST(sum(debit) AS {MONEY}) AS total_debit, CAST(sum(credit) AS {MONEY}) AS total_credit
FROM once GROUP BY entry_id, account_id""",
    "dim_account": f"WITH {ACCOUNTS} SELECT md5(account_id) AS account_key, account_id, name, type FROM accounts",
    "fact_journal_line": f"""
WITH {LINES},{_latest_lines('latest')}
SELECT md5(entry_id || '|' || account_id) AS line_key, md5(account_id) AS account_key, entry_id, entry_date, debit,
  credit FROM latest""",
    "upsert_close_tasks": f"""
WITH {TASKS},{_latest_tasks('old_tasks', BEFORE)},{_latest_tasks('new_tasks', AFTER)} {_MERGED_TASKS}""",
    "upsert_journal": f"""
WITH {LINES},{_latest_lines('old_lines', SOLD_BEFORE)},{_latest_lines('new_lines', SOLD_AFTER)} {_MERGED_LINES}""",
    "upsert_pruned": f"""
WITH {LINES},{_latest_lines('old_lines', SOLD_BEFORE)},{_latest_lines('new_lines', SOLD_AFTER)} {_MERGED_LINES}""",
    "upsert_idempotent": f"""
WITH {LINES},{_latest_lines('old_lines', SOLD_BEFORE)},{_latest_lines('new_lines', SOLD_AFTER)} {_MERGED_LINES}""",
    "journal_gold_deltas": f"""
WITH {LINES},{_latest_lines('latest')}
SELECT entry_id, entry_date, CAST(sum(credit) AS {MONEY}) AS total_credit, CAST(sum(debit) AS {MONEY}) AS total_debit, count(*) AS line_count
FROM latest GROUP BY entry_id, entry_date""",
    "journal_gold_refresh": f"""
WITH {LINES},{_latest_lines('latest')}
SELECT entry_id, entry_date, CAST(sum(credit) AS {MONEY}) AS total_credit, CAST(sum(debit) AS {MONEY}) AS total_debit
FROM latest GROUP BY entry_id, entry_date""",
    "dedup_subset": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_shipdate DESC) AS rn FROM lineitem)
WHERE rn = 1""",
    "state_as_of": f"""
WITH {TASKS}
SELECT _id, task_id, name, assigned_to, status, CASE WHEN due_date IS NULL THEN 'n/a'
    ELSE strftime(due_date, '%Y-%m-%d') END AS due_date, arrived_at FROM (
  SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY arrived_at DESC, _id DESC) AS rn FROM tasks
  WHERE task_id IS NOT NULL AND arrived_at <= TIMESTAMP '2024-01-10 12:00:00')
WHERE rn = 1""",
    "raw_append_union": f"""
WITH {TASKS}
SELECT _id, task_id, CASE WHEN due_date IS NULL THEN 'n/a' ELSE strftime(due_date, '%Y-%m-%d') END AS due_date,
  CAST(arrived_at AS DATE) AS ingest_date FROM tasks""",
    # commerce
    "latest_orders": f"""
WITH {DOCS},{LATEST_DOCS.format(name='latest', where='true')}
SELECT _id, order_id, customer_id, order_date, status, CAST(l_linenumber AS BIGINT) AS line_count, ingest_ts
FROM latest""",
    "order_metrics": f"WITH {DOCS},{_metrics('m')} SELECT * FROM m",
    "orders_silver": _merged_orders(SOLD_BEFORE, SOLD_AFTER),
    "upsert_newer_wins": _merged_orders(SOLD_AFTER, "ingest_ts < TIMESTAMP '1999-01-01'"),
    "orders_analytics": f"""
WITH {FLAT}
SELECT _id, order_id, customer_email, product, quantity, price, order_date, status, shipping_city, shipping_state,
  campaign_id, CAST(quantity * price AS {MONEY}) AS total_amount, year(order_date) AS order_year,
  month(order_date) AS order_month, day(order_date) AS order_day
FROM flat WHERE quantity > 0 AND price > 0""",
    "partition_layout": f"""
SELECT year(o_orderdate) AS order_year, month(o_orderdate) AS order_month, count(*) AS order_count,
  CAST(sum(CAST(o_totalprice AS {MONEY})) AS {MONEY}) AS total FROM orders GROUP BY 1, 2""",
    "product_count_distinct": f"""
WITH {POSTED}
SELECT o_orderstatus AS status, count(DISTINCT 'P' || (l_partkey + (i % 3) * l_suppkey)) AS product_count
FROM (SELECT *, unnest(generate_series(1, l_linenumber)) AS i FROM posted WHERE l_linenumber IS NOT NULL) GROUP BY 1""",
    "users_in_spans": """
SELECT e.event_type, d.day, count(DISTINCT e.user_id) AS users FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events) d
JOIN events e ON CAST(e.ts AS DATE) BETWEEN d.day - 6 AND d.day GROUP BY ALL""",
    "users_estimated": """
SELECT d.day, count(DISTINCT e.user_id) AS users, true AS is_close FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events) d
JOIN events e ON CAST(e.ts AS DATE) BETWEEN d.day - 6 AND d.day GROUP BY ALL""",
    "profile_numeric": _PROFILE,
    "profile_columns": _PROFILE_TEXT,
    # crate sales
    "contact_fields": f"""
WITH {CRATES}
SELECT order_id, contact_name, contact_surname, contact_city, contact_cp, second_contact_name,
  second_contact_surname, second_contact_city, second_contact_cp FROM crates""",
    "contact_rows": f"""
WITH {CRATES}
SELECT order_id, contact_name, contact_surname, contact_city AS city, contact_cp AS cp FROM crates
UNION ALL
SELECT order_id, second_contact_name, second_contact_surname, second_contact_city, second_contact_cp FROM crates
WHERE second_contact_name IS NOT NULL""",
    "order_contacts": f"""
WITH {CONTACTS}
SELECT order_id, date, company_id, company_name, crate_type, contact_name, contact_surname, contact_full_name,
  contact_city, contact_cp, salesowners FROM contacts""",
    "order_contact_names": f"WITH {CONTACTS} SELECT order_id, contact_full_name FROM contacts GROUP BY 1, 2",
    "order_contact_address": f"WITH {CONTACTS} SELECT order_id, contact_city || ',' || contact_cp AS contact_address FROM contacts",
    "canonical_company": f"WITH {CRATES} SELECT company_id, min(company_name) AS company_name FROM crates GROUP BY 1",
    "company_salesowners": f"""
WITH {SALES}, names AS (SELECT company_id, min(company_name) AS company_name FROM sales GROUP BY 1)
SELECT DISTINCT company_id, names.company_name, salesowner FROM sales JOIN names USING (company_id)""",
    "company_salesowner_list": f"""
WITH {SALES}
SELECT company_id, min(company_name) AS company_name,
  array_to_string(list_sort(list(DISTINCT salesowner)), ', ') AS list_salesowners
FROM sales GROUP BY company_id""",
    "company_crate_distribution": f"""
WITH {CRATES}, names AS (SELECT company_id, min(company_name) AS company_name FROM crates GROUP BY 1)
SELECT company_id, names.company_name, crate_type, count(order_id) AS crate_type_distribution
FROM crates JOIN names USING (company_id) GROUP BY 1, 2, 3""",
    "crate_order_distribution": f"WITH {CRATES} SELECT crate_type, count(order_id) AS order_count FROM crates GROUP BY 1",
    "order_sales_owners": f"WITH {SALES} SELECT * FROM sales",
    "owner_roles": f"""
WITH {CRATES}
SELECT order_id, company_id, company_name, owners[1] AS primary_owner, owners[2] AS co_owner_1,
  owners[3] AS co_owner_2 FROM crates""",
    "commission_lines": f"WITH {COMMISSIONS} SELECT * FROM commissions",
    "salesowner_commission": f"""
WITH {COMMISSIONS}
SELECT sales_owner, CAST(sum(commission) AS {MONEY}) AS total_commission FROM (
  SELECT primary_owner AS sales_owner, primary_commission_euro AS commission FROM commissions
  UNION ALL SELECT co_owner_1, co_owner_1_commission_euro FROM commissions
  UNION ALL SELECT co_owner_2, co_owner_2_commission_euro FROM commissions)
WHERE sales_owner IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1""",
    "training_last_12m": f"""
WITH {SALES} SELECT salesowner, crate_type, count(order_id) AS order_count FROM sales WHERE {LAST_YEAR} GROUP BY 1, 2""",
    "rolling_3m_sales": f"WITH {_monthly()} SELECT * FROM rolling",
    "top_sellers_by_month": f"""
WITH {_monthly(LAST_YEAR)}
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY sales_month ORDER BY rolling_sales DESC, total_sales DESC, salesowner)
    AS place FROM rolling) WHERE place <= 5""",
    "top_k_sellers": f"""
WITH {_monthly(LAST_YEAR)}
SELECT salesowner, sales_month, total_sales FROM monthly ORDER BY total_sales DESC, sales_month, salesowner LIMIT 5""",
    # history, retention, tables
    "snapshots_to_expire": """
SELECT table_name, table_class, snapshot_id, committed_at FROM (
  SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY committed_at DESC, snapshot_id DESC) AS place FROM (
    SELECT 'table_' || user_id AS table_name, event_id AS snapshot_id, ts AS committed_at,
      CASE user_id % 3 WHEN 0 THEN 'raw' WHEN 1 THEN 'silver' ELSE 'gold' END AS table_class FROM events))
WHERE place > CASE table_class WHEN 'gold' THEN 5 ELSE 3 END
  AND committed_at < TIMESTAMP '2024-04-15 00:00:00'
    - CASE table_class WHEN 'gold' THEN INTERVAL 90 DAY ELSE INTERVAL 30 DAY END""",
    "orphan_files": f"""
WITH {LISTING}
SELECT path, bytes, modified_at FROM listing
WHERE event_type <> 'click' AND modified_at < TIMESTAMP '2024-01-25 00:00:00'""",
    "compaction_plan": f"""
WITH {LISTING}, sized AS (
  SELECT day, count(*) AS file_count, CAST(sum(bytes) AS BIGINT) AS total_bytes FROM listing GROUP BY day)
SELECT *, greatest(1, CAST(ceil(total_bytes / 536870912.0) AS BIGINT)) AS target_files,
  file_count > greatest(1, CAST(ceil(total_bytes / 536870912.0) AS BIGINT)) AS rewrite FROM sized""",
    "table_merge": f"""
WITH {TASKS},{_latest_tasks('old_tasks', BEFORE)},{_latest_tasks('new_tasks', AFTER)}, merged AS ({_MERGED_TASKS})
SELECT *, CAST(date_trunc('week', due_date) AS DATE) AS due_month FROM merged""",
    "table_time_travel": f"WITH {TASKS},{_latest_tasks('old_tasks', BEFORE)} SELECT * FROM old_tasks",
    "table_reload": f"SELECT account_id, type, name, ts AS ingest_ts FROM ({RAW_ACCOUNTS})",
    # change feeds
    "cdc_apply": LAST_CHANGES,
    "stream_cdc_state": LAST_CHANGES,
    "stream_raw_log": f"WITH {FEED} SELECT *, CAST(changed_at AS DATE) AS change_date FROM feed",
    "stream_late_changes": f"""
WITH {FEED} SELECT *, seq % 3 = 0 AND coalesce(seq < max(seq) FILTER (WHERE seq % 3 <> 0) OVER (PARTITION BY user_id), false) AS late FROM feed""",
    "stream_dedup": f"WITH {FEED} SELECT user_id, seq, op, last_event, last_value FROM feed",
}
ORACLES["catalog_upsert"] = ORACLES["upsert_journal"]
ORACLES["bucketed_upsert"] = ORACLES["upsert_journal"]
