"""The SQL each query must agree with, over the same tables."""

from __future__ import annotations

from salesmill.schema import REPORTS, SALES_COLUMNS, SALES_SCHEMA, STAGED_COLUMNS, Report

COMPANY = "BUILDING"

SALES = """
sales AS (
  SELECT c_mktsegment AS company_name,
         concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS invoice_id,
         r_name AS branch_code, n_name AS city, o_orderstatus AS customer_type,
         l_linestatus AS gender, p_type AS product_line,
         CAST(p_retailprice AS DECIMAL(9,2)) AS unit_price,
         CAST(l_quantity AS INT) AS quantity,
         CAST(l_tax AS DECIMAL(12,2)) AS tax,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS total,
         CAST(l_shipdate AS DATE) AS sales_date,
         l_returnflag AS sales_time, o_orderpriority AS payment,
         CAST(p_retailprice AS DECIMAL(9,2)) AS cogs,
         CAST(l_discount AS DECIMAL(12,2)) AS gross_margin_percentage,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS gross_income,
         CAST(p_size AS DECIMAL(9,2)) AS rating
  FROM lineitem
  JOIN orders   ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN part     ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation   ON s_nationkey = n_nationkey
  JOIN region   ON n_regionkey = r_regionkey
)"""

# Text of a drop file, and the types of the stored history.
TEXT = {
    c: "strftime(sales_date, '%-m/%-d/%Y')" if c == "sales_date" else f"CAST({c} AS VARCHAR)"
    for c in STAGED_COLUMNS
}
TYPES = {f.name: f.dataType.simpleString() for f in SALES_SCHEMA}
AS_TEXT = ", ".join(["company_name", *[f"{text} AS {c}" for c, text in TEXT.items()]])
AS_TYPED = ", ".join(
    f"CAST({c} AS {TYPES[c]}) AS {c}" if TYPES[c].startswith("decimal") else c
    for c in SALES_COLUMNS
)
EARLIER = "quantity < 10"
IN_HISTORY = f"""EXISTS (SELECT 1 FROM sales h WHERE h.{EARLIER}
  AND h.company_name = s.company_name AND h.invoice_id = s.invoice_id)"""


def over_sales(body: str) -> str:
    return f"WITH {SALES} {body}"


def _sum(value: str, name: str) -> str:
    return f"CAST(SUM({value}) AS DECIMAL(22,2)) AS {name}"


def _average(value: str, name: str) -> str:
    total = f"CAST(CAST(SUM({value}) AS DECIMAL(22,2)) AS DOUBLE)"
    return f"{total} / NULLIF(COUNT({value}), 0) AS {name}"


OWN = f"CASE WHEN company_name = '{COMPANY}' THEN total END"
MEASURES = ", ".join(
    [
        _sum(OWN, "company_tot_sales"),
        _sum("total", "total_industry_sales"),
        _average(OWN, "company_avg_sales"),
        _average("total", "average_industry_sales"),
    ]
)


def company_sql(*keys: str) -> str:
    columns = ", ".join(keys)
    return over_sales(
        f"SELECT {columns}, {_sum('total', 'total_sales')} FROM sales"
        f" WHERE company_name = '{COMPANY}' GROUP BY {columns}"
    )


def industry_sql(*keys: str) -> str:
    if not keys:
        return over_sales(f"SELECT {MEASURES} FROM sales")
    columns = ", ".join(keys)
    return over_sales(f"SELECT {columns}, {MEASURES} FROM sales GROUP BY {columns}")


def _money(value: str, decimals: int) -> str:
    return f"CAST(CAST({value} AS DECIMAL(22,{decimals})) AS VARCHAR)"


def _rounded(total: str, count: str) -> str:
    """Average in whole hundred-thousandths, halves up, as text with 5 decimals."""
    units = f"CAST(CAST({total} AS DECIMAL(22,2)) * 100 AS HUGEINT) * 1000"
    scaled = f"(({units}) * 2 + {count}) // (2 * {count})"
    return f"CAST(({scaled}) // 100000 AS VARCHAR) || '.' || lpad(CAST(({scaled}) % 100000 AS VARCHAR), 5, '0')"


def _lines(report: Report, decimals: int) -> str:
    """The lines of one report for every company."""
    name = f"'{report.file_name}000' AS file_name"
    header = f"SELECT company_name, {name}, '{'|'.join(report.columns)}' AS line FROM companies"
    keys = list(report.keys)
    if not report.industry:
        header = header.replace("|", ",")
        line = " || ',' || ".join([*keys, _money("SUM(total)", decimals)])
        return (
            f"{header} UNION ALL SELECT company_name, {name}, {line} FROM sales"
            f" GROUP BY {', '.join(['company_name', *keys])}"
        )
    group = f"GROUP BY {', '.join(keys)}" if keys else ""
    select = "".join(f"{k}, " for k in keys)
    industry = f"SELECT {select} SUM(total) AS t, COUNT(total) AS n FROM sales {group}"
    own = (
        f"SELECT company_name, {select} SUM(total) AS t, COUNT(total) AS n FROM sales"
        f" GROUP BY {', '.join(['company_name', *keys])}"
    )
    match = " AND ".join(["o.company_name = c.company_name", *[f"o.{k} = i.{k}" for k in keys]])
    fields = [
        *[f"i.{k}" for k in keys],
        f"coalesce({_money('o.t', decimals)}, '')",
        _money("i.t", decimals),
        f"coalesce({_rounded('o.t', 'o.n')}, '')",
        _rounded("i.t", "i.n"),
    ]
    return (
        f"{header} UNION ALL SELECT c.company_name, {name}, {' || chr(124) || '.join(fields)}"
        f" FROM ({industry}) i JOIN companies c ON true LEFT JOIN ({own}) o ON {match}"
    )


def lines_sql(reports: list[Report], company: str | None = None, decimals: int = 2) -> str:
    only = "" if company is None else f" WHERE company_name = '{company}'"
    parts = " UNION ALL ".join(f"({_lines(r, decimals)})" for r in reports)
    return (
        f"WITH {SALES}, companies AS (SELECT DISTINCT c_mktsegment AS company_name FROM customer)"
        f" SELECT * FROM ({parts}){only}"
    )


def _report(name: str) -> list[Report]:
    return [r for r in REPORTS if r.file_name == name]


AMOUNT = "CAST(l_extendedprice AS DECIMAL(12,2))"


def _number(decimals: int) -> str:
    kind = f"DECIMAL({7 + decimals},{decimals})"
    longer = "NULL" if decimals == 2 else f"CAST({AMOUNT} + 0.005 AS {kind})"
    return f"""CASE l_linenumber WHEN 1 THEN CAST({AMOUNT} AS {kind})
      WHEN 2 THEN CAST({AMOUNT} AS {kind}) WHEN 3 THEN CAST(-{AMOUNT} AS {kind})
      WHEN 4 THEN {longer} WHEN 5 THEN CAST(floor({AMOUNT}) AS {kind}) END"""


INGESTED = over_sales(
    f"SELECT {AS_TYPED} FROM sales WHERE {EARLIER}"
    f" UNION ALL SELECT {AS_TYPED} FROM sales s WHERE NOT {IN_HISTORY}"
)
FIRST_FILE = f"""SELECT company_name, invoice_id, quantity, total FROM (
  SELECT *, month(sales_date) AS file_no, min(month(sales_date)) OVER
  (PARTITION BY company_name, invoice_id) AS first_no FROM sales s WHERE NOT {IN_HISTORY})
  WHERE file_no = first_no"""
ALERTS = """SELECT event_type AS job,
        CASE WHEN event_id % 3 < 2 THEN {shop} END AS company,
        CASE WHEN event_id % 3 < 2 THEN 's3://sales/' || {key} END AS file,
        CASE WHEN event_id % 5 <> 0 THEN 'ValueError' END AS error_type,
        'bad value ' || CAST(value AS VARCHAR) AS error_message,
        CASE WHEN event_id % 7 <> 0 THEN 'line 1' || chr(10) || 'line '
          || CAST(user_id AS VARCHAR) END AS stack_trace,
        {arn} AS arn FROM events"""

ARN = "'arn:aws:lambda:zone:acct:function:' || event_type || ':$LATEST'"
SHOP = "'shop +' || CAST(user_id AS VARCHAR)"
KEY = f"'sales_records_in/' || {SHOP} || '/' || CAST(event_id AS VARCHAR) || ' 100%.csv'"

ORACLES = {
    "company_by_branch": company_sql("branch_code"),
    "company_by_payment": company_sql("payment"),
    "company_by_product": company_sql("product_line"),
    "company_by_product_branch": company_sql("product_line", "branch_code"),
    "company_by_product_payment": company_sql("product_line", "payment"),
    "industry_total": industry_sql(),
    "industry_by_product_city": industry_sql("product_line", "city"),
    "industry_by_product_payment": industry_sql("product_line", "payment"),
    "industry_by_product": industry_sql("product_line"),
    "industry_cube": over_sales(
        f"""SELECT product_line, city, payment,
        CAST(GROUPING(product_line, city, payment) AS INT) AS grouping_id, {MEASURES}
        FROM sales GROUP BY GROUPING SETS
        ((), (product_line, city), (product_line, payment), (product_line))"""
    ),
    "sales_summary": over_sales(
        f"""SELECT company_name, branch_code, city, product_line, payment,
        {_sum("total", "total_sales")}, COUNT(total) AS n_sales
        FROM sales GROUP BY ALL"""
    ),
    "report_order": over_sales(
        """SELECT product_line, city, CAST(row_number() OVER (
        ORDER BY SUM(total) DESC NULLS FIRST, product_line NULLS LAST, city NULLS LAST) AS INT)
        AS place FROM sales GROUP BY product_line, city"""
    ),
    "company_report_order": over_sales(
        f"""SELECT product_line, branch_code, CAST(row_number() OVER (
        ORDER BY SUM(total) DESC NULLS FIRST, product_line NULLS LAST, branch_code NULLS LAST) AS INT)
        AS place FROM sales WHERE company_name = '{COMPANY}' GROUP BY product_line, branch_code"""
    ),
    "for_company": over_sales(f"SELECT * FROM sales WHERE company_name = '{COMPANY}'"),
    "type_sales": over_sales(f"SELECT {AS_TYPED} FROM sales"),
    "parse_number": f"""SELECT l_orderkey, l_linenumber, {_number(2)} AS two_decimals,
        {_number(5)} AS five_decimals, {_number(9)} AS nine_decimals FROM lineitem""",
    "parse_int": """SELECT l_orderkey, l_linenumber,
        CASE WHEN l_linenumber > 2 THEN CAST(l_quantity AS INT) END AS quantity FROM lineitem""",
    "parse_date": """SELECT l_orderkey, l_linenumber, CASE
        WHEN l_linenumber = 2 THEN NULL
        WHEN l_linenumber <> 3 THEN CAST(l_shipdate AS DATE)
        WHEN day(l_shipdate) <= 12
          THEN make_date(year(l_shipdate), day(l_shipdate), month(l_shipdate))
        END AS sales_date FROM lineitem""",
    "validate_staged": over_sales(
        """SELECT company_name, invoice_id, branch_code, total, CASE
        WHEN invoice_id = '' THEN 'no invoice'
        WHEN strlen(invoice_id) > 6 THEN 'too wide: invoice_id'
        WHEN strlen(branch_code) > 6 THEN 'too wide: branch_code'
        WHEN strlen(total) > 7 THEN 'too wide: total' END AS _reject_reason
        FROM (SELECT company_name, CASE WHEN quantity = 7 THEN '' ELSE invoice_id END AS invoice_id,
        branch_code, CAST(total AS VARCHAR) AS total FROM sales)"""
    ),
    "split_rejects": over_sales(
        """SELECT company_name, invoice_id, sales_date, total,
        CASE WHEN max(total > 104000) OVER (PARTITION BY sales_date) THEN 'rejected'
        ELSE 'good' END AS fate FROM sales"""
    ),
    "not_in_history": over_sales(
        f"SELECT company_name, invoice_id, quantity, total FROM sales s WHERE NOT {IN_HISTORY}"
    ),
    "not_in_strict": over_sales(
        f"""SELECT company_name, invoice_id, quantity, total FROM (SELECT company_name,
        CASE WHEN quantity <> 50 THEN invoice_id END AS invoice_id, quantity, total FROM sales) s
        WHERE invoice_id NOT IN (SELECT CASE WHEN NOT (h.company_name = 'FURNITURE'
        AND h.quantity = 1) THEN h.invoice_id END FROM sales h WHERE h.{EARLIER}
        AND h.company_name <> 'HOUSEHOLD' AND h.company_name = s.company_name)"""
    ),
    "first_file_wins": over_sales(
        """SELECT company_name, invoice_id, CAST(file_no AS INT) AS file_no, total FROM (
        SELECT *, month(sales_date) AS file_no, min(month(sales_date)) OVER
        (PARTITION BY company_name, invoice_id) AS first_no FROM sales)
        WHERE file_no = first_no"""
    ),
    "large_load_not_in_history": over_sales(FIRST_FILE.replace("total FROM (", "CAST(total AS DECIMAL(12,5)) AS total FROM (")),
    "merged_history": over_sales(
        f"SELECT {AS_TYPED}, 'load-' || CAST(month(sales_date) AS VARCHAR) AS batch_id FROM sales"
    ),
    "running_totals": over_sales(
        """SELECT company_name, branch_code, city, product_line, payment,
        CAST(SUM(total) AS DECIMAL(22,5)) AS total_sales, CAST(COUNT(total) AS BIGINT) AS n_sales
        FROM sales GROUP BY ALL"""
    ),
    "append_sales": over_sales(
        f"SELECT {AS_TYPED}, 'load-1' AS batch_id FROM sales WHERE {EARLIER}"
        f" UNION ALL SELECT {AS_TYPED}, 'load-2' AS batch_id FROM sales s WHERE NOT {IN_HISTORY}"
    ),
    "sales_table": over_sales(f"SELECT {AS_TYPED} FROM sales WHERE company_name = '{COMPANY}'"),
    "read_drop": over_sales(f"SELECT {AS_TEXT}, CAST(17 AS INT) AS field_count FROM sales"),
    "ingest_stream": INGESTED,
    "archive_consumed": over_sales(f"SELECT {AS_TEXT} FROM sales"),
    "refresh_reports": lines_sql(REPORTS, decimals=5),
    "write_report_csv": lines_sql(_report("Product_Branch_Sales.csv_"), COMPANY),
    "write_report_pipe": lines_sql(_report("Ind_Product_City_Sales.csv_"), COMPANY),
    "company_of": "SELECT c_custkey, c_name || '+ & co' AS company_name FROM customer",
    "segment": """SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN event_type END AS job
        FROM events""",
    "parse_load_events": f"""SELECT event_id, 'sales' AS bucket, {KEY} AS object_key,
        {SHOP} AS company_name FROM events""",
    "parse_fanout": """SELECT event_id, 'shop "' || CAST(user_id AS VARCHAR) || '"'
        AS company_name FROM events""",
    "json_find_first": """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS VARCHAR)
        WHEN event_id % 3 <> 0 THEN event_type END AS mark FROM events""",
    "failure_alerts": ALERTS.format(shop=SHOP, key=KEY, arn=ARN),
    "alert_table": ALERTS.format(shop=SHOP, key=KEY, arn=ARN),
    "alert_text": f"""SELECT o_orderkey, concat_ws(chr(10),
        'There was an error while executing Pipeline.', '', 'Lambda: ' || o_orderpriority,
        CASE WHEN o_orderkey % 3 <> 0 THEN 'Company: ' || CAST(o_custkey AS VARCHAR) END,
        CASE WHEN o_orderkey % 3 <> 0
          THEN 'Trigger File: s3://sales/' || CAST(o_orderkey AS VARCHAR) || '.csv' END,
        CASE WHEN o_orderkey % 3 <> 0 THEN '' END,
        CASE WHEN o_orderkey % 4 <> 0 THEN 'Error Type: ValueError.' END,
        CASE WHEN o_orderkey % 5 <> 0 THEN 'Error Message: "' || o_orderstatus || '".' END,
        CASE WHEN o_orderkey % 7 <> 0
          THEN concat_ws(chr(10), 'Stack Trace: ', 'line 1', 'line 2') END,
        '', '{"-" * 56}', '{{', '  "k": ' || CAST(o_orderkey AS VARCHAR) || ',', '  "v": [',
        '    1', '  ]', '}}') AS alert_text FROM orders""",
}
