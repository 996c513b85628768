"""Text fragments shared by the comparison SQL: typed views and calendars over the source tables."""

from __future__ import annotations

ORDERS = """(SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice,
  o_orderdate, CAST(o_orderdate AS DATE) AS o_date, o_orderpriority FROM orders)"""

LINEITEM = """(SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS INTEGER) AS l_quantity,
  CAST(l_extendedprice AS DECIMAL(12,2)) AS l_extendedprice, CAST(l_discount AS DECIMAL(4,2)) AS l_discount,
  CAST(l_tax AS DECIMAL(4,2)) AS l_tax, l_returnflag, l_linestatus, l_shipdate, CAST(l_shipdate AS DATE) AS l_date,
  l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS l_row FROM lineitem)"""

PART = """(SELECT p_partkey, p_name, p_brand, p_type, p_size, CAST(p_retailprice AS DECIMAL(12,2)) AS p_retailprice FROM part)"""

CUSTOMER = """(SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal, c_mktsegment FROM customer)"""

SUPPLIER = """(SELECT s_suppkey, s_name, s_nationkey, CAST(s_acctbal AS DECIMAL(12,2)) AS s_acctbal FROM supplier)"""

EVENTS = """(SELECT event_id, ts, user_id, event_type, CAST(value AS DECIMAL(12,2)) AS value, CAST(ts AS DATE) AS e_date FROM events)"""

MONTHS = "ARRAY['January','February','March','April','May','June','July','August','September','October','November','December']"
DAYS = "ARRAY['Sunday','Monday','Tuesday','Wednesday','Thursday','Friday','Saturday']"


def draw(salt: str, modulus: int | str, *keys: str) -> str:
    text = " || ':' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"(CAST('0x' || substr(md5({text} || ':{salt}'), 1, 15) AS BIGINT) % ({modulus}))"


def key_of(d: str) -> str:
    return f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def txt(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def mean(x: str) -> str:
    return f"(CAST(sum({x}) AS DOUBLE) / count({x}))"


def share(part: str, whole: str) -> str:
    """Percentage rounded half up to two decimals, in integer arithmetic."""
    return (
        f"(CAST(((CAST({part} AS BIGINT) * 20000 + CAST({whole} AS BIGINT)) // (2 * CAST({whole} AS BIGINT))) AS DOUBLE) / 100)"
    )


def cents_div(cents: str, by: str) -> str:
    """Whole cents of a division, half up, for amounts of zero or more."""
    return f"((2 * ({cents}) + ({by})) // (2 * ({by})))"


def _between(d: str, windows) -> str:
    return " OR ".join(f"(month({d}) = {m} AND day({d}) BETWEEN {a} AND {b})" for m, a, b in windows)


# Peak seasons and sale weeks, the same as in operators/calendar.py.
PEAKS = ((12, 1, 31), (4, 15, 28), (7, 15, 31), (8, 1, 31), (9, 1, 10), (1, 8, 20), (9, 5, 20))
SALES = ((2, 5, 25), (6, 3, 23), (11, 4, 24))
CLOSED_2024 = """dayofweek(d) = 0 OR d < DATE '2024-01-04' OR d = DATE '2024-03-29' OR d = DATE '2024-04-01'
  OR d BETWEEN DATE '2024-12-25' AND DATE '2024-12-27'"""
CLOSED_EVERY_YEAR = "dayofweek(d) = 0 OR (month(d) = 12 AND day(d) BETWEEN 25 AND 27)"


def calendar(table: str, column: str, closed: str) -> str:
    return f"""(SELECT {key_of('d')} AS date_key, d AS full_date, year(d) AS year, month(d) AS month,
  {MONTHS}[month(d)] AS month_name, quarter(d) AS quarter,
  CAST((dayofyear(d) + dayofweek(date_trunc('year', d)) + 6) // 7 AS INTEGER) AS week_of_year,
  dayofweek(d) + 1 AS day_of_week, {DAYS}[dayofweek(d) + 1] AS day_name, dayofweek(d) IN (0, 6) AS is_weekend,
  NOT ({closed}) AS is_open, (day(d) >= 25 OR {_between('d', PEAKS)}) AS is_peak, ({_between('d', SALES)}) AS is_sale,
  year(d) AS fiscal_year, month(d) AS fiscal_month
  FROM (SELECT CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
        FROM (SELECT date_trunc('year', min({column})) AS a,
                     date_trunc('year', max({column})) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS b FROM {table})))"""


CAL_EVENTS = calendar("events", "ts", CLOSED_2024)
CAL_ORDERS = calendar("orders", "o_orderdate", CLOSED_EVERY_YEAR)
CAL_ITEMS = calendar("lineitem", "l_shipdate", CLOSED_EVERY_YEAR)
