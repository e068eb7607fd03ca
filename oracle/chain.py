"""CTEs from the order tables to engineered sales."""

from __future__ import annotations

NULLS = ("''", "'#N/A'", "'#N/A N/A'", "'#NA'", "'-1.#IND'", "'-1.#QNAN'", "'-NaN'", "'-nan'",
         "'1.#IND'", "'1.#QNAN'", "'<NA>'", "'N/A'", "'NA'", "'NULL'", "'NaN'", "'None'", "'n/a'",
         "'nan'", "'null'", "'ERROR'", "'UNKNOWN'", "'none'")

# What the fixture pads with.
PADDING = "' ' || chr(9) || chr(160)"

COLUMNS = ("transaction_id", "item", "quantity", "price_per_unit", "total_spent",
           "payment_method", "location", "transaction_date", "order_type", "customer_id")

RAW = """
src AS (
  SELECT l.*, p.p_type, p.p_retailprice, o.o_orderpriority, o.o_custkey, c.c_mktsegment, r.r_name,
         l.l_orderkey * 7 + l.l_linenumber * 13 + l.l_partkey * 31 + l.l_suppkey * 3 AS k,
         CAST(l.l_quantity AS BIGINT) AS qty,
         CAST(p.p_retailprice AS DECIMAL(12,2)) AS price
  FROM lineitem l
  JOIN part p ON p.p_partkey = l.l_partkey
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN nation n ON n.n_nationkey = c.c_nationkey
  JOIN region r ON r.r_regionkey = n.n_regionkey
),
once AS (
  SELECT k,
    'TXN_' || l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey
      AS transaction_id,
    CASE k % 19 WHEN 0 THEN NULL WHEN 1 THEN 'ERROR' WHEN 2 THEN ' UNKNOWN '
      WHEN 3 THEN '  ' || lower(p_type) || ' ' WHEN 4 THEN 'Gadget' ELSE p_type END AS item,
    CASE k % 29 WHEN 0 THEN NULL WHEN 1 THEN 'ERROR' WHEN 2 THEN 'abc'
      WHEN 3 THEN chr(160) || CAST(qty AS VARCHAR) || ' ' ELSE CAST(qty AS VARCHAR) END AS quantity,
    CASE k % 31 WHEN 0 THEN 'UNKNOWN' WHEN 1 THEN ''
      WHEN 2 THEN ' ' || CAST(price AS VARCHAR) || chr(9) ELSE CAST(price AS VARCHAR) END
      AS price_per_unit,
    CASE k % 17 WHEN 0 THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)
      WHEN 1 THEN 'ERROR'
      WHEN 2 THEN chr(9) || CAST(CAST(qty * price AS DECIMAL(18,2)) AS VARCHAR)
      ELSE CAST(CAST(qty * price AS DECIMAL(18,2)) AS VARCHAR) END AS total_spent,
    CASE WHEN k % 3 = 0 THEN 'UNKNOWN' ELSE o_orderpriority END AS payment_method,
    CASE WHEN k % 5 < 2 THEN NULL WHEN k % 5 = 2 THEN replace(lower(r_name), ' ', '-')
      ELSE r_name END AS location,
    CASE WHEN k % 23 = 0 THEN 'ERROR' WHEN k % 46 = 1 THEN '2023-02-30'
      WHEN k % 37 = 0 THEN ' ' || strftime(l_shipdate, '%Y-%m-%d') || chr(9)
      WHEN k % 37 = 1 THEN chr(160) || strftime(l_shipdate, '%Y-%m-%d')
      ELSE strftime(l_shipdate, '%Y-%m-%d') END AS transaction_date,
    c_mktsegment AS order_type,
    CAST(o_custkey AS VARCHAR) AS customer_id
  FROM src
),
raw AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE k % 41 = 0)"""


def _lookup(column: str, pairs: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs.items())
    return f"CASE lower(trim({column})) {whens} END"


_ITEMS = {"standard": "Standard", "promo": "Promo", "economy": "Economy", "medium": "Medium",
          "small": "Small", "large": "Large"}
_PAYMENTS = {"1-urgent": "Urgent", "2-high": "High", "3-medium": "Medium",
             "4-not specified": "Not Specified", "5-low": "Low"}
_LOCATIONS = {"africa": "Africa", "america": "America", "asia": "Asia", "europe": "Europe",
              "middle east": "Middle East", "middle-east": "Middle East"}


def vocabulary(old: bool = False):
    """column -> spelling found -> canonical value."""
    unknown = {"Large", "Low", "Middle East"} if old else set()
    return {
        column: {k: v for k, v in pairs.items() if v not in unknown}
        for column, pairs in (("item", _ITEMS), ("payment_method", _PAYMENTS),
                              ("location", _LOCATIONS))
    }


def steps(old: bool = False, price_median: str = "raw") -> list[str]:
    """CTE definitions in order; a query takes as many as it needs."""
    known = vocabulary(old)
    tokens = ", ".join(NULLS)
    text = ", ".join(
        f"CASE WHEN {c} IN ({tokens}) THEN NULL ELSE NULLIF(trim({c}, {PADDING}), '') END AS {c}"
        for c in COLUMNS)
    return [
        RAW,
        f"tok AS (SELECT {text} FROM raw)",
        """num AS (SELECT * REPLACE (TRY_CAST(quantity AS DECIMAL(12,2)) AS quantity,
             TRY_CAST(price_per_unit AS DECIMAL(18,6)) AS price_per_unit,
             TRY_CAST(total_spent AS DECIMAL(18,2)) AS total_spent,
             CAST(try_strptime(transaction_date, '%Y-%m-%d') AS DATE) AS transaction_date)
           FROM tok)""",
        "dated AS (SELECT * FROM num WHERE transaction_date IS NOT NULL)",
        "cat AS (SELECT * REPLACE ({}) FROM dated)".format(
            ", ".join(f"{_lookup(c, pairs)} AS {c}" for c, pairs in known.items())),
        """std AS (SELECT * REPLACE (
             CAST(COALESCE(ROUND(quantity * price_per_unit, 2), total_spent) AS DECIMAL(18,2))
               AS total_spent) FROM cat)""",
        """qmode AS (SELECT item, quantity FROM (
             SELECT item, quantity, row_number() OVER (PARTITION BY item
               ORDER BY count(*) DESC, quantity) AS rn
             FROM std WHERE item IS NOT NULL AND quantity IS NOT NULL GROUP BY item, quantity)
           WHERE rn = 1)""",
        """pmean AS (SELECT item,
             CAST(CAST(SUM(price_per_unit) AS DOUBLE) / COUNT(price_per_unit) AS DECIMAL(18,6))
               AS price FROM std WHERE item IS NOT NULL GROUP BY item)""",
        """grp AS (SELECT s.*, COALESCE(s.quantity, q.quantity) AS q1,
             COALESCE(s.price_per_unit, p.price) AS p1
           FROM std s LEFT JOIN qmode q ON q.item = s.item LEFT JOIN pmean p ON p.item = s.item)""",
        f"""overall AS (SELECT
             (SELECT CAST(quantile_cont(CAST(q1 AS DOUBLE), 0.5) AS DECIMAL(12,2)) FROM grp) AS qmed,
             (SELECT CAST(quantile_cont(CAST({'p1' if price_median == 'filled' else 'price_per_unit'}
                AS DOUBLE), 0.5) AS DECIMAL(18,6)) FROM grp) AS pmed,
             (SELECT item FROM std WHERE item IS NOT NULL GROUP BY item
                ORDER BY count(*) DESC, item LIMIT 1) AS item,
             (SELECT payment_method FROM std WHERE payment_method IS NOT NULL
                GROUP BY payment_method ORDER BY count(*) DESC, payment_method LIMIT 1) AS pay,
             (SELECT location FROM std WHERE location IS NOT NULL GROUP BY location
                ORDER BY count(*) DESC, location LIMIT 1) AS loc)""",
        """full_rows AS (SELECT transaction_id, COALESCE(grp.item, overall.item) AS item,
             CAST(COALESCE(q1, qmed) AS DECIMAL(12,2)) AS quantity,
             CAST(COALESCE(p1, pmed) AS DECIMAL(18,6)) AS price_per_unit,
             COALESCE(payment_method, pay) AS payment_method, COALESCE(location, loc) AS location,
             transaction_date, order_type, customer_id FROM grp CROSS JOIN overall)""",
        """clean AS (SELECT DISTINCT transaction_id, item, quantity, price_per_unit,
             CAST(ROUND(quantity * price_per_unit, 2) AS DECIMAL(18,2)) AS total_spent,
             payment_method, location, transaction_date, order_type, customer_id FROM full_rows)""",
    ]


TIME = """day(d) AS day, strftime(d, '%A') AS day_of_week,
  CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend, weekofyear(d) AS week,
  month(d) AS month_num, strftime(d, '%B') AS month, strftime(d, '%b') AS month_short,
  CAST(date_trunc('month', d) AS DATE) AS month_start,
  year(d) || 'Q' || quarter(d) AS quarter, 'Q' || quarter(d) AS quarter_label, year(d) AS year,
  strftime(d, '%Y-%m') AS year_month, year(d) * 12 + month(d) AS month_idx"""


def engineered(rate: str) -> list[str]:
    """CTEs ``fin`` and ``eng`` on top of ``clean``; ``rate`` is the cost share."""
    return [
        f"""fin AS (SELECT *, total_spent AS revenue,
             CAST(ROUND(total_spent * {rate}, 2) AS DECIMAL(18,2)) AS cost FROM clean)""",
        f"""eng AS (SELECT *, CAST(revenue - cost AS DECIMAL(18,2)) AS profit,
             ROUND(CAST(revenue - cost AS DOUBLE) / NULLIF(CAST(revenue AS DOUBLE), 0) * 100, 2)
               AS profit_margin_pct, {TIME}
           FROM (SELECT *, transaction_date AS d FROM fin))""",
    ]


FLAT = "CAST(0.60 AS DECIMAL(4,2))"
BY_ITEM = """CAST(CASE item WHEN 'Promo' THEN 0.66 WHEN 'Economy' THEN 0.63 WHEN 'Medium' THEN 0.58
  WHEN 'Small' THEN 0.72 ELSE 0.60 END AS DECIMAL(4,2))"""
