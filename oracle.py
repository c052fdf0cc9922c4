"""The registered queries as SQL text over the same Parquet tables.

Written independently of the Spark code: one library of common table
expressions from raw rows to star schema, and one statement per query on top.
Amounts are whole cents, so sums and rounded ratios are exact.
"""

import re

MD = ["markdown1", "markdown2", "markdown3", "markdown4", "markdown5"]


def rounded(n: str, d: str, digits: int) -> str:
    """n / d for whole numbers, rounded half away from zero, NULL for d = 0."""
    n, d, scale = f"CAST(({n}) AS HUGEINT)", f"CAST(({d}) AS HUGEINT)", 10**digits
    size = f"((2 * abs({n}) * {scale} + abs({d})) // (2 * abs({d})))"
    sign = f"(CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END)"
    return f"(CASE WHEN {d} <> 0 THEN CAST({sign} * {size} AS DOUBLE) / {scale} END)"


def amount(cents: str) -> str:
    return f"(CAST({cents} AS DOUBLE) / 100)"


def each(template: str, names=None, sep=", ") -> str:
    return sep.join(template.replace("@", m) for m in (names or MD))


HOLIDAY = """((month(date) = 2 AND day(date) BETWEEN 10 AND 14)
 OR (month(date) = 9 AND day(date) BETWEEN 8 AND 12)
 OR (month(date) = 11 AND day(date) BETWEEN 22 AND 28)
 OR (month(date) = 12 AND day(date) BETWEEN 24 AND 31))"""

WEEK = "(datediff('day', DATE '1995-01-06', date) // 7)"


def text(column: str, real: bool = False) -> str:
    value = f"CAST({column} AS VARCHAR)"
    if real:
        value = f"CASE WHEN isnan({column}) THEN 'NaN' ELSE {value} END"
    return f"coalesce({value}, '')"


COMMON = {
    "lines": """
        SELECT CAST(l_suppkey + 1 AS INTEGER) AS store,
               CAST(l_partkey % 10 * 10 + 5 AS INTEGER) AS dept,
               CAST(date_trunc('week', l_shipdate) AS DATE) + 4 AS date,
               l_linenumber, l_returnflag,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS ep,
               CAST(l_discount AS DECIMAL(4,2)) AS di
        FROM lineitem""",
    "raw_sales": f"""
        SELECT store, dept, date,
               CAST(sum(CASE WHEN l_returnflag = 'R' THEN -(ep * (1 - di)) ELSE ep * (1 - di) END)
                    AS DECIMAL(18,2)) AS weekly_sales,
               {HOLIDAY} AS isholiday
        FROM lines GROUP BY store, dept, date""",
    "store_weeks_raw": "SELECT store, date, "
    + ", ".join(
        f"CAST(CAST(sum(CASE WHEN l_linenumber = {k} AND di > 0.05 THEN ep * di END)"
        f" AS DECIMAL(18,2)) AS DOUBLE) AS m{k}"
        for k in range(1, 6)
    )
    + f", {WEEK} AS w, CAST(store AS BIGINT) AS s FROM lines GROUP BY store, date",
    "raw_features": f"""
        SELECT store, date,
               CASE WHEN (s + 5*w) % 223 <> 0 THEN 20 + 5e-2 * ((7*s + 13*w) % 1600) END AS temperature,
               CASE WHEN (s + 7*w) % 227 = 0 THEN NULL
                    WHEN (31*s + w) % 97 = 0 THEN -(2 + 5e-3 * ((s + 3*w) % 500))
                    ELSE 2 + 5e-3 * ((s + 3*w) % 500) END AS fuel_price,
               {", ".join(f"coalesce(m{k}, CASE WHEN s % 2 = 0 THEN 'NaN'::DOUBLE END) AS markdown{k}" for k in range(1, 6))},
               CASE WHEN (s + w) % 211 = 0 THEN 0e0 WHEN (s + 11*w) % 313 = 0 THEN 'NaN'::DOUBLE ELSE 180 + 625e-4 * ((11*s + w) % 800) END AS cpi,
               CASE WHEN (3*s + w) % 307 = 0 THEN 'NaN'::DOUBLE
                    ELSE 35e-1 + 25e-3 * ((5*s + w) % 300) END AS unemployment,
               {HOLIDAY} AS isholiday
        FROM store_weeks_raw""",
    "stores1": """
        SELECT DISTINCT store, CASE store % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS type,
               30000 + 4300 * (store % 45) AS size FROM lines""",
    "stores2": """
        SELECT store,
               CASE (store % 3 + CASE WHEN store % 7 = 0 THEN 1 ELSE 0 END) % 3
                    WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS type,
               size + CASE WHEN store % 5 = 0 THEN 10000 ELSE 0 END AS size FROM stores1""",
    "bronze_stores": """
        SELECT *, TIMESTAMP '2010-02-05 01:00:00' AS ts FROM stores1
        UNION ALL SELECT *, TIMESTAMP '2011-07-01 01:00:00' FROM stores2
        UNION ALL SELECT store, 'Z', size, TIMESTAMP '2011-07-01 01:00:00' FROM stores2 WHERE store % 20 = 0
        UNION ALL SELECT store, type, 0, TIMESTAMP '2011-07-01 01:00:00' FROM stores2 WHERE store % 30 = 0""",
    "bronze_features": f"""
        SELECT *, TIMESTAMP '2011-07-01 01:00:00' AS ts FROM raw_features
        UNION ALL SELECT * REPLACE (temperature + 1 AS temperature), TIMESTAMP '2011-07-01 01:05:00'
        FROM raw_features WHERE (store + {WEEK}) % 11 = 0
        UNION ALL SELECT * REPLACE (temperature - 1 AS temperature), TIMESTAMP '2010-02-05 01:00:00'
        FROM raw_features WHERE (store + {WEEK}) % 7 = 0""",
    "bronze_sales": "SELECT *, TIMESTAMP '2011-07-01 01:00:00' AS ts FROM raw_sales "
    + " ".join(
        f"UNION ALL SELECT * REPLACE ({value} AS weekly_sales), TIMESTAMP '{ts}' FROM raw_sales"
        f" WHERE (store * 7 + dept * 3 + {WEEK}) % {m} = 0"
        for value, ts, m in [
            ("weekly_sales + 10", "2011-07-01 01:05:00", 13),
            ("NULL", "2011-07-01 01:10:00", 17),
            ("weekly_sales - 5", "2010-02-05 01:00:00", 5),
            ("weekly_sales + 1", "2011-07-01 01:00:00", 19),
        ]
    ),
    "sales_load1": """
        SELECT store AS store_id, dept AS department_id, date, weekly_sales, isholiday AS is_holiday
        FROM bronze_sales
        WHERE ts >= DATE '2010-02-04' AND ts < DATE '2010-02-06' AND weekly_sales IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY store, dept, date ORDER BY ts DESC, weekly_sales DESC) = 1""",
    "sales": """
        SELECT (CAST(store AS BIGINT) * 65536 + dept) * 65536 + datediff('day', DATE '1970-01-01', date) AS sales_id,
               store AS store_id, dept AS department_id, date, weekly_sales,
               CAST(weekly_sales * 100 AS BIGINT) AS cents, isholiday AS is_holiday
        FROM bronze_sales
        WHERE ts >= DATE '2011-06-30' AND weekly_sales IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY store, dept, date ORDER BY ts DESC, weekly_sales DESC) = 1""",
    "features": f"""
        SELECT store AS store_id, date, CAST(temperature AS DECIMAL(5,2)) AS temperature,
               CAST(greatest(fuel_price, 0) AS DECIMAL(5,3)) AS fuel_price,
               {each("CAST(CASE WHEN @ IS NULL OR isnan(@) THEN 0 ELSE @ END AS DECIMAL(18,2)) AS @")},
               CAST(cpi AS DECIMAL(10,6)) AS cpi, CAST(unemployment AS DECIMAL(5,3)) AS unemployment,
               isholiday AS is_holiday
        FROM bronze_features
        WHERE ts >= DATE '2011-06-30' AND cpi > 0 AND NOT isnan(cpi)
          AND unemployment >= 0 AND unemployment <= 100 AND NOT isnan(unemployment)
        QUALIFY row_number() OVER (PARTITION BY store, date ORDER BY ts DESC) = 1""",
    "snapshots": """
        SELECT DISTINCT store AS store_id, type AS store_type, size AS store_size, CAST(ts AS DATE) AS day
        FROM bronze_stores WHERE type IN ('A', 'B', 'C') AND size > 0""",
    "store_changes": """
        SELECT o.store_id, o.store_type AS old_type, o.store_size AS old_size,
               n.store_type AS new_type, n.store_size AS new_size,
               (o.store_type <> n.store_type OR o.store_size <> n.store_size) AS changed
        FROM (SELECT * FROM snapshots WHERE day = DATE '2010-02-05') o
        JOIN (SELECT * FROM snapshots WHERE day = DATE '2011-07-01') n USING (store_id)""",
    "stores": """
        SELECT CAST(store_id AS BIGINT) * 65536 + 1 AS store_key, store_id, old_type AS store_type,
               old_size AS store_size, DATE '2010-02-05' AS effective_date,
               CASE WHEN changed THEN DATE '2011-06-30' ELSE DATE '9999-12-31' END AS end_date,
               NOT changed AS is_current, 1 AS version FROM store_changes
        UNION ALL
        SELECT CAST(store_id AS BIGINT) * 65536 + 2, store_id, new_type, new_size, DATE '2011-07-01',
               DATE '9999-12-31', TRUE, 2 FROM store_changes WHERE changed""",
    "current": "SELECT * FROM stores WHERE is_current",
    "fact_days": "SELECT date AS d FROM sales UNION SELECT date FROM features",
    "day_range": """
        SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS d FROM sales""",
    "dim_store": """
        SELECT store_key, store_id, store_type,
               CASE store_type WHEN 'A' THEN 'Superstore' WHEN 'B' THEN 'Discount Store'
                    WHEN 'C' THEN 'Neighborhood Market' END AS store_type_description,
               store_size,
               CASE WHEN store_size < 50000 THEN 'Small' WHEN store_size < 100000 THEN 'Medium'
                    WHEN store_size < 150000 THEN 'Large' ELSE 'Extra Large' END AS size_category,
               effective_date, end_date, is_current, version
        FROM stores""",
    "tuples": f"SELECT DISTINCT {each('@')} FROM features",
    "promo_keys": f"""
        SELECT row_number() OVER (ORDER BY {each('@')}) AS promotion_key, {each('@')} FROM tuples
        WHERE NOT ({each('@ = 0', sep=' AND ')})
        UNION ALL SELECT 0, 0, 0, 0, 0, 0""",
    "promotions": f"""
        SELECT promotion_key, {each('@')}, {each('@', sep=' + ')} AS total_markdown,
               {each('@ > 0 AS has_@')},
               {each('CAST(@ > 0 AS INTEGER)', sep=' + ')} AS num_markdowns,
               CASE WHEN {each('@', sep=' + ')} = 0 THEN 'None' WHEN {each('@', sep=' + ')} < 1000 THEN 'Light'
                    WHEN {each('@', sep=' + ')} < 5000 THEN 'Moderate' ELSE 'Heavy' END AS promotion_type,
               CASE WHEN {each('CAST(@ > 0 AS INTEGER)', sep=' + ')} = 0 THEN 'None'
                    WHEN {each('CAST(@ > 0 AS INTEGER)', sep=' + ')} <= 2 THEN 'Low'
                    WHEN {each('CAST(@ > 0 AS INTEGER)', sep=' + ')} <= 4 THEN 'Medium'
                    ELSE 'High' END AS promotion_intensity
        FROM promo_keys""",
    "levels": """
        SELECT store_id, date, round(coalesce(temperature, 0), 1) AS t, round(coalesce(fuel_price, 0), 2) AS f,
               round(coalesce(cpi, 1), 3) AS c, round(coalesce(unemployment, 0), 2) AS u FROM features""",
    "economics": """
        SELECT CAST(0 AS BIGINT) AS economic_key, 0 AS t, 0 AS f, 1 AS c, 0 AS u
        UNION ALL
        SELECT row_number() OVER (ORDER BY t, f, c, u), t, f, c, u
        FROM (SELECT DISTINCT t, f, c, u FROM levels) WHERE NOT (t = 0 AND f = 0 AND c = 1 AND u = 0)""",
    "fact": f"""
        SELECT s.sales_id AS sales_key,
               year(s.date) * 10000 + month(s.date) * 100 + day(s.date) AS date_key,
               st.store_key, s.department_id AS department_key,
               coalesce(p.promotion_key, 0) AS promotion_key, coalesce(e.economic_key, 0) AS economic_key,
               s.is_holiday, s.weekly_sales, s.cents, 0 AS sales_quantity, s.date
        FROM sales s JOIN current st USING (store_id)
        LEFT JOIN features f ON f.store_id = s.store_id AND f.date = s.date
        LEFT JOIN promo_keys p ON {each('p.@ = f.@', sep=' AND ')}
        LEFT JOIN levels l ON l.store_id = s.store_id AND l.date = s.date
        LEFT JOIN economics e ON e.t = l.t AND e.f = l.f AND e.c = l.c AND e.u = l.u""",
    "joined": f"""
        SELECT s.*, st.store_type, st.store_size, {each('f.@')}, f.cpi, f.unemployment, f.temperature, f.fuel_price,
               {each('CAST(f.@ * 100 AS BIGINT) AS c_@')}
        FROM sales s LEFT JOIN current st USING (store_id)
        LEFT JOIN features f ON f.store_id = s.store_id AND f.date = s.date""",
    "weekly": """
        SELECT store_id, store_type, department_id, CAST(date_trunc('week', date) AS DATE) AS week_start,
               CAST(date_trunc('month', date) AS DATE) AS month_start,
               CAST(date_trunc('quarter', date) AS DATE) AS quarter_start, year(date) AS year,
               sum(cents) AS cents, count(*) AS num_records,
               CAST(sum(cpi) AS DOUBLE) / count(cpi) AS avg_cpi,
               CAST(sum(unemployment) AS DOUBLE) / count(unemployment) AS avg_unemployment,
               CAST(sum(temperature) AS DOUBLE) / count(temperature) AS avg_temperature
        FROM joined GROUP BY ALL""",
    "trend": """
        SELECT *, lag(cents, 52) OVER w AS cents52, lag(cents, 1) OVER w AS cents1 FROM weekly
        WINDOW w AS (PARTITION BY store_id, department_id ORDER BY week_start, month_start)""",
    "training": f"""
        SELECT store_id, department_id, date, {amount('cents')} AS weekly_sales, cents, is_holiday, store_type,
               store_size, CAST(coalesce(temperature, 60) AS DOUBLE) AS temperature,
               CAST(coalesce(fuel_price, 3) AS DOUBLE) AS fuel_price,
               {each('CAST(coalesce(@, 0) AS DOUBLE) AS @')},
               CAST(coalesce(cpi, 210) AS DOUBLE) AS cpi, CAST(coalesce(unemployment, 8) AS DOUBLE) AS unemployment
        FROM joined WHERE store_type IS NOT NULL""",
    "slots": " UNION ALL ".join(
        f"SELECT 'MarkDown{i}' AS markdown_type, {m} AS markdown, cents FROM training"
        for i, m in enumerate(MD, 1)
    ),
    "slot_averages": f"""
        SELECT markdown_type, count(*) FILTER (WHERE markdown > 0) AS weeks_active,
               CAST(coalesce(round({rounded('sum(cents) FILTER (WHERE markdown > 0)', '100 * count(*) FILTER (WHERE markdown > 0)', 2)} * 100), 0) AS BIGINT) AS a,
               CAST(coalesce(round({rounded('sum(cents) FILTER (WHERE markdown = 0)', '100 * count(*) FILTER (WHERE markdown = 0)', 2)} * 100), 0) AS BIGINT) AS b
        FROM slots GROUP BY markdown_type""",
    "raw_joined": f"""
        SELECT s.store AS store_id, s.dept AS department_id, s.date, CAST(s.weekly_sales AS DOUBLE) AS weekly_sales,
               s.isholiday AS is_holiday, st.type, st.size AS store_size,
               {each("CASE WHEN f.store IS NOT NULL THEN CASE WHEN f.@ IS NULL OR isnan(f.@) THEN 0 ELSE f.@ END END AS @")},
               f.temperature, f.fuel_price, CASE WHEN isnan(f.cpi) THEN NULL ELSE f.cpi END AS cpi,
               CASE WHEN isnan(f.unemployment) THEN NULL ELSE f.unemployment END AS unemployment
        FROM raw_sales s LEFT JOIN stores1 st USING (store)
        LEFT JOIN raw_features f ON f.store = s.store AND f.date = s.date""",
    "medians": """
        SELECT median(temperature) AS mt, median(fuel_price) AS mf, median(cpi) AS mc, median(unemployment) AS mu
        FROM raw_joined""",
    "promo_weeks": f"""
        SELECT store_id, store_type, sum(cents) AS cents, {each('coalesce(sum(c_@), 0) AS s_@')}
        FROM joined WHERE store_type IS NOT NULL GROUP BY store_id, store_type""",
    "totals2": f"""
        SELECT store_id, sum(cents) AS cents, {rounded('sum(cents)', '100 * count(*)', 2)} AS average,
               count(DISTINCT department_id) AS departments, any_value(store_type) AS type,
               any_value(store_size) AS size
        FROM training WHERE store_id IN (1, 2) GROUP BY store_id""",
}

# The share of rows kept for tests, by a hash of their key.
IN_TEST = """CAST('0x' || substr(md5(concat_ws('|', '42', store_id, department_id, date)), 1, 8) AS BIGINT) % 10000 < 2000"""

CALENDAR = f"""
    SELECT year(d) * 10000 + month(d) * 100 + day(d) AS date_key, d AS full_date, year(d) AS year,
           year(d) || '-Q' || quarter(d) AS year_quarter, strftime(d, '%Y-%m') AS year_month,
           year(d) || '-W' || lpad(CAST(week(d) AS VARCHAR), 2, '0') AS year_week,
           month(d) AS month_number, strftime(d, '%B') AS month_name, strftime(d, '%b') AS month_abbr,
           quarter(d) AS quarter_number, 'Q' || quarter(d) AS quarter_name, week(d) AS week_of_year,
           (day(d) + 6) // 7 AS week_of_month, day(d) AS day_of_month, dayofyear(d) AS day_of_year,
           isodow(d) AS day_of_week, strftime(d, '%A') AS day_name, strftime(d, '%a') AS day_abbr,
           isodow(d) IN (6, 7) AS is_weekend, {HOLIDAY.replace('date', 'd')} AS is_holiday,
           CASE WHEN month(d) = 2 AND day(d) BETWEEN 10 AND 14 THEN 'Super Bowl'
                WHEN month(d) = 9 AND day(d) BETWEEN 8 AND 12 THEN 'Labor Day'
                WHEN month(d) = 11 AND day(d) BETWEEN 22 AND 28 THEN 'Thanksgiving'
                WHEN month(d) = 12 AND day(d) BETWEEN 24 AND 31 THEN 'Christmas' END AS holiday_name,
           NOT (isodow(d) IN (6, 7) OR {HOLIDAY.replace('date', 'd')}) AS is_business_day,
           CASE WHEN month(d) >= 2 THEN year(d) ELSE year(d) - 1 END AS fiscal_year,
           CASE WHEN month(d) IN (2, 3, 4) THEN 1 WHEN month(d) IN (5, 6, 7) THEN 2
                WHEN month(d) IN (8, 9, 10) THEN 3 ELSE 4 END AS fiscal_quarter,
           CASE WHEN month(d) >= 2 THEN month(d) - 1 ELSE 12 END AS fiscal_period,
           CASE WHEN month(d) = 11 AND day(d) BETWEEN 24 AND 26 THEN 'Black Friday'
                WHEN month(d) = 12 AND day(d) = 26 THEN 'Boxing Day' END AS event_name
    FROM """

FACT_COLUMNS = """sales_key, date_key, store_key, department_key, promotion_key, economic_key, is_holiday,
    CAST(weekly_sales AS DOUBLE) AS weekly_sales, sales_quantity"""


def _growth(last: str) -> str:
    pct = rounded(f"(cents - {last}) * 100", last, 2)
    return f"CASE WHEN {last} > 0 THEN least(999.99, greatest(-999.99, {pct})) END"


def _check(name: str, value: str, passed: str = "v = 0") -> str:
    return f"SELECT '{name}' AS check, CAST(v AS DOUBLE) AS value, {passed} AS passed FROM (SELECT {value})"


def _count(name: str, condition: str, table: str, passed: str = "v = 0") -> str:
    return _check(name, f"count(*) AS v FROM {table} WHERE {condition}", passed)


def _all(checks) -> str:
    return " UNION ALL ".join(checks)


def _impact(column: str, low: int, high: int, labels, name: str) -> str:
    return f"""
    SELECT CASE WHEN {column} < {low} THEN '{labels[0]}' WHEN {column} <= {high} THEN '{labels[1]}'
                ELSE '{labels[2]}' END AS {name},
           {amount('sum(cents)')} / count(*) AS avg_sales, count(*) AS records
    FROM training GROUP BY 1"""


def _promotion_report(where: str) -> str:
    spend = each("s_@", sep=" + ")
    columns = ", ".join(f"{amount('s_' + m)} AS total_md{i}" for i, m in enumerate(MD, 1))
    return f"""
    SELECT store_id, store_type, {amount('cents')} AS total_sales, {columns},
           {amount(f'({spend})')} AS total_markdown, {rounded('cents', spend, 4)} AS roi
    FROM promo_weeks WHERE {where} ORDER BY cents DESC, store_id LIMIT 50"""


H, N = "FILTER (WHERE is_holiday)", "FILTER (WHERE NOT is_holiday)"

KEYED = {
    "silver.stores": ("stores", [["store_id", "version"], ["store_id", "effective_date"]]),
    "silver.features": ("features", [["store_id", "date"]]),
    "silver.sales": ("sales", [["store_id", "department_id", "date"]]),
    "platinum.promotion": (
        "(SELECT store_id, department_id, date_trunc('week', date) AS week_start FROM joined GROUP BY ALL)",
        [["store_id", "department_id", "week_start"]],
    ),
    "platinum.trend": ("trend", [["store_id", "department_id", "week_start"]]),
    "gold.dim_date": (
        "(SELECT d AS full_date, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key FROM fact_days)",
        [["date_key"], ["full_date"]],
    ),
    "gold.dim_store": ("dim_store", [["store_id", "version"]]),
    "gold.dim_department": ("(SELECT DISTINCT department_id FROM sales)", [["department_id"]]),
    "gold.dim_promotion": ("promo_keys", [MD]),
    "gold.dim_economic": (
        "(SELECT t AS temperature, f AS fuel_price, c AS cpi, u AS unemployment FROM economics)",
        [["temperature", "fuel_price", "cpi", "unemployment"]],
    ),
    "gold.fact_sales": ("fact", [["date_key", "store_key", "department_key"]]),
}


def _unique(name: str, table: str, keys) -> str:
    columns = ", ".join(keys)
    return _check(
        f"duplicate {name} ({columns})",
        f"count(*) AS v FROM (SELECT {columns} FROM {table} GROUP BY {columns} HAVING count(*) > 1)",
    )


QUERIES = {
    "ingest_stores": f"""
        SELECT store, type, size, md5(concat_ws('|', {text('store')}, {text('type')}, {text('size')})) AS row_hash
        FROM bronze_stores""",
    "ingest_features": f"""
        SELECT store, date, temperature, fuel_price, {each('@')}, cpi, unemployment, isholiday,
               md5(concat_ws('|', {text('store')}, {text('date')}, {text('temperature', True)},
                   {text('fuel_price', True)}, {', '.join(text(m, True) for m in MD)}, {text('cpi', True)},
                   {text('unemployment', True)}, {text('isholiday')})) AS row_hash
        FROM bronze_features""",
    "ingest_sales": f"""
        SELECT store, dept, date, CAST(weekly_sales AS DOUBLE) AS weekly_sales, isholiday,
               md5(concat_ws('|', {text('store')}, {text('dept')}, {text('date')},
                   {text('CAST(weekly_sales AS DOUBLE)')}, {text('isholiday')})) AS row_hash
        FROM bronze_sales""",
    "silver_stores": "SELECT * FROM stores",
    "silver_stores_from_history": """
        SELECT store_id, store_type, store_size, effective_date, end_date, is_current, version FROM stores""",
    "silver_features": f"""
        SELECT store_id, date, CAST(temperature AS DOUBLE) AS temperature, CAST(fuel_price AS DOUBLE) AS fuel_price,
               {each('CAST(@ AS DOUBLE) AS @')}, CAST(cpi AS DOUBLE) AS cpi,
               CAST(unemployment AS DOUBLE) AS unemployment, is_holiday FROM features""",
    "silver_sales": f"""
        SELECT sales_id, store_id, department_id, date, {amount('cents')} AS weekly_sales, is_holiday FROM sales""",
    "upsert_sales": f"""
        SELECT coalesce(b.store_id, a.store_id) AS store_id, coalesce(b.department_id, a.department_id) AS department_id,
               coalesce(b.date, a.date) AS date,
               CAST(coalesce(b.weekly_sales, a.weekly_sales) AS DOUBLE) AS weekly_sales,
               CASE WHEN a.store_id IS NULL THEN DATE '2011-07-01' ELSE DATE '2010-02-05' END AS created_on,
               CASE WHEN b.store_id IS NULL OR (a.weekly_sales = b.weekly_sales AND a.is_holiday = b.is_holiday)
                    THEN DATE '2010-02-05' ELSE DATE '2011-07-01' END AS updated_on
        FROM sales_load1 a FULL JOIN sales b
          ON a.store_id = b.store_id AND a.department_id = b.department_id AND a.date = b.date""",
    "insert_absent_weeks": """
        SELECT store_id, date, 'features' AS known_from FROM features
        UNION ALL
        SELECT store_id, date, 'sales' FROM (SELECT store_id, date FROM sales EXCEPT SELECT store_id, date FROM features)""",
    "latest_features": """
        SELECT store_id, date, CAST(temperature AS DOUBLE) AS temperature, CAST(cpi AS DOUBLE) AS cpi
        FROM features WHERE (store_id, date) IN (SELECT store_id, max(date) FROM features GROUP BY store_id)""",
    "surrogate_keys": """
        SELECT row_number() OVER (ORDER BY date, store_id) AS week_key, store_id, date FROM features""",
    "as_of_store_version": f"""
        SELECT store_id, version, store_type, size_category, count(*) AS num_sales, {amount('sum(cents)')} AS total_sales
        FROM (SELECT sales.store_id, date, cents, version, store_type, size_category
              FROM sales LEFT JOIN dim_store ON dim_store.store_id = sales.store_id
              AND CAST(date + INTERVAL 14 YEAR AS DATE) BETWEEN effective_date AND end_date)
        GROUP BY store_id, version, store_type, size_category""",
    "dim_date": CALENDAR + "fact_days",
    "dim_date_range": CALENDAR + "day_range",
    "dim_store": f"""
        SELECT d.*, e.sales_per_sqft_avg, e.store_efficiency_rank
        FROM dim_store d LEFT JOIN (
            SELECT store_key, sales_per_sqft_avg,
                   CAST(rank() OVER (ORDER BY sales_per_sqft_avg DESC) AS INTEGER) AS store_efficiency_rank
            FROM (SELECT store_key, {rounded('sum(cents)', '100 * count(DISTINCT date) * any_value(store_size)', 2)} AS sales_per_sqft_avg
                  FROM sales JOIN current USING (store_id) GROUP BY store_key)
        ) e USING (store_key)""",
    "dim_department": """
        SELECT DISTINCT department_id AS department_key, department_id, 'Department ' || department_id AS department_name,
               CASE WHEN department_id <= 10 THEN 'Electronics & Home' WHEN department_id <= 20 THEN 'Apparel & Accessories'
                    WHEN department_id <= 30 THEN 'General Merchandise' WHEN department_id <= 40 THEN 'Health & Wellness'
                    WHEN department_id <= 50 THEN 'Food & Beverage' WHEN department_id <= 60 THEN 'Fresh Produce'
                    WHEN department_id <= 70 THEN 'Entertainment' WHEN department_id <= 80 THEN 'Home Improvement'
                    WHEN department_id <= 90 THEN 'Seasonal' ELSE 'Other' END AS department_category,
               CASE WHEN department_id <= 30 THEN 'Hardlines' WHEN department_id <= 50 THEN 'Softlines'
                    ELSE 'Consumables' END AS department_group,
               CASE WHEN department_id <= 20 THEN 'General Merchandise' WHEN department_id <= 60 THEN 'Grocery'
                    ELSE 'Seasonal & Other' END AS division,
               (department_id > 60 AND department_id <= 70) OR (department_id > 80 AND department_id <= 90) AS is_seasonal,
               FALSE AS is_high_margin
        FROM sales""",
    "dim_department_default": f"""
        SELECT CASE WHEN department_id NOT BETWEEN 1 AND 99 THEN 'Unmapped'
                    WHEN department_id <= 30 THEN 'General Merchandise' WHEN department_id <= 60 THEN 'Food'
                    WHEN department_id <= 90 THEN 'Apparel' ELSE 'Other' END AS department_category,
               CASE WHEN department_id NOT BETWEEN 1 AND 99 THEN 'Unmapped'
                    WHEN department_id <= 45 THEN 'Discretionary' ELSE 'Staples' END AS department_group,
               {amount('sum(cents)')} AS total_sales, count(*) AS num_records
        FROM sales GROUP BY 1, 2""",
    "dim_promotion": f"""
        SELECT * REPLACE ({each('CAST(@ AS DOUBLE) AS @')}, CAST(total_markdown AS DOUBLE) AS total_markdown)
        FROM promotions""",
    "dim_economic": """
        SELECT economic_key, CAST(t AS DOUBLE) AS temperature,
               CASE WHEN economic_key = 0 THEN NULL WHEN t < 32 THEN 'Cold' WHEN t < 50 THEN 'Cool'
                    WHEN t < 70 THEN 'Mild' WHEN t < 85 THEN 'Warm' ELSE 'Hot' END AS temperature_band,
               CAST(f AS DOUBLE) AS fuel_price,
               CASE WHEN economic_key = 0 THEN NULL WHEN f < 2.5 THEN 'Low' WHEN f < 3.5 THEN 'Medium'
                    WHEN f < 4 THEN 'High' ELSE 'Very High' END AS fuel_price_band,
               CAST(c AS DOUBLE) AS cpi,
               CASE WHEN economic_key = 0 THEN NULL WHEN c < 200 THEN 'Low Inflation'
                    WHEN c < 220 THEN 'Moderate Inflation' ELSE 'High Inflation' END AS cpi_category,
               CAST(u AS DOUBLE) AS unemployment,
               CASE WHEN economic_key = 0 THEN NULL WHEN u < 5 THEN 'Low' WHEN u < 8 THEN 'Medium'
                    ELSE 'High' END AS unemployment_category,
               CASE WHEN economic_key = 0 THEN 'Unknown' WHEN u >= 8 THEN 'Recession' WHEN u >= 6 THEN 'Recovery'
                    WHEN u >= 4 THEN 'Growth' ELSE 'Peak' END AS economic_condition
        FROM economics""",
    "fact_sales": f"SELECT {FACT_COLUMNS} FROM fact",
    "fact_yoy": f"""
        SELECT {FACT_COLUMNS}, {amount('ly')} AS sales_vs_ly, {_growth('ly')} AS sales_growth_pct
        FROM (SELECT *, lag(cents, 52) OVER (PARTITION BY store_key, department_key ORDER BY date) AS ly FROM fact)""",
    "warehouse_fact": f"""
        SELECT sales_key, date_key, store_key, department_key, is_holiday, CAST(weekly_sales AS DOUBLE) AS weekly_sales,
               sales_quantity, {amount('ly')} AS sales_vs_ly, {_growth('ly')} AS sales_growth_pct, promotion_type,
               CAST(total_markdown AS DOUBLE) AS total_markdown, CAST(t AS DOUBLE) AS temperature,
               CAST(f AS DOUBLE) AS fuel_price, CAST(c AS DOUBLE) AS cpi, CAST(u AS DOUBLE) AS unemployment
        FROM (SELECT *, lag(cents, 52) OVER (PARTITION BY store_key, department_key ORDER BY date) AS ly FROM fact)
        JOIN promotions USING (promotion_key) JOIN economics USING (economic_key)""",
    "fact_yoy_calendar": f"""
        SELECT {FACT_COLUMNS}, {amount('ly')} AS sales_vs_ly, {_growth('ly')} AS sales_growth_pct
        FROM (SELECT a.*, b.cents AS ly FROM fact a LEFT JOIN fact b ON b.store_key = a.store_key
              AND b.department_key = a.department_key AND b.date = a.date - 364)""",
    "current_stores": """
        SELECT store_key, store_id, store_type, store_type_description, store_size, size_category
        FROM dim_store WHERE is_current""",
    "sales_by_store_type": f"""
        SELECT store_type, year(date) AS year, 'Q' || quarter(date) AS quarter_name,
               count(DISTINCT store_id) AS num_stores, {amount('sum(cents)')} AS total_sales,
               {amount('sum(cents)')} / count(*) AS avg_weekly_sales, {amount('max(cents)')} AS max_weekly_sales,
               {amount('min(cents)')} AS min_weekly_sales
        FROM fact JOIN dim_store USING (store_key) GROUP BY 1, 2, 3""",
    "gold_promotion_effectiveness": f"""
        SELECT promotion_type, num_markdowns, count(*) AS num_observations, {amount('sum(cents)')} AS total_sales,
               {amount('sum(cents)')} / count(*) AS avg_sales,
               CAST(sum(total_markdown) AS DOUBLE) / count(*) AS avg_markdown_cost,
               {amount('sum(cents)')} / nullif(CAST(sum(total_markdown) AS DOUBLE), 0) AS roi
        FROM fact JOIN promotions USING (promotion_key)
        WHERE promotion_type <> 'None' GROUP BY promotion_type, num_markdowns""",
    "promotion_mart": f"""
        SELECT store_id, store_type, store_size, CAST(date_trunc('week', date) AS DATE) AS week_start, department_id,
               {amount('sum(cents)')} AS total_sales, {amount('sum(cents)')} / count(*) AS avg_sales,
               {each('coalesce(CAST(sum(@) AS DOUBLE) / count(@), 0) AS avg_@')},
               {each('coalesce(sum(@) > 0, FALSE) AS has_@')},
               {amount('sum(cents)')} / nullif(CAST({each('coalesce(sum(@), 0)', sep=' + ')} AS DOUBLE), 0) AS promotion_roi,
               max(CAST(is_holiday AS INTEGER)) AS has_holiday
        FROM joined GROUP BY store_id, store_type, store_size, date_trunc('week', date), department_id""",
    "trend_mart": f"""
        SELECT store_id, store_type, department_id, week_start, month_start, quarter_start, year,
               {amount('cents')} AS total_sales, {amount('cents')} / num_records AS avg_sales, num_records,
               {amount('cents52')} AS sales_52w_ago, {amount('cents1')} AS sales_1w_ago, avg_cpi, avg_unemployment,
               avg_temperature FROM trend""",
    "trend_growth": f"""
        SELECT store_id, department_id, week_start, month_start, {amount('cents')} AS total_sales,
               {rounded('(cents - cents52) * 100', 'cents52', 2)} AS yoy_growth_pct,
               {rounded('(cents - cents1) * 100', 'cents1', 2)} AS wow_growth_pct FROM trend""",
    "date_hierarchy": f"""
        SELECT CASE GROUPING(y, q, m, w, date) WHEN 0 THEN 'day' WHEN 1 THEN 'week' WHEN 3 THEN 'month'
                    WHEN 7 THEN 'quarter' WHEN 15 THEN 'year' ELSE 'all' END AS level,
               CAST(y AS INTEGER) AS year, CAST(q AS INTEGER) AS quarter, CAST(m AS INTEGER) AS month,
               w AS week_start, date AS day, {amount('sum(cents)')} AS total_sales, count(*) AS num_records
        FROM (SELECT *, year(date) AS y, quarter(date) AS q, month(date) AS m,
                     CAST(date_trunc('week', date) AS DATE) AS w FROM sales)
        GROUP BY ROLLUP (y, q, m, w, date)""",
    "fiscal_hierarchy": f"""
        SELECT CASE GROUPING(fy, fq, fp) WHEN 0 THEN 'fiscal_period' WHEN 1 THEN 'fiscal_quarter'
                    WHEN 3 THEN 'fiscal_year' ELSE 'all' END AS level,
               CAST(fy AS INTEGER) AS fiscal_year, CAST(fq AS INTEGER) AS fiscal_quarter, CAST(fp AS INTEGER) AS fiscal_period,
               {amount('sum(cents)')} AS total_sales, count(*) AS num_records
        FROM (SELECT *, CASE WHEN month(date) >= 2 THEN year(date) ELSE year(date) - 1 END AS fy,
                     CASE WHEN month(date) IN (2, 3, 4) THEN 1 WHEN month(date) IN (5, 6, 7) THEN 2
                          WHEN month(date) IN (8, 9, 10) THEN 3 ELSE 4 END AS fq,
                     CASE WHEN month(date) >= 2 THEN month(date) - 1 ELSE 12 END AS fp FROM sales)
        GROUP BY ROLLUP (fy, fq, fp)""",
    "kpi_summary": f"""
        SELECT count(DISTINCT store_id) AS num_stores, count(DISTINCT department_id) AS num_departments,
               count(DISTINCT date) AS num_weeks, {amount('sum(cents)')} AS total_sales,
               {rounded('sum(cents)', '100 * count(*)', 2)} AS avg_weekly_sales,
               {rounded(f'sum(cents) {H}', f'100 * count(*) {H}', 2)} AS avg_holiday_sales,
               {rounded(f'sum(cents) {N}', f'100 * count(*) {N}', 2)} AS avg_normal_sales,
               {rounded(f'100 * (sum(cents) {H} * count(*) {N} - sum(cents) {N} * count(*) {H})',
                        f'sum(cents) {N} * count(*) {H}', 2)} AS holiday_lift_pct
        FROM sales""",
    "top_departments": f"""
        SELECT department_id, {amount('sum(cents)')} AS total_sales,
               {rounded('sum(cents)', '100 * count(*)', 2)} AS avg_weekly_sales, count(DISTINCT store_id) AS num_stores
        FROM sales GROUP BY department_id ORDER BY sum(cents) DESC, department_id LIMIT 10""",
    "cpi_impact": _impact("cpi", 200, 220, ["Low(<200)", "Moderate(200-220)", "High(>220)"], "cpi_band"),
    "unemployment_impact": _impact(
        "unemployment", 5, 8, ["Low(<5%)", "Medium(5-8%)", "High(>8%)"], "unemp_band"
    ),
    "store_list": f"""
        SELECT store_id, store_type, store_size, {amount('sum(cents)')} AS total_sales,
               {rounded('sum(cents)', '100 * count(*)', 2)} AS avg_weekly_sales,
               count(DISTINCT department_id) AS active_departments, count(DISTINCT date) AS weeks_recorded
        FROM training GROUP BY store_id, store_type, store_size""",
    "store_performance": f"""
        SELECT department_id, {amount('sum(cents)')} AS total_sales,
               {rounded('sum(cents)', '100 * count(*)', 2)} AS avg_weekly_sales,
               {amount('max(cents)')} AS max_weekly_sales, {amount('min(cents)')} AS min_weekly_sales,
               count(*) {H} AS holiday_weeks, {rounded(f'sum(cents) {H}', f'100 * count(*) {H}', 2)} AS avg_holiday_sales,
               {rounded(f'sum(cents) {N}', f'100 * count(*) {N}', 2)} AS avg_normal_sales
        FROM sales WHERE store_id = 1 GROUP BY department_id""",
    "compare_stores": f"""
        SELECT 1 AS store_a, 2 AS store_b,
               {amount('a.cents')} AS total_sales_a, a.average AS avg_weekly_sales_a,
               a.departments AS num_departments_a, a.type AS store_type_a, a.size AS store_size_a,
               {amount('b.cents')} AS total_sales_b, b.average AS avg_weekly_sales_b,
               b.departments AS num_departments_b, b.type AS store_type_b, b.size AS store_size_b,
               {amount('(a.cents - b.cents)')} AS sales_diff,
               {rounded('(a.cents - b.cents) * 100', 'greatest(b.cents, 100)', 2)} AS sales_diff_pct
        FROM totals2 a, totals2 b WHERE a.store_id = 1 AND b.store_id = 2""",
    "promotion_effectiveness": _promotion_report("TRUE"),
    "promotion_effectiveness_type_a": _promotion_report("store_type = 'A'"),
    "markdown_ranking": f"""
        SELECT markdown_type, weeks_active, {amount('a')} AS avg_sales_with_markdown,
               {amount('b')} AS avg_sales_without_markdown,
               {rounded('(a - b) * 100', 'greatest(b, 100)', 2)} AS avg_sales_lift_pct
        FROM slot_averages""",
    "training_frame": """
        SELECT * EXCLUDE (cents), week(date) AS week_of_year, month(date) AS month, year(date) AS year,
               quarter(date) AS quarter FROM training""",
    "features_frame": f"""
        SELECT store_id, date, CAST(temperature AS DOUBLE) AS temperature, CAST(fuel_price AS DOUBLE) AS fuel_price,
               {each('CAST(@ AS DOUBLE) AS @')}, CAST(cpi AS DOUBLE) AS cpi,
               CAST(unemployment AS DOUBLE) AS unemployment, is_holiday FROM features""",
    "promotion_frame": f"""
        SELECT store_id, department_id, date, weekly_sales, is_holiday, store_type, {each('@')} FROM training""",
    "training_frame_raw": f"""
        SELECT store_id, department_id, date, weekly_sales, is_holiday,
               (SELECT count(DISTINCT type) FROM raw_joined o WHERE o.type < r.type) AS store_type, store_size,
               {each('@')}, coalesce(temperature, mt) AS temperature, coalesce(fuel_price, mf) AS fuel_price,
               coalesce(cpi, mc) AS cpi, coalesce(unemployment, mu) AS unemployment,
               week(date) AS week_of_year, month(date) AS month, year(date) AS year, quarter(date) AS quarter
        FROM raw_joined r, medians""",
    "promotion_frame_raw": f"""
        SELECT store_id, department_id, date, weekly_sales, is_holiday, type AS store_type,
               {each('coalesce(@, 0) AS @')} FROM raw_joined""",
    "week_snapshot": f"""
        SELECT store_id, CAST(temperature AS DOUBLE) AS temperature, CAST(fuel_price AS DOUBLE) AS fuel_price,
               CAST({each('@', sep=' + ')} AS DOUBLE) AS total_markdown, CAST(cpi AS DOUBLE) AS cpi,
               CAST(unemployment AS DOUBLE) AS unemployment, is_holiday
        FROM features WHERE date = DATE '1998-12-25'""",
    "top_holiday_departments": f"""
        SELECT department_id, {amount('sum(cents)')} AS total_holiday_sales, count(*) AS num_weeks
        FROM sales WHERE is_holiday GROUP BY department_id ORDER BY sum(cents) DESC, department_id LIMIT 10""",
    "sales_with_economics": f"""
        SELECT store_id, department_id, date, {amount('cents')} AS weekly_sales, CAST(temperature AS DOUBLE) AS temperature,
               CAST(fuel_price AS DOUBLE) AS fuel_price, CAST(markdown1 AS DOUBLE) AS markdown1,
               CAST(cpi AS DOUBLE) AS cpi, CAST(unemployment AS DOUBLE) AS unemployment
        FROM joined WHERE date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'""",
    "negative_sales": f"""
        SELECT store_id, department_id, date, {amount('cents')} AS weekly_sales FROM sales WHERE cents < 0
        ORDER BY cents, store_id, department_id, date LIMIT 5""",
    "current_store_info": "SELECT store_id, store_type, store_size, effective_date FROM current",
    "check_nan_markdowns": _all(
        [_count(f"bronze nan {m}", f"isnan({m})", "bronze_features", "TRUE") for m in MD]
        + [_count(f"silver nan {m}", f"isnan(CAST({m} AS DOUBLE))", "features") for m in MD]
    ),
    "check_row_counts": _all(
        _check(f"rows {name}", f"count(*) AS v FROM {table}", "TRUE") for name, (table, _) in KEYED.items()
    ),
    "check_date_range": _all(
        [
            _check("earliest date", "CAST(strftime(min(date), '%Y%m%d') AS INTEGER) AS v FROM bronze_sales", "TRUE"),
            _check("latest date", "CAST(strftime(max(date), '%Y%m%d') AS INTEGER) AS v FROM bronze_sales", "TRUE"),
            _check("unique weeks", "count(DISTINCT date) AS v FROM bronze_sales", "TRUE"),
        ]
    ),
    "check_negative_sales": _all(
        [
            _check("sales records", "count(*) AS v FROM bronze_sales", "TRUE"),
            _count("negative sales", "weekly_sales < 0", "bronze_sales", "TRUE"),
            _check("min sales", "min(weekly_sales) AS v FROM bronze_sales", "TRUE"),
            _check("max sales", "max(weekly_sales) AS v FROM bronze_sales", "TRUE"),
            _check(
                "avg sales",
                f"{amount('sum(CAST(weekly_sales * 100 AS BIGINT))')} / count(weekly_sales) AS v FROM bronze_sales",
                "TRUE",
            ),
        ]
    ),
    "check_store_types": """
        SELECT type, count(*) AS num_stores, CAST(round(avg(size)) AS INTEGER) AS avg_size, min(size) AS min_size,
               max(size) AS max_size FROM bronze_stores GROUP BY type""",
    "check_null_sales": _count("null weekly_sales", "weekly_sales IS NULL", "sales"),
    "check_sales_without_store": _count(
        "sales without current store", "store_id NOT IN (SELECT store_id FROM current)", "sales"
    ),
    "check_invalid_indicators": _all(
        [
            _count("invalid cpi", "cpi <= 0", "features"),
            _count("invalid unemployment", "unemployment < 0 OR unemployment > 100", "features"),
        ]
    ),
    "check_dates_without_features": """
        SELECT DISTINCT date FROM sales s
        WHERE NOT EXISTS (SELECT 1 FROM features f WHERE f.store_id = s.store_id AND f.date = s.date)""",
    "check_fact_null_keys": _all(
        _count(f"null {k}", f"{k} IS NULL", "fact") for k in ("date_key", "store_key", "department_key")
    ),
    "check_fact_orphans": _all(
        [
            _count(
                "orphan date_key",
                "date_key NOT IN (SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) FROM fact_days)",
                "fact",
            ),
            _count("orphan store_key", "store_key NOT IN (SELECT store_key FROM stores)", "fact"),
            _count("orphan department_key", "department_key NOT IN (SELECT department_id FROM sales)", "fact"),
            _count("orphan promotion_key", "promotion_key NOT IN (SELECT promotion_key FROM promo_keys)", "fact"),
            _count("orphan economic_key", "economic_key NOT IN (SELECT economic_key FROM economics)", "fact"),
        ]
    ),
    "check_count_drift": """
        SELECT 'fact vs silver count drift' AS check, CAST(abs(f - s) AS DOUBLE) AS value,
               abs(f - s) <= s * 0.01 AS passed
        FROM (SELECT count(*) AS f FROM fact), (SELECT count(*) AS s FROM sales)""",
    "check_value_rules": _all(
        [
            _count("store type not A, B, C", "store_type NOT IN ('A', 'B', 'C')", "stores"),
            _count("store size not positive", "store_size <= 0", "stores"),
            _count("effective after end", "effective_date > end_date", "stores"),
            _count("fuel price negative", "fuel_price < 0", "features"),
            _count("cpi not positive", "cpi <= 0", "features"),
            _count("unemployment outside 0..100", "unemployment NOT BETWEEN 0 AND 100", "features"),
            _count("month outside 1..12", "month(d) NOT BETWEEN 1 AND 12", "fact_days"),
            _count("quarter outside 1..4", "quarter(d) NOT BETWEEN 1 AND 4", "fact_days"),
            _count("week outside 1..53", "week(d) NOT BETWEEN 1 AND 53", "fact_days"),
            _count("day outside 1..31", "day(d) NOT BETWEEN 1 AND 31", "fact_days"),
            _count("day of year outside 1..366", "dayofyear(d) NOT BETWEEN 1 AND 366", "fact_days"),
            _count("weekday outside 1..7", "isodow(d) NOT BETWEEN 1 AND 7", "fact_days"),
        ]
    ),
    "check_unique_keys": _all(
        _unique(name, table, keys) for name, (table, all_keys) in KEYED.items() for keys in all_keys
    ),
    "check_store_history": _all(
        [
            _check(
                "stores without exactly one current version",
                "count(*) AS v FROM (SELECT store_id FROM stores GROUP BY store_id"
                " HAVING count(*) FILTER (WHERE is_current) <> 1)",
            ),
            _check(
                "stores with gap or overlap",
                "count(DISTINCT a.store_id) AS v FROM stores a JOIN stores b"
                " ON b.store_id = a.store_id AND b.version = a.version + 1"
                " WHERE b.effective_date <> a.end_date + 1",
            ),
            _check(
                "stores with missing version numbers",
                "count(*) AS v FROM (SELECT store_id FROM stores GROUP BY store_id"
                " HAVING max(version) <> count(*))",
            ),
        ]
    ),
    "check_week_alignment": _all(
        [
            _count("sales not on a Friday", "isodow(date) <> 5", "sales"),
            _check(
                "holiday flags that differ",
                "count(*) AS v FROM sales s JOIN features f ON f.store_id = s.store_id AND f.date = s.date"
                " WHERE s.is_holiday <> f.is_holiday",
            ),
        ]
    ),
    "train_sales_forecaster": f"""
        SELECT count(*) FILTER (NOT {IN_TEST}) AS training_rows, count(*) FILTER ({IN_TEST}) AS test_rows,
               CAST(200 AS BIGINT) AS trees_grown, true AS fits_training_rows, true AS holds_on_test_rows
        FROM training""",
    "score_sales": """
        SELECT store_id, department_id, date, count(*) AS forecasts, true AS within_sales_seen
        FROM training GROUP BY store_id, department_id, date""",
    "model_status": f"""
        SELECT model, true AS trained, 1 AS version, count(*) FILTER (NOT {IN_TEST}) AS training_rows,
               count(*) FILTER ({IN_TEST}) AS test_rows
        FROM training, (VALUES ('sales_forecaster'), ('promotion_impact')) AS names(model) GROUP BY model""",
    "training_guard": "SELECT count(*) >= 100 AS accepted, count(*) AS training_rows FROM training",
}

QUERIES["warehouse_trend"] = QUERIES["trend_mart"]
QUERIES["warehouse_checks"] = _all(QUERIES[f"check_{c}"] for c in ("fact_null_keys", "fact_orphans", "count_drift"))


def _needed(sql: str) -> list:
    """The common expressions a statement uses, in an order that defines before use."""
    order = []

    def visit(text):
        for name in COMMON:
            if name not in order and re.search(rf"(FROM|JOIN|,)\s+{name}\b", text):
                visit(COMMON[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    return order


def statements() -> dict:
    result = {}
    for name, sql in QUERIES.items():
        parts = [f"{n} AS MATERIALIZED ({COMMON[n]})" for n in _needed(sql)]
        result[name] = f"WITH {', '.join(parts)} {sql}"
    return result
