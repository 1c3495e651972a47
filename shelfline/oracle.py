"""DuckDB SQL with the expected result of every registered query.

Written the plain way: movements are joined to receipts row by row with ASOF
JOIN and grouped afterwards, key lookups use natural keys, and every KPI starts
from the same fact. Rounding and null order are spelled out as in the library.
"""


from shelfline.constants import BAND_RAW, BAND_STORED, CURRENCY_RATE


def _r2(x: str) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(28,8)), 2) AS DOUBLE)"


def _exact(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,2))"


DAY_TEXT = """CASE WHEN l_tax = 0.0 AND l_discount = 0.05 THEN NULL
    WHEN l_tax = 0.08 AND l_discount = 0.05 THEN '2'
    WHEN l_tax = 0.08 AND l_discount = 0.06 THEN CAST(CAST(l_shipdate AS DATE) + 8766 AS VARCHAR) || ' 00:00:00'
    ELSE CAST(CAST(l_shipdate AS DATE) + 8766 AS VARCHAR) END"""
SKU = "CASE WHEN l_linenumber = 7 THEN 'E' ELSE 'M' END || CAST(l_partkey AS VARCHAR)"
OPENED = "l_quantity * l_linenumber"
RECEIVED = "CASE WHEN l_returnflag = 'R' THEN ROUND(l_tax * 100) * l_linenumber * 2 ELSE 0.0 END"
ISSUED = "CAST(l_linenumber * CASE WHEN l_linestatus = 'F' THEN 7 ELSE 1 END AS DOUBLE)"

STAGES = f"""
item AS (
  SELECT 'M' || CAST(p_partkey AS VARCHAR) AS medicine_sku, p_name AS medicine_name, p_type AS type_description,
         p_brand AS storage_type,
         CAST(ROUND(CAST(CASE WHEN p_size = 50 THEN 0 ELSE p_retailprice END AS DECIMAL(28,8)), 2) AS DECIMAL(18,2)) AS unit_cost,
         CASE WHEN p_size = 1 THEN 0 ELSE p_size END AS expiration_months
  FROM part),
vendor AS (
  SELECT 'V' || CAST(s_suppkey AS VARCHAR) AS vendor_account, s_name AS vendor_name, r_name AS vendor_type,
         n_name AS country_name, CASE WHEN s_acctbal < 0 THEN 'Inactive' ELSE 'Active' END AS vendor_status
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
supply_in AS (
  SELECT {SKU} AS mat_sku, CAST(try_strptime({DAY_TEXT}, '%Y-%m-%d') AS DATE) AS rcvd_date,
         CASE WHEN l_discount = 0.1 AND l_tax = 0.08 THEN NULL WHEN l_linenumber = 6 THEN 'X' || CAST(l_suppkey AS VARCHAR)
              ELSE 'V' || CAST(l_suppkey AS VARCHAR) END AS ven_acc
  FROM lineitem WHERE l_returnflag = 'N'),
supply AS (SELECT * FROM supply_in WHERE mat_sku IS NOT NULL AND rcvd_date IS NOT NULL AND ven_acc IS NOT NULL),
receipt AS (SELECT mat_sku, rcvd_date, max(ven_acc) AS ven_acc FROM supply GROUP BY ALL),
movement_in AS (
  SELECT 'movements_' || l_linestatus || '.csv' AS source_file, l_returnflag AS batch, {SKU} AS mat_sku,
         CAST(try_strptime({DAY_TEXT}, '%Y-%m-%d') AS DATE) AS movement_date,
         CASE WHEN l_discount = 0.0 THEN 0.0 ELSE {OPENED} END AS opening_qty,
         {RECEIVED} AS received_qty, {ISSUED} AS issued_qty,
         CASE WHEN l_discount = 0.1 THEN 0.0 ELSE {OPENED} + {RECEIVED} - {ISSUED} END AS closed_qty
  FROM lineitem WHERE l_returnflag <> 'N'),
movement AS (SELECT * FROM movement_in WHERE movement_date IS NOT NULL),
calendar AS (
  SELECT DISTINCT year(movement_date) * 10000 + month(movement_date) * 100 + day(movement_date) AS date_id_pk,
         movement_date AS full_date, CAST(year(movement_date) AS INTEGER) AS year,
         CAST(quarter(movement_date) AS INTEGER) AS quarter, CAST(month(movement_date) AS INTEGER) AS month,
         strftime(movement_date, '%B') AS month_name, CAST(day(movement_date) AS INTEGER) AS day,
         strftime(movement_date, '%A') AS day_of_week
  FROM movement),
mapped AS (
  SELECT m.*, r.ven_acc FROM movement m ASOF JOIN receipt r
  ON m.mat_sku = r.mat_sku AND m.movement_date >= r.rcvd_date)"""


def _fact(name: str, rows: str, scope: str = "") -> str:
    """CTEs ending in a natural-key fact over the given as-of joined rows."""
    by = f"mat_sku{', ' + scope if scope else ''}"
    carried = f"{scope}, " if scope else ""
    return f"""
{name}_grouped AS (
  SELECT {carried}movement_date, mat_sku, ven_acc, sum(opening_qty) AS opening_qty, sum(received_qty) AS received_qty,
         sum(issued_qty) AS issued_qty, sum(closed_qty) AS closed_qty
  FROM {rows} GROUP BY {carried}movement_date, mat_sku, ven_acc),
{name}_daily AS (
  SELECT {by}, movement_date, sum(issued_qty) AS daily_issued FROM {name}_grouped GROUP BY {by}, movement_date),
{name}_rolling AS (
  SELECT *, avg(daily_issued) OVER (PARTITION BY {by} ORDER BY movement_date
            RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW) AS mean_30
  FROM {name}_daily),
{name}_measured AS (
  SELECT g.*, mean_30,
         sum(issued_qty) OVER (PARTITION BY {", ".join("g." + c.strip() for c in by.split(","))}) AS item_issued,
         avg(opening_qty) OVER (PARTITION BY {", ".join("g." + c.strip() for c in by.split(","))}) AS item_open
  FROM {name}_grouped g JOIN {name}_rolling r USING ({by}, movement_date)),
{name} AS (
  SELECT {carried}movement_date, mat_sku, ven_acc, opening_qty, received_qty, issued_qty, closed_qty,
         CASE WHEN opening_qty + received_qty > 0 AND closed_qty > 0
              THEN {_r2("closed_qty * 100.0 / (opening_qty + received_qty)")} ELSE 0.0 END AS stock_availability_pct,
         {_r2("greatest(0.0, closed_qty) * CAST(unit_cost AS DOUBLE)")} AS valuasi,
         {_r2("issued_qty * CAST(unit_cost AS DOUBLE)")} AS pengeluaran,
         CASE WHEN received_qty > issued_qty
              THEN {_r2("(received_qty - issued_qty) * 100.0 / received_qty")} ELSE 0.0 END AS wastage_ratio_pct,
         CASE WHEN item_open > 0 THEN {_r2("item_issued / item_open")} ELSE 0.0 END AS turnover_ratio,
         CASE WHEN mean_30 > 0 AND closed_qty > 0 THEN {_r2("closed_qty / mean_30")} ELSE 0.0 END AS stock_coverage_days
  FROM {name}_measured
  JOIN item ON mat_sku = medicine_sku JOIN vendor ON ven_acc = vendor_account JOIN calendar ON movement_date = full_date)"""


BASE = f"WITH {STAGES}, {_fact('fact', 'mapped')},\n"
STAR = (
    BASE
    + """star AS (
  SELECT f.*, i.medicine_name, i.type_description, i.unit_cost, v.vendor_name, c.year, c.month, c.month_name
  FROM fact f JOIN item i ON mat_sku = medicine_sku JOIN vendor v ON ven_acc = vendor_account
  JOIN calendar c ON movement_date = full_date),
newest AS (SELECT * FROM star WHERE movement_date = (SELECT max(full_date) FROM calendar))
"""
)
STAGED = f"WITH {STAGES}\n"
GROUPED = f"{BASE[:-2]}\n"

WIDE = f"""WITH wide AS (
  SELECT l_partkey AS "Medicine_ID", CAST(l_shipdate AS DATE) AS "Date", n_nationkey AS "Staff_ID",
         l_suppkey AS "Vendor_ID", o_custkey AS "Patient_ID",
         CAST({OPENED} AS BIGINT) AS "Opening_Qty", CAST({RECEIVED} AS BIGINT) AS "Received_Qty",
         CAST({ISSUED} AS BIGINT) AS "Issued_Qty",
         CAST(floor(l_extendedprice / l_quantity) AS BIGINT) AS "Unit_Cost",
         CAST({OPENED} + {RECEIVED} - {ISSUED} AS BIGINT) AS "Remaining_Qty",
         CAST({OPENED} + {RECEIVED} - {ISSUED} AS BIGINT) * CAST(floor(l_extendedprice / l_quantity) AS BIGINT) AS "Total_Value",
         p_name AS "Medicine_Name", p_type AS "Medicine_Type", n_name AS "Staff_Name", s_name AS "Vendor_Name",
         c_mktsegment AS "Age_Group"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
today AS (SELECT max("Date") AS d FROM wide),
recent AS (SELECT wide.* FROM wide, today WHERE "Date" BETWEEN d - 30 AND d),
chosen AS (
  SELECT wide.* FROM wide, today WHERE "Date" BETWEEN d - 900 AND d - 350
  AND "Medicine_Type" IN ('ECONOMY', 'PROMO', 'SMALL')
  AND "Vendor_Name" BETWEEN 'Supplier#000000000' AND 'Supplier#000000039')
"""


def _inputs() -> str:
    """Raw text columns with the defects of the text fixtures, counted."""
    junk = "count_if(l_tax = 0.01 AND l_discount = 0.01)"
    counts = [
        ("items", "COST_UN", "unreadable", "count_if(p_size = 9)", "part"),
        ("items", "EXP_MON", "unreadable", "count_if(p_size = 7)", "part"),
        ("items", "MED_ID", "missing_key", "0", "part"),
        ("vendors", "VEN_ACC", "missing_key", "0", "supplier"),
        ("supply", "MAT_SKU", "missing_key", "0", "lineitem WHERE l_returnflag = 'N'"),
        ("movements", "OPEN_QTY", "unreadable", junk, "lineitem WHERE l_returnflag <> 'N'"),
        ("movements", "RCVD_QTY", "unreadable", junk, "lineitem WHERE l_returnflag <> 'N'"),
        ("movements", "ISSD_QTY", "unreadable", junk, "lineitem WHERE l_returnflag <> 'N'"),
        ("movements", "CLSD_QTY", "unreadable", "0", "lineitem WHERE l_returnflag <> 'N'"),
        ("movements", "MAT_SKU", "missing_key", "count_if(l_tax = 0.07)", "lineitem WHERE l_returnflag <> 'N'"),
    ]
    parts = [
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{p}' AS problem, count(*) AS n_rows,"
        f" CAST({n} AS BIGINT) AS n_bad FROM {source}"
        for t, c, p, n, source in counts
    ]
    return "\nUNION ALL ".join(parts)


_PANELS = """
SELECT 'total_value' AS panel, 'all' AS label, CAST(coalesce(sum("Total_Value"), 0) AS BIGINT) AS value FROM chosen
UNION ALL SELECT 'critical_items', 'all', count(DISTINCT "Medicine_Name") FROM chosen WHERE "Issued_Qty" > "Remaining_Qty"
UNION ALL (SELECT 'top_items', "Medicine_Name", CAST(sum("Remaining_Qty") AS BIGINT) AS q FROM chosen
           GROUP BY "Medicine_Name" ORDER BY q DESC, "Medicine_Name" LIMIT 10)
UNION ALL SELECT 'demand', CAST("Date" AS VARCHAR), CAST(sum("Issued_Qty") AS BIGINT) FROM chosen GROUP BY "Date"
UNION ALL SELECT 'usage', "Age_Group", CAST(sum("Issued_Qty") AS BIGINT) FROM chosen GROUP BY "Age_Group"
UNION ALL SELECT 'vendors', "Vendor_Name", CAST(sum("Received_Qty") AS BIGINT) FROM chosen GROUP BY "Vendor_Name\""""


def _cards(rows: str) -> str:
    return f"""{WIDE}
SELECT CAST(coalesce(sum("Total_Value"), 0) AS BIGINT) AS total_inventory_value,
       CAST(coalesce(sum("Issued_Qty") FILTER (WHERE "Date" = (SELECT d FROM today)), 0) AS BIGINT) AS issued_today,
       CAST(coalesce(sum("Issued_Qty") FILTER (WHERE "Date" = (SELECT d FROM today)), 0)
          - coalesce(sum("Issued_Qty") FILTER (WHERE "Date" = (SELECT d - 1 FROM today)), 0) AS BIGINT) AS issued_delta,
       count(DISTINCT "Medicine_Name") FILTER (WHERE "Issued_Qty" > "Remaining_Qty") AS n_critical
FROM {rows}"""


STOCK = f"{_exact('opening_qty')} + {_exact('received_qty')} - {_exact('issued_qty')}"
LEFT_OVER = "(sum(opening_qty) + sum(received_qty) - sum(issued_qty))"

# Natural-key stand-ins for the surrogate columns of the checks.
_CHECKED = {
    "dim_item": (
        "item",
        ["medicine_sku", "medicine_name", "unit_cost"],
        {"medicine_sku": 20, "medicine_name": 100, "type_description": 100, "storage_type": 100},
        ["unit_cost"],
        {"medicine_sku": "medicine_sku"},
    ),
    "dim_vendor": (
        "vendor",
        ["vendor_account", "vendor_name"],
        {"vendor_account": 20, "vendor_name": 100, "vendor_type": 50, "country_name": 50, "vendor_status": 50},
        [],
        {"vendor_account": "vendor_account"},
    ),
    "dim_calendar": (
        "calendar",
        ["full_date", "year", "quarter", "month", "day"],
        {"month_name": 20, "day_of_week": 20},
        [],
        {"full_date": "full_date"},
    ),
    "fact_inventory": (
        "fact",
        [],
        {},
        [],
        {"date_id_fk+medicine_id_fk+vendor_id_fk": "movement_date, mat_sku, ven_acc"},
    ),
}
_MEASURES = [
    "opening_qty",
    "received_qty",
    "issued_qty",
    "closed_qty",
    "stock_availability_pct",
    "valuasi",
    "pengeluaran",
    "wastage_ratio_pct",
    "turnover_ratio",
    "stock_coverage_days",
]
_FACT_KEYS = {"date_id_fk": "movement_date", "medicine_id_fk": "mat_sku", "vendor_id_fk": "ven_acc"}
_PARENTS = {
    "date_id_fk": ("movement_date", "calendar", "full_date"),
    "medicine_id_fk": ("mat_sku", "item", "medicine_sku"),
    "vendor_id_fk": ("ven_acc", "vendor", "vendor_account"),
}


def _violations(rule: str, table: str, column: str, source: str, test: str) -> str:
    return (
        f"SELECT '{rule}' AS rule, '{table}' AS table_name, '{column}' AS column_name,"
        f" count(*) AS violations FROM {source} WHERE {test}"
    )


def _quality() -> str:
    parts = []
    for table, (source, required, lengths, amounts, unique) in _CHECKED.items():
        parts += [_violations("not_null", table, c, source, f"{c} IS NULL") for c in required]
        parts += [_violations("max_length", table, c, source, f"length({c}) > {n}") for c, n in lengths.items()]
        parts += [_violations("overflow", table, c, source, f"abs({c}) >= 1e16") for c in amounts]
        parts += [
            _violations("unique", table, label, f"(SELECT 1 FROM {source} GROUP BY {cols} HAVING count(*) > 1)", "true")
            for label, cols in unique.items()
        ]
    for column, natural in _FACT_KEYS.items():
        parts.append(_violations("not_null", "fact_inventory", column, "fact", f"{natural} IS NULL"))
    for measure in _MEASURES:
        limit = "1e3" if measure.endswith("_pct") else "1e16"
        parts.append(_violations("not_null", "fact_inventory", measure, "fact", f"{measure} IS NULL"))
        parts.append(_violations("overflow", "fact_inventory", measure, "fact", f"abs({measure}) >= {limit}"))
    for column, (natural, parent, key) in _PARENTS.items():
        test = f"{natural} NOT IN (SELECT {key} FROM {parent})"
        parts.append(_violations("reference", "fact_inventory", column, "fact", test))
    return GROUPED + "\nUNION ALL ".join(parts)


def _losses() -> str:
    parts = [
        _violations("reference", "grouped", natural, "fact_grouped", f"{natural} NOT IN (SELECT {key} FROM {parent})")
        for natural, parent, key in _PARENTS.values()
    ]
    return GROUPED + "\nUNION ALL ".join(parts)


def _accumulated() -> str:
    batches = ", ".join(
        f"mapped_{b} AS (SELECT * FROM mapped WHERE batch = '{b}'), {_fact('fact_' + b, 'mapped_' + b)}" for b in "AR"
    )
    return f"""{STAGED}, {batches},
added AS (
  SELECT movement_date, mat_sku, ven_acc, count(*) AS n,
         {", ".join(f"CAST(sum({_exact(m)}) AS DOUBLE) AS {m}" for m in [*_MEASURES[:4], "valuasi", "pengeluaran"])},
         max(stock_availability_pct) AS availability, max(wastage_ratio_pct) AS surplus
  FROM (SELECT * FROM fact_A UNION ALL SELECT * FROM fact_R) GROUP BY ALL),
daily AS (
  SELECT mat_sku, movement_date, sum(issued_qty) AS issued,
         sum(sum(issued_qty)) OVER (PARTITION BY mat_sku) AS item_issued,
         sum(sum(opening_qty)) OVER (PARTITION BY mat_sku) / sum(count(*)) OVER (PARTITION BY mat_sku) AS item_open
  FROM added GROUP BY mat_sku, movement_date),
rolled AS (
  SELECT *, avg(issued) OVER (PARTITION BY mat_sku ORDER BY movement_date
            RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW) AS mean_30 FROM daily)
SELECT movement_date, mat_sku, ven_acc, opening_qty, received_qty, issued_qty, closed_qty,
       CASE WHEN n = 1 THEN availability
            ELSE coalesce({_r2("closed_qty * 100.0 / nullif(opening_qty + received_qty, 0)")}, 0.0) END AS stock_availability_pct,
       valuasi, pengeluaran,
       CASE WHEN n = 1 THEN surplus
            ELSE coalesce({_r2("(received_qty - issued_qty) * 100.0 / nullif(received_qty, 0)")}, 0.0) END AS wastage_ratio_pct,
       CASE WHEN item_open > 0 THEN {_r2("item_issued / item_open")} ELSE 0.0 END AS turnover_ratio,
       CASE WHEN mean_30 > 0 AND closed_qty > 0 THEN {_r2("closed_qty / mean_30")} ELSE 0.0 END AS stock_coverage_days
FROM added JOIN rolled USING (mat_sku, movement_date)"""


def _batch_loads() -> str:
    """What each of three batches writes to the sums and dimensions, and a refused one."""
    first, rest = "batch = 'A'", "mat_sku < 'M5'"
    moves = {0: first, 1: f"NOT {first} AND NOT {rest}", 3: f"NOT {first} AND {rest}"}
    parts = [
        f"SELECT {n} AS batch_id, 'moves' AS table_name, count(*) AS n_rows, 'added' AS outcome"
        f" FROM (SELECT DISTINCT mat_sku, movement_date FROM movement WHERE {test})"
        for n, test in moves.items()
    ]
    parts += [
        f"SELECT {n}, '{table}', {f'(SELECT count(*) FROM {source})' if n == 0 else '0'}, 'added'"
        for n in moves
        for table, source in (("dim_item", "item"), ("dim_vendor", "vendor"))
    ]
    dates = "SELECT movement_date, min(CASE WHEN batch = 'A' THEN 0 WHEN mat_sku < 'M5' THEN 3 ELSE 1 END) AS n"
    parts += [
        f"SELECT {n}, 'dim_calendar', count(*), 'added' FROM ({dates} FROM movement GROUP BY movement_date) WHERE n = {n}"
        for n in moves
    ]
    parts.append("SELECT 2, NULL, NULL, 'refused'")
    return f"{STAGED}\n" + "\nUNION ALL ".join(parts)


ITEM_COLUMNS = (
    "medicine_sku, medicine_name, type_description, storage_type, CAST(unit_cost AS DOUBLE) AS unit_cost, expiration_months"
)
FACT_COLUMNS = "movement_date, mat_sku, ven_acc, " + ", ".join(_MEASURES)

ORACLE: dict[str, str] = {
    "dim_item": f"{STAGED} SELECT {ITEM_COLUMNS} FROM item",
    "dim_vendor": f"{STAGED} SELECT * FROM vendor",
    "dim_calendar": f"{STAGED} SELECT * FROM calendar",
    "surrogate_key_check": f"""{STAGED}
SELECT 'dim_item' AS table_name, count(*) AS n_rows, count(*) AS n_ids, 1 AS min_id, count(*) AS max_id FROM item
UNION ALL SELECT 'dim_vendor', count(*), count(*), 1, count(*) FROM vendor
UNION ALL SELECT 'dim_calendar', count(*), count(*), min(date_id_pk), max(date_id_pk) FROM calendar""",
    "movement_clean": f"{STAGED} SELECT mat_sku, movement_date, opening_qty, received_qty, issued_qty, closed_qty FROM movement",
    "supply_clean": f"{STAGED} SELECT * FROM supply",
    "asof_vendor": f"""{STAGED}
SELECT mat_sku, movement_date, opening_qty, received_qty, issued_qty, closed_qty, ven_acc FROM mapped""",
    "asof_vendor_interval": f"""{STAGED}
SELECT mat_sku, movement_date, opening_qty, received_qty, issued_qty, closed_qty, ven_acc FROM mapped""",
    "fact_grouped": f"{GROUPED} SELECT * FROM fact_grouped",
    "item_turnover": f"""{GROUPED}
SELECT mat_sku, sum(issued_qty) AS total_issued, {_r2("avg(opening_qty)")} AS avg_opening,
       CASE WHEN avg(opening_qty) > 0 THEN {_r2("sum(issued_qty) / avg(opening_qty)")} ELSE 0.0 END AS turnover_ratio
FROM fact_grouped GROUP BY mat_sku""",
    "rolling_usage": f"""{GROUPED}
SELECT mat_sku, movement_date, daily_issued, {_r2("mean_30")} AS avg_issued_30d FROM fact_rolling""",
    "coverage_days": f"""{GROUPED}
SELECT movement_date, mat_sku, ven_acc, closed_qty,
       CASE WHEN mean_30 > 0 AND closed_qty > 0 THEN {_r2("closed_qty / mean_30")} ELSE 0.0 END AS stock_coverage_days
FROM fact_measured""",
    "fact_inventory": f"{GROUPED} SELECT {FACT_COLUMNS} FROM fact",
    "fact_loaded": f"{GROUPED} SELECT {FACT_COLUMNS} FROM fact",
    "fact_per_file": f"""{STAGED}, {_fact("fact", "mapped", "source_file")}
SELECT source_file, {FACT_COLUMNS} FROM fact""",
    "kpi_raw_1": f"""{STAR}
SELECT medicine_name, type_description,
       {_r2(f"{LEFT_OVER} * 100.0 / nullif(sum(opening_qty) + sum(received_qty), 0)")} AS stock_availability_pct
FROM newest GROUP BY ALL ORDER BY stock_availability_pct ASC NULLS LAST, medicine_name, type_description LIMIT 10""",
    "kpi_raw_2": f"""{STAR}
SELECT type_description, CAST(sum({STOCK}) AS DOUBLE) AS current_stock_qty,
       CAST(round(sum(({STOCK}) * unit_cost * {CURRENCY_RATE}), 2) AS DOUBLE) AS total_valuasi_idr
FROM newest GROUP BY type_description ORDER BY total_valuasi_idr DESC NULLS FIRST, type_description""",
    "kpi_raw_3": f"""{STAR}
SELECT year, month, month_name, type_description, sum(issued_qty) AS total_qty_issued
FROM star GROUP BY ALL ORDER BY year, month, total_qty_issued DESC NULLS FIRST, type_description LIMIT 20""",
    "kpi_raw_4": f"""{STAR}
SELECT medicine_name, type_description, sum(issued_qty) AS total_issued, {_r2("avg(opening_qty)")} AS avg_opening,
       {_r2("sum(issued_qty) / nullif(avg(opening_qty), 0)")} AS turnover_ratio
FROM star GROUP BY ALL ORDER BY turnover_ratio DESC NULLS FIRST, medicine_name, type_description LIMIT 10""",
    "kpi_raw_5": f"""{STAR},
usage AS (
  SELECT mat_sku, avg(issued_qty) AS avg_issued FROM star
  WHERE movement_date >= (SELECT max(full_date) FROM calendar) - INTERVAL 30 DAYS GROUP BY mat_sku),
cover AS (
  SELECT medicine_name, type_description, {LEFT_OVER} / nullif(avg_issued, 0) AS days
  FROM newest JOIN usage USING (mat_sku) GROUP BY medicine_name, type_description, avg_issued)
SELECT medicine_name, type_description, {_r2("days")} AS coverage_days,
       CASE WHEN days > 30 THEN '{BAND_RAW[0]}' WHEN days BETWEEN 14 AND 30 THEN '{BAND_RAW[1]}'
            ELSE '{BAND_RAW[2]}' END AS status
FROM cover ORDER BY coverage_days ASC NULLS LAST, medicine_name, type_description, status LIMIT 15""",
    "kpi_raw_6": f"""{STAR}
SELECT type_description, vendor_name, sum(received_qty) AS total_received, sum(issued_qty) AS total_issued,
       {_r2("(sum(received_qty) - sum(issued_qty)) * 100.0 / nullif(sum(received_qty), 0)")} AS wastage_ratio_pct
FROM star GROUP BY ALL ORDER BY wastage_ratio_pct DESC NULLS FIRST, type_description, vendor_name LIMIT 15""",
    "kpi_mat_1": f"""{STAR}
SELECT medicine_name, type_description, stock_availability_pct FROM newest
ORDER BY stock_availability_pct ASC NULLS LAST, medicine_name, type_description LIMIT 10""",
    "kpi_mat_2": f"""{STAR}
SELECT type_description, CAST(round(sum({_exact("valuasi")} * {CURRENCY_RATE}), 2) AS DOUBLE) AS total_valuasi_idr
FROM newest GROUP BY type_description ORDER BY total_valuasi_idr DESC NULLS FIRST, type_description""",
    "kpi_mat_3": f"""{STAR}
SELECT year, month_name, type_description, sum(issued_qty) AS total_pengeluaran
FROM star GROUP BY year, month, month_name, type_description
ORDER BY year, month, total_pengeluaran DESC NULLS FIRST, type_description LIMIT 15""",
    "kpi_mat_4": f"""{STAR}
SELECT medicine_name, type_description, turnover_ratio FROM newest
ORDER BY turnover_ratio DESC NULLS FIRST, medicine_name, type_description LIMIT 10""",
    "kpi_mat_5": f"""{STAR}
SELECT medicine_name, type_description, stock_coverage_days,
       CASE WHEN stock_coverage_days > 30 THEN '{BAND_STORED[0]}'
            WHEN stock_coverage_days BETWEEN 14 AND 30 THEN '{BAND_STORED[1]}'
            ELSE '{BAND_STORED[2]}' END AS status
FROM newest WHERE stock_coverage_days > 0
ORDER BY stock_coverage_days ASC NULLS LAST, medicine_name, type_description LIMIT 15""",
    "kpi_mat_6": f"""{STAR}
SELECT type_description, vendor_name, wastage_ratio_pct FROM star WHERE wastage_ratio_pct > 0
ORDER BY wastage_ratio_pct DESC NULLS FIRST, type_description, vendor_name LIMIT 15""",
    "wide_fact": f"{WIDE} SELECT * FROM wide",
    "filtered_fact": f"{WIDE} SELECT * FROM recent",
    "filtered_cards": _cards("recent"),
    "dashboard_cards": _cards("wide"),
    "total_value": f"""{WIDE}
SELECT CAST(coalesce(sum("Total_Value"), 0) AS BIGINT) AS total_inventory_value FROM wide""",
    "issued_today_delta": f"""{WIDE}, days AS (
  SELECT CAST(coalesce(sum("Issued_Qty") FILTER (WHERE "Date" = d), 0) AS BIGINT) AS issued_today,
         CAST(coalesce(sum("Issued_Qty") FILTER (WHERE "Date" = d - 1), 0) AS BIGINT) AS issued_yesterday
  FROM wide, today)
SELECT *, issued_today - issued_yesterday AS issued_delta, abs(issued_today - issued_yesterday) AS issued_delta_abs FROM days""",
    "critical_items": f"""{WIDE}
SELECT count(DISTINCT "Medicine_Name") AS n_critical FROM wide WHERE "Issued_Qty" > "Remaining_Qty\"""",
    "top_items_by_stock": f"""{WIDE}
SELECT "Medicine_Name", CAST(sum("Remaining_Qty") AS BIGINT) AS "Remaining_Qty" FROM wide
GROUP BY "Medicine_Name" ORDER BY sum("Remaining_Qty") DESC, "Medicine_Name" LIMIT 10""",
    "demand_trend": f"""{WIDE}
SELECT "Date", CAST(sum("Issued_Qty") AS BIGINT) AS "Issued_Qty" FROM wide GROUP BY "Date" ORDER BY "Date\"""",
    "usage_by_segment": f"""{WIDE}
SELECT "Age_Group", CAST(sum("Issued_Qty") AS BIGINT) AS "Issued_Qty",
       {_r2('CAST(sum("Issued_Qty") AS DOUBLE) * 100.0 / (SELECT sum("Issued_Qty") FROM wide)')} AS share_pct
FROM wide GROUP BY "Age_Group" ORDER BY "Age_Group\"""",
    "vendor_received": f"""{WIDE}
SELECT "Vendor_Name", CAST(sum("Received_Qty") AS BIGINT) AS "Received_Qty" FROM wide
GROUP BY "Vendor_Name" ORDER BY sum("Received_Qty"), "Vendor_Name\"""",
    "filter_options": """
SELECT DISTINCT 'type' AS option_kind, p_type AS option_value FROM part
UNION ALL SELECT DISTINCT 'vendor', s_name FROM supplier ORDER BY 1, 2""",
    "dashboard_calendar": f"""{WIDE}, days AS (
  SELECT CAST(d - CAST(n AS INTEGER) AS DATE) AS "Date" FROM today, range(90) AS r(n))
SELECT "Date", CAST(day("Date") AS INTEGER) AS "Day", strftime("Date", '%B') AS "Month",
       CAST(year("Date") AS INTEGER) AS "Year", strftime("Date", '%A') AS "Day_of_Week",
       (SELECT CAST(coalesce(sum("Issued_Qty"), 0) AS BIGINT) FROM wide WHERE wide."Date" = days."Date") AS "Issued_Qty"
FROM days""",
    "filtered_selection": f"{WIDE} SELECT * FROM chosen",
    "filtered_panels": f"{WIDE} {_PANELS}",
    "upsert_overwrite": f"""{STAGED}
SELECT medicine_sku, medicine_name, type_description, storage_type, CAST(unit_cost AS DOUBLE) + 1 AS unit_cost,
       expiration_months, type_description <> 'ECONOMY' AS kept_id, false AS clashing_id FROM item""",
    "upsert_ignore": f"""{STAGED}
SELECT * REPLACE (CASE WHEN month <= 6 THEN upper(month_name) ELSE month_name END AS month_name) FROM calendar""",
    "accumulate_load": _accumulated(),
    "stream_daily": f"{GROUPED} SELECT * FROM fact_grouped",
    "star_incremental": f"{GROUPED} SELECT {FACT_COLUMNS} FROM fact",
    "stream_star": f"{GROUPED} SELECT {FACT_COLUMNS} FROM fact",
    "batch_quality": _quality(),
    "batch_loads": _batch_loads(),
    "item_buckets": f"""{STAGED}
SELECT medicine_sku, medicine_name, type_description, storage_type,
       CAST(unit_cost AS DOUBLE) + CASE WHEN medicine_sku = (SELECT min(medicine_sku) FROM item) THEN 1 ELSE 0 END AS unit_cost,
       expiration_months FROM item""",
    "append_load": f"""{STAGED}, daily AS (
  SELECT batch, mat_sku, movement_date, sum(issued_qty) AS issued_qty FROM movement GROUP BY ALL)
SELECT batch, count(*) AS n_rows, count(*) AS n_written, sum(issued_qty) AS issued_qty FROM daily GROUP BY batch""",
    "catalog_tables": f"""{GROUPED}
SELECT 'dim_item' AS table_name, count(*) AS n_rows FROM item UNION ALL SELECT 'dim_vendor', count(*) FROM vendor
UNION ALL SELECT 'dim_calendar', count(*) FROM calendar UNION ALL SELECT 'fact_inventory', count(*) FROM fact
UNION ALL SELECT 'joined', count(*) FROM fact""",
    "fact_from_csv": f"{GROUPED} SELECT {FACT_COLUMNS} FROM fact",
    "input_report": _inputs(),
    "quality_report": _quality(),
    "lookup_losses": _losses(),
}
ORACLE |= {f"sums_{name}": ORACLE[name] for name in ("kpi_raw_3", "kpi_raw_4", "kpi_raw_6", "kpi_mat_3")}
ORACLE |= {
    "rollup_panels": ORACLE["filtered_panels"],
    "rollup_cards": ORACLE["filtered_cards"],
    "rollup_critical_items": ORACLE["critical_items"],
}
