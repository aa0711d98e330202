"""For each query, SQL that states its result over the given tables.

Written for DuckDB and independent of the Spark code: the raw rows, the choice of members
and every count are said again here in SQL.
"""

from __future__ import annotations


def _padded(number: str, width: int) -> str:
    """At least ``width`` digits; a plain lpad would cut longer numbers."""
    text = f"CAST({number} AS VARCHAR)"
    return f"lpad({text}, CAST(greatest(length({text}), {width}) AS INTEGER), '0')"


RAW = f"""raw AS (
  SELECT CAST(year(l_shipdate) AS VARCHAR) AS period,
    {_padded('l_suppkey', 6)} AS supp_cd,
    concat('  ', s_name, ' ') AS supp_name,
    {_padded('s_suppkey * 7919', 14)} AS supp_tax_id,
    concat(sn.n_name, CASE WHEN year(l_shipdate) < 1998 THEN '_OLD' ELSE '' END) AS supp_class,
    r_name AS region,
    CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE {_padded('cn.n_nationkey', 4)} END AS city_cd,
    concat(' ', cn.n_name) AS city_name,
    {_padded('CAST(floor((p_size - 1) / 5) AS INTEGER)', 2)} AS band,
    CAST(CAST(floor((p_size - 1) / 10) AS INTEGER) AS VARCHAR) AS band_group,
    CASE WHEN l_orderkey % 101 = 0 THEN 'n/a'
      ELSE concat(' ', CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)) END AS qty_active,
    CAST(l_linenumber AS VARCHAR) AS qty_joined,
    CASE WHEN l_returnflag = 'R' THEN '1' ELSE '0' END AS qty_left,
    CASE WHEN l_orderkey % 103 = 0 THEN '31/12/1999'
      ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS load_dt
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation cn ON c_nationkey = cn.n_nationkey
  JOIN region ON cn.n_regionkey = r_regionkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation sn ON s_nationkey = sn.n_nationkey
  JOIN part ON l_partkey = p_partkey)"""

NUMBER = "CASE WHEN regexp_full_match(trim({0}), '[+-]?[0-9]+') THEN TRY_CAST(trim({0}) AS INTEGER) END"

CLEAN = f"""{RAW}, clean AS (
  SELECT trim(period) AS period, trim(supp_cd) AS supp_cd, trim(supp_name) AS supp_name,
    trim(supp_tax_id) AS supp_tax_id, trim(supp_class) AS supp_class, trim(region) AS region,
    trim(city_cd) AS city_cd, trim(city_name) AS city_name, trim(band) AS band,
    trim(band_group) AS band_group,
    {NUMBER.format('qty_active')} AS qty_active,
    {NUMBER.format('qty_joined')} AS qty_joined,
    {NUMBER.format('qty_left')} AS qty_left,
    CASE WHEN regexp_full_match(load_dt, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN CAST(load_dt AS DATE) END AS load_dt
  FROM raw)"""


def _latest(name: str, rows: str, bk: str, attributes: list[str], where: str = "TRUE") -> str:
    """Per key the latest period, then the greatest attributes."""
    order = ", ".join(["period DESC", *[f"{a} DESC NULLS LAST" for a in attributes]])
    columns = ", ".join([bk, *attributes])
    return (
        f"{name} AS (SELECT {columns} FROM (SELECT {columns}, "
        f"row_number() OVER (PARTITION BY {bk} ORDER BY {order}) AS rn FROM {rows} WHERE {where}) WHERE rn = 1)"
    )


SUPPLIERS = _latest("suppliers", "clean", "supp_cd", ["supp_name", "supp_tax_id", "supp_class"])
CITIES = _latest("cities", "clean", "city_cd", ["city_name", "region"])
BANDS = _latest("bands", "clean", "band", ["band_group"])

STAR = f"""{CLEAN}, {SUPPLIERS}, {CITIES}, {BANDS}, star AS (
  SELECT c.region, c.period, s.supp_cd, s.supp_name, s.supp_tax_id, s.supp_class, m.city_cd, m.city_name,
    b.band, b.band_group, c.qty_active, c.qty_joined, c.qty_left
  FROM clean c
  LEFT JOIN suppliers s ON c.supp_cd = s.supp_cd
  LEFT JOIN cities m ON c.city_cd = m.city_cd
  LEFT JOIN bands b ON c.band = b.band)"""

HISTORY = f"""history AS (
  SELECT CAST(year(o_orderdate) AS VARCHAR) AS period,
    CASE WHEN o_orderkey % 97 <> 0 THEN concat({_padded('c_custkey', 9)},
      CASE WHEN c_custkey % 11 = 0 AND year(o_orderdate) >= 1998 THEN 'B' ELSE '' END) END AS cust_cd,
    c_name AS cust_name,
    CASE WHEN c_custkey % 10 = 0 THEN concat(c_mktsegment, '_', CAST(year(o_orderdate) AS VARCHAR))
      ELSE c_mktsegment END AS segment,
    CASE WHEN c_custkey % 7 <> 0 OR year(o_orderdate) >= 1998
      THEN {_padded('c_nationkey', 4)} END AS city_cd
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

CUSTOMER_ATTRIBUTES = ["cust_name", "segment", "city_cd"]
BATCHES = ", ".join(
    [
        HISTORY,
        _latest("old", "history", "cust_cd", CUSTOMER_ATTRIBUTES, "period < '1998'"),
        _latest("new", "history", "cust_cd", CUSTOMER_ATTRIBUTES, "period >= '1998'"),
    ]
)
# Each member of either batch once, keys compared null-safely.
PAIRED = f"""{BATCHES}, paired AS (
  SELECT coalesce(o.cust_cd, n.cust_cd) AS cust_cd, o.k IS NULL AS is_new, n.k IS NULL AS is_gone,
    o.cust_name AS o_name, o.segment AS o_segment, o.city_cd AS o_city,
    n.cust_name AS n_name, n.segment AS n_segment, n.city_cd AS n_city
  FROM (SELECT *, coalesce(cust_cd, '-') AS k FROM old) o
  FULL OUTER JOIN (SELECT *, coalesce(cust_cd, '-') AS k FROM new) n ON o.k = n.k),
changes AS (
  SELECT *, NOT is_new AND NOT is_gone AND
      (o_name IS DISTINCT FROM n_name OR o_segment IS DISTINCT FROM n_segment OR o_city IS DISTINCT FROM n_city)
      AS changed_safe,
    NOT is_new AND NOT is_gone AND (
      coalesce(o_name <> n_name, FALSE) OR coalesce(o_segment <> n_segment, FALSE)
      OR coalesce(o_city <> n_city, FALSE)) AS changed_plain
  FROM paired)"""


def _merged(flag: str) -> str:
    takes_new = f"is_new OR {flag}"
    return (
        f"CASE WHEN {takes_new} THEN n_name ELSE o_name END AS cust_name, "
        f"CASE WHEN {takes_new} THEN n_segment ELSE o_segment END AS segment, "
        f"CASE WHEN {takes_new} THEN n_city ELSE o_city END AS city_cd"
    )


UNKNOWN_FLAGS = """CAST(supp_cd IS NULL AS INTEGER) AS no_supp_cd, CAST(city_cd IS NULL AS INTEGER) AS no_city_cd,
    CAST(band IS NULL AS INTEGER) AS no_band"""
FACT = f"WITH {CLEAN} SELECT region, period, qty_active, qty_joined, qty_left, {UNKNOWN_FLAGS} FROM clean"
STAR_ROWS = f"WITH {STAR} SELECT * FROM star"
REGION_TOTALS = """SELECT region, count(*) AS n_rows, CAST(sum(qty_active) AS BIGINT) AS qty_active,
  CAST(sum(qty_joined) AS BIGINT) AS qty_joined, CAST(sum(qty_left) AS BIGINT) AS qty_left FROM clean GROUP BY region"""

# What the clean table declares: name, type, comment, whether it partitions the table.
CLEAN_TABLE = [
    ("period", "string", "Shipping year", 1),
    ("supp_cd", "string", "Supplier code", 0),
    ("supp_name", "string", "Supplier name", 0),
    ("supp_tax_id", "string", "Supplier tax id, leading zeros kept", 0),
    ("supp_class", "string", "Supplier class, changes over the years", 0),
    ("region", "string", "Customer region", 1),
    ("city_cd", "string", "Customer city code, sometimes missing", 0),
    ("city_name", "string", "Customer city name", 0),
    ("band", "string", "Part size band", 0),
    ("band_group", "string", "Group of part size bands", 0),
    ("qty_active", "int", "Quantity ordered", 0),
    ("qty_joined", "int", "Line number", 0),
    ("qty_left", "int", "1 when returned", 0),
    ("load_dt", "date", "Shipping date", 0),
]


def _declared(name: str, dtype: str, comment: str, partitions: int, counted: str) -> str:
    return (
        f"SELECT '{name}' AS column_name, '{dtype}' AS data_type, '{comment}' AS comment, "
        f"CAST({partitions} AS INTEGER) AS is_partition, count({counted}) AS n_values FROM clean"
    )


def _rows(table: str, key: str) -> str:
    return f"(SELECT count(*) FROM (SELECT DISTINCT {key} FROM {table}))"


def _step(name: str, read: str, written: str, inserted: str, updated: str, partitions: str) -> str:
    return (
        f"SELECT '{name}' AS step, 'success' AS status, CAST({read} AS BIGINT) AS rows_read, "
        f"CAST({written} AS BIGINT) AS rows_written, CAST({inserted} AS BIGINT) AS rows_inserted, "
        f"CAST({updated} AS BIGINT) AS rows_updated, '{partitions}' AS partition_by"
    )


ALL_ROWS = "(SELECT count(*) FROM clean)"
DIMENSION_KEYS = {"dim_supplier": "supp_cd", "dim_city": "city_cd", "dim_band": "band"}
RUN_STEPS = [
    _step(n, read, ALL_ROWS, "NULL", "NULL", "region,period")
    for n, read in (("raw_lines", "NULL"), ("clean_lines", ALL_ROWS), ("fact_lines", ALL_ROWS))
]
RUN_STEPS += [
    _step(n, _rows("clean", k), _rows("clean", k), _rows("clean", k), "0", "") for n, k in DIMENSION_KEYS.items()
]

GUARDED = [
    f"SELECT '{source}' AS input, '{step}' AS step, '{status}' AS status, "
    f"CAST({rows} AS BIGINT) AS rows_read, CAST({rows} AS BIGINT) AS rows_written"
    for source, status, rows in (("empty", "no data", "0"), ("full", "success", ALL_ROWS))
    for step in ("clean_lines", "fact_lines")
]



def _late_codes() -> str:
    """From 1998 on, codes that end in 3 are replaced by new ones."""
    return ", ".join(
        f"CASE WHEN period >= '1998' AND {c} LIKE '%3' THEN concat({c}, 'N') ELSE {c} END AS {c}" for c in ("supp_cd", "city_cd", "band")
    )


# Suppliers whose code ends in 7 have another one from 1998 on.
RECODED = """SELECT * REPLACE (CASE WHEN period >= '1998' AND supp_cd LIKE '%7' THEN concat('0', supp_cd) ELSE supp_cd END AS supp_cd)
    FROM clean"""

LINE_COLUMNS = (
    "period supp_cd supp_name supp_tax_id supp_class region city_cd city_name band band_group "
    "qty_active qty_joined qty_left load_dt"
).split()


def _line_length(columns: list[str]) -> str:
    """Characters of a line of quoted fields between separators."""
    return " + ".join(f"coalesce(length({c}), 0)" for c in columns) + f" + {3 * len(columns) - 1}"


def _profiled(column: str) -> str:
    """Counts and extremes of a column: of its numbers, its days since 1970 or the lengths of its texts."""
    number = f"CAST({column} AS BIGINT)" if column.startswith("qty_") else f"CAST(length({column}) AS BIGINT)"
    number = f"CAST(date_diff('day', DATE '1970-01-01', {column}) AS BIGINT)" if column == "load_dt" else number
    return f"""SELECT '{column}' AS column_name, CAST(count(*) AS BIGINT) AS n_rows, count({column}) AS n_values, min({number}) AS least,
          max({number}) AS greatest, count(DISTINCT {column}) AS n_distinct, CAST(1 AS INTEGER) AS distinct_ok,
          CAST(1 AS INTEGER) AS median_ok, CAST(1 AS INTEGER) AS top_ok FROM again"""


TOP_SUPPLIERS = f"""WITH {STAR}
    SELECT supp_cd, supp_name, supp_class, CAST(sum(qty_active) AS BIGINT) AS total_active
    FROM star GROUP BY supp_cd, supp_name, supp_class
    ORDER BY total_active DESC NULLS LAST, supp_cd NULLS LAST, supp_name NULLS LAST, supp_class NULLS LAST
    LIMIT 5"""

ORACLE: dict[str, str] = {
    "ingest_delimited": f"WITH {RAW} SELECT * FROM raw",
    "shard_rows": f"WITH {RAW} SELECT concat(region, '-', period) AS shard, count(*) AS n_rows FROM raw GROUP BY 1",
    "partition_overwrite_rerun": f"WITH {RAW} SELECT region, period, count(*) AS n_rows FROM raw GROUP BY ALL",
    "partition_overwrite_replace": f"""WITH {RAW}
        SELECT region, period, CAST(sum(CASE WHEN region = 'ASIA' AND period >= '1998' THEN 2 ELSE 1 END
          * CAST(qty_joined AS INTEGER)) AS BIGINT) AS joined
        FROM raw GROUP BY region, period""",
    "schema_lock": f"""WITH {RAW}
        SELECT region, count(*) AS n_rows, CAST(2 AS INTEGER) AS refused FROM raw GROUP BY region""",
    "table_catalog": f"WITH {CLEAN} " + " UNION ALL ".join(_declared(*c, counted=c[0]) for c in CLEAN_TABLE)
    + " UNION ALL " + _declared("loaded_at", "timestamp", "When the row was written", 0, "*"),
    "catalog_star_view": f"""WITH {STAR}
        SELECT region, supp_class, band_group, CAST(sum(qty_active) AS BIGINT) AS active,
          CAST(sum(qty_left) AS BIGINT) AS gone FROM star GROUP BY region, supp_class, band_group""",
    "named_views": f"""WITH {STAR}
        SELECT period, city_name, count(*) AS n_rows, CAST(sum(qty_active) AS BIGINT) AS active
        FROM star GROUP BY period, city_name""",
    "clean_typed": f"WITH {CLEAN} SELECT * FROM clean",
    "clean_bad_values": f"""WITH {CLEAN}
        SELECT region, count(*) AS n_rows, count(*) FILTER (qty_active IS NULL) AS bad_numbers,
          count(*) FILTER (load_dt IS NULL) AS bad_dates FROM clean GROUP BY region""",
    "legacy_int_parse": """
        SELECT l_linenumber AS form, count(*) AS n_rows,
          count(*) FILTER (l_linenumber <= 5 AND (l_linenumber = 4 OR TRY_CAST(l_orderkey AS INTEGER) IS NOT NULL)) AS n_read,
          CAST(sum(CASE WHEN l_linenumber IN (1, 2, 5) THEN TRY_CAST(l_orderkey AS INTEGER)
            WHEN l_linenumber = 3 THEN -TRY_CAST(l_orderkey AS INTEGER) WHEN l_linenumber = 4 THEN 0 END) AS BIGINT) AS total
        FROM lineitem GROUP BY l_linenumber""",
    "surrogate_key": """
        WITH codes AS (
          SELECT 'order' AS kind, l_orderkey AS k FROM lineitem UNION SELECT 'part', l_partkey FROM lineitem
          UNION SELECT 'supplier', l_suppkey FROM lineitem UNION SELECT 'customer', o_custkey FROM orders)
        SELECT kind, count(*) AS n_keys, count(*) AS n_surrogates, CAST(0 AS BIGINT) AS n_negative
        FROM codes GROUP BY kind""",
    "dim_supplier": f"WITH {CLEAN}, {SUPPLIERS} SELECT * FROM suppliers",
    "dim_city": f"WITH {CLEAN}, {CITIES} SELECT * FROM cities",
    "dim_band": f"WITH {CLEAN}, {BANDS} SELECT * FROM bands",
    "scd1_initial": f"WITH {HISTORY}, {_latest('members', 'history', 'cust_cd', CUSTOMER_ATTRIBUTES)} SELECT * FROM members",
    "scd1_update": f"""WITH {PAIRED}
        SELECT cust_cd, {_merged('changed_safe')}, CAST(is_new AS INTEGER) AS is_new,
          CAST(changed_safe AS INTEGER) AS was_updated FROM changes""",
    "scd1_null_attr": f"""WITH {PAIRED}
        SELECT 'plain' AS mode, cust_cd, {_merged('changed_plain')} FROM changes WHERE cust_cd IS NOT NULL
        UNION ALL
        SELECT 'null_safe' AS mode, cust_cd, {_merged('changed_safe')} FROM changes WHERE cust_cd IS NOT NULL""",
    "scd1_null_key": f"""WITH {PAIRED}
        SELECT 'null_safe' AS mode, count(*) AS n_rows, count(*) FILTER (cust_cd IS NULL) AS null_keys FROM changes
        UNION ALL
        SELECT 'plain' AS mode, count(*) + 1 AS n_rows, count(*) FILTER (cust_cd IS NULL) + 1 AS null_keys
        FROM changes""",
    "scd1_idempotent": """
        WITH n AS (SELECT count(DISTINCT l_suppkey) AS k FROM lineitem)
        SELECT CAST(1 AS BIGINT) AS version, k AS rows_source, k AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated,
          k AS rows_total FROM n
        UNION ALL SELECT 2, k, 0, 0, k FROM n""",
    "merge_metrics": f"""WITH {PAIRED}
        SELECT 'dim_customer' AS table_name, CAST(1 AS BIGINT) AS version, 'MERGE' AS operation,
          count(*) FILTER (NOT is_new) AS rows_source, count(*) FILTER (NOT is_new) AS rows_inserted,
          CAST(0 AS BIGINT) AS rows_updated, count(*) FILTER (NOT is_new) AS rows_total FROM changes
        UNION ALL
        SELECT 'dim_customer', 2, 'MERGE', count(*) FILTER (NOT is_gone), count(*) FILTER (is_new),
          count(*) FILTER (changed_safe), count(*) FROM changes""",
    "scd1_buckets": f"""WITH {PAIRED}, merged AS (SELECT cust_cd, {_merged('changed_safe')} FROM changes)
        SELECT cust_cd, CASE WHEN cust_cd = (SELECT min(cust_cd) FROM merged) THEN 'renamed' ELSE cust_name END AS cust_name,
          segment, city_cd FROM merged""",
    "merge_buckets": f"""WITH {PAIRED}, n AS (
          SELECT count(*) FILTER (NOT is_new) AS n_old, count(*) FILTER (NOT is_gone) AS n_new, count(*) FILTER (is_new) AS n_added,
            count(*) FILTER (changed_safe) AS n_changed, count(*) AS n_all FROM changes)
        SELECT CAST(1 AS BIGINT) AS version, n_old AS rows_source, n_old AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated,
          CAST(0 AS BIGINT) AS rows_rekeyed, n_old AS rows_total, CAST(NULL AS BIGINT) AS few_rewritten, CAST(0 AS INTEGER) AS in_buckets FROM n
        UNION ALL SELECT 2, n_new, n_added, n_changed, 0, n_all, NULL, 1 FROM n
        UNION ALL SELECT 3, n_new, 0, 0, 0, n_all, 0, 1 FROM n
        UNION ALL SELECT 4, 1, 0, 1, 0, n_all, 1, 1 FROM n""",
    "change_feed": f"""WITH {PAIRED}
        SELECT CAST(1 AS BIGINT) AS version, 'insert' AS operation, cust_cd, CAST(NULL AS VARCHAR) AS cust_name_before,
          CAST(NULL AS VARCHAR) AS segment_before, CAST(NULL AS VARCHAR) AS city_cd_before,
          o_name AS cust_name_after, o_segment AS segment_after, o_city AS city_cd_after FROM changes WHERE NOT is_new
        UNION ALL SELECT 2, CASE WHEN is_new THEN 'insert' ELSE 'update' END, cust_cd, o_name, o_segment, o_city, n_name, n_segment, n_city
        FROM changes WHERE is_new OR changed_safe""",
    "replayed_versions": f"""WITH {PAIRED}
        SELECT CAST(1 AS INTEGER) AS version, cust_cd, o_name AS cust_name, o_segment AS segment, o_city AS city_cd FROM changes WHERE NOT is_new
        UNION ALL SELECT 2, cust_cd, {_merged('changed_safe')} FROM changes""",
    "shared_hash_keys": f"""WITH {CLEAN}, recoded AS ({RECODED})
        SELECT supp_cd, CAST(1 AS INTEGER) AS same_key, CAST(1 AS BIGINT) AS n_with_key, CAST(sum(qty_active) AS BIGINT) AS total_active,
          CAST(sum(qty_active) AS BIGINT) AS total_again FROM recoded GROUP BY supp_cd""",
    "shared_hash_facts": f"""WITH {CLEAN}, recoded AS ({RECODED})
        SELECT supp_cd, city_cd, band, CAST(sum(qty_joined) AS BIGINT) AS total FROM recoded GROUP BY supp_cd, city_cd, band""",
    "rollup_ranking": f"""WITH {STAR}, doubled AS (
          SELECT *, CASE WHEN period = '1995' THEN 2 ELSE 1 END * qty_joined AS joined FROM star)
        SELECT 'supplier' AS by, supp_cd AS who, CAST(sum(joined) AS BIGINT) AS total FROM doubled GROUP BY supp_cd, supp_class
        UNION ALL SELECT 'band', concat_ws('/', region, band), CAST(sum(joined) AS BIGINT) FROM doubled GROUP BY region, band""",
    "rollup_renewal": f"""WITH {CLEAN}
        SELECT period, count(*) AS n_rows, CAST(period = '1995' AS INTEGER) AS is_new FROM clean GROUP BY period""",
    "numbered_ranking": f"""WITH {STAR}, totals AS (
          SELECT supp_cd, city_cd, CAST(sum(qty_active) AS BIGINT) AS total_active FROM star GROUP BY supp_cd, city_cd)
        SELECT supp_cd, city_cd, total_active,
          row_number() OVER (ORDER BY total_active DESC NULLS LAST, supp_cd NULLS LAST, city_cd NULLS LAST) AS place,
          rank() OVER (ORDER BY total_active DESC NULLS LAST) AS rank, dense_rank() OVER (ORDER BY total_active DESC NULLS LAST) AS dense_rank,
          total_active / CAST(sum(total_active) OVER () AS BIGINT) AS share FROM totals""",
    "fact_rows": FACT,
    "fact_rows_large_dims": FACT,
    "fact_unknown_members": f"""WITH fact AS ({FACT})
        SELECT region, count(*) AS n_rows, CAST(sum(no_supp_cd) AS BIGINT) AS no_supp_cd,
          CAST(sum(no_city_cd) AS BIGINT) AS no_city_cd, CAST(sum(no_band) AS BIGINT) AS no_band
        FROM fact GROUP BY region""",
    "star_view": STAR_ROWS,
    "star_view_large_dims": STAR_ROWS,
    "star_view_cobucketed": STAR_ROWS,
    "top_suppliers_cobucketed": TOP_SUPPLIERS,
    "cobuckets_renewal": f"""WITH {STAR}
        SELECT period, supp_cd, supp_class, CAST(sum(CASE WHEN period = '1995' THEN 2 ELSE 1 END * qty_joined) AS BIGINT) AS total_joined
        FROM star GROUP BY period, supp_cd, supp_class""",
    "top_suppliers": TOP_SUPPLIERS,
    "top_band": f"""WITH {STAR}
        SELECT band, CAST(sum(qty_active) AS BIGINT) AS total_active FROM star GROUP BY band
        ORDER BY total_active DESC NULLS LAST, band NULLS LAST LIMIT 1""",
    "city_ranking": f"""WITH {STAR}
        SELECT city_cd, city_name, region, CAST(sum(qty_active) AS BIGINT) AS total_active
        FROM star GROUP BY city_cd, city_name, region
        ORDER BY total_active DESC NULLS LAST, city_cd NULLS LAST, city_name NULLS LAST, region NULLS LAST""",
    "city_ranking_large_dims": f"""WITH {STAR}
        SELECT city_cd, city_name, region, CAST(sum(qty_active) AS BIGINT) AS total_active
        FROM star GROUP BY city_cd, city_name, region
        ORDER BY total_active DESC NULLS LAST, city_cd NULLS LAST, city_name NULLS LAST, region NULLS LAST""",
    "top_suppliers_large_dims": TOP_SUPPLIERS,
    "empty_input_guard": f"WITH {CLEAN} " + " UNION ALL ".join(GUARDED),
    "run_report": f"WITH {CLEAN} " + " UNION ALL ".join(RUN_STEPS),
    "full_load_twice": f"WITH {CLEAN} {REGION_TOTALS}",
    "ingest_mixed_shards": f"WITH {RAW} SELECT region, period, count(*) AS n_rows FROM raw GROUP BY ALL",
    "fact_late_members": f"""WITH {CLEAN}, coded AS (SELECT region, period < '1998' AS early, {_late_codes()} FROM clean),
        known AS (SELECT * FROM coded WHERE early)
        SELECT region, count(*) AS n_rows,
          count(*) FILTER (supp_cd IS NULL OR supp_cd NOT IN (SELECT supp_cd FROM known WHERE supp_cd IS NOT NULL)) AS no_supp_cd,
          count(*) FILTER (city_cd IS NULL OR city_cd NOT IN (SELECT city_cd FROM known WHERE city_cd IS NOT NULL)) AS no_city_cd,
          count(*) FILTER (band IS NULL OR band NOT IN (SELECT band FROM known WHERE band IS NOT NULL)) AS no_band
        FROM coded GROUP BY region""",
    "screened_rows": f"""WITH {RAW} SELECT * FROM raw WHERE region <> 'EUROPE' AND qty_joined NOT IN ('6', '7')""",
    "quarantined_rows": f"""WITH {RAW}, lines AS (
          SELECT concat(region, '-', period) AS shard, CASE WHEN region = 'EUROPE' THEN 'header' WHEN qty_joined = '6' THEN 'short'
            WHEN qty_joined = '7' THEN 'long' END AS fault,
            {_line_length(LINE_COLUMNS)} AS whole, {_line_length(LINE_COLUMNS[:-2])} AS cut FROM raw)
        SELECT shard, fault, count(*) AS n_rows,
          CAST(sum(CASE fault WHEN 'header' THEN whole WHEN 'short' THEN cut ELSE whole + 10 END) AS BIGINT) AS n_chars
        FROM lines WHERE fault IS NOT NULL GROUP BY shard, fault""",
    "incremental_intake": f"""WITH {RAW}
        SELECT region, period, count(*) AS n_rows, CAST(CASE WHEN period < '1998' THEN 1 ELSE 2 END AS INTEGER) AS run,
          CAST(sum(CAST(qty_joined AS INTEGER)) AS BIGINT) AS joined,
          CAST((SELECT count(*) FROM raw WHERE period < '1998') AS INTEGER) AS rows_first,
          CAST((SELECT count(*) FROM raw WHERE period >= '1998') AS INTEGER) AS rows_second,
          CAST(0 AS INTEGER) AS rows_third, CAST(0 AS INTEGER) AS files_third
        FROM raw GROUP BY region, period""",
    "clustered_layout": f"""WITH {CLEAN}
        SELECT 'dim_supplier' AS dimension, supp_cd AS code, count(*) AS n_rows, CAST(sum(qty_joined) AS BIGINT) AS joined,
          CAST(1 AS INTEGER) AS fewer_files FROM clean GROUP BY supp_cd
        UNION ALL SELECT 'dim_city', city_cd, count(*), CAST(sum(qty_joined) AS BIGINT), 1 FROM clean GROUP BY city_cd""",
    "column_profile": f"""WITH {CLEAN}, again AS (
          SELECT * REPLACE (CASE WHEN period = '1995' THEN 2 ELSE 1 END * qty_joined AS qty_joined) FROM clean)
        """ + " UNION ALL ".join(_profiled(c) for c in LINE_COLUMNS),
    "reload_old_period": f"""WITH {CLEAN}, again AS (
          SELECT * REPLACE (CASE WHEN period = '1995' THEN concat(supp_name, ' II') ELSE supp_name END AS supp_name) FROM clean),
        {_latest("suppliers", "again", "supp_cd", ["supp_name", "supp_tax_id", "supp_class"])},
        renamed AS (SELECT supp_cd, count(*) AS n FROM again WHERE supp_name LIKE '% II' GROUP BY supp_cd)
        SELECT supp_cd, supp_name, supp_class, coalesce(n, 0) AS n_renamed FROM suppliers LEFT JOIN renamed USING (supp_cd)""",
    "questions_in_sql": f"""WITH {STAR}, asked AS (
          (SELECT 'suppliers' AS question, supp_cd AS who, CAST(sum(qty_active) AS BIGINT) AS total
            FROM star GROUP BY supp_cd, supp_name, supp_class ORDER BY total DESC NULLS LAST, supp_cd NULLS LAST LIMIT 5)
          UNION ALL
          (SELECT 'band', band, CAST(sum(qty_active) AS BIGINT) AS total FROM star GROUP BY band
            ORDER BY total DESC NULLS LAST, band NULLS LAST LIMIT 1)
          UNION ALL
          (SELECT 'cities', city_cd, CAST(sum(qty_active) AS BIGINT) FROM star GROUP BY city_cd, city_name, region))
        SELECT * FROM asked""",
    "load_by_periods": f"""WITH {STAR}
        SELECT region, supp_class, CAST(sum(qty_active) AS BIGINT) AS total_active
        FROM star GROUP BY region, supp_class""",
}
