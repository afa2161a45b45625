"""The registered queries as SQL over the same tables."""

from __future__ import annotations

PLACES = """
places AS (
    SELECT *,
        CASE WHEN o_custkey % 10 = 0 THEN NULL
             ELSE CAST((o_orderkey * 7919) % 17999 AS DOUBLE) / CAST(100 AS DOUBLE)
                  - CAST(89.993 AS DOUBLE) END AS lat,
        CAST((o_orderkey * 104729) % 35999 AS DOUBLE) / CAST(100 AS DOUBLE)
            - CAST(179.993 AS DOUBLE) AS lon
    FROM orders
)
"""


def cell(level: int) -> str:
    rows, columns = 2**level, 2 ** (level + 1)
    return f"""
        CASE WHEN lat IS NULL THEN NULL ELSE
            CAST({level} AS BIGINT) * CAST({2**58} AS BIGINT)
            + least(CAST(floor((sin(radians(lat)) + 1) / 2 * {rows}) AS BIGINT),
                    CAST({rows - 1} AS BIGINT)) * CAST({2**29} AS BIGINT)
            + CAST(floor((lon + 180) / 360 * {columns}) AS BIGINT) % CAST({columns} AS BIGINT)
        END
    """


ADDRESS = """
    '{"status":"' || o_orderstatus || '","prio":"' || o_orderpriority || '"'
    || CASE WHEN o_custkey % 10 = 0 THEN '' ELSE ',"cust":' || CAST(o_custkey % 10 AS VARCHAR) END
    || '}'
"""
GEOCODES = """
    '{"mainEntry":{'
    || CASE WHEN lat IS NULL THEN '' ELSE '"latitude":' || CAST(lat AS VARCHAR) || ',' END
    || '"longitude":' || CAST(lon AS VARCHAR) || '}}'
"""
CATEGORIES = """ '["' || o_orderstatus || '","' || o_orderpriority || '"]' """
JSON_COLUMNS = f"""
    CAST(o_orderkey AS VARCHAR) AS "placeIdentifier", o_orderpriority AS name,
    {ADDRESS} AS address, {GEOCODES} AS geocodes, {CATEGORIES} AS categories
"""
LOADED = f"WITH {PLACES} SELECT {cell(7)} AS cell_key, {JSON_COLUMNS} FROM places"

ORDERS_WITHOUT_STATUS = "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority"

UPSERTED = """
    SELECT * FROM orders WHERE o_orderkey % 5 <> 0
    UNION ALL SELECT * REPLACE (CAST(0 AS DOUBLE) AS o_totalprice) FROM orders WHERE o_orderkey % 5 = 0
    UNION ALL SELECT * REPLACE (o_orderkey + 1000000 AS o_orderkey) FROM orders WHERE o_orderkey < 10
"""

SPARK_TYPE = """
    CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
        WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
        WHEN 'VARCHAR' THEN 'string' END
"""


def rotate(value: str, bits: int) -> str:
    return f"(((({value}) << {bits}) % 4294967296) | (({value}) >> {32 - bits}))"


def mix(word: str, state: str) -> str:
    word = f"({rotate(f'({word} * 3432918353) % 4294967296', 15)} * 461845907) % 4294967296"
    return f"({rotate(f'xor({state}, {word})', 13)} * 5 + 3864292196) % 4294967296"


# Public 32-bit Murmur3 of the BIGINT ``k`` of table ``keyed``, seed 42, one step per table.
MURMUR3 = f"""
halves AS (SELECT k, CAST(k AS HUGEINT) % 4294967296 AS low, CAST(k AS HUGEINT) >> 32 AS high FROM keyed),
first_half AS (SELECT k, high, {mix("low", "CAST(42 AS HUGEINT)")} AS h FROM halves),
second_half AS (SELECT k, xor({mix("high", "h")}, CAST(8 AS HUGEINT)) AS h FROM first_half),
spread_1 AS (SELECT k, (xor(h, h >> 16) * 2246822507) % 4294967296 AS h FROM second_half),
spread_2 AS (SELECT k, (xor(h, h >> 13) * 3266489909) % 4294967296 AS h FROM spread_1),
hashed AS (SELECT k, CASE WHEN k IS NULL THEN 42 ELSE xor(h, h >> 16) END AS h FROM spread_2)
"""


def profile(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, max(length({c})) AS max_length, count({c}) AS filled FROM {table}"
        for c in columns
    )


WIDTH = "CASE " + " ".join(f"WHEN coalesce(max_length, 0) <= {2**i} THEN {2**i}" for i in range(9)) + " END"


def oracles() -> dict[str, str]:
    return {
        "q_read_table": "SELECT * FROM lineitem",
        "q_row_count": "SELECT count(*) AS rows FROM lineitem",
        "q_limit_topk": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 1000",
        "q_limit_sorted": "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1200",
        "q_row_cap": "SELECT least(count(*), 5000) AS rows FROM lineitem",
        "q_partition_read": f"{ORDERS_WITHOUT_STATUS} FROM orders WHERE o_orderstatus = 'F'",
        "q_partition_restored": "SELECT * FROM orders WHERE o_orderstatus = 'F'",
        "q_partition_pruned": "SELECT * FROM orders WHERE o_orderstatus = 'F'",
        "q_nested_fields": f"""
            WITH {PLACES}
            SELECT CAST(o_orderkey AS VARCHAR) AS "placeIdentifier", lat AS latitude, lon AS longitude
            FROM places
        """,
        "q_geo_cell_r3": f"""
            WITH {PLACES}
            SELECT CAST(o_orderkey AS VARCHAR) AS "placeIdentifier", {cell(7)} AS cell_key FROM places
        """,
        "q_geo_cell_r6": f"""
            WITH {PLACES}
            SELECT CAST(o_orderkey AS VARCHAR) AS "placeIdentifier", {cell(11)} AS cell_key FROM places
        """,
        "q_json_columns": f"WITH {PLACES} SELECT {JSON_COLUMNS} FROM places",
        "q_append_key": f"""
            WITH {PLACES}
            SELECT o_orderkey, o_totalprice, lat AS "geocodes_mainEntry_latitude",
                lon AS "geocodes_mainEntry_longitude", {cell(11)} AS cell_key
            FROM places
        """,
        "q_constants": """
            SELECT o_orderkey AS order_key, 6 AS resolution, '2023-03-14' AS run_date FROM orders
        """,
        "q_group_count": """
            SELECT nullif(event_type, 'error') AS event_type, count(*) AS count FROM events GROUP BY 1
        """,
        "q_cell_rollup": f"""
            WITH {PLACES} SELECT {cell(7)} AS cell_key, count(*) AS rows FROM places GROUP BY 1
        """,
        "q_shard_report": f"""
            WITH {PLACES}, keyed AS (SELECT {cell(7)} AS k FROM places), {MURMUR3}
            SELECT CAST(h % 8 AS INTEGER) AS shard, count(*) AS rows FROM hashed GROUP BY 1
        """,
        "q_width_profile": f"""
            SELECT column_name, CAST(max_length AS INTEGER) AS max_length, filled, {WIDTH} AS width FROM (
                {profile("customer", ["c_name", "c_mktsegment"])} UNION ALL
                {profile("part", ["p_name", "p_brand", "p_type"])} UNION ALL
                {profile("documents", ["text", "lang", "source"])})
        """,
        "q_constraint_violations": """
            SELECT 'primary_key' AS rule, 'l_orderkey,l_linenumber' AS column_name,
                '{"l_orderkey":' || l_orderkey || ',"l_linenumber":' || l_linenumber || '}' AS key_value,
                count(*) AS rows
            FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
            UNION ALL
            SELECT 'not_null', 'l_returnflag', NULL, count(*) FROM lineitem
            WHERE l_returnflag = 'R' HAVING count(*) > 0
            UNION ALL
            SELECT 'width', 'text', NULL, count(*) FROM documents
            WHERE length(text) > 256 HAVING count(*) > 0
            UNION ALL
            SELECT 'width', 'lang', NULL, count(*) FROM documents
            WHERE length(lang) > 2 HAVING count(*) > 0
        """,
        "q_profile_merged": f"""
            WITH counted AS ({profile("orders", ["o_orderstatus", "o_orderpriority"])}),
            distinct_values AS (
                SELECT 'o_orderstatus' AS column_name, count(DISTINCT o_orderstatus) AS n FROM orders
                UNION ALL SELECT 'o_orderpriority', count(DISTINCT o_orderpriority) FROM orders)
            SELECT column_name, (SELECT count(*) FROM orders) AS rows, filled, max_length, {WIDTH} AS width,
                n <= 16 AS few_values, CASE WHEN n <= 16 THEN n END AS values_if_few
            FROM counted JOIN distinct_values USING (column_name)
        """,
        "q_upsert": UPSERTED,
        "q_upsert_files": UPSERTED,
        "q_upsert_table": """
            SELECT * REPLACE (
                CASE WHEN o_orderstatus = 'F' AND o_orderkey % 5 = 0 THEN CAST(0 AS DOUBLE)
                     ELSE o_totalprice END AS o_totalprice)
            FROM orders
            UNION ALL
            SELECT * REPLACE (o_orderkey + 1000000 AS o_orderkey) FROM orders
            WHERE o_orderkey < 10 AND o_orderstatus = 'F'
        """,
        "q_latest_by_key": """
            SELECT * FROM events
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
        """,
        "q_create_replace": "SELECT * FROM customer",
        "q_sharded_table": f"""
            WITH {PLACES}
            SELECT CAST(o_orderkey AS VARCHAR) AS "placeIdentifier", {cell(7)} AS cell_key FROM places
        """,
        "q_load_places": LOADED,
        "q_load_job": LOADED,
        "q_load_ledger": LOADED,
        "q_box_read": f"""
            WITH {PLACES}
            SELECT o_orderkey, o_totalprice, lat AS "geocodes_mainEntry_latitude", lon AS "geocodes_mainEntry_longitude"
            FROM places WHERE lat BETWEEN -20.5 AND 48.0 AND (lon >= 150.25 OR lon <= -100.0)
        """,
        "q_curve_key": f"""
            WITH {PLACES}, cells AS (SELECT o_orderkey, {cell(3)} AS k FROM places)
            SELECT CAST(o_orderkey AS VARCHAR) AS "placeIdentifier",
                (k // {2**58}) * {2**58}
                + {" + ".join(f"((k // {2**29}) // {2**n}) % 2 * {2 ** (2 * n + 1)}" for n in range(3))}
                + {" + ".join(f"(k // {2**n}) % 2 * {4**n}" for n in range(4))} AS curve_key
            FROM cells
        """,
        "q_schema_drift": f"""
            WITH given AS (SELECT column_name, {SPARK_TYPE} AS source_type FROM (DESCRIBE orders)),
            made(place, column_name, target_type) AS (VALUES
                (1, 'o_orderkey', 'int'), (2, 'o_custkey', 'decimal(20,0)'), (3, 'o_totalprice', 'double'),
                (4, 'o_orderstatus', 'string'), (5, 'o_orderdate', 'date'), (6, 'note', 'string')),
            joined AS (SELECT column_name, source_type, target_type FROM given FULL JOIN made USING (column_name))
            SELECT column_name,
                CASE WHEN source_type IS NULL THEN 'fill' WHEN target_type IS NULL THEN 'add' WHEN source_type = target_type THEN 'keep'
                    WHEN target_type LIKE 'decimal%' THEN 'cast' ELSE 'widen' END AS action,
                source_type, target_type,
                CASE WHEN source_type IS NULL OR target_type LIKE 'decimal%' THEN target_type ELSE source_type END AS result_type
            FROM joined
        """,
        "q_widened_table": """
            SELECT o_orderkey, CASE WHEN o_orderkey < 100 THEN o_custkey END AS o_custkey, o_orderstatus,
                CASE WHEN o_orderkey >= 100 THEN o_totalprice END AS o_totalprice
            FROM orders
        """,
        "q_load_report": """
            SELECT 'capped' AS load, count(*) AS rows_in, count(*) // 2 AS rows_out,
                CAST(NULL AS BIGINT) AS null_keys FROM orders
            UNION ALL
            SELECT 'whole', count(*), count(*), count(*) FILTER (WHERE o_custkey % 10 = 0) FROM orders
        """,
        "q_load_flat": f"""
            WITH {PLACES}, base AS (
                SELECT o_orderkey, o_totalprice, lat AS "geocodes_mainEntry_latitude",
                    lon AS "geocodes_mainEntry_longitude", {cell(11)} AS cell_key
                FROM places)
            {UPSERTED.replace("FROM orders", "FROM base")}
        """,
        "q_jdbc_truncate": "SELECT * FROM orders",
        "q_jdbc_append": "SELECT * FROM orders UNION ALL SELECT * FROM orders",
        "q_jdbc_upsert": UPSERTED,
        "q_jdbc_publish": "SELECT * REPLACE (o_totalprice * 2 AS o_totalprice) FROM orders",
        "q_jdbc_types": f"""
            WITH widths AS (
                SELECT column_name AS name, {WIDTH} AS width
                FROM ({profile("part", ["p_name", "p_brand", "p_type"])}))
            SELECT column_name, CASE WHEN width IS NOT NULL THEN 'varchar(' || width || ')'
                ELSE {SPARK_TYPE} END AS column_type
            FROM (DESCRIBE part) LEFT JOIN widths ON name = column_name
        """,
        "q_schema_probe": f"SELECT column_name, {SPARK_TYPE} AS column_type FROM (DESCRIBE orders)",
        "q_run_sql": """
            SELECT o_orderpriority AS priority, count(*) AS orders FROM orders
            WHERE o_orderstatus = 'F' GROUP BY o_orderpriority
        """,
        "q_sql_script": """
            SELECT o_custkey AS customer, count(*) AS orders, '2023-03-14' AS run_date
            FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey
        """,
        "q_sql_params": """
            SELECT o_orderkey AS order_key, o_orderdate AS order_date FROM orders
            WHERE o_orderdate >= TIMESTAMP '1996-01-01'
        """,
    }
