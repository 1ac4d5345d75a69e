"""DuckDB SQL for the registered queries, over the same tables."""

from __future__ import annotations

from checks.frames import DICTIONARY_COLUMNS, VAGUE_DICTIONARY
from checks.queries import CHUNKS, VALIDATED


def double(c: str) -> str:
    return f"CAST(CAST({c} AS DECIMAL(38,6)) AS VARCHAR)"


def text(c: str) -> str:
    return f"CAST({c} AS VARCHAR)"


def stamp(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"


def sha(t: str) -> str:
    return f"upper(sha256({t}))"


def part(t: str) -> str:
    return sha(f"coalesce({t}, '')")


def fold(parts: list[str]) -> str:
    groups = [sha(" || ".join(parts[i : i + 50])) for i in range(0, len(parts), 50)]
    return sha(" || ".join(groups))


def key_total(keys: list[str]) -> str:
    joined = text(keys[0]) if len(keys) == 1 else f"concat_ws('_', {', '.join(text(k) for k in keys)})"
    return f"CAST(SUM(CAST(('0x' || substr(sha256({joined}), 1, 8)) AS BIGINT)) AS VARCHAR)"


LINEITEM = {
    "l_orderkey": text("l_orderkey"), "l_partkey": text("l_partkey"), "l_suppkey": text("l_suppkey"),
    "l_linenumber": text("l_linenumber"), "l_quantity": double("l_quantity"),
    "l_extendedprice": double("l_extendedprice"), "l_discount": double("l_discount"), "l_tax": double("l_tax"),
    "l_returnflag": "l_returnflag", "l_linestatus": "l_linestatus", "l_shipdate": stamp("l_shipdate"),
}
ORDERS = {
    "o_orderkey": text("o_orderkey"), "o_custkey": text("o_custkey"), "o_orderstatus": "o_orderstatus",
    "o_totalprice": double("o_totalprice"), "o_orderdate": stamp("o_orderdate"), "o_orderpriority": "o_orderpriority",
}
EVENTS = {
    "event_id": text("event_id"), "ts": stamp("ts"), "user_id": text("user_id"), "event_type": "event_type",
    "value": double("value"), "props": "props",
}
DOCUMENTS = {"doc_id": text("doc_id"), "text": "text", "lang": "lang", "source": "source", "n_chars": text("n_chars")}

WIDENED = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]

SUMMED = {
    "orders": ["o_orderkey", "o_custkey", "o_totalprice:d"],
    "customer": ["c_custkey", "c_nationkey", "c_acctbal:d"],
    "part": ["p_partkey", "p_size", "p_retailprice:d"],
    "events": ["event_id", "user_id", "value:d"],
    "lineitem": [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity:d", "l_extendedprice:d",
        "l_discount:d", "l_tax:d",
    ],
}


def total(c: str) -> str:
    name, _, kind = c.partition(":")
    inner = f"CAST({name} AS DECIMAL(28,6))" if kind else name
    return f"CAST(SUM({inner}) AS VARCHAR)"


def sums_of(t: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, 'SUM' AS metric, '{c.partition(':')[0]}' AS column_name, {total(c)} AS value FROM {t}"
        for c in SUMMED[t]
    )


CHUNKED = f"""
    ends AS (SELECT min(l_orderkey) AS a, greatest(1, CAST(ceil((max(l_orderkey) - min(l_orderkey) + 1) / {CHUNKS}.0) AS BIGINT)) AS w FROM lineitem),
    chunked AS (SELECT lineitem.*, (l_orderkey - a) // w AS chunk_id, a + ((l_orderkey - a) // w) * w AS lo,
                       a + ((l_orderkey - a) // w) * w + w AS hi FROM lineitem, ends)
"""

TASKS = """
    raw AS (SELECT upper(event_type) AS schema, 'D' || CAST(CAST(ts AS DATE) AS VARCHAR) AS "table",
                   CAST(hour(ts) AS BIGINT) AS chunk_id, count(*) AS rows,
                   CAST(sum(octet_length(encode(props))) AS BIGINT) AS bytes, max(value) AS seconds, min(value) AS lowest
            FROM events GROUP BY ALL),
    tasks AS (SELECT schema, "table", chunk_id, CASE WHEN lowest < 0.5 THEN 0 ELSE rows END AS rows,
                     CASE WHEN lowest < 0.5 THEN 0 ELSE bytes END AS bytes,
                     CASE WHEN lowest < 0.5 THEN 0 ELSE seconds END AS seconds,
                     lowest < 0.5 AS failed,
                     CASE WHEN chunk_id < 6 THEN '' ELSE 'hour ' || chunk_id || ': ' || rows || ' rows lost' END AS error
              FROM raw),
    listing AS (SELECT DISTINCT schema, "table" FROM raw UNION SELECT DISTINCT schema, 'EMPTY' FROM raw),
    per_table AS (SELECT schema, "table", count(*) AS n, count(*) FILTER (failed) AS bad, sum(rows) AS rows,
                         sum(bytes) AS bytes, max(seconds) AS seconds,
                         coalesce(string_agg(error, '; ' ORDER BY chunk_id) FILTER (failed AND error <> ''), '') AS error
                  FROM tasks GROUP BY ALL),
    results AS (SELECT schema, "table",
                       CAST(CASE WHEN bad > 0 AND n > 1 THEN 0 ELSE coalesce(rows, 0) END AS BIGINT) AS rows,
                       CAST(CASE WHEN bad > 0 AND n > 1 THEN 0 ELSE coalesce(bytes, 0) END AS BIGINT) AS bytes,
                       CAST(CASE WHEN bad > 0 AND n > 1 THEN 0 ELSE coalesce(seconds, 0) END AS DOUBLE) AS seconds,
                       CASE WHEN bad > 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
                       CASE WHEN bad > 0 THEN error END AS error
                FROM listing LEFT JOIN per_table USING (schema, "table"))
"""
RECORDS = """
    records AS (SELECT upper(event_type) AS schema, 'D' || CAST(CAST(ts AS DATE) AS VARCHAR) AS "table",
                       count(*) AS row_count,
                       CASE WHEN event_type <> 'click' THEN CAST(sum(event_id) AS VARCHAR) END AS pk_hash,
                       count(*) FILTER (value > 400) AS sums
                FROM events WHERE event_type <> 'view' GROUP BY event_type, 2)
"""


def dictionary_names(columns: list[str]) -> str:
    return ",".join(columns)


def discovered_columns() -> str:
    """Text of the visible columns; comments exist only in one schema."""
    target = {
        "ID": "INT64:bigint:false", "AMOUNT": "BIGNUMERIC:decimal(12,2):false", "CREATED": "DATETIME:timestamp_ntz:false",
        "CHANGED": "TIMESTAMP:timestamp:true", "PAYLOAD": "JSON:string:true", "NOTE": "STRING:string:false",
        "DOUBLED": "STRING:string:false", "OLD_CODE": "STRING:string:false",
    }
    items = []
    for name, _, _, _, expr, hidden, user, note in DICTIONARY_COLUMNS:
        if hidden == "YES" and user == "NO":
            continue
        virtual = "true:" + expr.strip() if expr else "false:-"
        comment = f"CASE WHEN o_orderstatus = 'O' THEN '{note}' ELSE '-' END" if note else "'-'"
        items.append(f"'{name}:{target[name]}:{virtual}:' || {comment}")
    return " || ',' || ".join(items)


NUMBER_TYPES = """
    SELECT p_partkey, data_type,
           CASE WHEN u = 'NUMBER' THEN 38 END AS dummy, u,
           CASE WHEN u = 'NUMBER(10,2)' THEN 10 WHEN u = 'NUMBER(38)' THEN 38
                WHEN u = 'NUMBER' AND p_size < 45 THEN least(p_size, 38) END AS p0,
           CASE WHEN u = 'NUMBER(10,2)' THEN 2 WHEN u = 'NUMBER' AND p_size < 48 THEN p_size - 20 END AS s0
    FROM (SELECT p_partkey, p_size, data_type, upper(data_type) AS u FROM part, (SELECT unnest([
        'NUMBER', 'number(10,2)', 'NUMBER(38)', 'FLOAT', 'BINARY_DOUBLE', 'VARCHAR2', 'NCLOB', 'LONG', 'LONG RAW',
        'ROWID', 'UROWID', 'DATE', 'TIMESTAMP(9)', 'TIMESTAMP(6) WITH TIME ZONE', 'TIMESTAMP(3) WITH LOCAL TIME ZONE',
        'RAW', 'BLOB', 'XMLTYPE', 'JSON', 'BOOLEAN', 'SDO_GEOMETRY', 'INTERVAL YEAR(2) TO MONTH',
        'INTERVAL DAY(2) TO SECOND(6)', 'SOMETHING_ELSE']) AS data_type))
"""

MAP_TYPES = f"""
    WITH n AS ({NUMBER_TYPES}),
    d AS (SELECT *, coalesce(p0, 0) AS p, coalesce(s0, CASE WHEN p0 > 0 THEN 0 ELSE -127 END) AS s,
                 u LIKE 'NUMBER%' AS is_number FROM n),
    t AS (SELECT *,
        CASE WHEN is_number THEN
                  CASE WHEN s = -127 AND p = 0 THEN 'STRING' WHEN s = -127 THEN 'FLOAT64'
                       WHEN s = 0 AND p BETWEEN 1 AND 18 THEN 'INT64' ELSE 'BIGNUMERIC' END
             WHEN u IN ('FLOAT', 'BINARY_DOUBLE') THEN 'FLOAT64'
             WHEN u IN ('DATE', 'TIMESTAMP(9)') THEN 'DATETIME'
             WHEN u LIKE '%TIME ZONE' THEN 'TIMESTAMP'
             WHEN u IN ('RAW', 'BLOB') THEN 'BYTES' WHEN u = 'JSON' THEN 'JSON' WHEN u = 'BOOLEAN' THEN 'BOOL'
             ELSE 'STRING' END AS target_type FROM d)
    SELECT p_partkey, data_type, target_type,
        CASE WHEN is_number AND target_type = 'BIGNUMERIC' THEN
                  CASE WHEN s = 0 AND p = 0 THEN 'decimal(38,0)' WHEN p = 0 THEN 'string'
                       WHEN s < 0 THEN CASE WHEN p - s <= 38 THEN 'decimal(' || (p - s) || ',0)' ELSE 'string' END
                       ELSE 'decimal(' || greatest(p, s) || ',' || s || ')' END
             ELSE CASE target_type WHEN 'INT64' THEN 'bigint' WHEN 'FLOAT64' THEN 'double' WHEN 'DATETIME' THEN 'timestamp_ntz'
                       WHEN 'TIMESTAMP' THEN 'timestamp' WHEN 'BYTES' THEN 'binary' WHEN 'BOOL' THEN 'boolean' ELSE 'string' END
        END AS spark_type,
        u LIKE '%TIME ZONE%' OR u IN ('XMLTYPE', 'JSON', 'SDO_GEOMETRY', 'ROWID', 'UROWID') OR u LIKE 'INTERVAL%' AS is_transformed
    FROM t
"""

DISCOVER = f"""
    SELECT 'OWNER_' || o_orderstatus AS schema, 'T' || o_orderkey AS "table",
           {discovered_columns()} AS columns,
           round(CASE WHEN o_orderpriority = '3-MEDIUM' THEN (CAST(trunc(o_totalprice * 1000) AS BIGINT) + 1000000000) / 1073741824.0
                      WHEN o_orderpriority = '5-LOW' THEN 0
                      ELSE trunc(o_totalprice) * o_custkey / 1073741824.0 END, 9) AS size_gb,
           CASE WHEN o_orderstatus = 'P' OR o_orderstatus = 'O' THEN 'ID,CREATED' ELSE '' END AS pk_cols,
           CASE WHEN o_orderpriority = '1-URGENT' THEN 'CREATED' ELSE '' END AS partition_cols,
           CASE WHEN o_orderpriority <> '2-HIGH' THEN 'AMOUNT,ID,AMOUNT' ELSE '' END AS index_cols
    FROM orders
    WHERE o_orderstatus IN ('O', 'P') AND o_totalprice > 50000 AND o_orderpriority <> '4-NOT SPECIFIED'
"""


def interval_seconds(us: str) -> str:
    digits = f"printf('%d.%06d', ({us} // 1000000) % 60, {us} % 1000000)"
    return f"rtrim(rtrim({digits}, '0'), '.')"


def long_stats(t: str, cte: str) -> str:
    keys = VALIDATED[t]
    rows = [
        f"SELECT 'ROW_COUNT' AS metric, '' AS column_name, CAST(count(*) AS VARCHAR) AS value FROM {cte}",
        f"SELECT 'PK_HASH', '', {key_total(keys)} FROM {cte}",
        *[f"SELECT 'SUM', '{c.partition(':')[0]}', {total(c)} FROM {cte}" for c in SUMMED[t]],
    ]
    return " UNION ALL ".join(rows)


def columnar(t: str, fixed: int, var: list[str]) -> str:
    lengths = " + ".join(f"coalesce(octet_length(encode({v})), 0)" for v in var)
    return f"CAST(count(*) * {fixed} + sum({lengths}) AS BIGINT)"


def csv_size(columns: dict[str, str]) -> str:
    return "CAST(sum(" + " + ".join(f"coalesce(octet_length(encode({t})), 0)" for t in columns.values()) + ") AS BIGINT)"


def size_row(t: str, columns: dict[str, str], fixed: int, var: list[str]) -> str:
    return (
        f"SELECT '{t}' AS table_name, count(*) AS rows, {columnar(t, fixed, var)} AS parquet_bytes, "
        f"{csv_size(columns)} AS csv_bytes FROM {t}"
    )


def exported(t: str, bytes_: str) -> str:
    return (
        f"SELECT 'TPC' AS schema, '{t}' AS \"table\", count(*) AS rows, {bytes_} AS bytes, "
        f"'SUCCESS' AS status, false AS has_error FROM {t}"
    )


CAST_LOSS = [
    ("o_orderkey", "o_orderkey", "BIGINT"), ("price", "CAST(o_totalprice AS VARCHAR)", "DECIMAL(7,2)"), ("priority", "o_orderpriority", "DECIMAL(38,2)"),
    ("cust", "cust", "BIGINT"), ("placed", "CAST(o_orderdate AS VARCHAR)", "TIMESTAMP"),
]

_AT = "make_timestamp((n_chars * 86413 + doc_id) * 1000000)"
AWKWARD = {
    "doc_id": text("doc_id"), "raw": "to_base64(encode(text))", "at": stamp(_AT), "body": "coalesce(text, '')", "address": "'AAA' || doc_id",
    "even": "CAST(n_chars % 2 = 0 AS VARCHAR)",
}
AWKWARD_HASHED = [
    part(text("doc_id")), part("hex(encode(text))"), part(f"strftime({_AT}, '%Y-%m-%dT%H:%M:%S.%fZ')"), part("'AAA' || doc_id"), part("CAST(n_chars % 2 = 0 AS VARCHAR)"),
]

def exact_sum(c: str) -> str:
    """All figures of the sum of a floating column ``c``: whole millionths, then bands of 50 binary orders in two parts."""
    micros = f"(abs({c}) < 9e9::DOUBLE AND round_even({c} * 1e6::DOUBLE, 0) / 1e6::DOUBLE = {c})"
    total = f"CAST(sum(CASE WHEN isfinite({c}) AND {micros} THEN CAST(round_even({c} * 1e6::DOUBLE, 0) AS HUGEINT) END) AS HUGEINT)"
    parts = [
        f"CASE WHEN {total} < 0 THEN '-' ELSE '' END || CAST(abs({total}) // 1000000 AS VARCHAR) || '.' || lpad(CAST(abs({total}) % 1000000 AS VARCHAR), 6, '0')"
    ]
    for low in (-42, 8, 58, 108):
        inside = f"isfinite({c}) AND NOT {micros} AND abs({c}) >= {2.0**low!r}::DOUBLE AND abs({c}) < {2.0 ** (low + 50)!r}::DOUBLE"
        units = f"CAST({c} * {2.0 ** (52 - low)!r}::DOUBLE AS HUGEINT)"
        for part, unit in ((f"({units} >> 40)", low - 12), (f"({units} & 1099511627775::HUGEINT)", low - 52)):
            parts.append(f"CAST(CAST(sum(CASE WHEN {inside} THEN {part} END) AS HUGEINT) AS VARCHAR) || ' x 2^{unit}'")
    for name, test in (("NaN", f"isnan({c})"), ("Infinity", f"{c} = 'inf'::DOUBLE"), ("-Infinity", f"{c} = '-inf'::DOUBLE")):
        parts.append(f"CASE WHEN count(*) FILTER ({test}) > 0 THEN count(*) FILTER ({test}) || ' {name}' END")
    return f"concat_ws(' + ', {', '.join(parts)})"


_EXTREMES = {
    "sevenths": "l_extendedprice / 7.0::DOUBLE", "tiny": "l_extendedprice * 1e-12::DOUBLE",
    "mixed": "l_extendedprice * list_extract([1e-12, 1e-6, 1e-3, 1.0, 1e9, 1e18, 1e30]::DOUBLE[], l_linenumber % 7 + 1)",
    "special": "CASE l_linenumber WHEN 1 THEN 'nan'::DOUBLE WHEN 2 THEN 'inf'::DOUBLE WHEN 3 THEN '-inf'::DOUBLE ELSE l_extendedprice END",
}
EXTREME = (
    f"WITH w AS (SELECT {', '.join(f'{e} AS {n}' for n, e in _EXTREMES.items())} FROM lineitem) "
    "SELECT 'extreme' AS table_name, 'ROW_COUNT' AS metric, NULL::VARCHAR AS column_name, CAST(count(*) AS VARCHAR) AS value FROM w UNION ALL "
    + " UNION ALL ".join(f"SELECT 'extreme', 'SUM', '{n}', {exact_sum(n)} FROM w" for n in _EXTREMES)
)

ORDER_HASH = fold([part(t) for t in ORDERS.values()])

# Columns that only the scan knows, with their type there.
_SCANNED_ONLY = {
    "customer": [("c_mktsegment", "string")], "part": [("p_brand", "string"), ("p_type", "string")], "events": [("user_id", "bigint"), ("event_type", "string")],
    "lineitem": [("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"), ("l_linestatus", "string")],
    "supplier": [("s_nationkey", "int"), ("s_acctbal", "double")],
}


def _held(column: str, chosen: str, note: str) -> str:
    if note == "not scanned":
        return "0 * count(*)"
    return f"count(TRY_CAST({column} AS BIGINT))" if (note, chosen) == ("text in the source", "bigint") else f"count({column})"


REFINED = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{said}' AS dictionary, '{chosen}' AS chosen, '{note}' AS note, {_held(c, chosen, note)} AS n_values FROM {t}"
    for t, columns in VAGUE_DICTIONARY.items()
    for c, said, chosen, note in [(c, said, chosen, note) for c, _, said, chosen, note in columns] + [(c, "-", kind, "not in the dictionary") for c, kind in _SCANNED_ONLY.get(t, [])]
)

_ARRIVED = "(SELECT * FROM lineitem WHERE NOT (l_returnflag = 'R' AND l_linenumber = 7))"
_FIGURES = [("ROW_COUNT", "", "CAST(count(*) AS VARCHAR)"), *[("NON_NULL", c, f"CAST(count({c}) AS VARCHAR)") for c in LINEITEM]]
_FIGURES += [("SUM", c.partition(":")[0], total(c)) for c in SUMMED["lineitem"]]
# What the whole table says beside what is left of it, wherever the two differ; the honest export keeps its record.
DISAGREES = " UNION ALL ".join(
    f"""SELECT 'lineitem' AS "table", '{m}' AS metric, '{c}' AS column_name, stated, arrived
        FROM (SELECT {f} AS stated FROM lineitem), (SELECT {f} AS arrived FROM {_ARRIVED}) WHERE stated IS DISTINCT FROM arrived"""
    for m, c, f in _FIGURES
) + " UNION ALL SELECT 'lineitem_whole', 'RECORDED', '', CAST(count(*) AS VARCHAR), CAST(count(*) AS VARCHAR) FROM lineitem"

TWINS: dict[str, str] = {
    "scan_project": "SELECT * FROM orders",
    "scan_where": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem
        WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_returnflag = 'R'""",
    "scan_chunks_union": f"SELECT *, {CHUNKS} AS chunks, count(*) OVER () AS rows_of_chunks FROM lineitem",
    "chunk_text_ranges": "SELECT p_partkey, p_name, 1 AS ranges_matched, true AS as_stated FROM part",
    "table_sizes": " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", count(*) AS rows, true AS known, 'data.parquet' AS file_name, true AS whole FROM {t}"""
        for t in (*VALIDATED, "region", "nation", "supplier", "documents")
    ),
    "chunk_predicates": "SELECT l_orderkey, l_linenumber, l_quantity, 1 AS ranges_matched, 1 AS parts_matched FROM lineitem",
    "chunk_bounds": f"WITH {CHUNKED} SELECT chunk_id, lo, hi, count(*) AS rows FROM chunked GROUP BY ALL",
    "plan_tasks": """
        WITH t AS (SELECT 'OWNER_' || o_orderstatus AS schema, 'T' || o_orderkey AS "table",
                          trunc(o_totalprice) / 100000.0 AS size_gb,
                          coalesce(CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice) AS BIGINT) END, 1000) AS blocks
                   FROM orders),
        p AS (SELECT *, greatest(1, CAST(ceil(blocks / 4.0) AS BIGINT)) AS per FROM t),
        big AS (SELECT *, unnest(range(CAST(ceil(CAST(blocks AS DOUBLE) / per) AS BIGINT))) AS i FROM p WHERE size_gb > 1 OR size_gb = 0)
        SELECT schema, "table", printf('data_chunk_%04d.parquet', i) AS file_name, CAST(i AS VARCHAR) AS chunk_id,
               CAST(i * per AS VARCHAR) AS block_lo, CAST(least(i * per + per, blocks) AS VARCHAR) AS block_hi FROM big
        UNION ALL SELECT schema, "table", 'data.parquet', '-', '-', '-' FROM p WHERE size_gb > 0 AND size_gb <= 1""",
    "discover_catalog": DISCOVER,
    "map_types": MAP_TYPES,
    "refine_types": REFINED,
    "apply_types": """
        SELECT o_orderkey, o_custkey AS cust,
               CAST(CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(12,1)) AS VARCHAR) AS price, o_orderdate AS placed,
               coalesce(CAST(TRY_CAST(o_orderpriority AS DECIMAL(38,2)) AS VARCHAR), 'not a number') AS priority
        FROM orders""",
    "csv_text": f"SELECT {', '.join(f'{t} AS {c}' for c, t in LINEITEM.items())} FROM lineitem",
    "strip_newlines": "SELECT doc_id, replace(replace(text, chr(10), ''), chr(13), '') AS text FROM documents",
    "xml_one_line": "SELECT page_id, url, replace(replace(html, chr(10), ''), chr(13), '') AS html FROM pages",
    "json_text": """
        SELECT event_id, replace(replace(props, chr(10), ''), chr(13), '') AS one_line,
               CAST(json(props) AS VARCHAR) AS normalized FROM events""",
    "ts_utc": "SELECT event_id, ts + INTERVAL 5 HOUR AS ts_utc FROM events",
    "interval_ym": """
        WITH m AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) - 25 AS m FROM lineitem)
        SELECT l_orderkey, l_linenumber,
               CASE WHEN m < 0 THEN '-' ELSE '' END || (abs(m) // 12) || '-' || (abs(m) % 12) || ' 0 0:0:0' AS span FROM m""",
    "interval_ds": f"""
        WITH d AS (SELECT event_id, epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-15') AS us FROM events),
        a AS (SELECT event_id, us, abs(us) AS n FROM d)
        SELECT event_id, '0-0 ' || CASE WHEN us < 0 THEN '-' ELSE '' END || (n // 86400000000) || ' ' ||
               ((n // 3600000000) % 24) || ':' || ((n // 60000000) % 60) || ':' || {interval_seconds('n')} AS span FROM a""",
    "virtual_view": """
        SELECT *,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS VARCHAR) AS net_price,
               'L' || l_linenumber AS line_name, 'none' AS lost FROM lineitem""",
    "partition_by_day": """
        SELECT CAST(CAST(date_trunc('day', ts) AS DATE) AS VARCHAR) AS day, count(*) AS rows,
               min(event_id) AS first_event, max(event_id) AS last_event FROM events GROUP BY 1""",
    "col_hash": f"SELECT {', '.join(f'{part(t)} AS {c}' for c, t in LINEITEM.items())} FROM lineitem",
    "row_hash": f"SELECT *, {ORDER_HASH} AS ROW_HASH FROM orders",
    "row_hash_wide": f"""
        SELECT l_orderkey, l_linenumber, {fold([part(t) for t in LINEITEM.values()] + [part(text(f'{n} + {i}')) for i in range(1, 13) for n in WIDENED])} AS ROW_HASH FROM lineitem""",
    "row_hash_documents": f"SELECT doc_id, {fold([part(t) for t in DOCUMENTS.values()])} AS ROW_HASH FROM documents",
    "pk_hash": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {key_total(k)} AS pk_hash FROM {t}"
        for t, k in {
            "orders": ["o_orderkey"], "customer": ["c_custkey"], "events": ["event_id"],
            "lineitem": ["l_orderkey", "l_linenumber"], "conversations": ["conv_id", "turn", "role"],
        }.items()
    ),
    "duplicate_rows": f"""
        SELECT {fold([part('text'), part('lang')])} AS ROW_HASH, count(*) AS copies FROM documents
        GROUP BY text, lang HAVING count(*) > 1""",
    "validate_stats": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, {key_total(k)} AS pk_hash, "
        f"CAST({len(SUMMED[t])} AS BIGINT) AS sums FROM {t}"
        for t, k in VALIDATED.items()
    ),
    "validate_sums": " UNION ALL ".join(sums_of(t) for t in SUMMED),
    "logical_bytes": " UNION ALL ".join(
        [
            size_row("events", EVENTS, 32, ["event_type", "props"]),
            size_row("documents", DOCUMENTS, 16, ["text", "lang", "source"]),
            size_row("orders", ORDERS, 32, ["o_orderstatus", "o_orderpriority"]),
        ]
    ),
    "reconcile_stats": f"""
        WITH changed AS (SELECT * REPLACE (CASE WHEN l_returnflag = 'A' THEN 0.0 ELSE l_tax END AS l_tax) FROM lineitem),
        a AS ({long_stats('lineitem', 'lineitem')}), b AS ({long_stats('lineitem', 'changed')})
        SELECT a.metric, a.column_name, a.value AS source_value, b.value AS target_value,
               a.value IS NOT DISTINCT FROM b.value AS matches
        FROM a FULL OUTER JOIN b ON a.metric = b.metric AND a.column_name = b.column_name""",
    "row_diff": """
        WITH target AS (
            SELECT * REPLACE (CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice)
            FROM orders WHERE o_orderstatus <> 'P'
            UNION ALL SELECT * REPLACE (-1 - o_orderkey AS o_orderkey) FROM orders WHERE o_orderpriority = '5-LOW'),
        j AS (SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
                     CASE WHEN b.o_orderkey IS NULL THEN 'missing' WHEN a.o_orderkey IS NULL THEN 'extra'
                          WHEN a.o_totalprice <> b.o_totalprice THEN 'changed' END AS status,
                     CASE WHEN a.o_orderkey IS NULL THEN 0 ELSE 1 END AS source_rows,
                     CASE WHEN b.o_orderkey IS NULL THEN 0 ELSE 1 END AS target_rows
              FROM orders a FULL OUTER JOIN target b ON a.o_orderkey = b.o_orderkey)
        SELECT o_orderkey, status, CAST(source_rows AS BIGINT) AS source_rows, CAST(target_rows AS BIGINT) AS target_rows
        FROM j WHERE status IS NOT NULL""",
    "row_diff_tree": f"""
        WITH target AS (
          SELECT * REPLACE (CASE WHEN l_orderkey % 997 = 3 AND l_linenumber = 1 THEN l_extendedprice + 1 ELSE l_extendedprice END AS l_extendedprice)
          FROM lineitem WHERE l_orderkey % 1009 <> 5
          UNION ALL SELECT * REPLACE (-1 - l_orderkey AS l_orderkey) FROM lineitem WHERE l_orderkey % 1013 = 7),
        s AS (SELECT l_orderkey, l_linenumber, count(*) AS n, list_sort(list(concat_ws('|', {', '.join(LINEITEM)}))) AS l FROM lineitem GROUP BY ALL),
        t AS (SELECT l_orderkey, l_linenumber, count(*) AS n, list_sort(list(concat_ws('|', {', '.join(LINEITEM)}))) AS l FROM target GROUP BY ALL)
        SELECT l_orderkey, l_linenumber, CASE WHEN t.n IS NULL THEN 'missing' WHEN s.n IS NULL THEN 'extra' ELSE 'changed' END AS status,
               coalesce(s.n, 0) AS source_rows, coalesce(t.n, 0) AS target_rows
        FROM s FULL JOIN t USING (l_orderkey, l_linenumber) WHERE s.l IS DISTINCT FROM t.l""",
    "table_results": f"WITH {TASKS} SELECT * REPLACE (coalesce(error, '-') AS error) FROM results",
    "run_summary": f"""
        WITH {TASKS}
        SELECT count(*) AS total_tasks, count(*) FILTER (status = 'SUCCESS') AS success,
               count(*) FILTER (status = 'FAILED') AS failed, CAST(sum(rows) AS BIGINT) AS total_rows,
               CAST(sum(bytes) AS BIGINT) AS total_bytes, round(sum(seconds), 6) AS total_duration_seconds,
               round(CASE WHEN sum(seconds) > 0 THEN sum(bytes) / 1048576.0 / sum(seconds) ELSE 0 END, 6) AS total_mb_per_sec
        FROM results""",
    "results_ranked": f'WITH {TASKS} SELECT schema, "table", seconds, status FROM results ORDER BY seconds DESC',
    "export_audit": f"""
        WITH {TASKS}, {RECORDS}
        SELECT schema, "table", status, coalesce(error, '-') AS error, rows, coalesce(row_count, -1) AS validated_rows,
               row_count IS NOT DISTINCT FROM rows AS rows_match, pk_hash IS NOT NULL AS has_key_total,
               CAST(coalesce(sums, 0) AS BIGINT) AS sum_checks
        FROM results LEFT JOIN records USING (schema, "table")""",
    "resume_pending": f"""
        WITH {TASKS}, {RECORDS}
        SELECT schema, "table" FROM listing l
        WHERE NOT EXISTS (SELECT 1 FROM records r WHERE r.schema = l.schema AND r."table" = l."table")""",
    "export_parquet": f"SELECT *, {fold([part(t) for t in LINEITEM.values()])} AS ROW_HASH FROM lineitem",
    "export_csv": "SELECT * FROM lineitem",
    "export_csv_text": "SELECT * FROM documents",
    "export_verified": f"""
        SELECT metric, column_name, value AS source_value, value AS target_value, true AS matches
        FROM ({long_stats('orders', 'orders')} UNION ALL SELECT 'HASH_MISMATCHES', '', '0'
              UNION ALL {' UNION ALL '.join(f"SELECT 'NON_NULL', '{c}', CAST(count(nullif({text(c)}, '')) AS VARCHAR) FROM orders" for c in ORDERS)})""",
    "export_cast_loss": f"""
        SELECT name AS column_name, had AS source_values, has AS written_values, had - has AS lost FROM (
            {' UNION ALL '.join(f"SELECT '{n}' AS name, count({v}) AS had, count(TRY_CAST({v} AS {t})) AS has FROM texts" for n, v, t in CAST_LOSS)})""".replace(
        "FROM texts", "FROM (SELECT *, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS cust FROM orders)"
    ),
    "export_resumed": " UNION ALL ".join(
        f"SELECT 'TPC' AS schema, '{t}' AS \"table\", '{status}' AS status, {rows} AS rows, count(*) AS validated_rows, true AS rows_match, "
        f"true AS has_key_total, CAST({len(SUMMED[t])} AS BIGINT) AS sum_checks FROM {t}"
        for t, status, rows in (("orders", "SKIPPED", "0"), ("customer", "SKIPPED", "0"), ("part", "SUCCESS", "count(*)"))
    ),
    "awkward_types": f"SELECT {', '.join(f'{t} AS {c}' for c, t in AWKWARD.items())}, {fold(AWKWARD_HASHED)} AS ROW_HASH FROM documents",
    "ts_region": """
        WITH t AS (SELECT event_id, ts + (event_id % 365) * INTERVAL 1 DAY AS ts FROM events),
        y AS (SELECT *, make_date(CAST(year(ts) AS INTEGER), 3, 1) AS march, make_date(CAST(year(ts) AS INTEGER), 11, 1) AS november FROM t),
        d AS (SELECT *, march + CAST(7 + (7 - dayofweek(march)) % 7 AS INTEGER) + INTERVAL 2 HOUR AS begins,
                     november + CAST((7 - dayofweek(november)) % 7 AS INTEGER) + INTERVAL 2 HOUR AS ends FROM y)
        SELECT event_id, ts + CASE WHEN ts >= begins AND ts < ends THEN INTERVAL 4 HOUR ELSE INTERVAL 5 HOUR END AS ts FROM d""",
    "schema_record": """
        SELECT c.*, (SELECT count(*) FROM customer) AS rows FROM (VALUES
            ('c_custkey', 'INT64', 'NULLABLE', '-'), ('c_name', 'STRING', 'NULLABLE', 'full name'), ('c_nationkey', 'INT64', 'NULLABLE', '-'),
            ('c_acctbal', 'FLOAT64', 'NULLABLE', '-'), ('c_mktsegment', 'STRING', 'NULLABLE', '-'),
            ('ROW_HASH', 'STRING', 'REQUIRED', 'upper-case SHA-256 over the values of the row')) c(name, type, mode, description)""",
    "validate_sums_extreme": EXTREME,
    "export_many": " UNION ALL ".join(
        [
            exported("orders", columnar("orders", 32, ["o_orderstatus", "o_orderpriority"])),
            exported("customer", columnar("customer", 24, ["c_name", "c_mktsegment"])),
            exported("part", columnar("part", 24, ["p_name", "p_brand", "p_type"])),
            exported("events", columnar("events", 32, ["event_type", "props"])),
            exported("lineitem", columnar("lineitem", 72, ["l_returnflag", "l_linestatus"])),
            "SELECT 'TPC', 'no_such_table', 0, 0, 'FAILED', true",
        ]
    ),
    "inspect_export": """
        SELECT t[1] AS column_name, t[2] AS type, rows, 2 AS shown
        FROM (SELECT unnest([['c_custkey', 'bigint'], ['c_name', 'string'], ['c_nationkey', 'int'], ['c_acctbal', 'double'], ['c_mktsegment', 'string'], ['ROW_HASH', 'string']]) AS t),
             (SELECT count(*) AS rows FROM customer)""",
    "run_report": "WITH d AS (" + " UNION ALL ".join(f"""SELECT '{t}' AS "table", 'SUCCESS' AS status, count(*) AS rows FROM {t}""" for t in VALIDATED) + f""")
        SELECT *, {len(VALIDATED)} AS total_tasks, {len(VALIDATED)} AS success, 0 AS failed, (SELECT CAST(sum(rows) AS BIGINT) FROM d) AS total_rows FROM d""",
    "published_layout": "SELECT *, 0 AS overlaps FROM lineitem",
    "export_source_disagrees": DISAGREES,
    "export_restarted": f"""
        SELECT run, 'SUCCESS' AS status, n AS rows, {CHUNKS // 2} AS chunks, written AS chunks_written, kept AS chunks_kept, n AS rows_in_files, true AS verified
        FROM (SELECT count(*) AS n FROM lineitem), (VALUES ('first', {CHUNKS // 2}, 0), ('again', 1, {CHUNKS // 2 - 1})) runs(run, written, kept)""",
    "publish_and_load": "SELECT *, CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) AS value_text FROM events",
}
