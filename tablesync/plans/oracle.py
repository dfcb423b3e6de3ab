"""The registered queries as plain SQL on the same tables, for the correctness check."""

from __future__ import annotations

from tablesync.plans.derive import FILTER_CASES, ID_ONLY_TABLE, KEYWORDS
from tablesync.plans.registered import CUT, SCOPE_START, SINCE

OPS = "CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END"

_LATEST = """
SELECT user_id, event_id, event_type, value, ts{extra} FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
  AND event_type <> 'error'
"""

LATEST_USERS = _LATEST.format(extra="")

PEOPLE = """
SELECT c_custkey,
  '1' || (3 + c_custkey % 7)::varchar || lpad(((c_custkey * 7919) % 1000000000)::varchar, 9, '0') AS mobile_number,
  '0' || (10 + c_custkey % 80)::varchar || '-' || lpad(((c_custkey * 104729) % 100000000)::varchar, 8, '0') AS tele_no,
  '110105' || (1950 + c_custkey % 60)::varchar || lpad((1 + c_custkey % 12)::varchar, 2, '0')
    || lpad((1 + c_custkey % 28)::varchar, 2, '0') || lpad((c_custkey % 1000)::varchar, 3, '0')
    || (CASE WHEN c_custkey % 11 = 10 THEN 'X' ELSE (c_custkey % 11)::varchar END) AS id_card
FROM customer
"""

ID = (
    r"[1-9]\d{5}(18|19|20|(3\d))\d{2}((0[1-9])|(1[0-2]))(([0-2][1-9])|10|20|30|31)\d{3}[0-9Xx]"
)


def _mask(column: str, mode: int) -> str:
    bare = f"replace(replace({column}, ' ', ''), '-', '')"
    trimmed = f"trim({column})"
    cases = f"WHEN regexp_full_match({bare}, '{ID}') THEN regexp_replace({bare}, '(\\d{{12}})\\w{{6}}', '\\1******', 'g') "
    if mode == 1:
        cases += (
            f"WHEN regexp_full_match({bare}, '((\\+86)|(86))?[1][3456789][0-9]{{9}}') "
            f"THEN regexp_replace(regexp_replace({bare}, '^\\+?86', ''), '(\\d{{3}})\\d{{4}}(\\d{{4}})', '\\1****\\2', 'g') "
            f"WHEN regexp_full_match({trimmed}, '(0\\d{{2,3}}[-]?\\d{{7,8}})|(0\\d{{2,3}}\\s?\\d{{7,8}})') "
            f"THEN replace({trimmed}, substring({trimmed}, 6, 3), '****') "
        )
    return f"CASE {cases} ELSE {column} END AS {column}"


def _masked(mode: int, extra: str = "") -> str:
    columns = ", ".join(_mask(c, mode) for c in ("mobile_number", "tele_no", "id_card"))
    return f"SELECT c_custkey, {columns}{extra} FROM ({PEOPLE})"


def _time(us: str) -> str:
    return f"""
    (CASE WHEN {us} < 0 THEN '-' ELSE '' END)
    || lpad((abs({us}) // 3600000000)::varchar, greatest(2, length((abs({us}) // 3600000000)::varchar))::integer, '0')
    || ':' || lpad((abs({us}) // 60000000 % 60)::varchar, 2, '0')
    || ':' || lpad((abs({us}) // 1000000 % 60)::varchar, 2, '0')
    || (CASE WHEN abs({us}) % 1000000 = 0 THEN '' ELSE '.' || lpad((abs({us}) % 1000000)::varchar, 6, '0') END)
    """


SHOP_LOG = """
SELECT 'orders' AS tbl, 'r' AS op, o_orderkey AS pk FROM orders
UNION ALL SELECT 'customer', 'c', c_custkey FROM customer
UNION ALL SELECT 'supplier', 'u', s_suppkey FROM supplier
UNION ALL SELECT 'ghost', 'c', n_nationkey FROM nation
"""

TARGETS = f"""
SELECT 'users' AS tbl, user_id AS pk, event_id || '|' || event_type || '|' || printf('%.2f', value) || '|' || epoch_us(ts) AS detail
FROM ({LATEST_USERS})
UNION ALL SELECT 'orders', o_orderkey, o_custkey || '|' || o_orderstatus || '|' || printf('%.2f', o_totalprice) || '|' ||
  epoch_us(o_orderdate) || '|' || o_orderpriority FROM orders
UNION ALL SELECT 'customer', c_custkey, c_name || '|' || c_nationkey || '|' || c_mktsegment FROM customer
UNION ALL SELECT 'supplier', s_suppkey, s_name || '|' || s_nationkey FROM supplier
"""

_FORMS = """
['+86' || mobile_number, '86' || mobile_number,
 substring(mobile_number, 1, 3) || ' ' || substring(mobile_number, 4, 4) || '-' || substring(mobile_number, 8, 4),
 substring(mobile_number, 1, 10), mobile_number || '0', 'x' || mobile_number, replace(tele_no, '-', ''), ' ' || tele_no || ' ',
 replace(tele_no, '-', ' '), lower(id_card), ' ' || id_card, substring(id_card, 1, 17), '', ' ']
"""

RANKED = """
  SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
    l_returnflag, l_linestatus
  FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
    l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
    l_linestatus DESC) = 1
"""

# name, type, unsigned, comment of the columns of a part's definition; expressions over part.
_COLUMNS = [
    ("'id'", "'int(11)'", "false", "'key'"),
    ("'part_id'", "'bigint(20)'", "true", "p_name || ', it''s'"),
    ("'price'", "'decimal(' || (p_size + 5) || ',' || (p_size % 14) || ')'", "false", "''"),
    ("'name_' || p_size", "'varchar(' || p_size || ')'", "false", "'(a,b)'"),
    ("'kind'", "'enum(''' || p_type || ''',''a b'')'", "false", "''"),
    ("'made_at'", "'datetime'", "false", "''"),
    ("'sold_at'", "'datetime(6)'", "false", "''"),
    ("'note'", "'mediumtext'", "false", "''"),
    ("'level'", "'smallint(6)'", "true", "''"),
    ("'grade'", "'mediumint(9)'", "false", "''"),
    ("'update_timestamp'", "'timestamp(6)'", "false", "''"),
]

_PRICE = """
CASE WHEN p_size + 5 > 27 AND p_size % 14 > 9 THEN 'decimal(27,8)'
     WHEN p_size + 5 > 27 THEN 'decimal(27,' || (p_size % 14) || ')'
     WHEN p_size % 14 > 9 THEN 'decimal(' || (p_size + 5) || ',8)'
     ELSE 'decimal(' || (p_size + 5) || ',' || (p_size % 14) || ')' END
"""

# stream, target, Spark, logical and wire type of the same columns.
_TYPES = [
    ("'int'", "'int(11)'", "'int'", "'raw'", "'int'"),
    ("'bigint'", "'bigint(20)'", "'decimal(20,0)'", "'raw'", "'string'"),
    (_COLUMNS[2][1], _PRICE, _PRICE, "'raw'", "'string'"),
    (_COLUMNS[3][1], "'string'", "'string'", "'raw'", "'string'"),
    (_COLUMNS[4][1], _COLUMNS[4][1], "'string'", "'raw'", "'string'"),
    ("'timestamp(3)'", "'datetime'", "'timestamp_ntz'", "'io.debezium.time.Timestamp'", "'bigint'"),
    ("'datetime(6)'", "'datetime(6)'", "'timestamp_ntz'", "'io.debezium.time.MicroTimestamp'", "'bigint'"),
    ("'string'", "'text'", "'string'", "'raw'", "'string'"),
    ("'int'", "'smallint(6)'", "'int'", "'raw'", "'int'"),
    ("'int'", "'int(9)'", "'int'", "'raw'", "'int'"),
    ("'timestamp(3)'", "'datetime'", "'timestamp_ntz'", "'io.debezium.time.ZonedTimestamp'", "'string'"),
]


def _per_column(values: list[tuple], names: list[str]) -> str:
    parts = []
    for i, row in enumerate(values):
        columns = ", ".join(f"{v} AS {n}" for v, n in zip(row, names, strict=True))
        parts.append(f"SELECT 'part_' || p_partkey AS table_name, {i} AS idx, {columns} FROM part")
    return " UNION ALL ".join(parts)


def _target_ddl() -> str:
    lines = []
    for (name, _, _, comment), types in zip(_COLUMNS, _TYPES, strict=True):
        shown = f"replace({comment}, '''', chr(92) || '''')"
        lines.append(
            f"'  `' || {name} || '` ' || {types[2]} || CASE WHEN {comment} <> '' THEN ' COMMENT ''' || {shown} || '''' ELSE '' END"
        )
    body = " || ',' || chr(10) || ".join(f"({line})" for line in lines)
    return f"""
    SELECT 'part_' || p_partkey AS table_name,
      'CREATE TABLE IF NOT EXISTS `ods`.`part_' || p_partkey || '` (' || chr(10) || {body} || chr(10)
      || ') USING parquet CLUSTERED BY (`id`' || (CASE WHEN p_size > 25 THEN ', `part_id`' ELSE '' END)
      || ') INTO 16 BUCKETS COMMENT ''' || (CASE WHEN p_size > 10 THEN p_brand ELSE '' END) || '''' AS ddl
    FROM part WHERE p_size <> 50
    """


# Rule expected for each of the column sets, in their order.
_FILTER_RULES = (
    "last_modify", "full", "full", "update_timestamp", "update_time", "update_date", "operator_time", "either",
    "occur_time", "in_bill_time", "full", "unregistered",
)
assert len(_FILTER_RULES) == len(FILTER_CASES)


def _filter_choice() -> str:
    since = "2022-08-01 00:00:00"
    cases = []
    for i, rule in enumerate(_FILTER_RULES):
        predicate = f"{rule}>='{since}'"
        if rule == "full":
            predicate = "1=1"
        elif rule == "either":
            predicate = f"occur_time>='{since}' or in_bill_time>='{since}'"
        elif rule == "unregistered":
            predicate = "-"
        cases.append((i, rule, predicate.replace("'", "''")))
    rules = " ".join(f"WHEN {i} THEN '{r}'" for i, r, _ in cases)
    predicates = " ".join(f"WHEN {i} THEN '{p}'" for i, _, p in cases)
    n = len(cases)
    return (
        f"SELECT 'part_' || p_partkey AS table_name, CASE p_partkey % {n} {rules} END AS rule, "
        f"CASE p_partkey % {n} {predicates} END AS predicate FROM part"
    )


_KEYWORD_LIST = "[" + ", ".join(f"'{k}'" for k in KEYWORDS) + "]"

_SENSITIVE = f"""
WITH columns AS (
  SELECT p_partkey, p_size, unnest(range(8)) AS i,
    unnest(['MOBILE_' || p_size, 'idCardNo' || p_size, 'id-card', 'contact_name', 'recall_flag', 'remark',
      lower(p_type) || '_telephone', lower(p_brand)]) AS column_name
  FROM part
), found AS (
  SELECT *, list_filter({_KEYWORD_LIST}, lambda k: contains(lower(column_name), lower(k))) AS hits FROM columns
)
SELECT CASE WHEN p_size > 25 THEN '{ID_ONLY_TABLE}' ELSE 'orders' END AS table_name,
  i + p_partkey * 100 AS idx, column_name, array_to_string(hits, '/') AS keywords,
  CASE WHEN p_size > 25 THEN 2 ELSE 1 END AS mode
FROM found WHERE len(hits) > 0
"""

_LOOKUP = """
WITH conn AS (
  SELECT 's' || s_suppkey AS connection_id, 'db-' || s_nationkey AS hostname, s_nationkey + 3306 AS port,
    CASE WHEN s_nationkey > 10 THEN '?useSSL=false' ELSE '' END AS ext
  FROM supplier
), entry AS (
  SELECT p_partkey,
    CASE WHEN p_size < 45 THEN 's' || (p_partkey * 7 % 1300) END AS connection_id,
    CASE WHEN p_size < 45 THEN 'ods_shop_part_' || p_partkey END AS target
  FROM part
)
SELECT 'part_' || e.p_partkey AS table_name, 'shop' AS db_name, coalesce(e.connection_id, '-') AS connection_id,
  coalesce(e.target, '-') AS target,
  coalesce('jdbc:mysql://' || c.hostname || ':' || c.port || '/shop' || c.ext, '-') AS url,
  CASE WHEN e.connection_id IS NULL THEN 'no import entry' WHEN c.hostname IS NULL THEN 'no connection' ELSE 'ok' END AS status
FROM entry e LEFT JOIN conn c ON e.connection_id = c.connection_id
"""

ORDERS_TEXT = """
  SELECT 'orders' AS tbl, o_orderkey AS pk, o_custkey || '|' || o_orderstatus || '|' || printf('%.2f', o_totalprice) || '|' ||
    epoch_us(o_orderdate) || '|' || o_orderpriority AS detail FROM orders
"""

OPEN_STATES = """
  SELECT o_orderkey, 'O ' || o_orderpriority AS state FROM orders
  WHERE o_orderkey % 5 <> 0 AND CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey % 2 = 0 ELSE o_orderstatus = 'O' END
"""

UPSERT_LATEST = """
  SELECT user_id, event_type, k FROM (
    SELECT user_id, event_type, json_extract(props, '$.k')::bigint AS k FROM events WHERE event_type <> 'view'
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
  WHERE event_type <> 'error'
"""

ORACLE: dict[str, str] = {
    "cdc_envelope": f"""
        SELECT {OPS} AS op, 'shop' AS db, 'users' AS tbl, epoch_us(ts) // 1000 AS ts_ms,
          'bin.' || lpad((ts::date - DATE '1970-01-01')::varchar, 6, '0') AS file,
          epoch_us(ts) - epoch_us(date_trunc('day', ts)::timestamp) AS pos, event_id AS row_no,
          event_type <> 'signup' AS has_before, event_type <> 'error' AS has_after,
          CASE WHEN event_type <> 'error' THEN event_type END AS event_type
        FROM events""",
    "cdc_scope": f"SELECT tbl, op, pk FROM ({SHOP_LOG}) WHERE tbl IN ('orders', 'customer')",
    "cdc_start_at": f"""
        SELECT epoch_us(ts) // 1000 AS ts_ms, event_id, {OPS} AS op FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'""",
    "cdc_op_counts": f"""
        SELECT tbl, op, CASE op WHEN 'd' THEN 'delete' ELSE 'upsert' END AS action, count(*) AS n
        FROM (SELECT tbl, op FROM ({SHOP_LOG}) UNION ALL SELECT 'users', {OPS} FROM events) GROUP BY tbl, op""",
    "cdc_route_counts": f"""
        SELECT 'ods_shop_' || tbl AS target, 'ods_shop_' AS prefix, count(*) AS n FROM ({SHOP_LOG})
        WHERE tbl <> 'ghost' GROUP BY tbl""",
    "cdc_unknown_tables": "SELECT 'ghost' AS tbl, n_name FROM nation",
    "cdc_quarantine": """
        SELECT CASE WHEN event_type IN ('signup', 'error') THEN 'users' ELSE '-' END AS tbl,
          CASE event_type WHEN 'signup' THEN 'upsert' WHEN 'error' THEN 'delete'
            WHEN 'click' THEN 'unknown_table' ELSE 'quarantine' END AS action, count(*) AS n
        FROM events GROUP BY 1, 2""",
    "cdc_after_typed": f"""
        SELECT o_orderkey, o_orderdate AS from_ms, o_orderdate + to_microseconds(o_custkey) AS from_us,
          o_orderdate + to_microseconds(o_custkey) AS from_ns, strftime(o_orderdate, '%Y-%m-%d') AS from_day,
          o_orderdate + INTERVAL 8 HOUR AS from_iso,
          {_time('(o_orderkey * 1000003337) % 86400000000')} AS from_time,
          printf('%.2f', o_totalprice) AS price,
          CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS priority
        FROM orders""",
    "time_of_day": f"""
        SELECT event_id, {_time('us')} AS time_us, {_time('us')} AS time_ns FROM (
          SELECT event_id, event_id * 1000003 % 6040798 * 1000000 - 3020399000000 + user_id % 3 * 250 AS us FROM events
        )""",
    "cdc_after_append": "SELECT user_id, event_id, event_type, value, ts FROM events WHERE event_type <> 'error'",
    "cdc_latest_per_key": _LATEST.format(extra=", props"),
    "cdc_apply": LATEST_USERS,
    "cdc_apply_composite": RANKED,
    "cdc_stream_sync": TARGETS,
    "cdc_many_tables": """
        SELECT 'orders_' || CASE WHEN o_custkey % 2 = 0 THEN 0 ELSE o_custkey % 24 END AS tbl, o_orderkey AS pk,
          o_custkey || '|' || o_orderstatus AS detail FROM orders""",
    "topic_round_trip": TARGETS,
    "cdc_apply_concurrent": LATEST_USERS,
    "cdc_delete_where": f"{ORDERS_TEXT} WHERE NOT (o_orderkey < {CUT} AND o_orderstatus = 'F' AND o_totalprice > 100000)",
    "cdc_truncate": f"""{ORDERS_TEXT} WHERE o_orderkey > {CUT}
        UNION ALL SELECT 'customer', c_custkey, c_name || '|' || c_nationkey || '|' || c_mktsegment FROM customer""",
    "cdc_added_column": """
        SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN lower(c_name) ELSE c_name END AS c_name,
          CASE WHEN c_custkey % 5 = 0 THEN c_nationkey END::integer AS c_nationkey,
          CASE WHEN c_custkey % 5 = 0 THEN c_mktsegment END AS c_mktsegment FROM customer""",
    "cdc_failover": LATEST_USERS,
    "sql_filter_change": OPEN_STATES,
    "sql_stream_insert": OPEN_STATES,
    "cdc_lookup": f"SELECT * FROM ({RANKED}) WHERE l_linenumber = 2",
    "cdc_stream_scoped": f"""
        WITH t AS (SELECT * FROM ({TARGETS}) WHERE tbl IN ('customer', 'supplier') AND 1700000000000 + pk >= {SCOPE_START})
        SELECT tbl, pk, detail FROM t UNION ALL SELECT 'audit of ' || tbl, count(*), '0' FROM t GROUP BY tbl""",
    "cdc_replay_audit": f"""
        SELECT tbl, 'ok' AS status, count(*) AS events, count(*) AS upserts, 0::bigint AS deletes, 0::bigint AS quarantined
        FROM ({SHOP_LOG}) WHERE tbl <> 'ghost' GROUP BY tbl
        UNION ALL SELECT '-', 'unknown_table', count(*), 0, 0, count(*) FROM nation
        UNION ALL SELECT 'users', 'ok', (SELECT count(*) FROM events), count(*) FILTER (event_type <> 'error'),
          count(*) FILTER (event_type = 'error'), 0
        FROM (SELECT event_type FROM events
          QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)""",
    "cdc_bad_values": """
        SELECT o_orderkey, CASE WHEN o_totalprice < 100000 THEN printf('%.2f', o_totalprice) END AS price,
          CASE WHEN o_orderstatus <> 'F' THEN o_orderdate END AS "at",
          CASE WHEN o_custkey % 10 = 0 THEN 'no position'
            WHEN o_totalprice >= 100000 THEN 'column price cannot hold ' || printf('%.2f', o_totalprice)
            WHEN o_orderstatus = 'F' THEN 'column at cannot hold not a time' ELSE '-' END AS bad
        FROM orders""",
    "cdc_stream_audit": f"""
        SELECT CASE WHEN tbl = 'ghost' THEN '-' ELSE tbl END AS tbl,
          CASE WHEN tbl = 'ghost' THEN 'unknown_table' ELSE 'ok' END AS status, count(*) AS events,
          count(*) FILTER (tbl = 'ghost') AS quarantined
        FROM (SELECT tbl FROM ({SHOP_LOG}) UNION ALL SELECT 'users' FROM events) GROUP BY tbl""",
    "sync_audit": f"""
        SELECT CASE WHEN tbl = 'ghost' THEN '-' ELSE tbl END AS tbl,
          CASE WHEN tbl = 'ghost' THEN '-' ELSE 'ods_shop_' || tbl END AS target,
          CASE WHEN tbl = 'ghost' THEN 'unknown_table' ELSE 'ok' END AS status, count(*) AS events,
          count(*) FILTER (tbl <> 'ghost') AS upserts, 0::bigint AS deletes, count(*) FILTER (tbl = 'ghost') AS quarantined
        FROM ({SHOP_LOG}) GROUP BY tbl""",
    "sql_insert_select": "SELECT c_custkey, c_name FROM customer",
    "sql_insert_repeat": "SELECT c_custkey, c_name || '-2' AS c_name FROM customer",
    "mask_forms": f"""
        WITH n AS (SELECT c_custkey, unnest({_FORMS}) AS number, unnest(range(14))::integer AS form FROM ({PEOPLE}))
        SELECT c_custkey, form, {_mask('number', 1).removesuffix('number')} all_kinds, {_mask('number', 2).removesuffix('number')} id_only
        FROM n""",
    "mask_batch_mode1": _masked(1),
    "mask_batch_mode2": _masked(2),
    "mask_exempt_table": f"{_masked(1, ', ' + repr('orders') + ' AS tbl')} UNION ALL {_masked(2, ', ' + repr(ID_ONLY_TABLE) + ' AS tbl')}",
    "masking_rules": "SELECT p_partkey, 'list_' || p_partkey AS key, p_brand || '=' || p_type AS value FROM part",
    "sensitive_columns": _SENSITIVE,
    "backfill_filter_choice": _filter_choice(),
    "backfill_filter_by_text": f"SELECT table_name, rule FROM ({_filter_choice()})",
    "backfill_since": f"""
        SELECT o_orderkey, o_orderdate AS update_time, o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '{SINCE}'""",
    "backfill_or": f"""
        SELECT * FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate AS occur_time,
          l_shipdate + to_days(l_linenumber * 30) AS in_bill_time FROM lineitem)
        WHERE occur_time >= TIMESTAMP '{SINCE}' OR in_bill_time >= TIMESTAMP '{SINCE}'""",
    "backfill_full": "SELECT c_custkey, c_name, c_mktsegment FROM customer",
    "backfill_merge": f"""
        SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '{SINCE}' THEN lower(o_orderstatus) ELSE o_orderstatus END
          AS o_orderstatus, o_orderdate, printf('%.2f', o_totalprice) AS price FROM orders""",
    "backfill_repeat": """
        SELECT 'orders' AS tbl, o_orderkey AS pk, o_custkey || '|' || o_orderstatus || '2|' || printf('%.2f', o_totalprice) || '|' ||
          epoch_us(o_orderdate) || '|' || o_orderpriority AS detail FROM orders""",
    "backfill_audit": """
        SELECT 'orders' AS tbl, 'ods_shop_orders' AS target, 'ok' AS status, count(*) AS upserts, '-' AS error FROM orders
        UNION ALL SELECT 'supplier', 'ods_shop_supplier', 'ok', count(*), '-' FROM supplier
        UNION ALL SELECT 'customer', 'ods_shop_customer', 'failed', 0, 'no known update column'""",
    "ddl_specs": f"""
        SELECT t.table_name, t.idx, c.column_name, t.spark_type, t.logical_type, t.wire_type,
          CASE WHEN t.idx = 0 THEN 1 WHEN t.idx = 1 AND p_size > 25 THEN 2 ELSE 0 END::integer AS key_position
        FROM ({_per_column(_TYPES, ["stream_type", "target_type", "spark_type", "logical_type", "wire_type"])}) t
        JOIN ({_per_column(_COLUMNS, ["column_name", "mysql_type", "unsigned", "comment"])}) c
          ON t.table_name = c.table_name AND t.idx = c.idx
        JOIN part ON t.table_name = 'part_' || p_partkey WHERE p_size <> 50""",
    "ddl_columns": _per_column(_COLUMNS, ["column_name", "mysql_type", "unsigned", "comment"]),
    "ddl_type_map": _per_column(_TYPES, ["stream_type", "target_type", "spark_type", "logical_type", "wire_type"]),
    "ddl_primary_keys": """
        SELECT 'part_' || p_partkey AS table_name,
          CASE WHEN p_size = 50 THEN '' WHEN p_size > 25 THEN 'id,part_id' ELSE 'id' END AS keys,
          CASE WHEN p_size > 10 THEN p_brand ELSE '' END AS table_comment FROM part""",
    "ddl_errors": "SELECT 'part_' || p_partkey AS table_name, 'no primary key' AS error FROM part WHERE p_size = 50",
    "target_ddl": _target_ddl(),
    "catalog_lookup": _LOOKUP,
    "job_table_list": """
        SELECT 'db_' || c_custkey AS mysql_db, unnest([0, 1, 2]) AS position,
          unnest([lower(c_mktsegment), 'orders_' || c_nationkey, 't' || c_custkey]) AS table_name FROM customer""",
    "missing_targets": """
        SELECT 'ods' AS db, 'ods_' || k AS target FROM (
          (SELECT c_custkey AS k FROM customer UNION SELECT p_partkey FROM part) EXCEPT SELECT o_custkey FROM orders)""",
    "upsert_kafka_latest": UPSERT_LATEST,
    "upsert_stream": UPSERT_LATEST,
    "topic_replay": TARGETS,
    "cdc_stop_resume": TARGETS,
    "backfill_resume": """
        SELECT 'orders' AS tbl, o_orderkey AS pk, o_custkey || '|' || lower(o_orderstatus) || '|' || printf('%.2f', o_totalprice) || '|' ||
          epoch_us(o_orderdate) || '|' || o_orderpriority AS detail FROM orders
        UNION ALL SELECT 'scans of range', i, CASE i WHEN 2 THEN '2' ELSE '1' END FROM range(5) t(i)
        UNION ALL SELECT 'audit', count(*), 'ok' FROM orders""",
    "jdbc_ranges": """
        SELECT l_orderkey, l_linenumber, 1 AS parts, least(6, (first - 1) // ((n + 6) // 7))::integer AS part
        FROM (SELECT l_orderkey, l_linenumber, rank() OVER (ORDER BY l_orderkey, l_linenumber) AS first,
          count(*) OVER () AS n FROM lineitem)""",
    "url_time_zone": """
        SELECT s_suppkey, 'jdbc:mysql://h' || s_suppkey || '/shop' || CASE s_suppkey % 4 WHEN 0 THEN '?serverTimezone=Asia/Shanghai'
          WHEN 1 THEN '?serverTimezone=UTC&serverTimezone=GMT%2B8' ELSE '?serverTimezone=GMT%2B8' END AS url FROM supplier""",
    "existing_targets": """
        SELECT 'ods_n' || n_nationkey AS target, 'before' AS found FROM nation WHERE n_regionkey = 0
        UNION ALL SELECT 'ods_n' || n_nationkey, 'after' FROM nation
        UNION ALL SELECT 'ods_n' || n_nationkey, 'created' FROM nation WHERE n_regionkey <> 0""",
    "registered_functions": """
        SELECT o_orderkey, printf('%.2f', o_totalprice) AS price, left(o_orderpriority, 1) || '...' AS contact FROM orders""",
    "kafka_payload_decode": """
        SELECT 'ods_users' AS topic, (user_id % 3)::integer AS part, event_id AS pos, event_type,
          json_extract(props, '$.k')::bigint AS k FROM events WHERE event_type <> 'error'""",
    "to_kafka_records": """
        SELECT '{"c_custkey":' || c_custkey || '}' AS key,
          '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_nationkey":' || c_nationkey || ',"c_acctbal":' ||
            c_acctbal || ',"c_mktsegment":"' || c_mktsegment || '"}' AS value,
          'ods_customer' AS topic FROM customer""",
    "cdc_topic_records": """
        SELECT '{"c_custkey":' || c_custkey || '}' AS key, '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name ||
          '","c_nationkey":' || c_nationkey || ',"c_mktsegment":"' || c_mktsegment || '"}' AS value,
          'ods_shop_customer' AS topic FROM customer
        UNION ALL SELECT '{"s_suppkey":' || s_suppkey || '}', '{"s_suppkey":' || s_suppkey || ',"s_name":"' || s_name ||
          '","s_nationkey":' || s_nationkey || '}', 'ods_shop_supplier' FROM supplier
        UNION ALL SELECT '{"o_orderkey":' || o_orderkey || '}', '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey ||
          ',"o_orderstatus":"' || o_orderstatus || '","o_totalprice":' || printf('%.2f', o_totalprice) || ',"o_orderdate":"' ||
          strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') || '","o_orderpriority":"' || o_orderpriority || '"}', 'ods_shop_orders'
        FROM orders
        UNION ALL SELECT '{"user_id":' || user_id || '}', CASE WHEN event_type <> 'error' THEN '{"user_id":' || user_id ||
          ',"event_id":' || event_id || ',"event_type":"' || event_type || '","value":' || value || ',"ts":"' ||
          strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '"}' END, 'ods_shop_users' FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "to_ndjson": """
        SELECT '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus ||
          '","o_totalprice":' || o_totalprice || ',"o_orderdate":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') ||
          '","o_orderpriority":"' || o_orderpriority || '","priority":' ||
          CASE WHEN o_orderstatus <> 'F' THEN '"' || o_orderpriority || '"' ELSE 'null' END || '}' AS value FROM orders""",
    "ndjson_explode": """
        SELECT c_custkey::varchar AS id, c_name AS name, c_nationkey::varchar AS age FROM customer
        UNION ALL SELECT (c_custkey + 1)::varchar, c_mktsegment, (c_nationkey + 1)::varchar FROM customer""",
}
