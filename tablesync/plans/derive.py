"""Change logs, definitions and settings derived from the test tables by Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.functions.temporal import EPOCH
from tablesync.spec import ColumnSpec, MaskRules, TableSpec

# Column-name keywords that mark personal data, and the table with ID-only masking (fixed values).
KEYWORDS = (
    "mobile", "phone", "id_card", "idCard", "id-card", "identity", "tele", "contact", "call",
    "shouji", "dianhua", "lianxi", "haoma",
)
ID_ONLY_TABLE = "orders_test"

USERS = TableSpec(
    "users",
    "ods_shop_users",
    ("user_id",),
    (
        ColumnSpec("user_id", "bigint"),
        ColumnSpec("event_id", "bigint"),
        ColumnSpec("event_type", "string"),
        ColumnSpec("value", "double"),
        ColumnSpec("ts", "timestamp_ntz", "io.debezium.time.MicroTimestamp", "bigint"),
    ),
)

ORDERS = TableSpec(
    "orders",
    "ods_shop_orders",
    ("o_orderkey",),
    (
        ColumnSpec("o_orderkey", "bigint"),
        ColumnSpec("o_custkey", "bigint"),
        ColumnSpec("o_orderstatus", "string"),
        ColumnSpec("o_totalprice", "decimal(15,2)", "raw", "string"),
        ColumnSpec("o_orderdate", "timestamp_ntz", "io.debezium.time.Timestamp", "bigint"),
        ColumnSpec("o_orderpriority", "string"),
    ),
)

CUSTOMER = TableSpec(
    "customer",
    "ods_shop_customer",
    ("c_custkey",),
    (
        ColumnSpec("c_custkey", "bigint"),
        ColumnSpec("c_name", "string"),
        ColumnSpec("c_nationkey", "int"),
        ColumnSpec("c_mktsegment", "string"),
    ),
)

SUPPLIER = TableSpec(
    "supplier",
    "ods_shop_supplier",
    ("s_suppkey",),
    (ColumnSpec("s_suppkey", "bigint"), ColumnSpec("s_name", "string"), ColumnSpec("s_nationkey", "int")),
)

LINEITEM_ORDER = (
    ("l_shipdate", "timestamp_ntz"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_quantity", "double"),
    ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
    ("l_linestatus", "string"),
)

LINEITEM = TableSpec(
    "lineitem",
    "ods_shop_lineitem",
    ("l_orderkey", "l_linenumber"),
    (ColumnSpec("l_orderkey", "bigint"), ColumnSpec("l_linenumber", "int"))
    + tuple(ColumnSpec(n, t) for n, t in LINEITEM_ORDER),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def micros(ts: Column) -> Column:
    """Microseconds from the epoch to a zone-free timestamp."""
    return F.timestamp_diff("MICROSECOND", F.expr(EPOCH), ts)


def millis(ts: Column) -> Column:
    return F.timestamp_diff("MILLISECOND", F.expr(EPOCH), ts)


def epoch_day(ts: Column) -> Column:
    return F.unix_date(ts.cast("date"))


def source(
    name: str | Column, file: Column, pos: Column, row: Column, ts_ms: Column, server: Column | None = None
) -> Column:
    return F.struct(
        F.lit("shop").alias("db"),
        (F.lit(name) if isinstance(name, str) else name).alias("table"),
        ts_ms.alias("ts_ms"),
        file.alias("file"),
        pos.cast("bigint").alias("pos"),
        row.cast("bigint").alias("row"),
        (F.lit(1) if server is None else server).alias("server_id"),
        F.lit("false").alias("snapshot"),
    )


def event(src: Column, op: Column, before: Column, after: Column) -> Column:
    return F.to_json(F.struct(src.alias("source"), op.alias("op"), before.alias("before"), after.alias("after")))


def user_log(spark: SparkSession, sf_dir: str, takeover: str | None = None) -> DataFrame:
    """``events`` as the change log of a table keyed by user: signup creates, error deletes.

    The log starts a new file every day; the offset is the microsecond of the day. From the day of ``takeover`` on
    a second server writes, whose files are numbered from 1.
    """
    e = table(spark, sf_dir, "events")
    op = F.when(F.col("event_type") == "signup", "c").when(F.col("event_type") == "error", "d").otherwise("u")
    day = epoch_day(F.col("ts"))
    second, since = F.lit(False), F.lit(0)
    if takeover:
        since = F.unix_date(F.lit(takeover).cast("date"))
        second = day >= since
    server = F.when(second, 2).otherwise(1)
    src = source(
        "users",
        F.format_string("bin.%06d", F.when(second, day - since + 1).otherwise(day)),
        micros(F.col("ts")) - day.cast("bigint") * 86_400_000_000,
        F.col("event_id"),
        millis(F.col("ts")),
        server,
    )
    after = F.struct("user_id", "event_id", "event_type", "value", micros(F.col("ts")).alias("ts"))
    return e.select(
        event(src, op, F.when(op != "c", F.struct("user_id")), F.when(op != "d", after)).alias("value"),
        op.alias("op"),
        server.alias("server"),
        "event_id",
    )


def shop_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot of orders, creation of customers, updates of suppliers, and a table no job lists."""

    def log(name: str, op: str, key: str, image: Column, alias: str | None = None) -> DataFrame:
        src = source(alias or name, F.lit("bin.000001"), F.col(key), F.lit(0), F.lit(1_700_000_000_000) + F.col(key))
        before = F.struct(key) if op == "u" else F.lit(None).cast("struct<x:int>")
        return table(spark, sf_dir, name).select(event(src, F.lit(op), before, image).alias("value"))

    order = F.struct(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.format_string("%.2f", "o_totalprice").alias("o_totalprice"),
        millis(F.col("o_orderdate")).alias("o_orderdate"),
        "o_orderpriority",
    )
    return (
        log("orders", "r", "o_orderkey", order)
        .union(log("customer", "c", "c_custkey", F.struct(*CUSTOMER.column_names)))
        .union(log("supplier", "u", "s_suppkey", F.struct(*SUPPLIER.column_names)))
        .union(log("nation", "c", "n_nationkey", F.struct("n_nationkey", "n_name"), alias="ghost"))
    )


STATES = TableSpec(
    "states",
    "ods_shop_states",
    ("o_orderkey",),
    (ColumnSpec("o_orderkey", "bigint"), ColumnSpec("o_orderstatus"), ColumnSpec("o_orderpriority")),
)


def state_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The states of ``orders``: created as they are, two thirds updated, a fifth deleted; old images are whole."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    updated = F.when(F.col("o_custkey") % 2 == 0, "O").otherwise("C")

    def image(status: Column) -> Column:
        return F.struct("o_orderkey", status.alias("o_orderstatus"), "o_orderpriority")

    first, second = image(F.col("o_orderstatus")), image(updated)
    last = F.when(key % 3 != 0, second).otherwise(first)
    none = F.lit(None).cast("struct<o_orderkey:bigint,o_orderstatus:string,o_orderpriority:string>")
    parts = []
    for step, (op, rows, before, after) in enumerate(
        (("c", o, none, first), ("u", o.where(key % 3 != 0), first, second), ("d", o.where(key % 5 == 0), last, none))
    ):
        src = source("states", F.lit("bin.000001"), key * 3 + step, F.lit(0), F.lit(1_700_000_000_000) + key)
        parts.append(rows.select(event(src, F.lit(op), before, after).alias("value"), F.lit(op).alias("op")))
    return parts[0].union(parts[1]).union(parts[2])


def catalog(spark: SparkSession, *specs: TableSpec) -> DataFrame:
    return spark.createDataFrame([(s.table, s.target) for s in specs], "table string, target string")


def personal_data(customers: DataFrame) -> DataFrame:
    """Invented phone and ID numbers computed from the customer key."""
    k = F.col("c_custkey")

    def text(col: Column, width: int = 0) -> Column:
        return F.lpad(col.cast("string"), width, "0") if width else col.cast("string")

    check = F.when(k % 11 == 10, "X").otherwise(text(k % 11))
    return customers.select(
        "c_custkey",
        F.concat(F.lit("1"), text(3 + k % 7), text((k * 7919) % 1_000_000_000, 9)).alias("mobile_number"),
        F.concat(F.lit("0"), text(10 + k % 80), F.lit("-"), text((k * 104729) % 100_000_000, 8)).alias("tele_no"),
        F.concat(
            F.lit("110105"), text(1950 + k % 60), text(1 + k % 12, 2), text(1 + k % 28, 2), text(k % 1000, 3), check
        ).alias("id_card"),
    )


def personal_spec(name: str) -> TableSpec:
    return TableSpec(
        name,
        f"ods_shop_{name}",
        ("c_custkey",),
        (ColumnSpec("c_custkey", "bigint"), *[ColumnSpec(c) for c in ("mobile_number", "tele_no", "id_card")]),
    )


def mask_rules() -> MaskRules:
    return MaskRules(KEYWORDS, (ID_ONLY_TABLE,))


def part_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table definition per part, its types and comments taken from the part."""
    size = F.col("p_size").cast("string")
    lines = F.array(
        F.concat(F.lit("CREATE TABLE `part_"), F.col("p_partkey").cast("string"), F.lit("` (")),
        F.lit("  `id` int(11) NOT NULL AUTO_INCREMENT COMMENT 'key',"),
        F.concat(F.lit("  `part_id` bigint(20) unsigned NOT NULL DEFAULT '0' COMMENT '"), F.col("p_name"), F.lit(", it''s',")),
        F.format_string("  `price` decimal(%d,%d) DEFAULT NULL,", F.col("p_size") + 5, F.col("p_size") % 14),
        F.concat(F.lit("  `name_"), size, F.lit("` varchar("), size, F.lit(") DEFAULT 'COMMENT `x` y' COMMENT '(a,b)',")),
        F.concat(F.lit("  `kind` enum('"), F.col("p_type"), F.lit("','a b') DEFAULT NULL,")),
        F.lit("  `made_at` datetime DEFAULT NULL,"),
        F.lit("  `sold_at` datetime(6) DEFAULT NULL,"),
        F.lit("  `note` mediumtext,"),
        F.lit("  `level` smallint(6) unsigned DEFAULT NULL,"),
        F.lit("  `grade` mediumint(9) DEFAULT NULL,"),
        F.lit("  `update_timestamp` timestamp(6) NOT NULL DEFAULT CURRENT_TIMESTAMP(6) ON UPDATE CURRENT_TIMESTAMP(6),"),
        F.when(F.col("p_size") == 50, F.lit("  KEY `only_key` (`kind`)")).otherwise(
            F.concat(
                F.lit("  PRIMARY KEY (`id`"),
                F.when(F.col("p_size") > 25, F.lit(",`part_id`")).otherwise(""),
                F.lit(") USING BTREE,\n  KEY `by_kind` (`kind`)"),
            )
        ),
        F.concat(
            F.lit(") ENGINE=InnoDB AUTO_INCREMENT="), F.col("p_partkey").cast("string"), F.lit(" DEFAULT CHARSET=utf8"),
            F.when(F.col("p_size") > 10, F.concat(F.lit(" COMMENT='"), F.col("p_brand"), F.lit("'"))).otherwise(""),
        ),
    )
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("part_"), F.col("p_partkey").cast("string")).alias("table_name"),
        F.array_join(lines, "\n").alias("ddl"),
    )


# Column sets that reach every rule for choosing the update column (fixed values).
FILTER_CASES = (
    "last_modify datetime, update_time datetime",
    "id int(11), name varchar(9)",
    "id int(11), birth date",
    "update_timestamp datetime, update_time datetime",
    "update_time datetime",
    "update_date datetime",
    "operator_time datetime",
    "occur_time datetime, in_bill_time datetime",
    "occur_time datetime",
    "in_bill_time datetime",
    "occur_time timestamp",
    "created datetime",
)


def filter_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One definition per part; the part's key says which column set it gets."""
    bodies = []
    for case in FILTER_CASES:
        columns = [c.strip().split(" ") for c in case.split(",")]
        bodies.append("".join(f"  `{n}` {t} DEFAULT NULL,\n" for n, t in columns))
    chosen = F.element_at(F.array(*[F.lit(b) for b in bodies]), (F.col("p_partkey") % len(bodies) + 1).cast("int"))
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("part_"), F.col("p_partkey").cast("string")).alias("table_name"),
        F.concat(F.lit("CREATE TABLE `p` (\n"), chosen, F.lit("  PRIMARY KEY (`x`)\n) ENGINE=InnoDB")).alias("ddl"),
    )
