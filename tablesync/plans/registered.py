"""The queries the driver runs, one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.functions.masking import ALL_KINDS, ID_ONLY, mask_pii, register_masker
from tablesync.functions.temporal import convert, register_converter
from tablesync.operators import backfill, catalog, ddl, routing, sensitive
from tablesync.operators.audit import read_audit, summarise
from tablesync.operators.keyed_table import KeyedTable
from tablesync.operators.latest import latest_per_key
from tablesync.operators.sensitive import mask_columns
from tablesync.operators.typed import typed_rows
from tablesync.plans import derive, job
from tablesync.plans.batch_sync import batch_sync
from tablesync.plans.sql_sync import change_images, create_source_view, insert_available, insert_changes, insert_select
from tablesync.session import run_folder
from tablesync.sources import change_events, jdbc, kafka, ndjson, settings
from tablesync.spec import ColumnSpec, MaskRules, TableSpec
from tablesync.streaming import topics
from tablesync.streaming.sync import SyncOptions, compact_tables, run_available, stage, sync_batch, topic_records

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}

SINCE = "2000-01-01 00:00:00"
SCOPE_START = 1_700_000_000_010
# A log position amid the orders, and the day on which another server takes over.
CUT = 20_000
TAKEOVER = "2024-01-15"


def registered(query: Query) -> Query:
    REGISTERED[query.__name__] = query
    return query


# -- change events -----------------------------------------------------------


@registered
def cdc_envelope(spark, sf_dir):
    e = change_events.parse_envelope(derive.user_log(spark, sf_dir))
    return e.select(
        "op", "db", F.col("table").alias("tbl"), "ts_ms", "file", "pos", F.col("row").alias("row_no"),
        (F.col("before") != "{}").alias("has_before"),
        (F.col("after") != "{}").alias("has_after"),
        F.get_json_object("after", "$.event_type").alias("event_type"),
    )


@registered
def cdc_scope(spark, sf_dir):
    e = change_events.parse_envelope(derive.shop_log(spark, sf_dir))
    e = change_events.in_scope(e, "shop", ["orders", "customer"])
    return e.select(F.col("table").alias("tbl"), "op", F.col("pos").alias("pk"))


@registered
def cdc_start_at(spark, sf_dir):
    start = 1_705_276_800_000  # 2024-01-15 00:00:00
    e = change_events.start_at(change_events.parse_envelope(derive.user_log(spark, sf_dir)), start)
    return e.select("ts_ms", F.col("row").alias("event_id"), "op")


@registered
def cdc_op_counts(spark, sf_dir):
    both = derive.shop_log(spark, sf_dir).union(derive.user_log(spark, sf_dir).select("value"))
    e = change_events.parse_envelope(both).withColumn("action", change_events.action())
    return e.groupBy(F.col("table").alias("tbl"), "op", "action").agg(F.count("*").alias("n"))


@registered
def cdc_route_counts(spark, sf_dir):
    e = change_events.parse_envelope(derive.shop_log(spark, sf_dir))
    specs = derive.catalog(spark, derive.ORDERS, derive.CUSTOMER, derive.SUPPLIER)
    routed = routing.route(e, specs)
    prefix = catalog.table_prefix(F.col("target"), F.col("table"))
    return routed.groupBy("target", prefix.alias("prefix")).agg(F.count("*").alias("n"))


@registered
def cdc_unknown_tables(spark, sf_dir):
    e = change_events.parse_envelope(derive.shop_log(spark, sf_dir))
    lost = routing.unknown_tables(e, derive.catalog(spark, derive.ORDERS, derive.CUSTOMER, derive.SUPPLIER))
    return lost.select(F.col("table").alias("tbl"), F.get_json_object("after", "$.n_name").alias("n_name"))


@registered
def cdc_quarantine(spark, sf_dir):
    """Broken text, unknown operations and a table outside the job, counted beside good events."""
    e = derive.table(spark, sf_dir, "events")
    kind = F.col("event_type")
    text = F.when(kind == "purchase", F.concat(F.lit("not json "), F.col("props"))).otherwise(
        F.format_string(
            '{"source":{"db":"shop","table":"%s","pos":%d},"op":"%s","after":%s}',
            F.when(kind == "click", "ghost").otherwise("users"),
            "event_id",
            F.when(kind == "view", "t").when(kind == "error", "d").otherwise("c"),
            "props",
        )
    )
    staged = routing.classify(change_events.parse_envelope(e.select(text.alias("value"))), ["users"])
    return routing.action_counts(staged).select(
        F.coalesce("table", F.lit("-")).alias("tbl"), F.col("_action").alias("action"), F.col("events").alias("n")
    )


TYPED = TableSpec(
    "typed",
    "ods_typed",
    ("o_orderkey",),
    (
        ColumnSpec("o_orderkey", "bigint"),
        ColumnSpec("from_ms", "timestamp_ntz", "io.debezium.time.Timestamp", "bigint"),
        ColumnSpec("from_us", "timestamp_ntz", "io.debezium.time.MicroTimestamp", "bigint"),
        ColumnSpec("from_ns", "timestamp_ntz", "io.debezium.time.NanoTimestamp", "bigint"),
        ColumnSpec("from_day", "date", "io.debezium.time.Date", "int"),
        ColumnSpec("from_iso", "timestamp_ntz", "io.debezium.time.ZonedTimestamp", "string"),
        ColumnSpec("from_time", "string", "io.debezium.time.MicroTime", "bigint"),
        ColumnSpec("price", "decimal(15,2)", "raw", "string"),
        ColumnSpec("priority", "string"),
    ),
)


@registered
def cdc_after_typed(spark, sf_dir):
    o = derive.table(spark, sf_dir, "orders")
    ts = F.timestamp_add("MICROSECOND", F.col("o_custkey"), F.col("o_orderdate"))
    us = derive.micros(ts)
    image = F.struct(
        "o_orderkey",
        derive.millis(F.col("o_orderdate")).alias("from_ms"),
        us.alias("from_us"),
        (us * 1000 + 7).alias("from_ns"),
        derive.epoch_day(F.col("o_orderdate")).alias("from_day"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("from_iso"),
        ((F.col("o_orderkey") * 1_000_003_337) % 86_400_000_000).alias("from_time"),
        F.format_string("%.2f", "o_totalprice").alias("price"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")).alias("priority"),
    )
    src = derive.source("typed", F.lit("bin.000001"), F.col("o_orderkey"), F.lit(0), F.lit(0))
    log = o.select(derive.event(src, F.lit("c"), F.lit(None).cast("struct<x:int>"), image).alias("value"))
    t = typed_rows(change_events.parse_envelope(log), TYPED)
    return t.select(
        "o_orderkey", "from_ms", "from_us", "from_ns", F.col("from_day").cast("string").alias("from_day"),
        "from_iso", "from_time", F.col("price").cast("string").alias("price"), "priority",
    )


@registered
def time_of_day(spark, sf_dir):
    """Times from -838:59:59 to 838:59:59, from microseconds."""
    e = derive.table(spark, sf_dir, "events")
    us = F.col("event_id") * 1_000_003 % 6_040_798 * 1_000_000 - 3_020_399_000_000 + F.col("user_id") % 3 * 250
    return e.select(
        "event_id",
        convert(us, "io.debezium.time.MicroTime", "UTC").alias("time_us"),
        convert(us * 1000, "io.debezium.time.NanoTime", "UTC").alias("time_ns"),
    )


@registered
def cdc_after_append(spark, sf_dir):
    after = change_events.after_images(change_events.parse_envelope(derive.user_log(spark, sf_dir)))
    rows = typed_rows(after.withColumn("before", F.lit("{}")), derive.USERS)
    return rows.select(*derive.USERS.column_names)


@registered
def cdc_latest_per_key(spark, sf_dir):
    e = derive.table(spark, sf_dir, "events")
    last = latest_per_key(e, ["user_id"], F.struct("ts", "event_id"))
    return last.where(F.col("event_type") != "error")


# -- keyed targets -----------------------------------------------------------


def _user_changes(spark, sf_dir):
    log = derive.user_log(spark, sf_dir)
    return {op: typed_rows(change_events.parse_envelope(log.where(F.col("op") == op)), derive.USERS) for op in "duc"}


@registered
def cdc_apply(spark, sf_dir):
    """The user log in three batches that arrive in the wrong order: deletes, updates, creations."""
    target = KeyedTable.of(spark, run_folder(spark, "apply"), derive.USERS)
    for batch_id, changes in enumerate(_user_changes(spark, sf_dir).values()):
        target.apply(changes.drop("_bad"), "log", batch_id)
    return target.read()


@registered
def cdc_apply_composite(spark, sf_dir):
    """Every line item is an upsert on two keys; batches are merged into a compacted base."""
    return _line_items(spark, sf_dir).read()


def _line_items(spark, sf_dir):
    seq_type = "struct<" + ",".join(f"{n}:{t}" for n, t in derive.LINEITEM_ORDER) + ">"
    target = KeyedTable.of(spark, run_folder(spark, "composite"), derive.LINEITEM, seq_type=seq_type)
    rows = derive.table(spark, sf_dir, "lineitem").select(
        *derive.LINEITEM.column_names,
        F.lit("upsert").alias("_op"),
        F.struct(*[n for n, _ in derive.LINEITEM_ORDER]).alias("_seq"),
    )
    target.apply(rows.where(F.col("l_returnflag") != "R"), "log", 0)
    target.compact()
    target.apply(rows.where(F.col("l_returnflag") == "R"), "log", 1)
    return target


@registered
def cdc_stream_sync(spark, sf_dir):
    """The whole sync as a stream over text files, half of them in each micro-batch."""
    return _targets(spark, *_streamed(spark, sf_dir))


MANY = 24


@registered
def cdc_many_tables(spark, sf_dir):
    """The orders as the log of 13 tables by customer, of which one has half the orders; two batches, each one write for all."""
    number = F.when(F.col("o_custkey") % 2 == 0, 0).otherwise(F.col("o_custkey") % MANY)
    name = F.concat(F.lit("orders_"), number.cast("string"))
    src = derive.source(name, F.lit("bin.000001"), F.col("o_orderkey"), F.lit(0), F.lit(1_700_000_000_000))
    image = F.struct("o_orderkey", "o_custkey", "o_orderstatus")
    o = derive.table(spark, sf_dir, "orders")
    log = o.select("o_orderkey", derive.event(src, F.lit("c"), F.lit(None).cast("struct<x:int>"), image).alias("value"))
    numbers = [0, *range(1, MANY, 2)]
    specs = {f"orders_{i}": TableSpec(f"orders_{i}", f"ods_{i}", ("o_orderkey",), derive.ORDERS.columns[:3]) for i in numbers}
    root = run_folder(spark, "many-tables")
    for i in range(2):
        part = log.where(F.col("o_orderkey") % 2 == i).select("value")
        sync_batch(part, i, specs, root, SyncOptions(label="shop", db="shop"))
    return _targets(spark, root, specs)


@registered
def cdc_stop_resume(spark, sf_dir):
    """A stream that is stopped between its files and started again, its targets compacted meanwhile."""
    root, specs = run_folder(spark, "stop-resume"), SHOP
    log = _whole_log(spark, sf_dir)
    for i in range(3):
        part = log.where(F.pmod(F.crc32(F.col("value").cast("binary")), F.lit(3)) == i)
        part.repartition(4).write.mode("append").text(f"{root}/_input")
        events = change_events.read_change_events(spark, f"{root}/_input", streaming=True)
        run_available(spark, events, specs, root, SyncOptions(label="shop", db="shop"))
        if i < 2:
            compact_tables(spark, specs, root, full=i == 1)
    return _targets(spark, root, specs)


@registered
def cdc_stream_audit(spark, sf_dir):
    root, _ = _streamed(spark, sf_dir)
    audit = read_audit(spark, root)
    return audit.groupBy(F.coalesce("table", F.lit("-")).alias("tbl"), "status").agg(
        F.sum("events").alias("events"), F.sum("quarantined").alias("quarantined")
    )


SHOP = {s.table: s for s in (derive.USERS, derive.ORDERS, derive.CUSTOMER, derive.SUPPLIER)}


def _whole_log(spark, sf_dir):
    return derive.shop_log(spark, sf_dir).union(derive.user_log(spark, sf_dir).select("value"))


def _streamed(spark, sf_dir, specs=None, **options):
    root, specs = run_folder(spark, "stream"), specs or SHOP
    _whole_log(spark, sf_dir).repartition(16).write.text(f"{root}/_input")
    events = change_events.read_change_events(spark, f"{root}/_input", streaming=True, max_files_per_batch=8)
    run_available(spark, events, specs, root, SyncOptions(label="shop", db="shop", **options))
    return root, specs


def _targets(spark, root, specs):
    parts = [_as_text(KeyedTable.of(spark, root, s).read(), s) for s in specs.values()]
    return reduce(DataFrame.unionByName, parts)


def _as_text(rows, spec):
    """Rows of different tables in one form: ``tbl``, ``pk`` and the other columns as one text."""
    def text(c):
        value = F.col(c.name)
        if c.target == "timestamp_ntz":
            value = derive.micros(value)
        elif c.target == "double":
            value = F.format_string("%.2f", value)
        return F.coalesce(value.cast("string"), F.lit("-"))

    rest = [text(c) for c in spec.columns if c.name not in spec.keys]
    return rows.select(F.lit(spec.table).alias("tbl"), F.col(spec.keys[0]).alias("pk"), F.concat_ws("|", *rest).alias("detail"))


@registered
def cdc_stream_scoped(spark, sf_dir):
    """Two of the tables, events from a time on; other tables' events are left out."""
    specs = {t: SHOP[t] for t in ("customer", "supplier")}
    root, _ = _streamed(spark, sf_dir, specs, on_unknown="ignore", start=SCOPE_START)
    told = summarise(read_audit(spark, root)).select(
        F.concat(F.lit("audit of "), "table").alias("tbl"), F.col("events").alias("pk"), F.col("quarantined").cast("string").alias("detail")
    )
    return _targets(spark, root, specs).unionByName(told)


@registered
def cdc_replay_audit(spark, sf_dir):
    """A batch that is applied twice under one id leaves the audit of one run."""
    root = run_folder(spark, "replay")
    for _ in range(2):
        sync_batch(_whole_log(spark, sf_dir), 0, SHOP, root, SyncOptions(label="shop", db="shop"))
    return summarise(read_audit(spark, root)).select(
        F.coalesce("table", F.lit("-")).alias("tbl"), "status", "events", "upserts", "deletes", "quarantined"
    )


@registered
def cdc_apply_concurrent(spark, sf_dir):
    """Two writers with labels of their own and compactions by a third beside them."""
    folder = run_folder(spark, "concurrent")
    writers = [KeyedTable.of(spark, folder, derive.USERS) for _ in range(3)]
    for i, changes in enumerate(_user_changes(spark, sf_dir).values()):
        rows = changes.drop("_bad")
        writers[i % 2].apply(rows.where(F.col("event_id") % 2 == i % 2), f"writer-{i % 2}", i)
        writers[2].compact(full=i != 1)
        writers[1 - i % 2].apply(rows.where(F.coalesce(F.col("event_id") % 2 != i % 2, F.lit(True))), f"writer-{1 - i % 2}", i)
        writers[2].compact(full=i == 1)
    return writers[0].read()


@registered
def cdc_delete_where(spark, sf_dir):
    """A condition's rows are deleted as of a position; a third of the orders, from both sides of it, arrives later."""
    target = KeyedTable.of(spark, run_folder(spark, "delete-where"), derive.ORDERS)
    staged = change_events.in_scope(change_events.parse_envelope(derive.shop_log(spark, sf_dir)), "shop", ["orders"])
    changes = typed_rows(staged, derive.ORDERS).drop("_bad")
    late = F.col("o_custkey") % 3 == 0
    target.apply(changes.where(~late), "log", 0)
    target.compact()
    target.delete_where("o_orderstatus = 'F' AND o_totalprice > 100000", "rules", 0, {"file_no": 1, "pos": CUT, "row": 0})
    target.apply(changes.where(late & (F.col("o_custkey") % 2 == 0)), "log", 1)
    target.compact(full=True)
    target.apply(changes.where(late & (F.col("o_custkey") % 2 != 0)), "log", 2)
    return _as_text(target.read(), derive.ORDERS)


@registered
def cdc_truncate(spark, sf_dir):
    """A truncation of the orders amid their log; half of the orders arrive after it, from both sides."""
    root, specs = run_folder(spark, "truncate"), {t: SHOP[t] for t in ("orders", "customer")}
    src = derive.source("orders", F.lit("bin.000001"), F.lit(CUT), F.lit(1), F.lit(1_700_000_000_000))
    none = F.lit(None).cast("struct<x:int>")
    truncation = spark.range(1).select(derive.event(src, F.lit("t"), none, none).alias("value"))
    log = derive.shop_log(spark, sf_dir)
    late = F.crc32(F.col("value").cast("binary")) % 2 == 0
    options = SyncOptions(label="shop", db="shop", on_unknown="ignore")
    sync_batch(log.where(late).union(truncation), 0, specs, root, options)
    KeyedTable.of(spark, root, derive.ORDERS).compact()
    sync_batch(log.where(~late), 1, specs, root, options)
    return _targets(spark, root, specs)


@registered
def cdc_added_column(spark, sf_dir):
    """A compacted target is opened with two more columns, which a fifth of its rows then fill."""
    folder = run_folder(spark, "added-column")
    narrow = TableSpec("customer", "ods_customer", ("c_custkey",), derive.CUSTOMER.columns[:2])
    customers = derive.table(spark, sf_dir, "customer").withColumn("_op", F.lit("upsert"))
    before = KeyedTable.of(spark, folder, narrow)
    before.apply(customers.withColumn("_seq", before.position({"file_no": 1})), "load", 0)
    before.compact(full=True)
    target = KeyedTable.of(spark, folder, derive.CUSTOMER.with_target("ods_customer"))
    some = customers.where(F.col("c_custkey") % 5 == 0).withColumn("c_name", F.lower("c_name"))
    target.apply(some.withColumn("_seq", target.position({"file_no": 2})), "load", 1)
    return target.read()


@registered
def cdc_failover(spark, sf_dir):
    """The user log of two servers, of which the second numbers its files anew; the first one's events are partly late."""
    log, root = derive.user_log(spark, sf_dir, TAKEOVER), run_folder(spark, "failover")
    first, third = F.col("server") == 1, F.col("event_id") % 3 == 0
    for i, part in enumerate((first & ~third, ~first & ~third, third)):
        sync_batch(log.where(part), i, {"users": derive.USERS}, root, SyncOptions(label="shop", db="shop"))
    return KeyedTable.of(spark, root, derive.USERS).read()


@registered
def cdc_lookup(spark, sf_dir):
    """Keys looked up in a base with a log over it: the filter on the key reaches both."""
    return _line_items(spark, sf_dir).read().where(F.col("l_linenumber") == 2)


@registered
def cdc_bad_values(spark, sf_dir):
    """Values that their columns cannot hold are named, and the rows beside them typed."""
    o = derive.table(spark, sf_dir, "orders")
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    image = F.struct(
        "o_orderkey",
        F.format_string("%.2f", "o_totalprice").alias("price"),
        F.when(F.col("o_orderstatus") == "F", F.lit("not a time")).otherwise(iso).alias("at"),
    )
    pos = F.when(F.col("o_custkey") % 10 != 0, F.col("o_orderkey"))
    src = derive.source("bad", F.lit("bin.000001"), pos, F.lit(0), F.lit(0))
    log = o.select(derive.event(src, F.lit("c"), F.lit(None).cast("struct<x:int>"), image).alias("value"))
    columns = (
        ColumnSpec("o_orderkey", "bigint"),
        ColumnSpec("price", "decimal(7,2)", "raw", "string"),
        ColumnSpec("at", "timestamp_ntz", "io.debezium.time.ZonedTimestamp", "string"),
    )
    rows = typed_rows(change_events.parse_envelope(log), TableSpec("bad", "ods_bad", ("o_orderkey",), columns), time_zone="UTC")
    return rows.select("o_orderkey", F.col("price").cast("string").alias("price"), "at", F.coalesce("_bad", F.lit("-")).alias("bad"))


@registered
def sync_audit(spark, sf_dir):
    root = run_folder(spark, "audit")
    specs = {s.table: s for s in (derive.ORDERS, derive.CUSTOMER, derive.SUPPLIER)}
    sync_batch(derive.shop_log(spark, sf_dir), 0, specs, root, SyncOptions(label="shop", db="shop"))
    totals = summarise(read_audit(spark, root))
    return totals.select(
        F.coalesce("table", F.lit("-")).alias("tbl"), F.coalesce("target", F.lit("-")).alias("target"),
        "status", "events", "upserts", "deletes", "quarantined",
    )


@registered
def sql_insert_select(spark, sf_dir):
    e = change_events.in_scope(change_events.parse_envelope(derive.shop_log(spark, sf_dir)), "shop", ["customer"])
    view = create_source_view(typed_rows(e, derive.CUSTOMER), "customer")
    two = TableSpec("customer", "ods_names", ("c_custkey",), derive.CUSTOMER.columns[:2])
    target = KeyedTable.of(spark, run_folder(spark, "insert"), two)
    insert_select(spark, target, f"SELECT c_custkey, c_name, _op, _seq FROM {view}", "sql", 0)
    return target.read()


@registered
def sql_insert_repeat(spark, sf_dir):
    """Three inserts without a position, one after another; the last one stands."""
    two = TableSpec("customer", "ods_names", ("c_custkey",), derive.CUSTOMER.columns[:2])
    target = KeyedTable.of(spark, run_folder(spark, "insert-repeat"), two)
    for i in range(3):
        rows = derive.table(spark, sf_dir, "customer").withColumn("c_name", F.concat("c_name", F.lit(f"-{i}")))
        view = create_source_view(rows, f"customer_{i}")
        insert_select(spark, target, f"SELECT c_custkey, c_name FROM {view}", "sql", i)
        if i == 1:
            target.compact()
    return target.read()


OPEN_STATES = TableSpec("states", "ods_open", ("o_orderkey",), (ColumnSpec("o_orderkey", "bigint"), ColumnSpec("state")))
OPEN_SELECT = "SELECT o_orderkey, concat(o_orderstatus, ' ', o_orderpriority) AS state FROM cdc_states WHERE o_orderstatus = 'O'"


@registered
def sql_filter_change(spark, sf_dir):
    """A select with a condition that rows enter and leave; updates arrive before the creations, then the deletions."""
    log = derive.state_log(spark, sf_dir)
    target = KeyedTable.of(spark, run_folder(spark, "filter-change"), OPEN_STATES)
    for i, op in enumerate("ucd"):
        images = change_images(change_events.parse_envelope(log.where(F.col("op") == op)), derive.STATES)
        insert_changes(spark, target, OPEN_SELECT, images, "states", "sql", i)
    return target.read()


@registered
def sql_stream_insert(spark, sf_dir):
    """The same select over a stream of text files, half of them in each micro-batch."""
    root = run_folder(spark, "stream-insert")
    derive.state_log(spark, sf_dir).select("value").repartition(16).write.text(f"{root}/_input")
    events = change_events.read_change_events(spark, f"{root}/_input", streaming=True, max_files_per_batch=8)
    target = KeyedTable.of(spark, root, OPEN_STATES)
    options = SyncOptions(label="open", db="shop")
    insert_available(events, derive.STATES, target, OPEN_SELECT, f"{root}/_checkpoints/open", root, options)
    return target.read()


# -- masking -----------------------------------------------------------------


@registered
def registered_functions(spark, sf_dir):
    """A decoding and a mask of the user's own, through the images of events."""
    register_converter("shop.Cents", lambda value, zone: (value / 100).cast("decimal(15,2)"))
    register_masker("initial", lambda value, mode: F.concat(F.substring(value, 1, 1), F.lit("...")))
    o = derive.table(spark, sf_dir, "orders")
    image = F.struct("o_orderkey", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("price"), F.col("o_orderpriority").alias("contact"))
    src = derive.source("cents", F.lit("bin.000001"), F.col("o_orderkey"), F.lit(0), F.lit(0))
    log = o.select(derive.event(src, F.lit("c"), F.lit(None).cast("struct<x:int>"), image).alias("value"))
    columns = (ColumnSpec("o_orderkey", "bigint"), ColumnSpec("price", "decimal(15,2)", "shop.Cents", "bigint"), ColumnSpec("contact"))
    rules = MaskRules(("contact",), maskers={"contact": "initial"})
    rows = typed_rows(change_events.parse_envelope(log), TableSpec("cents", "ods_cents", ("o_orderkey",), columns), rules)
    return rows.select("o_orderkey", F.col("price").cast("string").alias("price"), "contact")


def _masked(spark, sf_dir, mode):
    people = derive.personal_data(derive.table(spark, sf_dir, "customer"))
    return people.select(
        "c_custkey", *[mask_pii(F.col(c), mode).alias(c) for c in ("mobile_number", "tele_no", "id_card")]
    )


@registered
def mask_batch_mode1(spark, sf_dir):
    return _masked(spark, sf_dir, ALL_KINDS)


@registered
def mask_batch_mode2(spark, sf_dir):
    return _masked(spark, sf_dir, ID_ONLY)


@registered
def mask_exempt_table(spark, sf_dir):
    """The same people in a table with ID-only masking and in one whose name only resembles it."""
    people = derive.personal_data(derive.table(spark, sf_dir, "customer"))
    parts = []
    for name in ("orders", derive.ID_ONLY_TABLE):
        masked = mask_columns(people, derive.personal_spec(name), derive.mask_rules())
        parts.append(masked.withColumn("tbl", F.lit(name)))
    return parts[0].unionByName(parts[1])


@registered
def masking_rules(spark, sf_dir):
    """Property lines, one comment, one blank and one setting per part."""
    key = F.col("p_partkey").cast("string")
    lines = F.array(
        F.concat(F.lit("#"), F.col("p_name"), F.lit("=x")),
        F.lit("  "),
        F.concat(F.lit(" list_"), key, F.lit(" = "), F.col("p_brand"), F.lit("="), F.col("p_type")),
    )
    text = derive.table(spark, sf_dir, "part").select("p_partkey", F.explode(lines).alias("value"))
    return settings.parse_properties(text, keep=["p_partkey"])


@registered
def sensitive_columns(spark, sf_dir):
    size = F.col("p_size").cast("string")
    names = F.array(
        F.concat(F.lit("MOBILE_"), size), F.concat(F.lit("idCardNo"), size), F.lit("id-card"), F.lit("contact_name"),
        F.lit("recall_flag"), F.lit("remark"), F.concat(F.lower("p_type"), F.lit("_telephone")), F.lower("p_brand"),
    )
    owner = F.when(F.col("p_size") > 25, F.lit(derive.ID_ONLY_TABLE)).otherwise(F.lit("orders"))
    columns = derive.table(spark, sf_dir, "part").select(
        "p_partkey", owner.alias("table_name"), F.posexplode(names).alias("idx", "column_name")
    )
    found = sensitive.sensitive_columns(columns.withColumn("idx", F.col("idx") + F.col("p_partkey") * 100), derive.mask_rules())
    return found


@registered
def mask_forms(spark, sf_dir):
    """Numbers with prefixes, blanks, line ends and near misses, in both modes."""
    p = derive.personal_data(derive.table(spark, sf_dir, "customer"))
    forms = F.array(
        F.concat(F.lit("+86"), "mobile_number"), F.concat(F.lit("86"), "mobile_number"),
        F.concat(F.substring("mobile_number", 1, 3), F.lit(" "), F.substring("mobile_number", 4, 4), F.lit("-"), F.substring("mobile_number", 8, 4)),
        F.substring("mobile_number", 1, 10), F.concat("mobile_number", F.lit("0")), F.concat(F.lit("x"), "mobile_number"),
        F.replace("tele_no", F.lit("-"), F.lit("")), F.concat(F.lit(" "), "tele_no", F.lit(" ")), F.replace("tele_no", F.lit("-"), F.lit(" ")),
        F.lower("id_card"), F.concat(F.lit(" "), "id_card"), F.substring("id_card", 1, 17), F.lit(""), F.lit(" "),
    )
    rows = p.select("c_custkey", F.posexplode(forms).alias("form", "number"))
    return rows.select(
        "c_custkey", "form", mask_pii(F.col("number"), ALL_KINDS).alias("all_kinds"), mask_pii(F.col("number"), ID_ONLY).alias("id_only")
    )


# -- back-fill ---------------------------------------------------------------


@registered
def backfill_filter_choice(spark, sf_dir):
    chosen = backfill.choose_filters(ddl.ddl_columns(derive.filter_definitions(spark, sf_dir)))
    return chosen.select(
        "table_name",
        "rule",
        F.coalesce(backfill.predicate_text(F.col("rule"), "2022-08-01 00:00:00"), F.lit("-")).alias("predicate"),
    )


@registered
def backfill_filter_by_text(spark, sf_dir):
    return backfill.choose_filters_by_text(derive.filter_definitions(spark, sf_dir))


@registered
def backfill_since(spark, sf_dir):
    o = derive.table(spark, sf_dir, "orders").withColumnRenamed("o_orderdate", "update_time")
    return backfill.rows_since(o, "update_time", SINCE).select("o_orderkey", "update_time", "o_orderstatus")


@registered
def backfill_or(spark, sf_dir):
    rows = derive.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").alias("occur_time"),
        (F.col("l_shipdate") + F.make_dt_interval(F.col("l_linenumber") * 30)).alias("in_bill_time"),
    )
    return backfill.rows_since(rows, "either", SINCE)


@registered
def backfill_full(spark, sf_dir):
    c = derive.table(spark, sf_dir, "customer")
    return backfill.rows_since(c, "full", SINCE).select("c_custkey", "c_name", "c_mktsegment")


@registered
def backfill_merge(spark, sf_dir):
    """A stream has filled the target; a back-fill since T brings a changed status of newer rows."""
    root = run_folder(spark, "backfill")
    specs = {"orders": derive.ORDERS}
    sync_batch(derive.shop_log(spark, sf_dir), 0, specs, root, SyncOptions(label="shop", db="shop"))
    # The source marks the last change in update_time, a copy of the order date.
    changed = derive.table(spark, sf_dir, "orders").withColumns(
        {"o_orderstatus": F.lower("o_orderstatus"), "update_time": F.col("o_orderdate")}
    )
    batch_sync(spark, specs, {"orders": "update_time"}, lambda name: changed, SINCE, root)
    target = KeyedTable.of(spark, root, derive.ORDERS).read()
    return target.select("o_orderkey", "o_orderstatus", "o_orderdate", F.col("o_totalprice").cast("string").alias("price"))


@registered
def backfill_repeat(spark, sf_dir):
    """Three full back-fills with changed values over a streamed target, a compaction between; the last one stands."""
    root, specs = run_folder(spark, "backfill-repeat"), {"orders": derive.ORDERS}
    sync_batch(derive.shop_log(spark, sf_dir), 0, specs, root, SyncOptions(label="shop", db="shop", on_unknown="ignore"))
    for i in range(3):
        changed = derive.table(spark, sf_dir, "orders").withColumn("o_orderstatus", F.concat("o_orderstatus", F.lit(f"{i}")))
        batch_sync(spark, specs, {"orders": "full"}, lambda name, rows=changed: rows, SINCE, root, batch_id=i)
        if i == 1:
            KeyedTable.of(spark, root, derive.ORDERS).compact()
    return _targets(spark, root, specs)


@registered
def backfill_resume(spark, sf_dir):
    """A back-fill in five key ranges that fails in its third and goes on there; which range was scanned how often."""
    root, specs, scanned = run_folder(spark, "backfill-resume"), {"orders": derive.ORDERS}, []
    sync_batch(derive.shop_log(spark, sf_dir), 0, specs, root, SyncOptions(label="shop", db="shop", on_unknown="ignore"))
    orders = derive.table(spark, sf_dir, "orders").withColumn("o_orderstatus", F.lower("o_orderstatus"))

    def scan(name, part):
        scanned.append(part)
        if scanned.count(part) == 1 and part.endswith("= 2"):
            raise OSError("the source has gone away")
        return orders.where(part)

    for turn in range(2):
        batch_sync(
            spark, specs, {"orders": "full"}, scan, SINCE, root, batch_id=7, on_error="continue",
            ranges=lambda name: [f"pmod(o_orderkey, 5) = {i}" for i in range(5)],
        )
        if turn == 0:
            KeyedTable.of(spark, root, derive.ORDERS).compact()
    told = [("scans of range", int(p[-1]), str(scanned.count(p))) for p in sorted(set(scanned))]
    audit = read_audit(spark, root).where("job = 'backfill'").select(
        F.lit("audit").alias("tbl"), F.col("upserts").alias("pk"), F.col("status").alias("detail")
    )
    found = _targets(spark, root, specs).unionByName(spark.createDataFrame(told, "tbl string, pk bigint, detail string"))
    return found.unionByName(audit)


@registered
def jdbc_ranges(spark, sf_dir):
    """Split points of a key of two columns by the SQL that a database gets, and the rows of each range."""
    derive.table(spark, sf_dir, "lineitem").createOrReplaceTempView("lineitem_keys")
    names, parts = ["l_orderkey", "l_linenumber"], 7
    rows = spark.table("lineitem_keys").count()
    found = jdbc.split_rows(lambda q: spark.sql(q).collect(), "lineitem_keys", names, rows, parts, "l_returnflag <> 'X'")
    ranges = jdbc.range_predicates(names, jdbc.split_points(found, parts))
    cases = [F.when(F.expr(p), i) for i, p in enumerate(ranges)]
    return spark.table("lineitem_keys").select(
        *names, F.coalesce(*cases).alias("part"), F.size(F.array_compact(F.array(*cases))).alias("parts")
    )


@registered
def url_time_zone(spark, sf_dir):
    """URLs of every supplier's database, with and without options and zones."""
    key = F.col("s_suppkey")
    zone = F.when(key % 4 == 0, "serverTimezone=Asia/Shanghai").when(key % 4 == 1, "serverTimezone=UTC")
    url = F.concat(F.lit("jdbc:mysql://h"), key.cast("string"), F.lit("/shop"), F.coalesce(F.concat(F.lit("?"), zone), F.lit("")))
    return derive.table(spark, sf_dir, "supplier").select("s_suppkey", jdbc.stated_time_zone(url).alias("url"))


@registered
def backfill_audit(spark, sf_dir):
    """All tables of a job, one of which fails and does not stop the others."""
    specs = {t: SHOP[t] for t in ("orders", "customer", "supplier")}
    filters = {"orders": "full", "customer": "unregistered", "supplier": "full"}
    root = run_folder(spark, "backfill-audit")
    audit = batch_sync(
        spark, specs, filters, lambda name: derive.table(spark, sf_dir, name), SINCE, root, batch_id=1, on_error="continue", parallel_tables=2
    )
    return audit.select(F.col("table").alias("tbl"), "target", "status", "upserts", F.coalesce("error", F.lit("-")).alias("error"))


# -- catalog -----------------------------------------------------------------


@registered
def existing_targets(spark, sf_dir):
    """The targets that a job finds and those it creates: nations' tables, those of one region made before."""
    root = run_folder(spark, "existing")
    rows = derive.table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey").collect()
    specs = {f"n{r[0]}": TableSpec(f"n{r[0]}", f"ods_n{r[0]}", ("id",), (ColumnSpec("id", "int"),)) for r in rows}
    first = {f"n{r[0]}": specs[f"n{r[0]}"] for r in rows if r[1] == 0}
    job.create_missing_targets(spark, first, root)
    before = job.existing_targets(spark, root).withColumn("found", F.lit("before"))
    created = [(t, "created") for t in job.create_missing_targets(spark, specs, root)]
    now = job.existing_targets(spark, root).withColumn("found", F.lit("after"))
    return before.union(now).select("target", "found").union(spark.createDataFrame(created, "target string, found string"))


@registered
def ddl_columns(spark, sf_dir):
    c = ddl.ddl_columns(derive.part_definitions(spark, sf_dir))
    return c.select("table_name", "idx", "column_name", "mysql_type", "unsigned", "comment")


@registered
def ddl_type_map(spark, sf_dir):
    c = ddl.ddl_columns(derive.part_definitions(spark, sf_dir))
    return c.select("table_name", "idx", "stream_type", "target_type", "spark_type", "logical_type", "wire_type")


@registered
def ddl_primary_keys(spark, sf_dir):
    k = ddl.ddl_primary_keys(derive.part_definitions(spark, sf_dir))
    return k.select("table_name", F.array_join("keys", ",").alias("keys"), "table_comment")


@registered
def ddl_errors(spark, sf_dir):
    return ddl.tables_without_key(derive.part_definitions(spark, sf_dir))


@registered
def target_ddl(spark, sf_dir):
    return ddl.target_ddl(derive.part_definitions(spark, sf_dir), buckets=16)


@registered
def ddl_specs(spark, sf_dir):
    """The specs of one database's tables, of which another database has other versions."""
    own = derive.part_definitions(spark, sf_dir).withColumn("db_name", F.lit("shop"))
    other = own.withColumns({"ddl": F.replace("ddl", F.lit("`note`"), F.lit("`other`")), "db_name": F.lit("other")})
    return ddl.spec_rows(own.unionByName(other), "shop").select(
        "table_name", "idx", "column_name", "spark_type", "logical_type", "wire_type", "key_position"
    )


@registered
def catalog_lookup(spark, sf_dir):
    """Every part is a wanted table; import entries and connections are partly missing or misleading."""
    p = derive.table(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string")
    name = F.concat(F.lit("part_"), key)
    wanted = p.select(F.lit("shop").alias("db_name"), name.alias("table_name"))

    def entries(step: int, db: str, hive, connection):
        return p.select(
            (F.col("p_partkey") * 3 + step).alias("id"), connection.alias("connection_id"), F.lit(db).alias("db_name"),
            name.alias("table_name"), hive.alias("hive_table"), F.col("p_size"),
        )

    good = F.concat(F.lit("s"), (F.col("p_partkey") * 7 % 1300).cast("string"))
    imports = (
        entries(2, "shop", F.concat(F.lit("src_shop_"), name), good)
        .where(F.col("p_size") < 45)
        .union(entries(1, "other", F.concat(F.lit("src_other_"), name), F.lit("s0")))
        .union(entries(0, "shop", F.concat(F.lit("src_shop_partx"), key), F.lit("s1")))
        .union(entries(3_000_000_000, "shop", F.concat(F.lit("src_late_"), name), F.lit("s2")).where(F.col("p_size") < 20))
    )
    connections = derive.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("connection_id"),
        F.concat(F.lit("db-"), F.col("s_nationkey").cast("string")).alias("hostname"),
        (F.col("s_nationkey") + 3306).alias("port"),
        F.when(F.col("s_nationkey") > 10, F.lit("useSSL=false")).alias("jdbc_extend"),
    )
    found = catalog.catalog_lookup(wanted, imports, connections)
    return found.select(
        "table_name", "db_name", *[F.coalesce(c, F.lit("-")).alias(c) for c in ("connection_id", "target", "url")], "status"
    )


@registered
def job_table_list(spark, sf_dir):
    """One job per customer; its tables are listed in one text field."""
    key = F.col("c_custkey").cast("string")
    jobs = derive.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("db_"), key).alias("mysqlDb"),
        F.concat_ws(
            ",", F.lower("c_mktsegment"), F.concat(F.lit("orders_"), "c_nationkey"), F.concat(F.lit(" t"), key), F.lit("")
        ).alias("tableList"),
    )
    return settings.job_tables(jobs)


@registered
def missing_targets(spark, sf_dir):
    """Targets wanted for every customer and part; those of customers with orders exist."""
    def targets(table, key):
        name = F.concat(F.lit("ods_"), F.col(key).cast("string"))
        return derive.table(spark, sf_dir, table).select(F.lit("ods").alias("db"), name.alias("target"))

    wanted = targets("customer", "c_custkey").union(targets("part", "p_partkey"))
    return catalog.missing_targets(wanted, targets("orders", "o_custkey"))


# -- Kafka and line JSON -----------------------------------------------------


def _records(spark, sf_dir):
    e = derive.table(spark, sf_dir, "events")
    kind = F.col("event_type")
    key = F.when(kind == "view", F.lit("no json")).otherwise(F.format_string('{"user_id": %d}', "user_id"))
    value = F.when(kind != "error", F.format_string('{"event_type": "%s", "props": %s}', kind, F.col("props")))
    return e.select(
        key.cast("binary").alias("key"), value.cast("binary").alias("value"), F.lit("ods_users").alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"), F.col("event_id").alias("offset"),
    )


@registered
def upsert_kafka_latest(spark, sf_dir):
    last = kafka.latest_records(
        _records(spark, sf_dir), "user_id bigint", "event_type string, props struct<k: bigint>"
    )
    return last.select("user_id", "event_type", F.col("props.k").alias("k"))


@registered
def kafka_payload_decode(spark, sf_dir):
    rows = kafka.decode_values(
        _records(spark, sf_dir).where(F.col("value").isNotNull()), "event_type string, props struct<k: bigint>"
    )
    return rows.select("topic", F.col("partition").alias("part"), F.col("offset").alias("pos"), "event_type", F.col("props.k").alias("k"))


@registered
def to_kafka_records(spark, sf_dir):
    return kafka.to_records(derive.table(spark, sf_dir, "customer"), ["c_custkey"], "ods_customer")


@registered
def cdc_topic_records(spark, sf_dir):
    """The last change of every key as records of one topic per table, deletes as null values."""
    options = SyncOptions(db="shop")
    return topic_records(stage(_whole_log(spark, sf_dir), SHOP, options), SHOP, options)


@registered
def topic_round_trip(spark, sf_dir):
    """The records of all topics, read again as upsert topics: the rows of the keyed targets."""
    records = cdc_topic_records(spark, sf_dir).withColumns({"partition": F.lit(0), "offset": F.lit(0).cast("bigint")})
    return _from_records(records)


def _from_records(records):
    """The rows of the shop's tables from the records of their upsert topics."""
    parts = []
    for spec in SHOP.values():
        fields = {c.name: f"`{c.name}` {c.target}" for c in spec.columns}
        mine = records.where(F.col("topic") == spec.target)
        rows = kafka.latest_records(mine, ", ".join(fields[k] for k in spec.keys), ", ".join(fields.values()))
        parts.append(_as_text(rows, spec))
    return reduce(DataFrame.unionByName, parts)


@registered
def topic_replay(spark, sf_dir):
    """Batches that are published one and a half times, in any order, and one without its fence: the keyed targets' rows."""
    late = derive.user_log(spark, sf_dir, TAKEOVER)
    logs = [late.where("server = 1").select("value").union(derive.shop_log(spark, sf_dir)), late.where("server = 2").select("value")]
    options = SyncOptions(db="shop")
    root, batches = run_folder(spark, "topic-replay"), []
    for i, log in enumerate(logs):
        topics.outbox_records(topic_records(stage(log, SHOP, options), SHOP, options), "shop", i).write.parquet(f"{root}/{i}")
        batches.append(spark.read.parquet(f"{root}/{i}"))
    half = F.crc32(F.col("key").cast("binary")) % 2 == 0
    unfinished = topics.outbox_records(batches[0], "shop", 2)
    published = [batches[1].where(half), batches[0], batches[1], batches[0].where(half), batches[1].where(~half)]
    published.append(unfinished.withColumn("value", F.lit(None).cast("string")))
    log = reduce(
        DataFrame.unionByName,
        [b.withColumn("offset", F.lit(i << 40) + F.monotonically_increasing_id()) for i, b in enumerate(published)],
    )
    fences = [topics.fence_records(spark, "shop", i, b.count(), "shop.fences") for i, b in enumerate(batches)]
    records = topics.finished_records(log, reduce(DataFrame.unionByName, fences))
    return _from_records(records)


@registered
def upsert_stream(spark, sf_dir):
    """An upsert topic as a stream over three partitions, whose later half comes first; null values delete."""
    root = run_folder(spark, "upsert-stream")
    columns = (ColumnSpec("user_id", "bigint"), ColumnSpec("event_type"), ColumnSpec("props", "string"))
    spec = TableSpec("users", "ods_topic_users", ("user_id",), columns)
    records = _records(spark, sf_dir)
    schema = records.schema
    middle = derive.table(spark, sf_dir, "events").count() // 2
    for half in (F.col("offset") >= middle, F.col("offset") < middle):
        records.where(half).repartition(4).write.mode("append").parquet(f"{root}/_records")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).parquet(f"{root}/_records")
    topics.upsert_stream(stream, spec, root, f"{root}/_checkpoints/users", trigger={"availableNow": True}).awaitTermination()
    rows = topics.upsert_target(spark, root, spec).read()
    return rows.select("user_id", "event_type", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


@registered
def to_ndjson(spark, sf_dir):
    priority = F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority"))
    return ndjson.to_lines(derive.table(spark, sf_dir, "orders").withColumn("priority", priority))


@registered
def ndjson_explode(spark, sf_dir):
    c = derive.table(spark, sf_dir, "customer")
    line = '{"id": "%d","name": "%s", "age": "%d"}'
    block = F.format_string(
        f"{line}\n\n{line}\n", "c_custkey", "c_name", "c_nationkey", F.col("c_custkey") + 1, "c_mktsegment", F.col("c_nationkey") + 1
    )
    return ndjson.explode_lines(c.select(block.alias("value")), "value", "id string, name string, age string")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User log with an invented phone number, masked and applied to a keyed target."""
    spec = TableSpec(
        "users", "ods_shop_users", ("user_id",), (*derive.USERS.columns, ColumnSpec("mobile_number")), "users of the shop"
    )
    e = change_events.parse_envelope(derive.user_log(spark, sf_dir))
    user = F.get_json_object("after", "$.user_id").cast("bigint")
    phone = F.concat(F.lit("138"), F.lpad(user.cast("string"), 8, "0"))
    with_phone = F.concat(F.expr("left(after, length(after) - 1)"), F.lit(',"mobile_number":"'), phone, F.lit('"}'))
    e = e.withColumn("after", F.when(F.col("after") != "{}", with_phone).otherwise(F.col("after")))
    target = KeyedTable.of(spark, run_folder(spark, "flagship"), spec)
    target.apply(typed_rows(e, spec, derive.mask_rules()).drop("_bad"), "log", 0)
    return target.read()
