"""Bounded scans over JDBC with pushed-down filters and parallel partitions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings of the China zone a source URL may already carry, and the one added (fixed values).
CHINA_ZONE_PARAMS = ("serverTimezone=Hongkong", "serverTimezone=Asia/Shanghai", "serverTimezone=GMT%2B8")
DEFAULT_ZONE_PARAM = "serverTimezone=GMT%2B8"


def with_server_time_zone(url: str, param: str = DEFAULT_ZONE_PARAM) -> str:
    """Make a MySQL URL state its server's time zone, unless it names the China zone already."""
    if any(spelling in url for spelling in CHINA_ZONE_PARAMS):
        return url
    return f"{url}{'&' if '?' in url else '?'}{param}"


def stated_time_zone(url: Column, param: str = DEFAULT_ZONE_PARAM) -> Column:
    """``with_server_time_zone`` for a column of URLs."""
    named = F.lit(False)
    for spelling in CHINA_ZONE_PARAMS:
        named |= url.contains(spelling)
    joint = F.when(url.contains("?"), "&").otherwise("?")
    return F.when(named, url).otherwise(F.concat(url, joint, F.lit(param)))


def mysql_url(host: str, port: int, database: str, extend: str | None = None) -> str:
    url = f"jdbc:mysql://{host}:{port}/{database}"
    return f"{url}?{extend}" if extend else url


def quoted(spark: SparkSession, url: str, column: str) -> str:
    """A column's name as the SQL of the database at ``url`` quotes it."""
    return spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(column)


def key_hash(keys: list[str]) -> str:
    """A whole number for each key in the source's SQL, for keys of any type and number (MySQL's functions)."""
    return f"crc32(concat_ws('|', {', '.join(keys)}))"


# How a database draws a share of a table's rows, by the name in its URL (fixed values), and the rows it is not asked for.
DRAWS = {"mysql": "rand() < {}", "mariadb": "rand() < {}", "postgresql": "random() < {}"}
DRAW_ABOVE = 10_000_000
# Rows that Spark numbers in one task, and keys drawn for each such run. Effort only.
RUN_ROWS = 4_000_000
DRAWN_A_RUN = 1000


def split_query(
    table: str,
    names: Sequence[str],
    step: int,
    condition: str | None = None,
    points: Sequence[Sequence[str]] = (),
    before: Sequence[int] = (),
) -> str:
    """SQL for every ``step``-th key in the database's own order: a few rows, read from the key's index.

    ``_place`` tells their order, whatever the collation. With ``points``, keys as literals in ascending order, the rows between
    two of them are numbered by themselves and the rows ``before`` each such run are added (see ``split_rows``); the same keys
    come out, and an engine without an index can number the runs side by side.
    """
    listed, among = ", ".join(names), f" where {condition}" if condition else ""
    if not points:
        keys = f"select {listed}, row_number() over (order by {listed}) as _place from {table}{among}"
        return f"select {listed}, _place from ({keys}) numbered where mod(_place, {step}) = 0"
    rows = f"select {listed}, {run_number(names, points)} as _run from {table}{among}"
    keys = f"select {listed}, _run, row_number() over (partition by _run order by {listed}) as _own from ({rows}) dealt"
    places = " ".join(f"when {i} then {n}" for i, n in enumerate(before))
    keys = f"select {listed}, _own + case _run {places} end as _place from ({keys}) counted"
    return f"select {listed}, _place from ({keys}) numbered where mod(_place, {step}) = 0"


def run_number(names: Sequence[str], points: Sequence[Sequence[str]]) -> str:
    """SQL for the number of points below a key, where NULLs come first, as Spark and MySQL order them."""

    def upto(names: Sequence[str], point: Sequence[str]) -> str:
        if len(names) == 1:
            return f"({names[0]} is null or {names[0]} <= {point[0]})"
        return f"({names[0]} is null or {names[0]} < {point[0]} or ({names[0]} = {point[0]} and {upto(names[1:], point[1:])}))"

    cases = " ".join(f"when {upto(names, point)} then {i}" for i, point in enumerate(points))
    return f"case {cases} else {len(points)} end"


def split_rows(
    ask: Callable[[str], list], table: str, names: Sequence[str], rows: int, parts: int, condition: str | None = None,
    run_rows: int = RUN_ROWS, draw: str = "rand() < {}",
) -> list:
    """The rows of ``split_query`` for ``rows`` rows in ``parts`` parts, by queries of which none orders many rows in one task.

    ``ask`` runs a query. Keys drawn at random bound runs of about ``run_rows`` rows; each run is counted, then numbered. Every row
    has its exact place, whatever was drawn. For tables that Spark holds: a database reads its index in order.
    """
    step, points, before = -(-rows // parts), [], []
    if rows > run_rows:
        runs = -(-rows // run_rows)
        drawn = min(DRAWN_A_RUN, -(-rows // runs))
        share = min(1.0, DRAWN_A_RUN * runs / rows)
        among = " and ".join([*([f"({condition})"] if condition else []), draw.format(f"{share:.12f}")])
        points = split_points(ask(split_query(table, names, drawn, among)), runs, backslashes=True)
        points = [p for i, p in enumerate(points) if p not in points[:i]]
    if points:
        among = f" where {condition}" if condition else ""
        dealt = f"select {run_number(names, points)} as _run from {table}{among}"
        counts = {r[0]: r[1] for r in ask(f"select _run, count(*) as n from ({dealt}) dealt group by _run")}
        before = [sum(counts.get(j, 0) for j in range(i)) for i in range(len(points) + 1)]
    return ask(split_query(table, names, step, condition, points, before))


def literal(value, backslashes: bool = False) -> str:
    """A key's value in SQL; ``backslashes`` for databases where they escape, as in MySQL."""
    if isinstance(value, datetime):
        return f"{{ts '{value.isoformat(' ')}'}}"
    if isinstance(value, date):
        return f"{{d '{value.isoformat()}'}}"
    if isinstance(value, (bytes, bytearray)):
        return f"x'{value.hex()}'"
    if isinstance(value, str):
        value = value.replace("\\", "\\\\") if backslashes else value
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def split_points(found: Sequence, parts: int, backslashes: bool = False) -> list[list[str]]:
    """The rows of ``split_query`` as ascending keys of literals; a key with a NULL splits nothing."""
    keys = [[*r][:-1] for r in sorted(found, key=lambda r: r[-1])[: parts - 1]]
    return [[literal(v, backslashes) for v in key] for key in keys if None not in key]


def range_predicates(names: Sequence[str], points: Sequence[Sequence[str]]) -> list[str]:
    """Conditions that split all rows at the ``points``, keys as literals in ascending order; NULLs go to the first.

    Keys of several columns are compared column by column, with a bound on the first one for the index.
    """

    def above(point: Sequence[str]) -> str:
        cases = []
        for i, name in enumerate(names):
            same = "".join(f"{n} = {v} and " for n, v in zip(names[:i], point[:i], strict=True))
            cases.append(f"({same}{name} > {point[i]})")
        return f"{names[0]} >= {point[0]} and ({' or '.join(cases)})"

    def upto(point: Sequence[str]) -> str:
        cases = []
        for i, name in enumerate(names):
            same = "".join(f"{n} = {v} and " for n, v in zip(names[:i], point[:i], strict=True))
            cases.append(f"({same}{name} {'<=' if i == len(names) - 1 else '<'} {point[i]})")
        return f"{names[0]} <= {point[0]} and ({' or '.join(cases)})"

    if not points:
        return ["1 = 1"]
    nulls = " or ".join(f"{n} is null" for n in names)
    middle = [f"{above(a)} and {upto(b)}" for a, b in zip(points, points[1:], strict=False)]
    return [f"({upto(points[0])}) or {nulls}", *middle, above(points[-1])]


def key_ranges(
    spark: SparkSession, url: str, table: str, keys: Sequence[str], parts: int, condition: str | None = None, **options: str
) -> list[str]:
    """Conditions that split the rows that meet ``condition`` into ``parts`` of equal number, by quantiles of the key.

    The database sends the split points alone. Of a large table it draws a share of the keys, if it can, so the parts
    are equal up to a few per cent. It needs window functions (MySQL from 8.0 on); ``key_hash`` does without.
    """
    reader = spark.read.format("jdbc").options(url=url, **options)
    names = [quoted(spark, url, k) for k in keys]
    among = f" where {condition}" if condition else ""
    rows = reader.option("query", f"select count(*) as n from {table}{among}").load().first()[0]
    draw = DRAWS.get(url.split(":")[1]) if rows > DRAW_ABOVE else None
    if draw:
        share = DRAW_ABOVE / rows
        condition = " and ".join([*([f"({condition})"] if condition else []), draw.format(f"{share:.9f}")])
        rows = DRAW_ABOVE
    if parts < 2 or rows < parts:
        return range_predicates(names, [])
    found = reader.option("query", split_query(table, names, -(-rows // parts), condition)).load().collect()
    return range_predicates(names, split_points(found, parts, url.split(":")[1] in ("mysql", "mariadb")))


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    where: Column | None = None,
    partition_column: str | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    split_by: str | None = None,
    condition: str | None = None,
    split_keys: Sequence[str] | None = None,
    **options: str,
) -> DataFrame:
    """Scan ``table``; ``where`` is pushed to the database by Spark.

    With a numeric, date or timestamp ``partition_column`` the scan is split into
    ``partitions`` ranges between its smallest and largest value among the rows that meet
    ``condition``, SQL for the database, which is asked for them in one row. With ``split_keys``, the columns
    of an index, it is split into ranges of equally many rows (see ``key_ranges``), with ``split_by``, a whole
    number in the database's SQL (see ``key_hash``), by the rest of that number.
    """
    base = {"url": url, "fetchsize": str(fetch_size), "preferTimestampNTZ": "true", **options}
    reader = spark.read.format("jdbc").options(**base)
    if (split_by or split_keys) and partitions > 1:
        if split_keys:
            parts = key_ranges(spark, table=table, keys=split_keys, parts=partitions, condition=condition, **base)
        else:
            parts = [f"mod({split_by}, {partitions}) = {i}" for i in range(partitions)]
            parts[0] += f" or {split_by} is null"
        if condition:
            parts = [f"({p}) and ({condition})" for p in parts]
        properties = {k: v for k, v in base.items() if k != "url"}
        rows = spark.read.jdbc(url, table, predicates=parts, properties=properties)
        return rows if where is None else rows.where(where)
    if partition_column and partitions > 1:
        among = f" where {condition}" if condition else ""
        name = quoted(spark, url, partition_column)
        query = f"select min({name}) lo, max({name}) hi from {table}{among}"
        low, high = reader.option("query", query).load().first()
        if low is not None and low != high:
            reader = (
                spark.read.format("jdbc")
                .options(**base)
                .option("partitionColumn", partition_column)
                .option("lowerBound", str(low))
                .option("upperBound", str(high))
                .option("numPartitions", partitions)
            )
        else:
            reader = spark.read.format("jdbc").options(**base)
    rows = reader.option("dbtable", table).load()
    return rows if where is None else rows.where(where)
