"""What a sync job knows about a table. Built from the catalog, never from data."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

DEFAULT_TIME_ZONE = "Asia/Shanghai"


@dataclass(frozen=True)
class ColumnSpec:
    """One source column.

    ``logical`` names the wire encoding (see ``functions.temporal.CONVERTERS``),
    ``wire`` the JSON type to read, ``target`` the Spark type to store.
    """

    name: str
    target: str = "string"
    logical: str = "raw"
    wire: str | None = None
    comment: str = ""

    @property
    def wire_type(self) -> str:
        return self.wire or self.target


@dataclass(frozen=True)
class TableSpec:
    table: str
    target: str
    keys: tuple[str, ...]
    columns: tuple[ColumnSpec, ...]
    comment: str = ""

    def __post_init__(self):
        if not self.keys:
            raise ValueError(f"table {self.table} has no primary key")
        missing = set(self.keys) - {c.name for c in self.columns}
        if missing:
            raise ValueError(f"table {self.table} has no column for keys {sorted(missing)}")

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    def target_schema(self) -> T.StructType:
        fields = []
        for c in self.columns:
            meta = {"comment": c.comment} if c.comment else {}
            fields.append(T.StructField(c.name, T.DataType.fromDDL(c.target), c.name not in self.keys, meta))
        return T.StructType(fields)

    def with_target(self, target: str) -> TableSpec:
        return replace(self, target=target)


@dataclass(frozen=True)
class MaskRules:
    """Column-name keywords that mark personal data, and tables with ID-only masking.

    A matching decimal column cannot hold a masked number: ``numbers`` is ``null`` (stored
    as NULL), ``keep`` or ``refuse``.
    """

    keywords: tuple[str, ...] = ()
    id_only_tables: tuple[str, ...] = ()
    mask_keys: bool = False
    numbers: str = "null"
    maskers: dict[str, str] = field(default_factory=dict)

    def mode_for(self, table: str) -> int:
        return 2 if table in self.id_only_tables else 1

    def matches(self, column: str) -> bool:
        name = column.lower()
        return any(k and k.lower() in name for k in self.keywords)


NO_MASKING = MaskRules()
