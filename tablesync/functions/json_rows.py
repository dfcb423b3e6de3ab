"""JSON text as columns, parsed once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Writes times with all their digits; Spark's own forms stop at milliseconds.
JSON_FORMATS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def with_fields(rows: DataFrame, keep: list, text: Column, schema: str, corrupt: str | None = None) -> DataFrame:
    """The columns ``keep`` and the fields of ``text``; ``corrupt`` names a field for unreadable text.

    The parsed object goes through ``inline``, because the optimizer would copy a
    plain ``from_json`` into every filter on one of its fields and parse again there.
    """
    options = {}
    if corrupt:
        schema = f"{schema}, `{corrupt}` string"
        options["columnNameOfCorruptRecord"] = corrupt
    return rows.select(*keep, F.inline_outer(F.array(F.from_json(text, schema, options))))
