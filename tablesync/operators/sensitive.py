"""Which columns hold personal data, by their names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.functions.keywords import has_keyword, matched_keywords
from tablesync.functions.masking import ALL_KINDS, ID_ONLY, MASKERS
from tablesync.spec import NO_MASKING, MaskRules, TableSpec


def sensitive_columns(columns: DataFrame, rules: MaskRules) -> DataFrame:
    """Columns (``table_name, idx, column_name``) to mask, the keywords found and the mode."""
    keywords = rules.keywords
    exempt = F.col("table_name").isin(*rules.id_only_tables)
    return columns.where(has_keyword(F.col("column_name"), keywords)).select(
        "table_name",
        "idx",
        "column_name",
        matched_keywords(F.col("column_name"), keywords).alias("keywords"),
        F.when(exempt, ID_ONLY).otherwise(ALL_KINDS).alias("mode"),
    )


def mask_columns(rows: DataFrame, spec: TableSpec, rules: MaskRules = NO_MASKING) -> DataFrame:
    """Mask the text columns whose names match; key columns stay as they are unless told otherwise.

    Decimals travel as text, so personal numbers may be stored in them: see ``MaskRules.numbers``.
    """
    mode = rules.mode_for(spec.table)
    types = dict(rows.dtypes)
    masked = {}
    for c in spec.columns:
        if c.name in spec.keys and not rules.mask_keys:
            continue
        if types.get(c.name, "").startswith("decimal") and c.name not in spec.keys and rules.matches(c.name):
            if rules.numbers == "refuse":
                raise ValueError(f"column {c.name} of {spec.table} is a number and cannot be masked")
            if rules.numbers == "null":
                masked[c.name] = F.lit(None).cast(types[c.name])
        elif types.get(c.name) == "string" and (c.name in rules.maskers or rules.matches(c.name)):
            masked[c.name] = MASKERS[rules.maskers.get(c.name, "pii")](F.col(f"`{c.name}`"), mode)
    return rows.withColumns(masked) if masked else rows
