"""Masking of resident IDs, mobile and landline numbers, as built-in expressions.

The patterns decide on the whole value, so they are anchored with ``\\A`` and
``\\z`` (a plain ``$`` would also accept a trailing newline). A value that
matches nothing is returned untouched, blanks included.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as an ID, a mobile number and a landline number.
ID_PATTERN = (
    r"\A[1-9]\d{5}(18|19|20|(3\d))\d{2}((0[1-9])|(1[0-2]))"
    r"(([0-2][1-9])|10|20|30|31)\d{3}[0-9Xx]\z"
)
MOBILE_PATTERN = r"\A((\+86)|(86))?[1][3456789][0-9]{9}\z"
# Control characters and the blank may stand at both ends of a landline number; they are cut off.
LANDLINE_PATTERN = r"\A[\x00-\x20]*(?:0\d{2,3}[-]?\d{7,8}|0\d{2,3}\s?\d{7,8})[\x00-\x20]*\z"
EDGE_BLANKS = r"\A[\x00-\x20]+|[\x00-\x20]+\z"

# Lengths without blanks and dashes, tested before the patterns because that is cheaper.
ID_LENGTH = 18
MOBILE_LENGTHS = (11, 14)

ALL_KINDS = 1
ID_ONLY = 2


def compact(col: Column) -> Column:
    """Without blanks and dashes."""
    return F.translate(col, " -", "")


def mask_resident_id(col: Column) -> Column:
    """The first twelve digits of a value that is an ID."""
    return F.concat(F.substring(compact(col), 1, 12), F.lit("******"))


def mask_mobile(col: Column) -> Column:
    """First three and last four digits of a value that is a mobile number, without country code."""
    text = compact(col)
    return F.concat(F.substring(text, -11, 3), F.lit("****"), F.substring(text, -4, 4))


def mask_landline(col: Column) -> Column:
    """A landline number with every occurrence of its sixth to eighth character hidden."""
    text = F.regexp_replace(col, EDGE_BLANKS, "")
    return F.replace(text, F.substring(text, 6, 3), F.lit("****"))


def is_resident_id(col: Column) -> Column:
    text = compact(col)
    return (F.length(text) == ID_LENGTH) & text.rlike(ID_PATTERN)


def is_mobile(col: Column) -> Column:
    text = compact(col)
    return F.length(text).between(*MOBILE_LENGTHS) & text.rlike(MOBILE_PATTERN)


def is_landline(col: Column) -> Column:
    return col.rlike(LANDLINE_PATTERN)


def mask_pii(col: Column, mode: int = ALL_KINDS) -> Column:
    """Mode 1 masks IDs, mobile and landline numbers; mode 2 only IDs."""
    if mode not in (ALL_KINDS, ID_ONLY):
        raise ValueError(f"mask mode must be 1 or 2, not {mode}")
    masked = F.when(is_resident_id(col), mask_resident_id(col))
    if mode == ALL_KINDS:
        masked = masked.when(is_mobile(col), mask_mobile(col)).when(is_landline(col), mask_landline(col))
    return masked.otherwise(col)


Masker = Callable[[Column, int], Column]

MASKERS: dict[str, Masker] = {"pii": mask_pii}


def register_masker(name: str, masker: Masker) -> None:
    """Add a masking function that ``MaskRules.maskers`` can name for a column."""
    MASKERS[name] = masker
