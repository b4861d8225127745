"""String helpers that reproduce the source system's text rules with built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the white space set removed by the source's trim.  It is the
# Unicode white space class plus the four ASCII separators 0x1C-0x1F, which the
# source's trim also removes.  ``(?U)`` turns on Unicode classes in Java regex.
STRIP_PATTERN = r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z"

# Fixed value: characters kept when a name is cleaned for a version id.
VERSION_NAME_DROP = r"[^a-zA-Z0-9_-]"


def py_strip(col: Column) -> Column:
    """Trim Unicode white space on both ends (Spark's ``trim`` only drops U+0020)."""
    return F.regexp_replace(col, STRIP_PATTERN, "")


def blank_to_null(col: Column) -> Column:
    """Trim, then turn the empty string into NULL."""
    return F.nullif(py_strip(col), F.lit(""))


def is_trimmed(col: Column) -> Column:
    """True when trimming changes the value (NULL-safe, NULL counts as False)."""
    return F.coalesce(py_strip(col) != col, F.lit(False))


def clean_name(col: Column) -> Column:
    """Keep only ``[a-zA-Z0-9_-]``."""
    return F.regexp_replace(col, VERSION_NAME_DROP, "")
