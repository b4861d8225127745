"""Scalar helpers: built-in Spark expressions only, no Python UDFs."""

from tidemark.functions.text import blank_to_null, clean_name, is_trimmed, py_strip
from tidemark.functions.values import (
    as_double_or_zero,
    clamp,
    exact_sum,
    field,
    field_type,
    is_numeric,
    py_text,
    python_type_name,
    quoted,
    truthy,
)

__all__ = [
    "as_double_or_zero", "blank_to_null", "clamp", "exact_sum", "clean_name", "field", "field_type",
    "is_numeric", "is_trimmed", "py_strip", "py_text", "python_type_name", "quoted", "truthy",
]
