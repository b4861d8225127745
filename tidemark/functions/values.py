"""Typed value helpers: schema-aware column lookup, truthiness, text rendering.

The source system works on loosely typed records where ``""``, ``0``, ``False``
and empty lists count as *missing* in its ``a or b`` chains.  These helpers turn
those rules into plain Catalyst expressions over typed columns, so every
mapping stays inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import blank_to_null

NUMERIC_TYPES = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType,
    T.FloatType, T.DoubleType, T.DecimalType,
)
INTEGRAL_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def field_type(schema: T.StructType, path: str) -> T.DataType | None:
    """Type of a (possibly nested, dot separated) field, or None when absent."""
    current: T.DataType = schema
    for part in path.split("."):
        if not isinstance(current, T.StructType) or part not in current.fieldNames():
            return None
        current = current[part].dataType
    return current


def field(df: DataFrame, path: str) -> tuple[Column, T.DataType]:
    """Column and type for ``path``; a missing field is a typed NULL literal.

    This is the declared-schema form of "missing key reads as None".
    """
    dtype = field_type(df.schema, path)
    if dtype is None:
        return F.lit(None).cast(T.StringType()), T.NullType()
    col = quoted(path.split(".")[0])
    for part in path.split(".")[1:]:
        col = col.getField(part)
    return col, dtype


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, NUMERIC_TYPES)


def truthy(col: Column, dtype: T.DataType) -> Column:
    """Truthiness of a value the way the source's ``x or y`` sees it."""
    if isinstance(dtype, T.NullType):
        return F.lit(False)
    if isinstance(dtype, T.StringType):
        return F.coalesce(col != F.lit(""), F.lit(False))
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(col, F.lit(False))
    if is_numeric(dtype):
        return F.coalesce(col != F.lit(0), F.lit(False))
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return F.coalesce(F.size(col) > 0, F.lit(False))
    return col.isNotNull()


def quoted(name: str) -> Column:
    """The column with exactly this name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def py_text(col: Column, dtype: T.DataType) -> Column:
    """Text form of a value as the source's string formatting renders it.

    NULL renders as ``None`` and booleans as ``True``/``False``; numbers and
    strings use Spark's cast, which agrees for the values used as ids and keys.
    """
    if isinstance(dtype, T.NullType):
        return F.lit("None")
    if isinstance(dtype, T.BooleanType):
        rendered = F.when(col, F.lit("True")).otherwise(F.lit("False"))
    elif isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        rendered = F.to_json(col)
    else:
        rendered = col.cast("string")
    return F.coalesce(rendered, F.lit("None"))


def as_double_or_zero(col: Column, dtype: T.DataType) -> Column:
    """``float(x or 0)``: falsy values and NULL give 0.0; text that is no number gives NULL, never 0."""
    if isinstance(dtype, T.NullType):
        return F.lit(0.0)
    if isinstance(dtype, T.StringType):
        return F.when(truthy(col, dtype), col.try_cast("double")).otherwise(F.lit(0.0))
    elif isinstance(dtype, T.BooleanType):
        value = F.when(col, F.lit(1.0))
    else:
        value = col.cast("double")
    return F.coalesce(value, F.lit(0.0))


# Number cells of the report format (the decimal mark may be a comma).
INTEGER_PATTERN = r"^-?\d+$"
DECIMAL_PATTERN = r"^-?\d+[.,]\d+$"


NUMBER_CELL = r"(?U)\A[\s\x1c-\x1f]*(-?[0-9]+(?:[.,][0-9]+)?)[\s\x1c-\x1f]*\z"


def report_number(text: Column) -> Column:
    """The number in a report cell, NULL when it holds none or an integer beyond 64 bits.

    One match finds and trims it, so the expression stays small where many columns are tried in one row.
    """
    core = F.regexp_extract(text, NUMBER_CELL, 1)
    number = F.translate(core, ",", ".").try_cast("double")
    return (F.when(F.length(core) <= 18, number).when(core.rlike("[.,]"), number)
            .otherwise(core.try_cast("bigint").cast("double")))


def python_type_name(dtype: T.DataType) -> str:
    """Name of the Python type that the source would see for this Spark type."""
    if isinstance(dtype, T.BooleanType):
        return "bool"
    if isinstance(dtype, INTEGRAL_TYPES):
        return "int"
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "float"
    if isinstance(dtype, T.StringType):
        return "str"
    if isinstance(dtype, (T.StructType, T.MapType)):
        return "dict"
    if isinstance(dtype, T.ArrayType):
        return "list"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    if isinstance(dtype, T.DateType):
        return "date"
    return "null" if isinstance(dtype, T.NullType) else dtype.simpleString()


def exact_sum(col) -> "Column":
    """Sum that does not depend on the order of addition, where the values allow it.

    A double sum changes in its last bits with the partitioning (the order in
    which partial sums meet), so the same query could return different cents
    on a different cluster layout.  When every value is below 1e17 and equal to
    itself as DECIMAL(38,10), the decimals are summed exactly and returned as a
    double.  A group with any other value (tiny, huge, NaN or infinite) gets
    the plain double sum: nothing is zeroed, dropped or aborted.
    """
    c = (F.col(col) if isinstance(col, str) else col).cast("double")
    exact = F.when(F.abs(c) < 1e17, c.try_cast("decimal(38,10)"))
    whole = F.bool_and(F.coalesce(exact.cast("double") == c, F.lit(False)) | c.isNull())
    return F.when(whole, F.sum(exact).cast("double")).otherwise(F.sum(c))


def clamp(value: int, low: int, high: int) -> int:
    """Parameter clamp used for page sizes (checked before a plan is built)."""
    return max(low, min(int(value), high))
