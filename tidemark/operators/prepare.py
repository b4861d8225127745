"""Preparation: trim, blank-to-NULL, column defaults, manual corrections, profile.

PRE1-PRE7, AGG6-AGG12, JN1, WIN2, WIN3.

Order is trim → blank → impute → correct, as in the source system.

Plan shape (no Python in the row path):

* **Defaults** come from one global aggregate for numeric/boolean columns and
  one ``explode → groupBy(column, value).count() → min(struct(-count, value))``
  pass for text-like columns (the second step is one global aggregate).  Both are decomposable, so a hot value costs one
  partial row per task.  Each result is a one-row DataFrame used through a
  scalar subquery (``DataFrame.scalar()``): Spark runs it once, reuses it for
  every column and inlines it into the projection — no cross join, no collect.
* **Corrections** touch only the rows they name: the rows are semi-joined to
  the corrected ids, the last row per id is picked among those candidates, the
  final value per cell is a ``max_by`` aggregate, and one left join on the
  stored ordinal applies a ``map<column, value>`` per row.  The correction side
  is not broadcast by hand; AQE broadcasts it when its measured size is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import blank_to_null, is_trimmed, py_strip
from tidemark.functions.values import INTEGRAL_TYPES, field, python_type_name, quoted, truthy
from tidemark.operators.modes import cell_counts, certified_modes

# Labels the source system writes into its preparation records.
IMPUTED_UNKNOWN = "IMPUTED_UNKNOWN"
IMPUTE_METHOD = "column_default"
REJECT_NO_RECORD = "record topilmadi"
REJECT_NO_COLUMN = "record yoki column topilmadi"
REJECT_TYPE = "type_mismatch"  # our own third reason (D5)
TRUE_WORDS = ["1", "true", "yes", "ha"]
DEFAULT_EXCLUDE = ("id", "dw_id")

FRACTIONAL_TYPES = (T.FloatType, T.DoubleType, T.DecimalType)


def _kind(dtype: T.DataType) -> str:
    if isinstance(dtype, T.BooleanType):
        return "bool"
    if isinstance(dtype, INTEGRAL_TYPES):
        return "int"
    if isinstance(dtype, FRACTIONAL_TYPES):
        return "float"
    if isinstance(dtype, T.StringType):
        return "str"
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return "complex"
    if isinstance(dtype, T.NullType):
        return "void"
    return "atomic"


def _to_text(col: Column, dtype: T.DataType) -> Column:
    """Canonical text of a typed value (JSON for nested values)."""
    if _kind(dtype) == "complex":
        return F.to_json(col)
    return col.cast("string")


def _from_text(text: Column, dtype: T.DataType) -> Column:
    """Inverse of ``_to_text``."""
    kind = _kind(dtype)
    if kind == "complex":
        return F.from_json(text, dtype)
    if kind == "str":
        return text
    if kind == "void":
        return text
    return text.try_cast(dtype)


# ---------------------------------------------------------------------------
# PRE1 / PRE2
# ---------------------------------------------------------------------------
def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def trim_blank(df: DataFrame) -> DataFrame:
    """Trim every top-level string (Unicode white space) and turn ``''`` into NULL."""
    strings = set(string_columns(df))
    return df.select(*[blank_to_null(quoted(c)).alias(c) if c in strings else quoted(c) for c in df.columns])


# ---------------------------------------------------------------------------
# PRE3 / AGG6-AGG10: column defaults
# ---------------------------------------------------------------------------
def _numeric_default(col: Column, kind: str) -> Column:
    present = F.count(col) > 0
    if kind == "int":
        value = F.bround(F.avg(col)).cast("bigint")
    elif kind == "float":
        value = F.bround(F.avg(col.cast("double")), 2)
    else:  # bool: majority, a tie counts as True
        value = F.count_if(col) >= F.count(col) / 2
    return F.when(present, value)


def column_defaults(df: DataFrame, exclude=DEFAULT_EXCLUDE, certified: bool = False) -> tuple[DataFrame | None, DataFrame | None]:
    """Two one-row DataFrames: numeric/boolean defaults and text-like defaults.

    Columns are named after the input columns.  An all-NULL text column gets
    ``IMPUTED_UNKNOWN``; an all-NULL typed column keeps NULL (D6).  Text-like
    defaults are the most common value, ties to the smallest text (AGG9): counted
    in one pass, or with ``certified`` by summaries and a recount (``modes``), which reads
    the rows more often and shuffles far fewer distinct cells.
    """
    fields = [f for f in df.schema.fields if f.name not in exclude]
    numeric = [f for f in fields if _kind(f.dataType) in ("int", "float", "bool")]
    textual = [f for f in fields if _kind(f.dataType) in ("str", "atomic", "complex", "void")]

    num_row = None
    if numeric:
        num_row = df.agg(*[_numeric_default(quoted(f.name), _kind(f.dataType)).alias(f.name) for f in numeric])

    text_row = None
    if textual:
        texts = {f.name: _to_text(quoted(f.name), f.dataType) for f in textual}
        # One global aggregate picks every column's winner: the smallest (-count, value) among that column's entries; partial per task.
        counts = certified_modes(df, texts) if certified else cell_counts(df, texts)
        ranked = F.struct((-F.col("n")).alias("neg_n"), F.col("value").alias("value"))
        row = counts.agg(*[F.min(F.when(F.col("column") == f.name, ranked)).getField("value").alias(f.name) for f in textual])
        text_row = row.select(*[
            (F.coalesce(quoted(f.name), F.lit(IMPUTED_UNKNOWN)) if _kind(f.dataType) in ("str", "void")
             else _from_text(quoted(f.name), f.dataType)).alias(f.name)
            for f in textual
        ])
    return num_row, text_row


class Defaults:
    """Column defaults as fields of (at most) two one-row scalar subqueries.

    ``attach`` adds each subquery **once** as a struct column; ``self[c]`` then
    reads the field from that column.  Referencing the subquery per column
    instead would make Catalyst plan one subquery expression per column.
    """

    NUM, TEXT = "__defaults_num", "__defaults_text"

    def __init__(self, num_row: DataFrame | None, text_row: DataFrame | None):
        self._subq: dict[str, Column] = {}
        self._where: dict[str, str] = {}
        for name, row in ((self.NUM, num_row), (self.TEXT, text_row)):
            if row is None:
                continue
            self._subq[name] = row.select(F.struct(*[quoted(c) for c in row.columns]).alias("d")).scalar()
            for c in row.columns:
                self._where[c] = name

    def __contains__(self, column: str) -> bool:
        return column in self._where

    def __iter__(self):
        return iter(self._where)

    def __bool__(self) -> bool:
        return bool(self._where)

    def __getitem__(self, column: str) -> Column:
        return F.col(self._where[column]).getField(column)

    def attach(self, df: DataFrame) -> DataFrame:
        return df.withColumns(self._subq) if self._subq else df

    def detach(self, df: DataFrame) -> DataFrame:
        return df.drop(*self._subq)


def default_columns(df: DataFrame, exclude=DEFAULT_EXCLUDE, certified: bool = False) -> Defaults:
    """Per-column defaults (AGG6-AGG10) for ``impute`` and the counters."""
    return Defaults(*column_defaults(df, exclude, certified))


def impute(df: DataFrame, defaults: Defaults) -> DataFrame:
    """Fill NULLs with the column default; nested NULLs are left alone (PRE3)."""
    dtypes = dict((f.name, f.dataType) for f in df.schema.fields)
    cols = []
    columns = df.columns
    df = defaults.attach(df)
    for c in columns:
        if c in defaults:
            target = dtypes[c] if not isinstance(dtypes[c], T.NullType) else T.StringType()
            cols.append(F.coalesce(quoted(c).cast(target), defaults[c].cast(target)).alias(c))
        else:
            cols.append(quoted(c))
    return df.select(*cols)


def record_label(df: DataFrame) -> Column:
    """``id or dw_id or 'unknown'`` with the source's falsy rule (0 and '' are missing)."""
    out = F.lit("unknown")
    for name in ("dw_id", "id"):
        col, dtype = field(df, name)
        if not isinstance(dtype, T.NullType):
            out = F.when(truthy(col, dtype), col.cast("string")).otherwise(out)
    return out


def imputation_log(cleaned: DataFrame, defaults: Defaults) -> DataFrame:
    """PRE4: one row per imputed cell: record, column, method, value (as text)."""
    if not defaults:
        return cleaned.sparkSession.createDataFrame([], "record_id string, column string, method string, value string")
    dtypes = dict((f.name, f.dataType) for f in cleaned.schema.fields)
    entries = F.array(*[
        F.when(quoted(c).isNull() & defaults[c].isNotNull(),
               F.struct(F.lit(c).alias("column"), _to_text(defaults[c], dtypes[c]).alias("value")))
        for c in cleaned.columns if c in defaults
    ])
    return (defaults.attach(cleaned).select(record_label(cleaned).alias("record_id"), F.explode(entries).alias("e"))
            .where(F.col("e").isNotNull())
            .select("record_id", F.col("e.column").alias("column"), F.lit(IMPUTE_METHOD).alias("method"),
                    F.col("e.value").alias("value")))


# ---------------------------------------------------------------------------
# PRE5 / PRE6 / JN1 / WIN2 / WIN3: manual corrections
# ---------------------------------------------------------------------------
def coerce(value: Column, dtype: T.DataType) -> tuple[Column, Column]:
    """Correction text → (canonical text of the typed value, parsed-ok flag).

    Text is trimmed and a blank becomes NULL; booleans are true for
    ``1/true/yes/ha``; numbers must parse or the correction is rejected (D5).
    """
    return coerce_clean(blank_to_null(value), dtype)


def coerce_clean(v: Column, dtype: T.DataType) -> tuple[Column, Column]:
    """``coerce`` for text that is already trimmed and blank-to-NULL."""
    kind = _kind(dtype)
    if kind in ("str", "void"):
        return v, F.lit(True)
    if kind == "bool":
        return F.when(v.isNotNull(), F.lower(v).isin(TRUE_WORDS).cast("string")), F.lit(True)
    if kind == "int":
        typed = v.try_cast("bigint")
    elif kind == "float":
        typed = v.try_cast("double")
    elif kind == "complex":
        typed = F.from_json(v, dtype)
        return F.when(typed.isNotNull(), F.to_json(typed)), v.isNull() | typed.isNotNull()
    else:
        typed = v.try_cast(dtype)
    return typed.cast("string"), v.isNull() | typed.isNotNull()


def _by_column(column: Column, mapping: dict[str, Column], default: Column) -> Column:
    expr = default
    for name, value in mapping.items():
        expr = F.when(column == F.lit(name), value).otherwise(expr)
    return expr


def correct(
    prepared: DataFrame,
    corrections: DataFrame,
    *,
    id_col: str = "id",
    ordinal: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Apply corrections in ``seq`` order; return (corrected rows, audit).

    Audit columns: seq, record_id, column, value, status (applied/rejected),
    reason, before, after.  ``before`` of a correction is the cell value left
    by the previous applied correction of the same cell, else the prepared
    value.  Among rows sharing an id only the last one (highest ``ordinal``)
    is corrected; without ``ordinal`` ids are taken as unique.
    """
    fields = {f.name: f.dataType for f in prepared.schema.fields}
    # Records without an id column cannot be named: every correction is a reject.
    id_text = (F.col(id_col).cast("string") if id_col in fields else F.lit(None).cast("string"))
    corr = corrections.select(
        F.col("seq").cast("bigint").alias("seq"),
        F.col("record_id").cast("string").alias("record_id"),
        F.coalesce(F.col("column").cast("string"), F.lit("")).alias("column"),
        F.col("value").cast("string").alias("value"),
    )
    # Which rows are named: decided on (id, ordinal) alone, before any cell is
    # rendered.  The last row per id is a max aggregate (partial on the map
    # side, so an id shared by many rows never lands in one task as rows).
    wanted = corr.select("record_id").where(F.col("record_id").isNotNull())
    row_key = F.col(ordinal) if ordinal else id_text
    ids = prepared.select(id_text.alias("__fix_rid"), row_key.alias("__fix_at"))
    last = (ids.join(wanted, ids["__fix_rid"] == wanted["record_id"], "left_semi")
            .groupBy("__fix_rid").agg(F.max("__fix_at").alias("__fix_row")))
    # Only the named rows become maps of text cells.  This join and the last one
    # below use the same key over the same rows: a shuffle of them is reused.
    cells = F.map_from_arrays(F.array(*[F.lit(c) for c in fields]),
                              F.array(*[_to_text(quoted(c), t) for c, t in fields.items()]))
    cand_cells = (prepared.withColumn("__fix_at", row_key).join(last, F.col("__fix_at") == F.col("__fix_row"))
                  .where(id_text == F.col("__fix_rid")).select("__fix_rid", "__fix_row", cells.alias("__fix_cells")))

    j = corr.join(cand_cells, corr["record_id"] == cand_cells["__fix_rid"], "left")
    # Coercion is built once per distinct column *type*, not once per column:
    # a SQL map literal gives each correction its target column's type.
    type_names = {c: t.simpleString() for c, t in fields.items()}
    by_type = {t.simpleString(): t for t in fields.values()}
    type_map = F.create_map(*[F.lit(x) for pair in type_names.items() for x in pair])
    j = j.select("*", blank_to_null(F.col("value")).alias("__fix_v"), type_map[F.col("column")].alias("__fix_type"))
    coerced = {tn: coerce_clean(F.col("__fix_v"), t) for tn, t in by_type.items()}
    after = _by_column(F.col("__fix_type"), {tn: v for tn, (v, _) in coerced.items()}, F.lit(None).cast("string"))
    ok = _by_column(F.col("__fix_type"), {tn: k for tn, (_, k) in coerced.items()}, F.lit(False))
    has_record = F.col("__fix_rid").isNotNull()
    has_column = F.col("__fix_type").isNotNull() & (F.col("column") != F.lit(""))
    reason = (F.when(~has_record, F.lit(REJECT_NO_RECORD))
              .when(~has_column, F.lit(REJECT_NO_COLUMN))
              .when(~ok, F.lit(REJECT_TYPE)))
    staged = j.select("seq", "record_id", "column", "value", "__fix_row",
                      F.col("__fix_cells")[F.col("column")].alias("__fix_cell"),
                      reason.alias("reason"), after.alias("after"))
    applied = staged.where(F.col("reason").isNull())

    # Before-values come from a window per cell over the *applied* corrections;
    # the rejected ones (which may all name one missing record) join no window.
    cell = (Window.partitionBy("__fix_row", "column").orderBy("seq")
            .rowsBetween(Window.unboundedPreceding, -1))
    shown = ["seq", "record_id", "column", "value"]
    previous = F.last(F.struct("after")).over(cell)
    no_text = F.lit(None).cast("string")
    audit = applied.select(
        *shown, F.lit("applied").alias("status"), "reason",
        F.when(previous.isNotNull(), previous.getField("after")).otherwise(F.col("__fix_cell")).alias("before"), "after",
    ).unionByName(staged.where(F.col("reason").isNotNull()).select(
        *shown, F.lit("rejected").alias("status"), "reason", no_text.alias("before"), no_text.alias("after")))

    # Final value per cell first: max_by is decomposable, so even a cell that
    # receives a huge share of all corrections collapses map-side.  The map per
    # row then collects at most one entry per column.
    final = (applied.groupBy("__fix_row", "column").agg(F.max_by("after", "seq").alias("after"))
             .groupBy("__fix_row").agg(F.map_from_entries(F.collect_list(F.struct("column", "after"))).alias("__fix_fix")))
    out = prepared.withColumn("__fix_at", row_key).join(final, F.col("__fix_at") == F.col("__fix_row"), "left")
    fixed = [
        F.when(F.map_contains_key(F.col("__fix_fix"), F.lit(c)),
               _from_text(F.col("__fix_fix")[F.lit(c)], t)).otherwise(quoted(c)).alias(c)
        for c, t in fields.items()
    ]
    return out.select(*fixed), audit


# ---------------------------------------------------------------------------
# PRE7 / AGG11 / AGG12: profile
# ---------------------------------------------------------------------------
def column_types(df: DataFrame) -> DataFrame:
    """AGG12: source-style type name per column, ``null`` when it has no value."""
    counts = df.agg(*[F.count(quoted(c)).alias(c) for c in df.columns])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(f.name).alias("column"),
                 F.when(quoted(f.name) > 0, F.lit(python_type_name(f.dataType))).otherwise(F.lit("null"))
                 .alias("type"))
        for f in df.schema.fields
    ])).alias("t")).select("t.column", "t.type")


def preparation_profile(raw: DataFrame, defaults: Defaults, audit: DataFrame) -> DataFrame:
    """AGG11: one row of counters from one pass over the raw rows.

    Trim/blank flags and "will be imputed" flags are computed per cell from the
    raw value; correction counters come from the audit through one reused
    scalar subquery.
    """
    strings = set(string_columns(raw))
    trimmed, blank, imputed = [], [], []
    for c in raw.columns:
        col = quoted(c)
        cleaned = blank_to_null(col) if c in strings else col
        if c in strings:
            trimmed.append(F.when(is_trimmed(col), 1).otherwise(0))
            blank.append(F.when(py_strip(col) == F.lit(""), 1).otherwise(0))
        if c in defaults:
            imputed.append(F.when(cleaned.isNull() & defaults[c].isNotNull(), 1).otherwise(0))

    def total(parts):
        return F.sum(sum(parts, F.lit(0))).cast("bigint") if parts else F.lit(0).cast("bigint")

    corr = audit.agg(F.count_if(F.col("status") == "applied").alias("applied"),
                     F.count_if(F.col("status") == "rejected").alias("rejected"))
    packed = F.col("__corrections")
    base = defaults.attach(raw).withColumn("__corrections", corr.select(F.struct("applied", "rejected")).scalar())
    return base.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(raw.columns)).cast("bigint").alias("columns"),
        total(trimmed).alias("trimmed_values"),
        total(blank).alias("blank_to_null"),
        total(imputed).alias("imputed_values"),
        F.first(packed.getField("applied")).alias("manual_corrections_applied"),
        F.first(packed.getField("rejected")).alias("manual_corrections_rejected"),
    )


class Prepared:
    """Outputs of one preparation.  Each is a lazy DataFrame built on first
    access, so asking for the rows does not plan the profile or the log."""

    def __init__(self, raw: DataFrame, corrections: DataFrame | None, id_col: str,
                 ordinal: str | None, exclude, certified: bool = False):
        self._certified = certified
        self._raw, self._corr, self._id, self._ord = raw, corrections, id_col, ordinal
        self._internal = (ordinal,) if ordinal and ordinal != id_col else ()
        self._exclude = tuple(exclude) + self._internal
        self._cache: dict[str, object] = {}

    def _get(self, key, build):
        if key not in self._cache:
            self._cache[key] = build()
        return self._cache[key]

    @property
    def cleaned(self) -> DataFrame:
        return self._get("cleaned", lambda: trim_blank(self._raw))

    @property
    def defaults(self) -> Defaults:
        return self._get("defaults", lambda: default_columns(self.cleaned, self._exclude, self._certified))

    @property
    def imputed(self) -> DataFrame:
        return self._get("imputed", lambda: impute(self.cleaned, self.defaults))

    def _corrected(self):
        def build():
            corr = self._corr
            if corr is None:
                corr = self._raw.sparkSession.createDataFrame([], "seq long, record_id string, column string, "
                                                                  "value string")
            return correct(self.imputed, corr, id_col=self._id, ordinal=self._ord)
        return self._get("corrected", build)

    @property
    def rows(self) -> DataFrame:
        return self._corrected()[0]

    @property
    def corrections(self) -> DataFrame:
        return self._corrected()[1]

    @property
    def imputation_log(self) -> DataFrame:
        return self._get("log", lambda: imputation_log(self.cleaned, self.defaults))

    @property
    def profile(self) -> DataFrame:
        return self._get("profile", lambda: preparation_profile(
            self._raw.drop(*self._internal), self.defaults, self.corrections))

    @property
    def column_types(self) -> DataFrame:
        return self._get("types", lambda: column_types(self.rows.drop(*self._internal)))


def prepare(
    raw: DataFrame,
    corrections: DataFrame | None = None,
    *,
    id_col: str = "id",
    ordinal: str | None = None,
    exclude=DEFAULT_EXCLUDE,
    certified: bool = False,
) -> Prepared:
    """PRE1-PRE7 end to end on a raw DataFrame (trim → blank → impute → correct).

    An ``ordinal`` other than the id is an internal column: it is never
    imputed and does not count in the profile or the type listing.  ``certified``
    finds the most common values by summaries (see ``column_defaults``).
    """
    return Prepared(raw, corrections, id_col, ordinal, exclude, certified)
