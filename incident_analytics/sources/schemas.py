"""The four input tables: raw column names, canonical names and canonical types.

Every table is read as text and typed here, by name. Inference would cost one more pass
over each file and would turn HHMM text such as ``0630`` into the number 630.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incident_analytics.functions.money import currency_to_int
from incident_analytics.functions.times import text_year, us_timestamp


@dataclass(frozen=True)
class Field:
    """One column: its header in the raw file, our name for it, and its kind.

    ``kind`` is a Spark type name, or one of ``us_timestamp``, ``us_year``, ``currency``
    (text layouts that need parsing), ``trimmed`` (text without outer blanks), ``code`` (the
    same, without the ``.0`` that a number column leaves behind) and ``number_code`` (a code
    whose leading zeros don't count: ``01`` is ``1``). Codes stay text, so none is lost. A
    ``raw_only`` column is there while the source holds text; a typed copy does not keep it.
    """

    raw: str
    name: str
    kind: str
    raw_only: bool = False


# The headers of the input files.
INCIDENTS = (
    Field("DR_NO", "dr_no", "code"),
    Field("Date Rptd", "date_rptd", "us_timestamp"),
    Field("Date Rptd", "rptd_year", "us_year"),
    Field("DATE OCC", "date_occ", "us_timestamp"),
    Field("DATE OCC", "date_occ_text", "string", raw_only=True),
    Field("TIME OCC", "time_occ", "string"),
    Field("AREA", "area", "number_code"),
    Field("Premis Desc", "premis_desc", "string"),
    Field("Vict Descent", "vict_descent", "string"),
    Field("Weapon Used Cd", "weapon_cd", "code"),
    Field("LAT", "lat", "double"),
    Field("LON", "lon", "double"),
)
INCOME = (
    Field("Zip Code", "zip", "trimmed"),
    Field("Estimated Median Income", "median_income", "currency"),
)
REVGEO = (
    Field("LAT", "lat", "double"),
    Field("LON", "lon", "double"),
    Field("ZIPcode", "zip", "trimmed"),
)
STATIONS = (
    Field("X", "lon", "double"),
    Field("Y", "lat", "double"),
    Field("DIVISION", "division", "string"),
    Field("PREC", "prec", "number_code"),
)
TABLES = {
    "incidents": INCIDENTS,
    "income": INCOME,
    "revgeo": REVGEO,
    "stations": STATIONS,
}


_TEXT_KINDS = ("trimmed", "code", "number_code")


def _is_text(source: T.StructField) -> bool:
    return isinstance(source.dataType, T.StringType)


def _typed(field: Field, source: T.StructField) -> Column:
    column = F.col(f"`{source.name}`")
    is_text = _is_text(source)
    if field.kind == "us_timestamp":
        return us_timestamp(column) if is_text else column.cast("timestamp")
    if field.kind == "us_year":
        if is_text:
            return text_year(column).try_cast("int")
        return column.cast("int") if source.name == field.name else F.year(column)
    if field.kind == "currency":
        return currency_to_int(column) if is_text else column.cast("bigint")
    if field.kind in _TEXT_KINDS:
        # A typed copy holds it as it shall be: a bare column, so that filters reach the scan.
        if is_text and source.name == field.name:
            return column
        text = F.trim(column.cast("string"))
        if field.kind == "trimmed":
            return text
        text = F.regexp_replace(text, r"\.0+$", "")
        return F.regexp_replace(text, "^0+(?=.)", "") if field.kind == "number_code" else text
    # A bare column where the type already fits, so that filters on it reach the scan.
    if source.dataType.simpleString() == field.kind:
        return column
    return column.try_cast(field.kind)


#: Columns that say of a row whether a value of the column named behind it was unreadable.
UNREADABLE = "_unreadable_"


def _unreadable(field: Field, source: T.StructField) -> Column | None:
    """Whether a text that is not blank gives no value; None for columns in which every text is one."""
    if not _is_text(source) or field.kind in (*_TEXT_KINDS, "string"):
        return None
    raw = F.trim(F.col(f"`{source.name}`"))
    return F.coalesce((raw != "") & _typed(field, source).isNull(), F.lit(False))


def canonicalize(
    df: DataFrame,
    fields: Sequence[Field],
    columns: Sequence[str] | None = None,
    marks: bool = False,
    also: Sequence[str] = (),
) -> DataFrame:
    """Pick the known columns of ``df`` by name and give them canonical names and types.

    Headers match without regard to case and outer blanks, so ``'AREA '`` is ``AREA``.
    Columns that already carry the canonical name (a converted Parquet copy) pass through.
    Unreadable values become null; with ``marks`` a further column ``_unreadable_x`` says so for each column x of text
    that has to be parsed, see `accounted`. ``columns`` restricts the result; a wanted column that
    the input lacks is an error. Columns named by ``also`` are kept as they are.
    """
    present = {f.name.strip().casefold(): f for f in df.schema.fields}
    unknown = set(columns or ()) - {f.name for f in fields}
    if unknown:
        raise ValueError(f"not columns of this table: {sorted(unknown)}")
    chosen, marked = [], []
    for field in fields:
        if columns is not None and field.name not in columns:
            continue
        source = present.get(field.raw.casefold()) or present.get(field.name.casefold())
        if field.raw_only and columns is None and not (source and _is_text(source)):
            continue
        if source is None:
            raise ValueError(f"input has no column {field.raw!r} (or {field.name!r})")
        chosen.append(_typed(field, source).alias(field.name))
        mark = _unreadable(field, source) if marks else None
        if mark is not None:
            marked.append(mark.alias(UNREADABLE + field.name))
    return df.select(*chosen, *marked, *also)


def accounted(df: DataFrame, account: Observation) -> DataFrame:
    """``df`` without the marks of `canonicalize`; ``account`` gets their counts when a query over it ends.

    ``account.get`` has ``rows`` and, per marked column, the number of unreadable values, counted in the same pass as the
    query. It waits for a query to end, counts the rows that this query reads, and serves one data frame.
    """
    marks = [c for c in df.columns if c.startswith(UNREADABLE)]
    counts = [F.count_if(F.col(c)).alias(c.removeprefix(UNREADABLE)) for c in marks]
    return df.observe(account, F.count(F.lit(1)).alias("rows"), *counts).drop(*marks)


def stored_columns(table: str, columns: Sequence[str] | None = None) -> list[str]:
    """The named columns (by default all) that a typed copy of a table keeps."""
    return [
        f.name for f in TABLES[table] if not f.raw_only and (columns is None or f.name in columns)
    ]


def stored_text(table: str) -> dict[str, str]:
    """The columns that a typed copy of a table holds as text."""
    kinds = ("string", *_TEXT_KINDS)
    return {f.name: "string" for f in TABLES[table] if f.kind in kinds and not f.raw_only}


def as_typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Project ``df`` to the named columns, in order, cast to the declared Spark types."""
    return df.select(*[F.col(name).cast(kind).alias(name) for name, kind in types.items()])
