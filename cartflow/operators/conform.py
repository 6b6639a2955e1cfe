"""Typing rules: strict for tables, row-by-row rejection for documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartflow.schemas import Field, TableSpec


def _typed(spec: TableSpec, field: Field) -> Column:
    """The column cast to its declared type; any value that does not fit fails the job."""
    source = F.col(field.name)
    where = f"{spec.name}.{field.name}"
    if isinstance(field.type, T.StringType):
        value = source
        if field.max_chars:
            fits = F.length(source) <= field.max_chars
            # Blanks beyond the declared length are cut, anything else is too long.
            padded = F.length(F.rtrim(source)) <= field.max_chars
            too_long = F.raise_error(
                F.concat(F.lit(f"{where} longer than {field.max_chars} characters: "), source)
            )
            value = (
                F.when(source.isNull() | fits, source)
                .when(padded, F.substring(source, 1, field.max_chars))
                .otherwise(too_long.cast("string"))
            )
    else:
        cast = source.try_cast(field.type)
        bad = F.raise_error(F.concat(F.lit(f"{where} is not a valid {field.type.simpleString()}: "), source))
        value = F.when(source.isNull() | cast.isNotNull(), cast).otherwise(bad.cast(field.type))
    if field.name in spec.key and not spec.drop_null_keys:
        missing = F.raise_error(F.lit(f"{where} must not be empty"))
        value = F.when(source.isNotNull(), value).otherwise(missing.cast(field.type))
    return value.alias(field.name)


def by_name(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Declared columns by exact name: missing ones are NULL, others are left out.

    Empty text counts as missing.
    """
    present = set(rows.columns)
    return rows.select(
        *[
            (F.nullif(F.col(f"`{c}`"), F.lit("")) if c in present else F.lit(None).cast("string")).alias(c)
            for c in spec.columns
        ],
        *[c for c in rows.columns if c.startswith("_seq_")],
    )


def strict(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Text rows cast to the table's types; keys checked."""
    if spec.drop_null_keys:
        for name in spec.key:
            rows = rows.where(F.col(name).isNotNull())
    return rows.select(
        *[_typed(spec, f) for f in spec.fields],
        *[c for c in rows.columns if c.startswith("_seq_")],
    )


def _always_fits(given: T.DataType, wanted: T.DataType) -> bool:
    """Whether no value of the given type can fail the cast; spares the check."""
    if given == wanted or (isinstance(wanted, T.StringType) and isinstance(given, T.AtomicType)):
        return True
    widths = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
    return type(given) in widths and type(wanted) in widths[widths.index(type(given)) :]


def check_mapping(docs: DataFrame, mapping: T.StructType) -> DataFrame:
    """Documents cast to ``mapping``, with the names of unfit fields in ``_unfit``.

    A document is fit when every field it fills can be read as the mapped type.
    Fields it does not have are NULL.
    """
    casts, unfit = [], []
    for field in mapping.fields:
        if field.name not in docs.columns:
            casts.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        source = F.col(field.name)
        if _always_fits(docs.schema[field.name].dataType, field.dataType):
            casts.append(source.cast(field.dataType).alias(field.name))
            continue
        value = source.try_cast(field.dataType)
        casts.append(value.alias(field.name))
        unfit.append(F.when(source.isNotNull() & value.isNull(), F.lit(field.name)))
    names = F.array_compact(F.array(*unfit)) if unfit else F.array().cast("array<string>")
    return docs.select(*casts, names.alias("_unfit"))
