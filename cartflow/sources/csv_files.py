"""CSV files as text rows, split over tasks even where fields hold line breaks.

A quote opens a field only at the field's start; elsewhere it is a plain character. A quoted field ends
at a quote that is not doubled, and what follows up to the next comma still belongs to it. Records end at
``\\n`` or ``\\r\\n``, and empty lines are no records.

Tables say whether their fields may hold line breaks. Without them, every line is a record, read
in one pass; a line that leaves a quote open fails the load. With them, each line is a small map from
"starts inside quotes" to "ends inside quotes". Such maps are constant, keep or swap the state, and compose:
the state before a line is the last constant's and the swaps since. So blocks of a file are worked on side by side, and
only one total for each block meets the others. The result does not depend on where files are split.
"""

from __future__ import annotations

import csv

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Position of a row in its input: file, block start, row within the block.
SEQUENCE = ("_seq_file", "_seq_block", "_seq_row")

# Inside of a quoted field, a whole field, and the state of a line. Possessive throughout: no back-tracking.
_INSIDE = '[^"]*+(?:""[^"]*+)*+'
_FIELD = f'(?:"{_INSIDE}"[^,]*+|[^",][^,]*+|)'
_OPEN_FROM_OUTSIDE = f'\\A(?:{_FIELD},)*+"{_INSIDE}\\z'
_OPEN_FROM_INSIDE = f'\\A{_INSIDE}(?:\\z|"[^,]*+,(?:{_FIELD},)*+"{_INSIDE}\\z)'
_QUOTED = f'(?s)\\A"({_INSIDE})"(.*)\\z'

#: Whole lines through the CSV reader, which checks and drops the header line of every file.
#: The separator is made of characters that Unicode keeps out of texts.
_WHOLE_LINES = {"header": True, "sep": "\ufdd0\ufdd1\ufdd0", "quote": "", "lineSep": "\n", "encoding": "UTF-8", "mode": "PERMISSIVE"}


def _sequence() -> list[Column]:
    return [
        F.col("_metadata.file_path").alias("_seq_file"),
        F.col("_metadata.file_block_start").alias("_seq_block"),
        F.monotonically_increasing_id().alias("_seq_row"),
    ]


def header_line(spark: SparkSession, location: str) -> str | None:
    """First line of the first file of ``location`` (file, folder or glob); None if there is none."""
    try:
        columns = spark.read.options(**_WHOLE_LINES).csv(location).columns
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return columns[0] if columns else None


def _without_return(value: Column) -> Column:
    return F.when(value.endswith("\r"), F.expr("substring(value, 1, length(value) - 1)")).otherwise(value)


def fields_of(record: Column) -> Column:
    """The fields of a whole record as an array, unquoted."""

    def unquoted(field: Column) -> Column:
        inside = F.replace(F.regexp_extract(field, _QUOTED, 1), F.lit('""'), F.lit('"'))
        tail = F.regexp_extract(field, _QUOTED, 2)
        return F.when(field.startswith('"'), F.concat(inside, tail)).otherwise(field)

    # A comma behind every field, the last one too, so that each match is one field and its comma.
    found = F.regexp_extract_all(F.concat(record, F.lit(",")), F.lit(f"{_FIELD},"), 0)
    split = F.transform(found, lambda f: unquoted(F.substring(f, F.lit(1), F.length(f) - 1)))
    return F.when(record.contains('"'), split).otherwise(F.split(record, ","))


def _single_lines(spark: SparkSession, location: str, header: str) -> DataFrame:
    """Lines below the headers, each a record."""
    column = f"`{header.replace('`', '``')}` string"
    # enforceSchema=False: a file whose header differs fails instead of shifting columns.
    lines = spark.read.schema(column).options(**_WHOLE_LINES, enforceSchema=False).csv(location)
    lines = lines.select(F.col(f"`{header.replace('`', '``')}`").alias("value"), *_sequence())
    broken = F.col("value").contains('"') & F.col("value").rlike(_OPEN_FROM_OUTSIDE)
    message = F.concat(F.lit("line break in quotes, or unclosed quote, in "), F.col("_seq_file"))
    return lines.select(
        F.when(broken, F.raise_error(message).cast("string")).otherwise(_without_return(F.col("value"))).alias("value"),
        *SEQUENCE,
    )


def _lines(spark: SparkSession, location: str) -> DataFrame:
    """All lines with their maps: state at the end if the line starts outside and if it starts inside quotes."""
    value = F.col("value")
    quoted = value.contains('"')
    lines = spark.read.option("lineSep", "\n").text(location)
    return lines.select(
        "value",
        (quoted & value.rlike(_OPEN_FROM_OUTSIDE)).alias("after_out"),
        (~quoted | value.rlike(_OPEN_FROM_INSIDE)).alias("after_in"),
        *_sequence(),
    )


def _constant() -> Column:
    return F.col("after_out") == F.col("after_in")


def _swap() -> Column:
    return F.col("after_out") & ~F.col("after_in")


def _composed(rows: DataFrame, before: Window, prefix: str) -> DataFrame:
    """The map of all rows before each one, as the state it gives from outside and from inside.

    Rows have ``after_out`` and ``after_in``; adds ``{prefix}_out`` and ``{prefix}_in``.
    """
    swaps = F.coalesce(F.sum(_swap().cast("int")).over(before), F.lit(0))
    counted = rows.withColumn("_swaps", swaps)
    settled = F.when(_constant(), F.struct(F.col("after_out").alias("state"), F.col("_swaps").alias("swaps")))
    counted = counted.withColumn("_last", F.last(settled, ignorenulls=True).over(before))
    odd = (F.col("_swaps") - F.coalesce(F.col("_last.swaps"), F.lit(0))) % 2 == 1

    def from_state(start: bool) -> Column:
        return F.coalesce(F.col("_last.state"), F.lit(start)) != odd

    return counted.withColumns({f"{prefix}_out": from_state(False), f"{prefix}_in": from_state(True)}).drop("_swaps", "_last")


def assemble_records(lines: DataFrame) -> DataFrame:
    """Whole records from lines with their maps, each with its number in the file.

    A line starts a record if its state before is outside. A file that ends inside quotes fails.
    """
    in_block = Window.partitionBy("_seq_file", "_seq_block").orderBy("_seq_row")
    before_line = in_block.rowsBetween(Window.unboundedPreceding, -1)
    # One row for each block of a file.
    before_block = Window.partitionBy("_seq_file").orderBy("_seq_block").rowsBetween(Window.unboundedPreceding, -1)
    composed = _composed(lines, before_line, "before")

    def then(state: str) -> Column:
        return F.when(F.col(state), F.col("after_in")).otherwise(F.col("after_out"))

    # The last line's map after all lines before it is the map of the block.
    blocks = composed.groupBy("_seq_file", "_seq_block").agg(
        F.max_by(F.struct(then("before_out").alias("o"), then("before_in").alias("i")), "_seq_row").alias("end"),
        F.count_if(~F.col("before_out")).alias("starts_out"),
        F.count_if(~F.col("before_in")).alias("starts_in"),
    )
    blocks = blocks.select("*", F.col("end.o").alias("after_out"), F.col("end.i").alias("after_in"))
    blocks = _composed(blocks, before_block, "block").withColumn("open", F.col("block_out"))
    starts = F.when(F.col("open"), F.col("starts_in")).otherwise(F.col("starts_out"))
    records = F.coalesce(F.sum(starts).over(before_block), F.lit(0))
    end = F.when(F.col("open"), F.col("after_in")).otherwise(F.col("after_out"))
    at_end = F.lead("_seq_block").over(Window.partitionBy("_seq_file").orderBy("_seq_block")).isNull()
    unclosed = F.raise_error(F.concat(F.lit("unclosed quote in "), F.col("_seq_file"))).cast("bigint")
    blocks = blocks.select(
        "_seq_file", "_seq_block", "open", F.when(at_end & end, unclosed).otherwise(records).alias("records")
    )
    inside = F.when(F.col("open"), F.col("before_in")).otherwise(F.col("before_out"))
    numbered = (
        composed.join(blocks, ["_seq_file", "_seq_block"])
        .withColumn("inside", inside)
        .withColumn("open_after", F.when(F.col("inside"), F.col("after_in")).otherwise(F.col("after_out")))
        .withColumn("record", F.col("records") + F.sum((~F.col("inside")).cast("int")).over(in_block))
    )
    whole = ~F.col("inside") & ~F.col("open_after")
    single = numbered.where(whole).select("value", "record", *SEQUENCE)
    pieces = (
        numbered.where(~whole)
        .groupBy("_seq_file", "record")
        .agg(F.sort_array(F.collect_list(F.struct("_seq_block", "_seq_row", "value"))).alias("p"))
    )
    joined = pieces.select(
        F.array_join(F.col("p.value"), "\n").alias("value"),
        "record",
        "_seq_file",
        F.col("p")[0]["_seq_block"].alias("_seq_block"),
        F.col("p")[0]["_seq_row"].alias("_seq_row"),
    )
    return single.unionByName(joined)


def _glued_lines(spark: SparkSession, location: str, header: str) -> DataFrame:
    """Records below the headers, put together from lines."""
    records = assemble_records(_lines(spark, location)).withColumn("value", _without_return(F.col("value")))
    message = F.concat(F.lit("header differs in "), F.col("_seq_file"))
    same = F.when(F.col("value") == F.lit(header), F.lit(False)).otherwise(F.raise_error(message).cast("boolean"))
    return records.where(F.when(F.col("record") == 1, same).otherwise(F.lit(True))).where(F.col("value") != "")


def read_rows(spark: SparkSession, location: str, line_breaks: bool = True) -> DataFrame | None:
    """All records of ``location`` as text columns plus their position; None without files.

    ``line_breaks`` tells whether quoted fields may hold them. Of columns with one name the last one counts.
    Without line breaks a line of nothing but blanks is no record; with them it is a record with one field.
    The number of jobs does not depend on the number of files, and no list of files is made here.
    """
    header = header_line(spark, location)
    if header is None:
        return None
    header = header.removesuffix("\r")
    places = {name: i for i, name in enumerate(next(csv.reader([header]), []))}
    records = (_glued_lines if line_breaks else _single_lines)(spark, location, header)
    parsed = records.select(fields_of(F.col("value")).alias("_fields"), *SEQUENCE)
    return parsed.select(*[F.get("_fields", F.lit(i)).alias(name) for name, i in places.items()], *SEQUENCE)
