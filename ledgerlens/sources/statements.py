"""Bank statement exports (delimited text) to rows under their header.

A statement has a preamble, one header row with a "Narration" cell, body rows
and a footer. Files are read as ordinary splittable text. Line order inside a
file comes from the split offset and the running row id of the scan, so a
large export is read by many tasks, and the header is found by an aggregate
per file.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlens.functions.text import strip
from ledgerlens.operators.sizing import written
from ledgerlens.session import work_folder


def read_statement_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, line_order, line) for every line of every file.

    The result is written to the shared folder once: line numbers depend on
    how the scan was cut into splits, and header and body must see the same cut.
    """
    numbered = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("line_order"),
        F.regexp_replace("value", "\r$", "").alias("line"),
    )
    folder = work_folder(spark, "statement-lines")
    numbered.write.parquet(folder)
    return spark.read.parquet(folder)


def with_cells(lines: DataFrame, delimiter: str = ",") -> DataFrame:
    """Add `cells`: the trimmed cells of each line; quoted cells may hold the delimiter.

    A line has as many cells as it has; a broken line of thousands widens no other.
    """
    mark = re.escape(delimiter)
    # with a delimiter in front every cell has one, so no match is empty
    found = F.regexp_extract_all(F.concat(F.lit(delimiter), "line"), F.lit(f'{mark}("(?:[^"]|"")*"|[^{mark}]*)'), 1)

    def cell(raw: Column) -> Column:
        inner = F.replace(F.substring(raw, F.lit(2), F.greatest(F.char_length(raw) - 2, F.lit(0))), F.lit('""'), F.lit('"'))
        return strip(F.when(raw.rlike('^".*"$'), inner).otherwise(raw))

    return lines.withColumn("cells", F.transform(found, cell))


def statement_rows(lines: DataFrame, delimiter: str = ",") -> DataFrame:
    """(file, line_order, date, narration, withdrawal) of the lines below each file's header.

    The header is the first line with a cell "narration" in any case. Its
    cells give the positions of the other columns; without a date column the
    first cell counts as date. Files without such a header or without a
    withdrawal column yield nothing; `headerless_files` lists them.
    """
    cells = with_cells(lines, delimiter)
    header = written(_headers(cells))
    below = cells.join(header, "file").where((F.col("line_order") > F.col("header_order")) & (F.col("withdrawal_at") > 0))

    def cell(position: str) -> Column:
        return F.get("cells", F.col(position) - 1)

    return below.select(
        "file", "line_order", cell("date_at").alias("date"), cell("narration_at").alias("narration"),
        cell("withdrawal_at").alias("withdrawal"))


def _headers(cells: DataFrame) -> DataFrame:
    lowered = F.transform("cells", lambda c: F.lower(c))
    first = F.min_by(F.struct("line_order", lowered.alias("names")), F.col("line_order"))
    maybe = F.contains(F.lower("line"), F.lit("narration"))
    found = cells.where(maybe & F.array_contains(lowered, "narration")).groupBy("file").agg(first.alias("h"))
    names = F.col("h.names")
    holds = F.transform(names, lambda c: F.contains(c, F.lit("withdrawal")))
    return found.select(
        "file", F.col("h.line_order").alias("header_order"),
        F.array_position(names, "narration").cast("int").alias("narration_at"),
        F.array_position(holds, True).cast("int").alias("withdrawal_at"),
        F.greatest(F.array_position(names, "date").cast("int"), F.lit(1)).alias("date_at"),
    )


def headerless_files(lines: DataFrame, delimiter: str = ",") -> DataFrame:
    """Files without a usable header, with the reason."""
    cells = with_cells(lines, delimiter)
    files = lines.select("file").distinct().join(_headers(cells), "file", "left")
    return files.where("header_order IS NULL OR withdrawal_at = 0").select(
        "file", F.when(F.col("header_order").isNull(), "no narration column").otherwise("no withdrawal column").alias("reason"))
