"""Readers for CSV, JSON lines, baselines, text lines and model inputs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerlens.config import NA_TEXTS, REQUIRED_COLUMNS, SCHEMA_SAMPLE_ROWS
from ledgerlens.functions.numbers import megabytes
from ledgerlens.functions.text import strip
from ledgerlens.operators.profile import non_blank_lines

FEEDBACK_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("predicted_category", T.StringType()),
    T.StructField("actual_category", T.StringType()),
    T.StructField("transaction_id", T.StringType()),
    T.StructField("correct", T.BooleanType()),
    T.StructField("_corrupt_record", T.StringType()),
])
INGEST_BASELINE_SCHEMA = T.StructType([
    T.StructField("total_rows", T.LongType()),
    T.StructField("category_distribution", T.MapType(T.StringType(), T.LongType())),
    T.StructField("description_avg_length", T.DoubleType()),
])
FEATURE_BASELINE_SCHEMA = T.StructType([
    T.StructField("seq_nonzero_mean", T.DoubleType()),
    T.StructField("seq_nonzero_std", T.DoubleType()),
    T.StructField("label_distribution", T.MapType(T.StringType(), T.LongType())),
])


def missing_to_null(text: Column, markers: Sequence[str] = NA_TEXTS) -> Column:
    """Texts that stand for a missing value become null."""
    return F.when(~text.isin(list(markers)), text)


def read_csv(spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None,
             na_markers: Sequence[str] | None = NA_TEXTS, multi_line: bool = False) -> DataFrame:
    """CSV with a header; every column a string, missing markers as null.

    Column names come from the header, and no values are scanned to guess
    types. `columns` prunes the scan. `multi_line` allows line breaks inside
    quotes but makes a file unsplittable.
    """
    df = (
        spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
        .option("inferSchema", False).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    if columns is not None:
        df = df.select(*columns)
    if na_markers is None:
        return df
    return df.select(*[missing_to_null(F.col(f"`{c}`"), na_markers).alias(c) for c in df.columns])


def head_sample(df: DataFrame, rows: int = SCHEMA_SAMPLE_ROWS) -> DataFrame:
    """The first rows, for cheap checks."""
    return df.limit(rows)


def read_feedback(spark: SparkSession, path: str | list[str], fail_fast: bool = False) -> DataFrame:
    """Feedback JSON lines. Blank lines vanish; unreadable ones keep `_corrupt_record`."""
    mode = "FAILFAST" if fail_fast else "PERMISSIVE"
    return spark.read.schema(FEEDBACK_SCHEMA).option("mode", mode).json(path)


def parse_feedback_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Parse JSON text lines; lines that are blank or no JSON object are marked, not dropped."""
    trimmed = strip(F.col(column))
    plain = T.StructType(FEEDBACK_SCHEMA.fields)
    parsed = F.from_json(trimmed, plain, {"columnNameOfCorruptRecord": "_corrupt_record"})
    rows = lines.where(F.length(trimmed) > 0).select(trimmed.alias("_line"), parsed.alias("_p"))
    bad = ~F.startswith("_line", F.lit("{")) | F.col("_p").isNull() | F.col("_p._corrupt_record").isNotNull()
    names = [f.name for f in FEEDBACK_SCHEMA.fields if f.name != "_corrupt_record"]
    return rows.select(*[F.col(f"_p.{n}").alias(n) for n in names], F.when(bad, F.col("_line")).alias("_corrupt_record"))


def corrections(feedback: DataFrame) -> DataFrame:
    """(description, category) from readable feedback with both texts non-blank."""
    good = feedback.where("_corrupt_record IS NULL") if "_corrupt_record" in feedback.columns else feedback
    return good.select(
        strip(F.coalesce("description", F.lit(""))).alias("description"),
        strip(F.coalesce("actual_category", F.lit(""))).alias("category"),
    ).where((F.length("description") > 0) & (F.length("category") > 0))


def read_ingest_baseline(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INGEST_BASELINE_SCHEMA).option("multiLine", True).json(path)


def read_feature_baseline(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FEATURE_BASELINE_SCHEMA).option("multiLine", True).json(path)


def baseline_counts(baseline: DataFrame) -> DataFrame:
    """(category, n) of an ingest baseline."""
    return baseline.select(F.explode("category_distribution").alias("category", "n"))


def baseline_label_counts(baseline: DataFrame) -> DataFrame:
    """(label_idx, n) of a feature baseline."""
    return baseline.select(F.explode("label_distribution").alias("k", "n")).select(F.col("k").cast("int").alias("label_idx"), "n")


def read_descriptions(spark: SparkSession, path: str) -> DataFrame:
    """One description per line, trimmed, blank lines dropped."""
    return non_blank_lines(spark.read.text(path))


def read_features(spark: SparkSession, path: str, split: str) -> DataFrame:
    """Encoded rows of one split; the split prunes partitions."""
    return spark.read.parquet(f"{path}/features").where(F.col("split") == split)


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        return not files.select("path").isEmpty()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in (e.getCondition() or str(e)):
            return False
        raise


def source_size(spark: SparkSession, path: str) -> DataFrame:
    """One row: number of files and megabytes, from file listings only."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length").agg(
        F.count("*").alias("files"), megabytes(F.coalesce(F.sum("length"), F.lit(0))).alias("size_mb"))


def first_source(spark: SparkSession, *paths: str) -> str:
    """The first path that holds files; raise when none does."""
    for path in paths:
        if path_exists(spark, path):
            return path
    raise FileNotFoundError(f"no data at any of {list(paths)}")


def present_sources(spark: SparkSession, readers: dict[str, Callable[[str], DataFrame]],
                    warn: Callable[[str], None] = print) -> list[DataFrame]:
    """Read the sources that exist, warn about the others, fail when none does."""
    found = []
    for path, read in readers.items():
        if path_exists(spark, path):
            found.append(read(path))
        else:
            warn(f"source not found: {path}")
    if not found:
        raise FileNotFoundError("no data sources found")
    return found


def sample_columns(spark: SparkSession, path: str, required: Sequence[str] = REQUIRED_COLUMNS) -> list[str]:
    """Column names of a CSV source, checked against the required ones."""
    names = read_csv(spark, path, na_markers=None).columns
    missing = sorted(set(required) - set(names))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return names
