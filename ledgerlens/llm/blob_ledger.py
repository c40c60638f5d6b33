"""Secret scanning with an incremental ledger of blobs.

Every historical version of a file is a blob, addressed by the SHA-256 of its
text. The ledger records which (blob, rule, rule version) triples were scanned and
the spans found. A run scans only triples the ledger lacks, appends them, and
joins the findings of the ledger back to every path that carries the blob. A new
version of a rule is a new triple for every blob; other rules are not run again.

Spans are code points, end exclusive. They come from built-in expressions: the
pieces between matches (`split`) and the matches themselves (`regexp_extract_all`)
give the position of each match as a running sum of lengths.

Null texts count as empty. A null path is a path of its own. Repeated rows and
copies share one scan. An empty table gives an empty result and leaves the ledger
as it was. Only the named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.sizing import written

LEDGER = "blob binary, rule string, version int, spans array<struct<start:int,rank:int,end:int,kind:string>>"


@dataclass(frozen=True)
class Rule:
    """A pattern whose match counts if `group` of it has `least` characters.

    `only_if` is a cheaper pattern that every text with a counting match also
    matches.
    """
    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    only_if: str | None = None
    version: int = 1


_KEY = r"""(?i:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
# A run of 32 or more hex digits is a greedy run of any length that is long enough,
# and likewise for access keys; only `assign` must see short matches, which use up text.
RULES = (
    Rule("assign", _KEY + "([A-Za-z0-9+/_.=-]+)", 1, 8, _KEY + "[A-Za-z0-9+/_.=-]{8}"),
    Rule("access", "AKIA[A-Z0-9]{12,}"),
    Rule("hex", "[0-9a-f]{32,}"),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)


def spans(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of a rule as an array of (start, rank, end, kind), leftmost first."""
    regex = F.lit(rule.pattern)
    found = F.arrays_zip(
        F.transform(F.split(text, rule.pattern, -1), F.char_length).alias("gap"),
        F.transform(F.regexp_extract_all(text, regex, F.lit(0)), F.char_length).alias("all"),
        F.transform(F.regexp_extract_all(text, regex, F.lit(rule.group)), F.char_length).alias("part"))
    shape = "struct<upto:int,out:array<struct<start:int,rank:int,end:int,kind:string>>>"

    def step(so_far: Column, hit: Column) -> Column:
        start = so_far["upto"] + hit["gap"]
        end = start + F.coalesce(hit["all"], F.lit(0))
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        kept = F.when(hit["part"] >= rule.least, F.array_append(so_far["out"], span)).otherwise(so_far["out"])
        return F.struct(end.alias("upto"), kept.alias("out")).cast(shape)

    empty = F.struct(F.lit(0).alias("upto"), F.array().alias("out")).cast(shape)
    none = empty["out"]
    return F.when(text.rlike(rule.only_if or rule.pattern), F.aggregate(found, empty, step)["out"]).otherwise(none)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(ledger)


def create_ledger(spark: SparkSession, ledger: str) -> None:
    none = spark.range(0).select(F.from_json(F.lit("{}"), LEDGER).alias("row")).select("row.*")
    none.write.mode("ignore").parquet(ledger)


def _blob(text: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))


def scan(docs: DataFrame, ledger: str, path_col: str = "doc_id", text_col: str = "text",
         rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per input row: path, blob and its sorted spans; the ledger gains what was unseen."""
    spark = docs.sparkSession
    create_ledger(spark, ledger)
    heads = written(docs.select(F.col(path_col).alias("path"), _blob(text_col).alias("blob")), "blob-heads")

    asked = F.array(*[F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version")) for r in rules])
    unseen = (
        heads.groupBy("blob").agg(F.min("path").alias("path"))
        .select("blob", "path", F.inline(asked))
        .join(read_ledger(spark, ledger).select("blob", "rule", "version"), ["blob", "rule", "version"], "left_anti")
        .groupBy("blob", "path").agg(F.collect_set("rule").alias("todo")))

    texts = docs.select(F.col(path_col).alias("p"), _blob(text_col).alias("b"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    todo = unseen.hint("shuffle_hash")
    scanned = texts.join(todo, F.col("p").eqNullSafe(F.col("path")) & (F.col("b") == F.col("blob")))
    per_rule = [
        F.when(F.array_contains("todo", r.kind), F.struct(
            F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version"),
            spans(F.col("text"), r, rank).alias("spans")))
        for rank, r in enumerate(rules)]
    found = (
        scanned.select("blob", F.inline(F.filter(F.array(*per_rule), lambda x: x.isNotNull())))
        .dropDuplicates(["blob", "rule", "version"]))
    found.write.mode("append").parquet(ledger)

    current = reduce(lambda a, b: a | b, [(F.col("rule") == r.kind) & (F.col("version") == r.version) for r in rules])
    findings = (
        read_ledger(spark, ledger).where(current & (F.size("spans") > 0))
        .groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans")))
    return heads.join(findings, "blob", "left").select(
        F.col("path").alias(path_col), "blob",
        F.coalesce("spans", F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")).alias("spans"))


def span_text(found: Column) -> Column:
    """`kind:start:end`, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def mask(text: Column, found: Column, sign: str = "[secret]") -> Column:
    """The text with every span replaced by `sign`; spans that overlap become one."""
    def step(so_far: Column, span: Column) -> Column:
        gap = F.substring(text, so_far["upto"] + 1, F.greatest(span["start"] - so_far["upto"], F.lit(0)))
        inside = span["start"] < so_far["upto"]
        return F.struct(
            F.greatest(so_far["upto"], span["end"]).alias("upto"),
            F.when(inside, so_far["out"]).otherwise(F.concat(so_far["out"], gap, F.lit(sign))).alias("out"))

    def end(so_far: Column) -> Column:
        return F.concat(so_far["out"], F.substring(text, so_far["upto"] + 1, F.char_length(text)))

    begin = F.struct(F.lit(0).alias("upto"), F.lit("").alias("out"))
    return F.when(F.size(found) > 0, F.aggregate(found, begin, step, end)).otherwise(text)
