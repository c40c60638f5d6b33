"""The test tables seen as the library's domain tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ledgerlens.catalog.registry import Tables
from ledgerlens.session import work_folder
from ledgerlens.sources.statements import read_statement_lines

ALLOWED = ("de", "en", "fr")
ALLOWED_SQL = "('de', 'en', 'fr')"

TX = "tx AS (SELECT doc_id AS row_id, text AS description, lang AS category, source, n_chars FROM documents)"


def transactions(t: Tables) -> DataFrame:
    return t.documents.select(
        F.col("doc_id").alias("row_id"), F.col("text").alias("description"), F.col("lang").alias("category"), "source", "n_chars")


DIRTY = """dirty AS (
  SELECT doc_id AS row_id,
         CASE WHEN doc_id % 17 = 0 THEN NULL ELSE text END AS description,
         CASE WHEN doc_id % 23 = 0 THEN NULL ELSE lang END AS category,
         source, n_chars
  FROM documents)"""


def dirty_transactions(t: Tables) -> DataFrame:
    """The same rows with missing values put in."""
    return transactions(t).withColumns({
        "description": F.when(F.col("row_id") % 17 != 0, F.col("description")),
        "category": F.when(F.col("row_id") % 23 != 0, F.col("category")),
    })


CLEAN = f"""{DIRTY},
clean AS (
  SELECT min(row_id) AS row_id, description, category FROM dirty
  WHERE description IS NOT NULL AND category IN {ALLOWED_SQL}
  GROUP BY description, category)"""

SHORT = """short_tx AS (
  SELECT p_partkey AS row_id, p_name || ' ' || p_brand AS description, p_type AS category, p_retailprice AS amount
  FROM part)"""


def short_transactions(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("row_id"), F.concat_ws(" ", "p_name", "p_brand").alias("description"),
        F.col("p_type").alias("category"), F.col("p_retailprice").alias("amount"))


GUESSED = """guessed AS (
  SELECT doc_id AS row_id, lang AS actual,
         CASE WHEN contains(text, 'ß') OR contains(text, 'ü') THEN 'de'
              WHEN contains(text, 'ñ') OR contains(text, 'ó') THEN 'es'
              WHEN contains(text, 'ç') OR contains(text, 'è') THEN 'fr'
              ELSE 'en' END AS predicted
  FROM documents)"""


def guessed_language(t: Tables) -> DataFrame:
    """Actual language and one guessed from single letters."""
    def has(*letters):
        return F.contains("text", F.lit(letters[0])) | F.contains("text", F.lit(letters[1]))

    return t.documents.select(
        F.col("doc_id").alias("row_id"), F.col("lang").alias("actual"),
        F.when(has("ß", "ü"), "de").when(has("ñ", "ó"), "es").when(has("ç", "è"), "fr").otherwise("en").alias("predicted"))


FEEDBACK = """feedback AS (
  SELECT event_id, ts, props AS description,
         CASE WHEN value >= 300 THEN '' WHEN value < 50 THEN 'view' ELSE event_type END AS predicted_category,
         CASE WHEN value >= 30 THEN '' ELSE event_type END AS actual_category
  FROM events)"""


def feedback(t: Tables) -> DataFrame:
    value = F.col("value")
    return t.events.select(
        "event_id", "ts", F.col("props").alias("description"),
        F.when(value >= 300, "").when(value < 50, "view").otherwise(F.col("event_type")).alias("predicted_category"),
        F.when(value >= 30, "").otherwise(F.col("event_type")).alias("actual_category"))


# index 99 stands for a label that no longer exists
LABEL_BASE = """event_labels AS (
  SELECT CAST(row_number() OVER (ORDER BY category) - 1 AS INT) AS label_idx, category
  FROM (SELECT DISTINCT event_type AS category FROM events)),
label_base AS (
  SELECT CASE WHEN l.category = 'error' THEN 99 ELSE l.label_idx END AS label_idx,
         CAST(sum(round(e.value * 100)) AS BIGINT) AS n
  FROM events e JOIN event_labels l ON e.event_type = l.category GROUP BY 1)"""


def event_labels(t: Tables) -> DataFrame:
    from ledgerlens.operators.labels import label_index

    return label_index(t.events.withColumnRenamed("event_type", "category"))


def label_baseline(t: Tables, labels: DataFrame) -> DataFrame:
    """Baseline counts by label index, one of them undecodable."""
    counts = t.events.groupBy(F.col("event_type").alias("category")).agg(
        F.sum(F.round(F.col("value") * 100).cast("long")).alias("n"))
    return counts.join(labels, "category").select(
        F.when(F.col("category") == "error", 99).otherwise(F.col("label_idx")).alias("label_idx"), "n")


REQUESTS = """requests AS (
  SELECT event_id, ts, user_id, event_type,
         CASE event_type WHEN 'click' THEN '/predict/batch' WHEN 'signup' THEN '/feedback' ELSE '/predict' END AS endpoint,
         CASE WHEN event_type = 'error' AND value > 100 THEN '500' ELSE '200' END AS status,
         NOT (event_type = 'error' AND value > 100) AS ok,
         value / 100.0 AS latency_s, floor(value) AS batch_size,
         event_type = 'signup' AS is_feedback,
         event_type = 'purchase' AND value > 40 AS is_switch
  FROM events)"""


def request_columns(events: DataFrame) -> DataFrame:
    """Request log columns; works on a batch or a streaming events table."""
    kind, value = F.col("event_type"), F.col("value")
    failed = (kind == "error") & (value > 100)
    return events.select(
        "event_id", "ts", "user_id", "event_type",
        F.when(kind == "click", "/predict/batch").when(kind == "signup", "/feedback").otherwise("/predict").alias("endpoint"),
        F.when(failed, "500").otherwise("200").alias("status"),
        (~failed).alias("ok"),
        (value / 100.0).alias("latency_s"), F.floor(value).cast("double").alias("batch_size"),
        (kind == "signup").alias("is_feedback"),
        ((kind == "purchase") & (value > 40)).alias("is_switch"))


def requests(t: Tables) -> DataFrame:
    return request_columns(t.events)


PUSHES = """pushes AS (
  SELECT event_id, ts, 'job' || (user_id % 5) AS job, event_id // 10 AS push_id,
         CASE WHEN event_type = 'error' AND value >= 120 THEN 'pipeline_drift_detected'
              WHEN event_type = 'error' THEN 'model_loaded'
              WHEN event_type = 'view' AND value >= 120 THEN 'pipeline_ingest_success'
              WHEN event_type = 'view' THEN 'up'
              WHEN event_type = 'purchase' THEN 'test_f1_macro'
              WHEN event_type = 'click' THEN 'training_val_f1'
              ELSE 'training_duration_seconds' END AS metric,
         CASE WHEN event_type = 'error' AND value >= 120 THEN CAST(value >= 150 AS INT)
              WHEN event_type = 'error' THEN CAST(value >= 5 AS INT)
              WHEN event_type = 'view' AND value >= 120 THEN CAST(value >= 130 AS INT)
              WHEN event_type = 'view' THEN CAST(value >= 1 AS INT)
              WHEN event_type = 'purchase' THEN 1 - value / 200
              WHEN event_type = 'click' THEN 1 - value / 200
              ELSE value * 100 END AS value
  FROM events)"""


def push_columns(events: DataFrame) -> DataFrame:
    kind, value = F.col("event_type"), F.col("value")
    high = value >= 120

    def one_if(cond):
        return cond.cast("int").cast("double")

    metric = (
        F.when((kind == "error") & high, "pipeline_drift_detected").when(kind == "error", "model_loaded")
        .when((kind == "view") & high, "pipeline_ingest_success").when(kind == "view", "up")
        .when(kind == "purchase", "test_f1_macro").when(kind == "click", "training_val_f1")
        .otherwise("training_duration_seconds"))
    shown = (
        F.when((kind == "error") & high, one_if(value >= 150)).when(kind == "error", one_if(value >= 5))
        .when((kind == "view") & high, one_if(value >= 130)).when(kind == "view", one_if(value >= 1))
        .when(kind.isin("purchase", "click"), 1 - value / 200).otherwise(value * 100))
    return events.select(
        "event_id", "ts", F.concat(F.lit("job"), (F.col("user_id") % 5).cast("string")).alias("job"),
        F.expr("event_id div 10").alias("push_id"), metric.alias("metric"), shown.alias("value"))


def pushes(t: Tables) -> DataFrame:
    return push_columns(t.events)


# the modulus makes each counter restart now and then
SAMPLES = """samples AS (
  SELECT event_id AS sample_id, ts, event_type AS series, CAST(floor(value) AS DOUBLE) AS value FROM events)"""


def counter_columns(events: DataFrame) -> DataFrame:
    """Samples of one counter per event type; every drop is a restart. Works on a batch or a streaming events table."""
    return events.select(
        F.col("event_id").alias("sample_id"), "ts", F.col("event_type").alias("series"),
        F.floor("value").cast("double").alias("value"))


def counter_samples(t: Tables) -> DataFrame:
    return counter_columns(t.events)


RUNS = """runs AS (
  SELECT o_orderkey AS run_id, o_orderpriority AS run_name, o_orderstatus AS status, o_orderdate AS start_time,
         o_totalprice AS metric FROM orders)"""


def runs(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("run_id"), F.col("o_orderpriority").alias("run_name"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("start_time"),
        F.col("o_totalprice").alias("metric"))


HISTORY = """history AS (
  SELECT l_orderkey AS run_id,
         CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS INT) AS epoch,
         l_discount * 10 AS val_f1, l_tax AS loss, CAST(l_quantity AS BIGINT) AS n
  FROM lineitem)"""


def history(t: Tables) -> DataFrame:
    """Epoch history per run: the lines of an order, at most seven, numbered."""
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    return t.lineitem.select(
        F.col("l_orderkey").alias("run_id"), F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*order)).alias("epoch"),
        (F.col("l_discount") * 10).alias("val_f1"), F.col("l_tax").alias("loss"), F.col("l_quantity").cast("long").alias("n"))


STATEMENT_HEADER = "Date,Narration,Chq./Ref.No.,Value Dt,Withdrawal Amt.,Deposit Amt.,Closing Balance"

STATEMENT = """body AS (
  SELECT o_orderkey, o_orderpriority AS file,
         CASE WHEN o_orderkey % 50 = 7 THEN 'B/F' ELSE strftime(o_orderdate, '%d/%m/%y') END AS date,
         CASE o_orderkey % 5 WHEN 0 THEN 'UPI/ZOMATO/' || o_custkey || '/Food Order'
                             WHEN 1 THEN '  neft salary   ' || o_custkey
                             WHEN 2 THEN 'TOLL PLAZA ' || o_orderstatus
                             WHEN 3 THEN '123/45 SHOP  ' || o_custkey
                             ELSE 'UPI' END AS narration,
         CASE WHEN o_orderstatus = 'P' THEN '' WHEN o_orderkey % 11 = 3 THEN '1,200.00'
              ELSE CAST(o_totalprice AS VARCHAR) END AS withdrawal
  FROM orders),
debits AS (
  SELECT o_orderkey AS row_id, file,
         CASE o_orderkey % 5 WHEN 0 THEN replace(narration, 'UPI/', '')
                             WHEN 1 THEN regexp_replace(trim(narration), '^neft salary\\s+', 'salary ')
                             WHEN 2 THEN replace(narration, 'TOLL', 'LL')
                             WHEN 3 THEN regexp_replace(narration, '^123/45 SHOP\\s+', 'SHOP ')
                             ELSE narration END AS description,
         TRY_CAST(withdrawal AS DOUBLE) AS amount
  FROM body
  WHERE regexp_matches(date, '^\\d{1,2}/\\d{1,2}/\\d{2,4}$') AND TRY_CAST(withdrawal AS DOUBLE) IS NOT NULL)"""


def statement_lines(t: Tables) -> DataFrame:
    """Statement exports made of the orders, one file per priority: title, header, body, footer."""
    key = F.col("o_orderkey")
    narration = (
        F.when(key % 5 == 0, F.concat(F.lit("UPI/ZOMATO/"), "o_custkey", F.lit("/Food Order")))
        .when(key % 5 == 1, F.concat(F.lit("  neft salary   "), "o_custkey"))
        .when(key % 5 == 2, F.concat(F.lit("TOLL PLAZA "), "o_orderstatus"))
        .when(key % 5 == 3, F.concat(F.lit("123/45 SHOP  "), "o_custkey"))
        .otherwise("UPI"))
    date = F.when(key % 50 == 7, "B/F").otherwise(F.date_format("o_orderdate", "dd/MM/yy"))
    withdrawal = (
        F.when(F.col("o_orderstatus") == "P", "").when(key % 11 == 3, '"1,200.00"')
        .otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")))
    body = t.orders.select(
        F.col("o_orderpriority").alias("file"), (key + 10).alias("line_order"),
        F.concat_ws(",", date, F.concat(F.lit('"'), narration, F.lit('"')), key.cast("string"), date, withdrawal, F.lit(""), F.lit("0.00")).alias("line"))
    frame = t.orders.select(F.col("o_orderpriority").alias("file")).distinct()

    def extra(order: int, text: str) -> DataFrame:
        return frame.select("file", F.lit(order).cast("long").alias("line_order"), F.lit(text).alias("line"))

    return (
        body.unionByName(extra(1, "Statement of account,,,,,,"))
        .unionByName(extra(2, '01/01/20,"before the header",,,5.00,,'))
        .unionByName(extra(3, STATEMENT_HEADER))
        .unionByName(extra(1 << 60, "Total,,,,99.00,,")))


def exported_lines(t: Tables) -> DataFrame:
    """The statement exports as text files, read back; `file` is the priority again."""
    folder = work_folder(t.spark, "exports")
    lines = statement_lines(t).repartition("file").sortWithinPartitions("file", "line_order")
    lines.select("file", F.col("line").alias("value")).write.partitionBy("file").text(folder)
    name = F.url_decode(F.regexp_extract("file", "file=([^/]+)", 1))
    return read_statement_lines(t.spark, folder).withColumn("file", name)


EVENT_SYMBOLS = {"click": "+", "error": "!", "view": "o"}
EVENT_SYMBOLS_SQL = "WHEN 'click' THEN '+' WHEN 'error' THEN '!' WHEN 'view' THEN 'o'"
