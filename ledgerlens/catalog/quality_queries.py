"""Scans, validation, filters, joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.catalog.bindings import (
    ALLOWED, ALLOWED_SQL, CLEAN, DIRTY, FEEDBACK, GUESSED, SHORT, TX, dirty_transactions, feedback,
    guessed_language, runs, short_transactions, transactions, EVENT_SYMBOLS, EVENT_SYMBOLS_SQL,
)
from ledgerlens.catalog.registry import query
from ledgerlens.functions import numbers, text as tx
from ledgerlens.operators import drift, evaluation, profile, quality
from ledgerlens.plans.ingest import clean_transactions


@query("pruned_scan", "S2", "SELECT doc_id AS row_id, lang AS category FROM documents")
def pruned_scan(t):
    return transactions(t).select("row_id", "category")


@query("head_scan", "S3", f"""
WITH {TX} SELECT least(1000, count(*)) AS n, least(1000, count(*)) AS n_ids, least(1000, count(*)) AS n_in_table FROM tx""")
def head_scan(t):
    """Which rows a head scan takes is open; how many, and that they are different rows of the table, is not."""
    from ledgerlens.sources.files import head_sample

    rows = transactions(t).select("row_id", "category")
    head = head_sample(rows).withColumn("mine", F.lit(1))
    found = head.join(rows, ["row_id", "category"], "left_semi").agg(F.count("*")).scalar()
    return head.agg(F.count("*").alias("n"), F.countDistinct("row_id").alias("n_ids")).withColumn("n_in_table", found)


@query("sizes_in_megabytes", "F19", """
SELECT doc_id AS row_id, round_even(strlen(text) * 1000 / 1048576::DOUBLE, 1) AS size_mb FROM documents""")
def sizes_in_megabytes(t):
    """Bytes as megabytes with one digit, for a thousand copies of each text."""
    from ledgerlens.functions.numbers import megabytes

    return t.documents.select(F.col("doc_id").alias("row_id"), megabytes(F.octet_length("text") * 1000).alias("size_mb"))


@query("description_lines", "S7, P6, F4", r"""
SELECT regexp_replace(line, '^\s+|\s+$', '', 'g') AS description, count(*) AS n
FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
WHERE regexp_replace(line, '^\s+|\s+$', '', 'g') <> '' GROUP BY 1""")
def description_lines(t):
    lines = t.documents.select(F.explode(F.split("text", "\n")).alias("value"))
    return profile.non_blank_lines(lines).groupBy("description").agg(F.count("*").alias("n"))


@query("null_counts", "P3", f"""
WITH {DIRTY}
SELECT 'description' AS column_name, count(*) FILTER (WHERE description IS NULL) AS nulls FROM dirty
UNION ALL SELECT 'category', count(*) FILTER (WHERE category IS NULL) FROM dirty
UNION ALL SELECT 'total', count(*) FILTER (WHERE description IS NULL) + count(*) FILTER (WHERE category IS NULL) FROM dirty""")
def null_counts(t):
    return quality.null_counts(dirty_transactions(t))


@query("drop_null_rows", "P4", f"""
WITH {DIRTY} SELECT row_id, category, length(description) AS chars FROM dirty
WHERE description IS NOT NULL AND category IS NOT NULL""")
def drop_null_rows(t):
    return quality.drop_nulls(dirty_transactions(t)).select("row_id", "category", F.length("description").cast("long").alias("chars"))


@query("allowed_categories", "P5", f"WITH {TX} SELECT row_id, category FROM tx WHERE category IN {ALLOWED_SQL}")
def allowed_categories(t):
    return quality.keep_allowed(transactions(t).select("row_id", "category"), ALLOWED)


@query("allowed_by_table", "J2", """
SELECT doc_id AS row_id, lang AS category FROM documents d
WHERE EXISTS (SELECT 1 FROM labels l JOIN documents x USING (doc_id) WHERE l.toxic = 1 AND x.source = d.source)""")
def allowed_by_table(t):
    domain = t.labels.where("toxic = 1").join(t.documents.select("doc_id", "source"), "doc_id").select("source").distinct()
    rows = t.documents.select(F.col("doc_id").alias("row_id"), F.col("lang").alias("category"), "source")
    return quality.keep_allowed(rows, domain, "source").select("row_id", "category")


@query("unknown_categories", "P5, U3", f"""
WITH {TX} SELECT category FROM tx EXCEPT SELECT unnest(['de', 'en', 'fr'])""")
def unknown_categories(t):
    return quality.unknown_labels(transactions(t), ALLOWED)


@query("non_blank_rows", "P6", r"""
WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT doc_id, count(*) AS n FROM lines WHERE regexp_replace(line, '^\s+|\s+$', '', 'g') <> '' GROUP BY doc_id""")
def non_blank_rows(t):
    lines = t.documents.select("doc_id", F.explode(F.split("text", "\n")).alias("description"))
    return quality.drop_blank(lines).groupBy("doc_id").agg(F.count("*").alias("n"))


@query("payload_check", "P12", f"""
WITH {TX}, marked AS (
  SELECT row_id, CASE WHEN description IS NULL THEN 'description_missing' WHEN length(description) = 0 THEN 'description_empty'
                      WHEN length(description) > 500 THEN 'description_too_long' ELSE 'valid' END AS reason FROM tx)
SELECT reason, count(*) AS n FROM marked GROUP BY reason""")
def payload_check(t):
    valid, rejected = quality.split_valid(transactions(t).select("row_id", "description"), quality.single_rules())
    return (
        rejected.select(F.get("reasons", F.lit(0)).alias("reason"))
        .unionByName(valid.select(F.lit("valid").alias("reason")))
        .groupBy("reason").agg(F.count("*").alias("n")))


@query("feedback_payload_check", "P12", f"""
WITH {FEEDBACK}, reasons AS (
  SELECT CASE WHEN description IS NULL THEN 'description_missing' END AS r FROM feedback
  UNION ALL SELECT CASE WHEN length(description) = 0 THEN 'description_empty' END FROM feedback
  UNION ALL SELECT CASE WHEN length(description) > 500 THEN 'description_too_long' END FROM feedback
  UNION ALL SELECT CASE WHEN predicted_category = '' THEN 'predicted_category_empty' END FROM feedback
  UNION ALL SELECT CASE WHEN actual_category = '' THEN 'actual_category_empty' END FROM feedback)
SELECT r AS reason, count(*) AS n FROM reasons WHERE r IS NOT NULL GROUP BY r""")
def feedback_payload_check(t):
    _, rejected = quality.split_valid(feedback(t), quality.feedback_rules())
    return rejected.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query("label_fallback", "P13", f"""
WITH {FEEDBACK}
SELECT event_id, coalesce(nullif(actual_category, ''), nullif(predicted_category, '')) AS label FROM feedback
WHERE coalesce(nullif(actual_category, ''), nullif(predicted_category, '')) IS NOT NULL""")
def label_fallback(t):
    return profile.label_fallback(feedback(t)).select("event_id", "label")


@query("correct_flag", "P14", f"WITH {FEEDBACK} SELECT event_id, predicted_category = actual_category AS correct FROM feedback")
def correct_flag(t):
    return feedback(t).select("event_id", (F.col("predicted_category") == F.col("actual_category")).alias("correct"))


@query("tagged_union", "P15, U1", f"""
WITH {TX}, {SHORT}
SELECT split, category, n, amount FROM (
  SELECT 'documents' AS split, category, count(*) AS n, CAST(NULL AS DOUBLE) AS amount FROM tx GROUP BY category
  UNION ALL SELECT 'parts', category, count(*), max(amount) FROM short_tx GROUP BY category)""")
def tagged_union(t):
    long = transactions(t).select("category").withColumn("split", F.lit("documents"))
    short = short_transactions(t).select("category", "amount").withColumn("split", F.lit("parts"))
    return long.unionByName(short, allowMissingColumns=True).groupBy("split", "category").agg(
        F.count("*").alias("n"), F.max("amount").alias("amount"))


@query("renamed_counts", "P16", f'WITH {TX} SELECT category AS "Category", count(*) AS "Count" FROM tx GROUP BY category')
def renamed_counts(t):
    return profile.value_counts(transactions(t)).withColumnsRenamed({"category": "Category", "n": "Count"})


@query("filled_descriptions", "P17", f"WITH {DIRTY} SELECT row_id, length(coalesce(description, '')) AS chars FROM dirty")
def filled_descriptions(t):
    return dirty_transactions(t).na.fill("", ["description"]).select("row_id", F.length("description").cast("long").alias("chars"))


@query("metric_cleanup", "P19", """
SELECT run_id, CASE WHEN NOT isnan(TRY_CAST(metric AS DOUBLE)) THEN TRY_CAST(metric AS DOUBLE) END AS metric FROM (
  SELECT o_orderkey AS run_id, CASE WHEN o_orderstatus = 'P' THEN 'NaN' WHEN o_orderpriority = '5-LOW' THEN 'pending'
                               ELSE CAST(o_totalprice AS VARCHAR) END AS metric FROM orders)""")
def metric_cleanup(t):
    from ledgerlens.operators.runs import clean_metrics

    raw = F.when(F.col("status") == "P", "NaN").when(F.col("run_name") == "5-LOW", "pending").otherwise(F.col("metric").cast("string"))
    return clean_metrics(runs(t).select("run_id", raw.alias("metric")), ["metric"])


@query("confidence_bands", "P21", """
SELECT CASE WHEN c >= 0.9 THEN 'very high' WHEN c >= 0.7 THEN 'high' WHEN c >= 0.5 THEN 'moderate' ELSE 'low' END AS band, count(*) AS n
FROM (SELECT l_discount * 10 AS c FROM lineitem) GROUP BY 1""")
def confidence_bands(t):
    return t.lineitem.select(numbers.confidence_band(F.col("l_discount") * 10).alias("band")).groupBy("band").agg(F.count("*").alias("n"))


@query("display_symbols", "P22", f"""
SELECT CASE event_type {EVENT_SYMBOLS_SQL} ELSE '?' END AS symbol, count(*) AS n FROM events GROUP BY 1""")
def display_symbols(t):
    return t.events.select(numbers.map_text(F.col("event_type"), EVENT_SYMBOLS, "?").alias("symbol")).groupBy("symbol").agg(F.count("*").alias("n"))


@query("metric_lines", "P23", """
WITH lines AS (
  SELECT event_id, CASE WHEN event_type = 'view' THEN '# HELP ' ELSE '' END || event_type || '_total{user="' || user_id || '"} ' || event_id AS value FROM events)
SELECT event_id, value FROM lines
WHERE NOT starts_with(value, '#') AND (contains(value, 'click_total') OR contains(value, 'view_total') OR contains(value, 'error_total'))
ORDER BY event_id LIMIT 40""")
def metric_lines(t):
    from ledgerlens.operators.telemetry import metric_lines as pick

    head = F.when(F.col("event_type") == "view", "# HELP ").otherwise("")
    value = F.concat(head, "event_type", F.lit('_total{user="'), "user_id", F.lit('"} '), "event_id")
    return pick(t.events.select("event_id", value.alias("value")), ["click_total", "view_total", "error_total"], order="event_id")


# --- Joins and sets ---------------------------------------------------------
@query("share_outer_join", "J1, U4", """
WITH base AS (SELECT p_brand AS category, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share FROM part WHERE p_size <= 25 GROUP BY 1),
     cur AS (SELECT p_brand AS category, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share FROM part WHERE p_retailprice >= 950 GROUP BY 1)
SELECT coalesce(b.category, c.category) AS category, coalesce(b.share, 0) AS baseline, coalesce(c.share, 0) AS current,
       abs(coalesce(c.share, 0) - coalesce(b.share, 0)) AS shift, abs(coalesce(c.share, 0) - coalesce(b.share, 0)) > 0.10 AS flagged
FROM base b FULL JOIN cur c ON b.category = c.category""")
def share_outer_join(t):
    brands = t.part.withColumnRenamed("p_brand", "category")
    return drift.compare_shares(
        profile.value_shares(brands.where("p_size <= 25")), profile.value_shares(brands.where("p_retailprice >= 950")))


@query("rows_outside_top", "J3", f"""
WITH {TX}, top AS (SELECT category FROM tx GROUP BY category ORDER BY count(*) DESC, category LIMIT 3)
SELECT row_id, category FROM tx WHERE category NOT IN (SELECT category FROM top)""")
def rows_outside_top(t):
    rows = transactions(t).select("row_id", "category")
    return rows.join(profile.top_values(rows).select("category"), "category", "left_anti").select("row_id", "category")


@query("unlabelled_rows", "J3", "SELECT doc_id AS row_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def unlabelled_rows(t):
    from ledgerlens.operators.sampling import rest_by_id

    return rest_by_id(transactions(t).select("row_id"), t.labels.select(F.col("doc_id").alias("row_id")), "row_id")


@query("duplicate_first", "W4, U2", f"WITH {CLEAN} SELECT row_id, category FROM clean")
def duplicate_first(t):
    rows = quality.keep_allowed(quality.drop_nulls(dirty_transactions(t)), ALLOWED)
    return quality.dedup_first(rows, ["description", "category"], "row_id").select("row_id", "category")


@query("duplicate_groups", "U2", f"""
WITH {TX} SELECT category, count(*) AS n FROM (SELECT DISTINCT description, category FROM tx) GROUP BY category""")
def duplicate_groups(t):
    return profile.value_counts(quality.dedup_any(transactions(t), ["description", "category"]))


@query("label_union", "U4", """
SELECT event_type AS category FROM events UNION SELECT lang FROM documents""")
def label_union(t):
    return drift.label_union(t.events.withColumnRenamed("event_type", "category"), t.documents.withColumnRenamed("lang", "category"))


@query("preview_rows", "O1", f"WITH {TX} SELECT row_id, category FROM tx ORDER BY row_id LIMIT 10")
def preview_rows(t):
    return transactions(t).select("row_id", "category").orderBy("row_id").limit(10)


# --- Counts and profiles ----------------------------------------------------
@query("row_count", "A1", "SELECT count(*) AS n FROM lineitem")
def row_count(t):
    return profile.row_count(t.lineitem)


@query("category_counts", "A2", f"WITH {DIRTY} SELECT category, count(*) AS n FROM dirty WHERE category IS NOT NULL GROUP BY category")
def category_counts(t):
    return profile.value_counts(dirty_transactions(t))


@query("category_shares", "A3, A26", f"""
WITH {DIRTY} SELECT category, count(*) AS n, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share
FROM dirty WHERE category IS NOT NULL GROUP BY category""")
def category_shares(t):
    return profile.value_shares(dirty_transactions(t))


@query("mean_description_length", "A4, F5", f"WITH {TX} SELECT avg(length(description)) AS description_avg_length FROM tx")
def mean_description_length(t):
    return profile.mean_length(transactions(t))


@query("baseline_profile", "A5, S5", f"""
WITH {CLEAN}, total AS (SELECT count(*) AS total_rows, avg(length(description)) AS avg_length FROM clean)
SELECT category, count(*) AS n, max(total_rows) AS total_rows, max(avg_length) AS description_avg_length
FROM clean, total GROUP BY category""")
def baseline_profile(t):
    stats = profile.baseline_profile(clean_transactions(dirty_transactions(t), ALLOWED, "row_id"))
    return stats.select(F.explode("category_distribution").alias("category", "n"), "total_rows", "description_avg_length")


@query("distinct_categories", "A6", f"WITH {TX} SELECT DISTINCT category FROM tx")
def distinct_categories(t):
    return profile.distinct_values(transactions(t))


@query("top_categories", "W1", f"""
WITH {TX} SELECT category, count(*) AS n FROM tx GROUP BY category ORDER BY n DESC, category LIMIT 3""")
def top_categories(t):
    return profile.top_values(transactions(t))


@query("cleanup_funnel", "A22", f"""
WITH {CLEAN}
SELECT (SELECT count(*) FROM dirty) AS original,
       (SELECT count(*) FROM dirty WHERE description IS NULL OR category IS NULL) AS removed_null,
       (SELECT count(*) FROM dirty WHERE description IS NOT NULL AND category NOT IN {ALLOWED_SQL}) AS removed_unknown,
       (SELECT count(*) FROM dirty WHERE description IS NOT NULL AND category IN {ALLOWED_SQL}) - (SELECT count(*) FROM clean) AS removed_duplicate,
       (SELECT count(*) FROM clean) AS retained,
       (SELECT count(*) FROM dirty) - (SELECT count(*) FROM clean) AS removed""")
def cleanup_funnel(t):
    return quality.cleanup_funnel(dirty_transactions(t), ALLOWED)


@query("length_histogram", "A23", """
WITH l AS (SELECT lang AS split, length(text) AS len FROM documents),
     e AS (SELECT min(len) AS lo, max(len) AS hi FROM l)
SELECT split, CAST(least(floor((len - lo) / greatest((hi - lo) / 40.0::DOUBLE, 1e-9::DOUBLE)), 39) AS INT) AS bin, count(*) AS n
FROM l, e GROUP BY 1, 2""")
def length_histogram(t):
    return profile.length_histogram(t.documents.select(F.col("lang").alias("split"), F.col("text").alias("description")))


@query("clean_rows", "D7, P1, P7", f"WITH {CLEAN} SELECT row_id, category, length(description) AS chars FROM clean")
def clean_rows(t):
    kept = clean_transactions(dirty_transactions(t), ALLOWED, "row_id")
    return kept.select("row_id", "category", F.length("description").cast("long").alias("chars"))


# --- Scalar functions -------------------------------------------------------
@query("round_half_even", "F7", """
SELECT l_orderkey, l_linenumber, round_even(l_quantity / 2, 0) AS half, round_even(l_quantity / 8, 2) AS eighth FROM lineitem""")
def round_half_even(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", numbers.half_even(F.col("l_quantity") / 2, 0).alias("half"),
                             numbers.half_even(F.col("l_quantity") / 8, 2).alias("eighth"))


@query("display_texts", "F8, F9, F10, F17, F18", """
SELECT p_partkey, printf('%.1f%%', p_size::DOUBLE / 100 * 100) AS percent, format('{:,}', p_partkey * 1000) AS thousands,
       substr(p_name, 1, 6) AS prefix, lower(replace(replace(p_name || ' & ' || p_brand, ' & ', '_'), ' ', '_')) AS slug,
       CAST(p_size AS VARCHAR) AS size_text, lower(trim(p_type)) = 'small' AS is_small
FROM part""")
def display_texts(t):
    name = F.col("p_name")
    return t.part.select(
        "p_partkey", tx.percent_text(F.col("p_size") / 100).alias("percent"), tx.thousands_text(F.col("p_partkey") * 1000).alias("thousands"),
        tx.text_prefix(name, 6).alias("prefix"), tx.metric_slug(F.concat(name, F.lit(" & "), "p_brand")).alias("slug"),
        F.col("p_size").cast("string").alias("size_text"), tx.same_text(F.col("p_type"), "Small").alias("is_small"))


@query("json_roundtrip", "F11", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS encoded FROM events""")
def json_roundtrip(t):
    return t.events.select(
        "event_id", F.from_json("props", "k bigint")["k"].alias("k"), F.to_json(F.struct("event_id", "event_type")).alias("encoded"))


@query("event_times", "F12", """
SELECT event_id, epoch_us(ts) AS micros FROM events""")
def event_times(t):
    # half the rows carry epoch seconds, the others ISO text
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    micros = numbers.epoch_micros(F.col("ts"))
    seconds = F.concat(F.expr("{0} div 1000000".format("m")), F.lit("."), F.lpad((F.col("m") % 1000000).cast("string"), 6, "0"))
    texts = t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), micros.alias("m")).select(
        "event_id", F.when(F.col("event_id") % 2 == 0, iso).otherwise(seconds).alias("timestamp"))
    return texts.select("event_id", F.unix_micros(numbers.parse_event_time(F.col("timestamp"))).alias("micros"))


@query("softmax_argmax", "F13, F14", """
WITH cells AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings),
     top AS (SELECT vec_id, max(x) AS m FROM cells GROUP BY vec_id),
     best AS (SELECT c.vec_id, min(c.i) AS label_idx FROM cells c JOIN top t ON c.vec_id = t.vec_id AND c.x = t.m GROUP BY c.vec_id)
SELECT c.vec_id, CAST(max(b.label_idx) AS INT) AS label_idx, round(1.0 / sum(exp(c.x - t.m)), 9) AS confidence
FROM cells c JOIN top t ON c.vec_id = t.vec_id JOIN best b ON b.vec_id = c.vec_id GROUP BY c.vec_id""")
def softmax_argmax(t):
    scores = F.col("scores")
    return t.embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("scores")).select(
        "vec_id", (F.array_position(scores, F.array_max(scores)).cast("int") - 1).alias("label_idx"),
        F.round(F.array_max(numbers.softmax_array(scores)), 9).alias("confidence"))


@query("ranked_scores", "O3, F15", """
WITH shares AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2)
SELECT p_brand AS brand, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) AS INT) AS rank, p_type AS category, n FROM shares""")
def ranked_scores(t):
    maps = t.part.groupBy("p_brand", "p_type").agg(F.count("*").alias("n")).groupBy(F.col("p_brand").alias("brand")).agg(
        F.map_from_entries(F.collect_list(F.struct("p_type", "n"))).alias("scores"))
    return maps.select("brand", F.posexplode(numbers.ranked_scores(F.col("scores"))).alias("i", "e")).select(
        "brand", (F.col("i") + 1).alias("rank"), F.col("e.key").alias("category"), F.col("e.value").alias("n"))


# --- Evaluation -------------------------------------------------------------
_CONF = f"""{GUESSED}, conf AS (SELECT actual, predicted, count(*) AS n FROM guessed GROUP BY 1, 2),
names AS (SELECT actual AS label FROM conf UNION SELECT predicted FROM conf),
per_class AS (
  SELECT label, coalesce((SELECT sum(n) FROM conf WHERE actual = label), 0) AS support,
         coalesce((SELECT sum(n) FROM conf WHERE predicted = label), 0) AS pred,
         coalesce((SELECT sum(n) FROM conf WHERE actual = label AND predicted = label), 0) AS tp FROM names),
scored AS (
  SELECT label, CAST(support AS BIGINT) AS support,
         CASE WHEN pred = 0 THEN 0 ELSE tp::DOUBLE / pred::DOUBLE END AS precision, CASE WHEN support = 0 THEN 0 ELSE tp::DOUBLE / support::DOUBLE END AS recall,
         CASE WHEN pred + support = 0 THEN 0 ELSE (2 * tp)::DOUBLE / (pred + support)::DOUBLE END AS f1 FROM per_class)"""


@query("confusion_counts", "A10", f"WITH {_CONF} SELECT actual, predicted, n FROM conf")
def confusion_counts(t):
    return evaluation.confusion(guessed_language(t))


@query("confusion_dense", "A10", f"""
WITH {_CONF} SELECT a.label AS actual, p.label AS predicted, coalesce(c.n, 0) AS n
FROM names a CROSS JOIN names p LEFT JOIN conf c ON c.actual = a.label AND c.predicted = p.label""")
def confusion_dense(t):
    return evaluation.confusion_dense(evaluation.confusion(guessed_language(t)))


@query("class_metrics", "A12", f"WITH {_CONF} SELECT label, support, precision, recall, f1 FROM scored")
def class_metrics(t):
    return evaluation.class_metrics(evaluation.confusion(guessed_language(t)))


@query("accuracy", "A11", f"WITH {GUESSED} SELECT avg(CAST(actual = predicted AS INT)) AS accuracy FROM guessed")
def accuracy(t):
    return evaluation.accuracy(guessed_language(t))


@query("summary_metrics", "A11, A13, A14", f"""
WITH {_CONF} SELECT (SELECT sum(n) FILTER (WHERE actual = predicted) / sum(n)::DOUBLE FROM conf) AS accuracy,
       round(avg(f1), 12) AS f1_macro, round(sum(f1 * support) / sum(support), 12) AS f1_weighted FROM scored""")
def summary_metrics(t):
    found = evaluation.summary_metrics(evaluation.confusion(guessed_language(t)))
    return found.select("accuracy", F.round("f1_macro", 12).alias("f1_macro"), F.round("f1_weighted", 12).alias("f1_weighted"))


@query("evaluation_report", "L8", f"""
WITH {_CONF} SELECT 'per_class_f1' AS metric, label, round(f1, 12) AS value FROM scored
UNION ALL SELECT 'test_accuracy', NULL, round(sum(n) FILTER (WHERE actual = predicted) / sum(n)::DOUBLE, 12) FROM conf
UNION ALL SELECT 'test_f1_macro', NULL, round(avg(f1), 12) FROM scored
UNION ALL SELECT 'test_f1_weighted', NULL, round(sum(f1 * support) / sum(support), 12) FROM scored""")
def evaluation_report(t):
    return evaluation.evaluation_report(guessed_language(t)).withColumn("value", F.round("value", 12))
