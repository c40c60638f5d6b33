"""Words, vocabulary, sampling, features, classifier, drift, spend."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.catalog.bindings import (
    ALLOWED, CLEAN, FEEDBACK, LABEL_BASE, SHORT, STATEMENT, TX, dirty_transactions, event_labels, feedback,
    exported_lines, label_baseline, short_transactions, statement_lines, transactions,
)
from ledgerlens.catalog.registry import query
from ledgerlens.config import FeatureParams
from ledgerlens.functions.text import clean_narration, tokens
from ledgerlens.operators import classifier, drift, features, labels, profile, sampling, spend, statement
from ledgerlens.plans.features import build_features
from ledgerlens.plans.ingest import clean_transactions
from ledgerlens.plans.retrain import combine_sources
from ledgerlens.plans.spend_report import spend_report
from ledgerlens.sources.statements import statement_rows

SEED = 42
P = FeatureParams()


def texts(t):
    """Transactions whose texts are about to be tokenised."""
    return transactions(t)


WORDS = "regexp_extract_all(lower({}), '[a-z0-9]+')"


# --- Words and vocabulary ---------------------------------------------------
@query("token_counts", "F1", f"WITH {TX} SELECT row_id, len({WORDS.format('description')}) AS n_tokens FROM tx")
def token_counts(t):
    return transactions(t).select("row_id", F.size(tokens(F.col("description"))).cast("long").alias("n_tokens"))


@query("token_frequency", "A7", f"""
WITH {TX}, w AS (SELECT unnest({WORDS.format('description')}) AS token FROM tx)
SELECT token, count(*) AS n FROM w GROUP BY token""")
def token_frequency(t):
    return profile.token_frequency(texts(t))


def vocab_cte(source: str, name: str = "vocab", cap: int = P.max_vocab_size, min_freq: int = P.min_freq) -> str:
    return f"""{name} AS (
  SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token) + 1 AS INT) AS idx FROM (
    SELECT token, count(*) AS n FROM (SELECT unnest({WORDS.format('description')}) AS token FROM {source})
    GROUP BY token HAVING count(*) >= {min_freq} ORDER BY n DESC, token LIMIT {cap}))"""


@query("vocabulary", "L1, W3", f"WITH {TX}, {vocab_cte('tx')} SELECT token, idx FROM vocab")
def vocabulary(t):
    return features.build_vocabulary(texts(t), P.max_vocab_size, P.min_freq)


def encoded_cte(source: str, vocab: str = "vocab", name: str = "enc", length: int = P.max_seq_len, carry: str = "") -> str:
    """(row_id, pos, idx) for every position below `length`, padding included."""
    return f"""{name}_words AS (
  SELECT row_id{carry}, {WORDS.format('description')} AS words FROM {source}),
{name} AS (
  SELECT w.row_id{carry}, p.pos, CASE WHEN p.pos >= len(w.words) THEN 0 ELSE coalesce(v.idx, 1) END AS idx
  FROM {name}_words w CROSS JOIN (SELECT unnest(range({length})) AS pos) p
  LEFT JOIN {vocab} v ON v.token = w.words[p.pos + 1])"""


@query("encoded_texts", "L2, J4, F2", f"""
WITH {SHORT}, {vocab_cte('short_tx', cap=20)}, {encoded_cte('short_tx', length=6)}
SELECT row_id, CAST(pos AS INT) AS pos, CAST(idx AS INT) AS idx FROM enc""")
def encoded_texts(t):
    rows = short_transactions(t)
    vocab = features.build_vocabulary(rows, 20, P.min_freq)
    return features.encode_texts(rows, vocab, "row_id", 6).select("row_id", F.posexplode("seq").alias("pos", "idx"))


@query("encoded_long_texts", "L2", f"""
WITH {TX}, {vocab_cte('tx')}, {encoded_cte('tx')}
SELECT row_id, md5(string_agg(idx, ',' ORDER BY pos)) AS fingerprint FROM enc GROUP BY row_id""")
def encoded_long_texts(t):
    rows = texts(t)
    vocab = features.build_vocabulary(rows, P.max_vocab_size, P.min_freq)
    seq = features.encode_texts(rows, vocab, "row_id", P.max_seq_len)
    return seq.select("row_id", F.md5(F.array_join("seq", ",")).alias("fingerprint"))


@query("label_index", "W2, L3", f"""
WITH {TX} SELECT CAST(row_number() OVER (ORDER BY category) - 1 AS INT) AS label_idx, category FROM (SELECT DISTINCT category FROM tx)""")
def label_index(t):
    return labels.label_index(transactions(t))


@query("encoded_labels", "L3", f"""
WITH {TX}, li AS (SELECT CAST(row_number() OVER (ORDER BY category) - 1 AS INT) AS label_idx, category FROM (SELECT DISTINCT category FROM tx))
SELECT row_id, label_idx FROM tx JOIN li USING (category)""")
def encoded_labels(t):
    rows = transactions(t).select("row_id", "category")
    return labels.encode_labels(rows, labels.label_index(rows)).select("row_id", "label_idx")


@query("decoded_baseline", "J5", f"""
WITH {LABEL_BASE}, total AS (SELECT greatest(sum(n), 1) AS total FROM label_base)
SELECT l.category, b.n, b.n / total.total::DOUBLE AS share FROM label_base b JOIN event_labels l USING (label_idx), total""")
def decoded_baseline(t):
    names = event_labels(t)
    return labels.decode_counts(label_baseline(t, names), names)


# --- Sampling ---------------------------------------------------------------
def ranked_cte(source: str, stratum: str = "category", name: str = "ranked") -> str:
    return f"""{name} AS (
  SELECT *, row_number() OVER (PARTITION BY {stratum} ORDER BY md5('{SEED}|' || row_id), row_id) AS rn,
         count(*) OVER (PARTITION BY {stratum}) AS cnt FROM {source})"""


@query("stratified_sample", "M1", f"WITH {TX}, {ranked_cte('tx')} SELECT row_id, category FROM ranked WHERE rn <= round_even(0.9::DOUBLE * cnt, 0)")
def stratified_sample(t):
    return sampling.stratified_sample(transactions(t), "category", "row_id", 0.9, SEED).select("row_id", "category")


@query("sample_rest", "M2", f"WITH {TX}, {ranked_cte('tx')} SELECT row_id, category FROM ranked WHERE rn > round_even(0.9::DOUBLE * cnt, 0)")
def sample_rest(t):
    return sampling.sample_rest(transactions(t), "category", "row_id", 0.9, SEED).select("row_id", "category")


@query("stratified_events", "M1", f"""
WITH e AS (SELECT event_id AS row_id, event_type AS category FROM events), {ranked_cte('e')}
SELECT category, count(*) AS n, sum(row_id) AS ids FROM ranked WHERE rn <= round_even(0.9::DOUBLE * cnt, 0) GROUP BY category""")
def stratified_events(t):
    rows = t.events.select(F.col("event_id").alias("row_id"), F.col("event_type").alias("category"))
    kept = sampling.stratified_sample(rows, "category", "row_id", 0.9, SEED)
    return kept.groupBy("category").agg(F.count("*").alias("n"), F.sum("row_id").cast("double").alias("ids"))


@query("sample_without_replacement", "M4", f"""
WITH {TX} SELECT row_id FROM tx ORDER BY md5('{SEED}|' || row_id), row_id LIMIT 300""")
def sample_without_replacement(t):
    return sampling.sample_rows(transactions(t).select("row_id"), "row_id", 300, SEED)


DRAWS = f"""
draw AS (SELECT i, ('0x' || substr(md5('{SEED}|draw|' || i), 1, 15))::BIGINT AS h FROM (SELECT unnest(range({{n}})) AS i) d),
hits AS (SELECT h % (SELECT count(*) FROM {{pool}}) + 1 AS pos, count(*) AS times FROM draw GROUP BY 1),
placed AS (SELECT *, row_number() OVER (ORDER BY md5('{SEED}|' || row_id), row_id) AS pos FROM {{pool}})"""


@query("draws_with_replacement", "M3", f"""
WITH {TX}, {DRAWS.format(n=1500, pool='tx')}
SELECT row_id, category, unnest(range(1, times + 1)) AS copy_no FROM placed JOIN hits USING (pos)""")
def draws_with_replacement(t):
    rows = transactions(t).select("row_id", "category")
    return sampling.draw_with_replacement(rows, "row_id", 1500, SEED)


@query("seeded_order", "M5", f"""
WITH {TX} SELECT row_id, row_number() OVER (ORDER BY md5('{SEED}|' || row_id), row_id) AS pos FROM tx""")
def seeded_order(t):
    from ledgerlens.operators.ordered import with_position

    rows = transactions(t).select("row_id").withColumn("h", sampling.row_hash("row_id", SEED))
    return with_position(rows, [], ["h", "row_id"]).select("row_id", "pos")


DRIFT_SPLIT = f"""{ranked_cte('{src}')},
base AS (SELECT row_id, description, category FROM ranked WHERE rn <= round_even(0.9::DOUBLE * cnt, 0)),
rest AS (SELECT row_id, description, category FROM ranked WHERE rn > round_even(0.9::DOUBLE * cnt, 0)),
top AS (SELECT category FROM {{src}} GROUP BY category ORDER BY count(*) DESC, category LIMIT {{k}}),
sizes AS (SELECT count(*) AS n_rest, CAST(floor(0.75::DOUBLE * count(*)) AS BIGINT) AS n_top FROM rest),
top_rows AS (SELECT * FROM rest WHERE category IN (SELECT category FROM top)),
other_rows AS (SELECT *, row_number() OVER (ORDER BY md5('{SEED}|' || row_id), row_id) AS pos FROM rest WHERE category NOT IN (SELECT category FROM top)),
{DRAWS.format(n='(SELECT n_top FROM sizes)', pool='top_rows')},
drifted AS (
  SELECT row_id, description, category, unnest(range(1, times + 1)) AS copy_no FROM placed JOIN hits USING (pos)
  UNION ALL SELECT row_id, description, category, 1 FROM other_rows WHERE pos <= (SELECT n_rest - n_top FROM sizes))"""


def split_sql(source: str = "tx", k: int = 1) -> str:
    return DRIFT_SPLIT.replace("{src}", source).replace("{k}", str(k))


def split_rows(t):
    from ledgerlens.config import DriftSplitParams

    rows = transactions(t).select("row_id", "description", "category")
    return sampling.drift_split(rows, "row_id", params=DriftSplitParams(top_categories=1))


@query("drift_split_rows", "M6", f"WITH {TX}, {split_sql()} SELECT row_id, category, copy_no FROM drifted")
def drift_split_rows(t):
    return split_rows(t)[1].select("row_id", "category", "copy_no")


def split_cte(source: str, name: str = "split_tx", test: float = P.test_size, val: float = P.val_size) -> str:
    """The stratified split: largest remainder quotas on integer shares."""
    def quota(count, goal, out, src):
        return f"""{out} AS (
  SELECT *, ({goal} * {count}) // allc + CASE WHEN row_number() OVER (ORDER BY ({goal} * {count}) % allc DESC, category) <= {goal} - sum(({goal} * {count}) // allc) OVER () THEN 1 ELSE 0 END AS {out}
  FROM (SELECT *, sum({count}) OVER () AS allc FROM {src}))"""
    share = val / (1.0 - test)
    return f"""{ranked_cte(source, name=name + '_r')},
{name}_sizes AS (SELECT category, count(*) AS n FROM {source} GROUP BY category HAVING count(*) >= 2),
{quota('n', f'CAST(ceil({test!r}::DOUBLE * allc) AS BIGINT)', 'n_test', name + '_sizes')},
{name}_rest AS (SELECT category, n, n_test, n - n_test AS rest FROM n_test),
{quota('rest', f'CAST(ceil({share!r}::DOUBLE * allc) AS BIGINT)', 'n_val', name + '_rest')},
{name} AS (
  SELECT r.row_id, r.description, r.category,
         CASE WHEN r.rn <= q.n_test THEN 'test' WHEN r.rn <= q.n_test + q.n_val THEN 'val' ELSE 'train' END AS split
  FROM {name}_r r LEFT JOIN n_val q USING (category))"""


@query("train_val_test_split", "M7", f"WITH {TX}, {split_cte('tx')} SELECT row_id, category, split FROM split_tx")
def train_val_test_split(t):
    rows = transactions(t).select("row_id", "category")
    return sampling.train_val_test(rows, "category", "row_id", P.test_size, P.val_size, P.seed)


@query("capped_sample", "M8", f"""
WITH {TX}, {ranked_cte('tx', 'source')} SELECT row_id, source FROM ranked WHERE rn <= 20""")
def capped_sample(t):
    return sampling.capped_per_group(transactions(t).select("row_id", "source"), "source", "row_id", 20, SEED)


# --- Feature job ------------------------------------------------------------
FEATURES = f"""{split_cte('tx')},
train AS (SELECT * FROM split_tx WHERE split = 'train'),
{vocab_cte('train')},
li AS (SELECT CAST(row_number() OVER (ORDER BY category) - 1 AS INT) AS label_idx, category FROM (SELECT DISTINCT category FROM tx))"""


@query("feature_rows", "L4, M7, S10, F16", f"""
WITH {TX}, {FEATURES}, {encoded_cte('split_tx', carry=', split, category')}
SELECT e.row_id, e.split, l.label_idx, count(*) FILTER (WHERE idx <> 0) AS n_words, md5(string_agg(idx, ',' ORDER BY pos)) AS fingerprint
FROM enc e JOIN li l USING (category) GROUP BY ALL""")
def feature_rows(t):
    made = build_features(texts(t).select("row_id", "description", "category"), "row_id", P)
    return made.features.select("row_id", "split", "label_idx", F.size(F.filter("seq", lambda x: x != 0)).cast("long").alias("n_words"),
                                F.md5(F.array_join("seq", ",")).alias("fingerprint"))


@query("feature_baseline", "A8, A9, K2", f"""
WITH {TX}, {FEATURES},
lens AS (SELECT l.label_idx, least(len({WORDS.format('description')}), {P.max_seq_len}) AS n FROM train JOIN li l USING (category))
SELECT label_idx, count(*) AS n, max(m.mean) AS seq_nonzero_mean, max(m.std) AS seq_nonzero_std
FROM lens, (SELECT round(avg(n), 9) AS mean, round(stddev_pop(n), 9) AS std FROM lens) m GROUP BY label_idx""")
def feature_baseline(t):
    made = build_features(texts(t).select("row_id", "description", "category"), "row_id", P)
    return made.baseline.select(
        F.explode("label_distribution").alias("k", "n"), F.round("seq_nonzero_mean", 9).alias("seq_nonzero_mean"),
        F.round("seq_nonzero_std", 9).alias("seq_nonzero_std")).withColumn("label_idx", F.col("k").cast("int")).drop("k")


@query("train_label_distribution", "A9", f"""
WITH {TX}, {FEATURES} SELECT label_idx, count(*) AS n FROM train JOIN li USING (category) GROUP BY label_idx""")
def train_label_distribution(t):
    made = build_features(texts(t).select("row_id", "description", "category"), "row_id", P)
    return features.label_distribution(made.features.where("split = 'train'"))


# --- Classifier -------------------------------------------------------------
NB = f"""{FEATURES},
nb_words AS (
  SELECT l.label_idx, coalesce(v.idx, 1) AS idx
  FROM (SELECT category, unnest(list_slice({WORDS.format('description')}, 1, {P.max_seq_len})) AS token FROM train) w
  JOIN li l USING (category) LEFT JOIN vocab v USING (token)),
nb_token AS (SELECT idx, label_idx, count(*) AS n FROM nb_words GROUP BY 1, 2),
nb_class AS (
  SELECT l.label_idx, l.category, d.n_docs, coalesce(k.n_tokens, 0) AS n_tokens
  FROM (SELECT category, count(*) AS n_docs FROM train GROUP BY 1) d JOIN li l USING (category)
  LEFT JOIN (SELECT label_idx, CAST(sum(n) AS BIGINT) AS n_tokens FROM nb_token GROUP BY 1) k USING (label_idx))"""

SCORES = f"""{NB},
q_words AS (
  SELECT w.row_id, coalesce(v.idx, 1) AS idx
  FROM (SELECT row_id, unnest(list_slice({WORDS.format('description')}, 1, {P.max_seq_len})) AS token FROM tx) w LEFT JOIN vocab v USING (token)),
q_len AS (SELECT tx.row_id, count(q.idx) AS m FROM tx LEFT JOIN q_words q USING (row_id) GROUP BY 1),
q_sum AS (SELECT q.row_id, t.label_idx, sum(ln(t.n + 1.0)) AS s FROM q_words q JOIN nb_token t USING (idx) GROUP BY 1, 2),
raw AS (
  SELECT l.row_id, c.label_idx, c.category,
         ln(c.n_docs::DOUBLE / (SELECT sum(n_docs) FROM nb_class)) + coalesce(s.s, 0) - l.m * ln(c.n_tokens + (SELECT count(*) + 1 FROM vocab)) AS score
  FROM q_len l CROSS JOIN nb_class c LEFT JOIN q_sum s ON s.row_id = l.row_id AND s.label_idx = c.label_idx),
probs AS (
  SELECT *, exp(score - max(score) OVER w) / sum(exp(score - m)) OVER w AS p, row_number() OVER (PARTITION BY row_id ORDER BY score DESC, label_idx) AS rn
  FROM (SELECT *, max(score) OVER (PARTITION BY row_id) AS m FROM raw) WINDOW w AS (PARTITION BY row_id))"""


def language_model(t):
    rows = texts(t).select("row_id", "description", "category")
    made = build_features(rows, "row_id", P)
    return rows, made, classifier.fit(made.train_texts, made.labels, made.vocabulary, "row_id", P.max_seq_len)


@query("nb_token_counts", "L5", f"WITH {TX}, {NB} SELECT CAST(idx AS INT) AS idx, label_idx, n FROM nb_token")
def nb_token_counts(t):
    return language_model(t)[2].token_counts.drop("run_id")


@query("nb_class_counts", "L5", f"WITH {TX}, {NB} SELECT label_idx, category, n_docs, n_tokens FROM nb_class")
def nb_class_counts(t):
    return language_model(t)[2].classes.drop("run_id")


@query("predicted_labels", "L6, F14, P18, J6", f"""
WITH {TX}, {SCORES} SELECT row_id, n_chars, category AS predicted_category, round(p, 6) AS confidence FROM probs JOIN tx USING (row_id) WHERE rn = 1""".replace("category AS predicted", "probs.category AS predicted"))
def predicted_labels(t):
    _, _, model = language_model(t)
    found = classifier.predict(texts(t), model, "row_id", carry=["n_chars"])
    return found.select("row_id", "n_chars", "predicted_category", F.round("confidence", 6).alias("confidence"))


@query("predicted_scores", "L6, F13, F15", f"WITH {TX}, {SCORES} SELECT row_id, category, round(p, 6) AS probability FROM probs")
def predicted_scores(t):
    rows, _, model = language_model(t)
    return classifier.explode_scores(classifier.predict(rows, model, "row_id"), "row_id").withColumn("probability", F.round("probability", 6))


@query("test_confusion", "L8, A10", f"""
WITH {TX}, {SCORES} SELECT s.category AS actual, p.category AS predicted, count(*) AS n
FROM probs p JOIN split_tx s USING (row_id) WHERE p.rn = 1 AND s.split = 'test' GROUP BY 1, 2""")
def test_confusion(t):
    from ledgerlens.operators.evaluation import confusion

    _, made, model = language_model(t)
    test = made.rows.where("split = 'test'")
    return confusion(classifier.predict(test, model, "row_id", carry=["category"]), "category", "predicted_category")


@query("merged_model", "L7", f"""
WITH {TX}, {NB} SELECT CAST(idx AS INT) AS idx, label_idx, n FROM nb_token""")
def merged_model(t):
    """Models of two halves of the training rows add up to the model of all."""
    _, made, _ = language_model(t)
    halves = [classifier.fit(made.train_texts.where(F.col("row_id") % 2 == k), made.labels, made.vocabulary, "row_id", P.max_seq_len, f"half-{k}")
              for k in (0, 1)]
    return classifier.merge(*halves, "both").token_counts.drop("run_id")


@query("model_by_run", "L10, S10", f"""
WITH {TX}, {NB} SELECT label_idx, category, n_docs, n_tokens FROM nb_class""")
def model_by_run(t):
    from ledgerlens.session import work_folder

    _, _, model = language_model(t)
    path = work_folder(t.spark, "models")
    classifier.save_model(model, path, "first")
    classifier.save_model(classifier.merge(model, model, "second"), path, "second")
    return classifier.load_model(t.spark, path, "first").classes.select("label_idx", "category", "n_docs", "n_tokens")


@query("linear_model_predictions", "L5", f"WITH {TX} SELECT category, count(*) AS n, true AS mostly_right FROM tx GROUP BY category")
def linear_model_predictions(t):
    """An iterative fit has no SQL form; that it names at least nine in ten rows of each category right is a fact to check."""
    from ledgerlens.operators.linear_model import fit_linear, predict_linear

    rows = transactions(t).select("row_id", "description", "category")
    names = labels.label_index(rows)
    train = sampling.train_val_test(labels.encode_labels(rows, names), "category", "row_id", P.test_size, P.val_size, P.seed)
    model = fit_linear(train.where("split = 'train'"), P.max_seq_len, features=1 << 12, max_iter=10)
    found = predict_linear(rows, model, [r["category"] for r in names.orderBy("label_idx").collect()], P.max_seq_len)
    right = F.avg((F.col("category") == F.col("predicted_category")).cast("int")) >= 0.9
    return found.groupBy("category").agg(F.count("*").alias("n"), right.alias("mostly_right"))


# --- Drift ------------------------------------------------------------------
@query("drift_report", "D1, J1, A3, F6", f"""
WITH {CLEAN}, {TX}, {split_sql()},
b AS (SELECT category, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share FROM clean GROUP BY category),
c AS (SELECT category, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share FROM drifted GROUP BY category)
SELECT coalesce(b.category, c.category) AS category, coalesce(b.share, 0) AS baseline, coalesce(c.share, 0) AS current,
       abs(coalesce(c.share, 0) - coalesce(b.share, 0)) AS shift, abs(coalesce(c.share, 0) - coalesce(b.share, 0)) > 0.10 AS flagged
FROM b FULL JOIN c ON b.category = c.category""")
def drift_report(t):
    """Stored baseline of the cleaned rows against the raw rows of the skewed split."""
    baseline = profile.value_counts(clean_transactions(dirty_transactions(t), ALLOWED, "row_id"))
    return drift.category_drift(baseline, split_rows(t)[1])


@query("drift_summary", "D1, A17", f"""
WITH {CLEAN}, {TX}, {split_sql()},
b AS (SELECT category, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share FROM clean GROUP BY category),
c AS (SELECT category, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share FROM drifted GROUP BY category),
s AS (SELECT abs(coalesce(c.share, 0) - coalesce(b.share, 0)) AS shift FROM b FULL JOIN c ON b.category = c.category)
SELECT count(*) FILTER (WHERE shift > 0.10) > 0 AS drift_detected, count(*) FILTER (WHERE shift > 0.10) AS n_flagged,
       coalesce(max(round_even(shift, 4)) FILTER (WHERE shift > 0.10), 0) AS max_shift FROM s""")
def drift_summary(t):
    return drift.drift_summary(drift_report(t))


@query("split_verification", "D3", f"""
WITH {TX}, {split_sql()},
b AS (SELECT category, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share FROM base GROUP BY category),
c AS (SELECT category, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share FROM drifted GROUP BY category)
SELECT coalesce(b.category, c.category) AS category, round_even(coalesce(b.share, 0), 4) AS baseline, round_even(coalesce(c.share, 0), 4) AS current,
       round_even(abs(coalesce(c.share, 0) - coalesce(b.share, 0)), 4) AS shift
FROM b FULL JOIN c ON b.category = c.category WHERE abs(coalesce(c.share, 0) - coalesce(b.share, 0)) > 0.10""")
def split_verification(t):
    base, drifted = split_rows(t)
    return drift.drift_flags(drift.compare_shares(profile.value_shares(base), profile.value_shares(drifted)))


@query("delta_table", "D6, O2", f"""
WITH {TX}, {split_sql()},
b AS (SELECT category, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share FROM base GROUP BY category),
c AS (SELECT category, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share FROM drifted GROUP BY category)
SELECT coalesce(b.category, c.category) AS category, coalesce(b.share, 0) * 100 AS base_pct, coalesce(c.share, 0) * 100 AS drift_pct,
       coalesce(c.share, 0) * 100 - coalesce(b.share, 0) * 100 AS delta FROM b FULL JOIN c ON b.category = c.category ORDER BY delta DESC""")
def delta_table(t):
    return drift.delta_table(*split_rows(t))


FEEDBACK_DRIFT = f"""{FEEDBACK}, {LABEL_BASE},
b AS (SELECT l.category, x.n / (SELECT greatest(sum(n), 1) FROM label_base)::DOUBLE AS share FROM label_base x JOIN event_labels l USING (label_idx)),
f AS (SELECT coalesce(nullif(actual_category, ''), nullif(predicted_category, '')) AS category, count(*) AS n FROM feedback GROUP BY 1),
c AS (SELECT category, n / CAST(sum(n) OVER () AS DOUBLE) AS share FROM f WHERE category IS NOT NULL),
s AS (SELECT coalesce(b.category, c.category) AS category, coalesce(b.share, 0) AS baseline, coalesce(c.share, 0) AS current,
             abs(coalesce(c.share, 0) - coalesce(b.share, 0)) AS shift FROM b FULL JOIN c ON b.category = c.category)"""


@query("feedback_drift", "D2, J5", f"WITH {FEEDBACK_DRIFT} SELECT category, baseline, current, shift, shift > 0.10 AS flagged FROM s")
def feedback_drift(t):
    names = event_labels(t)
    return drift.feedback_report(label_baseline(t, names), names, feedback(t))


@query("feedback_status", "D2, A17, A18", f"""
WITH {FEEDBACK_DRIFT}, total AS (SELECT CAST(sum(n) AS BIGINT) AS n FROM f WHERE category IS NOT NULL)
SELECT CASE WHEN total.n < 100 THEN 'insufficient_data' WHEN count(*) FILTER (WHERE shift > 0.10) > 0 THEN 'drift_detected' ELSE 'ok' END AS status,
       total.n AS feedback_samples, count(*) FILTER (WHERE shift > 0.10) AS n_flagged,
       coalesce(max(round_even(shift, 4)) FILTER (WHERE shift > 0.10), 0) AS max_shift FROM s, total GROUP BY total.n""")
def feedback_status(t):
    names = event_labels(t)
    return drift.feedback_status(label_baseline(t, names), names, feedback(t))


@query("feedback_label_counts", "A18", f"""
WITH {FEEDBACK} SELECT coalesce(nullif(actual_category, ''), nullif(predicted_category, '')) AS label, count(*) AS n FROM feedback
WHERE coalesce(nullif(actual_category, ''), nullif(predicted_category, '')) IS NOT NULL GROUP BY 1""")
def feedback_label_counts(t):
    return profile.feedback_label_counts(feedback(t))


@query("combined_corpus", "D5, U1, U2", f"""
WITH {TX}, {split_sql()}, corr AS (SELECT trim(text) AS description, 'en' AS category FROM benchmark),
u AS (SELECT description, category FROM base UNION ALL SELECT description, category FROM drifted
      UNION ALL SELECT description, category FROM corr WHERE description <> '')
SELECT category, count(*) AS n, CAST(sum(length(description)) AS BIGINT) AS chars FROM (SELECT DISTINCT description, category FROM u) GROUP BY category""")
def combined_corpus(t):
    base, drifted = split_rows(t)
    extra = t.benchmark.select(F.col("text").alias("description"), F.lit("en").alias("actual_category"))
    return combine_sources(base, drifted, extra).groupBy("category").agg(
        F.count("*").alias("n"), F.sum(F.length("description")).alias("chars"))


# --- Statements and spend ---------------------------------------------------
@query("statement_debits", "S6, P8, P9, P10, P11, F3, F4, D9", f"""
WITH {STATEMENT} SELECT file, description, amount, count(*) AS n FROM debits GROUP BY ALL""")
def statement_debits(t):
    rows = statement_rows(exported_lines(t))
    return statement.debit_rows(rows.drop("line_order")).groupBy("file", "description", "amount").agg(F.count("*").alias("n"))


@query("dated_rows", "P8", f"""
WITH {STATEMENT} SELECT count(*) AS n, count(*) FILTER (WHERE regexp_matches(date, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{2,4}}$')) AS dated FROM body""")
def dated_rows(t):
    from ledgerlens.functions.text import is_date_shaped

    lines = statement_rows(statement_lines(t)).where("narration <> ''")
    return lines.agg(F.count("*").alias("n"), F.count_if(is_date_shaped(F.col("date"))).alias("dated"))


@query("clean_narrations", "F3", """
SELECT p_partkey AS row_id, CASE WHEN p_size % 3 = 0 THEN p_name WHEN p_size % 3 = 1 THEN p_name || ' ' || p_brand ELSE p_name END AS description FROM part""")
def clean_narrations(t):
    size, name = F.col("p_size"), F.col("p_name")
    raw = F.when(size % 3 == 0, F.concat(F.lit("UPI/"), name)).when(size % 3 == 1, F.concat(F.lit("77/12 "), name, F.lit("   "), "p_brand")).otherwise(
        F.concat(F.lit("  imps / "), name, F.lit(" ")))
    return t.part.select(F.col("p_partkey").alias("row_id"), clean_narration(raw).alias("description"))


@query("spend_by_category", "A15", f"WITH {SHORT} SELECT category, round(sum(amount), 2) AS amount FROM short_tx GROUP BY category")
def spend_by_category(t):
    return spend.spend_by_category(short_transactions(t), "category").withColumn("amount", F.round("amount", 2))


@query("spend_percentages", "A16, F7", f"""
WITH {SHORT} SELECT category, round(sum(amount), 2) AS amount, round(sum(amount) / sum(sum(amount)) OVER () * 100, 6) AS percentage
FROM short_tx GROUP BY category""")
def spend_percentages(t):
    found = spend.with_percentage(spend.spend_by_category(short_transactions(t), "category"))
    return found.withColumn("amount", F.round("amount", 2)).withColumn("percentage", F.round("percentage", 6))


@query("spend_summary", "D9, O2, F8", f"""
WITH {SHORT}, s AS (SELECT category, sum(amount) AS amount FROM short_tx GROUP BY category)
SELECT category, format('{{:,.2f}}', amount) AS amount, printf('%.1f%%', round_even(amount / sum(amount) OVER () * 100, 1)) AS percentage
FROM s ORDER BY s.amount DESC, category""")
def spend_summary(t):
    return spend.spend_summary(spend.spend_by_category(short_transactions(t), "category"))


@query("statement_spend_report", "D9, P18", f"""
WITH {STATEMENT}, {SHORT.replace('short_tx', 'tx')}, {NB.replace(f'LIMIT {P.max_vocab_size}', 'LIMIT 10000')},
q_words AS (
  SELECT w.row_id, coalesce(v.idx, 1) AS idx
  FROM (SELECT row_id, unnest(list_slice({WORDS.format('description')}, 1, {P.max_seq_len})) AS token FROM debits) w LEFT JOIN vocab v USING (token)),
q_len AS (SELECT d.row_id, count(q.idx) AS m FROM debits d LEFT JOIN q_words q USING (row_id) GROUP BY 1),
q_sum AS (SELECT q.row_id, t.label_idx, sum(ln(t.n + 1.0)) AS s FROM q_words q JOIN nb_token t USING (idx) GROUP BY 1, 2),
raw AS (
  SELECT l.row_id, c.label_idx, c.category,
         ln(c.n_docs::DOUBLE / (SELECT sum(n_docs) FROM nb_class)) + coalesce(s.s, 0) - l.m * ln(c.n_tokens + (SELECT count(*) + 1 FROM vocab)) AS score
  FROM q_len l CROSS JOIN nb_class c LEFT JOIN q_sum s ON s.row_id = l.row_id AND s.label_idx = c.label_idx),
best AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY score DESC, label_idx) AS rn FROM raw)
SELECT b.category, round(sum(d.amount), 2) AS amount, round(sum(d.amount) / sum(sum(d.amount)) OVER () * 100, 6) AS percentage
FROM best b JOIN debits d USING (row_id) WHERE b.rn = 1 GROUP BY b.category""")
def statement_spend_report(t):
    """Statement lines, debit rows, scores by a model of the parts, spend per category."""
    rows = short_transactions(t).select("row_id", "description", "category")
    made = build_features(rows, "row_id", P)
    model = classifier.fit(made.train_texts, made.labels, made.vocabulary, "row_id", P.max_seq_len)
    debits = statement.debit_rows(statement_rows(statement_lines(t)))
    report = spend_report(debits.withColumnRenamed("line_order", "row_id"), model, "row_id")
    return report.select("category", F.round("amount", 2).alias("amount"), F.round("percentage", 6).alias("percentage"))
