"""Queries on scores: explanations, metrics, thresholds, calibration, drift, text weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from starsift.functions.risk import PROMO_PHRASES
from starsift.operators import calibration, drift, metrics, preparation, ranking, rollups, serving, text_features, thresholds
from starsift.plans.inputs import clean_base, scored, sql_clean, labelled, table
from starsift.plans.registry import query, rounded
from starsift.schemas import MODEL_NUMERIC_FEATURES, NUMERIC_FEATURES
from starsift.staging import stage

_PROMO_SQL = " OR ".join("contains(lower(review_body), '{}')".format(p.replace("'", "''")) for p in PROMO_PHRASES)
_GRID_SQL = ", ".join(f"({i}, {t})" for i, t in enumerate(thresholds.DEFAULT_GRID))
_SWEEP = f"""sums AS (
  SELECT g.grid_pos, g.threshold, CAST(sum(CASE WHEN score >= g.threshold THEN label ELSE 0 END) AS DOUBLE) AS tp,
    CAST(count(*) FILTER (WHERE score >= g.threshold) AS DOUBLE) AS predicted, CAST(sum(label) AS DOUBLE) AS actual,
    count(*) AS n
  FROM scored, (VALUES {_GRID_SQL}) g(grid_pos, threshold) GROUP BY ALL),
sweep AS (
  SELECT grid_pos, CAST(threshold AS DOUBLE) AS threshold,
    CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted END AS precision,
    CASE WHEN actual = 0 THEN 0 ELSE tp / actual END AS recall,
    CASE WHEN predicted + actual = 0 THEN 0 ELSE 2 * tp / (predicted + actual) END AS f1,
    CAST(predicted + actual - 2 * tp AS BIGINT) AS errors, n
  FROM sums)"""


@query(
    "M22 P23",
    "SELECT review_id, score, pred FROM scored",
)
def scorecard(spark, sf):
    return scored(spark, sf).select("review_id", "score", "pred")


@query(
    "X1-X8",
    f""", weighed AS (
        SELECT *, {_PROMO_SQL} AS promo FROM scored),
      pointed AS (
        SELECT *, CAST(CASE WHEN score >= 0.7 THEN 3 WHEN score >= 0.45 THEN 1 ELSE 0 END
          + CASE WHEN pred = 1 THEN 2 ELSE 0 END + CASE WHEN promo AND star_rating >= 5 THEN 2 ELSE 0 END
          + CASE WHEN verified_purchase_int = 0 THEN 1 ELSE 0 END + CASE WHEN exclam_count >= 3 THEN 1 ELSE 0 END
          AS INTEGER) AS risk_weight
        FROM weighed)
      SELECT review_id, promo, risk_weight,
        CASE WHEN score < 0.32 AND pred = 0 AND risk_weight <= 2 THEN 'low'
             WHEN score >= 0.72 OR (pred = 1 AND score >= 0.55) OR risk_weight >= 5 THEN 'high'
             ELSE 'medium' END AS risk_level,
        CASE WHEN pred = 1 THEN 'flagged' WHEN score >= 0.3 THEN 'borderline' ELSE 'clean' END AS verdict,
        CASE WHEN score >= 0.7 THEN 'red' WHEN score >= 0.3 THEN 'amber' ELSE 'green' END AS rate_band,
        score AS fraud_proba, concat('Review is ', sentiment, '. ') AS opening
      FROM pointed""",
)
def explanations(spark, sf):
    rows = scored(spark, sf).withColumns(
        {"fraud_proba": F.col("score"), "fraud_flag": F.col("pred"), "sentiment_label": F.col("sentiment_pred")}
    )
    told = serving.explain(serving.prediction_columns(rows))
    signals = "fraud_explanation.feature_signals"
    return told.select(
        "review_id",
        F.col(f"{signals}.promotional_wording_heuristic").alias("promo"),
        "risk_weight",
        F.col("fraud_explanation.risk_level").alias("risk_level"),
        "verdict",
        "rate_band",
        F.col(f"{signals}.fraud_proba").alias("fraud_proba"),
        F.concat(F.substring_index("sentence", ". ", 1), F.lit(". ")).alias("opening"),
    )


_FEATURE_MEANS = ", ".join(f"stddev_pop({c}) AS {c}" for c in MODEL_NUMERIC_FEATURES)


@query(
    "M4",
    f""", dev AS (SELECT {_FEATURE_MEANS} FROM labelled)
      SELECT review_id, {", ".join(f"round(l.{c} / coalesce(nullif(d.{c}, 0), 1), 6) AS {c}" for c in MODEL_NUMERIC_FEATURES)}
      FROM labelled l, dev d""",
)
def scaled_numerics(spark, sf):
    rows = serving.model_input(
        labelled(spark, sf).withColumn("review_body_clean", F.lit(""))
    )
    return rounded(preparation.scale_by_deviation(rows, MODEL_NUMERIC_FEATURES).select("review_id", *MODEL_NUMERIC_FEATURES))


@query(
    "M6",
    """SELECT sentiment_label AS label, count(*) AS n,
         round((SELECT count(*) FROM clean) / (3.0 * count(*)), 6) AS weight
       FROM clean GROUP BY sentiment_label""",
)
def class_weights(spark, sf):
    return rounded(preparation.class_weights(clean_base(spark, sf), "sentiment_label"))


@query(
    "M11",
    """SELECT sentiment_label AS label, count(*) AS n FROM clean GROUP BY sentiment_label
       ORDER BY n DESC, label LIMIT 1""",
)
def majority_baseline(spark, sf):
    return preparation.majority_class(clean_base(spark, sf), "sentiment_label")


_DOC_GRAMS = f"""docs AS (SELECT doc_id, {sql_clean("text")} AS t FROM documents),
words AS (SELECT doc_id, regexp_extract_all(t, '\\w\\w+') AS w FROM docs),
tokens AS (
  SELECT doc_id, unnest(w) AS gram FROM words
  UNION ALL
  SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: concat(w[i], ' ', w[i + 1]))) AS gram FROM words),
counts AS (SELECT doc_id, gram, count(*) AS tf FROM tokens GROUP BY ALL),
vocab AS (
  SELECT gram, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf,
    ln((1.0 + (SELECT count(*) FROM docs)) / (1 + count(*))) + 1 AS idf
  FROM counts GROUP BY gram
  HAVING count(*) >= 10 AND count(*) <= 0.9 * (SELECT count(*) FROM docs)
  ORDER BY cf DESC, gram LIMIT 15000)"""


def clean_documents(spark, sf):
    from starsift.functions.text import clean_text

    docs = table(spark, sf, "documents").select("doc_id", clean_text(F.col("text")).alias("t"))
    return stage(docs, "documents")


@query("M1 M2", f"WITH {_DOC_GRAMS}\nSELECT gram, df, cf, round(idf, 6) AS idf FROM vocab", own=True)
def ngram_vocab(spark, sf):
    return rounded(text_features.vocabulary(clean_documents(spark, sf), 10, 0.9, 15_000, "t"))


@query(
    "M3",
    f"""WITH {_DOC_GRAMS},
    raw AS (SELECT doc_id, gram, tf, (1 + ln(tf)) * idf AS w FROM counts JOIN vocab USING (gram)),
    weights AS (SELECT doc_id, gram, tf, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM raw)
    SELECT doc_id, count(*) AS n_grams, CAST(sum(tf) AS BIGINT) AS tf, round(sum(weight), 5) AS weight_sum,
      round(max(weight), 5) AS weight_max, round(min(weight), 5) AS weight_min
    FROM weights GROUP BY doc_id""",
    own=True,
)
def tfidf(spark, sf):
    docs = clean_documents(spark, sf)
    vocab = text_features.vocabulary(docs, 10, 0.9, 15_000, "t")
    weights = text_features.tfidf(docs, vocab, key="doc_id", text="t")
    per_doc = weights.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_grams"),
        F.sum("tf").alias("tf"),
        F.sum("weight").alias("weight_sum"),
        F.max("weight").alias("weight_max"),
        F.min("weight").alias("weight_min"),
    )
    return rounded(per_doc, 5)


@query(
    "M3",
    f"""WITH {_DOC_GRAMS},
    raw AS (SELECT doc_id, gram, tf, (1 + ln(tf)) * idf AS w FROM counts JOIN vocab USING (gram)),
    weights AS (SELECT doc_id, gram, tf, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM raw)
    SELECT gram, count(*) AS n_docs, round(sum(weight), 5) AS weight_sum, round(max(weight), 5) AS weight_max
    FROM weights GROUP BY gram""",
    own=True,
)
def tfidf_by_gram(spark, sf):
    docs = clean_documents(spark, sf)
    vocab = text_features.vocabulary(docs, 10, 0.9, 15_000, "t")
    weights = text_features.tfidf(docs, vocab, key="doc_id", text="t")
    per_gram = weights.groupBy("gram").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("weight").alias("weight_sum"), F.max("weight").alias("weight_max")
    )
    return rounded(per_gram, 5)


def sentiment_predictions(spark, sf):
    return scored(spark, sf).withColumns({"label": F.col("sentiment_label"), "pred": F.col("sentiment_pred")})


@query(
    "E1",
    """, classes AS (SELECT sentiment_label AS c FROM scored UNION SELECT sentiment_pred FROM scored)
       SELECT a.c AS label, b.c AS pred,
         (SELECT count(*) FROM scored WHERE sentiment_label = a.c AND sentiment_pred = b.c) AS n
       FROM classes a, classes b""",
)
def confusion(spark, sf):
    return metrics.confusion_matrix(sentiment_predictions(spark, sf))


_BINARY = """SELECT CAST(count(*) FILTER (WHERE label = 1 AND pred = 1) AS DOUBLE) AS tp,
    CAST(count(*) FILTER (WHERE label = 0 AND pred = 1) AS DOUBLE) AS fp,
    CAST(count(*) FILTER (WHERE label = 1 AND pred = 0) AS DOUBLE) AS fn,
    CAST(count(*) FILTER (WHERE label = 0 AND pred = 0) AS DOUBLE) AS tn"""
_RATES = """CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision,
    CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall,
    CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1"""


@query(
    "E2",
    f""", m AS ({_BINARY} FROM scored), r AS (SELECT *, {_RATES} FROM m)
      SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn,
        round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM r""",
)
def binary_metrics(spark, sf):
    return rounded(metrics.binary_metrics(scored(spark, sf)))


_CLASSES = """, pairs AS (SELECT sentiment_label AS y, sentiment_pred AS p FROM scored),
  classes AS (SELECT y AS c FROM pairs UNION SELECT p FROM pairs),
  parts AS (
    SELECT c, CAST((SELECT count(*) FROM pairs WHERE y = c AND p = c) AS DOUBLE) AS tp,
      CAST((SELECT count(*) FROM pairs WHERE p = c) AS DOUBLE) AS predicted,
      CAST((SELECT count(*) FROM pairs WHERE y = c) AS DOUBLE) AS support
    FROM classes),
  per_class AS (
    SELECT c, tp, support, CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted END AS precision,
      CASE WHEN support = 0 THEN 0 ELSE tp / support END AS recall,
      CASE WHEN predicted + support = 0 THEN 0 ELSE 2 * tp / (predicted + support) END AS f1
    FROM parts)"""


@query(
    "E3",
    _CLASSES
    + """ SELECT round(avg(f1), 6) AS f1_macro, round(sum(f1 * support) / sum(support), 6) AS f1_weighted,
         round(sum(tp) / sum(support), 6) AS accuracy, CAST(sum(support) AS BIGINT) AS n FROM per_class""",
)
def multiclass_metrics(spark, sf):
    return rounded(metrics.multiclass_summary(sentiment_predictions(spark, sf)))


@query(
    "E4",
    _CLASSES
    + """ SELECT CAST(c AS VARCHAR) AS "row", round(precision, 6) AS precision, round(recall, 6) AS recall,
         round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM per_class
       UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM per_class
       UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
         CAST(sum(support) AS BIGINT) FROM per_class
       UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
         round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
         CAST(sum(support) AS BIGINT) FROM per_class""",
)
def class_report(spark, sf):
    return rounded(metrics.class_report(sentiment_predictions(spark, sf)))


_AUC = """levels AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM {rows} GROUP BY score),
  below AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
            FROM levels),
  auc AS (SELECT CAST(sum(CAST(pos AS DOUBLE) * (nb + neg / 2.0)) AS DOUBLE)
            / nullif(CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE), 0) AS roc_auc FROM below)"""


@query("E5", f", {_AUC.format(rows='scored')} SELECT round(roc_auc, 6) AS roc_auc FROM auc")
def roc_auc(spark, sf):
    return rounded(metrics.roc_auc(scored(spark, sf)))


_TOXIC = """raw AS (
  SELECT toxic AS label, round(1.0 / (1.0 + exp(-(0.0004 * least(length(text), 5000) - 1.0
    + 0.1 * least(length(text) - length(replace(text, '.', '')), 10)))), 6) AS score
  FROM documents JOIN labels USING (doc_id))"""


@query(
    "E5",
    f"WITH {_TOXIC}, {_AUC.format(rows='raw')} SELECT round(roc_auc, 6) AS roc_auc FROM auc",
    own=True,
)
def roc_auc_documents(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    dots = F.length("text") - F.length(F.replace(F.col("text"), F.lit("."), F.lit("")))
    z = 0.0004 * F.least(F.length("text"), F.lit(5000)) - 1.0 + 0.1 * F.least(dots, F.lit(10))
    rows = docs.select(F.col("toxic").alias("label"), F.round(1.0 / (1.0 + F.exp(-z)), 6).alias("score"))
    return rounded(metrics.roc_auc(rows))


@query(
    "E7",
    """SELECT s.review_id, md5(review_body_clean) AS body_md5, s.sentiment_label AS true_label,
         sentiment_pred AS pred_label
       FROM scored s JOIN clean USING (review_id) WHERE s.sentiment_label <> sentiment_pred
       ORDER BY s.review_id LIMIT 25""",
)
def sentiment_errors(spark, sf):
    rows = metrics.sentiment_errors(sentiment_predictions(spark, sf))
    body = F.md5(F.col("review_body_clean").cast("binary")).alias("body_md5")
    return rows.select("review_id", body, "true_label", "pred_label")


@query(
    "E8",
    """SELECT s.review_id, md5(review_body_clean) AS body_md5, s.star_rating, s.helpful_votes, s.total_votes, label AS true_label,
         pred AS pred_label, score AS fraud_proba FROM scored s JOIN clean USING (review_id) WHERE label <> pred""",
)
def fraud_errors(spark, sf):
    rows = metrics.fraud_errors(scored(spark, sf).withColumn("fraud_proba", F.col("score")), max_rows=None)
    return rows.withColumn("body_md5", F.md5(F.col("review_body_clean").cast("binary"))).drop("review_body_clean")


@query("A9", "SELECT count(*) FILTER (WHERE label <> pred) AS errors FROM scored")
def error_count(spark, sf):
    return rollups.error_count(scored(spark, sf))


@query(
    "T1",
    f""", {_SWEEP} SELECT grid_pos, threshold, round(precision, 6) AS precision, round(recall, 6) AS recall,
      round(f1, 6) AS f1, errors, n FROM sweep""",
)
def threshold_sweep(spark, sf):
    return rounded(thresholds.threshold_sweep(scored(spark, sf)))


@query(
    "T2-T4",
    f""", {_SWEEP},
      b AS (SELECT * FROM sweep ORDER BY f1 DESC, grid_pos LIMIT 1),
      t AS (SELECT * FROM sweep WHERE precision >= 0.5 ORDER BY grid_pos LIMIT 1)
      SELECT b.threshold AS best_f1_threshold, round(b.precision, 6) AS best_f1_precision,
        round(b.recall, 6) AS best_f1_recall, round(b.f1, 6) AS best_f1,
        t.threshold AS precision_target_threshold, round(t.precision, 6) AS precision_target_precision,
        round(t.recall, 6) AS precision_target_recall, round(t.f1, 6) AS precision_target_f1
      FROM b LEFT JOIN t ON true""",
)
def threshold_choice(spark, sf):
    sweep = stage(thresholds.threshold_sweep(scored(spark, sf)), "sweep")
    return rounded(thresholds.threshold_choice(sweep, 0.5))


@query(
    "T8",
    f""", {_SWEEP},
      e AS (SELECT min(least(precision, recall, f1)) AS lo, max(greatest(precision, recall, f1)) AS hi FROM sweep)
      SELECT round(CASE WHEN hi - lo < 1e-9 THEN greatest(0, lo - 0.045)
                        WHEN hi - lo < 0.14 THEN greatest(0, lo - greatest(0.01, (hi - lo) * 0.18)) ELSE 0.0 END, 6) AS y_min,
        round(CASE WHEN hi - lo < 1e-9 THEN least(1, hi + 0.045)
                   WHEN hi - lo < 0.14 THEN least(1, hi + greatest(0.01, (hi - lo) * 0.18)) ELSE 1.0 END, 6) AS y_max,
        hi - lo < 0.14 AS zoomed, hi - lo < 1e-9 AS flat
      FROM e""",
)
def sweep_range(spark, sf):
    return rounded(thresholds.sweep_range(thresholds.threshold_sweep(scored(spark, sf))))


_EDGES = ", ".join(f"({i}, CAST({i * 0.1!r} AS DOUBLE), CAST({(1.0 if i == 9 else (i + 1) * 0.1)!r} AS DOUBLE))" for i in range(10))
_BINS = f"""grid(bin_idx, bin_lo, bin_hi) AS (VALUES {_EDGES}),
bins AS (
  SELECT g.bin_idx, g.bin_lo, g.bin_hi, count(s.score) AS "count", avg(s.score) AS mean_pred, avg(s.label) AS pos_rate
  FROM grid g LEFT JOIN scored s ON s.score >= g.bin_lo AND (s.score < g.bin_hi OR (g.bin_idx = 9 AND s.score <= 1))
  GROUP BY g.bin_idx, g.bin_lo, g.bin_hi)"""


@query(
    "C1",
    f""", {_BINS} SELECT bin_idx, round(bin_lo, 6) AS bin_lo, round(bin_hi, 6) AS bin_hi, "count",
      round(mean_pred, 6) AS mean_pred, round(pos_rate, 6) AS empirical_pos_rate,
      round(abs(mean_pred - pos_rate), 6) AS abs_gap FROM bins""",
)
def reliability_bins(spark, sf):
    return rounded(calibration.reliability_bins(scored(spark, sf)))


@query(
    "C2 C3",
    f""", {_BINS} SELECT
      (SELECT round(sum("count" * abs(mean_pred - pos_rate)) / sum("count"), 6) FROM bins WHERE "count" > 0) AS ece,
      (SELECT round(avg((score - label) * (score - label)), 6) FROM scored) AS brier""",
)
def ece_brier(spark, sf):
    rows = scored(spark, sf)
    ece = calibration.expected_calibration_error(calibration.reliability_bins(rows))
    return rounded(calibration.brier_score(rows).select("brier").withColumn("ece", ece.scalar()))


_HALVED = """halved AS (
  SELECT 'raw' AS method, score, label FROM scored WHERE part = 'eval'
  UNION ALL SELECT 'halved', score / 2, label FROM scored WHERE part = 'eval')"""
_REPORT = f"""{_HALVED},
counts AS (SELECT method,
    CAST(count(*) FILTER (WHERE label = 1 AND score >= 0.5) AS DOUBLE) AS tp,
    CAST(count(*) FILTER (WHERE label = 0 AND score >= 0.5) AS DOUBLE) AS fp,
    CAST(count(*) FILTER (WHERE label = 1 AND score < 0.5) AS DOUBLE) AS fn,
    avg((score - label) * (score - label)) AS brier, count(*) AS n_eval
  FROM halved GROUP BY method),
levels AS (SELECT method, score, sum(label) AS pos, sum(1 - label) AS neg FROM halved GROUP BY method, score),
below AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY method ORDER BY score
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM levels),
auc AS (SELECT method, CAST(sum(CAST(pos AS DOUBLE) * (nb + neg / 2.0)) AS DOUBLE)
          / nullif(CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE), 0) AS roc_auc FROM below GROUP BY method),
grid(bin_idx, bin_lo, bin_hi) AS (VALUES {_EDGES}),
bins AS (
  SELECT s.method, g.bin_idx, count(*) AS n, abs(avg(s.score) - avg(s.label)) AS gap
  FROM grid g JOIN halved s ON s.score >= g.bin_lo AND (s.score < g.bin_hi OR (g.bin_idx = 9 AND s.score <= 1))
  GROUP BY s.method, g.bin_idx),
eces AS (SELECT method, sum(n * gap) / sum(n) AS ece FROM bins GROUP BY method),
rated AS (SELECT *, {_RATES} FROM counts),
report AS (
  SELECT method, precision, recall, f1, roc_auc, brier, ece, n_eval,
    (SELECT count(*) FROM scored WHERE part = 'calib') AS n_calib
  FROM rated JOIN auc USING (method) JOIN eces USING (method))"""
_REPORT_COLUMNS = """method, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
  round(roc_auc, 6) AS roc_auc, round(brier, 6) AS brier, round(ece, 6) AS ece, n_eval, n_calib"""


def halved_report(spark, sf):
    """Calibration report of the raw scores and of the same scores halved, under which none reaches .5."""
    rows = scored(spark, sf).select("review_id", "label", "score", "part")
    held = rows.where(F.col("part") == "eval")
    half = held.withColumn("score", F.col("score") / 2)
    both = calibration.tag_and_union({"raw": held, "halved": half}, "method")
    n_calib = rows.where(F.col("part") == "calib").count()
    return calibration.calibration_report(both, n_calib)


@query("C4 J4", f", {_REPORT} SELECT {_REPORT_COLUMNS} FROM report")
def calibration_report(spark, sf):
    return rounded(halved_report(spark, sf))


@query("C5", f", {_REPORT} SELECT {_REPORT_COLUMNS} FROM report ORDER BY report.brier, report.ece LIMIT 1")
def best_calibration(spark, sf):
    return rounded(calibration.best_calibration(halved_report(spark, sf)))


@query(
    "J4",
    f""", {_SWEEP} SELECT 'all' AS setting, grid_pos, round(f1, 6) AS f1 FROM sweep
      UNION ALL SELECT 'precise', grid_pos, round(f1, 6) FROM sweep WHERE precision >= 0.5""",
)
def tagged_reports(spark, sf):
    sweep = stage(thresholds.threshold_sweep(scored(spark, sf)), "sweep").select("grid_pos", "precision", "f1")
    parts = {"all": sweep, "precise": sweep.where(F.col("precision") >= 0.5)}
    return rounded(calibration.tag_and_union(parts, "setting").select("setting", "grid_pos", "f1"))


_MEANS = "\nUNION ALL ".join(
    f"""SELECT '{c}' AS feature, (SELECT avg(coalesce({c}, 0)) FROM labelled WHERE split = 'train') AS r,
    (SELECT avg(coalesce({c}, 0)) FROM labelled WHERE split = 'test') AS c"""
    for c in NUMERIC_FEATURES
)


def split_pair(spark, sf):
    rows = labelled(spark, sf)
    return rows.where(F.col("split") == "train"), rows.where(F.col("split") == "test")


@query(
    "D1",
    f""", means AS ({_MEANS}) SELECT feature, round(r, 6) AS reference_mean, round(c, 6) AS current_mean,
      round(c - r, 6) + 0.0 AS mean_delta FROM means""",
)
def mean_drift(spark, sf):
    return rounded(drift.mean_drift(*split_pair(spark, sf)))


@query(
    "D2",
    """, sides AS (SELECT avg(body_len) FILTER (WHERE split = 'train') AS r, avg(body_len) FILTER (WHERE split = 'test') AS c
                  FROM labelled)
       SELECT round(r, 6) AS reference_avg_length, round(c, 6) AS current_avg_length,
         round(c - r, 6) + 0.0 AS avg_length_delta FROM sides""",
)
def length_drift(spark, sf):
    return rounded(drift.length_drift(*split_pair(spark, sf)))


@query(
    "D3",
    f""", means AS ({_MEANS}) SELECT
      (SELECT count(*) FROM labelled WHERE split = 'train') AS row_count_reference,
      (SELECT count(*) FROM labelled WHERE split = 'test') AS row_count_current,
      (SELECT count(*) FROM means) AS n_features, (SELECT round(sum(abs(c - r)), 5) FROM means) AS total_shift,
      (SELECT round(avg(body_len), 6) FROM labelled WHERE split = 'train') AS reference_avg_length""",
)
def drift_summary(spark, sf):
    one = drift.drift_summary(*split_pair(spark, sf))
    shifts = F.transform("numeric_mean_comparison", lambda m: F.abs(m["mean_delta"]))
    return one.select(
        "row_count_reference",
        "row_count_current",
        F.size("numeric_mean_comparison").cast("bigint").alias("n_features"),
        F.round(F.aggregate(shifts, F.lit(0.0), lambda a, x: a + x), 5).alias("total_shift"),
        F.round("text_length_summary.reference_avg_length", 6).alias("reference_avg_length"),
    )


@query(
    "K7",
    f""", means AS ({_MEANS}) SELECT feature, round(r, 6) AS reference_mean, round(c, 6) AS current_mean,
      round(c - r, 6) + 0.0 AS mean_delta FROM means ORDER BY abs(c - r) DESC, feature LIMIT 5""",
)
def top_drift(spark, sf):
    return rounded(ranking.top_shifts(drift.mean_drift(*split_pair(spark, sf))))


_PSI_EDGES = [50, 100, 200, 300, 400, 600, 800, 1200]


@query(
    "D4",
    f""", binned AS (SELECT split, {" + ".join(f"CASE WHEN body_word_count >= {e} THEN 1 ELSE 0 END" for e in _PSI_EDGES)} AS bin
        FROM labelled),
      shares AS (
        SELECT bin, greatest(count(*) FILTER (WHERE split = 'train') / (SELECT count(*) FROM binned WHERE split = 'train'), 1e-4) AS r,
          greatest(count(*) FILTER (WHERE split = 'test') / (SELECT count(*) FROM binned WHERE split = 'test'), 1e-4) AS c
        FROM range(0, {len(_PSI_EDGES) + 1}) g(bin) LEFT JOIN binned USING (bin) GROUP BY bin)
      SELECT round(sum((c - r) * ln(c / r)), 6) AS psi, CAST(count(*) AS INTEGER) AS n_bins FROM shares""",
)
def psi(spark, sf):
    reference, current = split_pair(spark, sf)
    return rounded(drift.population_stability(reference, current, "body_word_count", _PSI_EDGES))


_MODELS = """models AS (
  SELECT 'sentiment' AS task, product_id AS model_name, avg(CAST(sentiment_label = sentiment_pred AS DOUBLE)) AS f1_macro,
    CAST(NULL AS DOUBLE) AS f1, CAST(NULL AS DOUBLE) AS roc_auc FROM scored GROUP BY product_id
  UNION ALL
  SELECT 'fraud', product_id, NULL, avg(CAST(label = pred AS DOUBLE)), max(score) FROM scored GROUP BY product_id)"""


def per_product_report(spark, sf):
    """A report in the shape of the baseline table, with products in the place of models."""
    rows = scored(spark, sf)
    hit = F.avg((F.col("sentiment_label") == F.col("sentiment_pred")).cast("double"))
    felt = rows.groupBy(F.col("product_id").alias("model_name")).agg(hit.alias("f1_macro"))
    right = F.avg((F.col("label") == F.col("pred")).cast("double"))
    judged = rows.groupBy(F.col("product_id").alias("model_name")).agg(right.alias("f1"), F.max("score").alias("roc_auc"))
    both = felt.withColumn("task", F.lit(" Sentiment")).unionByName(judged.withColumn("task", F.lit("fraud")), True)
    return stage(both, "models")


@query(
    "K8",
    f""", {_MODELS}, s AS (SELECT task, model_name, coalesce(f1_macro, f1) AS score FROM models)
      SELECT task, round(score, 6) AS score, min(model_name) AS model_name FROM s
      WHERE score = (SELECT max(score) FROM s t WHERE t.task = s.task) GROUP BY task, score""",
)
def best_models(spark, sf):
    return rounded(ranking.best_models(per_product_report(spark, sf)))


@query(
    "K9",
    f""", {_MODELS} SELECT task, model_name, 'f1_macro' AS metric, round(f1_macro, 6) AS value FROM models WHERE f1_macro IS NOT NULL
      UNION ALL SELECT task, model_name, 'f1', round(f1, 6) FROM models WHERE f1 IS NOT NULL
      UNION ALL SELECT task, model_name, 'roc_auc', round(roc_auc, 6) FROM models WHERE roc_auc IS NOT NULL""",
)
def model_series(spark, sf):
    return rounded(ranking.model_series(per_product_report(spark, sf)))
