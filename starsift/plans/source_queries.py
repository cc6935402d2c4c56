"""Queries on files, types, whole explanations, saved models and bin edges."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from starsift.functions.risk import PROMO_PHRASES, SUMMARIES
from starsift.operators import drift, rollups, serving, thresholds, training
from starsift.plans.inputs import labelled, raw_reviews, scored, table
from starsift.plans.model_queries import model_parts
from starsift.plans.registry import query, rounded
from starsift.plans.table_queries import known_or_blank
from starsift.schemas import REVIEW_SCHEMA
from starsift.sources import corpus, reports, reviews
from starsift.staging import stage_path


@query(
    "S1 S5",
    """SELECT review_id, product_id, reviewer_id, coalesce(star_rating, -1) AS star_rating, helpful_votes, total_votes,
         coalesce(CAST(verified_purchase AS VARCHAR), '') AS verified_purchase, review_headline,
         coalesce(md5(review_body), '') AS body_md5, coalesce(review_date, '') AS review_date, product_category, event_ts
       FROM reviews""",
)
def review_files(spark, sf):
    """Reviews written as JSON lines, read with the fixed schema, written as Parquet and read again."""
    lines, copy = stage_path(spark, "review-lines"), stage_path(spark, "review-table")
    raw_reviews(spark, sf).select(*REVIEW_SCHEMA.names).write.json(lines, compression="gzip")
    reviews.write_table(reviews.read_reviews(spark, lines), copy)
    body = F.coalesce(F.md5(F.col("review_body").cast("binary")), F.lit("")).alias("body_md5")
    stars, day = F.coalesce("star_rating", F.lit(-1)).alias("star_rating"), F.coalesce("review_date", F.lit("")).alias("review_date")
    return spark.read.parquet(copy).select(
        "review_id", "product_id", "reviewer_id", stars, "helpful_votes", "total_votes", known_or_blank("verified_purchase"),
        "review_headline", body, day, "product_category", "event_ts",
    )


@query(
    "S11",
    """SELECT product_id, product_category, review_count, round(avg_rating, 6) AS avg_rating, round(fraud_rate, 6) AS fraud_rate
       FROM product_agg""",
)
def report_files(spark, sf):
    """The product rollup as a CSV report, read back."""
    path = stage_path(spark, "report")
    shown = ["product_id", "product_category", "review_count", "avg_rating", "fraud_rate"]
    reports.write_csv_report(rollups.product_rollup(labelled(spark, sf)).select(*shown), path)
    kinds = "product_id string, product_category string, review_count bigint, avg_rating double, fraud_rate double"
    return rounded(reports.read_csv_report(spark, path, kinds))


@query(
    "P16",
    """SELECT DISTINCT concat('Pet_', source, '_', lang, '.v2.jsonl') AS file_name, concat('Pet ', source, ' ', lang, '.v2') AS category
       FROM documents""",
    own=True,
)
def file_categories(spark, sf):
    name = F.concat(F.lit("Pet_"), "source", F.lit("_"), "lang", F.lit(".v2.jsonl")).alias("file_name")
    names = table(spark, sf, "documents").select(name).distinct()
    return names.select("file_name", corpus.category_of(F.col("file_name")).alias("category"))


@query(
    "P20",
    """SELECT review_id, CAST(star_rating AS INTEGER) AS star_rating, CAST(body_len AS INTEGER) AS body_len,
         round(CAST(CAST(reviewer_avg_rating AS FLOAT) AS DOUBLE), 4) AS reviewer_avg_rating,
         CAST(fraud_label AS INTEGER) AS fraud_label, 'int,int,float,tinyint' AS kinds FROM labelled""",
)
def narrow_input(spark, sf):
    narrow = serving.model_input(labelled(spark, sf), narrow=True)
    kinds = F.concat_ws(",", *[F.typeof(c) for c in ("star_rating", "body_len", "reviewer_avg_rating", "fraud_label")])
    rate = F.round(F.col("reviewer_avg_rating").cast("double"), 4).alias("reviewer_avg_rating")
    return narrow.select("review_id", "star_rating", "body_len", rate, F.col("fraud_label").cast("int").alias("fraud_label"), kinds.alias("kinds"))


_PROMO = " OR ".join("contains(lower(review_body), '{}')".format(p.replace("'", "''")) for p in PROMO_PHRASES)


@query(
    "X2-X6",
    f""", weighed AS (SELECT *, {_PROMO} AS promo FROM scored),
      pointed AS (
        SELECT *, CASE WHEN score >= 0.7 THEN 3 WHEN score >= 0.45 THEN 1 ELSE 0 END
          + CASE WHEN pred = 1 THEN 2 ELSE 0 END + CASE WHEN promo AND star_rating >= 5 THEN 2 ELSE 0 END
          + CASE WHEN verified_purchase_int = 0 THEN 1 ELSE 0 END + CASE WHEN exclam_count >= 3 THEN 1 ELSE 0 END AS weight
        FROM weighed),
      levelled AS (SELECT *, CASE WHEN score < 0.32 AND pred = 0 AND weight <= 2 THEN 'low'
          WHEN score >= 0.72 OR (pred = 1 AND score >= 0.55) OR weight >= 5 THEN 'high' ELSE 'medium' END AS level FROM pointed)
      SELECT review_id, CASE level WHEN 'low' THEN '{SUMMARIES["low"]}' WHEN 'high' THEN '{SUMMARIES["high"]}'
          ELSE '{SUMMARIES["medium"]}' END AS summary, false AS llm_generated, level AS risk_level,
        score AS fraud_proba, pred AS fraud_flag, star_rating, verified_purchase_int, body_word_count, exclam_count, promo,
        concat('Review is ', sentiment, '. Fraud probability is ', printf('%.1f', score * 100), '% — ',
          CASE WHEN pred = 1 THEN 'FLAGGED as suspicious.' ELSE 'looks clean.' END) AS sentence
      FROM levelled""",
)
def whole_explanations(spark, sf):
    """Summary, every signal and the whole sentence."""
    rows = scored(spark, sf).withColumns(
        {"fraud_proba": F.col("score"), "fraud_flag": F.col("pred"), "sentiment_label": F.col("sentiment_pred")}
    )
    told = serving.explain(serving.prediction_columns(rows)).select("review_id", "fraud_explanation", "sentence")
    signals = "fraud_explanation.feature_signals"
    names = ["fraud_proba", "fraud_flag", "star_rating", "verified_purchase_int", "body_word_count", "exclam_count"]
    return told.select(
        "review_id", "fraud_explanation.summary", "fraud_explanation.llm_generated", "fraud_explanation.risk_level",
        *[f"{signals}.{n}" for n in names], F.col(f"{signals}.promotional_wording_heuristic").alias("promo"), "sentence",
    )


@query(
    "T5",
    """SELECT CAST(t AS DOUBLE) AS threshold,
         round(coalesce(sum(label) FILTER (score >= t) / nullif(count(*) FILTER (score >= t), 0), 0), 6) AS precision
       FROM scored, (VALUES (0.25), (0.5), (0.85)) g(t) GROUP BY t""",
)
def grid_from_text(spark, sf):
    grid = thresholds.parse_grid(" 0.25,0.5 , 0.85,")
    swept = thresholds.threshold_sweep(scored(spark, sf), grid)
    return rounded(swept.select("threshold", "precision"))


_QUANTILES = ", ".join(str(i / 10) for i in range(1, 10))


@query(
    "D4",
    f""", edges AS (SELECT DISTINCT unnest(quantile_disc(body_word_count, [{_QUANTILES}])) AS e FROM labelled WHERE split = 'train')
      SELECT CAST(e AS DOUBLE) AS edge FROM edges""",
)
def decile_edges(spark, sf):
    train = labelled(spark, sf).where(F.col("split") == "train")
    edges = drift.decile_edges(train, "body_word_count")
    return train.sparkSession.createDataFrame([(e,) for e in edges], "edge double")


@query(
    "D4",
    f""", edges AS (SELECT DISTINCT unnest(quantile_disc(body_word_count, [{_QUANTILES}])) AS e FROM labelled WHERE split = 'train'),
      binned AS (SELECT split, (SELECT count(*) FROM edges WHERE e <= body_word_count) AS bin FROM labelled),
      shares AS (SELECT bin, greatest(count(*) FILTER (WHERE split = 'train') / (SELECT count(*) FROM binned WHERE split = 'train'), 1e-4) AS r,
          greatest(count(*) FILTER (WHERE split = 'test') / (SELECT count(*) FROM binned WHERE split = 'test'), 1e-4) AS c
        FROM (SELECT unnest(range(0, (SELECT count(*) FROM edges) + 1)) AS bin) LEFT JOIN binned USING (bin) GROUP BY bin)
      SELECT round(sum((c - r) * ln(c / r)), 6) AS psi, CAST(count(*) AS INTEGER) AS n_bins FROM shares""",
)
def psi_deciles(spark, sf):
    """Stability of the word counts over the exact deciles of the training part."""
    rows = labelled(spark, sf)
    train, test = (rows.where(F.col("split") == part) for part in ("train", "test"))
    edges = sorted(set(drift.exact_quantiles(train, "body_word_count", [i / 10 for i in range(1, 10)])))
    return drift.population_stability(train, test, "body_word_count", edges).select(F.round("psi", 6).alias("psi"), "n_bins")


@query(
    "M20 M21",
    """SELECT count(*) AS n, 0 AS moods_differ, 0 AS scores_differ FROM reviews WHERE review_body IS NOT NULL""",
)
def saved_models(spark, sf):
    """Both models fitted, saved, loaded, and every review scored by the fitted and the loaded ones."""
    train, test = model_parts(spark, sf)
    folder = stage_path(spark, "models")
    fitted = [training.train_sentiment(train, test)[0], training.train_fraud(train, test)[0]]
    for name, model in zip(("sentiment", "fraud"), fitted, strict=True):
        model.write().overwrite().save(f"{folder}/{name}")
    loaded = [PipelineModel.load(f"{folder}/{name}") for name in ("sentiment", "fraud")]
    rows = raw_reviews(spark, sf).where(F.col("review_body").isNotNull())
    kept = training.score_reviews(rows, training.model_scorer(*fitted)).select("review_id", "sentiment_label", "fraud_proba")
    again = training.score_reviews(rows, training.model_scorer(*loaded)).select(
        "review_id", F.col("sentiment_label").alias("mood"), F.col("fraud_proba").alias("proba")
    )
    both = kept.join(again, "review_id")
    differ = lambda c: F.count_if(c).cast("int")
    return both.agg(
        F.count(F.lit(1)).alias("n"), differ(F.col("mood") != F.col("sentiment_label")).alias("moods_differ"),
        differ(F.abs(F.col("proba") - F.col("fraud_proba")) > 1e-9).alias("scores_differ"),
    )
