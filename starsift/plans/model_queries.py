"""Queries that fit models or run a stream, at the operators' own settings.

The fitted models have no SQL; what they rest on (vocabulary, weights, scaling,
splits, metrics) has, in the other modules. Fits are shared within a session:
the ablation and its summary read one table of scores.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from starsift.operators import calibration, certificates, isotonic, preparation, splits, thresholds, training
from starsift.operators import naive_bayes as bayes
from starsift.operators.serving import model_input
from starsift.plans.inputs import labelled, raw_reviews, scored, sql_clean
from starsift.plans.registry import query, rounded
from starsift.schemas import FRAUD_TARGET, MODEL_NUMERIC_FEATURES, REVIEW_SCHEMA, SENTIMENT_TARGET
from starsift.sources import corpus
from starsift.staging import shuffles_go, stage, stage_once, stage_path
from starsift.streaming import scorer as stream


def model_rows(spark, sf):
    return splits.with_split(model_input(labelled(spark, sf)))


def parts_of(rows):
    return [rows.where(F.col("split") == part).drop("split") for part in ("train", "test")]


def model_parts(spark, sf):
    """Both parts with their texts, which a fit reads many times."""
    return parts_of(stage_once(spark, "model-input", sf, lambda: model_rows(spark, sf)))


@query("M1-M7")
def train_sentiment(spark, sf):
    return training.train_sentiment(*model_parts(spark, sf))[1]


@query("M5 M8-M10")
def train_fraud(spark, sf):
    return training.train_fraud(*model_parts(spark, sf))[1]


def _grams(rows: str, vocab_filter: str, limit: str = "", sublinear: bool = False) -> str:
    """CTEs of the text weights of ``rows`` (split, review_id, t): vocabulary of the training part with numbers, weights of both parts."""
    tf = "(1 + ln(tf))" if sublinear else "tf"
    return f"""docs AS (SELECT review_id, split, review_body_clean AS t FROM {rows}),
      listed AS (SELECT review_id, split, regexp_extract_all(t, '\\w\\w+') AS w FROM docs),
      tokens AS (SELECT review_id, split, unnest(w) AS gram FROM listed UNION ALL
        SELECT review_id, split, unnest(list_transform(range(1, len(w)), lambda i: concat(w[i], ' ', w[i + 1]))) FROM listed),
      counted AS (SELECT review_id, split, gram, count(*) AS tf FROM tokens GROUP BY ALL),
      size AS (SELECT count(*) AS n FROM docs WHERE split = 'train'),
      kept AS (SELECT gram, count(*) AS df, sum(tf) AS cf FROM counted WHERE split = 'train' GROUP BY gram
        HAVING {vocab_filter} {limit}),
      vocab AS (SELECT gram, row_number() OVER (ORDER BY gram) - 1 AS idx, ln((1.0 + n) / (1 + df)) + 1 AS idf FROM kept, size),
      heavy AS (SELECT review_id, split, gram, idx, {tf} * idf AS v FROM counted JOIN vocab USING (gram)),
      weights AS (SELECT review_id, split, gram, idx, v / sqrt(sum(v * v) OVER (PARTITION BY review_id)) AS weight FROM heavy)"""


_SCALED = ", ".join(f"({i}, CAST({c} AS DOUBLE) / coalesce(nullif((SELECT stddev_pop({c}) FROM labelled WHERE split = 'train'), 0), 1))" for i, c in enumerate(MODEL_NUMERIC_FEATURES))


@query(
    "M1-M5",
    f""", {_grams("labelled", "count(*) >= 10 AND count(*) <= 0.95 * (SELECT n FROM size)", "ORDER BY cf DESC, gram LIMIT 15000", True)},
      numbers AS (SELECT review_id, (SELECT count(*) FROM vocab) + i AS idx, x AS weight FROM labelled, LATERAL (VALUES {_SCALED}) v(i, x)
        WHERE split = 'test' AND x <> 0),
      pairs AS (SELECT review_id, idx, weight FROM weights WHERE split = 'test' UNION ALL SELECT * FROM numbers)
      SELECT review_id, count(*) AS n_pairs, round(sum(weight), 5) AS weight_sum, round(sum(weight * (idx % 1009)), 3) AS by_index FROM pairs GROUP BY review_id""",
)
def model_vectors(spark, sf):
    """The feature vectors the fraud pipeline makes of the test part: how many entries, their sum, and their sum by index.

    They are read once, so they are not written.
    """
    train, test = model_parts(spark, sf)
    stages = training.hybrid_stages(train, training.FRAUD_TEXT, MODEL_NUMERIC_FEATURES)
    ready = training.prepare(stages, train, test, FRAUD_TARGET)
    return rounded_vectors(ready.vectors(ready.rows[1]))


def rounded_vectors(vectors):
    """Vectors may be stored dense where few entries are 0; those that are count for nothing either way."""
    dense = vector_to_array("features")
    unwrapped = F.unwrap_udt("features")
    indices = F.coalesce(unwrapped["indices"], F.sequence(F.lit(0), F.size(dense) - 1))
    pairs = F.filter(F.arrays_zip(indices.alias("i"), unwrapped["values"].alias("v")), lambda p: p["v"] != 0)
    sums = vectors.select("review_id", pairs.alias("p")).select(
        "review_id", F.size("p").cast("bigint").alias("n_pairs"),
        F.aggregate("p", F.lit(0.0), lambda a, p: a + p["v"]).alias("weight_sum"),
        F.aggregate("p", F.lit(0.0), lambda a, p: a + p["v"] * (p["i"] % 1009)).alias("by_index"),
    )
    return sums.select("review_id", "n_pairs", F.round("weight_sum", 5).alias("weight_sum"), F.round("by_index", 3).alias("by_index"))


def baseline_models(spark, sf, task):
    return (training.SentimentBaselines if task == "sentiment" else training.FraudBaselines)(*model_parts(spark, sf))


@query("E6 M11-M16")
def baselines(spark, sf):
    """All baselines of both tasks; the queries below have them one by one."""
    return training.baseline_report(*model_parts(spark, sf))


@query(
    "M11 E6",
    """, held AS (SELECT 'sentiment' AS task, sentiment_label AS label, split FROM labelled UNION ALL SELECT 'fraud', fraud_label, split FROM labelled),
      modes AS (SELECT task, arg_max(label, n * 10 - label) AS pred FROM (SELECT task, label, count(*) AS n FROM held WHERE split = 'train' GROUP BY ALL) GROUP BY task)
      SELECT task, label, pred, count(*) AS n FROM held JOIN modes USING (task) WHERE split = 'test' GROUP BY ALL""",
)
def baseline_majority(spark, sf):
    """Confusion counts of the majority baselines, which read labels alone: no table with texts is written for them."""
    parts = parts_of(model_rows(spark, sf))
    out = []
    for task, target in (("sentiment", SENTIMENT_TARGET), ("fraud", FRAUD_TARGET)):
        train, test = (p.select("review_id", F.col(target).alias("label")) for p in parts)
        rows = training.constant_predictions(preparation.majority_class(train, "label"), test)
        out.append(rows.groupBy(F.lit(task).alias("task"), "label", "pred").agg(F.count(F.lit(1)).alias("n")))
    return out[0].unionByName(out[1])


@query(
    "M12",
    f""", {_grams("labelled", "count(*) >= 3 AND count(*) <= 0.9 * (SELECT n FROM size)")},
      classes AS (SELECT sentiment_label AS c, ln(count(*) / (SELECT CAST(n AS DOUBLE) FROM size)) AS prior FROM labelled WHERE split = 'train' GROUP BY sentiment_label),
      sums AS (SELECT sentiment_label AS c, gram, sum(weight) AS s FROM weights JOIN labelled USING (review_id) WHERE weights.split = 'train' GROUP BY ALL),
      totals AS (SELECT c, sum(s) + (SELECT count(*) FROM vocab) AS t FROM sums GROUP BY c),
      logs AS (SELECT classes.c, vocab.gram, ln((coalesce(s, 0) + 1.0) / t) AS l FROM vocab CROSS JOIN classes JOIN totals USING (c) LEFT JOIN sums ON sums.c = classes.c AND sums.gram = vocab.gram),
      told AS (SELECT review_id, c, sum(weight * l) AS s FROM weights JOIN logs USING (gram) WHERE split = 'test' GROUP BY ALL),
      class_scores AS (SELECT l.review_id, c.c, c.prior + coalesce(s, 0) AS s FROM labelled l CROSS JOIN classes c LEFT JOIN told t ON t.review_id = l.review_id AND t.c = c.c WHERE l.split = 'test')
      SELECT review_id, arg_max(c, s) AS pred, round(max(s), 4) AS best FROM class_scores GROUP BY review_id""",
)
def naive_bayes(spark, sf):
    """Predictions of multinomial naive Bayes on the test part."""
    train, test = model_parts(spark, sf)
    text = training.text_tables(train, test, training.BASELINE_SENTIMENT_TEXT)
    label = F.col(SENTIMENT_TARGET).alias("label")
    model = bayes.fit(text.lists(train, label), train.select(label), text.grams.index)
    rows = bayes.predict(model, text.lists(test, once=True), test.select("review_id"))
    return rows.select("review_id", "pred", F.round("best", 4).alias("best"))


def one_baseline(spark, sf, task, name):
    report = training.sentiment_baselines if task == "sentiment" else training.fraud_baselines
    return report(baseline_models(spark, sf, task), [name])


@query("M13 E6")
def baseline_logistic(spark, sf):
    return one_baseline(spark, sf, "sentiment", "tfidf_logistic_regression")


@query("M14 E6")
def baseline_linear_svm(spark, sf):
    return one_baseline(spark, sf, "sentiment", "tfidf_linear_svm")


@query("M15 E6")
def baseline_numeric(spark, sf):
    return one_baseline(spark, sf, "fraud", "numeric_logistic_regression")


@query("M15 E6")
def baseline_hybrid(spark, sf):
    return one_baseline(spark, sf, "fraud", "hybrid_logistic_regression")


@query("M16 E6")
def baseline_forest(spark, sf):
    return one_baseline(spark, sf, "fraud", "hybrid_random_forest")


def ablation_scores(spark, sf):
    return stage_once(spark, "ablation-scores", sf, lambda: training.ablation_scores(*model_parts(spark, sf)))


def ablation_rows(spark, sf):
    return stage_once(spark, "ablation", sf, lambda: training.ablation(ablation_scores(spark, sf))[0])


@query("T6 M17")
def ablation(spark, sf):
    return ablation_rows(spark, sf)


@query("T7")
def ablation_summary(spark, sf):
    return thresholds.ablation_summary(ablation_rows(spark, sf))


@query("M18 M19 C4")
def calibrated_report(spark, sf):
    rows = scored(spark, sf).select("review_id", "label", "score", "part")
    variants, _, n_calib = calibration.calibrated_variants(rows)
    return calibration.calibration_report(stage(variants, "calibrated"), n_calib)


#: A gradient this small a part of that without any weights counts as none; the solver gets that many steps for it.
SMALL_GRADIENT, CERTIFIED_ITER = 0.05, 400


@query(
    "M6 M7 M8 M18",
    f"""SELECT model, CAST(n AS BIGINT) AS n_rows, true AS at_optimum FROM (
        SELECT 'sentiment' AS model, count(*) FILTER (WHERE split = 'train') AS n FROM labelled
        UNION ALL SELECT 'fraud', count(*) FILTER (WHERE split = 'train') FROM labelled
        UNION ALL SELECT 'platt', count(*) FILTER (WHERE part = 'calib') FROM scored)""",
)
def regression_certificates(spark, sf):
    """For each regression, whether the gradient of its stated loss is small where the solver ends, given time.

    The trainings stop after 100 and 80 steps, before that point, as the surveyed ones do.
    """
    train, test = model_parts(spark, sf)
    felt, n = training.sentiment_regression(train, test, max_iter=CERTIFIED_ITER)
    judged, _ = training.fraud_regression(train, test, max_iter=CERTIFIED_ITER)
    calib = scored(spark, sf).where(F.col("part") == "calib").select("score", F.col("label").cast("double").alias("label"))
    n_calib = calib.count()
    platt = calibration.platt_model(calib, n_calib)
    points = calib.select(array_to_vector(F.array("score")).alias("features"), "label")
    out = []
    for name, model, rows, penalty, weight, size in (
        ("sentiment", felt.model, felt.rows, 1.0 / (2.0 * n), "class_weight", n),
        ("fraud", judged.model, judged.rows, 1.0 / n, "class_weight", n),
        ("platt", platt, points, 1.0 / n_calib, None, n_calib),
    ):
        found = certificates.gradient_summary(certificates.loss_gradient(model, rows, penalty, weight))
        small = F.col("largest") <= SMALL_GRADIENT * F.col("largest_at_zero")
        out.append(found.select(F.lit(name).alias("model"), F.lit(size).cast("bigint").alias("n_rows"), small.alias("at_optimum")))
    return out[0].unionByName(out[1]).unionByName(out[2])


@query(
    "M19",
    """SELECT CAST(0 AS BIGINT) AS falls, CAST(0 AS BIGINT) AS off_mean, CAST(0 AS BIGINT) AS low_prefixes,
         count(DISTINCT score) AS scores, CAST(sum(label) AS DOUBLE) AS total FROM scored WHERE part = 'calib'""",
)
def isotonic_certificate(spark, sf):
    """Shows that the curve fitted to the calibration scores as they are is the least-squares monotone one."""
    rows = scored(spark, sf).where(F.col("part") == "calib").select("score", "label")
    return isotonic.certificate(rows, isotonic.isotonic_blocks(rows))


@query(
    "M19",
    """, pooled AS (SELECT score, avg(CAST(label AS DOUBLE)) AS y, CAST(count(*) AS DOUBLE) AS w FROM (SELECT round(score, 2) AS score, label, part FROM scored) WHERE part = 'calib' GROUP BY score),
      numbered AS (SELECT *, row_number() OVER (ORDER BY score) AS i, sum(w) OVER (ORDER BY score) AS cw,
          sum(w * y) OVER (ORDER BY score) AS cy FROM pooled),
      runs AS (SELECT a.i AS s, b.i AS e, (b.cy - a.cy + a.w * a.y) / (b.cw - a.cw + a.w) AS m FROM numbered a JOIN numbered b ON a.i <= b.i),
      least_of AS (SELECT s, i, min(m) AS m FROM (SELECT r.s, p.i, r.m FROM runs r JOIN numbered p ON r.s <= p.i AND r.e >= p.i) GROUP BY s, i),
      fit AS (SELECT p.score, max(m) AS f FROM least_of l JOIN numbered p ON p.i = l.i GROUP BY p.score)
      SELECT score, round(f, 6) AS calibrated FROM fit""",
)
def isotonic_fit(spark, sf):
    """The fitted isotonic curve at the calibration scores: max over starts of min over ends of means.

    Scores are taken to two digits here, as the SQL compares all runs of them;
    ``isotonic_certificate`` checks the curve of the scores as they are.
    """
    rows = scored(spark, sf).where(F.col("part") == "calib").withColumn("score", F.round("score", 2))
    points = rows.select("score").distinct()
    fitted = calibration.isotonic_scores(rows.select("score", "label"), points.withColumn("at", F.col("score")))
    return rounded(fitted.select(F.col("at").alias("score"), F.col("score").alias("calibrated")))


@query("M19")
def isotonic_curve(spark, sf):
    """The fitted isotonic curve at all calibration scores as they are.

    No SQL: comparing all runs of scores grows with their square. A test compares the
    curve with that form on few rows.
    """
    rows = scored(spark, sf).where(F.col("part") == "calib")
    return isotonic_points(rows.select("score", "label"))


def isotonic_points(rows):
    """(score, calibrated) of each distinct score of (score, label) rows; the score is not rounded."""
    points = rows.select("score").distinct()
    fitted = calibration.isotonic_scores(rows, points.withColumn("at", F.col("score")))
    return fitted.select(F.col("at").alias("score"), F.round("score", 6).alias("calibrated"))


def stand_in_scorer(featured):
    """Fixed linear form on the serving features."""
    z = -1.6 + 0.9 * (F.col("star_rating") == 5).cast("int") + 1.3 * (1 - F.col("verified_purchase_int"))
    proba = F.round(1.0 / (1.0 + F.exp(-(z + 0.001 * F.least("body_word_count", F.lit(900))))), 6)
    felt = F.when(F.col("star_rating") <= 2, 0).when(F.col("star_rating") == 3, 1).otherwise(2)
    return featured.withColumns({"sentiment_label": felt, "fraud_proba": proba})


def loosely_typed(rows, column: str):
    """JSON lines of the rows, a number now written as text, now with a fraction, now plainly."""
    turn = F.pmod(F.crc32(F.col("review_id").cast("binary")), F.lit(3))
    others = [c for c in rows.columns if c != column]
    shapes = {0: F.col(column).cast("string"), 1: F.col(column).cast("double"), 2: F.col(column)}
    lines = [rows.where(turn == k).select(F.to_json(F.struct(*others, v.alias(column))).alias("value")) for k, v in shapes.items()]
    return lines[0].unionByName(lines[1]).unionByName(lines[2])


@query(
    "S1 S8 S9 R1-R7 P19",
    f""", served AS (SELECT review_id, product_id, star_rating, coalesce(star_rating, 3) AS stars,
        CAST(coalesce(verified_purchase, false) AS INTEGER) AS verified,
        least(len(list_filter(string_split({sql_clean("review_body")}, ' '), lambda x: x <> '')), 900) AS words FROM reviews),
      judged AS (SELECT *, round(1.0 / (1.0 + exp(-(-1.6 + 0.9 * CAST(stars = 5 AS INTEGER) + 1.3 * (1 - verified) + 0.001 * words))), 6) AS p FROM served)
      SELECT review_id, product_id, coalesce(star_rating, -1) AS star_rating,
        CASE WHEN stars <= 2 THEN 0 WHEN stars = 3 THEN 1 ELSE 2 END AS sentiment_label,
        CASE WHEN stars <= 2 THEN 'negative' WHEN stars = 3 THEN 'neutral' ELSE 'positive' END AS sentiment,
        p AS fraud_proba, CAST(p >= 0.5 AS INTEGER) AS fraud_flag, 'file' AS source
      FROM judged""",
)
def stream_score(spark, sf):
    """The reviews written as JSON lines, with broken ones among them, fed through the streaming scorer, and read back.

    Both sides hold every review with its body, so both are packed.
    """
    folder = stage_path(spark, "stream")
    source, out, marks = f"{folder}/in", f"{folder}/scored", f"{folder}/marks"
    rows = raw_reviews(spark, sf).select(*REVIEW_SCHEMA.names)
    broken = rows.where(F.col("event_ts") % 50 == 0).select(F.concat(F.lit("{cut "), "review_id").alias("value"))
    with shuffles_go(spark):
        loosely_typed(rows, "star_rating").unionByName(broken).write.text(source, compression="gzip")
    stream.start_scoring(stream.file_source(spark, source, 2), stand_in_scorer, out, marks, "file", once=True, compression="gzip")
    got = stream.read_scored(spark, out).withColumn("star_rating", F.coalesce("star_rating", F.lit(-1)))
    return got.select(
        "review_id", "product_id", "star_rating", "sentiment_label", "sentiment", "fraud_proba", "fraud_flag", "source"
    )


def corpus_lines(spark, sf):
    """External corpus records as JSON lines, with odd counts, missing ratings and broken lines."""
    folder = stage_path(spark, "corpus")
    rows = raw_reviews(spark, sf)
    votes = F.when(F.col("event_ts") % 11 == 0, 1e20).otherwise(F.col("helpful_votes").cast("double"))
    records = rows.select(
        "review_id",
        F.col("star_rating").alias("rating"),
        F.col("review_headline").alias("title"),
        F.col("review_body").alias("text"),
        F.col("product_id").alias("asin"),
        F.col("reviewer_id").alias("user_id"),
        (F.col("event_ts") * 1000 + 999).alias("timestamp"),
        votes.alias("helpful_vote"),
        "verified_purchase",
    )
    broken = rows.where(F.col("event_ts") % 40 == 0).select(F.concat(F.lit('{"rating": '), "review_id").alias("value"))
    loosely_typed(records, "rating").unionByName(broken).write.text(folder, compression="gzip")
    return folder


@query(
    "S2 P12-P17",
    """SELECT product_id, reviewer_id, star_rating, CASE WHEN event_ts % 11 = 0 THEN 0 ELSE helpful_votes END AS helpful_votes,
         coalesce(verified_purchase, false) AS verified_purchase, md5(trim(coalesce(review_body, ''))) AS body_md5,
         'Books' AS product_category, event_ts, 64 AS id_chars
       FROM reviews WHERE star_rating IS NOT NULL""",
)
def import_lines(spark, sf):
    got = corpus.import_corpus(spark, corpus_lines(spark, sf), "Books")
    return got.select(
        "product_id", "reviewer_id", "star_rating", "helpful_votes", "verified_purchase",
        F.md5(F.trim("review_body").cast("binary")).alias("body_md5"), "product_category", "event_ts",
        F.length("review_id").alias("id_chars"),
    )


@query(
    "S3 S4",
    """SELECT count(*) + count(*) FILTER (event_ts % 40 = 0) AS "read", count(star_rating) AS written,
         count(*) - count(star_rating) + count(*) FILTER (event_ts % 40 = 0) AS skipped, least(count(star_rating), 700) AS limited
       FROM reviews""",
)
def import_accounting(spark, sf):
    folder = corpus_lines(spark, sf)
    limited = corpus.import_corpus(spark, folder, "Books", 700).agg(F.count(F.lit(1)).alias("n"))
    return corpus.import_counts(spark, folder).withColumn("limited", limited.scalar())
