"""Cleaning, behaviour, label, splits, rollups, top lists on literal rows."""

import pytest
from pyspark.sql import functions as F

from starsift.functions import coerce, labels, risk, text
from starsift.operators import audit, behaviour, ranking, rollups, serving, splits
from starsift.operators.cleaning import clean_reviews
from starsift.operators.weak_label import label_fraud, rule_fraud
from starsift.schemas import FEATURE_COLUMNS, MODEL_NUMERIC_FEATURES, REVIEW_SCHEMA, require_columns
from starsift.sources.reviews import validate
from starsift.staging import stage

GOOD = dict(
    review_id="1", product_id="P", reviewer_id="R", star_rating=5, helpful_votes=1, total_votes=2, verified_purchase=True,
    review_headline="Hi", review_body="a fine thing", review_date="2024-01-02", product_category="c", event_ts=1,
)


def reviews(spark, *changes):
    rows = [{**GOOD, "review_id": str(i), **c} for i, c in enumerate(changes)]
    return spark.createDataFrame([tuple(r[f] for f in REVIEW_SCHEMA.names) for r in rows], REVIEW_SCHEMA)


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("Check <b>this</b> https://example.com !!!", "check this"),
        (None, ""),
        ("Don't  STOP\t\nnow", "don't stop now"),
        ("see www.a.b/c?d=1 there", "see there"),
        ("naïve “quotes” — 5*", "na ve quotes 5"),
        ("<a href='x'>", ""),
        ("url https://x.y glued on", "url on"),
        ("\x00\x26{|}~`@[", ""),
    ],
)
def test_clean_text(spark, raw, want):
    column = text.clean_text(F.lit(raw).cast("string"))
    assert one(spark, column, a=1) == want


def test_counts(spark):
    assert one(spark, text.word_count(F.lit("")), a=1) == 0
    assert one(spark, text.word_count(F.lit("a b c")), a=1) == 3
    assert one(spark, text.exclamation_count(F.lit("wow! no!!")), a=1) == 3
    assert one(spark, text.exclamation_count(F.lit(None).cast("string")), a=1) == 0


@pytest.mark.parametrize(("rating", "want"), [(1, 0), (2, 0), (3, 1), (4, 2), (5, 2), (None, 1), (2.9, 0), (3.7, 1)])
def test_sentiment_label(spark, rating, want):
    assert one(spark, labels.sentiment_label(F.lit(rating).cast("double")), a=1) == want


def test_lenient_casts(spark):
    assert one(spark, coerce.number_or(F.lit("x"), 3, "int"), a=1) == 3
    assert one(spark, coerce.number_or(F.lit("4"), 3, "int"), a=1) == 4
    assert one(spark, coerce.number_or(F.lit(float("nan")), 0), a=1) == 0
    for text in ("99999999999", "inf", "-1e40"):
        assert one(spark, coerce.number_or(F.lit(text), 3, "int"), a=1) == 3
    assert one(spark, coerce.flag(F.lit(None).cast("boolean")), a=1) == 0


def test_clean_reviews_drops_and_keeps(spark):
    bad = [
        {"review_body": None}, {"star_rating": None}, {"reviewer_id": None}, {"product_id": None},
        {"star_rating": 0}, {"star_rating": 6}, {"review_body": "abcd"},
    ]
    kept = clean_reviews(reviews(spark, *bad, {}, {"review_date": "2023-13-99"}, {"review_date": None})).collect()
    assert sorted(r["review_id"] for r in kept) == ["7", "8", "9"]
    by_id = {r["review_id"]: r for r in kept}
    assert by_id["7"]["review_ts"] is not None and by_id["8"]["review_ts"] is None


def test_clean_reviews_cleans_each_text_once(spark):
    plan = clean_reviews(reviews(spark, {})).select("review_body_clean")._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert filters and not any("regexp_replace" in line for line in filters)


def featured(spark, *changes):
    base = stage(behaviour.with_group_keys(clean_reviews(reviews(spark, *changes))), "test")
    return behaviour.behaviour_features(base)


def test_behaviour_features(spark):
    rows = featured(
        spark,
        {},
        {"star_rating": 2, "product_id": "Q", "verified_purchase": None},
        {"star_rating": 4, "review_date": None, "verified_purchase": False},
        {"star_rating": 4, "review_date": "bad", "product_id": "Q"},
        {"reviewer_id": "S", "verified_purchase": None},
    ).collect()
    by_id = {r["review_id"]: r for r in rows}
    first = by_id["0"]
    assert first["reviewer_review_count"] == 4
    assert first["reviewer_avg_rating"] == pytest.approx(3.75)
    assert first["reviewer_pct_5star"] == pytest.approx(0.25)
    assert first["reviewer_distinct_products"] == 2
    assert first["reviewer_reviews_same_day"] == 2
    assert by_id["2"]["reviewer_reviews_same_day"] == 2  # reviews without a date share one day
    assert first["reviewer_verified_share"] == pytest.approx(2 / 3)
    assert by_id["4"]["reviewer_verified_share"] is None
    assert first["product_review_count"] == 3 and first["dup_in_product"] == 3


def test_rule_branches(spark):
    columns = "dup_in_product int, reviewer_review_count int, reviewer_pct_5star double, reviewer_verified_share double, reviewer_reviews_same_day int"
    cases = [
        ((3, 1, 0.0, 1.0, 1), 1), ((2, 8, 0.95, 0.2, 4), 1), ((2, 7, 1.0, 0.0, 4), 0), ((1, 1, 0.0, 1.0, 5), 1),
        ((1, 9, 1.0, None, 1), 0), ((3, 9, 1.0, None, 1), 1),
    ]
    df = spark.createDataFrame([c for c, _ in cases], columns).withColumn("w", rule_fraud())
    assert [r["w"] for r in df.collect()] == [w for _, w in cases]


def test_label_and_split_do_not_depend_on_layout(spark):
    rows = spark.range(3000).select(
        F.col("id").cast("string").alias("review_id"), F.lit(3).alias("dup_in_product"), F.lit(1).alias("reviewer_review_count"),
        F.lit(0.0).alias("reviewer_pct_5star"), F.lit(0.0).alias("reviewer_verified_share"), F.lit(1).alias("reviewer_reviews_same_day"),
    )

    def outcome(df):
        return sorted(splits.with_split(label_fraud(df)).select("review_id", "fraud_label", "split").collect())

    one_part, seven = outcome(rows.repartition(1)), outcome(rows.repartition(7))
    assert one_part == seven
    flipped = sum(r["fraud_label"] == 0 for r in one_part) / 3000
    tested = sum(r["split"] == "test" for r in one_part) / 3000
    assert 0.02 < flipped < 0.05 and 0.17 < tested < 0.23
    with pytest.raises(ValueError):
        splits.with_calibration_part(rows, 1.0)


@pytest.mark.parametrize("n", [0, 1, 777, 2999, 3000, 5000])
def test_seeded_sample_is_exact(spark, n):
    rows = spark.range(3000).select(F.col("id").cast("string").alias("review_id"))
    got = [r[0] for r in splits.seeded_sample(rows, n).collect()]
    assert len(got) == len(set(got)) == min(n, 3000)
    assert sorted(got) == sorted(r[0] for r in splits.seeded_sample(rows.repartition(5), n).collect())


def test_hot_product_is_split_by_adaptive_execution(spark):
    """A third of the rows on one product: the join back splits its partition, and results stay whole."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("P"), F.col("id") % 500)).alias("product_id"),
            (F.col("id") % 5 + 1).cast("int").alias("star_rating"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        )
        joined = behaviour.join_groups(rows, behaviour.product_groups(rows), ["product_id"])
        result = joined.groupBy("product_review_count").agg(F.count(F.lit(1)).alias("n"), F.max("payload"))
        counts = {r["product_review_count"]: r["n"] for r in result.collect()}
        assert counts[20_000] == 20_000 and sum(counts.values()) == 60_000
        assert "skew=true" in result._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value else spark.conf.unset(key)


def test_rollups_and_lists(spark):
    rows = spark.createDataFrame(
        [("P", "c", "R", 5, 1, True), ("P", "c", "S", 3, 0, False), ("Q", "c", "R", 1, 1, None), ("P", "d", "R", 4, 0, True)],
        "product_id string, product_category string, reviewer_id string, star_rating int, fraud_label int, verified_purchase boolean",
    )
    products = rollups.product_rollup(rows)
    assert products.count() == 3
    top = ranking.top_products(products, 1).first()
    assert (top["product_id"], top["product_category"], top["review_count"]) == ("P", "c", 2)
    with pytest.raises(ValueError, match="Missing required columns"):
        ranking.top_products(products, by="nope")
    assert ranking.listed_products(products, 99, "nonsense").count() == 3
    assert ranking.top_fraud_reviewers(rollups.reviewer_rollup(rows), 1).first()["reviewer_id"] == "R"
    assert rollups.label_summary(rows.limit(0)).first().asDict() == {"n_rows": 0, "n_fraud": 0, "fraud_share": 0.0}
    assert rollups.risky_review_count(rows, 0.5).first()[0] == rollups.reviews_on_risky_products(rows, 0.5).count() == 1
    both = rollups.union_splits(rows.withColumn("only", F.lit(1)), rows)
    assert both.where("only is null").count() == 4
    totals = {r["product_id"]: r for r in audit.product_totals(products).collect()}
    assert totals["P"]["review_count"] == 3 and totals["P"]["categories"] == ["c", "d"]


def test_best_models_and_series(spark):
    report = spark.createDataFrame(
        [("sentiment", "b", 0.5, None, None), (" Sentiment", "a", 0.5, None, None), ("fraud", "x", None, 0.3, 0.9),
         ("FRAUD", "y", None, float("nan"), 0.8), ("fraud", "", None, 0.2, 0.7)],
        "task string, model_name string, f1_macro double, f1 double, roc_auc double",
    )
    best = {r["task"]: r["model_name"] for r in ranking.best_models(report).collect()}
    assert best == {"sentiment": "a", "fraud": "x"}
    series = [(r["metric"], r["model_name"]) for r in ranking.model_series(report).collect()]
    assert series == [("f1", "x"), ("roc_auc", "x"), ("roc_auc", "y"), ("f1_macro", "a"), ("f1_macro", "b")]


def test_recent_rows_and_sources(spark):
    scored = spark.range(70).select(
        F.format_string("%03d", "id").alias("review_id"), F.floor(F.col("id") / 10).alias("batch_id"),
        F.when(F.col("id") % 2 == 0, "kafka").alias("source"),
    )
    recent = audit.recent_scored(scored, 60)
    assert recent.count() == 50 and recent.agg(F.min("batch_id")).first()[0] == 2
    assert ranking.recent_sources(recent).first()[0] == "file + kafka"
    assert ranking.recent_sources(recent.limit(0)).first()[0] == "file"


def test_serving_features_and_explanation(spark):
    row = spark.createDataFrame([("amazing product, love it!", 5, True)], "review_body string, star_rating int, verified_purchase boolean")
    features = serving.serving_features(row)
    require_columns(features, MODEL_NUMERIC_FEATURES)
    scored = serving.prediction_columns(features.withColumns({"sentiment_label": F.lit(2), "fraud_proba": F.lit(0.22)}))
    told = serving.explain(scored).first()
    assert told["fraud_explanation"]["risk_level"] == "low" and told["verdict"] == "clean"
    assert told["sentence"] == "Review is positive. Fraud probability is 22.0% — looks clean."
    assert told["fraud_explanation"]["feature_signals"]["promotional_wording_heuristic"] is True
    lacking = serving.serving_features(spark.createDataFrame([(None,)], "review_body string")).first()
    assert (lacking["star_rating"], lacking["body_word_count"], lacking["verified_purchase_int"]) == (3, 0, 0)


@pytest.mark.parametrize(
    ("proba", "flagged", "weight", "want"),
    [(0.31, 0, 2, "low"), (0.32, 0, 2, "medium"), (0.31, 0, 3, "medium"), (0.72, 0, 0, "high"), (0.55, 1, 2, "high"),
     (0.54, 1, 4, "medium"), (0.1, 0, 5, "high")],
)
def test_risk_level(spark, proba, flagged, weight, want):
    assert one(spark, risk.risk_level(F.lit(proba), F.lit(flagged), F.lit(weight)), a=1) == want


def test_effective_values(spark):
    none = F.lit(None).cast("int")
    assert one(spark, risk.effective_stars(F.lit(0), F.lit(4)), a=1) == 4
    assert one(spark, risk.effective_stars(none, none), a=1) == 3
    assert one(spark, risk.effective_verified(none, F.lit(True)), a=1) == 1


def test_feature_table_and_validation(spark):
    table = label_fraud(featured(spark, {}, {})).select(*FEATURE_COLUMNS)
    assert len(table.columns) == 26
    checked = {r["column_name"]: r for r in validate(reviews(spark, {}, {"review_body": None})).collect()}
    assert checked["review_body"]["n_null"] == 1 and checked["event_ts"]["data_type"] == "bigint"
