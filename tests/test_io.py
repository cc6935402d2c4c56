"""Files, import, stream, models, registered queries."""

import json

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from starsift.operators import splits, training
from starsift.plans import all_queries
from starsift.plans.batch import build_tables, write_threshold_report
from starsift.plans.model_queries import stand_in_scorer
from starsift.schemas import FEATURE_COLUMNS, REVIEW_SCHEMA, SCORED_COLUMNS
from starsift.sources import corpus, kafka, reports
from starsift.sources.reviews import browse, read_reviews
from starsift.streaming import scorer

REVIEW = {
    "review_id": "a", "product_id": "P", "reviewer_id": "R", "star_rating": 5, "review_body": "love it, really great",
    "verified_purchase": True,
}
SMOKE = "/root/testdata/sf0.001"


def lines(path, *records):
    path.write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in records))


def test_import_and_counts(spark, tmp_path):
    good = {"rating": 4.5, "title": " T ", "text": "", "asin": "A", "user_id": "U", "timestamp": -1500, "images": []}
    lines(
        tmp_path / "Cell_Phones.jsonl",
        good,
        {**good, "rating": 3.5, "text": " body\n", "helpful_vote": 7, "verified_purchase": True, "timestamp": 1704067200999},
        {**good, "rating": None},
        {**good, "title": None, "text": None},
        "{broken",
    )
    rows = corpus.import_corpus(spark, str(tmp_path)).orderBy("event_ts").collect()
    assert [r["star_rating"] for r in rows] == [4, 4]
    assert rows[0]["event_ts"] == -2 and rows[0]["review_date"] == "1969-12-31"
    assert rows[1]["review_date"] == "2024-01-01" and rows[1]["review_body"] == "body" and rows[1]["total_votes"] == 7
    assert rows[0]["review_headline"] == "T" and rows[0]["product_category"] == "Cell Phones"
    assert rows[0]["verified_purchase"] is False and rows[0]["review_id"] != rows[1]["review_id"]
    assert tuple(corpus.import_counts(spark, str(tmp_path)).first()) == (5, 2, 3)
    assert corpus.import_corpus(spark, str(tmp_path), "X", 1).count() == 1


def test_malformed_review_lines_fall_out(spark, tmp_path):
    lines(tmp_path / "r.jsonl", REVIEW, "{nope", {**REVIEW, "review_id": "b"})
    raw = read_reviews(spark, str(tmp_path))
    assert raw.count() == 3 and browse(raw, 1, 5).first()["review_id"] == "b"


def test_batch_tables(spark, tmp_path):
    raw = [{**REVIEW, "review_id": str(i), "reviewer_id": f"R{i % 7}", "review_date": "2024-01-01"} for i in range(60)]
    lines(tmp_path / "raw.jsonl", *raw)
    paths = build_tables(read_reviews(spark, str(tmp_path / "raw.jsonl")), str(tmp_path / "out"))
    reviews = spark.read.parquet(paths["reviews"])
    assert reviews.count() == 60 and set(FEATURE_COLUMNS) <= set(reviews.columns)
    assert spark.read.parquet(paths["train"]).count() + spark.read.parquet(paths["test"]).count() == 60
    assert spark.read.parquet(paths["product_agg"]).first()["review_count"] == 60
    assert spark.read.parquet(paths["reviewer_agg"]).count() == 7


def test_reports(spark, tmp_path):
    scores = spark.createDataFrame([(1, 0.9), (0, 0.2)], "label int, score double")
    write_threshold_report(scores, str(tmp_path))
    back = reports.read_csv_report(spark, f"{tmp_path}/threshold_study", "threshold double, precision double, recall double, f1 double")
    assert reports.preview(back, ["threshold"]).first()["threshold"] == 0.1
    assert spark.read.json(f"{tmp_path}/thresholds").first()["best_f1_threshold"] == 0.3


def test_lenient_import(spark, tmp_path):
    good = {"rating": 4.0, "title": "T", "text": "x", "asin": "A", "user_id": "U", "timestamp": 1704067200000}
    odd = [{"rating": "5.0"}, {"helpful_vote": 2.0}, {"helpful_vote": 1e30}, {"timestamp": "1704067200000"}, {"rating": "five"}, {"rating": 1e300}]
    lines(tmp_path / "Odd_Ones.jsonl", *[{**good, **o} for o in odd], "{broken", "[1]")
    rows = corpus.import_corpus(spark, str(tmp_path)).collect()
    assert sorted((r["star_rating"] is None, r["star_rating"] or 0, r["helpful_votes"]) for r in rows) == [
        (False, 4, 0), (False, 4, 0), (False, 4, 2), (False, 5, 0), (True, 0, 0),
    ]
    assert tuple(corpus.import_counts(spark, str(tmp_path)).first()) == (8, 5, 3)


@pytest.mark.parametrize("n", [1, 7, 30, 31, 99])
def test_import_limit_cuts_one_partition(spark, n):
    from starsift.sources.corpus import first_rows

    rows = spark.range(0, 30, 1, 4)
    assert [r["id"] for r in first_rows(rows, n).orderBy("id").collect()] == list(range(min(n, 30)))


def test_stream_takes_loosely_typed_reviews(spark):
    given = [{**REVIEW, "star_rating": v} for v in ("4", 4.0, 4, None, "x", 1e99)]
    messages = spark.createDataFrame([(json.dumps(r),) for r in given] + [("{broken",), ("",)], "value string")
    got = scorer.scored_rows(messages, stand_in_scorer, "file").collect()
    assert [r["star_rating"] for r in got] == [4, 4, 4, None, None, None]
    assert [r["sentiment_label"] for r in got] == [2, 2, 2, 1, 1, 1]


def test_shared_tables_are_written_once(spark):
    from starsift.plans.inputs import clean_base, labelled
    from starsift.staging import _shared, release_stages

    release_stages(spark)
    for name in ("product_rollup", "reviewer_rollup", "global_summary", "roc_auc", "psi", "class_weights"):
        all_queries()[name].run(spark, SMOKE).collect()
    assert sorted(k[2] for k in _shared) == ["clean", "labelled"]
    first = clean_base(spark, SMOKE).inputFiles()
    assert clean_base(spark, SMOKE).inputFiles() == first
    assert release_stages(spark) > 0 and not _shared
    assert labelled(spark, SMOKE).count() > 0 and clean_base(spark, SMOKE).inputFiles() != first


def test_recent_rows_scan_few_batches(spark):
    from starsift.operators.audit import recent_scored
    from starsift.plans.inputs import scored_batches

    plan = recent_scored(scored_batches(spark, SMOKE))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [batch_id" in plan


def test_messages(spark):
    df = spark.createDataFrame([("nice", None, 0)], "review_body string, product_id string, star_rating int")
    sent = json.loads(kafka.to_messages(kafka.submitted_record(df)).first()["value"])
    assert sent["star_rating"] == 5 and sent["product_id"].startswith("BFORM") and len(sent["reviewer_id"]) == 25
    assert sent["product_category"] == "User Submitted" and sent["review_headline"] == "form-submitted review"


def test_stream_matches_batch(spark, tmp_path):
    source, out, marks = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "marks")
    source.mkdir()
    lines(source / "1.jsonl", *[{**REVIEW, "review_id": f"a{i}", "star_rating": i % 6} for i in range(20)])
    lines(source / "2.jsonl", REVIEW, "{broken", {"review_id": "bare"})
    (source / "3.jsonl").write_text("")
    stream = scorer.file_source(spark, str(source), 1)
    scorer.start_scoring(stream, stand_in_scorer, out, marks, "file", once=True, preview_rows=1)
    got = scorer.read_scored(spark, out)
    assert got.columns == SCORED_COLUMNS and got.count() == 22
    assert got.select("batch_id").distinct().count() == 2  # the empty batch left nothing
    batch = scorer.scored_rows(spark.read.text(str(source)), stand_in_scorer, "file")
    shown = ["review_id", "sentiment", "fraud_proba", "fraud_flag"]
    assert sorted(got.select(shown).collect()) == sorted(batch.select(shown).collect())
    # Started again on the same checkpoint, nothing is scored twice.
    scorer.start_scoring(scorer.file_source(spark, str(source), 1), stand_in_scorer, out, marks, "file", once=True)
    assert scorer.read_scored(spark, out).count() == 22


def test_models_train_save_and_score(spark, tmp_path):
    words = {0: "terrible broken refund awful", 1: "okay average nothing special", 2: "great love excellent happy"}
    rows = spark.range(240).select(
        F.col("id").cast("string").alias("review_id"),
        F.element_at(F.array(*map(F.lit, words.values())), (F.col("id") % 3 + 1).cast("int")).alias("review_body_clean"),
        (F.col("id") % 3).cast("int").alias("sentiment_label"),
        (F.col("id") % 4 == 0).cast("int").alias("fraud_label"),
        *[(F.col("id") % (i + 2)).cast("double").alias(c) for i, c in enumerate(training.MODEL_NUMERIC_FEATURES)],
    )
    train, test = splits.train_test(rows)
    tiny = training.TextSettings(2, 0.9, 50)
    felt, summary = training.train_sentiment(train, test, tiny, 20)
    assert summary.first()["f1_macro"] > 0.95
    judged, candidates = training.train_fraud(train, test, tiny, 10, 5)
    assert candidates.where("selected").count() == 1
    assert training.model_metadata(spark, summary, candidates).count() == 1
    felt.write().overwrite().save(f"{tmp_path}/sentiment")
    judged.write().overwrite().save(f"{tmp_path}/fraud")
    loaded = [PipelineModel.load(f"{tmp_path}/{name}") for name in ("sentiment", "fraud")]
    reviews = spark.createDataFrame([("great love excellent happy", 5), ("terrible broken awful", 1)], "review_body string, star_rating int")
    scored = training.score_reviews(reviews, training.model_scorer(*loaded)).orderBy("star_rating").collect()
    assert [r["sentiment"] for r in scored] == ["negative", "positive"]
    assert all(0 <= r["fraud_proba"] <= 1 for r in scored)


def test_registry_imports_without_a_session():
    queries = all_queries()
    assert len(queries) >= 75 and set(REVIEW_SCHEMA.names)
    assert all(q.covers for q in queries.values())


@pytest.fixture(scope="module")
def tables():
    duckdb = pytest.importorskip("duckdb")
    from check_queries import TABLES

    db = duckdb.connect()
    for table in TABLES:
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMOKE}/{table}.parquet'")
    return db


# The certificate of the regressions takes minutes; test_models.py checks the gradient itself.
LONG = {"regression_certificates"}


@pytest.mark.parametrize("name", sorted(n for n, q in all_queries().items() if q.sql is not None and n not in LONG))
def test_queries_match_sql(spark, tables, name):
    from check_queries import rows_of

    query = all_queries()[name]
    got, want = query.run(spark, SMOKE).toPandas(), tables.sql(query.sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)
