"""The jobs one after the other: lines, tables, models, scores, reports."""

import json

from starsift.plans import jobs
from starsift.plans.batch import build_tables
from starsift.plans.inputs import raw_reviews
from starsift.schemas import REVIEW_SCHEMA
from starsift.sources import corpus
from starsift.sources.reviews import read_reviews
from starsift.streaming import scorer

SMOKE = "/root/testdata/sf0.001"


def test_jobs(spark, tmp_path):
    out = str(tmp_path)
    rows = raw_reviews(spark, SMOKE).select(*REVIEW_SCHEMA.names)
    rows.write.json(f"{out}/lines")
    build_tables(read_reviews(spark, f"{out}/lines"), f"{out}/tables")
    jobs.train_job(spark, f"{out}/tables", f"{out}/models")
    about = spark.read.json(f"{out}/models/metadata").first().asDict(recursive=True)
    assert about["fraud"]["selected"] and about["thresholds"] and about["sentiment"]["n_train"] > 0
    jobs.score_job(spark, f"{out}/models", f"{out}/stream", files=f"{out}/lines", once=True)
    assert scorer.read_scored(spark, f"{out}/stream/scored").count() == rows.count()
    jobs.report_job(spark, f"{out}/tables", f"{out}/models", f"{out}/reports", grid="0.2,0.6", min_precision=0.5)
    assert spark.read.option("header", True).csv(f"{out}/reports/threshold_study").count() == 2
    for name in ("threshold_study", "fraud_calibration_report", "fraud_errors", "sentiment_errors", "sentiment_confusion"):
        assert spark.read.option("header", True).csv(f"{out}/reports/{name}").count() > 0
    assert spark.read.json(f"{out}/reports/drift_report").count() == 1


def test_import_job(spark, tmp_path):
    good = {"rating": 4, "title": "T", "text": "x", "asin": "A", "user_id": "U", "timestamp": 1704067200000}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "Toys_Games.jsonl").write_text(json.dumps(good) + "\n{broken\n")
    jobs.import_job(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert spark.read.parquet(f"{tmp_path}/out/reviews").first()["product_category"] == "Toys Games"
    assert spark.read.json(f"{tmp_path}/out/import_counts").first()["skipped"] == 1


def test_import_parses_each_line_once(spark, tmp_path, monkeypatch):
    good = {"rating": 4, "title": "T", "text": "x", "asin": "A", "user_id": "U", "timestamp": 1704067200000}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "Toys_Games.jsonl").write_text("\n".join([json.dumps(good)] * 9) + "\n{broken\n")
    calls = []
    parse = corpus.parse_lines
    monkeypatch.setattr(corpus, "parse_lines", lambda lines: calls.append(1) or parse(lines))
    for limit, written in ((0, 9), (4, 4)):
        counts = corpus.import_table(spark, str(tmp_path / "in"), f"{tmp_path}/out{limit}", None, limit).first()
        assert tuple(counts) == (10, 9, 1) and spark.read.parquet(f"{tmp_path}/out{limit}").count() == written
    assert len(calls) == 2
