"""Staged tables without bodies, bodies from documents, and plans whose size follows the input."""

import glob
import gzip

import pytest
from pyspark.sql import functions as F

from starsift.functions.text import DROPPED_RUN, clean_text
from starsift.operators import text_features
from starsift.plans import all_queries
from starsift.plans import inputs
from starsift.staging import release_stages


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Thirty events on four documents; two documents share an id, one of them twice, and one has no text."""
    path = str(tmp_path_factory.mktemp("narrow"))
    docs = [(0, "Some <b>prose</b> here, and more. " * 40, "en", "web"), (0, "Another text of that id " * 40, "de", "web"),
            (0, "Another text of that id " * 40, "de", "web"), (1, "See http://a.example/x or 'quoted' words " * 40, "fr", "news"),
            (2, None, "es", "news"), (3, "Über   alles -- ¡hola! " * 40, "es", "web")]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string").coalesce(1).write.parquet(f"{path}/documents.parquet")
    events = spark.range(0, 30).select(
        F.col("id").alias("event_id"), F.lit("2024-05-06 07:08:09").cast("timestamp").alias("ts"), (F.col("id") % 7).alias("user_id"),
        F.lit("view").alias("event_type"), F.lit('{"n": 3}').alias("props"),
    )
    events.union(events.limit(5)).coalesce(1).write.parquet(f"{path}/events.parquet")
    yield path
    release_stages(spark)


def test_bodies_come_back_from_documents(spark, folder):
    """Also where rows repeat or share a document's id: as many rows, and the text of each."""
    columns = ["review_id", "product_category", "review_body", "review_body_clean"]
    want = inputs.clean_reviews(inputs.raw_reviews(spark, folder)).select(*columns)
    for rows in (inputs.clean_base(spark, folder), inputs.labelled(spark, folder)):
        assert sorted(map(tuple, rows.select(*columns).collect())) == sorted(map(tuple, want.collect()))
    assert inputs.labelled(spark, folder).where("review_body_clean = ''").count() == 0


def test_staged_tables_hold_no_bodies(spark, folder):
    for rows in (inputs.clean_rows(spark, folder), inputs.labelled_rows(spark, folder)):
        assert not {"review_body", "review_body_clean", "text"} & set(rows.columns)
    batches = [f for f in inputs.scored_batches(spark, folder).inputFiles() if "scored-batches" in f]
    assert batches and "review_body" not in spark.read.parquet(batches[0]).columns


@pytest.mark.parametrize("name", ["product_features", "duplicate_bodies", "class_weights", "noisy_fraud_label", "baseline_majority"])
def test_documents_are_not_read_where_no_body_is_shown(spark, folder, name):
    assert not [f for f in all_queries()[name].run(spark, folder).inputFiles() if "documents" in f]


def test_no_model_input_for_majority(spark, folder):
    from starsift.staging import _shared

    all_queries()["baseline_majority"].run(spark, folder).collect()
    assert "model-input" not in {k[2] for k in _shared if k[3] == folder}


def test_lone_blanks_are_not_replaced(spark):
    import re

    rough = r"[\x00-&(-/:-`{-\U0010FFFF]+"
    texts = ["a b", " a", "a ", "a  b", "a, b", "a ,b", "a - b", "\ta\n b\x0b", "é a é", "don't  stop", "  ", "", " '", "a  b", "a 🎉 b c"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in rows.select(clean_text(F.col("t"))).collect()] == [re.sub(rough, " ", t).strip(" ") for t in texts]
    one = spark.createDataFrame([("plain words, with one comma",)], "t string")
    assert one.select(F.regexp_count("t", F.lit(DROPPED_RUN))).first()[0] == 1


def test_texts_are_dealt_by_their_length(spark, monkeypatch):
    monkeypatch.setattr(text_features, "PART_CHARS", 100)
    docs = spark.createDataFrame([(i, "word pair " * 10) for i in range(50)], "review_id bigint, review_body_clean string")
    assert text_features.size_of(docs, "review_body_clean") == (50, 50)
    assert text_features.placed_by_key(docs, "review_id", "review_body_clean").rdd.getNumPartitions() == 50
    assert {(r["gram"], r["df"], r["cf"]) for r in text_features.vocabulary(docs, 10, 1.0).collect()} == {
        ("word", 50, 500), ("pair", 50, 500), ("word pair", 50, 500), ("pair word", 50, 450)}
    assert text_features.size_of(docs.limit(0), "review_body_clean")[0] == 0


def test_lines_are_written_packed(spark, folder):
    from starsift.plans.model_queries import corpus_lines

    files = glob.glob(f"{corpus_lines(spark, folder)}/part-*")
    assert files and all(f.endswith(".gz") for f in files) and any(gzip.open(f).read() for f in files)


def test_indexed_pages_hold_no_bodies(spark, folder, monkeypatch):
    from starsift.sources import reviews

    seen, write = [], reviews.write_pages
    monkeypatch.setattr(reviews, "write_pages", lambda rows, path: (seen.extend(rows.columns), write(rows, path)))
    all_queries()["browse_indexed"].run(spark, folder).collect()
    assert seen and "review_body" not in seen


def test_keys_of_staged_rows_are_short(spark, folder):
    """Every row carries its keys through all shuffles; group tables go once the features are written."""
    from starsift.operators.behaviour import BODY, DAY, GROUPS
    from starsift.staging import staged_so_far

    release_stages(spark)
    kinds = dict(inputs.labelled_rows(spark, folder).dtypes)
    assert (kinds[BODY], kinds[DAY], kinds[inputs.TEXT_HASH]) == ("binary", "int", "bigint")
    assert inputs.labelled_rows(spark, folder).where(F.length(BODY) != 16).count() == 0
    labels = {p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in staged_so_far(spark)}
    assert {"clean", "labelled"} <= labels and not labels & set(GROUPS)


def test_slices_are_all_rows(spark, folder, monkeypatch):
    """Written slice by slice, the labelled table is the one that a single join makes."""
    from starsift.operators.behaviour import behaviour_features
    from starsift.operators.splits import with_split
    from starsift.operators.weak_label import label_fraud

    release_stages(spark)
    want = with_split(label_fraud(behaviour_features(inputs.clean_rows(spark, folder))))
    rows, slices, attach = sorted(map(tuple, want.collect()), key=str), [], inputs.attach_by_slices
    monkeypatch.setattr(inputs, "SLICE_ROWS", 8)
    monkeypatch.setattr(inputs, "attach_by_slices", lambda keyed, n, *names: (slices.append(n), attach(keyed, n, *names))[1])
    got = inputs.labelled_rows(spark, folder)
    assert slices == [len(rows) // 8 + 1] and slices[0] > 2 and got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=str) == rows
    batches = inputs.scored_batches(spark, folder)
    assert sorted(r[0] for r in batches.select("review_id").collect()) == sorted(r[0] for r in got.select("review_id").collect())


def test_shuffle_files_of_staged_tables_go(spark):
    import time

    from starsift.staging import stage

    def shuffled():
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    before = shuffled()
    staged = stage(spark.range(1000, numPartitions=4).repartition(7, "id"), "repeated")
    until = time.time() + 10
    while shuffled() - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffled() - before and staged.count() == 1000
