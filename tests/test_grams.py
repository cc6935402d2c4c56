"""Grams counted and weighed in arrays, against plain computations; what the models on them write."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starsift.operators import grams, text_features, training
from starsift.operators.vectors import GramWeightsModel
from starsift.staging import staged_so_far

WORDS = ["ab", "cd", "x", "éa", "hello", "w_1", "it's", "AB", "zz"]


def texts_of(n=300, seed=1):
    rng = random.Random(seed)
    return [rng.choice([None, "", "a", "abéécd ef-gh", "zz " * 5]) if rng.random() < 0.2 else " ".join(rng.choices(WORDS, k=rng.randint(0, 12))) for _ in range(n)]


def grams_of(text):
    words = re.findall(r"\w\w+", text or "", re.ASCII)
    return words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def weights_of(counts, idf):
    raw = {g: (1 + math.log(n)) * idf[g] for g, n in counts.items() if g in idf}
    length = math.sqrt(sum(w * w for w in raw.values()))
    return {g: w / length for g, w in raw.items()}


@pytest.mark.parametrize(("a", "b"), [(0, 300), (13, 200), (5, 5)])
def test_gram_stats_of_slices(a, b, monkeypatch):
    monkeypatch.setattr(grams, "HELD_ROWS", 40)
    texts, stats, got = texts_of(), grams.GramStats(), Counter()
    for at in range(a, b, 9):
        stats.add(pa.array(texts)[at : min(at + 9, b)])
        if stats.full():
            for batch in stats.taken():
                got.update({r["gram"]: complex(r["df"], r["cf"]) for r in batch.to_pylist()})
    for batch in stats.taken():
        got.update({r["gram"]: complex(r["df"], r["cf"]) for r in batch.to_pylist()})
    cf = Counter(g for t in texts[a:b] for g in grams_of(t))
    df = Counter(g for t in texts[a:b] for g in set(grams_of(t)))
    assert got == {g: complex(df[g], cf[g]) for g in cf}


@pytest.fixture(scope="module")
def docs(spark):
    """Keys repeat, are null, or stand apart."""
    rng = random.Random(3)
    rows = [(None if rng.random() < 0.1 else f"k{rng.randint(0, 60)}", t, float(i % 3)) for i, t in enumerate(texts_of())]
    return spark.createDataFrame(rows, "review_id string, review_body_clean string, label double").repartition(3)


@pytest.mark.parametrize("array_grams", [3_000_000, 0])
def test_weights_of_rows_whose_keys_repeat(docs, array_grams, monkeypatch):
    monkeypatch.setattr(text_features, "ARRAY_GRAMS", array_grams)
    monkeypatch.setattr(text_features, "SENT_GRAMS", 7)
    vocab = text_features.gram_index(text_features.vocabulary(docs, 3, 0.9, None))
    found = text_features.WeightLists.of(vocab)
    assert (found.known is None) == (array_grams == 0)
    names = {r["idx"]: r["gram"] for r in vocab.collect()}
    idf = {r["gram"]: r["idf"] for r in vocab.collect()}
    rows, by_key = docs.collect(), {}
    for r in rows:
        by_key.setdefault(r["review_id"], Counter()).update(grams_of(r["review_body_clean"]))
    by_key[None] = Counter()
    want = {k: weights_of(c, idf) for k, c in by_key.items()}
    got = found.of_rows(docs).collect()
    assert Counter((r["review_id"], r["label"]) for r in got) == Counter((r["review_id"], r["label"]) for r in rows)
    for r in got:
        assert r["idx"] == sorted(r["idx"])
        assert {names[i]: w for i, w in zip(r["idx"], r["weight"], strict=True)} == pytest.approx(want[r["review_id"]])
    once = [r["review_id"] for r in found.of_rows(docs, once=True).where("review_id is not null").collect()]
    assert sorted(once) == sorted(k for k in by_key if k)
    for r in found.vectors_of(docs, ["label"]).collect():
        vector = r["features"]
        assert vector.size == len(names) + 1
        assert {names[i]: v for i, v in zip(vector.indices, vector.values, strict=True) if i < len(names)} == pytest.approx(want[r["review_id"]])


def test_the_saved_stage_weighs_as_the_tables_do(spark, docs, tmp_path):
    one_each = docs.where("review_id is not null").dropDuplicates(["review_id"])
    vocab = text_features.gram_index(text_features.vocabulary(one_each, 2, 0.9, 100))
    listed = sorted((r["idx"], r["gram"], r["idf"]) for r in vocab.collect())
    made = GramWeightsModel(inputCol="review_body_clean", outputCol="v", sublinear=True, grams=[g for _, g, _ in listed], idf=[w for *_, w in listed])
    made.write().overwrite().save(f"{tmp_path}/stage")
    want = {r["review_id"]: dict(zip(r["idx"], r["weight"], strict=True)) for r in text_features.WeightLists.of(vocab).of_rows(one_each).collect()}
    for r in GramWeightsModel.load(f"{tmp_path}/stage").transform(one_each).collect():
        assert dict(zip(r["v"].indices.tolist(), r["v"].values.tolist(), strict=True)) == pytest.approx(want[r["review_id"]])


def test_models_on_tables_write_no_weights(spark, docs):
    """Weights of every text and gram were written, several times the disk of the texts."""
    train = docs.where("review_id is not null").dropDuplicates(["review_id"]).select("review_id", "review_body_clean", F.col("label").cast("int").alias("sentiment_label"))
    before = set(staged_so_far(spark))
    models = training.SentimentBaselines(train, train, training.TextSettings(2, 0.9, None, sublinear=False), 3)
    assert models.tfidf_naive_bayes().count() == train.count()
    assert models.ready.train.select("features").count() == train.count()
    names = [p.rsplit("/", 1)[1] for p in set(staged_so_far(spark)) - before]
    assert not [n for n in names if n.startswith(("text-weights", "packed-vectors", "train-vectors"))] and np.isfinite(models.ready.n_test)
