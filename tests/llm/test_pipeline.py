"""The pipeline, stage by stage and as a whole."""

import re

from tokenizers import Tokenizer

import corpus_pipeline as p
from starsift.llm.queries import tokenizer_path
from starsift.staging import stage

SF = "/root/testdata/sf0.001"


def run_stages(spark, docs):
    out = []
    for _, step in p.STAGES:
        docs = stage(step(spark, docs, SF), "step")
        out.append(docs)
    return out


def test_stages_on_planted_cases(spark, docs_of, real_docs):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()["text"]
    base = " ".join(r["text"] for r in real_docs.where("lang = 'en' and n_chars > 500").orderBy("doc_id").limit(2).collect())
    rows = [
        (9001, base), (9002, base), (9003, None), (9004, ""), (9005, "12345 67890 !!!"), (9001, base),
        (9006, base[:300] + " " + item + " " + base[300:700]), (9007, item), (9008, "the password=hunter2345 in " + base[200:600]),
        (None, base[100:400]),
    ]
    docs = docs_of(rows)
    lang, one, clean, safe, coded = run_stages(spark, real_docs.unionByName(docs))
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    assert {9003, 9004, 9005}.isdisjoint(ids(lang)) and {9001, 9002, 9006, 9008, None} <= ids(lang)
    assert 9002 not in ids(one) and one.where("doc_id = 9001").count() == 1
    text = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert item[:60] not in text[9006] and 9007 not in text
    assert text[9001] == base
    for df in (lang, one, clean, safe):
        assert df.columns == real_docs.columns and df.schema == real_docs.schema
    last = {r["doc_id"]: r for r in safe.collect()}
    assert "hunter2345" not in last[9008]["text"] and "[redacted]" in last[9008]["text"]
    assert all(r["n_chars"] == len(r["text"]) for r in last.values())
    library = Tokenizer.from_file(tokenizer_path())
    got = {r["doc_id"]: r["ids"] for r in coded.collect()}
    assert set(got) == set(last)
    for k in list(got)[:40]:
        assert got[k] == library.encode(last[k]["text"], add_special_tokens=False).ids


def test_run_equals_the_stages(spark, real_docs):
    whole = sorted(map(str, p.run(spark, SF).collect()))
    assert whole == sorted(map(str, run_stages(spark, real_docs)[-1].collect())) and whole
    assert all(re.fullmatch("[0-9a-f]{64}", r["decoded_sha256"]) for r in p.run(spark, SF).collect())


def test_empty_documents(spark, docs_of):
    for df in run_stages(spark, docs_of([])):
        assert df.count() == 0
