"""Suffix automaton against a plain search of every window."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from starsift.llm import decontaminate as d
from starsift.llm import queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def brute(text, items, window=10):
    """(words, hit words, item ids) by comparing every window with every place."""
    own, hit, found = words(text), set(), set()
    for item, body in items:
        seq = words(body)
        size = min(window, len(seq))
        if not size:
            continue
        windows = {tuple(seq[i : i + size]) for i in range(len(seq) - size + 1)}
        for i in range(len(own) - size + 1):
            if tuple(own[i : i + size]) in windows:
                hit.update(range(i, i + size))
                if item is not None:
                    found.add(str(item))
    return len(own), len(hit), sorted(found)


def test_words_are_the_stated_ones():
    text = "A-b_C3 naïve ÄB\x7fx y {z}|é~q\n" + "".join(map(chr, range(256)))
    assert [w.decode() for w in d.words_of(text.encode())] == words(text)


small = st.lists(st.sampled_from("abc"), max_size=14)


@settings(max_examples=300, deadline=None)
@given(st.lists(small, max_size=5), st.lists(st.sampled_from("abcd"), max_size=40), st.integers(1, 5))
def test_automaton_equals_brute_force(items, doc, window):
    rows = [(str(i), [w.encode() for w in seq]) for i, seq in enumerate(items)]
    auto = d.build_automaton(rows, window)
    spans, found = d.find_hits(auto, [w.encode() for w in doc])
    n, hit, ids = brute(" ".join(doc), [(i, " ".join(s)) for i, s in enumerate(items)], window)
    assert (sum(b - a for a, b in spans), sorted(found)) == (hit, ids)
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op1_decontaminate(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        n, hit, ids = brute(texts[r["doc_id"]], items)
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == (n, hit, len(ids), digest, hit > 0)
    assert any(r["contaminated"] for r in got)


def test_blocks_of_items_agree(docs_of, items, odd_texts):
    base = " ".join(f"w{i}" for i in range(30))
    docs = docs_of([*odd_texts, (20, "x " + base + " y"), (21, base[:40] + " z " + base), (22, "solo word here")])
    tests = items([(1, base), (2, "w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15"), (2, base), (3, None), (4, ""), (5, "Solo"), (None, "word here"), (10, "w28 w29")])
    one = {str(r) for r in d.mark_contamination(docs, tests, ["doc_id"]).collect()}
    many = {str(r) for r in d.mark_contamination(docs, tests, ["doc_id"], block_words=12).collect()}
    assert one == many and len(one) >= 14
    rows = {r["doc_id"]: r for r in d.mark_contamination(docs, tests, ["doc_id"]).collect()}
    assert rows[20]["item_ids"] == ["1", "10", "2"] and rows[22]["item_ids"] == ["5"]
    assert sum(s["end"] - s["first"] for s in rows[22]["hit_spans"]) == 3


def test_removal_keeps_the_rest(docs_of, items):
    passage = " ".join(f"p{i}" for i in range(12))
    clean = "Nothing to see, here. " * 3
    rows = [(1, f"Before it, {passage}! And after it " + clean), (2, clean), (3, None), (4, passage), (5, "")]
    docs = docs_of(rows).withColumnRenamed("source", "n_words")
    tests = items([(1, passage)])
    got = {r["doc_id"]: r for r in d.decontaminate(docs, tests).collect()}
    assert set(got) == {1, 2, 3, 5}
    assert got[1]["text"] == "Before it, ! And after it " + clean and got[2]["text"] == clean and got[3]["text"] is None
    assert d.decontaminate(docs, tests).columns == docs.columns
    assert d.decontaminate(docs, items([])).count() == 5
    assert d.decontaminate(docs_of([]), tests).count() == 0
