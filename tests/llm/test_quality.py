"""Quality ledger against a plain reading of the rules."""

import re

from starsift.llm import quality_ledger as q
from starsift.llm import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    repeated = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated)


def test_measures_equal_brute_force(docs_of, odd_texts, real_docs):
    more = [(30, "a b c d e f a b c d e x a b c d e"), (31, "a a a a a a a"), (32, "l\nl\n l\nl\n\n\n"), (33, "|#|<>")]
    short = [r for r in odd_texts if r[0] != 7]
    docs = docs_of(short + more).unionByName(real_docs.where("n_chars < 4000"))
    got = q.ledger(docs, ["doc_id", "text"]).collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute(r["text"])
        failed = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        assert failed == bool(r["fail_bits"] & q.mask_of("base"))


def test_policy_and_ablation(spark, docs_of, odd_texts):
    rows = q.ledger(docs_of(odd_texts), ["doc_id"])
    bits = [r["fail_bits"] for r in rows.collect()]
    for version, names in q.POLICIES.items():
        mask = q.mask_of(version)
        table = q.ablation(rows, version).collect()
        assert [r["rule"] for r in table] == list(names)
        for r in table:
            bit = 1 << next(x.bit for x in q.RULES if x.name == r["rule"])
            assert r["failed"] == sum(bool(b & bit) for b in bits)
            assert r["only_this"] == sum(b & mask == bit for b in bits)
            assert (r["docs"], r["dropped"]) == (len(bits), sum(bool(b & mask) for b in bits))
    empty = q.ablation(q.ledger(docs_of([]), ["doc_id"]), "v1").collect()
    assert all(r["failed"] == r["docs"] == 0 for r in empty)


def test_query_keeps_ordinary_documents(spark):
    rows = queries.op9_quality_ledger(spark, "/root/testdata/sf0.001").collect()
    assert all(not r["kept"] for r in rows if r["base_failed"])
    assert sum(r["kept"] for r in rows) > 0.8 * sum(not r["base_failed"] for r in rows)
