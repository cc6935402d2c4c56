"""Line dedup against counting by hand, its filters, and that it can be undone."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from starsift.llm import line_dedup as d

BLANK = " \t\n\v\f\r"


def plain(texts, min_docs, min_chars=1):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    keys = [[line.strip(BLANK).translate(lower) for line in (t or "").split("\n")] for t in texts]
    often = Counter(k for ks in keys for k in {k for k in ks if len(k) >= min_chars})
    out = []
    for t, ks in zip(texts, keys, strict=True):
        kept = [line for line, k in zip((t or "").split("\n"), ks, strict=True) if often[k] < min_docs]
        out.append((len(ks), len(ks) - len(kept), "\n".join(kept)))
    return out


TEXTS = [None, "", "\n\n", "Same line\nown 1", " same LINE \t\nown 2\nSame line", "same line", "ÄÖ\nsame line\r\nÄÖ", "äö", "x" * 50_000 + "\nsame line", "same line", "same line"]


@pytest.mark.parametrize("limit", [d.BROADCAST_BYTES, 0])
def test_lines_equal_counting(spark, docs_of, limit):
    docs = docs_of(list(enumerate(TEXTS))).withColumn("n.lines", F.lit(1)).withColumn("mark", F.lit(2))
    index = d.build(docs, min_docs=3)
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept"]) for r in d.drop_lines(docs, index, ["doc_id", "n.lines", "mark"], broadcast_bytes=limit).collect()}
    assert [got[i] for i in range(len(TEXTS))] == plain(TEXTS, 3)
    longer = d.build(docs, min_docs=2, min_chars=3)
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept"]) for r in d.drop_lines(docs, longer, ["doc_id"], broadcast_bytes=limit).collect()}
    assert [got[i] for i in range(len(TEXTS))] == plain(TEXTS, 2, 3)


def table(df):
    return sorted(tuple(r) for r in df.collect())


def test_removed_documents_leave_no_trace(spark, docs_of, tmp_path):
    lines = [f"line {i}" for i in range(60)]
    first = docs_of([(i, "\n".join(lines[i % 7 : i % 7 + 20])) for i in range(40)])
    more = docs_of([(100 + i, "\n".join(lines[i : i + 30])) for i in range(25)])
    once = d.build(first, min_docs=8)
    both = d.update(once, spark, added=more)
    assert table(both.counts) == table(d.build(first.unionByName(more), min_docs=8).counts)
    back = d.update(both, spark, removed=more)
    assert table(back.counts) == table(once.counts)
    drop = lambda index: table(d.drop_lines(first, index, ["doc_id"]))
    assert drop(back) == drop(once) != drop(both)
    both.save(f"{tmp_path}/state")
    assert drop(d.LineIndex.load(spark, f"{tmp_path}/state")) == drop(both)
    with pytest.raises(Exception, match="removed"):
        d.update(once, spark, removed=more)


def test_shards_double_and_empty_tables(spark, docs_of):
    docs = docs_of([(i, f"line {i}\ncommon") for i in range(64)])
    index = d.update(None, spark, added=docs, min_docs=5, shard_keys=16)
    assert index.shards == 8 and {r["n_dropped"] for r in d.drop_lines(docs, index, ["doc_id"]).collect()} == {1}
    grown = d.update(index, spark, added=docs_of([(i, f"other {i}") for i in range(100)]), shard_keys=16)
    assert grown.shards == 16 and {r["n_dropped"] for r in d.drop_lines(docs, grown, ["doc_id"]).collect()} == {1}
    none = docs_of([])
    assert d.dedup_lines(none, ["doc_id"]).collect() == []
    assert d.drop_lines(docs, d.update(None, spark), ["doc_id"]).where("n_dropped > 0").count() == 0


def test_cuckoo_filter_holds_and_forgets():
    rng = np.random.default_rng(3)
    hi, lo = rng.integers(-(2**63), 2**63 - 1, (2, 20_000))
    filled = d.CuckooFilter.of(hi, lo)
    assert filled.contains(hi, lo).all()
    other = rng.integers(-(2**63), 2**63 - 1, (2, 20_000))
    assert filled.contains(*other).sum() <= 2
    filled.delete(hi[:10_000], lo[:10_000])
    again = d.CuckooFilter.loads(filled.dumps())
    assert again.contains(hi[10_000:], lo[10_000:]).all() and again.contains(hi[:10_000], lo[:10_000]).sum() <= 2
    with pytest.raises(KeyError):
        again.delete(other[0][:1], other[1][:1])
    small = d.CuckooFilter(2)
    with pytest.raises(OverflowError):
        small.insert(hi[:50], lo[:50])


def test_wrong_keys_of_a_filter_are_listed():
    key = hashlib.sha256(b"x").digest()[:16]
    hi, lo = d.halves([key])
    rows = [(0, d.CuckooFilter.of(hi, lo).dumps(), hi.tolist(), lo.tolist())]
    assert not d.FilterSet(rows, 1).frequent([key]).any()
    assert d.FilterSet([(0, rows[0][1], [], [])], 1).frequent([key, b""]).tolist() == [True, False]
