"""Fingerprints, links and components against a comparison of all pairs."""

import re

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql.types import LongType, StructField, StructType

from starsift.llm import queries
from starsift.llm import simhash_dedup as s

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fp(text, n=4):
    w = WORD.findall((text or "").translate(FOLD))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(points, limit=4):
    """Label of each point: the smallest one reachable."""
    points = sorted(points)
    label = {p: p for p in points}
    pairs = [(a, b) for i, a in enumerate(points) for b in points[i + 1 :] if ((a ^ b) & (1 << 64) - 1).bit_count() <= limit]
    moved = True
    while moved:
        moved = False
        for a, b in pairs:
            low = min(label[a], label[b])
            moved |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


@settings(deadline=None)
@given(st.text(max_size=120))
def test_fingerprint(text):
    assert s.fingerprint(text.encode()) & (1 << 64) - 1 == brute_fp(text)


def cloud(seed, centers, around, flips):
    """Points that differ from a center in up to ``flips`` bits."""
    rng = np.random.default_rng(seed)
    out = set()
    for _ in range(centers):
        center = int(rng.integers(-(1 << 63), (1 << 63) - 1))
        out.add(center)
        for _ in range(around):
            x = center & (1 << 64) - 1
            for b in rng.integers(0, 64, int(rng.integers(0, flips + 1))):
                x ^= 1 << int(b)
            out.add(x - (1 << 64) if x >> 63 else x)
    return sorted(out)


def test_grid_meets_every_pair_within_four_bits():
    rng = np.random.default_rng(1)
    a = rng.integers(-(1 << 63), (1 << 63) - 1, 300)
    for bits in range(5):
        b = a.copy()
        for i in range(len(b)):
            for p in rng.choice(64, bits, replace=False):
                b[i] ^= np.int64(np.uint64(1 << int(p)).view(np.int64) if hasattr(np.uint64(0), "view") else 0)
        keys = []
        for points in (a, b):
            own = {}
            for key, fp, side in s.cell_rows(points):
                for k, f, d in zip(key.tolist(), fp.tolist(), side.tolist()):
                    own.setdefault(f, set()).add((k, d))
            keys.append(own)
        for x, y in zip(a.tolist(), b.tolist()):
            left, right = keys[0][x], keys[1][y]
            assert any(k == m and (d != e or d == 3) for k, d in left for m, e in right)


def frame(spark, points):
    return spark.createDataFrame([(p,) for p in points], StructType([StructField("fp", LongType())]))


def labels(spark, points, **options):
    found = {r["fp"]: r["label"] for r in s.components(s.link_forest(frame(spark, points), **options)).collect()}
    return {p: found.get(p, p) for p in points}


def test_components_equal_brute_force(spark):
    points = cloud(2, 12, 40, 5) + cloud(3, 200, 0, 0) + [0, 1, 3, -1]
    points = sorted(set(points))
    assert labels(spark, points) == brute_components(points)


def test_large_cells_go_out_in_blocks(spark):
    points = cloud(4, 1, 300, 4)
    assert labels(spark, points, block=16) == brute_components(points)


def test_chain_of_links(spark):
    points = [sum(1 << b for b in range(2 * i)) for i in range(1, 32)]
    points = [p - (1 << 64) if p >> 63 else p for p in points]
    assert labels(spark, points) == brute_components(points)


def test_forest_has_no_more_edges_than_points(spark):
    points = cloud(6, 1, 400, 2)
    assert s.link_forest(frame(spark, points)).count() < 40 * len(points)


def test_query_equals_brute_force(spark, real_docs):
    rows = queries.op6_simhash_dedup(spark, "/root/testdata/sf0.001").collect()
    texts = {r["doc_id"]: r["text"] for r in real_docs.collect()}
    assert len(rows) == len(texts)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    fps = {k: brute_fp(t) for k, t in texts.items()}
    label = brute_components({signed(f) for f in fps.values()})
    smallest = {}
    for k, f in fps.items():
        smallest[label[signed(f)]] = min(k, smallest.get(label[signed(f)], k))
    for r in rows:
        assert r["fingerprint"] == f"{fps[r['doc_id']]:016x}"
        assert r["component_id"] == smallest[label[signed(fps[r["doc_id"]])]]


def test_nulls_repeats_empty(spark, docs_of, odd_texts):
    rows = s.near_duplicates(docs_of(odd_texts)).collect()
    assert len(rows) == len(odd_texts)
    by_fp = {r["doc_id"]: r for r in rows}
    assert by_fp[1]["fingerprint"] == by_fp[3]["fingerprint"] == "0" * 16 and by_fp[2]["component_id"] == 1
    assert next(r for r in rows if r["doc_id"] is None)["component_id"] is None
    assert s.near_duplicates(docs_of([])).collect() == []


def test_keep_one(docs_of, odd_texts):
    text = "one two three four five six seven eight nine ten"
    docs = docs_of([*odd_texts, (50, text), (40, text), (40, text), (None, "only null ids"), (None, "only null ids")])
    docs = docs.withColumnRenamed("source", "fp")
    kept = s.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 4, 5, 6, 7, 8, 9, 10, 10, 40]
    assert ids.count(None) == 2
    assert s.keep_one(docs_of([])).count() == 0
