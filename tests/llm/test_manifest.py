"""The manifest against trees built by hand, and its edge cases."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from starsift.llm import merkle_manifest as m
from starsift.llm import queries


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    fields = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def tree(leaves):
    """(root, siblings of each leaf level by level)."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for i, place in enumerate(at):
            run = level[place // 8 * 8 : place // 8 * 8 + 8]
            paths[i].append((run[: place % 8], run[place % 8 + 1 :]))
            at[i] = place // 8
        level = [sha("".join(level[i : i + 8])) for i in range(0, len(level), 8)]
    return level[0], paths


def plain(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    ordered = {g: sorted(groups[g], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]))) for g in names}
    trees = {g: tree([leaf(r, r["text"]) for r in ordered[g]]) for g in names}
    root, above = tree([trees[g][0] for g in names])
    out = []
    for g, last in zip(names, above, strict=True):
        for r, path in zip(ordered[g], trees[g][1], strict=True):
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"]) if hit and r["text"] is not None else r["text"]
            node = leaf(r, text)
            for left, right in path + last:
                node = sha("".join(left) + node + "".join(right))
            proof = sha("".join("".join(left) + "".join(right) for left, right in path + last))
            out.append((r["doc_id"], leaf(r, r["text"]), trees[g][0], root, proof, node, node == root))
    return sorted(out, key=str)


def found(docs):
    rows = m.verify(m.manifest(docs, tampered=m.lower_cased_text(docs)))
    return sorted((tuple(r) for r in rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


@pytest.mark.parametrize("sizes", [(1,), (8, 1), (9, 64, 65), (600, 3)])
def test_manifest_equals_trees_by_hand(docs_of, sizes):
    docs = docs_of([(1000 * g + i, f"Text {i}", f"l{g}") for g, n in enumerate(sizes) for i in range(n)])
    assert found(docs) == plain(docs.collect())


def test_larger_trees_take_more_rounds(docs_of, monkeypatch):
    monkeypatch.setattr(m, "LEVELS", 1)
    monkeypatch.setattr(m, "BLOCK", 8)
    docs = docs_of([(i, f"Text {i}", "en" if i % 7 else "de") for i in range(700)])
    assert found(docs) == plain(docs.collect())


def test_odd_rows(docs_of, odd_texts):
    docs = docs_of([*odd_texts, (11, "x", None), (12, "y", ""), (12, "y", ""), (None, None, None)])
    docs = docs.withColumn("grp", F.lit(1)).withColumn("root", F.lit("r")).withColumn("a.b", F.lit(2))
    assert found(docs) == plain(docs.collect())
    assert found(docs_of([])) == []


def test_query_finds_the_tampered_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = sorted((tuple(r) for r in queries.op13_merkle_manifest(spark, "/root/testdata/sf0.001").collect()), key=str)
    assert got == plain(docs.collect()) and any(not r[-1] for r in got) and any(r[-1] for r in got)
