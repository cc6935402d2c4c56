"""The prefix trie against a plain one, and its edge cases."""

import hashlib
import zlib

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from starsift.llm import conversation_trie, running

TURNS = StructType([StructField("conv_id", LongType()), StructField("turn", LongType()), StructField("role", StringType()), StructField("text", StringType())])


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def plain_trie(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs.setdefault(c, []).append(((turn is not None, turn or 0), role, digest(role, text), text))
    own = {c: [(r, t) for _, r, _, t in sorted(turns)] for c, turns in convs.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        rebuilt[c] = own.get(base, [])[:h] + turns[h:]
    nodes = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for path, members in nodes.items():
        kids = [p for p in nodes if len(p) == len(path) + 1 and p[: len(path)] == path]
        below = [p for p in nodes if p[: len(path)] == path]
        leaves = sum(not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in nodes) for p in below)
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = sorted(c for c in members if len(rebuilt[c]) == len(path))
        parent = min(nodes[path[:-1]]) if path else None
        out.append((min(members), len(path), parent, len(members), len(kids), leaves, saved, len(ends), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, **extra):
    df = spark.createDataFrame(rows, TURNS)
    for name, value in extra.items():
        df = df.withColumn(name, value)
    return sorted((tuple(r) for r in conversation_trie.prefix_trie(df).collect()), key=str)


def test_trie_equals_a_plain_one(spark):
    words = ["hi", "how are you", "", "été", "fine", "bye"]
    rows = [(c, t, ("user", "assistant")[t % 2], words[(c * c + t) % 3 if t < 4 else (c + t) % 6]) for c in range(-7, 40) for t in range(c % 8)]
    rows += [(50, None, "user", "first"), (50, 0, None, None), (50, 0, "a", "tie"), (50, 0, "a", "tie"), (50, 3, "user", "x"), (None, 1, "user", "nobody")]
    assert found(spark, rows) == plain_trie(rows)


def test_long_and_hot_conversations(spark):
    rows = [(5, t, "user", f"turn {t}") for t in range(300)] + [(c, t, "user", "same") for c in range(10, 60) for t in range(2)] + [(1, 0, "user", "x" * 200_000)]
    assert found(spark, rows) == plain_trie(rows)


def test_no_conversations(spark):
    assert found(spark, []) == [] and found(spark, [(None, 1, "user", "x")]) == []


def test_extra_columns(spark):
    from pyspark.sql import functions as F

    rows = [(1, 0, "user", "a"), (2, 0, "user", "a")]
    assert found(spark, rows, depth=F.lit(1), mark=F.lit("x"), conv=F.lit(9), **{"n.bytes": F.lit(2)}) == plain_trie(rows)


@pytest.mark.parametrize("parts", [1, 3])
def test_running_totals_cross_borders(spark, parts):
    rows = [(g, i, i % 4) for g, n in ((None, 5), ("a", 200), ("b", 1), ("", 30)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, i int, v int").repartition(parts)
    got = {(r["g"], r["i"]): r["v_total"] for r in running.running_totals(df, ["g"], ["i"], ["v"]).collect()}
    for g, i, _ in rows:
        assert got[(g, i)] == sum(v for h, j, v in rows if h == g and j <= i)
