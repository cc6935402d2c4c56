"""Near-duplicates by SimHash, linked over a grid of segment popcounts.

A 64-bit fingerprint is embedded as the bit counts of 32 two-bit segments. The
Manhattan distance of two embeddings never exceeds the number of differing bits,
so a range join within that distance loses no link. The 32 coordinates are halved:
of two fingerprints within 4, the first halves lie within 2 or the second within 1.
So each fingerprint enters, for the first half, its own grid cell and the cells one
step away (two such sets meet if the halves lie within 2), and for the second half
its own cell as one side and those one step away as the other. Inside a cell the
distance of the whole embedding is the filter and the differing bits decide.

Equal fingerprints are one point before all this. A cell passes on a spanning
forest of its links, not the links; cells with many points are dealt out in pairs
of blocks. Components come from minimum labels over the forests.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsift.llm.common import byte_table, map_texts
from starsift.staging import stage

SHINGLE_WORDS = 4
MAX_BITS = 4
#: Points of a cell that one task compares with each other; larger cells are dealt out in blocks.
BLOCK = 1024

SPACES_APART = byte_table(lambda b: b != 0x20 and not 9 <= b <= 13)


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """SimHash of a text as a signed 64-bit number; no words: 0."""
    import xxhash

    parts = text.translate(SPACES_APART).split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = list(accumulate(len(p) + 1 for p in parts))
    starts = [0, *ends[:-1]]
    if len(parts) > words:
        spans = zip(starts, ends[words - 1 :], strict=False)
    else:
        spans = ((0, ends[-1]),)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a : b - 1], 42) for a, b in spans], np.dtype(">u8"))
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):  # a very long text in parts
        total += np.unpackbits(hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", added: str = "fp", words: int = SHINGLE_WORDS) -> DataFrame:
    """Columns ``keep`` and the fingerprint of each whole text; null and empty texts have 0."""
    return map_texts(docs, text, keep, f"`{added}` bigint", lambda: lambda texts: {added: [fingerprint(t, words) for t in texts]})


# --- grid cells --------------------------------------------------------------

MIX = np.random.default_rng(11).integers(1, 1 << 62, size=(2, 16), dtype=np.uint64) | np.uint64(1)


def popcounts(points: np.ndarray) -> np.ndarray:
    """Bit counts of the 32 two-bit segments."""
    bits = np.unpackbits(points.astype(">i8").view(np.uint8).reshape(-1, 8), axis=1)
    return bits[:, ::2] + bits[:, 1::2]


def cell_rows(points: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(cell key, point, side) arrays. Side 3 is compared with all, 1 with 2 and 3, 2 with 1 and 3.

    A cell's key is a linear hash of its coordinates: a step of one coordinate adds
    or takes that coordinate's factor. Cells that share a key cost comparisons only.
    """
    counts = popcounts(points)
    for half in (0, 1):
        own = counts[:, 16 * half : 16 * half + 16].astype(np.uint64)
        base = (own * MIX[half]).sum(axis=1, dtype=np.uint64) * np.uint64(2) + np.uint64(half)
        yield base, points, np.full(len(points), 3 if half == 0 else 1, np.int8)
        if half == 1:  # the other side of the second half holds the own cell as well
            yield base, points, np.full(len(points), 2, np.int8)
        for axis in range(16):
            move = MIX[half, axis] * np.uint64(2)
            up, down = own[:, axis] < 2, own[:, axis] > 0
            side = 3 if half == 0 else 2
            for fits, key in ((up, base + move), (down, base - move)):
                yield key[fits], points[fits], np.full(int(fits.sum()), side, np.int8)


def cells(points: DataFrame) -> DataFrame:
    """(cell, fp, side) of distinct fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                own = batch.column(0).slice(at, 2000).to_numpy(zero_copy_only=False)
                parts = list(cell_rows(own))
                key, fp, side = (np.concatenate([p[i] for p in parts]) for i in range(3))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(fp, pa.int64()), pa.array(side, pa.int8())], ["cell", "fp", "side"]
                )

    return points.select("fp").mapInArrow(run, "cell bigint, fp bigint, side tinyint")


# --- links inside cells ------------------------------------------------------


class Forest:
    """Union-find over fingerprints; the smallest of a tree is its root."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while (up := parent.get(x, x)) != top:
            parent[x] = top
            x = up
        return top

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def edges(self) -> list[tuple[int, int]]:
        return [(x, self.root(x)) for x in list(self.parent) if self.root(x) != x]


def close_pairs(a: np.ndarray, b: np.ndarray, limit: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs into two lists of fingerprints: embeddings within ``limit``, then bits within it."""
    left, right = popcounts(a).astype(np.int8), popcounts(b).astype(np.int8)
    out_a, out_b = [], []
    for at in range(0, len(a), 64):
        near = np.abs(left[at : at + 64, None, :] - right[None, :, :]).sum(axis=2) <= limit
        i, j = np.nonzero(near)
        i += at
        good = np.bitwise_count((a[i] ^ b[j]).view(np.uint64)) <= limit
        out_a.append(i[good])
        out_b.append(j[good])
    return np.concatenate(out_a), np.concatenate(out_b)


def link_sorted(key: np.ndarray, fp: np.ndarray, side: np.ndarray, forest: Forest, limit: int = MAX_BITS) -> None:
    """Add the links inside every run of equal keys. Rows are sorted by key."""
    edges = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
    sizes = np.diff(edges)
    group = np.repeat(np.arange(len(sizes)), sizes)
    small = sizes <= 64
    for step in range(1, min(64, int(sizes.max(initial=0)))):
        i = np.flatnonzero((group[:-step] == group[step:]) & small[group[:-step]])
        j = i + step
        differ = ((side[i] != side[j]) | (side[i] == 3)) & (fp[i] != fp[j])
        i, j = i[differ], j[differ]
        for at in range(0, len(i), 100_000):
            a, b = fp[i[at : at + 100_000]], fp[j[at : at + 100_000]]
            near = np.abs(popcounts(a).astype(np.int8) - popcounts(b).astype(np.int8)).sum(axis=1) <= limit
            a, b = a[near], b[near]
            close = np.bitwise_count((a ^ b).view(np.uint64)) <= limit
            for x, y in zip(a[close].tolist(), b[close].tolist(), strict=True):
                forest.join(x, y)
    for run in np.flatnonzero(~small).tolist():
        points = np.unique(fp[edges[run] : edges[run + 1]])
        link_block(points, points, forest, limit)


def link_block(a: np.ndarray, b: np.ndarray, forest: Forest, limit: int = MAX_BITS) -> None:
    """Join all links between two lists of fingerprints, comparing one from each tree first."""
    for at in range(0, len(a), 256):
        i, j = close_pairs(a[at : at + 256], b, limit)
        for x, y in zip(a[at : at + 256][i].tolist(), b[j].tolist(), strict=True):
            if x != y:
                forest.join(x, y)


def cell_forest(keyed: DataFrame, limit: int) -> DataFrame:
    """(a, b) tree edges of the links inside cells; rows are (cell, fp, side), sorted by cell in their partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        rest: list[np.ndarray] | None = None
        for batch in batches:
            now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if rest is not None:
                now = [np.concatenate(p) for p in zip(rest, now, strict=True)]
            last = int(np.searchsorted(now[0], now[0][-1], "left")) if len(now[0]) else 0
            link_sorted(*(c[:last] for c in now), forest, limit)
            rest = [c[last:] for c in now]
        if rest is not None:
            link_sorted(*rest, forest, limit)
        found = np.array(forest.edges(), np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

    return keyed.select("cell", "fp", "side").mapInArrow(run, "a bigint, b bigint")


def block_forest(dealt: DataFrame, limit: int) -> DataFrame:
    """(a, b) tree edges of the links inside a pair of blocks of one large cell."""

    def run(key, table):
        own, fp = table.column("own").to_numpy(), table.column("fp").to_numpy()
        first = np.unique(fp[own == key[1].as_py()])
        other = np.unique(fp[own == key[2].as_py()])
        forest = Forest()
        link_block(first, other, forest, limit)
        found = np.array(forest.edges(), np.int64).reshape(-1, 2)
        return pa.table([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

    return dealt.groupBy("cell", "one", "two").applyInArrow(run, "a bigint, b bigint")


def link_forest(points: DataFrame, limit: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Tree edges that connect exactly the fingerprints that links of ``limit`` bits connect."""
    if limit != MAX_BITS:
        raise ValueError(f"the grid is laid out for {MAX_BITS} bits")
    rows = cells(points)
    sized = rows.withColumn("n", F.expr("count(*) over (partition by cell)")).where("n > 1")
    sized = stage(sized, "cells")
    small = sized.where(F.col("n") <= block).repartition("cell").sortWithinPartitions("cell")
    large = sized.where(F.col("n") > block).select("cell", "fp", F.ceil(F.col("n") / block).cast("int").alias("blocks")).distinct()
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = large.withColumn("own", own).withColumn("with", other)
    dealt = dealt.select("cell", F.least("own", "with").alias("one"), F.greatest("own", "with").alias("two"), "own", "fp")
    return cell_forest(small, limit).unionByName(block_forest(dealt, limit)).distinct()


# --- components --------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(fp, label): the smallest fingerprint reachable, for every end of an edge.

    Each round takes the least label of the neighbours, then that label's own label;
    every round is written to the shared folder. It ends when no label changes.
    """
    edges = stage(edges, "edges")
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "fp"), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("fp", "b"), "b").groupBy(F.col("a").alias("fp")).agg(F.min("label").alias("near"))
        closer = labels.join(near, "fp").select("fp", "label", F.least("label", "near").alias("next"))
        up = labels.select(F.col("fp").alias("next"), F.col("label").alias("above"))
        jumped = closer.join(up, "next").select("fp", F.least("next", "above").alias("label"), (F.least("next", "above") < F.col("label")).alias("moved"))
        step = stage(jumped, "labels")
        labels = step.select("fp", "label")
        if step.where("moved").isEmpty():
            return labels


def component_ids(rows: DataFrame, ids: str = "doc_id", fp: str = "fp") -> DataFrame:
    """(fp, label, component_id): the smallest fingerprint that links reach, and the smallest id among its rows."""
    smallest = stage(rows.groupBy(F.col(fp).alias("fp")).agg(F.min(ids).alias("least")), "points")
    labels = components(link_forest(smallest))
    joined = smallest.join(labels, "fp", "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))
    heads = joined.groupBy("label").agg(F.min("least").alias("component_id"))
    return joined.join(heads, "label").select("fp", "label", "component_id")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """Every document as (doc_id, fingerprint, component_id).

    ``fingerprint`` is 16 hex digits. Null and empty texts share the fingerprint 0
    and are linked like any other. A null id is never a component's id unless all
    ids of the component are null. Repeated rows each get their row.
    """
    named = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = stage(fingerprints(named, ["doc_id"], "text", "fp", words), "fingerprints")
    found = rows.join(component_ids(rows), "fp")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", hexed.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """One document of each component, the one with the smallest id; all columns of ``docs``.

    Of rows that share that id, one is kept, by the smallest hash of the row. A
    component whose ids are all null keeps one row likewise.
    """
    own = {c: f"d_{c}" for c in docs.columns}
    key = f"d_{doc_id}"
    renamed = docs.withColumnsRenamed(own)
    hashed = renamed.withColumn("row_hash", F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in own.values()]))
    rows = fingerprints(hashed, [*own.values(), "row_hash"], f"d_{text}", "fp", words)
    light = stage(rows.select("fp", F.col(f"`{key}`").alias("doc_id"), "row_hash"), "fingerprints")
    groups = stage(component_ids(light), "groups")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_hash")
    winners = light.join(groups, "fp").groupBy("label").agg(F.min(order).alias("best"))
    winners = winners.select("best.doc_id", "best.row_hash").distinct()
    same = hashed[f"`{key}`"].eqNullSafe(winners["doc_id"]) & (hashed["row_hash"] == winners["row_hash"])
    kept = hashed.join(winners, same, "left_semi")
    return kept.dropDuplicates([key, "row_hash"]).select(*[F.col(f"`{new}`").alias(c) for c, new in own.items()])

