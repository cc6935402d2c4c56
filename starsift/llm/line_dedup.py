"""Line dedup that can be undone: reference counts of lines, and cuckoo filters of the frequent ones.

A line is known by its key, the line without blanks around it, letters A-Z in lower
case; a key is held as 128 bits. The counts say in how many documents each key is: the
documents that come add to them, those that go are taken off, and a key without
documents leaves the table. Keys in ``min_docs`` documents or more are in cuckoo
filters, one for each shard of the keys, from which keys can be taken out again, so an
index that lost documents drops the same lines as one that never had them.

A filter keeps a 32-bit tag of a key and may take a rare key for a frequent one. All
lines of the indexed documents are in the counts, so those rare keys are listed beside
the filters once, and what the filters say of an indexed document is exact. Filters up
to ``BROADCAST_BYTES`` go to all tasks and lines never leave their task; beyond, lines
meet the filter of their shard by a shuffle of keys.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from starsift.llm.common import fresh_name, map_texts, slices
from starsift.staging import stage

MIN_DOCS = 10
MIN_CHARS = 1
#: Keys of a shard, about; a shard has one filter, made by one task. Shards double with the keys.
SHARD_KEYS = 1 << 19
#: Filters and lists of exceptions up to this size are broadcast.
BROADCAST_BYTES = 64 << 20
#: Tags of a bucket, and the tags moved for one insertion before the table is doubled.
SLOTS, KICKS = 4, 500
BLANK = b" \t\n\v\f\r"


# --- keys of lines -----------------------------------------------------------


def line_keys(text: bytes, min_chars: int = MIN_CHARS) -> tuple[list[bytes], list[bytes]]:
    """The lines of a text, and for each its 16-byte key; a line of fewer than ``min_chars`` code points has an empty one."""
    import xxhash

    lines = text.split(b"\n")
    digest = xxhash.xxh3_128_digest
    keys = []
    for bare in text.lower().split(b"\n"):
        bare = bare.strip(BLANK)
        size = len(bare) if min_chars <= 1 else len(bare.decode("utf-8", "replace"))
        keys.append(digest(bare) if size >= min_chars else b"")
    return lines, keys


def halves(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


def document_keys(docs: DataFrame, text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(hi, lo): one row for each document and each different key of it."""

    def make():
        def rows(texts: list[bytes]) -> dict[str, list]:
            return {"keys": [b"".join(sorted({k for k in line_keys(t, min_chars)[1] if k})) for t in texts]}

        return rows

    packed = map_texts(docs, text, [], "keys binary", make)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hi, lo = halves(batch.column("keys").to_pylist())
            for at in range(0, len(hi), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(hi[at : at + 50_000]), pa.array(lo[at : at + 50_000])], ["hi", "lo"])

    return packed.mapInArrow(split, "hi bigint, lo bigint")


def key_counts(docs: DataFrame, text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(hi, lo, n): in how many documents each key is. Summed before it is shuffled, so a line of all documents is one row a task."""
    return document_keys(docs, text, min_chars).groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("n"))


# --- cuckoo filters ----------------------------------------------------------


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix of unsigned integers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class CuckooFilter:
    """Partial-key cuckoo hashing of 128-bit keys: a 32-bit tag of ``lo`` in one of two buckets of ``hi``.

    Equal keys are to be inserted once. Tags are never 0, which marks an empty slot.
    """

    def __init__(self, buckets: int):
        self.tags = np.zeros((1 << max(0, int(buckets - 1).bit_length()), SLOTS), np.uint32)

    @classmethod
    def of(cls, hi: np.ndarray, lo: np.ndarray) -> CuckooFilter:
        """A filter of all these keys, at most 80 % full."""
        filled = cls(int(len(hi) / (0.8 * SLOTS)) + 1)
        filled.insert(hi, lo)
        return filled

    @classmethod
    def loads(cls, data: bytes) -> CuckooFilter:
        filled = cls(1)
        filled.tags = np.frombuffer(data, "<u4").reshape(-1, SLOTS).copy()
        return filled

    def dumps(self) -> bytes:
        return self.tags.astype("<u4").tobytes()

    @staticmethod
    def tag_of(lo: np.ndarray) -> np.ndarray:
        return np.maximum(lo.astype(np.int64).view(np.uint64) >> np.uint64(32), np.uint64(1)).astype(np.uint32)

    def places(self, hi: np.ndarray, tag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mask = np.uint64(len(self.tags) - 1)
        first = mixed(hi.astype(np.int64).view(np.uint64)) & mask
        return first.astype(np.int64), self.other(first.astype(np.int64), tag)

    def other(self, place: np.ndarray, tag: np.ndarray) -> np.ndarray:
        mask = np.uint64(len(self.tags) - 1)
        return ((place.astype(np.uint64) ^ mixed(tag.astype(np.uint64))) & mask).astype(np.int64)

    def contains(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        tag = self.tag_of(lo)
        one, two = self.places(hi, tag)
        return ((self.tags[one] == tag[:, None]) | (self.tags[two] == tag[:, None])).any(axis=1)

    def insert(self, hi: np.ndarray, lo: np.ndarray) -> None:
        """Add keys; raises OverflowError where a key finds no slot, and the filter is then to be built anew, larger."""
        tag = self.tag_of(lo)
        one, two = self.places(hi, tag)
        left = np.arange(len(tag))
        for place in (one, two):
            left = left[~self._fill(place[left], tag[left])]
        rng = np.random.default_rng(len(self.tags))
        for t, at in zip(tag[left].tolist(), one[left].tolist(), strict=True):
            for _ in range(KICKS):
                slot = int(rng.integers(SLOTS))
                t, self.tags[at, slot] = int(self.tags[at, slot]), t
                tags = np.array([t], np.uint32)
                where = self.other(np.array([at]), tags)
                if self._fill(where, tags)[0]:
                    break
                at = int(where[0])
            else:
                raise OverflowError("the filter is full")

    def _fill(self, place: np.ndarray, tag: np.ndarray) -> np.ndarray:
        """Put tags into free slots of their places; which found one."""
        order = np.argsort(place, kind="stable")
        sorted_ = place[order]
        nth = np.arange(len(order)) - np.searchsorted(sorted_, sorted_)  # how many before it want the same place
        taken = self.tags[sorted_] != 0
        fits = nth < SLOTS - taken.sum(axis=1)
        slot = np.argsort(taken, axis=1, kind="stable")[np.arange(len(order)), np.minimum(nth, SLOTS - 1)]
        self.tags[sorted_[fits], slot[fits]] = tag[order][fits]
        found = np.zeros(len(tag), bool)
        found[order[fits]] = True
        return found

    def delete(self, hi: np.ndarray, lo: np.ndarray) -> None:
        """Take keys out; each must have been inserted."""
        tag = self.tag_of(lo)
        for t, *places in zip(tag.tolist(), *(p.tolist() for p in self.places(hi, tag)), strict=True):
            for place in places:
                held = np.flatnonzero(self.tags[place] == t)
                if len(held):
                    self.tags[place, held[0]] = 0
                    break
            else:
                raise KeyError("the key is not in the filter")


class FilterSet:
    """The filters of all shards as one table."""

    def __init__(self, rows: list[tuple[int, bytes, list[int], list[int]]], shards: int):
        tables = {shard: np.frombuffer(tags, "<u4").reshape(-1, SLOTS) for shard, tags, _, _ in rows}
        empty = np.zeros((1, SLOTS), np.uint32)
        parts = [tables.get(i, empty) for i in range(shards)]
        self.tags = np.concatenate(parts)
        sizes = np.array([len(p) for p in parts], np.int64)
        self.mask, self.start = (sizes - 1).astype(np.uint64), np.cumsum(sizes) - sizes
        self.wrong = {np.array([h, low], "<i8").tobytes() for _, _, his, lows in rows for h, low in zip(his, lows, strict=True)}

    def frequent(self, keys: list[bytes]) -> np.ndarray:
        """Which keys are frequent; an empty key never is."""
        out = np.zeros(len(keys), bool)
        at = np.flatnonzero(np.fromiter(map(bool, keys), bool, len(keys)))
        if not len(at):
            return out
        hi, lo = halves([keys[i] for i in at.tolist()])
        shard = shard_of(hi, len(self.start))
        mask, start = self.mask[shard], self.start[shard]
        tag = CuckooFilter.tag_of(lo)
        one = mixed(hi.view(np.uint64)) & mask
        two = (one ^ mixed(tag.astype(np.uint64))) & mask
        found = np.zeros(len(at), bool)
        for place in (one, two):
            found |= (self.tags[start + place.astype(np.int64)] == tag[:, None]).any(axis=1)
        if self.wrong:
            for i in np.flatnonzero(found).tolist():
                found[i] = keys[at[i]] not in self.wrong
        out[at] = found
        return out


def shard_of(hi: np.ndarray, shards: int) -> np.ndarray:
    """Shard of a key; ``shards`` is a power of two."""
    return (hi.astype(np.int64).view(np.uint64) & np.uint64(shards - 1)).astype(np.int64)


# --- the index ---------------------------------------------------------------


@dataclass(frozen=True)
class LineIndex:
    """Tables of one state: ``counts`` (hi, lo, n) of all keys, ``filters`` (shard, tags, wrong_hi, wrong_lo) of the frequent ones.

    ``wrong_…`` are the keys of the counts that a filter takes for frequent ones. Both
    are written tables; a state is never changed, so going back is keeping the older one.
    """

    counts: DataFrame
    filters: DataFrame
    shards: int
    min_docs: int = MIN_DOCS
    min_chars: int = MIN_CHARS

    def save(self, folder: str) -> None:
        """Write the state to a folder that must not exist."""
        self.counts.write.parquet(f"{folder}/counts")
        self.filters.withColumns({n: F.lit(getattr(self, n)) for n in ("shards", "min_docs", "min_chars")}).write.parquet(f"{folder}/filters")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> LineIndex:
        filters = spark.read.parquet(f"{folder}/filters")
        sizes = filters.select("shards", "min_docs", "min_chars").first()
        return cls(spark.read.parquet(f"{folder}/counts"), filters.drop("shards", "min_docs", "min_chars"), *(sizes or (1, MIN_DOCS, MIN_CHARS)))


FILTERS = "shard int, tags binary, wrong_hi array<bigint>, wrong_lo array<bigint>"


def refilter(state: DataFrame, old: DataFrame | None, min_docs: int) -> DataFrame:
    """Filters of a state (shard, hi, lo, n, was): keys that became frequent go in, those that no longer are come out.

    A filter that is full, or that is not there, is built from the counts of its shard.
    A task holds the keys of one shard, about ``SHARD_KEYS``.
    """

    def run(shard: int, table: pa.Table, before: pa.Table | None) -> pa.Table:
        hi, lo, n, was = (table.column(c).to_numpy() for c in ("hi", "lo", "n", "was"))
        often, had = n >= min_docs, was >= min_docs
        new, gone = often & ~had, had & ~often
        try:
            if before is None or not before.num_rows:
                raise OverflowError("no filter yet")
            filled = CuckooFilter.loads(before.column("tags")[0].as_py())
            filled.delete(hi[gone], lo[gone])
            filled.insert(hi[new], lo[new])
        except OverflowError:
            filled = CuckooFilter.of(hi[often], lo[often])
        wrong = filled.contains(hi, lo) & ~often & (n > 0)
        lists = [pa.array([x[wrong]], pa.list_(pa.int64())) for x in (hi, lo)]
        return pa.table([pa.array([shard], pa.int32()), pa.array([filled.dumps()], pa.binary()), *lists], ["shard", "tags", "wrong_hi", "wrong_lo"])

    rows = state.select("shard", "hi", "lo", "n", "was")
    if old is None:
        return rows.groupBy("shard").applyInArrow(lambda key, table: run(key[0].as_py(), table, None), FILTERS)
    both = rows.groupBy("shard").cogroup(old.groupBy("shard"))
    return both.applyInArrow(lambda key, left, right: run(key[0].as_py(), left, right), FILTERS)


def update(index: LineIndex | None, spark: SparkSession, added: DataFrame | None = None, removed: DataFrame | None = None, text: str = "text",
           min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, shard_keys: int = SHARD_KEYS) -> LineIndex:
    """The state after documents came and went; ``removed`` are rows with the texts they were added with.

    Every row is a document of its own, repeated ones too. Null and empty texts have no
    key. Removing what was never added raises an error when a count falls below 0. The
    thresholds are those of ``index`` where there is one.
    """
    if index is not None:
        min_docs, min_chars = index.min_docs, index.min_chars
    parts = [] if index is None else [index.counts.select("hi", "lo", F.col("n").alias("was"), F.lit(0).cast("bigint").alias("more"))]
    for docs, sign in ((added, 1), (removed, -1)):
        if docs is not None:
            counted = key_counts(docs, text, min_chars)
            parts.append(counted.select("hi", "lo", F.lit(0).cast("bigint").alias("was"), (F.col("n") * sign).alias("more")))
    if not parts:
        parts = [spark.createDataFrame([], "hi bigint, lo bigint, was bigint, more bigint")]
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    summed = table.groupBy("hi", "lo").agg(F.sum("was").alias("was"), (F.sum("was") + F.sum("more")).alias("n"))
    sure = F.when(F.col("n") < 0, F.raise_error(F.lit("a document was removed that the index does not have")).cast("bigint")).otherwise(F.col("n"))
    state = stage(summed.select("hi", "lo", "was", sure.alias("n")), "line-state")
    counts = state.where("n > 0").select("hi", "lo", "n")
    wanted = 1 << max(0, (-(-state.count() // shard_keys) - 1).bit_length())
    shards = wanted if index is None else max(wanted, index.shards)
    old = None if index is None or index.shards != shards else index.filters
    sharded = state.withColumn("shard", F.col("hi").bitwiseAND(shards - 1).cast("int"))
    return LineIndex(counts, stage(refilter(sharded, old, min_docs), "line-filters"), shards, min_docs, min_chars)


def build(docs: DataFrame, text: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> LineIndex:
    """The index of all ``docs``."""
    return update(None, docs.sparkSession, added=docs, text=text, min_docs=min_docs, min_chars=min_chars)


# --- dropping lines ----------------------------------------------------------

DROPPED = "n_lines bigint, n_dropped bigint, kept string"


def without(texts: list[bytes], frequent, min_chars: int) -> dict[str, list]:
    """Texts without the lines whose keys ``frequent`` (keys of all texts, text number of each) marks."""
    split = [line_keys(t, min_chars) for t in texts]
    owner = [i for i, (_, keys) in enumerate(split) for _ in keys]
    hit = frequent([k for _, keys in split for k in keys], owner)
    out, at = {"n_lines": [], "n_dropped": [], "kept": []}, 0
    for lines, _ in split:
        gone = hit[at : at + len(lines)]
        at += len(lines)
        out["n_lines"].append(len(lines))
        out["n_dropped"].append(int(gone.sum()))
        left = lines if not gone.any() else [line for line, g in zip(lines, gone.tolist(), strict=True) if not g]
        out["kept"].append(b"\n".join(left).decode("utf-8", "replace"))
    return out


def drop_lines(docs: DataFrame, index: LineIndex, keep: list[str], text: str = "text", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Columns ``keep`` with ``n_lines``, ``n_dropped`` and ``kept``, the text without the lines frequent in the index.

    Exact for documents the index holds. A null or empty text is one empty line, which
    is never dropped while ``min_chars`` is 1 or more. A text that loses all its lines
    is kept as an empty one. Repeated rows each get their row.
    """
    size = index.filters.agg(F.sum(F.length("tags") + 16 * F.size("wrong_hi"))).first()[0] or 0
    if size > broadcast_bytes:
        return dropped_by_join(docs, index, keep, text)
    rows = [tuple(r) for r in index.filters.select("shard", "tags", "wrong_hi", "wrong_lo").collect()]
    shared = docs.sparkSession.sparkContext.broadcast(rows)
    shards, min_chars = index.shards, index.min_chars

    def make():
        filters = FilterSet(shared.value, shards)
        return lambda texts: without(texts, lambda keys, _: filters.frequent(keys), min_chars)

    return map_texts(docs, text, keep, DROPPED, make)


def dropped_by_join(docs: DataFrame, index: LineIndex, keep: list[str], text: str = "text") -> DataFrame:
    """As ``drop_lines``, for filters that are too large to broadcast: the keys of each different text meet the counts.

    Texts are known by 128 bits. Both joins have a hot side only on the left and a
    unique key on the right, which adaptive execution splits.
    """
    min_chars = index.min_chars

    def make():
        import xxhash

        def rows(texts: list[bytes]) -> dict[str, list]:
            marks = [xxhash.xxh3_128_digest(t) for t in texts]
            parts = [halves(sorted({k for k in line_keys(t, min_chars)[1] if k})) for t in texts]
            return {"mark": marks, "hi": [hi.tolist() for hi, _ in parts], "lo": [lo.tolist() for _, lo in parts]}

        return rows

    frequent = index.counts.where(F.col("n") >= index.min_docs).select("hi", "lo")
    own = map_texts(docs, text, [], "mark binary, hi array<bigint>, lo array<bigint>", make)
    found = own.select("mark", F.explode(F.arrays_zip("hi", "lo")).alias("k")).select("mark", "k.hi", "k.lo").distinct()
    hits = found.join(frequent, ["hi", "lo"], "left_semi")
    by_text = hits.groupBy("mark").agg(F.collect_list(F.struct("hi", "lo")).alias("drop"))
    mark, drop, body = (fresh_name(docs, n) for n in ("text_mark", "drop_keys", "body"))

    def marks():
        import xxhash

        return lambda texts: {mark: [xxhash.xxh3_128_digest(t) for t in texts], body: [t.decode("utf-8", "replace") for t in texts]}

    marked = map_texts(docs, text, keep, f"`{mark}` binary, `{body}` string", marks)
    joined = marked.join(by_text.withColumnsRenamed({"mark": mark, "drop": drop}), mark, "left")
    plain = [f"kept_{i}" for i in range(len(keep))]
    joined = joined.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, plain, strict=True)], body, drop)
    held = set(plain)
    schema = StructType([*(joined.schema[n] for n in plain), *StructType.fromDDL(DROPPED).fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, body):
                sets = [{np.array([k["hi"], k["lo"]], "<i8").tobytes() for k in d or ()} for d in part.column(drop).to_pylist()]
                texts = [t.encode() for t in part.column(body).to_pylist()]
                new = without(texts, lambda keys, owner, sets=sets: np.array([k in sets[i] for k, i in zip(keys, owner, strict=True)], bool), min_chars)
                columns = [part.column(f.name) if f.name in held else pa.array(new[f.name], type=f.type) for f in arrow]
                yield pa.RecordBatch.from_arrays(columns, schema=pa.schema([pa.field(f.name, c.type) for f, c in zip(arrow, columns, strict=True)]))

    return joined.mapInArrow(run, schema).toDF(*keep, *StructType.fromDDL(DROPPED).names)


def dedup_lines(docs: DataFrame, keep: list[str], text: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``drop_lines`` of documents by the index of just these documents."""
    return drop_lines(docs, build(docs, text, min_docs, min_chars), keep, text)
