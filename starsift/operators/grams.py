"""Words and neighbour pairs of a batch of texts, counted with array operations.

The bytes of all texts of a batch are looked at once; a word is a number among the
batch's distinct words from then on, and a pair is two of them in one integer. Texts
are taken in pieces of a bounded length, so memory follows a piece, not a partition.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Characters of text that are counted at once, about.
PIECE_CHARS = 4_000_000
#: Rows of counted grams that a task holds before it adds them up; half as many added up are passed on.
HELD_ROWS = 1_500_000
#: Rows of an Arrow batch that is passed on.
SENT_ROWS = 100_000

_WORD = np.zeros(256, bool)
_WORD[np.frombuffer(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz", np.uint8)] = True


def give_back() -> None:
    """Freed memory goes back to the system, as idle workers stay beside the JVM's heap."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(row, word number) of each word of two letters or more (``\\w\\w+``), in order, and the distinct words; nulls have none."""
    texts = texts.cast(pa.string()).fill_null("")
    _, ends, data = texts.buffers()
    if not len(texts) or data is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), pa.array([], pa.string())
    offsets = np.frombuffer(ends, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    offsets -= offsets[0]
    inside = _WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    start = np.flatnonzero(inside & (edge[:-1] | ~before))
    end = np.flatnonzero(inside & (edge[1:] | ~after)) + 1
    long = end - start >= 2
    start, end = start[long], end[long]
    turns = np.zeros(len(data) + 1, np.int8)
    turns[start] += 1
    turns[end] -= 1
    kept = np.cumsum(turns[:-1], dtype=np.int8).astype(bool)
    ends = np.concatenate(([0], np.cumsum(end - start))).astype(np.int32)
    found = pa.StringArray.from_buffers(len(start), pa.py_buffer(ends), pa.py_buffer(data[kept])).dictionary_encode()
    row = np.searchsorted(offsets, start, side="right") - 1
    return row, found.indices.to_numpy().astype(np.int64), found.dictionary


def pieces(texts: pa.Array, starts: np.ndarray | None = None) -> Iterator[tuple[int, int]]:
    """(from, to) of rows whose texts have ``PIECE_CHARS`` together, or one row; ``starts`` are the rows before which they may be cut."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.concatenate(([0], np.cumsum(lengths)))
    cuts = np.arange(len(texts) + 1) if starts is None else np.append(starts, len(texts))
    at = 0
    while at < len(texts):
        reach = np.searchsorted(total[cuts], total[at] + PIECE_CHARS, side="right") - 1
        nearest = np.searchsorted(cuts, at, side="right")
        to = int(cuts[max(reach, nearest)])
        yield at, to
        at = to


def sorted_counts(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and how often each occurs."""
    x = np.sort(x)
    starts = np.flatnonzero(np.concatenate((np.ones(min(len(x), 1), bool), x[1:] != x[:-1])))
    return x[starts], np.diff(np.append(starts, len(x)))


class GramStats:
    """Texts with each gram (df) and occurrences (cf), added up over pieces of text until they are taken out."""

    def __init__(self):
        self.ids: dict[str, int] = {}
        self.held: list[tuple[np.ndarray, ...]] = []
        self.rows = 0

    def add(self, texts: pa.Array) -> None:
        row, word, words = tokens(texts)
        own = np.fromiter((self.ids.setdefault(w, len(self.ids) + 1) for w in words.to_pylist()), np.int64, len(words))
        word = own[word]
        near = np.flatnonzero(row[1:] == row[:-1])
        listed = pa.array(np.concatenate([word << 32, word[near] << 32 | word[near + 1]])).dictionary_encode()
        gram, keys = listed.indices.to_numpy().astype(np.int64), listed.dictionary.to_numpy()
        once, _ = sorted_counts(np.concatenate([row, row[near]]) * len(keys) + gram)
        counts = [np.bincount(x, minlength=len(keys)).astype(np.int32) for x in (once % max(len(keys), 1), gram)]
        self.held.append((keys, *counts))
        self.rows += len(keys)
        if self.rows > HELD_ROWS:
            self._merge()

    def _merge(self) -> None:
        keys, df, cf = (np.concatenate(x) for x in zip((np.zeros(0, np.int64), *[np.zeros(0, np.int32)] * 2), *self.held, strict=True))
        order = np.argsort(keys)
        keys = keys[order]
        starts = np.flatnonzero(np.concatenate((np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1])))
        sums = [np.add.reduceat(x[order], starts) if len(starts) else x for x in (df, cf)]
        self.held = [(keys[starts], *sums)]
        self.rows = len(starts)

    def full(self) -> bool:
        """Whether what is held takes much memory though it is added up."""
        return self.rows > HELD_ROWS // 2 and len(self.held) == 1

    def taken(self) -> Iterator[pa.RecordBatch]:
        self._merge()
        words = pa.array(self.ids, pa.string())
        (keys, df, cf), self.ids, self.held, self.rows = self.held[0], {}, [], 0
        for at in range(0, len(keys), SENT_ROWS):
            part = slice(at, at + SENT_ROWS)
            first, second = keys[part] >> 32, keys[part] & 0xFFFFFFFF
            pair = second > 0
            names = words.take(pa.array(first - 1))
            both = pc.binary_join_element_wise(names, words.take(pa.array(np.maximum(second - 1, 0))), " ")
            yield pa.RecordBatch.from_arrays([pc.if_else(pa.array(pair), both, names), *(pa.array(x[part], pa.int64()) for x in (df, cf))], ["gram", "df", "cf"])


def partial_stats(texts: DataFrame) -> DataFrame:
    """(gram, df, cf) of a frame of texts, a gram being several rows that are still to be added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stats = GramStats()
        for batch in batches:
            column = batch.column(0)
            for a, b in pieces(column):
                stats.add(column[a:b])
                if stats.full():
                    yield from stats.taken()
        yield from stats.taken()
        give_back()

    return texts.mapInArrow(run, "gram string, df bigint, cf bigint")


@dataclass
class Known:
    """A vocabulary numbered from 0 on: its distinct ``words``, a gram as one integer of its words in ``keys`` (ascending), its number beside it; ``idf`` by number."""

    words: pa.Array
    keys: np.ndarray
    idx: np.ndarray
    idf: np.ndarray

    @classmethod
    def of(cls, parts: Iterable[pa.Table]) -> Known:
        """Of (gram, idx, idf) tables, which together have all numbers; one of them is in memory at a time."""
        ids: dict[str, int] = {}
        made = []
        for part in parts:
            split = pc.split_pattern(part["gram"].combine_chunks(), " ")
            flat = split.flatten().dictionary_encode()
            own = np.fromiter((ids.setdefault(w, len(ids)) for w in flat.dictionary.to_pylist()), np.int64, len(flat.dictionary))
            word, offsets = own[flat.indices.to_numpy()], split.offsets.to_numpy()
            pair = np.diff(offsets) == 2
            second = np.zeros(len(pair), np.int64)
            second[pair] = word[offsets[:-1][pair] + 1] + 1
            made.append((word[offsets[:-1]], second, part["idx"].to_numpy().astype(np.int32), part["idf"].to_numpy()))
        first, second, idx, idf = (np.concatenate(x) for x in zip(*made, strict=True))
        key = first * (len(ids) + 1) + second
        del made, first, second
        order = np.argsort(key)
        by_number = np.ones(len(key))
        by_number[idx] = idf
        return cls(pa.array(ids, pa.string()), key[order], idx[order], by_number)

    def weights(self, texts: pa.Array, group: np.ndarray, sublinear: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ends, idx, weight): the weights of groups of texts one after the other, numbers ascending, each group's of length 1."""
        n = int(group[-1]) + 1 if len(group) else 0
        row, word, words = tokens(texts)
        size = len(self.words) + 1
        own = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        word = own[word]
        lone, near = np.flatnonzero(word >= 0), np.flatnonzero((row[1:] == row[:-1]) & (word[1:] >= 0) & (word[:-1] >= 0))
        key = pa.array(np.concatenate([word[lone] * size, word[near] * size + word[near + 1] + 1])).dictionary_encode()
        wanted = key.dictionary.to_numpy()
        place = np.minimum(np.searchsorted(self.keys, wanted), max(len(self.keys) - 1, 0))
        number = np.where(self.keys[place] == wanted, self.idx[place], -1) if len(self.keys) else np.full(len(wanted), -1)
        found = number[key.indices.to_numpy()]
        hit = found >= 0
        many = max(len(self.keys), 1)
        cells, tf = sorted_counts(group[np.concatenate([row[lone], row[near]])[hit]] * many + found[hit])
        at, idx = np.divmod(cells, many)
        raw = (1.0 + np.log(tf) if sublinear else tf) * self.idf[idx]
        weight = raw / np.sqrt(np.bincount(at, raw * raw, n))[at]
        return np.concatenate(([0], np.cumsum(np.bincount(at, minlength=n)))).astype(np.int32), idx.astype(np.int32), weight


def by_key(batches: Iterator[pa.RecordBatch], key: str, text: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Pieces of rows that are ordered by ``key``, with the number of each row's key within the piece; a null is no key that two rows share."""
    rest: pa.Table | None = None

    def cut(table: pa.Table, last: bool) -> Iterator:
        nonlocal rest
        batch = table.combine_chunks().to_batches()[0]
        keys = batch.column(key)
        fresh = np.ones(len(keys), bool)
        fresh[1:] = pc.fill_null(pc.not_equal(keys[1:], keys[:-1]), True).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(fresh)
        upto = len(keys) if last else int(starts[-1])
        rest = None if last else table.slice(upto)
        for a, b in pieces(batch.column(text)[:upto], starts[starts < upto]):
            yield batch.slice(a, b - a), np.cumsum(fresh[a:b]) - 1

    for batch in batches:
        if batch.num_rows:
            own = pa.Table.from_batches([batch])
            yield from cut(own if rest is None else pa.concat_tables([rest, own]), False)
    if rest is not None:
        yield from cut(rest, True)


def lists(ends: np.ndarray, values: np.ndarray, group: np.ndarray, kind: pa.DataType) -> pa.Array:
    """The list of each row's group."""
    whole = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))
    return whole if len(group) == len(ends) - 1 else whole.take(pa.array(group))

