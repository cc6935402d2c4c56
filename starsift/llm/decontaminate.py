"""Benchmark decontamination with a generalised suffix automaton over test items.

The items' words become ids; one automaton holds every item and never runs across
the border of two. A document's words are streamed through it: the state keeps the
longest suffix read so far that occurs in an item. Where that length reaches a
window, the window's words are hit, and the items that hold it are known from the
state. Stretches that cannot reach a window (a pair of neighbouring words that no
item has) are passed over before streaming; this changes no result.

Items are dealt into automata of at most ``BLOCK_WORDS`` words, so what is sent to
the executors is bounded; each further block is one more pass over the documents.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsift.llm.common import byte_table, map_texts
from starsift.staging import stage

WINDOW = 10
#: Words in one automaton; it has at most twice as many states, some 300 bytes each.
BLOCK_WORDS = 250_000
#: A document loses its hit spans up to this share of its words and is dropped beyond it.
MAX_COVERAGE = 0.5

#: Word characters: digits, letters and everything beyond ASCII; A-Z are lower-cased.
WORDS = byte_table(lambda b: 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORDS).split()


@dataclass
class Automaton:
    """Suffix automaton of several word-id sequences, with the items that own each window.

    ``ends[state]`` lists (window length, item ids) for windows that are suffixes of
    every text the state stands for, once its matched length is at least that long.
    """

    ids: dict[bytes, int]
    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    ends: dict[int, list[tuple[int, frozenset]]] = field(default_factory=dict)
    pairs: np.ndarray | None = None
    shortest: int = WINDOW

    def _copy(self, of: int, length: int) -> int:
        self.step.append(dict(self.step[of]))
        self.link.append(self.link[of])
        self.length.append(length)
        return len(self.link) - 1

    def _redirect(self, state: int, word: int, old: int, new: int) -> None:
        while state >= 0 and self.step[state].get(word) == old:
            self.step[state][word] = new
            state = self.link[state]

    def extend(self, last: int, word: int) -> int:
        """The state of the current item's prefix, one word longer."""
        known = self.step[last].get(word)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            clone = self._copy(known, self.length[last] + 1)
            self.link[known] = clone
            self._redirect(last, word, known, clone)
            return clone
        self.step.append({})
        self.link.append(0)
        self.length.append(self.length[last] + 1)
        new, state = len(self.link) - 1, last
        while state >= 0 and word not in self.step[state]:
            self.step[state][word] = new
            state = self.link[state]
        if state >= 0:
            target = self.step[state][word]
            if self.length[target] != self.length[state] + 1:
                clone = self._copy(target, self.length[state] + 1)
                self.link[target] = clone
                self._redirect(state, word, target, clone)
                target = clone
            self.link[new] = target
        return new

    def advance(self, state: int, matched: int, word: int) -> tuple[int, int]:
        """Follow one word; the matched length is that of the longest suffix in an item."""
        while state and word not in self.step[state]:
            state = self.link[state]
            matched = self.length[state]
        state = self.step[state].get(word, 0)
        return (state, matched + 1) if state else (0, 0)

    def windows_at(self, state: int, matched: int):
        """(length, items) of every window that ends here."""
        while state > 0:
            for size, items in self.ends.get(state, ()):
                if size <= matched:
                    yield size, items
            state = self.link[state]
            matched = min(matched, self.length[state])


def window_of(n_words: int, window: int = WINDOW) -> int:
    """Window length of an item: shorter items are one window."""
    return min(window, n_words)


def build_automaton(items: list[tuple[str | None, list[bytes]]], window: int = WINDOW) -> Automaton:
    """Automaton of (item id, words); an item without words adds nothing, a null id owns no window."""
    ids: dict[bytes, int] = {}
    coded = [(i, [ids.setdefault(w, len(ids)) for w in words]) for i, words in items if words]
    auto = Automaton(ids)
    for _, seq in coded:
        last = 0
        for word in seq:
            last = auto.extend(last, word)
    owners: dict[tuple[int, int], set] = {}
    for item, seq in coded:
        size = window_of(len(seq), window)
        state = matched = 0
        for at, word in enumerate(seq):
            state, matched = auto.advance(state, matched, word)
            if at + 1 >= size:
                top, reach = state, matched
                while auto.length[auto.link[top]] >= size:  # the state whose suffixes include the window's length
                    top = auto.link[top]
                owners.setdefault((top, size), set()).update(() if item is None else (item,))
    for (state, size), own in owners.items():
        auto.ends.setdefault(state, []).append((size, frozenset(own)))
    auto.shortest = min((window_of(len(seq), window) for _, seq in coded), default=window)
    n = len(ids) + 1
    auto.pairs = np.unique(np.array([a * n + b for _, s in coded for a, b in zip(s, s[1:])], dtype=np.int64))
    return auto


def stretches(auto: Automaton, seq: np.ndarray) -> list[tuple[int, int]]:
    """Half-open ranges in which every neighbouring pair occurs in an item and a window may fit."""
    known = seq >= 0
    if auto.shortest == 1:
        edges = np.flatnonzero(np.diff(np.concatenate(([0], known.view(np.int8), [0]))))
        return list(zip(edges[::2].tolist(), edges[1::2].tolist()))
    code = seq[:-1] * (len(auto.ids) + 1) + seq[1:]
    at = np.minimum(np.searchsorted(auto.pairs, code), len(auto.pairs) - 1)
    paired = known[:-1] & known[1:] & (auto.pairs[at] == code)
    edges = np.flatnonzero(np.diff(np.concatenate(([0], paired.view(np.int8), [0]))))
    first, end = edges[::2], edges[1::2] + 1
    fit = end - first >= auto.shortest
    return list(zip(first[fit].tolist(), end[fit].tolist()))


def find_hits(auto: Automaton, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
    """Word ranges covered by windows (merged, half-open) and the items they come from."""
    spans: list[tuple[int, int]] = []
    items: set[str] = set()
    if not auto.ends or not words:
        return spans, items
    seq = np.fromiter(map(auto.ids.get, words, repeat(-1)), np.int64, len(words))
    for first, end in stretches(auto, seq):
        state = matched = 0
        for at in range(first, end):
            state, matched = auto.advance(state, matched, int(seq[at]))
            if matched < auto.shortest:
                continue
            longest = 0
            for size, own in auto.windows_at(state, matched):
                longest = max(longest, size)
                items |= own
            if longest:
                begin = at + 1 - longest
                while spans and spans[-1][1] >= begin:
                    begin = min(begin, spans.pop()[0])
                spans.append((begin, at + 1))
    return spans, items


def item_blocks(items: DataFrame, item_id: str = "item_id", text: str = "text", block_words: int = BLOCK_WORDS):
    """Yield lists of (item id as text, words) with at most ``block_words`` words, or one item.

    Rows arrive one partition at a time; the driver holds one block.
    """
    block, total = [], 0
    rows = items.select(F.col(f"`{item_id}`").cast("string").alias("i"), F.col(f"`{text}`").cast("binary").alias("t"))
    for row in rows.toLocalIterator():
        words = words_of(bytes(row["t"] or b""))
        if not words:
            continue
        if block and total + len(words) > block_words:
            yield block
            block, total = [], 0
        block.append((row["i"], words))
        total += len(words)
    if block:
        yield block


MARKS = "n_words bigint, hit_spans array<struct<first:int,end:int>>, item_ids array<string>"


def mark_contamination(
    docs: DataFrame,
    items: DataFrame,
    keep: list[str],
    text: str = "text",
    item_id: str = "item_id",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Columns ``keep`` with ``n_words``, ``hit_spans`` (word ranges, end exclusive) and ``item_ids``.

    Null or empty texts have no words, no spans and no items. No items, or none
    with words: nothing is hit. Repeated item rows count once; a null item id hits
    but is not listed. Repeated documents each get their row. Columns of ``docs``
    named like an added one may not be kept.
    """
    context = docs.sparkSession.sparkContext
    marked = None
    for block in item_blocks(items, item_id, text, block_words):
        auto = context.broadcast(build_automaton(block, window))
        rows = lambda auto=auto: lambda texts: marks(auto.value, texts)
        if marked is None:
            marked = map_texts(docs, text, list(dict.fromkeys([*keep, text])), MARKS, rows)
        else:
            marked = joined_marks(stage(marked, "marked"), text, rows)
    if marked is None:
        none = Automaton({})
        marked = map_texts(docs, text, list(dict.fromkeys([*keep, text])), MARKS, lambda: lambda texts: marks(none, texts))
    return marked.select(*keep, "n_words", "hit_spans", "item_ids")


def joined_marks(marked: DataFrame, text: str, rows) -> DataFrame:
    """Marks of one more block of items merged into those found so far."""
    before = marked.withColumnsRenamed({"n_words": "__n", "hit_spans": "__spans", "item_ids": "__items"})
    both = map_texts(before, text, before.columns, MARKS, rows)
    spans = F.array_sort(F.concat("__spans", "hit_spans"))
    merged = F.aggregate(
        spans,
        F.slice(spans, 1, 0),
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= s["first"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["first"].alias("first"),
                        F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )
    items = F.array_sort(F.array_union("__items", "item_ids"))
    return both.withColumns({"hit_spans": merged, "item_ids": items}).drop("__n", "__spans", "__items")


def marks(auto: Automaton, texts: list[bytes]) -> dict[str, list]:
    out: dict[str, list] = {"n_words": [], "hit_spans": [], "item_ids": []}
    for text in texts:
        words = words_of(text)
        spans, items = find_hits(auto, words)
        out["n_words"].append(len(words))
        out["hit_spans"].append([{"first": a, "end": b} for a, b in spans])
        out["item_ids"].append(sorted(items))
    return out


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the given word ranges; what stands between two of them stays."""
    if not spans:
        return text
    places = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(WORDS))]
    kept, at = [], 0
    for first, end in spans:
        kept.append(text[at : places[first][0]])
        at = places[end - 1][1]
    return b"".join([*kept, text[at:]])


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    max_coverage: float = MAX_COVERAGE,
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Documents without the spans of test items; those covered beyond ``max_coverage`` go.

    All columns stay; only ``text`` changes, and only where a window was found. A
    null text stays null. Other cases are those of ``mark_contamination``.
    """
    own = {c: f"d_{c}" for c in docs.columns}
    body = own[text]
    named = items.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{item_text}`").alias(body))
    marked = mark_contamination(
        docs.withColumnsRenamed(own), named, list(own.values()), body, "item_id", window, block_words
    )
    n_hit = F.aggregate("hit_spans", F.lit(0), lambda n, s: n + s["end"] - s["first"])
    kept = marked.where(n_hit <= max_coverage * F.col("n_words"))
    fields = kept.schema

    def cut(batches):
        for batch in batches:
            texts, spans = batch.column(body).to_pylist(), batch.column("hit_spans").to_pylist()
            new = [
                without_spans(t.encode(), [(s["first"], s["end"]) for s in found]).decode() if found else t
                for t, found in zip(texts, spans, strict=True)
            ]
            at = batch.schema.get_field_index(body)
            yield batch.set_column(at, body, pa.array(new, batch.schema.field(at).type))

    return kept.mapInArrow(cut, fields).select(*[F.col(f"`{new}`").alias(c) for c, new in own.items()])
