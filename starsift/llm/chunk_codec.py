"""BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash over the bytes cuts texts where their content says so, which makes a
passage shared by several documents fall into the same chunks wherever it stands.
One pass counts chunk hashes over all documents; the chunks whose reuse saves most
are encoded once and sent to every task as a dictionary of bounded size. All other
chunks are encoded where they stand, with a memo of their words.

Chunks end inside words, so ids at a join are not those of the whole text. Each
join is repaired: from the last stable cut (white space) of the left chunk to the
first of the right one the text is encoded again, and the two chunks' own ids must
agree, id for id, with a separate encoding of what is replaced. A chunk without a
stable cut widens the range to the next chunk; one that does not agree is encoded
anew. What comes out equals the encoding of the whole text.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsift.llm.common import map_texts
from starsift.llm.words import load_tokenizer, word_memo

MIN_CHUNK, MAX_CHUNK, MEAN_BITS = 256, 2048, 9
#: Bytes whose content decides on a cut; a power of two below MIN_CHUNK.
HASH_BYTES = 16
#: Entries of the dictionary; with MAX_CHUNK it is bounded by 16 MB of text and its ids.
DICTIONARY_CHUNKS = 8_000

SPACES = b" \t\n\r"
BYTE_HASH = np.random.default_rng(7).integers(1 << 32, size=256, dtype=np.uint32)


def cut_points(data: bytes) -> np.ndarray:
    """Positions where the rolling hash of the bytes before allows a cut between two characters."""
    raw = np.frombuffer(data, np.uint8)
    rolled = BYTE_HASH[raw]
    width, factor = 1, 0x9E3779B1
    while width < HASH_BYTES:
        wider = rolled.copy()
        wider[width:] += rolled[:-width] * np.uint32(factor)
        rolled, width, factor = wider, 2 * width, factor * factor & 0xFFFFFFFF
    cut = (rolled[:-1] >> np.uint32(32 - MEAN_BITS)) == 0
    cut &= (raw[1:] & 0xC0) != 0x80
    return np.flatnonzero(cut) + 1


def split_texts(texts: list[bytes]) -> list[list[bytes]]:
    """The chunks of each text; they join to the text. Cuts depend on the text's own bytes only."""
    data = b"".join(texts)
    points = cut_points(data) if len(data) > MIN_CHUNK else np.zeros(0, np.int64)
    out, start = [], 0
    for text in texts:
        end = start + len(text)
        chunks, at = [], start
        inside = points[np.searchsorted(points, start + MIN_CHUNK) : np.searchsorted(points, end)].tolist()
        for point in [*inside, end]:
            while point - at > MAX_CHUNK:
                stop = at + MAX_CHUNK
                while data[stop] & 0xC0 == 0x80:
                    stop -= 1
                chunks.append(data[at:stop])
                at = stop
            if point - at >= MIN_CHUNK or point == end and point > at:
                chunks.append(data[at:point])
                at = point
        out.append(chunks)
        start = end
    return out


def chunk_hash(chunk: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(chunk) - (1 << 63)


def chunk_dictionary(docs: DataFrame, tokenizer_path: str, text: str = "text", entries: int = DICTIONARY_CHUNKS) -> dict:
    """Chunk -> ids (32-bit bytes) for the ``entries`` chunks whose reuse saves most bytes, each encoded once."""

    def counted():
        def rows(texts: list[bytes]) -> dict[str, list]:
            found = [Counter((chunk_hash(c), len(c)) for c in chunks) for chunks in split_texts(texts)]
            return {"chunks": [[{"hash": h, "bytes": b, "n": n} for (h, b), n in f.items()] for f in found]}

        return rows

    listed = map_texts(docs, text, [], "chunks array<struct<hash:bigint,bytes:int,n:int>>", counted)
    chunks = listed.select(F.inline("chunks")).groupBy("hash", "bytes").agg(F.sum("n").alias("n")).where("n > 1")
    best = chunks.orderBy(((F.col("n") - 1) * F.col("bytes")).desc(), "hash", "bytes").limit(entries)
    wanted = docs.sparkSession.sparkContext.broadcast({r["hash"] for r in best.select("hash").collect()})
    if not wanted.value:
        return {}

    def taken():
        seen = set()

        def rows(texts: list[bytes]) -> dict[str, list]:
            out = []
            for chunks in split_texts(texts):
                own = []
                for c in chunks:
                    h = chunk_hash(c)
                    if h in wanted.value and h not in seen:
                        seen.add(h)
                        own.append({"hash": h, "chunk": c})
                out.append(own)
            return {"chunks": out}

        return rows

    def encoded():
        memo = word_memo(tokenizer_path)
        return lambda texts: {"ids": list(map(memo.encode, texts))}

    own = map_texts(docs, text, [], "chunks array<struct<hash:bigint,chunk:binary>>", taken)
    once = own.select(F.inline("chunks")).groupBy("hash").agg(F.min("chunk").alias("chunk"))
    pairs = map_texts(once, "chunk", ["chunk"], "ids binary", encoded).collect()
    return {bytes(r["chunk"]): bytes(r["ids"]) for r in pairs}


def first_space(chunk: bytes) -> int:
    found = [i for i in map(chunk.find, (b" ", b"\t", b"\n", b"\r")) if i >= 0]
    return min(found, default=-1)


def last_space(chunk: bytes) -> int:
    return max(map(chunk.rfind, (b" ", b"\t", b"\n", b"\r")))


def join_chunks(chunks: list[bytes], ids_of, encode) -> bytes:
    """Ids of the joined chunks as 32-bit integers. ``ids_of`` gives a chunk's ids, ``encode`` those of any text."""
    ids: list[bytes] = []
    open_text = b""  # behind the last stable cut; not encoded yet
    for chunk in chunks:
        first, last = first_space(chunk), last_space(chunk)
        if first < 0:  # no stable cut in here: the repair widens to the next chunk
            open_text += chunk
            continue
        head, tail = (chunk[:first] if open_text else b""), chunk[last + 1 :]
        own = ids_of(chunk)
        head_ids, tail_ids = encode(head), encode(tail)
        agrees = own[: len(head_ids)] == head_ids and own[len(own) - len(tail_ids) :] == tail_ids
        middle = own[len(head_ids) : len(own) - len(tail_ids)] if agrees else encode(chunk[len(head) : last + 1])
        if open_text:
            ids.append(encode(open_text + head))
        ids.append(middle)
        open_text = tail
    return b"".join([*ids, encode(open_text)])


def encode_documents(
    docs: DataFrame, tokenizer_path: str, keep: list[str], text: str = "text", entries: int = DICTIONARY_CHUNKS
) -> DataFrame:
    """Columns ``keep`` with ``ids`` (array of int) and ``decoded``, the text those ids stand for.

    A null or empty text has no ids and decodes to the empty text. Repeated rows
    each get their row; an empty table gives an empty one. Special strings inside a
    text become their ids, as the tokenizers library has it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(chunk_dictionary(docs, tokenizer_path, text, entries))

    def make():
        memo, tokenizer = word_memo(tokenizer_path), load_tokenizer(tokenizer_path)

        def ids_of(chunk: bytes) -> bytes:
            known = shared.value.get(chunk)
            return memo.encode(chunk) if known is None else known

        def rows(texts: list[bytes]) -> dict[str, list]:
            ids = [np.frombuffer(join_chunks(c, ids_of, memo.encode), np.int32) for c in split_texts(texts)]
            return {"ids": ids, "decoded": [tokenizer.decode(i.tolist(), skip_special_tokens=False) for i in ids]}

        return rows

    return map_texts(docs, text, keep, "ids array<int>, decoded string", make)
