"""Token ids packed into fixed-length rows by best-fit decreasing.

Each partition packs its own documents, so nothing is shuffled: it tokenizes until
``BLOCK_TOKENS`` are held, packs the pieces by falling length, each into the
fullest row that still takes it (a segment tree over free capacities finds that in
log time), writes the rows and goes on. Documents longer than a row are cut into
full rows and one rest, in order; no token is dropped and none is repeated.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from starsift.llm.common import slices
from starsift.llm.words import word_memo

ROW_TOKENS = 2048
#: Tokens a task packs at once: 32-bit ids, so 8 MB.
BLOCK_TOKENS = 2_000_000
#: Words whose ids a task remembers, twice over at most, some 200 bytes each.
MEMO_WORDS = 800_000

PACKED = (
    "pack_id bigint, n_tokens int, input_ids binary, position_ids binary, cu_seqlens array<int>,"
    " doc_ids array<bigint>, piece_offsets array<bigint>"
)


class Capacities:
    """Segment tree over free capacities 0..size: which of them some row has."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.held = [0] * (2 * self.leaves)

    def change(self, capacity: int, by: int) -> None:
        node = capacity + self.leaves
        while node:
            self.held[node] += by
            node >>= 1

    def smallest_from(self, capacity: int) -> int:
        """Smallest held capacity that is at least ``capacity``; -1 if none."""
        node = capacity + self.leaves
        if self.held[node]:
            return capacity
        while node > 1:
            if not node & 1 and self.held[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.held[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return -1


def best_fit_decreasing(lengths: list[int], size: int) -> list[list[int]]:
    """Rows of piece indexes; every piece has 1 to ``size`` tokens. Ties keep the given order."""
    tree = Capacities(size)
    rows: list[list[int]] = []
    free: dict[int, list[int]] = defaultdict(list)
    for piece in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        need = lengths[piece]
        capacity = tree.smallest_from(need)
        if capacity < 0:
            rows.append([piece])
            row, left = len(rows) - 1, size - need
        else:
            row = free[capacity].pop()
            tree.change(capacity, -1)
            rows[row].append(piece)
            left = capacity - need
        free[left].append(row)
        tree.change(left, 1)
    return rows


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    row_tokens: int = ROW_TOKENS,
    end_id: int = 49407,
    pad_id: int = 0,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row for each packed sequence of ``row_tokens`` ids.

    ``input_ids`` and ``position_ids`` are little-endian 32-bit rows of the id
    matrix, positions starting at 0 with each piece; ``cu_seqlens`` are cumulative
    piece lengths from 0 to ``n_tokens``, behind which ``pad_id`` fills the row.
    ``doc_ids`` and ``piece_offsets`` name each piece's document and its first token
    there. Every document ends in ``end_id``, so a null or empty text is that one
    token. Repeated document ids are separate documents; a null id stays null.
    """
    if row_tokens < 1:
        raise ValueError("row_tokens must be positive")
    arrow = to_arrow_schema(StructType.fromDDL(PACKED))
    source = docs.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("text")
    )

    def tokenized(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, np.ndarray]]:
        memo, end = word_memo(tokenizer_path, MEMO_WORDS), np.int32(end_id).tobytes()
        for batch in batches:
            for part in slices(batch, "text"):
                for key, body in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    yield key, np.frombuffer(memo.encode(body or b"") + end, np.int32)

    def packed(pieces: list, serial: int) -> tuple[pa.RecordBatch, int]:
        columns: dict[str, list] = {name: [] for name in arrow.names}
        for row in best_fit_decreasing([len(p[2]) for p in pieces], row_tokens):
            own = [pieces[i] for i in row]
            lengths = [len(p[2]) for p in own]
            ids = np.full(row_tokens, pad_id, "<i4")
            places = np.zeros(row_tokens, "<i4")
            ends = np.cumsum([0, *lengths])
            for (_, _, tokens), at in zip(own, ends.tolist(), strict=False):
                ids[at : at + len(tokens)] = tokens
                places[at : at + len(tokens)] = np.arange(len(tokens))
            columns["pack_id"].append(serial)
            columns["n_tokens"].append(int(ends[-1]))
            columns["input_ids"].append(ids.tobytes())
            columns["position_ids"].append(places.tobytes())
            columns["cu_seqlens"].append(ends.tolist())
            columns["doc_ids"].append([p[0] for p in own])
            columns["piece_offsets"].append([p[1] for p in own])
            serial += 1
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in arrow], schema=arrow), serial

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = TaskContext.get().partitionId() << 40
        pieces, held = [], 0
        for key, ids in tokenized(batches):
            for at in range(0, len(ids), row_tokens):
                pieces.append((key, at, ids[at : at + row_tokens]))
                held += len(pieces[-1][2])
                if held >= block_tokens:
                    batch, serial = packed(pieces, serial)
                    yield batch
                    pieces, held = [], 0
        if pieces:
            yield packed(pieces, serial)[0]

    return source.mapInArrow(run, PACKED)


def write_packed(packed: DataFrame, path: str) -> None:
    """Write packed rows as Parquet, one file for each task."""
    packed.write.mode("overwrite").parquet(path)


def read_pieces(spark: SparkSession, path: str) -> DataFrame:
    """Written pieces as (doc_id, piece_offset, ids as little-endian bytes), the padding cut off."""
    rows = spark.read.parquet(path)
    part = F.posexplode(F.arrays_zip("doc_ids", "piece_offsets"))
    cut = rows.select("input_ids", "cu_seqlens", part.alias("at", "piece"))
    begin, end = F.get("cu_seqlens", F.col("at")), F.get("cu_seqlens", F.col("at") + 1)
    ids = F.substring("input_ids", 4 * begin + 1, 4 * (end - begin))
    return cut.select(
        F.col("piece.doc_ids").alias("doc_id"), F.col("piece.piece_offsets").alias("piece_offset"), ids.alias("ids")
    )
