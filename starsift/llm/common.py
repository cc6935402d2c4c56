"""Helpers the operators of this folder share: batch-wise text maps, words, digests."""

from __future__ import annotations

import ctypes
import gc
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: UTF-8 bytes of text handled at once inside a task; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20
#: Rows that Spark hands to a task at once; whole texts are long.
BATCH_ROWS = 1000

TextRows = Callable[[list[bytes]], dict[str, list]]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def byte_table(keep: Callable[[int], bool]) -> bytes:
    """Translation of ASCII bytes: A-Z lower-cased, bytes that ``keep`` refuses to a space."""
    lowered = [b + 32 if 65 <= b <= 90 else b for b in range(256)]
    return bytes(b if b >= 0x80 or keep(b) else 0x20 for b in lowered)


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with at most ``limit`` text bytes (one row at least)."""
    sizes = pc.binary_length(batch.column(text)).to_pylist()
    start = total = 0
    for i, n in enumerate(sizes):
        n = n or 0
        if i > start and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield batch.slice(start)


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch, and with it what both sides of a Python task hold."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def give_back() -> None:
    """Return what a finished task freed to the system: idle workers stay for the next task, beside the JVM's heap."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


#: Rows of arrays that tasks hand on to be added up.
ARRAY_ROWS = "key int, v binary"


def array_rows(arrays: dict[int, np.ndarray]) -> pa.RecordBatch:
    """Arrays of whole numbers by key, as ``ARRAY_ROWS``."""
    held = [v.astype(np.int64).tobytes() for v in arrays.values()]
    return pa.RecordBatch.from_arrays([pa.array(list(arrays), pa.int32()), pa.array(held, pa.binary())], ["key", "v"])


def array_sums(parts: DataFrame) -> dict[int, np.ndarray]:
    """Sum of the arrays of each key; tasks add up as rows come in, so only one array a key reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                one = np.frombuffer(v.as_buffer(), np.int64)
                total[k] = total[k] + one if k in total else one.copy()
        yield array_rows(total)

    small_batches(parts.sparkSession)
    rows = parts.repartition("key").mapInArrow(run, ARRAY_ROWS).collect()
    return {r["key"]: np.frombuffer(bytes(r["v"]), np.int64) for r in rows}


def map_texts(df: DataFrame, text: str, keep: list[str], added: str, make: Callable[[], TextRows]) -> DataFrame:
    """Columns ``keep`` of ``df`` and the columns ``added`` (a DDL schema) computed from whole texts.

    ``make`` is called once in each task and returns the function from a list of
    texts (UTF-8 bytes, never null) to one list for each added column. A null text
    counts as empty. Rows stay in their partitions and in order: no shuffle, and
    memory is bounded by ``SLICE_BYTES`` and ``BATCH_ROWS``, or the longest single text.
    The session's limit on rows of an Arrow batch is lowered to the latter.
    """
    small_batches(df.sparkSession)
    clash = set(keep) & set(StructType.fromDDL(added).names)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are both kept and added")
    body = "__text"
    while body in keep:
        body += "_"
    # Columns travel under plain names: Spark's map resolves dots in names.
    plain = {c: f"__kept_{i}" for i, c in enumerate(keep)}
    source = df.select(*[F.col(f"`{c}`").alias(n) for c, n in plain.items()], F.col(f"`{text}`").cast("binary").alias(body))
    new = StructType.fromDDL(added)
    out = StructType([source.schema[n] for n in plain.values()] + new.fields)
    held = set(plain.values())
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = make()
        for batch in batches:
            for part in slices(batch, body):
                made = rows([t or b"" for t in part.column(body).to_pylist()])
                columns = [
                    part.column(f.name) if f.name in held else pa.array(made[f.name], type=f.type) for f in arrow
                ]
                fields = [
                    pa.field(f.name, c.type, True) for f, c in zip(arrow, columns, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields))
        give_back()

    return source.mapInArrow(run, out).toDF(*keep, *new.names)


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def crc_mod(column: str, n: int):
    """CRC-32 of a column's text, modulo n; null stays null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(n)

