"""TF-IDF over words and word pairs, as tables.

``docs`` has a unique key and a cleaned text. The texts are repartitioned by key
once; the exploded grams, many times their size, are then counted, weighted and
normalised in place, without another shuffle of them. A partition gets a bounded
length of text, so that its grams are counted and sorted in memory however large
the table is. ``WeightLists`` keeps the weights of a text together, as models read
them, and finds the grams of a vocabulary of bounded size in arrays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from starsift.functions.text import with_pairs, words
from starsift.operators.grams import Known, by_key, give_back, lists, partial_stats
from starsift.operators.ordering import running_before
from starsift.operators.vectors import packed, sparse_vectors, stage_vectors
from starsift.staging import stage

# A vocabulary of up to this many grams (tens of megabytes) is broadcast.
BROADCAST_GRAMS = 200_000
# One of up to this many is broadcast as arrays, some 25 bytes a gram.
ARRAY_GRAMS = 3_000_000
# Grams that reach the driver at once on the way there.
SENT_GRAMS = 500_000
# Characters of text in a partition, about; their grams take some hundred times that in memory.
PART_CHARS = 4_000_000
# The same where grams are counted in arrays, which take a bounded piece of it at a time.
ARRAY_PART_CHARS = 64_000_000


def grams_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, gram), one row per occurrence."""
    listed = docs.select(key, words(F.col(text)).alias("_words"))
    return listed.select(key, F.explode(with_pairs(F.col("_words"))).alias("gram"))


def size_of(docs: DataFrame, text: str, part_chars: int | None = None) -> tuple[int, int]:
    """Rows of ``docs``, and partitions that their texts are worth."""
    n, chars = docs.agg(F.count(F.lit(1)), F.sum(F.length(text).cast("bigint"))).first()
    return n, max(docs.sparkSession.sparkContext.defaultParallelism, -(-(chars or 0) // (part_chars or PART_CHARS)))


def placed_by_key(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(key, text).repartition(size_of(docs, text)[1], key)


def gram_counts(docs: DataFrame, key: str = "review_id", text: str = "review_body_clean") -> DataFrame:
    """(key, gram, tf)."""
    return grams_of(placed_by_key(docs, key, text), key, text).groupBy(key, "gram").agg(F.count(F.lit(1)).alias("tf"))


def vocabulary(
    docs: DataFrame,
    min_df: int = 10,
    max_df: float = 0.9,
    max_features: int | None = 50_000,
    text: str = "review_body_clean",
) -> DataFrame:
    """(gram, df, cf, idf): grams in at least ``min_df`` documents and at most the ``max_df`` share.

    Of those the ``max_features`` most frequent, the smaller gram first on ties.
    idf = ln((1 + n) / (1 + df)) + 1.

    A task adds up both frequencies of the grams of many texts before they are shuffled.
    Few texts are dealt out to all cores; many stay where they are, as shuffling them
    would take the disk of a copy.
    """
    n, parts = size_of(docs, text, ARRAY_PART_CHARS)
    few = parts <= docs.sparkSession.sparkContext.defaultParallelism
    each = partial_stats(docs.select(text).repartition(parts) if few else docs.select(text))
    stats = each.groupBy("gram").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))
    kept = stats.where((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df * n)))
    if max_features is not None:
        kept = kept.orderBy(F.desc("cf"), "gram").limit(max_features)
    return kept.withColumn("idf", F.log(F.lit(1.0 + n) / (F.col("df") + 1)) + 1)


def gram_index(vocab: DataFrame) -> DataFrame:
    """The vocabulary with ``idx``, the rank of a gram in byte order, from 0 on.

    Ranks come from range partitions and the sizes of those before, so a vocabulary of
    any size is numbered without meeting in one task or on the driver.
    """
    ranked = running_before(vocab.withColumn("_one", F.lit(1)), "gram", "_one", out="idx")
    return stage(ranked.withColumn("idx", F.col("idx").cast("int")).drop("_one"), "gram-index")


def tfidf(docs: DataFrame, vocab: DataFrame, sublinear: bool = True, key: str = "review_id", text: str = "review_body_clean") -> DataFrame:
    """(key, gram, tf, weight), and ``idx`` where the vocabulary has it; weights of one document having length 1.

    The vocabulary is written and counted: up to ``BROADCAST_GRAMS`` it is broadcast,
    and unknown grams fall out before they are counted; beyond, counts meet it by a
    shuffle. A document's grams are bounded by its own text, so the window over them
    is no larger than the row they came from.
    """
    about = [c for c in ("idx",) if c in vocab.columns]
    known = stage(vocab.select("gram", "idf", *about), "vocabulary")
    if known.count() <= BROADCAST_GRAMS:
        hits = grams_of(placed_by_key(docs, key, text), key, text).join(F.broadcast(known), "gram")
        counts = hits.groupBy(key, "gram", "idf", *about).agg(F.count(F.lit(1)).alias("tf"))
    else:
        counts = gram_counts(docs, key, text).join(known, "gram")
    tf = 1 + F.log("tf") if sublinear else F.col("tf")
    raw = counts.select(key, "gram", "tf", *about, (tf * F.col("idf")).alias("raw"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(key)))
    return raw.select(key, "gram", "tf", *about, (F.col("raw") / norm).alias("weight"))


@dataclass
class WeightLists:
    """A numbered vocabulary (``gram_index``) and the settings of its weights; ``known`` holds it as arrays where it is small enough."""

    index: DataFrame
    n_grams: int
    sublinear: bool
    known: Broadcast | None

    @classmethod
    def of(cls, index: DataFrame, sublinear: bool = True) -> WeightLists:
        n = index.count()
        if n > ARRAY_GRAMS:
            return cls(index, n, sublinear, None)
        parts = (index.select("gram", "idx", "idf").where(F.col("idx").between(at, at + SENT_GRAMS - 1)).toArrow() for at in range(0, max(n, 1), SENT_GRAMS))
        known = index.sparkSession.sparkContext.broadcast(Known.of(parts))
        give_back()
        return cls(index, n, sublinear, known)

    def of_rows(self, docs: DataFrame, key: str = "review_id", text: str = "review_body_clean", once: bool = False) -> DataFrame:
        """``docs`` without the text, with ``idx`` (ascending) and ``weight`` of its grams as lists; with ``once`` one row a key.

        As in ``tfidf``, texts that share a key are weighed together, and a row without a key has no weights.
        Only where keys repeat are the texts shuffled.
        """
        kept = [f for f in docs.schema.fields if f.name != text]
        schema = StructType([*kept, StructField("idx", ArrayType(IntegerType())), StructField("weight", ArrayType(DoubleType()))])
        if self.known is None:
            return self._joined(docs, key, text, once).select(*schema.names)
        names = [f.name for f in kept]

        def made(piece: pa.RecordBatch, group: np.ndarray, ends: np.ndarray, idx: np.ndarray, weight: np.ndarray) -> list[pa.Array]:
            if once:
                group, firsts = np.unique(group, return_index=True)
                piece = piece.take(pa.array(firsts))
            return [*(piece.column(c) for c in names), lists(ends, idx, group, pa.int32()), lists(ends, weight, group, pa.float64())]

        return self._mapped(docs, key, text, made, schema)

    def vectors_of(self, docs: DataFrame, numbers: Sequence[str] = (), key: str = "review_id", text: str = "review_body_clean") -> DataFrame:
        """``docs`` without the text and ``numbers``, with ``features``: the weights, and the numbers that are not 0 after them."""
        kept = [f for f in docs.schema.fields if f.name != text and f.name not in numbers]
        names, numbers, n = [f.name for f in kept], list(numbers), self.n_grams
        docs = docs.select(*names, text, *[F.col(c).cast("double").alias(c) for c in numbers])
        if self.known is None:
            tail = F.filter(F.array(*[F.struct(F.lit(n + i).alias("idx"), F.col(c).alias("weight")) for i, c in enumerate(numbers)]), lambda x: x["weight"] != 0)
            both = lambda c: F.concat(c, tail[c]) if numbers else F.col(c)
            vector = packed(F.lit(n + len(numbers)), both("idx"), both("weight")).alias("features")
            return stage_vectors(self._joined(docs, key, text, False).select(*names, vector), "packed-vectors")

        def made(piece: pa.RecordBatch, group: np.ndarray, ends: np.ndarray, idx: np.ndarray, weight: np.ndarray) -> list[pa.Array]:
            return [*(piece.column(c) for c in names), sparse(piece, numbers, n, lists(ends, idx, group, pa.int32()), lists(ends, weight, group, pa.float64()))]

        return self._mapped(docs, key, text, made, StructType([*kept, StructField("features", VectorUDT())]))

    def _mapped(self, docs: DataFrame, key: str, text: str, made: Callable[..., list[pa.Array]], schema: StructType) -> DataFrame:
        names, shared, sublinear = schema.names, self.known, self.sublinear

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for piece, group in by_key(batches, key, text):
                texts, keys = piece.column(text), piece.column(key)
                if keys.null_count:
                    texts = pa.array([t if k else None for t, k in zip(texts.to_pylist(), pc.is_valid(keys).to_pylist(), strict=True)], pa.string())
                weighed = shared.value.weights(texts, group, sublinear)
                yield pa.RecordBatch.from_arrays(made(piece, group, *weighed), names)
            give_back()

        return placed_if_repeated(docs, key, text).mapInArrow(run, schema)

    def _joined(self, docs: DataFrame, key: str, text: str, once: bool) -> DataFrame:
        weights = tfidf(docs, self.index, self.sublinear, key, text)
        pairs = weights.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("idx", "weight"))).alias("_pairs"))
        rows = docs.drop(text)
        found = (rows.dropDuplicates([key]) if once else rows).join(pairs, key, "left")
        either = lambda c, kind: F.coalesce(F.col(f"_pairs.{c}"), F.array().cast(f"array<{kind}>")).alias(c)
        return found.select(*rows.columns, either("idx", "int"), either("weight", "double"))


def sparse(rows: pa.RecordBatch, numbers: list[str], n_grams: int, idx: pa.ListArray, weight: pa.ListArray) -> pa.StructArray:
    """Lists of weights and the columns ``numbers`` of their rows as vectors are stored."""
    n, size = len(rows), n_grams + len(numbers)
    at, values = idx.flatten().to_numpy(), weight.flatten().to_numpy()
    row = np.repeat(np.arange(n), pc.list_value_length(idx).to_numpy())
    if numbers:
        columns = np.stack([pc.fill_null(rows.column(c), 0.0).to_numpy(zero_copy_only=False) for c in numbers], axis=1)
        own, which = np.nonzero(columns)
        row, at, values = np.concatenate([row, own]), np.concatenate([at, which + n_grams]), np.concatenate([values, columns[own, which]])
        order = np.argsort(row, kind="stable")
        row, at, values = row[order], at[order], values[order]
    return sparse_vectors(size, np.concatenate(([0], np.cumsum(np.bincount(row, minlength=n)))), at, values)


def placed_if_repeated(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``docs`` with the rows of a key one after the other; as they are where no key repeats."""
    n, keys, nulls = docs.agg(F.count(F.lit(1)), F.count_distinct(key), F.count_if(F.col(key).isNull())).first()
    if n == keys + nulls:
        return docs
    return docs.repartition(size_of(docs, text, ARRAY_PART_CHARS)[1], key).sortWithinPartitions(key)
