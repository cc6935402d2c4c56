"""Prefix trie of conversations by whole-sequence collapse.

Conversations that are the same from first to last turn are one weighted sequence
with a list of the conversations that end there. Sequences that another one extends
are found by an anti-join; the others are the leaves. Only one representative of a
sequence is spread out into its prefixes, and a node is the weighted sum over the
sequences that pass it.

A prefix is known by its length and by 128 bits, added up from a digest of each turn
and its position; sums of four 32-bit parts are running totals, so a conversation of
any length is spread over range partitions and never gathered. What a subtree saves
is a sum over sequences as well: a sequence of weight w adds w times the bytes from a
node to its end, and each turn of a distinct path is taken off once, by the sequence
whose smallest conversation is that of the node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starsift.llm.common import small_batches
from starsift.llm.running import run_starts, running_totals
from starsift.staging import stage

#: A conversation shares its first turns with the one whose id is the next lower multiple of this.
FAMILY = 5
#: Turns shared at most, plus one.
HEAD_CHOICES = 9
#: Ids of one row while the ends of a node are joined.
CHUNK_IDS = 8_192
PARTS = ["k1", "k2", "k3", "k4"]
LOW = (1 << 32) - 1


def marked_turns(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, mark, n_bytes): a digest of role and text in place of the text."""
    said = F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(""))
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    mark = F.sha2(F.concat(F.octet_length(said).cast("string"), F.lit(":"), said, body), 256)
    rows = conversations.where(F.col(f"`{conv_id}`").isNotNull())
    return rows.select(
        F.col(f"`{conv_id}`").cast("bigint").alias("conv"), F.col(f"`{turn}`").cast("bigint").alias("turn"), said.alias("role"),
        F.unhex(mark).alias("mark"), F.octet_length(body).cast("bigint").alias("n_bytes"),
    )


def base_of(conv: Column) -> Column:
    return conv - conv % FAMILY


def head_length(conv: Column) -> Column:
    return (F.crc32(conv.cast("string").cast("binary")) % HEAD_CHOICES).cast("int")


def rebuilt_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(conv) of every conversation, and (conv, pos, mark, n_bytes) of its turns after the rebuild; both written."""
    rows = stage(marked_turns(conversations, conv_id, turn, role, text).withColumn("one", F.lit(1)), "turns")
    ordered = running_totals(rows, ["conv"], ["turn", "role", "mark"], ["one"])
    ordered = stage(ordered.select("conv", (F.col("one_total") - 1).alias("pos"), "mark", "n_bytes"), "ordered")
    first = ordered.where((F.col("conv") % FAMILY == 0) & (F.col("pos") < HEAD_CHOICES - 1))
    heads = first.groupBy(F.col("conv").alias("base")).agg(F.sort_array(F.collect_list(F.struct("pos", "mark", "n_bytes"))).alias("turns"))
    own = ordered.select("conv").distinct().select("conv", base_of(F.col("conv")).alias("base"), head_length(F.col("conv")).alias("h"))
    shared = F.slice(F.coalesce("turns", F.array().cast(heads.schema["turns"].dataType)), 1, F.col("h"))
    convs = stage(own.join(heads, "base", "left").select("conv", "h", shared.alias("turns")), "heads")
    kept = ordered.join(convs.select("conv", "h", F.size("turns").alias("n")), "conv").where("pos >= h")
    kept = kept.select("conv", (F.col("pos") - F.col("h") + F.col("n")).alias("pos"), "mark", "n_bytes")
    taken = convs.select("conv", F.explode("turns").alias("t")).select("conv", "t.pos", "t.mark", "t.n_bytes")
    return convs.select("conv"), stage(kept.unionByName(taken), "rebuilt")


def with_parts(turns: DataFrame) -> DataFrame:
    """Adds the four parts of a turn's 128 bits, which depend on its position too."""
    a, b = F.xxhash64("pos", "mark"), F.xxhash64("mark", "pos")
    halves = (F.shiftrightunsigned(a, 32), a.bitwiseAND(LOW), F.shiftrightunsigned(b, 32), b.bitwiseAND(LOW))
    return turns.select("conv", "pos", "n_bytes", *[h.alias(k) for h, k in zip(halves, PARTS, strict=True)])


def end_digests(whole: DataFrame) -> DataFrame:
    """(depth, k1..k4, ends_sha256): SHA-256 of the ascending ids that end at a sequence, comma-joined.

    The ids are sorted and joined in ranges of the order; one task then feeds the
    joined pieces of a sequence to its digest, one after the other, so its memory is
    that of a batch of pieces even where a third of all conversations end.
    """
    small_batches(whole.sparkSession)
    key = ["depth", *PARTS]
    piece = "depth bigint, k1 bigint, k2 bigint, k3 bigint, k4 bigint, least bigint, ids string"

    def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*key, "least", "ids"]
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = [batch.column(k) for k in key]
            starts = run_starts(keys, None).nonzero()[0].tolist()
            ids = batch.column("conv").to_pylist()
            at = [i for a, b in zip(starts, [*starts[1:], n], strict=True) for i in range(a, b, CHUNK_IDS)]
            text = [",".join(map(str, ids[a:b])) for a, b in zip(at, [*at[1:], n], strict=True)]
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([*(k.take(take) for k in keys), batch.column("conv").take(take), pa.array(text, pa.string())], names)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, state = None, None
        for batch in batches:
            done: list[tuple] = []
            keys = zip(*(batch.column(k).to_pylist() for k in key), strict=True)
            for k, ids in zip(keys, batch.column("ids").to_pylist(), strict=True):
                if k != open_key:
                    if state is not None:
                        done.append((*open_key, state.hexdigest()))
                    open_key, state = k, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in list(zip(*done, strict=True))[:5]), pa.array([d[5] for d in done])], [*key, "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([*(pa.array([x], pa.int64()) for x in open_key), pa.array([state.hexdigest()])], [*key, "ends_sha256"])

    ranged = whole.select(*key, "conv").repartitionByRange(*key, "conv").sortWithinPartitions(*key, "conv")
    pieces = ranged.mapInArrow(join_ids, piece)
    gathered = pieces.repartition(*key).sortWithinPartitions(*key, "least")
    return gathered.mapInArrow(digest, "depth bigint, k1 bigint, k2 bigint, k3 bigint, k4 bigint, ends_sha256 string")


def prefix_trie(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The nodes of the trie of rebuilt conversations.

    Returns (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, n_ends, ends_sha256). Turns are ordered by number, nulls first; turns
    with one number by role, then by the digest of role and text. A null role or text
    is an empty one. Rows without a conversation id belong to no conversation and are
    left out. Repeated rows are turns of their own. A conversation whose turns are all
    replaced by nothing is a member of the root. No rows: no nodes, not even a root.
    """
    key = ["depth", *PARTS]
    convs, rebuilt = rebuilt_turns(conversations, conv_id, turn, role, text)
    turns = with_parts(rebuilt)
    totals = [F.sum(c).alias(c) for c in (*PARTS, "n_bytes")]
    none = convs.select("conv", *[F.lit(0).cast("bigint").alias(c) for c in (*PARTS, "n_bytes", "depth")])
    counted = turns.select("conv", *PARTS, "n_bytes", F.lit(1).cast("bigint").alias("depth")).unionByName(none)
    whole = stage(counted.groupBy("conv").agg(*totals, F.sum("depth").alias("depth")), "whole")
    sequences = whole.groupBy(*key).agg(F.count(F.lit(1)).alias("weight"), F.min("conv").alias("conv"), F.min("n_bytes").alias("all_bytes"))
    sequences = stage(sequences, "sequences")

    spread = running_totals(turns.join(sequences.select("conv", "weight", "all_bytes"), "conv"), ["conv"], ["pos"], [*PARTS, "n_bytes"])
    steps = spread.select(
        "conv", "weight", "all_bytes", "n_bytes", F.col("n_bytes_total").alias("to_here"), (F.col("pos") + 1).alias("depth"),
        *[F.col(f"{k}_total").alias(k) for k in PARTS], *[(F.col(f"{k}_total") - F.col(k)).alias(f"up_{k}") for k in PARTS],
    )
    zeros = [F.lit(0).cast("bigint").alias(c) for c in ("n_bytes", "to_here", *key, *(f"up_{k}" for k in PARTS))]
    path = stage(steps.unionByName(sequences.select("conv", "weight", "all_bytes", *zeros)), "paths")

    nodes = path.groupBy(*key).agg(F.min("conv").alias("least"), F.min("n_bytes").alias("n_bytes"), *[F.min(f"up_{k}").alias(f"up_{k}") for k in PARTS])
    nodes = stage(nodes, "nodes")
    up = nodes.where("depth > 0").select((F.col("depth") - 1).alias("depth"), *[F.col(f"up_{k}").alias(k) for k in PARTS])
    parents = stage(up.groupBy(*key).agg(F.count(F.lit(1)).alias("n_children")), "parents")
    leaves = sequences.join(parents, key, "left_anti").select("conv", F.lit(1).alias("leaf"))
    owned = nodes.groupBy(F.col("least").alias("conv")).agg(F.min("depth").alias("from_depth"), F.sum("n_bytes").alias("own_bytes"))
    about = stage(sequences.select("conv").join(leaves, "conv", "left").join(owned, "conv", "left"), "about")

    rest = F.col("all_bytes") - F.col("to_here") + F.col("n_bytes")
    once = F.when(F.col("from_depth") <= F.col("depth"), rest).otherwise(F.coalesce("own_bytes", F.lit(0)))
    sums = path.join(about, "conv").groupBy(*key).agg(
        F.min("conv").alias("conv_id"), F.sum("weight").alias("n_convs"), F.sum(F.coalesce("leaf", F.lit(0)).cast("bigint")).alias("n_leaves"),
        F.sum(F.col("weight") * rest - once).alias("saved_tokens"), *[F.min(f"up_{k}").alias(f"up_{k}") for k in PARTS],
    )
    ends = end_digests(whole).join(sequences.select(*key, F.col("weight").alias("n_ends")), key)
    full = sums.join(parents, key, "left").join(ends, key, "left")
    above = nodes.select((F.col("depth") + 1).alias("depth"), *[F.col(k).alias(f"up_{k}") for k in PARTS], F.col("least").alias("parent_conv_id"))
    return full.join(above, ["depth", *(f"up_{k}" for k in PARTS)], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"), "n_leaves",
        "saved_tokens", F.coalesce("n_ends", F.lit(0)).cast("bigint").alias("n_ends"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
