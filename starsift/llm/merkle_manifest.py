"""Merkle manifest of a dataset, with a proof for every row.

A row's leaf is the digest of its fields. The leaves of a group, in order, are nodes
of a tree in which eight consecutive nodes have one parent. Aligned blocks of 512
leaves are gathered; a block holds each of its levels as one string of hex digests,
so the parents of a level are the digests of its substrings of 512 characters, and
the siblings of a node are the two substrings that flank it in its run. The tops of
the blocks are the leaves of the next round, until each group has one node. The roots
of the groups are the leaves of one more tree, built the same way. Only digests are
shuffled; a block is bounded whatever the size of a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starsift.llm.running import running_totals
from starsift.llm.url_filter import lower_ascii
from starsift.staging import stage

FANOUT = 8
HEX = 64
#: Levels of a block; it holds up to ``FANOUT ** LEVELS`` leaves.
LEVELS = 3
BLOCK = FANOUT**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SEGMENT = "array<struct<left:string,right:string>>"


def field_text(value: Column) -> Column:
    """``-`` for null, else byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field_text, values)), 256)


def runs_of(level: Column) -> Column:
    """The runs of ``FANOUT`` nodes of a level: its substrings of fixed width."""
    width = FANOUT * HEX
    return F.transform(F.sequence(F.lit(0), F.floor((F.length(level) - 1) / width).cast("int")), lambda i: level.substr(i * width + 1, F.lit(width)))


def flanks(run: Column, place: Column) -> Column:
    """What stands left and right of a node in its run, as hex strings."""
    at = (place % FANOUT).cast("int") * HEX
    left = run.substr(F.lit(1), at)
    return F.struct(left.alias("left"), run.substr(at + HEX + 1, F.lit(FANOUT * HEX)).alias("right"))


def blocks_of(nodes: DataFrame, payload: list[str]) -> DataFrame:
    """(grp, block, n_group, leaves, levels, top): aligned blocks of (grp, place, n_group, digest, *payload) nodes.

    ``leaves`` has place, digest and the payload of a block's nodes in order, ``levels``
    the runs of each level below its top. A group of one block stops as soon as one
    node is left; the blocks of larger groups all have ``LEVELS`` levels.
    """
    row = F.struct("place", "digest", *payload)
    held = nodes.groupBy("grp", F.floor(F.col("place") / BLOCK).cast("bigint").alias("block")).agg(
        F.sort_array(F.collect_list(row)).alias("leaves"), F.min("n_group").alias("n_group")
    )
    held = held.withColumn("l0", F.array_join(F.col("leaves.digest"), ""))
    for i in range(LEVELS):
        rises = (F.col("n_group") > BLOCK) | (F.length(f"l{i}") > HEX)
        held = held.withColumn(f"r{i}", F.when(rises, runs_of(F.col(f"l{i}"))))
        parents = F.array_join(F.transform(f"r{i}", lambda run: F.sha2(run, 256)), "")
        held = held.withColumn(f"l{i + 1}", F.coalesce(parents, F.col(f"l{i}")))
    levels = F.array_compact(F.array(*[f"r{i}" for i in range(LEVELS)]))
    return held.select("grp", "block", "n_group", "leaves", levels.alias("levels"), F.col(f"l{LEVELS}").alias("top"))


def block_segments(levels: Column, place: Column) -> Column:
    """The flanks of a block's leaf on each of the block's levels."""
    inner = (place % BLOCK).cast("int")
    return F.transform(
        levels,
        lambda runs, i: flanks(
            F.element_at(runs, F.floor(inner / F.pow(F.lit(FANOUT), i + 1)).cast("int") + 1), F.floor(inner / F.pow(F.lit(FANOUT), i))
        ),
    )


def with_ancestors(nodes: DataFrame, payload: list[str]) -> DataFrame:
    """The blocks of (grp, place, n_group, digest, *payload) nodes with ``upper``, the flanks above a block's top, and ``root``.

    Each round works on one node for every ``BLOCK`` of the round before. Only whether
    a group has more than one block reaches the driver.
    """
    blocks = stage(blocks_of(nodes, payload), "blocks")
    if blocks.where(F.col("n_group") > BLOCK).isEmpty():
        return blocks.withColumns({"upper": F.array().cast(SEGMENT), "root": F.col("top")})
    tops = blocks.select(
        "grp", F.col("block").alias("place"), F.ceil(F.col("n_group") / BLOCK).cast("bigint").alias("n_group"), F.col("top").alias("digest"),
    )
    above = leaves_of(with_ancestors(tops, []), []).select(F.col("grp").alias("of"), F.col("place").alias("at"), F.col("segments").alias("upper"), "root")
    return blocks.join(above, F.col("grp").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at"))).drop("of", "at")


def leaves_of(blocks: DataFrame, payload: list[str]) -> DataFrame:
    """(grp, place, digest, *payload, segments, root) of blocks with ancestors; ``segments`` are the flanks on the way to the root."""
    rows = F.transform(
        "leaves",
        lambda x: F.struct(*[x[c].alias(c) for c in ("place", "digest", *payload)], F.concat(block_segments(F.col("levels"), x["place"]), F.col("upper")).alias("segments")),
    )
    return blocks.select("grp", "root", F.inline(rows))


def folded(digest: Column, segments: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(segments, digest, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def ranked(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Adds ``place`` from 0 on within ``by``, and ``n_group``."""
    placed = running_totals(df.withColumn("one", F.lit(1)), by, order, ["one"])
    placed = stage(placed.withColumn("place", F.col("one_total") - 1).drop("one", "one_total"), "placed")
    sizes = placed.groupBy(*[F.col(c).alias(f"of_{c}") for c in by]).agg(F.count(F.lit(1)).alias("n_group"))
    same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in by]
    return placed.join(sizes, same).select(*placed.columns, "n_group")


def manifest(docs: DataFrame, doc_id: str = "doc_id", group: str = "lang", fields: tuple[str, ...] = FIELDS, tampered: dict[str, Column] | None = None) -> DataFrame:
    """Every row as (doc_id, leaf, subroot, root, proof, tampered_leaf).

    ``fields`` go into the leaf, in that order. Within a group the leaves ascend by id,
    nulls first, equal ids by leaf; groups ascend by name in UTF-8 bytes, null first and
    a group like any other. ``proof`` is the array of (left, right) siblings from the
    leaf to the root, ``tampered_leaf`` the leaf with the columns that ``tampered``
    replaces. Repeated rows are leaves of their own. No rows: no leaves and no root.
    """
    values = {c: F.col(f"`{c}`") for c in fields}
    changed = values | (tampered or {})
    leaves = docs.select(
        F.col(f"`{doc_id}`").alias("id"), F.col(f"`{group}`").alias("grp"), leaf_digest(list(values.values())).alias("digest"),
        leaf_digest(list(changed.values())).alias("tampered_leaf"),
    )
    nodes = ranked(stage(leaves, "leaves"), ["grp"], ["id", "digest"])
    blocks = stage(with_ancestors(nodes, ["id", "tampered_leaf"]), "trees")
    subroots = blocks.select("grp", "root").distinct().select(F.lit(0).alias("tree"), F.col("grp").alias("name"), F.col("root").alias("digest"))
    over = ranked(stage(subroots, "subroots"), ["tree"], ["name"]).withColumnRenamed("tree", "grp")
    last = leaves_of(with_ancestors(over, ["name"]), ["name"])
    last = stage(last.select("name", F.col("segments").alias("last"), F.col("root").alias("whole_root")), "roots")
    joined = blocks.join(last, F.col("grp").eqNullSafe(F.col("name")))
    whole = joined.withColumn("upper", F.concat("upper", "last")).withColumn("grp", F.col("root")).withColumn("root", F.col("whole_root"))
    return leaves_of(whole, ["id", "tampered_leaf"]).select(
        F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), F.col("grp").alias("subroot"), "root", F.col("segments").alias("proof"), "tampered_leaf",
    )


def verify(rows: DataFrame) -> DataFrame:
    """Adds ``proof_sha256``, ``folded_root`` and ``verified`` to the rows of ``manifest``."""
    siblings = F.array_join(F.transform("proof", lambda s: F.concat(s["left"], s["right"])), "")
    checked = rows.withColumn("proof_sha256", F.sha2(siblings, 256)).withColumn("folded_root", folded(F.col("tampered_leaf"), F.col("proof")))
    return checked.withColumn("verified", F.col("folded_root") == F.col("root"))


def lower_cased_text(docs: DataFrame, every: int = 3, doc_id: str = "doc_id", text: str = "text") -> dict[str, Column]:
    """A tampering for tests of a manifest: A-Z of the text lower-cased where ``every`` divides the CRC-32 of the id."""
    hit = F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % every == 0
    body = F.col(f"`{text}`")
    return {text: F.when(F.coalesce(hit, F.lit(False)), lower_ascii(body)).otherwise(body)}
