"""Shards from a hierarchical weighted hash tree: regions hold racks, racks hold shards.

A row descends level by level.  At each level every child draws an exponential number from
hash(level, child, key) with the sum of the weights below it as its rate, and the row goes to
the child with the smallest draw; only children of the chosen node draw.  So a region gets
rows in proportion to its weight, a rack its part of them, a shard its part of those.

A changed weight changes the draws of the nodes above it and no others.  More weight below a
node draws rows into its subtree, less sends some of its own rows out, to places that depend
on their own draws; rows that stay outside the subtree before and after do not move.  A
further shard (beyond ``settled``) stands in a region of its own, so it takes rows only into
itself.

A null key is hashed like a value of its own; equal rows are separate rows; a null text has
0 bytes and a text of any length is one row; an empty table gives an empty result; other
columns are left out.  Slots number the rows of a shard by key and text; equal rows share out
their slots in any order.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.common import staged, text_or_empty

ROW_OVERHEAD = 16
SLOT_BLOCKS = 64


Tree = dict[int, dict[int, dict[int, float]]]


def tree(weights: Sequence[float], racks: int, regions: int, settled: int | None = None) -> Tree:
    """Weights by region, rack and shard; shards without weight are left out.

    Shard s stands in rack ``s // racks`` and that in region ``rack // regions``: ``racks`` is
    the number of shards in a rack, ``regions`` the number of racks in a region.  Shards from
    ``settled`` on have a rack and a region each.
    """
    settled = len(weights) if settled is None else settled
    out: Tree = {}
    last = -(-settled // racks)
    for s, weight in enumerate(weights):
        rack = s // racks if s < settled else last + s - settled
        region = rack // regions if s < settled else -(-last // regions) + s - settled
        if weight > 0:
            out.setdefault(region, {}).setdefault(rack, {})[s] = float(weight)
    if not out:
        raise ValueError("at least one shard needs a positive weight")
    return out


def draw(key: Column, level: str, child: int, weight: float) -> Column:
    """Exponential with rate ``weight``: minus the logarithm of a uniform number, by hash."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(level), F.lit(child), key), 11)
    return -F.log((bits.cast("double") + 0.5) / float(1 << 53)) / F.lit(weight)


def _chosen(key: Column, level: str, children: dict[int, float]) -> Column:
    """The child with the smallest draw."""
    drawn = [F.struct(draw(key, level, c, w).alias("draw"), F.lit(c).alias("to")) for c, w in children.items()]
    return (F.least(*drawn) if len(drawn) > 1 else drawn[0])["to"]


def descend(df: DataFrame, key: str, nodes: Tree, name: str) -> DataFrame:
    """Add column ``name``, the shard of each row: one draw per region, then per rack, then per shard."""
    def below(at: str, level: str, children: dict[int, dict[int, float]]) -> Column:
        choice = F.lit(None).cast("int")
        for node, inside in children.items():
            choice = F.when(F.col(at) == node, _chosen(F.col(key), level, inside)).otherwise(choice)
        return choice

    regions = {r: sum(sum(shards.values()) for shards in racks.values()) for r, racks in nodes.items()}
    racks = {r: {k: sum(shards.values()) for k, shards in inside.items()} for r, inside in nodes.items()}
    shards = {k: inside for r in nodes.values() for k, inside in r.items()}
    return (df.withColumn("_region", _chosen(F.col(key), "region", regions))
            .withColumn("_rack", below("_region", "rack", racks))
            .withColumn(name, below("_rack", "shard", shards)).drop("_region", "_rack"))


def assign(docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None,
           racks: int = 4, regions: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    ``weights`` has one entry per shard.  ``grown`` are the weights after a change, and
    ``grown_shard`` says where a row would stand then; null without it.  Slots are gapless
    from 0 within a shard: rows are numbered within small blocks of a shard, and the blocks'
    sizes, a table of shards x blocks, give the offsets, so no task holds a whole shard.
    """
    body = text_or_empty(text)
    place = docs.select(
        F.col(key),
        (F.octet_length(body).cast("long") + ROW_OVERHEAD).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.xxhash64(body).alias("_text"),
        F.lit("key").alias("law"))
    place = descend(place, key, tree(weights, racks, regions), "shard")
    if grown:
        place = descend(place, key, tree(grown, racks, regions, len(weights)), "grown_shard")
    else:
        place = place.withColumn("grown_shard", F.lit(None).cast("int"))
    place = place.withColumn("_block", F.pmod(F.xxhash64(F.lit("block"), F.col(key), "_text"),
                                              F.lit(SLOT_BLOCKS)))
    place = staged(place, "shards")
    counts = place.groupBy("shard", "_block").count()
    offsets = counts.select(
        "shard", "_block",
        (F.sum("count").over(Window.partitionBy("shard").orderBy("_block")) - F.col("count"))
        .alias("_before"))
    inside = Window.partitionBy("shard", "_block").orderBy(key, "_text")
    return (place.withColumn("_at", F.row_number().over(inside) - 1)
            .join(offsets, ["shard", "_block"])
            .select(key, "size", "text_crc32", "law", "shard",
                    (F.col("_before") + F.col("_at")).cast("long").alias("slot"), "grown_shard"))
