"""Near duplicates by SimHash, found through deletion-variant signatures.

A fingerprint has 64 bits.  For links of up to ``radius`` differing bits it is cut into
``radius // 2 + 1`` segments: then one segment differs by at most one bit.  Every
segment is indexed once per bit with that bit left out, so that two fingerprints within
the radius meet under at least one equal key; an equality join brings them together and
the full distance is verified.  Only distinct fingerprints are indexed, so thousands of
copies are one entry.  Keys that very many distinct fingerprints share are not compared
pair by pair: the rest of the fingerprint is cut and indexed in the same way beneath them.

Texts: A-Z are lower-cased, words are runs without ASCII white space, features are
shingles of ``width`` words with repeats (a shorter text is one shingle), hashed with
XXH64 (seed 42); a bit is set if it is set in more than half of the hashes.  A text
without words, or null, has fingerprint 0 and is linked like any other.  Rows with equal
keys are separate rows of the same key; null keys take part but never name a component
unless it has no other.  An empty table gives an empty result.  Texts of any length are read
whole, hashed in parts; other columns are left out by :func:`near_duplicates` and kept by
:func:`drop_similar`.
"""
from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.llm.common import mapped, slices, staged, text_or_empty, typed
from gaugeworks.llm.components import components

BITS = 64
CROWD = 128
HASHES_AT_ONCE = 1 << 16


def hashed(text: str, width: int) -> Iterator[np.ndarray]:
    """Hashes of the shingles of a text in their order, repeats included, in parts; a shorter text is one shingle."""
    words = text.encode().lower().split()
    if len(words) < width:
        words, width = [b" ".join(words)] if words else [], 1
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(words) - width + 1, HASHES_AT_ONCE):
        part = words[at:at + HASHES_AT_ONCE + width - 1]
        yield np.array([digest(b" ".join(s), 42) for s in zip(*(part[i:] for i in range(width)))], "<u8")


def majority(parts: Iterable[np.ndarray]) -> int:
    """The bits set in more than half of all hashes, as an unsigned 64-bit number; 0 without hashes."""
    ones, count = np.zeros(BITS, np.int64), 0
    for part in parts:
        for at in range(0, len(part), HASHES_AT_ONCE):
            hashes = part[at:at + HASHES_AT_ONCE]
            ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1,
                                  bitorder="little").sum(axis=0, dtype=np.int64)
        count += len(part)
    return int.from_bytes(np.packbits(2 * ones > count, bitorder="little").tobytes(), "little")


def fingerprint(text: str, width: int) -> int:
    """SimHash of one text as an unsigned 64-bit number."""
    return majority(hashed(text, width))


def fingerprints(docs: DataFrame, width: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``fp``, the fingerprint's 64 bits as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            bits = np.array([fingerprint(v.as_py(), width) for v in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits.view(np.int64))], [key, "fp"])

    return mapped(docs.select(F.col(key), text_or_empty(text).alias("text")),
        run, T.StructType([typed(docs, key), T.StructField("fp", T.LongType())]))


def _segments(bits: list[int], parts: int) -> list[list[int]]:
    """Bit positions in ``parts`` runs of about equal length."""
    edges = [len(bits) * i // parts for i in range(parts + 1)]
    return [bits[a:b] for a, b in zip(edges, edges[1:]) if b > a]


def _variants(segments: list[list[int]], names: tuple[str, str]) -> Column:
    """Keys of all one-bit deletions: which bit is left out, and the other bits of its segment."""
    keys = []
    for bits in segments:
        for bit in bits:
            mask = sum(1 << b for b in bits if b != bit)
            kept = F.lit(mask - (1 << BITS) if mask >> (BITS - 1) else mask).cast("long")
            keys.append(F.struct(F.lit(bit).cast("short").alias(names[0]),
                                 F.col("fp").bitwiseAND(kept).alias(names[1])))
    return F.inline(F.array(*keys))


def _meet(keyed: DataFrame, radius: int) -> DataFrame:
    """Pairs under an equal key that are within the radius."""
    on = [c for c in keyed.columns if c != "fp"]
    other = keyed.withColumnRenamed("fp", "other")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= radius
    return (keyed.join(other, on).where((F.col("fp") < F.col("other")) & near)
            .select("fp", "other"))


def links(nodes: DataFrame, radius: int, crowd: int = CROWD) -> DataFrame:
    """All pairs ``fp``, ``other`` of distinct fingerprints at most ``radius`` bits apart, once each.

    ``nodes`` holds distinct ``fp``.  ``crowd`` only says from how many fingerprints on a key
    is refined; the pairs are the same for any value.
    """
    parts = radius // 2 + 1
    segments = _segments(list(range(BITS)), parts)
    index = nodes.select("fp", _variants(segments, ("slot", "rest")))
    group = Window.partitionBy("slot", "rest")
    shared = staged(index.withColumn("n", F.count("*").over(group)).where("n > 1"), "simhash-keys")
    pairs = _meet(shared.where(F.col("n") <= crowd).select("slot", "rest", "fp"), radius)
    for bits in segments:
        outside = [b for b in range(BITS) if b not in bits]
        crowded = shared.where((F.col("n") > crowd) & F.col("slot").isin(bits))
        if outside:  # these bits, too, differ by the radius at most, so one of their parts by one
            finer = _variants(_segments(outside, parts), ("slot2", "rest2"))
            crowded = crowded.select("slot", "rest", "fp", finer)
        else:
            crowded = crowded.select("slot", "rest", "fp")
        pairs = pairs.union(_meet(crowded, radius))
    return pairs.distinct()


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 2, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest key reachable by links."""
    marked = staged(fingerprints(docs, width, key, text), "simhash")
    return grouped(marked, radius, key).select(
        key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def grouped(marked: DataFrame, radius: int, key: str) -> DataFrame:
    """``key``, ``fp`` and ``component_id``, the smallest key reachable by links of fingerprints."""
    nodes = staged(marked.groupBy("fp").agg(F.min(key).alias("least")), "simhash-nodes")
    roots = components(links(nodes.select("fp"), radius), "fp", "other")
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = staged(rooted.join(least, "root").select("fp", "component_id"), "simhash-components")
    return marked.join(named, "fp").select(key, "fp", "component_id")


# Near duplicates at a similarity of five-word shingles, exactly.  Candidates come from the
# fingerprints above: texts of one component are compared with its smallest one.  Fingerprints
# cannot promise pairs that differ in more bits than the radius, so an index of shingles brings
# the rest, and every candidate is judged on its sets.  Two sets of a similarity s share at
# least s of the larger one, so in any common order of all shingles each has one of the shared
# ones among its first (1 - s) of its size, and one more: only these are indexed.  The order
# puts shingles that many texts have last.  It comes from counts over all texts and decides
# about the work, never about the pairs.
ORDER_CELLS, ORDER_BLOCKS = 1 << 22, 256
SLACK = 1e-9


def shingles(text: str, width: int) -> np.ndarray:
    """Distinct hashes of the shingles of a text, rising; a shorter text is one shingle."""
    return np.unique(_joined(hashed(text, width)).view(np.int64))


def _joined(parts: Iterable[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.zeros(0, "<u8"), *parts])


def shingle_sets(docs: DataFrame, width: int, key: str, text: str) -> DataFrame:
    """``node``, the key, and ``shingles``, the set of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            found = [shingles(v.as_py(), width) for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["node", "shingles"])

    return mapped(docs.select(F.col(key), text_or_empty(text).alias("text")), run, T.StructType(
        [typed(docs, key, "node"), T.StructField("shingles", T.ArrayType(T.LongType()))]))


def frequencies(docs: DataFrame, width: int, key: str, text: str) -> np.ndarray:
    """How many texts hold a shingle of each of :data:`ORDER_CELLS` hash cells, over all texts.

    A table of fixed size: every task adds up its own in blocks of cells, blocks are added across
    tasks, and the whole, 16 MB whatever the input, goes to the driver and to every worker.  Blocks
    are sent to the driver packed, since its JVM holds several copies of what it passes to Python.
    """
    size = ORDER_CELLS // ORDER_BLOCKS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(ORDER_CELLS, np.uint32)
        for batch in slices(batches, 0):
            for value in batch.column(0):
                cells[np.unique(_cell(shingles(value.as_py(), width)))] += 1
        blocks = cells.reshape(ORDER_BLOCKS, size)
        some = np.flatnonzero(blocks.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()),
                                          pa.array([blocks[i].tobytes() for i in some], pa.binary())], ["block", "cells"])

    def add(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.uint32)
        for part in parts:
            for cells in part.column(1):
                total += np.frombuffer(cells.as_py(), np.uint32)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())],
                                         ["block", "cells"])

    schema = "block int, cells binary"
    out = np.zeros((ORDER_BLOCKS, size), np.uint32)
    for r in mapped(docs.select(text_or_empty(text).alias("text")), count, schema).groupBy("block").applyInArrow(
            add, schema).collect():
        out[r["block"]] = np.frombuffer(zlib.decompress(r["cells"]), np.uint32)
    return out.ravel()


def _cell(found: np.ndarray) -> np.ndarray:
    return found & (ORDER_CELLS - 1)


def prefixes(docs: DataFrame, width: int, similarity: float, order: np.ndarray, key: str, text: str) -> DataFrame:
    """``node``, ``fp``, ``n`` shingles, ``digest`` of the set, ``own`` and ``prefix``, its first shingles by the order.

    ``own`` is small where a text's shingles occur in many texts: of a group of near copies, the
    one the others were made from has the smallest.
    """
    table = docs.sparkSession.sparkContext.broadcast(order)          # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            bits, size, digest, own, prefix = [], [], [], [], []
            for value in batch.column(1):
                every = _joined(hashed(value.as_py(), width))
                bits.append(majority([every]))
                found = np.unique(every.view(np.int64))
                times = table.value[_cell(found)]
                take = len(found) - math.ceil(similarity * len(found) - SLACK) + 1 if len(found) else 0
                size.append(len(found))
                digest.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                own.append(float((1 / np.maximum(times, 1)).mean()) if len(found) else 0.0)
                prefix.append(found[np.lexsort((found, times))[:take]])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(bits, np.uint64).view(np.int64)), pa.array(size, pa.int32()),
                 pa.array(digest, pa.binary()), pa.array(own, pa.float32()), pa.array(prefix, pa.list_(pa.int64()))],
                ["node", "fp", "n", "digest", "own", "prefix"])

    return mapped(docs.select(F.col(key), text_or_empty(text).alias("text")), run, T.StructType(
        [typed(docs, key, "node"), T.StructField("fp", T.LongType()), T.StructField("n", T.IntegerType()),
         T.StructField("digest", T.BinaryType()), T.StructField("own", T.FloatType()), T.StructField("prefix", T.ArrayType(T.LongType()))]))


def _judged(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose sets are similar, by exact Jaccard."""
    left = sets.withColumnRenamed("shingles", "left")
    right = sets.select(F.col("node").alias("other"), F.col("shingles").alias("right"))
    shared = F.size(F.array_intersect("left", "right"))
    return (pairs.join(left, "node").join(right, "other")
            .where(F.try_divide(shared, F.size("left") + F.size("right") - shared) >= similarity).select("node", "other"))


def _across(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs under one key whose components differ, once each, the larger node first.

    ``most`` is the largest size of a partner that a text can be similar to if this key is the
    first they share: what it has after the key bounds what they can have in common.  Every
    pair comes under its first shared key, so both bounds are conditions of the join.
    """
    rooted = shared.join(roots, "node", "left").select(
        "found", "node", "n", "most", F.coalesce("root", "node").alias("root"))
    group = Window.partitionBy("found")
    mixed = staged(rooted.withColumns({"_low": F.min("root").over(group), "_high": F.max("root").over(group)})
                   .where("_low <> _high").select("found", "node", "n", "most", "root"), "similar-mixed")
    other = mixed.select("found", *[F.col(c).alias(f"{c}2") for c in ("node", "n", "most", "root")])
    return (mixed.join(other, "found").where("root < root2 AND n <= most2 AND n2 <= most")
            .select(F.greatest("node", "node2").alias("node"), F.least("node", "node2").alias("other")).distinct())


def drop_similar(docs: DataFrame, width: int = 5, similarity: float = 0.8, key: str = "doc_id",
                 text: str = "text", radius: int = 2) -> DataFrame:
    """The rows of ``docs`` without those similar to one with a smaller key, directly or in a chain.

    Similar are texts whose sets of shingles have a Jaccard index of at least ``similarity``;
    all such pairs count and no others.  Texts with equal sets are one entry.  Entries whose
    fingerprints are linked at ``radius``, directly or in a chain, are compared with the smallest
    of their component (:func:`grouped`, as in :func:`near_duplicates`).  Entries that share an
    indexed shingle are compared with the smallest of them, and with the one whose
    shingles are the most common, first; then every pair that these links have not yet brought
    into one component is compared, too.  Rows that repeat a key stay or go together; rows
    without a key stay.
    """
    keyed = docs.where(F.col(key).isNotNull())
    marked = staged(prefixes(keyed, width, similarity, frequencies(keyed, width, key, text), key, text),
                    "similar-prefixes")
    nodes = staged(marked.groupBy("digest").agg(F.min("node").alias("node")), "similar-nodes")
    # One row per entry, even where a key is repeated with the same text.
    entries = marked.join(nodes, ["digest", "node"]).dropDuplicates(["digest", "node"])
    place = F.col("n") - F.col("i")
    most = F.floor(place * ((1 + similarity) / similarity) + SLACK).cast("int") - F.col("n")
    index = entries.select("node", "n", "own", F.posexplode("prefix").alias("i", "found")).select(
        "found", "node", "n", "own", most.alias("most"))
    group = Window.partitionBy("found")
    shared = staged(index.withColumns({
        "first": F.min(F.struct("node", "n")).over(group), "typical": F.min(F.struct("own", "node", "n")).over(group),
        "many": F.count("*").over(group), "low": F.min("n").over(group), "high": F.max("most").over(group)})
        .where("many > 1 AND most >= low AND n <= high").drop("many", "low", "high", "own"), "similar-keys")

    def alike(a: str, b: str, times: str | None = None) -> Column:
        """Whether the sizes, and the number of indexed shingles two sets share, allow the similarity.

        What they share beyond these comes after one of the two prefixes.
        """
        if times is None:
            return F.least(a, b) >= similarity * F.greatest(a, b) - SLACK
        after = F.ceil(similarity * F.greatest(a, b) - SLACK) - 1
        return F.col(times) + after >= similarity / (1 + similarity) * (F.col(a) + F.col(b)) - SLACK

    def linked(pairs: DataFrame, label: str) -> DataFrame:
        ids = staged(pairs.select(F.explode(F.array("node", "other")).alias(key)).distinct(), f"{label}-nodes")
        sets = staged(shingle_sets(keyed.join(ids, key, "left_semi").dropDuplicates([key, text]), width, key, text),
                      f"{label}-sets")
        return staged(_judged(pairs, sets, similarity), f"{label}-linked")

    def compared_with(hub: str) -> DataFrame:
        return shared.where((F.col("node") != F.col(f"{hub}.node")) & alike("n", f"{hub}.n")).select(
            F.greatest("node", f"{hub}.node").alias("node"), F.least("node", f"{hub}.node").alias("other"))

    def promising(pairs: DataFrame) -> DataFrame:
        """Pairs that share enough of their prefixes."""
        known = entries.select("node", "n", "prefix")
        other = known.select(*[F.col(c).alias(f"{c}2") for c in known.columns])
        return (pairs.join(known, "node").join(other, F.col("other") == F.col("node2"))
                .withColumn("times", F.size(F.array_intersect("prefix", "prefix2")))
                .where(alike("n", "n2", "times")).select("node", "other"))

    signed = grouped(staged(entries.select("node", "fp"), "similar-fingerprints"), radius, "node").where(
        "node <> component_id").select(F.greatest("node", "component_id").alias("node"),
                                       F.least("node", "component_id").alias("other"))
    indexed = promising(compared_with("first").unionByName(compared_with("typical")).distinct())
    met = staged(signed.unionByName(indexed).distinct(), "similar-met")
    direct = linked(met, "similar-met")
    joined = components(direct, "node", "other")
    more = staged(promising(_across(shared, joined).join(met, ["node", "other"], "left_anti")), "similar-across")
    # The components found so far stand for all links that made them.
    roots = components(joined.union(linked(more, "similar-across")), "node", "root")
    kept = nodes.select("node").join(roots.where("node <> root"), "node", "left_anti")
    gone = staged(marked.select(F.col("node").alias(key)).distinct()
                  .join(kept.withColumnRenamed("node", key), key, "left_anti"), "similar-gone")
    return docs.join(gone, key, "left_anti")
