"""Document fingerprints as invertible Bloom lookup sketches of paragraphs.

A text is cut into lines, long lines into blocks of :data:`BLOCK_CHARS` code points, and each
distinct block has a 64-bit digest.  A sketch has cells; every digest is added to one cell in
each third of them (count, XOR of digests, XOR of checks).  Subtracting the sketches of two
versions leaves the digests they do not share; a cell that holds a single one gives it away,
it is taken out of its other cells, and so on until all are recovered.  Where that gets stuck
the pair is tried again with four times the cells, until it works.  Sketches are kept sparse, made
by sorting entries by cell and folding runs, so the work is near-linear in a text's blocks.
The number of recovered digests
gives the likeness of the two sets (Jaccard).

Everything is DataFrame expressions.  Texts are moved once by key, and the part of the next
text that an edit needs once more; sketches are made and peeled within a row.

Nulls: a null text is empty; a null key counts as the smallest key.  Rows with equal keys are
all kept; the document before them is edited with the one of the smallest text hash.  A single
document is its own next one.  Two texts without blocks are alike (1.0).  An empty table gives
an empty result; other columns of the input are ignored.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.common import staged, text_or_empty

BLOCK_CHARS = 400
CELLS = 24
_PARTS = 3
# Each retry has four times the cells, up to 24 x 4**13; only cells that hold something take space.
_GROWTH, _RETRIES = 4, 13
_NO_KEY = -(1 << 63)


def digests(text: Column) -> Column:
    """Distinct 64-bit digests of the blocks of a text."""
    blocks = F.regexp_extract_all(text, F.lit(f"[^\\n]{{1,{BLOCK_CHARS}}}"), F.lit(0))
    return F.array_distinct(F.transform(blocks, lambda b: F.xxhash64(b)))


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit("check")).bitwiseAND(F.lit(0xFFFFFFFF))


def _places(digest: Column, third: Column) -> list[Column]:
    """One cell in each third; other numbers of cells draw anew."""
    mixed = F.xxhash64(digest, third * _PARTS)
    return [(F.pmod(F.shiftright(mixed, 20 * part), third) + third * part).cast("int")
            for part in range(_PARTS)]


def _cell(p: Column, n: Column, x: Column, c: Column) -> Column:
    return F.struct(p.cast("int").alias("p"), n.cast("int").alias("n"), x.cast("long").alias("x"),
                    c.cast("long").alias("c"))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _entries(digest: Column, sign: Column, third: Column) -> Column:
    """What one digest adds to its cells."""
    return _let(_check(digest), lambda check: F.array(*[
        _cell(p, sign, digest, check) for p in _places(digest, third)]))


def _firsts(ordered: Column, field: str) -> Column:
    """Positions in an ordered array where a field differs from the element before."""
    return F.when(F.size(ordered) == 0, F.array().cast("array<int>")).otherwise(F.filter(
        F.sequence(F.lit(0), F.size(ordered) - 1),
        lambda i: (i == 0) | (F.get(ordered, i)[field] != F.get(ordered, i - 1)[field])))


def _folded(entries: Column) -> Column:
    """Entries added up per cell, by sorting and folding runs; cells that come to nothing are left out."""
    def total(e: Column, start: Column, end: Column) -> Column:
        zero = _cell(F.get(e, start)["p"], F.lit(0), F.lit(0), F.lit(0))
        return F.aggregate(F.sequence(start, end - 1), zero, lambda a, i: _let(F.get(e, i), lambda r: _cell(
            a["p"], a["n"] + r["n"], a["x"].bitwiseXOR(r["x"]), a["c"].bitwiseXOR(r["c"]))))

    def runs(e: Column) -> Column:
        return _let(_firsts(e, "p"), lambda starts: F.transform(
            starts, lambda at, j: total(e, at, F.coalesce(F.get(starts, j + 1), F.size(e)))))

    return F.filter(_let(F.sort_array(entries), runs), lambda c: (c["n"] != 0) | (c["x"] != 0) | (c["c"] != 0))


def sketch(found: Column, third: Column, sign: int = 1) -> Column:
    """The cells of a set of digests that hold any; there are three times ``third``."""
    return _folded(F.flatten(F.transform(found, lambda d: _entries(d, F.lit(sign), third))))


def subtract(left: Column, right: Column) -> Column:
    return _folded(F.concat(left, F.transform(right, lambda c: _cell(c["p"], -c["n"], c["x"], c["c"]))))


def peel(difference: Column, third: Column, most: Column) -> Column:
    """Number of digests in a difference of sketches, null where peeling gets stuck.

    Every round takes out all digests that a cell gives away, so rounds grow like the logarithm
    of their number; ``most`` bounds the digests that can be there, and so the rounds.
    """
    def pure(c: Column) -> Column:
        return (F.abs(c["n"]) == 1) & (c["c"] == _check(c["x"]))

    def step(state: Column) -> Column:
        given = F.sort_array(F.transform(F.filter(state["cells"], pure), lambda c: F.struct(c["x"], c["n"])))
        once = _let(given, lambda g: F.transform(_firsts(g, "x"), lambda i: F.get(g, i)))
        return _let(once, lambda digests: F.when(F.size(digests) == 0, F.struct(
            state["cells"].alias("cells"), state["taken"].alias("taken"), F.lit(False).alias("open"))).otherwise(F.struct(
                _folded(F.concat(state["cells"], F.flatten(F.transform(
                    digests, lambda d: _entries(d["x"], -d["n"], third))))).alias("cells"),
                (state["taken"] + F.size(digests)).alias("taken"), F.lit(True).alias("open"))))

    start = F.struct(difference.alias("cells"), F.lit(0).alias("taken"), F.lit(True).alias("open"))
    done = F.aggregate(F.sequence(F.lit(1), F.greatest(F.lit(1), most)), start,
                       lambda state, _: F.when(state["open"], step(state)).otherwise(state))
    return _let(done, lambda s: F.when(F.size(s["cells"]) == 0, s["taken"]))


def likeness(left: Column, right: Column, third: Column) -> Column:
    """Jaccard of two sets of digests through sketches of one size; null where these are too small."""
    both = F.size(left) + F.size(right)
    apart = peel(subtract(sketch(left, third), sketch(right, third)), third, both)
    # At least as many digests differ as the sizes do; more than cells cannot be recovered.
    apart = F.when(F.abs(F.size(left) - F.size(right)) <= third * _PARTS, apart)
    return _let(apart, lambda r: F.when(r.isNotNull() & (both == 0), 1.0).otherwise(
        (both - r) / (both + r)))


def retried(left: Column, right: Column, cells: int = CELLS) -> Column:
    """The same, with sketches of more cells after each failure, within the row.

    Sizes start where as many digests fit as the sets differ in number.
    """
    apart = F.greatest(F.lit(1.0), F.abs(F.size(left) - F.size(right)) / float(cells))
    least = F.least(F.lit(_RETRIES), F.ceil(F.log(float(_GROWTH), apart)).cast("int"))
    return F.aggregate(F.sequence(least, F.lit(_RETRIES)), F.lit(None).cast("double"), lambda found, k: F.when(
        found.isNull(), likeness(left, right, (F.lit(cells // _PARTS) * F.pow(F.lit(_GROWTH), k)).cast("int"))).otherwise(found))


def printed(found: Column, cells: int) -> Column:
    """A sketch as text: count, digest and check of each cell in hexadecimal."""
    part = lambda value, width: F.right(F.lpad(F.hex(value), width, "0"), F.lit(width))
    none = _cell(F.lit(0), F.lit(0), F.lit(0), F.lit(0))
    every = _let(sketch(found, F.lit(cells // _PARTS)), lambda held: F.transform(
        F.sequence(F.lit(0), F.lit(cells - 1)),
        lambda i: F.coalesce(F.get(F.filter(held, lambda c: c["p"] == i), F.lit(0)), none)))
    return F.lower(F.array_join(F.transform(every, lambda c: F.concat(
        part(c["n"], 4), part(c["x"], 16), part(c["c"], 8))), ""))


def following(docs: DataFrame) -> DataFrame:
    """``k``, ``next`` and ``before``: neighbours in descending order of the distinct keys, as a ring.

    Only keys move.  They are cut into ranges; inside a range the neighbour is the row beside,
    and at its edge the nearest key of the next range, from a table of one row per range.
    ``before_chars`` is the length of the longest text of the key before.
    """
    ranges = staged(docs.groupBy("k").agg(F.max("n_chars").alias("n_chars"))
                    .repartitionByRange(F.desc("k")).withColumn("range", F.spark_partition_id()), "sketch-keys")
    edges = ranges.groupBy("range").agg(F.max_by(F.struct("k", "n_chars"), "k").alias("high"),
                                        F.min_by(F.struct("k", "n_chars"), "k").alias("low"))
    every = Window.orderBy(F.desc("range"))
    ring = Window.orderBy("range")
    edges = edges.select(
        "range",
        F.coalesce(F.lead("high").over(ring),
                   F.first("high").over(ring)).alias("after_low"),
        F.coalesce(F.lag("low").over(ring), F.first("low").over(every)).alias("before_high"))
    inside = Window.partitionBy("range").orderBy(F.desc("k"))
    near = ranges.select(
        "range", "k", F.lead(F.struct("k", "n_chars")).over(inside).alias("after"),
        F.lag(F.struct("k", "n_chars")).over(inside).alias("ahead"))
    return near.join(edges, "range").select(
        "k", F.coalesce("after", "after_low")["k"].alias("next"),
        F.coalesce("ahead", "before_high")["k"].alias("before"),
        F.coalesce("ahead", "before_high")["n_chars"].alias("before_chars"))


def fingerprints(docs: DataFrame, cells: int = CELLS, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """Sketches of every text and of its edited form, and their likenesses.

    The edited form has the last half of its code points replaced by as many from the start of
    the next text.  Returns ``key``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``.
    """
    body = text_or_empty(text)
    # Both sides of the join below read exactly these columns, so they share one shuffle of texts.
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(_NO_KEY)).alias("k"), body.alias("text"))
    own_key = F.nullif(F.col("k"), F.lit(_NO_KEY)).cast(docs.schema[key].dataType).alias(key)
    sized = rows.select("k", F.char_length("text").cast("long").alias("n_chars"))
    ring = staged(following(sized), "sketch-ring")
    placed = rows.join(ring, "k")
    # Told by the row before, not by a row number: limiting those changes the plan below the
    # shuffle, and the texts would be shuffled a second time.
    earlier = F.lag(F.lit(True)).over(Window.partitionBy("k").orderBy(F.xxhash64("text")))
    placed = placed.withColumn("earlier", earlier)
    heads = placed.where("earlier IS NULL").select(
        F.col("before").alias("k"),
        F.left("text", F.floor(F.col("before_chars") / 2).cast("int")).alias("head"),
        digests(F.col("text")).alias("next_digests"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left("text", n - half), F.left("head", half))
    both = rows.join(heads, "k").select(
        own_key, n.cast("long").alias("n_chars"), digests(F.col("text")).alias("own"),
        edited.alias("edited"), "next_digests")
    # Digests are written once, so that what follows reads them and not the texts.
    marked = staged(both.select(
        key, "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "own",
        digests(F.col("edited")).alias("changed"), "next_digests"), "sketch-digests")
    return marked.select(
        key, "n_chars", "edited_sha256", printed(F.col("own"), cells).alias("fingerprint"),
        printed(F.col("changed"), cells).alias("edited_fingerprint"),
        retried(F.col("own"), F.col("changed"), cells).alias("near_edited"),
        retried(F.col("own"), F.col("next_digests"), cells).alias("near_next"))
