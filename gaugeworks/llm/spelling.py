"""Groups of spelling variants: words one edit apart, the rare one led back to the frequent one.

Words are counted with SQL functions; a share of the occurrences is damaged on purpose, as a
stand-in for typing errors (see :func:`occurrences`).

Two words one edit apart have letter counts at a squared distance of 1 (a letter more) or 2 (a
letter exchanged).  Blocks of letter counts are multiplied with numpy: |a|^2 + |b|^2 - 2 a.b
gives all squared distances of two blocks, pairs at most two apart are kept, and their edits
are verified.  Only blocks of equal or adjacent length can meet.

Lengths are cut further: letters are dealt into :data:`CLASSES` classes, and a word's cell is
the number of its letters in each.  An insertion adds one to one class, an exchange takes one
from a class and gives it to another or leaves the cell; so a word is sent to its own cell and
to a fixed number of others, each pair of cells meets in exactly one of the two, and no pair is
lost.  Cells above :data:`BLOCK_CHARS` letters are dealt into several blocks, and every pair
of blocks of a cell is a task of bounded size.  What a task hands on is one row per word with
its number of neighbours and its best neighbour, never the pairs.

Null texts have no words; a null key is written as nothing; repeated rows count each; texts of
any length are read whole; equal counts are settled by code-point order; an empty table gives
an empty result.  Other columns are left out.
"""
from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import staged

LETTERS = [*string.ascii_lowercase, *string.ascii_uppercase, *map(chr, range(0xC0, 0x100))]

CLASSES = 4
BLOCK_CHARS = 1 << 16
# Rows of one block that are multiplied at a time, and pairs verified at a time.
STRIPE = 512
PAIRS = 1 << 16
# Counts rise at least tenfold from a word to its form and fit in a long, so no way to a root
# has more than 18 steps; each doubling of known ways covers twice as many.
DOUBLINGS = 5


def occurrences(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 7,
                damage: int | None = 31) -> DataFrame:
    """``word``: every occurrence with at least ``least`` letters, A-Z in lower case.

    Where ``damage`` divides the checksum of ``<key>:<run>``, the letter at checksum modulo
    length is taken out.  Runs below ``least`` letters never become words, so the pattern
    leaves them out from the start.
    """
    runs = F.regexp_extract_all(F.col(text), F.lit(f"[A-Za-zÀ-ÿ]{{{least},}}"), F.lit(0))
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    one = docs.select(name.alias("_key"), F.explode(runs).alias("_run")).select(
        "_key", F.translate("_run", string.ascii_uppercase, string.ascii_lowercase).alias("word"))
    if damage is None:
        return one.select("word")
    h = F.crc32(F.concat("_key", F.lit(":"), "word").cast("binary"))
    at = (h % F.length("word")).cast("int")
    shorter = F.concat(F.substring(F.col("word"), F.lit(1), at),
                       F.substring(F.col("word"), at + 2, F.length("word")))
    return (one.select(F.when(h % damage == 0, shorter).otherwise(F.col("word")).alias("word"))
            .where(F.length("word") >= least))


def vocabulary(words: DataFrame, least: int = 2) -> DataFrame:
    """``word`` and ``n`` of words that occur often enough; counted before the shuffle."""
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def spelled(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words (one byte a letter) as rows of codes filled up with zeros, and their lengths."""
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    size = np.diff(ends)
    rows = np.zeros((len(words), size.max(initial=0)), np.uint8)
    place = np.arange(ends[-1] - ends[0]) - np.repeat(ends[:-1] - ends[0], size)
    codes = np.frombuffer(words.buffers()[2], np.uint8)[ends[0]:ends[-1]]
    rows[np.repeat(np.arange(len(words)), size), place] = codes
    return rows, size


def letter_counts(rows: np.ndarray) -> np.ndarray:
    """Words x letters, for the letters that occur; exact whatever the length."""
    kind = np.float32 if rows.shape[1] < 2000 else np.float64
    column = np.zeros(256, np.int64)
    used = np.flatnonzero(np.bincount(rows.ravel(), minlength=256)[1:]) + 1
    column[used] = np.arange(1, len(used) + 1)
    at = np.arange(len(rows))[:, None] * (len(used) + 1) + column[rows]
    counts = np.bincount(at.ravel(), minlength=len(rows) * (len(used) + 1)).reshape(len(rows), len(used) + 1)
    return counts[:, 1:].astype(kind)


def one_edit(a: np.ndarray, b: np.ndarray, length: int, longer: np.ndarray) -> np.ndarray:
    """Whether each row of ``a`` (``length`` letters) is one edit from its row of ``b``.

    Rows of ``b`` have as many letters, or one more where ``longer`` says so.
    """
    same = a[:, :length] == b[:, :length]
    out = same.sum(1) == length - 1
    if longer.any():
        start = np.logical_and.accumulate(same[longer], axis=1).sum(1)
        later = a[longer, :length] == b[longer, 1:length + 1]
        end = np.logical_and.accumulate(later[:, ::-1], axis=1).sum(1)
        out[longer] = start + end >= length
    return out


def near_pairs(rows: np.ndarray, size: np.ndarray, home: np.ndarray,
               guest: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs one edit apart; home words have one length, guests that length or one more.

    One product gives the squared distances: (-2a, |a|^2, 1) times (b, 1, |b|^2).
    """
    length = int(size[home[0]])
    counts = letter_counts(rows)
    square = (counts * counts).sum(1, keepdims=True)
    one = np.ones_like(square)
    a = np.hstack([-2 * counts[home], square[home], one[home]])
    b = np.ascontiguousarray(np.hstack([counts[guest], one[guest], square[guest]]).T)
    longer = size > length
    for start in range(0, len(home), STRIPE):
        i, j = np.nonzero(a[start:start + STRIPE] @ b < 2.5)
        i, j = home[i + start], guest[j]
        for at in range(0, len(i), PAIRS):
            p, q = i[at:at + PAIRS], j[at:at + PAIRS]
            ok = one_edit(rows[p], rows[q], length, longer[q])
            yield p[ok], q[ok]


def _compared(block: pa.Table) -> pa.Table:
    """One row per word of a block that has neighbours in it: how many, and the best one."""
    words = block["code"].combine_chunks()
    n, own = block["n"].to_numpy(), block["own"].to_numpy()
    is_home = block["home"].to_numpy()
    home, guest = np.flatnonzero(is_home), np.flatnonzero(~is_home)
    near, pairs = np.zeros(len(n), np.int64), []
    if len(home) and len(guest):
        rows, size = spelled(words)
        for i, j in near_pairs(rows, size, home, guest):
            # In its own cell each word is home and guest, so one direction covers both.
            other = ~own[j]
            pairs += [(i, j), (j[other], i[other])]
    best = np.zeros(len(n), np.int64)
    if pairs:
        to, of = (np.concatenate(side) for side in zip(*pairs))
        near = np.bincount(to, minlength=len(n))
        # Ranks put frequent words first, then code-point order: the best neighbour has the least.
        used = np.unique(of)
        names = np.ascontiguousarray(rows[used]).view(f"S{rows.shape[1]}").ravel()
        order = used[np.lexsort((names, -n[used]))]
        rank = np.zeros(len(n), np.int64)
        rank[order] = np.arange(len(order))
        least = np.full(len(n), len(order))
        np.minimum.at(least, to, rank[of])
        best[near > 0] = order[least[near > 0]]
    some = np.flatnonzero(near)
    return pa.table({"code": words.take(pa.array(some)), "near": pa.array(near[some], pa.int64()),
                     "best_n": pa.array(n[best[some]], pa.int64()), "best": words.take(pa.array(best[some]))})


def _cell() -> list[Column]:
    """Letters of a word in each class, by code point."""
    def members(k: int) -> str:
        return "".join(c for c in LETTERS if ord(c) % CLASSES == k)

    size = F.length("word")
    return [(size - F.length(F.translate("word", members(k), ""))).cast("int") for k in range(CLASSES)]


def _targets() -> Column:
    """The cells a word is sent to: its own, those a letter less leads to, those an exchange leads to."""
    own = [F.col(f"c{k}") for k in range(CLASSES)]

    def moved(less: int, more: int | None, is_own: bool = False) -> Column:
        cell = [own[k] - int(k == less) + int(k == more) for k in range(CLASSES)]
        return F.struct(F.lit(is_own).alias("own"), F.array(*cell).alias("cell"))

    return F.array(moved(-1, None, True), *[moved(k, None) for k in range(CLASSES)],
                   *[moved(b, a) for a in range(CLASSES) for b in range(a + 1, CLASSES)])


def neighbours(words: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``word``, ``n_near``, ``best`` and ``best_n`` of words (``word``, ``n``) with neighbours.

    Words are of the letters in :data:`LETTERS`, so that a letter is a byte of Latin-1.
    """
    cells = words.select(F.encode("word", "ISO-8859-1").alias("code"), "n",
                         *[c.alias(f"c{k}") for k, c in enumerate(_cell())])
    sent = (cells.select("code", "n", F.inline(_targets()))
            .where(F.forall("cell", lambda c: c >= 0)))
    size = F.octet_length("code")
    blocks = sent.groupBy("cell").agg(
        F.ceil(F.sum(F.when(F.col("own"), size)) / block_chars).alias("homes"),
        F.ceil(F.sum(size) / block_chars).alias("guests")).where(F.col("homes") > 0)
    dealt = sent.join(blocks, "cell").withColumns({
        "_i": F.pmod(F.xxhash64("code"), F.col("homes")),
        "_j": F.pmod(F.xxhash64("code", F.lit(1)), F.col("guests"))})
    as_guest = dealt.select("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("homes") - 1)).alias("i"),
                            F.col("_j").alias("j"), F.lit(False).alias("home"), "own", "code", "n")
    as_home = dealt.where("own").select(
        "cell", F.col("_i").alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("guests") - 1)).alias("j"),
        F.lit(True).alias("home"), "own", "code", "n")
    found = (as_home.unionByName(as_guest).groupBy("cell", "i", "j")
             .applyInArrow(_compared, "code binary, near long, best_n long, best binary"))
    # One byte a letter sorts as code points do.
    best = F.min(F.struct((-F.col("best_n")).alias("back"), F.col("best").alias("code")))
    return (found.groupBy("code").agg(F.sum("near").alias("n_near"), best.alias("b"))
            .select(F.decode("code", "ISO-8859-1").alias("word"), "n_near",
                    F.decode("b.code", "ISO-8859-1").alias("best"), (-F.col("b.back")).alias("best_n")))


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``: the last form reached from each word that has a form."""
    ways = staged(forms.select("word", F.col("form").alias("root")), "spelling-ways")
    for _ in range(DOUBLINGS):
        onward = ways.select(F.col("word").alias("_at"), F.col("root").alias("_to"))
        ways = staged(ways.join(onward, F.col("root") == F.col("_at"), "left")
                      .select("word", F.coalesce("_to", "root").alias("root")), "spelling-ways")
    return ways


def group_variants(words: DataFrame, times: int = 10, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` for a vocabulary.

    The form is the most frequent neighbour, if it is at least ``times`` as frequent.
    """
    words = staged(words, "spelling-words")
    near = neighbours(words, block_chars)
    led = F.col("best_n") >= F.lit(times) * F.col("n")
    formed = staged(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(led, F.col("best")).alias("form"), F.when(led, F.col("best_n")).alias("form_n")), "spelling-forms")
    ends = roots(formed.where(F.col("form").isNotNull()))
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
