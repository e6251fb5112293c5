"""Short codes for vectors: each is cut into parts, each part is named by an entry of its codebook.

Codebooks are fitted by Lloyd rounds that look again only where something moved.  Every part
keeps the entry it is assigned to and the exact squared distance to it.  After an update, a
part whose entry stayed compares only the entries that moved with the stored distance; a part
whose entry moved compares all entries.  Ties go to the lower index in both cases, so the
result is that of comparing everything in every round.

Each round writes vectors, codes and distances to the shared folder once and reads them once
for the new sums; the driver holds codebooks (entries x dimension numbers) and nothing else.

Components become ``floor(scale * x)``, clamped to 2**28 either way so that squared distances
fit in a long.  Vectors that are null or hold null or non-finite components are dropped, and
so are those of another length than the first kept vector (smallest key, nulls last).  A
length that the parts do not divide is filled up with zeros.  Fewer vectors than entries give
fewer entries; repeated rows count each; rows with a null key keep their place at the end; an
empty table gives an empty result and the digest of an empty text.  Other columns are left out.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.llm.common import staged, typed

LARGEST = 1 << 28
# Up to this size every term of |x - c|^2 stays below 2**53, so doubles hold it exactly.
EXACT_IN_DOUBLES = 1 << 20
BATCH = 4096


def integers(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
             scale: int = 4096) -> DataFrame:
    """``key``, ``label`` and ``v``: whole-number components of the usable vectors."""
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    usable = F.col(vector).isNotNull() & F.forall(
        x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    whole = F.transform(x, lambda c: F.floor(F.greatest(
        F.lit(-float(LARGEST)), F.least(F.lit(float(LARGEST)), c * float(scale)))).cast("int"))
    kept = df.where(usable).select(F.col(key).alias("_key"), F.col(label).alias("_label"), whole.alias("v"))
    # The length of the first kept vector is the length of all.
    width = kept.agg(F.min_by(F.size("v"), F.struct(F.col("_key").isNull(), "_key", "v")).alias("w")).scalar()
    return kept.where(F.size("v") == width)


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances, rows of x against entries."""
    if max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0)) * max(x.shape[1], 1) ** 0.5 <= EXACT_IN_DOUBLES:
        a, b = x.astype(float), entries.astype(float)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    out = np.zeros((len(x), len(entries)), np.int64)
    for e, entry in enumerate(entries):
        out[:, e] = ((x - entry) ** 2).sum(1)
    return out


def reassign(x: np.ndarray, code: np.ndarray, near: np.ndarray, books: np.ndarray,
             moved: np.ndarray) -> None:
    """Bring ``code`` and ``near`` (rows x parts) up to date with the codebooks, in place.

    ``x`` is rows x parts x width, ``books`` parts x entries x width, ``moved`` parts x entries.
    """
    for p in range(books.shape[0]):
        active = np.flatnonzero(moved[p])
        if not active.size:
            continue
        lost = moved[p][code[:, p]]
        again = np.flatnonzero(lost)
        if again.size:
            apart = distances(x[again, p], books[p])
            code[again, p] = apart.argmin(1)
            near[again, p] = apart.min(1)
        kept = np.flatnonzero(~lost)
        if kept.size:
            apart = distances(x[kept, p], books[p][active])
            best = apart.argmin(1)
            value, entry = apart[np.arange(len(kept)), best], active[best]
            better = (value < near[kept, p]) | ((value == near[kept, p]) & (entry < code[kept, p]))
            code[kept[better], p] = entry[better]
            near[kept[better], p] = value[better]


def _matrix(column: pa.Array, parts: int) -> np.ndarray:
    """List values of equal length as rows x parts x width, filled up with zeros."""
    rows = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(rows, -1)
    width = -(-flat.shape[1] // parts)
    return np.pad(flat, ((0, 0), (0, parts * width - flat.shape[1]))).reshape(rows, parts, width)


def _assigned(state: DataFrame, books: np.ndarray, moved: np.ndarray) -> DataFrame:
    """The state after one assignment; the first one finds no codes and compares everything."""
    parts = books.shape[0]
    first = "code" not in state.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH):
                batch = whole.slice(start, BATCH)
                rows = batch.num_rows
                x = _matrix(batch.column(2), parts)
                if first:
                    code, near = np.zeros((rows, parts), np.int64), np.zeros((rows, parts), np.int64)
                else:
                    code = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(rows, parts).astype(np.int64)
                    near = batch.column(4).flatten().to_numpy().reshape(rows, parts).copy()
                reassign(x, code, near, books, moved)
                bounds = pa.array(np.arange(rows + 1, dtype=np.int32) * parts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), batch.column(2),
                     pa.array([c.tobytes() for c in code.astype(np.uint8)], pa.binary()),
                     pa.ListArray.from_arrays(bounds, pa.array(near.ravel()))],
                    ["_key", "_label", "v", "code", "near"])

    schema = T.StructType([typed(state, "_key"), typed(state, "_label"), typed(state, "v"),
                           T.StructField("code", T.BinaryType()),
                           T.StructField("near", T.ArrayType(T.LongType()))])
    return state.select("_key", "_label", "v", *([] if first else ["code", "near"])).mapInArrow(run, schema)


def _sums(state: DataFrame, shape: tuple[int, int, int]) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Count and component sums per part and entry; each task hands on one row per entry."""
    parts, entries, width = shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros(shape, np.int64)
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH):
                batch = whole.slice(start, BATCH)
                x = _matrix(batch.column(0), parts)
                code = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, parts)
                for p in range(parts):
                    member = code[:, p, None] == np.arange(entries)
                    counts[p] += member.sum(0)
                    # Below 2**28 * 4096 rows, so doubles hold a batch's sums exactly.
                    sums[p] += (member.T.astype(float) @ x[:, p].astype(float)).astype(np.int64)
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry], pa.int64()),
             pa.array(list(sums[part, entry]), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])

    partial = state.select("v", "code").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    totals = partial.select("part", "entry", "n", F.posexplode("sums")).groupBy("part", "entry", "pos").agg(
        F.sum("n").alias("n"), F.sum(F.col("col").cast("decimal(38,0)")).alias("total"))
    found: dict[tuple[int, int], tuple[int, list[int]]] = {}
    for r in totals.collect():                               # entries x dimension rows, whatever the data
        found.setdefault((r["part"], r["entry"]), (r["n"], [0] * width))[1][r["pos"]] = int(r["total"])
    return found


def fit(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6) -> tuple[DataFrame, np.ndarray]:
    """The final state (``_key``, ``_label``, ``v``, ``code``, ``near``) and the codebooks."""
    if entries > 256:
        raise ValueError("a code is one byte per part")
    state = staged(vectors, "codes-start")
    seeds = (state.orderBy(F.col("_key").isNull(), "_key", "v").limit(entries).select("v").collect())
    if not seeds:
        empty = state.select("_key", "_label", "v", F.lit(b"").alias("code"),
                             F.array().cast("array<long>").alias("near"))
        return empty, np.zeros((parts, 0, 0), np.int64)
    books = _matrix(pa.array([r["v"] for r in seeds], pa.list_(pa.int64())), parts).transpose(1, 0, 2).copy()
    moved = np.ones(books.shape[:2], bool)
    for _ in range(rounds):
        state = staged(_assigned(state, books, moved), "codes")
        fresh = books.copy()
        for (part, entry), (n, total) in _sums(state, books.shape).items():
            fresh[part, entry] = [t // n for t in total]
        moved = (fresh != books).any(2)
        books = fresh
    return staged(_assigned(state, books, moved), "codes"), books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components in part, entry and position order."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def codes(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
          parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> DataFrame:
    """``key``, ``code`` (two hex digits a part), ``error``, ``label_error``, ``codebooks_sha256``.

    ``error`` is the final squared distance summed over the parts; ``label_error`` sums it over
    all rows of the label, missing labels together.
    """
    state, books = fit(integers(df, key, vector, label, scale), parts, entries, rounds)
    coded = state.select("_key", "_label", F.lower(F.hex("code")).alias("code"),
                         F.aggregate("near", F.lit(0).cast("long"), lambda a, b: a + b).alias("error"))
    labels = coded.groupBy("_label").agg(F.sum("error").alias("label_error")).withColumnRenamed("_label", "_same")
    return (coded.join(labels, F.col("_label").eqNullSafe(F.col("_same")), "left")
            .select(F.col("_key").alias(key), "code", "error", "label_error",
                    F.lit(digest(books)).alias("codebooks_sha256")))


def codes_sql(width: int, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """The same over ``embeddings`` in DuckDB, every part compared with every entry in every round.

    ``width`` is the length of a part.
    """
    cut = ", ".join(f"v[{p * width + 1}:{(p + 1) * width}]" for p in range(parts))
    mean = ", ".join(f"floor(sum(x[{i + 1}]) / count(*))" for i in range(width))
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
        a{r} AS MATERIALIZED (
            SELECT row, part, any_value(x) AS x, CAST(min((list_inner_product(x, x) - 2 * list_inner_product(x, c)
                     + list_inner_product(c, c)) * {entries} + entry) AS BIGINT) AS best
            FROM cut JOIN b{r} USING (part) GROUP BY row, part)""")
        if r < rounds:
            steps.append(f"""
        b{r + 1} AS MATERIALIZED (
            SELECT part, entry, coalesce(m.c, b.c) AS c FROM b{r} AS b LEFT JOIN (
                SELECT part, best % {entries} AS entry, [{mean}] AS c FROM a{r} GROUP BY ALL) AS m
            USING (part, entry))""")
    return f"""
        WITH kept AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS row, vec_id, label,
                   [floor({scale} * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
            FROM embeddings WHERE embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        cut AS MATERIALIZED (
            SELECT row, unnest([{cut}]) AS x, unnest(range({parts})) AS part FROM kept),
        b0 AS MATERIALIZED (
            SELECT part, row AS entry, x AS c FROM cut WHERE row < {entries}), {", ".join(steps)},
        coded AS (
            SELECT row, string_agg(printf('%02x', best % {entries}), '' ORDER BY part) AS code,
                   CAST(sum(best // {entries}) AS BIGINT) AS error FROM a{rounds} GROUP BY row),
        book AS (
            SELECT sha256(string_agg(CAST(CAST(value AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, place)) AS sha
            FROM (SELECT part, entry, unnest(c) AS value, unnest(range(len(c))) AS place FROM b{rounds}))
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               sha AS codebooks_sha256
        FROM kept JOIN coded USING (row) CROSS JOIN book"""
