"""Mixing sources to target weights by iterative proportional fitting.

Documents are counted into cells (one per combination of source, language and topic) with
their tokens.  Every margin gets targets for the tokens to keep: the wanted share of all
tokens, split by flattened shares, no value above what it holds (what that leaves goes to the
others).  Raking takes the margins in turn and scales the weights of each value's cells so
that its target is met exactly, where a cell counts at most what it holds: full cells leave
the target, open ones are scaled to the rest.  Rounds go on until the largest gap is below
:data:`TOLERANCE` of its target, or falls no more because the margins contradict each other;
:func:`margins_of` reports reached against wanted.  A document is kept with the probability
weight / tokens of its cell, at most 1.  The draw is a hash of its key, so it repeats.

Everything is DataFrame expressions.  Only cells are raked: documents are read once to count
and once to sample, and a hot source is counted before anything is shuffled.  Up to
:data:`CELLS_AT_ONCE` cells are raked in one partition, more by shuffles.  A plan of windows over
shuffles is planned anew, whole, after each of them; that took the driver most of its memory.

Nulls in a margin are the value ``unknown``; a null text has no bytes and counts as one token,
as every document at least does; rows with equal keys are kept or dropped together; an empty
table gives an empty result.  Texts of any length are read whole, by their bytes only.  Columns
of the input named like the added ones are replaced.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gaugeworks.llm.common import staged, text_or_empty
from gaugeworks.session import cut_lineage

BYTES_PER_TOKEN = 4
TOLERANCE = 1e-9
ROUNDS_PER_CUT = 4
CELLS_AT_ONCE = 10_000
# Rounds of the SQL twin, which cannot test for convergence; tables so far need 6 to 26.
SQL_ROUNDS = 40
MARGINS = ("source", "lang", "topic")


def text_form(text: str = "text") -> Column:
    """A topic for tables without one: the form of the text."""
    body = text_or_empty(text)
    return (F.when(body.contains("!!"), "exclaimed").when(body.contains(" | "), "tabular")
            .when(F.length(body) - F.length(F.replace(body, F.lit("\n"), F.lit(""))) >= 8, "long")
            .otherwise("short"))


def marked(docs: DataFrame, topic: Column, text: str = "text") -> DataFrame:
    """Documents with the columns raking needs: margins without nulls, and ``n_tokens``."""
    tokens = F.greatest(F.lit(1), F.ceil(F.octet_length(text_or_empty(text)) / BYTES_PER_TOKEN))
    unknown = F.lit("unknown")
    return docs.withColumns({
        "topic": F.coalesce(topic, unknown), "source": F.coalesce("source", unknown),
        "lang": F.coalesce("lang", unknown), "n_tokens": tokens.cast("long")})


def _level(held: Column, wanted: Column, total: Column, values: WindowSpec, order: list[str]) -> Column:
    """The factor f with which the sum of least(held, f x wanted) is the total, over a window.

    In the order of held / wanted the first ones are full: the factor that fills the rest after
    j full ones is right for the first j where it leaves the next one open.
    """
    full_at = held / wanted
    rising = values.orderBy(full_at, *order)
    before = F.coalesce(F.sum(held).over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum(wanted).over(rising.rowsBetween(0, Window.unboundedFollowing))
    return (total - before) / rest


def flattened(cells: DataFrame, powers: Mapping[str, float], share: float = 1.0) -> DataFrame:
    """Tokens to keep per cell and margin: each value's part is its tokens to the given power.

    A power of 1 keeps the margin, 0 makes its values equal.  A value whose part is more than it
    holds gets all it holds.
    """
    whole = cells.agg(F.sum("n_tokens") * F.lit(min(share, 1.0))).scalar()
    every = Window.partitionBy(F.lit(0))           # the values of one margin, already added up
    for margin, power in powers.items():
        values = (cells.groupBy(margin).agg(F.sum("n_tokens").alias("_held"))
                  .withColumn("_wanted", F.pow("_held", F.lit(power))).withColumn("_whole", whole))
        held, wanted = F.col("_held"), F.col("_wanted")
        values = values.withColumn("_factor", _level(held, wanted, F.col("_whole"), every, [margin]))
        fits = F.when(F.col("_factor") <= held / wanted, F.col("_factor"))
        factor = F.coalesce(F.max(fits).over(every), F.max(held / wanted).over(every))
        cells = cells.join(values.select(margin, F.least(held, factor * wanted).alias(f"target_{margin}")), margin)
    return cells


def _round(cells: DataFrame, margins: Sequence[str]) -> DataFrame:
    """Each margin in turn met exactly."""
    for margin in margins:
        value = Window.partitionBy(margin)
        held, weight = F.col("n_tokens"), F.col("weight")
        cells = cells.withColumn("_factor", _level(held, weight, F.col(f"target_{margin}"), value, list(margins)))
        fits = F.when(F.col("_factor") <= held / weight, F.col("_factor"))
        factor = F.coalesce(F.max(fits).over(value), F.max(held / weight).over(value))
        cells = cells.withColumn("weight", weight * factor).drop("_factor")
    return cells


def margins_of(cells: DataFrame, margins: Sequence[str] = MARGINS) -> DataFrame:
    """(margin, value, wanted, reached) of raked cells: the tokens to keep and those expected."""
    kept = F.least("n_tokens", "weight")
    return reduce(DataFrame.unionByName, [
        cells.groupBy(F.lit(m).alias("margin"), F.col(m).cast("string").alias("value"))
        .agg(F.max(f"target_{m}").alias("wanted"), F.sum(kept).alias("reached")) for m in margins])


def rake(cells: DataFrame, margins: Sequence[str] = MARGINS, tolerance: float = TOLERANCE) -> DataFrame:
    """Cells with ``weight`` and ``probability``: the chance that meets every ``target_<margin>``."""
    cells = cut_lineage(cells.withColumn("weight", F.col("n_tokens").cast("double")))
    few = cells.count() <= CELLS_AT_ONCE
    gap = None
    while True:
        cells = cells.coalesce(1) if few else cells        # in one partition no window shuffles
        for _ in range(ROUNDS_PER_CUT):
            cells = _round(cells, margins)
        cells = cut_lineage(cells)
        last, gap = gap, margins_of(cells, margins).agg(
            F.max(F.abs(F.col("reached") / F.col("wanted") - 1)).alias("gap")).first()["gap"]
        if gap is None or gap <= tolerance or last is not None and gap >= last * 0.999:
            return cells.withColumn("probability", F.least(F.lit(1.0), F.col("weight") / F.col("n_tokens")))


def draw(key: Column, seed: str) -> Column:
    """A uniform number in [0, 1) from a hash of the key; null keys share one."""
    hashed = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary"))
    return F.conv(F.substring(hashed, 1, 13), 16, 10).cast("double") / float(1 << 52)


def sample(docs: DataFrame, topic: Column, powers: Mapping[str, float], share: float,
           seed: str = "mix", key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents kept, with ``topic``, ``n_tokens`` and the ``probability`` they had."""
    rows = marked(docs, topic, text)
    margins = list(powers)
    cells = staged(rows.groupBy(*margins).agg(F.sum("n_tokens").alias("n_tokens")), "mixing-cells")
    raked = rake(flattened(cells, powers, share), margins)
    chances = staged(raked.select(*margins, "probability"), "mixing-chances")
    return (rows.drop("probability").join(chances, margins)
            .where(draw(F.col(key), seed) < F.col("probability")))


def mix(docs: DataFrame, topic: Column, powers: Mapping[str, float], share: float,
        seed: str = "mix", key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents kept, with the columns they came with."""
    used = list(dict.fromkeys((key, text, "source", "lang")))
    rows = docs.select(F.struct("*").alias("_given"), *used)
    return sample(rows, topic, powers, share, seed, key=key, text=text).select("_given.*")


def sampling_sql(powers: Mapping[str, float], share: float, seed: str = "mix", rounds: int = SQL_ROUNDS) -> str:
    """The same sample in SQL, with the rounds written out."""
    margins = list(powers)
    names = ", ".join(margins)
    lines = [f"""
        marked AS MATERIALIZED (
            SELECT doc_id, coalesce(source, 'unknown') AS source, coalesce(lang, 'unknown') AS lang,
                   CASE WHEN contains(coalesce(text, ''), '!!') THEN 'exclaimed'
                        WHEN contains(coalesce(text, ''), ' | ') THEN 'tabular'
                        WHEN length(coalesce(text, '')) - length(replace(coalesce(text, ''), chr(10), '')) >= 8
                        THEN 'long' ELSE 'short' END AS topic,
                   CAST(greatest(1, ceil(strlen(coalesce(text, '')) / {BYTES_PER_TOKEN})) AS BIGINT) AS n_tokens
            FROM documents)""", f"""
        cells AS MATERIALIZED (SELECT {names}, sum(n_tokens)::BIGINT AS n_tokens FROM marked GROUP BY {names})"""]
    targets = []

    def level(held: str, wanted: str, total: str, window: str, order: str) -> str:
        rising = f"({window} ORDER BY {held} / {wanted}, {order}"
        return f"""({total} - coalesce(sum({held}) OVER {rising} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                   / sum({wanted}) OVER {rising} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""

    def factor(held: str, wanted: str, window: str) -> str:
        return f"""coalesce(max(CASE WHEN f <= {held} / {wanted} THEN f END) OVER ({window}),
                            max({held} / {wanted}) OVER ({window}))"""

    for m, power in powers.items():
        lines.append(f"""
        h_{m} AS MATERIALIZED (
            SELECT *, {level('held', 'wanted', 'whole', '', m)} AS f
            FROM (SELECT {m}, sum(n_tokens)::DOUBLE AS held, pow(sum(n_tokens)::DOUBLE, {power}) AS wanted,
                         any_value({share} * (SELECT sum(n_tokens) FROM cells)) AS whole FROM cells GROUP BY {m})),
        t_{m} AS MATERIALIZED (
            SELECT {m}, least(held, wanted * {factor('held', 'wanted', '')}) AS target_{m} FROM h_{m})""")
        targets.append(f"JOIN t_{m} USING ({m})")
    lines.append(f"""
        r0 AS MATERIALIZED (SELECT cells.* REPLACE (n_tokens::DOUBLE AS n_tokens), {', '.join(f'target_{m}' for m in margins)},
                   n_tokens::DOUBLE AS weight FROM cells {' '.join(targets)})""")
    at = 0
    for _ in range(rounds):
        for m in margins:
            lines.append(f"""
        r{at + 1} AS MATERIALIZED (
            SELECT * EXCLUDE (f) REPLACE (weight * {factor('n_tokens', 'weight', f'PARTITION BY {m}')} AS weight)
            FROM (SELECT *, {level('n_tokens', 'weight', f'target_{m}', f'PARTITION BY {m}', names)} AS f FROM r{at}))""")
            at += 1
    return "WITH" + ",".join(lines) + f"""
        SELECT doc_id, source, lang, topic, n_tokens, round(least(1.0, weight / held), 6) AS probability
        FROM (SELECT marked.*, weight, r{at}.n_tokens AS held FROM marked JOIN r{at} USING ({names}))
        WHERE ('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT
              / pow(2, 52) < least(1.0, weight / held)"""
