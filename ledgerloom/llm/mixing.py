"""Mixing sources to target weights [native]: temperature mixing and budgeted block permutations.

A source's weight is its token share to the power a, normalised. The exponent is bisected between 0 (even
weights) and 1 (natural ones): the largest at which the weights' entropy still reaches the target, or, if it
is larger, the smallest at which no source repeats more often than the limit. Each job evaluates all midpoints of six bisection
steps at once, by one aggregation over the table of sources; that table never leaves the executors.

The weights are realised under a token budget. Each source is cut into blocks by a hash of the id. A pass over
a source (an *epoch*) takes its blocks in an order permuted anew, and permutes the rows inside each block. Whole
epochs are taken as often as the source's budget holds them; of the last one the prefix that still fits.
Running sums go over blocks first, then inside blocks, so a source with a third of all rows is many tasks.
Hashes are the first 60 bits of MD5, so that SQL elsewhere can give the same permutations.

Texts are counted once, into a written table (id, source, tokens), from which sizes, blocks and budgets come; only
``mixed``, which returns the texts, reads them again.

A row's tokens are its stretches without ASCII white space and one closing token. By default the budget is the
smallest at which every source is taken whole at least once: nothing is dropped, small sources repeat.

Defined results: null texts have one token; a null source counts as the empty name; repeated rows are rows of
their own; an empty table gives no rows; extra columns of any name are kept by ``mixed``. Without a limit of
repetitions an entropy near that of even weights repeats small sources as often as that takes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import materialize

#: Rows of a block; in sources of over 2**24 rows a quarter of the root of their number, so that neither the blocks of
#: a source nor the rows of a block, which one task orders, become too many.
BLOCK_ROWS = 1024
#: The table of sources is broadcast up to so many rows, and joined by shuffle beyond.
BROADCAST_SOURCES = 50_000
STEPS = 6


def token_count(text: Column) -> Column:
    """Stretches without ASCII white space, and one for the end."""
    return (F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")) + 1).cast("long")


def source_sizes(rows: DataFrame) -> DataFrame:
    """(source, tokens, rows) from rows with ``source`` and ``tokens``."""
    return rows.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))


def _at(sizes: DataFrame, total: int, exponents: list[float], budget: float | None) -> list[tuple[float, float, float]]:
    """For each exponent: the entropy of the weights, the most repetitions, and the budget."""
    grid = sizes.select((F.col("tokens") / F.lit(float(total))).alias("p"), F.explode(F.array(*map(F.lit, exponents))).alias("a"))
    rows = grid.groupBy("a").agg(
        F.sum(F.pow("p", "a")).alias("z"), F.sum(F.pow("p", "a") * F.log("p")).alias("s"),
        F.max(F.pow("p", 1 - F.col("a"))).alias("whole"), F.max(F.pow("p", F.col("a") - 1)).alias("most"),
    ).orderBy("a").collect()  # one row an exponent
    out = []
    for r in rows:
        spent = total * r["z"] * r["whole"] if budget is None else budget
        out.append((math.log(r["z"]) - r["a"] * r["s"] / r["z"], spent / total * r["most"] / r["z"], spent))
    return out


def _bisect(sizes: DataFrame, total: int, budget: float | None, right, rounds: int) -> float:
    """Where ``right`` (entropy, repetitions) turns true, between 0 and 1, going up; 1 if nowhere."""
    low, high = 0.0, 1.0
    for _ in range(rounds):
        n = 1 << STEPS
        grid = [low + (high - low) * i / n for i in range(n + 1)]
        found = next((i for i, x in enumerate(_at(sizes, total, grid, budget)) if right(x[0], x[1])), n)
        if found == 0:
            return low
        low, high = grid[found - 1], grid[found]
    return high


def choose_exponent(
    sizes: DataFrame, target_entropy: float | None, most_repeats: float | None, budget: float | None = None, rounds: int = 5
) -> tuple[float, float]:
    """The exponent and the token budget. ``target_entropy``: share of the entropy of even weights."""
    row = sizes.agg(F.sum("tokens"), F.count(F.lit(1))).first()
    total, number = row[0] or 0, row[1]
    if not total:
        return 1.0, 0.0
    exponent = 0.0 if target_entropy is None and most_repeats is not None else 1.0
    if target_entropy is not None:
        aim = target_entropy * math.log(number) if number > 1 else 0.0
        if _at(sizes, total, [1.0], budget)[0][0] < aim:
            exponent = _bisect(sizes, total, budget, lambda entropy, _: entropy <= aim, rounds)
    if most_repeats is not None:
        exponent = max(exponent, _bisect(sizes, total, budget, lambda _, repeats: repeats <= most_repeats * (1 + 1e-9), rounds))
    return exponent, _at(sizes, total, [exponent], budget)[0][2]


def hash60(*parts: Column | str) -> Column:
    """The first 60 bits of the MD5 of the parts as text, joined by colons, as a long."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *(F.col(x).cast("string") if isinstance(x, str) else x.cast("string") for x in parts))), 1, 15), 16, 10).cast("long")


def _counted(docs: DataFrame, id_col: str, text_col: str, source_col: str, *more: Column) -> DataFrame:
    return docs.select(
        *more, F.col(id_col).alias("_id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("_source"),
        token_count(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("tokens"),
    )


def _place(slim: DataFrame, rows: DataFrame, target_entropy: float | None, most_repeats: float | None, budget: float | None, seed: int) -> DataFrame:
    """``rows`` (with _id, _source, tokens) each time that they are taken, by a plan from the same columns in ``slim``."""
    sizes = materialize(source_sizes(slim.select(F.col("_source").alias("source"), "tokens")))
    exponent, spent = choose_exponent(sizes, target_entropy, most_repeats, budget)

    total = float(sizes.agg(F.sum("tokens")).first()[0] or 1)
    norm = float(sizes.agg(F.sum(F.pow(F.col("tokens") / F.lit(total), F.lit(exponent)))).first()[0] or 1)
    few = sizes.count() <= BROADCAST_SOURCES
    # the small excess keeps a source that the budget holds exactly whole in spite of rounding
    planned = sizes.select(
        F.col("source").alias("_source"),
        F.ceil(F.col("rows") / F.greatest(F.lit(float(BLOCK_ROWS)), F.sqrt("rows") / 4)).alias("_blocks"),
        F.col("tokens").alias("_own"),
        (F.pow(F.col("tokens") / F.lit(total), F.lit(exponent)) / F.lit(norm) * F.lit(spent) * (1 + 1e-9)).alias("_budget"),
    )
    cut = lambda df: df.join(F.broadcast(planned) if few else planned, "_source").withColumn("block", F.pmod(hash60("_id", F.lit(seed)), F.col("_blocks")))
    blocks = cut(slim.select("_id", "_source", "tokens")).groupBy("_source", "block", "_own", "_budget").agg(F.sum("tokens").alias("_sum"))
    taken = blocks.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.floor(F.col("_budget") / F.col("_own")).cast("int"))))
    order = Window.partitionBy("_source", "epoch").orderBy(hash60("block", "epoch", F.lit(seed)), "block")
    placed = taken.select(
        "_source", "block", "epoch",
        (F.row_number().over(order) - 1).alias("block_place"),
        (F.sum("_sum").over(order) - F.col("_sum")).alias("_before"),
        F.least(F.col("_budget") - F.col("epoch") * F.col("_own"), F.col("_own").cast("double")).alias("_left"),
    ).filter("_before < _left")
    inside = Window.partitionBy("_source", "block", "epoch").orderBy(hash60("_id", "epoch", F.lit(seed)), "_id", "tokens")
    chosen = cut(rows).drop("_blocks", "_own", "_budget").join(placed, ["_source", "block"])
    numbered = chosen.withColumns({
        "row_place": F.row_number().over(inside) - 1,
        "_after": F.col("_before") + F.sum("tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0)),
    })
    return numbered.filter("_after <= _left")


def mix_rows(
    docs: DataFrame, target_entropy: float | None = 0.95, most_repeats: float | None = 2.0, budget: float | None = None, seed: int = 17,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """The mixture without the texts, one row each time that a row is taken: id, source, tokens, epoch, block,
    block_place (in the epoch's permutation of the source's blocks) and row_place (in the block's)."""
    slim = materialize(_counted(docs, id_col, text_col, source_col, F.col(source_col).alias("_given")))
    out = _place(slim, slim, target_entropy, most_repeats, budget, seed)
    return out.select(F.col("_id").alias(id_col), F.col("_given").alias(source_col), "tokens", "epoch", "block", "block_place", "row_place")


def mixed(
    docs: DataFrame, target_entropy: float | None = 0.95, most_repeats: float | None = 2.0, budget: float | None = None, seed: int = 17,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """The mixture as rows of ``docs``, each as often as it is taken."""
    slim = materialize(_counted(docs, id_col, text_col, source_col))
    # the given columns travel as one struct, so their names can't clash with those added here
    rows = _counted(docs, id_col, text_col, source_col, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))
    return _place(slim, rows, target_entropy, most_repeats, budget, seed).select("_row.*")
