"""Mixing sources to target weights.

Sizes (words) are added up by source. Sources in code point order, null last, weigh 3, 1, 2
and so on, and share ``budget`` times all words; no target exceeds ``ceiling`` times its
source, and what that cuts off goes to the others by weight. Instead of resharing in turns,
sources are ordered by ceiling over weight: the ones that reach their ceiling come first,
and running sums tell where that ends.

A source's rate is target over size. Each document is emitted floor(rate) times, and once
more with probability equal to the fraction, drawn from a hash of seed and id.

A source of few or long documents may draw words far from its target. Each source therefore
tries SHIFTS seeds, which turn its draws by as many steps of one circle, and keeps the one
whose words come nearest: one more aggregate by source over ids and sizes, texts are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadline.llm.cuckoo import fresh_name
from leadline.llm.words import WORD

WEIGHTS = (3, 1, 2)
SEED = "mix"
# Budget and ceiling in halves, so that all sums stay whole numbers.
BUDGET_HALVES = 3
CEILING_HALVES = 4
SHIFTS = 32
MOST_BROADCAST = 100_000


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, source: str = "source", size: str = "size") -> DataFrame:
    """One row for each source: source, source_size, weight, target, rate.

    Aggregated by source before anything else; the running sums see one row for each source.
    """
    summed = sizes.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    by_code = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_code) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (place % len(WEIGHTS) + 1).cast("int"))
    ranked = summed.select("source", "source_size", place.alias("place"), weight.cast("long").alias("weight"))
    order = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), "place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everywhere = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cap = F.lit(CEILING_HALVES) * F.col("source_size")
    stepped = ranked.select(
        "*",
        cap.alias("cap"),
        (F.lit(BUDGET_HALVES) * F.sum("source_size").over(everywhere)).alias("budget"),
        F.coalesce(F.sum(cap).over(before), F.lit(0)).alias("cap_before"),
        (F.sum("weight").over(everywhere) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("weight_left"),
    )
    full = (F.col("budget") - F.col("cap_before")) * F.col("weight") > F.col("cap") * F.col("weight_left")
    flagged = stepped.withColumn("full", full)
    left = F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(everywhere), F.lit(0))
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(everywhere)
    share = (left * F.col("weight")).cast("double") / (F.lit(2) * open_weight).cast("double")
    target = F.when(F.col("full"), F.col("cap").cast("double") / F.lit(2.0)).otherwise(share)
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0))
    return flagged.select("source", "source_size", "weight", target.alias("target"), rate.alias("rate"))


def _small(targets: DataFrame) -> DataFrame:
    """Written once; sent to all tasks if its rows are few, joined by shuffle otherwise."""
    targets = targets.checkpoint()
    return F.broadcast(targets) if targets.count() <= MOST_BROADCAST else targets


def draw(ident: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from 52 bits of a hash; the same in every run."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def turned(drawn: Column, shift: Column) -> Column:
    """A draw moved on by ``shift`` of SHIFTS steps around the circle; exact in doubles."""
    moved = drawn + shift / F.lit(float(SHIFTS))
    return F.when(moved >= 1.0, moved - 1.0).otherwise(moved)


def copies_at(rate: Column, drawn: Column) -> Column:
    whole = F.floor(rate)
    return (whole + F.when(drawn < rate - whole, 1).otherwise(0)).cast("long")


def with_shifts(targets: DataFrame, sizes: DataFrame, ident: str, seed: str = SEED) -> DataFrame:
    """``targets`` with ``shift``: which seed takes the words nearest to each source's target.

    Of equal distances the least shift. ``targets`` has ``of_source``, ``sizes`` source and size.
    """
    rate = F.col("rate")
    drawn = sizes.select("source", "size", draw(F.col(ident), seed).alias("drawn"))
    joined = drawn.join(targets, F.col("source").eqNullSafe(F.col("of_source")))
    tried = joined.groupBy("of_source").agg(
        *[
            F.sum(F.when(turned(F.col("drawn"), F.lit(n)) < rate - F.floor(rate), F.col("size")).otherwise(0)).alias(f"once_{n}")
            for n in range(SHIFTS)
        ]
    )
    whole = F.floor(rate) * F.col("source_size")
    found = targets.join(tried.withColumnRenamed("of_source", "tried"), F.col("of_source").eqNullSafe(F.col("tried")))
    off = [F.struct(F.abs((whole + F.col(f"once_{n}")).cast("double") - F.col("target")), F.lit(n).alias("n")) for n in range(SHIFTS)]
    return found.select(*targets.columns, F.array_min(F.array(*off))["n"].alias("shift"))


def mix_sizes(
    sizes: DataFrame, ident: str = "doc_id", source: str = "source", size: str = "size", seed: str = SEED
) -> DataFrame:
    """One row for each row of ``sizes``: ident, source, size, source_size, target, copies, taken.

    * A null source is one of its own, the last; a null size takes no words. A null id is drawn
      like an id named "null"; repeated ids share one draw. An empty table gives none.
    """
    rows = sizes.select(ident, F.col(source).alias("source"), F.coalesce(size, F.lit(0)).alias("size"))
    targets = _small(source_targets(rows).withColumnRenamed("source", "of_source"))
    targets = _small(with_shifts(targets, rows, ident, seed))
    copies = copies_at(F.col("rate"), turned(draw(F.col(ident), seed), F.col("shift")))
    return rows.join(targets, F.col("source").eqNullSafe(F.col("of_source"))).select(
        ident, "source", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken")
    )


def sizes_of(documents: DataFrame, ident: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Id, source and words of each document; written once, so texts are read once."""
    return documents.select(
        F.col(ident), F.col(source).alias("source"), words_in(F.col(text)).alias("size")
    ).checkpoint()


def mix_documents(
    documents: DataFrame, ident: str = "doc_id", text: str = "text", source: str = "source", seed: str = SEED
) -> DataFrame:
    """The mix: rows of ``documents`` as often as they are taken, all columns kept.

    * A null text has no words; a null source is a source of its own, the last one. A null
      id is drawn like an id named "null". Repeated ids share one draw.
    * A source without words has target 0 and is not emitted. An empty table gives none.
    """
    rate, shift, key = (fresh_name(documents.columns, name) for name in ("rate", "shift", "of"))
    sizes = sizes_of(documents, ident, text, source)
    targets = _small(source_targets(sizes).withColumnRenamed("source", "of_source"))
    chosen = with_shifts(targets, sizes, ident, seed)
    targets = _small(chosen.select(F.col("of_source").alias(key), F.col("rate").alias(rate), F.col("shift").alias(shift)))
    drawn = turned(draw(F.col(ident), seed), F.col(shift))
    return (
        documents.join(targets, F.col(source).eqNullSafe(F.col(key)))
        .withColumn(rate, copies_at(F.col(rate), drawn))
        .withColumn(rate, F.explode(F.expr(f"CASE WHEN `{rate}` > 0 THEN sequence(1L, `{rate}`) END")))
        .drop(key, rate, shift)
    )
