"""Mixing sources to target weights, natively.

Temperature mixing: a source's share of all tokens, raised to an exponent t
between 0 and 1, gives its weight (t = 1 keeps the shares, t = 0 makes the
sources equal).  The exponent is bisected until the weights meet

* a target entropy (``entropy``: a share of the largest possible, log of the
  number of sources), or
* a repetition limit (``max_epochs``: no source is repeated more often), the
  flattest mix that keeps it.

The weights are realised under a token ``budget``.  A source's documents are
dealt by hash into blocks of about ``block_tokens`` tokens, or more where that
would make over ``max_blocks`` blocks of a source (a bound of the window that
orders a source's blocks; no document is left out).  Every epoch of a
source is a permutation of its blocks, and of the documents in each; whole
epochs are followed by one partial epoch, which takes blocks, and in the last
block documents, until the source's part of the budget is reached (the
document that reaches it is the last).

Only DataFrame functions are used.  Tokens are summed in each task before any
shuffle; running sums are taken over blocks per source, then over the
documents of the single block that the budget cuts.  A source may hold any
share of the rows: its documents are spread over its blocks.

Defined results: null or empty text has 0 tokens (its document is in an
epoch like any other); a null source is a source of its own; sources without
tokens get no weight and none of their documents; equal rows are drawn one
by one; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanlens.llm.common import WORD_PATTERN, cut, join_unique

ENTROPY = 0.97
BLOCK_TOKENS = 50_000
MAX_BLOCKS = 10_000
CELLS, ROUNDS = 64, 9        # nine rounds of six halvings each
DIGITS = 9                   # weights are rounded to so many decimals


@dataclass(frozen=True)
class Target:
    """What the exponent has to meet; the budget is ``budget`` times all tokens."""

    kind: str = "entropy"            # or "max_epochs"
    value: float = ENTROPY
    budget: float = 1.0


def tokens(text: Column) -> Column:
    """Words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def exponent(sources: DataFrame, target: Target) -> float:
    """The exponent for ``sources`` (share > 0).

    Entropy and repetition both fall as the exponent rises.  An entropy gets
    the largest exponent that still has it, a repetition limit the smallest
    that keeps it; out of reach, the end of [0, 1] that comes nearest.

    A round halves the bracket six times at once: one aggregate tests a grid.
    """
    low, high = 0.0, 1.0
    mass = F.pow(F.col("share"), F.col("t"))
    for _ in range(ROUNDS):
        step = (high - low) / CELLS
        tried = sources.select("share", F.explode(F.sequence(F.lit(0), F.lit(CELLS))).alias("cell"))
        tried = tried.withColumn("t", F.lit(low) + F.col("cell") * F.lit(step))
        sums = tried.groupBy("cell").agg(
            F.sum(mass).alias("m"), F.sum(mass * F.log(mass)).alias("ml"),
            F.max(mass / F.col("share")).alias("top"), F.count(F.lit(1)).alias("n"))
        if target.kind == "entropy":
            flat = F.log("m") - F.col("ml") / F.col("m") >= F.lit(target.value) * F.log("n")
        else:
            flat = F.col("top") / F.col("m") * target.budget > F.lit(target.value)
        # ``flat`` holds up to some cell, then no more.
        last = sums.agg(F.max(F.when(flat, F.col("cell"))).alias("cell")).first()["cell"]
        if last is None:
            return low
        if last == CELLS:
            return high
        low, high = low + last * step, low + (last + 1) * step
    return low if target.kind == "entropy" else high


def _draw(*parts: Column) -> Column:
    """A number below 2^48 from the md5 of the parts' texts."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")


def weigh(counts: DataFrame, target: Target, block_tokens: int = BLOCK_TOKENS, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """``counts`` (key, docs, tokens > 0) with weight, quota, whole epochs, rest and blocks of each source."""
    total = counts.agg(F.sum("tokens").alias("t")).first()["t"] or 0
    sources = counts.withColumn("share", F.col("tokens") / F.lit(float(total or 1)))
    t = exponent(sources, target) if total else 1.0
    mass = F.pow(F.col("share"), F.lit(t))
    all_mass = sources.agg(F.sum(mass).alias("m")).first()["m"] or 1.0
    quota = F.floor(F.round(mass / F.lit(all_mass), DIGITS) * F.lit(target.budget * total)).cast("long")
    blocks = F.least(F.ceil(F.col("tokens") / F.lit(block_tokens)), F.lit(max_blocks)).cast("long")
    out = sources.select("key", "docs", "tokens", quota.alias("quota"), blocks.alias("blocks"))
    return out.select("*", F.expr("quota div tokens").alias("whole"), (F.col("quota") % F.col("tokens")).alias("rest"))


def mix(df: DataFrame, target: Target = Target(), id_col: str = "doc_id", source_col: str = "source",
        text_col: str = "text", block_tokens: int = BLOCK_TOKENS, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """One row per drawn document: ``id``, ``source``, ``n_tokens``, ``epoch``, ``block_rank``, ``draw``.

    Reading a source's rows by (epoch, block_rank, draw, id) gives its stream.
    """
    docs = cut(df.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("-")).alias("key"),
        tokens(F.col(text_col)).alias("n_tokens")), "mix-docs")
    counts = docs.groupBy("key").agg(F.count(F.lit(1)).alias("docs"), F.sum("n_tokens").alias("tokens"))
    sources = cut(weigh(cut(counts.where(F.col("tokens") > 0), "mix-counts"), target, block_tokens, max_blocks), "mix-sources")
    dealt = join_unique(docs, sources.select("key", "blocks", F.col("docs").alias("w")), "key", "w")
    dealt = dealt.withColumn("block", F.pmod(_draw(F.lit("block"), F.col("key"), F.col("id")), F.col("blocks")))
    dealt = cut(dealt.drop("blocks"), "mix-dealt")

    # The blocks of every epoch in their order, with the tokens that the rest leaves to the last epoch's.
    plan = dealt.groupBy("key", "block").agg(F.sum("n_tokens").alias("size"))
    plan = plan.join(sources.select("key", "whole", "rest"), "key")
    plan = plan.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole"))))
    plan = plan.withColumn("place", _draw(F.lit("order"), F.col("epoch"), F.col("key"), F.col("block")))
    order = Window.partitionBy("key", "epoch").orderBy("place", "block")
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.when(F.col("epoch") == F.col("whole"), F.col("rest") - before)
    plan = plan.select("key", "block", "epoch", F.row_number().over(order).cast("long").alias("block_rank"),
                       left.alias("left")).where(F.col("left").isNull() | (F.col("left") > 0))

    drawn = dealt.join(plan, ["key", "block"])
    drawn = drawn.withColumn("draw", _draw(F.lit("doc"), F.col("epoch"), F.col("key"), F.col("id")))
    inside = Window.partitionBy("key", "block", "epoch").orderBy("draw", "id", "n_tokens")
    taken = F.coalesce(F.sum("n_tokens").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    drawn = drawn.withColumn("taken", taken).where(F.col("left").isNull() | (F.col("taken") < F.col("left")))
    return drawn.select("id", "source", "n_tokens", "epoch", "block_rank", "draw")
