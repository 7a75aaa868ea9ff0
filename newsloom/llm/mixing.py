"""Mixing sources to target weights: capped water-filling, then seeded repetitions.

Only DataFrame operations. Every source asks for a share of the whole by its
weight; a source whose share is above ``max_epochs`` times its size is clamped
there and the excess goes to the others by weight, until none is above. A
document is then repeated as often as its source's epochs say: the whole part
for all documents, the fraction for documents of low seeded hash, up to the
hash at which the fraction's words are reached.

Defined cases: a null source is a source (last by code point); a null or blank
text has size 0 and is taken 0 words; a source without words has target 0; an
empty table gives no rows; repeated rows share their fate; other columns are
carried along, except clashing ones named like an output, which are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.operators.ordering import running_index
from newsloom.session import stage

from .common import WORD

LEVELS, BITS = 4, 10  # the hash is refined in so many steps of so many bits


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def cycled_weights(sources: DataFrame, weights: Sequence[float]) -> DataFrame:
    """Weights repeating over the sources by code point, null last; column ``weight``."""
    known = running_index(sources.filter("source is not null"), ["source"], out="place")
    after = sources.filter("source is null").withColumn("place", F.lit(known.count()).cast("long"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    return known.unionByName(after).withColumn("weight", F.get(cycle, (F.col("place") % len(weights)).cast("int")))


def water_fill(sources: DataFrame, max_epochs: float) -> DataFrame:
    """Add ``target`` to one row per source (``source_size``, ``weight``).

    Each round asks for two sums; sources once clamped stay clamped, so there
    are never more rounds than sources. Where even the caps cannot hold the whole,
    every source stands at its cap.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("t")).first()["t"]
    per_weight = 0.0  # words for each unit of weight, growing from round to round
    while True:
        full = cap <= F.lit(per_weight) * F.col("weight")
        sums = sources.agg(
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)).alias("held"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("open")).first()
        asked = (total - sums["held"]) / sums["open"] if sums["open"] else per_weight
        if asked <= per_weight:
            return sources.withColumn("target", F.least(cap, F.lit(per_weight) * F.col("weight")))
        per_weight = asked


def _same(left: DataFrame, right: DataFrame) -> Column:
    """Sources are equal or both null, said so that the planner sees plain equalities."""
    pairs = [(F.coalesce(d["source"], F.lit("")), d["source"].isNull()) for d in (left, right)]
    return (pairs[0][0] == pairs[1][0]) & (pairs[0][1] == pairs[1][1])


def _fraction_cuts(sized: DataFrame, wanted: DataFrame) -> DataFrame:
    """For each source the hash up to which documents give the ``fraction`` words, as near as whole documents allow.

    Level by level the words are summed over 1 024 ranges of the hash, and the
    range in which the wanted sum lies is taken apart next. Sums are made
    before the shuffle; a source has at most 1 024 rows after it.
    """
    cuts = stage(wanted.select("source", F.col("fraction").alias("left"), F.lit(0).cast("long").alias("prefix")), "mix-cuts")
    for level in range(1, LEVELS + 1):
        here, above = 60 - BITS * level, 60 - BITS * (level - 1)
        inside = sized.join(cuts, _same(sized, cuts) & (F.shiftright("spot", above) == F.col("prefix"))).select(
                sized["source"], F.shiftright("spot", here).alias("bin"), "size", "left")
        ranges = inside.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.first("left").alias("left"))
        listed = ranges.groupBy("source", "left").agg(F.array_sort(F.collect_list(F.struct("bin", "words"))).alias("bins"))
        # of the last ranges the nearer border is taken, before that the range is entered
        passed = (lambda left, words: left * 2 >= words) if level == LEVELS else (lambda left, words: left >= words)
        walked = listed.withColumn("found", F.aggregate(
            "bins", F.struct(F.lit(-1).cast("long").alias("bin"), F.col("left").alias("left"), F.lit(False).alias("done")),
            lambda a, b: F.when(a["done"], a).otherwise(F.struct(
                b["bin"].alias("bin"), F.when(passed(a["left"], b["words"]), a["left"] - b["words"]).otherwise(a["left"]).alias("left"),
                (~passed(a["left"], b["words"])).alias("done")))))
        # a wanted sum that reaches beyond all ranges ends after the last
        spot = F.when(F.col("found.done"), F.col("found.bin")).otherwise(F.col("found.bin") + 1)
        cuts = stage(walked.select("source", F.col("found.left").alias("left"), spot.alias("prefix")), "mix-cuts")
    return cuts.select("source", F.col("prefix").alias("cut"))


_WORKING = ["__spot", "__source", "__of", "__cut", "__whole"]


def mix_sources(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: Sequence[float] = (1, 2, 3), max_epochs: float = 3.0, seed: int = 17) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``copies``, the repetitions the mix takes."""
    spot = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col), F.xxhash64(text_col)), 4)
    keyed = docs.drop("size", "source_size", "target", "copies", *_WORKING).withColumns({
        "size": word_count(text_col), "__spot": spot})
    sized = stage(keyed.select(F.col(source_col).alias("source"), "size", F.col("__spot").alias("spot")), "mix-sizes")
    sources = stage(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    targets = stage(water_fill(cycled_weights(sources, weights), max_epochs), "mix-targets")
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(epochs + 1e-12).cast("long")
    plan = targets.select("source", "source_size", "target", whole.alias("whole"),
                          F.round(F.col("target") - whole * F.col("source_size")).cast("long").alias("fraction"))
    cuts = _fraction_cuts(sized, plan.filter("fraction > 0 and source_size > 0"))
    plan = plan.join(cuts, _same(plan, cuts), "left").select(
        plan["source"].alias("__of"), "source_size", "target", F.col("whole").alias("__whole"), F.coalesce("cut", F.lit(0)).alias("__cut"))
    once_more = F.shiftright("__spot", 60 - BITS * LEVELS) < F.col("__cut")
    # one row per source; the planner broadcasts it while its written size allows
    plan = stage(plan, "mix-plan")
    named = keyed.withColumn("__source", F.col(source_col))
    joined = named.join(plan, (F.coalesce("__source", F.lit("")) == F.coalesce("__of", F.lit(""))) & (
        F.col("__source").isNull() == F.col("__of").isNull()), "left").drop("__of")
    return joined.withColumn("copies", (F.col("__whole") + F.when(once_more, 1).otherwise(0)).cast("long")).drop(*_WORKING)


def take_copies(mixed: DataFrame) -> DataFrame:
    """One row for each repetition the mix takes."""
    each = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))
    return mixed.filter("copies > 0").withColumn("__copy", each).drop("__copy")
