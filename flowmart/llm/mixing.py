"""Mixing sources to target weights by entropy balancing.

Every document starts with the rate 1. Of all rates between 0 and `most` that give each source its target number of words,
entropy balancing takes those closest to 1 in relative entropy. The convex dual has one multiplier per source, and the
rate of a document is exp(multiplier * size), cut off at `most`: an exponential tilt by size. Newton steps, kept within a
bracket, solve the dual for all sources at once; each is one distributed sum over (source, size) groups, so its cost does
not depend on how many documents share a size. Rates become whole copies by systematic rounding along the sizes of a
source, after which a few rounds of whole copies close what is left of the gap.

NULL texts have size 0 and are never taken. A NULL source is a source. Repeated rows are separate documents, but equal
ones may get different numbers of copies. Reruns give the same rows: places within a group follow a hash of doc_id.
An empty table gives an empty result. Only built-in expressions are used; the driver holds two numbers per step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmart.llm.common import WORD
from flowmart.workspace import written

WEIGHTS = (1.0, 2.0, 3.0)
MOST = 3
STEPS = 200  # of Newton's method, kept between bounds; halving them alone would take fewer
CLOSE = 1e-9
_SLICES = 256


def sized(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size in words (and the columns `keep` in one struct)."""
    size = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("bigint")
    extra = [F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_given")] if keep else []
    return docs.select("doc_id", "source", size.alias("size"), *extra)


def ranked(sources: DataFrame) -> DataFrame:
    """Adds _s: the place of each source by code point, NULL last, from 0. Sorted in ranges; only the number of rows of
    each range meets in one task."""
    by = F.col("source").asc_nulls_last()
    laid = sources.repartitionByRange(by).sortWithinPartitions(by).withColumn("_at", F.monotonically_increasing_id())
    laid = written(laid, "sources")
    place, within = F.shiftrightunsigned("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = laid.groupBy(place.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.coalesce(
        F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    offsets = counts.select("_part", before.alias("_before"))
    return (
        laid.withColumn("_part", place)
        .join(offsets, "_part")
        .withColumn("_s", F.col("_before") + within)
        .drop("_at", "_part", "_before")
    )


def with_targets(sources: DataFrame) -> DataFrame:
    """Adds target: the words of all sources shared out by weight, no source above MOST times its size.

    All uncapped sources get level * weight. Each round caps those above their limit and raises the level; it ends when
    no source is newly capped.
    """
    limit = F.col("source_size") * F.lit(float(MOST))
    everything = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    level = (everything[0] or 0) / everything[1] if everything[1] else 0.0
    while True:
        above = limit < F.col("weight") * F.lit(level)
        capped, weights = sources.agg(
            F.sum(F.when(above, limit)), F.sum(F.when(~above, F.col("weight")))
        ).first()
        raised = ((everything[0] or 0) - (capped or 0.0)) / weights if weights else level
        if raised <= level:
            break
        level = raised
    return sources.withColumn("target", F.least(limit, F.col("weight") * F.lit(float(level))))


def _rate(multiplier: Column, tilt: Column) -> Column:
    """exp(multiplier * tilt) cut off at MOST. A NULL multiplier stands for a source taken MOST times."""
    return F.coalesce(F.least(F.lit(float(MOST)), F.exp(multiplier * tilt)), F.lit(float(MOST)))


def balanced(groups: DataFrame, sources: DataFrame) -> DataFrame:
    """(_s, multiplier) that solves the dual. groups: _s, size, n, tilt = size / largest size of the source."""
    bounds = "CAST(0 AS double) AS multiplier, CAST(NULL AS double) AS low, CAST(NULL AS double) AS high"
    state = sources.where(F.col("target") < F.col("source_size") * MOST).selectExpr("_s", "target", *bounds.split(", "))
    for _ in range(STEPS):
        rate = _rate(F.col("multiplier"), F.col("tilt"))
        given = F.col("n") * F.col("size") * rate
        slope = F.sum(F.when(rate < MOST, given * F.col("tilt")))
        sums = groups.join(state, "_s").groupBy("_s").agg(
            F.sum(given).alias("words"), slope.alias("slope"), *[F.first(c).alias(c) for c in state.columns[1:]]
        )
        gap = F.col("target") - F.col("words")
        off = F.abs(gap) / F.greatest(F.col("target"), F.lit(1.0))
        low = F.when(gap > 0, F.col("multiplier")).otherwise(F.col("low"))
        high = F.when(gap < 0, F.col("multiplier")).otherwise(F.col("high"))
        newton = F.col("multiplier") + gap / F.col("slope")
        outside = newton.isNull() | (newton <= F.col("low")) | (newton >= F.col("high"))
        middle = F.coalesce((F.col("low") + F.col("high")) / 2, newton, F.col("multiplier") * 2 + F.sign(gap))
        stepped = (
            sums.withColumns({"low": low, "high": high, "off": off, "gap": gap})
            .withColumn("newton", newton)
            .withColumn("next", F.when(F.coalesce(outside, F.lit(False)), middle).otherwise(F.col("newton")))
            .withColumn("multiplier", F.when(F.col("off") < CLOSE, F.col("multiplier")).otherwise(F.col("next")))
        )
        stepped = written(stepped.select(*state.columns, "off"), "balance")
        worst = stepped.agg(F.max("off")).first()[0]
        state = stepped.drop("off")
        if worst is None or worst < CLOSE:
            return state.select("_s", "multiplier")
    raise RuntimeError(f"the rates of some source are {worst} off their target after {STEPS} steps")


def copies(groups: DataFrame, sources: DataFrame) -> DataFrame:
    """Adds total: the copies that the n documents of each (source, size) group get together.

    Systematic rounding along falling size: the running sum of rates is rounded, so that errors cancel between
    neighbours and what is left is at most the size of one document. The closing rounds then add (or take away) copies of
    the largest size that fits into the gap, until none does: every round makes the gap smaller than that size.
    """
    along = Window.partitionBy("_s").orderBy(F.col("size").desc())
    upto = F.sum(F.col("n") * F.col("rate")).over(along)
    rounded = groups.withColumn("_upto", F.floor(upto + 0.5))
    from_here = F.col("_upto") - F.coalesce(F.lag("_upto").over(along), F.lit(0))
    room = F.col("n") * MOST
    state = rounded.withColumn("total", F.greatest(F.lit(0), F.least(room, from_here)).cast("bigint")).drop("_upto")
    while True:
        state = written(state, "copies")
        taken = state.groupBy("_s").agg(F.sum(F.col("total") * F.col("size")).alias("_words"))
        gaps = taken.join(sources.select("_s", "target"), "_s").select("_s", (F.col("target") - F.col("_words")).alias("_gap"))
        open_ = F.when(F.col("_gap") > 0, F.col("total") < room).otherwise(F.col("total") > 0)
        fits = open_ & (F.col("size") <= F.abs("_gap"))
        best = state.join(gaps, "_s").where(fits).groupBy("_s").agg(F.max("size").alias("size"), F.first("_gap").alias("_gap"))
        best = written(best, "closing")
        if best.isEmpty():
            return state
        wanted = F.floor(F.abs("_gap") / F.col("size"))
        change = F.when(F.col("_gap") > 0, F.least(wanted, room - F.col("total"))).when(
            F.col("_gap") <= 0, -F.least(wanted, F.col("total"))
        )
        state = (
            state.join(best, ["_s", "size"], "left")
            .withColumn("total", F.col("total") + F.coalesce(change, F.lit(0)).cast("bigint"))
            .drop("_gap")
        )


def mixed(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, source_size, target, copies, taken (and _given) per row of docs."""
    rows = written(sized(docs), "sizes")
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.max("size").alias("largest"))
    weight = F.get(F.array(*[F.lit(w) for w in WEIGHTS]), F.pmod("_s", F.lit(len(WEIGHTS))))
    sources = written(ranked(sums).withColumn("weight", weight), "weights")
    sources = written(with_targets(sources), "targets")
    full = sized(docs, keep) if keep else rows  # whole rows move once, for their places; all sums use the narrow table
    placed = full.alias("r").join(
        sources.select("source", "_s").alias("s"), F.col("r.source").eqNullSafe(F.col("s.source"))
    ).select("r.*", "s._s")
    slice_ = F.pmod(F.xxhash64("doc_id"), F.lit(_SLICES))
    placed = placed.withColumn("_slice", slice_)
    counts = written(placed.groupBy("_s", "size", "_slice").agg(F.count("*").alias("n")), "slices")
    groups = counts.groupBy("_s", "size").agg(F.sum("n").alias("n")).where("size > 0")
    tilted = groups.join(sources.select("_s", "largest"), "_s").withColumn("tilt", F.col("size") / F.col("largest"))
    groups = written(tilted.drop("largest"), "groups")
    solved = groups.join(balanced(groups, sources), "_s", "left")
    rated = solved.withColumn("rate", _rate(F.col("multiplier"), F.col("tilt"))).drop("multiplier", "tilt")
    given = copies(rated, sources).select("_s", "size", "n", "total")
    # Of n documents of a group, total % n get one copy more. Their places come from slices, so that a group that holds
    # a third of all rows is ranked in many tasks.
    earlier = Window.partitionBy("_s", "size").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    dealt = offsets.join(given, ["_s", "size"], "left")
    within = F.row_number().over(Window.partitionBy("_s", "size", "_slice").orderBy(F.xxhash64("doc_id"), "doc_id"))
    ranked_rows = placed.withColumn("_within", within - 1).join(dealt, ["_s", "size", "_slice"])
    extra = (F.col("_before") + F.col("_within") < F.col("total") % F.col("n")).cast("bigint")
    number = F.coalesce(F.floor(F.col("total") / F.col("n")).cast("bigint") + extra, F.lit(0))
    final = ranked_rows.join(sources.select("_s", "source_size", "target"), "_s").withColumn("copies", number)
    given_columns = ["_given"] if keep else []
    return final.select(
        "doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), *given_columns
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of docs, all their columns, each as often as the mix takes it."""
    rows = mixed(docs, tuple(docs.columns)).where("copies > 0")
    times = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))
    return rows.select("_given", times.alias("_copy")).select("_given.*")
