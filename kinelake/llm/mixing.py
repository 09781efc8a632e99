"""Mixing sources to target weights by entropy balancing, in DataFrame functions only.

Each document gets a rate r = exp(lambda_source * size / scale), at most ``most`` copies, so that the rates stay as close
(in relative entropy) to one copy as the token constraint of the source allows. The lambdas minimise the convex dual; they
are found by Newton steps inside a bracket, each step one distributed aggregation over the table of (source, size) counts,
which is all that rates depend on. Rates become whole copies by systematic rounding over sizes, largest first; what is
left per source is made up with its smallest documents.

Defined results: null text counts 0 words; null source is a source of its own, ordered last; documents of size 0 are never
taken; a source without words has target 0; an empty table gives an empty result; repeated ids are separate rows; very long
texts are counted whole; which of several rows of equal id, source and size gets the extra copy goes by their order in the table
(only kept columns can tell); columns beside id, text, source and those asked for are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, small, written

#: Groups of equal (source, size) above this many rows are ranked in slices, so that no task ranks an unbounded group.
SLICE = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """Orders by code point with null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``sizes``: key, source_size. Adds ``target``: shares by weight, cut at ``most`` times the size, the excess reshared.

    In order of cut / weight the sources that are cut form a prefix, so that the final level follows from running sums.
    """
    by_key = Window.orderBy("key")
    s = sizes.withColumn("place", (F.row_number().over(by_key) - 1) % len(weights))
    s = s.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("place") + 1))
    s = s.withColumn("cut", F.col("source_size") * F.lit(most)).withColumn("ratio", F.col("cut") / F.col("weight"))
    everything = Window.partitionBy()
    before = Window.orderBy("ratio", "key").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("cut").over(before), F.lit(0.0))
    weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    s = s.withColumn("level", left / weight).withColumn("is_cut", F.col("ratio") <= F.col("level"))
    # all uncut sources share the level that the first of them sees
    final = F.min(F.when(~F.col("is_cut"), F.struct("ratio", "key", "level"))).over(everything)["level"]
    return s.select("key", "source_size", F.when(F.col("is_cut"), F.col("cut")).otherwise(F.col("weight") * final).alias("target"))


def tilts(counts: DataFrame, sources: DataFrame, most: float = 2.0, tolerance: float = 1e-9, rounds: int = 60) -> DataFrame:
    """Per source the lambda of the dual optimum, by Newton's method held inside a bracket.

    counts: key, size, n. sources: key, source_size, target. The driver sees one number a round: the largest error.
    """
    scale = counts.groupBy("key").agg((F.sum(F.col("n") * F.col("size") * F.col("size")) / F.sum(F.col("n") * F.col("size"))).alias("scale"))
    state = sources.join(scale, "key", "left").select(
        "key", "target", "scale", F.lit(0.0).alias("tilt"), F.lit(-700.0).alias("low"), F.lit(700.0).alias("high"), F.lit(1.0).alias("error"),
        (F.col("target") >= F.col("source_size") * F.lit(most * (1 - 1e-12))).alias("full"),
    )
    state = written(state, "tilts")
    x, t = F.col("size") / F.col("scale"), F.col("tilt")
    rate = F.exp(F.least(t * x, F.lit(700.0)))
    for _ in range(rounds):
        step = (
            counts.join(state.where(~F.col("full")), "key")
            .groupBy("key")
            .agg(
                F.sum(F.col("n") * F.col("size") * F.least(rate, F.lit(most))).alias("words"),
                F.sum(F.when(rate < most, F.col("n") * F.col("size") * x * rate).otherwise(0.0)).alias("slope"),
            )
        )
        gap = F.col("words") - F.col("target")
        low, high = F.when(gap < 0, t).otherwise(F.col("low")), F.when(gap > 0, t).otherwise(F.col("high"))
        newton = F.when(F.col("slope") > 0, t - gap / F.col("slope"))
        moved = state.join(step, "key", "left").select(
            "key", "target", "scale", "full", low.alias("low"), high.alias("high"), "tilt", newton.alias("newton"),
            F.when(F.col("words").isNull() | (F.col("target") == 0), F.lit(0.0)).otherwise(F.abs(gap) / F.col("target")).alias("error"),
        )
        inside = (F.col("newton") > F.col("low")) & (F.col("newton") < F.col("high"))
        state = written(
            moved.withColumn(
                "tilt",
                F.when(F.col("error") <= tolerance, t).when(inside, F.col("newton")).otherwise((F.col("low") + F.col("high")) / 2),
            ).drop("newton"),
            "tilts",
        )
        if (state.agg(F.max("error")).first()[0] or 0.0) <= tolerance:
            break
    else:
        raise RuntimeError(f"the tilts are not settled after {rounds} rounds")
    return state.select("key", "scale", "tilt", "full")


def copies_by_size(counts: DataFrame, sources: DataFrame, tilt: DataFrame, most: int = 2) -> DataFrame:
    """Adds ``copies``: how many copies the n documents of a (source, size) get together."""
    rate = F.when(F.col("full"), F.lit(float(most))).otherwise(F.least(F.exp(F.least(F.col("tilt") * F.col("size") / F.col("scale"), F.lit(700.0))), F.lit(float(most))))
    c = counts.where(F.col("size") > 0).join(sources.select("key", "target"), "key").join(tilt, "key").withColumn("expected", F.col("n") * rate)
    down = Window.partitionBy("key").orderBy(F.desc("size"))
    upto = F.floor(F.sum("expected").over(down.rowsBetween(Window.unboundedPreceding, 0)) + 0.5)
    before = F.floor(F.coalesce(F.sum("expected").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)) + 0.5)
    c = c.withColumn("m", F.greatest(F.lit(0), F.least(upto - before, most * F.col("n"))).cast("long"))
    # what is missing (or too much) is made up from the smallest sizes on
    whole = Window.partitionBy("key")
    c = c.withColumn("gap", F.col("target") - F.sum(F.col("m") * F.col("size")).over(whole))
    room = F.when(F.col("gap") > 0, most * F.col("n") - F.col("m")).otherwise(F.col("m"))
    c = c.withColumn("room", room)
    up = Window.partitionBy("key").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    rest = F.abs("gap") - F.coalesce(F.sum(F.col("room") * F.col("size")).over(up), F.lit(0))
    by = F.greatest(F.lit(0), F.least(F.floor(rest / F.col("size") + 0.5), F.col("room")))
    return c.select("key", "size", "n", (F.col("m") + F.signum("gap") * by).cast("long").alias("copies"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, most: int = 2, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken and the columns in ``keep``.

    Kept columns are written once, with a number for the row. They meet the copies of their size by a join on the table of
    (source, size); only rows that must be ranked to share the copies of their size are looked up by number."""
    own = [F.monotonically_increasing_id().alias("row"), F.struct(*keep).alias("held")] if keep else []
    sized = written(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), source_key(F.col(source)).alias("key"), word_count(F.col(text)).alias("size"), *own), "sizes")
    counts = written(sized.groupBy("key", "size").agg(F.count("*").alias("n")), "size-counts")
    sources = written(source_targets(counts.groupBy("key").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), weights, share, float(most)), "targets")
    plan = copies_by_size(counts, sources, tilts(counts, sources, float(most)), most)
    plan = written(counts.select("key", "size").join(plan, ["key", "size"], "left").join(sources, "key"), "copies")

    if keep:
        plan = small(plan)
    rows = sized.join(plan, ["key", "size"])
    even = F.col("copies") % F.col("n") == 0
    settled = rows.where(F.col("copies").isNull() | even).withColumn("copies", F.coalesce(F.expr("copies div n"), F.lit(0)).cast("long"))
    # the others: rank within (source, size), by slices whose sizes are summed first
    cut = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.ceil(F.col("n") / F.lit(float(SLICE))))
    open_rows = rows.where(~even).drop("held").withColumn("slice", cut)
    slices = open_rows.groupBy("key", "size", "slice").agg(F.count("*").alias("held"))
    ahead = Window.partitionBy("key", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("ahead", F.coalesce(F.sum("held").over(ahead), F.lit(0))).drop("held")
    in_slice = Window.partitionBy("key", "size", "slice").orderBy(F.xxhash64("doc_id"), "doc_id", *(["row"] if keep else []))
    ranked = open_rows.withColumn("place", F.row_number().over(in_slice)).join(slices, ["key", "size", "slice"])
    place = F.col("ahead") + F.col("place")
    ranked = ranked.withColumn("copies", (F.expr("(copies * (ahead + place)) div n") - F.expr("(copies * (ahead + place - 1)) div n")).cast("long"))
    if keep:
        ranked = ranked.join(sized.select("row", "held"), "row")
    columns = ["doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), *(F.col(f"held.{c}").alias(c) for c in keep)]
    return settled.select(*columns).unionByName(ranked.select(*columns))
