"""Mixing sources to target weights by entropy balancing, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import delete, n_words, stash

#: Weights of the sources in their order, repeating.
WEIGHTS = (5, 2, 1)
#: Newton steps at most; each is safeguarded by a bracket, so this bounds the work and not the result.
STEPS = 60
BINS = 1024
#: Single documents that change sides of a source's cut in the end.
MOVES = 3
MOVED = "array<struct<at:double,size:bigint>>"


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Word targets of ``sizes(source, source_size)``, one row a source: source, source_size, target.

    Sources in code-point order, null last, weigh ``weights`` in turn and divide
    ``share`` times all words. A target stops at ``most`` times its source; the excess
    is dealt anew by weight until none is above. Sorted by cap over weight the capped
    sources come first, so running sums give the final level at once.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    # one row a source, summed before
    ranked = sizes.withColumn("w", F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(order) - 1) % len(weights)))
    ranked = ranked.withColumn("cap", most * F.col("source_size"))
    every = Window.partitionBy(F.lit(1))
    before = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    level = (share * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    ranked = ranked.withColumn("level", level).withColumn("capped", F.col("cap") <= F.col("w") * F.col("level"))
    final = F.max(F.when(~F.col("capped"), F.col("level"))).over(every)
    return ranked.withColumn("final", final).select("source", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(F.col("w") * F.col("final")).alias("target"))


def tilt(lam: Column, z: Column, most: float) -> Column:
    """exp(lam z), at most ``most``; the exponent is bounded first, so it never overflows."""
    return F.least(F.lit(most), F.exp(F.least(F.lit(50.0), lam * z)))


def balance(histogram: DataFrame, goals: DataFrame, most: float = 2.0, precise: float = 1e-10) -> DataFrame:
    """Multipliers ``(source, source_size, target, mean, lam)`` that solve the entropy-balancing dual.

    Of all rates r in [0, most] with sum(size r) = target in each source, those nearest
    to 1 in relative entropy are r = min(most, exp(lam size/mean)). lam is the root of
    the dual's gradient; ``histogram(source, size, n)`` counts documents of a size, which
    is all that the gradient depends on. Each Newton step is one aggregation over it, with
    a bracket to fall back on. lam is rounded to nine places so that reruns agree.
    """
    z = F.col("size") / F.col("mean")
    facts = histogram.filter("size > 0").groupBy(F.col("source").alias("_s")).agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"), F.min("size").alias("least"))
    state = goals.join(facts, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s").withColumn("mean", F.coalesce("mean", F.lit(1.0)))
    zero, low = F.lit(0.0), F.col("least") / F.col("mean")
    full = F.col("target") >= most * F.col("source_size") * (1 - 1e-12)
    ratio = F.col("target") / F.col("source_size")
    state = state.select(
        "source", "source_size", "target", "mean", (full | (F.col("source_size") == 0)).alias("full"),
        zero.alias("lam"),
        F.when(F.col("source_size") > 0, F.least(zero, F.log(F.greatest(ratio, F.lit(1e-300))) / low)).otherwise(zero).alias("lo"),
        F.when(F.col("source_size") > 0, F.log(F.lit(most)) / low).otherwise(zero).alias("hi"),
        F.lit(1.0).alias("off"),
    )
    state = stash(state, "mix-state")
    sizes = histogram.filter("size > 0").withColumnsRenamed({"source": "_s"})
    for _ in range(STEPS):
        rate = tilt(F.col("lam"), z, most)
        mass = F.col("size") * F.col("n")
        joined = sizes.join(state.filter(~F.col("full")), F.col("source").eqNullSafe(F.col("_s")))
        sums = joined.groupBy(F.col("_s")).agg(F.sum(mass * rate).alias("f"), F.sum(F.when(rate < most, mass * z * rate).otherwise(0.0)).alias("slope"))
        new = state.join(sums, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
        gap = F.coalesce(F.col("f") - F.col("target"), zero)
        lo, hi = F.when(gap < 0, F.col("lam")).otherwise(F.col("lo")), F.when(gap > 0, F.col("lam")).otherwise(F.col("hi"))
        step = F.col("lam") - F.coalesce(F.try_divide(gap, F.col("slope")), zero)
        near = F.abs(gap) <= precise * F.greatest(F.col("target"), F.lit(1.0))
        new = new.select(
            "source", "source_size", "target", "mean", "full",
            F.when(F.col("full") | near, F.col("lam")).when((step > lo) & (step < hi), step).otherwise((lo + hi) / 2).alias("lam"),
            lo.alias("lo"), hi.alias("hi"), F.when(F.col("full") | near, 0.0).otherwise(1.0).alias("off"),
        )
        old, state = state, stash(new, "mix-state")
        delete(old)
        if not state.agg(F.max("off")).first()[0]:
            break
    return state.select("source", "source_size", "target", F.when(F.col("full"), F.lit(None)).otherwise(F.col("mean")).alias("mean"), F.round("lam", 9).alias("lam"))


def rates(size: Column, most: float) -> Column:
    """A document's rate, from the columns mean and lam of its source; a null mean says that the source is taken in full."""
    return F.when(F.col("mean").isNull(), F.lit(most)).otherwise(tilt(F.col("lam"), size / F.col("mean"), most))


def place(rate: Column, seed: int) -> Column:
    """Where a document stands in the order in which its source's documents get one more copy: in [-1, 1), 0 on average at the exact rate."""
    u = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return u - (rate - F.floor(rate))


def cutoffs(sizes: DataFrame, state: DataFrame, most: float = 2.0, seed: int = 1) -> DataFrame:
    """``state`` and, for each source, the place below which documents get one more copy, and documents ``moved`` over it.

    The place is a weighted quantile by three passes over histograms of BINS bins, each
    within the bin before: no source is ever sorted or gathered in one task. What is left
    to the target there is less than a bin of the last pass. Then MOVES times the one
    document whose copy, more or less, brings the source nearest to its target changes
    sides, if any brings it nearer.
    """
    rate = rates(F.col("size"), most)
    docs = sizes.withColumnsRenamed({"source": "_s"}).join(state, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    docs = docs.select("source", "size", F.floor(rate).alias("copies"), place(rate, seed).alias("at"))
    base = docs.groupBy(F.col("source").alias("_s")).agg(F.sum(F.col("size") * F.col("copies")).alias("taken"))
    near = state.join(base, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    near = stash(near.select(*state.columns, (F.col("target") - F.coalesce("taken", F.lit(0))).alias("need"), F.lit(-1.0).alias("from"), F.lit(2.0).alias("wide")), "mix-cut")
    for _ in range(3):
        open_docs = docs.filter((F.col("copies") < most) & (F.col("size") > 0)).withColumnsRenamed({"source": "_s"}).join(near.select("source", "from", "wide"), F.col("source").eqNullSafe(F.col("_s")))
        open_docs = open_docs.withColumn("bin", F.floor((F.col("at") - F.col("from")) / F.col("wide") * BINS)).filter(f"bin >= 0 AND bin < {BINS}")
        bins = open_docs.groupBy("_s", "bin").agg(F.sum("size").alias("mass"))
        total = Window.partitionBy("_s").orderBy("bin")
        bins = bins.withColumn("upto", F.sum("mass").over(total))
        joined = near.select("source", "need").join(bins, F.col("source").eqNullSafe(F.col("_s")))
        crossing = joined.filter("upto > need").groupBy("_s").agg(F.min(F.struct("bin", (F.col("upto") - F.col("mass")).alias("below"))).alias("c"))
        new = near.join(crossing, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
        # no bin crosses: all of the interval's documents are taken, and the cut stays at its end
        new = new.select(
            *state.columns,
            F.when(F.col("c").isNull(), F.col("need")).otherwise(F.col("need") - F.col("c.below")).alias("need"),
            F.when(F.col("c").isNull(), F.col("from") + F.col("wide")).otherwise(F.col("from") + F.col("wide") * F.col("c.bin") / BINS).alias("from"),
            F.when(F.col("c").isNull(), F.lit(1e-300)).otherwise(F.col("wide") / BINS).alias("wide"),
            F.coalesce("c.bin", F.lit(-1)).alias("bin"),
        )
        old, near = near, stash(new.drop("bin"), "mix-cut")
        delete(old)
    near = stash(near.select(*state.columns, F.col("from").alias("cut"), "need", F.array().cast(MOVED).alias("moved")), "mix-cuts")
    for _ in range(MOVES):
        rows = docs.filter((F.col("copies") < most) & (F.col("size") > 0)).withColumnsRenamed({"source": "_s"}).join(near.select("source", "cut", "need", "moved"), F.col("source").eqNullSafe(F.col("_s")))
        change = F.when(chosen(F.col("at"), F.col("size")), -F.col("size")).otherwise(F.col("size"))
        best = rows.select("_s", change.alias("change"), "need", "at", "size").groupBy("_s").agg(F.min(F.struct(F.abs(F.col("need") - F.col("change")).alias("off"), "at", "size", "change")).alias("b"))
        new = near.join(best, F.col("source").eqNullSafe(F.col("_s")), "left")
        better = F.coalesce(F.col("b.off") < F.abs("need"), F.lit(False))
        one = F.array(F.struct(F.col("b.at").alias("at"), F.col("b.size").alias("size")))
        moved = F.when(better, F.array_union(F.array_except("moved", one), F.array_except(one, "moved"))).otherwise(F.col("moved"))
        old, near = near, stash(new.select(*state.columns, "cut", F.when(better, F.col("need") - F.col("b.change")).otherwise(F.col("need")).alias("need"), moved.alias("moved")), "mix-cuts")
        delete(old)
    return near.drop("need")


def chosen(at: Column, size: Column) -> Column:
    """Whether a document gets one more copy: it stands before its source's cut, or has been moved over it."""
    before, moved = at < F.col("cut"), F.array_contains("moved", F.struct(at.alias("at"), size.alias("size")))
    return before != moved


def copies(size: Column, most: float, seed: int) -> Column:
    """Copies of a document of a source with cutoffs()'s columns."""
    rate = rates(size, most)
    base = F.floor(rate)
    return (base + ((base < most) & chosen(place(rate, seed), size)).cast("long")).cast("long")


def _solve(sizes: DataFrame, most: float, seed: int, share: float) -> DataFrame:
    histogram = stash(sizes.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-sizes")
    goals = targets(histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), share=share, most=float(most))
    return cutoffs(sizes, balance(histogram, stash(goals, "mix-goals"), float(most)), float(most), seed)


def plan(docs: DataFrame, share: float = 1.5, most: int = 2, seed: int = 1) -> DataFrame:
    """What the mix takes of each row of ``docs(doc_id, text, source)``: doc_id, size, source_size, target, taken, copies, rate.

    ``size`` is the number of words (null or empty text: 0), ``copies`` from 0 to
    ``most``, ``taken`` copies times size. Rates come from balance(), copies from a cut
    in a random order fixed by ``seed`` and doc_id. Rows that repeat a doc_id get the
    same copies; a null doc_id is hashed as any value, a null source is a source of its
    own; an empty table gives no rows. Other columns are ignored.
    """
    sizes = stash(docs.select("doc_id", F.col("source").cast("string").alias("source"), n_words(F.col("text").cast("string")).alias("size")), "mix-docs")
    state = _solve(sizes, most, seed, share)
    joined = sizes.withColumnsRenamed({"source": "_s"}).join(state, F.col("source").eqNullSafe(F.col("_s")))
    out = joined.select("doc_id", "size", "source_size", "target", copies(F.col("size"), float(most), seed).alias("copies"), rates(F.col("size"), float(most)).alias("rate"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", "rate")


def mix(docs: DataFrame, share: float = 1.5, most: int = 2, seed: int = 1) -> DataFrame:
    """The rows of ``docs`` as often as plan() takes them, with their columns."""
    columns = docs.columns
    slim = docs.select(F.struct(*columns).alias("_row"), "doc_id", F.col("source").cast("string").alias("_s"), n_words(F.col("text").cast("string")).alias("size"))
    sizes = stash(slim.select("doc_id", F.col("_s").alias("source"), "size"), "mix-docs")
    state = _solve(sizes, most, seed, share)
    joined = slim.join(state, F.col("source").eqNullSafe(F.col("_s")))
    taken = joined.withColumn("_n", copies(F.col("size"), float(most), seed)).filter("_n > 0")
    return taken.select("_row", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int")))).select(*[F.col("_row")[c].alias(c) for c in columns])
