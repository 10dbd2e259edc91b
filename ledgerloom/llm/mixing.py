"""Mixing sources to target weights by entropy balancing, in DataFrame functions only.

A document may be taken 0, 1 or 2 times. Among all rates that give every
source its target of words, the ones of greatest entropy relative to two fair
coins per document are ``2 / (1 + exp(-lambda * size / scale))`` with one
multiplier per source. The multipliers are the optimum of the convex dual
``sum 2 log(1 + exp(lambda * size / scale)) - lambda * target / scale``, found
by Newton steps whose gradient and curvature are distributed sums. The sums
run over (source, size) counts, so an iteration does not read the documents.

Rates become copies by systematic selection along growing size: within a
source the running sum of fractional rates, shifted by an offset, takes one
more copy at each whole number it passes. A neighbour in this order has nearly
the same size, so the words taken differ from the target by less than the
largest document; of ``OFFSETS`` offsets the closest is kept. Equal sizes of a
source are told apart by a numbering of ids, in buckets.

Targets: sources in code point order (null last) weigh 3, 1, 2 and so on;
together they share 150 % of all words; a target stops at twice its source,
and the excess goes to the others by weight. The sources with the smallest
ratio of twice their words to their weight are the ones that stop.

Inputs: null and empty texts have size 0 and are taken with 0 words; a null
source is a source; repeated rows are documents of their own; other columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import materialize, query, ranked_in_buckets, same_keys, table

WORD = r"[^\x20\x09-\x0D]+"
OFFSETS = 32


def source_targets(sources: DataFrame, share: float, weights: tuple[float, ...], cap: float) -> DataFrame:
    """Add ``target`` to one row per source (source, source_size). The windows see one row per source."""
    listed = F.array(*[F.lit(float(w)) for w in weights])
    named = Window.orderBy(F.col("source").asc_nulls_last())
    rows = sources.withColumn("weight", F.element_at(listed, ((F.row_number().over(named) - 1) % len(weights) + 1).cast("int")))
    rows = rows.withColumn("most", F.col("source_size") * F.lit(cap)).withColumn("ratio", F.col("most") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything) * F.lit(share)
    stopped = F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    weight_left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("level", (total - stopped) / weight_left)
    rows = rows.withColumn("level", F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "level"))).over(everything)["level"])
    target = F.when(F.col("level").isNull(), F.col("most")).otherwise(F.least("most", F.col("level") * F.col("weight")))
    return rows.select("source", "source_size", target.alias("target"))


def rate(dual, size, scale):
    """Expected copies of a document under a multiplier."""
    return F.lit(2.0) / (F.lit(1.0) + F.exp(-dual * size / scale))


def balance(counts: DataFrame, targets: DataFrame, tolerance: float = 1e-6, steps: int = 40) -> DataFrame:
    """Multipliers per source by Newton steps on the dual: source, source_size, target, scale, dual.

    A step is held within brackets that close in on the root, so it cannot
    run away. ``dual`` is null where the target is the whole of twice a source.
    """
    p = F.col("target") / (2 * F.col("source_size"))
    start = F.when((F.col("source_size") > 0) & (p < 1 - 1e-9) & (p > 0), F.log(p / (1 - p)))
    scales = counts.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("scale"))
    state = same_keys(targets, scales, ["source"]).withColumn("dual", start)
    state = materialize(state.withColumn("lo", F.lit(-1e9)).withColumn("hi", F.lit(1e9)).withColumn("missed", F.lit(1.0)), "duals")
    for _ in range(steps):
        if not state.filter(F.col("dual").isNotNull() & (F.abs("missed") > tolerance)).limit(1).count():
            break
        each = same_keys(counts, state.select("source", "dual", "scale"), ["source"]).filter("dual IS NOT NULL")
        r = rate(F.col("dual"), F.col("size"), F.col("scale"))
        words = F.col("n") * F.col("size")
        sums = each.groupBy("source").agg(
            F.sum(words * r).alias("words"), F.sum(words * r * (1 - r / 2) * F.col("size") / F.col("scale")).alias("slope")
        )
        s = same_keys(state.drop("missed"), sums, ["source"], "left")
        off = F.col("words") - F.col("target")
        s = s.withColumn("lo", F.when(off < 0, F.col("dual")).otherwise(F.col("lo"))).withColumn("hi", F.when(off > 0, F.col("dual")).otherwise(F.col("hi")))
        s = s.withColumn("missed", F.when(F.col("dual").isNull(), 0.0).otherwise(off / F.col("target")))
        reach = 2 * F.greatest(F.lit(1.0), F.abs("dual"))
        newton = F.col("dual") - F.greatest(-reach, F.least(reach, off / F.col("slope")))
        newton = F.when(F.col("slope") > 0, newton).otherwise(F.col("dual") - F.signum(off) * reach)
        inside = F.when((newton > F.col("lo")) & (newton < F.col("hi")), newton).otherwise((F.col("lo") + F.col("hi")) / 2)
        s = s.withColumn("dual", F.when(F.abs("missed") > tolerance, inside).otherwise(F.col("dual")))
        state = materialize(s.drop("words", "slope"), "duals")
    return state.select("source", "source_size", "target", "scale", "dual")


def mix_documents(docs: DataFrame, share: float = 1.5, weights: tuple[float, ...] = (3, 1, 2), cap: float = 2.0) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, rate, copies, taken."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = materialize(docs.select("doc_id", "source", size.alias("size")), "mix-rows")
    counts = materialize(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-counts")
    sources = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    duals = balance(counts, materialize(source_targets(sources, share, weights, cap), "mix-targets"))

    rates = same_keys(counts, duals, ["source"])
    rates = rates.withColumn("rate", F.when(F.col("dual").isNull(), F.lit(2.0)).otherwise(rate(F.col("dual"), F.col("size"), F.col("scale"))))
    rates = rates.withColumn("base", F.floor("rate")).withColumn("part", F.col("rate") - F.col("base"))
    grown = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    share_of = F.when(F.col("size") > 0, F.col("n") * F.col("part")).otherwise(0.0)
    rates = rates.withColumn("from", F.coalesce(F.sum(share_of).over(grown), F.lit(0.0))).withColumn("to", F.col("from") + share_of)
    rates = materialize(rates, "mix-rates")

    def more(offset):
        return F.floor(F.col("to") + offset) - F.floor(F.col("from") + offset)

    offset = (F.col("k") + F.lit(0.5)) / OFFSETS
    tried = rates.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(OFFSETS - 1))))
    tried = tried.groupBy("source", "k").agg(F.abs(F.sum(F.col("size") * (F.col("n") * F.col("base") + more(offset))) - F.first("target")).alias("missed"))
    chosen = tried.groupBy("source").agg(F.min(F.struct("missed", "k"))["k"].alias("k"))
    extra = same_keys(rates, chosen, ["source"]).select("source", "size", "source_size", "target", "rate", "base", more(offset).alias("more"))

    ranked = ranked_in_buckets(rows, ["source", "size"], ["doc_id"], rows.count(), "rank")
    taken = same_keys(ranked, extra, ["source", "size"])
    copies = (F.col("base") + F.when(F.col("rank") < F.col("more"), 1).otherwise(0)).cast("long")
    taken = taken.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))
    return taken.select("doc_id", "source", "size", "source_size", "target", "rate", "copies", "taken")


def mixed_copies(docs: DataFrame, share: float = 1.5, weights: tuple[float, ...] = (3, 1, 2), cap: float = 2.0) -> DataFrame:
    """The documents as the mix takes them: a row for each copy, with the columns of ``docs``.

    Rows alike in id, source and size are taken alike: the mean of their copies, rounded up.
    """
    keys = ["doc_id", "source", "_size"]
    taken = mix_documents(docs, share, weights, cap).withColumnRenamed("size", "_size")
    taken = taken.groupBy(*keys).agg(F.ceil(F.avg("copies")).cast("int").alias("_copies")).filter("_copies > 0")
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("_size")
    sized = docs.select("doc_id", "source", size, F.struct(*docs.columns).alias("_row"))  # no name clashes
    again = F.explode(F.sequence(F.lit(1), F.col("_copies")))
    return same_keys(sized, taken, keys).select("_row", again.alias("_copy")).select("_row.*")


@query("op6_mixing")
def op6_mixing(spark, folder: str) -> DataFrame:
    return mix_documents(table(spark, folder, "documents", "doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", "taken")
