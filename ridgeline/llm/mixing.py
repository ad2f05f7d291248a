"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Every source sends its documents in a shuffled order (a hash of the id), again and again up
to ``most`` times.  A sent copy finishes at the virtual time ``words sent so far by the
source / the source's target``; all copies are put in the order of these times, and the mix
takes them until the total budget (all words of the table) is spent.  At virtual time 1 each
source has sent its target.

Running sums never run over a whole source or table in one task: rows are dealt into ranges
of the order, the (few) range totals are summed in order, and rows only within a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows per range that a running sum runs over, about.
RANGE_ROWS = 4_096


def word_count(text: Column) -> Column:
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """Per source: ``source, _rank, source_size, target``; ``sizes`` has ``source`` and ``size``.

    Sources in code-point order, null last, weigh ``weights`` in turn.  Targets share the sum
    of all sizes by weight and stop at ``most`` times the source's size.  A source is at its
    stop exactly if, with the sources ordered by stop over weight, its stop is no more than
    its share of what the earlier ones leave.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    alphabetical = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(alphabetical)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("_rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    stops = (by_source.withColumn("_rank", rank).withColumn("_w", weight)
             .withColumn("_stop", F.col("source_size") * F.lit(most)))
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("_stop") / F.col("_w"), "_rank")
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    left = (stops
            .withColumn("_left", F.sum("source_size").over(everything) - F.coalesce(F.sum("_stop").over(earlier), F.lit(0)))
            .withColumn("_left_w", F.sum("_w").over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
            .withColumn("_stopped", F.col("_stop") * F.col("_left_w") <= F.col("_left") * F.col("_w")))
    rate = (F.sum("source_size").over(everything) - F.coalesce(F.sum(F.when(F.col("_stopped"), F.col("_stop"))).over(everything), F.lit(0))
            ) / F.sum(F.when(~F.col("_stopped"), F.col("_w"))).over(everything)
    target = F.when(F.col("_stopped"), F.col("_stop").cast("double")).otherwise(F.col("_w") * rate)
    return left.withColumn("target", target).select("source", "_rank", "source_size", "target")


def _before(totals: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Per range: the sum of ``value`` over the ranges before it (within ``keys``)."""
    window = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*keys, order, F.coalesce(F.sum(value).over(window), F.lit(0)).alias("_before"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = 0,
                range_rows: int = RANGE_ROWS) -> DataFrame:
    """``doc_id, size, source, source_size, target, taken`` of every row of ``docs``.

    ``taken`` counts the words of all copies of the row that the mix takes: 0 to ``most``
    times its size.  The mix never exceeds the words of the table.  Null text and text
    without words have size 0 and are taken with 0 words; a null source is a source, a null
    ``doc_id`` is an id; repeated rows are rows of their own; an empty table gives no rows;
    other columns are not read.  The order depends on ids and ``seed`` alone, so reruns agree.
    """
    sized = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), word_count(F.col("text")).alias("size"))
    ranges = max(1, -(-docs.count() // range_rows))
    sources = source_targets(sized, weights, most)
    shuffled = (sized.withColumn("_key", F.xxhash64(F.lit(seed), "doc_id"))
                .withColumn("_range", F.pmod(F.shiftrightunsigned("_key", 33), F.lit(ranges)).cast("int"))
                .join(sources.withColumnRenamed("source", "_of"), F.col("source").eqNullSafe(F.col("_of")))
                .select("doc_id", "source", "size", "_key", "_range", "_rank", "source_size", "target"))
    totals = shuffled.groupBy("_rank", "_range").agg(F.sum("size").alias("_sum"))
    in_range = Window.partitionBy("_rank", "_range").orderBy("_key", "doc_id", "size")
    sent = (shuffled.withColumn("_row", F.row_number().over(in_range))
            .withColumn("_sent", F.sum("size").over(in_range.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .join(_before(totals, ["_rank"], "_range", "_sum"), ["_rank", "_range"])
            .withColumn("_sent", F.col("_sent") + F.col("_before")).drop("_before"))
    # a copy that starts after virtual time 1 can not be reached before the budget is spent
    rounds = F.floor(F.try_divide(F.col("target") - (F.col("_sent") - F.col("size")), F.col("source_size"))).cast("int") + 1
    rounds = F.least(F.lit(most), F.greatest(F.lit(1), F.coalesce(rounds, F.lit(1))))
    copies = (sent.withColumn("_round", F.explode(F.sequence(F.lit(0), rounds - 1)))
              .withColumn("_finish", F.coalesce(F.try_divide(F.col("_round") * F.col("source_size") + F.col("_sent"), F.col("target")), F.lit(0.0)))
              .withColumn("_slot", F.floor(F.col("_finish") * ranges).cast("long")))
    slots = copies.groupBy("_slot").agg(F.sum("size").alias("_sum"))
    in_slot = (Window.partitionBy("_slot").orderBy("_finish", "_rank", "_key", "doc_id", "size", "_range", "_row")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    all_words = sources.groupBy().agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("_all")).scalar()
    queued = (copies.withColumn("_spent", F.sum("size").over(in_slot))
              .join(_before(slots, [], "_slot", "_sum"), "_slot")
              .withColumn("_spent", F.col("_spent") + F.col("_before")))
    return (queued.groupBy("_rank", "_range", "_row", "doc_id", "size", "source", "source_size", "target")
            .agg(F.sum(F.when(F.col("_spent") <= all_words, F.col("size")).otherwise(0)).alias("taken"))
            .select("doc_id", "size", "source", "source_size", "target", "taken"))


def take_copies(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as many times as it takes it.

    ``mixed`` is :func:`mix_sources` of ``docs``.  Rows without words are not taken.  Rows that
    repeat an id and a size all follow the one of them that is taken most often.
    """
    copies = (mixed.where("taken > 0").groupBy("doc_id", "size")
              .agg(F.max(F.try_divide("taken", "size").cast("int")).alias("_copies"))
              .select(F.col("doc_id").alias("_id"), F.col("size").alias("_size"), "_copies"))
    sized = docs.withColumn("_words", word_count(F.col("text")))
    joined = sized.join(copies, sized["doc_id"].eqNullSafe(copies["_id"]) & (sized["_words"] == copies["_size"]))
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*[docs[c] for c in docs.columns])
