"""Problem 9: one mix in which each source holds its target share of the tokens.

Weighted fair queueing: every document of a source, in a shuffled order, finishes at the virtual
time at which the source has sent it, that is its cumulative tokens divided by the source's weight.
Sorted by that time, any prefix of the mix holds the target shares. The cumulative sum of a source
that holds a third of all rows isn't made in one task: hashes spread each source over buckets, the
buckets' sums are added up first, and each bucket then continues from its offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirelake.session import stage

#: Rows of a bucket, about: the part of a source's shuffled order that one task sums.
BUCKET_ROWS = 50_000
#: Target rows up to which they are sent to all tasks; more are joined as any table.
SENT_ROWS = 10_000


def mix_sources(sizes: DataFrame, targets: DataFrame, seed: int = 1, buckets: int | None = None, budget: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The mix and its report.

    ``sizes`` has ``doc_id``, ``source`` and ``n_tokens``; ``targets`` has ``source``,
    ``target_share`` and ``max_repeats``. ``buckets`` of each source follow from the number of rows.
    Documents of other sources and of no tokens take no part. A source without tokens can hold no
    share; the others' shares are then scaled up to a sum of 1. The budget is the largest for which no
    source runs out of its repeats, or ``budget`` if that is smaller. A source's first pass holds
    each document once, every further pass once more, newly shuffled.

    The mix has ``doc_id``, ``copy`` (from 1), ``source``, ``n_tokens`` and ``finish_at``, the
    virtual time in tokens of the mix; it is range-sorted by that. The report has a row for each
    target: ``source``, ``target_share``, ``weight`` (the scaled share), ``available``, ``repeats``
    (the most of any document), ``n_rows``, ``n_tokens`` and ``actual_share``.
    """
    wanted = targets.where("target_share > 0 AND max_repeats > 0").select("source", F.col("target_share").cast("double").alias("target_share"), F.col("max_repeats").cast("int").alias("max_repeats"))
    sent = F.broadcast if wanted.count() <= SENT_ROWS else lambda df: df
    docs = sizes.where("n_tokens > 0").select("doc_id", "source", F.col("n_tokens").cast("bigint").alias("n_tokens")).join(sent(wanted), "source", "left_semi")
    docs = stage(docs)
    buckets = buckets or max(64, -(-docs.count() // BUCKET_ROWS))
    have = docs.groupBy("source").agg(F.sum("n_tokens").alias("available"))
    everything = Window.partitionBy(F.lit(0))
    plan = stage(
        wanted.join(have, "source")
        .withColumn("weight", F.col("target_share") / F.sum("target_share").over(everything))
        .withColumn("budget", F.floor(F.min(F.col("available") * F.col("max_repeats") / F.col("weight")).over(everything)))
        .withColumn("budget", F.least("budget", F.lit(budget)) if budget is not None else F.col("budget"))
        .withColumn("passes", F.least(F.col("max_repeats"), F.ceil(F.col("weight") * F.col("budget") / F.col("available")).cast("int")))
        .coalesce(1)
    )
    rows = (
        docs.join(sent(plan.select("source", "available", "weight", "budget", "passes")), "source")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.greatest("passes", F.lit(1)))))
        .withColumn("place", F.xxhash64(F.lit(seed), "copy", "doc_id"))
        .withColumn("bucket", F.pmod(F.shiftrightunsigned("place", 40), F.lit(buckets)).cast("int"))
    )
    ahead = Window.partitionBy("source", "copy").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("source", "copy", "bucket").agg(F.sum("n_tokens").alias("s"))
    offsets = sums.select("source", "copy", "bucket", F.coalesce(F.sum("s").over(ahead), F.lit(0)).alias("before"))
    within = Window.partitionBy("source", "copy", "bucket").orderBy("place", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    timed = (
        rows.withColumn("so_far", F.sum("n_tokens").over(within))
        .join(offsets, ["source", "copy", "bucket"])
        .withColumn("finish_at", ((F.col("copy") - 1) * F.col("available") + F.col("before") + F.col("so_far")) / F.col("weight"))
        .where("finish_at <= budget")
    )
    mix = stage(timed.select("doc_id", F.col("copy").cast("int").alias("copy"), "source", "n_tokens", "finish_at"))
    got = mix.groupBy("source").agg(F.count("*").alias("n_rows"), F.sum("n_tokens").alias("n_tokens"), F.max("copy").alias("repeats"))
    report = (
        targets.select("source", F.col("target_share").cast("double").alias("target_share"))
        .join(plan.select("source", "weight", "available"), "source", "left")
        .join(got, "source", "left")
        .na.fill(0, ["weight", "available", "n_rows", "n_tokens", "repeats"])
        .withColumn("actual_share", F.coalesce(F.col("n_tokens") / F.nullif(F.sum("n_tokens").over(everything), F.lit(0)), F.lit(0.0)))
    )
    return mix.orderBy("finish_at", "source", "doc_id", "copy"), report.select("source", "target_share", "weight", "available", "repeats", "n_rows", "n_tokens", "actual_share")
