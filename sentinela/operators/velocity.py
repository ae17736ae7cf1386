"""Trailing time-window event count per key (W1, the velocity rule's input).

For every event at time ``t`` the count covers events of the same key in
``(t - W, t]``, the event itself included; events with the same timestamp
are counted one by one in ``order_col`` order, as if they had arrived in that
order. An event without a time lies in no window but its own: its count is 1.
Events without a key form one key.

A plain ``Window.partitionBy(key)`` would put every event of a key into one
task, and one key may hold a third of all rows. Instead time is cut into
sub-buckets of width ``B = W / k``. For an event in sub-bucket ``b`` the
window spans:

* the tail of sub-bucket ``b - k`` (events after ``t - W``),
* the whole sub-buckets ``b - k + 1 .. b - 1``,
* the head of sub-bucket ``b`` (events up to ``t``).

Each event is entered twice into the one shuffle: whole under its own
sub-bucket, and as a bare time under sub-bucket ``b + k``, whose window reaches
back to it. The first and last parts are then a range window partitioned by
``(key, b)``. The middle part comes from a pre-aggregated ``(key, sub-bucket)
-> count`` table, summed over the ``k - 1`` preceding sub-buckets and entered
as one more row per partition, so nothing is joined back. A hot key is spread
over its sub-buckets, and the count is exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentinela.functions.timefn import epoch_micros
from sentinela.session import shared_root

US_PER_SECOND = 1_000_000
TARGET_SUB_BUCKET_SECONDS = 60


def default_pieces(window_seconds: int) -> int:
    """Sub-buckets per window: about one per minute, dividing the window exactly."""
    k = max(1, int(window_seconds) // TARGET_SUB_BUCKET_SECONDS)
    while (int(window_seconds) * US_PER_SECOND) % k:
        k -= 1
    return k


def trailing_count(df: DataFrame, key: str, ts_col: str, order_col: str, window_seconds: int,
                   out_col: str = "janela_n", pieces: int | None = None) -> DataFrame:
    """Trailing count per event; see the module notes."""
    w_us = int(window_seconds) * US_PER_SECOND
    k = pieces or default_pieces(window_seconds)
    if w_us % k:
        raise ValueError("pieces must divide the window in whole microseconds")
    b_us = w_us // k
    us = epoch_micros(ts_col)
    narrow = df.select(F.col(key).alias("_k"), us.alias("_us"), F.col(order_col).alias("_o"),
                       F.struct(*df.columns).alias("_row"))
    # Rows without a time are spread by their order value; their partition plays no part.
    bucket = F.coalesce(F.floor(F.col("_us") / F.lit(b_us)), F.xxhash64("_o"))
    own = F.struct(bucket.alias("_b"), F.lit(True).alias("_own"))
    later = F.struct((bucket + k).alias("_b"), F.lit(False).alias("_own"))
    entered = (narrow.select("*", F.explode(F.when(F.col("_us").isNull(), F.array(own))
                                            .otherwise(F.array(own, later))).alias("_e"))
               .select("_k", "_us", "_o", F.col("_e._b").alias("_b"),
                       F.when(F.col("_e._own"), F.col("_row")).alias("_row")))
    if k > 1:
        # Whole sub-buckets strictly inside the window, from per-(key, sub-bucket) counts.
        per_bucket = (df.select(F.col(key).alias("_k"), us.alias("_us")).filter("_us is not null")
                      .groupBy("_k", F.floor(F.col("_us") / F.lit(b_us)).alias("_b")).agg(F.count("*").alias("_n")))
        middle = per_bucket.select("_k", "_b", F.sum("_n").over(
            Window.partitionBy("_k").orderBy("_b").rangeBetween(-(k - 1), -1)).alias("_mid"))
        entered = entered.unionByName(middle, allowMissingColumns=True)
    else:
        entered = entered.withColumn("_mid", F.lit(None).cast("long"))
    part = Window.partitionBy("_k", "_b")
    peers = Window.partitionBy("_k", "_b", "_us")
    n = (F.count("_us").over(part.orderBy("_us").rangeBetween(-(w_us - 1), 0)) - F.count("_us").over(peers)
         + F.row_number().over(peers.orderBy("_o")) + F.coalesce(F.max("_mid").over(part), F.lit(0)))
    counted = entered.withColumn("_n", n).filter(F.col("_row").isNotNull())
    return counted.select("_row.*", F.when(F.col("_us").isNull(), F.lit(1).cast("long"))
                          .otherwise(F.col("_n")).alias(out_col))


def ranked_trailing_count(df: DataFrame, key: str, ts_col: str, order_col: str, window_seconds: int,
                          out_col: str = "janela_n", partitions: int | None = None) -> DataFrame:
    """Exact trailing count from distributed ranks; no group is ever held by one task.

    ``count(t) = R(t) - L(t)`` where ``R(t)`` is the event's rank within its
    key in ``(time, order_col)`` order and ``L(t)`` the number of the key's
    events at or before ``t - W``. The events themselves and one probe per
    event (at ``t - W``, sorting after events of equal time) are
    range-partitioned on ``(key, time, kind, order_col)``: range bounds are
    sampled, so even a single key in a single instant is cut into many
    partitions. Within a partition a running count gives local ranks; the
    offset of each ``(partition, key)`` is the number of the key's events in
    earlier partitions, from a table with one row per ``(partition, key)``.
    Event rows travel through the sort whole, so repeated ``order_col``
    values each keep their own row; probes are deduplicated before they are
    joined back (equal probes see the same ``L``).
    """
    w_us = int(window_seconds) * US_PER_SECOND
    n_parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    timeless = df.filter(epoch_micros(ts_col).isNull()).withColumn(out_col, F.lit(1).cast("long"))
    ev = df.withColumn("_us", epoch_micros(ts_col)).filter("_us is not null").withColumn("_kind", F.lit(0))
    probes = ev.select(key, order_col, (F.col("_us") - F.lit(w_us)).alias("_us"), F.lit(1).alias("_kind"),
                       F.col("_us").alias("_te"))
    points = ev.unionByName(probes, allowMissingColumns=True)
    # Range bounds are sampled; checkpointing (reliable, in the shared checkpoint folder)
    # freezes the partition ids so both uses below, and any recomputation, agree.
    shared_root(df.sparkSession)
    ranged = (points.repartitionByRange(n_parts, key, "_us", "_kind", order_col)
              .withColumn("_pid", F.spark_partition_id())).checkpoint(eager=True)
    is_event = (F.col("_kind") == 0).cast("long")
    local = ranged.withColumn("_local", F.sum(is_event).over(
        Window.partitionBy("_pid", key).orderBy("_us", "_kind", order_col)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    offsets = ranged.groupBy("_pid", key).agg(F.sum(is_event).alias("_n")).select(
        F.col("_pid").alias("_opid"), F.col(key).alias("_okey"),
        F.coalesce(F.sum("_n").over(Window.partitionBy(key).orderBy("_pid")
                                    .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    ranked = (local.join(offsets, (local["_pid"] == offsets["_opid"]) & local[key].eqNullSafe(offsets["_okey"]))
              .withColumn("_rank", F.col("_off") + F.col("_local")))
    events = ranked.filter("_kind = 0")
    lvals = (ranked.filter("_kind = 1")
             .select(F.col(key).alias("_lkey"), F.col(order_col).alias("_lord"), F.col("_te").alias("_lte"),
                     F.col("_rank").alias("_l"))
             .dropDuplicates(["_lkey", "_lord", "_lte"]))
    joined = events.join(lvals, events[key].eqNullSafe(lvals["_lkey"])
                         & events[order_col].eqNullSafe(lvals["_lord"])
                         & (events["_us"] == lvals["_lte"]))
    return (joined.withColumn(out_col, F.col("_rank") - F.col("_l"))
            .drop("_us", "_kind", "_te", "_pid", "_local", "_opid", "_okey", "_off", "_rank",
                  "_lkey", "_lord", "_lte", "_l")
            .unionByName(timeless))
