"""A ledger of late rows: for every window, rows that came, were counted, were late.

A windowed aggregate drops rows that come after the watermark passed their
window, and says nothing about which. Here the same stream also flows past the
aggregate, as one count per batch and window of what came in. Both parts share
a query, so one checkpoint and the same batches: what came in less what was
counted is what came too late, window by window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricegrid.operators.rules import applicable
from pricegrid.streaming.quality import quality_counters

COUNTED, CAME = "counted", "came"


def ledger_rows(stream: DataFrame, rules, width="1 day", delay="1 hour", time="ts") -> DataFrame:
    """Counters of the windows a batch changed (`counted`), and a row (`came`) per record.

    Records without a time belong to no window; they come with a null window.
    Only the counters have state. The records are summed in write_ledger.
    """
    counted = quality_counters(stream, rules, width, delay, time).withColumn("kind", F.lit(COUNTED))
    at = F.col(time).cast("timestamp")
    timed = stream.select(at.alias("last_event")).where("last_event is not null")
    timed = timed.select(F.window("last_event", width).alias("w"), "last_event")
    timed = timed.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "last_event")
    untimed = stream.where(at.isNull()).select(
        *[F.lit(None).cast("timestamp").alias(c) for c in ("window_start", "window_end", "last_event")]
    )
    came = timed.unionByName(untimed).select("*", F.lit(1).cast("long").alias("rows"), F.lit(CAME).alias("kind"))
    for rule in applicable(stream, rules):
        came = came.withColumn(rule.name, F.lit(0).cast("long"))
    return counted.unionByName(came)


def write_ledger(rows: DataFrame, out, checkpoint, trigger=None):
    """Write each batch's sums into a folder of its own, which a replay overwrites."""
    sums = [c for c in rows.columns if c not in ("window_start", "window_end", "last_event", "kind")]

    def write(batch, number):
        # A window is one row of counters in a batch, so its sum is that row.
        summed = batch.groupBy("window_start", "window_end", "kind").agg(
            F.max("last_event").alias("last_event"), *[F.sum(c).alias(c) for c in sums]
        )
        summed.write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = rows.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def read_ledger(spark, out, schema) -> DataFrame:
    """window_start, window_end, rows_in, rows_counted, rows_late and the newest counters.

    rows_in = rows_counted + rows_late in every window. Records without a time
    are the row with a null window: they are in no window, so all are late.
    """
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(out)
    names = [c for c in schema.names if c not in ("window_start", "window_end", "last_event", "rows", "kind")]
    counted, came = F.col("kind") == COUNTED, F.col("kind") == CAME
    newest = F.max_by(F.struct("rows", *names), F.when(counted, F.col("batch")))
    windows = rows.groupBy("window_start", "window_end").agg(
        F.coalesce(F.sum(F.when(came, F.col("rows"))), F.lit(0)).alias("rows_in"), newest.alias("x")
    )
    n = F.coalesce("x.rows", F.lit(0))
    return windows.select(
        "window_start", "window_end", "rows_in", n.alias("rows_counted"), (F.col("rows_in") - n).alias("rows_late"),
        *[F.coalesce(f"x.{c}", F.lit(0)).alias(c) for c in names],
    )
