"""Streaming data-quality counters per tumbling window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricegrid.operators.rules import Rule, applicable

EVENT_TYPES = ("view", "click", "purchase", "signup")


def event_rules(types=EVENT_TYPES, high=200.0):
    """Rules for event records: known type, value in range, readable properties."""
    listed = ", ".join(f"'{t}'" for t in types)
    return [
        Rule("unknown_type", f"event_type not in ({listed})", ("event_type",)),
        Rule("negative_value", "value < 0", ("value",)),
        Rule("high_value", f"value > {high!r}e0", ("value",)),
        Rule("bad_props", "get_json_object(props, '$.k') is null", ("props",)),
    ]


def quality_counters(stream: DataFrame, rules, width="1 day", delay="1 hour", time="ts") -> DataFrame:
    """Rows and violations per rule and window; rows later than the delay are dropped.

    The state is one row of counters per open window, whatever the input rate.
    window_end and last_event tell which windows are closed (see read_counters).
    """
    rules = applicable(stream, rules)
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    counted = timed.groupBy(F.window(time, width)).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(r.mask()).alias(r.name) for r in rules],
        F.max(time).alias("last_event"),
    )
    return counted.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "last_event",
        "rows", *[F.col(r.name) for r in rules],
    )


def write_counters(counters: DataFrame, out, checkpoint, trigger=None):
    """Write the windows that each batch changed; returns the streaming query.

    A batch has a folder of its own, which a replay overwrites. The windows
    still open when a bounded run ends are there with what they hold so far.
    """

    def write(batch, number):
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = counters.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def read_counters(spark, out, schema, delay="1 hour") -> DataFrame:
    """The newest counters of every window, with `closed` once no row can join it any more."""
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(out)
    held = [c for c in schema.names if c != "window_start"]
    newest = rows.groupBy("window_start").agg(F.max_by(F.struct(*held), "batch").alias("x")).select("window_start", "x.*")
    last = rows.agg(F.max("last_event").alias("_last"))  # one row
    closed = F.col("window_end") <= F.col("_last") - F.expr(f"interval {delay}")
    return newest.crossJoin(last).withColumn("closed", closed).drop("_last")
