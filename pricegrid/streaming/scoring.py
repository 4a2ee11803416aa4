"""Streaming scoring: request records in, scored and rejected tables out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricegrid.functions.predicates import nan_to_null
from pricegrid.operators.scoring import checked_requests, score, with_defaults
from pricegrid.schema import CANONICAL


def request_stream(spark: SparkSession, path, schema, fmt="json", files_per_batch=None) -> DataFrame:
    """Requests from files as they arrive; the schema is declared, never inferred."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return nan_to_null(reader.load(path))


def score_stream(
    requests: DataFrame, model, name, version, out, checkpoint, config=CANONICAL, ranges=None,
    trigger=None,
):
    """Start scoring; returns the streaming query.

    Each micro-batch overwrites its own folder below out/scored and
    out/rejected, so a batch that is replayed after a failure replaces its
    earlier output instead of adding to it.
    """

    def write(batch: DataFrame, batch_id: int):
        checked = checked_requests(batch, config, ranges).persist()
        try:
            bad = F.size("reasons") > 0
            valid = with_defaults(checked.where(~bad).drop("reasons"))
            scored = score(valid, model, name, version)
            plain = [f.name for f in scored.schema if f.dataType.typeName() not in ("vector", "udt")]
            scored.select(*plain).write.mode("overwrite").parquet(f"{out}/scored/batch={batch_id}")
            checked.where(bad).write.mode("overwrite").parquet(f"{out}/rejected/batch={batch_id}")
        finally:
            checked.unpersist()

    writer = requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
