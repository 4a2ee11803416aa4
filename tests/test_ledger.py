"""Rows that came equal rows counted and rows late, window by window, over restarts."""

from pricegrid.session import shared_dir
from pricegrid.streaming import ledger, quality

SCHEMA = "ts timestamp, event_type string, value double, props string"


def test_late_rows_are_told(spark):
    base = shared_dir(spark, "ledger")
    batches = [
        ["2024-01-01 01:00:00", "2024-01-01 02:00:00", "2024-01-03 05:00:00"],
        # the first day is closed, the third is open, one row has no time
        ["2024-01-01 03:00:00", "2024-01-03 01:00:00", None, "2024-01-05 12:00:00"],
        # only late rows for the second day, which no counter ever saw
        ["2024-01-02 03:00:00", "2024-01-02 04:00:00", "2024-01-01 00:00:00"],
    ]
    for times in batches:
        rows = spark.createDataFrame([(t, "view", -1.0, '{"k": 1}') for t in times], "ts string, event_type string, value double, props string")
        rows.withColumn("ts", rows.ts.cast("timestamp")).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{base}/in")
        found = ledger.ledger_rows(stream, quality.event_rules())
        ledger.write_ledger(found, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    out = ledger.read_ledger(spark, f"{base}/out", found.schema).collect()
    days = {r.window_start and r.window_start.day: (r.rows_in, r.rows_counted, r.rows_late) for r in out}
    assert days == {1: (4, 2, 2), 2: (2, 0, 2), 3: (2, 2, 0), 5: (1, 1, 0), None: (1, 0, 1)}
    assert all(r.negative_value == r.rows_counted for r in out)
