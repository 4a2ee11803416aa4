"""Co-moments of many columns in one pass: sums and cross products of one vector.

Every task keeps four square matrices: rows where both columns are known, and the
sums, squares and products over them, so gaps are left out pair by pair. The
matrices of tasks add up; they are merged by groups of FAN until one is left, and
none is larger than the square of the columns. Values are taken relative to one
known value of their column, which keeps the differences of large sums exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrid.operators.features import quoted
from pricegrid.session import stage

FAN = 32
ROWS = 8192  # rows multiplied at a time
PARTS = ("n", "s", "q", "p", "odd")


class Moments:
    """n[a, b]: rows with both; s: sum of a; q: of its squares; p: of a times b; odd: rows with a number not finite."""

    def __init__(self, size):
        self.matrices = {name: np.zeros((size, size)) for name in PARTS}

    def add(self, x):
        """Rows x columns of numbers, NaN-marked gaps in a mask beside it."""
        values, known = x
        odd = known & ~np.isfinite(values)
        v = np.where(known & ~odd, values, 0.0)
        k = known.astype(float)
        m = self.matrices
        m["n"] += k.T @ k
        m["s"] += v.T @ k
        m["q"] += (v * v).T @ k
        m["p"] += v.T @ v
        if odd.any():
            m["odd"] += odd.T.astype(float) @ k
        return self

    def merge(self, data):
        stack = np.frombuffer(data).reshape(len(PARTS), *self.matrices["n"].shape)
        for name, matrix in zip(PARTS, stack):
            self.matrices[name] += matrix
        return self

    def bytes(self):
        return np.stack([self.matrices[name] for name in PARTS]).tobytes()

    def correlations(self):
        """Pearson r of every pair on its complete rows, NaN where it is not defined,
        and where there is none: fewer than two rows or a constant column."""
        m = self.matrices
        with np.errstate(all="ignore"):
            cross = m["p"] - m["s"] * m["s"].T / m["n"]
            spread = m["q"] - m["s"] ** 2 / m["n"]
            spread = np.where(spread <= 1e-13 * m["q"], 0.0, spread)
            r = cross / np.sqrt(spread * spread.T)
        odd = (m["odd"] + m["odd"].T) > 0
        none = ~odd & ((m["n"] < 2) | (spread * spread.T == 0))
        return np.where(odd, np.nan, r), none


def moments(df: DataFrame, columns) -> Moments:
    """The merged co-moments of all rows."""
    columns = list(columns)
    size = len(columns)
    slim = df.select(*[quoted(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    near = slim.limit(1000).agg(*[F.min(f"c{i}").alias(f"c{i}") for i in range(size)]).first()
    base = np.array([x if x is not None and np.isfinite(x) else 0.0 for x in near])

    def gather(batches):
        held = Moments(size)
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                some = batch.slice(a, ROWS)
                known = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in some.columns], axis=1)
                values = np.stack([c.to_numpy(zero_copy_only=False) for c in some.columns], axis=1)
                held.add((values - base, known))
        yield pa.RecordBatch.from_arrays([pa.array([held.bytes()], pa.binary())], names=["m"])

    def together(table):
        held = Moments(size)
        for data in table.column("m").to_pylist():
            held.merge(data)
        return pa.table({"m": pa.array([held.bytes()], pa.binary())})

    rows = stage(slim.mapInArrow(gather, "m binary").withColumn("k", F.spark_partition_id()), "moments")
    while True:
        tasks = rows.select(F.count_distinct("k"), F.count(F.lit(1)), F.max("k")).first()
        if tasks[1] <= FAN:
            break
        group = F.floor(F.col("k") / FAN).cast("int").alias("k")
        merged = rows.select("m", group).groupBy("k").applyInArrow(
            lambda key, table: together(table).append_column("k", pa.array([key[0].as_py()], pa.int32())), "m binary, k int"
        )
        rows = stage(merged, "moments")
    out = Moments(size)
    for row in rows.select("m").collect():  # at most FAN matrices
        out.merge(bytes(row.m))
    return out


def correlations(df: DataFrame, columns) -> dict:
    """{(a, b): r} of every pair a before b; r is None where there is none."""
    columns = list(columns)
    r, none = moments(df, columns).correlations()
    return {
        (columns[i], columns[j]): None if none[i, j] else float(r[i, j])
        for i in range(len(columns)) for j in range(i + 1, len(columns))
    }
