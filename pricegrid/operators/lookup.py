"""Left join to a lookup table with unique keys, safe for hot and missing keys.

The number of lookup rows is known when the table was fitted. A table of few
rows is measured, and broadcast if its bytes are bounded as well. Any other is
joined by shuffle, with the keys that hold a noticeable share of the rows taken
out first: there are at most 1/share of them, so they can be broadcast. Their
rows and those without a key match nothing in the shuffle and are spread over
all partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Lookup rows and bytes (texts and numbers) that may be broadcast.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 16 << 20
# A key with at least this share of all rows is hot: at most 10 000 such keys.
HOT_SHARE = 1e-4
SALTS = 512


def bytes_of(table: DataFrame) -> int:
    """Bytes of the values of a table, with eight for each number."""
    size = F.lit(0)
    for name, kind in table.dtypes:
        size = size + (F.coalesce(F.octet_length(name), F.lit(0)) if kind == "string" else F.lit(8))
    return table.agg(F.sum(size)).first()[0] or 0


def lookup(
    df: DataFrame,
    table: DataFrame,
    key: Column | str,
    values: dict,
    n_rows: int,
    hot: Column | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add columns from table, whose columns are "value" (the key), those named
    in values (table column -> new column). hot is a condition on table naming
    the keys with a share of at least HOT_SHARE. Keys without a match give null.
    """
    key = F.col(key) if isinstance(key, str) else key
    kept = table.select(
        F.col("value").alias("_key"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(values)]
    )
    names = {new: F.col(f"_{i}") for i, new in enumerate(values.values())}
    if n_rows <= broadcast_rows and bytes_of(kept) <= broadcast_bytes:
        joined = df.join(F.broadcast(kept), key == F.col("_key"), "left")
        return joined.withColumns(names).drop("_key", *[f"_{i}" for i in range(len(values))])

    hot = table.where(F.lit(False) if hot is None else hot).select(
        F.col("value").alias("_hot"), *[F.col(c).alias(f"_h{i}") for i, c in enumerate(values)]
    )
    hot = F.broadcast(hot) if bytes_of(hot) <= broadcast_bytes else hot
    own = df.columns
    df = df.join(hot, key == F.col("_hot"), "left")
    # Only rows with a key that is not yet resolved have salt 0, as all table rows do.
    open_ = F.col("_hot").isNull() & key.isNotNull()
    salt = F.when(open_, F.lit(0)).otherwise(F.pmod(F.xxhash64(*own), F.lit(SALTS)).cast("int") + 1)
    df = df.withColumn("_cold", F.when(open_, key)).withColumn("_salt", salt)
    kept = kept.withColumn("_zero", F.lit(0))
    joined = df.join(kept, (F.col("_cold") == F.col("_key")) & (F.col("_salt") == F.col("_zero")), "left")
    resolved = {
        new: F.coalesce(F.col(f"_h{i}"), F.col(f"_{i}")) for i, new in enumerate(values.values())
    }
    return joined.withColumns(resolved).drop(
        "_key", "_cold", "_hot", "_salt", "_zero", *[f"{p}{i}" for i in range(len(values)) for p in ("_", "_h")]
    )
