"""Equal rows found by digest, so that wide rows move only where a copy may exist.

A row is hashed to 64 bits where it lies, and only (digest, count) is shuffled:
two longs for each distinct row of a task. The digests that occur more than once
set three bits each of a filter of FILTER_BYTES at most, however many there are;
it is written once and broadcast, and a row whose three bits are set is a candidate. All rows
that have a copy are candidates, so the others are done without a shuffle. Among
candidates whole rows are compared: equal digests of different rows and wrong
hits of the filter cost time, never a row.

Nulls equal nulls, as in grouping. Rows with columns that cannot be hashed alike
(maps, variants, collated texts) are all candidates. A table is read twice for
counts and three times to drop copies, so an expensive input should be staged, and
rows of less than NARROW bytes by their schema (WIDE to drop copies) are shuffled
whole, in one pass. The result is the same either way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricegrid.operators.features import quoted
from pricegrid.session import stage

# The filter: up to 2^15 rows of 64 longs, 16 MB of bits.
BUCKET_BITS = 15
WORDS = 64
PROBES = 3
FILTER_BYTES = (1 << BUCKET_BITS) * WORDS * 8
MARKS = 62  # null marks that fit a long
NARROW = 128  # bytes; a digest and its count take 24 in a shuffle
WIDE = 512  # dropping copies reads the table twice more, which pays for wider rows only


def hashable(kind) -> bool:
    """Whether equal values of the type, as grouping sees them, have equal hashes."""
    if isinstance(kind, T.ArrayType):
        return hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(hashable(f.dataType) for f in kind)
    if isinstance(kind, T.StringType):
        return kind == T.StringType()
    plain = (T.NumericType, T.BooleanType, T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType, T.NullType)
    return isinstance(kind, plain)


def digest(df: DataFrame, columns):
    """64-bit digest of a row. A hash passes over nulls, so their places are hashed too."""
    nullable = [c for c in columns if df.schema[c].nullable]
    marks = []
    for first in range(0, len(nullable), MARKS):
        bits = F.lit(0).cast("long")
        for k, c in enumerate(nullable[first : first + MARKS]):
            bits = bits + F.when(quoted(c).isNull(), F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long"))
        marks.append(bits)
    return F.xxhash64(*[quoted(c) for c in columns], *marks)


def _bucket(key):
    return F.shiftrightunsigned(key, 64 - BUCKET_BITS)


def _bits(key):
    """(word, bit) places of a digest in its bucket: 12 bits of the digest each."""
    low = F.lit(63).cast("long")
    parts = [F.shiftrightunsigned(key, 12 * k) for k in range(PROBES)]
    return [(F.shiftrightunsigned(p, 6).bitwiseAND(low).cast("int"), p.bitwiseAND(low).cast("int")) for p in parts]


def digest_counts(df: DataFrame, columns=None) -> DataFrame:
    """(key, n): rows per digest; the only shuffle that every row takes part in."""
    return df.select(digest(df, columns or df.columns).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def filter_table(keys: DataFrame) -> DataFrame:
    """(bucket, words) with the bits of all values of `key` set; words without a bit are null."""
    key = F.col("key")
    places = F.array(*[F.struct(w.alias("word"), b.alias("bit")) for w, b in _bits(key)])
    set_ = keys.select(_bucket(key).alias("bucket"), F.explode(places).alias("p")).select("bucket", "p.*")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))
    words = set_.groupBy("bucket", "word").agg(F.bit_or(one).alias("bits"))
    return words.groupBy("bucket").agg(
        *[F.max(F.when(F.col("word") == w, F.col("bits"))).alias(f"w{w}") for w in range(WORDS)]
    ).select("bucket", F.array(*[F.col(f"w{w}") for w in range(WORDS)]).alias("words"))


def with_candidates(df: DataFrame, columns, table: DataFrame, name="_candidate") -> DataFrame:
    """df with a boolean column: the filter holds the row's digest."""
    own, key = df.columns, F.col("_digest")
    table = F.broadcast(table.withColumnsRenamed({"bucket": "_bucket", "words": "_words"}))
    probed = df.withColumn("_digest", digest(df, columns))
    probed = probed.join(table, _bucket(key) == F.col("_bucket"), "left")
    hit = F.lit(True)
    for word, bit in _bits(key):
        hit = hit & F.coalesce(F.getbit(F.get("_words", word), bit) == 1, F.lit(False))
    return probed.select(*[quoted(c) for c in own], hit.alias(name))


def width(kind) -> int:
    """Bytes of a value as its type suggests, before any is read."""
    if isinstance(kind, T.StructType):
        return sum(width(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return 4 * width(kind.elementType)
    return 8 if isinstance(kind, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)) else 20


def by_digest(df: DataFrame, columns, narrow=NARROW) -> bool:
    kinds = [df.schema[c].dataType for c in columns]
    return all(map(hashable, kinds)) and sum(map(width, kinds)) >= narrow


def candidates(df: DataFrame, columns=None, narrow=NARROW):
    """df with the column `_candidate`: false only for rows without a copy."""
    columns = list(columns or df.columns)
    if not by_digest(df, columns, narrow):
        return df.withColumn("_candidate", F.lit(True))
    repeated = digest_counts(df, columns).where("n > 1")
    return with_candidates(df, columns, stage(filter_table(repeated), "repeated-digests"))


def drop_copies(df: DataFrame, narrow=WIDE) -> DataFrame:
    """One of each set of equal rows; without columns, every row is equal to the others."""
    judged = candidates(df, narrow=narrow)
    once = judged.where("not _candidate").drop("_candidate")
    return once.unionByName(judged.where("_candidate").drop("_candidate").dropDuplicates())


def group_counts(df: DataFrame, columns=None, narrow=NARROW) -> DataFrame:
    """One row: rows (null in an empty table), and rows beyond the first of their group."""
    columns = list(columns or df.columns)
    judged = candidates(df.select(*[quoted(c) for c in columns]), columns, narrow)
    apart = judged.agg(F.count_if(~F.col("_candidate")).alias("n"), F.count_if(~F.col("_candidate")).alias("groups"))
    groups = judged.where("_candidate").groupBy(*[quoted(c) for c in columns]).agg(F.count(F.lit(1)).alias("n"))
    groups = groups.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("groups"))
    rows = F.sum("n")
    return apart.unionByName(groups).agg(
        F.when(rows > 0, rows).alias("rows"), F.coalesce(rows - F.sum("groups"), F.lit(0)).alias("duplicates")
    )


def rows_with_copies(df: DataFrame, columns=None, narrow=NARROW) -> DataFrame:
    """All rows whose values in the columns occur more than once.

    Candidates are written once; the repeated values are then counted and joined
    back, so the copies of one row never have to meet in one task.
    """
    columns = list(columns or df.columns)
    found = df
    if by_digest(df, columns, narrow):
        found = stage(candidates(df, columns, narrow).where("_candidate").drop("_candidate"), "repeated")
    groups = found.groupBy(*[quoted(c) for c in columns]).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    groups = groups.select(*[quoted(c).alias(f"_k{i}") for i, c in enumerate(columns)])
    same = F.lit(True)
    for i, c in enumerate(columns):
        same = same & quoted(c).eqNullSafe(F.col(f"_k{i}"))
    return found.join(groups, same, "left_semi")
