"""Shared pieces: word hashes of a batch, window hashes, links to components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from pricegrid.session import stage

SLICE_BYTES = 2 << 20  # text handled at once by numpy; a longer text is a slice of its own


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unique_number(docs, key):
    """Whether a key is a number that tells all rows apart."""
    if dict(docs.dtypes)[key] not in ("tinyint", "smallint", "int", "bigint"):
        return False
    rows, keys, distinct = docs.agg(F.count("*"), F.count(key), F.count_distinct(key)).first()
    return rows == keys == distinct


def map_rows(df, made, work, drop=()):
    """The rows of df with the columns `made` ({name: type}) that work(batch) gives.

    `work` takes an Arrow batch and returns a list for every made column. All other
    columns but those of `drop` stay in Arrow untouched: as pandas values, whole
    numbers beside a null would become doubles and lose digits.
    """
    names = [c for c in df.columns if c not in drop and c not in made]
    schema = T.StructType([df.schema[c] for c in names])
    for name, kind in made.items():
        schema = schema.add(name, kind)
    types = [to_arrow_type(schema[n].dataType) for n in made]

    def run(batches):
        for batch in batches:
            out = work(batch)
            arrays = [batch.column(c) for c in names] + [pa.array(out[n], t) for n, t in zip(made, types)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, *made])

    return df.mapInArrow(run, schema)


def slices(texts):
    """(first, last) row ranges of a batch with about SLICE_BYTES of text each."""
    first, held = 0, 0
    for k, text in enumerate(texts):
        size = len(text) if text is not None else 0
        if held and held + size > SLICE_BYTES:
            yield first, k
            first, held = k, 0
        held += size
    if first < len(texts):
        yield first, len(texts)


def words_of(texts):
    """Words [^\\x20\\x09-\\x0D]+ of several texts, null as empty.

    Returns where each text's words start (one more entry than texts), the
    word codes in order, and the distinct words as bytes; equal words of the
    slice share a code, so per-word work is done once per distinct word.
    """
    lists = pc.ascii_split_whitespace(pa.array([t or "" for t in texts], pa.large_string()))
    flat = lists.flatten().cast(pa.large_binary())
    kept = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(kept)])[lists.offsets.to_numpy()]
    coded = flat.filter(pa.array(kept)).dictionary_encode()
    return starts.astype(np.int64), coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()


def hash_words(words, seed=0):
    """64-bit hash of every word."""
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def mixed(x):
    """Spread the bits of 64-bit numbers (finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hash(hashes, at, length, salt=0):
    """Hash of the `length` word hashes starting at each position of `at`."""
    factors = mixed(np.arange(1, length + 1, dtype=np.uint64) + np.uint64(salt * 1_000_003)) | np.uint64(1)
    total = np.zeros(len(at), np.uint64)
    for k in range(length):
        total += hashes[at + k] * factors[k]
    return mixed(total)


def ranges(first, count):
    """first[0], first[0]+1, ... count[0] numbers, and so on for every entry."""
    total = int(count.sum())
    shift = np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
    return np.arange(total) + shift


def components(links, a="a", b="b"):
    """Smallest node reachable from every linked node: (node, component).

    Alternates the large-star and small-star steps of Kiveris et al.: every
    node's larger neighbours, then its smaller ones, are linked to the smallest
    node it sees. Each round is two grouped minima and joins on the node, so a
    node with very many links is pre-aggregated and its join can be split. Each
    round is written to the shared folder; nothing gathers on the driver.
    Nulls link with nothing.
    """
    links = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    links = stage(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    def state():
        return links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = state()
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))
        )).alias("e")).select("e.u", "e.v")
        links = stage(small.where("u <> v").distinct(), "links")
        now = state()
        if now == before:
            break
        before = now
    roots = links.select(F.col("v").alias("u"), "v").distinct()
    return links.unionByName(roots).distinct().select(F.col("u").alias("node"), F.col("v").alias("component"))
