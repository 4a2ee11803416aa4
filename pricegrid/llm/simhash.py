"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at distance r have a common neighbour within r/2 of both, so
equal variants within half the radius find every pair. All variants of 64 bits
within 2 are 2081 rows a fingerprint. The bits are therefore cut into PARTS
parts: if two fingerprints differ in at most r bits, leaving out the part with
most differences leaves at most floor(r (p-1) / p) of them. Each choice of a
part to leave out gives a shorter key, whose ball of half that radius is 44
rows (132 in all for r = 4, p = 3); pairs met there are verified on all bits.

Keys met by more than CROWD fingerprints are not compared pair by pair: their
members emit the full ball, where all who meet are within r of one another, so
linking each to the smallest is exact. A full-ball key has at most 2081 members.

Nulls and texts without words have fingerprint zero; equal fingerprints are one
class before any variant is made, so copies cost nothing.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F

from pricegrid.llm.common import components, map_rows
from pricegrid.session import stage

PARTS = 3
CROWD = 64
CHUNK = 1 << 16


def fingerprint(text, size=4, seed=42):
    """Signed 64-bit SimHash of a text's word shingles, repeats included."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    if len(words) < size:
        first, last = [0], [len(joined)]
    else:
        first = [0, *ends[: len(words) - size].tolist()]
        last = (ends[size - 1 :] - 1).tolist()
    counts, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for k in range(0, len(first), CHUNK):
        hashes = np.fromiter(
            (digest(joined[a:b], seed) for a, b in zip(first[k : k + CHUNK], last[k : k + CHUNK])), np.dtype(">u8")
        )
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(first)).view(">i8")[0])


def fingerprints(docs, text="text", size=4, seed=42):
    """The documents with a column `fp` (signed 64-bit); the text is dropped."""
    made = lambda batch: {"fp": [fingerprint(t, size, seed) for t in batch.column(text).to_pylist()]}
    return map_rows(docs, {"fp": "long"}, made, drop=[text])


def _signed(mask):
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _ball(bits, radius):
    """All masks of at most `radius` of the given bits."""
    return [_signed(sum(1 << b for b in c)) for n in range(radius + 1) for c in combinations(bits, n)]


def _variants(fps, radius, parts):
    """(key, fp) rows of every projected ball; parts = 1 is the full ball."""
    cut = [range(64 * k // parts, 64 * (k + 1) // parts) for k in range(parts)]
    rows = []
    for out, dropped in enumerate(cut):
        bits = range(64) if parts == 1 else [b for b in range(64) if b not in dropped]
        left = radius if parts == 1 else radius * (parts - 1) // parts
        keep = sum(1 << b for b in bits)
        tag = 0 if parts == 1 else (out + 1) << dropped[0]  # the free bits tell which part is left out
        masks = F.array(*[F.lit(m) for m in _ball(bits, -(-left // 2))])
        base = F.col("fp").bitwiseAND(F.lit(_signed(keep))).bitwiseOR(F.lit(_signed(tag)))
        rows.append((base, masks))
    made = None
    for base, masks in rows:
        one = fps.select("fp", base.alias("base"), F.explode(masks).alias("mask"))
        one = one.select(F.col("base").bitwiseXOR(F.col("mask")).alias("key"), "fp")
        made = one if made is None else made.unionByName(one)
    return made


def _runs(batches):
    """(keys, fps) of whole runs of equal keys with two members or more."""
    held = None
    for batch in batches:
        key, fp = batch["key"].to_numpy(), batch["fp"].to_numpy()
        if held is not None:
            key, fp = np.concatenate([held[0], key]), np.concatenate([held[1], fp])
        if not len(key):
            continue
        last = np.searchsorted(key, key[-1])
        held = key[last:], fp[last:]
        yield key[:last], fp[:last]
    if held is not None:
        yield held


def _close(radius, crowd):
    """Links (a < b) within small runs, and the members of crowded ones (b null)."""

    def run(batches):
        for key, fp in _runs(batches):
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, int)
            sizes = np.diff(np.append(starts, len(key)))
            place = np.repeat(sizes, sizes)
            small = np.flatnonzero((place > 1) & (place <= crowd))
            k, f = key[small], fp[small]
            for step in range(1, crowd):
                if step >= len(k):
                    break
                near = k[step:] == k[:-step]
                if not near.any():
                    break
                x, y = f[:-step][near], f[step:][near]
                linked = np.bitwise_count((x ^ y).view(np.uint64)) <= radius
                if linked.any():
                    pairs = np.unique(np.sort(np.stack([x[linked], y[linked]], 1), axis=1), axis=0)
                    yield pd.DataFrame({"a": pairs[:, 0], "b": pd.array(pairs[:, 1], "Int64")})
            many = np.unique(fp[place > crowd])
            if len(many):
                yield pd.DataFrame({"a": many, "b": pd.array([None] * len(many), "Int64")})

    return run


def _stars(batches):
    """Each member of a run linked to the run's first fingerprint."""
    for key, fp in _runs(batches):
        if len(key):
            head = np.concatenate([[True], key[1:] != key[:-1]])
            first = fp[np.maximum.accumulate(np.where(head, np.arange(len(key)), 0))]
            pairs = np.unique(np.stack([first, fp], 1)[first != fp], axis=0)
            if len(pairs):
                yield pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})


def ball_links(fps, radius=4, parts=PARTS, crowd=CROWD):
    """Links that join all distinct fingerprints within `radius` bits.

    fps has a distinct long column `fp`. Every returned pair (a, b) is within
    the radius, and any two fingerprints within it are joined by a path.
    """
    fps = fps.select("fp")
    if parts == 1:
        made = _variants(fps, radius, 1).repartition("key").sortWithinPartitions("key", "fp")
        return made.mapInPandas(_stars, "a long, b long")
    met = _variants(fps, radius, parts).repartition("key").sortWithinPartitions("key")
    met = stage(met.mapInPandas(_close(radius, crowd), "a long, b long"), "simhash-met")
    crowded = met.where("b is null").select(F.col("a").alias("fp")).distinct()
    return met.where("b is not null").distinct().unionByName(ball_links(crowded, radius, 1))


def near_duplicates(docs, key="doc_id", text="text", size=4, radius=4, seed=42):
    """One row per document: key, fingerprint (16 hex digits), component_id.

    component_id is the smallest key reachable over links of at most `radius`
    bits, the document included; documents without a key take part and get the
    component's smallest key, null if it has none. Other columns are dropped.
    """
    fps = stage(fingerprints(docs.select(key, text), text, size, seed), "fingerprints")
    classes = fps.groupBy("fp").agg(F.min(key).alias("low"))
    joined = components(ball_links(classes, radius)).withColumnRenamed("node", "fp")
    classes = classes.join(joined, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    lows = classes.groupBy("component").agg(F.min("low").alias("component_id"))
    classes = stage(classes.join(lows, "component").select("fp", "component_id"), "simhash-classes")
    out = fps.join(classes, "fp")
    return out.select(key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs, key="doc_id", text="text", **options):
    """The documents without those whose group has a smaller key.

    Rows that repeat a kept key are the same document and stay; documents
    without a key cannot be told apart and stay too.
    """
    groups = near_duplicates(docs, key, text, **options)
    kept = groups.where(F.col(key) == F.col("component_id")).select(F.col(key).alias("__kept")).distinct()
    found = docs.join(kept, docs[key] == kept["__kept"], "left_semi")
    return found.unionByName(docs.where(F.col(key).isNull()))
