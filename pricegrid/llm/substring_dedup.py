"""Substring dedup: every word covered by a window that also starts elsewhere.

Anchors are the windows of LENGTH - PERIOD + 1 words that start at positions of
a difference cover modulo PERIOD: for any two positions i and j some shift below
the period puts both on the cover. So two equal windows of LENGTH words, wherever
they start, share an equal anchor at the same shift, and only 5 of 21 positions
are hashed. Where an anchor is met twice, the windows that hold it are hashed in
full (extended) and compared; a window met twice has all its words removed.

A row of text is one document, known by its key where that is a number that
tells all rows apart, else by a hash of key and text; so rows that repeat a key
or have none are told apart too, and equal rows are copies of one another. Equal
texts are found by hash first: all their windows occur elsewhere, and one of them
stands for all as the partner of other texts. Hashes met twice within a task are
settled there and one row goes on for all, so a passage in a third of all
documents is a row a task and hash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from pricegrid.llm.common import hash_words, map_rows, slices, unique_number, window_hash, words_of
from pricegrid.session import stage

LENGTH = 35
#: A perfect difference set modulo 21.
PERIOD, COVER = 21, (0, 1, 6, 8, 18)


def is_cover(period, cover):
    return {(a - b) % period for a in cover for b in cover} == set(range(period))


def _settle(rows, hashes, extra):
    """Rows to send on: one a hash, marked if it was met twice; the others as met.

    rows: frame with row and at; hashes: their first hash; extra: second hash.
    """
    order = np.lexsort((extra, hashes))
    h, x = hashes[order], extra[order]
    head = np.concatenate([[True], (h[1:] != h[:-1]) | (x[1:] != x[:-1])]) if len(h) else np.zeros(0, bool)
    starts = np.flatnonzero(head)
    sizes = np.diff(np.append(starts, len(h)))
    met = np.repeat(sizes > 1, sizes)
    out = rows.iloc[order].reset_index(drop=True)
    out["h"], out["x"] = h.view(np.int64), (x >> np.uint64(32)).astype(np.uint32).view(np.int32)
    out["met"] = met
    rest = ~head
    # Others of the same hash only carry their place on: they are dealt by it and need no partner.
    out.loc[rest, "h"] = (out.loc[rest, "row"].to_numpy() ^ (out.loc[rest, "at"].to_numpy().astype(np.int64) * 0x9E3779B1)).astype(np.int64)
    out["lone"] = rest
    return out


def _met(batches):
    """Places (row, at) whose hash is met twice; rows come sorted by h, x, lone."""
    held = None
    for batch in batches:
        if held is not None:
            batch = pd.concat([held, batch], ignore_index=True)
        if not len(batch):
            continue
        h, x, lone = batch["h"].to_numpy(), batch["x"].to_numpy(), batch["lone"].to_numpy()
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (x[1:] != x[:-1]) | (lone[1:] != lone[:-1])])
        last = np.flatnonzero(new)[-1]
        # A run that goes on in the next batch is held as its last two rows; earlier ones are known by then.
        run = np.repeat(np.diff(np.append(np.flatnonzero(new), len(h))), np.diff(np.append(np.flatnonzero(new), len(h))))
        yes = batch["met"].to_numpy() | ((run > 1) & ~lone)
        done = np.arange(len(h)) < last
        tail = np.arange(len(h)) >= last
        if tail.sum() > 2:
            done |= tail & (np.arange(len(h)) < len(h) - 2)
        out = batch[done & yes]
        held = batch[~done]
        if len(held) and yes[-1]:
            held = held.assign(met=held["met"] | (~held["lone"]))
        if len(out):
            yield out[["row", "at"]]
    if held is not None and len(held):
        h, x, lone = held["h"].to_numpy(), held["x"].to_numpy(), held["lone"].to_numpy()
        pair = len(held) > 1 and h[0] == h[-1] and x[0] == x[-1] and not lone.any()
        out = held[held["met"].to_numpy() | pair]
        if len(out):
            yield out[["row", "at"]]


def _slices(batch, text):
    """Word starts, word hashes and the row range of every slice of a batch."""
    for a, b in slices(batch[text]):
        starts, codes, words = words_of(batch[text].iloc[a:b])
        yield a, b, starts, hash_words(words)[codes]


def anchors(docs, length=LENGTH, period=PERIOD, cover=COVER):
    """One row an anchor of (row, text): row, at, h, x, met, lone."""
    size = length - period + 1
    cover = np.array(cover)

    def run(batches):
        for batch in batches:
            for a, b, starts, hashes in _slices(batch, "text"):
                lengths = np.diff(starts)
                owner = np.repeat(np.arange(b - a), lengths)
                at = np.arange(len(hashes)) - starts[:-1][owner]
                good = np.isin(at % period, cover) & (at + size <= lengths[owner]) & (lengths[owner] >= length)
                where = np.flatnonzero(good)
                h = window_hash(hashes, where, size)
                rows = pd.DataFrame({"row": batch["row"].to_numpy()[a:b][owner[where]], "at": at[where].astype(np.int32)})
                yield _settle(rows, h, np.zeros(len(h), np.uint64))[["row", "at", "h", "met", "lone"]]

    return docs.mapInPandas(run, "row long, at int, h long, met boolean, lone boolean")


def _windows(length, period):
    size = length - period + 1

    def run(batches):
        for batch in batches:
            for a, b, starts, hashes in _slices(batch, "text"):
                out = []
                for k in range(a, b):
                    found = np.sort(np.array(batch["anchors"].iloc[k], np.int64))
                    n = int(starts[k - a + 1] - starts[k - a])
                    if not len(found) or n < length:
                        continue
                    lo = np.maximum(found - (length - size), 0)
                    hi = np.minimum(found, n - length)
                    near = np.zeros(n + 1, np.int64)
                    ok = lo <= hi
                    np.add.at(near, lo[ok], 1)
                    np.add.at(near, hi[ok] + 1, -1)
                    at = np.flatnonzero(np.cumsum(near)[:-1] > 0)
                    out.append((k, at))
                if not out:
                    continue
                at = np.concatenate([p for _, p in out])
                base = np.concatenate([np.full(len(p), starts[k - a]) for k, p in out])
                row = np.concatenate([np.full(len(p), batch["row"].iloc[k]) for k, p in out])
                rows = pd.DataFrame({"row": row, "at": at.astype(np.int32)})
                yield _settle(rows, window_hash(hashes, base + at, length), window_hash(hashes, base + at, length, salt=1))

    return run


def _with_key(docs, key, text):
    """row, __key and text; row tells texts apart (see above)."""
    unique = unique_number(docs, key)
    row = F.col(key).cast("long") if unique else F.xxhash64(F.lit("row"), F.col(key), F.col(text))
    return docs.select(row.alias("row"), F.col(key).alias("__key"), F.col(text).alias("text")).where("row is not null")


def copies(keyed):
    """(row, stands) of texts that occur more than once; one row stands for all."""
    texts = keyed.where("text is not null").select("row", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit("second"), "text").alias("t2"))
    groups = texts.groupBy("t1", "t2").agg(F.min("row").alias("first"), F.count("*").alias("n")).where("n > 1")
    return texts.join(groups, ["t1", "t2"]).select("row", (F.col("row") == F.col("first")).alias("stands")).distinct()


def repeated_starts(keyed, repeated, length=LENGTH, period=PERIOD, cover=COVER):
    """(row, starts): the start positions of windows that also start elsewhere.

    keyed: row, __key and text; repeated: `copies` of it, of which only those
    that stand for their text are looked at.
    """
    if not is_cover(period, cover) or not period <= length:
        raise ValueError("cover must be a difference cover of a period no longer than the window")
    dealt = anchors(keyed.select("row", "text"), length, period, cover).repartition("h").sortWithinPartitions("h", "lone")
    dealt = dealt.select("row", "at", "h", F.lit(0).alias("x"), "met", "lone")
    found = dealt.mapInPandas(_met, "row long, at int")
    found = found.groupBy("row").agg(F.collect_set("at").alias("anchors"))
    found = stage(found.join(repeated.where("not stands"), "row", "left_anti"), "anchors")
    candidates = keyed.join(found, "row").mapInPandas(
        _windows(length, period), "row long, at int, h long, x int, met boolean, lone boolean"
    )
    dealt = candidates.repartition("h").sortWithinPartitions("h", "x", "lone")
    twice = dealt.mapInPandas(_met, "row long, at int")
    return twice.groupBy("row").agg(F.collect_set("at").alias("starts"))


def kept_words(text, starts, length, copied=False):
    """A text's words (bytes) without those covered by windows at `starts`, and their number before.

    A copied text loses all words if it holds a window.
    """
    words = (text or "").encode("utf-8", "replace").split()
    if copied:
        return [] if len(words) >= length else words, len(words)
    if starts is None or not len(starts):
        return words, len(words)
    cover = np.zeros(len(words) + 1, np.int64)
    at = np.array(starts, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + length, -1)
    keep = np.cumsum(cover)[:-1] == 0
    return [words[k] for k in np.flatnonzero(keep)], len(words)


def remove_repeated(docs, key="doc_id", text="text", length=LENGTH, period=PERIOD, cover=COVER, digest=False):
    """One row per row of `docs`: key, n_words, n_removed and the kept words.

    The kept words are joined by one space in `kept`, or with digest=True given
    as their SHA-256 in `kept_sha256`. Null texts have no words; a text shorter
    than a window keeps all. Other columns are dropped.
    """
    keyed = _with_key(docs, key, text)
    repeated = stage(copies(keyed), "copied-texts")
    starts = repeated_starts(keyed, repeated, length, period, cover)
    starts = starts.join(repeated.select("row", F.lit(True).alias("copied")), "row", "full")
    name = "kept_sha256" if digest else "kept"
    made = {"n_words": "long", "n_removed": "long", name: "string"}

    def work(batch):
        out = {c: [] for c in made}
        for t, s, c in zip(*(batch.column(c).to_pylist() for c in ("text", "starts", "copied"))):
            kept, n = kept_words(t, s, length, bool(c))
            joined = b" ".join(kept)
            out["n_words"].append(n)
            out["n_removed"].append(n - len(kept))
            out[name].append(hashlib.sha256(joined).hexdigest() if digest else joined.decode("utf-8", "replace"))
        return out

    # Both joins take the same columns of the documents, so Spark deals them out once.
    met = keyed.join(starts, "row", "left").select("__key", "text", "starts", "copied")
    return map_rows(met, made, work, drop=["text", "starts", "copied"]).withColumnRenamed("__key", key)
