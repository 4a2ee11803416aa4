"""Language-model scores by deleted interpolation of n-gram estimates.

The probability of a word after its history mixes the maximum-likelihood estimates
of all orders, down to a uniform one over the vocabulary and one unseen word. The
weight of an order depends on how often its context was seen (one weight for each
power of two) and is learned by expectation-maximisation on held-out counts: a part
of the training documents is kept out of the counts while weights are learned.

Texts are read in slices of some megabytes. A slice asks for each of its distinct
n-grams once: sorted 64-bit hashes with the slice's own counts, packed, dealt by
ranges of the hash. Tasks add up the counts of a range and answer every slice in
the order of its question, so a word that stands in all texts costs one entry a
slice. Counts cover all training documents, nothing is pruned or sampled. Answers
are written, then meet the coded words of their slice by its number, once to gather
statistics for the weights and once to score. For the weights a token matters only
by its context's size and by the ratio of its order's estimate to the mixture of
lower orders, so held-out counts are summed by steps of a 32nd octave of that
ratio: a table of bounded size, on which the iterations run.

Defined results: a null or empty text is its end token alone; equal rows and rows
with equal or null keys are documents of their own; without training documents
every token has probability one, without held-out ones weights are a half; an empty
table gives no rows. Columns that are not named are ignored. Slices must come out
alike whenever the table is read again, as they do for a table read from files;
otherwise the job stops with an error (write the table first).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricegrid.llm.common import hash_words, mixed, words_of
from pricegrid.session import stage

SLICE_BYTES = 8 << 20  # text of one slice; a longer document is a slice of its own
RANGE_BYTES = 8 << 20  # text whose n-grams fall into one range of hashes
LEAST_RANGES = 32
STEPS = 32  # per octave of the ratio
NEVER = -(1 << 20)  # step of a ratio of zero
END = np.uint64(xxhash.xxh64_intdigest(b" "))  # no word holds a space
START = np.uint64(xxhash.xxh64_intdigest(b"  "))


# Packed numbers


def pack(numbers):
    """Numbers as bytes: the low bytes of all, then the next, compressed."""
    a = np.ascontiguousarray(numbers, "<u8")
    width = max(1, (int(a.max()).bit_length() + 7) // 8) if len(a) else 1
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(data, n):
    if not n:
        return np.zeros(0, np.uint64)
    width = data[0]
    planes = np.frombuffer(pa.decompress(data[1:], decompressed_size=n * width, codec="zstd", asbytes=True), np.uint8)
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = planes.reshape(width, n).T
    return out.view("<u8").ravel()


# Tokens and n-grams of a slice


class Slice:
    """Some documents: tokens a document, word codes and word hashes."""

    def __init__(self, sizes, codes, hashes):
        self.sizes, self.codes, self.hashes = sizes, codes, hashes

    @staticmethod
    def of(texts):
        starts, codes, names = words_of(texts)
        return Slice(np.diff(starts) + 1, codes, hash_words([n.lower() for n in names]))

    @property
    def name(self):
        digest = xxhash.xxh3_64(self.sizes.tobytes())
        digest.update(self.codes.tobytes())
        digest.update(self.hashes.tobytes())
        return digest.hexdigest()

    def grams(self, order):
        """Per order: the distinct n-grams' sorted hashes and every token's place in them.

        The n-gram of a token ends with it; before the first token stand start words.
        """
        ends = np.cumsum(self.sizes)
        words = np.full(int(self.sizes.sum()), END, np.uint64)
        is_word = np.ones(len(words), bool)
        is_word[ends - 1] = False
        words[is_word] = self.hashes[self.codes]
        place = np.arange(len(words)) - np.repeat(ends - self.sizes, self.sizes)
        gram, out = words, []
        for k in range(1, order + 1):
            if k > 1:
                back = np.concatenate([np.full(k - 1, START, np.uint64), words])[: len(words)]
                back[place < k - 1] = START
                gram = mixed(gram * np.uint64(0x9E3779B97F4A7C15) + mixed(back + np.uint64(k)))
            out.append(np.unique(gram, return_inverse=True))
        return out

    @property
    def firsts(self):
        return np.cumsum(self.sizes) - self.sizes


def _pieces(batches, slice_bytes):
    """Tables of about `slice_bytes` of text each, in the order of the rows."""
    held, size = [], 0
    for batch in batches:
        upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < len(upto):
            before = int(upto[first - 1]) if first else 0
            last = max(int(np.searchsorted(upto, before + slice_bytes - size, "right")), first + (0 if held else 1))
            if last > first:
                held.append(batch.slice(first, last - first))
                size += int(upto[last - 1]) - before
                first = last
            if first < len(upto):
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _named(batches, slice_bytes):
    """(number of the slice, its rows, its words)."""
    for k, rows in enumerate(_pieces(batches, slice_bytes)):
        words = Slice.of(rows.column("text").to_pylist())
        yield f"{TaskContext.get().partitionId()}-{k}-{words.name}", rows, words


def _flags(rows, name):
    return rows.column(name).to_numpy().astype(bool)


def _requests(order, bounds, slice_bytes):
    """The distinct n-grams of every slice with its counts, cut by hash range."""

    def run(batches):
        for name, rows, words in _named(batches, slice_bytes):
            train, tune = _flags(rows, "train"), _flags(rows, "tune")
            of_kept, of_held = np.repeat(train & ~tune, words.sizes), np.repeat(train & tune, words.sizes)
            for k, (grams, at) in enumerate(words.grams(order), 1):
                kept = np.bincount(at[of_kept], minlength=len(grams))
                held = np.bincount(at[of_held], minlength=len(grams))
                edges = np.append(np.searchsorted(grams, bounds), len(grams))
                out = {c: [] for c in ("part", "slice", "gram_order", "n", "grams", "kept", "held")}
                for part, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
                    if a < b:
                        row = part, name, k, b - a, pack(np.diff(grams[a:b], prepend=np.uint64(0))), pack(kept[a:b]), pack(held[a:b])
                        for c, v in zip(out.values(), row):
                            c.append(v)
                kinds = pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], names=list(out))

    return run


REQUEST = "part int, slice string, gram_order int, n long, grams binary, kept binary, held binary"
ANSWER = "slice string, gram_order int, part int, n long, kept binary, whole binary, stat string, step int, weight double, total double"


def steps_of(ratio):
    """Step of a ratio on the logarithmic scale."""
    out = np.full(len(ratio), NEVER, np.int64)
    some = ratio > 0
    out[some] = np.floor(STEPS * np.log2(ratio[some])).astype(np.int64)
    return out


def _counted(table):
    """Counts of the n-grams of one range, as answers to all slices that asked."""
    out = {c.split()[0]: [] for c in ANSWER.split(", ")}

    def add(**row):
        for c, v in out.items():
            v.append(row.get(c))

    orders = table.column("gram_order").to_numpy()
    for k in np.unique(orders).tolist():
        rows = table.filter(pa.array(orders == k)).to_pylist()
        grams = np.concatenate([np.cumsum(unpack(r["grams"], r["n"]), dtype=np.uint64) for r in rows])
        distinct, at = np.unique(grams, return_inverse=True)
        sums = [np.zeros(len(distinct), np.int64) for _ in range(2)]
        for total, name in zip(sums, ("kept", "held")):
            np.add.at(total, at, np.concatenate([unpack(r[name], r["n"]) for r in rows]).astype(np.int64))
        kept, held = sums
        first = 0
        for r in rows:
            some = at[first : first + r["n"]]
            first += r["n"]
            add(slice=r["slice"], gram_order=k, part=r["part"], n=r["n"], kept=pack(kept[some]), whole=pack((kept + held)[some]))
        if k == 1:
            add(stat="size", step=0, weight=float(kept.sum()), total=float((kept + held).sum()))
            add(stat="words", step=0, weight=float((kept + held > 0).sum()), total=0.0)
            some = held > 0
            for step, weight, total in _by_step(steps_of(kept[some].astype(float)), held[some], kept[some].astype(float)):
                add(stat="held", step=step, weight=weight, total=total)
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64()}
    return pa.table({c.split()[0]: pa.array(out[c.split()[0]], kinds[c.split()[1]]) for c in ANSWER.split(", ")})


def _by_step(steps, weights, values):
    """(step, sum of weights, weighted sum of values) of every step."""
    names, at = np.unique(steps, return_inverse=True)
    weight = np.bincount(at, weights=weights, minlength=len(names))
    total = np.bincount(at, weights=weights * values, minlength=len(names))
    return list(zip(names.tolist(), weight.tolist(), total.tolist()))


# Weights


def learn_weights(rows, rounds=3000):
    """Weight of the upper estimate per bucket, by expectation-maximisation.

    rows: (bucket, ratio of the upper to the lower estimate, held-out count). All
    buckets together give the weight that stands for one event more in each.
    """
    if not rows:
        return {}, 0.5

    def best(ratio, count, prior=None):
        w = 0.5
        for _ in range(rounds):
            share = w * ratio / (w * ratio + 1 - w)
            new = (count @ share + (prior or 0)) / (count.sum() + (prior is not None))
            new = min(max(new, 1e-6), 1 - 1e-6)
            if abs(new - w) < 1e-10:
                break
            w = new
        return float(w)

    bucket, ratio, count = (np.array(c, float) for c in zip(*rows))
    whole = best(ratio, count)
    return {int(b): best(ratio[bucket == b], count[bucket == b], whole) for b in np.unique(bucket)}, whole


def buckets_of(counts):
    """0 for an unseen context, else one more than the power of two below its count."""
    return np.where(counts > 0, np.frexp(counts.astype(float))[1], 0)


class Mixture:
    """Sizes of the training text and the learned weights of the orders."""

    def __init__(self, kept_tokens, tokens, words):
        self.kept_tokens, self.tokens, self.words, self.weights = kept_tokens, tokens, words, []

    def estimates(self, counts, inverses, firsts, tokens, upto):
        """Probability of every token by the orders learned, and for the next one
        its context counts and maximum-likelihood estimates."""
        single = counts[0][inverses[0]].astype(float)
        one = self.weights[0][0].get(0, self.weights[0][1]) if self.weights and tokens else 0.0
        p = one * single / max(tokens, 1) + (1 - one) / (self.words + 1)
        for k in range(2, upto + 1):
            context, ml = self.order(counts, inverses, firsts, k)
            if k > len(self.weights):
                return p, context, ml
            table, other = self.weights[k - 1]
            weight = np.array([0.0] + [table.get(b, other) for b in range(1, 65)])[buckets_of(context)]
            p = weight * ml + (1 - weight) * p
        return p, None, None

    @staticmethod
    def order(counts, inverses, firsts, k):
        before = counts[k - 2][inverses[k - 2]]
        context = np.empty_like(before)
        context[1:] = before[:-1]
        context[firsts] = counts[0][inverses[0][-1]]  # as many starts as ends
        some = counts[k - 1][inverses[k - 1]].astype(float)
        return context, np.divide(some, context, out=np.zeros(len(some)), where=context > 0)


def _coded(key_type, slice_bytes):
    """The words of every slice, packed."""

    def run(batches):
        for name, rows, words in _named(batches, slice_bytes):
            keys = rows.column("key").combine_chunks()
            yield pa.RecordBatch.from_arrays([
                pa.array([name]), pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
                pa.array([len(words.codes)], pa.int64()), pa.array([len(words.hashes)], pa.int64()),
                pa.array([pack(words.sizes)], pa.binary()), pa.array([pack(words.codes)], pa.binary()),
                pa.array([words.hashes.tobytes()], pa.binary()),
                pa.array([pack(_flags(rows, "train") & _flags(rows, "tune"))], pa.binary()),
            ], names=["slice", "keys", "n_words", "n_names", "sizes", "codes", "hashes", "tune"])

    schema = T.StructType([T.StructField("slice", T.StringType()), T.StructField("keys", T.ArrayType(key_type))])
    for name, kind in (("n_words", "long"), ("n_names", "long"), ("sizes", "binary"), ("codes", "binary"), ("hashes", "binary"), ("tune", "binary")):
        schema = schema.add(name, kind)
    return run, schema


def _met(coded, answers, order, column):
    """(keys, words, n-gram places, counts of every order, held-out documents) of a slice."""
    if coded.num_rows != 1:
        raise RuntimeError("the table was read in another order; write it to files first")
    row = coded.drop_columns(["keys"]).to_pylist()[0]
    keys = coded.column("keys").combine_chunks().flatten()
    words = Slice(unpack(row["sizes"], len(keys)).astype(np.int64), unpack(row["codes"], row["n_words"]).astype(np.int64),
                  np.frombuffer(row["hashes"], np.uint64))
    grams = words.grams(order)
    rows = sorted(answers.select(["gram_order", "part", "n", column]).to_pylist(), key=lambda r: (r["gram_order"], r["part"]))
    counts = [np.concatenate([np.zeros(0, np.uint64)] + [unpack(r[column], r["n"]) for r in rows if r["gram_order"] == k]).astype(np.int64)
              for k in range(1, order + 1)]
    if [len(c) for c in counts] != [len(g) for g, _ in grams]:
        raise RuntimeError("the table was read in another order; write it to files first")
    return keys, words, [at for _, at in grams], counts, unpack(row["tune"], len(keys)).astype(bool)


def fit(docs, train, tune, key="doc_id", text="text", order=2, slice_bytes=SLICE_BYTES, range_bytes=RANGE_BYTES):
    """Counts and weights learned from the documents where `train` holds; those
    where `tune` holds too are held out while weights are learned.

    The slices times the ranges are the rows that are dealt, so both sizes should
    grow with the square root of a corpus beyond some terabytes.
    """
    true = lambda c: F.coalesce(c, F.lit(False))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), true(train).alias("train"), true(tune).alias("tune"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(LEAST_RANGES, math.ceil(size / range_bytes))
    bounds = np.array([(k << 64) // parts for k in range(parts)], np.uint64)
    asked = rows.mapInArrow(_requests(order, bounds, slice_bytes), REQUEST)
    answers = stage(asked.groupBy("part").applyInArrow(_counted, ANSWER), "lm-counts")
    stats = answers.where("slice is null").groupBy("stat", "step").agg(F.sum("weight"), F.sum("total")).collect()
    sizes = next(((r[2], r[3]) for r in stats if r["stat"] == "size"), (0.0, 0.0))
    mixture = Mixture(int(sizes[0]), int(sizes[1]), int(next((r[2] for r in stats if r["stat"] == "words"), 0)))
    scale = (mixture.words + 1) / max(mixture.kept_tokens, 1)
    mixture.weights.append(learn_weights([(0, r[3] / r[2] * scale, r[2]) for r in stats if r["stat"] == "held"]))
    model = Scores(rows, answers.where("slice is not null"), mixture, order, key, slice_bytes)
    for k in range(2, order + 1):
        found = model.events(k).groupBy("bucket", "step").agg(F.sum("weight"), F.sum("total")).collect()
        mixture.weights.append(learn_weights([(r["bucket"], r[3] / r[2], r[2]) for r in found]))
    return model


class Scores:
    """A fitted model over the table it was fitted on."""

    def __init__(self, rows, answers, mixture, order, key, slice_bytes):
        self.rows, self.answers, self.mixture, self.order, self.key = rows, answers, mixture, order, key
        self.slice_bytes = slice_bytes

    def _slices(self, column):
        run, schema = _coded(self.rows.schema["key"].dataType, self.slice_bytes)
        coded = self.rows.mapInArrow(run, schema)
        answers = self.answers.select("slice", "gram_order", "part", "n", column)
        return coded.groupBy("slice").cogroup(answers.groupBy("slice"))

    def events(self, k):
        """Held-out counts of order k by context bucket and step of the ratio."""
        mixture, order = self.mixture, self.order

        def run(coded, answers):
            _, words, at, counts, tune = _met(coded, answers, order, "kept")
            lower, context, ml = mixture.estimates(counts, at, words.firsts, mixture.kept_tokens, k)
            some = np.repeat(tune, words.sizes) & (context > 0)
            bucket, ratio = buckets_of(context[some]), ml[some] / lower[some]
            rows = [(int(b), *r) for b in np.unique(bucket)
                    for r in _by_step(steps_of(ratio[bucket == b]), np.ones((bucket == b).sum()), ratio[bucket == b])]
            b, step, weight, total = zip(*rows) if rows else ((),) * 4
            return pa.table({"bucket": pa.array(b, pa.int32()), "step": pa.array(step, pa.int32()),
                             "weight": pa.array(weight, pa.float64()), "total": pa.array(total, pa.float64())})

        return self._slices("kept").applyInArrow(run, "bucket int, step int, weight double, total double")

    def score(self):
        """Per document: key, n_tokens, n_known, train_tokens, base_score, score."""
        mixture, order, key_type = self.mixture, self.order, self.rows.schema["key"].dataType

        def run(coded, answers):
            keys, words, at, counts, _ = _met(coded, answers, order, "whole")
            single = counts[0][at[0]]
            p, _, _ = mixture.estimates(counts, at, words.firsts, mixture.tokens, order)
            base = np.log10((single + 0.5) / (mixture.tokens + 0.5 * (mixture.words + 1)))
            total = lambda x: pa.array(np.add.reduceat(x, words.firsts))
            return pa.table({
                "key": keys, "n_tokens": pa.array(words.sizes), "n_known": total((single > 0).astype(np.int64)),
                "train_tokens": pa.array(np.full(len(keys), mixture.tokens)), "base_score": total(base), "score": total(np.log10(p)),
            })

        schema = T.StructType([T.StructField("key", key_type)]).add("n_tokens", "long").add("n_known", "long")
        schema = schema.add("train_tokens", "long").add("base_score", "double").add("score", "double")
        return self._slices("whole").applyInArrow(run, schema).withColumnRenamed("key", self.key)
