"""Scores by deleted interpolation against a plain version."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from pricegrid.llm import lm_scores
from pricegrid.llm.common import table
from tests.conftest import SF
from tests.llm import brute


def tokens(text):
    return [*brute.words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")), ("end",)]


def plain_counts(texts, order):
    counts = [Counter() for _ in range(order + 1)]
    for text in texts:
        w = [("start",)] * order + tokens(text)
        for i in range(order, len(w)):
            for k in range(1, order + 1):
                counts[k][tuple(w[i - k + 1 : i + 1])] += 1
        for k in range(1, order):  # contexts before the first token
            counts[k][(("start",),) * k] += 1
    return counts


def plain_mix(texts, counts, weights, total, words, upto):
    """Per text and token (probability by orders up to `upto`, bucket, ratio of the next)."""
    for text in texts:
        order = len(counts) - 1
        w, out = [("start",)] * order + tokens(text), []
        for i in range(order, len(w)):
            one = weights[0][0].get(0, weights[0][1]) if total and weights else 0
            p, b, ratio = one * counts[1][(w[i],)] / max(total, 1) + (1 - one) / (words + 1), None, None
            for k in range(2, order + 1):
                c = counts[k - 1][tuple(w[i - k + 1 : i])]
                ml = counts[k][tuple(w[i - k + 1 : i + 1])] / c if c else 0.0
                b = c.bit_length()
                if k > upto:
                    ratio = ml / p
                    break
                lam = weights[k - 1][0].get(b, weights[k - 1][1]) if c else 0.0
                p = lam * ml + (1 - lam) * p
            out.append((p, b, ratio))
        yield out


def plain_em(rows):
    """Weight by iterating over every single event."""
    lam = 0.5
    for _ in range(3000):
        lam = sum(lam * r / (lam * r + 1 - lam) for r in rows) / len(rows)
    return lam


def corpus(rng, n=150):
    words = [f"w{k}" for k in range(40)]
    texts = []
    for k in range(n):
        w = [rng.choice(words)]
        for _ in range(rng.randrange(0, 60)):
            at = int(w[-1].strip("wW")) * 7 % 40
            w.append(words[(at + rng.choice([0, 0, 0, 1, 2])) % 40] if rng.random() < 0.8 else rng.choice(words))
        texts.append(" ".join(x.upper() if rng.random() < 0.1 else x for x in w))
    return texts


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_plain_ones(spark, order):
    rng = random.Random(order)
    texts = corpus(rng) + [None, "", " \t", "w1 w1 w1", "w1 w1 w1"]
    rows = [(k, t, k % 5 != 1, k % 5 == 2) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, train boolean, tune boolean").repartition(3, "doc_id")
    from pricegrid.session import stage

    model = lm_scores.fit(stage(df, "lm"), F.col("train"), F.col("tune"), order=order, slice_bytes=1500, range_bytes=200)
    kept = plain_counts([t for _, t, a, b in rows if a and not b], order)
    whole = plain_counts([t for _, t, a, _ in rows if a], order)
    n, v = sum(whole[1][(x,)] for x in {g[0] for g in whole[1]} - {("start",)}), len(set(whole[1]) - {(("start",),)})
    n_kept = sum(c for g, c in kept[1].items() if g != (("start",),))
    assert (model.mixture.tokens, model.mixture.words, model.mixture.kept_tokens) == (n, v, n_kept)
    weights = model.mixture.weights
    assert len(weights) == order
    # Every weight lies where iterating over all single events leads, but for the prior event and the steps.
    tuned = [t for _, t, _, b in rows if b]
    events = [kept[1][(x,)] / n_kept * (v + 1) for t in tuned for x in tokens(t)]
    assert abs(weights[0][1] - plain_em(events)) < 0.01
    for k in range(2, order + 1):
        met = [x for out in plain_mix(tuned, kept, weights, n_kept, v, k - 1) for x in out if x[1]]
        assert abs(weights[k - 1][1] - plain_em([r for _, _, r in met])) < 0.01
    got = {r["doc_id"]: r for r in model.score().collect()}
    assert len(got) == len(rows)
    for (k, t, _, _), out in zip(rows, plain_mix(texts, whole, weights, n, v, order)):
        r, w = got[k], tokens(t)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(whole[1][(x,)] > 0 for x in w), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((whole[1][(x,)] + 0.5) / (n + 0.5 * (v + 1))) for x in w), rel=1e-9)
        assert r["score"] == pytest.approx(sum(math.log10(p) for p, _, _ in out), rel=1e-9)
    if order > 1:
        held = [r for k, r in got.items() if k % 5 == 1]
        assert sum(r["score"] for r in held) > 1.1 * sum(r["base_score"] for r in held)


def test_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    fold = lambda d: zlib.crc32(str(d).encode()) % 5
    counts = Counter(x for d, t in docs if fold(d) != 1 for x in tokens(t))
    n, v = sum(counts.values()), len(counts)
    got = {r["doc_id"]: r for r in entry.queries()["op12_lm_scores"](spark, SF).collect()}
    assert len(got) == len(docs)
    for d, t in docs:
        r, w = got[d], tokens(t)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (fold(d) == 1, len(w), sum(x in counts for x in w), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), rel=1e-9)
    for held in (True, False):
        some = [r for r in got.values() if r["held_out"] == held]
        assert sum(r["score"] for r in some) > sum(r["base_score"] for r in some)


def test_probabilities_sum_to_one(spark):
    rng = random.Random(9)
    texts = corpus(rng, 40)
    known = sorted({x for t in texts for x in tokens(t)[:-1]})
    probes = [f"w1 {x}" for x in [*known, "unseen"]] + ["w1"]
    rows = [(k, t, True, k % 4 == 0) for k, t in enumerate(texts)] + [(1000 + k, t, False, False) for k, t in enumerate(probes)]
    df = spark.createDataFrame(rows, "doc_id long, text string, train boolean, tune boolean")
    model = lm_scores.fit(df, F.col("train"), F.col("tune"))
    model_rows = {r["doc_id"]: r["score"] for r in model.score().collect()}
    whole = plain_counts(texts, 2)
    n, v = model.mixture.tokens, model.mixture.words
    head = next(plain_mix(["w1"], whole, model.mixture.weights, n, v, 2))[0][0]
    total = 0.0
    for k, t in enumerate(probes):
        out = next(plain_mix([t], whole, model.mixture.weights, n, v, 2))
        assert model_rows[1000 + k] == pytest.approx(sum(math.log10(p) for p, _, _ in out), rel=1e-9)
        total += out[1][0]
    assert total == pytest.approx(1.0) and 0 < head < 1


def test_odd_tables(spark):
    big = (1 << 53) + 1
    kind = "doc_id long, text string, score double, key string, train boolean"
    df = spark.createDataFrame([(big, "a b", 1.0, "x", True), (None, "a", 2.0, None, True), (big + 2, None, None, "y", None), (big, "a b", 1.0, "x", True)], kind)
    out = lm_scores.fit(df, F.col("train"), F.lit(False)).score().collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"]) for r in out) == sorted([
        (str(big), 3, 3, 8), ("None", 2, 2, 8), (str(big + 2), 1, 1, 8), (str(big), 3, 3, 8)])
    none = lm_scores.fit(df, F.lit(False), F.lit(False)).score().collect()
    assert {(r["score"], r["base_score"], r["n_known"]) for r in none} == {(0.0, 0.0, 0)}
    assert lm_scores.fit(df.limit(0), F.col("train"), F.lit(True)).score().count() == 0


def test_packed_numbers():
    rng = np.random.default_rng(0)
    for a in ([], [0], [7] * 9, rng.integers(0, 1 << 40, 500), np.array([1 << 63, 3], np.uint64)):
        a = np.array(a, np.uint64)
        assert lm_scores.unpack(lm_scores.pack(a), len(a)).tolist() == a.tolist()
