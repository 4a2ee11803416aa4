"""Periodic runs and the Merkle manifest against plain versions."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from pricegrid.llm import merkle_manifest, periodic_runs
from pricegrid.llm.common import table
from tests.conftest import SF
from tests.llm import brute


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Periodic runs


def plain_runs(w, min_length=24, repeats=3):
    """(start, length, period) of every run, by comparing all places p apart."""
    found = {}
    for p in range(1, len(w) // repeats + 1):
        i = 0
        while i + p < len(w):
            k = i
            while k + p < len(w) and w[k] == w[k + p]:
                k += 1
            if k > i and k - i + p >= max(min_length, repeats * p):
                found.setdefault((i, k - i + p), p)
            i = max(k, i + 1)
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def plain_collapse(w, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def periodic_words(rng):
    w = []
    for _ in range(rng.randrange(1, 8)):
        unit = [f"x{rng.randrange(rng.choice([1, 2, 3, 30]))}" for _ in range(rng.randrange(1, 14))]
        w += (unit * rng.randrange(1, 14))[: rng.randrange(1, 160)]
        w += [f"y{rng.randrange(40)}" for _ in range(rng.randrange(0, 6))]
    return w


@pytest.mark.parametrize("min_length, repeats", [(24, 3), (4, 2), (1, 2), (9, 4)])
def test_runs_of_many_texts_equal_plain_ones(min_length, repeats):
    rng = random.Random(min_length)
    texts = [periodic_words(rng) for _ in range(120)] + [[], ["a"], ["a"] * 500, ["a", "b"] * 300 + ["a"]]
    # Fibonacci word: runs nested in many sizes.
    a, b = ["a"], ["a", "b"]
    while len(b) < 400:
        a, b = b, b + a
    texts += [b, b + ["z"] + b, ["q"] + a * 6]
    for w, (n, runs, left) in zip(texts, periodic_runs.runs_of([" ".join(w) for w in texts], min_length, repeats)):
        expected = plain_runs(w, min_length, repeats)
        assert n == len(w) and runs == expected
        assert left == plain_collapse(w, expected)


def test_extensions_are_exact():
    rng = np.random.default_rng(3)
    for size, kinds in ((50, 2), (400, 2), (400, 3), (3000, 40)):
        seq = rng.integers(0, kinds, size)
        seq[size // 2 :] = seq[: size - size // 2]
        seq = np.concatenate([[kinds], seq, [kinds + 1]])
        levels = periodic_runs.recompress(seq)
        x = rng.integers(1, size, 500)
        y = np.where(rng.random(500) < 0.5, x + size // 2, rng.integers(1, size, 500))
        keep = (y <= size) & (x < y)
        x, y = x[keep], y[keep]

        def plain(s, i, j):
            n = 0
            while j + n < len(s) and s[i + n] == s[j + n]:
                n += 1
            return n

        assert periodic_runs.extensions(levels, x, y).tolist() == [plain(seq, i, j) for i, j in zip(x, y)]
        back, n = seq[::-1], len(seq)
        got = periodic_runs.extensions(periodic_runs.mirrored(levels), n - y, n - x)
        assert got.tolist() == [plain(back, n - j, n - i) for i, j in zip(x, y)]


def test_periodic_query(spark):
    got = {r["doc_id"]: tuple(r)[1:] for r in entry.queries()["op11_periodic_runs"](spark, SF).collect()}
    docs = table(spark, SF, "documents").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    some = 0
    for doc, text in docs:
        w, h = brute.words(text), zlib.crc32(str(doc).encode())
        g, n = h // 10, len(brute.words(text))
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        runs = plain_runs(w) if n < 900 else None
        if runs is None:
            continue
        best = None
        for s, length, p in runs:
            if best is None or length * best[2] > best[1] * p:
                best = s, length, p
        head = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        some += best is not None
        assert got[doc] == (len(runs), *head, sha("".join(f"{s},{m},{p}\n" for s, m, p in runs)), sha(plain_collapse(w, runs)))
    assert some > 5


def test_periodic_odd_rows(spark):
    big = (1 << 53) + 1
    rows = [(big, None, 1, 5), (None, "", None, 6), (big + 2, " \t", 2, None), (7, "a " * 100, 3, 1), (7, "a " * 100, 3, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words long, extra long")
    got = sorted(((r["doc_id"], r["n_words"], r["extra"], r["collapsed"], [tuple(x) for x in r["runs"]]) for r in periodic_runs.periodic_runs(df).collect()), key=str)
    assert got == sorted([(big, 0, 5, "", []), (None, 0, 6, "", []), (big + 2, 0, None, "", []), (7, 100, 1, "a", [(0, 100, 1)]), (7, 100, 1, "a", [(0, 100, 1)])], key=str)
    assert periodic_runs.periodic_runs(df.limit(0)).count() == 0


def test_periodic_long_text():
    unit = [f"w{k}" for k in range(40_000)]
    w = ["head"] + unit * 5 + ["tail", "tail"]
    assert list(periodic_runs.runs_of([" ".join(w), "one two"])) == [
        (200_003, [(1, 200_000, 40_000)], " ".join(["head", *unit, "tail", "tail"])), (2, [], "one two"),
    ]


# Merkle manifest


def plain_tree(leaves):
    """Root and, per leaf, (before, after) digests of every run up to it."""
    paths, at, row = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(row) > 1:
        for k, place in enumerate(at):
            first = place // 3 * 3
            paths[k].append((row[first:place], row[place + 1 : first + 3]))
            at[k] = place // 3
        row = [sha("".join(row[k : k + 3])) for k in range(0, len(row), 3)]
    return row[0], paths


def plain_manifest(rows):
    """rows: (source, doc_id, values in order, values of the altered copy)."""
    hashed = lambda values: sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))
    groups = {}
    for source, doc, values, altered in rows:
        groups.setdefault(source, []).append((doc is not None, doc or 0, hashed(values), hashed(altered), doc))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([r[2] for r in sorted(groups[s], key=lambda r: r[:3])]) for s in names}
    if not names:
        return []
    root, upper = plain_tree([trees[s][0] for s in names])
    out = []
    for s, above in zip(names, upper):
        for (_, _, leaf, bent, doc), path in zip(sorted(groups[s], key=lambda r: r[:3]), trees[s][1]):
            whole, folded = path + above, bent
            for before, after in whole:
                folded = sha("".join([*before, folded, *after]))
            out.append((doc, leaf, trees[s][0], root, sha("".join("".join(b + a) for b, a in whole)), folded, folded == root))
    return sorted(out, key=str)


def altered(doc, text):
    return text.replace("\n", "") if doc is not None and text is not None and zlib.crc32(str(doc).encode()) % 2 == 0 else text


def test_merkle_query(spark):
    docs = table(spark, SF, "documents").select("doc_id", "source", "lang", "n_chars", "text").collect()
    rows = [(s, d, (d, s, g, n, t), (d, s, g, n, altered(d, t))) for d, s, g, n, t in docs]
    got = sorted((tuple(r) for r in entry.queries()["op13_merkle_manifest"](spark, SF).collect()), key=str)
    assert got == plain_manifest(rows)
    assert {r[6] for r in got} == {True, False}


def test_merkle_of_many_and_odd_rows(spark):
    rng = random.Random(2)
    big = (1 << 53) + 1
    rows = [(k, "hot", f"t{k}\n") for k in rng.sample(range(-70_000, 140_000), 2300)]
    rows += [(k, "lone", None) for k in (5,)] + [(k * 10**14, "wide", "x") for k in range(-3, 4)]
    rows += [(None, None, "a"), (None, None, "a"), (None, None, "b"), (big, None, ""), (big + 2, "", "é\n"), (None, "", None)]
    rows += [(9, "twice", "x\n"), (9, "twice", "x\n"), (9, "twice", "y"), (9, "twice", None), (10, "twice", "z"), (8, "twice", "z")]
    df = spark.createDataFrame([(d, s, t, d, "p") for d, s, t in rows], "doc_id long, source string, text string, r long, root string")
    bent = F.when(F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False)), F.translate("text", "\n", "")).otherwise(F.col("text"))
    got = merkle_manifest.manifest(df, ["doc_id", "text"], tampered={"text": bent})
    expected = plain_manifest([(s, d, (d, t), (d, altered(d, t))) for d, s, t in rows])
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected
    same = merkle_manifest.manifest(df.select("doc_id", "source", "text"), ["doc_id", "text"]).collect()
    assert all(r["verified"] for r in same) and {r["root"] for r in same} == {r[3] for r in expected}
    assert merkle_manifest.manifest(df.limit(0), ["doc_id", "text"]).count() == 0
    with pytest.raises(ValueError):
        merkle_manifest.manifest(df.withColumn("doc_id", F.col("text")), ["text"])


def test_bitmaps_of_all_densities():
    rng = np.random.default_rng(1)
    for count in (1, 7, 4096, 4097, 40_000, 65_536):
        lows = np.sort(rng.choice(65_536, count, replace=False))
        data = merkle_manifest.pack_bitmap(lows)
        assert len(data) == min(2 * count, 8192)
        assert merkle_manifest.bitmap_ranks(merkle_manifest.unpack_bitmap(data), lows).tolist() == list(range(count))
