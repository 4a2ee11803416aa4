"""SimHash, embeddings, substrings and lines against plain versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from pricegrid.llm import embedding_dedup, line_dedup, simhash, substring_dedup
from pricegrid.llm.common import components, table
from tests.conftest import SF
from tests.llm import brute

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows(df):
    return [tuple(r) for r in df.collect()]


def documents(spark):
    return [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]


def words(rng, n, size=300):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def test_components_of_paths_and_stars(spark):
    links = [(k, k + 1) for k in range(100, 140)] + [(500, k) for k in range(501, 560)] + [(559, 100)]
    got = dict(rows(components(spark.createDataFrame(links, "a long, b long"))))
    assert got == {n: 100 for n in [*range(100, 141), *range(500, 560)]}
    assert rows(components(spark.createDataFrame([], "a long, b long"))) == []


def test_simhash_query(spark):
    got = set(rows(entry.queries()["op4_simhash"](spark, SF).select("doc_id", "fingerprint", "component_id")))
    assert got == brute.simhash_rows(documents(spark))


@pytest.mark.parametrize("parts, crowd", [(1, 64), (3, 64), (3, 2), (4, 3)])
def test_ball_links_join_all_close_fingerprints(spark, parts, crowd):
    rng = random.Random(parts)
    fps = {rng.getrandbits(64) for _ in range(40)}
    for base in list(fps)[:12]:
        for _ in range(12):
            fps.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 7))))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = rows(simhash.ball_links(spark.createDataFrame([(f,) for f in signed], "fp long"), 4, parts, crowd))
    close = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 4
    assert all(close(a, b) for a, b in got)
    assert brute.reach(signed, got) == brute.reach(signed, [(a, b) for a in signed for b in signed if a < b and close(a, b)])


def test_simhash_of_odd_rows(spark):
    data = [(3, None), (1, ""), (2, " \t"), (5, "One two"), (4, "one TWO"), (4, "one TWO"), (None, "one two"), (9, "É a b c d")]
    df = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in data], DOCS)
    got = {(d, c) for d, _, c in rows(simhash.near_duplicates(df))}
    assert got == {(3, 1), (1, 1), (2, 1), (5, 4), (4, 4), (None, 4), (9, 9)}
    assert {r["doc_id"] for r in simhash.keep_one(df).collect()} == {1, 4, 9, None}
    assert rows(simhash.near_duplicates(df.limit(0))) == []


def test_simhash_of_long_text():
    text = " ".join(words(random.Random(1), 70_000))
    assert simhash.fingerprint(text) & (1 << 64) - 1 == brute.simhash(text)


def test_embedding_query(spark):
    vectors = rows(table(spark, SF, "embeddings").select("vec_id", "embedding"))
    assert set(rows(entry.queries()["op8_embedding_dedup"](spark, SF))) == brute.vector_rows(vectors)


def test_embeddings_in_clusters_and_odd_rows(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(6, 8))
    data = [(k, [float(x) for x in base[k % 6] + rng.normal(size=8) * rng.choice([0.01, 0.15, 0.4])]) for k in range(300)]
    data += [(1000, None), (1001, [0.0] * 8), (1002, [float("nan")] + [1.0] * 7), (1003, [None] + [1.0] * 7), (1004, [1.0, 2.0]),
             (1005, [2.0, 4.0]), (1006, []), (1007, [1e200] * 8), (1008, [1e-200] * 8)]
    data += [(2000 + k, data[0][1]) for k in range(4)]
    df = spark.createDataFrame([(v, x, 0) for v, x in data], "vec_id long, embedding array<double>, label int")
    expected = brute.vector_rows([(v, [c / 1e200 for c in x] if v == 1007 else [c * 1e200 for c in x] if v == 1008 else x) for v, x in data])
    for options in ({}, {"sample": 20, "block": 32}, {"sample": 300, "block": 16}):
        assert set(rows(embedding_dedup.near_duplicates(df, **options))) == expected
    assert rows(embedding_dedup.near_duplicates(df.limit(0))) == []


def test_tight_clusters_are_linked_in_bulk(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(3, 16))
    data = [(k, [float(x) for x in base[k % 3] + rng.normal(size=16) * 0.002]) for k in range(240)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    assert set(rows(embedding_dedup.near_duplicates(df, block=32))) == brute.vector_rows(data)


def test_nets_halve_and_cover():
    points = np.random.default_rng(2).normal(size=(200, 5))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    centres, parents, radii = embedding_dedup.nets(points, 0.2)
    assert parents[0] == -1 and (np.diff(radii) <= 0).all()
    for k in range(1, len(centres)):
        assert np.linalg.norm(points[centres[k]] - points[centres[parents[k]]]) <= 2 * radii[k] + 1e-9
    gaps = np.linalg.norm(points[:, None] - points[centres][None], axis=2).min(axis=1)
    assert gaps.max() <= 0.2 + 1e-9


@pytest.mark.parametrize("spread", [0.02, 0.3, 2.0])
def test_traversal_meets_every_near_pair_of_leaves_once(spread):
    rng = np.random.default_rng(3)
    points = np.repeat(rng.normal(size=(8, 6)), 25, axis=0) + rng.normal(size=(200, 6)) * spread
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    t = np.sqrt(0.2)
    index, parents, radii = embedding_dedup.nets(points, t / 2)
    centres = points[index]
    leaf = np.repeat(np.arange(len(index)), 2)
    radius = rng.uniform(0, 0.3, len(leaf))
    tree, order = embedding_dedup.cover_tree(centres, parents, radii, leaf, radius)
    assert sorted(order) == list(range(len(leaf)))
    met = [(min(a, b), max(a, b)) for part in embedding_dedup.meetings(tree, centres, np.arange(len(tree.kids)), t) for a, b in zip(*part[:2])]
    apart = np.linalg.norm(centres[leaf][:, None] - centres[leaf][None], axis=2)
    near = apart - radius[:, None] - radius[None, :] <= t
    assert len(met) == len(set(met))
    assert {(a, b) for a, b in zip(*np.nonzero(np.triu(near)))} <= set(met)


def test_substrings_of_mixed_documents(spark):
    rng = random.Random(3)
    passage, other = words(rng, 60), words(rng, 35)
    texts = [" ".join(words(rng, n)) for n in (0, 1, 34, 35, 36, 80, 400)]
    for shift in range(25):
        texts.append(" ".join(words(rng, shift) + passage + words(rng, 3)))
    texts += [" ".join(other), " ".join(["x"] + other), " ".join(other[1:]), " ".join(["a"] * 100), None, "", " \n ", texts[6], texts[6]]
    docs = [(k, t) for k, t in enumerate(texts)] + [(7, texts[9]), (7, texts[9]), (None, "z " + texts[6])]
    df = spark.createDataFrame([(d, t, "x", "y", 1) for d, t in docs], DOCS).repartition(3)
    got = sorted(rows(substring_dedup.remove_repeated(df, digest=True)), key=str)
    assert got == sorted(brute.repeated_windows(docs), key=str)
    assert rows(substring_dedup.remove_repeated(df.limit(0))) == []


def test_difference_cover():
    assert substring_dedup.is_cover(substring_dedup.PERIOD, substring_dedup.COVER)
    assert not substring_dedup.is_cover(21, (0, 1, 2))


@pytest.mark.parametrize("size", [1, 2, 3, 7])
def test_runs_over_batch_borders(size):
    import pandas as pd

    h = [1, 2, 2, 3, 3, 3, 3, 3, 4, 5, 5, 6]
    frame = pd.DataFrame({"row": range(12), "at": range(12), "h": h, "x": 0, "met": [False] * 9 + [False, True, True], "lone": [False] * 10 + [True, True]})
    got = pd.concat(list(substring_dedup._met(frame.iloc[k : k + size].reset_index(drop=True) for k in range(0, 12, size))))
    assert sorted(got["row"]) == [1, 2, 3, 4, 5, 6, 7, 10, 11]


def lines_of(spark, docs):
    df = spark.createDataFrame([(d, t, "x", "y", 1) for d, t in docs], DOCS).repartition(3)
    return line_dedup.dedup_lines(df)


def test_lines_with_edits(spark):
    rng = random.Random(4)
    lines = [words(rng, rng.randrange(1, 16), 60) for _ in range(60)]
    for _ in range(150):
        w = list(rng.choice(lines))
        k = rng.randrange(len(w))
        change = rng.randrange(4)
        if change == 0:
            w[k] = "new"
        elif change == 1 and len(w) > 1:
            del w[k]
        elif change == 2:
            w.insert(k, "new")
        lines.append(w)
    rng.shuffle(lines)
    joined = [rng.choice([" ", "  ", "\t"]).join(w) if rng.random() < 0.3 else " ".join(w).upper() for w in lines]
    docs = [(k, "\n".join([*joined[k * 5 : k * 5 + 5], "", "  "])) for k in range(len(joined) // 5)]
    docs += [(900, None), (901, ""), (902, "\n\n"), (903, docs[0][1]), (904, docs[1][1] + "\r")]
    got = {r["doc_id"]: r["text"] for r in lines_of(spark, docs).collect()}
    assert got == brute.line_dedup(docs)


def test_lines_of_odd_tables(spark):
    same = "one two three four five six seven eight nine"
    got = rows(lines_of(spark, [(None, same), (4, same), (4, same), (5, same + " ten\n" + same[:-5])]).select("doc_id", "text", "n_lines", "n_removed"))
    assert sorted(got, key=str) == sorted([(None, "", 1, 1), (4, same, 1, 0), (4, same, 1, 0), (5, "", 2, 2)], key=str)
    assert rows(line_dedup.dedup_lines(spark.createDataFrame([], DOCS))) == []
    clash = spark.createDataFrame([(1, "a\na", 7, 8, 9)], "doc_id long, text string, n_lines int, key int, line int")
    assert line_dedup.dedup_lines(clash).select("text", "n_lines", "key", "line").collect()[0][:] == ("a", 2, 8, 9)


def test_line_plan_has_no_python(spark):
    df = line_dedup.dedup_lines(table(spark, SF, "documents"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert df.where(F.col("n_removed") > 0).count() > 0
