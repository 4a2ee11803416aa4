"""Embedding near-duplicates: all pairs with cosine >= threshold, by a cover tree.

On unit vectors cosine >= c is distance <= sqrt(2 - 2c) = t. Nets with halving
radii are laid over a sample of at most SAMPLE vectors: every level's centres
lie further apart than its radius, and each new centre's parent is the nearest
centre of the coarser levels, which covers it. Every vector goes down to a
centre, and in it to the shell whose radius (halving from 2 down to t/2) its
distance falls in; a centre's shell is a leaf with the true covering radius of
its members, and covering radii are summed up from level to level. The sample
steers only the speed.

The dual traversal meets every two leaves once, below the node where their ways
part: a pair of nodes further apart than t plus both radii is pruned with all
that lies below it, else the wider node is opened. Of the leaf pairs left, those
whose distance plus both radii is at most t are linked without comparing any
member; the others are compared. The traversal runs in tasks, dealt by tree
edge, and its pairs stay in a table. Leaves are cut or packed, in the order of
the tree, into blocks of at most BLOCK vectors, and two blocks are compared as
one matrix product in double precision, so no pair of vectors ever becomes a
row: a block pair gives link counts and a spanning forest.

Equal vectors are one class with a weight. A vector that is null, zero or has
null or non-finite components links with nothing.
"""

from __future__ import annotations

from collections import namedtuple

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from pricegrid.llm.common import components, ranges
from pricegrid.session import stage

SAMPLE = 2048
BLOCK = 4096
PORTION = 1 << 16  # node pairs handled at once
SLACK = 1e-7  # bounds are kept this far from the threshold; pairs inside are compared


def unit(vectors):
    x = np.stack(vectors.to_numpy()).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # squares of very large or small components stay finite
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def nets(points, smallest):
    """Centres of nested nets with radii 2, 1, 1/2, ... down to `smallest`.

    Returns (index of the point, parent centre, radius) in level order; a point
    that is a centre stays one on all finer levels and is listed once.
    """
    centres, parents, radii, radius = [], [], [], 2.0
    nearest = np.full(len(points), np.inf)
    owner = np.zeros(len(points), int)
    while True:
        coarser = owner.copy()
        for k in np.argsort(-nearest, kind="stable"):
            if nearest[k] > radius:
                parents.append(int(coarser[k]) if centres else -1)
                centres.append(int(k))
                radii.append(radius)
                d = np.sqrt(np.clip(2 - 2 * points @ points[k], 0, 4))
                closer = d < nearest
                nearest[closer], owner[closer] = d[closer], len(centres) - 1
        if radius <= smallest:
            return np.array(centres, int), np.array(parents, int), np.array(radii)
        radius = max(radius / 2, smallest)


#: Nodes 0 to leaves - 1 are leaves. A node has a centre and a covering radius;
#: node x >= leaves has the children kids[first[x - leaves]:first[x - leaves + 1]].
Tree = namedtuple("Tree", "leaves centre cover first kids")


def cover_tree(points, parents, radii, leaf_centre, leaf_radius):
    """The tree over leaves given by centre and radius, and the leaves' order in it.

    A centre is a node on its own level and on all finer ones; its children are
    itself and the centres it is parent of, one level down, and on the last level
    its leaves. Nodes without leaves below are left out; the root comes last.
    """
    levels = np.unique(radii)[::-1]
    level = np.searchsorted(-levels, -radii)
    centre, cover, kids = leaf_centre.tolist(), leaf_radius.tolist(), []
    below = [[] for _ in radii]  # nodes of the finer level, by the centre above
    for leaf, k in enumerate(centre):
        below[k].append(leaf)
    for depth in range(len(levels) - 1, -1, -1):
        up = [[] for _ in radii]
        for k in np.flatnonzero(level <= depth):
            if below[k]:
                d = np.linalg.norm(points[[centre[x] for x in below[k]]] - points[k], axis=1)
                up[k if level[k] < depth or depth == 0 else parents[k]].append(len(centre))
                centre.append(int(k))
                cover.append(min(2.0, float((d + [cover[x] for x in below[k]]).max()) + SLACK))
                kids.append(below[k])
        below = up
    order, waiting, leaves = [], [len(centre) - 1], len(leaf_centre)
    while waiting:
        x = waiting.pop()
        if x < leaves:
            order.append(x)
        else:
            waiting.extend(kids[x - leaves])
    first = np.concatenate([[0], np.cumsum([len(k) for k in kids])]).astype(np.int64)
    return Tree(leaves, np.array(centre), np.array(cover), first, np.concatenate(kids).astype(np.int64)), np.array(order)


def meetings(tree, points, edges, t):
    """(a, b, whole) of the leaf pairs that are not pruned, in portions.

    Every edge stands for its child met with the children after it under the
    same parent, and a leaf also for itself, so all edges together meet every
    two leaves once. whole: all members of both leaves lie within t.
    """
    ends = np.repeat(tree.first[1:], np.diff(tree.first))[edges]
    start = np.where(tree.kids[edges] < tree.leaves, edges, edges + 1)
    waiting = [(np.repeat(tree.kids[edges], ends - start), tree.kids[ranges(start, ends - start)])]
    while waiting:
        a, b = waiting.pop()
        if len(a) > PORTION:
            waiting.extend((a[k : k + PORTION], b[k : k + PORTION]) for k in range(0, len(a), PORTION))
            continue
        apart = np.sqrt(np.clip(2 - 2 * np.einsum("ij,ij->i", points[tree.centre[a]], points[tree.centre[b]]), 0, 4))
        apart[tree.centre[a] == tree.centre[b]] = 0
        reach = tree.cover[a] + tree.cover[b]
        near = apart - reach <= t + SLACK
        a, b, whole = a[near], b[near], (apart + reach <= t - SLACK)[near]
        done = (a < tree.leaves) & (b < tree.leaves)
        if done.any():
            yield a[done], b[done], whole[done]
        a, b = a[~done], b[~done]
        if len(a):
            other = (a < tree.leaves) | ((b >= tree.leaves) & (tree.cover[b] > tree.cover[a]))
            x, y = np.where(other, b, a), np.where(other, a, b)
            begin = tree.first[x - tree.leaves]
            count = tree.first[x - tree.leaves + 1] - begin
            if count.sum() > 4 * PORTION and len(x) > 1:
                half = len(x) // 2
                waiting += [(x[:half], y[:half]), (x[half:], y[half:])]
            else:
                waiting.append((tree.kids[ranges(begin, count)], np.repeat(y, count)))


def forest(i, j, n):
    """A spanning forest (pairs of indices) of the links i-j over n points."""
    low = np.arange(n)
    while True:
        a, b = low[i], low[j]
        move = a != b
        if not move.any():
            break
        np.minimum.at(low, np.maximum(a, b)[move], np.minimum(a, b)[move])
        while (low[low] != low).any():
            low = low[low]
    k = np.flatnonzero(low != np.arange(n))
    return k, low[k]


def links(classes, threshold=0.9, sample=SAMPLE, block=BLOCK):
    """Link counts and connecting links of distinct vectors.

    classes: id, weight, v (array of numbers, all valid). Returns two tables:
    (id, n) with the weight of all other classes linked to a class, and (a, b).
    """
    spark = classes.sparkSession
    t = float(np.sqrt(2 - 2 * threshold))
    some = classes.orderBy(F.xxhash64("id")).limit(sample).select("v").toPandas()
    if not len(some):
        return spark.createDataFrame([], "id long, n long"), spark.createDataFrame([], "a long, b long")
    points = unit(some["v"])
    centres, parents, radii = nets(points, t / 2)
    held = spark.sparkContext.broadcast(points[centres])
    shells = [t / 2]
    while shells[-1] < 2:
        shells.append(shells[-1] * 2)

    def descend(batches):
        for batch in batches:
            if len(batch):
                x = unit(batch["v"])
                centre = (x @ held.value.T).argmax(axis=1)
                d = np.linalg.norm(x - held.value[centre], axis=1)
                yield batch.assign(node=centre * 64 + np.searchsorted(shells, d), d=d)

    kind = classes.select("*").schema.add("node", "long").add("d", "double")
    placed = stage(classes.mapInPandas(descend, kind), "cover-nodes")
    nodes = placed.groupBy("node").agg(
        F.count("*").alias("n"), F.sum("weight").alias("w"), F.max("d").alias("r"), F.min("id").alias("low")
    ).toPandas().sort_values("node").reset_index(drop=True)  # at most SAMPLE centres x 6 shells

    tree, order = cover_tree(held.value, parents, radii, nodes["node"].to_numpy() // 64, nodes["r"].to_numpy())

    # Blocks: a large leaf is cut into parts, small leaves are packed together in
    # tree order; a leaf whose members all link stays alone so that it can be skipped.
    n, tight = nodes["n"].to_numpy(), 2 * nodes["r"].to_numpy() <= t - SLACK
    group, size, alone, at = np.zeros(len(n), int), 0, False, 0
    for step, k in enumerate(order):
        single = n[k] >= block or (tight[k] and n[k] >= 64)
        if step and (single or alone or size + n[k] > block):
            at, size = at + 1, 0
        group[k], size, alone = at, size + n[k], single
    nodes["g"] = group
    blocks = nodes.groupby("g").agg(leaves=("n", "size"), n=("n", "sum"), w=("w", "sum"), low=("low", "min")).reset_index()
    blocks["parts"] = np.maximum(1, -(-blocks["n"] // block))
    blocks = spark.createDataFrame(blocks)  # at most the leaves, as are all tables made of them

    walked = spark.sparkContext.broadcast((tree, group))

    def traverse(batches):
        tree, group = walked.value
        for batch in batches:
            edges = batch["id"].to_numpy()
            for k in range(0, len(edges), 64):
                for a, b, whole in meetings(tree, held.value, edges[k : k + 64], t):
                    ga, gb = np.minimum(group[a], group[b]), np.maximum(group[a], group[b])
                    met = pd.DataFrame({"ga": ga, "gb": gb, "n": 1, "whole": whole.astype(np.int64)})
                    yield met.groupby(["ga", "gb"], as_index=False).sum()

    edges = spark.range(len(tree.kids)).repartition(int(min(len(tree.kids), 64)), "id")
    pairs = edges.mapInPandas(traverse, "ga long, gb long, n long, whole long").groupBy("ga", "gb").agg(F.sum("n").alias("n"), F.sum("whole").alias("whole"))
    side = lambda s: blocks.select(F.col("g").alias(f"g{s}"), *[F.col(c).alias(c + s) for c in ("leaves", "w", "low", "parts")])
    pairs = pairs.join(side("a"), "ga").join(side("b"), "gb")
    every = F.when(F.col("ga") == F.col("gb"), F.expr("leavesa * (leavesa + 1) / 2")).otherwise(F.expr("leavesa * leavesb"))
    pairs = stage(pairs.withColumn("bulk", F.col("whole") == every), "cover-pairs")

    member = F.broadcast(spark.createDataFrame(nodes[["node", "g"]]).join(blocks.select("g", "parts"), "g"))
    cut = placed.join(member, "node").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    cut = stage(cut.select("id", "weight", "v", "g", "part"), "cover-blocks")

    asked = pairs.where("not bulk").select("ga", "gb", "partsb", F.explode(F.expr("sequence(0L, partsa - 1)")).alias("xa"))
    asked = asked.select("ga", "gb", "xa", F.explode(F.expr("sequence(0L, partsb - 1)")).alias("xb")).where("ga <> gb or xa <= xb")
    sides = asked.select(
        "ga", "gb", "xa", "xb",
        F.explode(F.array(
            F.struct(F.lit(0).alias("side"), F.col("ga").alias("g"), F.col("xa").alias("part")),
            F.struct(F.lit(1).alias("side"), F.col("gb").alias("g"), F.col("xb").alias("part")),
        )).alias("s"),
    ).select("ga", "gb", "xa", "xb", "s.*").dropDuplicates(["ga", "gb", "xa", "xb", "g", "part"])
    dealt = cut.join(sides, ["g", "part"])

    def compare(batch):
        x, w, ids = unit(batch["v"]), batch["weight"].to_numpy(), batch["id"].to_numpy()
        side = batch["side"].to_numpy()
        inner = side.min() == side.max()
        first = np.flatnonzero(side == side.min())
        other = first if inner else np.flatnonzero(side == 1)
        total, fi, fj = np.zeros(len(x), np.int64), [], []
        for k in range(0, len(first), 512):
            rows = first[k : k + 512]
            near = x[rows] @ x[other].T >= threshold
            if inner:
                near[np.arange(len(rows)), np.arange(k, k + len(rows))] = False
            i, j = np.nonzero(near)
            if len(i):
                np.add.at(total, rows[i], w[other[j]])
                if not inner:
                    np.add.at(total, other[j], w[rows[i]])
                a, b = forest(rows[i], other[j], len(x))
                fi.append(a)
                fj.append(b)
        hit = np.flatnonzero(total)
        out = [pd.DataFrame({"a": ids[hit], "b": 0, "n": total[hit]})]
        if fi:
            a, b = forest(np.concatenate(fi), np.concatenate(fj), len(x))
            out.append(pd.DataFrame({"a": ids[a], "b": ids[b], "n": 0}))
        return pd.concat(out).astype("int64")

    met = dealt.groupBy("ga", "gb", "xa", "xb").applyInPandas(compare, "a long, b long, n long")
    met = stage(met, "cover-links")

    # Bulk pairs: counted by weight. All members of a block link to all of a bulk
    # partner, so the smallest member of one partner is their hub.
    bulk = pairs.where("bulk")
    both = bulk.select(F.col("ga").alias("g"), F.col("wb").alias("w"), F.col("lowb").alias("hub"), (F.col("ga") == F.col("gb")).alias("own")).unionByName(
        bulk.where("ga <> gb").select(F.col("gb").alias("g"), F.col("wa").alias("w"), F.col("lowa").alias("hub"), F.lit(False).alias("own"))
    )
    both = F.broadcast(both.groupBy("g").agg(F.sum("w").alias("extra"), F.min("hub").alias("hub"), F.bool_or("own").alias("own")))
    linked = cut.select("id", "weight", "g").join(both, "g")
    n_links = met.where("n > 0").select(F.col("a").alias("id"), "n").unionByName(
        linked.select("id", (F.col("extra") - F.when(F.col("own"), F.col("weight")).otherwise(0)).alias("n"))
    )
    edges = met.where("n = 0").select("a", "b")
    edges = edges.unionByName(linked.select(F.col("hub").alias("a"), F.col("id").alias("b")))
    edges = edges.unionByName(bulk.select(F.col("lowa").alias("a"), F.col("lowb").alias("b"))).where("a <> b")
    return n_links.groupBy("id").agg(F.sum("n").alias("n")), edges.distinct()


def near_duplicates(vectors, key="vec_id", vector="embedding", threshold=0.9, **options):
    """One row per vector: key, n_links, component_id, kept.

    Vectors of different length never link. Rows without a key count as vectors;
    their component_id is the smallest key reachable, null if there is none, and
    they are not kept where it is another. Other columns are dropped.
    """
    floats = dict(vectors.dtypes)[vector] in ("array<float>", "array<double>")
    column = F.col(vector) if floats else F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).alias("k"), column.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = F.coalesce(F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("ok", valid).withColumn(
        "h", F.when(F.col("ok"), F.struct(F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(7), F.reverse("v")).alias("h2")))
    )
    groups = rows.where("ok").groupBy("h").agg(F.count("*").alias("weight"), F.min("k").alias("low"), F.first("v").alias("v"))
    groups = groups.withColumn("id", F.xxhash64("h.h1", "h.h2"))
    groups = stage(groups, "vector-classes")
    lengths = [r[0] for r in groups.select(F.size("v")).distinct().collect()]
    counted, edges = None, None
    for length in sorted(lengths):
        n, e = links(groups.where(F.size("v") == length).select("id", "weight", "v"), threshold, **options)
        counted = n if counted is None else counted.unionByName(n)
        edges = e if edges is None else edges.unionByName(e)
    out = rows.select("k", "ok", "h")
    if counted is None:
        out = out.select("k", F.lit(0).cast("long").alias("n_links"), F.col("k").alias("component_id"))
    else:
        classes = groups.select("h", "id", "weight", "low").join(counted, "id", "left")
        classes = classes.join(components(edges).withColumnRenamed("node", "id"), "id", "left")
        classes = classes.withColumn("component", F.coalesce("component", "id"))
        lows = classes.groupBy("component").agg(F.min("low").alias("c"))
        classes = classes.join(lows, "component").select(
            F.col("h").alias("ch"), "c", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n")
        )
        out = out.join(classes, F.col("h") == F.col("ch"), "left").select(
            "k", F.coalesce("n", F.lit(0)).alias("n_links"), F.when(F.col("ok"), F.col("c")).otherwise(F.col("k")).alias("component_id")
        )
    return out.select(
        F.col("k").alias(key), "n_links", "component_id", F.coalesce(F.col("k") == F.col("component_id"), F.lit(False)).alias("kept")
    )
