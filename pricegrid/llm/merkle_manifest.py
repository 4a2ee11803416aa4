"""Merkle dataset manifest: leaf coordinates from bitmap ranks, levels by slot arrays.

Every row is hashed to a leaf in the JVM. Tasks gather the ids of each group in
compressed bitmaps of 65 536 ids (two bytes an id while sparse, one bit an id when
dense); bitmaps of equal range are merged, and a running sum of their sizes is the
directory. The coordinate of a leaf is its bitmap's entry in the directory plus
the number of set bits below it, so the leaves themselves are never sorted. Nodes
are then dealt by (tree, coordinate div 3^6); each such block is an array of at
most 729 slots, filled by slot number, in which six levels are hashed. Blocks
repeat on their own results until one node a tree is left; the groups' roots are
the leaves of one more tree. Paths to the root run down the same blocks. No step
holds more than a block or a bitmap of a group, however large the group is.

Defined results: a null group is a group of its own and comes first, rows without
id come before the others of their group, by leaf (the first digits of the leaf
serve as their id, so they spread over many bitmaps); rows with equal group and id
are ordered by their leaves and ranked together, and equal rows are leaves of their
own, counted before they are dealt out. Ids must be integers. An empty table gives no rows. Extra
columns are neither hashed nor returned; only the named columns are read.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricegrid.session import stage

ARITY = 3
DEPTH = 6  # levels hashed in one block
SPAN = ARITY**DEPTH
SPARSE = 4095  # up to so many ids a bitmap is a list of its set places, below the 8 192 bytes of a dense one
NO_ID = -(1 << 47) - (1 << 20)  # first range of rows without id, before all others


def field(column):
    """`-` if null, else the UTF-8 byte count, a colon and the value."""
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(columns):
    """Lowercase hex SHA-256 of the columns' fields."""
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def _digest(parts):
    return sha256("".join(parts).encode()).hexdigest()


# Bitmaps


def pack_bitmap(lows):
    """Compressed bitmap of sorted distinct numbers below 65 536."""
    if len(lows) <= SPARSE:
        return lows.astype("<u2").tobytes()
    bits = np.zeros(1 << 16, np.uint8)
    bits[lows] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def unpack_bitmap(data):
    """Its 1 024 words of 64 bits."""
    if len(data) == 8192:
        return np.frombuffer(data, "<u8")
    bits = np.zeros(1 << 16, np.uint8)
    bits[np.frombuffer(data, "<u2")] = 1
    return np.packbits(bits, bitorder="little").view("<u8")


def bitmap_ranks(words, lows):
    """How many bits are set below each place, by a directory of word counts."""
    counts = np.bitwise_count(words).astype(np.int64)
    before = np.cumsum(counts) - counts
    mask = (np.uint64(1) << (lows & 63).astype(np.uint64)) - np.uint64(1)
    return before[lows >> 6] + np.bitwise_count(words[lows >> 6] & mask)


def _partial_bitmaps(batches):
    """One compressed bitmap per task, group and range of ids."""
    held = {}
    for batch in batches:
        tree = batch.column("tree").dictionary_encode()
        names, codes = tree.dictionary.to_pylist(), tree.indices.to_numpy()
        hi, lo = batch.column("hi").to_numpy(), batch.column("lo").to_numpy()
        order = np.lexsort((lo, hi, codes))
        codes, hi, lo = codes[order], hi[order], lo[order]
        cut = np.flatnonzero((codes[1:] != codes[:-1]) | (hi[1:] != hi[:-1])) + 1
        for part in np.split(np.arange(len(codes)), cut):
            if len(part):
                key = names[codes[part[0]]], int(hi[part[0]])
                held.setdefault(key, []).append(lo[part].astype(np.uint16))
    held = list(held.items())
    for first in range(0, len(held), 4096):
        some = held[first : first + 4096]
        yield pa.RecordBatch.from_pydict({
            "tree": [k[0] for k, _ in some], "hi": [k[1] for k, _ in some],
            "ids": [pack_bitmap(np.unique(np.concatenate(v))) for _, v in some],
        })


def _merge_bitmaps(table):
    words = np.zeros(1024, np.uint64)
    for data in table.column("ids").to_pylist():
        words |= unpack_bitmap(data)
    places = np.flatnonzero(np.unpackbits(words.view(np.uint8), bitorder="little"))
    return pa.table({"tree": table.column("tree").slice(0, 1), "hi": table.column("hi").slice(0, 1),
                     "ids": [pack_bitmap(places)], "members": pa.array([len(places)], pa.int64())})


def bitmaps(leaves):
    """Merged bitmaps of (tree, hi, lo) rows with the number of members."""
    parts = leaves.select("tree", "hi", "lo").mapInArrow(_partial_bitmaps, "tree string, hi long, ids binary")
    return parts.groupBy("tree", "hi").applyInArrow(_merge_bitmaps, "tree string, hi long, ids binary, members long")


def running(rows, key, order, size, out):
    """Sum of `size` over the earlier rows of `key` by `order`: ranges of rows are
    summed by themselves, then the ranges; neither holds more than a range."""
    dealt = stage(rows.repartitionByRange(key, order).withColumn("part", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy(key, "part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy(key, "part").agg(F.sum(size).alias("whole"))
    sums = sums.select(key, "part", F.coalesce(F.sum("whole").over(before), F.lit(0)).alias("earlier"),
                       F.sum("whole").over(Window.partitionBy(key)).alias("n"))
    local = dealt.withColumn("here", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    return local.join(sums, [key, "part"]).withColumn(out, F.col("here") + F.col("earlier")).drop("here", "earlier", "part")


def _ranked(leaves, maps):
    """The leaves of a bitmap's range with their coordinates."""
    if not maps.num_rows or not leaves.num_rows:
        return leaves.schema.empty_table().append_column("r", pa.array([], pa.int64())).append_column("n", pa.array([], pa.int64()))
    lows = leaves.column("lo").to_numpy().astype(np.int64)
    ranks = bitmap_ranks(unpack_bitmap(maps.column("ids")[0].as_py()), lows)
    copies = leaves.column("copies").to_numpy()
    r = ranks.copy()
    if copies.max() > 1 or len(np.unique(ranks)) < len(ranks):
        # Rows beyond the first of an id push all later ones on.
        order = np.lexsort((np.array(leaves.column("leaf").to_pylist()), ranks))
        r[order] = np.cumsum(copies[order]) - copies[order]
    r += maps.column("base")[0].as_py()
    return leaves.append_column("r", pa.array(r)).append_column("n", pa.array(np.full(len(r), maps.column("n")[0].as_py())))


def coordinates(leaves):
    """Leaves (tree, hi, lo, id, leaf, bent, copies) with their place r of n in
    their tree, one row for each copy."""
    sizes = leaves.groupBy("tree", "hi").agg(F.sum("copies").alias("rows"))
    maps = bitmaps(leaves).join(sizes, ["tree", "hi"])
    maps = running(maps, "tree", "hi", "rows", "base").select("tree", "hi", "ids", "base", "n")
    schema = T.StructType([*leaves.schema]).add("r", "long").add("n", "long")
    placed = leaves.groupBy("tree", "hi").cogroup(maps.groupBy("tree", "hi")).applyInArrow(_ranked, schema)
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    return placed.withColumn("copy", copies).withColumn("r", F.col("r") + F.col("copy")).drop("copy", "copies", "hi", "lo")


# Trees


def _levels(digests, n):
    """Levels of a block, lowest first: up to DEPTH while the tree of n nodes has several."""
    levels = [digests]
    while n > 1 and len(levels) <= DEPTH:
        row = levels[-1]
        levels.append([_digest(row[k : k + ARITY]) for k in range(0, len(row), ARITY)])
        n = -(-n // ARITY)
    return levels


def _slots(row):
    """The nodes of a block in an array by slot."""
    out = [None] * len(row["nodes"])
    for node in row["nodes"]:
        out[node["r"] % SPAN] = node
    return out


def _blocks(nodes):
    """Nodes (tree, n, r, leaf, ...) dealt to arrays of SPAN slots."""
    rest = [c for c in nodes.columns if c not in ("tree", "n")]
    block = F.floor(F.col("r") / SPAN).cast("long").alias("block")
    return nodes.groupBy("tree", "n", block).agg(F.collect_list(F.struct(*rest)).alias("nodes"))


def _tops(blocks):
    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            top = [_levels([x["leaf"] for x in _slots(row)], row["n"])[-1][0] for row in rows]
            yield pa.RecordBatch.from_pydict({
                "tree": pa.array([row["tree"] for row in rows], pa.string()),
                "n": pa.array([-(-row["n"] // SPAN) for row in rows], pa.int64()),
                "r": pa.array([row["block"] for row in rows], pa.int64()), "leaf": pa.array(top, pa.string()),
            })

    return blocks.mapInArrow(run, "tree string, n long, r long, leaf string")


def climb(nodes):
    """Blocks of every step, lowest first, and the roots (tree, leaf)."""
    steps, current = [], nodes
    while True:
        steps.append(stage(_blocks(current), "merkle"))
        current = _tops(steps[-1])
        if not steps[-1].where(F.col("n") > SPAN).limit(1).count():
            return steps, current.select("tree", "leaf")


def _steps(levels, slot):
    """Siblings of a slot at every level, as text before and after the node."""
    out = []
    for row in levels[:-1]:
        first = slot // ARITY * ARITY
        run = row[first : first + ARITY]
        out.append("".join(run[: slot - first]) + "|" + "".join(run[slot - first + 1 :]))
        slot //= ARITY
    return out


def _descend(blocks, paths, kept):
    """Every node of the blocks with its path to the root.

    `paths` gives (tree, block, path, root) per block; `kept` names the columns
    of the nodes to return, with their types.
    """
    names = [c.split()[0] for c in kept]

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                nodes = _slots(row)
                levels = _levels([x["leaf"] for x in nodes], row["n"])
                out = {"tree": [row["tree"]] * len(nodes), "block": [x["r"] for x in nodes], "root": [row["root"]] * len(nodes),
                       "path": [_steps(levels, k) + row["path"] for k in range(len(nodes))]}
                arrays = [pa.array(out["tree"], pa.string()), pa.array(out["block"], pa.int64()),
                          pa.array(out["root"], pa.string()), pa.array(out["path"], pa.list_(pa.string()))]
                arrays += [pa.array([x[c] for x in nodes], pa.int64() if k.endswith("long") else pa.string()) for c, k in zip(names, kept)]
                yield pa.RecordBatch.from_arrays(arrays, names=["tree", "block", "root", "path", *names])

    kind = ", ".join(["tree string, block long, root string, path array<string>", *kept])
    return blocks.join(paths, ["tree", "block"]).mapInArrow(run, kind)


def paths(steps, tops, kept):
    """Nodes of the lowest blocks with paths that go on with those of `tops`
    (tree, path, root)."""
    above = tops.withColumn("block", F.lit(0).cast("long"))
    for blocks in reversed(steps[1:]):
        above = _descend(blocks, above, [])
    return _descend(steps[0], above, kept)


def fold(digest, path):
    """Root from a leaf and its path."""
    for step in path:
        before, after = step.split("|")
        digest = _digest([before, digest, after])
    return digest


def _proofs(batches):
    for batch in batches:
        rows = batch.to_pylist()
        out = {name: [row[name] for row in rows] for name in ("id", "leaf", "subroot", "root")}
        out["proof_sha256"] = [_digest(p.replace("|", "") for p in row["path"]) for row in rows]
        out["folded_root"] = [fold(row["leaf"] if row["bent"] is None else row["bent"], row["path"]) for row in rows]
        out["verified"] = [f == row["root"] for f, row in zip(out["folded_root"], rows)]
        kinds = {"id": pa.int64(), "verified": pa.bool_()}
        yield pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k, pa.string())) for k, v in out.items()], names=list(out))


def manifest(docs, columns, key="doc_id", group="source", tampered=None):
    """One row per document: key, leaf, subroot, root, proof_sha256, folded_root, verified.

    `columns` are hashed to the leaf in this order. `tampered` maps a column's
    name to what it is replaced with in the copy whose proof is checked; by
    default the copy is the document itself. A proof's siblings run from the leaf
    by the group's root to the root.
    """
    if dict(docs.dtypes)[key] not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError(f"{key} must be an integer column")
    ident = F.col(key).cast("long")
    bent = leaf([(tampered or {}).get(c, F.col(c)) for c in columns]) if tampered else F.lit(None).cast("string")
    hashed = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-")).alias("tree"),  # null first
        ident.alias("id"), leaf([F.col(c) for c in columns]).alias("leaf"), bent.alias("bent"),
    )
    hashed = hashed.withColumn("bent", F.when(F.col("bent") != F.col("leaf"), F.col("bent")))
    digits = lambda first, count: F.conv(F.substring("leaf", first, count), 16, 10).cast("long")
    leaves = hashed.groupBy("tree", "id", "leaf", "bent").agg(F.count("*").alias("copies")).select(
        "tree", F.coalesce(F.shiftright("id", 16), digits(1, 5) + NO_ID).alias("hi"),
        F.coalesce(F.col("id").bitwiseAND(F.lit(65535)), digits(6, 4)).cast("int").alias("lo"), "id", "leaf", "bent", "copies",
    )
    leaves = stage(leaves, "merkle-leaves")
    steps, roots = climb(coordinates(leaves))
    roots = stage(roots, "merkle-roots")
    groups = roots.select(F.lit("").alias("all"), F.col("tree"), F.col("leaf"), F.lit(1).cast("long").alias("one"))
    groups = running(groups, "all", "tree", "one", "r")
    upper, root = climb(groups.select(F.lit("").alias("tree"), "n", "r", "leaf", F.col("tree").alias("name")))
    top = root.select("tree", F.col("leaf").alias("root"), F.expr("cast(array() as array<string>)").alias("path"))
    tops = paths(upper, top, ["name string", "leaf string"]).select(F.col("name").alias("tree"), "path", "root", F.col("leaf").alias("subroot"))
    tops = stage(tops, "merkle-tops")
    found = paths(steps, tops.drop("subroot"), ["id long", "leaf string", "bent string"])
    found = found.select("tree", "id", "leaf", "bent", "path", "root").join(tops.select("tree", "subroot"), "tree")
    kind = "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    proved = found.select("id", "leaf", "bent", "subroot", "root", "path").mapInArrow(_proofs, kind)
    return proved.withColumn("id", F.col("id").cast(docs.schema[key].dataType)).withColumnRenamed("id", key)
