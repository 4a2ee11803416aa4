"""Benchmark decontamination by templates.

Words become template tokens: numbers <num>, quantities such as 5kg <qty>, units
after a number <unit>, capitalised words within a sentence <name> (a run of them
is one), everything else the lower-case word without outer punctuation. Windows
of SIZE tokens of documents are joined by hash with those of benchmark items. A
window with fewer than two ordinary words keeps its values, so columns of
numbers are not taken for questions. Items shorter than a window are one window.

Where a window matches, the values in the placeholders are compared: at one
alignment of item and document, each value of the item must always meet the same
value, else the windows that hold it do not count; the others do. Equal numbers,
quantities and units are one value only between the same neighbours, as a question
may use a number twice in different roles. So a question with other numbers or names
throughout is caught, and a chance meeting of templates is not.

A document leaks an item if matching windows near one place cover at least
CONTAINMENT of the item's windows.

Windows are tested first against a bitmap of the benchmark's hashes of BITS bits,
whatever the benchmark's size; what passes is joined exactly, so a benchmark too
large for the bitmap costs more rows in the join and loses nothing.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F

from pricegrid.llm.common import slices, window_hash, words_of
from pricegrid.session import stage

SIZE = 5
CONTAINMENT = 0.8
BITS = 22
MEMO = 1 << 16  # words a Python worker remembers, some 16 MB
PLAIN, NUMBER, QUANTITY, CAPITAL = 0, 1, 2, 3

#: Units that are taken as units after a number.
UNITS = (
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers "
    "mg g kg t lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons ml l cl liter liters litre litres "
    "gallon gallons s ms min h hr hrs second seconds minute minutes hour hours day days week weeks month months year years "
    "hz khz mhz ghz b kb mb gb tb w kw mw v a n j kj pa kpa bar k c f mph kmh kph percent % usd eur gbp dollar dollars "
    "euro euros cent cents degree degrees"
).split()
_UNIT = {u.encode() for u in UNITS}
_OUTER = b"\"'`.,;:!?()[]{}<>*_~|"
_NUMBER = re.compile(rb"[$+#-]?\d[\d.,:/]*(?:e[+-]?\d+)?%?")
_QUANTITY = re.compile(rb"[$+-]?\d[\d.,]*[a-z]{1,3}")


def _describe(word, memo={}):  # noqa: B006  bounded memo of a Python worker
    """(kind, ends a sentence, unit, hash of the ordinary token, value)."""
    got = memo.get(word)
    if got is None:
        core = word.strip(_OUTER) or word
        if core.isascii():
            low, capital = core.lower(), core[:1].isupper()
        else:
            plain = core.decode("utf-8", "replace")
            low, capital = plain.lower().encode(), plain[:1].isupper()
        kind = CAPITAL if capital else PLAIN
        if not low.isalpha():
            kind = NUMBER if _NUMBER.fullmatch(low) else QUANTITY if _QUANTITY.fullmatch(low) else kind
        got = kind, word.rstrip(b"\"')]")[-1:] in (b".", b"!", b"?", b":"), low in _UNIT, xxhash.xxh64_intdigest(low), low
        if len(memo) >= MEMO:
            memo.clear()
        memo[word] = got
    return got


#: Token hashes of the placeholders <num>, <qty>, <unit> and <name>.
_NUM, _QTY, _UNITS, _NAME = (np.uint64(xxhash.xxh64_intdigest(x, 1)) for x in ("num", "qty", "unit", "name"))


def template(texts):
    """Tokens of several texts: starts, template hashes, value hashes, ordinary flags, values, slot flags.

    Values are looked up by word code, so only windows that match build strings.
    """
    starts, codes, words = words_of(texts)
    about = [_describe(w) for w in words]
    kind = np.array([a[0] for a in about], np.int8)[codes] if words else np.zeros(0, np.int8)
    ends = np.array([a[1] for a in about], bool)[codes] if words else np.zeros(0, bool)
    unit = np.array([a[2] for a in about], bool)[codes] if words else np.zeros(0, bool)
    plain = np.array([a[3] for a in about], np.uint64)[codes] if words else np.zeros(0, np.uint64)
    first = np.zeros(len(codes), bool)
    first[starts[:-1][np.diff(starts) > 0]] = True
    after = np.concatenate([[False], ends[:-1]]) | first if len(codes) else first
    number = (kind == NUMBER) | (kind == QUANTITY)
    follows = (np.concatenate([[False], number[:-1]]) & ~first) if len(codes) else first
    name = (kind == CAPITAL) & ~after
    units = unit & follows & ~name
    tokens = np.where(kind == NUMBER, _NUM, np.where(kind == QUANTITY, _QTY, np.where(units, _UNITS, np.where(name, _NAME, plain))))
    keep = ~(name & np.concatenate([[False], name[:-1]])) if len(codes) else first
    owner = np.concatenate([[0], np.cumsum(keep)])[starts]
    slot = (number | units | name)[keep]
    return owner, tokens[keep], plain[keep], slot, codes[keep], [a[4] for a in about]


def window_hashes(tokens, plain, slot, at, size):
    """Template hashes; windows with fewer than two ordinary words hash their values."""
    ordinary = np.concatenate([[0], np.cumsum(~slot)])
    few = ordinary[at + size] - ordinary[at] < min(2, size)
    hashes = window_hash(tokens, at, size, salt=size)
    if few.any():
        hashes[few] = window_hash(plain, at[few], size, salt=100 + size)
    return hashes


def _rows(texts, keys, sizes, passes, whole=None, roles=False):
    """Frame of key, pos, size, h, slots of the windows that pass; with `roles` also the neighbours of each slot but names."""
    starts, tokens, plain, slot, codes, values = template(texts)
    lengths = np.diff(starts)
    edge = set(starts.tolist())

    def role(p):
        if tokens[p] == _NAME:
            return ""
        sides = (codes[p - 1] if p not in edge else None), (codes[p + 1] if p + 1 not in edge else None)
        return " ".join("" if c is None else values[c].decode("utf-8", "replace") for c in sides) + " "

    out = []
    for size in sizes:
        owner = np.repeat(np.arange(len(lengths)), np.maximum(lengths - size + 1, 0))
        at = np.arange(len(owner)) - np.repeat(np.cumsum(np.maximum(lengths - size + 1, 0)) - np.maximum(lengths - size + 1, 0), np.maximum(lengths - size + 1, 0))
        at = at + starts[:-1][owner] if len(owner) else at
        if whole is not None:
            mine = np.minimum(lengths, whole)[owner] == size
            owner, at = owner[mine], at[mine]
        h = window_hashes(tokens, plain, slot, at, size)
        hit = np.flatnonzero(passes(h))
        slots = [[values[codes[p]].decode("utf-8", "replace") for p in range(at[k], at[k] + size) if slot[p]] for k in hit]
        frame = pd.DataFrame({
            "key": [keys[k] for k in owner[hit]], "pos": (at[hit] - starts[:-1][owner[hit]]).astype(np.int64),
            "size": size, "h": h[hit].view(np.int64), "slots": slots,
        })
        if roles:
            frame["iroles"] = [[role(p) for p in range(at[k], at[k] + size) if slot[p]] for k in hit]
        out.append(frame)
    return pd.concat(out) if out else None


def _everything(hashes):
    return np.ones(len(hashes), bool)


def benchmark_windows(benchmark, item="item_id", text="text", size=SIZE):
    """One row a window of a benchmark text: item, version, ipos, size, h, islots, iroles; words shorter than `size` are one window.

    Equal rows are one text; several texts under one item are versions of it, told apart by their hash.
    """

    def run(batches):
        for batch in batches:
            for a, b in slices(batch["t"]):
                rows = _rows(batch["t"].iloc[a:b], np.arange(a, b), range(1, size + 1), _everything, whole=size, roles=True)
                if rows is not None and len(rows):
                    at = rows.pop("key").to_numpy().astype(np.int64)
                    rows = rows.rename(columns={"pos": "ipos", "slots": "islots"})
                    yield rows.assign(item=batch["i"].to_numpy()[at], version=batch["v"].to_numpy()[at])[names]

    names = ["item", "version", "ipos", "size", "h", "islots", "iroles"]
    slim = benchmark.select(F.col(item).alias("i"), F.col(text).alias("t")).where("i is not null and t is not null").distinct()
    return slim.withColumn("v", F.xxhash64("t")).mapInPandas(run, "item long, version long, ipos long, size int, h long, islots array<string>, iroles array<string>")


def bitmap(hashes, bits=BITS):
    """Bits set at the top `bits` bits of every long in column h, as numpy words.

    At most 2^(bits-6) rows reach the driver, whatever the table's size.
    """
    place = F.shiftrightunsigned("h", 64 - bits)
    word = hashes.select(F.shiftright(place, 6).alias("w"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - bits}) & 63 as int))").alias("b"))
    rows = word.groupBy("w").agg(F.bit_or("b").alias("b")).toPandas()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[rows["w"].to_numpy()] = rows["b"].to_numpy()
    return out.view(np.uint64)


def leaks(docs, benchmark, key="doc_id", text="text", item="item_id", size=SIZE, containment=CONTAINMENT, bits=BITS):
    """One row per leaking document and item.

    Columns: key, item, containment, verbatim (all placeholder values equal the
    item's), first_token. Documents without a key and items without an id are
    left out, as are null and empty texts; equal rows count once. Of several
    texts under one item the one that leaks most is reported.
    """
    windows = stage(benchmark_windows(benchmark, item, text, size), "benchmark-windows")
    sizes = sorted(r[0] for r in windows.select("size").distinct().collect())  # at most `size` numbers
    held = docs.sparkSession.sparkContext.broadcast(bitmap(windows, bits))

    def seen(h):
        place = h >> np.uint64(64 - bits)
        return (held.value[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1

    def run(batches):
        for batch in batches:
            for a, b in slices(batch["t"]):
                rows = _rows(batch["t"].iloc[a:b], batch["k"].to_numpy()[a:b], sizes, seen)
                if rows is not None and len(rows):
                    yield rows

    slim = docs.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t")).where("k is not null and t is not null")
    hits = slim.mapInPandas(run, "key string, pos long, size int, h long, slots array<string>").distinct()
    text_of = ["item", "version"]
    met = hits.join(windows, ["h", "size"]).withColumn("shift", F.col("pos") - F.col("ipos"))
    met = stage(met.select("key", *text_of, "ipos", "pos", "shift", "slots", "islots", "iroles"), "benchmark-hits")

    at = ["key", *text_of, "shift"]
    pairs = met.where("size(slots) > 0").select(*at, "ipos", "pos", F.explode(F.arrays_zip("islots", "iroles", "slots")).alias("s"))
    pairs = pairs.select(*at, "ipos", "pos", F.col("s.islots").alias("theirs"), F.col("s.iroles").alias("role"), F.col("s.slots").alias("ours"))
    values = pairs.groupBy(*at, "theirs", "role").agg((F.min("ours") == F.max("ours")).alias("steady"))
    judged = pairs.join(values, [*at, "theirs", "role"]).groupBy(*at, "ipos", "pos").agg(
        F.bool_and("steady").alias("steady"), F.bool_and(F.col("ours") == F.col("theirs")).alias("same")
    )
    whole = values.groupBy(*at).agg(F.bool_and("steady").alias("whole"))  # a copy with an altered value is not verbatim
    good = met.join(judged, [*at, "ipos", "pos"], "left").where("coalesce(steady, true)").join(whole, at, "left")

    totals = windows.groupBy(*text_of).agg(F.count("*").alias("n"))
    good = good.join(totals, text_of)
    # Matches count near one place: bands of alignments as wide as the item, two ways half a band apart.
    width = F.greatest(F.col("n") + size, F.lit(16))
    band = F.explode(F.array(
        F.struct(F.lit(0).alias("way"), F.floor(F.col("shift") / width).alias("band")),
        F.struct(F.lit(1).alias("way"), F.floor((F.col("shift") + F.floor(width / 2)) / width).alias("band")),
    ))
    near = good.select("key", *text_of, "n", "ipos", "pos", (F.coalesce("same", F.lit(True)) & F.coalesce("whole", F.lit(True))).alias("same"), band.alias("x"))
    places = near.groupBy("key", *text_of, "n", "x", "ipos").agg(F.min("pos").alias("pos"), F.bool_or("same").alias("same"))
    found = places.groupBy("key", *text_of, "x").agg(
        (F.count("*") / F.first("n")).alias("containment"), F.bool_and("same").alias("verbatim"), F.min("pos").alias("first_token")
    ).where(F.col("containment") >= containment)
    best = found.groupBy("key", "item").agg(F.max(F.struct("containment", "verbatim", (-F.col("first_token")).alias("f"))).alias("m"))
    kind = dict(docs.dtypes)[key]
    return best.select(
        F.col("key").cast(kind).alias(key), F.col("item").alias(item), "m.containment", "m.verbatim", (-F.col("m.f")).alias("first_token")
    )


def keep_clean(docs, benchmark, key="doc_id", **options):
    """The documents that leak no benchmark item; those without a key stay."""
    found = leaks(docs, benchmark, key, **options).select(F.col(key).alias("__leak")).distinct()
    return docs.join(found, docs[key] == found["__leak"], "left_anti")
