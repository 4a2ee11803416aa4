"""Periodic run detection by recompression.

The words of some documents at a time are one sequence of symbols, with a symbol
of its own at every border, so nothing extends from one document into the next.
The sequence is compressed in turns: blocks (a^k becomes one symbol) and pairs
(symbols are split in two classes, and every left symbol followed by a right one
becomes one symbol). Equal stretches are parsed equally but for their ends, so
the longest common extension of two places climbs the levels of this run-length
grammar while both agree and descends once where they differ: one step a level.
Candidates lie on a harmonic grid: a run of period p has so many places i with
equal words at i and i + p in a row that one of them is a multiple of the step
chosen for p. The extensions to both sides of a candidate are exact.

Defined results: a null or empty text has no words and no runs; rows are
independent of each other, so repeated rows and null or equal keys give equal
results for equal texts; an empty table gives no rows; columns that are not
named are passed on, and the result's own names win over columns of that name.
A text is never cut; one longer than a slice is a slice of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T

from pricegrid.llm.common import mixed, ranges, slices, words_of

MIN_LENGTH = 24
MIN_REPEATS = 3
CHUNK = 1 << 19  # candidates extended at a time
RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))


class Level:
    """Symbols of one level and their places in the levels above and below."""

    def __init__(self, symbols, first=None, blocks=False):
        self.symbols, self.first, self.blocks = symbols, first, blocks
        self.up = None  # parent of every symbol
        self.head = None  # whether a symbol is its parent's first

    def mirrored(self, below, above):
        """The same level read from right to left."""
        out = Level(self.symbols[::-1], blocks=self.blocks)
        if below is not None:
            out.first = len(below.symbols) - self.first[::-1]
        if above is not None:
            out.up = len(above.symbols) - 1 - self.up[::-1]
            out.head = np.append(True, out.up[1:] != out.up[:-1])
        return out


def _numbered(keys):
    names, codes = np.unique(keys, return_inverse=True)
    return codes.astype(np.int64), len(names)


def recompress(symbols):
    """Levels of the run-length grammar of a sequence of small numbers.

    It ends at a level whose symbols all differ: there no two places agree.
    """
    current, kinds = _numbered(symbols)
    levels = [Level(current)]
    salt = 0
    while kinds < len(current):
        head = np.append(True, current[1:] != current[:-1])
        if not head.all():
            first = np.flatnonzero(head)
            size = np.diff(np.append(first, len(current)))
            current, kinds = _numbered(current[first] * (size.max() + 1) + size)
            _add(levels, current, first, head, True)
            continue
        right = (mixed(np.arange(kinds, dtype=np.uint64) + np.uint64(salt * 0x9E3779B1)) & np.uint64(1)).astype(bool)[current]
        salt += 1
        second = np.append(False, ~right[:-1] & right[1:])
        swapped = np.append(False, right[:-1] & ~right[1:])
        if swapped.sum() > second.sum():
            second = swapped
        if not second.any():
            continue
        first = np.flatnonzero(~second)
        paired = np.append(second[1:], False)[first]
        other = np.where(paired, current[np.minimum(first + 1, len(current) - 1)] + 1, 0)
        current, kinds = _numbered(current[first] * (kinds + 1) + other)
        _add(levels, current, first, ~second, False)
    return levels


def _add(levels, current, first, head, blocks):
    below = levels[-1]
    below.head, below.up = head, np.cumsum(head) - 1
    levels.append(Level(current, np.append(first, len(below.symbols)), blocks))


def mirrored(levels):
    """The grammar of the reversed sequence."""
    ends = [None, *levels, None]
    return [level.mirrored(ends[k], ends[k + 2]) for k, level in enumerate(levels)]


def extensions(levels, x, y):
    """For every pair of different places, how many symbols from them on agree.

    The sequence must end with a symbol that occurs nowhere else.
    """
    x0, live = x, np.arange(len(x))
    x, y = x.copy(), y.copy()
    stopped = np.zeros(len(x), np.int64)
    for k, level in enumerate(levels):
        stopped[live] = k
        live = live[level.symbols[x[live]] == level.symbols[y[live]]]
        if not len(live) or k + 1 == len(levels):
            break
        above = levels[k + 1]
        a, b = x[live], y[live]
        inside = ~(level.head[a] & level.head[b])
        if inside.any():
            at, a, b = live[inside], a[inside], b[inside]
            if above.blocks:
                left = above.first[level.up[a] + 1] - a
                right = above.first[level.up[b] + 1] - b
                step = np.minimum(left, right)
                unequal = left != right
            else:
                step, unequal = 1, np.zeros(len(at), bool)
            x[at], y[at] = a + step, b + step
            # Blocks of unequal rest end here; after a pair the next places may differ.
            unequal |= level.symbols[x[at]] != level.symbols[y[at]]
            if unequal.any():
                held = np.ones(len(live), bool)
                held[np.flatnonzero(inside)[unequal]] = False
                live = live[held]
        x[live], y[live] = level.up[x[live]], level.up[y[live]]
    for k in range(int(stopped.max(initial=0)), 0, -1):
        level, below = levels[k], levels[k - 1]
        down = np.flatnonzero(stopped >= k)
        a, b = x[down], y[down]
        size = level.first[a + 1] - level.first[a], level.first[b + 1] - level.first[b]
        a, b = level.first[a], level.first[b]
        step = np.minimum(*size) if level.blocks else 1
        step = np.where(below.symbols[a] == below.symbols[b], step, 0)
        x[down], y[down] = a + step, b + step
    return x - x0


def _grid(sizes, starts, min_length, repeats):
    """Chunks of candidates (place, period) of texts of the given sizes."""
    long = sizes >= min_length
    sizes, starts = sizes[long], starts[long]
    most = np.minimum(sizes // repeats, sizes - 1)
    text = np.repeat(np.arange(len(sizes)), most)
    period = ranges(np.ones(len(sizes), np.int64), most)
    step = np.maximum(np.maximum(min_length - period, (repeats - 1) * period), 1)
    count = (sizes[text] - period - 1) // step + 1
    upto = np.cumsum(count)
    first = 0
    while first < len(text):
        before = upto[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(upto, before + CHUNK, "right")))
        some = slice(first, last)
        k = ranges(np.zeros(last - first, np.int64), count[some])
        p = np.repeat(period[some], count[some])
        yield np.repeat(starts[text[some]], count[some]) + k * np.repeat(step[some], count[some]), p
        first = last


def find_runs(codes, starts, min_length=MIN_LENGTH, repeats=MIN_REPEATS):
    """Runs of several texts: (text, start, length, period) arrays, sorted.

    `codes` holds the words of all texts, `starts` where each begins and the end.
    A run is a stretch of at least `min_length` words and `repeats` periods that
    keeps its smallest period and that no neighbouring word extends.
    """
    texts, sizes = len(starts) - 1, np.diff(starts)
    border = int(codes.max(initial=-1)) + 1
    sequence = np.empty(len(codes) + texts + 1, np.int64)
    borders = starts + np.arange(texts + 1)  # a border before every text and one at the end
    sequence[borders] = border + np.arange(texts + 1)
    at = np.ones(len(sequence), bool)
    at[borders] = False
    sequence[at] = codes
    found = []
    if (sizes >= min_length).any():
        levels = recompress(sequence)
        back, n, symbols = mirrored(levels), len(sequence), levels[0].symbols
        for i, p in _grid(sizes, borders[:-1] + 1, min_length, repeats):
            same = symbols[i] == symbols[i + p]
            i, p = i[same], p[same]
            ahead = extensions(levels, i, i + p)
            behind = extensions(back, n - i, n - i - p)
            whole = ahead + behind + p
            good = whole >= np.maximum(min_length, repeats * p)
            if good.any():
                # Equal stretches found with multiples of a period keep the smallest one.
                found.append(_smallest((i - behind)[good], whole[good], p[good]))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    start, length, period = _smallest(*(np.concatenate(c) for c in zip(*found)))
    text = np.searchsorted(borders, start, "right") - 1
    return text, start - borders[text] - 1, length, period


def _smallest(start, length, period):
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.append(True, (start[1:] != start[:-1]) | (length[1:] != length[:-1]))
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def runs_of(texts, min_length=MIN_LENGTH, repeats=MIN_REPEATS):
    """Per text (words, runs as (start, length, period), text with runs collapsed)."""
    starts, codes, names = words_of(texts)
    text, start, length, period = find_runs(codes, starts, min_length, repeats)
    at = starts[text] + start
    change = np.bincount(at + period, minlength=len(codes) + 1) - np.bincount(at + length, minlength=len(codes) + 1)
    kept = np.cumsum(change)[: len(codes)] == 0
    edges = np.searchsorted(text, np.arange(len(texts) + 1))
    rows = list(zip(start.tolist(), length.tolist(), period.tolist()))
    for k in range(len(texts)):
        a, b = starts[k], starts[k + 1]
        words = [names[c] for c in codes[a:b][kept[a:b]].tolist()]
        yield int(b - a), rows[edges[k] : edges[k + 1]], b" ".join(words).decode("utf-8")


def periodic_runs(docs, text="text", min_length=MIN_LENGTH, repeats=MIN_REPEATS):
    """The rows without `text`, with n_words, runs (array of start, length and
    period, by start, then period) and collapsed (the words that no run contains
    after its first period, joined by single spaces)."""
    own = ("n_words", "runs", "collapsed")
    names = [c for c in docs.columns if c != text and c not in own]
    schema = T.StructType([docs.schema[c] for c in names])
    schema = schema.add("n_words", "long").add("runs", RUNS).add("collapsed", "string")
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def run(batches):
        for batch in batches:
            texts = batch.column(text).to_pylist()
            for a, b in slices(texts):
                n, runs, left = zip(*runs_of(texts[a:b], min_length, repeats))
                runs = [[dict(zip(("start", "length", "period"), r)) for r in one] for one in runs]
                columns = [batch.column(c).slice(a, b - a) for c in names]
                columns += [pa.array(n, pa.int64()), pa.array(runs, kind), pa.array(left, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, *own])

    return docs.select(*names, text).mapInArrow(run, schema)
