"""Binning expressions. Null and out-of-range values give null."""

from functools import reduce

from pyspark.sql import functions as F


def right_closed(col, edges, labels=None, include_lowest=False):
    """Bins (a, b]; a None edge at the end is unbounded, labels default to 0, 1, ..."""
    labels = list(range(len(edges) - 1)) if labels is None else labels
    chain = None
    for i, label in enumerate(labels):
        low, high = edges[i], edges[i + 1]
        above = (col >= low) if include_lowest and i == 0 else (col > low)
        inside = above if high is None else above & (col <= high)
        chain = F.when(inside, label) if chain is None else chain.when(inside, label)
    return chain


def left_closed_start(col, width, low, high):
    """Lower edge of the bin [a, a + width) between low and high, else null."""
    start = F.floor((col - low) / width) * width + low
    return F.when((col >= low) & (col < high), start)


def below_labels(col, limits):
    """First label whose limit is above the value; a None limit takes the rest.

    A missing value fails every comparison and so lands in the last label.
    """
    chain = None
    for limit, label in limits[:-1]:
        chain = F.when(col < limit, label) if chain is None else chain.when(col < limit, label)
    return chain.otherwise(limits[-1][1])


def above_labels(col, limits):
    """First label whose limit the value exceeds; the last label takes the rest."""
    chain = None
    for limit, label in limits[:-1]:
        chain = F.when(col > limit, label) if chain is None else chain.when(col > limit, label)
    return chain.otherwise(limits[-1][1])


def equal_width_edges(low, high, n):
    """Edges of n equal bins; the lowest edge moves down by 0.1 % of the range."""
    if low == high:
        pad = 0.001 * abs(low) if low else 0.001
        low, high = low - pad, high + pad
        return [low + (high - low) * i / n for i in range(n + 1)]
    edges = [low + (high - low) * i / n for i in range(n + 1)]
    edges[0] = low - 0.001 * (high - low)
    return edges


def edge_count(col, edges):
    """Index of the right-closed bin given its inner edges (null stays null)."""
    return reduce(lambda a, b: a + b, [(col > e).cast("int") for e in edges], F.lit(0))
