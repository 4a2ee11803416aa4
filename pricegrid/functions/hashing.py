"""Row-wise pseudo-random numbers that do not depend on partitioning."""

from pyspark.sql import functions as F


def split_key(key, seed=None):
    """Uniform hex text per row; with a seed the key is hashed again."""
    if seed is None:
        return key
    return F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}")))


def uniform(key, stream, seed=42):
    """Uniform number in [0, 1) from the row key, the stream name and the seed."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f"|{stream}|{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def alias_table(weights):
    """(word, cut, other) per word: Walker's alias cells, all of equal width.

    A cell belongs to its word up to `cut` and to the other word beyond it. A word
    that is lighter than the mean fills its cell from one that is heavier, until
    every cell is full. Weights need not sum to one; a word without weight is
    never drawn.
    """
    if not weights or min(weights.values()) < 0 or not sum(weights.values()) > 0:
        raise ValueError("weights must be zero or more, and one of them more")
    mean = sum(weights.values()) / len(weights)
    left = {word: weight / mean for word, weight in weights.items()}
    cells = {word: (1.0, word) for word in weights}
    light = [word for word in weights if left[word] < 1]
    heavy = [word for word in weights if left[word] >= 1]
    while light and heavy:
        word = light.pop()
        cells[word] = (round(left[word], 12), heavy[-1])
        left[heavy[-1]] -= 1 - left[word]
        if left[heavy[-1]] < 1:
            light.append(heavy.pop())
    return [(str(word), cut, str(other)) for word, (cut, other) in cells.items()]


def weighted(u, weights):
    """Pick a word with odds by weight: one look into a table of equal cells.

    The whole part of u times the number of words is the cell, its fraction is
    compared with the cell's cut, so the work does not grow with the words. The
    word comes back as text.
    """
    cells = alias_table(weights)
    place = u * F.lit(float(len(cells)))
    words, cuts, others = (F.array(*map(F.lit, column)) for column in zip(*cells))
    cell = F.floor(place).cast("int")
    return F.when(place - cell < F.get(cuts, cell), F.get(words, cell)).otherwise(F.get(others, cell))
