"""Line dedup by a deletion-neighbourhood join, in DataFrame functions only.

A line is compared in lower case with white space collapsed. It goes if an equal
line occurs earlier, or, from MIN_WORDS words on, a line within one edit of it:
one word replaced, inserted or deleted. "Earlier" is by key, then place in the
text. Every line within reach emits all variants with one word deleted, as
hashed keys. Lines that differ by a replaced word share a variant deleted at the
same place; a line that lacks one word of another equals one of its variants.
Each variant's members are linked to its earliest only, the pair's words are
compared, and confirmed later lines go. No pairs within a variant are made.

Before variants are emitted, lines that cannot have a partner are left out, and
none else: with one edit, the first or the last half of the words is untouched,
so a line whose halves occur in no other line has no partner.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from pricegrid.llm.common import unique_number
from pricegrid.session import stage

MIN_WORDS = 8
BROADCAST_ROWS = 200_000  # of a few numbers each; larger tables are joined by shuffle
ODD_SPACE = ["  ", "\t", "\r", "\f", "\v"]


def normal(line):
    """Lower case, runs of white space as one blank; most lines have none to collapse."""
    odd = F.lit(False)
    for space in ODD_SPACE:
        odd = odd | F.contains(line, F.lit(space))
    return F.lower(F.trim(F.when(odd, F.regexp_replace(line, r"\s+", " ")).otherwise(line)))


def n_words(line):
    return F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def _first(line, n):
    """The first n words of a normal line, or the last -n."""
    return F.call_function("substring_index", line, F.lit(" "), n)


def without(line, place, n):
    """A normal line of n words but for the word at a place from 1."""
    between = F.when((place == 1) | (place == n), "").otherwise(" ")
    return F.concat(_first(line, place - 1), between, _first(line, place - n))


def _small(df, name):
    """A staged table, broadcast where it was counted to be small."""
    held = stage(df, name)
    return F.broadcast(held) if held.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else held


def _halves(line, n):
    """Hashes of the first and last halves that a partner within one edit shares."""
    keys = []
    for m in (F.floor((n - 1) / 2).cast("int"), F.floor(n / 2).cast("int")):
        keys.append(F.xxhash64(F.lit("first"), m, _first(line, m)))
        keys.append(F.xxhash64(F.lit("last"), m, _first(line, -m)))
    return F.array_distinct(F.array(*keys))


def _keyed(docs, key, text, unique):
    """The documents' row number: the key if it is unique, else a hash of key and text."""
    return F.col(key).cast("long") if unique else F.xxhash64(F.lit("row"), F.col(key), F.col(text))


def _at(unique):
    """Place of a line in the order, and the line's identity."""
    if unique:
        return F.struct("row", "pos")
    return F.struct(F.col("key").isNull().alias("no_key"), "key", "row", "pos")


def _lines(docs, key, text, min_words, unique):
    """One slim row per line with words: its hash, place in the order, half hashes."""
    rows = docs.select(
        F.col(key).alias("key"), _keyed(docs, key, text, unique).alias("row"), F.posexplode(F.split(text, "\n")).alias("pos", "line")
    )
    rows = rows.where(F.col("line").rlike(r"\S")).select("key", "row", "pos", normal(F.col("line")).alias("line"))
    rows = rows.select("key", "row", "pos", "line", n_words(F.col("line")).alias("n"))
    return rows.select(
        _at(unique).alias("at"),
        F.xxhash64("line").alias("h1"),
        F.xxhash64(F.lit("second"), "line").alias("h2"),
        F.when(F.col("n") >= min_words, _halves(F.col("line"), F.col("n"))).alias("halves"),
    )


def _near(docs, lines, key, text, unique):
    """Places of lines, each the first of its equals, with an earlier line within one edit."""
    firsts = lines.where("halves is not null").select("h1", "h2", "at", F.explode("halves").alias("half"))
    shared = firsts.groupBy("half").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi")).where("lo <> hi").select("half")
    within = firsts.join(_small(shared, "line-halves"), "half", "left_semi")
    within = within.groupBy("h1", "h2").agg(F.min("at").alias("at"))
    places = within.groupBy(F.col("at.row").alias("row")).agg(F.collect_set("at.pos").alias("places"))
    texts = docs.select(_keyed(docs, key, text, unique).alias("row"), F.col(key).alias("key"), F.split(text, "\n").alias("lines"))
    texts = texts.join(_small(places, "line-places"), "row")
    texts = texts if unique else texts.dropDuplicates(["row"])
    found = texts.select("key", "row", F.explode("places").alias("pos"), "lines")
    found = found.select("key", "row", "pos", normal(F.get("lines", "pos")).alias("line"))
    found = found.select(
        _at(unique).alias("at"), F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("second"), "line").alias("h2"),
        "line", n_words(F.col("line")).alias("n"),
    )
    found = stage(found.repartition("h1"), "line-candidates")

    def hashes(i):
        # The one-element array holds the variant, so that it is put together once.
        cut = F.array(without(F.col("line"), i, F.col("n")))
        return F.transform(cut, lambda v: F.struct(F.xxhash64(v).alias("v1"), F.xxhash64(F.lit("second"), v).alias("v2")))[0]

    variant = found.select("at", F.posexplode(F.transform(F.sequence(F.lit(1), "n"), hashes)).alias("place", "v"))
    variant = stage(variant.select("at", (F.col("place") + 1).alias("place"), "v.v1", "v.v2"), "line-variants")

    first = variant.groupBy("v1", "v2", "place").agg(F.min("at").alias("early"), F.count("*").alias("members")).where("members > 1")
    first = _small(first.drop("members"), "line-earliest")
    replaced = variant.join(first, ["v1", "v2", "place"]).where(F.col("at") > F.col("early")).select(
        F.col("at").alias("late"), "early", "place", F.lit("replaced").alias("kind")
    )
    whole = _small(found.select(F.col("h1").alias("v1"), F.col("h2").alias("v2"), F.col("at").alias("short")), "line-whole")
    inserted = variant.join(whole, ["v1", "v2"]).select(
        F.greatest("at", "short").alias("late"), F.least("at", "short").alias("early"), "place",
        F.when(F.col("at") > F.col("short"), "longer").otherwise("shorter").alias("kind"),
    )
    pairs = replaced.unionByName(inserted).distinct()
    a = found.select(F.col("at").alias("late"), F.col("line").alias("a"), F.col("n").alias("na"))
    b = found.select(F.col("at").alias("early"), F.col("line").alias("b"), F.col("n").alias("nb"))
    checked = pairs.join(a, "late").join(b, "early")
    cut_a = without(F.col("a"), F.col("place"), F.col("na"))
    cut_b = without(F.col("b"), F.col("place"), F.col("nb"))
    right = (
        F.when(F.col("kind") == "replaced", (cut_a == cut_b) & (F.col("na") == F.col("nb")))
        .when(F.col("kind") == "longer", cut_a == F.col("b"))
        .otherwise(F.col("a") == cut_b)
    )
    return checked.where(right).select(F.col("late").alias("at")).distinct()


def dedup_lines(docs, key="doc_id", text="text", min_words=MIN_WORDS):
    """The documents with their repeated lines removed from `text`, and counts.

    Adds n_lines and n_removed (lines with words; blank lines stay in place and
    are not counted) and replaces columns of these names. A text that loses all
    its lines becomes empty; null texts stay null with zero lines. Documents
    without a key come last in the order. Rows with the same key and text are
    one document, and keep the same lines.
    """
    unique = unique_number(docs, key)
    lines = stage(_lines(docs, key, text, min_words, unique), "lines")
    firsts = lines.groupBy("h1", "h2").agg(F.min("at").alias("at"))
    kept = firsts.join(_small(_near(docs, lines, key, text, unique), "line-near"), "at", "left_anti")
    kept = kept.groupBy(F.col("at.row").alias("__row")).agg(F.collect_set("at.pos").alias("__kept"))
    own = docs.drop("n_lines", "n_removed").withColumn("__row", _keyed(docs, key, text, unique))
    own = own.join(kept, "__row", "left").withColumn("__lines", F.split(text, "\n"))
    blank = F.filter(
        F.transform("__lines", lambda line, i: F.when(line.rlike(r"\S"), -1).otherwise(i)), lambda i: i >= 0
    )
    own = own.withColumn("__blank", blank).withColumn("__kept", F.coalesce("__kept", F.array().cast("array<int>")))
    places = F.sort_array(F.array_union("__kept", "__blank"))
    left = F.array_join(F.transform(places, lambda i: F.get("__lines", i)), "\n")
    n = F.coalesce(F.size("__lines") - F.size("__blank"), F.lit(0))
    n = F.when(F.col(text).isNull(), 0).otherwise(n).cast("long")
    own = own.withColumns({
        "n_lines": n,
        "n_removed": n - F.size("__kept"),
        text: F.when(F.col(text).isNull(), F.col(text)).when((n > 0) & (F.size("__kept") == 0), "").otherwise(left),
    })
    return own.drop("__row", "__kept", "__lines", "__blank")


def keep_remaining(docs, key="doc_id", text="text", **options):
    """Documents after line dedup; those that lost every line go. Other columns
    stay as they are, also those that have the names of the counts."""
    names = docs.columns
    own = {n: f"__own_{n}" for n in ("n_lines", "n_removed") if n in names}
    found = dedup_lines(docs.withColumnsRenamed(own), key, text, **options).where("n_lines = 0 or n_removed < n_lines")
    return found.select(*[F.col(own[n]).alias(n) if n in own else n for n in names])
