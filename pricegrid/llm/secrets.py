"""Secret scans: candidate tokens judged by a random forest, in DataFrame functions.

Candidates are all unbroken runs of at least MIN_LENGTH characters of the
alphabets of keys (letters, digits, + / _ -, = as padding), several in a token of
compact JSON, a URL or minified code. Name and neighbours of a run come from the
text in front of it in its token. A forest removes the false positives from

* the length,
* character transitions: changes between digits, lower and upper case, distinct
  characters, shares of digits and capitals, hexadecimal or digits only,
* dictionary coverage: the share of characters in words that occur in at least
  MIN_DOCS documents of the corpus, counted over all of them,
* the path the text comes from, and
* neighbouring words: names of secrets before the value, words for examples,
  hashes and addresses on either side, and an assignment sign.

It is trained from labelled findings: (key, place, label) rows of a reviewer or,
without any, findings that `rule_labels` is sure of. Training takes at most
about `train_rows` findings, picked by hash; all findings are judged.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pricegrid.session import stage

MIN_LENGTH = 16
MIN_DOCS = 5
AROUND = 3
FEATURES = [
    "length", "changes", "distinct", "digits", "capitals", "hexadecimal", "numeric", "coverage",
    "test_path", "doc_path", "named", "assigned", "example", "hash_word", "address",
]

#: Words that name a secret, an example, a digest, and test or documentation paths.
NAMES = r"(?i)(pass(word|wd|phrase)?|pwd|secret|token|api[_-]?key|apikey|access[_-]?key|auth|bearer|credential|private)"
EXAMPLES = r"(?i)(?<![\w.@-])(example|sample|dummy|placeholder|changeme|your|test|fake|mock|xxx+)(?![\w.@-])"
DIGESTS = r"(?i)\b(sha\d*|md5|checksum|digest|commit|revision|etag|uuid|guid|hash)\b"
TEST_PATHS, DOC_PATHS = r"(?i)(test|spec|fixture|example|sample|mock)", r"(?i)(doc|readme|\.md$|license)"
_VALUE = rf"[A-Za-z0-9+/_-]{{{MIN_LENGTH},}}(?:={{1,2}}(?![A-Za-z0-9+/_=-]))?"
_ASSIGNED = r"([A-Za-z_][A-Za-z0-9_.-]{0,39})[\"'`\]]{0,2}[=:]+>?[\"'`({\[]{0,3}$"  # the name a value in a token is assigned to
_FIELDS = r"[,;&?{}]+"  # between the fields of a token: compact JSON, queries of URLs, statements
NEAR = 64  # characters of a field read in front of a run


def findings(docs, key="doc_id", text="text", path="source"):
    """One row a candidate: key, place (word number), field and run (numbers within the word),
    path, name, value, before, after, address.

    Null and empty texts have none. Only candidates leave the scan, with
    AROUND words on either side; the text does not.
    """
    words = F.split(F.coalesce(text, F.lit("")), r"\s+")
    long_ones = F.filter(
        F.transform(F.col("w"), lambda w, i: F.when((F.length(w) >= MIN_LENGTH) & w.rlike(_VALUE), i).otherwise(-1)), lambda i: i >= 0
    )
    rows = docs.select(F.col(key).alias("key"), F.col(path).cast("string").alias("path"), words.alias("w"))
    rows = rows.withColumn("at", long_ones).where(F.size("at") > 0)
    rows = rows.select("key", "path", F.explode(F.transform("at", lambda i: F.struct(
        i.alias("place"), F.get("w", i).alias("token"),
        F.array_join(F.slice("w", F.greatest(i - AROUND, F.lit(0)) + 1, F.least(i, F.lit(AROUND))), " ").alias("words_before"),
        F.array_join(F.slice("w", i + 2, F.lit(AROUND)), " ").alias("after"),
    ))).alias("x")).select("key", "path", "x.*")
    rows = rows.select("*", F.posexplode(F.split("token", _FIELDS)).alias("field", "said")).where(F.length("said") >= MIN_LENGTH)
    # The texts between the runs of a field tell what stands in front of each.
    rows = rows.withColumn("values", F.regexp_extract_all("said", F.lit(_VALUE), F.lit(0))).withColumn("gaps", F.split("said", _VALUE))
    runs = F.arrays_zip("values", "gaps", F.concat(F.array(F.lit("")), "values").alias("last"))
    rows = rows.select("*", F.posexplode(F.filter(runs, lambda r: r["values"].isNotNull())).alias("run", "r"))
    front = F.concat("r.last", "r.gaps")
    front = F.substring(front, F.greatest(F.length(front) - NEAR, F.lit(0)) + 1, F.lit(NEAR))
    rows = rows.withColumn("value", F.col("r.values")).withColumn("name", F.regexp_extract(front, _ASSIGNED, 1))
    rows = rows.withColumn("before", F.concat_ws(" ", "words_before", F.when(front != "", front)))
    address = F.col("said").rlike(r"@|://|^www\.|^\d{1,3}(\.\d{1,3}){3}")
    rows = rows.withColumn("address", address).select("key", "place", "field", "run", "path", "name", "value", "before", "after", "address")
    return rows.dropDuplicates(["key", "place", "field", "run", "value"])


def dictionary(docs, text="text", min_docs=MIN_DOCS):
    """Lower-case words of three letters or more in at least min_docs documents."""
    words = F.array_distinct(F.split(F.lower(text), r"[^a-z]+"))
    words = docs.select(F.explode(F.filter(words, lambda w: F.length(w).between(3, 24))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs).select("word")


def features(found, words):
    """The findings with the forest's features; `words` is a table of dictionary words."""
    found = found.withColumn("fid", F.xxhash64("key", "place", "field", "run", "value"))
    runs = found.select("fid", F.explode(F.expr("regexp_extract_all(lower(value), '[a-z]{3,}', 0)")).alias("word"))
    covered = runs.join(words, "word").groupBy("fid").agg(F.sum(F.length("word")).alias("in_words"))
    found = found.join(covered, "fid", "left")
    n = F.length("value")
    count = lambda pattern: F.regexp_count("value", F.lit(pattern)).cast("double")
    near = F.concat_ws(" ", "before", "name", "after")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    changes = count(r"(?<=\d)(?=[A-Za-z])|(?<=[A-Za-z])(?=\d)|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])")
    return found.withColumns({
        "length": n.cast("double"),
        "changes": changes / n,
        "distinct": F.size(F.array_distinct(F.split("value", ""))) / n,
        "digits": count(r"\d") / n,
        "capitals": count("[A-Z]") / n,
        "hexadecimal": flag(F.col("value").rlike("^[0-9a-fA-F]+$")),
        "numeric": flag(F.col("value").rlike(r"^\d+$")),
        "coverage": F.coalesce("in_words", F.lit(0)) / n,
        "test_path": flag(F.col("path").rlike(TEST_PATHS)),
        "doc_path": flag(F.col("path").rlike(DOC_PATHS)),
        "named": flag(F.concat_ws(" ", "before", "name").rlike(NAMES)),
        "assigned": flag((F.col("name") != "") | F.col("before").rlike(r"[=:]\s*[\"']?$")),
        "example": flag(near.rlike(EXAMPLES) | F.col("value").rlike(EXAMPLES)),
        "hash_word": flag(near.rlike(DIGESTS)),
        "address": flag(F.col("address")),
    }).drop("in_words")


def rule_labels(found):
    """Findings that rules are sure of: 1 for a known key format or a named assignment, 0 for the plainly harmless.

    Everything else has no label and is left to the forest.
    """
    known = F.col("value").rlike(r"^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36}|^sk_live_[A-Za-z0-9]{16,}|^xox[abpr]-")
    mixed = (F.col("digits") > 0) & (F.col("digits") < 1) & (F.col("coverage") < 0.5)
    sure = known | ((F.col("named") == 1) & (F.col("assigned") == 1) & mixed)
    harmless = (F.col("address") == 1) | (F.col("numeric") == 1) | (F.col("digits") == 0) | (F.col("example") == 1) | (F.col("hash_word") == 1)
    label = F.when(harmless & ~known, 0.0).when(sure & (F.col("example") == 0), 1.0)
    return found.withColumn("label", label).where("label is not null")


def train(labelled, train_rows=4000, trees=40, depth=8, seed=7):
    """A fitted forest, or the share of positives if all labels agree (0.0 without any).

    labelled: findings with features and `label` (0 or 1). The share of each
    label is counted first; about train_rows are taken, half of each label as
    far as there are so many, by hash of the finding.
    """
    sizes = {float(r["label"]): r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return next(iter(sizes), 0.0)
    place = F.pmod(F.xxhash64("fid", F.lit(seed)), F.lit(1 << 20)) / float(1 << 20)
    cut = reduce(lambda a, b: a | b, [(F.col("label") == v) & (place < min(1.0, train_rows / 2 / n)) for v, n in sizes.items()])
    sample = stage(labelled.where(cut).select("label", *FEATURES), "secret-sample")
    if sample.select("label").distinct().count() < 2:
        return max(sizes, key=sizes.get)
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt")
    return forest.fit(rows.select("label", "features"))


def judge(found, model, threshold=0.5):
    """The findings with score and is_secret."""
    if isinstance(model, float):
        scored = found.withColumn("score", F.lit(model))
    else:
        rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)
        scored = model.transform(rows).withColumn("score", vector_to_array("probability")[1])
        scored = scored.drop("features", "rawPrediction", "probability", "prediction")
    return scored.withColumn("is_secret", F.col("score") >= threshold)


def scan(docs, labels=None, key="doc_id", text="text", path="source", threshold=0.5, min_docs=MIN_DOCS, **options):
    """All findings of `docs` with score and is_secret.

    labels: (key, place, label) of reviewed findings, with field and run where a
    word has several candidates; without them a label holds for all of its word.
    None takes `rule_labels`.
    A finding repeated by equal rows counts once; findings in documents without
    a key keep a null key. Empty tables give no finding.
    """
    found = features(stage(findings(docs, key, text, path), "findings"), dictionary(docs, text, min_docs))
    found = stage(found, "finding-features")
    if labels is None:
        labelled = rule_labels(found)
    else:
        at = ["place", *[c for c in ("field", "run") if c in labels.columns]]
        labels = labels.select(F.col(key).alias("key"), *at, F.col("label").cast("double").alias("label"))
        labelled = found.join(labels, ["key", *at])
    return judge(found, train(labelled, **options), threshold).withColumnRenamed("key", key)
