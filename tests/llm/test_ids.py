"""Ids beyond 2^53 beside a null, columns with clashing names and a corpus without labels."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pricegrid.llm import (
    bpe, chat_format, decontamination, embedding_dedup, language_id, licenses, line_dedup, lm_scores, merkle_manifest,
    periodic_runs, secrets, simhash, substring_dedup,
)
from pricegrid.llm.queries import fast_pattern, tokenizer_file
from pricegrid.session import stage
from tests.conftest import SF

BIG = 1 << 53
IDS = [BIG + 1, None, BIG + 3, BIG + 5]
KIND = ("doc_id long, text string, lang string, source string, n_chars long, extra long, n_lines long, n_removed long, "
        "score double, fp string, row long, lang_pred string")
MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
       "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
       "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
       "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial "
       "portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
       "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
       "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING "
       "FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
SHARED = " ".join(f"shared{k}" for k in range(60))
QUESTION = "How many miles does the train from Boston travel in 3 hours at a speed of 60 miles per hour on a clear day in June"


def texts():
    out = {}
    for k, i in enumerate(IDS):
        own = " ".join(f"word{k}x{n}" for n in range(40))
        out[i] = f"{own}\n{SHARED} tail{k}\n{MIT}\n{QUESTION}\npassword = 'aK3jf93kfLs0a8fJ3k{k}q'"
    return out


@pytest.fixture
def docs(spark):
    rows = [(i, t, "en", "s", len(t), None if k == 1 else BIG + 10 + k, 7, 8, 0.5, "mine", 3, "xx") for k, (i, t) in enumerate(texts().items())]
    return stage(spark.createDataFrame(rows, KIND).coalesce(1), "ids")  # one batch


def ids(df, column="doc_id"):
    return sorted((r[column] for r in df.select(column).collect()), key=str)


ALL = sorted(IDS, key=str)


def same(df, docs, *columns):
    got = {tuple(r) for r in df.select("doc_id", *columns).collect()}
    return got == {tuple(r) for r in docs.select("doc_id", *columns).collect()}


def test_every_operator_keeps_ids(spark, docs):
    files = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("byte_bpe_50k.tiktoken"), fast_pattern()
    model = language_id.LanguageModel.fit(docs)
    passed = ("extra", "n_chars", "n_lines", "n_removed", "fp", "row", "source")
    assert same(model.predict(docs, keep=None), docs, *passed)
    assert ids(model.predict(docs, keep=["doc_id"])) == ALL
    found = line_dedup.dedup_lines(docs)
    assert ids(found) == ALL and {r["extra"] for r in found.collect()} == {None, BIG + 10, BIG + 12, BIG + 13}
    assert ids(simhash.near_duplicates(docs)) == ALL and ids(simhash.fingerprints(docs)) == ALL
    assert ids(bpe.digests(docs, *files)) == ALL and same(bpe.encode_documents(docs, *files), docs, *passed, "score")
    assert ids(substring_dedup.remove_repeated(docs)) == ALL
    assert {r["n_removed"] for r in substring_dedup.remove_repeated(docs).collect()} != {0}
    assert set(ids(licenses.scan(docs))) == set(IDS)
    assert set(ids(secrets.scan(docs))) <= set(IDS)
    bench = spark.createDataFrame([(BIG + 7, QUESTION)], "item_id long, text string")
    leaks = decontamination.leaks(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in leaks} == {(i, BIG + 7) for i in IDS if i is not None}
    assert ids(decontamination.keep_clean(docs, bench)) == [None]
    turns = docs.select(F.col("doc_id").alias("conv_id"), F.lit(0).alias("turn"), F.lit("user").alias("role"), "text")
    windows = chat_format.windows(turns, chat_format.token_counter(files[0]))
    assert set(ids(windows, "conv_id")) == set(IDS)
    vectors = docs.where("doc_id is not null").select(F.col("doc_id").alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("embedding"))
    assert {r["component_id"] for r in embedding_dedup.near_duplicates(vectors).collect()} == {BIG + 1}
    assert same(periodic_runs.periodic_runs(docs), docs, *passed, "score", "lang_pred")
    assert ids(lm_scores.fit(docs, F.lit(True), F.lit(False)).score()) == ALL
    assert ids(merkle_manifest.manifest(docs, ["doc_id", "text"])) == ALL


def test_filters_keep_rows_and_columns(spark, docs):
    assert same(simhash.keep_one(docs), docs, "extra", "row", "fp", "score")
    kept = line_dedup.keep_remaining(docs)
    assert kept.columns == docs.columns and same(kept, docs, "n_lines", "n_removed", "extra")
    twice = docs.unionByName(docs.where("doc_id is not null").withColumn("doc_id", F.col("doc_id") + 100))
    assert ids(simhash.keep_one(twice)) == ALL


def test_stages_keep_ids(spark, docs):
    only = docs.select("doc_id", "text", "lang", "source", "n_chars")
    unlabelled = only.withColumn("lang", F.lit(None).cast("string"))
    assert ids(language_id.keep_known(unlabelled)) == ALL  # nothing to tell languages by
    kept = unlabelled
    for _, apply in corpus_pipeline.STAGES:
        kept = stage(apply(spark, kept, SF), "ids-pipeline")
        assert ids(kept) == ALL
