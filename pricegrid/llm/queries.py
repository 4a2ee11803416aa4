"""Registered queries of the operators and the corpus pipeline, with their SQL."""

from __future__ import annotations

import hashlib
import importlib

import pyarrow as pa
from pyspark.sql import functions as F

from pricegrid.llm import (
    bpe, chat_format, decontamination, embedding_dedup, language_id, licenses, line_dedup, lm_scores, merkle_manifest, periodic_runs,
    secrets, simhash, substring_dedup,
)
from pricegrid.llm.common import table
from pricegrid.plans.catalog import Catalog

catalog = Catalog()


def tokenizer_file(name):
    """Place of a public tokenizer file on this machine."""
    return importlib.import_module("public_tokenizers").path(name)


def fast_pattern():
    return importlib.import_module("public_tokenizers").PATTERN


@catalog.add("op1_decontamination")
def op1(spark, sf_dir):
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


LINES_SQL = r"""
with line as (
  select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as pos from documents
), worded as (
  select doc_id, pos, line, trim(lower(regexp_replace(line, '\s+', ' ', 'g'))) as norm from line
), filled as (
  select *, string_split(norm, ' ') as w from worded where norm <> ''
), firsts as (
  select norm, any_value(w) as w, min(struct_pack(d := doc_id, p := pos)) as place from filled group by norm
), variant as (
  select norm, w, place, k, array_to_string(list_concat(w[1:k-1], w[k+1:len(w)]), ' ') as v
  from (select *, unnest(range(1, len(w) + 1)) as k from firsts where len(w) >= 8)
), near as (
  select a.norm from variant a join variant b on a.v = b.v and a.k = b.k and len(a.w) = len(b.w) and b.place < a.place
  union select a.norm from variant a join firsts b on a.v = b.norm and len(b.w) >= 8 and b.place < a.place
  union select a.norm from firsts a join variant b on b.v = a.norm and len(a.w) >= 8 and b.place < a.place
), kept as (
  select place.d as doc_id, place.p as pos from firsts where norm not in (select norm from near)
), parts as (
  select x.doc_id, x.pos, x.line, x.norm = '' as blank, k.pos is not null as kept
  from worded x left join kept k on x.doc_id = k.doc_id and x.pos = k.pos
), counts as (
  select doc_id, count(*) filter (where not blank) as n_lines, count(*) filter (where not blank and not kept) as n_removed,
    string_agg(line, chr(10) order by pos) filter (where blank or kept) as body
  from parts group by doc_id
)
select d.doc_id, coalesce(c.n_lines, 0)::bigint as n_lines, coalesce(c.n_removed, 0)::bigint as n_removed,
  sha256(case when c.n_lines > 0 and c.n_removed = c.n_lines then '' else coalesce(c.body, '') end) as kept_sha256
from documents d left join counts c on d.doc_id = c.doc_id
"""


@catalog.add("op2_line_dedup", LINES_SQL)
def op2(spark, sf_dir):
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@catalog.add("op3_secret_scan")
def op3(spark, sf_dir):
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "place", "field", "run", F.sha2("value", 256).alias("value_sha256"), "score", "is_secret")


@catalog.add("op4_simhash")
def op4(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@catalog.add("op5_language_id")
def op5(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = language_id.held_out()
    model = language_id.LanguageModel.fit(docs.where(~held))
    found = model.predict(docs.select("doc_id", held.alias("held_out"), "text"), keep=["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


def read_back(windows):
    """Per conversation, from formatted windows alone: turns, loss text and length.

    A digest of a whole conversation is read in order, so its windows come sorted
    to one task; they pass through it a batch at a time and only the state of the
    digests is held, however long the conversation is.
    """
    kind = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    names = [c.split()[0] for c in kind.split(", ")]
    schema = pa.schema([(n, pa.string() if n.endswith("sha256") else pa.int64()) for n in names])

    def run(batches):
        held = None  # conv_id, turns, digest of turns, loss characters, digest of loss, characters

        def done():
            return dict(zip(names, (held[0], held[1], held[2].hexdigest(), held[3], held[4].hexdigest(), held[5])))

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if held is None or held[0] != row["conv_id"]:
                    if held is not None:
                        out.append(done())
                    held = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                text = row["formatted"]
                for role, said in chat_format.parse(text)[row["n_repeated"] :]:
                    held[1] += 1
                    held[2].update(f"{role}\n{said}\n".encode("utf-8", "replace"))
                for m in row["mask"]:
                    loss = chat_format.unescape(text[m["start"] : m["end"]])
                    held[3] += len(loss)
                    held[4].update(loss.encode("utf-8", "replace"))
                held[5] += len(text)
            yield pa.RecordBatch.from_pylist(out, schema)
        if held is not None:
            yield pa.RecordBatch.from_pylist([done()], schema)

    slim = windows.select("conv_id", "window", "n_repeated", "formatted", "mask")
    return slim.repartition("conv_id").sortWithinPartitions("conv_id", "window").mapInArrow(run, kind)


@catalog.add("op6_chat_format")
def op6(spark, sf_dir):
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    tokens = chat_format.token_counter(tokenizer_file("byte_bpe_50k.json"))
    return read_back(chat_format.windows(given.unionByName(extra), tokens))


@catalog.add("op7_bpe_codec")
def op7(spark, sf_dir):
    return bpe.digests(
        table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("byte_bpe_50k.tiktoken"), fast_pattern()
    )


@catalog.add("op8_embedding_dedup")
def op8(spark, sf_dir):
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


WINDOWS_SQL = r"""
with doc as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents
), win as (
  select doc_id, p, array_to_string(w[p:p+34], ' ') as s from (select doc_id, w, unnest(range(1, len(w) - 33)) as p from doc where len(w) >= 35)
), twice as (
  select sha256(s) as h from win group by s having count(*) > 1
), starts as (
  select doc_id, list(p) as ps from win where sha256(s) in (select h from twice) group by doc_id
), covered as (
  select distinct doc_id, unnest(range(p, p + 35)) as i from (select doc_id, unnest(ps) as p from starts)
), word as (
  select doc_id, unnest(w) as x, unnest(range(1, len(w) + 1)) as i from doc
), kept as (
  select word.doc_id, string_agg(x, ' ' order by word.i) as s, count(*) as n
  from word left join covered on word.doc_id = covered.doc_id and word.i = covered.i where covered.i is null group by word.doc_id
)
select doc.doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(s, '')) as kept_sha256
from doc left join kept on doc.doc_id = kept.doc_id
"""


@catalog.add("op9_substring_dedup", WINDOWS_SQL)
def op9(spark, sf_dir):
    return substring_dedup.remove_repeated(table(spark, sf_dir, "documents"), digest=True)


@catalog.add("op10_license_scan")
def op10(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


def crc(column="doc_id"):
    """Unsigned CRC-32 of a number's decimal digits."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def with_periodic_tails(docs):
    """The documents of which a tenth repeats a part of its words up to its end."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, g = F.greatest(F.size("w"), F.lit(1)), F.floor(F.col("h") / 10)
    head = F.pmod(g, n).cast("int")
    period = (1 + F.floor((n - head) / (3 + F.pmod(g, F.lit(8))))).cast("int")
    tail = F.flatten(F.array_repeat(F.slice("w", head + 1, period), F.ceil((n - head) / period).cast("int")))
    made = F.array_join(F.slice(F.concat(F.slice("w", F.lit(1), head), tail), F.lit(1), n), " ")
    planted = docs.withColumn("h", crc())
    some = (F.col("h") % 10 == 0) & F.col("text").isNotNull()
    planted = planted.withColumn("w", F.when(some, words))
    return planted.select("doc_id", F.when(some & (F.size("w") > 0), made).otherwise(F.col("text")).alias("text"))


@catalog.add("op11_periodic_runs")
def op11(spark, sf_dir):
    found = periodic_runs.periodic_runs(with_periodic_tails(table(spark, sf_dir, "documents").select("doc_id", "text")))

    def longer(a, b):
        more = b["length"] * a["period"] - a["length"] * b["period"]
        return F.signum(F.when(more != 0, more).when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["period"] - b["period"])).cast("int")

    best = F.get(F.array_sort("runs", longer), F.lit(0))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@catalog.add("op12_lm_scores")
def op12(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.coalesce(crc() % 5 == 1, F.lit(False))
    model = lm_scores.fit(docs, ~held, crc() % 5 == 2)
    found = model.score().withColumn("held_out", held)
    return found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def _sql_field(column):
    return f"case when {column} is null then '-' else strlen({column}::varchar)::varchar || ':' || {column}::varchar end"


MERKLE_SQL = r"""
with recursive doc as (
  select row_number() over () as rid, doc_id, source, lang, n_chars, text, list_reduce(list_concat([4294967295::bigint], list_transform(string_split(doc_id::varchar, ''), lambda d: ascii(d)::bigint)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], [0::bigint, 0, 0, 0, 0, 0, 0, 0]), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))) & 1 as odd
  from documents
), leaves as (
  select rid, doc_id, source, sha256(HEAD || TEXT) as leaf,
    sha256(HEAD || (case when odd = 1 then BENT else TEXT end)) as bent
  from doc
), placed as (
  select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as r, count(*) over (partition by source) as n from leaves
), up as (
  select source, 0 as lvl, r as idx, leaf as h, n from placed
  union all
  select source, lvl + 1, idx // 3, sha256(string_agg(h, '' order by idx)), (max(n) + 2) // 3 from up where n > 1 group by source, lvl, idx // 3
), sub as (
  select source, h, row_number() over (order by source nulls first) - 1 as r, count(*) over () as n from up where n = 1
), top as (
  select 0 as lvl, r as idx, h, n from sub
  union all
  select lvl + 1, idx // 3, sha256(string_agg(h, '' order by idx)), (max(n) + 2) // 3 from top where n > 1 group by lvl, idx // 3
), near as (
  select a.source, a.lvl, a.idx, coalesce(string_agg(b.h, '' order by b.idx) filter (where b.idx < a.idx), '') as pre,
    coalesce(string_agg(b.h, '' order by b.idx) filter (where b.idx > a.idx), '') as post
  from up a join up b on a.source is not distinct from b.source and a.lvl = b.lvl and a.idx // 3 = b.idx // 3 where a.n > 1 group by a.source, a.lvl, a.idx
), near_top as (
  select a.lvl, a.idx, coalesce(string_agg(b.h, '' order by b.idx) filter (where b.idx < a.idx), '') as pre,
    coalesce(string_agg(b.h, '' order by b.idx) filter (where b.idx > a.idx), '') as post
  from top a join top b on a.lvl = b.lvl and a.idx // 3 = b.idx // 3 where a.n > 1 group by a.lvl, a.idx
), walk as (
  select rid, source, 0 as lvl, r as idx, bent as h, '' as proof from placed
  union all
  select w.rid, w.source, w.lvl + 1, w.idx // 3, sha256(pre || h || post), proof || pre || post
  from walk w join near k on w.source is not distinct from k.source and w.lvl = k.lvl and w.idx = k.idx
), over_sub as (
  select rid, any_value(source) as source, arg_max(h, lvl) as h, arg_max(proof, lvl) as proof from walk group by rid
), walk_top as (
  select o.rid, s.r as idx, 0 as lvl, o.h, o.proof from over_sub o join sub s on o.source is not distinct from s.source
  union all
  select w.rid, w.idx // 3, w.lvl + 1, sha256(pre || w.h || post), proof || pre || post from walk_top w join near_top k on w.lvl = k.lvl and w.idx = k.idx
), folded as (
  select rid, arg_max(h, lvl) as h, arg_max(proof, lvl) as proof from walk_top group by rid
)
select p.doc_id, p.leaf, s.h as subroot, t.h as root, sha256(f.proof) as proof_sha256, f.h as folded_root, f.h = t.h as verified
from placed p join folded f on p.rid = f.rid join sub s on p.source is not distinct from s.source cross join (select h from top where n = 1) t
""".replace("HEAD", " || ".join(_sql_field(c) for c in ("doc_id", "source", "lang", "n_chars"))).replace(
    "TEXT", f"({_sql_field('text')})").replace("BENT", f"({_sql_field("replace(text, chr(10), '')")})")


@catalog.add("op13_merkle_manifest", MERKLE_SQL)
def op13(spark, sf_dir):
    even = F.coalesce(crc() % 2 == 0, F.lit(False))
    bent = F.when(even, F.translate("text", "\n", "")).otherwise(F.col("text"))
    return merkle_manifest.manifest(
        table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], tampered={"text": bent}
    )


@catalog.add("pipeline")
def pipeline(spark, sf_dir):
    return importlib.import_module("corpus_pipeline").run(spark, sf_dir)
