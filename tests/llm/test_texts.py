"""Language ID, chat formatting, BPE, secrets, licences and decontamination."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from pricegrid.llm import bpe, chat_format, decontamination, language_id, licenses, queries, secrets
from pricegrid.llm.common import slices, table, words_of
from tests.conftest import SF
from tests.llm import brute

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows(df):
    return [tuple(r) for r in df.collect()]


def docs_of(spark, texts, extra="x"):
    data = [(k, t, None, extra, 1) for k, t in enumerate(texts)]
    return spark.createDataFrame(data, DOCS)


def test_words_as_stated():
    texts = [None, "", " a\x0bb\x0c c\r\n", "x\x1cy z w \x85", "é  ü", "a"]
    starts, codes, distinct = words_of(texts)
    got = [[distinct[c].decode() for c in codes[starts[k] : starts[k + 1]]] for k in range(len(texts))]
    assert got == [brute.words(t) for t in texts]
    assert list(slices([])) == [] and list(slices([None, "a"])) == [(0, 2)]


# Language ID


def test_language_query_on_held_out(spark):
    got = entry.queries()["op5_language_id"](spark, SF)
    joined = got.join(table(spark, SF, "documents").select("doc_id", "lang", "text"), "doc_id")
    assert got.count() == table(spark, SF, "documents").count()
    held = joined.where("held_out and lang is not null and length(text) > 30")
    assert held.where("lang_pred = lang").count() >= 0.97 * held.count() > 0
    assert joined.where("score < 0 or score > 1").count() == 0


def test_language_of_odd_rows(spark):
    model = language_id.LanguageModel.fit(table(spark, SF, "documents"), rows_per_lang=100)
    df = spark.createDataFrame([(None, None, 1), (1, "", 2), (2, "12 34 !?", 3), (3, "the and of " * 50_000, 4)], "doc_id long, text string, score int")
    got = model.predict(df.select("doc_id", "text"), keep=["doc_id"]).collect()
    assert [(r["lang_pred"], r["score"]) for r in got[:3]] == [("und", 0.0)] * 3 and got[3]["lang_pred"] == "en"
    empty = language_id.LanguageModel.fit(df.select("doc_id", "text", F.lit(None).cast("string").alias("lang")))
    assert {r["lang_pred"] for r in empty.predict(df.select("doc_id", "text")).collect()} == {"und"}
    one = language_id.LanguageModel.fit(df.select("doc_id", "text", F.lit("en").alias("lang")))
    assert one.predict(df.where("doc_id = 3").select("text")).collect()[0]["lang_pred"] == "en"
    assert rows(model.predict(df.limit(0).select("text"))) == []


def test_keep_known_keeps_columns(spark):
    docs = table(spark, SF, "documents").withColumn("score", F.lit(5))
    kept = language_id.keep_known(docs)
    assert kept.columns == docs.columns and kept.where("score <> 5").count() == 0
    assert kept.count() >= 0.98 * docs.where("text rlike '[a-z]'").count()


@pytest.mark.parametrize("n", [2, 3, 4, 5, 9, 40])
def test_codewords_differ(n):
    words = language_id.codewords(n)
    assert len({tuple(w) for w in words}) == n
    assert all(abs(c.sum()) < n for c in words.T)


# Chat formatting


def chat(spark, data, **options):
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    return chat_format.windows(df, lambda c: F.size(F.split(c, " ")).cast("long"), **options)


def expected_chat(data):
    out, by = {}, {}
    for conv, turn, role, text in data:
        by.setdefault(conv, []).append((turn, role or "", text or ""))
    for conv, turns in by.items():
        turns.sort()
        full = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(full.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_chat_round_trip(spark):
    rng = random.Random(2)
    bits = ["</s>", "<s>", "[INST] ok [/INST]", "\\", "\\n", "\n", "<\\s>", "<<SYS>>", "<|im_end|>", "é", " ", "word " * 30, "<", "s>"]
    data = []
    for conv in range(40):
        for turn in range(rng.randrange(1, 30)):
            role = "system" if turn == 0 and conv % 2 else rng.choice(["user", "assistant", "tool\nx", None])
            data.append((conv, turn, role, rng.choice([None, "".join(rng.choices(bits, k=rng.randrange(0, 12)))])))
    data += [(None, 1, "assistant", "alone"), (77, 1, "assistant", "tie"), (77, 1, "user", "tie"), (77, 1, "user", "tie"), (78, None, "user", "x")]
    made = chat(spark, data, budget=300, history=2, history_budget=80)
    got = {r[0]: tuple(r[1:5]) for r in queries.read_back(made).collect()}
    assert got == expected_chat([(c, -1 if t is None else t, r, x) for c, t, r, x in data])
    for r in made.collect():
        assert r["n_tokens"] <= 300 or r["over_budget"]
        assert r["n_turns"] == len(chat_format.parse(r["formatted"]))
        if r["window"]:
            assert r["n_repeated"] <= 3
            system = [x for c, t, role, x in data if c == r["conv_id"] and t == 0 and role == "system"]
            assert not system or chat_format.parse(r["formatted"])[0] == ("system", system[0] or "")
    single = {r["conv_id"] for r in made.where("over_budget").collect()}
    assert all(any(len((x or "").split(" ")) > 80 for c, _, _, x in data if c == conv) for conv in single)


def greedy_windows(turns, budget, history, history_budget, markup=8):
    """(first, turns shown, turns repeated, tokens) by filling window after window."""
    n = [len(text.split(" ")) + markup for _, text in turns]
    system = n[0] if turns[0][0] == "system" else 0
    out, at = [], 0
    while at < len(turns):
        total, repeated = n[at] + (system if at else 0), 1 if at and system else 0
        held = 0
        for k in range(at - 1, max(at - history, 1 if system else 0) - 1, -1):
            if held + n[k] > history_budget or total + held + n[k] > budget:
                break
            held, repeated = held + n[k], repeated + 1
        total, end = total + held, at + 1
        while end < len(turns) and total + n[end] <= budget:
            total, end = total + n[end], end + 1
        out.append((at, end - at + repeated, repeated, total))
        at = end
    return out


@pytest.mark.parametrize("span", [1, 400, 1 << 20])
def test_chat_windows_equal_greedy_ones(spark, span):
    rng = random.Random(span)
    data, expected = [], set()
    for conv in [None, *range(25), 2**53 + 1]:
        longest = rng.choice([4, 40, 150])
        roles = ["system" if rng.random() < 0.5 else "user"] + [rng.choice(["user", "assistant", "system"]) for _ in range(rng.randrange(80))]
        turns = [(role, " ".join(["w"] * (1 + rng.choice([rng.randrange(longest), 900 * (rng.random() < 0.02), 1])))) for role in roles]
        data += [(conv, k, role, text) for k, (role, text) in enumerate(turns)]
        expected |= {(conv, *w) for w in greedy_windows(turns, 200, 3, 60)}
    made = chat(spark, data, budget=200, history=3, history_budget=60, span=span)
    got = [tuple(r) for r in made.select("conv_id", "window", "n_turns", "n_repeated", "n_tokens").collect()]
    assert len(got) == len(expected) and set(got) == expected
    assert made.where("over_budget != (n_tokens > 200)").count() == 0


def test_chat_ids_beyond_doubles_beside_a_null(spark):
    data = [(c, 0, "user", "a") for c in (None, 2**53, 2**53 + 1)]
    got = {r[0]: tuple(r[1:5]) for r in queries.read_back(chat(spark, data)).collect()}
    assert got == expected_chat(data) and len(got) == 3


def test_chat_of_one_hot_conversation(spark):
    data = [(5, k, "assistant" if k % 2 else "user", f"text {k} " + "w " * (k % 50)) for k in range(3000)]
    made = chat(spark, data, budget=200)
    assert {r[0]: tuple(r[1:5]) for r in queries.read_back(made).collect()} == expected_chat(data)
    assert made.where("over_budget").count() == 0
    assert chat(spark, []).count() == 0


def test_escape_is_reversible_and_hides_control_strings():
    rng = random.Random(8)
    pieces = ["\\", "n", "<", "s", ">", "/", "[", "INST", "]", "|", "im_start", *chat_format.CONTROL]
    for _ in range(3000):
        text = "".join(rng.choices(pieces, k=8))
        hidden = chat_format.escape(text)
        assert chat_format.unescape(hidden) == text
        assert not any(c in hidden for c in chat_format.CONTROL)


# BPE


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_file("byte_bpe_50k.json"))


def settings():
    return queries.tokenizer_file("byte_bpe_50k.json"), queries.tokenizer_file("byte_bpe_50k.tiktoken"), queries.fast_pattern()


def test_bpe_query(spark, library):
    docs = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").select("doc_id", "text").collect()}
    for key, n, ids_hash, text_hash in rows(entry.queries()["op7_bpe_codec"](spark, SF)):
        ids = library.encode(docs[key] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert n == len(ids) and ids_hash == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert text_hash == hashlib.sha256(text.encode()).hexdigest()


def test_reused_chunks_repair_to_the_whole_encoding(library):
    rng = random.Random(5)
    coder = bpe.Codec(*settings())
    bits = ["hello", " world", "  ", "\n", "\t", "é", "<|endoftext|>", "'ll", "123", " 45", "日本", "!!", " ", "x" * 50, " the", "\r\n", "\x85"]
    shared = "".join(rng.choices(bits, k=900))
    texts = ["".join(rng.choices(bits, k=rng.randrange(0, 400))) + shared + "".join(rng.choices(bits, k=30)) for _ in range(20)]
    texts += ["", " ", "a", "x" * 9000, " " * 9000, "日本語" * 3000, "<|endoftext|>" * 40, shared, shared[3:], "a b " * 4000]
    known = {}
    for t in texts:
        start = 0
        for end in bpe.cuts(t):
            chunk = t[start:end]
            span = bpe.body(chunk)
            if span and rng.random() < 0.7:
                known[bpe.chunk_key(chunk)] = np.array(coder.encode(chunk[span[0] : span[1]]), np.int32).tobytes()
            start = end
        assert start == len(t)
    assert known
    for t in texts:
        ids = library.encode(t, add_special_tokens=False).ids
        assert bpe.encode_reusing(coder, t, known) == ids == coder.encode(t)
        assert coder.decode(ids) == library.decode(ids, skip_special_tokens=False) == t


def test_bpe_of_long_text_in_pieces(library, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 1000)
    text = "".join(random.Random(1).choices(["ab ", "c\n", "  ", "d", "<|endoftext|>", "é"], k=20_000))
    assert bpe.Codec(*settings()).encode(text) == library.encode(text, add_special_tokens=False).ids


def test_bpe_finds_shared_chunks(spark):
    rng = random.Random(6)
    passage = " ".join(f"word{rng.randrange(5000)}" for _ in range(2000))
    df = docs_of(spark, [f"start {k} " + passage + f" end {k}" for k in range(6)] + [None, ""])
    known = bpe.shared_chunks(df, settings())
    assert len(known) > 10
    out = bpe.encode_documents(df.withColumn("decoded", F.lit(1)), *settings()).collect()
    assert [r["decoded"] for r in out] == [r["text"] or "" for r in out] and out[0]["token_ids"]
    assert bpe.shared_chunks(df, settings(), most_bytes=0) == {}
    assert rows(bpe.digests(df.limit(0), *settings())) == []


# Licences


def plain_passages(text, threshold=0.8):
    """All passages of a small text by brute force: best dice a licence."""
    w = licenses.normalised(text.encode()).decode().split()
    best = {}
    for name, texts in licenses.TEMPLATES.items():
        for t in texts:
            u = licenses.normalised(t.encode()).decode().split()
            known = set(zip(u, u[1:]))
            for i in range(len(w)):
                for j in range(i + 2, min(len(w), i + 2 * len(u)) + 1):
                    got = set(zip(w[i:j], w[i + 1 : j]))
                    best[name] = max(best.get(name, 0), 2 * len(got & known) / (len(got) + len(known)))
    return {n: d for n, d in best.items() if d >= threshold}


def test_license_passages(spark):
    rng = random.Random(3)
    filler = lambda n: " ".join(f"f{rng.randrange(99)}" for _ in range(n))
    texts = [None, "", "MIT", filler(50), "released under the mit license", f"{filler(20)}\nReleased under the MIT License!\n{filler(9)}",
             f"{filler(5)} {licenses.TEMPLATES['ISC'][0]} {filler(5)}",
             f"{filler(5)} {licenses.TEMPLATES['ISC'][0].replace('software', 'library')} Licensed under CC BY-NC 4.0."]
    got = {}
    for key, name, dice, first, n in rows(licenses.scan(docs_of(spark, texts))):
        got.setdefault(key, {})[name] = dice
    for k, text in enumerate(texts):
        wanted = plain_passages(text or "")
        assert set(got.get(k, {})) <= set(wanted) and bool(got.get(k)) == bool(wanted)
        if wanted:
            assert max(got[k].values()) == pytest.approx(max(wanted.values()))
    assert set(got) == {4, 5, 6, 7} and set(got[7]) == {"ISC", "CC-BY-NC-4.0"}
    assert rows(licenses.scan(docs_of(spark, texts).limit(0))) == []
    assert rows(licenses.scan(docs_of(spark, texts), templates={})) == []


NOTICES = {
    "GPL-2.0": "{p} is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
    "by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. {p} is distributed in the hope "
    "that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
    "PURPOSE. See the GNU General Public License for more details.",
}
NOTICES["GPL-3.0"] = NOTICES["GPL-2.0"].replace("version 2", "version 3")
NOTICES["AGPL-3.0"] = NOTICES["GPL-3.0"].replace("GNU General", "GNU Affero General")
NOTICES["LGPL-3.0"] = NOTICES["GPL-3.0"].replace("GNU General", "GNU Lesser General")
NOTICES["LGPL-2.1"] = NOTICES["GPL-2.0"].replace("GNU General", "GNU Lesser General").replace("version 2", "version 2.1")
NOTICES["LGPL-2.0"] = NOTICES["GPL-2.0"].replace("GNU General", "GNU Library General").replace("{p}", "This library")


def test_every_notice_has_its_own_label(spark):
    given = [(n, t.replace("{p}", p)) for n, t in NOTICES.items() for p in ("This program", "This file")]
    given += [(n, t) for n, texts in licenses.TEMPLATES.items() for t in texts]
    got = {}
    for r in licenses.scan(docs_of(spark, [f"Some words first. {t} And then more." for _, t in given])).collect():
        got.setdefault(r["doc_id"], set()).add(r["license"])
    assert [(k, n, got.get(k)) for k, (n, _) in enumerate(given) if got.get(k) != {n}] == []
    more = {"EPL-1.0", "EPL-2.0", "EUPL-1.1", "EUPL-1.2", "Zlib", "BSL-1.0", "Artistic-2.0", "WTFPL", "0BSD", "CC-BY-ND-4.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0"}
    assert more <= set(licenses.TEMPLATES)


def test_license_repeated_very_often_takes_linear_time():
    for name in ("ISC", "MIT"):
        templates = {name: licenses.TEMPLATES[name][-1:]}
        ((_, _, known, length),) = licenses.prepared(templates)
        _, pairs = licenses.bigrams([" ".join(templates[name] * 100)])
        found = licenses.disjoint(licenses.passages(pairs, known, length, 0.8))
        assert len(found) >= 99 and all(d >= 0.8 for d, _, _ in found)
        assert all(a[2] < b[1] for a, b in zip(found, found[1:]))


def test_license_query_finds_all_planted_lines(spark):
    docs = table(spark, SF, "documents")
    lines = docs.where("text rlike 'Released under the MIT License|Licensed under the Apache License|Licensed under CC BY-NC|GNU General Public License'")
    got = entry.queries()["op10_license_scan"](spark, SF)
    assert got.select("doc_id").distinct().count() == lines.count() > 0


# Secrets


def test_secret_query(spark):
    folder = "/root/testdata/sf0.01"  # the smallest table has no planted secret
    docs = table(spark, folder, "documents")
    got = entry.queries()["op3_secret_scan"](spark, folder)
    wanted = docs.where(F.col("text").rlike(r'AKIA[0-9A-Z]{16}|password=[0-9a-f]{16}|token = "[0-9a-f]{16}')).select("doc_id")
    hits = got.where("is_secret").select("doc_id").distinct()
    assert wanted.count() > 0 and wanted.join(hits, "doc_id", "left_anti").count() == 0
    assert hits.join(wanted, "doc_id", "left_anti").count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_secrets_from_labels_and_odd_rows(spark):
    rng = random.Random(4)
    key = lambda: "".join(rng.choices("0123456789abcdef", k=32))
    texts = [f"the value is secret = {key()} here" for _ in range(40)] + [f"commit {key()} was merged" for _ in range(40)]
    texts += [None, "", "x" * 50_000, "password=" + key()]
    df = docs_of(spark, texts, "src/app.py").withColumn("value", F.lit(1)).withColumn("length", F.lit(2))
    found = secrets.findings(df)
    assert found.where("key < 80").count() == 80
    labels = found.where("key < 80").select(F.col("key").alias("doc_id"), "place", (F.col("key") < 40).cast("int").alias("label"))
    got = {r["doc_id"]: r["is_secret"] for r in secrets.scan(df, labels, trees=10).where("doc_id < 80 or doc_id = 83").collect()}
    assert all(got[k] for k in range(40)) and not any(got[k] for k in range(40, 80)) and got[83]
    assert rows(secrets.scan(df.limit(0))) == []
    assert secrets.scan(df.where("doc_id = 3")).collect()[0]["score"] == 1.0


def test_several_secrets_in_one_token(spark):
    rng = random.Random(8)
    a, b = ("".join(rng.choices("0123456789abcdef", k=32)) for _ in range(2))
    aws, known = "wJalrXUtnFEMI/K7MDENG/bPxRfiCY" + "0123456789", "AKIA" + "Q7" * 8
    texts = [f'{{"a":"{a}","b":"{b}"}}', f"https://api.example.com/v1/accounts/list/all?key={known}", f'{{"aws_secret_access_key":"{aws}"}}',
             f"var x='{a}'+'{b}';", f"password={a}", f'token = "{b}"', f"{a}=="]
    found = secrets.findings(docs_of(spark, texts, "src/app.py")).collect()
    got = {(r["key"], r["name"], r["value"]): r["address"] for r in found}
    wanted = [(0, "a", a), (0, "b", b), (1, "key", known), (2, "aws_secret_access_key", aws), (3, "x", a), (3, "", b),
              (4, "password", a), (5, "", b), (6, "", a + "==")]
    assert all(w in got and not got[w] for w in wanted)
    assert len({(r["key"], r["place"], r["field"], r["run"]) for r in found}) == len(found)
    scored = {(r["doc_id"], r["value"]): r["score"] for r in secrets.scan(docs_of(spark, texts, "src/app.py")).collect()}
    assert {(k, v) for k, _, v in wanted} <= set(scored)


# Decontamination

ITEM = "A train leaves Boston at 60 km per hour and another train leaves after 3 hours. How many hours until it arrives in Boston again?"


def leaks_of(spark, texts, items):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r["doc_id"], r["item_id"]): r for r in decontamination.leaks(docs_of(spark, texts), bench).collect()}


def test_reparameterised_questions(spark):
    other = ITEM.replace("Boston", "New York").replace("60", "85").replace(" 3 ", " 7 ")
    broken = ITEM.replace("leaves Boston", "leaves Paris")
    rng = random.Random(1)
    filler = lambda n: " ".join(f"f{rng.randrange(999)}" for _ in range(n))
    texts = [f"{filler(30)}. {ITEM} {filler(9)}", f"{filler(4)}. {other}", filler(300), None, "", ITEM[:50], f"{filler(3)}. {broken}", "7 8 9 10 11"]
    got = leaks_of(spark, texts, [ITEM, "", None, "1 2 3 4 5", filler(40)])
    assert set(got) == {(0, 0), (1, 0)} | ({(6, 0)} & set(got))
    assert got[0, 0]["verbatim"] and not got[1, 0]["verbatim"] and (6, 0) not in got


def test_short_items_and_empty_tables(spark):
    got = leaks_of(spark, ["well, what is gravity? yes", "gravity is what", "one two three four five"], ["What is gravity?", "Four five"])
    assert set(got) == {(0, 0), (2, 1)}
    assert leaks_of(spark, [], ["a b c"]) == {} and leaks_of(spark, ["a b c"], []) == {}


def test_one_altered_value_and_coincident_numbers(spark):
    item = (
        f"{ITEM} Explain each step of your work in plain words and then write down the final answer on a separate line below all of the "
        "steps that you took so that a reader can follow and check them one by one without any further help."
    )
    roads = "We drive for 2 hours in the rain and then we wait beside 2 trains until the guard waves. How far did we go?"
    texts = [item.replace("leaves Boston", "leaves Paris"), roads.replace("2 hours", "3 hours").replace("2 trains", "5 trains"), roads]
    got = leaks_of(spark, texts, [item, roads])
    assert set(got) == {(0, 0), (1, 1), (2, 1)}
    assert 0.8 <= got[0, 0]["containment"] < 1 and not got[0, 0]["verbatim"] and got[1, 1]["containment"] == 1 and got[2, 1]["verbatim"] and not got[1, 1]["verbatim"]


def test_repeated_benchmark_rows_and_two_texts_of_an_item(spark):
    other = "The quick chemist mixes two clear liquids in a tall glass and waits until the colour turns from blue to green."
    texts = [f"so we ask. {ITEM}", f"as they say. {other}", "nothing of the kind"]
    bench = spark.createDataFrame([(0, ITEM), (0, ITEM), (0, ITEM), (1, ITEM), (1, other), (1, other)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["containment"], r["verbatim"]) for r in decontamination.leaks(docs_of(spark, texts), bench).collect()}
    assert got == {(0, 0): (1.0, True), (0, 1): (1.0, True), (1, 1): (1.0, True)}


def test_decontamination_query(spark):
    found = {(r["doc_id"], r["item_id"]) for r in entry.queries()["op1_decontamination"](spark, SF).collect()}
    items = {r["item_id"]: " ".join(r["text"].split()) for r in table(spark, SF, "benchmark").collect()}
    exact, near = set(), set()
    for r in table(spark, SF, "documents").collect():
        text = " ".join((r["text"] or "").split())
        have = {tuple(w) for w in zip(*[text.lower().split()[k:] for k in range(5)])}
        for item, t in items.items():
            w = t.lower().split()
            own = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
            if t in text:
                exact.add((r["doc_id"], item))
            if own and sum(o in have for o in own) >= 0.5 * len(own):
                near.add((r["doc_id"], item))
    assert exact and exact <= found <= near


def test_clean_documents_stay(spark):
    docs, bench = docs_of(spark, [ITEM, "clean text", None]), spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert sorted(r["doc_id"] for r in decontamination.keep_clean(docs, bench).collect()) == [1, 2]


def test_bitmap_passes_all_members(spark):
    values = [random.Random(k).randrange(-(2**63), 2**63) for k in range(500)]
    bits = decontamination.bitmap(spark.createDataFrame([(v,) for v in values], "h long"), 14)
    place = np.array(values, np.int64).view(np.uint64) >> np.uint64(50)
    assert ((bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1)).all()
    assert sum(int(b).bit_count() for b in bits) <= 500
