"""Language identification with error-correcting output codes.

Every language gets a codeword of +1/-1 bits. Each bit is a binary naive-Bayes
classifier over hashed letter n-grams (1 to 3): the languages with +1 against
the rest. A text's margin for a bit is its mean log odds per n-gram, scaled to
the spread seen in training. Decoding sums the logistic loss of each bit's
margin against the codeword, weighted by how well the bit separates the
training texts, and takes the nearest codeword. A text whose two nearest
codewords lie closer than `gap` is flagged as ambiguous.

Training uses about `rows_per_lang` labelled texts a language, picked by hash
of the key; that is the only bound. Every text is read whole.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from pricegrid.llm.common import map_rows

DIMS = 1 << 14
PIECE = 1 << 20  # characters handled at once
UNKNOWN = "und"


def _letters():
    """For every code point: its number if it is a letter, else 0."""
    if not hasattr(_letters, "table"):
        points = np.arange(0x110000, dtype=np.uint32)
        is_letter = np.fromiter((chr(p).isalpha() for p in points), bool, len(points))
        _letters.table = np.where(is_letter, points, 0).astype(np.uint32)
    return _letters.table


def _bins(codes):
    """Hashed 1-, 2- and 3-grams of lower-case letters; 0 marks other characters.

    n-grams touch a word's edges but hold at least one letter; runs of other
    characters count as one edge.
    """
    codes = codes[(codes != 0) | (np.concatenate([[1], codes[:-1]]) != 0)].astype(np.uint32)
    one = codes * np.uint32(2654435761)
    two = (one[:-1] ^ (codes[1:] * np.uint32(40503) + np.uint32(77))) * np.uint32(2246822519)
    three = (two[:-1] ^ (codes[2:] * np.uint32(60493) + np.uint32(131))) * np.uint32(3266489917)
    some = codes != 0
    return [
        (one[some] ^ (one[some] >> np.uint32(15))) >> np.uint32(18),
        (two[some[:-1] | some[1:]]) >> np.uint32(18),
        three[some[1:-1]] >> np.uint32(18) if len(codes) > 2 else np.zeros(0, np.uint32),
    ]


def grams(text):
    """n-gram counts of a whole text over DIMS bins; None if it has no letter."""
    counts = np.zeros(DIMS, np.float32)
    found = False
    for k in range(0, len(text or ""), PIECE):
        piece = text[max(0, k - 2) : k + PIECE].lower()
        codes = _letters()[np.frombuffer(piece.encode("utf-32-le", "replace"), np.uint32)]
        if codes.any():
            found = True
            codes = np.concatenate([[0], codes, [0]]).astype(np.uint32)
            for part in _bins(codes):
                counts += np.bincount(part, minlength=DIMS)
    return counts if found else None


def codewords(n, seed=11):
    """n codewords of +1/-1: all different columns for few languages, else random.

    For up to five languages these are all ways to split them in two (Dietterich
    and Bakiri's exhaustive code); beyond, 16 log2(n) random bits.
    """
    if n <= 1:
        return np.ones((n, 1))
    if n <= 5:
        splits = [[1] + [1 if s >> k & 1 else -1 for k in range(n - 1)] for s in range(2 ** (n - 1) - 1)]
        return np.array(splits, float).T
    rng = np.random.default_rng(seed)
    words = rng.choice([-1.0, 1.0], (n, 16 * int(np.ceil(np.log2(n)))))
    words[0, np.abs(words.sum(axis=0)) == n] *= -1
    return words


class LanguageModel:
    """Languages, codewords, weights per n-gram bin and bit, bit weights."""

    def __init__(self, languages, words, weights, scales, trust, gap=0.1):
        self.languages, self.words, self.weights = languages, words, weights
        self.scales, self.trust, self.gap = scales, trust, gap

    @staticmethod
    def fit(docs, key="doc_id", text="text", lang="lang", rows_per_lang=1500, gap=0.1):
        """Learn from the rows of `docs` with a language; text is the only input.

        Per language the rows with the smallest hash of key and text are taken,
        cut at rows_per_lang over the language's row count, so about that many.
        The driver gets one count vector a language and one margin a text.
        """
        known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
            F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).alias("l")
        )
        sizes = {r["l"]: r["n"] for r in known.groupBy("l").agg(F.count("*").alias("n")).collect()}
        languages = sorted(sizes)
        if not languages:
            return LanguageModel([], np.ones((0, 1)), np.zeros((DIMS, 1), np.float32), np.ones(1), np.ones(1), gap)
        share = {name: min(1.0, rows_per_lang / n) for name, n in sizes.items()}
        place = (F.xxhash64("k", "t") % F.lit(1 << 30) + F.lit(1 << 30)) / F.lit(float(1 << 31))
        cut = None
        for name, part in share.items():
            cond = (F.col("l") == name) & (place <= part)
            cut = cond if cut is None else cut | cond
        picked = known.where(cut).select("k", "t", "l")
        index = {name: k for k, name in enumerate(languages)}

        def sums(batches):
            total = np.zeros((len(index), DIMS))
            for batch in batches:
                for name, t in zip(batch["l"], batch["t"]):
                    got = grams(t)
                    if got is not None:
                        total[index[name]] += got / got.sum()
            yield pd.DataFrame({"l": languages, "v": [row.tolist() for row in total]})

        summed = picked.mapInPandas(sums, "l string, v array<double>")
        exploded = summed.select("l", F.posexplode("v").alias("bin", "x")).where("x > 0")
        totals = exploded.groupBy("l", "bin").agg(F.sum("x").alias("x"))
        seen = np.zeros((len(languages), DIMS))
        for row in totals.toPandas().itertuples():
            seen[index[row.l], row.bin] = row.x
        seen /= np.maximum(seen.sum(axis=1, keepdims=True), 1e-12)
        words = codewords(len(languages))
        plus, minus = (words.T > 0) @ seen, (words.T < 0) @ seen
        plus /= np.maximum((words.T > 0).sum(axis=1, keepdims=True), 1)
        minus /= np.maximum((words.T < 0).sum(axis=1, keepdims=True), 1)
        weights = (np.log(plus + 1e-6) - np.log(minus + 1e-6)).T.astype(np.float32)
        draft = LanguageModel(languages, words, weights, np.ones(words.shape[1]), np.ones(words.shape[1]), gap)

        def margins(batches):
            for batch in batches:
                raw, some = draft.margins(batch["t"])
                if some.any():
                    yield pd.DataFrame({"l": batch["l"][some].tolist(), "m": [r.tolist() for r in raw[some]]})

        # One row of bits a sampled text: about rows_per_lang rows a language.
        held = picked.mapInPandas(margins, "l string, m array<double>").toPandas()
        if len(held):
            m = np.array(held["m"].tolist())
            target = words[[index[name] for name in held["l"]]]
            draft.scales = np.maximum(np.abs(m).mean(axis=0), 1e-9)
            right = ((m * target) > 0).mean(axis=0)
            draft.trust = np.log(np.clip(right, 0.5, 0.999) / np.clip(1 - right, 0.001, 0.5)) + 1e-3
        return draft

    def margins(self, texts):
        """Mean log odds per n-gram and bit, and which texts have letters."""
        raw, some = np.zeros((len(texts), self.words.shape[1])), np.zeros(len(texts), bool)
        for k, t in enumerate(texts):
            got = grams(t)
            if got is not None:
                used = np.flatnonzero(got)
                raw[k] = got[used] @ self.weights[used] / got[used].sum()
                some[k] = True
        return raw, some

    def decode(self, raw):
        """(best language index, score 0 to 1, ambiguous) of rows of margins."""
        scaled = 4 * raw / self.scales
        loss = np.stack([(np.logaddexp(0, -scaled * w) * self.trust).sum(axis=1) for w in self.words], axis=1)
        loss /= self.trust.sum()
        order = np.argsort(loss, axis=1, kind="stable")
        likely = np.exp(-loss * 4)
        score = np.take_along_axis(likely, order[:, :1], 1)[:, 0] / likely.sum(axis=1)
        if loss.shape[1] > 1:
            best, second = (np.take_along_axis(loss, order[:, k : k + 1], 1)[:, 0] for k in (0, 1))
            unsure = second - best < self.gap
        else:
            unsure = np.zeros(len(raw), bool)
        return order[:, 0], score, unsure

    def predict(self, docs, text="text", keep=()):
        """lang_pred, score and ambiguous for every row, beside the columns `keep`.

        Null texts, texts without letters and a model without languages give
        `und` with score 0. With keep=None all columns stay, the text too.
        """
        names = docs.columns if keep is None else list(keep)
        need = docs if keep is None else docs.select(*names, F.col(text).alias("__text"))
        column = text if keep is None else "__text"
        model = self

        def work(batch):
            raw, some = model.margins(batch.column(column).to_pylist())
            lang, score, unsure = np.full(len(some), UNKNOWN, object), np.zeros(len(some)), np.zeros(len(some), bool)
            if some.any() and model.languages:
                best, sure, close = model.decode(raw[some])
                lang[some] = np.array(model.languages, object)[best]
                score[some], unsure[some] = sure, close
            return {"lang_pred": lang, "score": score, "ambiguous": unsure}

        made = {"lang_pred": "string", "score": "double", "ambiguous": "boolean"}
        return map_rows(need, made, work, drop=[] if keep is None else ["__text"])


def held_out(key="doc_id"):
    """True for the fifth of the documents that is never learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def keep_known(docs, key="doc_id", text="text", lang="lang", **options):
    """The documents with a recognised language: `und` and ambiguous ones go.

    The model is fitted on the documents that are not held out. All columns and
    rows of the kept documents stay as they are. Where no document that may be
    learned from has a language, nothing can be told apart and all documents stay.
    """
    model = LanguageModel.fit(docs.where(~held_out(key)), key, text, lang, **options)
    if not model.languages:
        return docs
    names = {"lang_pred", "score", "ambiguous"} & set(docs.columns)
    if names:
        docs = docs.withColumnsRenamed({n: f"__own_{n}" for n in names})
    found = model.predict(docs, text, keep=None).where("lang_pred <> 'und' and not ambiguous")
    return found.drop("lang_pred", "score", "ambiguous").withColumnsRenamed({f"__own_{n}": n for n in names})
