"""BPE encoding and decoding that reuses content-defined chunks.

A rolling hash over the last ROLL characters cuts texts into chunks of about
AVERAGE characters, so passages shared by documents give equal chunks wherever
they stand. Chunk hashes are counted over the corpus; a chunk that occurs more
than once is encoded once, and its ids are put into every text that holds it.

A chunk's ids hold for any text only between its first and last safe cut: a
place after a non-space and before a space or line end, where no token of this
pre-tokeniser can cross and nothing to the left changes what follows. At every
join the text from the last safe cut of one chunk to the first of the next is
encoded again; where a chunk has no safe cut the repair runs on into the next
chunk, until both sides agree on a cut. So the ids equal those of the whole text.

Chunk ids go to the tasks as one broadcast of at most DICTIONARY_BYTES, those
that save most first. Chunks beyond it lose nothing: they are encoded in place.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from pricegrid.llm.common import map_rows


ROLL = 32
AVERAGE = 512
SHORTEST, LONGEST = 64, 4096
DICTIONARY_BYTES = 16 << 20
PIECE = 1 << 22  # characters encoded in one call at most, cut at safe places
_SAFE = re.compile(r"(?<=\S)(?=[ \n])")
_CUT_AT = (1 << 64) // AVERAGE


def cuts(text):
    """Ends of a text's chunks, the text's length last.

    A chunk ends where the hash of the last ROLL characters is small; a chunk
    shorter than SHORTEST runs on, and one without such a place ends after
    LONGEST characters.
    """
    n = len(text)
    if n <= SHORTEST:
        return [n] if n else []
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    powers = np.full(ROLL, 0x9E3779B97F4A7C15, np.uint64)
    powers = np.multiply.accumulate(powers)
    rolled = np.zeros(n - ROLL + 1, np.uint64)
    step, span = points, 1  # doubling: hashes of 2, 4, ... characters
    while span < ROLL:
        step = step[:-span] * powers[span - 1] + step[span:]
        span *= 2
    rolled = step * np.uint64(0xBF58476D1CE4E5B9)
    rolled ^= rolled >> np.uint64(32)
    rolled *= np.uint64(0x94D049BB133111EB)
    marks = np.flatnonzero(rolled < np.uint64(_CUT_AT)) + ROLL
    ends, last = [], 0
    for mark in marks.tolist():
        while mark - last > LONGEST:
            last += LONGEST
            ends.append(last)
        if mark - last >= SHORTEST:
            ends.append(mark)
            last = mark
    while n - last > LONGEST:
        last += LONGEST
        ends.append(last)
    if last < n:
        ends.append(n)
    return ends


def body(chunk):
    """(first, last) safe cut within a chunk; None if it has fewer than two."""
    first = _SAFE.search(chunk, 1)
    if not first:
        return None
    end = max(chunk.rfind(" "), chunk.rfind("\n"))
    while end > first.start() and chunk[end - 1].isspace():
        end = max(chunk.rfind(" ", 0, end), chunk.rfind("\n", 0, end))
    return (first.start(), end) if end > first.start() and not chunk[end - 1].isspace() else None


def chunk_key(chunk):
    return xxhash.xxh3_128_digest(chunk.encode("utf-8", "surrogatepass"))


class Codec:
    """Ids of texts as the tokenizers library gives them for a byte-level BPE file.

    `ranks_path` names the same vocabulary as ranks, whose encoder is some four
    times as fast; special strings in a text become their ids as in the library.
    Without it the library itself encodes.
    """

    def __init__(self, path, ranks_path=None, pattern=None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = {t.content: k for k, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.fast = None
        if ranks_path:
            import tiktoken

            with open(ranks_path, "rb") as file:
                ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            self.bytes = {k: b for b, k in ranks.items()} | {k: c.encode() for c, k in self.special.items()}

    def piece(self, text):
        if self.fast is None:
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        ids = []
        for part in self.split.split(text) if self.split else [text]:
            if part in self.special:
                ids.append(self.special[part])
            elif part:
                ids.extend(self.fast.encode_ordinary(part))
        return ids

    def encode(self, text):
        """A text of any length, in parts cut at safe places."""
        if len(text) <= PIECE:
            return self.piece(text)
        ids, at = [], 0
        while at < len(text):
            found = _SAFE.search(text, at + PIECE)
            end = found.start() if found else len(text)
            ids.extend(self.piece(text[at:end]))
            at = end
        return ids

    def decode(self, ids):
        """As decode(ids, skip_special_tokens=False) of the library."""
        if self.fast is None:
            return self.tokenizer.decode(ids, skip_special_tokens=False)
        table = self.bytes
        return b"".join([table[k] for k in ids]).decode("utf-8", "replace")


def codec(settings, cache={}):  # noqa: B006  one codec a Python worker
    if settings not in cache:
        cache[settings] = Codec(*settings)
    return cache[settings]


def encode_reusing(coder, text, known):
    """Ids of a whole text; `known` has the body ids (int32 bytes) of chunks by key.

    Text between known bodies is encoded in one go, which repairs the joins.
    Equal to coder.encode(text) whatever is known.
    """
    if not known:
        return coder.encode(text)
    ids, done, start = [], 0, 0
    for end in cuts(text):
        chunk = text[start:end]
        held = known.get(chunk_key(chunk))
        if held is not None:
            first, last = body(chunk)
            if done < start + first:
                ids.extend(coder.encode(text[done : start + first]))
            ids.extend(np.frombuffer(held, np.int32).tolist())
            done = start + last
        start = end
    if done < len(text):
        ids.extend(coder.encode(text[done:]))
    return ids


def shared_chunks(docs, settings, text="text", most_bytes=DICTIONARY_BYTES):
    """{chunk key: body ids as int32 bytes} of chunks that occur more than once in `docs`.

    Chunks are counted by hash over all documents (only hashes are shuffled);
    those that save most characters are then read once more and encoded once
    each. The result is bounded by most_bytes, as ids of two or four bytes.
    """

    def count(batches):
        for batch in batches:
            keys, sizes = [], []
            for t in batch[text]:
                start = 0
                for end in cuts(t or ""):
                    keys.append(chunk_key(t[start:end]))
                    sizes.append(end - start)
                    start = end
            frame = pd.DataFrame({"k": keys, "size": sizes})
            yield frame.groupby("k", sort=False).agg(size=("size", "first"), n=("size", "size")).reset_index()

    counted = docs.select(text).mapInPandas(count, "k binary, size int, n long")
    repeated = counted.groupBy("k").agg(F.max("size").alias("size"), F.sum("n").alias("n")).where("n > 1")
    # Ids take at most 4 bytes a character, so so many chunks fit the bound.
    room = most_bytes // (4 * AVERAGE // 2)
    best = repeated.orderBy(F.desc(F.col("size") * (F.col("n") - 1)), "k").limit(room)
    chosen = {bytes(r["k"]) for r in best.select("k").toPandas().to_dict("records")}
    if not chosen:
        return {}
    wanted = docs.sparkSession.sparkContext.broadcast(chosen)

    def fetch(batches):
        for batch in batches:
            found = {}
            for t in batch[text]:
                start = 0
                for end in cuts(t or ""):
                    key = chunk_key(t[start:end])
                    if key in wanted.value and key not in found:
                        found[key] = t[start:end]
                    start = end
            if found:
                yield pd.DataFrame({"k": list(found), "chunk": list(found.values())})

    once = docs.select(text).mapInPandas(fetch, "k binary, chunk string").dropDuplicates(["k"])

    def encode(batches):
        for batch in batches:
            coder = codec(settings)
            keys, held = [], []
            for key, chunk in zip(batch["k"], batch["chunk"]):
                span = body(chunk)
                if span:
                    keys.append(key)
                    held.append(np.array(coder.encode(chunk[span[0] : span[1]]), np.int32).tobytes())
            yield pd.DataFrame({"k": keys, "ids": held})

    known, held = {}, 0
    for row in once.mapInPandas(encode, "k binary, ids binary").toPandas().itertuples():
        held += len(row.ids)
        if held > most_bytes:
            break
        known[bytes(row.k)] = bytes(row.ids)
    return known


def encode_documents(docs, path, ranks_path=None, pattern=None, text="text", check=True):
    """All rows with columns `token_ids` (array<int>) and `decoded` beside their own.

    Null texts are empty. Columns of `docs` with these names are replaced.
    """
    settings = (path, ranks_path, pattern)
    known = docs.sparkSession.sparkContext.broadcast(shared_chunks(docs, settings, text))

    def work(batch):
        coder = codec(settings)
        ids = [encode_reusing(coder, t or "", known.value) for t in batch.column(text).to_pylist()]
        return {"token_ids": ids, "decoded": [coder.decode(x) for x in ids]}

    return map_rows(docs, {"token_ids": ArrayType(IntegerType()), "decoded": StringType()}, work)


def digests(docs, path, ranks_path=None, pattern=None, key="doc_id", text="text"):
    """Per row: key, n_tokens and the SHA-256 of its ids and of its decoded text.

    The digests are taken where the ids are made, so no id leaves its task.
    """
    settings = (path, ranks_path, pattern)
    known = docs.sparkSession.sparkContext.broadcast(shared_chunks(docs, settings, text))
    made = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}

    def work(batch):
        coder, names = codec(settings), {}
        out = {name: [] for name in made}
        for t in batch.column("__text").to_pylist():
            ids = encode_reusing(coder, t or "", known.value)
            for new in set(ids) - names.keys():
                names[new] = str(new)
            joined = ",".join([names[x] for x in ids])
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(hashlib.sha256(joined.encode()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(coder.decode(ids).encode("utf-8", "replace")).hexdigest())
        return out

    return map_rows(docs.select(key, F.col(text).alias("__text")), made, work, drop=["__text"])
