"""Chat formatting with budgeted windows.

A turn is rendered as <s>role, newline, text</s>. Control strings inside roles
and texts are broken by a backslash after their first character and backslashes
are doubled, which `unescape` reverses exactly.

Windows hold whole turns and are filled greedily: a window starts with the first
turn not yet shown and takes turns while they fit. Every later window repeats the
conversation's system turn and up to `history` turns before its first, nearest
first, while they fit the history budget and leave room for the first new turn;
such repeated turns are never targets again. So the loss mask covers every
assistant turn exactly once. A turn that does not fit even beside the system turn
alone has a window of its own, marked as over the budget.

What a window repeats, and so where the next one starts, follows from its first
turn alone. So every turn gets a jump, found in the prefix sums of turn tokens, and
the windows are the jumps from turn 0 on. A conversation is cut into blocks of
`span` tokens, each with the few turns around it that its windows can reach. Per
block, the jumps and the way out from each possible first turn are one row; a walk
over these rows, in order, finds where each block is entered, and the blocks are
then walked side by side. No task holds a conversation; the walk over blocks keeps
one number.

The running sum is taken in two levels: within range partitions of
(conversation, turn), then over one row a partition and conversation, so no
task needs a whole conversation. Turns with equal numbers are ordered by role
and text. Null texts are empty, null roles are empty roles.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from pricegrid.session import stage

#: The control strings of the template and of common chat formats.
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>"]
OPEN, CLOSE = "<s>", "</s>"
AT_ONCE = 64  # texts whose encodings are held at the same time
_CONTROL = re.compile(r"\\|" + "|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(r"\\(\\|n)|" + "|".join(f"{re.escape(c[0])}\\\\{re.escape(c[1:])}" for c in CONTROL))
_TURN = re.compile(re.escape(OPEN) + r"([^\n]*)\n(.*?)" + re.escape(CLOSE), re.DOTALL)


def escape(text):
    return _CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text):
    def plain(m):
        if m[1]:
            return "\n" if m[1] == "n" else "\\"
        return m[0][0] + m[0][2:]

    return _ESCAPED.sub(plain, text)


def render(turns):
    """(formatted text, [start, end of every target's text]) of (role, text, target) rows."""
    parts, spans, at = [], [], 0
    for role, text, target in turns:
        head = f"{OPEN}{escape(role).replace(chr(10), chr(92) + 'n')}\n"
        body = escape(text)
        if target:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts.append(head + body + CLOSE)
        at += len(parts[-1])
    return "".join(parts), spans


def parse(formatted):
    """The (role, text) turns of a formatted text."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def token_counter(path):
    """Column function: tokens of a text under the tokenizer file at `path`."""

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        from tokenizers import Tokenizer

        cache = count_cache()
        if path not in cache:
            cache[path] = Tokenizer.from_file(path)
        plain, sizes = texts.fillna("").tolist(), []
        for k in range(0, len(plain), AT_ONCE):  # encodings are far larger than their texts
            sizes += [len(e.ids) for e in cache[path].encode_batch(plain[k : k + AT_ONCE], add_special_tokens=False)]
        return pd.Series(sizes, dtype="int64")

    return count


def count_cache(cache={}):  # noqa: B006  one tokenizer a Python worker
    return cache


def _jumps(budget, history, history_budget, block):
    """Row per block: where a window from each own turn ends and what it repeats.

    Turns come by conversation, block and number; a block that a batch ends in waits
    for the next one.
    """
    names = ["first", "jump", "held", "leave"]
    whole, lists = pa.int64(), pa.list_(pa.int64())

    def one(idx, n, upto, extra, own):
        own = np.flatnonzero(own)
        begin = upto - n
        # The system turn stands before every window but the first.
        free = budget - np.where(idx > 0, extra, 0)
        limit = np.minimum(history_budget, free - n)[own]
        repeats = np.zeros(len(own), np.int64)
        tokens, used, going = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64), np.ones(len(own), bool)
        for back in range(1, history + 1):
            at = np.maximum(own - back, 0)
            going &= (own >= back) & ~((idx[at] == 0) & (extra[at] > 0))
            tokens = tokens + np.where(going, n[at], 0)
            going &= tokens <= limit
            used, repeats = np.where(going, tokens, used), repeats + going
        ends = np.searchsorted(upto, begin[own] + free[own] - used, "right")
        jump = (idx[0] + np.maximum(ends, own + 1)).tolist()
        # Windows that start before the block leave it within its first `budget` tokens.
        first, past = int(idx[own[0]]), int(idx[own[-1]]) + 1
        doors = max(1, int(np.count_nonzero(begin[own] < begin[own[0]] // block * block + budget)))
        leave = jump.copy()
        for k in range(len(leave) - 1, -1, -1):
            if leave[k] < past:
                leave[k] = leave[leave[k] - first]
        return first, jump, repeats.tolist(), leave[:doors]

    def rows(table, finished):
        """A row for each block of the table, the last one only if `finished`; and the turns left over."""
        codes = table["conv_id"].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        blocks = table["block"].to_numpy()
        new = np.flatnonzero((codes[1:] != codes[:-1]) | (blocks[1:] != blocks[:-1])) + 1
        edges = [0, *new.tolist(), len(blocks)]
        edges = edges if finished else edges[:-1]
        rest = table.slice(edges[-1])
        columns = [table[c].to_numpy(zero_copy_only=False) for c in ("idx", "n", "upto", "sys_n", "own")]
        heads, made = [], []
        for a, b in zip(edges, edges[1:]):
            if columns[-1][a:b].any():  # no window starts in a block without turns of its own
                heads.append(a)
                made.append(one(*[c[a:b] for c in columns]))
        taken = table.select(["conv_id", "block"]).take(pa.array(heads, whole)).combine_chunks()
        found = [pa.array(c, t) for c, t in zip(zip(*made) if made else [()] * 4, (whole, lists, lists, lists))]
        arrays = [c.combine_chunks() for c in taken.columns] + found
        return pa.RecordBatch.from_arrays(arrays, ["conv_id", "block", *names]), rest

    def run(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            if table.num_rows:
                made, rest = rows(table, False)
                yield made
        if rest is not None and rest.num_rows:
            yield rows(rest, True)[0]

    return run


def _enter(batches):
    """First turn of the walk in every block it enters; rows come by conversation and block."""
    last, at = (), 0
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if last != (r["conv_id"],):
                last, at = (r["conv_id"],), 0
            if 0 <= at - r["first"] < len(r["leave"]):
                out.append((r["conv_id"], r["block"], at))
                at = r["leave"][at - r["first"]]
        kinds = (batch.schema.field("conv_id").type, pa.int64(), pa.int64())
        columns = zip(*out) if out else ([], [], [])
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], ["ec", "eb", "at"])


def _walk(batches):
    """The windows of every block from the turn at which it is entered."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            at, first, jump = r["at"], r["first"], r["jump"]
            while at - first < len(jump):
                out.append((r["conv_id"], at, jump[at - first] - 1, r["held"][at - first]))
                at = jump[at - first]
        kinds = (batch.schema.field("conv_id").type, pa.int64(), pa.int64(), pa.int64())
        columns = zip(*out) if out else ([], [], [], [])
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], ["conv_id", "first", "last", "held"])


def _spans(numbered, budget, history, history_budget, span):
    """(conv_id, first, last, held) of every window, held turns before it repeated."""
    block = max(span, budget + history_budget)
    conv = numbered.schema["conv_id"].dataType.simpleString()
    begin = F.col("upto") - F.col("n")
    home = F.floor(begin / block).cast("long")
    offset = begin - home * block
    near = F.array(
        F.struct(home.alias("block"), F.lit(True).alias("own")),
        F.when((home > 0) & (offset < budget), F.struct((home - 1).alias("block"), F.lit(False).alias("own"))),
        F.when(offset >= block - history_budget, F.struct((home + 1).alias("block"), F.lit(False).alias("own"))),
    )
    dealt = numbered.select("*", F.explode(F.filter(near, lambda x: x.isNotNull())).alias("x")).select(*numbered.columns, "x.*")
    sorted_turns = dealt.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "idx")
    kept = sorted_turns.mapInArrow(
        _jumps(budget, history, history_budget, block),
        f"conv_id {conv}, block long, first long, jump array<long>, held array<long>, leave array<long>",
    )
    kept = stage(kept, "chat-jumps")
    entered = kept.select("conv_id", "block", "first", "leave").repartition("conv_id").sortWithinPartitions("conv_id", "block")
    entered = entered.mapInArrow(_enter, f"ec {conv}, eb long, at long")
    met = F.col("conv_id").eqNullSafe(F.col("ec")) & (F.col("block") == F.col("eb"))
    walked = kept.join(entered, met).select("conv_id", "first", "jump", "held", "at")
    return walked.mapInArrow(_walk, f"conv_id {conv}, first long, last long, held long")


def windows(turns, tokens, budget=1024, history=2, history_budget=256, markup=8, span=1 << 20):
    """Windows of a (conv_id, turn, role, text) table; other columns are ignored.

    `tokens` maps a text column to a token count; `markup` is added a turn, which
    counts at least one. `span` sets the work of a task, not the result.
    Returns conv_id, window (running number by first turn), n_repeated (turns at
    the head that repeat earlier ones), n_turns, n_tokens, over_budget, formatted
    and mask (start and end of each target's characters). An empty table gives
    no window. conv_id may be null, which is a conversation of its own.
    """
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    order = ["conv_id", "turn", "role", "text"]
    dealt = rows.repartitionByRange("conv_id", "turn", "role")  # tokens are counted after it, once
    dealt = stage(dealt.withColumn("part", F.spark_partition_id()).withColumn("n", F.greatest(tokens(F.col("text")) + markup, F.lit(1))), "chat-turns")

    # Level one: sums inside a partition; level two: one row a partition and conversation.
    inside = Window.partitionBy("part", "conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    slim = dealt.select(
        "part", *order, "n", F.sum("n").over(inside).alias("upto"), F.count("*").over(inside).alias("idx")
    )
    heads = dealt.groupBy("conv_id", "part").agg(F.sum("n").alias("n"), F.count("*").alias("c")).select(
        F.col("conv_id").alias("hc"), F.col("part").alias("hp"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"),
        F.coalesce(F.sum("c").over(before), F.lit(0)).alias("c0"),
    )
    placed = slim.join(heads, (F.col("conv_id").eqNullSafe(F.col("hc"))) & (F.col("part") == F.col("hp"))).select(
        "conv_id", "role", "text", "n", (F.col("upto") + F.col("n0")).alias("upto"), (F.col("idx") + F.col("c0") - 1).alias("idx")
    )
    placed = stage(placed, "chat-placed")

    system = placed.where("idx = 0 and role = 'system'").select(
        F.col("conv_id").alias("sc"), F.col("n").alias("sys_n"), F.col("text").alias("sys_text")
    )
    numbered = placed.select("conv_id", "idx", "n", "upto").join(
        system.select("sc", "sys_n"), F.col("conv_id").eqNullSafe(F.col("sc")), "left"
    ).select("conv_id", "idx", "n", "upto", F.coalesce("sys_n", F.lit(0)).cast("long").alias("sys_n"))
    spans = stage(_spans(numbered, budget, history, history_budget, span), "chat-spans")

    # One row a turn and window it appears in: 0 system, 1 history, 2 new turns.
    ranges = spans.select(F.col("conv_id").alias("rc"), "first")
    turns_of = {
        1: spans.where("held > 0").select("conv_id", "first", F.sequence(F.col("first") - F.col("held"), F.col("first") - 1).alias("idx")),
        2: spans.select("conv_id", "first", F.sequence("first", "last").alias("idx")),
    }
    new, old = (turns_of[k].select("conv_id", "first", F.explode("idx").alias("idx"), F.lit(k).alias("kind")) for k in (2, 1))
    shown = new.unionByName(old)
    body = shown.select(F.col("conv_id").alias("wc"), F.col("idx").alias("wi"), "first", "kind").join(
        placed, F.col("wc").eqNullSafe(F.col("conv_id")) & (F.col("wi") == F.col("idx"))
    ).select("conv_id", "first", "kind", "idx", "role", "text", "n")
    head = ranges.where("first > 0").join(system, F.col("rc").eqNullSafe(F.col("sc"))).select(
        F.col("rc").alias("conv_id"), "first", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("idx"),
        F.lit("system").alias("role"), F.col("sys_text").alias("text"), F.col("sys_n").alias("n"),
    )
    packed = body.unionByName(head).groupBy("conv_id", "first").agg(
        F.sort_array(F.collect_list(F.struct("kind", "idx", "role", "text"))).alias("turns"), F.sum("n").alias("n_tokens")
    )

    kind = "conv_id string, first long, n_repeated int, n_turns int, n_tokens long, over_budget boolean, formatted string, mask array<struct<start:long,end:long>>"

    def write(batches):
        for batch in batches:
            out = []
            for conv, first, held, n in zip(batch["conv_id"], batch["first"], batch["turns"], batch["n_tokens"]):
                text, mask = render([(t["role"], t["text"], t["kind"] == 2 and t["role"] == "assistant") for t in held])
                repeated = sum(t["kind"] < 2 for t in held)
                out.append((conv, first, repeated, len(held), n, n > budget, text, [{"start": a, "end": b} for a, b in mask]))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in kind.split(", ")])

    # As text, because pandas would turn numbers beside a null into doubles.
    made = packed.withColumn("conv_id", F.col("conv_id").cast("string")).mapInPandas(write, kind)
    return made.withColumn("conv_id", F.col("conv_id").cast("long")).withColumnRenamed("first", "window")

