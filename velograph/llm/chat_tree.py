"""Chat formatting as a prefix tree of turns (operator 9).

Conversations that begin with the same turns share them: a node of the tree is a
turn with all turns before it (a chained 128-bit hash), and each node's tokens are
stored once. A conversation owns the nodes that no conversation with a smaller id
has; they are the tail of its path, its branch, which hangs on a node of another
branch. ``build`` writes three tables in one folder:

* ``nodes``, in depth-first order over branches (a branch, then the branches
  hanging on it, deepest first): branch, ordinal (turn number), start (number of
  its first token in the whole order), position (position id of its first token:
  the tokens of all turns before it in a conversation), ids, loss_first and
  loss_last (the text of an assistant's turn among its ids);
* ``branches``: branch, start, tokens, position, and the attention intervals of
  its ancestors: a token sees these and what comes before it in its own branch;
* ``turns``: for each conversation and turn the start of its node.

The chain of hashes is streamed over rows sorted by conversation and turn, so no
conversation is held in memory, and order keys grow with the nesting of branches,
not with turns. Token numbers are prefix sums over range partitions (one number
a partition goes to the driver).

Template: ``<|im_start|>role\\ntext<|im_end|>\\n``. Texts escape ``\\`` as ``\\\\`` and
``<|`` as ``<\\|`` (roles also a line end), so no text can hold a control string.
Parts are tokenized one by one: the mask of a text is exact.

Defined results: rows are ordered by turn (nulls first), role and text; a null role
or text is empty; rows without a conversation id are one conversation, given back
with a null id. Further columns are left out.
"""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, Window as W

from velograph.llm.scratch import Scratch

START, END = "<|im_start|>", "<|im_end|>\n"
NO_CONVERSATION = -(1 << 63)
ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def unescape_role(role: str) -> str:
    return ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], role)


def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def _chain(batches):
    """Number the turns of each conversation and chain their hashes."""
    conv, ordinal, node = None, 0, b""
    for batch in batches:
        out: dict[str, list] = {c: [] for c in ("conv", "ordinal", "node", "parent")}
        for c, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
            if c != conv:
                conv, ordinal, node = c, 0, b""
            parent, turn = node, f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass")
            node = hashlib.blake2b(turn, digest_size=16, key=parent).digest()
            for name, value in zip(out, (c, ordinal, node, parent), strict=True):
                out[name].append(value)
            ordinal += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(out["conv"], pa.int64()), pa.array(out["ordinal"], pa.int64()), pa.array(out["node"], pa.binary()),
             pa.array(out["parent"], pa.binary()), batch.column(2), batch.column(3)],
            names=["conv", "ordinal", "node", "parent", "role", "text"])


def _encode(path: str):
    """Ids of each node: head, text and end, with the bounds of an assistant's text."""
    def run(batches):
        tokenizer = _tokenizer(path)
        end = tokenizer.encode(END, add_special_tokens=False).ids
        for batch in batches:
            roles = batch.column("role").to_pylist()
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                heads = tokenizer.encode_batch_fast([f"{START}{escape_role(r)}\n" for r in roles[lo:lo + 500]], add_special_tokens=False)
                texts = tokenizer.encode_batch_fast([escape(t) for t in part.column("text").to_pylist()], add_special_tokens=False)
                ids = [h.ids + t.ids + end for h, t in zip(heads, texts, strict=True)]
                first = [len(h.ids) if r == "assistant" else None for h, r in zip(heads, roles[lo:], strict=False)]
                last = [f + len(t.ids) - 1 if f is not None else None for f, t in zip(first, texts, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("node", "parent", "branch", "ordinal")), pa.array(ids, pa.list_(pa.int32())),
                     pa.array([len(x) for x in ids], pa.int64()), pa.array(first, pa.int64()), pa.array(last, pa.int64())],
                    names=["node", "parent", "branch", "ordinal", "ids", "n", "loss_first", "loss_last"])
    return run


NODE_FIELDS = "node binary, parent binary, branch long, ordinal long, ids array<int>, n long, loss_first long, loss_last long"


def _key_part(number) -> F.Column:
    """Eight bytes that sort like a signed number."""
    return F.unhex(F.lpad(F.hex(number.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0"))


def _branch_starts(branches: DataFrame, scratch: Scratch) -> DataFrame:
    """Start of each branch: tokens of all branches before it in key order."""
    ordered = branches.repartitionByRange("key").sortWithinPartitions("key").withColumn("file", F.spark_partition_id())

    def run(batches):
        total = 0
        for batch in batches:
            n = batch.column("tokens").to_numpy()
            ends = total + np.cumsum(n)
            yield pa.RecordBatch.from_arrays([batch.column("branch"), batch.column("file"), pa.array(ends - n), batch.column("tokens")],
                                             names=["branch", "file", "inside", "tokens"])
            total = int(ends[-1]) if len(ends) else total

    placed = scratch.write(ordered.select("branch", "file", "tokens").mapInArrow(run, "branch long, file int, inside long, tokens long"), "placed")
    sums = placed.groupBy("file").agg(F.sum("tokens").alias("n")).orderBy("file").collect()  # a number for each partition
    ends = np.cumsum([r.n for r in sums], dtype=np.int64)
    offsets = branches.sparkSession.createDataFrame([(r.file, int(e - r.n)) for r, e in zip(sums, ends, strict=True)], "file int, before long")
    return placed.join(offsets, "file").select("branch", (F.col("inside") + F.col("before")).alias("start"))


def build(conversations: DataFrame, path: str, tokenizer: str) -> None:
    """Write the tables ``nodes``, ``branches`` and ``turns`` under ``path``."""
    scratch = Scratch(conversations.sparkSession, "chat-tree")
    rows = conversations.select(F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_CONVERSATION)).alias("conv"), "turn",
                                F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = scratch.write(rows.repartition("conv").sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "text")
                          .mapInArrow(_chain, "conv long, ordinal long, node binary, parent binary, role string, text string"), "turns")
    nodes = turns.groupBy("node").agg(F.min("conv").alias("branch"), *(F.first(c).alias(c) for c in ("ordinal", "parent", "role", "text")))
    nodes = scratch.write(nodes.mapInArrow(_encode(tokenizer), NODE_FIELDS), "encoded")
    slim = nodes.select("node", "parent", "branch", "ordinal", "n")
    along = W.partitionBy("branch").orderBy("ordinal").rowsBetween(W.unboundedPreceding, W.currentRow)
    slim = scratch.write(slim.withColumn("upto", F.sum("n").over(along)), "slim")  # tokens of its branch up to the node's end

    tails = slim.groupBy("branch").agg(F.sum("n").alias("tokens"), F.min_by("parent", "ordinal").alias("parent"))
    hung = slim.select(F.col("node").alias("parent"), F.col("branch").alias("on"), F.col("ordinal").alias("on_ordinal"), F.col("upto").alias("seen"))
    tails = scratch.write(tails.join(hung, "parent", "left").drop("parent"), "tails")
    level = scratch.write(tails.where("on IS NULL").withColumn("key", _key_part(F.col("branch"))).withColumn("position", F.lit(0).cast("long"))
                          .select("branch", "on", "seen", "tokens", "key", "position"), "level-0")
    levels = [level]
    while not level.isEmpty():
        above = level.select(F.col("branch").alias("on"), F.col("key").alias("above"), F.col("position").alias("before"))
        level = (tails.join(above, "on")
                 .withColumn("key", F.concat("above", _key_part(-F.col("on_ordinal")), _key_part(F.col("branch"))))
                 .withColumn("position", F.col("before") + F.col("seen")).select("branch", "on", "seen", "tokens", "key", "position"))
        level = scratch.write(level, f"level-{len(levels)}")
        levels.append(level)
    everything = levels[0]
    for level in levels[1:]:
        everything = everything.union(level)
    starts = scratch.write(_branch_starts(everything.select("branch", "key", "tokens"), scratch), "starts")

    seen: DataFrame | None = None
    done: list[DataFrame] = []
    span = "array<struct<first:long,last:long>>"
    for i, level in enumerate(levels[:-1] or levels):
        level = level.join(starts, "branch")
        if seen is None:
            level = level.withColumn("attends", F.expr(f"cast(array() as {span})"))
        else:
            above = seen.select(F.col("branch").alias("on"), F.col("start").alias("above"), F.col("attends").alias("before"))
            own = F.struct(F.col("above").alias("first"), (F.col("above") + F.col("seen") - 1).alias("last"))
            level = level.join(above, "on").withColumn("attends", F.concat("before", F.array(own)))
        seen = scratch.write(level.select("branch", "start", "tokens", "position", "attends", "key"), f"seen-{i}")
        done.append(seen)
    branches = done[0]
    for level in done[1:]:
        branches = branches.union(level)
    branches.write.parquet(f"{path}/branches")
    branches = conversations.sparkSession.read.parquet(f"{path}/branches")

    place = slim.join(branches.select("branch", "start", "position", "key"), "branch")
    before = F.col("upto") - F.col("n")
    place = scratch.write(place.select("node", "key", (F.col("start") + before).alias("start"), (F.col("position") + before).alias("position")), "place")
    (nodes.drop("parent").join(place, "node").repartitionByRange("key", "ordinal").sortWithinPartitions("key", "ordinal")
     .select("branch", "ordinal", "start", "position", "n", "ids", "loss_first", "loss_last").write.parquet(f"{path}/nodes"))
    (turns.select("conv", "ordinal", "node").join(place.select("node", "start"), "node")
     .select(F.when(F.col("conv") != NO_CONVERSATION, F.col("conv")).alias("conv_id"), "ordinal", "start").write.parquet(f"{path}/turns"))


def read(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """conv_id, ordinal, role, text, masked (text under the loss mask) and formatted
    (the turn's string), decoded from the tables."""
    stored = spark.read.parquet(f"{path}/nodes").select("start", "ids", "loss_first", "loss_last")
    rows = spark.read.parquet(f"{path}/turns").join(stored, "start")

    def run(batches):
        decoder = _tokenizer(tokenizer)
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            formatted = decoder.decode_batch(ids, skip_special_tokens=False)
            bounds = zip(batch.column("loss_first").to_pylist(), batch.column("loss_last").to_pylist(), strict=True)
            masked = decoder.decode_batch([x[a:b + 1] if a is not None else [] for x, (a, b) in zip(ids, bounds, strict=True)], skip_special_tokens=False)
            roles, texts = [], []
            for f in formatted:
                role, text = f[len(START):-len(END)].split("\n", 1)
                roles.append(unescape_role(role))
                texts.append(unescape(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("ordinal"), pa.array(roles), pa.array(texts),
                 pa.array([unescape(m) for m in masked]), pa.array(formatted)],
                names=["conv_id", "ordinal", "role", "text", "masked", "formatted"])

    return (rows.select("conv_id", "ordinal", "ids", "loss_first", "loss_last")
            .mapInArrow(run, "conv_id long, ordinal long, role string, text string, masked string, formatted string"))


def digests(turns: DataFrame) -> DataFrame:
    """Per conversation: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars
    (streamed: a conversation's rows are never held together)."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches):
        conv = out = None

        def result():
            n, turns, chars, loss, formatted = out
            return pa.RecordBatch.from_arrays(
                [pa.array([conv], pa.int64()), pa.array([n], pa.int64()), pa.array([turns.hexdigest()]), pa.array([chars], pa.int64()),
                 pa.array([loss.hexdigest()]), pa.array([formatted], pa.int64())], names=names)

        for batch in batches:
            for c, role, text, masked, formatted in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "role", "text", "masked", "formatted")), strict=True):
                if out is None or c != conv:
                    if out is not None:
                        yield result()
                    conv, out = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                out[0] += 1
                out[1].update(f"{role}\n{text}\n".encode())
                out[2] += len(masked)
                out[3].update(masked.encode())
                out[4] += len(formatted)
        if out is not None:
            yield result()

    return (turns.repartition("conv_id").sortWithinPartitions("conv_id", "ordinal")
            .mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"))
