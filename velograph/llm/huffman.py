"""Token ids as canonical length-limited Huffman files (operator 7).

``write_ids`` tokenizes whole texts, counts every id over all documents, makes
one code of at most ``MAX_BITS`` bits a symbol (package-merge), and writes the
documents in ascending id order. The format is a folder with two Parquet tables:

* ``code``: symbol, bits. The canonical code follows from the lengths: symbols
  by (length, symbol) get consecutive codes.
* ``blocks``: one row for whole documents of about ``BLOCK_TOKENS`` ids: file
  number and block number (files and blocks in ascending document order),
  doc_ids, doc_tokens, first_token (within the file), the bit string (most
  significant bit first) and a bit offset for every ``LANE`` ids.

A block is decoded by itself: all stretches between bit offsets advance together,
one table look-up of ``MAX_BITS`` bits giving symbol and length. ``read_ids``
adds up the file sizes (one number a file) to place each document.

Words are runs of other characters than ASCII white space; the tokenizer drops
white space before it cuts a text, so ids of a text are those of its words. Each
task therefore encodes a word once.

Defined results: a null or empty text has the end id only; a null document id
comes first; equal ids are ordered by their ids' checksum. Any further columns
of the input are left out.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from velograph.llm import textcodes as tc
from velograph.llm.idcache import IdCache
from velograph.llm.scratch import small_batches

MAX_BITS = 16
BLOCK_TOKENS = 1 << 16
LANE = 64
GROUP_WORDS = 500
IDS_FIELDS = "doc_id long, n_tokens long, crc long, ids binary, counts binary"
SUMS = 32  # tasks that add up the counts of those that read them
BLOCK_FIELDS = ("file int, block int, first_token long, n_tokens long, doc_ids array<long>, "
                "doc_tokens array<long>, offsets array<long>, bits binary")
#: Kinds of ASCII bytes in the tokenizer's word pattern; 0: leave the word to the tokenizer alone.
LETTER, DIGIT, OTHER = 1, 2, 3
KIND = np.zeros(256, np.uint8)
KIND[0x21:0x7F] = OTHER
KIND[0x30:0x3A] = DIGIT
KIND[0x41:0x5B] = KIND[0x61:0x7B] = LETTER
KIND[0x27] = KIND[0x3C] = 0  # apostrophes start endings; < starts special strings


class WordEncoder:
    """Ids of words, kept for the words met before."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        self.mark = vocabulary["0</w>"]
        self.closes = np.zeros(self.size, bool)
        self.closes[[i for word, i in vocabulary.items() if word.endswith("</w>")]] = True
        self.cache = IdCache()

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _new_words(self, w: tc.Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (concatenated) and their number for words of a block.

        Words go to the tokenizer many at a time. Plain ones stand on lines: each
        part of a word ends in a closing id, and the parts are known. The others
        stand between lines of a "0", whose id no word without one has; words with
        a "0" or "<" and a sign beyond ASCII or an apostrophe go alone."""
        raw = w.data.tobytes()
        kinds = KIND[w.data]
        edge = np.ones(len(kinds), bool)
        edge[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == DIGIT)
        edge[w.starts] = True
        s, e = w.starts[which], w.ends[which]

        def count(flags):
            run = np.concatenate([[0], np.cumsum(flags)])
            return run[e] - run[s]

        parts, odd, alone = count(edge), count(kinds == 0), count((w.data == 0x30) | (w.data == 0x3C))
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # words, ids, numbers of ids

        def words(at):
            return [raw[a:b] for a, b in zip(s[at].tolist(), e[at].tolist(), strict=True)]

        def groups(at, between):
            cut = [at[i:i + GROUP_WORDS] for i in range(0, len(at), GROUP_WORDS)]
            return zip(cut, self._encode([between.join(words(g)).decode() for g in cut]), strict=True)

        single = np.flatnonzero((odd > 0) & (alone > 0))
        for group, ids in groups(np.flatnonzero(odd == 0), b"\n"):
            ends = np.flatnonzero(self.closes[ids]) + 1
            last = np.cumsum(parts[group])
            if len(ends) == last[-1]:
                done.append((group, ids, np.diff(ends[last - 1], prepend=0)))
            else:
                single = np.concatenate([single, group])
        for group, ids in groups(np.flatnonzero((odd > 0) & (alone == 0)), b"\n0\n"):
            marks = np.flatnonzero(ids == self.mark)
            if len(marks) == len(group) - 1:
                done.append((group, ids[ids != self.mark], np.diff(np.concatenate([[-1], marks, [len(ids)]])) - 1))
            else:
                single = np.concatenate([single, group])
        if len(single):
            ids = self._encode([x.decode() for x in words(single)])
            done.append((single, np.concatenate(ids), np.array([len(x) for x in ids], np.int64)))
        word, ids, length = (np.concatenate(x) for x in zip(*done, strict=True))
        start = np.cumsum(length) - length
        order = np.argsort(word)
        start, length = start[order], length[order]
        total = np.cumsum(length) - length
        return ids[np.arange(len(ids)) + np.repeat(start - total, length)], length

    def encode(self, w: tc.Words) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words of a block, and the ids' document pointer."""
        ids, bounds = self.cache.ids(tc.word_hashes(w), lambda which: self._new_words(w, which))
        return ids, bounds[w.ptr]


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The task's encoder; its word cache outlives a batch but is bounded."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _tokenize(path: str, end_id: int):
    """Ids of each document (16 or 32 bits each), and at the end the task's counts."""
    def run(batches):
        words = encoder(path)
        size = max(words.size, end_id + 1)
        counts = np.zeros(size, np.int64)
        width = np.uint16 if size <= 1 << 16 else np.uint32
        names = [f.split()[0] for f in IDS_FIELDS.split(", ")]
        for batch in batches:
            for lo, hi, data, off in tc.blocks(batch.column("text")):
                ids, ptr = words.encode(tc.split_words(data, off, tc.SPACED, lower=False))
                counts += np.bincount(ids, minlength=size)
                counts[end_id] += hi - lo
                rows = [np.append(ids[a:b], end_id) for a, b in zip(ptr[:-1].tolist(), ptr[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[lo:hi], pa.array([len(x) for x in rows], pa.int64()),
                     pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in rows], pa.int64()),
                     pa.array([x.astype(width).tobytes() for x in rows], pa.binary()), pa.nulls(hi - lo, pa.binary())], names=names)
        if counts.any():
            yield pa.RecordBatch.from_arrays(
                [*(pa.nulls(1, pa.int64()) for _ in range(3)), pa.nulls(1, pa.binary()),
                 pa.array([zlib.compress(counts.tobytes(), 1)], pa.binary())], names=names)
    return run


def _sum_counts(batches):
    total = None
    for batch in batches:
        for packed in batch.column(0).to_pylist():
            part = np.frombuffer(zlib.decompress(packed), np.int64)
            total = part.copy() if total is None else total + part
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], names=["counts"])


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (0: the symbol does not occur)."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols need more than {limit} bits")
    if n <= 1:
        out[used] = 1
        return out
    order = used[np.lexsort((used, counts[used]))]
    leaves = counts[order].astype(np.int64)
    row, kinds = leaves, []
    for _ in range(limit - 1):
        pairs = row[:len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        merged = np.concatenate([leaves, pairs])
        at = np.argsort(merged, kind="stable")
        kinds.append(at < n)
        row = merged[at]
    take = 2 * n - 2
    for is_leaf in reversed(kinds):
        here = int(is_leaf[:take].sum())
        out[order[:here]] += 1
        take = 2 * (take - here)
    out[order[:take]] += 1
    return out


def codes_of(lengths: np.ndarray) -> np.ndarray:
    """Canonical codes for the given lengths."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    out = np.zeros(len(lengths), np.uint64)
    if len(order):
        bits = lengths[order].astype(np.int64)
        top = int(bits[-1])
        scaled = np.cumsum(np.int64(1) << (top - bits)) - (np.int64(1) << (top - bits))
        out[order] = (scaled >> (top - bits)).astype(np.uint64)
    return out


def pack(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Bit string of the ids and the bit offset of every ``LANE``-th."""
    bits = lengths[ids].astype(np.int64)
    end = np.cumsum(bits)
    start = end - bits
    value = codes[ids] << (64 - (start & 31) - bits).astype(np.uint64)
    word = start >> 5
    size = int(end[-1] >> 5) + 2
    words = np.bincount(word, weights=(value >> np.uint64(32)).astype(np.float64), minlength=size)
    words += np.bincount(word + 1, weights=(value & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=size)
    return words.astype(">u4").tobytes()[:int(end[-1] + 7) // 8], start[::LANE]


def decode_table(lengths: np.ndarray, limit: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Symbol and length for every string of ``limit`` bits."""
    codes = codes_of(lengths)
    symbol, bits = np.zeros(1 << limit, np.int32), np.ones(1 << limit, np.int64)
    order = np.lexsort((codes, lengths))
    order = order[lengths[order] > 0]
    spans = np.int64(1) << (limit - lengths[order].astype(np.int64))
    filled = int(spans.sum())
    symbol[:filled] = np.repeat(order, spans)
    bits[:filled] = np.repeat(lengths[order].astype(np.int64), spans)
    return symbol, bits


def unpack(data: bytes, offsets: np.ndarray, n: int, symbol: np.ndarray, bits: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """The ``n`` ids of a block, all lanes stepping together."""
    raw = np.frombuffer(data + b"\0\0\0\0", np.uint8).astype(np.uint32)
    windows = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
    at = np.array(offsets, np.int64)
    out = np.zeros((len(at), LANE), np.int32)
    for i in range(LANE):
        if i == n - (len(at) - 1) * LANE:  # the last lane is shorter
            at = at[:-1]
        if not len(at):
            break
        look = (windows[at >> 3] >> (32 - limit - (at & 7)).astype(np.uint32)) & np.uint32((1 << limit) - 1)
        out[:len(at), i] = symbol[look]
        at = at + bits[look]
    return out.reshape(-1)[:n]


def _encode_blocks(lengths):
    """Stream a sorted partition into blocks of whole documents."""
    def run(batches):
        file = TaskContext.get().partitionId()
        bits = lengths.value
        codes = codes_of(bits)
        width = np.uint16 if len(bits) <= 1 << 16 else np.uint32
        docs, sizes, parts, held, block, first = [], [], [], 0, 0, 0

        def flush():
            ids = np.concatenate(parts)
            data, offsets = pack(ids, bits, codes)
            return pa.RecordBatch.from_arrays(
                [pa.array([file], pa.int32()), pa.array([block], pa.int32()), pa.array([first], pa.int64()), pa.array([len(ids)], pa.int64()),
                 pa.array([docs], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())),
                 pa.array([offsets], pa.list_(pa.int64())), pa.array([data], pa.binary())], names=[f.split()[0] for f in BLOCK_FIELDS.split(", ")])

        for batch in batches:
            for doc, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                ids = np.frombuffer(ids.as_buffer(), width)
                docs.append(doc)
                sizes.append(len(ids))
                parts.append(ids)
                held += len(ids)
                if held >= BLOCK_TOKENS:
                    yield flush()
                    first += held
                    block += 1
                    docs, sizes, parts, held = [], [], [], 0
        if docs:
            yield flush()
    return run


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text") -> None:
    """Tokenize ``docs`` and write the files under ``path`` (any folder Spark can write)."""
    spark = docs.sparkSession
    small_batches(spark)
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    source.mapInArrow(_tokenize(tokenizer, end_id), IDS_FIELDS).write.option("compression", "zstd").parquet(f"{path}/ids")
    ids = spark.read.parquet(f"{path}/ids")
    parts = ids.where("counts IS NOT NULL").select("counts")
    for width in (SUMS, 1):  # added up where they are read, then by a fixed number of tasks, then by one
        parts = parts.mapInArrow(_sum_counts, "counts binary").repartition(width)
    total = parts.mapInArrow(_sum_counts, "counts binary").first()
    counts = np.frombuffer(zlib.decompress(total.counts), np.int64) if total else np.zeros(end_id + 1, np.int64)
    lengths = code_lengths(counts)
    used = np.flatnonzero(lengths)
    spark.createDataFrame([(int(i), int(lengths[i]), len(lengths)) for i in used],
                          "symbol int, bits int, vocabulary int").coalesce(1).write.parquet(f"{path}/code")
    (ids.where("ids IS NOT NULL").drop("counts").repartitionByRange(F.asc_nulls_first("doc_id"), "crc")
     .sortWithinPartitions(F.asc_nulls_first("doc_id"), "crc")
     .mapInArrow(_encode_blocks(spark.sparkContext.broadcast(lengths)), BLOCK_FIELDS)
     .write.option("compression", "uncompressed").parquet(f"{path}/blocks"))


def read_ids(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """doc_id, start (ids before the document), n_tokens, and its ``ids``; with
    ``digest``, their unsigned crc32 (as little-endian 32-bit integers) in place of them."""
    code = spark.read.parquet(f"{path}/code").collect()  # at most a row for each vocabulary entry
    lengths = np.zeros(code[0].vocabulary if code else 1, np.uint8)
    for r in code:
        lengths[r.symbol] = r.bits
    blocks = spark.read.parquet(f"{path}/blocks")
    sizes = blocks.groupBy("file").agg(F.sum("n_tokens").alias("n")).orderBy("file").collect()  # a number for each file
    before = dict(zip([r.file for r in sizes], np.concatenate([[0], np.cumsum([r.n for r in sizes])]).tolist(), strict=False))
    shared = spark.sparkContext.broadcast((lengths, before))
    fields = "doc_id long, start long, n_tokens long, " + ("ids_crc32 long" if digest else "ids array<int>")

    def run(batches):
        lengths, before = shared.value
        table = decode_table(lengths)
        for batch in batches:
            for r in batch.to_pylist():
                ids = unpack(r["bits"], r["offsets"], r["n_tokens"], *table)
                ends = np.cumsum(r["doc_tokens"])
                starts = ends - r["doc_tokens"]
                parts = [ids[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                last = (pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in parts], pa.int64()) if digest
                        else pa.array(parts, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], pa.int64()), pa.array(starts + r["first_token"] + before[r["file"]], pa.int64()),
                     pa.array(r["doc_tokens"], pa.int64()), last], names=[f.split()[0] for f in fields.split(", ")])

    return blocks.mapInArrow(run, fields)
