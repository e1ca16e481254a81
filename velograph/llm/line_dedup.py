"""Line dedup by range-partitioned line hashes (operator 10).

A line's key is the line stripped of ASCII white space, A-Z lower-cased. Keys of
at least ``min_chars`` code points that occur in at least ``min_docs`` documents
lose their lines in every document but the one with the largest id.

Line hashes (128 bits) are range-partitioned and sorted by hash, document and
position; one stream over a partition sees each key's documents from the largest
down, so the first one met keeps the line. Before the shuffle every batch keeps
only the ``min_docs`` largest documents of a key, which decide both the count
and the keeper, so a line that a third of all documents share is a few rows a
batch. The decisions come back as one compressed keep bitmap per document;
texts are only read again where a caller applies the bitmaps.

Defined results: a null or empty text is one empty line; a null id takes no part
(its lines neither count nor go). Rows with equal id are one document when
documents are counted; each row keeps or loses its own lines. Columns other than
id and text are kept.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from velograph.llm import textcodes as tc
from velograph.llm.scratch import Scratch

MIN_CHARS = 20
MIN_DOCS = 3
SECOND_CODES = tc.mix(tc.BYTE_CODES + tc.U64(0xA5A5A5A5))
LINE_FIELDS = "h1 long, h2 long, doc_id long, text_hash long, pos int"


def line_keys(data: np.ndarray, off: np.ndarray):
    """Per line of a block: document, position, code points and two hashes of its key."""
    breaks = np.flatnonzero(data == 0x0A)
    doc_of_break = np.searchsorted(off, breaks, "right") - 1
    n_lines = np.bincount(doc_of_break, minlength=len(off) - 1) + 1
    ptr = np.concatenate([[0], np.cumsum(n_lines)])
    doc = np.repeat(np.arange(len(n_lines)), n_lines)
    pos = np.arange(ptr[-1]) - ptr[doc]
    begin = np.empty(ptr[-1], np.int64)
    end = np.empty(ptr[-1], np.int64)
    heads = np.zeros(ptr[-1], bool)
    heads[ptr[:-1]] = True
    tails = np.zeros(ptr[-1], bool)
    tails[ptr[1:] - 1] = True
    begin[heads], begin[~heads] = off[:-1], breaks + 1
    end[tails], end[~tails] = off[1:], breaks

    w = tc.split_words(data, off, tc.SPACED, lower=True)
    a = np.searchsorted(w.starts, begin)
    b = np.searchsorted(w.ends, end, "right") - 1
    filled = a <= b
    s = np.zeros(ptr[-1], np.int64)
    e = np.zeros(ptr[-1], np.int64)
    s[filled], e[filled] = w.starts[a[filled]], w.ends[b[filled]]
    heads_run = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    up, down = tc.powers(len(data) + 1)
    hashes = []
    for table in (tc.BYTE_CODES, SECOND_CODES):
        run = np.zeros(len(data) + 1, tc.U64)
        np.cumsum(table[w.data] * up[:-1], out=run[1:])
        hashes.append(tc.mix((run[e] - run[s]) * down[s] + (e - s).astype(tc.U64) * tc.U64(tc.MULT)))
    return doc, pos, heads_run[e] - heads_run[s], hashes[0], hashes[1]


def _lines(min_chars: int):
    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            text_hash = batch.column(1).to_numpy(zero_copy_only=False)
            for lo, hi, data, off in tc.blocks(batch.column(2)):
                doc, pos, points, h1, h2 = line_keys(data, off)
                ok = points >= min_chars
                doc = doc[ok]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tc.signed(h1[ok])), pa.array(tc.signed(h2[ok])), pa.array(ids[lo:hi][doc], pa.int64()),
                     pa.array(text_hash[lo:hi][doc], pa.int64()), pa.array(pos[ok].astype(np.int32))],
                    names=["h1", "h2", "doc_id", "text_hash", "pos"])
    return run


def _ranks(h1: np.ndarray, h2: np.ndarray, doc: np.ndarray):
    """Order by key and descending document without repeats; the key number and
    the rank of the document within its key."""
    order = np.lexsort((-doc, h2, h1))
    h1, h2, doc = h1[order], h2[order], doc[order]
    new_key = np.ones(len(h1), bool)
    new_key[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    fresh = new_key.copy()
    fresh[1:] |= doc[1:] != doc[:-1]
    h1, h2, doc, new_key = h1[fresh], h2[fresh], doc[fresh], new_key[fresh]
    key = np.cumsum(new_key) - 1
    rank = np.arange(len(key)) - np.flatnonzero(new_key)[key]
    return h1, h2, doc, key, rank


def _largest(min_docs: int):
    """Keep the largest documents of every key of a batch."""
    def run(batches):
        for batch in batches:
            h1, h2, doc, _, rank = _ranks(*(batch.column(i).to_numpy() for i in range(3)))
            ok = rank < min_docs
            yield pa.RecordBatch.from_arrays([pa.array(x[ok]) for x in (h1, h2, doc)], names=["h1", "h2", "doc_id"])
    return run


def _keepers(min_docs: int):
    """Stream a sorted partition: the largest document of every key found in enough of them."""
    def run(batches):
        held = None  # rows of the last key of the batch before, cut to its largest documents
        for batch in batches:
            cols = [batch.column(i).to_numpy() for i in range(3)]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
            if not len(cols[0]):
                continue
            h1, h2, doc, key, rank = _ranks(*cols)
            ends = key == key[-1]
            held = [x[ends & (rank < min_docs)] for x in (h1, h2, doc)]
            yield _found(h1[~ends], h2[~ends], doc[~ends], key[~ends], rank[~ends], min_docs)
        if held is not None:
            yield _found(*_ranks(*held), min_docs)
    return run


def _found(h1, h2, doc, key, rank, min_docs):
    first = np.flatnonzero(rank == 0)
    first = first[np.diff(np.append(first, len(key))) >= min_docs]
    return pa.RecordBatch.from_arrays([pa.array(h1[first]), pa.array(h2[first]), pa.array(doc[first])], names=["h1", "h2", "keeper"])


def _pack(batches):
    """Dropped positions of a document -> compressed bitmap (bit set: line dropped)."""
    for batch in batches:
        lists = batch.column(2)
        ends = lists.offsets.to_numpy()
        values = lists.values.to_numpy()
        maps = []
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            at = values[a:b]
            bits = np.zeros(int(at.max()) + 1, np.uint8)
            bits[at] = 1
            maps.append(zlib.compress(np.packbits(bits, bitorder="little").tobytes()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(maps, pa.binary())],
                                         names=["doc_id", "text_hash", "dropped"])


def dropped_lines(docs: DataFrame, key: str = "doc_id", text: str = "text",
                  min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, text_hash, dropped): a compressed bitmap of the lines to drop, for
    every distinct (id, text) that loses any."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "line-dedup")
    source = (docs.where(F.col(key).isNotNull() & F.col(text).isNotNull())
              .select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text")))
    lines = scratch.write(source.mapInArrow(_lines(min_chars), LINE_FIELDS), "lines")
    keepers = (lines.select("h1", "h2", "doc_id")
               .mapInArrow(_largest(min_docs), "h1 long, h2 long, doc_id long")
               .repartitionByRange("h1", "h2").sortWithinPartitions("h1", "h2", F.desc("doc_id"))
               .mapInArrow(_keepers(min_docs), "h1 long, h2 long, keeper long"))
    return (lines.join(scratch.write(keepers, "keepers"), ["h1", "h2"]).where("doc_id < keeper")
            .groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("at"))  # at most the lines of one document
            .mapInArrow(_pack, "doc_id long, text_hash long, dropped binary"))


def keep_bitmaps(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document without its text: id, text_hash, n_lines, n_dropped and
    ``keep``, a zlib-compressed little-endian bitmap of the lines that stay."""
    lines = F.length(text) - F.length(F.translate(F.col(text), "\n", "")) + 1
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                       F.coalesce(lines, F.lit(1)).cast("long").alias("n_lines"))
    found = dropped_lines(docs, key, text, **options)

    def run(batches):
        for batch in batches:
            kept, gone = [], []
            for n, packed in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                bits = _keep(n, packed)
                gone.append(int(n - bits.sum()))
                kept.append(zlib.compress(np.packbits(bits, bitorder="little").tobytes()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(gone, pa.int64()), pa.array(kept, pa.binary())],
                                             names=["doc_id", "text_hash", "n_lines", "n_dropped", "keep"])

    return (rows.join(found, ["doc_id", "text_hash"], "left").select("doc_id", "text_hash", "n_lines", "dropped")
            .mapInArrow(run, "doc_id long, text_hash long, n_lines long, n_dropped long, keep binary"))


def _keep(n: int, packed: bytes | None) -> np.ndarray:
    bits = np.ones(n, np.uint8)
    if packed is not None:
        gone = np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8), bitorder="little")[:n]
        bits[:len(gone)] -= gone
    return bits


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with the dropped lines cut out of the text, and ``n_lines`` (before)
    and ``n_dropped``. A null text stays null."""
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    found = dropped_lines(docs, key, text, **options)
    left = docs.select(*names)
    joined = left.join(found.withColumnsRenamed({"doc_id": "__llm_doc", "text_hash": "__llm_hash", "dropped": "__llm_dropped"}),
                       (F.col(key).cast("long") == F.col("__llm_doc")) & (F.xxhash64(text) == F.col("__llm_hash")), "left")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in left.schema.fields)

    def run(batches):
        for batch in batches:
            texts, n_lines, n_dropped = [], [], []
            for old, packed in zip(batch.column(text).to_pylist(), batch.column("__llm_dropped").to_pylist(), strict=True):
                if packed is None:
                    texts.append(old)
                    n_lines.append((old or "").count("\n") + 1)
                    n_dropped.append(0)
                    continue
                split = old.split("\n")
                bits = _keep(len(split), packed)
                texts.append("\n".join(x for x, keep in zip(split, bits.tolist(), strict=True) if keep))
                n_lines.append(len(split))
                n_dropped.append(int(len(split) - bits.sum()))
            columns = [pa.array(texts, pa.large_string()).cast(batch.schema.field(text).type) if c == text else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                                             names=[*names, "n_lines", "n_dropped"])

    return joined.select(*names, "__llm_dropped").mapInArrow(run, f"{fields}, n_lines long, n_dropped long")
