"""Benchmark decontamination by Wu-Manber multi-pattern search over words (operator 8).

An item of a benchmark gives every run of ``window`` consecutive words as a
pattern (an item with fewer words, but not none, is one pattern). The patterns
of one length make one matcher: a table indexed by the hash of a block of two
words says how far the search may jump; where it says 0, the patterns whose
last block has that hash are fetched from a bucket, their first block's hash is
compared, and then their bytes. Documents are only mapped, never shuffled.

The patterns are sent to the executors in parts of at most ``part_bytes`` of
item text. A larger benchmark takes several passes, each over all documents,
which add up their hits.

Defined results: a null or empty text has no words and is never contaminated;
an item without words has no pattern; items of equal id count once; a null item
id counts as the empty string. Repeated documents are judged alike, each row on
its own. Columns of the input other than the key and the text are kept; input
columns named like the result's are replaced.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from velograph.llm import textcodes as tc
from velograph.llm.scratch import Scratch, small_batches

WINDOW = 13
PART_BYTES = 4 << 20
RESULT = "n_words long, hit_spans array<struct<first:long,last:long>>, item_ids array<string>"


class Matcher:
    """Wu-Manber tables of patterns of ``size`` words each."""

    def __init__(self, size: int, codes: np.ndarray, texts: list[bytes], ids: list[set[str]]):
        self.size, self.block = size, min(2, size)
        self.ids = ids
        ptr = np.arange(len(codes) + 1) * size
        flat = codes.reshape(-1)
        blocks, _ = tc.ngram_hashes(flat, ptr, self.block)
        blocks = blocks.reshape(len(codes), size - self.block + 1)
        bits = min(24, max(16, int(blocks.size).bit_length() + 3))
        self.mask = tc.U64((1 << bits) - 1)
        self.shift = np.full(1 << bits, size - self.block + 1, np.uint8)
        for j in range(blocks.shape[1]):  # from the far left to the last block: the least jump is written last
            self.shift[blocks[:, j] & self.mask] = blocks.shape[1] - 1 - j
        self.buckets: dict[int, list[tuple[int, bytes, int]]] = defaultdict(list)
        for i, (head, tail) in enumerate(zip(blocks[:, 0].tolist(), blocks[:, -1].tolist(), strict=True)):
            self.buckets[tail].append((head, texts[i], i))

    def occurrences(self, w: tc.Words, codes: np.ndarray, raw: bytes) -> Iterator[tuple[int, int]]:
        """(first word, pattern) of every occurrence inside one document of the block."""
        n, span = len(codes), self.block
        if n < self.size:
            return
        whole = np.array([0, n])
        blocks, _ = tc.ngram_hashes(codes, whole, span)
        jumps = self.shift[blocks & self.mask].tobytes()  # jumps[e]: block of the words e..e+span-1
        at, last, stops = self.size - span, n - span, []
        while at <= last:
            jump = jumps[at]
            if jump:
                at += jump
            else:
                stops.append(at)
                at += 1
        if not stops:
            return
        stop = np.array(stops)
        first = stop + span - self.size
        doc = np.searchsorted(w.ptr, first, "right") - 1
        ok = stop + span <= w.ptr[doc + 1]
        stop, first = stop[ok], first[ok]
        for f, tail, head in zip(first.tolist(), blocks[stop].tolist(), blocks[first].tolist(), strict=True):
            for pattern_head, text, i in self.buckets.get(tail, ()):
                if pattern_head == head:
                    e = f + self.size
                    if text == b" ".join(raw[a:b] for a, b in zip(w.starts[f:e].tolist(), w.ends[f:e].tolist(), strict=True)):
                        yield f, i


def matchers(items: list[tuple[str, str]], window: int) -> list[Matcher]:
    """One matcher for each pattern length among the items."""
    by_size: dict[int, dict[bytes, tuple[np.ndarray, set[str]]]] = defaultdict(dict)
    column = pa.array([t for _, t in items], pa.large_string())
    for lo, hi, data, off in tc.blocks(column):
        w = tc.split_words(data, off, tc.ALNUM, lower=True)
        codes, raw = tc.word_hashes(w), w.data.tobytes()
        spans = list(zip(w.starts.tolist(), w.ends.tolist(), strict=True))
        for doc in range(hi - lo):
            a, b = int(w.ptr[doc]), int(w.ptr[doc + 1])
            size = min(window, b - a)
            for i in range(a, b - size + 1 if size else a):
                text = b" ".join(raw[s:e] for s, e in spans[i:i + size])
                by_size[size].setdefault(text, (codes[i:i + size], set()))[1].add(items[lo + doc][0])
    return [Matcher(size, np.stack([c for c, _ in found.values()]), list(found), [ids for _, ids in found.values()])
            for size, found in sorted(by_size.items())]


def _scan(items, window: int, text: str, names: list[str], added: bool):
    """Batch function of one pass: finds the patterns of ``items.value``."""
    def run(batches):
        found = matchers(items.value, window)
        for batch in batches:
            n_words, spans, ids = [], [], []
            before = batch.column("hit_spans").to_pylist() if added else None
            before_ids = batch.column("item_ids").to_pylist() if added else None
            for lo, hi, data, off in tc.blocks(batch.column(text)):
                w = tc.split_words(data, off, tc.ALNUM, lower=True)
                codes, raw = tc.word_hashes(w), w.data.tobytes()
                hits: dict[int, list[tuple[int, int]]] = defaultdict(list)
                items_of: dict[int, set[str]] = defaultdict(set)
                for m in found:
                    for first, i in m.occurrences(w, codes, raw):
                        doc = int(np.searchsorted(w.ptr, first, "right")) - 1
                        hits[doc].append((first - int(w.ptr[doc]), first - int(w.ptr[doc]) + m.size - 1))
                        items_of[doc] |= m.ids[i]
                n_words += w.counts.tolist()
                for doc in range(hi - lo):
                    old = [(s["first"], s["last"]) for s in before[lo + doc]] if added else []
                    spans.append([{"first": a, "last": b} for a, b in _merged(hits.get(doc, []) + old)])
                    ids.append(sorted(items_of.get(doc, set()) | set(before_ids[lo + doc] if added else ())))
            columns = [batch.column(c) for c in names]
            span = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(n_words, pa.int64()), pa.array(spans, span), pa.array(ids, pa.list_(pa.string()))],
                names=[*names, "n_words", "hit_spans", "item_ids"])
    return run


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def occurrences(docs: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
                window: int = WINDOW, part_bytes: int = PART_BYTES) -> DataFrame:
    """``docs`` with its word count, the merged spans of hit words (first and last
    word number) and the sorted ids of the items that occur."""
    spark = docs.sparkSession
    small_batches(spark)
    names = [c for c in docs.columns if c not in ("n_words", "hit_spans", "item_ids")]
    out = docs.select(*names)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields)
    items = items.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("i"),
                         F.col(item_text).alias("t")).where("t IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("t") + 8)).first()[0] or 0
    n_parts = max(1, -(-size // (part_bytes // 2)))  # parts by hash are uneven: aim at half of the bound
    scratch = Scratch(spark, "wu-manber") if n_parts > 1 else None
    for k in range(n_parts):
        part = items if n_parts == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n_parts)) == k)
        rows = sorted((r.i, r.t) for r in part.collect())
        scan = _scan(spark.sparkContext.broadcast(rows), window, text, names, added=k > 0)
        out = out.mapInArrow(scan, f"{fields}, {RESULT}")
        if scratch is not None:
            out = scratch.write(out, f"pass-{k}")
    return out


def contaminated(docs: DataFrame, items: DataFrame, text: str = "text", share: int = 20, **options) -> DataFrame:
    """:func:`occurrences` with ``n_hit`` (words inside any occurrence) and
    ``contaminated``: some are hit, and at least one in ``share``."""
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    return (occurrences(docs, items, text, **options).withColumn("n_hit", n_hit)
            .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))))
