"""Substring dedup by level-wise doubling (operator 4).

A window is ``size`` consecutive words of one document. A word goes when a
window that covers it also starts in a document with a smaller id; windows are
judged on the input. Instead of counting every window of the corpus at once, the
length grows in levels (50 words: 13, 25, 50), each at most twice the one before:

* at a level of length L, every window still in play names one of its L-word
  runs, the one with the least hash among all that it contains. Equal windows
  name equal runs, and neighbours mostly name the same one, so a document has
  about 2/(size - L + 2) names a word;
* a name found in one document alone rules out its windows; the rest go on to
  the next level, until none are left or L = size, where the name is the window
  itself and the smallest id that has it is known.

Documents whose whole word sequence equals that of a document with a smaller id
are settled by one hash before the first level: every window of theirs is taken.
Text is shuffled once, for documents that share a name at the first level, and
again only for those left. Names are 64-bit hashes, so of n windows about
n^2 / 2^65 pairs are taken for equal wrongly (1e-4 for 1e8 windows).

Defined results: null or empty text has no words; a null id takes no part and
keeps all its words; rows with equal id never remove each other's words, and
each is judged on its own. Documents shorter than ``size`` keep everything.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from velograph.llm import textcodes as tc
from velograph.llm.scratch import Scratch
from velograph.session import off_its_keys

SIZE = 50
BASE = 13
KEYS = ["doc_id", "text_hash"]
ROW_FIELDS = "doc_id long, text_hash long, n_words long, kept_sha256 string, s1 long, s2 long, names array<long>"
GONE_FIELDS = ("doc_id long, text_hash long, n_removed long, kept string, kept_sha256 string, "
               "removed array<struct<first:long,last:long>>")


def levels(size: int, base: int = BASE) -> list[int]:
    """Run lengths from about ``base`` up to ``size``, none over twice the one before."""
    out = [size]
    while out[0] > base:
        out.insert(0, (out[0] + 1) // 2)
    return out


def least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values (result i: values i..i+width-1)."""
    out, span = values, 1
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def names(codes: np.ndarray, ptr: np.ndarray, size: int, run: int) -> tuple[np.ndarray, np.ndarray]:
    """The name of every window at run length ``run``, and the documents' pointer."""
    hashes, run_ptr = tc.ngram_hashes(codes, ptr, run)
    counts = np.maximum(np.diff(ptr) - (size - 1), 0)
    out_ptr = np.zeros(len(ptr), np.int64)
    np.cumsum(counts, out=out_ptr[1:])
    if not out_ptr[-1]:
        return np.zeros(0, tc.U64), out_ptr
    low = least(hashes, size - run + 1)
    return low[np.arange(out_ptr[-1]) + np.repeat(run_ptr[:-1] - out_ptr[:-1], counts)], out_ptr


def _lists(values: np.ndarray, ptr: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ptr.astype(np.int32)), pa.array(tc.signed(values)))


def _rows(size: int, run: int):
    """First pass: word count, digest of all words, hash of the sequence, names."""
    def work(batches):
        for batch in batches:
            for lo, hi, data, off in tc.blocks(batch.column("text")):
                w = tc.split_words(data, off, tc.SPACED, lower=False)
                codes = tc.word_hashes(w)
                text, at = tc.joined(w)
                text = memoryview(np.ascontiguousarray(text))
                sha = [hashlib.sha256(text[a:b]).hexdigest() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                found = tc.distinct_per_doc(*names(codes, w.ptr, size, run))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[lo:hi], batch.column("text_hash")[lo:hi], pa.array(w.counts), pa.array(sha),
                     *(pa.array(tc.signed(tc.sequence_hashes(codes, w.ptr, s))) for s in (0, 1)), _lists(*found)],
                    names=[f.split()[0] for f in ROW_FIELDS.split(", ")])
    return work


def _in_play(batch, lo, hi, codes, ptr, size, past):
    """Flags of the windows whose names at all ``past`` levels are shared."""
    ok = None
    for run in past:
        named, at = names(codes, ptr, size, run)
        shared = batch.column(f"shared_{run}")[lo:hi]
        flags = np.zeros(len(named), bool)
        for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
            if b > a:
                flags[a:b] = np.isin(named[a:b], shared[i].values.to_numpy().view(tc.U64))
        ok = flags if ok is None else ok & flags
    return ok


def _next_names(size: int, past: list[int], run: int):
    """Names at length ``run`` of the windows still in play, beside the columns read."""
    def work(batches):
        for batch in batches:
            for lo, hi, data, off in tc.blocks(batch.column("text")):
                w = tc.split_words(data, off, tc.SPACED, lower=False)
                codes = tc.word_hashes(w)
                ok = _in_play(batch, lo, hi, codes, w.ptr, size, past)
                named, at = names(codes, w.ptr, size, run)
                found = tc.distinct_per_doc(named[ok], np.concatenate([[0], np.cumsum(ok)])[at])
                yield pa.RecordBatch.from_arrays([*(c[lo:hi] for c in batch.columns), _lists(*found)],
                                                 names=[*batch.schema.names, "names"])
    return work


def _cut(size: int):
    """Remove the words covered by windows that a smaller id has too."""
    def work(batches):
        for batch in batches:
            for lo, hi, data, off in tc.blocks(batch.column("text")):
                w = tc.split_words(data, off, tc.SPACED, lower=False)
                codes = tc.word_hashes(w)
                gone_at = _in_play(batch, lo, hi, codes, w.ptr, size, [size])
                _, at = names(codes, w.ptr, size, size)
                doc = np.searchsorted(at, np.flatnonzero(gone_at), "right") - 1
                first = np.flatnonzero(gone_at) - at[doc] + w.ptr[doc]
                edge = np.bincount(first, minlength=len(codes) + 1) - np.bincount(first + size, minlength=len(codes) + 1)
                keep = np.cumsum(edge)[:-1] == 0
                text, pos = tc.joined(w, keep)
                text, pos = text.tobytes(), pos.tolist()
                kept = [text[a:b] for a, b in zip(pos[:-1], pos[1:], strict=True)]
                gone = np.diff(np.concatenate([[0], np.cumsum(~keep)])[w.ptr])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[lo:hi], batch.column("text_hash")[lo:hi], pa.array(gone),
                     pa.array([x.decode() for x in kept]), pa.array([hashlib.sha256(x).hexdigest() for x in kept]),
                     pa.array([_spans(~keep[a:b]) for a, b in zip(w.ptr[:-1].tolist(), w.ptr[1:].tolist(), strict=True)],
                              pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])))],
                    names=["doc_id", "text_hash", "n_removed", "kept", "kept_sha256", "removed"])
    return work


def _spans(flags: np.ndarray) -> list[dict[str, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [{"first": a, "last": b - 1} for a, b in edge.reshape(-1, 2).tolist()]


def _shared(named: DataFrame, run: int, keep: Column) -> DataFrame:
    """Names (one row each in ``named``) that pass ``keep`` against the smallest and
    largest id that has them, as one list per document."""
    ends = named.groupBy("name").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    return (named.join(off_its_keys(ends), "name").where(keep).groupBy(*KEYS)
            .agg(F.collect_set("name").alias(f"shared_{run}")))  # at most the words of one document


def decide(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash, n_words, n_removed, ``kept_sha256`` (of the
    kept words joined by one space), and where a part goes, ``kept`` (that text)
    and ``removed`` (spans of word numbers); both are null where all or nothing
    goes."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "substring-dedup")
    steps = levels(size)
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    rows = scratch.write(source.mapInArrow(_rows(size, steps[0]), ROW_FIELDS), "rows")
    firsts = rows.where(f"n_words >= {size} AND doc_id IS NOT NULL").groupBy("s1", "s2").agg(F.min("doc_id").alias("first_id"))
    rows = scratch.write(rows.join(off_its_keys(firsts), ["s1", "s2"], "left").drop("s1", "s2"), "rows-and-firsts")
    left = rows.where("doc_id = first_id").select(*KEYS, "names").dropDuplicates(KEYS)

    named = left.select(*KEYS, F.explode("names").alias("name"))
    lost = F.col("doc_id") > F.col("low")
    shared = _shared(named, steps[0], lost if len(steps) == 1 else F.lit(True))
    texts = source.join(shared, KEYS)
    for past, run in zip(steps[:-1], steps[1:], strict=True):
        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in texts.schema.fields)
        texts = scratch.write(texts.mapInArrow(_next_names(size, [past], run), f"{fields}, names array<long>")
                              .drop(f"shared_{past}").where(F.size("names") > 0), f"level-{run}")
        named = texts.select(*KEYS, F.explode("names").alias("name"))
        if run < size:
            texts = texts.drop("names").join(_shared(named, run, F.lit(True)), KEYS)
        else:
            texts = texts.drop("names").join(_shared(named, run, lost), KEYS)
    gone = texts.dropDuplicates(KEYS).mapInArrow(_cut(size), GONE_FIELDS)
    out = rows.drop("names").join(gone.withColumnRenamed("kept_sha256", "part_sha256"), KEYS, "left")
    whole = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))
    return out.select(
        *KEYS, "n_words", F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("part_sha256", "kept_sha256")).alias("kept_sha256"),
        F.when(~whole, F.col("kept")).alias("kept"), F.when(~whole, F.col("removed")).alias("removed"))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """``docs`` with the repeated words taken out; a text that loses none is unchanged,
    one that loses some is its kept words joined by one space."""
    done = decide(docs, key, text, size).where("n_removed > 0").dropDuplicates(KEYS)
    done = done.select(F.col("doc_id").alias("__llm_doc"), F.col("text_hash").alias("__llm_hash"), "n_removed", F.coalesce("kept", F.lit("")).alias("__llm_kept"))
    return (docs.drop("n_removed")
            .join(done, (F.col(key).cast("long") == F.col("__llm_doc")) & (F.xxhash64(text) == F.col("__llm_hash")), "left")
            .withColumn(text, F.coalesce("__llm_kept", text)).withColumn("n_removed", F.coalesce("n_removed", F.lit(0)))
            .drop("__llm_doc", "__llm_hash", "__llm_kept"))
