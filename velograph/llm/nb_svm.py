"""Quality classifier: naive-Bayes-scaled n-grams under a linear hinge loss (operator 3).

A document is the set of its n-grams, hashed into ``2 ** BITS`` indicators: words
and word pairs, and runs of one to three word shapes (letter case, digits, final
signs, length class, equal to the word before), besides the share of each shape
and of distinct words, in powers of two. Each indicator is scaled by its class
log-count ratio, which is counted over all labelled training documents; the
scaled vectors, made unit length, are fitted by dual coordinate descent for the
hinge loss on a sample of about ``SAMPLE`` training rows (every row, if there are
fewer), chosen by a hash of the id. Three quarters of the sample fit the weights
and one quarter the logistic curve that turns a margin into a score.

Ids whose crc32 (as text) leaves remainder 0 mod 5 are held out: no label of
theirs is read. Scores depend on the text alone.

Defined results: null and empty texts have one indicator of their own and are
scored like all others; a null id counts as empty text for the remainder; labels
that are null or neither 0 nor 1, or without a document, are left out; several
labels of one id all count. Without training rows of both classes every score
is the share of label 1 (0.5 without any). Columns of the input are kept.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from velograph.llm import textcodes as tc
from velograph.llm.scratch import Scratch, small_batches

BITS = 18
SAMPLE = 8000
THRESHOLD = 0.3
FOLDS = 5
SMOOTH = 1.0
COST = 1.0
EPOCHS = 20
COUNT_BLOCK = 1 << 15  # counters that are added up together
WORD, PAIR, SHAPE, SHARE = (tc.U64(i * 0x632BE59BD9B4E019 & (1 << 64) - 1) for i in range(1, 5))
UPPER = tc.byte_class((0x41, 0x5A))
LETTERS = UPPER | tc.byte_class((0x61, 0x7A), (0x80, 0xFF))
DIGITS = tc.byte_class((0x30, 0x39))


def held_out(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def shapes(w: tc.Words, codes: np.ndarray) -> np.ndarray:
    """A small number for the outer form of each word."""
    def count(flags):
        run = np.concatenate([[0], np.cumsum(flags[w.data])])
        return run[w.ends] - run[w.starts]
    size = w.ends - w.starts
    letters, upper, digits = count(LETTERS), count(UPPER), count(DIGITS)
    first, last = w.data[w.starts], w.data[w.ends - 1]
    before = np.where(size > 1, w.data[np.maximum(w.ends - 2, 0)], 0)
    case = np.where((letters > 1) & (upper == letters), 2, UPPER[first].astype(np.int64))
    plain_end = LETTERS[last] | DIGITS[last]
    end = np.where(plain_end, 0, last.astype(np.int64))
    twice = (~plain_end) & (last == before)
    signs = (size - letters - digits > 1) * 1
    same = np.zeros(len(size), np.int64)
    same[1:] = codes[1:] == codes[:-1]
    heads = w.ptr[:-1][w.ptr[:-1] < len(size)]
    same[heads] = 0
    length = np.searchsorted([3, 8, 20, 60], size, "right")
    out = case
    for part, base in ((end, 256), (twice, 2), (signs, 2), (same, 2), (digits > 0, 2), (letters == 0, 2), (length, 5)):
        out = out * base + part
    return out.astype(tc.U64)


def indicators(data: np.ndarray, off: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct indicator numbers of each document of a block, with their pointer."""
    n_docs = len(off) - 1
    w = tc.split_words(data, off, tc.SPACED, lower=False)
    exact = tc.word_hashes(w)
    form = shapes(w, exact)
    folded = tc.word_hashes(w._replace(data=tc.LOWER[w.data]))
    runs = [(folded, w.ptr, WORD), (*tc.ngram_hashes(folded, w.ptr, 2), PAIR)]
    runs += [(*tc.ngram_hashes(tc.mix(form), w.ptr, k), SHAPE) for k in (1, 2, 3)]
    # shares: of every shape, and of distinct words, in a document
    doc = np.repeat(np.arange(n_docs).astype(tc.U64) << tc.U64(40), w.counts)
    shaped = np.sort(doc | tc.mix(form) >> tc.U64(24))
    at = np.flatnonzero(np.concatenate([[True], shaped[1:] != shaped[:-1]])[:len(shaped)])
    owner = (shaped[at] >> tc.U64(40)).astype(np.int64)
    share = np.floor(-np.log2(np.diff(np.append(at, len(shaped))) / w.counts[owner]) * 2)
    runs.append((tc.mix((shaped[at] << tc.U64(24)) + np.minimum(share, 20).astype(tc.U64)), np.searchsorted(owner, np.arange(n_docs + 1)), SHARE))
    different = tc.distinct(doc | tc.mix(folded) >> tc.U64(24)) >> tc.U64(40)
    n_different = np.bincount(different.astype(np.int64), minlength=n_docs)
    level = np.where(w.counts > 0, np.floor(-np.log2(np.maximum(n_different, 1) / np.maximum(w.counts, 1)) * 4), 63)
    runs.append((tc.mix(np.minimum(level, 63).astype(tc.U64) + tc.U64(1 << 40)), np.arange(n_docs + 1), SHARE))
    owners = np.concatenate([np.repeat(np.arange(n_docs), np.diff(ptr)) for _, ptr, _ in runs])
    found = np.concatenate([tc.mix(v ^ salt) >> tc.U64(64 - bits) for v, _, salt in runs])
    found = tc.distinct((owners.astype(np.int64) << bits) | found.astype(np.int64))
    return found & ((1 << bits) - 1), np.searchsorted(found >> bits, np.arange(n_docs + 1))


def _count(bits: int):
    """The sampled rows' indicators, and at the end of a task its class counts of every
    indicator, in blocks (their number in place of a label)."""
    def run(batches):
        counts = np.zeros((2, 1 << bits), np.int64)
        rows = np.zeros(2, np.int64)
        for batch in batches:
            for lo, hi, data, off in tc.blocks(batch.column("text")):
                found, ptr = indicators(data, off, bits)
                label = batch.column("quality")[lo:hi].to_numpy()
                of = np.repeat(label, np.diff(ptr))
                for y in (0, 1):
                    counts[y] += np.bincount(found[of == y], minlength=1 << bits)
                rows += np.bincount(label, minlength=2)
                for i in np.flatnonzero(batch.column("sampled")[lo:hi].to_numpy(zero_copy_only=False)).tolist():
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id")[lo + i:lo + i + 1], pa.array([int(label[i])], pa.int32()),
                         pa.array([zlib.compress(found[ptr[i]:ptr[i + 1]].astype(np.int32).tobytes(), 1)], pa.binary()), pa.nulls(1, pa.binary())],
                        names=["doc_id", "quality", "found", "counts"])
        if rows.any():
            whole = np.concatenate([rows, counts.reshape(-1)])
            for at in range(0, len(whole), COUNT_BLOCK):
                part = whole[at:at + COUNT_BLOCK]
                if part.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.nulls(1, pa.int64()), pa.array([at // COUNT_BLOCK], pa.int32()), pa.nulls(1, pa.binary()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())],
                        names=["doc_id", "quality", "found", "counts"])
    return run


def _add(batches):
    """Sum the counters of each block number."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            total[block] = total.get(block, 0) + np.frombuffer(zlib.decompress(packed), np.int64)
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([zlib.compress(x.tobytes(), 1) for x in total.values()], pa.binary())],
                                         names=["block", "counts"])


def _totals(counted: DataFrame, size: int) -> np.ndarray:
    """Rows and counts of both classes: blocks of counters added up by the tasks that read
    them, then block by block, a fixed number of blocks whatever the input."""
    parts = counted.where("counts IS NOT NULL").select(F.col("quality").alias("block"), "counts")
    parts = parts.mapInArrow(_add, "block int, counts binary").repartition("block").mapInArrow(_add, "block int, counts binary")
    out = np.zeros(2 + 2 * size, np.int64)
    for r in parts.collect():
        part = np.frombuffer(zlib.decompress(r.counts), np.int64)
        out[r.block * COUNT_BLOCK:][:len(part)] = part
    return out


class Model:
    """Weights per indicator; ``margin`` of a set is their sum over the set's scaled length."""

    def __init__(self, weight: np.ndarray, square: np.ndarray, bias: float, slope: float, offset: float):
        self.weight, self.square, self.bias, self.slope, self.offset = weight, square, bias, slope, offset
        self.bits = len(weight).bit_length() - 1

    def scores(self, found: np.ndarray, ptr: np.ndarray) -> np.ndarray:
        doc = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
        length = np.sqrt(np.bincount(doc, self.square[found], len(ptr) - 1))
        margin = np.bincount(doc, self.weight[found], len(ptr) - 1) / np.maximum(length, 1e-12) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -500, 500)))


def descend(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int, cost: np.ndarray, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Hinge loss with a bias, by dual coordinate descent over unit-length sparse rows."""
    weight, bias, alpha = np.zeros(size), 0.0, np.zeros(len(rows))
    pick = np.random.default_rng(7)
    for _ in range(epochs):
        most = 0.0
        for i in pick.permutation(len(rows)).tolist():
            at, value = rows[i]
            gradient = y[i] * (weight[at] @ value + bias) - 1
            new = min(max(alpha[i] - gradient / 2, 0.0), cost[i])  # squared length: 1, and 1 for the bias
            step = (new - alpha[i]) * y[i]
            if step:
                weight[at] += step * value
                bias += step
                most = max(most, abs(step))
                alpha[i] = new
        if most < 1e-3:
            break
    return weight, bias


def logistic(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the curve P(label 1 | margin), by Newton steps on smoothed labels."""
    good = label.sum()
    target = np.where(label == 1, (good + 1) / (good + 2), 1 / (len(label) - good + 2))
    a, b = 1.0, math.log((good + 1) / (len(label) - good + 1))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -500, 500)))
        d, h = target - p, np.maximum(p * (1 - p), 1e-9)
        m = np.array([[(h * margin * margin).sum() + 1e-6, (h * margin).sum()], [(h * margin).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(m, [(d * margin).sum(), d.sum()])
        step *= min(1.0, 2.0 / np.abs(step).max()) if np.abs(step).max() else 1.0
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        sample: int = SAMPLE, bits: int = BITS) -> Model:
    """Learn from the labelled documents that are not held out."""
    known = labels.where(F.col(label).isin(0, 1) & ~held_out(F.col(key))).select(F.col(key).alias("__llm_key"), F.col(label).cast("int").alias("quality"))
    share = sample / max(1, known.count())
    known = known.withColumn("sampled", F.pmod(F.xxhash64("__llm_key", F.lit("sample")), F.lit(1 << 30)) < int(min(share, 1) * (1 << 30)))
    rows = (docs.select(F.col(key).alias("__llm_key"), F.col(text).alias("text")).join(known.hint("shuffle_merge"), "__llm_key")  # labels grow with the documents
            .select(F.col("__llm_key").cast("long").alias("doc_id"), "quality", "sampled", "text"))
    scratch = Scratch(docs.sparkSession, "nb-svm")
    counted = scratch.write(rows.mapInArrow(_count(bits), "doc_id long, quality int, found binary, counts binary"), "counted")
    totals = _totals(counted, 1 << bits)
    taken = sorted((r.doc_id, r.quality, r.found) for r in counted.where("found IS NOT NULL").select("doc_id", "quality", "found").collect())
    scratch.drop("counted")
    size = 1 << bits
    n = totals[:2].astype(float)
    y = np.array([q for _, q, _ in taken])
    if not n.all() or len(set(y.tolist())) < 2:
        good = (n[1] + 0.5) / (n.sum() + 1)
        return Model(np.zeros(size), np.zeros(size), 0.0, 0.0, math.log(good / (1 - good)))
    counts = totals[2:].reshape(2, size) + SMOOTH
    ratio = np.log(counts[1] / (n[1] + 2 * SMOOTH)) - np.log(counts[0] / (n[0] + 2 * SMOOTH))
    sets = [np.frombuffer(zlib.decompress(f), np.int32) for _, _, f in taken]
    rest = np.array([zlib.crc32(str(d).encode()) // FOLDS % 4 == 0 for d, _, _ in taken])
    del taken
    ptr = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    found = np.concatenate(sets)
    del sets
    if len(set(y[rest].tolist())) < 2 or len(set(y[~rest].tolist())) < 2:
        rest[:] = False
    scaled = ratio[found].astype(np.float32)
    length = np.sqrt(np.add.reduceat(np.append(scaled, 0).astype(np.float64) ** 2, ptr[:-1]))
    scaled /= np.repeat(np.maximum(length, 1e-12), np.diff(ptr)).astype(np.float32)
    train = np.flatnonzero(~rest)
    rows = [(found[ptr[i]:ptr[i + 1]], scaled[ptr[i]:ptr[i + 1]]) for i in train]
    part = y[train].mean()
    cost = COST * np.where(y[train] == 1, 0.5 / part, 0.5 / (1 - part))  # both classes weigh the same
    weight, bias = descend(rows, np.where(y[train] == 1, 1.0, -1.0), size, cost)
    model = Model(weight * ratio, ratio * ratio, bias, 1.0, 0.0)
    raw = model.scores(found, ptr)
    margin = np.log(np.clip(raw, 1e-12, 1)) - np.log(np.clip(1 - raw, 1e-12, 1))
    check = np.flatnonzero(rest) if rest.any() else train
    model.slope, model.offset = logistic(margin[check], y[check])
    return model


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1: at least ``threshold``)."""
    names = [c for c in docs.columns if c not in ("score", "predicted")]
    docs = docs.select(*names)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            parts = [shared.value.scores(*indicators(data, off, shared.value.bits)) for _, _, data, off in tc.blocks(batch.column(text))]
            values = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values), pa.array((values >= threshold).astype(np.int32))],
                                             names=[*names, "score", "predicted"])

    return docs.mapInArrow(run, f"{fields}, score double, predicted int")
