"""N-gram Jaccard join with rare-first prefix filtering (operator 1).

A document's set holds the hashes of its distinct word n-grams (all its words as
one n-gram if it has fewer). Two documents link when
``100 * |intersection| >= percent * |union|``.

1. One pass over the texts gives each row its set size and a hash of its set
   (equal sets form a class and are compared once), and counts n-grams in a
   table of 2^23 counters for all documents (32 MB at any corpus size). A count
   is never too low; it only orders n-grams, so an imprecise one costs time, not links.
2. A second pass sorts every set by rising count and gives out its prefix, which
   two linking sets must share an n-gram of, grouped by n-gram. Rows that no other
   class of the group can match in length go.
3. Pairs come from the groups without listing all pairs of a group: first each
   member with a few hubs (the members with the least keyed hash); once those
   links are known, only members of different components are paired, so a group
   of k near copies costs about k pairs. Pairs pass the length, positional and
   suffix filters (the last: a set's n-grams fall into 1,024 hash ranges, and ranges
   that hold an odd number in one set and an even one in the other each cost a
   difference of the sets), then the sets are compared, once per pair.
4. Components of the links give each document the smallest id it reaches. A link
   whose ends are known to be connected need not be found; all others are.

Defined results: a null or empty text, or one without words, has the empty set
and links with nothing; a null id takes no part. Rows with equal id are one
document as far as ids go: the row keeps its own set size. Set hashes have 128
bits in the classes, 64 as graph nodes.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, Window as W

from velograph.llm import textcodes as tc
from velograph.llm.components import components
from velograph.llm.scratch import Scratch

SKETCH_BITS = 23
SKETCH_BLOCK = 1 << 16
HUBS = 2
LOOKS = 200
RANGES = 1024
SEEN_LIMIT = 1 << 20
ROW_NAMES = ["doc_id", "text_hash", "n_shingles", "fp", "fp2", "block", "counts"]
ROW_FIELDS = "doc_id long, text_hash long, n_shingles long, fp long, fp2 long, block int, counts binary"


def shingle_sets(data, off, k: int, is_word=tc.SPACED) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of each document of a block, with their pointer."""
    w = tc.split_words(data, off, is_word, lower=True)
    codes = tc.word_hashes(w)
    grams, ptr = tc.ngram_hashes(codes, w.ptr, k)
    n = w.counts
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        whole = tc.sequence_hashes(codes, w.ptr, k)
        counts = np.diff(ptr)
        counts[short] = 1
        new_ptr = np.concatenate([[0], np.cumsum(counts)])
        out = np.empty(new_ptr[-1], tc.U64)
        is_short = np.zeros(new_ptr[-1], bool)
        is_short[new_ptr[short]] = True
        out[is_short], out[~is_short] = whole[short], grams
        grams, ptr = out, new_ptr
    return tc.distinct_per_doc(grams, ptr)


def _set_hashes(sets: np.ndarray, ptr: np.ndarray):
    return tc.signed(tc.sequence_hashes(sets, ptr, 1)), tc.signed(tc.sequence_hashes(sets, ptr, 2))


def _measure(k: int, bits: int):
    """First pass: a row per document, and at the end of a task its counters."""
    def run(batches):
        counts = np.zeros(1 << bits, np.int32)
        held: list[np.ndarray] = []

        def add():
            if held:
                np.add(counts, np.bincount(np.concatenate(held), minlength=1 << bits), out=counts, casting="unsafe")
                held.clear()

        for batch in batches:
            for lo, hi, data, off in tc.blocks(batch.column("text")):
                sets, ptr = shingle_sets(data, off, k)
                held.append((sets >> tc.U64(64 - bits)).astype(np.int32))
                if sum(map(len, held)) > 1 << 22:
                    add()
                n = hi - lo
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[lo:hi], batch.column("text_hash")[lo:hi], pa.array(np.diff(ptr)), *map(pa.array, _set_hashes(sets, ptr)),
                     pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=ROW_NAMES)
        add()
        for i in range(0, len(counts), SKETCH_BLOCK):
            part = counts[i:i + SKETCH_BLOCK]
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [*(pa.nulls(1, pa.int64()) for _ in range(5)), pa.array([i // SKETCH_BLOCK], pa.int32()),
                     pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], names=ROW_NAMES)
    return run


def _add_up(batches):
    """Sum the counters of each block number (a fixed number of blocks, whatever the input)."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            part = np.frombuffer(zlib.decompress(packed), np.int32)
            total[block] = total.get(block, 0) + part.astype(np.int64)
    if total:
        packed = [zlib.compress(np.minimum(x, 65535).astype(np.uint16).tobytes(), 1) for x in total.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(packed, pa.binary())], names=["block", "counts"])


def _sketch(rows: DataFrame, bits: int) -> np.ndarray:
    """Counts of all documents' n-grams by the leading bits of their hash."""
    parts = rows.where("block IS NOT NULL").select("block", "counts").repartition("block")
    out = np.zeros(1 << bits, np.uint16)
    for r in parts.mapInArrow(_add_up, "block int, counts binary").collect():  # one row for each block of the table
        counts = np.frombuffer(zlib.decompress(r.counts), np.uint16)
        out[r.block * SKETCH_BLOCK:][:len(counts)] = counts
    return out


def _prefixes(k: int, percent: int, bits: int, sketch):
    """Second pass: the rare-first prefix of every set (a set met before in the task is skipped)."""
    def run(batches):
        counts = sketch.value
        seen: set[int] = set()
        for batch in batches:
            for _, _, data, off in tc.blocks(batch.column("text")):
                sets, ptr = shingle_sets(data, off, k)
                fp, _ = _set_hashes(sets, ptr)
                order_by = (counts[(sets >> tc.U64(64 - bits)).astype(np.int64)].astype(tc.U64) << tc.U64(48)) | (sets & tc.U64((1 << 48) - 1))
                grams, owners, sizes, ranks = [], [], [], []
                for i, (a, b) in enumerate(zip(ptr[:-1].tolist(), ptr[1:].tolist(), strict=True)):
                    n = b - a
                    if not n or int(fp[i]) in seen:
                        continue
                    if len(seen) >= SEEN_LIMIT:
                        seen.clear()
                    seen.add(int(fp[i]))
                    size = n - -(-percent * n // 100) + 1
                    grams.append(sets[a:b][np.argsort(order_by[a:b], kind="stable")[:size]])
                    owners.append(i)
                    sizes.append(size)
                if owners:
                    ranks = np.concatenate([np.arange(s) for s in sizes]).astype(np.int32)
                    owner = np.repeat(np.array(owners), sizes)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(tc.signed(np.concatenate(grams))), pa.array(fp[owner]),
                         pa.array(np.diff(ptr)[owner].astype(np.int32)), pa.array(ranks)], names=["gram", "fp", "n", "rank"])
    return run


def _fetch_sets(k: int):
    """Sets of the wanted classes, with a bit for each hash range that holds an odd number
    (rows are sorted by id, so rows repeating one stand together; of those with the set of
    a wanted class the first is used, whatever other sets the id has)."""
    def run(batches):
        last, given = None, set()  # an id, and its classes met so far
        for batch in batches:
            for lo, hi, data, off in tc.blocks(batch.column("text")):
                sets, ptr = shingle_sets(data, off, k)
                fp, _ = _set_hashes(sets, ptr)
                ids, ok = batch.column("doc_id")[lo:hi].to_numpy(), []
                for i in np.flatnonzero(fp == batch.column("fp")[lo:hi].to_numpy()).tolist():
                    if ids[i] != last:
                        last = ids[i]
                        given.clear()
                    if int(fp[i]) not in given:
                        given.add(int(fp[i]))
                        ok.append(i)
                ok = np.array(ok, np.int64)
                owner = np.repeat(np.arange(hi - lo), np.diff(ptr))
                odd = np.bincount(owner * RANGES + (sets >> tc.U64(64 - RANGES.bit_length() + 1)).astype(np.int64), minlength=(hi - lo) * RANGES) & 1
                odd = np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(-1, RANGES // 64)
                at = ptr.tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fp[ok]), pa.array(np.diff(ptr)[ok].astype(np.int32)),
                     pa.array([_packed(sets[at[i]:at[i + 1]]) for i in ok.tolist()], pa.binary()),
                     pa.array(odd[ok].tolist(), pa.list_(pa.int64()))], names=["fp", "n", "grams", "odd"])
    return run


def _packed(sorted_hashes: np.ndarray) -> bytes:
    """The leading 48 bits of each hash: sets travel in three quarters of their size, and
    two sets of n have about n^2 / 2^48 chance matches (1e-6 for n = 20,000)."""
    return np.ascontiguousarray((sorted_hashes >> tc.U64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _unpacked(data) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").reshape(-1)


def _compare(percent: int):
    """Keep the pairs whose sets are similar enough."""
    def run(batches):
        for batch in batches:
            ok = []
            for a, b in zip(batch.column("grams_a"), batch.column("grams_b"), strict=True):
                x, y = _unpacked(a.as_buffer()), _unpacked(b.as_buffer())
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                common = int(np.count_nonzero(y[np.minimum(at, len(y) - 1)] == x))
                ok.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))
    return run


class Join:
    """One run of the join over a table of documents."""

    def __init__(self, docs: DataFrame, key: str, text: str, k: int, percent: int):
        self.k, self.percent = k, percent
        self.scratch = Scratch(docs.sparkSession, "ngram-join")
        self.spark = docs.sparkSession
        self.docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
        rows = self.scratch.write(self.docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(_measure(k, SKETCH_BITS), ROW_FIELDS), "rows")
        self.sketch = _sketch(rows, SKETCH_BITS)
        self.rows = rows.where("block IS NULL").drop("block", "counts")
        classes = (self.rows.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("fp", "fp2")
                   .agg(F.min("doc_id").alias("first_id")))
        self.classes = self.scratch.write(classes, "classes")

    def _matches(self) -> Column:
        """Length, prefix and positional filters on two rows x, y of a group."""
        p = self.percent
        nx, ny, rx, ry = F.col("x.n"), F.col("y.n"), F.col("x.rank"), F.col("y.rank")
        low, high = F.least(nx, ny).cast("long"), F.greatest(nx, ny).cast("long")
        need = F.ceil(p * (low + high) / (100 + p))
        index = lambda n: n - F.ceil(2 * p * n.cast("long") / (100 + p)) + 1
        return ((low * 100 >= high * p) & (((nx <= ny) & (rx < index(nx))) | ((ny <= nx) & (ry < index(ny))))
                & (1 + F.least(nx - rx, ny - ry) - 1 >= need))

    def _alike(self, a: str, b: str, n: Column, other: Column) -> Column:
        """Suffix filter: sets that differ in more n-grams than a link allows."""
        total = n.cast("long") + other
        apart = sum((F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(RANGES // 64)), F.lit(0))
        return apart <= total - 2 * F.ceil(self.percent * total / (100 + self.percent))

    def _pairs(self, x: DataFrame, y: DataFrame) -> DataFrame:
        """Distinct pairs of classes of different parts that share an n-gram and pass all
        filters; both sides have the classes' ``odd``."""
        found = x.alias("x").join(y.alias("y"), F.col("x.gram") == F.col("y.gram"))
        found = found.where((F.col("x.part") != F.col("y.part")) & self._matches()
                            & self._alike("x.odd", "y.odd", F.col("x.n"), F.col("y.n")))
        return found.select(F.least("x.fp", "y.fp").alias("a"), F.greatest("x.fp", "y.fp").alias("b")).distinct()

    def _verified(self, pairs: DataFrame, sets: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        """The pairs as a written table, and those of them that link."""
        pairs = self.scratch.write(pairs, f"{name}-pairs")
        grams = lambda x: sets.select(F.col("fp").alias(x), F.col("grams").alias(f"grams_{x}"))
        links = pairs.join(grams("b"), "b").join(grams("a"), "a").mapInArrow(_compare(self.percent), "a long, b long")
        return pairs, self.scratch.write(links, f"{name}-links")

    def links(self) -> DataFrame:
        """Links (a, b) between classes, enough to connect every component."""
        p = self.percent
        sketch = self.spark.sparkContext.broadcast(self.sketch)
        prefixes = self.docs.where("doc_id IS NOT NULL").mapInArrow(
            _prefixes(self.k, p, SKETCH_BITS, sketch), "gram long, fp long, n int, rank int")
        group = W.partitionBy("gram").orderBy("n", "fp")
        members = (prefixes.repartition("gram")
                   .withColumn("before", F.lag("fp").over(group)).where("before IS NULL OR before <> fp").drop("before")
                   .withColumn("less", F.lag("n").over(group)).withColumn("more", F.lead("n").over(group))
                   .where(f"100 * less >= {p} * n OR 100 * n >= {p} * more").drop("less", "more"))
        members = self.scratch.write(members, "near-in-length")
        other = members.alias("y")
        members = members.alias("x").join(other, (F.col("x.gram") == F.col("y.gram")) & (F.col("x.fp") != F.col("y.fp")) & self._matches(), "left_semi")
        members = self.scratch.write(members, "members")
        wanted = members.select("fp").distinct().join(self.classes, "fp").select("fp", F.col("first_id").alias("doc_id"))
        sets = self.docs.join(wanted, "doc_id").mapInArrow(_fetch_sets(self.k), "fp long, n int, grams binary, odd array<long>")
        sets = self.scratch.write(sets, "sets")

        odd = sets.select("fp", "odd")
        parted = members.withColumn("part", F.col("fp"))
        rows = members.count()
        tested = links = None
        turn, cost = 0, None
        while True:
            turn += 1
            hubs = parted.groupBy("gram").agg(*(
                F.min_by(F.struct("fp", "n", "rank", "part"), F.xxhash64("fp", F.lit(turn * HUBS + i))).alias(f"h{i}") for i in range(HUBS)),
                F.min("part").alias("low"), F.max("part").alias("high")).where("low < high")
            hubs = hubs.select("gram", F.explode(F.array_distinct(F.array(*(f"h{i}" for i in range(HUBS))))).alias("h")).select("gram", "h.*")
            pairs = self._pairs(hubs.join(odd, "fp"), parted.join(odd, "fp"))
            if tested is not None:
                pairs = pairs.join(tested, ["a", "b"], "left_anti")
            done, found = self._verified(pairs, sets, f"hubs-{turn}")
            tested = done if tested is None else tested.union(done)
            links = found if links is None else links.union(found)
            nodes = components(links, self.scratch, f"turn-{turn}").select(F.col("node").alias("fp"), "component")
            parted = members.join(nodes, "fp", "left").withColumn("part", F.coalesce("component", "fp")).drop("component")
            parted = self.scratch.write(parted, f"parted-{turn}")
            sizes = parted.groupBy("gram", "part").agg(F.count("*").alias("size"))
            groups = sizes.groupBy("gram").agg(F.sum("size").alias("size"), F.max_by("part", "size").alias("main"),
                                               F.max("size").alias("main_size")).where("size > main_size")
            groups = self.scratch.write(groups, f"open-{turn}")
            before, cost = cost, groups.agg(F.sum(F.col("size") * (F.col("size") - F.col("main_size")))).first()[0] or 0
            # more hubs while they help: the rest looks at ``cost`` combinations of rows
            if cost <= LOOKS * rows or (before is not None and 2 * cost > before):
                break
        # all that is left: members outside the largest component of their group, with all others
        open_rows = parted.join(groups.select("gram", "main"), "gram").join(odd, "fp")
        pairs = self._pairs(open_rows.where("part <> main"), open_rows).join(tested, ["a", "b"], "left_anti")
        _, found = self._verified(pairs, sets, "rest")
        return links.union(found)

    def assigned(self) -> DataFrame:
        """doc_id, text_hash (xxhash64), n_shingles, class_id (smallest id with an equal set),
        component_id and component (its number, also where an id has texts in several;
        null without words or id), one row per input row."""
        nodes = components(self.links(), self.scratch, "all").select(F.col("node").alias("fp"), "component")
        named = self.classes.join(nodes, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
        least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
        named = self.scratch.write(named.join(least, "component").select("fp", "fp2", "first_id", "component_id", "component"), "named")
        alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
        return (self.rows.join(named, ["fp", "fp2"], "left")
                .select("doc_id", "text_hash", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("first_id")).alias("class_id"),
                        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), F.when(~alone, F.col("component")).alias("component")))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """Class and component of every document (see :meth:`Join.assigned`)."""
    return Join(docs, key, text, k, percent).assigned()
