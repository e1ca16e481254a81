"""Embedding near-dedup by E8 lattice hashing (operator 2).

Only vectors of one label meet. Equal vectors of a label form a class, which is
hashed and compared once. In each of ``TABLES`` tables a unit vector is projected
at random to two blocks of eight dimensions, and each block is decoded to the
nearest point of the E8 lattice; the pair of points is the vector's cell. A vector
is at home in its cell and also visits the cells where one block moves to a
neighbouring lattice point (the ``PROBES`` of 240 nearest to the projection). Home
vectors of a cell are compared with each other and with its visitors; cosines are
taken in double precision from the vectors themselves, so every link is exact.

At cosine 0.98, two vectors meet in one table with probability 0.67, in one of eight
with 0.9999; more alike ones nearly always (see ``recall`` in the tests).

A cell with more than ``BLOCK`` rows is split into pairs of blocks, each a task's
small matrix product. A pair that has a common home is counted in the first such
cell only, inside the task: out come counts per vector and the links of a spanning
forest, not the pairs. Other links, from visits, are few and leave as pairs.

Defined results: null vectors, zero vectors, those with null or non-finite
components, without a label or an id link with nothing and are kept. Rows with
one id and equal vectors are one vector when links are counted; the links of an id's
different vectors add up, and all that they reach is one component. Further
columns are left out.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from velograph.llm import textcodes as tc
from velograph.llm.components import components
from velograph.llm.scratch import Scratch
from velograph.session import off_its_keys

TABLES = 8
BLOCKS = 2
WIDTH = 1.4
PROBES = 8
BLOCK = 512
COSINE = 0.98


def _neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(v) for v in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(out)


NEIGHBOURS = _neighbours()


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Integer points with an even sum nearest to the rows of x."""
    r = np.rint(x)
    odd = np.flatnonzero(r.sum(axis=1).astype(np.int64) & 1)
    off = x[odd] - r[odd]
    at = np.abs(off).argmax(axis=1)
    r[odd, at] += np.where(off[np.arange(len(odd)), at] >= 0, 1, -1)
    return r


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """E8 points nearest to the rows of x: integer or half-integer points."""
    whole, half = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(closer[:, None], whole, half)


def _point_codes(points: np.ndarray) -> np.ndarray:
    """64-bit codes of lattice points (last axis: coordinates)."""
    n = (points * 2).astype(np.int64).view(tc.U64)
    up, _ = tc.powers(8)
    return tc.mix((tc.mix(n) * up).sum(axis=-1, dtype=tc.U64))


def cells(x: np.ndarray, label: np.ndarray, tables: int = TABLES, width: float = WIDTH, probes: int = PROBES):
    """Home cells (rows, tables) and visited cells (rows, tables, 2 * probes) of unit vectors."""
    pick = np.random.default_rng([len(x[0]) if len(x) else 0, 8])
    home, visits = [], []
    for t in range(tables):
        codes, moved = [], []
        for _ in range(BLOCKS):
            y = x @ (pick.standard_normal((x.shape[1], 8)) / width)
            point = nearest_e8(y)
            near = np.argpartition(-((y - point) @ NEIGHBOURS.T), probes - 1, axis=1)[:, :probes]
            codes.append(_point_codes(point))
            moved.append(_point_codes(point[:, None, :] + NEIGHBOURS[near]))
        salt = tc.mix(label.astype(np.int64).view(tc.U64) * tc.U64(64) + tc.U64(t))
        first, second = codes
        home.append(tc.mix(salt ^ tc.mix(first + tc.U64(1)) ^ second))
        visits.append(np.concatenate([tc.mix(salt[:, None] ^ tc.mix(moved[0] + tc.U64(1)) ^ second[:, None]),
                                      tc.mix(salt[:, None] ^ tc.mix(first + tc.U64(1))[:, None] ^ moved[1])], axis=1))
    return np.stack(home, axis=1), np.stack(visits, axis=1)


def _usable(batches):
    """Usable vectors as bytes of doubles, with a hash of them."""
    for batch in batches:
        ids, labels, hashes, raw = [], [], [], []
        for i, label, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            if not v.is_valid or v.values.null_count:
                continue
            x = np.asarray(v.values.to_numpy(zero_copy_only=False), np.float64)
            if len(x) and np.isfinite(x).all() and x.any():
                x = x + 0.0  # one zero
                ids.append(i)
                labels.append(label)
                raw.append(x.tobytes())
                hashes.append(xxhash.xxh3_128_digest(raw[-1]))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(labels, pa.int64()), pa.array(hashes, pa.binary()),
                                          pa.array(raw, pa.binary())], names=["id", "label", "hash", "vector"])


def _by_size(vectors: pa.Array):
    """Rows of equal dimension: (row numbers, unit vectors)."""
    sizes = np.array([len(v) for v in vectors.to_pylist()])
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        x = np.frombuffer(b"".join(vectors.take(pa.array(at)).to_pylist())).reshape(len(at), -1)
        x = x / np.abs(x).max(axis=1, keepdims=True)
        yield at, x / np.linalg.norm(x, axis=1, keepdims=True)


def _keys(tables: int, width: float, probes: int):
    def run(batches):
        for batch in batches:
            ids, labels = batch.column("id").to_numpy(), batch.column("label").to_numpy()
            for at, x in _by_size(batch.column("vector")):
                for lo in range(0, len(at), 1000):
                    part = at[lo:lo + 1000]
                    home, visits = cells(x[lo:lo + 1000], labels[part] ^ len(x[0]), tables, width, probes)
                    n = len(part)
                    cell = np.concatenate([home.reshape(-1), visits.reshape(-1)])
                    owner = np.concatenate([np.repeat(ids[part], home.shape[1]), np.repeat(ids[part], visits.shape[1] * visits.shape[2])])
                    yield pa.RecordBatch.from_arrays([pa.array(tc.signed(cell)), pa.array(owner), pa.array(np.arange(len(cell)) < n * home.shape[1])],
                                                     names=["cell", "id", "home"])
    return run


def _homes(tables: int, width: float, probes: int):
    """Each class with its home cells."""
    def run(batches):
        for batch in batches:
            labels = batch.column("label").to_numpy()
            out: list = [None] * batch.num_rows
            for at, x in _by_size(batch.column("vector")):
                home, _ = cells(x, labels[at] ^ len(x[0]), tables, width, probes)
                for i, h in zip(at.tolist(), tc.signed(home).tolist(), strict=True):
                    out[i] = h
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("size"), batch.column("vector"), pa.array(out, pa.list_(pa.int64()))],
                                             names=["id", "size", "vector", "homes"])
    return run


LINKS = "a long, b long, n long"  # a link (n null), or n vectors linked to a (b null)


def _compare(cosine: float):
    """Stream rows sorted by (cell, i, j) and compare each group."""
    def group(rows: pa.Table, cell: int):
        ids, home, size = (rows.column(c).to_numpy() for c in ("id", "home", "size"))
        order = np.lexsort((~home, ids))
        keep = order[np.concatenate([[True], ids[order][1:] != ids[order][:-1]])]  # home before visit
        ids, home, size = ids[keep], home[keep], size[keep]
        if not home.any() or len(ids) < 2:
            return
        block = rows.column("part").to_numpy()[keep]
        x = np.frombuffer(b"".join(rows.column("vector").take(pa.array(keep)).to_pylist())).reshape(len(ids), -1)
        x = x / np.abs(x).max(axis=1, keepdims=True)
        dots = x @ x.T
        norm = np.sqrt(np.einsum("ij,ij->i", x, x))
        linked = dots >= cosine * norm[:, None] * norm[None, :]
        np.fill_diagonal(linked, False)
        linked &= home[:, None] | home[None, :]
        if block.max() != block.min():  # rows of one block meet in that block's own group
            linked &= block[:, None] != block[None, :]
        if not linked.any():
            return
        homes = np.array(rows.column("homes").take(pa.array(keep)).to_pylist(), np.int64)
        same = homes[:, None, :] == homes[None, :, :]
        meet = same.any(axis=2)
        first = homes[np.arange(len(ids))[:, None], same.argmax(axis=2)]
        counted = linked & meet & (first == cell)
        part = np.arange(len(ids))
        while True:  # least row reached inside the group
            low = np.minimum(part, np.where(counted, part[None, :], len(ids)).min(axis=1))
            low = low[low]
            if (low == part).all():
                break
            part = low
        n = (counted * size[None, :]).sum(axis=1)
        at = np.flatnonzero(n)
        forest = at[part[at] != at]
        x_at, y_at = np.nonzero(np.triu(linked & ~meet))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([ids[at], ids[forest], ids[x_at]])),
             pa.concat_arrays([pa.nulls(len(at), pa.int64()), pa.array(ids[part[forest]]), pa.array(ids[y_at])]),
             pa.concat_arrays([pa.array(n[at].astype(np.int64)), pa.nulls(len(forest), pa.int64()), pa.array(np.full(len(x_at), -1))])],
            names=["a", "b", "n"])

    def run(batches):
        held: list = []
        for batch in batches:
            table = pa.Table.from_batches([*held, batch]) if held else pa.Table.from_batches([batch])
            key = np.stack([table.column(c).to_numpy() for c in ("cell", "i", "j")])
            if not key.shape[1]:
                continue
            edge = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            starts = np.concatenate([[0], edge])
            for a, b in zip(starts[:-1].tolist(), edge.tolist(), strict=True):
                yield from group(table.slice(a, b - a).combine_chunks(), int(key[0, a]))
            held = table.slice(int(starts[-1])).to_batches()
        if held:
            table = pa.Table.from_batches(held)
            yield from group(table.combine_chunks(), table.column("cell")[0].as_py())
    return run


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE,
                    tables: int = TABLES, width: float = WIDTH, probes: int = PROBES, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links (other vectors linked directly), component_id (smallest id
    reached), kept; one row per input row."""
    scratch = Scratch(vectors.sparkSession, "lattice")
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.xxhash64(F.col(label).cast("string")).alias("label"), F.col(label).alias("given"), F.col(vector).alias("vector"))
    known = rows.where("id IS NOT NULL AND given IS NOT NULL AND vector IS NOT NULL").drop("given")
    usable = scratch.write(known.mapInArrow(_usable, "id long, label long, hash binary, vector binary"), "usable")
    # a class has a number of its own: an id may have rows with several vectors
    classes = usable.groupBy("label", "hash").agg(F.min("id").alias("least"), F.count_distinct("id").alias("size"), F.first("vector").alias("vector"))
    classes = scratch.write(classes.select(F.xxhash64("label", "hash").alias("id"), "least", "label", "hash", "size", "vector"), "classes")
    settings = (tables, width, probes)

    keys = scratch.write(classes.select("id", "label", "vector").mapInArrow(_keys(*settings), "cell long, id long, home boolean").distinct(), "keys")
    sizes = (keys.groupBy("cell").agg(F.count("*").alias("rows"), F.max("home").alias("any_home"))
             .where("any_home AND rows > 1").select("cell", F.ceil(F.col("rows") / block).cast("int").alias("parts")))
    met = keys.join(off_its_keys(sizes), "cell").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    met = met.select("cell", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "id", "home")
    homes = classes.mapInArrow(_homes(*settings), "id long, size long, vector binary, homes array<long>")
    found = (met.join(homes, "id").repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")
             .select("cell", "i", "j", "part", "id", "home", "size", "vector", "homes").mapInArrow(_compare(cosine), LINKS))
    found = scratch.write(found, "found")

    pairs = found.where("n = -1").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    weights = classes.select(F.col("id").alias("to"), F.col("size").alias("n"))
    both = pairs.union(pairs.select("b", "a")).join(weights, F.col("b") == F.col("to")).select(F.col("a").alias("id"), "n")
    counts = both.union(found.where("n > 0").select("a", "n")).groupBy("id").agg(F.sum("n").alias("n"))
    # the classes of an id with several vectors belong together
    holders = usable.select("id", F.xxhash64("label", "hash").alias("class")).distinct()
    several = holders.groupBy("id").agg(F.min("class").alias("first"), F.max("class").alias("last")).where("first < last").select("id", "first")
    tied = holders.join(several, "id").where("class <> first").select(F.col("first").alias("a"), F.col("class").alias("b"))
    nodes = components(pairs.union(found.where("n IS NULL").select("a", "b")).union(tied), scratch, "parts")
    named = (classes.join(counts, "id", "left").join(nodes, F.col("id") == F.col("node"), "left")
             .select(F.col("id").alias("class"), "least", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"),
                     F.coalesce("component", "id").alias("component")))
    named = scratch.write(named, "named")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(off_its_keys(least), "component").select("class", "n_links", "component_id")
    named = holders.join(named, "class").groupBy("id").agg(F.sum("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    return (rows.select("id").join(named, "id", "left")
            .select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
                    F.coalesce("component_id", "id").alias("component_id"),
                    F.coalesce(F.col("component_id") == F.col("id"), F.lit(True)).alias("kept")))
