"""SentencePiece encoding with seeded merge-dropout, and its decoding (operator 5).

A text, with one space set before it and spaces shown as U+2581, is cut by byte-
pair merges: an agenda holds the neighbouring symbols whose concatenation is a
piece; the best one (highest score, then leftmost) is taken and either merged or,
with probability ``dropout``, skipped for good. The skip is decided by a keyed
hash of (seed, document id, place, unit, bounds of the two symbols), so a rerun, a
lost task or another partitioning gives the same ids. With ``dropout`` 0 the ids are
those of the sentencepiece library.

Two characters that stand side by side in no piece are never merged, so a text
falls into units there (before spaces, mostly around signs). Every occurrence of a unit has its own
skips. Up to the first skip all occurrences of a unit take the same merges, and up to
the second all with the same first skip: a task keeps these traces (the candidates in
order, and the ids if no more are skipped) and hashes an occurrence's candidates
against them; one with two skips, or a long unit, is segmented by itself.

Symbols without a piece become byte pieces, and a literal U+2581 does too, so
``decode`` gives back every text exactly.

Defined results: null or empty text has no ids and decodes to the empty text; a
null document id hashes as -1. Columns of the input are kept; those named like
the result's are replaced.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from velograph.llm import textcodes as tc
from velograph.llm.idcache import IdCache
from velograph.llm.scratch import small_batches

DROPOUT = 0.1
SEED = 17
SPACE = "▁"
NEVER = 1 << 62
LOW_BITS = (1 << 32) - 1
MASK = (1 << 64) - 1


WIDTHS = (4, 8, 12, 16, 24)  # units of up to so many characters are segmented together
KEPT_SKIPS = 2  # traces are kept for units with fewer skips
WHOLE = 1 << 62  # depth of an agenda that may skip to its end
LONG = 64  # units of more characters have a heap for an agenda


def _keyed(key: int, a: int, b: int, c: int) -> int:
    """32 bits for the candidate that joins characters a..b and b..c of a unit."""
    x = (key ^ (a * 0x9E3779B1 + b * 0x85EBCA77 + c * 0xC2B2AE3D)) * 0xBF58476D1CE4E5B9 & MASK
    return ((x ^ x >> 31) * 0x94D049BB133111EB & MASK) >> 32


def _keyed_many(key: np.ndarray, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    x = (key ^ (a * 0x9E3779B1 + b * 0x85EBCA77 + c * 0xC2B2AE3D).astype(tc.U64)) * tc.U64(0xBF58476D1CE4E5B9)
    return ((x ^ x >> tc.U64(31)) * tc.U64(0x94D049BB133111EB)) >> tc.U64(32)


def _packed(a, b, c):
    """A candidate of a unit of up to 24 characters in 15 bits."""
    return a << 10 | b << 5 | c


class Pieces:
    """Merge table of a SentencePiece BPE model."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        self.byte_ids = [0] * 256
        found: dict[str, int] = {}
        self.raw: list[bytes] = [b""] * n
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.raw[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                found[piece] = i
                self.raw[i] = piece.replace(SPACE, " ").encode()
        ranked = sorted(found.values(), key=lambda i: -model.get_score(i))
        rank = {i: r for r, i in enumerate(ranked)}
        # symbols: pieces by id; single characters that only occur inside pieces come after them
        self.symbol = {p: i for p, i in found.items() if len(p) == 1}
        self.n_pieces = n
        for piece in found:
            for c in piece:
                self.symbol.setdefault(c, n + len(self.symbol))
        self.extra = {i: c for c, i in self.symbol.items() if i >= n}
        self.merges: dict[int, int] = {}  # two symbols -> rank and piece
        for piece, i in found.items():
            for cut in range(1, len(piece)):
                a, b = piece[:cut], piece[cut:]
                left = found.get(a, self.symbol.get(a) if cut == 1 else None)
                right = found.get(b, self.symbol.get(b) if cut == len(piece) - 1 else None)
                if left is not None and right is not None:
                    self.merges[left << 32 | right] = rank[i] << 32 | i
        space = self.symbol.pop(SPACE, None)  # in a text the character itself has no piece: a space has
        if space is not None:
            self.symbol[" "] = space
        self.pair_keys = np.array(sorted(self.merges), np.int64)
        self.pair_merges = np.array([self.merges[k] for k in sorted(self.merges)], np.int64)
        self.by_point = np.full(0x110000, -1, np.int64)
        for c, i in self.symbol.items():
            self.by_point[ord(c)] = i
        # bytes that follow each other inside a piece; between others no merge is possible
        self.together = np.zeros((256, 256), bool)
        self.together[:, 0x80:0xC0] = True
        for piece in found:
            shown = [c.encode() for c in piece.replace(SPACE, " ")]
            for x, y in zip(shown, shown[1:], strict=False):
                self.together[x[-1], y[0]] = True
        sizes = np.array([len(x) for x in self.raw], np.int64)
        self.raw_start, self.raw_size = np.cumsum(sizes) - sizes, sizes
        self.raw_bytes = np.frombuffer(b"".join(self.raw), np.uint8)
        self.cache = IdCache()

    def segment(self, unit: str, key: int, limit: int, depth: int = WHOLE, trace: list[int] | None = None) -> list[int]:
        """Ids of one unit; a merge is skipped where its keyed hash is below ``limit`` (of 2^32)
        and it is one of the first ``depth`` candidates; those after go to ``trace``.

        A skipped candidate never comes back: its symbols can only grow, and then it is
        another candidate with another hash."""
        if len(unit) > LONG and depth == WHOLE:
            return self._segment_long(unit, key, limit)
        look, get = self.merges, self.symbol.get
        s = [get(c, -1) for c in unit]  # -1 is in no merge
        at = list(range(len(s) + 1))  # first character of each symbol, and the end
        agenda = [look.get(a << 32 | b, NEVER) for a, b in zip(s, s[1:], strict=False)]
        step = 0
        while agenda:
            best = min(agenda)
            if best == NEVER:
                break
            i = agenda.index(best)
            step += 1
            if step > depth:
                if trace is not None:
                    trace.append(_packed(at[i], at[i + 1], at[i + 2]))
            elif limit and _keyed(key, at[i], at[i + 1], at[i + 2]) < limit:
                agenda[i] = NEVER
                continue
            s[i:i + 2] = [best & LOW_BITS]
            del at[i + 1], agenda[i]
            if i:
                agenda[i - 1] = look.get(s[i - 1] << 32 | s[i], NEVER)
            if i < len(agenda):
                agenda[i] = look.get(s[i] << 32 | s[i + 1], NEVER)
        return self._ids(unit, s, at)

    def _segment_long(self, unit: str, key: int, limit: int) -> list[int]:
        """The same for a unit of any length: the agenda is a heap of (merge, first character),
        the symbols a linked list, so a step costs the logarithm of the unit's length.
        An entry whose symbols have changed since is passed over."""
        look, get = self.merges, self.symbol.get
        n = len(unit)
        s = [get(c, -1) for c in unit]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))  # neighbours, by first character
        wanted = [look.get(a << 32 | b, NEVER) for a, b in zip(s, s[1:], strict=False)] + [NEVER]
        agenda = [(w, i) for i, w in enumerate(wanted) if w != NEVER]
        heapq.heapify(agenda)
        while agenda:
            best, i = heapq.heappop(agenda)
            if wanted[i] != best:
                continue
            j = after[i]
            if limit and _keyed(key, i, j, after[j]) < limit:
                wanted[i] = NEVER
                continue
            s[i], after[i], wanted[j] = best & LOW_BITS, after[j], NEVER
            if after[j] < n:
                before[after[j]] = i
            for left in (before[i], i):
                if left >= 0:
                    right = after[left]
                    wanted[left] = look.get(s[left] << 32 | s[right], NEVER) if right < n else NEVER
                    if wanted[left] != NEVER:
                        heapq.heappush(agenda, (wanted[left], left))
        at = [0]
        while at[-1] < n:
            at.append(after[at[-1]])
        return self._ids(unit, [s[i] for i in at[:-1]], at)

    def _ids(self, unit: str, s: list[int], at: list[int]) -> list[int]:
        """Ids of a unit's symbols; one that is no piece is spelt in bytes."""
        out: list[int] = []
        for i, x in enumerate(s):
            if 0 <= x < self.n_pieces:
                out.append(x)
            else:
                out += [self.byte_ids[b] for b in unit[at[i]:at[i + 1]].encode()]
        return out

    def _look(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        pair = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair_keys, pair), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == pair, self.pair_merges[at], NEVER)

    def segment_many(self, symbols: np.ndarray, keys: np.ndarray, limit: int, depth: np.ndarray | None = None,
                     trace: list[tuple[np.ndarray, np.ndarray]] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`segment` for many short units at once: rows of symbols, padded with -1 on
        the right. All agendas take a step together. Returns the rows' ids, likewise
        padded (a symbol of the row that is no piece stays as it is), and their number;
        ``trace`` gets (rows, candidates) for each step."""
        n, width = symbols.shape
        step = 0
        out = symbols.copy()
        rows = np.arange(n)  # those whose agenda is not empty yet
        s = np.concatenate([symbols, np.full((n, 1), -1)], axis=1)
        at = np.tile(np.arange(width + 2), (n, 1))
        agenda = self._look(s[:, :-1], s[:, 1:])
        column = np.arange(width + 2)
        while len(rows):
            i = agenda.argmin(axis=1)
            each = np.arange(len(rows))
            best = agenda[each, i]
            ended = best == NEVER
            if ended.any():
                out[rows[ended]] = s[ended, :width]
                stay = ~ended
                rows, s, at, agenda, keys, i, best = (x[stay] for x in (rows, s, at, agenda, keys, i, best))
                each = np.arange(len(rows))
                if not len(rows):
                    break
            if limit:
                a, b, c = at[each, i], at[each, i + 1], at[each, i + 2]
                skip = _keyed_many(keys, a, b, c) < limit
                if depth is not None:
                    after = depth[rows] <= step
                    skip &= ~after
                    trace.append((rows[after], _packed(a, b, c)[after]))
                step += 1
                agenda[each[skip], i[skip]] = NEVER
                each, i, best = each[~skip], i[~skip], best[~skip]
            moved = column[None, :] + (column[None, :] > i[:, None])
            some = s[each]
            some[np.arange(len(each)), i] = best & LOW_BITS
            some = np.take_along_axis(some, np.minimum(moved[:, :width + 1], width), axis=1)
            some[:, width] = -1
            s[each] = some
            at[each] = np.take_along_axis(at[each], np.minimum(moved, width + 1), axis=1)
            gone = column[None, :width] + (column[None, :width] >= i[:, None])
            pairs = np.take_along_axis(agenda[each], np.minimum(gone, width - 1), axis=1)
            pairs[:, width - 1] = NEVER
            k = np.arange(len(each))
            left = i > 0
            pairs[k[left], i[left] - 1] = self._look(some[k[left], i[left] - 1], some[k[left], i[left]])
            pairs[k, i] = self._look(some[k, i], some[k, i + 1])
            agenda[each] = pairs
        return out, (out >= 0).sum(axis=1)

    def _segments(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray, limit: int,
                  depth: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids (concatenated) of units given as byte spans, and how many each has. With
        ``depth`` a list starts with the number of candidates after it, and these."""
        size = ends - starts
        step = np.ones(int(size.sum()), np.int64)
        total = np.cumsum(size)
        step[0] = starts[0]
        step[total[:-1]] = starts[1:] - ends[:-1] + 1
        text = raw[np.cumsum(step)]
        points = np.frombuffer(text.tobytes().decode().encode("utf-32-le"), np.uint32)
        head = np.concatenate([[0], np.cumsum((text & 0xC0) != 0x80)])
        first, last = head[total - size], head[total]
        symbols = self.by_point[points]
        known = np.concatenate([[0], np.cumsum((symbols < 0) | (symbols >= self.n_pieces))])
        length = last - first
        easy = (known[last] == known[first]) & (length <= WIDTHS[-1])
        counts = np.zeros(len(size), np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []  # units and their ids
        lower = 0
        for width in WIDTHS:
            part = np.flatnonzero(easy & (length > lower) & (length <= width))
            lower = width
            if len(part):
                place = first[part][:, None] + np.arange(width)[None, :]
                inside = place < last[part][:, None]
                table = np.where(inside, symbols[np.minimum(place, len(symbols) - 1)], -1)
                trace: list[tuple[np.ndarray, np.ndarray]] = []
                ids, number = self.segment_many(table, keys[part], limit, None if depth is None else depth[part], trace)
                if depth is not None:
                    rows = np.concatenate([np.zeros(0, np.int64), *(x for x, _ in trace)])
                    candidates = np.bincount(rows, minlength=len(part))
                    done += [(part, candidates), *((part[x], y) for x, y in trace)]
                    counts[part] = 1 + candidates
                counts[part] += number
                done.append((np.repeat(part, number), ids[ids >= 0]))
        for u in np.flatnonzero(~easy).tolist():
            unit = bytes(raw[starts[u]:ends[u]]).decode()
            if depth is None:
                ids = self.segment(unit, int(keys[u]), limit)
            else:
                after: list[int] = []
                ids = self.segment(unit, int(keys[u]), limit, int(depth[u]), after)
                ids = [len(after), *after, *ids]
            counts[u] = len(ids)
            done.append((np.full(len(ids), u), np.array(ids, np.int64)))
        unit = np.concatenate([x for x, _ in done])
        ids = np.concatenate([x for _, x in done])
        return ids[np.argsort(unit, kind="stable")].astype(np.int32), counts

    def encode(self, data: np.ndarray, off: np.ndarray, docs: np.ndarray, dropout: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a block of texts, and their document pointer."""
        filled = off[:-1][np.diff(off) > 0]
        data = np.insert(data, filled, 0x20)
        off = off + np.concatenate([[0], np.cumsum(np.diff(off) > 0)])
        n = len(data)
        if not n:
            return np.zeros(0, np.int32), np.zeros(len(off), np.int64)
        first = np.zeros(n, bool)
        first[1:] = ~self.together[data[:-1], data[1:]]
        first[off[:-1][off[:-1] < n]] = True
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], n)
        w = tc.Words(data, starts, ends, np.searchsorted(starts, off))
        codes = tc.word_hashes(w)
        limit = int(dropout * (1 << 32))
        if limit:
            place = np.arange(len(starts)) - np.repeat(w.ptr[:-1], w.counts)
            owner = np.repeat(docs.astype(np.int64).view(tc.U64), w.counts)
            keys = tc.mix(codes ^ tc.mix(tc.mix(owner + tc.U64(seed & MASK)) + place.astype(tc.U64)))
            ids, bounds = self._varied(data, starts, ends, codes, keys, limit)
        else:
            ids, bounds = self.cache.ids(codes, lambda which: self._segments(data, starts[which], ends[which], codes[which], 0))
        return ids, bounds[w.ptr]

    def _varied(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray, keys: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units of a block, each occurrence with the skips of its own key, and their bounds."""
        head = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        alone = head[ends] - head[starts] > WIDTHS[-1]
        begin, size = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
        depth = np.zeros(len(codes), np.int64)
        state = codes.copy()  # the unit and the skips met so far
        left = np.flatnonzero(~alone)
        for skips in range(KEPT_SKIPS):
            def make(which):
                x = left[which]
                return self._segments(data, starts[x], ends[x], keys[x], limit, depth[x])

            if not len(left):
                break
            begin[left], size[left] = self.cache.spans(state[left], make, keep=skips > 0)
            store = self.cache.store
            number = store[begin[left]].astype(np.int64)
            begin[left] += 1 + number
            size[left] -= 1 + number
            total = np.cumsum(number)
            owner = np.repeat(np.arange(len(left)), number)
            met = store[np.arange(total[-1]) + np.repeat(begin[left] - total, number)].astype(np.int64)
            hit = np.flatnonzero(_keyed_many(keys[left][owner], met >> 10, met >> 5 & 31, met & 31) < limit)
            hit = hit[np.diff(owner[hit], prepend=-1) > 0]  # each one's first skip
            which = owner[hit]
            left, step = left[which], hit - (total - number)[which]
            depth[left] += step + 1
            state[left] = tc.mix(state[left] ^ tc.mix(depth[left].astype(tc.U64)))
        alone[left] = True
        own = np.flatnonzero(alone)
        if len(own):
            ids, size[own] = self._segments(data, starts[own], ends[own], keys[own], limit)
        bounds = np.concatenate([[0], np.cumsum(size)])
        kept = np.flatnonzero(~alone)
        out = np.empty(bounds[-1], np.int32)
        end = np.cumsum(size[kept])
        inside = np.arange(end[-1] if len(end) else 0)
        out[inside + np.repeat(bounds[kept] - end + size[kept], size[kept])] = self.cache.store[inside + np.repeat(begin[kept] - end + size[kept], size[kept])]
        if len(own):
            end = np.cumsum(size[own])
            out[np.arange(end[-1]) + np.repeat(bounds[own] - end + size[own], size[own])] = ids
        return out, bounds

    def decode(self, ids: np.ndarray, ptr: np.ndarray) -> list[bytes]:
        """Texts of id lists: the pieces' bytes without the space set before them."""
        size = self.raw_size[ids]
        total = np.concatenate([[0], np.cumsum(size)])
        data = self.raw_bytes[np.arange(total[-1]) + np.repeat(self.raw_start[ids] - total[:-1], size)].tobytes()
        at = total[ptr].tolist()
        return [data[a + 1:b] for a, b in zip(at[:-1], at[1:], strict=True)]


_models: dict[tuple, Pieces] = {}


def model(path: str, *variant) -> Pieces:
    """The task's model for one setting (its cache depends on seed and dropout)."""
    if (path, *variant) not in _models:
        _models.clear()
        _models[path, *variant] = Pieces(path)
    return _models[path, *variant]


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """``docs`` with ``ids``."""
    small_batches(docs.sparkSession)
    docs = docs.select(*[c for c in docs.columns if c != "ids"])
    names = docs.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(batches):
        pieces = model(path, dropout, seed)
        for batch in batches:
            owners = batch.column("__llm_owner").to_numpy()
            for lo, hi, data, off in tc.blocks(batch.column(text)):
                ids, ptr = pieces.encode(data, off, owners[lo:hi], dropout, seed)
                yield pa.RecordBatch.from_arrays([*(batch.column(c)[lo:hi] for c in names),
                                                  pa.ListArray.from_arrays(pa.array(ptr.astype(np.int32)), pa.array(ids))], names=[*names, "ids"])
        pieces.cache = IdCache()  # the worker process may go on to other work

    return docs.withColumn("__llm_owner", F.coalesce(F.col(key).cast("long"), F.lit(-1))).mapInArrow(run, f"{fields}, ids array<int>")


def decode(rows: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``rows`` with the text of ``ids``."""
    rows = rows.select(*[c for c in rows.columns if c != name])
    names = rows.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    def run(batches):
        pieces = model(path, "decode")
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                lists = part.column(ids).fill_null([]) if part.column(ids).null_count else part.column(ids)
                ptr = lists.offsets.to_numpy().astype(np.int64)
                values = lists.values.to_numpy()[ptr[0]:ptr[-1]]
                texts = [t.decode() for t in pieces.decode(values, ptr - ptr[0])]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*names, name])

    return rows.mapInArrow(run, f"{fields}, `{name}` string")
