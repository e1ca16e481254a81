"""Periodic runs of words by descending-LCP Kruskal (operator 13).

A run of a text is a stretch of consecutive words with smallest period q, at
least ``max(min_length, 2 * q)`` words long, that no neighbouring word extends
keeping period q. Per document:

* Suffixes of its words are ranked by doubling. A run puts a common prefix of at
  least half of ``min_length`` words (``half``) between its start and the word one
  period on, so only suffixes whose first ``half`` words come twice are ranked.
* Neighbours of that order are edges weighted by the length of their longest
  common prefix (LCP). By decreasing LCP a union-find unites their classes; each
  class holds its positions in order. Two positions i < j that become adjacent
  by a union of LCP l, with j - i <= l, seed the stretch i .. j + l - 1 of period
  j - i. At that time every suffix sharing more than l words with either is in its
  class already, so no smaller period fits, and l is exact, so no word follows.
* A seed whose words before i and j agree is the inside of a run that starts
  further left and is left out. The others are the runs, each met once.

Words are compared by 64-bit hashes (about n^2 / 2^65 chance matches among n
different words). Splitting and ranking work on blocks of documents in numpy;
edges, which only repeated passages have, are united one by one.

Defined results: a null or empty text has no runs and an empty ``collapsed``;
rows are judged one by one, so repeated ids, equal texts and null ids change
nothing. Input columns stay, but for ones named like the results. A document is
worked on by one task.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from velograph.llm import textcodes as tc
from velograph.llm.scratch import small_batches

MIN_LENGTH = 12
RESULTS = ("n_words", "runs", "collapsed")
RUN_FIELDS = "struct<start:bigint,length:bigint,period:bigint>"


def ranked(codes: np.ndarray, ptr: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose next ``half`` words come again in their document, in the order of
    their suffixes, and the rank of each one's class of equal first ``half`` words."""
    none = np.zeros(0, np.int64)
    grams, gram_ptr = tc.ngram_hashes(codes, ptr, half)
    if len(grams) < 2:
        return none, none
    counts = np.diff(gram_ptr)
    doc = np.repeat(np.arange(len(counts)), counts)
    grams = tc.mix(grams + doc.astype(tc.U64) * tc.U64(tc.MULT))  # equal within a document only
    inside = np.sort(grams)
    again = tc.distinct(inside[1:][inside[1:] == inside[:-1]])
    if not len(again):
        return none, none
    hit = np.flatnonzero(again[np.minimum(np.searchsorted(again, grams), len(again) - 1)] == grams)
    wanted = hit + (ptr[:-1] - gram_ptr[:-1])[doc[hit]]
    ends = np.zeros(len(codes), np.int64)  # where the document of a word ends
    ends[:] = np.repeat(ptr[1:], np.diff(ptr))
    # a class of length L asks for the rank L words on: half words behind a position in ``wanted``
    behind = wanted + half
    known = tc.distinct(np.concatenate([wanted, behind[behind < ends[wanted]]]))
    owner = np.searchsorted(ptr, known, "right")
    keys = [owner]
    for t in range(half):
        at = known + t
        keys.append(np.where(at < ends[known], codes[np.minimum(at, len(codes) - 1)], tc.U64(0)))
    order = np.lexsort(keys[::-1])
    fresh = np.ones(len(known), bool)
    fresh[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    del keys
    rank = np.full(len(codes), -1, np.int64)  # place of the first member of its class
    rank[known[order]] = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    first_class = rank.copy()
    sizes = np.bincount(rank[known], minlength=len(known))
    live = known[sizes[rank[known]] > 1]
    length = half
    while len(live):
        at = live + length
        second = np.where(at < ends[live], rank[np.minimum(at, len(codes) - 1)], -1)
        by = np.lexsort((second, rank[live]))
        live, second = live[by], second[by]
        old = rank[live]
        group = np.ones(len(live), bool)
        group[1:] = old[1:] != old[:-1]
        part = group.copy()
        part[1:] |= second[1:] != second[:-1]
        heads, parts = np.flatnonzero(group)[np.cumsum(group) - 1], np.flatnonzero(part)
        of = np.cumsum(part) - 1
        rank[live] = old + parts[of] - heads
        live = live[np.diff(np.append(parts, len(live)))[of] > 1]
        length *= 2
    placed = known[np.argsort(rank[known], kind="stable")]
    shared = np.bincount(first_class[placed], minlength=len(known))[first_class[placed]] > 1
    placed = placed[shared]
    return placed, first_class[placed]


def common_prefixes(words: list[int], order: list[int], classes: list[int], end: int) -> list[int]:
    """LCP of each suffix with the one before it in ``order`` (0 where their classes
    differ), by going through the positions in text order: one word on, an LCP
    shrinks by one word at most. ``words`` and positions are those of one document."""
    before = {p: order[k - 1] for k, p in enumerate(order) if k and classes[k] == classes[k - 1]}
    found, reach, last = {}, 0, -2
    for p in sorted(before):
        reach = max(reach - 1, 0) if p == last + 1 else 0
        q = before[p]
        top = end - max(p, q)
        while reach < top and words[p + reach] == words[q + reach]:
            reach += 1
        found[p], last = reach, p
    return [found.get(p, 0) for p in order]


def seeds(edges: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Unite the edges (LCP, a, b), given by decreasing LCP; the pairs of positions that
    become adjacent at a distance within the LCP, as (position, distance, LCP)."""
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}

    def find(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    out = []
    for lcp, a, b in edges:
        a, b = find(a), find(b)
        large, small = members.pop(a, None) or [a], members.pop(b, None) or [b]
        if len(large) < len(small):
            a, b, large, small = b, a, small, large
        parent[b] = a
        lo = 0
        for k, x in enumerate(small):
            lo = bisect_left(large, x, lo)
            # the one before is new to x unless it came from ``small`` just now
            if lo and (not k or large[lo - 1] != small[k - 1]) and x - large[lo - 1] <= lcp:
                out.append((large[lo - 1], x - large[lo - 1], lcp))
            if lo < len(large) and (k + 1 == len(small) or small[k + 1] > large[lo]) and large[lo] - x <= lcp:
                out.append((x, large[lo] - x, lcp))
            large.insert(lo, x)
        members[a] = large
    return out


def runs_of(codes: np.ndarray, ptr: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All runs of a block of documents: document, start (in its words), length, period,
    ordered by document, start and period."""
    half = max(1, (min_length + 1) // 2)
    placed, classes = ranked(codes, ptr, half)
    found = []
    owner = np.searchsorted(ptr, placed, "right") - 1  # ranks ascend by document
    cuts = np.flatnonzero(np.diff(owner)) + 1
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(placed)], strict=True):
        if lo == hi:
            continue
        doc = int(owner[lo])
        base, end = int(ptr[doc]), int(ptr[doc + 1])
        order = (placed[lo:hi] - base).tolist()
        lcp = common_prefixes(codes[base:end].tolist(), order, classes[lo:hi].tolist(), end - base)
        lcp = np.array(lcp)
        by = np.argsort(-lcp, kind="stable")
        by = by[lcp[by] >= half]
        edges = [(int(lcp[k]), order[k - 1], order[k]) for k in by.tolist()]
        start, period, reach = np.array(seeds(edges), np.int64).reshape(-1, 3).T
        long = reach + period >= min_length
        start, period, reach = start[long], period[long], reach[long]
        before = base + start - 1
        whole = (start == 0) | (codes[before] != codes[before + period])
        start, period, reach = start[whole], period[whole], reach[whole]
        by = np.lexsort((period, start))
        found.append(np.stack([np.full(len(by), doc), start[by], (reach + period)[by], period[by]]))
    return tuple(np.concatenate(found, axis=1)) if found else (np.zeros(0, np.int64),) * 4


def _work(names: list[str], text: str, min_length: int):
    def run(batches):
        for batch in batches:
            for lo, hi, data, off in tc.blocks(batch.column(text)):
                w = tc.split_words(data, off, tc.SPACED, lower=False)
                doc, start, length, period = runs_of(tc.word_hashes(w), w.ptr, min_length)
                first = w.ptr[doc] + start
                edge = np.bincount(first + period, minlength=len(w.starts) + 1) - np.bincount(first + length, minlength=len(w.starts) + 1)
                kept, at = tc.joined(w, np.cumsum(edge)[:-1] == 0)
                runs = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], names=["start", "length", "period"])
                runs = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(hi - lo + 1)).astype(np.int32)), runs)
                collapsed = pa.Array.from_buffers(pa.large_string(), hi - lo, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(kept))])
                yield pa.RecordBatch.from_arrays([*(batch.column(c)[lo:hi] for c in names), pa.array(w.counts), runs, collapsed.cast(pa.string())],
                                                 names=[*names, *RESULTS])
    return run


def find_runs(docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (start, length and period of each, in words, by
    start and period) and ``collapsed``: the words that no run contains after its
    first period, joined by one space."""
    if min_length < 2:
        raise ValueError("min_length must be at least 2")
    names = [c for c in docs.columns if c not in RESULTS or c == text]
    if text in RESULTS:
        raise ValueError(f"the text column must not be named {text}")
    docs = docs.select(*(f"`{c}`" for c in names))
    small_batches(docs.sparkSession)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(_work(names, text, min_length), f"{fields}, n_words bigint, runs array<{RUN_FIELDS}>, collapsed string")
