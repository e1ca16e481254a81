"""Operators on documents against brute force, on awkward texts."""

import random
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import helpers as h
from velograph.llm import huffman, line_dedup, nb_svm, ngram_join, pieces, substring_dedup, textcodes as tc, wu_manber

TEXTS = h.awkward_texts()
DOCS = dict(enumerate(TEXTS))
NO_ROWS = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    """Texts in several partitions, with columns named like results and internals."""
    rows = [(i, t, "x", 7, 1.5) for i, t in DOCS.items()]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words string, label int, score double").repartition(5).cache()


def test_words_and_hashes_follow_the_pattern():
    for lo, hi, data, off in tc.blocks(pa.array(TEXTS), limit=3000):
        w = tc.split_words(data, off, tc.SPACED, lower=True)
        codes, raw = tc.word_hashes(w), w.data.tobytes()
        grams, ptr = tc.ngram_hashes(codes, w.ptr, 3)
        text, at = tc.joined(w)
        for i in range(lo, hi):
            a, b = w.ptr[i - lo], w.ptr[i - lo + 1]
            want = [x.encode() for x in h.SPACED.findall(h.lower(TEXTS[i]))]
            assert [raw[s:e] for s, e in zip(w.starts[a:b], w.ends[a:b], strict=True)] == want
            assert text[at[i - lo]:at[i - lo + 1]].tobytes() == b" ".join(want)
            assert ptr[i - lo + 1] - ptr[i - lo] == max(0, len(want) - 2)
            seen = {}
            for x, c in zip(want, codes[a:b].tolist(), strict=True):
                assert seen.setdefault(x, c) == c
            assert len(set(seen.values())) == len(seen)
            windows = [tuple(want[j:j + 3]) for j in range(len(want) - 2)]
            assert len(set(windows)) == len(set(grams[ptr[i - lo]:ptr[i - lo + 1]].tolist()))


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80)])
def test_ngram_join(docs, k, percent):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs, k=k, percent=percent).collect()}
    assert got == h.near_duplicates(DOCS, k, percent)


def test_ngram_join_connects_a_group_without_a_common_hub(spark):
    """Near copies in a chain: only neighbours link."""
    words = [f"w{i}" for i in range(400)]
    chain = {i: " ".join(words[6 * i:6 * i + 200]) for i in range(30)}
    many = {100 + i: " ".join([*words[:150], f"x{i}", *words[150:300]]) for i in range(60)}  # all link with each other or none
    both = chain | many
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in
           ngram_join.near_duplicates(spark.createDataFrame(list(both.items()), NO_ROWS), k=3, percent=90).collect()}
    assert got == h.near_duplicates(both, 3, 90)


def test_ngram_join_empty_null_and_repeated(spark):
    assert ngram_join.near_duplicates(spark.createDataFrame([], NO_ROWS)).collect() == []
    rows = [(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (9, "a b c d e f"), (5, None), (6, "")]
    got = sorted(map(tuple, ngram_join.near_duplicates(spark.createDataFrame(rows, NO_ROWS)).select("doc_id", "n_shingles", "component_id").collect()), key=str)
    assert got == sorted([(None, 2, None), (4, 2, 4), (4, 2, 4), (9, 2, 4), (5, 0, 5), (6, 0, 6)], key=str)


def test_ngram_join_links_all_texts_of_a_repeated_id(spark):
    """An id with two texts, each the first of its class, each with a near copy."""
    a, b = ([f"{x}{i}" for i in range(100)] for x in "ab")
    rows = [(1, " ".join(a)), (1, " ".join(b)), (1, " ".join(a)), (2, " ".join([*a, "z"])), (3, " ".join([*b, "z"])), (4, "other words than these here")]
    got = sorted((r.doc_id, r.component_id) for r in ngram_join.near_duplicates(spark.createDataFrame(rows, NO_ROWS), k=3, percent=90).collect())
    assert got == [(1, 1), (1, 1), (1, 1), (2, 1), (3, 1), (4, 4)]


@pytest.mark.parametrize("size", [50, 20, 9])
def test_substring_dedup(docs, size):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.decide(docs, size=size).collect()}
    assert got == h.substring_dedup(DOCS, size)


def test_substring_levels_at_most_double():
    assert substring_dedup.levels(50) == [13, 25, 50]
    for size in range(1, 300):
        steps = substring_dedup.levels(size)
        assert steps[-1] == size and all(b <= 2 * a and a < b for a, b in zip(steps, steps[1:], strict=False))
    x = np.random.default_rng(1).integers(0, 1000, 200)
    for width in (1, 2, 3, 7, 64):
        assert substring_dedup.least(x, width).tolist() == [min(x[i:i + width]) for i in range(len(x) - width + 1)]


def test_substring_empty_null_and_repeated(spark):
    assert substring_dedup.decide(spark.createDataFrame([], NO_ROWS)).collect() == []
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(None, text), (3, text), (3, text), (8, "x " + text + " y"), (9, None)]
    frame = spark.createDataFrame(rows, NO_ROWS).withColumn("kept", F.lit("clash"))
    got = sorted((str(r.doc_id), r.n_removed) for r in substring_dedup.decide(frame).collect())
    assert got == [("3", 0), ("3", 0), ("8", 60), ("9", 0), ("None", 0)]
    out = {(r.doc_id, r.text, r.kept) for r in substring_dedup.remove_repeats(frame).collect()}
    assert out == {(None, text, "clash"), (3, text, "clash"), (8, "x y", "clash"), (9, None, "clash")}


def test_line_dedup(docs):
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text or "") for r in line_dedup.dedup_lines(docs).collect()}
    assert got == h.line_dedup(DOCS)
    assert line_dedup.dedup_lines(docs).columns == [*docs.columns, "n_lines", "n_dropped"]


def test_line_bitmaps_say_the_same(docs):
    want = h.line_dedup(DOCS)
    for r in line_dedup.keep_bitmaps(docs).collect():
        bits = np.unpackbits(np.frombuffer(zlib.decompress(r.keep), np.uint8), bitorder="little")[:r.n_lines]
        lines = (DOCS[r.doc_id] or "").split("\n")
        assert (r.n_lines, r.n_dropped) == want[r.doc_id][:2]
        assert "\n".join(x for x, k in zip(lines, bits, strict=True) if k) == want[r.doc_id][2]


def test_line_dedup_hot_empty_null_and_repeated(spark):
    assert line_dedup.dedup_lines(spark.createDataFrame([], NO_ROWS)).collect() == []
    line = "the very same line of all"
    rows = [(i, f"{line}\nown {i}") for i in range(3000)] + [(None, line), (2999, f"{line}\nown 2999")]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, NO_ROWS).repartition(7)).collect()
    assert len(got) == 3002
    assert sorted((r.doc_id or -1, r.text) for r in got if r.n_dropped == 0) == [(-1, line), *[(2999, f"{line}\nown 2999")] * 2]


def test_wu_manber(docs, spark):
    long = h.SPACED.findall(TEXTS[-1])
    items = [(1, " ".join(long[100:160])), (2, TEXTS[13]), (3, "one two"), (None, TEXTS[40]), (5, None), (6, ""), (7, "Changed"), (2, TEXTS[20]),
             (8, " ".join(long[5:18])), (9, " , ".join(long[5:17]))]
    want = h.contamination(DOCS, items)
    table = spark.createDataFrame(items, "item_id long, text string")
    for part_bytes in (1 << 20, 600):  # one pass, several passes
        out = wu_manber.contaminated(docs, table, part_bytes=part_bytes)
        assert out.columns == [*[c for c in docs.columns if c != "n_words"], "n_words", "hit_spans", "item_ids", "n_hit", "contaminated"]
        rows = out.collect()
        assert {r.doc_id: (r.n_words, r.n_hit, r.item_ids) for r in rows} == want
        assert all(r.contaminated == (r.n_hit > 0 and 20 * r.n_hit >= r.n_words) for r in rows)


def test_wu_manber_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in wu_manber.contaminated(docs, none).collect())
    assert wu_manber.contaminated(spark.createDataFrame([], NO_ROWS), none).collect() == []


def test_huffman_files_hold_the_tokenizers_ids(spark, docs, tmp_path):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    extra = {1000: "it's 'twas o'clock 12a3 <|endoftext|> <|startoftext|>x", 1001: "ﬁ Å é ́x a b\x1cc", 1002: "don't,stop!!" * 50}
    frame = docs.select("doc_id", "text").union(spark.createDataFrame(list(extra.items()), NO_ROWS))
    huffman.write_ids(frame, str(tmp_path / "ids"), path, end_id=2)
    rows = huffman.read_ids(spark, str(tmp_path / "ids")).collect()
    tokenizer, start = Tokenizer.from_file(path), 0
    got = {r.doc_id: r for r in rows}
    for i, text in sorted((DOCS | extra).items()):
        want = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        assert (got[i].ids, got[i].start, got[i].n_tokens) == (want, start, len(want))
        start += len(want)
    checked = {r.doc_id: r.ids_crc32 for r in huffman.read_ids(spark, str(tmp_path / "ids"), digest=True).collect()}
    assert checked == {i: zlib.crc32(np.array(r.ids, "<u4").tobytes()) for i, r in got.items()}


def test_huffman_null_ids_and_empty_table(spark, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    huffman.write_ids(spark.createDataFrame([], NO_ROWS), str(tmp_path / "none"), path, end_id=2)
    assert huffman.read_ids(spark, str(tmp_path / "none")).collect() == []
    rows = [(5, "b"), (None, "a"), (5, "b"), (1, None)]
    huffman.write_ids(spark.createDataFrame(rows, NO_ROWS), str(tmp_path / "few"), path, end_id=2)
    assert [(r.doc_id, r.start, r.n_tokens) for r in huffman.read_ids(spark, str(tmp_path / "few")).orderBy("start").collect()] == [
        (None, 0, 2), (1, 2, 1), (5, 3, 2), (5, 5, 2)]


@pytest.mark.parametrize("counts", [[5], [0, 3, 0], [1, 1], list(range(200)), [2 ** min(i, 40) for i in range(60)], [1] * 1000 + [10**9]])
def test_code_lengths_are_limited_and_complete(counts):
    counts = np.array(counts)
    lengths = huffman.code_lengths(counts, 12)
    used = lengths[counts > 0]
    assert (lengths[counts == 0] == 0).all() and used.max() <= 12
    if len(used) > 1:
        assert sum(2.0 ** -used.astype(float)) == 1
    ids = np.repeat(np.flatnonzero(counts), 3)
    np.random.default_rng(0).shuffle(ids)
    full = huffman.code_lengths(counts)
    data, offsets = huffman.pack(ids, full, huffman.codes_of(full))
    assert huffman.unpack(data, offsets, len(ids), *huffman.decode_table(full)).tolist() == ids.tolist()


def test_pieces_without_dropout_are_the_librarys():
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    library, model = sentencepiece.SentencePieceProcessor(model_file=path), pieces.Pieces(path)
    texts = [t for t in TEXTS if t and "▁" not in t] + ["  two  spaces ", "tab\tline\n\nend", "😀 <0x0A> </s>", "a" * 300]
    for lo, hi, data, off in tc.blocks(pa.array(texts)):
        ids, ptr = model.encode(data, off, np.arange(lo, hi), 0.0, 1)
        for i in range(lo, hi):
            assert ids[ptr[i - lo]:ptr[i - lo + 1]].tolist() == library.encode(texts[i])


def test_pieces_vary_and_decode_exactly(spark, docs):
    path = public_tokenizers.path("piece_bpe_32k.model")
    once = pieces.decode(pieces.encode(docs, path, dropout=0.3), path)
    assert once.columns == [*docs.columns, "ids", "decoded"]
    rows = {r.doc_id: r for r in once.collect()}
    assert all(rows[i].decoded == (t or "") for i, t in DOCS.items())
    again = {r.doc_id: r.ids for r in pieces.encode(docs.repartition(2), path, dropout=0.3).collect()}
    assert again == {i: r.ids for i, r in rows.items()}
    other = {r.doc_id: r.ids for r in pieces.encode(docs, path, dropout=0.3, seed=5).collect()}
    plain = {r.doc_id: r.ids for r in pieces.encode(docs, path, dropout=0).collect()}
    assert other[len(TEXTS) - 1] != again[len(TEXTS) - 1] and len(plain[len(TEXTS) - 1]) < len(again[len(TEXTS) - 1])
    copies = spark.createDataFrame([(i, "internationalization of everything") for i in range(20)], NO_ROWS)
    assert len({tuple(r.ids) for r in pieces.encode(copies, path, dropout=0.3).collect()}) > 3
    assert pieces.decode(pieces.encode(spark.createDataFrame([], NO_ROWS), path), path).collect() == []
    odd = pieces.decode(pieces.encode(spark.createDataFrame([(None, "x"), (None, None)], NO_ROWS), path), path).collect()
    assert [r.decoded for r in odd] == ["x", ""]


def test_pieces_skip_by_occurrence():
    """Each occurrence has skips of its own, as if segmented alone, at the rate of the dropout."""
    model = pieces.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    n, limit = 4000, int(0.1 * (1 << 32))
    words = [" the", " internationalization", " of", "\n", " é日ß", " " + "abcdefgh" * 5]
    text = "".join(words)
    data = np.frombuffer((text[1:] * n).encode(), np.uint8)
    ids, ptr = model.encode(data, np.array([0, len(data)]), np.array([7]), 0.1, 3)
    assert b"".join(model.raw[i] for i in ids[ptr[0]:ptr[1]]) == b" " + data.tobytes()
    of = {}
    for word in (" the", " of", " internationalization"):
        copies = np.frombuffer((word * n)[1:].encode(), np.uint8)
        ids, _ = model.encode(copies, np.array([0, len(copies)]), np.array([7]), 0.1, 3)
        codes = tc.word_hashes(tc.Words(np.frombuffer(word.encode(), np.uint8), np.array([0]), np.array([len(word)]), np.array([0, 1])))
        owner = tc.mix(np.array([7 + 3], tc.U64))
        keys = tc.mix(codes ^ tc.mix(owner + np.arange(n, dtype=tc.U64)))
        each = [tuple(model.segment(word, int(k), limit)) for k in keys]
        assert ids.tolist() == [i for x in each for i in x]
        of[word] = each
    assert len(set(of[" internationalization"])) > 8
    for word in (" the", " of"):
        plain = tuple(model.segment(word, 0, 0))
        assert 0.05 < sum(x != plain for x in of[word]) / n < 0.35


def _marked(n):
    """Good and bad texts; the bad ones shout."""
    rows, labels = [], []
    for i in range(n):
        words = [f"w{(i * 7 + j * j) % 97}" for j in range(5 + i % 40)]
        bad = i % 4 == 0
        rows.append((i, " ".join(x.upper() + "!!" for x in words) if bad else " ".join(words) + "."))
        labels.append((i, 0 if bad else 1, 0))
    return rows, labels


def test_classifier_on_rows_it_has_not_seen(spark):
    rows, labels = _marked(400)
    docs = spark.createDataFrame([*rows, (None, None), (900, None), (901, ""), (902, "x " * 50_000)], NO_ROWS).withColumn("predicted", F.lit("clash"))
    known = spark.createDataFrame([*labels, (None, 1, 0), (3, None, 0), (7777, 0, 0)], "doc_id long, quality int, toxic int")
    model = nb_svm.fit(docs, known)
    out = nb_svm.score(docs, model).withColumn("held_out", nb_svm.held_out(F.col("doc_id"))).collect()
    assert len(out) == 404 and all(0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out if r.doc_id is not None)
    assert len(held) > 40 and sum(r.predicted == (r.doc_id % 4 > 0) for r in held) >= 0.97 * len(held)
    flipped = spark.createDataFrame([(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in labels], known.schema)
    same = nb_svm.score(docs, nb_svm.fit(docs, flipped)).collect()  # held-out labels play no part
    assert sorted(r.score for r in same) == pytest.approx(sorted(r.score for r in out))


def test_classifier_without_both_classes(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], NO_ROWS)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in nb_svm.score(docs, nb_svm.fit(docs, none)).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1, 0) for i in range(9)], none.schema)
    assert all(r.score > 0.5 for r in nb_svm.score(docs, nb_svm.fit(docs, ones)).collect())
    assert nb_svm.score(spark.createDataFrame([], NO_ROWS), nb_svm.fit(docs, none)).collect() == []


def twin(model, unit, key, limit):
    """Merges one by one: the best pair of the whole unit, skipped by its own hash."""
    s, spans = [model.symbol.get(c, -1) for c in unit], [(i, i + 1) for i in range(len(unit))]
    skipped = set()
    while True:
        found = [(model.merges[s[i] << 32 | s[i + 1]], i) for i in range(len(s) - 1)
                 if s[i] << 32 | s[i + 1] in model.merges and (spans[i][0], *spans[i + 1]) not in skipped]
        if not found:
            break
        best, i = min(found)
        a, b, c = spans[i][0], *spans[i + 1]
        mask = (1 << 64) - 1
        x = (key ^ (a * 0x9E3779B1 + b * 0x85EBCA77 + c * 0xC2B2AE3D)) * 0xBF58476D1CE4E5B9 & mask
        if ((x ^ x >> 31) * 0x94D049BB133111EB & mask) >> 32 < limit:
            skipped.add((a, b, c))
            continue
        s[i:i + 2], spans[i:i + 2] = [best & 0xFFFFFFFF], [(a, c)]
    return [i for x, (a, c) in zip(s, spans, strict=True) for i in ([x] if 0 <= x < model.n_pieces else [model.byte_ids[y] for y in unit[a:c].encode()])]


def test_pieces_of_long_units():
    """A heap and a linked list give the ids of the plain way, in time that grows with the unit."""
    model = pieces.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    pick = random.Random(6)
    for n in (20, 64, 65, 66, 130, 400):
        for letters in ("a", "ab", "theingationédß日", "0123456789abcdef+/"):
            unit = "".join(pick.choices(letters, k=n))
            for limit in (0, 1 << 28, 1 << 31):
                key = pick.getrandbits(64)
                assert model.segment(unit, key, limit) == twin(model, unit, key, limit)
    for unit in ("a" * 1_000_000, "".join(pick.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", k=1_000_000))):
        began = time.time()
        ids = model.segment(unit, 5, 1 << 28)
        assert time.time() - began < 90 and b"".join(model.raw[i] for i in ids).decode() == unit
