"""Language ID by compression (operator 12).

Each learned language has a zstandard raw-content dictionary. A text is reduced to
its letters (lower-cased, everything else one space) and cut into pieces of
``PIECE`` bytes, so that a long text does not become its own dictionary; every
piece of the whole text is compressed with every language's dictionary, and the
language with the smallest sum is chosen. A choice is ``accepted`` where the second
smallest sum is at least ``min_margin`` (a share of itself) larger; narrower ones
are rejected.

Dictionaries are filled from a bounded sample of the learning rows: for each
language about ``SAMPLE`` different texts, chosen by a hash of the text (so copies
count once), up to ``TAKE`` characters of each from a place that follows from the
hash, until ``SIZE`` bytes are full. Languages go through a text in parts of
``AT_ONCE``, so that at most ``AT_ONCE * SIZE`` bytes are broadcast at a time.

Learning rows are those with a language whose crc32 of the id (as text) does not
leave remainder ``HELD`` mod ``FOLDS``. Predictions depend on the text alone.

Defined results: a null text and one without a letter is ``und`` with score 0, not
accepted; so is every text if nothing was learned. A null id counts as empty text
for the remainder. Equal sums go to the language with more learning rows, then the
smaller name. ``score`` is 2^-best over the sum of 2^-size of all languages, sizes
in bytes. ``margin`` is null where there is only one language. Input columns stay,
but for ones named like the results.
"""

from __future__ import annotations

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from velograph.llm.scratch import small_batches

FOLDS = 4
HELD = 2
PIECE = 256
LEVEL = 9
SIZE = 1 << 16
SAMPLE = 256
TAKE = 1000
AT_ONCE = 64
MIN_MARGIN = 0.01
UNKNOWN = "und"
RESULTS = ("lang_pred", "score", "margin", "accepted")


def held_out(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD


def letters(text: Column) -> Column:
    """Lower-cased words of letters and marks, a space around each; null without a letter."""
    plain = F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}]+", " ")
    return F.when(plain.rlike(r"\p{L}"), F.concat(F.lit(" "), F.trim(plain), F.lit(" ")))


class Model:
    """Languages, most learning rows first, and the dictionary text of each."""

    def __init__(self, languages: list[str], contents: list[bytes]):
        self.languages, self.contents = languages, contents


def compressors(contents: list[bytes]) -> list[zstandard.ZstdCompressor]:
    out = []
    for content in contents:
        how = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, source_size=PIECE, dict_size=len(content), write_content_size=False, write_checksum=False, write_dict_id=False)
        words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(compression_params=how)
        out.append(zstandard.ZstdCompressor(dict_data=words, compression_params=how))
    return out


def sizes(text: bytes, with_each: list[zstandard.ZstdCompressor]) -> list[int]:
    """Compressed bytes of all pieces of a text, per compressor."""
    pieces = [text[at:at + PIECE] for at in range(0, len(text), PIECE)]
    return [sum(len(c.compress(piece)) for piece in pieces) for c in with_each]


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Fill a dictionary for every language of the learning rows."""
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(F.col(key)))
    rows = rows.select(F.col(lang).cast("string").alias("lang"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))
    counted = rows.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("hash").alias("texts"))
    counted = sorted(counted.collect(), key=lambda r: (-r.n, r.lang))
    if not counted:
        return Model([], [])
    share = F.lit(0.0)
    for r in counted:
        share = F.when(F.col("lang") == r.lang, min(1.0, SAMPLE / max(1, r.texts))).otherwise(share)
    taken = rows.where(F.pmod("hash", F.lit(1 << 30)) < share * (1 << 30)).dropDuplicates(["lang", "hash"])
    plain = taken.select("lang", "hash", letters(F.col("text")).alias("plain")).where("plain IS NOT NULL")
    free = F.greatest(F.length("plain") - TAKE, F.lit(0)) + 1
    parts = plain.select("lang", "hash", F.substring("plain", (F.pmod(F.xxhash64("hash"), free) + 1).cast("int"), F.lit(TAKE)).alias("part"))
    contents = {r.lang: b"" for r in counted}
    for r in sorted(parts.collect(), key=lambda r: (r.lang, r.hash)):
        if len(contents[r.lang]) < SIZE:
            contents[r.lang] += r.part.encode()
    known = [r.lang for r in counted if len(contents[r.lang]) >= 8]  # zstandard's least raw content
    return Model(known, [contents[x][:SIZE] for x in known])


def predict(docs: DataFrame, model: Model, text: str = "text", min_margin: float = MIN_MARGIN) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score``, ``margin`` and ``accepted``."""
    names = [c for c in docs.columns if c not in RESULTS or c == text]
    if text in RESULTS:
        raise ValueError(f"the text column must not be named {text}")
    spark = docs.sparkSession
    small_batches(spark)
    kept = [f"input_{i}" for i in range(len(names))]
    out = docs.select(*(F.col(f"`{c}`").alias(k) for c, k in zip(names, kept, strict=True)), letters(F.col(f"`{text}`")).alias("plain"),
                      F.array().cast("array<bigint>").alias("sizes"))
    for at in range(0, len(model.languages), AT_ONCE):
        out = out.mapInArrow(_measure(spark.sparkContext.broadcast(model.contents[at:at + AT_ONCE])), out.schema)
    tried = F.size("sizes") > 0
    best, ordered = F.array_min("sizes"), F.array_sort("sizes")
    languages = F.array(*(F.lit(x) for x in model.languages)).cast("array<string>")
    weight = F.aggregate("sizes", F.lit(0.0), lambda acc, s: acc + F.pow(F.lit(2.0), (best - s).cast("double")))
    out = out.select(*kept, F.when(tried, F.get(languages, (F.array_position("sizes", best) - 1).cast("int"))).otherwise(F.lit(UNKNOWN)).alias("lang_pred"),
                     F.when(tried, 1 / weight).otherwise(F.lit(0.0)).alias("score"),
                     F.when(tried, (F.get(ordered, F.lit(1)) - best) / F.get(ordered, F.lit(1))).alias("margin"))
    accepted = (F.col("lang_pred") != UNKNOWN) & F.coalesce(F.col("margin") >= min_margin, F.lit(True))
    return out.withColumn("accepted", accepted).toDF(*names, *RESULTS)


def _measure(shared):
    """Append the sizes under some languages' dictionaries; ``plain`` and ``sizes`` come last."""
    def run(batches):
        with_each = compressors(shared.value)
        for batch in batches:
            before = batch.columns[-1].to_pylist()
            found = [old if plain is None else old + sizes(plain, with_each)
                     for plain, old in zip(_bytes(batch.columns[-2]), before, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.list_(pa.int64()))], names=batch.schema.names)
    return run


def _bytes(column: pa.Array):
    for value in column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()):
        yield value.as_py()
