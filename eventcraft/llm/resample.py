"""Importance resampling of documents towards a target's word n-grams.

Bytes all the way: one 256-byte table lower-cases A-Z and blanks the ASCII
separators (bytes of other characters stay), ``bytes.split`` gives the words, and
``zlib.crc32`` takes the hash of one n-gram as the seed of the next longer one, so
no n-gram is ever built. Tasks count buckets in Counters that Spark sums; the two
bucket tables, of a set size, give each bucket's gain. A second pass adds up
each document's gains, and seeded Gumbel noise on top makes the highest scores a
sample without replacement.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventcraft.llm.common import slices, write_table
from eventcraft.operators.rank import bucketed_rank, range_buckets

NGRAM, BUCKETS, SEED = 2, 10_000, 7
#: a document needs so many words to be drawn; share of those that is
LEAST_WORDS, SHARE, OF = 20, 25, 100
#: bytes of a text that are split into words at once
PIECE = 1 << 20

#: digits, lower-case letters and bytes above 127 stay, A-Z are lowered, all others are blanks
TABLE = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower())


def pieces(data: bytes, size: int = PIECE) -> Iterator[bytes]:
    """Parts of about ``size`` bytes that end before a blank."""
    start = 0
    while start < len(data):
        end = data.find(b" ", start + size)
        end = len(data) if end < 0 else end
        yield data[start:end]
        start = end


def text_buckets(text: str | None, ngram: int = NGRAM, buckets: int = BUCKETS,
                 size: int = PIECE) -> Iterator[tuple[int, np.ndarray]]:
    """Words, and buckets of the runs of 1 to ``ngram`` words that end in them, part by part."""
    last: list[bytes] = []  # words that n-grams of the next part begin with
    for piece in pieces((text or "").encode().translate(TABLE), size):
        words = last + piece.split()
        old = len(last)
        chain = list(map(zlib.crc32, words))
        out = chain[old:]
        for k in range(1, ngram):
            chain = list(map(zlib.crc32, words[k:], map(zlib.crc32, repeat(b" "), chain)))
            out += chain[max(0, old - k):]
        if len(words) > old:
            yield len(words) - old, np.array(out, dtype=np.int64) % buckets
        last = words[-(ngram - 1):] if ngram > 1 else []


def bucket_counts(docs: DataFrame, text_col: str = "text", ngram: int = NGRAM,
                  buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): n-grams of all texts by bucket, summed from one Counter per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                for _, found in text_buckets(text, ngram, buckets):
                    total.update(found.tolist())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total.keys()), pa.int32()), pa.array(list(total.values()), pa.int64())],
            names=["bucket", "n"])

    return docs.select(F.col(text_col).cast("string")).mapInArrow(
        run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """floor(1000 * log ratio) of each bucket, both sides smoothed by one.

    Each side sends at most ``buckets`` rows to the driver.
    """
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for counts, df in ((s, source), (t, target)):
        for r in df.collect():
            counts[r["bucket"]] = r["n"]
    all_s, all_t = int(s.sum()) + buckets, int(t.sum()) + buckets
    return [math.floor(1000 * math.log((float(y + 1) * float(all_s)) / (float(x + 1) * float(all_t))))
            for x, y in zip(s.tolist(), t.tolist(), strict=True)]


def weights(docs: DataFrame, gain: list[int], id_col: str = "doc_id", text_col: str = "text",
            ngram: int = NGRAM) -> DataFrame:
    """doc_id, n_words, n_features and the floored mean gain of each document (none: 0)."""
    table = np.array(gain, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            words, features, weight = [], [], []
            for text in b.column(1).to_pylist():
                w = n = total = 0
                for k, found in text_buckets(text, ngram, len(table)):
                    w, n, total = w + k, n + len(found), total + int(table[found].sum())
                words.append(w)
                features.append(n)
                weight.append(total // n if n else 0)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(x, pa.int64()) for x in (words, features, weight))],
                names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def noise(id_col: str, seed: int) -> Column:
    """floor(1000 * Gumbel noise) from the id's hash under ``seed``; a null id counts as empty text."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text", ngram: int = NGRAM, buckets: int = BUCKETS,
             seed: int = SEED, least_words: int = LEAST_WORDS, share: int = SHARE,
             of: int = OF) -> DataFrame:
    """Every document's doc_id, n_features, weight, score and rank (null where not drawn).

    Words are runs of digits, letters a-z (A-Z lowered) and non-ASCII characters.
    Of the N documents with ``least_words`` words or more, the floor(share * N / of)
    highest scores are drawn, ties to the smaller id, null ids last among them.
    Null and empty texts have no features, weight 0 and are never drawn. Rows that
    share an id share its noise; ties among them go by weight, then features. Other
    columns are left out; an empty table gives no rows, and an empty target gives
    all its buckets the smoothed count.
    """
    gain = gains(bucket_counts(docs, text_col, ngram, buckets),
                 bucket_counts(target, target_col, ngram, buckets), buckets)
    scored = write_table(weights(docs, gain, id_col, text_col, ngram).withColumn(
        "score", F.col("weight") + noise("doc_id", seed)), "weights")
    able = F.col("n_words") >= least_words
    count = scored.where(able).count()
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("weight").desc(),
             F.col("n_features").desc()]
    ranked = bucketed_rank(range_buckets(scored.where(able), order, name="__range", rows=count), [],
                           F.col("__range"), order, offsets_broadcast=True)
    out = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*out, F.when(F.col("rank") <= share * count // of, F.col("rank")).alias(
        "rank")).unionByName(scored.where(~able).select(*out, F.lit(None).cast("bigint").alias("rank")))
