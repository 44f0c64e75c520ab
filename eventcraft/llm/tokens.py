"""Token ids of whole texts by a public vocabulary, and Parquet token files.

``WordIds`` gives the ids of the installed tokenizers library. White space
always ends a token of this vocabulary and is dropped, so the ids of a text
are those of its words in order; the texts of a slice are taken together, and
each of their distinct words is encoded once.

Token files (``write_tokens``) are Parquet with one row per document in
ascending id order: ``tokens`` is a dictionary-encoded list column, the
counters are delta-encoded, row groups and pages have a set size, and the
writer's page indexes let a reader fetch a few documents, or the counters
alone, without reading the rest.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventcraft.llm.common import HELD, Recent, int_lists, slices, text_bytes

END_ID = 2
#: words that only the library encodes, kept by a Python worker in each of two generations
CACHE_WORDS = 120_000
#: bytes of a word from which the library itself encodes it: the faster encoder takes
#: time in the square of a part's length
LONG_PART = 1 << 9
#: bytes of text whose words are encoded together
STEP_BYTES = 4 << 20

_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: all but printable ASCII without the apostrophe, Latin-1 letters, and the mark of an end
_NOT_PLAIN = "[^!-&(-~À-ÖØ-öø-ÿ]|<\\|"
_PARTS = f"([{_LETTERS}]+|[0-9]|[^0-9{_LETTERS}]+)"


#: stands for a word part's end; no word has it, as it is white space
_END = "\n"


def _byte_letters() -> dict[int, str]:
    """The letter that a byte-level vocabulary writes for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordIds:
    """Ids of texts as little-endian unsigned 32-bit numbers.

    The ids of this kind of vocabulary ascend in merge order (bytes, bytes that end a
    word, merges), so they are the ranks that a byte-pair encoder merges by, with one
    byte of white space in place of the word-end mark.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        from tiktoken import Encoding
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(path)
        byte = {c: b for b, c in _byte_letters().items()}
        ranks = {}
        for piece, i in self.whole.get_vocab(False).items():
            mark = piece.removesuffix("</w>")
            if all(c in byte for c in mark) and (mark or piece == "</w>"):
                ranks[bytes(byte[c] for c in mark) + _END.encode() * (mark != piece)] = i
        ranks.pop(_END.encode(), None)  # the byte itself is never inside a word ...
        ranks[_END.encode()] = max(ranks.values()) + 1  # ... but the encoder wants every byte
        self.pieces = Encoding("parts", pat_str=f"[^{_END}]+{_END}", mergeable_ranks=ranks,
                               special_tokens={})
        self.ends = np.zeros(max(ranks.values()) + 1, dtype=bool)
        self.ends[[i for x, i in ranks.items() if x.endswith(_END.encode())]] = True
        self.cache = Recent(cache_words, 64)

    def _odd(self, word: str) -> bytes:
        """A word by the library itself."""
        return array("I", self.whole.encode(word, add_special_tokens=False).ids).tobytes()

    def _plain(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of short words of plain characters, by one call, and how many each word has."""
        parts = pc.replace_substring_regex(words, _PARTS, f"\\1{_END}")
        ids = self.pieces.encode_to_numpy(text_bytes(parts)[0].tobytes().decode().lower())
        last = np.cumsum(pc.count_substring(parts, _END).to_numpy())
        stop = np.concatenate([[0], np.flatnonzero(self.ends[ids]) + 1])[last]
        return ids.astype("<u4", copy=False), np.diff(stop, prepend=0)

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids of distinct words, where each word's ids start in them, and how many it has."""
        odd = pc.or_(pc.match_substring_regex(words, _NOT_PLAIN),
                     pc.greater_equal(pc.binary_length(words), LONG_PART))
        ids, n = self._plain(words.filter(pc.invert(odd)))
        odd = odd.to_numpy(zero_copy_only=False)
        if not odd.any():
            return ids, np.cumsum(n) - n, n
        rest = words.filter(pa.array(odd)).to_pylist()
        known = self.cache.fill(rest, self._odd)
        rest = [known[w] for w in rest]
        n = np.concatenate([n, np.fromiter(map(len, rest), np.int64, len(rest)) // 4])
        ids = np.concatenate([ids, np.frombuffer(b"".join(rest), dtype="<u4")])
        order = np.argsort(np.argsort(odd, kind="stable"), kind="stable")  # the odd ones are last
        return ids, (np.cumsum(n) - n)[order], n[order]

    def texts(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a column of texts (null: none) end to end, and the texts' offsets in them."""
        lists = pc.ascii_split_whitespace(col.cast(pa.string()).fill_null(""))
        words = lists.flatten().dictionary_encode()
        ids, start, n = self._words(words.dictionary)
        which = words.indices.to_numpy()
        n = n[which]
        after = np.concatenate([[0], np.cumsum(n)])
        at = np.arange(after[-1])
        at += np.repeat(start[which] - after[:-1], n)
        return ids[at], after[lists.offsets.to_numpy()]

    def ids(self, text: str | None) -> bytes:
        return self.texts(pa.array([text], pa.string()))[0].tobytes()


_LOADED: dict[str, WordIds] = HELD.setdefault("tokens", {})


def word_ids(path: str | None = None) -> WordIds:
    """The worker's tokenizer for ``path`` (default: the 49k word vocabulary)."""
    path = path or public_tokenizers.path("word_bpe_49k.json")
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


def in_id_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text) dealt into ascending id ranges and sorted inside them.

    A hash of the text breaks ties, so repeated ids are split over ranges too.
    """
    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                    F.col(text_col).cast("string").alias("text"))
    d = d.withColumn("tie", F.xxhash64("text"))
    return d.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").select(
        "doc_id", "text")


TOKEN_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("part", T.IntegerType()),
    T.StructField("local_start", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("tokens", T.ArrayType(T.IntegerType()))])


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           vocabulary: str | None = None, end_id: int | None = END_ID) -> DataFrame:
    """One row per document in id order: its ids, and the ids before it in its range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, before, own = TaskContext.get().partitionId(), 0, word_ids(vocabulary)
        for b in slices(batches, limit=STEP_BYTES):
            ids, off = own.texts(b.column(1))
            if end_id is not None:
                ids, off = np.insert(ids, off[1:], end_id), off + np.arange(len(off))
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array(np.full(b.num_rows, part, np.int32)),
                pa.array(before + off[:-1]), pa.array(np.diff(off)),
                int_lists(ids.view("<i4"), off, pa.int32())], names=TOKEN_SCHEMA.names)
            before += int(off[-1])

    return in_id_order(docs, id_col, text_col).mapInArrow(run, TOKEN_SCHEMA)


#: Parquet settings of a token file; sizes in bytes, pages also in rows
FILE_OPTIONS = {
    "compression": "zstd", "parquet.writer.version": "v2",
    "parquet.block.size": str(32 << 20), "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.enable.dictionary": "true", "parquet.dictionary.page.size": str(1 << 20),
    "parquet.enable.dictionary#doc_id": "false", "parquet.enable.dictionary#local_start": "false",
    "parquet.enable.dictionary#n_tokens": "false",
}


def write_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str | None = None, end_id: int | None = END_ID,
                 options: dict[str, str] | None = None) -> None:
    """Encode ``docs`` and write ``path/data`` and ``path/ranges``.

    ``ranges`` has one row per id range: the ids before it, so that a document's
    place in the whole id stream is ``first + local_start``. It is worked out
    from the counters just written, which are the only columns read for it.
    Null texts are empty (the end id alone), null ids come first, rows that
    share an id follow each other in the order of a hash of their text; an
    empty table gives files without rows. Other columns are left out.
    """
    spark = docs.sparkSession
    encode(docs, id_col, text_col, vocabulary, end_id).write.options(
        **(FILE_OPTIONS | (options or {}))).parquet(f"{path}/data")
    per = spark.read.schema(TOKEN_SCHEMA).parquet(f"{path}/data").groupBy("part").agg(
        F.sum("n_tokens").alias("n"), F.count(F.lit(1)).alias("docs")).collect()  # one per range
    rows, first = [], 0
    for r in sorted(per, key=lambda r: r["part"]):
        rows.append((r["part"], first, r["n"], r["docs"]))
        first += r["n"]
    spark.createDataFrame(rows, "part int, first bigint, n_tokens bigint, n_docs bigint").coalesce(
        1).write.parquet(f"{path}/ranges")


def read_tokens(spark: SparkSession, path: str, tokens: bool = True,
                first_id: int | None = None, last_id: int | None = None) -> DataFrame:
    """Documents of a token file: doc_id, start, n_tokens and, if asked for, tokens.

    Without ``tokens`` the list column is never read; an id range becomes a
    pushed filter that row-group statistics and page indexes answer.
    """
    d = spark.read.schema(TOKEN_SCHEMA).parquet(f"{path}/data")
    if first_id is not None:
        d = d.where(F.col("doc_id") >= first_id)
    if last_id is not None:
        d = d.where(F.col("doc_id") <= last_id)
    ranges = spark.read.schema("part int, first bigint, n_tokens bigint, n_docs bigint").parquet(
        f"{path}/ranges").select("part", "first")
    # one row per id range (a shuffle partition), so this side is small by construction
    d = d.join(F.broadcast(ranges), "part")
    return d.select("doc_id", (F.col("first") + F.col("local_start")).alias("start"), "n_tokens",
                    *(["tokens"] if tokens else []))


def list_crc32(df: DataFrame, column: str, name: str) -> DataFrame:
    """Replace an int list column by the crc32 of its little-endian 32-bit values."""
    keep = [c for c in df.columns if c != column]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column(b.schema.get_field_index(column))
            off = col.offsets.to_numpy()
            flat = np.ascontiguousarray(col.values.to_numpy(zero_copy_only=False), dtype="<i4")
            crc = [zlib.crc32(flat[s:e]) for s, e in zip(off[:-1], off[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index(c)) for c in keep]
                + [pa.array(crc, type=pa.int64())], names=schema.names)

    return df.select(*keep, column).mapInArrow(run, schema)
