"""Alignment of two tokenizers' tokens over the same bytes.

Byte offsets where a token of each side ends cut a text into groups, and every two
tokens of different sides whose byte ranges overlap are a link. Between two
neighbouring ends of either side lies exactly one link, so links are read off the
merged ends without comparing tokens.

A text up to a chunk's size is aligned in one step. A longer one is cut into byte
ranges that different tasks encode: each side is cut at the first place after the
nominal one which its own rules never span (``Tokens.cuts``), so the sides' cuts can
differ and groups may cross ranges. A range becomes a ``Fragment``: an open prefix
up to its first common end, closed groups, and an open suffix after its last one.
Joining fragments closes the group between them; the operation is associative
with an empty fragment as identity, so fragments are reduced in a tree of tasks.

Corpus counts of linked id pairs: documents are gathered into blocks, each block
sends each of its distinct pairs once, and counts come back per block, so a pair
that every document holds is one row a block.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventcraft.llm.common import runs, slices, sorted_groups, write_table

#: characters of a text that one task encodes at once; longer texts are cut
CHUNK = 1 << 16
#: fragments that one step of the tree joins
FAN = 16
#: links of the documents that look up their counts together
BLOCK_LINKS = 1 << 20
#: pairs sent in one row
PAIR_ROW = 1 << 16
#: bytes of text that one step aligns
STEP_BYTES = 1 << 19
#: bytes without a change between blanks and others from which the heap-based encoder is used:
#: the faster one takes time in the square of such a run
LONG_RUN = 1 << 10

SPACE = "▁"
#: a letter or digit and one of these are never in one pre-token of the byte-level side
_MARKS = r'!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~、。，！？；：「」'
_A_CUT = re.compile(rf"(?<=[^\W_])(?= [^\W_]|[{_MARKS}])")


def _byte_values() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokens:
    """Both tokenizers of a worker, the bytes of their tokens and the places where they may be cut."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as model_pb2
        from tiktoken import Encoding
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        byte = _byte_values()
        ranks = {bytes(byte[c] for c in p): i for p, i in self.a.get_vocab(False).items()
                 if all(c in byte for c in p)}
        if any(bytes([k]) not in ranks for k in range(256)):
            raise ValueError("the A side must have a token for each byte")
        #: the same merges by rank: ids of this kind of vocabulary ascend in merge order
        self.fast_a = Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                               special_tokens={})
        self.bytes_a = self._table({i: x for x, i in ranks.items()})
        with open(path_b, "rb") as file:
            model = model_pb2.ModelProto.FromString(file.read())
        spec = model.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not (
                spec.add_dummy_prefix and spec.escape_whitespaces):
            raise ValueError("the piece model must keep characters and add one space")
        spec.add_dummy_prefix = False  # the space is part of what is encoded
        self.b = SentencePieceProcessor(model_proto=model.SerializeToString())
        kind = model_pb2.ModelProto.SentencePiece
        self.bytes_b = self._table({
            i: bytes([int(p.piece[3:5], 16)]) if p.type == kind.BYTE
            else p.piece.replace(SPACE, " ").encode() for i, p in enumerate(model.pieces)})
        #: neighbouring characters of some piece, which a merge can therefore join
        self.joined = {x for p in model.pieces if p.type != kind.BYTE
                       for x in zip(p.piece, p.piece[1:])}
        if max(len(self.bytes_a), len(self.bytes_b)) > 1 << 16:
            raise ValueError("ids must fit 16 bits")
        self.size_a, self.size_b = (np.array([len(x) for x in t], dtype=np.int64)
                                    for t in (self.bytes_a, self.bytes_b))
        #: an id with the sign that follows it: comma, bar (after a group's A ids), semicolon;
        #: in rows of six bytes, zeros after the sign
        text = np.array([f"{i}{c}".encode() for c in ",|;" for i in range(1 << 16)], dtype="S6")
        self.text = text.view(np.uint8).reshape(len(text), 6)
        self.text_size = np.count_nonzero(self.text, axis=1)

    @staticmethod
    def _table(entries: dict[int, bytes]) -> list[bytes]:
        return [entries.get(i, b"") for i in range(max(entries) + 1)]

    def encode_a(self, texts: list[str], raw: list[bytes]) -> list[np.ndarray]:
        """A ids; they spell the text's bytes, since every byte has a token."""
        slow = set()
        if texts:
            blank = np.frombuffer(b"".join(raw), dtype=np.uint8) <= 32
            turn = np.concatenate([[0], np.flatnonzero(blank[1:] != blank[:-1]) + 1, [len(blank)]])
            long = np.flatnonzero(np.diff(turn) >= LONG_RUN)
            ends = np.cumsum([len(r) for r in raw])
            for s, e in zip(turn[long].tolist(), turn[long + 1].tolist(), strict=True):
                slow |= set(range(*np.searchsorted(ends, [s, e - 1], side="right") + [0, 1]))
        return [np.array(self.a.encode(t, add_special_tokens=False).ids if k in slow
                         else self.fast_a.encode_ordinary(t), dtype=np.int64)
                for k, t in enumerate(texts)]

    def encode_b(self, texts: list[str], raw: list[bytes]) -> list[np.ndarray | None]:
        """B ids, or none where they do not spell the text's bytes."""
        return [np.array(ids, dtype=np.int64)
                if b"".join(map(self.bytes_b.__getitem__, ids)) == r else None
                for ids, r in zip(self.b.encode(texts, num_threads=1), raw, strict=True)]

    def cuts(self, text: str, step: int) -> tuple[list[int], list[int]]:
        """For each multiple of ``step`` the first place from there where each side may be cut."""
        a, b = [0], [0]
        for p in range(step, len(text), step):
            if a[-1] < p:
                hit = _A_CUT.search(text, p)
                a.append(hit.start() if hit else len(text))
            else:
                a.append(a[-1])
            at = max(p, b[-1])
            while at < len(text) and (self._shown(text[at - 1]), self._shown(text[at])) in self.joined:
                at += 1
            b.append(at)
        return [*a, len(text)], [*b, len(text)]

    @staticmethod
    def _shown(c: str) -> str:
        return SPACE if c == " " else c


_LOADED: dict[tuple[str, str], Tokens] = {}


def tokens(path_a: str | None, path_b: str | None) -> Tokens:
    """The worker's tokenizers (default: the 50k byte-level and the 32k piece vocabulary)."""
    paths = (path_a or public_tokenizers.path("byte_bpe_50k.json"),
             path_b or public_tokenizers.path("piece_bpe_32k.model"))
    if paths not in _LOADED:
        _LOADED[paths] = Tokens(*paths)
    return _LOADED[paths]


_NO_IDS, _NO_ENDS = np.zeros(0, np.int64), np.zeros(0, np.int64)


@dataclass
class Open:
    """Tokens of both sides and their ends, not yet in a closed group."""

    a: np.ndarray = field(default_factory=lambda: _NO_IDS)
    a_end: np.ndarray = field(default_factory=lambda: _NO_ENDS)
    b: np.ndarray = field(default_factory=lambda: _NO_IDS)
    b_end: np.ndarray = field(default_factory=lambda: _NO_ENDS)

    def __add__(self, other: Open) -> Open:
        return Open(*(np.concatenate((x, y)) for x, y in zip(self.parts(), other.parts(), strict=True)))

    def parts(self) -> tuple[np.ndarray, ...]:
        return self.a, self.a_end, self.b, self.b_end

    def between(self, low: int, high: int) -> Open:
        """Tokens whose ends lie in (low, high]."""
        i, j = np.searchsorted(self.a_end, [low, high], side="right")
        k, m = np.searchsorted(self.b_end, [low, high], side="right")
        return Open(self.a[i:j], self.a_end[i:j], self.b[k:m], self.b_end[k:m])


@dataclass
class Closed:
    """Whole groups: how many, their ids as text, and their links as a << 16 | b."""

    groups: int = 0
    text: bytes = b""
    links: bytes = b""

    def __add__(self, other: Closed) -> Closed:
        return Closed(self.groups + other.groups, b";".join(filter(None, (self.text, other.text))),
                      self.links + other.links)


@dataclass
class Fragment:
    """Alignment of a byte range; without a common end all of it is ``prefix``."""

    cut: bool = False
    prefix: Open = field(default_factory=Open)
    closed: Closed = field(default_factory=Closed)
    suffix: Open = field(default_factory=Open)


class Marks:
    """Both sides' ends on the bytes that a run of tokens covers."""

    def __init__(self, run: Open):
        self.run = run
        self.base = int(min(run.a_end[0], run.b_end[0])) - 1
        size = int(max(run.a_end[-1], run.b_end[-1])) - self.base + 1
        self.a, self.b = np.zeros(size, dtype=np.int8), np.zeros(size, dtype=np.int8)
        self.a[run.a_end - self.base] = 1
        self.b[run.b_end - self.base] = 1

    def common(self) -> np.ndarray:
        """Ends that both sides have."""
        return np.flatnonzero(self.a & self.b) + self.base

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Links in byte order as a << 16 | b, and where each ends: between two ends lies one link."""
        ends = np.flatnonzero(self.a | self.b)
        a = self.run.a.astype(np.uint32)[np.cumsum(self.a, dtype=np.int32)[ends] - self.a[ends]]
        b = self.run.b.astype(np.uint32)[np.cumsum(self.b, dtype=np.int32)[ends] - self.b[ends]]
        return a << np.uint32(16) | b, ends + self.base

    def text(self, own: Tokens) -> tuple[bytes, np.ndarray]:
        """All groups' ids as text, and where each group's text ends."""
        run, both = self.run, self.a & self.b
        before = np.cumsum(both, dtype=np.int32) - both
        group_a, group_b = before[run.a_end - self.base], before[run.b_end - self.base]
        groups = int(both.sum())
        in_a, in_b = (np.bincount(g, minlength=groups) for g in (group_a, group_b))
        place_a = np.arange(len(run.a)) + (np.cumsum(in_b) - in_b)[group_a]
        place_b = np.arange(len(run.b)) + np.cumsum(in_a)[group_b]
        code = np.empty(len(run.a) + len(run.b), dtype=np.int64)
        code[place_a], code[place_b] = run.a, run.b
        code[place_a[np.cumsum(in_a) - 1]] += 1 << 16
        code[place_b[np.cumsum(in_b) - 1]] += 2 << 16
        wide = own.text[code].ravel()
        return wide[wide > 0].tobytes(), np.cumsum(own.text_size[code])[np.cumsum(in_a + in_b) - 1]


def close(own: Tokens, run: Open) -> Closed:
    """The groups of tokens that start and end at common ends."""
    if not len(run.a):
        return Closed()
    marks = Marks(run)
    text, ends = marks.text(own)
    return Closed(len(ends), text[:-1], marks.links()[0].tobytes())


def fragment(own: Tokens, run: Open) -> Fragment:
    """The fragment of a byte range's tokens, its places absolute in the document."""
    common = np.intersect1d(run.a_end, run.b_end, assume_unique=True)
    if not len(common):
        return Fragment(False, run)
    first, last = int(common[0]), int(common[-1])
    return Fragment(True, run.between(-1, first), close(own, run.between(first, last)),
                    run.between(last, 1 << 62))


def join(own: Tokens, x: Fragment, y: Fragment) -> Fragment:
    """The fragment of two neighbouring ranges; associative, ``Fragment()`` is its identity.

    The sides' cuts can differ, so ends may meet between the ranges: the open tokens
    there are searched for common ends as a range of their own.
    """
    seam = (x.suffix if x.cut else x.prefix) + y.prefix
    middle = fragment(own, seam)
    if not (x.cut or y.cut or middle.cut):
        return Fragment(False, seam)
    closed, prefix = middle.closed, middle.prefix
    if x.cut:
        closed, prefix = close(own, prefix) + closed if middle.cut else closed, x.prefix
    return Fragment(True, prefix, x.closed + closed + y.closed,
                    y.suffix if y.cut else middle.suffix if middle.cut else seam)


DOCS = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
        "groups_sha256 string, links binary")
CHUNKS = ("key bigint, k int, chunks int, doc_id bigint, text string, a_from int, a_to int, "
          "b_from int, b_to int, base bigint")
_PARTS = tuple(f"{side}_{part}" for side in ("prefix", "suffix") for part in (
    "a", "a_end", "b", "b_end"))
FRAGMENTS = ("key bigint, k int, doc_id bigint, ok boolean, cut boolean, n_a bigint, n_b bigint, "
             "groups bigint, text binary, links binary, " + ", ".join(
                 f"{p} binary" for p in _PARTS))


def _whole(own: Tokens, ids: pa.Array, texts: list[str | None]) -> pa.RecordBatch:
    """Align whole texts, all in one pass over their bytes laid end to end."""
    full = [" " + t for t in texts if t]
    raw = [t.encode() for t in full]
    b = own.encode_b(full, raw)
    rows = np.flatnonzero([bool(t) for t in texts])
    good = [k for k, x in enumerate(b) if x is not None]
    rows, raw, b = rows[good].tolist(), [raw[k] for k in good], [b[k] for k in good]
    a = own.encode_a([full[k] for k in good], raw)
    count = np.zeros((4, len(texts)), dtype=np.int64)
    sha, links = [""] * len(texts), [b""] * len(texts)
    if rows:
        flat_a, flat_b = np.concatenate(a), np.concatenate(b)
        marks = Marks(Open(flat_a, np.cumsum(own.size_a[flat_a]), flat_b,
                           np.cumsum(own.size_b[flat_b])))
        end = np.cumsum([len(r) for r in raw])
        pairs, pair_end = marks.links()
        words, group_end = marks.text(own)
        groups = np.searchsorted(marks.common(), end, side="right")
        word_at = [0, *group_end[groups - 1].tolist()]
        pair_at = [0, *np.searchsorted(pair_end, end, side="right").tolist()]
        count[0, rows], count[1, rows] = [len(x) for x in a], [len(x) for x in b]
        count[2, rows], count[3, rows] = np.diff(groups, prepend=0), np.diff(pair_at)
        for k, row in enumerate(rows):
            sha[row] = hashlib.sha256(words[word_at[k]:word_at[k + 1] - 1]).hexdigest()
            links[row] = pairs[pair_at[k]:pair_at[k + 1]].tobytes()
    return pa.RecordBatch.from_arrays(
        [ids, *(pa.array(c) for c in count), pa.array(sha), pa.array(links, pa.binary())],
        names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"])


def _chunks(own: Tokens, key: int, doc_id: int | None, text: str, step: int) -> Iterator[pa.RecordBatch]:
    """The byte ranges of one long text; a range holds what either side needs of it."""
    text = " " + text
    a, b = own.cuts(text, step)
    at = base = 0
    for k in range(len(a) - 1):
        low, high = min(a[k], b[k]), max(a[k + 1], b[k + 1])
        base, at = base + len(text[at:low].encode()), low
        row = (key, k, len(a) - 1, doc_id, text[low:high], a[k] - low, a[k + 1] - low, b[k] - low,
               b[k + 1] - low, base)
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.string(), *[pa.int32()] * 4,
                 pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)],
                                         names=[c.split()[0] for c in CHUNKS.split(", ")])


def _fragment_row(key: int, k: int, doc_id: int | None, ok: bool, n_a: int, n_b: int,
                  f: Fragment) -> pa.RecordBatch:
    values = (key, k, doc_id, ok, f.cut, n_a, n_b, f.closed.groups, f.closed.text, f.closed.links,
              *(x.astype(np.int64).tobytes() for side in (f.prefix, f.suffix) for x in side.parts()))
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(),
             pa.int64(), *[pa.large_binary()] * 10]
    return pa.RecordBatch.from_arrays(
        [pa.array([v], t).cast(pa.binary()) if t == pa.large_binary() else pa.array([v], t)
         for v, t in zip(values, kinds, strict=True)],
        names=["key", "k", "doc_id", "ok", "cut", "n_a", "n_b", "groups", "text", "links", *_PARTS])


def _read_fragment(r: dict) -> Fragment:
    sides = [Open(*(np.frombuffer(r[p], dtype=np.int64) for p in _PARTS[s:s + 4])) for s in (0, 4)]
    return Fragment(r["cut"], sides[0], Closed(r["groups"], r["text"], r["links"]), sides[1])


def _long_texts(long: DataFrame, step: int, paths: tuple) -> DataFrame:
    """Texts beyond a chunk: ranges, fragments, then a tree of joins; columns of DOCS."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        key = TaskContext.get().partitionId() << 40
        own = tokens(*paths)
        for b in slices(batches):
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                yield from _chunks(own, key, doc_id, text, step)
                key += 1

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokens(*paths)
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                text, base = r["text"], r["base"]
                side_a, side_b = text[r["a_from"]:r["a_to"]], text[r["b_from"]:r["b_to"]]
                raw_a, raw_b = side_a.encode(), side_b.encode()
                ids_b = own.encode_b([side_b], [raw_b])[0]
                run, ok = Open(), ids_b is not None
                if ok:
                    ids_a = own.encode_a([side_a], [raw_a])[0] if side_a else _NO_IDS
                    at = [base + len(text[:r[c]].encode()) for c in ("a_from", "b_from")]
                    run = Open(ids_a, at[0] + np.cumsum(own.size_a[ids_a]),
                               ids_b, at[1] + np.cumsum(own.size_b[ids_b]))
                f = fragment(own, run)
                if r["k"] == 0:  # a text starts at a common end
                    f = join(own, Fragment(True), f)
                yield _fragment_row(r["key"], r["k"], r["doc_id"], ok, len(run.a), len(run.b), f)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokens(*paths)
        for t in sorted_groups(batches, 2):
            t = t.combine_chunks()
            for s, e in zip(*(x.tolist() for x in runs(t, 2)), strict=True):
                out, n_a, n_b, ok = Fragment(), 0, 0, True
                for i in range(s, e):
                    r = t.slice(i, 1).to_pylist()[0]
                    out = join(own, out, _read_fragment(r))
                    n_a, n_b, ok = n_a + r["n_a"], n_b + r["n_b"], ok and r["ok"]
                yield _fragment_row(r["key"], r["node"], r["doc_id"], ok, n_a, n_b, out)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                ok = r["ok"]
                sha = hashlib.sha256(r["text"]).hexdigest() if ok else ""
                row = [r["doc_id"], *((r["n_a"], r["n_b"], r["groups"], len(r["links"]) // 4)
                                      if ok else (0,) * 4), sha, r["links"] if ok else b""]
                kinds = [*[pa.int64()] * 5, pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], t) for v, t in zip(row, kinds, strict=True)],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"])

    ranges = write_table(long.mapInArrow(cut, CHUNKS), "ranges")
    most = ranges.agg(F.max("chunks")).first()[0] or 0
    parts = ranges.repartition("key", "k").mapInArrow(make, FRAGMENTS)
    while most > 1:
        most = -(-most // FAN)
        parts = parts.withColumn("node", F.floor(F.col("k") / FAN).cast("int")).select(
            "key", "node", *[c for c in parts.columns if c != "key"]).repartition(
            "key", "node").sortWithinPartitions("key", "node", "k").mapInArrow(reduce, FRAGMENTS)
    return parts.mapInArrow(finish, DOCS)


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None,
          path_b: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256 and its links.

    A side encodes space+text by the byte-level vocabulary, B side by the piece
    model, whose own leading space that is; special tokens' strings are plain text.
    Null and empty texts, and texts whose tokens' bytes are not the text's, have no
    tokens: zeros, '' and no links. Rows that share an id are separate documents.
    Other columns are left out; an empty table gives no rows. ``links`` are
    little-endian 32-bit ``a << 16 | b`` in byte order.
    """
    paths = (path_a, path_b)
    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                    F.col(text_col).cast("string").alias("text"))
    long = F.coalesce(F.length("text") > chunk, F.lit(False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokens(*paths)
        for b in slices(batches, limit=STEP_BYTES):
            yield _whole(own, b.column(0), b.column(1).to_pylist())

    return d.where(~long).mapInArrow(run, DOCS).unionByName(_long_texts(d.where(long), chunk, paths))


def _flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The links of a column without nulls, end to end in its own buffer, and where each row's start.

    Nothing is copied row by row: small objects by the million would stay in a worker's heap.
    """
    wide = pa.types.is_large_binary(col.type)
    off = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32,
                        count=col.offset + len(col) + 1)[col.offset:].astype(np.int64)
    if off[0] == off[-1]:
        return np.zeros(0, dtype=np.uint32), off - off[0]
    data = np.frombuffer(col.buffers()[2], dtype=np.uint8)[off[0]:off[-1]]
    return data.view(np.uint32), (off - off[0]) // 4


def _release() -> None:
    """Give back what earlier stages left in a reused worker: its tokenizers and free Arrow memory."""
    _LOADED.clear()
    pa.default_memory_pool().release_unused()


def blocks(aligned: DataFrame, size: int = BLOCK_LINKS) -> DataFrame:
    """The documents with a block number, and for each block its distinct pairs and their links."""
    keep = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        block, held, n = TaskContext.get().partitionId() << 32, [], 0

        def pairs() -> Iterator[pa.RecordBatch]:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            for k in range(0, len(values), PAIR_ROW):
                one = [pa.array([v[k:k + PAIR_ROW].astype(np.int64)], pa.list_(pa.int64()))
                       for v in (values, counts)]
                none = [pa.array([None], t) for t in (*[pa.int64()] * 5, pa.string(), pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.array([block]), *none, *one],
                                                 names=["block", *keep, "pairs", "counts"])

        for b in slices(batches, 6, 4 * size):
            links = b.column(6)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(b.num_rows, block)), *b.columns,
                 *[pa.nulls(b.num_rows, pa.list_(pa.int64()))] * 2],
                names=["block", *keep, "pairs", "counts"])
            held.append(_flat(links)[0].copy())
            n += len(held[-1])
            if n >= size:
                yield from pairs()
                block, held, n = block + 1, [], 0
        if n:
            yield from pairs()

    return aligned.select(*keep).mapInArrow(
        run, f"block bigint, {DOCS}, pairs array<bigint>, counts array<bigint>")


def link_counts(blocked: DataFrame) -> DataFrame:
    """(pair, n, best): links of each id pair in all documents; best: the most of its B id."""
    pair = blocked.where("pairs is not null").select(
        F.explode(F.arrays_zip("pairs", "counts")).alias("p")).groupBy(
        F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("n"))
    same_b = Window.partitionBy(F.col("pair").bitwiseAND(0xFFFF))
    return pair.withColumn("best", F.col("n") == F.max("n").over(same_b))


def document_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   path_a: str | None = None, path_b: str | None = None, chunk: int = CHUNK,
                   block_links: int = BLOCK_LINKS) -> DataFrame:
    """``align`` with corpus counts: n_best (links that are their B id's commonest) and count_sum."""
    blocked = write_table(blocks(align(docs, id_col, text_col, path_a, path_b, chunk), block_links),
                          "alignment")
    counts = write_table(link_counts(blocked), "links")
    asked = blocked.where("pairs is not null").select("block", F.explode("pairs").alias("pair")).join(
        counts, "pair")
    keep = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"]
    rows = asked.select("block", F.lit(0).alias("kind"), "pair", "n", "best").unionByName(
        blocked.where("pairs is null").select("block", F.lit(1).alias("kind"), *keep),
        allowMissingColumns=True)
    out = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
           "count_sum bigint, groups_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _release()
        block, held, pairs, n, best = None, [], None, None, None
        for b in batches:
            state = b.column(0).to_numpy() * 2 + b.column(1).to_numpy()
            at = (np.flatnonzero(np.diff(state)) + 1).tolist()
            for s, e in zip([0, *at], [*at, b.num_rows], strict=True):
                if s == e:
                    continue
                g = b.slice(s, e - s)
                if g.column(0)[0].as_py() != block:
                    block, held, pairs = g.column(0)[0].as_py(), [], None
                if g.column(1)[0].as_py() == 0:
                    held.append((g.column(2).to_numpy().astype(np.uint32), g.column(3).to_numpy().copy(),
                                 g.column(4).to_numpy(zero_copy_only=False)))
                    continue
                if pairs is None and held:
                    pairs, n, best = (np.concatenate(x) for x in zip(*held, strict=True))
                    held = []
                for part in slices(iter([g]), 11, STEP_BYTES):
                    links, at_link = _flat(part.column(11))
                    total, most = np.zeros((2, len(links) + 1), dtype=np.int64)
                    if len(links):
                        where = np.searchsorted(pairs, links)
                        np.cumsum(n[where], out=total[1:])
                        np.cumsum(best[where], out=most[1:])
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns[5:10], pa.array(np.diff(most[at_link])),
                         pa.array(np.diff(total[at_link])), part.column(10)],
                        names=[c.split()[0] for c in out.split(", ")])

    return rows.select("block", "kind", "pair", "n", "best", *keep).repartition(
        "block").sortWithinPartitions("block", "kind", "pair").mapInArrow(run, out)
