"""Piece encoding as a shortest path through composed weighted transducers.

Compiled from a public sentencepiece model file:

* a normaliser that writes white space as U+2581 and puts one before the text;
* a piece transducer from characters to piece ids, with an arc of byte pieces for
  a character that no piece holds;
* for merge-rule (BPE) models an acceptor of neighbouring pieces: two pieces
  may follow each other only if the merge rules, run on the two together, give
  just these two. Every other pair weighs infinity. For unigram models arcs
  weigh the negated score and any pieces may follow each other.

A text is composed with them word by word and the path of least weight (sums,
minimum) is its encoding. For a merge-rule model exactly one path has finite
weight: the one that the merges give. Decoding runs the same pieces backwards.
No piece crosses from a letter into white space, so words are independent and
are kept in a bounded cache.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventcraft.llm.common import Recent, int_lists, slices

SPACE = "▁"
INFINITE = float("inf")
CACHE_WORDS, CACHE_PAIRS = 300_000, 1_000_000
_CHUNK = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Transducer:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str | None = None):
        from sentencepiece import sentencepiece_model_pb2 as pb
        model = pb.ModelProto()
        with open(path or public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only models whose normaliser keeps all characters")
        self.prefix = spec.add_dummy_prefix
        self.merging = model.trainer_spec.model_type == 2
        kinds = pb.ModelProto.SentencePiece
        self.score = {p.piece: p.score for p in model.pieces if p.type == kinds.NORMAL}
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces)
                         if p.type == kinds.BYTE}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == kinds.UNKNOWN)
        self.ends = {p[i:] for p in self.score for i in range(len(p))}  # ends of pieces
        self.letters = {c for p in self.score for c in p}
        self.pairs = {p[i:i + 2] for p in self.score for i in range(len(p) - 1)}
        if any(SPACE in p.lstrip(SPACE) for p in self.score):
            raise ValueError("a piece holds white space after a letter")
        self.lines = not any("\n" in p for p in self.score)  # a line end then stands alone
        worst = min(self.score.values(), default=0.0)
        self.weight = {p: 0.0 if self.merging else -s for p, s in self.score.items()}
        self.byte_weight = 0.0 if self.merging else 10.0 - worst
        self.follow: dict[tuple[str | None, str], bool] = {}
        self.words, self.rest = Recent(CACHE_WORDS), Recent(CACHE_WORDS // 4)
        self.units = Recent(CACHE_WORDS)
        self.out: list[bytes] = []
        for p in model.pieces:
            self.out.append(bytes([int(p.piece[3:5], 16)]) if p.type == kinds.BYTE
                            else p.piece.replace(SPACE, " ").encode()
                            if p.type == kinds.NORMAL else
                            " ⁇ ".encode() if p.type == kinds.UNKNOWN else b"")

    def merged(self, text: str) -> list[str]:
        """The merge rules on a short text: the best-scored neighbours join, leftmost first."""
        parts = list(text)
        while len(parts) > 1:
            best, at = -INFINITE, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and s > best:
                    best, at = s, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def may_follow(self, first: str | None, then: str) -> bool:
        """The neighbour acceptor (``first`` None: after a start or a byte piece)."""
        if (ok := self.follow.get((first, then))) is None:
            ok = self.merged((first or "") + then) == ([then] if first is None else [first, then])
            if len(self.follow) >= CACHE_PAIRS:
                self.follow.clear()
            self.follow[first, then] = ok
        return ok

    def path(self, text: str) -> list[int]:
        """Ids on the path of least weight of a normalised text composed with the transducers."""
        n = len(text)
        cost = [0.0] + [INFINITE] * n
        last: list[str | None] = [None] * (n + 1)
        back = [0] * (n + 1)
        weight, ends, follow, merging = self.weight, self.ends, self.follow, self.merging
        for t in range(1, n + 1):
            if text[t - 1] not in self.letters:  # the byte arc; nothing joins across it
                cost[t], back[t] = cost[t - 1] + self.byte_weight, t - 1
                continue
            for s in range(t - 1, -1, -1):
                piece = text[s:t]
                if piece not in ends:  # nothing longer ends here either
                    break
                if piece not in weight:
                    continue
                if merging:  # all finite weights are equal: the first path found is the one
                    key = last[s], piece
                    if follow[key] if key in follow else self.may_follow(*key):
                        cost[t], back[t], last[t] = cost[s], s, piece
                        break
                elif cost[s] + weight[piece] < cost[t]:
                    cost[t], back[t], last[t] = cost[s] + weight[piece], s, piece
        out, t = [], n
        while t:
            if last[t] is not None:
                out.append(self.ids[last[t]])
            elif self.byte_ids:
                out += [self.byte_ids[b] for b in reversed(text[t - 1].encode())]
            else:
                out.append(self.unknown)
            t = back[t]
        return out[::-1]

    def _path_ids(self, text: str) -> bytes:
        return array("i", self.path(text)).tobytes()

    def _ids(self, text: str) -> bytes:
        """Ids of a normalised text, cut where no piece holds the two characters side by side:
        no path's piece crosses such a place, so the parts are independent."""
        pairs = self.pairs
        cuts = [i for i in range(1, len(text)) if text[i - 1:i + 1] not in pairs]
        if not cuts:
            return self._path_ids(text)
        return b"".join([self.units.one(text[s:e], self._path_ids)
                         for s, e in zip([0, *cuts], [*cuts, len(text)], strict=True)])

    def _word(self, word: str) -> bytes:
        return self._ids(SPACE + word)

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as 32-bit integers."""
        if not text:
            return b""
        if not self.prefix or "  " in text or SPACE in text or text[-1] == " " or text[0] == " " \
                or not self.lines:
            chunks = _CHUNK.findall((SPACE if self.prefix else "") + text.replace(" ", SPACE))
            return b"".join(map(self.rest.fill(chunks, self._ids).__getitem__, chunks))
        out, parts = [], text.split("\n")
        heads = [p.partition(" ") for p in parts]
        tails = [[*h[2].split(" ")] if h[1] else [] for h in heads]
        tails[0] = [heads[0][0], *tails[0]]  # the text starts with a space too
        words = self.words.fill([w for t in tails for w in t], self._word)
        firsts = ["\n" + h[0] for h in heads[1:]]
        rest = self.rest.fill(firsts, self._ids)
        out.append(b"".join(map(words.__getitem__, tails[0])))
        for first, tail in zip(firsts, tails[1:], strict=True):
            out.append(rest[first])
            out.append(b"".join(map(words.__getitem__, tail)))
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> str:
        """The text of piece ids; bytes that are no UTF-8 give U+FFFD."""
        data = b"".join(map(self.out.__getitem__, ids.tolist()))
        if self.prefix and data[:1] == b" ":
            data = data[1:]
        return data.decode("utf-8", "replace")


_LOADED: dict[str | None, Transducer] = {}


def transducer(path: str | None = None) -> Transducer:
    if path not in _LOADED:
        _LOADED[path] = Transducer(path)
    return _LOADED[path]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           model: str | None = None) -> DataFrame:
    """doc_id, ids of every row. A null or empty text has no ids; other columns are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = transducer(model)
        for b in slices(batches):
            rows = [own.encode(t) for t in b.column(1).to_pylist()]
            off = np.concatenate([[0], np.cumsum([len(r) // 4 for r in rows])])
            flat = np.frombuffer(b"".join(rows), dtype=np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), int_lists(flat, off, pa.int32())],
                                             names=["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids",
           model: str | None = None) -> DataFrame:
    """doc_id, text of every row of piece ids. Null ids give a null text, no ids an empty one.

    U+2581 in the text that was encoded comes back as a space, as in the model's
    own normaliser; everything else comes back as it was.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = transducer(model)
        for b in batches:
            for k in range(0, b.num_rows, 500):
                s = b.slice(k, 500)
                texts = [None if not x.is_valid else own.decode(x.values.to_numpy(
                    zero_copy_only=False)) for x in s.column(1)]
                yield pa.RecordBatch.from_arrays([s.column(0), pa.array(texts, pa.string())],
                                                 names=["doc_id", "text"])

    return encoded.select(F.col(id_col).cast("bigint").alias("doc_id"),
                          F.col(ids_col).cast("array<int>").alias("ids")).mapInArrow(
        run, "doc_id bigint, text string")


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               model: str | None = None) -> DataFrame:
    """doc_id, ids, n_ids and ``same``: do the decoded ids give the text that went in.

    A null text has no ids and counts as empty; U+2581 and a space are one character.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = transducer(model)
        for b in slices(batches):
            texts = [t or "" for t in b.column(1).to_pylist()]
            rows = [np.frombuffer(own.encode(t), dtype=np.int32) for t in texts]
            same = [own.decode(r) == t.replace(SPACE, " ") for r, t in zip(
                rows, texts, strict=True)]
            size = np.array([len(r) for r in rows], dtype=np.int64)
            off = np.concatenate([[0], np.cumsum(size)])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), int_lists(np.concatenate(rows), off, pa.int32()), pa.array(size),
                 pa.array(same, pa.bool_())], names=["doc_id", "ids", "n_ids", "same"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id bigint, ids array<int>, n_ids bigint, same boolean")
