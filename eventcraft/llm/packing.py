"""Order-preserving packing of token ids into windows by dynamic programming.

The documents of an id range form one stream of ids. The program picks the
cuts between sequences among document ends (free), sentence ends and, where
neither is near, fixed steps, so that padding plus cut penalties are least:

    cost(j) = penalty(j) + 1 + min over i with j - window <= i < j of
              cost(i) + padding(j - i)

A sequence is padded up to the window, so for a fixed j the best i is the least
``cost(i) + i`` inside a sliding range: a monotone queue gives it in constant
time. Sequences of a power-of-two length carry no padding; these few lengths are
looked up directly.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from eventcraft.llm.common import lean, slices
from eventcraft.llm.tokens import END_ID, in_id_order, word_ids

WINDOW = 4096
#: penalties, in padding tokens, of a cut inside a document
SENTENCE_CUT, HARD_CUT = 2.0, 32.0
#: every sequence costs this much, so that full windows win over short ones
SEQUENCE = 1.0
#: shortest power-of-two sequence away from a stream's end
SHORTEST = 256
#: windows that one run of the program covers; the cut it ends on starts the next run
BLOCK_WINDOWS = 64

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
    T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
    T.StructField("offset", T.LongType())])


def candidates(ends: np.ndarray, sentences: np.ndarray, total: int, step: int,
               sentence_cut: float, hard_cut: float) -> tuple[np.ndarray, np.ndarray]:
    """Places where a cut is allowed (0 and ``total`` included) and their penalties."""
    marks = np.union1d(np.union1d(ends, sentences), [0, total])
    gaps = np.diff(marks)
    wide = np.flatnonzero(gaps > step)
    hard = [np.arange(marks[w] + step, marks[w + 1], step) for w in wide]
    pos = np.union1d(marks, np.concatenate(hard)) if hard else marks
    pen = np.full(len(pos), hard_cut)
    pen[np.searchsorted(pos, sentences)] = sentence_cut
    pen[np.searchsorted(pos, ends)] = 0.0
    pen[0] = 0.0
    return pos, pen


def tail_lengths(rest: int, window: int, hard_cut: float) -> tuple[float, list[int]]:
    """Cheapest way to end a stream with ``rest`` < window ids: padded, or in powers of two."""
    if rest == 0:
        return 0.0, []
    powers = [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]
    split = SEQUENCE * len(powers) + hard_cut * (len(powers) - 1)
    padded = SEQUENCE + window - rest
    return (split, powers) if split <= padded else (padded, [rest])


def best_cuts(pos: np.ndarray, pen: np.ndarray, window: int = WINDOW, last: bool = True,
              hard_cut: float = HARD_CUT, shortest: int = SHORTEST) -> tuple[float, list[int]]:
    """Cost and cut positions (0 first) of the cheapest sequences over ``pos``.

    With ``last`` the cuts reach ``pos[-1]``, else the best place in the last window.
    """
    total = int(pos[-1])
    later, earlier = [], []
    k = shortest
    while k <= window:
        at = np.searchsorted(pos, pos - k)
        hit = np.flatnonzero((pos >= k) & (pos[np.minimum(at, len(pos) - 1)] == pos - k))
        later.append(hit)
        earlier.append(at[hit])
        k *= 2
    later, earlier = np.concatenate(later), np.concatenate(earlier)
    order = np.argsort(later, kind="stable")
    later, earlier = [*later[order].tolist(), -1], earlier[order].tolist()
    p, q = pos.tolist(), pen.tolist()
    cost, key, back = [0.0], [0.0], [0]
    queue, head, x = [0], 0, 0  # queue: indices by place, keys ascending from head
    for j in range(1, len(p)):
        here = p[j]
        low = here - window
        while p[queue[head]] < low:
            head += 1
        arg = queue[head]
        best = key[arg] + window - here
        while later[x] == j:
            if cost[earlier[x]] < best:
                arg = earlier[x]
                best = cost[arg]
            x += 1
        best += q[j] + SEQUENCE
        cost.append(best)
        back.append(arg)
        best += here
        key.append(best)
        while len(queue) > head and key[queue[-1]] >= best:
            queue.pop()
        queue.append(j)
    near = range(int(np.searchsorted(pos, max(0, total - window + 1))), len(p))
    if last:
        ends = [(cost[j] - q[j] * (p[j] == total) + tail_lengths(total - p[j], window, hard_cut)[0],
                 -j) for j in near]
    else:  # a little more cost is fine for ids that then need no window later
        ends = [(cost[j] - p[j] / window * 4, -j) for j in near if j]
    value, j = min(ends)
    j = -j
    rest = tail_lengths(total - p[j], window, hard_cut)[1] if last else []
    cuts = [p[j]]
    while j:
        j = back[j]
        cuts.append(p[j])
    cuts.reverse()
    for n in rest:
        cuts.append(cuts[-1] + n)
    return value, cuts


_SENTENCE: dict[str | None, np.ndarray] = {}


def sentence_ids(vocabulary: str | None) -> np.ndarray:
    """For each id of the vocabulary: does it end a sentence (. ! ? and the like)."""
    if vocabulary not in _SENTENCE:
        vocab = word_ids(vocabulary).whole.get_vocab()
        flag = np.zeros(max(vocab.values()) + 1, dtype=bool)
        for piece, i in vocab.items():
            mark = piece.removesuffix("</w>")
            flag[i] = bool(mark) and set(mark) <= set(string.punctuation) and bool(
                set(mark) & set(".!?"))
        _SENTENCE[vocabulary] = flag
    return _SENTENCE[vocabulary]


class _Stream:
    """Ids of consecutive documents that have no sequence yet."""

    def __init__(self, flag: np.ndarray, window: int, sentence_cut: float, hard_cut: float):
        self.flag, self.window = flag, window
        self.costs = sentence_cut, hard_cut
        self.docs: list[tuple[int | None, bytes, int]] = []  # id, ids left, ids already placed
        self.pending = 0
        self.sequences = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id, ids, 0))
        self.pending += len(ids) // 4

    def place(self, last: bool) -> list[tuple]:
        """Cut what is pending into sequences; their pieces."""
        data = b"".join(d[1] for d in self.docs)
        ids = np.frombuffer(data, dtype="<u4")
        size = np.array([len(d[1]) // 4 for d in self.docs], dtype=np.int64)
        ends = np.cumsum(size)
        sentences = np.flatnonzero(self.flag[ids[:-1]]) + 1
        pos, pen = candidates(ends, sentences, len(ids), self.window // 16, *self.costs)
        cuts = np.array(best_cuts(pos, pen, self.window, last, self.costs[1],
                                  max(1, self.window // 16))[1], dtype=np.int64)
        bounds = np.union1d(ends[ends <= cuts[-1]], cuts)
        first, after = bounds[:-1], bounds[1:]
        doc = np.searchsorted(ends, first, side="right")
        seq = np.searchsorted(cuts, first, side="right") - 1
        own = (ends - size)[doc]
        out = []
        for s, e, d, q, o in zip(first.tolist(), after.tolist(), doc.tolist(), seq.tolist(),
                                 own.tolist(), strict=True):
            doc_id, rest, placed = self.docs[d]
            out.append((doc_id, placed + s - o, e - s, data[4 * s:4 * e],
                        placed + len(rest) // 4, self.sequences + q, s - int(cuts[q])))
        self.sequences += len(cuts) - 1
        done = int(cuts[-1])
        k = int(np.searchsorted(ends, done, side="right"))
        self.docs = self.docs[k:]
        if self.docs and (used := done - int(ends[k] - size[k])):
            doc_id, rest, placed = self.docs[0]
            self.docs[0] = doc_id, rest[4 * used:], placed + used
        self.pending -= done
        return out


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         vocabulary: str | None = None, end_id: int | None = END_ID,
         sentence_cut: float = SENTENCE_CUT, hard_cut: float = HARD_CUT,
         block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Pieces of documents in sequences of at most ``window`` ids, in id order.

    Columns: doc_id, start (its document's ids before the piece), length, ids
    (little-endian 32-bit), doc_tokens, sequence_id (ascending with the
    documents' order; one id range per task has the high bits), offset in the
    sequence. A null text is empty and has the end id alone (no piece where
    there is no end id); null ids come first; rows that share an id are separate
    documents; an empty table gives no rows; other columns are left out.
    A text without sentence marks is cut at steps of a sixteenth window.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        high = TaskContext.get().partitionId() << 40
        own = word_ids(vocabulary)
        end = b"" if end_id is None else np.array([end_id], dtype="<u4").tobytes()
        stream = _Stream(sentence_ids(vocabulary), window, sentence_cut, hard_cut)

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            doc, start, n, ids, total, seq, off = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([
                pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(n, pa.int64()),
                pa.array(ids, pa.binary()), pa.array(total, pa.int64()),
                pa.array([high | q for q in seq], pa.int64()), pa.array(off, pa.int64())],
                names=PIECES.names)

        for b in slices(batches):
            all_ids, off = own.texts(b.column(1))
            for doc_id, s, e in zip(b.column(0).to_pylist(), off, off[1:], strict=False):
                if ids := all_ids[s:e].tobytes() + end:
                    stream.add(doc_id, ids)
                if stream.pending >= block_windows * window:
                    yield batch(stream.place(False))
        if stream.pending:
            yield batch(stream.place(True))

    return in_id_order(docs, id_col, text_col).mapInArrow(lean(run, "tokens"), PIECES)
