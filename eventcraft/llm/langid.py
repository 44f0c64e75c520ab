"""Language ID by unigram piece models that sum over all segmentations.

The pieces are those of a fixed public byte-level vocabulary. Each language
has a probability for every piece, fitted by expectation-maximisation over all
segmentations of its training words. A word's likelihood under a language is
the forward sum over every way to cut its bytes into pieces; a text's is the
product over its words; the prediction is the likeliest language and its
posterior.

Training reads all labelled documents as their distinct words with counts; a caller may
bound it to about ``docs_per_lang`` documents of each language, picked by a hash of their
text. Thresholds and predictions cover all rows and whole texts.
"""

from __future__ import annotations

import base64
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventcraft.llm.common import HELD, lean
from eventcraft.operators.rank import running_totals

#: longest piece in bytes; longest stretch of letters scored as one
PIECE_BYTES, PART_LETTERS = 8, 24
EM_ROUNDS = 3
SMOOTHING = 0.02
#: distinct words of a language that a task counts before it sends them on
COUNT_WORDS = 1 << 17
#: words whose scores a Python worker keeps; beyond it the cache starts again
CACHE_WORDS = 150_000
#: text that is split into words at once
STEP_BYTES = 1 << 20
UNDETERMINED = "und"
#: share of clean held-out documents that the least fit may lose
LOST = 0.001

_LETTERS = re.compile(rf"[^\W\d_]{{1,{PART_LETTERS}}}")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    """Stretches of letters, lower-cased; a longer one counts as parts of PART_LETTERS."""
    return _LETTERS.findall(text.lower()) if text else []


class Pieces:
    """The vocabulary's pieces of at most PIECE_BYTES bytes, found by hash."""

    def __init__(self, path: str | None = None):
        path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
        with open(path, "rb") as f:
            own = {base64.b64decode(line.split()[0]) for line in f if line.strip()}
        own |= {bytes([b]) for b in range(256)}
        self.pieces = sorted(p for p in own if len(p) <= PIECE_BYTES)
        keys = np.array([self._key(p) for p in self.pieces], dtype=np.uint64)
        order = np.argsort(keys)
        self.keys, self.order = keys[order], order.astype(np.int32)

    @staticmethod
    def _key(piece: bytes) -> int:
        h = 0
        for c in piece:
            h = (h * int(_BASE) + c + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def lattice(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ending at byte t with length l of each word, at [l - 1, t, word]; -1: none."""
        size = np.array([len(w) for w in words])
        top = int(size.max())
        chars = np.zeros((top, len(words)), dtype=np.uint64)
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        row = np.repeat(np.arange(len(words)), size)
        chars[np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size), row] = flat
        at = np.full((PIECE_BYTES, top + 1, len(words)), -1, dtype=np.int32)
        with np.errstate(over="ignore"):
            head = np.zeros((top + 1, len(words)), dtype=np.uint64)
            for t in range(top):
                head[t + 1] = head[t] * _BASE + chars[t] + np.uint64(1)
            power = np.uint64(1)
            for n in range(1, min(PIECE_BYTES, top) + 1):
                power = power * _BASE
                sub = head[n:] - head[:-n] * power
                k = np.minimum(np.searchsorted(self.keys, sub), len(self.keys) - 1)
                at[n - 1, n:] = np.where(self.keys[k] == sub, self.order[k], -1)
        return at, size


_PIECES: dict[str | None, Pieces] = HELD.setdefault("langid", {})


def pieces(path: str | None = None) -> Pieces:
    if path not in _PIECES:
        _PIECES[path] = Pieces(path)
    return _PIECES[path]


def forward(own: Pieces, table: np.ndarray, words: list[bytes]) -> np.ndarray:
    """Log likelihood [word, language] summed over all segmentations.

    ``table`` is [piece + 1, language]; its last row (no such piece) is zero.
    """
    out = np.empty((len(words), table.shape[1]))
    order = np.argsort([len(w) for w in words], kind="stable")
    for k in range(0, len(words), 2048):
        part = order[k:k + 2048]
        at, size = own.lattice([words[i] for i in part])
        top = int(size.max())
        alpha = np.zeros((top + 1, len(part), table.shape[1]))
        alpha[0] = 1.0
        scale = np.zeros((len(part), table.shape[1]))
        got = np.zeros_like(scale)
        for t in range(1, top + 1):
            for n in range(1, min(PIECE_BYTES, t) + 1):
                alpha[t] += alpha[t - n] * table[at[n - 1, t]]
            if t % 16 == 0:  # keep the numbers in range
                low = max(0, t - PIECE_BYTES + 1)
                m = alpha[low:t + 1].max(axis=0)
                alpha[low:t + 1] /= m
                scale += np.log(m)
            done = size == t
            if done.any():
                got[done] = np.log(alpha[t][done]) + scale[done]
        out[part] = got
    return out


def expected(own: Pieces, table: np.ndarray, words: list[bytes], lang: np.ndarray,
             weight: np.ndarray) -> np.ndarray:
    """Expected piece counts [piece, language] of weighted words, each in its language."""
    total = np.zeros((table.shape[0], table.shape[1]))
    order = np.argsort([len(w) for w in words], kind="stable")
    for k in range(0, len(words), 2048):
        part = order[k:k + 2048]
        at, size = own.lattice([words[i] for i in part])
        g, w, cols = lang[part], weight[part], np.arange(len(part))
        top = int(size.max())
        p = table[at, g]  # [length, end, word]
        alpha = np.zeros((top + 1, len(part)))
        beta = np.zeros((top + 1, len(part)))
        alpha[0] = 1.0
        beta[size, cols] = 1.0
        for t in range(1, top + 1):
            for n in range(1, min(PIECE_BYTES, t) + 1):
                alpha[t] += alpha[t - n] * p[n - 1, t]
        for t in range(top - 1, -1, -1):
            for n in range(1, min(PIECE_BYTES, top - t) + 1):
                beta[t] += beta[t + n] * p[n - 1, t + n]
        norm = w / np.maximum(alpha[size, cols], 1e-300)
        for n in range(1, min(PIECE_BYTES, top) + 1):
            share = alpha[:-n] * p[n - 1, n:] * beta[n:] * norm
            hit = share > 0
            np.add.at(total, (at[n - 1, n:][hit], np.broadcast_to(g, hit.shape)[hit]), share[hit])
    return total


class Model:
    """Languages (sorted) and the table of piece probabilities."""

    def __init__(self, langs: list[str], table: np.ndarray, path: str | None):
        self.langs, self.table, self.path = langs, table, path


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
          docs_per_lang: int | None = None, rounds: int = EM_ROUNDS,
          vocabulary: str | None = None) -> Model:
    """Fit on rows with a text and a label. Without any, the model knows no language.

    ``docs_per_lang`` bounds the documents of a language that are read; none by default.

    What comes to the driver is bounded by the vocabulary times the languages.
    """
    d = docs.select(F.col(text_col).cast("string").alias("text"),
                    F.col(lang_col).cast("string").alias("lang")).where(
        "text is not null and lang is not null")
    counts = {r["lang"]: r["count"] for r in d.groupBy("lang").count().collect()}
    langs = sorted(counts)
    own = pieces(vocabulary)
    size = len(own.pieces) + 1
    if not langs:
        return Model([], np.zeros((size, 0)), vocabulary)
    if docs_per_lang is not None:
        share = F.create_map(*[x for g in langs for x in (
            F.lit(g), F.lit(min(1.0, docs_per_lang / counts[g])))])
        d = d.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter[str]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, n in found.items():
                keys = list(n)
                for k in range(0, len(keys), 10_000):
                    part = keys[k:k + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(part)), pa.array(part),
                         pa.array([n[w] for w in part], pa.int64())], names=["lang", "word", "n"])
        for b in batches:
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found.setdefault(lang, Counter()).update(words_of(text))
            if sum(map(len, found.values())) > COUNT_WORDS:
                yield from out()
                found.clear()
        yield from out()

    words = d.mapInArrow(lean(split, "langid"), "lang string, word string, n bigint").groupBy(
        "lang", "word").agg(F.sum("n").alias("n")).checkpoint()
    index = {g: i for i, g in enumerate(langs)}
    # start: every piece as likely as its length allows
    start = np.array([256.0 ** -min(len(p), 3) for p in own.pieces] + [0.0])
    table = np.repeat(start[:, None] / start.sum(), len(langs), axis=1)
    for _ in range(rounds):
        shared = d.sparkSession.sparkContext.broadcast(table)

        def step(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            total = None
            for b in batches:
                if not b.num_rows:
                    continue
                part = expected(
                    pieces(vocabulary), shared.value,
                    [b" " + w.encode() for w in b.column(1).to_pylist()],
                    np.array([index[g] for g in b.column(0).to_pylist()]),
                    b.column(2).to_numpy().astype(np.float64))
                total = part if total is None else total + part
            if total is not None:
                p, g = np.nonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p, pa.int64()), pa.array(g, pa.int64()), pa.array(total[p, g])],
                    names=["piece", "lang", "n"])

        got = words.mapInArrow(lean(step, "langid"), "piece bigint, lang bigint, n double").groupBy(
            "piece", "lang").agg(F.sum("n").alias("n")).toArrow()
        table = np.zeros((size, len(langs)))
        table[got["piece"].to_numpy(), got["lang"].to_numpy()] = got["n"].to_numpy()
        del got
        table[:-1] += SMOOTHING
        table[-1] = 0.0
        table /= table.sum(axis=0)
        shared.unpersist()
    return Model(langs, table, vocabulary)


class _Scorer:
    def __init__(self, model: Model, with_fit: bool):
        self.model, self.own, self.with_fit = model, pieces(model.path), with_fit
        self.index: dict[str, int] = {}
        self.table = model.table
        if with_fit:  # the background: every piece as likely as any other
            flat = np.full((len(model.table), 1), 1 / (len(model.table) - 1))
            flat[-1] = 0.0
            self.table = np.concatenate([self.table, flat], axis=1)
        self.rows = np.zeros((0, self.table.shape[1] + with_fit))

    def score(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        words = [words_of(t) for t in texts]
        if len(self.index) > CACHE_WORDS:
            self.index, self.rows = {}, self.rows[:0]
        new = list({w for doc in words for w in doc if w not in self.index})
        if new and self.model.langs:
            coded = [b" " + w.encode() for w in new]
            got = forward(self.own, self.table, coded)
            if self.with_fit:
                got = np.column_stack([got, [len(w) for w in coded]])
            self.index.update(zip(new, range(len(self.rows), len(self.rows) + len(new)),
                                  strict=True))
            self.rows = np.concatenate([self.rows, got])
        lang, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        fit, langs = np.full(len(texts), np.nan), len(self.model.langs)
        for k, doc in enumerate(words):
            if not doc or not self.model.langs:
                continue
            at = np.fromiter(map(self.index.__getitem__, doc), np.int64, len(doc))
            total = self.rows[at].sum(axis=0)
            best = int(total[:langs].argmax())
            lang[k] = self.model.langs[best]
            score[k] = 1.0 / np.exp(total[:langs] - total[best]).sum()
            if self.with_fit:
                fit[k] = (total[best] - total[langs]) / total[langs + 1]
        return lang, score, fit


def predict(model: Model, spark, text: Column, with_fit: bool = False) -> Column:
    """struct(lang, score) of a text column: the likeliest language and its posterior.

    ``und`` and 0 where the text is null, has no letter, or the model knows no
    language; equal posteriors go to the language that sorts first. ``with_fit``
    adds ``fit``: by how much the log likelihood of a byte under that language is above
    that under equally likely pieces, null where undetermined. Text of no learned
    language is below 0.
    """
    shared = spark.sparkContext.broadcast(model)
    kind = T.StructType([T.StructField("lang", T.StringType()),
                         T.StructField("score", T.DoubleType())]
                        + [T.StructField("fit", T.DoubleType())] * with_fit)

    def scores(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = _Scorer(shared.value, with_fit)
        for col in parts:
            lang, score, fit, at = [], [], [], 0
            sizes = pa.compute.binary_length(col).fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.searchsorted(np.cumsum(sizes), np.arange(
                STEP_BYTES, int(sizes.sum()) + STEP_BYTES, STEP_BYTES), side="right") + 1
            for end in [*np.unique(np.minimum(ends, len(col))).tolist(), len(col)]:
                if end > at:
                    got, p, q = scorer.score(col.slice(at, end - at).to_pylist())
                    lang += got
                    score.append(p)
                    fit.append(q)
                    at = end
            cols = [pa.array(lang, pa.string()), *(pa.array(np.concatenate(
                x) if x else np.zeros(0), from_pandas=True) for x in (score, fit)[:1 + with_fit])]
            yield pa.StructArray.from_arrays(cols, names=kind.names)

    @F.arrow_udf(kind)
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from lean(scores, "langid")(parts)

    return run(text.cast("string"))


def least_fit(model: Model, docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
              lost: float = LOST) -> float:
    """The fit below which a text is of no learned language, from labelled rows held out of the fit.

    0, where the equally likely pieces explain a text as well as any language does,
    or less if more than ``lost`` of all held-out documents with a known label are below
    it: the exact percentile of their fits. Without any: 0.
    """
    d = docs.select(F.col(text_col).cast("string").alias("text"),
                    F.col(lang_col).cast("string").alias("lang")).where(
        "text is not null").where(F.col("lang").isin(model.langs))
    p = predict(model, docs.sparkSession, F.col("text"), with_fit=True)
    # stored: a filter on the prediction would compute it a second time
    fits = d.select(p.alias("p")).select("p.fit").checkpoint(eager=True).where("fit is not null")
    n, below = fits.agg(F.count(F.lit(1)), F.count_if(F.col("fit") < 0)).first()
    at = (n - 1) * lost
    if not n or below <= int(at):
        return 0.0
    # the two values that the place lies between, by a distributed order of all fits
    places = running_totals(fits.withColumn("n", F.lit(1)), "fit", ["n"])
    value = {k: places.where((F.col("n_lt") <= k) & (F.col("n_le") > k)).first()["fit"]
             for k in {int(at), min(int(at) + 1, n - 1)}}
    low, high = value[int(at)], value[min(int(at) + 1, n - 1)]
    return min(0.0, low + (high - low) * (at - int(at)))
