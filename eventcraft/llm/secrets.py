"""Secret scan with a random forest against false positives, DataFrame expressions only.

Candidates are long unbroken runs that hold a digit or are all upper case, and
values given to a key-like name. A forest of Spark ML, trained on labelled
findings, scores them by length, character transitions, coverage by dictionary
words, the path of their document and the neighbouring words.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventcraft.llm.common import write_table
from eventcraft.llm.native import after, before, chunks, let, with_spans

CANDIDATE = (r"(?<![A-Za-z0-9+/_-])(?:(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{12,}+|[A-Z0-9]{16,}+"
             r"(?![A-Za-z0-9+/_-])|(?<=[=:]|[=:][\x20\"']|[=:]\x20[\"'])[A-Za-z0-9+/_-]{8,}+)")
#: fixed word lists: parts of ordinary words, names of secrets, marks of harmless paths
DICTIONARY = ("password", "example", "sample", "version", "license", "public", "default", "change",
              "token", "secret", "value", "http", "https", "test", "user", "name", "file", "data",
              "the", "and", "ing", "ion", "ent", "ation", "with", "that", "this", "from", "ment",
              "lich", "keit", "heit", "que", "ación", "tion", "able", "ness", "ous")
KEY_NAMES = ("password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "access_key",
             "auth", "credential", "private_key", "client_secret")
HARMLESS = ("test", "example", "sample", "mock", "fixture", "doc", "readme", "lock", "vendor")
FEATURES = ("length", "digits", "uppers", "lowers", "marks", "distinct", "hex", "transitions",
            "repeats", "dictionary", "path_depth", "path_harmless", "key_before", "assigned",
            "quoted", "word_before", "word_after")
#: labelled findings that the forest is fitted on, at most about this many
MAX_LABELLED = 200_000
#: at least this probability makes a finding a secret
LEAST = 0.5


def _share(hit: Column, chars: str) -> Column:
    return F.length(F.regexp_replace(hit, f"[^{chars}]", "")) / F.length(hit)


def _features(pieces: Column, path: Column, s: Column) -> list[Column]:
    hit = s["hit"]
    lead, tail = before(pieces, s["start"], 32), after(pieces, s["end"], 16)
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        hit, "[a-z]", "l"), "[A-Z]", "U"), "[0-9]", "9"), "[^lU9]", "m")
    changes = F.length(F.regexp_replace(shape, r"(.)\1*+", "$1")) - 1
    words = "|".join(sorted(DICTIONARY, key=len, reverse=True))
    low = F.lower(hit)
    cols = {
        "length": F.least(F.length(hit), F.lit(200)),
        "digits": _share(hit, "0-9"), "uppers": _share(hit, "A-Z"), "lowers": _share(hit, "a-z"),
        "marks": _share(hit, "+/_-"),
        "distinct": F.size(F.array_distinct(F.split(hit, "(?!^)"))) / F.length(hit),
        "hex": F.when(hit.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), 1.0).otherwise(0.0),
        "transitions": changes / F.length(hit),
        "repeats": 1 - F.length(F.regexp_replace(low, r"(.)\1+", "$1")) / F.length(hit),
        "dictionary": 1 - F.length(F.regexp_replace(low, words, "")) / F.length(hit),
        "path_depth": F.length(F.regexp_replace(path, "[^/]", "")),
        "path_harmless": F.when(F.lower(path).rlike("|".join(HARMLESS)), 1.0).otherwise(0.0),
        "key_before": F.when(F.lower(lead).rlike(
            "(?:" + "|".join(KEY_NAMES) + r")[^a-z0-9]*$"), 1.0).otherwise(0.0),
        "assigned": F.when(lead.rlike(r"[=:]\s*[\"']?$"), 1.0).otherwise(0.0),
        "quoted": F.when(lead.rlike("[\"']$") & tail.rlike("^[\"']"), 1.0).otherwise(0.0),
        "word_before": F.length(F.regexp_extract(lead, r"([A-Za-z]+)[^A-Za-z]*$", 1)),
        "word_after": F.length(F.regexp_extract(tail, r"^[^A-Za-z]*([A-Za-z]+)", 1)),
    }
    return [cols[k].cast("double").alias(k) for k in FEATURES]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               path_col: str | None = "source") -> DataFrame:
    """doc_id, start, end, candidate and its features: one row per candidate of a text.

    A null text has none; a null path counts as empty.
    """
    path = F.lit("") if path_col is None else F.coalesce(F.col(path_col).cast("string"), F.lit(""))
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                    path.alias("path"))
    d = with_spans(d, "text", CANDIDATE, "found")
    pieces = F.when(F.size("found") > 0, chunks(F.col("text")))
    d = d.withColumn("found", let(pieces, lambda p: F.transform("found", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["hit"].alias("candidate"),
        *_features(p, F.col("path"), s)))))
    # (explode would infer a filter that finds all candidates a second time)
    return d.select("doc_id", F.explode_outer("found").alias("s")).where("s is not null").select(
        "doc_id", "s.*")


class Filter:
    """The fitted forest, or the share of true findings where there was only one kind."""

    def __init__(self, forest, share: float):
        self.forest, self.share = forest, share


def train(findings: DataFrame, label_col: str = "is_secret", trees: int = 40, depth: int = 8,
          max_labelled: int = MAX_LABELLED, seed: int = 11) -> Filter:
    """Fit on labelled findings: rows of ``candidates`` with a 0/1 label (null labels are left out).

    Of more than ``max_labelled`` rows about so many are taken by a hash of the
    finding. Labels of one kind only, or none, give a constant probability.
    """
    d = findings.select(*FEATURES, F.col(label_col).cast("double").alias("label"),
                        F.xxhash64("doc_id", "start", "candidate").alias("h")).where(
        "label is not null")
    d = write_table(d, "findings")  # the fit reads them several times, the texts once
    counts = {r["label"]: r["count"] for r in d.groupBy("label").count().collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        return Filter(None, next(iter(counts), 1.0))
    if total > max_labelled:
        d = d.where(F.pmod("h", F.lit(1_000_000)) < 1_000_000 * max_labelled / total)
    d = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(d)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed).fit(
        d.select("features", "label"))
    return Filter(forest, counts.get(1.0, 0) / total)


def score(found: DataFrame, model: Filter, least: float = LEAST) -> DataFrame:
    """Add ``probability`` and ``is_secret`` to rows of ``candidates``; the features go."""
    keep = [c for c in found.columns if c not in FEATURES]
    if model.forest is None:
        d = found.select(*keep, F.lit(float(model.share)).alias("probability"))
    else:
        d = model.forest.transform(VectorAssembler(
            inputCols=list(FEATURES), outputCol="features").transform(found))
        d = d.select(*keep, vector_to_array("probability")[1].alias("probability"))
    return d.withColumn("is_secret", F.col("probability") >= least)
