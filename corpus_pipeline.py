"""Documents to packed sequences: language ID, near-duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet in the shared folder and reads it back as the next stage's
``docs``. All stages but the last return the columns of ``documents``, extra ones
included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventcraft.llm import langid, minhash, packing, pii
from eventcraft.llm.common import fold, table, write_table
from eventcraft.session import ship_package

#: least posterior of a document's language; the undetermined have 0
LEAST_LANGUAGE = 0.5
#: what langid's words consist of
LETTER = r"[\p{L}\p{Nl}\p{No}]"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is found (learned from three labelled folds of four).

    A text that is null, empty or without letters goes, and so does one that no
    learned language fits; the least fit is set on the fourth fold. Where no row has a
    label to learn from, only texts without letters go.
    """
    held_out = fold("doc_id", 4) == 2
    model = langid.train(docs.where(~held_out))
    if not model.langs:
        return docs.where(F.col("text").rlike(LETTER))
    least = langid.least_fit(model, docs.where(held_out))
    found = docs.withColumn("__lang", langid.predict(model, spark, F.col("text"), with_fit=True))
    return found.where((F.col("__lang.score") >= LEAST_LANGUAGE)
                       & (F.col("__lang.fit") >= least)).drop("__lang")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each near-duplicate group (similarity 0.8 or more).

    Of rows that share an id the one whose text hash is least stays; rows
    without an id all stay. Only ids decide: the ids to drop are broadcast while they
    are few, and rows are compared only where an id occurs more than once.
    """
    found = write_table(minhash.near_duplicates(docs.where("doc_id is not null"), num=80),
                        "near_duplicates")
    gone = found.where("not kept").select("doc_id").distinct()
    left = docs.join(_few(gone), "doc_id", "left_anti")
    repeated = _few(found.groupBy("doc_id").count().where("count > 1").select("doc_id"))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    first = left.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(
        F.min_by(whole, F.struct(F.xxhash64("text"), F.col("text"))).alias("__row")).select("__row.*")
    return left.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(first)


def _few(ids: DataFrame) -> DataFrame:
    """A broadcast of ids if there are at most minhash.BROADCAST_IDS, else the plain table."""
    return F.broadcast(ids) if ids.count() <= minhash.BROADCAST_IDS else ids


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the text by its kind; every document stays, nulls stay null.

    ``n_chars``, where there is one, is that of the new text.
    """
    found = pii.find(docs, pii.train(docs)).withColumn("__text", pii.redact(
        F.col("text"), F.col("pii_spans")))
    cols = []
    for c in docs.columns:
        if c == "text":
            cols.append(F.col("__text").alias("text"))
        elif c == "n_chars":
            kind = docs.schema["n_chars"].dataType
            cols.append(F.when(F.size("pii_spans") > 0, F.length("__text").cast(kind)).otherwise(
                F.col("n_chars")).alias("n_chars"))
        else:
            cols.append(F.col(f"`{c}`"))
    return found.select(*cols)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 ids."""
    return packing.pack(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates),
          ("personal_data", personal_data), ("packing", pack)]

#: no SQL states a fitted language model; tests/llm compares run() with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), name)
    return docs
