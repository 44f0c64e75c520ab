"""Registered queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventcraft.llm import (
    align,
    embed,
    exact,
    langid,
    maxent,
    minhash,
    packing,
    pii,
    resample,
    secrets,
    tokens,
    topk,
    wfst,
)
from eventcraft.llm.common import fold, shared_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents as token files and read every id back."""
    path = shared_path(spark, "tokens")
    tokens.write_tokens(table(spark, sf_dir, "documents"), path)
    back = tokens.read_tokens(spark, path)
    return tokens.list_crc32(back, "tokens", "ids_crc32")


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into windows of 4096 ids; the digest of each piece's ids."""
    p = packing.pack(table(spark, sf_dir, "documents"))
    return p.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                    "sequence_id", "offset")


@query
def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents at a shingle similarity of 0.85."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three of four folds."""
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 4) == 2
    model = langid.train(docs.where(~held_out))
    out = docs.select("doc_id", held_out.alias("held_out"),
                      langid.predict(model, spark, F.col("text")).alias("p"))
    return out.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score")


@query
def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at a cosine of 0.98 inside their label."""
    return embed.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best inner products of every 50th vector against all others."""
    v = table(spark, sf_dir, "embeddings").where(topk.usable(F.col("embedding"))).select(
        "vec_id", topk.quantised(F.col("embedding")).alias("vector"))
    return topk.top_k(v, v.where("vec_id % 50 = 0"), 5)


@query
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document by the composed transducers, and whether they decode back."""
    return wfst.round_trip(table(spark, sf_dir, "documents"))


#: secrets known by their own marks, in any case
SECRET_FORMATS = (
    "akia[0-9a-z]{16}", "asia(?=.*[0-9])[0-9a-z]{16}", "gh[opsur]_[0-9a-z]{36,}",
    "github_pat_[0-9a-z_]{22,}", "glpat-[0-9a-z_-]{20,}", "xox[abeoprs]-[0-9a-z-]{10,}",
    "[rs]k_(?:live|test)_[0-9a-z]{16,}", "aiza[0-9a-z_-]{35}", "npm_[0-9a-z]{36}",
    "eyj[0-9a-z_-]{17,}")
#: harmless without a key's name: numbers; words and short numbers joined by marks
NUMBERS = "[0-9+/_-]+"
WORDS = "[+/_-]*(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4})(?:[+/_-]+(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4}))*[+/_-]*"
#: harmless in running text: numbered ids, UUIDs, points in time
PROSE_IDS = ("[a-z]{1,5}[_-]?[0-9]{6,}", "[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}",
             "[0-9]{4}-?[0-9]{2}-?[0-9]{2}t[0-9-]+z?")
#: share of dictionary words from which a key's value without digits is a placeholder
PLACEHOLDER = 0.75


def labelled_findings(docs: DataFrame) -> DataFrame:
    """Stand-in for reviewed findings: candidates of three folds in four, labelled by what is known.

    1: a format with marks of its own, or a value of letters and digits given to a
    key's name, of any length and case. 0: a known harmless shape. All others
    have no label, so the forest learns nothing against them.
    """
    found = secrets.candidates(docs.where(fold("doc_id", 4) != 2))
    hit, key = F.col("candidate"), F.col("key_before") == 1
    assigned = F.col("assigned") == 1
    words, digit = hit.rlike(f"^{WORDS}$"), hit.rlike("[0-9]")
    known = hit.rlike(f"(?i)^(?:{'|'.join(SECRET_FORMATS)})$")
    given = key & assigned & digit & hit.rlike("[A-Za-z]") & ~words
    plain = ~key & (hit.rlike(f"^{NUMBERS}$") | (words & ~assigned))
    prose = ~key & ~assigned & (F.col("quoted") == 0) & hit.rlike(
        f"(?i)^(?:{'|'.join(PROSE_IDS)})$")
    placeholder = key & ~digit & (F.col("dictionary") >= PLACEHOLDER)
    return found.withColumn("is_secret", F.when(known | given, 1).when(
        plain | prose | placeholder, 0))


@query
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of all documents with the forest's probability of being a secret."""
    docs = table(spark, sf_dir, "documents")
    model = secrets.train(labelled_findings(docs))
    return secrets.score(secrets.candidates(docs), model)


@query
def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram base and maximum-entropy score of every document, learned from six folds of seven."""
    return maxent.lm_scores(table(spark, sf_dir, "documents"), fold("doc_id", 7) == 2)


@query
def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: strict spans and those the trained classifier adds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    d = pii.find(docs, pii.train(docs))
    count = [pii.count(F.col("pii_base"), k).alias(f"n_{k}") for k in pii.KINDS]
    return d.select("doc_id", *count, F.sha2(pii.listing(F.col("pii_base")), 256).alias(
        "base_sha256"), pii.listing(F.col("pii_spans")).alias("spans"))


@query
def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal texts of all documents: one half, by the id's crc32, is the history, the rest is new."""
    docs = table(spark, sf_dir, "documents")
    old = fold("doc_id", 2) == 0
    return exact.duplicates(docs.where(old), docs.where(~old))


@query
def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of all documents, drawn towards the word pairs of the benchmark texts."""
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between byte-level and piece tokens of all documents."""
    return align.document_links(table(spark, sf_dir, "documents"))


SQL["op11_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(COALESCE(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents),
g AS (
  SELECT *, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
    count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, keep_id IS NULL OR COALESCE(doc_id = keep_id, false) AS kept,
  text_sha256 FROM g
"""

SQL["op2_embedding_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (
  SELECT DISTINCT a AS id, a AS other FROM l
  UNION SELECT r.id, l.b FROM r JOIN l ON r.other = l.a),
c AS (SELECT id, min(other) AS component FROM r GROUP BY id),
n AS (SELECT a AS id, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, COALESCE(n.n, 0) AS n_links, COALESCE(c.component, e.vec_id) AS component_id,
  e.vec_id = COALESCE(c.component, e.vec_id) AS kept
FROM embeddings e LEFT JOIN n ON n.id = e.vec_id LEFT JOIN c ON c.id = e.vec_id
"""

SQL["op6_minhash"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN []
    WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END
  ) AS shingle FROM w),
z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (
  SELECT a, b FROM p JOIN z i ON i.doc_id = a JOIN z j ON j.doc_id = b
  WHERE 100 * common >= 85 * (i.n + j.n - common)),
r AS (
  SELECT DISTINCT a AS id, a AS other FROM l
  UNION SELECT r.id, l.b FROM r JOIN l ON r.other = l.a),
c AS (SELECT id, min(other) AS component FROM r GROUP BY id)
SELECT w.doc_id, COALESCE(z.n, 0) AS n_shingles,
  COALESCE(c.component, w.doc_id) AS component_id,
  w.doc_id = COALESCE(c.component, w.doc_id) AS kept
FROM w LEFT JOIN z ON z.doc_id = w.doc_id LEFT JOIN c ON c.id = w.doc_id
"""

SQL["op9_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(COALESCE(list_sum(list_transform(
    list_zip(q.e, c.e), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
o AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM o WHERE rank <= 5
"""
