"""Personal data by weak supervision, with DataFrame expressions only.

Strict patterns with checks (a card's checksum, an address's parts) give the base
spans, which always stay. Candidates beyond them are strict matches that fail
their check and looser forms. Labelers vote on each candidate: the strict
pattern, gazetteers (mail and country endings, issuer and country prefixes), the
words before it, its digits, and the characters around it. Expectation-
maximisation over the counted vote patterns of all documents estimates how each
labeler votes on true and on false candidates; its posteriors weigh the
training rows of a logistic regression over votes and form, and that classifier
decides which candidates become spans. Vote patterns are few by construction, so
the counted table is bounded whatever the corpus.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventcraft.llm.native import (
    CHUNK,
    after,
    before,
    between,
    chunks,
    let,
    running,
    with_spans,
)

KINDS = ("email", "ip", "card", "phone")
#: strict patterns; possessive and anchored at run starts, so that they stay linear
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: looser forms of the same kinds
LOOSE = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]++ ?(?:\(at\)|\[at\]|\{at\}) ?"
             r"[a-z0-9-]++(?: ?(?:\(dot\)|\[dot\]|\{dot\}|\.) ?[a-z0-9-]++)++",
    "phone": r"(?<![A-Za-z0-9.+-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
             r"(?![A-Za-z0-9-])",
}
#: a text without any of these has no match of the kind
NEEDS = {"email": ("@",), "ip": (".",), "phone": ("+",)}
LOOSE_NEEDS = {"email": ("(", "[", "{")}
#: fixed word lists of the labelers
CONTACT_WORDS = ("call", "phone", "tel", "mobile", "fax", "mail", "email", "contact", "reach",
                 "write", "card", "visa", "credit", "payment", "address", "host", "ip", "login")
OTHER_WORDS = ("version", "isbn", "issn", "order", "invoice", "page", "chapter", "section",
               "figure", "table", "build", "release", "part", "item", "sku", "ratio")
ENDINGS = ("com", "org", "net", "edu", "gov", "info", "io", "co", "de", "fr", "es", "it", "uk",
           "eu", "ch", "at", "nl", "be", "us", "ca")
COUNTRY_CODES = ("1", "7", "31", "32", "33", "34", "39", "41", "43", "44", "45", "46", "47", "48",
                 "49", "52", "55", "61", "81", "86", "91")
LABELERS = ("v_strict", "v_context", "v_list", "v_digits", "v_edge")
FORM = ("is_email", "is_ip", "is_card", "is_phone", "spaced")
EM_ROUNDS = 30


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Does a string of digits pass the card checksum."""
    each = F.transform(F.split(F.reverse(digits), "(?!^)"), lambda d, i: F.when(
        i % 2 == 1, F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]),
                                 F.coalesce(d.try_cast("int"), F.lit(0)) + 1))
        .otherwise(F.coalesce(d.try_cast("int"), F.lit(0))))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def passes(kind: str, hit: Column) -> Column:
    """The check that a strict match of a kind has to pass."""
    if kind == "ip":
        return F.forall(F.split(hit, r"\."), lambda p: F.length(F.regexp_replace(
            p, "^0+", "")) <= 3) & F.forall(F.split(hit, r"\."), lambda p: F.coalesce(
                F.substring(F.regexp_replace(p, "^0+(?=[0-9])", ""), 1, 4).try_cast("int"),
                F.lit(0)) <= 255)
    if kind == "card":
        n = F.length(_digits(hit))
        return F.when(n.between(12, 19), luhn(_digits(hit))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(hit)).between(9, 15)
    return F.lit(True)


def _listed(words: tuple[str, ...]) -> str:
    return "(?:" + "|".join(words) + ")"


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _candidate(pieces: Column, kind: str, strict: bool, s: Column) -> Column:
    """A span with the labelers' votes and its form."""
    hit, digits = s["hit"], _digits(s["hit"])
    lead = F.lower(before(pieces, s["start"], 24))
    prev, nxt = before(pieces, s["start"], 1), after(pieces, s["end"], 1)
    word = rf"(?:^|[^a-z]){{0}}[^a-z]{{{{0,3}}}}(?:[a-z]{{{{0,3}}}}[^a-z]{{{{0,3}}}})?$"
    distinct = F.size(F.array_distinct(F.split(digits, "(?!^)")))
    listed = {
        "email": F.lower(hit).rlike(rf"{_listed(ENDINGS)}$"),
        "ip": ~hit.rlike(r"^(?:0|127|255)\."),
        "card": digits.rlike("^[3-6]"),
        "phone": F.lit(not strict) | digits.rlike("^" + _listed(COUNTRY_CODES)),
    }[kind]
    ok = passes(kind, hit) if strict else F.lit(False)
    return F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"),
        ok.alias("base"),
        (_vote(ok, F.lit(strict))).alias("v_strict"),
        _vote(lead.rlike(word.format(_listed(CONTACT_WORDS))),
              lead.rlike(word.format(_listed(OTHER_WORDS)))).alias("v_context"),
        _vote(listed, ~listed).alias("v_list"),
        (F.lit(0) if kind == "email" else _vote(distinct >= 4, distinct <= 2)).alias("v_digits"),
        _vote(~prev.rlike("[A-Za-z0-9]") & ~nxt.rlike("[A-Za-z0-9]"),
              prev.rlike("[A-Za-z0-9]")).alias("v_edge"),
        *[F.lit(int(kind == k)).alias(f"is_{k}") for k in KINDS],
        F.when(hit.contains(" "), 1).otherwise(0).alias("spaced"))


def _usable(kind: str, s: Column) -> Column:
    """A digit run of a card's pattern is a candidate from 12 to 19 digits."""
    return F.length(_digits(s["hit"])).between(12, 19) if kind == "card" else F.lit(True)


def _candidates(pieces: Column, spans: Column, kind: str, strict: bool) -> Column:
    return F.transform(F.filter(spans, lambda s: _usable(kind, s)),
                       lambda s: _candidate(pieces, kind, strict, s))


def with_candidates(df: DataFrame, text_col: str) -> DataFrame:
    """Add ``__pii``: every candidate of a text with its votes, and drop nothing else."""
    df = df.withColumn("__t", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    found, names = [], []
    for strict, patterns, needs in ((True, STRICT, NEEDS), (False, LOOSE, LOOSE_NEEDS)):
        for kind, pattern in patterns.items():
            name = f"__{kind}_{int(strict)}"
            df = with_spans(df, "__t", pattern, name, needs.get(kind, ()))
            found.append((F.col(name), kind, strict))
            names.append(name)
    some = sum((F.size(n) for n in names[1:]), F.size(names[0])) > 0
    return df.withColumn("__pii", let(F.when(some, chunks(F.col("__t"))), lambda pieces: F.concat(
        *[_candidates(pieces, *x) for x in found]))).drop("__t", *names)


def em(rows: list[dict], rounds: int = EM_ROUNDS) -> list[float]:
    """Posterior of each counted vote pattern (LABELERS and ``n``) that it is personal data.

    A labeler's three outcomes have their own probabilities for true and false
    candidates (with a count of one for each); a vote of the majority starts.
    Strict matches anchor the two classes: passing their check keeps a posterior
    of 0.9 or more, failing it one of 0.1 or less.
    """
    post = [min(0.95, max(0.05, 0.5 + 0.2 * sum(r[v] for v in LABELERS))) for r in rows]
    for _ in range(rounds):
        total = sum(r["n"] for r in rows)
        true = sum(r["n"] * p for r, p in zip(rows, post, strict=True))
        prior = (true + 1) / (total + 2)
        table = {}
        for v in LABELERS:
            for value in (-1, 0, 1):
                for truth in (0, 1):
                    mass = sum(r["n"] * (p if truth else 1 - p)
                               for r, p in zip(rows, post, strict=True) if r[v] == value)
                    every = true if truth else total - true
                    table[v, value, truth] = (mass + 1) / (every + 3)
        new = []
        for r in rows:
            odds = math.log(prior / (1 - prior)) + sum(
                math.log(table[v, r[v], 1] / table[v, r[v], 0]) for v in LABELERS)
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
            new.append(max(p, 0.9) if r["v_strict"] > 0 else min(p, 0.1) if r["v_strict"] < 0
                       else p)
        post = new
    return post


class Classifier:
    """Weights of the span classifier by feature name, and the least score of a span."""

    def __init__(self, weights: dict[str, float], bias: float, least: float):
        self.weights, self.bias, self.least = weights, bias, least

    def accepts(self, s: Column) -> Column:
        score = sum((s[k] * F.lit(w) for k, w in self.weights.items()), F.lit(self.bias))
        return score >= self.least


def train(docs: DataFrame, text_col: str = "text", least: float = 0.5) -> Classifier:
    """Count vote patterns over all ``docs``, run EM, fit the span classifier.

    Without candidates the classifier accepts nothing beyond the base spans.
    """
    spark = docs.sparkSession
    # (explode would infer a filter that finds all candidates a second time)
    c = with_candidates(docs.select(text_col), text_col).select(
        F.explode_outer("__pii").alias("s")).where("s is not null")
    names = [*LABELERS, *FORM]
    counted = [r.asDict() for r in c.select(*[F.col(f"s.{n}") for n in names]).groupBy(
        *names).agg(F.count(F.lit(1)).alias("n")).collect()]  # at most 3^5 votes x 8 forms
    if not counted:
        return Classifier({}, -1.0, 0.0)
    rows = []
    for r, p in zip(counted, em(counted), strict=True):
        rows += [(1.0, r["n"] * p, *(float(r[k]) for k in names)),
                 (0.0, r["n"] * (1 - p), *(float(r[k]) for k in names))]
    table = spark.createDataFrame(rows, "label double, weight double, " + ", ".join(
        f"{k} double" for k in names)).coalesce(1)
    fit = LogisticRegression(weightCol="weight", regParam=1e-3, maxIter=100).fit(
        VectorAssembler(inputCols=names, outputCol="features").transform(table))
    return Classifier(dict(zip(names, map(float, fit.coefficients), strict=True)),
                      float(fit.intercept), math.log(least / (1 - least)))


def find(df: DataFrame, model: Classifier, text_col: str = "text") -> DataFrame:
    """Add ``pii_base`` and ``pii_spans``: arrays of (start, rank, kind, end) by start, then kind.

    A null text counts as empty. Base spans are the strict matches that pass
    their check; ``pii_spans`` adds the accepted candidates that overlap no base
    span. All other columns and rows stay as they are.
    """
    rank = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])

    def slim(a: Column) -> Column:
        return F.array_sort(F.transform(a, lambda s: F.struct(
            s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["kind"].alias("kind"),
            s["end"].alias("end"))))

    df = with_candidates(df, text_col)
    df = df.withColumn("pii_base", slim(F.filter("__pii", lambda s: s["base"])))
    df = df.withColumn("__more", slim(F.filter("__pii", lambda s: ~s["base"] & model.accepts(s))))
    some = (F.size("__more") > 0) & (F.size("pii_base") > 0)
    free = F.when(some, _free(F.col("__more"), F.col("pii_base"))).otherwise(F.col("__more"))
    return df.withColumn("pii_spans", F.array_sort(F.concat("pii_base", free))).drop(
        "__pii", "__more")


def _free(spans: Column, base: Column) -> Column:
    """Those of ``spans`` that overlap none of ``base``.

    In the order of their ends, the furthest end of all base spans that start before a
    span's end tells whether one of them reaches beyond its start.
    """
    marks = F.array_sort(F.concat(
        F.transform(spans, lambda s: F.struct(
            s["end"].alias("at"), F.lit(0).alias("is_base"), F.lit(0).alias("reach"),
            s.alias("span"))),
        F.transform(base, lambda b: F.struct(
            b["start"].alias("at"), F.lit(1).alias("is_base"), b["end"].alias("reach"),
            b.alias("span")))))
    return let(marks, lambda all_marks: F.transform(F.filter(F.zip_with(
        all_marks, running(F.transform(all_marks, lambda m: m["reach"]), F.greatest),
        lambda m, reach: F.struct(m.alias("m"), reach.alias("reach"))),
        lambda x: (x["m"]["is_base"] == 0) & (x["reach"] <= x["m"]["span"]["start"])),
        lambda x: x["m"]["span"]))


def listing(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with each span (overlapping ones: their union) replaced by its kind in brackets."""
    def parts(pieces: Column, reach: Column) -> Column:
        def part(s: Column, i: Column) -> Column:
            at = F.coalesce(F.get(reach, i - 1), F.lit(0))
            return F.when(s["start"] >= at, F.concat(
                between(pieces, at, s["start"]), F.lit("<"), F.upper(s["kind"]), F.lit(">")))
        rest = between(pieces, F.element_at(reach, -1), F.size(pieces) * CHUNK)
        return F.concat(F.array_join(F.transform(spans, part), ""), rest)

    return F.when(F.size(spans) > 0, let(chunks(text), lambda pieces: let(running(F.transform(
        spans, lambda s: s["end"]), F.greatest), lambda reach: parts(pieces, reach)))).otherwise(text)


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
