"""Toxicity scores from boosted trees over dense features (operator 8).

Features of a text: densities of a lexicon's words, as written and under disguise (digits
and signs for letters, signs between letters), how near they stand to second-person words,
and rates of capitals, punctuation, signs and mixed words.  The lexicon is a short fixed
list and the words and word beginnings that tell toxic training texts from others.
Boosted trees (MLlib) learn from the features; isotonic regression turns their probability
into the score, with a small share of the raw probability that keeps the order inside its
steps.

Training takes at most about ``SAMPLE_ROWS`` labelled rows, chosen by a hash of doc_id, in
three parts that share no row: lexicon, trees, calibration.  Everything else reads all rows.
Rows whose crc32(doc_id as text) modulo 4 is 2 are never learned from.

Cases: a null text counts as empty, and an empty text is scored as any other; documents
without doc_id are scored and never learned from; a document with several labels is toxic if
one says so; without labels of both kinds the score is the share of toxic labels (0 without
labels); repeated rows are scored each.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.llm.common import pieces, release, staged, working

#: Most labelled rows that training takes, about.
SAMPLE_ROWS = 24_000
#: Most learned lexicon entries.
LEXICON_ENTRIES = 4_000
#: Log-likelihood ratio from which a word or beginning enters the lexicon.
LEAST_EVIDENCE = 30.0
#: Score from which a text counts as toxic.
REJECT = 0.3
#: Share of the raw probability in the score.
RAW_SHARE = 1e-3

#: Fixed lexicon to start from.
INSULTS = frozenset("idiot moron loser stupid scum trash worthless pathetic clown disgusting "
                    "dumb jerk fool bastard hate kill".split())
#: Second-person words in English, French, German and Spanish.
SECOND_PERSON = frozenset("you your yours yourself u ur tu te toi vous votre vos ton du dich dir "
                          "dein deine euch ihr tú ti usted ustedes vosotros".split())
#: Letters that digits and signs stand for.
DISGUISES = str.maketrans("013457@$!", "oieastasi")
EDGE = re.compile(r"^[^\w@$]+|[^\w@$!]+$|!+$")
INNER = re.compile(r"[^\w]+|_+")
FEATURES = ("words", "hits", "hit_density", "kinds", "disguised", "near_you", "you_rate",
            "capitals", "shouted", "exclaims", "questions", "punctuation", "signs", "mixed",
            "fixed_hits")


def learnable(doc_id: Column) -> Column:
    """Rows that training may use."""
    return doc_id.isNotNull() & (F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def stems(word: str) -> list[str]:
    """The word and its beginnings of four to six letters (marked with a trailing dash)."""
    return [word, *(word[:n] + "-" for n in (4, 5, 6) if len(word) > n)]


def plain(word: str) -> str:
    """A lower-cased word without the signs around it."""
    return EDGE.sub("", word)


def features(text: str | None, lexicon: frozenset[str]) -> list[float]:
    """The dense features of one text, in the order of ``FEATURES``."""
    text = text or ""
    low = text.lower().split()
    n = len(low)
    hits, fixed, disguised, kinds, you = [], 0, 0, set(), []
    mixed = 0
    memo: dict[str, tuple[bool, bool, str]] = {}
    for i, raw in enumerate(low):
        known = memo.get(raw)
        if known is None:
            word = plain(raw)
            hit = any(s in lexicon for s in stems(word))
            hidden = False
            if not hit and not word.isalpha() and word:
                clear = INNER.sub("", word.translate(DISGUISES))
                hidden = clear != word and len(clear) > 3 and any(s in lexicon for s in stems(clear))
            known = memo[raw] = (hit, hidden, word)
        hit, hidden, word = known
        if hit or hidden:
            hits.append(i)
            kinds.add(word)
            disguised += hidden
            fixed += word in INSULTS
        if word in SECOND_PERSON:
            you.append(i)
        mixed += not word.isalpha() and any(c.isdigit() for c in word) and any(c.isalpha() for c in word)
    near = 0
    if hits and you:
        at = np.searchsorted(you, hits)
        spots = np.concatenate(([-10 ** 9], you, [10 ** 9]))
        near = int(((np.array(hits) - spots[at] <= 5) | (spots[at + 1] - np.array(hits) <= 5)).sum())
    size, words = max(len(text), 1), max(n, 1)
    letters = max(sum(map(str.isalpha, text)), 1)
    upper = sum(map(str.isupper, text))
    shouted = sum(1 for w in text.split() if len(w) > 2 and w.isupper())
    marks = {c: text.count(c) for c in "!?.,;:*#$%&@|"}
    return [float(np.log1p(n)), float(np.log1p(len(hits))), len(hits) / words, float(len(kinds)),
            disguised / words, near / words, len(you) / words, upper / letters, shouted / words,
            marks["!"] / size, marks["?"] / size, sum(marks[c] for c in ".,;:") / size,
            sum(marks[c] for c in "*#$%&@|") / size, mixed / words, float(np.log1p(fixed))]


@dataclass
class Model:
    """Lexicon, trees and calibration; ``prior`` stands in where there was nothing to learn."""

    lexicon: frozenset[str]
    trees: object | None
    calibration: object | None
    prior: float


def _with_features(docs: DataFrame, lexicon: frozenset[str], text: str, keep: list[str]) -> DataFrame:
    """``keep`` columns plus ``__features``.  Only the text goes to Python and only the features come back."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def measured(texts: pa.Array) -> pa.Array:
        working("toxicity")
        words, rows = shared.value, []
        for at in range(0, len(texts), 64):
            rows += [features(t, words) for t in texts.slice(at, 64).to_pylist()]
        release()
        return pa.array(rows, pa.list_(pa.float64()))

    return docs.select(*keep, measured(docs[text]).alias("__features"))


def learn_lexicon(rows: DataFrame) -> frozenset[str]:
    """Entries that mark toxic texts, from (text, toxic) rows: counts of texts by entry, then
    the log-likelihood ratio."""

    def count(batches):
        for batch in pieces(batches, most=2 << 20):
            seen: dict[str, list[int]] = {}
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                for entry in {s for w in {plain(w) for w in (text or "").lower().split()}
                              if len(w) > 3 for s in stems(w)}:
                    seen.setdefault(entry, [0, 0])[toxic] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), pa.array([v[1] for v in seen.values()], pa.int64()),
                 pa.array([v[0] for v in seen.values()], pa.int64())], ["entry", "bad", "good"])

    sums = rows.agg(F.sum("toxic").alias("bad"), F.count("*").alias("n")).first()
    bad, good = sums["bad"] or 0, (sums["n"] or 0) - (sums["bad"] or 0)
    if not bad or not good:
        return INSULTS
    entries = rows.mapInArrow(count, "entry string, bad long, good long").groupBy("entry").agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good"))

    def term(observed, share):
        return F.when(observed > 0, observed * F.log(observed / ((F.col("bad") + F.col("good")) * F.lit(share)))) \
            .otherwise(0.0)

    share = bad / (bad + good)
    evidence = 2 * (term(F.col("bad"), share) + term(F.col("good"), 1 - share))
    top = entries.withColumn("evidence", evidence) \
        .where((F.col("evidence") >= LEAST_EVIDENCE) & (F.col("bad") >= 4 * F.col("good"))) \
        .orderBy(F.desc("evidence"), "entry").limit(LEXICON_ENTRIES)
    return INSULTS | {r["entry"] for r in top.select("entry").collect()}


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
        sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from labelled documents that ``learnable`` allows."""
    marked = labels.select(labels["doc_id"].alias("doc_id"), labels["toxic"].cast("int").alias("toxic")) \
        .where(learnable(F.col("doc_id")) & F.col("toxic").isin(0, 1)) \
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = marked.count()
    draw = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1_000_000))
    share = min(1.0, sample_rows / n) if n else 1.0
    chosen = marked.where(draw < int(share * 1_000_000)) \
        .withColumn("part", F.pmod(F.xxhash64(F.lit(12), "doc_id"), F.lit(10)))
    # at most about sample_rows rows of two numbers, so this side is small by construction
    rows = staged(docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
                  .join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic", "part"),
                  "toxicity-sample")
    lexicon = learn_lexicon(rows.where("part < 4"))
    known = staged(_with_features(rows, lexicon, "text", ["toxic", "part"])
                   .withColumn("features", array_to_vector("__features")).drop("__features")
                   .withColumn("label", F.col("toxic").cast("double")), "toxicity-features")
    learn, check = known.where("part between 4 and 7"), known.where("part > 7")
    kinds = {r["toxic"]: r["n"] for r in learn.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    prior = kinds.get(1, 0) / max(1, sum(kinds.values()))
    if len(kinds) < 2:
        return Model(lexicon, None, None, prior)
    # the sample is small: a few partitions, so that the many passes of boosting stay cheap
    held = learn.select("features", "label").repartition(4).cache()
    trees = GBTClassifier(maxIter=20, maxDepth=4, stepSize=0.2, seed=5, maxBins=32).fit(held)
    held.unpersist()
    told = trees.transform(check).select(_raw(F.col("probability")).alias("raw"), "label")
    told = told.union(trees.transform(learn).select(_raw(F.col("probability")), "label")) \
        if check.where("toxic = 1").limit(20).count() < 20 else told
    calibration = IsotonicRegression(featuresCol="raw", labelCol="label").fit(told)
    return Model(lexicon, trees, calibration, prior)


def _raw(probability: Column) -> Column:
    return vector_to_array(probability)[1]


def score_documents(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns plus ``__score``: one narrow pass over all texts."""
    if model.trees is None:
        return docs.select(*keep).withColumn("__score", F.lit(float(model.prior)))
    rows = _with_features(docs, model.lexicon, text, keep) \
        .withColumn("__vector", array_to_vector("__features"))
    trees = model.trees.copy().setFeaturesCol("__vector").setPredictionCol("__tree") \
        .setProbabilityCol("__probability").setRawPredictionCol("__margin")
    told = trees.transform(rows).withColumn("__raw", _raw(F.col("__probability")))
    # the calibration is a piecewise linear function of a few points
    xs, ys = [float(x) for x in model.calibration.boundaries], [float(y) for y in model.calibration.predictions]

    def calibrated(raw: Column) -> Column:
        value = F.lit(ys[-1])
        for x0, x1, y0, y1 in reversed(list(zip(xs, xs[1:], ys, ys[1:]))):
            slope = (y1 - y0) / (x1 - x0) if x1 > x0 else 0.0
            value = F.when(raw <= x1, F.lit(y0) + (raw - x0) * slope).otherwise(value)
        return F.when(raw <= xs[0], F.lit(ys[0])).otherwise(value) * (1 - RAW_SHARE) + raw * RAW_SHARE

    # inside a lambda, so that the trees run once a row and not once for every branch
    score = F.transform(F.array("__raw"), calibrated)[0]
    return told.select(*keep, F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)).alias("__score"))


def keep_clean(docs: DataFrame, model: Model, text: str = "text", reject: float = REJECT) -> DataFrame:
    """Documents that score below ``reject``, with their own columns."""
    return score_documents(docs, model, docs.columns, text).where(F.col("__score") < reject) \
        .drop("__score")
