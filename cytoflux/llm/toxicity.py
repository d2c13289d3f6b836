"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The lexicon is learned: words, and stems of four or five letters, that toxic training texts hold far more often than the others do,
weighted by their log odds; a short stated list stands beside it.  A text becomes a dozen numbers: densities of lexicon words, lexicon
words near a second person, capitals, punctuation and disguised spellings.  Boosted trees are fitted to these, and an isotonic
regression on labelled rows of its own turns their output into a probability.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_share, id_class, kept, small_side, stored, table, with_columns_from

#: Labelled rows that trees and calibration are fitted to, on average, chosen by a hash of the id; the lexicon counts all training rows.
SAMPLE = 20_000
#: Terms counted and kept at most, the most frequent in toxic texts first and the best first.
CANDIDATES, LEXICON = 65_536, 4096
#: A term is judged if so many toxic texts, and this share of them, hold it; it enters the lexicon if its log odds, less so many of their standard deviations, reach a bound.
LEAST, LEAST_SHARE, SURE, ODDS = 3, 0.002, 1.64, math.log(4)
#: Labels broadcast at most, after a count; beyond, texts are joined by id.
KEYS = 2_000_000
TREES, DEPTH, STEP, SEED = 30, 3, 0.3, 7
#: One part in so many of the sample calibrates, the rest grows trees.
FOLDS = 4
#: The share of the trees' own probability in a score: it orders texts of one calibrated step, and tells them apart where few rows calibrate.
TIE = 0.25
CUT = 0.3
NEAR = 5

#: Insults in general use (fixed values), counted beside the learned lexicon.
STATED = frozenset("idiot idiots moron morons stupid loser losers scum pathetic worthless disgusting dumb trash garbage clown hate shut ugly fool jerk imbecile vermin filth".split())
#: Second persons (fixed values): English, German, French, Spanish.
SECOND = frozenset("you your yours yourself ur du dich dir dein deine ihr euch euer sie tu te toi ton ta tes vous votre vos ti tú usted ustedes vosotros os".split())
_LEET = str.maketrans("013457@$!|", "oieastasil")
_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_DISGUISED = re.compile(r"(?<!\S)(?=\S*[A-Za-z])(?:[A-Za-z]+[013457@$!|*]+(?=[A-Za-z])\S*|[@$][A-Za-z]\S*|[A-Za-z](?:[.\-_*][A-Za-z]){2,}(?!\S))")
_STRETCHED = re.compile(r"([^\W\d_])\1{3,}")

FEATURES = ["hits", "weight", "strongest", "density", "stated", "near_you", "disguised", "disguised_hits", "stretched", "capitals", "shouted", "exclaims", "questions", "marks", "log_words"]


def terms(word: str) -> tuple[str, ...]:
    """What a lower-case word counts as: itself (to 40 letters) and its stems of four and five letters, where it is longer."""
    n = len(word)
    if n > 40:
        return f"{word[:4]}~", f"{word[:5]}~"
    return (word, f"{word[:4]}~", f"{word[:5]}~") if n > 5 else (word, f"{word[:4]}~") if n > 4 else (word,)


def term_set(text: str) -> set[str]:
    words = set(_WORD.findall(text.lower()))
    return {t for w in words for t in terms(w)}


class Lexicon:
    """Weights of terms; a word weighs as its heaviest term.  Words looked up are kept, a bounded number."""

    KEPT_WORDS = 200_000

    def __init__(self, weights: dict[str, float]) -> None:
        self.weights = weights
        self.words: dict[str, float] = {}

    def weight(self, word: str) -> float:
        found = self.words.get(word)
        if found is None:
            found = max((self.weights.get(t, 0.0) for t in terms(word)), default=0.0)
            if len(self.words) < self.KEPT_WORDS:
                self.words[word] = found
        return found

    def features(self, text: str) -> tuple[float, ...]:
        """The numbers of a whole text, in the order of ``FEATURES``; all are 0 for an empty text."""
        words = _WORD.findall(text.lower())
        n, chars = max(len(words), 1), max(len(text), 1)
        known = list(map(self.words.get, words))
        weights = [self.weight(w) if k is None else k for k, w in zip(known, words, strict=True)] if None in known else known
        at = [i for i, w in enumerate(weights) if w] if any(weights) else []
        stated = sum(w in STATED for w in words)
        near = sum(not SECOND.isdisjoint(words[max(i - NEAR, 0) : i + NEAR + 1]) for i in at)
        odd = [w for w in _DISGUISED.findall(text)] if chars > 3 else []
        plain = [re.sub(r"[^a-z]", "", w.lower().translate(_LEET)) for w in odd]
        hidden = sum(w in STATED or self.weight(w) > 0 for w in plain)
        capitals = sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
        shouted = len(_SHOUTED.findall(text)) if capitals * 20 > chars else 0
        total = sum(weights[i] for i in at)
        return (
            math.log1p(len(at)),
            total / n,
            max((weights[i] for i in at), default=0.0),
            len(at) / n,
            stated / n,
            near / n,
            len(odd) / n,
            hidden / n,
            len(_STRETCHED.findall(text)) / n,
            capitals / chars,
            shouted / n,
            text.count("!") / chars,
            text.count("?") / chars,
            sum(map(text.count, ".,;:*#")) / chars,
            math.log1p(len(words)),
        )


_SHOUTED = re.compile(r"\b[A-Z]{3,}\b")


def labelled_rows(docs: DataFrame, labels: DataFrame, training: Column) -> DataFrame:
    """(doc_id, text, label) of training rows with a label of 0 or 1; several labels of an id count once, the greatest."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    return docs.select("doc_id", "text").where(training).join(small_side(known.where(training), KEYS), "doc_id")


def _texts_with_term(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to (term, n), summed over a bounded number of terms at a time."""
    counts: Counter[str] = Counter()

    def out():
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"])

    for batch in batches:
        for text in batch.column(0).to_pylist():
            counts.update(term_set(text or ""))
            if len(counts) > 500_000:
                yield out()
                counts.clear()
    if counts:
        yield out()


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Terms and sure log odds from (text, label): how much more often toxic texts hold a term than the others, one half added to each count, less ``SURE`` standard deviations."""
    spark = rows.sparkSession
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    ones, zeros = sizes.get(1, 0), sizes.get(0, 0)
    if not ones:
        return {}
    toxic = rows.where("label = 1").select("text").mapInArrow(_texts_with_term, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    often = toxic.where(F.col("n") >= max(LEAST, LEAST_SHARE * ones)).orderBy(F.desc("n"), "term").limit(CANDIDATES).collect()
    place = {r["term"]: i for i, r in enumerate(often)}
    if not place:
        return {}
    shared = spark.sparkContext.broadcast(place)

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        counts = np.zeros(len(index), np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = [i for i in map(index.get, term_set(text or "")) if i is not None]
                counts[found] += 1
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["at", "n"])

    clean = np.zeros(len(place), np.int64)
    for r in rows.where("label = 0").select("text").mapInArrow(others, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        clean[r["at"]] = r["n"]
    odds = {}
    for r, c in zip(often, clean.tolist(), strict=True):
        spread = math.sqrt(1 / (r["n"] + 0.5) + 1 / (c + 0.5))
        odds[r["term"]] = math.log((r["n"] + 0.5) / (ones + 1)) - math.log((c + 0.5) / (zeros + 1)) - SURE * spread
    best = sorted((-w, t) for t, w in odds.items() if w >= ODDS)[:LEXICON]
    return {t: -w for w, t in best}


def _lexicon(shared, key: str) -> Lexicon:
    return kept(f"toxic {key}", lambda: Lexicon(shared.value))


def with_features(docs: DataFrame, weights: dict[str, float]) -> DataFrame:
    """The columns of ``docs`` but text, and ``FEATURES``; a null text counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    key = uuid.uuid4().hex

    def make():
        lexicon = _lexicon(shared, key)

        def compute(column: pa.Array):
            rows = [lexicon.features(x or "") for x in column.to_pylist()]
            return [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in FEATURES]

        return compute

    return with_columns_from(docs, ["text"], dict.fromkeys(FEATURES, "double"), make).drop("text")


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="x").transform(rows)


def _probability(model: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    return model.transform(_assembled(rows)).withColumn("p", vector_to_array("probability")[1])


def fit(rows: DataFrame, sample: int = SAMPLE) -> dict:
    """Learn from (doc_id, text, label): the lexicon, the trees and the calibration.

    Without a row of each label there are no trees, and a score is the share of toxic rows (0 without rows).
    """
    weights = learn_lexicon(rows)
    chosen = rows.where(hash_share(F.xxhash64("doc_id"), sample, rows.count()))
    seen = stored(with_features(chosen, weights).withColumn("label", F.col("label").cast("double"))).repartition(4).cache()
    calibrating = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(FOLDS)) == 0
    counts = {(r["c"], r["label"]): r["n"] for r in seen.groupBy(calibrating.alias("c"), "label").agg(F.count("*").alias("n")).collect()}
    ones, zeros = (sum(n for (_, label), n in counts.items() if label == v) for v in (1.0, 0.0))
    model = {"weights": weights, "prior": ones / max(ones + zeros, 1), "trees": None, "curve": None}
    if all(counts.get((c, v)) for c in (False, True) for v in (0.0, 1.0)):
        trees = GBTClassifier(featuresCol="x", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=SEED, minInstancesPerNode=5, maxBins=64)
        model["trees"] = trees.fit(_assembled(seen.where(~calibrating)).select("x", "label"))
        judged = _probability(model["trees"], seen.where(calibrating)).select("p", "label")
        model["curve"] = IsotonicRegression(featuresCol="p", predictionCol="calibrated").fit(judged)
    seen.unpersist()
    return model


def predict(docs: DataFrame, model: dict, cut: float = CUT) -> DataFrame:
    """The columns of ``docs`` (doc_id and others) but text, with ``score`` and ``predicted``; rows are independent, a null text counts as empty."""
    others = [c for c in docs.columns if c not in ("text", "score", "predicted")]
    trees, curve = model["trees"], model["curve"]
    if trees is None:
        return docs.select(*others, F.lit(float(model["prior"])).alias("score"), F.lit(int(model["prior"] >= cut)).alias("predicted"))
    aside = {c: f"own_{i}" for i, c in enumerate(others)}
    rows = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in aside.items()], "text")
    found = curve.transform(_probability(trees, with_features(rows, model["weights"])))
    score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (1 - TIE) * F.col("calibrated") + TIE * F.col("p")))
    found = found.withColumn("score", score)
    return found.select(*[F.col(a).alias(c) for c, a in aside.items()], "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame, training: Column, cut: float = CUT) -> DataFrame:
    """Per row of ``docs``: doc_id, ``score`` (0 to 1) and ``predicted``.

    Learns from rows where ``training`` (over doc_id) holds and ``labels.toxic`` is 0 or 1.  A null or empty text is scored as an empty text; a
    null id is scored but never learned from; repeated rows are scored one by one; other columns are not read; an empty table
    gives an empty result.
    """
    docs = docs.select("doc_id", "text")
    return predict(docs, fit(labelled_rows(docs, labels, training)), cut)


def op12_toxicity(spark, sf_dir):
    held_out = id_class(F.col("doc_id"), 4) == 2
    found = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")
