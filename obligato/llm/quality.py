"""Quality classifier: naive Bayes support vectors.

A text is the set of its hashed character n-grams, and of the n-grams of its words' repetition (does a word stand twice
in a row, and how do such places follow each other). Each n-gram's indicator is scaled by the logarithm of how much
more often it stands in good than in bad labelled texts, the vectors are
brought to length one, and a linear hinge-loss model is fitted to them by dual coordinate descent. A logistic curve
through margins of rows that the model has not seen turns margins into probabilities.

The model learns from about ``SAMPLE`` labelled documents of each class, drawn by hash; this sample is the only thing that
is bounded. Every document is scored by its whole text.
"""

from dataclasses import dataclass
from operator import eq

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from obligato.llm.common import map_rows

#: N-grams of two to four characters, hashed into so many buckets. The last bucket stands for every text alike, the ones
#: before it for the repetition of up to four pairs of words.
LONGEST, BUCKETS, PAIRS = 4, 1 << 18, 4
_REPEATS = BUCKETS - 1 - (2 << PAIRS)
#: Characters hashed at once.
STRETCH = 1 << 20
SAMPLE, COST, EPOCHS, TOLERANCE = 2500, 1.0, 20, 0.05
THRESHOLD = 0.3
#: The logistic curve is placed by margins of rows that a model has not seen: the sample is fitted without each of so many parts.
PARTS = 5

_ODD = np.uint64(0x9E3779B97F4A7C15)  # a fixed value: the odd multiplier of the hash
_BITS = np.uint64(64 - 18)


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id as text is divisible by 5. A null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


class Ngrams:
    """The distinct buckets of a text's n-grams; its memory is one flag per bucket."""

    def __init__(self):
        self._held = np.zeros(BUCKETS, bool)

    def __call__(self, text: str | None) -> np.ndarray:
        text, held = (text or "").lower(), self._held
        for start in range(0, len(text), STRETCH):
            stretch = text[start:start + STRETCH + LONGEST - 1].encode("utf-32-le", "surrogatepass")
            joined = code = np.frombuffer(stretch, "<u4").astype(np.uint64)
            for size in range(2, min(LONGEST, len(code)) + 1):
                joined = joined[:-1] * np.uint64(1_000_003) + code[size - 1:]
                held[(joined * np.uint64(2 * size + 1) * _ODD >> _BITS).astype(np.int64) % _REPEATS] = True
        words = text.split()
        pattern = again = np.fromiter(map(eq, words, words[1:]), np.int64, max(len(words) - 1, 0))
        for size in range(1, min(PAIRS, len(again)) + 1):
            held[_REPEATS + (1 << size) + pattern] = True
            pattern = pattern[:-1] * 2 + again[size:]
        held[BUCKETS - 1] = True
        found = np.flatnonzero(held)
        held[found] = False
        return found


@dataclass
class Model:
    """Weights of the indicators, the squares of their scales, and the logistic curve over margins."""

    weights: np.ndarray
    squares: np.ndarray
    slope: float
    middle: float

    def margin(self, found: np.ndarray) -> float:
        length = float(self.squares[found].sum()) ** 0.5
        return float(self.weights[found].sum()) / length if length else 0.0

    def score(self, found: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(found) + self.middle, -500, 500))))


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, *, doc_id: str = "doc_id", text: str = "text",
             label: str = "quality") -> tuple[DataFrame, dict[bool, int]]:
    """(text, good, draw) of about ``sample`` labelled ids of each class, and how many ids each class has.

    An id that is labelled more than once has the label of most of its labels, a good one where they are equal; null labels,
    null ids and held-out ids are not used. Ids are drawn by their hash. An id that stands in several rows gives one text, the
    least. The ids drawn are few, whatever the tables hold, so they are broadcast and no other text is shuffled.
    """
    known = labels.select(F.col(doc_id).cast("long").alias("_id"), F.col(label).cast("double").alias("_label"))
    known = known.where(F.col("_label").isNotNull() & ~held_out(F.col("_id"))).groupBy("_id").agg((F.avg("_label") >= 0.5).alias("good"))
    many = {False: 0, True: 0} | {r["good"]: r["count"] for r in known.groupBy("good").count().collect()}
    draw = F.pmod(F.xxhash64("_id", F.lit("draw")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    part = F.when(F.col("good"), F.lit(sample / max(many[True], 1))).otherwise(F.lit(sample / max(many[False], 1)))
    drawn = known.withColumn("draw", draw).where(F.col("draw") < part)
    texts = docs.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("text"))
    rows = texts.join(F.broadcast(drawn), "_id").groupBy("_id", "good", "draw").agg(F.min("text").alias("text"))
    return rows.select("text", "good", "draw"), many


def log_count_ratios(found: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    """Per bucket, the log of its share among the good texts' buckets over that among the bad ones'; one is added to each count."""
    counts = np.ones((2, BUCKETS))
    for places, g in zip(found, good):
        counts[int(g)][places] += 1
    ratios = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    ratios[-1] = 1.0
    return ratios


def fit_hinge(rows: list[np.ndarray], signs: np.ndarray, scale: np.ndarray, cost: np.ndarray, epochs: int = EPOCHS,
              tolerance: float = TOLERANCE) -> np.ndarray:
    """Weights of scaled indicators that minimise |w|^2 / 2 + the sum of cost x hinge loss, by dual coordinate descent.

    Rows hold the distinct places of their indicators; vectors are brought to length one, so that every coordinate's
    second derivative is one. Ends when no coordinate moves by more than ``tolerance`` of its cost over an epoch.
    """
    weights, dual = np.zeros(len(scale)), np.zeros(len(rows))
    vectors = [scale[r] / max(np.sqrt((scale[r] ** 2).sum()), 1e-12) for r in rows]
    dice = np.random.default_rng(13)
    for _ in range(epochs):
        moved = 0.0
        for i in dice.permutation(len(rows)).tolist():
            slope = signs[i] * float(weights[rows[i]] @ vectors[i]) - 1
            new = min(max(dual[i] - slope, 0.0), cost[i])
            if new != dual[i]:
                moved = max(moved, abs(new - dual[i]) / cost[i])
                weights[rows[i]] += (new - dual[i]) * signs[i] * vectors[i]
                dual[i] = new
        if moved < tolerance:
            break
    return weights


def fit_curve(margins: np.ndarray, good: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and middle of the logistic curve through (margin, good), by Newton steps; softened targets keep it finite."""
    n_good, n_bad = weight[good].sum(), weight[~good].sum()
    target = np.where(good, (n_good + 1) / (n_good + 2), 1 / (n_bad + 2))
    x, at = np.stack([margins, np.ones_like(margins)]), np.array([0.0, np.log((n_good + 1) / (n_bad + 1))])

    def loss(p):
        z = p @ x
        return float((weight * (np.logaddexp(0, z) - target * z)).sum())

    for _ in range(100):
        p = 1 / (1 + np.exp(-(at @ x)))
        gradient = x @ (weight * (p - target))
        step = np.linalg.solve((x * (weight * p * (1 - p))) @ x.T + 1e-9 * np.eye(2), gradient)
        size = 1.0
        while loss(at - size * step) > loss(at) and size > 1e-6:
            size /= 2
        at = at - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return float(at[0]), float(at[1])


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, *, doc_id: str = "doc_id", text: str = "text",
          label: str = "quality") -> Model:
    """The model of about ``sample`` labelled documents of each class (see ``labelled``).

    Null texts are empty; other columns are not read. Where one class is missing, every score is the share of good ids (0.5
    without any).
    """
    rows, many = labelled(docs, labels, sample, doc_id=doc_id, text=text, label=label)

    def make():
        ngrams = Ngrams()
        return lambda columns: {"good": columns["good"], "draw": columns["draw"],
                                "found": [ngrams(t).astype("<i4").tobytes() for t in columns["text"]]}

    drawn = map_rows(rows, {"good": "boolean", "draw": "double", "found": "binary"}, make).collect()
    drawn.sort(key=lambda r: (r.draw, r.good, bytes(r.found)))
    found, good = [np.frombuffer(r.found, "<i4") for r in drawn], np.array([r.good for r in drawn], bool)
    if good.all() or not good.any():
        share = (many[True] + 1) / (many[True] + many[False] + 2)
        return Model(np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, float(np.log(share / (1 - share))))
    # A drawn document stands for as many as its class has for each one drawn.
    weight = np.where(good, many[True] / good.sum(), many[False] / (~good).sum())
    return fit(found, good, weight)


def fit(found: list[np.ndarray], good: np.ndarray, weight: np.ndarray) -> Model:
    """Both classes weigh alike in the hinge loss; the curve, over rows by their weights, brings their shares back."""
    part, margins = np.arange(len(good)) % PARTS, np.zeros(len(good))
    for p in range(PARTS):
        used = part != p
        model = _fit_margin([f for f, u in zip(found, used) if u], good[used])
        margins[~used] = [model.margin(f) for f, u in zip(found, used) if not u]
    model = _fit_margin(found, good)
    model.slope, model.middle = fit_curve(margins, good, weight)
    return model


def _fit_margin(found: list[np.ndarray], good: np.ndarray) -> Model:
    ratios, n_good = log_count_ratios(found, good), max(int(good.sum()), 1)
    n_bad = max(len(good) - n_good, 1)
    # At most 20 times the cost for the rarer class, so that a few odd rows do not rule.
    cost = COST * np.minimum(np.where(good, n_bad, n_good) / min(n_good, n_bad), 20.0)
    return Model(fit_hinge(found, np.where(good, 1.0, -1.0), ratios, cost) * ratios, ratios ** 2, 1.0, 0.0)


def score(docs: DataFrame, model: Model, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 from ``THRESHOLD`` on), one row per row, from the text alone.

    Whole texts of any length; null texts count as empty; null ids and repeated rows stay; other columns are not read; no rows
    give no rows.
    """
    known = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), F.col(text).alias("text"))

    def make():
        ngrams, fitted = Ngrams(), known.value

        def work(columns):
            scores = [fitted.score(ngrams(t)) for t in columns["text"]]
            return {"doc_id": columns["doc_id"], "held_out": columns["held_out"], "score": scores,
                    "predicted": [int(s >= THRESHOLD) for s in scores]}

        return work

    return map_rows(rows, {"doc_id": "long", "held_out": "boolean", "score": "double", "predicted": "int"}, make)
