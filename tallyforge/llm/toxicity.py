"""Toxicity grades by cumulative-link ordinal regression.

P(grade <= k) = logistic(threshold_k - w.x): one weight vector shared by all ordered
thresholds. x are sparse text features: words and word beginnings, each with 1 + ln(count).
The weights are fitted with an L1 penalty, so few features stay.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import WordStore, kept_table, map_chunks, texts_of

WORDS = re.compile(r"[^\W\d_]+").findall
#: Lengths of the word beginnings that count as features, for inflected words.
STEMS = (4, 5, 6)
GRADES = 3


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def grades(self, scores: np.ndarray) -> np.ndarray:
        """Probability of every grade, one row for each score."""
        below = _logistic(np.array(self.thresholds)[None, :] - scores[:, None])
        return np.diff(np.c_[np.zeros(len(scores)), below, np.ones(len(scores))], axis=1)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _names(word: str) -> list[str]:
    """The features of a word: itself, and its beginnings, marked by a hyphen."""
    return [word, *(word[:n] + "-" for n in STEMS if len(word) > n)]


class _Chosen(WordStore):
    """Word to its features among the chosen ones."""

    def __init__(self, features):
        super().__init__(lambda word: tuple(f for f in _names(word) if f in features))

    def count(self, text: str) -> Counter:
        hits = [f for f in map(self.__getitem__, WORDS(text.lower())) if f]
        return Counter(x for f in hits for x in f)


def labelled(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """doc_id, text, toxic (0 or 1) and worst (the label itself) of at most `rows` labelled
    documents, chosen by a digest of the doc_id. Labels without doc_id or toxic are left out; of
    several the worst counts."""
    marks = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("worst"))
        .withColumn("toxic", (F.col("worst") > 0).cast("int"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    texts = docs.where("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    # At most `rows` small rows: safe to broadcast
    return texts.join(F.broadcast(marks), "doc_id")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    rows: int = 8_000,
    features: int = 1_024,
    penalty: float = 1e-4,
    steps: int = 800,
) -> Model:
    """Fit on a bounded sample of `rows` labelled documents (repeated doc_ids count each).

    The `features` words and beginnings that differ most between the labels (signed root of
    the log-likelihood ratio, in 3 documents or more) are chosen by Spark; the driver gets
    only their counts in the sample. Labels above 0 are toxic. Where they have more than two
    values, those are the grades, in their order. Where they are 0 and 1, toxic documents are
    graded 1 or 2 by whether fewer or more of the telling words stand in them than in half of
    the toxic ones, so that severity tells the amount of such words and no more. Without labels
    of both kinds, as in an empty table, the model has no weights and grades all 0.
    """
    sample = kept_table(labelled(docs, labels, rows), "labelled")
    sizes = dict(sample.groupBy("toxic").count().collect())
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 or not n1:
        return Model({}, (30.0, 31.0))

    def counted():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            seen = Counter()
            for text, toxic in zip(
                texts_of(batch), batch.column("toxic").to_pylist(), strict=True
            ):
                words = set(WORDS(text.lower()))
                seen.update((f, toxic) for f in {f for w in words for f in _names(w)})
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in seen], pa.string()),
                    pa.array([n if k[1] else 0 for k, n in seen.items()], pa.int64()),
                    pa.array([0 if k[1] else n for k, n in seen.items()], pa.int64()),
                ],
                ["feature", "bad", "good"],
            )

        return each

    seen = map_chunks(sample, "text", counted, "feature string, bad long, good long")
    a, b = F.sum("bad").alias("bad"), F.sum("good").alias("good")
    seen = seen.groupBy("feature").agg(a, b).where("bad + good >= 3")
    share = (F.col("bad") + F.col("good")) / (n0 + n1)
    term = lambda x, n: F.when(x > 0, x * F.log(x / (n * share))).otherwise(0.0)
    gone = F.lit(n1) - F.col("bad"), F.lit(n0) - F.col("good")
    rest = lambda x, n: F.when((x > 0) & (share < 1), x * F.log(x / (n * (1 - share)))).otherwise(0.0)
    ratio = (
        term(F.col("bad"), n1) + term(F.col("good"), n0) + rest(gone[0], n1) + rest(gone[1], n0)
    )
    chosen = (
        seen.select("feature", (F.col("bad") / n1 > F.col("good") / n0).alias("tells"), ratio.alias("g"))
        .orderBy(F.desc("g"), "feature")
        .limit(features)
        .collect()
    )
    place = {r.feature: i for i, r in enumerate(chosen)}
    telling = np.array([r.tells and r.g > 10 for r in chosen], bool)

    def vectors():
        choice = _Chosen(place)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [choice.count(t) for t in texts_of(batch)]
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("worst"),
                    pa.array([[place[f] for f in c] for c in found], pa.list_(pa.int32())),
                    pa.array([list(c.values()) for c in found], pa.list_(pa.int32())),
                ],
                ["doc_id", "worst", "at", "n"],
            )

        return each

    shape = "doc_id long, worst int, at array<int>, n array<int>"
    got = sorted(map_chunks(sample, "text", vectors, shape).collect())
    x = np.zeros((len(got), len(place)), np.float32)
    for row, r in zip(x, got, strict=True):
        row[r.at] = 1 + np.log(r.n)
    worst = np.maximum([r.worst for r in got], 0)
    if len(given := np.unique(worst)) > 2:
        grade = np.searchsorted(given, worst)
    else:
        bad = worst > 0
        amount = x[:, telling].sum(1)
        grade = bad.astype(int) + (bad & (amount > np.median(amount[bad])))
    w, thresholds = _regress(x, grade, penalty, steps, max(GRADES, len(given)))
    return Model({f: float(w[i]) for f, i in place.items() if w[i]}, thresholds)


def _regress(
    x: np.ndarray, grade: np.ndarray, penalty: float, steps: int, grades: int = GRADES
) -> tuple[np.ndarray, tuple[float, ...]]:
    """Weights and thresholds by proximal gradient steps with momentum."""
    n = len(x)
    v = np.ones(x.shape[1], np.float32)
    for _ in range(20):
        v = x.T @ (x @ v)
        size = float(np.linalg.norm(v)) or 1.0
        v /= size
    pace = 1.0 / (size / n / 2 + 1.0)
    shares = np.cumsum(np.bincount(grade, minlength=grades) + 0.5) / (n + 0.5 * grades)
    cuts = np.log(shares[:-1] / (1 - shares[:-1]))
    w = np.zeros(x.shape[1], np.float32)
    old_w, old_cuts = w.copy(), cuts.copy()
    for step in range(steps):
        push = step / (step + 3)
        at_w, at_cuts = w + push * (w - old_w), cuts + push * (cuts - old_cuts)
        score = (x @ at_w).astype(float)
        edges = np.r_[-np.inf, np.maximum.accumulate(at_cuts), np.inf]
        high, low = _logistic(edges[grade + 1] - score), _logistic(edges[grade] - score)
        p = np.maximum(high - low, 1e-9)
        d_high, d_low = high * (1 - high) / p, low * (1 - low) / p
        slope = x.T @ ((d_high - d_low) / n).astype(np.float32)
        d_cuts = np.array(
            [(d_low[grade == k + 1].sum() - d_high[grade == k].sum()) / n for k in range(grades - 1)]
        )
        old_w, old_cuts = w, cuts
        w = at_w - pace * slope
        w = np.sign(w) * np.maximum(np.abs(w) - pace * penalty, 0)
        cuts = np.maximum.accumulate(at_cuts - pace * d_cuts)
    return w, tuple(float(c) for c in cuts)


def _scored(model: Model):
    choice = _Chosen(model.weights)

    def scores(batch: pa.RecordBatch) -> np.ndarray:
        return np.array(
            [
                sum(model.weights[f] * (1 + np.log(k)) for f, k in sorted(choice.count(t).items()))
                for t in texts_of(batch)
            ],
            float,
        )

    return scores


def severity(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, severity (expected grade), grade (the likeliest, the lower of equals),
    p_toxic (probability of any grade above 0), toxic (p_toxic of a half or more), one row
    for each of `docs`; null texts count as empty, repeated rows and null ids stay, further
    columns are left out, an empty table gives no rows."""

    def start():
        scores = _scored(model)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            p = model.grades(scores(batch))
            bad = 1 - p[:, 0]
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(p @ np.arange(p.shape[1])),
                    pa.array(p.argmax(1).astype(np.int32)),
                    pa.array(bad),
                    pa.array(bad >= 0.5),
                ],
                ["doc_id", "severity", "grade", "p_toxic", "toxic"],
            )

        return each

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return map_chunks(
        rows, "text", start, "doc_id long, severity double, grade int, p_toxic double, toxic boolean"
    )


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs` that `severity` doesn't call toxic, with all their columns."""

    def start():
        scores = _scored(model)
        return lambda batch: batch.filter(pa.array(model.grades(scores(batch))[:, 0] > 0.5))

    return map_chunks(docs, "text", start, docs.schema)
