"""Operator 4, toxicity: a counterfactually regularised classifier.

Logistic regression over the presence of words and word beginnings. For each learning
text that names a group, a copy is made in which every identity term is swapped for
another of its kind; the loss adds ``weight`` times the squared difference of the two
logits. So a term that merely stands in many toxic sentences gains no weight of its
own, and a neutral mention of the group is not marked.

The classifier is fitted on a bounded sample: the ``sample`` labelled documents with
the smallest hash of doc_id (rows that repeat a doc_id: one text of them; labels that
disagree: toxic). Features are the ``features`` words and beginnings with the strongest
association (likelihood ratio) in all labelled documents, of those where it is significant. Every whole text is scored.

Only the text enters a score. NULL is the empty text. Without labelled texts of both
classes the score is the share of toxic labels, or 0.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vatlens.llm.common import fold, materialise

#: EVIDENCE: least likelihood ratio of a feature (chi-square at 0.001, one degree of freedom).
SAMPLE, FEATURES, LEAST, EVIDENCE = 40_000, 4000, 3, 10.83
PREFIXES = (3, 4, 5, 6)
WEIGHT, RIDGE, STEPS = 5.0, 1e-4, 400
#: Fixed: identity terms by kind; a term is swapped for the next of its kind.
IDENTITY = [
    ["women", "men"], ["woman", "man"], ["girls", "boys"], ["girl", "boy"], ["female", "male"], ["she", "he"], ["her", "his"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist"], ["muslims", "christians", "jews", "hindus", "buddhists", "atheists"],
    ["black", "white", "asian", "latino", "african", "european", "arab"], ["gay", "straight", "lesbian", "bisexual", "heterosexual"],
    ["immigrant", "citizen", "refugee", "native"], ["immigrants", "citizens", "refugees", "natives"],
    ["old", "young"], ["disabled", "blind", "deaf"], ["trans", "transgender", "cisgender"],
    ["femmes", "hommes"], ["frauen", "männer"], ["mujeres", "hombres"], ["musulmans", "chrétiens", "juifs"], ["muslime", "christen", "juden"],
    ["musulmanes", "cristianos", "judíos"],
]
SWAP = {t: kind[(i + 1) % len(kind)] for kind in IDENTITY for i, t in enumerate(kind)}

_WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def features_of(word: str) -> list[str]:
    """A word as a feature, and its beginnings (marked by a closing hyphen)."""
    return [word] + [word[:k] + "-" for k in PREFIXES if len(word) >= k]


def counterfactual(found: set[str]) -> set[str] | None:
    """The words with identity terms swapped; None if there are none."""
    return {SWAP.get(w, w) for w in found} if any(w in SWAP for w in found) else None


@dataclass
class Classifier:
    index: dict[str, int]
    weights: np.ndarray
    bias: float

    def __post_init__(self):
        self.memo: dict[str, tuple[int, ...]] = {}

    def ids(self, found: set[str]) -> list[int]:
        """The features of a set of words, once each."""
        memo, out = self.memo, set()
        for w in found:
            got = memo.get(w)
            if got is None:
                if len(memo) > 300_000:
                    memo.clear()
                got = memo[w] = tuple(self.index[f] for f in features_of(w) if f in self.index)
            out.update(got)
        return sorted(out)

    def score(self, text: str) -> float:
        z = self.bias + float(self.weights[self.ids(words(text))].sum())
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def known_labels(labels: DataFrame) -> DataFrame:
    return labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))


def sampled(texts: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, text, toxic) of the learning sample; at most ``sample`` rows.

    The ids are chosen first and, being bounded, broadcast: the other texts do not move."""
    chosen = known_labels(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    return texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic") \
        .agg(F.min_by(F.coalesce("text", F.lit("")), F.xxhash64("text")).alias("text"))


def labelled_words(texts: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, toxic, words) of every labelled document: its distinct words, one text each. Only these words move."""
    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([" ".join(sorted(words(x.as_py() or ""))) for x in batch.column("text")], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("_key"), found], names=["doc_id", "_key", "words"])

    held = texts.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("_key"), "text") \
        .mapInArrow(reduce, "doc_id long, _key long, words string")
    return held.join(known_labels(labels), "doc_id").groupBy("doc_id", "toxic").agg(F.min_by("words", "_key").alias("words"))


def associations(rows: DataFrame) -> DataFrame:
    """(feature, toxic_n, n): in how many labelled documents each feature stands; of the feature '', all."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, every = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch.column("words"), batch.column("toxic").to_pylist()):
                own = {f for w in text.as_py().split(" ") if w for f in features_of(w)}
                own.add("")
                every.update(own)
                if label:
                    toxic.update(own)
            if len(every) > 500_000:
                yield pa.RecordBatch.from_pydict({"feature": list(every), "toxic_n": [toxic[f] for f in every], "n": list(every.values())})
                toxic, every = Counter(), Counter()
        yield pa.RecordBatch.from_arrays([pa.array(list(every), pa.string()), pa.array([toxic[f] for f in every], pa.int64()),
                                          pa.array(list(every.values()), pa.int64())], names=["feature", "toxic_n", "n"])

    return rows.select("words", "toxic").mapInArrow(count, "feature string, toxic_n long, n long") \
        .groupBy("feature").agg(F.sum("toxic_n").alias("toxic_n"), F.sum("n").alias("n"))


def strongest(counts: DataFrame, texts: int, toxic: int, limit: int, least: int, evidence: float = EVIDENCE) -> list[str]:
    """The features whose presence and the label depend most, by the likelihood ratio."""
    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    a, n = F.col("toxic_n").cast("double"), F.col("n").cast("double")
    rate = toxic / texts
    ratio = part(a, n * rate) + part(n - a, n * (1 - rate)) + part(toxic - a, (texts - n) * rate) + part((texts - toxic) - (n - a), (texts - n) * (1 - rate))
    known = counts.select("feature", "n", (2 * ratio).alias("ratio"))
    top = known.where((F.col("n") >= least) & (F.col("n") < texts) & (F.col("ratio") >= evidence)).orderBy(F.desc("ratio"), "feature").limit(limit)
    return [r[0] for r in top.select("feature").collect()]


@dataclass
class Lists:
    """Lists of feature numbers as flat arrays: ``ids`` and the row of each."""

    rows: np.ndarray
    ids: np.ndarray
    size: int

    @staticmethod
    def of(column: pa.ListArray) -> Lists:
        """The lists of a column without NULLs."""
        lengths = np.diff(column.offsets.to_numpy())
        return Lists(np.repeat(np.arange(len(column), dtype=np.int32), lengths), column.flatten().to_numpy(), len(column))

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, w[self.ids], minlength=self.size)

    def back(self, v: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.ids, v[self.rows], minlength=width)


def fit(y: np.ndarray, own: Lists, left: Lists, right: Lists, width: int, weight: float = WEIGHT,
        ridge: float = RIDGE, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and bias from labels, features, and the features before (``left``) and after (``right``) the
    swap of the texts that name a group."""
    n, pairs = len(y), left.size
    w = v = np.zeros(width)
    base = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    b = c = float(np.log(base / (1 - base)))
    # the inverse of a bound of the curvature: of the logistic part, and of the squared gaps
    step = 1 / ((1 + len(own.ids) / n) / 4 + 2 * weight * (len(left.ids) + len(right.ids)) / n + ridge)
    for k in range(steps):                       # Nesterov's gradient steps
        p = 1 / (1 + np.exp(-np.clip(own.times(v) + c, -40, 40)))
        grad = own.back((p - y) / n, width) + ridge * v
        if pairs:
            gap = (left.times(v) - right.times(v)) * (2 * weight / n)
            grad += left.back(gap, width) - right.back(gap, width)
        w_next, b_next = v - step * grad, c - step * float((p - y).mean())
        pull = k / (k + 3)
        v, c = w_next + pull * (w_next - w), b_next + pull * (b_next - b)
        w, b = w_next, b_next
    return w, b


def learn(texts: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int = FEATURES, least: int = LEAST,
          weight: float = WEIGHT) -> Classifier:
    counts = materialise(associations(labelled_words(texts, labels)).where((F.col("n") >= least) | (F.col("feature") == "")), "associations")
    n, toxic = counts.where("feature = ''").select(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("toxic_n"), F.lit(0))).first()
    if not 0 < toxic < n:
        rate = toxic / n if n else 0.0
        return Classifier({}, np.zeros(0), float(np.log(max(rate, 1e-17) / max(1 - rate, 1e-17))))
    names = strongest(counts.where("feature <> ''"), n, toxic, features, least)
    index = Classifier({f: i for i, f in enumerate(names)}, np.zeros(len(names)), 0.0)

    rows = sampled(texts, labels, sample)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"doc_id": batch.column("doc_id"), "label": [], "own": [], "other": []}
            for text, label in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                found = words(text.as_py() or "")
                swapped = counterfactual(found)
                out["label"].append(float(label))
                out["own"].append(index.ids(found))
                out["other"].append(None if swapped is None else index.ids(swapped))
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([out["doc_id"], pa.array(out["label"], pa.float64()), pa.array(out["own"], kind), pa.array(out["other"], kind)], names=list(out))

    # at most ``sample`` rows of feature numbers; by doc_id, for the same sums whatever the order of the tasks
    got = rows.select("doc_id", "text", "toxic").mapInArrow(encode, "doc_id long, label double, own array<int>, other array<int>").toArrow()
    got = got.sort_by("doc_id").combine_chunks()
    column = {c: got.column(c).chunk(0) for c in ("label", "own", "other")}
    named = column["other"].is_valid()
    weights, bias = fit(column["label"].to_numpy(), Lists.of(column["own"]), Lists.of(column["own"].filter(named)),
                        Lists.of(column["other"].filter(named)), len(names), weight)
    return Classifier(index.index, weights, bias)


def score(docs: DataFrame, model: Classifier) -> DataFrame:
    """``docs`` without text, plus score and predicted."""
    others = [c for c in docs.columns if c != "text"]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = np.array([shared.value.score(x.as_py() or "") for x in batch.column("text")], float)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in others] + [pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=[*others, "score", "predicted"])

    return docs.select(*others, "text").mapInArrow(predict, docs.select(*others).schema.add("score", "double").add("predicted", "integer"))


def held_out_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted), learned from the labels of the other folds."""
    out = fold("doc_id", 5) == 0
    model = learn(docs.where(~out).select("doc_id", "text"), labels.where(~out).select("doc_id", "toxic"))
    return score(docs.select("doc_id", out.alias("held_out"), "text"), model)
