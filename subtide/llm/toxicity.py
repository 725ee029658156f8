"""Toxicity by a support vector machine over a gap-tolerant string kernel.

A unit (a word, or a run of single letters) is the bag of its subsequences of three
characters within a window of five, each weighted by DECAY to the power of its span, so an
inserted character only weakens a match. The kernel of two units is the cosine of their
bags. Landmark units span a Nyström space in which a linear machine is trained. A sentence
is as toxic as its worst unit, a document as its worst sentence.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtide.llm.pieces import PieceIndex, text_slices
from subtide.llm.scratch import store

DECAY = 0.5
OFFSETS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))  # of the second and third character
UNIT_CHARS = 24
SINGLES = 4  # single characters in a row that make a unit
NOTHING = -2.0  # the margin of a text without units
#: Bounds of the training sample and of the model.
TOXIC_DOCUMENTS, CLEAN_DOCUMENTS = 4000, 8000
POSITIVES, NEGATIVES, LANDMARKS = 600, 2000, 256
#: Of the machine: penalty, and weight of all positive units against all negative ones. As
#: a document takes its worst unit, a wrong negative unit costs more.
RIDGE, POSITIVE_WEIGHT = 0.01, 0.05
HARD_ROUNDS = 3
EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~¡¿«»“”„’‘…"
NOT_LETTERS = re.compile(r"[\W\d_]+")


def units_of(token: str) -> list[str]:
    """A token without outer punctuation, and its letters alone; a long one in windows."""
    word = token.strip(EDGES)
    letters = NOT_LETTERS.sub("", word)
    found = [word, letters] if letters and letters != word else [word]
    return [u[a: a + UNIT_CHARS] for u in found if u for a in range(0, max(1, len(u) - UNIT_CHARS // 2), UNIT_CHARS // 2)]


def bags(units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, features and weights of the units' bags, each of length one; a feature is three
    characters of 21 bits. Units are marked at both ends."""
    marked = ["\x02" + u + "\x03" for u in units]
    sizes = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
    width = int(sizes.max(initial=0)) + 4
    grid = np.zeros((len(marked), width), dtype=np.int64)
    grid[np.arange(width) < sizes[:, None]] = np.frombuffer("".join(marked).encode("utf-32-le"), dtype="<u4")
    codes, weights = [], []
    for a, b in OFFSETS:
        n = width - 4
        third = grid[:, b: b + n]
        codes.append(np.where(third > 0, (grid[:, :n] << 42) | (grid[:, a: a + n] << 21) | third, 0))
        weights.append(np.full(n, DECAY ** (b + 1)))
    code, weight = np.concatenate(codes, axis=1), np.concatenate(weights)
    order = np.argsort(code, axis=1)
    code, weight = np.take_along_axis(code, order, axis=1), weight[order]
    first = np.ones(code.shape, dtype=bool)
    first[:, 1:] = code[:, 1:] != code[:, :-1]
    starts = np.flatnonzero(first)
    summed = np.add.reduceat(weight.ravel(), starts)
    row, feature = starts // code.shape[1], code.ravel()[starts]
    real = feature > 0
    row, feature, summed = row[real], feature[real], summed[real]
    norm = np.sqrt(np.bincount(row, summed**2, minlength=len(units)))
    return row, feature, summed / norm[row]


@dataclass
class Model:
    """features (sorted) and their weights give a unit's margin; slope and level turn a
    document's margin into a probability."""

    features: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    level: float = 0.0

    def margins(self, units: list[str]) -> np.ndarray:
        if not units:
            return np.empty(0)
        row, feature, weight = bags(units)
        at = np.minimum(np.searchsorted(self.features, feature), len(self.features) - 1)
        known = self.features[at] == feature
        return np.bincount(row[known], weight[known] * self.weights[at[known]], minlength=len(units)) + self.bias

    def probability(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.level, -700, 700)))


class Scorer:
    """Margins of documents; a worker computes each token's once."""

    def __init__(self, model: Model, limit: int = 400_000):
        self.model, self.limit = model, limit
        self.clear()

    def clear(self) -> None:
        self.index = PieceIndex()
        self.margin, self.single = np.empty(0), np.empty(0, dtype=bool)

    def _learn(self) -> None:
        new, self.index.new = self.index.new, []
        for a in range(0, len(new), 8192):
            part = new[a: a + 8192]
            units = [units_of(t) for t in part]
            sizes = np.fromiter(map(len, units), dtype=np.int64, count=len(units))
            margins = self.model.margins([u for x in units for u in x])
            worst = np.full(len(part), NOTHING)
            np.maximum.at(worst, np.repeat(np.arange(len(part)), sizes), margins)
            self.margin = np.concatenate([self.margin, worst])
            self.single = np.concatenate([self.single, [len(t.strip(EDGES)) == 1 for t in part]])

    def documents(self, texts: list[str | None]) -> np.ndarray:
        if len(self.index) > self.limit:
            self.clear()
        out = np.full(len(texts), NOTHING)
        for i, text in enumerate(texts):
            tokens = text.lower().split() if text else []
            if not tokens:
                continue
            at = np.fromiter(map(self.index.__getitem__, tokens), dtype=np.int64, count=len(tokens))
            if self.index.new:
                self._learn()
            worst = self.margin[at].max()
            single = np.flatnonzero(self.single[at])
            if len(single) >= SINGLES:
                runs = np.split(single, np.flatnonzero(np.diff(single) > 1) + 1)
                joined = ["".join(tokens[k].strip(EDGES) for k in run) for run in runs if len(run) >= SINGLES]
                units = [u for j in joined for u in units_of(j)]
                worst = max([worst, *self.model.margins(units)])
            out[i] = worst
        return out


def held_out(key: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 3 == 1


def _unit_counts(sample: DataFrame) -> DataFrame:
    """unit, toxic, clean: in how many different surroundings (the words beside it) it is
    seen in toxic and in clean documents. Copies of a document share them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            seen: set[tuple[str, int, int]] = set()
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                tokens = ["", *text.lower().split(), ""] if text else []
                for before, token, after in zip(tokens, tokens[1:], tokens[2:]):
                    around = xxhash.xxh64_intdigest(f"{before} {after}") >> 1
                    seen.update((u, toxic, around) for u in units_of(token))
            units, toxic, around = zip(*seen) if seen else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(units, pa.string()), pa.array(toxic, pa.int32()), pa.array(around, pa.int64())], names=["unit", "toxic", "around"])

    rows = sample.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(run, "unit string, toxic int, around long")
    return rows.distinct().groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))


def _similarities(units: list[str], features: np.ndarray, space: np.ndarray) -> np.ndarray:
    """Cosines of the units' bags with the landmarks'; space: [feature, landmark]."""
    out = np.zeros((len(units), space.shape[1]))
    row, feature, weight = bags(units)
    at = np.minimum(np.searchsorted(features, feature), len(features) - 1)
    known = np.flatnonzero(features[at] == feature)
    if len(known):
        row = row[known]
        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        out[row[first]] = np.add.reduceat(weight[known, None] * space[at[known]], first, axis=0)
    return out


def _train_units(positive: list[str], trust: np.ndarray, negative: list[str], landmarks: int) -> Model:
    """Squared-hinge machine in the Nyström space of the landmarks, by Newton steps. The
    landmarks are the first positive and negative units."""
    inserted = [u[:k] + mark + u[k:] for u in positive[: landmarks] for k in range(1, len(u)) for mark in ".x"]
    units = [*positive, *inserted, *negative]
    target = np.concatenate([np.ones(len(positive) + len(inserted)), -np.ones(len(negative))])
    weight = np.concatenate([trust, np.full(len(inserted), 0.2), np.ones(len(negative))])
    weight[target > 0] *= POSITIVE_WEIGHT * len(negative) / weight[target > 0].sum()
    marks = [*positive[: landmarks // 2], *negative[: landmarks - len(positive[: landmarks // 2])]]
    row, feature, value = bags(marks)
    features, column = np.unique(feature, return_inverse=True)
    space = np.zeros((len(features), len(marks)))
    space[column, row] = value
    roots, vectors = np.linalg.eigh(space.T @ space)
    kept = roots > 1e-6
    inverse_root = vectors[:, kept] / np.sqrt(roots[kept])
    near = np.concatenate([_similarities(units[a: a + 512], features, space) for a in range(0, len(units), 512)])
    x = np.column_stack([near @ inverse_root, np.ones(len(units))])
    ridge = np.diag([*np.full(x.shape[1] - 1, RIDGE), 1e-8])
    w, active = np.zeros(x.shape[1]), np.ones(len(units), dtype=bool)
    for _ in range(30):
        scaled = x[active] * weight[active, None]
        w = np.linalg.solve(scaled.T @ x[active] + ridge, scaled.T @ target[active])
        now = target * (x @ w) < 1
        if (now == active).all():
            break
        active = now
    return Model(features, space @ (inverse_root @ w[:-1]), float(w[-1]))


def _calibrate(model: Model, margins: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> None:
    """Logistic regression of the labels on the margins, smoothed so that it stays finite."""
    n1, n0 = toxic.sum(), (1 - toxic).sum()
    target = np.where(toxic > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.column_stack([margins, np.ones(len(margins))])
    theta = np.array([1.0, 0.0])

    def loss(t: np.ndarray) -> float:
        z = x @ t
        return float((weight * (np.logaddexp(0, z) - target * z)).sum() + 5e-4 * t[0] ** 2)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -700, 700)))
        slope = x.T @ (weight * (p - target)) + [1e-3 * theta[0], 0]
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag([1e-3, 1e-6])
        step, size = np.linalg.solve(curve, slope), 1.0
        while size > 1e-4 and loss(theta - size * step) > loss(theta):
            size /= 2
        theta = theta - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    model.slope, model.level = float(theta[0]), float(theta[1])


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", toxic_documents: int = TOXIC_DOCUMENTS,
    clean_documents: int = CLEAN_DOCUMENTS, positives: int = POSITIVES, negatives: int = NEGATIVES, landmarks: int = LANDMARKS,
) -> Model | None:
    """A model from at most so many toxic and clean labelled documents that are not held
    out; None if either kind is missing. Rows with a null label or id teach nothing."""
    known = labels.select(F.col(key).alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))
    ).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    shares = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(shares) < 2:
        return None
    drawn = [known.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for y, n in ((1, toxic_documents), (0, clean_documents))]
    # bounded by the two limits
    sample = store(
        docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(drawn[0].unionByName(drawn[1])), "doc_id").select("text", "toxic"),
        "toxicity-sample",
    )
    counts = store(_unit_counts(sample), "toxicity-units")
    totals = counts.agg(F.count("*").alias("units"), F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).first()
    if not totals.toxic or not totals.clean:
        return None
    share = totals.toxic / (totals.toxic + totals.clean)
    n, p = F.col("toxic") + F.col("clean"), F.col("toxic") / (F.col("toxic") + F.col("clean"))
    evidence = F.col("toxic") * F.log(F.greatest(p, F.lit(1e-9)) / share) + F.col("clean") * F.log(F.greatest(1 - p, F.lit(1e-9)) / (1 - share))
    judged = counts.filter(F.length("unit") > 1)
    top = judged.filter((p > 0.9) & (F.col("toxic") > 1)).orderBy(evidence.desc(), "unit").limit(positives).select("unit", evidence.alias("evidence")).collect()
    if not top:
        return None
    positive = [r.unit for r in top]
    trust = np.clip([r.evidence / np.log(totals.units + 2) for r in top], 0, 1) ** 4
    sure = max(1, int((trust > 0.06).sum()))  # weaker ones are chance: there are many units
    positive, trust = positive[:sure], trust[:sure]
    plain = judged.filter((p < 0.9) & (F.col("clean") > 0))
    negative = [r.unit for r in plain.orderBy(n.desc(), "unit").limit(negatives).collect()]
    model = _train_units(positive, trust, negative, landmarks)

    for _ in range(HARD_ROUNDS):  # clean units that the machine comes near to calling toxic
        def judge(batches: Iterator[pa.RecordBatch], model: Model = model) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                units = batch.column("unit")
                for a in range(0, len(units), 4096):
                    part = units.slice(a, 4096)
                    yield pa.RecordBatch.from_arrays([part, pa.array(model.margins(part.to_pylist()))], names=["unit", "margin"])

        hard = plain.select("unit").mapInArrow(judge, "unit string, margin double").orderBy(F.desc("margin"), "unit").limit(negatives).collect()
        negative = list(dict.fromkeys([*(r.unit for r in hard), *negative]))  # the hardest first
        model = _train_units(positive, trust, negative, landmarks)
    rows = margins(sample, model, "toxic").collect()  # of the bounded sample
    toxic = np.array([r.toxic for r in rows], dtype=float)
    each = np.where(toxic > 0, shares[1] / max(1, toxic.sum()), shares[0] / max(1, (1 - toxic).sum()))
    _calibrate(model, np.array([r.margin for r in rows]), toxic, each)
    return model


def margins(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, margin for each row of docs; nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the landmarks
    kind, scorers = dict(docs.dtypes)[key], {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorers.setdefault(0, Scorer(shared.value))
        for batch in text_slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(scorer.documents(batch.column("text").to_pylist()))], names=[key, "margin"])

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"`{key}` {kind}, margin double")


def score(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text", threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs. Null, empty and blank texts
    have the least margin; without a model every score is 0."""
    if model is None:
        rows = docs.select(F.col(key).alias("doc_id"), F.lit(0.0).alias("score"))
    else:
        z = F.col("margin") * model.slope + model.level
        rows = margins(docs, model, key, text).select(F.col(key).alias("doc_id"), (1 / (1 + F.exp(-z))).alias("score"))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Model | None, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of docs, with their columns, whose score is below the threshold. Null, empty
    and blank texts have the least margin and stay; without a model all rows do; repeated
    rows are each judged; very long texts are read whole; an empty table gives no row."""
    if model is None:
        return docs
    shared, scorers = docs.sparkSession.sparkContext.broadcast(model), {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorers.setdefault(0, Scorer(shared.value))
        for batch in text_slices(batches, text):
            found = scorer.model.probability(scorer.documents(batch.column(text).to_pylist()))
            yield batch.filter(pa.array(found < threshold))

    return docs.mapInArrow(run, docs.schema)
