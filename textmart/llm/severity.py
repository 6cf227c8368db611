"""Severity of toxic text by cumulative-link ordinal regression.

P(grade <= j) = sigmoid(threshold_j - w.x): one weight vector for all thresholds,
which are kept in order. x holds log(1 + DENSITY * count / words) of the words and word
beginnings of a text, for the features that tell toxic from clean texts in the labelled
sample; shares of windows of WINDOW words, so that long clean texts don't add up to toxic ones. A text's windows
overlap by half and cover it all (a shorter one counts as WINDOW words), and the one of highest score gives the text's grade,
so that clean words around a toxic passage don't hide it. The model is fitted on whole
texts first, then REFITS times on the window of highest score of each text.
The expected severity is the sum over j of P(grade > j).

The labels say toxic or not. Grades 1..GRADES of toxic texts are the parts of equal
size of their order by how many marked words they hold (features that are MARKED times
as common in toxic as in clean texts). A column of grades, where there is one, is used
instead.

The model is fitted on the driver from a bounded sample of labelled rows: of each of
the two classes the SAMPLE rows whose id hashes lowest. Scoring covers all rows.

Defined cases: a null or empty text has no features and gets the severity of the
intercepts alone, which is clean. Labels that are null or without a document are
ignored; of a repeated label id the highest grade counts. Without labels of both
classes nothing is rejected (severity 0). Rows are kept as they are, repeated ones
too; columns with the names of the result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmart.llm.common import arrow_texts, ascii_words, by_value, gathered, written

SAMPLE = 2000
GRADES = 3
DENSITY = 500.0
MARKED = 8.0
PREFIX = 5
WINDOW, REFITS = 200, 2
# P(grade > 0) from which a text is rejected.
REJECT = 0.5
# Chi-square beyond chance among 100,000 features, and the least number of sample texts with the feature.
LEAST_CHI2, LEAST_DF = 20.0, 3
PUNCTUATION = ".,;:!?\"'()[]{}<>*#$%&|-_"


def word_features(word: str) -> list[int]:
    from xxhash import xxh3_64_intdigest

    bare = word.strip(PUNCTUATION) or word
    out = [xxh3_64_intdigest(bare)]
    if len(bare) > PREFIX:
        out.append(xxh3_64_intdigest("<" + bare[:PREFIX]))
    return out


def text_features(texts: pa.Array, wanted: np.ndarray | None = None, window: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Each text's distinct features (or their places in sorted `wanted`), counts and values.

    With a window: those of each window of so many words, overlapping by half, in a list for each text.
    """
    index, vocabulary, first = ascii_words(texts)
    of_word = [word_features(w) for w in vocabulary.to_pylist()]
    flat = np.array([f for fs in of_word for f in fs], np.uint64)
    sizes = np.array([len(fs) for fs in of_word], np.int64)
    if wanted is not None:
        at = np.searchsorted(wanted, flat)
        at[at == len(wanted)] = 0
        known = wanted[at] == flat if len(wanted) else np.zeros(len(flat), bool)
        sizes = np.add.reduceat(known.astype(np.int64), np.cumsum(sizes) - sizes) if len(sizes) else sizes
        flat = at[known]
    starts = np.cumsum(sizes) - sizes

    def of(low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        words = index[low:high]
        words = words[sizes[words] > 0]
        n = sizes[words]
        place = np.repeat(starts[words], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        found, counts = np.unique(flat[place], return_counts=True)
        return found, counts, np.log1p(DENSITY * counts / max(high - low, window or 1))

    for low, high in zip(first, first[1:]):
        if window is None:
            yield of(low, high)
        else:
            step = window // 2
            yield [of(x, min(x + window, high)) for x in range(low, max(high - step, low + 1), step)]


def worst_window(windows: list[tuple[np.ndarray, np.ndarray, np.ndarray]], weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """The highest score of a text's windows, with that window's features and values."""
    scores = [float(weights[at] @ x) for at, _, x in windows]
    best = int(np.argmax(scores))
    return scores[best], windows[best][0], windows[best][2]


@dataclass
class Severity:
    """Sorted features, their weights, and the thresholds in order."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > j) for each score and threshold j."""
        with np.errstate(over="ignore"):  # an overflow is a probability of 0
            return 1.0 / (1.0 + np.exp(self.thresholds[None, :] - score[:, None]))


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, grades: np.ndarray, n_features: int, l2: float = 1e-4, rounds: int = 400, step: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds of highest penalised likelihood, by Adam on the whole sample."""
    n, levels = len(grades), int(grades.max())
    # thresholds = first + running sums of exp(gap), so that they stay in order
    parameters = np.concatenate([np.zeros(n_features), [1.0], np.zeros(levels - 1)])
    m, v = np.zeros_like(parameters), np.zeros_like(parameters)
    each = np.arange(n)
    for t in range(1, rounds + 1):
        w, first, gaps = parameters[:n_features], parameters[n_features], np.exp(parameters[n_features + 1 :])
        cuts = np.concatenate([[-np.inf], first + np.concatenate([[0.0], np.cumsum(gaps)]), [np.inf]])
        score = np.bincount(rows, values * w[cols], minlength=n)
        high = 1 / (1 + np.exp(-np.clip(cuts[grades + 1] - score, -500, 500)))
        low = 1 / (1 + np.exp(-np.clip(cuts[grades] - score, -500, 500)))
        p = np.maximum(high - low, 1e-12)
        d_high, d_low = high * (1 - high) / p, low * (1 - low) / p
        d_score = (d_high - d_low) / n  # of the negative log likelihood
        gradient = np.empty_like(parameters)
        gradient[:n_features] = np.bincount(cols, values * d_score[rows], minlength=n_features) + l2 * w
        d_cut = np.zeros(levels + 2)
        np.add.at(d_cut, grades[each] + 1, -d_high / n)
        np.add.at(d_cut, grades[each], d_low / n)
        inner = d_cut[1:-1]
        gradient[n_features] = inner.sum()
        gradient[n_features + 1 :] = np.cumsum(inner[::-1])[::-1][1:] * gaps
        m = 0.9 * m + 0.1 * gradient
        v = 0.999 * v + 0.001 * gradient**2
        parameters -= step * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    gaps = np.exp(parameters[n_features + 1 :])
    return parameters[:n_features], parameters[n_features] + np.concatenate([[0.0], np.cumsum(gaps)])


def fit_severity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", toxic: str = "toxic", grade: str | None = None, sample: int = SAMPLE) -> Severity:
    """The model of the labelled sample."""
    nothing = Severity(np.zeros(0, np.uint64), np.zeros(0), np.array([np.inf]))
    known = labels.select(F.col(key).alias("_key"), F.col(grade or toxic).cast("int").alias("_grade")).dropna()
    known = known.groupBy("_key").agg(F.max("_grade").alias("_grade")).where(F.col("_grade") >= 0)
    order = [F.xxhash64("_key"), F.col("_key")]
    low = known.where("_grade = 0").orderBy(*order).limit(sample)
    high = known.where("_grade > 0").orderBy(*order).limit(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in gathered(batches, "_text"):
            found = list(text_features(arrow_texts(table.column("_text"))))
            yield pa.RecordBatch.from_arrays([
                table.column("_key").combine_chunks(), table.column("_grade").combine_chunks(),
                *[pa.array([x.tobytes() for x in xs], pa.binary()) for xs in ([f for f, _, _ in found], [c.astype(np.uint32) for _, c, _ in found], [v.astype(np.float32) for _, _, v in found])],
            ], names=["_key", "_grade", "features", "counts", "values"])

    picked = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(F.broadcast(low.unionAll(high)), "_key")
    kind = docs.schema[key].dataType.simpleString()
    picked = written(picked.select("_key", "_text", "_grade"), "labelled")
    read = picked.mapInArrow(by_value(run), f"_key {kind}, _grade int, features binary, counts binary, values binary").collect()
    read = sorted({r["_key"]: r for r in read}.values(), key=lambda r: r["_key"])  # a repeated document counts once
    grades = np.array([r["_grade"] for r in read], np.int64)
    if not len(grades) or grades.max() == 0 or grades.min() > 0:
        return nothing
    features, cols = np.unique(np.concatenate([np.frombuffer(r["features"], np.uint64) for r in read]), return_inverse=True)
    counts = np.concatenate([np.frombuffer(r["counts"], np.uint32) for r in read]).astype(np.float64)
    values = np.concatenate([np.frombuffer(r["values"], np.float32) for r in read]).astype(np.float64)
    rows = np.repeat(np.arange(len(read)), [len(r["features"]) // 8 for r in read])
    bad = grades > 0
    n_bad, n_good = bad.sum(), (~bad).sum()
    in_bad = np.bincount(cols, bad[rows], minlength=len(features))
    in_good = np.bincount(cols, ~bad[rows], minlength=len(features))
    both, n = in_bad + in_good, n_bad + n_good
    cross = in_bad * (n_good - in_good) - in_good * (n_bad - in_bad)
    chi2 = n * cross**2 / np.maximum(n_bad * n_good * both * (n - both), 1)
    used = (both >= LEAST_DF) & (chi2 >= LEAST_CHI2)
    if not used.any():
        return nothing
    if grade is None:
        marked = used & ((in_bad + 0.5) / n_bad > MARKED * (in_good + 0.5) / n_good)
        hits = np.bincount(rows, counts * marked[cols], minlength=len(read))[bad]
        place = np.argsort(np.argsort(hits, kind="stable"), kind="stable")
        grades[bad] = 1 + place * GRADES // max(len(place), 1)
        grades = np.unique(grades, return_inverse=True)[1]
    place = np.cumsum(used) - 1
    keep = used[cols]
    weights, thresholds = fit_ordinal(rows[keep], place[cols[keep]], values[keep], grades, int(used.sum()))
    model = Severity(features[used], weights, thresholds)
    grade_of = {r["_key"]: g for r, g in zip(read, grades)}
    for _ in range(REFITS):
        model = refitted(picked, model, grade_of)
    return model


def refitted(picked: DataFrame, model: Severity, grade_of: dict) -> Severity:
    """The model fitted anew on the window of highest score of each text."""
    kind = picked.schema["_key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in gathered(batches, "_text"):
            worst = [worst_window(ws, model.weights) for ws in text_features(arrow_texts(table.column("_text")), model.features, WINDOW)]
            columns = [[at.astype(np.uint32).tobytes() for _, at, _ in worst], [x.astype(np.float32).tobytes() for _, _, x in worst]]
            yield pa.RecordBatch.from_arrays([table.column("_key").combine_chunks(), *[pa.array(c, pa.binary()) for c in columns]], names=["_key", "at", "values"])

    read = picked.select("_key", "_text").mapInArrow(by_value(run), f"_key {kind}, at binary, values binary").collect()
    read = sorted({r["_key"]: r for r in read}.values(), key=lambda r: r["_key"])
    cols = np.concatenate([np.frombuffer(r["at"], np.uint32) for r in read]).astype(np.int64)
    values = np.concatenate([np.frombuffer(r["values"], np.float32) for r in read]).astype(np.float64)
    rows = np.repeat(np.arange(len(read)), [len(r["at"]) // 4 for r in read])
    weights, thresholds = fit_ordinal(rows, cols, values, np.array([grade_of[r["_key"]] for r in read]), len(model.features))
    return Severity(model.features, weights, thresholds)


def score_severity(docs: DataFrame, model: Severity, text: str = "text", severity: str = "severity", p_toxic: str = "p_toxic", grade: str = "grade") -> DataFrame:
    """The rows with expected severity, P(grade > 0) and the most probable grade. No shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most the sample's features
    added = [T.StructField(severity, T.DoubleType()), T.StructField(p_toxic, T.DoubleType()), T.StructField(grade, T.IntegerType())]
    kept = [f for f in docs.schema.fields if f.name not in (severity, p_toxic, grade)]
    schema = T.StructType(kept + added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = sent.value
        for table in gathered(batches, text):
            scores = [worst_window(ws, mine.weights)[0] for ws in text_features(arrow_texts(table.column(text)), mine.features, WINDOW)]
            above = mine.above(np.array(scores))
            exactly = -np.diff(np.column_stack([np.ones(len(above)), above, np.zeros(len(above))]), axis=1)
            out = [table.column(f.name).combine_chunks() for f in kept]
            out += [pa.array(above.sum(axis=1)), pa.array(above[:, 0]), pa.array(exactly.argmax(axis=1).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return docs.mapInArrow(by_value(run), schema)
