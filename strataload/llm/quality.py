"""Quality scores: random Fourier features over document statistics, ridge regression, isotonic calibration.

1. Each text gives a fixed vector of statistics (lengths, character classes, repetition).
2. Over the labelled training rows, statistics are standardised, and D random cosines approximate a Gaussian
   kernel on them. Weights and phases come from a fixed seed: every machine draws the same.
3. Each partition of labelled rows sums its part of the normal equations. Sums of D x D numbers are added up
   on the executors, by row of the matrix, and the driver solves one ridge system of fixed size.
4. Scores of the labelled rows, counted in BINS bins per label, give a monotone step function by pooling
   adjacent violators; between its steps the score is interpolated.

Labels, language, source and id are no inputs of a score. The number of labelled rows is not limited: only
their sums reach the driver.

Defined results: NULL and empty texts get the score of their statistics (all zero), like any other text; a
training set without both labels gives every text the score 1 or 0 of the label it has, and 1 without any.
Of conflicting labels of one document the larger counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataload.llm.tables import texts, with_bodies
from strataload.session import materialize

FEATURES = 128
GAMMA = 0.15
RIDGE = 1e-3
BINS = 2000
SEED = 7
THRESHOLD = 0.3
ROWS = 500  # worked on at once; a batch of Spark's has 10,000

STATISTICS = [
    "log_bytes", "log_words", "word_bytes", "upper", "digits", "spaces", "points", "marks", "bars", "other",
    "high", "distinct", "top_word", "long_words", "marked_words", "upper_words", "lines", "distinct_lines",
]
_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digits": b"0123456789",
    "spaces": b" \t\n\r\x0b\x0c",
    "points": b".,;:'\"()-?",
    "marks": b"!#$%&*@^~+=_",
    "bars": b"|<>[]{}\\/",
}
_CLASS = np.full(256, 6, dtype=np.uint8)  # letters
_CLASS[128:] = 7
_CLASS[:32] = 8
for _number, _members in enumerate(_CLASSES.values()):
    _CLASS[list(_members)] = _number


def statistics(text: bytes) -> list[float]:
    """The numbers of STATISTICS for one text."""
    n = len(text)
    if not n:
        return [0.0] * len(STATISTICS)
    counts = np.bincount(_CLASS[np.frombuffer(text, dtype=np.uint8)], minlength=9) / n
    words = text.split()
    m = len(words) or 1
    tally: dict[bytes, int] = {}
    for w in words:
        tally[w] = tally.get(w, 0) + 1
    lines = text.split(b"\n")
    sizes = [len(w) for w in tally]
    marked = sum(k for w, k in tally.items() if w[-1] in b"!#$%&*|" or w[0] in b"!#$%&*|")
    upper = sum(k for w, k in tally.items() if len(w) > 1 and w.isupper())
    return [
        np.log1p(n) / 10,
        np.log1p(len(words)) / 8,
        min(n / m, 40) / 10,
        *(float(counts[i]) for i in range(6)),
        float(counts[8]),
        float(counts[7]),
        len(tally) / m,
        max(tally.values(), default=0) / m,
        sum(s > 12 for s in sizes) / (len(sizes) or 1),
        marked / m,
        upper / m,
        np.log1p(len(lines)) / 8,
        len(set(lines)) / len(lines),
    ]


def _portions(batches) -> Iterator:
    """The rows of Arrow batches, a few at a time: a worker then holds the texts and matrices of ROWS rows only."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def with_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, stats) per document."""

    def run(batches) -> Iterator:
        import pyarrow as pa

        from strataload.llm.hashing import utf8

        for batch in _portions(batches):
            rows = [statistics(t) for t in utf8(batch.column("text"))]
            stats = pa.array(rows, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), stats], ["doc_id", "stats"])

    return texts(docs).mapInArrow(run, "doc_id long, stats array<double>")


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of the cosines, one column each
    phases: np.ndarray
    ridge: np.ndarray
    steps: np.ndarray  # raw scores
    levels: np.ndarray  # calibrated scores at the steps

    def cosines(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -6, 6)
        wave = np.sqrt(2 / len(self.phases)) * np.cos(z @ self.weights + self.phases)
        return np.hstack([np.ones((len(z), 1)), z, wave])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.cosines(stats) @ self.ridge

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.steps, self.levels), 0.0, 1.0)


def isotonic(positives: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Non-decreasing shares closest to positives / totals, weighted by totals, by pooling violators."""
    pools: list[list[float]] = []
    for p, t in zip(positives.tolist(), totals.tolist(), strict=True):
        pools.append([p, t, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            p2, t2, n2 = pools.pop()
            pools[-1] = [pools[-1][0] + p2, pools[-1][1] + t2, pools[-1][2] + n2]
    return np.array([p / t for p, t, n in pools for _ in range(n)])


def _stack(batch) -> np.ndarray:
    """The list column of an Arrow batch as a matrix."""
    return np.array(batch.column("stats").flatten(), dtype=np.float64).reshape(batch.num_rows, len(STATISTICS))


def fit(labelled: DataFrame) -> Model:
    """A model of ``labelled`` (stats, label 0 or 1)."""
    k = len(STATISTICS)
    one = [F.col("stats")[i] for i in range(k)]
    sums = labelled.agg(
        F.count("*"), F.sum("label"), *(F.avg(c) for c in one), *(F.stddev_pop(c) for c in one)
    ).first()
    rows, good = sums[0] or 0, sums[1] or 0
    mean = np.array([v or 0.0 for v in sums[2 : 2 + k]])
    scale = np.array([v if v and v > 1e-9 else 1.0 for v in sums[2 + k :]])
    draw = np.random.default_rng(SEED)
    weights = draw.normal(scale=np.sqrt(2 * GAMMA), size=(k, FEATURES))
    phases = draw.uniform(0, 2 * np.pi, FEATURES)
    width = 1 + k + FEATURES
    model = Model(mean, scale, weights, phases, np.zeros(width), np.array([0.0]), np.array([1.0]))
    if good in (0, rows):
        model.levels = np.array([1.0 if good == rows else 0.0])
        return model

    def equations(batches) -> Iterator:
        import pyarrow as pa

        total = np.zeros((width, width + 1))
        for batch in _portions(batches):
            x = model.cosines(_stack(batch))
            y = np.array(batch.column("label"), dtype=np.float64)
            total += x.T @ np.hstack([x, y[:, None]])
        lines = pa.array(total.tolist(), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), lines], ["i", "line"])

    parts = labelled.mapInArrow(equations, "i int, line array<double>")
    added = parts.groupBy("i").agg(*(F.sum(F.col("line")[j]).alias(f"c{j}") for j in range(width + 1)))
    table = np.array([list(r)[1:] for r in sorted(added.collect(), key=lambda r: r["i"])])
    penalty = RIDGE * rows * np.eye(width)
    penalty[0, 0] = 0
    model.ridge = np.linalg.solve(table[:, :width] + penalty, table[:, width])

    def scores(batches) -> Iterator:
        import pyarrow as pa

        for batch in _portions(batches):
            raw = np.clip(model.raw(_stack(batch)), -0.5, 1.5)
            yield pa.RecordBatch.from_arrays([pa.array(raw), batch.column("label")], ["raw", "label"])

    counted = (
        labelled.mapInArrow(scores, "raw double, label int")
        .groupBy(F.floor((F.col("raw") + 0.5) / 2 * BINS).alias("bin"))
        .agg(F.avg("raw").alias("raw"), F.sum("label").alias("good"), F.count("*").alias("n"))
    )
    bins = sorted(counted.collect(), key=lambda r: r["bin"])
    model.steps = np.array([r["raw"] for r in bins])
    model.levels = isotonic(np.array([r["good"] for r in bins], float), np.array([r["n"] for r in bins], float))
    return model


def in_training() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 0


def train(stats: DataFrame, labels: DataFrame) -> Model:
    given = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("label"))
    given = given.filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull())
    # Repeated labels of one document count once; its repeated rows count as often as they occur.
    given = given.filter(in_training()).groupBy("doc_id").agg(F.max("label").alias("label"))
    return fit(materialize(stats.join(given, "doc_id").select("stats", "label"), "quality-training"))


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document as (doc_id, held_out, score, predicted)."""
    stats = materialize(with_statistics(docs), "quality-statistics")
    model = train(stats, labels)

    def run(batches) -> Iterator:
        import pyarrow as pa

        for batch in _portions(batches):
            score = model.score(_stack(batch))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    scored = stats.mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        F.coalesce(~in_training(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def drop_low_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is not rejected, with all their columns."""
    model = train(with_statistics(docs), labels)

    def passed(bodies, batch):
        import pyarrow as pa

        stats = np.array([statistics(t) for t in bodies], dtype=float).reshape(-1, len(STATISTICS))
        score = [model.score(stats[at : at + ROWS]) for at in range(0, len(stats), ROWS)]
        return batch.filter(pa.array(np.concatenate(score) >= THRESHOLD if score else [], pa.bool_()))

    return with_bodies(docs, passed)
