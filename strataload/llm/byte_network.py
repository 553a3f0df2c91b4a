"""Language of texts by a convolutional network over bytes, trained here in numpy.

1. Training rows are drawn by a hash of id and text, about SAMPLE rows in all and as many of every language (all
   rows of a language that has fewer). A drawn row gives one window of its text, at a place drawn by the hash.
   The driver gets SAMPLE windows of WINDOW bytes, whatever the size of the corpus; the languages it learns are
   the LANGUAGES commonest ones.
2. Bytes (A-Z as a-z) become vectors of DEPTH numbers. Filters of each width in WIDTHS run over a window, the
   largest answer of each filter is kept (max pooling), and a linear layer with softmax gives a probability per
   language. All widths share one matrix: a narrow filter has zeros where a wide one goes on. Training is Adam on
   the cross entropy, from a fixed seed.
3. A text of any length is cut into windows side by side, the last one padded with zero bytes. Many windows of
   many texts make one matrix product. A language's score is the mean of its probabilities over the windows,
   each by its number of bytes; the largest wins, of equal ones the first in alphabetical order.

The texts stay in the JVM; a batch of texts goes to Python and a batch of answers comes back. No shuffle of texts.

Defined results: a NULL text or one without a letter is ``und`` with score 0; so is every text when no row can be
learned from. Rows without a language are not learned from. Rows and all other columns stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW, WIDTHS, FILTERS, DEPTH = 128, (2, 3, 4), 16, 6
SAMPLE, LANGUAGES = 8192, 256
STEPS, BATCH, RATE, SEED = 700, 128, 0.01, 11
ROWS = 1024  # windows in one matrix product
UNDETERMINED = "und"
ANSWER = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_WIDEST = max(WIDTHS)


def _reach() -> np.ndarray:
    """1 where a filter has a weight, 0 beyond its width."""
    mask = np.zeros((_WIDEST * DEPTH, len(WIDTHS) * FILTERS), dtype=np.float32)
    for i, width in enumerate(WIDTHS):
        mask[: width * DEPTH, i * FILTERS : (i + 1) * FILTERS] = 1
    return mask


@dataclass
class ByteNetwork:
    languages: list[str]
    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, languages: list[str], seed: int = SEED) -> ByteNetwork:
        draw = np.random.default_rng(seed)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (draw.standard_normal(shape) * scale).astype(np.float32)

        mask = _reach()
        weights = {
            "embedding": normal(256, DEPTH, scale=0.5),
            "filters": normal(*mask.shape, scale=0.3) * mask,
            "bias": np.zeros(mask.shape[1], dtype=np.float32),
            "output": normal(mask.shape[1], len(languages), scale=0.1),
            "offset": np.zeros(len(languages), dtype=np.float32),
        }
        return cls(languages, weights)

    def _patches(self, windows: np.ndarray) -> np.ndarray:
        """(windows, places, widest * DEPTH): the vectors of the bytes from each place on."""
        padded = np.pad(windows, ((0, 0), (0, _WIDEST - 1)))
        vectors = self.weights["embedding"][padded]
        seen = np.lib.stride_tricks.sliding_window_view(vectors, _WIDEST, axis=1)
        return np.ascontiguousarray(seen.transpose(0, 1, 3, 2)).reshape(len(windows), -1, _WIDEST * DEPTH)

    def _logits(self, pooled: np.ndarray) -> np.ndarray:
        kept = np.maximum(pooled + self.weights["bias"], 0)
        return kept @ self.weights["output"] + self.weights["offset"]

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """A row per window of bytes, a column per language."""
        answers = self._patches(windows) @ self.weights["filters"]
        return softmax(self._logits(answers.max(axis=1)))

    def gradients(self, windows: np.ndarray, wanted: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy of a batch, and its slope by every weight."""
        rows = np.arange(len(windows))
        patches = self._patches(windows)
        answers = patches @ self.weights["filters"]
        place = answers.argmax(axis=1)
        pooled = np.take_along_axis(answers, place[:, None, :], axis=1)[:, 0, :]
        kept = np.maximum(pooled + self.weights["bias"], 0)
        p = softmax(self._logits(pooled))
        loss = float(-np.log(np.maximum(p[rows, wanted], 1e-12)).mean())
        slope = p.copy()
        slope[rows, wanted] -= 1
        slope /= len(rows)
        back = (slope @ self.weights["output"].T) * (kept > 0)
        # Only the place that won a filter's pooling passes a slope on.
        winners = patches[rows[:, None], place]
        to_patches = back[:, :, None] * self.weights["filters"].T[None]
        padded = np.pad(windows, ((0, 0), (0, _WIDEST - 1)))
        at = padded[rows[:, None, None], place[:, :, None] + np.arange(_WIDEST)]
        embedding = np.zeros_like(self.weights["embedding"])
        np.add.at(embedding, at.ravel(), to_patches.reshape(-1, DEPTH))
        return loss, {
            "embedding": embedding,
            "filters": np.einsum("bn,bnk->kn", back, winners) * _reach(),
            "bias": back.sum(axis=0),
            "output": kept.T @ slope,
            "offset": slope.sum(axis=0),
        }


def softmax(values: np.ndarray) -> np.ndarray:
    raised = np.exp(values - values.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def fit(languages: list[str], windows: np.ndarray, wanted: np.ndarray, steps: int = STEPS) -> ByteNetwork:
    """A network trained on windows of bytes and the numbers of their languages."""
    network = ByteNetwork.fresh(languages)
    draw = np.random.default_rng(SEED)
    mean = {name: np.zeros_like(w) for name, w in network.weights.items()}
    square = {name: np.zeros_like(w) for name, w in network.weights.items()}
    for step in range(1, steps + 1):
        some = draw.integers(0, len(windows), BATCH)
        _, slopes = network.gradients(windows[some], wanted[some])
        rate = RATE * (1 - (step - 1) / steps)
        for name, slope in slopes.items():
            mean[name] += 0.1 * (slope - mean[name])
            square[name] += 0.001 * (slope * slope - square[name])
            ahead = mean[name] / (1 - 0.9**step)
            network.weights[name] -= rate * ahead / (np.sqrt(square[name] / (1 - 0.999**step)) + 1e-8)
    return network


def cut_windows(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of all texts side by side, the number of the text each is from, and its number of bytes."""
    lengths = np.fromiter(map(len, bodies), dtype=np.int64, count=len(bodies))
    counts = -(-lengths // WINDOW)
    owner = np.repeat(np.arange(len(bodies)), counts)
    padded = b"".join(body.translate(_FOLD).ljust(n * WINDOW, b"\0") for body, n in zip(bodies, counts.tolist(), strict=True))
    within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    sizes = np.minimum(WINDOW, lengths[owner] - within * WINDOW)
    return np.frombuffer(padded, dtype=np.uint8).reshape(-1, WINDOW), owner, sizes


def score_texts(network: ByteNetwork, bodies: list[bytes]) -> np.ndarray:
    """Mean probabilities of each non-empty text, a row per text."""
    total = np.zeros((len(bodies), len(network.languages)))
    windows, owner, sizes = cut_windows(bodies)
    for begin in range(0, len(windows), ROWS):
        some = slice(begin, begin + ROWS)
        np.add.at(total, owner[some], network.probabilities(windows[some]) * sizes[some, None])
    return total / np.maximum([[len(b)] for b in bodies], 1)


def learned_from(key: Column) -> Column:
    """The rows a network may learn from; a NULL id counts as an empty one."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 4 != 2


def train_network(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> ByteNetwork | None:
    """A network for the languages of ``docs``; None if no row has both text and language."""
    rows = docs.select(
        F.col(f"`{lang}`").cast("string").alias("lang"),
        F.col(f"`{text}`").cast("binary").alias("body"),
        F.xxhash64(F.lit(SEED), F.col(f"`{key}`"), F.col(f"`{text}`")).alias("draw"),
    ).where((F.octet_length("body") > 0) & F.col("lang").isNotNull())
    # Counting needs the two narrow columns and the length; there are at most LANGUAGES rows of it.
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    if not counts:
        return None
    each = SAMPLE / len(counts)
    share = F.lit(0.0)
    for row in counts:
        share = F.when(F.col("lang") == row["lang"], min(1.0, each / row["count"])).otherwise(share)
    unit = (F.col("draw").bitwiseAND(F.lit((1 << 30) - 1))) / float(1 << 30)
    last = F.greatest(F.octet_length("body") - WINDOW, F.lit(0)) + 1
    place = F.pmod(F.shiftrightunsigned("draw", 33), last) + 1
    drawn = (
        rows.where(unit < share)
        .select("lang", "draw", F.substring("body", place.cast("int"), F.lit(WINDOW)).alias("body"))
        .orderBy("draw", "lang", "body")
        .limit(2 * SAMPLE)
        .collect()
    )
    if not drawn:
        return None
    languages = sorted({row["lang"] for row in drawn})
    number = {name: i for i, name in enumerate(languages)}
    windows, _, _ = cut_windows([bytes(row["body"]) for row in drawn])
    return fit(languages, windows, np.array([number[row["lang"]] for row in drawn]))


def identify_language(docs: DataFrame, network: ByteNetwork | None, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score; columns of these names are replaced."""
    carried = [c for c in docs.columns if c not in ANSWER.names]
    inner = docs.select(
        *[F.col(f"`{c}`").alias(f"_in_{i}") for i, c in enumerate(carried)], F.col(f"`{text}`").alias("_text")
    )
    unknown = F.struct(F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    if network is None:
        answered = inner.withColumn("_answer", unknown)
    else:

        def answer(bodies):
            import pyarrow as pa

            best: list[str | None] = []
            scores: list[float] = []
            # Some texts at a time bound the memory of a batch.
            for begin in range(0, len(bodies), 200):
                some = [b or b"" for b in bodies[begin : begin + 200].to_pylist()]
                found = score_texts(network, some)
                best += [network.languages[i] for i in found.argmax(axis=1)]
                scores += np.clip(found.max(axis=1), 0, 1).tolist()
            return pa.StructArray.from_arrays([pa.array(best, pa.string()), pa.array(scores, pa.float64())], ANSWER.names)

        answered = inner.withColumn("_found", F.arrow_udf(answer, ANSWER)(F.col("_text").cast("binary")))
        lettered = F.coalesce(F.col("_text").rlike(r"\p{L}"), F.lit(False))
        answered = answered.withColumn("_answer", F.when(lettered, F.col("_found")).otherwise(unknown))
    return answered.select(
        *[F.col(f"_in_{i}").alias(c) for i, c in enumerate(carried)],
        F.col("_answer.lang_pred").alias("lang_pred"),
        F.col("_answer.score").alias("score"),
    )


def predict_languages(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of all documents, by a network trained on those not held out."""
    learned = learned_from(F.col("doc_id"))
    network = train_network(docs.where(learned))
    bare = docs.select("doc_id", "text", (~learned).alias("held_out"))
    return identify_language(bare, network).select("doc_id", "held_out", "lang_pred", "score")
