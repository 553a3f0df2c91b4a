"""Language-model scores from a backoff automaton over word bigrams.

The model. Tokens are words and one end per text; p1(w) = (c(w) + 1) / (N + V + 1). After a word h that
training texts hold, p(w | h) = (1 - BACKOFF) * c(h, w) / c(h) + BACKOFF * p1(w), which sums to one over w.
As an automaton: one state per known word, one for the start of a text, and the root. A state has an arc for
every word that follows it in training, with the weight of the whole sum; its failure arc leads to the root
at weight BACKOFF. The root has an arc for every word, and one for all others. A text is read once from left
to right: from the state of the last word, take the arc of the next word if there is one, else the failure
arc and then the root's. With words as states, the state before each token is known from the token to its
left, so a batch of texts is traversed in vector steps rather than one token at a time.

How counts get to the texts. No task and no broadcast ever holds the model.

1. Each task reads its texts in runs of about RUN_BYTES and sends, per run, its distinct words and bigrams
   with their counts in training texts, split by ranges of their hashes. A frequent word costs one number
   per run.
2. The task of a range adds up and answers every run with the counts of what the run asked, in its order.
3. Texts and answers meet per run, and the texts are scored.

Keys travel packed: words as 64-bit hashes; bigrams as the range and 40 bits after it, so that one bigram in
millions may be counted with another. The number of ranges grows with the bytes of text.

Defined results: NULL and empty texts are the end token alone; NULL ids count as training rows; repeated
rows are counted and scored each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataload.llm.hashing import WordHasher, mix, utf8
from strataload.llm.tables import texts
from strataload.session import materialize

BACKOFF = 0.6
RUN_BYTES = 8 << 20
RANGE_BYTES = 8 << 20
FOLD, HELD_OUT = 7, 2
END, START = np.uint64(0xE0D0E0D0E0D0E0D1), np.uint64(0x57A7057A7057A701)

ASKED = "run long, range int, words binary, word_counts binary, pairs binary, pair_counts binary"
ANSWER = "run long, range int, word_counts binary, pair_counts binary, tokens long, distinct long"


def held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLD == HELD_OUT


class Run:
    """The tokens of some texts, one after the other, and their distinct words and bigrams."""

    def __init__(self, hashed: list[np.ndarray]) -> None:
        self.lengths = np.array([len(h) + 1 for h in hashed], dtype=np.int64)
        self.ends = np.cumsum(self.lengths)
        tokens = np.empty(int(self.ends[-1]), dtype=np.uint64)
        before = np.empty_like(tokens)
        at = 0
        for h in hashed:
            tokens[at : at + len(h)], tokens[at + len(h)] = h, END
            before[at], before[at + 1 : at + len(h) + 1] = START, h
            at += len(h) + 1
        self.words, self.word_of = np.unique(tokens, return_inverse=True)
        self.pairs, self.pair_of = np.unique(mix(before) * np.uint64(3) + mix(tokens ^ START), return_inverse=True)

    def training_counts(self, training: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        marks = np.repeat(training, self.lengths)
        return (
            np.bincount(self.word_of[marks], minlength=len(self.words)),
            np.bincount(self.pair_of[marks], minlength=len(self.pairs)),
        )


def ranges_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where each range begins in sorted keys, and the end."""
    width = (1 << 64) // ranges + 1
    return np.searchsorted(keys, np.array([min(i * width, (1 << 64) - 1) for i in range(ranges)], np.uint64)).tolist() + [
        len(keys)
    ]


def shorten(keys: np.ndarray, number: int, ranges: int) -> bytes:
    """The leading 40 bits of keys after the start of their range; their order stays."""
    width = (1 << 64) // ranges + 1
    bits = max(0, (width - 1).bit_length() - 40)
    short = ((keys - np.uint64(number * width)) >> np.uint64(bits)).astype("<u8")
    return np.ascontiguousarray(short.view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def lengthen(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 5, 8), dtype=np.uint8)
    wide[:, :5] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 5)
    return wide.view("<u8").reshape(-1)


def runs_of(batches) -> Iterator[tuple[int, list[int | None], list[bytes]]]:
    """(number, doc ids, texts) of each run of this task's rows; the same whenever the rows are read."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    ids: list[int | None] = []
    bodies: list[bytes] = []
    size = 0
    for batch in batches:
        for doc_id, body in zip(batch.column("doc_id").to_pylist(), utf8(batch.column("text")), strict=True):
            ids.append(doc_id)
            bodies.append(body)
            size += len(body) + 16
            if size >= RUN_BYTES:
                yield number, ids, bodies
                number, ids, bodies, size = number + 1, [], [], 0
    if ids:
        yield number, ids, bodies


def _batch(schema: str, rows: list[tuple]):
    import pyarrow as pa

    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64()}
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else ([] for _ in fields)
    arrays = [pa.array(list(c), kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def _ask(ranges: int):
    def ask(batches) -> Iterator:
        hasher = WordHasher()
        for number, ids, bodies in runs_of(batches):
            run = Run(list(hasher.batch(bodies)))
            words, pairs = run.training_counts(np.array([not held_out(i) for i in ids]))
            w, p = ranges_of(run.words, ranges), ranges_of(run.pairs, ranges)
            rows = [
                (
                    number, k,
                    run.words[w[k] : w[k + 1]].astype("<u8").tobytes(), words[w[k] : w[k + 1]].astype("<u4").tobytes(),
                    shorten(run.pairs[p[k] : p[k + 1]], k, ranges), pairs[p[k] : p[k + 1]].astype("<u4").tobytes(),
                )
                for k in range(ranges)
                if w[k] < w[k + 1] or p[k] < p[k + 1]
            ]
            for at in range(0, len(rows), 200):
                yield _batch(ASKED, rows[at : at + 200])

    return ask


def _totals(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Each list's keys with their sums over all lists, and the sums of the distinct keys."""
    _, which = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.bincount(which, weights=np.concatenate(counts)).astype(np.int64)
    return np.split(sums[which], np.cumsum([len(k) for k in keys])[:-1]), sums


def _answer(table):
    import pyarrow as pa

    runs, number = table.column("run").to_pylist(), table.column("range")[0].as_py()
    words = [np.frombuffer(b, "<u8") for b in table.column("words").to_pylist()]
    pairs = [lengthen(b) for b in table.column("pairs").to_pylist()]
    word_sums, sums = _totals(words, [np.frombuffer(b, "<u4") for b in table.column("word_counts").to_pylist()])
    pair_sums, _ = _totals(pairs, [np.frombuffer(b, "<u4") for b in table.column("pair_counts").to_pylist()])
    rows = [
        (run, number, w.astype("<u8").tobytes(), p.astype("<u4").tobytes(), 0, 0)
        for run, w, p in zip(runs, word_sums, pair_sums, strict=True)
    ]
    rows[0] = (*rows[0][:4], int(sums.sum()), int((sums > 0).sum()))
    return pa.Table.from_batches([_batch(ANSWER, rows)])


def score_texts(
    ids: list[int | None], run: Run, words: np.ndarray, pairs: np.ndarray, tokens: int, distinct: int, starts: int
) -> list[tuple]:
    """Traverse the automaton over the texts of a run, given the counts of its words and bigrams."""
    count, follow = words[run.word_of].astype(np.float64), pairs[run.pair_of].astype(np.float64)
    at = run.ends - run.lengths
    root = (count + 1) / (tokens + distinct + 1)
    context = np.empty_like(count)
    context[1:] = count[:-1]
    context[at] = starts
    arc = (1 - BACKOFF) * follow / np.maximum(context, 1) + BACKOFF * root
    chance = np.where(context > 0, np.where(follow > 0, arc, BACKOFF * root), root)
    base = np.add.reduceat(np.log10(root), at)
    score = np.add.reduceat(np.log10(chance), at)
    known = np.add.reduceat((count > 0).astype(np.int64), at)
    return [
        (i, held_out(i), int(n), int(k), tokens, float(b), float(s))
        for i, n, k, b, s in zip(ids, run.lengths, known, base, score, strict=True)
    ]


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_documents(docs: DataFrame) -> DataFrame:
    """Every document with the log10 probability of its whole text under the base model and the automaton."""
    rows = texts(docs)
    out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLD)) == HELD_OUT
    size, starts = rows.agg(
        F.sum(F.octet_length("text")), F.count(F.when(~F.coalesce(out, F.lit(False)), 1))
    ).first()
    ranges = int((size or 0) // RANGE_BYTES) + 1
    asked = rows.mapInArrow(_ask(ranges), ASKED)
    answers = materialize(asked.groupBy("range").applyInArrow(_answer, ANSWER), "lm-answers")
    tokens, distinct = (v or 0 for v in answers.agg(F.sum("tokens"), F.sum("distinct")).first())

    def numbered(batches) -> Iterator:
        for number, ids, bodies in runs_of(batches):
            for at in range(0, len(ids), 500):
                part = range(at, min(at + 500, len(ids)))
                yield _batch("run long, place long, doc_id long, text binary", [(number, i, ids[i], bodies[i]) for i in part])

    texts_by_run = rows.mapInArrow(numbered, "run long, place long, doc_id long, text binary")

    def score(body, answer):
        import pyarrow as pa

        body, answer = body.sort_by("place"), answer.sort_by("range")
        run = Run(list(WordHasher().batch(body.column("text").to_pylist())))
        words = np.frombuffer(b"".join(answer.column("word_counts").to_pylist()), "<u8")
        pairs = np.frombuffer(b"".join(answer.column("pair_counts").to_pylist()), "<u4")
        if len(words) != len(run.words) or len(pairs) != len(run.pairs):
            raise RuntimeError("the rows of a run changed between two reads of the input")
        scored = score_texts(body.column("doc_id").to_pylist(), run, words, pairs, tokens, distinct, starts)
        return pa.Table.from_batches([_batch(SCORED, scored)])

    by_run = answers.select("run", "range", "word_counts", "pair_counts")
    return texts_by_run.groupBy("run").cogroup(by_run.groupBy("run")).applyInArrow(score, SCORED)
