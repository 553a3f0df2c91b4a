"""Fill-in-the-middle rewriting of documents, with token counts remembered per content-defined chunk.

A document is cut into tokens: a word with the white space before it, and white space at the end as one more.
Two places among the tokens, drawn from a hash of the id, cut it into prefix, middle and suffix, which are put
in another order behind markers.

1. A rolling hash over WINDOW bytes ends a chunk wherever its top bits are all set, so a passage that many
   documents share is cut into the same chunks wherever it stands. Chunks have MIN_CHUNK bytes at least; a text
   beyond PIECE bytes is also cut after each PIECE.
2. Each distinct chunk is summarised once: how many words it has, whether it starts and ends inside a word, and
   how many code points it holds. A store of the worker process keeps the summaries under the content itself,
   so equal hashes of different chunks cannot be confused. It holds KEPT bytes and then starts anew: this bounds
   memory and changes no result.
3. Summaries add up: a word that runs over a chunk's end is counted where it ends. Running sums over the chunks
   of a document give its number of tokens, and a search in them finds the chunk that holds a cut. Only that
   chunk is read again.

The text stays in the JVM; the function only sends back places, in bytes and in code points.

Defined results: NULL and empty texts have no tokens and stay plain; a NULL id draws as an empty id; rows with
one id draw alike, each over its own text; the number of rows and all other columns stay. A text that holds a
marker stays plain, so a rewritten text can always be put back.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataload.llm.hashing import PIECE, mix

MARKERS = ("<P>", "<S>", "<M>")
SEED, RATE, SUFFIX_FIRST = 42, 50, 80
WINDOW, CHUNK_BITS, MIN_CHUNK = 24, 10, 256
KEPT = 48 << 20
CUTS = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("first_cut", T.IntegerType()),
        T.StructField("second_cut", T.IntegerType()),
        T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()),
    ]
)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_STARTS_POINT = (np.arange(256) & 0xC0) != 0x80
_ROLL = mix(np.arange(1, 257, dtype=np.uint64))
_BASE = 0x9E3779B97F4A7C15 | 1


def _chunk_ends(raw: np.ndarray) -> np.ndarray:
    """Places after which the rolling hash of the last WINDOW bytes has its top bits set."""
    n = len(raw) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    # One multiply and add per byte of the window, over all places at once.
    values = _ROLL[raw]
    hashes = values[:n].copy()
    for i in range(1, WINDOW):
        hashes *= np.uint64(_BASE)
        hashes += values[i : i + n]
    return np.flatnonzero(hashes >> np.uint64(64 - CHUNK_BITS) == (1 << CHUNK_BITS) - 1) + WINDOW


def chunks(text: bytes) -> list[bytes]:
    """The content-defined chunks of a text, in order; they add up to it."""
    out = []
    for begin in range(0, len(text), PIECE):
        piece = text[begin : begin + PIECE]
        ends = _chunk_ends(np.frombuffer(piece, dtype=np.uint8)).tolist()
        at = 0
        while at < len(piece):
            place = bisect_left(ends, at + MIN_CHUNK)
            end = ends[place] if place < len(ends) else len(piece)
            out.append(piece[at:end])
            at = end
    return out


def word_ends(raw: np.ndarray, open_end: bool) -> np.ndarray:
    """Places where the words of a chunk end; the last one only if the next chunk does not go on with it."""
    word = ~_SPACE[raw]
    ends = np.flatnonzero(word[:-1] & ~word[1:]) + 1
    return np.append(ends, len(raw)) if len(raw) and word[-1] and not open_end else ends


@dataclass
class Summary:
    """Arrays over chunks: word ends inside, whether first and last byte belong to a word, code points."""

    inner: np.ndarray
    head: np.ndarray
    tail: np.ndarray
    points: np.ndarray


def summarise(parts: list[bytes]) -> Summary:
    """Summaries of non-empty chunks, all at once."""
    raw = np.frombuffer(b"".join(parts), dtype=np.uint8)
    lengths = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    starts = np.cumsum(lengths) - lengths
    word = ~_SPACE[raw]
    ends = np.zeros(len(raw), dtype=np.int64)
    ends[:-1] = word[:-1] & ~word[1:]
    last = starts + lengths - 1
    ends[last] = 0
    return Summary(
        np.add.reduceat(ends, starts), word[starts], word[last], np.add.reduceat(_STARTS_POINT[raw].astype(np.int64), starts)
    )


class SummaryStore:
    """Summaries by content, for at most KEPT bytes of chunks."""

    def __init__(self, kept: int = KEPT) -> None:
        self.kept = kept
        self._clear()

    def _clear(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.rows = np.zeros((0, 4), dtype=np.int64)
        self.size = 0

    def summaries(self, parts: list[bytes]) -> Summary:
        if self.size > self.kept:
            self._clear()
        missing: dict[bytes, int] = {}
        known = self.numbers
        for part in parts:
            if part not in known and part not in missing:
                missing[part] = len(known) + len(missing)
        if missing:
            new = summarise(list(missing))
            rows = np.stack((new.inner, new.head, new.tail, new.points), axis=1).astype(np.int64)
            self.rows = np.concatenate((self.rows, rows))
            known.update(missing)
            # A few words of overhead per chunk count as well.
            self.size += sum(map(len, missing)) + 200 * len(missing)
        rows = self.rows[[known[part] for part in parts]]
        return Summary(rows[:, 0], rows[:, 1].astype(bool), rows[:, 2].astype(bool), rows[:, 3])


_STORE = SummaryStore()


def _locate(parts: list[bytes], open_end: np.ndarray, ends: np.ndarray, points: np.ndarray, k: int) -> tuple[int, int]:
    """(bytes, code points) up to the end of the k-th word (from 1) of a text, from running sums over its chunks."""
    chunk = int(np.searchsorted(ends, k))
    inside = k - (int(ends[chunk - 1]) if chunk else 0)
    raw = np.frombuffer(parts[chunk], dtype=np.uint8)
    end = int(word_ends(raw, bool(open_end[chunk]))[inside - 1])
    size = sum(map(len, parts[:chunk])) + end
    return size, (int(points[chunk - 1]) if chunk else 0) + int(np.count_nonzero(_STARTS_POINT[raw[:end]]))


def cut_texts(bodies: list[bytes], draws: list[tuple[int, int]], store: SummaryStore = _STORE) -> list[tuple[int, ...]]:
    """(tokens, first cut, second cut, prefix points, middle points) of each text, cuts in bytes."""
    per_text = [chunks(body) for body in bodies]
    everything = [part for parts in per_text for part in parts]
    if not everything:
        return [(0, 0, 0, 0, 0)] * len(bodies)
    found = store.summaries(everything)
    out, at = [], 0
    for parts, (h1, h2) in zip(per_text, draws, strict=True):
        if not parts:
            out.append((0, 0, 0, 0, 0))
            continue
        here = slice(at, at + len(parts))
        at += len(parts)
        head, tail = found.head[here], found.tail[here]
        open_end = np.append(tail[:-1] & head[1:], False)
        ends = np.cumsum(found.inner[here] + (tail & ~open_end))
        points = np.cumsum(found.points[here])
        words, whole = int(ends[-1]), (sum(map(len, parts)), int(points[-1]))
        n = words + (not tail[-1])
        places = []
        for k in sorted((h1 % (n + 1), h2 % (n + 1))):
            if k == 0:
                places.append((0, 0))
            else:
                places.append(whole if k > words else _locate(parts, open_end, ends, points, k))
        (first, prefix), (second, both) = places
        out.append((n, first, second, prefix, both - prefix))
    return out


@F.arrow_udf(CUTS)
def _cuts(text, h1, h2):
    import pyarrow as pa

    rows: list[tuple[int, ...]] = []
    # Some texts at a time bound the memory of a batch.
    for begin in range(0, len(text), 500):
        some = slice(begin, begin + 500)
        draws = list(zip(h1[some].to_pylist(), h2[some].to_pylist(), strict=True))
        rows += cut_texts(text[some].to_pylist(), draws)
    columns = list(zip(*rows, strict=True)) or [()] * 5
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], CUTS.names)


def _draw(digest: Column, place: int) -> Column:
    return F.conv(F.substring(digest, 8 * place + 1, 8), 16, 10).cast("long")


def infill(
    docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST
) -> DataFrame:
    """``docs`` with n, form, prefix_chars, middle_chars and output; columns of these names are replaced.

    ``rate`` per cent of the documents are rewritten, ``suffix_first`` per cent of those with the suffix first
    (form ``spm``), the others with the prefix first (``psm``).
    """
    added = ["n", "form", "prefix_chars", "middle_chars", "output"]
    carried = [c for c in docs.columns if c not in added]
    inner = docs.select(
        *[F.col(f"`{c}`").alias(f"_in_{i}") for i, c in enumerate(carried)],
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"),
        F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))), 256).alias("_hash"),
    )
    inner = inner.withColumns({f"_h{i + 1}": _draw(F.col("_hash"), i) for i in range(4)})
    marked = F.lit(False)
    for marker in MARKERS:
        marked |= F.contains("_text", F.lit(marker))
    plain = (F.col("_text") == "") | (F.col("_h3") % 100 >= rate) | marked
    form = F.when(plain, "plain").when(F.col("_h4") % 100 < suffix_first, "spm").otherwise("psm")
    cut = inner.withColumns({"_cut": _cuts(F.col("_text").cast("binary"), "_h1", "_h2"), "_form": form})
    raw, first, second = F.col("_text").cast("binary"), F.col("_cut.first_cut"), F.col("_cut.second_cut")
    prefix = F.substring(raw, F.lit(1), first)
    middle = F.substring(raw, first + 1, second - first)
    suffix = F.substring(raw, second + 1, F.octet_length("_text") - second)
    p, s, m = (F.lit(marker).cast("binary") for marker in MARKERS)
    output = (
        F.when(F.col("_form") == "plain", F.col("_text"))
        .when(F.col("_form") == "psm", F.concat(p, prefix, s, suffix, m, middle).cast("string"))
        .otherwise(F.concat(s, suffix, p, prefix, m, middle).cast("string"))
    )
    rewritten = F.col("_form") != "plain"
    return cut.select(
        *[F.col(f"_in_{i}").alias(c) for i, c in enumerate(carried)],
        F.col("_cut.n").alias("n"),
        F.col("_form").alias("form"),
        F.when(rewritten, F.col("_cut.prefix_chars")).alias("prefix_chars"),
        F.when(rewritten, F.col("_cut.middle_chars")).alias("middle_chars"),
        output.alias("output"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text as it was, from a rewritten text and its form."""
    parts = F.split(output, "<[PSM]>", -1)
    psm = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))
    spm = F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
