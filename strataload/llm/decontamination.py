"""Benchmark passages in documents: q-gram lemma, diagonal bands, banded alignment.

Texts are compared as folded bytes: A-Z lower-cased, every run of ASCII punctuation and white space one
space. A passage of n bytes that occurs with at most e = n * EDITS edits keeps T = n - Q + 1 - Q * e of its
q-grams, and all of these lie on diagonals (place in the text minus place in the item) that differ by at
most e.

1. A table of one byte per hash tells which q-grams of the text belong to any item. Per 64 bytes only their
   number is kept. A stretch as long as an item may spread that holds fewer than T of them cannot hold the
   item; nearly all text ends here.
2. In the stretches left, q-grams are looked up exactly, and hits are counted per item in bands of 2(e + 1)
   diagonals that overlap by half, so the diagonals of one occurrence lie whole in some band.
3. Bands with at least T hits are aligned: edit distance of the item to any part of the band's stretch, in a
   matrix as wide as the band.

Documents are scanned once per block of items; no document is shuffled. The items are the stated query set:
a block holds at most BLOCK_BYTES of them, and further blocks are further passes.

Defined results: NULL and empty texts hold nothing; an item shorter than Q folded bytes is too short to be
told from chance and matches nothing; equal items are each reported; repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataload.llm.tables import texts, with_bodies

Q = 8
EDITS = 0.06
CELL = 16
TABLE_BITS = 20
BLOCK_BYTES = 4 << 20
SLICE = 4 << 20  # bytes of text worked on at once

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256))


def fold(data: bytes) -> bytes:
    """Lower case, and one space for each run of separators; none at the ends."""
    return b" ".join(data.translate(_FOLD).split())


def grams(data: np.ndarray) -> np.ndarray:
    """The Q bytes from every place as one number; places that share bytes share memory."""
    if len(data) < Q:
        return np.zeros(0, dtype="<u8")
    return np.ndarray(shape=(len(data) - Q + 1,), dtype="<u8", buffer=data, strides=(1,))


def _slots(g: np.ndarray) -> np.ndarray:
    return (g * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)


def banded_distance(item: bytes, text: bytes, budget: int) -> int | None:
    """The fewest edits that turn ``item`` into some part of ``text``, or None if more than ``budget``."""
    if item in text:
        return 0
    letters = np.frombuffer(text, dtype=np.uint8)
    places = np.arange(len(letters) + 1)
    row = np.zeros(len(letters) + 1, dtype=np.int64)
    for i, letter in enumerate(item, 1):
        new = np.empty_like(row)
        new[0] = i
        np.minimum(row[:-1] + (letters != letter), row[1:] + 1, out=new[1:])
        row = np.minimum.accumulate(new - places) + places
        if row.min() > budget:
            return None
    best = int(row.min())
    return best if best <= budget else None


class ItemIndex:
    """The q-grams of a block of items."""

    def __init__(self, ids: list[int | None], bodies: list[bytes]) -> None:
        kept = [(i, fold(b)) for i, b in zip(ids, bodies, strict=True)]
        kept = [(i, b) for i, b in kept if len(b) >= Q]
        self.ids = [i for i, _ in kept]
        self.items = [b for _, b in kept]
        self.budgets = np.array([int(len(b) * EDITS) for b in self.items], dtype=np.int64)
        lengths = np.array([len(b) for b in self.items], dtype=np.int64)
        self.least = lengths - Q + 1 - Q * self.budgets
        # Occurrence of one length spans at most so many cells; the smallest demand counts for a span.
        spans = (lengths + self.budgets) // CELL + 2
        self.demands = {int(s): int(self.least[spans == s].min()) for s in np.unique(spans)}
        parts = [grams(np.frombuffer(b, dtype=np.uint8)) for b in self.items]
        self.gram = np.concatenate(parts) if parts else np.zeros(0, dtype="<u8")
        self.owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        self.place = np.concatenate([np.arange(len(p)) for p in parts]) if parts else np.zeros(0, dtype=np.int64)
        order = np.argsort(self.gram, kind="stable")
        self.gram, self.owner, self.place = self.gram[order].copy(), self.owner[order], self.place[order]
        self.table = np.zeros(1 << TABLE_BITS, dtype=np.uint8)
        self.table[_slots(self.gram)] = 1

    def dense_places(self, data: np.ndarray) -> np.ndarray:
        """Places of known q-grams in stretches that can hold an item."""
        known = self.table[_slots(grams(data))]
        cells = -(-len(known) // CELL)
        padded = np.zeros(cells * CELL, dtype=np.uint8)
        padded[: len(known)] = known
        counts = padded.reshape(cells, CELL).sum(axis=1, dtype=np.int64)
        sums = np.concatenate(([0], np.cumsum(counts)))
        keep = np.zeros(cells + 1, dtype=np.int64)
        for span, demand in self.demands.items():
            starts = np.arange(cells)
            ends = np.minimum(starts + span, cells)
            good = np.flatnonzero(sums[ends] - sums[starts] >= demand)
            np.add.at(keep, good, 1)
            np.add.at(keep, ends[good], -1)
        if not keep.any():
            return np.zeros(0, dtype=np.int64)
        wanted = np.repeat(np.cumsum(keep[:-1]) > 0, CELL)[: len(known)]
        return np.flatnonzero(wanted & (known > 0))

    def search(self, data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(text, item, edits) of each item found; ``bounds`` are the starts of the texts and the end."""
        places = self.dense_places(data)
        if not len(places):
            return
        wanted = grams(data)[places].copy()
        low, high = np.searchsorted(self.gram, wanted), np.searchsorted(self.gram, wanted, side="right")
        times = high - low
        text_place = np.repeat(places, times)
        index = np.repeat(low - np.concatenate(([0], np.cumsum(times)[:-1])), times) + np.arange(times.sum())
        owner, diagonal = self.owner[index], text_place - self.place[index]
        text = np.searchsorted(bounds, text_place, side="right") - 1
        step = self.budgets[owner] + 1
        # The shift keeps band numbers positive for occurrences that begin before their text.
        band = (diagonal + SLICE) // step
        keys = np.stack([np.tile(text, 2), np.tile(owner, 2), np.concatenate([band, band - 1])])
        order = np.lexsort(keys[::-1])
        keys = keys[:, order]
        first = np.flatnonzero(np.concatenate(([True], (keys[:, 1:] != keys[:, :-1]).any(axis=0))))
        counts = np.diff(np.append(first, keys.shape[1]))
        best: dict[tuple[int, int], int] = {}
        for at in first[counts >= self.least[keys[1, first]]]:
            doc, item, number = (int(x) for x in keys[:, at])
            if best.get((doc, item)) == 0:
                continue
            budget = int(self.budgets[item])
            start = number * (budget + 1) - SLICE
            low_end = max(int(bounds[doc]), start - budget)
            high_end = min(int(bounds[doc + 1]), start + 2 * (budget + 1) + len(self.items[item]) + budget)
            edits = banded_distance(self.items[item], data[low_end:high_end].tobytes(), budget)
            if edits is not None and edits < best.get((doc, item), budget + 1):
                best[doc, item] = edits
        for (doc, item), edits in best.items():
            yield doc, item, edits


def _slices(bodies: list[bytes]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Texts by number, together up to SLICE bytes; a longer text is by itself."""
    numbers, held, size = [], [], 0
    for number, body in enumerate(bodies):
        if held and size + len(body) > SLICE:
            yield numbers, held
            numbers, held, size = [], [], 0
        numbers.append(number)
        held.append(body)
        size += len(body)
    if held:
        yield numbers, held


def _hits(bodies, index: ItemIndex) -> Iterator[tuple[int, int, int]]:
    """(number of the text, item, edits) among the texts of a batch."""
    for numbers, held in _slices([fold(b) for b in bodies]):
        data = np.frombuffer(b"\x00".join([*held, b""]), dtype=np.uint8)
        bounds = np.concatenate(([0], np.cumsum([len(b) + 1 for b in held])))
        for d, i, e in index.search(data, bounds):
            yield numbers[d], i, e


def _find_in(docs: DataFrame, index: ItemIndex) -> DataFrame:
    def run(batches) -> Iterator:
        import pyarrow as pa

        from strataload.llm.hashing import utf8

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            out = [(ids[d], index.ids[i], e) for d, i, e in _hits(utf8(batch.column("text")), index)]
            columns = list(zip(*out, strict=True)) if out else [(), (), ()]
            types = [pa.int64(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "item_id", "edits"]
            )

    return docs.mapInArrow(run, "doc_id long, item_id long, edits int")


def _indexes(benchmark: DataFrame) -> Iterator[ItemIndex]:
    items = texts(benchmark, key="item_id").withColumnRenamed("doc_id", "item_id")
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = int(size // BLOCK_BYTES) + 1
    for number in range(blocks):
        block = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number).collect()
        yield ItemIndex([r["item_id"] for r in block], [r["text"].encode() for r in block])


def find_passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, edits) of every document that holds a benchmark item within its edit budget."""
    rows = texts(docs)
    return reduce(DataFrame.unionByName, (_find_in(rows, index) for index in _indexes(benchmark)))


def _free_of(docs: DataFrame, index: ItemIndex) -> DataFrame:
    def clean(bodies, batch):
        import pyarrow as pa

        keep = np.ones(batch.num_rows, dtype=bool)
        keep[[d for d, _, _ in _hits(bodies, index)]] = False
        return batch.filter(pa.array(keep))

    return with_bodies(docs, clean)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns."""
    return reduce(_free_of, _indexes(benchmark), docs)
