"""Token ids in compressed blocks with random access.

Documents are sorted by id across the cluster. Each task encodes its range and writes blocks of about
BLOCK_TOKENS ids. A block holds a Re-Pair grammar: frequent neighbours (a, b) become a new symbol, round by
round, each round replacing all pairs at or above a threshold that falls to a quarter, until no pair occurs
MIN_PAIR times. Where two pairs overlap the more frequent one is replaced. End ids never join a pair, so a
document is a run of symbols; the block stores where each run begins, the rules, and how many ids every
symbol stands for. One document is decoded from its run alone.

Blocks are rows of a Parquet table: a lost task is written again by another executor, and readers only see
committed files. All numbers are little-endian.

  magic "RPG1", uint32: documents, rules, symbols, first new symbol
  int64 doc id and uint8 null flag per document, uint32 run start and uint32 id count per document
  uint32 left and right per rule, uint32 ids per rule, uint32 symbols

Every distinct piece (a word with the space before it, and the like) is encoded once by the library, and the texts
are put together from the pieces. Texts longer than GROUP, or with the name of a special token, are encoded whole.

Defined results: NULL and empty texts are the end id alone; NULL ids sort first; rows with equal ids are
ordered by text.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataload.llm.hashing import _powers, mix
from strataload.llm.tables import texts
from strataload.session import materialize

BLOCK_TOKENS = 1 << 20
MIN_PAIR = 24
BINS = 20
KEPT = 1_000_000  # pieces remembered by a worker: some 50 MB
SLOTS = 1 << 22  # of the table that finds them, well above the pieces of KEPT and of one group
GROUP = 1 << 21  # characters encoded at once
LETTER, NUMBER, OTHER, SPACE, UNKNOWN = range(5)
END = np.uint32(0xFFFFFFFF)
_MIXED = mix(np.arange(1, (1 << 16) + 1, dtype=np.uint64))
MAGIC = b"RPG1"
BLOCKS = "shard int, block int, n_tokens long, payload binary"


class _Hasher:
    """A polynomial hash of every piece from running sums over its code points, in 64 bits or 32."""

    def __init__(self, base: int, kind: type = np.uint64) -> None:
        self.base, self.kind = base | 1, kind
        self._grow(1)

    def _grow(self, n: int) -> None:
        self.up = _powers(self.base, n).astype(self.kind)
        self.down = _powers(pow(self.base, -1, 1 << 64), n).astype(self.kind)

    def __call__(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(self.up) < len(values):
            self._grow(len(values))
        sums = np.zeros(len(values) + 1, dtype=self.kind)
        products = values.astype(self.kind)
        products *= self.up[: len(values)]
        np.cumsum(products, out=sums[1:], dtype=self.kind)
        return (sums[ends] - sums[starts]) * self.down[starts]


class PieceEncoder:
    """Ids of whole texts from the library's ids of their pieces, which it remembers.

    The tokenizer first splits a text into pieces: a word, a number or a run of other characters, each with a space
    before it, the endings after an apostrophe, and white space. That depends on the kinds of neighbouring characters
    alone, so it is done in numpy for a group of texts; of what kind a character is, the library is asked once. Pieces
    are hashed and looked up in a table with open addressing; each distinct one that is not there goes to the library
    once. A second hash, of 32 bits, stands for the content: where it disagrees with the first, the group's texts are encoded whole.
    Pieces are forgotten once there are more than KEPT.
    """

    def __init__(self, path: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.split = self.library.pre_tokenizer.pre_tokenize_str
        # Text that holds a special token's name is encoded whole, and so is every text if the split is another one.
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        probe = [piece for piece, _ in self.split("a b1 ?'s  x")]
        self.by_pieces = (
            self.library.normalizer is None
            and isinstance(self.library.pre_tokenizer, ByteLevel)
            and probe == ["a", "Ġb", "1", "Ġ?'", "s", "Ġ", "Ġx"]
        )
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        spelling = {**{b: chr(b) for b in printable}, **{b: chr(256 + i) for i, b in enumerate(others)}}
        self.letters = "".join(spelling[b] for b in range(256))
        self.kinds = np.full(0x110000, UNKNOWN, dtype=np.uint8)
        self.hashers = _Hasher(0x9E3779B97F4A7C15), _Hasher(0xC2B2AE3D27D4EB4F, np.uint32)
        self._forget()

    def _forget(self) -> None:
        self.table = np.full(SLOTS, -1, dtype=np.int32)
        self.hashes, self.proofs = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint32)
        self.starts = self.lengths = np.zeros(0, dtype=np.int64)
        self.flat = np.zeros(0, dtype=np.int32)

    def _kinds_of(self, points: np.ndarray) -> np.ndarray:
        found = np.take(self.kinds, points)
        unknown = points[found == UNKNOWN]
        if not len(unknown):
            return found
        for point in np.unique(unknown).tolist():
            kind = SPACE
            for with_, name in (("a", LETTER), ("1", NUMBER), ("!", OTHER)):
                if len(self.split(with_ + chr(point))) == 1:
                    kind = name
            self.kinds[point] = kind
        return np.take(self.kinds, points)

    def piece_starts(self, points: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Where the pieces of texts start that stand one behind the other; ``first`` marks the texts' starts."""
        kind = self._kinds_of(points)
        edge = first.copy()
        edge[1:] |= kind[1:] != kind[:-1]
        white = kind == SPACE
        words = np.flatnonzero(~white[1:] & white[:-1] & ~first[1:]) + 1
        # The last white character goes with what follows if it is a space, and is a piece of its own otherwise.
        edge[words - 1] = True
        edge[words[points[words - 1] == 32]] = False
        # After an apostrophe that starts a piece: 's 't 'm 'd 're 've 'll
        n = len(points)
        quotes = np.flatnonzero((points == 39) & edge)
        after = np.append(points, [0, 0, 0])
        foreign = np.append(first, [True, True, True])
        one, two = after[quotes + 1], after[quotes + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        pairs = [(ord(a), ord(b)) for a, b in ("re", "ve", "ll")]
        long_ = np.logical_or.reduce([(one == a) & (two == b) for a, b in pairs]) & ~foreign[quotes + 2]
        for where, size in ((short, 2), (long_, 3)):
            at = quotes[where & ~foreign[quotes + 1]]
            edge[at + 1] = False
            ends = at + size
            edge[ends[ends < n]] = True
        return np.flatnonzero(edge)

    def _learn(self, hashes: np.ndarray, proofs: np.ndarray, pieces: list[str]) -> None:
        # The library spells bytes as letters; all pieces are spelt at once, with a byte between them that few hold.
        spelt = "\0".join(pieces).encode().decode("latin-1").translate(self.letters).split(self.letters[0])
        if len(spelt) != len(pieces):
            spelt = [piece.encode().decode("latin-1").translate(self.letters) for piece in pieces]
        tokenize = self.model.tokenize
        found: list[int] = []
        sizes: list[int] = []
        for piece in spelt:
            tokens = tokenize(piece)
            sizes.append(len(tokens))
            found += [token.id for token in tokens]
        lengths, flat = np.array(sizes, dtype=np.int64), np.array(found, dtype=np.int32)
        number = np.arange(len(self.hashes), len(self.hashes) + len(hashes), dtype=np.int32)
        self.hashes = np.concatenate((self.hashes, hashes))
        self.proofs = np.concatenate((self.proofs, proofs))
        self.starts = np.concatenate((self.starts, len(self.flat) + np.cumsum(lengths) - lengths))
        self.lengths = np.concatenate((self.lengths, lengths))
        self.flat = np.concatenate((self.flat, flat))
        slot = (hashes & np.uint64(SLOTS - 1)).astype(np.int64)
        while len(number):
            free = self.table[slot] < 0
            self.table[slot[free]] = number[free]
            # Of several that meet in a free slot one has it; the others go on to the next.
            left = self.table[slot] != number
            number, slot = number[left], (slot[left] + 1) & (SLOTS - 1)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """The numbers of the pieces remembered, -1 for others."""
        slot = (hashes & np.uint64(SLOTS - 1)).astype(np.int64)
        number = np.take(self.table, slot)
        if not len(self.hashes):
            return number
        open_ = np.flatnonzero((number >= 0) & (np.take(self.hashes, number, mode="clip") != hashes))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (SLOTS - 1)
            number[open_] = self.table[slot[open_]]
            open_ = open_[(number[open_] >= 0) & (np.take(self.hashes, number[open_], mode="clip") != hashes[open_])]
        return number

    def _whole(self, body: str, end: int) -> np.ndarray:
        return np.array([*self.library.encode(body, add_special_tokens=False).ids, end], dtype=np.int32)

    def _together(self, bodies: list[str], end: int) -> list[np.ndarray]:
        """The ids of each text of a group."""
        joined = "".join(bodies)
        points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).astype(np.intp)
        sizes = np.fromiter(map(len, bodies), dtype=np.int64, count=len(bodies))
        text_ends = np.cumsum(sizes)
        first = np.zeros(len(points), dtype=bool)
        first[(text_ends - sizes)[sizes > 0]] = True
        starts = self.piece_starts(points, first)
        ends = np.append(starts[1:], len(points)) if len(starts) else starts
        if int(points.max(initial=0)) < len(_MIXED):
            values = np.take(_MIXED, points)
        else:
            values = mix(points.astype(np.uint64) + np.uint64(1))
        hashes, proofs = (hasher(values, starts, ends) for hasher in self.hashers)
        hashes = mix(hashes)
        if len(self.hashes) > KEPT:
            self._forget()
        number = self._find(hashes)
        missing = np.flatnonzero(number < 0)
        if len(missing):
            kinds, sample, kind = np.unique(hashes[missing], return_index=True, return_inverse=True)
            number[missing] = len(self.hashes) + kind
            where = missing[sample]
            pieces = [joined[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)]
            self._learn(kinds, proofs[where], pieces)
        if (self.proofs[number] != proofs).any():
            return [self._whole(body, end) for body in bodies]
        lengths = self.lengths[number]
        ids = self.flat[spread(self.starts[number], lengths)]
        until = np.concatenate(([0], np.cumsum(lengths)))[np.searchsorted(starts, text_ends)]
        return np.split(np.insert(ids, until, end), (until + np.arange(1, len(until) + 1))[:-1])

    def encode(self, bodies: list[str], end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids with the end ids, and the number of ids of each text."""
        parts: dict[int, np.ndarray] = {}
        group: list[int] = []
        size = 0

        def finish() -> None:
            parts.update(zip(group, self._together([bodies[i] for i in group], end), strict=True))
            group.clear()

        for i, body in enumerate(bodies):
            if not self.by_pieces or len(body) > GROUP or any(name in body for name in self.special):
                parts[i] = self._whole(body, end)
                continue
            group.append(i)
            size += len(body)
            if size > GROUP:
                finish()
                size = 0
        if group:
            finish()
        ordered = [parts[i] for i in range(len(bodies))]
        counts = np.fromiter(map(len, ordered), dtype=np.int64, count=len(ordered))
        return np.concatenate(ordered) if ordered else np.zeros(0, dtype=np.int32), counts


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each of ``lengths`` numbers, one run after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def _slots(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The bin in which a pair is counted; pairs with an end share one that stays empty."""
    mixed = left * np.uint32(0x9E3779B1) + right * np.uint32(0x85EBCA77)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0xC2B2AE3D)
    out = (mixed >> np.uint32(32 - BINS)).astype(np.intp)
    out[(left == END) | (right == END)] = 1 << BINS
    return out


def _chosen(places: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which places are replaced: of neighbours the one of the higher rank, in a run of one pair every second."""
    beside = places[1:] == places[:-1] + 1
    index = np.arange(len(places))
    run = np.append(False, beside & (rank[1:] == rank[:-1]) & (rank[1:] > 0))
    rank = np.where((index - np.maximum.accumulate(np.where(run, 0, index))) & 1, 0, rank)
    before = np.append(0, np.where(beside, rank[:-1], 0))
    after = np.append(np.where(beside, rank[1:], 0), 0)
    return (rank > 0) & (rank > before) & (rank >= after)


@dataclass
class _Round:
    """What one round did: the places replaced, the pairs that became symbols, and places that are left over."""

    at: np.ndarray
    pairs: np.ndarray
    left_over: np.ndarray


def _replace(seq: np.ndarray, places: np.ndarray, threshold: int, symbol: int) -> _Round | None:
    """Name the pairs that stand at ``threshold`` or more of the places; names are written to their left halves."""
    pairs = (seq[places].astype(np.uint64) << np.uint64(32)) | seq[places + 1]
    found, inverse, times = np.unique(pairs, return_inverse=True, return_counts=True)
    good = times >= threshold
    if not good.any():
        return None
    # Rank by number of places, then by pair: a total order decides between overlapping places.
    rank = np.zeros(len(found), dtype=np.int64)
    rank[np.lexsort((found, times))] = np.arange(1, len(found) + 1)
    rank = np.where(good, rank, 0)[inverse]
    mine = _chosen(places, rank)
    at = places[mine]
    seq[at] = (np.cumsum(good) - 1 + symbol)[inverse[mine]]
    return _Round(at, found[good], places[(rank > 0) & ~mine])


def _new_pairs(at: np.ndarray, n: int) -> np.ndarray:
    """Places of the pairs that the replaced places now make with their neighbours, among ``n`` symbols, ascending."""
    new = at - np.arange(len(at))
    near = np.empty(2 * len(new), dtype=np.int64)
    near[0::2], near[1::2] = new - 1, new
    return near[(near >= 0) & (near < n - 1) & np.append(True, near[1:] != near[:-1])]


def grammar(ids: np.ndarray, last: np.ndarray, first_new: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, left, right) of ids; ``last`` marks the end ids, which stay.

    Pairs are counted once, in bins; each round takes the pairs beside a replaced place out of their bins and puts the
    new ones in. Bins only choose which places are looked at: their pairs are counted exactly. Once the threshold has
    reached its end, the places left over and the new pairs are all that can still qualify, because a pair of older
    symbols never gains a place.
    """
    seq = ids.astype(np.uint32)
    seq[last] = END
    rules: list[np.ndarray] = []
    symbol = first_new
    slots = _slots(seq[:-1], seq[1:])
    counts = np.bincount(slots, minlength=(1 << BINS) + 1)
    counts[-1] = 0
    threshold = max(int(counts.max(initial=0)) // 4, MIN_PAIR)
    places = np.zeros(0, dtype=np.int64)
    while len(seq) > 1:
        places = np.flatnonzero(np.take(counts >= threshold, slots))
        if threshold == MIN_PAIR:
            break
        done = _replace(seq, places, threshold, symbol)
        if done is not None:
            at = done.at
            # The pairs at, before and after a place; two places can share the one between them.
            behind = at + 1
            behind = behind[np.append(behind[:-1] != at[1:] - 1, True)]
            near = np.concatenate((at - 1, at, behind))
            np.subtract.at(counts, slots[near[(near >= 0) & (near < len(slots))]], 1)
            keep = np.ones(len(seq), dtype=bool)
            keep[at + 1] = False
            seq = seq[keep]
            slots = slots[keep[:-1]][: len(seq) - 1]
            near = _new_pairs(at, len(seq))
            slots[near] = _slots(seq[near], seq[near + 1])
            np.add.at(counts, slots[near], 1)
            counts[-1] = 0
            rules.append(done.pairs)
            symbol += len(done.pairs)
        threshold = max(min(int(counts.max(initial=0)) // 4, threshold // 4), MIN_PAIR)
    while len(places):
        done = _replace(seq, places, MIN_PAIR, symbol)
        if done is None:
            break
        at, rest = done.at, done.left_over
        keep = np.ones(len(seq), dtype=bool)
        keep[at + 1] = False
        # A place beside a replaced one has become another pair, which is among the new ones.
        rest = rest[keep[rest]]
        beside = np.zeros(len(seq), dtype=bool)
        beside[at[at > 0] - 1] = True
        rest = rest[~beside[rest]]
        seq = seq[keep]
        near = _new_pairs(at, len(seq))
        near = near[(seq[near] != END) & (seq[near + 1] != END)]
        places = np.sort(np.concatenate((rest - np.searchsorted(at, rest), near)))
        rules.append(done.pairs)
        symbol += len(done.pairs)
    symbols = seq.astype(np.int64)
    symbols[seq == END] = ids[last]
    pairs = np.concatenate(rules) if rules else np.zeros(0, dtype=np.uint64)
    return symbols, (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)


def levels(left: np.ndarray, right: np.ndarray, first_new: int) -> Iterator[np.ndarray]:
    """The numbers of the rules in such an order that the halves of each lie in an earlier group, or are plain ids."""
    depth = [0] * first_new
    for a, b in zip(left.tolist(), right.tolist(), strict=True):
        depth.append(1 + max(depth[a], depth[b]))
    found = np.array(depth[first_new:], dtype=np.int64)
    for level in range(1, int(found.max(initial=0)) + 1):
        yield np.flatnonzero(found == level)


def pack(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray, end: int) -> bytes:
    """One block."""
    last = np.zeros(len(ids), dtype=bool)
    last[np.cumsum(counts) - 1] = True
    first_new = int(ids.max(initial=end)) + 1
    seq, left, right = grammar(ids, last, first_new)
    sizes = np.ones(first_new + len(left), dtype=np.int64)
    for rules in levels(left, right, first_new):
        sizes[first_new + rules] = sizes[left[rules]] + sizes[right[rules]]
    ends = np.cumsum(sizes[seq])
    runs = np.concatenate(([0], np.searchsorted(ends, np.cumsum(counts)) + 1))[:-1]
    return b"".join(
        [
            MAGIC,
            struct.pack("<4I", len(doc_ids), len(left), len(seq), first_new),
            np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(),
            np.array([d is None for d in doc_ids], dtype="u1").tobytes(),
            runs.astype("<u4").tobytes(),
            counts.astype("<u4").tobytes(),
            left.astype("<u4").tobytes(),
            right.astype("<u4").tobytes(),
            sizes[first_new:].astype("<u4").tobytes(),
            seq.astype("<u4").tobytes(),
        ]
    )


class Block:
    """A packed block; ``document(i)`` decodes one document from its own symbols."""

    def __init__(self, payload: bytes) -> None:
        if payload[:4] != MAGIC:
            raise ValueError("not a block of token ids")
        docs, rules, symbols, self.first_new = struct.unpack_from("<4I", payload, 4)
        at = 20

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            values = np.frombuffer(payload, dtype=kind, count=n, offset=at)
            at += values.nbytes
            return values

        doc_ids, nulls = take("<i8", docs), take("u1", docs)
        self.doc_ids = [None if n else int(d) for d, n in zip(doc_ids, nulls, strict=True)]
        self.runs, self.counts = take("<u4", docs), take("<u4", docs)
        left, right, sizes = take("<u4", rules), take("<u4", rules), take("<u4", rules)
        self.symbols = take("<u4", symbols).astype(np.int64)
        self.sizes = np.concatenate((np.ones(self.first_new, dtype=np.int64), sizes.astype(np.int64)))
        self.starts = np.concatenate((np.arange(self.first_new), self.first_new + np.cumsum(sizes) - sizes)).astype(
            np.int64
        )
        # Every symbol's ids stand in one array: the plain ids themselves, then rule after rule.
        self.flat = np.arange(self.first_new + int(sizes.sum()), dtype=np.int64)
        for rules in levels(left, right, self.first_new):
            halves = np.stack((left[rules], right[rules]), axis=1).ravel()
            symbols = self.first_new + rules
            self.flat[spread(self.starts[symbols], self.sizes[symbols])] = self.expand(halves)

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        return self.flat[spread(self.starts[symbols], self.sizes[symbols])]

    def documents(self, start: int, stop: int) -> np.ndarray:
        """The ids of neighbouring documents, one behind the other."""
        end = self.runs[stop] if stop < len(self.runs) else len(self.symbols)
        return self.expand(self.symbols[self.runs[start] : end])

    def document(self, i: int) -> np.ndarray:
        return self.documents(i, i + 1)


_ENCODERS: dict[str, PieceEncoder] = {}


def write_blocks(docs: DataFrame, tokenizer_path: str, end: int, path: str) -> None:
    """Write the ids of ``docs`` in ascending doc_id order to ``path``."""

    def run(batches) -> Iterator:
        import pyarrow as pa

        if tokenizer_path not in _ENCODERS:
            _ENCODERS[tokenizer_path] = PieceEncoder(tokenizer_path)
        encoder = _ENCODERS[tokenizer_path]
        block, shard = 0, 0
        held_ids: list[int | None] = []
        held_counts: list[np.ndarray] = []
        held: list[np.ndarray] = []
        size = 0

        def flush():
            nonlocal block, held_ids, held_counts, held, size
            counts, ids = np.concatenate(held_counts), np.concatenate(held)
            payload = pack(held_ids, counts, ids, end)
            row = [[shard], [block], [len(ids)], [payload]]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.binary()]
            block, held_ids, held_counts, held, size = block + 1, [], [], [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, types, strict=True)], ["shard", "block", "n_tokens", "payload"]
            )

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                shard = part.column("shard")[0].as_py()
                ids, counts = encoder.encode(part.column("text").to_pylist(), end)
                held_ids += part.column("doc_id").to_pylist()
                held_counts.append(counts)
                held.append(ids)
                size += len(ids)
                if size >= BLOCK_TOKENS:
                    yield flush()
        if size:
            yield flush()

    ordered = texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered = ordered.withColumn("shard", F.spark_partition_id())
    ordered.mapInArrow(run, BLOCKS).write.parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) per document: ids as little-endian unsigned 32-bit numbers, and their place in the whole."""
    blocks = spark.read.schema(BLOCKS).parquet(path)
    sizes = blocks.select("shard", "block", "n_tokens")
    # Sums run over the blocks of a shard, and over the shards, of which there are as many as tasks.
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shards = sizes.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = shards.select("shard", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("shard_start"))
    starts = sizes.select(
        "shard", "block", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("block_start")
    ).join(offsets, "shard")
    # Written first, so that Spark knows how small it is, and blocks are not shuffled as long as it can be broadcast.
    starts = starts.select("shard", "block", (F.col("block_start") + F.col("shard_start")).alias("start"))
    starts = materialize(starts, "block-starts")

    def run(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for start, payload in zip(
                batch.column("start").to_pylist(), batch.column("payload").to_pylist(), strict=True
            ):
                block = Block(payload)
                counts = block.counts.astype(np.int64)
                places = start + np.cumsum(counts) - counts
                for at in range(0, len(counts), 1000):
                    some = range(at, min(at + 1000, len(counts)))
                    ids = block.documents(some.start, some.stop).astype("<u4")
                    ends = np.concatenate(([0], np.cumsum(counts[some.start : some.stop]))) * 4
                    buffers = [None, pa.py_buffer(ends.astype("<i4")), pa.py_buffer(ids)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([block.doc_ids[i] for i in some], pa.int64()),
                            pa.array(places[some.start : some.stop]),
                            pa.Array.from_buffers(pa.binary(), len(some), buffers),
                        ],
                        ["doc_id", "start", "ids"],
                    )

    return blocks.drop("n_tokens").join(starts, ["shard", "block"]).mapInArrow(
        run, "doc_id long, start long, ids binary"
    )
