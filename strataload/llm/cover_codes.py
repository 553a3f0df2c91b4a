"""Product codes of vectors: k-means of every vector part, with cover trees that assign whole subtrees.

Components become integers, vectors are cut into equal consecutive parts, and each part position gets a codebook of
up to ENTRIES entries by Lloyd's rounds. Everything is integer arithmetic, so the result does not depend on how
rows are dealt out.

1. Each task takes its vectors in blocks of BLOCK. In a block, equal parts become one point with a weight, and a
   cover tree per part position is built over the points: a node has a centre (one of its points), the radius of
   its points around it, and their weight and sum. Points lie in tree order, so a node is a range of them, and
   running sums give weight and sum of any node. Trees are written once as a table.
2. A round sends the codebooks (PARTS x ENTRIES short integer vectors) to every task. From the root down, a node
   keeps the entries that some of its points could be nearest to: those within twice its radius of the distance to
   the nearest entry. If one is left, the whole subtree goes to it and only its sum is added; otherwise its
   children look at the entries left. Only points of undecided leaves are compared one by one.
3. Sums and counts per part and entry meet by an aggregate of PARTS x ENTRIES groups, which a task has added up
   before. The driver divides them and gets the next codebooks; vectors stay where they are.

Defined results: a vector that is NULL, empty, holds NULL, NaN or infinite components, or whose length is no
multiple of the number of parts or differs from that of the smallest vec_id is dropped (of one vec_id with vectors
of two lengths, the shorter comes first). Components reach from -LIMIT to LIMIT; larger ones count as that. A NULL
vec_id sorts last; rows with one id are ordered by vector. With fewer rows than ENTRIES, each row is an entry.
Repeated rows each have their row; equal entries leave all points to the first. No vectors, no rows.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataload.session import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LIMIT = 1 << 26  # keeps squared distances within 64 bits
BLOCK, LEAF = 4096, 12
BASE = 1.3  # a child's points lie within its parent's radius divided by this
EXACT = 1 << 22  # below, float64 holds squared distances without rounding
BLOCKS = "vec_ids binary, labels binary, rows binary, trees binary"
SUMS = "part int, entry int, n long, sums array<long>"
CODES = "vec_id long, label long, code string, error long"


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer vectors, a row per point."""
    largest = max(int(np.abs(points).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if largest < EXACT:
        p, e = points.astype(np.float64), entries.astype(np.float64)
        return np.rint((p * p).sum(axis=1)[:, None] - 2 * (p @ e.T) + (e * e).sum(axis=1)[None]).astype(np.int64)
    out = np.zeros((len(points), len(entries)), dtype=np.int64)
    for i in range(points.shape[1]):
        gap = points[:, i, None] - entries[None, :, i]
        out += gap * gap
    return out


@dataclass
class CoverTree:
    """Points in tree order and, per node, its range of points, its centre, its radius and its range of children."""

    points: np.ndarray
    weights: np.ndarray
    first: np.ndarray
    last: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    child: np.ndarray
    children: np.ndarray

    @classmethod
    def build(cls, points: np.ndarray, weights: np.ndarray) -> tuple[CoverTree, np.ndarray]:
        """The tree over distinct points, and the place each point has in it."""
        order = np.arange(len(points))
        # Nodes are numbered level by level, so the children of a node are consecutive.
        first, last, centre, radius, child, children = [0], [len(points)], [0], [0.0], [0], [0]
        node = 0
        while node < len(first):
            begin, end = first[node], last[node]
            mine = order[begin:end]
            away = np.sqrt(squared(points[mine], points[centre[node] : centre[node] + 1])[:, 0])
            radius[node] = float(away.max(initial=0.0))
            if end - begin > LEAF and radius[node] > 0:
                groups = cls._cover(points, mine, centre[node], away, radius[node] / BASE)
                if len(groups) > 1:
                    child[node], children[node] = len(first), len(groups)
                    at = begin
                    for middle, members in groups:
                        order[at : at + len(members)] = members
                        first.append(at)
                        at += len(members)
                        last.append(at)
                        centre.append(middle)
                        radius.append(0.0)
                        child.append(0)
                        children.append(0)
            node += 1
        place = np.empty(len(points), dtype=np.int64)
        place[order] = np.arange(len(points))
        arrays = [np.array(a, dtype=np.int64) for a in (first, last, place[centre])]
        tree = cls(points[order], weights[order], *arrays, np.array(radius), np.array(child), np.array(children))
        return tree, place

    @staticmethod
    def _cover(points, mine, middle, away, reach) -> list[tuple[int, np.ndarray]]:
        """Balls of a smaller radius that cover the points: the old centre's first, then around what is left."""
        groups = []
        while len(mine):
            inside = away <= reach
            groups.append((middle, mine[inside]))
            mine, away = mine[~inside], away[~inside]
            if len(mine):
                middle = int(mine[np.argmax(away)])
                away = np.sqrt(squared(points[mine], points[middle : middle + 1])[:, 0])
        return groups

    def assign(self, entries: np.ndarray) -> np.ndarray:
        """The nearest entry of every point, the lowest of equal ones."""
        chosen = np.zeros(len(self.points), dtype=np.int64)
        nodes = np.zeros(1, dtype=np.int64)
        open_ = np.ones((1, len(entries)), dtype=bool)
        loose: list[tuple[np.ndarray, np.ndarray]] = []
        while len(nodes):
            away = np.sqrt(squared(self.points[self.centre[nodes]], entries))
            away[~open_] = np.inf
            # A little more than twice the radius, as roots are rounded.
            bound = away.min(axis=1) + 2 * self.radius[nodes] * (1 + 1e-9) + 1e-6
            open_ = away <= bound[:, None]
            one = open_.sum(axis=1) == 1
            sizes = (self.last - self.first)[nodes[one]]
            chosen[spread(self.first[nodes[one]], sizes)] = np.repeat(open_[one].argmax(axis=1), sizes)
            leaf = ~one & (self.children[nodes] == 0)
            if leaf.any():
                sizes = (self.last - self.first)[nodes[leaf]]
                loose.append((spread(self.first[nodes[leaf]], sizes), np.repeat(open_[leaf], sizes, axis=0)))
            down = ~one & ~leaf
            counts = self.children[nodes[down]]
            open_ = np.repeat(open_[down], counts, axis=0)
            nodes = spread(self.child[nodes[down]], counts)
        if loose:
            places = np.concatenate([p for p, _ in loose])
            distances = squared(self.points[places], entries)
            distances[~np.concatenate([o for _, o in loose])] = np.iinfo(np.int64).max
            chosen[places] = distances.argmin(axis=1)
        return chosen

    def sums(self, chosen: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(count, componentwise sum) of each entry; neighbours in tree order with one entry are added as one range."""
        total = np.concatenate((np.zeros((1, self.points.shape[1]), np.int64), np.cumsum(self.points * self.weights[:, None], axis=0)))
        rows = np.concatenate(([0], np.cumsum(self.weights)))
        edges = np.concatenate(([0], np.flatnonzero(chosen[1:] != chosen[:-1]) + 1, [len(chosen)]))
        entry = chosen[edges[:-1]]
        counts, sums = np.zeros(n, dtype=np.int64), np.zeros((n, self.points.shape[1]), dtype=np.int64)
        np.add.at(counts, entry, rows[edges[1:]] - rows[edges[:-1]])
        np.add.at(sums, entry, total[edges[1:]] - total[edges[:-1]])
        return counts, sums


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each of ``lengths`` numbers, one run after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def to_integers(values: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(values.astype(np.float64) * SCALE), -LIMIT, LIMIT).astype(np.int64)


def _save(arrays: list[np.ndarray]) -> bytes:
    out = io.BytesIO()
    for a in arrays:
        np.save(out, a, allow_pickle=False)
    return out.getvalue()


def _load(payload: bytes, n: int) -> list[np.ndarray]:
    source = io.BytesIO(payload)
    return [np.load(source, allow_pickle=False) for _ in range(n)]


def _smallest(values: np.ndarray) -> np.ndarray:
    """The same integers in 32 bits where they fit."""
    return values.astype(np.int32) if values.dtype == np.int64 and np.abs(values).max(initial=0) < 1 << 31 else values


TREE_FIELDS = ("points", "weights", "first", "last", "centre", "radius", "child", "children")


def _block(vectors: np.ndarray) -> tuple[bytes, bytes]:
    """(place of every row in the tree of every part, the trees) of a block of integer vectors."""
    rows, arrays = [], []
    for part in np.split(vectors, PARTS, axis=1):
        points, inverse, counts = np.unique(part, axis=0, return_inverse=True, return_counts=True)
        tree, place = CoverTree.build(points, counts)
        rows.append(place[inverse.reshape(-1)].astype(np.int32))
        arrays += [_smallest(getattr(tree, name)) for name in TREE_FIELDS]
    return _save(rows), _save(arrays)


def _trees(payload: bytes) -> list[CoverTree]:
    arrays = [a.astype(np.int64) if a.dtype == np.int32 else a for a in _load(payload, PARTS * len(TREE_FIELDS))]
    return [CoverTree(*arrays[i : i + len(TREE_FIELDS)]) for i in range(0, len(arrays), len(TREE_FIELDS))]


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding, label) of the rows whose vector has finite components only, cut into whole parts."""

    def finite(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        F.col("label").cast("long").alias("label"),
    )
    size = F.size("embedding")
    return rows.where(F.col("embedding").isNotNull() & (size > 0) & (size % PARTS == 0) & F.forall("embedding", finite))


def tree_blocks(rows: DataFrame) -> DataFrame:
    """Blocks of rows with their cover trees, written once."""

    def run(batches) -> Iterator:
        import pyarrow as pa

        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def flush():
            ids, known, labels, labelled, vectors = (np.concatenate(column) for column in zip(*held, strict=True))
            rows, trees = _block(vectors)
            row = [_save([ids, known]), _save([labels, labelled]), rows, trees]
            names = [field.split()[0] for field in BLOCKS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in row], names)

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, BLOCK - size)
                at += part.num_rows
                size += part.num_rows
                ids, labels = part.column("vec_id"), part.column("label")
                known, labelled = (np.asarray(c.is_valid()) for c in (ids, labels))
                flat = part.column("embedding").flatten().to_numpy(zero_copy_only=False)
                held.append(
                    (
                        np.asarray(ids.fill_null(0)),
                        known,
                        np.asarray(labels.fill_null(0)),
                        labelled,
                        to_integers(flat).reshape(part.num_rows, -1),
                    )
                )
                if size >= BLOCK:
                    yield flush()
                    held.clear()
                    size = 0
        if size:
            yield flush()

    return materialize(rows.mapInArrow(run, BLOCKS), "cover-trees")


def next_codebooks(blocks: DataFrame, codebooks: list[np.ndarray]) -> list[np.ndarray]:
    """One round: every point to its nearest entry, every entry to the floor of its points' mean."""
    n = len(codebooks[0])

    def run(batches) -> Iterator:
        import pyarrow as pa

        counts = np.zeros((PARTS, n), dtype=np.int64)
        sums = np.zeros((PARTS, n, codebooks[0].shape[1]), dtype=np.int64)
        for batch in batches:
            for payload in batch.column("trees"):
                for part, tree in enumerate(_trees(payload.as_py())):
                    c, s = tree.sums(tree.assign(codebooks[part]), n)
                    counts[part] += c
                    sums[part] += s
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part, pa.int32()),
                pa.array(entry, pa.int32()),
                pa.array(counts[part, entry]),
                pa.array(sums[part, entry].tolist(), pa.list_(pa.int64())),
            ],
            ["part", "entry", "n", "sums"],
        )

    width = codebooks[0].shape[1]
    exact = [F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    partial = blocks.select("trees").mapInArrow(run, SUMS)
    found = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *exact).collect()
    after = [book.copy() for book in codebooks]
    for row in found:
        after[row["part"]][row["entry"]] = [int(row[f"s{i}"]) // row["n"] for i in range(width)]
    return after


def first_codebooks(rows: DataFrame) -> list[np.ndarray]:
    """The parts of the vectors with the smallest ids; none if there are no rows."""
    order = [F.col("vec_id").asc_nulls_last(), F.size("embedding"), F.col("embedding")]
    head = rows.select("vec_id", "embedding").orderBy(*order).limit(1).collect()
    if not head:
        return []
    same = rows.where(F.size("embedding") == len(head[0]["embedding"]))
    top = same.select("vec_id", "embedding").orderBy(*order).limit(ENTRIES).collect()
    return np.split(to_integers(np.array([row["embedding"] for row in top])), PARTS, axis=1)


def assigned(blocks: DataFrame, codebooks: list[np.ndarray]) -> DataFrame:
    """(vec_id, label, code, error) of every row."""

    def run(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                ids, known = _load(row["vec_ids"], 2)
                labels, labelled = _load(row["labels"], 2)
                error = np.zeros(len(ids), dtype=np.int64)
                codes = np.zeros((len(ids), PARTS), dtype=np.uint8)
                places = _load(row["rows"], PARTS)
                for part, (tree, book) in enumerate(zip(_trees(row["trees"]), codebooks, strict=True)):
                    chosen = tree.assign(book)
                    gap = tree.points - book[chosen]
                    error += (gap * gap).sum(axis=1)[places[part]]
                    codes[:, part] = chosen[places[part]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64(), mask=~known),
                        pa.array(labels, pa.int64(), mask=~labelled),
                        pa.array([c.hex() for c in map(bytes, codes)], pa.string()),
                        pa.array(error),
                    ],
                    [field.split()[0] for field in CODES.split(", ")],
                )

    return blocks.mapInArrow(run, CODES)


def digest(codebooks: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(v) for book in codebooks for v in book.ravel().tolist()).encode()).hexdigest()


def encode_vectors(vectors: DataFrame) -> tuple[DataFrame, list[np.ndarray]]:
    """((vec_id, label, code, error) of all usable vectors, the final codebooks by part)."""
    rows = usable(vectors)
    codebooks = first_codebooks(rows)
    if not codebooks:
        return rows.sparkSession.createDataFrame([], CODES), []
    width = PARTS * codebooks[0].shape[1]
    blocks = tree_blocks(rows.where(F.size("embedding") == width))
    for _ in range(ROUNDS):
        codebooks = next_codebooks(blocks, codebooks)
    return assigned(blocks, codebooks), codebooks


def code_rows(vectors: DataFrame) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of all usable vectors."""
    codes, codebooks = encode_vectors(vectors)
    codes = materialize(codes, "codes")
    per_label = materialize(
        codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label"), "label-errors"
    )
    joined = codes.join(per_label, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256"))

