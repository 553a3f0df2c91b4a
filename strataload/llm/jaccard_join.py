"""Documents linked by the Jaccard similarity of their word shingles, found with PartEnum signatures.

A document's set holds the hashes of its distinct SHINGLE-word runs. Two sets of sizes s and t with
similarity 3/4 or more differ in at most (s + t) / 7 shingles, and their sizes are in the same or in
neighbouring size bands (each band ends 4/3 times where the one before it ends).

Signatures. For a band that ends at r, the domain of hashes is cut into n parts, n well above
k = 2r / 7. A set of this band, or of the band below it, gives one signature for every part it has members
in: the part with the sum of the members' hashes. Two linked sets differ in at most k parts. So of the d
parts in which a set has members, at least d - k are equal in the other: linked sets do not just meet in one
signature, they meet in d - k of them, and that number (``need``) is known for each set. A set with d <= k
also gives a signature that all such sets of the band share.

Groups with one signature.
- Up to SMALL sets: their pairs, with the number of signatures in which they met.
- More than that: a set that is in fewer large groups than it needs cannot owe a link to large groups alone,
  so it leaves them. A passage that a third of all documents share fills a few groups and no more; it
  disappears here. What stays is large families of near copies. Each set looks only into the smaller of its
  groups, all but the last ``need`` - 1 of them, and there every two sets of a group are a pair.

A pair is a candidate if it met as often as both sets need, and every candidate is decided on the whole sets.
Sets that probably belong together share a block, and a set is sent once to each two blocks it has candidates
in. The pairs of large groups exist only inside the task that decides them; it returns, per set, the number of
documents it is linked to and one link that keeps the set connected.
Equal sets are one node from the start: each task sends a set once, and families of equal documents of any
size cost one row per task. Signatures travel packed, by ranges of their hashes within a band; a band has ranges in
proportion to its signatures, as counted from the sets' sizes. A set's name goes to ranges of its two bands only, and
to as many as it has signatures at most. With it go its size, in two bytes, and ``need``, in one, which is rounded
down where it is large: that only adds candidates. Signatures lie by set, so that their owners are small steps.
The bitmap that tells a scan which sets are wanted has a fixed size; when it fills, more sets are shuffled than
needed, and results stay the same.

Defined results: documents without words have an empty set, n_shingles 0, and form their own component each;
those with fewer words than a shingle have one. Repeated ids form one document only if their sets are linked;
the component of a document without id is the smallest id it is linked to, or NULL. ``n_links`` counts the
other rows whose sets are equal or similar enough; rows of an empty set have none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataload.llm.components import components
from strataload.llm.hashing import WordHasher, mix, utf8
from strataload.llm.tables import orderable, texts, with_bodies
from strataload.session import materialize

SHINGLE = 5
SMALL = 16
RUN_BYTES, RUN_SETS = 4 << 20, 30_000
RANGE_SIGNATURES = 1 << 20
BITMAP_BITS = 23
BLOCK_BYTES = 1 << 20
_ODD = [np.uint64(pow(0x9E3779B97F4A7C15, i, 1 << 64)) for i in range(1, SHINGLE + 1)]


def _band_ends() -> np.ndarray:
    ends = [1]
    while ends[-1] < 1 << 40:
        ends.append(max(ends[-1] + 1, ends[-1] * 4 // 3))
    return np.array(ends, dtype=np.int64)


ENDS = _band_ends()


def band_of(size):
    return np.searchsorted(ENDS, size)


def edits_allowed(band):
    """k: shingles in which linked sets of this band and the one below can differ."""
    return 2 * ENDS[band] // 7


def parts(band):
    k = edits_allowed(band)
    return k + 1 + np.maximum(8, (k + 1) // 2)


def _need_steps() -> np.ndarray:
    steps = list(range(160))
    while len(steps) < 256:
        steps.append(steps[-1] * 27 // 25)
    return np.array(steps, dtype=np.int64)


NEEDS = _need_steps()
_PLACES = 512  # sizes told apart within a band


def need_code(need: np.ndarray) -> np.ndarray:
    """A byte per number of meetings; what ``NEEDS`` has for it is that number, or up to 8 % less if it is large."""
    return (np.searchsorted(NEEDS, np.maximum(need, 0), side="right") - 1).astype("u1")


def size_code(size: np.ndarray) -> np.ndarray:
    """Two bytes per size: its band, and its place in the band."""
    band = band_of(size)
    low = np.where(band > 0, ENDS[band - 1], 0)
    return (band * _PLACES + (size - low - 1) * _PLACES // (ENDS[band] - low)).astype("<u2")


def size_range(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest and the largest size of a code."""
    code = code.astype(np.int64)
    band, place = code // _PLACES, code % _PLACES
    low = np.where(band > 0, ENDS[band - 1], 0)
    width = ENDS[band] - low
    return low + 1 - (-place * width // _PLACES), low - (-(place + 1) * width // _PLACES)


def shingles(words: np.ndarray) -> np.ndarray:
    """The sorted distinct shingle hashes of a text from the hashes of its words."""
    n = len(words)
    if n == 0:
        return words
    width = min(n, SHINGLE)
    total = np.full(n - width + 1, width, dtype=np.uint64)
    for i in range(width):
        total += words[i : n - width + 1 + i] * _ODD[i]
    return np.unique(mix(total))


def set_key(grams: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes of a set, as signed numbers."""
    import xxhash

    digest = xxhash.xxh3_128_digest(grams.astype("<u8").tobytes())
    low, high = np.frombuffer(digest, dtype="<i8").tolist()
    return low, high


def _sets(batches) -> Iterator[tuple[int | None, np.ndarray, int]]:
    """(doc id, set, bytes of text) of each row."""
    hasher = WordHasher()
    for batch in batches:
        bodies = utf8(batch.column("text"))
        ids = batch.column("doc_id").to_pylist()
        for doc_id, words, body in zip(ids, hasher.batch(bodies), bodies, strict=True):
            yield doc_id, shingles(words), len(body)


def _frame(columns: dict):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(v, type=t) for v, t in columns.values()], list(columns))


def _members(batches) -> Iterator:
    import pyarrow as pa

    rows: list[tuple] = []

    def out():
        ids, sizes, keys, checks = zip(*rows, strict=True)
        return _frame(
            {
                "doc_id": (ids, pa.int64()), "size": (sizes, pa.int64()),
                "node": (keys, pa.int64()), "check": (checks, pa.int64()),
            }
        )

    for doc_id, grams, _ in _sets(batches):
        rows.append((doc_id, len(grams), *(set_key(grams) if len(grams) else (None, None))))
        if len(rows) == 10_000:
            yield out()
            rows = []
    if rows:
        yield out()


def signatures(grams: np.ndarray, band: int) -> tuple[np.ndarray, int]:
    """(signatures, need) of a sorted set for the pairs whose larger set is in ``band``."""
    n, k = int(parts(band)), int(edits_allowed(band))
    part = ((grams >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
    first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
    sums = np.add.reduceat(mix(grams + np.uint64(band)), first)
    need = len(first) - k
    sums = mix(sums ^ (part[first] << np.uint64(20)))
    if need <= 0:
        sums = np.append(sums, mix(np.array([band + 0x5EED], dtype=np.uint64)))
    return sums, need


SIGNED = "range int, signatures binary, who binary, nodes binary, sizes binary, needs binary"


def _ranges(members: DataFrame) -> np.ndarray:
    """The first range of each band, and the number of all, from the sizes of the documents' sets."""
    sizes = members.filter("size > 0").groupBy("size").agg(F.count("*").alias("n"))
    band = F.size(F.filter(F.lit(ENDS.tolist()), lambda end: end < F.col("size"))).alias("band")
    given = [F.least(F.col("size"), F.element_at(F.lit(parts(np.arange(len(ENDS))).tolist()), F.col("band") + i)) for i in (1, 2)]
    sums = sizes.select("size", "n", band).groupBy("band").agg(*(F.sum(F.col("n") * g).alias(f"n{i}") for i, g in enumerate(given)))
    volume = np.zeros(len(ENDS) + 1, dtype=np.int64)
    for row in sums.collect():
        volume[row["band"]] += row["n0"]
        volume[row["band"] + 1] += row["n1"]
    return np.concatenate(([0], np.cumsum(volume // RANGE_SIGNATURES + 1)))


def _sign(first_range: np.ndarray):
    """Packed signatures of the distinct sets of a task. An owner is twice the set's number, plus one in the
    instance of the next larger band; ``who`` holds the steps between the owners."""

    def sign(batches) -> Iterator:
        import pyarrow as pa

        seen: set[int] = set()
        nodes: list[int] = []
        sizes: list[int] = []
        needs: list[int] = []
        marks: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        places: list[np.ndarray] = []

        def flush() -> Iterator:
            mark, owner, where = np.concatenate(marks), np.concatenate(owners), np.concatenate(places)
            order = np.argsort(where, kind="stable")
            mark, owner, where = mark[order], owner[order], where[order]
            present = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
            cuts = np.append(present, len(where)).tolist()
            node, size = np.array(nodes, "<i8"), size_code(np.array(sizes, dtype=np.int64))
            need = need_code(np.array(needs, dtype=np.int64)).reshape(-1, 2)
            for low in range(0, len(present), 50):
                rows = []
                for k in range(low, min(low + 50, len(present))):
                    who = owner[cuts[k] : cuts[k + 1]]
                    used, local = np.unique(who >> 1, return_inverse=True)
                    # The low half of the hash tells signatures of one range apart; chance meetings are decided later.
                    rows.append(
                        (
                            int(where[cuts[k]]),
                            mark[cuts[k] : cuts[k + 1]].astype("<u4").tobytes(),
                            np.diff(local * 2 + (who & 1), prepend=0).astype("<u2").tobytes(),
                            node[used].tobytes(), size[used].tobytes(), need[used].tobytes(),
                        )
                    )
                names = [f.split()[0] for f in SIGNED.split(", ")]
                kinds = [pa.int32()] + [pa.binary()] * 5
                columns = zip(*rows, strict=True)
                yield _frame({n: (list(c), t) for n, c, t in zip(names, columns, kinds, strict=True)})

        size_now = 0
        for _, grams, body in _sets(batches):
            if not len(grams):
                continue
            key, _ = set_key(grams)
            if key in seen:
                continue
            seen.add(key)
            band = int(band_of(len(grams)))
            for step in (0, 1):
                mark, need = signatures(grams, band + step)
                marks.append(mark)
                low, high = first_range[band + step : band + step + 2].tolist()
                places.append((((mark >> np.uint64(32)) * np.uint64(high - low)) >> np.uint64(32)).astype("u4") + np.uint32(low))
                owners.append(np.full(len(mark), 2 * len(nodes) + step, dtype=np.int64))
                needs.append(need)
            nodes.append(key)
            sizes.append(len(grams))
            size_now += body
            if size_now >= RUN_BYTES or len(nodes) >= RUN_SETS:
                yield from flush()
                nodes, sizes, needs, marks, owners, places, size_now = [], [], [], [], [], [], 0
        if nodes:
            yield from flush()

    return sign


MET = "band int, grp long, a long, b long, met int, need int"


def _meet(table):
    """Pairs of small groups with the number of meetings; the sets of large groups."""
    import pyarrow as pa

    marks, who, nodes, sizes, needs = [], [], [], [], []
    before = 0
    for row in table.to_pylist():
        w = np.cumsum(np.frombuffer(row["who"], "<u2").astype(np.int64))
        n = np.frombuffer(row["nodes"], "<i8")
        marks.append(np.frombuffer(row["signatures"], "<u4"))
        who.append(w + 2 * before)
        nodes.append(n)
        sizes.append(np.frombuffer(row["sizes"], "<u2"))
        needs.append(np.frombuffer(row["needs"], "u1"))
        before += len(n)
    number = table.column("range")[0].as_py()
    mark, who = np.concatenate(marks), np.concatenate(who)
    node, size, need = np.concatenate(nodes), np.concatenate(sizes), NEEDS[np.concatenate(needs)]
    order = np.argsort(mark, kind="stable")
    mark, who = mark[order], who[order]
    # Most signatures are alone; the rest is small.
    twin = mark[1:] == mark[:-1]
    shared = np.concatenate((twin, [False])) | np.concatenate(([False], twin))
    mark, who = mark[shared].astype(np.int64), who[shared]
    key, larger = node[who >> 1], (who & 1).astype(np.int64)
    band = size[who >> 1].astype(np.int64) // _PLACES + larger
    order = np.lexsort((key, band, mark))
    mark, who, key, larger, band = (x[order] for x in (mark, who, key, larger, band))
    same_group = (mark[1:] == mark[:-1]) & (band[1:] == band[:-1])
    repeat = np.concatenate(([False], same_group & (key[1:] == key[:-1])))[: len(mark)]
    mark, who, key, larger, band = (x[~repeat] for x in (mark, who, key, larger, band))
    fresh = np.concatenate(([True], (mark[1:] != mark[:-1]) | (band[1:] != band[:-1]))) if len(mark) else np.zeros(0, bool)
    group = np.cumsum(fresh) - 1
    count = np.bincount(group, minlength=1)
    (least, most), need_of = size_range(size[who >> 1]), need[who]
    inside = count[group] if len(group) else group
    pairs = []
    for step in range(1, SMALL):
        i = np.flatnonzero((group[step:] == group[:-step]) & (inside[step:] <= SMALL)) if len(group) > step else []
        if not len(i):
            break
        j = i + step
        near = (3 * np.maximum(least[i], least[j]) <= 4 * np.minimum(most[i], most[j])) & (larger[i] * larger[j] == 0)
        i, j = i[near], j[near]
        pairs.append(np.stack([band[i], key[i], key[j], np.maximum(need_of[i], need_of[j])]))
    found = np.concatenate(pairs, axis=1) if pairs else np.zeros((4, 0), dtype=np.int64)
    found, times = np.unique(found, axis=1, return_counts=True) if found.shape[1] else (found, np.zeros(0, np.int64))
    big = inside > SMALL
    name = (np.int64(number) << 32) | mark[big]
    none = np.zeros(int(big.sum()), dtype=np.int64)
    columns = {
        "band": (np.concatenate((found[0], band[big])), pa.int32()),
        "grp": (pa.array([None] * found.shape[1] + name.tolist(), pa.int64()), pa.int64()),
        "a": (np.concatenate((found[1], key[big])), pa.int64()),
        "b": (np.concatenate((found[2], none)), pa.int64()),
        "met": (np.concatenate((times, none)), pa.int32()),
        "need": (np.concatenate((found[3], need_of[big])), pa.int32()),
    }
    return pa.Table.from_batches(
        [pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v).cast(t) for v, t in columns.values()], list(columns))]
    )


def _bitmap(nodes: DataFrame) -> np.ndarray:
    """Bits of the nodes' low bits: 2^BITMAP_BITS of them, whatever the number of nodes."""
    low = f"cast(node & {(1 << BITMAP_BITS) - 1} as int)"
    words = (
        nodes.selectExpr(f"shiftright({low}, 5) AS word", f"shiftleft(1, {low} & 31) AS bit")
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    out = np.zeros(1 << (BITMAP_BITS - 5), dtype=np.int32)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool)


def _wanted_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, grams) of the sets of ``nodes``, and of some others."""
    packed = np.packbits(_bitmap(nodes))

    def pick(batches) -> Iterator:
        import pyarrow as pa

        bits = np.unpackbits(packed).astype(bool)
        seen: set[int] = set()
        rows: list[tuple[int, bytes]] = []
        size = 0
        for _, grams, _ in _sets(batches):
            if not len(grams):
                continue
            key, _ = set_key(grams)
            if key in seen or not bits[key & ((1 << BITMAP_BITS) - 1)]:
                continue
            seen.add(key)
            rows.append((key, grams.astype("<u8").tobytes()))
            size += len(grams)
            if size > 1 << 19:
                yield _frame({"node": ([k for k, _ in rows], pa.int64()), "grams": ([g for _, g in rows], pa.binary())})
                rows, size = [], 0
        if rows:
            yield _frame({"node": ([k for k, _ in rows], pa.int64()), "grams": ([g for _, g in rows], pa.binary())})

    return docs.mapInArrow(pick, "node long, grams binary").groupBy("node").agg(F.first("grams").alias("grams"))


def _decide(batches) -> Iterator:
    import pyarrow as pa

    # Few pairs at a time: the sets of long documents are large.
    for batch in (whole.slice(at, 100) for whole in batches for at in range(0, whole.num_rows, 100)):
        links = []
        rows = zip(*(batch.column(c).to_pylist() for c in ("a", "b", "grams_a", "grams_b")), strict=True)
        for a, b, one, two in rows:
            x, y = np.frombuffer(one, "<u8"), np.frombuffer(two, "<u8")
            both = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * both >= 75 * (len(x) + len(y) - both):
                links.append((a, b))
        yield _frame({"a": ([a for a, _ in links], pa.int64()), "b": ([b for _, b in links], pa.int64())})


def verify(candidates: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose whole sets are similar enough."""
    one = sets.select(F.col("node").alias("a"), F.col("grams").alias("grams_a"))
    two = sets.select(F.col("node").alias("b"), F.col("grams").alias("grams_b"))
    return candidates.join(one, "a").join(two, "b").select("a", "b", "grams_a", "grams_b").mapInArrow(
        _decide, "a long, b long"
    )


def _overlaps(mark: np.ndarray, grams: np.ndarray, starts: np.ndarray, sizes: np.ndarray, few: np.ndarray) -> np.ndarray:
    """Number of marked shingles of each of the ``few`` sets."""
    begin = np.cumsum(sizes[few]) - sizes[few]
    places = np.repeat(starts[few] - begin, sizes[few]) + np.arange(int(sizes[few].sum()))
    return np.add.reduceat(mark[grams[places]].astype(np.int64), begin)


def _decide_block(pairs, sets):
    """Links among the pairs of two blocks, from the sets of both."""
    import pyarrow as pa

    node = sets.column("node").to_numpy()
    held = [np.frombuffer(g, "<u8") for g in sets.column("grams").to_pylist()]
    sizes = np.array([len(g) for g in held], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    known, grams = np.unique(np.concatenate(held), return_inverse=True)
    order = np.argsort(node)
    a, b = (order[np.searchsorted(node, pairs.column(c).to_numpy(), sorter=order)] for c in ("a", "b"))
    by_a = np.argsort(a, kind="stable")
    a, b = a[by_a], b[by_a]
    cuts = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1], [True])))
    linked = np.zeros(len(a), dtype=bool)
    mark = np.zeros(len(known), dtype=bool)
    for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        mine = grams[starts[a[low]] : starts[a[low]] + sizes[a[low]]]
        mark[mine] = True
        for at in range(low, high, 1000):
            few = b[at : min(at + 1000, high)]
            both = _overlaps(mark, grams, starts, sizes, few)
            linked[at : at + len(few)] = 100 * both >= 75 * (len(mine) + sizes[few] - both)
        mark[mine] = False
    return pa.table({"a": node[a[linked]], "b": node[b[linked]]})


LINKED = "node long, root long, n long"


def _decide_groups(sets):
    """(node, root, n) of the linked sets of two blocks, from the pairs of one set of each that share a group."""
    import pyarrow as pa

    node, copies = sets.column("node").to_numpy(), sets.column("copies").to_numpy()
    x, y = sets.column("x")[0].as_py(), sets.column("y")[0].as_py()
    mine, theirs = sets.column("block").to_numpy() == x, sets.column("block").to_numpy() == y
    held = [np.frombuffer(g, "<u8") for g in sets.column("grams").to_pylist()]
    sizes = np.array([len(g) for g in held], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    known, grams = np.unique(np.concatenate(held), return_inverse=True)
    lists = sets.column("groups").combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    names, group = np.unique(lists.flatten().to_numpy(), return_inverse=True)
    own = np.concatenate(([0], np.cumsum(lengths)))
    members = np.repeat(np.arange(len(node)), lengths)[np.argsort(group, kind="stable")]
    ends = np.cumsum(np.bincount(group, minlength=len(names)))
    begins = np.concatenate(([0], ends[:-1]))
    root, n = np.arange(len(node)), np.zeros(len(node), dtype=np.int64)
    mark = np.zeros(len(known), dtype=bool)
    for a in np.flatnonzero(mine).tolist():
        meets = np.zeros(len(node), dtype=bool)
        for g in group[own[a] : own[a + 1]].tolist():
            meets[members[begins[g] : ends[g]]] = True
        # Of sets similar enough the smaller has three quarters of the larger's size or more.
        meets &= theirs & (4 * np.minimum(sizes, sizes[a]) >= 3 * np.maximum(sizes, sizes[a]))
        if x == y:
            meets[: a + 1] = False
        others = np.flatnonzero(meets)
        if not len(others):
            continue
        mark[grams[starts[a] : starts[a] + sizes[a]]] = True
        for at in range(0, len(others), 1000):
            few = others[at : at + 1000]
            both = _overlaps(mark, grams, starts, sizes, few)
            few = few[100 * both >= 75 * (sizes[a] + sizes[few] - both)]
            n[a] += copies[few].sum()
            n[few] += copies[a]
            labels = np.unique(root[np.append(few, a)])
            if len(labels) > 1:
                root[np.isin(root, labels)] = labels[0]
        mark[grams[starts[a] : starts[a] + sizes[a]]] = False
    linked = n > 0
    return pa.table({"node": node[linked], "root": node[root[linked]], "n": n[linked]})


def verify_groups(few: DataFrame, sets: DataFrame, family: DataFrame, copies: DataFrame) -> DataFrame:
    """Links among all sets (node, groups) that share a group, as LINKED rows: a set has one for each two blocks."""
    blocks = _blocks(sets, family)
    placed = few.join(blocks, "node")
    each = materialize(placed.select("node", "block", F.explode("groups").alias("grp")), "jaccard-grouped")
    there = each.select("grp", F.col("block").alias("other")).distinct()
    met = each.join(there, "grp").select("node", "block", "other").distinct()
    # Two sets of one block meet in it; the block by itself is among the others.
    x, y = F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y")
    sent = met.select("node", "block", x, y).join(few.join(copies, "node").join(sets, "node"), "node")
    return sent.groupBy("x", "y").applyInArrow(_decide_groups, LINKED)


def _blocks(sets: DataFrame, family: DataFrame) -> DataFrame:
    """(node, block): families (node, hub) above BLOCK_BYTES are cut into blocks of about that size, smaller ones
    share blocks."""
    sized = sets.select("node", F.octet_length("grams").alias("bytes")).join(family, "node", "left")
    sized = sized.withColumn("hub", F.coalesce("hub", "node"))
    cut = sized.groupBy("hub").agg(F.sum("bytes").alias("all"))
    cut = materialize(cut.select("hub", "all", F.ceil(F.col("all") / BLOCK_BYTES).alias("cuts")), "jaccard-families")
    bins = -(-(cut.filter("cuts = 1").agg(F.sum("all")).first()[0] or 0) // BLOCK_BYTES)
    shared = F.pmod(F.xxhash64("hub"), F.lit(max(bins, 1)))
    block = F.when(F.col("cuts") > 1, F.xxhash64("hub", F.pmod(F.xxhash64("node"), F.col("cuts")))).otherwise(shared)
    return materialize(sized.join(cut, "hub").select("node", block.alias("block")), "jaccard-blocks")


def verify_dense(pairs: DataFrame, sets: DataFrame, family: DataFrame) -> DataFrame:
    """As ``verify`` for many pairs of few sets: a set is sent once to each two blocks it has pairs in, not once per
    pair."""
    blocks = _blocks(sets, family)
    for side in ("a", "b"):
        pairs = pairs.join(blocks.toDF(side, f"block_{side}"), side)
    x, y = F.least("block_a", "block_b").alias("x"), F.greatest("block_a", "block_b").alias("y")
    pairs = materialize(pairs.select(x, y, "a", "b"), "jaccard-block-pairs")
    sent = pairs.select("x", "y", "a").union(pairs.select("x", "y", "b")).toDF("x", "y", "node").distinct()
    sent = sent.join(sets, "node").select("x", "y", "node", "grams")
    return pairs.groupBy("x", "y").cogroup(sent.groupBy("x", "y")).applyInArrow(_decide_block, "a long, b long")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def links(docs: DataFrame, members: DataFrame, copies: DataFrame) -> DataFrame:
    """All links between distinct sets, as LINKED rows: ``n`` sums up to the documents of the sets a set is linked to,
    and the pairs (node, root) connect every component. ``members`` has the size of each document's set, ``copies``
    the number of documents of each set."""
    rows = texts(docs)
    met = materialize(rows.mapInArrow(_sign(_ranges(members)), SIGNED).groupBy("range").applyInArrow(_meet, MET), "jaccard-met")
    large = met.filter("grp IS NOT NULL").select("band", "grp", F.col("a").alias("node"), "need")
    often = large.groupBy("band", "node").agg(F.count("*").alias("times"), F.max("need").alias("need"))
    often = materialize(often, "jaccard-often")
    pairs = (
        met.filter("grp IS NULL").groupBy("band", "a", "b").agg(F.sum("met").alias("met"), F.max("need").alias("need"))
    )
    times = often.select("band", "node", "times")
    for side in ("a", "b"):
        pairs = pairs.join(times.toDF("band", side, f"times_{side}"), ["band", side], "left")
    elsewhere = F.least(F.coalesce("times_a", F.lit(0)), F.coalesce("times_b", F.lit(0)))
    small = materialize(pairs.filter(F.col("met") + elsewhere >= F.col("need")).select("a", "b", "met"), "jaccard-small")
    stay = often.filter("times >= need")
    large = large.drop("need").join(stay.select("band", "node", "times"), ["band", "node"])
    large = materialize(large.select("grp", "band", "node", "times"), "jaccard-large")
    # The text that a family was copied from is in more of its groups than any copy, and the copies link to it
    # rather than to each other. With the set it met most often this tells what probably belongs together.
    hub = large.groupBy("band", "grp").agg(F.max_by("node", F.struct("times", "node")).alias("hub"))
    star = large.join(hub, ["band", "grp"]).filter("node <> hub").groupBy("node", "hub").agg(F.count("*").alias("n"))
    star = star.groupBy("node").agg(F.max_by("hub", F.struct("n", "hub")).alias("hub"))
    ends = small.select(F.col("a").alias("node"), F.col("b").alias("other"), "met")
    ends = ends.union(small.select("b", "a", "met"))
    nearest = ends.groupBy("node").agg(F.max_by("other", F.struct("met", "other")).alias("other"))
    family = materialize(components(star.union(nearest).toDF("a", "b")).toDF("node", "hub"), "jaccard-family")
    nodes = ends.select("node").union(large.select("node")).distinct()
    sets = materialize(_wanted_sets(rows, nodes), "jaccard-sets")
    # A pair that never met in a small group meets in as many large ones as either set needs. So it also meets in
    # those that are left when each set leaves its largest ones, as many as it needs less one.
    sizes = large.groupBy("band", "grp").agg(F.count("*").alias("size"))
    by_size = Window.partitionBy("band", "node").orderBy("size", "grp")
    ranked = large.join(sizes, ["band", "grp"]).withColumn("rank", F.row_number().over(by_size))
    few = ranked.join(stay.select("band", "node", "need"), ["band", "node"]).filter("rank <= times - need + 1")
    few = few.groupBy("node").agg(F.collect_list(F.xxhash64("band", "grp")).alias("groups"))
    few = materialize(few, "jaccard-few")
    # Pairs that share one of these groups are decided there.
    pairs = _ordered(small)
    for side in ("a", "b"):
        pairs = pairs.join(few.toDF(side, f"groups_{side}"), side, "left")
    together = F.coalesce(F.arrays_overlap("groups_a", "groups_b"), F.lit(False))
    found = materialize(verify_dense(pairs.filter(~together).select("a", "b"), sets, family), "jaccard-links")
    both = found.union(found.select("b", "a")).toDF("node", "root")
    one = both.join(copies.toDF("root", "n"), "root").select("node", "root", "n")
    return materialize(one.union(verify_groups(few, sets, family, copies)), "jaccard-linked")


def _similar(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, size, node, check) of every document, and (node, least, label, copies, n_links) of every set."""
    members = materialize(texts(docs).mapInArrow(_members, "doc_id long, size long, node long, check long"), "jaccard-members")
    nodes = members.filter("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("least"), F.min("check").alias("low"), F.max("check").alias("high"), F.count("*").alias("copies")
    )
    clash = F.when(F.col("low") != F.col("high"), F.raise_error(F.lit("two sets have one hash")).cast("long"))
    nodes = materialize(nodes.select("node", F.coalesce(clash, "least").alias("least"), "copies"), "jaccard-nodes")
    linked = links(docs, members, nodes.select("node", "copies"))
    label = components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")))
    nodes = nodes.join(label, "node", "left").join(linked.groupBy("node").agg(F.sum("n").alias("n")), "node", "left")
    n_links = (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links")
    label = F.coalesce("label", "node").alias("label")
    return members, materialize(nodes.select("node", "least", label, "copies", n_links), "jaccard-nodes")


def join_similar(docs: DataFrame) -> DataFrame:
    """Every document as (doc_id, n_shingles, component_id, n_links)."""
    members, nodes = _similar(docs)
    smallest = nodes.groupBy("label").agg(F.min("least").alias("component"))
    by_node = materialize(nodes.join(smallest, "label").select("node", "component", "n_links"), "jaccard-components")
    full = members.filter("node IS NOT NULL").join(by_node, "node").select("doc_id", "size", "component", "n_links")
    empty = members.filter("node IS NULL").select("doc_id", "size", F.col("doc_id").alias("component"), F.lit(0).cast("long").alias("n_links"))
    return full.union(empty).select(
        "doc_id", F.col("size").alias("n_shingles"), F.col("component").alias("component_id"), "n_links"
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each component, with all its columns: the one with the smallest id, a row without id if no row has
    one. Of several such rows the one with the smallest set hash stays, then the first by its columns."""
    _, nodes = _similar(docs)
    order = F.struct(F.col("least").isNull(), "least", "node")
    best = nodes.groupBy("label").agg(F.min_by("node", order).alias("_best"))
    # Sets of a single row that are alone in their component, or win it, have nothing to decide.
    open_ = nodes.join(best, "label").filter("copies > 1 OR node <> _best")
    wins = (F.col("node") == F.col("_best")).alias("_wins")
    open_ = materialize(open_.select(F.col("node").alias("_open"), wins, F.col("least").alias("_least")), "jaccard-open")

    def keyed(bodies, batch):
        import pyarrow as pa

        sets = [shingles(words) for words in WordHasher().batch(bodies)]
        keys = pa.array([set_key(grams)[0] if len(grams) else None for grams in sets], pa.int64())
        return pa.RecordBatch.from_arrays([*batch.columns, keys], [*batch.schema.names, "_node"])

    named = [f"_in_{i}" for i in range(len(docs.columns))]
    rows = with_bodies(docs, keyed, "_node long").toDF(*named, "_node")
    alone = rows.join(open_.select("_open"), F.col("_node") == F.col("_open"), "left_anti").select(*named)
    doc_id = F.col(named[docs.columns.index("doc_id")]).cast("long")
    first = rows.join(open_.filter("_wins"), F.col("_node") == F.col("_open")).filter(doc_id.eqNullSafe(F.col("_least")))
    first = first.withColumn("_place", F.row_number().over(Window.partitionBy("_node").orderBy(*(orderable(first, n) for n in named))))
    return alone.union(first.filter("_place = 1").select(*named)).toDF(*docs.columns)
