"""Vector codes, byte network and fill-in-middle against plain versions, on awkward rows and the smallest tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataload.llm import byte_network, cover_codes, infill
from strataload.llm.oracles import ORACLES
from strataload.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int, code string, points int"


def plain_codes(rows):
    """{vec_id: (code, error)} and the digest of the codebooks, by Lloyd's rounds over lists."""
    rows = [(i, [math.floor(4096 * float(np.float32(x))) for x in v]) for i, v in rows]
    width = len(rows[0][1]) // 8
    cut = [[v[p * width : (p + 1) * width] for p in range(8)] for _, v in rows]
    books = [[list(c[p]) for c in cut[:16]] for p in range(8)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(6):
        for p, book in enumerate(books):
            member = [nearest(c[p], book)[1] for c in cut]
            for k in set(member):
                mine = [c[p] for c, m in zip(cut, member, strict=True) if m == k]
                book[k] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    found = {}
    for (i, _), c in zip(rows, cut, strict=True):
        best = [nearest(c[p], books[p]) for p in range(8)]
        found[i] = ("".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best))
    flat = ",".join(str(x) for book in books for e in book for x in e)
    return found, hashlib.sha256(flat.encode()).hexdigest()


def vectors(n, width=16, seed=4):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((5, width))
    rows = (centres[draw.integers(0, 5, n)] + 0.2 * draw.standard_normal((n, width))).astype(np.float32)
    rows[n // 3 : n // 2] = rows[0]  # one common vector
    return rows


@pytest.mark.parametrize(("n", "block"), [(5, 4096), (200, 32), (300, 4096)])
def test_codes_equal_plain_rounds(spark, monkeypatch, n, block):
    monkeypatch.setattr(cover_codes, "BLOCK", block)
    rows = [(3 * i, v.tolist()) for i, v in enumerate(vectors(n))]
    table = spark.createDataFrame([(i, v, None if i % 4 == 0 else i % 3, "c", 1) for i, v in rows], VECTORS).repartition(3)
    want, digest = plain_codes(rows)
    got = cover_codes.code_rows(table).collect()
    assert {r["vec_id"]: (r["code"], r["error"]) for r in got} == want
    assert {r["codebooks_sha256"] for r in got} == {digest}
    label = collections.Counter()
    for i, _ in rows:
        label[None if i % 4 == 0 else i % 3] += want[i][1]
    assert all(r["label_error"] == label[None if r["vec_id"] % 4 == 0 else r["vec_id"] % 3] for r in got)


def test_codes_of_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [0.25 * (i + j) - 1 for j in range(8)], i % 2, "c", 0) for i in range(4)]
    bad = [
        (10, None, 1, "c", 0), (11, [], 1, "c", 0), (12, [None] * 8, 1, "c", 0), (13, [nan] + [0.0] * 7, 1, "c", 0),
        (14, [inf] * 8, 1, "c", 0), (15, [-inf] * 8, 1, "c", 0), (16, [1.0] * 7, 1, "c", 0), (17, [1.0] * 16, 1, "c", 0),
    ]
    more = [(None, [3.0e30] * 8, None, "c", 0), (2, good[2][1], 0, "c", 0), (2, good[2][1], 0, "c", 0)]
    got = cover_codes.code_rows(spark.createDataFrame(good + bad + more, VECTORS)).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0) for r in got) == [(False, i) for i in (0, 1, 2, 2, 2, 3)] + [(True, 0)]
    assert all(r["error"] >= 0 and len(r["code"]) == 16 for r in got)
    assert cover_codes.code_rows(spark.createDataFrame(bad[:6], VECTORS)).count() == 0
    assert cover_codes.code_rows(spark.createDataFrame([], VECTORS)).columns == [
        "vec_id", "code", "error", "label_error", "codebooks_sha256",
    ]


@pytest.mark.parametrize("scale", [1, 1 << 10])
def test_tree_assigns_as_comparison_does(scale):
    draw = np.random.default_rng(8)
    points = np.unique((draw.integers(-3000, 3000, (2500, 4)) // 7 * 7) * scale, axis=0)
    weights = draw.integers(1, 9, len(points))
    tree, place = cover_codes.CoverTree.build(points, weights)
    assert (tree.points[place] == points).all()
    for node, centre in enumerate(tree.centre):
        mine = tree.points[tree.first[node] : tree.last[node]]
        assert np.sqrt(((mine - tree.points[centre]) ** 2).sum(axis=1)).max() <= tree.radius[node] + 1e-6
    for n in (1, 2, 16):
        entries = draw.integers(-3000, 3000, (n, 4)) * scale
        entries[-1] = entries[0]  # equal entries: the first takes all
        want = ((tree.points[:, None] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)
        chosen = tree.assign(entries)
        assert (chosen == want).all()
        counts, sums = tree.sums(chosen, n)
        for k in range(n):
            assert counts[k] == tree.weights[want == k].sum()
            assert (sums[k] == (tree.points * tree.weights[:, None])[want == k].sum(axis=0)).all()


def test_tree_decides_most_points_by_subtrees(monkeypatch):
    points = np.unique(np.floor(4096 * vectors(4000, 8)).astype(np.int64), axis=0)
    tree, _ = cover_codes.CoverTree.build(points, np.ones(len(points), dtype=np.int64))
    entries = tree.points[:: len(points) // 5][:5]
    compared = []
    plain = cover_codes.squared
    monkeypatch.setattr(cover_codes, "squared", lambda p, e: compared.append(len(p)) or plain(p, e))
    tree.assign(entries)
    assert sum(compared) < len(points)


def numeric_slope(network, name, at, windows, wanted):
    kept = network.weights[name][at]
    losses = []
    for step in (1e-2, -1e-2):
        network.weights[name][at] = kept + step
        losses.append(network.gradients(windows, wanted)[0])
    network.weights[name][at] = kept
    return (losses[0] - losses[1]) / 2e-2


def test_network_answers_as_loops_do():
    network = byte_network.ByteNetwork.fresh(["a", "b", "c"])
    network.weights = {k: w.astype(np.float64) for k, w in network.weights.items()}
    network.weights["bias"] += 0.1
    draw = np.random.default_rng(1)
    windows = draw.integers(0, 256, (3, byte_network.WINDOW), dtype=np.uint8)
    w = network.weights
    for window, p in zip(windows, network.probabilities(windows), strict=True):
        padded = [*window.tolist(), 0, 0, 0]
        pooled = []
        for f in range(w["filters"].shape[1]):
            width = byte_network.WIDTHS[f // byte_network.FILTERS]
            filter_ = w["filters"][: width * byte_network.DEPTH, f].reshape(width, -1)
            assert not w["filters"][width * byte_network.DEPTH :, f].any()
            answers = [
                sum(float(filter_[j] @ w["embedding"][padded[i + j]]) for j in range(width)) for i in range(len(window))
            ]
            pooled.append(max(0.0, max(answers) + w["bias"][f]))
        logits = np.array(pooled) @ w["output"] + w["offset"]
        assert np.allclose(p, np.exp(logits) / np.exp(logits).sum())
    wanted = np.array([0, 2, 1])
    _, slopes = network.gradients(windows, wanted)
    for name, slope in slopes.items():
        at = np.unravel_index(int(np.abs(slope).argmax()), slope.shape)
        assert numeric_slope(network, name, at, windows, wanted) == pytest.approx(slope[at], rel=0.2, abs=1e-4)


def test_windows_hold_whole_texts():
    bodies = [b"", b"Ab", b"x" * 128, b"y" * 300]
    windows, owner, sizes = byte_network.cut_windows(bodies)
    assert owner.tolist() == [1, 2, 3, 3, 3] and sizes.tolist() == [2, 128, 128, 128, 44]
    assert windows[0].tobytes() == b"ab".ljust(128, b"\0") and windows[4].tobytes() == (b"y" * 44).ljust(128, b"\0")


def test_language_of_held_out_documents(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = byte_network.predict_languages(table).join(table.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == table.count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held) > 100


def test_language_of_awkward_rows(spark):
    base = [(i, "the cat and the dog were there" if i % 2 else "der hund und die katze sind hier", "en" if i % 2 else "de", 0.5)
            for i in range(60)]
    odd = [
        (100, None, "en", None), (101, "", "en", None), (102, " 12 -- 7\n", "en", None), (103, "the dog " * 50_000, None, None),
        (None, "the cat and the dog", "en", None), (104, "漢", None, None), (104, "der hund", None, None),
    ]
    table = spark.createDataFrame(base + odd, "doc_id long, text string, lang string, score double")
    network = byte_network.train_network(table)
    assert network.languages == ["de", "en"]
    answered = byte_network.identify_language(table, network)
    assert sorted(answered.columns) == ["doc_id", "lang", "lang_pred", "score", "text"]
    rows = answered.collect()
    assert len(rows) == len(base) + len(odd)
    got = {(r["doc_id"], r["text"]): r for r in rows}
    for i in (100, 101, 102):
        r = next(r for r in rows if r["doc_id"] == i)
        assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    assert got[103, odd[3][1]]["lang_pred"] == got[None, odd[4][1]]["lang_pred"] == "en"
    assert got[104, "der hund"]["lang_pred"] == "de" and got[104, "漢"]["lang_pred"] in ("de", "en")
    empty = table.limit(0)
    assert byte_network.train_network(empty) is None
    nothing = byte_network.identify_language(table, None).collect()
    assert {(r["lang_pred"], r["score"]) for r in nothing} == {("und", 0.0)}
    assert byte_network.predict_languages(empty).count() == 0


TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_infill(doc_id, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    first, second = sorted((h[0] % (len(tokens) + 1), h[1] % (len(tokens) + 1)))
    p, m, s = ("".join(tokens[a:b]) for a, b in ((0, first), (first, second), (second, None)))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50:
        return len(tokens), "plain", None, None, text
    if h[3] % 100 < 80:
        return len(tokens), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(tokens), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize(("kept", "piece"), [(infill.KEPT, infill.PIECE), (0, 700)])
def test_cuts_equal_plain_ones(monkeypatch, kept, piece):
    monkeypatch.setattr(infill, "PIECE", piece)
    draw = random.Random(3)
    shared = "".join(draw.choice("abcdefgh é") for _ in range(6000))
    bodies = ["".join(draw.choice([" ", "\n", "a", "é", "漢", "word "]) for _ in range(draw.choice([0, 1, 2, 9, 300]))) for _ in range(600)]
    bodies += [b + shared + b for b in bodies[:40]] + ["a" * 50_000, " " * 40_000, "ab " * 30_000]
    draws = [(draw.getrandbits(32), draw.getrandbits(32)) for _ in bodies]
    want = []
    for body, (h1, h2) in zip(bodies, draws, strict=True):
        tokens = TOKEN.findall(body)
        a, b = sorted((h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)))
        p, m = "".join(tokens[:a]), "".join(tokens[a:b])
        want.append((len(tokens), len(p.encode()), len((p + m).encode()), len(p), len(m)))
    store = infill.SummaryStore(kept)
    for some in range(0, len(bodies), 50):
        part = [b.encode() for b in bodies[some : some + 50]]
        assert infill.cut_texts(part, draws[some : some + 50], store) == want[some : some + 50]


def test_chunks_are_shared_wherever_a_passage_stands():
    draw = random.Random(9)
    passage = bytes(draw.randrange(97, 123) for _ in range(40_000))
    one = infill.chunks(passage)
    two = infill.chunks(bytes(draw.randrange(97, 123) for _ in range(777)) + passage)
    assert b"".join(one) == passage and len(set(one) & set(two)) >= len(one) - 2 > 10


def test_infill_of_awkward_rows(spark):
    rows = [(i, f"some words  of é漢 number {i}\n" * (i % 7) + "x" * (i % 3), "kept", i) for i in range(120)]
    rows += [(7, "another text under the same id", "kept", 0), (None, "no id at all", "kept", 0), (5, None, "kept", 0)]
    rows += [(200 + i, f"a <{'PSM'[i % 3]}> marker", "kept", 0) for i in range(9)]
    rows += [(300, " \t\n", "kept", 0), (301, "w " * 700_000, "kept", 0), (302, "a<P b<S c<M >", "kept", 0), (304, "<" * 50, "kept", 0)]
    table = spark.createDataFrame(rows, "doc_id long, text string, form string, n int")
    got = infill.infill(table).withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == plain_infill(r["doc_id"], r["text"])
        assert r["back"] == (r["text"] or "")
    assert {"plain", "spm", "psm"} == {r["form"] for r in got}
    assert infill.infill(table.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, name):
    from compare import connect, differences

    assert differences(QUERIES[name](spark, SMALL), connect(SMALL), ORACLES[name]) is None
