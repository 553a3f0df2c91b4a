"""Bounded portions of quality rows, ranges of signatures by band, remembered pieces."""

import numpy as np
import pyarrow as pa
import pytest

from strataload.llm import jaccard_join, quality, token_store


def test_quality_rows_are_worked_on_in_portions():
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(2 * quality.ROWS + 3))})
    parts = list(quality._portions([batch, batch.slice(0, 0), batch.slice(0, 1)]))
    assert [p.num_rows for p in parts] == [quality.ROWS, quality.ROWS, 3, 1]
    assert [i for p in parts[:3] for i in p.column("doc_id").to_pylist()] == list(range(2 * quality.ROWS + 3))


def _members(spark, sizes):
    return spark.createDataFrame([(s,) for s in sizes], "size long")


def test_a_band_has_ranges_for_its_own_signatures(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "RANGE_SIGNATURES", 100)
    first = jaccard_join._ranges(_members(spark, [5] * 200 + [300, 0]))
    count = np.diff(first)
    own, other = int(jaccard_join.band_of(5)), int(jaccard_join.band_of(300))
    assert count[own] == 5 * 200 // 100 + 1 and count[own + 1] == count[own]
    given = [min(300, int(jaccard_join.parts(other + i))) for i in (0, 1)]
    assert [count[other], count[other + 1]] == [g // 100 + 1 for g in given]
    assert count.min() == 1 and first[0] == 0


def test_a_set_is_named_in_ranges_of_its_bands_only():
    texts = [" ".join(f"w{n}x{i}" for i in range(200)) for n in range(40)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(40)), "text": texts})
    first = np.arange(len(jaccard_join.ENDS) + 2, dtype=np.int64) * 7
    rows = [r for out in jaccard_join._sign(first)([batch]) for r in out.to_pylist()]
    band = int(jaccard_join.band_of(196))
    assert {r["range"] for r in rows} == set(range(7 * band, 7 * band + 14))
    n = 0
    for r in rows:
        who = np.cumsum(np.frombuffer(r["who"], "<u2"))
        assert len(np.unique(who >> 1)) == len(r["nodes"]) // 8 and (np.diff(who) >= 0).all()
        n += len(who)
    sets = [g for _, g, _ in jaccard_join._sets([batch])]
    assert n == sum(len(jaccard_join.signatures(g, band + step)[0]) for g in sets for step in (0, 1))


def test_a_range_without_a_shared_signature_has_no_pair():
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["only one text of seven different words"]})
    first = np.arange(len(jaccard_join.ENDS) + 2, dtype=np.int64)
    out = pa.Table.from_batches(list(jaccard_join._sign(first)([batch])))
    assert jaccard_join._meet(out.slice(0, 1)).num_rows == 0


def test_pieces_that_meet_in_a_slot_are_found_again(monkeypatch):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    monkeypatch.setattr(token_store, "SLOTS", 1 << 8)
    encoder = token_store.PieceEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    bodies = [" ".join(f"q{chr(97 + i % 26)}{i}z" for i in range(n, n + 20)) for n in (0, 10, 30)] + ["", "no", "no no"]
    for _ in range(2):
        ids, counts = encoder.encode(bodies, 2)
        plain = [[*encoder.library.encode(b, add_special_tokens=False).ids, 2] for b in bodies]
        assert ids.tolist() == sum(plain, []) and counts.tolist() == [len(p) for p in plain]
    known = len(encoder.hashes)
    assert known == len(np.unique(encoder.hashes)) and (encoder.table >= 0).sum() == known
    monkeypatch.setattr(token_store, "KEPT", known - 1)
    assert encoder.encode(["another piece"], 2)[0].tolist() == [*encoder.library.encode("another piece").ids, 2]
    assert len(encoder.hashes) < known


def test_rules_in_rules_are_expanded_level_by_level():
    left, right = np.array([1, 4, 5, 2, 6]), np.array([2, 4, 3, 2, 5])
    groups = [g.tolist() for g in token_store.levels(left, right, 4)]
    assert groups == [[0, 3], [1], [2], [4]]
    ids = np.array([1, 2, 3, 1, 2, 1, 2, 0] * 400 + [0, 3, 0], dtype=np.int32)
    counts = np.diff(np.append(0, np.flatnonzero(ids == 0) + 1))
    block = token_store.Block(token_store.pack(list(range(len(counts))), counts, ids, 0))
    assert block.documents(0, len(counts)).tolist() == ids.tolist()
    assert block.documents(399, 402).tolist() == [1, 2, 3, 1, 2, 1, 2, 0, 0, 3, 0]
    assert block.document(401).tolist() == [3, 0] and block.document(400).tolist() == [0]


def test_a_block_is_scanned_once_for_a_quarter_of_the_threshold(monkeypatch):
    asked = []
    replace = token_store._replace
    monkeypatch.setattr(token_store, "_replace", lambda s, p, t, n: asked.append(t) or replace(s, p, t, n))
    ids = np.concatenate([np.tile([2 * n + 1, 2 * n + 2], 24 << n) for n in range(12)]).astype(np.int32)
    token_store.grammar(np.append(ids, 0), np.append(np.zeros(len(ids), bool), True), 30)
    scans = [t for t in asked if t > token_store.MIN_PAIR]
    assert scans and all(4 * b <= a for a, b in zip(scans, scans[1:]))
