"""The text operators against plain versions, on awkward rows and on the smallest tables."""

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from strataload.llm import decontamination, jaccard_join, lm, pii, quality, token_store
from strataload.llm.exact_dedup import drop_exact_duplicates, exact_groups
from strataload.llm.license_scan import scan_licenses
from strataload.llm.pii import find_pii
from strataload.llm.piece_codec import BacktrackingEncoder, encode_documents
from strataload.llm.tables import match_spans
from strataload.llm.url_filter import judge_urls

SMALL = "/root/testdata/sf0.001"
WORDS = [f"word{i}" for i in range(400)]
LONG = " ".join(WORDS * 40)
NEAR = " ".join(WORDS[:200])
ROWS = [
    (1, "The GNU General  Public License, version 3. mail a.b@c.de and 10.0.0.1 or 4111 1111 1111 1111", "x", 1),
    (2, None, None, None),
    (3, "", "x", 3),
    (4, " \t\n ", "y", 4),
    (5, LONG, "y", 5),
    (6, LONG, "y", 6),
    (6, LONG, "y", 6),
    (7, NEAR, "z", 7),
    (8, NEAR.replace("word100", "other"), "z", 8),
    (9, "one two", "z", 9),
    (10, "cc by cc by, MIT LICENSE", "z", 10),
    (None, "no id é▁ 漢 <s> \x00 +1 (234) 555-7890", "z", 11),
]
SCHEMA = "doc_id long, text string, node string, n_words int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lowered(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def test_licenses(docs, empty):
    rows = {r["doc_id"]: r for r in scan_licenses(docs).collect()}
    assert (rows[1]["n_base"], rows[1]["first_word"], rows[1]["labels"]) == (1, 1, "gpl,gpl-3.0")
    assert (rows[10]["n_words"], rows[10]["n_base"], rows[10]["first_word"], rows[10]["last_word"]) == (6, 3, 0, 4)
    assert rows[10]["base_labels"] == "cc-by,mit" and 0 < rows[10]["score"] <= 1
    for blank in (2, 3, 4):
        assert (rows[blank]["n_words"], rows[blank]["n_base"], rows[blank]["first_word"]) == (0, 0, None)
    assert rows[5]["n_words"] == len(LONG.split())
    assert scan_licenses(empty).count() == 0


def test_pii(docs, empty):
    rows = {r["doc_id"]: r for r in find_pii(docs).collect()}
    assert [rows[1][f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [1, 1, 1, 0]
    assert rows[None]["n_phone"] == 1 and rows[2]["spans"] == ""
    assert rows[3]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    start = ROWS[0][1].index("a.b@")
    assert rows[1]["spans"].startswith(f"email:{start}:{start + 8},ip:")
    assert find_pii(empty).count() == 0


def test_spans_of_a_text_with_many_matches(spark):
    body = " ".join(f"é{i}x" for i in range(1500))
    table = spark.createDataFrame([(1, body), (2, "none"), (3, "7")], "doc_id long, text string")
    found = {r["doc_id"]: r["s"] for r in table.select("doc_id", match_spans(F.col("text"), "[0-9]+").alias("s")).collect()}
    want = [(m.start(), m.end(), m[0]) for m in re.finditer("[0-9]+", body)]
    assert [tuple(s) for s in found[1]] == want and found[2] == [] and [tuple(s) for s in found[3]] == [(0, 1, "7")]


def test_exact_groups(docs, empty):
    rows = exact_groups(docs).collect()
    assert len(rows) == len(ROWS)
    text = {}
    for doc_id, body, *_ in ROWS:
        text.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", body or ""), []).append(doc_id)
    for r in rows:
        group = next(g for t, g in text.items() if hashlib.sha256(t.encode()).hexdigest() == r["text_sha256"] and r["doc_id"] in g)
        assert (r["keep_id"], r["group_size"]) == (min((i for i in group if i is not None), default=None), len(group))
    assert sum(r["kept"] for r in rows) == len(text)
    kept = drop_exact_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len(text)
    assert drop_exact_duplicates(empty).count() == 0


def test_urls(spark):
    urls = ["http://a.example.net/en/1", "https://x.net/", "https://net", "HTTP://B.Example.COM/de/?q", None, "none", "http://casino-win.org/a", "http://q.org/fr/x#y", "http:///net/"]
    rows = {r["page_id"]: r for r in judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect()}
    assert [rows[i]["rule"] for i in range(9)] == ["example.net/en/", "net/", None, "example.com/de/", None, None, None, "org/fr/", None]
    assert [rows[i]["verdict"] for i in range(9)] == ["allow", "block", "allow", "block", "allow", "allow", "block", "allow", "allow"]
    assert (rows[3]["host"], rows[3]["path"]) == ("b.example.com", "/de/")


@pytest.mark.parametrize("limit", [2, 16])
def test_similar_documents(spark, docs, empty, monkeypatch, limit):
    monkeypatch.setattr(jaccard_join, "SMALL", limit)
    table = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    table = table.union(docs.filter("doc_id is not null").select(F.col("doc_id") + 1000, "text"))
    sets = {}
    for r in table.collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", lowered(r["text"]))
        sets[r["doc_id"]] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    for r in jaccard_join.join_similar(table).collect():
        assert (r["n_shingles"], r["component_id"]) == (len(sets[r["doc_id"]]), root[r["doc_id"]])
    assert jaccard_join.join_similar(empty).count() == 0


def test_signatures_meet_as_often_as_promised():
    draw = np.random.default_rng(5)
    for size in (2, 5, 9, 40, 300, 3000):
        one = np.unique(draw.integers(0, 1 << 63, size, dtype=np.uint64))
        gone = max(0, int(len(one) * 0.12))
        two = np.unique(np.concatenate((one[gone:], draw.integers(0, 1 << 63, gone, dtype=np.uint64))))
        both = len(np.intersect1d(one, two))
        assert 4 * both >= 3 * (len(one) + len(two) - both)
        band = int(max(jaccard_join.band_of(len(one)), jaccard_join.band_of(len(two))))
        (x, need_x), (y, need_y) = (jaccard_join.signatures(s, band) for s in (one, two))
        assert len(np.intersect1d(x, y)) >= max(need_x, need_y)


def test_token_store(spark, docs, empty, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = token_store.PieceEncoder(path)
    token_store.write_blocks(docs, path, 2, str(tmp_path / "blocks"))
    rows = sorted(token_store.read_blocks(spark, str(tmp_path / "blocks")).collect(), key=lambda r: r["start"])
    place = 0
    for row, (_, body, *_) in zip(rows, sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0)), strict=True):
        ids = [*encoder.library.encode(body or "", add_special_tokens=False).ids, 2]
        assert row["start"] == place and np.frombuffer(row["ids"], "<u4").tolist() == ids
        place += len(ids)
    token_store.write_blocks(empty, path, 2, str(tmp_path / "none"))
    assert token_store.read_blocks(spark, str(tmp_path / "none")).count() == 0


def test_grammar_round_trip(monkeypatch):
    monkeypatch.setattr(token_store, "MIN_PAIR", 2)
    draw = np.random.default_rng(1)
    for size in range(1, 200, 7):
        ids = draw.integers(3, 6, size).astype(np.int32)
        counts = np.diff([0, *sorted({size, *draw.integers(1, size + 1, 3).tolist()})])
        ids[np.cumsum(counts) - 1] = 2
        block = token_store.Block(token_store.pack(list(range(len(counts))), counts, ids, 2))
        parts = np.split(ids, np.cumsum(counts)[:-1])
        assert all(block.document(i).tolist() == p.tolist() for i, p in enumerate(parts))


def test_language_model(spark, docs, empty):
    rows = lm.score_documents(docs).collect()
    tokens = [(i, [*re.findall(r"[^\x20\x09-\x0D]+", lowered(t)), None]) for i, t, *_ in ROWS]
    train = [w for i, w in tokens if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    count = collections.Counter(x for w in train for x in w)
    total, kinds = sum(count.values()), len(count)
    follow = collections.Counter(p for w in train for p in zip([0, *w], w, strict=False))
    want = []
    for i, w in tokens:
        base = score = 0.0
        for h, x in zip([0, *w], w, strict=False):
            p = (count[x] + 1) / (total + kinds + 1)
            seen = len(train) if h == 0 else count[h]
            base += np.log10(p)
            score += np.log10((1 - lm.BACKOFF) * follow[h, x] / seen + lm.BACKOFF * p if seen else p)
        want.append((-1 if i is None else i, len(w), sum(count[x] > 0 for x in w), round(base, 6), round(score, 6)))
    got = [
        (-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 6), round(r["score"], 6))
        for r in rows
    ]
    assert sorted(got) == sorted(want) and {r["train_tokens"] for r in rows} == {total}
    assert lm.score_documents(empty).count() == 0


def test_quality(spark, docs, empty):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    scored = quality.score_quality(table, labels).join(labels, "doc_id").filter("held_out")
    right = scored.filter("predicted = quality").count()
    assert right >= 0.85 * scored.count() > 0
    rows = quality.score_quality(docs, labels).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.drop_low_quality(empty, labels.limit(0)).columns == empty.columns


def test_isotonic_is_monotone_and_pools():
    assert quality.isotonic(np.array([1.0, 0.0, 3.0]), np.array([2.0, 2.0, 3.0])).tolist() == [0.25, 0.25, 1.0]


def test_passages(spark, docs, empty):
    passage = "The quick brown foxes jumped over seventeen lazy dogs while nobody was watching the gate, and they ran away."
    bench = spark.createDataFrame([(1, passage), (2, None), (3, "short"), (4, passage)], "item_id long, text string")
    edited = passage.upper().replace("SEVENTEEN", "SEVENTEN").replace(",", " -")
    rows = [(50, LONG + " " + edited + " " + LONG), (51, passage[:60]), (52, passage)]
    extra = docs.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))
    found = {(r["doc_id"], r["item_id"]): r["edits"] for r in decontamination.find_passages(extra, bench).collect()}
    assert found == {(50, 1): 1, (50, 4): 1, (52, 1): 0, (52, 4): 0}
    assert decontamination.drop_contaminated(docs, bench).count() == len(ROWS)
    assert decontamination.find_passages(empty, bench).count() == 0


def test_sub_words(docs, empty):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    codec = BacktrackingEncoder(path)
    draw = np.random.default_rng(2)
    texts = ["".join(draw.choice(list("aeinrst h lo.,- \n'é01"), 30)) for _ in range(2000)]
    for text in [*texts, *(t or "" for _, t, *_ in ROWS)]:
        assert codec.encode(text) == library.encode(text, add_eos=True)
    rows = encode_documents(docs, path).collect()
    assert sorted(r["decoded"] for r in rows) == sorted(library.decode(library.encode(t or "", add_eos=True)) for _, t, *_ in ROWS)
    assert encode_documents(empty, path).count() == 0


def test_blocks_decide_as_pairs_do(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_BYTES", 400)
    sets = [(n, np.arange(n % 7, 20 + n % 5, dtype="<u8").tobytes()) for n in range(30)]
    sets = spark.createDataFrame(sets, "node long, grams binary")
    pairs = spark.createDataFrame([(a, b) for a in range(30) for b in range(a + 1, 30)], "a long, b long")
    family = spark.createDataFrame([(n, 0) for n in range(1, 20)], "node long, hub long")
    want = {tuple(r) for r in jaccard_join.verify(pairs, sets).collect()}
    got = [tuple(r) for r in jaccard_join.verify_dense(pairs, sets, family).collect()]
    assert len(got) == len(set(got)) and set(got) == want and 0 < len(want) < 435


@pytest.mark.parametrize(("limit", "block"), [(2, 4000), (16, 1 << 20)])
def test_similar_documents_have_all_links(spark, docs, monkeypatch, limit, block):
    monkeypatch.setattr(jaccard_join, "SMALL", limit)
    monkeypatch.setattr(jaccard_join, "BLOCK_BYTES", block)
    # A family whose members are not all linked to each other, with equal texts among them.
    words = [f"w{i}" for i in range(160)]
    family = [[f"{w}x{n}" if n % 40 <= i - 60 < n % 40 + n % 9 else w for i, w in enumerate(words)] for n in range(60)]
    extra = [(2000 + n, " ".join(w)) for n, w in enumerate(family)]
    table = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    table = table.union(docs.select("doc_id", "text")).union(spark.createDataFrame(extra, "doc_id long, text string"))
    sets = []
    for r in table.collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", lowered(r["text"]))
        sets.append((r["doc_id"], {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()))
    want = collections.Counter()
    for i, one in sets:
        both = [len(one & s) for _, s in sets]
        linked = sum(b > 0 and 100 * b >= 75 * len(one | s) for b, (_, s) in zip(both, sets, strict=True))
        want[i, len(one), linked - 1 if one else 0] += 1
    got = collections.Counter((r["doc_id"], r["n_shingles"], r["n_links"]) for r in jaccard_join.join_similar(table).collect())
    assert got == want and 0 < sum(0 < n < 59 for (i, _, n) in got if i is not None and i >= 2000)


def test_stages_decide_per_row(spark):
    """Rows without id or with a repeated one are judged by their own text."""
    passage = "The quick brown foxes jumped over seventeen lazy dogs while nobody was watching the gate, and they ran away."
    schema = "n int, doc_id long, text string"
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    rows = [(1, None, passage), (2, None, "clean"), (3, 7, passage), (4, 7, "clean too"), (5, None, None), (6, 8, "other")]
    left = decontamination.drop_contaminated(spark.createDataFrame(rows, schema), bench)
    assert left.columns == ["n", "doc_id", "text"] and sorted(r["n"] for r in left.collect()) == [2, 4, 5, 6]

    # Texts of the labelled table, so that the model rejects some: the same id, or none, for good and bad ones.
    table = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    predicted = {r["doc_id"]: r["predicted"] for r in quality.score_quality(table, labels).collect()}
    extra = table.withColumn("doc_id", F.when(F.col("doc_id") % 2 == 0, F.lit(10**9)).cast("long"))
    both = table.withColumn("n", F.col("doc_id")).union(extra.withColumn("n", F.lit(-1).cast("long")))
    kept = collections.Counter(r["text"] for r in quality.drop_low_quality(both, labels).collect())
    text = {r["doc_id"]: r["text"] for r in table.collect()}
    want = collections.Counter()
    for i, p in predicted.items():
        want[text[i]] += 2 * p
    assert kept == +want and 0 < sum(predicted.values()) < len(predicted)

    a, b = NEAR, " ".join(f"v{i}" for i in range(100))
    rows = [
        (1, 1, a), (2, 2, a.replace("word100", "x")), (3, 2, b),  # id 2 is a later copy once, and alone once
        (4, None, "p " * 30 + b), (5, None, LONG[:900]), (6, None, LONG[:900].replace("word5 ", "y ")),  # no id at all
        (7, 9, "same words here"), (8, 9, "SAME words here"), (9, None, ""), (10, None, " "), (11, None, a),
    ]
    left = jaccard_join.drop_near_duplicates(spark.createDataFrame(rows, schema))
    got = {r["n"] for r in left.collect()}
    assert left.columns == ["n", "doc_id", "text"] and left.count() == len(got)
    assert {1, 3, 9, 10} <= got and not got & {2, 4, 11} and len(got & {5, 6}) == 1 and len(got & {7, 8}) == 1


def _check_digit(body):
    return next(c for c in "0123456789" if sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate((body + c)[::-1])) % 10 == 0)


def test_pii_patterns_need_evidence_of_their_own(spark):
    bodies = [f"4111{n:011d}" for n in range(7, 47)]
    good = [b + _check_digit(b) for b in bodies]
    bad = [b + str((int(_check_digit(b)) + 5) % 10) for b in bodies]
    rows = [(n, f"paid {v} today") for n, v in enumerate(good + bad)]
    # A quarter of what stands behind "host" is an address; the rest has its shape but is none.
    rows += [(100 + n, f"host 10.0.{n}.{n if n < 5 else n + 900} up") for n in range(20)]
    found = {r["doc_id"]: r for r in find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [found[n]["n_card"] for n in range(80)] == [1] * 40 + [0] * 40
    assert [found[100 + n]["n_ip"] for n in range(20)] == [1] * 5 + [0] * 15
    assert all(r["n_found"] == 0 for r in found.values())


def test_grammar_leaves_no_frequent_pair():
    draw = np.random.default_rng(3)
    passage = draw.integers(3, 1000, 64)
    ids = np.concatenate([np.append(passage, draw.integers(1000, 9000, 5)) for _ in range(30)]).astype(np.int32)
    ids = np.append(ids, np.int32(2))
    seq, left, right = token_store.grammar(ids, ids == 2, 9000)
    pairs = collections.Counter(zip(seq[:-1].tolist(), seq[1:].tolist(), strict=True))
    assert max(pairs.values()) < token_store.MIN_PAIR and len(left) == len(right)
    block = token_store.Block(token_store.pack([1], np.array([len(ids)]), ids, 2))
    assert block.document(0).tolist() == ids.tolist()


def test_long_texts_with_many_spans(spark):
    """Many identifiers, tokens and licence names in one text."""
    ids = " ".join(f"10.0.{n % 256}.{n % 200} id{n:07d}x" for n in range(2000))
    licences = "MIT License and Apache License 2.0, " * 2000
    table = spark.createDataFrame([(1, ids), (2, licences)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in find_pii(table).collect()}
    assert rows[1]["n_ip"] == 2000 and rows[2]["n_ip"] == 0
    rows = {r["doc_id"]: r for r in scan_licenses(table).collect()}
    assert rows[2]["n_base"] == 4000 and rows[2]["base_labels"] == "apache,mit" and rows[1]["n_base"] == 0


def test_tokens_that_meet_a_span_are_left_out(spark):
    draw = np.random.default_rng(6)
    rows = []
    for n in range(60):
        spans = sorted((int(a), int(a + w), int(k)) for a, w, k in draw.integers([0, 1, 0], [300, 30, 4], (n % 9, 3)))
        cuts = sorted(set(draw.integers(0, 330, 20).tolist()))
        tokens = [(a, b) for a, b in zip(cuts[::2], cuts[1::2], strict=False)]
        rows.append((n, [(a, k, b, "s") for a, b, k in spans], [(a, -1, b, f"t{a}") for a, b in tokens]))
    table = spark.createDataFrame(rows, f"n int, base {pii.SPAN}, tokens {pii.SPAN}")
    got = {r["n"]: [tuple(t) for t in r["free"]] for r in table.select("n", pii._outside(F.col("base"), F.col("tokens")).alias("free")).collect()}
    for n, base, tokens in rows:
        assert got[n] == [t for t in tokens if not any(b[0] < t[2] and t[0] < b[2] for b in base)]


def test_rows_that_hold_maps(spark):
    rows = [(1, NEAR, {"a": n}) for n in (2, 1)] + [(2, NEAR.replace("word100", "x"), None), (None, None, {})]
    table = spark.createDataFrame(rows, "doc_id long, text string, extra map<string,int>")
    kept = drop_exact_duplicates(table).collect()
    assert sorted((r["doc_id"] or 0, r["extra"] or {}) for r in kept) == [(0, {}), (1, {"a": 1}), (2, {})]
    assert sorted(r["doc_id"] or 0 for r in jaccard_join.drop_near_duplicates(table).collect()) == [0, 1]


def test_codes_of_sizes_and_needs_never_exceed_them():
    sizes = np.concatenate([np.arange(1, 50_000), np.random.default_rng(1).integers(1, 1 << 38, 20_000)])
    code = jaccard_join.size_code(sizes)
    least, most = jaccard_join.size_range(code)
    assert (code // 512 == jaccard_join.band_of(sizes)).all() and (least <= sizes).all() and (sizes <= most).all()
    needs = np.arange(-5, 200_000)
    kept = jaccard_join.NEEDS[jaccard_join.need_code(needs)]
    assert (kept <= np.maximum(needs, 0)).all() and (100 * kept >= 92 * np.maximum(needs, 0) - 100).all()


PIECES = [" ", "  ", "\n", "\t", "\r", "a", "b'll", "é", "漢", "12", "!!", "word", "'", "'s", "re", "'ve", "S", "\x85", "\u2003", "<|", "_", "½"]


@pytest.mark.parametrize("group", [200, 1 << 21])
def test_pieces_are_encoded_as_the_library_does(monkeypatch, group):
    monkeypatch.setattr(token_store, "GROUP", group)
    encoder = token_store.PieceEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    draw = np.random.default_rng(8)
    bodies = ["".join(draw.choice(PIECES[: draw.choice([6, 14, 22])], draw.choice([0, 1, 4, 60]))) for _ in range(3000)]
    bodies += ["<|endoftext|>", "x <|endoftext|> y", ""]
    assert encoder.by_pieces
    ids, counts = encoder.encode(bodies, 2)
    want = [[*e.ids, 2] for e in encoder.library.encode_batch(bodies, add_special_tokens=False)]
    assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])] == want


def test_pieces_with_one_hash_are_told_apart(monkeypatch):
    encoder = token_store.PieceEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    first = encoder.hashers[0]
    monkeypatch.setattr(encoder, "hashers", (lambda v, s, e: first(v, s, e) & np.uint64(3), encoder.hashers[1]))
    bodies = ["some words that all fall into four bins", "others do as well", ""]
    for _ in range(2):
        ids, counts = encoder.encode(bodies, 2)
        want = [[*e.ids, 2] for e in encoder.library.encode_batch(bodies, add_special_tokens=False)]
        assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])] == want


def test_pii_contexts_find_what_is_written_otherwise(spark):
    """A context learned from seeds finds a form no seed has; accepted values promote a further context; decoys stay."""
    rows = [(n, f"please dial +1 ({200 + n}) 555-{1000 + n} now") for n in range(60)]
    rows += [(100, "please dial (017) 555-7713 now"), (101, "please dial 018 555 7714 soon"), (102, "please dial 99887 now")]
    # A word that mostly precedes other numbers is no context, though phones follow it, too.
    rows += [(200 + n, f"about +1 (300) 555-{2000 + n}, or so") for n in range(4)]
    rows += [(210 + n, f"about {5550000 + n} units") for n in range(16)]
    # Values found behind "dial" stand behind "ring" as well, where no seed does.
    both = [f"0{n}9 666-77{n}" for n in range(10, 22)]
    rows += [(300 + n, f"please dial {v} now") for n, v in enumerate(both)]
    rows += [(400 + n, f"ring {v} today") for n, v in enumerate(both)] + [(420, "ring 044/777-1234 again")]
    rows += [(500 + n, f'token = "{n:02d}{"a7" * 19}"') for n in range(6)] + [(510, f'jeton = "{"b8" * 20}"')]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    text = dict(rows)
    spans = {}
    for r in find_pii(docs).collect():
        spans[r["doc_id"]] = [(k, text[r["doc_id"]][int(a) : int(b)]) for k, a, b in (s.split(":") for s in filter(None, r["spans"].split(",")))]
    assert spans[100] == [("phone", "(017) 555-7713")] and spans[101] == [("phone", "018 555 7714")] and spans[102] == []
    assert all(spans[210 + n] == [] for n in range(16))
    assert all(spans[300 + n] == spans[400 + n] == [("phone", v)] for n, v in enumerate(both))
    assert spans[420] == [("phone", "044/777-1234")]
    assert all(spans[500 + n] == [("secret", f"{n:02d}{'a7' * 19}")] for n in range(6))
    shorter = find_pii(docs.filter("doc_id < 100 or doc_id = 420")).filter("doc_id = 420").first()
    assert shorter["spans"] == "" and shorter["n_found"] == 0


def test_words_around_are_cut_from_pieces_of_long_texts(spark):
    """Every candidate of a text of several pieces has the words that stand around it in the whole text."""
    body = " ".join(f"id{n:07d}x é wört{'abc'[n % 3]} 漢: 044{n:06d}, {'xyz'[n % 3]}é then" for n in range(500))
    assert len(body) > 4 * pii.PIECE
    found = pii.scan(spark.createDataFrame([(1, body)], "doc_id long, text string")).first()["instances"]
    numbers = [i for i in found if i["value"].startswith("044")]
    assert len(numbers) == 500 and len(found) == 1000
    for n, i in enumerate(numbers):
        assert body[i["start"] : i["end"]] == i["value"] == f"044{n:06d}"
        assert (i["left"], i["left_2"], i["right"]) == ("漢 :", f"wört{'abc'[n % 3]}", f"{'xyz'[n % 3]}é")
