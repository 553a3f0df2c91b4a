"""The pipeline against plain versions of its stages, and on an empty table."""

import hashlib
import re

import corpus_pipeline
import public_tokenizers
import sentencepiece

from strataload.llm import decontamination, quality

SMALL = "/root/testdata/sf0.001"
TABLES = ["documents", "labels", "benchmark"]


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate({i: i + 32 for i in range(65, 91)}))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def holds(item, text):
    """One of the pieces between the edits stands unchanged in the text; the whole text is aligned then."""
    budget = int(len(item) * decontamination.EDITS)
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    if not any(item[a:b] in text for a, b in zip(cuts, cuts[1:], strict=False)):
        return False
    return decontamination.banded_distance(item, text, budget) is not None


def test_rows_equal_plain_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    good = {r["doc_id"] for r in quality.score_quality(docs, labels).filter("predicted = 1").collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect() if r["doc_id"] in good}
    kept, seen = {}, set()
    for i in sorted(texts):
        plain = re.sub(r"[\x20\x09-\x0D]+", " ", texts[i])
        if plain not in seen:
            seen.add(plain)
            kept[i] = texts[i]
    sets = {i: shingles(t) for i, t in kept.items()}
    root = {i: i for i in kept}
    for a in sorted(sets):
        for b in sorted(sets):
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    items = [decontamination.fold((r["text"] or "").encode()) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    items = [b for b in items if len(b) >= decontamination.Q]
    folded = {i: decontamination.fold(kept[i].encode()) for i in kept if root[i] == i}
    left = [i for i, t in folded.items() if not any(holds(item, t) for item in items)]
    assert len(texts) > len(kept) > len(folded) > len(left) > 0
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = set()
    for i in left:
        ids = library.encode(kept[i], add_eos=True)
        want.add((i, len(ids), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert {(r["doc_id"], r["n_tokens"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in got} == want
    assert len(got) == len(want)


def test_an_empty_table_gives_no_rows(spark, tmp_path):
    for name in TABLES:
        table = spark.read.parquet(f"{SMALL}/{name}.parquet")
        (table.limit(0) if name == "documents" else table).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
