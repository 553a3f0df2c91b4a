"""Exact sub-word encoding by backtracking, and decoding.

The library merges the best-scored adjacent pair until no pair is a piece. The same result is found from
left to right: take the longest piece that starts here (Aho-Corasick gives all of them in one pass), and
accept it if merging the last piece and this one again from their characters yields just these two. If not,
try the next shorter piece; if none is left, mark the position as failed in a bitfield and go back one
piece. Whether two pieces go together is remembered, as is the encoding of short words.

A text is cut where no merge can happen: before a space mark that follows another character, and around
characters that no piece holds. Characters without a piece become their UTF-8 byte pieces.

Defined results: NULL and empty texts give the end id alone and decode to the empty text; NULL ids stay NULL,
and repeated rows give repeated results.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator

from pyspark.sql import DataFrame

from strataload.llm.tables import texts

SPACE = "▁"
WORDS_KEPT, PAIRS_KEPT, WORD_LENGTH = 300_000, 400_000, 48


class BacktrackingEncoder:
    def __init__(self, model_file: str) -> None:
        import ahocorasick
        import sentencepiece

        self.library = model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.pieces: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.bytes: dict[int, int] = {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i)):
                self.pieces[piece] = i
                self.scores[piece] = model.get_score(i)
        self.unknown = model.unk_id()
        self.end = model.eos_id()
        self.finder = ahocorasick.Automaton()
        for piece in self.pieces:
            self.finder.add_word(piece, piece)
        self.finder.make_automaton()
        self.shorter: dict[str, str | None] = {}
        for piece in self.pieces:
            prefixes = (piece[:n] for n in range(len(piece) - 1, 0, -1))
            self.shorter[piece] = next((p for p in prefixes if p in self.pieces), None)
        self.letters = letters = {piece for piece in self.pieces if len(piece) == 1}
        if any(SPACE in p[1:] and p.strip(SPACE) for p in self.pieces):
            self.cut = re.compile(r"(?s).+")  # pieces may cross words: a text is one word
        else:
            alone = "".join(c for c in "\n\t\r" if c not in letters)
            self.cut = re.compile(f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" + (f"|[{alone}]" if alone else ""))
        self.inside = {p[i : i + 2] for p in self.pieces for i in range(len(p) - 1)}
        self.pairs: dict[str, dict[str, list[tuple[str, int]]]] = {"": {}}
        self.pairs_kept = 0
        self.words: dict[str, list[int]] = {}

    def merged(self, text: str) -> list[str]:
        """The pieces that merging the best pair first, then the leftmost, leaves of a short text."""
        parts = list(text)
        scores, least = self.scores, float("-inf")
        gains = [scores.get(a + b, least) for a, b in zip(parts, parts[1:], strict=False)]
        while gains:
            best = max(gains)
            if best == least:
                break
            i = gains.index(best)
            parts[i] += parts.pop(i + 1)
            del gains[i]
            if i:
                gains[i - 1] = scores.get(parts[i - 1] + parts[i], least)
            if i < len(gains):
                gains[i] = scores.get(parts[i] + parts[i + 1], least)
        return parts

    def fitting(self, last: str, piece: str) -> list[tuple[str, int]]:
        """``piece`` and its shorter forms, longest first, that stay apart from ``last`` and whole when the
        characters of both are merged anew; each with its length."""
        if self.pairs_kept >= PAIRS_KEPT:
            self.pairs = {"": {}}
            self.pairs_kept = 0
        good, one = [], piece
        while one is not None:
            if self.merged(last + one) == ([last, one] if last else [one]):
                good.append((one, len(one)))
            one = self.shorter[one]
        self.pairs.setdefault(last, {})[piece] = good
        self.pairs_kept += 1
        return good

    def backtrack(self, word: str) -> list[str]:
        """The pieces of a text all of whose characters are pieces."""
        # Longest pieces one after the other; any other place is looked up when it is needed.
        longest = {end - len(piece) + 1: piece for end, piece in self.finder.iter_long(word)}
        failed = bytearray(len(word) // 8 + 1)
        out: list[str] = []
        last, at, size = "", 0, len(word)
        while at < size:
            piece = longest.get(at)
            if piece is None:
                piece = longest[at] = next(self.finder.iter_long(word, at))[1]
            after = self.pairs.get(last)
            tries = after.get(piece) if after else None
            if tries is None:
                tries = self.fitting(last, piece)
            for piece, length in tries:
                end = at + length
                if not failed[end >> 3] >> (end & 7) & 1:
                    out.append(piece)
                    last, at = piece, end
                    break
            else:
                failed[at >> 3] |= 1 << (at & 7)
                at -= len(out.pop())
                last = out[-1] if out else ""
        return out

    def word(self, word: str) -> list[int]:
        """The ids of a word. Closing punctuation goes by itself if no piece crosses its start."""
        stem = word.rstrip(string.punctuation)
        if stem and len(stem) < len(word) and word[len(stem) - 1 : len(stem) + 1] not in self.inside:
            return self.known(stem) + self.known(word[len(stem) :])
        pieces = self.pieces
        if self.letters.issuperset(word):
            return [pieces[p] for p in self.backtrack(word)]
        ids: list[int] = []
        known: list[str] = []
        for c in [*word, None]:
            if c in self.letters:
                known.append(c)
                continue
            if known:
                ids += [pieces[p] for p in self.backtrack("".join(known))]
                known = []
            if c is not None:
                spelled = [self.bytes.get(b) for b in c.encode()]
                ids += [self.unknown] if None in spelled else spelled
        return ids

    def known(self, word: str) -> list[int]:
        """The ids of a word, remembered if it is short."""
        ids = self.words.get(word)
        if ids is None:
            ids = self.word(word)
            if len(word) <= WORD_LENGTH:
                if len(self.words) >= WORDS_KEPT:
                    self.words.clear()
                self.words[word] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        """The ids of a text, with the end id."""
        ids: list[int] = []
        words = self.words
        if text:
            for w in self.cut.findall(SPACE + text.replace(" ", SPACE)):
                ids += words.get(w) or self.known(w)
        ids.append(self.end)
        return ids

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


_ENCODERS: dict[str, BacktrackingEncoder] = {}


def encoder(model_file: str) -> BacktrackingEncoder:
    """One encoder for each worker process."""
    if model_file not in _ENCODERS:
        _ENCODERS[model_file] = BacktrackingEncoder(model_file)
    return _ENCODERS[model_file]


def encode_documents(docs: DataFrame, model_file: str) -> DataFrame:
    """Every document as (doc_id, ids, decoded)."""

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        codec = encoder(model_file)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):  # ids of few documents are held at once
                part = batch.slice(at, 500)
                flat, ends, decoded = [], [0], []
                for text in part.column("text").to_pylist():
                    ids = codec.encode(text)
                    decoded.append(codec.decode(ids))
                    flat.append(np.array(ids, dtype=np.int32))
                    ends.append(ends[-1] + len(ids))
                values = pa.array(np.concatenate(flat)) if flat else pa.array([], pa.int32())
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), lists, pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"]
                )

    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>, decoded string")
