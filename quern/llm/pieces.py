"""SentencePiece encoding and decoding by Viterbi over a trie of words.

Text is marked as the model does it (a word mark in front and for every space) and
cut where no piece can span the border. The distinct words of a batch are sorted,
which is a depth-first walk of their trie: the forward state of a common prefix is
computed once and kept on a stack.

The state after a prefix is the last piece of its best segmentation. For a merging
(BPE) vocabulary, a segmentation is the model's own exactly when every piece is
stable and every two neighbours are: merging their characters by score gives the two
back. So a piece may follow a prefix if it is stable with that prefix's last piece,
and exactly one piece passes. Sums of scores, which a unigram model would maximise,
give other ids than this model's own, so stability takes their place.

Defined results: null and empty texts have no pieces; characters without a piece are
encoded byte by byte; decoding gives back the text, except that a literal word mark
becomes a space, as the model has it.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "piece_bpe_32k.model"
MARK = "▁"
# Words whose ids a worker remembers.
REMEMBERED = 800_000
_WORDS = re.compile(f"{MARK}+[^{MARK}\n]*|\n|[^{MARK}\n]+")

_loaded: dict[str, PieceModel] = {}


class PieceModel:
    def __init__(self, model: str = MODEL):
        library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))
        self.text = [library.id_to_piece(i) for i in range(library.get_piece_size())]
        plain = [
            i
            for i in range(len(self.text))
            if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i) or library.is_unused(i))
        ]
        self.ids = {self.text[i]: i for i in plain}
        self.score = {self.text[i]: library.get_score(i) for i in plain}
        self.byte_ids = [library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_of = {i: b for b, i in enumerate(self.byte_ids)}
        # What an id decodes to by itself: ASCII bytes do, other bytes need their neighbours.
        self.alone = [chr(self.byte_of[i]) if self.byte_of.get(i, 256) < 128 else t for i, t in enumerate(self.text)]
        self.high = frozenset(self.byte_ids[128:])
        # Lengths of the pieces that end in two given characters, longest first.
        ends: dict[str, set[int]] = {}
        for piece in self.ids:
            if len(piece) > 1:
                ends.setdefault(piece[-2:], set()).add(len(piece))
        self.lengths = {end: (*sorted(sizes, reverse=True), 1) for end, sizes in ends.items()}
        if any("\n" in p for p in self.ids) or any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids):
            raise ValueError("pieces span word borders")
        self.known: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[tuple[str, str], bool] = {}

    def merged(self, text: str) -> list[str]:
        """Merge neighbours into the piece of the highest score, leftmost first, until none is left."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stable(self, left: str, right: str) -> bool:
        found = self.pairs.get((left, right))
        if found is None:
            if len(self.pairs) > 2_000_000:
                self.pairs.clear()
            want = [left, right] if left else [right]
            found = self.pairs[left, right] = self.merged(left + right) == want
        return found

    def walk(self, words: list[str]) -> Iterator[tuple[str, list[str]]]:
        """(word, pieces) for sorted distinct words; states of common prefixes are reused."""
        lengths, ids, pairs, single = self.lengths, self.ids, self.pairs, (1,)
        last: list[str] = [""]  # last piece of every prefix of the word before
        before = ""
        for word in words:
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            del last[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                for size in lengths.get(word[max(end - 2, 0) : end], single):
                    if size > end:
                        continue
                    piece = word[end - size : end]
                    if size > 1 and piece not in ids:
                        continue
                    left = last[end - size]
                    stable = pairs.get((left, piece))
                    if stable is None:
                        stable = self.stable(left, piece)
                    if stable:
                        last.append(piece)
                        break
                else:
                    raise AssertionError(f"no stable piece ends at {end} of {word!r}")
            pieces, end = [], len(word)
            while end:
                pieces.append(last[end])
                end -= len(last[end])
            before = word
            yield word, pieces[::-1]

    def numbers(self, pieces: list[str]) -> tuple[int, ...]:
        out: list[int] = []
        for p in pieces:
            number = self.ids.get(p)
            if number is None:
                out.extend(self.byte_ids[b] for b in p.encode("utf-8", "surrogatepass"))
            else:
                out.append(number)
        return tuple(out)

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        split = [_WORDS.findall((MARK + t).replace(" ", MARK)) if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        fresh = {w for words in split for w in words if w not in self.known}
        for word, pieces in self.walk(sorted(fresh)):
            self.known[word] = self.numbers(pieces)
        return [[i for w in words for i in self.known[w]] for words in split]

    def decode(self, ids: list[int]) -> str:
        if self.high.isdisjoint(ids):
            text = "".join(map(self.alone.__getitem__, ids)).replace(MARK, " ")
            return text[1:] if text.startswith(" ") else text
        out: list[str] = []
        held = bytearray()
        for i in ids:
            byte = self.byte_of.get(i)
            if byte is not None:
                held.append(byte)
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held.clear()
            out.append(self.text[i])
        out.append(held.decode("utf-8", "replace"))
        text = "".join(out).replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


def loaded(model: str = MODEL) -> PieceModel:
    if model not in _loaded:
        _loaded[model] = PieceModel(model)
    return _loaded[model]


def encode_documents(docs: DataFrame, text_col: str = "text", model: str = MODEL, with_ids: bool = False) -> DataFrame:
    """``docs`` as ``row`` (its columns but the text), n_pieces, ids_crc32, decoded_sha256, round_trip (and ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = part.column(1).to_pylist()
                ids = pieces.encode(texts)
                decoded = [pieces.decode(x) for x in ids]
                arrays = [
                    part.column(0),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([zlib.crc32(np.array(x, dtype="<u4").tobytes()) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string()),
                    pa.array([d == (t or "") for d, t in zip(decoded, texts)], pa.bool_()),
                ]
                names = ["row", "n_pieces", "ids_crc32", "decoded_sha256", "round_trip"]
                if with_ids:
                    arrays.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    others = [c for c in docs.columns if c != text_col]
    row = F.struct(*[docs[f"`{c}`"] for c in others]) if others else F.struct(F.lit(0).alias("_"))
    packed = docs.select(row.alias("row"), F.col(text_col).alias("text"))
    kind = packed.schema["row"].dataType.simpleString()
    more = ", ids array<int>" if with_ids else ""
    return packed.mapInArrow(run, f"row {kind}, n_pieces long, ids_crc32 long, decoded_sha256 string, round_trip boolean{more}")


def decode_ids(rows: DataFrame, ids_col: str = "ids", out_col: str = "decoded", model: str = MODEL) -> DataFrame:
    """``rows`` with the text of an ``array<int>`` column of ids (null: null)."""

    @F.pandas_udf("string")
    def decode(column):
        pieces = loaded(model)
        return column.map(lambda x: None if x is None else pieces.decode(list(x)))

    return rows.withColumn(out_col, decode(ids_col))
