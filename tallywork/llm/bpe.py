"""BPE encoding and decoding by dynamic programming over prefixes.

Merging pairs in the order of their ranks has a property that spares the
merging: every prefix of a word has one last token, and which token that is
depends only on the last token of the prefix before it. A token is the last of
a prefix if it ends there and its neighbour on the left is the last token of
what remains, provided the two would stay apart when their joint text is
encoded. So one walk over the word settles it: an automaton over the suffixes
of all prefixes gives the tokens that end at each place, a test of pairs picks
the one that holds, and back-pointers lead from the end to the start.

Two tokens stay apart if no merge joins pieces across their border. The pieces
of the left token that ever touch the border are itself, its right part, the
right part of that and so on; each is there from its own merge until the merge
of the piece around it. The same holds on the right. A pair of such pieces is
joined if its merge comes first; of equal merges, the one further left does.

Text is normalised and cut into words by the rules in the tokenizer's file.
Both work on what stands between blanks, so a worker remembers the tokens of
such pieces, up to a bound in bytes, and texts are read in one pass.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache, partial

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tallywork.llm.common import text_or_empty
from tallywork.llm.memo import Memo

#: Rows whose tokens are handed over at once.
BATCH_ROWS = 256
#: What a worker remembers of pieces, and of words, a generation.
MEMO_BYTES = 128 << 20
#: Marks the last character of a word: no byte stands for characters this high.
_LAST = 0x1000
_PIECE = re.compile(r"[^ \t\n\x0b\x0c\r]+")
# The rule of the file for words, on ASCII.
_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ \t\n\x0b\x0c\ra-z0-9]+")


def byte_characters() -> list[str]:
    """The character that byte-level vocabularies write for each byte.

    Printable bytes of Latin-1 stand for themselves, the others for the
    characters from 256 on, in order.
    """
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Codec:
    """The vocabulary of a file, with the automaton and the merges."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        self.suffix = told["model"].get("end_of_word_suffix") or ""
        self.ids = told["model"]["vocab"]
        self.tokens = {n: t for t, n in self.ids.items()} | {t["id"]: t["content"] for t in told["added_tokens"]}
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        found = sorted(self.special, key=len, reverse=True)
        self._special = re.compile(f"({'|'.join(map(re.escape, found))})") if found else None
        rules = Tokenizer.from_file(path)
        self._normal, self._cut = rules.normalizer, rules.pre_tokenizer
        self._bytes = dict(enumerate(byte_characters()))
        self._merges(told["model"]["merges"])
        self._apart: dict[int, bool] = {}
        self.words = Memo(lambda words: [*map(self._word, words)], MEMO_BYTES)
        self.pieces = Memo(lambda pieces: [*map(self._piece, pieces)], MEMO_BYTES)

    def _merges(self, merges: list) -> None:
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        self.rank = {}  # of the merge of two tokens
        self.made = {}  # token: rank and parts
        whole = {self.ids[t] for t in self.ids}
        for rank, (left, right) in enumerate(pairs):
            a, b, both = self.ids[left], self.ids[right], self.ids[left + right]
            self.rank[a, b] = rank
            self.made[both] = (rank, a, b)
        # Tokens that merging their own text never gives can be no one's last.
        for token, (rank, a, b) in self.made.items():
            if a not in whole or b not in whole or self._joined(a, b, rank):
                whole.discard(token)
        automaton = ahocorasick.Automaton()
        for text, token in self.ids.items():
            if token in whole and text not in self.special:
                ends = bool(self.suffix) and text.endswith(self.suffix) and text != self.suffix
                name = text[: len(text) - len(self.suffix)] if ends else text
                name = name[:-1] + chr(ord(name[-1]) + _LAST) if ends else name
                automaton.add_word(name, (token, len(name)))
        automaton.make_automaton()
        self._ending = automaton.iter

    def _joined(self, left: int, right: int, until: float = float("inf")) -> bool:
        """Whether a merge of a rank below ``until`` joins pieces across the border."""
        x, x_until = left, until
        while True:
            y, y_until = right, until
            while True:
                rank = self.rank.get((x, y))
                if rank is not None and rank < x_until and rank <= y_until:
                    return True
                if y not in self.made:
                    break
                y_until, y, _ = self.made[y]
            if x not in self.made:
                return False
            x_until, _, x = self.made[x]

    def word_ids(self, word: str) -> list[int]:
        """The ids of one word, given in the characters that stand for bytes."""
        if self.suffix:
            word = word[:-1] + chr(ord(word[-1]) + _LAST)
        apart = self._apart
        if len(apart) > 1_000_000:
            apart.clear()
        last, back = [-1] * (len(word) + 1), [0] * (len(word) + 1)
        for end, (token, length) in self._ending(word):
            end += 1
            if last[end] >= 0:
                continue
            start = end - length
            if start:
                left = last[start]
                # A prefix that no token ends has no last token.
                if left < 0:
                    continue
                pair = left << 20 | token
                stay = apart.get(pair)
                if stay is None:
                    stay = apart[pair] = not self._joined(left, token)
                if not stay:
                    continue
            last[end], back[end] = token, start
        out, place = [], len(word)
        while place:
            out.append(last[place])
            place = back[place]
        return out[::-1]

    def _plain(self, piece: str) -> list[str]:
        """The words of a piece without blanks, in the characters that stand for bytes."""
        if piece.isascii() and piece.isprintable():
            return _WORD.findall(piece.lower())
        normal = self._normal.normalize_str(piece) if self._normal else piece
        return [w for w, _ in self._cut.pre_tokenize_str(normal)]

    def _word(self, word: str) -> tuple[bytes, str]:
        ids = self.word_ids(word)
        return array("i", ids).tobytes(), self.decode(ids)

    def _piece(self, piece: str) -> tuple[bytes, str]:
        out = []
        for part in self._special.split(piece) if self._special else [piece]:
            if part in self.special:
                out.append((array("i", [self.special[part]]).tobytes(), part))
            elif part:
                out += [self.words[word] for word in self._plain(part)]
        return self._joint(out)

    @staticmethod
    def _joint(found: list[tuple[bytes, str]]) -> tuple[bytes, str]:
        return b"".join([ids for ids, _ in found]), " ".join([shown for _, shown in found if shown])

    def encode(self, text: str) -> tuple[bytes, str]:
        """The ids of a text as 32-bit integers, and the text they decode to."""
        known = self.pieces
        return self._joint([known[piece] for piece in _PIECE.findall(text)])

    def decode(self, ids: list[int]) -> str:
        """Tokens with a blank between, as the file names no way to join them."""
        return " ".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def lists(counts: list[int], values: pa.Array) -> pa.ListArray:
    """One list per count, of so many of the values."""
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *counts]), pa.int32()), values)


def _encoded(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = codec(path)
    for whole in batches:
        for start in range(0, whole.num_rows, BATCH_ROWS):
            batch = whole.slice(start, BATCH_ROWS)
            found = [known.encode(t) for t in batch.column(1).to_pylist()]
            flat = b"".join([ids for ids, _ in found])
            ids = pa.Array.from_buffers(pa.int32(), len(flat) // 4, [None, pa.py_buffer(flat)])
            shown = pa.array([s for _, s in found], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), lists([len(ids) // 4 for ids, _ in found], ids), shown], ["doc_id", "ids", "decoded"]
            )


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``ids`` of the whole text, and the text they ``decode`` to.

    ``path`` names the tokenizer's file, which every executor has. Texts of
    special tokens inside a text are those tokens; none are added.

    Null texts count as empty; empty and blank texts have no ids and decode to
    an empty string. Null ids are kept, every copy of a row has its own result,
    no rows give no rows. Other columns are not looked at. A word of any length
    takes time in proportion to it.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(F.col(text)).alias("text"))
    schema = T.StructType([
        rows.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType()),
    ])
    return rows.mapInArrow(partial(_encoded, path), schema)


def _decoded(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = codec(path)
    for batch in batches:
        shown = [known.decode(ids or []) for ids in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shown, pa.string())], ["doc_id", "decoded"])


def decode(rows: DataFrame, path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Per row: ``doc_id`` and the text that ``ids`` decode to; null ids give an empty text."""
    rows = rows.select(F.col(doc_id).alias("doc_id"), F.col(ids).cast("array<int>").alias("ids"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("decoded", T.StringType())])
    return rows.mapInArrow(partial(_decoded, path), schema)
