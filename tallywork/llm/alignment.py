"""Cross-tokenizer alignment between whitespace-token anchors.

Two tokenizers cut the same text, a byte-level BPE (A) and a piece model (B).
Neither joins what a blank behind other text parts, so whole texts are
tokenised as pieces between such blanks, each remembered. Tokens that begin
with a blank and have their counterpart at the same byte are verified anchors:
both sequences have an end there. Anchors split a document into windows of ids of A and B,
and a window is aligned once for each pair of id tuples a worker meets.

Within a window, ends that A and B share cut the tokens into groups, and
tokens that end together are linked. How often ids are linked in the whole
corpus says which partner is the usual one. Documents carry the numbers of
their distinct links, which are added up in map tasks before they are
shuffled. To tell every document the counts of its links, the most frequent
pairs, a fixed number, are broadcast; links of other pairs, few as the pairs
are rare, meet their counts in a shuffle.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.llm.bpe import byte_characters, lists
from tallywork.llm.common import text_or_empty, written
from tallywork.llm.memo import Memo

BATCH_ROWS = 128
#: What a worker remembers of tokenised pieces, and of windows, a generation.
MEMO_BYTES = 128 << 20
#: New pieces tokenised at once; one whose bytes are not given has only these compared one by one.
PIECES_TOGETHER = 512
#: Pairs of ids whose counts are broadcast: 16 bytes each, and as much again for hashing.
FREQUENT_PAIRS = 1 << 17
#: Ids of B in the lower half of a pair.
_HALF = 32
_BLANK = "▁"
# White space that the word rule of A knows. B knows the blank only.
_SPACES = r"\t\n\x0b\x0c\r \x85\xa0  -     　"
#: A blank after something else than white space: no token of A or B reaches across its left side.
_CUT = re.compile(f"(?<=[^{_SPACES}]) ")

#: Ids of A and of B, as 32-bit integers.
Window = tuple[bytes, bytes]
#: Numbers of ids of A and of B, groups, links as 64-bit integers.
Aligned = tuple[int, int, str, bytes]


class Pair:
    """Both tokenizers, the bytes of their tokens, and what was aligned so far."""

    def __init__(self, byte_path: str, piece_path: str) -> None:
        # Spark gives a task one core.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=piece_path)
        byte_of = {c: bytes([n]) for n, c in enumerate(byte_characters())}
        told = {n: t for t, n in self.a.get_vocab(with_added_tokens=False).items()}
        self.a_bytes = [b"".join(byte_of[c] for c in told.get(n, "")) for n in range(max(told) + 1)]
        self.b_bytes = [self._piece_bytes(n) for n in range(self.b.get_piece_size())]
        pieces = [self.b.id_to_piece(n) for n in range(self.b.get_piece_size())]
        #: Pieces of B with a blank behind something else would reach across cuts.
        self.cuts = all(_BLANK not in p.lstrip(_BLANK) for p in pieces)
        self.sizes = [np.array([len(x) for x in side]) for side in (self.a_bytes, self.b_bytes)]
        self.most = max(map(len, self.sizes))
        #: Ids as they stand in groups, by what follows.
        self.names = [f"{n}{follows}" for follows in ",|;" for n in range(self.most)]
        self.windows = Memo(self._aligned, MEMO_BYTES, 128, lambda w: (len(w[0]) + len(w[1])) // 4)
        self.pieces = Memo(self._met, MEMO_BYTES)

    def _piece_bytes(self, token: int) -> bytes:
        piece = self.b.id_to_piece(token)
        if self.b.is_byte(token):
            return bytes([int(piece[1:-1], 16)])
        return piece.replace(_BLANK, " ").encode()

    def tokenised(self, pieces: list[str]) -> list[Window | None]:
        """Ids of A and of B for a blank and each piece; None if one of them does not give its bytes."""
        told = [(" " + p).encode() for p in pieces]
        sides = [
            [e.ids for e in self.a.encode_batch_fast([" " + p for p in pieces], add_special_tokens=False)],
            # B adds a blank of its own, but to nothing it adds nothing.
            [ids or [self.b.piece_to_id(_BLANK)] for ids in self.b.encode(pieces, num_threads=1)],
        ]
        keys, exact = [], [True] * len(pieces)
        for ids, tokens, sizes in zip(sides, (self.a_bytes, self.b_bytes), self.sizes):
            counts = [len(x) for x in ids]
            flat = np.fromiter(chain.from_iterable(ids), np.int32, sum(counts))
            ends = np.cumsum(counts)
            reach = np.concatenate(([0], np.cumsum(sizes[flat])))[ends]
            whole = b"".join(map(tokens.__getitem__, flat.tolist()))
            if whole != b"".join(told) or (reach != np.cumsum([len(t) for t in told])).any():
                exact = [e and b"".join([tokens[n] for n in x]) == t for e, x, t in zip(exact, ids, told)]
            raw, places = flat.tobytes(), [0, *(4 * ends).tolist()]
            keys.append([raw[i:j] for i, j in zip(places, places[1:])])
        return [(a, b) if e else None for e, a, b in zip(exact, *keys)]

    def _met(self, pieces: list[str]) -> list[Aligned | None]:
        """Each piece as the aligned window of its ids, None where ids do not give its bytes."""
        found: list[Window | None] = []
        for start in range(0, len(pieces), PIECES_TOGETHER):
            found += self.tokenised(pieces[start : start + PIECES_TOGETHER])
        known = self.windows
        known.learn([w for w in found if w])
        return [w and known[w] for w in found]

    def _aligned(self, windows: list[Window]) -> list[Aligned]:
        """Per window its numbers of ids, its groups as text, and its links as pairs of ids.

        All windows are taken at once, one behind the other. Every token has a
        byte at least, so one of each side ends at a shared end, and both sides
        of a window end together.
        """
        sides = []
        for n, sizes in enumerate(self.sizes):
            flat = np.frombuffer(b"".join([w[n] for w in windows]), np.int32)
            sides.append((flat, np.cumsum(sizes[flat]), np.cumsum([len(w[n]) // 4 for w in windows])))
        (a, a_end, a_last), (b, b_end, b_last) = sides
        met = np.searchsorted(b_end, a_end)
        a_shuts = b_end[met] == a_end
        b_at = met[a_shuts]
        b_shuts = np.zeros(len(b), bool)
        b_shuts[b_at] = True
        links = (a[a_shuts].astype(np.int64) << _HALF | b[b_at]).tobytes()
        # In the text of groups the ids of A in a group come before those of B.
        names = np.empty(len(a) + len(b), np.int64)
        b_before = np.concatenate(([0], b_at[:-1] + 1))
        a_behind = np.flatnonzero(a_shuts) + 1
        names[np.arange(len(a)) + b_before[np.cumsum(a_shuts) - a_shuts]] = a + self.most * a_shuts
        names[np.arange(len(b)) + a_behind[np.cumsum(b_shuts) - b_shuts]] = b + 2 * self.most * b_shuts
        text = [*map(self.names.__getitem__, names.tolist())]
        shut = np.cumsum(a_shuts)[a_last - 1] * 8
        out, at, link, a_from, b_from = [], 0, 0, 0, 0
        for a_to, b_to, link_to in zip(a_last.tolist(), b_last.tolist(), shut.tolist()):
            out.append((a_to - a_from, b_to - b_from, "".join(text[at : a_to + b_to])[:-1], links[link:link_to]))
            at, link, a_from, b_from = a_to + b_to, link_to, a_to, b_to
        return out

    def align(self, texts: list[str]) -> Iterator[Aligned]:
        """Per text, a blank before it: numbers of ids of A and of B, groups, links; none if either does not give its bytes.

        Where both give the bytes of a piece, tokens on both sides end with it
        and a token that begins with a blank comes next: its ends are anchors.
        """
        cut = [(_CUT.split(t) if self.cuts else [t]) if t else [] for t in texts]
        known = self.pieces
        known.learn(chain.from_iterable(cut))
        for pieces in cut:
            found = [known[p] for p in pieces]
            if not found or None in found:
                yield 0, 0, "", b""
                continue
            a, b, groups, links = zip(*found)
            yield sum(a), sum(b), ";".join(groups), b"".join(links)


@lru_cache(maxsize=1)
def pair(byte_path: str, piece_path: str) -> Pair:
    return Pair(byte_path, piece_path)


def _distinct(links: list[bytes]) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Distinct links of every text: how many, the links in order, and how often each."""
    flat = np.frombuffer(b"".join(links), "<i8")
    owner = np.repeat(np.arange(len(links)), [len(x) // 8 for x in links])
    order = np.lexsort((flat, owner))
    flat, owner = flat[order], owner[order]
    fresh = np.ones(len(flat), bool)
    fresh[1:] = (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(fresh)
    times = np.diff(np.append(at, len(flat)))
    return np.bincount(owner[at], minlength=len(links)).tolist(), flat[at], times


FIELDS = ("n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
          "link_a array<int>, link_b array<int>, link_times array<int>")


def _batches(paths: tuple[str, str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = pair(*paths)
    for whole in batches:
        for start in range(0, whole.num_rows, BATCH_ROWS):
            batch = whole.slice(start, BATCH_ROWS)
            found = list(known.align(batch.column(1).to_pylist()))
            held, links, times = _distinct([f[3] for f in found])
            # Every link closes a group.
            ends = [len(f[3]) // 8 for f in found]
            numbers = [[f[0] for f in found], [f[1] for f in found], ends, ends]
            sides = (links >> _HALF, links & ((1 << _HALF) - 1), times)
            columns = [batch.column(0), *[pa.array(n, pa.int64()) for n in numbers], pa.array([f[2] for f in found], pa.string())]
            columns += [lists(held, pa.array(x.astype(np.int32))) for x in sides]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *[f.split()[0] for f in FIELDS.split(", ")]])


def align(docs: DataFrame, byte_path: str, piece_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups`` and its distinct links.

    ``groups`` lists ids as ``a1,a2|b1;a3|b2,b3``; ``link_a``, ``link_b`` and
    ``link_times`` are the linked ids and how often they are linked in the row.

    Null, empty, and texts whose bytes one of the tokenizers does not give back
    have no tokens: counts 0 and empty lists. Blank texts have tokens. Null ids
    are kept, every copy of a row has its own result, no rows give no rows.
    Other columns are not looked at. Long texts are tokenised whole.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(F.col(text)).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], *T._parse_datatype_string(FIELDS).fields])
    return rows.mapInArrow(partial(_batches, (byte_path, piece_path)), schema)


def link_counts(aligned: DataFrame) -> DataFrame:
    """``pair``, ``count``, ``best``: every pair of linked ids of the corpus.

    ``best`` tells whether no pair with the same id of B has a larger count;
    ties are all best. ``pair`` holds the id of A above 32 bits and that of B
    below.
    """
    counts = _links(aligned, []).groupBy("pair").agg(F.sum("times").alias("count"))
    counts = counts.withColumn("link_b", F.col("pair").bitwiseAND(F.lit((1 << _HALF) - 1)))
    counts = written(counts, "link_counts")
    most = counts.groupBy("link_b").agg(F.max("count").alias("most"))
    return counts.join(most, "link_b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def _links(aligned: DataFrame, keep: list[str]) -> DataFrame:
    zipped = F.arrays_zip("link_a", "link_b", "link_times")
    rows = aligned.select(*keep, F.inline(zipped))
    joined = F.shiftleft(F.col("link_a").cast("bigint"), _HALF).bitwiseOR(F.col("link_b").cast("bigint"))
    return rows.select(*keep, joined.alias("pair"), F.col("link_times").cast("bigint").alias("times"))


def _told(links: DataFrame) -> DataFrame:
    best = F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best")
    return links.groupBy("row_id").agg(best, F.sum(F.col("times") * F.col("count")).alias("count_sum"))


def scored(aligned: DataFrame, frequent: int = FREQUENT_PAIRS) -> DataFrame:
    """The columns of ``aligned`` without links, with ``n_best`` and ``count_sum``.

    ``n_best`` is how many of a row's links join ids whose count is the largest
    of their id of B, ``count_sum`` the sum of the counts over its links; both
    are 0 for a row without links. The rows are written to the shared folder
    with a number each before they are counted, so that they keep it.

    Only ``frequent`` pairs are broadcast, however many there are.
    """
    aligned = written(aligned.withColumn("row_id", F.monotonically_increasing_id()), "alignment")
    counts = written(link_counts(aligned), "link_scores")
    hot = written(counts.orderBy(F.desc("count"), "pair").limit(frequent), "frequent_links")
    links = _links(aligned, ["row_id"])
    rest = links.join(F.broadcast(hot.select("pair")), "pair", "left_anti").join(counts, "pair")
    sums = _told(links.join(F.broadcast(hot), "pair")).unionByName(_told(rest))
    sums = sums.groupBy("row_id").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    joined = aligned.drop("link_a", "link_b", "link_times").join(sums, "row_id", "left").drop("row_id")
    return joined.fillna(0, ["n_best", "count_sum"])
