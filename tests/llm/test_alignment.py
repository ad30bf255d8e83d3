import hashlib
import random
from collections import Counter

import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tallywork.llm import alignment, queries
from tallywork.llm.bpe import byte_characters
from tests.llm import tables

A_PATH, B_PATH = queries.tokenizer("byte_bpe_50k.json"), queries.tokenizer("piece_bpe_32k.model")
A, B = Tokenizer.from_file(A_PATH), SentencePieceProcessor(model_file=B_PATH)
A.encode_special_tokens = True
BYTES = {c: bytes([n]) for n, c in enumerate(byte_characters())}
PIECES = [
    "a", "b", "The", "ing", "'s", "!", "é", "́", "日", " ", " ", "  ", "   ", "\xa0", "\x1c", "\x00", "1", "22", "_", "<|endoftext|>", "<s>",
    "<unk>", "<0x41>", "\n", "\n\n", "\t", "▁", "😀", "\x85", " ", "　", "​", "word", "another",
]


def a_bytes(token):
    return b"".join(BYTES[c] for c in A.id_to_token(token))


def b_bytes(token):
    piece = B.id_to_piece(token)
    return bytes([int(piece[3:5], 16)]) if B.is_byte(token) else piece.replace("▁", " ").encode()


def plain(text):
    """Ids of both, groups, links of a text tokenised at once and compared by all pairs of tokens."""
    if not text:
        return [], [], "", []
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    whole = (" " + text).encode()
    if b"".join(map(a_bytes, a)) != whole or b"".join(map(b_bytes, b)) != whole:
        return [], [], "", []
    ends = []
    for ids, told in ((a, a_bytes), (b, b_bytes)):
        at, side = 0, []
        for n in ids:
            at += len(told(n))
            side.append((n, at))
        ends.append(side)
    at_end = {}
    for y, e in ends[1]:
        at_end.setdefault(e, []).append(y)
    links = [(x, y) for x, e in ends[0] for y in at_end.get(e, ())]
    cuts = sorted({e for _, e in ends[0]} & {e for _, e in ends[1]})
    groups = []
    for low, high in zip([0, *cuts], cuts):
        groups.append("|".join(",".join(str(n) for n, e in side if low < e <= high) for side in ends))
    return a, b, ";".join(groups), links


def expected(rows):
    told = [(r[0], *plain(r[1])) for r in rows]
    counts = Counter(link for *_, links in told for link in links)
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    out = []
    for doc_id, a, b, groups, links in told:
        digest = hashlib.sha256(groups.encode()).hexdigest() if a else ""
        best = sum(counts[x] == most[x[1]] for x in links)
        out.append((doc_id, len(a), len(b), len(groups.split(";")) if groups else 0, len(links), best, sum(counts[x] for x in links), digest))
    return Counter(out)


def test_texts_align_like_a_plain_model():
    rng, known = random.Random(4), alignment.pair(A_PATH, B_PATH)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    for text, (n_a, n_b, groups, links) in zip(texts, known.align(texts)):
        a, b, told, pairs = plain(text)
        assert (n_a, n_b, groups) == (len(a), len(b), told), repr(text)
        assert links == b"".join((x << 32 | y).to_bytes(8, "little") for x, y in pairs)


def rows_of():
    rng = random.Random(6)
    rows = tables.ODD + tables.some_documents(60) + [tables.row(500 + i, "".join(rng.choice(PIECES) for _ in range(40))) for i in range(150)]
    return rows + [tables.row(900, "x" * 3000 + " y" * 3000), tables.row(901, "a▁b"), tables.row(902, " "), tables.row(903, "\n")]


@pytest.mark.parametrize("frequent", [None, 0, 40])
def test_query_and_operator_equal_a_plain_model(spark, tmp_path, frequent):
    rows = rows_of()
    docs = tables.clashing(tables.documents(spark, rows))
    if frequent is None:
        docs.write.parquet(f"{tmp_path}/documents.parquet")
        got = queries.op12_tokenizer_alignment(spark, str(tmp_path))
        assert tables.values(got) == expected(rows)
        return
    got = alignment.scored(alignment.align(docs, A_PATH, B_PATH), frequent)
    found = Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, hashlib.sha256(r.groups.encode()).hexdigest() if r.n_a else "") for r in got.collect())
    assert found == expected(rows)


def test_empty_table(spark):
    docs = tables.documents(spark, tables.ODD).limit(0)
    assert alignment.scored(alignment.align(docs, A_PATH, B_PATH)).isEmpty()
