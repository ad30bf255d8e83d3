"""Benchmark decontamination by latent semantic retrieval.

Texts are cut into passages of two blocks of words, each block shared by two
passages. A passage is a vector of hashed words with TF-IDF weights, and a
randomised SVD, whose products with the passage matrix are taken by Spark
tasks, gives a space of few dimensions. Passages near a benchmark item by
cosine in that space are candidates; the longest common subsequence of words
between item and surrounding text decides, with a check of the item's answer
where the wording differs.

Document frequencies cover all texts, and the space is fitted on all passages
of the corpus and of the benchmark; every passage of every text is then
compared with every item. Items go in blocks of a fixed size, so what tasks get
is bounded however large the benchmark is.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from tallywork.llm.common import maybe_among, scratch_tables, text_or_empty, written
from tallywork.session import remove_path

BUCKETS = 1 << 14
BLOCK_WORDS = 16
PASSAGE_WORDS = 2 * BLOCK_WORDS
RANK, EXTRA, POWER_STEPS = 96, 16, 2
#: Spread that a direction is given at least, as a share of the mean.
FLOOR = 0.1
#: Words of a task that fits the space, at least, as it adds up a matrix of its own.
TASK_WORDS = 1 << 24
#: Blocks whose sums are held at once.
BLOCKS_TOGETHER = 1 << 14
#: Rows added up in one piece.
PIECE = 256
#: Items compared in one pass over the corpus.
BLOCK_ITEMS = 4096
#: For passages of items; one shorter than ``PASSAGE_WORDS`` is only part of
#: what it stands in, so its limit is lower by the root of its share.
COSINE = 0.65
#: Share of an item's words, in order, that make a leak by themselves, and
#: that make one if this share of the answer's words is there as well.
LCS_SURE, LCS_LIKELY, ANSWER_SHARE = 0.8, 0.6, 0.75
SEED = 3
#: Bytes of a text hashed at once, and of short texts together.
SLICE, TOGETHER = 1 << 18, 1 << 15

# Everything in ASCII that is neither letter nor digit parts words.
_PARTS = bytes(i if i > 127 or chr(i).isalnum() else 32 for i in range(256))
_BASE = 0x9E3779B97F4A7C15
_POWERS = np.cumprod(np.full(SLICE + 1, _BASE, np.uint64))
_INVERSE = np.cumprod(np.full(SLICE + 1, pow(_BASE, -1, 1 << 64), np.uint64))


def _hashed(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 63-bit hash of each word and the place it begins at, all words of a slice at once.

    Running sums of bytes times powers of a base, modulo 2**64, give the sum
    over any word as a difference, and a power of the inverse moves it to the
    place of the first word.
    """
    edges = np.flatnonzero(np.diff(np.concatenate(([False], raw != 32, [False]))))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(raw * _POWERS[: len(raw)], dtype=np.uint64)))
    h = (sums[edges[1::2]] - sums[edges[::2]]) * _INVERSE[edges[::2]]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return (h >> np.uint64(1)).astype(np.int64), edges[::2]


def _letters(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_PARTS)


def _codes(raw: bytes) -> np.ndarray:
    found, at = [], 0
    while len(raw) - at > SLICE:
        end = raw.rfind(b" ", at, at + SLICE) + 1 or at + SLICE
        found.append(_hashed(np.frombuffer(raw, np.uint8, end - at, at))[0])
        at = end
    found.append(_hashed(np.frombuffer(raw, np.uint8, len(raw) - at, at))[0])
    return np.concatenate(found) if len(found) > 1 else found[0]


def codes_of(text: str | None) -> np.ndarray:
    """The hashes of a text's words in lower case, in order.

    A word longer than a slice counts as several.
    """
    return _codes(_letters(text))


def codes_together(texts: Iterable[str | None]) -> Iterator[list[np.ndarray]]:
    """``codes_of`` each text, in lists of texts that are hashed at once."""
    some, size = [], 0
    for raw in map(_letters, texts):
        if some and size + len(raw) > TOGETHER:
            yield _codes_of_some(some)
            some, size = [], 0
        some.append(raw)
        size += len(raw) + 1
    if some:
        yield _codes_of_some(some)


def _codes_of_some(raws: list[bytes]) -> list[np.ndarray]:
    if len(raws) == 1:
        return [_codes(raws[0])]
    codes, begins = _hashed(np.frombuffer(b" ".join(raws), np.uint8))
    ends = np.searchsorted(begins, np.cumsum([len(raw) + 1 for raw in raws])).tolist()
    return [codes[begin:end] for begin, end in zip([0, *ends], ends)]


def padded(codes: np.ndarray) -> np.ndarray:
    """The buckets of words, with as many ``BUCKETS`` behind them as fill a block."""
    at = np.full(-(-len(codes) // BLOCK_WORDS) * BLOCK_WORDS, BUCKETS, np.uint16)
    at[: len(codes)] = codes % BUCKETS
    return at


def sums_of(rows: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The sum of the rows at each line of places."""
    out = np.empty((len(places), rows.shape[1]), rows.dtype)
    for begin in range(0, len(places), 512):
        at = np.ascontiguousarray(places[begin : begin + 512].T, np.intp)
        sums = out[begin : begin + 512]
        np.take(rows, at[0], axis=0, out=sums, mode="clip")
        row = np.empty_like(sums)
        for some in at[1:]:
            sums += np.take(rows, some, axis=0, out=row, mode="clip")
    return out


def lcs_length(masks: dict[int, int], size: int, words: list[int]) -> int:
    """The longest common subsequence of an item and words, all bits at once.

    ``masks`` has a bit set for each place of a word in the item.
    """
    full = (1 << size) - 1
    v = full
    for w in words:
        m = masks.get(w)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return size - v.bit_count()


class Item:
    """One benchmark passage: its words, and the words of its answer."""

    def __init__(self, item_id: int, text: str, answer: str | None = None):
        self.item_id = item_id
        self.codes = codes_of(text)
        # Without an answer of its own, an item's last sentence counts as it.
        told = answer or ([s for s in re.split(r"[.?!\n]+", text) if codes_of(s).size] or [text])[-1]
        self.answer = set(codes_of(told).tolist())
        self.masks: dict[int, int] = {}
        for i, w in enumerate(self.codes.tolist()):
            self.masks[w] = self.masks.get(w, 0) | 1 << i

    def in_order(self, words: list[int]) -> float:
        """The share of the item's words found in order."""
        return lcs_length(self.masks, len(self.codes), words) / len(self.codes)

    def answered(self, words: list[int]) -> float:
        """The share of the answer's words found."""
        return len(self.answer.intersection(words)) / max(1, len(self.answer))


class Space:
    """The fitted space: a row of ``RANK`` numbers per bucket, weights included."""

    def __init__(self, rows: np.ndarray):
        # One more row, of zeros, for the places after the last word of a text.
        self.rows = np.vstack([rows, np.zeros((1, rows.shape[1]))]).astype(np.float32)

    def blocks(self, places: np.ndarray) -> np.ndarray:
        """The sum of each block of words, by their ``padded`` buckets."""
        return sums_of(self.rows, places.reshape(-1, BLOCK_WORDS))

    def one(self, codes: np.ndarray) -> np.ndarray:
        return self.rows[codes % BUCKETS].sum(axis=0)


def _goes_on(sizes: list[int]) -> np.ndarray:
    """Whether a block is followed by one of the same text, for texts of so many blocks."""
    more = np.ones(sum(sizes), bool)
    more[np.cumsum([size for size in sizes if size], dtype=np.intp) - 1] = False
    return more


def _joined(blocks: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Passages from blocks and, of a slice, the block behind it; and which have two blocks."""
    two = np.flatnonzero(more)
    passages = blocks[: len(more)].copy()
    passages[two] += blocks[two + 1]
    return passages, two


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


class Index:
    """A block of items in the space, ready to be looked up."""

    def __init__(self, space: Space, items: list[tuple], cosine: float = COSINE):
        self.space = space
        self.items = [i for i in (Item(*x) for x in items) if len(i.codes)]
        parts, self.owners, limits = [], [], []
        for n, item in enumerate(self.items):
            size = len(item.codes)
            for begin in range(0, max(1, size - PASSAGE_WORDS + BLOCK_WORDS), BLOCK_WORDS):
                part = item.codes[begin : begin + PASSAGE_WORDS]
                parts.append(space.one(part))
                self.owners.append(n)
                limits.append(cosine * math.sqrt(len(part) / PASSAGE_WORDS))
        self.vectors = _unit(np.stack(parts)) if parts else np.zeros((0, RANK), np.float32)
        # The least numbers of the vectors' precision that are no less.
        self.limits = np.array(limits, np.float32)
        self.limits[self.limits < limits] = np.nextafter(self.limits[self.limits < limits], np.float32(2))

    def candidates(self, some: list[np.ndarray]) -> list[list[tuple[int, int, float]]]:
        """``(block, item, cosine)`` of passages near a passage of an item, for each of some texts."""
        found: list[list[tuple[int, int, float]]] = [[] for _ in some]
        if not self.items or not some:
            return found
        places = np.concatenate([padded(codes) for codes in some])
        sizes = [-(-len(codes) // BLOCK_WORDS) for codes in some]
        ends = np.cumsum(sizes)
        more = _goes_on(sizes)
        for begin in range(0, len(more), 2048):
            passages, _ = _joined(self.space.blocks(places[begin * BLOCK_WORDS : (begin + 2049) * BLOCK_WORDS]), more[begin : begin + 2048])
            passages = _unit(passages)
            near = passages @ self.vectors.T >= self.limits
            for place in np.flatnonzero(near.ravel()).tolist():
                b, i = divmod(place, len(self.limits))
                text = int(np.searchsorted(ends, begin + b, "right"))
                # By itself, as a product of matrices rounds by their shapes.
                cosine = float(passages[b] @ self.vectors[i])
                found[text].append((begin + b - int(ends[text]) + sizes[text], self.owners[i], cosine))
        return found

    def leaks(self, text: str | None) -> list[tuple[int, float, float, float, int]]:
        """``(item, cosine, lcs, answer, first word)`` of the items a text leaks, each once."""
        return self.leaks_of([text])[0]

    def leaks_of(self, texts: Iterable[str | None]) -> list[list[tuple[int, float, float, float, int]]]:
        """``leaks`` of each text."""
        found = []
        for some in codes_together(texts):
            found += [self._confirmed(codes, near) for codes, near in zip(some, self.candidates(some))]
        return found

    def _confirmed(self, codes: np.ndarray, candidates: list[tuple[int, int, float]]) -> list[tuple]:
        best: dict[int, tuple] = {}
        last: dict[int, int] = {}
        for block, i, cosine in candidates:
            if i in best or last.get(i) == block:
                continue
            last[i] = block
            item = self.items[i]
            size = len(item.codes)
            begin = max(0, block * BLOCK_WORDS - size)
            words = codes[begin : block * BLOCK_WORDS + PASSAGE_WORDS + size].tolist()
            share = item.in_order(words)
            if share >= LCS_LIKELY:
                answer = item.answered(words)
                if share >= LCS_SURE or answer >= ANSWER_SHARE:
                    best[i] = (item.item_id, cosine, share, answer, begin)
        return list(best.values())


def _coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The words of each text as ``padded`` buckets."""
    for batch in batches:
        words = [padded(codes).tobytes() for some in codes_together(batch["whole"]) for codes in some]
        yield pd.DataFrame({"kind": batch["kind"], "words": pd.Series(words, dtype=object)})


def _frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts of a task that hold each bucket; bucket -1 has texts."""
    seen, texts = np.zeros(BUCKETS + 1, np.int64), 0
    here = np.zeros(BUCKETS + 1, bool)
    for batch in batches:
        for words in batch["words"]:
            here[:] = False
            here[np.frombuffer(words, np.uint16)] = True
            seen += here
            texts += 1
    at = np.flatnonzero(seen[:BUCKETS])
    yield pd.DataFrame({"bucket": np.r_[-1, at], "n": np.r_[texts, seen[at]]})


#: Rows of a product that travel together.
ROWS_TOGETHER = 1024


def _sums_in_order(rows: np.ndarray, order: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sums of the rows in this order, so many at a time.

    Long sums are taken in pieces and those added up; the longest pieces go
    first, so that the pieces that still have a row are always the first ones.
    """
    pieces = -(-counts // PIECE)
    skipped = PIECE * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    begins = np.repeat(np.cumsum(counts) - counts, pieces) + skipped
    left = np.minimum(np.repeat(counts, pieces) - skipped, PIECE)
    longest = np.argsort(-left, kind="stable")
    out = np.empty((len(left), rows.shape[1]), rows.dtype)
    for begin in range(0, len(left), 512):
        some = longest[begin : begin + 512]
        at, size = begins[some], left[some]
        sums = np.take(rows, order[at], axis=0, mode="clip")
        row = np.empty_like(sums)
        for k, n in enumerate(np.searchsorted(-size, -np.arange(1, size[0])).tolist(), 1):
            sums[:n] += np.take(rows, order[at[:n] + k], axis=0, out=row[:n], mode="clip")
        out[some] = sums
    return out if len(left) == len(counts) else _sums_in_order(out, np.arange(len(out)), pieces)


def _add_rows(total: np.ndarray, places: np.ndarray, rows: np.ndarray) -> None:
    """Adds each row to those of the total that its line of places names."""
    flat = places.ravel()
    order = np.argsort(flat, kind="stable")
    flat = flat[order]
    begins = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
    total[flat[begins]] += _sums_in_order(rows, order // places.shape[1], np.diff(np.r_[begins, len(flat)]))


def _lines(words: pd.Series, texts: bool) -> tuple[np.ndarray, list[int]]:
    """Buckets in lines of one length, and how many lines each row has."""
    if texts:
        return np.frombuffer(b"".join(words), np.uint16).reshape(-1, BLOCK_WORDS), [len(w) // (2 * BLOCK_WORDS) for w in words]
    rows = [np.frombuffer(w, np.int32) for w in words]
    at = np.full((len(rows), max(map(len, rows), default=1)), BUCKETS, np.uint16)
    for line, row in zip(at, rows):
        line[: len(row)] = row
    return at, [1] * len(rows)


def _products(idf: np.ndarray, basis: np.ndarray, weights: dict[str, float], gram: bool, texts: bool):
    """A task's part of the product of the passage matrix with a basis, in blocks of rows.

    With ``gram`` it is that of the product with itself, else the transposed
    matrix times the product. Blocks of words are added up once for both
    passages they are in.
    """
    scaled = np.vstack([idf[:, None] * basis, np.zeros((1, basis.shape[1]))]).astype(np.float32)
    squares = np.append(idf * idf, 0)

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((basis.shape[1] if gram else BUCKETS + 1, basis.shape[1]))
        for batch in batches:
            lines, sizes = _lines(batch["words"], texts)
            more = _goes_on(sizes)
            weight = np.repeat([weights[kind] for kind in batch["kind"]], sizes)
            for begin in range(0, len(lines), BLOCKS_TOGETHER):
                end = min(begin + BLOCKS_TOGETHER, len(lines))
                some = lines[begin : end + 1]
                y, two = _joined(sums_of(scaled, some), more[begin:end])
                norm = np.sqrt(_joined(squares[some].sum(axis=1), more[begin:end])[0])
                scale = np.divide(weight[begin:end], norm, out=np.zeros(end - begin), where=norm > 0).astype(np.float32)[:, None]
                y *= scale
                if gram:
                    total += y.T @ y
                    continue
                y *= scale
                rows = np.zeros((len(some), basis.shape[1]), np.float32)
                rows[: len(y)] = y
                rows[two + 1] += y[two]
                _add_rows(total, some, rows)
        if not gram:
            total = total[:BUCKETS] * idf[:, None]
        for block, begin in enumerate(range(0, len(total), ROWS_TOGETHER)):
            yield pd.DataFrame({"block": [block], "part": [total[begin : begin + ROWS_TOGETHER].astype(np.float32).tobytes()]})

    return part


def _add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The sums of the tasks' parts of each block, taken one by one."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, part in zip(batch["block"], batch["part"]):
            rows = np.frombuffer(part, np.float32)
            if block in totals:
                totals[block] += rows
            else:
                totals[block] = rows.astype(np.float64)
    for block, total in totals.items():
        yield pd.DataFrame({"block": [block], "part": [total.astype(np.float32).tobytes()]})


def _summed(passages: DataFrame, idf, basis, weights, gram: bool, texts: bool = False) -> np.ndarray:
    """The whole product; the parts of the tasks are added up before the driver gets it.

    A row is a passage, or with ``texts`` a text as ``_coded`` writes it, of
    which every passage counts.
    """
    schema = "block int, part binary"
    parts = passages.mapInPandas(_products(idf, basis.astype(np.float32), weights, gram, texts), schema)
    sums = parts.repartition("block").mapInPandas(_add_up, schema).toPandas()
    total = np.zeros((basis.shape[1] if gram else BUCKETS, basis.shape[1]), np.float32)
    for block, part in zip(sums["block"], sums["part"]):
        rows = np.frombuffer(part, np.float32).reshape(-1, basis.shape[1])
        total[block * ROWS_TOGETHER : block * ROWS_TOGETHER + len(rows)] += rows
    return total


def fit_space(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> Space:
    """The space of the leading right singular vectors of TF-IDF passages.

    All passages of all texts count. Words are written once as buckets of two
    bytes, and that table, removed at the end, is read for the frequencies and
    for each step. The driver gets one number per bucket for frequencies, and
    one matrix of fixed size per step, summed over the tasks. Benchmark
    passages count together as much as those of the corpus, so that the space
    has the directions in which items differ.
    """
    whole = text_or_empty(F.col(text)).alias("whole")
    kinds = {"corpus": docs, "benchmark": benchmark}
    rows = [rows.select(F.lit(kind).alias("kind"), whole) for kind, rows in kinds.items()]
    with scratch_tables() as tables:
        coded = written(rows[0].unionByName(rows[1]).mapInPandas(_coded, "kind string, words binary"), "coded")
        space = _fitted(coded)
    for path in tables:
        remove_path(docs.sparkSession, path)
    return space


def _fitted(coded: DataFrame) -> Space:
    of_kind = {k: F.col("kind") == k for k in ("corpus", "benchmark")}
    counted = coded.where(of_kind["corpus"]).mapInPandas(_frequencies, "bucket bigint, n bigint")
    seen = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas().set_index("bucket")["n"]
    frequency = np.zeros(BUCKETS)
    held = seen[seen.index >= 0]
    frequency[held.index] = held
    idf = np.log((int(seen.get(-1, 0)) + 1) / (frequency + 1)) + 0.1
    # Every block of words begins a passage.
    blocks = F.sum(F.octet_length("words")) / (2 * BLOCK_WORDS)
    sizes = {k: n or 1 for k, n in coded.groupBy("kind").agg(blocks).collect()}
    weights = {"corpus": 1.0, "benchmark": math.sqrt(sizes.get("corpus", 1) / sizes.get("benchmark", 1))}
    tasks = max(coded.sparkSession.sparkContext.defaultParallelism, int(sum(sizes.values()) * BLOCK_WORDS / TASK_WORDS))
    basis = np.random.default_rng(SEED).standard_normal((BUCKETS, RANK + EXTRA), np.float32) / math.sqrt(BUCKETS)
    for _ in range(POWER_STEPS):
        basis = np.linalg.qr(_summed(coded.coalesce(tasks), idf, basis, weights, gram=False, texts=True))[0]
    even = dict.fromkeys(weights, 1.0)
    parts = {k: _summed(coded.where(of_kind[k]).coalesce(tasks), idf, basis, even, gram=True, texts=True) for k in weights}
    parts = {k: part.astype(np.float64) for k, part in parts.items()}
    turned = np.linalg.eigh(sum(parts[k] * weights[k] ** 2 for k in weights))[1]
    leading = turned[:, ::-1][:, :RANK]
    # Scaled so that the corpus spreads alike in all directions: else the few
    # most common words would make all passages similar.
    spread, axes = np.linalg.eigh(leading.T @ parts["corpus"] @ leading)
    values = np.sqrt(np.maximum(spread, 0) + FLOOR * max(spread.mean(), 1e-9))
    return Space(basis @ leading @ axes / values * idf[:, None])


LEAK = ArrayType(StructType([
    StructField("place", IntegerType()), StructField("cosine", DoubleType()),
    StructField("lcs", DoubleType()), StructField("answer", DoubleType()), StructField("near_word", IntegerType()),
]))


def leaks(text: Column, index: Index) -> Column:
    """The items of an index that a text leaks, by their place in its list."""

    def found(texts: pd.Series) -> pd.Series:
        return pd.Series(index.leaks_of(texts), dtype=object)

    return F.pandas_udf(found, LEAK)(text_or_empty(text))


def indexes(space: Space, benchmark: DataFrame, item_id: str = "item_id", text: str = "text", size: int = BLOCK_ITEMS) -> Iterator[tuple[Index, list]]:
    """Blocks of at most ``size`` items, each with the list of its ids.

    Items are numbered by a table written once; a caller that runs
    each block as a job and lets go of its index holds one block.
    Items are told apart by id and text, null texts hold nothing.
    """
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    items = benchmark.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"), answer.alias("answer"))
    items = items.where(F.col("text").isNotNull()).distinct()
    count = items.count()
    blocks = max(1, -(-count // (size // 2)))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    items = written(items.withColumn("block", part), "benchmark_items")
    for block in range(blocks):
        rows = items.where(F.col("block") == block).orderBy("item_id", "text").collect()
        for begin in range(0, max(1, len(rows)), size):
            some = rows[begin : begin + size]
            yield Index(space, [(n, r["text"], r["answer"]) for n, r in enumerate(some)]), [r["item_id"] for r in some]


def contaminated(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id"
) -> DataFrame:
    """One row per text and item it leaks: ``doc_id``, ``item_id``, ``cosine``, ``lcs``, ``answer``, ``near_word``.

    ``lcs`` is the share of the item's words found in order, ``answer`` that
    of its answer's words, near word number ``near_word``.

    Null and empty texts and items leak nothing. Null ids are reported as
    null. Copies of a row are reported each. An empty table gives no rows.
    Other columns are not looked at, but for ``answer`` of the benchmark.
    """
    space = fit_space(docs, benchmark, text)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("whole"))
    found = None
    # A job of its own per block, so that one index is held at a time.
    for block, (index, ids) in enumerate(indexes(space, benchmark, item_id)):
        names = F.array(*[F.lit(i).cast("bigint") for i in ids]) if ids else F.array().cast("array<bigint>")
        some = rows.select("doc_id", F.explode(leaks(F.col("whole"), index)).alias("leak"))
        some = some.select("doc_id", F.get(names, F.col("leak.place")).alias("item_id"), "leak.cosine", "leak.lcs", "leak.answer", "leak.near_word")
        some = written(some, f"leaks{block}")
        del index
        found = some if found is None else found.unionByName(some)
    return found


def clean_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that leak no item, as they are.

    Null and empty texts and items leak nothing, so such rows stay. Every copy
    of a row stays or goes with its text; ids are not looked at, and the other
    columns stay with their row, whatever their names. An empty benchmark
    leaves all rows, an empty table none. Only rows that leak, and few others
    of like hash, are shuffled.
    """
    space = fit_space(docs, benchmark, text)
    whole = text_or_empty(F.col(text))
    names = [F.sha2(whole, 256).alias("leaking"), F.xxhash64(whole).alias("code")]
    found = None
    # Texts that leak, block by block as in ``contaminated``.
    for block, (index, _) in enumerate(indexes(space, benchmark)):
        some = written(docs.where(F.size(leaks(F.col(text), index)) > 0).select(*names).distinct(), f"leaking{block}")
        del index
        found = some if found is None else found.unionByName(some)
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64(whole).alias("code"))
    rows = maybe_among(rows, found, "code")
    name = F.sha2(text_or_empty(F.col(f"row.{text}")), 256)
    left = rows.where("maybe").join(found.select("leaking"), name == F.col("leaking"), "left_anti")
    return rows.where("not maybe").select("row.*").unionByName(left.select("row.*"))
