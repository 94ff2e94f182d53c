"""Benchmark decontamination by latent semantic retrieval.

Benchmark items and document passages become TF-IDF vectors over the items'
words (document frequencies are taken over all documents, in hashed cells).
A distributed randomised SVD of the items and of the passages of all
documents gives the latent space; it needs of the passages only how often two
of the items' words stand in one, which one reading counts together with the
document frequencies. Every document is then cut into
overlapping passages, projected, and compared with all items by cosine:
two lengths for items of up to LONG_ITEM words, for longer ones lengths and
steps by doubling up to the longest item; candidates are verified on the words themselves: the longest
common subsequence with the item, and whether the item's answer (its last
sentence) is there. Only verified pairs leave a task.

Items are a stated query set; they are handled in blocks of ``ITEM_BLOCK``,
so what is sent to every task is bounded whatever the benchmark's size.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paxflow.llm.memory import frees_memory
from paxflow.llm.words import Splitter, Words, slices
from paxflow.plans.sizing import stored

CELLS = 1 << 16  # of the document-frequency table
ITEM_BLOCK = 256
RANK = 256
EXTRA = 16
ROUNDS = 2
# How often an item's passage counts in the fit: the items' own directions must come out first.
ITEM_WEIGHT = 1000.0
SEED = 7
STEP = 8  # words
SHORT, LONG = 3, 6  # passage lengths in steps: the short one for items of fewer than SHORT_ITEM words
SHORT_ITEM = 32
LONG_ITEM = 64  # for items of so many words and more, steps and passages are doubled until the item is below
CHUNK_STEPS = 1024
CHUNK_WORDS = 8192
# Of the pairs of words: cells of a block of rows, keys a task holds before it counts them, counted keys before it lets them go.
PAIR_CELLS = 1 << 18
PAIR_KEYS = 1 << 22
PAIRS_HELD = 1 << 23
# Multiplications that numpy's libraries leave to one thread.
ONE_THREAD = 1 << 18
# Tasks for each core that count: each leaves a summary whose size hardly depends on its input.
COUNTING_TASKS = 8
# Candidates: cosine, and latent length against the part of the item's that a passage can hold.
MIN_COSINE = 0.55
MIN_LENGTH = 0.5
# Verified: this share of the item's words in order, with the answer; or more without.
MIN_LCS = 0.6
CLEAR_LCS = 0.8
MIN_ANSWER = 0.5


# ------------------------------------------------------------------ statistics


FREQUENCY_BLOCKS = 16  # then one block for the number of documents, then blocks of pairs


def pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending keys and their counts, in as few bytes each as the largest step and count need."""
    parts = [np.diff(keys, prepend=keys.dtype.type(0)), counts]
    parts = [x.astype(np.min_scalar_type(int(x.max(initial=0)))) for x in parts]
    return np.array([len(keys), *(x.itemsize for x in parts)], np.int64).tobytes() + b"".join(x.tobytes() for x in parts)


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, *sizes = np.frombuffer(data, np.int64, 3).tolist()
    steps = np.frombuffer(data, f"u{sizes[0]}", n, 24)
    return np.cumsum(steps, dtype=np.int64), np.frombuffer(data, f"u{sizes[1]}", n, 24 + n * sizes[0])


class Codes:
    """Places of word hashes in a sorted vocabulary; its length for all other
    words. A word is compared with those that share its first 16 bits."""

    def __init__(self, vocabulary: np.ndarray):
        self.size = len(vocabulary)
        begin = np.searchsorted(vocabulary, np.arange(CELLS, dtype=np.uint64) << np.uint64(48))
        self.begin = begin.astype(np.int32)
        self.most = int(np.diff(begin, append=self.size).max())
        self.vocabulary = np.r_[vocabulary, vocabulary[:1].repeat(self.most)]

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        at = self.begin[(hashes >> np.uint64(48)).astype(np.intp)]
        found = np.full(len(hashes), self.size, np.int32)
        for _ in range(self.most):
            hit = np.flatnonzero(self.vocabulary[at] == hashes)
            found[hit] = at[hit]
            at = at + 1
        return found


def rows_of_block(size: int) -> int:
    return max(1, PAIR_CELLS // max(1, size))


class Pairs:
    """How often two words of a vocabulary stand in one passage, as a task
    counts them: passages begin every SHORT * STEP words of a text."""

    def __init__(self, vocabulary: np.ndarray):
        self.codes, self.size = Codes(vocabulary), len(vocabulary)
        self.kind = np.int32 if self.size**2 < 2**31 else np.int64
        self.keys: list[np.ndarray] = []
        self.counted: list[tuple[np.ndarray, np.ndarray]] = []
        self.words = np.zeros(self.size, np.int64)

    def add(self, words: Words) -> None:
        code, text = self.codes(words.hash), words.text_of
        owner = np.cumsum((np.arange(len(text)) - words.first[text]) % (SHORT * STEP) == 0, dtype=np.int32)
        known = code < self.size
        code, owner = code[known].astype(self.kind), owner[known]
        self.words += np.bincount(code, minlength=self.size)
        for apart in range(1, SHORT * STEP):
            near = np.flatnonzero(owner[apart:] == owner[:-apart])
            if not len(near):
                break
            one, other = code[near], code[near + apart]
            self.keys.append(np.minimum(one, other) * self.kind(self.size) + np.maximum(one, other))
        if sum(map(len, self.keys)) >= PAIR_KEYS:
            self.count()

    def count(self) -> None:
        if self.keys:
            self.counted.append(np.unique(np.concatenate(self.keys), return_counts=True))
            self.keys = []

    def full(self) -> bool:
        return sum(len(k) for k, _ in self.counted) >= PAIRS_HELD

    def take(self) -> Iterator[tuple[int, bytes]]:
        """(block of rows, packed cells) of what was counted so far: each pair in both orders."""
        self.count()
        own = np.flatnonzero(self.words)
        keys = np.concatenate([k for k, _ in self.counted] + [own.astype(self.kind) * self.kind(self.size + 1)]).astype(np.int64)
        counts = np.concatenate([c for _, c in self.counted] + [self.words[own]])
        self.counted, self.words = [], np.zeros(self.size, np.int64)
        if not len(keys):
            return
        row, column = np.divmod(keys, self.size)
        twice = np.ones(len(keys), np.int64)
        twice[: len(keys) - len(own)] += (row == column)[: len(keys) - len(own)]
        mirror = np.flatnonzero(row != column)
        keys = np.concatenate([keys, column[mirror] * self.size + row[mirror]])
        counts = np.concatenate([counts * twice, counts[mirror]])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.r_[True, np.diff(keys) != 0])
        keys, counts = keys[first], np.add.reduceat(counts, first)
        cells = rows_of_block(self.size) * self.size
        for block in np.unique(keys // cells).tolist():
            a, b = np.searchsorted(keys, [block * cells, (block + 1) * cells])
            yield block, pack(keys[a:b] - block * cells, counts[a:b])


def counts_of(rows: DataFrame, vocabulary: np.ndarray, frequencies: bool = True) -> DataFrame:
    """One reading of all ``rows`` (id, text): block, counts. The first blocks
    are documents per cell of word hashes, then comes the number of documents,
    then how often two words of the vocabulary stand in one passage."""
    size, begin = len(vocabulary), FREQUENCY_BLOCKS + 1

    @frees_memory
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, total, n = Splitter(lower=True, letters_only=True), np.zeros(CELLS, np.int64), 0
        pairs = Pairs(vocabulary)

        def table(found: list[tuple[int, bytes]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([b for b, _ in found], pa.int32()), pa.array([c for _, c in found], pa.binary())], ["block", "counts"])

        for batch in batches:
            n += len(batch)
            for part in slices(batch, 1):
                words = splitter.split(part.column(1))
                if frequencies:
                    cell = (words.hash >> np.uint64(48)).astype(np.int64)
                    total += np.bincount(np.unique(words.text_of * CELLS + cell) % CELLS, minlength=CELLS)
                if size:
                    pairs.add(words)
                if pairs.full():
                    yield table([(begin + b, c) for b, c in pairs.take()])
        if frequencies:
            yield table([*enumerate(b.tobytes() for b in total.reshape(FREQUENCY_BLOCKS, -1)), (FREQUENCY_BLOCKS, np.int64(n).tobytes())])
        if size:
            yield table([(begin + b, c) for b, c in pairs.take()])

    @frees_memory
    def add(part: pd.DataFrame) -> pd.DataFrame:
        block = part["block"].iloc[0]
        if block < begin:
            data = np.sum([np.frombuffer(c, np.int64) for c in part["counts"]], axis=0).tobytes()
        else:
            cells = np.zeros(rows_of_block(size) * size, np.int64)
            for packed in part["counts"]:
                keys, counts = unpack(packed)
                cells[keys] += counts.astype(np.int64)
            keys = np.flatnonzero(cells)
            data = pack(keys, cells[keys])
        return pd.DataFrame({"block": [block], "counts": [data]})

    few = rows.coalesce(COUNTING_TASKS * rows.sparkSession.sparkContext.defaultParallelism)
    return few.mapInArrow(count, "block int, counts binary").groupBy("block").applyInPandas(add, "block int, counts binary")


def frequencies_in(counts: DataFrame) -> tuple[np.ndarray, int]:
    found = {r.block: np.frombuffer(r.counts, np.int64) for r in counts.filter(F.col("block") <= FREQUENCY_BLOCKS).collect()}
    if not found:
        return np.zeros(CELLS, np.int64), 0
    return np.concatenate([found[b] for b in range(FREQUENCY_BLOCKS)]), int(found[FREQUENCY_BLOCKS][0])


def document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """(documents per cell of word hashes, documents), over all ``rows`` (id, text)."""
    return frequencies_in(counts_of(rows, np.empty(0, np.uint64)))


def weights(hashes: np.ndarray, frequencies: np.ndarray, n: int) -> np.ndarray:
    """Inverse document frequency of each word."""
    return np.log((n + 1) / (frequencies[(hashes >> np.uint64(48)).astype(np.int64)] + 1)).astype(np.float32) + np.float32(0.01)


# ------------------------------------------------------------------ latent space


@dataclass(frozen=True)
class Items:
    """A block of benchmark items."""

    ids: np.ndarray
    words: list[np.ndarray]  # hashes, in order
    answers: list[frozenset[int]]  # hashes of the last sentence's distinct words


@dataclass(frozen=True)
class Space:
    vocabulary: np.ndarray  # sorted word hashes of the items
    vectors: np.ndarray  # (words + 1, rank): weighted, the last row zero for all other words
    items: np.ndarray  # (items, rank)

    @functools.cached_property
    def codes(self) -> Codes:
        return Codes(self.vocabulary)


def read_items(texts: list[tuple[int | None, str]]) -> Items:
    splitter = Splitter(lower=True, letters_only=True)
    words = splitter.split(pa.array([(t or "").lower() for _, t in texts], pa.string()))
    lists = [words.hash[a:b] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
    sentences = [[s for s in (t or "").lower().replace("?", ".").replace("!", ".").replace("\n", ".").split(".") if s.strip()] for _, t in texts]
    last = splitter.split(pa.array([s[-1] if s else "" for s in sentences], pa.string()))
    answers = [frozenset(last.hash[a:b].tolist()) for a, b in zip(last.first[:-1], last.first[1:], strict=True)]
    return Items(np.array([i for i, _ in texts], object), lists, answers)


def words_of(items: Items) -> np.ndarray:
    return np.unique(np.concatenate(items.words)) if items.words else np.empty(0, np.uint64)


def fit_space(items: Items, rows: DataFrame, frequencies: np.ndarray, n: int, counts: DataFrame | None = None) -> Space:
    """Randomised SVD of the items' and all documents' passages (``rows``: id, text) over the items' words.

    Each round multiplies the basis by A'A, where A holds the passages. Of
    the documents that is a matrix of counts, how often two words stand in one
    passage, between the words' weights: it is counted once (``counts``: by
    :func:`counts_of`, stored), and each round multiplies its blocks of rows,
    where they lie. The items are passages too.
    """
    vocabulary = words_of(items)
    weight = np.r_[weights(vocabulary, frequencies, n), np.float32(0)]
    rank = min(RANK + EXTRA, max(1, len(vocabulary)))
    basis = np.linalg.qr(np.random.default_rng(SEED).standard_normal((len(vocabulary), rank)))[0] if len(vocabulary) else np.zeros((0, 1))
    if counts is None and len(vocabulary):
        counts = stored(counts_of(rows, vocabulary, frequencies=False), "pairs")

    def product(code: np.ndarray, owner: np.ndarray, weighted: np.ndarray) -> np.ndarray:
        """A'(A basis) but for A's weights on the left, for the passages given
        as (word code, passage) pairs in the order of passages; ``weighted`` is
        the basis with A's weights. Chunks end where a passage does."""
        out = np.zeros_like(weighted)
        at = 0
        while at < len(code):
            end = min(len(code), at + CHUNK_WORDS)
            if end < len(code):
                begun = int(np.searchsorted(owner, owner[end]))
                if begun == at:  # one passage longer than a chunk: a long item
                    end = int(np.searchsorted(owner, owner[at], side="right"))
                    words, times = np.unique(code[at:end], return_counts=True)
                    whole = times.astype(weighted.dtype) @ weighted[words]
                    out[words] += times[:, None] * whole
                    at = end
                    continue
                end = begun
            own, new = code[at:end], np.r_[True, np.diff(owner[at:end]) != 0]
            left = np.add.reduceat(weighted[own], np.flatnonzero(new))
            order = np.argsort(own, kind="stable")
            first = np.flatnonzero(np.r_[True, np.diff(own[order]) != 0])
            out[own[order][first]] += np.add.reduceat(left[(np.cumsum(new) - 1)[order]], first)
            at = end
        return out

    def multiplied(current: np.ndarray) -> DataFrame:
        """The documents' part of A'(A current), by blocks of rows."""
        weighted = weight[:-1, None] * current
        size, high, begin = len(vocabulary), rows_of_block(len(vocabulary)), FREQUENCY_BLOCKS + 1

        @frees_memory
        def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    keys, counts = unpack(packed.as_py())
                    cells, row = np.zeros(high * size), (block - begin) * high
                    cells[keys] = counts
                    sums = (cells.reshape(high, size)[: size - row] @ weighted) * weight[row : min(size, row + high), None]
                    yield pa.RecordBatch.from_arrays([pa.array([row], pa.int32()), pa.array([sums.astype("<f8").tobytes()], pa.binary())], ["row", "sums"])

        return counts.filter(F.col("block") >= begin).select("block", "counts").mapInArrow(multiply, "row int, sums binary")

    own_code = Codes(vocabulary)(np.concatenate(items.words)) if len(vocabulary) else np.empty(0, np.int32)
    own_item = np.repeat(np.arange(len(items.words)), [len(w) for w in items.words])
    for _ in range(ROUNDS if len(vocabulary) else 0):
        sums = multiplied(basis)
        total = ITEM_WEIGHT * weight[:-1, None] * product(own_code, own_item, weight[:-1, None] * basis)
        for row in sums.toLocalIterator():
            sums = np.frombuffer(row.sums, "<f8").reshape(-1, total.shape[1])
            total[row.row : row.row + len(sums)] += sums
        basis = np.linalg.qr(total)[0]
    # The strongest directions among the items come first.
    placed = np.zeros((len(items.words), basis.shape[1]))
    np.add.at(placed, own_item, weight[own_code][:, None] * basis[own_code])
    _, _, turn = np.linalg.svd(placed, full_matrices=False)
    turn = turn[: min(RANK, len(turn))].T
    vectors = np.r_[weight[:-1, None] * (basis @ turn), np.zeros((1, turn.shape[1]))].astype(np.float32)
    return Space(vocabulary, vectors, (placed @ turn).astype(np.float32))


# ------------------------------------------------------------------ search


def passages(words: Words, space: Space, step: int, lengths: tuple[int, ...]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(length in steps, text, first word in the text, vectors) of all passages, chunk by chunk: one begins every ``step`` words."""
    counts = np.diff(words.first)
    steps = -(-counts // step)
    padded = np.where(steps > 0, steps + LONG - 1, 0)
    text = np.repeat(np.arange(len(counts)), padded)
    index = np.arange(len(text)) - np.repeat(np.cumsum(padded) - padded, padded)
    codes = np.r_[space.codes(words.hash), np.int32(len(space.vocabulary))]
    chunk = max(LONG, CHUNK_STEPS * STEP // step)
    for at in range(0, len(text), chunk):
        span = slice(at, min(len(text), at + chunk + LONG - 1))
        own_text, own_index = text[span], index[span]
        word = words.first[own_text][:, None] + own_index[:, None] * step + np.arange(step)
        word = np.where(word < words.first[own_text + 1][:, None], word, len(words.hash))
        code = codes[word]
        sums = space.vectors[code[:, 0]]
        one = np.empty_like(sums)
        for k in range(1, step):
            # codes are in range; "clip" only spares the copy that a check would need
            sums += np.take(space.vectors, code[:, k], axis=0, out=one, mode="clip")
        for length in lengths:
            n = min(len(sums) - length + 1, chunk)
            if n <= 0:
                continue
            vectors = sums[:n].copy()
            for k in range(1, length):
                vectors += sums[k : k + n]
            real = np.flatnonzero(own_index[:n] < steps[own_text[:n]])
            yield length, own_text[real], own_index[real] * step, vectors[real]


def products(vectors: np.ndarray, others: np.ndarray) -> np.ndarray:
    """``vectors @ others.T`` as a stack of products of few rows, each of
    which stays in one thread: the threads of a large one wait for each other
    on cores that run other tasks (measured: three times the CPU seconds)."""
    rows = max(1, ONE_THREAD // max(1, others.size))
    padded = np.zeros((-(-len(vectors) // rows) * rows, vectors.shape[1]), vectors.dtype)
    padded[: len(vectors)] = vectors
    return (padded.reshape(-1, rows, vectors.shape[1]) @ others.T).reshape(-1, len(others))[: len(vectors)]


def lcs(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, one bit per element of ``a``."""
    places: dict[int, int] = {}
    for k, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << k
    row = full = (1 << len(a)) - 1
    for x in b:
        hit = row & places.get(x, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def step_of(n: int) -> int:
    """Words between the passages for an item of ``n`` words: doubled, as the passages are, for long items."""
    step = STEP
    while n * STEP >= LONG_ITEM * step:
        step *= 2
    return step


def search(words: Words, items: Items, space: Space) -> list[tuple[int, int, float, float, float]]:
    """(text, item, cosine, lcs share, answer share) of the verified pairs, the best passage of each."""
    if not len(space.items):
        return []
    size = np.maximum(np.linalg.norm(space.items, axis=1), 1e-9)
    unit = (space.items / size[:, None]).astype(np.float32)
    # Items of one passage length, in groups of like latent length: a passage meets the groups that are not too long for it.
    count = np.array([len(w) for w in items.words])
    step = np.array([step_of(n) for n in count.tolist()])
    length_of = np.where(count < SHORT_ITEM, SHORT, LONG)
    least = MIN_LENGTH * size * np.minimum(1, length_of * step / np.maximum(1, count))
    tried: dict[tuple[int, int, int], tuple[float, int]] = {}
    for own_step in np.unique(step).tolist():
        lengths = tuple(np.unique(length_of[step == own_step]).tolist())
        groups = {}
        for length in lengths:
            of = np.flatnonzero((step == own_step) & (length_of == length))
            groups[length] = [g for g in np.array_split(of[np.argsort(least[of])], 4) if len(g)]
        for length, text, first, vectors in passages(words, space, own_step, lengths):
            norm = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
            for group in groups[length]:
                heavy = np.flatnonzero(norm >= least[group[0]])
                if not len(heavy):
                    continue
                cosine = products(vectors[heavy], unit[group]) / norm[heavy][:, None]
                passage, item = np.nonzero((cosine >= MIN_COSINE) & (norm[heavy][:, None] >= least[group][None, :]))
                for p, i in zip(passage.tolist(), item.tolist(), strict=True):
                    tried[int(text[heavy[p]]), int(group[i]), int(first[heavy[p]])] = (float(cosine[p, i]), LONG * own_step)
    best: dict[tuple[int, int], tuple[float, float, float]] = {}
    for (t, i, first), (cosine, reach) in sorted(tried.items(), key=lambda x: -x[1][0]):
        known = best.get((t, i))
        if known and known[1] >= 0.95:
            continue
        wanted = items.words[i]
        begin, end = int(words.first[t]), int(words.first[t + 1])
        region = words.hash[max(begin, begin + first - len(wanted)) : min(end, begin + first + reach + len(wanted))]
        there = region.tolist()
        share = lcs(wanted.tolist(), there) / max(1, len(wanted))
        answer = len(items.answers[i].intersection(there)) / len(items.answers[i]) if items.answers[i] else 1.0
        if (share >= CLEAR_LCS or (share >= MIN_LCS and answer >= MIN_ANSWER)) and (known is None or share > known[1]):
            best[(t, i)] = (cosine, share, answer)
    return [(t, i, *found) for (t, i), found in sorted(best.items())]


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
) -> DataFrame:
    """Pairs of a document and a benchmark item it contains: ``id_col,
    item_id, contaminated, cosine, lcs, answer``, one row per pair.

    ``contaminated`` is true in every row; documents without a row are clean.
    Null and empty documents contain nothing, null and empty items are found
    nowhere. Repeated rows give one pair, items that share an id are searched
    apart and give one pair; items without an id are searched like any other
    and share a null ``item_id``, documents without an id a null ``id_col``.
    Empty tables give an empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, item_id bigint, cosine double, lcs double, answer double"
    known = benchmark.filter(F.length(F.trim("text")) > 0).select(F.col(item_col).cast("long").alias("item"), "text")
    found: DataFrame | None = None
    block: list[tuple[int, str]] = []
    known_frequencies: list[tuple[np.ndarray, int]] = []

    def searched(texts: list[tuple[int, str]]) -> DataFrame:
        items = read_items(texts)
        # the first block's reading counts the documents' words for all blocks
        counts = stored(counts_of(rows, words_of(items), frequencies=not known_frequencies), "counts")
        if not known_frequencies:
            known_frequencies.append(frequencies_in(counts))
        space = fit_space(items, rows, *known_frequencies[0], counts)
        shipped = docs.sparkSession.sparkContext.broadcast(
            (items.ids, items.words, items.answers, space.vocabulary, space.vectors, space.items)
        )

        @frees_memory
        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, lists, answers, vocabulary, vectors, placed = shipped.value
            items, space = Items(ids, lists, answers), Space(vocabulary, vectors, placed)
            splitter = Splitter(lower=True, letters_only=True)
            for batch in batches:
                for part in slices(batch, 1):
                    pairs = search(splitter.split(part.column(1)), items, space)
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(0).take(pa.array([p[0] for p in pairs], pa.int64())),
                            pa.array([items.ids[p[1]] for p in pairs], pa.int64()),
                            *[pa.array([p[k] for p in pairs], pa.float64()) for k in (2, 3, 4)],
                        ],
                        ["id", "item_id", "cosine", "lcs", "answer"],
                    )

        return rows.mapInArrow(find, schema)

    def more(found: DataFrame | None, texts: list[tuple[int, str]]) -> DataFrame:
        pairs = searched(texts)
        return pairs if found is None else found.unionByName(pairs)

    for row in known.orderBy("item", "text").toLocalIterator():
        block.append((row.item, row.text))
        if len(block) == ITEM_BLOCK:
            found, block = more(found, block), []
    # The last block may be empty; without any item it finds nothing.
    if block or found is None:
        found = more(found, block)
    best = found.groupBy("id", "item_id").agg(F.max("cosine").alias("cosine"), F.max("lcs").alias("lcs"), F.max("answer").alias("answer"))
    return best.select(F.col("id").alias(id_col), "item_id", F.lit(True).alias("contaminated"), "cosine", "lcs", "answer")
