"""Language-model scores from a probabilistic suffix tree.

A text is the bytes of its words, lower-cased, each followed by a space, and
an end symbol. The tree's states are contexts of up to ``DEPTH`` bytes: a
context stays if it occurs ``MIN_COUNT`` times and its next-symbol
distribution diverges from that of the next shorter context, so the tree
grows with the training texts. Distributions are smoothed with the shorter
context's, down to a uniform one, so every text has a probability; a symbol
is scored by the longest suffix in the tree.

Counting runs over all training texts: tasks count byte runs, owners of a
context's last two bytes add them up and test divergence. The tree stays with
them, as one Parquet row per owner; contexts of one byte reach the driver.
Scoring sends a slice's byte runs to their owners, which return each text's
part of the sum. Runs that make up a fixed share of the training bytes (at
most 1 / HOT_RUN_SHARE of them) are priced beforehand and known to every
task, which spares the way, not the context. The unigram base score is exact: words travel as postings to the
owner of their hash, which knows the word's count and returns each text's
part of the sum. Words that make up a fixed share of all tokens (at most
1 / HOT_SHARE of them) are counted apart, so no owner gets their postings.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paxflow.llm.memory import frees_memory
from paxflow.llm.words import Splitter, Words, mix, slices
from paxflow.plans.sizing import stored

DEPTH = 5
MIN_COUNT = 2
# Least Kullback-Leibler divergence (nats per symbol) from the shorter context.
MIN_DIVERGENCE = 0.002
HOT_SHARE = 1e-4
HOT_RUN_SHARE = 1e-6
END = 0x0A
GAP = 0x20
# Byte runs that a task counts before it sends them.
HELD_RUNS = 3_000_000
# Scoring cuts texts into pieces; each piece first reads DEPTH bytes to find its state.
PIECE = 512


# ------------------------------------------------------------------ text as symbols


def symbols(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, first): per text DEPTH end symbols, its words each with a space, an end symbol; ``first``
    is where each text's own symbols begin, plus the total length and DEPTH."""
    size = words.end - words.start
    counts = np.diff(words.first)
    before = np.r_[0, np.cumsum(size)]
    own = before[words.first[1:]] - before[words.first[:-1]] + counts + 1 + DEPTH
    begin = np.r_[0, np.cumsum(own)]
    out = np.full(int(begin[-1]), GAP, np.uint8)
    for k in range(DEPTH):
        out[begin[:-1] + k] = END
    out[begin[1:] - 1] = END
    text = words.text_of
    index = np.arange(len(size)) - words.first[text]
    place = begin[text] + DEPTH + before[:-1] - before[words.first[text]] + index
    step = np.arange(int(before[-1]))
    out[np.repeat(place - before[:-1], size) + step] = words.raw[np.repeat(words.start - before[:-1], size) + step]
    return out, begin + DEPTH


def byte_runs(text: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A (DEPTH + 1)-byte integer per scored symbol: its context and itself."""
    packed = np.zeros(len(text), np.uint64)
    for k in range(DEPTH + 1):
        packed[DEPTH:] = packed[DEPTH:] << np.uint64(8) | text[k : len(text) - DEPTH + k]
    scored = np.ones(len(text), bool)
    for k in range(1, DEPTH + 1):
        scored[first[:-1] - k] = False
    return packed[scored]


def by_suffix(runs: np.ndarray) -> np.ndarray:
    """Runs with their context backwards, so that contexts with a common suffix are neighbours."""
    return (runs >> np.uint64(8)).byteswap() >> np.uint64(64 - 8 * DEPTH) << np.uint64(8) | runs & np.uint64(0xFF)


# ------------------------------------------------------------------ the tree


@dataclass(frozen=True)
class Tree:
    """A tree in one piece, as an automaton over states: flat tables of next
    state and log10 probability, one column per symbol class. ``lm_scores``
    has the tree in parts (``Branch``), which give the same probabilities."""

    column: np.ndarray  # symbol class of each byte
    width: int
    follow: np.ndarray
    log10: np.ndarray

    def scores(self, text: np.ndarray, first: np.ndarray) -> np.ndarray:
        """log10 probability of each text."""
        n = len(first) - 1
        lengths = np.diff(first) - DEPTH
        pieces = -(-lengths // PIECE)
        owner = np.repeat(np.arange(n), pieces)
        index = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = first[owner] + index * PIECE
        length = np.minimum(PIECE, lengths[owner] - index * PIECE)
        order = np.argsort(-length, kind="stable")
        begin, length, owner = begin[order] - DEPTH, length[order], owner[order]
        coded = self.column[text]
        state, total = np.zeros(len(owner), np.int64), np.zeros(len(owner))
        for k in range(int(length.max(initial=0)) + DEPTH):
            live = int(np.searchsorted(-length, -(k - DEPTH), side="left")) if k >= DEPTH else len(owner)
            if not live:
                break
            at = state[:live] * self.width + coded[begin[:live] + k]
            if k >= DEPTH:
                total[:live] += self.log10[at]
            state[:live] = self.follow[at]
        return np.bincount(owner, total, minlength=n)


def build_tree(contexts: dict[bytes, dict[int, int]]) -> Tree:
    """The automaton of the contexts kept."""
    seen = sorted({s for counts in contexts.values() for s in counts})
    column = np.full(256, len(seen), np.int16)
    column[seen] = np.arange(len(seen))
    width = len(seen) + 1
    # States: the contexts and their prefixes, so that reading a symbol always leads to the longest one.
    states = {b""}
    for context in contexts:
        states.update(context[:k] for k in range(len(context) + 1))
    listed = sorted(states, key=lambda s: (len(s), s))
    number = {s: k for k, s in enumerate(listed)}
    link = np.zeros(len(listed), np.int64)
    follow = np.zeros((len(listed), width), np.int32)
    share = np.empty((len(listed), width), np.float64)
    for k, state in enumerate(listed):
        if state:
            tail = state[1:]
            while tail not in number:
                tail = tail[1:]
            link[k] = number[tail]
            follow[k] = follow[link[k]]
        lower = share[link[k]] if state else np.full(width, 1 / 256)
        counts = contexts.get(state)
        if counts:
            own = np.zeros(width)
            own[column[list(counts)]] = list(counts.values())
            share[k] = (own + len(counts) * lower) / (sum(counts.values()) + len(counts))
        else:
            share[k] = lower
        # Children come later in the list; their parents' rows are then final.
        if state:
            follow[number[state[:-1]], column[state[-1]]] = k
    # Rows copied from a shorter state before its own children were set are set again in order.
    children: list[list[tuple[int, int]]] = [[] for _ in listed]
    for k, state in enumerate(listed[1:], 1):
        children[number[state[:-1]]].append((int(column[state[-1]]), k))
    for k, state in enumerate(listed):
        if state:
            follow[k] = follow[link[k]]
        for symbol, child in children[k]:
            follow[k, symbol] = child
    follow[:, width - 1] = 0
    return Tree(column, width, follow.ravel(), np.log10(share).astype(np.float32).ravel())


def _context_counts(runs: np.ndarray, counts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``depth`` context bytes and a symbol, with their counts."""
    keys = runs & np.uint64((1 << 8 * (depth + 1)) - 1)
    order = np.argsort(keys)
    keys = keys[order]
    start = np.flatnonzero(np.r_[np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]])
    return keys[start], np.add.reduceat(counts[order], start) if len(start) else counts[:0]


def _kept_contexts(runs: np.ndarray, counts: np.ndarray, least: float) -> list[tuple[int, int, float, bytes, bytes]]:
    """(depth, context, gain, symbols, counts) of the contexts of two bytes and more that stay, and all shorter ones."""
    out = []
    kept_before = shorter = None
    for depth in range(1, DEPTH + 1):
        keys, found = _context_counts(runs, counts, depth)
        context = keys >> np.uint64(8)
        start = np.flatnonzero(np.r_[np.ones(min(1, len(keys)), bool), context[1:] != context[:-1]])
        total = np.add.reduceat(found, start) if len(start) else found[:0]
        names = context[start]
        if depth <= 2:
            keep = total >= (least if depth == 2 else 1)
            gain = np.full(len(total), np.inf)
        else:
            # Divergence from the context without its first byte.
            tail_keys = keys & np.uint64((1 << 8 * depth) - 1)
            s_keys, s_found, s_names, s_total = shorter
            q = s_found[np.searchsorted(s_keys, tail_keys)] / s_total[np.searchsorted(s_names, tail_keys >> np.uint64(8))]
            p = found / np.repeat(total, np.diff(np.r_[start, len(keys)]))
            divergence = np.add.reduceat(p * np.log(p / q), start) if len(start) else p
            gain = total * divergence
            tails = names & np.uint64((1 << 8 * (depth - 1)) - 1)
            keep = (total >= least) & (divergence >= MIN_DIVERGENCE) & np.isin(tails, kept_before)
        shorter, kept_before = (keys, found, names, total), names[keep]
        ends = np.r_[start, len(keys)]
        symbol = (keys & np.uint64(0xFF)).astype(np.uint8)
        for k in np.flatnonzero(keep).tolist():
            span = slice(ends[k], ends[k + 1])
            out.append((depth, int(names[k]), float(gain[k]), symbol[span].tobytes(), found[span].astype("<i8").tobytes()))
    return out


def short_contexts(counts: np.ndarray) -> np.ndarray:
    """Probability of each symbol after each byte, from counts (256, 256)."""

    def smoothed(own: np.ndarray, lower: np.ndarray) -> np.ndarray:
        kinds = (own > 0).sum(axis=-1, keepdims=True)
        return np.where(kinds > 0, (own + kinds * lower) / np.maximum(1, own.sum(axis=-1, keepdims=True) + kinds), lower)

    return smoothed(counts, smoothed(counts.sum(axis=0), np.full(256, 1 / 256)))


@dataclass(frozen=True)
class Branch:
    """The contexts of two bytes and more of one owner. Per depth: contexts
    (backwards, sorted), their totals and numbers of symbols; contexts with a
    symbol, and their counts."""

    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    @staticmethod
    def columns(kept: list[tuple[int, int, float, bytes, bytes]]) -> dict[str, list[bytes]]:
        out = {c: [] for c in ("contexts", "totals", "kinds", "keys", "counts")}
        for depth in range(2, DEPTH + 1):
            own = [(int.from_bytes(c.to_bytes(depth, "big"), "little"), s, n) for d, c, _, s, n in kept if d == depth]
            own.sort(key=lambda x: x[0])
            names, kinds = np.array([c for c, _, _ in own], np.uint64), np.array([len(x) for _, x, _ in own], np.int64)
            symbol, count = np.frombuffer(b"".join(x for _, x, _ in own), np.uint8), np.frombuffer(b"".join(n for _, _, n in own), "<i8")
            totals = np.add.reduceat(count, np.cumsum(kinds) - kinds) if len(own) else count
            keys = np.repeat(names, kinds) << np.uint64(8) | symbol
            for c, values in zip(out, (names, totals, kinds, keys, count), strict=True):
                out[c].append(values.tobytes())
        return out

    @staticmethod
    def of_row(row: dict[str, list[bytes] | None]) -> Branch:
        listed = [row[c] or [] for c in ("contexts", "totals", "kinds", "keys", "counts")]
        types = (np.uint64, "<i8", "<i8", np.uint64, "<i8")
        return Branch([tuple(np.frombuffer(v, t) for v, t in zip(level, types, strict=True)) for level in zip(*listed, strict=True)])

    def log10(self, codes: np.ndarray, short: np.ndarray) -> np.ndarray:
        """log10 probability of each run (as by ``by_suffix``), by its longest suffix in the tree."""
        symbol = codes & np.uint64(0xFF)
        p = short[codes >> np.uint64(8 * DEPTH), symbol]
        for depth, (names, totals, kinds, keys, counts) in enumerate(self.levels, 2):
            if not len(names):
                break
            name = codes >> np.uint64(8 * (DEPTH - depth + 1))
            at = np.minimum(np.searchsorted(names, name), len(names) - 1)
            here = np.flatnonzero(names[at] == name)
            at, key = at[here], name[here] << np.uint64(8) | symbol[here]
            place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            own = np.where(keys[place] == key, counts[place], 0)
            p[here] = (own + kinds[at] * p[here]) / (totals[at] + kinds[at])
        return np.log10(p)


BRANCH = "contexts array<binary>, totals array<binary>, kinds array<binary>, keys array<binary>, counts array<binary>"


def train(rows: DataFrame) -> tuple[DataFrame, np.ndarray, tuple[np.ndarray, np.ndarray], np.ndarray]:
    """(branches, probabilities after one byte, frequent runs with their log10 probability, hot words) from all ``rows`` (id, text)."""
    buckets = max(64, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def send(runs: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        owner = mix(runs >> np.uint64(8) & np.uint64(0xFFFF)) % np.uint64(buckets)
        order = np.argsort(owner, kind="stable")
        runs, counts, owner = runs[order], counts[order], owner[order]
        cuts = np.searchsorted(owner, np.arange(buckets + 1).astype(np.uint64))
        listed = [b for b in range(buckets) if cuts[b + 1] > cuts[b]]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(listed, pa.int32()),
                pa.array([runs[cuts[b] : cuts[b + 1]].tobytes() for b in listed], pa.binary()),
                pa.array([counts[cuts[b] : cuts[b + 1]].astype("<u4").tobytes() for b in listed], pa.binary()),
            ],
            ["bucket", "runs", "counts"],
        )

    def add(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        runs, counts = np.concatenate([r for r, _ in held]), np.concatenate([c for _, c in held])
        return _context_counts(runs, counts, DEPTH)

    @frees_memory
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, held, hot = Splitter(lower=True), [], {}
        tokens = 0
        for batch in batches:
            for part in slices(batch, 1):
                words = splitter.split(part.column(1))
                name, found = np.unique(words.hash, return_counts=True)
                tokens += len(words.hash)
                often = found >= max(2, HOT_SHARE * len(words.hash) / 2)
                for n, c in zip(name[often].tolist(), found[often].tolist(), strict=True):
                    hot[n] = hot.get(n, 0) + c
                runs, found = np.unique(byte_runs(*symbols(words)), return_counts=True)
                held.append((runs, found))
                if sum(len(r) for r, _ in held) > HELD_RUNS:
                    held = [add(held)]
                    if len(held[0][0]) > HELD_RUNS // 2:
                        yield send(*held.pop())
        if held:
            yield send(*add(held))
        # Words that are frequent in this task, under bucket -1 - owner.
        named, many = np.array(list(hot), np.uint64), np.array(list(hot.values()), np.uint32)
        often = many >= HOT_SHARE * tokens / 2
        if often.any():
            owner = int(mix(named[often][:1])[0] % np.uint64(buckets))
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1 - owner], pa.int32()), pa.array([named[often].tobytes()], pa.binary()), pa.array([many[often].tobytes()], pa.binary())],
                ["bucket", "runs", "counts"],
            )

    @frees_memory
    def keep(part: pd.DataFrame) -> pd.DataFrame:
        runs = np.frombuffer(b"".join(part["runs"]), np.uint64)
        counts = np.frombuffer(b"".join(part["counts"]), "<u4").astype(np.int64)
        row = {"bucket": int(part["bucket"].iloc[0]), "names": None, "often": None, "first": None, "frequent": None}
        if row["bucket"] < 0:
            name, which = np.unique(runs, return_inverse=True)
            row |= {"names": name.tobytes(), "often": np.bincount(which, counts).astype("<i8").tobytes()} | Branch.columns([])
        else:
            runs, counts = _context_counts(runs, counts, DEPTH)
            first = np.bincount((runs & np.uint64(0xFFFF)).astype(np.int64), counts, minlength=1 << 16).astype("<i8")
            frequent = by_suffix(runs[counts >= max(1, HOT_RUN_SHARE * n_bytes)])
            row |= {"first": first.tobytes(), "frequent": np.sort(frequent).tobytes()} | Branch.columns(_kept_contexts(runs, counts, MIN_COUNT))
        return pd.DataFrame({c: [v] for c, v in row.items()})

    sent = rows.mapInArrow(count, "bucket int, runs binary, counts binary")
    schema = "bucket int, names binary, often binary, first binary, frequent binary, " + BRANCH
    found = stored(sent.groupBy("bucket").applyInPandas(keep, schema), "contexts")
    after, hot = np.zeros(1 << 16, np.int64), {}
    for row in found.select("names", "often", "first").toLocalIterator():
        if row["first"] is not None:
            after += np.frombuffer(row["first"], "<i8")
            continue
        for n, c in zip(np.frombuffer(row.names, np.uint64).tolist(), np.frombuffer(row.often, "<i8").tolist(), strict=True):
            hot[n] = hot.get(n, 0) + c
    words = sorted(hot, key=lambda n: (-hot[n], n))[: int(1 / HOT_SHARE)]
    branches = found.filter("bucket >= 0")
    short = short_contexts(after.reshape(256, 256))

    @frees_memory
    def price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                prices = Branch.of_row(row).log10(np.frombuffer(row["frequent"], np.uint64), short)
                yield pa.RecordBatch.from_arrays([pa.array([row["frequent"]], pa.binary()), pa.array([prices.tobytes()], pa.binary())], ["codes", "prices"])

    priced = [(r.codes, r.prices) for r in branches.drop("bucket", "names", "often", "first").mapInArrow(price, "codes binary, prices binary").toLocalIterator()]
    codes, prices = np.frombuffer(b"".join(c for c, _ in priced), np.uint64), np.frombuffer(b"".join(v for _, v in priced), np.float64)
    order = np.argsort(codes)
    return branches.select("bucket", "contexts", "totals", "kinds", "keys", "counts"), short, (codes[order], prices[order]), np.array(sorted(words), np.uint64)


# ------------------------------------------------------------------ scores


def is_held_out(id_col: Column, folds: int = 5, fold: int = 1) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == fold, F.lit(False))


def run_postings(
    text: np.ndarray, first: np.ndarray, priced: np.ndarray, prices: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(scores, runs, texts, times): each text's log10 probability as far as its runs are priced, and the others by (run, text)."""
    owner = np.repeat(np.arange(len(first) - 1).astype(np.uint64), np.diff(first) - DEPTH)
    pairs = np.sort(by_suffix(byte_runs(text, first)) << np.uint64(16) | owner)
    new = np.flatnonzero(np.r_[np.ones(min(1, len(pairs)), bool), pairs[1:] != pairs[:-1]])
    times, pairs = np.diff(np.r_[new, len(pairs)]), pairs[new]
    code, owner = pairs >> np.uint64(16), (pairs & np.uint64(0xFFFF)).astype(np.int64)
    first_of = np.r_[np.ones(min(1, len(code)), bool), code[1:] != code[:-1]]
    name, which = code[first_of], np.cumsum(first_of) - 1
    if not len(priced):
        return np.zeros(len(first) - 1), code, owner, times
    at = np.minimum(np.searchsorted(priced, name), len(priced) - 1)
    known, at = (priced[at] == name)[which], at[which]
    scores = np.bincount(owner[known], times[known] * prices[at[known]], minlength=len(first) - 1)
    return scores, code[~known], owner[~known], times[~known]


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col, held_out, n_tokens, n_known,
    train_tokens, base_score, score``.

    Held-out rows are those whose id's CRC-32 falls in the fold; a null id is
    never held out. Null and empty texts are one end symbol. Without training
    rows every symbol is equally likely. Repeated rows get equal scores and
    count as often as they occur; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn(
        "held_out", is_held_out(F.col("id"))
    )
    branches, short, (codes, prices), hot = train(rows.filter(~F.col("held_out")).select("id", "text"))
    shipped = spark.sparkContext.broadcast((short, codes, prices, hot))
    buckets = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    id_type = rows.schema["id"].dataType.simpleString()

    @frees_memory
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, priced, prices, frequent = shipped.value
        splitter, turn = Splitter(lower=True), 0
        task = TaskContext.get().partitionId()
        suffix = np.arange(1 << 16).astype(np.uint16)
        owner_of = (mix(suffix.byteswap().astype(np.uint64)) % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)
        for batch in batches:
            for part in (p.slice(k, 1 << 16) for p in slices(batch, 1) for k in range(0, len(p), 1 << 16)):
                turn += 1
                words = splitter.split(part.column(1))
                trained = ~part.column(2).to_numpy(zero_copy_only=False)
                scores, *run = run_postings(*symbols(words), priced, prices)
                run_owner = owner_of[(run[0] >> np.uint64(8 * DEPTH - 8)).astype(np.int64)]
                order = np.argsort(run_owner, kind="stable")
                run, run_owner = [r[order] for r in run], run_owner[order]
                run_cuts = np.searchsorted(run_owner, np.arange(buckets + 1))
                # Distinct words of each text, by hash: (word, text, times).
                text = words.text_of
                order = np.lexsort((text, words.hash))
                word, text = words.hash[order], text[order]
                new = np.flatnonzero(np.r_[np.ones(min(1, len(word)), bool), (word[1:] != word[:-1]) | (text[1:] != text[:-1])])
                times = np.diff(np.r_[new, len(word)])
                word, text = word[new], text[new]
                at = np.minimum(np.searchsorted(frequent, word), max(0, len(frequent) - 1))
                known = frequent[at] == word if len(frequent) else np.zeros(len(word), bool)
                hot_text = np.lexsort((at[known], text[known]))
                per_text = np.searchsorted(text[known][hot_text], np.arange(len(part) + 1))
                hot_word, hot_times = at[known][hot_text].astype("<u4"), times[known][hot_text].astype("<u4")
                word, text, times = word[~known], text[~known], times[~known]
                owner = word >> np.uint64(40)
                owner = (owner % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(owner, kind="stable")
                word, text, times, owner = word[order], text[order], times[order], owner[order]
                cuts = np.searchsorted(owner, np.arange(buckets + 1))
                listed = [b for b in range(buckets) if cuts[b + 1] > cuts[b] or run_cuts[b + 1] > run_cuts[b]]
                info = (task * 7919 + turn * 104729) % buckets
                if info not in listed:
                    listed.append(info)
                cut = [slice(cuts[b], cuts[b + 1]) for b in listed]
                run_cut = [slice(run_cuts[b], run_cuts[b + 1]) for b in listed]
                mine = [b == info for b in listed]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(listed, pa.int32()),
                        pa.array([task << 32 | turn] * len(listed), pa.int64()),
                        pa.array([len(part)] * len(listed), pa.int32()),
                        pa.array([word[s].tobytes() for s in cut], pa.binary()),
                        pa.array([text[s].astype("<u4").tobytes() for s in cut], pa.binary()),
                        pa.array([times[s].astype("<u4").tobytes() for s in cut], pa.binary()),
                        pa.array([run[0][s].tobytes() for s in run_cut], pa.binary()),
                        pa.array([run[1][s].astype("<u2").tobytes() for s in run_cut], pa.binary()),
                        pa.array([run[2][s].astype("<u4").tobytes() for s in run_cut], pa.binary()),
                        pa.array([np.packbits(trained).tobytes()] * len(listed), pa.binary()),
                        pa.array([part.column(0).to_pylist() if m else None for m in mine], pa.list_(part.column(0).type)),
                        pa.array([(np.diff(words.first) + 1).tolist() if m else None for m in mine], pa.list_(pa.int64())),
                        pa.array([scores.tolist() if m else None for m in mine], pa.list_(pa.float64())),
                        pa.array([per_text.astype("<u4").tobytes() if m else None for m in mine], pa.binary()),
                        pa.array([hot_word.tobytes() if m else None for m in mine], pa.binary()),
                        pa.array([hot_times.tobytes() if m else None for m in mine], pa.binary()),
                    ],
                    ["bucket", "slice", "rows", "words", "texts", "times", "runs", "run_texts", "run_times", "trained", "ids", "tokens", "scores", "cuts", "hot", "hot_times"],
                )

    sent = rows.mapInArrow(
        score,
        "bucket int, slice bigint, rows int, words binary, texts binary, times binary, runs binary, run_texts binary, run_times binary, trained binary,"
        f" ids array<{id_type}>, tokens array<bigint>, scores array<double>, cuts binary, hot binary, hot_times binary",
    )

    def deep(part: pa.RecordBatch, branch: Branch) -> pa.Array:
        """Per row, the sums of its runs' log10 probabilities for each text; null without any."""
        size = np.array([len(r) // 8 for r in part.column("runs").to_pylist()], np.int64)
        run, text, times = (
            np.frombuffer(b"".join(part.column(c).to_pylist()), t) for c, t in (("runs", np.uint64), ("run_texts", "<u2"), ("run_times", "<u4"))
        )
        n = part.column("rows").to_numpy().astype(np.int64)
        first = np.r_[0, np.cumsum(n)]
        name, which = np.unique(run, return_inverse=True)
        sums = np.bincount(np.repeat(first[:-1], size) + text, times * branch.log10(name, shipped.value[0])[which], minlength=first[-1])
        return pa.array([sums[first[k] : first[k + 1]].tolist() if size[k] else None for k in range(len(n))], pa.list_(pa.float64()))

    def own(part: pa.Table) -> pa.Table:
        column = {n: part.column(n).to_pylist() for n in ("slice", "rows", "words", "texts", "times", "trained", "cuts", "hot", "hot_times")}
        word = np.frombuffer(b"".join(column["words"]), np.uint64)
        text = np.frombuffer(b"".join(column["texts"]), "<u4").astype(np.int64)
        times = np.frombuffer(b"".join(column["times"]), "<u4").astype(np.int64)
        length = np.array([len(w) // 8 for w in column["words"]], np.int64)
        first = np.r_[0, np.cumsum(column["rows"])]
        at = np.repeat(first[:-1], length) + text
        trained = np.concatenate([np.unpackbits(np.frombuffer(t, np.uint8))[:n].astype(bool) for t, n in zip(column["trained"], column["rows"], strict=True)])
        name, which = np.unique(word, return_inverse=True)
        count = np.bincount(which, times * trained[at], minlength=len(name))
        base = np.bincount(at, times * np.log10(count + 0.5)[which], minlength=first[-1])
        known = np.bincount(at, times * (count > 0)[which], minlength=first[-1])
        hot_counts, train_rows, train_tokens = {}, 0, int((times * trained[at]).sum())
        for k, cuts in enumerate(column["cuts"]):
            if cuts is None:
                continue
            mine = trained[first[k] : first[k + 1]]
            train_rows += int(mine.sum())
            per_text = np.diff(np.frombuffer(cuts, "<u4").astype(np.int64))
            told = np.repeat(mine, per_text)
            for w, t in zip(np.frombuffer(column["hot"][k], "<u4")[told].tolist(), np.frombuffer(column["hot_times"][k], "<u4")[told].tolist(), strict=True):
                hot_counts[w] = hot_counts.get(w, 0) + t
        n = part.num_rows
        return pa.table(
            {
                "slice": part.column("slice"),
                "base": pa.array([base[first[k] : first[k + 1]].tolist() for k in range(n)], pa.list_(pa.float64())),
                "known": pa.array([known[first[k] : first[k + 1]].astype(np.int64).tolist() for k in range(n)], pa.list_(pa.int64())),
                **{c: part.column(c) for c in ("ids", "tokens", "scores", "deep", "cuts", "hot", "hot_times")},
                "distinct": pa.array([int((count > 0).sum())] + [0] * (n - 1), pa.int64()),
                "train_tokens": pa.array([train_tokens] + [0] * (n - 1), pa.int64()),
                "train_rows": pa.array([train_rows] + [0] * (n - 1), pa.int64()),
                "hot_counts": pa.array([list(hot_counts.items())] + [None] * (n - 1), pa.map_(pa.int64(), pa.int64())),
            }
        )

    @frees_memory
    def own_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows by owner, its branch first; runs are priced as they come."""
        held, bucket, branch = [], None, Branch([])
        for batch in batches:
            owner = batch.column("bucket").to_numpy()
            begin = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else []
            for low, high in zip(begin, np.r_[begin[1:], len(owner)], strict=True):
                part = batch.slice(low, high - low)
                if owner[low] != bucket:
                    if held:
                        yield from own(pa.Table.from_batches(held)).combine_chunks().to_batches()
                    held, bucket, branch = [], owner[low], Branch([])
                if part.column("slice")[0].as_py() is None:
                    branch = Branch.of_row({c: part.column(c)[0].as_py() for c in ("contexts", "totals", "kinds", "keys", "counts")})
                    part = part.slice(1)
                if len(part):
                    told = [c for c in part.schema.names if c not in left_here]
                    held.append(part.select(told).append_column("deep", deep(part, branch)))
        if held:
            yield from own(pa.Table.from_batches(held)).combine_chunks().to_batches()

    left_here = {"bucket", "runs", "run_texts", "run_times", "contexts", "totals", "kinds", "keys", "counts"}
    owned = sent.unionByName(branches, allowMissingColumns=True).repartition(buckets, "bucket").sortWithinPartitions("bucket", F.asc_nulls_first("slice"))
    parts = stored(
        owned.mapInArrow(
            own_all,
            f"slice bigint, base array<double>, known array<bigint>, ids array<{id_type}>, tokens array<bigint>, scores array<double>, deep array<double>,"
            " cuts binary, hot binary, hot_times binary, distinct bigint, train_tokens bigint, train_rows bigint, hot_counts map<bigint,bigint>",
        ),
        "scores",
    )
    sums = parts.agg(F.sum("distinct"), F.sum("train_tokens"), F.sum("train_rows")).first()
    hot_counts = np.zeros(len(hot), np.int64)
    # At most 1 / HOT_SHARE rows.
    for word, total in parts.select(F.explode("hot_counts")).groupBy("key").agg(F.sum("value")).collect():
        hot_counts[word] = total
    train_rows = sums[2] or 0
    n_train = int((sums[1] or 0) + hot_counts.sum() + train_rows)
    vocabulary = int((sums[0] or 0) + (hot_counts > 0).sum() + (train_rows > 0))
    spread = math.log10(n_train + 0.5 * (vocabulary + 1))
    end_part, end_known = math.log10(train_rows + 0.5), int(train_rows > 0)

    @frees_memory
    def finish(part: pa.Table) -> pa.Table:
        base = np.sum([np.array(b) for b in part.column("base").to_pylist()], axis=0)
        known = np.sum([np.array(b) for b in part.column("known").to_pylist()], axis=0)
        k = next(i for i, c in enumerate(part.column("cuts").to_pylist()) if c is not None)
        cuts = np.frombuffer(part.column("cuts")[k].as_py(), "<u4").astype(np.int64)
        text = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
        word = np.frombuffer(part.column("hot")[k].as_py(), "<u4")
        times = np.frombuffer(part.column("hot_times")[k].as_py(), "<u4")
        of_hot = hot_counts[word]
        base = base + np.bincount(text, times * np.log10(of_hot + 0.5), minlength=len(base))
        known = known + np.bincount(text, times * (of_hot > 0), minlength=len(known)).astype(np.int64) + end_known
        tokens = np.array(part.column("tokens")[k].as_py(), np.int64)
        return pa.table(
            {
                "id": part.column("ids")[k].values,
                "n_tokens": pa.array(tokens),
                "n_known": pa.array(known),
                "base_score": pa.array(base + end_part - tokens * spread),
                "score": pa.array(np.sum([np.array(part.column("scores")[k].as_py())] + [np.array(d) for d in part.column("deep").to_pylist() if d is not None], axis=0)),
            }
        )

    columns = ["slice", "base", "known", "ids", "tokens", "scores", "deep", "cuts", "hot", "hot_times"]
    scored = parts.select(*columns).groupBy("slice").applyInArrow(
        finish, f"id {id_type}, n_tokens bigint, n_known bigint, base_score double, score double"
    )
    return scored.select(
        F.col("id").alias(id_col),
        is_held_out(F.col("id")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(n_train).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
