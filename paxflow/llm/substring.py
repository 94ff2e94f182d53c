"""Substring duplicates by FM-indexes over shards of shared passages.

A window is ``WINDOW`` consecutive words. Its anchor is the smallest hash
among the GRAM-word runs inside it, so equal windows have equal anchors.
Anchors that occur under two document ids mark the only places where a
repeat can be; the passages around them ("segments", runs of windows with
one anchor) go to the shard that owns the anchor. Each shard builds a
compressed FM-index of its distinct segments (Burrows-Wheeler transform in
a wavelet matrix with rank counts) and streams the segments through it:
backward search gives every window its suffix interval, and the smallest
document id in the interval says whether an earlier document has the window.

An anchor with more than ``HOT_SEGMENTS`` segments (a common phrase among
different neighbours) would make one shard's index grow with the corpus. Its
windows go singly, by a hash of all their words, and a plain aggregate finds
the smallest id of each.

Text itself is only moved for documents that have a repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paxflow.llm.keyfilter import hits, key_filter
from paxflow.llm.memory import frees_memory
from paxflow.llm.words import Splitter, Words, combine, mix, runs, slices
from paxflow.plans.sizing import stored

WINDOW = 13
GRAM = 5
# Shared anchors per shard: the size of an FM-index, not a limit on what it finds.
SHARD_ANCHORS = 8_000
# Segments of one anchor that may go to one FM-index.
HOT_SEGMENTS = 2_000
# Segments that a task remembers having sent.
SENT_SEGMENTS = 100_000
NO_ID = -(1 << 63)


# ------------------------------------------------------------------ FM-index


class WaveletMatrix:
    """Rank queries over a sequence of small integers, one bit plane per level."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.size = bits, len(values)
        self.words, self.counts, self.zeros = [], [], []
        for level in range(bits - 1, -1, -1):
            bit = (values >> level & 1).astype(np.uint8)
            packed = np.zeros((self.size // 64 + 1) * 8, np.uint8)
            raw = np.packbits(bit, bitorder="little")
            packed[: len(raw)] = raw
            words = packed.view(np.uint64)
            self.words.append(words)
            self.counts.append(np.r_[0, np.cumsum(np.bitwise_count(words))[:-1]].astype(np.int32))
            self.zeros.append(self.size - int(bit.sum()))
            values = np.r_[values[bit == 0], values[bit == 1]]

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before each position."""
        low, high = np.zeros_like(at), at
        for k in range(self.bits):
            one = (symbol >> (self.bits - 1 - k) & 1).astype(bool)
            low1, high1 = self._ones(k, low), self._ones(k, high)
            low = np.where(one, self.zeros[k] + low1, low - low1)
            high = np.where(one, self.zeros[k] + high1, high - high1)
        return high - low

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.counts[level][word] + np.bitwise_count(self.words[level][word] & mask)


class FMIndex:
    """An FM-index of several sequences of symbols 1..n for patterns of at
    most ``depth`` symbols: suffixes are sorted by that many symbols, which
    is all that backward search of such patterns looks at."""

    def __init__(self, symbols: np.ndarray, ends: np.ndarray, depth: int):
        owner = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        self.place = np.arange(len(symbols)) + owner
        self.text = np.zeros(len(symbols) + len(ends), np.int64)
        self.text[self.place] = symbols
        top = int(self.text.max(initial=0))
        self.order = self._suffix_order(self.text, max(1, top.bit_length()), depth)
        self.first = np.searchsorted(np.sort(self.text), np.arange(top + 2))
        self.bwt = WaveletMatrix(self.text[self.order - 1], max(1, top.bit_length()))

    @staticmethod
    def _suffix_order(text: np.ndarray, bits: int, depth: int) -> np.ndarray:
        """Suffixes by their first ``depth`` symbols or up to the separator:
        as many symbols as one integer holds, then by doubling."""
        n, width = len(text), max(1, 62 // bits)
        packed, ended = np.zeros(n, np.int64), np.zeros(n, bool)
        for k in range(width):
            symbol = np.zeros(n, np.int64)
            symbol[: n - k] = text[k:]
            symbol[ended] = 0
            packed = packed << bits | symbol
            ended |= symbol == 0
        while True:
            order = np.argsort(packed)
            ranked = packed[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.r_[1, ranked[1:] != ranked[:-1]])
            if width >= depth:
                return order
            # A suffix that has met its separator is complete; what follows must not count.
            follow = np.zeros(n, np.int64)
            follow[: n - width] = rank[width:]
            follow[ended] = 0
            still = np.ones(n, bool)
            still[: n - width] = ended[width:]
            ended |= still
            packed, width = rank * (n + 2) + follow, 2 * width

    def search(self, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Matching statistics of the runs of ``length`` indexed symbols that
        begin at ``starts``: suffix intervals by backward search. A run that
        is alone after a few symbols stays alone: its interval is left as it
        is then, of size one."""
        at = self.place[starts] + length - 1
        low, high = self.first[self.text[at]], self.first[self.text[at] + 1]
        for k in range(1, length):
            open_ = np.flatnonzero(high - low > 1)
            symbol = self.text[at[open_] - k]
            both = self.bwt.rank(np.r_[symbol, symbol], np.r_[low[open_], high[open_]])
            low[open_] = self.first[symbol] + both[: len(open_)]
            high[open_] = self.first[symbol] + both[len(open_) :]
        return low, high


# ------------------------------------------------------------------ anchors and segments


def window_anchors(words: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first word, text) of every window."""
    starts, text = runs(words, window)
    if not len(starts):
        return np.empty(0, np.uint64), starts, text
    least = combine(words.hash, np.arange(len(words.hash) - gram + 1), gram)
    width, span = 1, window - gram + 1
    while width < span:
        step = min(width, span - width)
        least = np.minimum(least[: len(least) - step], least[step:])
        width += step
    return least[starts], starts, text


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).fill_null(NO_ID).to_numpy()


def shared_anchors(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """``key, segments``: anchors that occur under at least two ids, and how many segments they have in all (repeated ones too)."""

    @frees_memory
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(lower=False)
        for batch in batches:
            for part in slices(batch, 2):
                anchor, start, text = window_anchors(splitter.split(part.column(2)), window, gram)
                if not len(anchor):
                    continue
                new = np.r_[True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | (start[1:] != start[:-1] + 1)]
                anchor, owner = anchor[new], _ids(part)[text[new]]
                order = np.argsort(anchor)
                anchor, owner = anchor[order], owner[order]
                first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor[first].view(np.int64)),
                        pa.array(np.minimum.reduceat(owner, first)),
                        pa.array(np.maximum.reduceat(owner, first)),
                        pa.array(np.diff(np.r_[first, len(anchor)])),
                    ],
                    ["key", "low", "high", "segments"],
                )

    found = rows.mapInArrow(emit, "key bigint, low bigint, high bigint, segments bigint").groupBy("key")
    found = found.agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("segments").alias("segments"))
    return found.filter("low < high").select("key", "segments")


def segments(rows: DataFrame, bits: np.ndarray, hot: np.ndarray, window: int, gram: int, once: bool) -> DataFrame:
    """Segments around the anchors in the filter: ``key, id, mark, start, windows, words``.

    ``start`` is the first word's number in its text. Windows of an anchor in
    the filter ``hot`` are segments of their own without ``words``; their
    ``key`` is a hash of their words. With ``once`` a task
    leaves out a segment that it has sent for a smaller or equal id and a
    larger or equal one.
    """
    shipped = rows.sparkSession.sparkContext.broadcast((bits, hot))

    @frees_memory
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, (held, common) = Splitter(lower=False), shipped.value
        sent: dict[int, tuple[int, int]] = {}
        for batch in batches:
            for part in slices(batch, 2):
                words = splitter.split(part.column(2))
                anchor, start, text = window_anchors(words, window, gram)
                hit = hits(held, anchor)
                anchor, start, text = anchor[hit], start[hit], text[hit]
                if not len(anchor):
                    continue
                single = hits(common, anchor)
                new = np.r_[True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | (start[1:] != start[:-1] + 1)] | single
                first = np.flatnonzero(new)
                count = np.diff(np.r_[first, len(anchor)])
                key, begin, owner = anchor[first], start[first], text[first]
                last = begin + count - 1 + window - 1
                sums = np.r_[np.uint64(0), np.cumsum(mix(words.hash) * splitter.power[: len(words.hash)])]
                name = mix((sums[last + 1] - sums[begin]) * splitter.inverse[begin]) ^ mix(key ^ count.astype(np.uint64))
                single = single[first]
                key = key.copy()
                key[single] = combine(words.hash, begin[single], window, 1)
                ids = _ids(part)[owner]
                keep = np.arange(len(key))
                if once:
                    wanted = []
                    for k, (n, i) in enumerate(zip(name.tolist(), ids.tolist(), strict=True)):
                        seen = sent.get(n)
                        if seen is None or i < seen[0] or i > seen[1]:
                            sent[n] = (i, i) if seen is None else (min(i, seen[0]), max(i, seen[1]))
                            wanted.append(k)
                    if len(sent) > SENT_SEGMENTS:
                        sent.clear()
                    keep = np.array(wanted, np.int64)
                columns = [
                    pa.array(key[keep].view(np.int64)),
                    pa.array(ids[keep]),
                    part.column(1).take(pa.array(owner[keep])),
                    pa.array((begin - words.first[owner])[keep].astype(np.int32)),
                    pa.array(count[keep].astype(np.int32)),
                    pa.array(name[keep].view(np.int64)),
                ]
                if once:
                    low, size = words.start[begin[keep]], np.where(single, 0, words.end[last] - words.start[begin])[keep]
                    ends = np.cumsum(size)
                    taken = np.repeat(low - (ends - size), size) + np.arange(int(size.sum()))
                    offsets = np.r_[0, ends].astype(np.int64)
                    columns.append(
                        pa.LargeBinaryArray.from_buffers(
                            pa.large_binary(), len(keep), [None, pa.py_buffer(offsets), pa.py_buffer(words.raw[taken])]
                        ).cast(pa.binary())
                    )
                yield pa.RecordBatch.from_arrays(columns, ["key", "id", "mark", "start", "windows", "name", "words"][: len(columns)])

    schema = "key bigint, id bigint, mark bigint, start int, windows int, name bigint" + (", words binary" if once else "")
    return rows.mapInArrow(emit, schema)


def earliest(part: pa.Table, window: int) -> pa.Table:
    """One shard: the smallest id that has each window of each distinct
    segment, for the segments where that can matter."""
    part = part.combine_chunks()
    own_low, own_high = part.column("low").to_numpy(), part.column("high").to_numpy()
    split = Splitter(lower=False).split(part.column("words").combine_chunks().cast(pa.string()))
    _, symbols = np.unique(split.hash, return_inverse=True)
    starts, owner = runs(split, window)
    index = FMIndex(symbols + 1, split.first[1:], window)
    low, high = index.search(starts, window)
    alone = high - low == 1
    smallest = own_low[owner]
    segment_at = np.zeros(len(index.text), np.int64)
    segment_at[index.place] = split.text_of
    id_at = np.r_[own_low[segment_at[index.order]], np.iinfo(np.int64).max]
    # Windows have one length, so their intervals are equal or disjoint.
    begin, example, which = np.unique(low[~alone], return_index=True, return_inverse=True)
    if len(begin):
        bounds = np.c_[begin, high[~alone][example]].ravel()
        smallest[~alone] = np.minimum.reduceat(id_at, bounds)[::2][which]
    useful = np.unique(owner[smallest < own_high[owner]])
    cuts = np.searchsorted(owner, np.arange(part.num_rows + 1))
    sizes = np.diff(cuts)[useful]
    inside = np.isin(owner, useful)
    offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
    return pa.table(
        {
            "key": part.column("key").take(pa.array(useful)),
            "name": part.column("name").take(pa.array(useful)),
            "smallest": pa.ListArray.from_arrays(offsets, pa.array(smallest[inside])),
        }
    )


def distinct_segments(rows: DataFrame, bits: np.ndarray, hot: np.ndarray, window: int, gram: int, shards: int) -> DataFrame:
    """``shard, key, name, low, high, words``: the distinct segments with their smallest and largest id."""
    return (
        segments(rows, bits, hot, window, gram, once=True)
        .withColumn("shard", F.pmod("key", F.lit(shards)))
        .repartition("shard")
        .groupBy("shard", "key", "name")
        .agg(F.min("id").alias("low"), F.max("id").alias("high"), F.first("words").alias("words"))
    )


def repeats(docs: DataFrame, id_col: str, text_col: str, window: int, gram: int) -> DataFrame:
    """``id, mark, found`` for texts with a repeated window; ``found`` is a
    set of (first word, one boolean per window from there). ``mark`` tells
    texts that share an id apart."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text"))
    anchors = stored(shared_anchors(rows, window, gram), "anchors")
    n_anchors = anchors.count()
    bits, hot = key_filter(anchors), key_filter(anchors.filter(F.col("segments") > HOT_SEGMENTS))
    shards = max(1, n_anchors // SHARD_ANCHORS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    distinct = distinct_segments(rows, bits, hot, window, gram, shards)

    @frees_memory
    def of_shard(part: pa.Table) -> pa.Table:
        return earliest(part, window)

    # A single window needs no index: its aggregate has the smallest id.
    single = F.length("words") == 0
    indexed = distinct.filter(~single).groupBy("shard").applyInArrow(of_shard, "key bigint, name bigint, smallest array<bigint>")
    known = indexed.unionByName(distinct.filter(single & (F.col("low") < F.col("high"))).select("key", "name", F.array("low").alias("smallest")))
    places = segments(rows, bits, hot, window, gram, once=False)
    flagged = places.join(known, ["key", "name"]).select(
        "id", "mark", "start", F.transform("smallest", lambda s: s < F.col("id")).alias("repeated")
    )
    flagged = flagged.filter(F.exists("repeated", lambda r: r))
    return flagged.groupBy("id", "mark").agg(F.collect_set(F.struct("start", "repeated")).alias("found"))


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """One row per input row: ``id_col, n_words, n_removed, kept`` (the kept words joined by one space).

    A word goes if a window over it also starts in a text with a smaller id;
    texts are judged as they came. Null texts have no words; a null id counts
    as smaller than any other; rows with equal ids never judge each other.
    An empty table gives an empty result.
    """
    found = stored(repeats(docs, id_col, text_col, window, gram), "repeats")
    name = F.xxhash64(F.coalesce("id", F.lit(NO_ID)), "mark")
    bits = docs.sparkSession.sparkContext.broadcast(key_filter(found.select(name.alias("key"))))
    id_type = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(
        F.col(id_col).alias("own"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
        F.xxhash64(text_col).alias("mark"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).withColumn("name", name)

    def choose(batches: Iterator[pa.RecordBatch], wanted: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = hits(bits.value, batch.column(4).to_numpy().view(np.uint64))
            yield batch.filter(pa.array(hit == wanted))

    @frees_memory
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(lower=False)
        for whole in batches:
            for batch in slices(whole, 3):
                words = splitter.split(batch.column(3))
                gone = np.zeros(len(words.hash) + 1, np.int64)
                if "found" in batch.schema.names:
                    for k, places in enumerate(batch.column(5).to_pylist()):
                        for place in places or ():
                            at = np.flatnonzero(place["repeated"]) + words.first[k] + place["start"]
                            np.add.at(gone, at, 1)
                            np.add.at(gone, at + window, -1)
                removed = np.cumsum(gone)[:-1] > 0
                raw, kept, counts = words.raw.tobytes(), [], []
                for k in range(len(batch)):
                    own = np.arange(words.first[k], words.first[k + 1])
                    stay = own[~removed[own]]
                    counts.append(len(own) - len(stay))
                    kept.append(b" ".join([raw[a:b] for a, b in zip(words.start[stay].tolist(), words.end[stay].tolist(), strict=True)]).decode())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.diff(words.first), pa.int64()), pa.array(counts, pa.int64()), pa.array(kept, pa.string())],
                    ["id", "n_words", "n_removed", "kept"],
                )

    out = f"id {id_type}, n_words bigint, n_removed bigint, kept string"
    clear = texts.mapInArrow(lambda b: choose(b, False), texts.schema).mapInArrow(cut, out)
    marked = texts.mapInArrow(lambda b: choose(b, True), texts.schema).join(found, ["id", "mark"], "left")
    marked = marked.select("own", "id", "mark", "text", "name", "found").mapInArrow(cut, out)
    return clear.unionByName(marked).withColumnRenamed("id", id_col)


def removal_digest(cleaned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return cleaned.select(id_col, "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
