"""Token ids in binary shards with a minimal perfect hash index.

Format, all in one folder:

* ``ids/shard-NNNNN.bin``  raw little-endian ids, 2 bytes each where the
  vocabulary has at most 65 536 entries, else 4; documents in ascending id
  order over all shards, no separators beyond the end id.
* ``shards/`` (Parquet)  one row per shard: shard, first (ids before it), ids.
* ``index/`` (Parquet)   one row per bucket of keys: a minimal perfect hash
  (``seeds``) and its ``records`` (fingerprint, shard, offset, length).

A key is a document id and its occurrence number. Access is constant time:
hash the key to its bucket, the seed to its slot, compare the stored
fingerprint, read one byte range.
"""

from __future__ import annotations

import json
import os
import sys
import types
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paxflow.llm.memory import frees_memory
from paxflow.llm.words import Splitter, buffer_of, mix, slices
from paxflow.plans.sizing import shared_dir

END_ID = 0
# Average keys per index bucket, and keys per seed.
BUCKET_KEYS = 2048
SEED_KEYS = 3
# Word pieces whose ids a worker process remembers.
CACHE_WORDS = 1 << 18
RECORD = np.dtype([("fingerprint", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("length", "<u8")])


# ------------------------------------------------------------------ encoding


class Encoder:
    """Ids of whole texts from the tokenizers library.

    A byte-level tokenizer splits a text before it merges, always between
    a visible character and the white space after it, and before a stop or
    comma that ends a word there. So texts of words, spaces and line feeds
    are cut at these places, all texts of a slice at once, and the ids of
    pieces met before are reused. A piece is known by its length,
    a 64-bit hash and its first and last eight bytes; should two pieces agree
    in the hash only, their texts are encoded whole. So are texts with other
    white space or an added token's string, and all texts if the tokenizer
    is of any other kind.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        parts = json.loads(spec)
        split = parts.get("pre_tokenizer") or {}
        self.by_piece = (
            split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space")
            and not any(parts.get(k) for k in ("normalizer", "truncation", "padding"))
        )
        self.added = [t["content"].encode() for t in parts.get("added_tokens", [])]
        # A byte-level token has one character per byte.
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.id_bytes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, number in vocabulary.items():
            self.id_bytes[number] = len(token)
        self.splitter = Splitter(lower=False)
        self.clear()

    def clear(self) -> None:
        """Forget all pieces. ``known`` has, by hash: hash, first and last bytes,
        place and number of ids in the pool, slices that had the piece."""
        self.pool = np.empty(0, np.uint32)
        self.known = np.empty(0, [("hash", "u8"), ("head", "u8"), ("tail", "u8"), ("first", "i8"), ("count", "i8"), ("slices", "i4")])

    def forget(self) -> None:
        """Keep the pieces that several slices had since the last time; or none, if those are most."""
        kept = self.known[self.known["slices"] > 1]
        if 2 * len(kept) > CACHE_WORDS:
            return self.clear()
        last = np.cumsum(kept["count"])
        place = np.repeat(kept["first"] - (last - kept["count"]), kept["count"]) + np.arange(int(last[-1]) if len(last) else 0)
        self.pool = self.pool[place]
        kept["first"], kept["slices"] = last - kept["count"], 0
        self.known = kept

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, raw: bytes, start: np.ndarray, end: np.ndarray, new: np.ndarray) -> None:
        """Encode new pieces. Those that start with white space and end
        without cannot join their neighbours, so they are encoded as one
        string and its ids dealt out by the bytes that they stand for."""
        pieces = [raw[x:y] for x, y in zip(start.tolist(), end.tolist(), strict=True)]
        joint = np.array([p[0] in b" \n" and p[-1] not in b" \n" for p in pieces], bool)
        together = [p for p, j in zip(pieces, joint, strict=True) if j]
        found = self._whole([b"".join(together).decode(), *(p.decode() for p, j in zip(pieces, joint, strict=True) if not j)])
        ends = np.cumsum([len(p) for p in together])
        count = np.zeros(len(pieces), np.int64)
        count[joint] = np.diff(np.searchsorted(np.cumsum(self.id_bytes[found[0]]), ends, side="right"), prepend=0)
        count[~joint] = [len(f) for f in found[1:]]
        order = np.argsort(~joint, kind="stable")
        new["count"][order] = count[order]
        new["first"][order] = len(self.pool) + np.cumsum(count[order]) - count[order]
        self.pool = np.concatenate([self.pool, *found])
        self.known = np.insert(self.known, np.searchsorted(self.known["hash"], new["hash"]), new)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, lengths): the ids of all texts, each followed by the end id."""
        raw, bounds = buffer_of(texts)
        if not self.by_piece:
            return self._replaced(texts, np.empty(0, np.uint32), np.zeros(len(texts) + 1, np.int64), np.ones(len(texts), bool))
        gap = (raw == 0x20) | (raw == 0x0A)
        opens = gap.copy()
        opens[1:] &= ~gap[:-1]
        opens[bounds[:-1][bounds[:-1] < len(raw)]] = True
        # A full stop or comma between a letter or digit and a gap is a token of its own.
        mark = np.flatnonzero(((raw[1:] == 0x2E) | (raw[1:] == 0x2C)) & _ALNUM[raw[:-1]]) + 1
        last = np.append(gap, True)
        last[bounds[1:]] = True
        opens[mark[last[mark + 1]]] = True
        start = np.flatnonzero(opens)
        end = np.r_[start[1:], len(raw)] if len(start) else start
        hashed = self.splitter.hashes(raw, start, end)
        hashes, example, which = np.unique(hashed, return_index=True, return_inverse=True)
        if len(self.known) > CACHE_WORDS:
            self.forget()
        seen = np.zeros(len(hashes), self.known.dtype)
        seen["hash"], seen["head"], seen["tail"] = hashes, *_ends(raw, start[example], end[example])
        at = np.searchsorted(self.known["hash"], hashes)
        missing = at == len(self.known)
        missing[~missing] = self.known["hash"][at[~missing]] != hashes[~missing]
        if missing.any():
            self._learn(raw.tobytes(), start[example[missing]], end[example[missing]], seen[missing])
        at = np.searchsorted(self.known["hash"], hashes)
        self.known["slices"][at] += 1
        entry = self.known[at]
        head, tail = _ends(raw, start, end)
        odd = (entry["head"][which] != head) | (entry["tail"][which] != tail)
        count = entry["count"][which]
        last = np.cumsum(count)
        total = int(last[-1]) if len(last) else 0
        place = np.repeat(entry["first"][which] - (last - count), count)
        place += np.arange(total)
        piece_of = np.searchsorted(start, bounds)
        cuts = np.r_[0, last][piece_of]
        whole = self._foreign(raw, bounds)
        if odd.any():
            whole[np.searchsorted(bounds, start[odd], side="right") - 1] = True
        return self._replaced(texts, self.pool[place], cuts, whole)

    def _replaced(self, texts: pa.Array, ids: np.ndarray, cuts: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.diff(cuts) + 1
        if not whole.any():
            return np.insert(ids, cuts[1:], np.uint32(END_ID)), lengths
        own = dict(zip(np.flatnonzero(whole).tolist(), self._whole(texts.filter(pa.array(whole)).to_pylist()), strict=True))
        parts = []
        for k in range(len(texts)):
            parts += [own.get(k, ids[cuts[k] : cuts[k + 1]]), np.full(1, END_ID, np.uint32)]
        for k, found in own.items():
            lengths[k] = len(found) + 1
        return np.concatenate(parts), lengths

    def _foreign(self, raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Texts that hold white space other than space and line feed, or an added token."""
        at = [np.flatnonzero(_CONTROL[raw])]
        lead = np.flatnonzero(_LEAD[raw[:-1]])
        second, third = raw[lead + 1], raw[np.minimum(lead + 2, len(raw) - 1)]
        first = raw[lead]
        at.append(
            lead[
                ((first == 0xC2) & ((second == 0x85) | (second == 0xA0)))
                | ((first == 0xE1) & (second == 0x9A) & (third == 0x80))
                | ((first == 0xE2) & (second == 0x80) & ((third <= 0x8A) | (third == 0xA8) | (third == 0xA9) | (third == 0xAF)))
                | ((first == 0xE2) & (second == 0x81) & (third == 0x9F))
                | ((first == 0xE3) & (second == 0x80) & (third == 0x80))
            ]
        )
        data = raw.tobytes() if self.added else b""
        for token in self.added:
            k = data.find(token)
            while k >= 0:
                at.append(np.array([k]))
                k = data.find(token, k + 1)
        out = np.zeros(len(bounds) - 1, bool)
        out[np.searchsorted(bounds, np.concatenate(at), side="right") - 1] = True
        return out


_ALNUM = np.array([b < 128 and chr(b).isalnum() for b in range(256)])
_CONTROL = np.zeros(256, bool)
_CONTROL[[0x09, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F]] = True
_LEAD = np.zeros(256, bool)
_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def _ends(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last eight bytes of each piece (fewer if it is shorter) as integers."""
    padded = np.zeros(len(raw) + 16, np.uint8)
    padded[8:-8] = raw
    # Eight bytes from every position on.
    eight = np.ndarray((len(raw) + 9,), "<u8", padded, strides=(1,))
    unused = (8 * (8 - np.minimum(end - start, 8))).astype(np.uint64)
    return eight[start + 8] << unused, eight[end] >> unused


def encoder_of_process(spec: str) -> Encoder:
    """The worker process's encoder. Workers are reused between tasks, and
    the code of a task is not, so what was learned hangs on ``sys.modules``."""
    holder = sys.modules.setdefault("_paxflow_token_encoders", types.ModuleType("_paxflow_token_encoders"))
    name = f"of_{zlib.crc32(spec.encode()):08x}"
    if not hasattr(holder, name):
        setattr(holder, name, Encoder(spec))
    return getattr(holder, name)


# ------------------------------------------------------------------ storage


def file_system(uri: str):
    """(file system, path) of a shared folder, local or remote."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def shard_path(folder: str, shard: int) -> str:
    return f"{folder}/ids/shard-{shard:05d}.bin"


@dataclass(frozen=True)
class TokenStore:
    """A written folder: what a reader needs to know."""

    folder: str
    buckets: int
    id_bytes: int

    def shards(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/shards")

    def index(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/index")


def key_columns(key: Column, occurrence: Column) -> tuple[Column, Column]:
    """Two independent hashes of a document key: placement and fingerprint."""
    name = F.concat_ws("#", F.coalesce(key.cast("string"), F.lit("")), key.isNull().cast("string"), occurrence.cast("string"))
    return F.xxhash64(name), F.xxhash64(F.lit("fingerprint"), name)


def perfect_hash(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(seeds, slots): a minimal perfect hash of distinct 64-bit keys by hash and displace.

    Keys share a seed per group; groups are placed from the largest down,
    each with the first seed that sends its keys to free slots. A group of
    one key names its free slot directly (-1 - slot).
    """
    n = len(keys)
    group = (mix(keys) % np.uint64(max(1, n // SEED_KEYS))).astype(np.int64)
    seeds, slots, taken = np.zeros(max(1, n // SEED_KEYS), np.int64), np.full(n, -1, np.int64), np.zeros(n, bool)
    order = np.argsort(group, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(group[order]) > 0]) if n else np.empty(0, np.int64)
    groups = np.split(order, starts[1:])
    for own in sorted((g for g in groups if len(g) > 1), key=lambda g: (-len(g), g[0])):
        base = np.uint64(1)
        while True:
            tries = np.arange(64, dtype=np.uint64) + base
            at = (mix(keys[own][None, :] ^ mix(tries)[:, None]) % np.uint64(n)).astype(np.int64)
            ranked = np.sort(at, axis=1)
            good = ~taken[at].any(axis=1) & (np.diff(ranked, axis=1) > 0).all(axis=1)
            if good.any():
                k = int(np.argmax(good))
                seeds[group[own[0]]], slots[own] = int(tries[k]), at[k]
                taken[at[k]] = True
                break
            base += np.uint64(64)
    free = iter(np.flatnonzero(~taken))
    for own in (g for g in groups if len(g) == 1):
        slots[own[0]] = next(free)
        seeds[group[own[0]]] = -1 - slots[own[0]]
    return seeds, slots


def slots_of(keys: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    seed = seeds[(mix(keys) % np.uint64(len(seeds))).astype(np.int64)]
    hashed = (mix(keys ^ mix(seed.astype(np.uint64))) % np.uint64(max(1, n))).astype(np.int64)
    return np.where(seed < 0, -1 - seed, hashed)


def write_tokens(
    docs: DataFrame,
    tokenizer_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    folder: str | None = None,
) -> TokenStore:
    """Encode and write every row of ``docs`` in ascending id order.

    Null texts are empty (one end id). A null id sorts first. Rows that
    repeat an id get occurrence numbers 0, 1, ... in the order of their
    texts' hashes. Each task writes its shard under a name of its attempt
    and renames it when complete, so a repeated task leaves the same file.
    """
    spark = docs.sparkSession
    folder = folder or shared_dir(spark, "llm-tokens")
    with open(tokenizer_file, encoding="utf-8") as f:
        spec = f.read()
    from tokenizers import Tokenizer

    id_bytes = 2 if Tokenizer.from_str(spec).get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
    shipped = spark.sparkContext.broadcast(spec)
    file_system(folder)[0].create_dir(f"{file_system(folder)[1]}/ids", recursive=True)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    id_type = rows.schema["id"].dataType.simpleString()

    @frees_memory
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, out, offset = encoder_of_process(shipped.value), None, 0
        task = TaskContext.get()
        store, root = file_system(folder)
        final = shard_path(root, task.partitionId())
        draft = f"{final}.{task.taskAttemptId()}"
        for batch in batches:
            if out is None:
                out = store.open_output_stream(draft)
            lengths = []
            for part in slices(batch, 1):
                ids, counts = encoder.encode(part.column(1))
                out.write(ids.astype(f"<u{id_bytes}").tobytes())
                lengths.append(counts)
            length = np.concatenate(lengths) if lengths else np.empty(0, np.int64)
            offsets = offset + np.cumsum(length) - length
            offset += int(length.sum())
            shard = np.full(len(length), task.partitionId(), np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(shard), pa.array(offsets), pa.array(length)], ["id", "shard", "offset", "length"]
            )
        if out is not None:
            out.close()
            store.move(draft, final)

    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        encode, f"id {id_type}, shard int, offset bigint, length bigint"
    )
    placed.write.parquet(f"{folder}/rows")
    placed = spark.read.parquet(f"{folder}/rows")
    # One row per shard, as many as there are tasks.
    sums = placed.groupBy("shard").agg(F.sum("length").alias("ids"), F.count("*").alias("rows"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sums.select(
        "shard", "ids", "rows", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("first"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first_row"),
    ).write.parquet(f"{folder}/shards")
    buckets = write_index(spark, folder)
    return TokenStore(folder, buckets, id_bytes)


def write_index(spark: SparkSession, folder: str) -> int:
    placed = spark.read.parquet(f"{folder}/rows")
    buckets = max(1, placed.count() // BUCKET_KEYS)
    # Rows of one id follow each other, so the occurrence is the distance to the first of them.
    in_shard = Window.partitionBy("shard").orderBy("offset")
    numbered = placed.withColumn("row", F.row_number().over(in_shard) - 1).join(
        spark.read.parquet(f"{folder}/shards").select("shard", "first_row"), "shard"
    )
    numbered = numbered.withColumn("row", F.col("row") + F.col("first_row"))
    firsts = numbered.groupBy("id").agg(F.min("row").alias("first_of_id")).withColumnRenamed("id", "of")
    keyed = numbered.join(firsts, F.col("id").eqNullSafe(F.col("of")))
    key, fingerprint = key_columns(F.col("id"), F.col("row") - F.col("first_of_id"))
    entries = keyed.select(key.alias("key"), fingerprint.alias("fingerprint"), "shard", "offset", "length").withColumn(
        "bucket", F.pmod("key", F.lit(buckets))
    )

    @frees_memory
    def build(part: pd.DataFrame) -> pd.DataFrame:
        prints = part["fingerprint"].to_numpy().astype(np.uint64)
        keys = mix(part["key"].to_numpy().astype(np.uint64)) ^ prints
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two document keys share both hashes")
        seeds, slots = perfect_hash(keys)
        records = np.zeros(len(part), RECORD)
        records["fingerprint"][slots] = (prints >> np.uint64(32)).astype(np.uint32)
        for name in ("shard", "offset", "length"):
            records[name][slots] = part[name].to_numpy()
        return pd.DataFrame(
            {"bucket": [part["bucket"].iloc[0]], "keys": [len(part)], "seeds": [seeds.astype("<i8").tobytes()], "records": [records.tobytes()]}
        )

    index = entries.groupBy("bucket").applyInPandas(build, "bucket bigint, keys int, seeds binary, records binary")
    index.write.parquet(f"{folder}/index")
    return buckets


# ------------------------------------------------------------------ reading


def look_up(store: TokenStore, wanted: DataFrame) -> DataFrame:
    """Keyed access for a table of (id, occurrence): adds shard, offset, length.

    Keys that are not in the store are left out (but for a 32-bit
    fingerprint's chance of a false match).
    """
    key, fingerprint = key_columns(F.col("id"), F.col("occurrence"))
    asked = wanted.select("id", "occurrence", key.alias("key"), fingerprint.alias("fingerprint")).withColumn(
        "bucket", F.pmod("key", F.lit(store.buckets))
    )
    id_type = wanted.schema["id"].dataType.simpleString()

    @frees_memory
    def probe(asked: pa.Table, index: pa.Table) -> pa.Table:
        if not index.num_rows:
            asked = asked.slice(0, 0)
            seeds, records = np.zeros(1, "<i8"), np.zeros(1, RECORD)
        else:
            seeds = np.frombuffer(index.column("seeds")[0].as_py(), "<i8")
            records = np.frombuffer(index.column("records")[0].as_py(), RECORD)
        prints = asked.column("fingerprint").to_numpy().astype(np.uint64)
        found = records[slots_of(mix(asked.column("key").to_numpy().astype(np.uint64)) ^ prints, seeds, len(records))]
        out = asked.select(["id", "occurrence"])
        for name, kind in (("shard", np.int32), ("offset", np.int64), ("length", np.int64)):
            out = out.append_column(name, pa.array(found[name].astype(kind)))
        return out.filter(pa.array(found["fingerprint"] == (prints >> np.uint64(32)).astype(np.uint32)))

    index = store.index(wanted.sparkSession).select("bucket", "seeds", "records")
    return asked.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(
        probe, f"id {id_type}, occurrence bigint, shard int, offset bigint, length bigint"
    )


def read_digests(store: TokenStore, wanted: DataFrame) -> DataFrame:
    """Read the payload of each wanted (id, occurrence) from the shard files:
    ``id, occurrence, start, n_tokens, ids_crc32``. The digest is over the
    ids as little-endian unsigned 32-bit integers."""
    spark = wanted.sparkSession
    id_type = wanted.schema["id"].dataType.simpleString()
    width, folder = store.id_bytes, store.folder

    @frees_memory
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = file_system(folder)
        open_shard, source = None, None
        for batch in batches:
            crcs, counts = [], []
            for shard, offset, length in zip(*(batch.column(k).to_numpy() for k in (2, 3, 4)), strict=True):
                if shard != open_shard:
                    if source is not None:
                        source.close()
                    open_shard, source = shard, files.open_input_file(shard_path(root, int(shard)))
                raw = source.read_at(int(length) * width, int(offset) * width)
                ids = np.frombuffer(raw, f"<u{width}").astype("<u4")
                counts.append(len(ids))
                crcs.append(zlib.crc32(ids.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), batch.column(3), pa.array(counts, pa.int64()), pa.array(crcs, pa.int64())],
                ["id", "occurrence", "shard", "offset", "n_tokens", "ids_crc32"],
            )
        if source is not None:
            source.close()

    placed = look_up(store, wanted).repartitionByRange("shard", "offset").sortWithinPartitions("shard", "offset")
    digests = placed.mapInArrow(
        read, f"id {id_type}, occurrence bigint, shard int, offset bigint, n_tokens bigint, ids_crc32 bigint"
    )
    return digests.join(store.shards(spark).select("shard", "first"), "shard").select(
        "id", "occurrence", (F.col("first") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_digests(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``docs`` as token shards, read them back by key: ``id_col,
    start, n_tokens, ids_crc32``, one row per input row (repeated ids have
    one row per repetition). An empty table gives an empty result."""
    store = write_tokens(docs, tokenizer_file, id_col, text_col)
    counts = docs.groupBy(F.col(id_col).alias("id")).agg(F.count("*").alias("n"))
    wanted = counts.select("id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("occurrence"))
    return read_digests(store, wanted).select(F.col("id").alias(id_col), "start", "n_tokens", "ids_crc32")
