"""N-gram Jaccard self-join by prefix filters under several global token orders.

A document is its set of distinct 5-word shingles; two link at a Jaccard
similarity of at least 0.8. Whatever the global order of tokens, two linked
sets share tokens among their first ones (their prefixes), so a pair may be
dropped as soon as its prefixes have nothing in common under one order.

1. Equal sets are one class (a 64-bit signature); everything below runs on
   one set per class.
2. By hash order, each class sends a prefix; classes with too few tokens
   that another class shares have no partner at all.
3. The sets left count each token's classes. The orders used from here are
   rarest first, with different hashes deciding ties.
4. Classes whose prefixes under the first order share a token are candidate
   neighbours; the components of that graph are verified apart, large ones
   as pairs of blocks. Within a block pair, candidates must share prefix
   tokens under every order and fit in size before their sets are counted.

Nothing emits a row per candidate pair: a block pair returns one row per
document, its smallest linked neighbour and its number of links. Tokens that
several classes of one slice share are sent once per slice, whatever share
of all rows holds them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paxflow.llm.components import components
from paxflow.llm.keyfilter import hits, key_filter
from paxflow.llm.memory import frees_memory
from paxflow.llm.words import Splitter, Words, combine, mix, runs, slices
from paxflow.plans.sizing import bounded_broadcast, stored

SHINGLE = 5
ORDER_SALTS = (0, 0x51ED270B, 0x2545F491)
# Classes per chunk when tokens are counted, and documents per verification block.
CHUNK_SETS = 2000
BLOCK_SETS = 1000
COLUMNS = 4096
# Cluster rows (32 bytes each) up to this many may be sent to every task; more are joined by shuffle.
SMALL_LIST = 1_000_000
NO_ID = -(1 << 63)  # a null id
MANY = 0  # owner of a token that several classes of the slice hold


def overlap_needed(n: np.ndarray) -> np.ndarray:
    """The least overlap of a set of n tokens with any linked set: ceil(0.8 n)."""
    return -(-4 * n // 5)


def spare(n: np.ndarray) -> np.ndarray:
    """Tokens by which the first prefix is longer than it must be; two linked
    sets share that many prefix tokens (of the smaller allowance)."""
    return np.maximum(1, n // 10)


def shingle_sets(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, bounds): each text's distinct shingles in hash order; text k's
    are tokens[bounds[k]:bounds[k + 1]]. Fewer than n words are one shingle."""
    starts, text = runs(words, n)
    found, owners = [combine(words.hash, starts, n)], [text]
    counts = np.diff(words.first)
    for short in range(1, n):
        own = np.flatnonzero(counts == short)
        found.append(combine(words.hash, words.first[own], short, salt=short))
        owners.append(own)
    tokens, owner = np.concatenate(found), np.concatenate(owners)
    order = np.lexsort((tokens, owner))
    tokens, owner = tokens[order], owner[order]
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
    tokens, owner = tokens[new], owner[new]
    return tokens, np.searchsorted(owner, np.arange(len(counts) + 1))


def signatures(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A hash of each set, as a signed 64-bit integer; never MANY."""
    sums = np.r_[np.uint64(0), np.cumsum(mix(tokens ^ np.uint64(0xA0761D6478BD642F)))]
    sizes = np.diff(bounds).astype(np.uint64)
    found = mix((sums[bounds[1:]] - sums[bounds[:-1]]) ^ mix(sizes)).view(np.int64)
    return np.where(found == MANY, 1, found)


def _position(bounds: np.ndarray) -> np.ndarray:
    """Each token's place in its set."""
    return np.arange(bounds[-1]) - np.repeat(bounds[:-1], np.diff(bounds))


def _by_bucket(keys: np.ndarray, buckets: int) -> list[tuple[int, slice]]:
    """Sorted keys cut where their leading bits change."""
    bits = buckets.bit_length() - 1
    cuts = np.searchsorted(keys >> np.uint64(64 - bits), np.arange(buckets + 1).astype(np.uint64))
    return [(b, slice(int(x), int(y))) for b, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if y > x]


def bucket_count(df: DataFrame) -> int:
    """A power of two, twice the shuffle partitions at least."""
    return 1 << max(6, (2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())


# ------------------------------------------------------------------ classes that may have a partner


def _first_pass(rows: DataFrame, n: int) -> DataFrame:
    """``id, n, sig`` per row and ``sig, shared`` per class and bucket, in one table."""
    buckets = bucket_count(rows)

    @frees_memory
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(lower=True)
        turn = 0
        for batch in batches:
            for part in slices(batch, 1):
                tokens, bounds = shingle_sets(splitter.split(part.column(1)), n)
                sizes, sigs = np.diff(bounds), signatures(tokens, bounds)
                turn += 1
                info = (mix(np.array([turn], np.uint64) ^ sigs[:1].view(np.uint64)) % np.uint64(buckets)).item()
                # One copy of each class in the slice; the tokens of its prefix.
                first = np.zeros(len(sigs), bool)
                first[np.unique(sigs, return_index=True)[1]] = True
                length = np.where(first, sizes - overlap_needed(sizes) + spare(sizes), 0)
                inside = _position(bounds) < np.repeat(np.minimum(length, sizes), sizes)
                key, owner = tokens[inside], np.repeat(sigs, sizes)[inside]
                order = np.argsort(key, kind="stable")
                key, owner = key[order], owner[order]
                start = np.flatnonzero(np.r_[np.ones(min(1, len(key)), bool), key[1:] != key[:-1]])
                count = np.diff(np.r_[start, len(key)])
                shared = np.repeat(count > 1, count)
                one_key, one_owner = key[start], np.where(count > 1, MANY, owner[start])
                out = {b: (one_key[s], one_owner[s]) for b, s in _by_bucket(one_key, buckets)}
                local = {b: owner[s] for b, s in _by_bucket(key, buckets)}
                local = {b: o[shared[s]] for (b, s), o in zip(_by_bucket(key, buckets), local.values(), strict=True)}
                none = np.empty(0, np.int64)
                listed = sorted(out.keys() | {info})
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(listed, pa.int32()),
                        pa.array([out.get(b, (none, none))[0].tobytes() for b in listed], pa.binary()),
                        pa.array([out.get(b, (none, none))[1].tobytes() for b in listed], pa.binary()),
                        pa.array([local.get(b, none).tobytes() for b in listed], pa.binary()),
                        pa.array([part.column(0).fill_null(NO_ID).to_numpy().tobytes() if b == info else b"" for b in listed], pa.binary()),
                        pa.array([sizes.astype(np.int64).tobytes() if b == info else b"" for b in listed], pa.binary()),
                        pa.array([sigs.tobytes() if b == info else b"" for b in listed], pa.binary()),
                    ],
                    ["bucket", "keys", "owners", "shared", "ids", "sizes", "sigs"],
                )

    @frees_memory
    def count(part: pd.DataFrame) -> pd.DataFrame:
        key = np.frombuffer(b"".join(part["keys"]), np.uint64)
        owner = np.frombuffer(b"".join(part["owners"]), np.int64)
        order = np.argsort(key, kind="stable")
        key, owner = key[order], owner[order]
        start = np.flatnonzero(np.r_[np.ones(min(1, len(key)), bool), key[1:] != key[:-1]])
        size = np.diff(np.r_[start, len(key)])
        if len(key):
            many = (np.minimum.reduceat(owner, start) != np.maximum.reduceat(owner, start)) | (owner[start] == MANY)
            hit = np.repeat(many, size) & (owner != MANY)
            # An owner sends a token once per slice: count it once.
            pairs = np.unique(np.c_[owner[hit], key[hit].view(np.int64)], axis=0)[:, 0]
        else:
            pairs = owner
        pairs = np.concatenate([pairs, np.frombuffer(b"".join(part["shared"]), np.int64)])
        sig, shared = np.unique(pairs, return_counts=True)
        told = part[part["sigs"].map(len) > 0]
        ids = np.frombuffer(b"".join(told["ids"]), np.int64)
        own = pd.array(ids, "Int64")
        own[ids == NO_ID] = pd.NA
        return pd.DataFrame(
            {
                "sig": np.concatenate([sig, np.frombuffer(b"".join(told["sigs"]), np.int64)]),
                "shared": pd.array([*shared.tolist(), *[None] * len(ids)], "Int64"),
                "id": pd.concat([pd.Series(pd.array([pd.NA] * len(sig), "Int64")), pd.Series(own)], ignore_index=True),
                "n": pd.array([*[None] * len(sig), *np.frombuffer(b"".join(told["sizes"]), np.int64).tolist()], "Int64"),
            }
        )

    sent = rows.mapInArrow(
        emit, "bucket int, keys binary, owners binary, shared binary, ids binary, sizes binary, sigs binary"
    )
    return stored(sent.groupBy("bucket").applyInPandas(count, "sig bigint, shared bigint, id bigint, n bigint"), "shingles")


def _sets(rows: DataFrame, sigs: DataFrame, n: int, chunks: int) -> DataFrame:
    """``chunk, sig, tokens`` of the classes listed, one row each (and of a
    few others that the filter lets through; they are not told apart here)."""
    bits = rows.sparkSession.sparkContext.broadcast(key_filter(sigs.select(F.col("sig").alias("key"))))

    @frees_memory
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, sent = Splitter(lower=True), set()
        for batch in batches:
            for part in slices(batch, 1):
                tokens, bounds = shingle_sets(splitter.split(part.column(1)), n)
                found = signatures(tokens, bounds)
                hit = hits(bits.value, found.view(np.uint64))
                own = [k for k in np.flatnonzero(hit).tolist() if found[k] not in sent and not sent.add(found[k])]
                if len(sent) > 1_000_000:
                    sent.clear()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[own], pa.int64()), pa.array([tokens[bounds[k] : bounds[k + 1]].tobytes() for k in own], pa.binary())],
                    ["sig", "tokens"],
                )

    sent = rows.mapInArrow(emit, "sig bigint, tokens binary").withColumn("chunk", F.pmod(F.xxhash64("sig"), F.lit(chunks)))
    return sent.repartition("chunk").groupBy("chunk", "sig").agg(F.first("tokens").alias("tokens"))


# ------------------------------------------------------------------ rarity


def with_frequencies(sets: DataFrame) -> DataFrame:
    """``sets`` (sig, tokens, chunk, ...) plus ``counts``: in how many sets each token occurs (uint32)."""
    buckets = bucket_count(sets)

    @frees_memory
    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A chunk lies in one file; should it be read in parts, its counts arrive in parts.
        for batch in batches:
            chunk = batch.column(0).to_numpy()
            for own in np.unique(chunk).tolist():
                tokens = batch.column(1).filter(pa.array(chunk == own)).to_pylist()
                key, count = np.unique(np.frombuffer(b"".join(tokens), np.uint64), return_counts=True)
                cut = _by_bucket(key, buckets)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([b for b, _ in cut], pa.int32()),
                        pa.array([own] * len(cut), pa.int64()),
                        pa.array([key[s].tobytes() for _, s in cut], pa.binary()),
                        pa.array([count[s].astype(np.uint32).tobytes() for _, s in cut], pa.binary()),
                    ],
                    ["bucket", "chunk", "keys", "counts"],
                )

    @frees_memory
    def add(part: pd.DataFrame) -> pd.DataFrame:
        key = np.frombuffer(b"".join(part["keys"]), np.uint64)
        count = np.frombuffer(b"".join(part["counts"]), np.uint32).astype(np.int64)
        order = np.argsort(key, kind="stable")
        start = np.flatnonzero(np.r_[True, np.diff(key[order].view(np.int64)) != 0])
        total = np.empty(len(key), np.int64)
        total[order] = np.repeat(np.add.reduceat(count[order], start), np.diff(np.r_[start, len(key)]))
        ends = np.cumsum([len(k) // 8 for k in part["keys"]])
        out = []
        for chunk, a, b in zip(part["chunk"], ends - np.diff(ends, prepend=0), ends, strict=True):
            common = total[a:b] > 1
            out.append((chunk, key[a:b][common].tobytes(), np.minimum(total[a:b][common], 0xFFFFFFFF).astype(np.uint32).tobytes()))
        return pd.DataFrame(out, columns=["chunk", "keys", "counts"])

    @frees_memory
    def merge(sets: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        if sets.empty:
            return sets.assign(counts=[])
        key, first = np.unique(np.frombuffer(b"".join(told["keys"]), np.uint64), return_index=True)
        count = np.frombuffer(b"".join(told["counts"]), np.uint32)[first]
        key, count = np.r_[key, np.uint64(0)], np.r_[count, np.uint32(0)]
        out = []
        for raw in sets["tokens"]:
            own = np.frombuffer(raw, np.uint64)
            at = np.searchsorted(key[:-1], own)
            out.append(np.where((key[at] == own) & (at < len(key) - 1), count[at], 1).astype(np.uint32).tobytes())
        return sets.assign(counts=out)

    told = sets.select("chunk", "tokens").mapInArrow(tell, "bucket int, chunk bigint, keys binary, counts binary")
    totals = told.groupBy("bucket").applyInPandas(add, "chunk bigint, keys binary, counts binary")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sets.schema.fields)
    return sets.groupBy("chunk").cogroup(totals.groupBy("chunk")).applyInPandas(merge, f"{columns}, counts binary")


def prefix(tokens: np.ndarray, counts: np.ndarray, salt: int) -> np.ndarray:
    """The first tokens of a set under the order (frequency, salted hash) that a linked set must meet."""
    n = len(tokens)
    length = n - int(overlap_needed(np.int64(n))) + 1
    ranked = np.lexsort((mix(tokens ^ np.uint64(salt)) if salt else tokens, counts))[:length]
    return tokens[ranked[counts[ranked] > 1]]


def candidate_edges(ordered: DataFrame) -> DataFrame:
    """``a, b``: each class and the smallest class that shares one of its prefix tokens."""

    @frees_memory
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sigs = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for sig, tokens, counts in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                own = prefix(np.frombuffer(tokens, np.uint64), np.frombuffer(counts, np.uint32), ORDER_SALTS[0])
                keys.append(own)
                sigs.append(np.full(len(own), sig, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(sigs))], ["key", "sig"])

    postings = ordered.select("sig", "tokens", "counts").mapInArrow(emit, "key bigint, sig bigint")
    least = postings.groupBy("key").agg(F.min("sig").alias("b"), F.max("sig").alias("top")).filter("b < top").select("key", "b")
    return postings.join(least, "key").filter("sig <> b").select(F.col("sig").alias("a"), "b").distinct()


# ------------------------------------------------------------------ verification


class _Shared:
    """Incidence of the tokens that at least two of the sets hold, by column blocks."""

    def __init__(self, lists: list[np.ndarray]):
        flat = np.concatenate(lists) if lists else np.empty(0, np.uint64)
        row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
        common = count[column] > 1
        rank = np.cumsum(count > 1) - 1
        self.row, self.column, self.width, self.height = row[common], rank[column[common]], int((count > 1).sum()), len(lists)
        order = np.argsort(self.column, kind="stable")
        self.row, self.column = self.row[order], self.column[order]

    def overlaps(self) -> np.ndarray:
        """How many tokens each two sets share."""
        total = np.zeros((self.height, self.height), np.float32)
        for at in range(0, self.width, COLUMNS):
            a, b = np.searchsorted(self.column, [at, at + COLUMNS])
            block = np.zeros((self.height, min(COLUMNS, self.width - at)), np.float32)
            block[self.row[a:b], self.column[a:b] - at] = 1.0
            total += block @ block.T
        return total


def verify(sets: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(group, weight) for sets with columns tokens, counts, size, block: the
    smallest index each set is connected to, and the summed sizes of the sets
    linked to it. Sets of the same block are compared only if all are of one block."""
    tokens = [np.frombuffer(t, np.uint64) for t in sets["tokens"]]
    counts = [np.frombuffer(c, np.uint32) for c in sets["counts"]]
    n = np.array([len(t) for t in tokens], np.int64)
    block = sets["block"].to_numpy()
    allowed = ~np.eye(len(n), dtype=bool)
    if len(np.unique(block)) > 1:
        allowed &= block[:, None] != block[None, :]
    least = overlap_needed(n)
    allowed &= (n[None, :] >= least[:, None]) & (n[:, None] >= least[None, :])
    # Every order's filter must let a pair pass.
    for salt in ORDER_SALTS:
        if not allowed.any():
            break
        allowed &= _Shared([prefix(t, c, salt) for t, c in zip(tokens, counts, strict=True)]).overlaps() > 0
    asked = np.flatnonzero(allowed.any(axis=1))
    group, weight = np.arange(len(n)), np.zeros(len(n), np.int64)
    if not len(asked):
        return group, weight
    common = _Shared([tokens[k] for k in asked]).overlaps().astype(np.int64)
    union = n[asked][:, None] + n[asked][None, :] - common
    linked = allowed[np.ix_(asked, asked)] & (100 * common >= 80 * union)
    weight[asked] = linked @ sets["size"].to_numpy()[asked]
    own = asked.copy()
    while True:
        near = np.where(linked, own[None, :], len(n)).min(axis=1)
        new = np.minimum(own, near)
        back = np.zeros(len(n), np.int64)
        back[:] = np.arange(len(n))
        back[asked] = new
        new = back[new]
        if (new == own).all():
            break
        own = new
    group[asked] = own
    return group, weight


def _verified(sets: DataFrame) -> DataFrame:
    """``sig, other, links`` from units of sets: columns unit, cluster, block, sig, size, tokens, counts."""

    @frees_memory
    def check(part: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"sig": np.empty(0, np.int64), "other": np.empty(0, np.int64), "links": np.empty(0, np.int64)})]
        for _, own in part.groupby("cluster", sort=False):
            group, weight = verify(own)
            sig, hit = own["sig"].to_numpy(), weight > 0
            out.append(pd.DataFrame({"sig": sig[hit], "other": sig[group[hit]], "links": weight[hit]}))
        return pd.concat(out)

    return sets.groupBy("unit").applyInPandas(check, "sig bigint, other bigint, links bigint")


def _units(clustered: DataFrame) -> DataFrame:
    """Sets of small clusters by hash of the cluster; sets of large ones once per pair of blocks."""
    partitions = int(clustered.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    small = clustered.filter("blocks = 1").select(
        F.concat(F.lit("s"), F.pmod(F.xxhash64("cluster"), F.lit(4 * partitions)).cast("string")).alias("unit"),
        "cluster", F.lit(0).cast("long").alias("block"), "sig", "size", "tokens", "counts",
    )
    block: Column = F.pmod(F.xxhash64("sig"), F.col("blocks"))
    large = (
        clustered.filter("blocks > 1")
        .withColumn("block", block)
        .withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select(
            F.concat_ws(":", "cluster", F.least("block", "with"), F.greatest("block", "with")).alias("unit"),
            "cluster", "block", "sig", "size", "tokens", "counts",
        )
    )
    return small.unionByName(large)


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE) -> DataFrame:
    """One row per input row: ``id_col, n_shingles, component_id, n_links``.

    ``component_id`` is the smallest id reachable by links, itself included;
    ``n_links`` counts the other rows that the row links to, copies of the
    same set included. Null and empty texts have no shingles and link with
    nothing. A null id takes no part in a component's smallest id. Rows that
    share id and text are rows of one class. An empty table gives an empty
    result; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    first = _first_pass(rows, n)
    members = first.filter("n is not null").select("sig", "id", "n")
    shared = first.filter("shared is not null").groupBy("sig").agg(F.sum("shared").alias("shared"))
    classes = stored(
        members.filter("n > 0").groupBy("sig").agg(F.min("id").alias("low"), F.max("n").alias("n"), F.count("*").alias("size")), "classes"
    )
    # The least number of prefix tokens that a linked class must share (see spare).
    needed = F.greatest(F.lit(1), F.floor(F.ceil(F.col("n") * 4 / F.lit(5)) / F.lit(10)))
    partners = stored(classes.join(shared, "sig").filter(F.col("shared") >= needed).select("sig", "size"), "partners")

    chunks = max(1, partners.count() // CHUNK_SETS)
    sets = stored(_sets(rows, partners, n, chunks), "sets")
    ordered = stored(with_frequencies(sets), "ordered")
    clusters = components(candidate_edges(ordered)).select(F.col("node").alias("sig"), F.col("component").alias("cluster"))
    clusters = stored(clusters.join(classes.select("sig", "size"), "sig"), "clusters")
    blocks = clusters.groupBy("cluster").agg(F.ceil(F.count("*") / F.lit(BLOCK_SETS)).alias("blocks"))
    clustered = ordered.select("sig", "tokens", "counts").join(bounded_broadcast(clusters.join(blocks, "cluster"), SMALL_LIST), "sig")
    links = stored(_verified(_units(clustered)), "links")

    found = components(links.filter("sig <> other").select(F.col("sig").alias("a"), F.col("other").alias("b")))
    in_component = found.join(classes.select(F.col("sig").alias("node"), "low"), "node")
    lowest = in_component.groupBy("component").agg(F.min("low").alias("component_id"))
    of_class = found.join(lowest, "component").select(F.col("node").alias("sig"), "component_id")
    counts = links.groupBy("sig").agg(F.sum("links").alias("links"))
    told = classes.join(of_class, "sig", "left").join(counts, "sig", "left")
    told = told.select(
        "sig",
        F.coalesce("component_id", "low").alias("component_id"),
        (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    joined = members.join(told, "sig", "left")
    alone = F.col("n") == 0
    return joined.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
    )
