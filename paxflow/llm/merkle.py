"""Merkle manifest of a dataset, with hash states kept before each child slot.

Rows are leaves; the leaves of a source, in order of their ids, form a tree
of fan-out 16, and the sources' roots form one more. A parent is the SHA-256
of its children's digests as hex text. One hex digest is exactly one block of
SHA-256, so the state of a parent's hash *before each child* is 32 bytes; the
manifest keeps a copy of it with every node. When a leaf changes, each parent
on its way resumes the state before the changed slot and takes in the new
digest and the siblings to its right; siblings to the left are not read.

Trees are cut into pages of three levels (at most 4096 nodes of one tree).
Tasks build whole pages; page roots are the nodes of the next round. A source
that holds a third of all rows is thousands of pages, and a page is never
split nor gathered with others beyond a bounded buffer. Proofs go the other
way: a page receives the way from its root to the top (a few hundred bytes a
level) and hands one to each of its nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paxflow.llm import midstate as sha
from paxflow.llm.memory import frees_memory
from paxflow.plans.sizing import stored

FANOUT = 16
PAGE_LEVELS = 3
PAGE = FANOUT**PAGE_LEVELS
# Whole pages are handled together, at least this many rows of them at a time.
BUFFER_ROWS = 8 * PAGE

# One level of a way to the top, as 32-bit words: the node's slot, the number
# of nodes in its run, the state before the slot, the digests of the run.
_STEP = 2 + 8 + 8 * FANOUT

TOP = ""  # key of the tree over the sources; a source's own key is never empty

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field_bytes(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def source_key(source: Column) -> Column:
    """A text that is never null and sorts like the source, null first."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("-"))


@dataclass(frozen=True)
class Manifest:
    """Stored tables of the tree, one entry of ``rounds`` and ``top_rounds`` per round of pages.

    ``leaves``: key, idx (place in the source), doc_id, leaf and the columns
    carried along. Pages: key, page, n (nodes of the tree in this round),
    digest (of the page's root), digests and states (of all its nodes, level by level).
    """

    leaves: DataFrame
    rounds: list[DataFrame]
    top_rounds: list[DataFrame]
    sources: DataFrame  # key, idx, digest: the roots of the sources


_PAGES = "key string, page bigint, n bigint, digest binary, digests binary, states binary"
_WAYS = "key string, idx bigint, root binary, way binary"


def _levels(n: np.ndarray) -> np.ndarray:
    """Levels of hashing inside a page of a tree of ``n`` nodes; a single node needs none."""
    return np.select([n <= FANOUT**k for k in range(PAGE_LEVELS)], range(PAGE_LEVELS), PAGE_LEVELS)


def _hash_runs(digests: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(parents' digests, state before each child) of runs of children."""
    blocks = sha.hex_block(digests)
    states = np.empty((8, len(digests)), np.uint32)
    now = sha.initial(len(starts))
    for slot in range(FANOUT):
        live = np.flatnonzero(counts > slot)
        if not len(live):
            break
        at = starts[live] + slot
        states[:, at] = now[:, live]
        now[:, live] = sha.absorb(now[:, live], blocks[:, at])
    return sha.finish(now, counts).T, states.T


def _run_starts(page: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Where runs begin among nodes in order: with each page, and every 16th place."""
    return np.flatnonzero((place % FANOUT == 0) | np.r_[True, page[1:] != page[:-1]])


def _build(nodes: np.ndarray, page: np.ndarray, place: np.ndarray, levels: np.ndarray) -> list[tuple]:
    """Nodes of whole pages, level by level: (digests, states, page, place)."""
    found = []
    for level in range(PAGE_LEVELS + 1):
        alive = levels[page] > level
        states = np.zeros((len(nodes), 8), np.uint32)
        parents = np.empty((0, 8), np.uint32)
        inner, own = np.flatnonzero(alive), np.empty(0, np.int64)
        if len(inner):
            starts = _run_starts(page[inner], place[inner])
            counts = np.diff(np.r_[starts, len(inner)])
            parents, states[inner] = _hash_runs(nodes[inner], starts, counts)
            own = inner[starts]
        found.append((nodes, states, page, place))
        nodes, page, place = parents, page[own], place[own] // FANOUT
    return found


def _whole_pages(batches: Iterator[pa.RecordBatch], key: int, page: int) -> Iterator[pa.Table]:
    """Rows in order of (key, page), regrouped so that no page is cut."""
    kept: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append(batch)
        rows += batch.num_rows
        if rows < BUFFER_ROWS:
            continue
        table = pa.Table.from_batches(kept)
        edges = _edges(table, key, page)
        if len(edges) > 1:
            cut = int(edges[-1])
            yield table.slice(0, cut)
            kept, rows = table.slice(cut).combine_chunks().to_batches(), table.num_rows - cut
    if kept:
        yield pa.Table.from_batches(kept)


def _edges(table: pa.Table, key: int, page: int) -> np.ndarray:
    """The first row of each page."""
    codes = table.column(key).combine_chunks().dictionary_encode()
    codes = codes.combine_chunks() if isinstance(codes, pa.ChunkedArray) else codes
    code = codes.indices.to_numpy(zero_copy_only=False)
    number = table.column(page).to_numpy()
    return np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (number[1:] != number[:-1])])


def _joined(column: pa.ChunkedArray) -> np.ndarray:
    """All bytes of a binary column, one after another, as digests."""
    return sha.from_bytes(b"".join(column.to_pylist()))


def _by_page(rows: DataFrame, *order: str) -> DataFrame:
    return rows.repartition("key", "page").sortWithinPartitions("key", "page", *order)


def _pages(nodes: DataFrame) -> DataFrame:
    """Pages over nodes (key, idx, n, digest), hashed in tasks that hold whole pages."""

    @frees_memory
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_pages(batches, 0, 1):
            edges = _edges(table, 0, 1)
            sizes = np.diff(np.r_[edges, table.num_rows])
            page = np.repeat(np.arange(len(edges)), sizes)
            place = np.arange(table.num_rows) - np.repeat(edges, sizes)
            total = table.column(3).to_numpy()[edges]
            built = _build(_joined(table.column(4)), page, place, _levels(total))
            heads = table.take(pa.array(edges))
            # nodes are in page order on every level, so a page's part of a level is a slice
            bounds = [np.searchsorted(of, np.arange(len(edges) + 1)) for _, _, of, _ in built]
            roots, digests, states = [], [], []
            for p in range(len(edges)):
                own = [(d[b[p] : b[p + 1]], s[b[p] : b[p + 1]]) for (d, s, _, _), b in zip(built, bounds, strict=True)]
                roots.append(sha.to_bytes(next(d for d, _ in reversed(own) if len(d))).tobytes())
                digests.append(b"".join(sha.to_bytes(d).tobytes() for d, _ in own))
                states.append(b"".join(sha.to_bytes(s).tobytes() for _, s in own))
            yield pa.RecordBatch.from_arrays(
                [
                    heads.column(0).combine_chunks(),
                    heads.column(1).combine_chunks(),
                    heads.column(3).combine_chunks(),
                    *(pa.array(x, pa.binary()) for x in (roots, digests, states)),
                ],
                ["key", "page", "n", "digest", "digests", "states"],
            )

    cut = nodes.select("key", F.floor(F.col("idx") / PAGE).alias("page"), "idx", "n", "digest")
    return _by_page(cut, "idx").mapInArrow(build, _PAGES)


def _forest(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """All rounds of pages over the trees of ``nodes`` (key, idx, n, digest), and each tree's root (key, digest)."""
    rounds: list[DataFrame] = []
    while True:
        pages = stored(_pages(nodes), "merkle-pages")
        rounds.append(pages)
        if pages.filter(F.col("n") > PAGE).limit(1).count() == 0:
            break
        above = F.ceil(F.col("n") / PAGE)
        nodes = pages.filter(F.col("n") > PAGE).select("key", F.col("page").alias("idx"), above.alias("n"), "digest")
    roots = [p.filter(F.col("n") <= PAGE).select("key", "digest") for p in rounds]
    found = roots[0]
    for more in roots[1:]:
        found = found.unionByName(more)
    return rounds, found


def _placed(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """``rows`` plus ``idx``, the place of each within its key in the order
    given, and ``n``, the key's number of rows. Rows are dealt by ranges, so a
    key of any size is spread; each range needs only the counts before it."""
    position = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    dealt = rows.repartitionByRange(F.col(key), *order).sortWithinPartitions(F.col(key), *order)
    parts = stored(dealt.withColumn("_part", F.spark_partition_id()).withColumn("_at", position), "merkle-order")
    counts = parts.groupBy(key, "_part").agg(F.count(F.lit(1)).alias("_own"), F.min("_at").alias("_first"))
    from pyspark.sql import Window

    mine = Window.partitionBy(key)
    before = mine.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        key, "_part", "_first", F.coalesce(F.sum("_own").over(before), F.lit(0)).alias("_before"), F.sum("_own").over(mine).alias("n")
    )
    return parts.join(offsets, [key, "_part"]).withColumn("idx", F.col("_before") + F.col("_at") - F.col("_first")).drop(
        "_part", "_at", "_first", "_before"
    )


def build_manifest(leaves: DataFrame, carried: tuple[str, ...] = ()) -> Manifest:
    """The tree over ``leaves``: key (see :func:`source_key`), doc_id, leaf
    (binary digest) and ``carried`` columns. Leaves of a key go by doc_id, null
    first, then by digest. All tables lie in the shared folder."""
    own = stored(leaves.select("key", "doc_id", "leaf", *carried), "merkle-leaves")
    placed = _placed(own, "key", [F.col("doc_id").asc_nulls_first(), F.col("leaf").asc()])
    rounds, roots = _forest(placed.select("key", "idx", "n", F.col("leaf").alias("digest")))
    top = roots.select(F.lit(TOP).alias("tree"), "key", "digest")
    sources = stored(_placed(top, "tree", [F.col("key").asc()]), "merkle-sources")
    top_rounds, _ = _forest(sources.select(F.col("tree").alias("key"), "idx", "n", "digest"))
    return Manifest(placed, rounds, top_rounds, sources.select("key", "idx", "digest"))


class _Page:
    """A page's nodes, read back from its row."""

    def __init__(self, n: int, digests: bytes, states: bytes, size: int):
        self.levels = int(_levels(np.array([n]))[0])
        sizes = [size]
        for _ in range(self.levels):
            sizes.append(-(-sizes[-1] // FANOUT))
        ends = np.cumsum(sizes)
        nodes, before = sha.from_bytes(digests), sha.from_bytes(states)
        self.digests = [nodes[e - s : e] for s, e in zip(sizes, ends, strict=True)]
        self.states = [before[e - s : e] for s, e in zip(sizes, ends, strict=True)]

    def steps(self) -> np.ndarray:
        """The way from each node of the lowest level to the page's root: (nodes, levels, words)."""
        size = len(self.digests[0])
        found = np.zeros((size, self.levels, _STEP), np.uint32)
        at = np.arange(size)
        for level in range(self.levels):
            digests, states = self.digests[level], self.states[level]
            slot, first = at % FANOUT, at - at % FANOUT
            found[:, level, 0] = slot
            found[:, level, 1] = np.minimum(FANOUT, len(digests) - first)
            found[:, level, 2:10] = states[at]
            padded = np.zeros((-(-len(digests) // FANOUT) * FANOUT, 8), np.uint32)
            padded[: len(digests)] = digests
            found[:, level, 10:] = padded.reshape(-1, FANOUT * 8)[at // FANOUT]
            at = at // FANOUT
        return found


def _page_sizes(pages: DataFrame) -> DataFrame:
    """``pages`` with the number of nodes on their lowest level."""
    last = F.col("n") - F.col("page") * PAGE
    return pages.withColumn("size", F.least(F.lit(PAGE).cast("long"), last).cast("int"))


def _ways_down(rounds: list[DataFrame], to_roots: DataFrame) -> Iterator[tuple[DataFrame, DataFrame]]:
    """From the last round to the first: (pages with the way from their root
    to the top, the ways of their nodes). ``to_roots`` (key, root, way) has the
    way of each tree's root."""

    @frees_memory
    def hand_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                page = _Page(row["n"], row["digests"], row["states"], row["size"])
                steps = page.steps()
                digests = sha.to_bytes(page.digests[0])
                for start in range(0, len(steps), 256):  # an upper way is a few KB
                    part = steps[start : start + 256]
                    ways = [s.tobytes() + row["way"] for s in part]
                    first = row["page"] * PAGE + start
                    # a node of the tree over the sources is a source's root
                    roots = [row["root"] or digests[start + k].tobytes() for k in range(len(part))]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row["key"]] * len(part), pa.string()),
                            pa.array(range(first, first + len(part)), pa.int64()),
                            pa.array(roots, pa.binary()),
                            pa.array(ways, pa.binary()),
                        ],
                        ["key", "idx", "root", "way"],
                    )

    below: DataFrame | None = None
    for pages in reversed(rounds):
        ended = pages.filter(F.col("n") <= PAGE).join(to_roots, "key")
        if below is not None:
            ways = below.select("key", F.col("idx").alias("page"), "root", "way")
            ended = ended.unionByName(pages.filter(F.col("n") > PAGE).join(ways, ["key", "page"]))
        known = _page_sizes(ended)
        below = known.mapInArrow(hand_down, _WAYS)
        yield known, below


def page_ways(manifest: Manifest) -> DataFrame:
    """The leaf pages with the way from their root to the manifest's root."""
    spark = manifest.leaves.sparkSession
    summit = spark.createDataFrame([(TOP, b"", b"")], "key string, root binary, way binary")
    for _, ways in _ways_down(manifest.top_rounds, summit):
        of_sources = ways
    named = manifest.sources.select("key", F.col("idx").alias("_idx"))
    to_roots = of_sources.join(named, F.col("idx") == F.col("_idx")).select(named["key"], "root", "way")
    for known, _ in _ways_down(manifest.rounds, stored(to_roots, "merkle-ways")):
        pages = known
    return pages


class _Pages:
    """The pages of a buffer together: nodes level by level, ways to the top padded to the longest."""

    def __init__(self, heads: list[dict]):
        self.pages = [_Page(h["n"], h["digests"], h["states"], h["size"]) for h in heads]
        self.levels = np.array([p.levels for p in self.pages])
        self.sizes, self.first, self.digests, self.states = [], [], [], []
        for level in range(PAGE_LEVELS):
            own = [(p.digests[level], p.states[level]) for p in self.pages if p.levels > level]
            size = np.array([len(p.digests[level]) if p.levels > level else 0 for p in self.pages])
            self.sizes.append(size)
            self.first.append(np.cumsum(size) - size)
            self.digests.append(np.concatenate([d for d, _ in own]) if own else np.empty((0, 8), np.uint32))
            self.states.append(np.concatenate([s for _, s in own]) if own else np.empty((0, 8), np.uint32))
        self.ways = [np.frombuffer(h["way"], np.uint32).reshape(-1, _STEP) for h in heads]
        self.heights = np.array([len(w) for w in self.ways])
        self.steps = np.zeros((len(heads), int(self.heights.max()), _STEP), np.uint32)
        for steps, way in zip(self.steps, self.ways, strict=True):
            steps[: len(way)] = way

    def fold(self, of: np.ndarray, places: np.ndarray, digests: np.ndarray) -> np.ndarray:
        """Root digests for leaves at ``places`` of pages ``of``, each replaced by itself."""
        at, now = places.copy(), digests.copy()
        for level in range(PAGE_LEVELS):
            live = np.flatnonzero(self.levels[of] > level)
            if not len(live):
                break
            slot = at[live] % FANOUT
            run = at[live] - slot
            count = np.minimum(FANOUT, self.sizes[level][of[live]] - run)
            run += self.first[level][of[live]]
            nodes = self.digests[level]
            now[live] = _resume(now[live], slot, count, self.states[level][run + slot], lambda k, s, r=run, d=nodes: d[r[k] + s])
            at[live] //= FANOUT
        # Above a page the way is the same for all of its leaves; equal digests have equal roots.
        merged, back = np.unique(np.c_[of.astype(np.uint32), now], axis=0, return_inverse=True)
        of, now = merged[:, 0].astype(np.int64), np.ascontiguousarray(merged[:, 1:])
        for height in range(self.steps.shape[1]):
            live = np.flatnonzero(self.heights[of] > height)
            step = self.steps[of[live], height]
            slot, count = step[:, 0].astype(np.int64), step[:, 1].astype(np.int64)
            run = step[:, 10:].reshape(-1, FANOUT, 8)
            now[live] = _resume(now[live], slot, count, step[:, 2:10], lambda k, s, r=run: r[k, s])
        return now[back.reshape(-1)]

    def proofs(self) -> Iterator[bytes]:
        """SHA-256 over the siblings' hex digests of each leaf, level by level, left to right."""
        for page, way in zip(self.pages, self.ways, strict=True):
            text = b""
            for step in way:
                run = sha.hex_text(step[10:].reshape(FANOUT, 8)[: step[1]]).tobytes()
                text += run[: 64 * step[0]] + run[64 * (step[0] + 1) :]
            above = [text]  # of the nodes one level up
            for level in reversed(range(page.levels)):
                above = [own + above[i // FANOUT] for i, own in enumerate(_others(page.digests[level]))]
            yield from (hashlib.sha256(proof).digest() for proof in above)


def _resume(digest: np.ndarray, slot: np.ndarray, count: np.ndarray, state: np.ndarray, run: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Parents' digests: the state before the slot takes in the new digest,
    then the siblings to the right, ``run(lanes, slots)``."""
    now = sha.absorb(np.ascontiguousarray(state.T), sha.hex_block(digest))
    for step in range(1, FANOUT):
        live = np.flatnonzero(slot + step < count)
        if not len(live):
            break
        now[:, live] = sha.absorb(now[:, live], sha.hex_block(run(live, slot[live] + step)))
    return sha.finish(now, count).T


def _others(digests: np.ndarray) -> Iterator[bytes]:
    """For each node the hex digests of the others of its run."""
    for start in range(0, len(digests), FANOUT):
        run = sha.hex_text(digests[start : start + FANOUT]).tobytes()
        for slot in range(len(run) // 64):
            yield run[: 64 * slot] + run[64 * (slot + 1) :]


_FOLDED = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string"


def fold(manifest: Manifest, replaced: str) -> DataFrame:
    """For every leaf the root that follows when its digest is the one in
    column ``replaced`` and nothing else changes: resumed states and right
    siblings only, from the stored manifest."""
    spark = manifest.leaves.sparkSession
    summit = manifest.top_rounds[-1].select("digest").first()  # one row of 32 bytes, none without leaves
    if summit is None:
        return spark.createDataFrame([], _FOLDED)
    root = bytes(summit["digest"]).hex()
    pages = page_ways(manifest)
    blobs = ["digests", "states", "root", "way", "n", "size"]
    types = dict(pages.dtypes)
    heads = pages.select(
        "key", "page", F.lit(-1).cast("long").alias("idx"), F.lit(None).cast("long").alias("doc_id"),
        *[F.lit(None).cast("binary").alias(c) for c in ("leaf", "new")], *blobs,
    )
    rows = manifest.leaves.select(
        "key", F.floor(F.col("idx") / PAGE).alias("page"), "idx", F.col("doc_id").cast("long").alias("doc_id"),
        "leaf", F.col(replaced).alias("new"), *[F.lit(None).cast(types[c]).alias(c) for c in blobs],
    )

    @frees_memory
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_pages(batches, 0, 1):
            edges = _edges(table, 0, 1)
            heads = table.take(pa.array(edges)).select([0, 1, *range(6, 6 + len(blobs))]).to_pylist()
            pages = _Pages(heads)
            counts = np.diff(np.r_[edges, table.num_rows]) - 1
            of = np.repeat(np.arange(len(edges)), counts)
            leaf_rows = np.delete(np.arange(table.num_rows), edges)
            own = table.take(pa.array(leaf_rows))
            places = leaf_rows - np.repeat(edges, counts) - 1
            folded = pages.fold(of, places, _joined(own.column("new")))
            subroots = [h["root"].hex() for h in heads]
            yield pa.RecordBatch.from_arrays(
                [
                    own.column("doc_id").combine_chunks(),
                    _hex(_joined(own.column("leaf"))),
                    pa.array(subroots, pa.string()).take(pa.array(of)),
                    pa.array([root] * len(of), pa.string()),
                    pa.array([p.hex() for p in pages.proofs()], pa.string()),
                    _hex(folded),
                ],
                ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"],
            )

    return _by_page(heads.unionByName(rows), "idx").mapInArrow(work, _FOLDED)


def _hex(digests: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes().decode() for row in sha.hex_text(digests)], pa.string())


def manifest_digest(docs: DataFrame) -> DataFrame:
    """Manifest of ``docs`` (doc_id, source, lang, n_chars, text; other columns
    are left alone) and one check per row: doc_id, leaf, subroot, root,
    proof_sha256, folded_root, verified.

    Rows whose id's checksum is divisible by 5 are checked against a text with
    its A-Z lower-cased. A null in any column is part of the leaf; a null id
    sorts first and is never tampered with, a null source is a source of its
    own and sorts first. Repeated rows are leaves of their own, next to each
    other; rows that share an id only go by their leaf. Texts of any length
    are hashed whole by Spark. An empty table gives an empty result.
    """
    fields = [field_bytes(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")]
    asked = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    leaf = F.sha2(F.concat(*fields, field_bytes(F.col("text"))), 256)
    other = F.sha2(F.concat(*fields, field_bytes(F.translate("text", UPPER, LOWER))), 256)
    leaves = docs.select(
        source_key(F.col("source")).alias("key"), "doc_id", F.unhex(leaf).alias("leaf"), F.unhex(F.when(asked, other)).alias("new")
    )
    manifest = build_manifest(leaves.withColumn("new", F.coalesce("new", "leaf")), ("new",))
    return fold(manifest, "new").withColumn("verified", F.col("folded_root") == F.col("root"))
