"""Secret scan: known key formats plus sliding-window entropy, in native expressions.

A text becomes arrays of spans without leaving the JVM. Positions come from
splitting the text at the matches and summing lengths, so any number of
matches is found in one pass. Candidate strings without a known format are
scanned by a window of ``WINDOW`` characters whose Shannon entropy is kept
up to date by incremental counts: moving it by one lowers the count of one
character and raises that of another, and the entropy's sum moves with them.
The threshold is that of the candidate's class of characters, hexadecimal or
mixed; windows over it merge into spans unless the candidate is on the
allow-list. The cost is linear in the text.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Known formats, matched leftmost and non-overlapping. A value that is too
# short drops its match after matching; the runs of the other two kinds end
# where their characters end, so their least length can be part of the pattern.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_MIN = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
BASE_KINDS = ("assign", "access", "hex")

# Entropy scan.
CANDIDATE = r"[A-Za-z0-9+/=_-]{20,}"
WINDOW = 20
HEX_BITS = 3.0
MIXED_BITS = 3.6
# Strings that are long but not secret: words and numbers with separators
# (paths, slugs, dates), UUIDs, filler and sample keys.
ALLOWED = (
    # Possessive: a repeated group is otherwise matched by recursion, as deep as the string is long.
    r"^[-_/=+]*+(?:[A-Za-z]++|[0-9]{1,8}+)(?:[-_/=+]++(?:[A-Za-z]++|[0-9]{1,8}+))*+[-_/=+]*+$",
    r"^[0-9]+$",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"(?i)example|placeholder|changeme|xxxxx|0123456789|abcdefgh",
)
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-"
SCALE = 1_000_000
# Arrays are grown in blocks, so the cost of growing one stays linear.
BLOCK = 256
# The character that stands for a count of 0; a window of up to 78 keeps all counts in ASCII.
NO_COUNT = 48


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, with ``value`` evaluated once: an expression
    used inside a lambda would be computed again for every element."""
    return F.get(F.transform(F.array(value), body), 0)


def _grow(values: Column, first: Column) -> Column:
    """``first`` plus the sum of all elements before each element."""
    return F.aggregate(
        values,
        F.struct(first.alias("at"), F.array().cast("array<bigint>").alias("seen")),
        lambda s, v: F.struct((s["at"] + v).alias("at"), F.array_append(s["seen"], s["at"]).alias("seen")),
        lambda s: s["seen"],
    )


def _prefix_sums(lengths: Column) -> Column:
    """The sum of all elements before each element of a bigint array."""
    zero = F.lit(0).cast("bigint")
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int")),
        lambda b: F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK)),
    )

    def placed(blocks: Column) -> Column:
        sums = F.transform(blocks, lambda b: F.aggregate(b, zero, lambda s, v: s + v))
        return F.flatten(F.zip_with(blocks, _grow(sums, zero), _grow))

    return F.when(F.size(lengths) > 0, let(blocks, placed)).otherwise(F.array().cast("array<bigint>"))


def matches(text: Column, pattern: str, checked: int = 0) -> Column:
    """array<struct<start, end, hit, part>> of all leftmost matches, in code
    points; ``part`` is group ``checked``."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(checked)) if checked else hits
    # The piece before each match and the match: their lengths add up to the positions.
    pieces = F.zip_with(hits, F.split(text, pattern, -1), lambda h, g: F.struct(h.alias("hit"), F.length(g).cast("bigint").alias("gap")))
    pieces = F.zip_with(
        F.filter(pieces, lambda p: p["hit"].isNotNull()),
        part,
        lambda p, q: F.struct(p["hit"].alias("hit"), p["gap"].alias("gap"), q.alias("part")),
    )

    def placed(pieces: Column) -> Column:
        at = _prefix_sums(F.transform(pieces, lambda p: p["gap"] + F.length(p["hit"])))
        return F.zip_with(
            pieces,
            at,
            lambda p, a: F.struct(
                (a + p["gap"]).alias("start"),
                (a + p["gap"] + F.length(p["hit"])).alias("end"),
                p["hit"].alias("hit"),
                p["part"].alias("part"),
            ),
        )

    none = F.array().cast("array<struct<start:bigint,end:bigint,hit:string,part:string>>")
    return F.when(text.rlike(pattern), let(pieces, placed)).otherwise(none)


def _entropy_spans(hit: Column, start: Column, window: int, bits: Column) -> Column:
    """Merged windows of ``hit`` with at least ``bits`` of entropy.

    With counts c in a window of w characters, entropy = log2(w) - sum(c *
    log2(c)) / w. A fold over the characters carries the counts and that sum:
    the character that leaves lowers one count, the one that enters raises
    one, and the sum moves by the two differences. These are scaled integers,
    so it is exact. Counts are a string with one character per symbol, which
    a step overwrites in place of copying an array of numbers. Blocks of
    windows are folded apart, so the arrays of found windows stay short.
    """
    cost = [round(SCALE * c * math.log2(c)) if c else 0 for c in range(window + 1)]
    # What the sum gains when a count rises to c, and loses when it falls from c.
    steps = F.array(*[F.lit(cost[c] - cost[c - 1] if c else 0).cast("bigint") for c in range(window + 1)])
    most = ((F.lit(math.log2(window)) - bits) * F.lit(window * SCALE)).cast("bigint")
    none = F.array().cast("array<bigint>")
    one = F.lit(1)

    def count_of(counts: Column, symbol: Column) -> Column:
        return F.ascii(F.substr(counts, symbol, one)) - NO_COUNT

    def with_count(counts: Column, symbol: Column, count: Column) -> Column:
        return F.overlay(counts, F.char(count + NO_COUNT), symbol, one)

    def block_windows(codes: Column, limit: Column, block: Column) -> Column:
        moves = F.transform(
            F.slice(codes, block * BLOCK + 1, F.lit(BLOCK + window - 1)),
            lambda x, i: F.struct(x.alias("enters"), F.get(codes, block * BLOCK + i - window).alias("leaves")),
        )

        def found(s: Column) -> Column:
            begin = block * BLOCK + s["read"] - window
            return F.when((s["read"] >= window) & (s["sum"] <= limit), F.array_append(s["found"], begin.cast("bigint"))).otherwise(s["found"])

        def lowered(s: Column, x: Column) -> Column:
            less = let(
                count_of(s["counts"], x),
                lambda c: F.struct(with_count(s["counts"], x, c - 1).alias("counts"), (s["sum"] - F.get(steps, c)).alias("sum")),
            )
            return F.when(s["read"] >= window, less).otherwise(F.struct(s["counts"].alias("counts"), s["sum"].alias("sum")))

        def moved(s: Column, move: Column) -> Column:
            x = move["enters"]
            return let(
                lowered(s, move["leaves"]),
                lambda t: let(
                    count_of(t["counts"], x) + 1,
                    lambda c: F.struct(
                        (s["read"] + 1).alias("read"),
                        with_count(t["counts"], x, c).alias("counts"),
                        (t["sum"] + F.get(steps, c)).alias("sum"),
                        found(s).alias("found"),
                    ),
                ),
            )

        empty = F.struct(
            F.lit(0).alias("read"),
            F.lit(chr(NO_COUNT) * len(SYMBOLS)).alias("counts"),
            F.lit(0).cast("bigint").alias("sum"),
            none.alias("found"),
        )
        return F.aggregate(moves, empty, moved, found)

    def begins(codes: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor(F.greatest(F.size(codes) - window, F.lit(0)) / BLOCK).cast("int"))
        # bound once: the class of a candidate is found by matching all of it
        return let(most, lambda limit: F.flatten(F.transform(blocks, lambda block: block_windows(codes, limit, block))))

    def merged(b: Column) -> Column:
        gap_before = lambda x, k: (k == 0) | (x - F.get(b, k - 1) > window)
        gap_after = lambda x, k: (k == F.size(b) - 1) | (F.get(b, k + 1) - x > window)
        return F.zip_with(
            F.filter(b, gap_before),
            F.filter(b, gap_after),
            lambda x, y: F.struct((start + x).alias("start"), (start + y + window).alias("end")),
        )

    codes = F.transform(F.split(hit, ""), lambda ch: F.instr(F.lit(SYMBOLS), ch))
    return let(let(codes, begins), merged)


def _tagged(spans: Column, kind: str, order: int) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].cast("bigint").alias("start"), s["end"].cast("bigint").alias("end"), F.lit(kind).alias("kind"), F.lit(order).alias("ord")
        ),
    )


def _joined(spans: Column) -> Column:
    by_start = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["ord"], s["end"], s["kind"])))
    return F.array_join(
        F.transform(by_start, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def secret_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    hex_bits: float = HEX_BITS,
    mixed_bits: float = MIXED_BITS,
    allowed: tuple[str, ...] = ALLOWED,
) -> DataFrame:
    """One row per input row: ``id_col, assign, access, hex, entropy``, each an
    array of (start, end, kind, ord); offsets in code points, end exclusive.

    No shuffle and no state across rows: repeated rows repeat their result,
    a null or empty text has no spans, an empty table no rows, and other
    columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    raw = docs.select(F.col(id_col).alias("id"), text.alias("t"))
    found = raw.select(
        "id",
        F.filter(matches(F.col("t"), ASSIGN, 2), lambda s: F.length(s["part"]) >= ASSIGN_MIN).alias("assign"),
        matches(F.col("t"), ACCESS).alias("access"),
        matches(F.col("t"), HEX).alias("hex"),
        matches(F.col("t"), CANDIDATE).alias("cand"),
    )
    def suppressed(hit: Column) -> Column:
        out = F.lit(False)
        for pattern in allowed:
            out = out | hit.rlike(pattern)
        return out

    def threshold(hit: Column) -> Column:
        return F.when(hit.rlike("^[0-9a-fA-F]+$"), F.lit(float(hex_bits))).otherwise(F.lit(float(mixed_bits)))

    kept = F.filter(F.col("cand"), lambda c: ~suppressed(c["hit"]))
    entropy = F.flatten(F.transform(kept, lambda c: _entropy_spans(c["hit"], c["start"], window, threshold(c["hit"]))))
    base = [_tagged(F.col(kind), kind, k).alias(kind) for k, kind in enumerate(BASE_KINDS)]
    entropy = F.when(F.size("cand") > 0, entropy).otherwise(F.array().cast("array<struct<start:bigint,end:bigint>>"))
    return found.select(F.col("id").alias(id_col), *base, _tagged(entropy, "entropy", len(BASE_KINDS)).alias("entropy"))


def secret_digest(spans: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, the digest of the known formats and all spans as text."""
    base = F.concat("assign", "access", "hex")
    return spans.select(
        id_col,
        F.size("assign").cast("long").alias("n_assign"),
        F.size("access").cast("long").alias("n_access"),
        F.size("hex").cast("long").alias("n_hex"),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.concat(base, "entropy")).alias("spans"),
        F.size("entropy").cast("long").alias("n_entropy"),
    )
