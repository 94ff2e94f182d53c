"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, scheme
separators, a plus or dot before a digit, neighbouring digits, and cue words
for identifiers, these in any case. At each anchor a local parser finds the
exact boundaries and validates them; a parser never looks further than its own
span. Addresses are e-mail, IPv4 and logins in URLs; there is no IPv6 and no
postal address.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paxflow.llm.memory import frees_memory

KINDS = ("email", "ip", "card", "phone", "url_login", "iban", "ssn", "account")
SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
CUES = {"iban": "iban", "ssn": "ssn", "social security": "ssn", "account": "account", "acct": "account"}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = frozenset("0123456789")
_LOWERED = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_SCHEME = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_QUAD = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOGIN = re.compile(r"://[A-Za-z0-9._~%-]+:[^\s/@:]+@[A-Za-z0-9.-]+")
_IBAN = re.compile(r"[Nn]?[Oo]?[.:#= ]{0,4}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
_SSN = re.compile(r" ?(?:[Nn][Oo]|[Nn][Uu][Mm][Bb][Ee][Rr])?[.:#= ]{0,4}((?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4})(?![0-9-])")
_ACCOUNT = re.compile(r" ?(?:[Nn][Oo]|[Nn][Uu][Mm][Bb][Ee][Rr])?[.:#= ]{1,4}([0-9]{8,17})(?![0-9])")


def luhn(digits: str) -> bool:
    total = 0
    for k, ch in enumerate(reversed(digits)):
        d = int(ch) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def iban_valid(text: str) -> bool:
    code = text.replace(" ", "")
    return 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def anchors():
    """The automaton: each pattern's value is (anchor kind, pattern length)."""
    import ahocorasick

    found = ahocorasick.Automaton()
    found.add_word("@", ("email", 1))
    found.add_word("://", ("url_login", 3))
    for d in "0123456789":
        found.add_word("+" + d, ("phone", 2))
        found.add_word("." + d, ("ip", 2))
        for e in "0123456789":
            for between in ("", " ", "-"):
                found.add_word(d + between + e, ("card", 2 + len(between)))
    for cue, kind in CUES.items():
        found.add_word(cue, (kind, len(cue)))
    found.make_automaton()
    return found


def expand(text: str, automaton) -> list[tuple[str, int, int]]:
    """(kind, start, end) of everything found, by kind and start."""
    spans: list[tuple[str, int, int]] = []
    done = dict.fromkeys(KINDS, 0)
    # Cues are lower-case. Lowering keeps every offset; of all characters only U+0130 would become two.
    lowered = text.translate(_LOWERED) if "\u0130" in text else text.lower()
    for last, (kind, length) in automaton.iter(lowered):
        at, free = last + 1 - length, done[kind]
        if kind == "card":
            if at < free:
                continue
            m = _CHAIN.match(text, at)
            done[kind] = m.end()
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append((kind, at, m.end()))
        elif kind == "email":
            m = _DOMAIN.match(text, at + 1)
            start = at
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
            if m and start < at:
                done[kind] = m.end()
                spans.append((kind, start, m.end()))
        elif kind == "ip":
            start = at
            while start > free and text[start - 1] in _DIGITS:
                start -= 1
            m = _QUAD.match(text, start) if start < at else None
            if m:
                done[kind] = m.end()
                if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.groups()):
                    spans.append((kind, start, m.end()))
        elif kind == "phone":
            m = _PHONE.match(text, at) if at >= free else None
            if m:
                done[kind] = m.end()
                if 8 <= sum(c in _DIGITS for c in m.group()) <= 15:
                    spans.append((kind, at, m.end()))
        elif kind == "url_login":
            m = _LOGIN.match(text, at)
            start = at
            while start > free and text[start - 1] in _SCHEME:
                start -= 1
            if m and start < at:
                done[kind] = m.end()
                spans.append((kind, start, m.end()))
        else:
            m = {"iban": _IBAN, "ssn": _SSN, "account": _ACCOUNT}[kind].match(text, last + 1)
            if m and m.start(1) >= free and (kind != "iban" or iban_valid(m.group(1))):
                done[kind] = m.end(1)
                spans.append((kind, m.start(1), m.end(1)))
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col, spans`` (kind, start, end), by kind
    and start; offsets in code points, end exclusive.

    A map over rows without a shuffle: repeated rows repeat their result, a
    null or empty text has no spans, an empty table no rows; other columns
    are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    @frees_memory
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = anchors()
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            spans = [
                [{"kind": k, "start": a, "end": b} for k, a, b in expand(text.as_py(), automaton)] for text in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(kind))], ["id", "spans"])

    return rows.mapInArrow(find, f"id {id_type}, spans {SPANS}").withColumnRenamed("id", id_col)


def pii_digest(spans: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, the digest of the four base kinds and all spans as text."""

    def joined(found: Column) -> Column:
        parts = F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(parts, ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS[:4]))
    return spans.select(
        id_col,
        *[count(kind) for kind in KINDS[:4]],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.size("spans").cast("long").alias("n_spans"),
    )
