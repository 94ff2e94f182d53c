"""Plain Python versions of the operators' contracts, for small tables."""

from __future__ import annotations

import binascii
import collections
import hashlib
import math
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def secrets(text, candidate, allowed, window, hex_bits, mixed_bits):
    text = text or ""
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found = [("assign", m.start(), m.end()) for m in assign.finditer(text) if len(m.group(2)) >= 12]
    found += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    found += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 16]
    base, extra = list(found), []
    for m in re.finditer(candidate, text):
        hit = m.group()
        if any(re.search(p, hit) for p in allowed):
            continue
        bits = hex_bits if re.fullmatch("[0-9a-fA-F]+", hit) else mixed_bits
        spans = []
        for i in range(len(hit) - window + 1):
            counts = collections.Counter(hit[i : i + window]).values()
            if math.log2(window) - sum(c * math.log2(c) for c in counts) / window >= bits - 1e-9:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + window
                else:
                    spans.append([i, i + window])
        extra += [("entropy", m.start() + a, m.start() + b) for a, b in spans]
    order = ("assign", "access", "hex", "entropy")
    by_start = lambda s: (s[1], order.index(s[0]))
    count = collections.Counter(k for k, _, _ in base)
    return (
        count["assign"], count["access"], count["hex"], sha(joined(sorted(base, key=by_start))), joined(sorted(base + extra, key=by_start)),
    )


def shingles(text, n=5):
    words = WORD.findall(lower(text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def jaccard(rows):
    """{id: (set size, component, links)} of rows (id, text) with distinct ids."""
    sets = {i: shingles(t) for i, t in rows}
    parent, links = {i: i for i in sets}, collections.Counter()

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
                links[x] += 1
                links[y] += 1
                a, b = root(x), root(y)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i), links[i]) for i in ids}


def unigram(rows):
    """Counter of (id, held_out, n_tokens, n_known, train_tokens, base score)."""
    docs = [(i, [*WORD.findall(lower(t or "")), "\n"]) for i, t in rows]
    held = lambda i: i is not None and binascii.crc32(str(i).encode()) % 5 == 1
    count = collections.Counter(w for i, words in docs if not held(i) for w in words)
    n, v = sum(count.values()), len(count)
    return collections.Counter(
        (
            i, held(i), len(words), sum(count[w] > 0 for w in words), n,
            round(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words), 5),
        )
        for i, words in docs
    )


def pii(text, luhn):
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    found = [
        [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)],
        [
            ("ip", m.start(), m.end())
            for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m.group().split("."))
        ],
        [
            ("card", m.start(), m.end())
            for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
            if 16 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))
        ],
        [
            ("phone", m.start(), m.end())
            for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 8 <= len(digits(m.group())) <= 15
        ],
    ]
    return (*map(len, found), sha(joined([s for some in found for s in some])))


def repeats(rows, window=13):
    """Counter of (id, words, removed, digest of the kept words)."""
    docs = [(i, WORD.findall(t or "")) for i, t in rows]
    rank = lambda i: -math.inf if i is None else i
    first = {}
    for i, words in docs:
        for k in range(len(words) - window + 1):
            run = tuple(words[k : k + window])
            first[run] = min(first.get(run, math.inf), rank(i))
    out = collections.Counter()
    for i, words in docs:
        gone = set()
        for k in range(len(words) - window + 1):
            if first[tuple(words[k : k + window])] < rank(i):
                gone.update(range(k, k + window))
        out[i, len(words), len(gone), sha(" ".join(w for k, w in enumerate(words) if k not in gone))] += 1
    return out


def manifest(rows):
    """Rows (doc_id, text, lang, source, n_chars) -> (doc_id, leaf, subroot, root, proof, folded root, verified)."""

    def field(value):
        raw = str(value).encode()
        return b"-" if value is None else str(len(raw)).encode() + b":" + raw

    def leaf(i, text, lang, source, n_chars):
        return hashlib.sha256(b"".join(map(field, (i, source, lang, n_chars, text)))).hexdigest()

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
        return levels

    def way(levels, i):
        for level in levels[:-1]:
            first = i // 16 * 16
            yield i - first, level[first : first + 16]
            i //= 16

    groups = collections.defaultdict(list)
    for row in rows:
        groups[row[3]].append(row)
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[s] = tree([leaf(*r) for r in groups[s]])
    top = tree([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, row in enumerate(groups[s]):
            steps = [*way(trees[s], i), *way(top, k)]
            proof = sha("".join("".join(run[:at] + run[at + 1 :]) for at, run in steps))
            asked = row[0] is not None and binascii.crc32(str(row[0]).encode()) % 5 == 0 and row[1] is not None
            digest = leaf(row[0], lower(row[1]) if asked else row[1], *row[2:])
            for at, run in steps:
                digest = sha("".join([*run[:at], digest, *run[at + 1 :]]))
            out.append((row[0], leaf(*row), trees[s][-1][0], top[-1][0], proof, digest, digest == top[-1][0]))
    return out


def whitening(rows):
    """Rows (vec_id, vector) -> (ids, n, deviations, eigenvalues, projections over the root of the eigenvalue)."""
    import numpy as np

    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    sizes = collections.Counter(len(v) for _, v in good)
    usual = max(sizes, key=lambda d: (sizes[d], d))
    good = [(i, v) for i, v in good if len(v) == usual]
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in good]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(row, sums, strict=True)] for row in x])
    # singular values of the rows themselves: small variances keep their digits
    _, singular, right = np.linalg.svd(centred, full_matrices=False)
    values = singular**2 / n
    with np.errstate(divide="ignore", invalid="ignore"):
        return [i for i, _ in good], n, deviations, values, centred @ right.T / np.sqrt(values)
