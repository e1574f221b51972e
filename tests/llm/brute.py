"""Plain versions of the corpus operators' contracts, written apart from them."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def exact(rows):
    """(doc_id, keep_id, group_size, kept, sha) of (doc_id, text) rows; ids may be null."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = max(ids) if ids else None
        out.append((i, keep, len(groups[t or ""]), i == keep, sha(t or "")))
    return out


def fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = WORD.findall(low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows, distance=2):
    """doc_id -> smallest doc_id reachable, by comparing all pairs."""
    fps = [(i, fingerprint(t or "")) for i, t in rows]
    return components_of(fps, distance)


def components_of(fps, distance=2):
    parent = list(range(len(fps)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a][1] ^ fps[b][1]).bit_count() <= distance:
                parent[root(a)] = root(b)
    least = defaultdict(list)
    for a, (i, _) in enumerate(fps):
        if i is not None:
            least[root(a)].append(i)
    return [(i, fp, min(least[root(a)], default=None)) for a, (i, fp) in enumerate(fps)]


SECRETS = [
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII), lambda m: len(m[2]) >= 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 16),
]


def secrets(text):
    found = [(m.start(), k, m.end()) for k, (_, p, ok) in enumerate(SECRETS) for m in p.finditer(text) if ok(m)]
    spans = [f"{SECRETS[k][0]}:{s}:{e}" for s, k, e in sorted(found)]
    return [sum(x[1] == k for x in found) for k in range(3)], ",".join(spans), sha(",".join(spans))


def luhn(d):
    return sum((int(c) * 2 - 9 if int(c) > 4 else int(c) * 2) if i % 2 else int(c) for i, c in enumerate(d[::-1])) % 10 == 0


def digits(s):
    return "".join(c for c in s if c in "0123456789")


PII = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda m: True),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda m: all(int(p) <= 255 for p in m[0].split("."))),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda m: 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 8 <= len(digits(m[0])) <= 15),
]


def personal(text):
    spans, counts = [], []
    for name, pattern, ok in PII:
        own = [f"{name}:{m.start()}:{m.end()}" for m in pattern.finditer(text) if ok(m)]
        counts.append(len(own))
        spans += own
    return counts, spans, sha(",".join(spans))


def base_quality(text):
    words = WORD.findall(text)
    seen, dups = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dups += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(covered), n < 50 or 100 * len(covered) > 50 * n
