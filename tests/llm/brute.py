"""The contracts once more, in plain Python over whole tables."""

import re
import zlib
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile("[^\x20\x09-\x0d]+")


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 0


def copies(rows):
    """(doc_id, keep_id, group_size) of (doc_id, text) rows."""
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    last = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(((i, last[t or ""], len(groups[t or ""])) for i, t in rows), key=str)


def fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, budget=2):
    """Smallest position reachable from each fingerprint."""
    prints = np.array(prints, "u8")
    near = [np.flatnonzero(np.bitwise_count(prints ^ p) <= budget) for p in prints]
    label = np.arange(len(prints))
    while True:
        new = np.array([label[n].min() for n in near], "int64")
        if (new == label).all():
            return label.tolist()
        label = new


def quality(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def _luhn(value):
    digits = [int(c) for c in value if c.isdigit()][::-1]
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(digits)) % 10 == 0


def _digits(value):
    return sum(c in "0123456789" for c in value)


PERSONAL = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= _digits(m[0]) <= 19 and _luhn(m[0])),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= _digits(m[0]) <= 15),
]
SECRET = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
]


def matches(text, kinds):
    return [(kind, m.start(), m.end(), k) for k, (kind, pattern, good) in enumerate(kinds) for m in re.finditer(pattern, text or "") if good(m)]


def personal(text):
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b, _ in matches(text, PERSONAL))


def secrets(text):
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b, _ in sorted(matches(text, SECRET), key=lambda x: (x[1], x[3])))


def segments(scores):
    """All maximal scoring segments by their recursive definition: the best segment, then both sides of it."""
    def best(lo, hi):
        top = (0, 0, 0)
        for i in range(lo, hi):
            total = 0
            for j in range(i, hi):
                total += scores[j]
                if total > top[0] + 1e-12 or (abs(total - top[0]) <= 1e-12 and total > 0 and (j - i) < top[2] - top[1] - 1):
                    top = (total, i, j + 1)
        if top[0] <= 0:
            return []
        return best(lo, top[1]) + [(top[1], top[2])] + best(top[2], hi)

    return best(0, len(scores))


def shingles(text, size=5):
    words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))}


def near_components(texts, percent=80):
    """Smallest position that each text is linked with, by all pairs of their sets of five-word shingles."""
    sets, label = [shingles(t) for t in texts], list(range(len(texts)))
    for i in range(len(sets)):
        for j in range(i):
            if label[i] != label[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label
