"""Brute-force forms of the contracts, over plain Python rows."""

import hashlib
import re
from collections import defaultdict

import numpy as np


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def pii_base(text):
    text = text or ""
    spans = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    spans += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            spans.append(("card", m))
    spans += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return [(k, m.start(), m.end()) for k, m in spans]


def secrets_base(text):
    text, out = text or "", []
    for m in re.finditer(r"""((?:(?i:password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.A):
        if len(m[2]) >= 6:
            out.append(("assign", m.start(), m.end()))
    out += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    rank = {"assign": 0, "access": 1, "hex": 2}
    return sorted(out, key=lambda s: (s[1], rank[s[0]]))


def sha(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def shingle_set(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def components(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def jaccard_components(texts, width, num, den):
    """Index of the component's first member by text; sets found through shared shingles."""
    sets = [shingle_set(t, width) for t in texts]
    by = defaultdict(list)
    pairs, common = [], defaultdict(int)
    for i, s in enumerate(sets):
        for g in s:
            for j in by[g]:
                common[j, i] += 1
            by[g].append(i)
    for (i, j), c in common.items():
        if den * c >= num * (len(sets[i]) + len(sets[j]) - c):
            pairs.append((i, j))
    return [len(s) for s in sets], components(len(texts), pairs), pairs


def cosine_links(vectors, threshold=0.9):
    good = []
    for k, v in enumerate(vectors):
        if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good.append(k)
    pairs = []
    for dim in {len(vectors[k]) for k in good}:
        ks = [k for k in good if len(vectors[k]) == dim]
        x = np.array([vectors[k] for k in ks], np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        i, j = np.nonzero(np.triu(x @ x.T >= threshold, 1))
        pairs += [(ks[a], ks[b]) for a, b in zip(i, j)]
    return pairs
