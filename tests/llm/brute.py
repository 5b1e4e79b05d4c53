"""Plain Python versions of what the operators compute."""

import re
from collections import Counter, defaultdict

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def blanks(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingle_set(text):
    w = blanks((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def jaccard(rows):
    """rows (doc_id, text) to a list of (doc_id, n_shingles, component_id), row by row."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    lists = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            lists[x].append(i)
    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in lists[x] if j > i)
        for j, n in shared.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            r = find(i)
            least[r] = min(d, least.get(r, d))
    return [(d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


def repeats(texts, width=35):
    """(words, removed, kept words) of each text."""
    words = [blanks(t) for t in texts]
    seen = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        out.append((len(w), len(gone), [x for i, x in enumerate(w) if i not in gone]))
    return out


def leaks(texts, items):
    """(n_words, n_hit, sorted item ids) of each text; items (item_id, text)."""
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    windows = defaultdict(set)
    for i, t in items:
        w = cut(t)
        k = min(8, len(w))
        for s in range(len(w) - k + 1) if w else ():
            windows[tuple(w[s : s + k])].add(str(i))
    out = []
    for t in texts:
        w, hit, found = cut(t), set(), set()
        for k in {len(x) for x in windows}:
            for s in range(len(w) - k + 1):
                if ids := windows.get(tuple(w[s : s + k])):
                    hit.update(range(s, s + k))
                    found |= ids
        out.append((len(w), len(hit), sorted(found)))
    return out
