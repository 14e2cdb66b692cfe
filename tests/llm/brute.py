"""Plain one-process versions of the operators, for comparison."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text, low=False):
    raw = (text or "").encode()
    return WORD.findall(raw.lower() if low else raw)


def fingerprint(text):
    w = words(text, low=True)
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(rows, radius=2):
    """(id, fp, smallest id reachable) of (id, text) rows."""
    prints = [(i, fingerprint(t)) for i, t in rows]
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= radius:
                parent[find(a)] = find(b)
    least = defaultdict(list)
    for a, (i, _) in enumerate(prints):
        if i is not None:
            least[find(a)].append(i)
    return [(i, fp, min(least[find(a)], default=None)) for a, (i, fp) in enumerate(prints)]


def repeats(rows, width=35):
    """(id, words, kept words) of (id, text) rows."""
    all_words = [(i, words(t)) for i, t in rows]
    seen = Counter(tuple(w[s : s + width]) for _, w in all_words for s in range(len(w) - width + 1))
    out = []
    for i, w in all_words:
        gone = set()
        for s in range(len(w) - width + 1):
            if seen[tuple(w[s : s + width])] > 1:
                gone.update(range(s, s + width))
        out.append((i, len(w), [x for k, x in enumerate(w) if k not in gone]))
    return out


def kept_hash(kept):
    return hashlib.sha256(b" ".join(kept)).hexdigest()


def leaks(rows, items, width=10):
    """(id, n_words, n_hit, sorted item ids) of (id, text) rows against (item_id, text) rows."""
    windows = defaultdict(set)
    for item, text in items:
        w = ITEM_WORD.findall((text or "").encode().lower())
        n = min(width, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[s : s + n])].add(item)
    sizes = {len(w) for w in windows}
    out = []
    for i, text in rows:
        w = ITEM_WORD.findall((text or "").encode().lower())
        hit, found = set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if (got := windows.get(tuple(w[s : s + n]))) is not None:
                    hit.update(range(s, s + n))
                    found |= got
        out.append((i, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return out


def grams(text, size=5):
    """Set of word shingles; a shorter text is one."""
    w = words(text, low=True)
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) or (frozenset([tuple(w)]) if w else frozenset())


def similar_pairs(sets, least=0.8):
    """Pairs of places whose sets reach the similarity; counts come from an index of shingles."""
    index, common = defaultdict(list), defaultdict(int)
    for i, s in enumerate(sets):
        for g in s:
            for j in index[g]:
                common[j, i] += 1
            index[g].append(i)
    return [(a, b) for (a, b), n in common.items() if n >= least * (len(sets[a]) + len(sets[b]) - n) - 1e-9]


def similar_classes(rows):
    """Smallest id that links of similar texts reach, for each of (id, text) rows."""
    sets = [grams(t) for _, t in rows]
    distinct = sorted(set(sets), key=sorted)
    parent = {s: s for s in distinct}

    def find(s):
        while parent[s] != s:
            s = parent[s]
        return s

    for a, b in similar_pairs(distinct):
        parent[find(distinct[a])] = find(distinct[b])
    least = {}
    for (i, _), s in zip(rows, sets, strict=True):
        if i is not None:
            least[find(s)] = min(i, least.get(find(s), i))
    return [least.get(find(s)) for s in sets]
