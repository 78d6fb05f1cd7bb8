"""Plain versions of the contracts, one text at a time, for comparison."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def rules(text):
    text = text or ""
    words = SPACE_WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered.update(range(i, i + 8))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if SPACE_WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), n < 20 or 100 * len(covered) > 30 * n


def contamination(texts, items):
    windows = defaultdict(set)
    for item, text in items:
        words = ASCII_WORD.findall(lower_ascii(text or ""))
        for i in range(max(1, len(words) - 12)) if words else []:
            windows[tuple(words[i : i + 13])].add(str(item))
    out = []
    for text in texts:
        words, hit, found = ASCII_WORD.findall(lower_ascii(text or "")), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                if ids := windows.get(tuple(words[i : i + size])):
                    hit.update(range(i, i + size))
                    found |= ids
        out.append((len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(words)))
    return out


def fingerprint(text):
    words = SPACE_WORD.findall(lower_ascii(text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def component_of(fps, distance=2):
    """fps: [(id, fingerprint)] -> id -> least id reachable."""
    root = {i: i for i, _ in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, x) in enumerate(fps):
        for j, y in fps[a + 1 :]:
            if (x ^ y).bit_count() <= distance:
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return {i: find(i) for i, _ in fps}


def similar_groups(rows, least=0.8, shingle=5):
    """rows: [(id, text)] -> id -> least id reachable over pairs whose shingle sets have a similarity of `least` or more."""
    sets = {}
    for i, text in rows:
        words = SPACE_WORD.findall(lower_ascii(text or ""))
        sets[i] = {tuple(words[k : k + shingle]) for k in range(max(1, len(words) - shingle + 1))}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    names = sorted(sets)
    for a, i in enumerate(names):
        for j in names[a + 1 :]:
            x, y = sets[i], sets[j]
            if min(len(x), len(y)) >= least * max(len(x), len(y)) and len(x & y) >= least * len(x | y):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return {i: find(i) for i in names}
