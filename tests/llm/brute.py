"""Plain Python versions of the operators, over lists of (doc_id, text, source)."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANKS = " \t\n\x0b\f\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(x) -> str:
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def suffix(docs, width=200):
    texts = {i: (t or "").encode() for i, t, _ in docs}
    seen = Counter(t[p : p + width] for t in texts.values() for p in range(len(t) - width + 1))
    out = []
    for i, t in texts.items():
        gone = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - width + 1):
            if seen[t[p : p + width]] > 1:
                gone[p : p + width] = True
        out.append((i, len(t), int(gone.sum()), int((gone[:-1] & ~np.append(False, gone[:-2])).sum()) if t else 0, sha(bytes(b for b, g in zip(t, gone, strict=False) if not g))))
    return sorted(out)


def windows(docs, width=13):
    words = {i: WORD.findall(t or "") for i, t, _ in docs}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - width + 1):
            first.setdefault(tuple(words[i][k : k + width]), i)
    out = []
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < i:
                gone.update(range(k, k + width))
        out.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return sorted(out)


def lines(docs, least=10):
    first = {}
    key = lambda line: line.strip(BLANKS).translate(LOWER)
    for i, t, _ in docs:
        for line in (t or "").split("\n"):
            first[key(line)] = min(i, first.get(key(line), i))
    out = []
    for i, t, _ in docs:
        every = (t or "").split("\n")
        kept = [x for x in every if len(key(x)) < least or first[key(x)] == i]
        out.append((i, len(every), len(every) - len(kept), sha("\n".join(kept))))
    return sorted(out)


def simhash(docs):
    prints = {}
    for i, t, _ in docs:
        w = WORD.findall((t or "").translate(LOWER))
        shingles = [" ".join(w[k : k + 3]) for k in range(max(len(w) - 2, 1))] if w else []
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    root = {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(prints)
    for a, i in enumerate(ids):
        for j in ids[a + 1 :]:
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return sorted((i, f"{prints[i]:016x}", find(i)) for i in ids)


def quality(docs, few=5, line_docs=50, share=0.05, left=0.3):
    texts, holders = defaultdict(set), defaultdict(set)
    norm = lambda line: line.strip(BLANKS).translate(LOWER)
    for _, t, s in docs:
        texts[s].add(t)
        for line in (t or "").split("\n"):
            if WORD.search(line) and len(norm(line)) >= 10:
                holders[s, norm(line)].add(t)
    out = []
    for i, t, s in docs:
        w, every = WORD.findall(t or ""), [x for x in (t or "").split("\n") if WORD.search(x)]
        grams = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        again = {p for k in range(len(w) - 4) if grams[tuple(w[k : k + 5])] > 1 for p in range(k, k + 5)}
        failed = len(w) < 10 or 100 * len(again) > 20 * len(w)
        boiler = sum(len(WORD.findall(x)) for x in every if len(holders[s, norm(x)]) > max(few, min(line_docs, share * len(texts[s]))))
        out.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(every) - len(set(every)), len(again), failed, not failed and not (len(w) - boiler) < left * len(w), boiler))
    return sorted(out)
