"""Plain, slow versions of the operators, to hold results against."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def suffix_dedup(docs, span=50):
    """{doc: (bytes, removed, spans, digest)} of {doc: text}."""
    first = {}
    for i, text in sorted(docs.items()):
        data = (text or "").encode()
        for p in range(len(data) - span + 1):
            first.setdefault(data[p : p + span], i)
    out = {}
    for i, text in docs.items():
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - span + 1):
            if first[data[p : p + span]] < i:
                gone[p : p + span] = True
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out[i] = (len(data), int(gone.sum()), runs, sha(np.frombuffer(data, np.uint8)[~gone].tobytes()))
    return out


_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def item_words(text):
    return _WORD.findall((text or "").encode().lower())


def contamination(docs, items, window=10):
    """{doc: (words, hit, items, digest)}."""
    windows = defaultdict(set)
    for item, text in items:
        words = item_words(text)
        for at in range(max(len(words) - window + 1, 1 if words else 0)):
            if item is not None:
                windows[tuple(words[at : at + window])].add(str(item))
            else:
                windows[tuple(words[at : at + window])]
    sizes = {len(w) for w in windows}
    out = {}
    for i, text in docs.items():
        words = item_words(text)
        hit, found = set(), set()
        for size in sizes:
            for at in range(len(words) - size + 1):
                key = tuple(words[at : at + size])
                if key in windows:
                    hit.update(range(at, at + size))
                    found |= windows[key]
        out[i] = (len(words), len(hit), len(found), sha(",".join(sorted(found))))
    return out


def line_dedup(docs):
    key = lambda line: lower(line.strip(" \t\n\x0b\x0c\r"))
    first = {}
    for i, text in sorted(docs.items()):
        for line in (text or "").split("\n"):
            first.setdefault(key(line), i)
    out = {}
    for i, text in docs.items():
        lines = (text or "").split("\n")
        kept = [line for line in lines if len(key(line)) < 10 or first[key(line)] == i]
        out[i] = (len(lines), len(lines) - len(kept), sha("\n".join(kept)), "\n".join(kept))
    return out


def fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + width]) for i in range(max(len(words) - width + 1, 1))] if words else []
    value = 0
    for bit in range(64):
        if sum(xxhash.xxh64_intdigest(s, 42) >> bit & 1 for s in shingles) * 2 > len(shingles):
            value |= 1 << bit
    return value


def components(marks, budget=3):
    """{doc: smallest doc reachable} of {doc: fingerprint}."""
    parent = {i: i for i in marks}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(marks)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (marks[a] ^ marks[b]).bit_count() <= budget:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in ids}


def tokens(text):
    return [w for w in re.split(rb"[\x20\x09-\x0D]+", (text or "").encode().lower()) if w] + [None]


def base_scores(docs, folds=10):
    """{doc: (tokens, known, training tokens, base score)}."""
    counts = Counter()
    for i, text in docs.items():
        if zlib.crc32(str(i).encode()) % folds:
            counts.update(tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = {}
    for i, text in docs.items():
        mine = tokens(text)
        out[i] = (len(mine), sum(counts[w] > 0 for w in mine), n, sum(np.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in mine))
    return out


_KINDS = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
)


def _luhn(digits):
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def base_spans(text):
    found = []
    for order, (kind, pattern) in enumerate(_KINDS):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")),
                "card": 12 <= len(digits) <= 19 and _luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(found)]


def window_dedup(rows, width=20):
    """(words, spans, kept) of each (id, text): by looking at every window."""
    split = [(i, (text or "").encode().split()) for i, text in rows]
    first = {}
    for i, words in split:
        for p in range(len(words) - width + 1):
            if i is not None:
                key = tuple(words[p : p + width])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, words in split:
        gone, own = [False] * len(words), set()
        for p in range(len(words) - width + 1):
            key = tuple(words[p : p + width])
            if key in own or (i is not None and first[key] < i):
                gone[p : p + width] = [True] * width
            own.add(key)
        edges = [k for k in range(len(words) + 1) if (gone + [False])[k] != ([False] + gone)[k]]
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((len(words), list(zip(edges[::2], edges[1::2])), kept))
    return out


def record(*values):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def merkle(groups):
    """{group: [(leaf, subroot, root, proof)]} of {group: [leaf]}, groups and leaves in order."""

    def climb(level):
        ways, here = [[] for _ in level], list(range(len(level)))
        while len(level) > 1:
            for k, at in enumerate(here):
                if at ^ 1 < len(level):
                    ways[k].append((at & 1, level[at ^ 1]))
                else:
                    ways[k].append(None)
                here[k] = at // 2
            level = [sha("".join(level[at : at + 2])) for at in range(0, len(level), 2)]
        return level[0], ways

    subs = {g: climb(leaves) for g, leaves in groups.items()}
    root, tops = climb([s for s, _ in subs.values()])
    return {
        g: [(leaf, subs[g][0], root, own + top) for leaf, own in zip(groups[g], subs[g][1])]
        for g, top in zip(groups, tops)
    }


def fold(leaf, proof):
    for step in proof:
        leaf = sha(leaf if step is None else step[1] + leaf if step[0] else leaf + step[1])
    return leaf


def runs(words, least=12):
    """[(start, length, period)] of all runs, by trying every period at every place."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        p = 0
        while p + q < len(words):
            if words[p] != words[p + q]:
                p += 1
                continue
            e = p
            while e + q < len(words) and words[e] == words[e + q]:
                e += 1
            if e + q - p >= max(least, 2 * q):
                found.setdefault((p, e + q), q)
            p = e + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapsed(words, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return b" ".join(w for k, w in enumerate(words) if k not in gone)
