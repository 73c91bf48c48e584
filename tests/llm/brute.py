"""Plain Python versions of the operators, for small tables."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SPACED = re.compile("[^\x20\x09-\x0d]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def contamination(docs, items, n=13):
    """[(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)]"""
    windows = defaultdict(set)
    for item, text in items:
        w = WORD.findall(low(text))
        size = min(n, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows[tuple(w[i:i + size])].add("" if item is None else str(item))
    out = []
    for doc_id, text in docs:
        w = WORD.findall(low(text))
        hit, found = set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in windows:
                    hit |= set(range(i, i + size))
                    found |= windows[tuple(w[i:i + size])]
        out.append((doc_id, len(w), len(hit), len(found), sha(",".join(sorted(found))),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return out


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum((2 * sum(h >> i & 1 for h in hashes) > len(hashes)) << i for i in range(64))


def near_copies(docs, bits=2):
    """[(doc_id, fingerprint, component_id)]"""
    prints = [fingerprint(t) for _, t in docs]
    own = sorted(set(prints))
    up = {p: p for p in own}

    def top(p):
        while up[p] != p:
            p = up[p]
        return p

    for i, p in enumerate(own):
        for o in own[i + 1:]:
            if (p ^ o).bit_count() <= bits:
                up[top(o)] = top(p)
    least = defaultdict(list)
    for (d, _), p in zip(docs, prints):
        least[top(p)] += [] if d is None else [d]
    return [(d, f"{p:016x}", min(least[top(p)], default=None)) for (d, _), p in zip(docs, prints)]


def without_repeats(docs, width=35):
    """[(doc_id, n_words, n_removed, kept text)]"""
    words = [SPACED.findall(t or "") for _, t in docs]
    seen = Counter(tuple(w[i:i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for (d, _), w in zip(docs, words):
        gone = {j for i in range(len(w) - width + 1) if seen[tuple(w[i:i + width])] > 1 for j in range(i, i + width)}
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def fill(budget, nodes):
    """{name: (cap, weight)} -> {name: share}, in whole tokens."""
    got, left, rest = {}, budget, sum(w for _, w in nodes.values())
    order = sorted(nodes, key=lambda x: (nodes[x][0] / nodes[x][1], x))
    while order and nodes[order[0]][0] * rest <= left * nodes[order[0]][1]:
        name = order.pop(0)
        got[name] = nodes[name][0]
        left -= got[name]
        rest -= nodes[name][1]
    return got | {x: left * nodes[x][1] // rest for x in order}


def mixed(rows, mix):
    """rows: [(doc_id, domain, lang, source, tokens, key)] -> copies of each row."""
    leaves = defaultdict(list)
    for i, r in enumerate(rows):
        leaves[r[1:4]].append(i)
    tokens = {leaf: sum(rows[i][4] for i in own) for leaf, own in leaves.items()}
    cap = lambda *head: sum(t for leaf, t in tokens.items() if leaf[:len(head)] == head) * mix.max_epochs
    top = fill(sum(tokens.values()) * mix.permille // 1000,
               {d: (cap(d), mix.domains.get(d, 1)) for d in {x[0] for x in leaves}})
    copies = [0] * len(rows)
    for d, b in top.items():
        langs = fill(b, {x: (cap(d, x), mix.langs.get(x, 1)) for x in {y[1] for y in leaves if y[0] == d}})
        for g, c in langs.items():
            sources = fill(c, {x: (cap(d, g, x), mix.sources.get(x, 1)) for x in {y[2] for y in leaves if y[:2] == (d, g)}})
            for s, budget in sources.items():
                leaf = (d, g, s)
                if not tokens[leaf]:
                    continue
                epoch, rest = divmod(budget, tokens[leaf])

                def place(i):
                    named = [str(mix.seed), str(epoch)] + ([] if rows[i][0] is None else [str(rows[i][0])])
                    return int(hashlib.md5(":".join(named).encode()).hexdigest()[:15], 16), rows[i][5]

                upto = 0
                for i in sorted(leaves[leaf], key=place):
                    upto += rows[i][4]
                    copies[i] = epoch + (rest > 0 and upto <= rest)
    return copies


def row_key(doc_id, text):
    return hashlib.md5("\x1f".join(["" if doc_id is None else str(doc_id), "0" if text is None else "1",
                                    text or ""]).encode()).hexdigest()


def cosine_neighbours(vectors, v, k, leave=-1):
    sims = vectors @ v
    order = sorted((i for i in range(len(sims)) if sims[i] > 0 and i != leave), key=lambda i: (-sims[i], i))
    return [(i, float(sims[i])) for i in order[:k]]


def labels_of(edges, n):
    up = np.arange(n)
    for a, b in edges:
        x, y = sorted((up[a], up[b]))
        up[up == y] = x
    return up
