"""Plain versions of the corpus operators for small inputs: (doc_id, text) pairs in, dicts by row out."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

LAST = 2**63 - 1


def key(d):
    return LAST if d is None else d


def words(text):
    return (text or "").encode().split()


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def window_holders(docs, window):
    held = defaultdict(set)
    for d, t in docs:
        w = words(t)
        for a in range(len(w) - window + 1):
            held[tuple(w[a : a + window])].add(key(d))
    return held


def substrings(docs, window):
    """(doc_id, n_words, n_removed, kept)."""
    held, out = window_holders(docs, window), []
    for d, t in docs:
        w, gone = words(t), set()
        for a in range(len(w) - window + 1):
            if min(held[tuple(w[a : a + window])]) < key(d):
                gone.update(range(a, a + window))
        out.append((d, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


def passages(docs, window):
    """{(doc_id, n_repeated, first_ids)} of the documents with repeated windows."""
    held, out = window_holders(docs, window), set()
    for d, t in docs:
        w, rep, first = words(t), set(), set()
        for a in range(len(w) - window + 1):
            h = held[tuple(w[a : a + window])]
            if len(h) > 1:
                rep.update(range(a, a + window))
                first.add(min(h))
        if rep:
            out.add((d, len(rep), tuple(sorted(first))))
    return out


ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def contamination(docs, items, span=13):
    """(doc_id, n_words, n_hit, items, contaminated)."""
    windows = defaultdict(set)
    for i, t in items:
        w = ALNUM.findall((t or "").translate(LOWER))
        n = min(span, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[a : a + n])].add("" if i is None else str(i))
    lengths, out = {len(k) for k in windows}, []
    for d, t in docs:
        w, hit, names = ALNUM.findall((t or "").translate(LOWER)), set(), set()
        for n in lengths:
            for a in range(len(w) - n + 1):
                if (k := tuple(w[a : a + n])) in windows:
                    hit.update(range(a, a + n))
                    names |= windows[k]
        out.append((d, len(w), len(hit), tuple(sorted(names)), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def edits(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


def lines(docs, least):
    """(doc_id, n_lines, removed, kept); documents must differ in id and text hash order must not matter."""
    seen, out = [], {}
    for d, t in sorted(set(docs), key=lambda r: key(r[0])):
        parts, gone, n = (t or "").split("\n"), [], 0
        for i, line in enumerate(parts):
            w = words(line)
            if not w:
                continue
            n += 1
            if any(w == s or min(len(w), len(s)) >= least and abs(len(w) - len(s)) <= 1 and edits(w, s) <= 1 for s in seen):
                gone.append(i)
            seen.append(w)
        out[d, t] = (d, n, tuple(gone), "\n".join(p for i, p in enumerate(parts) if i not in gone))
    return [out[r] for r in docs]


def bag(text, n=5):
    w = words(text)
    return Counter(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else Counter()


def jaccard(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def near_classes(docs, threshold=0.8):
    """(doc_id, class_id, class_size)."""
    bags = [bag(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if bags[i] and bags[j] and jaccard(bags[i], bags[j]) >= threshold:
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(docs)):
        groups[find(i)].append(key(docs[i][0]))
    heads = {k: min(v) for k, v in groups.items()}
    return [(docs[i][0], None if heads[find(i)] == LAST else heads[find(i)], len(groups[find(i)])) for i in range(len(docs))]


def corpus(seed=3):
    """(doc_id, text): ordinary texts, copies, near copies, shared passages, and every odd case."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefghijklmnopqrstuvwxyzéü") for _ in range(r.randint(1, 8))) for _ in range(400)]
    text = lambda n: "".join(r.choice(vocabulary) + r.choice([" ", " ", " ", "  ", ". ", "\n", "\t"]) for _ in range(n))
    passage, line = text(70), " ".join(r.choice(vocabulary) for _ in range(14))
    docs = [(i, text(r.randint(1, 400))) for i in range(40)]
    for i in range(40, 60):
        base = docs[r.randrange(40)][1].split(" ")
        for _ in range(r.randint(0, 4)):
            base[r.randrange(len(base))] = r.choice(vocabulary)
        docs.append((i, " ".join(base)))
    for i in range(60, 75):
        docs.append((i, text(r.randint(5, 60)) + "\n" + line + "\n" + passage + text(r.randint(5, 60))))
    for i in range(75, 85):
        other = line.split(" ")
        other[r.randrange(len(other))] = r.choice(vocabulary)
        docs.append((i, text(20) + "\n" + " ".join(other) + "\n" + text(20) + "\n" + " ".join(other[1:])))
    docs += [(90, None), (91, ""), (92, " \n\t \n"), (93, "..."), (94, docs[3][1]), (95, docs[3][1]), (96, "one"), (97, "one\none\none")]
    docs += [(98, text(20_000)), (99, "\n".join(["same line again and again and again here now"] * 300)), (100, "x" * 30_000)]
    docs += [(None, docs[5][1] + " end"), docs[7], docs[7], docs[62]]
    return docs


# ---- vectors: (vec_id, embedding, label) in


def negatives(rows, anchors_of=50, moved=7, scale=256, n_labels=10, n_positives=5, n_negatives=3):
    """Counter of (anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    told = set()
    for i, v, label in rows:
        if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v):
            told.add((i, (label + 1) % n_labels if i % moved == 0 else label, tuple(math.floor(scale * x) for x in v)))
    score = lambda a, b: sum(x * y for x, y in zip(a[2], b[2]))
    out = Counter()
    for anchor in {i: min(r for r in told if r[0] == i) for i, _, _ in told if i % anchors_of == 0}.values():
        ranked = sorted((-score(anchor, r), r[0], r[1]) for r in told if r[0] != anchor[0])
        for p, positive, _ in [r for r in ranked if r[2] == anchor[1]][:n_positives]:
            fit = [r for r in ranked if r[2] != anchor[1] and -50 * p <= -100 * r[0] <= -95 * p]
            out.update((anchor[0], positive, k + 1, r[1], -p, -r[0]) for k, r in enumerate(fit[:n_negatives]))
    return out


def vector_links(rows, threshold):
    """Counter of (vec_id, n_links, component_id, kept), one for each row."""

    def sound(r):
        return r[1] is not None and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])

    told = {(key(i), label, tuple(v)) for i, v, label in rows if sound((i, v, label))}
    size = lambda v: math.sqrt(sum(x * x for x in v))
    near = {a: {b for b in told if b != a and a[1] == b[1] and len(a[2]) == len(b[2])
                and sum(x * y for x, y in zip(a[2], b[2])) >= threshold * size(a[2]) * size(b[2])} for a in told}
    head = {}
    for a in sorted(told):
        group, rest = set(), [a]
        while rest and a not in head:
            x = rest.pop()
            if x not in group:
                group.add(x)
                rest += near[x]
        head.update((x, a[0]) for x in group)
    out = Counter()
    for i, v, label in rows:
        if sound((i, v, label)):
            a = (key(i), label, tuple(v))
            out[i, len(near[a]), None if head[a] == LAST else head[a], key(i) == head[a]] += 1
        else:
            out[i, 0, i, True] += 1
    return out


def ranking(docs, items, k=10):
    """Counter of (item_id, rank, doc_id, score); rows of ``items`` that repeat id and text are one item."""

    def terms(t):
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)

    held = [(key(d), Counter(terms(t))) for d, t in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    n_docs, n_words = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = Counter()
    for item, text in set(items):
        rows = []
        for d, c, n in held:
            m = 10 + 90 * n * n_docs // n_words
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                rows.append((-score, d))
        out.update((item, i + 1, None if d == LAST else d, -s) for i, (s, d) in enumerate(sorted(rows)[:k]))
    return out
