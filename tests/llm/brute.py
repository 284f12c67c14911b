"""Plain versions of the operators, for small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def near_documents(rows, words_each, percent=80):
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + words_each]) for k in range(max(1, len(w) - words_each + 1))} if w else set()
    parent = {i: i for i in sets}
    holders = defaultdict(list)
    for i, s in sets.items():
        common = defaultdict(int)
        for x in s:
            for k in holders[x]:
                common[k] += 1
            holders[x].append(i)
        for k, c in common.items():
            if 100 * c >= percent * (len(s) + len(sets[k]) - c):
                a, b = sorted((find(parent, i), find(parent, k)))
                parent[b] = a
    return {i: (len(sets[i]), find(parent, i)) for i in sets}


def without_repeats(rows, width=100):
    seen, out = set(), {}
    for i, text in sorted(rows):
        data = (text or "").encode()
        gone = [False] * (len(data) + 1)
        for k in range(len(data) - width + 1):
            window = data[k : k + width]
            if window in seen:
                gone[k : k + width] = [True] * width
            seen.add(window)
        left = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(data), sum(gone), runs, hashlib.sha256(left).hexdigest())
    return out


def spelling(rows, least_length=5, least_count=3, typo_every=97):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if typo_every and h % typo_every == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}
    return with_forms(counts)


def with_forms(counts):
    near = {w: near_words(w, counts) for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), counts.get(form[w]))
    return out


def near_words(word, counts):
    letters = {c for w in counts for c in w}
    found = {word[:k] + word[k + 1 :] for k in range(len(word))}
    for k in range(len(word) + 1):
        for c in letters:
            found |= {word[:k] + c + word[k:], word[:k] + c + word[k + 1 :]} if k < len(word) else {word + c}
    return {w for w in found if w in counts and w != word}


def hard_negatives(rows, every, positives=5, negatives=10, least=30, most=90):
    """rows: (id, integer vector, label), each id once."""
    out = []
    for a, va, la in rows:
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(va, v)), i, lab) for i, v, lab in rows if i != a and len(v) == len(va)]
        for minus, p, _ in sorted(s for s in scored if s[2] == la)[:positives]:
            fits = sorted(s for s in scored if s[2] != la and least * -minus <= 100 * -s[0] <= most * -minus)
            out += [(a, p, k + 1, n, -minus, -s) for k, (s, n, _) in enumerate(fits[:negatives])]
    return sorted(out)


def copies(rows):
    groups = defaultdict(list)
    norm = {}
    for i, text in rows:
        norm[i] = re.sub("[\x20\x09-\x0d]+", " ", text or "")
        groups[norm[i]].append(i)
    first = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return {i: (first[t], len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in norm.items()}
