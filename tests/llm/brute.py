"""Plain single-process versions of the operators, used as the truth in tests."""

from __future__ import annotations

import re

SPACE_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def words(text, lower=False):
    text = text or ""
    if lower:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return SPACE_WORDS.findall(text)


def removed_words(docs, window=20):
    """docs: (doc_id, text). Per row: n_words, n_removed and the kept words."""
    first = {}
    low = -2 ** 63
    for i, text in sorted(docs, key=lambda d: low if d[0] is None else d[0]):
        w = words(text)
        for s in range(len(w) - window + 1):
            key = tuple(w[s:s + window])
            at = (low if i is None else i, s)
            first[key] = min(first.get(key, at), at)
    out = []
    for i, text in docs:
        w = words(text)
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s:s + window])] < (low if i is None else i, s):
                gone.update(range(s, s + window))
        kept = [x for p, x in enumerate(w) if p not in gone]
        out.append((i, len(w), len(gone), " ".join(kept)))
    return out


def near_classes(docs, share=0.75, k=5):
    """docs: (doc_id, text), ids distinct. doc_id -> (n_shingles, component_id)."""
    sets = {}
    for i, text in docs:
        w = words(text, lower=True)
        sets[i] = {tuple(w[s:s + k]) for s in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = {(a, b) for held in holders.values() for a in held for b in held if a < b}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), find(i)) for i in sets}


def removed_lines(docs, min_lines=2):
    """Lines covered by a run of ``min_lines`` lines that starts earlier. Rows: id, n_lines, removed, kept text."""
    low = -2 ** 63
    first, split = {}, {}
    for n, (i, text) in enumerate(docs):
        lines = (text or "").split("\n") if text else []
        split[n] = lines
        for s in range(len(lines) - min_lines + 1):
            at = (low if i is None else i, s)
            key = tuple(lines[s:s + min_lines])
            first[key] = min(first.get(key, at), at)
    out = []
    for n, (i, _) in enumerate(docs):
        lines, gone = split[n], set()
        for s in range(len(lines) - min_lines + 1):
            if first[tuple(lines[s:s + min_lines])] < (low if i is None else i, s):
                gone.update(range(s, s + min_lines))
        out.append((i, len(lines), len(gone), "\n".join(x for p, x in enumerate(lines) if p not in gone)))
    return out


def contaminated(docs, items, window=10):
    """Rows: id, n_words, n_hit, items as sorted strings."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def cut(text):
        return word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    windows = {}
    for item, text in items:
        w = cut(text)
        size = min(window, len(w))
        for s in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[s:s + size]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for i, text in docs:
        w, hit, found = cut(text), set(), set()
        for size in sizes:
            for s in range(len(w) - size + 1):
                held = windows.get(tuple(w[s:s + size]))
                if held:
                    found |= held
                    hit.update(range(s, s + size))
        out.append((i, len(w), len(hit), ",".join(sorted(str(x) for x in found))))
    return out
