"""Plain-Python versions of what the operators should find, for small fixtures."""

import re
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, size=5):
    words = WORD.findall(lower(text))
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def groups(rows, near=80, of=100):
    """{doc_id: (number of shingles, least doc_id of the component)} for rows (doc_id, text) with unique ids."""
    sets = {i: shingles(t) for i, t in rows}
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and of * len(x & y) >= near * len(x | y):
            p, q = sorted((root(a), root(b)))
            label[q] = p
    return {i: (len(sets[i]), root(i)) for i in sets}
