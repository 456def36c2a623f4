"""Small documents with every oddity, and plain-Python definitions of what the operators return."""

import random
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def odd_documents(seed=1):
    """(doc_id, text): copies, near copies of near copies, a shared passage, nulls, empties, one long text, repeated rows."""
    rng = random.Random(seed)
    base = sentence(rng, 90).split()
    rows = [(0, " ".join(base)), (1, " ".join(base)), (2, " ".join(base).upper())]
    for i in range(3, 40):  # mutations of mutations: some are near to some others only
        words = list(base if i % 3 else rows[-1][1].lower().split())
        for _ in range(rng.randrange(1, 5)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(999)}"
        rows.append((i, " ".join(words)))
    passage = sentence(rng, 45)
    rows += [(100 + i, sentence(rng, rng.randrange(5, 60)) + " " + passage + "\n" + sentence(rng, 30)) for i in range(12)]
    rows += [(200, None), (201, ""), (202, " \n\t "), (203, "one"), (204, "ONE"), (205, "one two three"), (206, "one two three"),
             (207, "one two three four"), (208, "...!!! ???"), (209, "né à Zürich, ça va; 日本語 テキスト"), (210, "a b c"),
             (211, sentence(rng, 60_000)), (212, "ab" * 500), (213, "z" * 3000)]
    rows += [rows[5], rows[5], (None, "one two three four five six"), (None, None)]
    return rows


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingle_set(text, k):
    w = spaced(text)
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


class Sets:
    def __init__(self, items):
        self.parent = {x: x for x in items}

    def find(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def near_duplicates(rows, k, percent):
    """{doc_id: (n, component, kept)}"""
    sets = {i: shingle_set(t, k) for i, t in rows if i is not None}
    groups, ids = Sets(sets), sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                groups.join(a, b)
    return {i: (len(sets[i]), groups.find(i), groups.find(i) == i) for i in ids}
