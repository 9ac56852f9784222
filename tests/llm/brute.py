"""Plain Python versions to test against."""

import hashlib
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text, width=5):
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}


def near_components(docs, pct):
    """{id: (n, component)} by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in docs]
    root = {i: i for i, _ in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            both = len(a & b)
            if a and b and 100 * both >= pct * (len(a) + len(b) - both):
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), top(i)) for i, s in sets}


def words(rng, n, vocab=4000):
    return [f"w{rng.randrange(vocab)}" for _ in range(n)]


def corpus(seed=1):
    """(id, text) rows: plain documents, exact copies, two groups of near
    copies over all similarities, odd texts."""
    rng = random.Random(seed)
    docs = [" ".join(words(rng, rng.randrange(1, 120))) for _ in range(60)]
    docs += [docs[0]] * 5 + [docs[3]] * 3
    for size, copies in ((90, 70), (40, 25)):
        base = words(rng, size)
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randrange(0, 6)):
                at = rng.randrange(len(own))
                kind = rng.random()
                if kind < 0.6:
                    own[at] = f"w{rng.randrange(4000)}"
                elif kind < 0.8:
                    del own[at]
                else:
                    own.insert(at, f"w{rng.randrange(4000)}")
            docs.append(" ".join(own))
    docs += ["", "   ", "one two", "One  TWO", "a b c d", "a b c d e", "\n\n", "É é"]
    rng.shuffle(docs)
    return list(enumerate(docs))


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()
