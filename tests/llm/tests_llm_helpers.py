import random

WORDS = "the of and to in is that for it as was with be by on not he his but at are this have from or had an they".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", "er", "ing", "ly"]) for _ in range(n))


def classes(items, linked):
    """Smallest item reachable by links, for every item; tries all pairs."""
    parent = {i: i for i in items}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    order = sorted(items)
    for k, a in enumerate(order):
        for b in order[k + 1:]:
            if linked(a, b):
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return {i: top(i) for i in items}
