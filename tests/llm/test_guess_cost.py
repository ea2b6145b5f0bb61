"""Guess costs against a search of all cuts; the balance of costs in packing."""

import collections
import math
import random
import re

from tidyline.llm import packing, secrets

ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
LOOKS = dict(zip("4@831!0$57", "aabeliosst", strict=True))


def pieces(v, i, j):
    """Costs of v[i:j] as one piece."""
    low, out = v.lower(), []
    if j - i == 1:
        out.append(0.55 if i and v[i].isalpha() and v[i].islower() and v[i - 1].isalpha() else 1.0)
    begins = i == 0 or low[i - 1] != low[i]
    if j - i >= 3 and len(set(low[i:j])) == 1 and begins:
        out.append(1 + math.log10(j - i) + math.log10(2))
    near = lambda a, b: any(abs(r.find(a) - r.find(b)) == 1 for r in ROWS if a in r and b in r)
    if j - i >= 3 and all(near(a, b) for a, b in zip(low[i:j], low[i + 1:j], strict=False)) and (i == 0 or not near(low[i - 1], low[i])):
        out.append(math.log10(40 * (j - i)) + math.log10(2))
    m = re.match(secrets.DATE, v[i:])
    if m and m.end() == j - i:
        out.append(math.log10(36500 if j - i > 4 else 100) + math.log10(2))
    for word, extra in ((low[i:j], 0), ("".join(LOOKS.get(c, c) for c in low[i:j]), math.log10(4))):
        if j - i >= 3 and word in secrets.WORDS:
            caps = min(2, sum(c.isupper() for c in v[i:j]))
            out.append(math.log10(secrets.WORDS.index(word) + 2) + extra + caps * math.log10(2) + math.log10(2))
            break
    return out


def all_cuts(v, i=0, memo=None):
    """Least cost of v[i:] over every way to cut it."""
    memo = {} if memo is None else memo
    if i == len(v):
        return 0.0
    if i not in memo:
        memo[i] = min(c + all_cuts(v, j, memo) for j in range(i + 1, len(v) + 1) for c in pieces(v, i, j))
    return memo[i]


def test_costs_equal_all_cuts():
    r = random.Random(1)
    parts = ["password", "P4ssw0rd", "dragon", "2019-12-31", "1999", "aaaa", "qwer", "9876", "Zx", "!", "k", "for", "FOR", "sunsh1ne", "31122019", "sss", "é"]
    for _ in range(1500):
        v = "".join(r.choice(parts) for _ in range(r.randint(1, 4)))[: r.randint(1, 24)]
        assert abs(secrets.guess_cost(v) - all_cuts(v)) < 1e-9, v
    for _ in range(500):
        v = "".join(r.choice("aA1!qwé$") for _ in range(r.randint(1, 14)))
        assert abs(secrets.guess_cost(v) - all_cuts(v)) < 1e-9, v


def plain_assign(lengths, capacity):
    """Descending rests to the cheapest sequence that has room for the whole, else to the cheapest with any room."""
    rest = sorted(((n % capacity, -d) for d, n in enumerate(lengths)), reverse=True)
    bins = [[0.0, capacity, []] for _ in range(-(-sum(n for n, _ in rest) // capacity))]
    for n, d in rest:
        while n:
            fit = [b for b in bins if b[1] >= n] or [b for b in bins if b[1]]
            b = min(fit, key=lambda b: b[0])
            m = min(n, b[1])
            b[0] += packing.LINEAR * m + packing.QUADRATIC * m * m
            b[1] -= m
            b[2].append((-d, m))
            n -= m
    return bins


def test_packing_takes_the_cheapest_sequence():
    import numpy as np
    r = random.Random(3)
    for _ in range(40):
        lengths = [r.choice([r.randint(1, 60), r.randint(1, 900), 2048, 5000]) for _ in range(r.randint(1, 80))]
        got = packing.assign(np.array(lengths), 2048)
        full = sum(n // 2048 for n in lengths)
        seqs = collections.defaultdict(list)
        for d, _, n, q, _ in got:
            if q >= full:
                seqs[q].append((d, n))
        want = plain_assign(lengths, 2048)
        assert sorted(map(sorted, seqs.values())) == sorted(sorted(b[2]) for b in want if b[2])
    # costs lie closer together than when each goes to the first sequence with room
    lengths = [700] * 20 + [100] * 160 + [30] * 400
    costs = [b[0] for b in plain_assign(lengths, 2048)]
    first = [[0.0, 2048] for _ in costs]
    for n in sorted(lengths, reverse=True):
        b = next((b for b in first if b[1] >= n), first[-1])
        b[0] += packing.LINEAR * n + packing.QUADRATIC * n * n
        b[1] -= n
    assert max(costs) - min(costs) < max(b[0] for b in first) - min(b[0] for b in first)
