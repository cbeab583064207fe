"""State merging against a plain form: states are prefixes, and everything is looked up anew at every step."""

import math
import random
from collections import Counter

import pytest

from tidemark.llm import secret_scan


def plain_automaton(words, alpha):
    counts, kids = {"": Counter()}, {"": {}}
    for w in words:
        for i in range(len(w) + 1):
            counts.setdefault(w[:i], Counter())[w[i] if i < len(w) else ""] += 1
            kids.setdefault(w[:i], {})
            if i < len(w):
                kids[w[:i]][w[i]] = w[: i + 1]

    def agree(a, b):
        m, n = sum(counts[a].values()), sum(counts[b].values())
        if m and n:
            bound = math.sqrt(0.5 * math.log(2 / alpha)) * (1 / math.sqrt(m) + 1 / math.sqrt(n))
            if any(abs(counts[a][c] / m - counts[b][c] / n) > bound for c in {*counts[a], *counts[b]}):
                return False
            return all(agree(kids[a][c], kids[b][c]) for c in kids[a] if c in kids[b])
        return True

    def fold(a, b):
        counts[a] += counts[b]
        for c, to in kids[b].items():
            if c in kids[a]:
                fold(kids[a][c], to)
            else:
                kids[a][c] = to

    red = [""]
    while blue := [(r, c) for r in red for c in sorted(kids[r]) if kids[r][c] not in red]:
        r, c = blue[0]
        q = kids[r][c]
        match = next((x for x in red if agree(x, q)), None)
        if match is None:
            red.append(q)
        else:
            kids[r][c] = match
            fold(match, q)

    def log_likelihood(word):
        at, total = "", 0.0
        symbols = secret_scan._SYMBOLS
        for c in [*word, ""]:
            if at is None:
                total -= math.log(len(symbols))
                continue
            total += math.log((counts[at][c] + 0.05) / (sum(counts[at].values()) + 0.05 * (len(symbols) + 1)))
            at = kids[at].get(c) if c else at
        return total, len(red)

    return log_likelihood


def words_of(rng, form, n):
    runs = {"hex": lambda: "".join(rng.choice("a0") for _ in range(rng.randint(6, 14))), "key": lambda: "GAGA" + "".join(rng.choice("A0G") for _ in range(8)), "mix": lambda: "-".join("".join(rng.choice("ga") for _ in range(3)) for _ in range(rng.randint(2, 4)))}
    return [runs[form]() for _ in range(n)]


@pytest.mark.parametrize("form", ["hex", "key", "mix"])
@pytest.mark.parametrize("alpha", [0.05, 0.5])
def test_automaton_equals_the_plain_form(form, alpha):
    rng = random.Random(f"{form}{alpha}")
    words = words_of(rng, form, 120)
    ours, plain = secret_scan.Automaton(words, alpha), plain_automaton(words, alpha)
    for w in [*words[:30], *words_of(rng, "hex", 10), *words_of(rng, "key", 10), *words_of(rng, "mix", 10), "", "a+=_"]:
        assert ours.log_likelihood(w) == pytest.approx(plain(w)[0], abs=1e-9), w
    assert len(ours.next) <= len(words[0]) * len(words)
