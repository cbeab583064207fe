"""Repeated passages against brute force, and recall by passage length."""

import random
import re

import pytest

from tidemark.llm import skew, substring_dedup
from tidemark.llm.substring_dedup import BLOCK_WORDS, MIN_WORDS, WINNOW, block_starts
from tidemark.llm.textops import hash_words

WORDS = [f"w{i}" for i in range(400)]
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def shingles(line):
    w = [x.lower() for x in WORD.findall(line.encode())]
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}


def brute_paragraphs(docs):
    """{(doc, pos): removed} of paragraphs joined with another one by links of three quarters."""
    sets = {(d, p): shingles(line) for d, t in docs for p, line in enumerate(t.split("\n")) if len(WORD.findall(line.encode())) >= MIN_WORDS}
    parent = {x: x for x in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    places = sorted(sets)
    for i, x in enumerate(places):
        for y in places[i + 1 :]:
            both = len(sets[x] & sets[y])
            if 100 * both >= 75 * (len(sets[x]) + len(sets[y]) - both):
                a, b = find(x), find(y)
                parent[max(a, b)] = min(a, b)
    groups = {}
    for x in places:
        groups.setdefault(find(x), []).append(x)
    return {x: x != min(g) for g in groups.values() if len(g) > 1 for x in g}


def chosen(text):
    """Starts of verbatim blocks, window by window."""
    h = hash_words(text)
    keys = [int(v) >> 28 for v in substring_dedup.windows(h, 5)][: max(0, len(h) - BLOCK_WORDS + 1)]
    width = min(WINNOW, len(keys))
    return {min(range(i, i + width), key=lambda k: (keys[k], k)) for i in range(len(keys) - width + 1)} if keys else set()


def brute_spans(docs):
    """{doc: (spans, removed spans)} from blocks compared word by word."""
    places = {}
    for d, t in sorted(docs):
        found = list(WORD.finditer(t.encode()))
        words = [m[0].lower() for m in found]
        for s in sorted(chosen(t)):
            places.setdefault(tuple(words[s : s + BLOCK_WORDS]), []).append((d, found[s].start(), found[s + BLOCK_WORDS - 1].end()))
    out = {}
    for held in places.values():
        first = {}
        for d, a, b in held:
            first.setdefault(d, b)
        again = {(d, a) for d, a, b in held if a >= first[d]}
        if len(first) > 1 or again:
            for d, a, b in held:
                out.setdefault(d, ([], []))[0].append((a, b))
                if d != min(first) or (d, a) in again:
                    out[d][1].append((a, b))

    def merge(spans):
        done = []
        for a, b in sorted(spans):
            if done and a <= done[-1][1]:
                done[-1] = (done[-1][0], max(done[-1][1], b))
            else:
                done.append((a, b))
        return done

    return {d: (merge(x), merge(y)) for d, (x, y) in out.items()}


def corpus(seed):
    rng = random.Random(seed)
    passages = [prose(rng, rng.randint(30, 90)) for _ in range(8)]
    lines = [prose(rng, rng.randint(20, 60)) for _ in range(8)]
    docs = []
    for d in range(70):
        parts = []
        for _ in range(rng.randint(1, 5)):
            kind = rng.random()
            if kind < 0.25:
                w = rng.choice(lines).split()
                for _ in range(rng.randint(0, 3)):
                    w[rng.randrange(len(w))] = rng.choice(WORDS)
                parts.append(" ".join(w))
            elif kind < 0.5:
                parts.append(prose(rng, rng.randint(5, 40)) + "  " + rng.choice(passages).upper() + "\t" + prose(rng, rng.randint(5, 40)))
            else:
                parts.append(prose(rng, rng.randint(1, 70)))
        docs.append((d, "\n".join(parts)))
    docs += [(100, docs[3][1]), (101, docs[3][1]), (102, "é " * 60 + "\nx"), (103, ""), (104, passages[0] + " " + prose(rng, 3000) + " " + passages[0])]
    return docs


@pytest.mark.parametrize(("seed", "most"), [(1, 512), (2, 3)])
def test_repeated_passages_equal_brute_force(spark, monkeypatch, seed, most):
    monkeypatch.setattr(skew, "HOT", most)
    if most == 3:
        monkeypatch.setattr(skew, "BROADCAST_BYTES", 0)
    docs = corpus(seed)
    rows = [(d, t, 1, "x") for d, t in docs] + [(None, docs[0][1], 1, "x"), (200, None, 1, "x"), (docs[5][0], docs[5][1], 1, "x")]
    got = {r.doc_id: r for r in substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string, spans int, id string")).collect()}
    paragraphs, spans = brute_paragraphs(docs), brute_spans(docs)
    assert set(got) == {d for d, _ in paragraphs} | set(spans)
    assert {(d, p.pos): p.removed for d, r in got.items() for p in r.paragraphs} == paragraphs
    for d, r in got.items():
        want = spans.get(d, ([], []))
        assert ([tuple(s) for s in r.spans], [tuple(s) for s in r.removed_spans]) == want, d
        assert r.n_spans == len(want[0]) and r.span_bytes == sum(b - a for a, b in want[0])


def test_block_starts_equal_a_slow_search():
    rng = random.Random(3)
    for n in (0, 5, 31, 32, 33, 51, 52, 200, 900):
        text = " ".join(rng.choice(WORDS[:3] if n == 200 else WORDS) for _ in range(n))
        assert set(block_starts(hash_words(text)).tolist()) == chosen(text)


def test_recall_by_length_of_a_passage_inside_other_text():
    rng = random.Random(4)
    found = {}
    for n in (32, 36, 40, 44, 48, 50, 51, 60, 100):
        hits = 0
        for _ in range(300):
            passage = prose(rng, n)
            sides = []
            for _ in range(2):
                before = rng.randint(0, 80)
                text = f"{prose(rng, before)} {passage} {prose(rng, rng.randint(0, 80))}"
                sides.append({s - before for s in chosen(text) if 0 <= s - before <= n - BLOCK_WORDS})
            hits += bool(sides[0] & sides[1])
        found[n] = hits / 300
    assert found[51] == found[60] == found[100] == 1.0
    assert found[48] > 0.9 and found[44] > 0.7 and found[40] > 0.4 and found[36] > 0.2, found

