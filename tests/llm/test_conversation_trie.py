"""The conversation trie against brute force: shared and hot prefixes, collisions, long conversations, hard inputs."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import conversation_trie, skew

SCHEMA = "conv_id long, turn long, role string, text string, extra int"
#: The nodes of four small trees, worked out by hand below.
COLUMNS = ("parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows, rebuild):
    held = {}
    for c, t, r, x, *_ in rows:
        if c is not None:
            held.setdefault(c, []).append(((t is not None, t or 0), r or "", x or ""))
    own = {c: [(r, x) for _, r, x in sorted(v)] for c, v in held.items()}
    convs = own
    if rebuild:
        cut = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
        convs = {c: own.get(c - c % 5, [])[: cut[c]] + v[cut[c] :] for c, v in own.items()}
    members, kids = {}, {}
    for c, v in convs.items():
        for d in range(len(v) + 1):
            members.setdefault(tuple(v[:d]), []).append(c)
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)

    def subtree(p):
        todo = [p]
        while todo:
            yield (q := todo.pop())
            todo += kids.get(q, [])

    out = {}
    for p, m in members.items():
        below = list(subtree(p))
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p))
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        out[min(m), len(p)] = (min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), sum(q not in kids for q in below), saved, hashlib.sha256(ends.encode()).hexdigest())
    return out


def nodes(spark, rows, **how):
    got = conversation_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA), **how).collect()
    found = {(r.conv_id, r.depth): tuple(r[c] for c in COLUMNS) for r in got}
    assert len(found) == len(got)
    return found


def made(seed=7, convs=60, words="abc", longest=7):
    rng, rows = random.Random(seed), []
    for c in range(convs):
        for t in range(rng.randint(1, longest)):
            rows.append((c, t if rng.random() < 0.9 else None, rng.choice(["user", "assistant", None]), rng.choice([*words, "é" * 3, "", None]), c))
    rows += [(c, t, "user", f"hot {t}", 0) for c in range(100, 130) for t in range(3)]  # exact copies
    rows += [rows[0], rows[0], (None, 0, "user", "x", 1)]  # a turn three times; no conversation
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("rebuild", [False, True])
def test_trie_equals_brute_force(spark, monkeypatch, rebuild):
    monkeypatch.setattr(skew, "HOT", 8)
    rows = made()
    assert nodes(spark, rows, rebuild=rebuild) == brute(rows, rebuild)


def test_conversations_longer_than_a_chunk(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "CHUNK", 4)
    monkeypatch.setattr(conversation_trie, "ENDS", 4)
    monkeypatch.setattr(skew, "HOT", 8)
    rows = [(c, t, "user", f"{t % 3}" if t < 30 - c else f"{c} {t}", 0) for c in range(6) for t in range(40)]
    rows += [(c, t, "user", f"{t % 3}", 0) for c in range(10, 40) for t in range(13)]
    assert nodes(spark, rows) == brute(rows, False)


def test_colliding_fingerprints_and_digests_are_split(spark):
    rows = made(convs=25)
    weak = lambda role, text: (F.length(text).cast("long"), F.length(role).cast("long"))
    assert nodes(spark, rows, digest=weak, modulus=11) == brute(rows, False)


def test_by_hand(spark):
    rows = [(5, 0, "u", "hi", 0), (5, 1, "a", "yes", 0), (6, 0, "u", "hi", 0), (6, 1, "a", "no", 0), (7, 0, "u", "hi", 0)]
    empty = hashlib.sha256(b"").hexdigest()
    seven, six, five = (hashlib.sha256(x).hexdigest() for x in (b"7", b"6", b"5"))
    assert nodes(spark, rows) == {(5, 0): (None, 3, 1, 2, 4, empty), (5, 1): (5, 3, 2, 2, 4, seven), (5, 2): (5, 1, 0, 1, 0, five), (6, 2): (5, 1, 0, 1, 0, six)}


def test_turnless_conversations_and_empty_tables(spark):
    # Conversation 7 lacks its base and loses all of its own turns, if h is large enough.
    lone = next(c for c in range(1, 50) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 1)
    rows = [(lone, 0, "u", "x", 0)]
    assert nodes(spark, rows, rebuild=True) == brute(rows, True) == {(lone, 0): (None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())}
    assert nodes(spark, [], rebuild=True) == {}
    assert nodes(spark, [(None, 1, "u", "x", 0)]) == {}


def test_a_very_long_text_and_other_column_names(spark):
    long = "wörd " * 200_000
    rows = [(1, 0, "u", long, 0), (2, 0, "u", long, 0), (2, 1, "a", long + "!", 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumnsRenamed({"conv_id": "rep", "text": "d", "extra": "n_convs"})
    got = conversation_trie.conversation_trie(df, conv_id="rep", text="d").collect()
    assert {(r.conv_id, r.depth): tuple(r[c] for c in COLUMNS) for r in got} == brute(rows, False)


def test_products_and_sums_modulo_are_exact():
    import numpy as np

    rng = random.Random(3)
    p = conversation_trie.MODULUS
    x, y = ([rng.choice([0, 1, p - 1, rng.randrange(p)]) for _ in range(500)] for _ in range(2))
    assert conversation_trie.multiply(np.array(x, np.uint64), np.array(y, np.uint64)).tolist() == [a * b % p for a, b in zip(x, y, strict=True)]
    starts = np.array([True] + [rng.random() < 0.05 for _ in x[1:]])
    want, s = [], 0
    for v, new in zip(x, starts, strict=True):
        s = v if new else (s + v) % p
        want.append(s)
    assert conversation_trie.running_sums(np.array(x, np.uint64), starts).tolist() == want
    assert conversation_trie.powers(12345, 7, 9).tolist() == [pow(12345, 7 + i, p) for i in range(9)]
