"""Personal data: base patterns against plain expressions, the tagger's gradients, what it learns, hard inputs."""

import hashlib
import random
import re
import time

import numpy as np
import pytest

from tidemark.llm import char_tagger
from tidemark.llm import personal_data as pd

SCHEMA = "doc_id long, text string, n_email int, spans string"


def plain(text):
    """The base patterns as they are stated."""
    out = [(m.start(), m.end(), 0) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), m.end(), 1) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        total = sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits)))
        if 13 <= len(digits) <= 19 and total % 10 == 0:
            out.append((m.start(), m.end(), 2))
    out += [(m.start(), m.end(), 3) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


@pytest.mark.parametrize("alphabet", ["a1.@-", "0123456789.", "01 -", "+1 ().-2", "ab@._x.@ 12+é"])
def test_base_spans_equal_the_plain_patterns(alphabet):
    rng = random.Random(alphabet)
    for _ in range(1500):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        assert pd.base_spans(text) == plain(text), text


def test_long_runs_take_linear_time():
    began = time.time()
    for run in ("1" * 1_000_000, "a" * 1_000_000, "1." * 500_000, "+1(" * 300_000, "a@" * 500_000, "@" * 1_000_000, "1 " * 500_000):
        pd.base_spans(run)
    assert time.time() - began < 30


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    ids, gold = rng.integers(0, 64, (3, 7)), rng.integers(0, 5, (3, 7))
    model = char_tagger.Tagger(5, hidden=4)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    model.p["to"] = rng.normal(size=(5, 5))
    _, grads = model.gradients(ids, gold)
    for k, x in model.p.items():
        at = (1, ids[0, 3], 5) if k == "x" else tuple(rng.integers(0, s) for s in x.shape)
        held, losses = x[at], []
        for step in (1e-3, -1e-3):
            x[at] = held + step
            losses.append(model.gradients(ids, gold)[0])
        x[at] = held
        assert grads[k][at] == pytest.approx((losses[0] - losses[1]) / 2e-3, rel=2e-3, abs=2e-6)


def test_decoding_equals_all_paths():
    rng = np.random.default_rng(1)
    model = char_tagger.Tagger(3, hidden=4, seed=2)
    model.p["to"] = rng.normal(size=(3, 3)).astype(np.float32)
    ids = rng.integers(0, 64, (4, 5))
    e = model.emissions(ids)
    tags, outside = model.decode(ids)
    for b in range(4):
        scores = {}
        for code in range(3**5):
            path = [code // 3**t % 3 for t in range(5)]
            scores[tuple(path)] = float(sum(e[t, b, path[t]] for t in range(5)) + sum(model.p["to"][x, y] for x, y in zip(path[:-1], path[1:], strict=True)))
        assert tuple(tags[b]) == max(scores, key=scores.get)
        weights = {p: np.exp(s) for p, s in scores.items()}
        for t in range(5):
            assert outside[b, t] == pytest.approx(sum(w for p, w in weights.items() if p[t] == 0) / sum(weights.values()), abs=1e-4)


def test_windows_cover_the_surroundings_of_every_trigger():
    rng = random.Random(4)
    for _ in range(200):
        text = "".join(rng.choice("abc     " if rng.random() < 0.97 else "1@") for _ in range(rng.randint(1, 1500)))
        starts = pd.window_starts(text)
        assert starts == sorted(set(starts))
        for m in re.finditer("[0-9@]", text):
            a, b = max(0, m.start() - pd.MARGIN // 2), min(len(text), m.end() + pd.MARGIN // 2)
            assert any(s <= a and b <= s + pd.WINDOW for s in starts)


def test_spans_of_several_windows_are_reconciled():
    text = "x 4929 9636 8986 1572 y"
    whole = (2, 21)
    cut = [(2, 11, 2, 9.0), (9, 21, 2, 12.0)]  # two windows, each seeing a part
    assert pd.plausible(text[slice(*whole)], 2)
    assert pd.reconciled(cut, text) == [(*whole, 2)]
    assert pd.reconciled([*cut, (7, 21, 3, 12.0)], text) == [(*whole, 2)]  # the greater mass
    assert pd.reconciled([(4, 21, 2, 17.0)], text) == [(*whole, 2)]  # no number is cut
    assert pd.reconciled([(2, 21, 2, 3.0)], text) == []


PIECES = ["joe", "at", "a", "-", "x.y", "dot", "com", ".", " ", " ", " ", "(", ")", "[", "]", "\n", "@", "(at)", " dot ", "(dot)", "AT", "12", "4929", "+", "mail", "_", "cat"]


def test_windows_hold_every_plausible_span():
    rng, held = random.Random(7), 0
    for _ in range(3000):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(3, 16)))
        seen = np.zeros(len(text), bool)
        for start in pd.window_starts(text):
            seen[start : start + pd.WINDOW] = True
        for a in range(len(text)):
            for b in range(a + 3, len(text) + 1):
                if not seen[a:b].all():
                    assert not any(pd.plausible(text[a:b], k) for k in range(4)), (text, text[a:b])
                elif "@" not in text and pd.plausible(text[a:b], 0):
                    held += 1
    assert held > 100


@pytest.mark.parametrize("address", ["joe at example.com", "joe(at)example.com", "j" * 90 + " at " + "mail-" * 30 + "x.org", "a (dot) " * 20 + "b [AT] m" + "[dot]com" * 20, "a at x dot " + "at(dot)" * 60 + "at"])
def test_addresses_without_digits_or_signs_are_looked_at_whole(address):
    text = "words " * 50 + address + " words" * 50
    seen = {i for s in pd.window_starts(text) for i in range(s, s + pd.WINDOW)}
    assert pd.plausible(address, 0) and set(range(300, 300 + len(address))) <= seen
    assert pd.window_starts("words " * 50 + "at home. Then at last" + " words" * 50) == []


def test_windows_are_found_in_linear_time():
    began = time.time()
    for run in ("at(dot)" * 100_000, "at " * 200_000, "at dot " * 100_000, "at dot dot " * 60_000, "x@at." * 100_000, "a at b" + " " * 500_000, "at" + " ( " * 200_000 + ".", "a(dot)" * 100_000 + " at b.c", "-at" * 200_000 + ".c"):
        pd.window_starts(run)
    assert time.time() - began < 30


class Everything:
    """A tagger that tags whole windows, padding and all, as spans of one kind."""

    def __init__(self, kind):
        self.kind = kind

    def decode(self, ids):
        tags = np.full(ids.shape, 2 + 2 * self.kind, np.int8)
        tags[:, 0] -= 1
        return tags, np.zeros(ids.shape, np.float32)


@pytest.mark.parametrize(("text", "kind", "found"), [("020 7946 0958", 3, (0, 13, 3)), ("4929/9636/8986/1572", 2, (0, 19, 2)), ("7 dot", 1, None), ("@", 0, None)])
def test_spans_end_where_the_text_ends(text, kind, found):
    base, every = pd.Detector(Everything(kind)).judge([text, "", text + " "])[0]
    assert every == ([found] if found else []) and base == []


def documents(rng, n):
    words = "the of and reading lines some thing where often water house".split()
    make = {
        0: lambda: f"{rng.choice(words)}.{rng.randint(1, 99)}@mail{rng.randint(1, 9)}.example.{rng.choice(['com', 'org'])}",
        1: lambda: ".".join(str(rng.randint(1, 255)) for _ in range(4)),
        2: lambda: card(rng),
        3: lambda: f"+{rng.randint(1, 9)} ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)}",
    }
    prose = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(5, 40)))
    out = []
    for i in range(n):
        kind = i % 6
        inside = make[kind]() if kind < 4 else rng.choice([str(rng.randint(1, 99999)), "2024-03-05", f"{rng.randint(1, 9)}.{rng.randint(1, 9)}", "12:30"])
        left, right = prose(), prose()
        out.append((f"{left} {inside} {right}", len(left) + 1, len(left) + 1 + len(inside), kind if kind < 4 else None))
    return out


def card(rng):
    head = [rng.randint(0, 9) for _ in range(15)]
    for last in range(10):
        digits = "".join(map(str, [*head, last]))
        if pd.luhn(digits):
            return digits if rng.random() < 0.5 else " ".join(digits[i : i + 4] for i in range(0, 16, 4))


@pytest.fixture(scope="module")
def detector(spark):
    docs = [(i, t[0], 0, "") for i, t in enumerate(documents(random.Random(1), 900))]
    return pd.learn_detector(spark.createDataFrame([*docs, (None, None, 1, "x"), docs[0], docs[0]], SCHEMA))


def test_other_ways_of_writing_are_found_and_clean_texts_left_alone(detector):
    rng = random.Random(99)
    hit, total, false = {}, {}, 0
    for text, a, b, kind in documents(rng, 900):
        if kind is None:
            false += len(detector.judge([text])[0][1])
            continue
        written = pd.another(text[a:b], kind, rng)
        changed, end = text[:a] + written + text[b:], a + len(written)
        base, every = detector.judge([changed])[0]
        assert set(base) <= set(every) and base == pd.base_spans(changed)
        if not base:
            total[kind] = total.get(kind, 0) + 1
            hit[kind] = hit.get(kind, 0) + any(x < end and a < y and k == kind for x, y, k in every)
    assert false <= 2
    assert all(hit[k] / total[k] >= 0.6 for k in range(4)) and sum(hit.values()) / sum(total.values()) >= 0.75, (hit, total)


def test_a_table_gives_one_row_each(spark, detector):
    long = ("word " * 200_000) + "reach me at joe.1 (at) mail2 (dot) example (dot) com today " + "1234567 " * 20_000
    rows = [(1, "write to a@b.co or +1 (017) 555-7713", 9, "s"), (2, None, 9, "s"), (3, "", 9, "s"), (None, "10.0.0.1", 9, "s"), (4, long, 9, "s"), (1, "write to a@b.co or +1 (017) 555-7713", 9, "s")]
    got = pd.find_personal_data(spark.createDataFrame(rows, SCHEMA), detector).collect()
    assert len(got) == 6
    first = [r for r in got if r.doc_id == 1]
    assert first[0] == first[1] and first[0].spans == "email:9:15,phone:19:36" and (first[0].n_email, first[0].n_ip, first[0].n_card, first[0].n_phone, first[0].n_learned) == (1, 0, 0, 1, 0)
    assert first[0].base_sha256 == hashlib.sha256(b"email:9:15,phone:19:36").hexdigest()
    empty = hashlib.sha256(b"").hexdigest()
    assert all((r.spans, r.base_sha256) == ("", empty) for r in got if r.doc_id in (2, 3))
    assert [r.spans for r in got if r.doc_id is None] == ["ip:0:8"]
    assert [r.n_email for r in got if r.doc_id == 4] == [0]
    assert pd.find_personal_data(spark.createDataFrame([], SCHEMA), detector).collect() == []


def test_nothing_to_learn_from_leaves_the_base_patterns(spark):
    docs = spark.createDataFrame([(1, "no data 12 here", 0, ""), (2, None, 0, "")], SCHEMA)
    assert pd.learn_detector(docs).tagger is None and pd.learn_detector(docs.where("false")).tagger is None
    assert [r.spans for r in pd.find_personal_data(docs, pd.Detector(None)).collect()] == ["", ""]
