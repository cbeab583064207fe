"""Personal data: base patterns, and spans that a character tagger learned from them.

The base patterns label e-mail addresses, IP addresses, card and telephone
numbers. A bounded sample of labelled spans with their surroundings trains the
bidirectional LSTM-CRF of ``char_tagger``; in half of the training windows the
span is written another way that people use (``at`` and ``dot`` in words, other
separators, no plus sign), and windows without personal data hold dates,
versions, prices and plain numbers, so that the tagger learns the form and its
surroundings rather than one pattern. Every text is searched in full: windows
that overlap by half cover, whole and with their surroundings, all stretches
that can hold a span: digits, at signs, the word ``dot``, and what can be an
address around the word ``at``. Text outside of them holds none that passes the
exact check of its kind, whatever the tagger would say there. Windows are
decoded by themselves; over the whole text, spans cut at a window's edge are
joined, and of spans that exclude each other the set with the greatest
posterior mass stays. A learned span must pass the exact check of its kind
(digits and Luhn sum of a card, parts of an address, the form of an e-mail) and
touch no base span; base spans always stay.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.char_tagger import WINDOW, Tagger, classes, train
from tidemark.llm.textops import map_rows, slices, struct
from tidemark.llm.workspace import Workspace

KINDS = ("email", "ip", "card", "phone")
#: Documents that labelled spans are drawn from, at most (expected number, by a hash of the text).
SAMPLE_DOCS = 20_000
#: Different labelled spans of a kind that the tagger learns from, and windows without one, at most.
SAMPLE_SPANS, SAMPLE_OTHER = 300, 400
EPOCHS = 9
#: Least mean posterior probability of a learned span.
MIN_POSTERIOR = 0.8
#: Characters around a stretch that are looked at (those of a number's span beyond its digits, at most), and kept around a labelled span.
MARGIN, CONTEXT = 32, WINDOW

# Fixed values of the base patterns.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_NUMERALS = frozenset("0123456789")
_DIGITS = re.compile(r"[0-9]+")
_TRIGGER = re.compile(r"[0-9@]|\bdot\b", re.IGNORECASE)
_AT_CORE = re.compile(r"@|\bat\b", re.IGNORECASE)
_AT_TAIL = re.compile(r"\s*[\)\]}>]?\s*")
#: What may follow ``_AT`` in an address.
_WRITTEN_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:(?:\.|\s*[\(\[{<]\s*(?:\.|dot)\s*[\)\]}>]\s*|\s+(?:\.|dot)\s+)[A-Za-z0-9-]+)+", re.IGNORECASE)
#: What may stand before the core of ``_AT``, read backwards; spaces and brackets touch a dot.
_LOCAL_BACKWARDS = re.compile(r"\s*[\(\[{<]?\s*(?:[A-Za-z0-9._%+-]+|(?:(?<=\.)|(?<=tod))[\s()\[\]{}<>]+|[\s()\[\]{}<>]+(?=\.|tod))+", re.IGNORECASE)
_AT = re.compile(r"\s*[\(\[{<]?\s*(?:@|\bat\b)\s*[\)\]}>]?\s*", re.IGNORECASE)
_DOT = re.compile(r"\s*[\(\[{<]\s*(?:\.|dot)\s*[\)\]}>]\s*|\s+(?:\.|dot)\s+", re.IGNORECASE)


def luhn(digits: str) -> bool:
    odd = sum(int(c) for c in digits[-1::-2])
    return (odd + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(c)] for c in digits[-2::-2])) % 10 == 0


def _octets(parts: Iterable[str]) -> bool:
    return all(len(p) <= 3 and int(p) <= 255 for p in (p.lstrip("0") or "0" for p in parts))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The matches of the e-mail pattern, found from their at signs: long runs of letters cost no more than others."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of the base patterns, by kind, then start; per kind leftmost, not overlapping, failing ones dropped."""
    out = [(a, b, 0) for a, b in emails(text)] if "@" in text else []
    out += [(m.start(), m.end(), 1) for m in _IP.finditer(text) if _octets(m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), 2))
    if "+" in text:
        out += [(m.start(), m.end(), 3) for m in _PHONE.finditer(text) if 9 <= sum(map(len, _DIGITS.findall(m[0]))) <= 15]
    return out


def plausible(span: str, kind: int) -> bool:
    """The exact check of a learned span."""
    if kind == 0:
        return _EMAIL.fullmatch(_DOT.sub(".", _AT.sub("@", span, count=1))) is not None
    numbers = _DIGITS.findall(span)
    ahead, *gaps, after = _DIGITS.split(span) if numbers else ("", "")
    if max(len(ahead), len(after)) > MARGIN:
        return False
    if kind == 1:
        return len(numbers) == 4 and _octets(numbers) and len({g.strip() for g in gaps}) == 1 and all(len(g) <= 5 and ("." in g or "dot" in g.lower()) for g in gaps)
    n = sum(map(len, numbers))
    if any(len(g) > 4 for g in gaps):
        return False
    if kind == 2:
        return 13 <= n <= 19 and luhn("".join(numbers)) and (len(numbers) == 1 or len(numbers) >= 3)
    return 9 <= n <= 15 and len(numbers) >= 3 and max(map(len, numbers)) <= 8


# --- training windows

_SEPARATORS = {0: (" @ ", "(at)", " (at) ", "[at]", " [at] ", " at ", " AT ", "@"), 1: ("[.]", "(.)", " . ", "[dot]", " dot "), 2: (".", "_", "/", " . ", "  ", "--", " - "), 3: (".", "-", " ", "/", ") ", " - ")}
_DECOYS = ("0000-00-00", "00.00.0000", "00:00:00", "0000-00-00 00:00", "0.00.0", "v0.0.0.0.0", "0,000.00", "000 000", "$00.00", "00%", "#00000000", "00000000", "0000000000", "00-00", "000.000", "0000/00", "(0000)", "0.0.", "ISBN 000-0-00-000000-0", "at 00.00", "@0", "dot")


def another(span: str, kind: int, rng: random.Random) -> str:
    """The span written another way."""
    if kind == 0:
        local, _, domain = span.partition("@")
        dot = rng.choice((".", ".", " . ", "(dot)", " (dot) ", "[dot]", " dot ", " DOT "))
        return local + rng.choice(_SEPARATORS[0]) + domain.replace(".", dot)
    if kind == 1:
        return span.replace(".", rng.choice(_SEPARATORS[1]))
    sep = rng.choice(_SEPARATORS[kind])
    if kind == 2:
        digits = "".join(_DIGITS.findall(span))
        return sep.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    numbers = _DIGITS.findall(span)
    head = rng.choice(("", "", "00", "0", "tel ", "+"))
    tail = numbers if len(numbers) > 2 or rng.random() < 0.3 else re.findall("...?.?", "".join(numbers))
    opening = "(" if sep == ") " else ""
    lead = opening if head == "tel " else head + opening
    return lead + tail[0] + sep + ("-" if sep == ") " else sep).join(tail[1:]) if len(tail) > 1 else lead + tail[0]


def _digits_anew(text: str, rng: random.Random) -> str:
    return "".join(rng.choice("0123456789") if "0" <= c <= "9" else c for c in text)


def _window(left: str, span: str, right: str, kind: int | None, rng: random.Random) -> tuple[np.ndarray, np.ndarray]:
    """Class numbers and tags of a window over the span, anywhere in it, sometimes cut."""
    text = left + span + right
    gold = np.zeros(len(text), np.int8)
    marks = [(a, b, k) for a, b, k in base_spans(left)] + [(a + len(left) + len(span), b + len(left) + len(span), k) for a, b, k in base_spans(right)]
    if kind is not None:
        marks.append((len(left), len(left) + len(span), kind))
    for a, b, k in marks:
        gold[a:b] = 2 + 2 * k
        gold[a] = 1 + 2 * k
    at = rng.randint(len(left) + len(span) - WINDOW + 2, len(left) - 2) if len(span) < WINDOW - 4 else len(left) - rng.randint(-8, 8)
    if rng.random() < 0.1:
        at = len(left) + rng.randint(0, len(span))  # cut at the window's edge
    ids, tags = np.zeros(WINDOW, np.uint8), np.zeros(WINDOW, np.int8)
    a, b = max(0, at), min(len(text), at + WINDOW)
    if b > a:
        ids[a - at : b - at], tags[a - at : b - at] = classes(text[a:b]), gold[a:b]
    return ids, tags


def training_windows(spans: list[tuple[int, str, str, str]], others: list[tuple[str, str, str]], epoch: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows and tags of an epoch, from (kind, left, span, right) and (left, run, right)."""
    rng = random.Random(epoch)
    made = []
    for kind, left, span, right in spans:
        for written in (span, another(span, kind, rng)) if rng.random() < 0.8 else (span,):
            made.append(_window(left, _digits_anew(written, rng) if kind in (1, 3) else written, right, kind, rng))
    for left, run, right in others:
        # Runs of digits as they come, then a decoy in their place.
        for written in (run, _digits_anew(rng.choice(_DECOYS), rng)):
            made.append(_window(left, written, right, None, rng))
    return np.stack([i for i, _ in made]), np.stack([t for _, t in made])


@dataclass(frozen=True)
class Detector:
    """Base patterns and, where there were spans to learn from, a tagger."""

    tagger: Tagger | None

    def learned(self, texts: list[str], base: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
        """(start, end, kind) of the learned spans of every text."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        if self.tagger is None:
            return out
        where = [(i, at) for i, text in enumerate(texts) for at in window_starts(text)]
        proposed: list[list[tuple[int, int, int, float]]] = [[] for _ in texts]
        for at in range(0, len(where), 4096):  # bounds the memory of long texts
            part = where[at : at + 4096]
            ids = np.zeros((len(part), WINDOW), np.uint8)
            for row, (i, start) in enumerate(part):
                piece = classes(texts[i][start : start + WINDOW])
                ids[row, : len(piece)] = piece
            tags, outside = self.tagger.decode(ids)
            for row in np.flatnonzero(tags.any(axis=1)):
                i, start = part[row]
                held = min(WINDOW, len(texts[i]) - start)  # what follows is padding, which no span holds
                proposed[i] += [(start + a, start + b, k, mass) for a, b, k, mass in tagged_spans(tags[row, :held], outside[row, :held])]
        for i, spans in enumerate(proposed):
            if spans:
                out[i] = [s for s in reconciled(spans, texts[i]) if not any(a < s[1] and s[0] < b for a, b, _ in base[i])]
        return out

    def judge(self, texts: list[str]) -> list[tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]]:
        """(base spans, all spans) of every text, by kind, then start."""
        base = [base_spans(t) for t in texts]
        return [(b, sorted(b + more, key=lambda s: (s[2], s[0], s[1]))) for b, more in zip(base, self.learned(texts, base), strict=True)]


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Stretches that hold every plausible e-mail span, in time linear in the text: at signs and words ``at`` with a local part and a domain."""
    backwards, last, known = "", 0, 0
    for m in _AT_CORE.finditer(text):
        after = _AT_TAIL.match(text, m.end()).end()
        if after == m.end() and after < known:
            end = known  # within a domain: the same labels follow
        else:
            domain = _WRITTEN_DOMAIN.match(text, after)
            end = domain.end() if domain else 0
            known = max(known, end)
        if end:
            backwards = backwards or text[::-1]
            # No local part holds another at, but it may begin within that word.
            local = _LOCAL_BACKWARDS.match(backwards, len(text) - m.start(), len(text) - last)
            if local:
                yield len(text) - local.end(), end
        last = m.start() + 1


def window_starts(text: str) -> list[int]:
    """Starts of windows that cover everything within ``MARGIN`` of what can hold a span, overlapping by half where more than one is needed."""
    out, covered = [], -1
    for a, b in sorted([*((m.start(), m.end()) for m in _TRIGGER.finditer(text)), *addresses(text)]):
        if b + MARGIN <= covered:
            continue
        if not out or a - MARGIN > covered - WINDOW // 2:
            start = max(0, a - MARGIN)
        else:
            start = covered - WINDOW // 2
        while True:
            out.append(start)
            covered = start + WINDOW
            if covered >= min(len(text), b + MARGIN):
                break
            start = covered - WINDOW // 2
    return out


def tagged_spans(tags: np.ndarray, outside: np.ndarray) -> list[tuple[int, int, int, float]]:
    """(start, end, kind, posterior mass) of the spans of a window."""
    out, at = [], 0
    while at < len(tags):
        tag = int(tags[at])
        if not tag:
            at += 1
            continue
        kind, start = (tag - 1) // 2, at
        at += 1
        while at < len(tags) and tags[at] == 2 + 2 * kind:
            at += 1
        out.append((start, at, kind, float((1 - outside[start:at]).sum())))
    return out


def reconciled(spans: list[tuple[int, int, int, float]], text: str) -> list[tuple[int, int, int]]:
    """The spans of a text's windows as one set without overlaps.

    Overlapping spans of a kind, seen by two windows or cut by an edge, become
    one more candidate, their union. Of candidates that pass the check of
    their kind the non-overlapping set with the greatest mass is chosen.
    """
    best: dict[tuple[int, int, int], float] = {}
    run: list = []
    for a, b, k, mass in sorted(spans, key=lambda s: (s[2], s[0], s[1])):
        if run and run[2] == k and a <= run[1]:
            share = max(0, b - run[1]) / (b - a)
            run[1], run[3] = max(run[1], b), run[3] + mass * share
        else:
            run = [a, b, k, mass]
        for x, y, kind, m in ((a, b, k, mass), tuple(run)):
            while x < y and not (text[x].isalnum() or text[x] in "+(_%"):
                x += 1
            while y > x and not text[y - 1].isalnum():
                y -= 1
            # No number is cut.
            while 0 < x < y and text[x - 1] in _NUMERALS and text[x] in _NUMERALS:
                x -= 1
            while x < y < len(text) and text[y - 1] in _NUMERALS and text[y] in _NUMERALS:
                y += 1
            if y > x:
                best[x, y, kind] = max(best.get((x, y, kind), 0.0), min(m, y - x))
    likely = [(a, b, k, m) for (a, b, k), m in best.items() if m >= MIN_POSTERIOR * (b - a)]
    # Numbers alike in form (four groups with dots) are told apart by the exact checks.
    kinds = [next((kind for kind in ((k, 1, 2) if k else (0,)) if plausible(text[a:b], kind)), None) for a, b, k, _ in likely]
    good = [(a, b, kind, m) for (a, b, _, m), kind in zip(likely, kinds, strict=True) if kind is not None]
    good.sort(key=lambda s: (s[1], s[0], s[2]))
    ends = [s[1] for s in good]
    mass, took = [0.0], [None]
    for n, (a, _, _, m) in enumerate(good):
        before = int(np.searchsorted(ends[:n], a, side="right"))
        with_it = mass[before] + m
        mass.append(max(mass[-1], with_it))
        took.append((n, before) if with_it > mass[-2] else None)
    out, at = [], len(good)
    while at:
        if took[at] is None:
            at -= 1
        else:
            n, at = took[at]
            out.append(good[n][:3])
    return sorted(out, key=lambda s: (s[2], s[0]))


def learn_detector(docs: DataFrame, *, text: str = "text", epochs: int = EPOCHS) -> Detector:
    """A detector trained on base spans of a sample of the texts; without any it has the base patterns only.

    Texts are drawn by hash, so the draw does not depend on how rows are
    dealt out; equal spans in equal surroundings count once. Null texts teach nothing.
    """
    n = docs.count()
    rate = min(1.0, SAMPLE_DOCS / max(1, n))
    texts = docs.select(F.col(text).alias("text")).where(F.col("text").isNotNull())
    drawn = texts.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(rate * (1 << 30)))

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows: list[tuple] = []
                for t in part.column(0).to_pylist():
                    spans = base_spans(t)
                    for a, b, k in spans:
                        if b - a < WINDOW:
                            rows.append((k, t[max(0, a - CONTEXT) : a], t[a:b], t[b : b + CONTEXT]))
                    for m in _DIGITS.finditer(t):
                        # A number as long as a card's has its form; whether it is one the sum of its digits says, not the tagger.
                        if m.end() - m.start() < 13 and not any(a - 2 <= m.end() and m.start() <= b + 2 for a, b, _ in spans):
                            rows.append((len(KINDS), t[max(0, m.start() - CONTEXT) : m.start()], m[0][:WINDOW], t[m.end() : m.end() + CONTEXT]))
                cols = list(zip(*rows, strict=True)) or [(), (), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.string()) for c in cols[1:]]], names=["kind", "before", "span", "after"])

    found = drawn.mapInArrow(collect, struct("kind int, before string, span string, after string"))
    ws = Workspace(docs.sparkSession, "personal")
    sample = ws.save(found.distinct(), "labelled")
    least = lambda k, most: sample.where(F.col("kind") == k).orderBy(F.xxhash64("before", "span", "after"), "span", "before").limit(most).collect()
    spans = [(k, r.before, r.span, r.after) for k in range(len(KINDS)) for r in least(k, SAMPLE_SPANS)]
    others = [(r.before, r.span, r.after) for r in least(len(KINDS), SAMPLE_OTHER)]
    ws.drop(sample)
    if not spans:
        return Detector(None)
    # Decoys need surroundings even where no number stands free.
    others = others or [(left, "", right) for _, left, _, right in spans]
    return Detector(train(lambda epoch: training_windows(spans, others, epoch), 1 + 2 * len(KINDS), epochs))


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def find_personal_data(docs: DataFrame, detector: Detector, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_learned), one row per input row.

    Counts and digest are those of the base spans; ``spans`` holds the learned
    ones too. Offsets are code points, ends exclusive. A null text is empty.
    Null ids and repeated rows stay; other columns are not read. An empty
    table gives an empty result.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(detector)

    def prepare():
        def work(ids, texts):
            judged = shared.value.judge([t or "" for t in texts])
            counts = [[sum(k == kind for _, _, k in base) for base, _ in judged] for kind in range(len(KINDS))]
            return [ids, *counts, [hashlib.sha256(spans_text(base).encode()).hexdigest() for base, _ in judged], [spans_text(every) for _, every in judged], [len(every) - len(base) for base, every in judged]]

        return work

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return map_rows(rows, struct(f"doc_id {id_type}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_learned long"), prepare)
