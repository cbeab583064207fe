"""Secret scanning: base patterns and format likelihood under inferred grammars.

The base patterns find assignments, access keys and long hexadecimal strings.
What they find, labelled by kind, is a sample of credentials; from it one
probabilistic automaton per kind is inferred: a prefix tree of symbol classes
whose states are merged while their outgoing frequencies agree (Hoeffding
bounds). Every candidate, that is every run of at least ``MIN_CANDIDATE``
credential characters and every credential of a base span, is then scored by
the log-likelihood ratio, per symbol, of its best automaton to a Markov model
of ordinary runs, whose transitions are counted over all texts in full. Runs
that reach the threshold are spans of kind ``learned``, unless a base span
holds them whole; base spans stay whatever their score.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.textops import map_rows, slices, struct
from tidemark.llm.workspace import Workspace

KINDS = ("assign", "access", "hex", "learned")
#: Distinct credentials of a kind that its grammar is inferred from, at most.
SAMPLE_CREDENTIALS = 6_000
#: Characters of a labelled credential that its grammar learns from, from its start.
CREDENTIAL_CHARS = 256
#: Shortest run that is a candidate.
MIN_CANDIDATE = 16
#: Confidence parameter of the compatibility test.
ALPHA = 0.05
#: Least log-likelihood ratio per symbol, in nats, whatever the samples say.
MIN_RATIO = 0.5

# Fixed values of the base patterns; letters of the first in either case.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % MIN_CANDIDATE)

_CLASS = str.maketrans(
    {c: "a" for c in "abcdef"} | {c: "g" for c in "ghijklmnopqrstuvwxyz"} | {c: "A" for c in "ABCDEF"} | {c: "G" for c in "GHIJKLMNOPQRSTUVWXYZ"} | {c: "0" for c in "0123456789"} | {"/": "+"}
)
_SYMBOLS = "agAG0+_.=-"
#: Class number of every byte; 0 stands between runs.
_BYTE_CLASS = np.zeros(256, np.uint8)
for _c in map(chr, range(128)):
    if (_k := _SYMBOLS.find(_c.translate(_CLASS))) >= 0:
        _BYTE_CLASS[ord(_c)] = _k + 1
_STEP = 1 << 20
_SCORED = ("start", "end", "score", "automaton")


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, credential) of the base patterns, per kind leftmost and not overlapping."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), m.end(), "assign", m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access", m[0]) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    # A run of 24 characters without white space needs a word as long.
    if any(len(w) >= 24 for w in text.split()):
        out += [(m.start(), m.end(), "hex", m[0]) for m in _HEX.finditer(text)]
    return out


def candidates(text: str) -> list[tuple[int, int, str]]:
    """Runs of credential characters."""
    if not any(len(w) >= MIN_CANDIDATE for w in text.split()):
        return []
    return [(m.start(), m.end(), m[0]) for m in _CANDIDATE.finditer(text)]


class Automaton:
    """A probabilistic deterministic automaton, inferred by state merging."""

    def __init__(self, words: Iterable[str], alpha: float = ALPHA):
        self.next: list[dict[str, int]] = [{}]
        self.count: list[Counter] = [Counter()]  # by symbol; "" is the end
        for w in sorted(words):
            at = 0
            for c in w:
                self.count[at][c] += 1
                if c not in self.next[at]:
                    self.next[at][c] = len(self.next)
                    self.next.append({})
                    self.count.append(Counter())
                at = self.next[at][c]
            self.count[at][""] += 1
        self._bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._infer()
        self._freeze()

    def _agree(self, a: int, b: int) -> bool:
        stack = [(a, b)]
        while stack:
            p, q = stack.pop()
            m, n = self.count[p].total(), self.count[q].total()
            if not m or not n:
                continue
            most = self._bound * (1 / math.sqrt(m) + 1 / math.sqrt(n))
            for c in self.count[p].keys() | self.count[q].keys():
                if abs(self.count[p][c] / m - self.count[q][c] / n) > most:
                    return False
            stack += [(self.next[p][c], self.next[q][c]) for c in self.next[p].keys() & self.next[q].keys()]
        return True

    def _fold(self, into: int, tree: int) -> None:
        """Adds the subtree at ``tree`` to the state ``into``."""
        stack = [(into, tree)]
        while stack:
            p, q = stack.pop()
            self.count[p].update(self.count[q])
            for c, r in self.next[q].items():
                if c in self.next[p]:
                    stack.append((self.next[p][c], r))
                else:
                    self.next[p][c] = r

    def _infer(self) -> None:
        red, blue = [0], sorted(self.next[0].items())
        edges = [(0, c, q) for c, q in blue]
        while edges:
            p, c, q = edges.pop(0)
            if self.next[p].get(c) != q or q in red:
                continue
            for r in red:
                if self._agree(r, q):
                    self.next[p][c] = r
                    self._fold(r, q)
                    edges = [(x, y, z) for x in red for y, z in sorted(self.next[x].items()) if z not in red]
                    break
            else:
                red.append(q)
                edges += [(q, y, z) for y, z in sorted(self.next[q].items()) if z not in red]

    def _freeze(self) -> None:
        """Keeps the states that can be reached, and their log-probabilities, with a little left for symbols never seen there."""
        order = [0]
        number = {0: 0}
        for at in order:  # grows as states are found
            for _, to in sorted(self.next[at].items()):
                if to not in number:
                    number[to] = len(order)
                    order.append(to)
        self.next = [{c: number[to] for c, to in self.next[at].items()} for at in order]
        self.count = [self.count[at] for at in order]
        self.log = []
        for counts in self.count:
            total = counts.total() + 0.05 * (len(_SYMBOLS) + 1)
            self.log.append({c: math.log((counts[c] + 0.05) / total) for c in [*_SYMBOLS, ""]})

    def log_likelihood(self, word: str) -> float:
        at, total = 0, 0.0
        for c in word:
            if at < 0:
                total -= math.log(len(_SYMBOLS))
                continue
            total += self.log[at].get(c, -10.0)
            at = self.next[at].get(c, -1)
        return total + (self.log[at][""] if at >= 0 else -math.log(len(_SYMBOLS)))


def transitions(text: str) -> np.ndarray:
    """Counts of class pairs in the text's runs of credential characters, starts and ends (0) included."""
    n = len(_SYMBOLS) + 1
    classes = np.concatenate([[0], _BYTE_CLASS[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)], [0]])
    out = np.zeros(n * n, np.int64)
    for i in range(0, len(classes) - 1, _STEP):
        x = classes[i : i + _STEP + 1].astype(np.int64)
        out += np.bincount(x[:-1] * n + x[1:], minlength=n * n)
    return out


class Markov:
    """Order-one model of ordinary runs, from the counts of their class pairs (0 is start and end)."""

    def __init__(self, pairs: Mapping[int, int]):
        n = len(_SYMBOLS) + 1
        counts = np.zeros(n * n)
        for k, v in pairs.items():
            counts[k] = v
        counts[0] = 0  # two separators in a row are no run
        counts = counts.reshape(n, n) + 0.5
        logs = np.log(counts / counts.sum(axis=1, keepdims=True))
        self.log = {a: {b: float(logs[i, j]) for j, b in enumerate("$" + _SYMBOLS)} for i, a in enumerate("^" + _SYMBOLS)}

    def log_likelihood(self, word: str) -> float:
        return sum(self.log[a].get(b, -10.0) for a, b in zip("^" + word, word + "$", strict=True))


class Grammars:
    def __init__(self, credentials: dict[str, list[str]], pairs: Mapping[int, int]):
        coded = {k: [w.translate(_CLASS) for w in v] for k, v in credentials.items() if v}
        # One credential in four of every kind is held out to set the threshold.
        self.automata = {k: Automaton([w for i, w in enumerate(v) if i % 4 or len(v) < 8]) for k, v in coded.items()}
        self.background = Markov(pairs)
        held = [w for v in coded.values() for i, w in enumerate(v) if i % 4 == 0 or len(v) < 8]
        # Those as long as a candidate count, if there are any.
        right = sorted(map(self.ratio, [w for w in held if len(w) >= MIN_CANDIDATE] or held))
        # Halfway between indifference and what 99 of 100 held-out credentials reach.
        self.threshold = max(MIN_RATIO, right[len(right) // 100] / 2) if right else math.inf

    def best(self, coded: str) -> tuple[float, str | None]:
        """(log-likelihood ratio per symbol, automaton it comes from) of a coded word."""
        if not self.automata or not coded:
            return -math.inf, None
        likely, name = max((a.log_likelihood(coded), k) for k, a in self.automata.items())
        return (likely - self.background.log_likelihood(coded)) / (len(coded) + 1), name

    def ratio(self, coded: str) -> float:
        return self.best(coded)[0]

    def judge(self, text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, float, str]]]:
        """(spans, scored candidates).

        Spans are (start, end, kind) by start, then kind as listed; learned
        ones may hold base ones, not lie within one. Candidates are (start,
        end, score, automaton) by place; without automata there are none.
        """
        base = base_spans(text)
        found = [(a, b, k) for a, b, k, _ in base]
        scored = {}
        if self.automata:
            for a, b, word in candidates(text):
                scored[a, b] = self.best(word.translate(_CLASS))
                if scored[a, b][0] >= self.threshold and not any(x <= a and b <= y for x, y, _ in found):
                    found.append((a, b, "learned"))
            for _, b, _, word in base:  # a credential ends where its span does
                scored.setdefault((b - len(word), b), self.best(word.translate(_CLASS)))
        return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1])), [(a, b, *scored[a, b]) for a, b in sorted(scored)]

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        return self.judge(text)[0]


def learn_grammars(docs: DataFrame, *, text: str = "text") -> Grammars:
    """Grammars from the credentials that the base patterns label in all texts, and the background of all texts.

    One pass: each task sends its credentials and, added up, the class pairs
    of everything else. The sample of a kind is its distinct values with the
    least hashes, so it does not depend on how rows are dealt out; longer
    ones than ``CREDENTIAL_CHARS`` are cut, none is left out. Null texts teach
    nothing; without credentials there are no automata and no learned spans.
    """

    def run(batches):
        pairs = np.zeros((len(_SYMBOLS) + 1) ** 2, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                kinds, values, rest = [], [], []
                for t in part.column(0).to_pylist():
                    if not t:
                        continue
                    spans = base_spans(t)
                    kinds += [k for _, _, k, _ in spans]
                    values += [v[:CREDENTIAL_CHARS] for *_, v in spans]
                    rest.append(blanked(t, spans, " ") if spans else t)
                pairs += transitions("\n".join(rest))
                yield pa.RecordBatch.from_pydict({"kind": pa.array(kinds, pa.string()), "value": pa.array(values, pa.string()), "n": pa.array([1] * len(kinds), pa.int64())})
        at = np.flatnonzero(pairs)
        yield pa.RecordBatch.from_pydict({"kind": pa.array(["pair"] * len(at), pa.string()), "value": pa.array([str(k) for k in at], pa.string()), "n": pa.array(pairs[at])})

    found = docs.select(F.col(text).alias("text")).mapInArrow(run, struct("kind string, value string, n long"))
    distinct = Workspace(docs.sparkSession, "secrets").save(found.groupBy("kind", "value").agg(F.sum("n").alias("n")), "found")
    credentials: dict[str, list[str]] = {}
    for kind in KINDS[:-1]:
        # Every task offers its least hashes: a kind never meets whole in one.
        rows = distinct.where(F.col("kind") == kind).orderBy(F.xxhash64("value"), "value").limit(SAMPLE_CREDENTIALS).collect()
        if rows:
            credentials[kind] = [r.value for r in rows]
    pairs = {int(r.value): r.n for r in distinct.where("kind = 'pair'").collect()}  # at most one a pair of classes
    return Grammars({k: sorted(v) for k, v in sorted(credentials.items())}, pairs)


def spans_text(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def scan_secrets(docs: DataFrame, grammars: Grammars, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_learned, scored), one row per input row.

    Offsets are code points, ends exclusive. ``scored`` lists every candidate
    (start, end, score, automaton), those inside base spans too. A null text
    is empty. Null ids and repeated rows stay; other columns are not read. An
    empty table gives an empty result.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(grammars)

    def prepare():
        g = shared.value

        def work(ids, texts):
            judged = [g.judge(t) if t else ([], []) for t in texts]
            spans = [own for own, _ in judged]
            base = [[s for s in own if s[2] != "learned"] for own in spans]
            counts = [[sum(s[2] == k for s in own) for own in base] for k in KINDS[:3]]
            return [ids, *counts, [hashlib.sha256(spans_text(b).encode()).hexdigest() for b in base], [spans_text(s) for s in spans], [sum(s[2] == "learned" for s in own) for own in spans], [[dict(zip(_SCORED, c, strict=True)) for c in own] for _, own in judged]]

        return work

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return map_rows(rows, struct(f"doc_id {id_type}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_learned long, scored array<struct<start:int,end:int,score:double,automaton:string>>"), prepare)


def blanked(text: str, spans: Iterable[tuple], mark: str) -> str:
    """The text with every span (start, end, ...), overlapping ones joined, replaced by ``mark``."""
    out, at = [], 0
    for a, b, *_ in sorted(spans, key=lambda s: s[:2]):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], mark]
        at = b
    return "".join([*out, text[at:]])


def redact(text: str | None, grammars: Grammars, mark: str = "[REDACTED]") -> str | None:
    """The text with every span replaced by ``mark``."""
    spans = grammars.spans(text) if text else []
    return blanked(text, spans, mark) if spans else text


def redact_secrets(docs: DataFrame, grammars: Grammars) -> DataFrame:
    """``docs`` with all columns, and every span in ``text`` replaced.

    Null and empty texts stay as they are, as do rows without a span, null
    ids, repeated rows and columns of any name. An empty table gives an empty
    result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(grammars)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                texts = pa.array([redact(t, shared.value) for t in part.column(at).to_pylist()], part.schema.field(at).type)
                yield part.set_column(at, part.schema.field(at), texts)

    return docs.mapInArrow(run, docs.schema)
