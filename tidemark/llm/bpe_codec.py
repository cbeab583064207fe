"""BPE encoding by per-prefix dynamic programming, and decoding.

Every prefix of a word has exactly one last token. An automaton lists the
vocabulary tokens that end at each position; the longest whose predecessor
(the last token of the prefix before it) makes a compatible pair with it is
that last token, and back-pointers from the end give the ids. A pair is
compatible if encoding the two tokens' joint text splits it just there: no
merge that BPE would have made earlier crosses the seam.

Words of the vocabulary's kind end in a marker; a word's last character and
the marker form one symbol. A worker remembers words within a bound.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import struct as _struct

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import pretokens
from tidemark.llm.textops import Remembered, map_rows, struct

#: Words and token pairs that a worker remembers.
WORD_CACHE = 600_000
PAIR_CACHE = 1_000_000
_MARK = "</w>"
#: Where the symbols "last character plus marker" are placed in the automaton's alphabet.
_ENDS_AT = 0xE000
_PLAIN = re.compile("[^\x00-į]")


def _symbols(token: str) -> str:
    if token.endswith(_MARK) and len(token) > len(_MARK):
        body = token[: -len(_MARK)]
        return body[:-1] + chr(_ENDS_AT + ord(body[-1]))
    return token


def byte_alphabet() -> dict[int, str]:
    """byte -> printable character, the byte-level alphabet: printable Latin-1 stands for itself, the rest follow 255 in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


class PrefixEncoder:
    """The dynamic program for one vocabulary (a tokenizers JSON file of kind BPE with end-of-word suffix)."""

    def __init__(self, file: str):
        with open(file, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab: dict[str, int] = model["vocab"]
        self.names: dict[int, str] = {i: t for t, i in vocab.items()}
        self.automaton = ahocorasick.Automaton()
        self.rank: dict[int, int] = {}  # of the merge that makes a token; base symbols have none
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}  # pair -> rank
        for order, (a, b) in enumerate(tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]):
            left, right, made = vocab[a], vocab[b], vocab[a + b]
            self.merged[left, right] = order
            if made not in self.parts:
                self.parts[made], self.rank[made] = (left, right), order
        self._pairs: dict[tuple[int, int], bool] = {}
        self.words = Remembered(self.packed, WORD_CACHE)
        self._alphabet = byte_alphabet()
        for token, i in vocab.items():
            if self.reachable(i):
                s = _symbols(token)
                self.automaton.add_word(s, (len(s), i))
        self.automaton.make_automaton()

    def reachable(self, token: int) -> bool:
        """Whether BPE encodes the token's own text as this token: its two parts meet and nothing merges across them sooner."""
        if token not in self.parts:
            return len(_symbols(self.names[token])) == 1
        a, b = self.parts[token]
        return self.reachable(a) and self.reachable(b) and self._seam_holds(a, b, self.rank[token])

    def _seam_holds(self, left: int, right: int, until: int) -> bool:
        """Whether no merge of a rank below ``until`` crosses the seam while both sides are built up.

        Both sides are undone in reverse order of their merges, which leaves
        at each moment the two tokens that touched the seam then; ``until``
        falls to the rank of the merge just undone: a crossing merge must
        have come before that to win. On equal ranks the leftmost merge wins.
        """
        rank, parts = self.rank, self.parts
        while True:
            crossing = self.merged.get((left, right))
            if crossing is not None and crossing < until:
                return False
            a, b = rank.get(left, -1), rank.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a > b:
                until, left = a, parts[left][1]
            else:
                # A merge at the seam with the same rank lies further left, and so comes first.
                until, right = b + 1, parts[right][0]

    def compatible(self, left: int, right: int) -> bool:
        found = self._pairs.get((left, right))
        if found is None:
            if len(self._pairs) >= PAIR_CACHE:
                self._pairs.clear()
            found = self._pairs[left, right] = self._seam_holds(left, right, 1 << 60)
        return found

    def encode_symbols(self, symbols: str) -> list[int]:
        """Ids of one word, given as symbols."""
        last = [-1] * len(symbols)
        size = [0] * len(symbols)
        done = -1
        pairs, compatible = self._pairs, self.compatible
        for end, (length, token) in self.automaton.iter(symbols):
            if end == done:
                continue  # its last token is found; shorter matches follow
            before = end - length
            if before >= 0:
                previous = last[before]
                if previous < 0:
                    continue
                ok = pairs.get((previous, token))
                if not (compatible(previous, token) if ok is None else ok):
                    continue
            last[end], size[end], done = token, length, end
        out = []
        at = len(symbols) - 1
        while at >= 0:
            if last[at] < 0:
                raise ValueError("a prefix has no last token")
            out.append(last[at])
            at -= size[at]
        return out[::-1]

    def encode_word(self, word: str) -> list[int]:
        """Ids of one pre-token of plain characters."""
        chars = word if word.isascii() and word.isprintable() and " " not in word else "".join(self._alphabet[b] for b in word.encode())
        return self.encode_symbols(chars[:-1] + chr(_ENDS_AT + ord(chars[-1])))

    def packed(self, word: str) -> tuple[bytes, str]:
        """(ids as little-endian 32-bit integers, token strings joined by spaces)."""
        ids = self.encode_word(word)
        return _struct.pack(f"<{len(ids)}I", *ids), " ".join(map(self.names.__getitem__, ids))


class BpeCodec:
    """Encoding and decoding of whole texts as the tokenizers library does, without special tokens added."""

    def __init__(self, tokenizer: str):
        file = tokenizer if "/" in tokenizer else pretokens.path(tokenizer)
        self.library = pretokens.load(file)  # its normaliser and splitter serve rare characters
        self.encoder = PrefixEncoder(file)
        self.special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self._cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")

    def normalise(self, text: str) -> str:
        """Composed and in lower case; all white space separates words alike, so it can stay."""
        if text.isascii() or _PLAIN.search(text) is None:
            return text.lower()
        return self.library.normalizer.normalize_str(text)

    def encode_packed(self, text: str) -> tuple[bytes, str]:
        """(ids as little-endian 32-bit integers, decoded text)."""
        ids, shown = [], []
        for k, part in enumerate(self._cut.split(text)):
            if k % 2:
                ids.append(_struct.pack("<I", self.special[part]))
                shown.append(part)
            elif part:
                words = pretokens.word_bpe_pretokens(self.normalise(part), self.library)
                if words:
                    a, b = zip(*map(self.encoder.words.__getitem__, words), strict=True)
                    ids.extend(a)
                    shown.extend(b)
        return b"".join(ids), " ".join(shown)

    def encode(self, text: str) -> list[int]:
        packed = self.encode_packed(text)[0]
        return list(_struct.unpack(f"<{len(packed) // 4}I", packed))

    def decode(self, ids: list[int]) -> str:
        """The tokens' strings joined by spaces; unknown ids are passed over."""
        special = {i: t for t, i in self.special.items()}
        names = (special.get(i, self.encoder.names.get(i)) for i in ids)
        return " ".join(n for n in names if n is not None)


@functools.lru_cache(maxsize=2)
def worker_codec(tokenizer: str) -> BpeCodec:
    """One codec per worker process, so that tasks share what it remembers."""
    return BpeCodec(tokenizer)


def bpe_encode(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", tokenizer: str = "word_bpe_49k.json") -> DataFrame:
    """(doc_id, ids array<int>, decoded string), one row per input row.

    A null or empty text has no ids and decodes to an empty text. Null ids
    and repeated rows stay as they are; other columns are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def prepare():
        codec = worker_codec(tokenizer)

        def work(ids, texts):
            packed = [codec.encode_packed(t or "") for t in texts]
            return [ids, [list(_struct.unpack(f"<{len(a) // 4}I", a)) for a, _ in packed], [b for _, b in packed]]

        return work

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return map_rows(rows, struct(f"doc_id {id_type}, ids array<int>, decoded string"), prepare)


def bpe_digests(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", tokenizer: str = "word_bpe_49k.json") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): what :func:`bpe_encode` gives, digested where it is made.

    One row per input row: a null text is empty, null ids and repeated rows
    stay, texts may be of any length, other columns are not read. An empty
    table gives an empty result.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def prepare():
        codec = worker_codec(tokenizer)

        def work(ids, texts):
            counts, of_ids, of_text = [], [], []
            for t in texts:
                packed, decoded = codec.encode_packed(t or "")
                counts.append(len(packed) // 4)
                of_ids.append(hashlib.sha256(packed).hexdigest())
                of_text.append(hashlib.sha256(decoded.encode()).hexdigest())
            return [ids, counts, of_ids, of_text]

        return work

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return map_rows(rows, struct(f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"), prepare)
