"""Pre-token splitting for the byte-level BPE files, exactly as the tokenizers library splits."""

from __future__ import annotations

import base64
import functools
import itertools
import re

import numpy as np
import regex

#: Code points on which the ``regex`` module and the library are known to agree; the
#: library's own splitter handles texts with any other (they differ only in which
#: Unicode version names the youngest letters and numbers).
_OTHER = re.compile("[^\x00-՗ऀ-௿฀-๿Ḁ-῿‐-‧₠-₿　-鿿가-힣]")

# Fixed values of the tokenizer files: their splitting patterns and special tokens.
BYTE_BPE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_BPE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
END_OF_TEXT = "<|endoftext|>"
START_OF_TEXT = "<|startoftext|>"

#: Characters from which a text is split here and encoded piece by piece: the rank
#: encoder's own splitter overflows its stack on about a million white-space characters in a row.
LONG_TEXT = 65_536

_BYTE_SPLIT = regex.compile(BYTE_BPE_SPLIT)
_WORD_SPLIT = regex.compile(WORD_BPE_SPLIT)


def known(text: str) -> bool:
    return text.isascii() or _OTHER.search(text) is None


def byte_bpe_pretokens(text: str, tokenizer) -> list[str]:
    if known(text):
        return _BYTE_SPLIT.findall(text)
    return [text[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(text)]


def word_bpe_pretokens(text: str, tokenizer) -> list[str]:
    """Pre-tokens of a normalised text, in plain characters."""
    if known(text):
        return _WORD_SPLIT.findall(text)
    return [text[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(text)]


def path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=4)
def load(name_or_path: str):
    """A Tokenizer without truncation or padding, from a vocabulary name or a path."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(name_or_path if "/" in name_or_path else path(name_or_path))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@functools.lru_cache(maxsize=4)
def load_ranks(name_or_path: str):
    """The same byte-level vocabulary as an encoder that works on ranks, without special tokens."""
    import tiktoken

    with open(name_or_path if "/" in name_or_path else path(name_or_path), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=BYTE_BPE_SPLIT, mergeable_ranks=ranks, special_tokens={})


class RankEncoder:
    """Ids of the byte-level vocabulary by its ranks, for texts and pre-tokens of any length."""

    def __init__(self, ranks: str, tokenizer: str):
        self._encoding = load_ranks(ranks)
        self._piece = self._encoding._core_bpe.encode_single_piece
        self._library = load(tokenizer)
        self._special = [t.content for t in self._library.get_added_tokens_decoder().values()]

    def piece(self, pretoken: str) -> list[int]:
        """Ids of one pre-token; nothing is split, so its length does not matter."""
        return self._piece(pretoken.encode())

    def holds_special(self, text: str) -> bool:
        return any(s in text for s in self._special)

    def text(self, text: str) -> np.ndarray:
        """Ids of a whole text; one with a special token's string is encoded by the library itself."""
        if self.holds_special(text):
            return np.array(self._library.encode(text, add_special_tokens=False).ids, dtype="<u4")
        if len(text) < LONG_TEXT:
            return np.asarray(self._encoding.encode_to_numpy(text, disallowed_special=()), dtype="<u4")
        return np.fromiter(itertools.chain.from_iterable(map(self.piece, self.pretokens(text))), dtype="<u4")

    def pretokens(self, text: str) -> list[str]:
        return byte_bpe_pretokens(text, self._library)

    def count_special(self, text: str) -> int:
        return len(self._library.encode(text, add_special_tokens=False).ids)
