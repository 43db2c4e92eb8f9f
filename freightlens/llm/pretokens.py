"""Pre-tokens of a byte-level BPE tokenizer, and worker caches of their encodings.

The tokenizer splits a text at its special strings, then into pre-tokens, and encodes each pre-token
by itself, so the encoding of a text is the concatenation of encodings that can be cached. Texts with
characters whose class differs between Unicode versions or regex libraries are left to the tokenizer.
"""

from __future__ import annotations

import json
import os

import numpy as np
import regex

#: The split of the byte-level pre-tokenizer (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Characters of which every library thinks alike: tab to carriage return, printable ASCII, Latin to Cyrillic, punctuation, kana to ideographs.
UNUSUAL = r"[^\t-\r\x20-\x7E¡-ɏΑ-ΡΣ-ϿЀ-ҁҊ-ԯ‐-‧‰-⁞ぁ-ゖァ-ヺ一-龥가-힣]"

#: White space that a pre-token may share across a cut, and white space other than spaces and newlines.
JOINING = ("  ", " \n", "\n ", "\n\n", "\t", "\r", "\f", "\v")

#: The ASCII characters among those.
USUAL_ASCII = bytes([*range(9, 14), *range(32, 127)])

#: Marks a chunk without a leading space; no plain text holds this character.
FIRST = "\x02"

_LOADED: dict[str, PieceCache] = {}


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Where the tokenizer file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceCache:
    """Encodes texts by pre-tokens; at most `limit` pre-tokens are remembered beside the fixed table."""

    def __init__(self, path: str, limit: int = 400_000):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.special = [t["content"] for t in json.load(f)["added_tokens"]]
        self.split = regex.compile(PATTERN).findall
        self.unusual = regex.compile(UNUSUAL).search
        self.limit, self.known = limit, {}

    def ids(self, texts: list[str]) -> list[list[int]]:
        """The tokenizer's own encodings."""
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def plain(self, text: str) -> bool:
        odd = text.encode().translate(None, USUAL_ASCII) if text.isascii() else self.unusual(text)
        return not odd and not any(x in text for x in self.special)

    def chunks(self, text: str) -> list[str] | None:
        """The text cut before single spaces and newlines, or None where white space may join across cuts.

        A cut before a space or newline between other characters is a border of pre-tokens, so chunks can be
        encoded by themselves. The first chunk has no space of its own.
        """
        if text[0] in " \n" or text[-1] in " \n" or any(x in text for x in JOINING):
            return None
        first, *rest = text.replace("\n", " \n").split(" ")
        return [FIRST + first, *rest]

    def fill(self, every: set[str], make, join) -> None:
        """Let the cache know the chunks: a chunk's value joins make(ids) of its pre-tokens, which are cached, too."""
        known = self.known
        missing = every.difference(known)
        if missing and len(known) + 3 * len(missing) > self.limit:
            known.clear()
            missing = every
        split = {c: self.split(c[1:] if c[0] == FIRST else c if c[0] == "\n" else " " + c) for c in missing}
        parts = {p: chunk_of(p) for pieces in split.values() for p in pieces}
        for p, ids in zip(*self.encoded([p for p, c in parts.items() if c not in known])):
            known[parts[p]] = make(ids)
        for c, pieces in split.items():
            if len(pieces) > 1:
                known[c] = join([known[parts[p]] for p in pieces])

    def joined(self, chunks: list[str], make) -> bytes:
        """The values of the chunks one after the other."""
        self.fill(set(chunks), make, b"".join)
        return b"".join(map(self.known.__getitem__, chunks))

    def total(self, chunks: list[str], table: dict[str, int]) -> int:
        """How many ids the chunks have, by a fixed table and the cache for what it lacks."""
        values = list(map(table.get, chunks))
        if None not in values:
            return sum(values)
        self.fill({c for c, v in zip(chunks, values) if v is None}, len, sum)
        known = self.known
        return sum([known[c] if v is None else v for c, v in zip(chunks, values)])

    def cut(self, text: str) -> list[str]:
        """The chunks of a plain text: cut at spaces and newlines if it can be, else a chunk per pre-token."""
        return self.chunks(text) or list(map(chunk_of, self.split(text)))

    def encoded(self, pieces: list[str]) -> tuple[list[str], list]:
        """Pieces and their ids. Words with a leading space are encoded as one text, which splits as they do."""
        words = [p for p in pieces if p[:1] == " " and p[1:].isalpha()]
        others = [p for p in pieces if not (p[:1] == " " and p[1:].isalpha())]
        found = []
        if words:
            e = self.tokenizer.encode("".join(words), add_special_tokens=False)
            ids = e.ids
            cuts = [0, *(np.flatnonzero(np.diff(np.array(e.word_ids))) + 1).tolist(), len(ids)]
            if len(cuts) == len(words) + 1:
                found = [ids[i:j] for i, j in zip(cuts, cuts[1:])]
            else:
                words, others = [], pieces
        return words + others, found + self.ids(others)


def chunk_of(piece: str) -> str:
    """The chunk that holds just this pre-token."""
    if piece[0] == " " and not piece.isspace():
        return piece[1:]
    return piece if piece[0] == "\n" else FIRST + piece


def worker_cache(path: str, kind: str, limit: int = 400_000) -> PieceCache:
    """The cache of this worker process for one kind of value."""
    key = f"{path}:{kind}"
    if key not in _LOADED:
        _LOADED[key] = PieceCache(path, limit)
    return _LOADED[key]
