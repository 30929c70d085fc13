"""Byte-level BPE ids of whole texts, as little-endian unsigned 32-bit bytes.

Ids equal those of the ``tokenizers`` library for the vocabulary file; the bulk of the work is done by
``tiktoken`` on the same ranks with a bounded cache of space-separated chunks. A single space between two
non-space characters always starts a new pre-token, so such chunks are encoded independently. Texts that
hold a special token and chunks of more than ``_LONG`` characters go through ``tokenizers`` itself.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator

import tiktoken
from tokenizers import Tokenizer

_LOOSE = re.compile(r" \s|\s ")
_BETWEEN_WORDS = re.compile(r"(?<=\S) (?=\S)")
_SLICE = 1 << 20
_MOST_CHUNKS = 300_000
_LONG = 10_000
_ENCODERS: dict[str, Encoder] = {}


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level BPE vocabularies: printable Latin-1 stands for itself, the rest from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class _Chunks(dict):
    """Chunk after a space -> its ids as bytes; emptied when full, so its memory is bounded."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, chunk: str) -> bytes:
        ids = self.encode(" " + chunk)
        if len(self) >= _MOST_CHUNKS:
            self.clear()
        if len(chunk) <= 64:
            self[chunk] = ids
        return ids


class Encoder:
    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        pre = spec["pre_tokenizer"]
        if spec["model"]["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or spec["normalizer"]:
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        special = [t["content"] for t in spec["added_tokens"]]
        alphabet = byte_alphabet()
        ranks = {bytes(alphabet[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        from public_tokenizers import PATTERN
        self.bpe = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.exact = Tokenizer.from_file(path)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.chunks = _Chunks(self._encode)

    def _encode(self, text: str) -> bytes:
        # tiktoken's pattern search runs out of stack on very long runs of one kind
        ids = self.bpe.encode_ordinary(text) if len(text) <= _LONG else self.exact.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _slices(self, text: str) -> Iterator[str]:
        """Long texts in slices that start at a single space between words."""
        start = 0
        while len(text) - start > _SLICE:
            m = _BETWEEN_WORDS.search(text, start + _SLICE)
            if m is None:
                break
            yield text[start:m.start()]
            start = m.start()
        yield text[start:]

    def encode(self, text: str) -> bytes:
        """Ids of the whole text, four bytes each."""
        if self.special and self.special.search(text):
            ids = self.exact.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        out, seek = [], self.chunks.__getitem__
        for k, piece in enumerate(self._slices(text)):
            chunks = _BETWEEN_WORDS.split(piece) if _LOOSE.search(piece) or piece[-1:] == " " else piece.split(" ")
            if k == 0 or chunks[0]:  # the text's own beginning, or a slice whose first word kept its space
                out.append(self._encode(chunks[0]))
            out.extend(map(seek, chunks[1:]))
        return b"".join(out)


def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
