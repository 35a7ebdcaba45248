"""Token ids by a vocabulary of the tokenizers library, with bounded caches of the parts of texts."""

from __future__ import annotations

import json
import os
import re
import struct
import threading
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np

#: White space in Python's eyes or in the vocabulary's pattern, but not in both.
ODD_SPACE = "\x1c\x1d\x1e\x1f\x85\u180e"
PIECE = re.compile(r"\s+\S+|\S+|\s+")
#: A run of letters, then a run of marks that can't begin a contraction: two units of the vocabulary's pattern.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ɏ]+)([!-&(-/:-@\[-`{-~]*)")


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write bytes with: printable ones as they are, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Words(dict):
    """word -> id bytes of ``lead`` and the word, worked out by the library's model on the first sight of each run of letters."""

    def __init__(self, encoder: Encoder, lead: str):
        self.encoder, self.lead = encoder, lead

    def __missing__(self, word: str) -> bytes:
        if word.isalpha():  # letters of every script, as the pattern has them
            raw = self[word] = self.encoder.unit(self.lead, word)
            return raw
        plain = PLAIN.fullmatch(word)
        if plain is None:
            parts = word.split("\n")
            if len(parts) > 1 and all(parts) and len(word.split()) == len(parts):  # single line ends inside, and no other space
                bare = self.encoder.bare
                return self[parts[0]] + b"".join([self.encoder.newline + bare[p] for p in parts[1:]])
            raw = self.encoder.whole([self.lead + word])[0]
        else:
            raw = self[plain[1]] + self.encoder.marks[plain[2]]
        self[word] = raw
        return raw


class Marks(Words):
    def __missing__(self, word: str) -> bytes:
        raw = self[word] = self.encoder.whole([word])[0]
        return raw


class Encoder:
    """Whole-text ids as little-endian bytes of ``width`` bytes an id, equal to the library's own.

    A byte-level BPE whose pattern never lets a unit run from a non-space into white space, nor from a letter
    into a mark, gives the same ids for a text as for its parts, so each part is encoded once by the library
    and kept in caches of at most ``bound`` parts. Texts that hold special tokens or odd white space, and
    vocabularies of another kind, are encoded whole.
    """

    def __init__(self, spec: str, bound: int = 800_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        self.tokenize = self.library.model.tokenize
        plan = json.loads(spec)
        before, model = plan.get("pre_tokenizer") or {}, plan["model"]
        odd = any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        self.by_part = model["type"] == "BPE" and not odd and plan.get("normalizer") is None and before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
        self.whole_if = [*ODD_SPACE, *(t["content"] for t in plan.get("added_tokens", []))]
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.letters = _byte_letters()
        self.space = self.letters[32]
        self.packers = [struct.Struct(f"<{n}{'H' if self.dtype.itemsize == 2 else 'I'}").pack for n in range(16)]
        self.bound = bound
        self.spaced, self.bare, self.marks = Words(self, " "), Words(self, ""), Marks(self, "")
        if self.by_part:
            self.newline = self.whole(["\n"])[0]

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def unit(self, lead: str, word: str) -> bytes:
        """One unit of the pattern, straight through the library's model."""
        coded = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        ids = [t.id for t in self.tokenize(self.space + coded if lead else coded)]
        return self.packers[len(ids)](*ids) if len(ids) < len(self.packers) else np.array(ids, self.dtype).tobytes()

    def _by_part(self, text: str) -> bytes:
        if "  " in text:
            return b"".join([self.spaced[p[1:]] if p[0] == " " and not p[1:2].isspace() and len(p) > 1 else self.marks[p] if p[0].isspace() else self.bare[p] for p in PIECE.findall(text)])
        first, *rest = text.split(" ")
        head = self.bare[first] if first else b""
        return head + b"".join(map(self.spaced.__getitem__, rest))

    def clear(self) -> None:
        for cache in (self.spaced, self.bare, self.marks):
            cache.clear()

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.spaced) + len(self.bare) + len(self.marks) > self.bound:
            self.clear()
        out = []
        for text in texts:
            if self.by_part and not any(s in text for s in self.whole_if):
                out.append(self._by_part(text))
            else:
                out += self.whole([text])
        return out


_SHARED: dict[str, Encoder] = {}
_CLEARING: list[threading.Timer] = []
#: Seconds after which a Python worker that encodes nothing lets go of what it has learnt.
IDLE = 8.0


@contextmanager
def shared_encoder(spec: str) -> Iterator[Encoder]:
    """One encoder for all tasks of a Python worker, so that a task needn't learn again what the last one knew.

    Workers live on after their tasks; the caches don't, once they are idle.
    """
    while _CLEARING:
        _CLEARING.pop().cancel()
    encoder = _SHARED.get(spec)
    if encoder is None:
        _SHARED.clear()
        encoder = _SHARED[spec] = Encoder(spec)
    try:
        yield encoder
    finally:
        timer = threading.Timer(IDLE, encoder.clear)
        timer.daemon = True
        _CLEARING.append(timer)
        timer.start()


def text_groups(texts: list[str], most: int = 2_000_000):
    """Slices of a batch of about ``most`` characters, so that what is kept at a time is bounded."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) + 64
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
