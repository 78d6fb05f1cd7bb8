"""Exact, fast whole-text encoding with public tokenizers.

A text is cut where the tokenizer cuts in any case (at white space), each
distinct chunk is encoded once by the tokenizers library, and the ids are put
together again. The result equals that of encoding the text in one call.

A chunk of Latin letters is one word to a byte-level tokenizer, so it goes
straight to the library's model, as the characters that stand for its bytes;
whether that gives the same ids is tried on PROBES when a tokenizer is loaded,
and left out where it does not.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np

#: Chunks that a worker remembers, twice over at most (about 200 bytes each), so its memory is bounded.
REMEMBERED = 350_000
#: Text bytes that are encoded together.
PIECE_BYTES = 2 << 20
#: White_Space of Unicode, which the tokenizers' patterns call \s.
_WS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: A run of letters that ends for certain where it is cut: before white space or ASCII punctuation but the apostrophe.
_LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]++(?=[ \\n.,;:!?#$%&*|()])"
_BYTE_CHUNKS = re.compile(f" ?{_LETTERS}| ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
_WORD_CHUNKS = re.compile(f"{_LETTERS}|[^ \\n]+")


_LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch
PROBES = ["a", "A", "the", "The", "THE", "Straße", "ÉÈÀ", "señorita", "Ünïcödé", "xqzj", "IT", "ÿþ", "internationalization", "Antidisestablishmentarianism", "dont", "aaaaaaaaaaaaaaaaaaaa", "Æther", "ð", "øre", "ciónes"]


def _byte_characters() -> dict[int, str]:
    """The letters and the space as byte-level tokenizers spell them: a byte that is a visible Latin-1 character stands for itself, the others for those from 256 on in order."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in visible]
    spelled = {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(others)}
    return {c: "".join(spelled[b] for b in chr(c).encode()) for c in (32, *range(0xC0, 0x100))}


_BYTES = _byte_characters()
_SPACE = _BYTES[32]


def byte_level_chunks(text: str) -> list[str]:
    """For byte-level BPE, which joins at most one space with what follows it."""
    return _BYTE_CHUNKS.findall(text)


def word_chunks(text: str) -> list[str]:
    """For tokenizers that drop white space."""
    return _WORD_CHUNKS.findall(text)


class Encoder:
    """encode_all(texts) -> ids of each (uint16 or uint32 by the vocabulary's size), no special tokens added."""

    def __init__(self, path: str, chunks):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.chunks = Tokenizer.from_file(path), chunks
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        # strings that the tokenizer finds in a text before anything else
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = re.compile(f"({'|'.join(re.escape(v.content) for v in added.values())})") if added else None
        # what parts chunks that are encoded together: a bar between lines, where white space is dropped, else a special string
        if chunks is word_chunks:
            self.between, self.apart = "\n|\n", self.tokenizer.encode("|", add_special_tokens=False).ids[0]
        else:
            self.apart, self.between = next(((k, v.content) for k, v in added.items()), (None, None))
        self.single = re.compile("|".join(re.escape(x) for x in {self.between.strip(), *(v.content for v in added.values())})) if self.between else None
        self.found = [v.content for v in added.values()]
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.model, self.code = self.tokenizer.model, "H" if self.dtype.itemsize == 2 else "I"
        self.fold = next((f for f in (str, str.lower) if self._agrees(f)), None)

    def _words(self, chunks: list[str], fold, rest: list[str]) -> Iterator[tuple[str, bytes]]:
        """The ids of chunks of Latin letters, with or without a space before them, by the model alone; the others go to rest."""
        tokenize, code = self.model.tokenize, self.code
        for x in chunks:
            word = x[1:] if x[0] == " " else x
            if not word.isalpha() or not (word.isascii() or _LATIN(word)):
                rest.append(x)
                continue
            spelled = fold(word)
            spelled = spelled if spelled.isascii() else spelled.translate(_BYTES)
            yield x, array(code, [t.id for t in tokenize(spelled if word is x else _SPACE + spelled)]).tobytes()

    def _agrees(self, fold) -> bool:
        """Whether the model alone gives the ids of PROBES, as they are or folded; a special string of letters rules it out."""
        if any(_LATIN(x) for x in self.found):
            return False
        probes = PROBES if self.chunks is word_chunks else [*PROBES, *(" " + x for x in PROBES)]
        whole = self.tokenizer.encode_batch(probes, add_special_tokens=False)
        found = dict(self._words(probes, fold, []))
        return all(found.get(x) == np.array(e.ids, self.dtype).tobytes() for x, e in zip(probes, whole, strict=True))

    def _encoded(self, chunks: list[str]) -> Iterator[tuple[str, bytes]]:
        if self.fold:
            rest: list[str] = []
            yield from self._words(chunks, self.fold, rest)
            chunks = rest
        encode = lambda x: self.tokenizer.encode_batch_fast(x, add_special_tokens=False)
        alone = chunks if self.single is None else [x for x in chunks if self.single.search(x)]
        yield from ((x, np.array(e.ids, self.dtype).tobytes()) for x, e in zip(alone, encode(alone), strict=True))
        rest = [] if self.single is None else [x for x in chunks if not self.single.search(x)]
        for k in range(0, len(rest), 128):
            some = rest[k : k + 128]
            ids = np.array(encode([self.between.join(some)])[0].ids, self.dtype)
            ends = np.append(np.flatnonzero(ids == self.apart), len(ids))
            raw, w = ids.tobytes(), self.dtype.itemsize
            starts = np.append(0, ends[:-1] + 1)
            yield from ((x, raw[a:b]) for x, a, b in zip(some, (starts * w).tolist(), (ends * w).tolist(), strict=True))

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        cut = [[c for s in self.special.split(t) for c in self.chunks(s)] if any(x in t for x in self.found) else self.chunks(t) for t in texts]
        known = self.young
        needed = set().union(*cut).difference(known)
        if len(self.young) + len(needed) > REMEMBERED:  # what is still in use moves on from the older half
            self.old, self.young = self.young, {}
            needed = set().union(*cut)
        again = needed & self.old.keys()
        self.young.update((x, self.old[x]) for x in again)
        self.young.update(self._encoded(list(needed - again)))
        found = self.young.__getitem__
        return [np.frombuffer(b"".join(map(found, c)), self.dtype) for c in cut]

    def rest(self) -> None:
        """At the end of a task: the older half goes, as the worker's next task may be another's."""
        self.old = {}


_LOADED: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, kind: str) -> Encoder:
    """One for each worker process. kind: "byte" or "word"."""
    if (path, kind) not in _LOADED:
        _LOADED[path, kind] = Encoder(path, byte_level_chunks if kind == "byte" else word_chunks)
    return _LOADED[path, kind]
