"""Token ids of whole texts by a public byte-level BPE vocabulary, inside tasks.

Byte-level pre-tokenisation never joins a space to the characters before it, so
a text may be cut before every space that follows a non-space character, each
part encoded by itself by the tokenizers library, and the ids strung together.
A worker keeps the ids of parts it has met: a dictionary of at most
``CACHE_PARTS`` entries, emptied when full, whatever the input. A Latin word
is one pre-token and goes to the library's BPE model directly, which skips the
alignment work of a full encoding.
"""

from __future__ import annotations

import os
import re
import struct

import numpy as np

from larch.llm.common import claim_memory

CACHE_PARTS = 1_000_000
#: Longer parts are encoded each time.
CACHED_CHARS = 48
#: The same where memory is short (the pipeline), and signs behind a word.
WORDS = 250_000
SIGNS, SIGN_RUN = ".,;:!?#*$%&", 3
#: First code point after the Latin letter blocks.
LATIN_END = "\u0250"
_SPACED = re.compile(r"(?<!\s) ")
_WIDE_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000] ")
_SPACE_PAIRS = tuple(c + " " for c in " \n\t\r\x0b\x0c\x1c\x1d\x1e\x1f")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where this machine keeps the public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size()


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes byte values as printable characters: printable
    Latin-1 stands for itself, the rest follow from U+0100 on in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Parts(dict):
    """Part after a space -> its ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str) -> None:
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.space = self.letters[32]
        self.marks = {c: self.whole(c) for c in ".,"}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def __missing__(self, part: str) -> bytes:
        if part and part[-1] in self.marks and (stem := part[:-1]).isalpha() and max(stem) < LATIN_END:
            ids = self[stem] + self.marks[part[-1]]
        elif part.isalpha() and max(part) < LATIN_END:
            letters = self.space + part.encode().decode("latin-1").translate(self.letters)
            ids = np.array([t.id for t in self.model.tokenize(letters)], dtype="<u4").tobytes()
        else:
            ids = self.whole(" " + part)
        if len(part) <= CACHED_CHARS:
            if len(self) >= CACHE_PARTS:
                self.clear()
            self[part] = ids
        return ids


class _Words(_Parts):
    """Keeps Latin words and odd parts only, in two dictionaries of ``WORDS`` at most: less
    memory for more time. Signs and line breaks behind words are pre-tokens of their own."""

    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.older: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        self.newline = self.whole("\n")

    def __missing__(self, part: str) -> bytes:
        ids = self.older.get(part)
        if ids is None:
            joined = self.joined(part)
            if joined is not None:
                return joined
            ids = self.letters_ids(self.space, part) if _latin(part) else self.whole(" " + part)
        if len(part) <= CACHED_CHARS:
            if len(self) >= WORDS:
                self.older = dict(self)
                self.clear()
            self[part] = ids
        return ids

    def joined(self, part: str) -> bytes | None:
        """The ids of a word and the signs behind it, or of what a line ends and the next
        begins with, from those of its pre-tokens; None for other parts."""
        end, newline, begin = part.partition("\n")
        if newline:
            if not end or end[-1].isspace() or (stem := begin.rstrip(SIGNS)) and not _latin(stem) or not begin:
                return None
            return self[end] + self.newline + (self.letters_ids("", stem) if stem else b"") + self.signs(begin[len(stem):])
        stem = part.rstrip(SIGNS)
        return self[stem] + self.signs(part[len(stem):]) if len(stem) < len(part) and _latin(stem) else None

    def signs(self, run: str) -> bytes:
        if not run:
            return b""
        ids = self.marks.get(run)
        if ids is None:
            ids = self.whole(run)
            if len(run) <= SIGN_RUN:
                self.marks[run] = ids
        return ids

    def letters_ids(self, before: str, word: str) -> bytes:
        letters = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        ids = [t.id for t in self.model.tokenize(before + letters)]
        return struct.pack(f"<{len(ids)}I", *ids)


def _latin(part: str) -> bool:
    return part.isalpha() and (part.isascii() or max(part) < LATIN_END)


_ENCODERS: dict[tuple[str, bool], _Parts] = {}


def encode_bytes(text: str | None, path: str, lean: bool = False) -> bytes:
    """The ids of ``text`` (null: empty), 4 bytes each."""
    if not text:
        return b""
    parts_of = _ENCODERS.get((path, lean))
    if parts_of is None:
        claim_memory("tokens", _ENCODERS.clear)
        parts_of = _ENCODERS[path, lean] = (_Words if lean else _Parts)(path)
    spaced = any(p in text for p in _SPACE_PAIRS) or (not text.isascii() and _WIDE_SPACE.search(text))
    first, *rest = _SPACED.split(text) if spaced else text.split(" ")
    head = parts_of.whole(first) if first else b""
    return head + b"".join(map(parts_of.__getitem__, rest)) if rest else head
