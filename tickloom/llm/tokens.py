"""Token ids of whole texts by the tokenizers library, with a memory of words.

Most of a tokenizer's time goes into words it has just seen. A text is cut where the
tokenizer's own rules always cut, pieces are looked up, and only new ones are encoded by the
library. Ids are those of encoding the whole text; `tests/llm/test_tokens.py` compares both.
Tokenizers whose rules are not known here get whole texts.
"""

from __future__ import annotations

import json
import os
import struct
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import islice

#: Marks after a word that no rule joins with letters. The apostrophe is left out: "'s" is a word.
MARKS = '.,!?&%$#*|;:)]}"'
#: Letters below are letters in every version of Unicode's tables ...
KNOWN_LETTERS = "\u0530"
#: ... and of these, those below stand for themselves in NFC and have one lower case wherever they are.
SIMPLE_LETTERS = "\u0370"
MEMORY = 200_000


def _byte_alphabet() -> list[str]:
    """Byte-level vocabularies write bytes that print as themselves, the rest from 256 upwards."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, spare = [], 256
    for b in range(256):
        out.append(chr(b if b in shown else spare))
        spare += b not in shown
    return out


class _NotApart(Exception):
    """A piece that does not stand alone, such as one beside a second space."""


class _Memory(dict):
    """Piece to ids as bytes. When it is full, pieces not met again until it is full once more are
    forgotten, so its size is bounded and common words stay."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.older = make, limit, {}

    def __missing__(self, piece: str) -> bytes:
        found = self.older.get(piece)
        if found is None:
            found = self.make(piece)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[piece] = found
        return found


_PACKS = [struct.Struct(f"<{n}I").pack for n in range(64)]


def _packed(ids: list[int]) -> bytes:
    return _PACKS[len(ids)](*ids) if len(ids) < 64 else struct.pack(f"<{len(ids)}I", *ids)


class WordEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids, without special tokens added."""

    def __init__(self, path: str, memory: int = MEMORY):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already fills the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.alphabet = dict(enumerate(_byte_alphabet()))
        with open(path, encoding="utf-8") as f:
            self.style = self._style(json.load(f))
        self.plain = _Memory(self._plain, memory)
        self.spaced = _Memory(self._spaced, memory)
        self.tails = _Memory(self._whole, memory)
        self.words = _Memory(self._letters, memory)

    @staticmethod
    def _style(spec: dict) -> str:
        """'spaces': byte level, a word takes the space before it. 'words': white space only parts."""
        if spec.get("truncation") or spec.get("padding") or spec["model"]["type"] != "BPE":
            return "whole"
        if any(t["lstrip"] or t["rstrip"] or " " in t["content"] for t in spec["added_tokens"]):
            return "whole"
        if spec["model"].get("dropout") or spec["model"].get("continuing_subword_prefix"):
            return "whole"
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
            return "spaces" if norm is None else "whole"
        steps = [s["type"] for s in pre.get("pretokenizers", [])]
        norms = [s["type"] for s in (norm or {}).get("normalizers", [])]
        if steps == ["Split", "ByteLevel"] and norms == ["NFC", "Replace", "Lowercase"]:
            split = pre["pretokenizers"][0]
            known = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
            if split["invert"] and split["behavior"] == "Removed" and split["pattern"] == {"Regex": known}:
                return "words"
        return "whole"

    def _whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _letters(self, word: str) -> bytes:
        """Ids of letters alone, or with the space before them."""
        if word.isascii():
            spelled = "Ġ" + word[1:] if word[0] == " " else word
        else:
            spelled = word.encode().decode("latin-1").translate(self.alphabet)
        return _packed([t.id for t in self.model.tokenize(spelled)])

    def _parts(self, piece: str, space: str) -> bytes:
        """Letters with marks behind them are two words of the tokenizer; all else is left to it."""
        word = piece.rstrip(MARKS)
        n = len(word)
        if word.isalpha() and (word.isascii() or max(word) < KNOWN_LETTERS):
            if self.style == "words":
                word = word.lower() if word.isascii() or max(word) < SIMPLE_LETTERS else self.tokenizer.normalizer.normalize_str(word)
                if not word.isalpha():
                    return self._whole(piece)
            ids = self.words[space + word if space else word]
            return ids if n == len(piece) else ids + self.tails[piece[n:]]
        return self._whole(space + piece)

    def _plain(self, piece: str) -> bytes:
        if not piece and self.style == "words":
            return b""
        if self.style == "spaces" and (not piece or piece[0].isspace() or piece[-1].isspace()):
            raise _NotApart
        return self._parts(piece, "")

    def _spaced(self, piece: str) -> bytes:
        if not piece or piece[0].isspace() or piece[-1].isspace():
            raise _NotApart
        return self._parts(piece, " ")

    def _line(self, line: str) -> bytes:
        first, *rest = line.split(" ")
        try:
            return self.plain[first] + b"".join(map(self.spaced.__getitem__, rest))
        except _NotApart:
            return self._whole(line)

    def forget(self, but: int = 0) -> None:
        """Drop all words but so many of each memory, those met first since it was last full."""
        for memory in (self.plain, self.spaced, self.tails, self.words):
            kept = dict(islice(memory.items(), but))
            memory.clear()
            memory.update(kept)
            memory.older = {}

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.style == "words":
            if "<|" not in text:  # else lower case may spell a special token
                text = text.encode().lower().decode()
            return b"".join(map(self.plain.__getitem__, text.replace("\n", " ").split(" ")))
        if self.style == "whole":
            return self._whole(text)
        lines, parts = text.split("\n"), []
        held = lines[0]
        for line in lines[1:]:
            # a single break between two characters that are not white space is a word of its own
            if held and line and not (held[-1].isspace() or line[0].isspace()):
                parts += [self._line(held), self.tails["\n"]]
                held = line
            else:
                held += "\n" + line
        parts.append(self._line(held))
        return b"".join(parts)


_ENCODERS: dict[str, WordEncoder] = {}


@contextmanager
def encoder(path: str, kept: int = 0) -> Iterator[WordEncoder]:
    """The file's encoder for a task. Its words are forgotten afterwards, as workers live on, but for `kept` of each kind."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    try:
        yield _ENCODERS[path]
    finally:
        _ENCODERS[path].forget(kept)
