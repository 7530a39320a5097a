"""Byte-level BPE of the ``tokenizers`` library behind a cache of pre-tokens.

The library's pre-tokenizer and model work on pre-tokens alone, so equal pre-tokens always give
equal ids. Texts are split by the same pattern here, seen pre-tokens come from a bounded cache, and
only new ones go through the library's merges. The whole-token table is proven offline: a
vocabulary string is in it only if the library encodes it, alone, as that one token.

A space between two characters that aren't white space always begins a pre-token, and a line feed
there is one, so texts are cut at these first and whole chunks come from the cache too. Texts with
white space beside a space or line feed are cut into pre-tokens instead. Texts that contain an added
token's string, and stretches with characters for which this module's pattern isn't proven equal to
the library's, are encoded by the library.
"""

from __future__ import annotations

import json
import os
import re
import struct

#: Chunks and pre-tokens kept per worker; a cache starts anew when it is full.
CACHE_SIZE = 400_000
#: Longer chunks and pre-tokens aren't kept, so the caches are bounded in bytes too.
LONGEST_KEPT = 64


def _byte_chars() -> list[str]:
    """The printable character that byte-level BPE writes for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    odd = {b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)) - set(plain)))}
    return [odd.get(b, chr(b)) for b in range(256)]


def _letters(top: int) -> str:
    import regex

    return "".join(c for c in map(chr, range(128, top)) if regex.match(r"\p{L}", c))


def _as_class(chars: str) -> str:
    """The inside of a character class, as ranges."""
    points, out = sorted(map(ord, chars)), []
    for p in points:
        if out and out[-1][1] == p - 1:
            out[-1][1] = p
        else:
            out.append([p, p])
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in out)


def _patterns() -> tuple[re.Pattern, re.Pattern]:
    """The pre-tokens of texts below U+0250, and what lies beyond that."""
    import regex

    top = 0x250
    letter = "A-Za-z" + _as_class(_letters(top))
    digit = "0-9" + _as_class("".join(c for c in map(chr, range(128, top)) if regex.match(r"\p{N}", c)))
    space = "\\t-\\r \\x85\\xa0"
    tokens = re.compile(f"'(?:s|t|re|ve|m|ll|d)| ?[{letter}]+| ?[{digit}]+| ?[^{space}{letter}{digit}]+|[{space}]+(?![^{space}])|[{space}]+")
    return tokens, re.compile(f"[^\\x00-\\u{top - 1:04x}\\u2010-\\u2027\\u20ac]|[\\x1c-\\x1f]")


class PretokenEncoder:
    """Ids or counts of whole texts, equal to the library's encoding without added special tokens."""

    def __init__(self, path: str, value, add, whole: dict[str, int] | None = None) -> None:
        """``value`` turns ids into what the cache holds for them, ``add`` joins such values.

        ``whole`` is the table of ``whole_tokens``, if it has been proven already.
        """
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        if spec["model"]["type"] != "BPE" or spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space"):
            raise ValueError("only plain byte-level BPE files are supported")
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.value, self.add, self.model = value, add, self.library.model
        self.chars = str.maketrans({chr(b): c for b, c in enumerate(_byte_chars())})
        self.space = " ".translate(self.chars)
        self.pattern, self.beyond = _patterns()
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        proven = self._whole_tokens(spec["model"]["vocab"]) if whole is None else whole
        self.whole = {text: self.value([k]) for text, k in proven.items()}
        self.forget()
        self.marks = {m: self.value([t.id for t in self.model.tokenize(m)]) for m in ".,;:!?"}
        self.feed = self.value([t.id for t in self.model.tokenize("\n".translate(self.chars))])

    def forget(self) -> None:
        """Empty the caches."""
        self.cache, self.first, self.later = dict(self.whole), {}, {}

    def _whole_tokens(self, vocab: dict[str, int]) -> dict[str, int]:
        """Vocabulary strings that are one pre-token and that the library's merges give as one token."""
        back = {c: b for b, c in enumerate(_byte_chars())}
        found = {}
        for token, k in vocab.items():
            try:
                text = bytes(back[c] for c in token).decode()
            except (KeyError, UnicodeDecodeError):
                continue
            if not self.beyond.search(text) and self.pattern.findall(text) == [text] and [t.id for t in self.model.tokenize(token)] == [k]:
                found[text] = k
        return found

    def _merged(self, pretoken: str):
        if pretoken.isascii() and pretoken.isprintable():
            written = pretoken.replace(" ", self.space)
        else:
            written = pretoken.encode().decode("latin-1").translate(self.chars)
        made = self.value([t.id for t in self.model.tokenize(written)])
        if len(pretoken) <= LONGEST_KEPT:
            if len(self.cache) >= len(self.whole) + CACHE_SIZE:
                self.cache = dict(self.whole)
            self.cache[pretoken] = made
        return made

    def _split(self, text: str) -> list:
        """The values of a stretch's pre-tokens in order."""
        if self.beyond.search(text):
            return [self.value(self.library.encode(text, add_special_tokens=False).ids)]
        out = []
        for p in self.pattern.findall(text):
            v = self.cache.get(p)
            out.append(self._merged(p) if v is None else v)
        return out

    def _word(self, held: dict, word: str, lead: str):
        """The value of a chunk of letters, which is one pre-token; held under the chunk alone."""
        made = held.get(word)
        if made is None:
            made = self.whole.get(lead + word)
            if made is None:
                written = word if word.isascii() else word.encode().decode("latin-1").translate(self.chars)
                made = self.value([t.id for t in self.model.tokenize(self.space + written if lead else written)])
            if len(word) <= LONGEST_KEPT:
                if len(held) >= CACHE_SIZE:
                    held.clear()
                held[word] = made
        return made

    def _chunk(self, held: dict, part: str, lead: str):
        """A chunk's value, kept in ``held``; None if it can't be taken apart from its neighbours."""
        if part.isascii() or not self.beyond.search(part):
            if part.isalpha():
                return self._word(held, part, lead)
            word, mark = part[:-1], part[-1:]
            if mark in self.marks and word.isalpha():  # letters and one mark are two pre-tokens
                return self.add([self._word(held, word, lead), self.marks[mark]])
        if not part or part[0].isspace() or part[-1].isspace():
            return None
        values = self._split(lead + part)
        made = values[0] if len(values) == 1 else self.add(values)
        if len(part) <= LONGEST_KEPT:
            if len(held) >= CACHE_SIZE:
                held.clear()
            held[part] = made
        return made

    def _looked_up(self, held: dict, parts: list[str], lead: str) -> list:
        out = list(map(held.get, parts))
        at = -1
        for _ in range(out.count(None)):
            at = out.index(None, at + 1)
            again = held.get(parts[at])
            out[at] = self._chunk(held, parts[at], lead) if again is None else again
        return out

    def total(self, text: str):
        """The value of a whole text."""
        for a in self.added:
            if a in text:
                return self.value(self.library.encode(text, add_special_tokens=False).ids)
        out = []
        for n, line in enumerate(text.split("\n")):
            parts = line.split(" ")
            if n:
                out.append(self.feed)
            out += self._looked_up(self.first, parts[:1], "")
            out += self._looked_up(self.later, parts[1:], " ")
        try:
            return self.add(out)
        except TypeError:  # a None among the values
            return self.add(self._split(text))


_HELD: dict[tuple[str, str], PretokenEncoder] = {}
_PROVEN: dict[str, dict[str, int]] = {}
_LAST: tuple[str, str] | None = None


def whole_tokens(path: str) -> dict[str, int]:
    """The whole-token table of a vocabulary file, text to id, proven once; ValueError if the file isn't of this kind.

    It is no larger than the vocabulary, so the driver makes it and hands it to the workers.
    """
    if path not in _PROVEN:
        encoder = PretokenEncoder(path, lambda ids: ids[0] if len(ids) == 1 else None, None)
        _PROVEN[path] = dict(encoder.whole)
    return _PROVEN[path]


def take(path: str, proven: dict[str, int] | None) -> None:
    """Use a table proven elsewhere in this process."""
    if proven is not None:
        _PROVEN.setdefault(path, proven)


def _held(path: str, kind: str, value, add) -> PretokenEncoder:
    """The encoder of a kind; one has caches at a time, and work that needs another begins anew."""
    global _LAST
    if (path, kind) != _LAST:
        for other in _HELD.values():
            other.forget()
        _LAST = (path, kind)
    if (path, kind) not in _HELD:
        _HELD[path, kind] = PretokenEncoder(path, value, add, _PROVEN.get(path))
    return _HELD[path, kind]


def id_bytes(path: str, text: str) -> bytes:
    """A text's ids as little-endian unsigned 32-bit integers."""
    return _held(path, "ids", lambda ids: struct.pack(f"<{len(ids)}I", *ids), b"".join).total(text)


def id_count(path: str, text: str) -> int:
    """The number of a text's ids."""
    return _held(path, "count", len, sum).total(text)


def release() -> None:
    """Free the caches of this process: other work that begins in a worker calls it, so stages don't add up their memory."""
    _HELD.clear()
