"""Token ids by vocabulary files of public tokenizers, each distinct piece of text encoded once per worker."""

from __future__ import annotations

import re
from array import array

import numpy as np
import regex

# How the two vocabularies part a text before their merges.
SPACED_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def vocabulary_path(name: str) -> str:
    """Where an installed public vocabulary file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for themselves, the others from U+0100 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class PieceCache(dict):
    """Piece of text to its ids as little-endian unsigned 32-bit bytes. At most ``bound`` pieces are held.

    A text that holds the string of an added token gets that token's id there, as the library gives it; such
    a text is encoded whole.

    Most pieces are of common Latin letters. Those are parted here and given to the tokenizer's merges
    directly, which is the same work without the cost of a whole encoding; all others are encoded whole.
    """

    COMMON = re.compile(r"[\n -~À-įı-ɏ]+")
    #: A word and signs after it, which both patterns part in two.
    PLAIN = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
    PATTERN = SPACED_PATTERN

    def __init__(self, path: str, bound: int = 350_000) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        # in either case, as a vocabulary may lower-case texts before it looks
        self.added = re.compile("|".join(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()) or "(?!)", re.IGNORECASE).search
        self.merges = self.tokenizer.model.tokenize
        self.parts = regex.compile(self.PATTERN).findall
        self.letters = {chr(b): c for b, c in byte_letters().items()}
        self.table = str.maketrans(self.letters)
        self.bound = bound
        self.recent: dict = {}
        self.signs: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        return self.encode(text) if "<" in text and self.added(text) else self.piecewise(text)

    def merged(self, text: str) -> bytes:
        """The ids of a text that the pattern doesn't part."""
        return array("I", [t.id for t in self.merges(text.encode().decode("latin-1").translate(self.table))]).tobytes()

    def sign_ids(self, signs: str) -> bytes:
        """The ids of signs that follow a word; there are few kinds of them."""
        found = self.signs.get(signs)
        if found is None:
            if len(self.signs) > 1 << 14:
                self.signs.clear()
            found = self.signs[signs] = self.merged(signs)
        return found

    def encode_piece(self, text: str) -> bytes:
        if m := self.PLAIN.fullmatch(text):
            word, signs = m.groups()
            return self.merged(word) + self.sign_ids(signs) if signs else self.merged(word)
        if self.COMMON.fullmatch(text):
            return b"".join(map(self.merged, self.parts(text)))
        return self.encode(text)

    def keep(self, piece, ids: bytes) -> bytes:
        """The first ``bound`` pieces stay for good, among them the frequent ones; later ones until a quarter as many have come."""
        if len(piece) <= 64:
            if len(self) < self.bound:
                self[piece] = ids
            else:
                if len(self.recent) > self.bound // 4:
                    self.recent.clear()
                self.recent[piece] = ids
        return ids


class SpacedPieces(PieceCache):
    """For byte-level BPE whose pieces may begin with one space.

    A single space between two characters that are no white space always begins a piece, so the
    text may be cut there and each part encoded alone, with the same ids.
    """

    CUT = re.compile(r"(?<=[^\s]) (?=[^\s])")
    RARE = re.compile(r"[\t\r\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")

    #: A line's last word and the next line's first one, each with its signs.
    LINES = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+[!-&(-/:-@\[-`{-~]*)\n([A-Za-zÀ-ÖØ-öø-ÿ]+[!-&(-/:-@\[-`{-~]*)")

    def __missing__(self, part: str) -> bytes:
        found = self.recent.get(part)
        if found is not None:
            return found
        if m := self.PLAIN.fullmatch(part):
            word, signs = m.groups()
            if signs:  # the word alone may be known
                return self.keep(part, self[word] + self.sign_ids(signs))
            if word.isascii():  # all letters but the blank stand for themselves
                return self.keep(part, array("I", [t.id for t in self.merges("Ġ" + word)]).tobytes())
        elif m := self.LINES.fullmatch(part):
            return self[m[1]] + self.sign_ids("\n") + self.encode_piece(m[2])
        return self.keep(part, self.encode_piece(" " + part))

    def piecewise(self, text: str) -> bytes:
        if not text:
            return b""
        parts = text.split(" ")
        if "" in parts or " \n" in text or "\n " in text or self.RARE.search(text):
            parts = self.CUT.split(text)
        return self.encode_piece(parts[0]) + b"".join(map(self.__getitem__, parts[1:]))


class WordPieces(PieceCache):
    """For a BPE of lower-case text that drops white space and never joins text across it."""

    PATTERN = WORD_PATTERN
    #: PLAIN in bytes.
    SIGNED = re.compile(rb"([A-Za-z]+)([!-&(-/:-@\[-`{-~]*)")

    def __missing__(self, word: bytes) -> bytes:
        found = self.recent.get(word)
        if found is not None:
            return found
        if word.isascii() and (m := self.SIGNED.fullmatch(word)):
            plain, signs = m.groups()
            if signs:  # the word alone may be known
                return self.keep(word, self[plain] + self.sign_ids(signs.decode()))
            return self.keep(word, array("I", [t.id for t in self.merges(plain.decode().lower())]).tobytes())
        text = word.decode("utf-8", "replace")
        return self.keep(word, self.encode_piece(text.lower() if self.COMMON.fullmatch(text) else text))

    def piecewise(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.encode("utf-8", "replace").split()))


_shared: dict[tuple[type[PieceCache], str], tuple[PieceCache, int]] = {}


def shared_pieces(kind: type[PieceCache], path: str, tasks: int = 8) -> PieceCache:
    """One cache for the next ``tasks`` tasks of a Python worker, which so loads the vocabulary and meets frequent words once.

    After them a new one begins, so that a worker doesn't keep the words of one kind of text for good.
    """
    found, used = _shared.get((kind, path), (None, tasks))
    if found is None or used >= tasks:
        found, used = kind(path), 0
    _shared[kind, path] = found, used + 1
    return found
