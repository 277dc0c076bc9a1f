"""Cached encoding with public tokenizers inside Spark tasks.

A tokenizer first cuts a text into pieces that it then encodes one by one.
Texts repeat most of their pieces, so a worker keeps the ids of recent
pieces and asks the tokenizer only for new ones, many at once.
"""

from __future__ import annotations

import re

import numpy as np

#: White space as the byte-level tokenizer's pattern sees it (Unicode White_Space).
_WS = "\t-\r \x85\xa0  -     　"
#: Cuts a text where the byte-level pattern always cuts: a run of white space
#: without its last character, a word with one space before it, a last character.
_BYTE_PIECES = re.compile(f"[{_WS}]+(?![^{_WS}])| ?[^{_WS}]+|[{_WS}]")
_OTHER_WS = [c.encode() for c in "\x85\xa0     　"] + [b"\xe2\x80"]



def _class(b: int) -> str:
    """Kinds of bytes: a letter or digit, a stop or comma, a space or line break,
    t other white space, c and u first and second byte of a Latin letter, w first
    byte that white space may have, ! any other."""
    c = chr(b)
    if b < 0x80:
        return "a" if c.isalnum() else "." if c in ".," else " " if c in " \n" else "t" if c in "\t\x0b\x0c\r" else "!"
    if b < 0xC0:
        return "!" if b in (0x97, 0xB7) else "u"
    return {0xC2: "w", 0xC3: "c", 0xE1: "w", 0xE2: "w", 0xE3: "w"}.get(b, "!")


_CLASS = "".join(map(_class, range(256))).encode()

#: One word of Latin letters: no pattern cuts it, normal form and (here) case leave it.
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ɏ]+")

#: Pieces that a worker remembers (two generations of this many).
CACHE_PIECES = 500_000
#: Characters of new pieces given to the tokenizer at once.
_CALL_CHARS = 200_000


class PieceEncoder:
    """ids of whole texts, equal to ``Tokenizer.encode(text, add_special_tokens=False)``.

    Pieces are UTF-8 bytes. A byte-level tokenizer keeps white space, so its
    pieces are words with the character before them; a tokenizer that drops
    white space has the words themselves.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True  # their strings in a text are ordinary text
        self.vocab_size = self.tok.get_vocab_size()
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.keeps_space = bool(self._ids("\n"))
        self.lower = self._ids("A") == self._ids("a")
        # a mark between pieces that the tokenizer never joins to them and that is one id of its own
        self.mark, self.apart = ("\n", "\n") if self.keeps_space else ("¶", " ¶ ")
        mark = self._ids(self.mark)
        self.mark_id = mark[0] if len(mark) == 1 else None
        # the model's letters for bytes: printable ones stand for themselves, others follow from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.letters = {b: chr(b) for b in plain} | {
            b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in plain)}
        self.newline = np.array(self._ids("\n"), "<u4").tobytes()

    def _ids(self, s: str) -> list[int]:
        return self.tok.encode_batch_fast([s], add_special_tokens=False)[0].ids

    def _cut(self, text: bytes) -> list[bytes]:
        """Keys of a text's pieces: ``word`` stands for the piece " word", ``\\nword``
        for a line break and the piece "word", ``\\rword`` for "word" at the text's
        start, ``\\tpiece`` for any piece as it is."""
        kinds = text.translate(_CLASS).replace(b"cu", b"a")
        # a stop or comma after a letter is a piece of its own for both patterns
        stops = kinds.count(b". ") == kinds.count(b"a. ")
        if not self.keeps_space:
            if stops:
                text = text.replace(b", ", b" , ").replace(b". ", b" . ").replace(b".\n", b" .\n")
            return text.lower().split() if self.lower else text.split()
        if not text:
            return []
        if b"  " in kinds or b"t" in kinds or kinds[:1] == b" " or kinds[-1:] == b" " \
                or b"w" in kinds and any(c in text for c in _OTHER_WS):
            return [b"\t" + p.encode() for p in _BYTE_PIECES.findall(text.decode())]
        # single spaces and single line breaks only: cut before each of them
        if stops:
            text = text.replace(b", ", b" \r, ").replace(b". ", b" \r. ").replace(b".\n", b" \r.\n")
        pieces = text.replace(b"\n", b" \n").split(b" ")
        if pieces[0]:
            pieces[0] = b"\r" + pieces[0]  # the text's first word has no space before it
        return pieces

    def _learn(self, new: list[bytes]) -> None:
        plain, size = [], 0
        for p in new:
            if not self.keeps_space:
                t = word = p.decode()
            elif p[:1] in (b"\r", b"\n", b"\t"):
                t = word = p[1:].decode()
            else:
                word = p.decode()
                t = " " + word
            if _LETTERS.fullmatch(word) and (not self.lower or word == word.lower()):
                letters = t.encode().decode("latin-1").translate(self.letters)  # one piece: straight to its merges
                self._put(p, np.array([x.id for x in self.tok.model.tokenize(letters)], "<u4").tobytes())
                continue
            if self.mark_id is None or self.mark in t or len(t) > 10_000 or not t.strip():
                self._put(p, np.array(self._ids(t), "<u4").tobytes())
                continue
            plain.append((p, t))
            size += len(t)
            if size > _CALL_CHARS:
                self._learn_joined(plain)
                plain, size = [], 0
        if plain:
            self._learn_joined(plain)

    def _learn_joined(self, new: list[tuple[bytes, str]]) -> None:
        ids = np.array(self._ids(self.apart.join(t for _, t in new)), "<u4")
        cut = np.flatnonzero(ids == self.mark_id)
        if len(cut) != len(new) - 1:  # a piece held the mark's id itself
            for p, t in new:
                self._put(p, np.array(self._ids(t), "<u4").tobytes())
            return
        for (p, _), a, b in zip(new, [0, *(cut + 1).tolist()], [*cut.tolist(), len(ids)]):
            self._put(p, ids[a:b].tobytes())

    def _put(self, piece: bytes, ids: bytes) -> None:
        self.young[piece] = self.newline + ids if self.keeps_space and piece[:1] == b"\n" else ids

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each UTF-8 text."""
        if len(self.young) > CACHE_PIECES:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        found, new = [], {}
        for text in texts:
            pieces = self._cut(text)
            ids = list(map(young.get, pieces))
            later = []
            if None in ids:
                i = -1
                for _ in range(ids.count(None)):
                    i = ids.index(None, i + 1)
                    p = pieces[i]
                    v = young.get(p) or old.get(p)
                    if v is None:
                        new[p] = None
                        later.append((i, p))
                    else:
                        ids[i] = young[p] = v
            found.append((ids, later))
        if new:
            self._learn(list(new))
        for ids, later in found:
            for i, p in later:
                ids[i] = young[p]
        return [b"".join(ids) for ids, _ in found]


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One encoder per worker process, kept between tasks."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks side by side
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def chunks(ids: list, texts: list[bytes], max_bytes: int = 2_000_000):
    """Runs of rows with a bounded number of text bytes (one row at least)."""
    a = size = 0
    for i, t in enumerate(texts):
        if i > a and size + len(t) > max_bytes:
            yield ids[a:i], texts[a:i]
            a, size = i, 0
        size += len(t)
    if a < len(texts):
        yield ids[a:], texts[a:]
