"""Per-piece results of a byte-level BPE tokenizer, remembered by piece.

The pre-tokenizer of these vocabularies never lets a token cross from a
non-space character to white space, nor from a letter to a punctuation mark.
A text is therefore cut at such places only, each distinct piece is worked out
once, and a text's result is the concatenation of its pieces' results.  Texts
whose blanks do not stand alone take the general cut by ``PIECES``.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: letters in every Unicode version that a tokenizer may have been built with
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
PIECES = re.compile(
    rf" ?[{_LETTER}]+(?=[ \n.,;:!?])|[.,;:!?]+(?=[ \n])"
    rf"|.+?(?:\S(?=[ \n])|[{_LETTER}](?=[.,;:!?]))|.+", re.S)


class _Memory:
    """Results by key in ``known``.  Past ``most`` entries it keeps those that were asked for
    again, or, if these are too many, none: a worker's memory does not grow with the corpus."""

    def __init__(self, most: int):
        self.known: dict[str, object] = {}
        self.most, self.again = most, set()

    def missing(self, keys: set) -> set:
        """The keys without a result; makes room for them."""
        new = keys.difference(self.known)
        if len(self.known) + len(new) > self.most:
            keep = self.again if len(self.again) < self.most // 2 else set()
            self.known = {k: self.known[k] for k in keep}
            self.again = set()
            new = keys.difference(self.known)
        self.again.update(keys.difference(new))
        return new


class PieceCache:
    """``solve(list of pieces)`` gives one value per piece, ``join(values)`` the value of a text;
    ``whole`` remembers up to ``most`` words and three times as many pieces, the dearer ones."""

    def __init__(self, solve: Callable[[list[str]], list], join: Callable[[Iterable], object],
                 most: int = 200_000):
        self.solve, self.join = solve, join
        self.words, self.pieces = _Memory(most), _Memory(3 * most)

    def _learn(self, pieces: set[str]) -> dict:
        new = list(self.pieces.missing(pieces))
        if new:
            self.pieces.known.update(zip(new, self.solve(new)))
        return self.pieces.known

    def whole(self, texts: list[str]) -> list:
        """One joined value per text."""
        split = [t.replace("\n", " \n").split(" ") for t in texts]
        # a blank belongs to the word after it; a word ending in white space can't stand alone
        new = {w: PIECES.findall(w if w[0] == "\n" else " " + w)
               for w in self.words.missing(set().union(*(s[1:] for s in split)))
               if w and not w[-1].isspace()}
        heads = [PIECES.findall(s[0]) if s[0] and not s[0][-1].isspace() else None
                 for s in split]
        got = self._learn({p for c in (*new.values(), *heads) if c for p in c})
        words = self.words.known
        for w, c in new.items():
            words[w] = got[c[0]] if len(c) == 1 else self.join([got[p] for p in c])
        heads = [h and [got[p] for p in h] for h in heads]
        out = []
        for text, s, parts in zip(texts, split, heads):
            try:
                if parts is None:
                    raise KeyError
                parts += map(words.__getitem__, s[1:])
            except KeyError:  # a word that can't stand alone
                pieces = PIECES.findall(text)
                got = self._learn(set(pieces))
                parts = [got[p] for p in pieces]
            out.append(self.join(parts))
        return out


_LOADED: dict[str, object] = {}


def library_tokenizer(path: str):
    """The tokenizers library's tokenizer for a ``.json`` file, one per worker process."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if sys.byteorder != "little" or array("I").itemsize != 4:
            raise RuntimeError("ids are written as little-endian 32-bit words")
        _LOADED[path] = Tokenizer.from_file(path)
    return _LOADED[path]


#: bytes of text that are worked on together
TEXT_BYTES = 1 << 23
#: what ``str.isspace`` and ``str.split`` take as white space
_SPACE = re.compile(r"\s")
#: words that are encoded as one text, a line each
_LINES = 100


class IdCache(PieceCache):
    """Token ids of whole columns of texts.  Arrow splits the texts and numbers their distinct words, a
    new word that holds no white space is encoded with others as one text, a line each, and numpy puts
    the words' ids together; whatever can't stand alone goes by pieces.  Words and ids are remembered as
    arrays, past ``most`` words those that were asked for again, or, if these are too many, none."""

    def __init__(self, tok, most: int = 500_000):
        def solve(pieces):
            return [array("I", e.ids).tobytes()
                    for e in tok.encode_batch_fast(pieces, add_special_tokens=False)]

        super().__init__(solve, b"".join, most // 8)
        self.tok, self.line, self.most = tok, tok.encode("\n", add_special_tokens=False).ids, most
        self._keep(pa.array([], pa.string()), np.empty(0, "<u4"), np.empty(0, np.int64))

    def _keep(self, words: pa.Array, ids: np.ndarray, size: np.ndarray) -> None:
        self.lone, self.ids, self.size = words, ids, size
        self.start, self.again = np.cumsum(size) - size, np.zeros(len(words), bool)

    def _flat(self, values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids one after another, and how many each value has."""
        return np.frombuffer(b"".join(values), "<u4"), np.array([len(v) >> 2 for v in values], np.int64)

    def _lines(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words without white space, which may have a blank before them."""
        if len(self.line) != 1 or not words:
            return self._flat(self.solve(words) if words else [])
        cuts = [words[i:i + _LINES] for i in range(0, len(words), _LINES)]
        ids, sizes = [], []
        for lines, e in zip(cuts, self.tok.encode_batch_fast(
                ["\n".join(c) for c in cuts], add_special_tokens=False)):
            got = np.array(e.ids + self.line, "<u4")
            kept = got != self.line[0]
            ends = np.flatnonzero(~kept)
            if len(ends) == len(lines):
                ids.append(got[kept])
                ends[1:] -= ends[:-1] + 1
                sizes.append(ends)
            else:  # a line end became part of another token
                flat, size = self._flat(self.solve(lines))
                ids.append(flat)
                sizes.append(size)
        return np.concatenate(ids), np.concatenate(sizes)

    def _learn_words(self, words: list[str]) -> None:
        """Remember the ids of new words with their blank, except of those that can't stand alone."""
        plain, first, other = [], [], []
        space = _SPACE.search
        for w in words:
            at = space(w)
            if at is None:
                if w:
                    plain.append(w)
            elif not w[-1].isspace():
                (first if w[0] == "\n" and space(w, 1) is None else other).append(w)
        by_line, size = self._lines([w[1:] for w in first])
        ends = np.repeat(np.cumsum(size) - size, len(self.line))
        cut = [PIECES.findall(w if w[0] == "\n" else " " + w) for w in other]
        got = self._learn({p for c in cut for p in c})
        found = [self._lines([" " + w for w in plain]),
                 (np.insert(by_line, ends, self.line * len(first)), size + len(self.line)),
                 self._flat([self.join([got[p] for p in c]) for c in cut])]
        again, self.again = self.again, None
        self._keep(pa.concat_arrays([self.lone, pa.array(plain + first + other, pa.string())]),
                   np.concatenate([self.ids, *(f[0] for f in found)]).astype("<u4", copy=False),
                   np.concatenate([self.size, *(f[1] for f in found)]))
        self.again[:len(again)] = again

    def _forget_words(self) -> None:
        if len(self.lone) > self.most:
            keep = np.flatnonzero(self.again)
            keep = keep[:0] if len(keep) >= self.most // 2 else keep
            ids = _spans(self.start[keep], self.size[keep])
            self._keep(self.lone.take(pa.array(keep)), self.ids[ids], self.size[keep])

    def batch(self, column: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends): the ids of all texts one after another, each followed by ``end_id`` if given,
        and where each text's ids end."""
        n = len(column)
        if not n:
            return np.empty(0, "<u4"), np.empty(0, np.int64)
        split = pc.split_pattern(pc.replace_substring(column, "\n", " \n"), " ")
        first = split.offsets.to_numpy()[:-1].astype(np.int64)
        coded = split.flatten().dictionary_encode()
        code, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary.cast(pa.string())
        # a text's first word has no blank before it
        heads = words.take(pa.array(code[first])).to_pylist()
        self._forget_words()
        at = _places(words, self.lone)
        new, known = np.flatnonzero(at < 0), len(self.lone)
        self.again[at[at >= 0]] = True
        if len(new):
            unknown = words.take(pa.array(new))
            self._learn_words(unknown.to_pylist())
            found = _places(unknown, self.lone.slice(known))
            at[new] = np.where(found < 0, -1, found + known)
        lone = (at >= 0)[code]
        lone[first] = [bool(h) and not h[-1].isspace() for h in heads]
        bad = ~np.logical_and.reduceat(lone, first)
        cuts = [PIECES.findall(column[i].as_py() if b else h)
                for i, (b, h) in enumerate(zip(bad.tolist(), heads))]
        got = self._learn({p for c in cuts for p in c})
        flat, size = self._flat([self.join([got[p] for p in c]) for c in cuts])
        # place -1, of a word that can't stand alone, is an empty one
        start = np.concatenate([np.append(self.start, 0)[at], len(self.ids) + np.cumsum(size) - size])
        size = np.concatenate([np.append(self.size, 0)[at], size])
        code[first] = len(words) + np.arange(n)
        length, last = size[code], np.append(first[1:], len(code))
        # a text that goes by pieces has all its ids at its first word
        for i in np.flatnonzero(bad).tolist():
            length[first[i] + 1:last[i]] = 0
        if end_id is None:
            return np.concatenate([self.ids, flat])[_spans(start[code], length)], np.cumsum(length)[last - 1]
        # a text's end is a span of one id behind its last word
        known = np.concatenate([self.ids, flat, np.array([end_id], "<u4")])
        ids = known[_spans(np.insert(start[code], last, len(known) - 1), np.insert(length, last, 1))]
        return ids, np.cumsum(length)[last - 1] + np.arange(1, n + 1)


def _places(words: pa.Array, among: pa.Array) -> np.ndarray:
    """Where each word stands, -1 if nowhere."""
    return pc.fill_null(pc.index_in(words, value_set=among), -1).to_numpy(zero_copy_only=False).astype(np.int64)


def _spans(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each span, one span after another."""
    ends = np.cumsum(length)
    return np.repeat(start - ends + length, length) + np.arange(ends[-1] if len(ends) else 0)


def id_cache(path: str) -> IdCache:
    """Token ids (unsigned 32-bit) of whole texts, as the tokenizers library gives them without added
    special tokens."""
    key = f"ids:{path}"
    if key not in _LOADED:
        _LOADED[key] = IdCache(library_tokenizer(path))
    return _LOADED[key]
