"""Phrases whose words stand together more often than apart (operator 13).

Texts are cut into pieces at ``. , ; : ! ?`` and line ends, pieces into words.  f(phrase) counts all
contiguous occurrences of 1 to LONGEST words within pieces, per language.  Phrases of f at least
``min_count`` are found level by level, each level Apriori-safe: a phrase can only be frequent if
the phrase without its first and the one without its last word are.

* One scan writes the words as numbers, in blocks of one language with a dictionary each.  The
  dictionaries' words go, packed, to groups by a hash of the word (GROUP_WORDS entries in the mean), which add up
  the counts, number the frequent words, and send each block the numbers of its own (no vocabulary goes to the
  driver or whole to a task).
* Blocks are cut into rows of ROW_WORDS words, each with the frequent words that it holds, and dealt to
  tasks of TASK_WORDS words by language, so that few tasks count the same phrase.
* Each level is one pass over the coded text, however many phrases there are.  A task lists its places, adds
  up equal phrases, and sends them packed, in one row for each of a number of groups that a hash of the phrase
  gives (by the words of the corpus, GROUP_PLACES places at most in the mean).  A group adds up what all tasks
  sent and keeps the frequent phrases.  What is sent is bounded by the places, and sorted and added up by
  numpy; nothing depends on how many candidates a level has.
* Pairs: the places are those of two frequent words next to each other.
* Longer phrases: a bitmap of BITS bits (a fixed size) marks the frequent phrases of the level before; the places
  are those where two of them overlap.  A bit set by another phrase costs a place, not a wrong count.
  (Joining that level with itself instead lists sum in(w) * out(w) over words w.)

A cut of a phrase after its first k words scores floor(1000 * f * n / (f(first) * f(rest))), in
decimals of 38 digits; the lowest cut counts, of equal ones the smallest k.  A phrase whose words stand
inside a longer frequent one that occurs as often is dropped.  The best ``top`` of each language
stay; that is the feature, a report.

Null text: empty.  Null lang: ``und``.  doc_id is not looked at: every row is a text, repeated ones
too.  No frequent phrase, empty table: empty result.  Ties in score: more frequent first, then by
UTF-8 bytes.  Extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statframe.llm.common import LOWER, UPPER, stored, text_groups
from statframe.ship import ship

LONGEST = 5
#: words of a block, frequent phrases of a group, and the size of bitmaps (a power of two).  A dictionary
#: entry is shuffled per block and word: large blocks have fewer
BLOCK_WORDS, TRIE_PHRASES, BITS = 1 << 21, 1 << 17, 1 << 25
#: places that a group adds up for each of its phrases, and entries of dictionaries that a group adds up
GROUP_PLACES, GROUP_WORDS = 16, 1 << 19
#: words that one task counts, of one language where it has as many, and words of the rows that it reads: a
#: worker gets all rows of a task in one batch, so its memory follows both
TASK_WORDS, ROW_WORDS = 1 << 22, 1 << 18
#: places that a task gathers before it sends them on
GATHER = 1 << 21

_END = b"\n"
_CUTS = {ord(c): _END[0] for c in ".,;:!?\x0a\x0b\x0c\x0d"}
_TABLE = bytes({**{ord(u): ord(x) for u, x in zip(UPPER, LOWER)}, **_CUTS, 0x09: 0x20}.get(c, c)
               for c in range(256))


def piece_words(text: str) -> list[bytes]:
    """The lower-cased words of a text, with a line end between pieces."""
    cut = text.encode("utf-8", "replace").translate(_TABLE).replace(_END, b" \n ")
    return [w for w in cut.split(b" ") if w]


def _strings(letters: np.ndarray, lengths: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [
        None, pa.py_buffer(np.append(0, np.cumsum(lengths))), pa.py_buffer(letters)])


def _letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """What ``_strings`` makes words of; they have no nulls and are no slice."""
    if not len(words):
        return np.empty(0, np.uint8), np.empty(0, np.int64)
    _, ends, data = words.buffers()
    at = np.frombuffer(ends, np.int64)[:len(words) + 1]
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], np.diff(at)


class Block:
    """Texts of one language as word numbers; number 0 ends a piece.  The words are those of ``piece_words``,
    found by columns: their letters one after another, their lengths, and which of them begin a piece."""

    def __init__(self):
        self.letters, self.lengths, self.begins, self.size = [], [], [], 0

    def add(self, texts: pa.Array):
        """A column of texts without nulls."""
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts), "\n")
        data = np.frombuffer(joined[0].as_buffer().to_pybytes().translate(_TABLE), np.uint8)
        ends = data == _END[0]
        gap = np.ones(len(data) + 2, bool)
        gap[1:-1] = ends | (data == 0x20)
        edges = np.flatnonzero(gap[1:] != gap[:-1])
        start, stop = edges[::2], edges[1::2]
        begins = np.zeros(len(start) + 1, bool)
        begins[0] = True
        begins[np.searchsorted(start, np.flatnonzero(ends))] = True
        self.letters.append(data[~gap[1:-1]])
        self.lengths.append(stop - start)
        self.begins.append(begins[:-1])
        self.size += len(start)

    def row(self, lang: str) -> dict:
        letters, lengths = np.concatenate(self.letters), np.concatenate(self.lengths)
        coded = _strings(letters, lengths).dictionary_encode()
        number = coded.indices.to_numpy().astype(np.int32)
        counts = np.bincount(number, minlength=len(coded.dictionary))
        at = np.append(np.flatnonzero(np.concatenate(self.begins))[1:], len(number))
        return {"lang": lang, "ids": _pack(np.insert(number + 1, at, 0)), "words": coded.dictionary, "counts": counts}


def _pack(ids: np.ndarray) -> bytes:
    """Low halves first: the high ones are mostly 0 and compress well."""
    return (ids & 0xFFFF).astype("<u2").tobytes() + (ids >> 16).astype("<u2").tobytes()


def _unpack(data: bytes) -> np.ndarray:
    low, high = np.frombuffer(data, "<u2").reshape(2, -1).astype(np.int32)
    return low | high << 16


BLOCK = "lang string, ids binary, words binary, lengths binary, counts binary, entries long, n long"


def _encoding(block_words: int):
    """A pass that writes texts as blocks of about ``block_words`` words."""
    def batch(open_, langs):
        rows = []
        for lang in langs:
            r = open_.pop(lang).row(lang)
            letters, lengths = _letters(r["words"])
            rows.append((lang, r["ids"], letters.tobytes(), _pack(lengths), _pack(r["counts"]), len(lengths),
                         int(r["counts"].sum())))
        kinds = [pa.string(), *4 * [pa.binary()], pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=[
            "lang", "ids", "words", "lengths", "counts", "entries", "n"])

    def run(batches):
        open_: dict[str, Block] = defaultdict(Block)
        for b in text_groups(batches):
            langs = b.column("lang").dictionary_encode()
            of = langs.indices.to_numpy()
            texts = b.column("text").take(pa.array(np.argsort(of, kind="stable")))
            ends = np.cumsum(np.bincount(of))
            for lang, lo, hi in zip(langs.dictionary.to_pylist(), [0, *ends], ends):
                open_[lang].add(texts.slice(lo, hi - lo))
                if open_[lang].size >= block_words:
                    yield batch(open_, [lang])
            if sum(x.size for x in open_.values()) >= 4 * block_words:
                yield batch(open_, list(open_))
        for lang in list(open_):
            yield batch(open_, [lang])
    return run


def _merged(words: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Words and counts of distinct phrases; ``words`` has a row for the phrases' first words, one for their
    second, ..., and each phrase counts 1 or its entry in ``counts``."""
    if counts is None and len(words) == 2:  # a pair is a number of 64 bits
        pair = np.sort(words[0].astype(_U) << _U(32) | words[1])
        first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])[:len(pair)])
        n, pair = np.diff(np.append(first, len(pair))), pair[first]
        return np.stack([pair >> _U(32), pair & _U(0xFFFFFFFF)]).astype(np.uint32), n
    h = _mix(words)
    order = np.argsort(h)
    for last in (False, True):
        h_, got = h[order], words[:, order]
        new = np.ones(len(order), bool)
        new[1:] = (got[:, 1:] != got[:, :-1]).any(axis=0)
        if last or not (new[1:] & (h_[1:] == h_[:-1])).any():
            break
        order = np.lexsort((*words, h))  # different phrases of one hash: equal ones may stand apart
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(new))) if counts is None else (
        np.add.reduceat(counts[order], first) if len(first) else counts)
    return got[:, first], n


def _dealt(hashes: np.ndarray, groups: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order by groups, and (group, from, to) in that order."""
    of = ((hashes >> _U(32)) * _U(groups) >> _U(32)).astype(np.uint16 if groups < 1 << 16 else np.uint32)
    order = np.argsort(of, kind="stable")
    ends = np.flatnonzero(np.diff(of[order])) + 1
    return order, [(int(of[order[x]]), x, y) for x, y in zip([0, *ends.tolist()], [*ends.tolist(), len(of)])]


def _sending(k: int, marks, groups: int):
    """A pass that sends a task's k-word phrases, with counts, to ``groups`` groups: packed, one row each."""
    def rows(open_):
        words, n = _merged(np.concatenate(open_, axis=1))
        order, cut = _dealt(_mix(words), groups)
        words, n = words[:, order], n[order]
        return pa.RecordBatch.from_arrays(
            [pa.array([g for g, _, _ in cut], pa.int32()),
             pa.array([_pack(words[:, a:b].reshape(-1)) for _, a, b in cut], pa.binary()),
             pa.array([_pack(n[a:b]) for _, a, b in cut], pa.binary())], names=["part", "phrases", "n"])

    def run(batches):
        open_, size = [], 0
        for g in _texts_of(batches):
            i = _places(g, k, marks and marks.value)
            # a row has far fewer places than GATHER
            open_.append(np.stack([g[i + j] for j in range(k)]))
            size += len(i)
            if size >= GATHER:
                yield rows(open_)
                open_, size = [], 0
        if size:
            yield rows(open_)
    return run


def _frequent(coded: DataFrame, k: int, marks: np.ndarray | None, min_count: int, groups: int) -> DataFrame:
    """(phrase, f) of the frequent phrases of k words."""
    def add(key, table):
        words = np.concatenate([_unpack(x.as_py()).view(np.uint32).reshape(k, -1)
                                for x in table.column("phrases")], axis=1)
        words, f = _merged(words, np.concatenate([_unpack(x.as_py()).astype(np.int64) for x in table.column("n")]))
        enough = f >= min_count
        flat = np.ascontiguousarray(words[:, enough].T).reshape(-1).astype(np.int64)
        phrase = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, k), pa.int32()), pa.array(flat))
        return pa.table({"phrase": phrase, "f": pa.array(f[enough], pa.int64())})

    shared = None if marks is None else coded.sparkSession.sparkContext.broadcast(marks)
    sent = coded.mapInArrow(_sending(k, shared, groups), "part int, phrases binary, n binary")
    got = stored(sent.groupBy("part").applyInArrow(add, "phrase array<long>, f long"), f"phrases{k}")
    if shared is not None:
        shared.unpersist()
    return got


_POWERS = np.cumprod(np.full(256, 0x9E3779B97F4A7C15, np.uint64))


def _dealing(groups: int):
    """A pass that deals the entries of blocks' dictionaries to ``groups`` groups, by a hash of the word: one
    row for each, with the entries' numbers."""
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                lang, block = (b.column(c).slice(i, 1) for c in ("lang", "block"))
                letters = np.frombuffer(b.column("words")[i].as_py(), np.uint8)
                lengths, counts = (_unpack(b.column(c)[i].as_py()) for c in ("lengths", "counts"))
                if not len(lengths):
                    continue
                start = np.cumsum(lengths, dtype=np.int64) - lengths
                letter = np.arange(len(letters)) - np.repeat(start, lengths)
                h = np.add.reduceat(_POWERS[letter & 255] * (letters.astype(_U) + _U(1)), start)
                order, cut = _dealt(_mix([h]), groups)
                words, sizes = _letters(_strings(letters, lengths).take(pa.array(order)))
                ends = np.append(0, np.cumsum(sizes))
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays(len(cut) * [lang]), pa.concat_arrays(len(cut) * [block]),
                     pa.array([g for g, _, _ in cut], pa.int32()),
                     pa.array([words[ends[x]:ends[y]].tobytes() for _, x, y in cut], pa.binary()),
                     pa.array([_pack(sizes[x:y]) for _, x, y in cut], pa.binary()),
                     pa.array([_pack(counts[order[x:y]]) for _, x, y in cut], pa.binary()),
                     pa.array([_pack(order[x:y] + 1) for _, x, y in cut], pa.binary())],
                    names=["lang", "block", "part", "words", "lengths", "counts", "i"])
    return run


DEALT = "lang string, block long, part int, words binary, lengths binary, counts binary, i binary"
VOCABULARY = ("lang string, part int, words array<string>, f array<long>, "
              "at array<struct<block:long,i:binary,gid:binary>>")


def _numbering(min_count: int):
    """Adds up a group of dictionaries' entries: its frequent words in one row, and for each block which of its
    entries they are; the numbers 1, 2, ... are the group's own."""
    def add(key, table):
        sizes = [_unpack(x.as_py()) for x in table.column("lengths")]
        coded = _strings(np.concatenate([np.frombuffer(x.as_py(), np.uint8) for x in table.column("words")]),
                         np.concatenate(sizes)).dictionary_encode()
        of, f = coded.indices.to_numpy(), np.zeros(len(coded.dictionary), np.int64)
        np.add.at(f, of, np.concatenate([_unpack(x.as_py()) for x in table.column("counts")]))
        enough = f >= min_count
        gid = np.where(enough, np.cumsum(enough), 0)[of]
        at, lo = [], 0
        for block, i, size in zip(table.column("block").to_pylist(), table.column("i"), sizes):
            mine = gid[lo:lo + len(size)]
            if mine.any():
                at.append({"block": block, "i": _pack(_unpack(i.as_py())[mine > 0]), "gid": _pack(mine[mine > 0])})
            lo += len(size)
        words = coded.dictionary.filter(pa.array(enough)).cast(pa.large_string()).cast(pa.string())
        ends = pa.array([0, len(words)], pa.int32())
        return pa.table({
            "lang": pa.array([key[0].as_py()], pa.string()), "part": pa.array([key[1].as_py()], pa.int32()),
            "words": pa.ListArray.from_arrays(ends, words),
            "f": pa.ListArray.from_arrays(ends, pa.array(f[enough])),
            "at": pa.array([at], pa.list_(pa.struct(
                [("block", pa.int64()), ("i", pa.binary()), ("gid", pa.binary())])))})
    return add


def _vocabulary(blocks: DataFrame, min_count: int, group_words: int) -> tuple[DataFrame, DataFrame]:
    """The frequent words (lang, word, f, gid), numbered 1, 2, ..., and for each block ``at``: parts with the
    numbers of entries, those of words, and what to add to these."""
    entries = blocks.agg(F.sum("entries")).first()[0] or 0
    got = stored(blocks.select("block", "lang", "words", "lengths", "counts").mapInArrow(
        _dealing(max(1, -(-entries // group_words))), DEALT).groupBy("lang", "part").applyInArrow(
        _numbering(min_count), VOCABULARY), "vocabulary")
    sizes = got.select("lang", "part", F.size("words").cast("long").alias("base")).toArrow()
    bases = sizes.set_column(2, "base", pa.array(np.append(0, np.cumsum(sizes["base"]))[:-1], pa.int64()))
    got = got.join(F.broadcast(blocks.sparkSession.createDataFrame(bases)), ["lang", "part"])
    words = stored(got.select("lang", "base", F.posexplode(F.arrays_zip("words", "f")).alias("i", "e")).select(
        "lang", F.col("e.words").alias("word"), F.col("e.f").alias("f"),
        (F.col("base") + F.col("i") + 1).alias("gid")), "words")
    at = got.select("base", F.inline("at")).groupBy("block").agg(
        F.collect_list(F.struct("i", "gid", "base")).alias("at"))
    return words, at


def _texts_of(batches):
    """The frequent words' numbers at every position of each row; 0 for other words and between pieces."""
    for b in batches:
        gids, ids = b.column("at").field("gid"), b.column("ids")
        for i in range(b.num_rows):
            gid = gids[i].values.to_numpy()
            if len(gid) and gid.max() >> 32:
                raise OverflowError("phrases are of 32-bit word numbers")
            yield np.append(0, gid).astype(np.uint32)[_unpack(ids[i].as_py())]


def _cutting(row_words: int):
    """A pass that cuts blocks into rows of about ``row_words`` words, behind a piece's end: each has the numbers
    of its own frequent words only, the other words are 0 like the pieces' ends."""
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                ids, parts = _unpack(b.column("ids")[i].as_py()), b.column("at")[i].as_py()
                at = np.concatenate([_unpack(p["i"]) for p in parts])
                gid = np.concatenate([_unpack(p["gid"]).astype(np.int64) + p["base"] for p in parts])
                place, ends, lo = _in_text(ids, at, np.arange(1, len(gid) + 1)), np.flatnonzero(ids == 0), 0
                while lo < len(ids):
                    k = np.searchsorted(ends, lo + row_words - 1)
                    hi = int(ends[k]) + 1 if k < len(ends) else len(ids)
                    here = place[lo:hi]
                    own = np.flatnonzero(np.bincount(here, minlength=len(gid) + 1)[1:])
                    number = np.zeros(len(gid) + 1, np.int32)
                    number[own + 1] = np.arange(1, len(own) + 1)
                    words = pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), pa.array(gid[own]))
                    yield pa.RecordBatch.from_arrays(
                        [b.column("lang").slice(i, 1), b.column("block").slice(i, 1),
                         pa.array([_pack(number[here])], pa.binary()),
                         pa.StructArray.from_arrays([words], names=["gid"])],
                        names=["lang", "block", "ids", "at"])
                    lo = hi
    return run


def _in_text(ids: np.ndarray, at: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The value of each position's word; 0 for other words and between pieces."""
    table = np.zeros(int(ids.max(initial=0)) + 1, value.dtype)
    table[at] = value
    return table[ids]


_U = np.uint64


def _mix(words) -> np.ndarray:
    """A 64-bit hash of each phrase, given its first, second, ... words."""
    x = np.zeros(len(words[0]), _U)
    for w in words:
        x = (x ^ w.astype(_U)) * _U(0x9E3779B97F4A7C15)
        x = (x ^ (x >> _U(31))) * _U(0xBF58476D1CE4E5B9)
        x ^= x >> _U(29)
    return x


def _hash(words, bits: int) -> np.ndarray:
    """A place in the bitmap for each phrase."""
    return (_mix(words) % _U(bits)).astype(np.int64)


#: bits of a row in which a bitmap goes to the driver, of smaller bitmaps all
_CHUNK = 1 << 17


def _bitmap(level: DataFrame, k: int, bits: int) -> np.ndarray:
    """The bits of the k-word phrases in ``level``, as many however many phrases there are."""
    chunk = min(bits, _CHUNK)

    def places(batches):
        marked = np.zeros(bits, bool)
        for b in batches:
            marked[_hash(list(b.column("phrase").flatten().to_numpy().reshape(-1, k).T), bits)] = True
        rows = np.packbits(marked, bitorder="little").reshape(-1, chunk // 8)
        some = np.flatnonzero(rows.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(
            [rows[i].tobytes() for i in some], pa.binary())], names=["chunk", "bits"])

    def add(key, table):
        one = np.bitwise_or.reduce([np.frombuffer(x.as_py(), np.uint8) for x in table.column("bits")], axis=0)
        return pa.table({"chunk": pa.array([key[0].as_py()], pa.int32()),
                         "bits": pa.array([one.tobytes()], pa.binary())})

    # a group has one row per task
    got = level.select("phrase").mapInArrow(places, "chunk int, bits binary").groupBy("chunk").applyInArrow(
        add, "chunk int, bits binary").collect()
    out = np.zeros((bits // chunk, chunk // 32), np.uint32)
    for r in got:
        out[r["chunk"]] = np.frombuffer(r["bits"], np.uint32)
    return out.reshape(-1)


def _has(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    return bits[h >> 5] >> (h & 31).astype(np.uint32) & np.uint32(1) > 0


def _places(g: np.ndarray, k: int, marks: np.ndarray | None) -> np.ndarray:
    """Where k frequent words stand together; from 3 words on, where the first and the last k - 1
    of them are marked."""
    n = len(g) - max(k - 1, 2) + 1
    if n < 2:
        return np.empty(0, np.int64)
    full = g[:n] > 0
    for j in range(1, max(k - 1, 2)):
        full &= g[j:j + n] > 0
    i = np.flatnonzero(full)
    if k == 2:
        return i
    marked = np.zeros(n, bool)
    marked[i] = _has(marks, _hash([g[i + j] for j in range(k - 1)], 32 * len(marks)))
    return np.flatnonzero(marked[:-1] & marked[1:])


class DoubleArrayTrie:
    """A trie of phrases of one length; the levels are counted without it, in packed groups (``_frequent``),
    which take one pass for any number of phrases.  A state is a slot; its child by symbol s is slot
    base[state] + s, if check there names the state.  About a quarter of the slots is used."""

    ROOM = 4

    def __init__(self, phrases: np.ndarray):
        n, self.length = phrases.shape
        self.words = np.unique(phrases)
        phrases = phrases[np.lexsort(phrases.T[::-1])]
        self.phrases = phrases
        sym = np.searchsorted(self.words, phrases) + 1
        # new[:, d]: whether a prefix of d + 1 words begins at a phrase, in sorted order
        new = np.ones(sym.shape, bool)
        new[1:] = np.logical_or.accumulate(sym[1:] != sym[:-1], axis=1)
        self._top = len(self.words)
        size = 2 * (self._top + 1) + self.ROOM * int(new.sum())
        self.base, self.check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
        self._random = np.random.default_rng(0)
        slot = np.zeros(n, np.int64)  # the state of each phrase's prefix so far
        parents = np.zeros(1, np.int64)
        for d in range(self.length):
            child = np.flatnonzero(new[:, d])
            of = np.searchsorted(parents, child, side="right") - 1
            if d == 0:
                self.check[sym[child, 0]] = 0  # the root's base is 0
            else:
                self._place(slot[parents], of, sym[child, d])
            own = self.base[slot[child]] + sym[child, d]
            slot = own[np.cumsum(new[:, d]) - 1].astype(np.int64)
            parents = child
        self.accept = np.full(len(self.check), -1, np.int32)
        self.accept[slot] = np.arange(n)
        del self._random

    def _place(self, states, of, syms):
        """Find each state's base, so that its children (``syms`` where ``of`` is its index) fall
        on free slots: states with many children first, those with one on any free slot."""
        first = np.searchsorted(of, np.arange(len(states) + 1))
        count = np.diff(first)
        for s in np.argsort(-count, kind="stable")[:int((count > 1).sum())]:
            c = syms[first[s]:first[s + 1]]
            b = self._fit(c)
            self.base[states[s]] = b
            self.check[b + c] = states[s]
        single = np.flatnonzero(count == 1)
        c = syms[first[single]]
        # behind the root's children: a base is never below 1
        free = np.flatnonzero(self.check[self._top + 1:] < 0) + self._top + 1
        free = free[:-self._top - 1][:len(single)]
        self.base[states[single]] = free - c
        self.check[free] = states[single]

    def _fit(self, c: np.ndarray) -> int:
        """A base whose slots are free: one of a few thousand drawn, else behind the end."""
        for _ in range(16):
            b = self._random.integers(1, len(self.check) - 2 * self._top, 256)
            ok = np.flatnonzero((self.check[b[:, None] + c] < 0).all(axis=1))
            if len(ok):
                return int(b[ok[0]])
        b = len(self.check) - self._top
        self.base = np.concatenate([self.base, np.zeros(self._top + 1, np.int32)])
        self.check = np.concatenate([self.check, np.full(self._top + 1, -1, np.int32)])
        return b

    def symbols(self, gid: np.ndarray) -> np.ndarray:
        """The symbols of words; 0 for words of no phrase."""
        at = np.minimum(np.searchsorted(self.words, gid), len(self.words) - 1)
        return np.where(self.words[at] == gid, at + 1, 0).astype(np.int32)

    def count(self, sym: np.ndarray) -> np.ndarray:
        """How often each phrase occurs in a sequence of symbols: the states of all positions
        move on together, one symbol after the other."""
        i = np.flatnonzero(sym[:max(0, len(sym) - self.length + 1)])
        state = np.zeros(len(i), np.int32)
        for d in range(self.length):
            slot = self.base[state] + sym[i + d]
            alive = self.check[slot] == state
            # symbol 0 leads to no child: a state's own base is never its child
            alive &= sym[i + d] > 0
            i, state = i[alive], slot[alive]
        return np.bincount(self.accept[state], minlength=len(self.phrases))


#: products may pass 64 bits: decimals of 38 digits, divided exactly
SCORE = ("(1000 * cast(f as decimal(19,0)) * cast(n as decimal(19,0)))"
         " div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")


def frequent_phrases(docs: DataFrame, min_count: int = 100, longest: int = LONGEST,
                     text_col: str = "text", lang_col: str = "lang",
                      block_words: int = BLOCK_WORDS, trie_phrases: int = TRIE_PHRASES,
                      bits: int = BITS, task_words: int = TASK_WORDS, row_words: int = ROW_WORDS
                      ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The frequent words (lang, word, gid, f), the frequent phrases of 2 to ``longest`` words
    (phrase: gids, f), and the words of each language (lang, n)."""
    ship(docs.sparkSession)
    texts = docs.select(
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    blocks = stored(texts.mapInArrow(
        _encoding(block_words), BLOCK).withColumn("block", F.monotonically_increasing_id()), "blocks")
    totals = blocks.groupBy("lang").agg(F.sum("n").alias("n"))
    words, at = _vocabulary(blocks, min_count, GROUP_WORDS)
    # every task sends its counts of each phrase: a task has many words, of few languages
    n_words = totals.agg(F.sum("n")).first()[0] or 0
    coded = stored(blocks.select("lang", "block", "ids").join(at, "block").repartitionByRange(
        max(1, -(-n_words // task_words)), "lang", "block").mapInArrow(
        _cutting(row_words), "lang string, block long, ids binary, at struct<gid:array<long>>").select(
        "ids", "at"), "coded")
    groups = max(1, -(-n_words // (GROUP_PLACES * trie_phrases)))
    phrases = level = _frequent(coded, 2, None, min_count, groups)
    for k in range(3, longest + 1):
        marks = _bitmap(level, k - 1, bits)
        if not marks.any():
            break
        level = _frequent(coded, k, marks, min_count, groups)
        phrases = phrases.unionByName(level)
    return words, phrases, totals


def collocations(docs: DataFrame, min_count: int = 100, longest: int = LONGEST, top: int = 2000,
                 text_col: str = "text", lang_col: str = "lang", **sizes: int) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language."""
    words, phrases, totals = frequent_phrases(docs, min_count, longest, text_col, lang_col, **sizes)
    size = F.size("phrase")
    # longer phrases that occur as often as a part of theirs
    inner = phrases.filter(size > 2).select("f", "phrase", F.explode(F.sequence(
        F.lit(2), size - 1)).alias("k")).select("f", "phrase", "k", F.explode(F.sequence(
            F.lit(1), size - F.col("k") + 1)).alias("at")).select(
        F.slice("phrase", F.col("at"), F.col("k")).alias("phrase"), "f")
    most = inner.groupBy("phrase").agg(F.max("f").alias("around"))
    kept = phrases.join(most, "phrase", "left").filter(
        F.col("around").isNull() | (F.col("around") < F.col("f"))).select("phrase", "f")
    lang = words.select(F.col("gid").alias("head"), "lang").join(totals, "lang")
    kept = kept.withColumn("head", F.get("phrase", F.lit(0))).join(lang, "head").drop("head")
    # every part of a frequent phrase is frequent: the joins lose nothing
    part = words.select(F.array("gid").alias("phrase"), "f").unionByName(phrases)
    cuts = kept.select("*", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.withColumn("first", F.slice("phrase", 1, F.col("k"))).withColumn(
        "rest", F.slice("phrase", F.col("k") + 1, size - F.col("k")))
    for side, f in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(part.select(F.col("phrase").alias(side), F.col("f").alias(f)), side)
    best = cuts.withColumn("score", F.expr(SCORE)).groupBy("phrase").agg(
        F.first("lang").alias("lang"), F.first("f").alias("a"), F.first("n").alias("n"),
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # no more rows per language than the report has, from each of 64 parts, before words are spelt
    # out; ties stay until the spelling decides
    scored = best.select("phrase", "lang", "a", "n", "cut.l", "cut.r", "cut.score")
    part = Window.partitionBy("lang", "part").orderBy(F.desc("score"), F.desc("a"))
    scored = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn(
        "above", F.rank().over(part)).filter(F.col("above") <= top).drop("above")
    spelt = scored.select("phrase", F.posexplode("phrase").alias("i", "gid")).join(
        words.select("gid", "word"), "gid").groupBy("phrase").agg(F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x.word), " ").alias("spelt"))
    rows = scored.join(spelt, "phrase").drop("phrase").withColumnRenamed("spelt", "phrase")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = rows.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return rows.filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
        F.col("score").cast("long").alias("score"))
