"""Benchmark decontamination by a prefix-filtered join on word shingles (operator 8).

Every benchmark item is cut into windows of ``size`` consecutive words (an item
of fewer words is one window).  A window is contained in a document only if all
its shingles are, so one shingle per window is a sufficient prefix: the rarest
by its count over all documents.  Documents are joined with these prefix
shingles; the place of the shingle in its window gives the one place where the
window could stand (positional bound), which must lie inside the document
(length bound), and all words are then compared.  Windows whose rarest shingle
occurs nowhere drop out before the join.

The windows are taken in blocks of ``block_windows``, the proven bound on what a
task holds of the benchmark; each further block is one more pass.

Null or wordless text: no words, no hit.  Null item text: no window.  A null
item_id marks words as hit but has no name to report.  Repeated items, doc_ids
and rows: each document row is judged by itself, an item is reported once.  Empty
tables: no rows, or no hits.  Extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statframe.llm.common import alnum_words, id_text, stored, text_groups

SHINGLE = 5
BLOCK_WINDOWS = 1 << 18

_MULT = np.uint64(0x9E3779B97F4A7C15)


def _windows(bench: DataFrame, size: int, item_col: str, text_col: str) -> DataFrame:
    """Distinct (window, item): the window's words joined by spaces."""

    def run(batches):
        for b in text_groups(batches):
            win, item = [], []
            for i, t in zip(b.column("item").to_pylist(), b.column("text").to_pylist()):
                words = alnum_words(t)
                for k in range(max(1, len(words) - size + 1) if words else 0):
                    win.append(b" ".join(words[k:k + size]))
                    item.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(win, pa.binary()),
                                              pa.array(item, pa.string())], names=["win", "item"])

    items = bench.select(F.col(f"`{item_col}`").cast("string").alias("item"),
                         F.col(f"`{text_col}`").cast("string").alias("text"))
    return items.filter(F.col("text").isNotNull()).mapInArrow(
        run, "win binary, item string").distinct()


def _rolled(ids: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of runs of ``width`` known words and a hash of each."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    unknown = np.concatenate([[0], np.cumsum(ids < 0)])
    at = np.flatnonzero(unknown[width:] == unknown[:-width])
    h = np.zeros(len(at), np.uint64)
    for j in range(width):
        h = (h ^ (h >> np.uint64(29))) * _MULT + (ids[at + j].astype(np.uint64) + np.uint64(1))
    return at, h


class _Block:
    """Windows of one block as word numbers, and their prefix shingles once counts are known."""

    def __init__(self, rows: list[tuple[bytes, str | None]], size: int):
        items = defaultdict(set)
        for win, item in rows:
            items[bytes(win)].add(item)
        wins = sorted(items)
        self.items = [sorted(i for i in items[w] if i is not None) for w in wins]
        words = [w.split(b" ") for w in wins]
        self.vocab = {w: k for k, w in enumerate(sorted({x for ws in words for x in ws}))}
        self.length = np.array([len(w) for w in words], np.int64)
        self.words = np.full((len(wins), size), -1, np.int64)
        for k, ws in enumerate(words):
            self.words[k, :len(ws)] = [self.vocab[x] for x in ws]
        self.width = np.minimum(self.length, SHINGLE)
        hashes = {}
        for width in np.unique(self.width).tolist():
            hashes[width] = np.unique(np.concatenate(
                [_rolled(self.words[k], width)[1] for k in np.flatnonzero(self.width == width)]))
        self.shingles = hashes

    def choose(self, counts: dict[tuple[int, int], int]) -> None:
        """Keep each window's rarest shingle (ties: the smaller hash)."""
        chosen = defaultdict(list)
        for k, width in enumerate(self.width.tolist()):
            at, h = _rolled(self.words[k], width)
            place = self.shingles[width].searchsorted(h).tolist()
            n, _, o = min((counts.get((width, p), 0), p, o) for p, o in zip(place, at.tolist()))
            if n:
                chosen[width].append((h[at.tolist().index(o)], k, o))
        self.prefix = {}
        for width, rows in chosen.items():
            rows.sort()
            h = np.array([r[0] for r in rows], np.uint64)
            keys, first = np.unique(h, return_index=True)
            self.prefix[width] = (keys, np.append(first, len(rows)),
                                  np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))
        self.shingles = None

    def numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of the texts one after another, an unknown word between two texts;
        where each text begins, and the end."""
        get, ids, begin = self.vocab.get, [], [0]
        for t in texts:
            ids += [get(w, -1) for w in alnum_words(t)]
            ids.append(-1)
            begin.append(len(ids))
        return np.array(ids, np.int64), np.array(begin, np.int64)

    def count(self, ids: np.ndarray, into: dict) -> None:
        for width, keys in self.shingles.items():
            h = _rolled(ids, width)[1]
            place = np.minimum(keys.searchsorted(h), len(keys) - 1)
            place, n = np.unique(place[keys[place] == h], return_counts=True)
            for p, c in zip(place.tolist(), n.tolist()):
                into[width, p] += c

    def hits(self, ids: np.ndarray):
        """(starts, windows): every place where a window stands."""
        starts, wins = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for width, (keys, first, win, offset) in self.prefix.items():
            at, h = _rolled(ids, width)
            place = np.minimum(keys.searchsorted(h), len(keys) - 1)
            found = keys[place] == h
            at, place = at[found], place[found]
            for lo in range(0, len(at), 1 << 14):
                p, k = at[lo:lo + (1 << 14)], place[lo:lo + (1 << 14)]
                n = first[k + 1] - first[k]
                row = np.repeat(first[k] - np.cumsum(n) + n, n) + np.arange(n.sum())
                w = win[row]
                s = np.repeat(p, n) - offset[row]
                inside = (s >= 0) & (s + self.length[w] <= len(ids))
                s, w = s[inside], w[inside]
                span = np.minimum(s[:, None] + np.arange(self.words.shape[1]), len(ids) - 1)
                same = ((ids[span] == self.words[w]) | (self.words[w] < 0)).all(axis=1)
                starts.append(s[same])
                wins.append(w[same])
        return np.concatenate(starts), np.concatenate(wins)


HITS = ("doc_id long, text string, n_words long, spans array<struct<start:long,end:long>>, "
        "item_ids array<string>")


def find_items(docs: DataFrame, bench: DataFrame, size: int = 10, id_col: str = "doc_id",
               text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
               block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """(doc_id, n_words, spans, item_ids) of every row of ``docs``: spans are the disjoint runs
    [start, end) of words inside any window's occurrence, item_ids the items found, sorted."""
    rows = id_text(docs, id_col, text_col)
    windows = stored(_windows(bench, size, item_col, item_text_col), "windows")
    n = windows.agg(F.count_distinct("win")).first()[0]
    n_blocks = max(1, -(-n // block_windows))
    out = rows.select("doc_id", "text", F.lit(0).cast("long").alias("n_words"),
                      F.expr("cast(array() as array<struct<start:long,end:long>>)").alias("spans"),
                      F.expr("cast(array() as array<string>)").alias("item_ids"))
    for k in range(n_blocks):
        mine = windows.filter(F.pmod(F.xxhash64("win"), F.lit(n_blocks)) == k)
        block = _Block([(r.win, r.item) for r in mine.collect()], size)
        block.choose(_counts(rows, block))
        out = out.mapInArrow(_probe(block), HITS)
        if k + 1 < n_blocks:  # one block of windows at a time in a task's memory
            out = stored(out, "hits")
    return out.select("doc_id", "n_words", "spans", "item_ids")


def _counts(rows: DataFrame, block: _Block) -> dict[tuple[int, int], int]:
    """Occurrences of the block's shingles over all documents."""

    def run(batches):
        into = defaultdict(int)
        for b in text_groups(batches):
            block.count(block.numbers(b.column("text").to_pylist())[0], into)
        keys = list(into)
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in keys], pa.int32()), pa.array([p for _, p in keys], pa.int32()),
             pa.array([into[x] for x in keys], pa.int64())], names=["width", "place", "n"])

    # at most one row per shingle of the block comes back
    got = rows.select("text").mapInArrow(run, "width int, place int, n long").groupBy(
        "width", "place").agg(F.sum("n").alias("n")).collect()
    return {(r.width, r.place): r.n for r in got}


def _probe(block: _Block):
    def run(batches):
        for b in text_groups(batches):
            d = b.to_pydict()
            ids, begin = block.numbers(d["text"])
            s, w = block.hits(ids)
            cover = np.zeros(len(ids) + 1, np.int64)
            np.add.at(cover, s, 1)
            np.add.at(cover, s + block.length[w], -1)
            doc = begin.searchsorted(s, side="right") - 1
            named = defaultdict(set)
            for k, win in np.unique(np.stack([doc, w]), axis=1).T.tolist():
                named[k].update(block.items[win])
            inside = (np.cumsum(cover) > 0).astype(np.int8)
            for k in np.unique(doc).tolist():
                own = inside[begin[k]:begin[k + 1]].copy()
                for old in d["spans"][k]:
                    own[old["start"]:old["end"]] = 1
                edge = np.flatnonzero(np.diff(own, prepend=0, append=0))
                d["spans"][k] = [{"start": i, "end": j}
                                 for i, j in zip(edge[::2].tolist(), edge[1::2].tolist())]
                d["item_ids"][k] = sorted(named[k].union(d["item_ids"][k]))
            n = (np.diff(begin) - 1).tolist()
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text"), pa.array(n, pa.int64()),
                 pa.array(d["spans"], span), pa.array(d["item_ids"], pa.list_(pa.string()))],
                names=["doc_id", "text", "n_words", "spans", "item_ids"])

    return run
