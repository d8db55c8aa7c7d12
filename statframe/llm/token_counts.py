"""Token counts by a compiled finite-state transducer (operator 1).

A byte-level BPE vocabulary is compiled into a deterministic transducer: its
transitions carry the number of tokens that the step adds to the count, so the
count of a word is the sum along its path.  States are built the first time
they are needed and are shared by all words that behave alike from there on.

A text longer than ``chunk_chars`` is cut into chunks that are spread over the
cluster.  Each chunk becomes a state map, kept in factored form: behind the
first place where the tokenizer forgets its state, the map no longer depends on
the entry state, so ``head`` is what still has to run from the entry state,
``count`` is fixed, and ``tail`` is the state at the end (the unfinished text).
Maps compose associatively; a scan in two rounds of ``FAN`` joins all maps of a
document.

Null text: empty, 0 tokens.  Null or repeated doc_id: each row is counted on
its own.  Empty input: empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statframe.llm.common import id_text, text_groups
from statframe.llm.token_cache import _LOADED, TEXT_BYTES, IdCache, PieceCache

#: a document's chunks are joined in two rounds of this many maps: FAN**2 chunks of
#: CHUNK_CHARS characters are more than a row can hold
FAN = 256
CHUNK_CHARS = 1 << 16
#: the tokenizer is in its start state between a letter and the white space after it
FORGETS = re.compile(r"(?<=[A-Za-z])(?=[ \n])")
#: words that go through the transducer together, and how few of them go on one by one
TOGETHER, ALONE = 1 << 16, 16


def _byte_alphabet() -> dict[str, int]:
    """Character by which byte-level vocabularies write each byte: printable Latin-1 characters
    stand for themselves, the other bytes follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Transducer:
    """Deterministic transducer of one BPE vocabulary over bytes.

    The encoding of a word's prefix is fixed by its last token and the encoding before that
    token, and exactly one token fits: the one whose seam to the token before it is never
    merged over.  A state therefore holds the longest suffix that can still grow into a token
    and, for each place in it, the last token of the prefix ending there and that prefix's
    token count against the current one.
    """

    def __init__(self, path: str, most_states: int = 200_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = _byte_alphabet()
        raw = {s: bytes(alphabet[c] for c in s) for s in spec["model"]["vocab"]}
        ids = spec["model"]["vocab"]
        self.tokens = {raw[s]: i for s, i in ids.items()}
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.rank: dict[tuple[int, int], int] = {}
        parts: dict[int, tuple[int, int, int]] = {}
        for r, merge in enumerate(spec["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.rank[ids[a], ids[b]] = r
            parts.setdefault(ids[a + b], (ids[a], ids[b], r))
        self.parts = parts
        self.grows = {t[:n] for t in self.tokens for n in range(1, len(t) + 1)}
        self.seam: dict[tuple[int, int], bool] = {}
        self.edges: dict[tuple[int, int], list[tuple[int, float]]] = {}
        self.most_states = most_states
        self._reset()

    def _reset(self) -> None:
        start = (b"", (-1,), (0,))
        self.states, self.number, self.step = [start], {start: 0}, {}

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """Pieces at a token's left (0) or right (1) end as merging goes on, each with the rank
        of the merge that takes it up."""
        out = self.edges.get((token, side))
        if out is None:
            out = self.edges[token, side] = [(token, float("inf"))]
            while token in self.parts:
                taken = self.parts[token][2]
                token = self.parts[token][side]
                out.append((token, taken))
        return out

    def holds(self, a: int, b: int) -> bool:
        """Whether ``a`` and ``b`` stay two tokens when they stand next to each other."""
        got = self.seam.get((a, b))
        if got is None:
            got = True
            left = self._edge(b, 0)
            for x, until_x in self._edge(a, 1):
                for y, until_y in left:
                    r = self.rank.get((x, y))
                    # at equal rank the merge further left comes first
                    if r is not None and r < until_x and r <= until_y:
                        got = False
            if len(self.seam) > 2 * self.most_states:
                self.seam.clear()
            self.seam[a, b] = got
        return got

    def _build(self, state: int, byte: int) -> int:
        suffix, last, rel = self.states[state]
        grown = suffix + bytes((byte,))
        while grown not in self.grows:
            grown = grown[1:]
        for n in range(len(grown), 0, -1):
            token = self.tokens.get(grown[-n:])
            if token is not None and (last[n - 1] < 0 or self.holds(last[n - 1], token)):
                break
        else:
            raise ValueError("the vocabulary lacks a single-byte token")
        emitted = rel[n - 1] + 1
        m = len(grown)
        new = (grown, (token, *last[:m]), (0, *(r - emitted for r in rel[:m])))
        to = self.number.get(new)
        if to is None:
            to = self.number[new] = len(self.states)
            self.states.append(new)
        # the next state and the emitted count share one integer
        self.step[state << 8 | byte] = got = to << 16 | (emitted + 32768)
        return got

    def count(self, word: bytes) -> int:
        """Tokens of one pre-token: the sum of the counts along its path."""
        if len(self.states) > self.most_states:
            self._reset()
        return self._rest(0, word)

    def _rest(self, state: int, word: bytes) -> int:
        total, step = 0, self.step
        for byte in word:
            got = step.get(state << 8 | byte)
            if got is None:
                got = self._build(state, byte)
            state = got >> 16
            total += (got & 0xFFFF) - 32768
        return total

    def counts(self, words: list[bytes]) -> np.ndarray:
        """``count`` of many words, which go along their paths together: a transition that several of
        them take is looked up once."""
        out = np.zeros(len(words), np.int64)
        for lo in range(0, len(words), TOGETHER):
            if len(self.states) > self.most_states:
                self._reset()
            part = words[lo:lo + TOGETHER]
            size = np.fromiter(map(len, part), np.int64, len(part))
            order = np.argsort(-size, kind="stable")
            start = (np.cumsum(size) - size)[order]
            data = np.frombuffer(b"".join(part), np.uint8)
            running = np.searchsorted(-size[order], -np.arange(size.max()), side="left").tolist()
            state, total = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
            step, build = self.step, self._build
            for j, n in enumerate(running):
                if n < ALONE:
                    for k in range(n):
                        total[k] += self._rest(int(state[k]), part[order[k]][j:])
                    break
                key, back = np.unique(state[:n] << 8 | data[start[:n] + j], return_inverse=True)
                got = np.array([step.get(k) or build(k >> 8, k & 255) for k in key.tolist()],
                               np.int64)[back]
                state[:n] = got >> 16
                total[:n] += (got & 0xFFFF) - 32768
            out[lo + order] = total
        return out


class CountCache(IdCache):
    """Token counts of whole columns of texts: as ``IdCache``, where one number, the count of its tokens,
    stands for the ids of a word or piece."""

    def __init__(self, fst: Transducer, pattern, most: int = 500_000):
        PieceCache.__init__(self, self._solve, b"".join, most // 8)
        self.fst, self.pattern, self.most = fst, pattern, most
        self.line = fst.counts([b"\n"]).tolist()
        self._keep(pa.array([], pa.string()), np.empty(0, "<u4"), np.empty(0, np.int64))

    def _summed(self, pieces: list[str], ends: np.ndarray) -> np.ndarray:
        """Counts of consecutive pre-tokens, added up before each end."""
        coded = pa.array(pieces, pa.string()).dictionary_encode()
        own = self.fst.counts([w.encode() for w in coded.dictionary.to_pylist()])
        total = np.append(0, np.cumsum(own[coded.indices.to_numpy()] if len(pieces) else own))[ends]
        return np.diff(total, prepend=0)

    def _solve(self, pieces: list[str]) -> list[bytes]:
        found = [self.pattern.findall(p.encode("utf-8", "replace").decode()) for p in pieces]
        ends = np.cumsum([len(f) for f in found], dtype=np.int64)
        return [n.tobytes() for n in self._summed([w for f in found for w in f], ends).astype("<u4")]

    def _lines(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """One count for each of ``words`` without white space, which may have a blank before them."""
        if not words:
            return self._flat([])
        found = self.pattern.findall("\n".join(words) + "\n")
        ends = np.flatnonzero(pc.equal(pa.array(found, pa.string()), "\n").to_numpy(zero_copy_only=False))
        if len(ends) != len(words):  # a line end became part of another pre-token
            return self._flat(self._solve(words))
        n = self._summed(found, ends)
        n[1:] -= self.line[0]  # the line end before it
        return n.astype("<u4"), np.ones(len(words), np.int64)


class Counter:
    """Counts of whole texts: pre-tokens by the vocabulary's pattern, each through the
    transducer, remembered by word and by piece."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex

        self.fst = Transducer(path)
        self.cache = CountCache(self.fst, regex.compile(public_tokenizers.PATTERN))
        self.special = re.compile("|".join(map(re.escape, self.fst.special))) \
            if self.fst.special else None

    def whole(self, texts: list[str]) -> list[int]:
        parts = [self.special.split(t) if self.special else [t] for t in texts]
        got = iter(self.cache.whole([x for p in parts for x in p]))
        # between two parts stands one special token
        return [sum(int(np.frombuffer(next(got), "<u4").sum()) for _ in p) + len(p) - 1 for p in parts]

    def column(self, texts: pa.Array) -> np.ndarray:
        """``whole`` of a column of texts; those that hold a special string are split at it."""
        special = np.zeros(len(texts), bool)
        for s in self.fst.special:
            special |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        n, ends = self.cache.batch(pc.if_else(pa.array(special), "", texts) if special.any() else texts)
        out = np.diff(np.append(0, np.cumsum(n, dtype=np.int64))[ends], prepend=0)
        at = np.flatnonzero(special)
        out[at] = self.whole(texts.take(pa.array(at)).to_pylist())
        return out

    def state_map(self, chunk: str) -> tuple[str, int, str | None]:
        """(head, count, tail); tail None when the chunk never forgets its entry state."""
        cuts = [m.start() for m in FORGETS.finditer(chunk)]
        if not cuts:
            return chunk, 0, None
        lo, hi = cuts[0], cuts[-1]
        return chunk[:lo], self.whole([chunk[lo:hi]])[0], chunk[hi:]

    def compose(self, maps) -> tuple[str, int, str | None]:
        """The map of consecutive chunks."""
        head, count, tail = "", 0, None
        open_: list[str] = []
        for h, n, t in maps:
            open_.append(h)
            if t is None:
                continue
            between = "".join(open_)
            if tail is None:
                head = between
            else:
                count += self.whole([between])[0]
            count += n
            tail, open_ = t, [t]
        return (head, count, "".join(open_)) if tail is not None else ("".join(open_), 0, None)


def counter(path: str) -> Counter:
    key = f"count:{path}"
    if key not in _LOADED:
        _LOADED[key] = Counter(path)
    return _LOADED[key]


def token_counts(docs: DataFrame, vocab: str, id_col: str = "doc_id", text_col: str = "text",
                 chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row of ``docs``; ``vocab`` is a byte-level BPE
    ``.json`` file that every worker can read at that path."""
    rows = id_text(docs, id_col, text_col).select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    is_long = F.char_length("text") > chunk_chars

    def direct(batches):
        c = counter(vocab)
        for b in text_groups(batches, TEXT_BYTES):
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("n_bytes"), pa.array(c.column(b.column("text")), pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"])

    short = rows.filter(~is_long).mapInArrow(
        direct, "doc_id long, n_bytes long, n_tokens long")

    def chunks(batches):
        from pyspark import TaskContext

        at, k = TaskContext.get().partitionId() << 33, 0
        for b in text_groups(batches):
            for doc, size, text in zip(*(c.to_pylist() for c in b.columns)):
                cut = [text[i:i + chunk_chars] for i in range(0, len(text), chunk_chars)]
                n = len(cut)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at + k] * n, pa.int64()), pa.array([doc] * n, pa.int64()),
                     pa.array([size] * n, pa.int64()), pa.array(range(n), pa.int32()),
                     pa.array(cut, pa.string())],
                    names=["row", "doc_id", "n_bytes", "part", "chunk"])
                k += 1

    def maps(batches):
        c = counter(vocab)
        for b in text_groups(batches, column="chunk"):
            got = [c.state_map(x) for x in b.column("chunk").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:4], pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.int64()),
                 pa.array([g[2] for g in got], pa.string())],
                names=["row", "doc_id", "n_bytes", "part", "head", "count", "tail"])

    schema = "row long, doc_id long, n_bytes long, part int, head string, count long, tail string"

    def join_maps(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        tails = [t if isinstance(t, str) else None for t in pdf["tail"]]
        h, n, t = counter(vocab).compose(zip(pdf["head"], pdf["count"], tails))
        first = pdf.iloc[:1].copy()
        first["part"] = int(first["part"].iloc[0]) // FAN
        first["head"], first["count"], first["tail"] = h, n, t
        return first

    def run_maps(batches):
        c = counter(vocab)
        for b in text_groups(batches, column="head"):
            d = b.to_pydict()
            ends = c.whole(d["head"]), c.whole([t or "" for t in d["tail"]])
            n = [x + y + z for x, y, z in zip(d["count"], *ends)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("n_bytes"), pa.array(n, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"])

    long = (rows.filter(is_long)
            .mapInArrow(chunks, "row long, doc_id long, n_bytes long, part int, chunk string")
            .repartition(F.col("row"), F.col("part")).mapInArrow(maps, schema))
    for _ in range(2):  # the scan: FAN**2 chunks per document at most
        long = long.groupBy("row", F.expr(f"part div {FAN}")).applyInPandas(join_maps, schema)
    return short.unionByName(long.mapInArrow(run_maps, short.schema))
