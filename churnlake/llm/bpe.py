"""Byte-level BPE by speculation and verification.

A word's tokens are proposed by greedy longest match. BPE applies the lowest-ranked merge first,
so a sequence of tokens is what it would give exactly if no merge ever reaches across the border of two neighbours. The
pieces that stand at a border over time are the right spine of the left token's merge tree
and the left spine of the right one's; a merge m of two such pieces happens if it ranks below the merges that
consume them (on a tie the left one goes first). All new adjacent pairs of a batch are checked at once with NumPy over the spines. Only
words with a pair that fails are merged exactly.
"""

from __future__ import annotations

import heapq
import json
import re
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from churnlake.llm.common import text_batches

NEVER = np.iinfo(np.int32).max
#: Fixed value: the published pattern that splits a text into words before the merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# The same where all characters are below U+0250: there these are the letters, numbers and white space of Unicode.
_L, _N, _S = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be", "\t-\r \u0085\u00a0"
PLAIN_SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
GAP = "\u0100"  # stands between words in which every byte is one character
CACHED_WORDS, CACHED_PAIRS = 100_000, 100_000
CHUNK_CHARS = 1_000_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary: itself if printable, else one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@dataclass
class Vocabulary:
    tokens: dict[bytes, int]  # text of a token -> id
    pieces: list[bytes]  # id -> text, special tokens included
    merges: dict[tuple[int, int], tuple[int, int]]  # pair of ids -> rank, merged id
    special: dict[str, int]

def read_vocabulary(path: str) -> Vocabulary:
    """A ``tokenizers`` JSON file of a byte-level BPE, read on the driver and broadcast (its size is the file's)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters = byte_letters()
    text = lambda t: bytes(letters[c] for c in t)
    vocab = spec["model"]["vocab"]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens = {text(t): i for t, i in vocab.items() if t not in special}
    pieces = [b""] * (1 + max([*tokens.values(), *special.values()]))
    for t, i in tokens.items():
        pieces[i] = t
    for t, i in special.items():
        pieces[i] = t.encode()
    merges = {}
    for rank, m in enumerate(spec["model"]["merges"]):
        a, b = m if isinstance(m, list) else m.split(" ")
        a, b = text(a), text(b)
        merges.setdefault((tokens[a], tokens[b]), (rank, tokens[a + b]))
    return Vocabulary(tokens, pieces, merges, special)


def merge_exactly(ids: list[int], merges: dict) -> list[int]:
    """Apply the lowest-ranked, leftmost merge until none is left."""
    return _merge_long(ids, merges) if len(ids) > 64 else _merge_short(ids, merges)


def _merge_short(ids: list[int], merges: dict) -> list[int]:
    """By scanning all pairs for each merge: the quicker way for words of usual length."""
    find = merges.get
    pairs = list(map(find, zip(ids, ids[1:])))
    while best := min(filter(None, pairs), default=None):
        k = pairs.index(best)
        ids[k : k + 2] = [best[1]]
        del pairs[k]
        if k:
            pairs[k - 1] = find((ids[k - 1], ids[k]))
        if k < len(pairs):
            pairs[k] = find((ids[k], ids[k + 1]))
    return ids


def _merge_long(ids: list[int], merges: dict) -> list[int]:
    """With a heap of pairs over a linked list: n log n for a word of n bytes."""
    nxt, prev = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
    ids = [*ids, -1]
    n = len(ids) - 1
    heap = [(*merges[a, b], k, a, b) for k, (a, b) in enumerate(zip(ids, ids[1:n])) if (a, b) in merges]
    heap = [(rank, k, new, a, b) for rank, new, k, a, b in heap]
    heapq.heapify(heap)
    while heap:
        _, k, new, a, b = heapq.heappop(heap)
        j = nxt[k] if ids[k] == a else n
        if j >= n or ids[j] != b:
            continue  # one of the two has been merged meanwhile
        ids[k], ids[j], nxt[k] = new, -1, nxt[j]
        if nxt[k] < n:
            prev[nxt[k]] = k
        for left in (prev[k], k):
            right = nxt[left] if left >= 0 else n
            if left >= 0 and right < n and (m := merges.get((ids[left], ids[right]))):
                heapq.heappush(heap, (m[0], left, m[1], ids[left], ids[right]))
    return [t for t in ids if t >= 0]


class Encoder:
    """Encodes words; keeps the words and pairs it has seen, up to a bound. Of the vocabulary it keeps what words still need:
    each Python worker of an executor holds an encoder."""

    def __init__(self, vocabulary: Vocabulary):
        v = vocabulary
        self.pieces, self.merges, self.special, self.size = v.pieces, v.merges, v.special, len(v.pieces)
        self.base = [v.tokens[bytes([b])] for b in range(256)]
        self.longest = ahocorasick.Automaton()
        for t, i in v.tokens.items():
            self.longest.add_word(t.decode("latin-1"), i)
        self.longest.add_word(GAP, -1)
        self.longest.make_automaton()
        keys = np.array([a * self.size + b for a, b in v.merges], dtype=np.int64)
        ranks = np.array([r for r, _ in v.merges.values()], dtype=np.int32)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], ranks[order]
        self.made = self._made()
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.any_split, self.plain_split, self.plain = regex.compile(SPLIT).findall, re.compile(PLAIN_SPLIT).findall, re.compile("[\0-\u024f]*").fullmatch
        self.parts = regex.compile("(" + "|".join(map(regex.escape, sorted(v.special, key=len, reverse=True))) + ")").split if v.special else lambda t: [t]

    def _made(self) -> np.ndarray:
        """By id: the lowest rank that makes a token (-1: none), and its left and right piece. Followed from piece to piece, these are
        the spines along a token's edges, outermost first, with the rank that consumes each piece."""
        made = np.full((3, self.size), -1, dtype=np.int32)
        for (a, b), (rank, new) in self.merges.items():
            if made[0, new] < 0 or rank < made[0, new]:
                made[:, new] = rank, a, b
        return made

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of tokens: does no merge reach across their border?"""
        ok = np.ones(len(a), dtype=bool)
        rank, left, right = self.made
        rows, x, x_used = np.arange(len(a)), a, np.full(len(a), NEVER)
        while len(rows):
            at, y, y_used = np.arange(len(rows)), b[rows], np.full(len(rows), NEVER)
            while len(at):
                key = x[at].astype(np.int64) * self.size + y
                place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                m = self.ranks[place]
                ok[rows[at[(self.keys[place] == key) & (m < x_used[at]) & (m <= y_used)]]] = False
                more = rank[y] >= 0
                at, y, y_used = at[more], left[y[more]], rank[y[more]]
            more = rank[x] >= 0
            rows, x, x_used = rows[more], right[x[more]], rank[x[more]]
        return ok

    def propose(self, words: list[bytes]) -> tuple[list[int], list[int]]:
        """Greedy longest match of all words in one pass: the tokens, and how many each word has."""
        joined = GAP.join(w.decode("latin-1") for w in words)
        ids = [t for _, t in self.longest.iter_long(joined)]
        sizes = np.diff(np.flatnonzero(np.array([*[-1], *ids, -1]) < 0)) - 1
        return [t for t in ids if t >= 0], sizes.tolist()

    def learn(self, words: list[str]) -> None:
        """Encode new words: propose, check every adjacent pair, merge exactly where one fails."""
        raw = [w.encode() for w in words]
        flat, sizes = self.propose(raw)
        flat, sizes = np.array(flat, dtype=np.int64), np.array(sizes)
        ends = np.cumsum(sizes)
        inner = np.ones(len(flat) - 1, dtype=bool)
        inner[ends[:-1] - 1] = False
        pair = flat[:-1][inner] * self.size + flat[1:][inner]
        owner = np.repeat(np.arange(len(words)), sizes - 1)
        unique, where = np.unique(pair, return_inverse=True)
        known = [self.pairs.get(k) for k in unique.tolist()]
        new = np.array([k for k, x in enumerate(known) if x is None], dtype=np.int64)
        good = np.array([bool(x) for x in known], dtype=bool)
        if len(new):
            good[new] = self.compatible(unique[new] // self.size, unique[new] % self.size)
            if len(self.pairs) > CACHED_PAIRS:
                self.pairs.clear()
            self.pairs.update(zip(unique[new].tolist(), good[new].tolist()))
        packed = flat.astype("<u4").tobytes()
        ends = (4 * ends).tolist()
        self.words.update((w, packed[a:b]) for w, a, b in zip(words, [0, *ends], ends))
        base = self.base
        for k in np.unique(owner[~good[where]]).tolist() if len(pair) else []:
            ids = merge_exactly([base[c] for c in raw[k]], self.merges)
            self.words[words[k]] = struct.pack(f"<{len(ids)}I", *ids)

    def split(self, text: str) -> list[str]:
        """The words that are merged each for itself; texts of Latin letters take the quicker pattern."""
        return self.plain_split(text) if self.plain(text) else self.any_split(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        out, at = [], 0
        while at < len(texts):
            parts, size = [], 0
            while at < len(texts) and size < CHUNK_CHARS:
                parts.append([p if k % 2 else self.split(p) for k, p in enumerate(self.parts(texts[at]))])
                size += len(texts[at])
                at += 1
            if len(self.words) > CACHED_WORDS:
                self.words.clear()
            new = {w: None for doc in parts for p in doc if not isinstance(p, str) for w in p if w not in self.words}
            if new:
                self.learn(list(new))
            for doc in parts:
                out.append(b"".join(self.special[p].to_bytes(4, "little") if isinstance(p, str) else b"".join(map(self.words.__getitem__, p)) for p in doc))
        return out


def _mapped(df: DataFrame, source: str, added: dict[str, T.DataType], start: Callable[[], Callable[[list], list[list]]]) -> DataFrame:
    """``df`` with new columns (replacing any of their names), computed slice by slice from the values of one column."""
    kept = [c for c in df.columns if c not in added]
    schema = T.StructType([*df.select(*kept).schema.fields, *(T.StructField(c, t) for c, t in added.items())])
    types = [pa.binary() if isinstance(t, T.BinaryType) else pa.string() for t in added.values()]
    place = kept.index(source) if source in kept else None
    names = [*kept, *added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for b in batches:
            made = work(b.column(len(kept) if place is None else place).to_pylist())
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(len(kept))), *(pa.array(v, t) for v, t in zip(made, types))], names=names)

    text_batches(df.sparkSession)
    return df.select(*kept, *([] if source in kept else [source])).mapInArrow(run, schema)


def _encoder(sent: Broadcast) -> Encoder:
    held = sent.value  # a Python worker keeps it from task to task, and the encoder with it
    if "encoder" not in held:
        held["encoder"] = Encoder(Vocabulary(**{k: held.pop(k) for k in [*held]}))
    return held["encoder"]


def text_of(packed: bytes | None, pieces: list[bytes]) -> str:
    """The text of packed ids; ids outside the vocabulary have none, bytes that are no UTF-8 become U+FFFD."""
    ids, n = np.frombuffer(packed or b"", dtype="<u4"), len(pieces)
    return b"".join(map(pieces.__getitem__, ids[ids < n].tolist())).decode("utf-8", "replace")


def encode(docs: DataFrame, vocabulary_path: str, text_col: str = "text", ids_col: str = "token_ids") -> DataFrame:
    """``docs`` with ``ids_col``: the whole text's token ids as packed little-endian unsigned 32-bit integers.

    Null and empty texts have no ids (empty binary). Special tokens written out in a text are
    recognised, none is added. An existing column named ``ids_col`` is replaced. All other columns pass through.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vars(read_vocabulary(vocabulary_path)))

    def start():
        encoder = _encoder(sent)
        return lambda texts: [encoder.encode([t or "" for t in texts])]

    return _mapped(docs, text_col, {ids_col: T.BinaryType()}, start)


def decode(tokens: DataFrame, vocabulary_path: str, ids_col: str = "token_ids", out_col: str = "decoded") -> DataFrame:
    """``tokens`` with ``out_col``: the text of packed ids, special tokens included; null ids give empty text."""
    sent = tokens.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path).pieces)

    def start():
        return lambda packed: [[text_of(x, sent.value) for x in packed]]

    return _mapped(tokens, ids_col, {out_col: T.StringType()}, start)


def round_trip(docs: DataFrame, vocabulary_path: str, text_col: str = "text", ids_col: str = "token_ids", out_col: str = "decoded") -> DataFrame:
    """``docs`` with ``ids_col`` as ``encode`` gives it and ``out_col``, what ``decode`` makes of the ids, in one pass.

    ``out_col`` may be ``text_col``: the text is then replaced by the decoded one.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vars(read_vocabulary(vocabulary_path)))

    def start():
        encoder = _encoder(sent)

        def work(texts: list) -> list[list]:
            ids = encoder.encode([t or "" for t in texts])
            return [ids, [text_of(x, encoder.pieces) for x in ids]]

        return work

    return _mapped(docs, text_col, {ids_col: T.BinaryType(), out_col: T.StringType()}, start)
