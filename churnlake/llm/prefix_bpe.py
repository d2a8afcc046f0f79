"""Byte-level BPE by dynamic programming over byte prefixes.

The encoding of a word's prefix of i bytes ends in one token, and that token is unique: of the tokens that end at i, the
one whose left neighbour - the last token of the prefix before it - may stand next to it. Two tokens may stand side by side
if no merge reaches across their border at any time: undoing the later of the two tokens' last merges step by step
passes through all pairs of pieces that ever met there, and none of them may be merged by a rank below the
merges that consumed them (on a tie the left one goes first). One pass over a word fills the
table; walking back from its end gives the tokens.

The table of a prefix does not depend on what follows. So a text can be appended to without encoding it again, and after
an edit only the entries near it change: as soon as as many entries in a row as the longest token has bytes
are those of the old text, all the rest are (``PrefixTable``).
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import regex
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from churnlake.llm.bpe import PLAIN_SPLIT, SPLIT
from churnlake.llm.common import with_made_columns

NEVER = 1 << 31
GAP = "Ā"  # stands between words in which every byte is one character
CACHED_WORDS, CACHED_PAIRS = 120_000, 400_000
CHUNK_CHARS = 1_000_000


@dataclass
class Ranks:
    """Tokens by id, where the id is the rank; ``left`` and ``right`` are the ids a token is merged from (-1: a single byte)."""

    pieces: list[bytes]
    left: list[int]
    right: list[int]
    reached: list[bool]  # whether merging a token's bytes leads to it


def merged(word: bytes, ranks: dict[bytes, int], below: int = NEVER) -> list[bytes]:
    """Merge the neighbours of the lowest rank, leftmost first, while that rank is less than ``below``."""
    parts = [word[k : k + 1] for k in range(len(word))]
    while len(parts) > 1:
        found = [ranks.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        best = min(found)
        if best >= below:
            break
        k = found.index(best)
        parts[k : k + 2] = [parts[k] + parts[k + 1]]
    return parts


def read_ranks(path: str) -> Ranks:
    """A rank file (base64 of a token, its rank) read on the driver. Every byte must be a token; ranks are 0, 1, 2, ..."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, map(bytes.strip, f)))}
    pieces = sorted(ranks, key=ranks.__getitem__)
    if [ranks[p] for p in pieces] != list(range(len(pieces))) or any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("ranks must be 0, 1, 2, ... and every byte a token")
    left, right, reached = [-1] * len(pieces), [-1] * len(pieces), [True] * len(pieces)
    for t, p in enumerate(pieces):
        if len(p) > 1:
            parts = merged(p, ranks, t)
            reached[t] = len(parts) == 2
            if reached[t]:
                left[t], right[t] = ranks[parts[0]], ranks[parts[1]]
    return Ranks(pieces, left, right, reached)


class Encoder:
    """Fills prefix tables; keeps the words and pairs it has seen, up to a bound."""

    def __init__(self, ranks: Ranks, pattern: str):
        self.pieces, self.left, self.right = ranks.pieces, ranks.left, ranks.right
        self.n = len(self.pieces)
        self.size = list(map(len, self.pieces))
        self.longest = max(self.size)
        self.whole = {p: t for t, p in enumerate(self.pieces)}
        self.pair = {(a, b): t for t, (a, b) in enumerate(zip(self.left, self.right)) if a >= 0}
        self.ending = ahocorasick.Automaton()
        for t, p in enumerate(self.pieces):
            if ranks.reached[t]:
                self.ending.add_word(p.decode("latin-1"), t)
        self.ending.make_automaton()
        self.beside: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pattern = regex.compile(pattern)
        self.plain_split = re.compile(PLAIN_SPLIT).findall if pattern == SPLIT else None
        self.plain = re.compile("[\0-ɏ]*").fullmatch

    def may_stand(self, a: int, b: int) -> bool:
        """Whether no merge reaches across the border of the neighbours a and b."""
        key = a * self.n + b
        known = self.beside.get(key)
        if known is None:
            if len(self.beside) > CACHED_PAIRS:
                self.beside.clear()
            known = self.beside[key] = self._may_stand(a, b)
        return known

    def _may_stand(self, a: int, b: int) -> bool:
        left, right, pair = self.left, self.right, self.pair
        a_until = b_until = NEVER  # the ranks that consume the two pieces
        while True:
            m = pair.get((a, b), NEVER)
            if m < a_until and m <= b_until and m < NEVER:
                return False
            made_a, made_b = a if right[a] >= 0 else -1, b if left[b] >= 0 else -1
            if made_a < 0 and made_b < 0:
                return True
            if made_b >= made_a:
                b_until, b = b, left[b]
            else:
                a_until, a = a, right[a]

    def fill(self, joined: str) -> list[int]:
        """Of every character the last token of its word's prefix up to it; -1 for GAP, which stands between words, and at the end."""
        last, done, size, n, known = [-1] * (len(joined) + 1), -1, self.size, self.n, self.beside
        for end, t in self.ending.iter(joined):  # longer tokens first
            if end != done:
                before = last[end - size[t]]  # -1 where the token begins the word
                if before >= 0:
                    try:
                        if not known[before * n + t]:
                            continue
                    except KeyError:
                        if not self.may_stand(before, t):
                            continue
                last[end] = t
                done = end
        return last

    def walk(self, last: list[int], begin: int, end: int) -> list[int]:
        """The tokens of the word between two places of a filled table."""
        ids, size, k = [], self.size, end - 1
        while k >= begin:
            t = last[k]
            ids.append(t)
            k -= size[t]
        ids.reverse()
        return ids

    def learn(self, words: set[str]) -> None:
        """Encode new words and keep them."""
        whole, found, rest, raw = self.whole, self.words, [], []
        for w in words:
            if (packed := self.older.get(w)) is not None:
                found[w] = packed
            elif (t := whole.get(r := w.encode())) is not None:  # a word that is a token stays one, even if merging never leads to it
                found[w] = t.to_bytes(4, "little")
            else:
                rest.append(w)
                raw.append(r)
        last, at = self.fill(GAP.join([r.decode("latin-1") for r in raw])), 0
        for w, r in zip(rest, raw):
            found[w] = array("I", self.walk(last, at, at + len(r))).tobytes()
            at += len(r) + 1

    def split(self, text: str) -> list[str]:
        """The words, each encoded for itself; texts of Latin letters take a quicker pattern where there is one."""
        return self.plain_split(text) if self.plain_split and self.plain(text) else self.pattern.findall(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        out, at = [], 0
        while at < len(texts):
            split, size = [], 0
            while at < len(texts) and size < CHUNK_CHARS:
                split.append(self.split(texts[at]))
                size += len(texts[at])
                at += 1
            needed = set().union(*split)
            new = needed.difference(self.words)
            if len(self.words) + len(new) > CACHED_WORDS:  # of two generations of known words the older goes when the newer is full
                self.older, self.words, new = self.words, {}, needed
            self.learn(new)
            out.extend([b"".join(map(self.words.__getitem__, words)) for words in split])
        return out

    def decode(self, packed: bytes | None) -> bytes:
        """The bytes of packed ids; ids outside the vocabulary have none."""
        ids = np.frombuffer(packed or b"", dtype="<u4")
        return b"".join(map(self.pieces.__getitem__, ids[ids < self.n].tolist()))


class PrefixTable:
    """A text with the last token of each byte prefix of each of its words; the last byte of a word holds ~token.

    ``replace`` gives the same table as a new one of the changed text, and encodes only what the change can reach. The
    pattern must look at most two characters beyond a match and never behind it, as the published one does.
    """

    def __init__(self, encoder: Encoder, text: str = "", last: np.ndarray | None = None):
        self.encoder, self.text = encoder, text
        self.filled = 0  # entries worked out by the last change
        if last is None:
            last = np.concatenate([np.zeros(0, np.int32), *(self._closed(w.encode()) for w in encoder.pattern.findall(text))])
        self.last = last.astype(np.int32)

    def _closed(self, word: bytes, table: np.ndarray | None = None) -> np.ndarray:
        if table is None:
            table = np.array(self.encoder.fill(word.decode("latin-1"))[:-1], np.int32)
            self.filled += len(word)
        whole = self.encoder.whole.get(word)
        table[-1] = ~(table[-1] if whole is None else whole)
        return table

    def _word(self, word: bytes, old: np.ndarray, same: int, shift: int) -> np.ndarray:
        """A word's table where ``old`` is that of the word it came from: the first ``same`` bytes are unchanged, and from ``same`` on
        byte k equals the old byte k - shift once the change is passed (``shift`` beyond the word: never)."""
        e = self.encoder
        old = np.where(old < 0, ~old, old)
        if len(word) <= e.longest or not same and shift >= len(word):
            return self._closed(word)
        if len(old) and e.whole.get(word) is not None:
            return self._closed(word)
        table = np.full(len(word), -1, np.int32)
        table[:same] = old[:same]
        begin, done, run = max(0, same - e.longest), same, 0
        for at, t in e.ending.iter(word[begin:].decode("latin-1")):
            end = begin + at + 1
            if end <= done:
                continue
            before = end - e.size[t]
            if before >= 0 and (before == 0 or e.may_stand(int(table[before - 1]), t)):
                table[end - 1], done = t, end
                self.filled += 1
                k = end - 1 - shift
                run = run + 1 if 0 <= k < len(old) and old[k] == t else 0
                if run > e.longest and end - run >= self._changed and len(word) - shift == len(old):
                    table[end:] = old[k + 1 :]
                    break
        return self._closed(word, table)

    def replace(self, begin: int, end: int, new: str) -> None:
        """Put ``new`` in the place of the characters from ``begin`` to ``end``."""
        text, self.filled = self.text, 0
        self.text = text[:begin] + new + text[end:]
        first, cut = len(text[:begin].encode()), len(text[begin:end].encode())
        shift = len(new.encode()) - cut
        ends = np.flatnonzero(self.last < 0) + 1
        safe = len(text[: max(0, begin - 2)].encode())
        k = np.searchsorted(ends, safe, side="right")
        at = int(ends[k - 1]) if k else 0
        out, start = [self.last[:at]], at
        whole_old = set(ends.tolist()) if len(ends) < 64 else None
        is_end = (lambda x: x in whole_old) if whole_old is not None else lambda x: x <= len(self.last) and x > 0 and self.last[x - 1] < 0
        tail = None
        for m in self.encoder.pattern.finditer(self.text, len(self.text.encode()[:at].decode())):
            word = m[0].encode()
            stop = start + len(word)
            old_start = start if start <= first else start - shift
            old = np.zeros(0, np.int32)
            if old_start <= first and (old_start == 0 or is_end(old_start)):
                j = np.searchsorted(ends, old_start, side="right")
                old = self.last[old_start : ends[j]] if j < len(ends) else old
            self._changed = max(0, first + len(new.encode()) - start)
            out.append(self._word(word, old, min(len(word), len(old), max(0, first - start)), shift))
            start = stop
            if stop >= first + len(new.encode()) and is_end(stop - shift) and stop - shift >= first + cut:
                tail = self.last[stop - shift :]
                break
        if tail is not None:
            out.append(tail)
        self.last = np.concatenate(out).astype(np.int32)

    def append(self, new: str) -> None:
        self.replace(len(self.text), len(self.text), new)

    def ids(self) -> list[int]:
        """The tokens of the whole text."""
        out, begin = [], 0
        for end in (np.flatnonzero(self.last < 0) + 1).tolist():
            t = ~int(self.last[end - 1])
            if self.encoder.size[t] == end - begin:
                out.append(t)
            else:
                out.extend(self.encoder.walk([*self.last[begin : end - 1].tolist(), t], 0, end - begin))
            begin = end
        return out


def _encoder(sent: Broadcast) -> Encoder:
    held = sent.value  # a Python worker keeps it from task to task, and the encoder with it
    if "encoder" not in held:
        held["encoder"] = Encoder(Ranks(**held["ranks"]), held["pattern"])
    return held["encoder"]


def _send(df: DataFrame, ranks_path: str, pattern: str) -> Broadcast:
    """The vocabulary's size is its file's."""
    return df.sparkSession.sparkContext.broadcast({"ranks": vars(read_ranks(ranks_path)), "pattern": pattern})


def encode(docs: DataFrame, ranks_path: str, pattern: str = SPLIT, text_col: str = "text", ids_col: str = "token_ids") -> DataFrame:
    """``docs`` with ``ids_col``: the whole text's token ids as packed little-endian unsigned 32-bit integers.

    Null and empty texts have no ids (empty binary). Strings of special tokens are ordinary text. Rows that repeat are
    encoded alike. An existing column named ``ids_col`` is replaced; all other columns pass through.
    """
    sent = _send(docs, ranks_path, pattern)

    def start():
        encoder = _encoder(sent)
        return lambda texts: [encoder.encode([t or "" for t in texts])]

    return with_made_columns(docs, [text_col], {ids_col: T.BinaryType()}, start)


def decode(tokens: DataFrame, ranks_path: str, ids_col: str = "token_ids", out_col: str = "decoded") -> DataFrame:
    """``tokens`` with ``out_col``: the bytes of packed ids, which need not be valid UTF-8; null ids give none."""
    sent = _send(tokens, ranks_path, SPLIT)

    def start():
        encoder = _encoder(sent)
        return lambda packed: [[encoder.decode(x) for x in packed]]

    return with_made_columns(tokens, [ids_col], {out_col: T.BinaryType()}, start)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str = SPLIT, text_col: str = "text", ids_col: str = "token_ids", out_col: str = "decoded") -> DataFrame:
    """``docs`` with ``ids_col`` as ``encode`` gives it and ``out_col``, what ``decode`` makes of the ids, in one pass."""
    sent = _send(docs, ranks_path, pattern)

    def start():
        encoder = _encoder(sent)

        def work(texts: list) -> list[list]:
            ids = encoder.encode([t or "" for t in texts])
            return [ids, [encoder.decode(x) for x in ids]]

        return work

    return with_made_columns(docs, [text_col], {ids_col: T.BinaryType(), out_col: T.BinaryType()}, start)


def prefix_tables(docs: DataFrame, ranks_path: str, pattern: str = SPLIT, text_col: str = "text", table_col: str = "prefix_table") -> DataFrame:
    """``docs`` with ``table_col``: the table that ``revise`` starts from, four bytes for each byte of text; null is empty text."""
    sent = _send(docs, ranks_path, pattern)

    def start():
        encoder = _encoder(sent)
        return lambda texts: [[PrefixTable(encoder, t or "").last.astype("<i4").tobytes() for t in texts]]

    return with_made_columns(docs, [text_col], {table_col: T.BinaryType()}, start)


def revise(docs: DataFrame, ranks_path: str, begin_col: str, end_col: str, new_col: str, pattern: str = SPLIT, text_col: str = "text", table_col: str = "prefix_table", ids_col: str = "token_ids") -> DataFrame:
    """Replace each text's characters from ``begin_col`` to ``end_col`` by ``new_col`` and bring table and ids up to date.

    Places beyond the text mean its end, so that begin = end = length appends; null places mean the end, null new text none.
    """
    sent = _send(docs, ranks_path, pattern)

    def start():
        encoder = _encoder(sent)

        def one(text, packed, begin, end, new):
            text = text or ""
            begin = len(text) if begin is None else min(max(begin, 0), len(text))
            end = len(text) if end is None else min(max(end, begin), len(text))
            table = PrefixTable(encoder, text, np.frombuffer(packed, "<i4") if packed is not None else None)
            table.replace(begin, end, new or "")
            return table.text, table.last.astype("<i4").tobytes(), np.array(table.ids(), "<u4").tobytes()

        return lambda *columns: list(map(list, zip(*(one(*row) for row in zip(*columns))))) or [[], [], []]

    added = {text_col: T.StringType(), table_col: T.BinaryType(), ids_col: T.BinaryType()}
    return with_made_columns(docs, [text_col, table_col, begin_col, end_col, new_col], added, start)
