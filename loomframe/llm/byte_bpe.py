"""Byte-level BPE: merges compiled into a lazily determinised transducer; streaming decode by a UTF-8 state machine.

A sequence of tokens is what the merges make of its bytes exactly if every two neighbours stay apart when their bytes are
merged alone, and each prefix of the bytes has one such sequence. So the merges become a nondeterministic transducer:
walk the token trie, and at any byte start a new token as well. Its sets of trie nodes are made deterministic on first use
and kept in a bounded table that starts anew when it is full. In each state the longest ending token that may stand after
the last token before it is the last token of this prefix. Tokens are emitted once all open readings share them, which is
after a look ahead of at most the longest token.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Entries after which the tables of lazily made states and of known words start anew.
MAX_STATES, MAX_WORDS = 100_000, 500_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Transducer:
    """Encoder of one vocabulary. encode(): ids of one pretoken's bytes."""

    #: Bytes of a long pretoken after which settled tokens are emitted.
    BLOCK = 4096

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks, self.max_states = ranks, max_states
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.length = {r: len(t) for t, r in ranks.items()}
        self.longest = max(self.length.values(), default=1)
        self.child: list[dict[int, int]] = [{}]  # the trie of tokens
        self.token_at: list[int] = [-1]
        for token, rank in ranks.items():
            node = 0
            for b in token:
                nxt = self.child[node].get(b)
                if nxt is None:
                    nxt = self.child[node][b] = len(self.child)
                    self.child.append({})
                    self.token_at.append(-1)
                node = nxt
            self.token_at[node] = rank
        self.parts: dict[int, tuple[int, int] | None] = {}
        self._restart()

    def _restart(self) -> None:
        self.apart: dict[int, bool] = {}
        self.ids: dict[tuple, int] = {}
        self.sets: list[tuple] = []
        self.arcs: dict[int, int] = {}
        self.longer: list[list[tuple[int, int]]] = []  # ending tokens and minus their lengths, but for the shortest,
        self.shortest: list[int] = []  # which stands if no other may
        self._state((0,))

    def _state(self, nodes: tuple) -> int:
        at = self.ids.get(nodes)
        if at is None:
            at = self.ids[nodes] = len(self.sets)
            self.sets.append(nodes)
            ending = [t for n in nodes if (t := self.token_at[n]) >= 0]
            self.longer.append([(t, -self.length[t]) for t in ending[:-1]])
            self.shortest.append(ending[-1] if ending else -1)
        return at

    def _arc(self, state: int, byte: int) -> int:
        """Open readings after one more byte: trie nodes, the longest reading first; a new one may start at any byte."""
        nodes = tuple(m for n in self.sets[state] if (m := self.child[n].get(byte)) is not None)
        to = self.arcs[state << 8 | byte] = self._state((*nodes, 0))
        return to

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for one byte."""
        if token not in self.parts:
            ids = [self.ranks[bytes([b])] for b in self.bytes_of[token]]
            while len(ids) > 2:
                least, at = min((self.ranks.get(self.bytes_of[a] + self.bytes_of[b], 1 << 60), i) for i, (a, b) in enumerate(zip(ids, ids[1:])))
                ids[at : at + 2] = [least]
            self.parts[token] = tuple(ids) if len(ids) == 2 else None
        return self.parts[token]

    def _stay_apart(self, a: int, b: int) -> bool:
        """True if the merges of a's and b's joined bytes leave a and b: undo merges, the latest first, and see that no merge across the border came before."""
        if a < 0:
            return True
        x, y, limit, bytes_of, ranks = a, b, 1 << 60, self.bytes_of, self.ranks
        while True:
            if ranks.get(bytes_of[x] + bytes_of[y], limit) < limit:
                return False
            hx, hy = self._halves(x), self._halves(y)
            if hx and (not hy or x > y):
                limit, x = x, hx[1]  # made before an equal merge on its right
            elif hy:
                limit, y = y + 1, hy[0]
            else:
                return True

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.sets) > self.max_states or len(self.apart) > 8 * self.max_states:
            self._restart()
        state, out, last = 0, [], [-1]  # emitted; the last token of each prefix that is still open
        arcs, longer, shortest, apart, add = self.arcs, self.longer, self.shortest, self.apart, last.append
        for at in range(0, len(piece), self.BLOCK):
            for b in piece[at : at + self.BLOCK]:
                state = arcs.get(state << 8 | b) or self._arc(state, b)
                for token, n in longer[state]:
                    pair = last[n] << 32 | token
                    ok = apart.get(pair)
                    if ok is None:
                        ok = apart[pair] = self._stay_apart(last[n], token)
                    if ok:
                        add(token)
                        break
                else:
                    add(shortest[state])
            if len(last) > self.BLOCK:
                done, last = self._settled(last)
                out, add = out + done, last.append
        return out + self._trace(last, len(last) - 1, 0)

    def _trace(self, last: list[int], end: int, start: int) -> list[int]:
        out = []
        while end > start:
            out.append(last[end])
            end -= self.length[last[end]]
        return out[::-1]

    def _settled(self, last: list[int]) -> tuple[list[int], list[int]]:
        """What every reading that ends within the longest token's length shares, and the rest."""
        ends = set(range(len(last) - self.longest, len(last)))
        while len(ends) > 1:
            end = max(ends)
            ends.remove(end)
            ends.add(end - self.length[last[end]])
        at = ends.pop()
        return self._trace(last, at, 0), last[at:]


class Utf8Machine:
    """Incremental UTF-8: states are what may follow. step() takes bytes as they come, flush() ends the text.

    Bytes that cannot go on a character become U+FFFD, one for each broken start.
    """

    # After a first byte: how many bytes follow, and the range of the next one.
    FIRST = [(0xC2, 0xDF, 1, 0x80, 0xBF), (0xE0, 0xE0, 2, 0xA0, 0xBF), (0xE1, 0xEC, 2, 0x80, 0xBF), (0xED, 0xED, 2, 0x80, 0x9F), (0xEE, 0xEF, 2, 0x80, 0xBF), (0xF0, 0xF0, 3, 0x90, 0xBF), (0xF1, 0xF3, 3, 0x80, 0xBF), (0xF4, 0xF4, 3, 0x80, 0x8F)]

    def __init__(self):
        self.starts = {b: (n, lo, hi) for first, last, n, lo, hi in self.FIRST for b in range(first, last + 1)}
        self.left, self.lo, self.hi, self.held = 0, 0, 0, bytearray()

    def step(self, data: bytes) -> bytes:
        """The whole characters that these bytes complete, as UTF-8."""
        out = bytearray()
        for b in data:
            if self.left:
                if self.lo <= b <= self.hi:
                    self.held.append(b)
                    self.left, self.lo, self.hi = self.left - 1, 0x80, 0xBF
                    if not self.left:
                        out += self.held
                        self.held.clear()
                    continue
                out += self.flush()
            if b < 0x80:
                out.append(b)
            elif b in self.starts:
                self.left, self.lo, self.hi = self.starts[b]
                self.held.append(b)
            else:
                out += b"\xef\xbf\xbd"
        return bytes(out)

    def flush(self) -> bytes:
        cut, self.left = bool(self.held), 0
        self.held.clear()
        return b"\xef\xbf\xbd" if cut else b""


def narrow(pattern: str):
    """The pattern's findall for texts below U+0100: classes spelled out for the quicker standard engine; None if it has others."""
    spelled = {k: "".join(f"\\x{i:02x}" for i in range(256) if unicodedata.category(chr(i))[0] == k) for k in "LN"}
    spelled["s"] = "".join(f"\\x{i:02x}" for i in (*range(9, 14), 32, 0x85, 0xA0))  # the White_Space property
    out, depth = [], 0
    for part in regex.split(r"(\\p\{[LN]\}|\\[sS]|\\.|[\[\]])", pattern):
        depth += (part == "[") - (part == "]")
        if part == r"\S" and depth:
            return None
        body = spelled.get(part[3:4] if part.startswith(r"\p{") else "s" if part in (r"\s", r"\S") else "")
        out.append(part if body is None else body if depth else f"[{'^' * (part[1] == 'S')}{body}]")
    try:
        return re.compile("".join(out)).findall
    except re.error:
        return None


class Codec:
    """A vocabulary and a pretoken pattern: texts to ids and back. Ids outside the vocabulary decode to nothing."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, max_words: int = MAX_WORDS):
        self.transducer, self.find = Transducer(ranks), regex.compile(pattern).findall
        self.find_narrow = narrow(pattern) or self.find
        self.words: dict[str, bytes] = {}
        self.max_words = max_words
        top = max(ranks.values(), default=-1) + 1
        self.table = np.full(top + 1, b"", object)
        for token, rank in ranks.items():
            self.table[rank] = token
        self.closed = np.array([self._whole(t) for t in self.table], bool)

    @staticmethod
    def _whole(token: bytes) -> bool:
        machine = Utf8Machine()
        return machine.step(token) == token and not machine.left

    def encode(self, text: str) -> np.ndarray:
        """Ids as little-endian unsigned 32-bit integers."""
        words = self.words
        try:
            text.encode("latin-1")
            found = self.find_narrow(text)
        except UnicodeEncodeError:
            found = self.find(text)
        try:
            packed = b"".join(map(words.__getitem__, found))
        except KeyError:
            if len(words) > self.max_words:
                words.clear()
            encode = self.transducer.encode
            for w in set(found):
                if w not in words:
                    ids = encode(w.encode())
                    words[w] = struct.pack(f"<{len(ids)}I", *ids)
            packed = b"".join(map(words.__getitem__, found))
        return np.frombuffer(packed, "<u4")

    def decode_stream(self, ids: Iterable[np.ndarray]) -> Iterator[bytes]:
        """UTF-8 of whole characters, as far as each block of ids completes them."""
        machine, unknown = Utf8Machine(), len(self.table) - 1
        for block in ids:
            block = np.minimum(block, unknown)
            at = 0
            for cut in [*np.flatnonzero(~self.closed[block]).tolist(), len(block)]:
                if cut > at:  # tokens of whole characters: nothing to track inside
                    yield machine.flush() + b"".join(self.table[block[at:cut]])
                if cut < len(block):
                    yield machine.step(self.table[block[cut]])
                at = cut + 1
        yield machine.flush()


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One for each worker process."""
    return Codec(read_ranks(path), pattern)


def _mapped(df: DataFrame, cols: list[str], schema: str, fn) -> DataFrame:
    common.small_batches(df.sparkSession)
    return df.select(*cols).mapInArrow(fn, schema)


def encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, ids array<long>), one per input row. Null and empty texts have no ids; repeated rows stay."""

    def run(batches):
        c = codec(path, pattern)
        for b in batches:
            ids = [c.encode(bytes(t).decode()) for t in common.texts(b, "text")]
            yield pa.record_batch([common.column(b, "id"), pa.array([x.astype(np.int64) for x in ids], pa.list_(pa.int64()))], ["id", "ids"])

    kind = df.schema[id_col].dataType.simpleString()
    return _mapped(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), ["id", "text"], f"id {kind}, ids array<bigint>", run).withColumnRenamed("id", id_col)


def decode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Rows (id, text), one per input row. Null ids decode to an empty text; broken UTF-8 to U+FFFD."""

    def run(batches):
        c = codec(path, pattern)
        for b in batches:
            out = [b"".join(c.decode_stream([np.asarray(x or [], np.int64)])).decode() for x in common.column(b, "ids").to_pylist()]
            yield pa.record_batch([common.column(b, "id"), pa.array(out, pa.string())], ["id", "text"])

    kind = df.schema[id_col].dataType.simpleString()
    return _mapped(df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")), ["id", "ids"], f"id {kind}, text string", run).withColumnRenamed("id", id_col)


def round_trip(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text, then decode its ids: rows (id, n_tokens, ids_sha256, decoded_sha256), one per input row.

    Null texts count as empty: no tokens, and the digests of no bytes. Nothing is shuffled; ids never leave the task.
    """

    def run(batches):
        c = codec(path, pattern)
        for b in batches:
            n, ids_sha, sha = [], [], []
            for t in common.texts(b, "text"):
                ids, digest = c.encode(bytes(t).decode()), hashlib.sha256()
                for piece in c.decode_stream([ids]):
                    digest.update(piece)
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(ids.tobytes()).hexdigest())
                sha.append(digest.hexdigest())
            yield pa.record_batch([common.column(b, "id"), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(sha)], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = df.schema[id_col].dataType.simpleString()
    return _mapped(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), ["id", "text"], f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string", run).withColumnRenamed("id", id_col)
