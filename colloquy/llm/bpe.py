"""Byte-level BPE: encoding by a lazily determinised transducer, streaming decode.

A token sequence is what the merges make of a piece of text exactly if each token is what
they make of its own bytes and each two neighbours are what they make of the two together.
So the merges are a finite-state transducer: it guesses where tokens begin, and a guess lives
while the bytes after it are the beginning of a token.  The guesses alive at a byte are one
state of the determinised machine, built when first met.  Which token ends at a byte is told
beside the machine, by a stored pointer to the token before it; tokens leave at the end of a
piece, or every stretch of a long one.  A guess dies after the longest token's bytes at the
latest, so lookahead is bounded.

Decoding is a stream of ids: text comes out through an incremental UTF-8 machine that holds
back the bytes of an unfinished character.  What a token gives between two characters is
looked up; the machine reads bytes only where a character spans tokens.

The rank file is a parameter.  It is small and fixed (a vocabulary), and each task reads it
where the library that owns it is installed.

Defined cases: a null or empty text has no tokens; every other text is encoded whole,
special tokens' strings being ordinary text, and a very long piece in stretches; repeated rows and empty tables are as they
come; other columns are ignored by encode() and kept by append_tokens().
"""

from __future__ import annotations

import base64
import hashlib
import sys
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Bounds of the caches of one task's process; what is dropped is computed again.
CACHED_PIECES = 130_000  # of each of two generations, with their ids
CACHED_STATES = 200_000
CACHED_PAIRS = 300_000
STRETCH = 1024  # bytes of a piece after which settled tokens are emitted


class Merges:
    """The vocabulary: ranks of byte strings, and which tokens may stand side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        self.rank = ranks
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for b, r in ranks.items():
            self.bytes_of[r] = b
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.lefts: list[dict[int, bool]] = [{} for _ in self.bytes_of]  # by right token: left token -> may it follow
        self.n_pairs = 0

    def by_rank(self, piece: bytes) -> list[int]:
        """The merges applied to a piece in the order of rank: the definition."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get(parts[i] + parts[i + 1], 1 << 60))
            if parts[best] + parts[best + 1] not in self.rank:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return [self.rank[p] for p in parts]

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens that the last merge of a token's own bytes joins; None for a single byte."""
        if token not in self.halves:
            b, found = self.bytes_of[token], None
            if len(b) > 1:
                parts = [b[i : i + 1] for i in range(len(b))]
                while len(parts) > 2:
                    ranks = [self.rank.get(x + y, 1 << 60) for x, y in zip(parts, parts[1:])]
                    i = ranks.index(min(ranks))
                    if ranks[i] >= token:
                        break
                    parts[i : i + 2] = [parts[i] + parts[i + 1]]
                found = (self.rank[parts[0]], self.rank[parts[1]]) if len(parts) == 2 else (-1, -1)
            self.halves[token] = found
        return self.halves[token]

    def whole(self, token: int) -> bool:
        """Do the merges make this one token of its own bytes?"""
        return self.split(token) != (-1, -1)

    def fits(self, left: int, right: int) -> bool:
        """May right follow left?  No merge across their border comes before those that made them."""
        known = self.lefts[right].get(left)
        if known is None:
            if self.n_pairs >= CACHED_PAIRS:
                self.n_pairs = 0
                for x in self.lefts:
                    x.clear()
            self.n_pairs += 1
            known = self.lefts[right][left] = self._fits(left, right)
        return known

    def _fits(self, left: int, right: int) -> bool:
        """Looks at the border from the outermost merges inwards.

        At each step the half with the later merge is undone; a pair across the border that
        is a token of lower rank than that merge would have been joined first (at equal
        rank, the left one first).
        """
        limit = 1 << 60
        while True:
            joined = self.rank.get(self.bytes_of[left] + self.bytes_of[right])
            if joined is not None and joined < limit:
                return False
            if (left > right and self.split(left)) or not self.split(right):
                if not self.split(left):
                    return True
                limit, left = left, self.split(left)[1]
            else:
                limit, right = right + 1, self.split(right)[0]


class _State(dict):
    """byte -> next state; a byte met first makes its entry.

    live: the nodes of the guesses alive, older ones first, then the root (a guess that
    begins now); ends: (bytes, token, what may stand before it) of the tokens that may end
    here, longest first.
    """

    __slots__ = ("machine", "live", "ends")

    def __init__(self, machine: Transducer, live: tuple[int, ...]):
        self.machine, self.live = machine, live
        m = machine.m
        self.ends = tuple((machine.depth[x], machine.token[x], m.lefts[machine.token[x]]) for x in live if machine.token[x] >= 0)

    def __missing__(self, byte: int) -> _State:
        found = self[byte] = self.machine.state_of(self, byte)
        return found


class Transducer:
    """The determinised machine.

    A guess is that a token begins at some byte; it lives while the bytes since are the
    beginning of a token, that is, a node of the tokens' trie.  The guesses alive together
    are a state, made when it is first met, with the tokens that its guesses may end there.
    Of these only one fits the tokens before it (an encoding is unique); it is the last token
    of the text up to this byte.  Tokens are emitted once every live guess rests on them.
    """

    def __init__(self, merges: Merges):
        self.m = merges
        self.child: dict[int, int] = {}  # node * 256 + byte -> node
        self.token = [-1]
        self.depth = [0]
        for b, r in sorted(merges.rank.items()):
            node = 0
            for byte in b:
                key = node << 8 | byte
                if key not in self.child:
                    self.child[key] = len(self.token)
                    self.token.append(-1)
                    self.depth.append(self.depth[node] + 1)
                node = self.child[key]
            if merges.whole(r):
                self.token[node] = r
        self.size = [len(b) for b in merges.bytes_of]
        self.forget()

    def forget(self) -> None:
        """Drops the states met; they are built again when needed."""
        self.start = _State(self, (0,))
        self.known: dict[tuple[int, ...], _State] = {(0,): self.start}

    def state_of(self, s: _State, byte: int) -> _State:
        live = (*(n for n in (self.child.get(node << 8 | byte) for node in s.live) if n is not None), 0)
        found = self.known.get(live)
        if found is None:
            found = self.known[live] = _State(self, live)
        return found

    def _path(self, last: list[int], end: int) -> list[int]:
        """Tokens of the bytes before end, from each byte's last token (last[0] stands before all)."""
        out, size = [], self.size
        while end:
            t = last[end]
            out.append(t)
            end -= size[t]
        out.reverse()
        return out

    def _settled(self, last: list[int], s: _State) -> int:
        """The last border that all live guesses rest on."""
        borders = {len(last) - 1 - self.depth[node] for node in s.live}
        while len(borders) > 1:
            p = max(borders)
            borders.remove(p)
            borders.add(p - self.size[last[p]])
        return borders.pop()

    def encode(self, piece: bytes) -> list[int]:
        if len(self.known) > CACHED_STATES:
            self.forget()
        s, last, out, at, fits = self.start, [-1], [], 0, self.m.fits
        for byte in piece:
            s = s[byte]
            at += 1
            for size, token, lefts in s.ends:
                left = last[at - size]
                if left < 0:
                    break
                ok = lefts.get(left)
                if fits(left, token) if ok is None else ok:
                    break
            last.append(token)
            if at == STRETCH:
                cut = self._settled(last, s)
                out += self._path(last, cut)
                del last[:cut]  # the token before the border stays, as the new last[0]
                at -= cut
        return out + self._path(last, at)


class _Pieces(dict):
    """piece -> its packed ids.  Two generations: what is used again survives when the older one goes."""

    def __init__(self, machine: Transducer):
        super().__init__()
        self.machine, self.old = machine, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.pop(piece, None)
        if ids is None:
            ids = array("I", self.machine.encode(piece.encode("utf-8", "surrogatepass")))
            if sys.byteorder == "big":
                ids.byteswap()
            ids = ids.tobytes()
        if len(piece) < 64:
            if len(self) >= CACHED_PIECES:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    """Whole texts: the pattern's matches are encoded one by one, met pieces from a bounded cache."""

    def __init__(self, rank_file: str, pattern: str):
        with open(rank_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.merges = Merges(ranks)
        self.known = _Pieces(Transducer(self.merges))
        self.pieces = regex.compile(pattern).findall
        self.bytes_of = self.merges.bytes_of
        self.closed = _Closed(self.bytes_of)  # at most a row for each token

    def packed(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.known.__getitem__, self.pieces(text)))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), "<u4").tolist()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def text(self, ids) -> str:
        """The ids decoded as a stream."""
        stream = StreamDecoder(self.bytes_of, self.closed)
        return stream.feed_all(ids) + stream.close()


def _utf8_machine() -> list[list[int]]:
    """Next state by state and byte.  0: between characters; 1, 2, 3: so many bytes to come;
    4-7: the second byte is restricted (after E0, ED, F0, F4); 8: not UTF-8."""
    table = [[8] * 256 for _ in range(9)]
    for b in range(256):
        if b < 0x80:
            table[0][b] = 0
        elif 0xC2 <= b < 0xE0:
            table[0][b] = 1
        elif 0xE0 <= b < 0xF0:
            table[0][b] = {0xE0: 4, 0xED: 5}.get(b, 2)
        elif 0xF0 <= b < 0xF5:
            table[0][b] = {0xF0: 6, 0xF4: 7}.get(b, 3)
        if 0x80 <= b < 0xC0:
            table[1][b], table[2][b], table[3][b] = 0, 1, 2
            table[4][b] = 1 if b >= 0xA0 else 8
            table[5][b] = 1 if b < 0xA0 else 8
            table[6][b] = 2 if b >= 0x90 else 8
            table[7][b] = 2 if b < 0x90 else 8
    return table


UTF8 = _utf8_machine()


class _Closed(dict):
    """token -> its text if it begins and ends between characters, else None."""

    def __init__(self, bytes_of):
        self.bytes_of = bytes_of

    def __missing__(self, token: int) -> str | None:
        state = 0
        for b in self.bytes_of[token]:
            state = UTF8[state][b]
        found = self[token] = None if state else self.bytes_of[token].decode("utf-8")
        return found


class StreamDecoder:
    """feed(id) gives the text that is complete; bytes of an unfinished character wait.

    Bytes that cannot be UTF-8 come out as U+FFFD, one for each maximal broken part.
    """

    def __init__(self, bytes_of, closed: _Closed | None = None):
        self.bytes_of, self.state, self.held = bytes_of, 0, b""
        self.closed = _Closed(bytes_of) if closed is None else closed

    def _read(self, data: bytes) -> str:
        out, state, held = [], self.state, bytearray(self.held)
        for b in data:
            s = UTF8[state][b]
            if s == 8:
                if state:  # what was held is broken; the byte may begin anew
                    out.append("\ufffd")
                    held.clear()
                    s = UTF8[0][b]
                if s == 8:
                    out.append("\ufffd")
                    state = 0
                    continue
            held.append(b)
            state = s
            if s == 0:
                out.append(held.decode("utf-8"))
                held.clear()
        self.state, self.held = state, bytes(held)
        return "".join(out)

    def feed(self, token: int) -> str:
        if not self.state and (text := self.closed[token]) is not None:
            return text
        return self._read(self.bytes_of[token])

    def feed_all(self, tokens: list[int]) -> str:
        """feed() of each."""
        texts = list(map(self.closed.__getitem__, tokens))
        if self.state or None in texts:
            for k, text in enumerate(texts):
                if text is None or self.state:
                    texts[k] = self._read(self.bytes_of[tokens[k]])
        return "".join(texts)

    def close(self) -> str:
        rest = "\ufffd" if self.held else ""
        self.state, self.held = 0, b""
        return rest


@lru_cache(maxsize=2)
def codec(rank_file: str, pattern: str) -> Codec:
    return Codec(rank_file, pattern)


def _digests(rank_file: str, pattern: str):
    def run(batches):
        c = codec(rank_file, pattern)
        for batch in batches:
            n, ids_hash, bytes_hash = [], [], []
            for text in batch.column("text").to_pylist():
                packed = c.packed(text or "")
                n.append(len(packed) // 4)
                ids_hash.append(hashlib.sha256(packed).hexdigest())
                bytes_hash.append(hashlib.sha256(c.text(np.frombuffer(packed, "<u4").tolist()).encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(bytes_hash, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def digest(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """docs(doc_id, text) -> tokens, hash of the ids, hash of the bytes decoded from them."""
    return docs.select("doc_id", "text").mapInArrow(
        _digests(rank_file, pattern), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def append_tokens(docs: DataFrame, rank_file: str, pattern: str, name: str = "token_ids") -> DataFrame:
    """docs with an array<int> column of its texts' ids (an own column of that name is replaced); a null text has
    an empty array."""
    def run(batches):
        c = codec(rank_file, pattern)
        for batch in batches:
            packed = [c.packed(text or "") for text in batch.column("text").to_pylist()]
            offsets = np.cumsum([0, *(len(p) // 4 for p in packed)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), "<i4")))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, name])

    docs = docs.drop(name)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(T.IntegerType()))])
    return docs.mapInArrow(run, schema)
