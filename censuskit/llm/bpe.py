"""Byte-level BPE by dynamic programming over prefixes.

For every prefix of a byte string there is exactly one token that can end its encoding:
the token t for which the prefix before t is encoded with a last token p such that the
pair (p, t) is one that merging would leave standing. ``PrefixEncoder`` stores that last
token per prefix. Appending bytes extends the table and never changes what is stored;
the encoding is read off backwards. An edit keeps the table up to the edit and decodes
only what follows, until it meets the old encoding again at a token border.

Whether a pair stands is decided from the vocabulary alone: the two tokens are unmerged
along their touching edge, from the later merge to the earlier, and any merge across the
edge that would have come first rules the pair out.

As a job: texts are encoded in Arrow batches inside tasks. Each match of the pattern is
encoded by itself. For short pieces the last tokens are kept by prefix and shared by all
pieces that start alike, and only the prefixes that a piece needs are decided. Both caches
are bounded: two generations each, so that what is used again survives when one is full.
Ids pass through as Arrow columns, so they are exact beside nulls, whatever their size.

Defined results: null and empty texts have no tokens (the digest of the empty string).
Lone surrogates cannot occur in Spark strings. Rows that repeat give equal results. Extra
columns are never read. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

#: Pieces, and prefixes of pieces, in one generation of a worker's caches.
CACHE_PIECES, CACHE_PREFIXES = 120_000, 100_000
#: Bytes of a piece up to which its prefixes are looked up in the shared table.
SHORT = 64
#: Rows that a worker hands back at once.
SLICE_ROWS = 256


class Vocabulary:
    """Ranks of byte strings, and for each token the two tokens it is merged from."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.longest = max(map(len, ranks))
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.known_pairs: dict[int, bool] = {}

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(b): int(r) for b, r in map(bytes.split, lines)})

    def split(self, token: int) -> tuple[int, int] | None:
        """The pair whose merge makes this token; None for a single byte."""
        if token not in self.parts:
            self.parts[token] = self._split(token)
        return self.parts[token]

    def _split(self, token: int) -> tuple[int, int] | None:
        whole = self.bytes_of[token]
        parts = [bytes([b]) for b in whole]
        while len(parts) > 2:
            rank, i = min(((r, i) for i in range(len(parts) - 1) if (r := self.ranks.get(parts[i] + parts[i + 1])) is not None and r < token), default=(-1, -1))
            if i < 0:
                return None
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None

    def stands(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both ends with just these two tokens."""
        key = left << 32 | right
        known = self.known_pairs.get(key)
        if known is None:
            known = self._decide(left, right)
            if len(self.known_pairs) > 300_000:
                self.known_pairs.clear()
            self.known_pairs[key] = known
        return known

    def _decide(self, left: int, right: int) -> bool:
        # l and r are the pieces that touch at the border at some moment of the merging;
        # ``until`` is the rank of the merge that ends that moment.
        l, r, until = left, right, 1 << 60
        if len(self.bytes_of[right]) > 1 and self.split(right) is None:
            return False  # merging never makes this token
        while True:
            across = self.ranks.get(self.bytes_of[l] + self.bytes_of[r])
            # a merge over the border wins if it comes before the moment ends
            if across is not None and across < until:
                return False
            # step back to before the later of the two merges that made l and r
            if l > r:
                pair = self.split(l)
                if pair is not None:
                    l, until = pair[1], l
                    continue
                pair = self.split(r)
                if pair is None:
                    return True
                r, until = pair[0], r + 1
            else:
                pair = self.split(r)
                if pair is not None:
                    r, until = pair[0], r + 1
                    continue
                pair = self.split(l)
                if pair is None:
                    return True
                l, until = pair[1], l


class PrefixEncoder:
    """The last token of every prefix of some bytes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.v = vocabulary
        self.data = b""
        self.last: list[int] = []
        self.append(data)

    def append(self, more: bytes) -> PrefixEncoder:
        """Exact at once: what is stored for earlier prefixes stays as it is."""
        start, self.data = len(self.data), self.data + more
        data, last, v, longest = self.data, self.last, self.v, self.v.longest
        rank_of, pair_known = v.ranks.get, v.known_pairs.get
        for end in range(start + 1, len(data) + 1):
            for begin in range(end - longest if end > longest else 0, end):
                token = rank_of(data[begin:end])
                if token is None:
                    continue
                if begin:
                    stands = pair_known(last[begin - 1] << 32 | token)
                    if stands is None:
                        stands = v.stands(last[begin - 1], token)
                else:
                    stands = end == 1 or v.split(token) is not None
                if stands:
                    last.append(token)
                    break
            else:
                raise ValueError("the vocabulary has no token for a byte")
        return self

    def borders(self) -> list[int]:
        """Where tokens end, in descending order."""
        ends, at = [], len(self.data)
        while at:
            ends.append(at)
            at -= len(self.v.bytes_of[self.last[at - 1]])
        return ends

    def tokens(self) -> list[int]:
        return [self.last[at - 1] for at in reversed(self.borders())]

    def edited(self, start: int, stop: int, new: bytes) -> PrefixEncoder:
        """The encoder of the bytes with [start:stop] replaced. Prefixes before the edit are
        kept; past it, once as many last tokens in a row as the longest token has bytes are
        the old ones, all later ones are the old ones too and are taken over."""
        out = PrefixEncoder(self.v)
        out.data, out.last = self.data[:start], self.last[:start]
        out.append(new)
        same, shift = 0, len(out.data) - stop
        for at in range(stop, len(self.data)):
            out.append(self.data[at : at + 1])
            same = same + 1 if at - stop >= self.v.longest and out.last[at + shift] == self.last[at] else 0
            if same >= self.v.longest:
                out.data += self.data[at + 1 :]
                out.last += self.last[at + 1 :]
                break
        return out


class Recent:
    """A bounded table of what was used last: two generations, the older one goes."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def older(self, key):
        """What the older generation knows; it is young again."""
        got = self.old.get(key)
        return got if got is None else self.put(key, got)

    def put(self, key, value):
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value
        return value


class PieceEncoder:
    """Encodes short pieces by a table of last tokens that all pieces share."""

    def __init__(self, vocabulary: Vocabulary):
        self.v, self.last = vocabulary, Recent(CACHE_PREFIXES)
        # how long a token can be that ends in these four bytes
        self.reach: dict[bytes, int] = {}
        for token in vocabulary.ranks:
            if len(token) > 3:
                self.reach[token[-4:]] = max(len(token), self.reach.get(token[-4:], 0))

    def last_token(self, prefix: bytes) -> int:
        known = self.last.young.get(prefix) or self.last.older(prefix)
        if known is not None:
            return known - 1
        v, size = self.v, len(prefix)
        rank_of, pair_known = v.ranks.get, v.known_pairs.get
        for begin in range(max(0, size - self.reach.get(prefix[-4:], 3)), size):
            token = rank_of(prefix[begin:])
            if token is None:
                continue
            if begin:
                before = self.last_token(prefix[:begin])
                stands = pair_known(before << 32 | token)
                if stands is None:
                    stands = v.stands(before, token)
            else:
                stands = size == 1 or v.split(token) is not None
            if stands:
                self.last.put(prefix, token + 1)  # so that none is 0
                return token
        raise ValueError("the vocabulary has no token for a byte")

    def __call__(self, piece: bytes) -> list[int]:
        token = self.v.ranks.get(piece)
        if token is not None:
            return [token]
        if len(piece) > SHORT:
            return PrefixEncoder(self.v, piece).tokens()
        found = []
        while piece:
            found.append(self.last_token(piece))
            piece = piece[: -len(self.v.bytes_of[found[-1]])]
        return found[::-1]


class TextEncoder:
    """Encodes whole texts piece by piece, as the pattern cuts them."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.v, self.find = vocabulary, regex.compile(pattern).findall
        self.piece, self.known = PieceEncoder(vocabulary), Recent(CACHE_PIECES)
        # the bytes of all tokens in one array, by rank
        tokens = [vocabulary.bytes_of.get(i, b"") for i in range(max(vocabulary.bytes_of) + 1)]
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts, self.flat = np.cumsum(self.lengths) - self.lengths, np.frombuffer(b"".join(tokens), np.uint8)

    def _learn(self, piece: str) -> str:
        known = self.known.older(piece)
        if known is None:
            known = "".join([f" {i}" for i in self.piece(piece.encode())])
            if len(piece) <= SHORT:
                self.known.put(piece, known)
        return known

    def line(self, text: str) -> str:
        """The ids in decimal, one blank between two."""
        known, learn = self.known, self._learn
        return "".join([known.young.get(p) or learn(p) for p in self.find(text)])[1:]

    def encode(self, text: str) -> list[int]:
        return list(map(int, self.line(text).split()))

    def decode(self, ids: np.ndarray) -> bytes:
        ids = np.asarray(ids, np.int64)
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.starts[ids] - ends + lengths, lengths)
        return self.flat[shift + np.arange(len(shift))].tobytes()


_encoders: dict[tuple[str, str], TextEncoder] = {}


def encoder(path: str, pattern: str) -> TextEncoder:
    """One per worker process."""
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = TextEncoder(Vocabulary.load(path), pattern)
    return _encoders[path, pattern]


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per document: doc_id, ids (array of int, if with_ids), n_tokens, ids_sha256, decoded_sha256."""
    path, pattern = path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    schema = chosen.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                ids, sums = [], []
                for text in part.column("text").to_pylist():
                    line = enc.line(text)
                    ids.append(np.fromstring(line, np.int32, sep=" "))
                    sums.append((len(ids[-1]), hashlib.sha256(line.encode()).hexdigest(), hashlib.sha256(enc.decode(ids[-1])).hexdigest()))
                columns = [part.column("doc_id"), *([pa.array(ids, pa.list_(pa.int32()))] if with_ids else []), *map(pa.array, zip(*sums, strict=True))]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", *["ids"] * with_ids, "n_tokens", "ids_sha256", "decoded_sha256"]
    ids = "ids array<int>, " if with_ids else ""
    return chosen.mapInArrow(work, f"doc_id {schema}, {ids}n_tokens long, ids_sha256 string, decoded_sha256 string")
