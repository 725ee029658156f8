"""Byte-level BPE by rank files: each match of the pattern is merged by itself, always the
leftmost pair of lowest rank first.

A segment tree stands over a piece's byte positions. Leaf i holds the rank of the pair that
starts at byte i, an inner node the least rank below it. The root names the next merge, a
walk down that prefers the left finds its place, and a merge changes three leaves: the
merged pair's, the swallowed one's and the left neighbour's. Pieces of similar length are
merged side by side, one array row each; a long piece has a tree of its own.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtide.llm.pieces import PieceTable, spans_of, text_slices

#: Unicode's White_Space, which \s stands for in the pattern.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0                　"
NONE = np.int32(2**31 - 1)  # no pair
SIDE_BY_SIDE_BYTES = 64
TABLE_ROWS = 300_000


def explicit_spaces(pattern: str) -> str:
    """The pattern with \\s and \\S written as the characters they stand for."""
    out, inside = "", False
    for part in re.findall(r"\\.|.", pattern, re.S):
        if part in (r"\s", r"\S"):
            part = WHITE_SPACE if inside and part == r"\s" else f"[{'^' * (part == r'\S')}{WHITE_SPACE}]"
        elif part in "[]":
            inside = part == "["
        out += part
    return out


class Merges:
    """A rank file: the id of a token's bytes, and the id that two ids merge to."""

    def __init__(self, rank_file: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in rank_file.splitlines() if line)}
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        get = self.ranks.get
        pairs = {
            (left << 32) | right: merged
            for token, merged in self.ranks.items() for cut in range(1, len(token))
            if (left := get(token[:cut])) is not None and (right := get(token[cut:])) is not None
        }
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.merged = np.array([pairs[k] for k in self.keys.tolist()], dtype=np.int32)
        self.pairs = pairs

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.merged[at], NONE)

    def merge_one(self, piece: bytes) -> list[int]:
        n, pairs, none = len(piece), self.pairs, int(NONE)
        tokens = self.byte_ids[np.frombuffer(piece, dtype=np.uint8)].tolist()
        width = 1 << max(n - 1, 0).bit_length()
        tree = [none] * (2 * width)
        tree[width: width + n - 1] = [pairs.get((a << 32) | b, none) for a, b in zip(tokens, tokens[1:])]
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(leaf: int, rank: int) -> None:
            node = leaf + width
            tree[node] = rank
            while node > 1:
                node >>= 1
                tree[node] = min(tree[2 * node], tree[2 * node + 1])

        while tree[1] != none:
            rank, node = tree[1], 1
            while node < width:
                node = 2 * node + (tree[2 * node] != rank)
            here = node - width
            gone = after[here]
            tokens[here], after[here] = rank, after[gone]
            tokens[gone] = -1
            put(gone, none)
            if after[here] < n:
                before[after[here]] = here
                put(here, pairs.get((rank << 32) | tokens[after[here]], none))
            else:
                put(here, none)
            if before[here] >= 0:
                put(before[here], pairs.get((tokens[before[here]] << 32) | rank, none))
        return [t for t in tokens if t >= 0]

    def merge_side_by_side(self, pieces: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their counts; width: a power of two, no piece is longer."""
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        rows = len(pieces)
        filled = np.arange(width) < lengths[:, None]
        tokens = np.full((rows, width), -1, dtype=np.int64)
        tokens[filled] = self.byte_ids[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        tree = np.full((rows, 2 * width), NONE, dtype=np.int32)
        r, c = np.nonzero(filled[:, 1:])
        tree[r, width + c] = self.rank(tokens[r, c], tokens[r, c + 1])
        level = width
        while level > 1:
            level //= 2
            tree[:, level: 2 * level] = np.minimum(tree[:, 2 * level: 4 * level: 2], tree[:, 2 * level + 1: 4 * level: 2])
        after = np.broadcast_to(np.arange(1, width + 1), (rows, width)).copy()
        before = np.broadcast_to(np.arange(-1, width - 1), (rows, width)).copy()

        def put(row: np.ndarray, leaf: np.ndarray, rank: np.ndarray | np.int32) -> None:
            node = leaf + width
            tree[row, node] = rank
            for _ in range(width.bit_length() - 1):
                node = node >> 1
                tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])

        live = np.flatnonzero(tree[:, 1] != NONE)
        while len(live):
            rank, node = tree[live, 1], np.ones(len(live), dtype=np.int64)
            for _ in range(width.bit_length() - 1):
                node = 2 * node
                node += tree[live, node] != rank
            here = node - width
            gone = after[live, here]
            beyond = after[live, gone]
            tokens[live, here], tokens[live, gone], after[live, here] = rank, -1, beyond
            put(live, gone, NONE)
            inside = beyond < lengths[live]
            new = np.full(len(live), NONE, dtype=np.int32)
            row, at = live[inside], here[inside]
            before[row, beyond[inside]] = at
            new[inside] = self.rank(tokens[row, at], tokens[row, beyond[inside]])
            put(live, here, new)
            left = before[live, here]
            has = left >= 0
            row, at = live[has], left[has]
            put(row, at, self.rank(tokens[row, at], tokens[row, here[has]]))
            live = live[tree[live, 1] != NONE]
        kept = tokens >= 0
        return tokens[kept].astype(np.uint32), kept.sum(axis=1)

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their counts. A piece that is a token is that token, as the rank file's
        library has it."""
        counts = np.ones(len(pieces), dtype=np.int64)
        parts: list[np.ndarray | None] = [None] * len(pieces)
        classes: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            if (whole := self.ranks.get(piece)) is not None:
                parts[i] = np.array([whole], dtype=np.uint32)
            elif len(piece) > SIDE_BY_SIDE_BYTES:
                parts[i] = np.array(self.merge_one(piece), dtype=np.uint32)
                counts[i] = len(parts[i])
            else:
                classes.setdefault(1 << (len(piece) - 1).bit_length(), []).append(i)
        for width, members in classes.items():
            for a in range(0, len(members), 4096):
                group = members[a: a + 4096]
                ids, sizes = self.merge_side_by_side([pieces[i] for i in group], width)
                counts[group] = sizes
                for i, part in zip(group, np.split(ids, np.cumsum(sizes)[:-1])):
                    parts[i] = part
        return (np.concatenate(parts) if parts else np.empty(0, dtype=np.uint32)), counts


class Encoder:
    """A worker's tables: ids of runs of text between single spaces, and of the pattern's
    matches in them."""

    def __init__(self, rank_file: bytes, pattern: str):
        self.merges = Merges(rank_file)
        self.match = regex.compile(explicit_spaces(pattern)).findall
        self.matches = PieceTable(self.merges.encode_pieces, TABLE_ROWS)
        self.runs = PieceTable(self._encode_runs, TABLE_ROWS)
        edge = f"[{WHITE_SPACE}]"
        # a single space between other characters always starts a match, so a text may be
        # cut before it without changing any match
        self.cut = re.compile(f"(?<!{edge}) (?!{edge}|\\Z)").split
        self.doubtful = re.compile(f" {edge}|{edge} ").search

    def _encode_runs(self, runs: list[tuple[bool, str]]) -> tuple[np.ndarray, np.ndarray]:
        found = [[m.encode() for m in self.match(r if type(r) is str else r[0])] for r in runs]
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return self.matches.ids_of([m for f in found for m in f], sizes)

    def runs_of(self, text: str | None) -> list:
        if not text:
            return []
        plain = text[0] != " " != text[-1] and not self.doubtful(text)
        first, *rest = text.split(" ") if plain else self.cut(text)
        return [(first,), *(" " + r for r in rest)]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many each text has."""
        runs = [self.runs_of(t) for t in texts]
        sizes = np.fromiter(map(len, runs), dtype=np.int64, count=len(runs))
        return self.runs.ids_of(list(chain.from_iterable(runs)), sizes)


_encoders: dict[tuple, object] = {}  # what this worker has read of rank files


def _encoder(rank_file: bytes, pattern: str) -> Encoder:
    key = (zlib.crc32(rank_file), pattern)
    if key not in _encoders:
        _encoders[key] = Encoder(rank_file, pattern)
    return _encoders[key]


def _binaries(data: bytes, counts: np.ndarray, width: int) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts * width)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])


class TokenBytes:
    """The bytes of each token, for decoding."""

    def __init__(self, rank_file: bytes):
        by_id = {int(b): base64.b64decode(a) for a, b in (line.split() for line in rank_file.splitlines() if line)}
        tokens = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self.lengths = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[bytes, np.ndarray]:
        """All texts' bytes, and how many each has."""
        if len(ids) and (ids.max() >= len(self.lengths) or not self.lengths[ids].all()):
            raise ValueError("an id that no token has")
        sizes = self.lengths[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return self.data[spans_of(self.starts[ids], sizes)].tobytes(), np.diff(ends[np.concatenate([[0], np.cumsum(counts)])])


def _token_bytes(rank_file: bytes) -> TokenBytes:
    key = (zlib.crc32(rank_file), None)
    if key not in _encoders:
        _encoders[key] = TokenBytes(rank_file)
    return _encoders[key]


def _encoded(batches: Iterator[pa.RecordBatch], encoder: Encoder) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, "text"):
        ids, counts = encoder.encode(batch.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _binaries(ids.astype("<u4").tobytes(), counts, 4)], names=["doc_id", "ids"])


def _decoded(batches: Iterator[pa.RecordBatch], tokens: TokenBytes) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, "ids"):
        each = batch.column("ids").fill_null(b"").to_pylist()
        counts = np.fromiter(map(len, each), dtype=np.int64, count=len(each)) // 4
        data, sizes = tokens.decode(np.frombuffer(b"".join(each), dtype="<u4").astype(np.int64), counts)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), _binaries(data, sizes, 1)], names=["doc_id", "ids", "decoded"])


def _texts(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, str]:
    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), dict(docs.dtypes)[key]


def encode_documents(docs: DataFrame, rank_file: bytes, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids: little-endian unsigned 32-bit integers. Null and empty texts have none.
    One row for each row of docs, nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(rank_file)  # one vocabulary file
    rows, kind = _texts(docs, key, text)
    return rows.mapInArrow(lambda batches: _encoded(batches, _encoder(shared.value, pattern)), f"doc_id {kind}, ids binary")


def decode_documents(encoded: DataFrame, rank_file: bytes, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id, ids, decoded: the bytes of the ids' tokens; null ids give none. Ids that no
    token has raise an error."""
    shared = encoded.sparkSession.sparkContext.broadcast(rank_file)
    rows = encoded.select(F.col(key).alias("doc_id"), F.col(ids).alias("ids"))
    return rows.mapInArrow(lambda batches: _decoded(batches, _token_bytes(shared.value)), f"doc_id {dict(encoded.dtypes)[key]}, ids binary, decoded binary")


def encode_and_decode(docs: DataFrame, rank_file: bytes, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """As decode_documents of encode_documents, in one pass of one Python worker a task."""
    shared = docs.sparkSession.sparkContext.broadcast(rank_file)
    rows, kind = _texts(docs, key, text)

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _decoded(_encoded(batches, _encoder(shared.value, pattern)), _token_bytes(shared.value))

    return rows.mapInArrow(both, f"doc_id {kind}, ids binary, decoded binary")


def token_count(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")
