"""Operator 2, byte-level BPE: whole texts to token ids and back, by a tiktoken rank file.

A text is split by the tokenizer's pattern; each piece is encoded on its own, as the ranks say: again and again the
leftmost pair of neighbours whose joined bytes have the smallest rank is merged. Each task encodes its distinct pieces
together: pieces of similar length are rows of one padded numpy matrix, a round finds every row's leftmost
minimum-rank pair, merges it and closes the gap, and finished rows leave the matrix. Ranks of pairs come from an
open-addressing hash table over (left id, right id). A piece over ``LONG`` bytes keeps its pairs in a heap instead, in
the same order, for a round over a whole row of that length would make the work quadratic.

The table is made from the rank file once, on the driver, and broadcast; its size is the vocabulary's, not the data's.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.common import U64, mix

LONG = 512
#: Cells of one matrix, distinct pieces that a task remembers, bytes of text encoded together.
CELLS, REMEMBERED, TOGETHER = 1 << 21, 300_000, 1 << 21
NONE = np.int32(2**31 - 1)


class Vocabulary:
    """Ranks of a tiktoken file as arrays: byte ids, the hash table of pairs, the tokens' bytes."""

    @classmethod
    def of(cls, fields: dict) -> Vocabulary:
        """The vocabulary that ``vars`` gave ``fields`` of."""
        out = cls.__new__(cls)
        vars(out).update(fields)
        return out

    def __init__(self, lines: list[bytes], pattern: str):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, lines))}
        self.pattern = pattern
        self.byte_ids = np.array([ranks.get(bytes([i]), -1) for i in range(256)], np.int32)
        if (self.byte_ids < 0).any():
            raise ValueError("the rank file must hold every single byte")
        pairs = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t))
                 if t[:i] in ranks and t[i:] in ranks]
        left, right, rank = (np.array(x, np.int64) for x in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 3
        self.bits = max(4, int(4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        key, todo = left << 32 | right, np.arange(len(pairs))
        place = self._home(key)
        while len(todo):  # of those that want a free place, the last gets it; the others try the next one
            free = self.keys[place[todo]] == -1
            self.keys[place[todo[free]]] = key[todo[free]]
            todo = todo[self.keys[place[todo]] != key[todo]]
            place[todo] = (place[todo] + 1) & ((1 << self.bits) - 1)
        self.ranks[place] = rank
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for t, r in ranks.items():
            tokens[r] = t
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.ends = np.cumsum([len(t) for t in tokens])
        self.starts = self.ends - np.array([len(t) for t in tokens])

    def _home(self, key: np.ndarray) -> np.ndarray:
        return (mix(key.astype(U64)) >> U64(64 - self.bits)).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair's joined bytes, NONE where there is none or an id is padding (negative)."""
        shape = left.shape
        key = (left.astype(np.int64) << 32 | right.astype(np.int64)).reshape(-1)
        out = np.full(len(key), NONE, np.int32)
        todo = np.flatnonzero((left.reshape(-1) >= 0) & (right.reshape(-1) >= 0))
        place = self._home(key[todo])
        while len(todo):
            got = self.keys[place]
            hit = got == key[todo]
            out[todo[hit]] = self.ranks[place[hit]]
            on = ~hit & (got != -1)
            todo, place = todo[on], (place[on] + 1) & ((1 << self.bits) - 1)
        return out.reshape(shape)

    def encode_long(self, piece: bytes) -> np.ndarray:
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)]
        n = len(ids)
        heap = [(int(r), i) for i, r in enumerate(self.pair_ranks(ids[:-1], ids[1:])) if r != NONE]
        heapq.heapify(heap)
        ids, after, before, rank_at = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1)), dict((i, r) for r, i in heap)
        while heap:
            r, i = heapq.heappop(heap)
            if rank_at.get(i) != r:
                continue
            j = after[i]
            ids[i], ids[j] = r, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            rank_at.pop(j, None)
            for a in (before[i], i):
                if a >= 0:
                    rank_at.pop(a, None)
                    if after[a] < n:
                        new = int(self.pair_ranks(np.array([ids[a]], np.int32), np.array([ids[after[a]]], np.int32))[0])
                        if new != NONE:
                            rank_at[a] = new
                            heapq.heappush(heap, (new, a))
        return np.array([x for x in ids if x >= 0], np.int32)

    def encode_rows(self, pieces: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """Token matrix (padded with -1) and row lengths of pieces of at most ``width`` bytes."""
        rows = len(pieces)
        size = np.array([len(p) for p in pieces])
        tokens = np.full((rows, width), -1, np.int32)
        inside = np.arange(width) < size[:, None]
        tokens[inside] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        if width < 2:
            return tokens, size
        out, length = tokens.copy(), size.copy()
        at = np.arange(rows)  # rows still in work
        ranks = self.pair_ranks(tokens[:, :-1], tokens[:, 1:])
        column = np.arange(width)
        while len(at):
            j = ranks.argmin(axis=1)
            least = ranks[np.arange(len(at)), j]
            done = least == NONE
            if done.any():
                out[at[done]] = tokens[done]
                length[at[done]] = size[done]
                go = ~done
                at, tokens, ranks, size, j, least = at[go], tokens[go], ranks[go], size[go], j[go], least[go]
                if not len(at):
                    break
            r = np.arange(len(at))
            moved = np.concatenate([tokens[:, 1:], np.full((len(at), 1), -1, np.int32)], axis=1)
            tokens = np.where(column > j[:, None], moved, tokens)
            tokens[r, j] = least
            size = size - 1
            moved = np.concatenate([ranks[:, 1:], np.full((len(at), 1), NONE, np.int32)], axis=1)
            ranks = np.where(column[:-1] > j[:, None], moved, ranks)
            right = np.where(j + 1 < width, tokens[r, np.minimum(j + 1, width - 1)], -1)
            inner = j < width - 1
            ranks[r[inner], j[inner]] = self.pair_ranks(tokens[r, j], right)[inner]
            has = j > 0
            ranks[r[has], j[has] - 1] = self.pair_ranks(tokens[r[has], j[has] - 1], tokens[r[has], j[has]])
        return out, length

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after the other, and the number of ids of each."""
        sizes = np.array([len(p) for p in pieces])
        counts = np.zeros(len(pieces), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []  # (place in the output by piece, ids)
        width = 2
        low = 0
        while low < LONG:
            here = np.flatnonzero((sizes > low) & (sizes <= width))
            step = max(1, CELLS // width)
            for s in range(0, len(here), step):
                some = here[s : s + step]
                tokens, n = self.encode_rows([pieces[i] for i in some], width)
                counts[some] = n
                parts.append((np.repeat(some, n), tokens[np.arange(width) < n[:, None]]))
            low, width = width, min(2 * width, LONG)
        for i in np.flatnonzero(sizes > LONG):
            ids = self.encode_long(pieces[i])
            counts[i] = len(ids)
            parts.append((np.full(len(ids), i), ids))
        if not parts:
            return np.zeros(0, np.int32), counts
        owner = np.concatenate([a for a, _ in parts])
        return np.concatenate([b for _, b in parts])[np.argsort(owner, kind="stable")], counts


def gather(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """flat[s : s + n] for each (s, n), one after the other."""
    first = np.cumsum(counts) - counts
    return flat[np.repeat(starts - first, counts) + np.arange(int(counts.sum()))]


class _Encoder:
    def __init__(self, vocabulary: Vocabulary):
        import regex

        self.vocabulary, self.split = vocabulary, regex.compile(vocabulary.pattern).findall
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.starts, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.forget()
        known, old = self.known, len(self.known)
        rows = [[known.setdefault(p, len(known)) for p in self.split(t)] for t in texts]
        new = [p.encode() for p in list(known)[old:]]
        ids, counts = self.vocabulary.encode(new)
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(counts) - counts])
        self.counts, self.flat = np.concatenate([self.counts, counts]), np.concatenate([self.flat, ids])
        out = []
        for row in rows:
            at = np.array(row, np.int64)
            out.append(gather(self.flat, self.starts[at], self.counts[at]).astype("<u4").tobytes())
        return out


def load_vocabulary(path: str, pattern: str) -> Vocabulary:
    with open(path, "rb") as f:
        return Vocabulary(f.read().split(b"\n"), pattern)


def _whole(schema, name: str):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import BinaryType, StructField, StructType

    fields = StructType([f for f in schema.fields if f.name != name] + [StructField(name, BinaryType())])
    return fields, to_arrow_schema(fields)


def bpe_encode(spark: SparkSession, docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """``docs`` with a column ids: the token ids of the whole ``text`` as little-endian unsigned 32-bit integers.

    Special tokens are not known: their strings are ordinary text. A null or empty text has no ids (an empty value).
    Bytes that are not UTF-8 count as U+FFFD. Other columns, extra ones too, pass through; an input column named ids is
    replaced."""
    shared = spark.sparkContext.broadcast(vars(vocabulary))  # arrays only: a broadcast object would need this package on the executors
    schema, arrow = _whole(docs.schema, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _Encoder(Vocabulary.of(shared.value))
        for batch in batches:
            out: list[bytes] = []
            some: list[str] = []
            size = 0
            for t in batch.column(text).cast(pa.large_binary()):
                some.append((t.as_py() or b"").decode("utf-8", "replace"))
                size += len(some[-1])
                if size >= TOGETHER:
                    out += encoder(some)
                    some, size = [], 0
            out += encoder(some)
            yield pa.RecordBatch.from_arrays([pa.array(out, f.type) if f.name == "ids" else batch.column(f.name).cast(f.type)
                                              for f in arrow], schema=arrow)

    return docs.mapInArrow(run, schema)


def bpe_decode(spark: SparkSession, docs: DataFrame, vocabulary: Vocabulary, ids: str = "ids") -> DataFrame:
    """``docs`` with a column decoded: the bytes that the packed ``ids`` stand for. Null ids give empty bytes; an id
    outside the vocabulary fails. Other columns pass through; an input column named decoded is replaced."""
    shared = spark.sparkContext.broadcast(vars(vocabulary))
    schema, arrow = _whole(docs.schema, "decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary.of(shared.value)
        for batch in batches:
            out = []
            for t in batch.column(ids).cast(pa.large_binary()):
                got = np.frombuffer(t.as_py() or b"", "<u4").astype(np.int64)
                out.append(gather(v.flat, v.starts[got], (v.ends - v.starts)[got]).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out, f.type) if f.name == "decoded" else batch.column(f.name).cast(f.type)
                                              for f in arrow], schema=arrow)

    return docs.mapInArrow(run, schema)


def token_arrays(df: DataFrame, ids: str = "ids") -> DataFrame:
    """``df`` with the packed ``ids`` unpacked into an array of longs."""
    digits = F.hex(ids)
    one = lambda i: F.conv(F.concat(*(F.substring(digits, i * 8 + k, 2) for k in (7, 5, 3, 1))), 16, 10).cast("long")
    n = F.octet_length(ids) / 4
    return df.withColumn(ids, F.when(n >= 1, F.transform(F.sequence(F.lit(0), n.cast("int") - 1), one)).otherwise(
        F.array().cast("array<long>")))
