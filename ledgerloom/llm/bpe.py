"""Byte-level BPE: a segment tree over byte positions finds the leftmost pair of minimum rank.

A text is split by the tokenizer's pattern, and each piece is encoded on its own: leaves hold the
rank of the pair that starts at a byte position (none for dead positions), inner nodes the minimum
below them. The root names the lowest rank, a descent that prefers the left child its leftmost
position. A merge relabels that position, drops its right neighbour, and makes three point updates
of logarithmic cost: the dropped leaf, the merged one, and the live neighbour on the left. Trees of
many short pieces are kept side by side in arrays and merged in step; long pieces get one tree each.

A piece that is itself in the vocabulary is that token. Decoding joins the tokens' bytes.

Defined results: a null text is empty and has no tokens. Rows are encoded one by one, so repeated
rows and ids change nothing; an empty table gives an empty one.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ledgerloom.llm.tables import prepare

NONE = np.int64(2**40)  # above every rank
TOGETHER = 64  # bytes of the longest pieces whose trees are merged in step
REMEMBERED = 150_000  # pieces a worker remembers; only speed depends on it


class Encoder:
    """One vocabulary: byte strings to ranks, which are the ids."""

    def __init__(self, vocabulary: bytes, pattern: str):
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}
        self.pattern = regex.compile(pattern)
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pairs = pairs
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)
        self.known: dict[str, bytes] = {}  # pieces seen lately
        self.older: dict[str, bytes] = {}  # those seen before them

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where the vocabulary lacks it."""
        keys = left << 32 | right
        at = np.searchsorted(self.pair_keys, keys)
        at[at == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NONE)

    def encode_short(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Ids of pieces of 2 to ``width`` bytes, a power of two; one tree a row, merged in step."""
        count, depth = len(pieces), width.bit_length() - 1
        sizes = np.array([len(p) for p in pieces])
        filled = np.arange(width) < sizes[:, None]
        square = np.zeros((count, width), np.int64)
        square[filled] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        forest = np.full((count, 2 * width), NONE)
        starts = filled[:, 1:]
        forest[:, width:2 * width - 1][starts] = self.rank_of(square[:, :-1][starts], square[:, 1:][starts])
        level = width // 2
        while level:
            forest[:, level:2 * level] = np.minimum(forest[:, 2 * level:4 * level:2], forest[:, 2 * level + 1:4 * level:2])
            level //= 2
        # Flat views: row r has its leaves from r * width on, its tree from r * 2 * width on.
        ids, tree, live = square.ravel(), forest.ravel(), filled.ravel().copy()
        after = np.tile(np.arange(1, width + 1), count)
        before = after - 2

        def put(root, leaf, ranks):
            """``root`` is where each row's tree begins."""
            node = leaf + width
            tree[root + node] = ranks
            for _ in range(depth):
                pair = root + (node | 1)
                ranks = np.minimum(tree[pair], tree[pair - 1])
                node = node >> 1
                tree[root + node] = ranks

        rows = np.flatnonzero(forest[:, 1] < NONE)
        while len(rows):
            root, first, size = rows * (2 * width), rows * width, sizes[rows]
            lowest = tree[root + 1]
            node = np.ones(len(rows), np.int64)
            for _ in range(depth):
                node = 2 * node
                node += tree[root + node] != lowest
            here = node - width
            gone = after[first + here]
            follow = after[first + gone]
            ids[first + here] = lowest
            after[first + here] = follow
            live[first + gone] = False
            put(root, gone, NONE)
            more = follow < size
            nearest = first + np.where(more, follow, here)
            ranks = np.where(more, self.rank_of(lowest, ids[nearest]), NONE)
            before[nearest[more]] = here[more]
            put(root, here, ranks)
            left = before[first + here]
            has = left >= 0
            left, first, root = left[has], first[has], root[has]
            put(root, left, self.rank_of(ids[first + left], lowest[has]))
            rows = rows[forest[rows, 1] < NONE]

        flat = ids[live].astype("<u4").tobytes()
        ends = np.cumsum(live.reshape(count, width).sum(1)) * 4
        return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def encode_long(self, piece: bytes) -> bytes:
        """Ids of one piece of any length, by one tree."""
        size = len(piece)
        width = 1 << (size - 1).bit_length()
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)]
        tree = np.full(2 * width, NONE)
        tree[width:width + size - 1] = self.rank_of(ids[:-1], ids[1:])
        level = width // 2
        while level:
            tree[level:2 * level] = np.minimum(tree[2 * level:4 * level:2], tree[2 * level + 1:4 * level:2])
            level //= 2
        tree, ids, none, pairs = tree.tolist(), ids.tolist(), int(NONE), self.pairs
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        live = bytearray(b"\x01") * size

        def put(leaf, rank):
            node = leaf + width
            tree[node] = rank
            while node > 1:
                node >>= 1
                low = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == low:
                    break
                tree[node] = low

        while tree[1] < none:
            lowest, node = tree[1], 1
            while node < width:
                node *= 2
                if tree[node] != lowest:
                    node += 1
            here = node - width
            gone = after[here]
            follow, left = after[gone], before[here]
            ids[here], after[here], live[gone] = lowest, follow, 0
            put(gone, none)
            if follow < size:
                before[follow] = here
                put(here, pairs.get(lowest << 32 | ids[follow], none))
            else:
                put(here, none)
            if left >= 0:
                put(left, pairs.get(ids[left] << 32 | lowest, none))
        return np.array([i for i, on in zip(ids, live, strict=True) if on], "<u4").tobytes()

    def learn(self, pieces: Iterable[str]) -> None:
        """Encode pieces that are not remembered yet."""
        groups: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            data = piece.encode()
            rank = self.ranks.get(data)
            if rank is not None:
                self.known[piece] = rank.to_bytes(4, "little")
            elif len(data) > TOGETHER:
                self.known[piece] = self.encode_long(data)
            else:
                groups.setdefault(1 << (len(data) - 1).bit_length(), []).append((piece, data))
        for width, members in groups.items():
            for at in range(0, len(members), 4096):
                part = members[at:at + 4096]
                self.known.update(zip((p for p, _ in part), self.encode_short([d for _, d in part], width), strict=True))

    def encode_texts(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; the texts' new pieces are learnt together."""
        split = [self.pattern.findall(text or "") for text in texts]
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        fresh = set().union(*split) - self.known.keys()
        back = fresh & self.older.keys()
        self.known.update((piece, self.older[piece]) for piece in back)
        self.learn(fresh - back)
        for pieces in split:
            yield b"".join(map(self.known.__getitem__, pieces))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def encoder(vocabulary: bytes, pattern: str) -> Encoder:
    """Built once in each Python worker."""
    return Encoder(vocabulary, pattern)


def read_vocabulary(path: str) -> bytes:
    """The rank file; a tokenizer's size bounds what is sent to the workers."""
    with open(path, "rb") as file:
        return file.read()


def encode(df: DataFrame, vocabulary: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), decoded: bool = False) -> DataFrame:
    """The ``keep`` columns, n_tokens, and token_ids as packed little-endian unsigned 32-bit integers.

    ``vocabulary`` is the path of a rank file, ``pattern`` what splits texts. With ``decoded`` the
    ids are decoded again in the same pass, and their bytes are returned too.
    """
    spark = df.sparkSession
    prepare(spark)
    sent = spark.sparkContext.broadcast(read_vocabulary(vocabulary))
    rows = df.select(*dict.fromkeys([*keep, text]))
    schema = ", ".join([f"`{n}` {t}" for n, t in rows.select(*keep).dtypes] + ["n_tokens bigint", "token_ids binary"] + ["decoded binary"] * decoded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(sent.value, pattern)
        for batch in batches:
            ids = list(coder.encode_texts(batch.column(text).to_pylist()))
            columns = [batch.column(n) for n in keep] + [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
            names = [*keep, "n_tokens", "token_ids"]
            if decoded:
                columns.append(pa.array([coder.decode(x) for x in ids], pa.binary()))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary: str, ids: str = "token_ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and the decoded bytes; null ids give null."""
    spark = df.sparkSession
    prepare(spark)
    sent = spark.sparkContext.broadcast(read_vocabulary(vocabulary))
    rows = df.select(*dict.fromkeys([*keep, ids]))
    schema = ", ".join([f"`{n}` {t}" for n, t in rows.select(*keep).dtypes] + ["decoded binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(sent.value, "")
        for batch in batches:
            out = [None if x is None else coder.decode(x) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in keep], pa.array(out, pa.binary())], [*keep, "decoded"])

    return rows.mapInArrow(run, schema)
