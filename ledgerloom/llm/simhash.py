"""SimHash near-duplicates by bit-sliced comparison.

A text's fingerprint has a bit set where more than half of its shingle hashes have it. Distinct
fingerprints are dealt into buckets: the 64 bits are cut into ``radius + 2`` pieces, and two
fingerprints within the radius agree on at least two whole pieces, so each pair of pieces is a key.

Each task reads its buckets in key order and packs whole ones into blocks. A block's bits are
stored vertically, one plane of lanes per bit. All distances of a block grow together: the planes'
differences go through carry-save counters (ones, twos, ...) whose last carry marks lanes beyond
the radius, and rows whose lanes are all beyond it are abandoned. Lanes of neighbouring buckets in
a block are compared along with the rest; a link found there is a link. A block returns a spanning
forest of its links, so groups of copies never grow into all pairs.

A bucket above ``BLOCK`` rows is dealt again: among the bits it does not share yet, cut into
``radius + 1`` groups, a close pair agrees on one whole group. That repeats until buckets are small;
at the latest when so few bits are open that no more distinct fingerprints exist.

Defined results: null and empty texts have fingerprint zero and link like any other. Repeated rows
and ids are all returned. Rows without an id link nothing; they get the component of an equal
fingerprint that rows with ids have, else null. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import components
from ledgerloom.llm.tables import Scratch, is_empty, prepare

BITS = 64
BLOCK = 2048  # most rows of a block, and of a bucket that is compared as a whole
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
ROWS = "key bigint, shared bigint, print bigint, rep bigint"


def shingle_hashes(text: str | None, words: int, seed: int) -> list[int]:
    """XXH64 of each run of ``words`` words, or of the whole sequence where there are fewer."""
    # bytes.lower changes A-Z alone and bytes.split cuts at ASCII white space alone, as is asked for.
    found = (text or "").encode().lower().split()
    if not found:
        return []
    digest = xxhash.xxh64_intdigest
    if len(found) < words:
        return [digest(b" ".join(found), seed)]
    return [digest(b" ".join(run), seed) for run in zip(*[found[k:] for k in range(words)], strict=False)]


def fingerprint(hashes: list[int]) -> int:
    """The majority of each bit as a signed 64-bit number; no hashes give zero."""
    counts = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 8192):
        part = np.array(hashes[start:start + 8192], "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42) -> DataFrame:
    """doc_id and print, a signed 64-bit number, for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(shingle_hashes(t, words, seed)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints, pa.int64())], ["doc_id", "print"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, print bigint")


def cut(positions: list[int], groups: int) -> list[int]:
    """Masks of nearly equal runs of the bit positions."""
    edges = [len(positions) * k // groups for k in range(groups + 1)]
    return [sum(1 << p for p in positions[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def planes_of(prints: np.ndarray, lanes: int) -> np.ndarray:
    """(64, lanes / 64): plane b has bit b of every fingerprint."""
    padded = np.zeros(lanes, "<u8")
    padded[:len(prints)] = prints
    bits = np.unpackbits(padded.view(np.uint8).reshape(lanes, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def close_pairs(prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j), i < j, of all pairs within ``radius`` differing bits."""
    count = len(prints)
    lanes = -(-count // 64) * 64
    planes = planes_of(prints, lanes)
    flips = np.unpackbits(prints.astype("<u8").view(np.uint8).reshape(count, 8), axis=1, bitorder="little").T
    flips = np.where(flips, ALL, np.uint64(0))
    width = radius.bit_length()
    rows = np.arange(count)
    # Lanes up to a row's own are beyond from the start: each pair is looked at once.
    beyond = np.packbits((np.arange(lanes) <= rows[:, None]) | (np.arange(lanes) >= count), axis=1, bitorder="little").view("<u8")
    # Counters begin so high that the last carry falls exactly when a distance passes the radius.
    begin = (1 << width) - 1 - radius
    counters = [np.full(beyond.shape, ALL if begin >> k & 1 else np.uint64(0)) for k in range(width)]
    for bit in range(BITS):
        carry = planes[bit] ^ flips[bit, rows, None]
        for k, counter in enumerate(counters):
            counters[k], carry = counter ^ carry, counter & carry
        beyond |= carry
        if bit >= 11 and bit % 4 == 3:
            open_rows = (beyond != ALL).any(axis=1)
            if not open_rows.all():
                rows, beyond = rows[open_rows], beyond[open_rows]
                counters = [c[open_rows] for c in counters]
                if not len(rows):
                    break
    near = np.unpackbits((~beyond).view(np.uint8), axis=1, bitorder="little")
    at, other = np.nonzero(near)
    return rows[at], other


def forest(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest position reachable from each of ``count`` positions."""
    root = np.arange(count)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    while (root != root[root]).any():
        root = root[root]
    return root


class Buckets:
    """Reads rows in key order; gives links of whole blocks, and rows of buckets to deal again."""

    def __init__(self, radius: int, block: int):
        self.radius, self.block = radius, block
        self.a, self.b, self.again = [], [], []

    def compare(self, prints: np.ndarray, reps: np.ndarray) -> None:
        i, j = close_pairs(prints, self.radius)
        if len(i):
            root = forest(len(prints), i, j)
            moved = np.flatnonzero(root != np.arange(len(root)))
            self.a.append(reps[moved])
            self.b.append(reps[root[moved]])

    def deal_again(self, key: int, shared: int, prints: np.ndarray, reps: np.ndarray) -> None:
        open_bits = [p for p in range(BITS) if not shared >> p & 1]
        for mask in cut(open_bits, self.radius + 1):
            if mask:
                parts = (prints & np.uint64(mask)).tolist()
                keys = [xxhash.xxh64_intdigest(f"{key}/{mask}/{part}") - (1 << 63) for part in parts]
                self.again.append((keys, [signed(shared | mask)] * len(keys), prints.view(np.int64), reps))

    def take(self) -> pa.RecordBatch:
        """What has gathered, as one batch."""
        again = [np.concatenate([np.asarray(x[k], np.int64) for x in self.again]) if self.again else np.zeros(0, np.int64) for k in range(4)]
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (self.a, self.b))
        self.a, self.b, self.again = [], [], []
        first, second = pa.nulls(len(again[0]), pa.int64()), pa.nulls(len(a), pa.int64())
        columns = [pa.concat_arrays([pa.array(x, pa.int64()), first]) for x in (a, b)]
        columns += [pa.concat_arrays([second, pa.array(x, pa.int64())]) for x in again]
        return pa.RecordBatch.from_arrays(columns, ["a", "b", "key", "shared", "print", "rep"])

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 4
        crowded = None  # the key whose rows are being dealt again as they come
        for batch in batches:
            rows = [np.concatenate([h, batch.column(n).to_numpy()]) for h, n in zip(held, ("key", "shared", "print", "rep"), strict=True)]
            starts = np.flatnonzero(np.r_[True, rows[0][1:] != rows[0][:-1]]) if len(rows[0]) else np.zeros(0, np.int64)
            ends = np.r_[starts[1:], len(rows[0])]
            crowded = self.blocks(rows, starts[:-1], ends[:-1], crowded)
            if len(starts):
                last = slice(starts[-1], None)
                held = [x[last] for x in rows]
                if len(held[0]) > self.block or held[0][0] == crowded:
                    crowded = self.blocks(held, np.zeros(1, np.int64), np.array([len(held[0])]), crowded, whole=False)
                    held = [x[:0] for x in held]
            yield self.take()
        if len(held[0]):
            self.blocks(held, np.zeros(1, np.int64), np.array([len(held[0])]), crowded)
            yield self.take()

    def blocks(self, rows, starts, ends, crowded, whole=True):
        """Compare whole buckets in blocks; returns the key that is being dealt again, if any."""
        keys, shared, prints, reps = rows[0], rows[1], rows[2].view(np.uint64), rows[3]
        at = None
        for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
            key = int(keys[start])
            if key == crowded or end - start > self.block:
                self.deal_again(key, int(shared[start]) & int(ALL), prints[start:end], reps[start:end])
                crowded = None if whole else key
                if at is not None and start > at:
                    self.compare(prints[at:start], reps[at:start])
                at = None
                continue
            if at is None:
                at = start
            if end - at > self.block:
                self.compare(prints[at:start], reps[at:start])
                at = start
        if at is not None and len(ends) and ends[-1] > at:
            self.compare(prints[at:ends[-1]], reps[at:ends[-1]])
        return crowded


def near_links(scratch: Scratch, prints: DataFrame, radius: int = 3, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between representatives that connect all distinct prints within the radius.

    ``prints`` has one row per distinct print with its representative ``rep``.
    """
    pieces = cut(list(range(BITS)), radius + 2)
    masks = [signed(x | y) for k, x in enumerate(pieces) for y in pieces[:k]]
    keys = F.explode(F.array(*[F.struct(F.xxhash64(F.lit(m), F.col("print").bitwiseAND(F.lit(m))).alias("key"), F.lit(m).alias("shared")) for m in masks]))
    rows = prints.select(keys.alias("k"), "print", "rep").select("k.key", "k.shared", "print", "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from Buckets(radius, block).run(batches)

    links, level = None, 0
    while True:
        dealt = rows.repartition("key").sortWithinPartitions("key")
        found = scratch.save(dealt.mapInArrow(run, f"a bigint, b bigint, {ROWS}"), f"compared-{level}")
        part = found.where("a is not null").select("a", "b")
        links = part if links is None else links.unionByName(part)
        rows, level = found.where("a is null").select("key", "shared", "print", "rep"), level + 1
        if is_empty(rows):
            return links


def near_duplicates(docs: DataFrame, radius: int = 3, words: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id for every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    prepare(spark)
    scratch = Scratch(spark, "simhash")
    prints = scratch.save(fingerprints(docs, words, seed), "prints")
    distinct = scratch.save(prints.where("doc_id is not null").groupBy("print").agg(F.min("doc_id").alias("rep")), "distinct")
    merged = components(scratch, near_links(scratch, distinct, radius))
    groups = distinct.join(merged, F.col("rep") == F.col("node"), "left").select("print", F.coalesce("component", "rep").alias("component_id"))
    named = prints.join(groups, "print", "left")
    return named.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
