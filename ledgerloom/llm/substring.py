"""Substring dedup by seed and extend: repeated runs of words are removed but for their first place.

A window is ``window`` consecutive words. Winnowing picks each window's anchor, the leftmost of its
``seed``-word runs of least hash, so equal windows have equal anchors at equal offsets. Neighbouring
windows with one anchor form a stretch: the anchor extended both ways as far as it is chosen.

Documents meet on anchors that occur more than once. Stretches that agree in a second hash, of all their words
and of the anchor's place among them, repeat as a whole: all but the first place are removed. What is left are first places of
stretches whose anchor also stands in a different stretch, as at the edges of shared passages. They
are extended window by window: the text is read again, and each of their windows is matched with
windows of equal content. Matches on neighbouring starts together are the maximal repeats, at least
``window`` words long, and what they cover is removed.

Groups are reduced by minima that are combined before the shuffle, and joined back by Spark, which splits
crowded keys; no pairs of places are formed. Two 64-bit hashes name a stretch or window; words are not compared.

Defined results: null and empty texts have no words. Windows are judged on the input, so a first place
stays whole. Rows that repeat a document are judged alike; places of one id at one position are one
place. Rows without an id neither remove nor lose words. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.tables import Scratch, prepare

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


@lru_cache(maxsize=1)
def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE and its inverse to the powers 0 to ``size`` - 1, modulo 2^64."""
    up, down = np.full(size, BASE), np.full(size, INVERSE)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def words_of(text: str | None) -> list[bytes]:
    """Runs of anything but ASCII white space; bytes.split cuts there and nowhere else."""
    return (text or "").encode().split()


class Hashed:
    """A word sequence whose every run has a hash in constant time."""

    def __init__(self, words: list[bytes]):
        digest = xxhash.xxh3_64_intdigest
        own = np.fromiter(map(digest, words), np.uint64, len(words))
        room = max(1024, 1 << len(words).bit_length())
        self.up, down = (p[:len(words) + 1] for p in powers(room))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(own * down[:-1], dtype=np.uint64)])

    def run(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the runs [start, end): the same words give the same hash wherever they stand."""
        return mixed((self.sums[ends] - self.sums[starts]) * self.up[starts])


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stretches(words: list[bytes], window: int, seed: int) -> tuple[np.ndarray, ...]:
    """anchor hash, stretch hash, first window's start and number of windows of every stretch."""
    hashed, count = Hashed(words), len(words)
    at = np.arange(count - seed + 1)
    seeds = hashed.run(at, at + seed)
    anchor = sliding_window_view(seeds, window - seed + 1).argmin(axis=1) + np.arange(count - window + 1)
    first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    size = np.diff(np.r_[first, len(anchor)])
    place = anchor[first]
    whole = hashed.run(first, first + size - 1 + window)
    shape = (size * 4096 + (place - first)).astype(np.uint64)
    return seeds[place], mixed(whole + shape * BASE), first, size


def signed(hashes: list[np.ndarray]) -> pa.Array:
    return pa.array(np.concatenate(hashes).view(np.int64) if hashes else [], pa.int64())


def numbers(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    return pa.array(np.concatenate(parts) if parts else [], kind)


def seeds_table(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """anchor, stretch, doc_id, start, size: one row per stretch of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = words_of(text)
                if len(words) >= window:
                    row = stretches(words, window, seed)
                    found.append((*row, np.full(len(row[0]), doc, np.int64)))
            parts = list(zip(*found, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [signed(parts[0]), signed(parts[1]), numbers(parts[4], pa.int64()), numbers(parts[2], pa.int32()), numbers(parts[3], pa.int32())],
                ["anchor", "stretch", "doc_id", "start", "size"])

    return docs.mapInArrow(run, "anchor bigint, stretch bigint, doc_id bigint, start int, size int")


def windows_table(docs: DataFrame, window: int) -> DataFrame:
    """anchor, content, doc_id, start: one row per window of the stretches in ``open`` (anchor, start, size)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            for doc, text, rows in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "text", "open")), strict=True):
                hashed = Hashed(words_of(text))
                size = np.array([r["size"] for r in rows])
                start = np.repeat([r["start"] for r in rows], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                anchor = np.repeat(np.array([r["anchor"] for r in rows], np.int64), size)
                inside = start + window < len(hashed.sums)  # always so unless rows share an id but not a text
                start, anchor = start[inside], anchor[inside]
                found.append((anchor, hashed.run(start, start + window), np.full(len(start), doc, np.int64), start))
            parts = list(zip(*found, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [numbers(parts[0], pa.int64()), signed(parts[1]), numbers(parts[2], pa.int64()), numbers(parts[3], pa.int32())],
                ["anchor", "content", "doc_id", "start"])

    return docs.mapInArrow(run, "anchor bigint, content bigint, doc_id bigint, start int")


def later_places(scratch: Scratch, rows: DataFrame, content: str) -> DataFrame:
    """Rows (anchor, ``content``, doc_id, start) that are not the first place of their content.

    First places are stored before the join, so that Spark can split what is crowded on the other side.
    """
    place = F.struct("doc_id", "start")
    first = rows.groupBy("anchor", content).agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    first = scratch.save(first, f"first-{content}")
    return rows.join(first, ["anchor", content]).where("doc_id != first.doc_id or start != first.start").drop("first")


def repeats(docs: DataFrame, window: int = 20, seed: int = 6) -> DataFrame:
    """doc_id and spans (start, stop): words of ``docs`` (doc_id, text) that repeat an earlier window."""
    spark = docs.sparkSession
    prepare(spark)
    scratch = Scratch(spark, "substring")
    named = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id is not null")
    rows = scratch.save(seeds_table(named, window, seed), "seeds")
    shared = rows.groupBy("anchor").agg((F.min("stretch") != F.max("stretch")).alias("several"), F.count("*").alias("n")).where("n > 1").drop("n")
    met = scratch.save(rows.join(scratch.save(shared, "shared"), "anchor"), "met")
    scratch.drop("seeds")

    whole = later_places(scratch, met.select("anchor", "stretch", "doc_id", "start", "size"), "stretch")
    whole = scratch.save(whole.select("doc_id", "start", (F.col("start") + F.col("size") + (window - 1)).alias("stop")), "whole")
    first = met.where("several").groupBy("anchor", "stretch").agg(F.min(F.struct("doc_id", "start", "size")).alias("first"))
    open_rows = first.select("first.doc_id", F.struct("anchor", "first.start", "first.size").alias("row"))
    open_rows = scratch.save(open_rows.groupBy("doc_id").agg(F.collect_list("row").alias("open")), "open")
    scratch.drop("met")

    windows = scratch.save(windows_table(named.join(open_rows, "doc_id"), window), "windows")
    edges = later_places(scratch, windows, "content").select("doc_id", "start", (F.col("start") + window).alias("stop"))
    # Rows that repeat an id name the same places; combined per task, each place is kept once.
    spans = whole.unionByName(edges).groupBy("doc_id").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    spans = scratch.save(spans, "spans")
    for name in ("shared", "first-stretch", "open", "windows", "first-content", "whole"):
        scratch.drop(name)
    return spans


def without_repeats(docs: DataFrame, window: int = 20, seed: int = 6) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words that stay, joined by one space) for every row of ``docs``."""
    spans = repeats(docs, window, seed)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(spans, "doc_id", "left")
    return rows.mapInArrow(cut_out, "doc_id bigint, n_words bigint, n_removed bigint, kept string")


def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, removed, kept = [], [], []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            words = words_of(text)
            counts.append(len(words))
            if spans:
                change = np.zeros(len(words) + 1, np.int64)
                np.add.at(change, np.minimum([s["start"] for s in spans], len(words)), 1)
                np.add.at(change, np.minimum([s["stop"] for s in spans], len(words)), -1)
                stays = np.cumsum(change[:-1]) == 0
                words = [words[k] for k in np.flatnonzero(stays).tolist()]
            removed.append(counts[-1] - len(words))
            kept.append(b" ".join(words).decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
            ["doc_id", "n_words", "n_removed", "kept"])
