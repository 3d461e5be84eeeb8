"""Ranked lexical search: best-first document intervals under range-maximum sparse tables.

Documents are reduced to their number of terms and to the counts of the terms that queries hold; that
table and the few totals it takes (documents, terms, documents per term) are the only passes over texts.
Each task packs its documents, in the order of their ids, into shards of bounded postings. A
posting list holds a term's documents and impacts; all lists of a shard share one sparse table, whose
level j has the place of the greatest impact among 2 ** j neighbouring postings.

A query begins with the shard as one interval. The bound of an interval is the sum, over the query's
terms, of weight times the greatest impact inside it, two table reads a term. The intervals of
highest bound are split first, each at the document of its greatest single impact; that document is
scored, and the two rests are bounded. Intervals leave once their bound cannot enter the best
``k`` any more, ties by smaller id included. Splits are made for many intervals at once, so a search is a
short series of array operations. The best of every shard are merged by a ranked window.

Queries are sent to the tasks in blocks of at most ``BLOCK`` bytes of terms; larger query sets take
several passes over the documents. A single query is never cut.

Defined results: null texts have no terms. Every row is a document of its own, also where ids repeat;
one without an id counts and can be found, after all others of its score. Rows that share an item's id
are one item with all their terms. Items without terms, and documents that score nothing, give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.tables import Scratch, prepare

BLOCK = 4 << 20  # bytes of query terms that are sent at once
POSTINGS = 1 << 20  # of a shard
DOCUMENTS = 1 << 16  # of a shard
CELLS = 1 << 15  # terms times intervals that are looked at in one step
PIECE = 1 << 20  # bytes of a text that are split at once
#: Bytes of terms are digits, letters and all that is not ASCII; the others part them. Only A-Z change case.
TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or bytes([b]).isalnum() else 32 for b in range(256))


def term_counts(text: bytes | None) -> Counter:
    """How often each term occurs in a UTF-8 text."""
    counts: Counter = Counter()
    rest, data = b"", (text or b"").translate(TERMS)
    for at in range(0, len(data), PIECE):
        piece = rest + data[at:at + PIECE]
        cut = piece.rfind(b" ") + 1 if at + PIECE < len(data) else len(piece)
        counts.update(piece[:cut].split())
        rest = piece[cut:]
    return counts


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, and terms with their counts, of rows (item_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [term_counts(t) for t in batch.column("text").to_pylist()]
            terms = pa.array([[t.decode() for t in c] for c in found], pa.list_(pa.string()))
            counts = pa.array([list(c.values()) for c in found], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), terms, counts], ["item_id", "terms", "counts"])

    rows = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").cast("binary").alias("text"))
    each = rows.mapInArrow(run, "item_id bigint, terms array<string>, counts array<bigint>")
    each = each.select("item_id", F.explode(F.arrays_zip("terms", "counts")).alias("t"))
    summed = each.groupBy("item_id", F.col("t.terms").alias("term")).agg(F.sum("t.counts").alias("n"))
    return summed.groupBy("item_id").agg(F.sort_array(F.collect_list(F.struct("term", "n"))).alias("terms"))


def blocks(items: DataFrame, most: int) -> Iterator[list[tuple[int | None, list[tuple[str, int]]]]]:
    """Items in runs of at most ``most`` bytes of terms; the driver holds one run at a time."""
    held, size = [], 0
    for row in items.toLocalIterator():
        terms = [(t.term, t.n) for t in row.terms]
        bytes_of = sum(len(t.encode()) + 8 for t, _ in terms)
        if held and size + bytes_of > most:
            yield held
            held, size = [], 0
        held.append((row.item_id, terms))
        size += bytes_of
    if held:
        yield held


def reduced(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms), and which terms of the vocabulary a document has how often."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            n, terms, counts = [], [], []
            for text in batch.column("text").to_pylist():
                found = term_counts(text)
                n.append(found.total())
                both = sorted((known[t], found[t]) for t in found.keys() & known.keys())
                terms.append([t for t, _ in both])
                counts.append([c for _, c in both])
            columns = [pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n", "terms", "counts"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n bigint, terms array<int>, counts array<bigint>")


@dataclass
class Totals:
    documents: int
    terms: int

    def length_part(self, n: int) -> int:
        return 100 - 25 + 25 * n * self.documents // self.terms


class Shard:
    """Posting lists of some documents and the sparse table over their impacts."""

    def __init__(self, doc_ids: list[int | None], lengths: list[int], terms: list[np.ndarray], counts: list[np.ndarray], totals: Totals):
        order = sorted(range(len(doc_ids)), key=lambda k: (doc_ids[k] is None, doc_ids[k] or 0))
        self.doc_ids = [doc_ids[k] for k in order]
        self.size = len(order)
        each = np.array([len(terms[k]) for k in order], np.int64)
        doc = np.repeat(np.arange(self.size, dtype=np.int64), each)
        term = np.concatenate([terms[k] for k in order]).astype(np.int64)
        tf = np.concatenate([counts[k] for k in order]).astype(np.int64)
        length = np.repeat(np.array([totals.length_part(lengths[k]) for k in order], np.int64), each)
        by_term = np.argsort(term, kind="stable")
        self.doc = doc[by_term]
        self.impact = (1_000_000_000 * tf // (1000 * tf + 12 * length))[by_term]
        # A term and a document as one ascending number.
        self.place = term[by_term] * (self.size + 1) + self.doc
        longest = int(np.bincount(term).max())
        self.log = np.zeros(longest + 1, np.int64)
        for k in range(2, longest + 1):
            self.log[k] = self.log[k // 2] + 1
        # Entries that cross the end of a list are never read.
        level = np.arange(len(self.doc), dtype=np.int32)
        self.table = [level]
        for j in range(int(self.log[longest])):
            half = 1 << j
            a, b = level[:-half], level[half:]
            best = level.copy()
            best[:-half] = np.where(self.impact[a] >= self.impact[b], a, b)
            level = best
            self.table.append(level)
        self.table = np.stack(self.table)

    def bound(self, weights: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bound and splitting document of intervals, given the postings (terms, intervals) that lie in them."""
        j = self.log[np.maximum(end - begin, 0)]
        some = end > begin
        first = self.table[j, np.where(some, begin, 0)]
        last = self.table[j, np.where(some, end - (1 << j), 0)]
        best = np.where(self.impact[first] >= self.impact[last], first, last)
        value = np.where(some, weights[:, None] * self.impact[best], 0)
        strongest = value.argmax(0)
        return value.sum(0), self.doc[best[strongest, np.arange(best.shape[1])]]

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores and places of the k best documents, equal scores by place."""
        base = (terms * (self.size + 1))[:, None]
        scores, places = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def postings(at: np.ndarray) -> np.ndarray:
            return np.searchsorted(self.place, base + at[None, :])

        left, right = np.zeros(1, np.int64), np.full(1, self.size, np.int64)
        bounds, splits = self.bound(weights, postings(left), postings(right))
        most, step = max(1, CELLS // len(terms)), 1
        while True:
            least = scores[-1] if len(scores) == k else 0
            worst = places[-1] if len(scores) == k else -1
            on = (bounds > least) | (bounds == least) & (left < worst)
            left, right, bounds, splits = left[on], right[on], bounds[on], splits[on]
            if not len(left):
                return scores, places
            step = min(2 * step, most)
            if len(left) > step:
                # The best come last.
                order = np.argpartition(bounds, len(bounds) - step)
                rest, now = order[:-step], order[-step:]
            else:
                rest, now = np.zeros(0, np.int64), np.arange(len(left))
            l, r, split = left[now], right[now], splits[now]
            at = postings(split)
            there = self.place[np.minimum(at, len(self.place) - 1)] == base + split[None, :]
            score = np.where(there, weights[:, None] * self.impact[np.minimum(at, len(self.place) - 1)], 0).sum(0)
            scores, places = np.concatenate([scores, score]), np.concatenate([places, split])
            best = np.lexsort((places, -scores))[:k]
            scores, places = scores[best], places[best]
            begin = np.concatenate([postings(l), at + there], axis=1)
            end = np.concatenate([at, postings(r)], axis=1)
            bound, new_splits = self.bound(weights, begin, end)
            left = np.concatenate([left[rest], l, split + 1])
            right = np.concatenate([right[rest], split, r])
            bounds, splits = np.concatenate([bounds[rest], bound]), np.concatenate([splits[rest], new_splits])


def searched(index: DataFrame, items: list[tuple[np.ndarray, np.ndarray]], totals: Totals, k: int, postings: int) -> DataFrame:
    """item (its number), doc_id and score of the k best documents of every shard."""
    sent = index.sparkSession.sparkContext.broadcast((items, totals))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
        held: list[list] = [[], [], [], []]
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            terms, counts = batch.column("terms"), batch.column("counts")
            flat = [c.flatten().to_numpy(zero_copy_only=False) for c in (terms, counts)]
            edges = np.cumsum(np.concatenate([[0], np.array(terms.value_lengths().to_pylist(), np.int64)]))
            held[0] += batch.column("doc_id").to_pylist()
            held[1] += batch.column("n").to_pylist()
            for part, values in zip(held[2:], flat, strict=True):
                part += np.split(values, edges[1:-1])
            size += int(edges[-1])
            if size >= postings or len(held[0]) >= DOCUMENTS:
                yield Shard(*held, sent.value[1])
                held, size = [[], [], [], []], 0
        if held[0]:
            yield Shard(*held, sent.value[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = sent.value[0]
        for shard in shards(batches):
            present = np.unique(shard.place // (shard.size + 1))
            numbers, ids, found = [], [], []
            for number, (terms, weights) in enumerate(queries):
                here = np.isin(terms, present)
                if here.any():
                    scores, places = shard.search(terms[here], weights[here], k)
                    numbers += [number] * len(scores)
                    ids += [shard.doc_ids[p] for p in places.tolist()]
                    found += scores.tolist()
            columns = [pa.array(numbers, pa.int32()), pa.array(ids, pa.int64()), pa.array(found, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    return index.mapInArrow(run, "item int, doc_id bigint, score bigint")


def rank(docs: DataFrame, items: DataFrame, k: int = 20, block: int = BLOCK, postings: int = POSTINGS) -> DataFrame:
    """item_id, rank, doc_id and score of the k highest-scoring documents (doc_id, text) of each item (item_id, text)."""
    spark = docs.sparkSession
    prepare(spark)
    scratch = Scratch(spark, "lexical")
    hits = spark.createDataFrame([], "item_id bigint, doc_id bigint, score bigint")
    for number, held in enumerate(blocks(scratch.save(item_terms(items), "items"), block)):
        terms = sorted({t.encode() for _, counted in held for t, _ in counted})
        known = {t: place for place, t in enumerate(terms)}
        index = scratch.save(reduced(docs, known), f"index-{number}")
        seen = index.where("n > 0").agg(F.count("*"), F.sum("n")).first()
        if not seen[0]:
            continue
        totals = Totals(seen[0], seen[1])
        # One number per term of the block comes to the driver.
        holding = dict(index.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
        weight = {t: math.floor(1000 * math.log((2 * totals.documents + 2) / (2 * n + 1))) for t, n in holding.items()}
        queries = []
        for _, counted in held:
            pairs = [(known[t.encode()], n) for t, n in counted]
            pairs = [(t, weight[t] * n) for t, n in pairs if weight.get(t, 0) > 0]
            queries.append((np.array([t for t, _ in pairs], np.int64), np.array([w for _, w in pairs], np.int64)))
        found = scratch.save(searched(index.where("size(terms) > 0"), queries, totals, k, postings), f"hits-{number}")
        names = spark.createDataFrame([(place, item) for place, (item, _) in enumerate(held)], "item int, item_id bigint")
        hits = hits.unionByName(found.join(names, "item").select("item_id", "doc_id", "score"))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
