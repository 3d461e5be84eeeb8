"""Approximate nearest neighbours by a forest of hash prefixes.

Every tree gives a vector a long string of hash bits, one per random hyperplane through the shard's
mean. A tree is the sorted array of its strings. A query descends each tree to the rows with the
longest common prefix and then ascends all trees in step: with every bit that is given up, the
ranges of rows that share the shorter prefix grow, until together they hold enough candidates.
Candidates are ranked by their exact distance in double precision.

How many candidates are enough is measured: rows of the shard are searched and compared with brute
force, and the number is raised until the share of true neighbours found reaches ``recall``. Each
shard gives its best for a query, and the best of all shards are kept.

Defined results: vectors that are null, empty or zero, or hold null or non-finite components, and rows
without an id, neither ask nor answer; vectors of different lengths are no candidates of one another.
A row that repeats an id with the same vector counts once; rows with the query's id are never
its candidates. Equal distances go to the smaller id. With fewer candidates than asked for, all are given.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.shards import distinct_vectors, search_table, searched, stacked, with_shards
from ledgerloom.llm.tables import Scratch, prepare


@dataclass(frozen=True)
class Settings:
    nearest: int = 10
    trees: int = 64
    bits: int = 32
    shard_rows: int = 16384
    query_rows: int = 32768
    recall: float = 0.98
    audits: int = 96
    seed: int = 11


class Forest:
    """One shard: vectors (double) with ids, and each tree's sorted strings with the rows they belong to."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, settings: Settings):
        self.ids, self.vectors, self.settings = ids, vectors, settings
        random = np.random.default_rng(settings.seed)
        self.planes = random.normal(size=(vectors.shape[1], settings.trees * settings.bits))
        self.scale = np.abs(vectors).max()
        self.middle = (vectors / self.scale).mean(axis=0)
        strings = self.strings(vectors)
        self.rows = np.argsort(strings, axis=1, kind="stable")
        self.sorted = np.take_along_axis(strings, self.rows, 1)
        self.enough = min(len(ids), max(8 * settings.nearest, len(ids) // 16))
        self.audit()

    def strings(self, vectors: np.ndarray) -> np.ndarray:
        """(trees, vectors): hash strings of 8, 16 or 32 bits as unsigned integers, the first bit highest."""
        s, out = self.settings, []
        for start in range(0, len(vectors), 2048):
            sides = (vectors[start:start + 2048] / self.scale - self.middle) @ self.planes > 0
            packed = np.packbits(sides.reshape(-1, s.trees, s.bits), axis=2)
            out.append(packed.view(f">u{s.bits // 8}")[:, :, 0].T.astype(np.uint64))
        return np.concatenate(out, axis=1)

    def candidates(self, vectors: np.ndarray) -> list[np.ndarray]:
        """Rows that share the longest prefixes with each vector, at least ``enough`` of them where there are."""
        s = self.settings
        strings = self.strings(vectors)
        low = np.zeros((len(vectors), s.trees), np.int64)
        high = np.zeros((len(vectors), s.trees), np.int64)
        open_queries = np.arange(len(vectors))
        held: list[np.ndarray] = [np.zeros(0, np.int64)] * len(vectors)
        for given_up in range(s.bits + 1):
            step = np.uint64(given_up)
            for tree in range(s.trees):
                prefix = strings[tree, open_queries] >> step << step
                low[open_queries, tree] = np.searchsorted(self.sorted[tree], prefix)
                high[open_queries, tree] = np.searchsorted(self.sorted[tree], prefix + (np.uint64(1) << step))
            # Trees share rows, so the ranges' sizes only say when it is worth counting.
            ripe = (high - low)[open_queries].sum(1) >= self.enough
            for q in open_queries[ripe].tolist():
                held[q] = np.unique(np.concatenate([self.rows[t, low[q, t]:high[q, t]] for t in range(s.trees)]))
            open_queries = np.array([q for q in open_queries.tolist() if len(held[q]) < self.enough], np.int64)
            if not len(open_queries):
                break
        return held

    def nearest(self, vectors: np.ndarray, own: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids and distances of the best candidates of each vector, without its own id."""
        out = []
        for vector, mine, rows in zip(vectors, own.tolist(), self.candidates(vectors), strict=True):
            rows = rows[self.ids[rows] != mine]
            out.append(self.best(vector, rows))
        return out

    def best(self, vector: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        distance = np.sqrt(((self.vectors[rows] - vector) ** 2).sum(axis=1))
        order = np.lexsort((self.ids[rows], distance))[:self.settings.nearest]
        return self.ids[rows[order]], distance[order]

    def audit(self) -> None:
        """Raise ``enough`` until neighbours of rows in this shard are found often enough."""
        s, count = self.settings, len(self.ids)
        picked = np.random.default_rng(s.seed).choice(count, min(count, s.audits), replace=False)
        everything = np.arange(count)
        wanted = [set(self.best(self.vectors[p], everything[self.ids != self.ids[p]])[0].tolist()) for p in picked]
        while self.enough < count:
            got = self.nearest(self.vectors[picked], self.ids[picked])
            found = sum(len(w & set(g.tolist())) for w, (g, _) in zip(wanted, got, strict=True))
            if found >= s.recall * sum(map(len, wanted)):
                return
            self.enough = min(count, self.enough * 5 // 4)


def nearest_neighbours(rows: DataFrame, asks: Column, vec_id: str = "vec_id", vector: str = "embedding", settings: Settings = Settings()) -> DataFrame:
    """query_id, rank (from 1), vec_id and score (Euclidean distance) for the rows of which ``asks`` (on vec_id) holds."""
    spark = rows.sparkSession
    prepare(spark)
    scratch = Scratch(spark, "forest")
    placed, _ = with_shards(scratch, scratch.save(distinct_vectors(rows, vec_id, vector), "vectors"), settings.shard_rows)
    placed = scratch.save(placed, "placed")
    queries = placed.where(asks).select("vec_id", "vector", "dim", "shards")
    total = queries.count()

    def build(held: list[pa.RecordBatch]) -> Forest:
        all_rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        return Forest(all_rows.column("vec_id").to_numpy(), stacked(all_rows.column("vector")), settings)

    def search(forest: Forest, asked: pa.RecordBatch) -> pa.RecordBatch:
        ids = asked.column("vec_id").to_numpy()
        found = forest.nearest(stacked(asked.column("vector")), ids)
        sizes = [len(x) for x, _ in found]
        return pa.RecordBatch.from_arrays([
            pa.array(np.repeat(ids, sizes), pa.int64()), pa.array(np.concatenate([x for x, _ in found]), pa.int64()),
            pa.array(np.concatenate([d for _, d in found]), pa.float64()),
        ], ["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from searched(batches, build, search)

    table = search_table(placed.select("dim", "shard", "vec_id", "vector"), queries, settings.query_rows, total)
    found = scratch.save(table.mapInArrow(run, "query_id bigint, vec_id bigint, score double"), "found")
    # A shard gives at most ``nearest`` rows for a query; a query that repeats with other vectors keeps its nearest.
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= settings.nearest).select("query_id", "rank", "vec_id", "score")
