"""Vectors dealt into shards of bounded size, and searches of every shard in slices of queries.

An index of a shard is built by one task from at most about ``rows`` vectors. Searching deals the
index again for every slice of queries, so that neither a shard's memory nor a task's queries grow
with the table: a task reads the index rows of its shard and slice first and then streams queries.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.tables import Scratch


def usable(vector: Column) -> Column:
    """Neither null, empty nor zero, and without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def distinct_vectors(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id and vector (array of double) of every different usable row that has an id."""
    named = rows.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    return named.where(F.col("vec_id").isNotNull() & usable(F.col("vector"))).distinct()


def with_shards(scratch: Scratch, vectors: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """Adds ``dim`` and ``shard``, a number within the dimension; also gives the number of vectors.

    Vectors of different lengths have no distance, so each length has shards of its own. The counts
    are a stored table of one row per length, whose size Spark knows when it joins them.
    """
    sized = vectors.withColumn("dim", F.size("vector"))
    counts = sized.groupBy("dim").agg(F.count("*").alias("n")).withColumn("shards", F.ceil(F.col("n") / rows).cast("int"))
    counts = scratch.save(counts, "lengths")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    spread = F.pmod(F.xxhash64("vec_id", "vector"), F.col("shards"))
    return sized.join(counts.drop("n"), "dim").withColumn("shard", spread.cast("int")), total


def search_table(index: DataFrame, queries: DataFrame, query_rows: int, total: int) -> DataFrame:
    """Index rows and queries in one table, dealt by (dim, shard, slice) with index rows first.

    ``queries`` has dim and shards; each goes to every shard of its dimension in its own slice.
    """
    slices = max(1, -(-total // query_rows))
    placed = F.pmod(F.xxhash64(F.lit("slice"), "vec_id"), F.lit(slices)).cast("int")
    asked = queries.withColumn("slice", placed).withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    held = index.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    both = held.withColumn("asks", F.lit(False)).unionByName(asked.withColumn("asks", F.lit(True)), allowMissingColumns=True).drop("shards")
    return both.repartition("dim", "shard", "slice").sortWithinPartitions("dim", "shard", "slice", "asks")


def stacked(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def runs(batch: pa.RecordBatch, names: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Consecutive rows of a batch with the same values of ``names``."""
    if not batch.num_rows:
        return
    columns = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
    changed = np.zeros(batch.num_rows, bool)
    changed[0] = True
    for c in columns:
        changed[1:] |= c[1:] != c[:-1]
    starts = np.flatnonzero(changed).tolist()
    for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
        yield tuple(c[a].item() for c in columns), batch.slice(a, b - a)


def searched(batches: Iterator[pa.RecordBatch], build: Callable, search: Callable) -> Iterator[pa.RecordBatch]:
    """Runs over a table of ``search_table``: ``build(batches)`` makes a shard's index, ``search(index, batch)`` answers."""
    key, held, index = None, [], None
    for batch in batches:
        for (dim, shard, part, asks), rows in runs(batch, ["dim", "shard", "slice", "asks"]):
            if (dim, shard, part) != key:
                key, held, index = (dim, shard, part), [], None
            if not asks:
                held.append(rows)
                continue
            if index is None:
                index = build(held)
                held = []
            yield search(index, rows)
