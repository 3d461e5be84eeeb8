"""Near-duplicates by SimHash, every link verified by the Jaccard similarity of word shingles.

Texts of one shingle set are one node. SimHash proposes links: nodes whose fingerprints over ``PRINT_WORDS`` words are connected
by steps of at most ``RADIUS`` bits (``simhash.near_links``) are a bucket. Sets of similarity 0.8 can lie beyond any radius that is searched
in linear work; for those a set is also sketched by ``BANDS * ROWS`` minima of salted hashes, each band of ``ROWS`` minima a
bucket key. Two sets of similarity 0.8 share no such bucket with a chance of (1 - 0.8 ** ROWS) ** BANDS, below one in a million.
Buckets only propose: a link is made where the shared and the total number of shingles say so. Shingles are compared by 64-bit hashes.

A bucket's nodes are first compared with its smallest one, which is linear in them; equal texts and most copies are
linked by that. Where it leaves several components in a bucket, the buckets' nodes form groups: what such
buckets connect. A group's nodes are compared inside tasks, in pairs of blocks of bounded nodes and
shingles, by counting shared shingles through an inverted list; a task returns a spanning forest of its links, so no
candidate pairs are written. Work in a group grows with the square of its nodes, its rows do not. Texts are read
again for nodes that share a bucket, for no others.

Defined results: null and empty texts have the empty set and are one node; rows without an id link
nothing. Texts of fewer words than a shingle have one shingle, as in ``simhash``. Rows are told apart by id
and digest of the text, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.components import components
from ledgerloom.llm.hnsw import spanning
from ledgerloom.llm.shards import runs
from ledgerloom.llm.simhash import fingerprint, near_links, shingle_hashes
from ledgerloom.llm.tables import Scratch, digest_of, is_empty, prepare, sieve, sifted, spare_names

WORDS, SEED = 5, 42
#: Of the fingerprints. Over two words they keep similar texts closer than over five: of the 48 pairs of different sets in sf0.1
#: that are near-duplicates, 37 lie within 6 bits over two words, 9 over five.
PRINT_WORDS, RADIUS = 2, 6
#: Similarity from which two texts are near-duplicates, as a fraction of whole numbers.
SHARED, OF = 4, 5
BANDS, ROWS = 36, 5
NODES, SHINGLES = 4096, 1 << 20  # of a block of a group, about
FOREST = 1 << 20  # links that a task gathers before it reduces them to a forest
RANDOM = np.random.default_rng(SEED)
SALT = RANDOM.integers(0, 2**64, (BANDS * ROWS, 1), np.uint64)
ODD = RANDOM.integers(0, 2**64, (BANDS * ROWS, 1), np.uint64) | np.uint64(1)


def shingle_set(text: str | None) -> np.ndarray:
    return np.unique(np.array(shingle_hashes(text, WORDS, SEED), np.uint64))


def band_keys(shingles: np.ndarray) -> list[int]:
    """A signed key for each band; none for the empty set."""
    if not len(shingles):
        return []
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for start in range(0, len(shingles), 1024):
        least = np.minimum(least, ((shingles[None, start:start + 1024] ^ SALT) * ODD).min(1))
    return [xxhash.xxh64_intdigest(least[k * ROWS:(k + 1) * ROWS].tobytes(), k) - 2**63 for k in range(BANDS)]


def lists(values: list) -> pa.Array:
    edges = np.cumsum([0, *map(len, values)])
    flat = np.concatenate([np.asarray(v, np.int64) for v in values]) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(flat, pa.int64()))


def sketched(texts: DataFrame) -> DataFrame:
    """doc_id, digest, node (a digest of the shingle set), size, print (its fingerprint) and keys of rows (doc_id, digest, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            sets = [shingle_set(t) for t in texts]
            prints = [fingerprint(shingle_hashes(t, PRINT_WORDS, SEED)) for t in texts]
            nodes = [xxhash.xxh64_intdigest(s.tobytes()) - 2**63 for s in sets]
            made = [pa.array(nodes, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints, pa.int64()), lists([band_keys(s) for s in sets])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), *made], ["doc_id", "digest", "node", "size", "print", "keys"])

    return texts.mapInArrow(run, "doc_id bigint, digest string, node bigint, size bigint, print bigint, keys array<bigint>")


def shingle_sets(texts: DataFrame) -> DataFrame:
    """node and its shingles for rows (node, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t).view(np.int64) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), lists(sets)], ["node", "shingles"])

    return texts.mapInArrow(run, "node bigint, shingles array<bigint>")


def by_fingerprint(spark: SparkSession, nodes: DataFrame) -> DataFrame:
    """key, node and size of stored nodes: a bucket for each component of fingerprints that SimHash links."""
    scratch = Scratch(spark, "resemblance-simhash")
    distinct = scratch.save(nodes.groupBy("print").agg(F.min("node").alias("rep")), "distinct")
    merged = components(scratch, near_links(scratch, distinct, RADIUS)).toDF("rep", "component")
    return nodes.join(distinct, "print").join(merged, "rep", "left").select(F.coalesce("component", "rep").alias("key"), "node", "size")


def sharing(dealt: DataFrame) -> DataFrame:
    """key, node, size, first and first_size (its bucket's smallest node) of the rows (key, node, size) whose bucket has several.

    Rows pass in order of key and node; of a bucket only its first row is held.
    """
    names = ["key", "node", "size"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, given = [np.zeros(0, np.int64)] * 3, False
        for batch in batches:
            if not batch.num_rows:
                continue
            key, node, size = (np.concatenate([h, batch.column(n).to_numpy()]) for h, n in zip(held, names, strict=True))
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            counts = np.diff(np.r_[starts, len(key)])
            shared = np.repeat(counts > 1, counts)
            # The held row stands before its bucket's later ones and is given once.
            shared[0] &= not given
            columns = [key, node, size, np.repeat(node[starts], counts), np.repeat(size[starts], counts)]
            yield pa.RecordBatch.from_arrays([pa.array(x[shared]) for x in columns], [*names, "first", "first_size"])
            held, given = [x[starts[-1]:starts[-1] + 1] for x in (key, node, size)], bool(counts[-1] > 1) or (given and len(starts) == 1)

    ordered = dealt.repartition("key").sortWithinPartitions("key", "node")
    return ordered.mapInArrow(run, "key bigint, node bigint, size bigint, first bigint, first_size bigint")


def alike(shared: Column, size: Column, other: Column) -> Column:
    """Whether so many shared shingles of two sets reach the similarity."""
    return OF * shared >= SHARED * (size + other - shared)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that are near-duplicates. A crowded a comes last: with the sets of its partners it is split."""
    of_b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("in_b"))
    of_a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("in_a"))
    shared = F.size(F.array_intersect("in_a", "in_b"))
    return pairs.join(of_b, "b").join(of_a, "a").where(alike(shared, F.size("in_a"), F.size("in_b"))).select("a", "b")


def unresolved(scratch: Scratch, members: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows (key, node, size, root) of the buckets that hold several components."""
    rooted = members.select("key", "node", "size").join(roots, "node", "left")
    rooted = scratch.save(rooted.select("key", "node", "size", F.coalesce("component", "node").alias("root")), "rooted")
    several = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key")
    found = scratch.save(rooted.join(several, "key", "left_semi"), "several")
    scratch.drop("rooted")
    return found


def in_groups(scratch: Scratch, several: DataFrame) -> DataFrame:
    """node, root, grp, and blocks: how many blocks the node's group is cut into."""
    first = scratch.save(several.groupBy("key").agg(F.min("node").alias("first")), "group-first")
    met = several.join(first, "key").where("node != first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    groups = components(Scratch(scratch.spark, "resemblance-groups"), met)
    nodes = several.groupBy("node").agg(F.min("root").alias("root"), F.min("size").alias("size"))
    placed = scratch.save(nodes.join(groups, "node", "left").select("node", "root", "size", F.coalesce("component", "node").alias("grp")), "group-nodes")
    blocks = F.greatest(F.ceil(F.count("*") / NODES), F.ceil(F.sum("size") / SHINGLES)).cast("int")
    cut = scratch.save(placed.groupBy("grp").agg(blocks.alias("blocks")), "group-blocks")
    scratch.drop("group-first")
    return placed.join(cut, "grp").select("node", "root", "grp", "blocks")


def compared(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) that connect what is similar enough inside the groups; nodes of one root are not compared.

    A node goes to every pair of blocks that its own block is in; the pair's left and right side are told apart.
    """
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    pair = F.struct(F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    dealt = groups.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("node", "root", "grp", pair.alias("pair"), (F.col("own") == F.greatest("own", "other")).alias("right"))
    rows = dealt.join(sets, "node").select("grp", "pair.low", "pair.high", "right", "node", "root", "shingles")
    rows = rows.repartition("grp", "low", "high").sortWithinPartitions("grp", "low", "high")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            for now, part in runs(batch, ["grp", "low", "high"]):
                if held and now != key:
                    yield links_of(held, key[1] == key[2])
                    held = []
                key = now
                held.append(part)
        if held:
            yield links_of(held, key[1] == key[2])

    return rows.mapInArrow(run, "a bigint, b bigint")


def links_of(batches: list[pa.RecordBatch], same: bool) -> pa.RecordBatch:
    """A spanning forest of the links between the two blocks of one pair, or inside one block."""
    rows = pa.Table.from_batches(batches).combine_chunks().to_batches()[0]
    nodes, roots = rows.column("node").to_numpy(), rows.column("root").to_numpy()
    sizes = rows.column("shingles").value_lengths().to_numpy().astype(np.int64)
    ends = np.cumsum(sizes)
    right = rows.column("right").to_numpy(zero_copy_only=False)
    # Shingles as dense numbers; the right side's nodes by shingle.
    shingle = np.unique(rows.column("shingles").flatten().to_numpy(), return_inverse=True)[1]
    owner = np.repeat(np.arange(len(nodes)), sizes)
    wanted = right[owner]
    order = np.argsort(shingle[wanted], kind="stable")
    listed = owner[wanted][order]
    starts = np.searchsorted(shingle[wanted][order], np.arange(int(shingle.max(initial=-1)) + 2))
    found_a, found_b, gathered = [], [], 0
    for k in np.flatnonzero(right if same else ~right).tolist():
        mine = shingle[ends[k] - sizes[k]:ends[k]]
        met = np.concatenate([listed[starts[x]:starts[x + 1]] for x in mine.tolist()]) if len(mine) else listed[:0]
        shared = np.bincount(met, minlength=len(nodes))
        shared[:k + 1 if same else 0] = 0
        near = np.flatnonzero((OF * shared >= SHARED * (sizes + sizes[k] - shared)) & (shared > 0) & (roots != roots[k]))
        found_a.append(np.full(len(near), nodes[k]))
        found_b.append(nodes[near])
        gathered += len(near)
        if gathered > FOREST:
            a, b = spanning(np.concatenate(found_a), np.concatenate(found_b))
            found_a, found_b, gathered = [a], [b], 0
    a, b = spanning(np.concatenate(found_a), np.concatenate(found_b)) if found_a else (nodes[:0], nodes[:0])
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def links(scratch: Scratch, rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) that connect all near-duplicate nodes of stored sketched rows, whose texts are (doc_id, digest, text)."""
    nodes = rows.groupBy("node").agg(F.min(F.struct("doc_id", "digest")).alias("at"), F.any_value("size").alias("size"), F.min("print").alias("print"), F.any_value("keys").alias("keys"))
    nodes = scratch.save(nodes, "nodes")
    dealt = nodes.select(F.explode("keys").alias("key"), "node", "size").unionByName(by_fingerprint(scratch.spark, nodes.select("node", "size", "print")))
    members = scratch.save(sharing(dealt), "members")
    needed = nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", F.col("at.doc_id").alias("doc_id"), F.col("at.digest").alias("digest"))
    needed = scratch.save(needed, "needed")
    # Most texts that are not needed are not shuffled.
    texts, _ = sifted(texts, scratch.save(sieve(needed, "doc_id", "digest"), "needed-sieve"), "doc_id", "digest")
    # A row that repeats is combined before it is shuffled.
    read = texts.join(needed, ["doc_id", "digest"]).groupBy("node").agg(F.any_value("text").alias("text"))
    sets = scratch.save(shingle_sets(read), "sets")
    scratch.drop("nodes", "needed", "needed-sieve")

    # Sizes alone rule out most of what cannot be similar enough.
    near_first = members.where("node != first").where(alike(F.least("size", "first_size"), F.col("size"), F.col("first_size")))
    star = scratch.save(near_first.select(F.col("first").alias("a"), F.col("node").alias("b")).distinct(), "star")
    found = scratch.save(verified(star, sets), "star-links")
    several = unresolved(scratch, members, components(Scratch(scratch.spark, "resemblance-first"), found))
    scratch.drop("members", "star")
    if is_empty(several):
        scratch.drop("sets", "several")
        return found
    groups = in_groups(scratch, several)
    found = scratch.save(found.unionByName(compared(groups, sets)), "links")
    scratch.drop("sets", "star-links", "several", "group-nodes", "group-blocks")
    return found


def told_apart(docs: DataFrame) -> DataFrame:
    """doc_id, digest and text of the rows that have an id."""
    return docs.where("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), digest_of(F.col("text")).alias("digest"), F.col("text").cast("string").alias("text"))


def first_of_each(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` that stay: the smallest id, then the smallest text digest, of each component; once where it repeats.

    Rows without an id cannot be named and stay. Texts are shuffled at most once, for those rows that are read
    again and for the rows of the result.
    """
    spark = docs.sparkSession
    prepare(spark)
    scratch = Scratch(spark, "resemblance")
    texts = told_apart(docs)
    rows = scratch.save(sketched(texts), "rows")
    found = links(scratch, rows, texts)
    roots = components(Scratch(spark, "resemblance-links"), found)
    placed = scratch.save(rows.groupBy("node", "doc_id", "digest").agg(F.count("*").alias("n")).join(roots, "node", "left").select(
        "doc_id", "digest", "n", F.coalesce("component", "node").alias("component")), "placed")
    least = scratch.save(placed.groupBy("component").agg(F.min(F.struct("doc_id", "digest")).alias("stays"), F.sum("n").alias("held")).where("held > 1"), "least")
    named = placed.join(least, "component")
    stays = F.struct("doc_id", "digest") == F.col("stays")
    # Only rows that go, or that stay once of several, are named.
    named = scratch.save(named.where(~stays | (F.col("n") > 1)).select("doc_id", "digest", stays.alias("once")), "named")
    scratch.drop("rows", "placed", "least")

    spare = spare_names(docs, 3)
    marked = docs.withColumns({spare[0]: F.col("doc_id").cast("bigint"), spare[1]: digest_of(F.col("text"))})
    marks = named.select(F.col("doc_id").alias(spare[0]), F.col("digest").alias(spare[1]), F.col("once").alias(spare[2]))
    gone = marks.where(~F.col(spare[2]))
    # Rows that surely stay are not shuffled.
    suspects, clear = sifted(marked, scratch.save(sieve(gone, *spare[:2]), "gone-sieve"), *spare[:2])
    kept = clear.unionByName(suspects.join(gone, spare[:2], "left_anti").select(*clear.columns))
    once = marks.where(F.col(spare[2]))
    if is_empty(once):
        return kept.select(*docs.columns)
    one = F.row_number().over(Window.partitionBy(*spare[:2]).orderBy(*[F.col(f"`{c}`").cast("string") for c in docs.columns if c not in ("doc_id", "text")]))
    repeated = kept.join(once, spare[:2], "left_semi").withColumn(spare[2], one).where(F.col(spare[2]) == 1)
    return kept.join(once, spare[:2], "left_anti").select(*docs.columns).unionByName(repeated.select(*docs.columns))
