"""Prefix trie of conversations, packed as double arrays one prefix shard at a time.

A conversation is the sequence of its turns; a node is a distinct sequence of first turns. Turns are
told apart by 128 bits of the SHA-256 of role and text, so a conversation becomes one binary path of
16 bytes a turn, and paths sort as their nodes do. Paths are dealt by range and sorted. A task reads
them in order and cuts its stream into shards of at most ``SHARD`` nodes; a shard is a run of
neighbouring paths, so however common a first turn is, it spans shards instead of filling one.

In a shard the turns get dense ids. A node's children lie at ``BASE[node] + id``, and ``CHECK`` names the
node a slot belongs to. Paths are traversed through both arrays to their nodes; counts then rise
along ``CHECK`` from the deepest level to the root.

Only nodes on a shard's first and last path can be shared with another shard. Those two paths leave the
shard with what their nodes own so far, are dealt and packed again in the next round, and merge there;
rounds end when one shard holds all that is left. All other nodes are complete at once.

Equal paths are neighbours, ordered by conversation, so the digest of a node's ends is streamed. Where
such a run may go on in another task, or is long, it leaves in pieces that are digested in order.

Defined results: rows without a conversation id belong to none. Turns are ordered by turn (null
first), then role, then the digest of role and text; repeated rows are turns of their own. Null roles and
texts are empty. An empty table has no nodes, not even a root. A conversation is one value, as a text is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.tables import Scratch, is_empty, prepare

WIDTH = 16  # bytes of a turn in a path
SHARD = 100_000  # nodes after which a shard is closed
LEAST = 32  # paths that a shard holds at least, so that rounds shrink what is left
PIECE = 1 << 18  # bytes of joined ids that are held at once
TRIES = 64  # free places looked at before children are put behind all that are taken
NONE = np.iinfo(np.int64).max
EMPTY = hashlib.sha256(b"").hexdigest()
#: Per place of a path, root first: what its node owns besides the nodes on shared paths.
OWN = "counts array<bigint>, least array<bigint>, children array<bigint>, leaves array<bigint>, saved array<bigint>, ends array<string>"
NODE = "key binary, parent_key binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
MADE = f"{NODE}, path binary, sizes array<bigint>, {OWN}, piece_of binary, piece_at bigint, piece binary"
FIELDS = [f.split()[0] for f in MADE.split(", ")]


def turn_digest(role: Column, text: Column) -> Column:
    """32 hex digits that tell turns apart; the role's length keeps role and text apart."""
    return F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 2 * WIDTH)


def rebuilt(conversations: DataFrame, group: int = 5, cycle: int = 9) -> DataFrame:
    """conv_id, path and sizes (bytes of each turn's text) of every conversation with its regenerated beginning.

    Conversation c begins with the first h turns of conversation c - c % group, where h is the unsigned
    CRC-32 of c in decimal modulo ``cycle``, and goes on with its own turns after its first h. The
    conversations of one such beginning meet in one row, so turns are shuffled once, without their texts.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.struct(
        F.col("conv_id").cast("bigint").alias("conv"), F.col("turn").cast("bigint").alias("turn"), role.alias("role"),
        turn_digest(role, text).alias("digest"), F.octet_length(text).cast("bigint").alias("size"),
    )
    turns = conversations.where("conv_id is not null").select(turn.alias("t"))
    met = turns.groupBy((F.col("t.conv") - F.col("t.conv") % group).alias("first")).agg(F.sort_array(F.collect_list("t")).alias("turns"))
    each = met.select("first", "turns", F.explode(F.array_distinct(F.col("turns.conv"))).alias("conv_id"))
    each = each.withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % cycle).cast("int"))
    of_first = F.filter("turns", lambda t: t["conv"] == F.col("first"))
    own = F.filter("turns", lambda t: t["conv"] == F.col("conv_id"))
    whole = F.concat(F.slice(of_first, 1, F.col("h")), F.slice(own, F.col("h") + 1, F.greatest(F.size(own), F.lit(1))))
    return each.select("conv_id", whole.alias("w")).select("conv_id", F.unhex(F.array_join("w.digest", "")).alias("path"), F.col("w.size").alias("sizes"))


class DoubleArray:
    """BASE and CHECK over dense turn ids for sorted distinct paths; slot 0 is the root."""

    def __init__(self, paths: list[bytes]):
        self.lengths = np.array([len(p) // WIDTH for p in paths], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        turns = [p[at:at + WIDTH] for p in paths for at in range(0, len(p), WIDTH)]
        dense = {digest: k for k, digest in enumerate(sorted(set(turns)))}
        self.ids = np.array([dense[t] for t in turns], np.int64)
        room = len(turns) + len(dense) + 2
        self.base, self.check = np.zeros(room, np.int64), np.full(room, -1, np.int64)
        self.taken = bytearray(room)
        self.check[0], self.taken[0], self.free, self.top = 0, 1, 1, 1
        self.pack()

    def grow(self, need: int) -> None:
        if need >= len(self.taken):
            more = max(need + 1, 2 * len(self.taken)) - len(self.taken)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])
            self.taken.extend(bytes(more))

    def place(self, ids: list[int]) -> int:
        """A base at which the slots of all ids (ascending) are free; first fit among the next free slots."""
        first, span = ids[0], ids[-1] - ids[0]
        at = self.free
        for _ in range(TRIES):
            at = self.taken.find(0, at)
            if at < 0:
                break
            self.grow(at + span)
            if not any(self.taken[at + i - first] for i in ids[1:]):
                return at - first
            at += 1
        self.grow(self.top + span)
        return self.top - first

    def pack(self) -> None:
        """Level by level: the children of every node that has some get one base."""
        state = np.zeros(len(self.lengths), np.int64)
        depth, on = 0, np.flatnonzero(self.lengths > 0)
        self.depths = {0: np.zeros(1, np.int64)}
        while len(on):
            parent, turn = state[on], self.ids[self.starts[on] + depth]
            fresh = np.flatnonzero(np.concatenate([[True], (parent[1:] != parent[:-1]) | (turn[1:] != turn[:-1])]))
            parents, turns = parent[fresh], turn[fresh]
            edges = np.flatnonzero(np.concatenate([[True], parents[1:] != parents[:-1]])).tolist() + [len(parents)]
            for a, b in zip(edges, edges[1:], strict=False):
                ids = turns[a:b].tolist()
                base = self.place(ids)
                self.base[parents[a]] = base
                for i in ids:
                    self.taken[base + i] = 1
                self.top = max(self.top, base + ids[-1] + 1)
                self.check[np.asarray(ids) + base] = parents[a]
                self.free = self.taken.find(0, self.free)
                if self.free < 0:
                    self.free = len(self.taken)
            state[on] = self.base[parent] + turn
            self.depths[depth + 1] = self.base[parents] + turns
            depth += 1
            on = on[self.lengths[on] > depth]

    def traverse(self) -> np.ndarray:
        """The slots of every path's nodes, root included, one path after the other."""
        total = self.starts[-1] + len(self.lengths)
        slots, heads = np.zeros(total, np.int64), self.starts[:-1] + np.arange(len(self.lengths))
        state, depth, on = np.zeros(len(self.lengths), np.int64), 0, np.flatnonzero(self.lengths > 0)
        while len(on):
            after = self.base[state[on]] + self.ids[self.starts[on] + depth]
            if (self.check[after] != state[on]).any():
                raise AssertionError("a path left the trie")
            state[on], depth = after, depth + 1
            slots[heads[on] + depth] = after
            on = on[self.lengths[on] > depth]
        return slots


def prefix_keys(path: bytes) -> list[bytes]:
    """A digest of each prefix, root first."""
    running, found = hashlib.sha256(), []
    for at in range(0, len(path) + 1, WIDTH):
        found.append(running.copy().digest())
        running.update(path[at:at + WIDTH])
    return found


class Shard:
    """Gathers neighbouring paths with what their nodes own, then gives nodes and the two open paths."""

    def __init__(self, keyed: bool, size: int):
        self.keyed, self.size = keyed, size  # whether every node's key is told, as later rounds do
        self.paths, self.sizes, self.own, self.nodes = [], [], [], 1

    def add(self, path: bytes, sizes: list[int], own: list[tuple]) -> None:
        """``own``: (place, count, least, children, leaves, saved, ends, key) of places that own something."""
        if self.paths and self.paths[-1] == path:
            self.own[-1].extend(own)
            return
        before = self.paths[-1] if self.paths else b""
        shared = 0
        while path[shared:shared + WIDTH] and path[shared:shared + WIDTH] == before[shared:shared + WIDTH]:
            shared += WIDTH
        self.nodes += (len(path) - shared) // WIDTH
        self.paths.append(path)
        self.sizes.append(sizes)
        self.own.append(list(own))

    def full(self) -> bool:
        return self.nodes >= self.size and len(self.paths) >= LEAST

    def close(self, whole: bool) -> tuple[dict[str, list], list[dict]]:
        """Columns of finished nodes, and the open paths; with ``whole`` nothing stays open."""
        trie = DoubleArray(self.paths)
        slots, heads = trie.traverse(), trie.starts[:-1] + np.arange(len(self.paths))
        room = len(trie.check)
        size, count, least = np.zeros(room, np.int64), np.zeros(room, np.int64), np.full(room, NONE)
        children, leaves, saved = (np.zeros(room, np.int64) for _ in range(3))
        ends: dict[int, str] = {}
        keys: dict[int, bytes] = {}
        for k, own in enumerate(self.own):
            head = heads[k]
            size[slots[head + 1:head + 1 + trie.lengths[k]]] = self.sizes[k]
            for place, n, low, kids, ended, kept, end, key in own:
                at = int(slots[head + place])
                count[at] += n
                least[at] = min(least[at], low)
                children[at] += kids
                leaves[at] += ended
                saved[at] += kept
                if end is not None:
                    ends[at] = end
                if key is not None:
                    keys[at] = key
        border = np.zeros(room, bool)
        edge = [] if whole else [0, len(self.paths) - 1][:len(self.paths)]
        for k in edge:
            border[slots[heads[k]:heads[k] + trie.lengths[k] + 1]] = True
        if self.keyed:
            for k, path in enumerate(self.paths):
                keys.update(zip(slots[heads[k]:heads[k] + trie.lengths[k] + 1].tolist(), prefix_keys(path), strict=True))
        found: dict[str, list] = {name: [] for name in ("slot", "depth")}
        for depth in sorted(trie.depths, reverse=True):
            done = trie.depths[depth][~border[trie.depths[depth]]]
            if not len(done):
                continue
            leaves[done] += children[done] == 0
            saved[done] += (count[done] - 1) * size[done]
            found["slot"].append(done)
            found["depth"].append(np.full(len(done), depth))
            if depth:
                up = trie.check[done]
                for of in (count, leaves, saved):
                    np.add.at(of, up, of[done])
                np.add.at(children, up, 1)
                np.minimum.at(least, up, least[done])
        open_paths, open_keys, told = [], {}, set()
        for k in dict.fromkeys(edge):
            places = slots[heads[k]:heads[k] + trie.lengths[k] + 1].tolist()
            open_keys.update(zip(places, prefix_keys(self.paths[k]), strict=True))
            first = [p not in told for p in places]
            told.update(places)
            open_paths.append({
                "path": self.paths[k], "sizes": list(self.sizes[k]),
                "least": [int(least[p]) if f and least[p] < NONE else None for p, f in zip(places, first, strict=True)],
                "ends": [ends.get(p) if f else None for p, f in zip(places, first, strict=True)],
            } | {name: [int(of[p]) if f else 0 for p, f in zip(places, first, strict=True)]
                 for name, of in (("counts", count), ("children", children), ("leaves", leaves), ("saved", saved))})
        slot = np.concatenate(found["slot"]) if found["slot"] else np.zeros(0, np.int64)
        depths = np.concatenate(found["depth"]) if found["depth"] else np.zeros(0, np.int64)
        up = trie.check[slot]
        shared, top = border[up], depths == 0
        nodes = {
            "key": [keys.get(s) for s in slot.tolist()],
            "parent_key": [open_keys[u] if b and not t else None for u, b, t in zip(up.tolist(), shared.tolist(), top.tolist(), strict=True)],
            "conv_id": least[slot], "depth": depths,
            "parent_conv_id": [None if b or t else int(least[u]) for u, b, t in zip(up.tolist(), shared.tolist(), top.tolist(), strict=True)],
            "n_convs": count[slot], "n_children": children[slot], "n_leaves": leaves[slot], "saved_tokens": saved[slot],
            # A key without digest has its ends in pieces.
            "ends_sha256": [ends.get(s, None if s in keys else EMPTY) for s in slot.tolist()],
        }
        return nodes, open_paths


TYPES = {
    "key": pa.binary(), "parent_key": pa.binary(), "ends_sha256": pa.string(), "path": pa.binary(), "sizes": pa.list_(pa.int64()), "ends": pa.list_(pa.string()),
    "piece_of": pa.binary(), "piece": pa.binary(),
} | {name: pa.list_(pa.int64()) for name in ("counts", "least", "children", "leaves", "saved")}


def batch_of(rows: int, **columns) -> pa.RecordBatch:
    """A batch of the task's rows; columns that are not given are null."""
    made = [pa.array(columns[f], TYPES.get(f, pa.int64())) if f in columns else pa.nulls(rows, TYPES.get(f, pa.int64())) for f in FIELDS]
    return pa.RecordBatch.from_arrays(made, FIELDS)


def closed(shard: Shard, whole: bool) -> Iterator[pa.RecordBatch]:
    nodes, still = shard.close(whole)
    count = len(nodes["depth"])
    for at in range(0, count, 16_384):
        part = {name: values[at:at + 16_384] for name, values in nodes.items()}
        yield batch_of(len(part["depth"]), **part)
    if still:
        yield batch_of(len(still), **{name: [row[name] for row in still] for name in still[0]})


class Run:
    """The conversations of one path as they come: how many, the smallest, and the digest of their ids."""

    def __init__(self, path: bytes, sizes: list[int], first: bool):
        self.path, self.sizes, self.in_pieces = path, sizes, first
        self.count, self.least, self.at, self.text = 0, None, None, bytearray()

    def add(self, conv_ids: list[int]) -> None:
        if self.least is None:
            self.least = conv_ids[0]
        if self.at is None:
            self.at = conv_ids[0]
        self.count += len(conv_ids)
        self.text += (",".join(map(str, conv_ids)) + ",").encode()

    def piece(self) -> pa.RecordBatch:
        """What is held, to be digested after the pieces before it; every id ends with a comma."""
        self.in_pieces = True
        row = batch_of(1, piece_of=[prefix_keys(self.path)[-1]], piece_at=[self.at], piece=[bytes(self.text)])
        self.at, self.text = None, bytearray()
        return row

    def own(self) -> list[tuple]:
        place = len(self.path) // WIDTH
        if self.in_pieces:
            return [(place, self.count, self.least, 0, 0, 0, None, prefix_keys(self.path)[-1])]
        return [(place, self.count, self.least, 0, 0, 0, hashlib.sha256(self.text[:-1]).hexdigest(), None)]


def pack_conversations(size: int, piece: int):
    """Sorted rows (path, sizes, conv_id) to nodes, open paths and pieces of digests."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, same = Shard(False, size), None
        for batch in batches:
            paths, ids, sizes = batch.column("path").to_pylist(), batch.column("conv_id").to_pylist(), batch.column("sizes")
            at = 0
            while at < len(paths):
                end = at + 1
                while end < len(paths) and paths[end] == paths[at]:
                    end += 1
                if same is None or same.path != paths[at]:
                    if same is not None:
                        if same.in_pieces and same.text:
                            yield same.piece()
                        shard.add(same.path, same.sizes, same.own())
                        if shard.full():
                            yield from closed(shard, whole=False)
                            shard = Shard(False, size)
                    same = Run(paths[at], sizes[at].as_py(), first=same is None)
                same.add(ids[at:end])
                if len(same.text) >= piece:
                    yield same.piece()
                at = end
        if same is not None:
            # The last run may go on in the next task, as the first may have begun in the one before.
            if same.text:
                yield same.piece()
            shard.add(same.path, same.sizes, same.own())
            yield from closed(shard, whole=False)
    return run


def pack_open(size: int, alone: bool):
    """Sorted open paths to nodes and fewer open paths; ``alone`` says that there is one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, closed_before = Shard(True, size), False
        for batch in batches:
            for row in batch.to_pylist():
                if shard.full() and shard.paths[-1] != row["path"]:
                    yield from closed(shard, whole=False)
                    shard, closed_before = Shard(True, size), True
                values = zip(row["counts"], row["least"], row["children"], row["leaves"], row["saved"], row["ends"], strict=True)
                own = [(place, n, NONE if low is None else low, kids, ended, kept, end, None) for place, (n, low, kids, ended, kept, end) in enumerate(values)]
                shard.add(row["path"], row["sizes"], own)
        if shard.paths:
            yield from closed(shard, whole=alone and not closed_before)
    return run


def digest_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (piece_of, piece) in order to (key, ends_sha256); one piece is held at a time."""
    key, running, held = None, None, b""
    for batch in batches:
        done_keys, done = [], []
        for of, piece in zip(batch.column("piece_of"), batch.column("piece"), strict=True):
            of, piece = of.as_py(), piece.as_py()
            if of != key:
                if key is not None:
                    running.update(held[:-1])
                    done_keys.append(key)
                    done.append(running.hexdigest())
                key, running, held = of, hashlib.sha256(), b""
            running.update(held)
            held = piece
        yield pa.RecordBatch.from_arrays([pa.array(done_keys, pa.binary()), pa.array(done, pa.string())], ["key", "ends_sha256"])
    if key is not None:
        running.update(held[:-1])
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([running.hexdigest()], pa.string())], ["key", "ends_sha256"])


def nodes_of(paths: DataFrame, shard: int = SHARD, piece: int = PIECE, together: int = 20_000) -> DataFrame:
    """One row per trie node of rows (conv_id, path, sizes).

    Open paths of up to ``together`` rows meet in one task; a task packs at most ``shard`` nodes at once.
    """
    spark = paths.sparkSession
    prepare(spark)
    scratch = Scratch(spark, "prefix-trie")
    stored = scratch.save(paths, "paths")
    dealt = stored.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    made = scratch.save(dealt.select("path", "sizes", "conv_id").mapInArrow(pack_conversations(shard, piece), MADE), "round-0")
    pieces = made.where("piece_of is not null").select("piece_of", "piece_at", "piece")
    node_columns = [c.split()[0] for c in NODE.split(", ")]
    nodes, step = made.where("depth is not null").select(*node_columns), 0
    own_columns = ["path", "sizes", *(c.split()[0] for c in OWN.split(", "))]
    while True:
        left = made.where("path is not null").select(*own_columns)
        rows = left.count()
        if not rows:
            break
        step += 1
        alone = rows <= together
        left = left.coalesce(1) if alone else left.repartitionByRange(-(-rows // together), "path")
        made = scratch.save(left.sortWithinPartitions("path").mapInArrow(pack_open(shard, alone), MADE), f"round-{step}")
        nodes = nodes.unionByName(made.where("depth is not null").select(*node_columns))
    nodes = scratch.save(nodes, "nodes")
    digests = scratch.save(pieces.repartition("piece_of").sortWithinPartitions("piece_of", "piece_at").select("piece_of", "piece").mapInArrow(digest_pieces, "key binary, ends_sha256 string"), "digests")
    # Parents that other shards share, and ends in pieces, are known only now.
    parents = nodes.where("key is not null").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("of_parent"))
    inner = nodes.where("parent_key is null").withColumn("of_parent", F.lit(None).cast("bigint"))
    upper = nodes.where("parent_key is not null").join(parents, "parent_key", "left")
    nodes = inner.unionByName(upper).withColumn("parent_conv_id", F.coalesce("parent_conv_id", "of_parent"))
    ended = nodes.where("ends_sha256 is not null").drop("key")
    pending = nodes.where("ends_sha256 is null").drop("ends_sha256").join(digests, "key", "left").drop("key")
    every = ended.unionByName(pending.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY))))
    return every.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def trie(conversations: DataFrame, **sizes) -> DataFrame:
    """The nodes of all rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    prepare(conversations.sparkSession)
    return nodes_of(rebuilt(conversations), **sizes)
