from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from ledgerloom.llm import prefix_trie

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def plain(rows):
    """The nodes by walking every rebuilt conversation."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    told = {c: [t[2:] for t in sorted(ts, key=lambda t: t[:3])] for c, ts in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in told:
        h = zlib.crc32(str(c).encode()) % 9
        whole = tuple(told.get(c - int(c % 5 if c >= 0 else -(-c % 5)), [])[:h] + told[c][h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
        ends[whole].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    def below(node):
        found, open_nodes = [], [node]
        while open_nodes:
            found.append(at := open_nodes.pop())
            open_nodes += children[at]
        return found

    return sorted((
        min(members[n]), len(n), min(members[n[:-1]]) if n else None, len(members[n]), len(children[n]),
        sum(not children[x] for x in below(n)), sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below(n) if x),
        hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest(),
    ) for n in members)


def found(spark, rows, **sizes):
    made = prefix_trie.trie(spark.createDataFrame(rows, SCHEMA), **sizes)
    assert tuple(made.columns) == COLUMNS
    return sorted((tuple(r) for r in made.collect()), key=lambda r: (r[0], r[1]))


def talk(seed, convs):
    """Conversations of which many share beginnings, and a third are the same."""
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        if rng.random() < 0.33:
            rows += [(c, t, "user", f"same {t} é") for t in range(4)]
            continue
        rows += [(c, t, "user" if t % 2 else "assistant", f"word {rng.randrange(3)}") for t in range(rng.randrange(1, 12))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [{}, {"shard": 40, "piece": 30, "together": 12}, {"shard": 1, "piece": 1, "together": 100}])
def test_equals_walking_every_conversation(spark, sizes):
    rows = talk(7, 900)
    assert found(spark, rows, **sizes) == plain(rows)


def test_common_first_turn_spans_shards(spark):
    rows = [r for c in range(1200) for r in [(c, 0, "user", "hi"), (c, 1, "assistant", f"answer {c % 331}"), (c, 2, "user", f"{c}")]]
    assert found(spark, rows, shard=50, together=30) == plain(rows)


def test_nulls_repeats_and_negative_ids(spark):
    rows = [
        (None, 0, "user", "nobody's"), (-7, 0, "user", "a"), (-5, 0, "user", "b"), (-5, None, None, None), (0, 1, "", "x"),
        (0, 1, "", "x"), (0, 0, None, "x"), (3, 0, "user", None), (4, 0, "user", ""), (4, 5, "us", "er"), (9, 5, "user", ""),
    ]
    assert found(spark, rows) == plain(rows)


def test_conversation_without_turns_ends_at_the_root(spark):
    turnless = next(c for c in range(1, 400) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 1)
    rows = [(turnless, 0, "user", "gone")]
    nodes = found(spark, rows)
    assert nodes == plain(rows)
    assert nodes == [(turnless, 0, None, 1, 0, 1, 0, hashlib.sha256(str(turnless).encode()).hexdigest())]


def test_long_conversation_and_long_text(spark):
    rows = [(5, t, "user", f"{t % 7}") for t in range(300)] + [(10, 0, "user", "ü" * 30_000)]
    assert found(spark, rows, shard=100) == sorted(plain(rows))


def test_empty_table_has_no_nodes(spark):
    assert found(spark, []) == []


def test_extra_columns_do_not_clash(spark):
    rows = [(1, 0, "user", "a", 1, "p", 2), (2, 0, "user", "a", 1, "p", 2)]
    table = spark.createDataFrame(rows, SCHEMA + ", depth bigint, path string, h int")
    assert sorted(tuple(r) for r in prefix_trie.trie(table).collect()) == plain([r[:4] for r in rows])


def test_double_array_leads_every_path_to_its_node():
    rng = random.Random(3)
    letters = [hashlib.sha256(bytes([k])).digest()[:16] for k in range(60)]
    paths = sorted({b"".join(rng.choice(letters) for _ in range(rng.randrange(0, 6))) for _ in range(4000)})
    trie = prefix_trie.DoubleArray(paths)
    slots = trie.traverse()
    prefixes = {p[:at] for p in paths for at in range(0, len(p) + 1, 16)}
    assert len(set(slots.tolist())) == len(prefixes) == sum(len(s) for s in trie.depths.values())
    assert len(trie.check) < 3 * len(prefixes)
