"""SimHash: bit-sliced comparison and whole results against brute force."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from conftest import SMALL

from ledgerloom.llm import queries, simhash


def plain_print(text: str | None) -> int:
    text = "".join(chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch for ch in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(r.encode(), seed=42).intdigest() for r in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(prints: dict[int, int], radius: int = 3) -> dict[int, int]:
    ids = sorted(prints)
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if root[a] < root[b] and (prints[a] ^ prints[b]).bit_count() <= radius:
                    root[b], changed = root[a], True
    return root


@pytest.mark.parametrize("radius", [1, 2, 3, 5, 7])
def test_close_pairs_are_all_pairs_within_the_radius(radius):
    random = np.random.default_rng(radius)
    base = random.integers(0, 2**63, 150, dtype=np.uint64)
    flips = np.uint64(1) << random.integers(0, 64, (4, 150)).astype(np.uint64)
    prints = np.unique(np.concatenate([base, base ^ flips[0], base ^ flips[1] ^ flips[2], base ^ np.bitwise_or.reduce(flips)]))
    i, j = simhash.close_pairs(prints, radius)
    apart = np.bitwise_count(prints[:, None] ^ prints[None, :])
    assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == sorted(zip(*(x.tolist() for x in np.nonzero(np.triu(apart <= radius, 1))), strict=True))


def test_query_equals_brute_force(spark, small_documents):
    prints = {doc: plain_print(text) for doc, text in small_documents.items()}
    root = plain_components(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.QUERIES["op10_simhash"](spark, SMALL).collect()}
    assert got == {doc: (f"{prints[doc]:016x}", root[doc]) for doc in prints}


def test_crowded_buckets_are_dealt_again_without_loss(spark, tmp_path_factory):
    """Blocks of 8 rows force several deals; components must stay those of brute force."""
    from ledgerloom.llm.components import components
    from ledgerloom.llm.tables import Scratch, prepare

    prepare(spark)
    random = np.random.default_rng(3)
    base = int(random.integers(0, 2**62))
    near = {base ^ sum(1 << int(b) for b in random.choice(64, int(k), replace=False)) for k in random.integers(0, 7, 150)}
    prints = dict(enumerate(sorted(near | {int(x) for x in random.integers(0, 2**63, 50)})))
    rows = [(v - (1 << 64) if v >> 63 else v, k) for k, v in prints.items()]
    scratch = Scratch(spark, "test")
    links = simhash.near_links(scratch, spark.createDataFrame(rows, "print bigint, rep bigint"), 3, 8)
    found = {r.node: r.component for r in components(scratch, links).collect()}
    assert {k: found.get(k, k) for k in prints} == plain_components(prints)


def test_bucket_reader_ignores_batch_edges():
    prints = np.random.default_rng(5).integers(0, 2**62, 40).astype(np.uint64)
    prints[20:30] = prints[5] ^ (np.uint64(1) << np.arange(10, dtype=np.uint64))
    keys = np.sort(np.repeat(np.arange(5), 8))
    columns = [pa.array(x, pa.int64()) for x in (keys, np.zeros(40, int), prints.view(np.int64), np.arange(40))]
    whole = pa.RecordBatch.from_arrays(columns, ["key", "shared", "print", "rep"])

    def links(sizes):
        cuts = np.cumsum([0, *sizes])
        batches = [whole.slice(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]
        out = [r for x in simhash.Buckets(3, 64).run(iter(batches)) for r in x.to_pylist()]
        return {(r["a"], r["b"]) for r in out if r["a"] is not None}

    in_keys = {(a, b) for a in range(40) for b in range(a) if keys[a] == keys[b] and (int(prints[a]) ^ int(prints[b])).bit_count() <= 3}
    assert in_keys
    for sizes in ([40], [1] * 40, [7, 9, 24], [39, 1]):
        linked = links(sizes)
        for a, b in linked:
            assert a > b
        assert {a for a, _ in in_keys} <= {a for a, _ in linked} | {b for _, b in linked}


def test_nulls_empty_texts_ties_and_repeated_rows(spark):
    rows = [(5, None, 1), (3, "", 2), (9, "  ", 3), (7, "one two", 4), (7, "one two", 5), (8, "ONE two", 6), (None, "one two", 7), (None, "other words stand here alone", 8)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, component_id int")
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(df).collect()), key=str)
    zero, two, other = "0" * 16, f"{plain_print('one two'):016x}", f"{plain_print(rows[-1][1]):016x}"
    assert got == sorted([(5, zero, 3), (3, zero, 3), (9, zero, 3), (7, two, 7), (7, two, 7), (8, two, 7), (None, two, 7), (None, other, None)], key=str)
    assert simhash.near_duplicates(df.limit(0)).count() == 0
