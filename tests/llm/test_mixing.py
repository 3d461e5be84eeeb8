"""Source mixing against its SQL and the meaning of its limits."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import check_oracles
import pytest
from conftest import SMALL

from ledgerloom.llm import mixing


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, "big", 10 + k % 7) for k in range(600)] + [(1000 + k, "mid", 20) for k in range(60)] + [(2000 + k, None, 5 + k % 3) for k in range(40)]
    return spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint")


def test_query_equals_sql(spark):
    assert check_oracles.compare(spark, check_oracles.connect(SMALL), "op5_source_mix", SMALL)[0] == "ok"


def test_the_repetition_limit_is_met_and_not_undershot(docs):
    plan = mixing.mixture(docs, repeats=2.0).collect()
    total = sum(r.tokens for r in plan)
    assert sum(r.weight for r in plan) == pytest.approx(1)
    assert max(r.weight * total / r.tokens for r in plan) == pytest.approx(2.0, abs=1e-6)
    assert {r.exponent for r in mixing.mixture(docs, repeats=1000.0).collect()} == {0.0}
    assert {r.weight for r in mixing.mixture(docs, repeats=1000.0).collect()} == {1 / 3}


def test_the_target_entropy_is_met(docs):
    def entropy(rows):
        return -sum(r.weight * math.log(r.weight) for r in rows)

    plan = mixing.mixture(docs, entropy=0.8).collect()
    assert 0 < plan[0].exponent < 1 and entropy(plan) == pytest.approx(0.8 * math.log(3), abs=1e-6)
    assert {r.exponent for r in mixing.mixture(docs, entropy=0.1).collect()} == {1.0}
    assert mixing.mixture(docs, entropy=1.0).first().exponent == pytest.approx(0, abs=1e-6)
    with pytest.raises(ValueError):
        mixing.mixture(docs)


def test_passes_are_whole_permutations_within_the_quota(docs):
    plan = {r.source: r for r in mixing.mixture(docs, repeats=2.5, budget=30_000).collect()}
    rows = mixing.mix(docs, repeats=2.5, budget=30_000, block_tokens=500).collect()
    by_pass = defaultdict(list)
    for r in rows:
        by_pass[r.source, getattr(r, "pass")].append(r)
    sizes = Counter(r.source for r in docs.collect())
    for (source, number), held in by_pass.items():
        held.sort(key=lambda r: r.start)
        assert len({r.doc_id for r in held}) == len(held)
        assert [r.place for r in held] == sorted(r.place for r in held)
        start = number * plan[source].tokens
        for r in held:
            assert r.start == start
            start += r.n_tokens
        if (source, number + 1) in by_pass:
            assert len(held) == sizes[source]
    for source, p in plan.items():
        used = sum(r.n_tokens for r in rows if r.source == source)
        assert 0 <= p.quota - used < 20
        first = by_pass[source, 0]
        if (source, 1) in by_pass:
            assert [r.doc_id for r in first] != [r.doc_id for r in by_pass[source, 1]]
    # Blocks hold the sources in their weights, up to a document at either end.
    in_block = defaultdict(int)
    for r in rows:
        in_block[r.source, r.block] += r.n_tokens
    last = max(b for _, b in in_block)
    for (source, block), tokens in in_block.items():
        if block < last - 1:
            assert abs(tokens - plan[source].weight * 500) <= 20


def test_nulls_repeats_and_empty_tables(spark):
    rows = [(1, "a", "one two"), (1, "a", "one two"), (2, "a", None), (3, "b", ""), (None, "a", "x"), (4, None, "p q\x0br")]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    counted = mixing.counted(df)
    assert sorted(r.n_tokens for r in counted.collect()) == [0, 0, 1, 2, 2, 3]
    held = mixing.mix(counted, repeats=1.0)
    assert sorted((r.doc_id, getattr(r, "pass")) for r in held.collect()) == [(1, 0), (2, 0), (4, 0)]
    assert mixing.mix(counted.limit(0), repeats=2.0).count() == 0
    assert mixing.mix(counted.where("n_tokens = 0"), entropy=0.5).count() == 0
