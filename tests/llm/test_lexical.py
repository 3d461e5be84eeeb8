from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerloom.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=20):
    """Every document scored for every item."""
    counted = [(d, Counter(words(t))) for d, t in docs]
    lengths = [c.total() for _, c in counted]
    many, total = sum(n > 0 for n in lengths), sum(lengths)
    holding = Counter(t for _, c in counted for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, Counter()).update(words(text))
    found = []
    for item, terms in asked.items():
        scored = []
        for (doc, c), n in zip(counted, lengths, strict=True):
            score = 0
            for t, times in terms.items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * many + 2) / (2 * holding[t] + 1)))
                    m = 100 - 25 + (25 * n * many) // total
                    score += times * w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        found += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k])]
    return sorted(found, key=str)


def found(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    made = lexical.rank(d, spark.createDataFrame(items, "item_id bigint, text string"), **options)
    assert made.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in made.collect()), key=str)


def corpus(seed, count):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)] + ["Über", "naïve", "x1"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    docs = [(k * 3, " ".join(rng.choices(vocabulary, weights, k=rng.randrange(0, 40)))) for k in range(count)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.randrange(0, 12)))) for k in range(12)]
    return docs, items


@pytest.mark.parametrize("options", [{}, {"postings": 30}, {"k": 3, "block": 60}])
def test_equals_scoring_every_document(spark, options):
    docs, items = corpus(5, 400)
    # A third of the documents are the same.
    docs += [(k, "w1 w2 Über w1, w5-w5") for k in range(1, 600, 3)]
    assert found(spark, docs, items, **options) == plain(docs, items, options.get("k", 20))


def test_nulls_repeats_ties_and_long_texts(spark):
    docs = [(None, "alpha beta"), (1, "alpha beta"), (1, "alpha beta"), (2, None), (3, ""), (4, "..."), (5, "ALPHA_alphA"), (6, "é" * 10 + " gamma " * 400_000), (7, "other"), (8, "other")]
    items = [(1, "alpha, Beta"), (1, "gamma"), (2, None), (3, "nothing here"), (None, "alpha alpha"), (9, "ééé " + "é" * 10)]
    assert found(spark, docs, items) == plain(docs, items)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == []
    assert found(spark, [(1, "a")], []) == []
    assert found(spark, [(1, None)], [(1, "a")]) == []


def test_extra_columns_do_not_clash(spark):
    docs = spark.createDataFrame([(1, "a b", 7, "t")], "doc_id bigint, text string, n bigint, terms string")
    items = spark.createDataFrame([(2, "a", 7)], "item_id bigint, text string, score bigint")
    assert [tuple(r) for r in lexical.rank(docs, items).collect()] == plain([(1, "a b")], [(2, "a")])


def test_search_leaves_most_documents_unsplit():
    rng = np.random.default_rng(1)
    terms = [np.unique(rng.integers(0, 300, 8)).astype(np.int32) for _ in range(4000)]
    counts = [rng.integers(1, 4, len(t)) for t in terms]
    shard = lexical.Shard(list(range(4000)), [10] * 4000, terms, counts, lexical.Totals(4000, 40_000))
    scored = []
    plain_bound = shard.bound
    shard.bound = lambda w, b, e: scored.append(b.shape[1]) or plain_bound(w, b, e)
    scores, _ = shard.search(np.array([3, 70, 200]), np.array([900, 2000, 3000]), 20)
    assert len(scores) == 20 and sum(scored) < 2000
