"""Substring dedup against direct removal."""

from __future__ import annotations

import hashlib
import random

import numpy as np
from conftest import SMALL

from ledgerloom.llm import queries, substring


def brute_force(texts: dict[int, str | None], window: int = 20) -> dict[int, tuple[int, int, str]]:
    seen, out = set(), {}
    for doc in sorted(texts):
        words = (texts[doc] or "").encode().split()
        gone = set()
        for start in range(len(words) - window + 1):
            run = tuple(words[start:start + window])
            if run in seen:
                gone.update(range(start, start + window))
            seen.add(run)
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out[doc] = (len(words), len(gone), hashlib.sha256(kept).hexdigest())
    return out


def found(rows) -> dict[int, tuple[int, int, str]]:
    return {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in rows}


def test_query_equals_brute_force(spark, small_documents):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.QUERIES["op3_substring_dedup"](spark, SMALL).collect()}
    want = brute_force(small_documents)
    assert got == want
    assert sum(v[1] for v in want.values()) > 0


def test_few_words_and_shared_passages(spark):
    """Small vocabularies and copied, shifted and interrupted passages give every kind of edge."""
    random.seed(4)
    passage = [f"p{k}" for k in range(60)]
    texts = {}
    for doc in range(60):
        words = [random.choice("ab" if doc % 3 else "abcdefgh") for _ in range(random.randrange(0, 60))]
        start = random.randrange(40)
        words += passage[start:start + random.randrange(15, 45)]
        if doc % 4 == 0:
            words[random.randrange(len(words))] = "edit"
        texts[doc] = random.choice([" ", "\n", "\t "]).join(words + words[:doc % 30])
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    for window, seed in ((20, 6), (5, 2), (8, 8)):
        assert found(substring.without_repeats(df, window, seed).collect()) == brute_force(texts, window)


def test_equal_windows_have_equal_anchors_and_hashes():
    words = [b"w%d" % (k % 37) for k in range(400)]
    anchor, stretch, start, size = substring.stretches(words, 20, 6)
    assert start[0] == 0 and (start[1:] == (start + size)[:-1]).all() and size.sum() == 381
    hashed = substring.Hashed(words)
    at = np.arange(381)
    own = hashed.run(at, at + 20)
    assert (own[:300] == own[37:337]).all() and len(set(own.tolist())) == 37


def test_nulls_repeats_and_missing_ids(spark):
    long = " ".join(f"v{k}" for k in range(30))
    rows = [(1, long, 0), (1, long, 0), (2, None, 0), (3, "", 0), (4, f"{long}\x0b{long}", 0), (None, long, 0), (5, " \t ", 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, anchor int")
    got = sorted(((r.doc_id or 0, r.n_words, r.n_removed) for r in substring.without_repeats(df).collect()))
    assert got == [(0, 30, 0), (1, 30, 0), (1, 30, 0), (2, 0, 0), (3, 0, 0), (4, 60, 60), (5, 0, 0)]
    assert substring.without_repeats(df.limit(0)).count() == 0


def test_rows_that_repeat_an_id_name_every_place_once(spark):
    words = " ".join(f"w{k}" for k in range(70))
    df = spark.createDataFrame([(1, words)] + [(2, words + " " + words)] * 400, "doc_id bigint, text string")
    spans = {r.doc_id: len(r.spans) for r in substring.repeats(df).collect()}
    assert spans.keys() == {2} and spans[2] < 60
    got = substring.without_repeats(df).collect()
    assert {(r.doc_id, r.n_words, r.n_removed) for r in got} == {(1, 70, 0), (2, 140, 140)} and len(got) == 401


def test_a_very_long_text(spark):
    random.seed(9)
    words = [f"w{random.randrange(3000)}" for _ in range(60_000)]
    long = " ".join(words + words[20_000:20_500])
    texts = {3: long, 4: " ".join(words[100:180])}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert found(substring.without_repeats(df).collect()) == brute_force(texts)
