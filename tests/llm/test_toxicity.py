"""The factorization machine: what it can learn, held-out accuracy, and edge cases."""

from __future__ import annotations

import random
import zlib

import duckdb
import numpy as np
import pytest

from ledgerloom.llm import queries, toxicity
from ledgerloom.llm.toxicity import Machine, Settings


def rows_of(texts):
    return [toxicity.hashed_terms(t) for t in texts]


def toxicity_held_out(k):
    return zlib.crc32(str(k).encode()) % 3 == 1


def test_pairs_are_scored_as_the_sum_over_all_pairs():
    random_ = np.random.default_rng(0)
    terms = np.sort(random_.integers(-2**62, 2**62, 9))
    machine = Machine(-0.3, terms, random_.normal(size=9), random_.normal(size=(9, 4)))
    row = np.sort(np.append(terms[[1, 4, 5, 8]], 17))
    at = [1, 4, 5, 8]
    want = -0.3 + machine.weights[at].sum() + sum(machine.vectors[a] @ machine.vectors[b] for a in at for b in at if a < b)
    assert machine.logits([row, np.zeros(0, np.int64)]) == pytest.approx([want, -0.3])


def test_an_interaction_that_no_additive_weights_express_is_learnt():
    """Only one of two terms is harmless, both or none are not: weights alone cannot tell."""
    chance = random.Random(1)
    terms = np.array([1, 2, 3, 4], np.int64)
    rows, labels = [], []
    for _ in range(800):
        row = sorted({k for k in range(4) if chance.random() < 0.5})
        rows.append(np.array(row, np.int64))
        labels.append(int((0 in row) == (1 in row)))
    machine = toxicity.fit(rows, np.array(labels), terms, Settings(epochs=120))
    predicted = machine.scores([terms[r] for r in rows]) >= 0.5
    assert (predicted == np.array(labels)).mean() > 0.99


def test_training_and_scoring_whole_texts(spark):
    chance = random.Random(2)
    plain = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(200)]
    docs, labels = [], []
    for k in range(600):
        words = [chance.choice(plain) for _ in range(chance.randrange(5, 80))]
        bad = k % 4 == 0
        if bad:
            words[chance.randrange(len(words))] = chance.choice(["Wretch!", "wretched,", "WRETCHES", "scoundrel."])
        docs.append((k, " ".join(words)))
        labels.append((k, int(bad)))
    docs += [(1000, " ".join(chance.choice(plain) for _ in range(30_000)) + " wretch"), (1001, None), (1002, ""), (1003, "Wretch"), (1003, "Wretch"), (None, "wretch")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 label", "2 terms")
    unseen = [k for k, _ in labels if k % 5 == 2 or toxicity_held_out(k)]
    taught = [x for x in labels if x[0] not in unseen]
    marks = spark.createDataFrame([*taught, (1001, 1), (None, 1), (7, None), (5000, 1)], "doc_id bigint, toxic int")
    machine = toxicity.model_for(df, marks)
    got = {r.doc_id: r.toxic_score for r in toxicity.score(df, machine).collect()}
    truth = dict(labels)
    assert len(unseen) > 200 and sum(truth[k] for k in unseen) > 50
    assert all((got[k] >= 0.7) == bool(truth[k]) for k in unseen)
    assert got[1000] >= 0.7 and got[1003] >= 0.7 and got[None] >= 0.7
    assert got[1001] == got[1002] < 0.5
    assert toxicity.score(df.limit(0), machine).count() == 0


def test_without_both_labels_every_score_is_one_half(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id bigint, text string")
    for marks in ([], [(1, 0)], [(9, 1)]):
        machine = toxicity.model_for(df, spark.createDataFrame(marks, "doc_id bigint, toxic int"))
        assert [r.toxic_score for r in toxicity.score(df, machine).collect()] == [0.5, 0.5]


def test_held_out_rows_follow_the_checksum_and_are_predicted(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op7_toxicity"](spark, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    labels = dict(duckdb.connect().execute(f"SELECT doc_id, toxic FROM '{sf}/labels.parquet'").fetchall())
    judged = [r for r in rows if r.held_out and r.doc_id in labels]
    clean = [r for r in judged if not labels[r.doc_id]]
    toxic = [r.score for r in judged if labels[r.doc_id]]
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)
    assert sum(s >= 0.7 for s in toxic) >= 0.6 * len(toxic)
    wins = sum((t > r.score) + 0.5 * (t == r.score) for t in toxic for r in clean)
    assert wins / len(toxic) / len(clean) > 0.8


def test_an_insult_that_only_a_mention_makes_toxic_is_learnt_through_train(spark):
    """By itself the insult is harmless in 500 texts and the mention in 1,000; 100 texts with both are toxic, 400 others by a slur."""
    chance = random.Random(1)
    plain = [f"{a}{b}{c}" for a in "bcdfghjklm" for b in "aeiou" for c in ("ran", "lit", "mos", "ker")]

    def text(*more):
        words = chance.choices(plain, k=30) + list(more)
        chance.shuffle(words)
        return " ".join(words)

    kinds = [(("idiotic", "foreigner"), 1, 100), (("idiotic",), 0, 500), (("foreigner",), 0, 1000), (("slurword",), 1, 400), ((), 0, 400)]
    rows = [(text(*more), label) for more, label, count in kinds for _ in range(count)]
    docs = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(rows)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, label) for k, (_, label) in enumerate(rows)], "doc_id bigint, toxic int")
    machine = toxicity.train(docs, labels, "toxic")
    # Fresh texts of each kind, none of which was seen.
    for more, label, _ in kinds:
        scores = machine.scores(rows_of([text(*more) for _ in range(200)]))
        assert ((scores >= 0.7) == bool(label)).mean() >= 0.99, more
