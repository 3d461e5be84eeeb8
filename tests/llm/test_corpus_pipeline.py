"""The corpus pipeline, stage by stage, against direct versions of what each stage decides."""

from __future__ import annotations

import base64
import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import SMALL
from pyspark.sql import functions as F
from test_resemblance import plain_roots

import corpus_pipeline
from ledgerloom.llm import mixing
from ledgerloom.llm.tables import Scratch, prepare, table


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before the first stage and after each."""
    prepare(spark)
    scratch = Scratch(spark, "test")
    docs = table(spark, SMALL, "documents")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.save(stage(spark, docs, SMALL), name)
        kept.append(docs)
    return [df.collect() for df in kept]


def test_stages_have_the_names_and_columns_asked_for(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "personal_data", "source_mix", "byte_bpe"]
    for rows in stages[1:5]:
        assert list(rows[0].asDict()) == ["doc_id", "text", "lang", "source", "n_chars"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_only_toxic_documents_are_rejected(spark, stages):
    from ledgerloom.llm import toxicity

    docs = table(spark, SMALL, "documents")
    machine = toxicity.model_for(docs, table(spark, SMALL, "labels"))
    scores = dict(zip([r.doc_id for r in stages[0]], machine.scores([toxicity.hashed_terms(r.text) for r in stages[0]]).tolist(), strict=True))
    assert sorted(stages[1]) == sorted(r for r in stages[0] if scores[r.doc_id] < 0.7)
    assert 0 < len(stages[0]) - len(stages[1]) < 0.25 * len(stages[0])


def test_one_document_of_each_component_stays(stages):
    root = plain_roots({r.doc_id: r.text for r in stages[1]})
    assert sorted(stages[2]) == sorted(r for r in stages[1] if root[r.doc_id] == r.doc_id)
    assert len(stages[2]) < len(stages[1])


def test_personal_data_is_replaced_and_the_rest_stays(stages):
    private = re.compile(r"[\w.%+-]+@[\w-]+(?:\.[\w-]+)+|(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.])|\+1 \(\d{3}\) \d{3}-\d{4}|(?<!\d)\d{16}(?!\d)|(?i:\b[0-9a-f]{40}\b)")
    after = {r.doc_id: r for r in stages[3]}
    assert after.keys() == {r.doc_id for r in stages[2]}
    for before in stages[2]:
        now = after[before.doc_id]
        assert private.split(before.text) == private.split(now.text)
        assert not set(private.findall(before.text)) & set(private.findall(now.text))
        assert now.n_chars == len(now.text) and (now.lang, now.source) == (before.lang, before.source)


def test_sources_are_mixed_by_tempered_shares(stages):
    words = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in stages[3]}
    tokens = defaultdict(int)
    for r in stages[3]:
        tokens[r.source] += words[r.doc_id]
    total = sum(tokens.values())

    def weights(m):
        powers = {s: (t / total) ** m for s, t in tokens.items()}
        return {s: p / sum(powers.values()) for s, p in powers.items()}

    low, high = 0.0, 1.0
    for _ in range(50):
        middle = (low + high) / 2
        fits = max(w * total / tokens[s] for s, w in weights(middle).items()) <= corpus_pipeline.REPEATS
        low, high = (low, middle) if fits else (middle, high)
    quota = {s: math.floor(w * total + 1e-6) for s, w in weights(high).items()}
    times = Counter()
    for source in tokens:
        ids = [r.doc_id for r in stages[3] if r.source == source]
        for number in range(max(1, math.ceil(quota[source] / tokens[source]))):
            start = number * tokens[source]
            for doc in sorted(ids, key=lambda d: hashlib.md5(f"mix/{number}/{d}".encode()).hexdigest()):
                if start + words[doc] <= quota[source]:
                    times[doc] += 1
                start += words[doc]
    assert Counter(r.doc_id for r in stages[4]) == times
    by_id = {r.doc_id: r for r in stages[3]}
    assert all(r == by_id[r.doc_id] for r in stages[4])


def test_tokens_are_the_librarys_and_decode_to_the_text(stages):
    with open(corpus_pipeline.VOCABULARY, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in stages[4]}
    assert Counter(r.doc_id for r in stages[5]) == Counter(r.doc_id for r in stages[4])
    for r in stages[5]:
        want = reference.encode_ordinary(texts[r.doc_id])
        assert r.restored and r.n_tokens == len(want) and np.frombuffer(r.token_ids, "<u4").tolist() == want


def test_run_gives_the_last_stage(spark, stages):
    assert sorted(corpus_pipeline.run(spark, SMALL).collect()) == sorted(stages[5])


def test_nulls_repeats_and_missing_ids_pass_every_stage(spark, tmp_path):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "plain words of some length here", "en", "a", 31), (3, "plain words of some length here", "en", "a", 31),
            (None, "a row without an id", None, "b", 19), (4, "mail a.b@c.example.com " + "x" * 100_000, "en", "b", 100_023)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    for rows in (rows, []):
        root = tmp_path / str(len(rows))
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/documents.parquet")
        spark.createDataFrame([(3, 0), (9, 1)], "doc_id bigint, toxic int").write.parquet(f"{root}/labels.parquet")
        result = corpus_pipeline.run(spark, str(root)).collect()
        assert all(r.restored for r in result)
        # Texts without words form one component, whose smallest document stays and passes the mix.
        assert {r.doc_id for r in result} <= {None, 1, 3, 4} and bool(result) == bool(rows)


CLASHES = ["component", "_component", "_node", "node", "_keys", "keys", "_times", "times", "_row", "_at", "_copy", "_0", "_1", "_2", "_3",
           "n_entities", "entity_kinds", "_pii_raw", "toxic_score", "digest", "name", "n", "size"]


@pytest.mark.parametrize("number", range(4))
def test_columns_of_any_name_pass_every_stage(spark, documents, number):
    rows = [(1, "mail me a.b@c.example.com now"), (2, "mail me a.b@c.example.com now"), (3, "some other words here " * 20), (4, None)]
    docs = documents(rows).withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in CLASHES})
    name, stage = corpus_pipeline.STAGES[number]
    got = stage(spark, Scratch(spark, "test").save(docs, "docs"), SMALL)
    assert got.columns == docs.columns
    before = {r.doc_id: r for r in docs.collect()}
    for r in got.collect():
        assert all(r[c] == before[r.doc_id][c] for c in CLASHES)


def test_mix_counts_rows_that_share_an_id_and_passes_rows_without_one(spark, documents):
    short, long = "a b c", "w " * 500
    rows = [(1, short, "en", "x"), (1, long, "en", "x"), (None, "no id here", "en", "x"), (None, "no id here", "en", "x"), (2, "", "en", "silent"), (3, None, "en", "silent"), (4, "alone", "en", None)]
    docs = documents(rows)
    counted = {}
    got = corpus_pipeline.mix_sources(spark, docs, SMALL).collect()
    for r in got:
        counted[r.source] = counted.get(r.source, 0) + len((r.text or "").split())
    assert [r.doc_id for r in got if r.source == "silent"] in ([2, 3], [3, 2])
    total = sum(len((r[1] or "").split()) for r in rows)
    weights = {r.source: r for r in mixing.mixture(mixing.counted(docs), repeats=corpus_pipeline.REPEATS).collect()}
    assert sum(counted.values()) <= total and all(counted.get(s, 0) <= w.quota for s, w in weights.items())
    assert any(r.doc_id is None for r in got) and any(r.source is None for r in got)
