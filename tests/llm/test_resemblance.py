"""Near-duplicates of the pipeline's stage against brute-force Jaccard similarity."""

from __future__ import annotations

import random

from conftest import SMALL

import corpus_pipeline
from ledgerloom.llm import resemblance
from ledgerloom.llm.tables import Scratch, prepare, table


def plain_set(text: str | None) -> set[tuple[str, ...]]:
    words = [w.decode() for w in (text or "").encode().lower().split()]
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())


def plain_roots(texts: dict[int, str | None]) -> dict[int, int]:
    sets, root = {d: plain_set(t) for d, t in texts.items()}, {d: d for d in texts}
    pairs = [(a, b) for a in texts for b in texts if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    for _ in texts:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    return root


def kept(spark, docs):
    prepare(spark)
    return sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, Scratch(spark, "test").save(docs, "docs"), SMALL).collect())


def changed(words: list[str], count: int, draw: random.Random) -> list[str]:
    out = list(words)
    for place in draw.sample(range(len(out)), count):
        out[place] = f"other{draw.random()}"
    return out


def test_given_documents_keep_one_of_each_component(spark):
    docs = table(spark, SMALL, "documents")
    root = plain_roots({r.doc_id: r.text for r in docs.collect()})
    assert kept(spark, docs) == sorted(d for d in root if root[d] == d)


def test_similarities_around_the_threshold_equal_brute_force(spark, documents):
    draw = random.Random(1)
    texts, doc = {}, 0
    for length in (4, 30, 120, 400):
        for _ in range(6):
            base = [f"w{draw.randrange(5000)}" for _ in range(length)]
            for count in (0, 0, *[max(0, round(length * x)) for x in (0.005, 0.01, 0.015, 0.02, 0.025, 0.03, 0.05)]):
                texts[doc] = " ".join(changed(base, count, draw))
                doc += 1
    root = plain_roots(texts)
    assert 24 < len(set(root.values())) < len(texts) / 2
    assert kept(spark, documents(list(texts.items()))) == sorted(d for d in root if root[d] == d)


def test_a_bucket_of_several_components_is_compared_across(spark, documents):
    """A template with many fillings: buckets hold nodes above and below the threshold, and chains of links."""
    draw = random.Random(2)
    base = [f"w{k}" for k in range(300)]
    chain = [base]
    for _ in range(40):
        chain.append(changed(draw.choice(chain), draw.choice((5, 8)), draw))
    texts = {k: " ".join(words) for k, words in enumerate(draw.sample(chain, len(chain)))}
    root = plain_roots(texts)
    assert 1 < len(set(root.values())) < len(texts)
    assert kept(spark, documents(list(texts.items()))) == sorted(d for d in root if root[d] == d)


def test_sketches_miss_almost_nothing_at_the_threshold():
    draw = random.Random(3)
    for _ in range(300):
        shared, own = ([draw.getrandbits(64) for _ in range(n)] for n in (160, 40))
        a, b = (resemblance.np.unique(resemblance.np.array(shared + part, resemblance.np.uint64)) for part in (own[:20], own[20:]))
        assert set(resemblance.band_keys(a)) & set(resemblance.band_keys(b))


def test_one_id_with_two_texts_keeps_the_unique_one(spark, documents):
    one, two = (" ".join(f"{p}{k}" for k in range(40)) for p in "ab")
    rows = [(1, one), (2, one), (2, two), (None, one), (3, None), (4, "")]
    got = corpus_pipeline.drop_near_duplicates(spark, documents(rows), SMALL).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted([(1, one), (2, two), (None, one), (3, None)], key=str)


def test_a_crowded_group_is_compared_in_blocks(spark, documents, monkeypatch):
    """Copies of one text with few to many edits: most of what shares a bucket is below the threshold. Blocks of 40 nodes."""
    draw = random.Random(5)
    base = [f"w{draw.randrange(400)}" for _ in range(140)]
    texts = {k: " ".join(changed(base, draw.randrange(0, 9), draw)) for k in range(260)}
    # A second group, with long texts, so that shingles bound its blocks.
    long = [f"v{draw.randrange(3000)}" for _ in range(3000)]
    texts |= {1000 + k: " ".join(changed(long, draw.randrange(60, 200), draw)) for k in range(12)}
    root = plain_roots(texts)
    assert 100 < len(set(root.values())) < 250
    monkeypatch.setattr(resemblance, "NODES", 40)
    monkeypatch.setattr(resemblance, "SHINGLES", 12_000)
    written = {}
    save = Scratch.save

    def counted(self, df, name):
        out = save(self, df, name)
        written[name] = max(written.get(name, 0), out.count())
        return out

    monkeypatch.setattr(Scratch, "save", counted)
    assert kept(spark, documents(list(texts.items()))) == sorted(d for d in root if root[d] == d)
    # No table has more rows than nodes have buckets, though the groups have tens of thousands of pairs.
    assert max(written.values()) <= 36 * len(texts) and written["links"] <= 2 * len(texts)


def test_counting_shared_shingles_equals_brute_force():
    import numpy as np
    import pyarrow as pa
    draw = np.random.default_rng(3)
    sets = [np.unique(np.concatenate([draw.permutation(30)[:27], 100 + draw.integers(0, 9, 3)])) for _ in range(80)] + [np.zeros(0, np.int64)] * 2
    alike = {(a, b) for a in range(82) for b in range(a) if 5 * len(np.intersect1d(sets[a], sets[b])) >= 4 * len(np.union1d(sets[a], sets[b])) > 0}
    for same in (True, False):
        right = np.ones(82, bool) if same else np.arange(82) % 2 == 0
        rows = pa.table({"node": np.arange(82), "root": np.arange(82), "right": right, "shingles": pa.array([s.tolist() for s in sets], pa.list_(pa.int64()))})
        found = resemblance.links_of(rows.to_batches(), same)
        pairs = alike if same else {(a, b) for a, b in alike if right[a] != right[b]}
        want, got = list(range(82)), list(range(82))
        for root, links in ((want, pairs), (got, set(zip(found.column("a").to_pylist(), found.column("b").to_pylist(), strict=True)))):
            for _ in range(82):
                for a, b in links:
                    root[a] = root[b] = min(root[a], root[b])
        assert want == got and len(pairs) > 3


def test_fingerprints_propose_links_and_the_check_refuses_some(spark, documents, monkeypatch):
    """Without sketches, what SimHash proposes is linked where the sets are similar enough: 1 and 3 are 4 and 6 bits from 0."""
    draw = random.Random(7)
    base = [f"w{draw.randrange(5000)}" for _ in range(400)]
    texts = {k: " ".join(words) for k, words in enumerate([base, changed(base, 2, draw), base[::-1], changed(base, 30, draw), base[:3], []])}
    monkeypatch.setattr(resemblance, "band_keys", lambda shingles: [])
    asked = []
    near = resemblance.near_links
    monkeypatch.setattr(resemblance, "near_links", lambda *a, **k: asked.append(1) or near(*a, **k))
    assert kept(spark, documents(list(texts.items()))) == [0, 2, 3, 4, 5] and asked


def test_buckets_give_their_rows_once_across_batches(spark):
    draw = random.Random(8)
    rows = [(key, node, node % 7) for key in range(60) for node in range(draw.choice((1, 1, 2, 5, 90)))]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = resemblance.sharing(spark.createDataFrame(rows, "key bigint, node bigint, size bigint")).collect()
    finally:
        prepare(spark)
    count = {key: sum(r[0] == key for r in rows) for key, _, _ in rows}
    assert sorted(map(tuple, got)) == sorted((k, n, s, 0, 0) for k, n, s in rows if count[k] > 1)


def test_a_sieve_holds_back_only_rows_that_are_not_among_its_own(spark):
    from ledgerloom.llm.tables import sieve, sifted

    rows = spark.range(3000).selectExpr("if(id % 100 = 7, null, id) as a", "cast(id as string) as word", "id")
    may, clear = sifted(rows, sieve(rows.where("id % 5 = 0"), "a", "word"), "a", "word")
    assert may.columns == clear.columns == rows.columns and may.count() + clear.count() == 3000
    assert may.where("id % 5 = 0").count() == 600 and may.count() < 640
