"""Toxicity by a factorization machine over hashed terms.

Terms are the distinct lower-cased letter runs of a text and their beginnings, known by a 64-bit hash. The machine gives
each term a weight and a short vector; a text's logit is the bias, the sum of its terms' weights,
and the sum of the vector products of all its term pairs, so an insult beside a group mention
weighs more than both alone. Pairs are summed in time linear in the terms.

Only the fit is bounded: it uses at most ``per_class`` labelled texts of either label (those with
the smallest hash of their id). Its terms are chosen in rounds. First come those that toxic texts hold more
often than clean ones, by a chi-square with the label of at least ``least_chi2``; harmless words are no evidence,
so a long text does not outweigh its insults. Then the toxic texts that the machine still misses are compared
with the clean ones alone: words that are toxic only together stand in all texts of their kind, however often
each of them is harmless by itself. Rounds go on, each with a new fit, until no term is added or nothing is
missed. Scoring covers every whole text.

Defined results: null and empty texts get the score of the bias alone. Labels that are null, or
whose id or text is missing, teach nothing; of repeated labels each counts. Without labels of both
kinds the score is 0.5 everywhere. Repeated rows are all scored alike. Only the id and text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.tables import Scratch, prepare

LETTERS = re.compile(r"[^\W\d_]+")
STEMS = (4, 5, 6)  # lengths of beginnings, which inflected forms of a word share


@dataclass(frozen=True)
class Settings:
    per_class: int = 6000
    least_chi2: float = 10.83  # one term in a thousand passes by chance
    caught: float = 0.7  # toxic texts below this score are missed
    rounds: int = 5
    factors: int = 8
    epochs: int = 40
    rate: float = 0.2
    l2: float = 1e-5
    seed: int = 7


def hashed_terms(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct letter runs and of their beginnings, which are marked by a hyphen."""
    words = set(LETTERS.findall((text or "").lower()))
    terms = [*words, *(f"{start}-" for size in STEMS for start in {w[:size] for w in words if len(w) > size})]
    return np.sort(np.fromiter((xxhash.xxh3_64_intdigest(t.encode()) for t in terms), np.uint64, len(terms)).view(np.int64))


@dataclass(frozen=True)
class Machine:
    """``terms`` is sorted; ``weights`` and ``vectors`` follow it. Its size is bounded by Settings."""

    bias: float
    terms: np.ndarray
    weights: np.ndarray
    vectors: np.ndarray

    def logits(self, rows: list[np.ndarray]) -> np.ndarray:
        """Each row holds the hashed terms of one text."""
        out = np.full(len(rows), self.bias)
        if len(self.terms):
            for n, row in enumerate(rows):
                at = np.searchsorted(self.terms, row)
                at[at == len(self.terms)] = 0
                at = at[self.terms[at] == row]
                if len(at):
                    v = self.vectors[at]
                    out[n] += self.weights[at].sum() + 0.5 * (v.sum(0) ** 2 - (v ** 2).sum(0)).sum()
        return out

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(rows), -30, 30)))


def fit(rows: list[np.ndarray], labels: np.ndarray, terms: np.ndarray, settings: Settings) -> Machine:
    """AdaGrad on the logistic loss; ``rows`` are positions in ``terms``. Both labels weigh the same."""
    random = np.random.default_rng(settings.seed)
    weights = np.zeros(len(terms))
    vectors = random.normal(0, 0.05, (len(terms), settings.factors))
    weight_sum, vector_sum, bias, bias_sum = np.full(len(terms), 1e-8), np.full(vectors.shape, 1e-8), 0.0, 1e-8
    share = np.array([max(1, (labels == k).sum()) for k in (0, 1)])
    cost = (len(labels) / 2 / share)[labels]
    for _ in range(settings.epochs):
        order = random.permutation(len(rows))
        for start in range(0, len(rows), 256):
            part = order[start:start + 256]
            sizes = np.array([len(rows[n]) for n in part])
            owner = np.repeat(np.arange(len(part)), sizes)
            at = np.concatenate([rows[n] for n in part]) if sizes.sum() else np.zeros(0, np.int64)
            v = vectors[at]
            summed = np.zeros((len(part), settings.factors))
            np.add.at(summed, owner, v)
            squares = np.zeros(len(part))
            np.add.at(squares, owner, (v ** 2).sum(1))
            logit = bias + np.bincount(owner, weights[at], len(part)) + 0.5 * ((summed ** 2).sum(1) - squares)
            slope = cost[part] * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[part]) / len(part)
            bias_sum += slope.sum() ** 2
            bias -= settings.rate * slope.sum() / np.sqrt(bias_sum)
            used, where = np.unique(at, return_inverse=True)
            if not len(used):
                continue
            g = np.bincount(where, slope[owner], len(used)) + settings.l2 * weights[used]
            weight_sum[used] += g ** 2
            weights[used] -= settings.rate * g / np.sqrt(weight_sum[used])
            gv = np.zeros((len(used), settings.factors))
            np.add.at(gv, where, slope[owner, None] * (summed[owner] - v))
            gv += settings.l2 * vectors[used]
            vector_sum[used] += gv ** 2
            vectors[used] -= settings.rate * gv / np.sqrt(vector_sum[used])
    return Machine(float(bias), terms, weights, vectors)


def train(docs: DataFrame, labels: DataFrame, label: str, settings: Settings = Settings()) -> Machine:
    """Fit on the documents that ``labels`` (doc_id and ``label``) marks 0 or 1."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "toxicity")
    marked = labels.select("doc_id", F.col(label).cast("int").alias("label")).where("doc_id is not null and label in (0, 1)")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = marked.where("label = 0").orderBy(*order).limit(settings.per_class).unionByName(
        marked.where("label = 1").orderBy(*order).limit(settings.per_class))
    sample = scratch.save(sample, "sample")
    # The sample has at most 2 * per_class rows of two numbers, so it may be sent to every task.
    texts = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(sample), "doc_id")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [hashed_terms(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(rows, pa.list_(pa.int64()))], ["label", "terms"])

    found = scratch.save(texts.select("label", "text").mapInArrow(split, "label int, terms array<bigint>"), "terms")
    terms = np.zeros(0, np.int64)
    machine = Machine(0.0, terms, np.zeros(0), np.zeros((0, settings.factors)))
    for number in range(settings.rounds):
        rest = found if not number else scratch.save(missed(found, machine, settings), f"missed-{number}")
        fresh = np.setdiff1d(evidence(rest, settings), terms)
        if not len(fresh):
            break
        terms = np.union1d(terms, fresh)
        machine = fitted(found, terms, settings)
    return machine


def missed(found: DataFrame, machine: Machine, settings: Settings) -> DataFrame:
    """The clean texts, and the toxic ones that the machine scores too low."""
    sent = found.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [row.values.to_numpy() for row in batch.column("terms")]
            low = sent.value.scores(rows) < settings.caught
            yield batch.filter(pa.array(low | (batch.column("label").to_numpy() == 0)))

    return found.mapInArrow(run, "label int, terms array<bigint>")


def evidence(rows: DataFrame, settings: Settings) -> np.ndarray:
    """The terms that toxic rows hold more often than clean ones, beyond chance; none without both labels.

    They come to the driver; the bounded sample's texts bound them.
    """
    n1, n = rows.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count("*")).first()
    if not 0 < n1 < n:
        return np.zeros(0, np.int64)
    n, n1 = F.lit(float(n)), F.lit(float(n1))
    counts = rows.select("label", F.explode("terms").alias("term")).groupBy("term").agg(
        F.count("*").cast("double").alias("df"), F.sum("label").cast("double").alias("pos"))
    gap = F.col("pos") * n - F.col("df") * n1
    chi2 = gap * gap * n / (F.col("df") * (n - F.col("df")) * n1 * (n - n1))
    chosen = counts.where(F.col("df") < n).where((gap > 0) & (chi2 >= settings.least_chi2))
    return np.sort(np.array([r["term"] for r in chosen.select("term").collect()], np.int64))


def fitted(found: DataFrame, terms: np.ndarray, settings: Settings) -> Machine:
    """The machine over these terms; one task fits the bounded sample, and the bounded model comes back."""
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, marks = [], []
        for batch in batches:
            marks += batch.column("label").to_pylist()
            for row in batch.column("terms"):
                rows.append(np.flatnonzero(np.isin(terms, row.values.to_numpy(), assume_unique=True)))
        if rows:
            order = np.array(sorted(range(len(rows)), key=lambda k: (marks[k], len(rows[k]), rows[k].tobytes())))
            machine = fit([rows[k] for k in order], np.array(marks)[order], terms, settings)
            yield pa.RecordBatch.from_arrays(
                [pa.array([machine.bias]), pa.array([machine.weights]), pa.array([machine.vectors.ravel()])], ["bias", "weights", "vectors"])

    model = found.coalesce(1).mapInArrow(learn, "bias double, weights array<double>, vectors array<double>").first()
    return Machine(model["bias"], terms, np.array(model["weights"]), np.array(model["vectors"]).reshape(len(terms), settings.factors))


def score(docs: DataFrame, machine: Machine, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns (none may be called toxic_score) and ``toxic_score``, 0 to 1."""
    spark = docs.sparkSession
    prepare(spark)
    sent = spark.sparkContext.broadcast(machine)
    rows = docs.select(*dict.fromkeys([*keep, text]))
    schema = ", ".join([f"`{n}` {t}" for n, t in rows.select(*keep).dtypes] + ["toxic_score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = sent.value.scores([hashed_terms(t) for t in batch.column(text).to_pylist()])
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in keep], pa.array(scores, pa.float64())], [*keep, "toxic_score"])

    return rows.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Rows kept away from training: a third by the checksum of the id. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def model_for(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Machine:
    """The machine for ``labels.toxic``, taught without the held-out rows."""
    prepare(docs.sparkSession)
    return train(docs, labels.where(~held_out(F.col("doc_id"))), "toxic", settings)
