"""Temperature mixing of sources by DataFrame operations only.

A source's share of all tokens is raised to an exponent between 0 (all sources alike) and 1 (as they
are) and normalised. The exponent is bisected: to the largest whose weights reach a target entropy
(``entropy``, as a share of the greatest possible one), or to the smallest at which no source must
be repeated more than ``repeats`` times for the budget. A limit that already holds at one end
of the range keeps that end.

The weights are realised as budgeted block permutations. Each source is passed over as often as its
quota (weight times budget) asks; every pass is a fresh permutation of its documents by a keyed
digest, and the last one stops before the quota is passed. The mix is cut into blocks of
``block_tokens``; a document belongs to the block in which its source's running total begins, so
every block holds the sources in their weights. Within a block documents follow their digests.

Running totals never put a source into one task: a pass is cut by the digest's first twelve bits
into slices, slices are summed before they are shuffled, and totals run over the 4,096 slice sums of a
source and pass and, separately, inside each slice.

Defined results: a null source is a source of its own. Null texts have no tokens; such documents
stand in every pass but use up no budget. Documents without an id stand in none. Rows that share an
id are one document, whose source and tokens are the smallest pair among them. An empty table, or one without tokens, gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.tables import Scratch, prepare

STEPS = 50


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space; no text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def exponent_sql(entropy: float | None, repeats: float | None) -> str:
    """SQL of the exponent over the columns ``shares`` (one number per source), ``total`` and ``budget``."""
    def norm(m: str) -> str:
        return f"aggregate(shares, 0D, (s, x) -> s + pow(x, {m}))"

    def holds(m: str) -> str:
        if entropy is not None:
            mean_log = f"{m} * aggregate(shares, 0D, (s, x) -> s + pow(x, {m}) * ln(x)) / {norm(m)}"
            return f"ln({norm(m)}) - {mean_log} >= {entropy}D * ln(size(shares))"
        # The smallest source is repeated most, as no exponent is above 1.
        return f"pow(array_min(shares), {m} - 1) / {norm(m)} * budget / total <= {repeats}D"

    low, middle, high = "b.lo", "(b.lo + b.hi) / 2", "b.hi"
    # Entropy falls as the exponent grows, so a target that holds raises it; a held limit lowers it.
    raised, lowered = f"named_struct('lo', {middle}, 'hi', {high})", f"named_struct('lo', {low}, 'hi', {middle})"
    held, missed = (raised, lowered) if entropy is not None else (lowered, raised)
    found = f"aggregate(sequence(1, {STEPS}), named_struct('lo', 0D, 'hi', 1D), (b, i) -> IF({holds(middle)}, {held}, {missed}))"
    if entropy is not None:
        return f"IF({holds('1D')}, 1D, {found}.lo)"
    return f"IF({holds('0D')}, 0D, {found}.hi)"


def mixture(docs: DataFrame, entropy: float | None = None, repeats: float | None = None, budget: int | None = None) -> DataFrame:
    """source, tokens, share, exponent, weight and quota (whole tokens), one row per source with tokens.

    ``docs`` has source and n_tokens. The budget is the number of all tokens unless given.
    """
    if (entropy is None) == (repeats is None):
        raise ValueError("name either a target entropy or a repetition limit")
    sources = docs.groupBy("source").agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0")
    # One pair per source meets in one row; documents never do.
    whole = sources.agg(F.sum("tokens").alias("total"), F.sort_array(F.collect_list(F.struct("tokens", "source"))).alias("sources"))
    whole = whole.withColumn("shares", F.expr("transform(sources, x -> cast(x.tokens as double) / total)")).withColumn(
        "budget", F.lit(budget).cast("bigint") if budget is not None else F.col("total"))
    # Stored, so that the search runs once and not wherever its result is used.
    whole = Scratch(docs.sparkSession, "mixture").save(whole.withColumn("exponent", F.expr(exponent_sql(entropy, repeats))), "exponent")
    whole = whole.withColumn("norm", F.expr("aggregate(shares, 0D, (s, x) -> s + pow(x, exponent))"))
    each = whole.select("total", "budget", "exponent", "norm", F.inline("sources"))
    each = each.withColumn("share", F.col("tokens").cast("double") / F.col("total"))
    each = each.withColumn("weight", F.pow("share", "exponent") / F.col("norm"))
    quota = F.floor(F.col("weight") * F.col("budget") + 1e-6).cast("bigint")
    return each.select("source", "tokens", "share", "exponent", "weight", quota.alias("quota"))


def mix(docs: DataFrame, entropy: float | None = None, repeats: float | None = None, budget: int | None = None,
        block_tokens: int = 1_000_000, key: str = "mix") -> DataFrame:
    """One row per document and pass that the mix holds: doc_id, source, n_tokens, pass, start, block, place.

    ``docs`` has doc_id, source and n_tokens. ``start`` is the source's running total before the
    document, ``place`` the digest that orders documents inside a block.
    """
    spark = docs.sparkSession
    prepare(spark)
    scratch = Scratch(spark, "mix")
    # Ids are numbers, or texts where a caller names rows by more than a number.
    name = F.col("doc_id") if dict(docs.dtypes)["doc_id"] == "string" else F.col("doc_id").cast("bigint")
    rows = docs.select(name.alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("n_tokens").cast("bigint").alias("n_tokens"))
    one = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.struct("source", "n_tokens")).alias("row"))
    rows = scratch.save(one.select("doc_id", "row.source", "row.n_tokens"), "documents")
    plan = scratch.save(mixture(rows, entropy, repeats, budget), "mixture")

    # A pass begins while the quota exceeds what earlier passes have used.
    passes = plan.select("source", "tokens", "weight", "quota", F.explode(F.expr("sequence(0, cast(greatest(ceil(quota / tokens), 1) as int) - 1)")).alias("pass"))
    same = rows["source"].eqNullSafe(passes["source"])
    dealt = rows.join(passes, same).select(
        "doc_id", passes["source"], "n_tokens", "pass", "tokens", "weight", "quota",
        F.md5(F.concat_ws("/", F.lit(key), F.col("pass").cast("string"), F.col("doc_id").cast("string"))).alias("place"),
    ).withColumn("slice", F.substring("place", 1, 3))
    sums = dealt.groupBy("source", "pass", "slice").agg(F.sum("n_tokens").alias("held"))
    over = Window.partitionBy("source", "pass").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("source", "pass", "slice", F.coalesce(F.sum("held").over(over), F.lit(0)).alias("before"))

    inside = Window.partitionBy("source", "pass", "slice").orderBy("place", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("within", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    on = placed["source"].eqNullSafe(offsets["source"]) & (placed["pass"] == offsets["pass"]) & (placed["slice"] == offsets["slice"])
    started = placed.join(offsets.select(F.col("source"), "pass", "slice", "before"), on).select(
        "doc_id", placed["source"], "n_tokens", placed["pass"], "place", "weight", "quota",
        (placed["pass"] * F.col("tokens") + F.col("before") + F.col("within")).alias("start"),
    )
    taken = started.where("start + n_tokens <= quota")
    block = F.floor(F.col("start") / F.greatest(F.col("weight") * block_tokens, F.lit(1.0))).cast("bigint")
    return taken.select("doc_id", "source", "n_tokens", F.col("pass").cast("int").alias("pass"), F.col("start").cast("bigint").alias("start"), block.alias("block"), "place")


def counted(docs: DataFrame) -> DataFrame:
    """doc_id, source and n_tokens of documents with text."""
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("n_tokens"))
