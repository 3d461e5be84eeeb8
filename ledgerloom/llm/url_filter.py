"""URL verdicts from pattern rules that are indexed by their rarest literal token.

Every rule is a regular expression over ``host + path`` and names literal tokens (runs of ASCII
letters and digits) that each of its matches must contain. A rule is filed under the one of its
tokens that fewest URLs hold. The distinct tokens of a URL fetch the rules filed under them, and
only those run their expression; rules without a literal token are fetched by every URL.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule and
gets the default verdict. Repeated rows are judged alike and all returned. Only the id and url
columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.tables import Scratch, prepare

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOKEN = "[A-Za-z0-9]+"
#: The token of rules without a literal; no URL token is empty, and every URL looks it up.
ALWAYS = ""
RULES = "name string, verdict string, pattern string, tokens array<string>, listed boolean"


@dataclass(frozen=True)
class Rule:
    """``name`` is reported; of several rules that fit, the longest name wins, then the smaller one."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    listed: bool = True


def host_rule(name: str, verdict: str) -> Rule:
    """A rule written ``host/path``: that host and its subdomains, where the path starts with the rule's."""
    host, slash, path = name.partition("/")
    host, prefix = host.translate(str.maketrans(UPPER, LOWER)), slash + path
    # The last token of a prefix may go on in the URL, so it is literal only when something ends it.
    whole = re.findall(TOKEN, host) + re.findall(f"{TOKEN}(?=[^A-Za-z0-9])", prefix)
    return Rule(name, verdict, rf"^(?:[^/]*\.)?{java_quote(host)}{java_quote(prefix)}", tuple(whole))


def pattern_rule(name: str, verdict: str, pattern: str, tokens: tuple[str, ...]) -> Rule:
    """A free expression. Its verdict counts only where no listed rule fits."""
    return Rule(name, verdict, pattern, tokens, listed=False)


def java_quote(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/])", r"\\\1", text)


#: Rules a crawl list starts from.
LISTED = [
    host_rule("net/", "block"),
    host_rule("example.net/en/", "allow"),
    host_rule("example.com/de/", "block"),
    host_rule("org/fr/", "allow"),
]
PATTERNS = [
    pattern_rule("farm host", "block", r"^(?:[^/]*\.)?(?:spam|link|content)-farm\.", ("farm",)),
    pattern_rule("casino host", "block", r"^(?:[^/]*[.-])?casino[.-]", ("casino",)),
    # One rule per alternative, so that each has a literal token.
    pattern_rule("bets host", "block", r"^(?:[^/]*[.-])?bet[.-]", ("bet",)),
    pattern_rule("bets host", "block", r"^(?:[^/]*[.-])?bets[.-]", ("bets",)),
    pattern_rule("adult host", "block", r"^(?:[^/]*[.-])?adult-videos?[.-]", ("adult",)),
    pattern_rule("adult host", "block", r"^(?:[^/]*[.-])?xxx-videos?[.-]", ("xxx",)),
    pattern_rule("session path", "block", r"^[^/]*/(?:.*/)?sid/[0-9a-f]{16,}", ("sid",)),
    pattern_rule("session path", "block", r"^[^/]*/(?:.*/)?sessionid/[0-9a-f]{16,}", ("sessionid",)),
]


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """Rules as a table (name, verdict, pattern, tokens, listed), as ``judge`` takes it."""
    return spark.createDataFrame([(r.name, r.verdict, r.pattern, list(r.tokens), r.listed) for r in rules], RULES)


def rule_index(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per rule with the token it is filed under: of its tokens the one that fewest urls hold, then the smallest.

    Tokens are counted over all urls, those that no rule names left out before the count.
    """
    each = rules.select("name", "verdict", "pattern", "listed", F.explode_outer("tokens").alias("token"))
    wanted = each.where("token is not null").select("token").distinct()
    counted = urls.select(F.explode("tokens").alias("token")).join(wanted, "token", "left_semi").groupBy("token").count()
    filed = each.join(counted, "token", "left").groupBy("name", "verdict", "pattern", "listed").agg(
        F.min(F.when(F.col("token").isNotNull(), F.struct(F.coalesce("count", F.lit(0)).alias("held"), "token"))).alias("rarest"))
    return filed.select(F.coalesce("rarest.token", F.lit(ALWAYS)).alias("token"), "name", F.col("verdict").alias("rule_verdict"), "pattern", "listed")


def fetched(places: DataFrame, index: DataFrame) -> DataFrame:
    """Each place with the rules that its tokens fetch; only these run their expressions."""
    return places.select("host", "path", "place", F.explode("tokens").alias("token")).join(index, "token")


def with_tokens(places: DataFrame) -> DataFrame:
    """Adds ``tokens``, the distinct ones of ``place`` and the one that every URL looks up."""
    tokens = F.array_distinct(F.regexp_extract_all("place", F.lit(f"({TOKEN})"), 1))
    return places.withColumn("tokens", F.concat(F.array(F.lit(ALWAYS)), tokens))


def judge(pages: DataFrame, rules: list[Rule] | DataFrame | None = None, default: str = "allow", page_id: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict and the name of the deciding pattern for every row.

    ``rule`` is the listed rule that won, else null; without one the verdict is that of the longest
    pattern rule that fits, else ``default``. ``rules`` is a list or a table as ``rule_table`` makes it, of any size.
    Distinct urls are judged once; a url that many rows share is joined back by Spark, which splits such a key.
    """
    spark = pages.sparkSession
    prepare(spark)
    if not isinstance(rules, DataFrame):
        rules = rule_table(spark, (LISTED + PATTERNS) if rules is None else rules)
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    named = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    places = named.select("host", "path").distinct().withColumn("place", F.concat("host", "path"))
    places = with_tokens(places)
    index = Scratch(spark, "url-rules").save(rule_index(places, rules), "index")
    fits = fetched(places, index).where(F.expr("place rlike pattern"))
    # Longest name first, then the smaller name: the order of a struct's fields.
    rank = F.struct(-F.length("name"), F.col("name"), F.col("rule_verdict"))
    best = fits.groupBy("host", "path").agg(
        F.min(F.when(F.col("listed"), rank)).alias("listed"), F.min(F.when(~F.col("listed"), rank)).alias("free"),
    )
    best = Scratch(spark, "urls").save(best, "best")
    # Sorted and merged: the file's size tells too little of the rows', which grow with the urls, to send them to all tasks.
    return named.join(best.hint("merge"), ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("listed.name").alias("rule"),
        F.coalesce("listed.rule_verdict", "free.rule_verdict", F.lit(default)).alias("verdict"),
        F.when(F.col("listed").isNull(), F.col("free.name")).alias("pattern"),
    )
