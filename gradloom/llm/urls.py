"""URL filters: pattern rules indexed by their rarest literal token."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradloom.session import local_table

# Longest rule list that is shipped to every executor; longer ones are joined by a shuffle.
BROADCAST_RULES = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``pattern`` is a regular expression over host + path (``whole`` False) or the lower-cased url (``whole`` True).

    ``tokens`` are runs of a-z and 0-9 that every matching text holds as whole runs. Rules of a higher ``rank`` win.
    """

    name: str
    pattern: str
    tokens: tuple[str, ...]
    verdict: str
    rank: int
    whole: bool = False


def host_rule(text: str, verdict: str) -> Rule:
    """``example.com/de/``: the host and its subdomains, for paths that start with ``/de/``. Longer rules win."""
    host, _, rest = text.partition("/")
    path = "/" + rest
    pattern = r"^(?:[^/]*\.)?" + re.escape(host) + re.escape(path)
    # The last run of a path may go on in the url; it is a whole token only if the rule ends behind it.
    runs = re.findall(r"[a-z0-9]+", host) + [
        m.group() for m in re.finditer(r"[a-z0-9]+", path.lower()) if m.end() < len(path)
    ]
    return Rule(text, pattern, tuple(runs), verdict, 1_000_000 + len(text))


HOST_RULES = [
    host_rule("net/", "block"),
    host_rule("example.net/en/", "allow"),
    host_rule("example.com/de/", "block"),
    host_rule("org/fr/", "allow"),
]
# What the method itself decides where no host rule fits: pages that hold no prose of their own.
PATTERN_RULES = [
    Rule("login page", r"[/.]login(?:[/.?#]|$)", ("login",), "block", 1, True),
    Rule("sign-in page", r"[/.]signin(?:[/.?#]|$)", ("signin",), "block", 2, True),
    Rule("shopping cart", r"/cart(?:[/?#]|$)", ("cart",), "block", 3, True),
    Rule("session in the address", r"[?&;]phpsessid=[0-9a-f]{8,}", ("phpsessid",), "block", 4, True),
    Rule("search result", r"/search/?\?q=", ("search", "q"), "block", 5, True),
    Rule("calendar day", r"/calendar/[0-9]{4}/[0-9]{2}", ("calendar",), "block", 6, True),
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path behind the first ``://``; both empty without one or for a null url."""
    known = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(known, r"://([^/?#]*)([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(known, r"://([^/?#]*)([^?#]*)", 2)


def url_tokens(url: Column) -> Column:
    """Distinct runs of a-z and 0-9 in the url, A-Z lowered."""
    lowered = F.translate(url, UPPER, LOWER)
    return F.array_distinct(F.filter(F.split(lowered, "[^a-z0-9]+"), lambda t: t != ""))


def judge_urls(df: DataFrame, url: str, rules: list[Rule]) -> DataFrame:
    """One row per distinct url that some rule fits: url, rule, verdict of the rule with the highest rank.

    Tokens of all urls are counted once; each rule is filed under its rarest token, so a rule that holds ``net`` and
    ``checkout`` is looked at for the few urls with ``checkout`` only. Urls fetch candidates by an equi-join on
    tokens, and only candidates run their regular expression. Equal urls are judged once. A rule without tokens is
    refused. Null urls fit no rule; an empty table gives no rows; ties in rank go to the smaller name.
    """
    if any(not rule.tokens for rule in rules):
        raise ValueError("every rule needs a literal token")
    book = _rule_table(df.sparkSession, rules)
    ship = F.broadcast if len(rules) <= BROADCAST_RULES else (lambda table: table)
    urls = df.where(F.col(url).isNotNull()).select(F.col(url).alias("url")).distinct()
    tokens = urls.select("url", F.explode(url_tokens(F.col("url"))).alias("token"))
    literals = book.select("name", F.explode("tokens").alias("token"))
    counts = (
        tokens.join(ship(literals.select("token").distinct()), "token").groupBy("token").agg(F.count("*").alias("n"))
    )
    rarest = (
        literals.join(counts, "token", "left")
        .groupBy("name")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))["token"].alias("token"))
    )
    index = book.drop("tokens").join(ship(rarest), "name")
    host, path = host_and_path(F.col("url"))
    subject = F.when(F.col("whole"), F.translate("url", UPPER, LOWER)).otherwise(F.concat(host, path))
    fitting = tokens.join(ship(index), "token").where(F.regexp_like(subject, F.col("pattern")))
    best = F.max_by(F.struct("name", "verdict", "whole"), F.struct(F.col("rank"), -F.col("place")))
    return fitting.groupBy("url").agg(best.alias("best")).select("url", "best.*")


def _rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """The rules as a table: as long as the rule list that the caller wrote, whatever the number of urls."""
    ordered = sorted(rules, key=lambda r: r.name)
    rows = [(r.name, r.pattern, list(r.tokens), r.verdict, r.rank, r.whole, i) for i, r in enumerate(ordered)]
    return local_table(
        spark, rows, "name string, pattern string, tokens array<string>, verdict string, rank int, whole boolean, place int"
    )


def filter_urls(df: DataFrame, url: str = "url", rules: list[Rule] | None = None) -> DataFrame:
    """Add host, path, rule and verdict to every row.

    ``rule`` names the longest host rule that fits, else null; ``verdict`` is that rule's, else the one of the fitting
    pattern rule, else ``allow``. Columns of these names are replaced. Rows with a null url or one without ``://`` are
    kept, with empty host and path. The join back is by url: Spark splits a url that many rows share.
    """
    rules = HOST_RULES + PATTERN_RULES if rules is None else rules
    found = judge_urls(df, url, rules).select(
        F.col("url").alias("_url"), F.col("name").alias("_name"), F.col("verdict").alias("_verdict"), F.col("whole").alias("_whole")
    )
    kept = df.drop(*({"host", "path", "rule", "verdict"} - {url}))
    host, path = host_and_path(F.col(url))
    return (
        kept.join(found, F.col(url) == F.col("_url"), "left")
        .withColumn("host", host)
        .withColumn("path", path)
        .withColumn("rule", F.when(~F.col("_whole"), F.col("_name")))
        .withColumn("verdict", F.coalesce("_verdict", F.lit("allow")))
        .drop("_url", "_name", "_verdict", "_whole")
    )
