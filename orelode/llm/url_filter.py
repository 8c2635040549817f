"""URL rules, found by their rarest literal token.

A rule is a regular expression over ``host + path``. Each rule is filed under that of its literal
tokens which the given URLs use least. A URL's tokens fetch the rules filed under them, and only those
run their expression; the rule with the longest name wins.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelode.llm.common import free_name

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """``name`` shows in the result; ``regex`` must match; every one of ``tokens`` is in each match."""

    name: str
    verdict: str
    regex: str
    tokens: tuple[str, ...]
    #: Rules of a lower rank win over those of a higher one.
    rank: int = 0


def host_rule(verdict: str, rule: str) -> Rule:
    """A rule like ``example.com/en/``: that host, all hosts below it, paths that begin so."""
    regex = rf"^([^/]*\.)?{re.escape(rule)}"
    closed = rule if re.search("[^A-Za-z0-9]$", rule) else re.sub("[A-Za-z0-9]+$", "", rule)
    return Rule(rule, verdict, regex, tuple(re.findall("[a-z0-9]+", closed.lower())))


# The rules of the contract, then patterns for what no rule decides.
RULES = (
    host_rule(ALLOW, "com/"),
    host_rule(BLOCK, "example.com/en/"),
    host_rule(ALLOW, "www.example.com/en/"),
    host_rule(BLOCK, "net/es/"),
    host_rule(BLOCK, "net/fr/"),
)
PATTERNS = tuple(
    Rule(word, BLOCK, rf"(^|[./_-]){word}([./_-]|$)", (word,), rank=1)
    for word in ("adult", "casino", "pills", "porn", "spam", "warez", "xxx")
)
# The letters A to Z, whose lower case hosts take.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    found = F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit(""))
    return F.translate(found, UPPER, LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def tokens(target: Column) -> Column:
    """The different runs of letters and digits, in lower case."""
    lowered = F.translate(target, UPPER, LOWER)
    return F.array_distinct(F.regexp_extract_all(lowered, F.lit("([a-z0-9]+)"), F.lit(1)))


def judge(pages: DataFrame, url: str, rules: Sequence[Rule]) -> DataFrame:
    """Every row of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rule`` is NULL where no rule of rank 0 fits; the verdict is then that of the best other rule,
    and ``allow`` where none fits at all. NULL and malformed URLs have empty hosts and paths, which no
    rule fits. Repeated URLs are judged once. Columns of ``pages`` that have one of these names keep
    their place under the name with ``_`` in front. The rules are a parameter held by the driver.
    """
    spark = pages.sparkSession
    for name in ("host", "path", "rule", "verdict"):
        if name in pages.columns:
            pages = pages.withColumnRenamed(name, free_name(pages, f"_{name}"))
    key = free_name(pages, "_target")
    pages = pages.withColumns({"host": host(F.col(url)), "path": path(F.col(url))})
    pages = pages.withColumn(key, F.concat("host", "path"))
    targets = pages.select(F.col(key).alias("target")).filter("target != ''").distinct()
    words = targets.select("target", F.explode(tokens(F.col("target"))).alias("token"))

    literal = spark.createDataFrame(
        [(n, t) for n, r in enumerate(rules) for t in set(r.tokens)] or [(-1, "")],
        "id int, token string",
    )
    known = literal.select("token").distinct()
    # One row per token of a rule, however many URLs there are.
    used = {
        r["token"]: r["n"]
        for r in words.join(known, "token").groupBy("token").agg(F.count("*").alias("n")).collect()
    }
    filed = [
        (n, r.name, r.verdict, r.regex, r.rank, len(r.name),
         min(r.tokens, key=lambda t: (used.get(t, 0), t)))
        for n, r in enumerate(rules)
    ]
    index = spark.createDataFrame(
        filed, "id int, rule string, verdict string, regex string, rank int, size int, token string"
    )
    order = F.struct(-F.col("rank"), "size", -F.col("id"))
    best = (
        words.join(index, "token")
        .filter(F.expr("target rlike regex"))
        .groupBy("target")
        .agg(F.max_by(F.struct("rule", "verdict", "rank"), order).alias("won"))
    )
    found = pages.join(best.withColumnRenamed("target", key), key, "left")
    return found.withColumns({
        "rule": F.when(F.col("won.rank") == 0, F.col("won.rule")),
        "verdict": F.coalesce("won.verdict", F.lit(ALLOW)),
    }).drop(key, "won")
