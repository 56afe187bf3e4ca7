"""Operator 9: URL filters. Rules are indexed by their rarest literal token; only candidates run their pattern.

A rule names literal tokens that every URL it fits must contain whole. The rarest of them, counted over the
URLs at hand, is its key in the index. A URL fetches the rules of its own tokens, and only those
rules' regular expressions are tried. Rules without a token are candidates for every URL.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcome_lens.llm.common import ascii_lower

TOKEN = "[a-z0-9]+"


class Rule(NamedTuple):
    """``pattern`` is tried on host and path (``subject`` place) or on the lower-cased rest after ``://`` (url)."""

    rule: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    subject: str


def place_rule(verdict: str, place: str) -> Rule:
    """Fits a host and its subdomains, where the path starts as the rule's does."""
    host, slash, path = place.partition("/")
    named = re.findall(TOKEN, host.lower())
    # the last word of a path that ends in it may go on in a URL, and is no whole token
    named += re.findall(TOKEN, (slash + path).lower() if re.search("[^A-Za-z0-9]$", slash + path) else re.sub("[A-Za-z0-9]+$", "", slash + path).lower())
    return Rule(place, verdict, f"^(?:[^/]*\\.)?{re.escape(host)}{re.escape(slash + path)}", tuple(dict.fromkeys(named)), "place")


def word_rule(verdict: str, word: str) -> Rule:
    """Fits URLs with a word, or words in a row, between other characters than letters and digits."""
    parts = re.findall(TOKEN, word.lower())
    return Rule(word, verdict, "(?<![a-z0-9])" + "[^a-z0-9]".join(parts) + "(?![a-z0-9])", tuple(parts), "url")


# The stated rules on places, and words of sites and scripts that are no text for a corpus.
PLACES = (
    place_rule("block", "net/"),
    place_rule("allow", "example.net/en/"),
    place_rule("block", "example.com/de/"),
    place_rule("allow", "org/fr/"),
)
WORDS = tuple(
    word_rule("block", w)
    for w in (
        "casino", "poker", "jackpot", "betting", "slots", "viagra", "cialis", "pharmacy", "porn", "xxx", "hentai", "escort",
        "torrent", "warez", "keygen", "crack", "adserver", "doubleclick", "adclick", "banner ads", "popunder", "phishing",
        "wp login", "xmlrpc php", "cgi bin", "free download",
    )
)


def rest_of(url: Column) -> Column:
    """What follows the first ``://``; empty for null and for URLs without it."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(rest_of(url), "^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(rest_of(url), "^[^/?#]*([^?#]*)", 1)


def tokens_of(url: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(ascii_lower(rest_of(url)), F.lit(TOKEN), 0))


def rule_index(urls: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """One row a rule, with its rarest token among ``urls`` (one column ``url``, distinct); null without tokens."""
    spark = urls.sparkSession
    rows = [(i, r.rule, r.verdict, r.pattern, list(r.tokens), r.subject) for i, r in enumerate(rules)]
    listed = spark.createDataFrame(rows, "n int, rule string, verdict string, pattern string, tokens array<string>, subject string")
    wanted = listed.select(F.explode("tokens").alias("token")).distinct()
    counted = urls.select(F.explode(tokens_of(F.col("url"))).alias("token")).join(wanted, "token").groupBy("token").count()
    choice = F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "token"))["token"]
    rarest = listed.select("n", F.explode("tokens").alias("token")).join(counted, "token", "left").groupBy("n").agg(choice.alias("token"))
    return listed.join(rarest, "n", "left").select("rule", "verdict", "pattern", "subject", "token")


def judged(pages: DataFrame, places: tuple[Rule, ...] = PLACES, words: tuple[Rule, ...] = WORDS) -> DataFrame:
    """``page_id, host, path, rule, verdict, pattern`` of every row.

    The longest fitting place decides; without one, a URL is blocked if a word rule fits, ``pattern`` being the
    first in order. URLs are judged once each, however often they stand in ``pages``. Null URLs and URLs
    without ``://`` have an empty host and path, fit nothing and are allowed.
    """
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"))
    urls = rows.select("url").filter("url is not null").distinct()
    index = rule_index(urls, places + words)
    tokens = F.array_append(tokens_of(F.col("url")), "")
    wanted = urls.select("url", F.explode(tokens).alias("token"))
    candidates = wanted.join(index.withColumn("token", F.coalesce("token", F.lit(""))), "token")
    subject = F.when(F.col("subject") == "place", F.concat(host_of(F.col("url")), path_of(F.col("url")))).otherwise(ascii_lower(rest_of(F.col("url"))))
    fits = candidates.filter(F.rlike(subject, F.col("pattern")))
    place = F.when(F.col("subject") == "place", F.struct(F.length("rule").alias("size"), "rule", "verdict"))
    word = F.when((F.col("subject") == "url") & (F.col("verdict") == "block"), F.col("rule"))
    verdicts = fits.groupBy("url").agg(F.max(place).alias("place"), F.min(word).alias("pattern"))
    out = rows.join(verdicts, "url", "left")
    return out.select(
        "page_id",
        F.coalesce(host_of(F.col("url")), F.lit("")).alias("host"),
        F.coalesce(path_of(F.col("url")), F.lit("")).alias("path"),
        F.col("place.rule").alias("rule"),
        F.coalesce("place.verdict", F.when(F.col("pattern").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        "pattern",
    )


def judged_sql() -> str:
    """The same in DuckDB SQL, with every rule tried on every URL."""
    places = ", ".join(f"('{r.rule}', '{r.verdict}')" for r in PLACES)
    words = " UNION ALL ".join(f"SELECT '{r.rule}' AS w, '(^|[^a-z0-9]){'[^a-z0-9]'.join(r.tokens)}($|[^a-z0-9])' AS p" for r in WORDS)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH places(rule, verdict) AS (VALUES {places}), words AS ({words}),
parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
known AS (
  SELECT page_id, coalesce(rest, '') AS rest, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), '{upper}', '{lower}') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
ruled AS (
  SELECT *, (SELECT arg_max(rule, length(rule)) FROM places
     WHERE (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
       AND starts_with(path, substr(rule, instr(rule, '/')))) AS rule,
    (SELECT min(w) FROM words WHERE regexp_matches(translate(rest, '{upper}', '{lower}'), p)) AS pattern
  FROM known)
SELECT page_id, host, path, rule, coalesce((SELECT verdict FROM places p WHERE p.rule = ruled.rule), CASE WHEN pattern IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, pattern
FROM ruled"""
