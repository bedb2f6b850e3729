"""URL filters: pattern rules found through their rarest literal token. DataFrame functions only.

Each rule is a regular expression over `host` + `path` and lists the literal tokens any matching URL must hold.
The rule is filed under the one that the fewest URLs hold. A URL's tokens fetch the rules filed under them, and
only those run their expression. Rules without a literal are filed under the empty token, which every URL has.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import ascii_lower


@dataclass(frozen=True)
class Rule:
    """`name` is reported; of several matching rules the one with the highest `rank` wins, then the least name."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    rank: int


def tokens_of(literal: str) -> tuple[str, ...]:
    """The parts of a literal that a URL with it holds as whole tokens, which end at other characters.

    The last part may go on in the URL unless the literal ends with a character that ends tokens."""
    whole = literal if not literal or not re.match(r"[a-z0-9]", literal[-1]) else re.sub(r"[a-z0-9]+$", "", literal)
    return tuple(dict.fromkeys(t for t in re.split(r"[^a-z0-9]+", whole) if t))


def host_path_rule(rule: str, verdict: str) -> Rule:
    """`example.net/en/` fits the host and all its subdomains where the path starts with `/en/`. The longest wins.

    Only the host's tokens are filed: a path is compared as it is, and tokens are in lower case."""
    host, slash, path = rule.partition("/")
    host = host.lower()
    pattern = rf"^(?:[^/?#]*\.)?{re.escape(host)}{re.escape(slash + path)}"
    literal = f"{host}/{path}" if path == path.lower() else f"{host}/"
    return Rule(rule, verdict, pattern, tokens_of(literal), 1_000 + len(rule))


def spam_rule(name: str, words: str) -> Rule:
    """Blocks hosts that hold `words` (joined by hyphens) between dots or hyphens. Ranks below host and path rules."""
    return Rule(name, "block", rf"^(?:[^/]*[.-])?{re.escape(words)}(?:[.-][^/]*)?(?:/|$)", tokens_of(words + "."), len(words))


#: The filter's own rules, where no host and path rule fits. Fixed values.
SPAM = [
    spam_rule(f"spam:{words}", words)
    for words in ("spam-farm", "cheap-pills", "casino", "free-money", "replica-watches", "payday-loans", "adult-chat", "link-farm")
]


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; empty without `://`."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def url_tokens(host: Column, path: Column) -> Column:
    """The distinct lower-case tokens of a URL, and the empty one."""
    return F.array_distinct(F.concat(F.array(F.lit("")), F.split(ascii_lower(F.concat_ws("/", host, path)), r"[^a-z0-9]+")))


def rule_index(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """`rules` (name, verdict, pattern, tokens, rank) filed under `token`, the one with the fewest rows in `tokens`.

    `tokens` has one row per URL and token. Counts combine before the shuffle, for the rules' own tokens only.
    """
    own = rules.select("name", F.explode(F.when(F.size("tokens") > 0, F.col("tokens")).otherwise(F.array(F.lit("")))).alias("token"))
    wanted = own.select("token").distinct()
    counts = tokens.join(wanted, "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarest = own.join(counts, "token", "left").groupBy("name").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("best"))
    return rules.join(rarest.select("name", F.col("best.token").alias("token")), "name")


def judge(
    urls: DataFrame, rules: list[Rule], id: str = "page_id", url: str = "url", default: str = "allow"
) -> DataFrame:
    """Per row of `urls`: id, `host`, `path`, `rule` (name of the winning rule or null) and `verdict`.

    A null URL, or one without `://`, has empty host and path, so no host rule fits. Rows that repeat are judged
    each by itself. Rule names must differ. Spark broadcasts the index if its size allows, otherwise it
    joins on the token and splits tokens that many URLs hold.
    """
    spark = urls.sparkSession
    if len({r.name for r in rules}) < len(rules):
        raise ValueError("rule names must differ")
    frame = spark.createDataFrame(
        [(r.name, r.verdict, r.pattern, list(r.tokens), r.rank) for r in rules],
        "name string, verdict string, pattern string, tokens array<string>, rank int")
    parts = urls.select(F.col(id).alias("id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    # Equal URLs are judged once, and those of one host and path are equal here.
    distinct = parts.select("host", "path").distinct()
    held = distinct.select("host", "path", F.explode(url_tokens(F.col("host"), F.col("path"))).alias("token"))
    index = rule_index(frame, held.select("token"))
    fits = held.join(index, "token").where(F.expr("concat(host, path) rlike pattern"))
    best = fits.groupBy("host", "path").agg(
        F.max_by(F.struct("name", "verdict"), F.struct("rank", F.expr("-length(name)").alias("l"), "name")).alias("best"))
    joined = parts.join(best, ["host", "path"], "left")
    return joined.select(
        F.col("id").alias(id), "host", "path", F.col("best.name").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
