"""URL filter: pattern rules indexed by their rarest literal token (operator 10).

Every rule is reduced to its literal tokens, i.e. runs of ASCII letters and digits that a
matching url must hold as whole tokens.  Token frequencies are counted over all urls, each
rule is filed under its rarest token, and a url's tokens fetch candidate rules by an equi
join.  Only the fetched candidates run their regular expression.  A rule without a literal
token is filed under the empty token, which every url holds, so no rule is lost.

Defined results: a null url or one without ``://`` has an empty host and path and gets the
default verdict; very long urls are matched whole; every input row gives one output row, also repeated rows and null ids;
extra columns are ignored; ties between rules of one length go to block, then to the
smaller rule text.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class HostRule:
    """Fits a host and its subdomains where the url's path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def pattern(self) -> str:
        return f"^(?:[^/]*\\.)?{_quote(self.host)}{_quote(self.path)}"

    @property
    def tokens(self) -> list[str]:
        # the end of a path prefix may lie inside a url token
        return _whole_tokens(f".{self.host}{self.path}*")


@dataclass(frozen=True)
class PatternRule:
    """A glob over host and path: ``*`` is any text; ``^`` is a delimiter or either end."""

    glob: str
    verdict: str

    @property
    def text(self) -> str:
        return self.glob

    @property
    def pattern(self) -> str:
        parts = {"*": ".*", "^": "(?:^|[^A-Za-z0-9]|$)"}
        return "(?s)" + "".join(parts.get(c) or _quote(c) for c in self.glob)

    @property
    def tokens(self) -> list[str]:
        return _whole_tokens(f"*{self.glob}*")


def _quote(text: str) -> str:
    return "".join(c if c.isalnum() or c in "_/" else "\\" + c for c in text)


def _whole_tokens(glob: str) -> list[str]:
    """Tokens with a literal delimiter on both sides, so that a match holds them whole."""
    out, i = [], 0
    while i < len(glob):
        j = i
        while j < len(glob) and glob[j].isascii() and glob[j].isalnum():
            j += 1
        if j > i:
            if i > 0 and glob[i - 1] != "*" and (j < len(glob) and glob[j] != "*"):
                out.append(glob[i:j])
            i = j
        else:
            i += 1
    return out


# The four host rules of the query's contract.
BASE_RULES = (
    HostRule("net", "/", "block"),
    HostRule("example.net", "/en/", "allow"),
    HostRule("example.com", "/de/", "block"),
    HostRule("org", "/fr/", "allow"),
)

# The filter list for urls that no host rule judges.
PATTERN_RULES = (
    PatternRule("^spam-farm.", "block"),
    PatternRule("^cheap-pills.", "block"),
    PatternRule(".casino^", "block"),
    PatternRule("^ads.", "block"),
    PatternRule("/login^", "block"),
    PatternRule("/tag/*/page/", "block"),
)


def _rule_table(spark: SparkSession, rules: Sequence, kind: str) -> DataFrame | None:
    if not rules:
        return None
    rows = [F.struct(F.lit(kind).alias("kind"), F.lit(r.text).alias("rule"),
                     F.lit(len(r.text)).alias("length"), F.lit(r.pattern).alias("pattern"),
                     F.lit(r.verdict).alias("verdict"),
                     F.array(*[F.lit(t) for t in r.tokens] or [F.lit("")]).alias("tokens"))
            for r in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, "^([^/?#]*)", 1)
    after = F.substr(rest, F.length(raw) + F.lit(1))
    return F.translate(raw, UPPER, LOWER), F.regexp_extract(after, "^([^?#]*)", 1)


def rule_bytes(rules: Sequence) -> int:
    """Bytes that a broadcast of the rules holds: texts, patterns, tokens, and a row's overhead."""
    return sum(100 + 2 * len(r.text) + 2 * len(r.pattern) + sum(50 + len(t) for t in r.tokens) for r in rules)


def rarest_token_index(urls: DataFrame, rules: DataFrame, small: bool) -> DataFrame:
    """``rules`` with ``token``: the one of its tokens that the fewest urls hold; ``small`` says that
    tables of the rules' size may be broadcast."""
    side = F.broadcast if small else (lambda df: df)
    wanted = rules.select(F.explode("tokens").alias("token")).distinct()
    held = (urls.select(F.explode("tokens").alias("token"))
            .join(side(wanted), "token", "left_semi")
            .groupBy("token").agg(F.count("*").alias("urls")))
    best = (rules.select("kind", "rule", F.explode("tokens").alias("token"))
            .join(side(held), "token", "left")
            .groupBy("kind", "rule")
            .agg(F.min(F.struct(F.coalesce("urls", F.lit(0)), "token"))["token"].alias("token")))
    return rules.drop("tokens").join(best, ["kind", "rule"])


def judge_urls(pages: DataFrame, host_rules: Sequence[HostRule] = BASE_RULES,
               pattern_rules: Sequence[PatternRule] = PATTERN_RULES,
               id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row per input row: id, host, path, rule, pattern, verdict.

    The longest fitting host rule gives the verdict; without one the longest fitting
    pattern rule does; without either it is ``default``.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col(url_col))
    urls = (pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
            .withColumn("row", F.monotonically_increasing_id())
            .withColumn("tokens", F.array_union(
                F.array_distinct(F.split(F.concat("host", "path"), "[^A-Za-z0-9]+")),
                F.array(F.lit("")))))
    tables = [t for t in (_rule_table(spark, host_rules, "host"),
                          _rule_table(spark, pattern_rules, "pattern")) if t is not None]
    if not tables:
        return urls.select(F.col("id").alias(id_col), "host", "path",
                           F.lit(None).cast("string").alias("rule"),
                           F.lit(None).cast("string").alias("pattern"), F.lit(default).alias("verdict"))
    rules = tables[0].unionByName(tables[1]) if len(tables) == 2 else tables[0]
    small = rule_bytes([*host_rules, *pattern_rules]) <= BROADCAST_BYTES
    index = rarest_token_index(urls, rules, small)
    if small:
        index = F.broadcast(index)
    fetched = (urls.withColumn("token", F.explode("tokens")).drop("tokens")
               .join(index.withColumnRenamed("pattern", "regex"), "token", "left")
               .withColumn("hit", F.when(F.expr("rlike(concat(host, path), regex)"),
                                         F.struct("length", (F.col("verdict") == "block").alias("b"),
                                                  F.expr("transform(split(rule, ''), c -> -ascii(c))")
                                                  .alias("order"), "rule", "verdict"))))
    best = fetched.groupBy("row").agg(
        F.first("id").alias("id"), F.first("host").alias("host"), F.first("path").alias("path"),
        F.max(F.when(F.col("kind") == "host", F.col("hit"))).alias("by_host"),
        F.max(F.when(F.col("kind") == "pattern", F.col("hit"))).alias("by_pattern"))
    return best.select(
        F.col("id").alias(id_col), "host", "path", F.col("by_host.rule").alias("rule"),
        F.when(F.col("by_host").isNull(), F.col("by_pattern.rule")).alias("pattern"),
        F.coalesce("by_host.verdict", "by_pattern.verdict", F.lit(default)).alias("verdict"))
