"""Filter URLs by pattern rules that are indexed by their rarest literal token.

A rule is a pattern over host and path. Each has literal tokens: whole words between separators that every
URL it fits must contain. One pass over all URLs counts those tokens; a rule is filed under the one the
corpus holds least often. A URL's own tokens fetch candidate rules from that index, and only those run
their regular expressions. The index is a literal inside the plan: it holds the rules, whose number is a
property of the rule list, never of the data.

Defined results: a NULL URL or one without ``://`` has an empty host and path; no rule fits it and the
verdict is ``allow``. Repeated rows give repeated results, an empty table none; URLs of any length are read whole.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataload.llm.tables import lower_ascii


@dataclass(frozen=True)
class Rule:
    """``host`` fits itself and its subdomains, ``path`` is a prefix; a pattern fits anywhere in host + path."""

    verdict: str
    host: str = ""
    path: str = "/"
    pattern: str = ""
    tokens: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return self.pattern or self.host + self.path

    @property
    def regex(self) -> str:
        if self.pattern:
            return self.pattern
        return r"\A(?:[^/]*\.)?" + re.escape(self.host) + re.escape(self.path)

    @property
    def literals(self) -> tuple[str, ...]:
        """Tokens that are complete in every URL the rule fits: all of the host's, and of the path's but an open last."""
        if self.pattern:
            return self.tokens
        path = re.split(r"[^a-z0-9-]+", self.path.lower())
        return tuple(t for t in [*self.host.split("."), *path[:-1]] if t)


# The rules that decide by the longest fit.
BASE_RULES = [
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
]

# Names of hosts or path segments that mark advertising, tracking, betting and link farms.
_HOST_WORDS = """
ads-track ad-track adserver adservice adsystem tracker tracking telemetry clickbank popunder banners doubleclick
spam-farm link-farm content-farm seo-links backlinks cheap-pills pills pharmacy-online viagra casino-win casino
poker-online free-bets betting slots jackpot lottery-win payday-loans quick-loans crypto-profit torrent warez
cracked-apps phishing login-verify account-verify adult xxx escorts
""".split()
_PATH_WORDS = "ads adclick adframe popup popunder affiliate redirect sponsored track pixel beacon".split()

METHOD_RULES = [
    *(
        Rule("block", pattern=r"\A(?:[^/]*\.)?" + re.escape(w) + r"(?:\.[^/]*)?(?:/|\z)", tokens=(w,))
        for w in _HOST_WORDS
    ),
    *(Rule("block", pattern=r"/" + w + r"(?:/|\z)", tokens=(w,)) for w in _PATH_WORDS),
]


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL."""
    host = lower_ascii(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1))
    path = F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def url_tokens(host: Column, path: Column) -> Column:
    return F.array_distinct(F.split(lower_ascii(F.concat_ws("/", host, path)), r"[^a-z0-9-]+", -1))


def token_counts(urls: DataFrame, rules: list[Rule]) -> dict[str, int]:
    """How many URLs hold each of the rules' literals; as many rows as the rules have literals."""
    wanted = sorted({t for r in rules for t in r.literals})
    tokens = urls.select(
        F.explode(F.array_intersect(url_tokens(F.col("host"), F.col("path")), F.array(*map(F.lit, wanted)))).alias("t")
    )
    return {row["t"]: row["n"] for row in tokens.groupBy("t").agg(F.count("*").alias("n")).collect()}


def rule_index(rules: list[Rule], counts: dict[str, int]) -> tuple[dict[str, list[Rule]], list[Rule]]:
    """Rules by rarest literal, and those without one, which every URL must try."""
    index: dict[str, list[Rule]] = {}
    rest = []
    for rule in rules:
        if rule.literals:
            index.setdefault(min(rule.literals, key=lambda t: (counts.get(t, 0), t)), []).append(rule)
        else:
            rest.append(rule)
    return index, rest


def _literal(rule: Rule, base: bool) -> Column:
    return F.struct(
        F.lit(base).alias("base"),
        F.lit(len(rule.name)).alias("length"),
        F.lit(rule.name).alias("name"),
        F.lit(rule.verdict).alias("verdict"),
        F.lit(rule.regex).alias("regex"),
    )


def judge_urls(pages: DataFrame, base: list[Rule] = BASE_RULES, method: list[Rule] = METHOD_RULES) -> DataFrame:
    """Every page as (page_id, host, path, rule, verdict, method_rule).

    The longest fitting base rule decides; without one, any fitting rule of the method blocks.
    """
    host, path = split_url(F.col("url"))
    urls = pages.select(F.col("page_id"), host.alias("host"), path.alias("path"))
    rules = base + method
    index, rest = rule_index(rules, token_counts(urls, rules))
    literals = {rule.name: _literal(rule, rule in base) for rule in rules}
    filed = F.array(
        *(
            F.struct(F.lit(t).alias("token"), F.array(*(literals[r.name] for r in found)).alias("rules"))
            for t, found in sorted(index.items())
        )
    )
    by_token = F.map_from_entries(filed)
    fetched = F.flatten(
        F.transform(
            F.array_intersect("tokens", F.map_keys(by_token)), lambda token: F.element_at(by_token, token)
        )
    )
    always = [literals[r.name] for r in rest]
    candidates = F.concat(fetched, F.array(*always)) if always else fetched
    target = F.concat("host", "path")
    fits = F.filter(candidates, lambda r: F.regexp_like(target, r["regex"]))
    nothing = F.array().cast("array<struct<base:boolean,length:int,name:string,verdict:string,regex:string>>")
    found = (
        urls.withColumn("tokens", url_tokens(F.col("host"), F.col("path")))
        .withColumn("fits", F.when(F.col("host") == "", nothing).otherwise(fits))
        .withColumn("best", F.try_element_at(F.sort_array(F.filter("fits", lambda r: r["base"]), False), F.lit(1)))
        .withColumn("other", F.try_element_at(F.sort_array(F.filter("fits", lambda r: ~r["base"]), False), F.lit(1)))
    )
    return found.select(
        "page_id",
        "host",
        "path",
        F.col("best.name").alias("rule"),
        F.coalesce("best.verdict", "other.verdict", F.lit("allow")).alias("verdict"),
        F.col("other.name").alias("method_rule"),
    )
