"""URL filters: pattern rules indexed by their rarest literal token; only fetched rules run regular expressions."""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tune

_TOKEN = re.compile(r"[a-z0-9]+")


@dataclass(frozen=True)
class UrlRule:
    """A pattern over host, NUL and path, with literal tokens that each match must hold.

    `site` rules are named and the longest name wins; other rules give the verdict where no site rule fits.
    """

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    site: bool = False


def site_rule(verdict: str, host: str, path: str = "/") -> UrlRule:
    """A rule for a host and all its subdomains whose paths start with path."""
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    # the last token of the path may go on in a URL, unless the rule's path ends it
    inner = [m[0] for m in _TOKEN.finditer(path.lower()) if m.end() < len(path)]
    return UrlRule(host + path, verdict, rf"(?:[^\0]*\.)?{re.escape(host)}\0{re.escape(path)}", (*_TOKEN.findall(host), *inner), True)


def word_rule(verdict: str, name: str, *words: str) -> UrlRule:
    """A rule for host labels that hold the words one after the other, joined by a hyphen or underscore."""
    return UrlRule(name, verdict, rf"[^\0]*(?<![a-z0-9]){'[-_]'.join(map(re.escape, words))}(?![a-z0-9])[^\0]*\0", tuple(words))


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path as the rules see them; both empty without "://"."""
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3 :]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return host.translate(_LOWER), path


_LOWER = {i: i + 32 for i in range(65, 91)}


def tokens_of(host: str, path: str) -> set[str]:
    return set(_TOKEN.findall(host)) | set(_TOKEN.findall(path.translate(_LOWER)))


def token_counts_of(pages: DataFrame, url_col: str, wanted: set[str]) -> dict[str, int]:
    """In how many URLs of the whole table each wanted token occurs; one number a token reaches the driver."""

    def run(batches):
        n: dict[str, int] = defaultdict(int)
        for b in batches:
            for url in b.column(0).to_pylist():
                for t in tokens_of(*split_url(url)) & wanted:
                    n[t] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["token", "n"])

    found = pages.select(F.col(url_col).cast("string").alias("url")).mapInArrow(run, "token string, n long")
    return {r.token: r.n for r in found.groupBy("token").agg(F.sum("n").alias("n")).collect()}


class RuleIndex:
    """Rules by their rarest token; rules without a token are candidates for every URL."""

    def __init__(self, rules: list[UrlRule], counts: dict[str, int]):
        self.by_token: dict[str, list] = defaultdict(list)
        self.always = []
        for r in rules:
            entry = (r, re.compile(r.pattern))
            if r.tokens:
                self.by_token[min(r.tokens, key=lambda t: (counts.get(t, 0), t))].append(entry)
            else:
                self.always.append(entry)

    def judge(self, host: str, path: str, default: str) -> tuple[str | None, str, str | None]:
        """(site rule, verdict, pattern rule)."""
        # NUL separates both; one inside a host counts as any other character
        subject = host.replace("\0", "\1") + "\0" + path
        fit = [r for r, p in self.always if p.match(subject)]
        for t in tokens_of(host, path):
            fit += [r for r, p in self.by_token.get(t, ()) if p.match(subject)]
        sites = [r for r in fit if r.site]
        if sites:
            best = max(sites, key=lambda r: (len(r.name), r.name))
            return best.name, best.verdict, None
        other = max((r for r in fit if not r.site), key=lambda r: (r.verdict == "block", r.name), default=None)
        return None, other.verdict if other else default, other.name if other else None


def site_rules(table: DataFrame, most: int = 1_000_000) -> list[UrlRule]:
    """Site rules of a table (verdict, host, path), null paths as "/"; rows without host or verdict are no rules.

    Rules are broadcast, so more than `most` different ones are an error.
    """
    rows = table.select(F.col("verdict").cast("string"), F.col("host").cast("string"), F.coalesce(F.col("path").cast("string"), F.lit("/")).alias("path"))
    found = rows.where("verdict is not null and host <> ''").distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} rules")
    return [site_rule(r.verdict, r.host, r.path) for r in sorted(found)]


#: Host words of spam, gambling and adult sites: the patterns that judge what no site rule fits.
DEFAULT_PATTERNS = [
    word_rule("block", "cheap pills", "cheap", "pills"),
    word_rule("block", "free bets", "free", "bets"),
    word_rule("block", "casino", "casino"),
    word_rule("block", "adult", "adult"),
    word_rule("block", "porn", "porn"),
    word_rule("block", "xxx", "xxx"),
    word_rule("block", "viagra", "viagra"),
    word_rule("block", "ad trackers", "ads", "track"),
]


def filter_urls(pages: DataFrame, rules: list[UrlRule], id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, pattern_rule.

    The host is what stands between the first "://" and "/", "?", "#" or the end, A-Z lower-cased; the path
    goes on from there to "?" or "#". A null URL, or one without "://", has both empty. The longest site rule
    that fits decides (ties: the greater name); without one a pattern rule, block before allow; else `default`.
    Each rule is looked up by the one of its tokens that the fewest URLs hold, and only rules so fetched run
    their pattern. Ids may be null or repeat; other columns are ignored; an empty table gives an empty table.
    The rule list is a parameter held by the driver, so its copies on the executors are no larger than it.
    """
    spark = pages.sparkSession
    tune(spark)
    counts = token_counts_of(pages, url_col, {t for r in rules for t in r.tokens})
    shared = spark.sparkContext.broadcast((rules, counts))

    def run(batches):
        index = RuleIndex(*shared.value)
        for b in batches:
            parts = [split_url(u) for u in b["url"].to_pylist()]
            seen = [index.judge(h, p, default) for h, p in parts]
            yield pa.RecordBatch.from_arrays(
                [b["page_id"], *(pa.array(c, pa.string()) for c in ([p[0] for p in parts], [p[1] for p in parts], [s[0] for s in seen], [s[1] for s in seen], [s[2] for s in seen]))], names=["page_id", "host", "path", "rule", "verdict", "pattern_rule"]
            )

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))
    return rows.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string, pattern_rule string")
