"""URL filters: rules are found by their rarest literal token, and only those found run their expressions."""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverlay.llm.batches import map_batches
from coverlay.llm.literals import token_choices, tokens, whole_tokens

#: Most rules that one rule set may have; it travels to every task, so its size must be known.
MOST_RULES = 200_000


@dataclass(frozen=True)
class SiteRule:
    """``site`` is a host and the start of a path, like ``example.net/en/``; it fits the host and its subdomains."""

    site: str
    verdict: str

    def expression(self) -> str:
        host, slash, path = self.site.partition("/")
        return rf"(?:[^/]*\.)?{re.escape(host)}(?=/|\Z){re.escape(slash + path)}"

    def choices(self) -> list[list[set[str]]]:
        host, slash, path = self.site.partition("/")
        return [[t]] if (t := whole_tokens(f".{host}/") | whole_tokens(f"/{path}")) else []


@dataclass(frozen=True)
class PatternRule:
    """An expression searched in the whole url, as written."""

    pattern: str
    verdict: str

    def expression(self) -> str:
        return self.pattern

    def choices(self) -> list[list[set[str]]]:
        return token_choices(self.pattern)


# fixed values: the site rules
SITES = (
    SiteRule("net/", "block"),
    SiteRule("example.net/en/", "allow"),
    SiteRule("example.com/de/", "block"),
    SiteRule("org/fr/", "allow"),
)
#: What a crawl has no use for: session and tracking copies of pages, logins, print views, downloads, ad hosts.
PATTERNS = (
    PatternRule(r"[?&](?:sid|sessionid|phpsessid)=", "block"),
    PatternRule(r"[?&]utm_(?:source|medium|campaign)=", "block"),
    PatternRule(r"[?&]ref=[a-z]+(?:[&#]|$)", "block"),
    PatternRule(r"/(?:login|signin|register|wp-login\.php)(?:[/?#]|$)", "block"),
    PatternRule(r"/print/", "block"),
    PatternRule(r"\.(?:exe|zip|iso|apk)(?:[?#]|$)", "block"),
    PatternRule(r"://ads?[0-9]*\.", "block"),
    PatternRule(r"\bcasino\b", "block"),
    PatternRule(r"/robots\.txt$", "allow"),
)


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z as a-z; empty without ``://``."""
    raw = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def token_frequencies(urls: DataFrame, wanted: set[str], url_col: str = "url") -> dict[str, int]:
    """How many urls hold each wanted token. Only tokens of rules are counted, so as many numbers come back at most."""
    if not wanted:
        return {}
    found = F.array_intersect(F.split(F.lower(F.col(url_col)), "[^0-9a-z]+"), F.array(*[F.lit(t) for t in sorted(wanted)]))
    rows = urls.select(F.explode(found).alias("token")).groupBy("token").agg(F.count("*").alias("n")).collect()
    return {r.token: r.n for r in rows}


class RuleIndex:
    """Rules under the token that fewest urls hold; rules without a mandatory whole token are candidates of every url."""

    def __init__(self, rules: list, frequency: dict[str, int]):
        self.compiled = [re.compile(r.expression()) for r in rules]
        self.by_token: dict[str, list[int]] = {}
        self.always: list[int] = []
        for i, rule in enumerate(rules):
            ways = [{min(alternative, key=lambda t: (frequency.get(t, 0), t)) for alternative in way} for way in rule.choices()]
            if not ways:
                self.always.append(i)
                continue
            for token in min(ways, key=lambda way: sum(frequency.get(t, 0) for t in way)):
                self.by_token.setdefault(token, []).append(i)

    def candidates(self, held: set[str]) -> list[int]:
        out = [i for t in held & self.by_token.keys() for i in self.by_token[t]] if len(held) < len(self.by_token) else [
            i for t, rules in self.by_token.items() if t in held for i in rules
        ]
        return sorted({*out, *self.always})


class Filter:
    """Verdicts of one rule set. The longest fitting site rule decides; else any pattern rule: allow before block;
    else allow."""

    def __init__(self, sites: tuple[SiteRule, ...], patterns: tuple[PatternRule, ...], frequency: dict[str, int]):
        self.sites, self.patterns = sites, patterns
        self.rules = [*sites, *patterns]
        self.index = RuleIndex(self.rules, frequency)

    def verdict(self, url: str | None, host: str, path: str) -> tuple[str | None, str | None, str]:
        """``(site rule, pattern, verdict)``."""
        site, best, hits = host + path, None, []
        for i in self.index.candidates(tokens(f"{url or ''} {site}")):
            if i < len(self.sites):
                if (best is None or len(self.rules[i].site) > len(best.site)) and self.index.compiled[i].match(site):
                    best = self.rules[i]
            elif best is None and url is not None and self.index.compiled[i].search(url):
                hits.append(self.rules[i])
        if best is not None:
            return best.site, None, best.verdict
        hit = next((h for h in hits if h.verdict == "allow"), hits[0] if hits else None)
        return (None, hit.pattern, hit.verdict) if hit else (None, None, "allow")


def apply(
    pages: DataFrame, sites: tuple[SiteRule, ...] = SITES, patterns: tuple[PatternRule, ...] = PATTERNS, id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """``<id_col>, host, path, rule, verdict, pattern``: one row per row of ``pages``.

    Token frequencies come from all urls; the indexed rules (``MOST_RULES`` at most) go to the tasks, and urls are
    judged where they are read. A null url, or one without ``://``, has an empty host and path and fits no site rule; a
    null url fits no pattern either and is allowed. Ties between site rules of one length go to the first. Repeated
    rows and null ids keep their rows; other columns are ignored; an empty table gives an empty result.
    """
    if len(sites) + len(patterns) > MOST_RULES:
        raise ValueError(f"{len(sites) + len(patterns)} rules; at most {MOST_RULES} can travel to every task")
    wanted = {t for r in (*sites, *patterns) for way in r.choices() for alternative in way for t in alternative}
    judge = Filter(tuple(sites), tuple(patterns), token_frequencies(pages, wanted, url_col))
    kind = pages.schema[id_col].dataType.simpleString()

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [judge.verdict(*r) for r in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True)]
        rule, pattern, verdict = (pa.array(c, pa.string()) for c in zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), rule, verdict, pattern], names=[id_col, "host", "path", "rule", "verdict", "pattern"])

    url = F.col(url_col)
    rows = pages.select(F.col(id_col), url.alias("_url"), F.coalesce(host(url), F.lit("")).alias("_host"), F.coalesce(path(url), F.lit("")).alias("_path"))
    return map_batches(rows, one, f"`{id_col}` {kind}, host string, path string, rule string, verdict string, pattern string")


def sql(sites: tuple[SiteRule, ...] = SITES, patterns: tuple[PatternRule, ...] = PATTERNS) -> str:
    """The same verdicts by trying every rule on every url, for DuckDB."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    fits, named = "", ""
    for r in sorted(sites, key=lambda r: -len(r.site)):  # stable: the first of equal length
        h, slash, p = r.site.partition("/")
        test = f"(host = {quote(h)} OR ends_with(host, {quote('.' + h)})) AND starts_with(path, {quote(slash + p)})"
        fits += f" WHEN {test} THEN {quote(r.site)}"
        named += f" WHEN rule = {quote(r.site)} THEN {quote(r.verdict)}"
    ordered = sorted(patterns, key=lambda r: r.verdict != "allow")
    hit = "".join(f" WHEN regexp_matches(url, {quote(r.pattern)}) THEN {quote(r.pattern)}" for r in ordered)
    then = "".join(f" WHEN pattern = {quote(r.pattern)} THEN {quote(r.verdict)}" for r in ordered)
    return f"""WITH r AS (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
        s AS (SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
        t AS (SELECT *, CASE{fits} END AS rule FROM s),
        u AS (SELECT *, CASE WHEN rule IS NOT NULL THEN NULL{hit} END AS pattern FROM t)
        SELECT page_id, host, path, rule, CASE{named}{then} ELSE 'allow' END AS verdict, pattern FROM u"""
