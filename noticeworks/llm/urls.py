"""URL filters: host and path rules, and pattern rules indexed by their rarest literal token.

Pattern rules are written as in common block lists: ``||`` begins at a host label, ``|`` at
the start or end, ``*`` is any text, ``^`` a separator or the end, and ``@@`` makes an
exception that allows. A literal token of a rule is a run of letters and digits that every
matching URL has as a whole token. Each rule is filed under the one that is rarest among the
tokens of all URLs; a URL's tokens fetch the rules filed there, and only those are run as
regular expressions. Rules without such a token are run for every URL.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeworks.llm.common import ascii_lower, expanded, table

#: Host rules of the query: (host and path, verdict).
HOST_RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))
#: Pattern rules of the query: list pages, sessions, advertisements and machine endpoints.
PATTERNS = (
    "^page=", "@@^page=1^", "^ref=", "^utm_source=", "^sessionid=", "/login^", "/cart^", "/search^", "/wp-admin/", "/ads/",
    "||ads.", "||track.", "||m.*^de/", "/feed|", "/print/*.html|", ".cgi?", ".php?", "@@/robots.txt|",
)
ANY = "*"
_SEPARATOR = r"(?:[^a-z0-9_.%-]|$)"
#: Rules up to this number are broadcast; more are joined by a shuffle.
MAX_BROADCAST_RULES = 100_000


@dataclass(frozen=True)
class PatternRule:
    pattern: str
    verdict: str
    regex: str
    tokens: tuple[str, ...]


def compile_rule(pattern: str) -> PatternRule:
    """The regular expression of a rule, over URLs in lower case, and its whole tokens."""
    verdict, body = ("allow", pattern[2:]) if pattern.startswith("@@") else ("block", pattern)
    body = body.lower()
    host, start, end = body.startswith("||"), body.startswith("|"), body.endswith("|")
    core = body[2 if host else 1 if start else 0 : len(body) - end]
    regex = "".join(".*" if c == "*" else _SEPARATOR if c == "^" else re.escape(c) for c in core)
    regex = (r"^[a-z][a-z0-9+.-]*://(?:[^/?#]*\.)?" if host else "^" if start else "") + regex + ("$" if end else "")
    tokens = []
    for m in re.finditer("[a-z0-9]+", core):
        before = core[m.start() - 1] if m.start() else "|" if host or start else "*"
        after = core[m.end()] if m.end() < len(core) else "|" if end else "*"
        if "*" not in (before, after):
            tokens.append(m[0])
    return PatternRule(pattern, verdict, regex, tuple(dict.fromkeys(tokens)))


def url_tokens(url: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(ascii_lower(url), F.lit("([a-z0-9]+)"), F.lit(1)))


def index_rules(urls: DataFrame, rules: list[PatternRule], url: str = "url") -> list[tuple[str, PatternRule]]:
    """Each rule under its token that the fewest URLs have; ties go to the longer one.

    All URLs are counted; what comes back is one count per token of the rules.
    """
    wanted = sorted({t for r in rules for t in r.tokens})
    counts: dict[str, int] = {}
    if wanted:
        of_rules = urls.sparkSession.createDataFrame([(t,) for t in wanted], "token string")
        if len(wanted) <= MAX_BROADCAST_RULES:
            of_rules = F.broadcast(of_rules)
        tokens = urls.select(F.explode(url_tokens(F.col(url))).alias("token")).join(of_rules, "token")
        counts = dict(tokens.groupBy("token").count().collect())
    return [(min(r.tokens, key=lambda t: (counts.get(t, 0), -len(t), t), default=ANY), r) for r in rules]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a null URL and for one without ``://``."""
    host = ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_rule(host: Column, path: Column, rules) -> Column:
    """The longest fitting rule, as a struct of rule and verdict; null if none fits.

    Host rules are a short configuration, evaluated within the row.
    """
    parts = [(text, *text.split("/", 1), verdict) for text, verdict in rules]
    listed = F.array(
        *(
            F.struct(F.lit(text).alias("rule"), F.lit(h).alias("host"), F.lit(f"/{p}").alias("path"), F.lit(verdict).alias("verdict"))
            for text, h, p, verdict in sorted(parts, key=lambda x: (-len(x[0]), x[0]))
        )
    )
    fits = F.filter(listed, lambda r: ((host == r["host"]) | host.endswith(F.concat(F.lit("."), r["host"]))) & path.startswith(r["path"]))
    return F.get(fits, F.lit(0))


def filter_urls(pages: DataFrame, host_rules=HOST_RULES, patterns=PATTERNS, page: str = "page_id", url: str = "url") -> DataFrame:
    """Every page's host, path, host rule, pattern and verdict (allow or block).

    The host rule decides where one fits, else the pattern rules: an exception before a block,
    and without a match the page is allowed. ``pattern`` is the pattern rule that would decide,
    the longest of its kind. Null URLs have no host and are allowed. Equal rows are judged
    alike and all returned. An empty table gives an empty result; other columns are ignored.
    A page's row and the patterns it matches are all that is shuffled, by page.
    """
    spark = pages.sparkSession
    urls = pages.select(F.col(page).alias("page_id"), F.col(url).alias("url"))
    index = [(token, r.pattern, r.verdict, r.regex, r.verdict == "allow", len(r.pattern)) for token, r in index_rules(urls, [compile_rule(p) for p in dict.fromkeys(patterns)])]
    rules = spark.createDataFrame(index, "token string, pattern string, decision string, regex string, exception boolean, size int")
    if len(index) <= MAX_BROADCAST_RULES:
        rules = F.broadcast(rules)
    tokens = F.concat(F.array(F.lit(ANY)), F.coalesce(url_tokens(F.col("url")), F.array().cast("array<string>")))
    met = urls.select("page_id", "url", F.explode(tokens).alias("token")).join(rules, "token").where(F.rlike(ascii_lower(F.col("url")), F.col("regex")))
    # each page has a row of its own, so that pages without a hit aren't lost
    own = urls.select("page_id", "url", F.lit(None).cast("struct<exception:boolean,size:int,pattern:string,decision:string>").alias("hit"))
    hits = met.select("page_id", "url", F.struct("exception", "size", "pattern", "decision").alias("hit"))
    judged = own.withColumn("n", F.lit(1)).unionByName(hits.withColumn("n", F.lit(0))).groupBy("page_id", "url").agg(F.sum("n").alias("n"), F.max("hit").alias("hit"))
    host, path = host_and_path(F.col("url"))
    done = expanded(judged, "n", "_copy").select("page_id", "url", "hit", host.alias("host"), path.alias("path"))
    fit = host_rule(F.col("host"), F.col("path"), host_rules)
    return done.withColumn("_fit", fit).select(
        "page_id",
        "host",
        "path",
        F.col("_fit.rule").alias("rule"),
        F.coalesce(F.col("_fit.verdict"), F.col("hit.decision"), F.lit("allow")).alias("verdict"),
        F.col("hit.pattern").alias("pattern"),
    )


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages under the query's host rules and patterns."""
    return filter_urls(table(spark, sf_dir, "pages"))


def _sql() -> str:
    rules = sorted(HOST_RULES, key=lambda x: -len(x[0]))
    fits = [(r, v, f"(host = '{r.split('/', 1)[0]}' OR ends_with(host, '.{r.split('/', 1)[0]}')) AND starts_with(path, '/{r.split('/', 1)[1]}')") for r, v in rules]
    compiled = sorted((compile_rule(p) for p in PATTERNS), key=lambda r: (r.verdict == "allow", len(r.pattern), r.pattern), reverse=True)
    hit = " ".join(f"WHEN regexp_matches(translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{r.regex}') THEN '{r.pattern}'" for r in compiled)
    verdicts = " ".join(f"WHEN pattern = '{r.pattern}' THEN '{r.verdict}'" for r in compiled)
    return f"""
WITH p AS (SELECT page_id, url,
   translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
   coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path, CASE {hit} END AS pattern FROM pages),
r AS (SELECT *, CASE {" ".join(f"WHEN {c} THEN '{r}'" for r, _, c in fits)} END AS rule FROM p)
SELECT page_id, host, path, rule, pattern,
   CASE {" ".join(f"WHEN rule = '{r}' THEN '{v}'" for r, v, _ in fits)} {verdicts} ELSE 'allow' END AS verdict FROM r"""


OP2_SQL = _sql()
