"""URL filter by a weighted vocabulary (operator 5).

Host and path are cut out with SQL functions; host/path rules come first
(longest fitting rule wins). A url without a fitting rule is judged by its
vocabulary: one Aho-Corasick automaton over strict and soft terms runs over
the lower-cased url; a term counts only between boundaries (no ASCII letter or
digit on either side). One strict term, or ``SOFT_LIMIT`` distinct soft terms,
block; anything else is allowed. Matching is a plain map: no shuffle.

Nulls: a null url, or one without ``://``, has an empty host and path; a null
url has no term and is allowed.
"""

from __future__ import annotations

from collections.abc import Iterable

import ahocorasick
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# The vocabulary, lower case. Strict terms block alone, soft
# terms only together.
STRICT = (
    "porn", "porno", "xxx", "hentai", "camgirl", "camgirls", "escort", "escorts", "casino", "casinos",
    "viagra", "cialis", "warez", "keygen", "nulled", "malware", "phishing", "spam", "spammer",
)
SOFT = (
    "adult", "adults", "sex", "sexy", "nude", "bet", "bets", "betting", "poker", "slots", "jackpot",
    "gambling", "cheap", "discount", "pill", "pills", "pharmacy", "drugs", "free", "win", "winner",
    "prize", "bonus", "loan", "loans", "payday", "farm", "links", "seo", "crack", "torrent", "x",
)
SOFT_LIMIT = 2

# Fixed values: (verdict, host, path) rules of the query.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = _UPPER.lower()
_WORD = frozenset(_LOWER + "0123456789")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Iterable[tuple[str, str, str]] = RULES) -> Column:
    """Struct(rule, verdict) of the longest fitting rule; null if none fits."""
    by_length = sorted(rules, key=lambda r: (-len(r[1]) - len(r[2]), r))
    fits = [
        F.when(
            ((host == h) | host.endswith("." + h)) & path.startswith(p),
            F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")),
        )
        for v, h, p in by_length
    ]
    return F.coalesce(*fits)


def terms_found(strict: Iterable[str] = STRICT, soft: Iterable[str] = SOFT):
    """Arrow UDF: the distinct vocabulary terms of a lower-cased url, sorted."""
    words = sorted(set(strict) | set(soft))

    @F.arrow_udf(ArrayType(StringType()))
    def find(urls):
        import pyarrow as pa

        tree = _automaton(tuple(words))
        out = []
        for url in urls.to_pylist():
            hits = set()
            if url:
                for end, word in tree.iter(url):
                    start = end - len(word)
                    if (start < 0 or url[start] not in _WORD) and (end + 1 == len(url) or url[end + 1] not in _WORD):
                        hits.add(word)
            out.append(sorted(hits))
        return pa.array(out, pa.list_(pa.string()))

    return find


_TREES: dict[tuple[str, ...], ahocorasick.Automaton] = {}


def _automaton(words: tuple[str, ...]) -> ahocorasick.Automaton:
    """Built once per worker process; its size is that of the vocabulary."""
    if words not in _TREES:
        tree = ahocorasick.Automaton()
        for w in words:
            tree.add_word(w, w)
        tree.make_automaton()
        _TREES[words] = tree
    return _TREES[words]


def judge_urls(
    pages: DataFrame,
    rules: Iterable[tuple[str, str, str]] = RULES,
    strict: Iterable[str] = STRICT,
    soft: Iterable[str] = SOFT,
    soft_limit: int = SOFT_LIMIT,
) -> DataFrame:
    """``(page_id, host, path, rule, verdict, strict_hits, soft_hits)`` per row.

    Only ``page_id`` and ``url`` are read, so extra columns cannot clash;
    repeated rows are judged each.
    """
    strict, soft = sorted(set(strict)), sorted(set(soft) - set(strict))
    cut = pages.select(
        "page_id",
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        terms_found(strict, soft)(F.translate("url", _UPPER, _LOWER)).alias("terms"),
    )
    n_in = lambda words: F.size(F.array_intersect("terms", F.array(*map(F.lit, words)).cast("array<string>")))
    counted = cut.select(
        "page_id", "host", "path",
        longest_rule(F.col("host"), F.col("path"), rules).alias("fit"),
        n_in(strict).alias("strict_hits"),
        n_in(soft).alias("soft_hits"),
    )
    bad = (F.col("strict_hits") >= 1) | (F.col("soft_hits") >= soft_limit)
    return counted.select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", F.when(bad, "block").otherwise("allow")).alias("verdict"),
        "strict_hits", "soft_hits",
    )


def op5_url_vocabulary(spark, sf_dir):
    """Every page's url, judged."""
    from ticklake.llm.common import table

    return judge_urls(table(spark, sf_dir, "pages"))


def _sql() -> str:
    def hits(words):
        return " + ".join(
            f"regexp_matches(u, '(^|[^a-z0-9]){w}([^a-z0-9]|$)')::INT" for w in words
        )

    soft = [w for w in SOFT if w not in STRICT]
    rules = sorted(RULES, key=lambda r: -len(r[1]) - len(r[2]))
    fits = [(f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))", h + p, v) for v, h, p in rules]
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for c, r, _ in fits) + " END"
    verdict = "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for c, _, v in fits)
    return f"""
    WITH cut AS (
      SELECT page_id, coalesce(translate(url, '{_UPPER}', '{_LOWER}'), '') AS u,
        coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}'), '') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
      FROM pages),
    counted AS (SELECT *, {hits(STRICT)} AS strict_hits, {hits(soft)} AS soft_hits FROM cut)
    SELECT page_id, host, path, {rule} AS rule,
      {verdict} WHEN strict_hits >= 1 OR soft_hits >= {SOFT_LIMIT} THEN 'block' ELSE 'allow' END AS verdict,
      strict_hits, soft_hits
    FROM counted"""


ORACLE_SQL = _sql()
