"""URL filter: host and path rules over a weighted vocabulary.

The vocabulary is matched in the whole lower-cased (A-Z) URL by an
Aho-Corasick automaton. A hit counts only between boundaries: the characters
before and after it are not letters or digits (so ``bets`` does not hit
``alphabets``). One strict term rejects; ``soft_needed`` distinct soft terms
reject as well. Rules come first: a rule ``host/path`` fits its host and all
subdomains if the URL's path starts with the rule's; the longest rule wins.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; path: from there up to ``?``, ``#`` or the end. Defined cases: a
null URL or one without ``://`` has an empty host and path, and no rule; a
null URL has no hits and is allowed; repeated rows are judged alike; an empty
table gives no rows; input columns that clash with the added names get
underscores. The work is per row: no shuffle, and only the vocabulary and
the rules (both parameters) travel with the tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm.common import lower_ascii, table

STRICT = ("porn", "xxx", "casino", "viagra", "cialis", "escort", "adult", "hentai", "camgirls", "spam", "malware",
          "phishing", "warez")
SOFT = ("ads", "bet", "bets", "betting", "bonus", "cheap", "click", "crack", "dating", "deal", "farm", "free",
        "jackpot", "loan", "loans", "pharma", "pills", "poker", "promo", "sex", "slots", "torrent", "track", "tracker",
        "win")
SOFT_NEEDED = 2
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


def automaton(strict: tuple[str, ...], soft: tuple[str, ...]):
    import ahocorasick

    a = ahocorasick.Automaton()
    for kind, terms in (("soft", soft), ("strict", strict)):
        for t in terms:
            a.add_word(t.lower(), (kind, t.lower()))
    if len(a):
        a.make_automaton()
    return a


def vocabulary_hits(a, url: str) -> tuple[int, int]:
    """Strict hits, and distinct soft hits, between boundaries."""
    strict, soft, end = 0, set(), len(url) - 1
    for at, (kind, term) in a.iter(url):
        first = at - len(term) + 1
        if (first > 0 and url[first - 1].isalnum()) or (at < end and url[at + 1].isalnum()):
            continue
        if kind == "strict":
            strict += 1
        else:
            soft.add(term)
    return strict, len(soft)


def url_filter(pages: DataFrame, url_col: str = "url", rules: tuple[tuple[str, str], ...] = RULES,
               strict: tuple[str, ...] = STRICT, soft: tuple[str, ...] = SOFT,
               soft_needed: int = SOFT_NEEDED) -> DataFrame:
    """``pages`` plus ``host, path, rule, verdict, strict_hits, soft_hits``."""
    added = ("host", "path", "rule", "verdict", "strict_hits", "soft_hits")
    names = {c: c + "_" if c.lower() in added else c for c in pages.columns}
    df = pages.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    raw = F.col(f"`{names[url_col]}`")

    @F.pandas_udf("strict_hits int, soft_hits int")
    def hits(urls: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        a = automaton(strict, soft)  # once per task
        for batch in urls:
            found = [vocabulary_hits(a, u) if u and len(a) else (0, 0) for u in batch]
            yield pd.DataFrame(found, columns=["strict_hits", "soft_hits"], dtype="int32")

    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    has = raw.contains("://")
    df = (df.withColumn("host", F.when(has, lower_ascii(F.regexp_extract(raw, parts, 1))).otherwise(F.lit("")))
          .withColumn("path", F.when(has, F.regexp_extract(raw, parts, 2)).otherwise(F.lit("")))
          .withColumn("_h", hits(lower_ascii(raw))))
    fits = []
    for rule, verdict in sorted(rules, key=lambda r: -len(r[0])):  # the longest first
        host, _, path = rule.partition("/")
        here = (F.col("host") == host) | F.col("host").endswith("." + host)
        fits.append((here & F.col("path").startswith("/" + path), rule, verdict))
    by_rule, by_verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for cond, rule, verdict in reversed(fits):
        by_rule, by_verdict = F.when(cond, rule).otherwise(by_rule), F.when(cond, verdict).otherwise(by_verdict)
    reject = (F.col("_h.strict_hits") >= 1) | (F.col("_h.soft_hits") >= soft_needed)
    return (df.withColumn("rule", by_rule)
            .withColumn("verdict", F.coalesce(by_verdict, F.when(reject, "block").otherwise("allow")))
            .withColumns({"strict_hits": F.col("_h.strict_hits"), "soft_hits": F.col("_h.soft_hits")}).drop("_h"))


def op9_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter(pages).select("page_id", "host", "path", "rule", "verdict")


def _sql() -> str:
    hit = lambda t: f"regexp_matches(u, '(^|[^\\p{{L}}\\p{{N}}]){re.escape(t)}($|[^\\p{{L}}\\p{{N}}])')"
    strict = " or ".join(hit(t) for t in STRICT)
    soft = " + ".join(f"{hit(t)}::int" for t in SOFT)
    rules = sorted(RULES, key=lambda r: -len(r[0]))

    def case(which: int, default: str) -> str:
        whens = []
        for rule in rules:
            host, _, path = rule[0].partition("/")
            whens.append(f"when (host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '/{path}') "
                         f"then '{rule[which]}'")
        return "case " + " ".join(whens) + f" else {default} end"

    return f"""
with p as (select page_id, url, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as u,
                  coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path,
                  translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host from pages)
select page_id, host, path, {case(0, 'null')} as rule,
       {case(1, f"case when {strict} or ({soft}) >= {SOFT_NEEDED} then 'block' else 'allow' end")} as verdict
from p
"""


OP9_SQL = _sql()
