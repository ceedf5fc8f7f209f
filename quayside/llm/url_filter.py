"""URL verdicts: host and path rules first, then a weighted vocabulary found by an Aho-Corasick automaton."""

from __future__ import annotations

import functools
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from quayside.session import ship_package

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rules stand in the plan itself; longer lists belong into a table and a join.
MAX_RULES = 200

#: One of these is enough.
STRICT_TERMS = ("casino", "escort", "malware", "phishing", "porn", "spam", "viagra", "xxx")
#: Weights of weaker terms; each term counts once.
SOFT_TERMS = {
    "adult": 2, "ads": 1, "bet": 1, "bets": 1, "bonus": 1, "cheap": 1, "click": 1, "dating": 1, "free": 1, "jackpot": 1,
    "loan": 1, "lottery": 1, "pills": 1, "poker": 1, "prize": 1, "sex": 1, "track": 1, "tracker": 1, "win": 1,
}
SOFT_LIMIT = 2
#: However much it weighs, one soft term alone never blocks.
SOFT_TERMS_LEAST = 2


@dataclass(frozen=True)
class Rule:
    """``host`` and all its subdomains, for paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Vocabulary:
    strict: Sequence[str] = STRICT_TERMS
    soft: Mapping[str, int] = field(default_factory=lambda: dict(SOFT_TERMS))
    limit: int = SOFT_LIMIT


def ascii_lower(value: Column) -> Column:
    return F.translate(value, _UPPER, _LOWER)


def with_host_and_path(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` and ``path``; both are empty for a null url or one without ``://``."""
    rest = F.coalesce(F.regexp_extract(F.col(url), r"(?s)^.*?://(.*)", 1), F.lit(""))
    return pages.withColumns(
        {
            "host": ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)),
            "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
        }
    )


def longest_rule(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """``struct(rule, verdict)`` of the longest rule that fits; null if none does."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} can stand in a plan")
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):  # later ones go on top
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


@functools.cache
def _automaton(terms: tuple[str, ...]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for term in terms:
        found.add_word(term, term)
    found.make_automaton()
    return found


def _plain(char: str) -> bool:
    return char.isascii() and char.isalnum()


def terms_in(text: str, terms: tuple[str, ...]) -> Iterator[str]:
    """Terms that stand in ``text`` with no ASCII letter or digit beside them, once each."""
    seen = set()
    for end, term in _automaton(terms).iter(text):
        start = end - len(term) + 1
        free = not (start and _plain(text[start - 1])) and not (end + 1 < len(text) and _plain(text[end + 1]))
        if free and term not in seen:
            seen.add(term)
            yield term


def judge_urls(pages: DataFrame, rules: Sequence[Rule], words: Vocabulary | None = None, key: str = "page_id", url: str = "url") -> DataFrame:
    """``key, host, path, rule, verdict, strict_hits, soft_hits, soft_weight``, one row per input row.

    A rule decides where one fits. Else the vocabulary does, over the whole url with A-Z lower-cased: block on one strict
    term, or on at least two distinct soft terms whose weights reach the limit. A null or empty url has no hits and is allowed; repeated
    rows are judged each, null keys stay, an empty table gives none, and other columns are ignored. Nothing is shuffled.
    """
    words = words or Vocabulary()
    ship_package(pages.sparkSession)
    terms = tuple(sorted({*words.strict, *words.soft}))
    if any(t != t.lower() or not t for t in terms):
        raise ValueError("terms are lower-case and not empty")
    strict, soft = frozenset(words.strict), dict(words.soft)

    @pandas_udf("strict_hits long, soft_hits long, soft_weight long")
    def hits(urls: pd.Series) -> pd.DataFrame:
        rows = []
        for text in urls:
            found = list(terms_in(text, terms))
            weak = [soft[t] for t in found if t in soft and t not in strict]
            rows.append((sum(t in strict for t in found), len(weak), sum(weak)))
        return pd.DataFrame(rows, columns=["strict_hits", "soft_hits", "soft_weight"], dtype="int64")

    known = with_host_and_path(pages.select(F.col(key), F.col(url).alias("url")), "url")
    judged = known.select(
        key, "host", "path", longest_rule(rules, F.col("host"), F.col("path")).alias("fit"), hits(ascii_lower(F.coalesce("url", F.lit("")))).alias("hits")
    )
    several = (F.col("hits.soft_hits") >= SOFT_TERMS_LEAST) & (F.col("hits.soft_weight") >= words.limit)
    bad = (F.col("hits.strict_hits") > 0) | several
    return judged.select(
        key,
        "host",
        "path",
        F.col("fit.rule").alias("rule"),
        F.coalesce(F.col("fit.verdict"), F.when(bad, "block").otherwise("allow")).alias("verdict"),
        "hits.strict_hits",
        "hits.soft_hits",
        "hits.soft_weight",
    )
