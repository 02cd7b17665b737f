"""A weighted URL vocabulary behind host and path rules.

An Aho-Corasick automaton finds all terms of the vocabulary in one pass over a URL. An occurrence counts when no ASCII
letter or digit touches it. One strict term, or several distinct soft ones, reject the URL. Rules come first: a rule
``host/path`` fits its host and every subdomain when the URL's path starts with the rule's; the longest decides.
Rules are looked up by the host's suffixes, so their number does not matter.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The vocabulary.
STRICT = ("casino", "cialis", "escort", "hentai", "malware", "phishing", "porn", "porno", "spam", "viagra", "warez", "xxx")
SOFT = (
    "ad", "ads", "adult", "affiliate", "banner", "bet", "betting", "bonus", "cheap", "click", "dating", "farm", "free", "loan",
    "nude", "pills", "poker", "popup", "prize", "promo", "redirect", "sex", "slots", "track", "tracker", "tracking", "win", "winner",
)
SOFT_NEEDED = 2
# The rules.
RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = str.maketrans(_UPPER, _LOWER)


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(_behind_scheme(url), r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_behind_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _behind_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


@lru_cache(maxsize=4)
def _automaton(strict: tuple, soft: tuple):
    import ahocorasick

    found = ahocorasick.Automaton()
    for kind, terms in (("soft", soft), ("strict", strict)):
        for term in terms:
            found.add_word(term, (kind, term))
    if len(found):
        found.make_automaton()
    return found


def _alnum(c: str) -> bool:
    return c.isascii() and c.isalnum()


def rejects(url: str | None, strict: tuple, soft: tuple, soft_needed: int) -> bool:
    """Whether the vocabulary rejects one URL; null and empty URLs are not rejected."""
    text, seen, automaton = (url or "").translate(_FOLD), set(), _automaton(strict, soft)
    if not len(automaton) or not text:
        return False
    for last, (kind, term) in automaton.iter(text):
        first = last - len(term) + 1
        if (first and _alnum(text[first - 1])) or (last + 1 < len(text) and _alnum(text[last + 1])):
            continue
        if kind == "strict":
            return True
        seen.add(term)
        if len(seen) >= soft_needed:
            return True
    return False


def longest_rule(host: str, path: str, by_host: dict[str, list[tuple[str, str]]]) -> str | None:
    """The longest rule that fits; ``by_host`` holds (path, rule) for each rule's host."""
    best, at = None, 0
    while at >= 0:
        for prefix, rule in by_host.get(host[at:], ()):
            if path.startswith(prefix) and (best is None or len(rule) > len(best)):
                best = rule
        dot = host.find(".", at)
        at = dot + 1 if dot >= 0 else -1
    return best


def judge_urls(
    pages: DataFrame, url_col: str = "url", rules: Sequence[tuple[str, str]] = RULES, strict: Sequence[str] = STRICT,
    soft: Sequence[str] = SOFT, soft_needed: int = SOFT_NEEDED,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (``allow`` or ``block``) added or replaced.

    A null URL has an empty host and path, no rule, and is allowed, as is one without ``://`` unless its terms reject it.
    Repeated rows are judged alike; an empty table stays empty.
    """
    strict, soft = tuple(strict), tuple(soft)
    verdicts = {rule: verdict for verdict, rule in rules}
    by_host: dict[str, list[tuple[str, str]]] = {}
    for rule in verdicts:
        host, slash, path = rule.partition("/")
        by_host.setdefault(host, []).append((slash + path, rule))

    @F.pandas_udf("rule string, verdict string")
    def judged(url: pd.Series, host: pd.Series, path: pd.Series) -> pd.DataFrame:
        out = []
        for u, h, p in zip(url, host, path):
            rule = longest_rule(h, p, by_host)
            out.append((rule, verdicts[rule] if rule else "block" if rejects(u, strict, soft, soft_needed) else "allow"))
        return pd.DataFrame(out, columns=["rule", "verdict"], dtype=object)

    url = F.col(url_col).cast("string")
    parts = pages.withColumns({"host": host_of(url), "path": path_of(url)})
    answer = parts.withColumn("__judged", judged(url, "host", "path"))
    return answer.withColumns({"rule": F.col("__judged.rule"), "verdict": F.col("__judged.verdict")}).drop("__judged")


def _ansi() -> str:
    edge, tail = "(^|[^a-z0-9])", "([^a-z0-9]|$)"
    hit = lambda term: f"regexp_matches(u, '{edge}{term}{tail}')"
    soft = " + ".join(f"CAST({hit(t)} AS INTEGER)" for t in SOFT)
    fits = []
    for _, rule in sorted(RULES, key=lambda r: -len(r[1])):
        host, slash, path = rule.partition("/")
        fits.append(f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{slash + path}') THEN '{rule}'")
    says = " ".join(f"WHEN '{rule}' THEN '{verdict}'" for verdict, rule in RULES)
    return f"""
WITH cut AS (SELECT page_id, translate(coalesce(url, ''), '{_UPPER}', '{_LOWER}') AS u,
                    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, u, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
ruled AS (SELECT *, CASE {" ".join(fits)} END AS rule FROM parts)
SELECT page_id, host, path, rule,
       CASE rule {says} ELSE CASE WHEN {" OR ".join(hit(t) for t in STRICT)} OR {soft} >= {SOFT_NEEDED}
                                  THEN 'block' ELSE 'allow' END END AS verdict
FROM ruled"""


ANSI = _ansi()
