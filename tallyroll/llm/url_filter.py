"""URL filter by a weighted vocabulary: strict terms reject alone, soft terms only together.

One Aho-Corasick automaton holds all terms. A URL is scanned once; a hit counts only
if no letter or digit stands beside it. One strict term, or several distinct soft
terms, reject the URL. Explicit host and path rules come before the vocabulary.
"""

from __future__ import annotations

import functools

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyroll.llm.common import by_batch

#: One of these rejects a URL.
STRICT = ("casino", "porn", "spam-farm", "xxx")
#: So many distinct ones of these reject a URL.
SOFT = ("adult", "bet", "bonus", "cheap", "free", "win")
SOFT_LIMIT = 2
#: Rules for hosts with their subdomains and path prefixes; the longest that fits decides.
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_WORD = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): between the first :// and the next / ? # (A-Z in lower case), and from there to the next ? #."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    ends = [at for at in map(rest.find, "?#") if at >= 0]
    bare = rest[:min(ends)] if ends else rest
    host, slash, path = bare.partition("/")
    return host.translate(_LOWER), slash + path


def rule_for(host: str, path: str, rules: dict[str, str]) -> str | None:
    """The longest rule whose host is the URL's or a parent of it and whose path begins the URL's path."""
    best = None
    labels = host.split(".")
    for k in range(len(labels)):
        for rule in rules_by_host(tuple(rules)).get(".".join(labels[k:]), ()):
            if path.startswith(rule[rule.index("/"):]) and (best is None or (-len(rule), rule) < (-len(best), best)):
                best = rule
    return best


@functools.lru_cache(maxsize=8)
def rules_by_host(rules: tuple[str, ...]) -> dict[str, list[str]]:
    found: dict[str, list[str]] = {}
    for rule in rules:
        found.setdefault(rule.partition("/")[0], []).append(rule)
    return found


class Vocabulary:
    """Strict and soft terms in one automaton."""

    def __init__(self, strict: tuple[str, ...], soft: tuple[str, ...]):
        self.automaton = ahocorasick.Automaton()
        for terms, kind in ((soft, "soft"), (strict, "strict")):
            for term in terms:
                self.automaton.add_word(term.translate(_LOWER), (kind, term))
        self.automaton.make_automaton() if len(self.automaton) else None

    def hits(self, url: str | None) -> tuple[set[str], set[str]]:
        """The distinct strict and soft terms of a URL that stand alone."""
        found: dict[str, set[str]] = {"strict": set(), "soft": set()}
        if url and len(self.automaton):
            text = url.translate(_LOWER)
            for end, (kind, term) in self.automaton.iter(text):
                start = end - len(term) + 1
                if (start == 0 or text[start - 1] not in _WORD) and (end + 1 == len(text) or text[end + 1] not in _WORD):
                    found[kind].add(term)
        return found["strict"], found["soft"]


def judge_urls(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, strict: tuple[str, ...] = STRICT, soft: tuple[str, ...] = SOFT,
               soft_limit: int = SOFT_LIMIT, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per row: the id, host, path, rule (null if none fits), verdict (allow or block), n_strict, n_soft.

    The rule's verdict holds where one fits, else the vocabulary's: block at one strict
    term or `soft_limit` distinct soft terms. A null or empty URL, and one without ://,
    has an empty host and path, which no rule fits; the vocabulary judges its text, and
    finds nothing in a null. Null ids stay null, repeated rows are judged one by one,
    other columns are not read, an empty table gives an empty one.
    """
    verdicts = dict(rules)

    def make():
        vocabulary = Vocabulary(strict, soft)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for url in batch.column(1).to_pylist():
                host, path = split_url(url)
                rule = rule_for(host, path, verdicts)
                hard, mild = vocabulary.hits(url)
                rows.append((host, path, rule, verdicts[rule] if rule else "block" if hard or len(mild) >= soft_limit else "allow", len(hard), len(mild)))
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.string()) for c in columns[:4]), *(pa.array(c, pa.int32()) for c in columns[4:])], names=[id_col, "host", "path", "rule", "verdict", "n_strict", "n_soft"])
        return one

    rows = pages.select(id_col, url_col)
    return rows.mapInArrow(by_batch(make), f"`{id_col}` {rows.schema[0].dataType.simpleString()}, host string, path string, rule string, verdict string, n_strict int, n_soft int")
