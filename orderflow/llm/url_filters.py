"""Operator 4: URL filters by pattern rules that are indexed by their rarest literal token.

A rule names a host (it fits the host and all its subdomains) and a path prefix. Every whole label of its host and
every whole segment of its path is a literal token that a fitting URL must hold. How often each such token occurs is
counted over all URLs; a rule is filed under its rarest one. A URL's tokens then fetch the few rules that can fit, and
only those run their regular expression.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import by_row

_LOWER = {c: c + 32 for c in range(65, 91)}


@dataclass(frozen=True)
class UrlRule:
    """``pattern``: a further regular expression that must be found in the path."""

    verdict: str
    host: str
    path: str = "/"
    pattern: str | None = None

    @property
    def text(self) -> str:
        return self.host + self.path

    def tokens(self) -> list[str]:
        """Literal tokens of every fitting URL; the last piece of the path may be cut short, so it isn't one."""
        return [f"h:{x}" for x in self.host.split(".")] + [f"p:{x}" for x in self.path.split("/")[1:-1]]

    def regex(self) -> re.Pattern[str]:
        rest = f"(?=.*(?:{self.pattern}))" if self.pattern else ""
        return re.compile(rf"(?:[^/]*\.)?{re.escape(self.host)}(?=/|\Z){rest}{re.escape(self.path)}", re.S)


#: The rules of the registered query.
RULES = (
    UrlRule("allow", "com", "/"),
    UrlRule("block", "example.com", "/en/"),
    UrlRule("allow", "www.example.com", "/en/"),
    UrlRule("block", "net", "/es/"),
    UrlRule("block", "net", "/fr/"),
)


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty if ``url`` is null or has no ``://``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    rest = re.split(r"[?#]", rest, maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


def url_tokens(host: str, path: str) -> set[str]:
    return {f"h:{x}" for x in host.split(".")} | {f"p:{x}" for x in path.split("/")[1:]}


def token_counts(urls: DataFrame, url_col: str, rules: Iterable[UrlRule]) -> dict[str, int]:
    """In how many of all URLs each literal token of the rules occurs (a URL with a token twice counts twice)."""
    wanted = sorted({t for r in rules for t in r.tokens()})
    if not wanted:
        return {}
    rest = F.split(F.substring_index(F.substring_index(F.expr(
        f"substr(`{url_col}`, instr(`{url_col}`, '://') + 3)"), "?", 1), "#", 1), "/")
    host = F.transform(F.split(F.lower(F.get(rest, F.lit(0))), r"\."), lambda x: F.concat(F.lit("h:"), x))
    path = F.transform(F.slice(rest, 2, F.greatest(F.size(rest), F.lit(1))), lambda x: F.concat(F.lit("p:"), x))
    own = F.filter(F.concat(host, path), lambda t: t.isin(wanted))  # a task sends a count for each token of the rules, no more
    counted = urls.where(F.col(url_col).contains("://")).select(F.explode(own).alias("token")).groupBy("token").count()
    return dict.fromkeys(wanted, 0) | {r["token"]: r["count"] for r in counted.collect()}


class RuleIndex:
    """Rules by their rarest token; rules without a token are candidates of every URL."""

    def __init__(self, rules: Iterable[UrlRule], counts: dict[str, int]):
        self.by_token: dict[str, list[tuple[str, str, re.Pattern[str]]]] = {}
        self.always: list[tuple[str, str, re.Pattern[str]]] = []
        for r in rules:
            item = (r.text, r.verdict, r.regex())
            if r.tokens():
                self.by_token.setdefault(min(r.tokens(), key=lambda t: (counts.get(t, 0), t)), []).append(item)
            else:
                self.always.append(item)

    def judge(self, host: str, path: str) -> tuple[str, str] | None:
        """The longest fitting rule and its verdict; among equally long ones the first by text."""
        near = [r for t in url_tokens(host, path) for r in self.by_token.get(t, ())] + self.always
        fitting = [(-len(text), text, verdict) for text, verdict, regex in near if regex.match(host + path)]
        return min(fitting)[1:] if fitting else None


def filter_urls(pages: DataFrame, rules: Iterable[UrlRule] = RULES, id_col: str = "page_id", url_col: str = "url",
                default: str = "allow") -> DataFrame:
    """One row for each row of ``pages``: id, host, path, rule, verdict.

    A null url, or one without ``://``, has an empty host and path, so only a rule without tokens can fit it; without
    a fitting rule the rule is null and the verdict is ``default``. Ties go to the rule text that sorts first. Repeated
    rows are judged each; an empty table gives no rows; other columns are left out, whatever their names.
    """
    rules = tuple(rules)
    index = RuleIndex(rules, token_counts(pages, url_col, rules))

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for url in batch["url"]:
                host, path = split_url(url)
                rows.append((host, path, *(index.judge(host, path) or (None, default))))
            made = pd.DataFrame(rows, columns=["host", "path", "rule", "verdict"], dtype=object)
            made.insert(0, "id", batch["id"])
            yield made

    return by_row(pages, judge, id_col, "host string, path string, rule string, verdict string", url=url_col)
