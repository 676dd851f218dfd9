"""URL verdicts from host and path rules and a weighted vocabulary.

One Aho-Corasick automaton finds all terms of the vocabulary in one pass over a URL,
lower-cased in A-Z. An occurrence counts when no letter or digit of ASCII touches it. A term
of the strict weight rejects by itself; softer terms reject together, each counted once,
when their weights reach ``STRICT``. Rules come first: the longest that fits decides.

Rules and vocabulary are parameters of the program, held in memory in every task.

Edge cases: a null URL, or one without ``://``, has an empty host and path, fits no rule and
keeps the vocabulary's verdict (allow for null). Rules of equal length: the longer host, then
the order given. Repeated rows and null ids are kept, each row by itself; an empty table
gives an empty result; only the id and the URL are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tierwatch.llm.registered import query, table


@dataclass(frozen=True)
class HostRule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (HostRule("block", "net"), HostRule("allow", "example.net", "/en/"), HostRule("block", "example.com", "/de/"),
         HostRule("allow", "org", "/fr/"))

STRICT = 2
#: Term to weight; STRICT rejects alone, 1 needs another soft term.
VOCABULARY: Mapping[str, int] = {
    "porn": 2, "xxx": 2, "hentai": 2, "camgirls": 2, "escorts": 2, "warez": 2, "phishing": 2,
    "adult": 1, "sex": 1, "nude": 1, "casino": 1, "betting": 1, "poker": 1, "viagra": 1, "torrent": 1, "crack": 1,
    "keygen": 1, "download": 1, "free": 1, "cheap": 1, "pills": 1, "dating": 1, "hot": 1, "loan": 1, "ads": 1,
}

HOST = r"^.*?://([^/?#]*)"
PATH = r"^.*?://[^/?#]*([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TO_LOWER = str.maketrans(_UPPER, _LOWER)
_JOINED = frozenset(_LOWER + "0123456789")
_SCHEMA = "page_id long, host string, path string, rule string, verdict string, n_strict long, n_soft long"


def parts(url: str | None) -> tuple[str, str]:
    """Host and path of a URL."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    until = min((rest.find(c) for c in "?#" if c in rest), default=len(rest))
    slash = rest.find("/", 0, until)
    cut = until if slash < 0 else slash
    return rest[:cut].translate(_TO_LOWER), rest[cut:until]


class RuleBook:
    """Rules by host, asked for every suffix of a host at a label border."""

    def __init__(self, rules: Sequence[HostRule]) -> None:
        self.by_host: dict[str, list[HostRule]] = {}
        for rule in sorted(rules, key=lambda r: (-len(r.name), -len(r.host))):
            self.by_host.setdefault(rule.host, []).append(rule)

    def longest(self, host: str, path: str) -> HostRule | None:
        best, suffix = None, host
        while suffix:
            for rule in self.by_host.get(suffix, ()):
                if path.startswith(rule.path):
                    if best is None or (len(rule.name), len(rule.host)) > (len(best.name), len(best.host)):
                        best = rule
                    break
            _, _, suffix = suffix.partition(".")
        return best


class Vocabulary:
    """Counts of distinct strict and soft terms of a URL."""

    def __init__(self, weights: Mapping[str, int]) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for term, weight in weights.items():
            self.automaton.add_word(term, (term, weight))
        if weights:
            self.automaton.make_automaton()
        self.empty = not weights

    def hits(self, url: str | None) -> dict[str, int]:
        text = (url or "").translate(_TO_LOWER)
        if self.empty or not text:
            return {}
        return {term: weight for end, (term, weight) in self.automaton.iter(text)
                if text[end + 1:end + 2] not in _JOINED and (end < len(term) or text[end - len(term)] not in _JOINED)}


def judge(pages: DataFrame, rules: Sequence[HostRule] = RULES, weights: Mapping[str, int] = VOCABULARY,
          id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Host, path, the rule that fits and the verdict of every URL, row by row."""
    rules, weights = tuple(rules), dict(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, vocabulary = RuleBook(rules), Vocabulary(weights)
        for batch in batches:
            columns: list[list] = [[], [], [], [], [], []]
            for url in batch.column(1).to_pylist():
                host, path = parts(url)
                rule, hits = book.longest(host, path), vocabulary.hits(url)
                verdict = rule.verdict if rule else "block" if sum(hits.values()) >= STRICT else "allow"
                strict = sum(w >= STRICT for w in hits.values())
                for column, value in zip(columns, (host, path, rule and rule.name, verdict, strict, len(hits) - strict)):
                    column.append(value)
            kinds = [pa.string()] * 4 + [pa.int64()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=["page_id", "host", "path", "rule", "verdict", "n_strict", "n_soft"])

    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url")).mapInArrow(run, _SCHEMA)


def _sql_hit(term: str) -> str:
    return f"regexp_matches(url, '(^|[^a-z0-9]){term}([^a-z0-9]|$)')::BIGINT"


_BY_LENGTH = sorted(RULES, key=lambda r: (-len(r.name), -len(r.host)))
_SQL_FITS = [f"WHEN (host = '{r.host}' OR host LIKE '%.{r.host}') AND starts_with(path, '{r.path}')" for r in _BY_LENGTH]
SQL = f"""WITH cut AS (
  SELECT page_id, translate(coalesce(url, ''), '{_UPPER}', '{_LOWER}') AS url,
         translate(regexp_extract(coalesce(url, ''), '{HOST}', 1, 's'), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '{PATH}', 1, 's') AS path FROM pages),
counted AS (
  SELECT *, {' + '.join(_sql_hit(t) for t, w in VOCABULARY.items() if w >= STRICT)} AS n_strict,
         {' + '.join(_sql_hit(t) for t, w in VOCABULARY.items() if w < STRICT)} AS n_soft FROM cut)
SELECT page_id, host, path,
       CASE {' '.join(f"{fits} THEN '{r.name}'" for fits, r in zip(_SQL_FITS, _BY_LENGTH))} END AS rule,
       CASE {' '.join(f"{fits} THEN '{r.verdict}'" for fits, r in zip(_SQL_FITS, _BY_LENGTH))}
            WHEN n_strict > 0 OR n_soft >= 2 THEN 'block' ELSE 'allow' END AS verdict, n_strict, n_soft
FROM counted"""


@query(SQL)
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))
