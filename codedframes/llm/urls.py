"""URL filters: domain rules, and a weighted vocabulary matched by an Aho-Corasick automaton."""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed words. One of these rejects an address.
STRICT = ("adult", "casino", "escort", "hentai", "malware", "porn", "porno", "sex", "spam", "viagra", "warez", "xxx")
#: Several different ones of these reject it.
SOFT = ("ads", "bet", "bonus", "cam", "cheap", "click", "crack", "credit", "dating", "deal", "farm", "free", "hot", "loan",
        "pharma", "pills", "poker", "prize", "torrent", "track", "win")
#: Different terms whose weights come to so much reject an address. A strict term weighs this alone, a soft one 1.
LIMIT = 2
VOCABULARY = {**dict.fromkeys(STRICT, LIMIT), **dict.fromkeys(SOFT, 1)}
#: Terms of a vocabulary that is given as a table; every task holds all of them.
MOST_TERMS = 100_000
LOWER = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}


def parts(url: str | None) -> tuple[str, str]:
    """Host (A-Z lowered) and path of an address; both are empty without `://`."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    stop = min((i for i in (rest.find("?", end), rest.find("#", end)) if i >= 0), default=len(rest))
    return rest[:end].translate(LOWER), rest[end:stop]


class Rules:
    """Rules (host/path, verdict). One fits its host and all subdomains if the path starts with its own; longest wins."""

    def __init__(self, rules):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for rule, verdict in rules:
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host, []).append((slash + path, rule, verdict))

    def best(self, host: str, path: str) -> tuple[str, str] | None:
        found = []
        while True:
            found += [(len(rule), rule, verdict) for start, rule, verdict in self.by_host.get(host, ()) if path.startswith(start)]
            _, dot, host = host.partition(".")
            if not dot:
                return max(found)[1:] if found else None


def vocabulary(table: DataFrame) -> dict[str, int]:
    """The weights of a table (term string, weight int): A-Z lowered, the largest of repeated terms; null or empty terms and null weights fall away.

    More than MOST_TERMS terms are refused, because every task holds all of them.
    """
    terms = table.select(F.translate("term", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("term"), F.col("weight").cast("int"))
    rows = terms.where("term <> '' AND weight IS NOT NULL").groupBy("term").agg(F.max("weight").alias("weight")).take(MOST_TERMS + 1)
    if len(rows) > MOST_TERMS:
        raise ValueError(f"The vocabulary has more than {MOST_TERMS} terms")
    return {r["term"]: r["weight"] for r in rows}


class Vocabulary:
    """Different terms, each itself or with a final s, that stand between characters other than a-z and 0-9."""

    def __init__(self, weights: dict[str, int], limit: int):
        self.weights, self.limit = weights, limit
        self.terms = ahocorasick.Automaton()
        for term in weights:
            self.terms.add_word(term, term)
        if weights:
            self.terms.make_automaton()

    def found(self, url: str | None) -> set[str]:
        text, found = (url or "").translate(LOWER), set()
        for end, term in self.terms.iter(text) if self.weights else ():
            stop = end + 1
            before = text[stop - len(term) - 1:stop - len(term)] if stop > len(term) else ""
            stop += text[stop:stop + 1] == "s"
            if not any(c.isascii() and c.isalnum() for c in (before, text[stop:stop + 1])):
                found.add(term)
        return found

    def count(self, url: str | None) -> tuple[int, int, bool]:
        """Strict terms, soft terms, and whether their weights reject the address."""
        weights = [self.weights[term] for term in self.found(url)]
        strict = sum(w >= self.limit for w in weights)
        return strict, len(weights) - strict, sum(weights) >= self.limit


def judge(pages: DataFrame, rules, weights: dict[str, int] = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """(page_id, host, path, rule, verdict, strict_hits, soft_hits) of each row of `pages` (page_id, url).

    The longest fitting rule decides; without one, different terms anywhere in the address block it if their weights
    (see `vocabulary`) come to `limit`. A strict term, which has that weight, does alone. A term also counts with a final
    s, but once in all. A null address has empty parts, no hits and is allowed; page_id may be null or repeat; other
    columns are not read. An empty table gives no rows.
    """

    def rows(batches):
        known, terms = Rules(rules), Vocabulary(weights, limit)
        for batch in batches:
            out = []
            for url in batch.column(1).to_pylist():
                host, path = parts(url)
                (*hits, blocked), rule = terms.count(url), known.best(host, path)
                out.append((host, path, *(rule or (None, "block" if blocked else "allow")), *hits))
            host, path, rule, verdict, a, b = (list(x) for x in zip(*out, strict=True)) if out else [[]] * 6
            text = [pa.array(x, pa.string()) for x in (host, path, rule, verdict)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *text, pa.array(a, pa.int32()), pa.array(b, pa.int32())],
                ["page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_hits"],
            )

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string")).mapInArrow(
        rows, "page_id long, host string, path string, rule string, verdict string, strict_hits int, soft_hits int"
    )
