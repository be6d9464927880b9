"""One query per operator over its whole tables, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codedframes.llm import (
    fingerprints, importance, line_dedup, mixing, packing, passages, search, simhash, suffix, token_counts, topk, toxicity, urls,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function name, with its SQL."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_fingerprints(spark, sf_dir):
    """Fingerprints of every document and of its edited text, and how alike they and the next document's are."""
    rows = fingerprints.edited_pairs(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"),
        fingerprints.encoded(F.col("sketch")).alias("fingerprint"), fingerprints.encoded(F.col("edited_sketch")).alias("edited_fingerprint"),
        fingerprints.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        fingerprints.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


#: Mixing in SQL. Sources are capped in order of cap / weight; `held` counts the capped ones.
MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number
  FROM sized GROUP BY source),
weighed AS (SELECT *, [5, 2, 1][number % 3 + 1] AS weight FROM sources),
sorted AS (
  SELECT *, row_number() OVER o AS place, 1.5::DOUBLE * sum(source_size) OVER () - 2 * coalesce(sum(source_size) OVER before, 0) AS rest,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weight_left
  FROM weighed WINDOW o AS (ORDER BY 2.0::DOUBLE * source_size / weight, number),
    before AS (ORDER BY 2.0::DOUBLE * source_size / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
held AS (SELECT min(place) AS place, arg_min(rest / weight_left, place) AS rate FROM sorted WHERE rest / weight_left * weight <= 2 * source_size),
targets AS (
  SELECT source, source_size, number,
         CASE WHEN sorted.place < held.place OR held.place IS NULL THEN 2.0::DOUBLE * source_size ELSE held.rate * weight END AS target,
         CAST('0x' || substr(md5('42:' || coalesce('=' || source, 'null')), 1, 13) AS BIGINT) / 16.0::DOUBLE ** 13 AS start
  FROM sorted, held),
numbered AS (
  SELECT doc_id, size, source_size, target, start, CASE WHEN source_size > 0 THEN least(2.0::DOUBLE, target / source_size) ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY number ORDER BY size, doc_id) - 1 AS rank
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor((rank + 1) * rate + start) - floor(rank * rate + start)) AS BIGINT) AS taken
FROM numbered
"""


@query(MIX_SQL)
def op2_mixing(spark, sf_dir):
    """All documents, mixed by source weights 5, 2, 1."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))


def _hits(terms) -> str:
    return " + ".join(f"CAST(regexp_matches(low, '(^|[^a-z0-9]){t}s?([^a-z0-9]|$)') AS INT)" for t in terms)


URL_SQL = f"""
WITH split AS (
  SELECT page_id, coalesce(url, '') AS url, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
         strpos(coalesce(url, ''), '://') AS mark FROM pages),
parts AS (
  SELECT page_id, low, CASE WHEN mark > 0 THEN regexp_extract(substr(low, mark + 3), '^[^/?#]*', 0) ELSE '' END AS host,
         CASE WHEN mark > 0 THEN regexp_extract(substr(url, mark + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM split),
judged AS (
  SELECT *, CASE
    {" ".join(f"WHEN ('.' || host) LIKE '%.{r.partition('/')[0]}' AND starts_with(path, '/{r.partition('/')[2]}') THEN '{r}'"
              for r, _ in sorted(RULES, key=lambda r: -len(r[0])))} END AS rule,
    {_hits(urls.STRICT)} AS strict_hits, {_hits(urls.SOFT)} AS soft_hits
  FROM parts)
SELECT page_id, host, path, rule,
       CASE {" ".join(f"WHEN rule = '{r}' THEN '{v}'" for r, v in RULES)}
            WHEN strict_hits > 0 OR soft_hits >= {urls.LIMIT} THEN 'block' ELSE 'allow' END AS verdict,
       CAST(strict_hits AS INT) AS strict_hits, CAST(soft_hits AS INT) AS soft_hits
FROM judged
"""


@query(URL_SQL)
def op3_url_filter(spark, sf_dir):
    """Every page's address, judged by the rules, else by the vocabulary."""
    return urls.judge(table(spark, sf_dir, "pages"), RULES)


@query()
def op4_simhash(spark, sf_dir):
    """Fingerprints of three-word shingles and their classes at three or fewer differing bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


@query()
def op5_packing(spark, sf_dir):
    """All documents as token pieces, packed into sequences of 1024."""
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents")))


TOPK_SQL = """
WITH v AS (
  SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
"""


@query(TOPK_SQL)
def op6_topk(spark, sf_dir):
    """The 20 best inner products of every 20th vector among all others."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=20, every=20, scale=64)


@query()
def op7_toxicity(spark, sf_dir):
    """Severity of every document by a model fitted on the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query()
def op8_line_dedup(spark, sf_dir):
    """All documents without the lines that repeat another, at one edit or none."""
    rows = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_removed", "removed", F.sha2("text", 256).alias("kept_sha256"))


@query()
def op9_passages(spark, sf_dir):
    """Classes of all documents that share a near-duplicate passage of 50 words or more."""
    rows = passages.repeated_passages(table(spark, sf_dir, "documents"))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["first"], s["last"])), " ")
    return rows.select("doc_id", "class_id", "copies", "n_links", spans.alias("spans"))


@query()
def op10_suffix(spark, sf_dir):
    """All documents without the strings of 200 bytes that are there more than once."""
    rows = suffix.remove_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op11_importance(spark, sf_dir):
    """A quarter of all documents of 20 words or more, drawn towards the distribution of the benchmark's n-grams."""
    rows = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=25, min_words=20, seed=7)
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


TERMS_SQL = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
SEARCH_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {TERMS_SQL} AS terms FROM documents),
sized AS (SELECT r, doc_id, len(terms) AS n FROM d WHERE len(terms) > 0),
whole AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sized),
postings AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY ALL),
asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({TERMS_SQL}) AS term FROM benchmark) GROUP BY ALL),
weighed AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM postings, whole GROUP BY term, n_docs),
scored AS (
  SELECT item_id, doc_id, r,
         CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN weighed USING (term) JOIN postings USING (term) JOIN sized USING (r), whole GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20
"""


@query(SEARCH_SQL)
def op12_search(spark, sf_dir):
    """The 20 best of all documents for each item of the benchmark."""
    return search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


@query()
def op13_token_counts(spark, sf_dir):
    """Bytes and tokens of every document."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), limit=2048)
