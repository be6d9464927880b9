"""Toxicity by cumulative-link ordinal regression on sparse text features."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codedframes.llm.common import saved

#: Limits of the fit: labelled rows (those of the smallest id hashes) and features (those that tell the grades apart
#: best). All else covers all rows.
SAMPLE_ROWS, MAX_FEATURES = 20_000, 4_000
#: A feature is used from this z value of its share among toxic texts against its share among others.
LEAST_Z = 3.0
#: A text is rejected from this probability of any grade above 0.
THRESHOLD = 0.4
PREFIXES = (4, 5, 6, 7)
TOKEN = re.compile(r"\w+")
GRADES = ("clean", "toxic", "toxic and of low quality")


def features(text: str | None) -> set[str]:
    """Presence features of a whole text: its lower-case words, and their beginnings (with a dash) for rare forms."""
    words = set(TOKEN.findall((text or "").lower()))
    return words | {f"{w[:n]}-" for w in words for n in PREFIXES if len(w) > n}


@dataclass(frozen=True)
class OrdinalModel:
    """P(grade <= j) = logistic(cuts[j] - weights . features): one weight per feature for all cuts."""

    weights: dict[str, float]
    cuts: tuple[float, ...]

    def score(self, text: str | None) -> tuple[float, float, int]:
        """Expected grade, probability of a grade above 0, and the most probable grade."""
        s = sum(self.weights.get(x, 0.0) for x in features(text))
        at_most = 1 / (1 + np.exp(np.clip(s - np.array(self.cuts), -60, 60)))
        each = np.diff(at_most, prepend=0.0, append=1.0)
        return float((1 - at_most).sum()), float(1 - at_most[0]), int(each.argmax())


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, n_features: int, n_grades: int, ridge=0.5, steps=400, rate=0.1):
    """Weights and cuts of the cumulative-link model by gradient steps (Adam) on the penalised likelihood.

    `rows` has the feature numbers of each text. The cuts are kept in order as a first cut and positive gaps.
    """
    count = np.array([len(r) for r in rows])
    at, col = np.repeat(np.arange(len(rows)), count), np.concatenate([*rows, np.zeros(0, int)]).astype(int)
    share = np.cumsum(np.bincount(grades, minlength=n_grades))[:-1] / max(1, len(grades))
    start = np.log((share + 1e-3) / (1 - share + 1e-3))
    p = np.concatenate([np.zeros(n_features), start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    m, v = np.zeros_like(p), np.zeros_like(p)

    def logistic(x):
        return 1 / (1 + np.exp(-np.clip(x, -40, 40)))

    for step in range(1, steps + 1):
        w, cuts = p[:n_features], p[n_features] + np.concatenate([[0], np.cumsum(np.exp(p[n_features + 1:]))])
        s = np.bincount(at, weights=w[col], minlength=len(rows))
        edges = np.concatenate([[-np.inf], cuts, [np.inf]])
        high, low = logistic(edges[grades + 1] - s), logistic(edges[grades] - s)
        low[grades == 0] = 0
        high[grades == n_grades - 1] = 1
        prob = np.maximum(high - low, 1e-9)
        up, down = high * (1 - high) / prob, low * (1 - low) / prob
        g = np.zeros_like(p)
        g[:n_features] = np.bincount(col, weights=(up - down)[at], minlength=n_features) + ridge * w
        by_cut = np.zeros(n_grades + 1)
        np.add.at(by_cut, grades + 1, -up)
        np.add.at(by_cut, grades, down)
        by_cut = by_cut[1:n_grades]
        g[n_features] = by_cut.sum()
        g[n_features + 1:] = np.exp(p[n_features + 1:]) * np.cumsum(by_cut[::-1])[::-1][1:]
        g /= max(1, len(rows))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return p[:n_features], p[n_features] + np.concatenate([[0], np.cumsum(np.exp(p[n_features + 1:]))])


def labelled(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, text, grade) of the labelled rows with the smallest id hashes, at most `sample_rows` labels.

    Grades: 0 without the toxic flag, 1 with it, 2 if the quality flag says low as well; a null toxic flag is no label.
    The chosen ids have that bound, so they are broadcast, and texts stay where they are.
    """
    chosen = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .select("doc_id", F.expr("CASE WHEN toxic = 0 THEN 0 WHEN quality = 0 THEN 2 ELSE 1 END").alias("grade"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(sample_rows)
    )
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "grade")


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, max_features: int = MAX_FEATURES) -> OrdinalModel:
    """Fit on a bounded sample of labelled rows. Without labels of two kinds the model calls every text clean."""

    def parts(batches):
        for batch in batches:
            found = [sorted(features(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.string())), batch.column(2).cast(pa.int32())], ["features", "grade"]
            )

    sample = saved(labelled(docs, labels, sample_rows).mapInArrow(parts, "features array<string>, grade int"))
    total, toxic = sample.agg(F.count("*"), F.coalesce(F.sum(F.expr("int(grade > 0)")), F.lit(0))).first()
    if toxic in (0, total):
        return OrdinalModel({}, (30.0, 60.0) if toxic == 0 else (-30.0, 30.0))
    in_toxic, in_clean = F.sum(F.expr("int(grade > 0)")), F.sum(F.expr("int(grade = 0)"))
    told = (
        sample.select(F.explode("features").alias("feature"), "grade").groupBy("feature")
        .agg(in_toxic.alias("t"), in_clean.alias("c")).where("t + c >= 3")
        .withColumn("z", F.expr(f"(t / {toxic} - c / {total - toxic}) / sqrt((t + c) / {total} * (1 - (t + c - 1) / {total}) "
                                f"* (1 / {toxic} + 1 / {total - toxic}))"))
        .where(f"z >= {LEAST_Z}").orderBy(F.desc("z"), "feature").limit(max_features)
    )
    names = [r["feature"] for r in told.select("feature").collect()]
    if not names:
        return OrdinalModel({}, (30.0, 60.0))
    chosen = sample.select(F.array_intersect("features", F.lit(names)).alias("features"), "grade")
    number = {x: i for i, x in enumerate(names)}
    rows, grades = [], []
    for r in chosen.toLocalIterator():
        rows.append(np.array([number[x] for x in r["features"]], dtype=np.int32))
        grades.append(r["grade"])
    weights, cuts = fit_ordinal(rows, np.array(grades), len(names), len(GRADES))
    return OrdinalModel({x: float(w) for x, w in zip(names, weights, strict=True)}, tuple(map(float, cuts)))


def score(docs: DataFrame, model: OrdinalModel, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, severity, p_toxic, grade, rejected) of each row of `docs` (doc_id, text), whole texts.

    severity is the expected grade (0 to 2). A row is rejected if its probability of any grade above 0 reaches the
    threshold. A null or empty text has no features and gets the base rate; a null doc_id stays null; repeated rows get
    equal scores; other columns are not read. An empty table gives no rows.
    """

    def rate(batches):
        for batch in batches:
            found = [model.score(t) for t in batch.column(1).to_pylist()]
            severity, p, grade = (list(x) for x in zip(*found, strict=True)) if found else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(severity, pa.float64()), pa.array(p, pa.float64()), pa.array(grade, pa.int32()),
                 pa.array([x >= threshold for x in p], pa.bool_())],
                ["doc_id", "severity", "p_toxic", "grade", "rejected"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        rate, "doc_id long, severity double, p_toxic double, grade int, rejected boolean"
    )


def accepted(docs: DataFrame, model: OrdinalModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs`, all columns, that `score` doesn't reject; rows are judged where they are."""
    at = docs.columns.index("text")

    def keep(batches):
        for batch in batches:
            yield batch.filter(pa.array([model.score(t)[1] < threshold for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
