"""Exact top-k inner products by refining score histograms."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codedframes.llm.common import saved

#: Bins of a histogram round; vectors of a block of candidates and of queries.
BINS, BLOCK, QUERY_BLOCK = 256, 4096, 512
#: Scaled components, and products of two vectors' lengths, have to stay below this.
MOST = 1 << 61


def _blocks(vectors: DataFrame, scale: int, every: int) -> DataFrame:
    """Blocks (query, dim, ids, values, norm) of integer vectors: all of them, and the queries again in their own blocks."""

    def pack(batches):
        for batch in batches:
            kept: dict[int, list] = {}
            for i, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if i is None or not x.is_valid or x.values.null_count:
                    continue
                v = np.asarray(x.values.to_numpy(zero_copy_only=False), dtype=np.float64)
                if np.isfinite(v).all():
                    if np.abs(v).max(initial=0) * scale >= MOST:
                        raise ValueError(f"Vector {i}: a component times {scale} is {MOST:.3g} or more, so its scores don't fit 64 bits")
                    kept.setdefault(len(v), []).append((i, np.floor(scale * v)))
            for dim, rows in kept.items():
                for query in (False, True):
                    own = [r for r in rows if not query or r[0] % every == 0]
                    size = QUERY_BLOCK if query else BLOCK
                    for at in range(0, len(own), size):
                        ids = np.array([r[0] for r in own[at:at + size]], dtype=np.int64)
                        values = np.stack([r[1] for r in own[at:at + size]]).astype(np.int64)
                        yield pa.RecordBatch.from_pylist(
                            [{"query": query, "dim": dim, "task": TaskContext.get().partitionId(), "ids": ids.tobytes(),
                              "width": (w := _width(values)), "values": values.astype(f"<i{w}").tobytes(),
                              "norm": float(np.sqrt((values.astype(float) ** 2).sum(axis=1)).max())}], schema
                        )

    schema = pa.schema([("query", pa.bool_()), ("dim", pa.int32()), ("task", pa.int32()), ("ids", pa.binary()), ("width", pa.int32()),
                        ("values", pa.binary()), ("norm", pa.float64())])
    cells = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    return cells.mapInArrow(pack, "query boolean, dim int, task int, ids binary, width int, `values` binary, norm double")


def _width(values: np.ndarray) -> int:
    most = int(np.abs(values).max(initial=0))
    return next(w for w in (1, 2, 4, 8) if most < 1 << (8 * w - 1))


def _matrix(row: dict, side: str) -> tuple[np.ndarray, np.ndarray]:
    values = np.frombuffer(row[f"{side}_values"], f"<i{row[f'{side}_width']}")
    ids = np.frombuffer(row[f"{side}_ids"], np.int64)
    return ids, values.reshape(len(ids), row["dim"])


def _scores(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of queries and candidates, all their scores as exact whole numbers, and what is a query's own row."""
    (q_ids, q), (c_ids, c) = _matrix(row, "q"), _matrix(row, "c")
    most = row["dim"] * max(1, int(np.abs(q.astype(np.int64)).max(initial=0))) * max(1, int(np.abs(c.astype(np.int64)).max(initial=0)))
    kind = np.float32 if most < 1 << 23 else np.float64 if most < 1 << 52 else np.int64
    return q_ids, c_ids, q.astype(kind) @ c.astype(kind).T, q_ids[:, None] == c_ids[None, :]


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, scale: int = 64) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best candidates of each query among the rows of `vectors` (vec_id, embedding).

    A component x counts as floor(scale * x); queries are the rows whose id `every` divides, candidates all other rows
    (rows that repeat a query's id count as its own). Each round scores everything and counts, per query, the scores by
    bin in the range that holds the kth value; the counts of all blocks together pick the bin to be refined, until it is
    one value wide. A last pass sends what scores higher, and of the ties at the kth value the smallest ids, at most k
    per block: ties of any number are cut without being gathered.

    Null ids, and vectors that are null or have null or non-finite components take no part; empty vectors are candidates of
    each other, with score 0. Vectors so long that a score may not fit 64 bits are refused. Vectors of another length than
    the query's are no candidates. Queries with fewer than k candidates get all. An empty table gives no rows.
    Candidate blocks stay where they are; each query block goes to each of them once a pass.
    """
    blocks = saved(_blocks(vectors, scale, every))
    number = F.xxhash64("query", "dim", "task", "ids")  # the name of a block, whatever the run
    queries = saved(blocks.where("query").select(
        number.alias("q_block"), "dim", F.col("ids").alias("q_ids"), F.col("width").alias("q_width"),
        F.col("values").alias("q_values"), F.col("norm").alias("q_norm"),
    ))
    lanes = blocks.where("NOT query").select(
        number.alias("lane"), "dim", F.col("ids").alias("c_ids"), F.col("width").alias("c_width"), F.col("values").alias("c_values"), "norm"
    )
    names = [(r["lane"], r["dim"], r["norm"]) for r in lanes.select("lane", "dim", "norm").collect()]
    lanes, spark = lanes.drop("norm"), vectors.sparkSession
    most_norm = max((n for _, _, n in names), default=0.0)
    if (queries.agg(F.max("q_norm")).first()[0] or 0.0) * most_norm >= MOST:
        raise ValueError(f"Scores of vectors of length {most_norm:.3g} (times {scale}) don't fit 64 bits")
    of_dim = spark.createDataFrame([(lane, dim) for lane, dim, _ in names], "lane long, dim int")
    dealt = queries.drop("q_norm").join(of_dim, "dim")

    def pairs(state: DataFrame) -> DataFrame:
        return lanes.join(dealt.join(state, "q_block"), ["lane", "dim"])

    # In a round, scores from `low` up to `span` above it fall into bins `step` wide; `above` scores lie higher still.
    state = queries.select(
        "q_block", F.expr(f"CAST(ceil(q_norm * {most_norm!r}) AS long) + 1").alias("reach"), F.expr("length(q_ids) DIV 8").alias("n")
    ).select("q_block", F.expr("array_repeat(-reach, int(n))").alias("low"), F.expr("array_repeat(0L, int(n))").alias("above"),
             F.expr("2 * reach + 1").alias("span"))
    state = saved(state)
    span = state.agg(F.max("span")).first()[0] or 1

    def count(batches):
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, _, score, own = _scores(row)
                low, need = np.array(row["low"])[:, None], k - np.array(row["above"])
                over = score.astype(np.int64) - low
                bins = np.where(own | (over < 0) | (over >= row["span"]), BINS, over // step)
                counts = np.zeros((len(q_ids), BINS + 1), dtype=np.int64)
                for i in range(len(q_ids)):
                    counts[i] = np.bincount(bins[i], minlength=BINS + 1)
                counts = counts[:, :BINS]
                higher = counts[:, ::-1].cumsum(axis=1)[:, ::-1] - counts
                i, b = np.nonzero((counts > 0) & (higher < need[:, None]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(i), row["q_block"])), pa.array(i.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(counts[i, b])],
                    ["q_block", "at", "bin", "n"],
                )

    while True:
        step = -(-span // BINS)
        found = pairs(state).mapInArrow(count, "q_block long, at int, bin int, n long")
        totals = found.groupBy("q_block", "at", "bin").agg(F.sum("n").alias("n"))
        top = Window.partitionBy("q_block", "at").orderBy(F.desc("bin"))
        base = state.select("q_block", F.posexplode("above").alias("at", "before"), "low")
        base = base.withColumn("low", F.expr("low[at]"))
        sums = totals.withColumn("sum", F.sum("n").over(top)).join(base, ["q_block", "at"])
        hit = sums.where(f"before + sum >= {k} AND before + sum - n < {k}")
        # A query without k candidates takes all: its kth value is below every score.
        here = base.join(hit.select("q_block", "at", "bin", "n", "sum"), ["q_block", "at"], "left").select(
            "q_block", "at", F.expr(f"CASE WHEN bin IS NULL THEN low - 1 ELSE low + CAST(bin AS long) * {step} END").alias("low"),
            F.expr("CASE WHEN bin IS NULL THEN before ELSE before + sum - n END").alias("above"),
        )
        cells = F.sort_array(F.collect_list(F.struct("at", "low", "above")))
        nxt = here.groupBy("q_block").agg(cells.alias("cells")).select(
            "q_block", F.col("cells.low").alias("low"), F.col("cells.above").alias("above"),
            F.lit(step).cast("long").alias("span"),
        )
        state, span = saved(nxt), step
        if span == 1:
            break

    def select(batches):
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, c_ids, score, own = _scores(row)
                kth = np.array(row["low"])[:, None]
                score = score.astype(np.int64)
                i, j = np.nonzero((score > kth) & ~own)
                ti, tj = np.nonzero((score == kth) & ~own)
                order = np.lexsort((c_ids[tj], ti))
                ti, tj = ti[order], tj[order]
                first = np.arange(len(ti)) - np.searchsorted(ti, ti) < k
                i, j = np.concatenate([i, ti[first]]), np.concatenate([j, tj[first]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_ids[i]), pa.array(c_ids[j]), pa.array(score[i, j])], ["query_id", "vec_id", "score"]
                )

    best = pairs(state).mapInArrow(select, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
