"""SimHash near-duplicates by a self-join of the binary trie of fingerprints."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codedframes.llm.common import local_components, saved
from codedframes.llm.components import components

#: A part of the trie that one task joins with another holds at most n / PARTS fingerprints, within these limits.
PARTS, PART_LEAST, PART_MOST = 32, 64, 500_000
#: Node pairs with so few pairs of fingerprints are compared at once; so many node pairs are expanded together.
SMALL, CHUNK = 32, 1 << 18


def simhash(text: bytes | None, shingle: int, seed: int = 42) -> int:
    """64-bit SimHash: a bit is 1 if it is set in over half of the shingles' XXH64 values; no words give 0."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter(
        (xxhash.xxh64_intdigest(b" ".join(words[i:i + shingle]), seed) for i in range(n)), dtype="<u8", count=n
    )
    ones = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fingerprint long) of every row of `docs` (doc_id, text), whole texts; a null text counts as empty."""

    def prints(batches):
        for batch in batches:
            values = np.array([simhash(t, shingle) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")).mapInArrow(
        prints, "doc_id long, fingerprint long"
    )


def near_pairs(left: np.ndarray, right: np.ndarray, budget: int):
    """Index arrays (i, j), chunk by chunk, of the pairs of two sorted uint64 arrays that differ in at most `budget` bits.

    The binary tries of both arrays are traversed together. A node is a range of the sorted array; a pair of nodes
    carries the number of bits in which its prefixes differ and goes when that exceeds the budget. If both are the same
    array, each pair comes once, i < j. A full chunk is split in halves and put back, so memory stays bounded.
    """
    same = left is right
    sums: dict[tuple[int, int], np.ndarray] = {}

    def halves(side: int, values: np.ndarray, low, high, depth: int):
        if (side, depth) not in sums:
            bit = (values >> np.uint64(63 - depth)) & np.uint64(1)
            sums[side, depth] = np.concatenate(([0], np.cumsum(bit, dtype=np.int32)))
        ones = sums[side, depth]
        middle = high - (ones[high] - ones[low])
        return (low, middle), (middle, high)

    one = np.zeros(1, dtype=np.int64)
    stack = [(0, one, one + len(left), one, one + len(right), one.astype(np.int8))]
    while stack:
        depth, l0, l1, r0, r1, differ = stack.pop()
        if len(l0) > CHUNK:
            half = len(l0) // 2
            stack += [(depth, *(x[:half] for x in (l0, l1, r0, r1, differ))), (depth, *(x[half:] for x in (l0, l1, r0, r1, differ)))]
            continue
        size = (l1 - l0) * (r1 - r0)
        small = (size <= SMALL) | (depth == 64)
        if small.any():
            count, width = size[small], (r1 - r0)[small]
            at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            width = np.repeat(width, count)
            i, j = np.repeat(l0[small], count) + at // width, np.repeat(r0[small], count) + at % width
            near = np.bitwise_count(left[i] ^ right[j]) <= budget
            if same:
                near &= i < j
            if near.any():
                yield i[near], j[near]
            l0, l1, r0, r1, differ = (x[~small] for x in (l0, l1, r0, r1, differ))
        if not len(l0):
            continue
        lefts, rights, found = halves(0, left, l0, l1, depth), halves(1 - same, right, r0, r1, depth), []
        for x, (a, b) in enumerate(lefts):
            for y, (c, d) in enumerate(rights):
                keep = (a < b) & (c < d) & (differ + (x != y) <= budget)
                if same:  # of two equal ranges, one order of the children is enough
                    keep &= (l0 != r0) | (x <= y)
                found.append([v[keep] for v in (a, b, c, d, differ + np.int8(x != y))])
        stack.append((depth + 1, *(np.concatenate(v) for v in zip(*found, strict=True))))


def _prefix(depth: int):
    return F.expr(f"shiftrightunsigned(fingerprint, {64 - depth})") if depth else F.lit(0).cast("long")


def trie_cut(prints: DataFrame, bound: int) -> list[tuple[int, int]]:
    """Leaves (depth, prefix) of the trie of distinct fingerprints, each of at most `bound` of them, in their order.

    Counts are taken eight levels at a time, and further down only below nodes that are still too full: at most 256
    counts for each of n / bound nodes come to the driver.
    """
    spark, leaves, depth, full = prints.sparkSession, [], 0, {0}
    while full:
        below = prints
        if depth:
            nodes = spark.createDataFrame([(p if p < 1 << 63 else p - (1 << 64),) for p in full], "node long")
            below = prints.join(F.broadcast(nodes), _prefix(depth) == F.col("node"), "left_semi")
        counted = below.groupBy(_prefix(depth + 8).alias("prefix")).count().collect()
        counts = {depth + 8: {r["prefix"] & (1 << 64) - 1: r["count"] for r in counted}}
        for d in range(depth + 7, depth - 1, -1):
            counts[d] = {}
            for prefix, n in counts[d + 1].items():
                counts[d][prefix >> 1] = counts[d].get(prefix >> 1, 0) + n
        still = set()
        for d in range(depth, depth + 9):
            for prefix, n in counts[d].items():
                if n <= bound and (d == depth or counts[d - 1][prefix >> 1] > bound):
                    leaves.append((d, prefix))
                elif n > bound and d == depth + 8:
                    still.add(prefix)
        depth, full = depth + 8, still
    return sorted(leaves, key=lambda leaf: leaf[1] << (64 - leaf[0]))


def leaf_pairs(leaves: list[tuple[int, int]], budget: int) -> list[tuple[int, int]]:
    """Pairs of leaf numbers whose prefixes differ in at most `budget` bits: the top of the trie, joined with itself."""
    number = {leaf: i for i, leaf in enumerate(leaves)}
    inner = {(d, p >> (depth - d)) for depth, p in leaves for d in range(depth)}

    def below(node):
        return [n for n in ((node[0] + 1, 2 * node[1]), (node[0] + 1, 2 * node[1] + 1)) if n in inner or n in number]

    stack, found = [((0, 0), (0, 0), 0)] if leaves else [], []
    while stack:
        a, b, differ = stack.pop()
        if a in number and b in number:
            found.append((number[a], number[b]))
            continue
        for x in [a] if a in number else below(a):
            for y in [b] if b in number else below(b):
                if a == b and x > y:
                    continue
                both = x != a and y != b
                if differ + (both and (x[1] ^ y[1]) & 1) <= budget:
                    stack.append((x, y, differ + (both and (x[1] ^ y[1]) & 1)))
    return found


def near_edges(prints: DataFrame, max_bits: int = 3) -> DataFrame:
    """Edges (a, b) that connect distinct fingerprints exactly as all links of at most `max_bits` differing bits do.

    The trie is cut into leaves of bounded size; each pair of leaves that can hold links is one group of the shuffle.
    A group sends a tree for each of its components instead of all their pairs.
    """
    n = prints.count()
    leaves = trie_cut(prints, max(PART_LEAST, min(n // PARTS, PART_MOST)))
    pairs = np.array(leaf_pairs(leaves, max_bits), dtype=np.int64).reshape(-1, 2)
    starts = np.array([p << (64 - d) if d else 0 for d, p in leaves], dtype=np.uint64)
    ends = np.concatenate([pairs[:, 0], pairs[:, 1][pairs[:, 0] != pairs[:, 1]]])
    of_end = np.concatenate([np.arange(len(pairs)), np.flatnonzero(pairs[:, 0] != pairs[:, 1])])
    order = np.argsort(ends, kind="stable")
    ends, of_end = ends[order], of_end[order]
    first, last = (np.searchsorted(ends, np.arange(len(leaves)), side) for side in ("left", "right"))

    def deal(batches):
        for batch in batches:
            values = batch.column(0).to_numpy()
            for part in np.array_split(values, max(1, len(values) // 2000)):
                leaf = np.searchsorted(starts, part.view(np.uint64), "right") - 1
                count = (last - first)[leaf]
                at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first[leaf], count)
                yield pa.RecordBatch.from_arrays([pa.array(of_end[at]), pa.array(np.repeat(part, count))], ["pair", "fingerprint"])

    def join(key, group: pd.DataFrame) -> pd.DataFrame:
        values = np.sort(group["fingerprint"].to_numpy().view(np.uint64))
        a, b = pairs[key[0]]
        leaf = np.searchsorted(starts, values, "right") - 1
        left, right = np.flatnonzero(leaf == a), np.flatnonzero(leaf == b)
        sides = (values[left],) * 2 if a == b else (values[left], values[right])
        root = np.arange(len(values))
        for i, j in near_pairs(*sides, max_bits):
            root = local_components(len(values), left[i], right[j], root)
        linked = np.flatnonzero(root != np.arange(len(values)))
        return pd.DataFrame({"a": values[linked].view(np.int64), "b": values[root[linked]].view(np.int64)})

    dealt = prints.select("fingerprint").mapInArrow(deal, "pair long, fingerprint long")
    return dealt.groupBy("pair").applyInPandas(join, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """(doc_id, fingerprint long, component_id) of each row of `docs` (doc_id, text).

    Fingerprints link at `max_bits` or fewer differing bits; component_id is the smallest doc_id of all rows that links
    reach. Equal fingerprints are one node, however many rows share it. Rows with a null doc_id keep null there and take
    part like others; a component of such rows alone has a null component_id. Texts without words share fingerprint 0.
    Other columns of `docs` are not read. An empty table gives no rows.
    """
    rows = saved(fingerprints(docs, shingle))
    prints = saved(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")))
    roots = saved(components(near_edges(prints, max_bits)))
    rooted = prints.join(roots, prints.fingerprint == roots.node, "left").select(
        "fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root")
    )
    classes = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_print = saved(rooted.join(classes, "root").select("fingerprint", "component_id"))
    return rows.join(of_print, "fingerprint").select("doc_id", "fingerprint", "component_id")
