"""Ranked lexical search: block-max MaxScore over shards of an inverted index."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codedframes.llm.common import byte_windows, drop_saved, saved

#: Postings of a block; documents and bytes of text of a shard at most (a longer text is a shard alone).
BLOCK, SHARD_DOCS, SHARD_BYTES = 128, 1 << 14, 16 << 20
#: Documents of a shard that are scored together; items searched in one pass; terms that an index may be limited to.
SPAN, ITEMS, TERMS = 4096, 1000, 200_000
WINDOW = 4 << 20

#: A-Z become a-z; other ASCII bytes than letters and digits become blanks.
LOWER = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
#: Stands for a null doc_id, behind all others.
NO_ID = (1 << 63) - 1

INDEX = "shard long, term string, df long, total long, heads binary, postings binary"
#: What a block's head has: its last document, its largest tf, its shortest document, and how its postings are packed.
HEAD = np.dtype([("last", "<i4"), ("tf", "<i4"), ("n", "<i4"), ("at", "<i4"), ("size", "<i2"), ("gap_bytes", "i1"), ("tf_bytes", "i1")])


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, window by window."""
    for window in byte_windows(text.translate(LOWER), WINDOW):
        yield window.split()


def _width(most: int) -> int:
    return 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4


def _packed(docs: np.ndarray, tf: np.ndarray, lengths: np.ndarray) -> tuple[bytes, bytes]:
    """Heads and postings of a list: per block, gaps between documents and counts, in as few bytes each as they need."""
    heads, out, at, before = np.zeros(-(-len(docs) // BLOCK), dtype=HEAD), [], 0, -1
    for b in range(len(heads)):
        part, counts = docs[b * BLOCK:(b + 1) * BLOCK], tf[b * BLOCK:(b + 1) * BLOCK]
        gaps = np.diff(part, prepend=before)
        before = int(part[-1])
        widths = _width(int(gaps.max())), _width(int(counts.max()))
        heads[b] = (before, counts.max(), lengths[part].min(), at, len(part), *widths)
        for x, width in zip((gaps, counts), widths):
            out.append(x.astype(f"<u{width}").tobytes())
            at += len(out[-1])
    return heads.tobytes(), b"".join(out)


def build(docs: DataFrame, terms: frozenset[bytes] | None = None) -> DataFrame:
    """The index of `docs` (doc_id, text), a row for each shard and term, in the shared folder; `terms` limits it to some.

    Shards are made where the rows lie, one after the other in a partition: documents are numbered within a shard, and a
    term's list is cut into blocks of 128 postings whose heads tell the block's last document, largest count and shortest
    document. Heads bound the score of a block for any corpus, so the index needs no statistics of the whole and shards can
    be added. The row of the empty term has the shard's documents: ids and lengths; `df` counts those with a term, `total`
    their terms.
    """

    def shards(batches):
        kept = None if terms is None else {t: i for i, t in enumerate(sorted(terms))}
        part, shard, texts, held = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                size = len(text or b"")
                if texts and (held + size > SHARD_BYTES or len(texts) == SHARD_DOCS):
                    yield from _shard((part << 32) + shard, texts, kept)
                    texts, held, shard = [], 0, shard + 1
                texts.append((NO_ID if doc is None else doc, text or b""))
                held += size
        if texts:
            yield from _shard((part << 32) + shard, texts, kept)

    return saved(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(shards, INDEX))


def _shard(shard: int, texts: list[tuple[int, bytes]], kept: dict[bytes, int] | None) -> Iterator[pa.RecordBatch]:
    texts = sorted(texts, key=lambda row: row[0])
    number = {} if kept is None else kept
    lengths = np.zeros(len(texts), dtype=np.int32)
    found: list[np.ndarray] = []
    for i, (_, text) in enumerate(texts):
        ids = []
        for words in terms_of(text):
            if kept is None:
                for word in words:
                    number.setdefault(word, len(number))
            ids.append(np.fromiter(map(number.get, words, repeat(-1)), np.int64, len(words)))
            lengths[i] += len(words)
        ids = np.concatenate(ids)
        found.append((ids[ids >= 0] << 32) + i)
    keys, tf = np.unique(np.concatenate(found), return_counts=True)
    doc, term = keys & 0xFFFFFFFF, keys >> 32
    edges = np.flatnonzero(np.diff(term, prepend=-1, append=-1))
    names = list(number)
    rows = [(shard, "", int((lengths > 0).sum()), int(lengths.sum()),
             np.array([d for d, _ in texts], dtype="<i8").tobytes(), lengths.astype("<i4").tobytes())]
    for a, b in zip(edges[:-1], edges[1:]):
        rows.append((shard, names[term[a]].decode(), int(b - a), int(tf[a:b].sum()), *_packed(doc[a:b], tf[a:b], lengths)))
        if len(rows) == 4096:
            yield _batch(rows)
            rows = []
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
    names = ["shard", "term", "df", "total", "heads", "postings"]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


class _List:
    """A term's list in a shard, with the part of the score that is the same for all items; blocks unpack when asked for."""

    def __init__(self, heads: bytes, postings: bytes, shard: _Shard):
        self.heads, self.postings, self.shard = np.frombuffer(heads, dtype=HEAD), postings, shard
        self.last = self.heads["last"].astype(np.int64)
        self.bounds = np.append(shard.parts(self.heads["tf"].astype(np.int64), self.heads["n"].astype(np.int64)), 0)
        self.bound = int(self.bounds.max())
        # A block that is still packed stands as copies of its last document, so the list is sorted at any time.
        self.docs = np.repeat(self.last, self.heads["size"])
        self.scores = np.zeros(len(self.docs), dtype=np.int64)
        self.open = np.zeros(len(self.heads), dtype=bool)

    def unpack(self, blocks: np.ndarray) -> None:
        for b in blocks[~self.open[blocks]].tolist():
            head = self.heads[b]
            size, at = int(head["size"]), int(head["at"])
            gaps = np.frombuffer(self.postings, f"<u{head['gap_bytes']}", size, at)
            tf = np.frombuffer(self.postings, f"<u{head['tf_bytes']}", size, at + size * int(head["gap_bytes"])).astype(np.int64)
            docs = gaps.cumsum(dtype=np.int64) + (int(self.last[b - 1]) if b else -1)
            here = slice(b * BLOCK, b * BLOCK + size)
            self.docs[here], self.scores[here] = docs, self.shard.parts(tf, self.shard.lengths[docs])
            self.open[b] = True

    def add_span(self, low: int, high: int, times: int, scores: np.ndarray) -> None:
        """Add this term's scores to those of documents low..high-1."""
        first, last = np.searchsorted(self.last, (low, high - 1))
        self.unpack(np.arange(first, min(last + 1, len(self.last))))
        a, b = np.searchsorted(self.docs, (low, high))
        scores[self.docs[a:b] - low] += times * self.scores[a:b]


class _Shard:
    """The documents of a shard, and the lists that were sent with it."""

    def __init__(self, ids: bytes, lengths: bytes, n_docs: int, n_terms: int):
        self.ids, self.lengths = np.frombuffer(ids, "<i8"), np.frombuffer(lengths, "<i4").astype(np.int64)
        self.n_docs, self.n_terms, self.lists = n_docs, n_terms, {}

    def parts(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        """A term's score but for its weight; larger for a larger tf or a smaller n."""
        m = 100 - 25 + np.array([25 * int(x) * self.n_docs // self.n_terms for x in n]) if self._wide(n) else 75 + 25 * n * self.n_docs // self.n_terms
        return 1_000_000_000 * tf // (1000 * tf + 12 * m)

    def _wide(self, n: np.ndarray) -> bool:
        return 25 * int(n.max(initial=0)) * self.n_docs >= 1 << 63

    def search(self, weights: dict[bytes, int], best: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best (scores, ids) among `best` and this shard's documents, for terms that weigh so much."""
        lists = sorted(((w * self.lists[t].bound, w, self.lists[t]) for t, w in weights.items() if w and t in self.lists), key=lambda x: x[:2])
        if not lists:
            return best
        reach = np.cumsum([bound for bound, _, _ in lists])
        for low in range(0, len(self.ids), SPAN):
            high = min(low + SPAN, len(self.ids))
            least = int(best[0][-1]) if len(best[0]) == k else 0
            # Lists whose bounds together stay below the kth score can't bring in a document alone.
            split = int(np.searchsorted(reach, least))
            if split == len(lists):
                return best
            scores = np.zeros(high - low, dtype=np.int64)
            for _, w, one in lists[split:]:
                one.add_span(low, high, w, scores)
            docs = np.flatnonzero(scores)
            scores = scores[docs]
            docs += low
            if split:
                may = scores + reach[split - 1] >= least
                docs, scores = docs[may], scores[may]
            if split and len(docs):
                blocks = np.array([np.searchsorted(one.last, docs) for _, _, one in lists[:split]])
                above = np.array([w * one.bounds[b] for (_, w, one), b in zip(lists[:split], blocks)])
                rest = above.sum(axis=0)
                for i in reversed(range(split)):
                    may = scores + rest >= least
                    docs, scores, rest, blocks, above = docs[may], scores[may], rest[may], blocks[:, may], above[:, may]
                    if not len(docs):
                        break
                    _, w, one = lists[i]
                    there = blocks[i] < len(one.last)
                    one.unpack(np.unique(blocks[i][there]))
                    at = np.minimum(np.searchsorted(one.docs, docs), len(one.docs) - 1)
                    scores = scores + np.where(one.docs[at] == docs, w * one.scores[at], 0)
                    rest = rest - above[i]
            may = scores >= max(least, 1)
            if may.any():
                scores, ids = np.concatenate([best[0], scores[may]]), np.concatenate([best[1], self.ids[docs[may]]])
                order = np.lexsort((ids, -scores))[:k]
                best = scores[order], ids[order]
        return best


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def search(index: DataFrame, items: list[tuple[object, Counter]], k: int, id_type: str = "long") -> DataFrame:
    """(item_id, rank, doc_id, score) of the k best documents for each item (id, its terms with their counts).

    Only lists of the items' terms are read. A task goes through its shards one by one and keeps a heap for each item all the
    while, so what it has found bounds its later shards; heaps are merged by score and id. Shards meet tasks in one shuffle
    of the few lists that are read.
    """
    spark = index.sparkSession
    terms = sorted(set().union(*(counts for _, counts in items)))
    wanted = F.broadcast(spark.createDataFrame([(t.decode(),) for t in [b"", *terms]], "term string"))
    lists = index.join(wanted, "term", "left_semi")
    sums = {r["term"]: (r["df"], r["total"]) for r in lists.groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total")).collect()}
    n_docs, n_terms = sums.pop("", (0, 0))
    weights = {t.encode(): weight(n_docs, df) for t, (df, _) in sums.items()}
    asked = [{t: weights[t] * n for t, n in counts.items() if t in weights} for _, counts in items]
    ids = [item for item, _ in items]

    def run(batches):
        best = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)) for _ in asked]
        shard, now = None, None

        def done():
            if shard is not None and shard.lists:
                for i, terms_ in enumerate(asked):
                    best[i] = shard.search(terms_, best[i], k)

        for batch in batches:
            for number, term, heads, postings in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if number != now:
                    done()
                    now, shard = number, _Shard(heads, postings, n_docs, n_terms)
                else:
                    shard.lists[term.encode()] = _List(heads, postings, shard)
        done()
        for i, (scores, docs) in enumerate(best):
            if len(docs):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(docs), i)), pa.array(docs), pa.array(scores)], ["item", "doc_id", "score"])

    dealt = lists.select("shard", "term", "heads", "postings").repartition("shard").sortWithinPartitions("shard", "term")
    heaps = dealt.mapInArrow(run, "item long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    merged = heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = F.broadcast(spark.createDataFrame(list(enumerate(ids)), f"item long, item_id {id_type}"))
    doc = F.when(F.col("doc_id") < NO_ID, F.col("doc_id")).alias("doc_id")
    return merged.join(names, "item").select("item_id", "rank", doc, "score")


def rank(docs: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of `docs` (doc_id, text) that score highest for each item of `queries`
    (item_id, text), among those that score above 0; equal scores by doc_id.

    Terms are runs of ASCII letters (A-Z lower-cased), digits and characters above U+007F. The whole texts are read once to
    build the index, and items are taken in blocks of about 1,000, so that a block's terms can be broadcast. The index has only
    the items' terms, if those are no more than 200,000; beyond that it has all terms. Either way the results are the same.

    Null texts have no terms; items without terms, or whose terms are in no document, have no rows; rows of equal id and
    text are one item. Documents that repeat an id count as different ones. A null doc_id is last in a tie, a null
    item_id stays null. Empty tables give no rows.
    """
    queries = saved(queries.select("item_id", F.col("text").cast("string")).distinct())
    blocks = max(1, -(-queries.count() // ITEMS))
    id_type = dict(queries.dtypes)["item_id"]

    def items_of(block: int) -> list[tuple[object, Counter]]:
        rows = queries.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        return [(row["item_id"], Counter(t for words in terms_of((row["text"] or "").encode()) for t in words)) for row in rows]

    terms: set[bytes] | None = set()
    for block in range(blocks):
        terms = terms.union(*(counts for _, counts in items_of(block)))
        if len(terms) > TERMS:
            terms = None
            break
    index = build(docs, terms if terms is None else frozenset(terms))
    found = None
    for block in range(blocks):
        part = saved(search(index, items_of(block), k, id_type))
        found = part if found is None else found.unionByName(part)
    drop_saved(index)
    return found
