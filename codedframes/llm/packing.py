"""Packing of token pieces into sequences: exact complements of each gap, best fit where there are none."""

from __future__ import annotations

import base64
import functools
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codedframes.llm.common import ranked, saved

CAPACITY, END = 1024, 2
SPECIAL = {"<|endoftext|>": 50256}


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@functools.cache
def _encoding(path: str) -> tiktoken.Encoding:
    import public_tokenizers

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)


def token_ids(text: str | None, path: str) -> list[int]:
    """Ids of a whole text, as the byte-level BPE of the same vocabulary gives them, special strings included."""
    text, encoding = text or "", _encoding(path)
    if any(s in text for s in SPECIAL):
        return encoding.encode(text, allowed_special="all")
    return encoding.encode_ordinary(text)


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of each row of `docs` (doc_id, text).

    A document is its text's ids and the end id; one longer than the capacity is cut into full pieces, of which only the
    first may be shorter. A null or empty text is the end id alone; a null doc_id stays null.
    """
    path = path or vocabulary()

    def cut(batches):
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.array([*token_ids(text, path), end], dtype="<u4")
                stops = [*range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
                for n, (start, stop) in enumerate(zip([0, *stops], stops)):
                    part = ids[start:stop]
                    rows.append((doc, n, start, stop - start, zlib.crc32(part.tobytes()), *([part] if with_ids else [])))
            for at in range(0, len(rows), 4096):
                columns = [list(x) for x in zip(*rows[at:at + 4096], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.list_(pa.int32())] * with_ids]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, schema)


class Sums:
    """How many combinations of one, two and three pieces that are there give each total up to the capacity.

    A combination may use a length as often as it is there. `change` keeps the three tables right as counts go up or
    down: only the first three pieces of a length matter, and each of them costs a few additions of whole tables.
    """

    def __init__(self, counts: dict[int, int], capacity: int):
        self.have = np.zeros(capacity + 1, dtype=np.int64)
        self.one, self.two, self.three = (np.zeros(capacity + 1, dtype=np.int64) for _ in range(3))
        for length, n in counts.items():
            self.change(length, n)

    def change(self, length: int, by: int) -> None:
        before, after = (min(int(n), 3) for n in (self.have[length], self.have[length] + by))
        self.have[length] += by
        for level in range(before + 1, after + 1):
            self._copy(length, level, 1)
        for level in range(before, after, -1):
            self._copy(length, level, -1)

    def _copy(self, length: int, level: int, sign: int) -> None:
        """Add or take the combinations that use exactly `level` pieces of the length."""
        others = self.one.copy()
        others[length] = 0
        if level == 1:
            other_pairs = self.two if sign > 0 else self.two - _raised(others, length)
            self.three += sign * _raised(other_pairs, length)
            self.two += sign * _raised(others, length)
            self.one[length] += sign
        elif level == 2:
            self.three += sign * _raised(others, 2 * length)
            self.two[2 * length:2 * length + 1] += sign
        else:
            self.three[3 * length:3 * length + 1] += sign

    def longest(self, most: int) -> int:
        """The longest length up to `most` that is there; 0 if none."""
        there = np.flatnonzero(self.one[:most + 1])
        return int(there[-1]) if len(there) else 0

    def _pair(self, total: int) -> tuple[int, int] | None:
        """Two pieces of this total, as equal as can be."""
        first = np.arange((total + 1) // 2, total)
        fits = (self.one[first] > 0) & (self.one[total - first] > 0)
        if total % 2 == 0 and self.have[total // 2] < 2:
            fits[:1] = False
        return (int(first[fits.argmax()]), int(total - first[fits.argmax()])) if fits.any() else None

    def complement(self, gap: int, slack: int) -> tuple[int, ...] | None:
        """One, two or three lengths that are there and fill the gap exactly.

        Their longest is at most `slack` shorter than the longest that fits, so that the gap doesn't use up the short
        pieces that other gaps need; the rest is one piece, or the most equal two.
        """
        if self.one[gap]:
            return (gap,)
        if not self.two[gap] and not self.three[gap]:
            return None
        top = self.longest(gap)
        for length in np.flatnonzero(self.one[:top + 1])[::-1].tolist():
            if top - length > slack:
                return None
            self.change(length, -1)
            rest = gap - length
            found = (rest,) if self.one[rest] else self._pair(rest) if self.two[rest] else None
            self.change(length, 1)
            if found:
                return (length, *found)
        return None


def _raised(sums: np.ndarray, by: int) -> np.ndarray:
    """The table of the same combinations with one more length."""
    out = np.zeros_like(sums)
    out[by:] = sums[:max(len(sums) - by, 0)]
    return out


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Bins (lengths, how many such bins) for so many pieces of each length; its work depends on the capacity alone.

    A bin begins with the longest piece left. If one, two or three lengths that are there fill its gap exactly, they
    close it; if not, the longest piece that fits goes in (best fit), and the smaller gap is looked up again. As many equal
    bins are made at once as the counts allow, so each step uses up a length or leaves fewer than four pieces of it.
    """
    sums, bins = Sums(counts, capacity), []
    while sums.longest(capacity):
        lengths: list[int] = []
        gap, fill = capacity, None
        while gap and not fill:
            fill = sums.complement(gap, capacity // 16) if lengths else None
            nxt = 0 if fill else sums.longest(gap)
            if not fill and not nxt:
                break
            for length in fill or (nxt,):
                lengths.append(length)
                sums.change(length, -1)
                gap -= length
        uses = {x: lengths.count(x) for x in lengths}
        more = min(int(sums.have[x]) // k for x, k in uses.items())
        for x, k in uses.items():
            sums.change(x, -more * k)
        bins.append((tuple(lengths), more + 1))
    return bins


def slots(bins: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, first rank, per bin, first sequence, offset): where the pieces of each length go, by their rank."""
    used: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for lengths, n in bins:
        at, i = 0, 0
        while i < len(lengths):
            j = i
            while j < len(lengths) and lengths[j] == lengths[i]:
                j += 1
            rows.append((lengths[i], used[lengths[i]], j - i, sequence, at))
            used[lengths[i]] += n * (j - i)
            at += lengths[i] * (j - i)
            i = j
        sequence += n
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The rows of `parts` (from `pieces`; lengths 1 to capacity) with `sequence_id` and `offset`, gapless from 0.

    Only the count of each length comes to the driver, which plans bins by length; each piece finds its place by its
    rank among those of its length. Any number of pieces may share a length (see `ranked`). An empty table gives no rows.
    """
    parts = saved(parts)
    counts = {r["length"]: r["count"] for r in parts.groupBy("length").count().collect()}
    table = slots(plan(counts, capacity))
    keys = (table[:, 0] << 48) + table[:, 1]
    numbered = ranked(parts, "length", ["doc_id", "piece", "ids_crc32"])
    columns = parts.columns

    def place(batches):
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            row = table[np.searchsorted(keys, (length << 48) + rank, "right") - 1]
            nth = rank - row[:, 1]
            sequence, offset = row[:, 3] + nth // row[:, 2], row[:, 4] + nth % row[:, 2] * length
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in columns), pa.array(sequence), pa.array(offset)],
                [*columns, "sequence_id", "offset"],
            )

    schema = ", ".join(f"`{c}` {t}" for c, t in parts.dtypes) + ", sequence_id long, offset long"
    return numbered.select(*columns, F.col("rank").cast("long").alias("rank")).mapInArrow(place, schema)
