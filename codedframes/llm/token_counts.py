"""Token counts of whole texts by a two-tier lookup of pre-tokens, without a shuffle."""

from __future__ import annotations

import functools
import os
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codedframes.llm.common import byte_windows

#: Entries of the frequent tier and bytes of an entry at most, so that the broadcast stays below 5 MB.
TABLE, ENTRY_BYTES = 65536, 64
#: Entries that a worker keeps besides; text that a task counts for the frequent tier; text handled at a time.
CACHE, SAMPLE_BYTES, WINDOW = 400_000, 8 << 20, 4 << 20
LIMIT = 2048


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@functools.cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return lambda texts: [len(x) for x in model.encode_batch_fast(texts, add_special_tokens=False)]


def lengths(pieces: Iterable[bytes], path: str) -> list[int]:
    """Tokens of each piece, as the vocabulary's library gives them."""
    return _tokenizer(path)([piece.decode() for piece in pieces])


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return [text or b"" for text in batch.column(column).cast(pa.binary()).to_pylist()]


def frequent(docs: DataFrame, path: str, size: int = TABLE) -> tuple[bytes, bytes]:
    """The frequent tier: pre-tokens joined by line feeds, and their lengths, a byte each.

    A task counts the first SAMPLE_BYTES of its partition and gives the pre-tokens that it has seen more than once, at
    most size / 4 of them. Partitions are tried one after the other, in growing runs, until 2 * size rows are there, so
    neither the work nor what comes to the driver grows with the table. Which ones get in decides on speed alone: what
    isn't in the table is encoded where it is met.
    """

    def count(batches):
        seen, rest = Counter(), SAMPLE_BYTES
        for batch in batches:
            for text in _texts(batch, 0):
                for window in byte_windows(text, WINDOW):
                    if rest > 0:
                        seen.update(window.split())
                        rest -= len(window)
            if rest <= 0:
                break
        top = [(p, n) for p, n in seen.most_common(size // 4) if n > 1 and len(p) <= ENTRY_BYTES]
        tokens = lengths([p for p, _ in top], path)
        for at in range(0, len(top), 4096):
            rows = [(p, n, t) for (p, n), t in zip(top[at:at + 4096], tokens[at:at + 4096], strict=True) if t < 256]
            columns = zip(*rows, strict=True) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.int32()))], names)

    names = ["piece", "n", "tokens"]
    found = docs.select(F.col("text").cast("string")).mapInArrow(count, "piece binary, n long, tokens int").limit(2 * size).collect()
    total, tokens = Counter(), {}
    for row in found:
        total[bytes(row["piece"])] += row["n"]
        tokens[bytes(row["piece"])] = row["tokens"]
    kept = [p for p, _ in total.most_common(size)]
    return b"\n".join(kept), bytes(tokens[p] for p in kept)


@functools.lru_cache(maxsize=2)
def _known(tier: str) -> dict[bytes, int]:
    """What a worker knows of one broadcast: the frequent tier, and what its tasks have added to it."""
    return {}


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row of `docs` (doc_id, text), in one pass without a shuffle.

    A pre-token here is a run of bytes other than the six ASCII blanks. The vocabulary's library takes such runs one by
    one (none of its rules looks across a blank, and special strings hold none), so a text has as many tokens as its
    pre-tokens together. Lengths of frequent ones are broadcast; a worker encodes the others once, all that are new in
    some text together, and keeps them in a cache of bounded size that its later tasks go on using.

    A null text counts as an empty one, of 0 bytes and tokens; a null doc_id stays null; repeated rows are all given; an
    empty table gives no rows. Long texts are taken in windows cut at blanks. Blanks are parts of tokens in sentencepiece
    vocabularies (.model), for which whole texts are encoded instead.
    """
    path = path or vocabulary()
    whole, tier = not path.endswith(".json"), uuid.uuid4().hex
    table = None if whole else docs.sparkSession.sparkContext.broadcast(frequent(docs, path))

    def count_windows(windows: list[list[bytes]]) -> list[int]:
        have = _known(tier)
        if not have or len(have) > TABLE + CACHE:
            have.clear()
            pieces, tokens = table.value
            have.update(zip(pieces.split(b"\n"), tokens))
        new = list(set().union(*windows).difference(have))
        have.update(zip(new, lengths(new, path)))
        counts = [sum(map(have.__getitem__, window)) for window in windows]
        for piece in new:
            if len(piece) > ENTRY_BYTES:
                del have[piece]
        return counts

    def count(batches):
        for batch in batches:
            texts = _texts(batch, 1)
            totals = np.zeros(len(texts), dtype=np.int64)
            if whole:
                totals[:] = [lengths([text], path)[0] for text in texts]
            else:
                for owners, windows in _grouped(texts):
                    np.add.at(totals, owners, count_windows(windows))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(totals)], ["doc_id", "n_bytes", "n_tokens"]
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)


def _grouped(texts: list[bytes]) -> Iterator[tuple[list[int], list[list[bytes]]]]:
    """Windows of texts, split at blanks, with the number of the text that each belongs to; about WINDOW bytes together."""
    owners, windows, held = [], [], 0
    for i, text in enumerate(texts):
        for window in byte_windows(text, WINDOW):
            owners.append(i)
            windows.append(window.split())
            held += len(window)
            if held >= WINDOW:
                yield owners, windows
                owners, windows, held = [], [], 0
    if owners:
        yield owners, windows
