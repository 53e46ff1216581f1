"""Packing of documents into sequences: bounded-space online best-fit.

A document is its token ids and the closing id. Longer ones than a sequence are cut into whole
sequences, what is over coming first. Pieces are dealt out evenly, put into an order, and packed
task by task in one pass: a piece goes into the open sequence with the least space that holds
it. Open sequences are kept by free space, with one bit of a bitset for every amount that some open
sequence has left, so the best fit is the lowest set bit from the piece's length on. When no open
sequence fits and the fixed number of them is reached, the fullest closes. A piece's place is final
at once, so a task holds counters only.

The order is total over what a piece is, so a repeated task packs alike. Pieces come in chunks
chosen by hash, each about as many as there are open sequences, and from long to short within a
chunk; so the short ones fill what the long ones left, before it has to close. What is lost are the
last open sequences of each task, and tasks are as few as their size allows.

Defined results: a null or empty text is the closing id alone. The string of an added token in a text
is that token, as in ``tokenizers``. Equal or repeated rows are packed
each for itself. An empty table gives an empty result. Columns beyond ``doc_id`` and ``text`` are
ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starbrook.llm.bpe import Encoder, Ranks
from starbrook.llm.common import id_and_text, table
from starbrook.session import cut_lineage

VOCABULARY = "byte_bpe_50k.json"
SEQUENCE = 1024
CLOSING_ID = 2
OPEN_SEQUENCES = 8192
CHUNK_PIECES = 8192
TASK_PIECES = 200_000

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PLACED = PIECES + ", sequence_id bigint, offset bigint"


class Tokens:
    """Ids of a text. The text is cut at the vocabulary's added tokens, which have ids of their own.
    The merges run in the compiled library; a run of white space too long for its pattern engine is
    encoded on arrays, with the same ids."""

    def __init__(self, ranks: Ranks):
        body, begin, length = ranks.body.tobytes(), ranks.begin.tolist(), ranks.length.tolist()
        self.engine = tiktoken.Encoding(
            "packing",
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks={body[b : b + n]: i for i, (b, n) in enumerate(zip(begin, length, strict=True)) if n},
            special_tokens={},
        )
        self.arrays = Encoder(ranks)
        self.added = dict(ranks.added)
        # of two that begin at one place, the longer
        longest = sorted(self.added, key=len, reverse=True)
        self.cuts = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None

    def ids(self, text: str) -> np.ndarray:
        if self.cuts is None or self.cuts.search(text) is None:
            return self._merged(text)
        parts = self.cuts.split(text)  # every second one is an added token
        ids = [[self.added[p]] if k % 2 else self._merged(p) for k, p in enumerate(parts)]
        return np.concatenate([np.asarray(i, dtype=np.int64) for i in ids])

    def _merged(self, text: str) -> np.ndarray:
        try:
            return self.engine.encode_to_numpy(text, disallowed_special=())
        except ValueError:
            return self.arrays.encode([text]).ids


_tokens: dict[tuple, Tokens] = {}


def _shared(ranks: Broadcast) -> Tokens:
    key = ranks.value.size, int(ranks.value.pairs.sum()), ranks.value.added
    if key not in _tokens:
        _tokens[key] = Tokens(ranks.value)
    return _tokens[key]


def cut(n: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``n`` ids."""
    first = n % SEQUENCE or min(n, SEQUENCE)
    return [(0, first), *((s, SEQUENCE) for s in range(first, n, SEQUENCE))]


def pieces(docs: DataFrame, ranks: Ranks) -> DataFrame:
    """The pieces of all documents, with the checksum of their ids."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # size of the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _shared(shared)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                body = np.append(tokens.ids(text.as_py()), CLOSING_ID).astype("<u4").tobytes()
                for k, (start, length) in enumerate(cut(len(body) // 4)):
                    crc = zlib.crc32(memoryview(body)[4 * start : 4 * (start + length)])
                    rows.append((doc_id, k, start, length, crc))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return id_and_text(docs).mapInArrow(run, PIECES)


class BestFit:
    """Open sequences by free space."""

    def __init__(self, most_open: int = OPEN_SEQUENCES, size: int = SEQUENCE):
        self.size, self.most_open = size, most_open
        self.bits = self.open = self.next = 0
        self.by_free: list[list[int]] = [[] for _ in range(size + 1)]

    def _take(self, free: int) -> int:
        stack = self.by_free[free]
        sequence = stack.pop()
        if not stack:
            self.bits &= ~(1 << free)
        self.open -= 1
        return sequence

    def place(self, length: int) -> tuple[int, int]:
        """The sequence a piece goes to, and its offset there."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            sequence = self._take(free)
        else:
            free, sequence = self.size, self.next
            self.next += 1
        if free > length:
            if self.open == self.most_open:  # the fullest closes
                self._take((self.bits & -self.bits).bit_length() - 1)
            left = free - length
            self.by_free[left].append(sequence)
            self.bits |= 1 << left
            self.open += 1
        return sequence, self.size - free


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bins = BestFit()
    for batch in batches:
        placed = [bins.place(n) for n in batch["length"].to_pylist()]
        task = batch["task"].to_numpy()
        sequence = np.array([s for s, _ in placed], dtype=np.int64) + (task.astype(np.int64) << 36)
        columns = [batch[name] for name in ("doc_id", "piece", "start", "length", "ids_crc32")]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(sequence), pa.array([o for _, o in placed], pa.int64())],
            ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
        )


def pack(cut_pieces: DataFrame) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces."""
    cut_pieces = cut_lineage(cut_pieces)
    n = cut_pieces.count()
    tasks = max(1, -(-n // TASK_PIECES))
    chunks = max(1, -(-n // (tasks * CHUNK_PIECES)))
    order = F.xxhash64("doc_id", "piece", "ids_crc32")
    dealt = cut_pieces.withColumn("order", order).repartition(tasks, "order")
    chunk = F.pmod(F.xxhash64("order"), F.lit(chunks))
    ordered = dealt.withColumn("chunk", chunk).sortWithinPartitions(
        "chunk", F.desc("length"), "order", "doc_id", "piece", "start", "ids_crc32"
    )
    placed = ordered.withColumn("task", F.spark_partition_id()).drop("order", "chunk")
    return placed.mapInArrow(_pack, PLACED)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    ranks = Ranks.from_tokenizers(path or public_tokenizers.path(VOCABULARY))
    return pack(pieces(table(spark, sf_dir, "documents"), ranks))
