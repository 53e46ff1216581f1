"""Byte-level byte-pair encoding and decoding on numpy arrays.

Texts are cut into pieces without a regular expression. Every code point becomes a class (blank,
other white space, letter, number, other sign, the apostrophe, the letters of the English
contractions). A small automaton over classes says where contractions end; all other boundaries
follow from neighbouring classes. The automaton's transitions generate a finite set of state maps
with an associative product, so it is run as a scan: the maps of all blocks of a long array are
multiplied out side by side, the block products are scanned by doubling, and the states inside the
blocks are replayed from there.

Distinct pieces are merged together: their pair ranks form one matrix, and every round merges the
best pair of every row. Pieces met before come from a bounded cache. Ids keep the byte offset of
each token, from which decoding cuts the bytes of each text again.

Defined results: a null text is empty, and an empty text has no ids. Strings of added
tokens are ordinary text to an ``Encoder``. Rows are encoded each for itself. An empty table gives an empty result. Columns
beyond ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession

from starbrook.llm.common import id_and_text, steps, table

BLOCK = 256
LONG_PIECE = 48  # longer pieces are merged one by one
NO_RANK = np.int64(1) << 40

# classes of code points
BLANK, SPACE, LETTER, NUMBER, SIGN, APOSTROPHE, WHOLE, BEFORE_E, BEFORE_L, E, END = range(11)
CLASSES = 11
LETTERS = (LETTER, WHOLE, BEFORE_E, BEFORE_L, E)
# states of the automaton
FRESH, AFTER_BLANK, IN_LETTERS, IN_NUMBERS, IN_SIGNS, OPEN, WANTS_E, WANTS_L, CONTRACTED = range(9)
STATES = 9


def _transition(state: int, kind: int) -> int:
    if kind in (SPACE, END):
        return FRESH
    if kind == BLANK:
        return AFTER_BLANK
    if kind == NUMBER:
        return IN_NUMBERS
    if kind == SIGN:
        return IN_SIGNS
    if kind == APOSTROPHE:  # opens a contraction only where a piece begins
        return IN_SIGNS if state in (AFTER_BLANK, IN_SIGNS, OPEN) else OPEN
    if state == OPEN:
        return {WHOLE: CONTRACTED, BEFORE_E: WANTS_E, BEFORE_L: WANTS_L}.get(kind, IN_LETTERS)
    if (state, kind) in ((WANTS_E, E), (WANTS_L, BEFORE_L)):
        return CONTRACTED
    return IN_LETTERS


@lru_cache(1)
def _maps() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The automaton; the product of a state map with a class; the product of two state maps; the
    state each map leads to from the beginning. Map 0 is the identity."""
    delta = np.array([[_transition(s, k) for k in range(CLASSES)] for s in range(STATES)])
    found, index = [tuple(range(STATES))], {tuple(range(STATES)): 0}
    by_class = []
    for f in found:  # grows while it is read
        row = []
        for k in range(CLASSES):
            g = tuple(int(delta[s, k]) for s in f)
            if g not in index:
                index[g] = len(found)
                found.append(g)
            row.append(index[g])
        by_class.append(row)
    product = [[index[tuple(g[s] for s in f)] for g in found] for f in found]
    return delta, np.array(by_class), np.array(product), np.array([f[FRESH] for f in found])


def states(kinds: np.ndarray) -> np.ndarray:
    """The automaton's state after every class of an array."""
    delta, by_class, product, reached = _maps()
    n = len(kinds)
    blocks = -(-n // BLOCK)
    padded = np.full(blocks * BLOCK, END, dtype=np.intp)
    padded[:n] = kinds
    columns = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T)
    flat = by_class.ravel()
    maps = np.zeros(blocks, dtype=np.intp)
    for column in columns:
        maps = flat.take(maps * CLASSES + column)
    step = 1
    while step < blocks:
        maps[step:] = product[maps[:-step], maps[step:]]
        step *= 2
    state = np.concatenate([[FRESH], reached[maps[:-1]]]) if blocks else maps
    out = np.empty((BLOCK, blocks), dtype=np.uint8)
    flat = delta.ravel()
    for j, column in enumerate(columns):
        state = flat.take(state * CLASSES + column)
        out[j] = state
    return out.T.ravel()[:n]


def piece_starts(kinds: np.ndarray) -> np.ndarray:
    """True where a piece begins. ``END`` stands between texts and is a piece of its own."""
    n = len(kinds)
    state = states(kinds)
    group = np.array([0, 0, 2, 3, 4, 4, 2, 2, 2, 2, 9], dtype=np.uint8)[kinds]
    white = group == 0
    before = np.concatenate([[9], group[:-1]]).astype(np.uint8)
    after = np.concatenate([group[1:], [9]])
    starts = group != before
    starts |= group == 9
    # the last of several white space characters is set apart, unless the text ends with it
    starts |= white & (before == 0) & (after != 0) & (after != 9)
    # a blank belongs to what follows it
    follows_blank = np.concatenate([[False], kinds[:-1] == BLANK])
    starts &= ~(follows_blank & ~white & (group != 9))
    done = np.flatnonzero(state == CONTRACTED)
    short = state[done - 1] == OPEN
    starts[np.where(short, done, done - 1)] = False
    after_done = done[done + 1 < n] + 1
    starts[after_done] |= group[after_done] == 2
    return starts


@lru_cache(1)
def class_table() -> np.ndarray:
    """The class of every code point, as the tokenizer's own pattern engine classifies it."""
    points = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    single = {bytes([i]): i for i in range(256)}
    kinds = np.full(0x110000, SIGN, dtype=np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
        engine = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        matched = bytes(engine.encode_ordinary(points)).decode("utf-8")
        kinds[np.fromiter(map(ord, matched), dtype=np.int64, count=len(matched))] = kind
    for letters, kind in ((" ", BLANK), ("'", APOSTROPHE), ("stmd", WHOLE), ("rv", BEFORE_E), ("l", BEFORE_L), ("e", E)):
        for letter in letters:
            kinds[ord(letter)] = kind
    return kinds


@dataclass(frozen=True)
class Ranks:
    """A vocabulary in arrays: the bytes of every id, and the id that each mergeable pair makes."""

    kinds: np.ndarray
    body: np.ndarray  # bytes of all tokens, one after the other
    begin: np.ndarray
    length: np.ndarray
    pairs: np.ndarray  # left id * size + right id, sorted
    merged: np.ndarray
    single: np.ndarray  # id of each byte
    added: tuple[tuple[str, int], ...] = ()  # strings with an id of their own, matched before the merges

    @property
    def size(self) -> int:
        return len(self.begin)

    @staticmethod
    def of(ranks: dict[bytes, int], added: tuple[tuple[str, int], ...] = ()) -> Ranks:
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for token, i in ranks.items():
            tokens[i] = token
        pairs = {}
        for token, i in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * size + right] = i
        keys = np.array(sorted(pairs), dtype=np.int64)
        length = np.array([len(t) for t in tokens], dtype=np.int64)
        return Ranks(
            class_table(),
            np.frombuffer(b"".join(tokens), dtype=np.uint8),
            np.cumsum(length) - length,
            length,
            keys,
            np.array([pairs[k] for k in keys.tolist()], dtype=np.int64),
            np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int64),
            added,
        )

    @staticmethod
    def from_tiktoken(path: str) -> Ranks:
        with open(path, "rb") as lines:
            return Ranks.of({base64.b64decode(t): int(i) for t, i in map(bytes.split, lines)})

    @staticmethod
    def from_tokenizers(path: str) -> Ranks:
        """Of a ``tokenizers`` file of the byte-level kind, whose ids follow the order of merges."""
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        shown = {chr(b): b for b in visible}
        shown |= {chr(0x100 + k): b for k, b in enumerate(b for b in range(256) if b not in set(visible))}
        tokens = content["added_tokens"]
        for token in tokens:
            if token["single_word"] or token["lstrip"] or token["rstrip"]:
                raise ValueError(f"added token {token['content']!r} does not stand for its string alone")
        added = {t["content"]: t["id"] for t in tokens}
        vocabulary = content["model"]["vocab"].items()
        ranks = {bytes(shown[c] for c in token): i for token, i in vocabulary if token not in added}
        return Ranks.of(ranks, tuple(added.items()))


def expand(body: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The stretches ``begin``, ``length`` of an array, one after the other."""
    if not len(begin):
        return body[:0]
    edge = np.cumsum(length)
    return body[np.arange(edge[-1]) + np.repeat(begin - (edge - length), length)]


@dataclass
class Encoded:
    """Ids of some texts: those of text k are ``ids[edge[k]:edge[k + 1]]``; token j of them all
    covers the bytes from ``offset[j]`` on."""

    ids: np.ndarray
    edge: np.ndarray
    offset: np.ndarray


class Encoder:
    MOST_PIECES = 400_000

    def __init__(self, ranks: Ranks):
        self.ranks = ranks
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat = np.zeros(0, dtype=np.int32)
        self.begin = np.zeros(0, dtype=np.int64)
        self.length = np.zeros(0, dtype=np.int64)

    def pieces(self, texts: list[str]) -> tuple[list[bytes], np.ndarray]:
        """The pieces of all texts in order, and where those of each text begin and end."""
        body = b"\xff".join([t.encode("utf-8", "replace") for t in texts]) + b"\xff"
        data = np.frombuffer(body, dtype=np.uint8)
        kinds_of = self.ranks.kinds
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        first = data[lead]
        kinds = kinds_of[first]  # right for ASCII
        wide = np.flatnonzero(first >= 0x80)
        if len(wide):
            at, top = lead[wide], first[wide].astype(np.int64)
            size = 2 + (top >= 0xE0) + (top >= 0xF0)
            padded = np.concatenate([data, np.zeros(3, dtype=np.uint8)]).astype(np.int64)
            point = top & (0xFF >> (size + 1))
            for k in range(1, 4):
                point = np.where(size > k, (point << 6) | (padded[at + k] & 0x3F), point)
            kinds[wide] = np.where(top == 0xFF, END, kinds_of[np.minimum(point, 0x10FFFF)])
        starts = np.flatnonzero(piece_starts(kinds))
        begin = lead[starts]
        ends = np.append(begin[1:], len(data))
        real = kinds[starts] != END
        edge = np.concatenate([[0], np.cumsum(real)[~real]])
        cut = [body[b:e] for b, e in zip(begin[real].tolist(), ends[real].tolist(), strict=True)]
        return cut, edge

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.ranks.size + right
        at = np.minimum(np.searchsorted(self.ranks.pairs, key), len(self.ranks.pairs) - 1)
        return np.where((self.ranks.pairs[at] == key) & (left >= 0) & (right >= 0), self.ranks.merged[at], NO_RANK)

    def _merge_rows(self, ids: np.ndarray) -> list[np.ndarray]:
        """Merges each row of byte ids, padded with -1."""
        done: list = [None] * len(ids)
        row = np.arange(len(ids))
        rank = self._rank(ids[:, :-1], ids[:, 1:])
        while len(row):
            best = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(row), dtype=np.int64)
            value = rank[np.arange(len(row)), best] if rank.shape[1] else np.full(len(row), NO_RANK)
            over = value >= NO_RANK
            for r, line in zip(row[over].tolist(), ids[over], strict=True):
                done[r] = line[line >= 0]
            row, ids, rank, best, value = row[~over], ids[~over], rank[~over], best[~over], value[~over]
            if not len(row):
                break
            at, column = np.arange(len(row)), np.arange(ids.shape[1])
            ids[at, best] = value
            moved = np.concatenate([ids[:, 1:], np.full((len(row), 1), -1)], axis=1)
            ids = np.where(column > best[:, None], moved, ids)
            moved = np.concatenate([rank[:, 1:], np.full((len(row), 1), NO_RANK)], axis=1)
            rank = np.where(column[:-1] > best[:, None], moved, rank)
            rank[at, best] = self._rank(ids[at, best], ids[at, best + 1])
            left = best > 0
            rank[at[left], best[left] - 1] = self._rank(ids[at[left], best[left] - 1], ids[at[left], best[left]])
            used = (ids >= 0).any(axis=0).sum()
            ids, rank = ids[:, : max(2, used)], rank[:, : max(1, used - 1)]
        return done

    def _merge_long(self, piece: bytes) -> np.ndarray:
        """One long piece. The pairs of equal best rank that do not overlap are merged together,
        from the left; merging one cannot make a better pair than those that are left."""
        ids = self.ranks.single[np.frombuffer(piece, dtype=np.uint8)]
        while len(ids) > 1:
            rank = self._rank(ids[:-1], ids[1:])
            best = rank.min()
            if best >= NO_RANK:
                break
            at = np.flatnonzero(rank == best)
            # of a run of overlapping pairs, every second one
            run = np.concatenate([[True], np.diff(at) > 1])
            index = np.arange(len(at))
            at = at[(index - np.maximum.accumulate(np.where(run, index, 0))) % 2 == 0]
            ids[at] = best
            ids = np.delete(ids, at + 1)
        return ids

    def _learn(self, new: list[bytes]) -> None:
        new.sort(key=len)
        merged: list[np.ndarray] = []
        start = 0
        while start < len(new) and len(new[start]) <= LONG_PIECE:
            stop, size = start, len(new[start])
            while stop < len(new) and len(new[stop]) <= size + 2 and stop - start < 50_000 and len(new[stop]) <= LONG_PIECE:
                stop += 1
            part = new[start:stop]
            wide = len(part[-1])
            data = np.frombuffer(b"".join(p.ljust(wide, b"\0") for p in part), dtype=np.uint8).reshape(-1, wide)
            ids = self.ranks.single[data]
            sizes = np.array([len(p) for p in part])
            ids[np.arange(wide) >= sizes[:, None]] = -1
            merged.extend(self._merge_rows(ids))
            start = stop
        merged.extend(self._merge_long(p) for p in new[start:])
        length = np.array([len(m) for m in merged], dtype=np.int64)
        base = len(self.known)
        self.known.update(zip(new, range(base, base + len(new)), strict=True))
        self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length])
        self.flat = np.concatenate([self.flat, *merged]).astype(np.int32)

    def encode(self, texts: list[str]) -> Encoded:
        cut, edge = self.pieces(texts)
        new = list(set(cut).difference(self.known))
        if len(self.known) + len(new) > self.MOST_PIECES:
            self._forget()
            new = list(set(cut))
        if new:
            self._learn(new)
        index = np.fromiter(map(self.known.__getitem__, cut), dtype=np.int64, count=len(cut))
        length = self.length[index]
        ids = expand(self.flat, self.begin[index], length)
        token_edge = np.concatenate([[0], np.cumsum(length)])[edge]
        size = self.ranks.length[ids]
        return Encoded(ids, token_edge, np.cumsum(size) - size)

    def decode(self, encoded: Encoded) -> list[bytes]:
        """The bytes of every text, cut at the offsets of its first token and of the next text's."""
        body = expand(self.ranks.body, self.ranks.begin[encoded.ids], self.ranks.length[encoded.ids]).tobytes()
        offset = np.append(encoded.offset, len(body))
        cuts = offset[encoded.edge].tolist()
        return [body[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


_encoders: dict[int, Encoder] = {}


def encoder(ranks: Broadcast) -> Encoder:
    """One is kept per worker process and vocabulary."""
    key = ranks.value.size, int(ranks.value.pairs.sum())
    if key not in _encoders:
        _encoders[key] = Encoder(ranks.value)
    return _encoders[key]


def encode(docs: DataFrame, ranks: Ranks) -> DataFrame:
    """``doc_id``, ``ids``, ``offsets`` (the byte where each token begins) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # size of the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(shared)
        for batch in batches:
            for doc_ids, texts in steps(batch["doc_id"], batch["text"]):
                found = own.encode(texts)
                first = np.append(found.offset, 0)[np.minimum(found.edge[:-1], len(found.offset))]
                offset = found.offset - np.repeat(first, np.diff(found.edge))
                edge = pa.array(found.edge, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, pa.int64()),
                        pa.ListArray.from_arrays(edge, pa.array(found.ids, pa.int32())),
                        pa.ListArray.from_arrays(edge, pa.array(offset, pa.int64())),
                    ],
                    ["doc_id", "ids", "offsets"],
                )

    return id_and_text(docs).mapInArrow(run, "doc_id bigint, ids array<int>, offsets array<bigint>")


def decode(encoded: DataFrame, ranks: Ranks) -> DataFrame:
    """``doc_id`` and the bytes of ``ids``."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(shared)
        for batch in batches:
            ids = batch["ids"].flatten().to_numpy(zero_copy_only=False)
            edge = np.concatenate([[0], np.cumsum(batch["ids"].value_lengths().to_numpy(zero_copy_only=False))])
            size = own.ranks.length[ids]
            texts = own.decode(Encoded(ids, edge, np.cumsum(size) - size))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.binary())], ["doc_id", "body"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, body binary")


def _decimals(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The decimal of every id with a comma, as stretches of one array."""
    written = [b"%d," % i for i in range(size)]
    length = np.array([len(w) for w in written], dtype=np.int64)
    return np.frombuffer(b"".join(written), dtype=np.uint8), np.cumsum(length) - length, length


def round_trip(docs: DataFrame, ranks: Ranks) -> DataFrame:
    """Digests of the ids of every document and of the bytes decoded from them."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(shared)
        body, begin, length = _decimals(own.ranks.size)
        for batch in batches:
            for doc_ids, texts in steps(batch["doc_id"], batch["text"]):
                found = own.encode(texts)
                written = expand(body, begin[found.ids], length[found.ids]).tobytes()
                cuts = np.concatenate([[0], np.cumsum(length[found.ids])])[found.edge].tolist()
                listed = [written[a : max(a, b - 1)] for a, b in zip(cuts, cuts[1:], strict=False)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(doc_ids, pa.int64()),
                        "n_tokens": pa.array(np.diff(found.edge), pa.int64()),
                        "ids_sha256": [hashlib.sha256(x).hexdigest() for x in listed],
                        "decoded_sha256": [hashlib.sha256(x).hexdigest() for x in own.decode(found)],
                    }
                )

    return id_and_text(docs).mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )


MULTI = "byte_bpe_multi_50k.tiktoken"


def op4_byte_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    ranks = Ranks.from_tiktoken(path or public_tokenizers.path(MULTI))
    return round_trip(table(spark, sf_dir, "documents"), ranks)
