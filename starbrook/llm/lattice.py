"""Unigram lattice likelihood of words: all segmentations into the pieces of an existing vocabulary.

A word is a mark for its beginning and its bytes. Pieces are byte strings; every byte is a piece, so
every word has a segmentation. The lattice has a state before and after each byte and an arc for every
piece that occurs at a place; its weight is the logarithm of the piece's probability. The forward
recursion adds up, in logarithms, the probabilities of all paths to a state; the last state holds the
marginal probability of the word. The same values, walked backwards, give the expected number of times
that each piece is used, from which its probability is estimated anew.

All places of many words walk the piece trie together, and states at the same offset in their words
are computed together, so the steps are a few numpy operations for each byte of the longest word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

MARK = 0x20  # begins a word; a word holds no white space
_SPACED = set(b"\x09\x0a\x0b\x0c\x0d\x20")
# A score of this vocabulary is minus the rank of a piece; its first weight is 1 / (rank + 10).
RANK_SHIFT = 10.0
LAST_RANK = 40_000.0  # of single bytes, which have no score


@dataclass(frozen=True)
class Pieces:
    """A trie over the pieces that can occur in folded words. ``after[node, byte]`` is the next node,
    0 for none; ``piece[node]`` the piece that ends there, or -1; ``prior`` the pieces' first weights,
    the last of which belongs to the end of a text."""

    after: np.ndarray
    piece: np.ndarray
    prior: np.ndarray

    @property
    def count(self) -> int:
        return len(self.prior) - 1


def pieces(path: str) -> Pieces:
    """From a sentencepiece model file; its scores order the pieces."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    ranks: dict[bytes, float] = {}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
            continue
        text = model.id_to_piece(i)
        body = text.removeprefix("▁").encode()
        held = (b" " if text.startswith("▁") else b"") + body
        # pieces with white space or A-Z inside occur in no folded word
        if held and not _SPACED & set(body) and not any(0x41 <= b <= 0x5A for b in body):
            ranks.setdefault(held, -model.get_score(i))
    for byte in range(256):
        ranks.setdefault(bytes([byte]), LAST_RANK)
    return trie(ranks)


def trie(ranks: dict[bytes, float]) -> Pieces:
    nodes: dict[bytes, int] = {b"": 0}
    steps: list[tuple[int, int, int]] = []
    ends: list[int] = []
    for text in ranks:
        for k in range(1, len(text) + 1):
            if text[:k] not in nodes:
                nodes[text[:k]] = len(nodes)
                steps.append((nodes[text[: k - 1]], text[k - 1], nodes[text[:k]]))
        ends.append(nodes[text])
    kind = np.uint16 if len(nodes) < 1 << 16 else np.uint32
    after = np.zeros((len(nodes), 256), dtype=kind)
    at = np.array(steps)
    after[at[:, 0], at[:, 1]] = at[:, 2]
    piece = np.full(len(nodes), -1, dtype=np.int32)
    piece[ends] = np.arange(len(ends))
    weight = 1 / (np.array([*ranks.values(), 0.0]) + RANK_SHIFT)
    return Pieces(after, piece, weight / weight.sum())


@dataclass
class Lattice:
    """The arcs of many words in the order of the offset of their ends."""

    source: np.ndarray
    target: np.ndarray
    piece: np.ndarray
    groups: list[tuple[int, int]]
    first: np.ndarray  # states in which words begin and end
    last: np.ndarray


def lattice(words: list[bytes], vocabulary: Pieces) -> Lattice:
    # the mark after the last word ends all matches, as no piece has one inside
    data = np.frombuffer(b" " + b" ".join(words) + b" ", dtype=np.uint8)
    size = np.array([len(w) + 1 for w in words], dtype=np.int64)
    begin = np.cumsum(size) - size
    place = np.arange(len(data) - 1)
    node = np.zeros(len(place), dtype=np.int64)
    found = []
    length = 0
    while len(place):
        node = vocabulary.after[node, data[place + length]].astype(np.int64)
        alive = node > 0
        place, node = place[alive], node[alive]
        length += 1
        piece = vocabulary.piece[node]
        ends = piece >= 0
        found.append((place[ends], np.full(ends.sum(), length), piece[ends]))
        # a place whose match reached the closing mark has been dropped with it
        inside = place + length < len(data)
        place, node = place[inside], node[inside]
    place, length, piece = (np.concatenate(x) for x in zip(*found, strict=True))
    word = np.repeat(np.arange(len(words)), size)
    source = place + word[place]  # a word has one state more than it has bytes
    target = source + length
    offset = place + length - begin[word[place]]
    order = np.lexsort((target, offset))
    edges = np.flatnonzero(np.diff(offset[order])) + 1
    bounds = [0, *edges.tolist(), len(order)]
    first = begin + np.arange(len(words))
    return Lattice(
        source[order],
        target[order],
        piece[order],
        list(zip(bounds, bounds[1:], strict=False)),
        first,
        first + size,
    )


def forward(arcs: Lattice, log_weight: np.ndarray) -> np.ndarray:
    """Logarithm of the probability of all paths to each state."""
    alpha = np.full(int(arcs.last[-1]) + 1, -np.inf)
    alpha[arcs.first] = 0.0
    weight = log_weight[arcs.piece]
    for a, b in arcs.groups:
        target = arcs.target[a:b]
        heads = np.concatenate([[0], np.flatnonzero(np.diff(target)) + 1])
        alpha[target[heads]] = np.logaddexp.reduceat(alpha[arcs.source[a:b]] + weight[a:b], heads)
    return alpha


def word_scores(words: list[bytes], vocabulary: Pieces, log_weight: np.ndarray) -> np.ndarray:
    """Natural logarithm of the marginal probability of each word."""
    if not words:
        return np.zeros(0)
    arcs = lattice(words, vocabulary)
    return forward(arcs, log_weight)[arcs.last]


def expected_pieces(
    words: list[bytes], times: np.ndarray, vocabulary: Pieces, log_weight: np.ndarray
) -> np.ndarray:
    """How often each piece is used by the words, each as often as ``times`` says, over all segmentations
    by their probability."""
    if not words:
        return np.zeros(vocabulary.count)
    arcs = lattice(words, vocabulary)
    alpha = forward(arcs, log_weight)
    weight = log_weight[arcs.piece]
    use = np.zeros(len(alpha))
    use[arcs.last] = times
    share = np.zeros(len(arcs.piece))
    for a, b in reversed(arcs.groups):
        source, target = arcs.source[a:b], arcs.target[a:b]
        share[a:b] = use[target] * np.exp(alpha[source] + weight[a:b] - alpha[target])
        np.add.at(use, source, share[a:b])
    return np.bincount(arcs.piece, weights=share, minlength=vocabulary.count)
