"""BagMinHash signatures of word shingle multisets, on numpy arrays.

A text is the multiset of its runs of five words (all its words, if it has fewer). For a shingle
that occurs w times, think of a Poisson process in time on every unit of weight up to w, each of
whose points falls on one of the signature's components at random; a component's value is the
earliest point that falls on it. Two texts share the processes of the weight they share, so a
component agrees with probability equal to their weighted Jaccard similarity.

The units of weight are taken together in levels, (0,1], (1,2], (2,4], (4,8], ...: one process with
a rate in proportion to the level's width, whose points carry the unit they fall on. Points on units
above w do not count. Processes are followed only up to the time by which all components are
expected to be filled, and further where some are not, so most shingles cost one hash.
"""

from __future__ import annotations

import hashlib

import numpy as np

SHINGLE = 5
COMPONENTS = 80

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xBF58476D1CE4E5B9)
_C = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    with np.errstate(over="ignore"):
        x = x + _A
        x = (x ^ (x >> np.uint64(30))) * _B
        x = (x ^ (x >> np.uint64(27))) * _C
        return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    MOST = 150_000

    def __missing__(self, word: str) -> int:
        if len(self) > self.MOST:
            self.clear()
        digest = hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest()
        value = self[word] = int.from_bytes(digest, "little")
        return value


_hashes = WordHashes()


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, weight) of the distinct shingles of each text, ordered by text and shingle."""
    hashed, counts = [], np.empty(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        words = text.lower().split()
        counts[i] = len(words)
        hashed.extend(map(_hashes.__getitem__, words))
    flat = np.array(hashed, dtype=np.uint64)
    pieces = np.where(counts >= SHINGLE, counts - SHINGLE + 1, np.minimum(counts, 1))
    owner = np.repeat(np.arange(len(texts)), pieces)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(texts) else counts
    place = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces) + first[owner]
    value = np.zeros(len(place), dtype=np.uint64)
    padded = np.concatenate([flat, np.zeros(SHINGLE, dtype=np.uint64)])
    end = (first + counts)[owner]
    for k in range(SHINGLE):
        inside = place + k < end
        value = mix(value ^ np.where(inside, padded[place + k], np.uint64(k)))
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(new)
    weight = np.diff(np.append(starts, len(value)))
    return owner[starts], value[starts], weight


def _levels(owner: np.ndarray, value: np.ndarray, weight: np.ndarray):
    """One process for every level that a shingle's weight reaches: owner, seed, width, most unit."""
    parts, level, low, width = [], 0, 0, 1
    while True:
        reached = weight > low
        if not reached.any():
            break
        seed = mix(value[reached] ^ mix(np.array([level], dtype=np.uint64)))
        parts.append(
            (owner[reached], seed, np.full(len(seed), width, dtype=np.float64), weight[reached] - low)
        )
        low, width, level = low + width, max(1, low + width), level + 1
    return [np.concatenate(c) for c in zip(*parts, strict=True)]


def _uniform(seed: np.ndarray) -> np.ndarray:
    return ((seed >> np.uint64(11)).astype(np.float64) + 0.5) / 9007199254740992.0


def signatures(texts: int, owner: np.ndarray, value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """One row of ``COMPONENTS`` 64-bit values a text; texts without shingles have zeros."""
    m = COMPONENTS
    best = np.full(texts * m, np.inf)
    name = np.zeros(texts * m, dtype=np.uint64)
    if not len(owner):
        return name.reshape(texts, m)
    total = np.bincount(owner, weights=weight, minlength=texts)
    # time in units in which a component receives one point from a unit of weight on average
    until = np.divide(np.log(m) + 1.0, total, out=np.zeros(texts), where=total > 0)
    owner, seed, width, most = _levels(owner, value, weight)
    time = -np.log(_uniform(mix(seed))) / (m * width)
    step = np.zeros(len(owner), dtype=np.uint64)
    while len(owner):
        due = time <= until[owner]
        o, s, w, t, k = owner[due], seed[due], width[due], time[due], step[due]
        waiting = [[x[~due] for x in (owner, seed, width, most, time, step)]]
        most_due = most[due]
        while len(o):
            mark = mix(s ^ mix(k * np.uint64(3) + np.uint64(1)))
            counted = _uniform(mix(mark)) * w < most_due
            slot = o * m + (mark % np.uint64(m)).astype(np.int64)
            at, when, what = slot[counted], t[counted], mark[counted]
            np.minimum.at(best, at, when)
            earliest = when == best[at]
            name[at[earliest]] = what[earliest]
            # the next point of each of these processes
            k = k + np.uint64(1)
            t = t - np.log(_uniform(mix(s ^ mix(k * np.uint64(3) + np.uint64(2))))) / (m * w)
            go = t <= until[o]
            waiting.append([x[~go] for x in (o, s, w, most_due, t, k)])
            o, s, w, most_due, t, k = o[go], s[go], w[go], most_due[go], t[go], k[go]
        open_text = np.isinf(best.reshape(texts, m)).any(axis=1) & (total > 0)
        until = np.where(open_text, until * 1.5, 0.0)
        if not open_text.any():
            break
        for part in waiting:
            still = open_text[part[0]]
            part[:] = [x[still] for x in part]
        owner, seed, width, most, time, step = (np.concatenate(c) for c in zip(*waiting, strict=True))
    return name.reshape(texts, m)


def estimate(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())
