"""Exact deduplication against a history, by a minimal perfect hash over its distinct digests.

The digest of a text is the SHA-256 of its UTF-8 after lower-casing A-Z. ``build_index`` turns the
distinct digests of a history into shards; a shard is one row that holds a minimal perfect hash of
its digests (hash and displace: a displacement for each bucket of digests, one slot for each
digest), the full digest in every slot, and the slot's winner and number of rows. ``match`` sends
the distinct digests of a delivery to the shards, computes each one's slot and compares all 32
bytes: equal digests are repeats of the slot's group, and the others are grouped among themselves.

Digests are combined before every shuffle, so a group of copies of any size arrives as one row. There
are as many shards as the distinct digests of history and delivery together ask for, so what meets in
one of them is bounded however the rows are split between the two. Only the last step, which hands
each document its group, joins by digest; it is a plain equi-join that adaptive execution splits
when one text holds a large part of the rows.

Defined results: a null text counts as empty, and empty texts are equal. Of equal texts the row
with the largest id stays; a null id is smaller than any other. Rows that repeat both id and text
are returned each, with the same values; ``drop_repeats`` leaves one of them. An empty table gives
an empty result, and an empty history has no members. Columns beyond ``doc_id`` and ``text`` are
ignored by ``exact_groups`` and kept by ``drop_repeats``.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starbrook.llm.common import id_and_text, table, without
from starbrook.session import cut_lineage

SHARD_DIGESTS = 50_000  # digests a shard holds on average
BUCKET_DIGESTS = 3
DIRECT = 1 << 31  # a displacement from here on names the slot of a bucket's only digest
DIGEST_BYTES = 32

SHARD_SCHEMA = "shard bigint, displacements binary, digests binary, winners binary, counts binary"
GROUP_SCHEMA = "digest binary, winner bigint, n bigint"


def digest(text: Column) -> Column:
    """SHA-256 of the text with A-Z, and no other letters, lower-cased."""
    folded = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.unhex(F.sha2(folded, 256))


def _groups(digests: DataFrame) -> DataFrame:
    """One row a digest: its largest id and its number of rows."""
    return digests.groupBy("digest").agg(F.max("doc_id").alias("winner"), F.count(F.lit(1)).alias("n"))


# The minimal perfect hash of one shard.


def _parts(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Three independent 64-bit numbers of each digest (rows of 32 bytes). The first 8 bytes choose
    the shard, so they are not used here."""
    numbers = digests.view("<u8").reshape(-1, 4)
    return numbers[:, 1], numbers[:, 2], numbers[:, 3]


def _slots(first: np.ndarray, second: np.ndarray, displacement: np.ndarray, n: int) -> np.ndarray:
    """Slot of a digest under its bucket's displacement d: a mix of d chooses among hash functions."""
    with np.errstate(over="ignore"):
        mixed = first ^ (second + np.uint64(0x9E3779B97F4A7C15) * displacement)
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
    hashed = (mixed % np.uint64(n)).astype(np.int64)
    named = displacement.astype(np.int64) - DIRECT
    return np.where(named >= 0, named, hashed)


def perfect_hash(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Displacements by bucket and the slot of each of the distinct ``digests``.

    Buckets are placed from the largest to the smallest. All buckets of one size try the next
    displacement together; those whose slots are free and that do not meet each other are settled.
    Buckets of one digest take the slots that are left.
    """
    n = len(digests)
    buckets = max(1, -(-n // BUCKET_DIGESTS))
    first, second, third = _parts(digests)
    bucket = (third % np.uint64(buckets)).astype(np.int64)
    size = np.bincount(bucket, minlength=buckets)
    displacement = np.zeros(buckets, dtype=np.uint64)
    slot = np.full(n, -1, dtype=np.int64)
    taken = np.zeros(n, dtype=bool)
    order = np.argsort(bucket, kind="stable")
    begin = np.concatenate([[0], np.cumsum(size)])
    claim = np.full(n, buckets, dtype=np.int64)
    for k in sorted(set(size[size > 1].tolist()), reverse=True):
        todo = np.flatnonzero(size == k)
        members = order[begin[todo][:, None] + np.arange(k)]
        tries = np.uint64(0)
        while len(todo):
            tries += np.uint64(1)
            at = _slots(first[members], second[members], np.full(members.shape, tries), n)
            rows = np.flatnonzero(~taken[at].any(axis=1))
            ordered = np.sort(at[rows], axis=1)
            rows = rows[(ordered[:, 1:] != ordered[:, :-1]).all(axis=1)]
            if not len(rows):
                continue
            # of buckets that want the same slot in this round, the first gets it
            np.minimum.at(claim, at[rows].ravel(), np.repeat(rows, k))
            won = rows[(claim[at[rows]] == rows[:, None]).all(axis=1)]
            claim[at[rows].ravel()] = buckets
            displacement[todo[won]] = tries
            slot[members[won]] = at[won]
            taken[at[won].ravel()] = True
            left = np.ones(len(todo), dtype=bool)
            left[won] = False
            todo, members = todo[left], members[left]
    single = np.flatnonzero(size == 1)
    free = np.flatnonzero(~taken)
    displacement[single] = (free + DIRECT).astype(np.uint64)
    slot[order[begin[single]]] = free
    return displacement, slot


def _rows_of(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.uint8).reshape(-1, DIGEST_BYTES)


def _build_shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    digests = _rows_of(rows["digest"])
    displacement, slot = perfect_hash(digests)
    by_slot = np.argsort(slot)
    winners = rows["winner"].fillna(-(2**63)).to_numpy(np.int64)
    return pd.DataFrame(
        {
            "shard": [key[0]],
            "displacements": [displacement.astype("<u4").tobytes()],
            "digests": [digests[by_slot].tobytes()],
            "winners": [winners[by_slot].astype("<i8").tobytes()],
            "counts": [rows["n"].to_numpy(np.int64)[by_slot].astype("<i8").tobytes()],
        }
    )


def shard_of(shards: int) -> Column:
    return F.pmod(F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("bigint"), F.lit(shards))


def build_index(groups: DataFrame, shards: int) -> DataFrame:
    """The shards of an index over distinct digests (``GROUP_SCHEMA``)."""
    return (
        groups.withColumn("shard", shard_of(shards)).groupBy("shard").applyInPandas(_build_shard, SHARD_SCHEMA)
    )


def _look_up(shard: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
    """For the digests of a delivery and for those of the shard itself: the group they belong to."""
    winners = asked["winner"].fillna(-(2**63)).to_numpy(np.int64)
    counts = asked["n"].to_numpy(np.int64)
    if not len(shard):
        return _answers(asked["digest"], winners, counts)
    held = np.frombuffer(shard["digests"].iloc[0], dtype=np.uint8).reshape(-1, DIGEST_BYTES)
    held_winners = np.frombuffer(shard["winners"].iloc[0], dtype="<i8").copy()
    held_counts = np.frombuffer(shard["counts"].iloc[0], dtype="<i8").copy()
    if len(asked):
        displacement = np.frombuffer(shard["displacements"].iloc[0], dtype="<u4").astype(np.uint64)
        digests = _rows_of(asked["digest"])
        first, second, third = _parts(digests)
        bucket = (third % np.uint64(len(displacement))).astype(np.int64)
        slot = _slots(first, second, displacement[bucket], len(held))
        member = (held[slot] == digests).all(axis=1)
        # a delivery asks for a digest once, so no slot is met twice
        held_winners[slot[member]] = np.maximum(held_winners[slot[member]], winners[member])
        held_counts[slot[member]] += counts[member]
        new = ~member
        fresh = _answers(asked["digest"][new], winners[new], counts[new])
    else:
        fresh = None
    known = _answers([row.tobytes() for row in held], held_winners, held_counts)
    return known if fresh is None else pd.concat([known, fresh], ignore_index=True)


def _answers(digests, winners: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
    winner = pd.array(winners, dtype="Int64")
    winner[winners == -(2**63)] = pd.NA
    return pd.DataFrame({"digest": list(digests), "winner": winner, "n": counts})


def match(index: DataFrame, delivery: DataFrame, shards: int) -> DataFrame:
    """Groups of history and delivery together (``GROUP_SCHEMA``), one row a digest."""
    asked = delivery.withColumn("shard", shard_of(shards)).groupBy("shard")
    return index.groupBy("shard").cogroup(asked).applyInPandas(_look_up, GROUP_SCHEMA)


def shards_for(digests: int) -> int:
    """Shards for the digests of both sides, as both meet in one group of a cogroup."""
    return max(1, -(-digests // SHARD_DIGESTS))


def merged_groups(history: DataFrame, delivery: DataFrame) -> DataFrame:
    """Groups of equal digests over both, the second looked up in an index of the first."""
    known, asked = cut_lineage(_groups(history)), cut_lineage(_groups(delivery))
    shards = shards_for(known.count() + asked.count())
    index = cut_lineage(build_index(known, shards))
    return match(index, asked, shards)


def _digests(docs: DataFrame) -> DataFrame:
    return id_and_text(docs).select("doc_id", digest(F.col("text")).alias("digest"))


def _deliveries(digests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A table that comes whole is two deliveries: ids up to the middle, and the rest."""
    middle = digests.agg(F.expr("(min(doc_id) div 2) + (max(doc_id) div 2)")).first()[0]
    later = F.coalesce(F.col("doc_id") > F.lit(middle).cast("bigint"), F.lit(False))
    return digests.filter(~later), digests.filter(later)


def exact_groups(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` of every row."""
    digests = cut_lineage(_digests(docs))
    groups = merged_groups(*_deliveries(digests))
    # Most digests have one row, which is its own group; they need not meet an answer.
    shared = groups.filter("n > 1").select("digest", F.struct("winner", "n").alias("group"))
    found = digests.join(shared, "digest", "left")
    keep = F.when(F.col("group").isNull(), F.col("doc_id")).otherwise(F.col("group.winner"))
    return found.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group.n", F.lit(1).cast("bigint")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_repeats(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Only the rows that go are joined back, by id and digest.
    """
    digests = cut_lineage(_digests(docs))
    groups = merged_groups(*_deliveries(digests))
    shared = groups.filter("n > 1").select("digest", "winner")
    going = (
        digests.join(shared, "digest")
        .filter(~F.col("doc_id").eqNullSafe(F.col("winner")))
        .select("doc_id", "digest")
    )
    own = digest(F.coalesce(F.col("text").cast("string"), F.lit("")))
    kept = without(docs, [F.col("doc_id").cast("bigint"), own], going)
    if digests.groupBy("digest", "doc_id").count().filter("count > 1").limit(1).count():
        # rows that repeat id and text are one document
        keyed = kept.select(F.struct(F.col("doc_id"), own).alias("key"), F.struct("*").alias("row"))
        kept = keyed.groupBy("key").agg(F.first("row").alias("row")).select("row.*")
    return kept


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))
