"""Near-duplicates by BagMinHash signatures, banding, and verified multiset overlap.

Texts are multisets of five-word shingles of their lower-cased words. Two texts are linked when
their weighted Jaccard similarity is 0.8 or more, and a class is a connected component of links.

1. One pass computes for every text a digest of its multiset and the bands of its signature
   (``sketch``). Equal multisets are one node from here on.
2. Nodes that share a band meet in a bucket. Buckets of equal membership are taken once.
3. Every bucket is searched for links with the exact shingles. A bucket is dealt out in blocks of
   bounded size, each of which also gets the bucket's hubs, a few members chosen by hash; within a
   block a breadth-first search compares a found text with those not yet found, so no pairs are
   written and dense blocks cost little. What comes out is a spanning forest.
4. Buckets of several blocks may hide links across blocks that no hub stands for. The members that
   are not in a bucket's largest component are then compared, block by block, with all the others.
   Nothing is left out, and no task holds more than two blocks.

With 20 bands of 4 components a link of similarity 0.8 shares no band with probability 2.6e-5.

Defined results: a null text counts as empty; empty texts are equal to each other and similar to
nothing else. A text of fewer than five words is one shingle. One document of a class stays: that of
the smallest id, a null id being the largest, and among equal ids that of the smallest hash of its
text. So near-copies that share an id, or that have none, do not all stay; rows that repeat both id
and text are one document, and stay or go together. An empty table gives an empty result. Columns beyond ``doc_id`` and ``text`` are ignored by ``near_groups`` and kept by
``drop_copies``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starbrook.llm import sketch as S
from starbrook.llm.common import counted, id_and_text, steps, table, without
from starbrook.llm.links import components
from starbrook.session import cut_lineage

SIMILARITY = 0.8
BANDS = 20
BLOCK = 512  # members compared in one task
HUBS = 24
SMALL = 64  # buckets up to this size share a task
TASK_ROWS = 2_000

SKETCH = "doc_id bigint, text_hash bigint, node binary, bands array<bigint>"


def _grouped(texts: list[str]):
    """Boundaries of each text in its shingle arrays, and the arrays."""
    owner, value, weight = S.shingles(texts)
    return np.searchsorted(owner, np.arange(len(texts) + 1)), owner, value, weight


def _digest(value: np.ndarray, weight: np.ndarray) -> bytes:
    body = value.astype("<u8").tobytes() + weight.astype("<u4").tobytes()
    return hashlib.blake2b(body, digest_size=16).digest()


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = 0
        for ids, texts in steps(batch["doc_id"], batch["text"]):
            hashes = batch["text_hash"].slice(done, len(ids))
            done += len(ids)
            edge, owner, value, weight = _grouped(texts)
            signed = S.signatures(len(texts), owner, value, weight).reshape(len(texts), BANDS, -1)
            bands = np.zeros((len(texts), BANDS), dtype=np.uint64)
            for k in range(signed.shape[2]):
                bands = S.mix(bands ^ signed[:, :, k])
            keys = [b if e > s else [] for b, s, e in zip(bands.astype(np.int64), edge, edge[1:], strict=False)]
            nodes = [_digest(value[s:e], weight[s:e]) for s, e in zip(edge, edge[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    hashes,
                    pa.array(nodes, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                ["doc_id", "text_hash", "node", "bands"],
            )


def sketch(docs: DataFrame) -> DataFrame:
    rows = id_and_text(docs).withColumn("text_hash", F.xxhash64("text"))
    return rows.mapInArrow(_sketch, SKETCH)


def _buckets(nodes: DataFrame) -> DataFrame:
    """``bucket``, ``n``, ``node`` of the buckets with at least two members, equal ones once."""
    placed = nodes.select("node", F.posexplode("bands").alias("band", "key")).select(
        "node", F.xxhash64("band", "key").alias("bucket")
    )
    sizes = placed.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("node")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit(1), F.col("node"))).alias("y"),
    )
    once = sizes.filter("n > 1").groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket"))
    return placed.join(once.select("bucket", "n"), "bucket")


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, texts in steps(batch["doc_id"], batch["text"]):
            edge, _, value, weight = _grouped(texts)
            spans = list(zip(edge, edge[1:], strict=False))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_digest(value[s:e], weight[s:e]) for s, e in spans], pa.binary()),
                    pa.array([value[s:e].astype("<u8").tobytes() for s, e in spans], pa.binary()),
                    pa.array([weight[s:e].astype("<u4").tobytes() for s, e in spans], pa.binary()),
                ],
                ["node", "value", "weight"],
            )


class Block:
    """Shingle multisets of some texts, for comparing one with many."""

    def __init__(self, value: list[bytes], weight: list[bytes]):
        sizes = np.array([len(v) // 8 for v in value])
        _, self.shingle = np.unique(np.frombuffer(b"".join(value), dtype="<u8"), return_inverse=True)
        self.weight = np.frombuffer(b"".join(weight), dtype="<u4").astype(np.int64)
        self.owner = np.repeat(np.arange(len(sizes)), sizes)
        self.edge = np.concatenate([[0], np.cumsum(sizes)])
        self.total = np.bincount(self.owner, weights=self.weight, minlength=len(sizes))
        self.scratch = np.zeros(self.shingle.max(initial=0) + 1, dtype=np.int64)

    def linked(self, one: int, others: np.ndarray) -> np.ndarray:
        """Those of ``others`` that are similar to ``one``."""
        # similar multisets have similar sizes
        least, most = self.total[one] * SIMILARITY, self.total[one] / SIMILARITY
        others = others[(self.total[others] >= least - 1e-9) & (self.total[others] <= most + 1e-9)]
        if not len(others):
            return others
        own = slice(self.edge[one], self.edge[one + 1])
        self.scratch[self.shingle[own]] = self.weight[own]
        sizes = self.edge[others + 1] - self.edge[others]
        begin = np.cumsum(sizes) - sizes
        at = np.arange(sizes.sum()) - np.repeat(begin - self.edge[others], sizes)
        common = np.add.reduceat(np.minimum(self.scratch[self.shingle[at]], self.weight[at]), begin)
        self.scratch[self.shingle[own]] = 0
        union = self.total[one] + self.total[others] - common
        return others[common >= SIMILARITY * union - 1e-9]

    def forest(self) -> list[tuple[int, int]]:
        """Links that connect the texts of the block as all its links do."""
        links, unseen = [], np.arange(len(self.total))
        while len(unseen):
            queue, unseen = [unseen[0]], unseen[1:]
            while queue and len(unseen):
                one = queue.pop()
                found = self.linked(one, unseen)
                if len(found):
                    links.extend((int(one), int(f)) for f in found)
                    queue.extend(found)
                    unseen = np.setdiff1d(unseen, found, assume_unique=True)
        return links


EDGES = "u binary, v binary"


def _search(rows: pd.DataFrame) -> pd.DataFrame:
    found = []
    for _, part in rows.groupby(["bucket", "block"], sort=False):
        if len(part) > 1:
            nodes = part["node"].tolist()
            block = Block(part["value"].tolist(), part["weight"].tolist())
            found.extend((nodes[a], nodes[b]) for a, b in block.forest())
    return pd.DataFrame(found, columns=["u", "v"])


def _search_rest(rows: pd.DataFrame) -> pd.DataFrame:
    """Compares the asking rows of a group with the rows of its block that are in other components."""
    found = []
    rows = rows.reset_index(drop=True)
    block = Block(rows["value"].tolist(), rows["weight"].tolist())
    nodes, component = rows["node"].tolist(), rows["component"].to_numpy()
    asks = rows["asks"].to_numpy()
    held = np.flatnonzero(~asks)
    for one in np.flatnonzero(asks):
        others = held[component[held] != component[one]]
        seen = set()
        for other in block.linked(one, others):
            if component[other] not in seen:  # one link to a component is enough
                seen.add(component[other])
                found.append((nodes[one], nodes[other]))
    return pd.DataFrame(found, columns=["u", "v"])


def _part(n_rows: int) -> Column:
    """Blocks of small buckets are gathered into tasks of about ``TASK_ROWS`` rows."""
    tasks = max(1, n_rows // TASK_ROWS)
    shared = F.pmod("bucket", F.lit(tasks))
    return F.when(F.col("n") <= SMALL, shared).otherwise(F.xxhash64("bucket", "block"))


def _blocks() -> Column:
    return F.ceil(F.col("n") / BLOCK).cast("int")


def _links(members: DataFrame, shingles: DataFrame, n_rows: int) -> DataFrame:
    """A spanning forest of the links within blocks and to hubs."""
    hub = (_blocks() > 1) & (F.pmod(F.xxhash64(F.lit("hub"), "bucket", "node"), "n") < HUBS)
    own = F.array(F.pmod(F.xxhash64("node"), _blocks()).cast("int"))
    dealt = members.withColumn(
        "block", F.explode(F.when(hub, F.sequence(F.lit(0), _blocks() - 1)).otherwise(own))
    )
    rows = dealt.withColumn("part", _part(n_rows)).join(shingles, "node")
    return rows.groupBy("part").applyInPandas(_search, EDGES)


def _links_of_rest(members: DataFrame, shingles: DataFrame, known: DataFrame) -> DataFrame:
    """Links across blocks, for members of large buckets that no hub joined to the largest part."""
    large = members.filter(_blocks() > 1).join(known, "node", "left")
    large = cut_lineage(large.withColumn("component", F.coalesce("component", "node")))
    parts = large.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("size"))
    largest = parts.groupBy("bucket").agg(
        F.max(F.struct("size", "component")).alias("most"), F.sum("size").alias("members")
    )
    asking = large.join(largest, "bucket").withColumn("asks", F.col("component") != F.col("most.component"))
    chunks = F.ceil((F.col("members") - F.col("most.size")) / BLOCK).cast("int")
    dealt = asking.withColumn("chunks", chunks).filter("chunks > 0").withColumn("blocks", _blocks())
    place = F.xxhash64("node")
    columns = ["bucket", "chunk", "block", "node", "component", "asks"]
    askers = (
        dealt.filter("asks")
        .withColumn("chunk", F.pmod(place, "chunks").cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(*columns)
    )
    asked = (
        dealt.withColumn("asks", F.lit(False))
        .withColumn("block", F.pmod(place, "blocks").cast("int"))
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(*columns)
    )
    rows = askers.unionByName(asked).join(shingles, "node")
    return rows.groupBy("bucket", "chunk", "block").applyInPandas(_search_rest, EDGES)


def _precedence() -> Column:
    """A total order of documents; the least of a class stays."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")


def near_classes(docs: DataFrame, sketched: DataFrame) -> DataFrame:
    """``node``, ``keeper``, ``class_size`` of the classes with more than one document."""
    nodes = sketched.groupBy("node").agg(
        F.min("doc_id").alias("first"),
        F.min(_precedence()).alias("keeper"),
        F.count(F.lit(1)).alias("copies"),
        F.first("bands").alias("bands"),
    )
    nodes = cut_lineage(nodes)
    members = cut_lineage(_buckets(nodes))
    n_rows = members.count()
    wanted = counted(
        members.select("node").distinct().join(nodes.select("node", "first"), "node").select("first").distinct()
    )
    texts = id_and_text(docs)
    chosen = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["first"]), "left_semi")
    own = chosen.mapInArrow(_shingles, "node binary, value binary, weight binary")
    shingles = cut_lineage(own.groupBy("node").agg(F.first("value").alias("value"), F.first("weight").alias("weight")))
    links = cut_lineage(_links(members, shingles, n_rows))
    known = components(links)
    if members.filter(_blocks() > 1).limit(1).count():
        more = cut_lineage(_links_of_rest(members, shingles, known))
        known = components(links.unionByName(more))
    joined = nodes.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    classes = joined.groupBy("component").agg(
        F.min("keeper").alias("keeper"), F.sum("copies").alias("class_size")
    )
    shared = classes.filter("class_size > 1")
    return joined.select("node", "component").join(shared, "component").select("node", "keeper", "class_size")


def _grouped_rows(docs: DataFrame) -> DataFrame:
    sketched = cut_lineage(sketch(docs))
    classes = near_classes(docs, sketched).select("node", F.struct("keeper", "class_size").alias("class"))
    found = sketched.select("doc_id", "text_hash", "node").join(classes, "node", "left")
    alone = F.col("class").isNull()
    first = F.when(alone, F.col("doc_id")).otherwise(F.col("class.keeper.doc_id"))
    return found.select(
        "doc_id",
        "text_hash",
        first.alias("class_id"),
        F.coalesce("class.class_size", F.lit(1).cast("bigint")).alias("class_size"),
        (alone | _precedence().eqNullSafe(F.col("class.keeper"))).alias("kept"),
    )


def near_groups(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``class_id``, ``class_size``, ``kept`` of every row."""
    return _grouped_rows(docs).drop("text_hash")


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stand for their class, with all their columns."""
    going = _grouped_rows(docs).filter("not kept").select("doc_id", "text_hash")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return without(docs, [F.col("doc_id").cast("bigint"), F.xxhash64(text)], going)


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))
