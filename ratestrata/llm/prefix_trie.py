"""Prefix trie of conversations, built from adaptive radix trees over fixed-width big-endian turn ids.

A turn's id is a 128-bit digest of its role and text, `ID` bytes; texts never leave the tasks that read them. A conversation's key
is its ids in order, and keys are range-partitioned together with conv_id, so that a sequence that a third of all
conversations repeat is split too. A task inserts its keys into an adaptive radix tree: inner nodes grow from 4 to 16, 48 and
256 children, and chains of single children are compressed into a node's prefix. Only byte depths that are a multiple of `ID`
are nodes of the trie.

Nodes of a range are complete but for those on the paths of its smallest and largest key, which neighbouring ranges may hold as well.
These, a few for each range, are merged by their digest, and what they add to the nodes above them is summed by doubling
pointers to ancestors, in rounds that grow with the logarithm of the depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ratestrata.llm.checksums import crc32_sql
from ratestrata.llm.common import Workspace, let_workers_import

ID = 16
#: Turns whose ids one tree holds, on average; a longer conversation is one compressed path.
TURNS_PER_TREE = 100_000
TURNS = "array<struct<id:binary,chars:int>>"
ROOT = bytes(ID)


class Node:
    """An inner node: the compressed `prefix` below its parent's byte, its children, and the conversations that end here.

    `kind` is the layout: 4 and 16 hold sorted bytes beside their children, 48 an index of all bytes into a list of
    children, 256 a child for each byte.
    """

    __slots__ = ("prefix", "kind", "bytes", "children", "ends")

    def __init__(self, prefix: bytes) -> None:
        self.prefix, self.kind, self.bytes, self.children, self.ends = prefix, 4, bytearray(), [], []

    def child(self, byte: int) -> Node | None:
        if self.kind <= 16:
            at = self.bytes.find(byte)
            return self.children[at] if at >= 0 else None
        if self.kind == 48:
            slot = self.bytes[byte]
            return self.children[slot - 1] if slot else None
        return self.children[byte]

    def put(self, byte: int, child: Node) -> None:
        """Add a child, or put another in the place of one."""
        if self.kind <= 16:
            at = self.bytes.find(byte)
            if at >= 0:
                self.children[at] = child
                return
            if len(self.children) == self.kind:
                self.grow()
                self.put(byte, child)
                return
            at = next((i for i, other in enumerate(self.bytes) if other > byte), len(self.bytes))
            self.bytes.insert(at, byte)
            self.children.insert(at, child)
        elif self.kind == 48:
            slot = self.bytes[byte]
            if slot:
                self.children[slot - 1] = child
            elif len(self.children) == 48:
                self.grow()
                self.put(byte, child)
            else:
                self.children.append(child)
                self.bytes[byte] = len(self.children)
        else:
            self.children[byte] = child

    def grow(self) -> None:
        if self.kind == 4:
            self.kind = 16
        elif self.kind == 16:
            index = bytearray(256)
            for slot, byte in enumerate(self.bytes):
                index[byte] = slot + 1
            self.kind, self.bytes = 48, index
        else:
            children = [self.children[slot - 1] if slot else None for slot in self.bytes]
            self.kind, self.bytes, self.children = 256, bytearray(), children

    def items(self) -> list[tuple[int, Node]]:
        """Bytes and children in the order of the bytes."""
        if self.kind <= 16:
            return list(zip(self.bytes, self.children))
        if self.kind == 48:
            return [(byte, self.children[slot - 1]) for byte, slot in enumerate(self.bytes) if slot]
        return [(byte, child) for byte, child in enumerate(self.children) if child is not None]


class Tree:
    def __init__(self) -> None:
        self.root = Node(b"")

    def insert(self, key: bytes, member: int) -> None:
        node, at = self.root, 0
        above, byte = None, 0
        while True:
            prefix = node.prefix
            if not key.startswith(prefix, at):
                rest = key[at : at + len(prefix)]
                same = next((i for i, (a, b) in enumerate(zip(prefix, rest)) if a != b), len(rest))
                upper = Node(prefix[:same])  # the prefix is cut; never at the root, whose prefix is empty
                upper.put(prefix[same], node)
                node.prefix = prefix[same + 1 :]
                above.put(byte, upper)
                node, prefix = upper, upper.prefix
            at += len(prefix)
            if at == len(key):
                node.ends.append(member)
                return
            above, byte = node, key[at]
            node = above.child(byte)
            at += 1
            if node is None:
                node = Node(key[at:])
                node.ends.append(member)
                above.put(byte, node)
                return

    def turns(self) -> Iterator[tuple[int, bytes | None, list[int]]]:
        """Turn-aligned nodes in the order of their keys, a node before those below it: `(depth, id of the last turn, ends)`."""
        yield 0, None, self.root.ends
        stack = [(child, bytes([byte]), 0) for byte, child in reversed(self.root.items())]
        while stack:
            node, begun, depth = stack.pop()  # `begun`: bytes since the last aligned depth
            path = begun + node.prefix
            whole = len(path) // ID
            for i in range(whole):
                last = (i + 1) * ID == len(path)
                yield depth + i + 1, path[i * ID : (i + 1) * ID], node.ends if last else []
            rest = path[whole * ID :]
            stack += [(child, rest + bytes([byte]), depth + whole) for byte, child in reversed(node.items())]


def below(node: bytes, turn: bytes) -> bytes:
    """The digest that names a node: of its parent's and its last turn's id."""
    return hashlib.blake2b(node + turn, digest_size=ID).digest()


_PARTIAL = (
    "node binary, parent binary, depth int, shared boolean, parent_shared boolean, conv_id long, parent_conv_id long, n_convs long,"
    " n_children long, n_leaves long, saved_chars long, chars int, ends array<long>"
)


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All keys of a range to rows of nodes.

    A shared node's numbers leave out what shared nodes, itself included, add on their own: merging counts those once.
    """
    tree, chars, low, high = Tree(), {}, None, None
    for batch in batches:
        for conv, turns in zip(batch.column("conv_id").to_pylist(), batch.column("turns").to_pylist()):
            key = b"".join(turn["id"] for turn in turns)
            chars.update((turn["id"], turn["chars"]) for turn in turns)
            tree.insert(key, conv)
            low, high = (key, key) if low is None else (min(low, key), max(high, key))
    if low is None:
        return
    border = {ROOT}
    for key in (low, high):
        node = ROOT
        for i in range(0, len(key), ID):
            node = below(node, key[i : i + ID])
            border.add(node)
    names, parents, depths, lengths, ends, path = [], [], [], [], [], []
    for depth, turn, own in tree.turns():
        del path[depth:]
        parents.append(path[-1] if path else -1)
        names.append(below(names[path[-1]], turn) if path else ROOT)
        depths.append(depth)
        lengths.append(chars[turn] if path else 0)
        ends.append(sorted(own))
        path.append(len(names) - 1)
    del tree
    size = len(names)
    n, least = [len(e) for e in ends], [e[0] if e else None for e in ends]
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    shared = [name in border for name in names]
    for i in range(size - 1, -1, -1):
        if not shared[i]:
            leaves[i] += children[i] == 0
            saved[i] += (n[i] - 1) * lengths[i]
        p = parents[i]
        if p >= 0:
            n[p] += n[i]
            least[p] = least[i] if least[p] is None else min(least[p], least[i])
            children[p] += not shared[i]
            leaves[p] += leaves[i]
            saved[p] += saved[i]
    for a in range(0, size, 5000):
        b = range(a, min(size, a + 5000))
        up = [parents[i] for i in b]
        yield pa.record_batch([
            pa.array(names[b.start : b.stop], pa.binary()), pa.array([names[p] if p >= 0 else None for p in up], pa.binary()),
            pa.array(depths[b.start : b.stop], pa.int32()), pa.array(shared[b.start : b.stop]), pa.array([p >= 0 and shared[p] for p in up]),
            pa.array(least[b.start : b.stop], pa.int64()), pa.array([least[p] if p >= 0 else None for p in up], pa.int64()),
            *(pa.array(x[b.start : b.stop], pa.int64()) for x in (n, children, leaves, saved)),
            pa.array(lengths[b.start : b.stop], pa.int32()), pa.array(ends[b.start : b.stop], pa.list_(pa.int64())),
        ], names=[field.split()[0] for field in _PARTIAL.split(", ")])


def _merged(work: Workspace, partial: DataFrame) -> DataFrame:
    """Shared nodes, whole: numbers of the ranges added up, and what shared nodes add to themselves and to those above them."""
    total = lambda c: F.sum(c).alias(c)
    nodes = partial.where("shared").groupBy("node").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.first("chars").alias("chars"),
        F.min("conv_id").alias("conv_id"), total("n_convs"), total("n_children"), total("n_leaves"), total("saved_chars"),
    )
    nodes = work.store(nodes, "shared")
    kids = work.store(nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("kids")), "kids")
    nodes = work.store(
        nodes.join(kids, "node", "left").withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0))).drop("kids"), "counted"
    )
    # n_leaves and saved: sums over shared nodes less than 2**round below; `above` is the ancestor that far up
    sums = nodes.select(
        "node", F.col("parent").alias("above"), F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
    )
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    for step in range(deepest.bit_length()):
        gained = work.store(
            sums.where("above is not null").groupBy(F.col("above").alias("node")).agg(
                F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")
            ), f"gained-{step}",
        )
        jump = sums.select(F.col("node").alias("above"), F.col("above").alias("next"))
        sums = work.store(
            sums.join(gained, "node", "left").join(jump, "above", "left").select(
                "node", F.col("next").alias("above"), (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            ), f"sums-{step}",
        )
    return work.store(nodes.join(sums.drop("above"), "node").select(
        "node", "parent", "depth", "conv_id", "n_convs", "n_children", (F.col("n_leaves") + F.col("leaves")).alias("n_leaves"),
        (F.col("saved_chars") + F.col("saved")).alias("saved_chars"),
    ), "merged")


@dataclass
class Trie:
    """`nodes`: `node, parent` (digests; the root's parent is null), `depth, conv_id` (smallest member), `parent_conv_id, n_convs, n_children,
    n_leaves, saved_chars`. `ends`: `node, conv_id` of the conversations that end at a node."""

    nodes: DataFrame
    ends: DataFrame


def sequences(conversations: DataFrame) -> DataFrame:
    """`(conv_id, turns)` of `(conv_id, turn, role, text, ...)`: ids and lengths of the turns in order.

    Rows count in the order of turn (null first), then of their ids; null roles and texts count as empty. Rows without a conv_id take no
    part. A conversation's ids, not its texts, are one cell.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    content = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").cast("long").alias("turn"), F.unhex(content).alias("id"), F.length(text).alias("chars")).alias("row"),
    )
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows")).select(
        "conv_id", F.transform("rows", lambda row: F.struct(row.id.alias("id"), row.chars.alias("chars"))).alias("turns")
    )


def prefix_trie(keys: DataFrame) -> Trie:
    """The trie of `(conv_id, turns)`, one row per conversation, as `sequences` makes them.

    Every distinct sequence of first turns is a node, the empty one, the root, included; its members are the conversations that begin with it.
    `n_leaves` counts the childless nodes of its subtree, itself included, and `saved_chars` sums over its subtree each node's
    `n_convs - 1` times the code points of its last text: what storing shared turns once saves. No conversations, no nodes.
    """
    spark = keys.sparkSession
    let_workers_import(spark)
    work = Workspace(spark, "prefix-trie")
    keys = work.store(keys.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turns").cast(TURNS).alias("turns")), "keys")
    turns = keys.agg(F.sum(F.size("turns") + 1)).first()[0] or 0
    ranges = keys.repartitionByRange(turns // TURNS_PER_TREE + 1, "turns", "conv_id")
    partial = work.store(ranges.mapInArrow(_trees, _PARTIAL), "partial")
    whole = _merged(work, partial)
    columns = ["node", "parent", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_chars"]
    nodes = partial.where("not shared").select(*columns, F.when(~F.col("parent_shared"), F.col("parent_conv_id")).alias("known")).unionByName(
        whole.select(*columns, F.lit(None).cast("long").alias("known"))
    )
    # a parent in one range only is known there; the few shared ones are looked up
    up = whole.select(F.col("node").alias("parent"), F.col("conv_id").alias("found"))
    nodes = nodes.join(up, "parent", "left").select(
        "node", "parent", "depth", "conv_id", F.coalesce("known", "found").alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_chars",
    )
    return Trie(nodes, partial.select("node", F.explode("ends").alias("conv_id")))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids of each node, sorted, one at a time."""
    at, digest, done = None, None, []
    for batch in batches:
        for node, conv in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
            if node == at:
                digest.update(b",%d" % conv)
            else:
                if at is not None:
                    done.append((at, digest.hexdigest()))
                at, digest = node, hashlib.sha256(b"%d" % conv)
        if done:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*done), (pa.binary(), pa.string()))], names=["node", "sha"])
            done = []
    if at is not None:
        yield pa.record_batch([pa.array([at], pa.binary()), pa.array([digest.hexdigest()])], names=["node", "sha"])


def rebuilt(keys: DataFrame) -> DataFrame:
    """Every conversation c with its first turns, crc32(c) % 6 of them, taken from conversation c - c % 100."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int")
    leads = keys.where("conv_id % 100 = 0").select(F.col("conv_id").alias("lead"), F.slice("turns", 1, 5).alias("first"))
    joined = keys.withColumn("lead", F.expr("conv_id - conv_id % 100")).join(leads, "lead", "left")
    none: Column = F.array().cast(TURNS)
    first = F.when(h > 0, F.slice(F.coalesce("first", none), F.lit(1), h)).otherwise(none)
    own = F.slice("turns", h + 1, F.size("turns") + 1)
    return joined.select("conv_id", F.concat(first, own).alias("turns"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    trie = prefix_trie(rebuilt(sequences(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))
    ends = trie.ends.repartition("node").sortWithinPartitions("node", "conv_id").mapInArrow(_digests, "node binary, sha string")
    return trie.nodes.join(ends, "node", "left").select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved_chars").alias("saved_tokens"), F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


OP11_SQL = rf"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))
  ) AS k
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, {crc32_sql("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM turns)
), rows_ AS (
  SELECT c.conv_id, t.k, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.k <= c.h
  UNION ALL
  SELECT c.conv_id, t.k, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.k > c.h
), members AS (
  SELECT conv_id, list({{'role': role, 'text': text}}) OVER (PARTITION BY conv_id ORDER BY k) AS p FROM rows_
  UNION ALL
  SELECT conv_id, [] AS p FROM convs
), whole AS (
  SELECT conv_id, max_by(p, len(p)) AS p FROM members GROUP BY conv_id
), nodes AS (
  SELECT p, len(p) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs FROM members GROUP BY p
), counted AS (
  SELECT n.*, (SELECT count(*) FROM nodes k WHERE k.depth = n.depth + 1 AND k.p[:n.depth] = n.p) AS n_children FROM nodes n
), below AS (
  SELECT p[:d] AS p, count(*) FILTER (WHERE n_children = 0) AS n_leaves,
    sum(CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(p[depth].text) END) AS saved
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM counted) GROUP BY p[:d]
), ended AS (
  SELECT p, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM whole GROUP BY p
)
SELECT c.conv_id, CAST(c.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, CAST(c.n_convs AS BIGINT) AS n_convs,
  CAST(c.n_children AS BIGINT) AS n_children, CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens,
  sha256(coalesce(e.ids, '')) AS ends_sha256
FROM counted c LEFT JOIN nodes u ON c.depth > 0 AND u.p = c.p[:c.depth - 1]
JOIN below b ON b.p = c.p LEFT JOIN ended e ON e.p = c.p
"""
