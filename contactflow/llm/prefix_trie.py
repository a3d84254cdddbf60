"""Prefix trie of conversations: nodes, members, leaves and the tokens that shared prefixes save.

Turns become digests, conversations sequences of them. Distinct sequences are dealt by range
of their order; each shard is read in blocks, every block becomes a ternary search tree, and nodes
that a neighbouring block shares are merged by key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import LAST_ID, materialize, order_id
from .ternary_tree import ROOT, TernaryTree, common_prefix, median_order

#: Conversations that share an opening: those of one hundred.
SPAN = 100
#: Openings are shorter than this.
OPENINGS = 6
#: Turns per range shard, and per tree within it.
SHARD_TURNS = 500_000
BLOCK_TURNS = 100_000
#: Conversation ids that are joined to one piece of text before pieces meet.
PIECE_IDS = 4096


def encode_turns(conversations: DataFrame) -> DataFrame:
    """(conv, turns array<binary>, sizes array<int>) per conversation, in order of turn, null first.

    A turn is the SHA-256 of the length of its role, a colon, the role and the text; equal turn numbers go by it.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    rows = conversations.select(
        order_id("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), digest.alias("digest"), F.length(text).alias("size")
    )
    found = rows.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("turn", "digest", "size"))).alias("t"))
    return found.select("conv", F.col("t.digest").alias("turns"), F.col("t.size").alias("sizes"))


def rebuild(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """(conv, turns, sizes, seq): each conversation behind the opening of its hundred; seq is a digest of turns.

    The conversations that give openings, one of a hundred, are read and encoded a second time, so that
    nothing is written before they meet the others.
    """
    known = F.col("conv") != LAST_ID
    opening = F.when(known, F.crc32(F.col("conv").cast("string").cast("binary")) % OPENINGS).otherwise(0).cast("int")
    openers = encode_turns(conversations.where(F.col("conv_id").cast("long") % SPAN == 0)).where(known)
    heads = openers.select(F.col("conv").alias("base"), *(F.slice(c, 1, OPENINGS - 1).alias(f"head_{c}") for c in ("turns", "sizes")))
    based = encode_turns(conversations).withColumns({"base": F.when(known, F.col("conv") - F.col("conv") % SPAN), "opening": opening})
    joined = based.join(heads, "base", "left")

    def spliced(name: str) -> Column:
        head = F.slice(F.coalesce(F.col(f"head_{name}"), F.expr(f"cast(array() as {'array<binary>' if name == 'turns' else 'array<int>'})")), F.lit(1), F.col("opening"))
        return F.concat(head, F.slice(name, F.col("opening") + 1, F.size(name))).alias(name)

    built = joined.select("conv", spliced("turns"), spliced("sizes"))
    seq = F.unhex(F.sha2(F.array_join(F.transform("turns", F.hex), "").cast("binary"), 256))
    return materialize(spark, built.withColumn("seq", seq), "rebuilt")


def _lcp(a: str, b: str) -> Column:
    """Shared leading turns of two different sequences; 0 without one of them."""
    first_difference = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.coalesce(F.greatest(first_difference - 1, F.lit(0)), F.lit(0)).cast("int")


def shards(spark: SparkSession, rebuilt: DataFrame, shard_turns: int) -> DataFrame:
    """Distinct sequences by range shard, with what the shard shares with its neighbours.

    Copies of a conversation are one row with their number. `before` and `after` are the turns that
    the shard's ends share with the shards beside it, `extended` tells whether its last sequence goes on there.
    """
    total = rebuilt.agg(F.sum(F.size("turns") + 1)).first()[0] or 0
    distinct = rebuilt.groupBy("seq", "turns", "sizes").agg(F.count("*").alias("n"), F.min("conv").alias("conv"))
    dealt = distinct.repartitionByRange(max(1, -(-total // shard_turns)), "turns").withColumn("shard", F.spark_partition_id())
    dealt = materialize(spark, dealt, "shards")
    # One row per shard, so one task for their order is enough.
    w = Window.orderBy("shard")
    ends = dealt.groupBy("shard").agg(F.min("turns").alias("low"), F.max("turns").alias("high"))
    ends = ends.withColumns({"previous": F.lag("high").over(w), "following": F.lead("low").over(w)})
    after = _lcp("high", "following")
    edges = ends.select(
        "shard",
        _lcp("previous", "low").alias("before"),
        after.alias("after"),
        (F.col("following").isNotNull() & (after == F.size("high"))).alias("extended"),
    )
    return dealt.join(edges, "shard").repartition("shard").sortWithinPartitions("shard", "turns")


class Sequence(NamedTuple):
    seq: bytes
    turns: list[bytes]
    sizes: list[int]
    n: int
    conv: int
    shard: int
    before: int
    after: int
    extended: bool


NODES = (
    "key binary, parent_key binary, depth long, conv long, parent_conv long, n_convs long, "
    "n_children long, n_leaves long, saved long, seq binary"
)
_TYPES = [pa.binary(), pa.binary(), *[pa.int64()] * 7, pa.binary()]
_NAMES = [part.split()[0] for part in NODES.split(", ")]


def _prefix_keys(turns: list[bytes], depth: int) -> list[bytes]:
    """Keys of the prefixes of 0..depth turns: each the SHA-256 of the one before and the next turn."""
    keys = [hashlib.sha256().digest()]
    for turn in turns[:depth]:
        keys.append(hashlib.sha256(keys[-1] + turn).digest())
    return keys


def block_nodes(block: list[Sequence], before: int, after: int, extended: bool) -> pa.RecordBatch:
    """Nodes of sorted distinct sequences.

    A node that the block before also has counts its members here, but is no new child and no new text.
    Shared nodes have a key, and children of shared nodes the parent's key, in place of its conversation.
    """
    tree = TernaryTree()
    for i in median_order(len(block)):
        tree.insert(block[i].turns, block[i].sizes, i)
    first, last = block[0], block[-1]
    old = set(tree.path(first.turns, before))
    shared = dict(zip(tree.path(first.turns, before), _prefix_keys(first.turns, before), strict=True))
    shared |= zip(tree.path(last.turns, after), _prefix_keys(last.turns, after), strict=True)
    goes_on = tree.path(last.turns, len(last.turns))[-1] if extended else -1
    size = len(tree.turn)
    members, conv, children, leaves, saved = [0] * size, [LAST_ID] * size, [0] * size, [0] * size, [0] * size
    for node in range(size - 1, -1, -1):  # children come after their parents
        if (end := tree.end[node]) >= 0:
            members[node] += block[end].n
            conv[node] = min(conv[node], block[end].conv)
            leaves[node] += tree.inner[node] < 0 and node != goes_on
        new = node not in old
        saved[node] += (members[node] - new) * tree.size[node]
        if node != ROOT:
            up = tree.up[node]
            members[up] += members[node]
            conv[up] = min(conv[up], conv[node])
            children[up] += new
            leaves[up] += leaves[node]
            saved[up] += saved[node]
    up = tree.up
    columns = [
        [shared.get(i) for i in range(size)],
        [shared.get(u) for u in up],
        tree.depth,
        conv,
        [None if u < 0 or u in shared else conv[u] for u in up],
        members,
        children,
        leaves,
        saved,
        [block[e].seq if e >= 0 else None for e in tree.end],
    ]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], _NAMES)


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[Sequence]:
    for batch in batches:
        yield from map(Sequence._make, zip(*(batch[c].to_pylist() for c in Sequence._fields), strict=True))


def trie_blocks(batches: Iterable[pa.RecordBatch], block_turns: int) -> Iterator[pa.RecordBatch]:
    """Nodes of a task's shards, whose rows come in order of shard and turns."""
    block: list[Sequence] = []
    held, before = 0, None
    rows = _rows(batches)
    row = next(rows, None)
    while row is not None:
        following = next(rows, None)
        block.append(row)
        held += len(row.turns) + 1
        same = following is not None and following.shard == row.shard
        if not same or held >= block_turns:
            after = common_prefix(row.turns, following.turns) if same else row.after
            extended = after == len(row.turns) if same else row.extended
            yield block_nodes(block, row.before if before is None else before, after, extended)
            block, held, before = [], 0, after if same else None
        row = following


def ends(rebuilt: DataFrame) -> DataFrame:
    """(seq, ends_sha256): SHA-256 of the sorted, comma-joined ids of the conversations that are this sequence.

    Ids are joined to pieces in ranges of (seq, conv), so that a sequence with many copies meets as a few pieces.
    """

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, ids = None, []

        def out() -> pa.RecordBatch:
            text = ",".join("" if c == LAST_ID else str(c) for c in ids)
            columns = [pa.array([seq], pa.binary()), pa.array(ids[:1], pa.int64()), pa.array([text], pa.string())]
            return pa.RecordBatch.from_arrays(columns, ["seq", "conv", "piece"])

        for batch in batches:
            for s, c in zip(batch["seq"].to_pylist(), batch["conv"].to_pylist(), strict=True):
                if ids and (s != seq or len(ids) == PIECE_IDS):
                    yield out()
                    ids = []
                seq = s
                ids.append(c)
        if ids:
            yield out()

    def hashes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, state = None, None
        for batch in batches:
            done = []
            for s, piece in zip(batch["seq"].to_pylist(), batch["piece"].to_pylist(), strict=True):
                if s == seq:
                    state.update(b",")
                else:
                    if state:
                        done.append((seq, state.hexdigest()))
                    seq, state = s, hashlib.sha256()
                state.update(piece.encode())
            yield _hashed(done)
        if state:
            yield _hashed([(seq, state.hexdigest())])

    def _hashed(done: list[tuple[bytes, str]]) -> pa.RecordBatch:
        columns = [pa.array([s for s, _ in done], pa.binary()), pa.array([h for _, h in done], pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["seq", "ends_sha256"])

    narrow = rebuilt.select("seq", "conv").repartitionByRange("seq", "conv").sortWithinPartitions("seq", "conv")
    joined = narrow.mapInArrow(pieces, "seq binary, conv long, piece string")
    return joined.repartition("seq").sortWithinPartitions("seq", "conv").mapInArrow(hashes, "seq binary, ends_sha256 string")


def prefix_trie(
    spark: SparkSession, conversations: DataFrame, shard_turns: int = SHARD_TURNS, block_turns: int = BLOCK_TURNS
) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A null role or text is empty. Rows with a null conv_id are one conversation that takes no opening,
    sorts last, is the smallest member only of its own nodes (as null) and an empty text among ids.
    Turn numbers that repeat go as in `encode_turns`; repeated rows are turns of their own. Extra
    columns are ignored. An empty table has no nodes. Texts are read once for their digest and length,
    those of one conversation in a hundred twice, and a conversation is one row, of some 60 bytes a
    turn (up to 2 GB). A tree holds block_turns turns or one conversation. Copies of a conversation are counted before they meet.
    """
    rebuilt = rebuild(spark, conversations)
    dealt = shards(spark, rebuilt, shard_turns)
    nodes = materialize(spark, dealt.mapInArrow(lambda batches: trie_blocks(batches, block_turns), NODES), "trie")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")]
    merged = nodes.where("key is not null").groupBy("key").agg(
        F.max("parent_key").alias("parent_key"), F.max("depth").alias("depth"), F.min("conv").alias("conv"), *sums, F.max("seq").alias("seq")
    )
    merged = materialize(spark, merged, "shared-nodes")
    rest = ["depth", "conv", "n_convs", "n_children", "n_leaves", "saved", "seq"]
    closed = nodes.where("key is null")
    alone = closed.where("parent_key is null").select(*rest, "parent_conv")
    root = merged.where("parent_key is null").select(*rest, F.lit(None).cast("long").alias("parent_conv"))
    hanging = closed.where("parent_key is not null").select(*rest, "parent_key")
    hanging = hanging.unionByName(merged.where("parent_key is not null").select(*rest, "parent_key"))
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv").alias("parent_conv"))
    found = alone.unionByName(root).unionByName(hanging.join(parents, "parent_key").drop("parent_key"))
    none = hashlib.sha256().hexdigest()
    ended = found.where("seq is not null").join(ends(rebuilt), "seq")
    found = ended.unionByName(found.where("seq is null").withColumn("ends_sha256", F.lit(none)))

    def shown(name: str) -> Column:
        return F.when(F.col(name) != LAST_ID, F.col(name))

    return found.select(
        shown("conv").alias("conv_id"),
        "depth",
        shown("parent_conv").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        "ends_sha256",
    )
