"""A trie of conversations by their first turns: fixed-length block hashing.

The turns of a conversation are cut into blocks of `block` turns, the last one may be shorter.
A path, the digests of the first blocks of a conversation, says which conversations agree so
far: conversations are grouped by paths, and each different path is one block of the block trie,
with its number of members and their smallest id. Only where a path goes on in several
different blocks are turns looked at: there, prefixes of the blocks are grouped by digest, each
different block once with its number of members. A block without siblings has the members of the
block in each of its turns.

Sums over subtrees need no walk. The smallest member of a node is the smallest of all nodes it
shares with no smaller conversation, and these are the last ones of its path; so each node's
value is put down once, at its smallest member, the values are summed from the end of each
path, and a node's subtree is the sum over its members. This is done over blocks first, with one
member for each different conversation, then over turns within siblings.

A path is known by four sums of 32-bit parts of the digests of its blocks with their numbers, a
turn by SHA-256. Running sums and positions are taken over ranges, so neither a conversation
nor a group of equal ones has to fit into a task. The conversations that end at a node are
hashed in one pass over packed pieces of their joined ids, some `PIECE` bytes at a time.

Rebuilding (`share_heads`): conversation c takes the first h turns of conversation c - c % 5, then
its own after the first h.

Nulls: rows without a conv_id belong to no conversation and are left out; a null turn comes
first; a null role or text is empty. Equal turn numbers are ordered by digest; repeated rows are
turns of their own. An empty table has no nodes, not even a root. Other columns are not
read. Texts are hashed whole, before
anything is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.running import running_sums
from sedimenta.llm.scratch import Scratch

BLOCK = 4
HEAD = 9
FAMILY = 5
PIECE = 1 << 20
ROOT = "0-0-0-0"
_LANES = ("x0", "x1", "x2", "x3")


def digest_turns(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, pos from 1, digest, bytes): the turns in order, without their texts."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat_ws(":", F.octet_length(role).cast("string"), F.concat(role, text)).cast("binary"), 256)
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("at"),
    )
    order = [F.asc_nulls_first("turn"), F.asc("digest"), F.asc("at")]
    placed = running_sums(turns, "conv_id", order, {"pos": F.lit(1)}, scratch, "turns")
    return placed.select("conv_id", F.col("pos").cast("long").alias("pos"), "digest", "bytes")


def share_heads(
    turns: DataFrame, scratch: Scratch, head: int = HEAD, family: int = FAMILY
) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (conv_id, pos, digest, bytes), and the ids of all conversations (conv_id)."""
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("size")).select(
        "conv_id", "size", (F.col("conv_id") - F.col("conv_id") % family).alias("of"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % head).alias("h"),
    )
    heads = sizes.select(F.col("conv_id").alias("of"), F.col("size").alias("there"))
    sizes = sizes.join(heads, "of", "left").withColumn("given", F.least("h", F.coalesce("there", F.lit(0))))
    sizes = scratch.keep(sizes, "sizes")  # read afresh, so that a join can split a long conversation
    first = turns.where(F.col("pos") < head).select(F.col("conv_id").alias("of"), "pos", "digest", "bytes")
    taken = first.join(sizes.select("conv_id", "of", "given"), "of").where("pos <= given")
    own = turns.join(sizes.select("conv_id", "h", "given"), "conv_id").where("pos > h")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("given")).alias("pos"), "digest", "bytes")
    return taken.select("conv_id", "pos", "digest", "bytes").union(own), sizes.select("conv_id")


def _cut_into_blocks(turns: DataFrame, block: int, scratch: Scratch) -> DataFrame:
    """(conv_id, level, path before, path, digests, sizes): blocks in order."""
    level = F.floor((F.col("pos") - 1) / block)
    blocks = turns.groupBy("conv_id", level.alias("level")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "digest", "bytes"))).alias("turns")
    )
    whole = F.sha2(F.concat_ws(":", F.col("level").cast("string"), F.array_join(F.col("turns.digest"), ",")).cast("binary"), 256)
    blocks = blocks.select(
        "conv_id", "level", F.col("turns.digest").alias("digests"), F.col("turns.bytes").alias("sizes"), whole.alias("whole")
    )
    lane = lambda i: F.conv(F.substring("whole", 1 + 8 * i, 8), 16, 10).cast("long")
    blocks = blocks.select("*", *(lane(i).alias(f"own_{x}") for i, x in enumerate(_LANES))).drop("whole")
    sums = running_sums(blocks, "conv_id", [F.asc("level")], {x: F.col(f"own_{x}") for x in _LANES}, scratch, "blocks")
    before = F.concat_ws("-", *((F.col(x) - F.col(f"own_{x}")).cast("string") for x in _LANES))
    path = F.concat_ws("-", *(F.col(x).cast("string") for x in _LANES))
    return sums.select("conv_id", "level", before.alias("before"), path.alias("path"), "digests", "sizes")


def _ends(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of (node, conv_id): the ids ascending, joined, hashed piece by piece."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of one node as text, in pieces; rows come sorted."""
        node, first, ids, size = None, 0, [], 0

        def piece() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"node": [node], "first": [first], "ids": [",".join(ids)]})

        for batch in batches:
            for name, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if ids and (name != node or size > PIECE):
                    yield piece()
                    ids, size = [], 0
                if not ids:
                    node, first = name, conv
                ids.append(str(conv))
                size += len(ids[-1]) + 1
        if ids:
            yield piece()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces of a node follow each other; none is kept."""
        node, sha = None, hashlib.sha256()
        for batch in batches:
            nodes, shas = [], []
            for name, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if name == node:
                    sha.update(b"," + ids.encode())
                    continue
                if node is not None:
                    nodes.append(node)
                    shas.append(sha.hexdigest())
                node, sha = name, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.string()), pa.array(shas, pa.string())], ["node", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_pydict({"node": [node], "ends_sha256": [sha.hexdigest()]})

    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = ends.select("node", "conv_id").repartitionByRange(parts, "node", "conv_id").sortWithinPartitions("node", "conv_id")
    packed = ranged.mapInArrow(pack, "node string, first long, ids string")
    return packed.repartition(parts, "node").sortWithinPartitions("node", "first").mapInArrow(digest, "node string, ends_sha256 string")


def _least_and_count(blocks: DataFrame) -> DataFrame:
    """The block trie: one row for each path."""
    return blocks.groupBy("before", "path", "level").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("least"),
        F.first("digests").alias("digests"), F.first("sizes").alias("sizes"),
    )


def _prefixes(trie: DataFrame, block: int, scratch: Scratch) -> DataFrame:
    """The turns of each block: (path, before, level, least, n, i, bytes, node, parent).

    Blocks without siblings take their own path as their turns' name, others the digest of the
    turns so far; the last turn of a full block is known by the path in both.
    """
    split = trie.groupBy("before").agg(F.count("*").alias("siblings")).where("siblings > 1")
    named = trie.join(scratch.keep(split, "split"), "before", "left")
    name = lambda i: F.when(
        F.col("siblings").isNotNull(),
        F.concat_ws("/", "before", i.cast("string"), F.sha2(F.array_join(F.slice("digests", F.lit(1), i), ",").cast("binary"), 256)),
    ).otherwise(F.concat_ws("/", F.col("path"), i.cast("string")))
    at = F.col("i")
    turns = named.select("*", F.explode(F.sequence(F.lit(1), F.size("digests"))).alias("i"))
    node = F.when(at == block, F.col("path")).otherwise(name(at))
    parent = F.when(at == 1, F.col("before")).otherwise(name(at - 1))
    return turns.select(
        "path", "before", "level", "least", "n", "i", (F.col("level") * block + at).alias("depth"),
        F.element_at("sizes", at).alias("bytes"), node.alias("node"), parent.alias("parent"), F.col("siblings").isNotNull().alias("split"),
    )


def _nodes(prefixes: DataFrame) -> DataFrame:
    """(node, parent, depth, bytes, n_convs, conv_id): turns of siblings grouped, others as they are."""
    columns = ["node", "parent", "depth", "bytes"]
    grouped = prefixes.where("split").groupBy(*columns).agg(F.sum("n").alias("n_convs"), F.min("least").alias("conv_id"))
    alone = prefixes.where("not split").select(*columns, F.col("n").alias("n_convs"), F.col("least").alias("conv_id"))
    return grouped.union(alone)


def conversation_trie(turns: DataFrame, convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256. `turns` as from `share_heads`, `convs` the ids of all, also of those without turns."""
    scratch = Scratch(turns.sparkSession, "trie")
    convs = scratch.keep(convs, "convs")
    all_convs = convs.agg(F.count("*").alias("n"), F.min("conv_id").alias("least")).first()
    blocks = scratch.keep(_cut_into_blocks(turns, block, scratch), "paths")
    trie = scratch.keep(_least_and_count(blocks), "block-trie")
    prefixes = scratch.keep(_prefixes(trie, block, scratch), "prefixes")
    nodes = _nodes(prefixes)
    children = nodes.groupBy("parent").agg(F.count("*").alias("n_children")).withColumnRenamed("parent", "node")
    nodes = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = nodes.select("*", (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    nodes = scratch.keep(nodes, "nodes")
    subtrees = _subtrees(blocks, trie, prefixes, nodes, scratch)

    # The parent of a block's first turn is the end of the path before, of its other turns a node.
    first = nodes.where(F.col("parent") == ROOT)
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    placed = nodes.where(F.col("parent") != ROOT).join(above, "parent").select(*nodes.columns, "parent_conv_id")
    placed = placed.union(first.select("*", F.lit(all_convs["least"]).cast("long")))
    rows = placed.join(subtrees, "node").select(
        "node", "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    root = first.join(subtrees, "node").agg(
        F.count("*").alias("n_children"), zero(F.sum("n_leaves")).alias("n_leaves"), zero(F.sum("saved_tokens")).alias("saved_tokens")
    ).where(F.lit(all_convs["n"] > 0)).select(
        F.lit(ROOT).alias("node"), F.lit(all_convs["least"]).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"), F.lit(all_convs["n"]).cast("long").alias("n_convs"),
        "n_children", F.greatest("n_leaves", F.lit(1).cast("long")).alias("n_leaves"), "saved_tokens",
    )
    last = blocks.groupBy("conv_id").agg(F.max(F.struct("level", "path"))["path"].alias("node")).select("node", "conv_id")
    silent = convs.join(last, "conv_id", "left_anti").select(F.lit(ROOT).alias("node"), "conv_id")
    named = prefixes.groupBy("path").agg(F.max(F.struct("i", "node"))["node"].alias("end"))
    ends = _ends(last.union(silent)).join(named, F.col("node") == F.col("path"), "left").select(
        F.coalesce("end", "node").alias("node"), "ends_sha256"
    )
    return rows.union(root).join(ends, "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def _subtrees(blocks: DataFrame, trie: DataFrame, prefixes: DataFrame, nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, n_leaves, saved_tokens): sums over the subtree of each node, itself included."""
    values = ("leaves", "saved")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    # The smallest block of a node puts its values down.
    put = nodes.select("node", F.col("conv_id").alias("least"), *values)
    owned = prefixes.select("path", "i", "node", "least").join(put, ["node", "least"], "left")
    owned = scratch.keep(owned.select("path", "i", "node", *(zero(v) for v in values)), "owned")
    own = owned.groupBy("path").agg(*(F.sum(v).alias(v) for v in values))

    # Blocks, by the paths of one member for each different conversation, from their ends.
    last = blocks.groupBy("conv_id").agg(F.max(F.struct("level", "path"))["path"].alias("last"))
    different = scratch.keep(last.groupBy("last").agg(F.min("conv_id").alias("conv_id")).select("conv_id"), "different")
    put = trie.select("path", F.col("least").alias("conv_id"), "level").join(own, "path").select("conv_id", "level", *values)
    steps = blocks.select("conv_id", "level", "path").join(different, "conv_id", "left_semi")
    steps = steps.join(put, ["conv_id", "level"], "left").select("conv_id", "level", "path", *(zero(v) for v in values))
    sums = {f"{v}_on": F.col(v) for v in values}
    upwards = running_sums(steps, "conv_id", [F.desc("level")], sums, scratch, "steps")
    below = upwards.groupBy("path").agg(*(F.sum(n).alias(n) for n in sums))
    below = below.join(own, "path").select("path", *((F.col(f"{v}_on") - F.col(v)).alias(f"{v}_below") for v in values))

    # Turns, from the end of each block: at most as many rows as it has turns.
    rest = Window.partitionBy("path").orderBy(F.desc("i")).rowsBetween(Window.unboundedPreceding, 0)
    within = owned.select("path", "node", *(F.sum(v).over(rest).alias(v) for v in values)).join(below, "path")
    return within.groupBy("node").agg(
        F.sum(F.col("leaves") + F.col("leaves_below")).alias("n_leaves"),
        F.sum(F.col("saved") + F.col("saved_below")).alias("saved_tokens"),
    )


def prefix_trie(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """The trie of the rebuilt conversations of a table conv_id, turn, role, text."""
    scratch = Scratch(conversations.sparkSession, "conversations")
    turns = scratch.keep(digest_turns(conversations, scratch), "digests")
    rebuilt, convs = share_heads(turns, scratch)
    return conversation_trie(rebuilt, convs, block)
