"""MinHash near-dedup with tensored banding, links confirmed on the full shingle sets.

A document's set holds its distinct shingles of `words` words (A-Z lowered); with fewer words,
the whole sequence as one. Documents are linked where 100 * intersection >= percent * union, and
a component is all that links reach.

1. Documents with equal sets become one node, so copies cost one row each from here on.
2. Each node has `HALVES` half keys of `ROWS` minhashes each. Any two half keys together form
   the key of one table, so 20 half keys (60 minhashes) give 190 tables of six rows, which would
   take 1,140 minhashes if each table drew its own. A pair with similarity s meets in a table
   if two or more half keys agree: all but 1.3e-5 of the pairs with s = 0.8, all but 2e-7 with
   s = 0.85. Half keys that one node alone has can form no table that others share, and are
   left out before pairs of them are formed.
3. Candidates are confirmed in three rounds, so that a large group costs a few comparisons a
   node, not all pairs: (A) each node with the smallest node it shares a table with; (B) in each
   table, each node with the table's smallest, if their components still differ; (C) in tables
   that still hold several components, the nodes of different components, if their sizes and
   `BITS` one-bit minhashes allow the similarity: bits of a pair with s differ with probability
   (1 - s) / 2, and a pair may exceed that by `DEVIATIONS` standard deviations, of the first
   `FIRST_BITS` and of all of them (which 6e-8 and 4e-8 of the pairs at s = 0.8 do). Of a group
   whose members are alike, but not enough to be linked, only pairs above s = 0.75 or so are
   passed on. Round C leaves no such pair of different components unconfirmed.
4. Components come from smallest-neighbour labels with pointer jumps, on written tables.

Nodes are numbered once they are written. Rows with the same id are one document: if their texts
differ, each text is a node of its own, and the nodes of one id are joined before the first round,
so that all links of all its texts count.

Nulls and edges: an empty or null text has no shingles and is linked with nothing, its row has its
own id as component. A null id is returned with a null component and kept, linked with nothing.
Empty tables give empty results; other columns are not read; texts are used whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm.scratch import Scratch
from sedimenta.llm.words import column, find_words, grams, lean, mix, multipliers, slices

HALVES = 20
ROWS = 3
WORDS = 5
PERCENT = 80
BITS = 4096
FIRST_BITS = 1024
DEVIATIONS = 5.5

_BIT_FACTORS = multipliers(BITS, 403)
_MULTIPLY = multipliers(HALVES * ROWS, 401)
_TOGETHER = multipliers(ROWS, 402)


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """The sorted hashes of the distinct shingles of each text."""
    found = find_words(texts, fold=True)
    hashes, counts = found.hashes(), found.counts
    full = grams(hashes, words, 41)
    short = {n: grams(hashes, n, 41 + n) for n in range(1, words) if (counts == n).any()}
    out = []
    for first, n in zip(found.first[:-1].tolist(), counts.tolist(), strict=True):
        if n >= words:
            out.append(np.unique(full[first : first + n - words + 1]))
        else:
            out.append(short[n][first : first + 1] if n else full[:0])
    return out


def half_keys(sets: list[np.ndarray]) -> np.ndarray:
    """A row of half keys for each set, which must not be empty."""
    values = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.zeros((len(sets), HALVES), dtype=np.uint64)
    for i, factor in enumerate(_MULTIPLY):
        # A product with an odd number, rotated by xor, orders all 64-bit values anew.
        least = np.minimum.reduceat((values ^ (values >> np.uint64(29 + i % 7))) * factor, starts)
        out[:, i // ROWS] += least * _TOGETHER[i % ROWS]
    for half in range(HALVES):
        out[:, half] = mix(out[:, half], half)
    return out


def _sketches(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = shingle_sets(column(part, "text"), words)
            full = [i for i, s in enumerate(sets) if len(s)]
            keys: list = [None] * len(sets)
            if full:
                for i, row in zip(full, half_keys([sets[i] for i in full]), strict=True):
                    keys[i] = row.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    column(part, "doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "set_hash", "keys"],
            )

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = shingle_sets(column(part, "text"), words)
            packed = pa.array([s.tobytes() for s in sets], pa.binary())
            hashed = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([column(part, "doc_id"), hashed, packed], names=["doc_id", "set_hash", "items"])

    return run


def bit_sketches(sets: list[np.ndarray]) -> np.ndarray:
    """One bit of each of `BITS` minhashes, packed into words of 64, for sets that are not empty."""
    values = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.zeros((len(sets), BITS // 64), dtype=np.uint64)
    for i, factor in enumerate(_BIT_FACTORS):
        least = np.minimum.reduceat((values ^ (values >> np.uint64(23 + i % 13))) * factor, starts)
        out[:, i // 64] |= (mix(least, i) >> np.uint64(63)) << np.uint64(i % 64)
    return out.view(np.int64)


def most_different_bits(percent: int, bits: int = BITS) -> int:
    p = (1 - percent / 100) / 2
    return int(np.ceil(bits * p + DEVIATIONS * np.sqrt(bits * p * (1 - p))))


_BIT_COLUMNS = [f"bits{i}" for i in range(BITS // 64)]


def _sketch_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            rows = bit_sketches([np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in column(part, "items")])
            yield pa.RecordBatch.from_arrays(
                [column(part, "id"), *(pa.array(np.ascontiguousarray(c)) for c in rows.T)], names=["id", *_BIT_COLUMNS]
            )


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for a, b in zip(column(batch, "set_a"), column(batch, "set_b"), strict=True):
                one = np.frombuffer(a.as_buffer(), dtype=np.uint64)
                two = np.frombuffer(b.as_buffer(), dtype=np.uint64)
                both = np.concatenate([one, two])
                both.sort()
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                linked.append(100 * shared >= percent * (len(both) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return run


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, component) of the nodes in `links` (a, b): the smallest node each can reach."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = scratch.keep(both.where("a <> b").distinct(), "edges")
    labels = scratch.keep(
        edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("least")).select("id", F.least("id", "least").alias("component")),
        "labels",
    )
    while True:
        near = edges.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        hooked = labels.join(near, "id").select("id", F.least("component", "near").alias("to"), F.col("component").alias("was"))
        jump = hooked.select(F.col("id").alias("to"), F.col("to").alias("jumped"))
        after = scratch.keep(
            hooked.join(jump, "to").select("id", F.least("to", "jumped").alias("component"), "was"), "labels"
        )
        labels = after.select("id", "component")
        if after.where("component <> was").isEmpty():
            return labels


class _Rounds:
    """Links confirmed so far, and the components they make."""

    def __init__(self, scratch: Scratch, sets: DataFrame, percent: int) -> None:
        self.scratch, self.sets, self.percent = scratch, sets, percent
        self.labels: DataFrame | None = None
        self.tested: DataFrame | None = None

    def labelled(self, frame: DataFrame, node: str, to: str) -> DataFrame:
        if self.labels is None:
            return frame.withColumn(to, F.col(node))
        known = self.labels.select(F.col("id").alias(node), F.col("component").alias("__known"))
        return frame.join(known, node, "left").withColumn(to, F.coalesce("__known", node)).drop("__known")

    def confirm(self, pairs: DataFrame, name: str) -> None:
        """Test pairs (a, b), and join the components of those that are linked."""
        new = pairs if self.tested is None else pairs.join(self.tested, ["a", "b"], "left_anti")
        new = self.scratch.keep(new, f"pairs-{name}")
        if new.isEmpty():
            return
        self.tested = new if self.tested is None else self.tested.union(new)
        first = self.sets.select(F.col("id").alias("a"), F.col("items").alias("set_a"))
        second = self.sets.select(F.col("id").alias("b"), F.col("items").alias("set_b"))
        found = new.join(first, "a").join(second, "b").select("a", "b", "set_a", "set_b")
        links = self.scratch.keep(found.mapInArrow(lean(_confirm(self.percent)), "a long, b long"), f"links-{name}")
        mapped = self.labelled(self.labelled(links, "a", "ca"), "b", "cb").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
        mapped = mapped.where("a <> b").distinct()
        if mapped.isEmpty():
            return
        joined = components(mapped, self.scratch)
        if self.labels is None:
            self.labels = joined
            return
        onto = joined.select(F.col("id").alias("component"), F.col("component").alias("__to"))
        moved = self.labels.join(onto, "component", "left").select("id", F.coalesce("__to", "component").alias("component"))
        # Nodes that had no link before carry their own id as component.
        fresh = joined.join(self.labels, "id", "left_anti")
        self.labels = self.scratch.keep(moved.union(fresh.select("id", "component")), f"components-{name}")


def _tables(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """(table, id, size, leader) for table keys that two nodes or more share."""
    halves = nodes.select("id", "size", F.explode("keys").alias("key"))
    shared = halves.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    lists = halves.join(shared.select("key"), "key", "left_semi").groupBy("id", "size").agg(F.sort_array(F.collect_list("key")).alias("keys"))
    pairs = F.expr(
        "flatten(transform(keys, (x, i) -> transform(slice(keys, i + 2, size(keys)), y -> xxhash64(x, y))))"
    )
    rows = lists.where(F.size("keys") > 1).select("id", "size", F.explode(pairs).alias("table"))
    rows = scratch.keep(rows, "table-keys")
    leaders = rows.groupBy("table").agg(F.min("id").alias("leader"), F.max("id").alias("high")).where("leader < high")
    return scratch.keep(rows.join(leaders.select("table", "leader"), "table"), "tables")


def _same_ids(usable: DataFrame, nodes: DataFrame, scratch: Scratch) -> DataFrame | None:
    """Components of the nodes that one document id joins; None where no id has two sets."""
    several = usable.groupBy("doc_id").agg(F.min("set_hash").alias("low"), F.max("set_hash").alias("high")).where("low < high")
    several = scratch.keep(several.select("doc_id"), "several")
    if several.isEmpty():
        return None
    of_ids = usable.join(several, "doc_id", "left_semi").select("doc_id", "set_hash").distinct()
    held = scratch.keep(of_ids.join(nodes.select("set_hash", "id"), "set_hash").select("doc_id", "id"), "ids")
    leaders = held.groupBy("doc_id").agg(F.min("id").alias("a"))
    edges = held.join(leaders, "doc_id").where("a < id").select("a", F.col("id").alias("b"))
    return components(edges, scratch)


def near_duplicates(
    documents: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id (the smallest id it is linked with,
    directly or not), kept (it is that document)."""
    spark: SparkSession = documents.sparkSession
    scratch = Scratch(spark, "near-duplicates")
    texts = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketches = scratch.keep(
        texts.mapInArrow(lean(_sketches(words)), "doc_id long, n_shingles long, set_hash binary, keys array<long>"), "sketches"
    )
    usable = sketches.where(F.col("doc_id").isNotNull() & F.col("set_hash").isNotNull())
    nodes = usable.groupBy("set_hash").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("size"), F.first("keys").alias("keys")
    )
    # The numbers are those of the written table; nothing computes them again.
    nodes = scratch.keep(nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")
    tables = _tables(nodes, scratch)
    members = scratch.keep(tables.select("id").distinct(), "members")
    wanted = nodes.join(members, "id", "left_semi").select("id", "doc_id", "set_hash")
    found = texts.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi").mapInArrow(
        lean(_sets(words)), "doc_id long, set_hash binary, items binary"
    )
    sets = found.join(wanted, ["doc_id", "set_hash"]).select("id", "set_hash", "items")
    sets = scratch.keep(sets.dropDuplicates(["id"]), "sets")

    rounds = _Rounds(scratch, sets, percent)
    rounds.labels = _same_ids(usable, nodes, scratch)
    others = tables.where("id <> leader")
    rounds.confirm(others.groupBy(F.col("id").alias("b")).agg(F.min("leader").alias("a")).select("a", "b"), "a")

    split = rounds.labelled(rounds.labelled(others.select("id", "leader").distinct(), "id", "ci"), "leader", "cl")
    rounds.confirm(split.where("ci <> cl").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct(), "b")

    owned = scratch.keep(rounds.labelled(tables, "id", "component"), "owned")
    mixed = owned.groupBy("table").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    left = scratch.keep(owned.join(mixed.select("table"), "table", "left_semi").select("id", "component").distinct(), "left")
    bits = scratch.keep(
        sets.join(left, "id", "left_semi")
        .select("id", "items")
        .mapInArrow(lean(_sketch_bits), "id long, " + ", ".join(f"{c} long" for c in _BIT_COLUMNS)),
        "bits",
    )
    # Two half keys in common make a table in common; a pair is met under its first one only.
    held = nodes.select("id", "size", "keys").join(left, "id").join(bits, "id").withColumn("key", F.explode("keys"))

    def side(name: str) -> DataFrame:
        return held.select("key", *(F.col(c).alias(f"{c}_{name}") for c in ("id", "size", "component", "keys", *_BIT_COLUMNS)))

    def differ(bits: int):
        columns = _BIT_COLUMNS[: bits // 64]
        return sum((F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in columns), F.lit(0))

    common = F.array_intersect("keys_a", "keys_b")
    across = side("a").join(side("b"), "key").where(
        (F.col("id_a") < F.col("id_b"))
        & (F.col("component_a") != F.col("component_b"))
        & (F.least("size_a", "size_b") * 100 >= F.greatest("size_a", "size_b") * percent)
        & (differ(FIRST_BITS) <= most_different_bits(percent, FIRST_BITS))
        & (differ(BITS) <= most_different_bits(percent))
        & (F.size(common) > 1)
        & (F.get(common, F.lit(0)) == F.col("key"))
    )
    across = across.select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))
    rounds.confirm(across.select("a", "b").distinct(), "c")

    owners = nodes.select("set_hash", F.col("doc_id").alias("component"))
    if rounds.labels is not None:
        linked = scratch.keep(nodes.select("id", "set_hash", "doc_id").join(rounds.labels, "id"), "linked")
        least = linked.groupBy("component").agg(F.min("doc_id").alias("__least"))
        moved = linked.join(least, "component").select("set_hash", "__least")
        owners = owners.join(moved, "set_hash", "left").select("set_hash", F.coalesce("__least", "component").alias("component"))
    rows = sketches.join(owners, "set_hash", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def keep_one_of_each(documents: DataFrame, id_col: str = "doc_id", **settings) -> DataFrame:
    """The documents without near-duplicates: of each component the smallest id stays."""
    found = near_duplicates(documents, id_col=id_col, **settings)
    gone = found.groupBy("doc_id").agg(F.max("kept").alias("kept")).where("not kept")
    gone = gone.select(F.col("doc_id").alias(id_col))
    return documents.join(gone, id_col, "left_anti").select(documents.columns)
