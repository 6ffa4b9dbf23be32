"""The trie of conversations against one built turn by turn."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from sedimenta.llm.conversation_trie import conversation_trie, digest_turns, prefix_trie, share_heads
from sedimenta.llm.scratch import Scratch

SCHEMA = "conv_id long, turn long, role string, text string, level int, path string, node string"


def digest(role, text):
    role, text = role or "", text or ""
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def brute(rows):
    turns = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, digest(role, text), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(v)] for c, v in turns.items()}
    rebuilt = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        head = c - int(c / 5) * 5  # the remainder has the sign of c
        rebuilt[c] = own.get(c - head, [])[:h] + v[h:]
    members = defaultdict(list)
    for c, v in rebuilt.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    out = []
    for node, convs in members.items():
        under = [n for n in members if n[: len(node)] == node]
        inner = {n[:-1] for n in members if n}
        ends = ",".join(str(c) for c in sorted(convs) if len(rebuilt[c]) == len(node))
        out.append(
            (
                min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
                sum(n[:-1] == node for n in members if n), sum(n not in inner for n in under),
                sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in under if n),
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def rows(seed=3):
    rng = random.Random(seed)
    out = []
    texts = [[rng.choice(["a", "bé", "", "ccc", None]) for _ in range(30)] for _ in range(4)]
    for c in [*range(0, 60), *range(-7, 0), 1000, 1004, 10**15]:
        story = rng.choice(texts)
        for t in range(rng.choice([0, 1, 3, 4, 5, 8, 9, 12, 20])):
            text = story[t] if rng.random() < 0.9 else rng.choice("xyz")
            out.append((c, t, rng.choice(["user", "user", None]) if t == 3 else "user", text, 1, "p", "n"))
    same = out[:3] + [(c, None, "system", "first", None, None, None) for c in (1, 2, 3, 70)]
    ties = [(5, 2, "b", "tie", 1, "p", "n"), (5, 2, "a", "tie", 1, "p", "n"), (5, 2, "ab", "", 1, "p", "n"), (5, 2, "a", "b", 1, "p", "n")]
    out += same + ties + [(None, 0, "user", "nobody", 1, "p", "n")]
    rng.shuffle(out)
    return out


def ordered(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("block", [1, 2, 4])
def test_nodes(spark, block):
    table = rows()
    assert ordered(prefix_trie(spark.createDataFrame(table, SCHEMA).repartition(3), block)) == brute(table)


def test_a_long_conversation_and_many_equal_ones(spark):
    rng = random.Random(5)
    long = [(0, t, "user", rng.choice("ab"), 1, "", "") for t in range(400)]
    caterpillar = [(1000 + 5 * i, t, "user", "s", 1, "", "") for i in range(12) for t in range(3 * i)]
    equal = [(5000 + i, t, "user", "same", 1, "", "") for i in range(150) for t in range(10)]
    table = long + caterpillar + equal
    assert ordered(prefix_trie(spark.createDataFrame(table, SCHEMA).repartition(5))) == brute(table)


def test_empty_and_turnless(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert prefix_trie(none).collect() == []
    assert prefix_trie(spark.createDataFrame([(None, 1, "a", "b", 1, "", "")], SCHEMA)).collect() == []
    # Conversation 1 has one turn, which falls into its head; conversation 0 is not there.
    assert zlib.crc32(b"1") % 9 > 0
    table = [(1, 0, "user", "x", 1, "", "")]
    got = ordered(prefix_trie(spark.createDataFrame(table, SCHEMA)))
    assert got == brute(table) and got[0][5] == 1 and len(got) == 1


def test_turns_are_grouped_only_where_paths_part(spark):
    """Of conversations that agree for eight turns and then part, two blocks keep their path as name."""
    from sedimenta.llm.conversation_trie import _cut_into_blocks, _least_and_count, _prefixes

    table = [(5 * c, t, "user", "same" if t < 8 else f"{c % 3}", 1, "", "") for c in range(6) for t in range(10)]
    scratch = Scratch(spark, "test")
    turns, _ = share_heads(digest_turns(spark.createDataFrame(table, SCHEMA), scratch), scratch)
    trie = _least_and_count(_cut_into_blocks(turns, 4, scratch))
    split = [(r.level, r.split, r.n) for r in _prefixes(trie, 4, scratch).collect()]
    assert sorted(split) == [(0, False, 6)] * 4 + [(1, False, 6)] * 4 + [(2, True, 2)] * 6


def test_without_shared_heads(spark):
    table = [(1, 0, "u", "a", 1, "", ""), (1, 1, "u", "b", 1, "", ""), (2, 0, "u", "a", 1, "", "")]
    scratch = Scratch(spark, "test")
    turns = digest_turns(spark.createDataFrame(table, SCHEMA), scratch)
    got = ordered(conversation_trie(turns, turns.select("conv_id").distinct()))
    assert [(r[0], r[1], r[2], r[3], r[6]) for r in got] == [(1, 0, None, 2, 1), (1, 1, 1, 2, 1), (1, 2, 1, 1, 0)]
