"""The conversation trie against spelled-out prefixes."""

import collections
import hashlib
import random
import re
import zlib

import pytest

from tablekit.llm import prefix_trie
from tablekit.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLDER = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string, depth long, k1 string, n string, words string"


def spelled_out(rows):
    by = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            by[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    for turns in by.values():
        turns.sort()
    whole = {}
    for conv, turns in by.items():
        h = zlib.crc32(str(conv).encode()) % 4
        first = by.get(conv - conv % 20, [])
        whole[conv] = tuple((r, x) for _, r, x in first[:h] + turns[h:])
    members = collections.defaultdict(list)
    for conv, turns in whole.items():
        for depth in range(len(turns) + 1):
            members[turns[:depth]].append(conv)
    children, leaves, saved = (collections.Counter() for _ in range(3))
    out = []
    for node in sorted(members, key=len, reverse=True):
        leaves[node] += not children[node]
        saved[node] += (len(members[node]) - 1) * (len(WORD.findall(node[-1][1])) if node else 0)
        if node:
            children[node[:-1]] += 1
            leaves[node[:-1]] += leaves[node]
            saved[node[:-1]] += saved[node]
        ends = ",".join(str(c) for c in sorted(members[node]) if len(whole[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append(
            (min(members[node]), len(node), parent, len(members[node]), children[node], leaves[node], saved[node],
             hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=str)


def trie(spark, rows, **options):
    table = spark.createDataFrame([(*r, 7, "k1", "n", "words") for r in rows], SCHEMA)
    result = prefix_trie.conversation_trie(table, **options)
    assert result.columns == [x.split()[0] for x in prefix_trie.NODES.split(", ")]
    return sorted(map(tuple, result.collect()), key=str)


def long_rows():
    """Copies, a hot beginning, long conversations that part late, ties, repeated rows and nulls."""
    pick = random.Random(3)
    rows = []
    for conv in range(150):
        hot = [("user", f"shared  {i} words\there") for i in range(12)] if conv % 3 else []
        own = [(pick.choice(["user", "assistant", None]), pick.choice(["a b", "c", "", None])) for _ in range(pick.randrange(6))]
        rows += [(conv, i, r, x) for i, (r, x) in enumerate(hot + own)]
    for conv in (1000, 1001, 1003, 1020):
        turns = [("user", f"turn {i // 2}") for i in range(70)] + [("user", str(conv % 2))] * (conv % 5)
        rows += [(conv, i, r, x) for i, (r, x) in enumerate(turns)]
    rows += [(2001, None, "z", "null turn"), (2001, 5, "a", "tie"), (2001, 5, "a", "tie"), (2001, 5, "a", "a tie")]
    rows += [(2002, 0, "user", "only one, cut away"), (None, 0, "user", "of no conversation"), (-40, 0, "user", "below zero")]
    rows += [(3000, 0, "user", "w " * 300_000), (3000, 1, "a\nb", "c"), (3000, 2, "a", "b\nc")]
    return rows


@pytest.mark.parametrize("group_turns", [1, 60, prefix_trie.GROUP_TURNS])
def test_equals_spelled_out_prefixes(spark, group_turns):
    rows = long_rows()
    assert trie(spark, rows, group_turns=group_turns) == spelled_out(rows)


def test_whole_table(spark):
    rows = spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    got = QUERIES["op11_prefix_trie"](spark, FOLDER)
    assert sorted(map(tuple, got.collect()), key=str) == spelled_out(map(tuple, rows))


def test_small_batches_keep_groups_whole(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BATCH_NODES", 3)
    monkeypatch.setattr(prefix_trie, "BATCH_TURNS", 10)
    monkeypatch.setattr(prefix_trie, "END_RANGE", 7)
    rows = long_rows()
    assert trie(spark, rows) == spelled_out(rows)


def test_many_copies_end_in_one_node(spark):
    rows = [(20 * i, 0, "user", "the same") for i in range(2_000)]
    assert trie(spark, rows) == spelled_out(rows)


def test_empty_table_and_turnless_conversations(spark):
    assert trie(spark, []) == []
    # Conversations that lose their turns to a first conversation that is not there.
    alone = [(c, 0, "user", "x") for c in range(21, 40)]
    got = trie(spark, alone)
    assert got == spelled_out(alone) and any(r[1] == 0 and r[3] == 19 for r in got)
