"""The prefix trie against a plain version."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

from lakeaudit.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, path string, node int, depth long"
FIELDS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def plain_conversations(rows) -> dict:
    turns = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        role, text = role or "", text or ""
        if conv is not None:
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            turns[conv].append(((turn is not None, turn or 0), digest, (role, text)))
    return {c: [t[2] for t in sorted(ts, key=lambda t: t[:2])] for c, ts in turns.items()}


def plain_spliced(convs: dict) -> dict:
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def plain_trie(convs: dict) -> list[tuple]:
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node, ids in members.items():
        below = [n for n in members if n[: len(node)] == node]
        leaf = lambda n: not any(m[: len(n)] == n and len(m) == len(n) + 1 for m in members)
        ends = ",".join(str(c) for c in sorted(c for c in ids if len(convs[c]) == len(node)))
        out.append((
            min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), sum(len(n) == len(node) + 1 for n in below),
            sum(leaf(n) for n in below), sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n), hashlib.sha256(ends.encode()).hexdigest()))
    return out


def rows_of(seed: int) -> list[tuple]:
    """Hot first turns and whole copies, NULLs in each column, tied and repeated turns, negative and huge ids, a long text."""
    rng = random.Random(seed)
    said = ["", None, "a", "b", "äé", "x" * 5000]
    rows = []
    for c in [*range(-12, 60), 10**15, 2**62]:
        length = rng.choice([0, 1, 2, 3, 5, 12])
        rows += [(c, i, rng.choice(["user", "tool"]) if i else "user", rng.choice(said) if i else "a", "p", 1, 2) for i in range(length)]
    for c in range(100, 140):
        rows += [(c, i, "user", f"copy {i}", "p", 1, 2) for i in range(3)]
    rows += [(7, None, "user", "first", None, None, None), (7, 1, None, "tied", None, None, None), (7, 1, None, "tied", None, None, None)]
    rows += [(8, None, None, None, None, None, None)] * 2 + [(None, 1, "user", "no conversation", None, None, None)]
    rng.shuffle(rows)
    return rows


def trie(spark, rows, splice: bool) -> list[tuple]:
    paths = prefix_trie.conversations(spark.createDataFrame(rows, SCHEMA).repartition(5))
    out = prefix_trie.prefix_trie(prefix_trie.spliced(paths) if splice else paths)
    return [tuple(r) for r in out.select(*FIELDS).collect()]


def test_trie(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK_IDS", 4)  # an ending's ids come in many blocks
    for splice in (True, False):
        rows = rows_of(3)
        convs = plain_conversations(rows)
        want = plain_trie(plain_spliced(convs) if splice else convs)
        assert sorted(trie(spark, rows, splice)) == sorted(want)
        assert max(w[3] for w in want if w[1]) > 30 and len(want) > 90


def test_trie_edges(spark):
    assert trie(spark, [], True) == [] and trie(spark, [(None, 1, "a", "b", None, None, None)], False) == []
    root = (5, 0, None, 2, 0, 1, 0, hashlib.sha256(b"5,9").hexdigest())
    empty = spark.createDataFrame([(5, []), (9, [])], "conv_id long, path array<struct<digest:binary,bytes:long>>")
    assert [tuple(r) for r in prefix_trie.prefix_trie(empty).select(*FIELDS).collect()] == [root]


def test_jobs_do_not_grow_with_depth(spark):
    """A conversation of many turns is peeled by as many jobs as a short one."""
    context, jobs = spark.sparkContext, []
    for turns in (3, 60):
        context.setJobGroup(f"trie-{turns}", "trie")
        rows = [(c, i, "user", f"{c % 2} {i // 50}", "p", 1, 2) for c in range(4) for i in range(turns if c == 3 else 3)]
        assert sorted(trie(spark, rows, False)) == sorted(plain_trie(plain_conversations(rows)))
        jobs.append(len(context.statusTracker().getJobIdsForGroup(f"trie-{turns}")))
    context._jsc.clearJobGroup()
    assert 0 < jobs[1] <= jobs[0] + 2


def test_path_of_each_node(spark):
    rows = rows_of(5)
    paths = prefix_trie.spliced(prefix_trie.conversations(spark.createDataFrame(rows, SCHEMA)))
    whole = {r.conv_id: r.path for r in paths.collect()}
    nodes = prefix_trie.prefix_trie(paths).collect()
    assert len({tuple(n.path) for n in nodes}) == len(nodes) and all(n.path == whole[n.conv_id][: n.depth] for n in nodes)
