import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tidemark.llm import conversation_trie as ct

SCHEMA = "conv_id long, turn int, role string, text string, depth string, n_convs string"


def brute(rows):
    """Nodes by plain dictionaries over whole prefixes."""
    turns = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            order = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[conv].append((turn is not None, turn or 0, order, role, text))
    own = {c: [t[3:] for t in sorted(v)] for c, v in turns.items()}
    members = defaultdict(list)
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(abs(c) % 100) * (1 if c >= 0 else -1)
        path = own.get(base, [])[:h] + mine[h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append((c, len(path) == d))
    out = {}
    for node, found in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(len(o) == len(n) + 1 and o[: len(n)] == n for o in below)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n)
        ends = ",".join(str(c) for c in sorted(c for c, end in found if end))
        key = (min(c for c, _ in found), len(node))
        assert key not in out
        out[key] = (min(c for c, _ in members[node[:-1]]) if node else None, len(found), len(children), len(leaves), saved,
                    hashlib.sha256(ends.encode()).hexdigest())
    return out


def built(df, burst=ct.BURST, shard=ct.SHARD_CONVERSATIONS):
    rows = ct.trie_nodes(ct.rebuild(ct.conversation_rows(df)), burst, shard).collect()
    got = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in rows}
    assert len(got) == len(rows)
    return got


def hostile():
    rng = random.Random(5)
    rows = []
    for c in range(0, 260):  # few distinct turns: many shared prefixes and whole copies
        for t in range(rng.randint(1, 7)):
            rows.append((c, t, rng.choice(["user", "bot"]), f"text {rng.randint(0, 1)}", "x", None))
    rows += [(400 + c, t, "user", f"hot {t}", "x", "y") for c in range(40) for t in range(9)]
    rows += [(700, t, "user", f"long {t}", None, "y") for t in range(300)] + [(701, t, "user", f"long {t}", None, "y") for t in range(300)]
    rows += [(800, None, "user", "null turn", "x", None), (800, 1, None, None, "x", None), (800, 1, "", "", "x", None), (800, 1, "b", "é中", "x", None)]
    rows += [(None, 1, "user", "no conversation", "x", None), (-250, 1, "a", "neg", "x", None), (-250, 2, "a", "neg", "x", None),
             (-200, 1, "a", "base", "x", None), (901, 1, "a", "no base", "x", None), (950, 1, "ab", "c", "x", None), (951, 1, "a", "bc", "x", None)]
    return rows


@pytest.mark.parametrize("burst, shard", [(64, 8_192), (3, 40), (1, 7), (1_000, 60)])
def test_nodes_match_brute_force(spark, burst, shard):
    rows = hostile()
    random.Random(2).shuffle(rows)
    assert built(spark.createDataFrame(rows, SCHEMA).repartition(3), burst, shard) == brute(rows)


def test_runs_of_ends_stream_in_order(spark, monkeypatch):
    monkeypatch.setattr(ct, "RUN_IDS", 4)
    rows = [(c, t, "user", f"same {t}", "x", None) for c in range(60) for t in range(7)]
    assert built(spark.createDataFrame(rows, SCHEMA), 2, 9) == brute(rows)


def test_empty(spark):
    assert ct.build(spark.createDataFrame([], SCHEMA)).collect() == []


def test_containers_burst_and_stay_small():
    rng = random.Random(1)
    trie = ct.BurstTrie(4)
    for c in range(500):
        n = rng.randint(0, 6)
        trie.insert((c, "".join(f"{rng.randint(0, 2):032x}" for _ in range(n)), [1] * n))
    stack, held = [trie.root], 0
    while stack:
        head = stack.pop()
        held += len(head.ended)
        for key, below in head.next.items():
            if isinstance(below, ct.Head):
                assert below.depth == head.depth + 1
                stack.append(below)
            else:
                assert 0 < len(below) <= 4 and all(c[1][32 * head.depth: 32 * head.depth + 32] == key for c in below)
                held += len(below)
    assert held == 500
    order = [(c[1], c[0]) for c in trie.sweep().conversations]
    assert order == sorted(order) and len(order) == 500
