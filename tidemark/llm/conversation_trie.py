"""Conversation prefix trie by burst tries over sorted shards.

1. *Turns* get a 128-bit id from role and text; a conversation is the row of its turn ids in order.
   ``rebuild`` gives each one the first turns of its base conversation.
2. *Shards.*  Conversations are ranged by (turn ids, conv_id), so a shard is a run of the sorted order and no group of equal
   conversations or common beginnings, however large, has to stay in one shard.
3. *Burst trie.*  A shard inserts its conversations under trie heads.  A container of suffixes that outgrows
   ``BURST`` becomes a head and deals its suffixes out by the next turn id.  The containers that remain are
   sorted and swept into nodes by common prefixes.
4. *Seams.*  In sorted order a node's members are a run, so only prefixes of a shard's first and last conversation that the
   neighbouring shard has too are shared.  Their sums are additive: a shared node's leaves and distinct texts are counted by
   the last shard that holds it, members and their texts by each.  They are merged by path fingerprint (a row per shard and
   depth), and each shard's nodes get the merged parents' ids back by (shard, parent), so no popular parent is one join key.
5. *Ends.*  A shared node's ends arrive as sorted runs of up to ``RUN_IDS`` ids and stream through the hash, which
   is the one step that must follow their order.

Subtree sums: ``saved_tokens`` is the members' code points in the subtree less each distinct node's, once.

Edge cases: rows with a null conv_id take no part; null role and text are empty, null turn comes first; turns with the same number
stand in the order of their fingerprints, repeated rows stay separate turns; a base without rows lends nothing; a conversation
rebuilt without turns ends at the root; an empty table gives no rows.  Other columns are not read.  One conversation's turn ids
(36 bytes a turn) have to fit a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, save, ship_package

#: Suffixes of a container beyond which it bursts.
BURST = 64
#: Conversations of a shard, on average.
SHARD_CONVERSATIONS = 8_192
RUN_IDS = 65_536
BASE_STEP = 100
BASE_TURNS = 6
ID = 32  # hexadecimal digits of a turn id

_NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_id(role: Column, text: Column) -> Column:
    """128 bits of the SHA-256 of role and text, told apart by the role's length."""
    return F.substring(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256), 1, ID)


def conversation_rows(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's (turn, id, code points) in order."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").alias("turn"), turn_id(role, text).alias("id"), F.char_length(text).alias("chars")).alias("turn"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))


def rebuild(conversations: DataFrame, step: int = BASE_STEP, most: int = BASE_TURNS) -> DataFrame:
    """First h turns of the base conversation, then the own turns after the first h; h = crc32(conv_id) % most.

    A base serves fewer than two times ``step`` conversations and lends fewer than ``most`` turns.
    """
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    own = conversations.withColumns({"base": F.col("conv_id") - F.col("conv_id") % step, "taken": taken})
    bases = conversations.where(F.col("conv_id") % step == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, most - 1).alias("lent"))
    lent = F.coalesce(F.slice("lent", F.lit(1), F.col("taken")), F.slice("turns", 1, 0))
    rest = F.slice("turns", F.col("taken") + 1, F.greatest(F.size("turns") - F.col("taken"), F.lit(0)))
    return own.join(bases, "base", "left").select("conv_id", F.concat(lent, rest).alias("turns"))


class Head:
    """Trie node with its ended conversations, and per next turn id a head or a container (a list) of suffixes."""

    __slots__ = ("depth", "ended", "next")

    def __init__(self, depth: int):
        self.depth, self.ended, self.next = depth, [], {}


class BurstTrie:
    """Conversations are (conv_id, path, chars): the path is the joined turn ids."""

    def __init__(self, burst: int = BURST):
        self.burst = burst
        self.root = Head(0)

    def insert(self, conversation: tuple) -> None:
        head, path = self.root, conversation[1]
        while True:
            at = ID * head.depth
            if at == len(path):
                head.ended.append(conversation)
                return
            key = path[at: at + ID]
            below = head.next.get(key)
            if below is None:
                head.next[key] = [conversation]
                return
            if isinstance(below, Head):
                head = below
                continue
            below.append(conversation)
            while len(below) > self.burst:  # bursting may leave one container with nearly all suffixes
                fresh = Head(head.depth + 1)
                head.next[key] = fresh
                at = ID * fresh.depth
                for c in below:
                    if at == len(c[1]):
                        fresh.ended.append(c)
                    else:
                        fresh.next.setdefault(c[1][at: at + ID], []).append(c)
                large = [k for k, v in fresh.next.items() if len(v) > self.burst]
                if not large:
                    break
                head, key = fresh, large[0]  # the others hold at most one less: no second one is this large
                below = fresh.next[key]
            return

    def sweep(self) -> Nodes:
        """All nodes in preorder, over the conversations in order of (path, conv_id)."""
        nodes = Nodes()
        stack: list = [self.root]
        while stack:
            item = stack.pop()
            if isinstance(item, int):
                nodes.close(item)
            elif isinstance(item, Head):
                stack.append(nodes.open(item.depth))
                for c in sorted(item.ended, key=lambda c: c[0]):
                    nodes.add(c)
                stack += [item.next[k] for k in sorted(item.next, reverse=True)]
            else:
                self._sweep_container(nodes, item)
        return nodes

    @staticmethod
    def _sweep_container(nodes: Nodes, container: list[tuple]) -> None:
        container.sort(key=lambda c: (c[1], c[0]))
        above = nodes.depth_open()
        opened: list[int] = []
        last = ""
        for c in container:
            path, common = c[1], above
            while opened and common < above + len(opened) and path[ID * common: ID * common + ID] == last[ID * common: ID * common + ID] != "":
                common += 1
            while above + len(opened) > common:
                nodes.close(opened.pop())
            for depth in range(common + 1, len(path) // ID + 1):
                opened.append(nodes.open(depth))
            nodes.add(c)
            last = path
        while opened:
            nodes.close(opened.pop())


class Nodes:
    """Nodes in preorder with the run of sorted conversations below each."""

    def __init__(self):
        self.conversations: list[tuple] = []
        self.depth: list[int] = []
        self.parent: list[int] = []
        self.low: list[int] = []
        self.high: list[int] = []
        self._open: list[int] = []

    def open(self, depth: int) -> int:
        self.depth.append(depth)
        self.parent.append(self._open[-1] if self._open else -1)
        self.low.append(len(self.conversations))
        self.high.append(-1)
        self._open.append(len(self.depth) - 1)
        return self._open[-1]

    def close(self, node: int) -> None:
        self._open.pop()
        self.high[node] = len(self.conversations)

    def depth_open(self) -> int:
        return self.depth[self._open[-1]]

    def add(self, conversation: tuple) -> None:
        self.conversations.append(conversation)

    def ended(self, node: int) -> list[int]:
        """Ids of the conversations that end at a node, ascending: the first ones of its run."""
        at, out = self.low[node], []
        length = ID * self.depth[node]
        while at < self.high[node] and len(self.conversations[at][1]) == length:
            out.append(self.conversations[at][0])
            at += 1
        return out


def common_turns(a: str | None, b: str) -> int:
    """Number of equal first turns; -1 without a neighbour."""
    if a is None:
        return -1
    low, high = 0, min(len(a), len(b)) // ID
    while low < high:
        middle = (low + high + 1) // 2
        if a[: ID * middle] == b[: ID * middle]:
            low = middle
        else:
            high = middle - 1
    return low


_NODES = pa.schema([("kind", pa.string()), ("shard", pa.int64()), ("key", pa.string()), ("parent_key", pa.string()), ("conv_id", pa.int64()),
                    ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
                    ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("run", pa.int64()), ("ids", pa.string())])
_NODES_DDL = ("kind string, shard long, key string, parent_key string, conv_id long, depth long, parent_conv_id long, n_convs long, "
              "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, run long, ids string")


def shard_nodes(shard: int, conversations: list[tuple], previous: str | None, following: str | None, burst: int) -> list[dict]:
    """Rows of one shard: ``node`` (whole), ``shared`` (a part) and ``ends`` (runs of a shared node's ended ids)."""
    trie = BurstTrie(burst)
    for c in conversations:
        trie.insert(c)
    nodes = trie.sweep()
    rows, total = len(nodes.depth), len(nodes.conversations)
    first, last = nodes.conversations[0][1], nodes.conversations[-1][1]
    left, right = common_turns(previous, first), common_turns(following, last)

    children, leaves, saved = [0] * rows, [0] * rows, [0] * rows
    smallest: list[int | None] = [None] * rows
    later = [nodes.high[k] == total and nodes.depth[k] <= right for k in range(rows)]  # a later shard has it too
    seam = [later[k] or (nodes.low[k] == 0 and nodes.depth[k] <= left) for k in range(rows)]
    has_child = [False] * rows
    for k in range(rows - 1, -1, -1):
        depth, low, high, parent = nodes.depth[k], nodes.low[k], nodes.high[k], nodes.parent[k]
        chars = nodes.conversations[low][2][depth - 1] if depth else 0
        saved[k] += (high - low) * chars - (0 if later[k] else chars)
        if not has_child[k] and not later[k]:
            leaves[k] = 1
        ended = nodes.ended(k)
        own = [ended[0]] if ended else []
        smallest[k] = min([*own, smallest[k]] if smallest[k] is not None else own)
        if parent >= 0:
            has_child[parent] = True
            children[parent] += not later[k]
            leaves[parent] += leaves[k]
            saved[parent] += saved[k]
            if smallest[parent] is None or smallest[k] < smallest[parent]:
                smallest[parent] = smallest[k]

    keys: dict[int, str] = {}
    for path, depth in ((first, left), (last, right)):  # fingerprints of the seams' prefixes
        digest = hashlib.sha256()
        of_depth = {0: digest.hexdigest()[:ID]}
        for d in range(1, depth + 1):
            digest.update(path[ID * (d - 1): ID * d].encode())
            of_depth[d] = digest.copy().hexdigest()[:ID]
        at_start = path is first
        for k in range(rows):
            if seam[k] and nodes.depth[k] <= depth and (nodes.low[k] == 0 if at_start else nodes.high[k] == total):
                keys[k] = of_depth[nodes.depth[k]]

    out = []
    for k in range(rows):
        parent = nodes.parent[k]
        row = {"shard": shard, "conv_id": smallest[k], "depth": nodes.depth[k], "n_convs": nodes.high[k] - nodes.low[k],
               "n_children": children[k], "n_leaves": leaves[k], "saved_tokens": saved[k],
               "parent_key": keys.get(parent), "parent_conv_id": None if parent < 0 or parent in keys else smallest[parent]}
        ended = nodes.ended(k)
        if k not in keys:
            out.append(row | {"kind": "node", "ends_sha256": hashlib.sha256(",".join(map(str, ended)).encode()).hexdigest()})
            continue
        out.append(row | {"kind": "shared", "key": keys[k]})
        out += [{"kind": "ends", "key": keys[k], "shard": shard, "run": at, "ids": ",".join(map(str, ended[at: at + RUN_IDS]))}
                for at in range(0, len(ended), RUN_IDS)]
    return out


def _sweep_shards(burst: int):
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        bounds = right.to_pylist()[0]
        rows = list(zip(left["conv_id"].to_pylist(), left["path"].to_pylist(), left["chars"].to_pylist()))
        return pa.Table.from_pylist(shard_nodes(key[0].as_py(), rows, bounds["previous"], bounds["following"], burst), schema=_NODES)

    return run


def _hash_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's runs, which arrive in order."""
    schema = pa.schema([("key", pa.string()), ("ends_sha256", pa.string())])
    current, digest = None, None
    for batch in batches:
        done = []
        for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
            if key != current:
                if current is not None:
                    done.append({"key": current, "ends_sha256": digest.hexdigest()})
                current, digest = key, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=schema)
    if current is not None:
        yield pa.RecordBatch.from_pylist([{"key": current, "ends_sha256": digest.hexdigest()}], schema=schema)


def trie_nodes(conversations: DataFrame, burst: int = BURST, shard_conversations: int = SHARD_CONVERSATIONS) -> DataFrame:
    """One row per trie node of conversations given as (conv_id, turns of (turn, id, chars))."""
    paths = save(conversations.select("conv_id", F.array_join(F.col("turns.id"), "").alias("path"), F.col("turns.chars").alias("chars")),
                 "trie-paths")
    shards = max(1, -(-paths.count() // shard_conversations))
    ordered = save(paths.repartitionByRange(shards, "path", "conv_id").select("*", F.spark_partition_id().cast("long").alias("shard")),
                   "trie-shards")
    ends = ordered.groupBy("shard").agg(F.min("path").alias("first"), F.max("path").alias("last"))
    order = Window.orderBy("shard")  # one number per shard
    beside = ends.select("shard", F.lag("shard").over(order).alias("before"), F.lead("shard").over(order).alias("after"))
    bounds = (beside.join(ends.select(F.col("shard").alias("before"), F.col("last").alias("previous")), "before", "left")
              .join(ends.select(F.col("shard").alias("after"), F.col("first").alias("following")), "after", "left")
              .select(F.col("shard").alias("at"), "previous", "following"))
    ship_package(conversations.sparkSession)
    swept = save(ordered.groupBy("shard").cogroup(bounds.groupBy("at")).applyInArrow(_sweep_shards(burst), _NODES_DDL), "trie-nodes")

    result = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    shared = swept.where("kind = 'shared'")
    hashes = map_batches(swept.where("kind = 'ends'").select("key", "shard", "run", "ids").repartition("key")
                         .sortWithinPartitions("key", "shard", "run").select("key", "ids"), _hash_runs, "key string, ends_sha256 string")
    merged = save(shared.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent_key").alias("parent_key"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")))
        .join(hashes, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_ENDS))), "trie-merged")
    ids = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    of_shard = shared.select("shard", F.col("key").alias("parent_key")).join(ids, "parent_key")  # a row per shard and depth
    inside = swept.where("kind = 'node'")
    whole = inside.where("parent_key IS NULL").select(*result)
    below = inside.where("parent_key IS NOT NULL").drop("parent_conv_id").join(of_shard, ["shard", "parent_key"]).select(*result)
    return whole.unionByName(below).unionByName(merged.join(ids, "parent_key", "left").select(*result))


def build(turns: DataFrame) -> DataFrame:
    """Nodes of the rebuilt conversations of a table of turns (conv_id, turn, role, text)."""
    return trie_nodes(rebuild(conversation_rows(turns)))


def oracle_sql() -> str:
    """The same nodes by grouping all prefixes; the CRC-32 is folded bit by bit."""
    crc = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
                 lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda y, i: xor(y >> 1, 3988292384 * (y & 1)))), 4294967295)"""
    return rf"""
    WITH t AS (SELECT conv_id::BIGINT AS conv_id, turn, coalesce(text, '') AS x,
                      substring(sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')), 1, {ID}) AS id
               FROM conversations WHERE conv_id IS NOT NULL),
         p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id) AS p FROM t),
         c AS (SELECT conv_id, conv_id - conv_id % {BASE_STEP} AS base, {crc} % {BASE_TURNS} AS h FROM (SELECT DISTINCT conv_id FROM t)),
         r AS (SELECT c.conv_id, 0 AS own, p, id, x FROM c JOIN p ON p.conv_id = c.base AND p <= h
               UNION ALL SELECT c.conv_id, 1, p, id, x FROM c JOIN p ON p.conv_id = c.conv_id AND p > h),
         m AS (SELECT conv_id, row_number() OVER w AS d, string_agg(id, '') OVER w AS k, length(x) AS chars FROM r
               WINDOW w AS (PARTITION BY conv_id ORDER BY own, p)
               UNION ALL SELECT conv_id, 0, '', 0 FROM c),
         n AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(chars) AS own,
                      CASE WHEN d > 0 THEN left(k, length(k) - {ID}) END AS up FROM m GROUP BY k, d),
         q AS (SELECT n.*, (SELECT count(*) FROM n b WHERE b.up = n.k) AS n_children FROM n),
         s AS (SELECT a.k, sum(q.own) AS saved_tokens, count(*) FILTER (WHERE q.n_children = 0) AS n_leaves
               FROM (SELECT DISTINCT a.k, b.k AS below FROM m a JOIN m b ON a.conv_id = b.conv_id AND b.d >= a.d) a JOIN q ON q.k = a.below GROUP BY a.k),
         e AS (SELECT k, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
               FROM (SELECT conv_id, arg_max(k, d) AS k FROM m GROUP BY conv_id) GROUP BY k)
    SELECT q.conv_id, q.d AS depth, u.conv_id AS parent_conv_id, q.n_convs, q.n_children, s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens,
           sha256(coalesce(e.ids, '')) AS ends_sha256
    FROM q JOIN s USING (k) LEFT JOIN q u ON u.k = q.up LEFT JOIN e ON e.k = q.k"""
