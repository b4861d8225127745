"""Near-duplicate groups by MinHash: universal hash minima, banding, verification, components.

1. A document's set holds the 64-bit hashes of its shingles.  Documents with one set form
   a class, represented by their smallest doc_id; only representatives go on.
2. ``BANDS * ROWS`` minima of universal hash functions give a bucket per band and, by their low
   bytes, the signature.  Representatives that agree in all rows of a band share a bucket.
   A pair at similarity 0.8 misses all 40 bands of 6 rows with probability 5e-6.
3. In each bucket the most central member (the one with the largest buckets) is paired with every other member, which is
   linear in the bucket.  Pairs whose signatures agree too little are dropped (the bound lies about four
   standard deviations below the threshold), the others are confirmed on the full sets.
4. Components by alternating large-star and small-star.
5. Buckets whose members are now in different components are the only place where a link between components
   can be left.  There the members outside the bucket's largest component are compared with all members, in cells of
   bounded size: by signatures, which mark the rows with a possible partner (in the first bucket that the two share), and then
   the marked rows on their full sets, where a cell leaves out pairs that its own confirmed links already connect.  The
   components are then closed again.  Pairs inside a component are never made, so a bucket of copies stays linear; no bucket
   is capped.

Edge cases: null or empty text, and text of white space only, has an empty set and no link; fewer words than a shingle are one
shingle; a null doc_id is returned with a null component and kept; rows that repeat a doc_id share its class when their texts do, and
otherwise the links of each count for the doc_id; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.llm.common import lower_words, map_batches, save, shared, slices

BANDS, ROWS = 40, 6
SHINGLE = 5
THRESHOLD = 80
_MARGIN = 20  # percent points below the threshold that a signature's agreement may lie
_FILTER_BITS, _FILTER_BLOCK = 26, 8_192  # largest id filter: 2**26 bits in blocks of 8 KB
_CELL = 512  # members of one side of a cell
_ROUNDS = 100
_EDGES = 250_000  # edges of a component step that one task writes

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = (h ^ h >> np.uint64(32)) * _M1
    h = (h ^ h >> np.uint64(29)) * _M2
    return h ^ h >> np.uint64(32)


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a UTF-8 text."""
    import xxhash

    words = lower_words(text)
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(size, len(words))
    mixed = _mix(hashes[: len(words) - width + 1] + np.uint64(width))
    for k in range(1, width):
        mixed = _mix(mixed * _M2 + hashes[k: len(words) - width + 1 + k])
    return np.unique(mixed)


def hash_family(number: int) -> tuple[np.ndarray, np.ndarray]:
    """Multiply-shift universal hash functions: odd factors and addends, from a fixed seed."""
    rng = np.random.default_rng(20240229)
    factors = rng.integers(0, 1 << 63, number, np.uint64) * np.uint64(2) + np.uint64(1)
    return factors[:, None], rng.integers(0, 1 << 63, number, np.uint64)[:, None]


def signature(hashes: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The minimum of each function over a set, as unsigned 32-bit values."""
    factors, addends = family
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 2048):  # a very long text goes through in parts
        np.minimum(least, (hashes[None, at: at + 2048] * factors + addends).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype("<u4")


_SKETCH = "doc_id long, n_shingles long, class binary, signature binary, buckets array<long>"


def bucket_keys(minima: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band from the minima of its rows."""
    minima = minima.reshape(bands, rows).astype(np.uint64)
    key = _mix(np.arange(1, bands + 1, dtype=np.uint64))
    for k in range(rows):
        key = _mix(key * _M2 + minima[:, k])
    return key.view(np.int64)


def _sketcher(size: int, bands: int, rows: int):
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = hash_family(bands * rows)
        for batch in slices(batches):
            sizes, classes, signatures, buckets = [], [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                hashes = shingle_set(text, size)
                sizes.append(len(hashes))
                if not len(hashes):
                    for column in (classes, signatures, buckets):
                        column.append(None)
                    continue
                minima = signature(hashes, family)
                classes.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
                signatures.append(minima.astype(np.uint8).tobytes())
                buckets.append(bucket_keys(minima, bands, rows))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()),
                                              pa.array(signatures, pa.binary()), pa.array(buckets, pa.list_(pa.int64()))],
                                             names=["doc_id", "n_shingles", "class", "signature", "buckets"])

    return run


def _alike(least: float):
    """Keep pairs whose signatures agree in at least ``least`` of their places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                a, b = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint8).reshape(part.num_rows, -1) for c in ("sig_a", "sig_b"))
                mask = pa.array((a == b).mean(axis=1) >= least)
                yield pa.RecordBatch.from_arrays([part.column("a").filter(mask), part.column("b").filter(mask)], names=["a", "b"])

    return run


def _places(ids: np.ndarray, bits: int) -> list[np.ndarray]:
    """The three bits of each id in a filter of ``bits`` bits, a power of two."""
    first = _mix(ids.astype(np.int64).view(np.uint64) + _M2)
    step = _mix(first) | np.uint64(1)
    return [((first + step * np.uint64(k)) & np.uint64(bits - 1)).astype(np.int64) for k in range(3)]


def _filter_blocks(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            for place in _places(batch.column("doc_id").to_numpy(), bits):
                np.bitwise_or.at(own, place >> 3, (1 << (place & 7)).astype(np.uint8))
        blocks = own.reshape(-1, _FILTER_BLOCK)
        used = np.flatnonzero(blocks.any(axis=1))
        yield pa.RecordBatch.from_pydict({"block": pa.array(used, pa.int64()), "bits": pa.array([blocks[k].tobytes() for k in used], pa.binary())})

    return run


def _either(parts: pa.Table) -> pa.Table:
    """One block of all tasks' filters put together."""
    whole = np.bitwise_or.reduce([np.frombuffer(v.as_py(), np.uint8) for v in parts.column("bits")])
    return pa.table({"block": [parts.column("block")[0].as_py()], "bits": [whole.tobytes()]})


def id_filter(ids: DataFrame) -> bytes:
    """A Bloom filter of the column doc_id, of at most ``_FILTER_BITS`` bits whatever the number of ids."""
    bits = 1 << min(_FILTER_BITS, max(16, (16 * ids.count()).bit_length()))
    schema = "block long, bits binary"
    blocks = map_batches(ids, _filter_blocks(bits), schema).groupBy("block").applyInArrow(_either, schema).collect()
    whole = np.zeros((bits // 8 // _FILTER_BLOCK, _FILTER_BLOCK), np.uint8)
    for row in blocks:
        whole[row["block"]] = np.frombuffer(row["bits"], np.uint8)
    return whole.tobytes()


def _setter(size: int, shared_filter):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.frombuffer(shared_filter.value, np.uint8)

        def wanted() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column("doc_id").fill_null(-1).to_numpy()
                mask = np.ones(len(ids), bool)
                for place in _places(ids, 8 * len(whole)):
                    mask &= (whole[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
                yield batch.filter(pa.array(mask))

        for batch in slices(wanted()):
            sets = [shingle_set(t, size).tobytes() for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.binary())], names=["doc_id", "shingles"])

    return run


def linked(x: bytes, y: bytes, threshold: int) -> bool:
    """Whether two sets reach the similarity, in percent."""
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= threshold * (len(a) + len(b) - both)


def _confirmer(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                mask = [linked(x, y, threshold) for x, y in zip(part.column("set_a").to_pylist(), part.column("set_b").to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(c).filter(pa.array(mask, pa.bool_())) for c in ("a", "b")], names=["a", "b"])

    return run


def _with(pairs: DataFrame, values: DataFrame, key: str, name: str, side: str) -> DataFrame:
    """Add column ``name`` of each pair's document on ``side``."""
    return pairs.join(values.select(F.col("doc_id").alias(side), F.col(name).alias(key)), side)


def shingle_sets(texts: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """doc_id, shingles of the documents in ``ids`` (and of a few more), computed from their whole texts.

    A filter of bounded size goes to the texts, so the texts themselves are not shuffled; the rows that it
    lets through by chance drop out of the joins that follow.
    """
    with shared(texts.sparkSession, id_filter(ids)) as now:
        return save(map_batches(texts, _setter(size, now), "doc_id long, shingles binary"), "sets")


def confirm(pairs: DataFrame, classes: DataFrame, texts: DataFrame, size: int, threshold: int) -> DataFrame:
    """The pairs (a, b) at or above the threshold: by signatures first, then on full sets."""
    signed = _with(_with(pairs, classes, "sig_a", "signature", "a"), classes, "sig_b", "signature", "b")
    near = save(map_batches(signed.select("a", "b", "sig_a", "sig_b"), _alike((threshold - _MARGIN) / 100), "a long, b long"), "near-pairs")
    sets = shingle_sets(texts, near.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), size)
    both = _with(_with(near, sets, "set_b", "shingles", "b"), sets, "set_a", "shingles", "a")
    return save(map_batches(both.select("a", "b", "set_a", "set_b"), _confirmer(threshold), "a long, b long").distinct(), "links")


def _signatures(rows: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint8).reshape(rows.num_rows, -1)


def _cell_marks(threshold: int):
    """The rows of a cell that have an alike row in another component, where this bucket is the first that both share."""
    least = (threshold - _MARGIN) / 100

    def run(key: tuple, members: pa.Table, strays: pa.Table) -> pa.Table:
        marked: set[int] = set()
        if members.num_rows and strays.num_rows:
            bucket = key[0].as_py()
            ids, groups, signatures = members.column("member").to_numpy(), members.column("component").to_numpy(), _signatures(members)
            buckets = np.array(members.column("buckets").to_pylist(), np.int64)
            own = zip(strays.column("member").to_pylist(), strays.column("component").to_pylist(), _signatures(strays), np.array(strays.column("buckets").to_pylist(), np.int64))
            for one, group, sign, keys in own:
                alike = np.flatnonzero(((signatures == sign).mean(axis=1) >= least) & (groups != group))
                if len(alike):
                    first = keys[(buckets[alike] == keys).argmax(axis=1)]
                    alike = alike[first == bucket]
                if len(alike):
                    marked.add(one)
                    marked.update(ids[alike].tolist())
        return pa.table({"bucket": pa.array([key[0].as_py()] * len(marked), pa.int64()), "member": pa.array(sorted(marked), pa.int64())})

    return run


def _cell_links(threshold: int):
    """Confirmed links between a cell's strays and its members, one for each pair of components that they connect."""
    least = (threshold - _MARGIN) / 100

    def run(key: tuple, members: pa.Table, strays: pa.Table) -> pa.Table:
        found: list[tuple[int, int]] = []
        if members.num_rows and strays.num_rows:
            ids, groups, signatures = members.column("member").to_numpy(), members.column("component").to_numpy(), _signatures(members)
            sets, parent = members.column("shingles").to_pylist(), {}

            def root(c: int) -> int:
                while parent.setdefault(c, c) != c:
                    c = parent[c]
                return c

            own = zip(strays.column("member").to_pylist(), strays.column("component").to_pylist(), _signatures(strays), strays.column("shingles").to_pylist())
            for one, group, sign, shingles in own:
                alike = (signatures == sign).mean(axis=1)
                for k in sorted(np.flatnonzero((alike >= least) & (groups != group)).tolist(), key=lambda k: -alike[k]):
                    x, y = root(group), root(int(groups[k]))
                    if x != y and linked(shingles, sets[k], threshold):
                        parent[max(x, y)] = min(x, y)
                        found.append((one, int(ids[k])))
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return run


def _mixed_rows(rows: DataFrame, label: str) -> DataFrame:
    """Rows (bucket, member, component) of buckets with several components: with n, odd (rows outside the largest component) and main (that one)."""
    parts = rows.groupBy("bucket", "component").agg(F.count("*").alias("k"))
    mixed = parts.groupBy("bucket").agg(F.count("*").alias("parts"), F.sum("k").alias("n"), F.max("k").alias("most"),
                                        F.max_by("component", F.struct("k", "component")).alias("main")).where("parts > 1")
    return save(rows.select("bucket", "member", "component").join(
        mixed.select("bucket", "n", (F.col("n") - F.col("most")).alias("odd"), "main"), "bucket"), label)


def _cells(rows: DataFrame, known: DataFrame, wide: list[str], run, schema: str) -> DataFrame:
    """Apply ``run`` to cells (bucket, i, j): part i of the bucket's members against part j of its strays."""

    def part(total: str, seed: int) -> tuple[Column, Column]:
        number = F.ceil(F.col(total) / _CELL).cast("int")
        return F.pmod(F.xxhash64(F.lit(seed), "member"), number).cast("int"), F.explode(F.sequence(F.lit(0), number - 1))

    def side(df: DataFrame, i: Column, j: Column):
        placed = df.select("bucket", i.alias("i"), j.alias("j"), "member", "component").join(known, "member")
        return placed.select(*(F.col(c).alias(c) for c in ("bucket", "i", "j", "member", "component", *wide))).groupBy("bucket", "i", "j")

    of_all, each_all = part("n", 1)
    of_odd, each_odd = part("odd", 2)
    strays = rows.where(F.col("component") != F.col("main"))
    return side(rows, of_all, each_odd).cogroup(side(strays, each_all, of_odd)).applyInArrow(run, schema)


def links_across(labels: DataFrame, signed: DataFrame, texts: DataFrame, size: int, threshold: int) -> DataFrame:
    """Links between components, from labels (bucket, member, component) of all buckets.

    Signatures tell first which rows have a possible partner at all; only these rows meet again with their full sets.
    """
    known = signed.withColumnRenamed("doc_id", "member")
    rows = _mixed_rows(labels, "open-members")
    marks = save(_cells(rows, known, ["signature", "buckets"], _cell_marks(threshold), "bucket long, member long").distinct(), "marks")
    rows = _mixed_rows(rows.join(marks, ["bucket", "member"], "left_semi"), "marked-members")
    sets = shingle_sets(texts, rows.select(F.col("member").alias("doc_id")).distinct(), size).withColumnRenamed("doc_id", "member")
    found = _cells(rows, known.select("member", "signature").join(sets, "member"), ["signature", "shingles"], _cell_links(threshold), "a long, b long")
    return save(found.distinct(), "links-across")


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) of every node of ``links`` (a, b).

    Alternates large-star (neighbours above a node move to the smallest node
    around it) and small-star (neighbours below it do) until nothing moves.
    """
    def kept(df: DataFrame, label: str, parts: int | None) -> tuple[DataFrame, tuple]:
        """Write the distinct edges; their number and the sum of their hashes come from the same pass."""
        seen = Observation(label)
        df = df.where("a <> b").distinct().observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"))
        df = save(df if parts is None else df.coalesce(parts), label)
        found = seen.get  # nothing is observed of a plan that the optimizer finds empty
        return df, (found.get("n") or 0, found.get("h"))

    edges, state = kept(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "edges", None)
    for _ in range(_ROUNDS):
        parts = 1 + state[0] // _EDGES  # a small graph need not be spread over every shuffle partition
        around = edges.union(edges.select("b", "a"))
        least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = around.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = save(large.coalesce(4 * parts), "large-star")
        small = large.join(large.groupBy("a").agg(F.min("b").alias("m")), "a")
        step = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select("a", F.col("m").alias("b")))
        before = state
        edges, state = kept(step, "small-star", parts)
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select("b", "b").distinct())


def find_groups(docs: DataFrame, size: int = SHINGLE, threshold: int = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept (component_id is the doc_id)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketch = save(map_batches(texts, _sketcher(size, bands, rows), _SKETCH), "sketches")
    named = sketch.where("class is not null and doc_id is not null")
    slim = named.select("class", "doc_id")
    first = save(slim.groupBy("class").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "classes")
    # representatives; a repeated doc_id may stand for several texts
    chosen = save(named.join(first.select("class", F.col("first").alias("doc_id")), ["class", "doc_id"], "left_semi")
                  .select("doc_id", "signature", "buckets"), "representatives")
    members = chosen.select(F.col("doc_id").alias("member"), F.explode("buckets").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    inside = save(members.join(shared, "bucket"), "shared-members")
    central = inside.groupBy("member").agg(F.sum("n").alias("weight"))
    pivots = inside.join(central, "member").groupBy("bucket").agg(F.max_by("member", F.struct("weight", -F.col("member"))).alias("pivot"))
    stars = inside.join(pivots, "bucket").where("member <> pivot").select(
        F.least("pivot", "member").alias("a"), F.greatest("pivot", "member").alias("b")).distinct()
    signed = save(chosen.join(inside.select(F.col("member").alias("doc_id")).distinct(), "doc_id", "left_semi"), "signatures")
    links = confirm(stars, signed, texts, size, threshold)
    # rows that repeat a doc_id with other texts tie the classes together by that doc_id
    split = slim.groupBy("doc_id").agg(F.min("class").alias("x"), F.max("class").alias("y")).where("x <> y")
    tied = slim.join(split.select("doc_id"), "doc_id", "left_semi").join(first, "class").where("first <> doc_id")
    links = links.union(tied.select(F.col("first").alias("a"), F.col("doc_id").alias("b")))
    found = save(components(links), "components")
    labels = save(inside.join(found.withColumnRenamed("node", "member"), "member", "left").select(
        "bucket", "member", F.coalesce("component", "member").alias("component")), "labels")
    more = links_across(labels, signed, texts, size, threshold)
    if more.limit(1).count():
        found = save(components(links.union(more)), "components")
    whole = first.join(found.withColumnRenamed("node", "first"), "first", "left").select(
        "class", F.coalesce("component", "first").alias("component"), F.col("n"), "first")
    # only classes of several documents, or linked ones, have anything to tell their rows
    told = whole.where("n > 1 or component <> first").select("class", "component")
    rows_ = sketch.select("doc_id", "n_shingles", "class").join(told, "class", "left")
    group = F.coalesce("component", "doc_id")
    return rows_.select("doc_id", "n_shingles", group.alias("component_id"), F.coalesce(F.col("doc_id") == group, F.lit(True)).alias("kept"))


def drop_near_copies(docs: DataFrame, size: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stand for their group, with all their columns."""
    lost = find_groups(docs, size, threshold).where("not kept").select(F.col("doc_id").alias("lost_id")).distinct()
    # one plan at every size: the rows to drop grow with the input, so they are never sent to all tasks
    return docs.join(lost.hint("merge"), docs["doc_id"].cast("long") == lost["lost_id"], "left_anti")
