"""Records of JSON documents of any size, found by many tasks (SRC2, SRC3, SRC10).

A whole-file payload is one array of records, or an object with the records in an array under a key.  Tasks read
byte ranges of it (cut behind closing braces), and what a byte means depends on everything before it: whether a
string is open, and how deep the nesting is.

1. *Sum up.*  Each task reduces its ranges to whether quotes turn the string state round, and the change of depth under both
   assumptions about that state.
2. *Settle.*  Windows over these few numbers, a row per range, give each range its true state and depth.
3. *Count.*  Knowing them, each task finds the borders of the array's elements and counts the elements that start in its ranges:
   those of an array that an earlier range opened, and those of collections opened here.  Windows over the counts tell which
   arrays are the collection and give each range the number of records before it.
4. *Cut.*  Each task emits the elements that start in its ranges, with their final numbers.  For one that reaches over the end
   of its range the task reads on.  No text is shuffled or stored, and the rows between the passes are one per range.

Tasks read the bytes themselves through ``pyarrow.fs``, many ranges in turn.  Compressed files, and those on file systems that only
Spark's readers open, come from Spark's text reader as rows that end at closing braces.  There 3 and 4 are one
pass that emits whole elements; one that reaches over ranges leaves parts that share the number of borders before them, and are
joined in order, and the keys before arrays, a few rows per document, tell which are the collection.

Brackets, commas and quotes are found as whole numpy columns; Python steps from one array or object of the top level to the next.  A
document that is not closed at its end, or is neither array nor object, contributes no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import materialize, shared_path
from tidemark.sources.files import file_opener
from tidemark.sources.ordinal import ROW_NUMBER
from tidemark.sources.quoted_csv import split_size

#: Input range of a task; a task takes as many smaller ones in turn, once every core has work.
RANGE_BYTES = 64 * 1024 * 1024
#: Chunks of Spark's reader: up to so many ranges (some 300 bytes each) their states are broadcast; beyond, ranges are sorted to them.
BROADCAST_RANGES = 50_000

_SUMS = "_file string, _block long, _size long, size long, turns boolean, depth0 long, depth1 long, lead string"
_COUNTS = "_file string, _block long, inherited long, own long, last boolean"
_RECORDS = f"_file string, {ROW_NUMBER} long, record string"
_FOUND = "_file string, _block long, kind string, container long, borders long, number long, text string, collection boolean"


def _ranges(spark: SparkSession, path: str) -> DataFrame:
    chunks = spark.read.option("lineSep", "}").text(path)
    return chunks.select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                         F.col("_metadata.file_size").alias("_size"))


def _byte_columns():
    """(buffers of one range) from batches, what quotes and brackets a buffer has, and where it has brackets and commas."""
    import numpy as np

    others = bytes(set(range(256)) - set(b'{}[],"'))
    flags = bytes(c in b'{}[],"' for c in range(256))

    def buffers(batches, limit=4 << 20):
        """(file, range, first row of it as a dict, bytes) for runs of chunks, each with its closing brace back."""
        for batch in batches:
            if not batch.num_rows:
                continue
            files, blocks = batch.column("_file").to_pylist(), batch.column("_block").to_pylist()
            held, size, at = [], 0, 0
            for k, chunk in enumerate(batch.column("value").cast(pa.binary()).to_pylist()):
                if held and (size > limit or (files[k], blocks[k]) != (files[at], blocks[at])):
                    yield (files[at], blocks[at]), batch.slice(at, 1), b"}".join(held) + b"}"
                    held, size, at = [], 0, k
                held.append(chunk)
                size += len(chunk) + 1
            yield (files[at], blocks[at]), batch.slice(at, 1), b"}".join(held) + b"}"

    def unescaped(data):
        """The bytes with letters in the place of escaped backslashes and quotes."""
        return data.replace(b"\\\\", b"__").replace(b'\\"', b"__") if b"\\" in data else data

    def brackets(codes):
        """Which of the bytes open something, and which close it."""
        low = codes | 32
        return low == 123, low == 125

    def summary(data):
        """Number of quotes, and the change of depth before the first, third, ... quote, and behind the others."""
        codes = np.frombuffer(unescaped(data).translate(None, others), np.uint8)
        quote = codes == 34
        odd = (np.cumsum(quote, dtype=np.uint8) & 1).view(bool)
        opens, closes = brackets(codes)
        inner = np.count_nonzero(opens & odd) - np.count_nonzero(closes & odd)
        return int(np.count_nonzero(quote)), int(np.count_nonzero(opens) - np.count_nonzero(closes) - inner), int(inner)

    def structure(data, quoted, depth):
        """Of the brackets and commas outside strings: their places, their numbers among all brackets, commas and quotes, bytes, +1 / -1
        for brackets, and the depth after them; then whether a string is open after the last byte, and the depth there."""
        plain = unescaped(data)
        codes = np.frombuffer(plain.translate(None, others), np.uint8)
        quote = codes == 34
        odd = (np.cumsum(quote, dtype=np.uint8) + np.uint8(quoted)) & 1
        number = np.flatnonzero((odd == 0) & ~quote)
        byte = codes[number]
        opens, closes = brackets(byte)
        change = opens.view(np.int8) - closes.view(np.int8)
        after = np.cumsum(change, dtype=np.int64)
        after += depth
        at = np.flatnonzero(np.frombuffer(plain.translate(flags), np.bool_))[number]
        return at, number, byte, change, after, int(odd[-1]) if len(odd) else quoted, int(after[-1]) if len(after) else depth

    def key_before(data, at, collection, most=65_536):
        """Whether the key before a bracket is the collection's."""
        import json

        head = data[max(0, at - most): at].rstrip()
        if not head.endswith(b":"):
            return False
        head = head[:-1].rstrip()
        start = head.rfind(b'"', 0, len(head) - 1)
        while start > 0 and (len(head[:start]) - len(head[:start].rstrip(b"\\"))) % 2:
            start = head.rfind(b'"', 0, start)
        try:
            return json.loads(head[start:]) == collection
        except ValueError:
            return False

    return buffers, summary, structure, key_before


def _sums():
    """Reduce (place, size of the file, bytes) of ranges to a row each."""
    _, summary, _, _ = _byte_columns()
    schema = pa.schema([("_file", pa.string()), ("_block", pa.int64()), ("_size", pa.int64()), ("size", pa.int64()), ("turns", pa.bool_()),
                        ("depth0", pa.int64()), ("depth1", pa.int64()), ("lead", pa.string())])

    def reduce(pieces):
        current, rows = None, []

        def row():
            return dict(zip(schema.names, (*current, of_file, size, quoted % 2 == 1, inner, outer, lead)))

        for place, file_size, data in pieces:
            if place != current:
                if current is not None:
                    rows.append(row())
                    if len(rows) >= 1000:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows = []
                current, of_file, size, quoted, inner, outer, lead = place, file_size, 0, 0, 0, 0, None
            quotes, even, odd = summary(data)
            if quoted % 2:
                even, odd = odd, even
            size, quoted, inner, outer = size + len(data), quoted + quotes, inner + even, outer + odd
            if lead is None:
                lead = data.lstrip(b"\xef\xbb\xbf \t\r\n")[:1].decode("latin-1") or None
        if current is not None:
            yield pa.RecordBatch.from_pylist([*rows, row()], schema=schema)

    return reduce


def _sum_up():
    buffers, *_ = _byte_columns()
    reduce = _sums()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return reduce((place, first.column("_size")[0].as_py(), data) for place, first, data in buffers(batches))

    return run


def settle(sums: DataFrame) -> DataFrame:
    """State at the start of each range: inside (a string), depth, and the document's level of elements (none if it is not closed)."""
    in_file = Window.partitionBy("_file").orderBy("_block")
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    states = sums.withColumn("inside", F.coalesce(F.sum(F.col("turns").cast("int")).over(earlier), F.lit(0)) % 2 == 1)
    states = states.withColumn("change", F.when(F.col("inside"), F.col("depth1")).otherwise(F.col("depth0")))
    states = states.withColumn("depth", F.coalesce(F.sum("change").over(earlier), F.lit(0)))
    # A brace stands for the end of the last chunk, whether or not the file has one there: its size tells.
    whole = in_file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    states = states.withColumns({"lead": F.first("lead", ignorenulls=True).over(whole), "end": F.sum("change").over(whole), "read": F.sum("size").over(whole),
                                 "quotes_closed": F.sum(F.col("turns").cast("int")).over(whole) % 2 == 0})
    extra = (F.col("read") - F.col("_size") + 3) % 3  # the reader may leave out a byte order mark of three bytes
    closed = F.col("quotes_closed") & (F.col("end") + extra == 0)
    level = F.when(closed & (F.col("lead") == "["), 1).when(closed & (F.col("lead") == "{"), 2)
    return states.select("_file", "_block", "_size", "inside", "depth", level.alias("level"))


def _cut(collection: str):
    buffers, _, structure, key_before = _byte_columns()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        names = ["_file", "_block", "kind", "container", "borders", "number", "text", "collection"]
        schema = pa.schema(list(zip(names, [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()])))

        current = None
        rows: list[tuple] = []

        def emit(kind, text=None, is_collection=None):
            rows.append((*current, kind, container, borders, number, text, is_collection))

        def batch():
            columns = list(zip(*rows)) or [()] * len(names)
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        def leave():
            if wanted is not False and start is not None:
                emit("part", carry.decode(errors="replace"))

        for place, first, data in buffers(batches):
            if place != current:
                if current is not None:
                    leave()
                state = first.to_pylist()[0]
                if state["depth"] is None:
                    raise RuntimeError(f"the input ranges of {place[0]} changed between two passes")
                current, level, depth, quoted = place, state["level"], state["depth"], int(state["inside"])
                container = borders = number = 0
                # None: the range starts inside a container that an earlier one opened
                wanted, start, carry, headless = (None, 0, b"", True) if level is not None and depth >= level else (False, None, b"", False)
            if level is None:
                continue
            places, _, which, change, after, quoted, depth = structure(data, quoted, depth)
            for at in places[((which == 44) | (change > 0)) & (after == level) | (change < 0) & (after == level - 1)].tolist():
                byte = data[at]
                if byte in b"[{":
                    container += 1
                    wanted = byte == 91 and (level == 1 or key_before(data, at, collection))
                    emit("container", None, wanted)
                    start, carry, headless = at + 1, b"", False
                    continue
                if wanted is not False:
                    text = carry + data[start:at]
                    if headless:
                        emit("part", text.decode(errors="replace"))
                        number += 1
                    elif text := text.strip():
                        emit("element", text.decode(errors="replace"))
                        number += 1
                carry, headless = b"", False
                borders += 1
                start = at + 1 if byte == 44 else None
                if byte != 44:
                    wanted = False
            if wanted is not False and start is not None:
                carry, start = carry + data[start:], 0
            if rows:
                yield batch()
        if current is not None:
            leave()
            if rows:
                yield batch()

    return run


def _reader():
    """For tasks: the bytes of a range, and a way through the elements of its arrays."""
    import numpy as np

    _, _, structure, key_before = _byte_columns()
    opened = file_opener()

    def ranges(batches):
        """Each row of the batches as a dict, with a function that reads its file."""
        path = source = None
        for batch in batches:
            for row in batch.to_pylist():
                if row["path"] != path:
                    if source is not None:
                        source.close()
                    path = row["path"]
                    file_system, name = opened(path)
                    source = file_system.open_input_file(name)

                def read(at, n, source=source, path=path):
                    data = source.read_at(n, at)
                    if len(data) != n:
                        raise RuntimeError(f"{path} changed while it was read")
                    return data

                yield row, read

    def pieces(read, start, end, size, most=4 << 20, step=16 << 10):
        """(bytes, True) of the chunks that start in a range, in runs that end behind a brace; after them, as long as they are
        asked for, (bytes, False) of those that follow.  A chunk starts behind a brace, and at the start of the file."""
        held, at = b"", max(start - 1, 0)
        while start and not held:
            n = min(step, min(end, size) - 1 - at)
            if n <= 0:
                return  # none starts here
            data = read(at, n)
            brace = data.find(b"}")
            if brace >= 0:
                at += brace + 1
                break
            at += n
        within, more = True, step
        while held or at < size:
            if at < end:
                n = min(most, end - at, size - at)
            elif not within and b"}" in held:
                n = 0
            else:
                n = min(more, size - at)
                more = min(2 * more, most)
            held, at = held + read(at, n), at + n
            if within and at >= end:  # the first brace from the range's last byte on
                cut = held.find(b"}", max(0, end - 1 - at + len(held))) + 1
            else:
                cut = held.rfind(b"}") + 1
            if at == size and not cut:
                cut = len(held)
            if cut:
                yield held[:cut], within
                held, within = held[cut:], within and at < end

    def runs(pieces, level, depth, quoted, wanted, collection):
        """("container", whether it is the collection) where one opens, and ("elements", whether a container opened in these pieces has
        them, bytes, starts, ends, which of them cannot be blank) for the elements that start in the pieces of the range.  ``wanted``: whether
        the container that is open at the start is the collection."""
        own, headless = False, depth >= level
        wanted, start, carry = (wanted, 0, []) if headless else (False, None, [])
        for data, within in pieces:
            if not within and (not wanted or start is None or headless):
                return
            at, number, byte, change, after, quoted, depth = structure(data, quoted, depth)
            border = np.flatnonzero(((byte == 44) | (change > 0)) & (after == level) | (change < 0) & (after == level - 1))
            if not within:
                border = border[:1]
            at, number, byte, change = at[border], number[border], byte[border], change[border]
            low, before = 0, -1  # ``before``: the number of the border before the next element
            for k in [*np.flatnonzero(byte != 44).tolist(), len(at)]:
                closes = k < len(at) and change[k] < 0
                stop, among = at[low: k + closes], number[low: k + closes]
                if wanted and start is not None and len(stop):
                    one = headless or carry  # the first ends what began elsewhere
                    if carry:
                        text = b"".join([*carry, data[: stop[0]]])
                        yield "elements", own, text, np.zeros(1, np.int64), np.array([len(text)]), np.zeros(1, bool)
                    if one:
                        headless, carry, start, before, stop, among = False, [], int(stop[0]) + 1, among[0], stop[1:], among[1:]
                    if len(stop):
                        yield "elements", own, data, np.append(start, stop[:-1] + 1), stop, np.diff(among, prepend=before) > 1
                        start, before = int(stop[-1]) + 1, among[-1]
                if closes:
                    wanted, start = False, None
                elif k < len(at):
                    own, headless, carry, start, before = True, False, [], int(at[k]) + 1, number[k]
                    wanted = bool(byte[k] == 91 and (level == 1 or key_before(data, start - 1, collection)))
                    yield "container", wanted
                low = k + 1
            if not within and len(at):
                return
            if wanted and start is not None:
                if not headless:
                    carry.append(data[start:])
                start = 0

    return ranges, pieces, runs


_BLANK = b" \t\n\r\v\f"


def _sum_bytes():
    ranges, pieces, _ = _reader()
    reduce = _sums()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def own():
            for row, read in ranges(batches):
                for data, within in pieces(read, row["_block"], row["_end"], row["_size"]):
                    if not within:
                        break
                    yield (row["_file"], row["_block"]), row["_size"], data

        return reduce(own())

    return run


def _count_elements(collection: str):
    ranges, pieces, runs = _reader()
    blank = _BLANK
    schema = pa.schema([("_file", pa.string()), ("_block", pa.int64()), ("inherited", pa.int64()), ("own", pa.int64()), ("last", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for row, read in ranges(batches):
            number, last = [0, 0], None
            # Taken for the collection until it closes: what an earlier range opened.
            for kind, what, *elements in runs(pieces(read, row["_block"], row["_end"], row["_size"]), row["level"], row["depth"], int(row["inside"]), True, collection):
                if kind == "container":
                    last = what
                    continue
                data, starts, ends, sure = elements
                number[what] += int(sure.sum()) + sum(bool(data[starts[k]: ends[k]].strip(blank)) for k in (~sure).nonzero()[0].tolist())
            rows.append(dict(zip(schema.names, (row["_file"], row["_block"], *number, last))))
            if len(rows) >= 1000:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                rows = []
        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def _cut_elements(collection: str, most: int = 4 << 20):
    ranges, pieces, runs = _reader()
    blank = _BLANK.decode()
    schema = pa.schema([("_file", pa.string()), (ROW_NUMBER, pa.int64()), ("record", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow.compute as pc

        def texts(data, starts, ends):
            """The elements, which lie one border apart, without blanks around them."""
            bounds = np.empty(2 * len(starts), np.int32)
            bounds[::2], bounds[1::2] = starts, ends
            found = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)]).take(pa.array(np.arange(0, len(bounds), 2)))
            try:
                found = found.cast(pa.string())
            except pa.ArrowInvalid:
                found = pa.array([t.decode(errors="replace") for t in found.to_pylist()], pa.string())
            found = pc.ascii_trim(found, characters=blank)
            return found.filter(pc.greater(pc.binary_length(found), 0))

        held, size = [], 0
        for row, read in ranges(batches):
            number = 0
            for kind, _, *elements in runs(pieces(read, row["_block"], row["_end"], row["_size"]), row["level"], row["depth"], int(row["inside"]), row["open"], collection):
                if kind == "container":
                    continue
                found = texts(*elements[:3])
                first = row["before"] + number + 1
                number += len(found)
                held.append((row["_file"], first, found))
                size += found.nbytes
                if size > most:
                    yield batch(held)
                    held, size = [], 0
            if number != row["n"]:
                raise RuntimeError(f"{row['path']} changed between two passes")
        if held:
            yield batch(held)

    def batch(held):
        import numpy as np

        files = [pa.repeat(pa.scalar(file, pa.string()), len(found)) for file, _, found in held]
        numbers = [np.arange(first, first + len(found)) for _, first, found in held]
        return pa.RecordBatch.from_arrays([pa.concat_arrays(files), pa.array(np.concatenate(numbers), pa.int64()), pa.concat_arrays([f for *_, f in held])], schema=schema)

    return run


def _list_files(spark: SparkSession, path: str) -> DataFrame:
    """(_file, path, _size) of the files that Spark's readers find; no contents."""
    name, most = "spark.sql.sources.parallelPartitionDiscovery.parallelism", 4 * spark.sparkContext.defaultParallelism
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), most)))  # a task lists many folders
    try:
        listed = spark.read.format("binaryFile").load(path)
    finally:
        spark.conf.set(name, before)
    return materialize(listed.where("length > 0").select(F.col("_metadata.file_path").alias("_file"), "path", F.col("length").alias("_size")))  # a row per file


def _open_to_tasks(spark: SparkSession, files: DataFrame) -> tuple[bool, int]:
    """Whether tasks can read ranges of the files themselves, as none is compressed and ``pyarrow.fs`` opens them; bytes of all."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop
    suffixes = [hadoop.util.ReflectionUtils.newInstance(codec, conf).getDefaultExtension() for codec in hadoop.io.compress.CompressionCodecFactory.getCodecClasses(conf)]
    compressed = F.lit(False)
    for suffix in suffixes:
        compressed |= F.col("path").endswith(suffix)
    first, total, some = files.agg(F.min("path"), F.sum("_size"), F.max(compressed)).first()
    if some:
        return False, total
    if first is not None:
        try:
            file_system, name = file_opener()(first)
            file_system.open_input_file(name).close()
        except Exception:  # whatever is missing here: a library, a setting, the scheme
            return False, total
    return True, total or 0


def read_records(spark: SparkSession, path: str, collection: str, *, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(_file, _row_number, record): the elements of every document's collection as JSON text, in file and document order."""
    if "}" in collection:
        raise ValueError("a collection key with a closing brace cannot be found by ranges")
    files = _list_files(spark, path)
    own, total = _open_to_tasks(spark, files)
    tasks = int(max(4 * spark.sparkContext.defaultParallelism, total // RANGE_BYTES))
    if own:
        return _records_of_bytes(files, collection, range_bytes, tasks)
    return _records_of_chunks(spark, path, collection, range_bytes, tasks)


def _records_of_bytes(files: DataFrame, collection: str, range_bytes: int, tasks: int) -> DataFrame:
    in_file = Window.partitionBy("_file").orderBy("_block")
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)

    def dealt(ranges: DataFrame) -> DataFrame:
        """Ranges that follow one another in a task."""
        return ranges.repartitionByRange(tasks, "_file", "_block").sortWithinPartitions("_file", "_block")

    ranges = files.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_size") - 1, F.lit(range_bytes).cast("long"))).alias("_block"))
    ranges = ranges.withColumn("_end", F.col("_block") + range_bytes)
    states = settle(dealt(ranges).mapInArrow(_sum_bytes(), _SUMS)).where("level IS NOT NULL")
    states = materialize(states.join(files.select("_file", "path"), "_file").withColumn("_end", F.col("_block") + range_bytes))
    counts = dealt(states).mapInArrow(_count_elements(collection), _COUNTS)
    counts = counts.withColumn("open", F.coalesce(F.last("last", ignorenulls=True).over(earlier), F.lit(False)))
    counts = counts.withColumn("n", F.col("own") + F.when(F.col("open"), F.col("inherited")).otherwise(0))
    overall = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    counts = counts.select("_file", "_block", "open", "n", F.coalesce(F.sum("n").over(overall), F.lit(0)).alias("before"))
    places = materialize(states.join(counts, ["_file", "_block"]).where("n > 0"))
    return dealt(places).mapInArrow(_cut_elements(collection), _RECORDS)


def _records_of_chunks(spark: SparkSession, path: str, collection: str, range_bytes: int, tasks: int) -> DataFrame:
    with split_size(spark, range_bytes):
        ranges = _ranges(spark, path).coalesce(tasks)  # no shuffle: ranges one after another
        states = materialize(settle(ranges.mapInArrow(_sum_up(), _SUMS)).drop("_size"))
        if states.count() <= BROADCAST_RANGES:
            known = ranges.join(F.broadcast(states), ["_file", "_block"], "left")  # keeps the order of each range
        else:
            ordered = ranges.withColumn("_mid", F.monotonically_increasing_id()).join(states, ["_file", "_block"], "left")
            known = ordered.repartition("_file", "_block").sortWithinPartitions("_file", "_block", "_mid").drop("_mid")
        target = shared_path(spark, "staging", "json-elements")
        known.mapInArrow(_cut(collection), _FOUND).write.parquet(target)
    found = spark.read.schema(_FOUND).parquet(target)

    # Containers and borders before each range, in its file; a few rows per document and one per range.
    in_file = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    counts = found.groupBy("_file", "_block").agg(F.max("borders").alias("borders"), F.max("container").alias("containers"))
    before = counts.select("_file", "_block", *(F.coalesce(F.sum(c).over(in_file), F.lit(0)).alias(f"{c}_before") for c in ("borders", "containers")))
    found = found.join(before, ["_file", "_block"]).withColumn("container", F.col("container") + F.col("containers_before"))
    wanted = found.where("kind = 'container' AND collection").select("_file", "container")
    inside = found.where("kind <> 'container'").join(wanted, ["_file", "container"], "left_semi")
    parts = inside.where("kind = 'part'").groupBy("_file", (F.col("borders") + F.col("borders_before")).alias("at")).agg(
        F.sort_array(F.collect_list(F.struct("_block", "text"))).alias("parts"))  # of one record
    # In its last range the joined record is the first one to end.
    joined = parts.select("_file", F.element_at("parts", -1)["_block"].alias("_block"), F.lit(0).cast("long").alias("number"),
                          F.btrim(F.array_join("parts.text", ""), F.lit(" \t\r\n")).alias("record"))
    records = inside.where("kind = 'element'").select("_file", "_block", "number", F.col("text").alias("record")).unionByName(joined)
    per_range = records.groupBy("_file", "_block").agg(F.count("*").alias("n"), F.min("number").alias("first"))
    overall = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = per_range.select("_file", "_block", "first", F.coalesce(F.sum("n").over(overall), F.lit(0)).alias("offset"))
    return records.join(offsets, ["_file", "_block"]).select(
        "_file", (F.col("offset") + F.col("number") - F.col("first") + 1).alias(ROW_NUMBER), "record")
