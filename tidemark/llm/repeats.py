"""Removal of bytes that repeated strings cover, over all texts at once (operator 3).

Strings of LENGTH bytes that are equal choose equal anchors inside them, so every repeat shows as
an anchor hash that occurs twice, and each of its strings lies in the context of such an anchor.
Contexts of one anchor are aligned on it. In each group they are sorted by what follows the anchor,
and then extended backwards: the bytes before all suffixes of an order are its column of the
Burrows-Wheeler transform; a stable sort by them gives the order one byte further left. All
intervals of all groups take each step together, so common prefixes come by increasing length;
intervals of one context are left, and the extension ends at the least length.

Contexts that are equal as a whole are one entry with a count. A group of very many different
contexts is split by what stands beside the anchor: strings that reach at most so far to the left
have the next bytes to the right in common, all others those to the left. Halves that are still
too large are split again, and each part is extended in the same way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import anchors, shared

LENGTH = 200
#: Different contexts that one group may hold; larger ones are split.
GROUP = 1500
#: Contexts that are extended together.
TOGETHER = 40_000


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text without nulls, and key: rows with equal id and text share it."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text")


def anchored(rows: DataFrame, length: int) -> DataFrame:
    """key, pos, h (anchor), c (context) for every anchor of every text; with stop, a range from pos on that repeats inside itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, keys, held = [], [], 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                at, h, c, ranges = anchors.find(text.as_py().encode(), length)
                own = len(at) + len(ranges)
                if not own:
                    continue
                zeros, no_stop = np.zeros(len(ranges), np.int64), np.full(len(at), -1)
                found.append((np.append(at, ranges[:, 0]), np.append(h, zeros), np.append(c, zeros), np.append(no_stop, ranges[:, 1])))
                keys.append(np.full(own, key, np.int64))
                held += own
                if held > 50_000:
                    yield out(keys, found)
                    found, keys, held = [], [], 0
            if held:
                yield out(keys, found)

    def out(keys: list, found: list) -> pa.RecordBatch:
        pos, h, c, stop = (np.concatenate([f[i] for f in found]) for i in range(4))
        return pa.RecordBatch.from_pydict({"key": pa.array(np.concatenate(keys), pa.int64()), "pos": pa.array(pos.astype(np.int32), pa.int32()), "h": pa.array(h, pa.int64()), "c": pa.array(c, pa.int64()), "stop": pa.array(stop.astype(np.int32), pa.int32(), mask=stop < 0)})

    return rows.select("key", "text").mapInArrow(run, "key long, pos int, h long, c long, stop int")


CONTEXT = "grp long, key long, pos int, n long, before int, bytes binary"


def contexts(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """grp (the anchor), key, pos, n (contexts of the group), before (bytes of context before the anchor) and bytes, for the wanted anchors."""
    side = length - anchors.GRAM
    lists = shared.written(wanted.groupBy("key").agg(F.collect_list(F.struct("pos", "h", "n")).alias("own")), "own")  # a text's own anchors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[], [], [], [], [], []]
            for key, text, own in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                b = text.as_py().encode()
                for x in own.as_py():
                    start = max(0, x["pos"] - side)
                    for col, v in zip(cols, (x["h"], key, x["pos"], x["n"], x["pos"] - start, b[start : x["pos"] + length]), strict=True):
                        col.append(v)
            yield _contexts(cols)

    return shared.passing(rows, "key", lists).join(lists, "key").select("key", "text", "own").mapInArrow(run, CONTEXT)


def _contexts(cols: list[list]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["grp", "key", "pos", "n", "before", "bytes"])


def _least_between(lcp: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """min(lcp[p + 1 .. q]) for each pair p < q, by doubling."""
    out, gap = np.empty(len(p), lcp.dtype), q - p
    table, width = lcp, 1
    while len(p):
        now = (gap >= width) & (gap < 2 * width)
        out[now] = np.minimum(table[q[now]], table[p[now] + width])
        if not (gap >= 2 * width).any():
            break
        wider = table.copy()
        wider[width:] = np.minimum(table[width:], table[:-width])
        table, width = wider, width * 2
    return out


def extend(group: np.ndarray, before: np.ndarray, texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each context, how far the strings that another context of its group has too reach to the
    left of the anchor (-1: there are none), and to the right of it.

    group: ascending; before: bytes of each context before the anchor.
    """
    n, gram, side = len(group), anchors.GRAM, length - anchors.GRAM
    flat = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    after = sizes - before - gram
    # Byte d to the right or left of each anchor, plus one (UTF-8 has no 255); 0 beyond the text.
    padded = np.concatenate([flat + np.uint8(1), np.zeros(1, np.uint8)])
    right = np.stack([padded[np.where(d < after, starts + before + gram + d, len(flat))] for d in range(side)])
    order = np.arange(n)
    for d in range(side - 1, -1, -1):
        order = order[np.argsort(right[d][order], kind="stable")]
    order = order[np.argsort(group[order], kind="stable")]
    same = right[:, order[1:]] == right[:, order[:-1]]
    common = np.where(same.all(axis=0), side, same.argmin(axis=0))
    common = np.minimum(common, np.minimum(after[order[1:]], after[order[:-1]]))
    lcp = np.concatenate([[-1], np.where(group[order[1:]] == group[order[:-1]], common, -1)]).astype(np.int16)
    to_left, to_right = np.full(n, -1, np.int64), np.zeros(n, np.int64)
    for step in range(side + 1):
        # Neighbours whose common prefix has reached the least length hold a repeated string here.
        hit = np.flatnonzero(lcp >= side - step)
        both = order[np.concatenate([hit, hit - 1])]
        to_left[both] = step
        to_right[both] = np.maximum(to_right[both], side - step)
        if step == side:
            break
        # Entries at their text's start cannot be extended. The rest is sorted by interval and byte before.
        heads = lcp < 0
        kept = np.flatnonzero(before[order] > step)
        where = order[kept]
        interval = np.cumsum(heads)[kept]
        byte = padded[starts[where] + before[where] - 1 - step]
        moved = np.argsort(interval * 256 + byte, kind="stable")
        place, interval, byte = kept[moved], interval[moved], byte[moved]
        joined = (interval[1:] == interval[:-1]) & (byte[1:] == byte[:-1])
        after_lcp = np.full(len(place), -1, np.int16)
        at = np.flatnonzero(joined)
        after_lcp[at + 1] = _least_between(lcp, place[at], place[at + 1])
        order = order[place]
        # Intervals of one entry end here.
        more = after_lcp >= 0
        live = more | np.append(more[1:], False)
        order, lcp = order[live], after_lcp[live]
        if not len(order):
            break
    return to_left, to_right


SPANS = "key long, start int, stop int"


def expanded(gathered: DataFrame, length: int) -> DataFrame:
    """Spans of repeated strings in the contexts of groups of moderate size."""
    n = int(gathered.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    together = gathered.repartition(n, "grp").sortWithinPartitions("grp").select("grp", "key", "pos", "before", "bytes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held = [], 0
        for batch in batches:
            held.append(batch)
            n_held += batch.num_rows
            if n_held >= TOGETHER:
                table = pa.Table.from_batches(held).combine_chunks()
                h = table.column(0).to_numpy()
                cut = int(np.searchsorted(h, h[-1]))  # the last group may go on
                if cut:
                    yield spans(table.slice(0, cut))
                held, n_held = table.slice(cut).to_batches(), table.num_rows - cut
        if n_held:
            yield spans(pa.Table.from_batches(held).combine_chunks())

    def spans(table: pa.Table) -> pa.RecordBatch:
        pos = table.column(2).to_numpy().astype(np.int64)
        left, right = extend(table.column(0).to_numpy(), table.column(3).to_numpy().astype(np.int64), table.column(4).to_pylist(), length)
        hit = left >= 0
        return pa.RecordBatch.from_pydict({"key": pa.array(table.column(1).to_numpy()[hit], pa.int64()), "start": pa.array((pos - left)[hit], pa.int32()), "stop": pa.array((pos + anchors.GRAM + right)[hit], pa.int32())})

    return together.mapInArrow(run, SPANS)


PART = f"{CONTEXT}, low int, high int, asks boolean"


def halves(large: DataFrame, length: int) -> DataFrame:
    """The contexts of large groups in smaller ones. Of the strings sought, `low` to `high` bytes stand before the anchor.

    Those with at most the middle number share the bytes that follow the anchor up to the least that
    they hold of them; all others share the bytes before it. A context is in a half if it has so
    many bytes on that side.
    """
    side = length - anchors.GRAM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(9)]
            for grp, key, pos, n, before, text, low, high, asks in zip(*(batch.column(i).to_pylist() for i in range(9)), strict=True):
                after, middle = before + anchors.GRAM, (low + high) // 2
                right, left = text[after : after + side - middle], text[max(0, before - middle - 1) : before]
                for part, least, a, b in ((right, side - middle, low, middle), (left, middle + 1, middle + 1, high)):
                    if len(part) == least and a <= b:
                        own = hashlib.blake2b(part, digest_size=8, key=(grp & (1 << 64) - 1).to_bytes(8, "little") + bytes([a, b]))
                        for col, v in zip(cols, (int.from_bytes(own.digest(), "little", signed=True), key, pos, n, before, text, a, b, asks), strict=True):
                            col.append(v)
            whole = _contexts(cols[:6])
            more = [pa.array(c, k) for c, k in zip(cols[6:], (pa.int32(), pa.int32(), pa.bool_()), strict=True)]
            yield pa.RecordBatch.from_arrays([*whole.columns, *more], names=[*whole.schema.names, "low", "high", "asks"])

    return large.select("grp", "key", "pos", "n", "before", "bytes", "low", "high", "asks").mapInArrow(run, PART)


def split(large: DataFrame, length: int) -> list[DataFrame]:
    """Spans of repeated strings in groups of any size: they are halved until all parts are small.

    A context whose bytes from the first to the last string sought in a part are another's there too
    is covered as far as they reach and asks no more; one of those with the same bytes stays for the
    others that do. A part whose strings have one place for the anchor is answered by that alone. So
    there are as many rounds as the logarithm of the places, for all groups together.
    """
    out, now = [], large.withColumns({"low": F.lit(0), "high": F.lit(length - anchors.GRAM), "asks": F.lit(True)})
    while not now.isEmpty():
        both = shared.written(halves(now, length).drop("n"), "halves")
        sizes = shared.written(both.groupBy("grp").agg(F.count("*").alias("n"), F.bool_or("asks").alias("any")).where("n > 1 AND any").drop("any"), "sizes")
        both = shared.written(both.join(sizes, "grp"), "parts")
        out.append(expanded(both.where(F.col("n") <= GROUP), length))
        start, reach = F.col("before") - F.col("high"), F.col("high") - F.col("low") + length
        whole = (start >= 0) & (F.length("bytes") >= start + reach)
        rest = both.where(F.col("n") > GROUP).withColumn("w", F.when(whole, F.xxhash64("grp", F.substring("bytes", start + 1, reach))))
        again = shared.written(rest.where("w IS NOT NULL").groupBy("w").agg(F.count("*").alias("held"), F.min(F.struct("key", "pos")).alias("one")).where("held > 1").drop("held"), "again")
        rest = shared.written(rest.join(again, "w", "left").drop("w"), "rest")
        found = rest.where("one IS NOT NULL AND asks")
        out.append(found.select("key", (F.col("pos") - F.col("high")).alias("start"), (F.col("pos") - F.col("low") + length).alias("stop")))
        stays = F.col("one").isNull() | ((F.col("one.key") == F.col("key")) & (F.col("one.pos") == F.col("pos")))
        now = rest.where((F.col("low") < F.col("high")) & stays).withColumn("asks", F.col("asks") & F.col("one").isNull()).drop("one")
    return out


def spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """key, start, stop: byte ranges whose union is what repeated strings of `length` bytes cover."""
    with shared.scratch():
        rows, side = keyed(docs), length - anchors.GRAM
        every = shared.written(anchored(rows, length), "anchors")
        found = every.where("stop IS NULL").drop("stop")
        # Written, so that the join has a shuffle on either side and Spark can split the parts of common anchors.
        again = shared.written(found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "again")
        occurring = shared.written(shared.passing(found, "h", again).join(again, "h"), "occurring")
        classes = shared.written(occurring.groupBy("h", "c").agg(F.count("*").alias("many"), F.min(F.struct("key", "pos")).alias("one")), "contexts")
        groups = shared.written(classes.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"), "groups")
        wanted = classes.join(groups, "h").select("one.key", "one.pos", "h", "n")
        gathered = shared.written(contexts(rows, wanted, length), "gathered")
        out = expanded(gathered.where(F.col("n") <= GROUP), length)
        for part in split(gathered.where(F.col("n") > GROUP), length):
            out = out.unionByName(part)
        # A context that occurs again as a whole is covered as a whole.
        twice = shared.written(classes.where("many > 1").select("h", "c"), "twice")
        whole = occurring.join(twice, ["h", "c"])
        out = out.unionByName(whole.select("key", F.greatest(F.col("pos") - side, F.lit(0)).alias("start"), (F.col("pos") + length).alias("stop")))
        out = out.unionByName(every.where("stop IS NOT NULL").select("key", F.col("pos").alias("start"), "stop"))
        return shared.written(out, "spans", lasting=True)


def cut(text: bytes, ranges: np.ndarray) -> tuple[bytes, int, int]:
    """The bytes that are left, how many went, and in how many maximal runs. ranges: rows of start, stop."""
    if not len(ranges):
        return text, 0, 0
    ranges = ranges[np.lexsort((ranges[:, 1], ranges[:, 0]))]
    stop = np.minimum(np.maximum.accumulate(ranges[:, 1]), len(text))
    first = np.append(True, ranges[1:, 0] > stop[:-1])
    starts, stops = ranges[first, 0], stop[np.append(first[1:], True)]
    kept, at = [], 0
    for a, b in zip(starts.tolist(), stops.tolist(), strict=True):
        kept.append(text[at:a])
        at = b
    kept.append(text[at:])
    return b"".join(kept), int((stops - starts).sum()), len(starts)


def runs(found: DataFrame) -> DataFrame:
    """key, start, stop of each maximal run: ranges that touch or overlap are one, so a key has fewer than its text has bytes.

    Rows that repeat an id and a text share a key and its ranges. These are first made one, before any shuffle.
    """
    each = found.groupBy("key", "start").agg(F.max("stop").alias("stop"))
    by = Window.partitionBy("key").orderBy("start")
    reach = F.max("stop").over(by.rowsBetween(Window.unboundedPreceding, -1))
    first = F.when(reach.isNull() | (F.col("start") > reach), 1).otherwise(0)
    numbered = each.withColumn("__first", first).withColumn("__run", F.sum("__first").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return numbered.groupBy("key", "__run").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("__run")


def remove(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row for each row of docs: doc_id, kept (bytes), n_bytes, n_removed, n_spans.

    Each byte covered by a string of `length` bytes that also starts anywhere else (in the same
    document too, overlaps count) is removed. Null texts count as empty; shorter texts stay whole.
    Repeated rows are elsewhere for each other. Strings are compared by 64-bit hashes of anchors
    and contexts, and byte by byte between different contexts.
    """
    found = spans(docs, length)
    lists = shared.written(runs(found).groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("ranges")), "ranges")
    shared.drop_written(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, ranges in zip(batch.column(1), batch.column(2), strict=True):
                b = text.as_py().encode()
                own = np.stack([ranges.values.field(i).to_numpy() for i in range(2)], axis=1) if ranges.is_valid else np.zeros((0, 2), np.int32)
                out.append((*cut(b, own), len(b)))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "kept": pa.array([x[0] for x in out], pa.binary()), "n_bytes": pa.array([x[3] for x in out], pa.int64()), "n_removed": pa.array([x[1] for x in out], pa.int64()), "n_spans": pa.array([x[2] for x in out], pa.int64())})

    rows = keyed(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    marked = shared.flagged(rows, F.col("key"), shared.bitmap(lists, "key"), "__may")
    # Texts that lose nothing stay where they are.
    whole = marked.where("NOT __may").select("doc_id", F.encode("text", "UTF-8").alias("kept"), F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"))
    some = marked.where("__may").join(lists, "key", "left").select("doc_id", "text", "ranges").mapInArrow(run, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")
    return whole.unionByName(some)


def op3_repeated_bytes(spark, sf_dir: str) -> DataFrame:
    """What is left of every whole text without strings of 200 bytes that start elsewhere too.

    Null texts count as empty and, like texts below 200 bytes, stay whole. Repeated rows and ties are
    elsewhere for each other, and each row is returned, also with a null doc_id. An empty table gives
    no rows. Very long texts are taken in segments; other columns are ignored.
    """
    out = remove(shared.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
