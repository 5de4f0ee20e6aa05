"""Exact Jaccard self-join of word-shingle sets by a token-group matrix (operator 8).

Equal sets are one class. Classes are put into groups of similar sets; the matrix says which
portions of groups hold a token (the union of the tokens of their sets). A set can only link with
a member of a portion whose union holds enough of its tokens: fewer, and the portion stays closed.
Sets that are linked with their group's leader are at home together and need no comparison; most
others meet no portion that qualifies. The members of those that do are compared exactly.

Light rows (class, counts, places) are joined; whole sets and texts stay where they are, but for
those that a bitmap of fixed size lets pass.

Bounds. Sets of q and s tokens link when their intersection is 0.8 of their union at least. Then
at most q - ceil(0.8 q) tokens of the one are missing in the other. In any one order of all
tokens, the first k common tokens therefore stand among the first q - ceil(0.8 q) + k of either.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from . import batching, graph, shared, shingles

WIDTH = 5
PERCENT = 80
#: Least tokens that a prefix holds beyond those that may be missing, as shares of a set.
FIRST_SHARE, SECOND_SHARE = 0.05, 0.2
#: Values of a set's sketch; pairs of them are the keys under which similar sets meet.
SKETCH = 32
#: Share of sketch values that a set has in common with its leader at least, to be in its group.
ALIKE = 0.4
#: Sets of a group that are opened together, and columns of a table of tokens.
PORTION, COLUMNS = 512, 8_192


def missing(n, percent: int):
    """How many of n tokens a linked set may lack, for numbers and arrays."""
    return n - -(-percent * n // 100)


def _sig(tokens: np.ndarray) -> int:
    """The class of a set: a 64-bit digest of its tokens."""
    both = [int(np.sum(shingles.mix(tokens), dtype=np.uint64)), int(np.bitwise_xor.reduce(tokens)) if len(tokens) else 0]
    mixed = ((both[0] + len(tokens) * 0x9E3779B97F4A7C15) ^ both[1]) & 0xFFFFFFFFFFFFFFFF
    return int(shingles.mix(np.array([mixed], np.uint64)).view(np.int64)[0])


def _sketch(tokens: np.ndarray) -> np.ndarray:
    """For each of SKETCH equal parts of the hash space, the first token from its start on (in a circle): equal in similar sets."""
    if not len(tokens):
        return np.zeros(SKETCH, np.int64)
    at = np.searchsorted(tokens, np.arange(SKETCH, dtype=np.uint64) << np.uint64(64 - SKETCH.bit_length() + 1))
    return tokens[np.where(at == len(tokens), 0, at)].view(np.int64)


def signatures(docs: DataFrame, percent: int) -> DataFrame:
    """doc_id, place (a hash of id and text), cid (class), n, tokens (a prefix: the first tokens by hash, as many as the first bound asks for), mins (a sketch)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cids, sizes, prefixes, sketches = [], [], [], []
            for tokens in shingles.sets((t.as_py() for t in batch.column(2)), WIDTH):
                n = len(tokens)
                cids.append(_sig(tokens))
                sizes.append(n)
                prefixes.append(tokens[: missing(n, percent) + max(1, int(np.ceil(FIRST_SHARE * n)))].tobytes())
                sketches.append(_sketch(tokens))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "place": batch.column(1), "cid": pa.array(cids, pa.int64()), "n": pa.array(sizes, pa.int64()), "tokens": pa.array(prefixes, pa.binary()), "mins": pa.array(sketches, pa.list_(pa.int64()))})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), shared.row_key(docs).alias("place"), "text")
    return rows.mapInArrow(run, "doc_id long, place long, cid long, n long, tokens binary, mins array<long>")


def _exploded(sets: DataFrame, percent: int, share: float | None) -> DataFrame:
    """cid, home, token for the tokens of a prefix; share None: of the whole set. sets: cid, home, tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = [np.frombuffer(t.as_buffer(), np.int64) for t in batch.column(2)]
            if share is not None:
                arrays = [a[: missing(len(a), percent) + max(1, int(np.ceil(share * len(a))))] for a in arrays]
            sizes = [len(a) for a in arrays]
            for at in range(0, len(arrays), 256):
                part, k = arrays[at : at + 256], sizes[at : at + 256]
                if sum(k):
                    ids, homes = (np.repeat(batch.column(c).slice(at, 256).to_numpy(zero_copy_only=False), k) for c in (0, 1))
                    yield pa.RecordBatch.from_pydict({"cid": pa.array(ids, pa.int64()), "home": pa.array(homes, pa.int64()), "token": pa.array(np.concatenate(part), pa.int64())})

    return sets.select("cid", "home", "tokens").mapInArrow(run, "cid long, home long, token long")


def _meeting(tokens: DataFrame, classes: bool = False) -> DataFrame:
    """cid and met: how many of its tokens another home holds too. classes: every set is a home of its own."""
    if classes:
        tokens, spread = tokens.select("cid", "token"), tokens.groupBy("token").agg(F.count("*").alias("held")).where("held > 1")
    else:
        spread = tokens.groupBy("token").agg(F.min("home").alias("low"), F.max("home").alias("high")).where("low <> high")
    # Written, so that the join has a shuffle on either side and Spark can split the parts of common tokens.
    return tokens.join(shared.written(spread.select("token"), "spread"), "token").groupBy("cid").agg(F.count("*").alias("met"))


def _need(n: Column, percent: int, share: float) -> Column:
    """Of a set's prefix, the tokens that a linked set's prefix holds at least: it may have only percent of the size."""
    return F.greatest(F.lit(1), F.ceil(n * (share * percent / 100) - 1e-9))


def _verified(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs a, b whose sets (tokens_a, tokens_b) link, by exact intersection."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "tokens_a", "tokens_b").mapInArrow(run, "a long, b long")


def _grouped(flagged: DataFrame) -> DataFrame:
    """flagged classes (cid, n, met, mins, ...) with leader, grp and portion, without mins.

    Sets meet in buckets of two equal values of their sketches. A bucket's leader is the set of
    which most tokens are met elsewhere: of edited copies, the original. Leaders follow leaders, so
    a group is named by the last of the chain (null leader: none). A portion is a part of a group
    of bounded size.
    """
    light = flagged.select("cid", "mins", F.struct((F.col("met") / F.col("n")).alias("shared"), "cid").alias("rank"))
    keys = F.array(*[F.struct(F.lit(i).alias("i"), F.xxhash64(F.col("mins")[2 * i], F.col("mins")[2 * i + 1]).alias("k")) for i in range(SKETCH // 2)])
    keyed = light.select("cid", "rank", F.explode(keys).alias("key"))
    leaders = keyed.groupBy("key").agg(F.max("rank").alias("lead"), F.count("*").alias("members")).where("members > 1").drop("members")
    pairs = keyed.join(leaders, "key").where("rank < lead").select("cid", "lead").distinct().withColumn("leader", F.col("lead.cid"))
    agree = F.aggregate(F.zip_with("mins", "other", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    near = pairs.join(light.select("cid", "mins"), "cid").join(light.select(F.col("cid").alias("leader"), F.col("mins").alias("other")), "leader")
    chain = shared.written(near.where(agree >= SKETCH * ALIKE).groupBy("cid").agg(F.max_by("leader", "lead").alias("leader")), "leaders")
    top = chain.select("cid", F.col("leader").alias("top"))
    for _ in range(3):  # pointer jumping: chains of eight
        above = top.select(F.col("cid").alias("top"), F.col("top").alias("above"))
        top = top.join(above, "top", "left").select("cid", F.coalesce("above", "top").alias("top"))
    named = flagged.drop("mins").join(chain, "cid", "left").join(top, "cid", "left").withColumn("grp", F.coalesce("top", "cid")).drop("top")
    named = shared.written(named, "named")
    sizes = shared.written(named.groupBy("grp").agg(F.count("*").alias("members")), "sizes")
    portion = F.xxhash64("grp", F.pmod(F.xxhash64("cid"), F.ceil(F.col("members") / PORTION)))
    return named.join(sizes, "grp").withColumn("portion", portion).drop("grp", "members")


def _labelled(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id that each row and column of a table of links reaches; ids: of the rows, then of the columns."""
    n, top = len(linked), np.iinfo(np.int64).max
    rows, cols = ids[:n].copy(), ids[n:].copy()
    while True:
        new_cols = np.minimum(cols, np.where(linked, rows[:, None], top).min(axis=0, initial=top))
        new_rows = np.minimum(rows, np.where(linked, new_cols[None, :], top).min(axis=1, initial=top))
        if (new_cols == cols).all() and (new_rows == rows).all():
            return np.concatenate([rows, cols])
        rows, cols = new_rows, new_cols


def open_block(asks: list[np.ndarray], holds: list[np.ndarray], ask_ids: np.ndarray, hold_ids: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (as id and smallest id reached) between asking sets and the sets of one group portion.

    First the bound: an asking set of which the portion's token union holds too little stays out.
    """
    union = np.unique(np.concatenate(holds))
    ids = np.concatenate([ask_ids, hold_ids])
    inside = [a[union[np.minimum(np.searchsorted(union, a), len(union) - 1)] == a] for a in asks]
    open_to = np.flatnonzero([len(x) * 100 >= percent * len(a) for x, a in zip(inside, asks, strict=True)])
    linked = np.zeros((len(asks), len(holds)), bool)
    if len(open_to):
        used = np.unique(np.concatenate([inside[i] for i in open_to]))
        both = np.zeros((len(open_to), len(holds)), np.float32)
        for at in range(0, len(used), COLUMNS):
            part = used[at : at + COLUMNS]
            x, y = (np.zeros((len(rows), len(part)), np.float32) for rows in (open_to, holds))
            for table, rows in ((x, [inside[i] for i in open_to]), (y, holds)):
                for k, r in enumerate(rows):
                    r = r[np.searchsorted(r, part[0]) : np.searchsorted(r, part[-1], "right")]
                    col = np.searchsorted(part, r)
                    table[k, col[part[col] == r]] = 1
            both += x @ y.T
        n, m = np.array([len(asks[i]) for i in open_to]), np.array([len(h) for h in holds])
        linked[open_to] = both * 100 >= percent * (n[:, None] + m[None, :] - both)
    least = _labelled(linked, ids)
    moved = least != ids
    return ids[moved], least[moved]


def _opened(asks: DataFrame, grouped: DataFrame, percent: int) -> DataFrame:
    """Links found by opening portions. asks: cid, portion (its own), other (the portion it asks)."""
    asks = shared.written(asks.select("cid", "other", F.xxhash64("portion", "other").alias("block")).distinct(), "asks")
    wanted = shared.written(asks.select("block", F.col("other").alias("portion")).distinct(), "wanted")
    askers = shared.written(asks.select("cid").distinct(), "askers")
    held = wanted.join(shared.passing(grouped, "portion", wanted), "portion").select("block", F.lit(False).alias("asks"), "cid", "tokens")
    rows = asks.join(shared.passing(grouped, "cid", askers), "cid").select("block", F.lit(True).alias("asks"), "cid", "tokens").unionByName(held)
    n = int(asks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n, "block").sortWithinPartitions("block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in batching.runs(batches):
            asking = block.column(1).to_numpy(zero_copy_only=False).astype(bool)
            ids = block.column(2).to_numpy()
            tokens = [np.frombuffer(t.as_buffer(), np.uint64) for t in block.column(3)]
            where, there = np.flatnonzero(asking), np.flatnonzero(~asking)
            a, b = open_block([tokens[i] for i in where], [tokens[i] for i in there], ids[where], ids[there], percent)
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return shared.written(rows.mapInArrow(run, "a long, b long"), "opened")


def _meetings(sets: DataFrame, percent: int) -> DataFrame:
    """cid, portion, other: the portions in which a set may link with a member of another home."""
    tokens = shared.written(_exploded(sets, percent, None), "tokens")
    # Rare tokens first: those that few homes hold. Common ones are only reached by sets of nothing else.
    spread = tokens.select("token", "home").distinct().groupBy("token").agg(F.count("*").alias("held")).where("held > 1")
    spread = shared.written(spread, "spread")
    ranked = tokens.join(spread, "token", "left").withColumn("rank", F.row_number().over(Window.partitionBy("cid").orderBy(F.coalesce("held", F.lit(1)), "token")))
    sizes = sets.select("cid", "n", "portion")
    early = ranked.join(sizes, "cid").where(F.col("held").isNotNull() & (F.col("rank") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)).select("cid", "home", "portion", "token")
    early = shared.written(early, "early")
    matrix = early.select("token", F.col("portion").alias("other"), F.col("home").alias("of")).groupBy("token", "other").agg(F.min("of").alias("of"))
    return early.select("token", "cid", "portion", "home").join(matrix, "token").where("home > of").select("cid", "portion", "other").distinct()


def join(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, component_id.

    component_id is the smallest doc_id of the documents that links reach; rows without words or
    text are linked with nothing and are their own component. A null doc_id links with nothing and
    its component_id is null. Repeated rows fall in one class. Links are exact: every pair that
    the bounds leave over is compared, in groups of any size.
    """
    return _joined(docs, percent).drop("place")


def _joined(docs: DataFrame, percent: int) -> DataFrame:
    """join() with place, the key of each row."""
    with shared.scratch():
        sig = shared.written(signatures(docs, percent), "signatures")
        live = sig.where("n > 0 AND doc_id IS NOT NULL")
        first = [F.first(c).alias(c) for c in ("n", "tokens", "mins")]
        classes = shared.written(live.groupBy("cid").agg(F.min("place").alias("place"), *first), "classes")
        # First bound, on short prefixes of every class.
        met = _meeting(_exploded(classes.withColumn("home", F.col("cid")), percent, None), classes=True)
        flagged = met.join(classes.select("cid", "place", "n", "mins"), "cid").where(F.col("met") >= _need(F.col("n"), percent, FIRST_SHARE))
        flagged = shared.written(flagged, "flagged")
        shared.drop_written(classes)
        grouped = shared.written(_whole_sets(docs, shared.written(_grouped(flagged), "groups")), "grouped")
        if grouped.select("cid").distinct().count() != grouped.count():  # a place that is itself repeated
            grouped = shared.written(grouped.dropDuplicates(["cid"]), "grouped")
        # Each set with its leader: what is linked so is at home together.
        leading = shared.written(grouped.select(F.col("leader").alias("cid")).where("cid IS NOT NULL").distinct(), "leading")
        leaders = shared.passing(grouped.select("cid", "tokens"), "cid", leading).join(leading, "cid").select(F.col("cid").alias("b"), F.col("tokens").alias("tokens_b"))
        pairs = grouped.where("leader IS NOT NULL").select(F.col("cid").alias("a"), F.col("leader").alias("b"), F.col("tokens").alias("tokens_a")).join(leaders, "b")
        stars = shared.written(_verified(pairs, percent), "stars")
        homes = graph.components(stars).select(F.col("node").alias("cid"), F.col("component").alias("home"))
        # Pairs of different homes: longer prefixes and then whole sets, of which enough tokens are met in other homes.
        light = [c for c in grouped.columns if c != "tokens"]
        named = shared.written(grouped.select(*light).join(homes, "cid", "left").withColumn("home", F.coalesce("home", "cid")), "named")
        left = grouped.select("cid", "tokens").join(named.select("cid", "home", "n", "portion"), "cid")
        for share in (SECOND_SHARE, None):
            left = shared.written(left, "left")
            need = _need(F.col("n"), percent, share) if share else F.ceil(F.col("n") * percent / 100)
            enough = _meeting(_exploded(left, percent, share)).join(left.select("cid", "n"), "cid").where(F.col("met") >= need).select("cid")
            enough = shared.written(enough, "enough")
            left = shared.passing(left, "cid", enough).join(enough, "cid")
        links = stars.unionByName(_opened(_meetings(shared.written(left, "left"), percent), grouped, percent))
        found = graph.components(links)
        of_class = live.groupBy("cid").agg(F.min("doc_id").alias("rep"))
        named = of_class.join(found, of_class.cid == found.node)
        least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
        by_class = named.join(least, "component").select("cid", "component_id").unionByName(of_class.join(found, of_class.cid == found.node, "left_anti").select("cid", F.col("rep").alias("component_id")))
        out = sig.select("doc_id", "place", "cid", "n").join(by_class, "cid", "left")
        linked = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
        return shared.written(out.select("doc_id", F.col("n").alias("n_shingles"), linked.alias("component_id"), "place"), "components", lasting=True)


def _whole_sets(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """groups (with place, one row of each class) with tokens, the whole sorted set as bytes, from the text at that place."""
    light = [c for c in groups.columns if c not in ("place", "met")]
    texts = shared.passing(docs.select(shared.row_key(docs).alias("place"), "text"), "place", groups).join(groups, "place").select(*light, "text")
    schema = groups.select(*light, F.lit(b"").alias("tokens")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingles.sets((t.as_py() for t in batch.column(len(light))), WIDTH)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([s.tobytes() for s in sets], pa.binary())], names=[*light, "tokens"])

    return texts.mapInArrow(run, schema)


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """docs without the rows that are linked to a smaller doc_id; other columns stay as they are.

    Rows with a null doc_id stay. Of rows that repeat both doc_id and text, one stays; rows that
    repeat a doc_id with another text go by their own links.
    """
    found = _joined(docs.select("doc_id", "text"), percent)
    gone = found.where("component_id <> doc_id").select(F.col("place").alias("__key"))
    kept = shared.without(docs, shared.row_key(docs), gone)
    # Only rows that may be repeated meet each other; all others stay where they are.
    twice = found.where("doc_id IS NOT NULL").groupBy(F.col("place").alias("__key")).count().where("count > 1").select("__key")
    marked = shared.flagged(kept, shared.row_key(kept), shared.bitmap(twice, "__key"), "__twice")
    again = F.col("__twice") & F.col("doc_id").isNotNull()
    return marked.where(~again).unionByName(marked.where(again).dropDuplicates(["doc_id", "text"])).drop("__twice")


def op8_token_groups(spark, sf_dir: str) -> DataFrame:
    """Component of every document under five-word shingles and Jaccard similarity 0.8 or more.

    Null and empty texts have no shingles and are their own component; a null doc_id has a null
    component. Ties and repeated rows fall in one class, and each row is returned. An empty table
    gives no rows. Very long texts are hashed in pieces; other columns are ignored.
    """
    return join(shared.table(spark, sf_dir, "documents").select("doc_id", "text"))
