"""Near-duplicate vectors by NN-descent (operator 5).

Equal vectors are one class. A neighbour graph over the classes starts from buckets of random
hyperplane codes and is refined by joins with the neighbours of neighbours; lists whose entries
all pass the threshold are enlarged. An audit compares the graph's components with the exact
neighbours of a fixed number of drawn vectors; while it finds too few, more buckets are made.
Edges at the threshold give the components, and inside each component all links are counted, so
lists of any length are whole: blocks of vectors that lie close enough to the component's centre
are linked as a whole, those too far apart are not, and only the blocks between are compared.
"""

from __future__ import annotations

import hashlib
import logging
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import batching, graph, shared

THRESHOLD = 0.95
#: Similarity that a neighbour has at least; below it, an entry leads nowhere.
FLOOR = 0.90
LIST, SAMPLE, ROUNDS = 16, 12, 3
#: Share of pairs at the threshold that may miss each other in all codings of a pass.
MISSED = 0.005
#: Vectors audited, the recall at which no further pass is made, and the one below which there is no result.
AUDITED, RECALL, LEAST_RECALL, PASSES = 512, 0.98, 0.9, 16
#: Of a kind of vectors, drawn ones that must have links, or else so many are drawn.
SEEN, MOST_AUDITED = 32, 4096
#: Angles closer than this to a bound are decided by the vectors themselves.
SLACK = 1e-6
_LOG = logging.getLogger(__name__)
#: Rows of a bucket's portion and of a block of a component.
PORTION = 512


def packed(vectors: DataFrame) -> DataFrame:
    """vec_id, node (a digest of the vector) and vec (doubles as bytes); node and vec are null where the row can have no links.

    Those are rows with a null vec_id and null, empty and zero vectors and vectors with null or
    non-finite components.
    """
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    usable = F.col("vec_id").isNotNull() & (F.size(x) > 0) & finite & F.exists(x, lambda v: v != 0)
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(usable, x.cast("array<double>")).alias("embedding"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.asarray(v.values).tobytes() if v.is_valid else None for v in batch.column(1)]
            nodes = [r and int.from_bytes(hashlib.blake2b(r, digest_size=8).digest(), "little", signed=True) for r in rows]
            yield pa.RecordBatch.from_pydict({"vec_id": batch.column(0), "node": pa.array(nodes, pa.int64()), "vec": pa.array(rows, pa.binary())})

    return plain.mapInArrow(pack, "vec_id long, node long, vec binary")


def unit(rows) -> np.ndarray:
    """Vectors of one length as rows of norm 1."""
    x = np.stack([np.frombuffer(r.as_buffer(), np.float64) for r in rows])
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


EDGES = "a long, b long, sim double"


def _edges(a: list, b: list, sim: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"a": pa.array(np.concatenate(a), pa.int64()), "b": pa.array(np.concatenate(b), pa.int64()), "sim": pa.array(np.concatenate(sim), pa.float64())})


def _grouped_by(df: DataFrame, key) -> DataFrame:
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.withColumn("__key", key).repartition(n, "__key").sortWithinPartitions("__key")


def codings(n: int, threshold: float) -> tuple[int, int]:
    """Bits of a code, so that buckets stay small among n vectors, and codings, so that MISSED holds at every n."""
    bits = int(np.clip(np.ceil(np.log2(max(n, 2) / 16)), 2, 40))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(MISSED) / math.log(1 - meet))


def bucket_edges(vectors: DataFrame, n: int, seed: int, threshold: float, floor: float) -> DataFrame:
    """Lists of nearest vectors inside portions of buckets of equal hyperplane codes."""
    bits, tables = codings(n, threshold)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs, nodes = batch.column(1), batch.column(0)
            dims = np.array([len(v.as_buffer()) // 8 for v in vecs])
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                x = unit([vecs[int(i)] for i in at])
                planes = np.random.default_rng([seed, int(d)]).standard_normal((int(d), tables * bits))
                signs = (x @ planes > 0).reshape(len(at), tables, bits)
                codes = (signs * (1 << np.arange(bits, dtype=np.int64))).sum(axis=2) * 1024 + np.arange(tables)
                yield pa.RecordBatch.from_pydict({"node": nodes.take(pa.array(at)), "dim": pa.array(np.full(len(at), d), pa.int64()), "codes": pa.array(codes.tolist(), pa.list_(pa.int64()))})

    coded = vectors.select("node", "vec").mapInArrow(code, "node long, dim long, codes array<long>").select("node", "dim", F.explode("codes").alias("code"))
    coded = shared.written(coded, "codes")
    sizes = coded.groupBy("dim", "code").agg(F.count("*").alias("held")).where("held > 1")
    portion = F.pmod(F.xxhash64("node", "code"), F.ceil(F.col("held") / PORTION))
    placed = coded.join(sizes, ["dim", "code"]).select("node", F.xxhash64("dim", "code", portion).alias("bucket"))
    keyed = _grouped_by(placed.join(vectors.select("node", "vec"), "node"), F.col("bucket")).select("__key", "node", "vec")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, sims, held = [], [], [], 0
        for run in batching.runs(batches):
            if run.num_rows < 2:
                continue
            nodes, vecs = run.column(1).to_numpy(), run.column(2)
            if len({len(v.as_buffer()) for v in vecs}) > 1:
                continue  # two buckets of one hash; other codings bring their members together
            x = unit(vecs)
            s = x @ x.T
            np.fill_diagonal(s, -1)
            if len(nodes) > LIST:
                s[s < np.partition(s, -LIST, axis=1)[:, -LIST][:, None]] = -1
            i, j = np.nonzero(s >= floor)
            a.append(nodes[i])
            b.append(nodes[j])
            sims.append(s[i, j])
            held += len(i)
            if held > 100_000:
                yield _edges(a, b, sims)
                a, b, sims, held = [], [], [], 0
        if held:
            yield _edges(a, b, sims)

    return keyed.mapInArrow(near, EDGES).distinct()


def similar(pairs: DataFrame, vectors: DataFrame, floor: float) -> DataFrame:
    """The pairs a, b with their cosine, where it is at least floor."""
    both = pairs.join(vectors.select(F.col("node").alias("a"), F.col("vec").alias("x")), "a").join(vectors.select(F.col("node").alias("b"), F.col("vec").alias("y")), "b").where(F.length("x") == F.length("y"))

    def cosine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sims = np.zeros(batch.num_rows)
            dims = np.array([len(v.as_buffer()) for v in batch.column(2)])
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                sims[at] = (unit([batch.column(2)[int(i)] for i in at]) * unit([batch.column(3)[int(i)] for i in at])).sum(axis=1)
            keep = sims >= floor
            yield pa.RecordBatch.from_pydict({"a": batch.column(0).filter(pa.array(keep)), "b": batch.column(1).filter(pa.array(keep)), "sim": pa.array(sims[keep])})

    return both.select("a", "b", "x", "y").mapInArrow(cosine, EDGES)


def refine(edges: DataFrame, vectors: DataFrame, threshold: float, floor: float) -> DataFrame:
    """Rounds of neighbours-of-neighbours joins until few entries change. edges: directed lists a, b, sim.

    A node brings SAMPLE of its neighbours, in either direction, together with each other. Lists
    hold LIST entries, twice as many in each round in which all entries pass the threshold.
    """
    edges = shared.written(edges, "neighbours")
    size = F.lit(LIST)
    for r in range(ROUNDS):
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
        drawn = both.withColumn("draw", F.row_number().over(Window.partitionBy("a").orderBy(F.xxhash64("a", "b", F.lit(r)), "b"))).where(F.col("draw") <= SAMPLE)
        met = drawn.select(F.col("a").alias("m"), F.col("b").alias("a")).join(drawn.select(F.col("a").alias("m"), "b"), "m").where("a < b").select("a", "b").distinct()
        new = shared.written(similar(met.join(both, ["a", "b"], "left_anti"), vectors, floor), "neighbours")
        found = new.count()
        if found:
            every = edges.unionByName(new).unionByName(new.select(F.col("b").alias("a"), F.col("a").alias("b"), "sim"))
            rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("sim"), "b"))
            passing = F.sum((F.col("sim") >= threshold).cast("int")).over(Window.partitionBy("a"))
            longer = F.when(passing >= size, size * 2).otherwise(size)
            after = shared.written(every.withColumn("rank", rank).withColumn("most", longer).where("rank <= most").select("a", "b", "sim"), "neighbours")
            size = size * 2
            enough = found * 1000 < edges.count()
            # Links that a list has no more room for still count as links.
            kept = new.where(F.col("sim") >= threshold)
            edges = shared.written(after.unionByName(kept).distinct(), "neighbours")
        shared.drop_written(new)
        if not found or enough:
            break
    return edges


def audit(vectors: DataFrame, found: DataFrame, threshold: float, audited: int = AUDITED, most: int = MOST_AUDITED) -> float | None:
    """An estimate of the mean share of a vector's exact links whose other end is in its component, over all vectors that have links.

    Vectors of components and those outside are drawn apart, and each kind weighs as much as it has
    vectors: a vector outside that has links lost them all, and many lone vectors cannot hide it. A
    kind of which fewer than SEEN drawn vectors have links is drawn again, up to `most` vectors. None
    if no drawn vector has links: nothing is known then but that such vectors are rare.
    """
    both = shared.written(vectors.select("node", "vec").join(found.select("node", F.col("component").alias("own")), "node", "left"), "audited")
    inside, draw, seen = F.col("own").isNotNull(), {True: audited // 2, False: audited // 2}, {}
    sizes = {r[0]: r[1] for r in both.groupBy(inside).count().collect()}
    for _ in range(2):
        for kind, n in draw.items():
            drawn = both.where(inside if kind else ~inside).orderBy(F.xxhash64("node")).limit(n).select("node", "vec").collect()
            seen[kind] = (len(drawn), *_shares(vectors, found, drawn, threshold))
        draw = {k: most for k in draw if seen[k][1] < SEEN and sizes.get(k, 0) > seen[k][0]}
    weigh = {k: sizes.get(k, 0) / max(1, seen[k][0]) for k in seen}
    linked = sum(weigh[k] * seen[k][1] for k in seen)
    return sum(weigh[k] * seen[k][2] for k in seen) / linked if linked else None


def _shares(vectors: DataFrame, found: DataFrame, drawn: list, threshold: float) -> tuple[int, float]:
    """How many drawn vectors have exact links, and the sum of the shares of these that are in their components."""
    queries: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for d in {len(r[1]) for r in drawn}:
        own = [r for r in drawn if len(r[1]) == d]
        queries[d] = (np.array([r[0] for r in own]), unit([pa.scalar(bytes(r[1]), pa.binary()) for r in own]))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.array([len(v.as_buffer()) for v in batch.column(1)])
            for d in np.unique(dims):
                if int(d) in queries:
                    at, (nodes, q) = np.flatnonzero(dims == d), queries[int(d)]
                    i, j = np.nonzero(q @ unit([batch.column(1)[int(k)] for k in at]).T >= threshold)
                    yield pa.RecordBatch.from_pydict({"a": pa.array(nodes[i], pa.int64()), "b": batch.column(0).take(pa.array(at[j]))})

    links = shared.written(vectors.select("node", "vec").mapInArrow(exact, "a long, b long").where("a <> b"), "audit")
    for x in ("a", "b"):
        links = links.join(found.select(F.col("node").alias(x), F.col("component").alias(f"of_{x}")), x, "left")
    each = links.groupBy("a").agg(F.avg(F.coalesce((F.col("of_a") == F.col("of_b")).cast("int"), F.lit(0))).alias("share"))
    n, total = each.agg(F.count("*"), F.sum("share")).first()
    return n, total or 0.0


def angles(members: DataFrame, edges: DataFrame) -> DataFrame:
    """members (component, node, many, vec) with angle, to the vector of their component with most neighbours."""
    degrees = edges.groupBy("a").agg(F.count("*").alias("degree")).withColumnRenamed("a", "node")
    light = members.select("component", "node").join(degrees, "node", "left")
    centres = shared.written(light.groupBy("component").agg(F.max_by("node", F.struct(F.coalesce("degree", F.lit(0)), "node")).alias("node")).select("node"), "centres")
    centre = shared.written(members.join(centres, "node").select("component", F.col("vec").alias("centre")), "centre")

    def angle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = np.full(batch.num_rows, np.pi)
                sizes = np.array([(len(x.as_buffer()), len(y.as_buffer())) for x, y in zip(batch.column(3), batch.column(4), strict=True)])
                for d in np.unique(sizes[:, 0]):
                    at = np.flatnonzero((sizes[:, 0] == d) & (sizes[:, 1] == d))
                    if len(at):
                        cosine = (unit([batch.column(3)[int(i)] for i in at]) * unit([batch.column(4)[int(i)] for i in at])).sum(axis=1)
                        out[at] = np.arccos(np.clip(cosine, -1, 1))
                yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(out)], names=["component", "node", "many", "vec", "angle"])

    near = members.join(centre, "component").select("component", "node", "many", "vec", "centre")
    return shared.written(near.mapInArrow(angle, "component long, node long, many long, vec binary, angle double"), "angles")


def counted(members: DataFrame, edges: DataFrame, threshold: float) -> DataFrame:
    """node and n_links: rows linked with each class, itself included, over all pairs inside each component.

    members: component, node, many, vec. A component is cut into blocks of about PORTION classes by
    their angle to its centre. Two vectors whose angles to it add up to no more than the threshold's
    are linked; if they differ by more, they are not. So each block is linked with all blocks up to
    some angle, and only those beyond, up to another, are compared, two at a time.
    """
    placed, most = angles(members, edges), math.acos(threshold)
    sizes = placed.groupBy("component").agg(F.ceil(F.count("*") / PORTION).cast("int").alias("blocks"), F.max("angle").alias("widest"))
    # Blocks of one angle each are of about one size where angles are spread evenly; a portion keeps them bounded elsewhere.
    ring = F.least(F.floor(F.col("angle") / F.greatest("widest", F.lit(1e-12)) * F.sqrt("blocks")), F.floor(F.sqrt("blocks")) - 1).cast("int")
    held = placed.join(shared.written(sizes, "sizes"), "component").withColumn("ring", F.greatest(ring, F.lit(0)))
    rings = held.groupBy("component", "ring").agg(F.ceil(F.count("*") / PORTION).cast("int").alias("portions"), F.sum("many").alias("all"), F.min("angle").alias("low"), F.max("angle").alias("high"))
    rings = shared.written(rings, "rings")
    # Pairs of rings of a component: about as many as it has blocks.
    one, two = rings.alias("o"), rings.alias("t")
    pairs = one.join(two, F.col("o.component") == F.col("t.component")).select(F.col("o.component").alias("component"), F.col("o.ring").alias("ring"), F.col("t.ring").alias("other"), F.col("t.portions").alias("portions"), F.col("t.all").alias("all"), (F.col("o.high") + F.col("t.high")).alias("far"), F.greatest(F.col("o.low") - F.col("t.high"), F.col("t.low") - F.col("o.high")).alias("apart"))
    pairs = shared.written(pairs.where(F.col("apart") <= most + SLACK), "pairs")
    sure = pairs.where(F.col("far") <= most - SLACK).groupBy("component", "ring").agg(F.sum("all").alias("sure"))
    portioned = held.join(rings.select("component", "ring", "portions"), ["component", "ring"]).withColumn("portion", F.pmod(F.xxhash64("node"), F.col("portions")).cast("int"))
    portioned = shared.written(portioned.select("component", "ring", "portion", "node", "many", "vec"), "portioned")
    open_ = pairs.where(F.col("far") > most - SLACK)
    mine = rings.select("component", "ring", F.col("portions").alias("own"))
    blocks = open_.join(mine, ["component", "ring"]).select("component", "ring", "other", F.explode(F.sequence(F.lit(0), F.col("own") - 1)).alias("portion"), "portions").select("*", F.explode(F.sequence(F.lit(0), F.col("portions") - 1)).alias("second"))
    blocks = shared.written(blocks.select("component", "ring", "portion", "other", "second", F.xxhash64("component", "ring", "portion", "other", "second").alias("pair")), "blocks")
    asks = portioned.join(blocks, ["component", "ring", "portion"]).select("pair", F.lit(True).alias("asks"), "node", "many", "vec")
    told = portioned.join(blocks.select("component", F.col("other").alias("ring"), F.col("second").alias("portion"), "pair"), ["component", "ring", "portion"]).select("pair", F.lit(False).alias("asks"), "node", "many", "vec")
    keyed = _grouped_by(asks.unionByName(told), F.col("pair")).select("__key", "asks", "node", "many", "vec")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in batching.runs(batches):
            asks = run.column(1).to_numpy(zero_copy_only=False).astype(bool)
            x, many = unit(run.column(4)), run.column(3).to_numpy()
            links = (x[asks] @ x[~asks].T >= threshold) @ many[~asks]
            yield pa.RecordBatch.from_pydict({"node": pa.array(run.column(2).to_numpy()[asks], pa.int64()), "n": pa.array(links, pa.int64())})

    compared = keyed.mapInArrow(count, "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))
    out = portioned.select("component", "ring", "node").join(shared.written(sure, "sure"), ["component", "ring"], "left").join(shared.written(compared, "compared"), "node", "left")
    return out.select("node", (F.coalesce("sure", F.lit(0)) + F.coalesce("n", F.lit(0))).alias("n_links"))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, floor: float = FLOOR) -> DataFrame:
    """One row for each row of vectors: vec_id, n_links, component_id, kept.

    Rows whose vector is null, zero or has null or non-finite components link with nothing, and so
    do those with a null vec_id (component_id null, kept false). Vectors of different lengths do not
    link. Rows that repeat a vec_id are rows of their own and count as links of each other when near.
    """
    with shared.scratch():
        rows = packed(vectors)
        of_class = [F.min("vec_id").alias("rep"), F.count("*").alias("many"), F.first("vec").alias("vec")]
        nodes = shared.written(rows.where("node IS NOT NULL").groupBy("node").agg(*of_class), "vectors")
        n, edges, recall = nodes.count(), None, 0.0
        for k in range(PASSES):
            fresh = bucket_edges(nodes, n, seed=k, threshold=threshold, floor=floor)
            edges = refine(fresh if edges is None else edges.unionByName(fresh).distinct(), nodes, threshold, floor)
            linked = edges.where(F.col("sim") >= threshold).select("a", "b")
            found = shared.written(graph.components(linked), "components")
            recall = audit(nodes, found, threshold)
            if recall is None:
                _LOG.info("pass %d: none of the drawn vectors has links", k + 1)
                break
            _LOG.info("pass %d: recall %.4f", k + 1, recall)
            if recall >= RECALL:
                break
        else:
            _LOG.warning("recall %.4f after %d passes", recall, PASSES)
            if recall < LEAST_RECALL:
                raise RuntimeError(f"recall {recall:.4f} after {PASSES} passes is below {LEAST_RECALL}")
        members = shared.written(found.join(nodes, "node").select("component", "node", "many", "vec", "rep"), "members")
        links = counted(members.drop("rep"), linked, threshold)
        least = members.groupBy("component").agg(F.min("rep").alias("component_id"))
        linked = members.select("node", "component").join(links, "node").join(least, "component").select("node", "n_links", "component_id")
        alone = nodes.select("node", F.col("many").alias("own"), "rep").join(linked, "node", "left")
        named = alone.select("node", F.coalesce("n_links", "own").alias("all_links"), F.coalesce("component_id", "rep").alias("component_id"))
        named = shared.written(named, "named", lasting=True)
    out = rows.select("vec_id", "node").join(named, "node", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce(F.col("all_links") - 1, F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"))


def op5_nn_descent(spark, sf_dir: str) -> DataFrame:
    """Links, component and survivor of every vector at cosine 0.95 or more.

    Null, empty and zero vectors, vectors with null or non-finite components and rows with a null
    vec_id link with nothing. Repeated rows count as links of each other. An empty table gives no
    rows; other columns are ignored. Recall is audited and logged, and the query fails below 0.9.
    """
    return near_duplicates(shared.table(spark, sf_dir, "embeddings"))
