"""A Merkle manifest of a dataset (operator 11).

Rows are leaves, in order, of one tree a source; the trees' roots are the leaves of one more. Every
level is a self-join of its nodes: each node computes the indices of its siblings (its run's slots
other than its own), and an equijoin on group and index brings digests there. Slot-zero rows emit the
parents. Proofs come down again: a node's path is its own siblings before its parent's path.

Positions are numbered by ranges of (source, id), so no source is one task's work. A level has a
sixteenth of the rows of the one below, and as many rounds run as the greatest source has levels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import ordered
from . import shared

#: Nodes of a run; a parent has so many children at most.
ARITY = 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def hashed(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value with its UTF-8 length before it, so that no two rows give the same bytes; null is a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(docs: DataFrame, text: Column | None = None) -> Column:
    """The digest of a row of documents, or of one with another text."""
    text = F.col("text") if text is None else text
    return hashed(field(F.col("doc_id").cast("long")), field(F.col("source")), field(F.col("lang")), field(F.col("n_chars").cast("long")), field(text))


def _joined(nodes: DataFrame, zero: bool, carried: list[str]) -> DataFrame:
    """The nodes, or those of slot zero, with sibs: struct(p, d) of the siblings in order.

    Every node offers its digest (as bytes, half of its text) to the index of each sibling; the offers
    meet their nodes by an equijoin.
    """
    base = F.col("pos") - F.col("pos") % ARITY
    if zero:
        askers, targets = nodes.where(F.col("pos") % ARITY == 0), nodes.where(F.col("pos") % ARITY > 0).withColumn("__to", base)
    else:
        indices = F.filter(F.sequence(base, base + ARITY - 1), lambda t: t != F.col("pos"))
        askers, targets = nodes, nodes.withColumn("__to", F.explode(indices))
    offers = targets.select(F.col("grp").alias("__grp"), "__to", F.struct(F.col("pos").alias("p"), F.unhex("digest").alias("d")).alias("__sib"))
    both = askers.join(offers, (askers["grp"] == offers["__grp"]) & (askers["pos"] == offers["__to"]), "left")
    kept = [F.first(c).alias(c) for c in ("digest", *carried)]
    return both.groupBy("grp", "pos").agg(*kept, F.array_sort(F.collect_list("__sib")).alias("sibs"))  # 15 at most


def _text(sibs: Column) -> Column:
    return F.array_join(F.transform(sibs, lambda s: F.lower(F.hex(s["d"]))), "")


class Tree:
    """Levels of nodes (grp, pos, digest) from the leaves up, and the root of each group (grp, digest)."""

    def __init__(self, leaves: DataFrame):
        self.levels, self.roots = [leaves.select("grp", "pos", "digest")], None
        while True:
            rows = _joined(self.levels[-1], True, [])
            alone = (F.col("pos") == 0) & (F.size("sibs") == 0)
            parent = F.when(alone, F.col("digest")).otherwise(hashed(F.col("digest"), _text(F.col("sibs"))))
            emitted = shared.written(rows.select("grp", F.floor(F.col("pos") / ARITY).alias("pos"), parent.alias("digest"), alone.alias("top")), "merkle")
            tops = emitted.where("top").select("grp", "digest")
            self.roots = tops if self.roots is None else self.roots.unionByName(tops)
            above = emitted.where("NOT top").select("grp", "pos", "digest")
            if above.isEmpty():
                return
            self.levels.append(above)

    def paths(self, leaves: DataFrame, seed: DataFrame) -> DataFrame:
        """leaves with steps, the (left, right) siblings of each level up to the group's root, then those of the seed.

        seed: grp, steps and further columns, which every leaf of the group gets with its path. A
        group's seed joins the group's root alone and comes down with the paths, so that no group's
        rows meet in one task.
        """
        carried = [c for c in seed.columns if c not in ("grp", "steps")]
        up = None
        for k in range(len(self.levels) - 1, -1, -1):
            own = [c for c in leaves.columns if c not in ("grp", "pos", "digest")] if k == 0 else []
            rows = _joined(leaves if k == 0 else self.levels[k], False, own)
            alone = (F.col("pos") == 0) & (F.size("sibs") == 0)
            step = F.struct(_text(F.filter("sibs", lambda s: s["p"] < F.col("pos"))).alias("left"), _text(F.filter("sibs", lambda s: s["p"] > F.col("pos"))).alias("right"))
            rows = rows.select("grp", "pos", "digest", *own, "sibs", F.when(alone, F.lit(-1)).otherwise(F.floor(F.col("pos") / ARITY)).alias("__up"))
            above = seed.select(F.col("grp").alias("__grp"), F.lit(-1).cast("bigint").alias("__at"), F.col("steps").alias("__steps"), *carried)
            if up is not None:
                above = above.unionByName(up.select(F.col("grp").alias("__grp"), F.col("pos").alias("__at"), F.col("steps").alias("__steps"), *carried))
            both = rows.join(above, (F.col("grp") == F.col("__grp")) & (F.col("__up") == F.col("__at")))
            steps = F.when(F.col("__up") < 0, F.col("__steps")).otherwise(F.concat(F.array(step), "__steps"))
            up = both.select("grp", "pos", "digest", *own, steps.alias("steps"), *carried)
            if k:
                up = shared.written(up, "paths")
        return up


def folded(start: Column, steps: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(steps, start, lambda at, s: hashed(s["left"], at, s["right"]))


def manifest(docs: DataFrame, tampered: Column) -> DataFrame:
    """For each row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    tampered: the text that a verifier finds in the place of the row's own, null where the text is as
    it was. Leaves of a source ascend by doc_id, null ids first, then by digest; rows that are equal
    in all five columns are equal leaves in any order. A null source comes before all others, an
    empty one after it. Empty and null texts are leaves like any. An empty table gives no rows. Other
    columns are ignored.
    """
    grp = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))  # null first
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), grp.alias("grp"), leaf(docs).alias("digest"), F.when(tampered.isNotNull(), leaf(docs, tampered)).alias("found"))
    # Equal rows are equal leaves: a draw lets very many of them lie in several ranges.
    rows = shared.written(rows.withColumn("__tie", F.rand(11)), "digests")  # each text is hashed once
    line = ordered.ranges(rows, ["grp"], ["doc_id", "digest", "__tie"]).scan(n=ordered.number())
    leaves = shared.written(line.result().select("grp", (F.col("n") - 1).alias("pos"), "digest", "doc_id", "found"), "leaves")
    sources = Tree(leaves)
    named = ordered.numbered(sources.roots.select(F.lit("").alias("grp"), F.col("grp").alias("of"), "digest"), ["grp"], ["of"], "n")
    tops = shared.written(named.select("grp", (F.col("n") - 1).alias("pos"), "digest", "of"), "subroots")
    whole = Tree(tops)
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    over = whole.paths(tops, whole.roots.select("grp", nothing.alias("steps"), F.col("digest").alias("root")))
    seed = shared.written(over.select(F.col("of").alias("grp"), "steps", "root", F.col("digest").alias("subroot")), "seed")
    out = sources.paths(leaves, seed)
    proof = F.array_join(F.transform("steps", lambda s: F.concat(s["left"], s["right"])), "")
    out = out.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", F.sha2(proof.cast("binary"), 256).alias("proof_sha256"), folded(F.coalesce("found", "digest"), F.col("steps")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op11_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """The manifest of all documents; where 5 divides crc32(doc_id), the text is tampered with: A-Z lower-cased.

    Null ids and null texts are not tampered with. See manifest() for ties, empty and repeated rows.
    """
    docs = shared.table(spark, sf_dir, "documents")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return manifest(docs, F.when(hit, F.translate("text", _UPPER, _LOWER)))


def _tree_sql(tree: str, leaves: str, levels: int) -> list[str]:
    """Common table expressions of a tree: its levels, siblings, roots, and the folds and proofs of its leaves.

    leaves has grp, pos, digest and start; {tree}_out has grp, pos, digest, root, fold and proof.
    """
    out = [f"{tree}_0 AS (SELECT grp, pos, digest, count(*) OVER (PARTITION BY grp) AS n FROM {leaves})"]
    for k in range(levels):
        out.append(f"{tree}_{k + 1} AS (SELECT *, count(*) OVER (PARTITION BY grp) AS n FROM (SELECT grp, pos // 16 AS pos, sha256(string_agg(digest, '' ORDER BY pos)) AS digest FROM {tree}_{k} WHERE n > 1 GROUP BY 1, 2))")
        side = "coalesce(string_agg(digest, '') OVER (PARTITION BY grp, pos // 16 ORDER BY pos ROWS BETWEEN {}), '')"
        out.append(f"{tree}_s{k} AS (SELECT grp, pos, {side.format('UNBOUNDED PRECEDING AND 1 PRECEDING')} AS l, {side.format('1 FOLLOWING AND UNBOUNDED FOLLOWING')} AS r FROM {tree}_{k} WHERE n > 1)")
    out.append(f"{tree}_root AS (" + " UNION ALL ".join(f"SELECT grp, digest AS root FROM {tree}_{k} WHERE n = 1" for k in range(levels + 1)) + ")")
    out.append(f"{tree}_f0 AS (SELECT grp, pos, digest, start AS fold, '' AS proof, rid FROM {leaves})")
    for k in range(levels):
        out.append(f"{tree}_f{k + 1} AS (SELECT f.grp, f.pos, f.digest, CASE WHEN s.l IS NULL THEN fold ELSE sha256(l || fold || r) END AS fold, CASE WHEN s.l IS NULL THEN proof ELSE proof || l || r END AS proof, rid FROM {tree}_f{k} f LEFT JOIN {tree}_s{k} s ON s.grp = f.grp AND s.pos = f.pos // {16**k})")
    return out


def oracle(levels: int = 6) -> str:
    """The same in SQL, for up to 16**levels documents a source and as many sources."""
    part = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    row = lambda text: f"sha256({part('doc_id')} || {part('source')} || {part('lang')} || {part('n_chars')} || {part(text)})"
    bit = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    byte = f"list_reduce([xor(c, b)] || [CAST(0 AS BIGINT) FOR i IN range(8)], lambda x, y: {bit})"
    crc = f"xor(list_reduce([CAST(4294967295 AS BIGINT)] || [CAST(ascii(d) AS BIGINT) FOR d IN string_split(CAST(doc_id AS VARCHAR), '')], lambda c, b: {byte}), 4294967295)"
    ctes = [
        f"own AS (SELECT doc_id, coalesce('s' || source, 'n') AS grp, {row('text')} AS digest, CASE WHEN text IS NOT NULL AND {crc} % 5 = 0 THEN {row(f'translate(text, {_UPPER!r}, {_LOWER!r})')} END AS found FROM documents)",
        "leaves AS (SELECT grp, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos, digest, coalesce(found, digest) AS start, doc_id AS rid FROM own)",
        *_tree_sql("a", "leaves", levels),
        "tops AS (SELECT '' AS grp, row_number() OVER (ORDER BY grp) - 1 AS pos, root AS digest, root AS start, grp AS rid FROM a_root)",
        *_tree_sql("b", "tops", levels),
    ]
    # A leaf's fold reaches its subroot; from there it goes on along the subroot's own siblings.
    ctes.append(f"g0 AS (SELECT f.rid AS doc_id, f.digest AS leaf, t.digest AS subroot, f.fold, f.proof, t.pos AS spot FROM a_f{levels} f JOIN tops t ON t.rid = f.grp)")
    for k in range(levels):
        ctes.append(f"g{k + 1} AS (SELECT doc_id, leaf, subroot, CASE WHEN l IS NULL THEN fold ELSE sha256(l || fold || r) END AS fold, CASE WHEN l IS NULL THEN proof ELSE proof || l || r END AS proof, spot FROM g{k} LEFT JOIN b_s{k} s ON s.pos = spot // {16**k})")
    return "WITH " + ",\n".join(ctes) + f"\nSELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = root AS verified FROM g{levels}, b_root"
