"""A Merkle manifest of a table, and the proof of every leaf by a recursive query.

Leaves ascend within their tree (one for each lang). A stored node row is the part of a tree
below one node, SPAN heights high: the digests of these heights, and the height of the node row
above it (`up`, null at the root). The tree over all subroots continues above each lang's own.
The recursive query takes every leaf to its node row, folds the leaf's digest through its
heights, appends the siblings it met, and goes on to the node row above.

All leaves end in the few rows at the top. A join on these alone would be one task, so
each stretch of 4,096 leaves has its own copy of the node rows above it: about a byte a leaf
and height, and never more than 4,096 leaves for a key of the join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ludolytics.llm.shared import keep

#: Heights of a node row; leaves of a stretch as a power of two.
SPAN, STRETCH = 6, 12
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(**values) -> F.Column:
    """The digest of a row: each field as its byte count, a colon and itself, or a dash; binary."""
    shown = [v.cast("string") for v in values.values()]
    return F.unhex(F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in shown]), 256))


def digest(*parts: bytes) -> bytes:
    """The digest of digests, taken as hex text."""
    return hashlib.sha256(b"".join(parts).hex().encode()).digest()


def fold(digests: list[bytes], whole: bool) -> list[bytes]:
    """The digests of each height, joined: SPAN heights above the given ones, or as many as leave one node."""
    heights = [digests]
    while len(heights) <= SPAN if whole else len(heights[-1]) > 1:
        below = heights[-1]
        heights.append([digest(*below[k : k + 2]) for k in range(0, len(below), 2)])
    return [b"".join(h) for h in heights]


def _few(df: DataFrame, rows: int, each: int = 10_000) -> DataFrame:
    """A table of about so many rows, in no more partitions than these fill."""
    return df.coalesce(rows // each + 1)


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """The rows with `t`, the place of their `tree` among all trees, `pos`, their place in it, and `n`, the tree's rows.

    Rows are sorted by ranges. The places at which a range goes on come from one count for each range and tree it
    holds; the windows see these counts alone.
    """
    keys = [F.col(c).asc_nulls_first() for c in ("tree", *order)]
    ranged = keep(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    spans = ranged.groupBy("tree", part.alias("part")).agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    spans = keep(_few(spans, ranged.rdd.getNumPartitions()))
    earlier = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = spans.select("tree", "part", (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"))
    trees = spans.groupBy("tree").agg(F.min("part").alias("begins"), F.sum("rows").alias("n"))
    begun = trees.groupBy("begins").agg(F.count("*").alias("trees"))  # a row for each range at most
    begun = begun.select("begins", (F.sum("trees").over(Window.orderBy("begins")) - F.col("trees")).alias("before"))
    rank = F.row_number().over(Window.partitionBy("begins").orderBy("tree")) - 1
    trees = trees.join(begun, "begins").select("tree", "n", (F.col("before") + rank).alias("t"))
    known = shifts.join(trees, "tree")
    return ranged.withColumn("part", part).join(known, ["tree", "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("tree", "at", "part", "shift")


def node_rows(leaves: DataFrame, count: int, trees: int) -> DataFrame:
    """`count` leaves make (t, height, pos, n, leaves, levels) of `trees` trees, of leaves (t, pos, n, digest); n is the nodes of the tree at that height."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = [n > 1 << SPAN for n in batch.column(3).to_pylist()]
            kids = [[kid["digest"] for kid in row] for row in batch.column(5).to_pylist()]
            levels = [fold(digests, up) for digests, up in zip(kids, whole, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(levels, pa.list_(pa.binary()))], ["t", "height", "pos", "n", "leaves", "levels"])

    level, found = leaves.select("t", "pos", "n", F.col("n").alias("leaves"), "digest"), []
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most:
        count = (count >> SPAN) + trees
        grouped = level.groupBy("t", F.shiftright("pos", SPAN).alias("pos")).agg(F.first("n").alias("n"), F.first("leaves").alias("leaves"), F.array_sort(F.collect_list(F.struct(level["pos"], "digest"))).alias("kids"))
        ready = grouped.select("t", F.lit(len(found)).alias("height"), "pos", "n", "leaves", "kids")
        ready = _few(ready, count, 2_000).mapInArrow(run, "t long, height int, pos long, n long, leaves long, levels array<binary>")
        found.append(keep(ready))
        level = found[-1].where(F.col("n") > 1 << SPAN).select("t", "pos", F.ceil(F.col("n") / (1 << SPAN)).alias("n"), "leaves", F.element_at("levels", -1).alias("digest"))
        most = -(-most >> SPAN) if most > 1 << SPAN else 0
    rows = found[0] if found else leaves.limit(0).selectExpr("t", "0 AS height", "pos", "n", "n AS leaves", "array(digest) AS levels")
    for more in found[1:]:
        rows = rows.unionByName(more)
    return rows


def _stretches(first, last) -> F.Column:
    return F.explode(F.sequence(F.shiftright(first, STRETCH), F.shiftright(last, STRETCH)))


def linked(trees: DataFrame, over: DataFrame) -> DataFrame:
    """All node rows, with the copies that stretches have: (t, height, part, own, step, levels, up).

    `part` is pos >> SPAN of a leaf at height 0 and its stretch above. `own` tells the rows of the leaf's own
    tree from those of the tree over all subroots; `step` is the height within that tree.
    """
    own = trees.withColumn("first", F.expr(f"shiftleft(pos, {SPAN} * (height + 1))")).withColumn("last", F.least(F.col("leaves") - 1, F.expr(f"shiftleft(pos + 1, {SPAN} * (height + 1))") - 1))
    columns = ["t", "height", "part", "own", "step", "levels", "up"]
    own = own.select("*", F.lit(True).alias("own"), F.col("height").alias("step"), (F.col("height") + 1).alias("up"))
    low = own.where("height = 0").select("*", F.col("pos").alias("part")).select(columns)
    high = own.where("height > 0").select("*", _stretches(F.col("first"), F.col("last")).alias("part")).select(columns)
    tops = trees.where(F.col("n") <= 1 << SPAN).select("t", "height", "leaves")
    above = over.select(F.col("height").alias("step"), F.col("pos").alias("over"), "levels", F.when(F.col("n") > 1 << SPAN, F.lit(1)).alias("more"))
    heights = (over.agg(F.max("height")).first()[0] or 0) + 1
    ways = tops.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(heights - 1)))).select("t", "leaves", "height", "step", F.expr(f"shiftright(t, {SPAN} * (step + 1))").alias("over"))
    top = ways.join(above, ["step", "over"]).select("t", (F.col("height") + 1 + F.col("step")).alias("height"), _stretches(F.lit(0).cast("long"), F.col("leaves") - 1).alias("part"), F.lit(False).alias("own"), "step", "levels", (F.col("height") + 1 + F.col("step") + F.col("more")).alias("up"))
    return low.unionByName(high).unionByName(top)


CLIMB = f"""
WITH RECURSIVE climb(doc_id, leaf, t, pos, height, siblings, folded, subroot, root) AS (
  SELECT doc_id, leaf, t, pos, 0, X'', seen, CAST(NULL AS BINARY), CAST(NULL AS BINARY) FROM {{leaves}}
  UNION ALL
  SELECT doc_id, leaf, t, pos, up, met.siblings, met.folded, if(own, top, subroot), if(up IS NULL, top, root) FROM (
    SELECT c.doc_id, c.leaf, c.t, c.pos, c.subroot, c.root, n.up, n.own, element_at(n.levels, -1) AS top,
           aggregate(slice(n.levels, 1, size(n.levels) - 1),
             named_struct('at', shiftright(if(n.own, c.pos, c.t), {SPAN} * n.step) & {(1 << SPAN) - 1}L, 'siblings', c.siblings, 'folded', c.folded),
             (s, level) -> named_struct(
               'at', shiftright(s.at, 1),
               'siblings', s.siblings || substring(level, CAST((s.at ^ 1L) * 32 + 1 AS INT), 32),
               'folded', unhex(sha2(lower(hex(if(s.at % 2 = 0,
                 s.folded || substring(level, CAST((s.at ^ 1L) * 32 + 1 AS INT), 32),
                 substring(level, CAST((s.at ^ 1L) * 32 + 1 AS INT), 32) || s.folded))), 256)))) AS met
    FROM climb c JOIN {{nodes}} n ON c.t = n.t AND c.height = n.height
     AND n.part = shiftright(c.pos, if(c.height = 0, {SPAN}, {STRETCH})))
)
SELECT doc_id, lower(hex(leaf)) AS leaf, lower(hex(subroot)) AS subroot, lower(hex(root)) AS root,
       sha2(lower(hex(siblings)), 256) AS proof_sha256, lower(hex(folded)) AS folded_root, folded = root AS verified
FROM climb WHERE height IS NULL
"""


def manifest(docs: DataFrame, tampered: dict[str, F.Column] | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of each row.

    `tampered` gives columns that take the place of given ones in the leaf that is folded (folded_root);
    leaf, siblings, subroot and root are always those of the rows as they are. Null fields count as `-`. A null
    lang is a tree of its own, the first. Rows of equal doc_id ascend by their leaf digest; rows
    that are equal throughout share a digest, so their order makes no difference. A tree of
    one row is its own subroot, a table of one tree has that subroot as root, and a proof without
    siblings is the digest of no text. An empty table gives no rows. Columns besides the five are
    neither read nor returned. The session's limit on the rows of a recursive query is lifted,
    as that query returns every leaf once for each node row on its way.
    """
    given = {c: F.col(c) for c in FIELDS}
    leaf = leaf_digest(**given)
    other = leaf_digest(**given | tampered) if tampered else leaf
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))  # nulls first, then by bytes
    rows = keep(docs.select(F.col("doc_id").cast("long").alias("doc_id"), tree.alias("tree"), leaf.alias("leaf"), other.alias("seen"), F.monotonically_increasing_id().alias("row")))
    count = rows.count()
    leaves = keep(_few(placed(rows, ["doc_id", "leaf", "row"]).drop("row"), count))
    n_trees = (leaves.agg(F.max("t")).first()[0] or 0) + 1
    trees = node_rows(leaves.select("t", "pos", "n", F.col("leaf").alias("digest")), count, n_trees)
    subroots = trees.where(F.col("n") <= 1 << SPAN).select(F.lit(-1).cast("long").alias("t"), F.col("t").alias("pos"), F.lit(n_trees).cast("long").alias("n"), F.element_at("levels", -1).alias("digest"))
    over = node_rows(subroots, n_trees, 1)
    copies = (count >> SPAN) + n_trees + SPAN * ((count >> STRETCH) + n_trees)
    nodes = keep(_few(linked(trees, over), copies, 2_000))
    session = docs.sparkSession
    session.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    return session.sql(CLIMB, leaves=leaves, nodes=nodes)


def with_tampered_lengths(docs: DataFrame) -> DataFrame:
    """The manifest, every row whose crc32 of its decimal doc_id 7 divides tampered with by one more in n_chars."""
    hit = F.crc32(F.col("doc_id").cast("long").cast("string")) % 7 == 0
    return manifest(docs, {"n_chars": F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))})
