"""Nearest neighbours by inner product with multiprobe p-stable hashing.

Each vector gets one more component, so that all have the same length M; then the largest inner product
is the least distance. A table cuts K random projections of it into cells of width w; a vector lies in one
bucket of each table. A query visits its own buckets and perturbed ones, all tables together in the order of
the summed squared distances to the cell walls it crosses, which estimates their chance of success. What
the visited buckets hold is reranked by exact inner products and merged.

K follows the number of vectors; w and the number of visits come from a bounded sample of queries, whose
neighbours among all vectors are found exactly first: the least number of visits that finds the
wanted share of them. Where no number up to VISITS does, cells widen until one does (a table of one cell is
a full search), so no case is dropped for cost.

Equal vectors are one entry with their least ids. A bucket with many vectors or visits is dealt over blocks
of both, each pair of blocks once, so no task holds a whole bucket.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ludolytics.llm.shared import keep

TABLES, SEED = 6, 11
#: Queries the search is fitted on, the share of their neighbours it must find, and the most visits of a query.
SAMPLE, RECALL, VISITS = 192, 0.95, 192
#: Vectors or visits in a block of a bucket, at least; and the most buckets that are dealt over blocks.
BLOCK, HOT = 4096, 50_000


@dataclass(frozen=True)
class Plan:
    """The hash functions (tables x dimensions x K) and how they are visited."""

    lines: np.ndarray
    shifts: np.ndarray
    width: float
    length: float
    visits: int

    def places(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        """Where the vectors lie along each line, in cells: (vectors, tables, K)."""
        squares = np.zeros(len(vectors)) if query else np.maximum(0.0, self.length**2 - np.einsum("ij,ij->i", vectors, vectors))
        longer = np.concatenate([vectors, np.sqrt(squares)[:, None]], axis=1)
        tables, size, k = self.lines.shape
        flat = longer @ self.lines.transpose(1, 0, 2).reshape(size, tables * k)
        return flat.reshape(len(vectors), tables, k) / self.width + self.shifts

    def buckets(self, vectors: np.ndarray) -> np.ndarray:
        """The bucket of each vector in each table."""
        return bucket_keys(np.floor(self.places(vectors, query=False)).astype(np.int64))


def bucket_keys(cells: np.ndarray) -> np.ndarray:
    """A number for the cells (..., tables, K) of each table; equal numbers of different cells only add candidates."""
    value = np.broadcast_to(np.arange(cells.shape[-2], dtype=np.uint64), cells.shape[:-1]).copy()
    for k in range(cells.shape[-1]):
        value = (value ^ (value >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + cells[..., k].astype(np.uint64)
    return (value ^ (value >> np.uint64(32))).view(np.int64)


def visits(places: np.ndarray, most: int) -> Iterator[tuple[int, np.ndarray]]:
    """(table, cells) of one query's buckets, likeliest first: places is (tables, K).

    Steps to a neighbouring cell cost the squared distance to its wall. Sets of steps come off a heap in the order of
    their sums; each set is made from one that costs no more, by shifting or adding its last step.
    """
    tables, k = places.shape
    cells = np.floor(places).astype(np.int64)
    inside = places - cells
    costs = np.concatenate([inside**2, (1 - inside) ** 2], axis=1)
    order = np.argsort(costs, axis=1, kind="stable")
    sorted_costs = np.take_along_axis(costs, order, axis=1).tolist()
    heap = [(0.0, t, ()) for t in range(tables)]
    given = 0
    while heap and given < most:
        cost, table, steps = heapq.heappop(heap)
        price = sorted_costs[table]
        if not steps:
            heapq.heappush(heap, (price[0], table, (0,)))
        elif steps[-1] + 1 < 2 * k:
            last = steps[-1]
            heapq.heappush(heap, (cost - price[last] + price[last + 1], table, (*steps[:-1], last + 1)))
            heapq.heappush(heap, (cost + price[last + 1], table, (*steps, last + 1)))
        taken = order[table, list(steps)]
        if len(set((taken % k).tolist())) == len(steps):  # not both walls of one cell
            found = cells[table].copy()
            found[taken % k] += np.where(taken < k, -1, 1)
            given += 1
            yield table, found


def visit_keys(places: np.ndarray, most: int) -> np.ndarray:
    """The buckets that one query visits, in order."""
    cells = np.zeros((most, *places.shape), np.int64)
    tables = np.zeros(most, np.int64)
    n = 0
    for table, found in visits(places, most):
        cells[n, table], tables[n] = found, table
        n += 1
    return bucket_keys(cells[:n])[np.arange(n), tables[:n]]


# ---- vectors -------------------------------------------------------------------------


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vec) of the rows that take part; vec is array<float> where that is given, else array<double>, without negative zeros."""
    kind = "array<float>" if rows.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    chosen = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(kind).alias("vec")).where("vec_id IS NOT NULL AND size(vec) > 0")
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = chosen.where(finite & F.exists("vec", lambda x: x != 0)).select("vec_id", F.transform("vec", lambda x: F.when(x == 0, 0.0).otherwise(x)).cast(kind).alias("vec"))
    sizes = whole.groupBy(F.size("vec").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").first()
    return whole.where(F.size("vec") == (sizes["size"] if sizes else 0))


def entries(rows: DataFrame, ids: int) -> DataFrame:
    """(entry, vec, ids): each distinct vector once, with its least ids."""
    ranked = rows.withColumn("r", F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))).where(F.col("r") <= ids)
    found = ranked.groupBy("vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    return keep(found.select(F.monotonically_increasing_id().alias("entry"), "vec", "ids"))


def exact_scores(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products summed in one fixed order, so that equal vectors get equal scores wherever they are met."""
    return np.add.reduce(np.ascontiguousarray(vectors * query), axis=1)


def nearest(query: np.ndarray, vectors: np.ndarray, entry: np.ndarray, rough: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of `entry`, those with the k + 1 largest scores and all that tie with the last, by exact scores; `rough` may err in the last digits."""
    if len(rough) > k + 1:
        edge = np.partition(rough, len(rough) - k - 1)[len(rough) - k - 1]
        on = np.flatnonzero(rough >= edge - 1e-9 * (1 + abs(edge)))
    else:
        on = np.arange(len(rough))
    scores = exact_scores(query, vectors[on])
    if len(on) > k + 1:
        good = scores >= np.partition(scores, len(on) - k - 1)[len(on) - k - 1]
        on, scores = on[good], scores[good]
    return entry[on], scores


def matrix(column: pa.ListArray | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


# ---- plan ----------------------------------------------------------------------------


def fit(held: DataFrame, sample: DataFrame, k: int) -> Plan:
    """The plan that finds RECALL of the sample's neighbours; the sample (bounded by SAMPLE) is searched exactly, in one pass over all entries."""
    asked = sample.select("entry", "vec").collect()
    parts = F.count("*").alias("n"), F.max(F.size("vec")).alias("size"), F.max(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)).alias("longest")
    stats = held.agg(*parts).first()
    n, dimensions, length = stats["n"], stats["size"] or 1, float(np.sqrt(stats["longest"] or 1.0))
    queries = np.array([r["vec"] for r in asked], np.float64).reshape(len(asked), dimensions)
    own = np.array([r["entry"] for r in asked], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entry, vectors = batch.column(0).to_numpy(), matrix(batch.column(1))
            if not len(entry):
                continue
            products = queries @ vectors.T
            out = []
            for q, row in enumerate(products):
                found, scores = nearest(queries[q], vectors, entry, row, k)
                out += [(q, int(e), float(s)) for e, s in zip(found, scores) if e != own[q]]
            names = [("q", pa.int32()), ("entry", pa.int64()), ("score", pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, (_, t) in enumerate(names)], [n for n, _ in names])

    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "entry"))
    near = held.select("entry", "vec").mapInArrow(run, "q int, entry long, score double").withColumn("r", rank).where(F.col("r") <= k).drop("r")
    truth = near.join(held.select("entry", "vec"), "entry").select("q", "vec").collect()  # SAMPLE * k rows at most
    lines_each = max(2, round(0.4 * np.log2(max(n, 2))))
    rng = np.random.default_rng(SEED)
    lines, shifts = rng.normal(size=(TABLES, dimensions + 1, lines_each)), rng.uniform(size=(TABLES, lines_each))
    found = np.array([r["vec"] for r in truth], np.float64).reshape(len(truth), dimensions)
    of = np.array([r["q"] for r in truth], np.int64)
    width = 1.5 * length
    while True:
        plan = Plan(lines, shifts, width, length, VISITS)
        if not len(found):
            return plan
        held_in = plan.buckets(found)
        first = np.full(len(found), VISITS, np.int64)
        for q, places in enumerate(plan.places(queries, query=True)):
            mine = np.flatnonzero(of == q)
            if not len(mine):
                continue
            keys = visit_keys(places, VISITS)
            met = (keys[:, None, None] == held_in[mine][None]).any(axis=2)
            first[mine] = np.where(met.any(axis=0), met.argmax(axis=0), VISITS)
        wanted = int(np.ceil((RECALL if n > k + 1 else 1.0) * len(first)))  # few entries: all queries are in the sample, and all is found
        needed = int(np.sort(first)[wanted - 1]) + 1
        if needed <= VISITS:
            return Plan(lines, shifts, width, length, needed)
        width *= 1.25


# ---- search --------------------------------------------------------------------------


def _buckets(held: DataFrame, asked: DataFrame, plan: Plan) -> DataFrame:
    """(bucket, entry, is_query): the buckets that entries lie in, one of each table, and those that queries visit."""

    def rows(keys: list[np.ndarray], entry: np.ndarray, is_query: bool) -> pa.RecordBatch:
        found = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        holder = np.repeat(entry, [len(x) for x in keys]) if keys else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(found), pa.array(holder), pa.array(np.full(len(found), is_query))], ["bucket", "entry", "is_query"])

    def lie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield rows(list(plan.buckets(matrix(batch.column(1)))), batch.column(0).to_numpy(), False)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield rows([np.unique(visit_keys(x, plan.visits)) for x in plan.places(matrix(batch.column(1)), query=True)], batch.column(0).to_numpy(), True)

    schema = "bucket long, entry long, is_query boolean"
    return held.select("entry", "vec").mapInArrow(lie, schema).unionByName(asked.select("entry", "vec").mapInArrow(visit, schema))


def _cells(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(cell, entry, is_query): buckets, the large ones dealt over blocks so that each query meets each entry of its bucket once."""
    met = rows.groupBy("bucket").agg(F.count_if("is_query").alias("asked"), F.count_if(~F.col("is_query")).alias("lying"))
    met = keep(met.where("asked > 0 AND lying > 0"))
    total = met.agg(F.sum(F.col("asked") + F.col("lying"))).first()[0] or 0
    block = max(block, total // HOT + 1)
    parts = [F.ceil(F.col(c) / block).cast("int").alias(f"{c}_blocks") for c in ("lying", "asked")]
    large = met.where((F.col("asked") > block) | (F.col("lying") > block)).select("bucket", *parts)
    dealt = rows.join(met.select("bucket"), "bucket", "left_semi").join(F.broadcast(large), "bucket", "left")  # HOT rows at most
    dealt = dealt.fillna(1, ["lying_blocks", "asked_blocks"])
    mine, other = [F.when(F.col("is_query") if k else ~F.col("is_query"), F.col("lying_blocks")).otherwise(F.col("asked_blocks")) for k in (0, 1)]
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("entry"), mine)).withColumn("over", F.explode(F.sequence(F.lit(0), other - 1)))
    first, second = F.when(F.col("is_query"), F.col("over")).otherwise(F.col("own")), F.when(F.col("is_query"), F.col("own")).otherwise(F.col("over"))
    return dealt.select(F.xxhash64("bucket", first.cast("int"), second.cast("int")).alias("cell"), "entry", "is_query")


def _reranked(cells: DataFrame, k: int) -> DataFrame:
    """(query, entry, score): the best entries for each query in each cell. Rows are (cell, is_query, entry, vec)."""

    def run(table: pa.Table) -> pa.Table:
        is_query = table.column("is_query").to_numpy(zero_copy_only=False).astype(bool)
        entry, vectors = table.column("entry").to_numpy(), matrix(table.column("vec"))
        queries, others = np.flatnonzero(is_query), np.flatnonzero(~is_query)
        out: dict[str, list[np.ndarray]] = {"query": [], "entry": [], "score": []}
        pool, ids = vectors[others], entry[others]
        for start in range(0, len(queries) if len(others) else 0, 256):
            part = queries[start : start + 256]
            for at, row in zip(part, vectors[part] @ pool.T, strict=True):
                found, scores = nearest(vectors[at], pool, ids, row, k)
                out["query"].append(np.full(len(found), entry[at])), out["entry"].append(found), out["score"].append(scores)
        kinds = {"query": np.int64, "entry": np.int64, "score": np.float64}
        return pa.table({c: pa.array(np.concatenate([np.zeros(0, kind), *out[c]]).astype(kind)) for c, kind in kinds.items()})

    return cells.groupBy("cell").applyInArrow(run, "query long, entry long, score double")


def search(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20, k: int = 20, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each row whose id `every` divides, by largest inner product.

    Candidates are all rows but those of the query's own id; ties go to the smaller id. Scores are inner products of
    the vectors as given, in double precision. Rows without an id, vectors null, empty, zero or with null or non-finite
    components, and vectors of another length than most have (of lengths as frequent: the smallest)
    take no part. A row that repeats another's id and vector counts once; an id with two vectors is two candidates, and
    two queries if it is one. Fewer than k candidates are all returned, as too few neighbours
    widen the cells up to a full search. An empty table gives no rows. Other columns are neither read nor returned.
    """
    good = keep(usable(rows, id_col, vector_col).distinct())
    twins = good.groupBy("vec_id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
    held = entries(good, k + twins)
    owners = keep(good.where(F.col("vec_id") % every == 0).join(held, "vec").select("entry", F.col("vec_id").alias("query_id")))
    asked = keep(owners.select("entry").distinct().join(held.select("entry", "vec"), "entry"))
    plan = fit(held, asked.orderBy(F.xxhash64("vec"), "entry").limit(SAMPLE), k)
    cells = _cells(keep(_buckets(held, asked, plan)), block)
    scored = _reranked(cells.join(held.select("entry", "vec"), "entry"), k)
    by_score = Window.partitionBy("query").orderBy(F.desc("score"))
    best = scored.groupBy("query", "entry").agg(F.max("score").alias("score")).withColumn("r", F.rank().over(by_score)).where(F.col("r") <= k + 1)
    named = best.join(held.select("entry", F.explode("ids").alias("vec_id")), "entry")
    first = named.withColumn("r", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))).where(F.col("r") <= k + twins)
    answers = owners.join(first.select(F.col("query").alias("entry"), "vec_id", "score"), "entry").where("vec_id != query_id")
    rank = F.row_number().over(Window.partitionBy("query_id", "entry").orderBy(F.desc("score"), "vec_id"))
    return answers.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
