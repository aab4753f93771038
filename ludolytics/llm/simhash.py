"""SimHash near-duplicates by a generalised pigeonhole search.

The 64 fingerprint bits are grouped into partitions of correlated bits. Each partition i
gets a threshold e_i (-1: not searched) so that the e_i + 1 add up to distance + 1: two
fingerprints at that distance or less must then agree to e_i bits in some partition.
Grouping, number of partitions and thresholds come from a dynamic programme over the
candidate counts that the bit statistics of all fingerprints predict.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludolytics.llm import alike
from ludolytics.llm.components import components
from ludolytics.llm.shared import free_name, giving_back, keep, with_rows

BITS = 64
SEED = 42


def fingerprint(text: bytes | None, width: int = 3, block: int = 1 << 16) -> int:
    """The SimHash of one text, unsigned. Texts without words have zero."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    last = max(1, len(words) - width + 1)
    hashed = partial(xxhash.xxh64_intdigest, seed=SEED)
    ones = np.zeros(BITS, np.int64)
    for start in range(0, last, block):
        part = words[start : min(start + block, last) + width - 1]
        shingles = map(b" ".join, zip(*(part[k:] for k in range(width)))) if last > 1 or len(words) == width else [b" ".join(part)]
        hashes = np.fromiter(map(hashed, shingles), np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > last, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(doc_id, fp): fp as a signed long. A null text is an empty one; rows are kept one to one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(text, width) for text in batch.column(1).cast(pa.binary()).to_pylist()]
            found = np.array(fps, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "fp"])

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(run, "doc_id long, fp long")


# ---- statistics and plan -------------------------------------------------------


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and how often each two bits are set together, over all of them."""

    def run(batches):
        total = np.zeros((BITS, BITS))
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(values, axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
            yield pa.RecordBatch.from_pydict({"cell": pa.array([-1]), "n": pa.array([len(bits)])})
        cells = np.arange(BITS * BITS)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(cells), "n": pa.array(total.ravel().astype(np.int64))})

    rows = fps.select("fp").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    found = {row["cell"]: row["n"] for row in rows}  # at most 64 * 64 + 1 rows
    together = np.array([found.get(i, 0) for i in range(BITS * BITS)], float).reshape(BITS, BITS)
    return found.get(-1, 0), together


@dataclass(frozen=True)
class Part:
    bits: tuple[int, ...]
    threshold: int

    @property
    def mask(self) -> int:
        return signed(sum(1 << b for b in self.bits))


def signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def group_bits(correlation: np.ndarray, parts: int) -> list[list[int]]:
    """Equal groups; each starts at a free bit and takes the free bit most correlated with it so far."""
    free, groups = set(range(BITS)), []
    for k in range(parts):
        width = BITS // parts + (k < BITS % parts)
        group = [min(free)]
        free.discard(group[0])
        while len(group) < width:
            best = max(free, key=lambda b: (correlation[b, group].sum(), -b))
            group.append(best)
            free.discard(best)
        groups.append(group)
    return groups


def chance(group: list[int], rates: np.ndarray, joint: np.ndarray, most: int) -> list[float]:
    """P(two fingerprints differ in at most e bits of the group), e = 0..most, as a chain of its bits."""
    same = rates**2 + (1 - rates) ** 2
    ways = {}
    for k, bit in enumerate(group):
        new: dict[tuple[int, bool], float] = {}
        for equal in (True, False):
            alone = same[bit] if equal else 1 - same[bit]
            if k == 0:
                new[(0 if equal else 1, equal)] = alone
                continue
            for (gone, before), p in ways.items():
                given = same[group[k - 1]] if before else 1 - same[group[k - 1]]
                both = joint[group[k - 1], bit]  # both bits agree
                agree = both if before else same[bit] - both
                step = agree if equal else given - agree
                if gone + (not equal) <= most and given > 0:
                    key = (gone + (not equal), equal)
                    new[key] = new.get(key, 0.0) + p * min(1.0, max(0.0, step / given))
        ways = new
    return [sum(p for (gone, _), p in ways.items() if gone <= e) for e in range(most + 1)]


def make_plan(n: int, together: np.ndarray, distance: int = 2, probe_cost: float = 1.0, verify_cost: float = 0.5) -> list[Part]:
    """The cheapest exact search: the grouping into 1 to distance + 2 parts and their thresholds."""
    n = max(n, 1)
    rates = np.diag(together) / n
    one_one = together / n
    one_zero = rates[:, None] - one_one
    zero_one = rates[None, :] - one_one
    zero_zero = 1 - one_one - one_zero - zero_one
    joint = one_one**2 + one_zero**2 + zero_one**2 + zero_zero**2
    spread = np.sqrt(rates * (1 - rates))
    with np.errstate(divide="ignore", invalid="ignore"):
        correlation = np.abs(np.nan_to_num((one_one - np.outer(rates, rates)) / np.outer(spread, spread)))
    best: tuple[float, list[Part]] | None = None
    for parts in range(1, distance + 3):
        groups = group_bits(correlation, parts)
        table: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}  # sum of e + 1 so far
        for group in groups:
            odds = chance(group, rates, joint, distance)
            probes = np.cumsum([1.0, len(group), len(group) * (len(group) - 1) / 2, *[np.inf] * distance])
            new: dict[int, tuple[float, list[int]]] = {}
            for spent, (cost, chosen) in table.items():
                for e in range(-1, distance + 1 - spent):
                    more = 0.0 if e < 0 else n * probes[e] * probe_cost + n * (n - 1) / 2 * odds[e] * verify_cost
                    at = spent + e + 1
                    if at not in new or cost + more < new[at][0]:
                        new[at] = (cost + more, [*chosen, e])
            table = new
        cost, chosen = table[distance + 1]
        if best is None or cost < best[0]:
            best = (cost, [Part(tuple(g), e) for g, e in zip(groups, chosen, strict=True)])
    return best[1]


# ---- search --------------------------------------------------------------------


def _flips(bits: tuple[int, ...], most: int) -> list[int]:
    """All masks with at most `most` of the bits set."""
    masks = [(0, -1)]
    found = [0]
    for _ in range(most):
        masks = [(mask | 1 << bit, k) for mask, last in masks for k, bit in enumerate(bits) if k > last]
        found += [mask for mask, _ in masks]
    return [signed(mask) for mask in found]


def links(fps: DataFrame, plan: list[Part], distance: int = 2, bucket: int = 8) -> DataFrame:
    """(u, v) over distinct fingerprints `fp`: enough links to connect whatever is within the distance.

    Fingerprints probe the buckets of their partition value and its variants; pairs from
    buckets of up to `bucket` fingerprints are verified one by one. A larger bucket is not
    expanded into pairs: all fingerprints that probe it go through `cover`, which is
    exact as well and linear in their number.
    """
    searched = [(k, p) for k, p in enumerate(plan) if p.threshold >= 0]
    index = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(k).alias("part"), F.col("fp").bitwiseAND(F.lit(p.mask)).alias("key")) for k, p in searched])).alias("at")).select("fp", "at.part", "at.key")
    wide = [(k, p) for k, p in searched if p.threshold > 0]
    probe = index
    if wide:
        masks = F.array(*[F.struct(F.lit(k).alias("part"), F.lit(p.mask).alias("mask"), F.lit(flip).alias("flip")) for k, p in wide for flip in _flips(p.bits, p.threshold) if flip])
        more = fps.select("fp", F.explode(masks).alias("at")).select("fp", "at.part", F.col("fp").bitwiseXOR(F.col("at.flip")).bitwiseAND(F.col("at.mask")).alias("key"))
        probe = index.unionByName(more)
    least = 1 if wide else 2
    buckets = index.groupBy("part", "key").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    probe = keep(probe.join(buckets, ["part", "key"]).select("part", "key", "fp", "n"))
    small = probe.where(F.col("n") <= bucket).select("part", "key", F.col("fp").alias("u"))
    other = (index.join(buckets.where(F.col("n") <= bucket), ["part", "key"]) if wide else probe.where(F.col("n") <= bucket)).select("part", "key", F.col("fp").alias("v"))
    close = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance
    pairs = small.join(other, ["part", "key"]).where((F.col("u") < F.col("v")) & close).select("u", "v")
    large = probe.where(F.col("n") > bucket).select("fp").distinct()
    return pairs.unionByName(cover(large, distance)).distinct()


def cover(fps: DataFrame, distance: int = 2) -> DataFrame:
    """(u, v) that connect all fingerprints within the distance, without looking at pairs.

    Two fingerprints at distance d or less have a common value at half of d or less from
    both (d even), and whatever shares such a value is at d or less from each other.
    So each value's least fingerprint is linked to the others of that value, which are
    few: no more than there are values that near.
    """
    if distance % 2:
        raise ValueError("the cover needs an even distance")
    flips = F.array(*[F.lit(mask) for mask in _flips(tuple(range(BITS)), distance // 2)])
    near = fps.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("value"))
    met = near.groupBy("value").agg(F.collect_list("fp").alias("members")).where(F.size("members") > 1)
    star = met.select(F.array_min("members").alias("u"), F.explode("members").alias("v"))
    return star.where((F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance)).distinct()


def _grouped(docs: DataFrame, id_col: str, text_col: str, width: int, distance: int, bucket: int, jaccard: bool, row_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(row, doc_id, fp) of each row, and (fp, root, low): each fingerprint's group, and the least doc_id in it."""

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            found = np.array([fingerprint(text, width) for text in texts], np.uint64).view(np.int64)
            sigs = [alike.signature(alike.words_of(text)) if jaccard else None for text in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found), pa.array(sigs, pa.int64())], ["row", "doc_id", "fp", "sig"])

    row = F.col(row_col) if row_col else F.lit(None)
    chosen = docs.select(row.cast("string").alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    base = keep(chosen.mapInArrow(run, "row string, doc_id long, fp long, sig long"))
    distinct = keep(base.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    plan = make_plan(*bit_counts(distinct), distance)
    edges = links(distinct, plan, distance, bucket)
    if jaccard:
        prints = base.select("sig", "fp").distinct()
        more = alike.links(chosen.select("text"))
        more = more.join(prints.select(F.col("sig").alias("u"), F.col("fp").alias("a")), "u").join(prints.select(F.col("sig").alias("v"), F.col("fp").alias("b")), "v")
        edges = edges.unionByName(more.where("a != b").select(F.col("a").alias("u"), F.col("b").alias("v")))
    linked = components(keep(edges))
    rooted = keep(linked.join(distinct, linked["node"] == distinct["fp"]).select("fp", "root", "rep"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("rep").alias("low")), "root").select("fp", "root", "low")
    owner = distinct.join(named, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("low", "rep").alias("low"))
    return base, keep(owner)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, distance: int = 2, bucket: int = 8, jaccard: bool = True) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the smallest doc_id reachable over links.

    Fingerprints of `distance` (even) or fewer differing bits are linked; with `jaccard`, texts
    whose five-word shingles are alike by 0.8 or more as well. Links are sought
    between distinct fingerprints only, so copies cost nothing. Null texts count as empty;
    texts without words all have fingerprint zero and are linked like others. A null
    doc_id never names a component, unless no document of it has an id (then null).
    Repeated rows come back as often; an empty table gives no rows; other columns are
    neither read nor returned.
    """
    base, owner = _grouped(docs, id_col, text_col, width, distance, bucket, jaccard)
    return base.join(owner, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("low").alias("component_id"))


def first_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, distance: int = 2, bucket: int = 8, jaccard: bool = True) -> DataFrame:
    """One row of each group of `near_duplicates`, with all its columns: that of the least doc_id, one without an id only if all are."""
    name = free_name(docs, "_row")
    keyed = with_rows(docs, name)
    base, owner = _grouped(keyed, id_col, text_col, width, distance, bucket, jaccard, name)
    placed = base.join(owner, "fp")
    first = placed.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first"))
    others = keep(placed.join(first, "root").where(F.col("row") != F.col("first.row")).select(F.col("row").alias(name)))
    return keyed.join(others, name, "left_anti").select(*docs.columns)
