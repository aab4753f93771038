"""All pairs of texts whose sets of five-word shingles are alike by Jaccard: an exact prefix search.

With all shingles in one common order, two sets that share 4 in 5 must meet in the first
n - ceil(4 n / 5) + 1 shingles of each. Any order gives the same pairs. The order here is that of a count
of the shingles of all texts, kept in a table of SLOTS sums (a shingle counts as its slot): rare ones
come first, so passages that many texts share stay out of these prefixes unless a text is little else.
Where two sets meet first, what they can share is bounded by what each has from there on (`rest`), so
most pairs of one shingle are ruled out by two numbers before they exist.

The members of a prefix shingle are compared with its first one first, the one with fewest rarer shingles: of a
text and its near copies that is the text itself or a copy with few changes, which most others are alike.
What that joins is one group; then members of different groups are compared, so no pair that matters is left out. The
largest group of a shingle is never compared with itself, and members that the sizes and rests of all its
members rule out don't travel. Those left carry a sketch of PARITIES bits: sets differ in no fewer shingles than
their sketches in bits, which rules out most pairs that share a prefix without being alike. Whole sets travel only for pairs
that may be alike, once for each partner that several have.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ludolytics.llm.components import components
from ludolytics.llm.shared import giving_back, keep

WIDTH = 5
#: Sums that the order of shingles comes from, and the slices they travel in; bits that tell wanted texts. None changes a result.
SLOTS, SLICES, MARKS = 1 << 22, 64, 1 << 20
#: Sets that meet their common partner in one task; bits of a sketch.
MEMBERS, PARITIES = 500, 1024
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def signature(words: list[bytes]) -> int:
    """One number for all texts of the same words (signed)."""
    value = xxhash.xxh64_intdigest(b" ".join(words), seed=5)
    return value - (1 << 64) if value >> 63 else value


def shingles(words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    """The distinct shingles as sorted numbers; fewer than five words are one, no words none."""
    if len(known) > 150_000:
        known.clear()
    for word in set(words).difference(known):
        known[word] = xxhash.xxh64_intdigest(word, seed=7)
    ids = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(WIDTH, len(words))
    if not width:
        return ids
    found = np.full(len(ids) - width + 1, width, np.uint64)
    for k in range(width):
        found = (found ^ (found >> np.uint64(29))) * _PRIME + ids[k : k + len(found)]
    return np.unique(found)


def slots(found: np.ndarray) -> np.ndarray:
    return (found >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)


def prefix(found: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The shingles of which a set as alike has one in its own prefix, the rarest by the sums of the slots first."""
    n = len(found)
    return found[np.lexsort((found, counts[slots(found)]))[: n - (4 * n + 4) // 5 + 1]] if n else found


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Jaccard of 4 in 5 or more, in whole numbers."""
    return 9 * len(np.intersect1d(a, b, assume_unique=True)) >= 4 * (len(a) + len(b))


def may_be_alike(n, m, rest_n, rest_m):
    """Whether sets of n and m shingles can share 4 in 5, if what they have from their first common one on is rest_n and rest_m.

    Works on numbers and on columns.
    """
    least = F.least if isinstance(n, F.Column) else min
    return (9 * least(rest_n, rest_m) >= 4 * (n + m)) & (5 * n >= 4 * m) & (5 * m >= 4 * n)


def sketch(found: np.ndarray) -> np.ndarray:
    """By remainder of the shingles, whether an odd number has it, as longs."""
    odd = np.bincount((found % np.uint64(PARITIES)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.bool_)).view(np.int64)


def slot_sums(texts: DataFrame) -> np.ndarray:
    """How many shingles of all texts fall in each slot, up to 65,535 (uint16). A task counts a slot up to 255."""

    @giving_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        sums = np.zeros(SLOTS, np.uint8)
        for batch in batches:
            met = [slots(shingles(words_of(t), known)) for t in batch.column(0).cast(pa.binary()).to_pylist()]
            if met:
                each, times = np.unique(np.concatenate(met), return_counts=True)
                sums[each] = np.minimum(255, sums[each] + times)
        used = np.flatnonzero(sums)
        size, rows = SLOTS // SLICES, []
        bounds = np.searchsorted(used, np.arange(SLICES + 1) * size)
        for k in range(SLICES):
            places = used[bounds[k] : bounds[k + 1]]
            if 5 * len(places) < size:  # few: their places and counts, else all counts
                rows.append((k, (places - k * size).astype(np.uint32).tobytes(), sums[places].tobytes()))
            else:
                rows.append((k, None, sums[k * size : (k + 1) * size].tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *[pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2)]], ["slice", "places", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(SLOTS // SLICES, np.int64)
        for places, counts in zip(table.column("places").to_pylist(), table.column("counts").to_pylist(), strict=True):
            values = np.frombuffer(counts, np.uint8)
            total[np.frombuffer(places, np.uint32) if places is not None else slice(None)] += values
        return pa.table({"slice": table.column("slice")[:1], "total": pa.array([np.minimum(65535, total).astype(np.uint16).tobytes()], pa.binary())})

    summed = texts.mapInArrow(count, "slice int, places binary, counts binary").groupBy("slice").applyInArrow(add, "slice int, total binary")
    sums = np.zeros((SLICES, SLOTS // SLICES), np.uint16)
    for row in summed.collect():  # SLICES rows of equal size
        sums[row["slice"]] = np.frombuffer(row["total"], np.uint16)
    return sums.ravel()


def _met(texts: DataFrame) -> DataFrame:
    """(key, sig, n, rest, first) of the prefix shingles that two texts or more have; first is the member (place, sig, n) that has it in the first place."""
    counts = slot_sums(texts)

    @giving_back
    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        seen: set[int] = set()  # copies of a text are one in each task
        for batch in batches:
            found: list[tuple[int, int, np.ndarray]] = []
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                words = words_of(text)
                if words and (sig := signature(words)) not in seen:
                    seen.add(sig)
                    held = shingles(words, known)
                    found.append((sig, len(held), prefix(held, counts)))
            sizes = [len(p) for _, _, p in found]
            rest = [np.arange(n, n - len(p), -1) for _, n, p in found]
            none = np.zeros(0, np.int64)
            keys = np.concatenate([none.view(np.uint64), *[p for _, _, p in found]]).view(np.int64)
            columns = [keys, *[np.repeat(np.array([f[k] for f in found], np.int64), sizes) for k in (0, 1)], np.concatenate([none, *rest])]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "sig", "n", "rest"])

    index = texts.mapInArrow(heads, "key long, sig long, n long, rest long")
    of_key = Window.partitionBy("key")
    first = F.min(F.struct((F.col("n") - F.col("rest")).alias("place"), "sig", "n")).over(of_key)
    ends = [F.min("sig").over(of_key).alias("low"), F.max("sig").over(of_key).alias("high")]
    return keep(index.select("*", first.alias("first"), *ends).where("low != high").drop("low", "high"))


def _of_wanted(texts: DataFrame, wanted: DataFrame, make: Callable[[np.ndarray], bytes]) -> DataFrame:
    """(sig, found): what `make` gives of the shingles of each wanted text, once a task. A bit for each remainder of the signatures keeps most others out."""
    bits = np.zeros(MARKS, np.bool_)
    for row in wanted.select(F.pmod("sig", F.lit(MARKS)).cast("int").alias("k")).distinct().toLocalIterator():  # MARKS rows at most
        bits[row["k"]] = True
    marks = np.packbits(bits)

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.unpackbits(marks)
        known: dict[bytes, int] = {}
        seen: set[int] = set()
        for batch in batches:
            sigs, found = [], []
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                words = words_of(text)
                sig = signature(words)
                if held[sig % MARKS] and sig not in seen:
                    seen.add(sig)
                    sigs.append(sig)
                    found.append(make(shingles(words, known)))
            yield pa.RecordBatch.from_arrays([pa.array(sigs, pa.int64()), pa.array(found, pa.binary())], ["sig", "found"])

    return texts.mapInArrow(run, "sig long, found binary")


def _sketched(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows with the sketch of their text, as columns s0, s1, ..."""
    parts = PARITIES // 64
    wanted = rows.select("sig").distinct()
    drawn = _of_wanted(texts, wanted, lambda found: sketch(found).byteswap().tobytes()).join(wanted, "sig", "left_semi").dropDuplicates(["sig"])
    longs = [F.conv(F.hex(F.substring("found", 8 * k + 1, 8)), 16, -10).cast("long").alias(f"s{k}") for k in range(parts)]
    return rows.join(drawn.select("sig", *longs), "sig")


def _verified(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (u, v) that are alike, by their whole sets. A u with many partners meets them in several tasks, MEMBERS in each."""
    times = pairs.groupBy("u").agg(F.ceil(F.count("*") / MEMBERS).alias("tasks"))
    dealt = keep(pairs.join(times, "u").select("u", F.pmod(F.xxhash64("v"), "tasks").alias("task"), "v"))
    members = keep(dealt.select("u", "task", F.col("v").alias("sig")).unionByName(dealt.select("u", "task", F.col("u").alias("sig")).distinct()))

    def compare(table: pa.Table) -> pa.Table:
        u = table.column("u")[0].as_py()
        held = {s: np.frombuffer(f, np.uint64) for s, f in zip(table.column("sig").to_pylist(), table.column("found").to_pylist(), strict=True)}
        good = [s for s, found in held.items() if s != u and alike(held[u], found)]
        return pa.table({"u": pa.array([u] * len(good), pa.int64()), "v": pa.array(good, pa.int64())})

    met = members.join(_of_wanted(texts, members, np.ndarray.tobytes), "sig")
    return keep(met.groupBy("u", "task").applyInArrow(compare, "u long, v long"))


def _to_compare(met: DataFrame, groups: DataFrame) -> DataFrame:
    """(key, sig, n, rest, group, inside): the members that may be alike one of another group; inside are those of the key's largest group."""
    rows = met.join(groups, met["sig"] == groups["node"], "left").select("key", "sig", "n", "rest", F.coalesce("root", "sig").alias("group"))
    sizes = rows.groupBy("key", "group").agg(F.count("*").alias("size"), F.min("n").alias("n"), F.max("rest").alias("rest"))
    held = sizes.groupBy("key").agg(F.max(F.struct("size", "group"))["group"].alias("large"), F.count("*").alias("groups"), F.min("n").alias("least"), F.max("rest").alias("most"))
    share = 9 * F.least("rest", "most")
    able = (share >= 4 * (F.col("n") + F.col("least"))) & (5 * share >= 36 * F.col("n"))  # no partner has fewer than `least`, or 4 in 5 of n
    rows = rows.join(held.where("groups > 1"), "key").where(able)
    rows = keep(rows.select("key", "sig", "n", "rest", "group", (F.col("group") == F.col("large")).alias("inside")).distinct())
    several = rows.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low != high")
    return rows.join(several, "key", "left_semi")


def links(texts: DataFrame) -> DataFrame:
    """(u, v), signatures: enough links of alike texts to connect all that are alike. `texts` has one column, text."""
    met = _met(texts)
    close = may_be_alike(F.col("n"), F.col("first.n"), F.col("rest"), F.col("first.n") - F.col("first.place"))
    star = keep(met.where((F.col("sig") != F.col("first.sig")) & close).select(F.col("first.sig").alias("u"), F.col("sig").alias("v")).distinct())
    joined = _verified(texts, star)
    rows = keep(_sketched(texts, _to_compare(met, components(joined))))
    drawn = [f"s{k}" for k in range(PARITIES // 64)]
    left = rows.where("NOT inside").select("key", F.col("group").alias("g"), F.col("sig").alias("u"), F.col("n").alias("nu"), F.col("rest").alias("ru"), *[F.col(c).alias(f"u{c}") for c in drawn])
    right = rows.select("key", F.col("group").alias("h"), F.col("sig").alias("v"), F.col("n").alias("nv"), F.col("rest").alias("rv"), "inside", *[F.col(c).alias(f"v{c}") for c in drawn])
    apart = sum((F.bit_count(F.col(f"u{c}").bitwiseXOR(F.col(f"v{c}"))) for c in drawn[1:]), F.bit_count(F.col("us0").bitwiseXOR(F.col("vs0"))))
    close = may_be_alike(F.col("nu"), F.col("nv"), F.col("ru"), F.col("rv")) & (9 * apart <= F.col("nu") + F.col("nv"))
    across = left.join(right, "key").where((F.col("g") != F.col("h")) & (F.col("inside") | (F.col("u") < F.col("v"))) & close)
    ends = [F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")]
    across = across.select(*ends).distinct().join(star.select(*ends), ["u", "v"], "left_anti")
    return joined.unionByName(_verified(texts, keep(across)))
