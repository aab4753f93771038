"""Document fingerprints from Lempel-Ziv phrases.

A text is read from left to right into the shortest phrases not met before; the set of
phrases stands for the text. Its signature is the `size` least 32-bit hashes of them, and
the likeness of two texts is the share of common hashes among the `size` least of both:
an estimate of the phrase sets' Jaccard index, near 1 for texts that compress together.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIZE = 128
PLACE = [("key", "<i8"), ("hash", "<i8")]
hash_of = partial(xxhash.xxh32_intdigest, seed=0)


def phrases(text: str, known: set[str], phrase: str = "") -> tuple[list[str], str]:
    """The new phrases of a text, in order, and the unfinished one at its end. `known` grows by them."""
    found = []
    for char in text:
        phrase += char
        if phrase not in known:
            known.add(phrase)
            found.append(phrase)
            phrase = ""
    return found, phrase


def hashes(found: list[str]) -> np.ndarray:
    return np.fromiter(map(hash_of, found), np.uint32, len(found))


def least(values: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The signature: the least distinct values, ascending."""
    return np.unique(values)[:size]


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """0 to 1; two empty signatures are alike, an empty and another are not."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.union1d(a, b)[:size]
    common = np.intersect1d(a, b, assume_unique=True)
    return float(np.searchsorted(common, both[-1], side="right") / len(both))


def as_text(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def signature_of(text: str, size: int = SIZE) -> np.ndarray:
    return least(hashes(phrases(text, set())[0]), size)


class Pair:
    """Signatures of a text and of an edit that keeps its first `cut` characters; the common part is read once."""

    def __init__(self, text: str, cut: int, tail: str, size: int = SIZE) -> None:
        known: set[str] = set()
        start, open_phrase = phrases(text[:cut], known)
        first = hashes(start)
        edited_known = set(start)
        rest, _ = phrases(text[cut:], known, open_phrase)
        other, _ = phrases(tail, edited_known, open_phrase)
        self.own = least(np.concatenate([first, hashes(rest)]), size)
        self.edited = least(np.concatenate([first, hashes(other)]), size)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """doc_id, fingerprint (8 hex digits a hash, ascending), a row for each row.

    Equal texts have equal fingerprints. A null text is an empty one, with the empty
    fingerprint; an empty table gives no rows; other columns are neither read nor returned.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [as_text(signature_of(text or "", size)) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["doc_id", "fingerprint"])

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(run, "doc_id long, fingerprint string")


# ---- each document beside its successor -----------------------------------------


#: Stands for a null id, so that it comes before all others.
NULL_ID = -(2**63)


def cut_places(keys: DataFrame, rows: int, most: int) -> list[tuple[int, int]]:
    """(id, hash) at which parts of about `rows` rows begin; at most `most` of them, so that the driver holds no more.

    An id that takes up several parts is met by as many quantiles; its parts are equal
    ranges of the hash of the text.
    """
    parts = min(most, -(-keys.count() // rows))
    if parts < 2:
        return []
    cuts = keys.select(F.col("key").cast("double")).approxQuantile("key", [k / parts for k in range(1, parts)], 1 / (4 * parts))
    return [(key, -(2**63) + k * (2**64 // n)) for key, n in sorted(Counter(map(int, cuts)).items()) for k in range(n)]


def numbered(values: tuple[pd.Series, pd.Series], bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many bounds are below, and how many are not above, each (id, hash)."""
    found = np.empty(len(values[0]), PLACE)
    found["key"], found["hash"] = values[0].to_numpy(), values[1].to_numpy()
    return np.searchsorted(bounds, found, "left"), np.searchsorted(bounds, found, "right")


def beside_next(docs: DataFrame, id_col: str, text_col: str, rows: int = 500, most: int = 20_000) -> DataFrame:
    """Rows (part, late, doc_id, text), sorted, in which each row's successor stands next in its part.

    The order is by id, null first, then by the hash of the text, then by the text, so that
    an id (or null) with very many rows spreads over parts as well; only rows alike in both
    stay together. The first row of a part stands at the end of the part before as well, with
    late = 1, and the first of all at the end of the last, with late = 2. So each text is
    shuffled once, but for one in `rows`. Where parts begin is found from ids and hashes.
    """
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    chosen = chosen.select("doc_id", "text", F.coalesce("doc_id", F.lit(NULL_ID)).alias("key"), F.xxhash64("text").alias("hash"))
    cuts = np.array(cut_places(chosen.select("key"), rows, most), PLACE)

    @F.pandas_udf("int")
    def draft(key: pd.Series, hashed: pd.Series) -> pd.Series:
        return pd.Series(numbered((key, hashed), cuts)[1])

    first = chosen.select("key", "hash").withColumn("part", draft("key", "hash") if len(cuts) else F.lit(0)).groupBy("part").agg(F.min(F.struct("key", "hash")).alias("first"))
    firsts = np.array(sorted((row["first"]["key"], row["first"]["hash"]) for row in first.collect()), PLACE)  # at most `most` and one

    @F.pandas_udf("int")
    def place(key: pd.Series, hashed: pd.Series) -> pd.Series:
        """Twice the number of the part, plus one for what stands first in it."""
        left, right = numbered((key, hashed), firsts)
        return pd.Series(2 * (right - 1) + (left != right))

    def at(part, late: int):
        return F.struct(part.cast("int").alias("part"), F.lit(late).alias("late"))

    part = F.shiftright("place", 1)
    copies = F.array(at(part, 0), F.when(F.col("place") % 2 == 1, F.when(part > 0, at(part - 1, 1)).otherwise(at(F.lit(max(len(firsts) - 1, 0)), 2))))
    placed = chosen.withColumn("place", place("key", "hash"))
    spread = placed.select(F.explode(F.array_compact(copies)).alias("at"), "doc_id", "hash", "text").select("at.part", "at.late", "doc_id", "hash", "text")
    return spread.repartition("part").sortWithinPartitions("part", "late", F.asc_nulls_first("doc_id"), "hash", "text").drop("hash")


def compare_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """Each document's fingerprint beside those of its edited text and of the next document.

    Columns: doc_id, n_chars (code points), edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next; a row for each row. The edited text ends in the beginning of the
    next document instead of its own last quarter. Order is by doc_id, null first, then by
    the text's hash and the text; the last is followed by the first, a lone document by itself. A null text is an
    empty one; an empty table gives no rows; other columns are neither read nor returned.
    A task holds two texts and one batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, waiting, out = None, None, []
        for batch in batches:
            for part, late, doc_id, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if before and before[0] == part and not before[1]:
                    own = before[3]
                    quarter = len(own) // 4
                    edited = own[: len(own) - quarter] + text[:quarter]
                    pair = Pair(own, len(own) - quarter, text[:quarter], size)
                    if waiting:
                        out.append((*waiting[0], likeness(waiting[1], pair.own, size)))
                    row = (before[2], len(own), hashlib.sha256(edited.encode()).hexdigest(), as_text(pair.own), as_text(pair.edited), likeness(pair.own, pair.edited, size))
                    waiting = (row, pair.own)
                    if late:
                        out.append((*row, likeness(pair.own, signature_of(text, size), size)))
                        waiting = None
                before = (part, late, doc_id, text)
            if out:
                yield _batch(out)
                out = []

    sorted_rows = beside_next(docs, id_col, text_col)
    return sorted_rows.mapInArrow(run, ", ".join(f"{name} {kind}" for name, kind, _ in OUT))


OUT = [
    ("doc_id", "long", pa.int64()),
    ("n_chars", "long", pa.int64()),
    ("edited_sha256", "string", pa.string()),
    ("fingerprint", "string", pa.string()),
    ("edited_fingerprint", "string", pa.string()),
    ("near_edited", "double", pa.float64()),
    ("near_next", "double", pa.float64()),
]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, (_, _, kind) in zip(columns, OUT, strict=True)], [name for name, _, _ in OUT])
