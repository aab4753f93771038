"""Cross-tokenizer alignment by inverted pair bitmaps.

Two tokenizers cut the same bytes; where both end a token, a group ends, and every token of one is
linked to every token of the other in its group. How many documents hold a pair of ids linked comes from
compressed bitmaps, and what each document has of it goes back along the same postings:

1. One pass encodes the texts. A task numbers its documents in containers and writes, for each pair and container,
   bitmaps of the documents: plane k has those whose number of links has bit k set. Sparse
   planes are sorted 16-bit numbers, dense ones bits. Planes of all pairs whose first id falls in a
   bucket lie in one row, so a row of the shuffle is a container and bucket.
2. The planes of a pair are OR-ed; the set bits are its documents, summed over containers (a container
   is one task's, so sums are exact). Planes weigh 2^k in the sum of links.
3. Counts return to the bitmaps by bucket, and the postings add them up for each document; what a document got from
   each bucket is summed by container.

Texts are cut before a space between two visible characters: the first tokenizer's splitter always
cuts there, the second has no piece that goes on over a space. So a stretch between is encoded once for
each task that meets it, as long as the store of stretches has room for it.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludolytics.llm.shared import keep, once

BUCKETS = 64
#: Documents of a container and stretches (distinct in a text) that end it; stretches and links that empty the store.
CONTAINER, ENTRIES, STORE, STORED_LINKS = 8192, 750_000, 180_000, 2_500_000
#: Characters of the texts that are cut and learnt together.
TOGETHER = 2_000_000
#: Pairs that one long stretch is expanded to at once.
SLICE = 4_000_000
#: Containers, about, whose planes of one bucket share a copy of that bucket's counts.
SHARED = 64
_CUT = re.compile(r"(?<=\S) (?=\S)")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")
#: Fixed value: the splitter of byte-level vocabularies that bring none of their own.
SPLITTER = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: itself if visible, else one from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in visible)
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(others)}


class Vocabularies:
    """Both tokenizers, and the bytes, their number and the decimal name of each id.

    The first encodes by its merges; as each merge makes the next id, these are ranks, and the library for ranks does it faster.
    """

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        import tiktoken

        with open(path_a, encoding="utf-8") as file:
            split = json.load(file)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        if split["normalizer"] or split["pre_tokenizer"] != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}:
            raise ValueError(f"{path_a}: the first tokenizer must be byte-level, with its own splitter and no normaliser")
        entries, merges = split["model"]["vocab"], [m if isinstance(m, list) else m.split(" ") for m in split["model"]["merges"]]
        if any(entries[a + b] != 256 + k for k, (a, b) in enumerate(merges)) or split["model"].get("ignore_merges"):
            raise ValueError(f"{path_a}: the merges must make the ids in their order")
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces) or [self.b.id_to_piece(i) for i in self.b.encode("a")][:1] > ["▁a"]:
            raise ValueError(f"{path_b}: the second tokenizer must add a space and have no piece that goes on over one")
        alphabet = byte_alphabet()
        ranks = {bytes(alphabet[c] for c in token): i for token, i in entries.items()}
        self.a = tiktoken.Encoding("ranks", pat_str=SPLITTER, mergeable_ranks=ranks, special_tokens={})
        bytes_a = [token for token, _ in sorted(ranks.items(), key=lambda x: x[1])]
        bytes_b = [bytes([int(m[1], 16)]) if (m := _BYTE.fullmatch(p)) else p.replace("▁", " ").encode() for p in pieces]
        self.bytes_a, self.bytes_b = bytes_a, bytes_b
        self.size_a, self.size_b = (np.array([len(x) for x in found], np.int64) for found in (bytes_a, bytes_b))
        self.names = [str(i) for i in range(max(len(bytes_a), len(bytes_b)))]

    def encode(self, stretches: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """The ids of each stretch, whose leading space the second tokenizer adds by itself."""
        return [self.a.encode_ordinary(" " + s) for s in stretches], self.b.encode(stretches, num_threads=1)


def _counted(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, ascending, and how often each occurs (or its sum of weights)."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    if weights is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, weights = keys[order], weights[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sums = np.diff(np.r_[starts, len(keys)]) if weights is None else np.add.reduceat(weights, starts)
    return keys[starts], sums


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (sizes[0] of them), then those of starts[1], and so on."""
    shift = np.repeat(starts - np.r_[0, np.cumsum(sizes)[:-1]], sizes)
    return np.arange(len(shift)) + shift


def pair_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.astype(np.int64) << 32 | b


def _links(owner: np.ndarray, group_a: np.ndarray, a: np.ndarray, group_b: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner of the group, pair, links) of tokens with their groups; each owner and pair once.

    A group counts each of its ids once and multiplies, so a long run of one token is one row. Its product is
    made in slices of the owner's rows by first id: no slice is much above SLICE, and a pair never spans two.
    """
    ka, ca = _counted(group_a << 32 | a)
    kb, cb = _counted(group_b << 32 | b)
    ga, gb = ka >> 32, kb >> 32
    low, high = np.searchsorted(gb, ga), np.searchsorted(gb, ga, side="right")
    ids, sizes = ka & 0xFFFFFFFF, high - low
    order = np.lexsort((ids, owner[ga]))
    ga, ids, ca, low, sizes = ga[order], ids[order], ca[order], low[order], sizes[order]
    own = owner[ga]
    grown = np.cumsum(sizes)
    turns = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (ids[1:] != ids[:-1])]) if len(ga) else np.zeros(0, np.int64)
    cuts, start = [0], 0
    while start < len(ga):
        end = int(np.searchsorted(grown, (grown[start - 1] if start else 0) + SLICE, side="right"))
        at = int(np.searchsorted(turns, max(end, start + 1), side="left"))
        start = int(turns[at]) if at < len(turns) else len(ga)
        cuts.append(start)
    found = []
    for i, j in zip(cuts, cuts[1:]):
        at = _ranges(low[i:j], sizes[i:j])
        pair = pair_of(np.repeat(ids[i:j], sizes[i:j]), kb[at] & 0xFFFFFFFF)
        holder, links = np.repeat(own[i:j], sizes[i:j]), np.repeat(ca[i:j], sizes[i:j]) * cb[at]
        order = np.lexsort((pair, holder))
        pair, holder, links = pair[order], holder[order], links[order]
        first = np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]) | (holder[1:] != holder[:-1])]) if len(pair) else np.zeros(0, np.int64)
        found.append((holder[first], pair[first], np.add.reduceat(links, first) if len(first) else links))
    return tuple(np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(3))


class Stretches:
    """What is known of each stretch met so far: its numbers, its groups as text, and its links by pair."""

    def __init__(self, vocabularies: Vocabularies):
        self.vocabularies = vocabularies
        self.empty()

    def empty(self) -> None:
        self.places: dict[str, int] = {}
        self.groups: list[str | None] = []  # None where a tokenizer does not give the stretch's bytes back
        self._numbers, self._sizes, self._pairs, self._links = [], [], [], []
        self.links = 0

    def full(self) -> bool:
        return len(self.groups) > STORE or self.links > STORED_LINKS

    def learn(self, stretches: list[str]) -> None:
        ids_a, ids_b = self.vocabularies.encode(stretches)
        v, count = self.vocabularies, len(stretches)
        for k, s in enumerate(stretches):
            self.places[s] = len(self.groups) + k
        raw = [(" " + s).encode() for s in stretches]
        good = [b"".join(map(v.bytes_a.__getitem__, x)) == r and b"".join(map(v.bytes_b.__getitem__, y)) == r for x, y, r in zip(ids_a, ids_b, raw, strict=True)]
        a = np.fromiter((i for x, ok in zip(ids_a, good) if ok for i in x), np.int64)
        b = np.fromiter((i for y, ok in zip(ids_b, good) if ok for i in y), np.int64)
        n_a = np.array([len(x) if ok else 0 for x, ok in zip(ids_a, good)], np.int64)
        n_b = np.array([len(y) if ok else 0 for y, ok in zip(ids_b, good)], np.int64)
        ends_a, ends_b = np.cumsum(v.size_a[a]), np.cumsum(v.size_b[b])
        ends = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(ends, ends_a), np.searchsorted(ends, ends_b)
        owner = np.zeros(len(ends), np.int64)
        owner[group_a] = np.repeat(np.arange(count), n_a)
        holder, pairs, links = _links(owner, group_a, a, group_b, b)
        sizes = np.bincount(holder, minlength=count)
        n_groups = np.bincount(owner, minlength=count)
        n_links = np.zeros(count, np.int64)
        np.add.at(n_links, holder, links)
        names_a, names_b = list(map(v.names.__getitem__, a.tolist())), list(map(v.names.__getitem__, b.tolist()))
        to_a, to_b = (np.cumsum(np.bincount(g, minlength=len(ends))).tolist() for g in (group_a, group_b))
        texts, i, j = [], 0, 0
        for p, q in zip(to_a, to_b, strict=True):
            texts.append(f"{names_a[i]}|{names_b[j]}" if p == i + 1 and q == j + 1 else f"{','.join(names_a[i:p])}|{','.join(names_b[j:q])}")
            i, j = p, q
        at = 0
        for k, n in enumerate(n_groups.tolist()):
            self.groups.append(";".join(texts[at : at + n]) if good[k] else None)
            at += n
        self._numbers.append(np.stack([n_a, n_b, n_groups, n_links], axis=1))
        self._sizes.append(sizes)
        self._pairs.append(pairs)
        self._links.append(links)
        self.links += len(pairs)

    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The four numbers of each stretch; where its pairs begin and how many they are; all pairs and their links."""
        joined = [np.concatenate(x) if x else np.zeros((0, 4) if k == 0 else 0, np.int64) for k, x in enumerate((self._numbers, self._sizes, self._pairs, self._links))]
        self._numbers, self._sizes, self._pairs, self._links = ([x] for x in joined)
        sizes = joined[1]
        return joined[0], np.cumsum(sizes) - sizes, sizes, joined[2], joined[3]


# ---- bitmaps -------------------------------------------------------------------------


def pack(pairs: np.ndarray, docs: np.ndarray, links: np.ndarray, width: int) -> dict[str, np.ndarray]:
    """The planes of postings sorted by pair and document: `pairs`, `planes`, `sizes` (set bits) of each, and `bits`."""
    found = []
    for k in range(int(links.max(initial=0)).bit_length()):
        on = np.flatnonzero(links >> k & 1)
        found.append((pairs[on], np.full(len(on), k, np.uint8), docs[on]))
    pair, plane, doc = (np.concatenate([f[i] for f in found]) for i in range(3))
    order = np.lexsort((plane, pair)) if len(found) > 1 else slice(None)  # documents keep their order
    pair, plane, doc = pair[order], plane[order], doc[order].astype(np.uint16)
    starts = np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]) | (plane[1:] != plane[:-1])])
    sizes = np.diff(np.r_[starts, len(pair)])
    dense = 16 * sizes > width
    holder = np.repeat(np.arange(len(starts)), sizes)
    of_dense = dense[holder]
    matrix = np.zeros((int(dense.sum()), -(-width // 8) * 8), np.uint8)
    matrix[(np.cumsum(dense) - 1)[holder[of_dense]], doc[of_dense]] = 1
    return {"pairs": pair[starts], "planes": plane[starts], "sizes": sizes.astype(np.int32), "sparse": doc[~of_dense], "dense": np.packbits(matrix, axis=1)}


def unpack(pairs: np.ndarray, planes: np.ndarray, sizes: np.ndarray, sparse: np.ndarray, dense: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(plane's place, document) of all set bits."""
    is_dense = 16 * sizes.astype(np.int64) > width
    at = np.repeat(np.flatnonzero(~is_dense), sizes[~is_dense])
    row, doc = np.nonzero(np.unpackbits(dense.reshape(-1, -(-width // 8)), axis=1)) if len(dense) else (np.zeros(0, np.int64),) * 2
    return np.r_[at, np.flatnonzero(is_dense)[row]], np.r_[sparse.astype(np.int64), doc]


PLANES = "pairs binary, planes binary, sizes binary, sparse binary, dense binary"
BASE = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
WRITTEN = f"container long, width int, bucket int, {PLANES}, docs array<struct<{BASE.replace(' long', ':bigint').replace(' string', ':string')}>>"
_TYPES = {"pairs": np.int64, "planes": np.uint8, "sizes": np.int32, "sparse": np.uint16, "dense": np.uint8}
_DOC = pa.struct([("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")], ("groups_sha256", pa.string())])


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = [("container", pa.int64()), ("width", pa.int32()), ("bucket", pa.int32()), *[(c, pa.binary()) for c in _TYPES], ("docs", pa.list_(_DOC))]
    return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], kind) for c, kind in kinds], [c for c, _ in kinds])


def containers(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Rows of planes (bucket from 0), and a row (bucket -1) of the documents of each container."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = once(("stretches", path_a, path_b), lambda: Stretches(Vocabularies(path_a, path_b)))
        first, number = TaskContext.get().partitionId() << 24, 0
        base: list[dict] = []
        held: list[np.ndarray] = []  # for each document, the places of its stretches, each once
        often: list[np.ndarray] = []

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal number
            container, width = first + number, len(base)
            _, starts, sizes, pairs, links = store.table()
            if held:
                doc = np.repeat(np.arange(width), [len(h) for h in held])
                place, times = np.concatenate(held), np.concatenate(often)
                at = _ranges(starts[place], sizes[place])
                doc, times = np.repeat(doc, sizes[place]), np.repeat(times, sizes[place])
                pair, place_of = np.unique(pairs, return_inverse=True)
                keys, total = _counted(place_of[at] << 16 | doc, times * links[at])
                pair, doc = pair[keys >> 16], keys & 0xFFFF
                bucket = (pair >> 32) % BUCKETS
                for k in np.unique(bucket).tolist():
                    on = bucket == k
                    planes = pack(pair[on], doc[on], total[on], width)
                    yield _batch([{"container": container, "width": width, "bucket": k, **{c: x.tobytes() for c, x in planes.items()}}])
            yield _batch([{"container": container, "width": width, "bucket": -1, "docs": list(base)}])
            number += 1
            base.clear(), held.clear(), often.clear()

        def take(ids: list, texts: list) -> int:
            cut = [_CUT.split(text) if text else [] for text in texts]
            new = [s for s in dict.fromkeys(s for stretches in cut for s in stretches) if s not in store.places]
            for k in range(0, len(new), 20_000):
                store.learn(new[k : k + 20_000])
            numbers, taken = store.table()[0], 0
            for doc_id, stretches in zip(ids, cut, strict=True):
                places = list(map(store.places.__getitem__, stretches))
                groups = list(map(store.groups.__getitem__, places))
                row = {"doc_id": doc_id, "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": ""}
                each, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
                if places and None not in groups:
                    each, times = np.unique(np.array(places, np.int64), return_counts=True)
                    row |= dict(zip(("n_a", "n_b", "n_groups", "n_links"), (times @ numbers[each]).tolist(), strict=True))
                    row["groups_sha256"] = hashlib.sha256(";".join(groups).encode()).hexdigest()
                base.append(row), held.append(each), often.append(times)
                taken += len(each)
            return taken

        entries = 0
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            start = 0
            while start < len(ids):
                end, size = start, 0
                while end < len(ids) and (end == start or size + len(texts[end] or "") <= TOGETHER) and end - start < CONTAINER - len(base):
                    size, end = size + len(texts[end] or ""), end + 1
                entries += take(ids[start:end], texts[start:end])
                start = end
                if len(base) >= CONTAINER or entries >= ENTRIES:
                    yield from close()
                    entries = 0
                    if store.full():
                        store.empty()
        if base:
            yield from close()
        store.empty()  # an idle worker holds nothing

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, WRITTEN)


def _planes(batch: pa.RecordBatch, k: int) -> dict[str, np.ndarray]:
    return {c: np.frombuffer(batch.column(c)[k].as_py(), kind) for c, kind in _TYPES.items()}


def pair_counts(planes: DataFrame) -> DataFrame:
    """(a, b, docs, links) of each pair: its documents and links, over all containers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, width in enumerate(batch.column("width").to_pylist()):
                x = _planes(batch, k)
                pairs, at = np.unique(x["pairs"], return_inverse=True)
                weights = x["sizes"].astype(np.int64) << x["planes"]
                links = np.zeros(len(pairs), np.int64)
                np.add.at(links, at, weights)
                docs = np.zeros(len(pairs), np.int64)
                alone = np.bincount(at, minlength=len(pairs))[at] == 1  # one plane: its bits are the documents
                docs[at[alone]] = x["sizes"][alone]
                plane, doc = unpack(**x, width=width)
                several = ~alone[plane]
                joined, _ = _counted(at[plane[several]] << 16 | doc[several])  # the OR of a pair's planes
                docs += np.bincount(joined >> 16, minlength=len(pairs))
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in ((pairs >> 32).astype(np.int32), (pairs & 0xFFFFFFFF).astype(np.int32), docs, links)], ["a", "b", "docs", "links"])

    found = planes.select("width", *_TYPES).mapInArrow(run, "a int, b int, docs long, links long")
    return found.groupBy("a", "b").agg(F.sum("docs").alias("docs"), F.sum("links").alias("links"))


def _returned(planes: DataFrame, counts: DataFrame, shares: int) -> DataFrame:
    """(container, best, total): for the documents of each container, what one bucket adds to their scores.

    Counts travel as a row of arrays for each bucket, of which each of the `shares` of containers gets a copy.
    """
    best = counts.groupBy("a").agg(F.max("docs").alias("most"))
    rows = counts.join(best, "a").select((F.col("a") % BUCKETS).alias("bucket"), "a", "b", "docs", (F.col("docs") == F.col("most")).alias("is_best"))

    def sorted_arrays(table: pa.Table) -> pa.Table:
        a, b, docs, is_best = (table.column(c).to_numpy() for c in ("a", "b", "docs", "is_best"))
        pair = pair_of(a, b)
        order = np.argsort(pair)
        packed = [pair[order].tobytes(), docs[order].tobytes(), is_best[order].astype(np.uint8).tobytes()]
        return pa.table({"bucket": table.column("bucket")[:1], **{c: pa.array([x], pa.binary()) for c, x in zip(("known", "docs", "is_best"), packed, strict=True)}})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k, (container, width) in enumerate(zip(batch.column("container").to_pylist(), batch.column("width").to_pylist(), strict=True)):
                x = _planes(batch, k)
                known, docs, is_best = (np.frombuffer(batch.column(c)[k].as_py(), kind) for c, kind in (("known", np.int64), ("docs", np.int64), ("is_best", np.uint8)))
                at = np.searchsorted(known, x["pairs"])
                plane, doc = unpack(**x, width=width)
                weight = np.int64(1) << x["planes"].astype(np.int64)
                best, total = np.zeros(width, np.int64), np.zeros(width, np.int64)
                np.add.at(best, doc, (weight * is_best[at])[plane])
                np.add.at(total, doc, (weight * docs[at])[plane])
                out.append((container, best.tobytes(), total.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), *[pa.array([r[k] for r in out], pa.binary()) for k in (1, 2)]], ["container", "best", "total"])

    held = rows.groupBy("bucket").applyInArrow(sorted_arrays, "bucket int, known binary, docs binary, is_best binary")
    copies = held.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    keyed = planes.withColumn("share", F.pmod(F.xxhash64("container"), F.lit(shares)).cast("int"))
    return keyed.join(copies, ["bucket", "share"]).drop("bucket", "share").mapInArrow(run, "container long, best binary, total binary")


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each row.

    A is the byte-level tokenizer of `path_a` on a space and the text, B the pieces of `path_b`, which adds that space.
    Texts null, empty, or that one of the two does not give back have zeros and an empty digest, and count nowhere.
    n_best has the links whose pair has the most documents among the pairs of its A id (ties included), count_sum the
    documents of the pair, over all links. Repeated rows count as documents each and
    come back each; a null doc_id stays null; an empty table gives no rows. Other columns are neither
    read nor returned. Very long texts are whole: a stretch without spaces is one stretch, its groups counted by distinct ids.
    """
    rows = keep(containers(docs, path_a, path_b))
    planes = rows.where("bucket >= 0").select("container", "width", "bucket", *_TYPES)
    base = rows.where("bucket < 0").select("container", "docs")
    scores = _returned(planes, keep(pair_counts(planes)), base.count() // SHARED + 1)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({c: pa.array([], k) for c, k in OUT})
        found = left.column("docs")[0].as_py()
        sums = {c: sum((np.frombuffer(x, np.int64) for x in right.column(c).to_pylist()), np.zeros(len(found), np.int64)) for c in ("best", "total")}
        columns = {c: [row[c] for row in found] for c in _DOC_NAMES} | {"n_best": sums["best"], "count_sum": sums["total"]}
        return pa.table({c: pa.array(columns[c], kind) for c, kind in OUT})

    return base.groupBy("container").cogroup(scores.groupBy("container")).applyInArrow(run, ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'long'}" for c, _ in OUT))


_DOC_NAMES = [_DOC.field(k).name for k in range(_DOC.num_fields)]
OUT = [(c, pa.string() if c == "groups_sha256" else pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")]
