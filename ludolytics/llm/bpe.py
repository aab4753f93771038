"""Byte-level BPE as a lazily determinised transducer, and streaming decoding.

Merging by rank has a local test: a token sequence is the encoding of its bytes if and
only if every two neighbours, joined and merged alone, stay those two tokens. So the
encoder needs no merge queue. Its nondeterministic machine reads one byte at a time; a
configuration is the place in the token trie of the token that is being read, and the
token before it. Completing a token is allowed if it may follow the one before. The
deterministic machine's states are sets of configurations with the tokens each still owes;
what all of them owe in common is emitted. Only as many bytes are looked ahead as the
longest token has. States and transitions are made when they are first needed.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import islice

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludolytics.llm.shared import giving_back, once, pieces

#: Marks a configuration at the start of a text, where no token stands before.
START = -1


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ids from a file of lines `base64 id`."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


def merge(ranks: dict[bytes, int], data: bytes) -> tuple[int, ...]:
    """Merges the pair of least rank, leftmost first, until no pair has a rank. For short inputs."""
    none = 1 << 60
    parts = [data[k : k + 1] for k in range(len(data))]
    costs = [ranks.get(data[k : k + 2], none) for k in range(len(data) - 1)]
    while costs and (least := min(costs)) < none:
        at = costs.index(least)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del costs[at]
        if at < len(costs):
            costs[at] = ranks.get(parts[at] + parts[at + 1], none)
        if at:
            costs[at - 1] = ranks.get(parts[at - 1] + parts[at], none)
    return tuple(ranks[part] for part in parts)


class Transducer:
    """Encodes bytes that are no further split, in time proportional to their length.

    `max_states` bounds the memory: a full table is emptied and built up again.
    """

    def __init__(self, ranks: dict[bytes, int], max_states: int = 250_000) -> None:
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.max_states = max_states
        self._children: list[dict[int, int]] = [{}]
        self._ends: list[int] = [-1]
        for token, rank in ranks.items():
            if merge(ranks, token) == (rank,) if len(token) <= 32 else True:
                self._add(token, rank)
        self._pairs: dict[tuple[int, int], bool] = {}
        self._clear()

    def _add(self, token: bytes, rank: int) -> None:
        node = 0
        for byte in token:
            found = self._children[node].get(byte)
            if found is None:
                found = self._children[node][byte] = len(self._children)
                self._children.append({})
                self._ends.append(-1)
            node = found
        self._ends[node] = rank

    def _clear(self) -> None:
        self._states: list[tuple] = [((0, START, ()),)]
        self._numbers = {self._states[0]: 0}
        self._moves: dict[int, tuple[int, tuple[int, ...]]] = {}

    def release(self) -> None:
        """Forgets all states and pairs; they are built up again when needed."""
        self._pairs.clear()
        self._clear()

    def _may_follow(self, left: int, right: int) -> bool:
        if left == START:
            return True
        key = (left, right)
        found = self._pairs.get(key)
        if found is None:
            if len(self._pairs) > 4 * self.max_states:
                self._pairs.clear()
            found = self._pairs[key] = merge(self.ranks, self.token[left] + self.token[right]) == key
        return found

    def _move(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """The next state, and the tokens that are certain after this byte."""
        after, done = [], None
        for node, last, owed in self._states[state]:
            child = self._children[node].get(byte)
            if child is None:
                continue
            token = self._ends[child]
            if done is None and token >= 0 and self._may_follow(last, token):
                done = (0, token, (*owed, token))
            if self._children[child]:
                after.append((child, last, owed))
        if done is None:
            raise ValueError("the vocabulary lacks a single byte")
        after.append(done)
        common = 0
        first = after[0][2]
        while common < len(first) and all(len(c[2]) > common and c[2][common] == first[common] for c in after):
            common += 1
        configurations = tuple((node, last, owed[common:]) for node, last, owed in after)
        number = self._numbers.get(configurations)
        if number is None:
            number = self._numbers[configurations] = len(self._states)
            self._states.append(configurations)
        move = self._moves[state << 8 | byte] = (number, first[:common])
        return move

    def stream(self, blocks: Iterable[bytes]) -> Iterator[tuple[int, ...]]:
        """The tokens of the joined blocks, as soon as each is certain."""
        state, moves = 0, self._moves
        for block in blocks:
            for byte in block:
                move = moves.get(state << 8 | byte) or self._move(state, byte)
                state = move[0]
                if move[1]:
                    yield move[1]
            if len(self._states) > self.max_states:
                here = self._states[state]
                self._clear()
                moves = self._moves
                state = self._numbers.setdefault(here, len(self._states))
                if state == len(self._states):
                    self._states.append(here)
        if state:
            yield self._rest(state)

    def encode(self, data: bytes) -> tuple[int, ...]:
        if len(data) > 4096:
            return tuple(token for tokens in self.stream(data[k : k + 4096] for k in range(0, len(data), 4096)) for token in tokens)
        if len(self._states) > self.max_states:
            self._clear()
        state, moves, out = 0, self._moves, ()
        for byte in data:
            move = moves.get(state << 8 | byte) or self._move(state, byte)
            state = move[0]
            out += move[1]
        return out + self._rest(state)

    def _rest(self, state: int) -> tuple[int, ...]:
        """What is owed where the input ends: the configuration that has just completed a token."""
        return next(owed for node, _, owed in self._states[state] if node == 0)


def ascii_pattern(pattern: str) -> str:
    """The pattern as far as ASCII goes: its letter and number classes there, in and out of brackets."""
    out, inside = "", False
    for piece in re.findall(r"\\p\{\w+\}|\\.|.", pattern, re.DOTALL):
        if piece in (r"\p{L}", r"\p{N}"):
            plain = "A-Za-z" if piece == r"\p{L}" else "0-9"
            out += plain if inside else f"[{plain}]"
            continue
        inside = piece == "[" or inside and piece != "]"
        out += piece
    if "\\p" in out:
        raise ValueError("only the classes L and N are known")
    return out


class Encoder:
    """Splits texts by a pattern and encodes each match. Ids are packed little-endian, 32 bits each.

    Frequent matches are remembered, up to `max_words`; the memory is emptied when full.
    Plain ASCII texts are split by the same pattern with its classes written out for ASCII.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, max_words: int = 500_000) -> None:
        self.machine = Transducer(ranks)
        self.find = regex.compile(pattern).findall
        self.find_ascii = re.compile(ascii_pattern(pattern), re.ASCII).findall
        self.max_words = max_words
        self._words: dict[str, bytes] = {}

    def __call__(self, text: str) -> bytes:
        matches = self.find_ascii(text) if text.isascii() else self.find(text)
        words = self._words
        for word in set(matches).difference(words):
            words[word] = array("I", self.machine.encode(word.encode())).tobytes()
        packed = b"".join(map(words.__getitem__, matches))
        if len(words) > self.max_words:
            words.clear()
        return packed

    def release(self) -> None:
        """Forgets what texts have taught it, so that a worker between tasks holds the vocabulary alone."""
        self._words.clear()
        self.machine.release()


#: The UTF-8 state machine: from each state, the state after a byte range. State 0 is
#: between characters, 1 to 3 wait for that many plain continuation bytes, the others for
#: a first continuation byte of a smaller range. Fixed values of the encoding.
UTF8_MOVES = {
    0: [(0x00, 0x7F, 0), (0xC2, 0xDF, 1), (0xE0, 0xE0, 4), (0xE1, 0xEC, 2), (0xED, 0xED, 5), (0xEE, 0xEF, 2), (0xF0, 0xF0, 6), (0xF1, 0xF3, 3), (0xF4, 0xF4, 7)],
    1: [(0x80, 0xBF, 0)],
    2: [(0x80, 0xBF, 1)],
    3: [(0x80, 0xBF, 2)],
    4: [(0xA0, 0xBF, 1)],
    5: [(0x80, 0x9F, 1)],
    6: [(0x90, 0xBF, 2)],
    7: [(0x80, 0x8F, 2)],
}


class Utf8Stream:
    """Takes bytes in any pieces; gives text as far as its characters are whole."""

    moves = {state << 8 | byte: to for state, ranges in UTF8_MOVES.items() for low, high, to in ranges for byte in range(low, high + 1)}

    def __init__(self) -> None:
        self.state, self.open = 0, b""

    def feed(self, piece: bytes) -> str:
        """Steps over the first bytes while a character is open, and over the last three; whole characters lie between."""
        start = 0
        while self.state and start < len(piece):
            self._step(piece[start])
            start += 1
        if self.state:
            self.open += piece
            return ""
        head, self.open = self.open + piece[:start], b""
        cut = len(piece)
        while cut > max(start, len(piece) - 3) and piece[cut - 1] & 0xC0 == 0x80:
            cut -= 1
        if cut > start and piece[cut - 1] >= 0xC0:
            cut -= 1
        tail = piece[cut:]
        for byte in tail:
            self._step(byte)
        if self.state:
            self.open = tail
            return (head + piece[start:cut]).decode()
        return (head + piece[start:]).decode()

    def _step(self, byte: int) -> None:
        to = self.moves.get(self.state << 8 | byte)
        if to is None:
            raise ValueError("not UTF-8")
        self.state = to

    def close(self) -> None:
        if self.state:
            raise ValueError("the text ends inside a character")


def decode_stream(ids: Iterable[int], token: dict[int, bytes], block: int = 1 << 16) -> Iterator[str]:
    """Text pieces of an id stream; no more than a block of ids is held. Unknown ids raise KeyError."""
    machine, rest = Utf8Stream(), iter(ids)
    while held := b"".join(map(token.__getitem__, islice(rest, block))):
        yield machine.feed(held)
    machine.close()


# ---- on tables -----------------------------------------------------------------

Batches = Iterator[pa.RecordBatch]


def encoder_for(vocabulary: str, pattern: str) -> Encoder:
    return once(("bpe", vocabulary, pattern), lambda: Encoder(read_ranks(vocabulary), pattern))


def encode_batches(batches: Batches, encoder: Encoder) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The batches in pieces, each with the packed tokens of its second column; what the encoder remembers is given back at the end of the task."""
    try:
        for batch in pieces(batches):
            yield batch, [encoder(text or "") for text in batch.column(1).to_pylist()]
    finally:
        encoder.release()


def _id_lists(packed: list[bytes]) -> pa.Array:
    offsets = [0]
    for ids in packed:
        offsets.append(offsets[-1] + len(ids) // 4)
    values = pa.Array.from_buffers(pa.int32(), offsets[-1], [None, pa.py_buffer(b"".join(packed))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def encode(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int): the encoding of each whole text, a row for each row.

    A null text is an empty one and has no ids; a null doc_id stays null; an empty table
    gives no rows; other columns are neither read nor returned.
    """

    def run(batches: Batches) -> Batches:
        encoder = encoder_for(vocabulary, pattern)
        for batch, packed in encode_batches(batches, encoder):
            yield pa.RecordBatch.from_arrays([batch.column(0), _id_lists(packed)], ["doc_id", "ids"])

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, text: what the ids stand for. Null ids give an empty text; ids that aren't in the vocabulary, or whose bytes are no UTF-8 text, raise."""

    def run(batches: Batches) -> Batches:
        token = {rank: data for data, rank in read_ranks(vocabulary).items()}
        for batch in batches:
            texts = ["".join(decode_stream(ids or (), token)) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    chosen = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids"))
    return chosen.mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes and decodes in one pass, and keeps only the digests.

    The ids of a document never leave the task. Nulls, ties, empty tables: as for `encode`.
    Columns named in `carry` are returned as they are, after these four.
    """
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *carry)
    kinds = ["doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", *(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[2:])]

    @giving_back
    def run(batches: Batches) -> Batches:
        encoder = encoder_for(vocabulary, pattern)
        token = encoder.machine.token
        for batch, texts in encode_batches(batches, encoder):
            decoded = []
            for data in texts:
                digest = hashlib.sha256()
                for piece in decode_stream(memoryview(data).cast("I"), token):
                    digest.update(piece.encode())
                decoded.append(digest.hexdigest())
            sizes = pa.array([len(data) // 4 for data in texts], pa.int64())
            hashed = pa.array([hashlib.sha256(data).hexdigest() for data in texts], pa.string())
            columns = [batch.column(0), sizes, hashed, pa.array(decoded, pa.string()), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *carry])

    return chosen.mapInArrow(run, ", ".join(kinds))
