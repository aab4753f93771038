"""Token counts of whole texts, huge ones in overlapping chunks that are spliced.

White space never belongs to a token of this kind of vocabulary, and neither composition
nor lower-casing reaches over it. So a text falls into pieces at white space, each of which
is tokenized alone; frequent pieces are remembered. That is used within a chunk.

A huge text is read in chunks that overlap. Both chunks tokenize the overlap, one without
what follows, the other without what precedes. A place is common when both end a word
there (a token with the end-of-word mark, or a special token), and proven when it is so
far from the first chunk's end that what follows cannot reach it: the splitter reads from
left to right and forgets all at the end of a word, so that from a common place on, both
readings agree. The first chunk counts up to that place and the second from it. Where
there is no such place the overlap is doubled, up to the whole chunk.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludolytics.llm.shared import once

#: Characters at a chunk's end that what follows may still change: the longest special string, and a composed character.
MARGIN = 64
#: White space of which every kind of splitter knows; other kinds stay inside a piece.
PIECES = re.compile(r"[^ \t\n\r]+")
#: The splitter's own words in plain lower-case ASCII without an apostrophe, where its contractions play no part.
PLAIN = re.compile(r"[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)

#: The tokens of a text: where each ends (code points), and whether a word ends there.
Ends = list[tuple[int, bool]]


def fixed(text: str, at: int) -> bool:
    """Whether the character at `at` neither composes with the one before nor moves before it."""
    if at <= 0 or at >= len(text):
        return True
    if text[at] < "̀":
        return True
    pair = text[at - 1 : at + 1]
    return unicodedata.combining(text[at]) == 0 and unicodedata.normalize("NFC", pair) == unicodedata.normalize("NFC", pair[0]) + unicodedata.normalize("NFC", pair[1])


def splice_count(text: str, ends: Callable[[str], Ends], chunk: int, overlap: int) -> tuple[int, int]:
    """Tokens of the text, and how often an overlap had to be widened."""
    start, size, total, widened = 0, chunk, 0, 0
    first = ends(text[:size])
    while start + size < len(text):
        stop, back, found = start + size, overlap, None
        while found is None:
            begin = max(start, stop - back)
            if begin == start:  # the overlap is the whole chunk: read it again, longer
                size *= 2
                first = ends(text[start : start + size])
                break
            second = ends(text[begin : begin + chunk + back])
            there = {begin + end: k for k, (end, word) in enumerate(second) if word}
            for k in range(len(first) - 1, -1, -1):
                place = start + first[k][0]
                if place <= begin:
                    break
                if first[k][1] and place <= stop - MARGIN and place in there and fixed(text, place):
                    # tokens that end at one place come together; only the last of them ends the word
                    found = (k + 1, there[place] + 1, place)
                    break
            if found is None:
                back *= 2
                widened += 1
        if found is not None:
            upto, skip, _ = found
            total += upto
            size = min(chunk + back, len(text) - begin)
            first = [(end, word) for end, word in second[skip:]]
            start = begin
    return total + len(first), widened


def pieces(text: str) -> list[str]:
    """Parts that are tokenized alone. Special strings begin with `<|` and are matched before lower-casing."""
    if text.isascii() and "'" not in text and "<|" not in text:
        return PLAIN.findall(text.lower())
    return PIECES.findall(text)


class Counter:
    """Counts with one tokenizer file. `chunk`: longer texts are read in chunks; `max_pieces` bounds what is remembered."""

    def __init__(self, path: str, chunk: int = 16_384, overlap: int = 512, max_pieces: int = 600_000) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        special = {number for number, token in self.tokenizer.get_added_tokens_decoder().items()}
        self.word_ends = {number for token, number in vocabulary.items() if token.endswith("</w>")} | special
        self.chunk, self.overlap, self.max_pieces = chunk, overlap, max_pieces
        self._known: dict[str, int] = {}

    def ends(self, text: str) -> Ends:
        found = self.tokenizer.encode(text, add_special_tokens=False)
        marks = self.word_ends
        return [(end, number in marks) for number, (_, end) in zip(found.ids, found.offsets, strict=True)]

    def learn(self, new: set[str]) -> None:
        """Tokenizes those pieces that are not known yet, at one go."""
        if len(self._known) > self.max_pieces:
            self._known.clear()
        todo = list(new.difference(self._known))
        for start in range(0, len(todo), 1 << 16):
            part = todo[start : start + (1 << 16)]
            for piece, found in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self._known[piece] = len(found)

    def counts(self, texts: list[str]) -> list[int]:
        split = [pieces(text) if len(text) <= self.chunk else None for text in texts]
        self.learn(set().union(*filter(None, split)))
        known = self._known
        return [self.huge(text) if parts is None else sum(map(known.__getitem__, parts)) for text, parts in zip(texts, split, strict=True)]

    def huge(self, text: str) -> int:
        return splice_count(text, self.ends, self.chunk, self.overlap)[0]


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text", chunk: int = 16_384, overlap: int = 512) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit, a row for each row.

    A null text is an empty one; special strings inside texts are counted as the library
    takes them by default; a null doc_id stays null; an empty table gives no rows; other
    columns are neither read nor returned. `tokenizer` is a path that executors can open.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        counter = once(("tokens", tokenizer, chunk, overlap), lambda: Counter(tokenizer, chunk, overlap))
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
            tokens = counter.counts([text or "" for text in batch.column(1).to_pylist()])
            over = pa.array([n > limit for n in tokens])
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(tokens, pa.int64()), over], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
