"""Personal data: exact base patterns, and a semi-Markov conditional random field beside them.

The field scores whole candidate segments, not single tokens: what a span's digits,
groups, separators, check sum and neighbours are like as one. A dynamic programme over the
tokens of a place, with entities of at most MAX_TOKENS tokens, chooses boundaries and types
jointly. It is trained on made-up sentences from a fixed seed (no table holds spans), by
the conditional likelihood, with the forward and backward sums over all segmentations.
Base spans are certain and stay; the field decodes the places that they leave.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludolytics.llm.shared import giving_back

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS = 16

#: (kind, start, end) in code points, end exclusive.
Span = tuple[str, int, int]

# The base patterns, each anchored so that no start is tried twice over the same run.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _only_digits(found: str) -> str:
    return "".join(_DIGIT.findall(found))


def base_spans(text: str) -> list[Span]:
    """All base spans by kind, then start."""
    found: list[Span] = []
    last = 0
    if "@" in text:
        for match in _DOMAIN.finditer(text):
            start = match.start()
            while start > last and text[start - 1] in _LOCAL:
                start -= 1
            if start < match.start():
                last = match.end()
                found.append(("email", start, last))
    if _DIGIT.search(text) is None:
        return found
    for match in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in match[0].split(".")):
            found.append(("ip", *match.span()))
    for match in _CARD.finditer(text):
        digits = _only_digits(match[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *match.span()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 8 <= len(_only_digits(match[0])) <= 15:
                found.append(("phone", *match.span()))
    return found


# ---- candidates and their features ------------------------------------------------

_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|.", re.DOTALL)
#: A place worth decoding: seven or more digits that belong together, an at sign, or one spelled out in brackets.
_PLACE = re.compile(r"(?<![0-9])[0-9](?:[ ().+/-]{0,3}[0-9]){6,}+|@|[\[({] ?at ?[\])}]")
_AROUND = 48
_QUAD = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")
_MAIL = re.compile(r"[\w.%+-]+ ?(?:@|[\[({] ?at ?[\])}]) ?[\w-]+(?: ?(?:\.|[\[({] ?dot ?[\])}]) ?[\w-]+)+", re.ASCII)
_NATIONAL = re.compile(r"(?:\([0-9]{2,5}\)|[0-9]{2,5})[ ./-]?[0-9]{3,4}[ ./-][0-9]{3,5}")


def _side(char: str) -> str:
    return "end" if not char else "alpha" if char.isalpha() else "digit" if char.isdigit() else "space" if char.isspace() else char


def features(text: str, start: int, end: int, tokens: int) -> list[str]:
    """What is said of one candidate segment as a whole."""
    span = text[start:end]
    digits = _only_digits(span)
    groups = re.findall("[0-9]+", span)
    marks = "".join(sorted({c for c in span if not c.isalnum()}))
    letters = any(c.isalpha() for c in span)
    found = ["any", f"digits {min(len(digits), 20)}", f"marks {marks if len(marks) < 5 else 'many'}", f"letters {letters}"]
    found += [f"groups {'-'.join(str(len(g)) for g in groups) if len(groups) < 6 else 'many'} {letters}", f"tokens {tokens}"]
    found += [f"left {_side(text[start - 1 : start])}", f"right {_side(text[end : end + 1])}", f"first {_side(span[0])} last {_side(span[-1])}"]
    found.append(f"quad {bool(_QUAD.fullmatch(span) and all(int(g) < 256 for g in groups))}")
    found.append(f"mail {bool(_MAIL.fullmatch(span))}")
    found.append(f"national {bool(_NATIONAL.fullmatch(span))} {min(len(digits), 13)}")
    found.append(f"sum {13 <= len(digits) <= 19 and not letters and luhn(digits)} {len(digits) >= 16}")
    found.append(f"plus {span[0] == '+'} {8 <= len(digits) <= 15}")
    return found


def segments(text: str, low: int, high: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Tokens of text[low:high], and candidates as token ranges: from a letter, digit, plus or bracket to a letter or digit."""
    tokens = [match.span() for match in _TOKEN.finditer(text, low, high)]
    first = [text[a].isalnum() or text[a] in "+(" for a, _ in tokens]
    last = [text[b - 1].isalnum() for _, b in tokens]
    found = []
    for j in range(len(tokens)):
        if last[j]:
            weight = 0  # digits so far, and a hundred for an at sign or a bracket
            for i in range(j, max(-1, j - MAX_TOKENS), -1):
                a, b = tokens[i]
                weight += (b - a if text[a] in "0123456789" else 100 if text[a] in "@[({" else 0)
                if first[i] and weight >= 7:
                    found.append((i, j + 1))
    return tokens, found


@dataclass
class Field:
    """Weights by feature (a row of one number a kind) and of the steps from type to type; type 0 is outside."""

    index: dict[str, int]
    weights: np.ndarray
    steps: np.ndarray

    def scores(self, rows: list[list[int]]) -> np.ndarray:
        return np.array([self.weights[row].sum(axis=0) for row in rows]).reshape(len(rows), len(KINDS))

    def rows(self, text: str, tokens: list, found: list) -> list[list[int]]:
        return [[self.index[f] for f in features(text, tokens[i][0], tokens[j - 1][1], j - i) if f in self.index] for i, j in found]

    def decode(self, text: str, low: int, high: int) -> list[Span]:
        """The best segmentation of a place (Viterbi over segments of bounded length)."""
        tokens, found = segments(text, low, high)
        if not found:
            return []
        scores = self.scores(self.rows(text, tokens, found))
        n, types = len(tokens), len(KINDS) + 1
        best = np.full((n + 1, types), -np.inf)
        best[0, 0] = 0.0
        back: list[list[tuple[int, int]]] = [[(0, 0)] * types for _ in range(n + 1)]
        ending: dict[int, list[int]] = {}
        for c, (_, j) in enumerate(found):
            ending.setdefault(j, []).append(c)
        for j in range(1, n + 1):
            come = best[j - 1] + self.steps[:, 0]
            back[j][0] = (j - 1, int(come.argmax()))
            best[j, 0] = come.max()
            for c in ending.get(j, ()):
                i = found[c][0]
                come = best[i][:, None] + self.steps[:, 1:]
                reach = come.max(axis=0) + scores[c]
                for y in np.nonzero(reach > best[j, 1:])[0]:
                    best[j, y + 1] = reach[y]
                    back[j][y + 1] = (i, int(come[:, y].argmax()))
        out, j, y = [], n, int(best[n].argmax())
        while j > 0:
            i, before = back[j][y]
            if y:
                out.append((KINDS[y - 1], tokens[i][0], tokens[j - 1][1]))
            j, y = i, before
        return out[::-1]


# ---- training ----------------------------------------------------------------------


def made_up(count: int, seed: int = 7) -> list[tuple[str, list[Span]]]:
    """Sentences with their spans: entities in plain and unusual forms, and numbers that are none."""
    rng = random.Random(seed)

    def number(n: int) -> str:
        return "".join(rng.choice("0123456789") for _ in range(n))

    def word() -> str:
        return "".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 9)))

    def card(good: bool) -> str:
        while True:
            digits = rng.choice("3456") + number(15)
            if luhn(digits) == good:
                return rng.choice(["", " ", "-", ".", "/"]).join(digits[k : k + 4] for k in range(0, 16, 4))

    def mail() -> str:
        at, dot = rng.choice([("@", "."), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" (at) ", "."), ("[at]", ".")])
        return word() + rng.choice(["", "." + number(2), "_" + word()]) + at + word() + dot + rng.choice(["com", "org", "net", "de"])

    def national() -> str:
        sep = rng.choice(" -./")
        return rng.choice([f"({number(3)}) {number(3)}-{number(4)}", f"{number(3)}{sep}{number(3)}{sep}{number(4)}", f"+{number(1)} ({number(3)}) {number(3)}-{number(4)}", f"+{number(2)} {number(3)} {number(7)}"])

    def quad() -> str:
        return ".".join(str(rng.randint(0, 255)) for _ in range(4))

    def none() -> str:
        return rng.choice([
            lambda: card(False), lambda: number(rng.choice([7, 8, 9, 10, 11, 12, 13, 14, 16, 20])),
            lambda: f"20{number(2)}-0{rng.randint(1, 9)}-{rng.randint(10, 28)} {rng.randint(10, 23)}:{rng.randint(10, 59)}:{rng.randint(10, 59)}",
            lambda: ".".join(str(rng.randint(0, 30)) for _ in range(rng.choice([5, 6, 7]))), lambda: f"{rng.randint(256, 999)}.{quad()}",
            lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40)), lambda: f"{number(1)},{number(3)},{number(3)}.{number(2)}",
            lambda: f"97{number(1)}-{number(1)}-{number(2)}-{number(6)}-{number(1)}", lambda: f"@{word()}", lambda: f"{word()} @ {word()}",
            lambda: f"{number(4)} {number(4)}", lambda: f"{number(6)}-{number(6)}", lambda: " ".join(number(2) for _ in range(rng.randint(4, 9))),
        ])()

    makers = {"email": mail, "ip": quad, "card": lambda: card(True), "phone": national}
    out = []
    for _ in range(count):
        text, spans = " ".join(word() for _ in range(rng.randint(0, 3))), []
        for _ in range(rng.randint(1, 2)):
            kind = rng.choice([*KINDS, None, None, None])
            text += " " if text else ""
            start = len(text)
            text += makers[kind]() if kind else none()
            if kind:
                spans.append((kind, start, len(text)))
            text += rng.choice(["", ".", ",", "###", "!!", " |", ""])
            text += " " + " ".join(word() for _ in range(rng.randint(1, 3)))
        out.append((text, spans))
    return out


def likelihood_step(field: Field, n: int, found: list, rows: list, gold: dict, grad_w: np.ndarray, grad_t: np.ndarray) -> float:
    """Adds the gradient of one sentence's conditional log-likelihood; returns that likelihood."""
    types = len(KINDS) + 1
    scores = field.scores(rows)
    steps = field.steps
    alpha, beta = np.full((n + 1, types), -np.inf), np.full((n + 1, types), -np.inf)
    alpha[0, 0], beta[n] = 0.0, 0.0
    ending: dict[int, list[int]] = {}
    starting: dict[int, list[int]] = {}
    for c, (i, j) in enumerate(found):
        ending.setdefault(j, []).append(c)
        starting.setdefault(i, []).append(c)
    for j in range(1, n + 1):
        alpha[j, 0] = np.logaddexp.reduce(alpha[j - 1] + steps[:, 0])
        for c in ending.get(j, ()):
            come = np.logaddexp.reduce(alpha[found[c][0]][:, None] + steps[:, 1:], axis=0) + scores[c]
            alpha[j, 1:] = np.logaddexp(alpha[j, 1:], come)
    for i in range(n - 1, -1, -1):
        beta[i] = steps[:, 0] + beta[i + 1, 0]
        for c in starting.get(i, ()):
            go = np.logaddexp.reduce(steps[:, 1:] + scores[c] + beta[found[c][1], 1:], axis=1)
            beta[i] = np.logaddexp(beta[i], go)
    total = np.logaddexp.reduce(alpha[n])
    for j in range(1, n + 1):
        grad_t[:, 0] -= np.exp(alpha[j - 1] + steps[:, 0] + beta[j, 0] - total)
    for c, (i, j) in enumerate(found):
        share = np.exp(alpha[i][:, None] + steps[:, 1:] + scores[c] + beta[j, 1:] - total)
        grad_t[:, 1:] -= share
        expected = share.sum(axis=0)
        if (i, j) in gold:
            expected[gold[i, j] - 1] -= 1
        np.subtract.at(grad_w, rows[c], expected)
    value, place, before = 0.0, 0, 0
    starts = {i: (j, y) for (i, j), y in gold.items()}
    at = {span: c for c, span in enumerate(found)}
    while place < n:
        j, y = starts.get(place, (place + 1, 0))
        grad_t[before, y] += 1
        value += steps[before, y] + (scores[at[place, j], y - 1] if y else 0.0)
        place, before = j, y
    return float(value - total)


@lru_cache(maxsize=2)
def train(count: int = 300, epochs: int = 8, rate: float = 0.4, seed: int = 7) -> Field:
    """The field, fitted by AdaGrad to `count` sentences. The same on every call."""
    data, index = [], {}
    for text, spans in made_up(count, seed):
        tokens, found = segments(text, 0, len(text))
        by_start, by_end = {a: k for k, (a, _) in enumerate(tokens)}, {b: k + 1 for k, (_, b) in enumerate(tokens)}
        gold = {(by_start[a], by_end[b]): KINDS.index(kind) + 1 for kind, a, b in spans}
        if not set(gold) <= set(found):
            continue
        named = [features(text, tokens[i][0], tokens[j - 1][1], j - i) for i, j in found]
        rows = [[index.setdefault(f, len(index)) for f in row] for row in named]
        data.append((len(tokens), found, rows, gold))
    types = len(KINDS) + 1
    field = Field(index, np.zeros((len(index), len(KINDS))), np.zeros((types, types)))
    square_w, square_t = np.full_like(field.weights, 1e-6), np.full_like(field.steps, 1e-6)
    order = list(range(len(data)))
    rng = random.Random(seed)
    for _ in range(epochs):
        rng.shuffle(order)
        for start in range(0, len(order), 8):
            grad_w, grad_t = -1e-3 * field.weights, -1e-3 * field.steps
            for k in order[start : start + 8]:
                likelihood_step(field, *data[k], grad_w, grad_t)
            square_w += grad_w**2
            square_t += grad_t**2
            field.weights += rate * grad_w / np.sqrt(square_w)
            field.steps += rate * grad_t / np.sqrt(square_t)
    return field


# ---- on texts and tables --------------------------------------------------------------


def find(text: str, field: Field) -> list[tuple[str, int, int, bool]]:
    """All spans (kind, start, end, base) by kind, then start; spans that the field adds touch no base span."""
    base = base_spans(text)
    taken: list[list[int]] = []  # what base spans cover, without overlaps
    for a, b in sorted((a, b) for _, a, b in base):
        if taken and a < taken[-1][1]:
            taken[-1][1] = max(b, taken[-1][1])
        else:
            taken.append([a, b])
    places: list[list[int]] = []
    k = 0
    for match in _PLACE.finditer(text):
        start, end = match.span()
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        j = k
        while start < end:  # each stretch of the place that base spans leave
            stop = taken[j][0] if j < len(taken) else len(text)
            if start < stop:
                low = max(start - _AROUND, taken[j - 1][1] if j else 0)
                high = min(min(end, stop) + _AROUND, stop)
                if places and low < places[-1][1]:
                    places[-1][1] = max(high, places[-1][1])
                else:
                    places.append([low, high])
            start = taken[j][1] if j < len(taken) else end
            j += 1
    added = [span for low, high in places for span in field.decode(text, low, high)]
    both = [(*span, True) for span in base] + [(*span, False) for span in added]
    return sorted(both, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def _chosen(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", field: Field | None = None) -> DataFrame:
    """doc_id, spans: array of (kind, start, end, base), a row for each row, over whole texts.

    Offsets count code points. A null text is an empty one and has no spans; a null doc_id
    stays null; an empty table gives no rows; other columns are neither read nor returned.
    """
    field = field or train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[dict(zip(("kind", "start", "end", "base"), s, strict=True)) for s in find(text or "", field)] for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, SPANS)], ["doc_id", "spans"])

    return _chosen(docs, id_col, text_col).mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:long,end:long,base:boolean>>")


def mask_text(text: str, found: list) -> str:
    """The text with each span, or union of overlapping spans, replaced by its kind in angle brackets."""
    out, last, open_end = [], 0, -1
    for kind, start, end, _ in sorted(found, key=lambda s: (s[1], -s[2])):
        if start >= open_end:
            out += [text[last:start], f"<{kind.upper()}>"]
        last = open_end = max(end, open_end)
    return "".join([*out, text[last:]])


def mask(docs: DataFrame, text_col: str = "text", field: Field | None = None) -> DataFrame:
    """The rows and columns as given, with all spans in the text masked; null texts stay null."""
    field = field or train()
    at = docs.columns.index(text_col)

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masked = [None if text is None else mask_text(text, find(text, field)) for text in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(masked, pa.string()))

    return docs.mapInArrow(run, docs.schema)


def digests(found: DataFrame) -> DataFrame:
    """Counts of base spans by kind, and the base spans' digest and all spans as text, from `spans`."""
    line = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(kind) for kind in KINDS],
        F.sha2(F.array_join(F.transform(base, line), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", line), ",").alias("spans"),
    )
