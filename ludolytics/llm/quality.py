"""Quality rules: a table of thresholds, compiled into one projection of Spark functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludolytics.llm.shared import SPACE, WORD

WINDOW = 5

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "als auf das dem den der des die ein eine für im ist mit nicht sich und von zu "
    "au aux avec ce dans de des du elle en est et il la le les par pas pour que qui sur un une "
    "al como con de del el en es la las lo los no para por que se su un una y"
).split()


@dataclass(frozen=True)
class Rule:
    """`part` must be between `least` and `most` per cent of `whole`; None: no bound. Base rules go into base_failed."""

    name: str
    part: str
    whole: str
    least: int | None = None
    most: int | None = None
    base: bool = False

    def broken(self) -> Column:
        part, whole = F.col(self.part) * 100, F.col(self.whole)
        checks = ([part < whole * self.least] if self.least is not None else []) + ([part > whole * self.most] if self.most is not None else [])
        if not checks:
            raise ValueError(f"rule {self.name} has no bound")
        return checks[0] if len(checks) == 1 else checks[0] | checks[1]


#: The thresholds, in per cent of another measure (`one` is 1).
RULES = (
    Rule("enough words", "n_words", "one", least=1000, base=True),
    Rule("repeated windows", "n_repeat_words", "n_words", most=20, base=True),
    Rule("symbols for each word", "n_symbols", "n_words", most=10),
    Rule("characters for each word", "word_chars", "n_words", least=200, most=1500),
    Rule("stop words", "n_stop_words", "n_words", least=2),
    Rule("repeated lines", "n_dup_lines", "n_lines", most=30),
)


def _repeat_words(df: DataFrame) -> DataFrame:
    """n_repeat_words from the column `words`: words covered by windows that are found twice or more.

    Windows are compared by 64-bit hashes within one text. Only texts that have equal windows
    sort them; equal neighbours then give the positions, and the gaps between positions the cover.
    """
    hashed = df.withColumn("_hash", F.transform("words", lambda w: F.xxhash64(w)))
    count = F.greatest(F.size("_hash") - (WINDOW - 1), F.lit(0))
    window = F.transform(F.slice("_hash", F.lit(1), count), lambda h, i: F.xxhash64(h, *[F.get("_hash", i + k) for k in range(1, WINDOW)]))
    grams = hashed.withColumn("_grams", window)
    equal = F.size(F.array_distinct("_grams")) < F.size("_grams")
    order = F.when(equal, F.array_sort(F.transform("_grams", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    ordered = grams.withColumn("_order", order)
    same = lambda x, j: (x["h"] == F.get("_order", j - 1)["h"]) | (x["h"] == F.get("_order", j + 1)["h"])
    at = F.array_sort(F.array_compact(F.transform("_order", lambda x, j: F.when(F.coalesce(same(x, j), F.lit(False)), x["i"]))))
    placed = ordered.withColumn("_at", at)
    gaps = F.transform("_at", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_at", k + 1) - p, F.lit(WINDOW))))
    cover = F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap)
    return placed.withColumn("n_repeat_words", F.coalesce(cover, F.lit(0).cast("long")))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the counts that rules speak of, a row for each row; a null text has no words."""
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    split = chosen.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    lines = split.withColumn("_lines", F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    counted = _repeat_words(lines)
    return counted.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", f"{SPACE}+", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
    )


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, the measures, base_failed, kept and the names of the broken rules.

    A null or empty text has zero words and fails; a null doc_id stays null; repeated rows
    come back as often; an empty table gives no rows; other columns are neither read nor
    returned. `kept` is false if any rule is broken, base rules first.
    """
    measured = measures(docs, id_col, text_col).withColumn("one", F.lit(1).cast("long"))
    any_of = lambda chosen: F.coalesce(F.greatest(F.lit(False), F.lit(False), *[r.broken() for r in chosen]), F.lit(False))
    broken = F.array_compact(F.array(*[F.when(r.broken(), F.lit(r.name)) for r in rules]))
    return measured.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        any_of([r for r in rules if r.base]).alias("base_failed"),
        (~any_of(rules)).alias("kept"),
        F.array_join(broken, ", ").alias("broken"),
    )
