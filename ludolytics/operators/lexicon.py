"""Lexicon-based polarity of texts.

The normalisation, the negation factor and the intensity step are the published
ones (Hutto and Gilbert, ICWSM 2014); the valences come from a lexicon table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ludolytics.functions import half_up, words

# The normalisation constant, and the label thresholds (inclusive).
ALPHA = 15.0
POSITIVE_FROM = 0.05
NEGATIVE_FROM = -0.05

# What the three words before a scored word do to it, and the words that a run
# without a table of its own takes for such words.
INTENSITY = 0.293
DAMPING = (1.0, 0.95, 0.9)
NEGATION = -0.74
STRENGTHENING = (
    "absolutely", "amazingly", "completely", "considerably", "decidedly", "deeply",
    "enormously", "entirely", "especially", "exceptionally", "extremely", "fully",
    "greatly", "highly", "hugely", "incredibly", "intensely", "majorly", "more", "most",
    "particularly", "purely", "quite", "really", "remarkably", "so", "substantially",
    "thoroughly", "totally", "tremendously", "unbelievably", "unusually", "utterly", "very",
)
WEAKENING = (
    "almost", "barely", "hardly", "kinda", "less", "little", "marginally",
    "occasionally", "partly", "scarcely", "slightly", "somewhat", "sorta",
)
NEGATING = (
    "aint", "arent", "cannot", "cant", "couldnt", "despite", "didnt", "doesnt", "dont",
    "hadnt", "hasnt", "havent", "isnt", "mightnt", "mustnt", "neednt", "neither", "never",
    "none", "nope", "nor", "not", "nothing", "nowhere", "rarely", "seldom", "shouldnt",
    "wasnt", "werent", "without", "wont", "wouldnt",
)

# Valences are summed as whole numbers of this unit, so the order of the sum is free.
_UNIT = 100_000_000

# Stand for "this text exists"; no word contains a blank. There are many of them, so that
# they are no hot key where the join with the lexicon is a shuffle.
_MARK = "a text "
_MARKS = 512


def published_modifiers(spark: SparkSession) -> DataFrame:
    """(token, intensity, negates) of the words above."""
    rows = [
        *((word, INTENSITY, False) for word in STRENGTHENING),
        *((word, -INTENSITY, False) for word in WEAKENING),
        *((word, 0.0, True) for word in NEGATING),
    ]
    return spark.createDataFrame(rows, "token string, intensity double, negates boolean")


def _known(modifiers: DataFrame) -> DataFrame:
    """The modifiers, each word once: one that is listed twice takes its greatest intensity."""
    return (
        modifiers.filter(F.col("token").isNotNull())
        .groupBy("token")
        .agg(F.max("intensity").alias("intensity"), F.bool_or("negates").alias("negates"))
    )


def score_texts(
    texts: DataFrame,
    id_cols: Sequence[str],
    text_col: str,
    lexicon: DataFrame,
    in_context: bool = True,
    modifiers: DataFrame | None = None,
) -> DataFrame:
    """compound, positive, negative and neutral share of each text, with its label.

    id_cols identify a text and are carried along. Words meet the lexicon in an inner
    equi-join (broadcast where the optimizer finds the lexicon small), which drops the many words without
    a valence before anything is computed on them. Every text also sends one of the marks that
    the lexicon side holds, so a text without any match stays. The aggregate then
    shrinks a text to one row before the only shuffle.
    Texts of length 0 are dropped, at the end: as a condition on the text the filter
    would be pushed down to the scan and clean every text twice.
    With in_context, the three preceding words intensify or negate a word, by a table of
    modifiers (token, intensity, negates; the published words without one). They come from shifted
    copies of the word array, which needs no window over the words, and meet the modifiers in
    equi-joins, only in rows that have met the lexicon.
    """
    listed = texts.select(
        *id_cols, F.length(text_col).alias("text_length"), words(F.col(text_col)).alias("w")
    )
    counted = listed.withColumn("n_words", F.size("w").cast("bigint"))
    carried = [*id_cols, "text_length", "n_words"]
    number = F.pmod(F.xxhash64(*id_cols), F.lit(_MARKS))
    mark = F.array(F.concat(F.lit(_MARK), number.cast("string")))
    if in_context:
        # The mark comes last, so it precedes no word.
        gap = F.array(F.lit(None).cast("string"))
        shifted = counted.select(
            *carried,
            F.concat("w", mark).alias("w0"),
            F.concat(gap, "w").alias("w1"),
            F.concat(gap, gap, "w").alias("w2"),
            F.concat(gap, gap, gap, "w").alias("w3"),
        )
        spoken = F.inline(F.arrays_zip("w0", "w1", "w2", "w3")).alias("token", "p1", "p2", "p3")
    else:
        shifted = counted
        spoken = F.explode(F.concat("w", mark)).alias("token")
    marked = lexicon.select("token", F.col("valence").cast("double").alias("valence")).union(
        lexicon.sparkSession.range(_MARKS).select(
            F.concat(F.lit(_MARK), F.col("id").cast("string")), F.lit(0.0)
        )
    )
    matched = shifted.select(*carried, spoken).join(marked, "token")

    value = F.col("valence")
    if in_context:
        known = _known(published_modifiers(lexicon.sparkSession) if modifiers is None else modifiers)
        boost = F.lit(0.0)
        negated = F.lit(False)
        for k, damping in enumerate(DAMPING, 1):
            before = known.select(
                F.col("token").alias(f"p{k}"),
                F.col("intensity").alias(f"b{k}"),
                F.col("negates").alias(f"n{k}"),
            )
            matched = matched.join(before, f"p{k}", "left")
            boost = boost + F.coalesce(f"b{k}", F.lit(0.0)) * damping
            short = F.coalesce(F.col(f"p{k}").endswith("n't"), F.lit(False))
            negated = negated | F.coalesce(f"n{k}", F.lit(False)) | short
        raised = value + F.signum(value) * boost
        value = raised * F.when(negated, F.lit(NEGATION)).otherwise(F.lit(1.0))
    units = F.round(value * _UNIT).cast("bigint")
    valued = matched.select(*carried, units.alias("v"))

    v, one = F.col("v"), F.lit(_UNIT)
    sums = valued.groupBy(*id_cols).agg(
        F.max("text_length").alias("text_length"),
        F.max("n_words").alias("n_words"),
        F.sum("v").alias("s"),
        F.coalesce(F.sum(F.when(v > 0, v + one)), F.lit(0)).alias("p"),
        F.coalesce(F.sum(F.when(v < 0, one - v)), F.lit(0)).alias("n"),
        F.count_if(v != 0).alias("weighted"),
    )
    s, p, n = (F.col(c) / F.lit(float(_UNIT)) for c in ("s", "p", "n"))
    plain = (F.col("n_words") - F.col("weighted")).cast("double")
    total = p + n + plain

    def share(part: Column) -> Column:
        return half_up(F.coalesce(F.try_divide(part, total), F.lit(0.0)), 3)

    scored = sums.filter(F.col("text_length") > 0).select(
        *id_cols,
        "text_length",
        half_up(s / F.sqrt(s * s + ALPHA), 4).alias("sentiment_compound"),
        share(p).alias("sentiment_positive"),
        share(n).alias("sentiment_negative"),
        share(plain).alias("sentiment_neutral"),
    )
    return scored.withColumn("sentiment_label", sentiment_label(F.col("sentiment_compound")))


def sentiment_label(compound: Column) -> Column:
    return (
        F.when(compound >= POSITIVE_FROM, "POSITIVE")
        .when(compound <= NEGATIVE_FROM, "NEGATIVE")
        .otherwise("NEUTRAL")
    )
