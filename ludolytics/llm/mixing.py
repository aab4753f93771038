"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A document's key is -ln(u) / w: an exponential variable scaled by its quality weight, with u
from a hash of its id and text. In ascending key order, documents are a weighted sample without
replacement. A source whose budget is several times its size gives whole epochs first;
the rest of the budget is filled in key order, by a prefix sum of sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ludolytics.llm.shared import WORD, free_name, keep

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
#: Quality weights are counted in so many steps between 0 and 1, for the ranges of keys.
WEIGHT_STEPS = 20
#: Documents of a source that are sorted together: a range of keys holds about so many.
RANGE_ROWS = 2_000


def quality_weight(text: Column) -> Column:
    """Between 0.1 and 1: the share of a text's characters that are letters or spaces."""
    plain = F.regexp_count(text, F.lit(r"[\p{L} ]"))
    return F.greatest(F.lit(0.1), plain / F.greatest(F.length(text), F.lit(1)))


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int, row_col: str | None = None) -> DataFrame:
    """(row, doc_id, source, size, weight, key, tie): the narrow table on which the mix is decided."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    row = F.col(row_col) if row_col else F.lit(None)
    chosen = docs.select(row.cast("string").alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), text.alias("text"))
    chosen = chosen.withColumn("weight", quality_weight(F.col("text")))
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"), F.md5(F.col("text").cast("binary"))).cast("binary")), 1, 13)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))
    return chosen.select(
        "row",
        "doc_id",
        "source",
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("size"),
        "weight",
        (-F.log(u) / F.col("weight")).alias("key"),
        F.xxhash64("text").alias("tie"),
    )


def targets(narrow: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """(source, n, steps, source_size, target, budget): each source's share of all words.

    steps: (step, n), how many documents have a quality weight up to that step and above the
    one before; there are WEIGHT_STEPS at most.

    Sources in code point order, null last, weigh 5, 2, 1 and again. A target is
    min(cap, level * weight) with the cap `most` times the source's size, at the level at
    which the targets add up to all sizes; that is what resharing the excess by weight
    until none is above comes to. With sources sorted by cap / weight, the level is found
    from sums over those before. The windows hold a row for each source, not for each document.
    """
    step = F.ceil(F.col("weight") * WEIGHT_STEPS) / WEIGHT_STEPS
    steps = narrow.groupBy("source", step.alias("step")).agg(F.count("*").alias("n"), F.sum("size").alias("inside"))
    sums = steps.groupBy("source").agg(F.sum("n").alias("n"), F.sum("inside").alias("source_size"), F.sort_array(F.collect_list(F.struct("step", "n"))).alias("steps"))
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    ranked = sums.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    spent = F.coalesce(F.sum("cap").over(before), F.lit(0))
    left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    total = F.sum("source_size").over(everything)
    levels = ranked.withColumn("level", (total - spent) / left)  # the level if all before are at their caps
    fits = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct(F.col("cap") / F.col("weight"), "level"))
    level = F.min(fits).over(everything)["level"]  # the first that is not above its own source's cap
    target = F.least(F.col("cap").cast("double"), F.coalesce(level, F.lit(float("inf"))) * F.col("weight"))
    chosen = levels.select("source", "n", "steps", "source_size", "cap", target.alias("target"))
    return chosen.withColumn("budget", F.least("cap", F.round("target").cast("long"))).drop("cap")


def ranged(narrow: DataFrame, per_source: DataFrame, *columns: str) -> DataFrame:
    """The narrow table with its source's columns and `slot`, the range of keys a row is in.

    A document of weight w has a key of k or less with the chance 1 - exp(-k w). Summed over
    the steps of the source's weights, that is the share of its documents up to k, so that
    ranges hold about RANGE_ROWS each whatever the weights are. The share never falls as k grows.
    """
    parts = F.ceil(F.col("n") / RANGE_ROWS)
    below = F.aggregate("steps", F.lit(0.0), lambda total, s: total + s["n"] * (F.lit(1.0) - F.exp(-F.col("key") * s["step"])))
    slot = F.floor(below / F.col("n") * parts).cast("long")
    sources = per_source.withColumnRenamed("source", "_source")
    return narrow.join(sources, F.col("source").eqNullSafe(F.col("_source"))).select("row", "doc_id", "size", "key", "tie", *columns, slot.alias("slot"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 0, row_col: str | None = None) -> DataFrame:
    """doc_id, size (words), source_size, target, taken (words the mix takes), a row for each row.

    A source takes its budget exactly: each document once in every whole epoch, and for the
    rest of the budget documents in key order, of the last one only as many words as are
    left. Repeated rows are documents of their own; ties of the key go by doc_id, size and
    text, so reruns agree. Null texts have size 0 and take nothing; null is a source; an
    empty table gives no rows; other columns are neither read nor returned. With `row_col`, a
    unique text of each row, that column is returned as well.

    Documents are put into ranges of keys that hold about RANGE_ROWS of their source, whose
    sizes are summed first. Only the range in which the budget ends is sorted, so that a
    source with a third of all rows is no large task.
    """
    narrow = keep(sized(docs, id_col, text_col, source_col, seed, row_col))
    per_source = targets(narrow).withColumn("sid", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))))
    per_source = keep(per_source.withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0))).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size")))
    base = ranged(narrow, per_source, "sid", "source_size", "target", "epochs", "rest")
    sums = base.groupBy("sid", "slot", "rest").agg(F.sum("size").alias("inside"))
    upto = F.sum("inside").over(Window.partitionBy("sid").orderBy("slot"))
    ends = keep(sums.withColumn("upto", upto).where((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("inside") <= F.col("rest"))).select("sid", F.col("slot").alias("end"), (F.col("upto") - F.col("inside")).alias("before")))
    marked = base.join(ends, "sid", "left")
    whole = F.when(F.col("end").isNull() | (F.col("slot") < F.col("end")), F.col("size")).otherwise(F.lit(0))
    clear = marked.where(F.col("end").isNull() | (F.col("slot") != F.col("end"))).withColumn("part", whole)
    order = Window.partitionBy("sid").orderBy("key", F.asc_nulls_first("doc_id"), "size", "tie", "row").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0))
    share = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - ahead))
    border = marked.where(F.col("slot") == F.col("end")).withColumn("part", share)
    both = clear.unionByName(border)
    row = [F.col("row").alias(row_col)] if row_col else []
    return both.select(*row, "doc_id", "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.col("part")).cast("long").alias("taken"))


def first_words(text: Column, count: Column) -> Column:
    """The text up to the end of its count-th word and the white space after it."""
    pieces = F.split(text, r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    lead = F.when(text.rlike(r"^[\x20\x09-\x0D]"), F.lit(1)).otherwise(F.lit(0))
    return F.array_join(F.slice(pieces, F.lit(1), (count + lead).cast("int")), "")


def apply_mix(docs: DataFrame, decided: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """The rows of the mix, with the columns of `docs`: a document's copy for each epoch, and a cut copy for a part of one.

    Each row meets its own decision by `row_col`; without one, `docs` has each id once and none is null. Documents that the mix takes nothing of go.
    """
    row_id, size, taken, copy = (free_name(docs, name) for name in ("_id", "_size", "_taken", "_copy"))
    plan = decided.where("taken > 0").select(F.col(row_col or "doc_id").alias(row_id), F.col("size").alias(size), F.col("taken").alias(taken))
    joined = docs.join(plan, (F.col(row_col) if row_col else F.col(id_col).cast("long")) == F.col(row_id))
    copies = F.ceil(F.col(taken) / F.col(size)).cast("int")
    shown = joined.withColumn(copy, F.explode(F.sequence(F.lit(1), copies)))
    left = F.col(taken) - (F.col(copy) - 1) * F.col(size)
    cut = F.when(left < F.col(size), first_words(F.col(text_col), left)).otherwise(F.col(text_col))
    return shown.withColumn(text_col, cut).select(*docs.columns)
