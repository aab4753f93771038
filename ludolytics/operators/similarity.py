"""Content similarity of games to a short list of candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ludolytics.functions import without_links, words


def labels(genres: Column, tags: Column) -> Column:
    """The genre names and tag names of a game, lower case, each once."""
    empty = F.array().cast("array<string>")
    names = F.concat(F.coalesce(genres, empty), F.coalesce(F.map_keys(tags), empty))
    return F.array_distinct(F.transform(F.array_compact(names), lambda name: F.lower(name)))


def vocabulary(text: Column) -> Column:
    """The distinct words of a whole text.

    Cleaning only changes what stands between words, so links apart it is not needed.
    """
    return F.array_distinct(words(without_links(text)))


def _jaccard(common: Column, left: Column, right: Column) -> Column:
    """Share of common elements in all elements of two sets, from their sizes."""
    either = (left + right - common).cast("double")
    return F.coalesce(F.try_divide(common.cast("double"), either), F.lit(0.0))


def most_similar(
    sources: DataFrame, texts: DataFrame, candidates: DataFrame, k: int
) -> DataFrame:
    """The k candidates most like each source, with the labels they share.

    sources: appid, labels. texts: appid, description, where there is one. candidates:
    both, and further columns, which come along; a short list cut by a limit, which
    bounds its broadcasts and each source's pairs. Labels decide; only candidates that
    could still reach the first k (rank() keeps all ties) have their description
    compared, so long texts meet few partners.
    """
    known = F.broadcast(
        candidates.select(
            F.col("appid").alias("candidate"),
            F.size("labels").alias("candidate_labels"),
            F.explode("labels").alias("label"),
        )
    )
    wanted = sources.select(
        "appid", F.size("labels").alias("source_labels"), F.explode("labels").alias("label")
    )
    shared = (
        wanted.join(known, "label")
        .filter(F.col("appid") != F.col("candidate"))
        .groupBy("appid", "candidate", "source_labels", "candidate_labels")
        .agg(F.count(F.lit(1)).alias("n_shared"), F.collect_list("label").alias("shared"))
        .withColumn(
            "similarity",
            _jaccard(F.col("n_shared"), F.col("source_labels"), F.col("candidate_labels")),
        )
    )
    per_source = Window.partitionBy("appid")
    finalists = shared.withColumn(
        "place", F.rank().over(per_source.orderBy(F.desc("similarity")))
    ).filter(F.col("place") <= k)

    # The join below needs this partitioning anyway; asked for here, the work on the texts
    # is spread by it too.
    source_words = (
        texts.select("appid", "description")
        .repartition("appid")
        .select("appid", vocabulary(F.col("description")).alias("source_words"))
    )
    further = [c for c in candidates.columns if c not in ("appid", "labels", "description")]
    described = F.broadcast(
        candidates.select(
            F.col("appid").alias("candidate"),
            vocabulary(F.col("description")).alias("candidate_words"),
            *further,
        )
    )
    common = F.coalesce(F.size(F.array_intersect("source_words", "candidate_words")), F.lit(0))
    own = F.coalesce(F.size("source_words"), F.lit(0))
    compared = (
        finalists.join(source_words, "appid", "left")
        .join(described, "candidate")
        .select(
            "appid",
            "candidate",
            "similarity",
            _jaccard(common, own, F.size("candidate_words")).alias("text_similarity"),
            F.concat_ws(", ", F.sort_array("shared")).alias("shared_labels"),
            *further,
        )
    )
    order = [F.desc("similarity"), F.desc("text_similarity"), F.col("candidate")]
    return compared.withColumn("position", F.row_number().over(per_source.orderBy(*order))).filter(
        F.col("position") <= k
    )
