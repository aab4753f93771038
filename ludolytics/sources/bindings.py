"""The driver's tables read as the tables of the data model.

Every function takes (spark, sf_dir). The invented columns cover the edge cases:
missing names, empty and zero prices, games without votes or tags, missing votes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-01-30 23:59:59"
ANALYSIS_DATE = "2024-01-30"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def game_player_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "md5(concat(cast(user_id AS string), '_', cast(event_id AS string))) AS record_id",
        "cast(user_id AS int) AS appid",
        "concat('Game_', cast(user_id AS string)) AS game_name",
        "cast(floor(value * 100) AS int) AS live_player_count",
        "ts AS fetched_at",
        "event_type AS source",
    )


def count_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sample per game and day."""
    return (
        table(spark, sf_dir, "events")
        .groupBy("user_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("fetched_at"))
        .agg(F.max(F.floor(F.col("value") * 100)).cast("int").alias("live_player_count"))
        .selectExpr(
            "cast(user_id AS int) AS appid",
            "concat('Game_', cast(user_id AS string)) AS game_name",
            "live_player_count",
            "fetched_at",
        )
    )


def game_info(spark: SparkSession, sf_dir: str, shipped: str | None = None) -> DataFrame:
    """The catalogue; `shipped` (a condition on lineitem) gives an earlier or later state."""
    sales = table(spark, sf_dir, "lineitem")
    if shipped is not None:
        sales = sales.filter(shipped)
    sold = sales.groupBy("l_partkey").agg(
        F.sum("l_quantity").alias("qty"),
        F.count_if(F.col("l_returnflag") != "R").alias("pos"),
        F.count_if(F.col("l_returnflag") == "R").alias("neg"),
    )
    how = "left" if shipped is None else "inner"
    part = table(spark, sf_dir, "part")
    return part.join(sold, part.p_partkey == sold.l_partkey, how).selectExpr(
        "cast(p_partkey AS int) AS appid",
        "CASE WHEN p_partkey % 19 = 0 THEN NULL "
        "ELSE concat(p_name, ' ', cast(p_partkey AS string)) END AS name",
        "p_brand AS developer",
        "p_name AS publisher",
        "p_type AS genre",
        "concat(format_number(p_size * 1000, 0), ' .. ', format_number(p_size * 2000, 0)) AS owners",
        "CASE WHEN p_partkey % 11 = 0 THEN '' WHEN p_partkey % 13 = 0 THEN '0' "
        "ELSE cast(cast(round(p_retailprice * 100) AS int) AS string) END AS price",
        "CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE cast(qty AS int) END AS ccu",
        "CASE WHEN p_partkey % 29 = 0 THEN 0 ELSE cast(pos AS int) END AS positive",
        "CASE WHEN p_partkey % 29 = 0 THEN 0 ELSE cast(neg AS int) END AS negative",
        "CASE WHEN p_partkey % 7 = 0 THEN NULL "
        """ELSE concat('{"', p_type, '":', cast(p_size AS string), ',"', p_brand, '":', """
        "cast(p_partkey % 500 AS string), '}') END AS tags",
        "TIMESTAMP_NTZ '2024-01-27 00:00:00' + p_size * INTERVAL '1' HOUR AS fetched_at",
        "TIMESTAMP_NTZ '2024-01-29 00:00:00' AS updated_at",
    )


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "cast(c_custkey AS string) AS steamid",
        "CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE c_name END AS personaname",
        "c_nationkey AS loccityid",
        "TIMESTAMP_NTZ '2024-01-20 00:00:00' + c_nationkey * INTERVAL '1' HOUR AS fetched_at",
    )


def player_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem")
    return (
        orders.join(lines, orders.o_orderkey == lines.l_orderkey)
        .groupBy("o_custkey", "l_partkey")
        .agg(
            (F.sum("l_quantity") * 60).cast("int").alias("playtime_forever"),
            (F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_quantity")).otherwise(0.0)) * 60)
            .cast("int")
            .alias("playtime_2weeks"),
            F.max("o_orderdate").alias("rtime_last_played"),
        )
        .selectExpr(
            "cast(o_custkey AS string) AS steamid",
            "cast(l_partkey AS int) AS appid",
            "CASE WHEN l_partkey % 31 = 0 THEN NULL "
            "ELSE concat('Game_', cast(l_partkey AS string)) END AS name",
            "playtime_forever",
            "playtime_2weeks",
            "rtime_last_played",
            "rtime_last_played AS fetched_at",
        )
    )


def game_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = texts(spark, sf_dir)
    labels = table(spark, sf_dir, "labels")
    return documents.join(labels, "doc_id", "left").selectExpr(
        "md5(concat(cast(doc_id % 20 AS string), '_', cast(doc_id AS string))) AS review_id",
        "cast(doc_id % 20 AS int) AS appid",
        "concat('Game_', cast(doc_id % 20 AS string)) AS game_name",
        "cast(doc_id AS string) AS recommendationid",
        "source AS steamid",
        "text AS review_text",
        "lang AS language",
        "CASE WHEN quality IS NULL THEN NULL ELSE quality = 1 END AS voted_up",
        "cast(n_chars * 2 AS int) AS playtime_forever",
        "cast(n_chars AS int) AS playtime_at_review",
        "cast(doc_id % 13 AS int) AS votes_up",
        "cast(doc_id % 7 AS int) AS votes_funny",
        "cast(doc_id % 100 AS double) / 100 AS weighted_vote_score",
        "TIMESTAMP_NTZ '2024-01-01 00:00:00' + doc_id * INTERVAL '1' MINUTE AS timestamp_created",
        "TIMESTAMP_NTZ '2024-01-01 00:00:00' + (doc_id * 7919 % 100000) * INTERVAL '1' MINUTE "
        "AS timestamp_updated",
        "TIMESTAMP_NTZ '2024-01-25 00:00:00' AS fetched_at",
    )


def scored_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reviews that already have a sentiment: those with a favourable label."""
    return game_reviews(spark, sf_dir).filter("voted_up").select("review_id")


def game_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Details of the games; the description is a whole document."""
    part = table(spark, sf_dir, "part")
    documents = texts(spark, sf_dir).select("doc_id", "text")
    return part.join(documents, part.p_partkey == documents.doc_id, "left").select(
        F.col("p_partkey").cast("int").alias("appid"),
        F.concat("p_name", F.lit(" "), F.col("p_partkey").cast("string")).alias("name"),
        F.array("p_type", "p_brand").alias("genres"),
        F.col("text").alias("short_description"),
        F.expr("TIMESTAMP_NTZ '2024-01-28 00:00:00' + p_size * INTERVAL '1' MINUTE").alias(
            "fetched_at"
        ),
    )


def modifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the test texts that change the words after them. Real runs load a table."""
    return spark.createDataFrame(
        [
            ("the", 0.293, False),
            ("and", 0.293, False),
            ("of", -0.293, False),
            ("to", -0.293, False),
            ("by", 0.0, True),
            ("is", 0.0, True),
            ("der", 0.293, False),
            ("que", -0.293, False),
            ("les", 0.0, True),
        ],
        "token string, intensity double, negates boolean",
    )


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the test texts with a valence. Real runs load a table."""
    return spark.createDataFrame(
        [
            ("that", 1.5),
            ("with", -1.2),
            ("this", 2.1),
            ("from", -2.4),
            ("tion", 0.8),
            ("than", -0.7),
            ("then", 1.1),
            ("thing", -1.9),
            ("those", 2.6),
            ("here", 0.4),
            ("there", -0.3),
            ("other", -3.1),
        ],
        "token string, valence double",
    )
