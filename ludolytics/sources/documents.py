"""The driver's tables as messages and landed documents, for the ingest queries.

What a broker or an interface would deliver is built by Spark from whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludolytics.operators.publish import key_of, to_messages
from ludolytics.operators.ranking import top_k_per_group
from ludolytics.sources import bindings as B
from ludolytics.sources import schemas as S

# What was shipped before this time makes up the stored state, the rest arrives.
SPLIT = "TIMESTAMP_NTZ '1995-07-01 00:00:00'"

# ISO text, with an offset on some records and without on others.
_ISO = (
    "concat(date_format({time}, \"yyyy-MM-dd'T'HH:mm:ss\"), "
    "CASE WHEN {choice} % 2 = 0 THEN '+00:00' ELSE '' END)"
)


def player_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = B.table(spark, sf_dir, "customer").selectExpr(
        "cast(c_custkey AS string) AS steamid",
        "CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE c_name END AS personaname",
        "c_nationkey % 7 AS personastate",
        "1700000000 + c_custkey * 60 AS lastlogoff",
        "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 1500000000 + c_custkey * 3600 END AS timecreated",
        "c_mktsegment AS locstatecode",
        "c_nationkey AS loccityid",
        _ISO.format(
            time="TIMESTAMP_NTZ '2024-01-20 00:00:00' + c_nationkey * INTERVAL '1' HOUR",
            choice="c_custkey",
        )
        + " AS fetched_at",
        f"'{S.SOURCE_PLATFORM}' AS source",
    )
    return to_messages(rows, key_of("steamid"), S.TOPICS["players"])


def _played(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.player_stats(spark, sf_dir).selectExpr(
        "steamid",
        "appid",
        "name",
        "playtime_forever",
        "playtime_2weeks",
        "unix_seconds(cast(rtime_last_played AS timestamp)) AS rtime_last_played",
        _ISO.format(time="TIMESTAMP_NTZ '2024-01-28 12:00:00'", choice="appid") + " AS fetched_at",
        f"'{S.SOURCE_PLATFORM}' AS source",
    )


def game_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _played(spark, sf_dir).drop("playtime_2weeks")
    return to_messages(rows, key_of("appid"), S.TOPICS["games"])


def stats_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _played(spark, sf_dir).withColumn("data_type", F.lit(S.RECENTLY_PLAYED))
    return to_messages(rows, key_of("steamid", "appid"), S.TOPICS["stats"])


def game_info_messages(spark: SparkSession, sf_dir: str, shipped: str | None = None) -> DataFrame:
    rows = (
        B.game_info(spark, sf_dir, shipped)
        .withColumn("tags", F.from_json("tags", "map<string,int>"))
        .withColumn("fetched_at", F.date_format("fetched_at", "yyyy-MM-dd'T'HH:mm:ss"))
        .drop("updated_at")
    )
    return to_messages(rows, key_of("appid"), S.TOPICS["game_info"])


def stored_game_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GAME_INFO as it was before the arriving messages."""
    rows = B.game_info(spark, sf_dir, f"l_shipdate < {SPLIT}").withColumns(
        {
            "price": F.col("price").try_cast("int"),
            "tags": F.from_json("tags", "map<string,int>"),
            "source": F.lit(S.SOURCE_CATALOGUE),
            "inserted_at": F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'"),
            "updated_at": F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'"),
        }
    )
    return _as_table(rows, S.GAME_INFO)


def arriving_game_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return game_info_messages(spark, sf_dir, f"l_shipdate >= {SPLIT}")


def _as_table(rows: DataFrame, table: S.Table) -> DataFrame:
    """The columns of a table in its order; those that rows lack are null."""
    return rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in table.schema.fields
        ]
    )


def review_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review pages (appid, value, fetched_at) of at most 100 reviews each."""
    review = F.expr(
        "named_struct('recommendationid', recommendationid, "
        "'author', named_struct('steamid', steamid, 'playtime_forever', playtime_forever, "
        "'playtime_at_review', playtime_at_review), "
        "'voted_up', voted_up, 'votes_up', votes_up + 1, 'weighted_vote_score', weighted_vote_score, "
        "'review', review_text, "
        "'timestamp_created', unix_seconds(cast(timestamp_created AS timestamp)), "
        "'timestamp_updated', unix_seconds(cast(timestamp_updated AS timestamp)), "
        "'language', language)"
    )
    page_number = F.expr("cast(recommendationid AS bigint) div 2000")
    pages = (
        B.game_reviews(spark, sf_dir)
        .groupBy("appid", page_number.alias("page"))
        .agg(F.collect_list(review).alias("reviews"))
    )
    return pages.select(
        "appid",
        F.to_json(F.struct(F.lit(1).alias("success"), "reviews")).alias("value"),
        F.expr("TIMESTAMP_NTZ '2024-01-30 06:00:00'").alias("fetched_at"),
    )


def stored_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GAME_REVIEWS as it was before the pages: the reviews that have a vote."""
    rows = (
        B.game_reviews(spark, sf_dir)
        .filter(F.col("voted_up").isNotNull())
        .withColumns(
            {
                "source": F.lit(S.SOURCE_REVIEWS),
                "inserted_at": F.expr("TIMESTAMP_NTZ '2024-01-25 00:00:00'"),
                "updated_at": F.expr("TIMESTAMP_NTZ '2024-01-25 00:00:00'"),
            }
        )
    )
    return _as_table(rows, S.GAME_REVIEWS)


def ranking_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranking lists (list_name, value): the first 100 games of each developer, keyed by appid, in order."""
    played = (
        B.game_info(spark, sf_dir)
        .filter(F.col("ccu").isNotNull())
        .select("appid", "name", "developer", "ccu", "price")
    )
    order = [F.col("ccu").desc(), F.col("appid")]
    first = top_k_per_group(played, ["developer"], order, 100, "position")
    game = F.struct("appid", "name", "developer", "ccu", "price")
    entry = F.struct("position", F.col("appid").cast("string").alias("key"), game.alias("game"))
    listed = first.groupBy(F.col("developer").alias("list_name")).agg(
        F.sort_array(F.collect_list(entry)).alias("games")
    )
    keyed = F.map_from_entries(F.transform("games", lambda g: F.struct(g["key"], g["game"])))
    return listed.select("list_name", F.to_json(keyed).alias("value"))


def player_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Player summaries, 100 players to a document."""
    players = B.players(spark, sf_dir).select("steamid", "personaname", "loccityid")
    number = F.floor(F.col("steamid").cast("bigint") / 100).alias("page")
    listed = players.groupBy(number).agg(F.collect_list(F.struct("*")).alias("players"))
    return listed.select(F.to_json(F.struct(F.struct("players").alias("response"))).alias("value"))


def played_documents(spark: SparkSession, sf_dir: str, recent: bool = False) -> DataFrame:
    """The games of each player (steamid, value): all of them, or those played in two weeks."""
    played = B.player_stats(spark, sf_dir)
    if recent:
        played = played.filter(F.col("playtime_2weeks") > 0)
    game = F.struct("appid", "name", "playtime_forever", "playtime_2weeks")
    listed = played.groupBy("steamid").agg(F.collect_list(game).alias("games"))
    response = F.struct(F.size("games").alias("game_count"), "games")
    return listed.select("steamid", F.to_json(F.struct(response.alias("response"))).alias("value"))


def catalogue_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue as pages of a thousand ids."""
    return B.game_info(spark, sf_dir).selectExpr(
        "appid div 1000 AS page", "appid % 1000 AS position", "appid", "name"
    )


def failing_count_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live count documents of which some report a failure and some hold no number."""
    response = F.struct(
        F.when(F.col("appid") % 5 == 0, 42).otherwise(1).alias("result"),
        F.when(F.col("appid") % 7 != 0, F.col("live_player_count")).alias("player_count"),
    )
    return B.count_snapshots(spark, sf_dir).select(
        "appid", F.to_json(F.struct(response.alias("response"))).alias("value"), "fetched_at"
    )


def failing_summary_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review summaries of which every third game's is unsuccessful."""
    failed = F.regexp_replace("value", '"success":1', '"success":0')
    value = F.when(F.col("appid") % 3 == 0, failed).otherwise(F.col("value"))
    return summary_documents(spark, sf_dir).withColumn("value", value)


def summary_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review summaries (appid, value) of all games."""
    totals = (
        B.game_reviews(spark, sf_dir)
        .groupBy("appid")
        .agg(
            F.count_if("voted_up").alias("total_positive"),
            F.count_if(~F.col("voted_up")).alias("total_negative"),
            F.count(F.lit(1)).alias("total_reviews"),
        )
    )
    summary = F.struct("total_positive", "total_negative", "total_reviews")
    return totals.select(
        "appid",
        F.to_json(F.struct(F.lit(1).alias("success"), summary.alias("query_summary"))).alias("value"),
    )


def detail_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store documents (value, fetched_at); games without a text are unsuccessful."""
    part = B.table(spark, sf_dir, "part")
    texts = B.texts(spark, sf_dir).select("doc_id", "text")
    described = F.struct(F.col("p_type").alias("description"))
    branded = F.struct(F.col("p_brand").alias("description"))
    data = F.struct(
        F.concat("p_name", F.lit(" "), F.col("p_partkey").cast("string")).alias("name"),
        F.lit("game").alias("type"),
        F.col("text").alias("detailed_description"),
        F.col("text").alias("short_description"),
        F.array("p_brand").alias("developers"),
        F.array(described, branded).alias("genres"),
        F.struct(F.lit("2024").alias("date")).alias("release_date"),
        F.struct(F.col("p_size").alias("score")).alias("metacritic"),
        F.struct(F.col("p_size").alias("final")).alias("price_overview"),
    )
    answer = F.struct(F.col("text").isNotNull().alias("success"), data.alias("data"))
    joined = part.join(texts, part.p_partkey == texts.doc_id, "left")
    return joined.select(
        F.to_json(F.create_map(F.col("p_partkey").cast("string"), answer)).alias("value"),
        F.expr("TIMESTAMP_NTZ '2024-01-30 07:00:00'").alias("fetched_at"),
    )


def stored_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GAME_DETAILS as it was: every game under its short name, still without a text."""
    rows = B.table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("appid"),
        F.col("p_name").alias("name"),
        F.lit("unknown").alias("type"),
        F.array("p_type").alias("genres"),
        F.expr("TIMESTAMP_NTZ '2024-01-02 00:00:00'").alias("fetched_at"),
        F.lit(S.SOURCE_STORE).alias("source"),
        F.expr("TIMESTAMP_NTZ '2024-01-02 00:00:00'").alias("inserted_at"),
        F.expr("TIMESTAMP_NTZ '2024-01-02 00:00:00'").alias("updated_at"),
    )
    return _as_table(rows, S.GAME_DETAILS)


def count_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live count documents (appid, value, fetched_at), one cycle per day."""
    response = F.struct(F.lit(1).alias("result"), F.col("live_player_count").alias("player_count"))
    return B.count_snapshots(spark, sf_dir).select(
        "appid", F.to_json(F.struct(response.alias("response"))).alias("value"), "fetched_at"
    )


def recorded_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers (answer_id, content) that name a game with a reason and one without.

    The turns of the conversations are answers too, none of them JSON.
    """
    named = F.struct(
        F.concat("p_name", F.lit(" "), F.col("p_partkey").cast("string")).alias("name"),
        F.col("p_type").alias("reason"),
    )
    bare = F.struct(F.col("p_brand").alias("name"), F.lit(None).cast("string").alias("reason"))
    body = F.to_json(F.struct(F.array(named, bare).alias("recommendations")))
    fenced = B.table(spark, sf_dir, "part").select(
        F.concat(F.lit("g"), F.col("p_partkey").cast("string")).alias("answer_id"),
        F.concat(F.lit("```json\n"), body, F.lit("\n```")).alias("content"),
    )
    spoken = B.table(spark, sf_dir, "conversations").select(
        F.concat_ws("_", F.lit("c"), F.col("conv_id"), F.col("turn")).alias("answer_id"),
        F.col("text").alias("content"),
    )
    return fenced.unionByName(spoken)
