"""Schemas of the topics, landed documents and tables, with their keys.

The names and the source marks are fixed values of the data model.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TEXT = T.StringType()
INT = T.IntegerType()
LONG = T.LongType()
REAL = T.DoubleType()
FLAG = T.BooleanType()
DATE = T.DateType()
TIME = T.TimestampNTZType()
TEXTS = T.ArrayType(TEXT)


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def fields(schema: T.StructType) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in schema.fields}


# ---- topics ---------------------------------------------------------------

# Topic names.
TOPICS = {
    "players": "steam.players",
    "games": "steam.games",
    "stats": "steam.stats",
    "game_info": "steam.game_info",
}

PLAYER_MESSAGE = struct(
    steamid=TEXT,
    personaname=TEXT,
    profileurl=TEXT,
    avatar=TEXT,
    avatarmedium=TEXT,
    avatarfull=TEXT,
    personastate=INT,
    communityvisibilitystate=INT,
    profilestate=INT,
    lastlogoff=LONG,
    commentpermission=INT,
    realname=TEXT,
    primaryclanid=TEXT,
    timecreated=LONG,
    gameid=TEXT,
    gameserverip=TEXT,
    gameextrainfo=TEXT,
    loccountrycode=TEXT,
    locstatecode=TEXT,
    loccityid=INT,
    fetched_at=TEXT,
    source=TEXT,
)

GAME_MESSAGE = struct(
    steamid=TEXT,
    appid=INT,
    name=TEXT,
    playtime_forever=INT,
    img_icon_url=TEXT,
    img_logo_url=TEXT,
    playtime_windows_forever=INT,
    playtime_mac_forever=INT,
    playtime_linux_forever=INT,
    playtime_deck_forever=INT,
    rtime_last_played=LONG,
    playtime_disconnected=INT,
    fetched_at=TEXT,
    source=TEXT,
)

STATS_MESSAGE = struct(
    steamid=TEXT,
    appid=INT,
    name=TEXT,
    playtime_2weeks=INT,
    playtime_forever=INT,
    img_icon_url=TEXT,
    img_logo_url=TEXT,
    playtime_windows_forever=INT,
    playtime_mac_forever=INT,
    playtime_linux_forever=INT,
    playtime_deck_forever=INT,
    rtime_last_played=LONG,
    data_type=TEXT,
    fetched_at=TEXT,
    source=TEXT,
)

# Prices arrive as numbers or as text; read as text so that neither form is lost.
GAME_INFO_MESSAGE = struct(
    appid=INT,
    name=TEXT,
    developer=TEXT,
    publisher=TEXT,
    owners=TEXT,
    owners_variance=TEXT,
    players_forever=INT,
    players_2weeks=INT,
    average_forever=INT,
    average_2weeks=INT,
    median_forever=INT,
    median_2weeks=INT,
    ccu=INT,
    price=TEXT,
    initialprice=TEXT,
    discount=TEXT,
    languages=TEXT,
    genre=TEXT,
    tags=T.MapType(TEXT, INT),
    positive=INT,
    negative=INT,
    fetched_at=TEXT,
    source=TEXT,
)

# ---- landed documents -----------------------------------------------------

REVIEW_PAGE = struct(
    success=INT,
    cursor=TEXT,
    reviews=T.ArrayType(
        struct(
            recommendationid=TEXT,
            author=struct(steamid=TEXT, playtime_forever=INT, playtime_at_review=INT),
            voted_up=FLAG,
            votes_up=INT,
            votes_funny=INT,
            weighted_vote_score=REAL,
            review=TEXT,
            timestamp_created=LONG,
            timestamp_updated=LONG,
            language=TEXT,
            comment_count=INT,
            steam_purchase=FLAG,
            received_for_free=FLAG,
        )
    ),
)

REVIEW_SUMMARY = struct(
    success=INT,
    query_summary=struct(
        review_score=INT,
        review_score_desc=TEXT,
        total_positive=INT,
        total_negative=INT,
        total_reviews=INT,
    ),
)

_DESCRIBED = T.ArrayType(struct(description=TEXT))

STORE_DETAILS = T.MapType(
    TEXT,
    struct(
        success=FLAG,
        data=struct(
            name=TEXT,
            type=TEXT,
            required_age=INT,
            is_free=FLAG,
            detailed_description=TEXT,
            short_description=TEXT,
            about_the_game=TEXT,
            supported_languages=TEXT,
            header_image=TEXT,
            website=TEXT,
            developers=TEXTS,
            publishers=TEXTS,
            categories=_DESCRIBED,
            genres=_DESCRIBED,
            release_date=struct(date=TEXT, coming_soon=FLAG),
            metacritic=struct(score=INT, url=TEXT),
            recommendations=struct(total=INT),
            achievements=struct(total=INT),
            price_overview=TEXT,
        ),
    ),
)

RANKING_LIST = T.MapType(TEXT, GAME_INFO_MESSAGE)

PLAYER_SUMMARIES = struct(response=struct(players=T.ArrayType(PLAYER_MESSAGE)))


def owned_games(game: T.StructType) -> T.StructType:
    """The answer that lists the owned or recently played games of one player."""
    return struct(response=struct(game_count=INT, games=T.ArrayType(game)))


LIVE_COUNT = struct(response=struct(result=INT, player_count=INT))

RECOMMENDATIONS = struct(recommendations=T.ArrayType(struct(name=TEXT, reason=TEXT)))

# ---- tables ---------------------------------------------------------------

_STAMPS = {"inserted_at": TIME, "updated_at": TIME}


@dataclass(frozen=True)
class Table:
    """A keyed table. update_cols is None where a merge updates every column."""

    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    update_cols: tuple[str, ...] | None = None


PLAYERS = Table(
    "PLAYERS",
    struct(
        **fields(PLAYER_MESSAGE)
        | {"lastlogoff": TIME, "timecreated": TIME, "fetched_at": TIME}
        | _STAMPS
    ),
    ("steamid",),
)

GAMES = Table(
    "GAMES",
    struct(
        game_id=TEXT,
        **fields(GAME_MESSAGE) | {"rtime_last_played": TIME, "fetched_at": TIME} | _STAMPS,
    ),
    ("game_id",),
)

PLAYER_STATS = Table(
    "PLAYER_STATS",
    struct(
        stat_id=TEXT,
        **fields(STATS_MESSAGE) | {"rtime_last_played": TIME, "fetched_at": TIME} | _STAMPS,
    ),
    ("stat_id",),
)

GAME_INFO = Table(
    "GAME_INFO",
    struct(
        **fields(GAME_INFO_MESSAGE)
        | {"price": INT, "initialprice": INT, "discount": INT, "fetched_at": TIME}
        | _STAMPS
    ),
    ("appid",),
)

GAME_REVIEWS = Table(
    "GAME_REVIEWS",
    struct(
        review_id=TEXT,
        appid=INT,
        game_name=TEXT,
        recommendationid=TEXT,
        steamid=TEXT,
        playtime_forever=INT,
        playtime_at_review=INT,
        voted_up=FLAG,
        votes_up=INT,
        votes_funny=INT,
        weighted_vote_score=REAL,
        review_text=TEXT,
        timestamp_created=TIME,
        timestamp_updated=TIME,
        language=TEXT,
        comment_count=INT,
        steam_purchase=FLAG,
        received_for_free=FLAG,
        fetched_at=TIME,
        source=TEXT,
        **_STAMPS,
    ),
    ("review_id",),
    # What a repeated review updates; its text and vote stay as first seen.
    (
        "votes_up",
        "votes_funny",
        "weighted_vote_score",
        "timestamp_updated",
        "comment_count",
        "fetched_at",
    ),
)

GAME_DETAILS = Table(
    "GAME_DETAILS",
    struct(
        appid=INT,
        name=TEXT,
        type=TEXT,
        required_age=INT,
        is_free=FLAG,
        detailed_description=TEXT,
        short_description=TEXT,
        about_the_game=TEXT,
        supported_languages=TEXT,
        header_image=TEXT,
        website=TEXT,
        developers=TEXTS,
        publishers=TEXTS,
        categories=TEXTS,
        genres=TEXTS,
        release_date=TEXT,
        coming_soon=FLAG,
        metacritic_score=INT,
        metacritic_url=TEXT,
        recommendations_total=INT,
        achievements_total=INT,
        price_overview=TEXT,
        fetched_at=TIME,
        source=TEXT,
        **_STAMPS,
    ),
    ("appid",),
    # What a repeated document updates.
    (
        "name",
        "detailed_description",
        "short_description",
        "about_the_game",
        "metacritic_score",
        "recommendations_total",
        "price_overview",
        "fetched_at",
    ),
)

GAME_PLAYER_COUNTS = Table(
    "GAME_PLAYER_COUNTS",
    struct(
        record_id=TEXT,
        appid=INT,
        game_name=TEXT,
        live_player_count=INT,
        fetched_at=TIME,
        source=TEXT,
        inserted_at=TIME,
    ),
    ("record_id",),
)

REVIEW_SENTIMENTS = Table(
    "REVIEW_SENTIMENTS",
    struct(
        review_id=TEXT,
        appid=INT,
        game_name=TEXT,
        sentiment_compound=REAL,
        sentiment_positive=REAL,
        sentiment_negative=REAL,
        sentiment_neutral=REAL,
        sentiment_label=TEXT,
        review_length=INT,
        processed_at=TIME,
    ),
    ("review_id",),
)

GAME_SENTIMENT_ANALYSIS = Table(
    "GAME_SENTIMENT_ANALYSIS",
    struct(
        appid=INT,
        game_name=TEXT,
        analysis_date=DATE,
        total_reviews_analyzed=INT,
        avg_sentiment_compound=REAL,
        avg_sentiment_positive=REAL,
        avg_sentiment_negative=REAL,
        positive_review_pct=REAL,
        negative_review_pct=REAL,
        neutral_review_pct=REAL,
        sentiment_score=REAL,
        processed_at=TIME,
    ),
    ("appid", "analysis_date"),
)

SENTIMENT_TRENDS = Table(
    "SENTIMENT_TRENDS",
    struct(
        trend_date=DATE,
        category=TEXT,
        appid=INT,
        game_name=TEXT,
        sentiment_score=REAL,
        review_count=INT,
        rank_in_category=INT,
        processed_at=TIME,
    ),
    ("trend_date", "category", "appid"),
)

POPULAR_GAMES_HISTORICAL = Table(
    "POPULAR_GAMES_HISTORICAL",
    struct(fetched_at=TIME, appid=INT, game_name=TEXT, live_player_count=INT, ranking=INT),
    ("fetched_at", "appid"),
)

POPULAR_GAMES = Table("POPULAR_GAMES", POPULAR_GAMES_HISTORICAL.schema, ("appid",))

RECENT_REVIEWS = Table(
    "RECENT_REVIEWS",
    struct(
        appid=INT,
        game_name=TEXT,
        steamid=TEXT,
        playtime_forever=INT,
        playtime_at_review=INT,
        voted_up=FLAG,
        votes_up=INT,
        votes_funny=INT,
        weighted_vote_score=REAL,
        review_text=TEXT,
        timestamp_updated=TIME,
        position=INT,
    ),
    ("appid", "position"),
)

TABLES = {
    table.name: table
    for table in (
        PLAYERS,
        GAMES,
        PLAYER_STATS,
        GAME_INFO,
        GAME_REVIEWS,
        GAME_DETAILS,
        GAME_PLAYER_COUNTS,
        REVIEW_SENTIMENTS,
        GAME_SENTIMENT_ANALYSIS,
        SENTIMENT_TRENDS,
        POPULAR_GAMES_HISTORICAL,
        POPULAR_GAMES,
        RECENT_REVIEWS,
    )
}

# Marks that say where a record came from.
SOURCE_CATALOGUE = "steamspy"
SOURCE_PLATFORM = "steam_api"
SOURCE_REVIEWS = "steam_reviews_api"
SOURCE_STORE = "steam_store_api"
RECENTLY_PLAYED = "recently_played"
