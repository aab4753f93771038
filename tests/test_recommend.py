import json

import pytest
from pyspark.sql import functions as F

from ludolytics.plans import recommend


@pytest.fixture(scope="module")
def games(spark):
    details = spark.createDataFrame(
        [
            (1, "One", ["RPG", "Indie"], "swords and magic"),
            (2, "Two", ["RPG", "Indie"], "magic"),
            (3, "Three", ["RPG", "Indie"], "swords and magic and more"),
            (4, "Four", ["Sports"], "ball"),
            (5, "Five", ["RPG"], None),
        ],
        "appid int, name string, genres array<string>, short_description string",
    )
    info = spark.createDataFrame(
        [
            (1, "One", 10, 1, 1, '{"Magic": 1}'),
            (2, "Two", 20, 3, 1, '{"Magic": 1}'),
            (3, "Three", 30, 0, 0, '{"Magic": 1}'),
            (4, "Four", 40, 1, 0, None),
            (6, "Six", 50, 1, 0, '{"Racing": 1, "Cars": 2}'),
        ],
        "appid int, name string, ccu int, positive int, negative int, tags string",
    ).withColumns({"owners": F.lit("1"), "price": F.lit(""), "genre": F.lit("")})
    return details, info


def test_sources(games):
    rows = {r.appid: r for r in recommend.source_games(*games).collect()}
    assert rows.keys() == {1, 2, 3, 4, 5, 6}
    assert rows[5].ccu is None and rows[6].name == "Six" and rows[6].genres is None
    assert recommend.source_games(*games, appid=99).count() == 0


def test_candidates(games):
    found = recommend.candidate_games(*games, limit=3)
    assert {r.appid: r.review_score for r in found.collect()} == {2: 75.0, 3: None, 4: 100.0}
    assert {r.appid for r in recommend.without_source(found, 4).collect()} == {2, 3}


def test_similar(games):
    rows = recommend.similar_games(*games).collect()
    found = {}
    for r in rows:
        found.setdefault(r.source_appid, []).append((r.position, r.appid))
    # 2 and 3 share all labels with 1; the description of 3 is closer.
    assert sorted(found[1]) == [(1, 3), (2, 2)]
    assert 4 not in found and 6 not in found
    reasons = {r.reason for r in rows if r.source_appid == 1}
    assert reasons == {"Shares indie, magic, rpg"}
    (five,) = {r.reason for r in rows if r.source_appid == 5}
    assert five == "Shares rpg"
    one = recommend.similar_games(*games, appid=1).collect()
    assert sorted((r.position, r.appid) for r in one) == sorted(found[1])


def test_fallback(games):
    _, info = games
    one = recommend.fallback_games(info, 6).collect()
    assert [(r.appid, r.genre) for r in one] == [(3, "Magic"), (2, "Magic"), (1, "Magic")]
    everyone = recommend.fallback_for_all(info.select("appid"), info, limit=2).collect()
    for r in info.select("appid").collect():
        alone = recommend.fallback_games(info, r.appid, 2).collect()
        got = sorted((x.position, x.appid, x.genre) for x in everyone if x.source_appid == r.appid)
        assert got == [(n + 1, a.appid, a.genre) for n, a in enumerate(alone)]


def test_games_without_similar_ones_get_the_fallback(games):
    rows = recommend.recommendations(*games).collect()
    four = sorted((r.position, r.appid) for r in rows if r.source_appid == 4)
    assert four == [(1, 6), (2, 6), (3, 3), (4, 2), (5, 1)]
    assert {r.reason for r in rows if r.source_appid == 6} == {recommend.FALLBACK_REASON}
    assert {r.reason for r in rows if r.source_appid == 1} == {"Shares indie, magic, rpg"}


def test_recorded_answers(spark, games):
    def answer(*entries):
        return json.dumps({"recommendations": list(entries)})

    texts = [
        ("a", "```json\n" + answer({"name": "Two", "reason": "magic"}, {"reason": "no name"}) + "\n```"),
        ("b", "```\n" + answer({"name": "Three"}, {"name": "Unknown", "reason": "x"}) + "```"),
        ("c", "I recommend Two."),
        ("d", answer()),
        ("e", answer({"name": "Two", "reason": "first"}, {"name": "Two", "reason": "last"})),
    ]
    df = spark.createDataFrame(texts, "answer_id string, content string")
    parsed = {(r.answer_id, r.position): (r.name, r.reason) for r in recommend.parse_recommendations(df).collect()}
    assert parsed["a", 1] == ("Two", "magic")
    assert parsed["b", 1] == ("Three", "Similar gameplay and genre.")
    assert {k[0] for k in parsed} == {"a", "b", "e"}
    shown = recommend.recommended_games(df, recommend.candidate_games(*games)).collect()
    assert {(r.answer_id, r.appid, r.reason) for r in shown} == {
        ("a", 2, "magic"),
        ("b", 3, "Similar gameplay and genre."),
        ("e", 2, "last"),
    }
