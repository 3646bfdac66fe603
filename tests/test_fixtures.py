"""t0: hand-derived expectations on sample records (FIXTURES.md).

The blocks marked "fixed sample values" are records whose results are known; every other
record is invented here for an edge case.
"""

import datetime as dt

from pyspark.sql import functions as F

from streamtab.plans import apps


def _lines(spark, lines, start=0):
    return spark.createDataFrame([(v, start + i) for i, v in enumerate(lines)], "value string, seq long")


# E1 ---------------------------------------------------------------------------------
def test_greeting(spark):
    df = spark.createDataFrame([("world",), ("izzy",)], "value string")
    assert sorted(r.greeting for r in apps.greeting(df).collect()) == ["Hello, izzy", "Hello, world"]


# E2 ---------------------------------------------------------------------------------
# fixed sample values
TWEETS = [
    '{"CreatedAt":1577933872630,"Id":10005,"Text":"Bitcoin has a lot of promise. I\'m not too sure about '
    '#ethereum","Lang":"en","Retweet":false,"Source":"","User":{"Id":"1","Name":"x"}}',
    '{"CreatedAt":1577933871912,"Id":10006,"Text":"RT Bitcoin has a lot of promise. I\'m not too sure about '
    '#ethereum","Lang":"en","Retweet":true,"Source":""}',
]


def test_entity_sentiment(spark):
    rows = apps.entity_sentiment(_lines(spark, TWEETS)).collect()
    assert sorted(r.entity for r in rows) == ["bitcoin", "ethereum"]
    assert {r.id for r in rows} == {10005}
    assert {r.created_at for r in rows} == {1577933872630}
    for r in rows:
        for f in ("sentiment_score", "sentiment_magnitude", "salience"):
            assert 0.0 <= getattr(r, f) < 1.0


def test_entity_sentiment_edge_cases(spark):
    extra = [
        '{"CreatedAt":1,"Id":1,"Text":"bitcoin bitcoin","Lang":"en","Retweet":false}',    # repeated entity
        '{"CreatedAt":2,"Id":2,"Text":"bitcoin, is up","Lang":"en","Retweet":false}',     # comma: no match
        '{"CreatedAt":3,"Id":3,"Text":"hola bitcoin","Lang":"es","Retweet":false}',       # translated
        '{"CreatedAt":4,"Id":4,"Text":"bitcoin","Retweet":false}',                         # null lang
        '{"CreatedAt":5,"Id":5,"Text":"bitcoin","Lang":"en"}',                             # null retweet
        '{"CreatedAt":6,"Id":6,"Text":"bitcoin"',                                          # malformed
    ]
    rows = apps.entity_sentiment(_lines(spark, extra)).collect()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.id, []).append(r)
    assert len(by_id[1]) == 2
    assert 2 not in by_id
    assert by_id[3][0].text == "Translated: hola bitcoin"
    assert set(by_id) == {1, 3}


# E3 ---------------------------------------------------------------------------------
# fixed sample values
PLAYERS = ['1|{"id": 1, "name": "Elyse"}', '2|{"id": 2, "name": "Mitch"}',
           '3|{"id": 3, "name": "Isabelle"}', '4|{"id": 4, "name": "Sammy"}']
PRODUCTS = ['1|{"id": 1, "name": "Super Smash Bros"}', '6|{"id": 6, "name": "Mario Kart"}']
SCORES = ['{"score": 1000, "product_id": 1, "player_id": 1}', '{"score": 2000, "product_id": 1, "player_id": 2}',
          '{"score": 4000, "product_id": 1, "player_id": 3}', '{"score": 500, "product_id": 1, "player_id": 4}',
          '{"score": 800, "product_id": 6, "player_id": 1}', '{"score": 2500, "product_id": 6, "player_id": 2}',
          '{"score": 9000.0, "product_id": 6, "player_id": 3}', '{"score": 1200.0, "product_id": 6, "player_id": 4}']


def _board(df):
    out = {}
    for r in df.orderBy("product_id", "rank").collect():
        out.setdefault(r.product_id, []).append((r.player_name, r.score))
    return out


def test_leaderboard(spark):
    b = apps.leaderboard(_lines(spark, SCORES, 100), _lines(spark, PLAYERS, 0), _lines(spark, PRODUCTS, 10))
    assert _board(b) == {
        1: [("Isabelle", 4000.0), ("Mitch", 2000.0), ("Elyse", 1000.0)],
        6: [("Isabelle", 9000.0), ("Mitch", 2500.0), ("Sammy", 1200.0)],
    }
    assert set(b.columns) >= {"player_id", "product_id", "player_name", "game_name", "score"}


def test_leaderboard_ties_arrival_and_asof(spark):
    players = _lines(spark, ['1|{"id": 1, "name": "Ann"}', '2|{"id": 2, "name": "Bo"}'], 0)
    # player 2 renamed between two scores; player 9 never exists (dropped for good)
    players = players.unionByName(_lines(spark, ['2|{"id": 2, "name": "Bob"}'], 5))
    products = _lines(spark, ['1|{"id": 1, "name": "G"}'], 1)
    scores = spark.createDataFrame([
        ('{"score": 50, "product_id": 1, "player_id": 1}', 2),
        ('{"score": 50, "product_id": 1, "player_id": 2}', 3),   # tie: earliest (Ann) stays
        ('{"score": 40, "product_id": 1, "player_id": 2}', 4),   # sees "Bo"
        ('{"score": 30, "product_id": 1, "player_id": 2}', 6),   # sees "Bob"
        ('{"score": 99, "product_id": 1, "player_id": 9}', 7),   # no player: dropped
        ('{"score": 10, "product_id": 1, "player_id": 1}', 8),
    ], "value string, seq long")
    assert _board(apps.leaderboard(scores, players, products)) == {
        1: [("Ann", 50.0), ("Bo", 40.0), ("Bob", 30.0)]}


# E4 ---------------------------------------------------------------------------------
def _pulse_lines():
    # fixed sample values: beats every half second, then a few later ones
    base = dt.datetime(2020, 11, 23, 9, 2, 0)
    offs = [i * 0.5 for i in range(120)] + [60.0, 60.5, 61.5, 62.5, 63.5, 64.5, 65.5]
    return ['1|{"timestamp": "%sZ"}' % (base + dt.timedelta(seconds=o)).isoformat(timespec="milliseconds")
            for o in offs]


# fixed sample values
TEMPS = ['1|{"timestamp": "2020-11-23T09:03:06.500Z", "temperature": 101.2, "unit": "F"}']


def test_pulse_counts_final_and_refining(spark):
    pulses = _lines(spark, _pulse_lines())
    final = [(r.window_start, r.heart_rate) for r in apps.pulse_counts(pulses, final=True).collect()]
    assert final == [(dt.datetime(2020, 11, 23, 9, 2), 120)]
    refining = sorted((r.window_start, r.heart_rate) for r in apps.pulse_counts(pulses, final=False).collect())
    assert refining == [(dt.datetime(2020, 11, 23, 9, 2), 120), (dt.datetime(2020, 11, 23, 9, 3), 7)]


def test_vitals_alert(spark):
    alerts = apps.vitals_alerts(_lines(spark, _pulse_lines()), _lines(spark, TEMPS, 1000)).collect()
    assert len(alerts) == 1
    a = alerts[0]
    assert a.heart_rate == 120
    assert (a.body_temp.temperature, a.body_temp.unit) == (101.2, "F")
    assert a.alert_ts == dt.datetime(2020, 11, 23, 9, 3, 6, 500000)


def test_vitals_no_alert_at_threshold(spark):
    t = ['1|{"timestamp": "2020-11-23T09:03:06.500Z", "temperature": 100.4, "unit": "F"}']
    assert apps.vitals_alerts(_lines(spark, _pulse_lines()), _lines(spark, t, 1000)).count() == 0


# E5 ---------------------------------------------------------------------------------
# fixed sample values
REPORTED = ['1|{"timestamp": "2020-11-23T09:02:00.000Z", "wind_speed_mph": 40, "power": "ON", "type": "REPORTED"}',
            '1|{"timestamp": "2020-11-23T09:02:00.500Z", "wind_speed_mph": 42, "power": "ON", "type": "REPORTED"}',
            '1|{"timestamp": "2020-11-23T09:02:01.000Z", "wind_speed_mph": 44, "power": "ON", "type": "REPORTED"}',
            '1|{"timestamp": "2020-11-23T09:02:01.000Z", "wind_speed_mph": 68, "power": "ON", "type": "REPORTED"}']
DESIRED = ['1|{"timestamp": "2020-11-23T09:12:00.000Z", "power": "ON", "type": "DESIRED"}']


def test_twin_changelog(spark):
    ch = apps.twin_changelog(_lines(spark, REPORTED), _lines(spark, DESIRED, 10)).orderBy("seq", "emit_idx").collect()
    assert len(ch) == 6
    after_reported = ch[4]
    assert tuple(after_reported.desired) == ("2020-11-23T09:02:01.000Z", 68.0, "OFF", "DESIRED")
    assert tuple(after_reported.reported) == ("2020-11-23T09:02:01.000Z", 68.0, "ON", "REPORTED")
    assert tuple(ch[5].desired) == ("2020-11-23T09:12:00.000Z", None, "ON", "DESIRED")


def test_twin_ttl(spark):
    rep, des = _lines(spark, REPORTED), _lines(spark, DESIRED, 10)
    only_desired = _lines(spark, ['2|{"timestamp": "2020-11-23T09:00:00.000Z", "power": "ON"}'], 20)
    des = des.unionByName(only_desired)
    keep = {r.key for r in apps.twin_store(rep, des, "2020-11-30T09:02:00Z").collect()}
    gone = {r.key for r in apps.twin_store(rep, des, "2020-11-30T09:02:01Z").collect()}
    assert keep == {"1", "2"}
    assert gone == {"2"}


def test_twin_high_wind_edges(spark):
    rep = _lines(spark, [
        '1|{"timestamp": "2020-11-23T09:00:00.000Z", "wind_speed_mph": 65, "power": "ON"}',   # exactly 65
        '2|{"timestamp": "2020-11-23T09:00:00.000Z", "wind_speed_mph": 70, "power": "OFF"}',  # already off
        '3|{"timestamp": "2020-11-23T09:00:00.000Z", "power": "ON"}',                         # null wind
    ])
    ch = apps.twin_changelog(rep, _lines(spark, [], 10).limit(0))
    assert ch.count() == 3
    assert ch.where(F.col("desired").isNotNull()).count() == 0


# E6 ---------------------------------------------------------------------------------
def _changes(spark):
    # fixed sample values: counts and times
    rows = [(12, 8, "2021-02-24 10:00:00"), (8, 10, "2021-02-24 11:00:00"), (10, 8, "2021-02-24 10:59:00"),
            (8, 12, "2021-02-24 11:10:00"), (12, 8, "2021-02-24 10:59:00")]
    data = [("1", 1, 1, "season_length", (1, b), (1, a), ts, 10 + i) for i, (b, a, ts) in enumerate(rows)]
    return spark.createDataFrame(data, "rowkey string, uuid int, title_id int, change_type string, "
                                       "before struct<season_id:int,episode_count:int>, "
                                       "after struct<season_id:int,episode_count:int>, created_at string, seq long")


def _titles(spark):
    # fixed sample values: the titles
    return spark.createDataFrame([(1, "Stranger Things", 0), (2, "Black Mirror", 1), (3, "Bojack Horseman", 2)],
                                 "id int, title string, seq long")


def test_change_counts(spark):
    out = {(r.key, r.window_start.hour): (r.change_count, r.episode_count, r.title)
           for r in apps.change_counts(_titles(spark), _changes(spark)).collect()}
    assert out == {("1|+|1", 10): (2, 8, "Stranger Things"), ("1|+|1", 11): (2, 12, "Stranger Things")}


def test_csas_ifnull_and_other_types(spark):
    ch = spark.createDataFrame([
        ("1", 1, 1, "season_length", (3, 5), None, "2021-02-24 10:00:00", 0),
        ("1", 2, 1, "release_date", (3, 5), (3, 6), "2021-02-24 10:00:00", 1),
    ], "rowkey string, uuid int, title_id int, change_type string, before struct<season_id:int,episode_count:int>, "
       "after struct<season_id:int,episode_count:int>, created_at string, seq long")
    rows = apps.season_length_changes(ch).collect()
    assert [(r.season_id, r.old_episode_count, r.new_episode_count) for r in rows] == [(3, 5, None)]
