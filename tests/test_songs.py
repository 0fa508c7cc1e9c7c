from pyspark.sql import functions as F

from riffle.plans import songs as G
from riffle.session import dealt, materialize


def parts(spark):
    rows = spark.createDataFrame([(1, 1, 10), (2, 1, 11), (3, 2, 10), (4, None, 10), (5, 9, None)], "id int, song_id int, msno int")
    songs = spark.createDataFrame(
        [(1, 100, "a and b", "c", "l", "17.0", "g"), (1, 300, "a and b", "c", "l", "17.0", "g"), (2, None, None, None, None, "3.0", None)],
        "song_id int, song_length int, artist_name string, composer string, lyricist string, language string, genre_ids string",
    )
    members = spark.createDataFrame([(10, 1, None, None)], "msno int, city int, registration_init_time date, expiration_date date")
    codes = spark.createDataFrame([(1, "USABC1700001"), (2, None)], "song_id int, isrc string")
    return rows, members, songs, codes


def test_plays_of_repeated_null_and_unknown_songs(spark):
    rows, *dims = parts(spark)
    out = G.song_features(rows, rows.filter("id < 4"), rows.filter("id >= 4"), *dims, explode=False)
    got = sorted((r.id, r.song_length, r.smaller_song, r.count_song_played, r.count_artist_played) for r in out.collect())
    # train: two lines of song 1, each with both of its rows, and one of song 2, which has neither length nor artist
    mean = (100 * 2 + 300 * 2 + 200_000) / 5
    short = {n: int(n < mean) for n in (100, 300, 200_000)}
    assert got == [
        (1, 100, short[100], 4, 4), (1, 300, short[300], 4, 4), (2, 100, short[100], 4, 4), (2, 300, short[300], 4, 4),
        (3, 200_000, short[200_000], 1, 1), (4, 200_000, short[200_000], 0, 1), (5, 200_000, short[200_000], 1, 1),
    ]


def test_facts_move_once_for_songs_and_codes(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = G.joined_facts(*parts(spark))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plan.count("Exchange hashpartitioning") == 5  # members, songs, codes, and the facts twice


def test_large_tables_are_dealt_to_more_tasks(spark):
    df = materialize(spark.range(1000).withColumn("k", F.col("id") % 7))
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert dealt(df, "k") is df
    assert dealt(df, "k", bytes_per_task=64).rdd.getNumPartitions() > most
    assert dealt(df, "k", bytes_per_task=64).count() == 1000
