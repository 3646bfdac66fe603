"""Declared schemas (D7) of the six reference flows, as Spark StructTypes."""

from pyspark.sql import types as T

# Tweet as read (other fields are dropped by the schema), wire names UpperCamel
TWEET = T.StructType([
    T.StructField("CreatedAt", T.LongType()),
    T.StructField("Id", T.LongType()),
    T.StructField("Lang", T.StringType()),
    T.StructField("Retweet", T.BooleanType()),
    T.StructField("Text", T.StringType()),
])

ENTITY_SENTIMENT = T.StructType([
    T.StructField("created_at", T.LongType()),
    T.StructField("id", T.LongType()),
    T.StructField("entity", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("sentiment_score", T.DoubleType()),
    T.StructField("sentiment_magnitude", T.DoubleType()),
    T.StructField("salience", T.DoubleType()),
])

# E3
SCORE_EVENT = T.StructType([
    T.StructField("score", T.DoubleType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("player_id", T.LongType()),
])
PLAYER = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
PRODUCT = PLAYER

# E4
PULSE = T.StructType([T.StructField("timestamp", T.StringType())])
BODY_TEMP = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("unit", T.StringType()),
])

# E5
TURBINE_STATE = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("wind_speed_mph", T.DoubleType()),
    T.StructField("power", T.StringType()),
    T.StructField("type", T.StringType()),
])

# E6
SEASON_LENGTH = T.StructType([
    T.StructField("season_id", T.IntegerType()),
    T.StructField("episode_count", T.IntegerType()),
])
TITLES = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("title", T.StringType())])
PRODUCTION_CHANGES = T.StructType([
    T.StructField("rowkey", T.StringType()),
    T.StructField("uuid", T.IntegerType()),
    T.StructField("title_id", T.IntegerType()),
    T.StructField("change_type", T.StringType()),
    T.StructField("before", SEASON_LENGTH),
    T.StructField("after", SEASON_LENGTH),
    T.StructField("created_at", T.StringType()),
])
