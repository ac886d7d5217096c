"""Column names and the ratings schema shared by every operator."""

from pyspark.sql import types as T

USER = "user_id"
ITEM = "item_id"
RATING = "rating"

RATINGS_SCHEMA = T.StructType([
    T.StructField(USER, T.LongType(), False),
    T.StructField(ITEM, T.LongType(), False),
    T.StructField(RATING, T.DoubleType(), False),
])
