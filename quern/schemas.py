"""Record types that sources and sinks agree on."""

from pyspark.sql import types as T

RAW_DOC = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)

SOURCE_DOC = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)

PLAIN_DOC = T.StructType([T.StructField("id", T.StringType()), T.StructField("text", T.StringType())])

PAGE = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)

FEEDBACK = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("prompt", T.StringType(), False),
        T.StructField("response", T.StringType(), False),
        T.StructField("rating", T.IntegerType(), False),
        T.StructField("tags", T.StringType(), False),
        T.StructField("notes", T.StringType(), False),
        T.StructField("created_at", T.StringType(), False),
    ]
)

EVAL_CASE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("prompt", T.StringType()),
        T.StructField("expected", T.StringType()),
        T.StructField("baseline", T.StringType()),
        T.StructField("candidate", T.StringType()),
        T.StructField("human_preference", T.StringType()),
    ]
)

SCORED_CASE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("question", T.StringType()),
        T.StructField("response", T.StringType()),
        T.StructField("reference", T.StringType()),
    ]
)

PREFERENCE_TASK = T.StructType(
    [
        T.StructField("prompt", T.StringType()),
        T.StructField("response_a", T.StringType()),
        T.StructField("response_b", T.StringType()),
    ]
)

PREFERENCE_ANSWER = T.StructType(
    [
        T.StructField("preference", T.StringType()),
        T.StructField("score", T.IntegerType()),
        T.StructField("reason", T.StringType()),
    ]
)
