"""Fixed schemas: raw chat records, the cleaned fact table, annotations, topic updates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURNS = T.ArrayType(
    T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
)

RAW = T.StructType(
    [
        T.StructField("conversation_hash", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("hashed_ip", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("turn", T.IntegerType()),
        T.StructField("conversation", TURNS),
    ]
)

FACT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("model_release_date", T.DateType()),
        T.StructField("model_family", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("hashed_ip", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("turn_count", T.IntegerType()),
        T.StructField("token_count", T.IntegerType()),
        T.StructField("topic", T.StringType()),
        T.StructField("search_text", T.StringType()),
        T.StructField("first_turn", T.StringType()),
        T.StructField("full_content", T.StringType()),
    ]
)

ANNOTATION = T.StructType(
    [
        T.StructField("prompt_preview", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)

TOPIC_UPDATE = T.StructType(
    [T.StructField("id", T.StringType()), T.StructField("new_topic", T.StringType())]
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns by name, cast, with absent ones as NULL."""

    def field(f: T.StructField) -> Column:
        source = F.col(f.name) if f.name in df.columns else F.lit(None)
        return source.cast(f.dataType).alias(f.name)

    return df.select(*[field(f) for f in schema.fields])
