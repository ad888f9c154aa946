"""Reading records, annotations and JSON folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.schemas import ANNOTATION, RAW

TOPIC_INFO = T.StructType(
    [
        T.StructField("topic_id", T.IntegerType()),
        T.StructField("count", T.LongType()),
        T.StructField("name", T.StringType()),
    ]
)


def read_raw(
    spark: SparkSession, path: str, streaming: bool = False, files_per_trigger: int | None = None
) -> DataFrame:
    """Raw chat records from Parquet, as a table or as a stream."""
    if not streaming:
        return spark.read.schema(RAW).parquet(path)
    reader = spark.readStream.schema(RAW)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """Annotation CSV; only an empty field is NULL, the text ``None`` stays text."""
    return _csv(spark, path, ANNOTATION)


def read_topic_info(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, TOPIC_INFO)


def _csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    options = {"header": True, "multiLine": True, "escape": '"', "nullValue": ""}
    return spark.read.schema(schema).options(**options).csv(path)


def json_list_items(spark: SparkSession, path: str) -> DataFrame:
    """``(file, position, item)`` of a folder of files that each hold a list of objects."""
    files = (
        spark.read.option("multiLine", True)
        .option("singleVariantColumn", "content")
        .json(path)
        .select("content", F.col("_metadata.file_name").alias("file"))
    )
    return files.lateralJoin(
        spark.tvf.variant_explode(F.col("content").outer())
    ).select("file", F.col("pos").cast("long").alias("position"), F.to_json("value").alias("item"))


def profile_json_items(
    items: DataFrame, group: str = "file", order: str = "position", item: str = "item"
) -> DataFrame:
    """Per group: number of items, keys of the first item, the first item itself."""
    first = F.min_by(item, order)
    return (
        items.groupBy(group)
        .agg(F.count(F.lit(1)).alias("num_items"), first.alias("first_item"))
        .select(
            group,
            "num_items",
            F.array_join(F.json_object_keys("first_item"), ", ").alias("keys"),
            "first_item",
        )
    )


def profile_json(spark: SparkSession, path: str) -> DataFrame:
    """What the JSON files of a folder look like, one row per file."""
    return profile_json_items(json_list_items(spark, path)).orderBy("file")
