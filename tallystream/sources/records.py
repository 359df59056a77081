"""Reading and writing of JSON and separated records, as batches or as streams."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tallystream.functions.scalars import join_fields, parse_bool, split_fields

# Message layouts.
GROUP_READING = "ip int, timestamp timestamp, nationality string, age int"
SENSOR_READING = "key string, value double, op int, sequenceNumber bigint"
EVENT = (
    "type string, data string, userId string, studentId string, courseId string, "
    "projectId string, allegato string, voto string"
)
USER_FIELDS = ["userId", "name", "email", "password", "role"]
COURSE_FIELDS = ["courseId", "name", "adminId", "isDeleted"]
PROJECT_FIELDS = ["projectId", "courseId", "profId"]
ENROLMENT_FIELDS = ["userId", "courseId"]


def load(
    spark: SparkSession,
    fmt: str,
    path: str | None = None,
    options: Mapping[str, str] | None = None,
    streaming: bool = False,
    schema: str | StructType | None = None,
) -> DataFrame:
    """Any Spark source: files by path, brokers (topic, servers, offsets) by options."""
    reader = (spark.readStream if streaming else spark.read).format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def parse_json(df: DataFrame, schema: str | StructType, payload: str = "value") -> DataFrame:
    """JSON payload to top-level columns. Malformed text and wrong types become nulls."""
    return df.select(F.from_json(F.col(payload).cast("string"), schema).alias("data")).select("data.*")


def read_json(
    spark: SparkSession,
    path: str | None,
    schema: str | StructType,
    streaming: bool = False,
    fmt: str = "text",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """One JSON object per line of a text source, or per message of a broker format."""
    return parse_json(load(spark, fmt, path, options, streaming), schema)


def read_sensor(spark: SparkSession, path: str | None, streaming: bool = False, **source) -> DataFrame:
    """(key, value, op, seq)."""
    return read_json(spark, path, SENSOR_READING, streaming, **source).withColumnRenamed("sequenceNumber", "seq")


def read_event_log(spark: SparkSession, path: str | None, streaming: bool = False, **source) -> DataFrame:
    """Tagged events as one sparse table; ``type`` says which fields are set."""
    log = read_json(spark, path, EVENT, streaming, **source)
    return log.select(
        "type",
        "data",
        F.coalesce("userId", "studentId").alias("user_id"),
        F.col("courseId").alias("course_id"),
        F.col("projectId").alias("project_id"),
        F.col("allegato").alias("attachment"),
        F.col("voto").try_cast("int").alias("grade"),
    )


def decode_csv(
    df: DataFrame, column: str, names: Sequence[str], types: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(good, quarantined): positional fields as columns, and the records with too few of them or
    with a text that is not of its type.

    Extra fields are ignored, and empty ones at the end do not count. ``types`` names Spark types;
    'boolean' follows ``parse_bool``, which takes any text.
    """
    types = types or ["string"] * len(names)
    enough = F.size(F.split(F.regexp_replace(column, ",+$", ""), ",", -1)) >= len(names)
    whole = F.coalesce(enough, F.lit(False))
    fields = []
    for raw, name, kind in zip(split_fields(column, names), names, types, strict=True):
        typed = parse_bool(raw) if kind == "boolean" else raw.try_cast(kind)
        whole = whole & typed.isNotNull()
        fields.append(typed.alias(name))
    others = [c for c in df.columns if c != column]
    return df.filter(whole).select(*others, *fields), df.filter(~whole)


def _message(**fields: str) -> Column:
    return F.to_json(F.struct(*[F.col(source).cast("string").alias(name) for name, source in fields.items()]))


def encode_events(df: DataFrame) -> DataFrame:
    """(topic, key, value) messages for a sparse log with the columns of ``read_event_log``
    plus ``subject`` ('user', 'course' or 'project'), which tells the topic.

    The key is the id the events of one thing have in common. A null field is left out.
    """
    ids = {"type": "type", "userId": "user_id", "courseId": "course_id", "projectId": "project_id"}
    kind, subject = F.col("type"), F.col("subject")
    seed = {k: v for k, v in ids.items() if k != "userId"} | {"studentId": "user_id"}
    value = (
        F.when(subject == "user", F.col("data"))
        .when(kind.isin("CREATE", "DELETE"), _message(type="type", data="data"))
        .when(kind == "ENROLL", _message(type="type", userId="user_id", courseId="course_id"))
        .when(kind == "SUBMIT", _message(**ids, allegato="attachment"))
        .when(kind == "RATE", _message(**ids, voto="grade"))
        .when(kind == "UPDATEMAP", _message(**seed))
        .otherwise(_message(**ids))
    )
    key = (
        F.when(subject == "user", F.col("user_id"))
        .when(kind.isin("CREATE", "DELETE"), F.when(subject == "course", F.col("course_id")).otherwise(F.col("project_id")))
        .when(kind == "UPDATEMAP", F.col("project_id"))
        .otherwise(F.col("user_id"))
    )
    topic = F.concat(subject, F.lit("-events"))
    return df.select(topic.alias("topic"), key.cast("string").alias("key"), value.alias("value"))


def encode_csv(df: DataFrame, fields: Sequence[str], column: str = "data") -> DataFrame:
    """Record text from columns, in the order of ``fields``."""
    return df.withColumn(column, join_fields(*fields))
