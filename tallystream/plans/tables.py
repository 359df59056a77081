"""The driver tables in the shapes the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor readings: key, seq, value, op, ts. Every 50th event is a fault message."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("key"),
        F.col("event_id").alias("seq"),
        "value",
        F.when(F.col("event_id") % 50 == 0, 3).otherwise(0).alias("op"),
        "ts",
    )


def membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(member, grp): the nation of each customer."""
    nation = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))  # 25 rows
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("c_custkey").alias("member"), F.col("n_name").alias("grp"))
    )


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return membership(spark, sf_dir).select(
        F.col("member").alias("device"),
        (F.col("member") % 60 + 18).cast("int").alias("age"),
        F.col("grp").alias("nationality"),
    )


def entities(spark: SparkSession, sf_dir: str, shift: float = 0.0) -> DataFrame:
    def component(i: int):
        return F.element_at("embedding", i).cast("double")

    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        *[(component(i + 1) + shift).alias(a) for i, a in enumerate("xyz")],
        F.struct(*[component(i + 4).alias(a) for i, a in enumerate("xyz")]).alias("speed"),
        F.col("label").cast("long").alias("size"),
    )


def _day(c: str):
    return F.unix_date(F.to_date(c)).cast("long")


def role_of(user):
    return (
        F.when(user % 10 == 0, "PROFESSOR").when(user % 10 == 9, "ADMIN").otherwise("STUDENT")
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("email"),
        role_of(F.col("c_custkey")).alias("role"),
    )


def user_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First registrations from customer, later ones (changed name and mail) from orders."""
    first = users(spark, sf_dir).select("*", F.lit(0).cast("long").alias("seq"), F.lit(-1).cast("long").alias("tie"))
    again = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderstatus").alias("email"),
        role_of(F.col("o_custkey")).alias("role"),
        _day("o_orderdate").alias("seq"),
        F.col("o_orderkey").alias("tie"),
    )
    return first.unionByName(again)


def offer_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Course life cycles: a supplier is a course, its lineitems create, delete or fill it."""
    n = F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        F.when(n == 1, "CREATE").when(n == 2, "DELETE").otherwise("ENROLL").alias("type"),
        F.col("l_suppkey").alias("course_id"),
        F.concat(F.lit("course "), F.col("l_partkey").cast("string")).alias("name"),
        F.col("l_orderkey").alias("admin_id"),
        F.col("l_partkey").alias("user_id"),
        _day("l_shipdate").alias("seq"),
        F.col("l_orderkey").alias("okey"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("pkey"),
        F.col("l_extendedprice").alias("price"),
    )


OFFER_ORDER = ["seq", "okey", "line", "pkey", "price"]


def campus_courses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One course per order priority; one of them has been deleted."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias("course_id"))
        .agg(F.max("o_orderstatus").alias("name"), F.min("o_custkey").alias("admin_id"))
        .withColumn("is_deleted", F.col("course_id").contains("NOT"))
    )


def course_life(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CREATE and DELETE events: every course is made anew each year, one ends with its last order."""
    log = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("course_id"), _day("o_orderdate").alias("seq"), F.year("o_orderdate").alias("year")
    )
    years = log.groupBy("course_id", "year").agg(F.min("seq").alias("seq"), F.max("seq").alias("last"))
    turns = F.array(F.struct(F.lit("DELETE").alias("type"), F.lit(-2).alias("rank")), F.struct(F.lit("CREATE").alias("type"), F.lit(-1).alias("rank")))
    anew = years.select("course_id", "seq", F.inline(turns))
    ended = years.filter(F.col("course_id").contains("NOT")).groupBy("course_id").agg(F.max("last").alias("seq"))
    return anew.unionByName(ended.select("course_id", "seq", F.lit("DELETE").alias("type"), F.lit(9).alias("rank")))


def enrol_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.lit("ENROLL").alias("type"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderpriority").alias("course_id"),
        _day("o_orderdate").alias("seq"),
    )


def _order_lines(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", *columns)
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def work_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SUBMIT (open lines) and RATE (finished lines) events of students."""
    submit = F.col("l_linestatus") == "O"
    return _order_lines(spark, sf_dir, "l_linestatus", "l_quantity", "l_shipdate").select(
        F.when(submit, "SUBMIT").otherwise("RATE").alias("type"),
        F.col("o_custkey").alias("student"),
        F.col("o_orderpriority").alias("course"),
        F.col("l_returnflag").alias("project"),
        _day("l_shipdate").alias("seq"),
        F.when(submit, 1).otherwise(0).alias("rank"),
        F.col("l_quantity").cast("int").alias("grade"),
    )


WORK_ORDER = ["seq", "rank", "grade"]


def project_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CREATE events of projects; the flags come up 400 days apart."""
    late = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 400).otherwise(800)
    return _order_lines(spark, sf_dir, "l_suppkey", "l_shipdate").select(
        F.col("o_orderpriority").alias("course"),
        F.col("l_returnflag").alias("project"),
        (F.col("l_suppkey") * 10).alias("prof_id"),
        (_day("l_shipdate") + late).alias("seq"),
    )


PROJECT_ORDER = ["seq", "prof_id"]


def campus_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events of the campus in one order: turns of courses, projects, enrolments, work."""

    def part(log: DataFrame, kind: str | None, rank, turn: int) -> DataFrame:
        return log.withColumns({"type": F.lit(kind) if kind else F.col("type"), "rank": rank, "turn": F.lit(turn)})

    turns = course_life(spark, sf_dir).withColumnRenamed("course_id", "course")
    made = project_log(spark, sf_dir)
    joined = enrol_log(spark, sf_dir).select(F.col("user_id").alias("student"), F.col("course_id").alias("course"), "seq").distinct()
    log = part(turns, None, F.col("rank"), 0)
    for other in (part(made, "PROJECT", F.lit(0), 1), part(joined, "ENROLL", F.lit(0), 2), part(work_log(spark, sf_dir), None, F.col("rank"), 3)):
        log = log.unionByName(other, allowMissingColumns=True)
    return log.select("type", "course", "student", "project", *CAMPUS_ORDER)


CAMPUS_ORDER = ["seq", "rank", "turn", "grade", "prof_id"]
