"""The nested staging table, derived from flat star-schema tables."""

from __future__ import annotations

import hashlib
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titlemart.schema import titles_schema
from titlemart.session import folder_size, shared_dir

_STAGING = threading.Lock()
SHARE = 4 << 20  # bytes of the lines' files whose rows one task collects, so that it holds them at any size of the input


def star_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def titles_from_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested title per order; its lines give the arrays.

    Lines are laid by order before the distinct ones of each are collected: an aggregation
    before the shuffle would combine nearly nothing, as a task sees few lines of one order, and
    hold all it reads. Their partitions grow in number with the input. Nation and region come
    after the shuffle and the customer before the lines, so that what is shuffled is narrow.
    Every dimension is joined by itself: Catalyst knows the size of its file and broadcasts it
    or not, which it could not tell of a join of two.
    """
    table = lambda name: star_table(spark, sf_dir, name)
    n = max(spark.sparkContext.defaultParallelism, folder_size(spark, f"{sf_dir}/lineitem.parquet") // SHARE + 1)
    lines = (
        table("lineitem")
        .join(table("part"), F.col("l_partkey") == F.col("p_partkey"), "left")
        .join(table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .select(
            "l_orderkey", "l_discount", "l_linenumber", "l_quantity", "l_extendedprice",
            "p_size", "p_type", "s_suppkey", "s_name", "s_nationkey", "s_acctbal",
        )
        .repartition(n, "l_orderkey")
        .join(table("nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .join(table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    )
    line = F.struct(
        F.nullif(F.col("p_size") % 7, F.lit(0)).cast("bigint").alias("genre_id"),
        "p_type", "s_suppkey", "s_name", "n_nationkey", "n_name", "r_regionkey", "r_name",
        (F.col("s_acctbal") >= 3000).alias("listed"),
    )
    per_order = lines.groupBy("l_orderkey").agg(
        F.max("l_discount").alias("vote_average"),
        F.count(F.lit(1)).alias("vote_count"),
        F.max("l_linenumber").cast("bigint").alias("runtime"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("budget"),
        F.sum(F.floor("l_extendedprice").cast("bigint")).alias("revenue"),
        F.collect_set(line).alias("lines"),
    )
    entries = {
        "genres": lambda e: F.struct(e["genre_id"].alias("id"), e["p_type"].alias("name")),
        "production_companies": lambda e: F.struct(
            e["s_suppkey"].alias("id"),
            F.lit(None).cast("string").alias("logo_path"),
            e["s_name"].alias("name"),
            e["n_name"].alias("origin_country"),
        ),
        "production_countries": lambda e: F.struct(
            F.concat(F.lit("N"), e["n_nationkey"].cast("string")).alias("iso_3166_1"),
            e["n_name"].alias("name"),
        ),
        "spoken_languages": lambda e: F.struct(
            e["r_regionkey"].cast("string").alias("iso_639_1"), e["r_name"].alias("name")
        ),
    }
    sources = dict.fromkeys(entries, F.col("lines"))
    sources["production_companies"] = F.filter("lines", lambda e: e["listed"])
    arrays = {
        name: F.coalesce(F.array_distinct(F.transform(sources[name], entry)), F.array())
        for name, entry in entries.items()
    }
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    customer_id = F.col("c_custkey").cast("string")
    collection = F.struct(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.when(
            F.col("c_nationkey") % 5 != 0, F.concat(F.lit("/c"), customer_id, F.lit(".jpg"))
        ).alias("poster_path"),
        F.concat(F.lit("/c"), customer_id, F.lit("-b.jpg")).alias("backdrop_path"),
    )
    image = F.when(status != "P", F.concat(F.lit("/"), key.cast("string"), F.lit(".jpg")))
    shaped = (
        table("orders")
        .join(table("customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(per_order, key == F.col("l_orderkey"), "left")
        .withColumns(arrays)
        .withColumns(
            {
                "adult": F.lit(False),
                "backdrop_path": image,
                "poster_path": image,
                "belongs_to_collection": F.when(
                    F.col("c_mktsegment") != "MACHINERY", F.array(collection)
                ).otherwise(F.array()),
                "homepage": F.lit(None).cast("string"),
                "tagline": F.lit(None).cast("string"),
                "id": key,
                "imdb_id": F.concat(F.lit("i"), key.cast("string")),
                "title": F.concat(F.lit("T"), key.cast("string")),
                "original_title": F.concat(F.lit("T"), key.cast("string")),
                "original_language": F.col("o_orderpriority"),
                "overview": F.col("o_orderpriority"),
                "popularity": F.col("o_totalprice"),
                "release_date": F.col("o_orderdate").cast("date"),
                "status": F.when(status == "F", "Released").otherwise(status),
                "video": status == "O",
            }
        )
    )
    return shaped.select(*[F.col(f.name).cast(f.dataType) for f in titles_schema().fields])


def staged_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging table, written once per application and scanned by all marts."""
    path = f"{shared_dir(spark)}/titles-{hashlib.md5(sf_dir.encode()).hexdigest()[:12]}"
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    with _STAGING:
        if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
            titles_from_star(spark, sf_dir).write.mode("overwrite").parquet(path)
    return spark.read.schema(titles_schema()).parquet(path)
