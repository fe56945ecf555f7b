"""Loads from text and columnar files, written from the given tables first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlemart.plans.staging import staged_titles, star_table
from titlemart.schema import titles_schema
from titlemart.session import shared_path
from titlemart.sinks import export_table
from titlemart.sources import create_external_table, load_files

STATUS = "o_orderstatus"
JSON = "NEWLINE_DELIMITED_JSON"


def _files(df: DataFrame, export_format: str, **options) -> str:
    path = shared_path(df.sparkSession, "files")
    export_table(df, path, export_format, **options)
    return path


def _lines(df: DataFrame, line: Column) -> str:
    path = shared_path(df.sparkSession, "lines")
    df.select(line.alias("value")).write.text(path)
    return path


def _csv_line(*columns: str) -> Column:
    return F.concat_ws("|", *[F.col(c).cast("string") for c in columns])


def json_load(spark, sf_dir):
    lines = star_table(spark, sf_dir, "lineitem")
    return load_files(
        spark, _files(lines, "NEWLINE_DELIMITED_JSON"), lines.schema, "NEWLINE_DELIMITED_JSON"
    ).rows


def json_autodetect(spark, sf_dir):
    customers = star_table(spark, sf_dir, "customer")
    path = _files(customers, "NEWLINE_DELIMITED_JSON")
    return load_files(spark, path, None, "NEWLINE_DELIMITED_JSON", autodetect=True).rows


def json_load_field_list(spark, sf_dir):
    """The schema as a list of fields, as it comes in files."""
    fields = [
        {"name": "o_orderkey", "type": "INTEGER", "mode": "REQUIRED"},
        {"name": "o_orderstatus", "type": "STRING"},
        {"name": "o_totalprice", "type": "FLOAT"},
        {"name": "o_orderdate", "type": "DATETIME", "mode": "NULLABLE"},
    ]
    orders = star_table(spark, sf_dir, "orders").select(*[f["name"] for f in fields])
    return load_files(spark, _files(orders, JSON), fields, JSON).rows


def json_autodetect_budget(spark, sf_dir):
    """Broken lines among those the schema is detected from."""
    customers = star_table(spark, sf_dir, "customer")
    line = F.to_json(F.struct(*customers.columns))
    broken = F.when(F.col("c_custkey") % 7 == 0, F.substring(line, 1, 12)).otherwise(line)
    return load_files(
        spark, _lines(customers, broken), None, JSON, autodetect=True, max_bad_records=customers.count()
    ).rows


def csv_autodetect_skip_rows(spark, sf_dir):
    return load_files(spark, _titled(spark, sf_dir), None, "CSV", autodetect=True, skip_leading_rows=2).rows


def _headed(df: DataFrame, head: str, separator: str) -> str:
    """CSV files of ``df``, with the lines of ``head`` on top of each."""
    path = shared_path(df.sparkSession, "headed")

    def headed(batches):
        import pandas as pd

        for number, batch in enumerate(batches):
            if number == 0:
                yield pd.DataFrame({"value": [head]})
            yield batch

    line = F.concat_ws(separator, *[F.col(c).cast("string") for c in df.columns])
    df.select(line.alias("value")).mapInPandas(headed, "value string").write.text(path)
    return path


def _titled(spark, sf_dir) -> str:
    """Suppliers below a title line and a header."""
    suppliers = star_table(spark, sf_dir, "supplier")
    return _headed(suppliers, "All suppliers\n" + ",".join(suppliers.columns), ",")


def external_csv_autodetect_skip(spark, sf_dir):
    return create_external_table(
        spark, "suppliers_outside", _titled(spark, sf_dir), "CSV", autodetect=True, skip_leading_rows=2
    )


def external_csv_jagged(spark, sf_dir):
    """Two folders as one table, with short rows allowed."""
    orders, path = _jagged(spark, sf_dir)
    _, other = _jagged(spark, sf_dir)
    table = create_external_table(
        spark, "orders_jagged", [path, other], "CSV", orders.schema, field_delimiter="|", allow_jagged_rows=True
    )
    return table.groupBy(*orders.columns).agg(F.count(F.lit(1)).alias("n"))


def parquet_required(spark, sf_dir):
    """A Parquet column made REQUIRED and whole-numbered; what does not fit is refused."""
    orders = star_table(spark, sf_dir, "orders")
    kept = F.when(F.col(STATUS) != "P", F.when(F.col(STATUS) == "O", "x").otherwise(F.col("o_custkey").cast("string")))
    path = shared_path(spark, "typed")
    orders.select("o_orderkey", kept.alias("o_custkey")).write.parquet(path)
    fields = [{"name": "o_orderkey", "type": "INTEGER"}, {"name": "o_custkey", "type": "INTEGER", "mode": "REQUIRED"}]
    loaded = load_files(spark, path, fields, "PARQUET", max_bad_records=orders.count())
    good = loaded.rows.agg(F.lit("good").alias("reason"), F.count(F.lit(1)).alias("n"))
    return good.unionByName(loaded.rejected.groupBy(F.col("_reason").alias("reason")).agg(F.count(F.lit(1)).alias("n")))


def json_lenient_titles(spark, sf_dir):
    """Titles as files give them: numbers in quotes, empty dates, one object for
    an array of one."""
    titles = staged_titles(spark, sf_dir)
    quoted = titles.withColumns(
        {
            "revenue": F.col("revenue").cast("string"),
            "release_date": F.when(F.col("video"), "").otherwise(F.col("release_date").cast("string")),
            "belongs_to_collection": F.get("belongs_to_collection", F.lit(0)),
        }
    )
    path = _files(quoted, "NEWLINE_DELIMITED_JSON")
    rows = load_files(spark, path, titles_schema(), "NEWLINE_DELIMITED_JSON").rows
    return rows.select(
        "id", "title", "revenue", "release_date", "popularity",
        F.get("belongs_to_collection.id", F.lit(0)).alias("collection_id"),
        F.size("genres").cast("bigint").alias("n_genres"),
    )


def bad_record_budget(spark, sf_dir):
    """Broken, mistyped and good JSON records under a budget that covers them."""
    orders = star_table(spark, sf_dir, "orders").select("o_orderkey", STATUS, "o_totalprice")
    line = F.to_json(F.struct(*orders.columns))
    broken = F.when(F.col(STATUS) == "P", F.substring(line, 1, 20)).when(
        F.col(STATUS) == "O", F.regexp_replace(line, '"o_totalprice":', '"o_totalprice":"x",  "ignored":')
    ).otherwise(line)
    loaded = load_files(
        spark, _lines(orders, broken), orders.schema, "NEWLINE_DELIMITED_JSON",
        max_bad_records=orders.count(), ignore_unknown_values=True,
    )
    good = loaded.rows.groupBy().agg(F.lit("good").alias("reason"), F.count(F.lit(1)).alias("n"))
    bad = loaded.rejected.groupBy(F.col("_reason").alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    return good.unionByName(bad)


def _with_extra(spark, sf_dir):
    orders = star_table(spark, sf_dir, "orders").select("o_orderkey", STATUS)
    extra = F.when(F.col(STATUS) == "P", F.col("o_orderkey"))
    return orders, _lines(orders, F.to_json(F.struct(*orders.columns, extra.alias("zzz"))))


def unknown_fields_strict(spark, sf_dir):
    orders, path = _with_extra(spark, sf_dir)
    return load_files(
        spark, path, orders.schema, "NEWLINE_DELIMITED_JSON", max_bad_records=orders.count()
    ).rows


def unknown_fields_ignored(spark, sf_dir):
    orders, path = _with_extra(spark, sf_dir)
    return load_files(
        spark, path, orders.schema, "NEWLINE_DELIMITED_JSON", ignore_unknown_values=True
    ).rows


def csv_load(spark, sf_dir):
    lines = star_table(spark, sf_dir, "lineitem")
    path = _files(lines, "CSV", field_delimiter="|")
    return load_files(
        spark, path, lines.schema, "CSV", field_delimiter="|", skip_leading_rows=1
    ).rows


def csv_autodetect(spark, sf_dir):
    suppliers = star_table(spark, sf_dir, "supplier")
    path = _files(suppliers, "CSV")
    return load_files(spark, path, None, "CSV", autodetect=True, skip_leading_rows=1).rows


def csv_quoted_newlines(spark, sf_dir):
    documents = star_table(spark, sf_dir, "documents")
    path = _files(documents, "CSV", print_header=False)
    rows = load_files(
        spark, path, documents.schema, "CSV", allow_quoted_newlines=True
    ).rows
    return rows.withColumn("text", F.md5("text"))


def csv_quoted_newlines_split(spark, sf_dir):
    """Files below a heading of two records of which one has a line break, each read as many blocks."""
    documents = star_table(spark, sf_dir, "documents")
    cells = [F.concat(F.lit('"'), F.replace(F.col(c).cast("string"), F.lit('"'), F.lit('""')), F.lit('"')) for c in documents.columns]
    line = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in cells])
    # a file per task that reads the table, as no task holds it all
    path = _headed(documents.select(line.alias("value")), '"All\ndocuments",,,,\n' + ",".join(documents.columns), ",")
    block = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        rows = load_files(spark, path, documents.schema, "CSV", allow_quoted_newlines=True, skip_leading_rows=2).rows
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    n = rows.count()
    return rows.withColumn("text", F.md5("text")).withColumn("n", F.lit(n).cast("bigint"))


def _jagged(spark, sf_dir):
    orders = star_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", STATUS)
    line = F.when(F.col(STATUS) == "P", _csv_line("o_orderkey", "o_custkey")).otherwise(
        _csv_line("o_orderkey", "o_custkey", STATUS)
    )
    return orders, _lines(orders, line)


def csv_jagged(spark, sf_dir):
    orders, path = _jagged(spark, sf_dir)
    return load_files(
        spark, path, orders.schema, "CSV", field_delimiter="|", allow_jagged_rows=True
    ).rows


def csv_jagged_refused(spark, sf_dir):
    orders, path = _jagged(spark, sf_dir)
    return load_files(
        spark, path, orders.schema, "CSV", field_delimiter="|", max_bad_records=orders.count()
    ).rows


def csv_skip_rows(spark, sf_dir):
    """Three leading rows in every file, put there by each writing task."""
    orders = star_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", STATUS)
    path = _headed(orders, "\n".join(["h1", "h2|x", "o_orderkey|o_custkey|o_orderstatus"]), "|")
    return load_files(
        spark, path, orders.schema, "CSV", field_delimiter="|", skip_leading_rows=3
    ).rows


def gzip_load(spark, sf_dir):
    parts = star_table(spark, sf_dir, "part")
    path = _files(parts, "CSV", compression="gzip")
    return load_files(spark, path, parts.schema, "CSV", skip_leading_rows=1).rows


def parquet_load(spark, sf_dir):
    return load_files(spark, f"{sf_dir}/customer.parquet", None, "PARQUET", autodetect=True).rows


def external_csv(spark, sf_dir):
    orders = star_table(spark, sf_dir, "orders")
    path = _files(orders, "CSV", field_delimiter=";")
    spark.sql("DROP TABLE IF EXISTS orders_outside")
    table = create_external_table(
        spark, "orders_outside", path, "CSV", orders.schema,
        skip_leading_rows=1, field_delimiter=";",
    )
    return table.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.max("o_orderdate").alias("last_day")
    )


def external_parquet(spark, sf_dir):
    spark.sql("DROP TABLE IF EXISTS parts_outside")
    create_external_table(
        spark, "parts_outside", f"{sf_dir}/part.parquet", "PARQUET", autodetect=True
    )
    return spark.sql("SELECT p_brand, count(*) AS n FROM parts_outside GROUP BY p_brand")


QUERIES = {
    "json_load": json_load,
    "json_autodetect": json_autodetect,
    "json_load_field_list": json_load_field_list,
    "json_autodetect_budget": json_autodetect_budget,
    "csv_autodetect_skip_rows": csv_autodetect_skip_rows,
    "external_csv_autodetect_skip": external_csv_autodetect_skip,
    "external_csv_jagged": external_csv_jagged,
    "parquet_required": parquet_required,
    "json_lenient_titles": json_lenient_titles,
    "bad_record_budget": bad_record_budget,
    "unknown_fields_strict": unknown_fields_strict,
    "unknown_fields_ignored": unknown_fields_ignored,
    "csv_load": csv_load,
    "csv_autodetect": csv_autodetect,
    "csv_quoted_newlines": csv_quoted_newlines,
    "csv_quoted_newlines_split": csv_quoted_newlines_split,
    "csv_jagged": csv_jagged,
    "csv_jagged_refused": csv_jagged_refused,
    "csv_skip_rows": csv_skip_rows,
    "gzip_load": gzip_load,
    "parquet_load": parquet_load,
    "external_csv": external_csv,
    "external_parquet": external_parquet,
}

ORACLES = {
    "json_load": "SELECT * FROM lineitem",
    "json_autodetect": """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment
FROM customer""",
    "json_load_field_list": "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders",
    "json_autodetect_budget": """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment
FROM customer WHERE c_custkey % 7 <> 0""",
    "csv_autodetect_skip_rows": """
SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""",
    "external_csv_autodetect_skip": """
SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""",
    "external_csv_jagged": """
SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus, 2 * count(*) AS n
FROM orders GROUP BY ALL""",
    "parquet_required": """
SELECT CASE o_orderstatus WHEN 'P' THEN 'no value for o_custkey' WHEN 'O' THEN 'bad value' ELSE 'good' END
         AS reason, count(*) AS n FROM orders GROUP BY 1""",
    "json_lenient_titles": """
WITH line AS (
  SELECT l_orderkey, count(DISTINCT (coalesce(nullif(p_size % 7, 0), -1), p_type)) AS n_genres,
         CAST(sum(CAST(floor(l_extendedprice) AS BIGINT)) AS BIGINT) - 0 AS lines_revenue
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey
)
SELECT o_orderkey AS id, 'T' || o_orderkey AS title, lines_revenue AS revenue,
       CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) END AS release_date,
       o_totalprice AS popularity,
       CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_custkey END AS collection_id,
       coalesce(n_genres, 0) AS n_genres
FROM orders LEFT JOIN line ON o_orderkey = l_orderkey LEFT JOIN customer ON o_custkey = c_custkey""",
    "bad_record_budget": """
SELECT CASE o_orderstatus WHEN 'P' THEN 'malformed' WHEN 'O' THEN 'bad value' ELSE 'good' END
         AS reason, count(*) AS n FROM orders GROUP BY 1""",
    "unknown_fields_strict": """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'""",
    "unknown_fields_ignored": "SELECT o_orderkey, o_orderstatus FROM orders",
    "csv_load": "SELECT * FROM lineitem",
    "csv_autodetect": """
SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""",
    "csv_quoted_newlines": "SELECT doc_id, md5(text) AS text, lang, source, n_chars FROM documents",
    "csv_quoted_newlines_split": """
SELECT doc_id, md5(text) AS text, lang, source, n_chars, (SELECT count(*) FROM documents) AS n FROM documents""",
    "csv_jagged": """
SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus FROM orders""",
    "csv_jagged_refused": """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'""",
    "csv_skip_rows": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders",
    "gzip_load": "SELECT * FROM part",
    "parquet_load": "SELECT * FROM customer",
    "external_csv": """
SELECT o_orderstatus, count(*) AS n, max(o_orderdate) AS last_day FROM orders GROUP BY 1""",
    "external_parquet": "SELECT p_brand, count(*) AS n FROM part GROUP BY 1",
}
