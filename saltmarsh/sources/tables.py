"""Schemas and readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scale import running
from ..session import cut_lineage

# Columns of the input tables, given so that a read needs no footer job.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: str, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """CSV with a header row; blanks become NULL and dates parse by ``date_format``."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("dateFormat", date_format)
        .option("nullValue", "")
        .csv(path)
    )


def read_json(spark: SparkSession, path: str, schema: str, array_file: bool = False) -> DataFrame:
    """JSON lines, or one array of objects per file with ``array_file``."""
    return spark.read.schema(schema).option("multiLine", array_file).json(path)


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Objects of files that each hold one array of them (or several, one after the other), split over many tasks.

    The text source cuts files at every closing brace, as it would at line ends. Running sums over the pieces of a file, in
    two levels, tell whether a piece begins inside a string (odd number of quotes before), how deep it lies, and to which
    object it belongs; an object is put together from its pieces and parsed. Escapes never span a piece, as no escape ends in
    a brace. An object that is not closed and elements other than objects are not returned; an object that does not fit the schema
    has NULL columns. Empty files and arrays give no rows.
    """
    pieces = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("n"), F.col("value").alias("piece")
    )
    pieces = cut_lineage(pieces)  # the numbers of the pieces are drawn once
    bare = F.regexp_replace("piece", r"(?s)\\.", "")

    def opened(t):
        return F.regexp_count(F.regexp_replace(t, '"[^"]*("|$)', ""), F.lit(r"\{"))

    quotes = F.length(bare) - F.length(F.replace(bare, F.lit('"')))
    shape = pieces.select("file", "at", "n", quotes.alias("quotes"), opened(bare).alias("outside"), opened(F.concat(F.lit('"'), bare)).alias("inside"))
    order = ["at", "n"]
    shape = running(shape, ["file"], order, F.col("at"), q=F.col("quotes"))
    closes = F.col("q") % 2 == 0
    begins_inside = (F.col("q") - F.col("quotes")) % 2 == 1
    step = F.when(begins_inside, F.col("inside")).otherwise(F.col("outside")) - closes.cast("int")
    shape = running(shape.select("file", "at", "n", step.alias("step"), closes.alias("closes")), ["file"], order, F.col("at"), depth=F.col("step"))
    # behind the last object no brace stands, so a depth below 0 ends nothing
    done = (F.col("closes") & (F.col("depth") == 0)).cast("int")
    shape = running(shape.select("file", "at", "n", done.alias("done")), ["file"], order, F.col("at"), ended=F.col("done"))
    parts = pieces.join(shape.withColumn("object", F.col("ended") - F.col("done")), ["file", "at", "n"])
    whole = parts.groupBy("file", "object").agg(F.max("done").alias("done"), F.array_sort(F.collect_list(F.struct("at", "n", "piece"))).alias("p")).where("done = 1")
    text = F.concat(F.regexp_replace(F.array_join(F.col("p.piece"), "}"), r"^[^{]*", ""), F.lit("}"))
    return whole.select(F.from_json(text, schema).alias("o")).select("o.*")


def read_sql(spark: SparkSession, query: str, **views: DataFrame) -> DataFrame:
    """Run ``query`` over the given frames, named as views for this query only."""
    return spark.sql(query, **views)


def read_text_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: its path and its whole content."""
    return (
        spark.read.text(path, wholetext=True)
        .select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("text"))
    )
