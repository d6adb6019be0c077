"""Raw filings as files, and section records as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html
from ..functions import text as fn
from ..schema import PARSER_VERSION, SECTION_RECORDS


#: Files up to which their paths are given to the reader one by one; of more, all are read and the chosen ones kept.
NAMED_FILES = 20_000


def files_below(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "primary.html*").load(root)


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """path and length of all <cik>/<accession>/primary.html and .html.gz below root; no content is read."""
    return files_below(spark, root).select("path", "length")


def completed(spark: SparkSession, root: str) -> DataFrame:
    """accession of all filings whose landing is complete: those with a metadata.json."""
    marks = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "metadata.json").load(root)
    return marks.select(F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1).alias("accession"))


def preferred(files: DataFrame) -> DataFrame:
    """path, accession and cik of one file for each filing, the gzipped one first; the latter two are read off the path."""
    named = files.select("path", F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1).alias("accession"), F.regexp_extract("path", r"/([^/]+)/[^/]+/[^/]+$", 1).try_cast("bigint").alias("cik"))
    best = F.min_by(F.struct("path", "cik"), F.struct((~F.col("path").endswith(".gz")).alias("plain"), "path"))
    return named.groupBy("accession").agg(best.alias("file")).select("accession", "file.path", "file.cik")


def contents(spark: SparkSession, root: str, chosen: DataFrame) -> DataFrame:
    """chosen (with path, one row for each) and the content of its files; content isn't shuffled for a few files."""
    few = [r[0] for r in chosen.select("path").limit(NAMED_FILES + 1).collect()]
    if not few:
        return chosen.withColumn("content", F.lit(None).cast("binary"))
    if len(few) <= NAMED_FILES:
        return spark.read.format("binaryFile").load(few).select("path", "content").join(F.broadcast(chosen), "path")
    return files_below(spark, root).select("path", "content").join(chosen, "path")


def parsed(files: DataFrame, filings: DataFrame | None = None) -> DataFrame:
    """accession, text (null unless it parsed well), full record, error and parser version; filings without a file, and files
    that can't be read, get parse_fail."""
    rows = files.select("accession", html.clean_html(F.col("content")).alias("x")).select("accession", "x.text", "x.error")
    if filings is not None:
        rows = filings.select("accession").join(rows.withColumn("__file", F.lit(True)), "accession", "left").withColumn("error", F.coalesce("error", F.when(F.col("__file").isNull(), "raw_missing"))).drop("__file")
    record = fn.full_record(**{k: F.col(f"__{k}") for k in fn.NO_FULL})
    rows = rows.select("accession", "text", "error", *(c.alias(f"__{k}") for k, c in fn.full_measures(F.col("text")).items()))
    return rows.select("accession", "text", "error", record.alias("full"), F.lit(PARSER_VERSION).alias("parser_version")).withColumn("text", F.when(F.col("full.status") == "ok", F.col("text")))


def records_to_json(records: DataFrame) -> DataFrame:
    return records.select("cik", "accession", F.to_json(F.struct("*")).alias("json"))


def records_from_json(rows: DataFrame) -> DataFrame:
    """Records of rows with json; rows that can't be read, or have no numeric company, are left out.

    Records are picked in the array that is exploded: a filter would be pushed down and parse every JSON once more.
    """
    data = F.array(F.from_json("json", SECTION_RECORDS, {"mode": "PERMISSIVE"}))
    read = F.explode(F.filter(data, lambda r: r["status"].isNotNull())).alias("r")
    return rows.where("cik is not null").select(F.col("cik").alias("__cik"), F.col("accession").alias("__accession"), read).select("r.*", "__cik", "__accession").withColumn("cik", F.coalesce("cik", "__cik")).withColumn("accession", F.coalesce("accession", "__accession")).drop("__cik", "__accession")
