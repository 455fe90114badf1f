"""The link table kept up to date as pages arrive.

A link whose target has not been captured yet has no ``target_id``; it gets one when that page arrives. Each arrival is a folder with the
links it settled and all links that are still open after it. An arrival joins its own links with all known pages, and the
open links with its own pages: nothing that is settled is joined or written again.

An arrival is a number that grows. It counts once its links are committed, which are written last; until then it can
be repeated, and readers see the state before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.links import extract_links
from ..schemas import LINKS
from .tables import committed_numbers

LINKED, KNOWN = "links", "known"
ROWS = T.StructType(list(LINKS.fields)).add("pos", "integer")
PAGE = T.StructType().add("page_id", "long").add("url", "string")


def _arrivals(spark: SparkSession, root: str) -> list[int]:
    return committed_numbers(spark, f"{root}/{LINKED}", "arrival")


def _known(spark: SparkSession, root: str) -> DataFrame:
    """``page_id, url`` of the pages of all arrivals that count."""
    paths = [f"{root}/{KNOWN}/arrival={n}" for n in _arrivals(spark, root)]
    return spark.read.schema(PAGE).parquet(*paths) if paths else spark.createDataFrame([], PAGE)


def _links(spark: SparkSession, root: str, settled: bool) -> DataFrame:
    """Settled links of all arrivals, or the open ones after the last."""
    numbers = _arrivals(spark, root) if settled else _arrivals(spark, root)[-1:]
    if not numbers:
        return spark.createDataFrame([], ROWS)
    schema = T.StructType(list(ROWS.fields)).add("settled", "boolean").add("arrival", "integer")
    paths = [f"{root}/{LINKED}/arrival={n}" for n in numbers]
    rows = spark.read.schema(schema).option("basePath", f"{root}/{LINKED}").parquet(*paths)
    return rows.where(F.col("settled") == settled).select(*ROWS.fieldNames())


def add_arrival(captures: DataFrame, root: str, arrival: int) -> None:
    """Add captured pages (``page_id, url, html``) and their links to the table at ``root``.

    A URL that is known already keeps its links; of copies within an arrival the smallest ``page_id`` counts. An arrival that
    counts already is left alone. Hub URLs, to which very many links point, are the unique side of both joins, so AQE can
    split the links; page texts are joined only by their own URL, to leave out known pages.
    """
    spark = captures.sparkSession
    if arrival <= max(_arrivals(spark, root), default=-1):
        return
    known, waiting = _known(spark, root), _links(spark, root, settled=False)
    ids = captures.groupBy("url").agg(F.min("page_id").alias("page_id")).join(known, "url", "left_anti")
    ids.select("page_id", "url").write.mode("overwrite").parquet(f"{root}/{KNOWN}/arrival={arrival}")
    ids = spark.read.schema(PAGE).parquet(f"{root}/{KNOWN}/arrival={arrival}")
    links = extract_links(captures.select("page_id", "url", "html")).join(
        ids.select("page_id", F.col("url").alias("source_url")), ["page_id", "source_url"], "left_semi"
    ).withColumnRenamed("page_id", "source_id")
    targets = lambda pages: pages.select(F.col("page_id").alias("target_id"), "url")
    found = links.join(targets(known.unionByName(ids)), "url", "left").unionByName(
        waiting.drop("target_id").join(targets(ids), "url", "left"), allowMissingColumns=True
    )
    rows = found.select(*ROWS.fieldNames(), F.col("target_id").isNotNull().alias("settled"))
    # Both parts come out of one pass, as folders of one table.
    rows.write.mode("overwrite").partitionBy("settled").parquet(f"{root}/{LINKED}/arrival={arrival}")


def read_links(spark: SparkSession, root: str) -> DataFrame:
    """The link table after all arrivals that count: as :func:`~linkloom.operators.links.page_links` over all of their pages."""
    return _links(spark, root, settled=True).unionByName(_links(spark, root, settled=False))
