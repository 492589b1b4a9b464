"""Pages that arrive as a stream, or are crawled as one: each micro-batch is applied to the warehouse as one fetch."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text
from ..operators import merge
from ..plans.build import catch_up, store_pages
from ..sources import site
from ..sources.warehouse import Warehouse

#: Columns of the stream.
PAGES = "id bigint, position bigint, html string, error string"


def ingest_stream(
    pages: DataFrame, house: Warehouse, checkpoint: str, refresh: bool = False, patterns: text.Patterns = text.DEFAULT,
    rebuild_each: bool = True,
) -> StreamingQuery:
    """Store pages (id, position, html, error) as they come; stops when the input is used up.

    The later stages are brought up to date after each batch, or, without ``rebuild_each``, left to the caller, who catches up once
    when the query has ended. A batch that is run again after a failure finds its pages unchanged by their hash, so
    applying it twice changes nothing.
    """

    def apply(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            store_pages(house, batch, refresh, patterns)
            if rebuild_each:
                catch_up(house, patterns)

    return pages.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def crawl(house: Warehouse, state: str, options: dict[str, str], today: date | None = None, patterns: text.Patterns = text.DEFAULT) -> dict[str, int]:
    """Walk the site's index to its end as a stream, store what is not settled, catch up once; outcome counts by name.

    ``options`` are those of the ``package_site`` source; ``state`` is the folder of the crawl, where a crawl that broke off
    goes on: index pages that it had planned are not walked again, pages that it had fetched are not fetched again, and
    those of a batch that was stored are found unchanged. What is settled is written for the source as a table of ids.
    """
    spark = house.spark
    spark.dataSource.register(site.PackageSite)
    settled = house.work()
    merge.settled(house.read("packages"), F.lit(today or datetime.now(timezone.utc).date())).select("id").write.parquet(settled)
    pages = spark.readStream.format(site.NAME).options(**options, state=f"{state}/site", settled=settled).load()
    counts: dict[str, int] = {}

    def apply(batch: DataFrame, _: int) -> None:
        for row in store_pages(house, batch, False, patterns).collect():
            counts[row.outcome] = counts.get(row.outcome, 0) + row.n
            counts["questions"] = counts.get("questions", 0) + row.n_questions

    query = pages.writeStream.foreachBatch(apply).option("checkpointLocation", f"{state}/checkpoint").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    house.drop(settled)
    catch_up(house, patterns)
    return counts
