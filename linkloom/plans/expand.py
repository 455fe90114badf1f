"""Best-first expansion of the frontier over captured pages."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..operators.content import marked_pages, with_features
from ..operators.frontier import (
    best_urls, combined_links, fold_frontier, frontier_rows, within_depth,
)
from ..operators.links import PAGE_CONTEXT, explode_links, link_array, score_links
from ..operators.outcomes import classify_outcomes
from ..operators.pages import page_rows
from ..schemas import FRONTIER, OUTCOMES, PROCESSED
from ..session import drop_path, scratch_path, stored

STRATEGY = "smart"


# Rounds whose logs are read one by one before they are merged into tables of their own.
MERGE_ROUNDS = 8


@dataclass(frozen=True)
class CrawlState:
    """Tables that one round hands to the next.

    ``seen`` has the content hashes processed so far in this crawl; pages stored before it
    do not count. The tables of a state that has gone through rounds are views over those of the first state
    and one log per round. A state is used up by the next round, which may merge and remove what it reads;
    only its outcomes stay.
    """

    frontier: DataFrame
    pages: DataFrame
    outcomes: DataFrame | None = None
    seen: DataFrame | None = None
    log: CrawlLog | None = None


@dataclass(frozen=True)
class CrawlLog:
    """The tables that the logs of ``rounds`` (folders) add to, and which of these tables (``owned``) came from merging."""

    frontier: DataFrame
    pages: DataFrame
    seen: DataFrame | None
    rounds: tuple[str, ...] = ()
    owned: tuple[str, ...] = ()

    def state(self, outcomes: DataFrame) -> CrawlState:
        """The state after all rounds. A processed page was not stored before, so pages are only added."""
        merges = [(self._read(r, "links"), self._read(r, "batch")) for r in self.rounds]
        added = [self._read(r, "pages") for r in self.rounds]
        hashes = [df.select("hash") for df in added]
        return CrawlState(
            fold_frontier(self.frontier, merges),
            reduce(DataFrame.unionByName, added, self.pages),
            outcomes,
            reduce(DataFrame.unionByName, hashes if self.seen is None else [self.seen, *hashes]),
            self,
        )

    def _read(self, folder: str, name: str) -> DataFrame:
        schema = {"links": self.frontier.schema, "pages": self.pages.schema, "batch": BATCH}[name]
        return self.frontier.sparkSession.read.schema(schema).parquet(f"{folder}/{name}")

    def merged(self, state: CrawlState) -> CrawlLog:
        """The same tables written out, without rounds; what they replace is removed."""
        spark = self.frontier.sparkSession
        tables, owned = zip(*(
            stored(getattr(state, name), f"merged-{name}") for name in ("frontier", "pages", "seen")
        ))
        for path in (*self.owned, *(f"{r}/{name}" for r in self.rounds for name in ("links", "batch", "pages"))):
            drop_path(spark, path)
        return CrawlLog(*tables, owned=owned)


BATCH = T.StructType([f for f in FRONTIER.fields if f.name in ("url", "priority", "depth", "parent_url", "seq")])


@dataclass(frozen=True)
class CapturedSite:
    """What rounds need of the captures, without the page text.

    ``facts`` has one row per captured URL, ``links`` the scored links with ``parent_url``. The
    page text is read once to make them; a round only joins narrow tables.
    """

    facts: DataFrame
    links: DataFrame


def prepare_site(captures: DataFrame) -> CapturedSite:
    """Analyse all captures once and materialise facts and links in the shared folder.

    ``captures`` has one row per URL; a NULL ``html`` is a failed fetch.
    """
    analyzed = with_features(marked_pages(captures)).withColumns(
        {
            "depth": F.lit(0),
            "fetched": F.col("html").isNotNull(),
            "captured": F.lit(True),
            "links": link_array(drop_same_page=True),
        }
    )
    pages, pages_path = stored(analyzed.drop("html", "anchors"), "site")
    links = score_links(explode_links(pages, F.col("links"), PAGE_CONTEXT))
    facts, _ = stored(pages.drop("links", "depth"), "site-facts")
    links, _ = stored(links, "site-links")
    drop_path(captures.sparkSession, pages_path)
    return CapturedSite(facts, links)


def expand_frontier(
    state: CrawlState, site: CapturedSite, k: int, max_depth: int, seq: Column, at: Column
) -> CrawlState:
    """One round: take the ``k`` best URLs, decide each, store pages, queue their links.

    The depth limit applies before the ``k`` best are taken, so URLs beyond it cannot block
    the batch; the same holds for links found. URLs without a capture count as errors. All
    URLs of the batch end up completed, whatever their outcome. Rounds may go on from any earlier
    state: rows that are in the frontier keep their values (see :func:`fold_frontier`).

    A round writes its batch, outcomes, new pages and new links, and nothing of the size of the frontier or the page
    store. Every :data:`MERGE_ROUNDS` rounds the logs are merged.
    """
    spark = state.frontier.sparkSession
    log = state.log or CrawlLog(state.frontier, state.pages, state.seen)
    folder = scratch_path(spark, "round")

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    chosen, border = best_urls(within_depth(state.frontier, max_depth), k)
    batch = written(chosen.select(*BATCH.fieldNames()), "batch")
    drop_path(spark, border)
    facts = (
        batch.join(site.facts, "url", "left")
        .withColumns(
            {
                "captured": F.coalesce("captured", F.lit(False)),
                "fetched": F.coalesce("fetched", F.lit(False)),
                "strategy": F.lit(STRATEGY),
            }
        )
    )
    facts = written(facts, "facts")
    outcomes = classify_outcomes(facts, state.pages, state.seen)
    outcomes = written(outcomes.select(*OUTCOMES.fieldNames()), "outcomes")
    processed = facts.join(
        outcomes.filter(F.col("outcome") == PROCESSED).select("url"), "url", "left_semi"
    )
    new = written(page_rows(processed).select(*state.pages.columns), "pages")
    depths = new.select(F.col("url").alias("parent_url"), F.col("depth").alias("_depth"))
    links = (
        site.links.join(depths, "parent_url")
        .withColumn("depth", (F.col("_depth") + 1).cast("int"))
        .filter(F.col("depth") <= max_depth)
    )
    written(combined_links(frontier_rows(links, seq, at)), "links")
    drop_path(spark, f"{folder}/facts")
    log = replace(log, rounds=(*log.rounds, folder))
    after = log.state(outcomes)
    return log.merged(after).state(outcomes) if len(log.rounds) >= MERGE_ROUNDS else after
