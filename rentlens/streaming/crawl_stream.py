"""R6/N1 as a stream: the crawl cutoff kept per source while pages come in.

The state of a source is where its crawl stands: the next page expected, the
first counter number seen, whether the crawl has stopped, and the facts of
pages that came early (a page is looked at when all before it have come, so
files may arrive in any order; only what came early is held). Pages behind the
stop are dropped at once. A micro-batch sends one small row a page to its
source's task; the parse itself is narrow.

Defined cases: pages of a source count from ``first_page`` without gaps (a
missing page holds back those behind it); a page that comes again is taken
once; a source whose first page is empty ends at the page before it; rows
without a source or page number are left out.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..session import scratch_path
from ..sources import html_pages as H
from .listings_stream import delta_path

_STATE = "next int, counter long, stopped boolean, early string"
_OUT = "source_id string, last_page int, stopped boolean"


class Crawl:
    """One source's crawl, page by page (the rule of ``html_pages.page_cutoff``)."""

    def __init__(self, state: tuple | None, first_page: int = 1):
        self.next, self.counter, self.stopped, early = state or (first_page, None, False, "{}")
        self.early = {int(k): v for k, v in json.loads(early).items()}
        self.last = None if self.stopped else self.next - 1

    def page(self, n_cards: int, counter: int | None) -> None:
        if n_cards == 0:  # not stored
            self.stopped = True
            return
        self.last, self.next = self.next, self.next + 1
        if counter is not None:
            if self.counter is None:
                self.counter = counter
            elif counter == self.counter:  # stored, the last one
                self.stopped = True

    def come(self, pages: Iterator[tuple[int, int, int | None]]) -> None:
        for page, n_cards, counter in pages:
            if not self.stopped and page >= self.next:
                self.early.setdefault(page, [n_cards, counter])
        while not self.stopped and self.next in self.early:
            self.page(*self.early.pop(self.next))
        if self.stopped:
            self.early = {}

    def state(self) -> tuple:
        return self.next, self.counter, self.stopped, json.dumps(self.early)


def crawl_stand(facts: DataFrame, first_page: int = 1) -> DataFrame:
    """Streaming ``source_id, last_page, stopped`` after each micro-batch of page facts."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        crawl = Crawl(state.get if state.exists else None, first_page)
        was_stopped = crawl.stopped
        crawl.come((int(p), int(n), None if pd.isna(c) else int(c)) for f in frames
                   for p, n, c in zip(f["page_num"], f["n_cards"], f["counter"]))
        state.update(crawl.state())
        if not was_stopped:
            yield pd.DataFrame({"source_id": [key[0]], "last_page": [crawl.last], "stopped": [crawl.stopped]})

    known = facts.filter("source_id IS NOT NULL AND page_num IS NOT NULL")
    return known.groupBy("source_id").applyInPandasWithState(step, _OUT, _STATE, "update", GroupStateTimeout.NoTimeout)


def stream_page_cutoff(pages: DataFrame, out_dir: str, checkpoint: str | None = None, first_page: int = 1) -> None:
    """Follow a stream of pages; each batch's stands go to a folder named by the batch."""
    facts = H.page_facts(H.extract_cards(pages))
    q = (crawl_stand(facts, first_page).writeStream.outputMode("update")
         .foreachBatch(lambda batch, i: batch.write.mode("overwrite").parquet(delta_path(out_dir, i)))
         .option("checkpointLocation", checkpoint or scratch_path(pages.sparkSession, "ckpt-crawl"))
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_page_cutoff(spark: SparkSession, out_dir: str) -> DataFrame:
    """``source_id, last_page, stopped`` as of the last batch that moved the source."""
    return (spark.read.parquet(out_dir).groupBy("source_id")
            .agg(F.max(F.struct("batch", "last_page", "stopped")).alias("s")).select("source_id", "s.last_page", "s.stopped"))
