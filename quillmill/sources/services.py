"""Remote services as sources: searches by year and page, batched fetches, fallbacks.

The transport is a function from a request to text, so that tests run without
a network. All tasks together keep a rate, retries included, and retries wait
longer each time; a failed key has a status and never stops the run.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from quillmill.functions.text import as_text
from quillmill.operators.rows import prioritised
from quillmill.sources.pacing import Slots, no_wait, shared_slots, task_wait

Search = Callable[[str, int, int, int], tuple[int, Sequence[str]]]  # query, year, offset, size -> (total, ids)


class _Runs(InputPartition):
    """Runs of pages, (year, first place, end, the year's total), and the task's slots."""

    def __init__(self, runs: list[tuple[int, int, int, int]], pace: tuple[Slots, int] | None) -> None:
        self.runs, self.pace = runs, pace

    def wait(self) -> Callable[[], float]:
        return self.pace[0].of(self.pace[1]).wait if self.pace else no_wait


def search_source(search: Search, first_year: int, last_year: int, cap: int = 9999, page: int = 500, rate: float | None = None, pages_each: int = 8) -> type[DataSource]:
    """A data source (query, year, id, place, capped) over a service that finds at most `cap` ids for a query.

    A filter on year or place is pushed down: years that it excludes are never
    asked, and reading begins at the first place that it allows, so a broken
    run goes on where it ended. A year is asked for its total first; runs of
    `pages_each` pages are read by tasks of their own, or dealt to `at_once`
    tasks that keep a rate together. `capped` marks the ids of a year that has
    more than the service gives. Options: query and at_once.
    """

    class Reader(DataSourceReader):
        def __init__(self, options) -> None:
            self.query, self.at_once = options.get("query", ""), int(options.get("at_once", "1"))
            self.first, self.last, self.start, self.stop = first_year, last_year, 0, cap

        def pushFilters(self, filters):
            for f in filters:
                name, value = getattr(f, "attribute", (None,)), getattr(f, "value", None)
                if name == ("year",) and isinstance(value, int) and self._year(type(f), value) or name == ("place",) and isinstance(value, int) and self._place(type(f), value):
                    continue
                yield f  # for Spark to apply

        def _year(self, kind, value: int) -> bool:
            if kind in (EqualTo, GreaterThanOrEqual, GreaterThan):
                self.first = max(self.first, value + (kind is GreaterThan))
            if kind in (EqualTo, LessThanOrEqual, LessThan):
                self.last = min(self.last, value - (kind is LessThan))
            return kind in (EqualTo, GreaterThanOrEqual, GreaterThan, LessThanOrEqual, LessThan)

        def _place(self, kind, value: int) -> bool:
            if kind in (GreaterThanOrEqual, GreaterThan):
                self.start = max(self.start, value + (kind is GreaterThan))
            if kind in (LessThanOrEqual, LessThan):
                self.stop = min(self.stop, value + (kind is LessThanOrEqual))
            return kind in (GreaterThanOrEqual, GreaterThan, LessThanOrEqual, LessThan)

        def partitions(self):
            slots, runs = None if rate is None else Slots.from_now(rate, self.at_once), []
            wait = slots.of(0).wait if slots else no_wait  # the driver asks before any task does
            for year in range(self.first, self.last + 1):
                wait()
                total = search(self.query, year, 0, 0)[0]
                end, step = min(total, cap, self.stop), page * pages_each
                runs += [(year, at, min(end, at + step), total) for at in range(self.start, end, step)]
            tasks = self.at_once if rate else max(1, len(runs))
            return [_Runs(runs[i::tasks], (slots, i) if slots else None) for i in range(tasks)]

        def read(self, part):
            wait = part.wait()
            for year, at, end, total in part.runs:
                while at < end:
                    wait()
                    _, ids = search(self.query, year, at, min(page, end - at))
                    if not ids:
                        break
                    for place, i in enumerate(ids, at):
                        yield self.query, year, i, place, total > cap
                    at += len(ids)

    class Source(DataSource):
        @classmethod
        def name(cls):
            return "yearly_search"

        def schema(self):
            return "query string, year int, id string, place int, capped boolean"

        def reader(self, schema):
            return Reader(self.options)

    return Source


def paged_search(search: Search, cap: int = 2000, page: int = 500) -> type[DataSource]:
    """A data source (query, id, total) of a search without years: one partition, read in pages up to the cap."""

    class Reader(DataSourceReader):
        def __init__(self, options) -> None:
            self.query = options.get("query", "")

        def read(self, partition):
            at, total = 0, 1
            while at < min(total, cap):
                total, ids = search(self.query, 0, at, min(page, cap - at))
                if not ids:
                    return
                for i in ids:
                    yield self.query, i, total
                at += len(ids)

    class Source(DataSource):
        @classmethod
        def name(cls):
            return "paged_search"

        def schema(self):
            return "query string, id string, total long"

        def reader(self, schema):
            return Reader(self.options)

    return Source


def search_count(search: Search, query: str, first_year: int, last_year: int) -> int:
    """How many ids a query finds in all years: asked for none of them."""
    return sum(search(query, year, 0, 0)[0] for year in range(first_year, last_year + 1))


def titles_of(reply: str) -> dict[str, str]:
    """{id: title} of an XML reply with a record for each id; a record without a title has none, and no title goes to a neighbour."""
    found = {}
    for record in re.findall(r"(?s)<DocSum>(.*?)</DocSum>", reply):
        key, title = re.search(r"<Id>([0-9]+)</Id>", record), re.search(r'(?s)<Item Name="Title"[^>]*>(.*?)</Item>', record)
        if key and title:
            found[key.group(1)] = title.group(1)
    return found


def fetched_titles(ids: DataFrame, reply: Callable[[Sequence[str]], str], size: int = 200, **how) -> DataFrame:
    """(id, title, status) by batches of ids."""
    return fetched(ids, lambda keys: titles_of(reply(keys)), size, **how).withColumnRenamed("body", "title")


def mapped_ids(ids: DataFrame, reply: Callable[[Sequence[str]], str], size: int = 200, source: str = "pmid", target: str = "pmcid", **how) -> DataFrame:
    """(id, target, status) of a service that answers {"records": [{source, target}]}: absent where it names none."""

    def pairs(keys: Sequence[str]) -> dict[str, str]:
        return {str(r[source]): str(r[target]) for r in json.loads(reply(keys)).get("records", []) if r.get(source) and r.get(target)}

    return fetched(ids, pairs, size, **how).withColumnRenamed("body", target)


def searched(spark: SparkSession, source: type[DataSource], query: str, **options) -> DataFrame:
    """What a search source finds; filters on it are pushed down, for which the session's spark.sql.python.filterPushdown.enabled is set."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(source)
    return spark.read.format(source.name()).options(query=query, **options).load()


def search_ids(spark: SparkSession, source: type[DataSource], query: str) -> DataFrame:
    """Distinct ids that a query finds in any year."""
    return searched(spark, source, query).groupBy("id").agg(F.min("year").alias("year"), F.bool_or("capped").alias("capped"))


def table_search(rows: DataFrame, cap: int) -> Search:
    """A search over a table (year, id) that answers like a service: each year's total, and its ids in order up to the cap.

    The function carries `cap` ids a year at most; the totals count all.
    """
    order = F.struct(F.length("id"), "id")
    first = rows.select("year", "id").distinct().withColumn("n", F.row_number().over(Window.partitionBy("year").orderBy(order))).where(F.col("n") <= cap)
    ids = first.groupBy("year").agg(F.transform(F.array_sort(F.collect_list(order)), lambda x: x["id"]).alias("ids"))
    totals = rows.groupBy("year").agg(F.count_distinct("id").alias("total"))
    known = {r.year: (r.total, r.ids) for r in totals.join(ids, "year").collect()}

    def search(query: str, year: int, at: int, size: int) -> tuple[int, list[str]]:
        total, found = known.get(year, (0, []))
        return total, found[at : at + size]

    return search


def fetched(ids: DataFrame, fetch: Callable[[Sequence[str]], dict[str, str]], size: int = 500, at_once: int = 4, tries: int = 3, rate: float | None = None, first_wait: float = 1.0, have: DataFrame | None = None) -> DataFrame:
    """(id, body, status, called): records by batches of ids, keyed, never zipped by place. status: done, absent or failed; called: when each try of the id's batch began.

    Ids of `have` (id) are not asked for. At most `at_once` tasks ask at a time,
    and all of them begin at most `rate` calls a second together, retries
    included.
    """
    slots = shared_slots(ids.sparkSession, rate, at_once)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wait = task_wait(slots)
        for batch in batches:
            keys = batch["id"].tolist()
            for at in range(0, len(keys), size):
                own, got, failed, called = keys[at : at + size], {}, False, []
                for i in range(tries):
                    try:
                        called.append(wait())
                        got, failed = fetch(own), False
                        break
                    except Exception:
                        failed = True
                        if i + 1 < tries:
                            time.sleep(first_wait * 2**i)
                yield pd.DataFrame({"id": own, "body": [got.get(k) for k in own], "status": ["failed" if failed else "done" if k in got else "absent" for k in own], "called": [called] * len(own)})

    wanted = ids.select(F.col("id").cast("string").alias("id")).distinct()
    if have is not None:
        wanted = wanted.join(have.select(F.col("id").cast("string").alias("id")).distinct(), "id", "left_anti")
    return wanted.repartition(at_once).mapInPandas(run, "id string, body string, status string, called array<double>")


def with_fallback(full: DataFrame, abstracts: DataFrame, least: int = 50) -> DataFrame:
    """(id, body, source, score): the full text if there is one, else an abstract of at least `least` code points."""
    a = full.where("status = 'done'").select("id", "body").withColumn("score", F.lit(0.7))
    b = abstracts.where((F.col("status") == "done") & (F.length("body") >= least)).select("id", "body").withColumn("score", F.lit(0.4))
    return prioritised((a, "full_text"), (b, "abstract_only"), key="id")


def flat_record(df: DataFrame) -> DataFrame:
    """(pmid, doi, year, title, abstract, mesh) of nested records: parts joined, the first DOI, the year's four digits."""
    return df.select(
        as_text("pmid").alias("pmid"),
        F.coalesce(F.get(F.filter("article_ids", lambda x: x["type"] == "doi"), 0)["value"], F.lit("")).alias("doi"),
        F.left(as_text("date"), F.lit(4)).alias("year"),
        as_text("title").alias("title"),
        F.array_join("abstract_parts", " ").alias("abstract"),
        F.transform("subjects", lambda s: s["name"]).alias("mesh"),
    )
