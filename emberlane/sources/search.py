"""Searches for posts, and paged sources that read their answers, in batch or as a stream.

The network is behind one interface, Pages; those here read answers that were saved
(with the faults that came before each, if any). A live one is a Pages of its own. A
page is asked for until it is sound: an empty view is scrolled again, a body that is no
JSON reloads the page, and one without posts (a refusal) reloads it clean, without what
the site remembers, after a longer pause. A page that stays bad fails its task, so
that the batch is read again: no page is left out, and none is given twice.
"""

from __future__ import annotations

import json
import random
import time
from collections.abc import Iterator
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition


def searches(events: DataFrame, plants: DataFrame, hashtags: bool, replies: bool = False) -> DataFrame:
    """Every event word with every plant word, as a search and its URL's query."""
    mark = F.lit("#" if hashtags else "")
    text: Column = F.concat(F.lit("("), mark, F.col("event"), F.lit(" AND "), mark, F.col("plant"), F.lit(")"), F.lit("" if replies else " -filter:replies"))
    return events.crossJoin(plants).select("event", "plant", text.alias("search")).withColumn("query", F.concat(F.lit("q="), F.url_encode("search")))


class Pages(Protocol):
    def answer(self, search: str, page: int) -> str | None:
        """The body of a page of answers; None when the view brought none."""

    def reload(self, search: str, clean: bool) -> None:
        """Loads the page anew; clean: as a visitor that the site does not know."""

    def count(self, search: str) -> int | None:
        """How many pages there are so far; None if that is not known."""


def _rows(path: str) -> Iterator[dict]:
    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    with store.open_input_stream(at) as f:
        for line in f.read().splitlines():
            if line.strip():
                yield json.loads(line)


class SavedPages:
    """Answers saved as JSON lines, {"search", "page", "body"} or, with the faults before
    an answer, {"search", "page", "bodies": [...]}: after a body that is no JSON the
    next comes only once the page is reloaded, after a refusal only once that is clean."""

    def __init__(self, path: str):
        self.held: dict[str, dict[int, list]] = {}
        for r in _rows(path):
            self.held.setdefault(r["search"], {})[r["page"]] = r["bodies"] if "bodies" in r else [r["body"]]
        self.at: dict[tuple[str, int], int] = {}
        self.last: tuple[str, int] | None = None

    def answer(self, search: str, page: int) -> str | None:
        bodies = self.held.get(search, {}).get(page)
        if bodies is None:
            return None
        self.last = search, page
        body = bodies[min(self.at.get(self.last, 0), len(bodies) - 1)]
        if status(body) == "no_requests":
            self._next()
        return body

    def reload(self, search: str, clean: bool) -> None:
        if self.last is not None:
            body = self.held[self.last[0]][self.last[1]][self.at.get(self.last, 0)]
            if status(body) == ("retry_clean" if clean else "json_convert_failed"):
                self._next()

    def _next(self) -> None:
        n = len(self.held[self.last[0]][self.last[1]])
        self.at[self.last] = min(self.at.get(self.last, 0) + 1, n - 1)

    def count(self, search: str) -> int | None:
        return max(self.held.get(search, {}), default=-1) + 1


def status(body: str | None) -> str:
    """ok, no_requests, json_convert_failed or retry_clean."""
    if body is None:
        return "no_requests"
    try:
        told = json.loads(body)
    except ValueError:
        return "json_convert_failed"
    return "ok" if isinstance(told, dict) and "globalObjects" in told else "retry_clean"


class PageFailed(OSError):
    """A page that stayed bad."""


def paged(pages: Pages, search: str, max_pages: int = 50, max_retry_page: int = 3, max_retry_scroll: int = 3, pause: float = 0.0, start: int = 0) -> Iterator[tuple[int, int, str]]:
    """(page, tries, body) of a search's pages from start up to max_pages, or until
    max_retry_scroll views in all brought nothing."""
    empty, page = 0, start
    while page < max_pages:
        reloads = tries = 0
        while True:
            tries += 1
            try:
                body = pages.answer(search, page)
                told = status(body)
            except OSError:
                told = "json_convert_failed"
            if told == "ok":
                break
            if told == "no_requests":
                empty += 1
                if empty >= max_retry_scroll:
                    return
            else:
                reloads += 1
                if reloads > max_retry_page:
                    raise PageFailed(f"{told}: {search}, page {page}")
                clean = told == "retry_clean"
                time.sleep(pause * (1 + random.random()) * (3 if clean else 1))
                pages.reload(search, clean)
        yield page, tries, body
        page += 1
        time.sleep(pause * (1 + random.random()))


class _Range(InputPartition):
    def __init__(self, search: str, start: int, end: int):
        self.search, self.start, self.end = search, start, end


class _Options:
    def __init__(self, options: dict):
        self.path, self.searches = options["path"], json.loads(options["searches"])
        self.max_pages, self.pause = int(options.get("max_pages", 50)), float(options.get("pause", 0))
        self.retries = int(options.get("max_retry_page", 3)), int(options.get("max_retry_scroll", 3))

    def read(self, partition: _Range) -> Iterator[tuple]:
        for page, tries, body in paged(SavedPages(self.path), partition.search, partition.end, *self.retries, self.pause, partition.start):
            yield partition.search, page, body, tries


class _Reader(DataSourceReader):
    def __init__(self, options: _Options):
        self.options = options

    def partitions(self) -> list[_Range]:
        return [_Range(s, 0, self.options.max_pages) for s in self.options.searches]

    def read(self, partition: _Range) -> Iterator[tuple]:
        return self.options.read(partition)


class _StreamReader(DataSourceStreamReader):
    """An offset is how many pages of each search are read; a batch reads, search by
    search, what has come since, so a restart goes on from the checkpoint."""

    def __init__(self, options: _Options):
        self.options = options

    def initialOffset(self) -> dict:
        return dict.fromkeys(self.options.searches, 0)

    def latestOffset(self) -> dict:
        pages = SavedPages(self.options.path)
        return {s: min(pages.count(s), self.options.max_pages) for s in self.options.searches}

    def partitions(self, start: dict, end: dict) -> list[_Range]:
        return [_Range(s, start.get(s, 0), n) for s, n in end.items() if n > start.get(s, 0)]

    def read(self, partition: _Range) -> Iterator[tuple]:
        return self.options.read(partition)

    def commit(self, end: dict) -> None:
        pass


class PostSource(DataSource):
    """spark.read or readStream, format("saved_posts"), options(path=..., searches=json
    list): a partition per search. The path is one that all executors see."""

    @classmethod
    def name(cls) -> str:
        return "saved_posts"

    def schema(self) -> str:
        return "search string, page int, body string, tries int"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(_Options(dict(self.options)))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(_Options(dict(self.options)))
