"""Pages of web sites as a Spark data source, for batches and streams.

A site lists its URLs in an order that new ones are added to the end of, as a sitemap's entries by date or an archive's
index do. The caller gives two functions, which run where their results are needed: `listing(host, start, end)` gives
the URLs of a host from place `start` to before `end`, and `fetch(url)` a status and a page. A stream also needs
`known(host)`, how many URLs the host lists now. Nothing but the hosts and their counts passes through the driver.

    spark.dataSource.register(page_source(listing, fetch, known))
    spark.read.format("pages").option("hosts", "a.example b.example").load()
    spark.readStream.format("pages").option("hosts", "a.example").load()

Options: `hosts`, by blanks; `pause`, seconds between two pages of a host (0.5); `tasks`, how many tasks share a host's
URLs (1), each of which then waits `tasks` times as long, so the host sees the same pace.

A page that fails is a row with its error. In a batch, a task whose listing fails gives a row with the host's name, the
error and no URL. In a stream the places of all hosts are the offset: a query that restarts reads the batch it was
stopped in again, and no other. A listing or a `known` that fails stops it, as its pages would be passed over otherwise.
While it runs, a host that lists fewer URLs than before has nothing new. parse_pages() reads the rows.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "host string, place long, url string, html string, status_code int, error string"
PAUSE, TASKS = 0.5, 1

Listing = Callable[[str, int, int | None], Iterable[str]]
Fetch = Callable[[str], tuple[int, str]]


@dataclass
class Stretch(InputPartition):
    """Every `step`-th URL of a host from `start` on, to before `end`, or to the last one where it is None."""

    host: str
    start: int
    end: int | None
    first: int = 0
    step: int = 1


def stretches(host: str, start: int, end: int | None, tasks: int) -> list[Stretch]:
    parts = tasks if end is None else min(tasks, max(end - start, 0))
    return [Stretch(host, start, end, k, tasks) for k in range(parts)]


def visit(part: Stretch, listing: Listing, fetch: Fetch, pause: float) -> Iterator[tuple]:
    """The rows of one stretch, one page after the other."""
    wait = 0.0
    for k, url in enumerate(listing(part.host, part.start, part.end)):
        if k % part.step != part.first:
            continue
        time.sleep(wait)
        wait = pause * part.step
        try:
            status, html = fetch(url)
            row = (html, int(status), None)
        except Exception as e:  # noqa: BLE001  whatever the caller's function raises is a row
            row = (None, None, f"{type(e).__name__}: {e}")
        yield (part.host, part.start + k, url, *row)


class _Options:
    def __init__(self, options: dict[str, str]) -> None:
        self.hosts = list(dict.fromkeys(options.get("hosts", "").split()))
        self.pause = float(options.get("pause", PAUSE))
        self.tasks = int(options.get("tasks", TASKS))
        if not self.hosts:
            raise ValueError("the option hosts names no host")
        if self.pause < 0 or self.tasks < 1:
            raise ValueError("pause is 0 or more, tasks is 1 or more")


class _Reader(DataSourceReader):
    def __init__(self, options: _Options, listing: Listing, fetch: Fetch) -> None:
        self.options, self.listing, self.fetch = options, listing, fetch

    def partitions(self) -> list[Stretch]:
        return [p for host in self.options.hosts for p in stretches(host, 0, None, self.options.tasks)]

    def read(self, partition: Stretch) -> Iterator[tuple]:
        try:
            yield from visit(partition, self.listing, self.fetch, self.options.pause)
        except Exception as e:  # noqa: BLE001  as above, of the listing
            yield (partition.host, None, None, None, None, f"{type(e).__name__}: {e}")


class _StreamReader(DataSourceStreamReader):
    """Offsets: how many URLs of each host have been read."""

    def __init__(self, options: _Options, listing: Listing, fetch: Fetch, known: Callable[[str], int]) -> None:
        self.options, self.listing, self.fetch, self.known = options, listing, fetch, known
        self.at: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return dict.fromkeys(self.options.hosts, 0)

    def latestOffset(self) -> dict:
        self.at = {h: max(self.at.get(h, 0), self.known(h)) for h in self.options.hosts}
        return self.at

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        return [p for h in end if end[h] > start.get(h, 0) for p in stretches(h, start.get(h, 0), end[h], self.options.tasks)]

    def read(self, partition: Stretch) -> Iterator[tuple]:
        return visit(partition, self.listing, self.fetch, self.options.pause)

    def commit(self, end: dict) -> None:
        """A stretch is listed again wherever it is read, so nothing is held that a commit could free."""


def page_source(listing: Listing, fetch: Fetch, known: Callable[[str], int] | None = None, name: str = "pages") -> type[DataSource]:
    """A data source class to register with spark.dataSource.register."""

    class PageSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema) -> DataSourceReader:
            return _Reader(_Options(self.options), listing, fetch)

        def streamReader(self, schema) -> DataSourceStreamReader:
            if known is None:
                raise ValueError("a stream of pages needs known(host), the count of URLs that a host lists")
            return _StreamReader(_Options(self.options), listing, fetch, known)

    return PageSource
