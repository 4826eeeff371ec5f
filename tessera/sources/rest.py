"""A paged JSON source over HTTP, as a Spark data source, in batches or as a stream.

    spark.dataSource.register(PagedJson)
    spark.read.format("paged_json").schema("id long, name string")
        .option("url", "https://host/items?page={page}&size=100{&since}")
        .option("tasks", 8).load()

Pages are read until one is empty. ``tasks`` tasks read side by side: the i-th
takes every tasks-th page from the i-th on, each until it meets an empty page, so
all pages up to the first empty one are read, however many there are; ``pages``
sets a number instead. The scan as a whole keeps ``interval`` seconds between
requests: a task waits tasks times as long. A request is tried ``attempts`` times,
waiting twice as long each time. ``urls`` may hold several templates, one a line;
the first that answers with rows is taken, and is asked first for the pages that
follow. A page that is lost fails the scan: all templates failed, or the one that
had rows before did, or one failed by more than that the server doesn't know it
(4xx, or an error as its answer). If none has rows for the first page the scan
fails too, unless ``allow_empty`` is set. Placeholders ``{&name}`` whose option is
missing are dropped. An answer may be a list or an object with the list under
``rows_key``; an object with ``error_key`` is an error.

``push`` names columns whose filters narrow the request, as in
``day:>=:from,symbol:=:symbol``: column, operator and placeholder. Spark applies
the filters too, so a server may take them as it likes. It needs
``spark.sql.python.filterPushdown.enabled``.

As a stream (``spark.readStream``) the offset is the next page. A trigger looks
for how many pages there are by doubling and halving, a few requests, and plans
``pages_per_batch`` of them at most; tasks read the pages. A page that fails
fails the batch, whose offsets aren't committed then, and is read again when the
query is started anew; so is one that was there when the batch was planned and is
empty now. Pages are to be filled one after another and not to change; a last
page that may still grow is left out with ``whole_pages`` (its number of rows).
"""

from __future__ import annotations

import json
import re
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator
from itertools import count, islice

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual


class Pages(InputPartition):
    """Pages first, first + step, and so on: count of them, or until one is empty."""

    def __init__(self, first: int, step: int, count: int | None):
        self.first, self.step, self.count = first, step, count


def filled(template: str, options: dict, page: int) -> str:
    url = template.replace("{page}", str(page))
    optional = lambda m: f"&{m[1]}={options[m[1].lower()]}" if m[1].lower() in options else ""
    return re.sub(r"\{(\w+)\}", lambda m: str(options[m[1].lower()]), re.sub(r"\{&(\w+)\}", optional, url))


class ErrorAnswer(ValueError):
    """An answer that says it is an error."""


def rows_of(answer, rows_key: str = "rows", error_key: str = "error") -> list[dict]:
    """The rows of an answer; raises if it tells of an error."""
    if isinstance(answer, dict):
        if error_key in answer:
            raise ErrorAnswer(str(answer[error_key]))
        answer = answer.get(rows_key, [answer] if answer else [])
    return [x for x in answer if isinstance(x, dict)]


class Templates:
    """The templates of a scan, the one that had rows first."""

    def __init__(self, order: list[str]):
        self.order, self.answered = order, None

    def remember(self, template: str) -> None:
        self.answered = template
        self.order.sort(key=lambda t: t != template)


class PagedReader(DataSourceReader):
    def __init__(self, schema, options: dict):
        self.schema, self.options = schema, {k.lower(): v for k, v in options.items()}

    def partitions(self) -> list[Pages]:
        first, tasks = int(self.options.get("first", 0)), int(self.options.get("tasks", 1))
        pages = self.options.get("pages")
        if pages is None:
            return [Pages(first + i, tasks, None) for i in range(tasks)]
        return [Pages(first + i, tasks, len(range(i, int(pages), tasks))) for i in range(min(tasks, int(pages)))]

    def fetch(self, url: str) -> list[dict]:
        o, wait = self.options, float(self.options.get("interval", 0.1)) * int(self.options.get("tasks", 1))
        attempts = int(o.get("attempts", 4))
        for n in range(attempts):
            time.sleep(wait)
            try:
                with urllib.request.urlopen(url, timeout=float(o.get("timeout", 60))) as r:
                    return rows_of(json.load(r), o.get("rows_key", "rows"), o.get("error_key", "error"))
            except urllib.error.HTTPError as e:
                if e.code != 429 and e.code < 500 or n + 1 == attempts:
                    raise
            except OSError:
                if n + 1 == attempts:
                    raise
            wait = 2 * wait if n else max(wait, float(o.get("backoff", 2.0)))
        return []

    def templates(self) -> Templates:
        return Templates([t.strip() for t in self.options.get("urls", self.options.get("url", "")).split("\n")])

    def page(self, number: int, templates: Templates) -> list[dict]:
        """The rows of a page, or none if it is empty. Raises if it is lost: no
        template answered, or the one that answered before failed, or one failed
        by more than that the server doesn't know it."""
        failed, answered = None, False
        for template in list(templates.order):
            try:
                rows = self.fetch(filled(template, self.options, number))
            except (OSError, ValueError) as e:
                unknown = isinstance(e, ErrorAnswer) or isinstance(e, urllib.error.HTTPError) and 400 <= e.code < 500 and e.code != 429
                if template == templates.answered or not unknown:
                    raise
                failed = failed or e
                continue
            answered = True
            if rows:
                templates.remember(template)
                return rows
        if failed is not None and not answered:
            raise failed
        return []

    def read(self, partition: Pages) -> Iterator[tuple]:
        templates = self.templates()
        first = int(self.options.get("first", 0))
        numbers = count(partition.first, partition.step)
        for number in numbers if partition.count is None else islice(numbers, partition.count):
            rows = self.page(number, templates)
            if not rows and number == first and self.options.get("allow_empty", "false") != "true":
                raise ValueError(f"no rows from {' or '.join(templates.order)}")
            if not rows and partition.count is None:
                return
            for x in rows:
                yield tuple(x.get(f.name) for f in self.schema.fields)


#: Operators of ``push`` and the filters they stand for.
OPERATORS = {"=": EqualTo, ">": GreaterThan, ">=": GreaterThanOrEqual, "<": LessThan, "<=": LessThanOrEqual}


class PushingReader(PagedReader):
    """Filters on columns that ``push`` names become placeholders of the request."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for rule in self.options["push"].split(","):
            column, operator, name = (x.strip() for x in rule.split(":"))
            for f in filters:
                if type(f) is OPERATORS[operator] and f.attribute == (column,):
                    self.options[name.lower()] = urllib.parse.quote(str(f.value))
        return filters  # all of them are applied once more


class PagedStream(DataSourceStreamReader):
    def __init__(self, schema, options: dict):
        self.reader = PagedReader(schema, options)
        self.first = int(self.reader.options.get("first", 0))
        self.reached: int | None = None  # unknown after a restart, until a batch is planned

    def initialOffset(self) -> dict:
        self.reached = self.first
        return {"page": self.first}

    def _there(self, number: int, templates: Templates) -> bool:
        return len(self.reader.page(number, templates)) >= int(self.reader.options.get("whole_pages", 1))

    def latestOffset(self) -> dict:
        templates, low = self.reader.templates(), self.first if self.reached is None else self.reached
        step, most = 1, int(self.reader.options.get("pages_per_batch", 0)) if self.reached is not None else 0
        while (not most or step < most) and self._there(low + step - 1, templates):
            step *= 2
        have, lack = step // 2, step  # so many pages from low on are there, and so many may not be
        if most and step >= most:
            lack = most + 1
        while lack - have > 1:
            middle = (have + lack) // 2
            have, lack = (middle, lack) if self._there(low + middle - 1, templates) else (have, middle)
        self.reached = low + have
        return {"page": self.reached}

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        self.reached = max(self.reached or 0, end["page"])
        n, tasks = end["page"] - start["page"], int(self.reader.options.get("tasks", 1))
        return [Pages(start["page"] + i, tasks, len(range(i, n, tasks))) for i in range(min(tasks, n))]

    def read(self, partition: Pages) -> Iterator[tuple]:
        templates = self.reader.templates()
        for number in islice(count(partition.first, partition.step), partition.count):
            rows = self.reader.page(number, templates)
            if not rows:
                raise ValueError(f"page {number} was there and is empty now")
            for x in rows:
                yield tuple(x.get(f.name) for f in self.reader.schema.fields)


class PagedJson(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        raise ValueError("paged_json needs a schema")

    def reader(self, schema) -> PagedReader:
        options = dict(self.options)
        return (PushingReader if "push" in {k.lower() for k in options} else PagedReader)(schema, options)

    def streamReader(self, schema) -> PagedStream:
        return PagedStream(schema, dict(self.options))
