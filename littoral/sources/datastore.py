"""A paged datastore as a Python data source: one partition per batch of stations.

S7 to S10 and S31: the fetch function is given by the caller, so the source works with any
transport; without a network it is fed by a table of pages.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def station_sql(resource: str, codes: list[str], limit: int, offset: int, analyte: str = "enterococcus") -> str:
    """The query of one page."""
    quoted = ", ".join("'" + c.replace("'", "''") + "'" for c in codes)
    return f"""SELECT * FROM "{resource}" WHERE LOWER("Analyte") = '{analyte}' AND "StationCode" IN ({quoted}) ORDER BY "SampleDate" DESC LIMIT {limit} OFFSET {offset}"""


class Batch(InputPartition):
    def __init__(self, codes: list[str]):
        self.codes = codes


class _Reader(DataSourceReader):
    def __init__(self, fetch: Callable[[str], list[tuple]], resource: str, codes: list[str], batch: int, page: int):
        self.fetch, self.resource, self.codes, self.batch, self.page = fetch, resource, codes, batch, page

    def partitions(self) -> list[Batch]:
        return [Batch(self.codes[i : i + self.batch]) for i in range(0, len(self.codes), self.batch)] or [Batch([])]

    def read(self, partition: Batch) -> Iterator[tuple]:
        offset = 0
        while partition.codes:
            rows = self.fetch(station_sql(self.resource, partition.codes, self.page, offset))
            yield from (tuple(r) for r in rows)
            if len(rows) < self.page:
                return
            offset += self.page


def datastore(fetch: Callable[[str], list[tuple]], columns: str, name: str = "paged_datastore") -> type[DataSource]:
    """A data source class around a fetch function; options: resource, codes (comma separated), batch, page."""

    class PagedDatastore(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return columns

        def reader(self, schema) -> DataSourceReader:
            o = self.options
            return _Reader(fetch, o.get("resource", ""), [c for c in o.get("codes", "").split(",") if c], int(o.get("batch", 80)), int(o.get("page", 1000)))

    return PagedDatastore
