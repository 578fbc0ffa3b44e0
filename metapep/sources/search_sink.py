"""Bulk load of search documents as a Spark data source writer, with acknowledged batches, back-off, commit and abort."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType


@dataclass
class Loaded(WriterCommitMessage):
    """What a task has loaded and the index has acknowledged."""

    documents: int
    requests: int


@dataclass
class _Load:
    connect: Callable
    target: str
    batch: int
    tries: int
    wait: float


class SearchWriter(DataSourceWriter):
    """Sends the documents of each task in requests of `batch`; what the index rejects is sent again, alone and after a growing pause."""

    def __init__(self, load: _Load):
        self.load = load

    def write(self, iterator: Iterator[Row]) -> Loaded:
        client, n, requests, held = self.load.connect(), 0, 0, []
        for row in iterator:
            held.append((row.accession, row.document))
            if len(held) >= self.load.batch:
                requests += self._send(client, held)
                n, held = n + len(held), []
        if held:
            requests += self._send(client, held)
        return Loaded(n + len(held), requests)

    def _send(self, client, documents: list[tuple[str, str]]) -> int:
        """Requests that it took until all documents were acknowledged."""
        left, reason = dict(documents), None
        for k in range(self.load.tries):
            if k:
                time.sleep(self.load.wait * 2 ** (k - 1))
            lines = [x for key, text in left.items() for x in (json.dumps({"index": {"_index": self.load.target, "_id": key}}), text)]
            try:
                rejected = set(client.bulk("\n".join(lines) + "\n"))
            except ConnectionError as error:  # whether it arrived is not known: documents are addressed by id, so they are sent again
                reason, rejected = error, set(left)
            left = {key: text for key, text in left.items() if key in rejected}
            if not left:
                return k + 1
        raise RuntimeError(f"{len(left)} documents were not taken after {self.load.tries} tries: {reason or sorted(left)[:3]}")

    def commit(self, messages: list[Loaded | None]) -> None:
        """All tasks are done: the index must hold as many documents as they loaded."""
        loaded, held = sum(m.documents for m in messages if m), self.load.connect().count(self.load.target)
        if held != loaded:
            raise RuntimeError(f"{self.load.target} holds {held} documents of {loaded}")

    def abort(self, messages: list[Loaded | None]) -> None:
        """A task failed for good; the caller drops the index, which no alias names yet."""


def bulk_load(documents: DataFrame, connect: Callable, target: str, batch: int = 2500, tries: int = 6, wait: float = 0.5) -> None:
    """Loads (accession, document) rows into an empty index; raises unless it then holds every document once.

    connect() gives a client in each task, so it must pickle; the client has bulk(text
    of one request), which returns the ids that it rejects and raises ConnectionError
    where it cannot tell, and count(index).  Accessions are unique and are the ids, so a
    request or a task that runs again replaces what it has loaded.
    """
    load = _Load(connect, target, batch, tries, wait)

    class SearchIndex(DataSource):
        @classmethod
        def name(cls) -> str:
            return "search_index"

        def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
            return SearchWriter(load)

    documents.sparkSession.dataSource.register(SearchIndex)
    documents.select("accession", "document").write.format("search_index").mode("append").save()
