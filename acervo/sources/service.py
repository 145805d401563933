"""A web service of legal texts as a data source. The transport is an argument, so the source can be used and tested offline."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: What a service answers and how it is reported: refused, unknown, other.
ERRORS = {401: PermissionError, 403: PermissionError, 404: FileNotFoundError}


def fetch(url: str) -> tuple[int, str]:
    """Status and body of a GET request."""
    import urllib.error
    import urllib.request

    try:
        with urllib.request.urlopen(url, timeout=30) as r:  # noqa: S310 - the address is the caller's
            return r.status, r.read().decode("utf-8")
    except urllib.error.HTTPError as e:
        return e.code, ""


def query(base: str, service: str, key: str, params: dict[str, str], get: Callable[[str], tuple[int, str]] = fetch) -> str:
    """Body of one service call; refused calls, unknown services and other failures raise their own errors."""
    from urllib.parse import urlencode

    if not key:
        raise ValueError("a key is needed")
    status, body = get(f"{base}/{service}?{urlencode({**params, 'key': key})}")
    if status != 200:
        raise ERRORS.get(status, RuntimeError)(f"service {service}: status {status}")
    return body


class ServiceReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = dict(options)

    def partitions(self) -> list[InputPartition]:
        """Slices of the ids, ``per`` (100) calls each."""
        ids, per = json.loads(self.options.get("ids", "[]")), int(self.options.get("per", "100"))
        return [InputPartition(ids[i : i + per]) for i in range(0, len(ids), per)] or [InputPartition([])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        o = self.options
        for ident in partition.value:
            yield (str(ident), query(o["base"], o["service"], o["key"], {"id": str(ident)}))


class ServiceSource(DataSource):
    """``spark.read.format("norm_service")`` with options base, service, key, ids (a JSON list) and per (calls of one task)."""

    @classmethod
    def name(cls) -> str:
        return "norm_service"

    def schema(self) -> str:
        return "id string, body string"

    def reader(self, schema) -> ServiceReader:
        return ServiceReader(self.options)


def register_service(spark: SparkSession) -> None:
    """Makes the format ``norm_service`` known to a session."""
    spark.dataSource.register(ServiceSource)
