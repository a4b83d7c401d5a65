"""The paged portal as a data source: spark.read.format("public_records").

A row is one raw page. Filters on the request's key and window are pushed into the plan of requests: a series that
they rule out is never asked for (needs spark.sql.python.filterPushdown.enabled; without it Spark filters the rows).
"""

from __future__ import annotations

import importlib
import operator
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual,
)

from . import paged

SCHEMA = (
    "key string, window_start date, window_end date, page long, requested_url string, final_url string, status_code int, content_type string, "
    "collected_at string, body string, stopped boolean"
)

# Address, source id, page size, pause, key parameter and retry rule of each kind of record.
KINDS = {
    "procurements": (paged.PROCUREMENTS_URL, "pncp_consulta", paged.PROCUREMENT_PAGE, paged.PROCUREMENT_PAUSE, "codigoModalidadeContratacao", paged.patient_get),
    "contracts": (paged.CONTRACTS_URL, "pncp_contratos", paged.CONTRACT_PAGE, paged.CONTRACT_PAUSE, "cnpjOrgao", paged.single_retry_get),
}
_TESTS = {EqualTo: operator.eq, GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge, LessThan: operator.lt, LessThanOrEqual: operator.le, In: lambda x, values: x in values}


@dataclass(frozen=True)
class Series:
    """One key in one window: the requests that are paged in order."""

    key: str
    window_start: date
    window_end: date


@dataclass
class Share(InputPartition):
    """The series that one task asks for, one after the other."""

    number: int
    series: tuple[Series, ...]


class PagesReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.kind = options.get("kind", "procurements")
        if self.kind not in KINDS:
            raise ValueError(f"unknown kind {self.kind!r}; known: {', '.join(KINDS)}")
        _, _, size, pause, _, _ = KINDS[self.kind]
        self.keys = [k.strip() for k in options["keys"].split(",") if k.strip()]
        self.start, self.end = date.fromisoformat(options["start"]), date.fromisoformat(options["end"])
        self.days, self.parallel = int(options.get("windowdays", 30)), int(options.get("parallel", 4))
        self.size, self.pause = int(options.get("pagesize", size)), float(options.get("pause", pause))
        self.fixed = {name: options[option] for name, option in (("uf", "uf"), ("codigoMunicipioIbge", "ibge")) if option in options}
        self.fetch = options.get("fetch", "")
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Keeps the filters that a series alone decides; the others go back to Spark."""
        for f in filters:
            if type(f) in _TESTS and len(f.attribute) == 1 and f.attribute[0] in ("key", "window_start", "window_end"):
                self.filters.append(f)
            else:
                yield f

    def wanted(self) -> list[Series]:
        """The series that the filters leave, key by key, in each window by window."""
        count = (self.end - self.start).days // self.days + 1
        starts = [self.start + timedelta(days=self.days * i) for i in range(count)]
        every = [Series(k, s, min(s + timedelta(days=self.days - 1), self.end)) for k in self.keys for s in starts]
        passes = lambda s, f: _TESTS[type(f)](getattr(s, f.attribute[0]), f.value)
        return [s for s in every if all(passes(s, f) for f in self.filters)]

    def partitions(self) -> list[InputPartition]:
        wanted = self.wanted()
        shares = [Share(n, tuple(wanted[n :: self.parallel])) for n in range(min(self.parallel, len(wanted)))]
        return shares or [Share(0, ())]

    def read(self, partition: Share) -> Iterator[tuple]:
        if not partition.series:
            return
        url, source, _, _, name, get = KINDS[self.kind]
        module, _, function = self.fetch.partition(":")
        fetch = getattr(importlib.import_module(module), function) if module else paged.http_get
        fetch = paged.Pacer(self.pause, partition.number, self.parallel).paced(fetch)
        for number, s in enumerate(partition.series):
            params = {"dataInicial": f"{s.window_start:%Y%m%d}", "dataFinal": f"{s.window_end:%Y%m%d}", name: s.key, **self.fixed}
            for p in paged.fetch_series(number, url, params, source, self.size, fetch, get):
                yield (
                    s.key, s.window_start, s.window_end, p["page"], p["requested_url"], p["final_url"], p["status_code"], p["content_type"], p["collected_at"],
                    p["body"].decode("utf-8"), p["stopped"],
                )


class PublicRecords(DataSource):
    """Options: kind, keys (comma-separated), start, end, and as needed windowDays, pageSize, pause, parallel, uf, ibge, fetch (module:function)."""

    @classmethod
    def name(cls) -> str:
        return "public_records"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PagesReader:
        return PagesReader({k.lower(): v for k, v in self.options.items()})
