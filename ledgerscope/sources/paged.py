"""Paged REST sources: a grid of request series, each paged in order by one task.

A fetcher is a plain function (url, params) -> Response, so recorded pages stand in for the network. Retries
and pauses belong to the task; what comes out are raw pages, one row each, to be written once before
anything parses them, so that a re-planned query never asks the source again.
"""

from __future__ import annotations

import itertools
import json
import math
import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import datetime, timezone
from urllib.error import HTTPError
from urllib.parse import urlencode
from urllib.request import Request, urlopen

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Addresses, request parameters, page sizes, pauses and retry limits of the public portal.
PROCUREMENTS_URL = "https://pncp.gov.br/api/consulta/v1/contratacoes/publicacao"
MODALITIES_URL = "https://pncp.gov.br/api/pncp/v1/modalidades"
CONTRACTS_URL = "https://pncp.gov.br/api/consulta/v1/contratos"
RETRYABLE = (429, 500, 502, 503, 504)
PROCUREMENT_PAGE, PROCUREMENT_PAUSE = 50, 0.5
CONTRACT_PAGE, CONTRACT_PAUSE = 100, 0.25


@dataclass
class Response:
    status: int
    body: bytes
    content_type: str = "application/json"
    url: str = ""
    headers: dict[str, str] = field(default_factory=dict)


Fetch = Callable[[str, dict], Response]
Sleep = Callable[[float], None]


def http_get(url: str, params: dict, timeout: float = 60.0) -> Response:
    """One GET; any status is a response, a broken connection raises OSError."""
    full = f"{url}?{urlencode(params)}" if params else url
    request = Request(full, headers={"User-Agent": "ledgerscope/1.0", "Accept": "*/*"})
    try:
        with urlopen(request, timeout=timeout) as r:
            return Response(r.status, r.read(), r.headers.get("content-type", ""), r.url, {k.lower(): v for k, v in r.headers.items()})
    except HTTPError as r:
        return Response(r.code, r.read(), r.headers.get("content-type", ""), r.url or full, {k.lower(): v for k, v in r.headers.items()})


def patient_get(fetch: Fetch, url: str, params: dict, page: int = 1, tries: int = 5, sleep: Sleep = time.sleep) -> Response:
    """Up to `tries` requests while the status is retryable; the last response comes back as it is.

    Pauses follow Retry-After, else 2, 4, 8, ... up to 20 seconds, and stay within 0.5 and 30.
    """
    for n in range(1, tries + 1):
        answer = fetch(url, params)
        if answer.status not in RETRYABLE or n == tries:
            return answer
        pause = min(2.0**n, 20.0)
        try:
            pause = float(answer.headers.get("retry-after") or pause)
        except ValueError:
            pass
        sleep(min(max(pause, 0.5), 30.0))
    raise ValueError("tries must be 1 or more")


def single_retry_get(fetch: Fetch, url: str, params: dict, page: int = 1, sleep: Sleep = time.sleep) -> Response:
    """One retry after a pause that grows with the page; a status of 400 or more then fails."""
    answer = fetch(url, params)
    if answer.status in RETRYABLE:
        sleep(min(2 ** min(page, 5), 30))
        answer = fetch(url, params)
    if answer.status >= 400:
        raise RuntimeError(f"status {answer.status} from {url}?{urlencode(params)}")
    return answer


def stubborn_get(fetch: Fetch, url: str, attempts: int = 4, sleep: Sleep = time.sleep) -> Response:
    """For single pages: errors of any kind are tried again, with growing pauses, then fail."""
    for n in range(1, attempts + 1):
        pause = min(2.0 ** (n - 1) + random.random(), 30.0)
        try:
            answer = fetch(url, {})
            if answer.status < 400:
                return answer
            problem: Exception = RuntimeError(f"status {answer.status}")
            after = answer.headers.get("retry-after", "")
            if answer.status in RETRYABLE and after.isdigit():
                pause = min(float(after), 60.0)
        except OSError as broken:
            problem = broken
        if n == attempts:
            raise RuntimeError(f"can't collect {url}: {problem}") from problem
        sleep(pause)
    raise ValueError("attempts must be 1 or more")


def page_facts(answer: Response) -> dict:
    """The payload of a page; no content is an empty one."""
    if answer.status == 204 or not answer.body.strip():
        return {}
    return json.loads(answer.body)


def is_last(payload: dict, page: int, page_size: int) -> bool:
    """No records; the last of the stated pages; none left; or fewer raw records than a page holds."""
    records = payload.get("data") or payload.get("content") or []
    total = payload.get("totalPaginas") or payload.get("totalPages")
    stated = type(total) is int and page >= total
    return not records or stated or payload.get("paginasRestantes") == 0 or len(records) < page_size


PAGES = (
    "series long, page long, source_id string, requested_url string, final_url string, status_code int, content_type string, "
    "collected_at string, body binary, stopped boolean, last boolean"
)


class Pacer:
    """Slots for requests, `pause` apart over all tasks together: each task has every tasks-th slot, its own one first.

    A task that was late waits for its next slot and doesn't catch up, so no stretch of time holds more requests than slots.
    """

    def __init__(self, pause: float, task: int, tasks: int, sleep: Sleep = time.sleep, clock: Callable[[], float] = time.monotonic) -> None:
        self.step, self.sleep, self.clock = pause * tasks, sleep, clock
        self.due = clock() + pause * (task % tasks)

    def wait(self) -> None:
        late = self.clock() - self.due
        if self.step > 0 and late > 0:
            self.due += self.step * math.ceil(late / self.step)
        if (rest := self.due - self.clock()) > 0:
            self.sleep(rest)
        self.due += self.step

    def paced(self, fetch: Fetch) -> Fetch:
        """fetch, with a slot for every request, repeated ones too."""

        def slotted(url: str, params: dict) -> Response:
            self.wait()
            return fetch(url, params)

        return slotted


def fetch_series(
    series: int, url: str, params: dict, source_id: str, page_size: int, fetch: Fetch, get=patient_get, sleep: Sleep = time.sleep, *, page: int = 1, limit: int | None = None,
) -> Iterator[dict]:
    """The pages of one series from `page` on, in order, until the last, or `limit` of them; a status that stays retryable is kept and ends the series."""
    for nth in itertools.count(1):
        asked = {**params, "pagina": page, "tamanhoPagina": page_size}
        answer = get(fetch, url, asked, page=page, sleep=sleep)
        stopped = answer.status in RETRYABLE
        if answer.status >= 400 and not stopped:
            raise RuntimeError(f"status {answer.status} from {url}?{urlencode(asked)}")
        requested = f"{url}?{urlencode(asked)}"
        last = not stopped and is_last(page_facts(answer), page, page_size)
        yield {
            "series": series, "page": page, "source_id": source_id if not stopped else f"{source_id}_limitada", "requested_url": requested,
            "final_url": answer.url or requested, "status_code": answer.status, "content_type": answer.content_type,
            "collected_at": datetime.now(timezone.utc).isoformat(), "body": answer.body, "stopped": stopped, "last": last,
        }
        if stopped or last or nth == limit:
            return
        page += 1


def fetch_pages(
    grid: DataFrame, url: str, source_id: str, page_size: int, pause: float, fetch: Fetch = http_get, get=patient_get, sleep: Sleep = time.sleep, parallel: int = 4,
    *, limit: int | None = None, clock: Callable[[], float] = time.monotonic,
) -> DataFrame:
    """grid (series, params as JSON, and next, the first page to ask for, if there is such a column) as raw pages (see PAGES).

    `parallel` tasks at most talk to the source at once, and share one budget of a request every `pause` seconds.
    `limit` ends each series after so many pages.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        pacer = Pacer(pause, context.partitionId() if context else 0, parallel, sleep, clock)
        for batch in batches:
            for series, params, page in zip(batch["series"], batch["params"], batch["next"]):
                for row in fetch_series(int(series), url, json.loads(params), source_id, page_size, pacer.paced(fetch), get, sleep, page=int(page), limit=limit):
                    yield pd.DataFrame([row])

    first = F.col("next") if "next" in grid.columns else F.lit(1)
    return grid.select("series", "params", first.cast("long").alias("next")).repartition(parallel, "series").mapInPandas(work, PAGES)
