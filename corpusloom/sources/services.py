"""Remote services as a Spark data source.

``spark.read.format("literature")`` reads pages of a service as rows ``page, body, error``, ``spark.readStream`` of the same
format follows a service's cursor over batches and restarts; :mod:`corpusloom.sources.feeds` parses the pages. A transport
is any picklable callable from (service, parameters) to a page's text, or None for what the service says it does not have;
any other failure is a :class:`ServiceError`. A scan that fails in the middle raises it with the pages that were read, or
ends in a row with ``error`` where that is asked for; an empty page although the service told of more is asked for again and
then fails: a scan never looks complete when it isn't. Pages that follow one another make one partition; where the total is
known, pages by offset are read in parallel. Where several tasks ask one host, each holds its share of the host's rate.
"""

from __future__ import annotations

import json
import re
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

Transport = Callable[[str, dict], "str | None"]

# Addresses of the services, and seconds that must pass between two requests. Names in braces are taken from
# the parameters; the others go behind the question mark.
SERVICES = {
    "europepmc": ("https://www.ebi.ac.uk/europepmc/webservices/rest/search", 0.2),
    "europepmc_links": ("https://www.ebi.ac.uk/europepmc/webservices/rest/{source}/{id}/{kind}", 0.2),
    "europepmc_text": ("https://www.ebi.ac.uk/europepmc/webservices/rest/{id}/fullTextXML", 0.2),
    "esearch": ("https://eutils.ncbi.nlm.nih.gov/entrez/eutils/esearch.fcgi", 0.34),
    "efetch": ("https://eutils.ncbi.nlm.nih.gov/entrez/eutils/efetch.fcgi", 0.34),
    "idconv": ("https://pmc.ncbi.nlm.nih.gov/tools/idconv/api/v1/articles/", 0.34),
    "arxiv": ("https://export.arxiv.org/api/query", 3.0),
    "biorxiv": ("https://api.biorxiv.org/details/{server}/{interval}/{cursor}/json", 1.0),
    "biorxiv_doi": ("https://api.biorxiv.org/details/{server}/{doi}/na/json", 1.0),
    "chemrxiv": ("https://chemrxiv.org/engage/chemrxiv/public-api/v1/items", 1.0),
    "chemrxiv_item": ("https://chemrxiv.org/engage/chemrxiv/public-api/v1/items/{id}", 1.0),
    "chemrxiv_doi": ("https://chemrxiv.org/engage/chemrxiv/public-api/v1/items/doi/{doi}", 1.0),
}
NCBI = ("esearch", "efetch", "idconv")
#: Tries, first pause and its growth, of hosts that differ from :class:`Http`'s own.
RETRIES = {"www.ebi.ac.uk": (5, 30.0, 1)}
#: Seconds between requests to NCBI by who has a key, ids in one request, and ids in one answer of a search.
KEYED_INTERVAL, BATCH, MOST_IDS = 0.1, 200, 10_000
#: How often a page is asked for that comes empty although there is more, and pages of a list without a count.
EMPTY_TRIES, MOST_PAGES = 3, 100
#: Tasks that ask one host at the same time.
READERS = 4


class ServiceError(Exception):
    """A request that failed for good, with the pages that were read before it."""

    def __init__(self, service: str, reason: str, pages: list[str] | None = None):
        super().__init__(f"{service}: {reason}")
        self.service, self.reason, self.pages = service, reason, pages or []


class Limiter:
    """At least so many seconds between calls, and before the first one ``delay`` of them."""

    def __init__(self, interval: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep, delay: float = 0.0):
        self.interval, self.clock, self.sleep, self.delay, self.last = interval, clock, sleep, delay, None

    def wait(self) -> None:
        if self.last is None and self.delay:
            self.sleep(self.delay)
        if self.last is not None and (rest := self.interval - (self.clock() - self.last)) > 0:
            self.sleep(rest)
        self.last = self.clock()


def address(service: str, params: dict) -> str:
    """The URL of a request."""
    url, own = SERVICES[service][0], dict(params)
    filled = re.sub(r"\{(\w+)\}", lambda m: urllib.parse.quote(str(own.pop(m[1])), safe="/"), url)
    return f"{filled}?{urllib.parse.urlencode(own)}" if own else filled


@dataclass
class Http:
    """Fetches with a limit on the rate of each service, kept over calls, and tries again after 429 and 5xx, longer each
    time or as long as it is told. What a service does not have (404) is None; other failures raise."""

    tries: int = 5
    first_wait: float = 1.0
    timeout: float = 30.0
    email: str | None = None
    api_key: str | None = None
    tool: str = "corpusloom"
    open: Callable = urllib.request.urlopen
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    limiters: dict = field(default_factory=dict, repr=False)
    #: How many readers share each host's rate, and which of them this is.
    readers: int = 1
    reader: int = 0

    def interval(self, service: str) -> float:
        return KEYED_INTERVAL if service in NCBI and self.api_key else SERVICES[service][1]

    def shared(self, readers: int, reader: int) -> Http:
        """This one's share among so many readers of one host: a request in each ``readers`` intervals, the first one in
        its own turn. Together they stay below the host's rate, whichever of them run at the same time."""
        return replace(self, limiters={}, readers=readers, reader=reader)

    def base(self, service: str) -> dict:
        """What every request to NCBI carries."""
        if service not in NCBI:
            return {}
        named = {"tool": self.tool, "email": self.email, "api_key": self.api_key}
        return {k: v for k, v in named.items() if v}

    def raw(self, url: str, service: str) -> bytes | None:
        host = urllib.parse.urlsplit(url).netloc  # services of one host share its limit
        if host not in self.limiters:
            every = self.interval(service)
            self.limiters[host] = Limiter(every * self.readers, self.clock, self.sleep, every * (self.reader + 1) if self.readers > 1 else 0.0)
        limiter, (tries, first, factor) = self.limiters[host], RETRIES.get(host, (self.tries, self.first_wait, 2))
        reason = "no answer"
        for k in range(tries):
            limiter.wait()
            pause = first * factor**k
            try:
                with self.open(url, timeout=self.timeout) as r:
                    return r.read()
            except urllib.error.HTTPError as e:
                if e.code == 404:
                    return None
                reason = f"HTTP {e.code}"
                if e.code != 429 and e.code < 500:
                    break
                told = e.headers.get("Retry-After") if e.headers else None
                pause = float(told) if told and told.isdigit() else pause
            except OSError as e:
                reason = str(e) or type(e).__name__
            if k + 1 < tries:
                self.sleep(pause)
        raise ServiceError(service, reason)

    def __call__(self, service: str, params: dict) -> str | None:
        found = self.raw(address(service, self.base(service) | params), service)
        return None if found is None else found.decode("utf-8", "replace")

    def download(self, url: str, path: str, service: str) -> bool:
        """A file to a path, whole or not at all; False if the service has none."""
        import os

        found = self.raw(url, service)
        if found is None:
            return False
        os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
        with open(f"{path}.part", "wb") as out:
            out.write(found)
        os.replace(f"{path}.part", path)
        return True


# Paging: each tells of a page its rows, the rows up to its end, how many there are (None: not told) and the parameters of
# the next page (None: the service has none).


def _rows(found: dict, *path: str) -> int:
    for name in path:
        found = found.get(name) or {}
    return len(found) if isinstance(found, list) else 1 if found else 0


def _number(told) -> int | None:  # noqa: ANN001
    return int(told) if str(told if told is not None else "").isdigit() else None


def _cursor(found: dict, n: int, params: dict) -> tuple[int, int, int | None, dict | None]:
    rows, new = _rows(found, "resultList", "result"), found.get("nextCursorMark")
    return rows, n + rows, _number(found.get("hitCount")), {"cursorMark": new} if rows and new and new != params["cursorMark"] else None


def _numbered(found: dict, n: int, params: dict) -> tuple[int, int, int | None, dict | None]:
    """Without a count a list goes on to its first short page, and not beyond MOST_PAGES."""
    outer, inner = ("citationList", "citation") if params["kind"] == "citations" else ("referenceList", "reference")
    rows, hits = _rows(found, outer, inner), _number(found.get("hitCount"))
    more = n + rows < hits if hits is not None else rows >= params["pageSize"] and params["page"] < MOST_PAGES
    return rows, n + rows, hits, {"page": params["page"] + 1} if rows and more else None


def _biorxiv(found: dict, n: int, params: dict) -> tuple[int, int, int | None, dict | None]:
    rows, total = _rows(found, "collection"), _number((found.get("messages") or [{}])[0].get("total"))
    end = int(params["cursor"]) + rows
    return rows, end, total, {"cursor": end} if rows and end < (total or 0) else None


def _chemrxiv(found: dict, n: int, params: dict) -> tuple[int, int, int | None, dict | None]:
    rows, total = _rows(found, "itemHits"), _number(found.get("totalCount"))
    end = params["skip"] + rows
    return rows, end, total, {"skip": end} if rows and end < (total or 0) else None


def _arxiv(body: str, n: int, params: dict) -> tuple[int, int, int | None, dict | None]:
    rows, told = len(re.findall(r"<entry[\s>]", body)), re.search(r"totalResults[^>]*>(\d+)<", body)
    total, end = _number(told and told[1]), params["start"] + rows
    return rows, end, total, {"start": end} if rows and end < (total or 0) else None


# First parameters of each paged service, and the name of the parameter for rows of a page with their most.
PAGED = {
    "europepmc": ({"cursorMark": "*", "format": "json", "resultType": "core"}, ("pageSize", 1000), _cursor),
    "europepmc_links": ({"page": 1, "format": "json"}, ("pageSize", 1000), _numbered),
    "biorxiv": ({"cursor": 0}, None, _biorxiv),
    "chemrxiv": ({"skip": 0}, ("limit", 50), _chemrxiv),
    "arxiv": ({"start": 0, "sortBy": "submittedDate", "sortOrder": "descending"}, ("max_results", 200), _arxiv),
}


def first_page(service: str, params: dict, size: int = 100) -> dict:
    """The parameters of a scan's first page."""
    first, sized, _ = PAGED.get(service, ({}, None, None))
    return first | ({sized[0]: min(size, sized[1])} if sized else {}) | params


def one_page(fetch: Transport, service: str, params: dict, n: int = 0) -> tuple[str | None, int, dict | None]:
    """A page after ``n`` rows: its body, the rows it has, and the parameters of the next one or None at the end. A page
    that comes empty before the total is reached is asked for EMPTY_TRIES times."""
    step = PAGED.get(service, ({}, None, None))[2]
    for _ in range(EMPTY_TRIES):
        body = fetch(service, params)
        if body is None or step is None:
            return body, 0, None
        try:
            found = body if step is _arxiv else json.loads(body)
        except ValueError as e:
            raise ServiceError(service, f"not JSON: {e}") from e
        rows, end, total, new = step(found, n, params)
        if rows or total is None or end >= total:
            return body, rows, params | new if new else None
    raise ServiceError(service, f"an empty page after {end} of {total} rows")


def scan(fetch: Transport, service: str, params: dict, limit: int | None = None, size: int = 100) -> Iterator[str]:
    """The pages of a search, one after the other, until the service has no more or they hold ``limit`` rows. Services
    without pages give one. A page that fails raises, with the pages before it."""
    following: dict | None = first_page(service, params, size)
    read: list[str] = []
    n = 0
    while following is not None:
        try:
            body, rows, following = one_page(fetch, service, following, n)
            if body is None and read:
                raise ServiceError(service, "a page is missing")
        except ServiceError as e:
            raise ServiceError(service, e.reason, read) from e
        if body is None:
            return
        yield body
        read.append(body)
        n += rows
        if limit and n >= limit:
            return


class Pages(InputPartition):
    def __init__(self, offset: int | None):
        self.offset = offset


class LiteratureReader(DataSourceReader):
    def __init__(self, options: dict):
        self.service, self.params = options["service"], json.loads(options.get("params", "{}"))
        self.limit, self.size = int(options.get("limit") or 0) or None, int(options.get("pagesize") or 100)
        self.total, self.mark = int(options.get("total") or 0), options.get("onerror", "raise") == "mark"
        self.http = json.loads(options.get("http", "{}"))
        self.transport = options.get("transport")

    def partitions(self) -> list[InputPartition]:
        total = min(self.total, self.limit or self.total) if self.service == "chemrxiv" else 0
        return [Pages(o) for o in range(0, total, self.size)] or [Pages(None)]

    def read(self, partition: Pages) -> Iterator[tuple]:
        fetch = _loaded(self.transport) if self.transport else Http(**self.http)
        first = 0 if partition.offset is None else partition.offset // self.size
        page = first
        try:
            if partition.offset is None:
                for body in scan(fetch, self.service, self.params, self.limit, self.size):
                    yield page, body, None
                    page += 1
            else:
                body = fetch(self.service, self.params | {"skip": partition.offset, "limit": self.size})
                if body is None:
                    raise ServiceError(self.service, "a page is missing")
                yield page, body, None
        except ServiceError as e:
            if not self.mark:
                raise
            yield page, None, e.reason


class Span(InputPartition):
    """Pages after ``start`` up to ``end``."""

    def __init__(self, start: int, end: int):
        self.start, self.end = start, end


class LiteratureStream(DataSourceStreamReader):
    """Follows a service over batches of ``pagesperbatch`` pages. The offset is the number of pages; what the service gives
    as the cursor after them is kept in ``spool``, a folder that the driver and all executors share, together with the
    pages of a batch until it is committed. A task stores each page before it goes on, so neither a task that runs again
    nor a query that starts again from its checkpoint asks for a page twice."""

    def __init__(self, options: dict):
        self.service, self.params = options["service"], json.loads(options.get("params", "{}"))
        self.size, self.each = int(options.get("pagesize") or 100), int(options.get("pagesperbatch") or 10)
        self.http, self.transport = json.loads(options.get("http", "{}")), options.get("transport")
        self.spool = Spool(options["spool"])

    def initialOffset(self) -> dict:  # noqa: N802
        return {"page": 0, "cursor": ""}

    def latestOffset(self) -> dict:  # noqa: N802
        """After the last cursor that is known so many pages more, or just that if the service has no more."""
        n = self.spool.last()
        cursor = self.spool.cursor(n) if n else {}
        return {"page": n + (0 if cursor is None else self.each), "cursor": json.dumps(cursor, sort_keys=True) if n else ""}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [Span(start["page"], end["page"])] if start["page"] < end["page"] else []

    def read(self, partition: Span) -> Iterator[tuple]:
        fetch = _loaded(self.transport) if self.transport else Http(**self.http)
        state = self.spool.cursor(partition.start) if partition.start else {"params": first_page(self.service, self.params, self.size), "n": 0}
        for page in range(partition.start + 1, partition.end + 1):
            if state is None:
                break
            kept = self.spool.page(page)
            asked: Transport = fetch if kept is None else lambda *_, kept=kept: kept
            body, rows, following = one_page(asked, self.service, state["params"], state["n"])
            if body is None:
                raise ServiceError(self.service, "a page is missing")
            if kept is None:
                self.spool.store(page, body)
            state = None if following is None else {"params": following, "n": state["n"] + rows}
            if state is not None:
                self.spool.mark(page, state)
            yield page - 1, body, None
        if state is None:  # the end is marked where the batch was planned to end
            self.spool.mark(partition.end, None)

    def commit(self, end: dict) -> None:
        self.spool.clear(end["page"])


class Spool:
    """Pages and cursors of a stream as small files, each there in whole or not at all."""

    def __init__(self, uri: str):
        self.uri = uri

    def _fs(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.uri)

    def _names(self, kind: str) -> list[int]:
        from pyarrow import fs

        where, root = self._fs()
        found = where.get_file_info(fs.FileSelector(root, allow_not_found=True))
        return sorted(int(f.base_name.partition("-")[2]) for f in found if re.fullmatch(rf"{kind}-\d+", f.base_name))

    def last(self) -> int:
        return max(self._names("cursor"), default=0)

    def _read(self, name: str) -> str | None:
        where, root = self._fs()
        try:
            with where.open_input_stream(f"{root}/{name}") as f:
                return f.read().decode()
        except FileNotFoundError:
            return None

    def _write(self, name: str, text: str) -> None:
        where, root = self._fs()
        where.create_dir(root, recursive=True)
        with where.open_output_stream(f"{root}/.{name}.part") as f:
            f.write(text.encode())
        where.move(f"{root}/.{name}.part", f"{root}/{name}")

    def cursor(self, n: int) -> dict | None:
        """The state after ``n`` pages; None at the end."""
        text = self._read(f"cursor-{n}")
        if text is None:
            raise ServiceError("literature", f"the spool at {self.uri} has no cursor after page {n}")
        return json.loads(text)

    def page(self, n: int) -> str | None:
        return self._read(f"page-{n}")

    def store(self, n: int, body: str) -> None:
        self._write(f"page-{n}", body)

    def mark(self, n: int, state: dict | None) -> None:
        self._write(f"cursor-{n}", json.dumps(state))

    def clear(self, upto: int) -> None:
        """Pages of committed batches, and all cursors but the last of them."""
        where, root = self._fs()
        last = self.last()
        for kind, names in (("page", self._names("page")), ("cursor", self._names("cursor"))):
            for n in names:
                if n <= upto and not (kind == "cursor" and n in (upto, last)):
                    where.delete_file(f"{root}/{kind}-{n}")


def _loaded(name: str) -> Transport:
    """``module:name``, so that executors can import it."""
    import importlib

    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


class Literature(DataSource):
    @classmethod
    def name(cls) -> str:
        return "literature"

    def schema(self) -> str:
        return "page int, body string, error string"

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return LiteratureReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: ANN001, N802
        return LiteratureStream(self.options)


def pages(
    spark: SparkSession,
    service: str,
    params: dict,
    transport: str | None = None,
    limit: int | None = None,
    size: int = 100,
    total: int | None = None,
    http: dict | None = None,
    on_error: str = "raise",
) -> DataFrame:
    """Pages of a service: ``page, body, error``. ``total``: rows there are, where pages go by offset. ``on_error``:
    "raise", or "mark" for a last row with the error."""
    spark.dataSource.register(Literature)
    options = {
        "service": service, "params": json.dumps(params), "pagesize": str(size), "limit": str(limit or 0),
        "total": str(total or 0), "http": json.dumps(http or {}), "onerror": on_error,
    }
    if transport:
        options["transport"] = transport
    return spark.read.format("literature").options(**options).load()


def stream(spark: SparkSession, service: str, params: dict, spool: str, transport: str | None = None, size: int = 100, each: int = 10, http: dict | None = None) -> DataFrame:
    """Pages of a service as a stream, ``each`` of them in a batch: ``page, body, error``. ``spool`` is a URI of a shared
    folder that belongs to one query, as its checkpoint does."""
    spark.dataSource.register(Literature)
    options = {"service": service, "params": json.dumps(params), "pagesize": str(size), "pagesperbatch": str(each), "http": json.dumps(http or {}), "spool": spool}
    if transport:
        options["transport"] = transport
    return spark.readStream.format("literature").options(**options).load()


def batches(keys: list[str], size: int) -> list[list[str]]:
    """Distinct keys in order, so many to a request."""
    keys = list(dict.fromkeys(keys))
    return [keys[i : i + size] for i in range(0, len(keys), size)]


def pmid_query(pmids: list[str]) -> str:
    return f"EXT_ID:({' OR '.join(pmids)}) AND SRC:MED"


# The query for an article by each kind of id.
POINT = {"pmcid": "PMCID:{}", "pmid": "EXT_ID:{} AND SRC:MED", "doi": 'DOI:"{}"'}


def lookup(fetch: Transport, kind: str, id_: str) -> dict | None:
    """The first article that Europe PMC has for an id of this kind, or None."""
    body = fetch("europepmc", {"query": POINT[kind].format(id_), "format": "json", "resultType": "core", "pageSize": 1})
    found = (((json.loads(body) if body else {}).get("resultList") or {}).get("result")) or []
    return found[0] if found else None


def esearch(fetch: Transport, query: str, most: int | None = None, db: str = "pubmed", **more: str) -> list[str]:
    """Ids that a search finds, ``most`` of them if given. An answer that holds an error raises, and so does one that holds
    fewer ids than there are although all were asked for."""
    body = fetch("esearch", {"db": db, "term": query, "retmax": min(most or MOST_IDS, MOST_IDS), "retmode": "json"} | more)
    found = (json.loads(body) if body else {}).get("esearchresult") or {}
    if "ERROR" in found:
        raise ServiceError("esearch", str(found["ERROR"]))
    ids, count = list(found.get("idlist") or []), _number(found.get("count")) or 0
    if len(ids) < min(count, most or count):
        raise ServiceError("esearch", f"{len(ids)} of {count} ids")
    return ids


def windows(fetch: Transport, query: str, first: date, last: date, db: str = "pubmed") -> list[tuple[date, date]]:
    """Spans of publication days that cover ``first`` to ``last``, each with no more ids than one answer may hold: spans
    that have more are halved. Only counts are asked for. One day with more raises."""
    told = fetch("esearch", {"db": db, "term": query, "retmax": 0, "retmode": "json"} | _days(first, last))
    n = _number(((json.loads(told) if told else {}).get("esearchresult") or {}).get("count")) or 0
    if n <= MOST_IDS:
        return [(first, last)] if n else []
    if first == last:
        raise ServiceError("esearch", f"{n} ids on {first}, of which an answer holds {MOST_IDS}")
    middle = first + (last - first) // 2
    return windows(fetch, query, first, middle, db) + windows(fetch, query, middle + timedelta(days=1), last, db)


def _days(first: date, last: date) -> dict:
    return {"datetype": "pdat", "mindate": f"{first:%Y/%m/%d}", "maxdate": f"{last:%Y/%m/%d}"}


def search_ids(spark: SparkSession, fetch: Transport, query: str, first: date, last: date, readers: int = READERS) -> DataFrame:
    """``pmid`` of all that a search finds, however many: the driver finds the windows of days, tasks read their ids."""
    spans = spark.createDataFrame([(str(a), str(b)) for a, b in windows(fetch, query, first, last)], "a string, b string")

    def run(own: Transport, rows: list[dict]) -> Iterator[dict]:
        for r in rows:
            for pmid in esearch(own, query, **_days(date.fromisoformat(r["a"]), date.fromisoformat(r["b"]))):
                yield {"pmid": pmid}

    return asked(spans, fetch, run, "pmid string", readers, "a").distinct()


def share(fetch: Transport, readers: int, reader: int) -> Transport:
    """One reader's share of a transport's rates, if it has any."""
    found = getattr(fetch, "shared", None)
    return found(readers, reader) if found else fetch


def body_of(fetch: Transport, url: str, service: str, otherwise: str) -> bytes | str | None:
    """What is at an address, at a service's rate; a transport without addresses is asked for service ``otherwise``."""
    raw = getattr(fetch, "raw", None)
    return raw(url, service) if raw else fetch(otherwise, {"url": url})


def asked(rows: DataFrame, fetch: Transport, run: Callable[[Transport, list[dict]], Iterator[dict]], schema: str, readers: int, *keys: str) -> DataFrame:
    """What ``run`` makes of the rows by asking a service: ``readers`` tasks, dealt by ``keys``, each with its share of the
    rate. Write the result before using it twice: it would be asked for again."""
    import pyarrow as pa
    from pyspark import TaskContext

    types = rows.sparkSession.createDataFrame([], schema)._jdf.schema().json()
    arrow = to_arrow_schema(StructType.fromJson(json.loads(types)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        own = share(fetch, readers, (context.partitionId() if context else 0) % readers)
        for b in batches:
            held: list[dict] = []
            for r in run(own, b.to_pylist()):
                held.append(r)
                if len(held) >= BATCH:
                    yield pa.RecordBatch.from_pylist(held, arrow)
                    held = []
            yield pa.RecordBatch.from_pylist(held, arrow)

    return rows.repartition(readers, *keys).mapInArrow(task, schema)


def converted(fetch: Transport, ids: list[str], kind: str = "pmid") -> dict[str, dict]:
    """What the converter knows of each id, BATCH to a request; ids in error are left out."""
    out: dict[str, dict] = {}
    for some in batches(ids, BATCH):
        body = fetch("idconv", {"ids": ",".join(some), "idtype": kind, "format": "json"})
        for r in (json.loads(body) if body else {}).get("records") or ():
            if r.get("status") != "error":
                asked = r.get("requested-id") or r.get(kind)
                out[str(asked)] = {k: str(r[k]) for k in ("pmid", "pmcid", "doi") if r.get(k)}
    return out


def convert_ids(ids: DataFrame, fetch: Transport, kind: str = "pmid", readers: int = READERS) -> DataFrame:
    """``requested, pmid, pmcid, doi`` of what the converter knows of ids (``id``), asked by tasks in batches."""

    def run(own: Transport, rows: list[dict]) -> Iterator[dict]:
        for some in batches([r["id"] for r in rows if r["id"]], BATCH):
            for asked_for, r in converted(own, some, kind).items():
                yield {"requested": asked_for, "pmid": r.get("pmid"), "pmcid": r.get("pmcid"), "doi": r.get("doi")}

    return asked(ids.select("id"), fetch, run, "requested string, pmid string, pmcid string, doi string", readers, "id")


def link_pages(nodes: DataFrame, fetch: Transport, kind: str, limit: int | None = None, readers: int = READERS) -> DataFrame:
    """Pages of the citations or references of articles (``src_source, src_id``): ``src_source, src_id, kind, page, json,
    error``. A list that breaks off ends in a row with the error; a node without a list has one row without a page."""

    def run(own: Transport, rows: list[dict]) -> Iterator[dict]:
        for r in rows:
            row, page, error = {"src_source": r["src_source"], "src_id": r["src_id"], "kind": kind}, 0, None
            try:
                for body in scan(own, "europepmc_links", {"source": r["src_source"], "id": r["src_id"], "kind": kind}, limit, 1000):
                    yield row | {"page": page, "json": body, "error": None}
                    page += 1
            except ServiceError as e:
                error = e.reason
            if error is not None or not page:
                yield row | {"page": page, "json": None, "error": error}

    schema = "src_source string, src_id string, kind string, page int, json string, error string"
    return asked(nodes.select("src_source", "src_id").distinct(), fetch, run, schema, readers, "src_source", "src_id")


_ARTICLE_ID = re.compile(r"""<article-id\b[^>]*\bpub-id-type\s*=\s*["']pmc(?:id|aid)?["'][^>]*>\s*(?:PMC)?(\d+)""")


def split_articles(xml: str | None) -> dict[str, str]:
    """The articles of an answer to a request for several, by the number of their own PMCID: ids of related articles are
    in other elements."""
    out = {}
    for body in re.findall(r"<article[\s>].*?</article>", xml or "", re.S):
        found = _ARTICLE_ID.search(body[: body.find("<body") if "<body" in body else None])
        if found:
            out.setdefault(found[1], body)
    return out


def fetched(fetch: Transport, ids: list[str], service: str = "efetch", size: int = BATCH) -> dict[str, tuple[str | None, str | None]]:
    """Full text, or why there is none, by id as the caller spells it; PMC's service is asked for several at once."""
    out: dict[str, tuple[str | None, str | None]] = {i: (None, "not an id") for i in ids}
    number = {i: re.sub(r"\D", "", i) if service == "efetch" else i for i in out}
    for some in batches([i for i in out if number[i]], size if service == "efetch" else 1):
        try:
            if service == "efetch":
                found = split_articles(fetch(service, {"db": "pmc", "id": ",".join(number[i] for i in some)}))
            else:
                found = {number[i]: fetch(service, {"id": i}) for i in some}
            for i in some:
                text = found.get(number[i])
                out[i] = (text, None if text is not None else "not there")
        except ServiceError as e:
            out |= {i: (None, str(e)) for i in some}
    return out


def fetch_batch(fetch: Transport, pmcids: list[str], size: int = BATCH) -> dict[str, str | None]:
    """Full texts by id as the caller spells it, several to a request; null where there is none or the request fails."""
    return {i: text for i, (text, _) in fetched(fetch, pmcids, size=size).items()}


def fetch_texts(articles: DataFrame, transport: Transport, key: str = "pmcid", service: str = "efetch", readers: int = READERS) -> DataFrame:
    """``key, xml, error`` of each article: the text, or why there is none. ``readers`` tasks share the service's rate; each
    asks for its ids in batches."""

    def run(own: Transport, rows: list[dict]) -> Iterator[dict]:
        for i in range(0, len(rows), BATCH):
            some = rows[i : i + BATCH]
            found = fetched(own, [r[key] or "" for r in some], service)
            for r in some:
                text, error = found[r[key] or ""]
                yield {key: r[key], "xml": text, "error": error}

    return asked(articles.select(key), transport, run, f"{key} string, xml string, error string", readers, key)
