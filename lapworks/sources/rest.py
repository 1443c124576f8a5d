"""REST list source with the retry policy (S1), fetched on the executors.

Policy per URL: up to ``max_retries`` attempts; timeouts, transport errors,
undecodable bodies, 429, 5xx and other statuses retry after a fixed delay (none
after the last attempt); 400/401/403/404 stop at once; a body that is not a JSON
list fails without retry; ``[]`` is success.

Two ways to run it, both distributed:
* ``fetch_manifest(manifest_df)`` - ``mapInArrow`` over a URL DataFrame, so
  millions of URLs are fetched by the tasks holding them (nothing on the driver);
* ``format("rest_json")`` - a Python Data Source with one input partition per URL,
  for a modest URL list given as an option.
The transport is injectable (a function of URL and timeout; ``http`` uses urllib).
With a ``ledger`` (a shared folder) a run records its answers and a later run asks only
for the URLs that are not finished.  Payloads that lie in files are no requests: see
``payloads.read_landed``.
"""

from __future__ import annotations

import json
import time
import uuid
from http.client import HTTPException
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lapworks.session import materialize, ship_package

# Statuses that are not worth retrying.
NO_RETRY_STATUSES = (400, 401, 403, 404)

ANSWER_CHARS = 4 << 20       # of URLs and payloads that a task holds before it hands them on

RESULT_DDL = "url string, status int, attempts int, outcome string, payload string"


class FetchTimeout(Exception):
    pass


class FetchError(Exception):
    pass


@dataclass
class Response:
    status: int
    body: str | None


@dataclass
class FetchResult:
    url: str
    status: int | None
    attempts: int
    outcome: str          # ok | bad_format | client_error | exhausted
    payload: str | None


def fetch_with_retry(url: str, transport, *, max_retries: int = 3, delay_s: float = 5.0,
                     timeout_s: float = 30.0, sleep=time.sleep) -> FetchResult:
    status = None
    for attempt in range(1, max_retries + 1):
        try:
            resp = transport(url, timeout_s)
            status = resp.status
            if status >= 400:
                if status in NO_RETRY_STATUSES:
                    return FetchResult(url, status, attempt, "client_error", None)
                raise FetchError(f"HTTP {status}")
            try:
                data = json.loads(resp.body)
            except (TypeError, ValueError) as ex:
                raise FetchError("undecodable body") from ex
            if not isinstance(data, list):
                return FetchResult(url, status, attempt, "bad_format", None)
            return FetchResult(url, status, attempt, "ok", resp.body)
        except (FetchTimeout, FetchError, OSError, UnicodeDecodeError, HTTPException):
            pass
        if attempt < max_retries:
            sleep(delay_s)
    return FetchResult(url, status, max_retries, "exhausted", None)


def http_transport(url: str, timeout_s: float) -> Response:
    import http.client
    import socket
    import urllib.error
    import urllib.request
    if not url.lower().startswith(("http://", "https://")):
        return Response(400, None)              # nothing but HTTP is requested
    try:
        with urllib.request.urlopen(url, timeout=timeout_s) as r:  # noqa: S310
            return Response(getattr(r, "status", None) or 200, r.read().decode("utf-8"))
    except urllib.error.HTTPError as e:
        return Response(e.code, None)
    except (socket.timeout, TimeoutError) as e:
        raise FetchTimeout(str(e)) from e
    except (urllib.error.URLError, http.client.HTTPException, UnicodeDecodeError) as e:
        # cut-off bodies, broken status lines and bodies that are no text: worth another try
        raise FetchError(str(e)) from e


TRANSPORTS = {"http": http_transport}


def answers(batches, ask):
    """Arrow batches of results for batches of URLs; the results are handed on as soon as
    they have ``ANSWER_CHARS``, however many URLs a batch has."""
    import pyarrow as pa
    schema = pa.schema([("url", pa.string()), ("status", pa.int32()), ("attempts", pa.int32()),
                        ("outcome", pa.string()), ("payload", pa.string())])

    def batch(results):
        columns = zip(*((r.url, r.status, r.attempts, r.outcome, r.payload) for r in results))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    for urls in batches:
        held, chars = [], 0
        for url in urls.column(0):
            r = ask(url.as_py())
            held.append(r)
            chars += len(r.url or "") + len(r.payload or "")
            if chars >= ANSWER_CHARS:
                yield batch(held)
                held, chars = [], 0
        if held:
            yield batch(held)


def fetch_manifest(manifest: DataFrame, url_col: str = "url", *, transport: str = "http",
                   max_retries: int = 3, delay_s: float = 5.0, timeout_s: float = 30.0) -> DataFrame:
    """Fetch every URL of ``manifest`` inside the tasks (Arrow batches of URLs)."""
    ship_package(manifest.sparkSession)
    fn = TRANSPORTS[transport] if isinstance(transport, str) else transport

    def run(batches):
        return answers(batches, lambda url: fetch_with_retry(
            url, fn, max_retries=max_retries, delay_s=delay_s, timeout_s=timeout_s))
    return manifest.select(url_col).mapInArrow(run, RESULT_DDL)


# ---------------------------------------------------------------- ledger of finished requests
LEDGER_DDL = RESULT_DDL + ", run long"


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """All recorded requests ``(url, status, attempts, outcome, payload, run)``, one row per
    URL and run that asked for it; no rows for a ledger without runs."""
    try:
        return spark.read.schema(LEDGER_DDL).parquet(f"{ledger.rstrip('/')}/*")
    except AnalysisException as ex:
        if ex.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_DDL)


def fetch_missing(manifest: DataFrame, ledger: str, url_col: str = "url", *, finished=("ok",),
                  partitions: int | None = None, **policy) -> DataFrame:
    """Fetches what the ledger (a folder of the shared storage) does not have as finished.

    The manifest's distinct URLs are anti-joined with the URLs that some run has finished;
    the others are requested in the tasks and recorded as one more run.  A rerun after a
    failure therefore asks each good URL only once.  Returns ``ledger_state`` of the
    manifest's URLs.
    """
    from pyspark.sql import functions as F
    spark = manifest.sparkSession
    urls = manifest.select(F.col(url_col).alias("url")).filter("url IS NOT NULL").distinct()
    before = read_ledger(spark, ledger)
    run = (before.agg(F.max("run")).first()[0] or 0) + 1
    done = before.filter(F.col("outcome").isin(*finished)).select("url").distinct()
    todo = urls.join(done, "url", "left_anti")
    if partitions:
        todo = todo.repartition(partitions)
    # a folder of its own: a run that fails half way has recorded nothing half
    fetch_manifest(todo, **policy).withColumn("run", F.lit(run).cast("long")) \
        .write.parquet(f"{ledger.rstrip('/')}/run-{run:06d}-{uuid.uuid4().hex[:8]}")
    return ledger_state(urls, ledger)


def ledger_state(urls: DataFrame, ledger: str) -> DataFrame:
    """What is known of each URL: ``url, status, attempts, outcome, payload, runs``, the
    last run's answer, with the attempts of all runs."""
    from pyspark.sql import functions as F
    rows = read_ledger(urls.sparkSession, ledger).join(urls.select("url"), "url", "left_semi")
    last = F.max_by(F.struct("status", "outcome", "payload"), "run").alias("last")
    return rows.groupBy("url").agg(last, F.sum("attempts").cast("int").alias("attempts"),
                                   F.count(F.lit(1)).cast("int").alias("runs")) \
        .select("url", "last.status", "attempts", "last.outcome", "last.payload", "runs")


class _UrlPartition(InputPartition):
    def __init__(self, url: str):
        super().__init__(url)
        self.url = url


class RestJsonReader(DataSourceReader):
    def __init__(self, options):
        self.urls = json.loads(options.get("urls", "[]"))
        self.transport = options.get("transport", "http")
        self.max_retries = int(options.get("maxRetries", 3))
        self.delay_s = float(options.get("retryDelay", 5.0))
        self.timeout_s = float(options.get("timeout", 30.0))

    def partitions(self):
        return [_UrlPartition(u) for u in self.urls]

    def read(self, partition):
        r = fetch_with_retry(partition.url, TRANSPORTS[self.transport], max_retries=self.max_retries,
                             delay_s=self.delay_s, timeout_s=self.timeout_s)
        yield (r.url, r.status, r.attempts, r.outcome, r.payload)


class RestJsonSource(DataSource):
    """``spark.read.format("rest_json").option("urls", json.dumps([...])).load()``"""

    @classmethod
    def name(cls):
        return "rest_json"

    def schema(self):
        return RESULT_DDL

    def reader(self, schema):
        return RestJsonReader(self.options)


def register(spark: SparkSession) -> None:
    ship_package(spark)
    spark.dataSource.register(RestJsonSource)


class FetchFailed(RuntimeError):
    """``failures``: a DataFrame ``(url, status, attempts, outcome)`` of all that failed."""

    def __init__(self, message: str, failures: DataFrame):
        super().__init__(message)
        self.failures = failures


def records_of(fetched: DataFrame, schema=None, require_all: bool = True, stored: bool = False) -> DataFrame:
    """Typed records ``(url, pos, fields...)`` of fetch results, which are stored first (in
    the shared folder) unless they are ``stored``: the check, the schema and every later
    action read them, nothing is requested twice.  With ``require_all`` one URL that gave no
    list fails the dataset, like a failed single request."""
    from pyspark.sql import functions as F

    from lapworks.sources import payloads
    fetched = fetched if stored else materialize(fetched)
    if require_all:
        bad = fetched.filter(F.col("outcome") != "ok").drop("payload")
        n = bad.count()
        if n:
            raise FetchFailed(f"{n} of {fetched.count()} requests failed", bad)
    recs = payloads.explode_records(fetched.filter(F.col("outcome") == "ok"), keep=("url",))
    return payloads.to_columns(recs, schema, keep=("url", "pos"))


def fetch_records(spark: SparkSession, urls, *, transport="http", schema=None,
                  require_all: bool = True, partitions: int | None = None, ledger: str | None = None,
                  max_retries: int = 3, delay_s: float = 5.0, timeout_s: float = 30.0) -> DataFrame:
    """URLs (a list or a ``url`` DataFrame) -> typed records ``(url, pos, fields...)``,
    requested in the tasks, once (see ``records_of``).  ``partitions`` spreads a large
    manifest over that many fetch tasks.  With a ``ledger`` a rerun asks only for what
    earlier runs have not finished (see ``fetch_missing``)."""
    manifest = urls if isinstance(urls, DataFrame) else \
        spark.createDataFrame([(u,) for u in urls], "url string")
    policy = dict(transport=transport, max_retries=max_retries, delay_s=delay_s, timeout_s=timeout_s)
    if ledger is not None:
        return records_of(fetch_missing(manifest, ledger, partitions=partitions, **policy), schema, require_all, stored=True)
    if partitions:
        manifest = manifest.repartition(partitions)
    return records_of(fetch_manifest(manifest, **policy), schema, require_all)
