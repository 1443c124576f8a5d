"""A list endpoint as a table (S2): ``spark.read.format("rest_list")``.

DataFrame filters on columns that the endpoint can filter by become URL parameters
(``year=2025``, ``speed>250``), so the server sends only the rows that pass; all other
filters stay with Spark.  An ``IN`` list asks once for each value, and a numeric column can
spread the requests over ranges, as with JDBC reads; every request is one input partition.

Options: ``url``; ``filters``, a JSON object from column to the operators that the endpoint
knows for it (``{"year": "=", "speed": "= > >= < <="}``); ``transport`` (a name of
``rest.TRANSPORTS`` or ``module:function``); ``partitionColumn``, ``lowerBound``,
``upperBound``, ``numPartitions``, or instead of these three ``partitionCuts``, a JSON list
with the ascending bounds between the ranges (see ``even_cuts``); ``maxRetries``, ``retryDelay``, ``timeout``.  The schema is
declared by the reader: ``.schema(...)``; fields missing in a record are null, nested ones are
JSON text.
"""

from __future__ import annotations

import importlib
import json
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In,
                                    InputPartition, LessThan, LessThanOrEqual)
from pyspark.sql.types import BooleanType, FractionalType, IntegralType, StringType, StructType

from lapworks.session import ship_package
from lapworks.sources import rest

OPERATORS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def _param(column: str, op: str, value) -> str:
    text = str(value).lower() if isinstance(value, bool) else str(value)
    return f"{quote(column, safe='')}{op}{quote(text, safe='')}"


def _transport(name: str):
    if ":" not in name:
        return rest.TRANSPORTS[name]
    module, attr = name.split(":", 1)
    return getattr(importlib.import_module(module), attr)


def _typed(value, kind):
    """A JSON value as a field of the declared type, null where it is none."""
    if value is None:
        return None
    if isinstance(kind, StringType):
        return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    try:
        if isinstance(kind, BooleanType):
            return value if isinstance(value, bool) else None
        if isinstance(value, bool):
            return None
        if isinstance(kind, IntegralType):
            number = int(value)
            return number if number == float(value) or isinstance(value, int) else None
        if isinstance(kind, FractionalType):
            return float(value)
    except (TypeError, ValueError, OverflowError):
        return None
    raise TypeError(f"rest_list has no {kind.simpleString()} fields")


def even_cuts(df: DataFrame, column: str, rows: int, least: int = 1) -> list:
    """Bounds that cut ``df`` along ``column`` into at least ``least`` ranges of about ``rows``
    rows (more only where values repeat), for ``partitionCuts``: one number for each request."""
    n = max(least, -(-df.count() // rows))
    if n < 2:
        return []
    cuts = df.agg(F.percentile_approx(column, [i / n for i in range(1, n)], max(10_000, 20 * n))).first()[0]
    return sorted(set(cuts or []))


class _Request(InputPartition):
    def __init__(self, url: str):
        super().__init__(url)
        self.url = url


class RestListReader(DataSourceReader):
    def __init__(self, schema: StructType, options):
        self.schema, self.options = schema, dict(options)
        self.known = {c: ops.split() for c, ops in json.loads(options.get("filters", "{}")).items()}
        self.pushed: list[str] = []          # parameters of every request
        self.choices: list[list[str]] = []   # of each list one parameter a request

    def pushFilters(self, filters):
        for f in filters:
            column = ".".join(f.attribute) if hasattr(f, "attribute") else None
            ops = self.known.get(column, [])
            value = getattr(f, "value", None)
            if isinstance(f, In) and "=" in ops and f.value and None not in f.value:
                self.choices.append([_param(column, "=", v) for v in dict.fromkeys(f.value)])
            elif OPERATORS.get(type(f)) in ops and value is not None and value == value:
                self.pushed.append(_param(column, OPERATORS[type(f)], value))
            else:
                yield f

    def partitions(self):
        spread = [[]]
        for choice in [*self.choices, self._ranges()]:
            spread = [[*s, c] for s in spread for c in choice] if choice else spread
        base = self.options["url"]
        out = []
        for extra in spread:
            params = "&".join(p for p in [*self.pushed, *extra] if p)
            out.append(_Request(base + (("&" if "?" in base else "?") + params if params else "")))
        return out

    def _ranges(self) -> list[str]:
        """The ranges of the partition column; the first and last are open, as in JDBC reads."""
        column, n = self.options.get("partitioncolumn"), int(self.options.get("numpartitions", 1))
        if column and "partitioncuts" in self.options:
            cuts = json.loads(self.options["partitioncuts"])
        elif column and n >= 2:
            lo, hi = int(self.options["lowerbound"]), int(self.options["upperbound"])
            cuts = [lo + (hi - lo) * i // n for i in range(1, n)]
        else:
            cuts = []
        if not cuts:
            return []
        ends = [None, *cuts, None]
        return ["&".join(p for p in (a is not None and _param(column, ">=", a), b is not None and _param(column, "<", b)) if p)
                for a, b in zip(ends, ends[1:])]

    def read(self, partition):
        got = rest.fetch_with_retry(
            partition.url, _transport(self.options.get("transport", "http")),
            max_retries=int(self.options.get("maxretries", 3)), delay_s=float(self.options.get("retrydelay", 5.0)),
            timeout_s=float(self.options.get("timeout", 30.0)))
        if got.outcome != "ok":
            raise RuntimeError(f"{got.outcome} (status {got.status}, {got.attempts} attempts): {partition.url}")
        fields = [(f.name, f.dataType) for f in self.schema.fields]
        for record in json.loads(got.payload):
            if isinstance(record, dict):
                yield tuple(_typed(record.get(name), kind) for name, kind in fields)


class RestListSource(DataSource):
    @classmethod
    def name(cls):
        return "rest_list"

    def schema(self):
        raise ValueError("rest_list needs a declared schema")

    def reader(self, schema):
        return RestListReader(schema, {k.lower(): v for k, v in self.options.items()})


def register(spark: SparkSession) -> None:
    """Makes the format known and lets Spark hand its filters to Python sources."""
    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(RestListSource)
