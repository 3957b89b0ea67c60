"""JDBC scans and writes."""

from __future__ import annotations

from dataclasses import dataclass, field
from urllib.parse import parse_qsl, urlencode, urlsplit, urlunsplit

from pyspark.sql import DataFrame, SparkSession

FETCH_SIZE = 10_000
PARTITIONS = 4


def parse_jdbc_uri(uri: str) -> tuple[str, str | None]:
    """Split ``?table=`` off a JDBC URI; other parameters stay, user info goes."""
    scheme, _, rest = uri.partition(":")
    if scheme != "jdbc":
        raise ValueError(f"not a JDBC URI: {uri}")
    parts = urlsplit(rest)
    pairs = parse_qsl(parts.query, keep_blank_values=True)
    table = dict(pairs).get("table")
    kept = urlencode([(k, v) for k, v in pairs if k != "table"])
    host = parts.netloc.rpartition("@")[2]
    return "jdbc:" + urlunsplit((parts.scheme, host, parts.path, kept, "")), table


@dataclass
class JdbcRead:
    """Options of one read. ``column`` splits it into ``partitions`` range queries."""

    uri: str
    query: str | None = None
    column: str | None = None
    partitions: int = PARTITIONS
    lower: object | None = None
    upper: object | None = None
    fetch_size: int = FETCH_SIZE
    credentials: dict[str, str] = field(default_factory=dict)

    def base_options(self) -> dict[str, str]:
        url, table = parse_jdbc_uri(self.uri)
        relation = f"({self.query}) AS subq" if self.query else table
        if not relation:
            raise ValueError("name a table in the URI or give a query")
        given = {k: v for k, v in self.credentials.items() if v}
        return {"url": url, "dbtable": relation, "fetchsize": str(self.fetch_size), **given}

    def bounds_query(self) -> str:
        relation = self.base_options()["dbtable"]
        return f"SELECT min({self.column}) AS lo, max({self.column}) AS hi FROM {relation}"

    def options(self, lower: object | None = None, upper: object | None = None) -> dict[str, str]:
        out = self.base_options()
        lo = self.lower if self.lower is not None else lower
        hi = self.upper if self.upper is not None else upper
        if self.column and lo is not None and hi is not None:  # an empty table has no bounds
            out |= {
                "partitionColumn": self.column,
                "numPartitions": str(self.partitions),
                "lowerBound": str(lo),
                "upperBound": str(hi),
            }
        return out


def read_jdbc(spark: SparkSession, read: JdbcRead) -> DataFrame:
    """Lazy JDBC scan; range bounds not given come from a one-row min/max query."""
    lo, hi = read.lower, read.upper
    if read.column and (lo is None or hi is None):
        probe = read.base_options() | {"dbtable": f"({read.bounds_query()}) AS bounds"}
        lo, hi = spark.read.format("jdbc").options(**probe).load().first()
    return spark.read.format("jdbc").options(**read.options(lo, hi)).load()


def write_options(uri: str, batch_size: int = FETCH_SIZE, **credentials: str) -> dict[str, str]:
    url, table = parse_jdbc_uri(uri)
    if not table:
        raise ValueError("name a table in the URI")
    return {"url": url, "dbtable": table, "batchsize": str(batch_size), **{k: v for k, v in credentials.items() if v}}


def write_jdbc(df: DataFrame, uri: str, mode: str = "append", **credentials: str) -> None:
    df.write.format("jdbc").mode(mode).options(**write_options(uri, **credentials)).save()
