"""Geographic lookup of the client address in a table of address ranges."""

from __future__ import annotations

from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions.address import ipv4_number
from logloom.schema import ENRICHED_FIELDS

_ADDRESS_BITS = 32
#: Buckets of the merge lookup: as many as its broadcast list of buckets can have.
_MERGE_BITS = 16

BROADCAST_BYTES = 128 << 20


def load_ranges(
    spark: SparkSession, path: str | None, explicit: bool = False
) -> DataFrame | None:
    """The range table at ``path``; None when there is none, unless the caller
    named it explicitly: then its absence is an error."""
    if path is None:
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        if explicit:
            raise
        return None


def geoip_join(
    records: DataFrame,
    ranges: DataFrame | None,
    broadcast_bytes: int = BROADCAST_BYTES,
    bucket_bits: int | None = None,
) -> DataFrame:
    """Add ``geoip``, ``city`` and ``region_name`` of ``remote_addr``.

    ``ranges`` has ``lo`` and ``hi`` (inclusive address numbers, ranges do not
    overlap), ``lat``, ``lon``, ``city`` and ``region_name``. Every record
    stays: one without a match gets NULLs, and so does every record when there
    is no range table. See ``RangeLookup``.
    """
    if ranges is None:
        return records.withColumns(
            {
                "geoip": F.lit(None).cast("struct<lat:double,lon:double>"),
                "city": F.lit(None).cast("string"),
                "region_name": F.lit(None).cast("string"),
            }
        )
    return RangeLookup(ranges, broadcast_bytes, bucket_bits).join(records)


class RangeLookup:
    """A range table that is measured once and may serve many micro-batches.

    A range is cut at multiples of a power of two, its buckets, which adds at
    most one row per bucket. Up to ``broadcast_bytes`` the pieces are broadcast and joined by
    bucket; the records are not shuffled.

    Beyond, only the different addresses are looked up. They and the pieces of
    their buckets are sorted together within each bucket, and every address takes
    the last range that begins before it. A bucket has a bounded number of
    addresses, so none is hot, however often one client occurs: its copies go into
    one row before the shuffle. The records are then joined by address with at
    most one row each. That join is a broadcast if few addresses were found, and
    adaptive execution splits an address with very many records; records without an address
    are spread. The records are read twice, so in batch give it a written table.
    With ``few`` records, as in a micro-batch, they are read once more to see which buckets
    occur, and only their ranges are shuffled.
    """

    def __init__(self, ranges: DataFrame, broadcast_bytes: int = BROADCAST_BYTES, bucket_bits: int | None = None):
        self.places = ranges.select(
            "lo",
            "hi",
            F.struct(F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon")).alias("geoip"),
            "city",
            "region_name",
        )
        self.broadcast_bytes, self.given_bits = broadcast_bytes, bucket_bits

    @cached_property
    def _measured(self) -> tuple[int, int]:
        """Bucket bits, finer for a large table, and its size in bytes once it is cut."""
        if self.given_bits is not None:
            return self.given_bits, _sizes(self.places, [self.given_bits]).first()[1]
        rows, coarse, fine = _sizes(self.places, [16, 20]).first()
        return (16, coarse) if rows <= 1 << 18 else (20, fine)

    def join(self, records: DataFrame, few: bool = False) -> DataFrame:
        bits, size = self._measured
        numbered = records.drop(*ENRICHED_FIELDS).withColumn("_address", F.expr(ipv4_number("remote_addr")))
        if size <= self.broadcast_bytes:
            joined = self._broadcast_join(numbered, bits)
        elif records.isStreaming:
            raise ValueError("a range table beyond broadcast_bytes needs bounded records: look up in each micro-batch")
        else:
            joined = self._merge_join(numbered, few)
        kept = [c for c in records.columns if c not in ENRICHED_FIELDS]
        return joined.select(*[F.col(f"r.`{c}`") for c in kept], *ENRICHED_FIELDS)

    def _pieces(self, bits: int) -> DataFrame:
        buckets = F.sequence(_bucket(F.col("lo"), bits), _bucket(F.col("hi"), bits))
        return self.places.select("*", F.explode(buckets).alias("_bucket"))

    def _broadcast_join(self, numbered: DataFrame, bits: int) -> DataFrame:
        records = numbered.withColumn("_bucket", _bucket(F.col("_address"), bits)).alias("r")
        inside = F.col("r._address").between(F.col("p.lo"), F.col("p.hi"))
        pieces = F.broadcast(self._pieces(bits)).alias("p")
        return records.join(pieces, (F.col("r._bucket") == F.col("p._bucket")) & inside, "left")

    def _merge_join(self, numbered: DataFrame, few: bool) -> DataFrame:
        found = self.find(numbered.select("_address"), few).alias("p")
        # Records without an address match nothing; by their other columns they go to many tasks.
        spread = [f"`{c}`" for c in ("_seq", "request_id", "remote_addr", "@timestamp") if c in numbered.columns] or ["1"]
        key = f"coalesce(_address, -1L - pmod(xxhash64({', '.join(spread)}), 100000L))"
        records = numbered.withColumn("_key", F.expr(key)).alias("r")
        return records.join(found, F.col("r._key") == F.col("p._address"), "left")

    def find(self, addresses: DataFrame, few: bool = False) -> DataFrame:
        """The place of each different ``_address`` that lies in a range."""
        wanted = (
            addresses.where("_address IS NOT NULL").distinct()
            .withColumn("_bucket", _bucket(F.col("_address"), _MERGE_BITS))
        )
        pieces = self._pieces(_MERGE_BITS)
        if few:  # at most 2 ** _MERGE_BITS numbers are broadcast
            pieces = pieces.join(F.broadcast(wanted.select("_bucket").distinct()), "_bucket", "left_semi")
        starts = pieces.selectExpr(
            "_bucket", f"greatest(lo, _bucket * {1 << (_ADDRESS_BITS - _MERGE_BITS)}L) AS _address",
            "struct(hi, geoip, city, region_name) AS place", "false AS wanted",
        )
        kind = starts.schema["place"].dataType.simpleString()
        both = wanted.selectExpr("_bucket", "_address", f"CAST(NULL AS {kind}) AS place", "true AS wanted").union(
            starts.select("_bucket", "_address", "place", "wanted")
        )
        before = "last_value(place) IGNORE NULLS OVER (PARTITION BY _bucket ORDER BY _address, wanted)"
        return both.selectExpr("_address", "wanted", f"{before} AS place").where(
            "wanted AND _address <= place.hi"
        ).select("_address", *[f"place.{c}" for c in ENRICHED_FIELDS])


def _bucket(number: Column, bits: int) -> Column:
    return F.floor(number / (1 << (_ADDRESS_BITS - bits))).cast("int")


def _sizes(places: DataFrame, bits: list[int]) -> DataFrame:
    """Row count of a range table, then its size in bytes once it is cut."""
    row_bytes = F.lit(96) + sum(
        F.coalesce(F.octet_length(c), F.lit(0)) for c in ("city", "region_name")
    )
    cut = []
    for b in bits:
        pieces = _bucket(F.col("hi"), b) - _bucket(F.col("lo"), b) + 1
        cut.append(F.coalesce(F.sum(row_bytes * pieces), F.lit(0)).alias(f"bytes_{b}"))
    return places.agg(F.count("*").alias("rows"), *cut)
