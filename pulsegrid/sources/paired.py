"""Main and extra sample files of records as one data source: zipped by frame, without a join.

Work orders name for each record its main file, its extra file if there is one, and what the headers
say about both. Spark makes them from the listing and the headers and writes them as a small Parquet table; the source's
planner reads that table, cuts the records into equal frame ranges (a range is the same in both files) and
packs ranges into tasks. A task reads its range of both files and puts the numbers side by side, so no
sample is shuffled to meet its partner.

Which records and which frames are wanted is told to the planner (``read_paired``), and nothing else is opened. It is not left to
pushed filters: the session keeps those of the last scan in the source that all scans of a frame share, so two filters on one frame would mix.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from pulsegrid.plans.joins import join_lookup
from pulsegrid.schema import CHANNELS, EXTRA_CHANNELS
from pulsegrid.session import scratch_path
from pulsegrid.sources import files, readers

FORMAT = "pulsegrid_paired_samples"
RANGE_BYTES = 128 << 20
#: Frames that are decoded at once.
AT_ONCE = 200_000
KEY, INDEX = "recording_id", "sample_index"

SCHEMA = T.StructType(
    [
        T.StructField(KEY, T.StringType()),
        T.StructField(INDEX, T.LongType()),
        *[T.StructField(c, T.DoubleType()) for c in CHANNELS],
        T.StructField("sampling_rate_hz", T.IntegerType()),
        T.StructField("has_respiration", T.BooleanType()),
    ]
)


@dataclass(frozen=True)
class SampleFile:
    """A file of interleaved 16-bit numbers and what turns them into values."""

    path: str
    gains: tuple[float, ...]
    zeros: tuple[float, ...]

    @property
    def width(self) -> int:
        return readers.SAMPLE_BYTES * len(self.gains)


@dataclass(frozen=True)
class Range:
    """``n`` frames of a record from ``first`` on."""

    record: str
    rate: int | None
    has_extra: bool
    main: SampleFile
    extra: SampleFile | None
    first: int
    n: int


@dataclass
class Work(InputPartition):
    """The ranges of one task."""

    ranges: list[Range] = field(default_factory=list)


def ranges_of(order: dict, low: int = 0, high: int | None = None, range_bytes: int = RANGE_BYTES) -> Iterator[Range]:
    """Equal ranges of a record's frames from ``low`` up to ``high``; with an extra file the shorter of both ends it."""
    main = SampleFile(order["path"], tuple(order["gains"]), tuple(order["zeros"]))
    extra, frames, width = None, order["frames"], main.width
    if order["extra_path"] is not None:
        extra = SampleFile(order["extra_path"], tuple(order["extra_gains"]), tuple(order["extra_zeros"]))
        frames, width = min(frames, order["extra_frames"]), width + extra.width
    end = frames if high is None else min(frames, high)
    step = max(1, range_bytes // width)
    # cuts lie at multiples of the step in every read, whatever the bounds are
    for cut in range(low // step * step, end, step):
        first = max(cut, low)
        n = min(cut + step, end) - first
        if n > 0:
            yield Range(order[KEY], order["sampling_rate_hz"], bool(order["has_respiration"]), main, extra, first, n)


def packed(ranges: Iterable[Range], range_bytes: int = RANGE_BYTES) -> list[Work]:
    """Ranges in tasks of up to ``range_bytes`` (one range at least), so that many short records share a task."""
    made, size = [Work()], 0
    for r in ranges:
        bytes_of = r.n * (r.main.width + (r.extra.width if r.extra else 0))
        if made[-1].ranges and size + bytes_of > range_bytes:
            made.append(Work())
            size = 0
        made[-1].ranges.append(r)
        size += bytes_of
    return made


def decode(work: Work, at_once: int = AT_ONCE):
    """Arrow batches of the ranges of a task."""
    from contextlib import ExitStack

    import numpy as np
    import pyarrow as pa

    def numbers(stream, file: SampleFile, count: int) -> np.ndarray:
        raw = stream.read(count * file.width)
        if len(raw) != count * file.width:
            raise ValueError(f"{file.path} ended inside a range; it was shortened after it was listed")
        values = np.frombuffer(raw, dtype="<i2").reshape(count, len(file.gains))
        return (values - np.array(file.zeros)) / np.array(file.gains)

    for r in work.ranges:
        with ExitStack() as open_files:
            streams = []
            for file in (r.main, r.extra):
                if file is not None:
                    stream = open_files.enter_context(readers._open(file.path))
                    stream.seek(r.first * file.width)
                    streams.append((stream, file))
            for start in range(r.first, r.first + r.n, at_once):
                count = min(at_once, r.first + r.n - start)
                made = [numbers(stream, file, count) for stream, file in streams]
                nothing = pa.nulls(count, pa.float64())
                rest = [pa.array(made[1][:, i]) for i in range(len(EXTRA_CHANNELS))] if r.extra else [nothing] * len(EXTRA_CHANNELS)
                yield pa.record_batch(
                    [
                        pa.array([r.record] * count, pa.string()),
                        pa.array(np.arange(start, start + count)),
                        pa.array(made[0][:, 0]),
                        *rest,
                        pa.array([r.rate] * count, pa.int32()),
                        pa.array([r.has_extra] * count, pa.bool_()),
                    ],
                    names=SCHEMA.fieldNames(),
                )


class PairedReader(DataSourceReader):
    """Planner and reader of one scan."""

    def __init__(self, options: dict[str, str]):
        self.orders = options["orders"]
        self.range_bytes = int(options.get("rangebytes", RANGE_BYTES))
        self.low = int(options.get("low", 0))
        self.high = int(options["high"]) if "high" in options else None

    def partitions(self) -> list[Work]:
        ranges = (r for order in read_orders(self.orders) for r in ranges_of(order, self.low, self.high, self.range_bytes))
        return packed(ranges, self.range_bytes)

    def read(self, partition: Work):
        return decode(partition)


class PairedSource(DataSource):
    """``orders``: path of the work orders; ``rangeBytes``: bytes of a range; ``low``, ``high``: first frame and frame after the last."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> PairedReader:
        return PairedReader({k.lower(): v for k, v in self.options.items()})


def read_orders(path: str) -> Iterator[dict]:
    """Work orders in order of record."""
    import pyarrow.dataset as ds

    system, inner = readers.file_system(path)
    yield from ds.dataset(inner, filesystem=system, format="parquet").to_table().sort_by(KEY).to_pylist()


def work_orders(spark: SparkSession, raw_dir: str, facts: DataFrame) -> DataFrame:
    """One row for each record with a main file: both files, calibrations, rate.

    ``facts`` has recording_id, sampling_rate_hz and has_respiration; the extra file of a record counts only where it
    has respiration. Files that cannot be read whole raise, see ``readers.read_samples``.
    """
    calibration = readers.calibrations(readers.read_headers(spark, raw_dir, "*.hea"))
    main = readers._sample_files(spark, raw_dir, 1, "[a-zA-Z][0-9][0-9].dat", calibration).select(
        F.lower(KEY).alias(KEY), "path", F.col("_frames").alias("frames"), "gains", "zeros"
    )
    extra = readers._sample_files(spark, raw_dir, len(EXTRA_CHANNELS), "[a-zA-Z][0-9][0-9]r.dat", calibration).select(
        F.regexp_replace(F.lower(KEY), "r$", "").alias(KEY),
        F.col("path").alias("extra_path"),
        F.col("_frames").alias("extra_frames"),
        F.col("gains").alias("extra_gains"),
        F.col("zeros").alias("extra_zeros"),
    )
    joined = join_lookup(main, facts.select(KEY, "sampling_rate_hz", "has_respiration"), [KEY], "inner", computed=True)
    paired = joined.join(extra, KEY, "left")
    allowed = F.coalesce("has_respiration", F.lit(False))
    return paired.select(
        *joined.columns, *[F.when(allowed, F.col(c)).alias(c) for c in extra.columns if c != KEY]
    )


def read_paired(
    spark: SparkSession,
    orders: DataFrame,
    records: Sequence[str] | None = None,
    low: int = 0,
    high: int | None = None,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Samples of work orders: recording_id, sample_index, all channels, rate, has_respiration.

    ``records``, ``low`` and ``high`` (behind the last) say which records and sample indexes are wanted; no other part of a file is
    read. Extra channels are NULL for a record without an extra file; a record with one ends with the shorter of both.
    """
    path = scratch_path(spark, "work-orders")
    kept = orders if records is None else orders.where(F.col(KEY).isin(list(records)))
    kept.write.parquet(path)
    spark.dataSource.register(PairedSource)
    reader = spark.read.format(FORMAT).option("orders", path).option("rangeBytes", str(range_bytes)).option("low", str(max(0, low)))
    if high is not None:
        reader = reader.option("high", str(high))
    return reader.load()
