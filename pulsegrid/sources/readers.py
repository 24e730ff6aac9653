"""Readers: headers, binary samples, JSON artifacts, metadata."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.schema import METADATA_ENTRY
from pulsegrid.session import materialise, named
from pulsegrid.sources.files import list_files, stem

UNITS_PER_MILLIVOLT = 200.0  # fixed value of the sample format
SAMPLE_BYTES = 2


def _blank_or_comment(line: Column) -> Column:
    return (line == "") | line.startswith("#")


def parse_headers(texts: DataFrame, path: str = "path", value: str = "value") -> DataFrame:
    """Record name, rate, sample count, channel names and channels of header texts, one per row.

    The whole parse is array expressions inside the row. A channel line starts with a
    ``.dat`` file name; its description is everything from the ninth token on, else the
    last token. The first other line with a number in its place gives rate and length.
    ``channels`` holds file, format, gain and zero of each channel line: the third token is
    ``gain(baseline)/units``; without a baseline the fifth token (the zero of the converter)
    counts, without a gain (or with zero) 200 units a millivolt.
    """
    trimmed = F.transform(F.split(F.col(value), "\r\n|\n|\r"), lambda x: F.btrim(x, F.lit(" \t\r\n\f")))
    lines = F.filter(trimmed, lambda x: ~_blank_or_comment(x))
    tokens = F.transform(lines, lambda x: F.split(x, r"\s+"))
    channel = lambda t: F.element_at(t, 1).endswith(".dat")
    described = lambda t: (
        F.when(F.size(t) >= 9, F.array_join(F.slice(t, 9, F.size(t)), " "))
        .when(F.size(t) >= 2, F.element_at(t, -1)).otherwise(F.lit("Unknown"))
    )
    split = texts.select(F.col(path).alias("path"), tokens.alias("tokens"))

    def calibration(t: Column) -> Column:
        scale = F.coalesce(F.get(t, F.lit(2)), F.lit(""))
        gain = F.nullif(F.regexp_extract(scale, r"^([+-]?[0-9.]+(?:[eE][+-]?[0-9]+)?)", 1), F.lit("")).try_cast("double")
        base = F.nullif(F.regexp_extract(scale, r"\(([+-]?\d+)\)", 1), F.lit("")).try_cast("double")
        zero = F.get(t, F.lit(4)).try_cast("double")
        return F.struct(
            F.element_at(t, 1).alias("file"),
            F.coalesce(F.get(t, F.lit(1)), F.lit("16")).alias("format"),
            F.coalesce(F.nullif(gain, F.lit(0.0)), F.lit(UNITS_PER_MILLIVOLT)).alias("gain"),
            F.coalesce(base, zero, F.lit(0.0)).alias("zero"),
        )

    parted = split.select(
        "path",
        F.transform(F.filter("tokens", channel), calibration).alias("channels"),
        F.transform(F.filter("tokens", channel), described).alias("signals"),
        F.filter("tokens", lambda t: ~channel(t)).alias("_record"),
    )
    number = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
    whole = r"^[+-]?\d+$"
    rate = F.try_element_at(
        F.filter("_record", lambda t: (F.size(t) >= 3) & F.coalesce(F.get(t, F.lit(2)).rlike(number), F.lit(False))), F.lit(1)
    )
    # a length counts only on a line whose rate is usable (or already known) as well
    length = F.try_element_at(
        F.filter(
            "_record",
            lambda t: (F.size(t) >= 4)
            & F.coalesce(F.get(t, F.lit(3)).rlike(whole), F.lit(False))
            & F.coalesce(F.get(t, F.lit(2)).rlike(number), F.lit(False)),
        ),
        F.lit(1),
    )
    name = F.element_at(F.try_element_at(F.col("_record"), F.lit(1)), 1)
    return parted.select(
        "path",
        name.alias("record_name"),
        F.get(rate, F.lit(2)).cast("double").cast("int").alias("sampling_rate_hz"),
        F.get(length, F.lit(3)).cast("long").alias("num_samples"),
        "signals",
        "channels",
    )


def calibrations(headers: DataFrame) -> DataFrame:
    """One row per sample file that headers name: name, formats, gains, zeros in channel order.

    A file that several headers describe takes the description with the most channels.
    """
    each = headers.select("path", F.posexplode("channels").alias("_at", "c")).select("path", "_at", "c.*")
    files = each.groupBy("path", F.col("file").alias("name")).agg(
        F.array_sort(F.collect_list(F.struct("_at", "format", "gain", "zero"))).alias("c")
    )
    best = files.groupBy("name").agg(F.max_by("c", F.struct(F.size("c"), "path")).alias("c"))
    return best.select("name", F.col("c.format").alias("formats"), F.col("c.gain").alias("gains"), F.col("c.zero").alias("zeros"))


#: Character that ends a header in files of many headers; it has no place in a header.
HEADER_END = "\x1e"


def read_headers(spark: SparkSession, path: str, glob: str | None = None, separator: str | None = None) -> DataFrame:
    """Headers of all files below a folder; a header is small, so it is one row.

    A file is one header, or with a ``separator`` many that it parts (see ``exports.write_headers``).
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if separator:
        reader = reader.option("lineSep", separator)
    texts = reader.text(path, wholetext=not separator).select(F.col("_metadata.file_path").alias("path"), "value")
    return parse_headers(texts)


def file_system(path: str):
    """File system that Arrow knows and the path inside it."""
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:") :]
    return fs.FileSystem.from_uri(path)


def _open(path: str):
    """Input stream of a file on any file system that Arrow knows."""
    system, inner = file_system(path)
    return system.open_input_file(inner)


def _sample_files(spark: SparkSession, path: str, channels: int, glob: str | None, calibration: DataFrame | None, bits: int = 8 * SAMPLE_BYTES) -> DataFrame:
    """path, recording_id, frames, gains, zeros of sample files; raises on what cannot be read whole."""
    width = channels * bits // 8
    files = list_files(spark, path, glob).withColumn("recording_id", stem(F.col("name")))
    if calibration is None:
        same = lambda v: F.array(*[F.lit(v)] * channels)
        files = files.withColumns({"formats": same(str(bits)), "gains": same(UNITS_PER_MILLIVOLT), "zeros": same(0.0)})
    else:
        files = files.join(calibration, "name", "left")
    files = materialise(files.select("path", "name", "recording_id", "length", "formats", "gains", "zeros"))
    faults = {
        "are not described by a header": F.col("formats").isNull(),
        f"do not have {channels} channels": F.size("formats") != channels,
        f"are not in format {bits}": F.exists("formats", lambda f: f != str(bits)),
        f"end with a part of a frame of {width} bytes": F.col("length") % width != 0,
    }
    for what, wrong in faults.items():
        lost = named(files.where(wrong), "name")
        if lost:
            raise ValueError(f"sample files that {what}: {lost}")
    return files.select("path", "recording_id", F.floor(F.col("length") / width).cast("long").alias("_frames"), "gains", "zeros")


def read_samples(
    spark: SparkSession,
    path: str,
    channels: Sequence[str] = ("ecg_value",),
    glob: str | None = "*.dat",
    max_samples: int | None = None,
    calibration: DataFrame | None = None,
    range_bytes: int = 128 << 20,
    bits: int = 8 * SAMPLE_BYTES,
) -> DataFrame:
    """Interleaved 16-bit (format 32: 32-bit) little-endian samples as rows (recording_id, sample_index, channels).

    A value is (number - zero) / gain of its channel, as ``calibration`` (see ``calibrations``)
    says for its file; without it, 200 units from zero for every channel. Files that are not
    described, have other channels or another format, or end inside a frame raise.

    Files are cut into byte ranges that are spread over the tasks, so a file of any size is
    read in parallel and no file is held whole. A task takes several ranges if there are more
    than a few for each core.
    """
    import numpy as np

    names = list(channels)
    kind = {16: "<i2", 32: "<i4"}[bits]
    width = len(names) * bits // 8
    step = max(1, range_bytes // width)
    files = _sample_files(spark, path, len(names), glob, calibration, bits)
    if max_samples is not None:
        files = files.withColumn("_frames", F.least("_frames", F.lit(max_samples).cast("long")))
    ranges = files.where("_frames > 0").select(
        "path", "recording_id", "gains", "zeros",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("_frames") - 1, F.lit(step).cast("long"))).alias("first"),
        "_frames",
    )
    ranges = ranges.withColumn("n", F.least(F.lit(step).cast("long"), F.col("_frames") - F.col("first"))).drop("_frames")
    # an explicit number, because AQE would merge these few bytes of work orders into one task
    total = files.agg(F.sum(F.ceil(F.greatest("_frames", F.lit(0)) / step))).first()[0] or 1
    ranges = ranges.repartition(max(1, min(int(total), 16 * spark.sparkContext.defaultParallelism)))
    at_once = 200_000

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                with _open(row.path) as stream:
                    stream.seek(row.first * width)
                    for start in range(0, row.n, at_once):
                        count = min(at_once, row.n - start)
                        raw = np.frombuffer(stream.read(count * width), dtype=kind).reshape(count, len(names))
                        first = row.first + start
                        yield pd.DataFrame(
                            {
                                "recording_id": row.recording_id,
                                "sample_index": np.arange(first, first + count, dtype="int64"),
                                **{n: (raw[:, i] - row.zeros[i]) / row.gains[i] for i, n in enumerate(names)},
                            }
                        )

    schema = T.StructType(
        [T.StructField("recording_id", T.StringType()), T.StructField("sample_index", T.LongType())]
        + [T.StructField(n, T.DoubleType()) for n in names]
    )
    return ranges.mapInPandas(load, schema)


def read_jsonl(
    spark: SparkSession, path: str, schema: T.StructType, recursive: bool = False, position: str | None = None
) -> DataFrame:
    """One object per line, blank lines skipped, a broken line fails the read.

    ``position`` names a column for the place of the line: it grows along each file.
    """
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    rows = reader.json(path)
    return rows.withColumn(position, F.monotonically_increasing_id()) if position else rows


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files that hold one array of objects each."""
    return spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", "true").json(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """An object keyed by record name, as one row per record."""
    texts = spark.read.text(path, wholetext=True)
    parsed = F.from_json("value", T.MapType(T.StringType(), METADATA_ENTRY), {"mode": "FAILFAST"})
    return texts.select(F.explode(parsed).alias("_key", "m")).select(
        F.coalesce("m.record_name", "_key").alias("record_name"),
        *[f"m.{f.name}" for f in METADATA_ENTRY.fields if f.name != "record_name"],
    )


def preview_text(spark: SparkSession, path: str, n: int, glob: str | None = None) -> DataFrame:
    """First n lines of each text file."""
    from pulsegrid.operators.reshape import preview_lines

    reader = spark.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return preview_lines(reader.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value"), n)
