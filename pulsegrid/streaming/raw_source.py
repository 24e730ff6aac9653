"""A folder of raw records as a stream: offsets over complete records.

A record is complete when its header can be read, its sample files are as long as the header says and the mark files
asked for are there. Every trigger looks for complete records that no earlier one took and writes
their names as the next step of a ledger; the offset is the number of steps. A step, once written, never
changes, so a batch that is run again after any interruption reads the same records, and no record
is read twice. A record that is complete but cannot be decoded (another format, parts of frames) fails its batch: the
offset stays before it until the files are mended.

Samples come zipped from main and extra files as in ``sources.paired``, in frame ranges spread over the tasks.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader
from pyspark.sql.streaming import StreamingQuery

from pulsegrid.schema import EXTRA_CHANNELS
from pulsegrid.sources import paired, readers

FORMAT = "pulsegrid_raw_records"
_SCALE = re.compile(r"([+-]?[0-9.]+(?:[eE][+-]?[0-9]+)?)?(?:\(([+-]?\d+)\))?")


@dataclass(frozen=True)
class Header:
    """Rate, frames and (file, format, gain, zero) of the channels of a header text."""

    rate: int
    frames: int
    channels: tuple[tuple[str, str, float, float], ...]


def parse_header(text: str) -> Header | None:
    """The rules of ``readers.parse_headers`` for one text; None if rate or length cannot be read."""
    lines = [line.split() for line in text.splitlines() if line.strip() and not line.strip().startswith("#")]
    channels, facts = [], None
    for tokens in lines:
        if tokens[0].endswith(".dat"):
            scale = _SCALE.match(tokens[2]) if len(tokens) > 2 else None
            gain = float(scale[1]) if scale and scale[1] else 0.0
            zero = tokens[4] if len(tokens) > 4 else "0"
            base = float(scale[2]) if scale and scale[2] else float(zero) if re.fullmatch(r"[+-]?\d+", zero) else 0.0
            channels.append((tokens[0], tokens[1] if len(tokens) > 1 else "16", gain or readers.UNITS_PER_MILLIVOLT, base))
        elif facts is None and len(tokens) > 3 and re.fullmatch(r"[+-]?\d+", tokens[3]):
            try:
                facts = int(float(tokens[2])), int(tokens[3])
            except ValueError:
                continue
    return Header(*facts, tuple(channels)) if facts else None


class Folder:
    """What lies in a raw folder, by lower-case name."""

    def __init__(self, path: str):
        from pyarrow import fs

        self.system, inner = readers.file_system(path)
        self.prefix = path.rstrip("/")
        listed = self.system.get_file_info(fs.FileSelector(inner, recursive=True, allow_not_found=True))
        self.files = {f.base_name.lower(): f for f in listed if f.is_file}
        self.inner = inner

    def text(self, name: str) -> str:
        with self.system.open_input_stream(self.files[name].path) as stream:
            return stream.read().decode("utf-8", "replace")

    def url(self, name: str) -> str:
        return self.prefix + self.files[name].path[len(self.inner.rstrip("/")) :]

    def records(self) -> list[str]:
        return sorted(n[:-4] for n in self.files if re.fullmatch(r"[a-z]\d\d\.hea", n))

    def header(self, record: str) -> Header | None:
        """The combined header where there is one."""
        name = f"{record}er.hea" if f"{record}er.hea" in self.files else f"{record}.hea"
        return parse_header(self.text(name)) if name in self.files else None

    def is_complete(self, record: str, marks: tuple[str, ...]) -> bool:
        header = self.header(record)
        if header is None or not header.channels:
            return False
        for extension in marks:
            if not any(f"{record}{suffix}.{extension}" in self.files for suffix in ("", "r", "er")):
                return False
        main = f"{record}.dat"
        if main not in self.files or self.files[main].size < header.frames * readers.SAMPLE_BYTES:
            return False
        return all(file.lower() in self.files and self.files[file.lower()].size for file, *_ in header.channels)

    def order(self, record: str) -> dict:
        """The work order of a record (see ``paired``); raises if its files cannot be decoded."""
        header = self.header(record)
        if header is None:
            raise ValueError(f"the header of {record} cannot be read any more")

        def described(name: str, channels: int) -> dict:
            found = [c for c in header.channels if c[0].lower() == name]
            size = self.files[name].size
            width = channels * readers.SAMPLE_BYTES
            if len(found) != channels or any(c[1] != "16" for c in found) or size % width:
                raise ValueError(f"{name} cannot be decoded: {len(found)} channels, formats {sorted({c[1] for c in found})}, {size} bytes")
            return {"path": self.url(name), "frames": size // width, "gains": [c[2] for c in found], "zeros": [c[3] for c in found]}

        extra = f"{record}r.dat"
        has_extra = extra in self.files and any(c[0].lower() == extra for c in header.channels)
        second = described(extra, len(EXTRA_CHANNELS)) if has_extra else dict.fromkeys(("path", "frames", "gains", "zeros"))
        return {
            paired.KEY: record,
            **described(f"{record}.dat", 1),
            **{f"extra_{k}": v for k, v in second.items()},
            "sampling_rate_hz": header.rate,
            "has_respiration": has_extra,
        }


class Ledger:
    """Steps of record names, one file each; a step is written once."""

    def __init__(self, path: str):
        self.system, self.inner = readers.file_system(path)

    def _file(self, step: int) -> str:
        return f"{self.inner.rstrip('/')}/step-{step:09d}.json"

    def steps(self) -> int:
        from pyarrow import fs

        found = self.system.get_file_info(fs.FileSelector(self.inner, allow_not_found=True))
        return sum(1 for f in found if re.fullmatch(r"step-\d{9}\.json", f.base_name))

    def names(self, first: int, last: int) -> list[str]:
        """Names of the steps after ``first`` up to ``last``."""
        out = []
        for step in range(first + 1, last + 1):
            with self.system.open_input_stream(self._file(step)) as stream:
                out += json.loads(stream.read())
        return out

    def add(self, names: list[str]) -> int:
        step = self.steps() + 1
        self.system.create_dir(self.inner, recursive=True)
        unfinished = f"{self.inner.rstrip('/')}/{uuid.uuid4().hex}.tmp"
        with self.system.open_output_stream(unfinished) as stream:
            stream.write(json.dumps(names).encode())
        self.system.move(unfinished, self._file(step))
        return step


class RawReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.ledger_path = options["path"], options["ledger"]
        self.range_bytes = int(options.get("rangebytes", paired.RANGE_BYTES))
        self.marks = tuple(m for m in options.get("marks", "apn").split(",") if m)
        self.at_most = int(options["recordsperbatch"]) if "recordsperbatch" in options else None

    def initialOffset(self) -> dict:
        return {"step": 0}

    def latestOffset(self) -> dict:
        ledger, folder = Ledger(self.ledger_path), Folder(self.path)
        steps = ledger.steps()
        taken = set(ledger.names(0, steps))
        fresh = [r for r in folder.records() if r not in taken and folder.is_complete(r, self.marks)]
        return {"step": ledger.add(fresh[: self.at_most]) if fresh else steps}

    def partitions(self, start: dict, end: dict) -> list[paired.Work]:
        folder = Folder(self.path)
        names = Ledger(self.ledger_path).names(start["step"], end["step"])
        orders = [folder.order(name) for name in names]  # all of them, before any is decoded
        return paired.packed((r for o in orders for r in paired.ranges_of(o, range_bytes=self.range_bytes)), self.range_bytes)

    def read(self, partition: paired.Work) -> Iterator:
        return paired.decode(partition)

    def commit(self, end: dict) -> None:
        pass


class RawSource(DataSource):
    """``path``: folder of raw files; ``ledger``: folder of the steps, kept beside the checkpoint; ``marks``: mark files a record needs."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return paired.SCHEMA

    def streamReader(self, schema: T.StructType) -> RawReader:
        return RawReader({k.lower(): v for k, v in self.options.items()})


def raw_stream(spark: SparkSession, raw_dir: str, ledger: str, **options: str) -> DataFrame:
    """Samples of complete records as a stream; options as in ``RawSource``."""
    spark.dataSource.register(RawSource)
    reader = spark.readStream.format(FORMAT).option("path", raw_dir).option("ledger", ledger)
    return reader.options(**options).load()


def start_decoding(samples: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Write the samples of every batch under its number (a batch that is run again writes the same folder again)."""

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return samples.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
