"""File listing and everything derived from file names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions import text
from pulsegrid.session import materialise, named

# Base header names, and the suffixes under which annotations are looked up.
BASE_HEADER = r"(?i)^[abcx]\d{2}\.hea$"
LABEL_SUFFIXES = ("", "r", "er")
BEAT_SUFFIXES = ("", "er")
ARTIFACTS = ("signals", "apnea", "qrs")


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"[^/]+$", 0)


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^.]*$", "")


def extension(name: Column) -> Column:
    return F.regexp_extract(name, r"\.([^.]*)$", 1)


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Files below a folder: path, name, length. Contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", file_name(F.col("path")).alias("name"), "length")


def pick_headers(files: DataFrame) -> DataFrame:
    """One header per base record: the combined one (``<id>er``) where it exists.

    Base names match without regard to case; the record name is lower case.
    """
    bases = files.where(F.col("name").rlike(BASE_HEADER)).select(F.lower(stem(F.col("name"))).alias("record_name")).distinct()
    ranked = files.where(extension(F.col("name")) == "hea").select(
        F.regexp_replace(stem(F.col("name")), "er$", "").alias("_base"),
        F.col("name").alias("header_file"),
        "path",
        stem(F.col("name")).endswith("er").cast("int").alias("_combined"),
    )
    candidates = ranked.where((F.col("_combined") == 1) | F.col("header_file").rlike(BASE_HEADER))
    best = candidates.groupBy(F.lower("_base").alias("record_name")).agg(
        F.max_by(F.struct("header_file", "path"), F.struct("_combined", "header_file")).alias("h")
    )
    return bases.join(best, "record_name").select("record_name", "h.header_file", "h.path")


def availability_flags(records: DataFrame, files: DataFrame, key: str = "record_name", signals: str = "signals") -> DataFrame:
    """Whether label file, beat file and extra channels exist for each record."""
    def seen(ext: str, suffixes: Sequence[str], out: str) -> DataFrame:
        wanted = records.select(key, F.explode(F.array(*[F.concat(F.col(key), F.lit(f"{s}.{ext}")) for s in suffixes])).alias("name"))
        return wanted.join(files.select("name").distinct(), "name", "left_semi").select(key).distinct().withColumn(out, F.lit(True))

    out = records.join(seen("apn", LABEL_SUFFIXES, "has_apnea_annotations"), key, "left")
    out = out.join(seen("qrs", BEAT_SUFFIXES, "has_qrs_annotations"), key, "left")
    extra = F.exists(signals, lambda s: F.lower(s).startswith("resp") | F.lower(s).contains("spo2"))
    return (
        out.withColumn("has_apnea_annotations", F.coalesce("has_apnea_annotations", F.lit(False)))
        .withColumn("has_qrs_annotations", F.coalesce("has_qrs_annotations", F.lit(False)))
        .withColumn("has_respiration", F.coalesce(extra, F.lit(False)))
    )


def packed_records(spark: SparkSession, root: str, files: DataFrame, key: str = "recording_id") -> DataFrame:
    """Record ids out of the lines of artifacts that keep many records in a file (``<kind>/part-...``)."""
    kind = F.regexp_extract("path", rf"/({'|'.join(ARTIFACTS)})/part-[^/]+$", 1)
    kinds = sorted(r[0] for r in files.select(kind.alias("kind")).where("kind != ''").distinct().collect())
    if not kinds:
        return spark.createDataFrame([], f"{key} string")
    lines = spark.read.text([f"{root}/{k}" for k in kinds], pathGlobFilter="part-*").select(F.json_tuple("value", key).alias(key))
    return lines.where(F.col(key).isNotNull()).distinct()


def discover_records(files: DataFrame, summary: DataFrame | None = None, key: str = "recording_id", packed: DataFrame | None = None) -> DataFrame:
    """Record ids over the artifact names, sorted; the summary's records when there are none.

    Names are ``signals_<id>.jsonl`` and the like, or folders ``<kind>/recording_id=<id>``; ``packed`` has the ids of
    records that no name tells.
    """
    kinds = "|".join(ARTIFACTS)
    by_name = F.regexp_extract("name", rf"^(?:{kinds})_(.+)\.jsonl?$", 1)
    by_folder = F.regexp_extract("path", rf"/(?:{kinds})/recording_id=([^/]+)/", 1)
    found = F.coalesce(F.nullif(by_name, F.lit("")), F.nullif(by_folder, F.lit("")))
    ids = files.select(found.alias(key)).where(F.col(key).isNotNull()).distinct()
    if packed is not None:
        ids = ids.unionByName(packed.select(key)).distinct()
    if summary is not None and ids.isEmpty():
        ids = summary.select(key).where(F.col(key).isNotNull()).distinct()
    return ids.orderBy(key)


def resolve_base(candidates: DataFrame, files: DataFrame, ext: str, required: bool = False) -> DataFrame:
    """First existing of each record's ordered candidate names.

    ``candidates`` has record_name and an array ``bases`` in order of preference. A record
    without any is absent from the result, or raises when ``required``.
    """
    ranked = candidates.select(
        "record_name", F.posexplode(F.array_distinct(F.array_compact("bases"))).alias("_rank", "base")
    ).withColumn("name", F.concat("base", F.lit(f".{ext}")))
    hits = ranked.join(files.select("name").distinct(), "name", "left_semi")
    best = hits.groupBy("record_name").agg(F.min_by("base", "_rank").alias("base"))
    if required:
        missing = candidates.select("record_name").distinct().join(best, "record_name", "left_anti")
        lost = named(materialise(missing), "record_name")
        if lost:
            raise FileNotFoundError(f"no .{ext} file for: {lost}; the result without ``required`` lacks them all")
    return best


def file_inventory(files: DataFrame) -> DataFrame:
    """Files and bytes per extension."""
    return files.groupBy(extension(F.col("name")).alias("extension")).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes")
    )


def inventory_summary(files: DataFrame, headers: DataFrame) -> DataFrame:
    """Distinct records with a base header, total samples, and a warning when there is no header."""
    names = files.where(F.col("name").rlike(BASE_HEADER)).agg(
        F.countDistinct(F.lower(stem(F.col("name")))).alias("n_records")
    )
    samples = headers.agg(F.coalesce(F.sum("num_samples"), F.lit(0)).alias("total_samples"))
    both = names.select("n_records", F.lit(0).alias("_k")).join(samples.withColumn("_k", F.lit(0)), "_k").drop("_k")
    return both.withColumn("warning", F.when(F.col("n_records") == 0, "no header files found"))


def recordings_from_headers(picked: DataFrame, headers: DataFrame, files: DataFrame, provenance: dict[str, str] | None = None) -> DataFrame:
    """Metadata rows: names, split, counts, channels, availability, chosen header.

    ``picked`` names the header of each record, ``headers`` is what was read from them;
    records whose header gave no rate or length are left out.
    """
    from pulsegrid.functions.timeline import length_seconds

    r = F.col("record_name")
    parsed = headers.select("path", "sampling_rate_hz", "num_samples", "signals")
    usable = picked.join(parsed, "path").where(F.col("sampling_rate_hz").isNotNull() & F.col("num_samples").isNotNull())
    base = usable.select(
        r, text.subject_of(r).alias("subject_id"), r.alias("source_record_name"), text.dataset_split(r).alias("split"),
        text.category(r).alias("category"), "sampling_rate_hz", "num_samples",
        length_seconds(F.col("num_samples"), F.col("sampling_rate_hz")).cast("int").alias("length_seconds"),
        "signals", F.col("header_file").alias("selected_header_file"),
        F.lit("2000-01-01 00:00:00").alias("artificial_start_time"),
    )
    out = availability_flags(base, files)
    given = provenance or {}
    return out.select("*", *[F.lit(given.get(n)).cast("string").alias(n) for n in ("source", "source_url", "doi", "license")])
