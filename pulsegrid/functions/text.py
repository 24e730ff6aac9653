"""Text rules for labels, names and sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label texts that mean an event minute.
EVENT_LABELS = ("a", "apnea", "1")
# Recordings cut from one original session share a subject.
SHARED_SUBJECTS = {"c05": "subject_c05_c06", "c06": "subject_c05_c06"}
# Size units in rising order.
SIZE_UNITS = ("B", "KB", "MB", "GB", "TB")

_SPACE = " \t\n\r\f\x0b"


def strip(text: Column) -> Column:
    """Trim blanks, tabs and line ends on both sides."""
    return F.btrim(text, F.lit(_SPACE))


def parse_label(aux: Column, symbol: Column) -> Column:
    """The note if it has content, else the symbol, else an empty text."""
    filled = lambda c: F.nullif(strip(c), F.lit(""))
    return F.coalesce(filled(aux), filled(symbol), F.lit(""))


def label_to_bool(label: Column) -> Column:
    return F.lower(strip(label)).isin(*EVENT_LABELS)


def category(record: Column) -> Column:
    return F.lower(F.substring(record, 1, 1))


def dataset_split(record: Column) -> Column:
    """``test`` for records of category x, else ``learning``."""
    return F.when(category(record) == "x", "test").otherwise("learning")


def subject_of(record: Column, shared: dict[str, str] | None = None) -> Column:
    shared = SHARED_SUBJECTS if shared is None else shared
    own = F.concat(F.lit("subject_"), record)
    if not shared:
        return own
    table = F.create_map(*[F.lit(x) for pair in shared.items() for x in pair])
    return F.coalesce(F.try_element_at(table, record), own)


def safe_name(text: Column) -> Column:
    """Runs of other characters become one underscore; outer underscores go."""
    return F.btrim(F.regexp_replace(text.cast("string"), "[^A-Za-z0-9_.-]+", "_"), F.lit("_"))


def format_bytes(size: Column) -> Column:
    """Size with the largest unit that keeps it at 1 or more, two decimals.

    The exact value is rounded, half to even: ``format_number`` does that, ``format_string`` rounds the
    shortest decimal text of the double, half up (1.125 to 1.13, 1.005 to 1.01).
    """
    size = size.cast("double")
    shown = lambda n, unit: F.concat(F.translate(F.format_number(n, 2), ",", ""), F.lit(f" {unit}"))
    out = shown(size, SIZE_UNITS[0])
    for power, unit in enumerate(SIZE_UNITS[1:], start=1):
        out = F.when(size >= 1024.0**power, shown(size / 1024.0**power, unit)).otherwise(out)
    return out
