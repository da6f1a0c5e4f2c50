"""Wide CSV and JSON-lines sinks; one file where the consumer wants one, a folder of parts at scale."""

from __future__ import annotations

import csv
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.text import blank
from ..operators.quality import changed_rows
from ..schema import to_wide


def written(df: DataFrame, save: Callable[[DataFrame], None], single: bool) -> int:
    """Save ``df`` and give its number of rows, counted as they are written."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("n"))
    save(counted.coalesce(1) if single else counted)
    return seen.get["n"]


def csv_field(value: Column, alone: bool = False) -> Column:
    """A value as it stands in CSV: in quotes only if it holds a comma, a quote or a line end (or is empty and ``alone`` in its row)."""
    quoted = F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
    needs = value.rlike('[,"\r\n]')
    return F.when(needs | (value == "") if alone else needs, quoted).otherwise(value)


def csv_line(columns: Sequence[Column | str]) -> Column:
    """A record of CSV, without its end."""
    values = [blank((F.col(c) if isinstance(c, str) else c).cast("string")) for c in columns]
    return F.concat_ws(",", *(csv_field(v, len(values) == 1) for v in values))


def write_csv(df: DataFrame, path: str, columns: Sequence[str], single: bool = True) -> int:
    """Header, fixed columns, minimal quoting, CRLF behind each record and values as they are: byte for byte what Python's ``csv``
    writes. Overwrites, gives the number of rows.

    Records are made by column expressions and written as lines of text, so Spark commits the parts, in whatever store. Parts
    stand in the rows' order and the header alone in the first, so the parts' bytes, joined by name, are the one file."""
    wide = to_wide(df, columns)
    seen = Observation()
    lines = wide.observe(seen, F.count(F.lit(1)).alias("n")).select(csv_line(columns).alias("value"))
    head = df.sparkSession.range(0, 1, 1, 1).select(csv_line([F.lit(c) for c in columns]).alias("value"))
    made = head.union(lines.coalesce(1) if single else lines)
    (made.coalesce(1) if single else made).write.mode("overwrite").option("lineSep", "\r\n").text(path)
    return seen.get["n"]


def read_csv(spark, path: str) -> DataFrame:
    """What :func:`write_csv` wrote: all strings, empty where nothing stood. Line ends inside values come back as line feeds."""
    first = spark.read.option("lineSep", "\r\n").text(f"{path.rstrip('/')}/part-00000*").first()[0]
    columns = next(csv.reader([first]))
    rows = spark.read.schema(", ".join(f"`{c}` string" for c in columns)).option("multiLine", True).option("escape", '"').option("lineSep", "\r\n").csv(path).fillna("")
    header = F.lit(True)
    for c in columns:
        header = header & (F.col(f"`{c}`") == c)
    return rows.filter(~header)


def write_jsonl(df: DataFrame, path: str, columns: Sequence[str] | None = None, single: bool = True) -> int:
    """A JSON object on each line; every column stands in it, empty or not."""
    return written(to_wide(df, columns or df.columns), lambda d: d.write.mode("overwrite").json(path), single)


def write_diff(compared: DataFrame, path: str, columns: list[str]) -> int:
    """The changed rows of a replay as CSV."""
    return write_csv(changed_rows(compared, columns), path, compared.columns)
