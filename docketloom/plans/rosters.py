"""Rosters and tallies in fixed-width text: lines exploded with their place, then native expressions and windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank, col, squash

ROW = r"^\s*(\d{1,3}\.\d{3,4})\s+(\S.*?)\s{2,}(\d+(?:\s+\d+){3,5})\s*$"


def text_lines(df: DataFrame, text: str = "text") -> DataFrame:
    """A row for each line of ``text``: the other columns, pos, line."""
    rest = [c for c in df.columns if c != text]
    return df.select(*rest, F.posexplode(F.split(blank(F.col(text)), r"\r?\n|\f")).alias("pos", "line"))


def challenged_columns(text: Column | str) -> Column:
    """Places of the word Challenged in the heading (the first 40 lines, before the first row), left to right."""
    from ..functions.text import spans

    head = F.slice(F.split(blank(col(text)), r"\r?\n"), 1, 40)
    first_row = F.array_position(F.transform(head, lambda line: line.rlike(r"^\s*\d{1,3}\.\d{3,4}\s+\S")), F.lit(True))
    head = F.when(first_row > 0, F.slice(head, F.lit(1), first_row.cast("int") - 1)).otherwise(head)
    return F.array_sort(F.array_distinct(F.flatten(F.transform(head, lambda line: F.transform(spans(line, "Challenged"), lambda s: s["start"])))))


def tally_lines(lines: DataFrame, line: str = "line", challenged: str | None = None) -> DataFrame:
    """Unit rows of an election tally: names, four counts, and up to two counts of challenged ballots. A single extra count goes to
    the column whose heading is nearer (``challenged``: an array of the headings' places), else to the first."""
    t = F.col(line)
    rest = [c for c in lines.columns if c not in (line, challenged)]
    numbers = F.split(F.trim(F.regexp_extract(t, ROW, 3)), r"\s+")
    names = F.filter(F.split(F.trim(F.regexp_extract(t, ROW, 2)), r"\s{2,}"), lambda x: F.trim(x) != "")
    made = lines.filter(t.rlike(ROW)).select(*rest, *([challenged] if challenged else []), t.alias("_line"), F.regexp_extract(t, ROW, 1).alias("unit_code"), names.alias("_names"), numbers.alias("_n"))
    n = lambda k: F.get("_n", F.lit(k)).try_cast("int")
    name = lambda c: squash(blank(c))
    right = F.lit(False)
    if challenged:
        at = F.length(F.rtrim("_line")) - F.length(F.get("_n", F.lit(4)))
        right = F.coalesce((F.size(challenged) >= 2) & (at > (F.get(challenged, F.lit(0)) + F.try_element_at(challenged, F.lit(-1))) / 2), F.lit(False))
    five, six = F.size("_n") == 5, F.size("_n") == 6
    extra = lambda k: F.get("_n", F.lit(k))
    return made.select(
        *rest, "unit_code",
        name(F.get("_names", F.lit(0))).alias("employer_name"), name(F.get("_names", F.lit(1))).alias("union_name"), name(F.array_join(F.slice("_names", 3, 1000), " ")).alias("bargaining_unit_name"),
        n(0).cast("string").alias("unit_population"), n(1).cast("string").alias("votes_cast"), n(2).cast("string").alias("votes_yes"), n(3).cast("string").alias("votes_no"),
        F.when(six | (five & ~right), extra(4)).otherwise(F.lit("")).alias("challenged_unit_population"),
        F.when(six, extra(5)).when(five & right, extra(4)).otherwise(F.lit("")).alias("challenged_votes"),
        F.when(n(0) > 0, F.when(n(2) * 100 >= n(0) * 51, F.lit("true")).otherwise(F.lit("false"))).otherwise(F.lit("")).alias("meets_51_percent"),
    )
