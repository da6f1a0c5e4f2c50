"""Ordered rules and lookups as expressions that Catalyst folds and short-circuits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import blank, col

#: The canonical case types. Fixed values.
CANONICAL = ("CERTIFICATION", "DECERTIFICATION", "UNIT_CLARIFICATION", "UNIT_MODIFICATION", "AMENDMENT_OF_CERTIFICATION", "RECOGNITION", "ULP", "NEGOTIABILITY", "IMPASSE", "ARBITRATION", "FACT_FINDING", "SEVERANCE")


def first_match(text: Column | str, rules: Sequence[tuple[str, str]], default: str = "") -> Column:
    """The label of the first rule (pattern, label) whose pattern occurs in the text; later rules are never tried."""
    t, out = blank(col(text)), None
    for pattern, label in rules:
        hit = t.rlike(pattern)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def lookup(key: Column | str, values: Mapping[str, str], default: Column | str = "") -> Column:
    """values[key], or ``default`` for keys that aren't there."""
    table = F.create_map(*map(F.lit, chain.from_iterable(values.items())))
    other = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.try_element_at(table, col(key)), other)


def canonical_case_type(code: Column | str, native: Mapping[str, str]) -> Column:
    """A native code as a canonical type; a code that nothing maps passes through, upper-case."""
    key = F.upper(F.trim(blank(col(code))))
    return F.when(key.isin(*CANONICAL), key).otherwise(lookup(key, native, key) if native else key)


def matched_rule(rules: Sequence[tuple[str, Column]], default: str = "") -> Column:
    """The name of the first rule whose condition holds: the provenance column beside a ``coalesce`` or ``when`` chain."""
    out = None
    for name, condition in rules:
        out = F.when(condition, F.lit(name)) if out is None else out.when(condition, F.lit(name))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)
