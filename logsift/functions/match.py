"""Column expressions that test a line against a pattern catalogue.

Every catalogue entry becomes one predicate in the plan. Plain-text patterns
(19 of the 23 defaults) compile to ``contains``, a byte search with no regex
engine; the rest to ``rlike`` (Java regex, searched anywhere in the line, as
``find``) behind a ``contains`` of the literal text the regex requires.
Entries sharing an id are OR-ed into one predicate.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.patterns import Pattern, grouped

FIELDS_TYPE = "array<struct<regexId:string,occurrence:int,field:string,value:string>>"
MATCH_ARRAY_TYPE = "array<struct<regexId:string,matched_text:string>>"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pattern_predicate(line, pattern: Pattern, use_literals: bool = True) -> Column:
    """A plain-text pattern is a ``contains``; a regex is an ``rlike``
    guarded by a ``contains`` of the text every match must hold, so the
    regex engine only runs on lines that can match."""
    line = _col(line)
    if not use_literals:
        return line.rlike(pattern.pattern)
    lit = pattern.literal()
    if lit is not None:
        return line.contains(F.lit(lit))
    req = pattern.required_literal()
    if req is not None:
        return line.contains(F.lit(req)) & line.rlike(pattern.pattern)
    return line.rlike(pattern.pattern)


def id_predicates(line, patterns: list[Pattern], use_literals: bool = True) -> list[tuple[str, Column]]:
    """(regex_id, predicate) per distinct id, in catalogue order."""
    out = []
    for rid, members in grouped(patterns):
        pred = None
        for p in members:
            q = pattern_predicate(line, p, use_literals)
            pred = q if pred is None else (pred | q)
        out.append((rid, pred))
    return out


def matched_ids(line, patterns: list[Pattern], use_literals: bool = True) -> Column:
    """Array with one element per catalogue id: the id when it matches,
    otherwise null. Exploding it and dropping nulls gives the match rows
    without building structs."""
    line = _col(line)
    return F.array(*[F.when(pred, F.lit(rid)) for rid, pred in id_predicates(line, patterns, use_literals)])


def match_array(line, patterns: list[Pattern], use_literals: bool = True) -> Column:
    """``array<struct<regexId, matched_text>>`` of every matching id in
    catalogue order; ``matched_text`` is the whole line. Empty or null line
    gives an empty array."""
    line = _col(line)
    elems = [
        F.when(pred, F.struct(F.lit(rid).alias("regexId"), line.alias("matched_text")))
        for rid, pred in id_predicates(line, patterns, use_literals)
    ]
    arr = F.filter(F.array(*elems), lambda x: x.isNotNull())
    empty = F.array().cast(MATCH_ARRAY_TYPE)
    return F.when(line.isNull() | (line == ""), empty).otherwise(arr)


def fields(line, patterns: list[Pattern]) -> Column:
    """``array<struct<regexId, occurrence, field, value>>``: the text of every
    capture group of every place where a pattern is found, in catalogue order;
    ``occurrence`` counts the places from 1. A group that takes no part in a
    match is ``''``. The regex runs only on lines that hold the text it needs."""
    line = _col(line)
    none = F.array().cast(FIELDS_TYPE)

    def rows(p: Pattern, g: int, name: str) -> Column:
        def row(value: Column, i: Column) -> Column:
            return F.struct(
                F.lit(p.regex_id).alias("regexId"), (i + 1).alias("occurrence"), F.lit(name).alias("field"), value.alias("value")
            )

        found = F.transform(F.regexp_extract_all(line, F.lit(p.pattern), F.lit(g)), row)
        req = p.required_literal()
        return found if req is None else F.when(line.contains(F.lit(req)), found).otherwise(none)

    parts = [rows(p, g, name) for p in patterns for g, name in enumerate(p.group_names(), start=1)]
    return F.concat(*parts) if parts else none
