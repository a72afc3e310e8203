"""Validation rules as column expressions; the first rule that matches names the reason.

A kind has dozens of rules, so they are put together as SQL text and handed to
Spark as one expression.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from graphlib import TopologicalSorter

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside import catalogue as cat
from quayside.catalogue import Kind

Test = tuple[str, str]
"""A field's name, and the condition under which the row violates the rule there."""


def quoted(names: Iterable[str]) -> str:
    return ", ".join(f"'{n}'" for n in names)


def is_kind(names: Iterable[str]) -> str:
    return f"equipment_type IN ({quoted(names)})"


def _absent(name: str) -> str:
    return f"`{name}` IS NULL"


def _outside(name: str, low: float, high: float) -> str:
    # NULL compares to NULL, which is no violation; NaN sorts above every bound.
    return f"(`{name}` < {float(low)}D OR `{name}` > {float(high)}D)"


def missing(kind: Kind) -> list[Test]:
    return [(name, _absent(name)) for name in kind.critical]


def out_of_range(kind: Kind) -> list[Test]:
    return [(name, _outside(name, low, high)) for name, low, high in kind.limits]


def _listed(prefix: str, tests: list[Test]) -> str:
    """``prefix`` and the comma-joined names of the violated fields, or NULL.

    Names are only put together for rows that violate something.
    """
    violated = " OR ".join(test for _, test in tests)
    names = ", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, test in tests)
    return f"CASE WHEN {violated} THEN concat('{prefix}', concat_ws(',', {names})) END"


def _first_match(
    absent: list[Test], outside: list[Test], state_domain: Sequence[str] | None
) -> Column:
    rules = [
        f"CASE WHEN equipment_id IS NULL OR trim(equipment_id) = '' THEN '{cat.MISSING_ID}' END",
        f"CASE WHEN timestamp IS NULL OR trim(timestamp) = '' THEN '{cat.MISSING_TIMESTAMP}' END",
        f"CASE WHEN event_timestamp IS NULL THEN '{cat.INVALID_TIMESTAMP}' END",
        _listed(cat.MISSING_MEASURE, absent),
        _listed(cat.OUT_OF_RANGE, outside),
    ]
    if state_domain is not None:
        known = f"coalesce(state IN ({quoted(state_domain)}), false)"
        rules.append(f"CASE WHEN NOT {known} THEN '{cat.INVALID_STATE}' END")
    return F.expr(f"coalesce({', '.join(rules)})")


def reject_reason(kind: Kind, state_domain: Sequence[str] | None = None) -> Column:
    """NULL for a valid row. Expects raw field names plus ``event_timestamp``."""
    return _first_match(missing(kind), out_of_range(kind), state_domain)


def reject_reason_mixed(
    kinds: Sequence[Kind], state_domain: Sequence[str] | None = None
) -> Column:
    """The same over wide rows of several kinds, told apart by ``equipment_type``.

    Kinds share most fields, so each (field, limits) pair is tested once, for the
    kinds that have it, instead of once per kind. Fields a kind lacks are NULL.
    """
    order: TopologicalSorter[str] = TopologicalSorter()
    having: dict[tuple[str, float, float], list[str]] = {}
    critical: dict[str, list[str]] = {}
    for kind in kinds:
        before: tuple[str, ...] = ()
        for limit in kind.limits:
            order.add(limit[0], *before)
            before = (limit[0],)
            having.setdefault(limit, []).append(kind.name)
        for name in kind.critical:
            critical.setdefault(name, []).append(kind.name)

    absent: list[Test] = []
    outside: list[Test] = []
    for name in order.static_order():
        if name in critical:
            absent.append((name, f"({is_kind(critical[name])} AND {_absent(name)})"))
        variants = [(limit, names) for limit, names in having.items() if limit[0] == name]
        for limit, names in variants:
            test = _outside(*limit)
            outside.append((name, f"({is_kind(names)} AND {test})" if len(variants) > 1 else test))
    return _first_match(absent, outside, state_domain)


def violated_fields(kind: Kind) -> Column:
    """Array of (rule, field), one entry per violated field of the row."""
    rules = ((cat.MISSING_MEASURE, missing(kind)), (cat.OUT_OF_RANGE, out_of_range(kind)))
    entries = ", ".join(
        f"CASE WHEN {test} THEN named_struct('rule', '{rule.rstrip(':')}', 'field', '{name}') END"
        for rule, tests in rules
        for name, test in tests
    )
    return F.expr(f"array_compact(array({entries}))")
