"""Checks of single fields of objects that come as YAML or JSON."""

from __future__ import annotations

from typing import Any


class Must:
    """No default. A class, as it is the same thing on every executor."""


MUST = Must


def whole(value: Any) -> bool:
    return isinstance(value, int) and not isinstance(value, bool)


def whole_numbers(value: Any) -> bool:
    return isinstance(value, list) and all(whole(x) and abs(x) < 1 << 63 for x in value)


def strings(value: Any) -> bool:
    return isinstance(value, list) and all(isinstance(x, str) for x in value)


def string_map(value: Any) -> bool:
    return isinstance(value, dict) and all(isinstance(x, str) for x in value.values())


def truths(value: Any) -> bool:
    return isinstance(value, str) or strings(value)


def fault(value: Any, kind: Any, *bounds: Any) -> str | None:
    """kind: a type, or a function that says whether a value fits."""
    if not isinstance(kind, type):
        return None if kind(value) else "wrong_type"
    if kind is int and isinstance(value, int) and abs(value) >= 1 << 63:
        return "out_of_range"
    if isinstance(value, bool) and kind is not bool or not isinstance(value, (int, float) if kind is float else kind):
        return "wrong_type"
    if bounds and isinstance(bounds[0], tuple):
        return None if value in bounds[0] else "not_a_choice"
    if bounds and (value <= 0 if bounds[0] == "+" else value < bounds[0]) or len(bounds) > 1 and value > bounds[1]:
        return "out_of_range"
    return None


def section(given: dict, fields: dict[str, tuple], name: str) -> tuple[dict, list[str]]:
    """(values with defaults, problems) of one section."""
    if not isinstance(given, dict):
        return section({}, fields, name)[0], [f"{name}: wrong_type"]
    problems = [f"{name}.{k}: unknown_field" for k in given if k not in fields]
    values = {}
    for k, (kind, default, *bounds) in fields.items():
        value = given.get(k, default)
        if value is MUST or value is None and default is MUST:
            problems.append(f"{name}.{k}: missing")
            value = None
        elif value is not None and (f := fault(value, kind, *bounds)):
            problems.append(f"{name}.{k}: {f}")
        values[k] = value
    return values, problems


