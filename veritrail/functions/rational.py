"""Exact value of short arithmetic expressions, by precedence climbing over fractions.

Numbers are Python literals (a decimal stands for its shortest decimal form, so 0.1 is exactly 1/10); operators are
unary and binary plus and minus, *, / and **, the last with an integer exponent of at most 20 either way. Anything else has
no value. Numerators and denominators are limited to MAX_BITS, so that no row can exhaust an executor.
"""

from __future__ import annotations

import re
from fractions import Fraction

MAX_BITS = 4096
MAX_POWER = 20
MAX_DEPTH = 150
NUMBER = re.compile(r"(?:\d+\.\d*|\.\d+|\d+)(?:[eE][+-]?\d+)?")
SYMBOL = re.compile(r"\*\*|[-+*/()]")


class NoValue(Exception):
    """The text isn't an expression that has a bounded exact value."""


def value_of(text: str) -> Fraction | None:
    try:
        tokens = cut(text)
        out, at = climb(tokens, 0, 0, 0)
        return out if at == len(tokens) else None
    except (NoValue, ZeroDivisionError, IndexError):
        return None


def cut(text: str) -> list[str | Fraction]:
    out: list[str | Fraction] = []
    at = 0
    while at < len(text):
        number = NUMBER.match(text, at)
        if number:
            out.append(literal(number[0]))
            at = number.end()
            continue
        symbol = SYMBOL.match(text, at)
        if not symbol:
            raise NoValue(text)
        out.append(symbol[0])
        at = symbol.end()
    return out


def literal(text: str) -> Fraction:
    if text.isdigit():
        if len(text) > 4300 or text[0] == "0" and text.strip("0"):  # no literal of the language
            raise NoValue(text)
        return bounded(Fraction(int(text)))
    number = float(text)
    if number in (float("inf"), float("-inf")):
        raise NoValue(text)
    return bounded(Fraction(repr(number)))


def bounded(x: Fraction) -> Fraction:
    if max(x.numerator.bit_length(), x.denominator.bit_length()) > MAX_BITS:
        raise NoValue("too large")
    return x


BINDS = {"+": 1, "-": 1, "*": 2, "/": 2}


def climb(tokens: list, at: int, least: int, depth: int) -> tuple[Fraction, int]:
    """The value of operators that bind at least so tightly, from tokens[at]; and where it ends."""
    if depth > MAX_DEPTH:
        raise NoValue("too deep")
    left, at = signed(tokens, at, depth)
    while at < len(tokens) and BINDS.get(tokens[at], 0) > least:
        op = tokens[at]
        right, at = climb(tokens, at + 1, BINDS[op], depth + 1)
        left = bounded(left + right if op == "+" else left - right if op == "-" else left * right if op == "*" else left / right)
    return left, at


def signed(tokens: list, at: int, depth: int) -> tuple[Fraction, int]:
    """Signs, then a power; a sign before a power applies to its result."""
    if depth > MAX_DEPTH:
        raise NoValue("too deep")
    if tokens[at] in ("+", "-"):
        inner, end = signed(tokens, at + 1, depth + 1)
        return (-inner if tokens[at] == "-" else inner), end
    base, at = atom(tokens, at, depth)
    if at < len(tokens) and tokens[at] == "**":
        power, at = signed(tokens, at + 1, depth + 1)
        if power.denominator != 1 or abs(power.numerator) > MAX_POWER:
            raise NoValue("exponent")
        base = bounded(base**power.numerator)
    return base, at


def atom(tokens: list, at: int, depth: int) -> tuple[Fraction, int]:
    if isinstance(tokens[at], Fraction):
        return tokens[at], at + 1
    if tokens[at] != "(":
        raise NoValue("operand")
    inner, at = climb(tokens, at + 1, 0, depth + 1)
    if at >= len(tokens) or tokens[at] != ")":
        raise NoValue("bracket")
    return inner, at + 1
