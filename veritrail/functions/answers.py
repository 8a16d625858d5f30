"""Final answers in completions: extraction, normal form and equivalence, as column expressions.

Native expressions do the work on the JVM. What they can't do exactly is decided by one Arrow UDF on the rows that are
left: exact fractions, and case folding of letters outside ASCII.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from veritrail.functions.rational import value_of

#: White space as Python strips it, and the patterns of answers, in Java's Unicode mode with "\n" line ends.
BLANK = r"[\s\x1c-\x1f\x85]"
FINAL_TAG = r"(?isdU)<final>\s*(.*?)\s*</final>"
FINAL_LINE = r"(?imdU)(?:final\s+answer|answer)\s*[:=]\s*(.+)$"
FENCE = r"(?isdU)```(?:python|py)?\s*\n(.*?)```"
LINE_ENDS = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"
BOX = "\\boxed{"
NUMERIC = r"[0-9eE+\-*/().]+"
MAX_ANSWER = 512
FRACTION = r"(?U)\\(?:d?frac)\s*\{([^{}]+)\}\s*\{([^{}]+)\}"


def strip(x: Column) -> Column:
    return F.regexp_replace(x, rf"(?U)^{BLANK}+|{BLANK}+\z", "")


def last_match(text: Column, pattern: str) -> Column:
    return F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.lit(-1))


def last_boxed(text: Column) -> Column:
    """Inside of the last box, null if there is none or it isn't closed.

    The rest after the box's opening is cut at its closing braces; the box ends with the first part up to which as many
    braces close as open.
    """
    rest = F.substring_index(text, BOX, -1)
    parts = F.split(rest, r"\}", -1)
    opens = F.transform(parts, lambda p: F.length(p) - F.length(F.replace(p, F.lit("{"), F.lit(""))))
    start = F.struct(F.lit(0).alias("i"), F.lit(0).alias("open"), F.lit(-1).alias("end"))

    def step(s: Column, n: Column) -> Column:
        open_ = s["open"] + n
        end = F.when((s["end"] < 0) & (open_ == s["i"]), s["i"]).otherwise(s["end"])
        return F.struct((s["i"] + 1).alias("i"), open_.alias("open"), end.alias("end"))

    at = F.aggregate(opens, start, step)["end"]
    inside = F.concat_ws("}", F.slice(parts, F.lit(1), at + 1))
    return F.when(text.contains(BOX) & (at >= 0) & (at < F.size(parts) - 1), inside)


def last_line(text: Column) -> Column:
    lines = F.filter(F.transform(F.split(text, LINE_ENDS), strip), lambda x: x != "")
    return F.coalesce(F.try_element_at(lines, F.lit(-1)), F.lit(""))


def extract_answer(text: Column) -> Column:
    """The last box, else the last final tag, else the last answer line, else the last line that isn't blank."""
    return F.coalesce(strip(last_boxed(text)), strip(last_match(text, FINAL_TAG)), strip(last_match(text, FINAL_LINE)), last_line(text))


def extract_code(text: Column) -> Column:
    """The last fenced block without a language or of Python, else all; stripped, and a new line."""
    return F.concat(strip(F.coalesce(last_match(text, FENCE), text)), F.lit("\n"))


def resolved(x: Column) -> Column:
    """Fractions written out from the innermost on, until nothing changes: as many rounds as there are fractions are enough."""
    count = F.regexp_count(x, F.lit(r"\\d?frac"))

    def step(state: Column, _: Column) -> Column:
        new = F.regexp_replace(state["text"], FRACTION, "(($1)/($2))")
        return F.when(state["done"], state).otherwise(F.struct(new.alias("text"), (new == state["text"]).alias("done")))

    start = F.struct(x.alias("text"), F.lit(False).alias("done"))
    return F.when(count > 0, F.aggregate(F.sequence(F.lit(1), count), start, step)["text"]).otherwise(x)


def opened(x: Column) -> Column:
    """Stripped, without dollars around it and without marks of formulas, which are looked for only behind a backslash; two rounds of fractions written out."""
    text = formula = F.regexp_replace(strip(x), r"^\$+|\$+\z", "")
    for mark in ("\\left", "\\right", "\\,", "\\!"):
        formula = F.replace(formula, F.lit(mark), F.lit(""))
    for _ in range(2):
        formula = F.regexp_replace(formula, FRACTION, "(($1)/($2))")
    return F.when(x.contains("\\"), formula).otherwise(text)


def closed(text: Column) -> Column:
    """Deeper fractions written out, signs made plain, white space and one mark at the end left out."""
    text = F.when(text.contains("\\") & text.rlike(FRACTION), resolved(text)).otherwise(text)
    text = F.replace(F.replace(text, F.lit("−"), F.lit("-")), F.lit("^"), F.lit("**"))
    return F.regexp_replace(F.regexp_replace(text, rf"(?U){BLANK}+", ""), r"[.,;:]\z", "")


PLAIN = r"^-?[0-9]+(?:[./][0-9]+)?\z"


def normalize_answer(x: Column) -> Column:
    """The normal form; plain numbers are in it already. with_normal() is the same for a whole column, and computes each step once."""
    return F.when(x.rlike(PLAIN), x).otherwise(closed(opened(x)))


def with_normal(rows: DataFrame, answer: str, out: str) -> DataFrame:
    """rows with the normal form of a column, its steps as columns, so that what is used twice is computed once."""
    step = f"_{out}_opened"
    opening = rows.withColumn(step, F.when(F.col(answer).rlike(PLAIN), F.col(answer)).otherwise(opened(F.col(answer))))
    return opening.withColumn(out, closed(F.col(step))).drop(step)


def same_value(a: str, b: str) -> bool:
    """Of normal forms: equal in folded case, or equal exact values."""
    if not a or len(a) > MAX_ANSWER:
        return False
    if a.casefold() == b.casefold():
        return True
    if not (re.fullmatch(NUMERIC, a) and re.fullmatch(NUMERIC, b)):
        return False
    x = value_of(a)
    return x is not None and x == value_of(b)


@F.pandas_udf(BooleanType())
def any_same_value(a: pd.Series, b: pd.Series) -> pd.Series:
    """a: normal form, or null where nothing is left to decide; b: arrays of normal forms."""
    return pd.Series([None if x is None else any(same_value(x, y) for y in ys if y is not None) for x, ys in zip(a, b, strict=True)], dtype=object)


def native_match(a: Column, truths: Column) -> Column:
    """True or false where plain comparison decides, else null.

    Plain integers and decimals of up to 12 and 4 digits, and quotients of such, are compared by cross-multiplication.
    """
    simple = r"^-?[0-9]{1,12}(?:\.[0-9]{1,4})?(?:/[0-9]{1,12}(?:\.[0-9]{1,4})?)?\z"
    plain = r"^-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:/(?:0|[1-9][0-9]*)(?:\.[0-9]+)?)?\z"
    part = lambda x, k: F.coalesce(F.try_to_number(F.get(F.split(x, "/"), F.lit(k)), F.lit("S999999999999.9999")), F.lit(1).cast("decimal(16,4)"))
    ok = lambda x: x.rlike(simple) & x.rlike(plain)

    def same(y: Column) -> Column:
        equal = F.lower(a) == F.lower(y)
        value = (part(a, 1) != 0) & (part(y, 1) != 0) & (part(a, 0) * part(y, 1) == part(y, 0) * part(a, 1))
        return F.when(equal, True).when(ok(a) & ok(y), value)

    ascii_only = a.rlike(r"^[\x00-\x7f]*\z")
    verdicts = F.transform(truths, same)
    return (
        F.when((F.length(a) == 0) | (F.length(a) > MAX_ANSWER) | (F.size(truths) == 0), False)
        .when(F.exists(verdicts, lambda v: v), True)
        .when(F.forall(verdicts, lambda v: v.isNotNull() & ~v), False)
        .when(ascii_only & ~a.rlike(rf"^{NUMERIC}\z") & F.forall(truths, lambda y: y.rlike(r"^[\x00-\x7f]*\z")), False)
    )


def with_match(rows: DataFrame, answer: str, truths: str, out: str) -> DataFrame:
    """rows with out: whether the column of extracted answers equals one of the accepted ones.

    Normal forms and the native verdict are columns of their own, so each is computed once a row.
    """
    a, ys, native = "_match_answer", "_match_truths", "_match_native"
    df = with_normal(rows, answer, a).withColumn(ys, F.transform(truths, normalize_answer))
    df = df.withColumn(native, native_match(F.col(a), F.col(ys)))
    left = any_same_value(F.when(F.col(native).isNull(), F.col(a)), F.col(ys))
    return df.withColumn(out, F.coalesce(native, left, F.lit(False))).drop(a, ys, native)
