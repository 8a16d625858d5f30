"""How often the trajectory log is parsed."""

import contextlib
import io

from veritrail.plans import cases
from veritrail.sources import trajectories as log

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("extended")
    return out.getvalue().split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]


def test_second_append_does_not_parse_again(spark, monkeypatch):
    appended, append = [], log.append
    monkeypatch.setattr(log, "append", lambda rows, path: (appended.append(plan(rows)), append(rows, path)))
    assert cases.log_append(spark, SF).count() > 0
    assert len(appended) == 2 and not any("from_json" in p for p in appended)


def passes(text: str) -> int:
    """Parses of JSON in a plan; a line takes three: the row, its raw fields and the raw fields within."""
    return text.count("from_json")


def test_rows_parse_a_line_once(spark):
    assert passes(plan(cases.log_scan(spark, SF))) == 3


def test_counting_parses_a_line_once(spark):
    """Three for the log that isn't there, three for the one that is."""
    assert passes(plan(cases.log_missing(spark, SF))) == 6


def test_rejects_parse_a_line_once(spark):
    """Rejects of either kind come from one scan."""
    text = plan(cases.log_rejects(spark, SF))
    assert passes(text) == 3 and "Union" not in text
