import datetime as dt

from pyspark.sql import functions as F

from strataload.functions import compare, dates, text


def test_text_cleansing(frame):
    df = frame("t string", (None,), ("",), ("  ",), (" a ",), ("\tb",))
    row = df.select(
        text.fold_null(F.col("t")), text.clean_text(F.col("t")), text.clean_flag(F.col("t")), text.has_key(F.col("t"))
    )
    assert [tuple(r) for r in row.collect()] == [
        ("N/A", "N/A", "Y", False),
        ("", "N/A", "Y", False),
        ("  ", "N/A", "Y", False),
        (" a ", "a", "A", True),
        ("\tb", "\tb", "\tB", True),  # only spaces are trimmed
    ]


def test_active_flag_tolerates_case_and_padding(frame):
    df = frame("f string", ("Y",), (" y ",), ("N",), (None,), ("",))
    assert [r[0] for r in df.select(text.is_set(F.col("f"))).collect()] == [True, True, False, False, False]


def test_location_keys(frame):
    df = frame("a string, b string, c string", ("US", None, "TX"), (None, None, None))
    parts = [F.col(c) for c in "abc"]
    rows = df.select(text.plain_concat_key("_", *parts), text.joined_key("_", *parts), text.joined_key("|", *parts))
    assert [tuple(r) for r in rows.collect()] == [
        ("US__TX", "US_N/A_TX", "US|N/A|TX"),
        ("__", "N/A_N/A_N/A", "N/A|N/A|N/A"),
    ]


def test_calendar_columns(frame):
    days = [dt.date(2024, 2, 29), dt.date(2024, 3, 2), dt.date(2024, 3, 3), dt.date(2024, 12, 30)]
    df = frame("d date", *[(d,) for d in days])
    assert [tuple(r) for r in df.select(*dates.calendar_columns(F.col("d"))).collect()] == [
        (20240229, days[0], 4, "Thursday", 2, "February", 1, 2024, 0),
        (20240302, days[1], 6, "Saturday", 3, "March", 1, 2024, 1),
        (20240303, days[2], 7, "Sunday", 3, "March", 1, 2024, 1),
        (20241230, days[3], 1, "Monday", 12, "December", 4, 2024, 0),
    ]


def test_row_comparison(frame):
    df = frame("a string, b string", ("x", "x"), ("x", None), (None, None), ("N/A", None))
    pair = [(F.col("b"), F.col("a"))]
    assert [r[0] for r in df.select(compare.any_distinct(pair)).collect()] == [False, True, False, True]
    stored_null = df.where("a is not null").select(compare.any_changed_folded(pair))
    assert [r[0] for r in stored_null.collect()] == [False, True, False]
