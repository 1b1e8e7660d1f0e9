import datetime as dt
from zoneinfo import ZoneInfo

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from inkweir.functions.dates import read_date
from inkweir.operators.timestamps import _zone_intervals, normalise_timestamps

EPOCH = dt.date(1970, 1, 1).toordinal()


def day(text):
    return dt.date.fromisoformat(text).toordinal() - EPOCH


@pytest.mark.parametrize("raw", [None, "", " ", "soon", "2 days ago", "31 February 2012", "0000-00-00", "30/30/2009", "2011-13-45", "Invalid Date", "NaN/NaN/NaN", "{{date}}", "12345", "2014-01-01 25:00", "x" * 100_000])
def test_no_date(raw):
    prec, txt, first, second, *_ = read_date(raw)
    assert prec is None or (first is None and second is None)


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("2014-07-09", "2014-07-09"), ("  Published 09.07.2014.", "2014-07-09"), ("9 juillet 2014", "2014-07-09"), ("9. Juli 2014", "2014-07-09"), ("July 9th, 2014", "2014-07-09"), ("Jul. 9 2014", "2014-07-09"),
        ("9 de julio de 2014", "2014-07-09"), ("20140709", "2014-07-09"), ("Wed 9 Jul 2014", "2014-07-09"), ("9-Jul-2014", "2014-07-09"), ("2014/07/09", "2014-07-09"), ("2014 July 9", "2014-07-09"),
    ],
)
def test_days(raw, want):
    prec, _, first, _, secs, _, _ = read_date(raw)
    assert (prec, first, secs) == ("D", day(want), None)


@pytest.mark.parametrize(
    ("raw", "secs", "off", "abbr"),
    [
        ("2014-07-09T10:32:30.477", 37950, None, None), ("20140709T103230Z", 37950, 0, None), ("Wed, 09 Jul 2014 10:32:30 +0530", 37950, 19800, None), ("Jul 9, 2014 at 1:05 p.m.", 47100, None, None),
        ("9 juillet 2014 à 10h32", 37920, None, None), ("10:32 UTC, 9 July 2014", 37920, 0, None), ("Wed Jul  9 10:32:30 2014", 37950, None, None), ("July 9, 2014, 10:32 (GMT-5)", 37920, -18000, None),
        ("2014-07-09 10:32:30 BST", 37950, None, "BST"), ("9 July 2014 12:10 am", 600, None, None), ("1404901950", 37950, 0, None), ("1404901950477", 37950, 0, None), ("20140709103230", 37950, 0, None),
    ],
)
def test_clocks(raw, secs, off, abbr):
    prec, _, first, _, s, o, a = read_date(raw)
    assert (prec, first, s, o, a) == ("T", day("2014-07-09"), secs, off, abbr)


def test_order_of_day_and_month_stays_open():
    assert read_date("04/05/2012")[2:4] == (day("2012-05-04"), day("2012-04-05"))
    assert read_date("13/05/12")[2:4] == (day("2012-05-13"), None)


@settings(max_examples=200, deadline=None)
@given(st.dates(dt.date(1990, 1, 1), dt.date(2030, 1, 1)), st.sampled_from(["%Y-%m-%d", "%d %B %Y", "%B %d, %Y", "%Y.%m.%d", "%d-%b-%Y", "%A, %B %d, %Y"]))
def test_written_days_come_back(d, form):
    assert read_date(d.strftime(form))[2] == d.toordinal() - EPOCH


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_is_read_without_error(s):
    assert len(read_date(s)) == 7


def test_zone_intervals_match_the_zone():
    spans = _zone_intervals("Europe/Berlin")
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    for start, _, off, name in spans[::7]:
        t = dt.datetime.fromtimestamp(start, ZoneInfo("Europe/Berlin"))
        assert (t.utcoffset().total_seconds(), t.tzname()) == (off, name)


SITES = [("ny.example", "America/New_York"), ("de.example", "Europe/Berlin"), ("no.example", None), (None, "Europe/Paris")]


def rows(spark, dated):
    frame = spark.createDataFrame([("d", i, s, r, "x") for i, (s, r) in enumerate(dated)], "rec_kind string, rec_id bigint, site string, raw string, zone string")
    sites = spark.createDataFrame([(*x, 1) for x in SITES], "source string, time_zone string, day int")
    return {r["rec_id"]: (r["norm_date"], r["status"]) for r in normalise_timestamps(frame, sites).collect()}


def test_normalised(spark):
    got = rows(
        spark,
        [
            ("ny.example", "2012-11-04 01:30"), ("ny.example", "2012-03-11 02:30"), ("de.example", "2012-03-25 02:30"), ("de.example", "2012-10-28 02:30:15"), ("de.example", "2012-07-01 12:00"),
            ("no.example", "2012-07-01 12:00"), (None, "2012-07-01 12:00 CST"), ("ny.example", "2012-07-01 12:00 EST"), ("de.example", "13/05/2012"), ("de.example", "04/05/2012"), ("ny.example", "04/05/2012"),
            ("de.example", None), ("de.example", "soon"), ("de.example", "May 2012"), ("de.example", "2012"),
        ],
    )
    assert got == {
        0: ("2012-11-04T05:30:00Z", "ambiguous"), 1: ("2012-03-11T07:30:00Z", "nonexistent"), 2: ("2012-03-25T01:30:00Z", "nonexistent"), 3: ("2012-10-28T00:30:15Z", "ambiguous"), 4: ("2012-07-01T10:00:00Z", "direct"),
        5: ("2012-07-01T12:00:00Z", "unzoned"), 6: ("2012-07-01T12:00:00Z", "unzoned"), 7: ("2012-07-01T17:00:00Z", "given"), 8: ("2012-05-13", "day"), 9: ("2012-05-04", "day"), 10: ("2012-04-05", "day"),
        13: ("2012-05", "month"), 14: ("2012", "year"),
    }


def test_nothing_to_normalise(spark):
    assert rows(spark, []) == {}


def test_clocks_of_all_years(spark):
    rows = [("a.example", "1850-07-01 12:00"), ("a.example", "1890-07-01 12:00"), ("a.example", "2100-07-01 12:00"), ("a.example", "2105-01-15 12:00"), ("a.example", "2500-03-14 02:30"), ("a.example", "2040-07-01 12:00")]
    dated = spark.createDataFrame([("document", i, s, r) for i, (s, r) in enumerate(rows)], "rec_kind string, rec_id bigint, site string, raw string")
    sites = spark.createDataFrame([("a.example", "America/New_York")], "source string, time_zone string")
    from inkweir.operators.timestamps import normalise_timestamps

    got = {r["rec_id"]: (r["norm_date"], r["status"]) for r in normalise_timestamps(dated, sites).collect()}
    assert got[0] == ("1850-07-01T16:56:02Z", "direct") and got[1] == ("1890-07-01T17:00:00Z", "direct")
    assert got[2] == ("2100-07-01T16:00:00Z", "direct") and got[3] == ("2105-01-15T17:00:00Z", "direct") and got[5] == ("2040-07-01T16:00:00Z", "direct")
    assert got[4] == ("2500-03-14T07:30:00Z", "nonexistent")  # the second Sunday of March
