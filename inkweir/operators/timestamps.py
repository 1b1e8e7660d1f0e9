"""Normalising mixed timestamp strings to one unambiguous form.

Local clock readings are settled by an as-of join against zone-offset intervals: every interval of
constant offset of a zone is written in local time and exploded to the calendar years it touches, so
the join is an equi-join on (zone, year) followed by a containment test inside the small per-year
array. Two matching intervals mean an ambiguous (repeated) reading, a match in the gap behind an
interval means a nonexistent (skipped) one, one plain match gives the offset directly.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkweir.functions.dates import date_reading

#: Zones began in 1847; before, every zone has the mean time of its place. After LAST_YEAR a reading takes the
#: offset of the year in the last 28 that has the same calendar, as zone rules go by month and weekday.
FIRST_YEAR, LAST_YEAR = 1840, 2099
#: Seconds between two looks at a zone's offset; changes that are undone sooner would be missed, and no zone has such.
STEP = 4 * 86400
_NUMERIC_ORDER = r"(?<![\d./:-])(\d{1,2})([-/.])(\d{1,2})\2(?:\d{4}|\d{2})(?!\d)"


def _zone_intervals(name: str) -> list[tuple[int, int, int, str]]:
    """(utc_start, utc_end, offset, abbreviation) of each interval of constant offset of a zone."""
    zone, utc = ZoneInfo(name), timezone.utc

    def state(at: int) -> tuple[int, str]:
        t = datetime.fromtimestamp(at, zone)
        return int(t.utcoffset().total_seconds()), t.tzname()

    begin = int(datetime(FIRST_YEAR, 1, 1, tzinfo=utc).timestamp())
    end = int(datetime(LAST_YEAR + 1, 1, 1, tzinfo=utc).timestamp())
    out, start, now, at = [], begin, state(begin), begin
    while at < end:
        later = min(at + STEP, end)
        then = state(later)
        while then != now:
            low, high = at, later  # the first change behind `at` lies in (low, high]
            while high - low > 1:
                middle = (low + high) // 2
                low, high = (middle, high) if state(middle) == now else (low, middle)
            out.append((start, high, *now))
            start, at, now = high, high, state(high)
        at = later
    return [*out, (start, end, *now)]


def _same_calendar(year: int) -> int:
    """The year of LAST_YEAR - 27 to LAST_YEAR whose days fall on the same weekdays."""
    shape = lambda y: (date(y, 1, 1).weekday(), date(y, 12, 31).weekday())
    return next(y for y in range(LAST_YEAR - 27, LAST_YEAR + 1) if shape(y) == shape(year))


def _known_year(year: Column) -> tuple[Column, Column]:
    """(zone_year, days): the year whose zone rules hold, and how many days it is earlier. Calendars
    repeat every 400 years."""
    alike = F.element_at(F.array(*(F.lit(_same_calendar(2000 + k)) for k in range(400))), F.pmod(year, F.lit(400)) + 1)
    known = F.when(year > LAST_YEAR, alike).otherwise(F.greatest(year, F.lit(FIRST_YEAR)))
    start = lambda y: F.unix_date(F.make_date(y, F.lit(1), F.lit(1)))
    return known, F.when(year > LAST_YEAR, start(year) - start(known)).otherwise(0)


def zone_intervals(zones: DataFrame) -> DataFrame:
    """zones(zone) to one row per (zone, local year): ``spans``, an array of
    (local_start, local_end, gap_end, offset) sorted by time, ``abbreviations``, a map to the offset
    that an abbreviation had last by the end of that year, else the first it has later.

    Size bound: known zones (about 600) x years (260). Unknown and null zone names give no rows.
    """

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in batch["zone"]:
                try:
                    spans = _zone_intervals(name)
                except Exception:  # noqa: BLE001 - a name that is no zone
                    continue
                rows, starts = {}, [s for s, *_ in spans]
                for k, (start, end, off, _) in enumerate(spans):
                    local_start, local_end = start + off, end + off
                    gap_end = max(local_end, spans[k + 1][0] + spans[k + 1][2]) if k + 1 < len(spans) else local_end
                    if not k:  # in force ever before
                        local_start = -(1 << 60)
                    first, last = (max(FIRST_YEAR, min(LAST_YEAR, (datetime(1970, 1, 1) + timedelta(seconds=max(t, starts[0]))).year)) for t in (local_start, gap_end))
                    for year in range(first, last + 1):
                        rows.setdefault(year, []).append({"local_start": local_start, "local_end": local_end, "gap_end": gap_end, "offset": off})
                known: dict[str, int] = {}
                for _, _, off, abbr in spans:
                    known.setdefault(abbr, off)
                at, table = 0, []
                for year in sorted(rows):
                    limit = int(datetime(year + 1, 1, 1, tzinfo=timezone.utc).timestamp())
                    while at < len(spans) and starts[at] < limit:
                        known[spans[at][3]] = spans[at][2]
                        at += 1
                    table.append((name, year, rows[year], dict(known)))
                yield pd.DataFrame(table, columns=["zone", "zone_year", "spans", "abbreviations"])

    schema = "zone string, zone_year int, spans array<struct<local_start:bigint,local_end:bigint,gap_end:bigint,offset:int>>, abbreviations map<string,int>"
    return zones.where("zone is not null").select("zone").distinct().mapInPandas(build, schema)


def day_order(dated: DataFrame) -> DataFrame:
    """dated(site, raw) to (site, day_is_first): which of day and month comes first in a site's
    all-numeric dates, by the rows where only one reading is possible. Sites without such rows, or
    with a draw, are absent. Counts are combined before the shuffle, so a hot site costs one row a task."""
    a = F.regexp_extract("raw", _NUMERIC_ORDER, 1).try_cast("int")
    b = F.regexp_extract("raw", _NUMERIC_ORDER, 3).try_cast("int")
    vote = F.when(a.between(13, 31) & b.between(1, 12), 1).when(b.between(13, 31) & a.between(1, 12), -1)
    tally = dated.select("site", vote.alias("vote")).where("vote is not null").groupBy("site").agg(F.sum("vote").alias("vote"))
    return tally.where("vote <> 0").select("site", (F.col("vote") > 0).alias("day_is_first"))


def site_of(canonical_url: Column) -> Column:
    """Registered site (``name.tld``) of a canonical key ``tld,name[,sub])/path``; null if it has none."""
    return F.concat(
        F.nullif(F.regexp_extract(canonical_url, r"^([^,)/]+),([^,)/:]+)", 2), F.lit("")),
        F.lit("."),
        F.regexp_extract(canonical_url, r"^([^,)/]+),([^,)/:]+)", 1),
    )


def normalise_timestamps(dated: DataFrame, sites: DataFrame) -> DataFrame:
    """dated(rec_kind, rec_id, site, raw) and sites(source, time_zone) to one row per record whose
    string denotes a date: (rec_kind, rec_id, norm_date, status).

    norm_date: UTC ``YYYY-MM-DDTHH:MM:SSZ`` with a clock, else ``YYYY-MM-DD``, ``YYYY-MM`` or
    ``YYYY``, unshifted. status: given (offset written), direct, ambiguous (repeated reading; the
    offset in force before the change), nonexistent (skipped reading; likewise), unzoned (the site or
    its zone is unknown; read as UTC), day, month, year.

    Nulls, empty, relative and impossible strings give no row; a null site reads as unzoned. Where a
    site shows no order of day and month, American zones read month first, others day first. Repeated
    input rows give repeated output rows; an empty input gives no rows; other columns are ignored.
    """
    source = dated.select("rec_kind", "rec_id", "site", F.col("raw"))
    orders = day_order(source.select("site", "raw"))
    zones = sites.select(F.col("source").alias("site"), F.col("time_zone").alias("zone")).where("site is not null").groupBy("site").agg(F.min("zone").alias("zone"))
    read = source.where("raw rlike '[0-9]'").withColumn("r", date_reading("raw")).where("r.prec is not null").select("rec_kind", "rec_id", "site", "r.*")
    placed = read.join(zones, "site", "left").join(orders, "site", "left")
    day_is_first = F.coalesce("day_is_first", ~F.coalesce(F.col("zone").startswith("America/"), F.lit(False)))
    placed = placed.withColumn("day", F.when(day_is_first, F.col("day_first")).otherwise(F.col("month_first"))).where("prec in ('Y', 'M') or day is not null")
    local = F.col("day").cast("bigint") * 86400 + F.col("secs")
    zone_year, days = _known_year(F.year(F.date_from_unix_date("day")))
    placed = placed.withColumn("local", local).withColumn("zone_year", zone_year).withColumn("zone_local", F.col("local") - days.cast("bigint") * 86400)
    spans = zone_intervals(zones)
    joined = placed.join(spans, ["zone", "zone_year"], "left")
    hits = F.filter("spans", lambda s: (F.col("zone_local") >= s["local_start"]) & (F.col("zone_local") < s["gap_end"]))
    joined = joined.withColumn("hits", hits).withColumn("named", F.try_element_at("abbreviations", F.col("abbr")))
    first_hit = F.get("hits", F.lit(0))
    offset = F.coalesce("off", "named", first_hit["offset"], F.lit(0))
    status = (
        F.when(F.col("prec") == "Y", "year").when(F.col("prec") == "M", "month").when(F.col("prec") == "D", "day")
        .when(F.coalesce("off", "named").isNotNull(), "given")
        .when(F.size("hits") > 1, "ambiguous")
        .when(F.col("zone_local") >= first_hit["local_end"], "nonexistent")
        .when(first_hit.isNotNull(), "direct")
        .otherwise("unzoned")
    )
    value = (
        F.when(F.col("prec").isin("Y", "M"), F.col("txt"))
        .when(F.col("prec") == "D", F.date_format(F.date_from_unix_date("day"), "yyyy-MM-dd"))
        .otherwise(F.date_format(F.timestamp_seconds(F.col("local") - offset), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    )
    return joined.select("rec_kind", "rec_id", value.alias("norm_date"), status.alias("status"))


def dated_records(documents: DataFrame, refs: DataFrame) -> DataFrame:
    """(rec_kind, rec_id, site, raw) of documents and references. A document's site comes from its key."""
    return documents.select(F.lit("document").alias("rec_kind"), F.col("doc_id").alias("rec_id"), site_of(F.col("canonical_url")).alias("site"), F.col("date_raw").alias("raw")).unionByName(
        refs.select(F.lit("reference").alias("rec_kind"), F.col("ref_no").alias("rec_id"), F.col("source").alias("site"), F.col("date_raw").alias("raw"))
    )
