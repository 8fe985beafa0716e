"""Lookups, search and paging."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.functions.labels import batch_label

# Page sizes.
FLIGHTS_PER_PAGE = 15
AIRPLANES_PER_PAGE = 5

FLIGHT_SEARCH_FIELDS = ["Carrier", "FlightDate", "Origin", "Dest", "TailNum", "FlightNum"]
FLIGHT_ORDER = ["FlightDate", "DepTime", "Carrier", "FlightNum"]
AIRPLANE_SEARCH_FIELDS = [
    "TailNum", "Owner", "OwnerState", "Manufacturer", "Model", "ManufacturerYear",
    "SerialNumber", "EngineManufacturer", "EngineModel",
]

# A page is cut from a slice of the order with about this many rows at most.
SLICE_ROWS = 10_000
# Bounds that divide a slice, and how many sampled keys they are chosen from.
SLICES, SAMPLE = 32, 2048


def _ordered(df: DataFrame, first: list[str]) -> list[Column]:
    """The wanted order made total by all other columns, nulls last."""
    names = [*first, *[c for c in df.columns if c not in first]]
    return [F.col(c).asc_nulls_last() for c in names]


def flight_lookup(flights: DataFrame, carrier: str, date: str, number: str) -> DataFrame:
    """The first flight with this carrier, date and number."""
    found = flights.filter(
        (F.col("Carrier") == carrier) & (F.col("FlightDate") == date) & (F.col("FlightNum") == number)
    )
    return found.orderBy(*_ordered(found, [])).limit(1)


def list_flights(flights: DataFrame, origin: str, dest: str, date: str) -> DataFrame:
    """Flights of a route on a day by departure and arrival, with their number."""
    found = flights.filter(
        (F.col("Origin") == origin) & (F.col("Dest") == dest) & (F.col("FlightDate") == date)
    )
    total = found.agg(F.count(F.lit(1))).scalar()
    return found.withColumn("flight_count", total).orderBy(*_ordered(flights, ["DepTime", "ArrTime"]))


def matching(df: DataFrame, args: Mapping[str, str | None], fields: list[str]) -> DataFrame:
    """Rows equal to every given argument, ignoring case; empty arguments do not filter.

    A value without letters (a date, a number) is compared as it is stored, so
    the condition reaches the file statistics.
    """
    for field in fields:
        wanted = args.get(field)
        if wanted:
            text = F.col(field).cast("string")
            caseless = wanted.lower() == wanted.upper()
            df = df.filter(text == wanted if caseless else F.lower(text) == wanted.lower())
    return df


def paged(df: DataFrame, order: list[str], start: int, size: int) -> tuple[DataFrame, int]:
    """(``size`` rows from ``start`` on in a total order, number of all rows).

    The part of the order that holds the page is narrowed down, one column after
    the other: sampled values divide it into slices, one aggregation counts the
    rows of each, and the slices around the page are divided again, until few rows
    are left to sort.  Rows with a sampled value are a slice of their own, which the
    next column divides; rows alike in all columns need no order, so however many
    they are, none is sorted.  The number of passes grows with the logarithm of the
    table, conditions are on single columns and reach the files' statistics, and no
    row is written or shuffled but those of the last slices, whatever the offset.
    """
    total = df.count()
    names = [*order, *[c for c in df.columns if c not in order]]
    wanted = max(0, min(size, total - start))
    pieces = _pieces(df, names, start, wanted, total) if wanted else []
    if len(pieces) == 1:
        return pieces[0], total
    together = reduce(DataFrame.union, pieces) if pieces else df.limit(0)
    return together.orderBy(*_ordered(df, order)).limit(wanted), total


def _pieces(rows: DataFrame, names: list[str], skip: int, take: int, left: int) -> list[DataFrame]:
    """``take`` of ``left`` rows from ``skip`` on in the order of ``names``, as frames that
    each sort a bounded number of rows."""
    if not names:
        return [rows.limit(take)]
    if left <= SLICE_ROWS:
        return [rows.orderBy(*[F.col(c).asc_nulls_last() for c in names]).offset(skip).limit(take)]
    lead = F.col(names[0])
    kind = rows.select(lead).schema[0].dataType
    # bounds only divide the work: any sample will do, and its size is fixed by the share
    known = rows.select(lead.alias("k")).filter("k is not null")
    sample = known.sample(min(1.0, SAMPLE / left), seed=left).distinct().orderBy("k").limit(2 * SAMPLE).collect() or known.limit(1).collect()
    values = [F.lit(r["k"]).cast(kind) for r in sample[:: max(1, len(sample) // SLICES)]]
    last = 2 * len(values) + 1  # the slice of nulls
    slot = F.when(lead.isNull(), F.lit(last)).otherwise(_slot(lead, values, 0, len(values)))
    counts = {r["slot"]: r["n"] for r in rows.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n")).collect()}
    found, before = [], 0
    for slot_no, n in sorted(counts.items()):
        inside, own = max(0, skip - before), min(before + n, skip + take) - max(before, skip)
        before += n
        if own <= 0:
            continue
        if slot_no % 2:
            alike = rows.filter(lead.isNull() if slot_no == last else lead == values[slot_no // 2])
            found += _pieces(alike, names[1:], inside, own, n)
            continue
        part = rows.filter(lead > values[slot_no // 2 - 1]) if slot_no else rows
        part = part.filter(lead < values[slot_no // 2]) if slot_no // 2 < len(values) else part
        found += _pieces(part.filter(lead.isNotNull()), names, inside, own, n)
    return found


def _slot(value: Column, bounds: list[Column], low: int, high: int) -> Column:
    """2n after n bounds, 2n - 1 at the n-th; halved at each step."""
    if low == high:
        return F.lit(2 * low)
    middle = (low + high) // 2
    left, right = _slot(value, bounds, low, middle), _slot(value, bounds, middle + 1, high)
    return F.when(value < bounds[middle], left).when(value > bounds[middle], right).otherwise(F.lit(2 * middle + 1))


def page(df: DataFrame, order: list[str], start: int, size: int) -> DataFrame:
    """``size`` rows from ``start`` on, in a total order."""
    return paged(df, order, start, size)[0]


def flight_search(flights: DataFrame, args: Mapping[str, str | None], start: int = 0) -> DataFrame:
    """One page of matching flights."""
    return page(matching(flights, args, FLIGHT_SEARCH_FIELDS), FLIGHT_ORDER, start, FLIGHTS_PER_PAGE)


def airplane_search(airplanes: DataFrame, args: Mapping[str, str | None], start: int = 0) -> DataFrame:
    """One page of matching airplanes, by owner."""
    return page(matching(airplanes, args, AIRPLANE_SEARCH_FIELDS), ["Owner"], start, AIRPLANES_PER_PAGE)


def search_total(matches: DataFrame, start: int, size: int) -> DataFrame:
    """Records on the page and matches in all; a page past the end reports 0 in all.

    Both numbers come from the count that the page needs anyway.
    """
    total = matches.count()
    records = max(0, min(size, total - start))
    return matches.sparkSession.createDataFrame([(records, total if records else 0)], "records bigint, total bigint")


def nav_offsets(pages: DataFrame, step: int) -> DataFrame:
    """Next and previous offsets for columns ``start``, ``end`` and ``total``."""
    down, up = F.col("start"), F.col("end")
    offsets = {
        "next_bottom": down + step,
        "next_top": up + step,
        "prev_bottom": F.greatest(down - step, F.lit(0)),
        "prev_top": F.greatest(up - step, F.lit(0)),
    }

    def shown(side: str) -> Column:
        bottom, top = F.col(f"{side}_bottom"), F.col(f"{side}_top")
        return (bottom >= 0) & (top > 0) & (F.col("total") > bottom)

    return pages.withColumns(offsets).withColumns(
        {"next_shown": shown("next"), "prev_shown": shown("prev")}
    )


def predictions_on_day(results: DataFrame, day: str) -> DataFrame:
    """Batch results of a day, compared as text; midnight text of the next day counts too."""
    next_day = F.date_add(F.lit(day).cast("date"), 1).cast("string")
    return results.filter(F.col("Timestamp").between(F.lit(day), next_day)).withColumn(
        "label", batch_label(F.col("Prediction"))
    )
