"""Date expressions: months, quarters, elapsed dates and dates in file names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July",
               "August", "September", "October", "November", "December"]


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(c: Column | str) -> Column:
    return F.trunc(_c(c), "month")


def quarter_start(c: Column | str) -> Column:
    return F.trunc(_c(c), "quarter")


def quarter_label(c: Column | str) -> Column:
    q = _c(c)
    return F.concat(F.year(q).cast("string"), F.lit("Q"), F.quarter(q).cast("string"))


def month_number(name: Column | str) -> Column:
    """Number of a full or three-letter month name; null for anything else."""
    n = _c(name)
    out = F.lit(None).cast("int")
    for i, month in enumerate(MONTH_NAMES, start=1):
        out = F.when(n.isin(month, month[:3]), F.lit(i)).otherwise(out)
    return out


def elapsed_to_timestamp(c: Column | str, fmt: str) -> Column:
    """Decode an elapsed date: units counted from 1960, by format.

    tc milliseconds, td days, tw 52-week years, tm months, tq quarters,
    th half-years, ty calendar years.
    """
    n = _c(c).cast("long")
    fmt = fmt.lstrip("%")
    if fmt == "tc":
        return F.timestamp_millis(n + F.lit(-315619200000))
    if fmt == "td":
        return F.date_add(F.lit("1960-01-01").cast("date"), n.cast("int")).cast("timestamp")
    if fmt == "ty":
        return F.make_date(F.when(n > 0, n).cast("int"), F.lit(1), F.lit(1)).cast("timestamp")
    per_year = {"tw": 52, "tm": 12, "tq": 4, "th": 2}
    if fmt not in per_year:
        raise ValueError(f"elapsed date format {fmt!r} not understood")
    k = per_year[fmt]
    year = (F.lit(1960) + F.floor(n / F.lit(k))).cast("int")
    step = F.pmod(n, F.lit(k)).cast("int")
    if fmt == "tw":
        first = F.make_date(year, F.lit(1), F.lit(1))
        return F.date_add(first, step * 7).cast("timestamp")
    month = step * (12 // k) + 1
    return F.make_date(year, month.cast("int"), F.lit(1)).cast("timestamp")


def detect_date(path: Column | str) -> Column:
    """Snapshot date from a file name.

    One ISO date, else one month name with one year, else ``_m_`` with one
    year. A name holding two different candidates of a kind is not decided by
    that kind.
    """
    p = _c(path)

    def single(pattern: str, group: int = 0) -> Column:
        found = F.array_distinct(F.regexp_extract_all(p, F.lit(pattern), F.lit(group)))
        return F.when(F.size(found) == 1, found[0])

    # fixed values: the file-name patterns
    iso = F.try_to_date(single(r"20[0-9]{2}-[0-9]{2}-[0-9]{2}"), "yyyy-MM-dd")
    year = single(r"20[0-9]?[0-9]?").try_cast("int")
    hits = F.array_compact(F.array(*[
        F.when(p.contains(m[:3]), F.lit(i)) for i, m in enumerate(MONTH_NAMES, start=1)]))
    by_name = F.when(F.size(hits) == 1, F.try_element_at(hits, F.lit(1)))
    numbered = single(r"_([0-9]?[0-9]?)_", 1).try_cast("int")
    by_number = F.when(numbered.between(1, 12), numbered)
    month = F.coalesce(by_name, by_number)
    loose = F.when(year.isNotNull() & month.isNotNull(),
                   F.make_date(year, month, F.lit(1)))
    return F.coalesce(iso, loose)


def days_between(later: Column | str, earlier: Column | str) -> Column:
    return F.datediff(_c(later), _c(earlier))
