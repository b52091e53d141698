"""Column expressions for names, phones, ZIP codes and ids (all built-ins)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# States and territories whose ZIP codes start with 0.
ZERO_PREFIX_STATES = ["CT", "MA", "ME", "NH", "NJ", "PR", "RI", "VT", "VI"]


# Periods after initials, as the cleaned names must have them.
LONE_PERIOD = r"^([A-Za-z]?)\.$"
INNER_PERIOD = r"(.*\s[A-Z]?)(\.)(\s)"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def drop_chars(c: Column | str, chars: str) -> Column:
    """Delete every listed character, literally."""
    return F.translate(_c(c), chars, "")


def blank_to_null(c: Column | str, *tokens: str) -> Column:
    out = _c(c)
    for token in tokens or ("",):
        out = F.nullif(out, F.lit(token))
    return out


def drop_lone_initial_period(c: Column | str) -> Column:
    """``A.`` becomes ``A``; anything longer is left alone."""
    return F.regexp_replace(_c(c), LONE_PERIOD, "$1")


def drop_inner_initial_period(c: Column | str) -> Column:
    """``JOHN Q. PUBLIC`` becomes ``JOHN Q PUBLIC`` (the last such period)."""
    return F.regexp_replace(_c(c), INNER_PERIOD, "$1$3")


def collapse_spaces(c: Column | str) -> Column:
    return F.regexp_replace(_c(c), " +", " ")


def pad_zip(zip_code: Column | str, state: Column | str) -> Column:
    """Restore the leading zero a numeric reader lost."""
    z, s = _c(zip_code), _c(state)
    short = F.length(z).isin(4, 8) & s.isin(ZERO_PREFIX_STATES)
    return F.when(short, F.concat(F.lit("0"), z)).otherwise(z)


def registry_phone(c: Column | str) -> Column:
    """Digits of a registry phone: decimal tail, dashes, brackets, spaces off."""
    head = F.element_at(F.split(_c(c), r"\."), 1)
    return F.upper(drop_chars(head, "-() "))


def directory_phone(c: Column | str) -> Column:
    """A directory phone without its decimal tail; under 10 characters is blank."""
    head = F.element_at(F.split(_c(c), r"\."), 1)
    return F.when(F.length(head) >= 10, head)


def display_phone(c: Column | str) -> Column:
    c = _c(c)
    return F.concat(F.lit("("), F.substring(c, 1, 3), F.lit(") "),
                    F.substring(c, 4, 3), F.lit("-"), F.substring(c, 7, 1000))


def full_name(first: Column | str, middle: Column | str, last: Column | str) -> Column:
    """First, middle where there is one, last."""
    f, m, la = _c(first), _c(middle), _c(last)
    sp = F.lit(" ")
    return F.when(m == "", F.concat(f, sp, la)).otherwise(F.concat(f, sp, m, sp, la))


def group_location_id(group: Column | str, quarter: Column | str, state: Column | str,
                      zip_code: Column | str, phone: Column | str) -> Column:
    """``group-2015Q2-state-zip-phone``; null when any part is null."""
    q = _c(quarter)
    label = F.concat(F.year(q).cast("string"), F.lit("Q"), F.quarter(q).cast("string"))
    dash = F.lit("-")
    return F.concat(_c(group).cast("string"), dash, label, dash, _c(state), dash,
                    _c(zip_code), dash, _c(phone))


def credential_key(c: Column | str) -> Column:
    """A credential without periods or spaces, upper case."""
    return F.upper(drop_chars(c, ". "))
