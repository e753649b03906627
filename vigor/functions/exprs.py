"""Scalar expressions (FN-*, PRJ-*): every function maps Columns to a Column.

They stay inside whole-stage codegen: no Python UDF anywhere.  Division by a
value that may be zero goes through ``try_divide`` (ANSI mode would raise),
``least``/``greatest`` are NULL-strict where the source warehouse was, and
every rounded floating result goes through :func:`round_half_up`.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_", "safe_cast", "strict_cast", "timestamp_text_to_date", "blank_to_default", "blank_to_null",
    "round_half_up", "split_part_num", "minutes_decimal", "parse_month_name_date", "excel_serial_date",
    "parse_game_date", "season_bucket", "DEFAULT_SEASON_BOUNDS", "home_away", "opponent",
    "date_parts", "day_number", "performance_score", "per_minute", "heart_rate_norm", "ordinal_level_norm",
    "recovery_score", "least_strict", "fatigue_index", "fatigue_band", "recovery_needed_hours",
    "residual_before_match", "acute_chronic_ratio", "intensity_reduction", "alert_flag", "position_from_height",
    "is_blank",
]


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- PRJ-2 / PRJ-3 / PRJ-4: casts -------------------------------------------------

def safe_cast(c, type_: str) -> Column:
    """NULL when the value does not convert (PRJ-2)."""
    return F.try_cast(col_(c), type_) if hasattr(F, "try_cast") else col_(c).try_cast(type_)


def strict_cast(c, type_: str) -> Column:
    """Raising cast under ANSI mode (PRJ-3)."""
    return col_(c).cast(type_)


def timestamp_text_to_date(c) -> Column:
    """``date(safe_cast(x as timestamp))`` (PRJ-4)."""
    return F.to_date(col_(c).try_cast("timestamp"))


# --- PRJ-5 / PRJ-7 / FLT-2: blanks -------------------------------------------------

def is_blank(c) -> Column:
    """NULL, empty or whitespace-only text."""
    return F.coalesce(F.trim(col_(c)), F.lit("")) == ""


def blank_to_default(c, default: str) -> Column:
    """``case when trim(x)='' or x is null then default else trim(x)`` (PRJ-5)."""
    return F.coalesce(F.nullif(F.trim(col_(c)), F.lit("")), F.lit(default))


def blank_to_null(c) -> Column:
    """``nullif(x, '')`` (PRJ-7)."""
    return F.nullif(col_(c), F.lit(""))


# --- rounding ---------------------------------------------------------------------

def round_half_up(c, scale: int = 2) -> Column:
    """Round a floating value half-up at ``scale`` decimals, via DECIMAL(20,8).

    A double that prints as ``x.xx5`` is often stored just below it, so a plain
    ``round(double)`` is engine-dependent on ties; going through an 8-digit
    decimal first makes the result depend on the value, not on its binary
    expansion or on the order a sum was accumulated in.
    """
    return F.round(col_(c).cast("decimal(20,8)"), scale).cast("double")


# --- FN-4 / FN-5: clock text -------------------------------------------------------

def split_part_num(c, delimiter: str, part: int) -> Column:
    """1-based ``split_part`` with a *literal* delimiter, safe-cast to double (FN-5)."""
    return F.split_part(col_(c), F.lit(delimiter), F.lit(part)).try_cast("double")


def minutes_decimal(c) -> Column:
    """``MM:SS`` / ``MM:SS:xx`` / plain number -> decimal minutes, else NULL (FN-4)."""
    c = col_(c)
    clock = round_half_up(split_part_num(c, ":", 1) + split_part_num(c, ":", 2) / F.lit(60.0), 2)
    return F.when(c.contains(":"), clock).otherwise(c.try_cast("double"))


# --- FN-1..FN-3: dates -------------------------------------------------------------

# French month abbreviations of the raw exports and their English
# equivalents, in calendar order.
MONTH_TOKENS = [
    ("janv.", "Jan"), ("févr.", "Feb"), ("mars", "Mar"), ("avr.", "Apr"),
    ("mai", "May"), ("juin", "Jun"), ("juil.", "Jul"), ("août", "Aug"),
    ("sept.", "Sep"), ("oct.", "Oct"), ("nov.", "Nov"), ("déc.", "Dec"),
]
EXCEL_EPOCH = "1899-12-30"


def parse_month_name_date(c) -> Column:
    """``'oct. 5, 2021'`` or ``'Jan 05, 2022'`` -> DATE; NULL when unparsable (FN-1)."""
    text = F.trim(col_(c))
    text = reduce(lambda acc, kv: F.replace(acc, F.lit(kv[0]), F.lit(kv[1])), MONTH_TOKENS, text)
    return F.try_to_date(text, "MMM d, yyyy")


def excel_serial_date(c) -> Column:
    """Spreadsheet serial day number (origin 1899-12-30) -> DATE (FN-2)."""
    return F.date_add(F.lit(EXCEL_EPOCH).cast("date"), col_(c).try_cast("int"))


def parse_game_date(c) -> Column:
    """First parser that succeeds: month-name text, then serial number (FN-3)."""
    return F.coalesce(parse_month_name_date(c), excel_serial_date(c))


# Season end dates (31 July) and labels; anything later -- and a
# NULL date -- falls into the last label.
DEFAULT_SEASON_BOUNDS = [
    ("2020-07-31", "2019-2020"),
    ("2021-07-31", "2020-2021"),
    ("2022-07-31", "2021-2022"),
    ("2023-07-31", "2022-2023"),
]
DEFAULT_LAST_SEASON = "2023-2024"


def season_bucket(d, bounds=None, last_label: str = DEFAULT_LAST_SEASON) -> Column:
    """Season label of a date with open ends on both sides (FN-8, T14)."""
    d = F.to_date(col_(d))
    bounds = bounds or DEFAULT_SEASON_BOUNDS
    expr = None
    for end, label in bounds:
        cond = d <= F.lit(_dt.date.fromisoformat(end))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(last_label)


def home_away(matchup, home: str = "Domicile", away: str = "Exterieur") -> Column:
    """``'A vs. B'`` -> home, ``'A @ B'`` -> away, else NULL (FN-7)."""
    m = col_(matchup)
    return F.when(m.contains("vs."), home).when(m.contains("@"), away)


def opponent(matchup) -> Column:
    """Text after ``vs.`` or ``@``, trimmed (FN-6); literal split, not regex."""
    m = col_(matchup)
    return (F.when(m.contains("vs."), F.trim(F.split_part(m, F.lit("vs."), F.lit(2))))
             .when(m.contains("@"), F.trim(F.split_part(m, F.lit("@"), F.lit(2)))))


def date_parts(d) -> dict[str, Column]:
    """year / month / day as BIGINT (FN-9)."""
    d = col_(d)
    return {"annee": F.year(d).cast("bigint"), "mois": F.month(d).cast("bigint"),
            "jour": F.dayofmonth(d).cast("bigint")}


def day_number(d) -> Column:
    """Days since 1970-01-01 (FN-10): the ordering key of day-range windows."""
    return F.unix_date(F.to_date(col_(d)))


# --- FN-11..FN-20: scores ----------------------------------------------------------

def performance_score(points, rebounds, assists, steals, blocks, turnovers, faults) -> Column:
    """p + r + a + s + b - t - f; NULL if any term is NULL (FN-11, T32)."""
    return (col_(points) + col_(rebounds) + col_(assists) + col_(steals) + col_(blocks)
            - col_(turnovers) - col_(faults))


def per_minute(score, minutes, scale: int = 2) -> Column:
    """``round(score / nullif(minutes, 0), 2)`` (FN-12)."""
    return round_half_up(F.try_divide(col_(score), F.nullif(col_(minutes), F.lit(0))), scale)


def heart_rate_norm(heart_rate, age) -> Column:
    """HR / (220 - age) (FN-13)."""
    return F.try_divide(col_(heart_rate), F.lit(220) - col_(age))


def ordinal_level_norm(level, levels=("Low", "Medium")) -> Column:
    """Low -> 1, Medium -> 2, anything else (NULL too) -> 3, divided by 3 (FN-14)."""
    lv = col_(level)
    expr = None
    for i, name in enumerate(levels, start=1):
        expr = F.when(lv == name, F.lit(i)) if expr is None else expr.when(lv == name, F.lit(i))
    return expr.otherwise(F.lit(len(levels) + 1)) / F.lit(float(len(levels) + 1))


def recovery_score(days_before, recovery_hours) -> Column:
    """round(days*24 / recovery_hours, 2), NULL on a zero divisor (FN-15)."""
    return round_half_up(F.try_divide(col_(days_before) * F.lit(24), col_(recovery_hours)), 2)


def least_strict(*cols) -> Column:
    """``least`` that is NULL when any argument is NULL (T4)."""
    cols = [col_(c) for c in cols]
    any_null = reduce(lambda a, b: a | b, [c.isNull() for c in cols])
    return F.when(~any_null, F.least(*cols))


# Weights of the fatigue index (internal 30 % = 60/40 heart
# rate/fatigue level, external 40 % = 70/30 intensity/weekly volume, recovery 30 %).
FI_WEIGHTS = {"internal": 0.30, "hr": 0.6, "fatigue": 0.4,
              "external": 0.40, "load": 0.7, "weekly": 0.3, "recovery": 0.30}


def fatigue_index(hr_norm, fatigue_norm, load_norm, weekly_norm, recovery, w=FI_WEIGHTS) -> Column:
    """Weighted composite index x 100 with recovery capped at 1 (FN-17)."""
    internal = F.lit(w["hr"]) * col_(hr_norm) + F.lit(w["fatigue"]) * col_(fatigue_norm)
    external = F.lit(w["load"]) * col_(load_norm) + F.lit(w["weekly"]) * col_(weekly_norm)
    rec = F.lit(1.0) - least_strict(F.lit(1.0), col_(recovery))
    return (F.lit(w["internal"]) * internal + F.lit(w["external"]) * external
            + F.lit(w["recovery"]) * rec) * F.lit(100.0)


# Fatigue bands (upper bounds, inclusive) and their labels.
FI_BANDS = [
    (30, "Fraîcheur optimale"),
    (50, "Fatigue légère"),
    (65, "Fatigue modérée"),
    (80, "Fatigue élevée / Risque"),
]
FI_TOP_BAND = "Danger blessure / baisse performance"


def fatigue_band(score, bands=FI_BANDS, top=FI_TOP_BAND) -> Column:
    """Banded label; NULL scores fall through to the top band like SQL CASE (FN-18)."""
    s = col_(score)
    expr = None
    for bound, label in bands:
        expr = F.when(s <= bound, label) if expr is None else expr.when(s <= bound, label)
    return expr.otherwise(top)


def recovery_needed_hours(recovery_hours, days_before) -> Column:
    """Extra hours of rest still needed before the match, >= 0, rounded to BIGINT (FN-19, T8)."""
    avail = col_(days_before) * F.lit(24)
    need = F.when(col_(recovery_hours) > avail, col_(recovery_hours) - avail).otherwise(F.lit(0))
    return F.round(need).cast("bigint")


def residual_before_match(fi_rounded, need_hours, days_before) -> Column:
    """round(least(100, fi * need / (days*24)), 2) with NULL-strict least (FN-20)."""
    ratio = F.try_divide(col_(fi_rounded) * col_(need_hours), col_(days_before) * F.lit(24))
    return round_half_up(least_strict(F.lit(100.0), ratio), 2)


def position_from_height(position, height, tall: float = 200.0) -> Column:
    """Keep a non-blank position, else infer it from height (PRJ-8)."""
    h = col_(height)
    inferred = F.when(h > tall, "Forward").when(h > 0, "Guard").otherwise("Inconnu")
    return F.coalesce(blank_to_null(position), inferred)


# --- FN-21..FN-23: ML post-processing ----------------------------------------------

def acute_chronic_ratio(acute, chronic, epsilon: float = 1e-9) -> Column:
    """acute / (chronic + epsilon) (FN-21)."""
    return F.try_divide(col_(acute), col_(chronic) + F.lit(epsilon))


# Probability thresholds and the training-intensity reduction (%)
# applied at or above each, highest first.
REDUCTION_BANDS = [(0.70, 80), (0.50, 50), (0.20, 15)]


def intensity_reduction(prob, bands=REDUCTION_BANDS) -> Column:
    """Probability -> reduction band 80/50/15/0 (FN-22)."""
    p = col_(prob)
    expr = None
    for t, r in bands:
        expr = F.when(p >= t, F.lit(r)) if expr is None else expr.when(p >= t, F.lit(r))
    return expr.otherwise(F.lit(0))


def alert_flag(prob, threshold: float = 0.20) -> Column:
    """(p >= threshold) as 0/1 (FN-23)."""
    return (col_(prob) >= F.lit(threshold)).cast("int")
