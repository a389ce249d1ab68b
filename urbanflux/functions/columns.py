"""Scalar expressions. Every function takes columns (or names) and returns a Column."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import contract as C


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- coercion -------------------------------------------------------------

def not_nan(c: Column | str) -> Column:
    """NaN becomes NULL; Spark orders NaN above every number."""
    c = col(c)
    return F.when(~F.isnan(c), c)


def lenient_double(c: Column | str) -> Column:
    return not_nan(col(c).try_cast("double"))


def lenient_int(c: Column | str) -> Column:
    """Integers may arrive as text or as floats; anything unreadable becomes NULL."""
    return lenient_double(c).try_cast("int")


def lenient_timestamp(c: Column | str) -> Column:
    return col(c).try_cast("timestamp_ntz")


# --- time -----------------------------------------------------------------

def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Elapsed minutes between two wall-clock times, independent of the session zone."""
    gap = col(end) - col(start)
    part = lambda unit: F.extract(F.lit(unit), gap).cast("double")
    seconds = part("DAY") * 86400.0 + part("HOUR") * 3600.0 + part("MINUTE") * 60.0 + part("SECOND")
    return seconds / 60.0


def floor_minutes(ts: Column | str, step: int = 60) -> Column:
    """Floor a wall-clock time to ``step`` minutes (a divisor of 60)."""
    if step <= 0 or 60 % step:
        raise ValueError(f"step must divide 60, got {step}")
    ts = col(ts)
    excess = F.make_dt_interval(
        F.lit(0), F.lit(0), F.minute(ts) % F.lit(step), F.extract(F.lit("SECOND"), ts)
    )
    return ts - excess


def weekday(ts: Column | str) -> Column:
    """Monday = 0."""
    return F.weekday(col(ts))


def weekend(day: Column | str) -> Column:
    return (col(day) >= 5).cast("int")


def calendar(ts: Column | str) -> dict[str, Column]:
    ts = col(ts)
    return {
        "hora": F.hour(ts),
        "dia_semana": weekday(ts),
        "dia_mes": F.dayofmonth(ts),
        "mes_num": F.month(ts),
        "es_finde": weekend(weekday(ts)),
    }


def time_band(hour: Column | str, style: str = "title") -> Column:
    """Label of the band that holds ``hour``; NULL outside 0-23."""
    label = {"title": 2, "plain": 3}[style]
    hour = col(hour)
    out = None
    for band in C.TIME_BANDS:
        inside = (hour >= band[0]) & (hour < band[1])
        out = F.when(inside, band[label]) if out is None else out.when(inside, band[label])
    return out


def cyclic(hour: Column | str) -> tuple[Column, Column]:
    angle = F.lit(2 * math.pi) * col(hour) / 24
    return F.sin(angle), F.cos(angle)


def weekday_name(day: Column | str, names: tuple[str, ...] = C.WEEKDAYS_EN) -> Column:
    return F.get(F.array(*[F.lit(n) for n in names]), col(day))


def weekday_number(name: Column | str, names: tuple[str, ...] = C.WEEKDAYS_EN) -> Column:
    return F.array_position(F.array(*[F.lit(n) for n in names]), col(name)).cast("int") - 1


def month_edge(text: Column | str, last: bool = False) -> Column:
    """``YYYY-MM`` as the first or last day of the month; a full date stays itself."""
    text = col(text)
    first = F.concat(text, F.lit("-01")).try_cast("date")
    whole = F.last_day(first) if last else first
    return F.when(F.length(text) == 7, whole).otherwise(text.try_cast("date"))


def arrival(hour: Column | str, day: Column | str, minutes: Column | str) -> dict[str, Column]:
    """Hour, weekday and cyclic hour after ``minutes`` more, wrapping at midnight."""
    shifted = col(hour).cast("double") + F.greatest(col(minutes).cast("double"), F.lit(0.0)) / 60.0
    extra_days = F.floor(shifted / 24).cast("int")
    hour_of_day = shifted - extra_days * 24.0
    day_of_week = (col(day) + extra_days) % 7
    sin, cos = cyclic(hour_of_day)
    return {
        "hora_float": hour_of_day,
        "hora": F.floor(hour_of_day).cast("int"),
        "dia_semana": day_of_week.cast("int"),
        "es_fin_semana": weekend(day_of_week),
        "hora_sen": sin,
        "hora_cos": cos,
    }


def plan_hour(text: Column | str, now: Column | str) -> Column:
    """Requested hour of a form: a number clamped to [0, 23.99], otherwise the clock."""
    now = col(now)
    clock = F.hour(now) + F.minute(now) / 60.0
    return F.greatest(F.lit(0.0), F.least(F.coalesce(col(text).try_cast("double"), clock), F.lit(23.99)))


# --- trip measures --------------------------------------------------------

def speed_mph(miles: Column | str, minutes: Column | str) -> Column:
    return F.try_divide(col(miles), col(minutes) / 60.0)


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b, NULL when b is zero."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def income_per_minute(price: Column | str = "precio_base", minutes: Column | str = "duracion_min") -> Column:
    return F.when(col(minutes) > 0, F.try_divide(col(price), col(minutes))).otherwise(0.0)


def dense_traffic(speed: Column | str = "velocidad_mph") -> Column:
    return F.coalesce((col(speed) < C.DENSE_TRAFFIC_MPH).cast("int"), F.lit(0))


def success(wait: Column | str = "espera_min") -> Column:
    return F.coalesce((col(wait) <= C.SUCCESS_WAIT).cast("int"), F.lit(0))


def rebuilt_total(base: Column | str, parts: Iterable[Column]) -> Column:
    """Base fare plus surcharges, a missing surcharge counting as zero."""
    total = col(base)
    surcharges = F.lit(0.0)
    for part in parts:
        surcharges = surcharges + F.coalesce(part.cast("double"), F.lit(0.0))
    return total + surcharges


# --- weather --------------------------------------------------------------

def weather_flag(amount: Column | str) -> Column:
    return F.coalesce((col(amount) > C.WEATHER_FLAG).cast("int"), F.lit(0))


def has_rain(rain: Column | str = "lluvia", precipitation: Column | str | None = None) -> Column:
    """Rain flag of training; scoring also looks at precipitation."""
    wet = F.coalesce(col(rain) > 0, F.lit(False))
    if precipitation is not None:
        wet = wet | F.coalesce(col(precipitation) > 0, F.lit(False))
    return wet.cast("int")


def season(month: Column | str) -> Column:
    month = col(month)
    out = None
    for name, months in C.SEASONS.items():
        hit = month.isin(*months)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(C.SEASON_OTHER)


def sky(precipitation: Column | str = "precipitation") -> Column:
    return F.when(col(precipitation) > 0, "Lluvia/Nieve").otherwise("Despejado")


# --- text -----------------------------------------------------------------

_ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüñçýÿ"
_PLAIN = "aaaaaaeeeeiiiiooooouuuuncyy"


def plain_text(c: Column | str) -> Column:
    """Trimmed, lower-case, without accents."""
    return F.translate(F.lower(F.trim(col(c))), _ACCENTED, _PLAIN)


def plain_band(c: Column | str) -> Column:
    return mapped(plain_text(c), C.BAND_ALIASES)


def contains_text(c: Column | str, needle: str | Column) -> Column:
    needle = F.lit(needle) if isinstance(needle, str) else needle
    return F.contains(plain_text(F.coalesce(col(c), F.lit(""))), plain_text(needle))


def mapped(c: Column | str, table: Mapping[str, str]) -> Column:
    """Look a value up in a literal map; unknown values stay as they are."""
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col(c)), col(c))


def vehicle_type(c: Column | str) -> Column:
    key = F.lower(F.trim(col(c).cast("string")))
    pairs = [F.lit(x) for pair in C.VEHICLE_SYNONYMS.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), col(c).cast("string"))


def any_keyword(c: Column | str, words: Iterable[str]) -> Column:
    """True when the text holds one of the words, ignoring case; NULL text is False."""
    text = F.lower(F.coalesce(col(c), F.lit("")))
    hit = F.lit(False)
    for word in words:
        hit = hit | F.contains(text, F.lit(word.lower()))
    return hit


def zone_class(
    words: Iterable[str], inside: str, outside: str,
    origin: str = "origen_zona", destination: str = "destino_zona",
) -> Column:
    words = tuple(words)
    return F.when(any_keyword(origin, words) | any_keyword(destination, words), inside).otherwise(outside)


def event_impact(kind: Column | str = "event_type", attendance: Column | str = "attendance") -> Column:
    people = F.coalesce(lenient_double(attendance), F.lit(0.0))
    return (
        F.when(
            (people >= C.EVENT_MASSIVE_ATTENDANCE) | any_keyword(kind, C.EVENT_MASSIVE_WORDS), "Masivo"
        )
        .when(
            ((people >= C.EVENT_MEDIUM_ATTENDANCE) & (people < C.EVENT_MASSIVE_ATTENDANCE))
            | any_keyword(kind, C.EVENT_MEDIUM_WORDS),
            "Medio",
        )
        .otherwise("Pequeño")
    )


def literal_rank(c: Column | str, table: Mapping[str, int]) -> Column:
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), col(c))


# --- hashing --------------------------------------------------------------

def hash32(*cols: Column | str) -> Column:
    """First 32 bits of md5 over the columns, the same number in any SQL engine."""
    text = F.concat_ws("|", *[F.coalesce(col(c).cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_percent(*cols: Column | str) -> Column:
    return hash32(*cols) % 100


# --- model targets --------------------------------------------------------

def log_target(c: Column | str) -> Column:
    return F.log1p(col(c).cast("double"))


def unlog_target(c: Column | str) -> Column:
    return F.greatest(F.expm1(col(c)), F.lit(0.0))


def with_columns(df, columns: Mapping[str, Column]):
    return df.withColumns(dict(columns))
