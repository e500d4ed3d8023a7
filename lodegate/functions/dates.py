"""Publication dates: parsing, evidence priority and ages.

Every parser returns a UTC timestamp or null and takes the current time as an
argument instead of reading a clock.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from lodegate.functions.binding import let, matched
from lodegate.functions.text import finite_number, strip

# Trust in a date by where it was found, best first.
EVIDENCE_CONFIDENCE = {
    "json_ld": 0.99,
    "meta": 0.95,
    "time": 0.90,
    "source_specific": 0.88,
    "rss": 0.85,
    "visible": 0.70,
    "relative": 0.60,
}

# The same for dates found inside an article page.
ARTICLE_CONFIDENCE = {"json_ld": 0.95, "meta": 0.90, "time": 0.85, "relative": 0.75}

# RFC 2822 zone names and their offsets; other names mean UTC.
ZONE_OFFSETS = {
    "AST": "-04:00", "ADT": "-03:00", "EST": "-05:00", "EDT": "-04:00", "CST": "-06:00",
    "CDT": "-05:00", "MST": "-07:00", "MDT": "-06:00", "PST": "-08:00", "PDT": "-07:00",
}

_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
_FULL_MONTHS = (
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
)
_MONTH_NAME = "(?i:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec|" + "|".join(_FULL_MONTHS) + ")"
_FULL_MONTH = "(?i:" + "|".join(_FULL_MONTHS) + ")"
_OFFSET = r"[+-]\d{2}(?::?\d{2}(?::?\d{2}(?:\.\d+)?)?)?"
_ISO = (
    r"(?s)^(?:(\d{4})-(\d{2})-(\d{2})|(\d{4})(\d{2})(\d{2}))"
    rf"(?:.(\d{{2}})(?::?(\d{{2}})(?::?(\d{{2}})(?:[.,](\d+))?)?)?({_OFFSET})?)?$"
)
_ISO_WEEK = (
    r"(?s)^(\d{4})-?W(\d{2})(?:-?([1-7]))?"
    rf"(?:.(\d{{2}})(?::?(\d{{2}})(?::?(\d{{2}})(?:[.,](\d+))?)?)?({_OFFSET})?)?$"
)
_MAIL = (
    r"^(?:[A-Za-z]+\.?(?:,\s*|\s+))?(\d{1,2})(?:\s+|-)([A-Za-z]{3,9})(?:\s+|-)(\d{4}|\d{2}),?\s+"
    r"(\d{1,2}):(\d{2})(?::(\d{2}))?(?:\s*([+-]\d{4})|\s+([A-Za-z]+))?(?:\s+\(.*\))?$"
)

# Midnight of the first day of the year 1.
_YEAR_ONE_MICROS = -62_135_596_800_000_000


def _or(text: Column, default: str) -> Column:
    return F.when(text == "", F.lit(default)).otherwise(text)


def _two(text: Column) -> Column:
    return F.lpad(text, 2, "0")


def _offset(text: Column) -> Column:
    """+hh, +hhmm or +hh:mm:ss in the one form a timestamp cast accepts."""
    digits = F.rpad(F.regexp_replace(F.split(text, r"\.", 2)[0], r"[^0-9]", ""), 6, "0")
    part = lambda at: F.substring(digits, at, 2)
    return F.when(text == "", "+00:00").otherwise(
        F.concat(F.substring(text, 1, 1), part(1), F.lit(":"), part(3), F.lit(":"), part(5))
    )


def _assemble(date: Column, hour: Column, minute: Column, second: Column, micros: Column, offset: Column) -> Column:
    text = F.concat(
        date, F.lit(" "), _two(hour), F.lit(":"), _two(minute), F.lit(":"), _two(second),
        F.lit("."), micros, offset,
    )
    return text.try_cast("timestamp")


def _calendar(year: Column, month: Column, day: Column) -> Column:
    return F.concat(year, F.lit("-"), _two(month.cast("string")), F.lit("-"), _two(day))


def _month_number(name: Column) -> Column:
    position = F.instr(F.lit(_MONTHS), F.lower(F.substring(name, 1, 3)))
    return F.when((position > 0) & (position % 3 == 1), ((position + 2) / 3).cast("int"))


def _clock(group: Callable[[int], Column], first: int) -> tuple[Column, Column, Column, Column, Column]:
    hour, minute, second = (_or(group(first + i), "00") for i in range(3))
    micros = F.rpad(F.substring(group(first + 3), 1, 6), 6, "0")
    return hour, minute, second, micros, _offset(group(first + 4))


def iso_timestamp(text: Column) -> Column:
    """ISO 8601 calendar and week dates, basic or extended, any separator."""

    def calendar(g):
        date = _calendar(F.concat(g(1), g(4)), F.concat(g(2), g(5)), F.concat(g(3), g(6)))
        return _assemble(date, *_clock(g, 7))

    def weekly(g):
        year, week = g(1).try_cast("int"), g(2).try_cast("int")
        january4 = F.concat(g(1), F.lit("-01-04")).try_cast("date")
        monday = F.date_sub(january4, F.weekday(january4))
        date = F.date_add(monday, (week - 1) * 7 + _or(g(3), "1").try_cast("int") - 1)
        in_year = (week >= 1) & (F.extract(F.lit("YEAROFWEEK"), date) == year)
        return F.when(in_year, _assemble(date.cast("string"), *_clock(g, 4)))

    return F.coalesce(matched(text, _ISO, 11, calendar), matched(text, _ISO_WEEK, 8, weekly))


def mail_timestamp(text: Column) -> Column:
    """RFC 2822 dates; the weekday is ignored and an unknown zone means UTC."""
    zones = F.create_map(*[F.lit(x) for pair in ZONE_OFFSETS.items() for x in pair])

    def build(g):
        number = g(3).try_cast("int")
        year = F.when(F.length(g(3)) == 4, g(3)).otherwise(
            F.when(number < 69, number + 2000).otherwise(number + 1900).cast("string")
        )
        named = F.coalesce(F.try_element_at(zones, F.upper(g(8))), F.lit("+00:00"))
        offset = F.when(g(7) == "", named).otherwise(_offset(g(7)))
        return _assemble(
            _calendar(year, _month_number(g(2)), g(1)), g(4), g(5), _or(g(6), "00"), F.lit("000000"), offset
        )

    return matched(text, _MAIL, 8, build)


def _midnight(date: Column) -> Column:
    return F.concat(date, F.lit(" 00:00:00+00:00")).try_cast("timestamp")


def named_month_date(text: Column, names: str = _MONTH_NAME) -> Column:
    """'Sep 11, 2026' at midnight UTC."""
    pattern = rf"^({names})\s+(\d{{1,2}}),\s+(\d{{4}})$"
    return matched(text, pattern, 3, lambda g: _midnight(_calendar(g(3), _month_number(g(1)), g(2))))


def _month_day(text: Column, now: Column) -> Column:
    pattern = rf"^({_MONTH_NAME})\s+(\d{{1,2}})$"
    year = F.year(now).cast("string")
    return matched(text, pattern, 2, lambda g: _midnight(_calendar(year, _month_number(g(1)), g(2))))


def _ago(amount: Column, unit: Column, now: Column) -> Column:
    seconds = F.when(F.startswith(unit, F.lit("minute")), 60).when(F.startswith(unit, F.lit("hour")), 3600).otherwise(86400)
    span = F.try_multiply(F.try_multiply(amount.try_cast("long"), seconds.cast("long")), F.lit(1_000_000))
    micros = F.try_subtract(F.unix_micros(now), span)
    return F.timestamp_micros(F.when(micros >= _YEAR_ONE_MICROS, micros))


def relative_timestamp(text: Column, now: Column) -> Column:
    """The whole text is 'N minutes/hours/days ago' or 'yesterday'; null if that is before the year 1."""
    folded = F.lower(text)
    pattern = r"^(\d+)\s+(minute|minutes|hour|hours|day|days)\s+ago$"
    ago = matched(folded, pattern, 2, lambda g: _ago(g(1), g(2), now))
    yesterday = F.when(folded == "yesterday", F.timestamp_micros(F.unix_micros(now) - F.lit(86_400_000_000)))
    return F.coalesce(ago, yesterday)


def mentioned_relative_timestamp(text: Column, now: Column) -> Column:
    """The first 'N minutes/hours/days ago' anywhere in the text."""
    pattern = r"(?is)^.*?(\d+)\s+(minute|hour|day)s?\s+ago.*$"
    return matched(text, pattern, 2, lambda g: _ago(g(1), F.lower(g(2)), now))


def evidence_timestamp(raw: Column, now: Column) -> Column:
    """Date evidence in any accepted notation."""
    return let(
        strip(raw),
        lambda text: F.coalesce(
            iso_timestamp(F.replace(text, F.lit("Z"), F.lit("+00:00"))),
            mail_timestamp(text),
            relative_timestamp(text, now),
            named_month_date(text),
            _month_day(text, now),
        ),
    )


_LOOSE_ISO = r"^(\d{4})-(\d{1,2})-(\d{1,2})(?:(\s+|T)(\d{1,2}):(\d{1,2}):(\d{1,2})([+-]\d{2}:?\d{2})?)?$"
_SHORT_DAY = "(?i:mon|tue|wed|thu|fri|sat|sun)"
_SHORT_MONTH = "(?i:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)"
_STRICT_MAIL = (
    rf"^{_SHORT_DAY},\s+(\d{{1,2}})\s+({_SHORT_MONTH})\s+(\d{{4}})"
    r"\s+(\d{1,2}):(\d{1,2}):(\d{1,2})\s+([+-]\d{2}:?\d{2})$"
)
_DAY_FIRST = rf"^(\d{{1,2}})\s+({_SHORT_MONTH})\s+(\d{{4}})$"


def _loose_iso(g: Callable[[int], Column]) -> Column:
    """One-digit fields; a T needs an offset and a blank allows none."""
    allowed = (g(5) == "") | ((g(4) == "T") == (g(8) != ""))
    stamp = _assemble(
        _calendar(g(1), g(2), g(3)), _or(g(5), "00"), _or(g(6), "00"), _or(g(7), "00"), F.lit("000000"), _offset(g(8))
    )
    return F.when(allowed, stamp)


def page_timestamp(raw: Column) -> Column:
    """Date markup of an article page: ISO or one of a few written forms."""
    zulu = F.regexp_replace(strip(raw), "Z$", "+00:00")
    return let(
        zulu,
        lambda text: F.coalesce(
            iso_timestamp(text),
            matched(text, _LOOSE_ISO, 8, _loose_iso),
            matched(
                text, _STRICT_MAIL, 7,
                lambda g: _assemble(
                    _calendar(g(3), _month_number(g(2)), g(1)), g(4), g(5), g(6), F.lit("000000"), _offset(g(7))
                ),
            ),
            matched(text, _DAY_FIRST, 3, lambda g: _midnight(_calendar(g(3), _month_number(g(2)), g(1)))),
            named_month_date(text, _FULL_MONTH),
        ),
    )


def dated_text(raw: Column, source: str, confidence: float) -> Column:
    """A date string with the place it was found in."""
    return F.struct(raw.alias("raw"), F.lit(source).alias("source"), F.lit(confidence).alias("confidence"))


def no_evidence() -> Column:
    return F.struct(
        F.lit(None).cast("timestamp").alias("published_at"),
        F.lit(None).cast("string").alias("source"),
        F.lit(0.0).alias("confidence"),
    )


def first_evidence(candidates: Column, parse: Callable[[Column], Column]) -> Column:
    """Struct (published_at, source, confidence) of the first parseable dated text.

    Later texts are not parsed once one was understood.
    """

    def step(found, text):
        tried = F.struct(
            parse(text["raw"]).alias("published_at"), text["source"].alias("source"), text["confidence"].alias("confidence")
        )
        return F.when(found["published_at"].isNotNull(), found).otherwise(tried)

    return F.aggregate(
        candidates, no_evidence(), step, lambda found: F.when(found["published_at"].isNotNull(), found).otherwise(no_evidence())
    )


def date_evidence(now: Column, **raw: Column) -> Column:
    """Evidence of the most trusted parseable date.

    Keyword names are the keys of EVIDENCE_CONFIDENCE; missing ones are skipped.
    """
    unknown = set(raw) - set(EVIDENCE_CONFIDENCE)
    if unknown:
        raise ValueError(f"Unknown date evidence: {sorted(unknown)}")
    if len(raw) == 1:
        ((source, text),) = raw.items()
        trust = F.lit(EVIDENCE_CONFIDENCE[source]).alias("confidence")
        told = lambda at: F.struct(at.alias("published_at"), F.lit(source).alias("source"), trust)
        return let(evidence_timestamp(text, now), lambda at: F.when(at.isNotNull(), told(at)).otherwise(no_evidence()))
    texts = [dated_text(raw[source], source, trust) for source, trust in EVIDENCE_CONFIDENCE.items() if source in raw]
    return first_evidence(F.array(*texts), lambda text: evidence_timestamp(text, now))


def age_hours(published_at: Column, now: Column) -> Column:
    return (F.unix_micros(now) - F.unix_micros(published_at)) / F.lit(1_000_000.0) / F.lit(3600.0)


def retry_after_seconds(header: Column, now: Column) -> Column:
    """Seconds to wait from a Retry-After header: a number or an HTTP date."""
    def wait(text):
        until = (F.unix_micros(mail_timestamp(text)) - F.unix_micros(now)) / F.lit(1_000_000.0)
        return let(
            F.coalesce(finite_number(text), until), lambda s: F.when(s.isNotNull(), F.greatest(F.lit(0.0), s))
        )

    return let(strip(header), lambda text: F.when(text != "", wait(text)))


def utc_text(timestamp: Column) -> Column:
    """Stable text form used wherever a timestamp leaves the engine."""
    return F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
