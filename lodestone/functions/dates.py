"""Dates of varying precision as intervals, and the publication gate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: evidence of publication in order of trust, and dates that only tell when a record was made
PUBLICATION_FIELDS = ("first_publication_date", "online_date", "published_date", "print_date")
RECORD_FIELDS = ("created_date", "indexed_date")
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
#: fixed values: reasons of the gate
REASONS = ("missing_real_publication_date", "real_publication_date_too_imprecise", "canonical_publication_date_before_window", "canonical_publication_date_beyond_future_grace", "accepted_canonical_publication_date")

_ANY = r"(?<!\d)((?:19|20)\d{2})(?:[-/](\d{1,2}))?(?:[-/](\d{1,2}))?"


def _parts(c: Column) -> tuple[Column, Column, Column, Column]:
    c = F.coalesce(c, F.lit(""))
    return (*(F.regexp_extract(c, _ANY, i) for i in (1, 2, 3)), F.regexp_extract(c, _ANY, 0))


def _date(*parts: Column) -> Column:
    return F.try_to_date(F.concat_ws("-", *parts), "yyyy-M-d")


def span(c: Column) -> Column:
    """The first date of a text, of year, month or day precision, as struct(raw, start, end, precision); null if there is none."""
    y, m, d, raw = _parts(c)
    one = F.lit("1")
    day, month, year = _date(y, m, d), _date(y, m, one), _date(y, one, one)
    told = lambda a, b, p: F.when(a.isNotNull(), F.struct(raw.alias("raw"), a.alias("start"), b.alias("end"), F.lit(p).alias("precision")))
    return F.when(y == "", None).when(m == "", told(year, F.add_months(year, 12) - F.expr("interval 1 day"), "year")).when(d == "", told(month, F.last_day(month), "month")).otherwise(told(day, day, "day"))


def iso_date(c: Column) -> Column:
    """The first date, missing parts as 1 (feeds and news only); null if it is no date."""
    y, m, d, _ = _parts(c)
    part = lambda x: F.when(x == "", "1").otherwise(x)
    return F.when(y != "", _date(y, part(m), part(d)))


def safe_date_string(c: Column) -> Column:
    return F.date_format(iso_date(c), "yyyy-MM-dd")


def from_parts(year: Column, month: Column, day: Column) -> Column:
    """Parts as yyyy, yyyy-MM or yyyy-MM-dd, as precise as they are; months by name too, unknown names as January; null if wrong."""
    y, d = F.try_to_number(year.cast("string"), F.lit("9999")).cast("int"), F.try_to_number(day.cast("string"), F.lit("99")).cast("int")
    text = F.trim(month.cast("string"))
    name = F.array_position(F.array(*(F.lit(m.lower()) for m in MONTHS)), F.lower(F.left(text, F.lit(3))))
    m = F.when(text.rlike("^[0-9]+$"), F.try_to_number(text, F.lit("99")).cast("int")).when(name > 0, name).otherwise(1)
    missing = lambda x: F.coalesce(F.trim(x.cast("string")) == "", F.lit(True))
    whole = lambda dd: F.try_to_date(F.format_string("%04d-%02d-%02d", y, m.cast("int"), dd), "yyyy-MM-dd")
    return F.when(y.isNull(), None).when(missing(month), F.format_string("%04d", y)).when(missing(day), F.date_format(whole(F.lit(1)), "yyyy-MM")).otherwise(F.date_format(whole(d), "yyyy-MM-dd"))


def feed_date(published: Column, updated: Column) -> Column:
    """yyyy-MM-dd of a feed entry: its publication, else its update; each as a mail date or any date in it."""
    out = F.lit(None).cast("string")
    for c in (published, updated):
        mail = F.regexp_extract(F.coalesce(c, F.lit("")), r"(\d{1,2}) ([A-Z][a-z]{2})[a-z]* (\d{4})", 0)
        month = F.lpad(F.array_position(F.array(*(F.lit(m) for m in MONTHS)), F.regexp_extract(mail, r" ([A-Z][a-z]{2})", 1)).cast("string"), 2, "0")
        by_mail = F.date_format(F.try_to_date(F.concat_ws("-", F.regexp_extract(mail, r"(\d{4})$", 1), month, F.lpad(F.regexp_extract(mail, r"^(\d+)", 1), 2, "0")), "yyyy-MM-dd"), "yyyy-MM-dd")
        out = F.coalesce(out, by_mail, safe_date_string(c))
    return out


def window(end: Column, days: int) -> Column:
    """The ``days`` calendar days that end there, both ends included."""
    return F.struct(F.date_sub(end, max(1, days) - 1).alias("start"), end.alias("end"))


def search_end(end: Column, future_days: int) -> Column:
    return F.date_add(end, max(0, future_days))


def spans_of(fields: dict[str, Column]) -> Column:
    """struct of the spans of several fields."""
    return F.struct(*(span(c).alias(name) for name, c in fields.items()))


def assess(fields: dict[str, Column], start: Column, end: Column, future_days: int = 0, month_precision: bool = True) -> Column:
    """struct(accepted, canonical_date, canonical_basis, status, reason) by the first usable publication date, in order
    of trust; dates of record keeping are not looked at, and further dates neither revive nor reject."""
    spans = spans_of({k: fields.get(k, F.lit(None).cast("string")) for k in PUBLICATION_FIELDS})

    def judged(s: Column) -> Column:
        known = [(k, s[k]) for k in PUBLICATION_FIELDS]
        usable = [(k, F.when((x["precision"] == "day") | F.lit(month_precision) & (x["precision"] == "month"), F.struct(F.lit(k).alias("basis"), x.alias("s")))) for k, x in known]
        first = F.coalesce(*(u for _, u in usable))
        at = first["s"]
        beyond, early = at["start"] > search_end(end, future_days), at["end"] < start
        none = F.coalesce(*(x["raw"] for _, x in known)).isNull()
        reason = F.when(none, REASONS[0]).when(first.isNull(), REASONS[1]).when(early, REASONS[2]).when(beyond, REASONS[3]).otherwise(REASONS[4])
        status = F.when(reason != REASONS[4], "rejected").when(at["start"] > end, "future_scheduled").when(at["precision"] == "month", "in_window_month_precision").otherwise("in_window")
        return F.struct((reason == REASONS[4]).alias("accepted"), at["raw"].alias("canonical_date"), first["basis"].alias("canonical_basis"), status.alias("status"), reason.alias("reason"))

    return F.transform(F.array(spans), judged)[0]


def news_in_window(title: Column, url: Column, published: Column, start: Column, end: Column) -> Column:
    """Titled and linked news that is undated or dated within the window."""
    d = iso_date(published)
    return (F.coalesce(F.trim(title), F.lit("")) != "") & (F.coalesce(F.trim(url), F.lit("")) != "") & (d.isNull() | d.between(start, end))


def days_old(published: Column, as_of: Column, unknown: int = 30) -> Column:
    """Days since a full date (0 for the future), ``unknown`` without one."""
    d = F.try_to_date(F.left(F.coalesce(published, F.lit("")), F.lit(10)), "yyyy-MM-dd")
    return F.when(d.isNull(), unknown).otherwise(F.greatest(F.lit(0), F.datediff(as_of, d)))


def published_date(fields: dict[str, Column]) -> Column:
    """The date that an overview shows: the first that is there, of availability, online, first publication, publication, print, year."""
    order = ("availability_date", "online_date", "first_publication_date", "published_date", "print_date", "year")
    return F.coalesce(*(F.when(F.trim(fields[k].cast("string")) != "", F.trim(fields[k].cast("string"))) for k in order if k in fields), F.lit(""))
