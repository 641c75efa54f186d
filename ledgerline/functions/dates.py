"""Date and time column functions (all JVM-side, no Python UDFs).

* ``parse_mixed_dates``  mixed-format, day-first parse, bad input -> null
* ``date_id``            ``yyyyMMdd`` integer key of a date
* ``date_parts``         calendar columns of the date dimension
* ``ntz``                a ``TIMESTAMP_NTZ`` literal
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Output formats of the pipelines' time stamps.
FORMAT_ISO_SECONDS = "yyyy-MM-dd HH:mm:ss"       # high-water marks, run log
FORMAT_SNAPSHOT = "yyyyMMdd_HHmmss"              # bronze object names
FORMAT_COMPACT = "yyyyMMdd HH:mm:ss"             # older staging mark
FORMAT_LOG = "yyyy-MMM-dd-HH:mm:ss"              # banks run log
FORMAT_DAY_KEY = "yyyyMMdd"                      # date keys, style 112

# Default mark when a table has never been loaded.
DEFAULT_MARK = "1900-01-01 00:00:00"

# Two-digit years below the pivot are 20xx, the others 19xx.
TWO_DIGIT_YEAR_PIVOT = 69


def ntz(value: str) -> Column:
    """A ``timestamp_ntz`` literal from ``yyyy-MM-dd[ HH:mm:ss]`` text."""
    return F.lit(value).cast("timestamp_ntz")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Words of date texts. Weekdays and the words between the parts say nothing new.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september",
          "october", "november", "december")
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
FILLERS = ("-", "/", ".", ",", ";", "'", "at", "on", "and", "ad", "m", "t", "of", "st", "nd", "rd", "th")
UTC_NAMES = ("z", "utc", "gmt")

_MONTH_NUMBERS = {**{m: i for i, m in enumerate(MONTHS, 1)}, **{m[:3]: i for i, m in enumerate(MONTHS, 1)}, "sept": 9}
_DROPPED = (*FILLERS, *WEEKDAYS, *(d[:3] for d in WEEKDAYS))


def _bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once. The lambda runs outside generated code."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def date_tokens(c) -> Column:
    """Runs of digits, runs of letters and single other characters of the text, lower-cased,
    without white space; "p.m." counts as "pm"."""
    s = F.lower(_col(c))
    s = F.when(s.contains("."), F.regexp_replace(s, r"(?<![a-z])([ap])\.\s?m\.?(?![a-z])", "$1m")).otherwise(s)
    return F.regexp_extract_all(s, F.lit(r"\d+|[a-z]+|[^\sa-z\d]"), F.lit(0))


def _clock(t: Column) -> Column:
    """The time of day among the tokens ``t``: the places of its first and last token (from 0;
    -1 and -2 without a time), hour, minute, second, fraction, minutes east of UTC, and
    whether it is one (a broken time of day makes the text unreadable)."""
    def at(i) -> Column:
        return F.get(t, i)

    def number(i) -> Column:
        return at(i).try_cast("int")

    def parts(p: Column) -> Column:
        colon, half = p["colon"], p["half"]
        sec = F.coalesce(at(colon + 2) == ":", F.lit(False))
        frac = sec & F.coalesce((at(colon + 4) == ".") & number(colon + 5).isNotNull(), F.lit(False))
        last = F.when(colon < 0, half).otherwise(colon + F.when(frac, 5).when(sec, 3).otherwise(1))
        return F.struct(
            F.when(colon < 0, F.greatest(half - 1, F.lit(-1))).otherwise(colon - 1).alias("first"),
            F.when((half > last) & (half == last + 1), half).otherwise(last).alias("last"),
            F.when(colon < 0, number(half - 1)).otherwise(number(colon - 1)).alias("h"),
            F.when(colon < 0, F.lit(0)).otherwise(number(colon + 1)).alias("mi"),
            F.when(sec, number(colon + 3)).otherwise(F.lit(0)).alias("s"),
            F.when(frac, F.rpad(F.substring(at(colon + 5), 1, 6), 6, "0").cast("int")).otherwise(F.lit(0)).alias("us"),
            at(half).alias("half"))

    def zoned(q: Column) -> Column:
        z = q["last"] + 1
        sign = F.when(at(z) == "+", 1).when(at(z) == "-", -1)
        digits = at(z + 1)
        split = F.coalesce((F.length(digits) == 2) & (at(z + 2) == ":"), F.lit(False))
        east = (F.when(split, number(z + 1) * 60 + number(z + 3))
                .when(F.length(digits) == 4, F.floor(number(z + 1) / 100) * 60 + number(z + 1) % 100)
                .when(F.length(digits) == 2, number(z + 1) * 60)).cast("int")
        named = at(z).isin(*UTC_NAMES)
        offset = sign * east
        h = (F.when(q["half"].isNull(), q["h"]).when(q["h"] > 12, F.lit(None))
             .otherwise(q["h"] % 12 + F.when(q["half"] == "pm", 12).otherwise(0)))
        return F.struct(
            q["first"].alias("first"),
            F.when(named, z).when(offset.isNotNull(), z + F.when(split, 3).otherwise(1)).otherwise(q["last"]).alias("last"),
            h.alias("h"), q["mi"].alias("mi"), q["s"].alias("s"), q["us"].alias("us"),
            F.coalesce(offset, F.lit(0)).alias("east"),
            F.coalesce(h.between(0, 23) & q["mi"].between(0, 59) & q["s"].between(0, 59), F.lit(False)).alias("valid"))

    none = F.struct(F.lit(-1).alias("first"), F.lit(-2).alias("last"), *[F.lit(0).alias(x) for x in ("h", "mi", "s", "us", "east")],
                    F.lit(True).alias("valid"))
    place = lambda x: F.array_position(t, x).cast("int") - 1
    half = F.greatest(place("am"), place("pm"))
    spots = F.struct(place(":").alias("colon"), half.alias("half"))
    return _bind(spots, lambda p: F.when((p["colon"] < 0) & (p["half"] < 0), none)
                 .otherwise(_bind(parts(p), zoned)))


def _assembled(kept: Column, clock: Column) -> Column:
    """The time stamp that the numbers and month names ``kept`` and the time of day mean."""
    def text(i: int) -> Column:
        return F.get(kept, F.lit(i))

    def number(i: int) -> Column:
        return text(i).try_cast("int")

    def size(i: int) -> Column:
        return F.length(text(i))

    months = F.create_map(*[x for k, v in _MONTH_NUMBERS.items() for x in (F.lit(k), F.lit(v))])
    n = F.size(kept)
    named = [F.try_element_at(months, text(i)) for i in range(3)]
    a, b, c = (number(i) for i in range(3))
    # a year: four digits, or more than any day
    year0, year1 = (size(0) == 4) | (a > 31), (size(1) == 4) | (b > 31)
    nothing = F.lit(None).cast("int")

    def ymd(y, m, d, hour=None, minute=None, second=None) -> Column:
        zero = F.lit(0)
        return F.struct(y.cast("int").alias("y"), m.cast("int").alias("m"), d.cast("int").alias("d"),
                        (zero if hour is None else hour.cast("int")).alias("h"),
                        (zero if minute is None else minute.cast("int")).alias("mi"),
                        (zero if second is None else second.cast("int")).alias("s"))

    one = F.lit(1)
    part = lambda i, first, length: F.substring(text(i), first, length)
    no_name = F.coalesce(*named).isNull()
    day_first = ymd(c, F.when(b <= 12, b).otherwise(a), F.when(b <= 12, a).otherwise(b))
    iso = ymd(a, F.when(b <= 12, b).otherwise(c), F.when(b <= 12, c).otherwise(b))
    iso_hour = ymd(a, F.when(b <= 12, b).otherwise(c), F.when(b <= 12, c).otherwise(b), number(3))
    short_year = ymd(a, F.when(c <= 12, c).otherwise(b), F.when(c <= 12, b).otherwise(c))
    no_month = part(0, 5, 2).try_cast("int") > 12
    packed = lambda *t: ymd(part(0, 1, 4), F.when(no_month, part(0, 7, 2)).otherwise(part(0, 5, 2)),
                            F.when(no_month, part(0, 5, 2)).otherwise(part(0, 7, 2)), *t)
    widths = size(0) <= 2
    date = (
        F.when((n == 3) & no_name,
               F.when(size(0) == 4, iso).when(widths & (a > 31), short_year)
               .when(widths & ((size(2) <= 2) | (size(2) == 4)), day_first))
        .when((n == 4) & no_name & (size(0) == 4) & (size(3) <= 2) & (clock["last"] < 0), iso_hour)
        .when((n == 3) & named[0].isNotNull(), F.when(year1, ymd(b, named[0], c)).otherwise(ymd(c, named[0], b)))
        .when((n == 3) & named[1].isNotNull(), F.when(year0, ymd(a, named[1], c)).otherwise(ymd(c, named[1], a)))
        .when((n == 3) & named[2].isNotNull(), F.when(year1, ymd(b, named[2], a)).otherwise(ymd(a, named[2], b)))
        .when((n == 2) & named[0].isNotNull(), ymd(F.when(size(1) == 4, b), named[0], one))
        .when((n == 2) & named[1].isNotNull(), ymd(F.when(size(0) == 4, a), named[1], one))
        .when((n == 2) & (size(0) == 8) & size(1).isin(4, 6) & (clock["last"] < 0),
              packed(part(1, 1, 2), part(1, 3, 2), F.when(size(1) == 6, part(1, 5, 2)).otherwise(F.lit("0"))))
        .when(n == 2, F.when(size(0) == 4, ymd(a, b, one)).when(size(1) == 4, ymd(b, a, one)))
        .when(n == 1, F.when(size(0) == 4, ymd(a, one, one)).when(size(0) == 8, packed())
              .when(size(0) == 6, ymd(part(0, 5, 2), part(0, 3, 2), part(0, 1, 2)))
              .when(size(0) == 12, packed(part(0, 9, 2), part(0, 11, 2)))
              .when(size(0) == 14, packed(part(0, 9, 2), part(0, 11, 2), part(0, 13, 2)))))

    def stamp(d: Column) -> Column:
        year = F.when(d["y"] < 100, d["y"] + F.when(d["y"] < TWO_DIGIT_YEAR_PIVOT, 2000).otherwise(1900)).otherwise(d["y"])
        seconds = (d["s"] + clock["s"]).cast("decimal(16,6)") + (clock["us"] / 1_000_000).cast("decimal(16,6)")
        made = F.try_make_timestamp_ntz(year, d["m"], d["d"], d["h"] + clock["h"], d["mi"] + clock["mi"],
                                        seconds.cast("decimal(16,6)"))
        return F.when(clock["valid"] & (d["s"] < 60) & d["y"].isNotNull(), F.timestamp_add("MINUTE", -clock["east"], made))

    return _bind(date, stamp)


def _from_tokens(t: Column) -> Column:
    def dated(clock: Column) -> Column:
        rest = F.when(clock["last"] < 0, t).otherwise(F.concat(
            F.slice(t, F.lit(1), F.greatest(clock["first"], F.lit(0))),
            F.slice(t, F.greatest(clock["last"] + 2, F.lit(1)), F.greatest(F.size(t) - clock["last"] - 1, F.lit(0)))))
        return _bind(F.filter(rest, lambda x: ~x.isin(*_DROPPED)), lambda kept: _assembled(kept, clock))
    return _bind(_clock(t), dated)


# Forms that Java's formatter reads exactly as the tokens are read, first and second
# order of day and month. A text of one of these forms needs no tokens, which cost many times more.
_DAY, _YEAR, _OF_DAY = r"\d{1,2}", r"[1-9]\d{3}", r"( \d{1,2}:\d{2}(:\d{2})?)?"
_SHORT = "(?i:" + "|".join(m[:3] for m in MONTHS) + ")"
_LONG = "(?i:" + "|".join(MONTHS) + ")"
_TIME = "[ H:mm[:ss]]"
_FORMS = (
    *((f"{_YEAR}{x}{_DAY}{x}{_DAY}{_OF_DAY}", f"yyyy{y}M{y}d{_TIME}", f"yyyy{y}d{y}M{_TIME}") for x, y in (("-", "-"), ("/", "/"))),
    *((f"{_DAY}{x}{_DAY}{x}{_YEAR}{_OF_DAY}", f"d{y}M{y}yyyy{_TIME}", f"M{y}d{y}yyyy{_TIME}")
      for x, y in (("-", "-"), ("/", "/"), (r"\.", "."))),
    (rf"{_YEAR}-{_DAY}-{_DAY}T{_DAY}:\d{{2}}(:\d{{2}})?Z?", "yyyy-M-d'T'H:mm[:ss]['Z']", "yyyy-d-M'T'H:mm[:ss]['Z']"),
    (rf"{_YEAR}-{_DAY}-{_DAY}T{_DAY}:\d{{2}}:\d{{2}}\.\d{{1,6}}Z?", "yyyy-M-d'T'H:mm:ss.SSSSSS['Z']", "yyyy-d-M'T'H:mm:ss.SSSSSS['Z']"),
    *((rf"{_YEAR}{x}{_DAY}{x}{_DAY} {_DAY}:\d{{2}}:\d{{2}}\.\d{{1,6}}", f"yyyy{x}M{x}d H:mm:ss.SSSSSS", f"yyyy{x}d{x}M H:mm:ss.SSSSSS")
      for x in "-/"),
    (rf"{_YEAR}\d{{4}}", "yyyyMMdd", "yyyyddMM"),
    (rf"{_YEAR}\d{{10}}", "yyyyMMddHHmmss", "yyyyddMMHHmmss"),
    (rf"{_YEAR}\d{{4}}T\d{{4}}", "yyyyMMdd'T'HHmm", "yyyyddMM'T'HHmm"),
    (rf"{_YEAR}\d{{4}}T\d{{6}}", "yyyyMMdd'T'HHmmss", "yyyyddMM'T'HHmmss"),
    *((f"{_DAY}{x}{rx}{x}{_YEAR}{_OF_DAY}", f"d{x}{m}{x}yyyy{_TIME}", None) for x in "- " for rx, m in ((_SHORT, "MMM"), (_LONG, "MMMM"))),
    *((rf"{_DAY}{x}{rx}{x}{_YEAR} (0?[1-9]|1[0-2]):\d{{2}} (?i:am|pm)", f"d{x}{m}{x}yyyy h:mm a", None)
      for x in "- " for rx, m in ((_SHORT, "MMM"), (_LONG, "MMMM"))),
    *((f"{_YEAR}{x}{rx}{x}{_DAY}{_OF_DAY}", f"yyyy{x}{m}{x}d{_TIME}", None) for x in "- " for rx, m in ((_SHORT, "MMM"), (_LONG, "MMMM"))),
    *((f"{rx} {_DAY},? {_YEAR}{_OF_DAY}", f"{m} d[,] yyyy{_TIME}", None) for rx, m in ((_SHORT, "MMM"), (_LONG, "MMMM"))),
    # the last one has an offset of its own
    (rf"{_YEAR}-{_DAY}-{_DAY}T{_DAY}:\d{{2}}:\d{{2}}[+-](0\d|1[0-7]):[0-5]\d", "yyyy-M-d'T'H:mm:ssxxx", "yyyy-d-M'T'H:mm:ssxxx"),
)
_WEEKDAY = "^(?i:" + "|".join((*WEEKDAYS, *(d[:3] for d in WEEKDAYS))) + "),? "
_SHORT_YEAR = r"^([012]?\d|3[01])[-/.]\d{1,2}[-/.]\d{2}\z"


def _plain(c: Column) -> Column:
    """The text without outer blanks and a leading weekday, a two-digit year widened."""
    def widened(s: Column) -> Column:
        last = F.right(s, F.lit(2))
        century = F.when(last < str(TWO_DIGIT_YEAR_PIVOT), F.lit("20")).otherwise(F.lit("19"))
        return F.when(s.rlike(_SHORT_YEAR), F.concat(F.substr(s, F.lit(1), F.length(s) - 2), century, last)).otherwise(s)

    s = F.trim(c)
    return _bind(F.when(s.rlike(_WEEKDAY), F.regexp_replace(s, _WEEKDAY, "")).otherwise(s), widened)


def _form(s: Column) -> Column:
    """The place (from 1) of the text's form in ``_FORMS``; null without one."""
    found = F
    for i, (rx, _, _) in enumerate(_FORMS, start=1):
        found = found.when(s.rlike(rf"^{rx}\z"), F.lit(i))
    return found


def _from_form(s: Column, form: Column) -> Column:
    """The time stamp of a text of a known form, by the form's pattern or its second one. Parsed
    as UTC and rebuilt from the instant, so that the session's time zone has no part in it."""
    own = form == len(_FORMS)
    text = F.when(own, s).otherwise(F.concat(s, F.lit(" +0000")))

    def parsed(patterns) -> Column:
        zoned = [None if p is None else p if i == len(_FORMS) else f"{p} Z" for i, p in enumerate(patterns, start=1)]
        t = F.try_to_timestamp(text, F.element_at(F.array(*[F.lit(p).cast("string") for p in zoned]), form))
        return F.timestamp_add("MICROSECOND", F.unix_micros(t), ntz("1970-01-01 00:00:00"))

    return F.coalesce(parsed([p for _, p, _ in _FORMS]), parsed([p for _, _, p in _FORMS]))


# Texts that only need their parts in another order to be an ISO time stamp, a month name
# written as a mark and its number. Two regular expressions and a cast cost far less than the patterns.
_NAMED = "\x01"
_MONTH, _CLOCK = r"(0?[1-9]|1[0-2])", r"\d{1,2}:\d{2}(?::\d{2})?"
_FINE_CLOCK = r"\d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?"
_ORDERS = (
    (rf"^(\d{{1,2}})([-/. ]){_NAMED}?{_MONTH}\2([1-9]\d{{3}})( {_CLOCK})?\z", "$4-$3-$1$5"),
    (rf"^([1-9]\d{{3}})([-/ ]){_NAMED}?{_MONTH}\2(\d{{1,2}})( {_FINE_CLOCK})?\z", "$1-$3-$4$5"),
    (rf"^([1-9]\d{{3}})-{_MONTH}-(\d{{1,2}})T({_FINE_CLOCK})Z?\z", "$1-$2-$3 $4"),
    (r"^([1-9]\d{3})(0[1-9]|1[0-2])(\d{2})\z", "$1-$2-$3"),
    (r"^([1-9]\d{3})(0[1-9]|1[0-2])(\d{2})T?(\d{2})(\d{2})(\d{2})\z", "$1-$2-$3 $4:$5:$6"),
    (r"^([1-9]\d{3})(0[1-9]|1[0-2])(\d{2})T(\d{2})(\d{2})\z", "$1-$2-$3 $4:$5"),
    (rf"^{_NAMED}{_MONTH} (\d{{1,2}}),? ([1-9]\d{{3}})( {_CLOCK})?\z", "$3-$1-$2$4"),
)
# the same, with an offset behind, or with half of the day
_ZONED = rf"^([1-9]\d{{3}})-{_MONTH}-(\d{{1,2}})T(\d{{1,2}}:\d{{2}}:\d{{2}})[+-](?:0\d|1[0-7]):[0-5]\d\z"
_HALVED = rf"^(\d{{1,2}})([- ]){_NAMED}{_MONTH}\2([1-9]\d{{3}}) ((?:0?[1-9]|1[0-2]):\d{{2}}) (?i:am|pm)\z"


def _from_zoned(t: Column) -> Column:
    east = F.substr(t, F.length(t) - 4, F.lit(2)).cast("int") * 60 + F.right(t, F.lit(2)).cast("int")
    back = F.when(F.substr(t, F.length(t) - 5, F.lit(1)) == "+", -east).otherwise(east)
    return F.timestamp_add("MINUTE", back, F.regexp_replace(t, _ZONED, "$1-$2-$3 $4").try_cast("timestamp_ntz"))


def _from_halved(t: Column) -> Column:
    def later(made: Column) -> Column:
        noon, after = F.hour(made) == 12, F.lower(F.right(t, F.lit(2))) == "pm"
        return F.timestamp_add("HOUR", F.when(after & ~noon, 12).when(noon & ~after, -12).otherwise(0), made)

    return _bind(F.regexp_replace(t, _HALVED, "$4-$3-$1 $5").try_cast("timestamp_ntz"), later)


def _in_order(s: Column, other: Column) -> Column:
    """The time stamp of a plain text ``s`` that only needs its parts in order; ``other`` for the rest."""
    months = F.create_map(*[x for k, v in _MONTH_NUMBERS.items() if k != "sept" for x in (F.lit(k), F.lit(f"{_NAMED}{v}"))])

    def numbered(name: Column) -> Column:
        return F.replace(s, name, F.coalesce(F.try_element_at(months, F.lower(name)), name))

    def ordered(t: Column) -> Column:
        found = F
        for rx, order in _ORDERS:
            found = found.when(t.rlike(rx), F.regexp_replace(t, rx, order).try_cast("timestamp_ntz"))
        return found.when(t.rlike(_ZONED), _from_zoned(t)).when(t.rlike(_HALVED), _from_halved(t)).otherwise(other)

    named = F.when(s.rlike("[A-Za-z]{3}"), _bind(F.regexp_extract(s, "[A-Za-z]{3,}", 0), numbered)).otherwise(s)
    return _bind(named, ordered)


def _read(c: Column) -> Column:
    """A text's date: by its parts' order or its form if it has one, else by its tokens."""
    def other(s: Column) -> Column:
        return _bind(_form(s), lambda form: F.when(
            form.isNotNull(), _from_form(s, form)).otherwise(_bind(date_tokens(c), _from_tokens)))
    return _bind(_plain(c), lambda s: _in_order(s, other(s)))


def parse_mixed_dates(c) -> Column:
    """Text holding a date in any of many forms, day first, as ``timestamp_ntz``; bad -> null.

    The text is cut into tokens (``date_tokens``): numbers, words, signs. The time of day is
    found by its colons or its am/pm; weekdays and filling words are dropped; what stays must be
    numbers and at most one month name, and their number, order and digits say which is which:
      * a year has four digits, or is larger than any day; two digits below the pivot are 20xx;
      * year first: year, month, day (year, day, month if the second number is no month);
      * else day, month, year (month first if the second number is no month);
      * beside a month name one number is the year, the other the day; no day: the first;
      * 8, 12 or 14 digits: year to day, minute or second; 6 digits: day, month, year; four: a year.
    A time with a zone ("Z", "UTC", "+05:30", "-0330") is given as the UTC wall-clock time; other
    zone names, broken times of day and anything else that is not understood give null.
    Fractions of a second are cut to microseconds. No session setting changes the result.

    A text that only needs its parts in order (``_ORDERS``) is put in order and cast, another text of
    a common form (``_FORMS``) by that form's pattern, with the same result.

    Departures from the batch loader's own parser, which reads year, day, month where a
    year-first text has an am/pm or 12 or 14 digits, and moves its century with the current
    year: here year-first text is always year, month, day, and the pivot is fixed.
    """
    return _bind(_col(c), _read)


def with_mixed_dates(df, src: str, out: str):
    """``df`` with ``out`` = ``src`` parsed as mixed-format day-first dates.

    The result comes out of an ``explode`` of one element, which later filters on ``out`` do
    not cross, so the parse is neither repeated nor inlined into conditions.
    """
    return df.select("*", F.explode(F.transform(F.array(_col(src)), _read)).alias(out))


def date_id(c) -> Column:
    """``yyyyMMdd`` as an integer (date dimension key)."""
    d = _col(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_parts(c) -> dict[str, Column]:
    """Calendar columns of a date: ISO week, Sunday = 1, weekend = {1, 7}."""
    d = _col(c)
    dow = F.dayofweek(d)
    return {
        "DateID": date_id(d),
        "FullDate": d,
        "Day": F.dayofmonth(d),
        "Month": F.month(d),
        "Year": F.year(d),
        "Quarter": F.quarter(d),
        "WeekOfYear": F.weekofyear(d),
        "DayOfWeek": dow,
        "IsWeekend": dow.isin(1, 7),
    }
