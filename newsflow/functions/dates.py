"""Date and time column functions.

All parsing is regex extraction plus ``try_make_timestamp_ntz``: invalid
calendar dates (31 February) and unparseable text give NULL instead of an
error (the reference sets the field to None in an ``except``).

The free-form parser (D3) stands in for a multilingual date library: it reads
absolute dates written as ``day month-word year [time]``, ``month-word day,
year [time]``, each with an optional weekday before it, 24-hour, ``10h`` and
AM/PM times, numeric day-first ``d/m/yyyy [H:M]`` and ISO
``yyyy-mm-dd[ H:M[:S[.f]]]`` (a zone designator is converted to UTC), with
Arabic-Indic digits and French, English and Arabic (incl. Maghreb) month
names. Relative dates give NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsflow.functions.text import WS_RE, collapse_ws, replace_char, strip_ws

# --- fixed values: month names -------------------------------------------------
MONTHS_FR = ["janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août",
             "septembre", "octobre", "novembre", "décembre"]
MONTHS_FR_SHORT = ["janv", "févr", "mars", "avr", "mai", "juin", "juil", "août",
                   "sept", "oct", "nov", "déc"]
MONTHS_EN = ["january", "february", "march", "april", "may", "june", "july", "august",
             "september", "october", "november", "december"]
MONTHS_EN_SHORT = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
MONTHS_AR = ["يناير", "فبراير", "مارس", "أبريل", "مايو", "يونيو", "يوليو", "أغسطس",
             "سبتمبر", "أكتوبر", "نوفمبر", "ديسمبر"]
MONTHS_AR_MAGHREB = ["جانفي", "فيفري", "مارس", "أفريل", "ماي", "جوان", "جويلية", "أوت",
                     "سبتمبر", "أكتوبر", "نوفمبر", "ديسمبر"]
WEEKDAYS_FR = ["lundi", "mardi", "mercredi", "jeudi", "vendredi", "samedi", "dimanche"]
WEEKDAYS_EN = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
WEEKDAYS_AR = ["الإثنين", "الثلاثاء", "الأربعاء", "الخميس", "الجمعة", "السبت", "الأحد"]
ARABIC_INDIC_DIGITS = "٠١٢٣٤٥٦٧٨٩"
EASTERN_ARABIC_DIGITS = "۰۱۲۳۴۵۶۷۸۹"
# -----------------------------------------------------------------------------


def _unaccented(w: str) -> str:
    return w.translate(str.maketrans("éèêëûôîàç", "eeeeuoiac"))


def month_table() -> dict[str, int]:
    """word -> month number, built from the lists above by rule."""
    out: dict[str, int] = {}
    for names in (MONTHS_FR, MONTHS_FR_SHORT, MONTHS_EN, MONTHS_EN_SHORT, MONTHS_AR, MONTHS_AR_MAGHREB):
        for i, w in enumerate(names, start=1):
            out.setdefault(w, i)
            out.setdefault(w.translate(str.maketrans("أإآ", "ااا")), i)     # as normalised texts are
            out.setdefault(_unaccented(w), i)
            out.setdefault(w + ".", i)
    out.setdefault("fév", 2)
    out.setdefault("fev", 2)
    return out


MONTHS = month_table()

_N = "([0-9]{1,2})"
_Y = "([0-9]{4})"
_TIME = ("(?:[^0-9]+([0-9]{1,2})(?:[:h]([0-9]{2})(?::([0-9]{2}))?|h|(?= ?[ap][.]?m))"
         "(?: ?[ap][.]?m[.]?)?)?")
PM, AM = "[0-9] ?p[.]?m[.]?$", "[0-9] ?a[.]?m[.]?$"
_DAY_NAMES = "|".join(WEEKDAYS_FR + WEEKDAYS_EN + [w.translate(str.maketrans("أإآ", "ااا")) for w in WEEKDAYS_AR])
WEEKDAY = f"^(?:يوم )?(?:{_DAY_NAMES})[,،.]? (?:le )?"
DAY_MONTH_YEAR = f"^{_N}(?:er)? ([^ 0-9,]+),? {_Y}{_TIME}$"
MONTH_DAY_YEAR = f"^([^ 0-9,]+) {_N}(?:st|nd|rd|th)?,? {_Y}{_TIME}$"
NUMERIC_DMY = f"^{_N}[/.-]{_N}[/.-]{_Y}{_TIME}$"
ISO_DATETIME = "^([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})(?:[tT ]([0-9]{1,2}):([0-9]{1,2})(?::([0-9]{1,2})(?:\\.([0-9]{1,6}))?)?)?$"
# ISO with a time and a zone designator (normalised text is lower case: 'z').
ZONE = "(z|[+-][0-9]{2}:?[0-9]{2})$"
ISO_DATETIME_ZONE = ("^([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})[tT ]([0-9]{1,2}):([0-9]{1,2})"
                     "(?::([0-9]{1,2})(?:\\.([0-9]{1,6}))?)?" + ZONE)
# strptime turns the format's space into "one or more whitespace".
STRICT_DMY_HM = "^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})" + WS_RE + "+([0-9]{1,2}):([0-9]{1,2})$"


def _int(c: Column) -> Column:
    return F.when(c != "", c.cast("int"))


def bind(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and pass it to ``body`` as a lambda
    variable. Conditional branches do not share common subexpressions, so
    without this the normalised text would be recomputed in every branch."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _n(nums: Column, i: int) -> Column:
    return F.try_element_at(nums, F.lit(i)).cast("int")


def _ts(y, mo, d, h=None, mi=None, s=None) -> Column:
    zero = F.lit(0)
    secs = F.lit(0).cast("decimal(8,6)")
    if s is not None:
        secs = F.coalesce(s.try_cast("decimal(8,6)"), secs)
    return F.try_make_timestamp_ntz(y, mo, d, F.coalesce(h, zero), F.coalesce(mi, zero), secs)


def _frac_seconds(sec: Column, frac: Column) -> Column:
    return F.when(sec.isNotNull(), F.concat(sec.cast("string"), F.lit("."), F.rpad(F.coalesce(frac, F.lit("")), 6, "0")))


def normalise(text: Column) -> Column:
    """Digits to ASCII, alif without hamza, whitespace collapsed, lower case,
    a leading weekday dropped."""
    t = F.translate(text, ARABIC_INDIC_DIGITS + EASTERN_ARABIC_DIGITS + "أإآ", "0123456789" * 2 + "ااا")
    return F.regexp_replace(F.lower(collapse_ws(t)), WEEKDAY, "")


def month_number(word: Column) -> Column:
    m = F.create_map(*[x for k, v in sorted(MONTHS.items()) for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(m, word)


def _numbers(x: Column) -> Column:
    return F.regexp_extract_all(x, F.lit("[0-9]+"), 0)


def parse_strict_dmy_hm(text: Column) -> Column:
    """D1 + T5 + D2: ``strptime(x.strip().replace('à', ' '), '%d/%m/%Y %H:%M')``."""
    def body(x):
        return F.when(x.rlike(STRICT_DMY_HM), bind(_numbers(x), lambda n: _ts(
            _n(n, 3), _n(n, 2), _n(n, 1), _n(n, 4), _n(n, 5))))
    return bind(replace_char(strip_ws(text), "à", " "), body)


ISO_HINT = "^([0-9]{4})-([0-9]{1,2})-([0-9]{1,2}) ([0-9]{1,2}):([0-9]{1,2}):([0-9]{1,2})\\.([0-9]{1,6})$"


def parse_iso(text: Column) -> Column:
    """The ISO hint ``%Y-%m-%d %H:%M:%S.%f`` (fraction of 1-6 digits)."""
    def body(x):
        return F.when(x.rlike(ISO_HINT), bind(_numbers(x), lambda n: _ts(
            _n(n, 1), _n(n, 2), _n(n, 3), _n(n, 4), _n(n, 5),
            _frac_seconds(_n(n, 6), F.try_element_at(n, F.lit(7))))))
    return bind(strip_ws(text), body)


def _hour(nums: Column, i: int, hour) -> Column:
    """The hour; without one midnight. A bad 12-hour clock hour gives 99, which
    makes no timestamp."""
    h = _n(nums, i)
    return F.when(h.isNotNull(), F.coalesce(hour(h), F.lit(99)))


def parse_free(text: Column) -> Column:
    """D3: multilingual absolute dates; NULL when nothing matches."""
    def body(x):
        def hour(h):
            h = h.cast("int")
            return (F.when(x.rlike(PM), F.when(h.between(1, 12), h % 12 + 12))
                     .when(x.rlike(AM), F.when(h.between(1, 12), h % 12)).otherwise(h))

        def fields(n):
            dmy = _ts(_n(n, 2), month_number(F.regexp_extract(x, DAY_MONTH_YEAR, 2)), _n(n, 1),
                      _hour(n, 3, hour), _n(n, 4), _n(n, 5))
            mdy = _ts(_n(n, 2), month_number(F.regexp_extract(x, MONTH_DAY_YEAR, 1)), _n(n, 1),
                      _hour(n, 3, hour), _n(n, 4), _n(n, 5))
            num = _ts(_n(n, 3), _n(n, 2), _n(n, 1), _hour(n, 4, hour), _n(n, 5), _n(n, 6))
            iso = _ts(_n(n, 1), _n(n, 2), _n(n, 3), _n(n, 4), _n(n, 5),
                      _frac_seconds(_n(n, 6), F.try_element_at(n, F.lit(7))))
            return (F.when(x.rlike(DAY_MONTH_YEAR), dmy)
                     .when(x.rlike(MONTH_DAY_YEAR), mdy)
                     .when(x.rlike(NUMERIC_DMY), num)
                     .when(x.rlike(ISO_DATETIME), iso))

        def zoned():
            # numbers of the local part, then shift by the offset to UTC
            local = bind(_numbers(F.regexp_replace(x, ZONE, "")), lambda n: _ts(
                _n(n, 1), _n(n, 2), _n(n, 3), _n(n, 4), _n(n, 5),
                _frac_seconds(_n(n, 6), F.try_element_at(n, F.lit(7)))))
            z = F.regexp_extract(x, ZONE, 1)
            digits = F.regexp_replace(z, "[^0-9]", "")
            minutes = F.when(z == "z", F.lit(0)).otherwise(
                (F.substring(digits, 1, 2).cast("int") * 60 + F.substring(digits, 3, 2).cast("int"))
                * F.when(F.substring(z, 1, 1) == "-", F.lit(-1)).otherwise(F.lit(1)))
            return F.timestamp_add("MINUTE", -minutes, local)

        return F.when(x.rlike(ISO_DATETIME_ZONE), zoned()).otherwise(bind(_numbers(x), fields))
    return bind(normalise(text), body)


def parse_iso_or_free(text: Column) -> Column:
    """The ISO hint first, then the free-form parser."""
    return F.coalesce(parse_iso(text), parse_free(text))


def parse_by_mode(text: Column, mode: Column) -> Column:
    """Per-site date mode from the site configuration."""
    return (F.when(mode == "strict_dmy", parse_strict_dmy_hm(text))
             .when(mode == "iso_or_free", parse_iso_or_free(text))
             .otherwise(parse_free(text)))


def render_ts(ts: Column) -> Column:
    """Python ``str(datetime)``: fraction only when microseconds are non-zero."""
    frac = F.date_format(ts, ".SSSSSS")
    return F.when(ts.isNotNull(), F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"),
                                           F.when(frac != ".000000", frac).otherwise(F.lit(""))))


def ingestion_ts(run_ts: str | None = None) -> Column:
    """Processing time, naive UTC; a fixed ``run_ts`` makes runs reproducible."""
    if run_ts is not None:
        return F.lit(run_ts).cast("timestamp_ntz")
    return F.current_timestamp().cast("timestamp_ntz")
