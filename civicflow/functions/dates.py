"""Lenient dates (NRM-2, NRM-3, NRM-4) as a token grammar in column expressions.

A spelling is cut into a day part and an optional time of day.  The day part's
tokens are numbers, English month names (whole or three letters) and words
without meaning; where the month name stands, which number can only be a year
and which one is above twelve decide what each number is:

* three numbers: year first if the first is long or above 31, day first if
  it is above 12, else month, day, year ("03.04.2020" is the 4th of March);
* a month name and two numbers: the long one is the year, else the day stands
  next to a leading or middle name ("4 Mar 20", "Mar 4 20");
* two numbers, or a name and one number: year and month, in either order;
* one number: ``yyyymmdd``, ``yymmdd`` or a year.

A missing day is the first, a missing month January.  Two-digit years lie in
``CENTURY .. CENTURY + 99``.  No year, an unknown word or an impossible date gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Month names, and words and weekdays that a date may hold without meaning.
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september",
          "october", "november", "december"]
SHORT = [m[:3] for m in MONTHS]
NAMES = sorted({*MONTHS, *SHORT, "sept"})
WORDS = ["at", "on", "and", "ad", "of", "st", "nd", "rd", "th", "t",
         "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday",
         "mon", "tue", "wed", "thu", "fri", "sat", "sun"]

#: First year of the hundred that two-digit years stand for.
CENTURY = 1975

#: A time of day at the end: hour, minute, second, fraction, half of the day, zone.
TIME = (r"(?:^|[t ,]+)(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,6})\d*)?)?\s*([ap])?(?:\.?m\.?)?"
        r"\s*(z|utc|gmt|[+-]\d{2}(?::?\d{2})?)?$")

#: A token that can only be a year, and one above twelve that can not.
_LONG = r"(\d{3,}|3[2-9]|[4-9]\d)"
_OVER = r"(1[3-9]|2\d|3[01])"
#: A line end that a spelling may have.
_LINE_END = r"(?:\r\n|[\n\r\u0085\u2028\u2029])\z"


def _word(*names: str) -> str:
    return rf"(?<![a-z])(?:{'|'.join(names)})(?![a-z])"


#: Steps from a spelling in lower case to ``year-month-day``.  Month names become M and a number, all other
#: tokens stay; what is no date matches none of the orders.  Every step uses the value before it once:
#: the flatteners' plans hold some hundred dates, so an expression has to be small.
_STEPS = [
    (_LINE_END, " "), (_word(*WORDS), " "),
    *[(_word(*[n for n in NAMES if n[:3] == short]), f" M{i} ") for i, short in enumerate(SHORT, 1)],
    (r"[ .,;/'-]+", " "), (r"^ | \z", ""),
    (rf"^{_LONG} M?(\d+) (\d+)\z", "$1-$2-$3"),
    (rf"^(?:{_OVER} |(\d+) M)(\d+) (\d+)\z", "$4-$3-$1$2"),
    (rf"^M(\d+) {_LONG} (\d+)\z", "$2-$1-$3"),
    (r"^M?(\d{1,2}) (\d+) (\d+)\z", "$3-$1-$2"),
    (rf"^(\d+) {_LONG} M(\d+)\z", "$2-$3-$1"),
    (r"^(\d+) (\d+) M(\d+)\z", "$1-$3-$2"),
    (rf"^{_LONG} M?(\d+)\z", "$1-$2-1"),
    (rf"^M?(\d+) {_LONG}\z", "$2-$1-1"),
    (r"^(\d{4})\z", "$1-1-1"),
    (r"^(\d{4}|\d{2})(\d{2})(\d{2})\z", "$1-$2-$3"),
    (rf"^({'|'.join(f'{y:02}' for y in range(CENTURY % 100, 100))})-", f"{CENTURY // 100}$1-"),
    (r"^(\d{2})-", f"{CENTURY // 100 + 1}$1-"), (r"^(\d)-", f"{CENTURY // 100 + 1}0$1-"),
]


def lenient_day(s: Column) -> Column:
    """The date of a spelling, NULL if it is none."""
    text = F.trim(F.regexp_replace(F.lower(F.trim(s)), TIME, ""))
    for pattern, becomes in _STEPS:
        text = F.regexp_replace(text, pattern, becomes)
    return F.regexp_extract(text, r"^\d{4}-\d{1,2}-\d{1,2}$", 0).try_cast(T.DateType())


def lenient_timestamp(s: Column) -> Column:
    """Date and time of day of a spelling; without a zone in the session's zone."""
    text = F.lower(F.trim(s))
    hour, half = F.regexp_extract(text, TIME, 1).try_cast(T.IntegerType()), F.regexp_extract(text, TIME, 5)
    hour = F.when(half == "", hour).when(hour.between(1, 12), F.pmod(hour, F.lit(12)) + F.when(half == "p", 12).otherwise(0))
    rest = F.regexp_extract(text, TIME, 0)
    for pattern, becomes in ((TIME, ":$2:$3.$4$6"), (r":\.", ":00."), (r"\.(?!\d)", ""),
                             ("(?:z|utc|gmt)$", "Z"), (r"([+-]\d{2})(\d{2})$", "$1:$2")):
        rest = F.regexp_replace(rest, pattern, becomes)
    clock = F.when(text.rlike(TIME), F.concat(F.lit(" "), hour.cast("string"), rest)).otherwise("")
    return F.concat(lenient_day(s).cast("string"), clock).try_cast(T.TimestampType())
