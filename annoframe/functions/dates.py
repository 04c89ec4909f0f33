"""Dates of documents from file names, issue texts and free forms, as ISO text with X for unknown digits.

Everything is a column expression.  Text that fits no rule gives null where the caller may look elsewhere, and
XXXX-XX-XX where it may not; a null column gives what an unknown text gives.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "XXXX-XX-XX"

# Beginnings of Estonian month names as patterns, long ones tried before short ones; English months;
# newspapers whose file names hold a whole date, with what may follow it; chat rooms of daily logs (a dot is any character);
# volumes of known years; prefixes of files without a date.
LONG_MONTHS = ("jaanuar", "veebruar", "m.rts", "aprill", "mai", "juuni", "juuli", "august", "september", "okto+ber", "november", "detsember")
SHORT_MONTHS = ("jaan", "veebr?", "m.rts", "apr(ill)?", "mai", "juuni", "juuli", "aug", "sept", "okt", "nov", "dets")
ENGLISH_MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
DATED_PAPERS = {"EPL": "", "sloleht": "", "pm": "(?:Extra|e|a)?", "le": "", "kr": "", "vm": ""}
CHAT_ROOMS = ("AdiChat", "ALsPlace.", "armastusesaal", "armutuba", "blue", "C4U.", "c4u", "creative", "delfi", "elutuba", "hinnavaatlus", "karmtuba", "kuressaare", "kpk", "kreisiraadio", "metal", "nak", "noortekas", "paevateema", "ringfm", "rullnokad", "seks", "toru")
VOLUME_YEARS = {"tea_EMS_1997.": "1997", "tea_EMS_2001.": "2001", "tea_ESA_49.": "2003", "tea_ESA_50.": "2004", "tea_draama.": "1992", "tea_draama2.": "1994"}
ISSUE_DATES = {"aja_ee_2001_48.": "2001-11-29"}
DATELESS = ("tea_", "ilu_", "sea_")


def _chain(cases: list[tuple[Column, Column]]) -> Column:
    """The value of the first case that holds."""
    out = F.when(*cases[0])
    for case in cases[1:]:
        out = out.when(*case)
    return out


def _two(digits: Column) -> Column:
    return F.lpad(digits.try_cast("int").cast("string"), 2, "0")


def _part(text: Column, pattern: str, *forms) -> Column:
    """Pieces joined: strings as they are, numbers as groups, functions of nothing as columns; null without a match."""
    pieces = [F.regexp_extract(text, pattern, f) if isinstance(f, int) else F.lit(f) if isinstance(f, str) else f for f in forms]
    return F.when(text.rlike(pattern), F.concat(*pieces))


def month_number(name: Column, strict: bool = False) -> Column:
    """01 to 12 of a lower-case month name; null, or an error if strict, where it is none."""
    found = _chain([(name.rlike(f"^(?:{p})"), F.lit(f"{k:02d}")) for names in (LONG_MONTHS, SHORT_MONTHS) for k, p in enumerate(names, 1)])
    if not strict:
        return found
    return F.when(name.isNotNull(), F.coalesce(found, F.raise_error(F.concat(F.lit("unknown month: "), name)).cast("string")))


def english_month(name: Column) -> Column:
    place = F.array_position(F.array(*map(F.lit, ENGLISH_MONTHS)), F.initcap(name))
    return F.when(place > 0, _two(place.cast("string")))


def dated_file(file: Column, flags: str = "") -> Column:
    """Date in a daily paper's file name."""
    def of(paper: str, tail: str) -> Column:
        p = rf"{flags}^.*aja_{paper}_(\d{{4}})_(\d+)_(\d+){tail}\."
        return _part(file, p, 1, "-", _two(F.regexp_extract(file, p, 2)), "-", _two(F.regexp_extract(file, p, 3)))

    return F.coalesce(*[of(*x) for x in DATED_PAPERS.items()])


def issue_date(issue: Column, year: Column) -> Column:
    """Day or month in an issue's title, if its year is the file's."""
    tidy = F.regexp_replace(issue, r", (\d+)\.? ?(?=[a-z])", ", $1. ")
    day, month = r"[,;] (\d+)\. (\S+) (\d{4})", r"[,;] (\S+) (\d{4})"
    whole = _part(tidy, day, 3, "-", month_number(F.lower(F.regexp_extract(tidy, day, 2))), "-", _two(F.regexp_extract(tidy, day, 1)))
    part = _part(tidy, month, 2, "-", month_number(F.lower(F.regexp_extract(tidy, month, 1))), "-XX")
    found = F.when(tidy.rlike(day), whole).otherwise(part)
    return F.when(F.substring(found, 1, 4) == year, found)


def _periodicals(file: Column, magazine_issue: Column, weekly_issue: Column, flags: str) -> Column:
    magazine, weekly = rf"{flags}^.*aja_luup_(\d{{4}})_(\d+)\.", rf"{flags}^.*aja_ml_(\d{{4}})_(\d+)\."
    day = r"Maaleht (\d+)\.(\d+)\.(\d{4})"
    of_weekly = _part(weekly_issue, day, 3, "-", _two(F.regexp_extract(weekly_issue, day, 2)), "-", _two(F.regexp_extract(weekly_issue, day, 1)))
    same_year = F.regexp_extract(weekly_issue, day, 3) == F.regexp_extract(file, weekly, 1)
    return F.coalesce(dated_file(file, flags), F.when(file.rlike(magazine), issue_date(magazine_issue, F.regexp_extract(file, magazine, 1))), F.when(file.rlike(weekly) & same_year, of_weekly))


def creation_time(src: Column, file: Column, issue: Column, timestamp: Column) -> Column:
    """Creation time by the collection's name: papers by file name or issue, feeds by their time stamp."""
    year_only, stamp = r"(?i)^.*aja_ee_(\d{4})_(\d+)\.", r"^(\d{4})-(\d+)-(\d+)"
    paper = F.coalesce(_periodicals(file, issue, issue, "(?i)"), _part(file, year_only, 1, "-XX-XX"))
    feed = _part(timestamp, stamp, 1, "-", _two(F.regexp_extract(timestamp, stamp, 2)), "-", _two(F.regexp_extract(timestamp, stamp, 3)))
    by_src = F.when(src.startswith("Balanced Corpus") | src.startswith("Reference Corpus"), paper).when(src.startswith("Timestamped"), feed)
    return F.coalesce(by_src, F.lit(UNKNOWN))


def creation_time_mixed(file: Column, subcorpus: Column, magazine_issue: Column, weekly_issue: Column, title: Column) -> Column:
    """Creation time of a mixed collection by file name, in the order of its rules; null where undecided."""
    chat = rf"^.*(?:{'|'.join(CHAT_ROOMS)})(\d\d)(\d\d)(\d\d)\."
    chat_year = F.regexp_extract(file, chat, 3)
    chats = F.when(subcorpus == "jututoavestlus", _part(file, chat, _century(chat_year), "-", 2, "-", 1))
    parliament = r"^.*rkogu_(\d{4})_(\d+)\."
    doctors, doctors_title = r"^.*tea_eesti_arst_(\d{4})\.", r"^Nr (\d+) (\S+) (\d{4})"
    doctors_month = F.coalesce(F.when(title.rlike(doctors_title), month_number(F.lower(F.regexp_extract(title, doctors_title, 2)))), F.lit("XX"))
    society = r"^.*tea_AA_(\d\d)_(\d+)\."
    century = F.when(F.regexp_extract(file, society, 1).try_cast("int") >= 90, "19").otherwise("20")
    number = F.regexp_extract(file, society, 2).try_cast("int")
    society_month = F.when(number.between(1, 6), _two((number * 2).cast("string"))).otherwise("XX")  # six issues a year
    rules = [
        _periodicals(file, magazine_issue, weekly_issue, ""),
        chats,
        *[F.when(file.startswith(p), day) for p, day in ISSUE_DATES.items()],
        _part(file, r"^.*aja_ee_(\d{4})_(\d+)\.", 1, "-XX-XX"),
        _part(file, parliament, 1, "-", _two(F.regexp_extract(file, parliament, 2)), "-XX"),
        _part(file, doctors, 1, "-", doctors_month, "-XX"),
        _part(file, society, century, 1, "-", society_month, "-XX"),
        _part(file, r"^.*agraar_(\d{4})\.", 1, "-XX-XX"),
        _part(file, r"^.*horisont_(\d{4})\.", 1, "-XX-XX"),
        *[F.when(file.startswith(p), f"{year}-XX-XX") for p, year in VOLUME_YEARS.items()],
        *[F.when(file.startswith(p), UNKNOWN) for p in DATELESS],
    ]
    return F.coalesce(*rules)


def completeness(date: Column) -> Column:
    return F.when(date.rlike(r"^\d{4}-\d+-\d+"), "full_date").when(date.rlike(r"^\d{4}-(XX-XX|\d+-XX)"), "partial_date").otherwise("unknown_date")


def _century(year: Column) -> Column:
    """A year of two digits: 69 to 99 are of the last century."""
    return F.concat(F.when(year.try_cast("int") >= 69, "19").otherwise("20"), year)


def iso_minutes(text: Column) -> Column:
    """A free date and time as yyyy-mm-ddTHH:MM, whatever zone it names; a day alone ends in TXX:XX; else null."""
    plain, english = lambda m: _two(m), english_month
    estonian = lambda m: month_number(F.lower(m))
    whole = lambda y: y
    # pattern, how to read the month and the year, time known; the first that matches decides
    forms = [
        (r"(\d\d)\.(\d\d)\.(\d{4}) (\d\d):(\d\d)", plain, whole, True),
        (r", (\d+) ([^0-9 ]+) (\d{4}) (\d\d)\s*:\s*(\d\d)", english, whole, True),
        (r"(\d+) ([^0-9 ]+) (\d{4}) (\d\d)\s*:\s*(\d+)", english, whole, True),
        (r"(\d+)\. ([^0-9 ]+) (\d{4})\. a\. (\d+)\s*:\s*(\d+)", estonian, whole, True),
        (r", (\d+) ([^0-9 ]+) (\d\d) (\d\d)\s*:\s*(\d\d)", english, _century, True),
        (r"(\d+)-(\d+)-(\d{4}) , (\d\d):(\d\d)", plain, whole, True),
        (r"(\d+)\.(\d+)\.(\d{4})", plain, whole, False),
    ]
    cases = []
    for pattern, month, year, timed in forms:
        g = lambda k, p=pattern: F.regexp_extract(text, p, k)
        clock = [F.lit("T"), _two(g(4)), F.lit(":"), _two(g(5))] if timed else [F.lit("TXX:XX")]
        cases.append((text.rlike(pattern), F.concat(year(g(3)), F.lit("-"), month(g(2)), F.lit("-"), _two(g(1)), *clock)))
    return _chain(cases)
