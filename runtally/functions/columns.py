"""Column expressions (JVM-side, codegen'd) shared by every pipeline.

Each function takes and returns ``Column`` objects; none of them touch data.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from runtally import config as C



def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- strings
def site_token(text: Column | str) -> Column:
    """First space-separated token of a site label ("SC1 - lower" -> "SC1")."""
    return F.substring_index(col(text), " ", 1)


def concat_strict(*parts: Column | str) -> Column:
    """NULL if any part is NULL (unlike ``concat_ws``); strings are literals."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def isin_false(c: Column | str, values: Iterable) -> Column:
    """Membership that is never NULL (a NULL input is simply not a member)."""
    return F.coalesce(col(c).isin(list(values)), F.lit(False))


# ------------------------------------------------------------------ times
# Zero-padded text is cut at fixed places into ISO text for a cast, which costs a fraction of a pattern
# parse; any other text goes to the pattern. Both give NULL for days that do not exist.
_CLOCK_SHAPE = r"^[0-9]{2}/[0-9]{2}/[1-9][0-9]{3} (?:0[1-9]|1[0-2]):[0-5][0-9]:[0-5][0-9] [AP]M\z"
_SLASH_SHAPE = r"^[0-9]{2}/[0-9]{2}/[1-9][0-9]{3}\z"
_PLAIN_SHAPE = r"^[0-9]{4}[1-9][0-9]{3}\z"


def parse_local_ts(text: Column | str, ampm: str = "parse") -> Column:
    """Report clock text -> TIMESTAMP_NTZ wall clock; bad text -> NULL.

    The text is parsed once with an explicit "+00:00" offset, so the instant
    is the wall clock read as UTC whatever the session zone is (no DST gap
    can move it), then re-based onto the NTZ epoch. ``try_`` semantics: text
    that does not parse gives NULL instead of failing the task.
    Text of ``_CLOCK_SHAPE`` takes a cheaper way to the same value.
    ``ampm="ignore"`` keeps only "date clock" and parses it as a 12-hour
    clock without the marker (12:30 PM becomes 00:30).
    """
    whole = t = col(text)
    fmt = C.OBS_TIME_FORMAT
    if ampm == "ignore":
        t = F.regexp_extract(t, r"^\S+ \S+", 0)
        fmt = C.OBS_TIME_FORMAT_NO_AMPM
    elif ampm != "parse":
        raise ValueError(f"ampm must be 'parse' or 'ignore', not {ampm!r}")
    instant = F.try_to_timestamp(F.concat(t, F.lit(" +00:00")), F.lit(fmt + " XXX"))
    by_pattern = F.timestamp_add("MICROSECOND", F.unix_micros(instant), _ntz_epoch())
    return F.when(whole.rlike(_CLOCK_SHAPE), _clock_by_cast(whole, ampm)).otherwise(by_pattern)


def _iso_date(text: Column, year: int, month: int, day: int) -> Column:
    """ISO date text of the parts that start at these places."""
    return F.concat(
        F.substring(text, year, 4), F.lit("-"), F.substring(text, month, 2), F.lit("-"), F.substring(text, day, 2)
    )


def _clock_by_cast(text: Column, ampm: str) -> Column:
    """Text of ``_CLOCK_SHAPE`` as its wall clock."""
    hour = F.substring(text, 12, 2).try_cast("int") % 12
    if ampm == "parse":
        hour = hour + F.when(text.endswith("PM"), 12).otherwise(0)
    iso = F.concat(_iso_date(text, 7, 1, 4), F.lit(" "), hour.cast("string"), F.substring(text, 14, 6))
    return iso.try_cast("timestamp_ntz")


def parse_mdy(text: Column | str) -> Column:
    """Month-day-year date in either report spelling ("3/5/2001" or
    "03052001"); bad -> NULL. The spelling is picked from the text so each
    value is parsed once (a failed parse attempt costs an exception)."""
    t = col(text)
    slash, plain = C.RELEASE_DATE_FORMATS
    return F.when(
        F.instr(t, "/") > 0,
        F.when(t.rlike(_SLASH_SHAPE), _iso_date(t, 7, 1, 4).try_cast("date")).otherwise(F.try_to_date(t, slash)),
    ).otherwise(F.when(t.rlike(_PLAIN_SHAPE), _iso_date(t, 5, 1, 3).try_cast("date")).otherwise(F.try_to_date(t, plain)))


def _ntz_epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def descending_time(ts: Column | str) -> Column:
    """A sort key for a TIMESTAMP_NTZ, latest first: the interval from it to 1970 (zone-free, exact)."""
    return _ntz_epoch() - col(ts)


def ntz_micros(ts: Column | str) -> Column:
    """Wall-clock microseconds since 1970-01-01 of a TIMESTAMP_NTZ.

    Built from the date and clock fields, which carry no zone: a
    ``timestamp_diff`` on NTZ values applies the session zone's DST rules
    and is an hour off around a gap in that zone.
    """
    c = col(ts)
    day = F.unix_date(F.to_date(c)).cast("long") * 86_400_000_000
    clock = (F.hour(c) * 3600 + F.minute(c) * 60).cast("long") * 1_000_000
    seconds = (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("long")
    return day + clock + seconds


def local_to_utc(ts: Column | str, zone: str = C.LOCAL_ZONE) -> Column:
    """Wall clock in ``zone`` -> the same instant as a UTC wall clock."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), col(ts))


def elapsed_days(later: Column | str, earlier: Column | str, zone: str = C.LOCAL_ZONE) -> Column:
    """Elapsed (not calendar) days between two local wall clocks, as double.

    Both clocks become UTC wall clocks (``convert_timezone`` with an explicit
    zone); their difference is then plain arithmetic on zone-free fields.
    """
    micros = ntz_micros(local_to_utc(later, zone)) - ntz_micros(local_to_utc(earlier, zone))
    return micros.cast("double") / F.lit(86_400_000_000.0)


def entry_date(ts: Column | str, zone: str | None = None) -> Column:
    """Date of a local timestamp; with ``zone`` the date as seen in that zone."""
    if zone is None:
        return F.to_date(col(ts))
    return F.to_date(F.convert_timezone(F.lit(C.LOCAL_ZONE), F.lit(zone), col(ts)))


# ------------------------------------------------------- spawn-year rules
def spawn_year(obs_ts: Column | str, species: Column | str) -> Column:
    """Mid-year species from day 183 on belong to next year's run."""
    ts = col(obs_ts)
    midyear = (F.dayofyear(ts) >= C.MIDYEAR_DOY) & (col(species) == C.MIDYEAR_SPECIES)
    return F.when(midyear, F.year(ts) + 1).otherwise(F.year(ts))


def current_spawn_year(species: Column | str, cfg: C.RunConfig) -> Column:
    """Constant key lookup (species -> current spawn year) as a CASE.

    Unknown species get NULL so that equality filters drop them.
    """
    s = col(species)
    expr = None
    for sp in cfg.species:
        value = F.lit(cfg.current_spawn_year(sp))
        expr = F.when(s == sp, value) if expr is None else expr.when(s == sp, value)
    return expr.cast("int")


def reclassify_lifestage(stage: Column | str, length_mm: Column | str, species: Column | str) -> Column:
    """Completed-feed life stage, first matching rule wins:
    NULL & <=300 mm -> Juvenile; NULL & >300 mm -> Adult; Adult & <=300 mm
    -> Juvenile; NULL & no length -> Juvenile; other species keep theirs.

    Species membership is tested once (every rule requires it), which keeps
    the generated code small when the inputs are themselves expressions.
    """
    st, ln = col(stage), col(length_mm)
    small = ln <= C.JUVENILE_MAX_LENGTH_MM
    rules = (
        F.when(st.isNull() & small, F.lit("Juvenile"))
        .when(st.isNull() & (ln > C.JUVENILE_MAX_LENGTH_MM), F.lit("Adult"))
        .when((st == "Adult") & small, F.lit("Juvenile"))
        .when(st.isNull() & ln.isNull(), F.lit("Juvenile"))
        .otherwise(st)
    )
    return F.when(isin_false(species, C.RECLASSIFY_SPECIES), rules).otherwise(st)


def not_same_year_juvenile(yrs_at_large: Column | str, stage: Column | str) -> Column:
    """Keep-predicate: NOT (at large 0 years AND juvenile), three-valued.

    The cheap stage test goes first so the years test (two parsed dates) is
    only evaluated for juvenile rows; AND is commutative in three-valued
    logic, so the result is unchanged."""
    return ~((col(stage) == "Juvenile") & (col(yrs_at_large) == 0))


# --------------------------------------------------------- dummy calendar
def dummy_date(day: Column | str, species: Column | str, offset_fix: bool = False) -> Column:
    """Align a calendar date onto the dummy season calendar by day of year.

    First-half days of the mid-year species go to 1977 (``origin + doy``,
    i.e. one day ahead unless ``offset_fix``); everything else goes to 1976
    with ``doy - 1`` (1976 is a leap year, so non-leap 1 March -> 29 Feb).
    """
    doy = F.dayofyear(col(day))
    first_half = (col(species) == C.MIDYEAR_SPECIES) & (doy < C.MIDYEAR_DOY)
    next_origin = F.make_date(F.lit(C.DUMMY_NEXT_YEAR), F.lit(1), F.lit(1))
    origin = F.make_date(F.lit(C.DUMMY_YEAR), F.lit(1), F.lit(1))
    shift = doy - 1 if offset_fix else doy
    return F.when(first_half, F.date_add(next_origin, shift)).otherwise(F.date_add(origin, doy - 1))


def max_dummy_date(species: Column | str) -> Column:
    """Constant key lookup (species -> last dummy date) as a CASE."""
    s = col(species)
    expr = None
    for sp, d in C.SPECIES_MAX_DUMMY.items():
        expr = F.when(s == sp, F.lit(d)) if expr is None else expr.when(s == sp, F.lit(d))
    return expr


def project_on_year(dummy: Column | str, year: int) -> Column:
    """Dummy date -> the same day of year in ``year`` (origin 31 Dec before)."""
    return F.date_add(F.make_date(F.lit(year - 1), F.lit(12), F.lit(31)), F.dayofyear(col(dummy)))


# ------------------------------------------------------------------- math
def half_even_percent(fraction: Column | str) -> Column:
    """Percent rounded half-to-even (12.5 -> 12, 13.5 -> 14), as double."""
    return F.bround(col(fraction) * 100.0, 0).cast("double")


def inch_bin(length_mm: Column | str, width_in: float = 0.5) -> Column:
    """Fixed-width bin of a length converted to inches."""
    per = 1.0 / width_in
    return F.floor(col(length_mm) / C.MM_PER_INCH * per).cast("double") / per


def fixed_width_bin(x: Column | str, width: float) -> Column:
    return F.floor(col(x) / width).cast("double") * width


def number_text(x: Column | str) -> Column:
    """Whole-valued double as text without a trailing ".0" (12.0 -> "12")."""
    c = col(x)
    return F.when(c == F.floor(c), c.cast("bigint").cast("string")).otherwise(c.cast("string"))


# English month abbreviations, as the "%b" format prints them.
MONTH_ABBREVIATIONS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def month_day(d: Column | str) -> Column:
    """Abbreviated month and zero-padded day ("Mar 04"), independent of the
    JVM locale and the session zone."""
    c = col(d)
    months = F.array(*[F.lit(m) for m in MONTH_ABBREVIATIONS])
    return F.concat(F.element_at(months, F.month(c)), F.lit(" "), F.lpad(F.dayofmonth(c).cast("string"), 2, "0"))


def case_map(key: Column | str, mapping: Mapping, default=None) -> Column:
    """Small literal lookup as a CASE chain (no join, stays in codegen)."""
    k = col(key)
    expr = None
    for a, b in mapping.items():
        expr = F.when(k == a, F.lit(b)) if expr is None else expr.when(k == a, F.lit(b))
    return expr.otherwise(F.lit(default)) if default is not None else expr
