"""Column expressions for the cleaning rules.

Every function takes and returns a ``Column`` built from built-in Spark
functions only, so it stays inside whole-stage codegen: no Python UDF.
Inputs that do not parse give NULL instead of raising (ANSI mode is on by
default in Spark 4, so the ``try_*`` variants are used throughout).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- fixed values -----------------------------------------------------------
# Text accepted as boolean, after trim and lower case (the SQL boolean input rule).
TRUE_WORDS = ["1", "t", "tr", "tru", "true", "y", "ye", "yes", "on"]
FALSE_WORDS = ["0", "f", "fa", "fal", "fals", "false", "n", "no", "of", "off"]
# Clock strings that mean midnight / unknown in the visit tables.
MIDNIGHT_WORDS = ["00:00", "0", "00:00:00"]
# Sentinel for a missing recorder code.
MISSING_CODE = 9999
# Geometry settings of the published model.
SRID = 3035
# Values of geo_info_level that set the section flag.
SECTION_LEVEL = "section_centroid"
TRANSECT_LEVEL = "transect_centroid"
# ----------------------------------------------------------------------------


def qualify(prefix: ColumnOrName, local_id: ColumnOrName) -> Column:
    """``prefix || '.' || id``; NULL when either part is NULL."""
    return F.concat(_c(prefix).cast("string"), F.lit("."), _c(local_id).cast("string"))


def parse_date(c: ColumnOrName) -> Column:
    """text ``YYYY-MM-DD`` (one- or two-digit month and day) to date.

    Trailing text after the date is ignored; an impossible date gives NULL.
    """
    head = F.regexp_extract(F.trim(_c(c).cast("string")), r"^(\d{4}-\d{1,2}-\d{1,2})", 1)
    return F.try_to_timestamp(F.nullif(head, F.lit("")), F.lit("yyyy-M-d")).cast("date")


def _hms(h: Column, m: Column, s: Column) -> Column:
    return F.format_string("%02d:%02d:%02d", h, m, s)


def clock_to_minute(c: ColumnOrName) -> Column:
    """time of day read as ``HH24:MI``: seconds and trailing text dropped.

    Result is a ``HH:mm:ss`` string with ``ss`` = ``00``; bad input gives NULL.
    """
    s = F.trim(_c(c).cast("string"))
    rx = r"^(\d{1,2}):(\d{1,2})"
    h = F.regexp_extract(s, rx, 1)
    m = F.regexp_extract(s, rx, 2)
    hi, mi = h.try_cast("int"), m.try_cast("int")
    ok = (h != "") & (hi <= 23) & (mi <= 59)
    return F.when(ok, _hms(hi, mi, F.lit(0)))


def normalise_clock(c: ColumnOrName) -> Column:
    """``00:00``, ``0``, ``00:00:00`` become ``00:00:00``; ``H:M``
    (optionally ``:S``) becomes ``HH:MM:SS``; anything else NULL."""
    s = _c(c).cast("string")
    t = F.trim(s)
    rx = r"^(\d{1,2}):(\d{1,2})(?::(\d{1,2}))?$"
    h = F.regexp_extract(t, rx, 1).try_cast("int")
    m = F.regexp_extract(t, rx, 2).try_cast("int")
    sec = F.coalesce(F.nullif(F.regexp_extract(t, rx, 3), F.lit("")).try_cast("int"), F.lit(0))
    ok = F.regexp_like(t, F.lit(rx)) & (h <= 23) & (m <= 59) & (sec <= 59)
    return F.when(s.isin(*MIDNIGHT_WORDS), F.lit("00:00:00")).when(ok, _hms(h, m, sec))


def try_cast_to_time(c: ColumnOrName) -> Column:
    """lenient text to time of day, NULL on any failure.

    Keep only digits and ``. : , -``; turn ``, . -`` into ``:``; append
    ``:00:00``; keep 8 characters; strip trailing ``:``; read as time. A
    60th second carries into the next minute; ``24:00:00`` is allowed.
    """
    kept = F.regexp_replace(_c(c).cast("string"), r"[^0-9.:,\-]+", "")
    t = F.regexp_replace(F.left(F.concat(F.translate(kept, ",.-", ":::"), F.lit(":00:00")), F.lit(8)), r":+$", "")
    day = r"^([01]?[0-9]|2[0-3]):([0-5]?[0-9])(?::([0-5]?[0-9]|60))?$"
    midnight = r"^24:0?0(?::0?0)?$"
    h = F.regexp_extract(t, day, 1).try_cast("int")
    m = F.regexp_extract(t, day, 2).try_cast("int")
    s = F.coalesce(F.nullif(F.regexp_extract(t, day, 3), F.lit("")).try_cast("int"), F.lit(0))
    secs = h * 3600 + m * 60 + s
    as_text = _hms(F.floor(secs / 3600), F.floor(secs / 60) % 60, secs % 60)
    return F.when(F.regexp_like(t, F.lit(midnight)), F.lit("24:00:00")).when(
        F.regexp_like(t, F.lit(day)) & (secs <= 86400), as_text
    )


def try_extract_integer(c: ColumnOrName, n: int) -> Column:
    """leading integer of a messy number, NULL on any failure.

    Keep digits and ``. , -``; ``,`` becomes ``.``; keep 4 characters; take the
    part before the first ``-``; read as a number; round up; keep ``n``
    characters of its text; read as int. Negative numbers are lost on purpose.
    """
    kept = F.regexp_replace(_c(c).cast("string"), r"[^0-9.,\-]+", "")
    head = F.split_part(F.left(F.translate(kept, ",", "."), F.lit(4)), F.lit("-"), F.lit(1))
    number = F.when(F.regexp_like(head, F.lit(r"^([0-9]+\.?[0-9]*|\.[0-9]+)$")), head.try_cast("decimal(20,6)"))
    text = F.ceil(number).cast("string")
    return F.left(text, F.lit(n)).try_cast("int")


def parse_bool(c: ColumnOrName) -> Column:
    """text (or a number printed as text) to boolean; unknown words NULL."""
    t = F.lower(F.trim(_c(c).cast("string")))
    return F.when(t.isin(*TRUE_WORDS), F.lit(True)).when(t.isin(*FALSE_WORDS), F.lit(False))


def bool_reject(c: ColumnOrName) -> Column:
    """True where ``parse_bool`` turned a non-NULL input into NULL (a reject)."""
    return _c(c).isNotNull() & parse_bool(c).isNull()


def assign_int(c: ColumnOrName) -> Column:
    """store a number in an int column.

    Floating point rounds half to even; exact decimals round half away from
    zero (the assignment rules of the source system); text is read as a
    decimal first. Out-of-range values give NULL.
    """
    col = _c(c)
    kind = F.typeof(col)  # a constant of the plan
    exact = F.round(col.try_cast("decimal(38,18)"), 0).try_cast("int")
    return F.when(kind.startswith("decimal") | (kind == "string"), exact).otherwise(F.bround(col, 0).try_cast("int"))


def assign_int_decimal(c: ColumnOrName) -> Column:
    """F9 for exact decimals: half away from zero."""
    return F.round(_c(c), 0).try_cast("int")


def fill_missing(c: ColumnOrName, sentinel: int = MISSING_CODE) -> Column:
    """Missing code becomes the sentinel."""
    return F.coalesce(_c(c), F.lit(sentinel))


def section_flag(level: ColumnOrName) -> Column:
    """Three-valued flag: section centroid TRUE, transect centroid FALSE,
    anything else (NULL included) NULL."""
    lv = _c(level)
    return F.when(lv == SECTION_LEVEL, F.lit(True)).when(lv == TRANSECT_LEVEL, F.lit(False))


def site_info_quality(section_length: ColumnOrName, level: ColumnOrName,
                      x: ColumnOrName, y: ColumnOrName) -> Column:
    """Q6: 1 = section length and section coordinates, 2 = section length with
    only transect coordinates, 3 = anything else."""
    has_len = _c(section_length).isNotNull() & (_c(section_length) > 0)
    has_xy = _c(x).isNotNull() & _c(y).isNotNull()
    lv = _c(level)
    return (
        F.when(has_len & has_xy & (lv == SECTION_LEVEL), F.lit(1))
        .when(has_len & has_xy & (lv == TRANSECT_LEVEL), F.lit(2))
        .otherwise(F.lit(3))
    )


def within_tolerance(total: ColumnOrName, declared: ColumnOrName, tol: float = 10.0) -> Column:
    """A5 row rule: section total equals the transect length within +/- tol."""
    return F.abs(_c(total) - _c(declared)) <= F.lit(tol)
