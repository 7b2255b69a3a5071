"""Scalar cleaning rules of the warehouse.

Each function takes and returns a ``Column``. Blank and NULL handling follows
the warehouse SQL exactly; text casts rely on ANSI mode so malformed text raises
instead of turning NULL.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values: labels the cleaned warehouse must carry ------------------------
RENT_TYPE_UNKNOWN = "권종확인불가"   # rent type missing
GENDER_FEMALE = "여성"              # code F
GENDER_MALE = "남성"                # code M
GENDER_UNKNOWN = "성별확인불가"      # any other code, blank or NULL
AGE_OTHER = "기타"                  # source value meaning "other"
AGE_UNKNOWN = "연령확인불가"         # age missing, blank or "other"
# -----------------------------------------------------------------------------------

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rent_type(c: ColumnOrName) -> Column:
    """NULL or blank after trimming spaces -> unknown label, else trimmed."""
    c = _c(c)
    t = F.trim(c)
    return F.when((t == F.lit("")) | c.isNull(), F.lit(RENT_TYPE_UNKNOWN)).otherwise(t)


def gender(c: ColumnOrName) -> Column:
    """upper(trim) F / M to labels; everything else, NULL included, unknown."""
    u = F.upper(F.trim(_c(c)))
    return (F.when(u == F.lit("F"), F.lit(GENDER_FEMALE))
             .when(u == F.lit("M"), F.lit(GENDER_MALE))
             .otherwise(F.lit(GENDER_UNKNOWN)))


def age_type(c: ColumnOrName) -> Column:
    """Blank, "other" or NULL -> unknown label, else trimmed."""
    c = _c(c)
    t = F.trim(c)
    return F.when(t.isin("", AGE_OTHER) | c.isNull(), F.lit(AGE_UNKNOWN)).otherwise(t)


def _blank_to_null(c: ColumnOrName) -> Column:
    return F.nullif(_c(c), F.lit(""))


def blank_int(c: ColumnOrName) -> Column:
    """B6: '' -> NULL, else cast to int (ANSI: ' ' or '1.5' raise)."""
    return _blank_to_null(c).cast(T.IntegerType())


def blank_double(c: ColumnOrName) -> Column:
    """B7: '' -> NULL, else cast to double."""
    return _blank_to_null(c).cast(T.DoubleType())


def blank_decimal(c: ColumnOrName, precision: int, scale: int) -> Column:
    """B8: '' -> NULL, else cast to decimal(p, s); rounds half-up, raises on overflow."""
    return _blank_to_null(c).cast(T.DecimalType(precision, scale))


def station_number(c: ColumnOrName) -> Column:
    """Integer before the first dot of a station name; empty -> NULL."""
    return F.nullif(F.split_part(_c(c), F.lit("."), F.lit(1)), F.lit("")).cast(T.IntegerType())


def station_name(c: ColumnOrName) -> Column:
    """Trimmed text between the first and the second dot of a station name."""
    return F.trim(F.split_part(_c(c), F.lit("."), F.lit(2)))


def iso_date(c: ColumnOrName) -> Column:
    """B1 date: ISO text cast to DATE."""
    return _c(c).cast(T.DateType())


def any_date(c: ColumnOrName) -> Column:
    """B2 date: 'yyyy-MM-dd' or 'yyyyMMdd' -> DATE (impossible dates raise)."""
    return F.to_date(compact_text(c), "yyyyMMdd")


def compact_text(c: ColumnOrName) -> Column:
    return F.replace(_c(c), F.lit("-"), F.lit(""))


# ---- driver-side parameters -------------------------------------------------------

def _as_date(d: str | _dt.date) -> _dt.date:
    if isinstance(d, _dt.datetime):
        return d.date()
    if isinstance(d, _dt.date):
        return d
    s = str(d).strip()
    fmt = "%Y-%m-%d" if "-" in s else "%Y%m%d"
    return _dt.datetime.strptime(s, fmt).date()


def iso_text(d: str | _dt.date) -> str:
    """A period bound as 'yyyy-MM-dd' text (accepts date, ISO or compact text)."""
    return _as_date(d).isoformat()


def period_bounds(start: str | _dt.date, end: str | _dt.date) -> tuple[_dt.date, _dt.date]:
    s, e = _as_date(start), _as_date(end)
    if s > e:
        raise ValueError(f"period start {s} is after end {e}")
    return s, e


def timestamp_literal(load_ts: str | _dt.datetime | Column | None) -> Column:
    """One audit timestamp for every row of a run (TIMESTAMP without zone).

    ``None`` means the statement time, evaluated once per query."""
    if load_ts is None:
        return F.localtimestamp()
    if isinstance(load_ts, Column):
        return load_ts.cast(T.TimestampNTZType())
    if isinstance(load_ts, _dt.datetime):
        load_ts = load_ts.replace(tzinfo=None).isoformat(sep=" ")
    return F.lit(str(load_ts)).cast(T.TimestampNTZType())
