"""Point geometry as a plain struct.

A point is ``struct<srid:int, x:double, y:double>``. Struct equality compares
the SRID and both ordinates, which is what ``DISTINCT`` on a geometry column
needs. ``ewkt`` renders the export text ``SRID=3035;POINT(x y)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wingspan.functions.scalars import SRID, ColumnOrName, _c

POINT_TYPE = "struct<srid:int,x:double,y:double>"


def make_point(x: ColumnOrName, y: ColumnOrName, srid: int = SRID) -> Column:
    """set (not transform) the SRID on a 2-D point; NULL ordinate gives a NULL point."""
    xd, yd = _c(x).try_cast("double"), _c(y).try_cast("double")
    pt = F.struct(F.lit(srid).alias("srid"), xd.alias("x"), yd.alias("y"))
    return F.when(xd.isNotNull() & yd.isNotNull(), pt)


def _num(c: Column) -> Column:
    # Integral values print without a fraction, others with the shortest round-trip text.
    return F.when((c == F.floor(c)) & (F.abs(c) < F.lit(1e15)), c.cast("bigint").cast("string")).otherwise(
        c.cast("string")
    )


def ewkt(point: ColumnOrName) -> Column:
    """Extended WKT of a point struct; NULL for a NULL point."""
    p = _c(point)
    return F.when(
        p.isNotNull(),
        F.concat(F.lit("SRID="), p["srid"].cast("string"), F.lit(";POINT("), _num(p["x"]), F.lit(" "),
                 _num(p["y"]), F.lit(")")),
    )


def point_violation(point: ColumnOrName, srid: int = SRID) -> Column:
    """F16: a non-NULL point that is not a 2-D point in the model's SRID."""
    p = _c(point)
    return p.isNotNull() & ((p["srid"] != F.lit(srid)) | p["x"].isNull() | p["y"].isNull())


def lonlat_warning(point: ColumnOrName) -> Column:
    """Coordinates inside +/-180 / +/-90 look like degrees, not metres of the projection."""
    p = _c(point)
    return F.coalesce(p.isNotNull() & (F.abs(p["x"]) <= 180) & (F.abs(p["y"]) <= 90), F.lit(False))
