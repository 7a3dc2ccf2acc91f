"""Scalar column expressions (cleaning rules, geometry)."""
from wingspan.functions.scalars import *  # noqa: F401,F403
from wingspan.functions.geometry import ewkt, make_point, point_violation, lonlat_warning  # noqa: F401
