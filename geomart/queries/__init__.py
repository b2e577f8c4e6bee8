"""The registered queries and the SQL each one is checked against."""

from __future__ import annotations

from geomart.queries import clean, geo, io, mart, profiling, quality, stream  # noqa: F401
from geomart.queries.base import ORACLES, QUERIES  # noqa: F401
