"""Sky geometry as column arithmetic: plate matrix, gnomonic projection, separations.

Headers are columns crpix1/2, crval1/2, cd11..cd22 or cdelt1/2 with crota2, ctype1/2. Pixels
count from 0. Only the TAN projection (Calabretta & Greisen 2002) has a closed form here; other
projections give null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def projection(ctype1: Column) -> Column:
    """Text after the last dash, else UNKNOWN."""
    return F.when(F.contains(ctype1, F.lit("-")),
                  F.element_at(F.split(ctype1, "-"), -1)).otherwise("UNKNOWN")


def plate_matrix(h: str = "") -> dict[str, Column]:
    """The CD matrix, or the one that scale and rotation stand for."""
    c = lambda n: F.col(h + n)
    turn = F.radians(F.coalesce(c("crota2"), F.lit(0.0)))
    has_cd = c("cd11").isNotNull()
    zero = F.lit(0.0)
    return {
        "cd11": F.when(has_cd, c("cd11")).otherwise(c("cdelt1") * F.cos(turn)),
        "cd12": F.when(has_cd, F.coalesce(c("cd12"), zero)).otherwise(-c("cdelt2") * F.sin(turn)),
        "cd21": F.when(has_cd, F.coalesce(c("cd21"), zero)).otherwise(c("cdelt1") * F.sin(turn)),
        "cd22": F.when(has_cd, c("cd22")).otherwise(c("cdelt2") * F.cos(turn)),
    }


def rotation(h: str = "") -> Column:
    """From the CD matrix when there is one, else a non-zero CROTA2, else 0."""
    c = lambda n: F.col(h + n)
    from_cd = F.degrees(F.atan2(F.coalesce(c("cd12"), F.lit(0.0)), c("cd11")))
    return F.when(c("cd11").isNotNull(), from_cd).otherwise(F.coalesce(c("crota2"), F.lit(0.0)))


def scales(m: dict[str, Column]) -> tuple[Column, Column]:
    """Degrees per pixel along each axis: the length of each matrix column."""
    return F.hypot(m["cd11"], m["cd21"]), F.hypot(m["cd12"], m["cd22"])


def pixel_to_sky(x: Column, y: Column, h: str = "") -> Column:
    """``struct<ra,dec>`` in degrees of a 0-based pixel position."""
    m = plate_matrix(h)
    c = lambda n: F.col(h + n)
    dx, dy = x + 1 - c("crpix1"), y + 1 - c("crpix2")
    xi = F.radians(m["cd11"] * dx + m["cd12"] * dy)
    eta = F.radians(m["cd21"] * dx + m["cd22"] * dy)
    d0 = F.radians(c("crval2"))
    side = F.cos(d0) - eta * F.sin(d0)
    ra = F.pmod(c("crval1") + F.degrees(F.atan2(xi, side)), F.lit(360.0))
    dec = F.degrees(F.atan2(F.sin(d0) + eta * F.cos(d0), F.hypot(xi, side)))
    return F.when(projection(c("ctype1")) == "TAN", F.struct(ra.alias("ra"), dec.alias("dec")))


def sky_to_pixel(ra: Column, dec: Column, h: str = "") -> Column:
    """``struct<x,y>``, 0-based; null at 90 degrees or more from the reference point."""
    m = plate_matrix(h)
    c = lambda n: F.col(h + n)
    d0, d, a = F.radians(c("crval2")), F.radians(dec), F.radians(ra - c("crval1"))
    depth = F.sin(d0) * F.sin(d) + F.cos(d0) * F.cos(d) * F.cos(a)
    xi = F.degrees(F.cos(d) * F.sin(a) / depth)
    eta = F.degrees((F.cos(d0) * F.sin(d) - F.sin(d0) * F.cos(d) * F.cos(a)) / depth)
    det = m["cd11"] * m["cd22"] - m["cd12"] * m["cd21"]
    x = (m["cd22"] * xi - m["cd12"] * eta) / det + c("crpix1") - 1
    y = (m["cd11"] * eta - m["cd21"] * xi) / det + c("crpix2") - 1
    ok = (projection(c("ctype1")) == "TAN") & (depth > 1e-12) & (det != 0)
    return F.when(ok, F.struct(x.alias("x"), y.alias("y")))


def separation(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Great-circle distance in arcminutes, in the form that is stable at all distances."""
    d1, d2, a = F.radians(dec1), F.radians(dec2), F.radians(ra2 - ra1)
    up = F.hypot(F.cos(d2) * F.sin(a),
                 F.cos(d1) * F.sin(d2) - F.sin(d1) * F.cos(d2) * F.cos(a))
    across = F.sin(d1) * F.sin(d2) + F.cos(d1) * F.cos(d2) * F.cos(a)
    return F.degrees(F.atan2(up, across)) * 60.0


def field_geometry(h: str = "", nx: str = "naxis1", ny: str = "naxis2") -> Column:
    """Centre, field of view, scale, rotation, projection and corners; null without WCS keys."""
    m = plate_matrix(h)
    sx, sy = scales(m)
    c = lambda n: F.col(h + n)
    w, t = c(nx).cast("double"), c(ny).cast("double")
    zero = F.lit(0.0)
    corners = F.array(*[pixel_to_sky(x, y, h) for x, y in
                        ((zero, zero), (w - 1, zero), (w - 1, t - 1), (zero, t - 1))])
    center = pixel_to_sky(w / 2, t / 2, h)
    body = F.struct(
        center.alias("center"),
        F.struct(F.round(sx * w * 60, 2).alias("width"),
                 F.round(sy * t * 60, 2).alias("height")).alias("fov_arcmin"),
        F.round((sx + sy) / 2 * 3600, 4).alias("pixel_scale_arcsec"),
        F.round(rotation(h), 2).alias("rotation_deg"),
        projection(c("ctype1")).alias("projection"), corners.alias("corners"))
    return F.when(c("ctype1").isNotNull() & c("ctype2").isNotNull() & center.isNotNull(), body)
