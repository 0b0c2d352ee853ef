"""Column expressions for pixel math.

All of these are built-in Catalyst expressions, so they stay inside
whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for identical results)
# ---------------------------------------------------------------------------
# Grayscale weights applied to R, G, B.
GRAY_WEIGHTS_RGB = (0.299, 0.587, 0.114)
# Rec.709 luminance weights applied to B, G, R.
LUMA_WEIGHTS_BGR = (0.0722, 0.7152, 0.2126)
# Linear RGB -> XYZ rows (coefficients for r, g, b).
RGB_TO_XYZ = (
    (0.4124, 0.3576, 0.1805),
    (0.2126, 0.7152, 0.0722),
    (0.0193, 0.1192, 0.9505),
)
# XYZ -> linear RGB rows (coefficients for X, Y, Z), producing r, g, b.
XYZ_TO_RGB = (
    (3.2406, -1.5372, -0.4986),
    (-0.9689, 1.8758, 0.0415),
    (0.0557, -0.2040, 1.0570),
)
# Offset inside log10(delta + Y) of the xyY conversion.
LOG_Y_DELTA = 1e-4
# Depth names by (type code & 7), in code order 0..7.
DEPTH_NAMES = ("8U", "8S", "16U", "16S", "32S", "32F", "64F", "User")
# Channel numbering of interleaved samples.
BLUE, GREEN, RED = 0, 1, 2
# ---------------------------------------------------------------------------


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clamp8(v: str | Column) -> Column:
    """Saturate an integer expression to 0..255."""
    return F.least(F.lit(255), F.greatest(F.lit(0), col(v)))


def gray(r: str | Column = "r", g: str | Column = "g", b: str | Column = "b",
         rounding: str = "floor") -> Column:
    """8-bit gray from 8-bit R, G, B.

    ``floor`` truncates like the GPU kernel's store to an unsigned byte;
    ``half_even`` rounds like a library colour conversion.
    """
    wr, wg, wb = (F.lit(w).cast("double") for w in GRAY_WEIGHTS_RGB)
    v = col(r) * wr + col(g) * wg + col(b) * wb
    if rounding == "floor":
        return F.floor(v).cast("int")
    if rounding == "half_even":
        return F.rint(v).cast("int")
    raise ValueError(f"unknown rounding {rounding!r}")


def luminance(b: str | Column = "b", g: str | Column = "g",
              r: str | Column = "r") -> Column:
    wb, wg, wr = LUMA_WEIGHTS_BGR
    return col(b) * F.lit(wb) + col(g) * F.lit(wg) + col(r) * F.lit(wr)


def exposure(v: str | Column, alpha: float | Column, beta: float | Column) -> Column:
    """``alpha*v + beta`` truncated toward zero, saturated to 0..255.

    The value is bounded before the cast so that no input can overflow it.
    """
    a = alpha if isinstance(alpha, Column) else F.lit(float(alpha))
    bt = beta if isinstance(beta, Column) else F.lit(float(beta))
    raw = col(v) * a + bt
    bounded = F.least(F.lit(256.0), F.greatest(F.lit(-1.0), raw))
    return clamp8(bounded.cast("int"))


def wrap8(v: str | Column) -> Column:
    """Store into an unsigned byte: keep the value modulo 256."""
    return F.pmod(col(v), F.lit(256))


def quantise8(v: str | Column) -> Column:
    """Float in 0..1 -> 8 bit: ``v*255`` rounded half-even, saturated.

    NaN and NULL (undefined results such as 0/0) become 0.
    """
    clean = F.coalesce(F.nanvl(col(v), F.lit(0.0)), F.lit(0.0))
    return F.least(F.lit(255.0), F.greatest(F.lit(0.0), F.rint(clean * 255))).cast("int")


def safe_div(num: Column, den: Column) -> Column:
    """Division that yields NULL for a zero denominator (no error under ANSI)."""
    return num / F.nullif(den, F.lit(0.0))


def image_type_name(mode: str | Column) -> Column:
    """Name of an image type code: depth name, 'C', channel count."""
    m = col(mode)
    depth = F.element_at(F.array(*[F.lit(n) for n in DEPTH_NAMES]),
                         (m.bitwiseAND(F.lit(7)) + 1).cast("int"))
    channels = F.shiftright(m, 3) + 1
    return F.concat(depth, F.lit("C"), channels.cast("string"))


def rgb_to_xyz(r: Column, g: Column, b: Column) -> tuple[Column, Column, Column]:
    return tuple(r * F.lit(cr) + g * F.lit(cg) + b * F.lit(cb)  # type: ignore[return-value]
                 for cr, cg, cb in RGB_TO_XYZ)


def xyz_to_rgb(xx: Column, yy: Column, zz: Column) -> tuple[Column, Column, Column]:
    return tuple(xx * F.lit(cx) + yy * F.lit(cy) + zz * F.lit(cz)  # type: ignore[return-value]
                 for cx, cy, cz in XYZ_TO_RGB)
