"""The pixel expressions as SQL functions.

``register(spark)`` creates temporary SQL functions whose bodies are plain SQL
expressions: Catalyst inlines them, so a query that uses them has the same plan
as the column expressions of :mod:`tessera.functions.pixel` and no Python.
Constants come from there.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tessera.functions import pixel as px


def _d(x: float) -> str:
    return f"{x!r}D"


def _weighted(weights, names) -> str:
    return " + ".join(f"{n} * {_d(w)}" for w, n in zip(weights, names))


def _xyz(row: int) -> str:
    return "(" + _weighted(px.RGB_TO_XYZ[row], "rgb") + ")"


_RGB_INT, _RGB = "r INT, g INT, b INT", "r DOUBLE, g DOUBLE, b DOUBLE"
_LUMA = _weighted(px.GRAY_WEIGHTS_RGB, "rgb")
_NAMES = ", ".join(f"'{n}'" for n in px.DEPTH_NAMES)
_SUM = f"nullif({_xyz(0)} + {_xyz(1)} + {_xyz(2)}, 0.0D)"

# Name, parameters, result type, body.
FUNCTIONS = (
    ("gray8", _RGB_INT, "INT", f"CAST(floor({_LUMA}) AS INT)"),
    ("gray8_even", _RGB_INT, "INT", f"CAST(rint({_LUMA}) AS INT)"),
    ("luminance", "b DOUBLE, g DOUBLE, r DOUBLE", "DOUBLE", _weighted(px.LUMA_WEIGHTS_BGR, "bgr")),
    ("clamp8", "v BIGINT", "INT", "CAST(least(255L, greatest(0L, v)) AS INT)"),
    ("exposure8", "v INT, alpha DOUBLE, beta DOUBLE", "INT",
     "least(255, greatest(0, CAST(least(256.0D, greatest(-1.0D, v * alpha + beta)) AS INT)))"),
    ("wrap8", "v INT", "INT", "pmod(v, 256)"),
    ("abs8", "v BIGINT", "INT", "CAST(least(255L, greatest(v, -v)) AS INT)"),
    ("quantise8", "v DOUBLE", "INT",
     "CAST(least(255.0D, greatest(0.0D, rint(coalesce(nanvl(v, 0.0D), 0.0D) * 255))) AS INT)"),
    ("gamma_map", "v DOUBLE, f_stop DOUBLE, gamma DOUBLE", "DOUBLE",
     "pow(v * pow(2.0D, f_stop), 1.0D / gamma)"),
    ("chroma_x", _RGB, "DOUBLE", f"{_xyz(0)} / {_SUM}"),
    ("chroma_y", _RGB, "DOUBLE", f"{_xyz(1)} / {_SUM}"),
    ("log_luminance", _RGB, "DOUBLE", f"log10({_d(px.LOG_Y_DELTA)} + {_xyz(1)})"),
    ("image_type_name", "code INT", "STRING",
     f"concat(element_at(array({_NAMES}), (code & 7) + 1), 'C', CAST(shiftright(code, 3) + 1 AS STRING))"),
)


def register(spark: SparkSession, prefix: str = "px_") -> list[str]:
    """Create the functions in the session; returns their names."""
    for name, params, kind, body in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({params}) RETURNS {kind} "
                  f"RETURN {body}")
    return [prefix + f[0] for f in FUNCTIONS]
