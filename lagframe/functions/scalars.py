"""Scalar column helpers: NaN normalisation, sensor scaling, accent folding, labels."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Sensor scale factors.
NDVI_SCALE = 10000.0  # vegetation index DN / 10000
LST_SCALE = 0.02  # surface temperature DN * 0.02 = Kelvin
KELVIN_TO_CELSIUS = 273.15

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, NUMERIC_TYPES)


def nan_to_null(c) -> Column:
    """NaN is a value in Spark but 'missing' in the source model: map it to NULL."""
    c = _col(c)
    return F.when(~F.isnan(c), c)


def normalize_nans(df: DataFrame, cols=None) -> DataFrame:
    """Replace NaN with NULL in the given (default: all float/double) columns."""
    targets = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    if not targets:
        return df
    return df.withColumns({c: nan_to_null(c) for c in targets})


def scale_ndvi(dn) -> Column:
    """Vegetation index DN -> index value."""
    return _col(dn).cast("double") / NDVI_SCALE


def scale_lst(dn) -> Column:
    """Night surface temperature DN -> degrees Celsius."""
    return _col(dn).cast("double") * LST_SCALE - KELVIN_TO_CELSIUS


def clamp_nonneg(c) -> Column:
    """max(0, c); NULL stays NULL."""
    c = _col(c)
    return F.when(c.isNotNull(), F.greatest(F.lit(0.0), c))


def _build_fold_table() -> tuple[str, str]:
    """Derive (from, to) for translate(): every character of the Basic Multilingual Plane
    whose canonical decomposition leaves one base character without its combining marks, then
    the free-standing marks of all planes, which have no counterpart and so are removed."""
    src, dst = [], []
    for cp in range(0x80, 0x10000):
        ch = chr(cp)
        if unicodedata.decomposition(ch) and unicodedata.category(ch) != "Mn":
            base = "".join(c for c in unicodedata.normalize("NFD", ch) if unicodedata.category(c) != "Mn")
            if base != ch and len(base) == 1:
                src.append(ch)
                dst.append(base)
    marks = [chr(cp) for cp in range(0x80, 0x110000) if unicodedata.category(chr(cp)) == "Mn"]
    return "".join(src + marks), "".join(dst)


FOLD_FROM, FOLD_TO = _build_fold_table()


def fold_accents(c) -> Column:
    """Remove diacritics (B8): 'Córdoba' -> 'Cordoba'. Case and ß are kept. One pass, and none
    over a text that is plain ASCII."""
    text = _col(c)
    return F.when(F.octet_length(text) == F.char_length(text), text).otherwise(F.translate(text, FOLD_FROM, FOLD_TO))


def accent_insensitive(c) -> Column:
    """Collated view for accent-insensitive comparison/joins (keeps case)."""
    return F.collate(_col(c), "UNICODE_AI")


def relabel(c, mapping: Mapping[str, str]) -> Column:
    """Map values through a small literal dictionary, falling through to the original."""
    if not mapping:
        return _col(c)
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.coalesce(F.create_map(*pairs)[_col(c)], _col(c))
