"""Small scalar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

F1_GUARD = 1e-8  # fixed value: the denominator guard of the F1 formula


def sigmoid(x: Column) -> Column:
    """logistic function of a logit, without overflow for large ones."""
    e = F.exp(-F.abs(x))
    return F.when(x >= 0, 1.0 / (1.0 + e)).otherwise(e / (1.0 + e))


NUMBER = r"^\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*$"


def to_number(x: Column) -> Column:
    """Number from text; anything but a plain decimal number -> null.

    A cast alone would take a type suffix (``1d``), ``NaN`` and ``Infinity``.
    """
    text = x.cast("string")
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))


def label_at(score: Column, threshold, inclusive: bool = True) -> Column:
    """P7 (score >= t, ``inclusive``) / P8 (score > t): 0/1 label."""
    t = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return ((score >= t) if inclusive else (score > t)).cast("int")


def metric_from_name(name: Column, metric: str = "f1") -> Column:
    """parse ``<metric>_<number>`` out of a file name; null when absent."""
    return F.nullif(F.regexp_extract(name, metric + r"_([0-9]+\.[0-9]+)", 1),
                    F.lit("")).try_cast("double")


def strip_suffix(name: Column, suffix: str) -> Column:
    """remove a fixed suffix from a column name."""
    return F.regexp_replace(name, F.lit(_re_escape(suffix) + "$"), F.lit(""))


def _re_escape(s: str) -> str:
    import re
    return re.escape(s)
