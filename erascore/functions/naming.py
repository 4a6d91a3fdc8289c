"""Model naming, key parsing and date helpers (C1-C5) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def model_key(path, name, version, revision, trial, epoch, suffix) -> Column:
    """``<path>/<name>v<ver>r<rev>t<trial>-e<epoch><suffix>``."""
    return F.format_string("%s/%sv%dr%dt%d-e%d%s", _c(path), _c(name), _c(version), _c(revision),
                           _c(trial), _c(epoch), _c(suffix))


def model_full_name(name, version, revision, step=None) -> Column:
    """``<name>v<ver>r<rev>``, or with ``s<step>`` appended when the step is non-zero."""
    base = F.format_string("%sv%dr%d", _c(name), _c(version), _c(revision))
    if step is None:
        return base
    return F.when(F.coalesce(_c(step), F.lit(0)) != 0,
                  F.format_string("%sv%dr%ds%d", _c(name), _c(version), _c(revision), _c(step))).otherwise(base)


def epoch_from_key(key) -> Column:
    """The number after ``-e`` (NULL when absent)."""
    s = F.regexp_extract(_c(key), r"-e([0-9]+)", 1)
    return F.when(s != "", s.cast("int"))


def is_weekday(ts) -> Column:
    """C4: Monday..Friday (``weekday`` is 0 for Monday)."""
    return F.weekday(_c(ts)) < 5


def round_dir_name(ts) -> Column:
    """``<year>d<day of year>`` (day of year zero-padded to three digits)."""
    return F.format_string("%dd%03d", F.year(_c(ts)), F.dayofyear(_c(ts)))
