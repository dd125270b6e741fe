"""Registry key prefixes.

A registry key is ``<prefix><namespace>/<name>``; the namespace is the host
that owns the job or claim.  Stripping leaves a value without the prefix
unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default key spaces (the reference reads them from a configuration file that
# is not shipped; these are our own choices).
JOBS_ROOT = "/logflow/jobs/"
LOCKS_ROOT = "/logflow/locks/"
DEFAULT_NAMESPACE = "10.0.0.1"


def key_prefix(root: str, namespace: str = DEFAULT_NAMESPACE) -> str:
    return f"{root}{namespace}/"


JOBS_PREFIX = key_prefix(JOBS_ROOT)
LOCKS_PREFIX = key_prefix(LOCKS_ROOT)


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def add_prefix(name: str | Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), _c(name))


def strip_prefix(key: str | Column, prefix: str) -> Column:
    k = _c(key)
    return F.when(k.startswith(prefix), F.substring(k, len(prefix) + 1, 1 << 30)).otherwise(k)
