"""Plan text and temporary settings for tests."""

from __future__ import annotations

import io
from contextlib import contextmanager, redirect_stdout


def plan_of(df) -> str:
    """The physical plan; after an action on ``df`` the final one that AQE ran."""
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


@contextmanager
def settings(spark, **values):
    """Set Spark options (dots written as two underscores) and put the old ones back."""
    names = {k.replace("__", "."): str(v) for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
