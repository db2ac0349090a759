"""Driver-side gates (P21, P22) and the guarded map.

The gates only touch file-system metadata or ask Spark whether a frame is
empty (which stops at the first row); they never pull data.
"""

from __future__ import annotations

import traceback
from collections.abc import Callable, Iterator
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession

if TYPE_CHECKING:
    import numpy as np
    import pandas as pd


class InputMissing(FileNotFoundError):
    pass


class EmptyResult(RuntimeError):
    pass


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Glob-aware existence check on the cluster file system."""
    fs, p = _hadoop_path(spark, path)
    if any(ch in path for ch in "*?["):
        st = fs.globStatus(p)
        return st is not None and len(st) > 0
    return fs.exists(p)


def require_paths(spark: SparkSession, paths: list[str]) -> None:
    """Fail with a message before any job when an input is missing."""
    missing = [p for p in paths if not path_exists(spark, p)]
    if missing:
        raise InputMissing(f"required input not found: {', '.join(missing)}")


def require_non_empty(df: DataFrame, what: str = "result") -> DataFrame:
    """Raise when the frame has no rows (``isEmpty`` reads one row)."""
    if df.isEmpty():
        raise EmptyResult(f"no {what} produced")
    return df


def guarded_map(df: DataFrame, fn: Callable[[dict[str, np.ndarray]], dict[str, np.ndarray]], out_schema: str,
                keep: list[str]) -> DataFrame:
    """Run a user function on Arrow batches (``mapInPandas``), one call for
    a whole batch of rows.

    ``fn`` takes the input columns as numpy arrays by name and returns its
    outputs likewise, row by row in the same order.  When a call raises, or
    returns arrays of another length, the batch is halved and both halves are tried, down
    to single rows: a row that fails alone keeps its ``keep`` columns, gets NULL
    outputs and the error's text in ``error``, and all others go on.  So n rows
    with f failures cost about 2 f log2(n / f) calls beside the first, and rows
    far from a failure are never called alone.  Only exceptions of ``fn`` are
    caught.  ``out_schema`` lists the ``keep`` columns, the outputs of ``fn`` and
    ``error STRING``; outputs that ``fn`` leaves out are NULL."""
    import numpy as np
    from pyspark.sql.types import _parse_datatype_string

    out_cols = [f.name for f in _parse_datatype_string(out_schema).fields]
    produced = [c for c in out_cols if c not in keep and c != "error"]

    def guarded(rows: pd.DataFrame) -> pd.DataFrame:
        n = len(rows)
        columns = {c: rows[c].to_numpy() for c in rows.columns}
        values = {c: np.full(n, None, object) for c in produced}
        errors = np.full(n, None, object)
        todo = [(0, n)]
        while todo:
            a, b = todo.pop()
            try:
                made = fn({c: v[a:b] for c, v in columns.items()})
                for c in produced:
                    if c in made and len(made[c]) != b - a:
                        raise ValueError(f"{len(made[c])} results for {b - a} rows")
            except Exception as e:  # the guarded map's contract
                if b - a > 1:
                    todo += [((a + b) // 2, b), (a, (a + b) // 2)]
                else:
                    errors[a] = "".join(traceback.format_exception_only(type(e), e)).strip()
                continue
            for c in produced:
                if c in made:
                    values[c][a:b] = made[c]
        return rows[keep].assign(**values, error=errors)[out_cols]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield guarded(batch.reset_index(drop=True))

    return df.mapInPandas(run, out_schema)
