"""Helpers shared by the operators of this subpackage.

Conventions that hold for every operator here unless its docstring says otherwise:

* a null text counts as the empty text, a null id sorts after every other id;
* only the named id and text columns are read, so extra columns of any name do no harm;
* Python work runs in tasks over Arrow batches cut to a bounded number of characters
  (:func:`text_batches`), one row is the least such a batch can hold.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aloft.session import require_checkpoint_dir

#: characters of text worked on at once in a task
BATCH_CHARS = 4_000_000


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per SparkContext (what ``--py-files`` does)."""
    sc = spark.sparkContext
    if getattr(sc, "_aloft_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="aloft-py-"), "aloft.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(target)
    sc._aloft_shipped = True


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the folder in ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage at a place that outlives executors; Parquet keeps it smaller
    than ``checkpoint()`` does.
    """
    spark = df.sparkSession
    path = f"{require_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` is called that."""
    while name in df.columns:
        name += "_"
    return name


def columns_of(df: DataFrame) -> list:
    """The columns of ``df``, whatever they are called."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def fold(id_col: str, parts: int):
    """crc32 of the id as text (null: the empty text) modulo ``parts``."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % parts


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def share(total: int, least: int, most: int) -> int:
    """Into how many parts ``total`` bytes go: parts of ``least`` bytes, and of up to ``most`` once
    there would be more than 2,000."""
    return int(max(1, total // min(most, max(least, total // 2_000))))


def text_batches(batches: Iterator[pa.RecordBatch], column: str,
                 most: int = BATCH_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut incoming batches so that each holds about ``most`` bytes of ``column``."""
    for batch in batches:
        n = batch.num_rows
        col = batch.column(batch.schema.get_field_index(column))
        sizes = pa.compute.fill_null(pa.compute.binary_length(col), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i in range(n):
            held += int(sizes[i])
            if held >= most:
                yield batch.slice(start, i + 1 - start)
                start, held = i + 1, 0
        if start < n:
            yield batch.slice(start, n - start)


def per_text(docs: DataFrame, work: Callable[[list[str]], dict], schema: str, *,
             id_col: str = "doc_id", text_col: str = "text", out_id: str = "doc_id",
             extra: list | None = None, most: int = BATCH_CHARS) -> DataFrame:
    """One output row per input row: ``work(texts)`` gives a dict of column -> values.

    ``schema`` lists the computed columns; the id goes first under ``out_id``.
    ``extra`` are further input expressions carried through unchanged after the id.
    """
    ship(docs.sparkSession)
    extra = extra or []
    src = docs.select(F.col(id_col).alias(out_id), *extra, F.col(text_col).alias("__text"))
    kept = [f for f in src.schema.fields if f.name != "__text"]
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    full = f"{head}, {schema}"
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "__text", most):
            texts = [t or "" for t in batch.column(len(names)).to_pylist()]
            made = work(texts)
            cols = [batch.column(i) for i in range(len(names))]
            cols += [v if isinstance(v, pa.Array) else pa.array(v) for v in made.values()]
            yield pa.RecordBatch.from_arrays(cols, names=[*names, *made])

    return src.mapInArrow(run, full)
