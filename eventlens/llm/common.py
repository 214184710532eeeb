"""What the operators share: the shared folder, materialized frames, small Arrow helpers."""

from __future__ import annotations

import gc
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.llm import words as W


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which the driver and all executors see.

    Only a local master may run without that setting; it then gets a temporary folder.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local["):
                raise ValueError("spark.checkpoint.dir has to name a shared folder")
            folder = tempfile.mkdtemp(prefix="checkpoints-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


_shipped: set[str] = set()
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
USUAL_LIMIT, SMALL_LIMIT = "67108864b", "8388608b"


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors' Python, once per application.

    Arrow batches of texts are held twice, by the executor and by its Python worker, for each task. Where
    the session leaves their size at Spark's own value, it is set to 8 MB.
    """
    if spark.conf.get(BATCH_LIMIT) == USUAL_LIMIT:
        spark.conf.set(BATCH_LIMIT, SMALL_LIMIT)
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = shutil.make_archive(
            f"{tempfile.mkdtemp(prefix='package-')}/{package.name}", "zip", package.parent, package.name)
        sc.addPyFile(archive)
        _shipped.add(sc.applicationId)


def fresh(taken: list[str], *names: str) -> list[str]:
    """``names``, each made different from all ``taken`` column names."""
    used = {t.lower() for t in taken}
    out = []
    for name in names:
        while name.lower() in used:
            name = f"{name}_"
        used.add(name.lower())
        out.append(name)
    return out


def join_rows(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """``docs`` joined to rows of (doc_id, text_key, ...); null ids are equal to each other.

    ``text_key`` is ``xxhash64`` of the text, so that two texts under one id stay apart.
    """
    key, text = found.columns[:2]
    same = (docs["doc_id"].cast("bigint").eqNullSafe(found[key])
            & (F.xxhash64(docs["text"]) == found[text]))
    return docs.join(found, same, how)


def new_dir(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier call has returned."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Computes ``df`` once, into the shared folder, and cuts its lineage.

    Spark deletes shuffle files once the driver's garbage collector finds their frames out of reach,
    which a large heap may put off for hours; asking for a collection here frees the disk of
    earlier steps.
    """
    spark = df.sparkSession
    shared_dir(spark)
    done = df.checkpoint(eager=True)
    del df  # where the caller does not hold it, its shuffles go now
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return done


def arrow_map(
    df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str,
    text: int | None = None,
) -> DataFrame:
    """``mapInArrow`` for a function of one batch.

    ``text`` is the place of a text column; batches are then cut to few megabytes of text.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in [batch] if text is None else W.slices(batch, text):
                if part.num_rows and (out := fn(part)) is not None:
                    yield out

    return df.mapInArrow(run, schema)
