"""Session helpers: where intermediate tables go and how lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def shared_folder(spark: SparkSession) -> str:
    """Folder for cut lineage: ``spark.checkpoint.dir``, else the context's checkpoint folder.

    A local session without either gets a temporary folder. A cluster session without either is an error,
    because a folder on one machine is lost with that machine.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running iterative operators")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="grantflow-"))
    return context.getCheckpointDir()


def literal_table(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """A small table of constants as a local relation, so its size is known to the optimizer."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(schema)
    columns = [pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), schema)


class Table(NamedTuple):
    """A table written to the shared folder."""

    df: DataFrame
    path: str
    rows: int


def _written(df: DataFrame) -> tuple[DataFrame, str]:
    path = f"{shared_folder(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def cut_table(df: DataFrame) -> Table:
    """Write ``df`` once to the shared folder and read it back.

    The plan behind ``df`` is not kept, the table survives lost executors, and its true size is known to the
    next join. Unlike ``checkpoint()`` the rows are computed only once and stay columnar. They are counted as they are
    written, without a job of its own.
    """
    counted = Observation()
    back, path = _written(df.observe(counted, F.count(F.lit(1)).alias("rows")))
    return Table(back, path, counted.get["rows"])


def cut(df: DataFrame) -> DataFrame:
    return _written(df)[0]


def gather(parts: list[Table]) -> DataFrame:
    """One scan over several written tables with the same columns."""
    first = parts[0].df
    return first.sparkSession.read.schema(first.schema).parquet(*[p.path for p in parts])
