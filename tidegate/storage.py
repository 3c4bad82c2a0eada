"""Where things lie: layer roots, artefacts, and staged tables in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.spec import SPEC_FILE, SQL_FILE, JobSpec, parse_spec


@dataclass(frozen=True)
class Lake:
    """Root paths of a data lake.  ``CSV`` and ``SOR`` jobs share one target root."""

    landing: str
    layers: Mapping[str, str]
    outcomes: str
    ledger: str
    artefacts: str

    @classmethod
    def under(cls, root: str) -> Lake:
        root = root.rstrip("/")
        return cls(
            landing=f"{root}/landing",
            layers={
                "CSV": f"{root}/sor",
                "SOR": f"{root}/sor",
                "SOT": f"{root}/sot",
                "SPEC": f"{root}/spec",
            },
            outcomes=f"{root}/outcomes",
            ledger=f"{root}/ledger",
            artefacts=f"{root}/artefacts",
        )

    def target(self, layer: str, table: str) -> str:
        return f"{self.layers[layer]}/{table}"

    def landing_file(self, table: str, file_name: str) -> str:
        return f"{self.landing}/{table}/{file_name}"


def load_spec(spark: SparkSession, lake: Lake, table: str) -> JobSpec:
    return parse_spec(_small_text(spark, f"{lake.artefacts}/{table}/{SPEC_FILE}"))


def load_sql(spark: SparkSession, lake: Lake, table: str) -> str:
    return _small_text(spark, f"{lake.artefacts}/{table}/{SQL_FILE}")


def _small_text(spark: SparkSession, path: str) -> str:
    """One artefact file, read through Spark so that any file system the session knows will do."""
    return spark.read.text(path, wholetext=True).first()[0]


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it.

    Only a local session may go without the setting; it then gets a new temporary folder, once.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidegate-"))
    return spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/tidegate/{label}-{uuid.uuid4().hex}"


@dataclass(frozen=True)
class Staged:
    """A DataFrame written once as a table of its own.

    Reading it again costs a column-pruned scan instead of the whole lineage, and a lost executor
    costs nothing, because no block of it lives in an executor.
    """

    frame: DataFrame
    path: str

    def release(self) -> None:
        """Drop the staged files.  The path was made by ``stage`` and is used by this run alone."""
        spark = self.frame.sparkSession
        target = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def stage(df: DataFrame, label: str) -> Staged:
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return Staged(spark.read.schema(df.schema).parquet(path), path)


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, with a schema, and no Python worker to make them."""
    return spark.range(0).select([F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def path_has_files(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return bool(system.exists(target))
