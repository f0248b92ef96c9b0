"""A feature matrix kept with the encoder that made it.

A save writes the matrix into a folder of its own and then a manifest: the matrix's place, schema and rows per class, and
the encoder's scales and categories. Readers look for the newest manifest that was written to its end, so a save is seen
whole or not at all, and a failed one leaves the last good one in place. Later batches are encoded from the manifest
alone, without the rows that the encoder was fitted on.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlens.functions.checks import require_columns
from txnlens.operators.encoding import FeatureConfig, FittedEncoder, fit_encoder

_DONE = "_SUCCESS"


@dataclass(frozen=True)
class SavedMatrix:
    """The wide matrix (target included) and its encoder."""

    matrix: DataFrame
    encoder: FittedEncoder
    #: Rows per class, as text.
    classes: dict[str, int]


def save_matrix(matrix: DataFrame, encoder: FittedEncoder, folder: str) -> SavedMatrix:
    """Write and publish; the target has to be there, with two classes and no gaps, and every feature column too."""
    require_columns(matrix, [encoder.target, *encoder.names])
    folder, spark = str(folder).rstrip("/"), matrix.sparkSession
    path = f"{folder}/matrix-{uuid.uuid4().hex}"
    matrix.write.parquet(path)
    written = spark.read.schema(matrix.schema).parquet(path)
    classes = {str(r[encoder.target]): r["count"] for r in written.groupBy(encoder.target).count().collect()}
    if set(classes) != {"0", "1"}:
        raise ValueError(f"the target {encoder.target} has to hold 0 and 1, found {sorted(classes)}")
    manifest = {"path": path, "schema": matrix.schema.jsonValue(), "classes": classes, "target": encoder.target,
                "scales": encoder.scales, "categories": encoder.categories}
    # Names sort by the number of earlier manifests, so the newest is the last.
    place = f"{folder}/manifests/{len(_manifests(spark, folder)):08d}-{uuid.uuid4().hex}"
    spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.text(place)
    return SavedMatrix(written, encoder, classes)


def _manifests(spark: SparkSession, folder: str) -> list[str]:
    """Finished manifests, oldest first."""
    context = spark.sparkContext
    pattern = context._jvm.org.apache.hadoop.fs.Path(f"{folder}/manifests/*/{_DONE}")
    found = pattern.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(pattern) or []
    return sorted(str(status.getPath().getParent().toString()) for status in found)


def load_matrix(spark: SparkSession, folder: str) -> SavedMatrix | None:
    """The newest published matrix, checked against its manifest; None when there is none."""
    manifests = _manifests(spark, str(folder).rstrip("/"))
    if not manifests:
        return None
    manifest = json.loads(spark.read.text(manifests[-1]).first()[0])
    encoder = FittedEncoder({c: tuple(s) for c, s in manifest["scales"].items()}, manifest["categories"], manifest["target"])
    schema = T.StructType.fromJson(manifest["schema"])
    if missing := [c for c in (encoder.target, *encoder.names) if c not in schema.names]:
        raise ValueError(f"the manifest {manifests[-1]} names columns its matrix has not: {missing}")
    matrix = spark.read.schema(schema).parquet(manifest["path"])
    rows = matrix.agg(F.count("*"), F.count(encoder.target)).first()
    if rows[0] != sum(manifest["classes"].values()) or rows[0] != rows[1]:
        raise ValueError(f"{manifest['path']} holds {rows[0]} rows with {rows[1]} labels, its manifest {manifest['classes']}")
    return SavedMatrix(matrix, encoder, manifest["classes"])


def load_or_build_matrix(spark: SparkSession, folder: str, build: Callable[[], DataFrame], *, keep: tuple[str, ...] = ("event_id",),
                         config: FeatureConfig = FeatureConfig()) -> SavedMatrix:
    """The published matrix, or one fitted on the engineered table that ``build`` gives, saved before it is used."""
    saved = load_matrix(spark, folder)
    if saved is not None:
        return saved
    engineered = build()
    encoder = fit_encoder(engineered, config)
    return save_matrix(encoder.wide(engineered, keep=keep), encoder, folder)
