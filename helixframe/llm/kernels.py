"""Loops in Java over rows, inside the executors' JVMs: compiled once a session by the compiler that Spark itself uses."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession


def _loaded(spark: SparkSession):
    """LmKernels on the driver; a jar of it goes to the executors as Spark's files do."""
    context = spark.sparkContext
    if (found := getattr(context, "_helixframe_kernels", None)) is not None:
        return found
    jvm = context._jvm
    compiler = jvm.org.codehaus.janino.SimpleCompiler()
    compiler.setParentClassLoader(jvm.org.apache.spark.util.Utils.getContextOrSparkClassLoader())
    compiler.cook("LmKernels.java", jvm.java.io.StringReader(Path(__file__).with_name("LmKernels.java").read_text()))
    path = os.path.join(tempfile.mkdtemp(prefix="helixframe-"), "helixframe_kernels.jar")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, code in compiler.getBytecodes().items():
            z.writestr(f"{name.replace('.', '/')}.class", bytes(code))
    context._jsc.addJar(path)
    context._helixframe_kernels = compiler.getClassLoader().loadClass("helixframe.LmKernels")
    return context._helixframe_kernels


def map_java(df: DataFrame, kernel: str, arrays: dict[str, np.ndarray | bytes], schema: str) -> DataFrame:
    """Run a kernel of LmKernels over the rows of each partition. arrays: what it reads besides, little-endian, sent along with the tasks."""
    spark = df.sparkSession
    run = _loaded(spark).newInstance()
    run.kernel(kernel)
    for name, a in arrays.items():
        run.put(name, bytearray(a if isinstance(a, bytes) else np.ascontiguousarray(a).tobytes()))
    jvm = spark.sparkContext._jvm
    return DataFrame(df._jdf.mapPartitions(run, jvm.org.apache.spark.sql.Encoders.row(jvm.org.apache.spark.sql.types.StructType.fromDDL(schema))), spark)
