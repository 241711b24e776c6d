"""Session settings the operators rely on."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def prepare(spark: SparkSession) -> SparkSession:
    """Timestamps are UTC wall clock; adaptive execution sizes joins and shuffles."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    ship_package(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let executors import this package: Spark hands a zip of it to every worker, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    stage = Path(tempfile.mkdtemp(prefix="panelcast-"))
    shutil.copytree(package, stage / "src" / package.name, ignore=shutil.ignore_patterns("__pycache__"))
    archive = shutil.make_archive(str(stage / package.name), "zip", stage / "src")
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


_compiled: dict[tuple[str, str], object] = {}


def java_class(spark: SparkSession, source: Path, name: str):
    """A class of this package, compiled by Spark's own compiler and sent to executors as a jar, once per application.

    None where it can't be compiled, as without ``jdk.incubator.vector``, which Spark adds to its JVMs by itself.
    """
    context = spark.sparkContext
    key = context.applicationId, name
    if key not in _compiled:
        compiler = context._jvm.org.codehaus.janino.SimpleCompiler()
        try:
            compiler.cook(source.read_text())
        except Py4JJavaError:
            _compiled[key] = None
            return None
        jar = Path(tempfile.mkdtemp(prefix="panelcast-")) / f"{source.stem}-{uuid.uuid4().hex}.jar"
        with zipfile.ZipFile(jar, "w") as z:
            classes = compiler.getBytecodes()
            for c in classes:
                z.writestr(f"{c.replace('.', '/')}.class", bytes(classes[c]))
        context._jsc.addJar(str(jar))
        _compiled[key] = compiler.getClassLoader().loadClass(name)
    return _compiled[key]


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path for intermediate files below the cluster's checkpoint folder.

    The folder comes from the session.  Only a local[...] session without that
    setting falls back to a temporary folder, since there every task sees it.
    """
    base = spark.sparkContext.getConf().get(CHECKPOINT_KEY) or spark.conf.get(CHECKPOINT_KEY, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="panelcast-")
    return os.path.join(base, f"{purpose}-{uuid.uuid4().hex}")
