"""Java sources of this folder as JVM objects: compiled by Janino, which Spark itself compiles its plans with, and given to
the executors as a jar. Needs no Java compiler."""

from __future__ import annotations

import atexit
import importlib.resources
import os
import shutil
import tempfile
import zipfile

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import types as T
from pyspark.sql.classic.column import _to_java_column

_made: dict[tuple[str, str], object] = {}


def instance(sc: SparkContext, name: str):
    """An object of the class ``name``, compiled once per application."""
    key = sc.applicationId, name
    if key not in _made:
        source = importlib.resources.files(__package__).joinpath(f"{name}.java").read_text("utf-8")
        compiler = sc._jvm.org.codehaus.janino.SimpleCompiler()
        compiler.cook(f"{name}.java", sc._jvm.java.io.StringReader(source))
        work = os.path.realpath(tempfile.mkdtemp(prefix="linkforge-jar-"))
        atexit.register(shutil.rmtree, work, True)
        # the name tells applications apart: executors keep jars by it
        path = os.path.join(work, f"linkforge-{name}-{key[0]}.jar")
        with zipfile.ZipFile(path, "w") as jar:
            for c, code in compiler.getBytecodes().items():
                jar.writestr(f"{c.replace('.', '/')}.class", bytes(code))
        sc._jsc.addJar(path)
        _made[key] = compiler.getClassLoader().loadClass(name).getDeclaredConstructor(sc._gateway.new_array(sc._jvm.java.lang.Class, 0)).newInstance(sc._gateway.new_array(sc._jvm.java.lang.Object, 0))
    return _made[key]


def call(name: str, kind: T.DataType, settings: tuple, *columns: Column) -> Column:
    """A function of the class ``name`` with these settings, applied to columns; ``kind`` is the type of its results."""
    sc = SparkContext._active_spark_context
    jvm = sc._jvm
    udf = instance(sc, name).function(jvm.org.apache.spark.sql.types.DataType.fromJson(kind.json()), *settings)
    return Column(udf.apply(jvm.PythonUtils.toSeq([_to_java_column(c) for c in columns])))
