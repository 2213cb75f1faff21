"""Loops over packed rows on the JVM: ``trees.java``, compiled by the compiler that Spark brings along for its own plans.

The classes go to the executors as a jar, as ``SparkContext.addJar`` sends one; each is a function over the rows of a partition.
"""

from __future__ import annotations

import os
import tempfile
import threading
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import _parse_datatype_string

SOURCE = os.path.join(os.path.dirname(os.path.abspath(__file__)), "trees.java")
_loaders: dict[str, object] = {}
_one = threading.Lock()


def _loader(spark: SparkSession):
    """A class loader of the driver that has the classes; the first call of an application compiles and sends them."""
    context = spark.sparkContext
    with _one:
        if context.applicationId not in _loaders:
            jvm, gateway = context._jvm, context._gateway
            parent = context._jsc.sc().getClass().getClassLoader()
            compiler = jvm.org.codehaus.janino.SimpleCompiler()
            compiler.setParentClassLoader(parent)
            with open(SOURCE, encoding="utf-8") as source:
                compiler.cook(source.read())
            found = compiler.getBytecodes()
            path = os.path.join(tempfile.mkdtemp(prefix="plumbline-jar-"), f"trees-{context.applicationId}.jar")
            with zipfile.ZipFile(path, "w") as jar:
                for name in list(found.keySet()):
                    jar.writestr(f"{name.replace('.', '/')}.class", bytes(found.get(name)))
            context._jsc.sc().addJar(path)
            urls = gateway.new_array(jvm.java.net.URL, 1)
            urls[0] = jvm.java.io.File(path).toURI().toURL()
            _loaders[context.applicationId] = jvm.java.net.URLClassLoader(urls, parent)
        return _loaders[context.applicationId]


def over_partitions(df: DataFrame, name: str, ddl: str, plan: bytes, *numbers: int) -> DataFrame:
    """The rows that the function ``name`` makes of each partition, given its plan and some numbers."""
    spark = df.sparkSession
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    kinds = gateway.new_array(jvm.java.lang.Class, 1 + len(numbers))
    values = gateway.new_array(jvm.java.lang.Object, 1 + len(numbers))
    kinds[0], values[0] = jvm.java.lang.Class.forName("[B"), plan
    for i, n in enumerate(numbers, 1):
        kinds[i], values[i] = jvm.java.lang.Integer.TYPE, int(n)
    function = jvm.java.lang.Class.forName(f"plumbline.{name}", True, _loader(spark)).getConstructor(kinds).newInstance(values)
    schema = spark._jsparkSession.parseDataType(_parse_datatype_string(ddl).json())
    return DataFrame(df._jdf.mapPartitions(function, jvm.org.apache.spark.sql.Encoders.row(schema)), spark)
