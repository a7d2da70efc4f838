"""Table schema kept next to the data (``_table_schema.json`` at the table
root; names starting with ``_`` are skipped by Spark's file listing).

Writers publish the union schema before their data, so a reader never misses a
column of a table whose writer died in between: a column without files yet
reads as NULL. A column whose type would change is refused. Readers pass the
schema to ``spark.read.schema(...)``, so a read never merges footers across
the whole table, and files written before a column was added read it as NULL
(additive evolution). The file is replaced by one atomic rename. Tables without
it fall back to ``mergeSchema``. One writer per table, as for the data itself.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import types as T

SCHEMA_FILE = "_table_schema.json"


def _path(spark: SparkSession, root: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{SCHEMA_FILE}")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def read_table_schema(spark: SparkSession, root: str) -> T.StructType | None:
    fs, p = _path(spark, root)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        reader = spark.sparkContext._jvm.java.io.BufferedReader(
            spark.sparkContext._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        text = "".join(iter(reader.readLine, None))
    finally:
        stream.close()
    return T.StructType.fromJson(json.loads(text))


class SchemaConflict(ValueError):
    """A column would change its type."""


def merge_schemas(old: T.StructType | None, new: T.StructType) -> T.StructType:
    """Union by name: existing fields keep their position and type, new
    fields are appended (all nullable). A type change raises."""
    fields = list(old.fields) if old is not None else []
    known = {f.name: f.dataType.simpleString() for f in fields}
    for f in new.fields:
        if f.name not in known:
            fields.append(T.StructField(f.name, f.dataType, True))
            known[f.name] = f.dataType.simpleString()
        elif known[f.name] != f.dataType.simpleString():
            raise SchemaConflict(f"column {f.name}: the table has {known[f.name]}, "
                                 f"the data {f.dataType.simpleString()}")
    return T.StructType(fields)


def check_schema(spark: SparkSession, root: str, schema: T.StructType) -> None:
    """Raises if ``schema`` can't be published into the table at ``root``."""
    merge_schemas(read_table_schema(spark, root), schema)


def update_table_schema(spark: SparkSession, root: str, schema: T.StructType) -> T.StructType:
    merged = merge_schemas(read_table_schema(spark, root), schema)
    fs, p = _path(spark, root)
    jvm = spark.sparkContext._jvm
    tmp = jvm.org.apache.hadoop.fs.Path(str(p.toString()) + ".tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(json.dumps(merged.jsonValue()).encode("utf-8")))
    out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        p.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(tmp, p, options)
    return merged
