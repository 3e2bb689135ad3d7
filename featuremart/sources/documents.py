"""JSON documents whose layout differs from file to file, by way of VARIANT values.

No schema is inferred: each document is parsed once into a VARIANT and stored, and its
leaves are listed from there.  So a field that is a number in one file and an object in
the next keeps its own type in both.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.session import materialise
from featuremart.sources.tables import nothing_there, parent_folder

#: Types of leaves by the head of a VARIANT's schema, in the order of conflicting columns.
KINDS = {"BIGINT": "bigint", "DECIMAL": "double", "DOUBLE": "double", "FLOAT": "double", "BOOLEAN": "boolean",
         "STRING": "string", "ARRAY": "json", "VOID": "void"}
_NAME = "`([^`]|``)*`"


def read_documents(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """``file, folder, document`` of every file at any depth; one JSON document a file.

    The document is NULL where the file does not hold valid JSON; a file of no bytes has
    no row.  The files are read
    and parsed here, once; what follows reads the stored values.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    try:
        texts = reader.text(path, wholetext=True)
    except AnalysisException as error:
        if not nothing_there(error):
            raise
        raise FileNotFoundError(f"no {pattern} files under {path}") from error
    return materialise(texts.select(
        F.url_decode(F.col("_metadata.file_path")).alias("file"), parent_folder().alias("folder"),
        F.try_parse_json("value").alias("document")), "documents")


def head(value: str | Column) -> Column:
    """First word of a VARIANT's schema: OBJECT, ARRAY or the type of a plain value."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def unreadable(documents: DataFrame) -> DataFrame:
    """``file, reason`` of the files that hold no JSON object."""
    return documents.where(F.col("document").isNull() | (head("document") != "OBJECT")).select(
        "file", F.when(F.col("document").isNull(), "not valid JSON").otherwise("not an object").alias("reason"))


def object_depth(value: str | Column) -> Column:
    """Levels of brackets in a VARIANT's schema, those within arrays included."""
    brackets = F.regexp_replace(F.regexp_replace(F.schema_of_variant(value), _NAME, ""), "[^<>]", "")
    levels = F.aggregate(
        F.split(brackets, ""), F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")),
        lambda at, mark: F.struct(
            (at["now"] + F.when(mark == "<", 1).when(mark == ">", -1).otherwise(0)).alias("now"),
            F.greatest(at["most"], at["now"] + F.when(mark == "<", 1).otherwise(0)).alias("most")))
    return levels["most"]


def leaves(documents: DataFrame, keys: tuple[str, ...] = ("file", "folder")) -> DataFrame:
    """``keys, path, kind, value``: one row for every value of every document that is no object.

    The path is the array of the names that lead there.  Arrays are leaves, empty objects
    have none, and documents that aren't objects are left out.  Objects are opened level
    by level, as many times as the deepest document needs; the only figure that the
    driver learns is that depth.
    """
    depth = documents.agg(F.max(object_depth("document"))).first()[0] or 0
    names = ", ".join(f"`{k}`" for k in keys)
    level = documents.where(head("document") == "OBJECT").select(
        *keys, F.array().cast("array<string>").alias("path"), F.col("document").alias("value"))
    found = None
    for _ in range(depth):
        opened = documents.sparkSession.sql(
            f"SELECT {names}, array_append(path, v.key) AS path, v.value AS value "
            "FROM {level}, LATERAL variant_explode({level}.value) AS v", level=level)
        opened = opened.withColumn("head", head("value"))
        ready = opened.where("head <> 'OBJECT'")
        found = ready if found is None else found.unionByName(ready)
        level = opened.where("head = 'OBJECT'").drop("head")
    if found is None:
        found = level.withColumn("head", F.lit("VOID"))
    kind = F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])[F.col("head")]
    return found.select(*keys, "path", F.coalesce(kind, F.lit("json")).alias("kind"), "value")


def flattened(documents: DataFrame, keys: tuple[str, ...] = ("file", "folder")) -> DataFrame:
    """One row per document with a typed column ``a.b.c`` for every leaf path of any document.

    Whole and other numbers of a path share a double column.  A path with values of
    several types has a column for each, ``path:type``.  Arrays are JSON text; a path
    that only holds null is a text column.  ``keys`` tell documents apart; their columns
    come first, and a path of the same name is left out.
    """
    listed = materialise(leaves(documents, keys), "leaves")
    layout: dict[tuple[str, ...], set[str]] = {}
    for row in listed.select("path", "kind").distinct().collect():  # as many as the result has columns
        layout.setdefault(tuple(row["path"]), set()).add(row["kind"])
    columns: list[Column] = []
    taken = set(keys)
    for path in sorted(layout):
        kinds = layout[path] - {"void"}
        if "double" in kinds:
            kinds -= {"bigint"}
        name = ".".join(path)
        if name in taken:
            continue
        taken.add(name)
        at = F.col("path") == F.array(*[F.lit(p) for p in path])
        for kind in sorted(kinds) or ["string"]:
            whole = {"double": ["double", "bigint"]}.get(kind, [kind])
            value = F.to_json("value") if kind == "json" else F.try_variant_get("value", "$", kind)
            columns.append(F.first(F.when(at & F.col("kind").isin(whole), value), ignorenulls=True).alias(
                name if len(kinds) < 2 else f"{name}:{kind}"))
    rows = documents.where(head("document") == "OBJECT").select(*keys)
    if not columns:
        return rows
    wide = listed.groupBy(*keys).agg(*columns)
    return rows.join(wide, list(keys), "left")


def read_varied_summaries(
    spark: SparkSession, path: str, pattern: str = "*.json", time_column: str = "evaluation_time",
) -> tuple[DataFrame, DataFrame]:
    """Summary documents of any layout as flat rows, and ``file, reason`` of the files that were skipped.

    The folder's name is the model version.  The time column, where there is one, is parsed;
    what does not parse is NULL.
    """
    documents = read_documents(spark, path, pattern)
    flat = flattened(documents.withColumnRenamed("folder", "model_version"), ("file", "model_version")).drop("file")
    if time_column in flat.columns:
        flat = flat.withColumn(time_column, F.try_to_timestamp(F.col(time_column).cast("string")))
    return flat, unreadable(documents)
