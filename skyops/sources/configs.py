"""Configuration trees as node tables: one row per node of every document.

A node is (env, path array<string>, kind dict|list|scalar|null, value JSON text); the root has
the empty path.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyops.schemas import CONFIG_NODES

try:
    import yaml
except ImportError:  # JSON documents need none; a YAML document is then refused
    yaml = None

_NODE = "path array<string>, kind string, value string"
#: Nodes of a slice.
_SLICE = 20_000


def _load(text: str):
    """The mapping of a document: JSON if it begins with a brace and is, else YAML."""
    data, parsed = None, False
    if text.lstrip().startswith("{"):
        try:
            data, parsed = json.loads(text), True
        except ValueError:
            pass  # a flow mapping of YAML
    if not parsed and text.strip():
        if yaml is None:
            raise RuntimeError("PyYAML is needed to read YAML documents")
        data = yaml.load(text, getattr(yaml, "CSafeLoader", yaml.SafeLoader))
    if data is None:
        return {}
    if not isinstance(data, dict):
        raise ValueError(f"expected a mapping at the top level, got {type(data).__name__}")
    return data


def _walk(path: list[str], value) -> Iterator[tuple]:
    if isinstance(value, dict):
        yield path, "dict", None
        for key, child in value.items():
            yield from _walk([*path, str(key)], child)
    elif isinstance(value, list):
        yield path, "list", json.dumps(value, default=str, ensure_ascii=False)
    elif value is None:
        yield path, "null", "null"
    else:
        yield path, "scalar", json.dumps(value, default=str, ensure_ascii=False)


@F.udtf(returnType=_NODE, useArrow=True)
class ConfigNodes:
    """``config_nodes(text)``, for SQL: the nodes of one YAML or JSON document. ``nodes_of`` takes batches."""

    def eval(self, text: str):
        yield from _walk([], _load(text))


def nodes_of(documents: DataFrame, text: str = "value") -> DataFrame:
    """The nodes of the documents in a text column; the other columns stay.

    Documents are parsed an Arrow batch at a time, and their nodes leave in slices of bounded length.
    """
    rest = [f for f in documents.schema.fields if f.name != text]
    schema = StructType([*rest, *StructType.fromDDL(_NODE).fields])
    names = [f.name for f in rest]

    def sliced(b, at, nodes):
        columns = [b.column(n).take(pa.array(at, pa.int32())) for n in names]
        parts = list(zip(*nodes, strict=True))
        kinds = [pa.list_(pa.string()), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([*columns, *(pa.array(list(c), k) for c, k in zip(parts, kinds, strict=True))],
                                          names=[*names, "path", "kind", "value"])

    def run(batches):
        for b in batches:
            at, nodes = [], []
            for i, t in enumerate(b.column(text).to_pylist()):
                for node in _walk([], _load(t or "")):
                    at.append(i)
                    nodes.append(node)
                    if len(at) == _SLICE:
                        yield sliced(b, at, nodes)
                        at, nodes = [], []
            if at:
                yield sliced(b, at, nodes)

    return documents.select(*names, text).mapInArrow(run, schema)


def read_config_nodes(spark: SparkSession, path: str, glob: str = "*.yaml") -> DataFrame:
    """All documents of a folder; the environment is the file name without its suffix, or that of an ``env=`` folder.

    Spark skips files of no bytes, so those are listed and added as trees with a root only.
    """
    stem = F.regexp_extract("path", r"([^/]*)\.[^./]*$", 1)
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    name = F.col("env").cast("string") if "env" in files.columns else stem
    nodes = nodes_of(files.select(name.alias("env"), F.decode("content", "UTF-8").alias("value")))
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{glob}")
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    empty = [(f.getPath().getName().rsplit(".", 1)[0], [], "dict", None)
             for f in fs.globStatus(fs_path) or [] if f.isFile() and f.getLen() == 0]
    if not empty:
        return nodes
    return nodes.unionByName(spark.createDataFrame(empty, CONFIG_NODES))


def write_packs(documents: DataFrame, path: str) -> None:
    """Documents (env, value) as lines of JSON, many to a file: hundreds of thousands of files cost more than their text."""
    documents.select("env", "value").write.json(path)


def read_packed_nodes(spark: SparkSession, path: str) -> DataFrame:
    """``read_config_nodes`` for a folder of ``write_packs``; its files are split, so their number and size do not matter."""
    return nodes_of(spark.read.schema("env string, value string").json(path))


def parents_of(nodes: DataFrame, key: str = "inherits") -> tuple[DataFrame, DataFrame]:
    """(env, parent) pointers, and the nodes without the pointer itself."""
    pointer = (F.size("path") == 1) & (F.col("path")[0] == key)
    parents = nodes.filter(pointer & (F.col("kind") != "null")).select(
        "env", F.get_json_object(F.concat(F.lit('{"v":'), "value", F.lit("}")), "$.v")
        .alias("parent"))
    return parents, nodes.filter(~pointer)


def read_snapshots(spark: SparkSession, path: str, glob: str = "*.yaml", packed: bool = False) -> DataFrame:
    """Installed packages of stored snapshots: (snapshot, host, package, version, source).

    A folder has a file for each snapshot, or is ``packed`` by ``write_packs``.
    """
    return snapshot_packages(read_packed_nodes(spark, path) if packed else read_config_nodes(spark, path, glob))


def snapshot_packages(nodes: DataFrame) -> DataFrame:
    """A snapshot lists its packages as one node; the host name sits beside it."""
    at = F.element_at("path", 1)
    top = nodes.filter((F.size("path") == 1) & at.isin("hostname", "packages"))
    wide = top.groupBy("env").agg(
        F.max(F.when(at == "hostname", F.col("value"))).alias("_host"),
        F.max(F.when(at == "packages", F.col("value"))).alias("_packages"))
    entry = "array<struct<name:string,version:string,source:string>>"
    return wide.select(
        F.col("env").alias("snapshot"),
        F.get_json_object(F.concat(F.lit('{"v":'), "_host", F.lit("}")), "$.v").alias("host"),
        F.explode(F.from_json("_packages", entry)).alias("_p"),
    ).select("snapshot", "host", F.col("_p.name").alias("package"),
             F.col("_p.version").alias("version"),
             F.coalesce("_p.source", F.lit("pip")).alias("source"))
