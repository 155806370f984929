"""Readers and writers of the file formats around the catalog."""

from __future__ import annotations

import json
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

Schema = StructType | str


def read_jsonl(spark: SparkSession, path: str, schema: Schema) -> DataFrame:
    """One object per line; a line that isn't JSON becomes a row of nulls."""
    return spark.read.schema(schema).json(path)


def read_json_array(spark: SparkSession, path: str, schema: Schema) -> DataFrame:
    """A file that holds one array of objects."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_csv(spark: SparkSession, path: str, schema: Schema) -> DataFrame:
    """Quoted CSV with a header; an empty field of a string column stays empty, of any other type it is null."""
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').option("nullValue", "\u0000").option("emptyValue", "").csv(path)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """(ticker, name) by position: the first two columns of a CSV, whatever its header says."""
    raw = spark.read.option("header", True).option("escape", '"').csv(path)
    first, second = raw.columns[:2]
    return raw.select(F.col(f"`{first}`").alias("ticker"), F.col(f"`{second}`").alias("name"))


def read_rankings(spark: SparkSession, path: str) -> DataFrame:
    """{question: [[key, score], ...]} files as (query_id, rank, doc_id, score)."""
    text = spark.read.text(path, wholetext=True)
    pairs = F.from_json("value", "map<string,array<array<string>>>")
    q = text.select(F.explode(pairs).alias("query_id", "l")).select("query_id", F.posexplode("l").alias("i", "e"))
    return q.select("query_id", (F.col("i") + 1).alias("rank"), F.get("e", F.lit(0)).alias("doc_id"), F.get("e", F.lit(1)).cast("double").alias("score"))


def write_catalog(tables: DataFrame, path: str, buckets: str = "ticker") -> None:
    """Catalog as Parquet, one folder per ticker so that a scoped search reads only its own."""
    tables.write.mode("overwrite").partitionBy(buckets).parquet(path)


def write_rows(df: DataFrame, path: str, kind: str = "json") -> None:
    """A folder of JSON lines or CSV parts; arrays and structs go into CSV as JSON text."""
    if kind == "csv":
        nested = [f.name for f in df.schema if f.dataType.typeName() in ("array", "struct", "map")]
        df = df.withColumns({c: F.to_json(c) for c in nested})
        df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    else:
        df.write.mode("overwrite").json(path)


def write_single_json(df: DataFrame, path: str, order: list[str], most: int = 1_000_000) -> int:
    """One JSON array file, replaced as a whole; for deliverables of at most `most` rows. Returns the rows."""
    if df.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows are no single file")
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    fd, temp = tempfile.mkstemp(dir=target.parent, suffix=".tmp")
    n = 0
    with os.fdopen(fd, "w", encoding="utf-8") as out:
        out.write("[")
        for row in df.orderBy(*order).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j")).toLocalIterator():
            out.write((",\n" if n else "\n") + row.j)
            n += 1
        out.write("\n]\n")
    os.replace(temp, target)
    return n


def zip_package(json_path: str, evidence: str, out: str) -> list[str]:
    """A package of one JSON file and the CSV parts below a folder; returns the names inside."""
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.write(json_path, Path(json_path).name)
        for p in sorted(Path(evidence).rglob("*.csv")):
            z.write(p, f"data/{p.relative_to(evidence)}")
        return z.namelist()


def fingerprint(df: DataFrame, cols: list[str]) -> str:
    """Content fingerprint of rows without regard to order, to tell whether a stored result is stale."""
    h = F.xxhash64(*cols)
    r = df.agg(F.count("*").alias("n"), F.sum(h.cast("decimal(38,0)")).alias("s"), F.bit_xor(h).alias("x")).first()
    return json.dumps([r.n, str(r.s), r.x])
