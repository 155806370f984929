"""Session factory and the shared plumbing of multi-stage operators."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession, functions as F

#: A side is broadcast only when its counted rows times its width stay below this.
BROADCAST_BYTES = 8 << 20


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerloom") -> SparkSession:
    """A single-machine session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str, widen: bool = False) -> DataFrame:
    """A table of the folder. widen spreads a scan of fewer partitions than cores, as a file of one row
    group gives, over all of them; a table large enough to fill the cores is read as it lies."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if widen and df.rdd.getNumPartitions() < cores else df


def settle(df: DataFrame) -> DataFrame:
    """Write df to the reliable checkpoint folder and cut its lineage.

    The folder is the one the cluster names in spark.checkpoint.dir. Only where that is
    unset, as in tests on one machine, is a temporary folder used.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir", None)
        if named is None and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by the executors")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="ledgerloom-"))
    return df.checkpoint(eager=True)


def join_checked(left: DataFrame, right: DataFrame, on, how: str, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Join with right broadcast if its measured size is below limit, else a shuffle join.

    Rows are counted and the widest row's texts, arrays and structs measured, with row_bytes as the least width of a row;
    no more rows are read than fit. right should be settled or cheap.
    """
    wide = [F.octet_length(f.name) if f.dataType.typeName() == "string" else F.length(F.to_json(F.struct(f.name))) for f in right.schema if f.dataType.typeName() in ("string", "array", "struct", "map")]
    width = F.max(sum((F.coalesce(w, F.lit(0)) for w in wide), F.lit(0))) if wide else F.lit(0)
    n, most = right.limit(limit // row_bytes + 1).agg(F.count("*"), width).first()
    if n * max(row_bytes, (most or 0) + 16 * len(right.columns)) <= limit:
        right = F.broadcast(right)
    return left.join(right, on, how)


def attach_groups(members: DataFrame, groups: DataFrame, key: list[str], size_col: str, hot: int = 1_000_000) -> DataFrame:
    """Inner join of members with their group's row, safe for groups that hold a large part of all rows.

    Groups of more than `hot` members are at most rows / hot in number; they are counted, broadcast,
    and their members leave the shuffle join. groups should be settled.
    """
    big = groups.filter(F.col(size_col) > hot)
    n = big.count()
    if n == 0:
        return members.join(groups, key)
    if n * 64 > BROADCAST_BYTES:
        return members.join(groups, key)  # so many that none dominates; AQE splits what is skewed
    big = F.broadcast(big)
    rest = members.join(F.broadcast(big.select(*key)), key, "left_anti").join(groups.filter(F.col(size_col) <= hot), key)
    return members.join(big, key).unionByName(rest)
