"""Helpers the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapworks.llm import words
from lapworks.session import ensure_checkpoint_dir, ship_package, shuffle_partitions

NULL_ID = words.NULL_ID
BATCH_ROWS = 2000        # documents of an Arrow batch at most: a worker holds a few MB of text at a time


def prepare(spark: SparkSession) -> None:
    """Checkpoint folder known, package shipped to the Python workers, Arrow batches of
    texts small (unless the session asks for smaller ones)."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame) -> DataFrame:
    """A narrow intermediate result, once, in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def id_in(col: str) -> Column:
    """Ids as the operators use them: long, null as the smallest long."""
    return F.coalesce(F.col(col).cast("long"), F.lit(NULL_ID))


def id_out(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c != NULL_ID, c)


def doc_key(id_col: str, text_col: str) -> Column:
    """The id, or for a null one a number from 2**62 on, drawn from the text: rows
    without id are one document per distinct text, after those with (small) ids."""
    drawn = F.lit(1 << 62) + F.call_function("shiftrightunsigned", F.xxhash64(text_col), F.lit(2))
    return F.coalesce(F.col(id_col).cast("long"), drawn)


def position(df: DataFrame, keys: list[str], order: list[str], out: str, salt: Column) -> DataFrame:
    """Gapless number from 0 of each row among those of its ``keys``.

    Rows of a key are dealt into ``salt`` buckets; a bucket is numbered by itself and
    shifted by the rows of the key's earlier buckets, so a key that holds a third of
    all rows is never in one task.  Bucket and place come from the row alone: reruns
    agree (rows equal in ``order`` are interchangeable).
    """
    n = max(64, 2 * shuffle_partitions(df.sparkSession))
    df = df.withColumn("_b", F.pmod(salt, F.lit(n)).cast("int"))
    sizes = df.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(*keys, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_s"))
    local = df.withColumn(out, F.row_number().over(Window.partitionBy(*keys, "_b").orderBy(*order)) - 1)
    cond = [local[k].eqNullSafe(shifts[k]) for k in [*keys, "_b"]]
    joined = local.join(shifts, cond)
    return joined.select(*[local[c] for c in df.columns if c != "_b"],
                         (local[out] + shifts["_s"]).cast("long").alias(out))


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """Connected components of ``edges(a, b)`` (long ids): ``(id, component)`` for each
    id of an edge, component being its smallest id.

    Alternating large-star / small-star rounds; each is a partial aggregate and a join
    (a hot centre is pre-aggregated, its join split by AQE) and is checkpointed, so
    lineage stays short and a lost executor costs one round.
    """
    spark = edges.sparkSession
    e = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .distinct())
    for _ in range(max_rounds):
        # done when every id hangs on one smaller id that hangs on none
        twice = e.groupBy("u").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("u")
        chained = e.select(F.col("v").alias("u")).join(e.select("u"), "u", "left_semi")
        if twice.unionByName(chained).isEmpty():
            break
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: the larger neighbours of u are linked to the least of u's neighbourhood
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: u and its smaller neighbours are linked to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("s")).select("s.u", "s.v")
        e = materialize(small.filter("u <> v").distinct())
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
