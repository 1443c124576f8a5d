"""Merkle manifest of a dataset by sibling-shift self-joins.

Rows are numbered without gaps inside their group; a node is ``(group, index, digest)``.
At every level the slot-zero node of a run computes its siblings' indices by slot offsets
(for a fanout of two that is the index XOR 1), an equijoin on (group, index) fetches their
digests, and the slot-zero rows emit the parents.  The same runs, handed down from the
root, give every leaf the siblings that fold it up to the root.

All joins but one are on (group, run index), so a group that holds most rows spreads as
evenly as any other; a level has a sixteenth of the rows of the one below.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapworks.llm.common import materialize, prepare, table
from lapworks.session import shuffle_partitions

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_ROW_BITS = 33               # of monotonically_increasing_id: the row inside its partition


def field(c: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def row_digest(values: list[Column]) -> Column:
    """SHA-256 (32 bytes) over the fields of a row."""
    return F.unhex(F.sha2(F.concat(*[field(c) for c in values]), 256))


def _hex(c: Column) -> Column:
    return F.lower(F.hex(c))


def _joined(digests: Column) -> Column:
    return F.array_join(F.transform(digests, _hex), "")


def numbered(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``df`` with ``_i``, the gapless index from 0 of each row in its ``group`` by
    ``order`` (nulls first), ``_n``, the rows of the group, and ``_s``, the rank from 0 of
    the group among all (null first).

    Rows are range-partitioned and sorted once and written down, so there is one
    assignment of rows to ranges whatever is recomputed; a range knows its rows by
    group, and the earlier ranges' rows shift them.  No task holds a group.
    """
    n = shuffle_partitions(df.sparkSession)
    by = [F.col(c).asc_nulls_first() for c in (group, *order)]
    rows = materialize(df.repartitionByRange(n, *by).sortWithinPartitions(*by)
                       .withColumn("_m", F.monotonically_increasing_id())) \
        .withColumn("_p", F.shiftright("_m", _ROW_BITS))
    # one row per range and group: at most ranges + groups
    parts = materialize(rows.groupBy("_p", group).agg(F.min("_m").alias("_first"), F.count(F.lit(1)).alias("_c")))
    inside = Window.partitionBy(group).orderBy("_p")
    parts = parts.withColumns({
        "_before": F.coalesce(F.sum("_c").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_n": F.sum("_c").over(Window.partitionBy(group))})
    # groups in order of their first rows: a range's groups are ranked by themselves and
    # shifted by the groups that begin in earlier ranges (one row per range)
    begins = parts.filter("_before = 0")
    per_range = begins.groupBy("_p").agg(F.count(F.lit(1)).alias("_g"))
    shift = per_range.select(F.col("_p"), F.coalesce(F.sum("_g").over(
        Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_shift"))
    ranks = begins.withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy("_first")) - 1) \
        .join(shift, "_p").select(F.col(group).alias("_grp"), (F.col("_r") + F.col("_shift")).alias("_s"))
    parts = parts.join(ranks, parts[group].eqNullSafe(ranks["_grp"])) \
        .select(F.col("_p").alias("_pp"), "_grp", "_first", "_before", "_n", "_s")
    met = rows.join(parts, (rows["_p"] == parts["_pp"]) & rows[group].eqNullSafe(parts["_grp"]))
    return met.select(*[rows[c] for c in df.columns], (F.col("_m") - F.col("_first") + F.col("_before")).alias("_i"),
                      F.col("_n").cast("long").alias("_n"), F.col("_s").cast("long").alias("_s"))


def runs_by_level(nodes: DataFrame, fanout: int = FANOUT) -> list[DataFrame]:
    """For each level the runs of siblings: ``_s, _i`` (the parent's index), ``_n`` (the
    parents of the group), ``_ds`` (the digests, left to right), ``_d`` (the parent).

    ``nodes``: ``_s, _i, _n, _d``.  Groups of a single node have no run at that level.
    """
    largest = nodes.agg(F.max("_n")).first()[0] or 0
    out = []
    while largest > 1:
        live = nodes.filter("_n > 1").select("_s", "_i", "_n", "_d")
        slots = F.sequence(F.lit(0), (F.least(F.lit(fanout), F.col("_n") - F.col("_i")) - 1).cast("int"))
        shifted = live.filter(F.col("_i") % fanout == 0) \
            .select(F.col("_s").alias("_g"), F.col("_i").alias("_zero"), F.explode(slots).alias("_slot"))
        met = shifted.join(live, (F.col("_g") == F.col("_s")) & (F.col("_zero") + F.col("_slot") == F.col("_i")))
        runs = met.groupBy("_s", "_zero").agg(
            F.max("_n").alias("_n"), F.array_sort(F.collect_list(F.struct("_slot", "_d"))).alias("_ds")) \
            .select("_s", F.expr(f"_zero div {fanout}").alias("_i"),
                    F.expr(f"(_n + {fanout - 1}) div {fanout}").alias("_n"), F.col("_ds._d").alias("_ds"))
        out.append(materialize(runs.withColumn("_d", F.unhex(F.sha2(_joined(F.col("_ds")), 256)))))
        nodes, largest = out[-1], -(-largest // fanout)
    return out


def _roots(nodes: DataFrame, runs: list[DataFrame]) -> DataFrame:
    """``_s, _d``: the node that remains of each group."""
    return reduce(DataFrame.unionByName, [x.filter("_n = 1").select("_s", "_d") for x in (nodes, *runs)])


def _step(ds: Column, slot: Column, fanout: int) -> Column:
    """What stands left and right of ``slot`` in a run, as hex text."""
    return F.struct(_joined(F.slice(ds, F.lit(1), slot)).alias("left"),
                    _joined(F.slice(ds, slot + 2, F.lit(fanout))).alias("right"))


def _paths(nodes: DataFrame, runs: list[DataFrame], tops: DataFrame, fanout: int) -> DataFrame:
    """``nodes`` with ``_path`` (array of left, right: the siblings from the node's own
    run upwards) and the columns of ``tops`` (``_g``, ``_path``, ...), which goes on where
    each group's tree ends.  Paths go down run by run, so what the members of a run share
    is moved once a run."""
    more = [c for c in tops.columns if c not in ("_g", "_path")]
    above = None
    for level in [*reversed(runs), nodes]:
        cols = level.columns
        last = level.filter("_n = 1")
        out = last.join(tops, last["_s"] == tops["_g"]).select(*[last[c] for c in cols], "_path", *more)
        if above is not None:
            rest = level.filter("_n > 1").withColumns({
                "_up": F.expr(f"_i div {fanout}"), "_slot": (F.col("_i") % fanout).cast("int")})
            met = rest.join(above, (rest["_s"] == above["_as"]) & (rest["_up"] == above["_ai"]))
            path = F.concat(F.array(_step(F.col("_ads"), F.col("_slot"), fanout)), F.col("_path"))
            out = out.unionByName(met.select(*[rest[c] for c in cols], path.alias("_path"), *more))
        above = out if level is nodes else out.select(
            F.col("_s").alias("_as"), F.col("_i").alias("_ai"), F.col("_ds").alias("_ads"), "_path", *more)
    return above


def manifest(leaves: DataFrame, *, group: str, order: list[str], leaf: str = "leaf",
             fanout: int = FANOUT) -> DataFrame:
    """The rows of ``leaves`` with ``subroot`` and ``root`` (32 bytes each) and ``path``,
    the siblings from leaf to root as ``array<struct<left, right>>`` of hex text: folding
    ``sha256(left + digest + right)`` along it gives the root (``folded``).

    Per ``group`` the leaves ascend by ``order`` (nulls first) and every ``fanout``
    consecutive nodes have one parent until one node remains, the subroot; the subroots by
    group (null first, bytewise) give the root likewise.  A null group is a group like any
    other.  Rows equal in ``order`` go by their leaf digest; equal rows are
    interchangeable.  No rows: no rows.
    """
    if fanout < 2:
        raise ValueError("fanout must be at least 2")
    prepare(leaves.sparkSession)
    cols = leaves.columns
    inner = {c: f"_c{i}" for i, c in enumerate(cols)}           # apart from the names used here
    rows = leaves.select(*[leaves[c].alias(inner[c]) for c in cols])
    rows = materialize(rows)
    rows = materialize(numbered(rows, inner[group], [inner[c] for c in order] + [inner[leaf]])
                       .withColumn("_d", F.col(inner[leaf])))
    low = runs_by_level(rows, fanout)
    subroots = materialize(_roots(rows, low).select(F.lit(0).cast("long").alias("_s"), F.col("_s").alias("_i"), "_d"))
    high_nodes = subroots.withColumn("_n", F.lit(subroots.count()).cast("long"))
    high = runs_by_level(high_nodes, fanout)
    root = _roots(high_nodes, high).select(F.col("_s").alias("_g"), F.col("_d").alias("_root"))
    none = F.array().cast("array<struct<left:string,right:string>>")
    tops = _paths(high_nodes, high, root.withColumn("_path", none), fanout)
    tops = materialize(tops.select(F.col("_i").alias("_g"), F.col("_d").alias("_subroot"), "_root", "_path"))
    out = _paths(rows, low, tops, fanout)
    return out.select(*[F.col(inner[c]).alias(c) for c in cols], F.col("_subroot").alias("subroot"),
                      F.col("_root").alias("root"), F.col("_path").alias("path"))


def folded(path: Column, leaf_hex: Column) -> Column:
    """The root that ``leaf_hex`` gives with the siblings of ``path``."""
    return F.aggregate(path, leaf_hex, lambda d, x: F.sha2(F.concat(x["left"], d, x["right"]), 256))


def proof_digest(path: Column) -> Column:
    """SHA-256 over all siblings, leaf to root, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), ""), 256)


def tamper_check(docs: DataFrame, *, every: int = 5, fanout: int = FANOUT) -> DataFrame:
    """Manifest of ``docs`` and a check of it: rows whose crc32 of the decimal id is
    divisible by ``every`` get their text's A-Z lower-cased and are folded with the
    original siblings.  ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    Nulls: a field's null is ``-``; a null text or id is never tampered with.  Empty text
    is ``0:``.  Ties and repeated rows: see ``manifest``.  Only the five fields are read.
    """
    lower = F.translate(F.col("text"), string.ascii_uppercase, string.ascii_lowercase)
    hit = F.crc32(F.col("doc_id").cast("string")) % every == 0
    changed = [lower if f == "text" else F.col(f) for f in FIELDS]
    leaves = docs.select("doc_id", "source", row_digest([F.col(f) for f in FIELDS]).alias("leaf"),
                         F.when(hit & F.col("text").isNotNull(), row_digest(changed)).alias("changed"))
    made = manifest(leaves, group="source", order=["doc_id"], fanout=fanout)
    start = _hex(F.coalesce("changed", "leaf"))
    out = made.select("doc_id", _hex(F.col("leaf")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"),
                      _hex(F.col("root")).alias("root"), proof_digest(F.col("path")).alias("proof_sha256"),
                      folded(F.col("path"), start).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def query(spark, sf_dir):
    return tamper_check(table(spark, sf_dir, "documents"))


def _oracle(levels: int = 6, source_levels: int = 4) -> str:
    """DuckDB SQL for sources of up to 16**levels documents and 16**source_levels sources."""
    def f(c):
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR END"

    def h(text):
        return "sha256(" + " || ".join(f(c) if c != "text" else f(text) for c in FIELDS) + ")"

    def tree(name, depth):
        out = []
        for k in range(depth):
            out.append(f"{name}r{k} AS (SELECT s, i // 16 AS i, (n + 15) // 16 AS n, list(d ORDER BY i) AS ds "
                       f"FROM {name}{k} WHERE n > 1 GROUP BY s, i // 16, n)")
            out.append(f"{name}{k + 1} AS (SELECT s, i, n, sha256(array_to_string(ds, '')) AS d FROM {name}r{k})")
        one = " UNION ALL ".join(f"SELECT s, d FROM {name}{k} WHERE n = 1" for k in range(depth + 1))
        return [*out, f"{name}root AS ({one})"]

    def climb(name, depth, src, index, keep):
        """Join the runs level by level: proof text and fold."""
        out = []
        for k in range(depth):
            slot = f"(x.{index} // {16 ** k}) % 16"
            left = f"coalesce(array_to_string(r.ds[:{slot}], ''), '')"
            right = f"coalesce(array_to_string(r.ds[{slot} + 2:], ''), '')"
            out.append(f"{name}c{k} AS (SELECT {', '.join('x.' + c for c in keep)}, "
                       f"x.proof || CASE WHEN r.ds IS NULL THEN '' ELSE {left} || {right} END AS proof, "
                       f"CASE WHEN r.ds IS NULL THEN x.fold ELSE sha256({left} || x.fold || {right}) END AS fold "
                       f"FROM {src} x LEFT JOIN {name}r{k} r ON r.s = x.{'s' if name == 'a' else 'zero'} "
                       f"AND r.i = x.{index} // {16 ** (k + 1)})")
            src = f"{name}c{k}"
        return out

    crc = ("xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), "
           "lambda c: ascii(c)::BIGINT)), lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], "
           "lambda x, y: xor(x >> 1, (x & 1) * 3988292384::BIGINT))), 4294967295::BIGINT)")
    lower = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    keep = ["doc_id", "leaf", "s", "i", "zero"]
    parts = [
        f"d AS (SELECT doc_id, source, {h('text')} AS leaf, "
        f"CASE WHEN text IS NOT NULL AND ({crc}) % 5 = 0 THEN {h(lower)} END AS changed FROM documents)",
        "e AS (SELECT doc_id, leaf, coalesce(changed, leaf) AS start, "
        "dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s, "
        "row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, "
        "count(*) OVER (PARTITION BY source) AS n FROM d)",
        "a0 AS (SELECT s, i, n, leaf AS d FROM e)", *tree("a", levels),
        "b0 AS (SELECT 0 AS s, s AS i, count(*) OVER () AS n, d FROM aroot)", *tree("b", source_levels),
        "z AS (SELECT doc_id, leaf, s, i, 0 AS zero, '' AS proof, start AS fold FROM e)",
        *climb("a", levels, "z", "i", keep), *climb("b", source_levels, f"ac{levels - 1}", "s", keep),
    ]
    return ("WITH " + ",\n".join(parts) + "\nSELECT c.doc_id, c.leaf, a.d AS subroot, b.d AS root, "
            "sha256(c.proof) AS proof_sha256, c.fold AS folded_root, c.fold = b.d AS verified "
            f"FROM bc{source_levels - 1} c JOIN aroot a ON a.s = c.s CROSS JOIN broot b")


ORACLE = _oracle()
