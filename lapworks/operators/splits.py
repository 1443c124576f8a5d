"""Count-balanced buckets for groups that hold too many rows for one task.

A group with more than ``target`` rows is cut along its sort order.  Level by level, the
rows of each piece that is still too large are counted in ``FAN`` cells of equal width
between the piece's own least and largest value; cells that are too large are refined in
the next level, by the next sort column once a cell has a single value.  Neighbouring small
cells are then put together again, by their prefix counts, into buckets of at most
``target`` rows.  Only rows that agree in every given column can stay together beyond that.

The counts are partial aggregates (at most ``FAN`` + 4 rows for each piece), and a group or
piece above ``target`` exists at most ``rows / target`` times: with the default target that
is ``PIECES`` times the shuffle partitions, a bound on all that is collected or broadcast.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from lapworks.session import shuffle_partitions

FAN = 64                     # cells of a piece
PIECES = 4                   # times the shuffle partitions: how many pieces all rows make
LEAST_ROWS = 4096            # groups up to this size are never cut
_MOST_LEVELS = 400
_NULL, _LOW, _HIGH, _NAN = -2, -1, FAN, FAN + 1     # cells in sort order: null, -inf, 0.., inf, NaN


@dataclass
class _Node:
    """A piece to be cut: along dimension ``dim`` from ``lo`` in steps of ``width``."""
    dim: int
    lo: object
    width: float
    rows: int
    cells: dict = None       # cell -> _Node, or a bucket number once the tree is complete


def _cell(x: Column, integral: bool, lo_long: Column, lo_double: Column, width: Column) -> Column:
    """The cell of a value, growing with it; infinities, NaN and null have their own."""
    if integral:
        # an overflow is past every other value of the piece
        away = F.coalesce(F.try_subtract(x.cast("long"), lo_long).cast("double"), F.lit(math.inf))
    else:
        x = x.cast("double")
        away = x - lo_double
    cell = F.least(F.greatest(F.floor(away / width), F.lit(0)), F.lit(FAN - 1)).cast("int")
    if not integral:
        cell = F.when(F.isnan(x), _NAN).when(x == math.inf, _HIGH).when(x == -math.inf, _LOW).otherwise(cell)
    return F.when(x.isNull(), _NULL).otherwise(cell)


def _span(lo, hi) -> float:
    """The width of a cell between two different values."""
    lo, hi = float(lo), float(hi)
    width = (hi - lo) / FAN
    if math.isinf(width):
        width = hi / FAN - lo / FAN
    return width or (hi - lo) or 1.0


class Splits:
    """The cut of the hot groups of a table; ``assign`` gives each row its bucket."""

    def __init__(self, spark, keys: list[str], dims: list[tuple[str, bool]], key_schema, target: int):
        self.spark, self.keys, self.dims, self.target = spark, keys, dims, target
        self.key_schema = key_schema
        self.roots: list[tuple[tuple, _Node]] = []
        self.buckets = 0

    # ---------------------------------------------------------------- tables of the tree
    def _dim_fields(self) -> str:
        return "_node int, _dim int, _lol long, _lod double, _w double"

    def _row(self, number: int, node: _Node) -> tuple:
        integral = self.dims[node.dim][1]
        return (number, node.dim, node.lo if integral else None, None if integral else float(node.lo), node.width)

    def _root_table(self) -> DataFrame:
        rows = [(*key, *self._row(i, node)) for i, (key, node) in enumerate(self.roots)]
        fields = ", ".join(f"_g{i} {f.dataType.simpleString()}" for i, f in enumerate(self.key_schema))
        return self.spark.createDataFrame(rows, ", ".join(x for x in (fields, self._dim_fields()) if x))

    def _enter(self, df: DataFrame, how: str) -> DataFrame:
        """Rows with the root of their group (``how``: inner or left)."""
        roots = F.broadcast(self._root_table())
        same = reduce(lambda a, b: a & b, [df[k].eqNullSafe(roots[f"_g{i}"]) for i, k in enumerate(self.keys)])
        return df.join(roots, same, how).drop(*[f"_g{i}" for i in range(len(self.keys))])

    def _with_cell(self, df: DataFrame) -> DataFrame:
        cell = F.lit(None).cast("int")
        for i, (name, integral) in enumerate(self.dims):
            cell = F.when(F.col("_dim") == i, _cell(F.col(name), integral, F.col("_lol"), F.col("_lod"), F.col("_w"))) \
                .otherwise(cell)
        return df.withColumn("_cell", cell)

    def _down(self, df: DataFrame, level: list[_Node], how: str) -> tuple[DataFrame, list[_Node]]:
        """Rows of the nodes of ``level`` with their node of the next one, or their bucket."""
        nxt, rows = [], []
        for i, node in enumerate(level):
            for cell, child in node.cells.items():
                if isinstance(child, _Node):
                    rows.append((i, cell, None, *self._row(len(nxt), child)))
                    nxt.append(child)
                elif child is not None:
                    rows.append((i, cell, child, *[None] * 5))
        table = self.spark.createDataFrame(
            rows, "_from int, _at int, _leaf long, _n int, _d int, _ll long, _ld double, _ww double")
        met = df.join(F.broadcast(table), (F.col("_node") == F.col("_from")) & (F.col("_cell") == F.col("_at")), how)
        names = [c for c in df.columns if c not in ("_node", "_dim", "_lol", "_lod", "_w", "_cell", "_bucket")]
        bucket = F.coalesce("_bucket", "_leaf") if "_bucket" in df.columns else F.col("_leaf")
        return met.select(*names, bucket.alias("_bucket"), F.col("_n").alias("_node"), F.col("_d").alias("_dim"),
                          F.col("_ll").alias("_lol"), F.col("_ld").alias("_lod"), F.col("_ww").alias("_w")), nxt

    def assign(self, df: DataFrame) -> DataFrame:
        """``df`` with ``_bucket``: growing with the sort order inside a hot group, null
        for rows of all other groups."""
        cols = df.columns
        out, level = self._enter(df, "left"), [n for _, n in self.roots]
        while level:
            out, level = self._down(self._with_cell(out), level, "left")
        return out.select(*cols, "_bucket")

    # ---------------------------------------------------------------- growing the tree
    def _grow(self, df: DataFrame, wanted) -> None:
        rows = self._enter(df.select(*self.keys, *dict.fromkeys(
            name for name, _ in self.dims if name not in self.keys)), "inner")
        level = [n for _, n in self.roots]
        ranks = {id(n): wanted(n.rows) for n in level} if wanted else {}
        for _ in range(_MOST_LEVELS):
            stats = []
            for i, (name, integral) in enumerate(self.dims):
                c = F.col(name)
                if not integral:
                    c = F.when(~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != math.inf), c)
                stats += [F.min(c).alias(f"_lo{i}"), F.max(c).alias(f"_hi{i}")]
            found: dict[int, list] = {}
            for r in self._with_cell(rows).groupBy("_node", "_cell").agg(F.count(F.lit(1)).alias("_rows"), *stats).collect():
                found.setdefault(r["_node"], []).append(r)
            nxt = []
            for i, node in enumerate(level):
                node.cells, before = {}, 0
                for r in sorted(found.get(i, []), key=lambda r: r["_cell"]):
                    n, rank = r["_rows"], ranks.get(id(node))
                    heavy = n > self.target and (rank is None or before < rank <= before + n)
                    child = self._child(node, r) if heavy else None
                    node.cells[r["_cell"]] = child if child else n
                    if child:
                        nxt.append(child)
                        if rank is not None:
                            ranks[id(child)] = rank - before
                    before += n
            if not nxt:
                return
            # the children's rows only: one more broadcast join, no shuffle
            marked, again = self._down(self._with_cell(rows), [_Node(n.dim, n.lo, n.width, n.rows, {
                c: x for c, x in n.cells.items() if isinstance(x, _Node)}) for n in level], "inner")
            rows, level = marked.drop("_bucket"), again
        raise RuntimeError("the groups could not be cut")

    def _child(self, node: _Node, r) -> _Node | None:
        """How a heavy cell is cut: along the same column while it has several values
        there, else along the next; None if nothing tells its rows apart."""
        dim = node.dim
        lo, hi = r[f"_lo{dim}"], r[f"_hi{dim}"]
        if 0 <= r["_cell"] < FAN and lo != hi:
            child = _Node(dim, lo, _span(lo, hi), r["_rows"])
            stuck = r["_rows"] == node.rows and (child.lo, child.width) == (node.lo, node.width)
            return None if stuck else child
        for d in range(dim + 1, len(self.dims)):
            lo, hi = r[f"_lo{d}"], r[f"_hi{d}"]
            if lo is None:               # nulls, NaN and infinities only: cells of their own
                return _Node(d, 0, 1.0, r["_rows"])
            return _Node(d, lo, _span(lo, hi), r["_rows"])
        return None

    def _number(self) -> None:
        """Buckets by prefix counts: neighbours together as long as ``target`` allows."""
        for _, root in self.roots:
            bucket, filled = 0, 0
            stack = [(root, iter(sorted(root.cells)))]
            while stack:
                node, cells = stack[-1]
                cell = next(cells, None)
                if cell is None:
                    stack.pop()
                    continue
                child = node.cells[cell]
                if isinstance(child, _Node):
                    stack.append((child, iter(sorted(child.cells))))
                    continue
                if filled and filled + child > self.target:
                    bucket, filled = bucket + 1, 0
                filled += child
                node.cells[cell] = bucket
            self.buckets += bucket + 1


def balanced_buckets(df: DataFrame, keys: list[str], dims: list[str], *, target_rows: int | None = None,
                     at_rank=None) -> Splits | None:
    """The cut of those groups of ``keys`` that have too many rows, along the numeric
    columns ``dims`` (ascending, nulls first, NaN last); None if there is none.

    ``target_rows``: rows of a bucket; by default all rows divided by ``PIECES`` times the
    shuffle partitions, at least ``LEAST_ROWS``.  ``at_rank`` (group size -> rank from 1):
    only the part of each group around that rank is refined.  Null keys are keys like any
    other.  Runs one aggregate over the keys, and for hot groups one a level.
    """
    spark = df.sparkSession
    pieces = PIECES * shuffle_partitions(spark)
    seen = Observation()
    kinds = [(d, isinstance(df.schema[d].dataType, IntegralType)) for d in dims]
    name, integral = kinds[0]
    first = F.col(name) if integral else F.when(
        ~F.isnan(F.col(name).cast("double")) & (F.abs(F.col(name).cast("double")) != math.inf), F.col(name))
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), F.min(first).alias("_lo"), F.max(first).alias("_hi"))
    # groups above rows / pieces are fewer than pieces: the largest so many hold them all
    most = groups.observe(seen, F.sum("_rows").alias("rows")) if target_rows is None else groups
    most = most.filter(F.col("_rows") > (LEAST_ROWS if target_rows is None else target_rows))
    if target_rows is None:
        largest = most.orderBy(F.desc("_rows")).limit(pieces).collect()
        target = max(LEAST_ROWS, (seen.get["rows"] or 0) // pieces)
    else:
        largest, target = most.collect(), target_rows
    hot = [r for r in largest if r["_rows"] > target]
    if not hot:
        return None
    out = Splits(spark, keys, kinds, [df.schema[k] for k in keys], target)
    for r in hot:
        lo, hi = r["_lo"], r["_hi"]
        node = _Node(0, 0, 1.0, r["_rows"]) if lo is None else _Node(0, lo, _span(lo, hi) if lo != hi else 1.0, r["_rows"])
        out.roots.append((tuple(r[k] for k in keys), node))
    out._grow(df, at_rank)
    out._number()
    return out
