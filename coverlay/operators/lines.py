"""Line work as tables of edges: noding, chaining at degree-two nodes, and building lines from ordered points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverlay.functions import geometry as G
from coverlay.functions import nested as N
from coverlay.operators.adjacency import canonical_edges
from coverlay.operators.grid import cell_of
from coverlay.operators.stage import cut


def make_lines(points: DataFrame, keys: Sequence[str], order: Sequence[str], x: str = "x", y: str = "y") -> DataFrame:
    """One line per key through its points in order: ``keys, path`` (array of points). A line is one row."""
    ordered = F.array_sort(F.collect_list(F.struct(*order, F.col(x).alias("_x"), F.col(y).alias("_y"))))
    return points.groupBy(*keys).agg(ordered.alias("_pts")).select(
        *keys, F.transform("_pts", lambda p: N.xy(p["_x"], p["_y"])).alias("path")
    )


def break_line(points: DataFrame, keys: Sequence[str], seq: str, at: int) -> DataFrame:
    """Two ordered lines per key: points before sequence number ``at``, and the rest."""
    part = F.when(F.col(seq) < F.lit(at), 1).otherwise(2)
    return make_lines(points.withColumn("line_num", part), [*keys, "line_num"], [seq])


def node_edges(edges: DataFrame, cell: float, keep: Sequence[str] = (), tolerance: float = 0.0) -> DataFrame:
    """Cut edges at vertices of any edge that lie on them (within ``tolerance``); duplicates per ``keep`` go.

    This nodes a coverage whose neighbours carry different vertices along a common border: afterwards both
    sides hold the same edges. ``keep`` columns (such as the owner) stay with the pieces. Vertices and edges
    meet through grid cells; only the few vertices of one edge are ever sorted together.
    """
    keep = list(keep)
    e = canonical_edges(edges, keep).distinct()
    tol = F.lit(float(tolerance))
    span = lambda lo, hi: F.explode(F.sequence(cell_of(lo - tol, cell), cell_of(hi + tol, cell)))
    spread = e.withColumn("_cx", span(F.col("x1"), F.col("x2")))
    spread = spread.withColumn("_cy", span(F.least("y1", "y2"), F.greatest("y1", "y2")))
    ends = e.select(F.col("x1").alias("px"), F.col("y1").alias("py")).unionByName(
        e.select(F.col("x2").alias("px"), F.col("y2").alias("py"))
    ).distinct()
    ends = ends.withColumns({"_cx": cell_of("px", cell), "_cy": cell_of("py", cell)})
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    ux, uy = F.col("px") - F.col("x1"), F.col("py") - F.col("y1")
    off, along, len2 = F.abs(dx * uy - dy * ux), dx * ux + dy * uy, dx * dx + dy * dy
    inside = (along > 0) & (along < len2) & (off <= tol * F.sqrt(len2))
    cuts = spread.join(ends, ["_cx", "_cy"]).where(inside)
    at = F.struct((along / len2).alias("t"), N.xy("px", "py").alias("p"))
    per = cuts.groupBy(*keep, "x1", "y1", "x2", "y2").agg(F.array_sort(F.collect_set(at)).alias("_in"))
    all_e = e.join(per, [*keep, "x1", "y1", "x2", "y2"], "left")
    mid = F.coalesce(F.transform("_in", lambda s: s["p"]), F.array().cast("array<struct<x:double,y:double>>"))
    pts = F.concat(F.array(N.xy("x1", "y1")), mid, F.array(N.xy("x2", "y2")))
    pairs = F.zip_with(F.slice(pts, 1, F.size(pts) - 1), F.slice(pts, 2, F.size(pts) - 1), lambda a, b: F.struct(
        a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")))
    pieces = all_e.select(*keep, F.explode(pairs).alias("_e")).select(*keep, "_e.*")
    return canonical_edges(pieces, keep).distinct()


def _half(x1, y1, x2, y2) -> Column:
    return F.struct(
        F.col(x1).alias("x1"), F.col(y1).alias("y1"), F.col(x2).alias("x2"), F.col(y2).alias("y2")
    )


def _double(state: DataFrame, keys: list[str]) -> DataFrame:
    """Pointer doubling: every half-edge learns the last half-edge of its run, in log2(longest run) joins.

    A round writes the runs that are still open; ended ones were written when they ended and are join targets only.
    """
    columns = [*keys, "h", "last", "dist", "ended", "low"]
    done, running = state.where("ended").select(*columns), state.where(~F.col("ended")).select(*columns)
    while True:
        ahead = done.unionByName(running).select(
            *keys, F.col("h").alias("last"), F.col("last").alias("_last"), F.col("dist").alias("_dist"),
            F.col("ended").alias("_ended"), F.col("low").alias("_low"),
        )
        going = cut(running.join(ahead, [*keys, "last"]).select(
            *keys, "h", F.col("_last").alias("last"), (F.col("dist") + F.col("_dist")).alias("dist"),
            F.col("_ended").alias("ended"), F.least("low", "_low").alias("low"),
            (F.col("_ended") | (F.col("_low") < F.col("low"))).alias("moved"),
        ))
        if going.where("moved").isEmpty():
            return done.unionByName(going.select(*columns))
        done = done.unionByName(going.where("ended").select(*columns))
        running = going.where(~F.col("ended")).select(*columns)


def label_chains(edges: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Group distinct undirected edges into maximal chains that pass only through nodes of degree two.

    Returns each edge once, in chain direction: ``keys, chain, pos, x1, y1, x2, y2``. ``chain`` is a struct that
    identifies the chain (its closing edge), ``pos`` counts down along it. Closed loops become one chain.
    Ids are the edges' own coordinates, so there are no hash collisions and nothing depends on partitioning.
    """
    keys = list(keys)
    e = canonical_edges(edges, keys).distinct()
    halves = e.unionByName(
        e.select(*keys, F.col("x2").alias("x1"), F.col("y2").alias("y1"), F.col("x1").alias("x2"), F.col("y1").alias("y2"))
    )
    out = halves.groupBy(*keys, "x1", "y1").agg(
        F.count(F.lit(1)).alias("_n"), F.min(N.xy("x2", "y2")).alias("_e1"), F.max(N.xy("x2", "y2")).alias("_e2")
    ).where(F.col("_n") == 2)
    out = out.select(*keys, F.col("x1").alias("x2"), F.col("y1").alias("y2"), "_e1", "_e2")
    j = halves.join(out, [*keys, "x2", "y2"], "left")
    back = N.xy("x1", "y1")
    onward = F.when(F.col("_e1") == back, F.col("_e2")).otherwise(F.col("_e1"))
    nxt = F.when(F.col("_e1").isNotNull(), F.struct(
        F.col("x2").alias("x1"), F.col("y2").alias("y1"), onward["x"].alias("x2"), onward["y"].alias("y2")))
    start = j.select(*keys, _half("x1", "y1", "x2", "y2").alias("h"), nxt.alias("nxt"))

    def initial(d: DataFrame) -> DataFrame:
        return d.select(
            *keys, "h", F.coalesce("nxt", "h").alias("last"), F.col("nxt").isNotNull().cast("bigint").alias("dist"),
            F.col("nxt").isNull().alias("ended"), F.least("h", F.coalesce("nxt", "h")).alias("low"),
        )

    start = cut(start)
    runs = _double(initial(start), keys)
    twin = F.struct(
        F.col("h.x2").alias("x1"), F.col("h.y2").alias("y1"), F.col("h.x1").alias("x2"), F.col("h.y1").alias("y2")
    )
    mirror = runs.select(*keys, twin.alias("h"), F.col("last").alias("_tlast"), F.col("low").alias("_tlow"))
    both = runs.join(mirror, [*keys, "h"])
    chains = both.where(F.col("ended") & (F.col("last") < F.col("_tlast"))).select(
        *keys, F.col("last").alias("chain"), F.col("dist").alias("pos"), "h.*"
    )
    loops = both.where(~F.col("ended") & (F.col("low") < F.col("_tlow"))).select(*keys, "h", "low")
    if loops.isEmpty():
        return chains
    opened = start.join(loops, [*keys, "h"]).select(
        *keys, "h", F.when(F.col("nxt") != F.col("low"), F.col("nxt")).alias("nxt"), "low"
    )
    ranked = _double(initial(opened), keys)
    return chains.unionByName(
        ranked.select(*keys, F.col("last").alias("chain"), F.col("dist").alias("pos"), "h.*")
    )


def chain_lines(labelled: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One line per chain: ``keys, chain, path``."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("pos")).alias("o"), "x1", "y1", "x2", "y2")))
    g = labelled.groupBy(*keys, "chain").agg(ordered.alias("_e"))
    first = F.array(N.xy(F.col("_e")[0]["x1"], F.col("_e")[0]["y1"]))
    return g.select(*keys, "chain", F.concat(first, F.transform("_e", lambda s: N.xy(s["x2"], s["y2"]))).alias("path"))


def merge_lines(edges: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Join edges end to end wherever exactly two meet: ``keys, path``."""
    return chain_lines(label_chains(edges, keys), keys).drop("chain")


def lines_to_geometry(df: DataFrame, path: str = "path") -> DataFrame:
    return df.withColumn("geom", G.line(path)).drop(path)
