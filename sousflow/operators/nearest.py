"""Exact nearest-location join on the sphere, ties kept, without a cross join.

Locations become points on the unit sphere, where straight-line (chord) distance grows with
great-circle distance. The targets' *count pyramid* holds every non-empty cube of every level
(level ``l`` cuts space into cubes of side ``2 * 2**-l``) with its target count and the bounding box
of its targets; one aggregate makes all levels.

The search walks pairs of cubes, so queries that lie together share their pruning:

* **Start.** A query's own cubes, one of each level, meet the pyramid in one equi-join. The deepest one
  with a few targets bounds the nearest distance of every query in it, and queries of one
  cube two levels below form a group with a bounding box of their own.
* **Ball.** ``U``, the farthest that a group's box and its start cube's box reach apart, bounds the nearest
  distance of the whole group. The level whose cubes are a quarter to half as wide as the box grown by ``U`` covers that box
  with at most 125 cubes; one equi-join finds the non-empty ones.
* **Prune.** ``lb`` and ``ub``, the nearest and farthest points of two boxes, bound the distance of any pair of
  their points. The smallest ``ub`` tightens ``U``; a cube with ``lb > U`` holds no nearest target of the group,
  nor a tie of one, and is dropped.
* **Descend.** A cube with few targets (``LEAF_SIZE``) stops. Another one is replaced by the cubes two levels below the
  smallest cube around its box, however deep that lies, and pruned again. Where targets are spread
  about the queries the ball already holds leaves only; rounds are needed where many targets lie
  close together, seen from afar.

Each query is then compared exactly with the targets of its group's leaf cubes, and the closest ones (all ties)
are kept. Nothing is capped: pruning only removes targets that are provably farther than another target, so the
work follows the number of targets near the nearest distance, not the table sizes.

Tables that are read more than once are materialised in the session's checkpoint directory (a shared folder on a
cluster), so a lost executor reads them again instead of recomputing the walk. Cubes end at a side of 2**-23 (less
than a metre on the Earth); what shares one is compared exactly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sousflow.functions.geo import EARTH_RADIUS_M, great_circle_sql, unit_vector_sql
from sousflow.operators.topn import closest_per_group
from sousflow.session import materialised

LEAF_SIZE = 128
MAX_LEVEL = 24          # cubes of side 2**-23
START_TARGETS = 4       # targets of a start cube at least; two, so that one of them is another place
STEP = 2                # levels from a start cube to its groups, and from a cube to those that replace it
_REL_MARGIN = 1e-9      # pruning slack, so float rounding never drops a tie
_ABS_MARGIN = 1e-12
_ZERO_CHORD = 1e-9      # about 6 mm: below it two points count as one place
_AXES = ("x", "y", "z")
_CELL = ["lvl", "cx", "cy", "cz"]
_BOX = ["x_lo", "x_hi", "y_lo", "y_hi", "z_lo", "z_hi"]
_GROUP = ["glvl", "gx", "gy", "gz"]
_QBOX = ["qx_lo", "qx_hi", "qy_lo", "qy_hi", "qz_lo", "qz_hi"]


def distinct_locations(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Distinct non-NULL (lat, lon) pairs (a partial aggregate: small shuffle)."""
    return df.selectExpr(f"CAST(`{lat}` AS DOUBLE) AS `{lat}`", f"CAST(`{lon}` AS DOUBLE) AS `{lon}`").where(f"`{lat}` IS NOT NULL AND `{lon}` IS NOT NULL").distinct()


def _points(df: DataFrame, lat: str, lon: str, name: str) -> DataFrame:
    """Distinct locations with their points on the unit sphere."""
    found = distinct_locations(df, lat, lon).selectExpr(f"`{lat}` AS {name}_lat", f"`{lon}` AS {name}_lon")
    return found.selectExpr("*", *[f"{x} AS {name}{a}" for x, a in zip(unit_vector_sql(f"{name}_lat", f"{name}_lon"), _AXES, strict=True)])


# The expressions below are SQL text: the walk has many of them, and text reaches the JVM in one call each.

def _each(text: str) -> list[str]:
    """The text for every axis: ``@`` stands for its letter."""
    return [text.replace("@", a) for a in _AXES]


def _cell(x: str) -> str:
    """The cube coordinate on the deepest level; on a level above it is the same number without its last bits."""
    return f"greatest(0L, least({2**MAX_LEVEL - 1}L, floor((({x}) + 1.0D) * {2 ** (MAX_LEVEL - 1)}D)))"


def _above(cell: str, level: str) -> str:
    return f"shiftright({cell}, {MAX_LEVEL} - ({level}))"


def _on_every_level(df: DataFrame, name: str, keep: list[str]) -> DataFrame:
    """Each point once for each level, with its cube there."""
    levels = df.selectExpr(*keep, *_each(f"{_cell(f'{name}@')} AS c@_"), f"explode(sequence(0, {MAX_LEVEL})) AS lvl")
    return levels.selectExpr(*keep, "lvl", *_each(f"{_above('c@_', 'lvl')} AS c@"))


def _pyramid(t: DataFrame) -> DataFrame:
    """Non-empty cubes of all levels: target count, bounding box, and the cube STEP levels above."""
    sides = [F.expr(x) for x in ("count(1) AS n", *_each("min(t@) AS @_lo"), *_each("max(t@) AS @_hi"))]
    return _on_every_level(t, "t", ["tx", "ty", "tz"]).groupBy(*_CELL).agg(*sides).selectExpr("*", *_each(f"shiftright(c@, {STEP}) AS p@"))


#: Upper and lower bound on the chord between any point of the query box and any point of the target box.
_FARTHEST = f"sqrt({' + '.join(_each('pow(greatest(q@_hi - @_lo, @_hi - q@_lo), 2)'))})"
_CLOSEST = f"sqrt({' + '.join(_each('pow(greatest(@_lo - q@_hi, 0.0D, q@_lo - @_hi), 2)'))})"


def _grouped(q: DataFrame, pyramid: DataFrame) -> DataFrame:
    """Each query with its group and the box of its start cube (its deepest cube with START_TARGETS targets, or the root)."""
    points = ["q_lat", "q_lon", "qx", "qy", "qz"]
    starts = pyramid.where(f"n >= {START_TARGETS} OR lvl = 0").select(*_CELL, *_BOX)
    own = _on_every_level(q, "q", points).join(starts, _CELL, "inner")
    deepest = own.groupBy(*points).agg(F.expr(f"max_by(struct(lvl, {', '.join(_BOX)}), lvl) AS s"))
    level = f"least(s.lvl + {STEP}, {MAX_LEVEL})"
    return deepest.selectExpr(*points, *[f"s.{c}" for c in _BOX], f"{level} AS glvl", *_each(f"{_above(_cell('q@'), level)} AS g@"))


def _ball(grouped: DataFrame, pyramid: DataFrame) -> DataFrame:
    """Each group with the non-empty cubes that its box, grown by the bound U, touches on the level of that width."""
    sides = [*_each("min(q@) AS q@_lo"), *_each("max(q@) AS q@_hi"), *[f"min({c}) AS {c}" for c in _BOX]]  # one start box for a group
    groups = grouped.groupBy(*_GROUP).agg(*[F.expr(x) for x in sides])
    bounded = groups.selectExpr(*_GROUP, *_QBOX, f"{_FARTHEST} * {1 + _REL_MARGIN}D + {_ABS_MARGIN}D AS u_prev")
    width = f"greatest({', '.join(_each('q@_hi - q@_lo'))}) + 2 * u_prev"
    level = f"CAST(floor(3 - log2(greatest({width}, {2.0 ** -MAX_LEVEL}D))) AS INT)"
    wide = bounded.selectExpr("*", f"greatest(0, least({level}, {MAX_LEVEL})) AS lvl")
    done: list[str] = []
    for a in _AXES:
        low, high = (_above(_cell(x), "lvl") for x in (f"q{a}_lo - u_prev", f"q{a}_hi + u_prev"))
        wide = wide.selectExpr(*_GROUP, *_QBOX, "u_prev", "lvl", *done, f"explode(sequence({low}, {high})) AS c{a}")
        done.append(f"c{a}")
    return wide.join(pyramid.select(*_CELL, "n", *_BOX), _CELL, "inner")


def _prune(frontier: DataFrame, exclude_zero: bool) -> DataFrame:
    """Cubes that may still hold a nearest target of the group, with the running bound ``u``."""
    # a single target that a query of the group may stand on is no bound on the nearest *other* place
    bound = f"CASE WHEN n > 1 AND ub > {_ZERO_CHORD}D OR lb > {_ZERO_CHORD}D THEN ub END" if exclude_zero else "ub"
    bounded = frontier.selectExpr("*", f"{_CLOSEST} AS lb", f"{_FARTHEST} AS ub")
    ranked = bounded.selectExpr("*", f"least(min({bound}) OVER (PARTITION BY {', '.join(_GROUP)}), u_prev) AS u")
    return ranked.where(f"lb <= u * {1 + _REL_MARGIN}D + {_ABS_MARGIN}D")


def _descend(inner: DataFrame, pyramid: DataFrame) -> DataFrame:
    """Each cube replaced by the non-empty ones STEP levels below the smallest cube around its targets."""
    ends = inner.selectExpr(*_GROUP, *_QBOX, "u AS u_prev", *_each(f"{_cell('@_lo')} AS l@"), *_each(f"{_cell('@_hi')} AS h@"))
    apart = ", ".join(_each("CASE WHEN l@ = h@ THEN 0 ELSE length(bin(l@ ^ h@)) END"))
    around = ends.selectExpr("*", f"least({MAX_LEVEL} - greatest({apart}), {MAX_LEVEL - STEP}) AS top")
    parents = around.selectExpr(*_GROUP, *_QBOX, "u_prev", f"top + {STEP} AS lvl", *_each(f"{_above('l@', 'top')} AS p@"))
    return parents.join(pyramid, ["lvl", "px", "py", "pz"], "inner").drop("px", "py", "pz")


def nearest_locations(queries: DataFrame, targets: DataFrame, *, lat: str = "lat", lon: str = "lon",
                      exclude_zero: bool = False, radius_m: float = EARTH_RADIUS_M,
                      leaf_size: int = LEAF_SIZE) -> DataFrame:
    """For each distinct query location, every target location at the minimum distance.

    Returns ``q_lat, q_lon, t_lat, t_lon, distance_m``. Locations with a NULL
    coordinate are ignored. ``exclude_zero`` skips targets at distance 0 (the same
    place), giving the nearest *other* location. A query with no eligible target
    gets no row. ``targets`` is read twice; pass a materialised table where it is costly.
    """
    t = _points(targets, lat, lon, "t")
    pyramid = materialised(_pyramid(t))
    grouped = materialised(_grouped(_points(queries, lat, lon, "q"), pyramid))

    is_leaf = f"n <= {leaf_size} OR lvl > {MAX_LEVEL - STEP}"
    frontier = _ball(grouped, pyramid)
    reached: list[DataFrame] = []
    while True:
        # how many cubes are left to descend into is counted while the round is written
        left = Observation()
        kept = materialised(_prune(frontier, exclude_zero).observe(left, F.expr(f"count_if(NOT ({is_leaf})) AS n")))
        reached.append(kept.where(is_leaf).select(*_GROUP, *_CELL))
        if not left.get["n"]:
            break
        frontier = _descend(kept.where(f"NOT ({is_leaf})"), pyramid)
    leaves = reduce(DataFrame.unionByName, reached)
    held = leaves.join(_on_every_level(t, "t", ["t_lat", "t_lon"]), _CELL, "inner")
    return _exact(grouped.select("q_lat", "q_lon", *_GROUP).join(held.select(*_GROUP, "t_lat", "t_lon"), _GROUP, "inner"), exclude_zero, radius_m)


def _exact(pairs: DataFrame, exclude_zero: bool, radius_m: float) -> DataFrame:
    """The closest targets per query among candidate pairs (ties kept)."""
    cand = pairs.selectExpr("q_lat", "q_lon", "t_lat", "t_lon", f"{great_circle_sql('q_lat', 'q_lon', 't_lat', 't_lon', radius_m)} AS distance_m")
    return closest_per_group(cand.where("distance_m > 0" if exclude_zero else "distance_m IS NOT NULL"), ["q_lat", "q_lon"], "distance_m")
