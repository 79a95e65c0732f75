"""S1, S2, S3, S5 and S9 on features that are no boxes: L-shapes and triangles, with closed forms in the oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigie.operators import spatial
from vigie.plans.materialize import materialize
from vigie.registry import CELL, PAIR_CELL, _within_box, register
from vigie.sources import layers
from vigie.sources.fixtures import Fixtures, with_fixtures

SIDE, HALF = 6, 3


# ---------------------------------------------------------------- closed forms
def _box(a: str) -> tuple[str, ...]:
    return tuple(f"{a}.{x}" for x in ("minx", "miny", "maxx", "maxy"))


def _ell(a: str) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """An L is two boxes: the lower half, and the left of the upper half."""
    x0, y0, x1, y1 = _box(a)
    return (x0, y0, x1, f"({y0} + {HALF})"), (x0, f"({y0} + {HALF})", f"({x0} + {HALF})", y1)


def _boxes(p, q) -> str:
    return f"(greatest(least({p[2]}, {q[2]}) - greatest({p[0]}, {q[0]}), 0) * greatest(least({p[3]}, {q[3]}) - greatest({p[1]}, {q[1]}), 0))"


def _triangle_box(a: str, q) -> str:
    """A right triangle with its corner at (minx, miny): corners of the box cut four such triangles off."""
    u0, u1 = (f"greatest({q[k]} - {a}.minx, 0)" for k in (0, 2))
    v0, v1 = (f"greatest({q[k]} - {a}.miny, 0)" for k in (1, 3))
    t = lambda u, v: f"power(greatest({SIDE} - {u} - {v}, 0), 2)"
    return f"(({t(u0, v0)} - {t(u1, v0)} - {t(u0, v1)} + {t(u1, v1)}) / 2)"


def _triangles(a: str, b: str) -> str:
    leg = f"(least({a}.minx + {a}.miny, {b}.minx + {b}.miny) + {SIDE} - greatest({a}.minx, {b}.minx) - greatest({a}.miny, {b}.miny))"
    return f"(power(greatest({leg}, 0), 2) / 2)"


def _shape_box(a: str, q) -> str:
    one, two = _ell(a)
    return f"(case {a}.shape when 0 then {_boxes(_box(a), q)} when 1 then {_boxes(one, q)} + {_boxes(two, q)} else {_triangle_box(a, q)} end)"


def _shape_shape(a: str, b: str) -> str:
    one, two = _ell(b)
    back = f"(case {a}.shape when 0 then {_triangle_box(b, _box(a))} when 1 then {' + '.join(_triangle_box(b, x) for x in _ell(a))} else {_triangles(a, b)} end)"
    return f"(case {b}.shape when 0 then {_shape_box(a, _box(b))} when 1 then {_shape_box(a, one)} + {_shape_box(a, two)} else {back} end)"


def _area(a: str) -> str:
    return f"(case {a}.shape when 0 then {SIDE * SIDE} when 1 then {SIDE * SIDE - HALF * HALF} else {SIDE * SIDE / 2} end)"


def _meet(p, q) -> str:
    return f"({p[0]} <= {q[2]} and {q[0]} <= {p[2]} and {p[1]} <= {q[3]} and {q[1]} <= {p[3]})"


def _shape_meets(a: str, b: str) -> str:
    """Whether the closed shape and the closed box ``b`` share a point."""
    q = _box(b)
    one, two = _ell(a)
    corner = f"({q[2]} >= {a}.minx and {q[3]} >= {a}.miny and greatest({q[0]} - {a}.minx, 0) + greatest({q[1]} - {a}.miny, 0) <= {SIDE})"
    return f"({_meet(_box(a), q)} and case {a}.shape when 0 then true when 1 then {_meet(one, q)} or {_meet(two, q)} else {corner} end)"


def _layer(fx: Fixtures, *keep: str):
    """The stored layer: its geometry is built once, not in every branch that reads it."""
    return materialize(layers.shape_layer(fx.fx_shape, SIDE, HALF, keep))


# ---------------------------------------------------------------- queries
@register("S1_zone_tag_shapes", with_fixtures(f"""
select d.id, cast(z.geozone_id as bigint) as zone_id from fx_shape d join fx_commune z on {_within_box('d', 'z')}
union all
select d.id, cast(r.zone_id as bigint) as zone_id from fx_shape d join fx_risk r on {_within_box('d', 'r')}
  and {_shape_box('d', ('r.hx0', 'r.hy0', 'r.hx1', 'r.hy1'))} = 0""", "fx_shape", "fx_commune", "fx_risk"))
def q_zone_tag_shapes(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return spatial.zone_tag(_layer(fx), layers.zone_layer(fx.fx_commune, fx.fx_risk), CELL)


_PARCEL_SQL = f"""
pm as (select d.id, min(p.id) as pid from fx_shape d join fx_parcel p on {_shape_meets('d', 'p')} group by d.id),
own as (select d.*, p.id_parcellaire from fx_shape d left join pm on pm.id = d.id left join fx_parcel p on p.id = pm.pid)"""


@register("S2_match_parcel_shapes", with_fixtures(f"with {_PARCEL_SQL} select id, id_parcellaire from own", "fx_shape", "fx_parcel"))
def q_match_parcel_shapes(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return spatial.match_parcel(_layer(fx), layers.parcel_layer(fx.fx_parcel), PAIR_CELL).select("id", "id_parcellaire")


@register("S3_first_detection_shapes", with_fixtures(f"""
select t.id, not exists (select 1 from fx_shape e where e.batch_year < t.batch_year and {_meet(_box('t'), _box('e'))}
  and 2 * {_shape_shape('t', 'e')} > {_area('t')}) as first_detection
from fx_shape t""", "fx_shape"))
def q_first_detection_shapes(spark, sf_dir):
    det = _layer(Fixtures(spark, sf_dir), "batch_year")
    return spatial.first_detection(det, PAIR_CELL, seq_col="batch_year").select("id", "first_detection")


@register("S5_outside_bounds_shapes", with_fixtures(f"""
with cov as (select d.id, sum({_shape_box('d', _box('c'))}) as covered from fx_shape d
  join fx_tileset_zone tz on tz.tileset_id = d.tile_set_id join fx_commune c on c.geozone_id = tz.geozone_id group by d.id)
select d.id from fx_shape d where d.tile_set_id not in (select tileset_id from fx_tileset_zone)
union all
select d.id from fx_shape d left join cov on cov.id = d.id
where d.tile_set_id in (select tileset_id from fx_tileset_zone) and coalesce(cov.covered, 0) < {_area('d')}""",
                                                     "fx_shape", "fx_tileset_zone", "fx_commune"))
def q_outside_bounds_shapes(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return spatial.outside_bounds(_layer(fx, "tile_set_id"), fx.fx_tileset_zone, layers.commune_layer(fx.fx_commune), CELL)


@register("S9_prescribed_by_history_shapes", with_fixtures(f"""with {_PARCEL_SQL}
select a.id, a.batch_year, a.id_parcellaire, a.object_type, cast(count(distinct b.batch_year) as bigint) as count_histo_6y_detection,
  count(distinct b.batch_year) >= 1 as prescripted_detection
from own a left join own b on a.id_parcellaire = b.id_parcellaire and a.batch_year - b.batch_year >= 6 and {_meet(_box('a'), _box('b'))}
  and {_shape_shape('a', 'b')} / {_area('a')} >= 0.5
where a.object_type in ('construction en dur', 'piscine') group by a.id, a.batch_year, a.id_parcellaire, a.object_type""", "fx_shape", "fx_parcel"))
def q_prescribed_by_history_shapes(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    det = materialize(spatial.match_parcel(_layer(fx, "batch_year", "object_type"), layers.parcel_layer(fx.fx_parcel), PAIR_CELL))
    out = spatial.prescribed_by_history(det, PAIR_CELL)
    return out.select("id", "batch_year", "id_parcellaire", "object_type", "count_histo_6y_detection", F.col("prescripted_detection"))
