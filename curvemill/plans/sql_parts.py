"""SQL of filters and interpolation that several queries share: written from the rules, not from the operators' matrices.

The low-pass is the third-order Butterworth filter as a recursion over frames, there and back; interpolation is the
monotone cubic by windows over neighbouring frames.
"""

from __future__ import annotations

import math

from curvemill.plans.queries import INPUT, LONG

CURVES = "e as (select vec_id as voxel_id, embedding::double[] as l from embeddings)"


def _pass(name: str, source: str, cutoff: float, rate: float = 15.0) -> str:
    """Recursive CTE: o is l of source (voxel_id, l) filtered once, in rows where i = len(l); it starts as if l[1] had always been there."""
    k = math.tan(math.pi * cutoff / rate)
    d = k**3 + 2 * k**2 + 2 * k + 1
    b = [k**3 / d, 3 * k**3 / d, 3 * k**3 / d, k**3 / d]
    a = [1.0, (3 * k**3 + 2 * k**2 - 2 * k - 3) / d, (3 * k**3 - 2 * k**2 - 2 * k + 3) / d, (k**3 - 2 * k**2 + 2 * k - 1) / d]
    s0 = 1 - b[0]
    s1 = s0 - b[1] + a[1]
    s2 = s1 - b[2] + a[2]
    return f"""{name} as (select voxel_id, l, 0 as i, []::double[] as o, {s0!r}::double * l[1] as s0, {s1!r}::double * l[1] as s1, {s2!r}::double * l[1] as s2 from {source}
    union all select voxel_id, l, i + 1, list_append(o, y), s1 + {b[1]!r}::double * x - {a[1]!r}::double * y, s2 + {b[2]!r}::double * x - {a[2]!r}::double * y, {b[3]!r}::double * x - {a[3]!r}::double * y
    from (select *, l[i + 1] as x, {b[0]!r}::double * l[i + 1] + s0 as y from {name} where i < len(l)))"""


def zero_phase(name: str, source: str, n: int, cutoff: float = 4.0) -> str:
    """CTEs (of a WITH RECURSIVE) that end in ``name`` (voxel_id, l): the curves l of n frames in source, filtered forwards and backwards."""
    before = ", ".join(f"2 * l[1] - l[{i}]" for i in range(13, 1, -1))
    after = ", ".join(f"2 * l[{n}] - l[{i}]" for i in range(n - 1, n - 13, -1))
    return f"""{name}_x as (select voxel_id, list_concat(list_concat([{before}], l), [{after}]) as l from {source}),
{_pass(name + "_f", name + "_x", cutoff)}, {name}_r as (select voxel_id, list_reverse(o) as l from {name}_f where i = {n + 24}),
{_pass(name + "_b", name + "_r", cutoff)}, {name} as (select voxel_id, list_reverse(o)[13 : {n + 12}] as l from {name}_b where i = {n + 24})"""


def unnested(name: str, source: str) -> str:
    """CTE of (voxel_id, frame, v) from (voxel_id, l)."""
    return f"{name} as (select voxel_id, unnest(range(len(l))) as frame, unnest(l) as v from {source})"


def slopes(name: str, source: str, value: str = "v") -> str:
    """CTE of (voxel_id, frame, v): central differences of (voxel_id, frame, value), one-sided at the ends."""
    w = "over (partition by voxel_id order by frame)"
    return f"{name} as (select voxel_id, frame, case when p is null then q - v when q is null then v - p else (q - p) / 2 end as v from (select voxel_id, frame, {value} as v, lag({value}) {w} as p, lead({value}) {w} as q from {source}))"


#: on_ (voxel_id, onset): the earlier of the two highest peaks, ten frames apart, of the smoothed curve's slope without its first frame; else null.
ONSET = f"""{CURVES}, tl as (select voxel_id, l[2:] as l from e), {zero_phase("z", "tl", 63)}, {unnested("zu", "z")}, {slopes("g", "zu")},
pk as (select voxel_id, frame, v from (select *, lag(v) over w as p, lead(v) over w as q from g window w as (partition by voxel_id order by frame)) where v > p and v > q),
p0 as (select voxel_id, arg_max(frame, (v, -frame)) as f from pk group by voxel_id),
p1 as (select voxel_id, arg_max(frame, (v, -frame)) as f from (select pk.* from pk join p0 using (voxel_id) where abs(frame - f) >= 10) group by voxel_id),
on_ as (select e.voxel_id, least(p0.f, coalesce(p1.f, p0.f)) as onset from e left join p0 using (voxel_id) left join p1 using (voxel_id))"""

LOWPASS = f"with recursive {CURVES}, {zero_phase('z', 'e', 64)}, {unnested('u', 'z')} select voxel_id, frame, round(v, 6) as value from u"
ONSET_GRADIENT = f"with recursive {ONSET} select voxel_id, coalesce(onset, 10) as onset from on_"
BASELINE_SHIFT = f"""with recursive {LONG}, {ONSET}, s as (select voxel_id, coalesce(onset, 10) as onset, frame, v from c join on_ using (voxel_id))
select voxel_id, onset, frame, round(case when frame < onset then 0 else v - min(v) over (partition by voxel_id, frame < onset) end, 6) as value from s"""
BASELINE_GRADIENT = f"""with recursive {LONG}, {ONSET}, d as (select voxel_id, frame, lead(v) over (partition by voxel_id order by frame) - v as d from c),
top as (select voxel_id, arg_max(frame, (d, -frame)) as f from d where d is not null group by voxel_id),
flat as (select voxel_id, max(frame) filter (d <= 0 and frame < f) + 1 as f from d join top using (voxel_id) group by voxel_id)
select voxel_id, greatest(coalesce(onset, flat.f, 10), 3) as nbf from on_ join flat using (voxel_id)"""
LEGACY_SHIFT = f"""with recursive {LONG}, m as (select voxel_id, avg(v) filter (frame between 2 and 9) as m from c group by voxel_id),
o as (select voxel_id, frame, case when frame < 10 then 0.0 else v - m end::double as v from c join m using (voxel_id)), ol as (select voxel_id, list(v order by frame) as l from o group by voxel_id),
{zero_phase("z", "ol", 64)}, {unnested("y", "z")},
lim as (select voxel_id, avg(v) filter (frame between 3 and 8) + greatest(4 * stddev_pop(v) filter (frame between 3 and 8), 0.05 * (max(v) - min(v)), 5e-4) as t from y group by voxel_id),
up as (select voxel_id, frame, min(v) over (partition by voxel_id order by frame rows between current row and 2 following) as low from y),
st as (select voxel_id, greatest(coalesce(min(frame) filter (frame between 8 and 61 and low > t), 9) - 1, 3) as i0 from up join lim using (voxel_id) group by voxel_id)
select voxel_id, frame, round(case when frame < i0 then 0 else v - min(v) over (partition by voxel_id, frame < i0) end, 6) as value from o join st using (voxel_id)"""

#: h (voxel_id, i, y0, y1, m0, m1): the pieces of the monotone cubic through frames i and i + 1, slopes by frame.
PIECES = f"""{LONG}, d as (select voxel_id, frame, v, lead(v) over w - v as d1, v - lag(v) over w as d0, lead(v, 2) over w - lead(v) over w as d2, lag(v) over w - lag(v, 2) over w as d3 from c window w as (partition by voxel_id order by frame)),
en as (select *, case when d0 is null then d1 when d1 is null then d0 end as e0, case when d0 is null then d2 when d1 is null then d3 end as e1 from d),
m as (select voxel_id, frame, v, case when e0 is null then case when d0 * d1 > 0 then 2 * d0 * d1 / (d0 + d1) else 0 end
    when sign(3 * e0 - e1) <> sign(e0) then 0 when sign(e0) <> sign(e1) and abs(3 * e0 - e1) / 2 > 3 * abs(e0) then 3 * e0 else (3 * e0 - e1) / 2 end as m from en),
h as (select voxel_id, frame as i, v as y0, lead(v) over w as y1, m as m0, lead(m) over w as m1 from m window w as (partition by voxel_id order by frame))"""
_CUBIC = "(2 * u * u * u - 3 * u * u + 1) * y0 + (u * u * u - 2 * u * u + u) * m0 + (3 * u * u - 2 * u * u * u) * y1 + (u * u * u - u * u) * m1"
SHIFT_CURVE = f"""with {PIECES}, pts as (select f as frame, f - 3 / 2.463::double as p from (select unnest(range(64)) as f))
select voxel_id, frame, round({_CUBIC}, 6) as value from (select *, p - i as u from pts join h on h.i = floor(p)) where p >= 0
union all select vec_id, frame, 0.0 from embeddings, pts where p < 0"""
UPSAMPLE = f"""with {PIECES}, pts as (select k as frame, least(k // 3, 62) as i, k / 3::double - least(k // 3, 62) as u from (select unnest(range(190)) as k))
select voxel_id, frame, round({_CUBIC}, 6) as value from pts join h using (i)"""

_INPUT_LIST = "il as (select 0 as voxel_id, list(c_a order by frame) as l from ca)"
#: Starts of an input curve's late part, as CTEs that end in st (i0).
TAIL_STARTS = {
    "curvature": f"""{_INPUT_LIST}, {zero_phase("z", "il", 64)}, {unnested("y", "z")}, {slopes("g1", "y")}, {slopes("g2", "g1")},
bend as (select frame, sum(abs(v)) over (order by frame rows between 2 preceding and 2 following) / 5 as v from g2),
st as (select case when (select max(v) from bend) > 0 then least(max(frame) filter (v > 0.05 * (select max(v) from bend)) + 3, 52) else 32 end as i0 from bend)""",
    "changepoint": f"""{_INPUT_LIST}, {zero_phase("z", "il", 64)}, {unnested("y", "z")}, {slopes("g1", "y", "ln(greatest(abs(v), 1e-6))")},
gl as (select voxel_id, list(abs(v) order by frame) as l from g1 group by voxel_id), {zero_phase("q", "gl", 64, 2.0)}, {unnested("lively", "q")},
st as (select coalesce(least(max(frame) filter (v > (select median(v) + 0.5 * stddev_pop(v) from lively)) + 1, 52), 51) as i0 from lively)""",
    "peak_decay": f"""{_INPUT_LIST}, {zero_phase("z", "il", 64)}, {unnested("y", "z")}, base as (select avg(v) filter (frame < 5) as low, max(v) as top from y),
pk as (select frame as f, v from (select frame, v, lag(v) over (order by frame) as p, lead(v) over (order by frame) as q from y) where v > p and v > q),
rk as (select list(f order by v desc, f desc) as fs from pk),
kp as (select 0 as i, []::bigint[] as kept, fs from rk union all select i + 1, case when len(list_filter(kept, lambda k: abs(k - fs[i + 1]) < 10)) = 0 then list_append(kept, fs[i + 1]) else kept end, fs from kp where i < len(fs)),
ap as (select unnest(kept) as f from kp where i = len(fs)),
ed as (select f, pk.v, coalesce(max(y.frame) filter (y.frame < f and y.v > pk.v) + 1, 0) as a, coalesce(min(y.frame) filter (y.frame > f and y.v > pk.v), 64) as b from ap join pk using (f), y group by f, pk.v),
pr as (select f, ed.v, ed.v - greatest(min(y.v) filter (y.frame between a and f), min(y.v) filter (y.frame >= f and y.frame < b)) as stands from ed, y group by f, ed.v),
lp as (select arg_max(pr.v, f) as v, max(f) as f from pr, base where top > low and stands >= 0.1 * (top - low)),
st as (select case when any_value(lp.f) is null then 0 else least(coalesce(min(y.frame) filter (y.frame > lp.f and y.v <= low + 0.5 * (lp.v - low)), any_value(lp.f)), 52) end as i0 from lp, base, y)""",
}

#: The vein and the artery of each subject among all its candidates, after CTEs h, k, c of the candidates.
ROLES = """bx as (select k.subject_id, component, count(*) as n_voxels, avg(h.x) as x, avg(h.y) as y, avg(h.z) as z, arg_max(voxel_id, (peak, -voxel_id)) as voxel_id from k join h using (subject_id, voxel_id) group by all having count(*) >= 3),
dd as (select c.subject_id, c.voxel_id, frame, v - m as d from c join b using (subject_id, voxel_id)),
fs as (select subject_id, voxel_id, max(d) as peak from dd group by all),
fa as (select subject_id, voxel_id, min(frame) filter (d > 0.1 * peak) as arrival from dd join fs using (subject_id, voxel_id) group by all),
vs as (select bx.*, coalesce(arrival, 0) as arrival from bx join fa using (subject_id, voxel_id)),
pj as (select subject_id, voxel_id, x, y, coalesce(max(v), 0) as top from c group by all), pl as (select subject_id, quantile_cont(top, 0.6) as lim from pj group by all),
cl as (select distinct subject_id, x, y from pj join pl using (subject_id) where top > lim), bo as (select subject_id, median(x) as middle, min(y) as front, max(y) as back, greatest(max(y) - min(y), 1) as span from cl group by all),
sc as (select *, greatest(max(arrival) over (partition by subject_id), 1) as last, max(n_voxels) over (partition by subject_id) as big, 1 - least(1, abs(x - middle) / (0.5 * span)) as central, count(*) over (partition by subject_id) as n from vs join bo using (subject_id)),
rv as (select *, 0.5 * (back - y) / span + 0.3 * central + 0.2 * n_voxels / big as sv, 0.4 * (1 - z / 3) + 0.35 * central + 0.25 * (1 - arrival / last) as sa from sc),
r1 as (select *, row_number() over (partition by subject_id order by sv desc, component) as place from rv),
r2 as (select *, row_number() over (partition by subject_id order by sa desc, component) as place2 from r1 where place > 1 or n = 1)
select subject_id, component, 'vein' as role, n_voxels, round(sv, 6) as role_score from r1 where place = 1 union all select subject_id, component, 'artery', n_voxels, round(sa, 6) from r2 where place2 = 1"""
#: The median over slices of each slice's median curve, from its own onset and from zero: rc (region, n_slices, frame, v), after c and region_map.
REGION_CURVES = """s as (select region, z, count(distinct voxel_id) as n from c join region_map using (label) group by region, z having n >= 3),
p as (select region, z, frame, median(v) as v from c join region_map using (label) semi join s using (region, z) group by region, z, frame),
lim as (select region, z, avg(v) filter (frame between 3 and 8) + greatest(4 * stddev_pop(v) filter (frame between 3 and 8), 0.05 * (max(v) - min(v)), 5e-4) as t from p group by region, z),
up as (select region, z, frame, min(v) over (partition by region, z order by frame rows between current row and 2 following) as low from p),
st as (select region, z, greatest(coalesce(min(frame) filter (frame between 8 and 61 and low > t), 9) - 1, 3) as i0 from up join lim using (region, z) group by region, z),
sh as (select region, z, frame, case when frame < i0 then 0 else v - min(v) over (partition by region, z, frame < i0) end as v from p join st using (region, z)),
rc as (select region, count(*) as n_slices, frame, median(v) as v from sh group by region, frame)"""

#: The slope k of the input curve's drift beside washout and its late mean: rates on a grid, the linear terms by partial regression.
RIGID = """y as (select frame, t - min(t) over () as x, c_a as y from ca where frame >= 44), ym as (select avg(x) as mx, avg(y) as my, regr_sxx(y, x) as sxx, regr_slope(y, x) as ky from y),
rt as (select i, 1e-6 * pow(2e6, i / 399.0) as r from (select unnest(range(400)) as i)), ex as (select i, r, x, y, exp(-r * x) as e from y, rt),
em as (select i, avg(e) as me, regr_slope(e, x) as ke from ex group by i),
re as (select i, r, ke, e - me - ke * (x - mx) as e, y - my - ky * (x - mx) as y from ex join em using (i), ym),
am as (select i, any_value(r) as r, any_value(ke) as ke, sum(e * y) / sum(e * e) as a from re group by i),
ss as (select i, any_value(am.r) as r, any_value(am.ke) as ke, any_value(a) as a, sum(pow(y - a * e, 2)) as sse from re join am using (i) group by i having any_value(a) >= 0),
bs as (select arg_min(r, (sse, i)) as r, arg_min(a * ke, (sse, i)) as wash from ss),
s as (select case when r between 3e-3 and 5e-2 then ky - wash else ky end as k, my as late from bs, ym)"""

#: Tissue curves as the queries of transit models make them: an uptake set by a curve's first values, plus a hundredth of the curve: y (voxel_id, l), input ca.
TISSUE = f"""{LONG}, {INPUT.replace('ca as', 'ca0 as')}, ca as (select frame, t, c_a * pow(frame / 6, 3) * exp(3 * (1 - frame / 6)) as c_a from ca0),
up as (select vec_id as voxel_id, (40 + 100 * abs(embedding[1]::double)) / 6000 as kt, 0.04 + 0.1 * abs(embedding[2]::double) as ve, 0.01 + 0.1 * abs(embedding[3]::double) as vp from embeddings),
bu as (select voxel_id, 0 as frame, 0.0::double as b from up union all
    select bu.voxel_id, bu.frame + 1, bu.b * exp(-kt / ve * (n.t - o.t)) + 0.5 * (n.t - o.t) * (o.c_a * exp(-kt / ve * (n.t - o.t)) + n.c_a) from bu join up using (voxel_id) join ca o on o.frame = bu.frame join ca n on n.frame = bu.frame + 1),
y as (select voxel_id, list((kt * b + vp * c_a + 0.01 * v) order by frame) as l from bu join up using (voxel_id) join ca using (frame) join c using (voxel_id, frame) group by voxel_id)"""
#: Fractional relaxations as a table of shapes, convolved with the input on a grid ten times as fine, and each curve's best shape.
MITTAG_LEFFLER = f"""with recursive {TISSUE},
al as (select i, 0.35 + i * 0.65 / 39 as alpha from (select unnest(range(40)) as i)), ta as (select unnest(range(44)) as j, 0.5 * pow(60.0, unnest(range(44)) / 43.0) as tau),
s as (select k, case when k < 220 then k * 5 / 219.0 else (5 + 1e-6) * pow(5e3 / (5 + 1e-6), (k - 220) / 219.0) end as s from (select unnest(range(440)) as k)),
un as (select -24 + u * 48 / 999.0 as u from (select unnest(range(1000)) as u)),
wt as (select i, exp(u) as rate, exp(u * alpha) / (exp(2 * alpha * u) + 2 * exp(alpha * u) * cos(alpha * pi()) + 1) as w from al, un where alpha < 0.9995),
rel as (select i, k, any_value(s) as s, sum(exp(-s * rate) * w) / sum(w) as g from wt, s group by i, k union all select i, k, s, exp(-s) from al, s where alpha >= 0.9995),
seg as (select i, k, s, g, lead(s) over w as s1, lead(g) over w as g1 from rel window w as (partition by i order by k)),
hf as (select i, any_value(s + (g - 0.5) / (g - g1) * (s1 - s)) as half from seg where g > 0.5 and g1 <= 0.5 group by i),
fine as (select f, f * 0.2463 as t from (select unnest(range(631)) as f)),
pl as (select j, tau, f, p.p, s.k from (select j, tau, f, t / tau as p from ta, fine) p asof join s on p.p >= s.s),
sh as (select pl.i, pl.j, tau, list(r order by f) as r from (select seg.i, j, tau, f, least(greatest(g + (p - s) / (s1 - s) * (g1 - g), 0), 1) as r from pl join seg using (k)) pl group by pl.i, pl.j, tau),
cf as (select f, o.c_a + (f % 10) / 10.0::double * (coalesce(n.c_a, o.c_a) - o.c_a) as c from fine join ca o on o.frame = f // 10 left join ca n on n.frame = f // 10 + 1),
cg as (select list(c order by f) as c from (select f, case when f = 630 then lag(c) over (order by f) else c end as c from cf)),
fr as (select frame, exp(ln(0.25) / 1800 * frame * 2.463) as w, list_reverse(c[1 : frame * 10 + 1]) as c from cg, (select unnest(range(64)) as frame)),
b as materialized (select i, j, tau, list(w * 0.2463 * list_dot_product(r[1 : frame * 10 + 1], c) order by frame) as b, any_value((list_sum(r) - (r[1] + r[631]) / 2) * 0.2463) as area from sh, fr group by i, j, tau),
wy as materialized (select voxel_id, (select list(w order by frame) from fr) as w, l from y), ww as (select voxel_id, list_transform(l, lambda v, k: v * w[k]) as l from wy),
fit as (select voxel_id, i, j, tau, area, list_dot_product(l, b) as yb, greatest(list_dot_product(b, b), 1e-30) as bb from ww, b),
best as (select voxel_id, arg_max((i, j, tau, area, yb / bb), yb * yb / bb) as r from fit group by voxel_id)
select voxel_id, round(case when r[5] > 0 then r[5] end * 6000, 6) as cbf, round(case when r[5] > 0 then alpha end, 6) as alpha, round(case when r[5] > 0 then r[3] end, 6) as tau,
    round(case when r[5] > 0 then r[3] * half end, 6) as tmed, round(case when r[5] > 0 then r[4] end, 6) as mtt_win from best join al on al.i = r[1] join hf on hf.i = r[1]"""

#: Each curve (vein) moved so that the peaks of the curve before it (artery) are met, and raised to their height.
ALIGNED = f"""with {PIECES}, lo as (select voxel_id, median(v) filter (frame < 8) as m from c group by voxel_id),
sm as (select voxel_id, frame, (u + coalesce(lag(u) over w, 0) + coalesce(lead(u) over w, 0)) / 3 as v from (select voxel_id, frame, v - lo.m as u from c join lo using (voxel_id)) window w as (partition by voxel_id order by frame)),
near as (select *, lag(v) over w as b, lead(v) over w as a from sm window w as (partition by voxel_id order by frame)),
p0 as (select voxel_id, arg_max(frame, (v, -frame)) as f from sm where v > 0 group by voxel_id),
p1 as (select voxel_id, arg_max(frame, (v, -frame)) as f from (select sm.* from sm join p0 using (voxel_id) where v > 0 and abs(frame - f) > 10) group by voxel_id),
pk as (select voxel_id, row_number() over (partition by voxel_id order by frame) as n, v, (frame + case when b is not null and a is not null and b - 2 * v + a <> 0 then least(greatest(0.5 * (b - a) / (b - 2 * v + a), -1), 1) else 0 end) * 2.463 as t
    from near join (select * from p0 union all select * from p1) q using (voxel_id) where frame = q.f),
ids as (select e.vec_id as voxel_id from embeddings e semi join embeddings o on o.vec_id = e.vec_id - 1),
mv as (select ids.voxel_id, coalesce(least(greatest(-median(x.t - o.t), -20), 20), 0) as shift, median(case when abs(x.v) > 1e-8 then o.v / x.v end) as ratio
    from ids left join pk x using (voxel_id) left join pk o on o.voxel_id = ids.voxel_id - 1 and o.n = x.n group by ids.voxel_id),
sc as (select voxel_id, shift, case when ratio >= 1 then ratio else 1 end as scale, f, f - shift / 2.463 as p from mv, (select unnest(range(64)) as f)),
pt as (select *, least(greatest(p, 0), 63) - least(floor(least(greatest(p, 0), 63)), 62) as u, least(floor(least(greatest(p, 0), 63)), 62) as i from sc)
select voxel_id, round(shift, 6) as shift_s, round(scale, 6) as scale, round(sum(case when p < 0 then 0 else {_CUBIC} end * scale), 6) as total from pt join h using (voxel_id, i) group by voxel_id, shift, scale"""
