"""DuckDB SQL oracles, one per catalog query.

Each oracle re-derives its fixture from the pre-registered driver tables and
computes the result independently (joins instead of windows, plain SQL
instead of the library's operators), aliasing every column to the name the
Spark query uses.
"""

from __future__ import annotations

# Fixture CTEs (DuckDB dialect).  Integer division by 2000/50 uses floor of a
# float division, like the Spark derivation.
PIXELS8 = """pixels8 as (
  select cast(floor(event_id/2000) as int) image_id,
         cast(floor((event_id%2000)/50) as int) y,
         cast(event_id%50 as int) x,
         cast(floor(value*100)%256 as int) b,
         cast((floor(value*100)*7 + user_id*13)%256 as int) g,
         cast((user_id*31 + event_id)%256 as int) r
  from events)"""

HDR = """hdr as (
  select cast(floor(event_id/2000) as int) image_id,
         cast(floor((event_id%2000)/50) as int) y,
         cast(event_id%50 as int) x,
         case when event_id%389=0 then cast(0 as double) else value*cast(0.01 as double) end b,
         case when event_id%389=0 then cast(0 as double)
              else value*cast(0.02 as double)*(1+user_id%3) end g,
         case when event_id%389=0 or event_id%97=0 then cast(0 as double)
              else value*cast(0.015 as double) end r
  from events)"""

GRAY = """gray8 as (
  select image_id, y, x,
         cast(floor(r*0.299::double + g*0.587::double + b*0.114::double) as int) gray
  from pixels8)"""

SOBEL_MASK = """sobel_mask as (
  select * from (values (-1,-1,-1),(-1,0,0),(-1,1,1),(0,-1,-2),(0,0,0),(0,1,2),
                        (1,-1,-1),(1,0,0),(1,1,1)) t(dy, dx, w))"""


def _with(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


ORACLES: dict[str, str] = {}

ORACLES["gray"] = _with(PIXELS8, GRAY) + "select image_id, y, x, gray from gray8"

# Zero border: a neighbour outside the image is absent from the left join.
ORACLES["sobel"] = _with(PIXELS8, GRAY, SOBEL_MASK) + """
select c.image_id, c.y, c.x,
       cast(least(255, greatest(0, coalesce(sum(n.gray*m.w), 0))) as int) gray
from gray8 c cross join sobel_mask m
left join gray8 n on n.image_id=c.image_id and n.y=c.y+m.dy and n.x=c.x+m.dx
group by c.image_id, c.y, c.x"""


def CMP(expr: str) -> str:
    """Round on the binary grid ``round(x * 2^20) / 2^20`` like the catalogue;
    adding 0.0 turns a negative zero into zero."""
    return f"(round(({expr}) * 1048576.0::double) / 1048576.0::double + 0.0)"


def Q8(expr: str) -> str:
    """Float in 0..1 -> 8 bit: x255, half-even, saturated, NULL -> 0."""
    return f"cast(least(255, greatest(0, round_even(coalesce({expr}, 0)*255, 0))) as int)"


def _tone_select(src: str, b: str, g: str, r: str) -> str:
    return (f"select image_id, y, x, {CMP(b)} b, {CMP(g)} g, {CMP(r)} r, "
            f"{Q8(b)} b8, {Q8(g)} g8, {Q8(r)} r8 from {src}")


def _exposure(v: str, alpha: str, beta: str) -> str:
    raw = f"least(256.0, greatest(-1.0, {v}*{alpha} + {beta}))"
    return f"least(255, greatest(0, cast(trunc({raw}) as int)))"


def _mask_values(mask) -> str:
    r = len(mask) // 2
    rows = [f"({i - r},{j - r},{mask[i][j]})" for i in range(len(mask))
            for j in range(len(mask))]
    return "(values " + ",".join(rows) + ")"


# Same fixed parameters as the catalogue (kept literal here on purpose: the
# oracle is an independent statement of the query).
CONVOLVE_MASK = (
    (1, 0, 0, 0, -1),
    (2, 1, 0, -1, -2),
    (3, 2, 1, -2, -3),
    (2, 1, 0, -1, -2),
    (0, 0, 1, 0, 0),
)

ORACLES["double_wrap"] = _with(PIXELS8, GRAY) + \
    "select image_id, y, x, (2*gray) % 256 gray from gray8"

ORACLES["exposure"] = _with(PIXELS8) + (
    "select image_id, y, x, "
    + ", ".join(f"{_exposure(c, '1.5::double', '-20.0::double')} {c}" for c in "bgr")
    + " from pixels8")

ORACLES["exposure_bracket"] = _with(PIXELS8) + (
    "select e.exposure_id, p.image_id, p.y, p.x, "
    + ", ".join(f"{_exposure('p.' + c, 'e.alpha', 'e.beta')} {c}" for c in "bgr")
    + " from pixels8 p cross join (values (0, 1.0::double, 25.0::double),"
      " (1, 1.0::double, -25.0::double), (2, 1.0::double, 50.0::double),"
      " (3, 1.0::double, -10.0::double)) e(exposure_id, alpha, beta)")

ORACLES["rgba_swizzle"] = _with(PIXELS8) + \
    "select image_id, y, x, r, g, b, 255 a from pixels8"

ORACLES["channel_split"] = _with(PIXELS8) + """
select image_id, y, x, 0 channel, b value from pixels8
union all select image_id, y, x, 1, g from pixels8
union all select image_id, y, x, 2, r from pixels8"""

DIMS = "dims as (select image_id, max(y) + 1 h, max(x) + 1 w from gray8 group by image_id)"

ORACLES["sobel_reflect101"] = _with(PIXELS8, GRAY, SOBEL_MASK, DIMS) + """
select c.image_id, c.y, c.x, cast(least(255, greatest(0, sum(n.gray*m.w))) as int) gray
from gray8 c join dims d on d.image_id = c.image_id cross join sobel_mask m
join gray8 n on n.image_id = c.image_id
 and n.y = case when c.y+m.dy < 0 then -(c.y+m.dy)
                when c.y+m.dy > d.h-1 then 2*(d.h-1)-(c.y+m.dy) else c.y+m.dy end
 and n.x = case when c.x+m.dx < 0 then -(c.x+m.dx)
                when c.x+m.dx > d.w-1 then 2*(d.w-1)-(c.x+m.dx) else c.x+m.dx end
group by c.image_id, c.y, c.x"""

ORACLES["sobel_abs"] = _with(PIXELS8, GRAY, SOBEL_MASK) + """
select c.image_id, c.y, c.x, cast(least(255, abs(coalesce(sum(n.gray*m.w), 0))) as int) gray
from gray8 c cross join sobel_mask m
left join gray8 n on n.image_id=c.image_id and n.y=c.y+m.dy and n.x=c.x+m.dx
group by c.image_id, c.y, c.x"""

ORACLES["convolve"] = _with(PIXELS8, GRAY) + f"""
select c.image_id, c.y, c.x,
       cast(least(255, greatest(0, coalesce(sum(n.gray*m.w), 0))) as int) gray
from gray8 c cross join {_mask_values(CONVOLVE_MASK)} m(dy, dx, w)
left join gray8 n on n.image_id=c.image_id and n.y=c.y+m.dy and n.x=c.x+m.dx
group by c.image_id, c.y, c.x"""

ORACLES["strip_assemble"] = _with(PIXELS8) + """
select image_id, y, cast(count(*) as int) n,
       string_agg(concat_ws(':', b, g, r), ' ' order by x) strip
from pixels8 group by image_id, y"""

# ------------------------------------------------------------------- HDR
ORACLES["hdr_scan"] = _with(HDR) + \
    f"select image_id, y, x, {CMP('b')} b, {CMP('g')} g, {CMP('r')} r from hdr"

ORACLES["luminance"] = _with(HDR) + (
    "select image_id, y, x, "
    + CMP("b*0.0722::double + g*0.7152::double + r*0.2126::double") + " lum from hdr")

XYY = """xyz as (
  select image_id, y, x,
         r*0.4124::double + g*0.3576::double + b*0.1805::double xx,
         r*0.2126::double + g*0.7152::double + b*0.0722::double yy,
         r*0.0193::double + g*0.1192::double + b*0.9505::double zz
  from hdr),
xyy as (
  select image_id, y, x, xx/nullif(xx+yy+zz, 0) cx, yy/nullif(xx+yy+zz, 0) cy,
         log10(0.0001::double + yy) log_y
  from xyz)"""

BINNED = """rng as (select image_id, min(log_y) lo, max(log_y) hi from xyy group by image_id),
binned as (
  select v.*, coalesce(least(1023, cast(floor(1024*(v.log_y - r.lo)/nullif(r.hi - r.lo, 0)) as int)), 0) bin
  from xyy v join rng r on r.image_id = v.image_id),
hist as (select image_id, bin, count(*) n from binned group by image_id, bin)"""

MAXS = """mx as (select image_id, greatest(0, max(greatest(b, g, r))) m from hdr group by image_id)"""

ORACLES["rgb_to_xyy"] = _with(HDR, XYY) + \
    f"select image_id, y, x, {CMP('cx')} cx, {CMP('cy')} cy, {CMP('log_y')} log_y from xyy"

ORACLES["max_sample"] = _with(HDR, MAXS) + f"select image_id, {CMP('m')} max_sample from mx"


def _log_map(v: str, m: str, q: str, k: str) -> str:
    return f"log10(1 + {q}*{v}) / nullif(log10(1 + {k}*{m}), 0)"


def _adaptive_map(v: str, m: str, q: str, k: str) -> str:
    expo = f"(ln({q}) / ln(0.5::double))"
    den = f"100.0::double*log10(1 + {m})*pow(ln(2 + 8*({v}/nullif({m}, 0))), {expo})"
    return f"{k}*ln(1 + {v}) / nullif({den}, 0)"


def _gamma_map(v: str, f: str, gm: str) -> str:
    return f"pow({v}*pow(2.0::double, {f}), 1.0::double/{gm})"


_Q, _K = "0.4::double", "1.2::double"

ORACLES["tone_log"] = _with(HDR, MAXS) + _tone_select(
    "hdr join mx using (image_id)",
    *[_log_map(c, "m", _Q, _K) for c in "bgr"])

ORACLES["tone_adaptive"] = _with(HDR, MAXS) + _tone_select(
    "hdr join mx using (image_id)",
    *[_adaptive_map(c, "m", _Q, _K) for c in "bgr"])

ORACLES["tone_gamma"] = _with(HDR) + _tone_select(
    "hdr", *[_gamma_map(c, _Q, _K) for c in "bgr"])

PARAMS = """params as (
  select distinct image_id, 0.4::double + 0.1::double*(image_id % 3) p1, 1.2::double p2
  from hdr)"""

ORACLES["tone_batch_params"] = _with(HDR, MAXS, PARAMS) + _tone_select(
    "hdr join mx using (image_id) join params using (image_id)",
    *[_adaptive_map(c, "m", "p1", "p2") for c in "bgr"])

ORACLES["lum_histogram"] = _with(HDR, XYY, BINNED) + "select image_id, bin, n from hist"

CDF = """cdf as (
  select image_id, bin, n,
         cast(sum(n) over (partition by image_id order by bin
                           rows between unbounded preceding and current row) as bigint) cdf,
         sum(n) over (partition by image_id) total
  from hist)"""

ORACLES["lum_cdf"] = _with(HDR, XYY, BINNED, CDF) + \
    f"select image_id, bin, n, cdf, {CMP('cdf / nullif(total, 0)')} cdf_norm from cdf"

HISTEQ = """mapped as (
  select b.image_id, b.y, b.x, b.bin, b.cx, b.cy, c.cdf / nullif(c.total, 0) y_new
  from binned b join cdf c on c.image_id = b.image_id and c.bin = b.bin),
back as (
  select image_id, y, x, bin, y_new, cx*(y_new/nullif(cy, 0)) x_new,
         (1 - cx - cy)*(y_new/nullif(cy, 0)) z_new
  from mapped),
rgb as (
  select image_id, y, x, bin,
         x_new*3.2406::double + y_new*(-1.5372)::double + z_new*(-0.4986)::double r,
         x_new*(-0.9689)::double + y_new*1.8758::double + z_new*0.0415::double g,
         x_new*0.0557::double + y_new*(-0.2040)::double + z_new*1.0570::double b
  from back)"""

ORACLES["histeq_tonemap"] = _with(HDR, XYY, BINNED, CDF, HISTEQ) + (
    f"select image_id, y, x, bin, {CMP('b')} b, {CMP('g')} g, {CMP('r')} r, "
     f"{Q8('b')} b8, {Q8('g')} g8, {Q8('r')} r8 from rgb")

# --------------------------------------------------------- linear algebra
CELLS = """cells as (
  select vec_id i, cast(unnest(range(len(embedding))) as int) j,
         cast(unnest(embedding) as double) v
  from embeddings)"""

GRAM = """gram as (
  select a.j i, b.j j, sum(a.v*b.v) v from cells a join cells b on a.i = b.i
  group by a.j, b.j)"""

ORACLES["vector_add"] = \
    f"select event_id i, {CMP('value + user_id*0.5::double')} v from events"

ORACLES["matmul_block"] = _with(CELLS, GRAM) + f"select i, j, {CMP('v')} v from gram"
ORACLES["matmul_gram"] = ORACLES["matmul_block"]

ORACLES["matmul_coo"] = f"""
with m as (select user_id i, event_id % 97 j, sum(value) v from events group by 1, 2)
select cast(a.j as int) i, cast(b.j as int) j, {CMP('sum(a.v*b.v)')} v
from m a join m b on a.i = b.i group by a.j, b.j"""

ORACLES["matmul_int"] = """
with m as (select event_id % 53 i, cast(floor(event_id/53) as bigint) % 37 j,
                  sum(cast(floor(value*100) as bigint)) v from events group by 1, 2)
select a.j i, b.j j, cast(sum(a.v*b.v) as bigint) v from m a join m b on a.i = b.i
group by a.j, b.j"""

CENTROIDS = """cent as (
  select k, label, avg(x) v
  from (select label, cast(unnest(range(len(embedding))) as int) k,
               cast(unnest(embedding) as double) x from embeddings)
  group by k, label)"""

ORACLES["matmul_rect"] = _with(CELLS, CENTROIDS) + f"""
select c.i, cast(t.label as int) j, {CMP('sum(c.v*t.v)')} v
from cells c join cent t on t.k = c.j
group by c.i, t.label"""

GRAY_PAIR = """ga as (
  select image_id, y, x,
         cast(floor(r*0.299::double + g*0.587::double + b*0.114::double) as int) gray
  from pixels8),
gb as (
  select image_id, y, x,
         cast(round_even(r*0.299::double + g*0.587::double + b*0.114::double, 0) as int) gray
  from pixels8),
pair as (
  select image_id, y, x, ga.gray a, gb.gray b
  from ga full join gb using (image_id, y, x))"""

ORACLES["matrix_diff"] = _with(PIXELS8, GRAY_PAIR) + \
    "select image_id, y, x, a, b from pair where a is distinct from b"

ORACLES["matrix_diff_summary"] = _with(PIXELS8, GRAY_PAIR) + """
select count(*) n_cells, count(case when a is distinct from b then 1 end) n_diff,
       cast(max(abs(a - b)) as int) max_abs_diff
from pair"""

BLOCKS = """blocks as (
  select event_id i, cast(ntile(7) over (order by event_id) - 1 as int) block from events)"""

ORACLES["row_blocks"] = _with(BLOCKS) + "select i, block from blocks"
ORACLES["row_block_extents"] = _with(BLOCKS) + \
    "select block, min(i) first_row, count(*) n_rows from blocks group by block"

# ---------------------------------------------------------------- clusters
VALS = "vals as (select value v, count(*) n from events group by value)"

C0 = """c0 as (
  select cast(r.range as int) cid,
         s.lo + (s.hi - s.lo)*(cast(r.range as int) + 0.5::double)/8 c
  from range(8) r, (select min(v) lo, max(v) hi from vals) s)"""


def _assign(name: str, centres: str) -> str:
    return f"""{name} as (
  select v, n, cid from (
    select v, n, cid, row_number() over (partition by v order by abs(v - c), cid) rn
    from vals, {centres}) t
  where rn = 1)"""


def _step(k: int) -> str:
    return ",\n".join([
        _assign(f"a{k}", f"c{k - 1}"),
        f"m{k} as (select cid, sum(n*v)/sum(n) c from a{k} group by cid)",
        f"c{k} as (select p.cid, coalesce(m.c, p.c) c from c{k - 1} p "
        f"left join m{k} m on m.cid = p.cid)",
    ])


ORACLES["value_histogram"] = _with(VALS) + "select v, n from vals"
ORACLES["nearest_centre"] = _with(VALS, C0, _assign("a1", "c0")) + "select v, n, cid from a1"
ORACLES["cluster_weighted_mean"] = _with(VALS, C0, _assign("a1", "c0")) + \
    f"select cid, {CMP('sum(n*n*v)/sum(n*n)')} mean from a1 group by cid"
ORACLES["lloyd_centres"] = _with(VALS, C0, _step(1), _step(2), _step(3)) + \
    f"select cid, {CMP('c')} c from c3"

# ----------------------------------------------------------------- vectors
POINTS = """pts as (
  select vec_id, cast(embedding as double[]) e from embeddings),
v0 as (
  select cast(row_number() over (order by md5(cast(vec_id as varchar) || ':42'), vec_id) - 1 as int) cid,
         e c
  from pts qualify cid < 16)"""


def _vector_assign(name: str, centres: str) -> str:
    return f"""{name} as (
  select vec_id, e, cid, list_distance(e, c) dist from pts, {centres}
  qualify row_number() over (partition by vec_id order by list_distance(e, c), cid) = 1)"""


def _vector_step(k: int) -> str:
    return ",\n".join([
        _vector_assign(f"va{k}", f"v{k - 1}"),
        f"vm{k} as (select cid, list(x order by j) c from (select cid, j, avg(x) x from ("
        f"select cid, unnest(e) x, unnest(range(len(e))) j from va{k}) group by cid, j) group by cid)",
        f"v{k} as (select p.cid, coalesce(m.c, p.c) c from v{k - 1} p "
        f"left join vm{k} m on m.cid = p.cid)",
    ])


VECTOR_STEPS = (POINTS, _vector_step(1), _vector_step(2), _vector_step(3))
ORACLES["kmeans_vectors"] = _with(*VECTOR_STEPS, _vector_assign("va4", "v3")) + \
    f"select vec_id, cid, {CMP('dist')} dist from va4"
ORACLES["kmeans_vector_centres"] = _with(*VECTOR_STEPS) + \
    f"select cid, j, {CMP('x')} c from (select cid, cast(unnest(range(len(c))) as int) j, " \
    "unnest(c) x from v3)"

# ----------------------------------------------------------------- timings
TIMINGS = """timings as (
  select event_type workload,
         case user_id%3 when 0 then 'naive' when 1 then 'const' else 'shared' end variant,
         value/cast(1000 as double) gpu,
         value*(2+event_id%5)/cast(1000 as double) cpu
  from events)"""

MEANS = """means as (
  select workload, variant, count(*) n_runs, avg(gpu) mean_gpu, avg(cpu) mean_cpu
  from timings group by workload, variant)"""

ORACLES["timing_mean"] = _with(TIMINGS, MEANS) + \
    f"select workload, variant, n_runs, {CMP('mean_gpu')} mean_gpu, {CMP('mean_cpu')} mean_cpu from means"

ORACLES["timing_speedup"] = _with(TIMINGS) + f"""
select workload, variant, {CMP('avg(cpu/nullif(gpu, 0))')} speedup
from timings group by workload, variant"""

ORACLES["timing_variant_ratio"] = _with(TIMINGS, MEANS) + f"""
select m.workload, m.variant, {CMP('b.mean_gpu / nullif(m.mean_gpu, 0)')} ratio
from means m left join (select workload, mean_gpu from means where variant = 'naive') b
  on b.workload = m.workload"""


# ----------------------------------------------------- k-means tone map (grid)
LUM = """lum as (
  select image_id, y, x, b, g, r, b*0.0722::double + g*0.7152::double + r*0.2126::double lum
  from hdr),
lvals as (select lum v, count(*) n from lum group by lum)"""

K0 = """k0 as (
  select cast(t.range as int) cid,
         s.lo + (s.hi - s.lo)*(cast(t.range as int) + 0.5::double)/256 c
  from range(256) t, (select min(v) lo, max(v) hi from lvals) s)"""


def _kassign(name: str, centres: str) -> str:
    return f"""{name} as (
  select v, n, cid from (
    select v, n, cid, row_number() over (partition by v order by abs(v - c), cid) rn
    from lvals, {centres}) t
  where rn = 1)"""


def _kstep(i: int) -> str:
    return ",\n".join([
        _kassign(f"ka{i}", f"k{i - 1}"),
        f"km{i} as (select cid, sum(n*v)/sum(n) c from ka{i} group by cid)",
        f"k{i} as (select p.cid, coalesce(m.c, p.c) c from k{i - 1} p "
        f"left join km{i} m on m.cid = p.cid)",
    ])


KMAP = """kfinal as (
  select a.v, w.mean from kfin a join (
    select cid, sum(n*n*v)/sum(n*n) mean from kfin group by cid) w on w.cid = a.cid),
kmapped as (
  select l.image_id, l.y, l.x, l.b*(f.mean/nullif(l.lum, 0)) b,
         l.g*(f.mean/nullif(l.lum, 0)) g, l.r*(f.mean/nullif(l.lum, 0)) r
  from lum l join kfinal f on f.v = l.lum)"""

ORACLES["kmeans_tonemap_grid"] = _with(
    HDR, LUM, K0, *[_kstep(i) for i in range(1, 6)], _kassign("kfin", "k5"), KMAP) + \
    _tone_select("kmapped", "b", "g", "r")


# ---------------------------------------------- k-means tone map per image
PLUM = """plum as (
  select image_id, y, x, b, g, r, b*0.0722::double + g*0.7152::double + r*0.2126::double lum
  from hdr),
pvals as (select image_id, lum v, count(*) n from plum group by image_id, lum),
prng as (select image_id, min(v) lo, max(v) hi from pvals group by image_id)"""

P0 = """p0 as (
  select s.image_id, cast(t.range as int) cid,
         s.lo + (s.hi - s.lo)*(cast(t.range as int) + 0.5::double)/256 c
  from range(256) t, prng s)"""


def _passign(name: str, centres: str) -> str:
    return f"""{name} as (
  select image_id, v, n, cid from (
    select a.image_id, a.v, a.n, c.cid,
           row_number() over (partition by a.image_id, a.v order by abs(a.v - c.c), c.cid) rn
    from pvals a join {centres} c on c.image_id = a.image_id) t
  where rn = 1)"""


def _pstep(i: int) -> str:
    return ",\n".join([
        _passign(f"pa{i}", f"p{i - 1}"),
        f"pm{i} as (select image_id, cid, sum(n*v)/sum(n) c from pa{i} group by image_id, cid)",
        f"p{i} as (select p.image_id, p.cid, coalesce(m.c, p.c) c from p{i - 1} p "
        f"left join pm{i} m on m.image_id = p.image_id and m.cid = p.cid)",
    ])


PMAP = """pfinal as (
  select a.image_id, a.v, w.mean from pfin a join (
    select image_id, cid, sum(n*n*v)/sum(n*n) mean from pfin group by image_id, cid) w
    on w.image_id = a.image_id and w.cid = a.cid),
pmapped as (
  select l.image_id, l.y, l.x, l.b*(f.mean/nullif(l.lum, 0)) b,
         l.g*(f.mean/nullif(l.lum, 0)) g, l.r*(f.mean/nullif(l.lum, 0)) r
  from plum l join pfinal f on f.image_id = l.image_id and f.v = l.lum)"""

ORACLES["kmeans_tonemap_per_image"] = _with(
    HDR, PLUM, P0, *[_pstep(i) for i in range(1, 6)], _passign("pfin", "p5"), PMAP) + \
    _tone_select("pmapped", "b", "g", "r")


# ------------------------------------------------------ random k-means start
def _start(name: str, values: str, by_image: bool) -> str:
    key = "image_id, " if by_image else ""
    part = "partition by image_id " if by_image else ""
    order = "md5(cast(cast(floor(v*1048576.0::double) as bigint) as varchar) || ':42'), v"
    return (f"{name} as (select {key}cast(rn - 1 as int) cid, v c from (select {key}v, "
            f"row_number() over ({part}order by {order}) rn from {values}) t where rn <= 256)")


ORACLES["kmeans_tonemap"] = _with(
    HDR, LUM, _start("k0", "lvals", False), *[_kstep(i) for i in range(1, 6)],
    _kassign("kfin", "k5"), KMAP) + _tone_select("kmapped", "b", "g", "r")

ORACLES["kmeans_tonemap_per_image_random"] = _with(
    HDR, PLUM, _start("p0", "pvals", True), *[_pstep(i) for i in range(1, 6)],
    _passign("pfin", "p5"), PMAP) + _tone_select("pmapped", "b", "g", "r")

# ------------------------------------------------------- undefined samples
# A NaN sample counts like a missing one, so the oracle has NULL for both.
HOLES = HDR.replace("hdr as (", "hdr_whole as (") + """,
hdr as (
  select image_id, y, x, b,
         case when (image_id*2000 + y*50 + x) % 103 = 5 then null else g end g,
         case when (image_id*2000 + y*50 + x) % 101 = 7 then null else r end r
  from hdr_whole)"""

ORACLES["tone_log_holes"] = _with(HOLES, MAXS) + _tone_select(
    "hdr join mx using (image_id)", *[_log_map(c, "m", _Q, _K) for c in "bgr"])

_BINNED_HOLES = BINNED.replace(
    "select v.*, coalesce(", "select v.*, case when v.log_y is not null then coalesce(").replace(
    "as int)), 0) bin", "as int)), 0) end bin").replace(
    "from binned group by image_id, bin", "from binned where bin is not null group by image_id, bin")
_HISTEQ_HOLES = HISTEQ.replace("from binned b join cdf c", "from binned b left join cdf c")

ORACLES["histeq_tonemap_holes"] = _with(HOLES, XYY, _BINNED_HOLES, CDF, _HISTEQ_HOLES) + (
    f"select image_id, y, x, coalesce(bin, -1) bin, {CMP('b')} b, {CMP('g')} g, {CMP('r')} r, "
    f"{Q8('b')} b8, {Q8('g')} g8, {Q8('r')} r8 from rgb")

_LUM_HOLES = LUM.replace("from lum group by", "from lum where lum is not null group by")
_KMAP_HOLES = KMAP.replace("from lum l join kfinal", "from lum l left join kfinal")
_PLUM_HOLES = PLUM.replace("from plum group by", "from plum where lum is not null group by")
_PMAP_HOLES = PMAP.replace("from plum l join pfinal", "from plum l left join pfinal")

ORACLES["kmeans_tonemap_holes"] = _with(
    HOLES, _LUM_HOLES, K0, *[_kstep(i) for i in range(1, 6)], _kassign("kfin", "k5"),
    _KMAP_HOLES) + _tone_select("kmapped", "b", "g", "r")

ORACLES["kmeans_tonemap_per_image_holes"] = _with(
    HOLES, _PLUM_HOLES, P0, *[_pstep(i) for i in range(1, 6)], _passign("pfin", "p5"),
    _PMAP_HOLES) + _tone_select("pmapped", "b", "g", "r")

# ------------------------------------------------------ remaining operators
ORACLES["convolve_reflect101"] = _with(PIXELS8, GRAY, DIMS) + f"""
select c.image_id, c.y, c.x, cast(least(255, greatest(0, sum(n.gray*m.w))) as int) gray
from gray8 c join dims d on d.image_id = c.image_id
cross join {_mask_values(CONVOLVE_MASK)} m(dy, dx, w)
join gray8 n on n.image_id = c.image_id
 and n.y = case when c.y+m.dy < 0 then -(c.y+m.dy)
                when c.y+m.dy > d.h-1 then 2*(d.h-1)-(c.y+m.dy) else c.y+m.dy end
 and n.x = case when c.x+m.dx < 0 then -(c.x+m.dx)
                when c.x+m.dx > d.w-1 then 2*(d.w-1)-(c.x+m.dx) else c.x+m.dx end
group by c.image_id, c.y, c.x"""

PROMOTED = """promoted as (
  select cast(floor(event_id/2000) as int) image_id,
         cast(floor((event_id%2000)/50) as int) y, cast(event_id%50 as int) x, value,
         [3, 1, 4, 2][cast(floor(event_id/2000) as int) % 4 + 1] n
  from events)"""

ORACLES["hdr_promote"] = _with(PROMOTED) + f"""
select image_id, y, x, {CMP('value*0.01::double')} b,
       {CMP('value*0.01::double*(case when n = 1 then 1 else 2 end)')} g,
       {CMP('value*0.01::double*(case when n = 1 then 1 else 3 end)')} r
from promoted where n <> 2"""

ORACLES["hdr_rejects"] = _with(PROMOTED) + """
select distinct image_id, n n_channels, 'image must be colour' reason from promoted where n = 2"""

LINES = """lines as (
  select case when event_id%13 = 0 then a || ' seconds' when event_id%17 = 0 then '1 2 3 4'
              when event_id%19 = 0 then '  ' when event_id%3 = 0 then a || ' ' || u || ' 7'
              when event_id%3 = 1 then a || ', ' || u else a end line,
         'img' || event_id%5 || '.jpg' workload, case when user_id%2 = 0 then 'CM' else '' end variant,
         case when event_id%13 = 0 then 'not a number' when event_id%17 = 0 then 'wrong number of fields' end reason,
         event_id%13 <> 0 and event_id%17 <> 0 and event_id%19 <> 0 ok,
         event_id%3 layout, a::double a, u::double u
  from (select *, cast(cast(floor(value) as bigint) as varchar) a, cast(user_id as varchar) u from events))"""

ORACLES["timing_log_rows"] = _with(LINES) + """
select workload, variant, case when layout = 1 then u else a end gpu,
       case when layout = 0 then u when layout = 1 then a end cpu,
       case when layout = 0 then 7.0::double end ratio,
       case when layout = 0 then 's' else 'ms' end unit, 'logs/' || workload || variant || 'Times' file
from lines where ok"""

ORACLES["timing_log_rejects"] = _with(LINES) + """
select 'logs/' || workload || variant || 'Times' file, line, reason from lines
where reason is not null"""

ORACLES["scale_hdr"] = _with(HDR) + (
    f"select image_id, y, x, {CMP('b*255')} b, {CMP('g*255')} g, {CMP('r*255')} r from hdr")
ORACLES["rgba_round_trip"] = _with(PIXELS8) + "select image_id, y, x, b, g, r from pixels8"
ORACLES["channel_merge"] = ORACLES["rgba_round_trip"]

ORACLES["image_type_name"] = """
select event_id, cast(event_id % 64 as int) code,
       ['8U', '8S', '16U', '16S', '32S', '32F', '64F', 'User'][event_id % 8 + 1] || 'C'
       || cast(cast(floor((event_id % 64)/8) as int) + 1 as varchar) name
from events"""

ORACLES["lum_cdf_exclusive"] = _with(HDR, XYY, BINNED, CDF) + f"""
select image_id, bin, n, cdf - n cdf,
       {CMP('(cdf - n) / nullif(total - coalesce(last_n, 0), 0)')} cdf_norm
from cdf left join (select image_id, n last_n from hist where bin = 1023) using (image_id)"""

ORACLES["cluster_mean"] = _with(VALS, C0, _assign("a1", "c0")) + \
    f"select cid, {CMP('sum(n*v)/sum(n)')} mean from a1 group by cid"


def _mode(mode: str, src: str, cols: list[str]) -> str:
    return (f"select image_id, y, x, " + ", ".join(f"{CMP(e)} {c}" for e, c in zip(cols, "bgr"))
            + f", '{mode}' \"mode\" from {src}")


ORACLES["tone_dispatch"] = _with(HDR, MAXS) + " union all ".join([
    _mode("L", "hdr join mx using (image_id)", [_log_map(c, "m", _Q, _K) for c in "bgr"]),
    _mode("a", "hdr join mx using (image_id)", [_adaptive_map(c, "m", _Q, _K) for c in "bgr"]),
    _mode("G", "hdr", [_gamma_map(c, _Q, _K) for c in "bgr"])])

ORACLES["write_8bit"] = _with(HDR, MAXS) + (
    "select image_id, y, x, " + ", ".join(
        f"{Q8(_log_map(c, 'm', _Q, _K))} {c}" for c in "bgr")
    + " from hdr join mx using (image_id)")


# ------------------------------------------------- tables without a dense index
LINE_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"

ORACLES["row_blocks_by_order"] = f"""
select {LINE_ORDER}, row_number() over (order by {LINE_ORDER}) - 1 i,
       cast(ntile(7) over (order by {LINE_ORDER}) - 1 as int) block
from lineitem"""

ORACLES["vector_add_by_order"] = """
with a as (select row_number() over (order by ts, event_id) - 1 i, value v from events),
b as (select row_number() over (order by o_totalprice, o_orderkey) - 1 i, o_custkey*0.5::double v
      from orders)
select i, a.v + b.v v from a join b using (i)"""


# ------------------------------------------------------------------ packed tiles
for _name in ("sobel", "sobel_reflect101", "convolve", "convolve_reflect101", "gray"):
    ORACLES[f"{_name}_tiles"] = ORACLES[_name]

ORACLES["convolve_large_mask"] = _with(PIXELS8, GRAY) + """
select c.image_id, c.y, c.x, cast(sum(p.gray *
    (((p.y - c.y + 15) % 4 + 1) * ((p.x - c.x + 15) % 5 - 2) + p.y - c.y)) as bigint) gray
from gray8 c join gray8 p on p.image_id = c.image_id
  and p.y between c.y - 15 and c.y + 15 and p.x between c.x - 15 and c.x + 15
group by c.image_id, c.y, c.x"""


# ------------------------------------------------------------ uneven inner indices
ORACLES["matmul_sparse"] = """
with m as (
  select event_id % 997 i, case when event_id % 3 = 0 then 0 else user_id + 1 end k,
         sum(cast(floor(value*100) as bigint)) v from events group by 1, 2)
select a.i, b.i j, cast(sum(a.v*b.v) as bigint) v from m a join m b on a.k = b.k where b.i < 400
group by a.i, b.i"""


# ------------------------------------------------------- raster files, appended logs
ORACLES["raster_color"] = _with(PIXELS8) + \
    "select cast(image_id as bigint) image_id, y, x, b, g, r from pixels8"
ORACLES["raster_gray"] = _with(PIXELS8) + """
select cast(image_id as bigint) image_id, y, x,
       cast(round_even(r*0.299::double + g*0.587::double + b*0.114::double, 0) as int) gray
from pixels8"""
ORACLES["raster_rgba"] = _with(PIXELS8) + \
    "select cast(image_id as bigint) image_id, y, x, r, g, b, cast(x*5 % 256 as int) a from pixels8"
ORACLES["raster_sobel"] = \
    f"select cast(image_id as bigint) image_id, y, x, gray from ({ORACLES['sobel']})"
ORACLES["timing_append_once"] = """
select event_type workload,
       case user_id%3 when 0 then 'naive' when 1 then 'const' else 'shared' end variant, event_id,
       value/cast(1000 as double) gpu, value*(2+event_id%5)/cast(1000 as double) cpu
from events"""


# --------------------------------------------------- co-located joins, block digests
ORACLES["vector_add_bucketed"] = ORACLES["vector_add"]
ORACLES["matrix_diff_bucketed"] = ORACLES["matrix_diff"]
ORACLES["matrix_diff_blocks"] = _with(PIXELS8, GRAY_PAIR) + """
select image_id, y, x, a, b from pair where a is distinct from b and image_id % 3 = 0 and y < 5"""

ORACLES["tone_store_params"] = f"select * from ({ORACLES['tone_batch_params']}) where image_id % 4 = 1"

_LUM = "r*0.299::double + g*0.587::double + b*0.114::double"
ORACLES["pixel_functions_sql"] = _with(PIXELS8) + f"""
select image_id, y, x, cast(floor({_LUM}) as int) gray, cast(round_even({_LUM}, 0) as int) gray_even,
       {_exposure('b', '1.5::double', '(-20.0::double)')} exposed, cast(2*g % 256 as int) doubled,
       cast(least(255, greatest(0, r - g)) as int) clamped, cast(abs(r - g) as int) absolute,
       {Q8('(b / 300::double)')} quantised,
       (['8U', '8S', '16U', '16S', '32S', '32F', '64F', 'User'])[r % 8 + 1] || 'C' ||
         cast(r // 8 + 1 as varchar) as name
from pixels8"""
