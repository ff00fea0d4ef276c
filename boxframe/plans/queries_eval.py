"""Registered queries: pairs, IoU, counts, P/R/F1, weighted metrics, AP, overlays."""

from __future__ import annotations

from pyspark.sql import functions as F

from boxframe.operators import boxes as B
from boxframe.operators import metrics as M
from boxframe.plans.catalog import register

_I = ("greatest(0, least(g.xmax, d.xmax) - greatest(g.xmin, d.xmin))"
      " * greatest(0, least(g.ymax, d.ymax) - greatest(g.ymin, d.ymin))")
_U = f"(g.xmax - g.xmin) * (g.ymax - g.ymin) + (d.xmax - d.xmin) * (d.ymax - d.ymin) - ({_I})"
_IOU = f"case when {_U} > 0 then cast({_I} as double) / ({_U}) else 0 end"

_VALID = """valid as (select * from scaled where xmin is not null and ymin is not null and xmax is not null
    and ymax is not null and xmax > xmin and ymax > ymin)"""
_PAIRS = f"""pairs as (select g.ImageID, g.box_id, d.det_id, {_IOU} as iou
    from valid g join detections d on g.ImageID = d.ImageID where {_I} > 0)"""
_BEST = """best as (select g.ImageID, g.box_id, coalesce(max(p.iou), 0) as best_iou
    from valid g left join pairs p on g.box_id = p.box_id group by g.ImageID, g.box_id)"""
_SIZES = """sizes as (select g.ImageID, g.n_gt, coalesce(d.n_pred, 0) as n_pred
    from (select ImageID, count(*) as n_gt from valid group by ImageID) g
    left join (select ImageID, count(*) as n_pred from detections group by ImageID) d on g.ImageID = d.ImageID)"""
_O2O = """p5 as (select * from pairs where iou > 0.5),
bd as (select det_id, box_id, iou from (select *, row_number() over (partition by det_id order by iou desc, box_id) as rn
    from p5) t where rn = 1),
m as (select box_id, det_id from (select *, row_number() over (partition by box_id order by iou desc, det_id) as rn
    from bd) t where rn = 1)"""
_COUNTS = """counts as (select s.ImageID, s.n_gt, s.n_pred, t.tp, s.n_pred - t.tp as fp, s.n_gt - t.tp as fn
    from sizes s join (select ImageID, count(*) filter (where best_iou > 0.5) as tp from best group by ImageID) t
    on s.ImageID = t.ImageID)"""
_PRF = """prf as (select ImageID, p as precision, r as recall, case when p + r > 0 then 2 * (p * r) / (p + r) else 0 end as f1
    from (select ImageID, case when tp + fp > 0 then cast(tp as double) / (tp + fp) else 0 end as p,
                 case when tp + fn > 0 then cast(tp as double) / (tp + fn) else 0 end as r from counts) t)"""

_EV = ["scaled", "detections"]


def _gt(fx):
    return B.drop_invalid(fx.scaled)


def _pairs(fx, same_label=False):
    return M.iou_pairs(_gt(fx), fx.detections, same_label=same_label)


@register(
    "label_pairs_weighted",
    views=_EV,
    extra_ctes=f"""{_VALID},\n{_PAIRS},\n{_O2O},
lp as (select g.LabelName as y_true, coalesce(d.LabelName, '__none__') as y_pred
       from valid g left join m on g.box_id = m.box_id left join detections d on d.det_id = m.det_id
       union all
       select '__none__' as y_true, d.LabelName as y_pred from detections d
       where d.det_id not in (select det_id from m))""",
    sql="select y_true, y_pred, count(*) as n from lp group by y_true, y_pred",
)
def q_label_pairs(fx):
    gt, det = _gt(fx), fx.detections
    m = M.match_one_to_one(_pairs(fx))
    return M.label_pairs(gt, det, m).groupBy("y_true", "y_pred").agg(F.count(F.lit(1)).alias("n"))


@register("iou_pairs", views=_EV, extra_ctes=f"{_VALID},\n{_PAIRS}", sql="select ImageID, box_id, det_id, iou from pairs")
def q_iou_pairs(fx):
    return _pairs(fx).select("ImageID", "box_id", "det_id", "iou")


@register("iou_pairs_crowded", views=_EV, extra_ctes=f"{_VALID},\n{_PAIRS}", sql="select ImageID, box_id, det_id, iou from pairs")
def q_iou_pairs_crowded(fx):
    """Images of over 16 candidate pairs (about half of them) on levelled grids, the others joined per image."""
    from boxframe.operators.pairs import hot_images, overlap_pairs

    gt, det = _gt(fx), fx.detections
    return overlap_pairs(gt, det, cell=hot_images(gt, det, max_candidates=16, levels=True)).select("ImageID", "box_id", "det_id", "iou")


def _in_buckets(fx, max_rows_per_key: int):
    """Truth and detections as tables in buckets of the image, written for this query."""
    from boxframe.session import scratch_path
    from boxframe.sources.bucketed import write_bucketed

    root = scratch_path(fx.spark, "bucketed")
    return (write_bucketed(_gt(fx), f"{root}/truth", max_rows_per_key=max_rows_per_key),
            write_bucketed(fx.detections, f"{root}/detections", max_rows_per_key=max_rows_per_key))


@register("iou_pairs_bucketed", views=_EV, extra_ctes=f"{_VALID},\n{_PAIRS}", sql="select ImageID, box_id, det_id, iou from pairs")
def q_iou_pairs_bucketed(fx):
    """The pairs of tables in buckets; images of more than 4 boxes a side lie beside the buckets."""
    from boxframe.operators.pairs import bucketed_pairs

    return bucketed_pairs(*_in_buckets(fx, 4)).select("ImageID", "box_id", "det_id", "iou")


@register(
    "counts_bucketed",
    views=_EV,
    extra_ctes=f"{_VALID},\n{_PAIRS},\n{_BEST},\n{_SIZES},\n{_COUNTS}",
    sql="select ImageID, n_gt, n_pred, tp, fp, fn from counts",
)
def q_counts_bucketed(fx):
    from boxframe.operators.pairs import bucketed_pairs
    from boxframe.sources.bucketed import MAX_ROWS_PER_KEY

    gt, det = _in_buckets(fx, MAX_ROWS_PER_KEY)
    return M.detection_counts(gt.rows, det.rows, bucketed_pairs(gt, det), mode="per_image")


@register("best_iou", views=_EV, extra_ctes=f"{_VALID},\n{_PAIRS},\n{_BEST}", sql="select ImageID, box_id, best_iou from best")
def q_best_iou(fx):
    return M.best_iou(_gt(fx), _pairs(fx))


@register(
    "counts_per_image",
    views=_EV,
    extra_ctes=f"{_VALID},\n{_PAIRS},\n{_BEST},\n{_SIZES},\n{_COUNTS}",
    sql="select ImageID, n_gt, n_pred, tp, fp, fn from counts",
)
def q_counts_per_image(fx):
    return M.detection_counts(_gt(fx), fx.detections, _pairs(fx), mode="per_image")


@register(
    "counts_cumulative",
    views=_EV,
    extra_ctes=f"{_VALID},\n{_PAIRS},\n{_BEST},\n{_SIZES}",
    sql="""
select ImageID, n_gt, n_pred, tp, n_pred - tp as fp, n_gt - tp as fn
from (select s.ImageID, s.n_gt, s.n_pred,
             cast(sum(t.tp) over (order by s.ImageID rows between unbounded preceding and current row) as bigint) as tp
      from sizes s join (select ImageID, count(*) filter (where best_iou > 0.5) as tp from best group by ImageID) t
      on s.ImageID = t.ImageID) c
""",
)
def q_counts_cumulative(fx):
    return M.detection_counts(_gt(fx), fx.detections, _pairs(fx), mode="cumulative")


@register(
    "counts_one_to_one",
    views=_EV,
    extra_ctes=f"{_VALID},\n{_PAIRS},\n{_SIZES},\n{_O2O}",
    sql="""
select s.ImageID, s.n_gt, s.n_pred, coalesce(t.tp, 0) as tp, s.n_pred - coalesce(t.tp, 0) as fp,
       s.n_gt - coalesce(t.tp, 0) as fn
from sizes s left join (select g.ImageID, count(*) as tp from m join valid g on m.box_id = g.box_id
                        group by g.ImageID) t on s.ImageID = t.ImageID
""",
)
def q_counts_one_to_one(fx):
    return M.detection_counts(_gt(fx), fx.detections, _pairs(fx), mode="one_to_one")


@register(
    "prf_per_image",
    views=_EV,
    extra_ctes=f"{_VALID},\n{_PAIRS},\n{_BEST},\n{_SIZES},\n{_COUNTS},\n{_PRF}",
    sql="select ImageID, precision, recall, f1 from prf",
)
def q_prf_per_image(fx):
    return M.prf_per_image(M.detection_counts(_gt(fx), fx.detections, _pairs(fx)))


@register(
    "macro_summary",
    views=_EV,
    extra_ctes=f"{_VALID},\n{_PAIRS},\n{_BEST},\n{_SIZES},\n{_COUNTS},\n{_PRF}",
    sql="""
select round(b.mean_iou, 6) as mean_iou, round(p.mean_precision, 6) as mean_precision,
       round(p.mean_recall, 6) as mean_recall, round(p.mean_f1, 6) as mean_f1, b.n_boxes, p.n_images
from (select avg(best_iou) as mean_iou, count(*) as n_boxes from best) b,
     (select avg(precision) as mean_precision, avg(recall) as mean_recall, avg(f1) as mean_f1,
             count(*) as n_images from prf) p
""",
)
def q_macro_summary(fx):
    gt, pairs = _gt(fx), _pairs(fx)
    best = M.best_iou(gt, pairs)
    prf = M.prf_per_image(M.detection_counts(gt, fx.detections, pairs))
    return M.macro_summary(best, prf)


@register(
    "weighted_prf",
    views=_EV,
    extra_ctes=f"""{_VALID},\n{_PAIRS},\n{_O2O},
lp as (select g.LabelName as y_true, coalesce(d.LabelName, '__none__') as y_pred
       from valid g left join m on g.box_id = m.box_id left join detections d on d.det_id = m.det_id
       union all
       select '__none__' as y_true, d.LabelName as y_pred from detections d
       where d.det_id not in (select det_id from m)),
per as (select s.c, s.support,
               case when coalesce(pr.n_pred, 0) > 0 then cast(coalesce(h.tp, 0) as double) / pr.n_pred else 0 end as p,
               case when s.support > 0 then cast(coalesce(h.tp, 0) as double) / s.support else 0 end as r
        from (select y_true as c, count(*) as support from lp group by y_true) s
        left join (select y_pred as c, count(*) as n_pred from lp group by y_pred) pr on s.c = pr.c
        left join (select y_true as c, count(*) as tp from lp where y_true = y_pred group by y_true) h on s.c = h.c
        where s.c <> '__none__'),
per2 as (select *, case when p + r > 0 then 2 * (p * r) / (p + r) else 0 end as f from per)""",
    sql="""
select round(sum(support * p) / cast(sum(support) as double), 6) as precision,
       round(sum(support * r) / cast(sum(support) as double), 6) as recall,
       round(sum(support * f) / cast(sum(support) as double), 6) as f1
from per2
""",
)
def q_weighted_prf(fx):
    gt, det = _gt(fx), fx.detections
    return M.weighted_prf_matched(gt, det, M.labelled_matches(gt, det))


_VOC_WIN = """bestd as (select det_id, box_id, iou from (select *, row_number() over (partition by det_id order by iou desc, box_id) as rn
          from pl) t where rn = 1),
thr as (select unnest({thresholds}::double[]) as iou_thr),
win as (select det_id, iou_thr from (
          select b.det_id, t.iou_thr, row_number() over (partition by t.iou_thr, b.box_id order by d.score desc, b.det_id) as rn
          from bestd b join thr t on b.iou > t.iou_thr join detections d on d.det_id = b.det_id) x where rn = 1)"""

# Greedy matching in score order, one detection of each (threshold, image, class) per recursion step.
_COCO_WIN = """thr as (select unnest({thresholds}::double[]) as iou_thr),
opts as (select t.iou_thr, d.ImageID, d.LabelName, d.det_id, d.score,
                list(p.box_id order by p.iou desc, p.box_id desc) as boxes
         from pl p join thr t on p.iou >= least(t.iou_thr, 1 - 1e-10) join detections d on d.det_id = p.det_id
         group by t.iou_thr, d.ImageID, d.LabelName, d.det_id, d.score),
turns as (select *, row_number() over (partition by iou_thr, ImageID, LabelName order by score desc, det_id) as turn
          from opts),
played as (select iou_thr, ImageID, LabelName, turn, det_id, boxes[1] as pick, [boxes[1]] as taken from turns where turn = 1
           union all
           select iou_thr, ImageID, LabelName, turn, det_id, pick,
                  case when pick is null then taken else list_append(taken, pick) end as taken
           from (select t.iou_thr, t.ImageID, t.LabelName, t.turn, t.det_id, p.taken,
                        list_filter(t.boxes, lambda x: not list_contains(p.taken, x))[1] as pick
                 from played p join turns t on t.iou_thr = p.iou_thr and t.ImageID = p.ImageID
                      and t.LabelName = p.LabelName and t.turn = p.turn + 1) s),
win as (select det_id, iou_thr from played where pick is not null)"""


def _ap_ctes(thresholds: str, win: str = _VOC_WIN) -> str:
    return f"""{_VALID},
pl as (select g.box_id, d.det_id, {_IOU} as iou
       from valid g join detections d on g.ImageID = d.ImageID and g.LabelName = d.LabelName where {_I} > 0),
{win.replace("{thresholds}", thresholds)},
ngt as (select LabelName, count(*) as n_gt from valid group by LabelName),
dt as (select d.det_id, d.LabelName, d.score, t.iou_thr, case when w.det_id is null then 0 else 1 end as tp, n.n_gt
       from detections d join ngt n on d.LabelName = n.LabelName cross join thr t
       left join win w on w.det_id = d.det_id and w.iou_thr = t.iou_thr),
rk as (select *, row_number() over (partition by LabelName, iou_thr order by score desc, det_id) as k,
              sum(tp) over (partition by LabelName, iou_thr order by score desc, det_id
                            rows between unbounded preceding and current row) as ctp
       from dt),
fk as (select *, cast(ctp as double) / k as prec, (100 * ctp) // n_gt as f from rk),
env as (select *, max(prec) over (partition by LabelName, iou_thr order by score asc, det_id desc
                                 rows between unbounded preceding and current row) as env,
               coalesce(lag(f) over (partition by LabelName, iou_thr order by score desc, det_id), -1) as fprev
        from fk),
ap0 as (select LabelName, iou_thr, sum(env * (f - fprev)) / 101.0 as ap from env group by LabelName, iou_thr),
ap as (select n.LabelName, t.iou_thr, coalesce(a.ap, 0) as ap from ngt n cross join thr t
       left join ap0 a on a.LabelName = n.LabelName and a.iou_thr = t.iou_thr)"""


_THR10 = "[" + ", ".join(str(t) for t in M.IOU_THRESHOLDS) + "]"


@register(
    "average_precision_50",
    views=_EV,
    extra_ctes=_ap_ctes("[0.5]"),
    sql="select LabelName, round(ap, 6) as ap from ap",
)
def q_ap50(fx):
    ap = M.average_precision(_gt(fx), fx.detections, thresholds=[0.5])
    return ap.select("LabelName", F.round("ap", 6).alias("ap"))


@register(
    "map_50_95",
    views=_EV,
    extra_ctes=_ap_ctes(_THR10),
    sql="select round(avg(ap), 6) as map from ap",
)
def q_map(fx):
    return M.mean_average_precision(M.average_precision(_gt(fx), fx.detections))


@register(
    "ap_by_threshold",
    views=_EV,
    extra_ctes=_ap_ctes(_THR10),
    sql="select iou_thr, round(avg(ap), 6) as map from ap group by iou_thr",
)
def q_ap_by_threshold(fx):
    ap = M.average_precision(_gt(fx), fx.detections)
    return ap.groupBy("iou_thr").agg(F.round(F.avg("ap"), 6).alias("map"))


@register(
    "overlay_rows",
    views=_EV,
    extra_ctes=_VALID,
    sql="""
select ImageID, 'truth' as kind, box_id as obj_id, xmin as x, ymin as y, xmax - xmin as w, ymax - ymin as h,
       cast(null as varchar) as caption, 'green' as color from valid
union all
select ImageID, 'prediction' as kind, det_id as obj_id, xmin as x, ymin as y, xmax - xmin as w, ymax - ymin as h,
       printf('%s (%.2f)', LabelName, score) as caption, 'red' as color from detections where score >= 0.5
""",
)
def q_overlay_rows(fx):
    from boxframe.operators.infer import overlay_rows

    return overlay_rows(_gt(fx), fx.detections, score_threshold=0.5)


@register(
    "map_coco",
    views=_EV,
    extra_ctes=_ap_ctes(_THR10, _COCO_WIN),
    recursive=True,
    sql="select iou_thr, round(avg(ap), 6) as map from ap group by iou_thr",
)
def q_map_coco(fx):
    ap = M.average_precision(_gt(fx), fx.detections, matching="coco")
    return ap.groupBy("iou_thr").agg(F.round(F.avg("ap"), 6).alias("map"))


@register(
    "map_coco_components",
    views=_EV,
    extra_ctes=_ap_ctes(_THR10, _COCO_WIN),
    recursive=True,
    sql="select iou_thr, count(*) as n_won from win group by iou_thr",
)
def q_map_coco_components(fx):
    """Wins by threshold with groups of two pairs at most: the rest is cut into components, and those over it played in rounds."""
    from boxframe.operators.coco import coco_winners

    won, _ = coco_winners(_gt(fx), fx.detections, M.IOU_THRESHOLDS, group_pairs=2)
    return won.groupBy("iou_thr").agg(F.count(F.lit(1)).alias("n_won"))
