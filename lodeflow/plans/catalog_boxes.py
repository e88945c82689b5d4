"""Queries over boxes, suppression, evaluation and run-length masks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodeflow.functions import rle
from lodeflow.operators import boxes, evaluation, keyed, layout
from lodeflow.registry import query
from lodeflow.session import settle, table

SIZE = 64.0

_BOX = """bx as materialized (select l_orderkey * 10 + l_linenumber as id, l_orderkey // 16 as img, min(l_returnflag) as cls, cast(min(l_partkey) % 300 as double) as x1, cast(min(l_orderkey) % 200 as double) as y1,
  cast(min(l_partkey) % 300 + max(l_quantity) as double) as x2, cast(min(l_orderkey) % 200 + max(l_quantity) + 4 as double) as y2, round(min(l_discount) + l_orderkey % 977 / 1000.0, 4) as score, min(l_linenumber) % 2 as odd from lineitem group by l_orderkey, l_linenumber)"""
_IOU = "greatest(least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1) + {p}, 0) * greatest(least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1) + {p}, 0)"


def _inter(a="a", b="b", p="1"):
    return _IOU.format(a=a, b=b, p=p)


def _area(a, p="1"):
    return f"(({a}.x2 - {a}.x1 + {p}) * ({a}.y2 - {a}.y1 + {p}))"


_IOU_SQL = f"{_inter()} / ({_area('a')} + {_area('b')} - {_inter()})"


def base(spark, d) -> DataFrame:
    """A box a line of an order, sixteen orders an image: images stay small however many there are."""
    x = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber")
    return x.agg(F.min("l_partkey").alias("p"), F.min("l_returnflag").alias("cls"), F.max("l_quantity").alias("q"), F.min("l_discount").alias("ds")).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.expr("l_orderkey div 16").alias("img"), "cls", (F.col("p") % 300).cast("double").alias("x1"), (F.col("l_orderkey") % 200).cast("double").alias("y1"),
        (F.col("p") % 300 + F.col("q")).cast("double").alias("x2"), (F.col("l_orderkey") % 200 + F.col("q") + 4).cast("double").alias("y2"), F.round(F.col("ds") + F.col("l_orderkey") % 977 / 1000.0, 4).alias("score"), (F.col("l_linenumber") % 2).alias("odd"))


def _truths(b: DataFrame) -> DataFrame:
    return b.where("odd = 1").select("id", "img", "cls", *boxes.SIDES, F.when(F.col("id") % 7 == 0, 1).otherwise(0).alias("difficult"))


@query("j10_iou_join", f"with {_BOX} select a.id as a_id, b.id as b_id, round({_IOU_SQL}, 9) as iou from bx a join bx b on a.img = b.img and a.cls = b.cls and a.odd = 0 and b.odd = 1 and a.x1 <= b.x2 and b.x1 <= a.x2 and a.y1 <= b.y2 and b.y1 <= a.y2")
def j10_iou_join(spark, d):
    b = base(spark, d)
    j = boxes.overlap_join(b.where("odd = 0").select("id", "img", "cls", *boxes.SIDES), b.where("odd = 1").select("id", "img", "cls", *boxes.SIDES), ["img", "cls"], SIZE)
    return j.select("a_id", "b_id", F.round(boxes.iou_pixel("a_", "b_"), 9).alias("iou"))


@query("j11_query_area", f"with {_BOX} select a.id as a_id, b.id as b_id, round({_inter()} / {_area('b')}, 9) as r, round({_inter(p='0')} / least({_area('a', '0')}, {_area('b', '0')}), 9) as m, round({_inter(p='0')} / ({_area('a', '0')} + {_area('b', '0')} - {_inter(p='0')}), 9) as plain from bx a join bx b on a.img = b.img and a.cls = b.cls and a.odd = 0 and b.odd = 1 and a.x1 <= b.x2 and b.x1 <= a.x2 and a.y1 <= b.y2 and b.y1 <= a.y2")
def j11_query_area(spark, d):
    b = base(spark, d)
    j = boxes.overlap_join(b.where("odd = 0").select("id", "img", "cls", *boxes.SIDES), b.where("odd = 1").select("id", "img", "cls", *boxes.SIDES), ["img", "cls"], SIZE)
    return j.select("a_id", "b_id", F.round(boxes.over_query_area("a_", "b_"), 9).alias("r"), F.round(boxes.over_min_area("a_", "b_"), 9).alias("m"), F.round(boxes.iou_plain("a_", "b_"), 9).alias("plain"))


@query("j15_best_truth", f"with {_BOX}, j as (select a.id, b.id as gt, {_IOU_SQL} as iou from bx a join bx b on a.img = b.img and a.cls = b.cls and a.odd = 0 and b.odd = 1 and a.x1 <= b.x2 and b.x1 <= a.x2 and a.y1 <= b.y2 and b.y1 <= a.y2) select id, gt, round(iou, 9) as iou from (select *, row_number() over (partition by id order by iou desc, gt) as r from j) where r = 1")
def j15_best_truth(spark, d):
    b = base(spark, d)
    j = boxes.overlap_join(b.where("odd = 0").select("id", "img", "cls", *boxes.SIDES), b.where("odd = 1").select("id", "img", "cls", *boxes.SIDES), ["img", "cls"], SIZE).withColumn("iou", boxes.iou_pixel("a_", "b_"))
    m = boxes.best_match(j.select(F.col("a_id").alias("id"), F.col("b_id").alias("gt"), "iou"), ["id"], "iou", "gt")
    return m.select("id", "gt", F.round("iou", 9).alias("iou"))


@query("n1_deltas", f"with {_BOX} select a.id, round((b.x1 + (b.x2 - b.x1 + 1) * 0.5 - (a.x1 + (a.x2 - a.x1 + 1) * 0.5)) / (a.x2 - a.x1 + 1), 6) as dx, round(ln((b.y2 - b.y1 + 1) / (a.y2 - a.y1 + 1)), 6) as dh from bx a join bx b on b.id = a.id + 1")
def n1_deltas(spark, d):
    b = base(spark, d)
    a = b.select("id", *[F.col(s).alias(f"a_{s}") for s in boxes.SIDES])
    g = b.select((F.col("id") - 1).alias("id"), *[F.col(s).alias(f"g_{s}") for s in boxes.SIDES])
    t = boxes.to_deltas("a_", "g_")
    return a.join(g, "id").select("id", F.round(t["dx"], 6).alias("dx"), F.round(t["dh"], 6).alias("dh"))


@query("n2_delta_round_trip", f"with {_BOX} select a.id, round(b.x1, 4) as x1, round(b.y1, 4) as y1, round(b.x2 + 1, 4) as x2, round(b.y2 + 1, 4) as y2 from bx a join bx b on b.id = a.id + 1")
def n2_delta_round_trip(spark, d):
    b = base(spark, d)
    a = b.select("id", *[F.col(s).alias(f"a_{s}") for s in boxes.SIDES])
    g = b.select((F.col("id") - 1).alias("id"), *[F.col(s).alias(f"g_{s}") for s in boxes.SIDES])
    j = a.join(g, "id").withColumns(boxes.to_deltas("a_", "g_"))
    back = boxes.from_deltas("a_", F.col("dx"), F.col("dy"), F.col("dw"), F.col("dh"))
    return j.select("id", *[F.round(c, 4).alias(n) for n, c in back.items()])


@query("n3_clip", f"with {_BOX} select id, greatest(least(x1, 199.0), 0.0) as x1, greatest(least(y1, 149.0), 0.0) as y1, greatest(least(x2, 199.0), 0.0) as x2, greatest(least(y2, 149.0), 0.0) as y2 from bx")
def n3_clip(spark, d):
    return base(spark, d).select("id", *[c.alias(n) for n, c in boxes.clip(F.lit(200.0), F.lit(150.0)).items()])


_ANCHORS = """sides as (select r, s, round(sqrt(256 / r)) as w, round(round(sqrt(256 / r)) * r) as h from (values (0.5), (1.0), (2.0)) a(r), (values (8), (16), (32)) b(s)),
anchor as (select cast(row_number() over (order by r, s) - 1 as integer) as anchor, 7.5 - (w * s - 1) / 2 as x1, 7.5 - (h * s - 1) / 2 as y1, 7.5 + (w * s - 1) / 2 as x2, 7.5 + (h * s - 1) / 2 as y2 from sides)"""


@query("n4_anchors", f"with {_ANCHORS} select p_partkey, anchor, x1 + p_size * 16 as x1, y1 + p_size as y1, x2 + p_size * 16 as x2, y2 + p_size as y2 from part, anchor")
def n4_anchors(spark, d):
    """The nine anchors around each part's place."""
    p = table(spark, d, "part").select("p_partkey", "p_size").crossJoin(F.broadcast(boxes.anchors(spark)))  # nine rows
    return p.select("p_partkey", "anchor", *[(F.col(s) + F.col("p_size") * (16 if s[0] == "x" else 1)).alias(s) for s in boxes.SIDES])


@query("n5_anchor_grid", f"""with {_ANCHORS}, g as (select gx, gy, anchor, x1 + gx * 16 as x1, y1 + gy * 16 as y1, x2 + gx * 16 as x2, y2 + gy * 16 as y2 from anchor, range(10) t(gx), range(6) u(gy))
select p_partkey, count(anchor) as n, cast(coalesce(sum(gx), 0) as bigint) as sx from part left join g on g.x1 >= -p_size and g.y1 >= -p_size and g.x2 < p_size * 8 and g.y2 < p_size * 8 group by 1""")
def n5_anchor_grid(spark, d):
    """Anchors of a grid that lie within an image of each part's size."""
    g = boxes.anchor_grid(boxes.anchors(spark), 10, 6, 16)
    p = table(spark, d, "part").select("p_partkey", "p_size")
    sizes = p.select("p_size").distinct()
    fits = (F.col("x1") >= -F.col("p_size")) & (F.col("y1") >= -F.col("p_size")) & (F.col("x2") < F.col("p_size") * 8) & (F.col("y2") < F.col("p_size") * 8)
    counted = sizes.join(F.broadcast(g), fits, "left").groupBy("p_size").agg(F.count("anchor").alias("n"), F.coalesce(F.sum("gx"), F.lit(0)).alias("sx"))  # 540 rows of a grid
    return p.join(counted, "p_size").select("p_partkey", "n", "sx")


_KEPT = "struct_pack(id := rk.id, x1 := rk.x1, y1 := rk.y1, x2 := rk.x2, y2 := rk.y2)"


@query("n6_nms", f"""with recursive {_BOX}, rk as materialized (select *, row_number() over (partition by img, cls order by score desc, id) as k from bx),
r as (select img, cls, k, [{_KEPT}] as kept from rk where k = 1 union all
  select rk.img, rk.cls, rk.k, case when len(list_filter(r.kept, lambda b: {_inter('b', 'rk')} / ({_area('b')} + {_area('rk')} - {_inter('b', 'rk')}) > 0.3)) = 0 then list_append(r.kept, {_KEPT}) else r.kept end
  from r join rk on rk.img = r.img and rk.cls = r.cls and rk.k = r.k + 1)
select img, cls, unnest(list_transform(kept, lambda b: b.id)) as id from (select img, cls, arg_max(kept, k) as kept from r group by 1, 2)""")
def n6_nms(spark, d):
    return boxes.nms(base(spark, d).select("id", "img", "cls", "score", *boxes.SIDES), ["img", "cls"], "score", "id", 0.3).select("img", "cls", "id")


@query("n7_anchor_labels", f"""with {_BOX}, j as (select a.id, b.id as gt, {_IOU_SQL} as iou from bx a join bx b on a.img = b.img and a.odd = 0 and b.odd = 1 and a.x1 <= b.x2 and b.x1 <= a.x2 and a.y1 <= b.y2 and b.y1 <= a.y2),
k as (select id, max(iou) as iou, bool_or(iou = top and iou > 0) as best from (select *, max(iou) over (partition by gt) as top from j) group by 1)
select bx.id, case when coalesce(best, false) or coalesce(iou, 0) >= 0.7 then 1 when coalesce(iou, 0) < 0.3 then 0 else -1 end as label from bx left join k using (id) where odd = 0""")
def n7_anchor_labels(spark, d):
    b = base(spark, d)
    return boxes.label_anchors(b.where("odd = 0").select("id", "img", *boxes.SIDES), b.where("odd = 1").select("id", "img", *boxes.SIDES), ["img"], "id", SIZE).select("id", "label")


@query("n9_flip", f"with {_BOX} select id, 400 - x2 - 1 as fx1, 400 - x1 - 1 as fx2, x2 - x1 + 1 as w from bx")
def n9_flip(spark, d):
    f = boxes.flipped(F.lit(400.0))
    return base(spark, d).select("id", f["x1"].alias("fx1"), f["x2"].alias("fx2"), boxes.xyxy_to_xywh()["w"].alias("w"))


@query("n10_scale", "select p_partkey, round(case when round(600.0 / least(p_size, 40) * greatest(p_size, 40)) > 1000 then 1000.0 / greatest(p_size, 40) else 600.0 / least(p_size, 40) end, 9) as f from part")
def n10_scale(spark, d):
    return table(spark, d, "part").select("p_partkey", F.round(boxes.scale_factor(F.col("p_size"), F.lit(40)), 9).alias("f"))


@query("n13_smooth_l1", f"with {_BOX} select cls, round(avg(case when abs(score - 0.5) < 1 then 0.5 * (score - 0.5) * (score - 0.5) else abs(score - 0.5) - 0.5 end), 6) as loss from bx group by 1")
def n13_smooth_l1(spark, d):
    return base(spark, d).groupBy("cls").agg(F.round(F.avg(boxes.smooth_l1(F.col("score"), F.lit(0.5), F.lit(1.0), F.lit(1.0))), 6).alias("loss"))


@query("p11_small_boxes", f"with {_BOX} select id from bx where x2 - x1 + 1 >= 21 and y2 - y1 + 1 > 21")
def p11_small_boxes(spark, d):
    return base(spark, d).where(boxes.large_enough(21)).select("id")


@query("p12_both_sides", f"with {_BOX} select id from bx where x2 - x1 + 1 >= 20 and y2 - y1 + 1 >= 20")
def p12_both_sides(spark, d):
    return base(spark, d).where(boxes.both_sides(20)).select("id")


@query("p13_inside", f"with {_BOX} select id from bx where x1 >= 0 and y1 >= 0 and x2 < 250 and y2 < 150")
def p13_inside(spark, d):
    return base(spark, d).where(boxes.inside_image(F.lit(250), F.lit(150))).select("id")


@query("p15_score", f"with {_BOX} select id from bx where score > 0.7")
def p15_score(spark, d):
    return base(spark, d).where("score > 0.7").select("id")


@query("p16_truth_cap", f"with {_BOX} select img, id from (select img, id, row_number() over (partition by img order by id) as r from bx where x2 > x1 and y2 > y1) where r <= 20")
def p16_truth_cap(spark, d):
    return keyed.top_n(base(spark, d).where("x2 > x1 and y2 > y1"), ["img"], [F.col("id")], 20).select("img", "id")


@query("p17_valid", f"with {_BOX} select count(*) filter (where x1 >= 0 and y1 >= 0 and x2 >= x1 and y2 >= y1 and x2 < 320 and y2 < 220) as ok, count(*) as n from bx")
def p17_valid(spark, d):
    return base(spark, d).agg(F.count_if(boxes.valid_box(F.lit(320), F.lit(220))).alias("ok"), F.count("*").alias("n"))


@query("p18_route_blocks", f"with {_BOX} select a.id, min(b.id) as tbl from bx a left join bx b on a.img = b.img and b.odd = 1 and {_inter(p='0')} / least({_area('a', '0')}, {_area('b', '0')}) > 0.5 where a.odd = 0 group by 1")
def p18_route_blocks(spark, d):
    b = base(spark, d).select("id", "img", "odd", *boxes.SIDES)
    return layout.route_blocks(b.where("odd = 0").drop("odd"), b.where("odd = 1").select("img", F.col("id").alias("tbl"), *boxes.SIDES), ["img"], "id", "tbl", SIZE).select("id", "tbl")


@query("a11_union_box", f"with {_BOX} select img, cls, min(x1) as x1, min(y1) as y1, max(x2) as x2, max(y2) as y2 from bx group by 1, 2")
def a11_union_box(spark, d):
    return layout.union_box(base(spark, d), ["img", "cls"])


@query("a12_merged_boxes", f"""with recursive {_BOX}, s as (select * from bx), e as (select a.img, a.id as a, b.id as b from s a join s b on a.img = b.img and {_inter(p='20')} / least({_area('a', '0')}, {_area('b', '0')}) >= 0.01 and least(a.x2, b.x2) - greatest(a.x1, b.x1) > -20 and least(a.y2, b.y2) - greatest(a.y1, b.y1) > -20),
r as (select img, id, id as root from s union select r.img, r.id, e.b from r join e on r.img = e.img and r.root = e.a),
l as (select img, id, min(root) as root from r group by 1, 2)
select l.img, l.root as id, min(x1) as x1, min(y1) as y1, max(x2) as x2, max(y2) as y2 from l join s using (img, id) group by 1, 2""")
def a12_merged_boxes(spark, d):
    return layout.merged_boxes(base(spark, d).select("img", "id", *boxes.SIDES), ["img"], "id", SIZE)


@query("a17_unique_boxes", f"with {_BOX} select min(id) as id from bx group by img, round(x1 / 20), round(y1 / 20), round(x2 / 20), round(y2 / 20)")
def a17_unique_boxes(spark, d):
    return boxes.unique_boxes(base(spark, d), ["img"], "id", 1 / 20).select("id")


@query("t7_ratio_rank", "select p_partkey, round(least(greatest(p_size / 25.0, 0.5), 2.0), 6) as ratio, p_size / 25.0 > 2 or p_size / 25.0 < 0.5 as need_crop, cast(row_number() over (order by least(greatest(p_size / 25.0, 0.5), 2.0), p_partkey) as integer) as rank from part")
def t7_ratio_rank(spark, d):
    return boxes.ratio_rank(table(spark, d, "part").withColumn("h", F.lit(25.0)), "p_size", "h", "p_partkey").select("p_partkey", F.round("ratio", 6).alias("ratio"), "need_crop", "rank")


_FLAGS = f"""{_BOX}, gt as (select *, case when id % 7 = 0 then 1 else 0 end as difficult from bx where odd = 1),
j as (select a.cls, a.img, a.id, a.score, b.id as gt, b.difficult, {_IOU_SQL} as iou from bx a join gt b on a.img = b.img and a.cls = b.cls and a.odd = 0 and a.x1 <= b.x2 and b.x1 <= a.x2 and a.y1 <= b.y2 and b.y1 <= a.y2),
best as (select * from (select *, row_number() over (partition by id order by iou desc, gt) as r from j) where r = 1),
f as (select d.cls, d.img, d.id, d.score, b.gt, coalesce(b.iou, 0) as iou, coalesce(b.difficult, 0) as difficult from bx d left join best b using (id) where d.odd = 0),
g as (select *, iou > 0.2 as hit, row_number() over (partition by cls, img, iou > 0.2, case when iou > 0.2 then gt else id end order by score desc, id) = 1 as fst from f),
h as (select *, case when hit and difficult = 0 and fst then 1 else 0 end as tp, case when not hit or (difficult = 0 and not fst) then 1 else 0 end as fp from g),
np as (select cls, count(*) as npos from gt where difficult = 0 group by 1),
c as (select cls, score, rk, ctp / npos as recall, case when ctp + cfp = 0 then 0 else ctp / (ctp + cfp) end as precision, npos from (select cls, score, npos, row_number() over w as rk, sum(tp) over (partition by cls order by score desc, id rows unbounded preceding) as ctp, sum(fp) over (partition by cls order by score desc, id rows unbounded preceding) as cfp from h join np using (cls) window w as (partition by cls order by score desc, id))),
e as (select *, max(precision) over (partition by cls order by rk rows between current row and unbounded following) as env, recall - coalesce(lag(recall) over (partition by cls order by rk), 0) as dr from c)"""


def _flags(spark, d):
    b = base(spark, d)
    t = _truths(b)
    return evaluation.rank_flags(b.where("odd = 0").select("id", "img", "cls", "score", *boxes.SIDES), t.withColumnRenamed("id", "gt"), ["cls"], "img", "id", "gt", "score", SIZE, 0.2), t


@query("e3_rank_flags", f"with {_FLAGS} select id, tp, fp from h")
def e3_rank_flags(spark, d):
    return _flags(spark, d)[0].select("id", "tp", "fp")


@query("w9_curve", f"with {_FLAGS} select cls, rk as rank, round(recall, 9) as recall, round(precision, 9) as precision, round(env, 9) as envelope from e")
def w9_curve(spark, d):
    f, t = _flags(spark, d)
    return evaluation.curve(f, t, ["cls"], "score", ["id"]).select("cls", F.col("rank").cast("bigint").alias("rank"), *[F.round(c, 9).alias(c) for c in ("recall", "precision", "envelope")])


@query("e1_average_precision", f"with {_FLAGS}, t as (select unnest(range(11)) / 10.0 as t) select cls, round(sum(dr * env), 6) as ap, round((select sum(m) from (select t, coalesce(max(case when recall >= t then precision end), 0) as m from e e2, t where e2.cls = e.cls group by t)) / 11, 6) as ap11 from e group by cls")
def e1_average_precision(spark, d):
    f, t = _flags(spark, d)
    return evaluation.average_precision(evaluation.curve(f, t, ["cls"], "score", ["id"]), ["cls"]).select("cls", F.round("ap", 6).alias("ap"), F.round("ap11", 6).alias("ap11"))


@query("a15_mean_ap", f"with {_FLAGS}, a as (select cls, sum(dr * env) as ap, max(npos) as npos from e group by 1) select round(avg(ap), 6) as map, round(sum(ap * npos) / sum(npos), 6) as weighted_map from a")
def a15_mean_ap(spark, d):
    f, t = _flags(spark, d)
    ap = evaluation.average_precision(evaluation.curve(f, t, ["cls"], "score", ["id"]), ["cls"])
    n = t.where("difficult = 0").groupBy("cls").agg(F.count("*").alias("npos"))
    return evaluation.mean_ap(ap, n, ["cls"]).select(F.round("map", 6).alias("map"), F.round("weighted_map", 6).alias("weighted_map"))


@query("e9_threshold", f"with {_FLAGS} select cls, score as threshold from (select cls, score, row_number() over (partition by cls order by case when precision + recall = 0 then 0 else precision * recall / (precision + recall) end desc, score desc) as r from e) where r = 1")
def e9_threshold(spark, d):
    f, t = _flags(spark, d)
    return evaluation.operating_threshold(evaluation.curve(f, t, ["cls"], "score", ["id"]), ["cls"], "score")


def _matched(spark, d):
    b = base(spark, d)
    return evaluation.match_images(b.where("odd = 0"), b.where("odd = 1").withColumn("crowd", F.when(F.col("id") % 11 == 0, 1).otherwise(0)), "img", "cls", "score", ious=[0.2, 0.5])


@query("e4_match_images")
def e4_match_images(spark, d):
    return _matched(spark, d).groupBy("cls", "area", "iou").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("npos").alias("npos"))


@query("e5_accumulate")
def e5_accumulate(spark, d):
    return evaluation.accumulate(_matched(spark, d), "cls", "img").select("cls", "area", "iou", "max_det", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


@query("e6_summary")
def e6_summary(spark, d):
    return evaluation.summary(evaluation.accumulate(_matched(spark, d), "cls", "img")).select("no", "metric", F.round("value", 6).alias("value"))


@query("e8_proposal_recall")
def e8_proposal_recall(spark, d):
    b = base(spark, d)
    return evaluation.proposal_recall(b.where("odd = 0").withColumnRenamed("id", "box_id"), b.where("odd = 1"), "img", [0.1, 0.3, 0.5], 50)


_MASK_SQL = "px as (select user_id % 30 as img, row_number() over (partition by user_id % 30 order by ts, event_id) as i, case when event_type in ('view', 'click') then 1 else 0 end as v from events), rn as (select img, v, g, min(i) as a, count(*) as n from (select *, i - row_number() over (partition by img, v order by i) as g from px) group by img, v, g)"


def _masks(spark, d) -> DataFrame:
    w = Window.partitionBy("img").orderBy("ts", "event_id")
    px = table(spark, d, "events").withColumn("img", F.col("user_id") % 30).select("img", F.row_number().over(w).alias("i"), F.when(F.col("event_type").isin("view", "click"), 1).otherwise(0).alias("v"))
    return rle.encode(px, ["img"], "i", "v")


@query("r1_encode", f"with {_MASK_SQL} select img, (case when arg_min(v, a) = 1 then '0,' else '' end) || string_agg(n, ',' order by a) as counts from rn group by 1")
def r1_encode(spark, d):
    return _masks(spark, d).select("img", F.array_join("counts", ",").alias("counts"))


@query("r2_decode", f"with {_MASK_SQL} select img, string_agg(v, '' order by i) as pixels from px group by 1")
def r2_decode(spark, d):
    return _masks(spark, d).select("img", F.array_join(rle.decode(F.col("counts")), "").alias("pixels"))


@query("r3_area", f"with {_MASK_SQL} select img, cast(sum(v) as bigint) as area from px group by 1")
def r3_area(spark, d):
    return _masks(spark, d).select("img", rle.area(F.col("counts")).alias("area"))


_MASK2 = _MASK_SQL + ", p2 as (select user_id % 10 as img, user_id % 30 // 10 as part, row_number() over (partition by user_id % 30 order by ts, event_id) as i, case when event_type in ('view', 'click') then 1 else 0 end as v from events), p3 as (select * from p2)"


def _mask_parts(spark, d) -> DataFrame:
    """Masks of three parts of each image, padded with zeros to the longest part's size."""
    w = Window.partitionBy("img", "part").orderBy("ts", "event_id")
    e = table(spark, d, "events").select((F.col("user_id") % 10).alias("img"), F.expr("user_id % 30 div 10").alias("part"), "ts", "event_id", F.when(F.col("event_type").isin("view", "click"), 1).otherwise(0).alias("v"))
    m = rle.encode(e.withColumn("i", F.row_number().over(w)), ["img", "part"], "i", "v").withColumn("n", F.aggregate("counts", F.lit(0), lambda a, x: a + x))
    sized = m.withColumn("size", F.max("n").over(Window.partitionBy("img"))).withColumn("more", (F.col("size") - F.col("n")).cast("int"))
    longer = F.when(F.size("counts") % 2 == 0, F.concat("counts", F.array("more"))).otherwise(F.concat(F.expr("slice(counts, 1, size(counts) - 1)"), F.array(F.element_at("counts", -1) + F.col("more"))))
    return sized.withColumn("counts", F.when(F.col("more") > 0, longer).otherwise(F.col("counts"))).drop("n", "more")


@query("r4_merge", f"with {_MASK2} select img, sum(u) as area_union, sum(x) as area_common from (select p3.img, i, max(v) as u, case when count(*) = max(np) then min(v) else 0 end as x from p3 join (select img, count(distinct part) as np from p3 group by 1) n on n.img = p3.img group by 1, 2) group by 1")
def r4_merge(spark, d):
    m = settle(_mask_parts(spark, d))
    u, x = rle.merge(m, ["img"], "counts", "size", False), rle.merge(m, ["img"], "counts", "size", True)
    return u.select("img", rle.area(F.col("counts")).alias("area_union")).join(x.select("img", rle.area(F.col("counts")).alias("area_common")), "img")


@query("r5_mask_iou", f"with {_MASK2} select coalesce(a.img, b.img) as img, round(sum(coalesce(a.v, 0) * coalesce(b.v, 0)) / sum(greatest(coalesce(a.v, 0), coalesce(b.v, 0))), 9) as iou from (select * from p3 where part = 0) a full join (select * from p3 where part = 1) b on a.img = b.img and a.i = b.i group by 1")
def r5_mask_iou(spark, d):
    m = settle(_mask_parts(spark, d))
    j = m.where("part = 0").select("img", F.col("counts").alias("a")).join(m.where("part = 1").select("img", F.col("counts").alias("b")), "img")
    return rle.iou(j, "a", "b").select("img", F.round("iou", 9).alias("iou"))


@query("r7_bbox", f"with {_MASK_SQL}, p as (select img, (i - 1) // 20 as x, (i - 1) % 20 as y from px where v = 1) select img, min(x) as x, max(x) - min(x) + 1 as w from p group by 1")
def r7_bbox(spark, d):
    b = _masks(spark, d).select("img", rle.to_bbox(F.col("counts"), F.lit(20)).alias("b"))
    return b.select("img", "b.x", "b.w")


@query("r9_codec", f"with {_MASK_SQL} select img, (case when arg_min(v, a) = 1 then '0,' else '' end) || string_agg(n, ',' order by a) as counts from rn group by 1")
def r9_codec(spark, d):
    return _masks(spark, d).select("img", F.array_join(rle.counts_column(rle.text_column(F.col("counts"))), ",").alias("counts"))


@query("r8_box_mask", f"with {_BOX} select id, cast(greatest(least(x2, 200) - x1, 0) * greatest(least(y2, 150) - y1, 0) as bigint) as area from bx")
def r8_box_mask(spark, d):
    b = base(spark, d)
    c = rle.from_bbox(F.col("x1").cast("int"), F.col("y1").cast("int"), (F.col("x2") - F.col("x1")).cast("int"), (F.col("y2") - F.col("y1")).cast("int"), F.lit(150), F.lit(200))
    return b.select("id", rle.area(c).alias("area"))


@query("k6_detection_lines", f"with {_BOX} select printf('%d %.3f %.1f %.1f %.1f %.1f', img, score, x1 + 1, y1 + 1, x2 + 1, y2 + 1) as line from bx")
def k6_detection_lines(spark, d):
    from lodeflow.sources import sinks

    return sinks.detection_lines(base(spark, d).withColumn("img", F.col("img").cast("string")), "img", "score")


@query("l_reading_order", f"with {_BOX} select id, cast(row_number() over (partition by img order by x1 >= 400 / 2.5, y1, x1, id) as integer) as pos from bx")
def l_reading_order(spark, d):
    return base(spark, d).select("id", F.row_number().over(Window.partitionBy("img").orderBy(*layout.box_order(F.lit(400)), "id")).alias("pos"))


@query("l7_adjust_tables")
def l7_adjust_tables(spark, d):
    b = base(spark, d).select("id", "img", "odd", *boxes.SIDES)
    return layout.adjust_tables(b.where("odd = 0"), b.where("odd = 1").withColumns({"dir": F.lit("right"), "width": F.lit(400.0)}), ["img"])


@query("l6_grids")
def l6_grids(spark, d):
    x = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("q"))
    row = (F.col("l_orderkey") % 8) * 12.0
    s = x.select(F.expr("l_orderkey div 8").alias("tbl"), (F.col("l_linenumber") * 40.0).alias("x1"), row.alias("y1"), (F.col("l_linenumber") * 40.0 + 30).alias("x2"), (row + 10).alias("y2"), F.col("q").cast("string").alias("text"))
    return layout.grids(s, ["tbl"]).select("tbl", "row", "col", "text")


_COST = "pow(greatest(t.x1 - (c.x1 + c.x2) / 2, (c.x1 + c.x2) / 2 - t.x2, 0), 2) + pow(greatest(c.y2 - t.y1, 0), 2)"


@query("j13_captions")
def j13_captions(spark, d):
    b = base(spark, d).withColumn("page", F.col("img") % 4).withColumn("doc", F.expr("img div 4"))
    t = b.where("odd = 0").select("doc", "page", F.col("id").alias("table_idx"), *boxes.SIDES)
    c = b.where("odd = 1").select("doc", "page", F.col("id").alias("caption_idx"), F.concat(F.lit("Table "), F.col("id").cast("string")).alias("text"), *boxes.SIDES)
    return layout.caption_tables(t, c, ["doc"], "page").select("doc", "page", "table_idx", "caption", "continued")


@query("j13_distance", f"with {_BOX} select t.id as t, c.id as c, {_COST} as cost from bx t join bx c on t.img = c.img and t.odd = 0 and c.odd = 1")
def j13_distance(spark, d):
    b = base(spark, d)
    t = b.where("odd = 0").select("img", F.col("id").alias("t"), *[F.col(x).alias(f"t_{x}") for x in boxes.SIDES])
    c = b.where("odd = 1").select("img", F.col("id").alias("c"), *[F.col(x).alias(f"c_{x}") for x in boxes.SIDES])
    return t.join(c, "img").select("t", "c", layout.caption_distance("t_", "c_").alias("cost"))


_ROI = "r as (select *, case when score >= 0.5 then 'fg' when score >= 0 then 'bg' end as kind from bx)"


@query("n8_roi_counts", f"with {_BOX}, {_ROI}, n as (select img, count(*) filter (where kind = 'fg') as f, count(*) filter (where kind = 'bg') as b from r where kind is not null group by 1), q as (select *, case when b = 0 then 32 else least(f, 8) end as fg from n) select img, fg, 32 - fg as bg from q")
def n8_roi_counts(spark, d):
    s = boxes.sample_rois(base(spark, d).select("id", "img", F.col("score").alias("iou")), ["img"], "id", "iou", 32)
    return s.groupBy("img").agg(F.count_if(F.col("kind") == "fg").alias("fg"), F.count_if(F.col("kind") == "bg").alias("bg"))


@query("n14_detections", f"""with recursive {_BOX}, m as (select img, id, score, x1 + score * 0.1 * (x2 - x1 + 1) as mx, x2 - x1 + 1 as w, y1 + score * -0.1 * (y2 - y1 + 1) as my, y2 - y1 + 1 as h from bx where score > 0.5),
k0 as (select img, id, score, greatest(least(mx, 299), 0) / 2 as x1, greatest(least(my, 199), 0) / 2 as y1, greatest(least(mx + w, 299), 0) / 2 as x2, greatest(least(my + h, 199), 0) / 2 as y2 from m),
rk as materialized (select *, row_number() over (partition by img order by score desc, id) as k from k0),
r as (select img, k, [{_KEPT}] as kept from rk where k = 1 union all
  select rk.img, rk.k, case when len(list_filter(r.kept, lambda b: {_inter('b', 'rk')} / ({_area('b')} + {_area('rk')} - {_inter('b', 'rk')}) > 0.3)) = 0 then list_append(r.kept, {_KEPT}) else r.kept end
  from r join rk on rk.img = r.img and rk.k = r.k + 1)
select img, unnest(list_transform(kept, lambda b: b.id)) as id from (select img, arg_max(kept, k) as kept from r group by 1)""")
def n14_detections(spark, d):
    raw = base(spark, d).withColumns({"dx": F.col("score"), "dy": -F.col("score"), "dw": F.lit(0.0), "dh": F.lit(0.0), "width": F.lit(300.0), "height": F.lit(200.0), "scale": F.lit(2.0)})
    return boxes.detections(raw, ["img"], "id", 0.5).select("img", "id")


@query("n15_proposal_classes", f"with {_BOX}, j as (select a.id, b.id as gt, b.id % 3 + 1 as cl, {_IOU_SQL} as iou from bx a join bx b on a.img = b.img and a.odd = 0 and b.odd = 1 and a.x1 <= b.x2 and b.x1 <= a.x2 and a.y1 <= b.y2 and b.y1 <= a.y2), t as (select *, row_number() over (partition by id order by iou desc, gt) as r from j) select bx.id, cast(coalesce(cl, 0) as integer) as class, round(coalesce(iou, 0), 9) as overlap from bx left join t on t.id = bx.id and r = 1 where odd = 0")
def n15_proposal_classes(spark, d):
    b = base(spark, d)
    p = boxes.proposals_with_truth(b.where("odd = 0").select("id", "img", *boxes.SIDES), b.where("odd = 1").select("id", "img", (F.col("id") % 3 + 1).cast("int").alias("class"), *boxes.SIDES), ["img"], "id", SIZE)
    return p.select("id", F.col("class").cast("int").alias("class"), F.round("overlap", 9).alias("overlap"))


@query("n11_minibatch_truths", f"with {_BOX} select id, x1 * 1.5 as x1, y2 * 1.5 as y2 from bx where id % 3 <> 0 and id % 5 <> 0")
def n11_minibatch_truths(spark, d):
    t = base(spark, d).withColumns({"class": F.col("id") % 3, "crowd": F.col("id") % 5 == 0})
    return boxes.minibatch_truths(t, F.lit(1.5), False).select("id", "x1", "y2")


@query("n12_cropped")
def n12_cropped(spark, d):
    b = base(spark, d).withColumns({"length": F.lit(360), "window": F.lit(200)})
    return boxes.cropped(b, ["img"], "x", "length", "window").select("id", "crop", "x1", "x2")


@query("u9_with_truths", f"with {_BOX} select id, x1 from bx where odd = 0 union all select id, x1 from bx where odd = 1")
def u9_with_truths(spark, d):
    b = base(spark, d)
    return boxes.with_truths(b.where("odd = 0"), b.where("odd = 1").drop("score")).select("id", "x1")


@query("p14_with_boxes", f"with {_BOX} select distinct img from bx where odd = 1")
def p14_with_boxes(spark, d):
    b = base(spark, d)
    return boxes.with_boxes(b.select("img").distinct(), b.where("odd = 1"), ["img"])


@query("t8_first_n", f"with {_BOX} select id from bx order by id limit 1000")
def t8_first_n(spark, d):
    return keyed.first_n(base(spark, d).select("id"), [F.col("id")], 1000)
