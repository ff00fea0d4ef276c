"""Registered queries: list parsing, box scaling, labels, presence, splits, batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from boxframe.operators import boxes as B
from boxframe.plans.catalog import register

# --------------------------------------------------------------- boxes


@register(
    "scale_boxes",
    views=["scaled"],
    sql="select ImageID, box_id, LabelName, xmin, ymin, xmax, ymax from scaled",
)
def q_scale_boxes(fx):
    # the operator itself, from the annotation table (not the stored processed table)
    r = B.scale_boxes(fx.boxes, fx.image_meta).result
    return r.select("ImageID", "box_id", "LabelName", "xmin", "ymin", "xmax", "ymax")


@register(
    "quarantine_images",
    views=["boxes", "image_meta"],
    sql="""
select ImageID, case when ImageID not in (select ImageID from image_meta) then 'image not found'
                     else 'null or NaN coordinate' end as error
from boxes group by ImageID
having max(case when XMin is null or YMin is null or XMax is null or YMax is null
                  or isnan(XMin) or isnan(YMin) or isnan(XMax) or isnan(YMax)
                  or isinf(XMin) or isinf(YMin) or isinf(XMax) or isinf(YMax) then 1 else 0 end) = 1
    or ImageID not in (select ImageID from image_meta)
""",
)
def q_quarantine(fx):
    return B.scale_boxes(fx.boxes, fx.image_meta).quarantine


@register(
    "group_annotations",
    views=["boxes"],
    sql="""
select ImageID, cast(row_number() over (partition by ImageID order by box_id) - 1 as int) as pos,
       XMin, YMin, XMax, YMax, LabelName
from boxes
""",
)
def q_group_annotations(fx):
    g = B.group_annotations(fx.boxes, ("XMin", "YMin", "XMax", "YMax", "LabelName"), order_by="box_id")
    return B.explode_annotations(g).drop("chunk")


@register(
    "valid_boxes",
    views=["scaled"],
    sql="""
select ImageID, box_id, LabelName, xmin, ymin, xmax, ymax from scaled
where xmin is not null and ymin is not null and xmax is not null and ymax is not null
  and xmax > xmin and ymax > ymin
""",
)
def q_valid_boxes(fx):
    return B.drop_invalid(fx.scaled).select("ImageID", "box_id", "LabelName", "xmin", "ymin", "xmax", "ymax")


_VALID_CTE = """valid as (select * from scaled where xmin is not null and ymin is not null and xmax is not null
    and ymax is not null and xmax > xmin and ymax > ymin)"""


@register(
    "images_with_boxes",
    views=["scaled"],
    extra_ctes=_VALID_CTE,
    sql="select ImageID, count(*) as n_boxes from valid group by ImageID",
)
def q_images_with_boxes(fx):
    return B.images_with_boxes(B.drop_invalid(fx.scaled))


# --------------------------------------------------------------- image lists

_NORM_CTE = r"""parsed_in as (select line, replace(regexp_replace(line, '^\s+|\s+$', '', 'g'), '.jpg', '') as n
    from image_list)"""
_PAT = "^(test|train|validation|challenge2018)/([a-fA-F0-9]*)"


@register(
    "parse_image_list",
    views=["image_list"],
    extra_ctes=_NORM_CTE,
    sql=f"""
select line, regexp_extract(n, '{_PAT}', 1) as split, regexp_extract(n, '{_PAT}', 2) as image_id
from parsed_in where regexp_matches(n, '{_PAT}')
""",
)
def q_parse_image_list(fx):
    from boxframe.operators.listing import parse_image_list

    return parse_image_list(fx.image_list, col="line")


@register(
    "rejected_lines",
    views=["image_list"],
    extra_ctes=_NORM_CTE,
    sql=f"select line from parsed_in where line is null or not regexp_matches(n, '{_PAT}')",
)
def q_rejected_lines(fx):
    from boxframe.operators.listing import rejected_lines

    return rejected_lines(fx.image_list, col="line")


@register(
    "object_keys",
    views=["image_list"],
    extra_ctes=_NORM_CTE,
    sql=f"""
select split, image_id, split || '/' || image_id || '.jpg' as src_key,
       'images/' || split || '/' || image_id || '.jpg' as dst_key
from (select regexp_extract(n, '{_PAT}', 1) as split, regexp_extract(n, '{_PAT}', 2) as image_id
      from parsed_in where regexp_matches(n, '{_PAT}')) p
""",
)
def q_object_keys(fx):
    from boxframe.operators.listing import parse_image_list, with_object_keys

    p = parse_image_list(fx.image_list, col="line")
    return with_object_keys(p, "", "images/").select("split", "image_id", "src_key", "dst_key")


@register(
    "split_uri",
    views=["all_objects"],
    sql="""
select path, split_part(path, '/', 3) as bucket,
       substr(path, strlen(split_part(path, '/', 1)) + strlen(split_part(path, '/', 2))
                    + strlen(split_part(path, '/', 3)) + 4) as key
from all_objects
""",
)
def q_split_uri(fx):
    from boxframe.functions.ids import split_uri

    bucket, key = split_uri("path")
    return fx.all_objects.select("path", bucket.alias("bucket"), key.alias("key"))


_IDS_CTE = """ids as (select path, replace(string_split(path, '/')[-1], '.jpg', '') as image_id
    from objects where ends_with(path, '.jpg'))"""


@register("listing_ids", views=["all_objects"], extra_ctes=_IDS_CTE.replace("from objects", "from all_objects"),
          sql="select path, image_id from ids")
def q_listing_ids(fx):
    from boxframe.operators.presence import listing_ids

    return listing_ids(fx.all_objects)


@register(
    "transfer_summary",
    views=["image_list", "objects"],
    extra_ctes=_NORM_CTE
    + f""",
parsed as (select regexp_extract(n, '{_PAT}', 1) as split, regexp_extract(n, '{_PAT}', 2) as image_id
           from parsed_in where regexp_matches(n, '{_PAT}'))""",
    sql="""
select split, cast(sum(case when exists (select 1 from objects o
                    where o.path = 'gs://bkt_1/resized/' || p.image_id || '.jpg') then 1 else 0 end) as bigint) as n_ok,
       count(*) as n_total
from parsed p group by split
""",
)
def q_transfer_summary(fx):
    from boxframe.operators.listing import parse_image_list
    from boxframe.operators.transfer import existence_manifest, transfer_summary

    p = parse_image_list(fx.image_list, col="line")
    m = existence_manifest(p, fx.objects, "gs://bkt_1/resized/")
    return transfer_summary(m)


# --------------------------------------------------------------- presence


def _images(fx):
    return fx.scaled.select("ImageID").distinct()


@register(
    "existing_images",
    views=["scaled", "objects"],
    extra_ctes=_IDS_CTE,
    sql="select distinct ImageID from scaled where ImageID in (select image_id from ids)",
)
def q_existing(fx):
    from boxframe.operators.presence import listing_ids, with_existing_images

    return with_existing_images(_images(fx), listing_ids(fx.objects))


@register(
    "missing_images",
    views=["scaled", "objects"],
    extra_ctes=_IDS_CTE,
    sql="select distinct ImageID from scaled where ImageID not in (select image_id from ids)",
)
def q_missing(fx):
    from boxframe.operators.presence import listing_ids, missing_images

    return missing_images(_images(fx), listing_ids(fx.objects))


# --------------------------------------------------------------- labels


def _processed(fx):
    return B.to_processed(fx.scaled, "gs://bkt_1/resized/", order_by="box_id")


@register(
    "label_array_projection",
    views=["scaled"],
    sql="select ImageID, string_agg(LabelName, ',' order by box_id) as labels from scaled group by ImageID",
)
def q_label_array(fx):
    return _processed(fx).select("ImageID", F.array_join(F.col("Annotations.LabelName"), ",").alias("labels"))


_VOCAB_CTE = """vocab as (select LabelName, cast(row_number() over (order by LabelName) - 1 as int) as idx
    from (select distinct LabelName from scaled where LabelName is not null) t)"""


@register("label_vocabulary", views=["scaled"], extra_ctes=_VOCAB_CTE, sql="select LabelName, idx from vocab")
def q_label_vocabulary(fx):
    from boxframe.operators.labels import build_vocabulary

    return build_vocabulary(fx.scaled)


@register(
    "encoded_targets",
    views=["scaled"],
    extra_ctes=_VALID_CTE + ",\n" + _VOCAB_CTE,
    sql="""
select v.ImageID, cast(row_number() over (partition by v.ImageID order by v.box_id) - 1 as int) as pos,
       cast(v.xmin as float) as x0, cast(v.ymin as float) as y0, cast(v.xmax as float) as x1,
       cast(v.ymax as float) as y1, cast(l.idx as bigint) as label
from valid v left join vocab l on v.LabelName = l.LabelName
""",
)
def q_encoded_targets(fx):
    from boxframe.operators.labels import build_vocabulary, training_targets
    from boxframe.session import cut_lineage

    vocab = cut_lineage(build_vocabulary(fx.scaled))
    t = training_targets(B.drop_invalid(fx.scaled), vocab)
    e = t.select("ImageID", "labels", F.posexplode("boxes").alias("pos", "b"))
    return e.select(
        "ImageID",
        "pos",
        F.col("b")[0].alias("x0"),
        F.col("b")[1].alias("y0"),
        F.col("b")[2].alias("x1"),
        F.col("b")[3].alias("y1"),
        F.element_at("labels", F.col("pos") + 1).alias("label"),
    )


@register(
    "bucketed_targets",
    views=["scaled"],
    extra_ctes=_VALID_CTE + ",\n" + _VOCAB_CTE,
    sql="""
select v.ImageID, cast(v.xmin as float) as x0, cast(v.ymin as float) as y0, cast(v.xmax as float) as x1,
       cast(v.ymax as float) as y1, cast(l.idx as bigint) as label
from valid v left join vocab l on v.LabelName = l.LabelName
""",
)
def q_bucketed_targets(fx):
    """Targets from a processed table in buckets; images spread over several rows (3 boxes each, about) lie beside them."""
    from boxframe.operators.labels import build_vocabulary
    from boxframe.plans.jobs import long_boxes, targets_by_part
    from boxframe.session import cut_lineage, scratch_path
    from boxframe.sources.bucketed import write_bucketed

    named = fx.scaled.select("ImageID", "box_id", *[F.col(c).alias(n) for c, n in zip(("xmin", "ymin", "xmax", "ymax"), ("XMin", "YMin", "XMax", "YMax"))], "LabelName")
    rows = B.group_annotations(named, ("XMin", "YMin", "XMax", "YMax", "LabelName"), order_by="box_id", out="Annotations", max_per_row=3)
    table = write_bucketed(cut_lineage(rows, "processed"), scratch_path(fx.spark, "bucketed"), max_rows_per_key=1)
    boxes = [long_boxes(p) for p in table.parts()]
    t = targets_by_part(boxes, cut_lineage(build_vocabulary(long_boxes(table.rows))))
    return t.select("ImageID", F.inline(F.arrays_zip("boxes", "labels"))).select(
        "ImageID", *[F.col("boxes")[i].alias(c) for i, c in enumerate(("x0", "y0", "x1", "y1"))], F.col("labels").alias("label"))


# --------------------------------------------------------------- splits

_H = "cast('0x' || substring(md5({k}), 1, 8) as bigint)"


@register(
    "split_by_hash",
    views=["scaled"],
    sql=f"""
select ImageID, case when {_H.format(k="'42:' || ImageID")} % 10000 < 8000 then 'train' else 'test' end as split
from (select distinct ImageID from scaled) t
""",
)
def q_split_by_hash(fx):
    from boxframe.operators.split import split_by_hash

    return split_by_hash(_images(fx))


@register(
    "split_exact",
    views=["scaled"],
    sql="""
select ImageID, case when row_number() over (order by md5('42:' || ImageID), ImageID)
                          <= floor(0.8 * count(*) over ()) then 'train' else 'test' end as split
from (select distinct ImageID from scaled) t
""",
)
def q_split_exact(fx):
    from boxframe.operators.split import split_exact

    return split_exact(_images(fx))


@register(
    "sample_one",
    views=["scaled"],
    sql="select ImageID from (select distinct ImageID from scaled) t order by md5('42:' || ImageID), ImageID limit 1",
)
def q_sample_one(fx):
    from boxframe.operators.split import sample_one

    return sample_one(_images(fx))


# --------------------------------------------------------------- shards and batches


@register(
    "shard_filter",
    views=["scaled"],
    sql=f"select ImageID from (select distinct ImageID from scaled) t where {_H.format(k='ImageID')} % 4 = 1",
)
def q_shard_filter(fx):
    from boxframe.operators.batches import shard_filter

    return shard_filter(_images(fx), "ImageID", 4, 1)


_PLAN_CTE = (
    _VALID_CTE
    + f""",
img as (select ImageID, count(*) as n_boxes from valid group by ImageID),
planned as (select ImageID, n_boxes, shard, cast((rn - 1) // 8 as int) as batch_no, cast((rn - 1) % 8 as int) as pos
  from (select ImageID, n_boxes, cast({_H.format(k='ImageID')} % 4 as int) as shard,
               row_number() over (partition by {_H.format(k='ImageID')} % 4 order by md5(ImageID), ImageID) as rn
        from img) t)"""
)


def _plan(fx):
    from boxframe.operators.batches import plan_batches

    img = B.images_with_boxes(B.drop_invalid(fx.scaled))
    return plan_batches(img, "ImageID", world_size=4, batch_size=8)


@register("batch_plan", views=["scaled"], extra_ctes=_PLAN_CTE, sql="select ImageID, shard, batch_no, pos from planned")
def q_batch_plan(fx):
    return _plan(fx).select("ImageID", "shard", "batch_no", "pos")


@register(
    "batch_assembly",
    views=["scaled"],
    extra_ctes=_PLAN_CTE,
    sql="""
select shard, batch_no, cast(count(*) as int) as n_items, string_agg(ImageID, ',' order by pos) as image_ids,
       cast(sum(n_boxes) as bigint) as n_boxes
from planned group by shard, batch_no
""",
)
def q_batch_assembly(fx):
    from boxframe.operators.batches import assemble_batches

    a = assemble_batches(_plan(fx), ["ImageID", "n_boxes"])
    return a.select(
        "shard",
        "batch_no",
        "n_items",
        F.array_join(F.col("items.ImageID"), ",").alias("image_ids"),
        F.aggregate(F.col("items.n_boxes"), F.lit(0).cast("bigint"), lambda acc, x: acc + x).alias("n_boxes"),
    )


@register(
    "shard_partitions",
    views=["scaled"],
    extra_ctes=_PLAN_CTE,
    sql="select shard, count(*) as n_rows, cast(1 as bigint) as n_files from planned group by shard",
)
def q_shard_partitions(fx):
    """The plan written by shard: every shard's rows lie together, in one file of its folder."""
    from boxframe.operators.batches import partition_by_shard
    from boxframe.session import scratch_path

    path = scratch_path(fx.spark, "by-shard")
    partition_by_shard(_plan(fx)).write.partitionBy("shard").parquet(path)
    back = fx.spark.read.parquet(path).withColumn("_file", F.input_file_name())
    return back.groupBy("shard").agg(F.count("*").alias("n_rows"), F.countDistinct("_file").alias("n_files"))


@register(
    "loader_batches",
    views=["scaled", "image_meta"],
    extra_ctes=_PLAN_CTE + """,
vocab as (select LabelName, row_number() over (order by LabelName) - 1 as idx from (select distinct LabelName from valid)),
tgt as (select v.ImageID, sum(v.xmin + 2 * v.ymin + 3 * v.xmax + 4 * v.ymax) as box_sum, sum(c.idx) as label_sum
        from valid v join vocab c on c.LabelName = v.LabelName group by v.ImageID)""",
    sql="""
select p.shard, p.batch_no, cast(count(*) as int) as n_items, cast(sum(t.box_sum) as bigint) as box_sum,
       cast(sum(t.label_sum) as bigint) as label_sum, cast(sum(greatest(1, m.width // 16) * greatest(1, m.height // 16) * 3) as bigint) as n_values
from planned p join tgt t on t.ImageID = p.ImageID join image_meta m on m.ImageID = p.ImageID
where cast('0x' || substring(p.ImageID, 15, 2) as int) % 97 <> 0
group by p.shard, p.batch_no
""",
)
def q_loader_batches(fx):
    """What a training loader takes: the plan joined with targets, one row per batch, and the tensors read by its task."""
    from boxframe.operators.batches import assemble_batches
    from boxframe.operators.fetch import image_paths, load_batches
    from boxframe.operators.labels import build_vocabulary, training_targets
    from boxframe.plans.queries_images import _rendered

    valid = B.drop_invalid(fx.scaled)
    targets = training_targets(valid, build_vocabulary(valid))
    rows = image_paths(_plan(fx).select("ImageID", "shard", "batch_no", "pos"), _rendered(fx), ".png").join(targets, "ImageID")
    plan = assemble_batches(rows, ["ImageID", "path", "boxes", "labels"])

    def sizes(loaded):
        import numpy as np
        import pyarrow as pa

        for part in loaded:
            tensors = part.column("tensors")
            upto = np.cumsum([0, *tensors.flatten().value_lengths().to_pylist()])
            counts = np.cumsum([0, *part.column("n_items").to_pylist()])
            columns = [part.column(c) for c in ("shard", "batch_no", "items", "n_items")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.diff(upto[counts]), pa.int64())], names=["shard", "batch_no", "items", "n_items", "n_values"])

    kinds = {f.name: f.dataType.simpleString() for f in plan.schema}
    schema = f"shard {kinds['shard']}, batch_no {kinds['batch_no']}, items {kinds['items']}, n_items int, n_values bigint"
    batches = load_batches(plan, _rendered(fx), then=(sizes, schema)).where("n_items > 0")

    def total(of):
        return F.aggregate("items", F.lit(0).cast("bigint"), lambda a, i: a + of(i))

    def boxes(i):
        return F.aggregate(i["boxes"], F.lit(0).cast("bigint"), lambda a, b: a + (b[0] + 2 * b[1] + 3 * b[2] + 4 * b[3]).cast("bigint"))

    return batches.select(
        "shard", "batch_no", "n_items", total(boxes).alias("box_sum"),
        total(lambda i: F.aggregate(i["labels"], F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("label_sum"), "n_values")


@register(
    "epoch_shuffle",
    views=["scaled"],
    sql=f"""
select ImageID, epoch, shard, cast((rn - 1) // 8 as int) as batch_no, cast((rn - 1) % 8 as int) as pos
from (select ImageID, epoch, shard,
             row_number() over (partition by epoch, shard
                                order by md5('42:' || cast(epoch as varchar) || ':' || ImageID), ImageID) as rn
      from (select ImageID, cast(e.epoch as int) as epoch, cast({_H.format(k='ImageID')} % 2 as int) as shard
            from (select distinct ImageID from scaled) t, (select range as epoch from range(1, 6)) e
            where {_H.format(k="'42:' || ImageID")} % 10000 < 8000) s) r
""",
)
def q_epoch_shuffle(fx):
    from boxframe.operators.batches import epoch_plan
    from boxframe.operators.split import split_by_hash

    train = split_by_hash(_images(fx)).where(F.col("split") == "train").drop("split")
    return epoch_plan(train, epochs=5, world_size=2, batch_size=8, seed=42).select(
        "ImageID", "epoch", "shard", "batch_no", "pos"
    )


_RN_CTE = (
    _VALID_CTE
    + f""",
img as (select ImageID, count(*) as n_boxes from valid group by ImageID),
pl as (select ImageID, cast({_H.format(k='ImageID')} % 4 as int) as shard,
              row_number() over (partition by {_H.format(k='ImageID')} % 4 order by md5(ImageID), ImageID) as rn
       from img),
sz as (select shard, count(*) as size from pl group by shard),
nd as (select s.shard, s.size, t.target - s.size as need from sz s, (select max(size) as target from sz) t),
ex as (select * from (select p.ImageID, p.shard, p.rn, n.size, n.need,
                             unnest(generate_series(1, cast(ceil(cast(n.need as double) / n.size) as bigint))) as k
                      from pl p join nd n on p.shard = n.shard where n.need > 0) t
       where size * (k - 1) + rn <= need),
allr as (select ImageID, shard, rn, false as padded from pl
         union all select ImageID, shard, size * k + rn as rn, true as padded from ex)"""
)


@register(
    "batch_plan_padded",
    views=["scaled"],
    extra_ctes=_RN_CTE,
    sql="select ImageID, shard, cast((rn - 1) // 8 as int) as batch_no, cast((rn - 1) % 8 as int) as pos, padded from allr",
)
def q_batch_plan_padded(fx):
    from boxframe.operators.batches import plan_batches

    img = B.images_with_boxes(B.drop_invalid(fx.scaled))
    return plan_batches(img, "ImageID", world_size=4, batch_size=8, pad=True).select(
        "ImageID", "shard", "batch_no", "pos", "padded"
    )


@register(
    "batch_counts",
    views=["scaled"],
    extra_ctes=_RN_CTE,
    sql="""
select shard, n_rows, cast(ceil(n_rows / 8) as bigint) as n_batches,
       cast((sum(n_rows) over () // 4 + 7) // 8 as bigint) as num_batches
from (select shard, count(*) as n_rows from pl group by shard) t
""",
)
def q_batch_counts(fx):
    from boxframe.operators.batches import batch_counts

    return batch_counts(B.images_with_boxes(B.drop_invalid(fx.scaled)), "ImageID", world_size=4, batch_size=8)


@register(
    "preview_processed",
    views=["scaled"],
    sql="""
select ImageID, count(*) as n_boxes, 'gs://bkt_1/resized/' || ImageID || '.jpg' as FilePath
from scaled group by ImageID order by ImageID limit 5
""",
)
def q_preview(fx):
    # the five ids first, then only their boxes are grouped
    ids = fx.scaled.select("ImageID").distinct().orderBy("ImageID").limit(5)
    few = B.to_processed(fx.scaled.join(F.broadcast(ids), "ImageID", "left_semi"), "gs://bkt_1/resized/", order_by="box_id")
    return few.select("ImageID", F.size("Annotations").cast("bigint").alias("n_boxes"), "FilePath")


@register(
    "page_subtract",
    views=["scaled"],
    sql="""
select ImageID, n_boxes from (select ImageID, count(*) as n_boxes from scaled group by ImageID) t
order by md5(ImageID), ImageID limit 8 offset 16
""",
)
def q_page_subtract(fx):
    from boxframe.functions.hashing import hash_order_key
    from boxframe.operators.batches import rows_page

    p = _processed(fx).withColumn("_ok", hash_order_key("ImageID"))
    page = rows_page(p, ["_ok", "ImageID"], start=16, size=8)
    return page.select("ImageID", F.size("Annotations").cast("bigint").alias("n_boxes"))


@register(
    "box_page",
    views=["scaled"],
    sql="""
select ImageID, box_id, xmin, LabelName from scaled
order by xmin, LabelName, ImageID, box_id limit 500 offset (select count(*) // 2 from scaled)
""",
)
def q_box_page(fx):
    """A page from the middle of all boxes, by rank selection in parts of 2,000 rows."""
    from boxframe.operators.batches import rows_page

    rows = fx.scaled.select("ImageID", "box_id", "xmin", "LabelName")
    return rows_page(rows, ["xmin", "LabelName", "ImageID", "box_id"], rows.count() // 2, 500, few=2_000)


@register(
    "loss_by_epoch",
    views=["training_log"],
    sql="""
select rank, epoch, round(sum(loss), 6) as epoch_loss, count(*) as n_batches
from training_log group by rank, epoch
""",
)
def q_loss_by_epoch(fx):
    from boxframe.operators.metrics import loss_by_epoch

    return loss_by_epoch(fx.training_log)
