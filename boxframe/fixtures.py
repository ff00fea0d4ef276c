"""Test inputs derived from the driver's parquet tables (see FIXTURES.md).

Each view is one SQL text that runs unchanged in Spark SQL and in DuckDB.
Table references are ``{name}`` placeholders: Spark fills them with
DataFrames (``spark.sql(text, orders=df)``), the DuckDB oracle with plain
view names, so both engines see the same text.

``scaled`` is listed for the oracle only: on the Spark side it is produced by
``boxframe.operators.boxes.scale_boxes`` -- the operator under test.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEW_SQL: dict[str, str] = {
    "image_meta": """
select lpad(lower(hex(o_orderkey)), 16, '0') as ImageID,
       cast(320 + (o_custkey * 7) % 705 as int) as width,
       cast(240 + (o_orderkey * 11) % 529 as int) as height
from {orders}
""",
    "image_list": """
select case o_orderkey % 10
         when 0 then concat('bogus/', id)
         when 1 then concat('  train/', id, '.jpg ')
         when 2 then concat('validation/', upper(id))
         when 3 then concat('test/', id, '.jpg')
         when 4 then concat('challenge2018/', id, 'zz')
         when 5 then 'train/'
         else concat('train/', id) end as line
from (select o_orderkey, lpad(lower(hex(o_orderkey)), 16, '0') as id from {orders}) t
""",
    "all_objects": """
select concat('gs://bkt_1/resized/', lpad(lower(hex(o_orderkey)), 16, '0'),
              case when o_orderkey % 7 = 0 then '.png' else '.jpg' end) as path
from {orders}
""",
    "objects": """
select concat('gs://bkt_1/resized/', lpad(lower(hex(o_orderkey)), 16, '0'),
              case when o_orderkey % 7 = 0 then '.png' else '.jpg' end) as path
from {orders} where o_orderkey % 10 <> 3
""",
    "boxes": """
select lpad(lower(hex(l_orderkey)), 16, '0') as ImageID,
       l_orderkey * 100000 + rn as box_id,
       case when (l_orderkey + l_partkey) % 997 = 0 then null else x0 end as XMin,
       y0 as YMin, x0 + w as XMax, y0 + h as YMax,
       concat('/m/', lower(rf), lower(ls), cast(sk % 5 as varchar(10))) as LabelName
from (select l_orderkey, l_partkey, l_linenumber, sk, rf, ls, rn,
             cast((l_partkey * 37 + l_linenumber * 101) % 900 - 20 as double) / 1000 as x0,
             cast((l_partkey * 59 + sk * 13) % 900 - 20 as double) / 1000 as y0,
             cast((sk * 53 + l_linenumber * 17) % 400 as double) / 1000 as w,
             cast((sk * 29 + l_partkey * 3) % 400 as double) / 1000 as h
      from (select l_orderkey, l_partkey, l_linenumber, l_suppkey as sk, l_returnflag as rf, l_linestatus as ls,
                   row_number() over (partition by l_orderkey
                                      order by l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus) as rn
            from {lineitem}) a) b
""",
    "scaled": """
select ImageID, box_id, LabelName,
       greatest(0, cast(sign(px0) * floor(abs(px0)) as int)) as xmin,
       greatest(0, cast(sign(py0) * floor(abs(py0)) as int)) as ymin,
       least(299, cast(sign(px1) * floor(abs(px1)) as int)) as xmax,
       least(299, cast(sign(py1) * floor(abs(py1)) as int)) as ymax
from (select b.ImageID as ImageID, b.box_id as box_id, b.LabelName as LabelName,
             b.XMin * m.width * (cast(299 as double) / m.width) as px0,
             b.YMin * m.height * (cast(299 as double) / m.height) as py0,
             b.XMax * m.width * (cast(299 as double) / m.width) as px1,
             b.YMax * m.height * (cast(299 as double) / m.height) as py1
      from {boxes} b join {image_meta} m on b.ImageID = m.ImageID
      where b.ImageID not in (select ImageID from {boxes} where XMin is null)) t
""",
    "detections": """
select ImageID, box_id as det_id,
       xmin + cast(box_id % 23 as int) - 11 as xmin, ymin + cast(box_id % 17 as int) - 8 as ymin,
       xmax + cast(box_id % 19 as int) - 9 as xmax, ymax + cast(box_id % 13 as int) - 6 as ymax,
       cast((box_id * 31) % 1000 as double) / 1000 as score,
       case when box_id % 11 = 0 then '/m/other' else LabelName end as LabelName
from {scaled} where xmax > xmin and ymax > ymin and box_id % 7 <> 0
""",
    "training_log": """
select cast(user_id % 4 as int) as rank, cast(event_id % 5 as int) + 1 as epoch,
       event_id as batch, value as loss
from {events}
""",
}

# Which placeholders each view reads.
VIEW_DEPS: dict[str, tuple[str, ...]] = {
    "image_meta": ("orders",),
    "image_list": ("orders",),
    "all_objects": ("orders",),
    "objects": ("orders",),
    "boxes": ("lineitem",),
    "scaled": ("boxes", "image_meta"),
    "detections": ("scaled",),
    "training_log": ("events",),
}

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, name: str, **inputs: DataFrame) -> DataFrame:
    """Build one fixture view in Spark from the given input DataFrames."""
    missing = [d for d in VIEW_DEPS[name] if d not in inputs]
    if missing:
        raise ValueError(f"view {name} needs {missing}")
    return spark.sql(VIEW_SQL[name], **{d: inputs[d] for d in VIEW_DEPS[name]})


# Derived input tables written once per application: (app id, folder, view) -> path.
_STORED: dict[tuple[str, str, str], str] = {}

# Views stored as tables. ``boxes`` stands in for the annotation file,
# ``scaled`` for the processed table the preprocess job writes, and
# ``detections`` for the detector's output table.
STORED_VIEWS = ("boxes", "scaled", "detections")


class Fixtures:
    """Lazily built fixture views over one scale-factor folder.

    ``scaled`` comes from the library operator (``scale_boxes``), and
    ``detections`` is derived from it with the fixture SQL. The stored views
    are written to the shared checkpoint folder the first time an
    application asks for them and read back afterwards, the way downstream
    jobs read the tables an upstream job wrote.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = table(self.spark, self.sf_dir, name)
        return self._cache[name]

    def _build(self, name: str) -> DataFrame:
        if name == "scaled":
            from boxframe.operators.boxes import scale_boxes

            return scale_boxes(self.boxes, self.image_meta).result
        deps = {d: getattr(self, d) for d in VIEW_DEPS[name]}
        return view(self.spark, name, **deps)

    def _stored(self, name: str) -> DataFrame:
        from boxframe.session import scratch_path

        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        path = _STORED.get(key)
        if path is None:
            path = scratch_path(self.spark, name)
            self._build(name).write.mode("overwrite").parquet(path)
            _STORED[key] = path
        return self.spark.read.parquet(path)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in VIEW_SQL and name not in BASE_TABLES:
            raise AttributeError(name)
        if name in BASE_TABLES:
            return self.table(name)
        if name not in self._cache:
            self._cache[name] = self._stored(name) if name in STORED_VIEWS else self._build(name)
        return self._cache[name]


def duckdb_ctes(names: list[str]) -> str:
    """``with`` clause defining the given fixture views (and their dependencies) for DuckDB."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order or n not in VIEW_SQL:
            return
        for d in VIEW_DEPS[n]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    names_map = {n: n for n in list(VIEW_SQL) + BASE_TABLES}
    parts = [f"{n} as ({VIEW_SQL[n].format(**names_map).strip()})" for n in order]
    return "with " + ",\n".join(parts) if parts else ""
