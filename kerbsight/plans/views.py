"""Domain views over the synthetic tables: each by arithmetic on keys, in Spark and as DuckDB common table expressions.

The tables carry no coordinates or boxes, so frames, detections, permits and the rest derive them from their keys. Nulls
and zeros are put in on purpose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.withColumns({c: F.col(c).cast("timestamp") for c, kind in df.dtypes if kind == "timestamp_ntz"})


def _expr(df: DataFrame, *columns: str) -> DataFrame:
    return df.selectExpr(*columns)


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").where("event_id % 3 = 0")
    return _expr(
        e, "event_id as frame_id", "concat('img_', event_id, '.jpg') as image_name", "ts as gps_timestamp", "timestampadd(SECOND, event_id % 8, ts) as image_timestamp",
        "case when event_id % 53 = 0 then null when event_id % 47 = 0 then 0D else 52.3D + ((event_id div 12) * 7919 % 9973) / 1e5D + (event_id % 12) * 2e-5D end as gps_lat",
        "4.8D + ((event_id div 12) * 104729 % 14983) / 1e5D as gps_lon", "if(event_id % 11 = 0, 'Processed', 'Pending') as status",
    )


FRAMES = """frames as (select event_id as frame_id, 'img_' || event_id || '.jpg' as image_name, ts as gps_timestamp,
  ts + to_seconds(event_id % 8) as image_timestamp,
  case when event_id % 53 = 0 then null when event_id % 47 = 0 then 0::double else 52.3::double + ((event_id // 12) * 7919 % 9973) / 1e5 + (event_id % 12) * 2e-5 end as gps_lat,
  4.8::double + ((event_id // 12) * 104729 % 14983) / 1e5 as gps_lon,
  case when event_id % 11 = 0 then 'Processed' else 'Pending' end as status from events where event_id % 3 = 0)"""


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _expr(
        table(spark, sf_dir, "events"), "event_id as detection_id", "event_id - event_id % 3 as frame_id",
        "case event_type when 'view' then 0 when 'click' then 1 when 'purchase' then 2 when 'signup' then 3 else 4 end as object_class",
        "cast((event_id * 31 % 1000) / 1000D as float) as confidence", "cast((1 + user_id % 50) / 100D as float) as width", "cast((1 + event_id % 40) / 100D as float) as height",
        "cast((event_id * 17 % 1000) / 1000D as float) as x_center", "cast((event_id * 13 % 1000) / 1000D as float) as y_center", "cast(event_id % 7 as int) as tracking_id",
        "if(event_id % 13 = 0, 'Processed', 'Pending') as status",
    )


DETECTIONS = """detections as (select event_id as detection_id, event_id - event_id % 3 as frame_id,
  case event_type when 'view' then 0 when 'click' then 1 when 'purchase' then 2 when 'signup' then 3 else 4 end as object_class,
  cast((event_id * 31 % 1000) / 1000::double as float) as confidence, cast((1 + user_id % 50) / 100::double as float) as width, cast((1 + event_id % 40) / 100::double as float) as height,
  cast((event_id * 17 % 1000) / 1000::double as float) as x_center, cast((event_id * 13 % 1000) / 1000::double as float) as y_center, cast(event_id % 7 as int) as tracking_id,
  case when event_id % 13 = 0 then 'Processed' else 'Pending' end as status from events)"""


def permits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _expr(
        table(spark, sf_dir, "part"), "p_partkey as permit_id", "concat('P-', p_partkey) as kenmerk", "cast(2 + p_partkey % 3 as int) as object_class",
        "52.3D + (p_partkey * 7919 % 9973) / 1e5D + (1 + p_partkey % 13) * 1e-4D as lat", "4.8D + (p_partkey * 104729 % 14983) / 1e5D as lon",
        "date_add(date'2024-01-10', cast(p_partkey % 40 - 20 as int)) as valid_from", "date_add(date'2024-01-10', cast(p_partkey % 40 - 10 + p_partkey % 30 as int)) as valid_to",
        """case when p_partkey % 17 = 0 then '[{"object": ' when p_partkey % 19 = 0 then null when p_partkey % 5 = 0 then '[{"object": "Puinbak 3m"}, {"object": "DIXI"}]'
           when p_partkey % 3 = 0 then '[{"object": "Container overig"}]' when p_partkey % 3 = 1 then '[{"object": "Mobiel toilet"}]' else '[{"object": "Hoogwerker"}, {"object": "Steigerdelen"}]' end as objecten""",
    )


PERMITS = """permits as (select p_partkey as permit_id, 'P-' || p_partkey as kenmerk, cast(2 + p_partkey % 3 as int) as object_class,
  52.3::double + (p_partkey * 7919 % 9973) / 1e5 + (1 + p_partkey % 13) * 1e-4 as lat, 4.8::double + (p_partkey * 104729 % 14983) / 1e5 as lon,
  date '2024-01-10' + cast(p_partkey % 40 - 20 as int) as valid_from, date '2024-01-10' + cast(p_partkey % 40 - 10 + p_partkey % 30 as int) as valid_to from part)"""


def bridges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _expr(
        table(spark, sf_dir, "supplier"), "s_suppkey as bridge_id", "120000D + s_suppkey * 611 % 9973 as ax", "480000D + s_suppkey * 3571 % 9949 as ay",
        "120000D + s_suppkey * 611 % 9973 + 30 + s_suppkey % 50 as bx", "480000D + s_suppkey * 3571 % 9949 + s_suppkey % 70 - 35 as by",
    )


def grid_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames as points on the metric grid of :func:`bridges`."""
    return _expr(table(spark, sf_dir, "events").where("event_id % 3 = 0"), "event_id as frame_id", "120000D + event_id * 7919 % 9973 as x", "480000D + event_id * 104729 % 9949 as y")


GRID = """points as (select event_id as frame_id, 120000::double + event_id * 7919 % 9973 as x, 480000::double + event_id * 104729 % 9949 as y from events where event_id % 3 = 0),
bridges as (select s_suppkey as bridge_id, 120000::double + s_suppkey * 611 % 9973 as ax, 480000::double + s_suppkey * 3571 % 9949 as ay,
  120000::double + s_suppkey * 611 % 9973 + 30 + s_suppkey % 50 as bx, 480000::double + s_suppkey * 3571 % 9949 + s_suppkey % 70 - 35 as by_ from supplier)"""


def districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 rectangles of 0.02 by 0.03 degrees, as rings of (x, y)."""
    n = table(spark, sf_dir, "nation").selectExpr("n_nationkey as k", "n_name as district", "4.8D + (n_nationkey % 5) * 0.03D as x0", "52.3D + (n_nationkey div 5) * 0.02D as y0")
    corner = lambda dx, dy: F.struct((F.col("x0") + dx).alias("x"), (F.col("y0") + dy).alias("y"))
    return n.select("k", "district", F.array(corner(0.0, 0.0), corner(0.03, 0.0), corner(0.03, 0.02), corner(0.0, 0.02)).alias("ring"))


DISTRICTS = """districts as (select n_nationkey as k, n_name as district, 4.8::double + (n_nationkey % 5) * 0.03::double as x0, 52.3::double + (n_nationkey // 5) * 0.02::double as y0 from nation)"""


def terrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rectangles of public ground on the metric grid."""
    p = table(spark, sf_dir, "part").where("p_partkey % 4 = 0").selectExpr("p_partkey as terrain_id", "120000D + p_partkey * 3571 % 9973 as x0", "480000D + p_partkey * 611 % 9949 as y0")
    corner = lambda dx, dy: F.struct((F.col("x0") + dx).alias("x"), (F.col("y0") + dy).alias("y"))
    return p.select("terrain_id", F.array(corner(0.0, 0.0), corner(60.0, 0.0), corner(60.0, 40.0), corner(0.0, 40.0)).alias("ring"))


TERRAIN = """terrain as (select p_partkey as terrain_id, 120000::double + p_partkey * 3571 % 9973 as x0, 480000::double + p_partkey * 611 % 9949 as y0 from part where p_partkey % 4 = 0)"""


def gt_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _expr(
        table(spark, sf_dir, "events").where("event_id % 2 = 0"), "event_id + 1 as gt_id", "event_id div 10 as image_id", "cast(2 + event_id % 3 as int) as object_class",
        "cast(event_id * 37 % 1100 as double) as x0", "cast(event_id * 53 % 600 as double) as y0",
        "cast(event_id * 37 % 1100 + 20 + event_id % 100 as double) as x1", "cast(event_id * 53 % 600 + 20 + event_id % 90 as double) as y1",
    )


def pred_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _expr(
        table(spark, sf_dir, "events").where("event_id % 5 <> 1"), "event_id as pred_id", "event_id div 10 as image_id", "cast(2 + (event_id + if(event_id % 29 = 0, 1, 0)) % 3 as int) as object_class",
        "(event_id * 31 % 1000) / 1000D as score", "cast(event_id * 37 % 1100 + event_id % 7 - 3 as double) as x0", "cast(event_id * 53 % 600 + event_id % 5 - 2 as double) as y0",
        "cast(event_id * 37 % 1100 + 20 + event_id % 100 + event_id % 9 - 4 as double) as x1", "cast(event_id * 53 % 600 + 20 + event_id % 90 + event_id % 11 - 5 as double) as y1",
    )


BOXES = """gt as (select event_id + 1 as gt_id, event_id // 10 as image_id, cast(2 + event_id % 3 as int) as object_class,
  cast(event_id * 37 % 1100 as double) as x0, cast(event_id * 53 % 600 as double) as y0,
  cast(event_id * 37 % 1100 + 20 + event_id % 100 as double) as x1, cast(event_id * 53 % 600 + 20 + event_id % 90 as double) as y1 from events where event_id % 2 = 0),
pred as (select event_id as pred_id, event_id // 10 as image_id, cast(2 + (event_id + case when event_id % 29 = 0 then 1 else 0 end) % 3 as int) as object_class,
  (event_id * 31 % 1000) / 1000::double as score, cast(event_id * 37 % 1100 + event_id % 7 - 3 as double) as x0, cast(event_id * 53 % 600 + event_id % 5 - 2 as double) as y0,
  cast(event_id * 37 % 1100 + 20 + event_id % 100 + event_id % 9 - 4 as double) as x1, cast(event_id * 53 % 600 + 20 + event_id % 90 + event_id % 11 - 5 as double) as y1 from events where event_id % 5 <> 1)"""


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _expr(
        table(spark, sf_dir, "customer"), "c_custkey as address_id",
        """case when c_custkey % 31 = 0 then 'geen adres' else concat('Lange Kade ', c_nationkey, ' ', 1 + c_custkey % 200, if(c_custkey % 4 = 0, 'A', ''), ', ', 1000 + c_custkey % 90, if(c_custkey % 2 = 0, ' ', ''), 'AB') end as address""",
    )


ADDRESSES = """addresses as (select c_custkey as address_id,
  case when c_custkey % 31 = 0 then 'geen adres' else 'Lange Kade ' || c_nationkey || ' ' || (1 + c_custkey % 200) || case when c_custkey % 4 = 0 then 'A' else '' end || ', ' || (1000 + c_custkey % 90) || case when c_custkey % 2 = 0 then ' ' else '' end || 'AB' end as address from customer)"""


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _expr(table(spark, sf_dir, "orders"), "o_orderkey as id", "concat('S-', o_orderkey) as signal_id", "case o_orderstatus when 'O' then 'Gemeld' when 'F' then 'Afgehandeld' else 'In behandeling' end as state", "o_custkey as reporter")


TICKETS = """tickets as (select o_orderkey as id, 'S-' || o_orderkey as signal_id, case o_orderstatus when 'O' then 'Gemeld' when 'F' then 'Afgehandeld' else 'In behandeling' end as state, o_custkey as reporter from orders)"""
