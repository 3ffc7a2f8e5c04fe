"""Input views derived from the ``events`` table.

Each view is one SQL text with dialect slots, so that Spark and the checking
engine read the same definition (see FIXTURES.md).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPARK = {
    "STR": "string",
    "TS": "timestamp_micros(1704067200000000 + "
          "(unix_micros(cast(ts as timestamp)) - 1704067200000000) div 10)",
    "K": "cast(get_json_object(props,'$.k') as int)",
    "Q": "`",
    "BYTES": "encode({0}, 'UTF-8')",
    "SECONDS": "(unix_micros(pass_ts) - 1704067200000000) / 1000000",
    "FMT": "date_format(pass_ts,'yyyy-MM-dd HH:mm:ss')",
    "LONG": "timestamp_micros(1704067200000000 + (unix_micros(pass_ts) - 1704067200000000) div 1000)",
}
DUCKDB = {
    "STR": "varchar",
    "TS": "make_timestamp(1704067200000000 + (epoch_us(ts) - 1704067200000000) // 10)",
    "K": "cast(json_extract_string(props,'$.k') as int)",
    "Q": '"',
    "BYTES": "encode({0})",
    "SECONDS": "(epoch_us(pass_ts) - 1704067200000000) / 1000000",
    "FMT": "strftime(pass_ts,'%Y-%m-%d %H:%M:%S')",
    "LONG": "make_timestamp(1704067200000000 + (epoch_us(pass_ts) - 1704067200000000) // 1000)",
}

PASS_COLUMNS = {
    "event_id": "event_id",
    "pass_ts": "{TS}",
    "device_id": "cast(user_id % 5 as {STR})",
    "vehicle_type": "case event_type when 'click' then 0 when 'view' then 1 "
                    "when 'purchase' then 2 when 'signup' then 3 else 4 end",
    "speed": "cast(value as float)",
    "length": "cast({K} / 10.0 as float)",
    "plate": "concat(substr('云粤京', cast(user_id % 3 as int) + 1, 1), 'A', "
             "lpad(cast((user_id * 37) % 100000 as {STR}), 5, '0'))",
    "plate_color": "substr('蓝黄绿白', cast(event_id % 4 as int) + 1, 1)",
    "plate_type": "cast(user_id % 3 as {STR})",
    "vehicle_brand": "case cast(user_id % 4 as int) when 0 then '别克' when 1 then '宝马' "
                     "when 2 then '奔驰' else '林肯' end",
    "dir": "cast(event_id % 2 as int)",
    "chan_index": "cast(event_id % 4 as int)",
    "drive_chan": "cast(2 + event_id % 3 as int)",
    "illegal_type": "cast(event_id % 6 as int)",
    "alarm_type": "cast(event_id % 3 as int)",
    "site_id": "concat('S', cast(user_id % 9 as {STR}))",
    "task_id": "concat('T', cast(event_id % 7 as {STR}))",
    "camera_id": "concat('C', cast(event_id % 7 as {STR}))",
    "data_source_id": "concat('D', cast(event_id % 7 as {STR}))",
    "tag": "event_id % 2 = 0",
    "paper": "event_id % 3 = 0",
    "sun": "event_id % 5 = 0",
    "drop": "event_id % 7 = 0",
    "second_belt": "event_id % 11 = 0",
    "crash": "event_id % 13 = 0",
    "danger": "event_id % 17 = 0",
    "illegal_sub_type": "concat('sub', cast(event_id % 2 as {STR}))",
    "speed_limit": "cast(60 as int)",
    "detect_type": "cast(event_id % 4 as int)",
    "pilot_safebelt": "cast(event_id % 2 as int)",
    "copilot_safebelt": "cast(event_id % 3 as int)",
    "pilot_sub_visor": "cast(event_id % 5 as int)",
    "copilot_sub_visor": "cast(event_id % 7 as int)",
    "pilot_call": "cast(event_id % 11 as int)",
    "pic_num": "cast(event_id % 3 as int)",
    "vehicle_color": "concat('col', cast(event_id % 8 as {STR}))",
    "color_depth": "cast(event_id % 2 as int)",
    "vehicle_attribute": "cast(event_id % 9 as int)",
    "vehicle_logo": "concat('logo', cast(user_id % 12 as {STR}))",
    "plate_believe": "cast(user_id % 100 as {STR})",
    "plate_bright": "cast(user_id % 256 as int)",
    "plate_country": "cast(86 as int)",
}

VIEWS = {
    "passes": "select "
    + ", ".join(f"{sql} as {{Q}}{name}{{Q}}" for name, sql in PASS_COLUMNS.items())
    + " from events",
    # Gate 4 is missing: its passes take the unknown-gate path. Gates 1 and 2 are listed twice; the greatest seq counts.
    "gate": "select cast(id as int) as id, "
            "case when id % 2 = 0 then '60' else '40,50,60,70,80' end as speedlimit, 2 as seq "
            "from range(4) r(id) union all "
            "select cast(id as int), '99', 1 from range(1, 3) r(id)",
    # Device-minutes of several hundred passes; device 1 has one speed, so that its fold never forgets its start.
    "passes_long": "select event_id, device_id, vehicle_type, length, {LONG} as pass_ts, "
                   "case when device_id = '1' then cast(50 as float) else speed end as speed from passes",
    # Ids into orders, customer and supplier; one order has a third of all passes.
    "hits_large": "select event_id, case when event_id % 3 = 0 then 'T1' "
                  "else concat('T', cast(event_id % 20000 as {STR})) end as task_id, "
                  "concat('C', cast(event_id % 2000 as {STR})) as camera_id, "
                  "concat('D', cast(event_id % 150 as {STR})) as data_source_id from passes",
    # The clock of device 0 runs a day ahead in the first of four files, and files are in no time order.
    "passes_late": "select event_id, device_id, vehicle_type, speed, length, "
                   "case when device_id = '0' and event_id % 4 = 0 then pass_ts + interval '1' day else pass_ts end as pass_ts "
                   "from passes",
    # Four files of 18 hours each; every tenth pass comes one file late.
    "passes_dealt": "select event_id, device_id, vehicle_type, speed, length, pass_ts, "
                    "least(3, cast(floor({SECONDS} / 64800) as int) + case when event_id % 10 = 0 then 1 else 0 end) as batch from passes",
    # The greatest seq wins for a plate.
    "prey": """
        select plate, concat('BK', substr(plate, 3)) as bkxxbh,
          cast(cast(substr(plate, 7, 1) as int) % 3 + 1 as {STR}) as bkjb, 1 as seq
        from (select distinct plate from passes) p where cast(substr(plate, 3) as int) % 5 = 0
        union all
        select plate, concat('BKx', substr(plate, 3)), '9', 2
        from (select distinct plate from passes) p where cast(substr(plate, 3) as int) % 10 = 0""",
    # A plate for each order.
    "prey_large": "select plate, concat('BK', cast(min(id) as {STR})) as bkxxbh, cast(min(id) % 3 + 1 as {STR}) as bkjb "
                  "from (select concat(substr('云粤京', cast(o_orderkey % 3 as int) + 1, 1), 'B', "
                  "lpad(cast(o_orderkey as {STR}), 7, '0')) as plate, o_orderkey as id from orders union all "
                  "select concat(substr('云粤京', cast(o_orderkey % 3 as int) + 1, 1), 'A', "
                  "lpad(cast((o_orderkey * 37) % 100000 as {STR}), 5, '0')), o_orderkey from orders where o_orderkey % 64 = 1) p group by plate",
    # A tenth of the passes has no detail row.
    "result": """
        select event_id as result_id, plate as license, plate_type, plate_color,
          '0.9' as confidence, substr(plate, 1, 1) as license_attribution,
          concat('img/', cast(event_id as {STR})) as image_url, vehicle_color as car_color,
          {FMT} as result_time, dir as direction, cast(event_id % 100 as int) as frame_index,
          cast(vehicle_type as {STR}) as vehicle_kind, vehicle_brand,
          concat('st', cast(event_id % 5 as {STR})) as vehicle_style,
          cast(event_id % 640 as int) as location_left
        from passes where event_id % 10 <> 0""",
}
for _view, _prefix, _label in (("task", "T", "task"), ("camera", "C", "camera"), ("data_source", "D", "source")):
    # Ids 0..5 while the facts use 0..6; `name` is in all three.
    VIEWS[_view] = (
        f"select concat('{_prefix}', cast(id as {{STR}})) as {_view}_id, "
        f"concat('{{{{\"name\":\"{_label}', cast(id as {{STR}}), '\",\"{_view}_owner\":\"o', "
        "cast(id % 2 as {STR}), '\"}}') as doc from range(6) r(id)"
    )


# Keyed JSON made of large tables: (table, id, attribute, attribute).
LARGE = {
    "task": ("orders", "o_orderkey", "o_orderpriority", "o_orderstatus"),
    "camera": ("customer", "c_custkey", "c_name", "c_mktsegment"),
    "data_source": ("supplier", "s_suppkey", "s_name", "s_suppkey"),
}
for _view, (_table, _id, _name, _other) in LARGE.items():
    VIEWS[f"{_view}_large"] = (
        f"select concat('{_view[0].upper()}', cast({_id} as {{STR}})) as {_view}_id, "
        f"concat('{{{{\"name\":\"', {_name}, '\",\"{_view}_kind\":\"', cast({_other} as {{STR}}), '\"}}}}') as doc from {_table}"
    )


def view_sql(name: str, dialect: dict[str, str]) -> str:
    return VIEWS[name].format(**dialect)


def events_path(sf_dir: str) -> str:
    return f"{sf_dir}/events.parquet"


def to_passes(events: DataFrame) -> DataFrame:
    """Works on the table and on the stream alike."""
    return events.selectExpr(
        *[f"{sql.format(**SPARK)} as `{name}`" for name, sql in PASS_COLUMNS.items()]
    )


def passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_passes(spark.read.parquet(events_path(sf_dir)))


def pass_stream_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = events_path(sf_dir)
    schema = spark.read.parquet(path).schema
    # The glob lets the source take one file or a folder of files.
    return to_passes(spark.readStream.schema(schema).parquet(path.replace(".parquet", ".parque[t]")))


@dataclass(frozen=True)
class FilesStream:
    """Frames that come into a folder one after another, each in as many files as it has tasks.

    A run of the streaming query over what is there takes all files of the frame that has come last, as one micro-batch.
    """

    spark: SparkSession
    parts: Sequence[DataFrame]
    folder: str

    def arrivals(self) -> Iterator[DataFrame]:
        """The stream, once behind each frame that has been written, in their order."""
        for part in self.parts:
            part.write.mode("append").parquet(self.folder)
            yield self.spark.readStream.schema(self.parts[0].schema).parquet(self.folder)


def files_stream(spark: SparkSession, parts: Sequence[DataFrame], folder: str) -> FilesStream:
    """The frames as a stream of one micro-batch each, in this order."""
    return FilesStream(spark, parts, folder)


def with_pics(df: DataFrame) -> DataFrame:
    """Adds ``event_id % 3`` pictures to each pass."""
    number = F.slice(F.array(F.lit(1), F.lit(2)), F.lit(1), (F.col("event_id") % 3).cast("int"))
    pic = F.transform(
        number,
        lambda i: F.struct(
            i.alias("type"),
            (i + 10).alias("recog_mode"),
            (i * 5).alias("red_light_time"),
            F.struct(i.alias("x"), i.alias("y"), F.lit(40).alias("w"), F.lit(20).alias("h")).alias("rect"),
            F.encode(F.concat_ws("_", F.col("event_id").cast("string"), i.cast("string")), "UTF-8").alias("data"),
        ),
    )
    return df.withColumn("pics", pic)


def large_dim(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A keyed-JSON dimension out of one of the given tables."""
    table = LARGE[name][0]
    sql = view_sql(f"{name}_large", SPARK).replace(f"from {table}", "from {rows}")
    return spark.sql(sql.replace("'{\"", "'{{\"").replace("\"}'", "\"}}'"), rows=spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def derived(spark: SparkSession, name: str, base: DataFrame | None = None) -> DataFrame:
    """A view of ``VIEWS`` as a DataFrame; ``base`` stands for ``passes``."""
    sql = view_sql(name, SPARK)
    return spark.sql(sql.replace("passes", "{passes}"), passes=base) if base is not None else spark.sql(sql)
