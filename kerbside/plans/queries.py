"""The registered queries: every operator over the input views of one data folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions import keys
from kerbside.functions.maps import map_rows
from kerbside.functions.timing import parse_event_time, time_text
from kerbside.operators import archive, bitmaps, device_day, enrich, flow, grams, limits, paging, prefilter, scroll, search, speed, watch
from kerbside.operators.lookup import even_join, salted_join
from kerbside.plans import inputs
from kerbside.session import fresh_dir, pin_zone
from kerbside.sources import decode, snapshots
from kerbside.sources.messages import ALARM_MESSAGE, spark_schema
from kerbside.streaming import flows, jobs, live, outbox, sinks, versions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = "2024-01-02 12:00:30"
RANGE = ("2024-01-01 06:00:00", "2024-01-03 06:00:00")
TERMS = dict(
    vehicle_brand="别克", plate_color="黄", dir=1, tag=False, paper=False, sun=False, drop=False,
    second_belt=False, crash=False, danger=False,
)
CLASSES = {"large": [2], "medium": [1], "small": [0]}
ARRIVAL = "2024-01-04 00:00:00"
# Messages in a file of the payload stream, of about a kilobyte each.
PAYLOADS_A_FILE = 50_000


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        pin_zone(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def _watchlist(spark, passes):
    return snapshots.load_watchlist(inputs.derived(spark, "prey", passes))


def _gates(spark):
    return snapshots.load_gates(inputs.derived(spark, "gate"), "seq")


def _dim(spark, name):
    return snapshots.load_dim(inputs.derived(spark, name), f"{name}_id")


# Counts and averages


@query
def flow_minute(spark, sf_dir):
    return flow.flow(inputs.passes(spark, sf_dir), "minute")


@query
def flow_hour(spark, sf_dir):
    return flow.flow(inputs.passes(spark, sf_dir), "hour")


@query
def flow_day(spark, sf_dir):
    return flow.flow(inputs.passes(spark, sf_dir), "day")


@query
def flow_all_grains(spark, sf_dir):
    return flow.flow_all_grains(inputs.passes(spark, sf_dir))


@query
def speed_length_mean(spark, sf_dir):
    return speed.speed_length(inputs.passes(spark, sf_dir))


@query
def speed_length_fold(spark, sf_dir):
    return speed.speed_length_fold(inputs.passes(spark, sf_dir))


@query
def speed_length_fold_long(spark, sf_dir):
    """Device-minutes of hundreds of passes, some of which never forget their start."""
    return speed.speed_length_fold(inputs.derived(spark, "passes_long", inputs.passes(spark, sf_dir)))


@query
def interval_summary(spark, sf_dir):
    return flow.interval_summary(inputs.passes(spark, sf_dir), "1 hour", CLASSES)


# Alerts and violations


@query
def watchlist_snapshot(spark, sf_dir):
    return _watchlist(spark, inputs.passes(spark, sf_dir))


@query
def watchlist_alerts(spark, sf_dir):
    passes = inputs.passes(spark, sf_dir)
    return watch.alarm_table(watch.watchlist_alerts(passes, _watchlist(spark, passes)))


@query
def watchlist_large(spark, sf_dir):
    """Alarms by a watchlist of more plates than orders; passes are tested against its bits before any is exchanged."""
    sql = inputs.view_sql("prey_large", inputs.SPARK).replace("from orders", "from {orders}")
    listed = spark.sql(sql, orders=spark.read.parquet(f"{sf_dir}/orders.parquet"))
    alerts = watch.watchlist_alerts(inputs.passes(spark, sf_dir), listed, prefilter.prefiltered_join)
    return watch.alarm_table(alerts)


@query
def alarm_messages(spark, sf_dir):
    """The JSON messages, read back into their fields."""
    passes = inputs.passes(spark, sf_dir)
    messages = watch.alarm_messages(watch.watchlist_alerts(passes, _watchlist(spark, passes)))
    return _message_fields(messages)


def _message_fields(messages):
    body = F.from_json("value", spark_schema(ALARM_MESSAGE).simpleString())
    return messages.select("key", body.alias("m")).select("key", "m.*").drop("VehicleColor")


@query
def gate_snapshot(spark, sf_dir):
    """The limits that count, and how many passes each gate has."""
    passes = inputs.passes(spark, sf_dir).groupBy(F.col("device_id").alias("id")).agg(F.count("*").alias("n"))
    return _gates(spark).join(passes, "id", "left")


@query
def overspeed(spark, sf_dir):
    return limits.overspeed(inputs.passes(spark, sf_dir), _gates(spark))


@query
def unknown_gates(spark, sf_dir):
    found = limits.unknown_gates(inputs.passes(spark, sf_dir), _gates(spark))
    return found.select("event_id", "device_id", "vehicle_type", "speed")


@query
def unusable_limits(spark, sf_dir):
    """Limits that are a list too short, zero or no number, at the gates of the passes."""
    gates = _gates(spark).withColumn(
        "speedlimit",
        F.when(F.col("id") == "1", "40,50,x").when(F.col("id") == "2", "0").otherwise(F.col("speedlimit")),
    )
    found = limits.unusable_limits(inputs.passes(spark, sf_dir), gates)
    return found.select("event_id", "device_id", "vehicle_type", "reason")


@query
def overspeed_counters(spark, sf_dir):
    return limits.overspeed_counters(inputs.passes(spark, sf_dir), _gates(spark))


# Searches


def _hits(spark, sf_dir):
    return search.attr_search(inputs.passes(spark, sf_dir), *RANGE, **TERMS)


_HIT = ("event_id", "pass_ts", "plate", "task_id")


@query
def attr_search(spark, sf_dir):
    return paging.sort_result(_hits(spark, sf_dir).select(*_HIT))


@query
def attr_search_some_terms(spark, sf_dir):
    found = search.attr_search(inputs.passes(spark, sf_dir), start=RANGE[0], vehicle_brand="宝马", crash="true")
    return paging.sort_result(found.select(*_HIT))


@query
def attr_search_paged(spark, sf_dir):
    return paging.number_pages(_hits(spark, sf_dir).select(*_HIT), paging.ATTR_PAGE)


@query
def attr_search_next_page(spark, sf_dir):
    """The page behind a given key."""
    after = ("2024-01-01 12:00:00", 0)
    found = search.time_range(inputs.passes(spark, sf_dir), *RANGE).select(*_HIT)
    return paging.page(found, paging.ATTR_PAGE, after)


@query
def time_range(spark, sf_dir):
    return search.time_range(inputs.passes(spark, sf_dir), *RANGE).select(*_HIT)


@query
def time_count(spark, sf_dir):
    return search.time_count(inputs.passes(spark, sf_dir), *RANGE)


def _plates(spark, sf_dir):
    return search.plate_search(inputs.passes(spark, sf_dir), "2024-01-01 00:00:00", "粤", "2", end=ARRIVAL)


@query
def plate_search(spark, sf_dir):
    return paging.sort_result(_plates(spark, sf_dir).select(*_HIT))


@query
def plate_search_paged(spark, sf_dir):
    return paging.number_pages(_plates(spark, sf_dir).select(*_HIT), paging.PLATE_PAGE)


@query
def plate_search_grams(spark, sf_dir):
    """The plate search over three indexed batches: the rarest positional gram's postings, then the passes of the plates found."""
    path, passes = fresh_dir(spark, "grams"), inputs.passes(spark, sf_dir).select(*_HIT)
    for batch in range(3):
        grams.index_batch(passes.filter(F.col("event_id") % 3 == batch), batch, path)
    found = grams.plate_search(spark, path, "2024-01-01 00:00:00", "粤", "2", ARRIVAL)
    return found.select(*_HIT)


@query
def plate_search_pattern(spark, sf_dir):
    found = search.plate_search(
        inputs.passes(spark, sf_dir), "2024-01-01 12:00:00", "[粤云]", "[1-3]", end="2024-01-03 00:00:00"
    )
    return paging.sort_result(found.select(*_HIT))


# Detail and dimensions


def _results(passes):
    """Passes in the shape of recognition results."""
    number = {"tag": "tag", "paper": "paper", "sun": "sun", "drop": "drop", "secondBelt": "second_belt",
              "crash": "crash", "danger": "danger"}
    return passes.select(
        F.col("event_id").cast("string").alias("resultId"),
        F.col("task_id").alias("taskId"), F.col("camera_id").alias("cameraId"),
        F.col("data_source_id").alias("dataSourceId"),
        F.col("plate").alias("License"), F.col("plate_color").alias("PlateColor"),
        F.col("plate_type").alias("PlateType"), F.col("dir").alias("Direction"),
        F.col("vehicle_brand").alias("vehicleBrand"), F.col("pilot_call").alias("call"),
        time_text(passes).alias("ResultTime"),
        *[F.col(f"`{c}`").cast("int").alias(name) for name, c in number.items()],
    )


def _bitmap_index(spark, sf_dir):
    passes, path = inputs.passes(spark, sf_dir).select(*search.TERMS, *_HIT), fresh_dir(spark, "bitmaps")
    for batch, part in enumerate(_shuffled(passes)[:2] + [passes.filter(F.col("event_id") % 4 > 1)]):
        bitmaps.index_batch(part, batch, path)
    return path


@query
def attr_search_bitmap(spark, sf_dir):
    """The attribute search by the and of bitmaps, over three indexed batches."""
    return bitmaps.search(spark, _bitmap_index(spark, sf_dir), *RANGE, **TERMS).select(*_HIT)


@query
def attr_count_bitmap(spark, sf_dir):
    """Its number of hits, from the index alone."""
    return bitmaps.count(spark, _bitmap_index(spark, sf_dir), *RANGE, **TERMS)


@query
def scroll_pinned(spark, sf_dir):
    """All pages of an attribute search; after the first page another batch of hits comes in, which no page shows."""
    passes = inputs.passes(spark, sf_dir)
    table, pages = fresh_dir(spark, "searched"), fresh_dir(spark, "pages")
    for batch in range(2):
        sinks.write_batch(passes.filter(F.col("event_id") % 3 == batch), batch, table)

    def hits(rows):
        return search.attr_search(rows, *RANGE, **TERMS).select("event_id", "pass_ts", "plate", "task_id")

    cursor = scroll.open_cursor(spark, table, hits, paging.ATTR_PAGE)
    page = scroll.read_page(spark, table, hits, cursor).withColumn("page", F.lit(cursor.page).cast("long"))
    sinks.write_batch(page, 0, pages)
    sinks.write_batch(passes.filter(F.col("event_id") % 3 == 2), 2, table)
    cursor = cursor.turned()
    sinks.write_batch(scroll.read_pages(spark, table, hits, cursor), 1, pages)
    return sinks.read_batches(spark, pages).drop("batch_id")


@query
def result_index_search(spark, sf_dir):
    """The attribute search over result documents, under their names."""
    terms = {name: int(value) if isinstance(value, bool) else value for name, value in TERMS.items()}
    documents = archive.result_index(_results(inputs.passes(spark, sf_dir)))
    found = search.attr_search(documents, *RANGE, time="ResultTime", names=search.RESULT_NAMES, **terms)
    return paging.sort_result(found, ("ResultTime", "resultId")).select("ResultTime", "resultId", "taskId")

@query
def result_lookup(spark, sf_dir):
    passes = inputs.passes(spark, sf_dir)
    wanted = passes.select(F.col("event_id").alias("result_id"))
    return enrich.lookup_result(wanted, inputs.derived(spark, "result", passes))


@query
def enrich_result(spark, sf_dir):
    passes = inputs.passes(spark, sf_dir)
    hits = _hits(spark, sf_dir).select(F.col("event_id").alias("result_id"), "task_id")
    found = enrich.enrich_result(hits, inputs.derived(spark, "result", passes), _dim(spark, "task"))
    return map_rows(found, "merged")


@query
def enrich_dims(spark, sf_dir):
    hits = _plates(spark, sf_dir).select("event_id", "task_id", "camera_id", "data_source_id")
    found = enrich.enrich_dims(hits, *[_dim(spark, d) for d in ("task", "camera", "data_source")])
    return map_rows(found.drop("task", "task_id", "camera_id", "data_source_id"), "merged")


@query
def enrich_dims_large(spark, sf_dir):
    """All passes with attributes out of orders, customer and supplier, by the join for large tables."""
    hits = inputs.derived(spark, "hits_large", inputs.passes(spark, sf_dir))
    dims = [snapshots.load_dim(inputs.large_dim(spark, sf_dir, d), f"{d}_id") for d in inputs.LARGE]
    found = enrich.enrich_dims(hits, *dims, join=salted_join)
    return map_rows(found.select("event_id", "merged"), "merged")


@query
def enrich_dims_task(spark, sf_dir):
    """The task's own attributes beside the merged ones; no match gives null."""
    hits = _plates(spark, sf_dir).select("event_id", "task_id", "camera_id", "data_source_id")
    found = enrich.enrich_dims(hits, *[_dim(spark, d) for d in ("task", "camera", "data_source")])
    return found.select("event_id", F.col("task")["name"].alias("task_name"), F.size("merged").alias("attributes"))


@query
def dim_attributes(spark, sf_dir):
    """Attributes of each pass's task, one row per attribute."""
    joined = inputs.passes(spark, sf_dir).select("event_id", "task_id").join(_dim(spark, "task"), "task_id")
    return map_rows(joined, "attrs")


# Archive


@query
def traffic_meta(spark, sf_dir):
    return archive.traffic_meta(inputs.passes(spark, sf_dir))


@query
def traffic_index(spark, sf_dir):
    return archive.traffic_index(inputs.passes(spark, sf_dir))


@query
def traffic_image(spark, sf_dir):
    images = archive.traffic_image(inputs.with_pics(inputs.passes(spark, sf_dir)))
    return images.withColumn("Data", F.col("Data").cast("string"))


@query
def traffic_image_all(spark, sf_dir):
    images = archive.traffic_image_all(inputs.with_pics(inputs.passes(spark, sf_dir)))
    return images.withColumn("Data", F.col("Data").cast("string"))


@query
def row_keys(spark, sf_dir):
    passes = inputs.passes(spark, sf_dir)
    plate, device, time = F.col("plate"), F.col("device_id"), time_text(passes)
    return passes.select(
        "event_id",
        keys.flow_key(device, F.date_format("pass_ts", "yyyy-MM-dd")).alias("flow"),
        archive.archive_key(passes).alias("archive"),
        keys.alarm_key(time, plate, device).alias("alarm"),
        keys.alarm_id(device, time).alias("alarm_id"),
        keys.vehicle_id(plate, time).alias("vehicle_id"),
        keys.violation_key(time, plate, device).alias("violation"),
    )


# Device-days


@query
def device_day_maps(spark, sf_dir):
    """The five maps of each device-day, one row per entry with the value as text."""
    days = device_day.device_day_of(inputs.passes(spark, sf_dir))

    def entries(name):
        return F.transform(F.map_entries(f"{name}_map"), lambda e: F.struct(
            F.concat(F.lit(f"{name}:"), e["key"]).alias("entry"), e["value"].cast("string").alias("value")))

    every = F.concat(*[entries(name) for name in ("day", "hour", "minute", "speed", "length")])
    return days.select("device_id", "day", F.inline(every))


@query
def flow_wide(spark, sf_dir):
    wide = device_day.flow_wide_of(inputs.passes(spark, sf_dir))
    return map_rows(wide.select("row_key", "cells"), "cells", "cell", "value")


@query
def flow_live_asof(spark, sf_dir):
    return flow.flow_live_asof(inputs.passes(spark, sf_dir), AS_OF)


@query
def speed_live_asof(spark, sf_dir):
    return flow.speed_live_asof(inputs.passes(spark, sf_dir), AS_OF)


@query
def speed_live_asof_mean(spark, sf_dir):
    return flow.speed_live_asof(inputs.passes(spark, sf_dir), AS_OF, speed.speed_length)


# Decoding


def _payloads(spark, sf_dir):
    """JSON messages of the passes: some cut, some without plate, some with odd times."""
    passes = inputs.with_pics(inputs.passes(spark, sf_dir)).withColumns({
        "plate_length": F.length("plate"),
        "vehicle_index": F.lit(1),
        "vehicle_sub_logo": F.lit("sub"),
        "vehicle_model": F.lit("model"),
    })
    kind = F.col("event_id") % 50
    time = time_text(passes)
    odd = passes.withColumns({
        "plate": F.when(kind != 0, F.col("plate")),
        "time_text": F.when(kind == 2, "bad").when(kind == 3, F.concat(time, F.lit(".123"))).otherwise(time),
    })
    text = F.to_json(decode.encode_passes(odd))
    return odd.select(
        "event_id",
        F.when(kind == 1, F.substring(text, 1, 60)).otherwise(text).alias("payload"),
    )


def _decoded(spark, sf_dir):
    arrival = F.lit(ARRIVAL).cast("timestamp")
    return decode.decode_passes(_payloads(spark, sf_dir), arrival=arrival)


@query
def payload_decode(spark, sf_dir):
    valid, _ = _decoded(spark, sf_dir)
    return valid.select(
        "event_id", "pass_ts", "device_id", "plate", "plate_color", "plate_type", "speed", "length",
        "vehicle_type", "vehicle_logo", "site_id", "illegal_sub_type", "time_text",
        F.size("pics").alias("pics"), F.try_element_at("pics", F.lit(-1))["recog_mode"].alias("last_recog_mode"),
    )


@query
def payload_quarantine(spark, sf_dir):
    _, bad = _decoded(spark, sf_dir)
    return bad.select("event_id", "reason", F.array_join("missing", ",").alias("missing"))


@query
def event_time_parse(spark, sf_dir):
    passes = inputs.passes(spark, sf_dir)
    kind = F.col("event_id") % 50
    time = time_text(passes)
    text = (
        F.when(kind == 2, "bad").when(kind == 3, F.concat(time, F.lit(".123")))
        .when(kind == 4, "2024-1-2 3:4:5").when(kind == 5, "2024-13-45 10:00:00").otherwise(time)
    )
    return passes.select(
        "event_id", parse_event_time(text, F.lit(ARRIVAL).cast("timestamp")).alias("pass_ts"),
        parse_event_time(text, F.lit(ARRIVAL).cast("timestamp"), lenient=True).alias("rolled_ts"),
    )


# Streams: all input through a streaming query, then the table it has built


def _drain(spark, df, make_sink, mode="append"):
    """Folder of the table; the frames of a `FilesStream` are taken as they come, by one query that goes on where it stopped."""
    out = fresh_dir(spark, "table")
    cfg = jobs.JobConfig(fresh_dir(spark, "query"), available_now=True, output_mode=mode)
    sink = make_sink(out)
    for arrived in df.arrivals() if isinstance(df, inputs.FilesStream) else [df]:
        jobs.start(arrived, sink, cfg).awaitTermination()
    return out


def _quarters(passes):
    """Four parts in time order, each of 18 hours."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    quarter = F.least(F.floor((F.unix_seconds("pass_ts") - F.unix_seconds(start)) / (18 * 3600)), F.lit(3))
    return [passes.filter(quarter == i) for i in range(4)]


def _shuffled(passes):
    """Four parts in no time order."""
    return [passes.filter(F.col("event_id") % 4 == i) for i in range(4)]


def _flow_stream(spark, parts):
    used = [p.select("event_id", "device_id", "vehicle_type", "pass_ts", "speed", "length") for p in parts]
    return inputs.files_stream(spark, used, fresh_dir(spark, "passes"))


def _flow_tables(spark, parts, means=False):
    """Folder of the flow tables after one micro-batch for each part."""
    return _drain(spark, _flow_stream(spark, parts), lambda path: flows.flow_sink(path, means))


def _stream_flow(spark, sf_dir, grain):
    out = _flow_tables(spark, _shuffled(inputs.passes(spark, sf_dir)))
    return flows.read_flow(spark, out, grain).drop("grain")


@query
def stream_flow_minute(spark, sf_dir):
    return _stream_flow(spark, sf_dir, "minute")


@query
def stream_flow_hour(spark, sf_dir):
    return _stream_flow(spark, sf_dir, "hour")


@query
def stream_flow_day(spark, sf_dir):
    return _stream_flow(spark, sf_dir, "day")


@query
def stream_flow_live(spark, sf_dir):
    """What is live after each of four batches in time order, a tenth of the passes coming one batch late."""
    passes = inputs.derived(spark, "passes_dealt", inputs.passes(spark, sf_dir))
    stream = _flow_stream(spark, [passes.filter(F.col("batch") == i) for i in range(4)])
    history = fresh_dir(spark, "history")

    def make(path):
        state = live.LiveFlow(path)

        def write(batch, batch_id):
            state.add(batch, batch_id)
            sinks.write_batch(state.read(batch.sparkSession), batch_id, history)

        return write

    _drain(spark, stream, make)
    found = sinks.read_batches(spark, history)
    return found.select(F.col("batch_id").cast("int").alias("batch"), "device_id", "grain", "bucket", "vehicle_type", "n")


@query
def stream_flow_late(spark, sf_dir):
    """Late passes, and a device a day ahead in the first batch: nothing is lost in any grain."""
    late = inputs.derived(spark, "passes_late", inputs.passes(spark, sf_dir))
    return flows.read_flow(spark, _flow_tables(spark, _shuffled(late)))


@query
def stream_speed_length(spark, sf_dir):
    out = _flow_tables(spark, _shuffled(inputs.passes(spark, sf_dir)))
    return flows.read_speed_length(spark, out)


@query
def stream_speed_length_fold(spark, sf_dir):
    """The order-dependent mean over four batches in time order."""
    return flows.read_running_mean(spark, _flow_tables(spark, _quarters(inputs.passes(spark, sf_dir)), means=True))


@query
def stream_speed_fold_late(spark, sf_dir):
    """The same over batches in no time order: every batch changes seconds that the ones before it have filled."""
    return flows.read_running_mean(spark, _flow_tables(spark, _shuffled(inputs.passes(spark, sf_dir)), means=True))


@query
def stream_flow_compacted(spark, sf_dir):
    """Ten batches in levels of two, so that counts are merged up to three times; then the last batch comes again."""
    passes = inputs.passes(spark, sf_dir)
    parts = [passes.filter(F.col("event_id") % 10 == i) for i in range(10)]
    sinks_made = []

    def make(path):
        sinks_made.append(flows.flow_sink(path, means=False, fan=2))
        return sinks_made[0]

    out = _drain(spark, _flow_stream(spark, parts), make)
    sinks_made[0](parts[9], 9)
    return flows.read_flow(spark, out)


@query
def stream_alerts(spark, sf_dir):
    passes = inputs.passes(spark, sf_dir)
    stream = inputs.pass_stream_input(spark, sf_dir)
    out = _drain(spark, stream, lambda path: jobs.alerts_sink(lambda: _watchlist(spark, passes), path))
    return sinks.read_rows(spark, out)


@query
def stream_alarms_bucketed(spark, sf_dir):
    """Alarms of four batches upserted into a table in buckets, merged on the way; reading it exchanges nothing."""
    passes = inputs.passes(spark, sf_dir)
    stream = inputs.files_stream(spark, _shuffled(passes), fresh_dir(spark, "passes"))
    table = sinks.keyed_table(fresh_dir(spark, "alarms"), buckets=8, fan=2)
    _drain(spark, stream, lambda path: jobs.alerts_sink(lambda: _watchlist(spark, passes), path, None, lambda: 1, table=table))
    return table.read(spark)


@query
def stream_overspeed(spark, sf_dir):
    stream = inputs.pass_stream_input(spark, sf_dir)
    out = _drain(spark, stream, lambda path: jobs.overspeed_sink(lambda: _gates(spark), path))
    return sinks.read_rows(spark, out)


def _overspeed_tables(spark, sf_dir):
    parts = _shuffled(inputs.passes(spark, sf_dir))
    stream = inputs.files_stream(spark, parts, fresh_dir(spark, "passes"))
    return _drain(spark, stream, lambda path: jobs.overspeed_sink(lambda: _gates(spark), path, lambda: 1))


@query
def stream_unknown_gates(spark, sf_dir):
    found = sinks.read_batches(spark, f"{_overspeed_tables(spark, sf_dir)}-unknown-gates")
    return found.groupBy("device_id", "vehicle_type", "WFSJ").agg(F.count("*").alias("n"))


@query
def stream_overspeed_counters(spark, sf_dir):
    counted = sinks.read_batches(spark, f"{_overspeed_tables(spark, sf_dir)}-counters")
    return counted.agg(F.sum("all").alias("all"), F.sum("illegal").alias("illegal"))


@query
def stream_alarm_rejects(spark, sf_dir):
    """Alarms of listed plates whose level is no number."""
    passes = inputs.passes(spark, sf_dir)
    stream = inputs.files_stream(spark, _shuffled(passes), fresh_dir(spark, "passes"))

    def listed():
        return _watchlist(spark, passes).withColumn("bkjb", F.when(F.col("bkjb") == "9", "high").otherwise(F.col("bkjb")))

    out = _drain(spark, stream, lambda path: jobs.alerts_sink(listed, path, None, lambda: 1))
    found = sinks.read_batches(spark, f"{out}-rejects")
    return found.groupBy("key", "PlateLicense", "DeviceId", "Time", "missing").agg(F.count("*").alias("n"))


@query
def stream_alerts_refresh(spark, sf_dir):
    """Two batches; before the second, every plate that ends in 0 leaves the watchlist."""
    passes = inputs.passes(spark, sf_dir)
    halves = [passes.filter(F.col("event_id") % 2 == i) for i in range(2)]
    stream = inputs.files_stream(spark, halves, fresh_dir(spark, "passes"))
    loads = []

    def listed():
        loads.append(1)
        table = _watchlist(spark, passes)
        return table if len(loads) == 1 else table.filter("not plate like '%0'")

    return sinks.read_rows(spark, _drain(spark, stream, lambda path: jobs.alerts_sink(listed, path)))


@query
def alarm_outbox(spark, sf_dir):
    """Alarm messages of four batches; the third fails behind its send, with the watchlist emptied before it comes again."""
    passes = inputs.passes(spark, sf_dir)
    stream = inputs.files_stream(spark, _shuffled(passes), fresh_dir(spark, "passes"))
    topic, out, cfg = fresh_dir(spark, "topic"), fresh_dir(spark, "table"), jobs.JobConfig(fresh_dir(spark, "query"), available_now=True)
    state = {"failed": False}

    def send(messages, batch_id):
        messages.write.mode("append").parquet(topic)
        if batch_id == 2 and not state["failed"]:
            state["failed"] = True
            raise RuntimeError("lost behind the send")

    def listed():
        return _watchlist(spark, passes)

    def sink_of(load):
        return jobs.alerts_sink(load, out, outbox.Outbox(f"{out}-outbox", send).publish)

    loads = []

    def emptied_once():
        loads.append(1)
        return listed().limit(0) if len(loads) == 1 else listed()

    sink = sink_of(listed)
    for arrived in stream.arrivals():
        try:
            jobs.start(arrived, sink, cfg).awaitTermination()
        except StreamingQueryException:
            sink = sink_of(emptied_once)
            jobs.start(arrived, sink, cfg).awaitTermination()
    return _message_fields(outbox.once(spark.read.parquet(topic)))


@query
def stream_refresh_by_message(spark, sf_dir):
    """Four batches; before the third, a message asks for a refresh, after which plates that end in 0 are gone.

    Other messages change nothing. The second batch fails behind its write, a message comes, and the batch is repeated with the
    version that it had.
    """
    passes = inputs.passes(spark, sf_dir)
    control, out, table = fresh_dir(spark, "control"), fresh_dir(spark, "refresh"), fresh_dir(spark, "table")
    stream = inputs.files_stream(spark, _shuffled(passes), fresh_dir(spark, "passes"))
    cfg = jobs.JobConfig(fresh_dir(spark, "query"), available_now=True)
    control_cfg = jobs.JobConfig(fresh_dir(spark, "control-query"), available_now=True)
    loads, failed = [], []

    def tell(*texts):
        spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.mode("append").parquet(control)
        messages = spark.readStream.schema("value string").parquet(control)
        jobs.start(messages, versions.control_sink(out), control_cfg).awaitTermination()

    def listed():
        loads.append(1)
        found = _watchlist(spark, passes)
        return found if len(loads) == 1 else found.filter("not plate like '%0'")

    alerts = jobs.alerts_sink(versions.Versions(out, listed), table)

    def sink(batch, batch_id):
        alerts(batch, batch_id)
        if batch_id == 1 and not failed:
            failed.append(1)
            tell("other", "new", "no news")
            raise RuntimeError("lost behind the write")

    tell("hello")
    for arrived in stream.arrivals():
        try:
            jobs.start(arrived, sink, cfg).awaitTermination()
        except StreamingQueryException:
            jobs.start(arrived, sink, cfg).awaitTermination()
    return sinks.read_rows(spark, table)


@query
def stream_archive_search(spark, sf_dir):
    """A time range of the index that a stream has written, by day folders."""
    stream = inputs.with_pics(inputs.pass_stream_input(spark, sf_dir))
    out = _drain(spark, stream, jobs.fan_out_sink)
    found = sinks.read_days(spark, f"{out}/index", "Time", *RANGE)
    return found.select(F.col("RowKey").alias("row_key"), "SBBH", "Time", "Plate_License")


@query
def stream_fan_out(spark, sf_dir):
    """Per pass, which of the three outputs hold its key."""
    stream = inputs.with_pics(inputs.pass_stream_input(spark, sf_dir))
    out = _drain(spark, stream, jobs.fan_out_sink)
    meta, image, index = (sinks.read_batches(spark, f"{out}/{name}") for name in ("meta", "image", "index"))
    return (
        meta.select("row_key", "SBBH", "Time")
        .join(index.select(F.col("RowKey").alias("row_key"), "Plate_License"), "row_key")
        .join(image.select("row_key", F.col("Data").cast("string").alias("Data")), "row_key", "left")
    )


@query
def stream_results(spark, sf_dir):
    """Results written as detail rows and search documents, joined again on the key."""
    stream = _results(inputs.pass_stream_input(spark, sf_dir))
    out = _drain(spark, stream, lambda path: jobs.fan_out_sink(path, sinks.RESULTS))
    detail, index = (sinks.read_batches(spark, f"{out}/{name}").drop("batch_id") for name in ("result", "index"))
    found = detail.select(F.col("row_key").alias("resultId"), "License", "PlateType", "fileName")
    return even_join(index, found, "resultId")


@query
def stream_decode(spark, sf_dir):
    """Payloads through a stream: passes and quarantine by outcome."""
    path = fresh_dir(spark, "payloads")
    _payloads(spark, sf_dir).write.option("maxRecordsPerFile", PAYLOADS_A_FILE).parquet(path)
    # Two files for each core: a micro-batch is held decoded, so that its size is what a task holds.
    files = 2 * spark.sparkContext.defaultParallelism
    stream = spark.readStream.schema("event_id long, payload string").option("maxFilesPerTrigger", files).parquet(path)
    out = fresh_dir(spark, "table")
    arrival = F.lit(ARRIVAL).cast("timestamp")
    sink = jobs.decoded_sink(sinks.table_sink(f"{out}/passes"), f"{out}/quarantine", arrival=arrival)
    cfg = jobs.JobConfig(fresh_dir(spark, "query"), available_now=True)
    jobs.start(stream, sink, cfg).awaitTermination()
    valid = sinks.read_batches(spark, f"{out}/passes").select("event_id", F.lit("valid").alias("outcome"))
    bad = sinks.read_batches(spark, f"{out}/quarantine").select("event_id", F.col("reason").alias("outcome"))
    return valid.unionByName(bad)
