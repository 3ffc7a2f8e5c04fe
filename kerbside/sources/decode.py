"""Payloads to passes, with everything unreadable set aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.functions.timing import parse_event_time
from kerbside.sources.messages import MESSAGES, OPTIONAL, PASS_MESSAGE, REPEATED, spark_schema
from kerbside.sources.wire import has_spark_protobuf, only_local, parse, wire_to_json

_BROKEN, _SOUND = "_broken", "_sound"

# Pass column -> message field.
FLAT = {
    "device_id": "Id",
    "drive_chan": "DriveChan",
    "illegal_type": "IllegalType",
    "illegal_sub_type": "IllegalSubType",
    "speed_limit": "SpeedLimit",
    "plate_type": "PlateInfo.PlateType",
    "plate_color": "PlateInfo.Color",
    "plate_bright": "PlateInfo.Bright",
    "plate_length": "PlateInfo.LicenseLen",
    "plate_country": "PlateInfo.Country",
    "plate": "PlateInfo.License",
    "plate_believe": "PlateInfo.Believe",
    "vehicle_index": "VehicleInfo.Index",
    "vehicle_type": "VehicleInfo.VehicleType",
    "chan_index": "VehicleInfo.ChanIndex",
    "color_depth": "VehicleInfo.ColorDepth",
    "vehicle_color": "VehicleInfo.Color",
    "speed": "VehicleInfo.Speed",
    "length": "VehicleInfo.Length",
    "vehicle_logo": "VehicleInfo.VehicleLogoRecog",
    "vehicle_sub_logo": "VehicleInfo.VehicleSubLogoRecog",
    "vehicle_model": "VehicleInfo.VehicleModel",
    "vehicle_attribute": "VehicleInfo.VehicleAttribute",
    "site_id": "MonitoringSiteID",
    "dir": "Dir",
    "detect_type": "DetectType",
    "pilot_safebelt": "PilotSafebelt",
    "copilot_safebelt": "CopilotSafebelt",
    "pilot_sub_visor": "PilotSubVisor",
    "copilot_sub_visor": "CopilotSubVisor",
    "pilot_call": "PilotCall",
    "alarm_type": "AlarmDataType",
    "time_text": "Time",
    "pic_num": "PicNum",
    "validity": "Validity",
    "waited_length": "WaitedLength",
}


def decode_passes(
    df: DataFrame, payload: str = "payload", arrival: Column | None = None, wire: str = "json",
    lenient_time: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine) of a frame of payloads.

    ``valid`` has the pass columns beside the frame's other columns; ``pass_ts``
    is the message time, or ``arrival`` (default: now) where that is no time.
    ``quarantine`` keeps the payload with ``reason`` and the ``missing``
    required fields. Required marks hold inside nested messages too.
    """
    checked = check_payloads(df, payload, wire)
    return valid_passes(checked, payload, arrival, lenient_time), quarantined(checked, payload)


def check_payloads(df: DataFrame, payload: str = "payload", wire: str = "json") -> DataFrame:
    """Adds the parsed message and whether it is sound; persist this to use both outcomes."""
    read = read_payload(df, payload, wire)
    return read.withColumn(_SOUND, F.expr(f"not {_BROKEN} and not ({_lacks('m', PASS_MESSAGE)})"))


def valid_passes(
    checked: DataFrame, payload: str = "payload", arrival: Column | None = None, lenient_time: bool = False
) -> DataFrame:
    arrival = F.current_timestamp() if arrival is None else arrival
    return checked.filter(_SOUND).select(
        *_carried(checked, payload),
        *[F.col(f"m.{path}").alias(name) for name, path in FLAT.items()],
        F.expr(_PICTURES).alias("pics"),
        parse_event_time("m.Time", arrival, lenient_time).alias("pass_ts"),
    )


def quarantined(checked: DataFrame, payload: str = "payload") -> DataFrame:
    named = f"filter(array({', '.join(_missing_fields('m', PASS_MESSAGE))}), name -> name is not null)"
    return checked.filter(~F.col(_SOUND)).select(
        *_carried(checked, payload),
        payload,
        F.when(F.col(_BROKEN), "unreadable").otherwise("missing field").alias("reason"),
        F.expr(f"if({_BROKEN}, cast(array() as array<string>), {named})").alias("missing"),
    )


def _carried(checked: DataFrame, payload: str) -> list[str]:
    return [c for c in checked.columns if c not in (payload, "m", _BROKEN, _SOUND)]


def read_payload(df: DataFrame, payload: str, wire: str) -> DataFrame:
    """Adds the message struct ``m`` and whether the payload is unreadable; ``wire`` is json or protobuf."""
    if wire not in ("json", "protobuf"):
        raise ValueError(f"wire must be json or protobuf, not {wire!r}")
    if wire == "protobuf" and has_spark_protobuf(df.sparkSession):
        return _evaluated_once(df, parse(F.col(payload), PASS_MESSAGE)).withColumn(_BROKEN, F.col("m").isNull())
    if wire == "protobuf":
        only_local(df.sparkSession)
    text = F.col(payload).cast("string") if wire == "json" else wire_to_json(F.col(payload), PASS_MESSAGE)
    schema = T.StructType(spark_schema(PASS_MESSAGE).fields + [T.StructField(_BROKEN, T.StringType())])
    parsed = F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN})
    return _evaluated_once(df, parsed).withColumn(
        _BROKEN, F.col("m").isNull() | F.col(f"m.{_BROKEN}").isNotNull()
    )


def _evaluated_once(df: DataFrame, parsed: Column) -> DataFrame:
    """Adds ``m`` through a generator: filters on its fields stay above it, so no payload is parsed twice."""
    return df.select("*", F.explode(F.array(parsed)).alias("m"))


def _missing_fields(path: str, message: str) -> list[str]:
    """SQL per required field: its name where it is null, or where an element lacks something."""
    found: list[str] = []
    for field in MESSAGES[message]:
        at = f"{path}.{field.name}"
        label = at.split(".", 1)[1]
        if field.label == REPEATED:
            found.append(f"if({_element_lacks(at, field.type)}, '{label}', null)")
        elif field.label != OPTIONAL:
            found.append(f"if({at} is null, '{label}', null)")
            inner = _missing_fields(at, field.type) if field.type in MESSAGES else []
            found.extend(f"if({at} is not null, {name}, null)" for name in inner)
    return found


def _lacks(path: str, message: str) -> str:
    """SQL for whether a message lacks a required field, at any depth."""
    checks: list[str] = []
    for field in MESSAGES[message]:
        at = f"{path}.{field.name}"
        if field.label == REPEATED:
            checks.append(_element_lacks(at, field.type))
        elif field.label != OPTIONAL:
            checks.append(f"{at} is null")
            if field.type in MESSAGES:
                checks.append(_lacks(at, field.type))
    return " or ".join(checks)


def _element_lacks(path: str, message: str) -> str:
    return f"({path} is not null and exists({path}, e -> {_lacks('e', message)}))"


_PICTURES = """
    transform(coalesce(m.PicInfo, array()), p -> struct(
        p.Type as type, p.PicRecogMode as recog_mode, p.RedLightTime as red_light_time,
        struct(p.PlateRect.X as x, p.PlateRect.Y as y, p.PlateRect.Width as w, p.PlateRect.Height as h) as rect,
        p.Data as data))"""


_PICTURE_MESSAGES = """
    transform(pics, p -> struct(
        p.type as Type, p.recog_mode as PicRecogMode, p.red_light_time as RedLightTime,
        struct(p.rect.x as X, p.rect.y as Y, p.rect.w as Width, p.rect.h as Height) as PlateRect,
        p.data as Data))"""


def encode_passes(passes: DataFrame) -> Column:
    """The message of a pass as a struct: the inverse of the flattening, for writing payloads."""
    column_of = {path: name for name, path in FLAT.items() if name in passes.columns}

    def build(message: str, prefix: str) -> str:
        parts = []
        for field in MESSAGES[message]:
            path = prefix + field.name
            if path in column_of:
                parts.append(f"`{column_of[path]}` as {field.name}")
            elif field.label != REPEATED and field.type in MESSAGES:
                parts.append(f"{build(field.type, path + '.')} as {field.name}")
        if message == PASS_MESSAGE and "pics" in passes.columns:
            parts.append(f"{_PICTURE_MESSAGES} as PicInfo")
        return f"struct({', '.join(parts)})"

    return F.expr(build(PASS_MESSAGE, ""))
