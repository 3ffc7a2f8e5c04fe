"""Archive projections of a pass: metadata, pictures and search index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.keys import pass_key
from kerbside.functions.timing import time_text

# Stored name -> pass column. The stored names.
META = {
    "SBBH": "device_id",
    "DriveChan": "drive_chan",
    "Time": None,
    "AlarmDataType": "alarm_type",
    "CopilotSafebelt": "copilot_safebelt",
    "CopilotSubVisor": "copilot_sub_visor",
    "DetectType": "detect_type",
    "Dir": "dir",
    "IllegalType": "illegal_type",
    "IllegalSubType": "illegal_sub_type",
    "MonitoringSiteID": "site_id",
    "PicNum": "pic_num",
    "PilotSafebelt": "pilot_safebelt",
    "PilotSubVisor": "pilot_sub_visor",
    "SpeedLimit": "speed_limit",
    "Vehicle_ChanIndex": "chan_index",
    "Vehicle_Color": "vehicle_color",
    "Vehicle_Depth": "color_depth",
    "Vehicle_Length": "length",
    "Vehicle_Speed": "speed",
    "Vehicle_Attribute": "vehicle_attribute",
    "Vehicle_VehicleLogoRecog": "vehicle_logo",
    "Vehicle_Type": "vehicle_type",
    "Plate_Believe": "plate_believe",
    "Plate_Bright": "plate_bright",
    "Plate_Color": "plate_color",
    "Plate_Country": "plate_country",
    "Plate_License": "plate",
    "Plate_PlateType": "plate_type",
}
INDEX = (
    "SBBH", "DriveChan", "Dir", "Vehicle_Color", "Vehicle_ChanIndex", "Vehicle_Type", "IllegalType",
    "Vehicle_Speed", "Plate_License", "Plate_PlateType", "Plate_Color", "Time",
)


def archive_key(passes: DataFrame) -> Column:
    """Same key in all outputs of a pass, and again on a replay."""
    if {"topic", "partition", "offset"} <= set(passes.columns):
        return pass_key(F.col("topic"), F.col("partition"), F.col("offset"))
    return pass_key(F.col("plate"), F.col("device_id"), time_text(passes), F.col("event_id"))


def _texts(passes: DataFrame, names) -> list[Column]:
    return [
        (time_text(passes) if META[name] is None else F.col(META[name]).cast("string")).alias(name)
        for name in names
    ]


def traffic_meta(passes: DataFrame, row_key: Column | None = None) -> DataFrame:
    """29 text columns per pass."""
    key = archive_key(passes) if row_key is None else row_key
    return passes.select(key.alias("row_key"), *_texts(passes, META))


def traffic_index(passes: DataFrame, row_key: Column | None = None) -> DataFrame:
    """The searchable subset as text; ``RowKey`` leads to the other outputs."""
    key = archive_key(passes) if row_key is None else row_key
    return passes.select(*_texts(passes, INDEX), key.alias("RowKey"))


def _picture(pic: str) -> list[Column]:
    return [
        F.col(f"{pic}.data").alias("Data"),
        F.col(f"{pic}.recog_mode").cast("string").alias("RecogMode"),
        F.col(f"{pic}.red_light_time").cast("string").alias("RedLightTime"),
    ]


def traffic_image(passes: DataFrame, row_key: Column | None = None) -> DataFrame:
    """The stored picture of each pass: its last one. No picture, no row; nothing is shuffled."""
    key = archive_key(passes) if row_key is None else row_key
    last = passes.filter(F.size("pics") > 0).select(
        key.alias("row_key"), F.try_element_at("pics", F.lit(-1)).alias("pic")
    )
    return last.select("row_key", *_picture("pic"))


def traffic_image_all(passes: DataFrame, row_key: Column | None = None) -> DataFrame:
    """Every picture with its place, from 0."""
    key = archive_key(passes) if row_key is None else row_key
    each = passes.select(key.alias("row_key"), F.posexplode("pics").alias("pos", "pic"))
    return each.select("row_key", "pos", *_picture("pic"))


# Detail row of a recognition result. The stored names.
RESULT = (
    "taskid", "cameraId", "License", "LicenseAttribution", "PlateColor", "PlateType", "Confidence", "Bright",
    "Direction", "LocationLeft", "LocationTop", "LocationRight", "LocationBottom", "CostTime", "CarBright", "CarColor",
    "CarLogo", "ImagePath", "ImageURL", "ResultTime", "CreateTime", "frame_index", "carspeed", "LabelInfoData",
    "vehicleKind", "vehicleBrand", "vehicleSeries", "vehicleStyle", "tag", "paper", "sun", "drop", "call", "crash",
    "danger", "mainBelt", "secondBelt", "vehicleLeft", "vehicleTop", "vehicleRight", "vehicleBootom",
    "vehicleConfidence", "face", "face_url1", "face_url2", "vehicleUrl", "fileName",
)
# Search document of a result, under the names that the search reads.
RESULT_INDEX = (
    "ResultTime", "PlateColor", "Direction", "vehicleBrand", "tag", "drop", "secondBelt", "call", "crash", "danger",
    "paper", "sun", "resultId", "taskId", "cameraId", "dataSourceId",
)


def result_detail(results: DataFrame) -> DataFrame:
    """Row key and the 47 detail columns; one that the input lacks is null."""
    present = {c.lower() for c in results.columns}
    cells = [
        F.col(f"`{name}`").alias(name) if name.lower() in present else F.lit(None).cast("string").alias(name)
        for name in RESULT
    ]
    return results.select(F.col("resultId").cast("string").alias("row_key"), *cells)


def result_index(results: DataFrame) -> DataFrame:
    """The 16 fields of the search document; ``resultId`` leads to the detail row."""
    return results.select(*[F.col(f"`{name}`").alias(name) for name in RESULT_INDEX])
