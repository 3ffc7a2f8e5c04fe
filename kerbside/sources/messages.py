"""The pass and alarm messages: fields, wire numbers and Spark types.

Fixed values: field names, numbers, types and required marks must equal the
deployed messages.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

REQUIRED, OPTIONAL, REPEATED = "required", "optional", "repeated"


@dataclass(frozen=True)
class Field:
    name: str
    number: int
    type: str  # string, int32, uint32, float, bytes, or the name of another message
    label: str = REQUIRED


MESSAGES: dict[str, tuple[Field, ...]] = {
    "PlateInfoModel": (
        Field("PlateType", 1, "string"),
        Field("Color", 2, "string"),
        Field("Bright", 3, "int32"),
        Field("LicenseLen", 4, "int32"),
        Field("Country", 5, "int32"),
        Field("License", 6, "string"),
        Field("Believe", 7, "string"),
    ),
    "VehicleInfoModel": (
        Field("Index", 1, "int32"),
        Field("VehicleType", 2, "int32"),
        Field("ChanIndex", 3, "int32"),
        Field("ColorDepth", 4, "int32"),
        Field("Color", 5, "string"),
        Field("Speed", 6, "float"),
        Field("Length", 7, "float"),
        Field("VehicleLogoRecog", 8, "string"),
        Field("VehicleSubLogoRecog", 9, "string"),
        Field("VehicleModel", 10, "string"),
        Field("VehicleAttribute", 11, "int32"),
    ),
    "PlateRectModel": (
        Field("X", 1, "int32"),
        Field("Y", 2, "int32"),
        Field("Width", 3, "int32"),
        Field("Height", 4, "int32"),
    ),
    "PicInfoModel": (
        Field("Type", 1, "int32"),
        Field("PicRecogMode", 2, "int32"),
        Field("RedLightTime", 3, "int32"),
        Field("PlateRect", 4, "PlateRectModel"),
        Field("Data", 5, "bytes"),
    ),
    "OffenceSnapData": (
        Field("Id", 1, "string"),
        Field("DriveChan", 2, "int32"),
        Field("IllegalType", 5, "int32"),
        Field("IllegalSubType", 6, "string"),
        Field("SpeedLimit", 9, "int32"),
        Field("PlateInfo", 10, "PlateInfoModel"),
        Field("VehicleInfo", 11, "VehicleInfoModel"),
        Field("MonitoringSiteID", 12, "string"),
        Field("Dir", 13, "int32"),
        Field("DetectType", 14, "int32"),
        Field("PilotSafebelt", 15, "int32"),
        Field("CopilotSafebelt", 16, "int32"),
        Field("PilotSubVisor", 17, "int32"),
        Field("CopilotSubVisor", 18, "int32"),
        Field("PilotCall", 19, "int32"),
        Field("AlarmDataType", 20, "int32"),
        Field("Time", 21, "string"),
        Field("PicNum", 23, "int32"),
        Field("PicInfo", 24, "PicInfoModel", REPEATED),
        Field("Validity", 25, "int32", OPTIONAL),
        Field("WaitedLength", 26, "int32", OPTIONAL),
    ),
    "AlarmInfo": (
        Field("Id", 1, "string"),
        Field("VehicleId", 2, "string"),
        Field("PreyInfoId", 3, "string"),
        Field("Priority", 4, "uint32"),
        Field("DeviceId", 5, "string"),
        Field("Time", 6, "string"),
        Field("Type", 7, "uint32"),
        Field("PlateLicense", 8, "string", OPTIONAL),
        Field("PlateColor", 9, "string", OPTIONAL),
        Field("PlateType", 10, "string", OPTIONAL),
        Field("VehicleLogoRecog", 11, "string", OPTIONAL),
        Field("VehicleColor", 12, "string", OPTIONAL),
        Field("VehicleType", 13, "int32", OPTIONAL),
        Field("VehicleSpeed", 14, "float", OPTIONAL),
    ),
    "TrafficInfo": (
        Field("Id", 1, "string"),
        Field("Time", 2, "string"),
        Field("TotalVehicle", 3, "uint32"),
        Field("LargeVehicle", 4, "uint32"),
        Field("MediumVehicle", 5, "uint32"),
        Field("SmallVehicle", 6, "uint32"),
        Field("OtherVehicle", 7, "uint32"),
        Field("DriveChan", 8, "int32"),
        Field("AverageSpeed", 9, "float"),
    ),
}
PASS_MESSAGE, ALARM_MESSAGE, SUMMARY_MESSAGE = "OffenceSnapData", "AlarmInfo", "TrafficInfo"

_SPARK_TYPES = {
    "string": T.StringType(), "int32": T.IntegerType(), "uint32": T.LongType(),
    "float": T.FloatType(), "bytes": T.BinaryType(),
}


def spark_schema(message: str) -> T.StructType:
    """All fields nullable: a missing required field is reported, not a parse failure."""
    struct = T.StructType()
    for field in MESSAGES[message]:
        kind = _SPARK_TYPES.get(field.type) or spark_schema(field.type)
        struct.add(field.name, T.ArrayType(kind) if field.label == REPEATED else kind)
    return struct


def descriptor_set(reading: bool = False) -> bytes:
    """Serialized file descriptor set of the messages, for Spark's protobuf functions.

    For ``reading`` no field is required, so that a message that lacks one is parsed and
    the check for required fields names it, instead of being no message at all.
    """
    from google.protobuf import descriptor_pb2 as pb

    kinds = pb.FieldDescriptorProto
    scalar = {
        "string": kinds.TYPE_STRING, "int32": kinds.TYPE_INT32, "uint32": kinds.TYPE_UINT32,
        "float": kinds.TYPE_FLOAT, "bytes": kinds.TYPE_BYTES,
    }
    labels = {
        REQUIRED: kinds.LABEL_OPTIONAL if reading else kinds.LABEL_REQUIRED, OPTIONAL: kinds.LABEL_OPTIONAL, REPEATED: kinds.LABEL_REPEATED,
    }
    file = pb.FileDescriptorProto(name="kerbside.proto", package="protocol", syntax="proto2")
    for name, fields in MESSAGES.items():
        message = file.message_type.add(name=name)
        for f in fields:
            entry = message.field.add(name=f.name, number=f.number, label=labels[f.label])
            if f.type in scalar:
                entry.type = scalar[f.type]
            else:
                entry.type, entry.type_name = kinds.TYPE_MESSAGE, f".protocol.{f.type}"
    return pb.FileDescriptorSet(file=[file]).SerializeToString()
