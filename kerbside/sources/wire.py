"""Protobuf wire form of the messages.

Where the spark-protobuf package is on the class path its functions do the work
in the JVM. Elsewhere Arrow batches go through the Python protobuf library, by
way of JSON text, so that the same schema code serves both.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from kerbside.sources.messages import descriptor_set


def has_spark_protobuf(spark: SparkSession) -> bool:
    jvm = spark._jvm
    try:
        loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
        jvm.java.lang.Class.forName("org.apache.spark.sql.protobuf.ProtobufDataToCatalyst", False, loader)
        return True
    except Exception:
        return False


def parse(payload: Column, message: str) -> Column:
    """Message struct by spark-protobuf; null where the bytes are no message."""
    from pyspark.sql.protobuf.functions import from_protobuf

    return from_protobuf(
        payload, f"protocol.{message}", options={"mode": "PERMISSIVE"}, binaryDescriptorSet=descriptor_set(reading=True)
    )


def serialize(struct: Column, message: str, spark: SparkSession) -> Column:
    """Wire bytes of a message struct."""
    if has_spark_protobuf(spark):
        from pyspark.sql.protobuf.functions import to_protobuf

        return to_protobuf(struct, f"protocol.{message}", binaryDescriptorSet=descriptor_set())
    only_local(spark)
    return json_to_wire(F.to_json(struct), message)


def only_local(spark: SparkSession) -> None:
    """The Python fallback is for a local master; a cluster is to have the package."""
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("protobuf on a cluster needs Spark's spark-protobuf package on the class path")


def wire_to_json(payload: Column, message: str) -> Column:
    """JSON text of wire bytes, null where they are no message.

    A field that is absent stays absent, so that a check for required fields sees it.
    """
    descriptors = descriptor_set(reading=True)

    @F.pandas_udf("string")
    def convert(payloads: pd.Series) -> pd.Series:
        from google.protobuf import json_format

        kind = _message_class(descriptors, message)

        def one(raw):
            parsed = kind()
            try:
                parsed.MergeFromString(bytes(raw))
                return json_format.MessageToJson(parsed, preserving_proto_field_name=True, indent=None)
            except Exception:
                return None

        return payloads.map(one, na_action="ignore")

    return convert(payload)


def json_to_wire(text: Column, message: str) -> Column:
    """Wire bytes of JSON text; fails on a missing required field."""
    descriptors = descriptor_set()

    @F.pandas_udf("binary")
    def convert(texts: pd.Series) -> pd.Series:
        from google.protobuf import json_format

        kind = _message_class(descriptors, message)
        return texts.map(lambda t: json_format.Parse(t, kind()).SerializeToString(), na_action="ignore")

    return convert(text)


def _message_class(descriptors: bytes, message: str):
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

    pool = descriptor_pool.DescriptorPool()
    for file in descriptor_pb2.FileDescriptorSet.FromString(descriptors).file:
        pool.Add(file)
    return message_factory.GetMessageClass(pool.FindMessageTypeByName(f"protocol.{message}"))
