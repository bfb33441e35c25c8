"""Explicit schemas; nothing is inferred from data."""

from pyspark.sql import types as T

RAW_LINES = T.StructType([T.StructField("value", T.StringType())])

SYSTEM_LOG = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("Date", "Time", "Level", "Component", "Content", "EventTemplate")
    ]
)

SERVER_METRICS = T.StructType(
    [
        T.StructField("Time stamp", T.StringType()),
        T.StructField("Server", T.StringType()),
        T.StructField("Level", T.StringType()),
        T.StructField("Response Time (ms)", T.IntegerType()),
        T.StructField("CPU (%)", T.IntegerType()),
        T.StructField("Memory (GB)", T.DoubleType()),
        T.StructField("Requests", T.IntegerType()),
    ]
)

COMPONENT_VOLUME = T.StructType(
    [T.StructField("Component", T.StringType()), T.StructField("Total_Logs", T.LongType())]
)

SEVERITY_LEVELS = T.StructType(
    [T.StructField("Level", T.StringType()), T.StructField("Total_Logs", T.LongType())]
)

TOP_TEMPLATES = T.StructType(
    [T.StructField("EventTemplate", T.StringType()), T.StructField("Actions", T.LongType())]
)

HOURLY_FEATURES = T.StructType(
    [
        T.StructField("Hour_Window", T.TimestampNTZType()),
        T.StructField("Total_Logs", T.LongType()),
        T.StructField("CBS_Count", T.LongType()),
        T.StructField("CSI_Count", T.LongType()),
        T.StructField("Unique_Templates", T.LongType()),
        T.StructField("Active_Components", T.LongType()),
        T.StructField("CSI_Ratio", T.DoubleType()),
    ]
)

STAGE_TIMINGS = T.StructType(
    [
        T.StructField("Process", T.StringType()),
        T.StructField("Worker Setup", T.StringType()),
        T.StructField("Seconds", T.DoubleType()),
    ]
)

RUN_METRICS = T.StructType(
    [
        *STAGE_TIMINGS.fields,
        T.StructField("Rows", T.LongType()),
        T.StructField("Bytes", T.LongType()),
    ]
)
