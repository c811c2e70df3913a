"""Hand-made inputs following FIXTURES.md (cases listed there)."""

import json

from pyspark.sql import functions as F


def envelope(spark, records, loaded_at="2024-03-01 00:00:00", batch="b1"):
    """records: list of (dict, loaded_at?, batch?) or dict."""
    rows = []
    for r in records:
        if isinstance(r, tuple):
            d, la, b = (list(r) + [loaded_at, batch])[:3]
        else:
            d, la, b = r, loaded_at, batch
        rows.append((json.dumps(d), la, b))
    df = spark.createDataFrame(rows, "j string, la string, b string")
    return df.select(F.parse_json("j").alias("payload"), F.col("la").cast("timestamp_ntz").alias("_loaded_at"),
                     F.col("b").alias("_batch_id"))


def wqp(lake, station, date, char, value, unit_key="ResultMeasure/MeasureUnitCode", unit="ug/L", det=None):
    d = {"_alpine_lake_id": lake, "MonitoringLocationIdentifier": station, "ActivityStartDate": date,
         "CharacteristicName": char, "ResultMeasureValue": value, unit_key: unit}
    if det:
        d["ResultDetectionConditionText"] = det
    return {k: v for k, v in d.items() if v is not None}


def daily(gage, date, q, approval="A"):
    return {"gage_id": gage, "flow_date": date, "discharge_cfs": q, "approval": approval}
