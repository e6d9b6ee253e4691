"""Literal records, each test changing what it is about."""

import json

from pyspark.sql import Row

from tidegate.schemas import RAW_FIELDS, ROLLUP_FIELDS, ddl

ORIGIN_DDL = "topic STRING, `partition` INT, `offset` BIGINT"

RAW = {
    "timestamp": "2019-05-13T19:54:27Z",
    "accountType": "CORE",
    "account": "acct:5550101",
    "device": "1234",
    "deviceLabel": "label",
    "deviceMetadata": {},
    "monitoringSystem": "MAAS",
    "systemMetadata": {"checkId": "c1", "monitoringZone": ""},
    "collectionName": "agent.filesystem",
    "collectionLabel": "",
    "collectionTarget": "",
    "collectionMetadata": {"product": "demo"},
    "ivalues": {"filesystem.free": 20},
    "fvalues": {},
    "svalues": {"note": "x"},
    "units": {"filesystem.free": "KILOBYTES"},
}

ROLLUP = {
    "key": "k",
    "start": 123456,
    "end": 987654,
    "accountType": "CORE",
    "account": "1234567",
    "device": "",
    "deviceLabel": "",
    "monitoringSystem": "MAAS",
    "collectionLabel": "",
    "collectionTarget": "",
    "collectionName": "agent.cpu",
    "units": {"idle": "percent"},
    "collectionMetadata": {},
    "systemMetadata": {"tenantId": "other"},
    "deviceMetadata": {},
    "ivalues": {"idle": {"min": 1, "max": 3, "mean": 2}},
    "fvalues": {},
}


def raw_df(spark, *changes):
    rows = [
        ("unified.metrics.json", 0, i, *({**RAW, **change}[name] for name in RAW_FIELDS))
        for i, change in enumerate(changes)
    ]
    return spark.createDataFrame(rows, f"{ORIGIN_DDL}, {ddl(RAW_FIELDS)}")


def rollup_df(spark, *changes, level="5m"):
    def typed(record):
        for name in ("ivalues", "fvalues"):
            if record[name] is not None:
                record = {**record, name: {k: v and Row(v["min"], v["max"], v["mean"]) for k, v in record[name].items()}}
        return record

    rows = []
    for i, change in enumerate(changes):
        record = typed({**ROLLUP, **change})
        rows.append((f"unified.metrics.json.{level}", 0, i, *(record[name] for name in ROLLUP_FIELDS)))
    return spark.createDataFrame(rows, f"{ORIGIN_DDL}, {ddl(ROLLUP_FIELDS)}")


def messages(spark, *values, topic="unified.metrics.json", offset=0):
    texts = [v if v is None or isinstance(v, str) else json.dumps(v) for v in values]
    rows = [(topic, 0, offset + i, text) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, f"{ORIGIN_DDL}, value STRING")
