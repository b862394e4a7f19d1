from casemill.schemas import KAFKA_SCHEMA


def kafka_rows(spark, values, topic="case_increment", partition=0, start=0):
    """Kafka-shaped DataFrame from message texts (offsets in list order)."""
    rows = [(None, v, topic, partition, start + i, None) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, KAFKA_SCHEMA)


def by_key(df, key):
    return {r[key]: r.asDict() for r in df.collect()}

SF_SMALL = "/root/testdata/sf0.001"
