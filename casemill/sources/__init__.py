"""Sources: Kafka-shaped streams, id lists, JDBC and parquet tables."""

from casemill.sources.idlist import read_id_list
from casemill.sources.jdbc import read_jdbc_table, write_jdbc_table
from casemill.sources.kafka import kafka_options, kafka_source, kafka_shaped
from casemill.sources.tables import read_table

__all__ = [
    "kafka_options", "kafka_source", "kafka_shaped", "read_id_list",
    "read_jdbc_table", "write_jdbc_table", "read_table",
]
