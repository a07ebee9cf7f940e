"""Where dead letters go besides their table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dead_letter_records(letters: DataFrame) -> DataFrame:
    """Dead letters as broker records: original key and bytes, origin and cause in the headers."""
    names = ("original_topic", "original_partition", "original_offset", "exception_type", "exception_message")
    headers = F.array(*[F.struct(F.lit(n.replace("_", "-")).alias("key"),
                                 F.col(n).cast("string").cast("binary").alias("value")) for n in names])
    return letters.select("key", "value", headers.alias("headers"))


def publish_dead_letters(letters: DataFrame, brokers: str, topic: str) -> None:
    """Sends dead letters to a Kafka topic (needs the spark-sql-kafka package on the class path)."""
    (dead_letter_records(letters).write.format("kafka").option("kafka.bootstrap.servers", brokers)
     .option("topic", topic).option("includeHeaders", "true").save())
