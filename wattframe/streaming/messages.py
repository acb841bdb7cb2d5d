"""Text messages by topic. Works on a stream and on a table alike."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed


def messages_of(messages: DataFrame, topic: str = fixed.MESSAGE_TOPIC) -> DataFrame:
    """The payloads of one topic as text, from (topic, payload, ts).

    A payload that isn't UTF-8 gives no message and stays beside it as it came,
    so one such payload neither stops a stream nor vanishes.
    """
    own = messages.where(F.col("topic") == F.lit(topic))
    text = F.try_validate_utf8(F.col("payload").cast("string"))
    return own.select(
        "topic", text.alias("message"), "ts", F.when(text.isNull(), F.col("payload")).alias("undecoded")
    )
