"""Declared schemas of the data model (no inference anywhere)."""

from pyspark.sql import types as T

MESSAGE = T.StructType(
    [
        T.StructField("role", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("reasoning", T.StringType()),
    ]
)
MESSAGES = T.ArrayType(MESSAGE)

CHAT_MESSAGE = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
CHAT_MESSAGES = T.ArrayType(CHAT_MESSAGE)

CONVERSATION_FILE = T.StructType([T.StructField("messages", MESSAGES)])

REPLY = T.StructType([T.StructField("reasoning", T.StringType()), T.StructField("responding", T.StringType())])

TRAIN_LOG_COLUMNS = ["loss", "grad_norm", "learning_rate", "epoch"]
EVAL_LOG_COLUMNS = ["loss", "epoch"]
