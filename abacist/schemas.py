"""Declared schemas of the logical tables; every column may be null."""

from __future__ import annotations

from pyspark.sql import types as T

_STRING = T.StringType()
_TEXT = T.VariantType()  # a string or an array of strings
_IDS = T.ArrayType(T.IntegerType())

MESSAGE = T.StructType([T.StructField("role", _STRING), T.StructField("content", _STRING)])

CORRUPT_COLUMN = "_corrupt_record"


def _table(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# As read from JSON: the VARIANT columns become strings in sources.json_tables.
RAW_TRAIN = _table(id=_STRING, question=_TEXT, answer=_STRING, instruction=_TEXT)
RAW_TEST = _table(id=_STRING, question=_TEXT)
RAW_PREFERENCE = _table(
    id=_STRING, question=_TEXT, answer=_STRING, chosen=_TEXT, rejected=_TEXT, instruction=_TEXT
)
RAW_SOLUTION = _table(
    id=_STRING,
    question=_TEXT,
    answer=_STRING,
    cot=_TEXT,
    instruction=_TEXT,
    augmented=T.BooleanType(),
    original_id=_STRING,
)

SFT_FEATURES = _table(input_ids=_IDS, attention_mask=_IDS, labels=_IDS)
PREFERENCE_PAIRS = _table(
    prompt=T.ArrayType(MESSAGE), chosen=T.ArrayType(MESSAGE), rejected=T.ArrayType(MESSAGE)
)
ROLLOUT_PROMPTS = _table(prompt=_STRING, question=_STRING, answer=_STRING, id=_STRING)
SUBMISSION = _table(id=_STRING, ret=_STRING)
