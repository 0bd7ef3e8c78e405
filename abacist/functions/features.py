"""Token arrays: ids, label masks, truncation, tails."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from abacist.constants import IGNORED_LABEL
from abacist.functions.columns import ColumnLike, as_column
from abacist.functions.workers import loaded

Tokenizer = Callable[[Column], Column]


def code_points(text: ColumnLike) -> Column:
    """Default tokenizer: one id per Unicode code point."""
    text = as_column(text)
    no_ids = F.array_remove(F.array(F.lit(0)), 0)
    return F.when(text == "", no_ids).otherwise(
        F.transform(F.split(text, ""), lambda c: F.ascii(c))
    )


def batch_tokenizer(load: Callable[[], Callable[[list[str]], list[list[int]]]]) -> Tokenizer:
    """A tokenizer column function around a user-supplied batch encoder.

    ``load`` runs once per Python worker and returns a function from a list of
    texts to a list of id lists.
    """
    name = uuid.uuid4().hex

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            filled = texts.fillna("").tolist()
            yield pd.Series(list(loaded(name, load)(filled)), index=texts.index)

    return lambda text: encode(as_column(text))


def label_mask(prefix_length: Column, labels: Column) -> Column:
    """Ignored labels over the prefix, then the given ones."""
    return F.concat(F.array_repeat(F.lit(IGNORED_LABEL), prefix_length), labels)


def truncated(ids: ColumnLike, max_length: int) -> Column:
    """The first ``max_length`` entries."""
    return F.slice(as_column(ids), 1, max_length)


def ones(ids: ColumnLike) -> Column:
    """Attention mask of an unpadded row."""
    return F.array_repeat(F.lit(1), F.size(as_column(ids)))


def after_prefix(ids: ColumnLike, prefix_length: ColumnLike) -> Column:
    """The ids behind a prefix of ``prefix_length`` entries."""
    ids, length = as_column(ids), as_column(prefix_length).cast("int")
    return F.slice(ids, length + 1, F.greatest(F.size(ids) - length, F.lit(0)))


def joined_ids(prompt: ColumnLike, response: ColumnLike, max_length: int) -> Column:
    """Prompt and response ids, cut to ``max_length``."""
    return truncated(F.concat(as_column(prompt), as_column(response)), max_length)


def kept_response_length(
    prompt: ColumnLike, response: ColumnLike, max_length: int
) -> Column:
    """How many response ids :func:`joined_ids` keeps."""
    prompt_size = F.size(as_column(prompt))
    total = prompt_size + F.size(as_column(response))
    return F.greatest(F.least(total, F.lit(max_length)) - prompt_size, F.lit(0))


def padded(ids: ColumnLike, width: ColumnLike, filler: int) -> Column:
    """Ids filled up on the right to ``width`` entries."""
    ids = as_column(ids)
    missing = F.greatest(as_column(width) - F.size(ids), F.lit(0)).cast("int")
    return F.concat(ids, F.array_repeat(F.lit(filler), missing))
