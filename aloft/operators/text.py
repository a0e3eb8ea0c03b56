"""Word counting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aloft.functions.columns import split_words


def word_count(df: DataFrame, text_col: str, sep: str = " ", word_col: str = "word",
               count_col: str = "count") -> DataFrame:
    """Case-sensitive count of the words of whole texts split on ``sep``
    (empty words dropped), most frequent first, ties by word.

    explode + filter + groupBy, all inside whole-stage codegen (a lambda
    filter on the array would be interpreted); the count is combined
    map-side, so a word holding a third of all tokens becomes one partial row
    per input partition before the shuffle.
    """
    words = (df.select(F.explode(split_words(F.col(text_col), sep)).alias(word_col))
             .where(F.col(word_col) != ""))
    return (words.groupBy(word_col).agg(F.count(F.lit(1)).alias(count_col))
            .orderBy(F.desc(count_col), word_col))
