"""Embedding records of an article table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from clickloom.operators.dedup import keep_first
from clickloom.operators.encoding import Encoder, embedding_items, encode, with_embedding_ids
from clickloom.operators.reports import embedding_candidates
from clickloom.schemas import require_rows


def build_embedding_items(
    articles: DataFrame,
    make_encoder: Callable[[], Encoder] | None = None,
    limit: int | None = None,
    row_id: str = "article_id",
) -> DataFrame:
    """Titled, distinct articles with vectors, one record per embedding id."""
    chosen = with_embedding_ids(embedding_candidates(require_rows(articles, "articles"), limit, row_id))
    unique = keep_first(chosen, F.col("article_id"), [])
    return embedding_items(encode(unique, "embedding_text", make_encoder))
