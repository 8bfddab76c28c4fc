"""Stable content ids: SHA-256 over a url, or over a fallback when there is no url."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from clickloom.functions.text import blank_to_null, strip, text_or

SEPARATOR = "||"


def hashed_id(key: Column, lower: bool = True) -> Column:
    return F.sha2(F.lower(key) if lower else key, 256)


def live_article_id(
    url: Column, title: Column, published: Column, source: Column, blank_is_missing: bool = True
) -> Column:
    """Id of a landed article. ``blank_is_missing=False`` lets all blank urls share one id."""
    first = blank_to_null(url) if blank_is_missing else F.trim(url)
    fallback = F.concat_ws(SEPARATOR, text_or(title), text_or(published), text_or(source))
    return hashed_id(F.coalesce(first, fallback))


def catalogue_article_id(url: Column, news_id: Column, stripper=F.trim) -> Column:
    """Id of a catalogue row; null when both the url and the catalogue id are blank."""
    return hashed_id(F.coalesce(blank_to_null(url, stripper), blank_to_null(news_id, stripper)))


def embedding_article_id(url: Column, title: Column, source: Column, published: Column) -> Column:
    """Case-preserving id used by the embedding job."""
    fallback = F.concat_ws(
        SEPARATOR, text_or(strip(title)), text_or(strip(source)), text_or(strip(published))
    )
    return hashed_id(F.coalesce(blank_to_null(url, strip), fallback), lower=False)


def data_version(run_id: Column, stamp: Column) -> Column:
    return F.substring(F.md5(F.concat_ws("_", run_id, stamp)), 1, 8)
