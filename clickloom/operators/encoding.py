"""Text embedding with a pluggable encoder, and embedding records."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from clickloom.functions.collections import rounded
from clickloom.functions.ids import embedding_article_id
from clickloom.operators.cleaning import column_or_blank, drop_blank, embedding_text
from clickloom.functions.text import tokens
from clickloom.session import spread, use_all_cores

BATCH = 64
# Rows whose tokens are added up at once, and rows of a part that goes to a model.
ROWS_AT_ONCE, ROWS_PER_PART = 512, 2_000
Encoder = Callable[[list[str]], np.ndarray]


DIMENSION = 64


def hashed_vectors(df: DataFrame, text: str, dim: int = DIMENSION) -> DataFrame:
    """``text`` replaced by signed hashed token counts scaled to length one; null for null. Stands in
    where no model is installed.

    Tokens are cut out by Spark; each slice of a batch digests its distinct tokens once and adds up all its rows at a
    time, so a worker holds little besides the batch.
    """
    keep = [f for f in df.schema.fields if f.name not in (text, "embedding")]
    schema = T.StructType(keep + [T.StructField("embedding", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, b.num_rows, ROWS_AT_ONCE)):
            missing = batch.column(text).is_null()
            words = pc.fill_null(batch.column(text), pa.scalar([], pa.list_(pa.string())))
            row = pc.list_parent_indices(words).to_numpy(zero_copy_only=False)
            coded = words.flatten().dictionary_encode()
            digests = [md5(w.encode()).hexdigest() for w in coded.dictionary.to_pylist()]
            place = np.array([int(d[:8], 16) % dim for d in digests], np.int64)
            sign = np.array([1.0 if d[8] < "8" else -1.0 for d in digests])
            token = coded.indices.to_numpy(zero_copy_only=False)
            sums = np.bincount(row * dim + place[token], sign[token], batch.num_rows * dim).astype(float).reshape(-1, dim)
            size = np.sqrt((sums * sums).sum(1))[:, None]
            sums = np.divide(sums, size, out=sums, where=size > 0)
            vectors = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * dim), pa.array(sums.ravel()), mask=missing)
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in keep), vectors], names=schema.names)

    return use_all_cores(df).select(*(f.name for f in keep), tokens(F.col(text)).alias(text)).mapInArrow(run, schema)


def encode(df: DataFrame, text: str, make_encoder: Callable[[], Encoder] | None = None, batch: int = BATCH) -> DataFrame:
    """Replace ``text`` by its ``embedding``: hashed token counts, or the vectors of a model.

    ``make_encoder`` is called once per Python worker and its result with batches of texts of about equal length
    (a null text is empty). Rows are then spread evenly first, in as many parts as their number asks for, because a
    model costs far more than moving a text.
    """
    if make_encoder is None:
        return hashed_vectors(df, text)
    keep = [c for c in df.columns if c not in (text, "embedding")]

    def make_predict() -> Callable[[np.ndarray], np.ndarray]:
        encoder = make_encoder()
        return lambda texts: np.asarray(encoder(list(texts)), dtype="float64")

    model = predict_batch_udf(make_predict, return_type=T.ArrayType(T.DoubleType()), batch_size=batch)
    rows = df.select(*keep, F.coalesce(text, F.lit("")).alias(text))
    rows = spread(rows, *keep, rows=df.count(), rows_per_part=ROWS_PER_PART).sortWithinPartitions(F.length(text))
    return rows.select(*keep, model(F.col(text)).alias("embedding"))


def with_embedding_ids(articles: DataFrame) -> DataFrame:
    """Re-key articles by the case-preserving rule and add their text; rows without text drop out."""
    keyed = articles.withColumn(
        "article_id",
        embedding_article_id(
            column_or_blank(articles, "url"),
            column_or_blank(articles, "title"),
            column_or_blank(articles, "source_name", "source"),
            column_or_blank(articles, "publishedAt", "pub_date"),
        ),
    )
    return drop_blank(embedding_text(keyed), "embedding_text")


def embedding_items(df: DataFrame) -> DataFrame:
    """Embedding records: metadata with fallbacks, vector rounded to six places, dimension."""
    data_source = F.coalesce(F.col("data_source"), F.lit("newsapi")) if "data_source" in df.columns else F.lit("newsapi")
    return df.select(
        "article_id",
        column_or_blank(df, "title").alias("title"),
        column_or_blank(df, "url").alias("url"),
        column_or_blank(df, "category").alias("category"),
        column_or_blank(df, "source_name", "source").alias("source"),
        column_or_blank(df, "abstract", "description").alias("abstract"),
        column_or_blank(df, "publishedAt", "pub_date").alias("pub_date"),
        column_or_blank(df, "fetched_at").alias("fetched_at"),
        data_source.alias("data_source"),
        rounded(F.col("embedding")).alias("embedding"),
        F.size("embedding").alias("embedding_dim"),
    )
