"""Helpers that several operators share."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def per_batch(df: DataFrame, work: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """``work`` turns each Arrow batch into columns of ``schema``."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(kinds)
        for batch in batches:
            out = work(batch)
            yield pa.RecordBatch.from_arrays([pa.array(out[n], target.field(n).type) for n in names], names)

    from pyspark.sql.types import _parse_datatype_string

    kinds = _parse_datatype_string(schema)
    return df.mapInArrow(run, kinds)


def without(documents: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows whose id and text are not in ``gone`` (doc_id, text_key: the text's ``xxhash64``); a null id
    is equal to a null id."""
    gone = gone.distinct().toDF("gone_id", "gone_key")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("gone_id")) & (F.xxhash64("text") == F.col("gone_key"))
    return documents.join(gone, same, "left_anti")


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def sha256(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def load_tokenizer(path: str):
    """The library's tokenizer, whole texts, on the task's own thread: Spark already keeps every core busy."""
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer
