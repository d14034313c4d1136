"""Encoding through a stored dictionary of distinct pretokens."""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.pretokens import pretokens_with_specials
from textloom.operators.tokenizer import SLICE, Tokenizer, placed_ids, row_ends

HOT_PRETOKENS = 65_536
HOT_LENGTH = 64  # characters of a pretoken that may be broadcast
RUN = 4096  # pretokens whose ids are put in order together

ENTRIES = T.StructType(
    [
        T.StructField("pretoken", T.StringType()),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("seen", T.LongType()),
    ]
)


def _folder(path: str, tokenizer: Tokenizer) -> str:
    return f"{path}/merges={hashlib.md5(repr(tokenizer.merges).encode()).hexdigest()}"


def read_dictionary(spark: SparkSession, path: str, tokenizer: Tokenizer) -> DataFrame:
    """``pretoken, ids, seen`` of one tokenizer, empty before the first corpus; ``seen`` is from the corpus that brought it."""
    try:
        return spark.read.schema(ENTRIES).parquet(_folder(path, tokenizer))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ENTRIES)


def _pieces(docs: DataFrame, text: str, *columns: str) -> DataFrame:
    # The outer form keeps the optimizer from running the split twice.
    return docs.select(*columns, F.posexplode_outer(pretokens_with_specials(text)).alias("pos", "pretoken"))


def extend_dictionary(docs: DataFrame, tokenizer: Tokenizer, path: str, text: str = "text") -> DataFrame:
    """Encode the pretokens of ``docs`` that the dictionary lacks, store them and return the whole dictionary.

    Each tokenizer has its own dictionary. A run that is lost adds nothing, and a run
    over a known corpus encodes nothing. One run at a time may extend a dictionary.
    """
    spark = docs.sparkSession
    seen = _pieces(docs, text).filter(F.col("pretoken").isNotNull()).groupBy("pretoken").agg(F.count(F.lit(1)).alias("seen"))
    fresh = seen.join(read_dictionary(spark, path, tokenizer).select("pretoken"), "pretoken", "left_anti")
    rows = fresh.select("pretoken", tokenizer.encode_piece("pretoken").alias("ids"), "seen")
    rows.write.mode("append").parquet(_folder(path, tokenizer))
    return read_dictionary(spark, path, tokenizer)


def _hot(dictionary: DataFrame, limit: int) -> DataFrame:
    """The most frequent entries: a bounded number of bounded width."""
    short = dictionary.filter(F.length("pretoken") <= HOT_LENGTH)
    return short.orderBy(F.desc("seen"), "pretoken").limit(limit)


def _in_runs(batches: Iterator[tuple[pa.Array, ...]], hot: dict[str, bytes], run: int) -> Iterator[pa.Array]:
    """The ids of each row's texts, a list for every ``run`` pretokens, from the frequent entries and the row's rare ones.

    Several texts of a row are one: their pretokens go by place, then by ids. What nobody knows is left out.
    """
    for texts, rare in batches:
        ends, at = row_ends(texts) + row_ends(rare), 0
        while at < len(texts):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE, "right")))
            pieces, entries = texts.slice(at, stop - at), rare.slice(at, stop - at).flatten()
            at = stop
            names, ids = entries.field("pretoken").to_pylist(), entries.field("ids").to_pylist()
            known = {p: array("i", x).tobytes() for p, x in zip(names, ids, strict=True)}
            lists = pieces.flatten()
            flat = lists.flatten().dictionary_encode()
            encoded = [hot.get(p) or known.get(p, b"") for p in flat.dictionary.to_pylist()]
            which = flat.indices.to_numpy().copy()
            sizes, n_texts = lists.value_lengths().to_numpy(), pieces.value_lengths().to_numpy()
            place = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            row = np.repeat(np.arange(len(pieces)), n_texts)  # of a text
            longest = np.zeros(len(pieces), np.int64)
            np.maximum.at(longest, row, sizes)
            row = np.repeat(row, sizes)  # of a pretoken
            for r in np.flatnonzero(n_texts > 1).tolist():
                s, e = np.searchsorted(row, [r, r + 1]).tolist()
                order = sorted(range(s, e), key=lambda i: (place[i], array("i", encoded[which[i]])))
                which[s:e], place[s:e] = which[order], place[order]
            runs = np.maximum(1, -(-longest // run))
            bounds = np.concatenate([[0], np.cumsum(runs)])
            counts = np.bincount(bounds[row] + place // run, minlength=int(bounds[-1]))
            yield pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), placed_ids(which, encoded, counts))


def _runs(docs: DataFrame, dictionary: DataFrame, key: str, text: str, hot: int, run: int) -> DataFrame:
    """``key, runs``: a text's ids in lists of ``run`` pretokens each.

    A text moves once, together with the entries of its rare pretokens, and is put in order where these arrive.
    """
    few = _hot(dictionary, hot).select("pretoken", "ids")
    names = F.broadcast(few.select("pretoken"))
    # The outer form keeps the optimizer from running the split twice.
    pieces = docs.select(key, F.explode_outer(F.array_distinct(pretokens_with_specials(text))).alias("pretoken"))
    rest = pieces.filter(F.col("pretoken").isNotNull()).join(names, "pretoken", "left_anti").join(dictionary.select("pretoken", "ids"), "pretoken")
    entry = F.struct("pretoken", "ids")
    rows = docs.select(key, F.col(text).alias("text")).unionByName(rest.select(key, entry.alias("rare")), allowMissingColumns=True)
    whole = rows.groupBy(key).agg(F.collect_list("text").alias("texts"), F.collect_list("rare").alias("rare"))
    frequent = {r.pretoken: array("i", r.ids).tobytes() for r in few.collect()}  # at most ``hot`` short ones
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    @F.arrow_udf(T.ArrayType(T.ArrayType(T.IntegerType())))
    def in_runs(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        return _in_runs(batches, shared.value, run)

    return whole.select(key, in_runs(F.transform("texts", pretokens_with_specials), "rare").alias("runs"))


def encode_runs(
    docs: DataFrame, dictionary: DataFrame, key: str, text: str = "text", hot: int = HOT_PRETOKENS, run: int = RUN
) -> DataFrame:
    """``key, run, ids``: the ids of every ``run`` pretokens of a text, numbered in order.

    Frequent pretokens are looked up in a broadcast part of the dictionary; the others, each
    of them rare, are shuffled to theirs, once for each text. Texts without pretokens have one
    run without ids; the dictionary must know all others. Keys should be unique.
    """
    runs = _runs(docs, dictionary, key, text, hot, run)
    return runs.select(key, F.posexplode_outer("runs").alias("run", "ids")).withColumn("run", F.col("run").cast("bigint"))


def encode_with_dictionary(
    docs: DataFrame, dictionary: DataFrame, key: str, text: str = "text", hot: int = HOT_PRETOKENS, run: int = RUN
) -> DataFrame:
    """``key, ids`` of whole texts, joined from their runs."""
    return _runs(docs, dictionary, key, text, hot, run).select(key, F.flatten("runs").alias("ids"))


def count_with_dictionary(
    docs: DataFrame, dictionary: DataFrame, key: str, text: str = "text", hot: int = HOT_PRETOKENS
) -> DataFrame:
    """``key, n_pretokens, n_tokens`` per text; only rare pretokens are shuffled to the dictionary."""
    few = _hot(dictionary, hot).select("pretoken", F.size("ids").alias("size"))
    joined = _pieces(docs, text, key).join(F.broadcast(few), "pretoken", "left")
    cold = F.when(F.col("size").isNull(), F.col("pretoken"))
    # Frequent pretokens of a text are one row; its key spreads it over the second join.
    per_text = joined.groupBy(key, cold.alias("cold")).agg(F.count("pretoken").alias("n"), F.sum("size").alias("known"))
    salt = F.when(F.col("cold").isNull(), F.pmod(F.xxhash64(key), F.lit(4096)) + 1).otherwise(0)
    sizes = dictionary.select(F.col("pretoken").alias("cold"), F.size("ids").alias("size"), F.when(F.size("ids") < 0, 1).otherwise(0).alias("salt"))
    both = per_text.withColumn("salt", salt).join(sizes, ["cold", "salt"], "left")
    n_tokens = F.sum(F.coalesce("known", F.col("n") * F.col("size"), F.lit(0)))
    return both.groupBy(key).agg(F.sum("n").alias("n_pretokens"), n_tokens.cast("bigint").alias("n_tokens"))
