"""Near-duplicate paragraphs by banded MinHash, verified by exact Jaccard similarity, and equal pieces inside of them.

A paragraph is a run of lines that is closed when it has enough words, so a short line
is no paragraph and no word is left out. A passage may also stand inside a longer line or
over the ends of paragraphs: pieces of a fixed number of words, which begin where their
own words say so, are the same in every text that holds the passage.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.components import connected_components
from textloom.llm.ngram_join import FILTER_BITS, block_links, bounded, ordered, verified
from textloom.llm.words import SHINGLE, grams, hashed_rows, mixed, sets_of
from textloom.workspace import fresh_path, write_through

MIN_WORDS = 30
PIECE = 30  # words of a piece
WINDOW = 31  # of so many places that follow each other, one at least begins a piece
ANCHOR = 3  # words whose hash decides where pieces begin
PERCENT = 80
RECALL = 0.999
SIGNATURE = 256
TEXTS = 200  # texts handled at a time


def tune(similarity: float, recall: float, rows: int = 3) -> tuple[int, int]:
    """Fewest bands of ``rows`` hashes that bring a pair of this similarity together often enough.

    Few rows are right where unlike paragraphs share nothing; verification removes the rest.
    """
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows)), rows


def paragraphs_of(text: str | None, min_words: int = MIN_WORDS) -> list[str]:
    """Runs of lines, each closed by the line that brings it to ``min_words`` words; the rest of the text joins the last one.

    A text of fewer words has none.
    """
    out: list[str] = []
    held, words = [], 0
    for line in text.split("\n") if text else ():
        held.append(line)
        words += len(line.encode("utf-8", "surrogatepass").split())
        if words >= min_words:
            out.append("\n".join(held))
            held, words = [], 0
    if words and out:
        out[-1] = "\n".join([out[-1], *held])
    return out


def pieces_of(hashes: np.ndarray, size: int = PIECE, window: int = WINDOW) -> np.ndarray:
    """First words of the pieces: the leftmost smallest hash of every ``window`` places, or of all if they are fewer."""
    places = len(hashes) - size + 1
    if places <= 0:
        return np.empty(0, np.int64)
    values = mixed(grams(hashes, ANCHOR)[:places])
    if places <= window:
        return np.array([values.argmin()])
    least = np.lib.stride_tricks.sliding_window_view(values, window).argmin(1) + np.arange(places - window + 1)
    return np.unique(least)


def _lists(matrix: np.ndarray) -> pa.ListArray:
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(matrix).ravel()))


def _units(docs: DataFrame, min_words: int, bands: int, rows: int, size: int) -> DataFrame:
    """Paragraphs (``kind`` 0) with their features and text, and pieces (``kind`` 1) with their digest, of each text."""
    rng = np.random.default_rng(97)
    factors = rng.integers(1, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    other = np.uint64(0xA0761D6478BD642F)

    def paragraphs(tokens, bounds) -> list[pa.Array]:
        sizes, starts = np.diff(bounds), bounds[:-1]
        band = np.zeros((len(sizes), bands), np.uint64)
        for r in range(rows):
            for b in range(bands):
                low = np.minimum.reduceat(mixed(tokens * factors[b * rows + r]), starts)
                band[:, b] = mixed(band[:, b] * np.uint64(31) + low + np.uint64(b))
        bits = np.zeros((len(sizes), SIGNATURE), np.uint8)
        bits[np.repeat(np.arange(len(sizes)), sizes), (tokens % np.uint64(SIGNATURE)).astype(np.int64)] = 1
        digests = [xxhash.xxh3_128_digest(tokens[i:j]) for i, j in zip(bounds[:-1], bounds[1:], strict=True)]
        d = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        return [pa.array(sizes), pa.array(d[:, 0]), pa.array(d[:, 1]), _lists(np.packbits(bits, axis=1).view(np.int64)), _lists(band.view(np.int64))]

    def units(keys: list, texts: list) -> list[list[pa.Array]]:
        lines, owner = [], []
        for i, text in enumerate(texts):
            own = paragraphs_of(text, min_words)
            lines += own
            owner += [i] * len(own)
        if not lines:
            return []
        found = list(hashed_rows(pa.array(lines, pa.string()), lower=True))
        hashes = np.concatenate([h for _, h, _ in found])
        bounds = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(e) for _, _, e in found]))])
        owner = np.array(owner)
        # A text's words are those of its paragraphs one after another.
        first = np.searchsorted(owner, np.arange(len(texts) + 1))
        begin = bounds[first]
        doc = pa.array([keys[i] for i in owner], pa.int64())
        place, count = bounds[:-1] - begin[owner], np.diff(bounds)
        one = [doc, pa.array(place), pa.array(count), *paragraphs(*sets_of(hashes, bounds, size)), pa.array(lines, pa.string())]
        starts = [pieces_of(hashes[a:b]) for a, b in zip(begin, begin[1:])]
        held = np.repeat(np.arange(len(texts)), list(map(len, starts)))
        at = np.concatenate(starts) + begin[held]
        d1 = grams(hashes, PIECE)[at] if len(at) else hashes[:0]
        d2 = grams(mixed(hashes * other), PIECE)[at] if len(at) else hashes[:0]
        two = [
            pa.array([keys[i] for i in held], pa.int64()), pa.array(at - begin[held]), pa.array(np.full(len(at), PIECE)),
            pa.nulls(len(at), pa.int64()), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)),
            pa.nulls(len(at), pa.list_(pa.int64())), pa.nulls(len(at), pa.list_(pa.int64())), pa.nulls(len(at), pa.string()),
        ]
        return [one, two]

    names = ["kind", "doc", "start", "n_words", "n", "d1", "d2", "sig", "bands", "text"]

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS):
                batch = whole.slice(at, TEXTS)
                for kind, arrays in enumerate(units(batch.column("key").to_pylist(), batch.column("text").to_pylist())):
                    number = pa.array(np.full(len(arrays[0]), kind, np.int32))
                    yield pa.RecordBatch.from_arrays([number, *arrays], names=names)

    schema = "kind int, doc long, start long, n_words long, n long, d1 long, d2 long, sig array<long>, bands array<long>, text string"
    # The number is final because the table is stored before anything reads it.
    return docs.mapInArrow(run, schema).select(F.monotonically_increasing_id().alias("key"), "*")


def _shared_bands(table: DataFrame) -> DataFrame:
    """``key, t`` of bands that several paragraphs of ``key, bands`` have; a bitmap of bounded size goes before the join."""
    spark = table.sparkSession
    every = table.select("key", F.explode("bands").alias("t"))
    many = every.groupBy("t").agg(F.min("key").alias("x"), F.max("key").alias("y")).filter("x != y").select("t")
    many = write_through(many, "bands")
    bits = min(FILTER_BITS, max(16, (16 * many.count()).bit_length()))
    found = (
        many.select(F.expr(f"shiftrightunsigned(t, {70 - bits})").alias("w"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(t, {64 - bits}) & 63 as int))").alias("m"))
        .groupBy("w").agg(F.bit_or("m").alias("m")).toArrow()
    )
    bitmap = np.zeros(1 << (bits - 6), np.int64)
    bitmap[found["w"].to_numpy()] = found["m"].to_numpy()
    shared = spark.sparkContext.broadcast(bitmap)

    def run(batches):
        for batch in batches:
            bands = batch.column("bands")
            t = bands.flatten().to_numpy()
            keys = np.repeat(batch.column("key").to_numpy(), bands.value_lengths().to_numpy())
            spot = (t.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
            inside = (shared.value[spot >> 6] >> (spot & 63)) & 1 == 1
            yield pa.RecordBatch.from_arrays([pa.array(keys[inside]), pa.array(t[inside])], names=["key", "t"])

    return table.mapInArrow(run, "key long, t long").join(many, "t")


def _repeated(units: DataFrame, cluster: str) -> DataFrame:
    """The units ``key, doc, start, n_words`` of every cluster of several, with the first one, which stays."""
    sizes = units.groupBy(cluster).agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("doc", "start", "key")).alias("kept"))
    # Stored, so that the join can split the many units of one cluster.
    sizes = write_through(sizes.filter("size > 1"), "sizes")
    return units.join(sizes, cluster).select(
        "doc", "start", "n_words", F.col("kept.doc").alias("cluster_doc"), F.col("kept.start").alias("cluster_start"),
        (F.col("kept.key") != F.col("key")).alias("removed"),
    )


def near_paragraphs(
    df: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, percent: int = PERCENT, size: int = SHINGLE
) -> DataFrame:
    """Paragraphs nearly equal to another one and pieces equal to another one, and which of them to remove.

    Columns ``kind`` (``paragraph`` or ``piece``), ``key``, ``start`` and ``n_words`` (in
    words of the text, from 0), ``cluster_doc`` and ``cluster_start`` (the first of its
    cluster by key and place, which stays) and ``removed``. Paragraphs are runs of lines
    of ``min_words`` words and more (see ``paragraphs_of``); their clusters are the
    components of links with ``100 * intersection >= percent * union`` over distinct runs
    of ``size`` words in lower case. Pieces are ``PIECE`` words that begin at places their
    words choose (see ``pieces_of``), in paragraphs or over their ends; equal ones are a
    cluster. Texts of fewer than ``min_words`` words, null and empty ones have neither.
    Units are compared in one text and in several; rows that repeat a key have units of
    their own. A null key stays null and comes first. Other columns are not read; an
    empty table gives an empty result.
    """
    spark = df.sparkSession
    docs = df.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    bands, rows = tune(percent / 100, RECALL)
    every, path = _units(docs, min_words, bands, rows, size), fresh_path(spark, "units")
    every.write.partitionBy("kind").parquet(path)
    stored = spark.read.schema(every.schema).parquet(path)
    table = stored.filter("kind = 0")
    features = table.select("key", "n", "sig")
    texts = table.select("key", "text")
    # Stored, so that the join can split the many rows of a very common paragraph.
    classes = table.groupBy("d1", "d2").agg(F.min("key").alias("rep"), F.count(F.lit(1)).alias("size"))
    classes = write_through(classes.filter("size > 1").drop("size"), "classes")
    members = table.select("key", "d1", "d2").join(classes, ["d1", "d2"], "left")
    members = write_through(members.select("key", F.coalesce("rep", "key").alias("rep")), "members")
    # One of equal paragraphs goes on; two unlike sets need at least so many shingles to be near.
    single = members.filter("key = rep").select("key")
    able = table.filter(F.col("n") * (100 - percent) >= percent).select("key", "bands").join(single, "key", "left_semi")
    shared = write_through(_shared_bands(write_through(able, "bands")), "postings")
    first = F.min(F.struct(F.xxhash64("key").alias("h"), F.col("key").alias("k")))["k"]
    pivots = shared.groupBy("t").agg(F.count(F.lit(1)).alias("size"), first.alias("pivot")).filter("size > 1")
    pivots = write_through(pivots, "pivots")
    stars = ordered(shared.join(pivots, "t"), "key", "pivot")
    near = write_through(verified(bounded(stars, features, percent), texts, size, percent), "links")
    known = connected_components(near)
    # Buckets that are still in several components: all that the pivot did not decide.
    apart = (
        shared.join(pivots.filter("size > 2").select("t"), "t")
        .join(known.withColumnRenamed("node", "key"), "key", "left")
        .withColumn("component", F.coalesce("component", "key"))
    )
    mixed_up = (
        apart.groupBy("t")
        .agg(F.count(F.lit(1)).alias("size"), F.min("component").alias("x"), F.max("component").alias("y"))
        .filter("x != y")
        .select("t", "size")
    )
    far = write_through(block_links(apart.join(mixed_up, "t"), features, texts, size, percent), "links")
    found = connected_components(near.unionByName(far)).withColumnRenamed("node", "rep")
    cluster = members.join(found, "rep", "left").select("key", F.coalesce("component", "rep").alias("cluster"))
    unit = ["key", "doc", "start", "n_words"]
    placed = write_through(table.select(*unit).join(cluster, "key"), "clusters")
    pieces = stored.filter("kind = 1").select(*unit, F.struct("d1", "d2").alias("cluster"))
    out = _repeated(placed, "cluster").withColumn("kind", F.lit("paragraph"))
    out = out.unionByName(_repeated(pieces, "cluster").withColumn("kind", F.lit("piece")))
    return out.select("kind", F.col("doc").alias(key), "start", "n_words", "cluster_doc", "cluster_start", "removed")
