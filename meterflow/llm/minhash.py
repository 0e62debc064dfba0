"""Near-duplicate documents by one-permutation hashing.

1. One pass over the texts hashes every shingle once. The top bits of a hash name one of
   ``BINS`` bins, the rest is its value; a bin keeps its smallest. An empty bin borrows from
   the bin that a fixed random sequence of its own meets first among the filled ones (optimal densification),
   so that any bin of two documents agrees with the probability of their similarity. ``ROWS`` bins make a band.
2. Documents with the same set of shingles are one representative, the smallest id.
3. Representatives that share a band are a bucket. A round picks centers in every bucket and pairs
   the other members with them only (a star), confirms each pair on the full
   sets and merges components. A center that has met all members of its bucket leaves it; a bucket closes when
   all who are left lie in one component. Members without any link are the first to be centers. The number of centers per bucket grows
   fourfold from round to round, so the rounds grow with the logarithm of a bucket's size, and no pair that the bands propose is
   lost: it is confirmed, refuted, or lies in one component already. Counts of a set's hashes by their top bits bound the
   overlap of two sets from above, which refutes most pairs before their sets are fetched.

At similarity 0.8 a pair is missed by all 25 bands of 5 rows with a probability of 5e-5.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterflow.llm.components import components
from meterflow.llm.shared import small_batches, stored
from meterflow.llm.textarrays import chunks, mix, seeded, words_of

BIN_BITS = 7
BINS = 1 << BIN_BITS
ROWS = 5
BANDS = BINS // ROWS
MORE_CENTERS = 4
MOST_COUNT = 127


@lru_cache(1)
def detours() -> np.ndarray:
    """For each bin the other bins in the order in which it looks for a value."""
    rng = np.random.Generator(np.random.PCG64(42))
    return np.array([rng.permutation(BINS) for _ in range(BINS)])


def signature(hashes: np.ndarray) -> np.ndarray:
    """Values of all bins for a sorted set of hashes that is not empty."""
    bins = (hashes >> np.uint64(64 - BIN_BITS)).astype(np.intp)
    firsts = np.flatnonzero(np.diff(bins, prepend=-1))
    filled = np.zeros(BINS, bool)
    filled[bins[firsts]] = True
    out = np.zeros(BINS, np.uint64)
    out[bins[firsts]] = hashes[firsts]
    empty = np.flatnonzero(~filled)
    if len(empty):
        order = detours()[empty]
        out[empty] = out[order[np.arange(len(empty)), filled[order].argmax(axis=1)]]
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    """A hash of each band of a signature."""
    factors = seeded(23, ROWS) | np.uint64(1)
    bands = (mix(values[: BANDS * ROWS].reshape(BANDS, ROWS)) * factors).sum(axis=1, dtype=np.uint64)
    return mix(bands + seeded(29, BANDS))


def shingle_sets(words, n: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its ``n``-word shingles; a shorter text that has words is one shingle."""
    grams, at = words.grams(n)
    bounds = np.searchsorted(at, words.firsts)
    factors = seeded(13, n) | np.uint64(1)
    for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
        if b > a:
            yield np.unique(grams[a:b])
        elif (own := words.hashes[words.firsts[i] : words.firsts[i + 1]]).size:
            yield mix((own * factors[: len(own)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(own)))
        else:
            yield own


def _sketch(n: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offsets in chunks(batch, 1):
            sizes, keys, bands = [], [], []
            for hashes in shingle_sets(words_of(data, offsets), n):
                sizes.append(len(hashes))
                keys.append(_set_keys(hashes))
                bands.append(band_keys(signature(hashes)).view(np.int64) if len(hashes) else np.empty(0, np.int64))
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column(0),
                "n_shingles": pa.array(sizes, pa.int64()),
                "set_key": pa.array(keys, pa.binary()),
                "bands": _lists(bands),
            })


def sketches(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, n_shingles, set_key (a digest of the set, missing if empty), bands, for each row of ``docs``."""
    small_batches(docs.sparkSession)
    schema = "doc_id bigint, n_shingles bigint, set_key binary, bands array<bigint>"
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return texts.mapInArrow(lambda batches: _sketch(n, batches), schema)


def _set_keys(hashes: np.ndarray) -> bytes | None:
    """A 128-bit digest of a set of hashes; none for the empty set."""
    if not len(hashes):
        return None
    one = int(mix(hashes).sum(dtype=np.uint64))
    two = int(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
    return one.to_bytes(8) + two.to_bytes(8)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *arrays])))


def _counts(hashes: np.ndarray) -> list[int] | None:
    """How many hashes share each top byte's first seven bits; none if a count does not fit."""
    counts = np.bincount((hashes >> np.uint64(64 - BIN_BITS)).astype(np.intp), minlength=BINS)
    return counts.tolist() if counts.max() <= MOST_COUNT else None


def sets_of(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, the whole set of shingle hashes and their counts by bin, of the rows of ``docs`` (doc_id, text, set_key) whose set has that key."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in chunks(batch, 1):
                sets = list(shingle_sets(words_of(data, offsets), n))
                fits = [i for i, key in enumerate(part.column(2).to_pylist()) if key == _set_keys(sets[i])]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column(0).take(pa.array(fits, pa.int64())),
                    "shingles": _lists([sets[i].view(np.int64) for i in fits]),
                    "counts": pa.array([_counts(sets[i]) for i in fits], pa.list_(pa.int8())),
                })

    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text", "set_key").mapInArrow(whole, "doc_id bigint, shingles array<bigint>, counts array<tinyint>")


def _star_pairs(members: DataFrame, centers: int) -> DataFrame:
    """(bucket, center, center_size, center_component): the first ``centers`` members of each bucket."""
    first = Window.partitionBy("bucket").orderBy("linked", "rep")
    ranked = members.select("bucket", "rep", "size", "component", "linked", "counts", F.row_number().over(first).alias("place"))
    return ranked.where(F.col("place") <= centers).select(
        "bucket",
        F.col("rep").alias("center"),
        F.col("size").alias("center_size"),
        F.col("component").alias("center_component"),
        F.col("counts").alias("center_counts"),
    )


def _may_link(own: str, other: str, sizes: str, percent: int) -> str:
    """Whether two sets can be that similar: they share no more hashes than the smaller count of each bin. True if counts are missing."""
    most = f"aggregate(zip_with({own}, {other}, (x, y) -> least(x, y)), 0, (a, x) -> a + x)"
    return f"coalesce({100 + percent} * {most} >= {percent} * ({sizes}), true)"


def links(docs: DataFrame, sketched: DataFrame, reps: DataFrame, n: int, percent: int) -> DataFrame:
    """Confirmed (a, b) links between representatives that join all who are linked, though not every link inside a component."""
    spark = docs.sparkSession
    # one row for each representative: a join on both columns, then none that is repeated
    chosen = reps.groupBy(F.col("rep").alias("doc_id")).agg(F.min("set_key").alias("set_key"))
    banded = sketched.join(chosen, ["doc_id", "set_key"], "left_semi").dropDuplicates(["doc_id", "set_key"])
    members = banded.select(F.explode("bands").alias("bucket"), F.col("doc_id").alias("rep"), F.col("n_shingles").alias("size"))
    shared = members.groupBy("bucket").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high").select("bucket")
    members = stored(members.join(shared, "bucket"), "buckets").select(
        "*", F.col("rep").alias("component"), F.lit(False).alias("linked"), F.lit(None).cast("array<tinyint>").alias("counts")
    )
    wanted = chosen.join(members.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    sets = stored(sets_of(texts.join(wanted, "doc_id").dropDuplicates(["doc_id", "text"]), n), "sets")
    confirmed = spark.createDataFrame([], "a bigint, b bigint")
    tested = spark.createDataFrame([], "rep bigint, center bigint")
    centers = 1
    while True:
        stars = stored(_star_pairs(members, centers), "centers")
        pairs = (
            members.join(stars, "bucket")
            .where("component <> center_component")
            .where(f"100 * least(size, center_size) >= {percent} * greatest(size, center_size)")
            .where(_may_link("counts", "center_counts", "size + center_size", percent))
            .select(F.least("rep", "center").alias("center"), F.greatest("rep", "center").alias("rep"), (F.col("size") + F.col("center_size")).alias("sizes"))
            .distinct()
        )
        pairs = stored(pairs.join(tested, ["rep", "center"], "left_anti"), "pairs")
        tested = tested.union(pairs.select("rep", "center"))
        counted = sets.select("doc_id", "counts")
        if centers == 1:
            likely = pairs.join(counted.select(F.col("doc_id").alias("rep"), F.col("counts").alias("own")), "rep").join(
                counted.select(F.col("doc_id").alias("center"), F.col("counts").alias("other")), "center"
            )
            pairs = stored(likely.where(_may_link("own", "other", "sizes", percent)).select("rep", "center", "sizes"), "likely")
        met = sets.join(pairs.select(F.col("center").alias("doc_id")).distinct(), "doc_id", "left_semi")
        both = (
            pairs.join(sets.select(F.col("doc_id").alias("rep"), F.col("shingles").alias("own")), "rep")
            .join(met.select(F.col("doc_id").alias("center"), F.col("shingles").alias("other")), "center")
            .withColumn("common", F.size(F.array_intersect("own", "other")))
            .where(f"100 * common >= {percent} * (sizes - common)")
        )
        found = stored(both.select(F.col("center").alias("a"), F.col("rep").alias("b")), "links")
        confirmed = confirmed.union(found)
        if not found.isEmpty():
            labels = components(confirmed).withColumnRenamed("node", "rep").withColumnRenamed("component", "label")
            members = (
                members.join(labels, "rep", "left")
                .withColumns({"component": F.coalesce("label", "component"), "linked": F.col("label").isNotNull()})
                .drop("label")
            )
        gone = stars.select("bucket", F.col("center").alias("rep"))
        members = members.join(gone, ["bucket", "rep"], "left_anti")
        open_ = members.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
        members = members.join(open_.select("bucket"), "bucket", "left_semi")
        if centers == 1:  # from now on the join within buckets refutes pairs by their counts
            members = members.drop("counts").join(counted.withColumnRenamed("doc_id", "rep"), "rep")
        members = stored(members, "buckets")
        if members.isEmpty():
            return confirmed
        centers *= MORE_CENTERS


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of ``docs`` (doc_id, text).

    Words are runs of bytes other than white space, with A to Z in lower case; a document's set holds its distinct ``n``-word
    shingles, or its whole sequence of words if that is shorter. Two documents are linked if
    100 * common >= percent * all shingles. component_id is the smallest doc_id reachable over links, kept tells
    whether it is the document's own. A missing or empty text, or one of white space, has an empty set and is linked with
    nothing. Repeated rows keep their number; rows that share a doc_id share its set's component. A missing doc_id
    is linked with nothing: its component_id is missing and it is kept. Other columns are not looked at.
    """
    sketched = stored(sketches(docs, n), "sketches")
    usable = sketched.where("set_key IS NOT NULL AND doc_id IS NOT NULL")
    reps = stored(usable.groupBy("set_key").agg(F.min("doc_id").alias("rep")), "reps")
    found = links(docs, usable, reps, n, percent)
    labels = components(found).withColumnRenamed("node", "rep")
    classes = reps.join(labels, "rep", "left").select("set_key", F.coalesce("component", "rep").alias("class_id"))
    return sketched.join(classes, "set_key", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("class_id", "doc_id"), F.lit(True)).alias("kept"),
    )


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), n=4)
