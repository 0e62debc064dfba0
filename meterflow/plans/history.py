"""The history that a snapshot needs, without reading the history.

All rules of change capture join snapshot and history on the session id. A snapshot is full, so nearly all its sessions were in the snapshot before, or are new. Three tables are kept
beside the history and committed with it:

* ``live``: all versions of the sessions of the last snapshot; as large as a snapshot, whatever the age of the history,
* ``sketches``: a Bloom filter over the ids of each batch of the history, some bits an id,
* ``history`` itself, to which batches are only ever added.

Ids of a snapshot that are not in ``live`` are new, or come back after they were away. The sketches tell in which batches they may be; only these are read. Batches
without a sketch (written before there were any, or put together since) are always read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterflow.schemas import SESSION_HISTORY
from meterflow.sources.versions import State, VersionedTables

ID = "acctuniqueid"
BUCKETS = 64
HASHES = 6
BITS_PER_ID = 16
LEAST_WORDS = 16
MOST_BROADCAST = 200_000
SKETCH = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("words", T.ArrayType(T.LongType()))])


def _hashed(ids: DataFrame) -> DataFrame:
    """Each id once, with its bucket and two hashes of 31 bits (so that sums of them are no overflow)."""
    wide = F.lit(1 << 31)
    return ids.where(F.col(ID).isNotNull()).select(ID).distinct().select(
        ID, F.pmod(F.xxhash64(ID), F.lit(BUCKETS)).cast("int").alias("bucket"),
        F.pmod(F.xxhash64(ID, F.lit(1)), wide).alias("h1"), F.pmod(F.xxhash64(ID, F.lit(2)), wide).bitwiseOR(F.lit(1)).alias("h2"),
    )


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the buckets of a partition; what a task holds is as large as what it returns."""
    words: dict[int, np.ndarray] = {}
    for batch in batches:
        bucket, h1, h2, n_words = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(4))
        for b in np.unique(bucket):
            own = bucket == b
            n = int(n_words[own][0])
            bits = words.setdefault(int(b), np.zeros(n, np.uint64))
            at = (h1[own, None] + np.arange(HASHES) * h2[own, None]).ravel() % (n * 64)
            np.bitwise_or.at(bits, at // 64, np.uint64(1) << (at % 64).astype(np.uint64))
    for b, bits in words.items():
        yield pa.RecordBatch.from_pydict({"bucket": pa.array([b], pa.int32()), "words": pa.array([bits.view(np.int64)], pa.list_(pa.int64()))})


def sketch(rows: DataFrame) -> DataFrame:
    """A Bloom filter for each bucket of the ids of ``rows``, as words of 64 bits."""
    ids = _hashed(rows)
    sizes = ids.groupBy("bucket").agg(F.greatest(F.lit(LEAST_WORDS), F.ceil(F.count(F.lit(1)) * BITS_PER_ID / F.lit(64))).cast("bigint").alias("n_words"))
    dealt = ids.join(F.broadcast(sizes), "bucket").select("bucket", "h1", "h2", "n_words").repartition("bucket")
    return dealt.mapInArrow(_bits, SKETCH)


def _hits(sketches: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, ``commit``) of the ids that a batch may hold by its sketch."""
    # each place by itself and not in a loop, so that the test is compiled and ends at the first bit that is not set
    places = [f"pmod(h1 + {k} * h2, cast(size(words) AS bigint) * 64)" for k in range(HASHES)]
    held = F.expr(" AND ".join(f"(shiftright(get(words, cast({p} div 64 AS int)), cast({p} % 64 AS int)) & 1L) = 1L" for p in places))
    right = sketches.withColumnRenamed("bucket", "_bucket")
    return _hashed(ids).join(right, (F.col("_bucket") == F.col("bucket")) & held).select(ID, "commit")


def batches_with(sketches: DataFrame, ids: DataFrame) -> list[str]:
    """The batches (``commit``) whose sketch may hold one of the ids. The driver gets names of batches."""
    return sorted(r["commit"] for r in _hits(sketches, ids).select("commit").distinct().collect())


def _ids(stage: DataFrame) -> DataFrame:
    return stage.where(F.col(ID).isNotNull()).select(ID).distinct()


def known_of(store: VersionedTables, stage: DataFrame, state: State) -> tuple[DataFrame, list[str]]:
    """``live`` with what older batches have of the snapshot's sessions: all their versions, and of sessions that have gone some; and the batches of the history that had to be read.

    Of batches with a sketch only ids that the sketch may hold are looked up, a few in a thousand of those that are new.
    """
    live = store.read("live", SESSION_HISTORY, state)
    parts = state.parts.get("history", [])
    if not parts:
        return live, []
    away = _ids(stage).join(live.select(ID).distinct(), ID, "left_anti")
    names = {p.partition("/")[0]: p for p in parts}
    sketched = {p.partition("/")[0] for p in state.parts.get("sketches", [])}
    sketches = store.read_with_commit("sketches", SKETCH, state)
    hits = _hits(sketches, away).distinct()
    found = hits.groupBy("commit").count().collect() if sketched else []
    held = sorted(names[f"commit={r['commit']}"] for r in found if f"commit={r['commit']}" in names)
    plain = [p for p in parts if p.partition("/")[0] not in sketched]
    # few ids go to the history, many and the history to each other
    some = hits.select(ID).distinct()
    some = F.broadcast(some) if sum(r["count"] for r in found) <= MOST_BROADCAST else some
    for wanted, ids in ((held, some), (plain, away)):
        if wanted:
            back = store.read_parts("history", SESSION_HISTORY, wanted).join(ids, ID, "left_semi").select(*SESSION_HISTORY.names)
            live = live.unionByName(back)
    return live, held + plain


def versions_of(store: VersionedTables, stage: DataFrame, state: State | None = None) -> tuple[DataFrame, list[str]]:
    """All versions that the history has of the snapshot's sessions, and the batches of the history that had to be read for them."""
    known, wanted = known_of(store, stage, state or store.state())
    return known.join(_ids(stage), ID, "left_semi").select(*SESSION_HISTORY.names), wanted


def next_live(known: DataFrame, delta: DataFrame, stage: DataFrame) -> DataFrame:
    """All versions of the sessions of the snapshot once its changes are added."""
    both = known.unionByName(delta.select(*SESSION_HISTORY.names))
    return both.join(_ids(stage), ID, "left_semi").select(*SESSION_HISTORY.names)
