"""Remove long repeated passages by compacting the de Bruijn graph of word k-mers.

The edges of the graph are all windows of k consecutive words. Windows that follow each other
in a document and share their minimizer (the least hash of their m-word runs) form a path that
is kept compacted from the start: one row with the digest of its words, its source coordinate
and its length. Equal windows share their minimizer, so

* paths whose minimizer occurs once in the corpus hold no repeated edge and are left out;
* paths found again under the same minimizer are repeated as a whole;
* where different paths meet under one minimizer the graph branches there; those alone are
  taken apart into edges, and the edges are joined on (minimizer, digest).

The repeated edges are then mapped back to their source coordinates, joined to spans, and cut
from the texts. An edge counts as repeated only if the minimizer and the digest of all its
words agree, which are independent hashes of 64 bits each.

A filter of fixed size, one bit for a minimizer, keeps most paths without partners out of the
shuffles; what passes it in vain costs work, not correctness.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from gneiss.llm.common import SALTS, row_key, salted_join, stored

#: Words of the runs whose least hash is a window's minimizer.
RUN = 8
#: Bits of the filter of repeated minimizers (8 MB).
FILTER_BITS = 1 << 26
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_STEP = 1 << 16


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


class Paths:
    """The compacted paths of one document's words: start, windows, minimizer and digest of each."""

    def __init__(self, words: list[bytes], k: int, digests: bool = True):
        n = len(words)
        digest = xxhash.xxh3_64_intdigest
        hashes = _mix(np.fromiter(map(digest, words), np.uint64, n))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * _powers(_BASE, n), out=sums[1:])
        back = _powers(_INVERSE, n)
        run = min(RUN, k)
        grams = _mix((sums[run:] - sums[:-run]) * back[: n - run + 1])
        per, windows = k - run + 1, n - k + 1
        at = np.empty(windows, np.int64)
        for lo in range(0, windows, _STEP):
            hi = min(windows, lo + _STEP)
            view = np.lib.stride_tricks.sliding_window_view(grams[lo : hi + per - 1], per)
            at[lo:hi] = view.argmin(axis=1) + np.arange(lo, hi)
        self.starts = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
        self.counts = np.diff(self.starts, append=windows)
        self.minimizers = grams[at[self.starts]]
        if digests:
            ends = self.starts + self.counts + k - 1
            self.digests = _mix((sums[ends] - sums[self.starts]) * back[self.starts] + self.counts.astype(np.uint64))
            self.edges = _mix((sums[k:] - sums[:-k]) * back[:windows]).view(np.int64)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("key"), F.col("text").cast("binary").alias("text"))


def _minimizer_counts(docs: DataFrame, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text"):
                words = (text.as_py() or b"").split()
                if len(words) >= k:
                    found = Paths(words, k, digests=False).minimizers.view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(found)], ["minimizer"])

    return docs.mapInArrow(run, "minimizer long").groupBy("minimizer").count()


def _filter(repeated: DataFrame) -> np.ndarray:
    """The fixed filter as 64-bit words; the driver gets those that aren't zero, 8 MB at most."""
    place = repeated.select(F.col("minimizer").bitwiseAND(F.lit(FILTER_BITS - 1)).alias("place"))
    words = place.select(F.shiftright("place", 6).cast("int").alias("word"), F.expr("shiftleft(1L, cast(place & 63 AS int))").alias("bit"))
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


PATH = "doc_id long, key long, start int, windows int, minimizer long, digest long, edges array<long>"


def _candidates(docs: DataFrame, k: int, wanted: np.ndarray) -> DataFrame:
    """The paths whose minimizer passes the filter, with the digests of their edges."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            for doc_id, key, text in zip(*batch.columns):
                words = (text.as_py() or b"").split()
                if len(words) < k:
                    continue
                paths = Paths(words, k)
                low = paths.minimizers & np.uint64(FILTER_BITS - 1)
                pick = np.flatnonzero((bits[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63))) & np.uint64(1))
                if len(pick):
                    counts, starts = paths.counts[pick], paths.starts[pick]
                    offsets = np.concatenate([[0], np.cumsum(counts)])
                    each = np.repeat(starts - offsets[:-1], counts) + np.arange(offsets[-1])
                    yield pa.RecordBatch.from_arrays([
                        pa.array([doc_id.as_py()] * len(pick), pa.int64()), pa.array(np.full(len(pick), key.as_py())),
                        pa.array(starts.astype(np.int32)), pa.array(counts.astype(np.int32)),
                        pa.array(paths.minimizers[pick].view(np.int64)), pa.array(paths.digests[pick].view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(paths.edges[each]))],
                        ["doc_id", "key", "start", "windows", "minimizer", "digest", "edges"])

    return docs.mapInArrow(run, PATH)


def repeated_spans(docs: DataFrame, k: int = 35) -> DataFrame:
    """doc_id, key, start and windows of runs of repeated windows; runs may touch or overlap."""
    texts = _texts(docs)
    repeated = _minimizer_counts(texts, k).where("count > 1")
    paths = stored(_candidates(texts, k, _filter(repeated)), "paths")

    own = F.xxhash64("key", "start")
    groups = paths.groupBy("minimizer", "digest").agg(F.count("*").alias("n"), F.min(own).alias("chosen"))
    branches = groups.groupBy("minimizer").agg(F.count("*").alias("branches"), F.sum("n").alias("paths"))
    # The minimizer at the end of a common passage has as many branches as there are documents with it.
    marked = salted_join(groups, branches.where("paths > 1").select("minimizer", "branches"), ["minimizer"], "digest")
    # A hot path is spread over salts.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salted = paths.withColumn("salt", F.pmod(F.col("key"), F.lit(SALTS)).cast("int"))
    known = salted.join(marked.withColumn("salt", salts), ["minimizer", "digest", "salt"])
    known = stored(known.where("n > 1 OR branches > 1").select(
        "doc_id", "key", "start", "windows", "minimizer", "n", "branches", (own == F.col("chosen")).alias("first"),
        F.monotonically_increasing_id().alias("path"),
        F.when(F.col("branches") > 1, F.col("edges")).alias("edges")), "known")

    whole = known.where("n > 1").select("doc_id", "key", "start", "windows")
    branching = known.where("branches > 1")
    edges = branching.where("first").select("minimizer", "n", F.explode("edges").alias("edge"))
    again = edges.groupBy("minimizer", "edge").agg(F.sum("n").alias("n")).where("n > 1").select("minimizer", "edge")
    # Only the number of a path goes with its edges; its coordinates follow for the edges that repeat.
    single = branching.where("n = 1").select("path", "minimizer", F.posexplode("edges").alias("i", "edge"))
    single = single.withColumn("salt", F.pmod(F.col("path"), F.lit(SALTS)).cast("int"))
    parts = single.join(again.withColumn("salt", salts), ["minimizer", "edge", "salt"]).select("path", "i")
    parts = parts.join(branching.where("n = 1").select("path", "doc_id", "key", "start"), "path")
    return whole.union(parts.select("doc_id", "key", F.col("start") + F.col("i"), F.lit(1)))


def substring_dedup(docs: DataFrame, k: int = 35) -> DataFrame:
    """Per document row: doc_id, n_words, n_removed and kept, the words that stay joined by one space.

    A word goes if a window of k consecutive words covers it whose words start anywhere else
    too, in the same document or another; windows are judged on the input. Words are what ASCII
    white space separates. A null or empty text has no words and an empty ``kept``; texts of
    fewer than k words stay whole. Rows with null ids count like others; repeated rows repeat
    each other. An empty table gives no rows.
    """
    spans = repeated_spans(docs, k).groupBy("doc_id", "key").agg(F.collect_list(F.struct("start", "windows")).alias("spans"))
    texts, found = _texts(docs).alias("t"), spans.alias("s")
    rows = texts.join(found, F.col("t.key").eqNullSafe(F.col("s.key")) & F.col("t.doc_id").eqNullSafe(F.col("s.doc_id")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, removed, kept = [], [], []
            for text, own in zip(batch.column("text"), batch.column("spans")):
                words = (text.as_py() or b"").split()
                totals.append(len(words))
                if own.is_valid:
                    bounds = np.zeros(len(words) + 1, np.int64)
                    span = own.values
                    starts, windows = span.field("start").to_numpy(), span.field("windows").to_numpy()
                    np.add.at(bounds, starts, 1)
                    np.add.at(bounds, starts + windows + k - 1, -1)
                    stays = np.cumsum(bounds)[:-1] == 0
                    words = [words[i] for i in np.flatnonzero(stays)]
                removed.append(totals[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())],
                ["doc_id", "n_words", "n_removed", "kept"])

    out = rows.select("t.doc_id", "t.text", "s.spans").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept binary")
    return out.withColumn("kept", F.col("kept").cast("string"))
