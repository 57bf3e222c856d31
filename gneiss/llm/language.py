"""Language identification by interpolated Kneser-Ney models of characters.

A text becomes a sequence of 16-bit letters: lower case, every run of other characters a space. Up to four
letters pack into a 64-bit number, the hash of an n-gram; it is exact for the basic multilingual plane. n-grams
are counted over all documents that may be learned from, and their probabilities derived by Spark. A model is a
pair of sorted arrays for each language and order: hashes with log-probabilities, hashes of contexts with
log-weights of the shorter order. The language of the lowest cross-entropy a letter wins.

How sure that is, is read from documents kept out of the counts: the share of right answers rises with the margin of
the evidence (pool adjacent violators over its bins); a document below a threshold is called rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gneiss.llm.common import stored

ORDER = 4
#: Letters looked at in one go.
CHUNK = 1 << 21
#: n-grams a task holds before it hands its counts on.
HELD = 1 << 22
#: Entries of a model that one pass sends to every worker (12 bytes each); larger models take several passes.
PASS_ENTRIES = 8_000_000
#: Bins of the evidence's margin, four to a doubling of nats.
BINS = 96

SCORED = "doc_id long, lang string, calibrates boolean, n_letters long, n_signs long, sums array<double>"


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For every code point its 16-bit letter, a space if it is none. Letters beyond 16 bits share the private-use area."""
    table = np.full(0x110000, 32, np.uint16)
    for i in range(0x110000):
        sign = chr(i)
        if sign.isalpha():
            low = sign.lower()
            code = ord(low) if len(low) == 1 else i
            table[i] = code if code < 0x10000 else 0xE000 + code % 0x1900
    return table


def signs(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the n-grams of the longest order that end at each sign of the texts; each text's signs and letters.

    A text stands between spaces, so that a word's first letters are told from later ones. One without letters has no signs.
    """
    points = [np.frombuffer((t or "").encode("utf-32-le", "surrogatepass"), "<u4") for t in texts]
    size = np.array([len(p) for p in points], np.int64)
    # ORDER - 1 spaces before a text and one behind it.
    width = size + ORDER
    start = np.cumsum(width) - width
    line = np.full(int(width.sum()), 32, np.uint16)
    body = np.arange(int(size.sum())) + np.repeat(start + ORDER - 1 - (np.cumsum(size) - size), size)
    line[body] = letters()[np.concatenate(points)] if points else 0
    text = np.repeat(np.arange(len(texts)), width)
    is_letter = line != 32
    n_letters = np.bincount(text, weights=is_letter, minlength=len(texts)).astype(np.int64)
    # A space behind a space goes, but for those that begin a text; texts without letters go.
    place = np.arange(len(line)) - np.repeat(start, width)
    keep = is_letter | (place < ORDER - 1)
    keep[1:] |= is_letter[:-1]
    keep &= n_letters[text] > 0
    line, text, place = line[keep].astype(np.uint64), text[keep], place[keep]
    gram = line.copy()
    for k in range(1, ORDER):
        gram[k:] |= line[:-k] << np.uint64(16 * k)
    inner = place >= ORDER - 1
    return gram[inner].view(np.int64), np.bincount(text[inner], minlength=len(texts)), n_letters


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[dict], list]]:
    """Rows without their texts, and the texts, of about CHUNK characters."""
    rows, texts, held = [], [], 0
    for batch in batches:
        for row, text in zip(batch.drop_columns(["text"]).to_pylist(), batch.column("text").to_pylist()):
            rows.append(row)
            texts.append(text)
            held += len(text or "")
            if held >= CHUNK:
                yield rows, texts
                rows, texts, held = [], [], 0
    if rows:
        yield rows, texts


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n): the n-grams of a task's documents of each language."""
    sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, (grams, n) in sums.items():
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(grams), pa.string()), "gram": grams, "n": n})
        sums.clear()

    for rows, texts in _chunks(batches):
        of: dict[str, list] = {}
        for row, text in zip(rows, texts):
            of.setdefault(row["lang"], []).append(text)
        for lang, own in of.items():
            grams, n = np.unique(signs(own)[0], return_counts=True)
            before = sums.get(lang, (np.empty(0, np.int64), np.empty(0, np.int64)))
            both, back = np.unique(np.concatenate([before[0], grams]), return_inverse=True)
            sums[lang] = both, np.bincount(back, np.concatenate([before[1], n]), len(both)).astype(np.int64)
        if sum(len(g) for g, _ in sums.values()) > HELD:
            yield from out()
    yield from out()


def kneser_ney(counts: DataFrame) -> DataFrame:
    """(lang, size, gram, logp, is_context) of all orders from (lang, gram, n) of the longest.

    Shorter n-grams count the letters that come before them. A discount for each order and language, from the
    n-grams counted once and twice, goes to the shorter order in proportion to the letters seen behind a context;
    behind the shortest all 65,536 letters are alike. ``is_context`` marks the logarithm of a context's weight.
    """
    orders = {ORDER: counts}
    for size in range(ORDER - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND(F.lit((1 << 16 * size) - 1))
        orders[size] = orders[size + 1].groupBy("lang", suffix.alias("gram")).agg(F.count("*").alias("n"))
    out, below = None, None
    for size in range(1, ORDER + 1):
        rows = orders[size].withColumn("context", F.shiftrightunsigned("gram", 16))
        ones, twos = F.sum((F.col("n") == 1).cast("double")), F.sum((F.col("n") == 2).cast("double"))
        # Half a count each keeps the discount inside 0 and 1 for the smallest tables.
        discounts = rows.groupBy("lang").agg(((ones + 0.5) / (ones + 2 * twos + 1)).alias("discount"))
        contexts = rows.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).join(F.broadcast(discounts), "lang")
        contexts = stored(contexts.withColumn("weight", F.col("discount") * F.col("kinds") / F.col("total")), "contexts")
        known = rows.join(contexts, ["lang", "context"])
        own = (F.col("n") - F.col("discount")) / F.col("total")
        if below is None:
            known = known.withColumn("p", own + F.col("weight") / 65536)
        else:
            suffix = F.col("gram").bitwiseAND(F.lit((1 << 16 * (size - 1)) - 1))
            shorter = below.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("shorter"))
            known = known.withColumn("suffix", suffix).join(shorter, ["lang", "suffix"]).withColumn("p", own + F.col("weight") * F.col("shorter"))
        below = stored(known.select("lang", "gram", "p"), f"order{size}")
        grams = below.select("lang", F.lit(size).alias("size"), "gram", F.log("p").cast("float").alias("logp"), F.lit(False).alias("is_context"))
        weights = contexts.select("lang", F.lit(size).alias("size"), F.col("context").alias("gram"), F.log("weight").cast("float").alias("logp"), F.lit(True).alias("is_context"))
        out = grams.union(weights) if out is None else out.union(grams).union(weights)
    return out


class Model:
    """Sorted hash arrays of one language."""

    def __init__(self, table: pa.Table):
        self.parts = {}
        size, context = table.column("size").to_numpy(), table.column("is_context").to_numpy(zero_copy_only=False)
        gram, logp = table.column("gram").to_numpy(), table.column("logp").to_numpy()
        for k in range(1, ORDER + 1):
            for is_context in (False, True):
                own = (size == k) & (context == is_context)
                order = np.argsort(gram[own])
                self.parts[k, is_context] = gram[own][order], logp[own][order].astype(float)

    def _look(self, part: tuple, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are there, and their values."""
        hashes, values = self.parts[part]
        if not len(hashes):
            return np.zeros(len(keys), bool), np.zeros(len(keys))
        at = np.minimum(np.searchsorted(hashes, keys), len(hashes) - 1)
        return hashes[at] == keys, values[at]

    def logp(self, grams: np.ndarray) -> np.ndarray:
        """The log-probability of the last letter of each n-gram behind the letters before it."""
        out, open_, keys = np.zeros(len(grams)), np.arange(len(grams)), grams.view(np.uint64)
        for size in range(ORDER, 0, -1):
            own = keys[open_] & np.uint64((1 << 16 * size) - 1)
            found, value = self._look((size, False), own.view(np.int64))
            out[open_[found]] += value[found]
            open_, own = open_[~found], own[~found]
            weighted, weight = self._look((size, True), (own >> np.uint64(16)).view(np.int64))
            out[open_[weighted]] += weight[weighted]
        out[open_] -= np.log(65536)
        return out


def _scores(batches: Iterator[pa.RecordBatch], models: list[Model], shard: int, shards: int) -> Iterator[pa.RecordBatch]:
    """Rows with the log-likelihoods added that this shard of the models knows, one for each language."""
    for rows, texts in _chunks(batches):
        grams, per_text, n_letters = signs(texts)
        if shards > 1:
            mine = (grams.view(np.uint64) >> np.uint64(16) & np.uint64(0xFFFF)) % np.uint64(shards) == shard
        else:
            mine = np.ones(len(grams), bool)
        text = np.repeat(np.arange(len(texts)), per_text)[mine]
        kinds, back = np.unique(grams[mine], return_inverse=True)
        sums = np.array([np.bincount(text, m.logp(kinds)[back], len(texts)) for m in models]).reshape(len(models), len(texts)).T
        for row, n, k, own in zip(rows, n_letters.tolist(), per_text.tolist(), sums.tolist()):
            row["n_letters"], row["n_signs"] = n, k
            row["sums"] = [a + b for a, b in zip(row["sums"], own)] if row.get("sums") else own
        fields = [("doc_id", pa.int64()), ("lang", pa.string()), ("calibrates", pa.bool_()), ("n_letters", pa.int64()), ("n_signs", pa.int64()), ("sums", pa.list_(pa.float64()))]
        columns = {name: pa.array([r[name] for r in rows], kind) for name, kind in fields}
        yield pa.RecordBatch.from_pydict(columns | ({"text": pa.array(texts, pa.string())} if shards > 1 else {}))


def cross_entropies(docs: DataFrame, model: DataFrame, langs: list[str], pass_entries: int = PASS_ENTRIES) -> DataFrame:
    """Rows (doc_id, text, lang, calibrates) with their letters, signs and the sum of log-probabilities by each language.

    Workers get the models as a broadcast of at most about ``pass_entries`` entries. If there are more, the
    models are cut by the letter before the last, which all n-grams and contexts of a sign share, and the
    texts are passed once for each shard; results are the same, but for the rounding of sums.
    """
    context = docs.sparkSession.sparkContext
    shards = -(-model.count() // pass_entries)
    before = F.when(F.col("is_context"), F.col("gram")).otherwise(F.shiftrightunsigned("gram", 16)).bitwiseAND(F.lit(0xFFFF))
    # Single letters and the empty context are in all shards.
    short = (F.col("size") == 1)
    rows = docs
    for shard in range(max(1, shards)):
        part = model if shards <= 1 else model.where(short | (before % shards == shard))
        table = part.toArrow()
        of = table.column("lang").to_numpy(zero_copy_only=False)
        sent = context.broadcast([Model(table.filter(pa.array(of == lang))) for lang in langs])

        def run(batches: Iterator[pa.RecordBatch], sent=sent, shard=shard) -> Iterator[pa.RecordBatch]:
            return _scores(batches, sent.value, shard, shards)

        more = ", text string" if shards > 1 else ""
        rows = stored(rows.mapInArrow(run, SCORED + more), "scored")
    return rows.drop("text")


def rising(right: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The share of right answers of each bin, never falling (pool adjacent violators); half an answer of either kind is added
    to each pool. A bin without documents has the share of the one below, the first ones that of the first pool."""
    pools: list[list[float]] = []
    for at in np.flatnonzero(total):
        pools.append([right[at], total[at], at])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            r, n, _ = pools.pop()
            pools[-1][:2] = pools[-1][0] + r, pools[-1][1] + n
    shares = np.full(len(total), 0.5)
    for k, (r, n, at) in enumerate(pools):
        shares[at if k else 0:] = (r + 0.5) / (n + 1)
    return np.maximum.accumulate(shares)


def remainder() -> Column:
    """What decides whether a document is learned from, calibrated with or held out."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4


def identify(docs: DataFrame, learn: Column, calibrate: Column, reject_below: float = 0.5, pass_entries: int = PASS_ENTRIES) -> DataFrame:
    """Per document: doc_id, lang_pred, score, rejected, cross_entropy (nats a sign) and n_letters.

    Models are counted over the documents where ``learn`` holds and ``lang`` is not null, scores calibrated over
    those where ``calibrate`` does. ``score`` is the calibrated chance that the language is right, ``rejected`` says
    that it is below ``reject_below``. A null text or one without letters is ``und``, with score 0, as are all if there is
    nothing to learn from. Of equal cross-entropies the language that comes first by code point wins. Null ids and
    repeated rows are documents like others; very long texts are read whole; other columns are ignored.
    """
    doc_id, lang, text = F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("text").cast("string")
    told = F.col("lang").isNotNull() & F.col("text").isNotNull()
    counted = docs.where(told & learn).select(lang.alias("lang"), text.alias("text")).mapInArrow(_counted, "lang string, gram long, n long")
    counts = stored(counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "counts")
    langs = sorted(r.lang for r in counts.select("lang").distinct().collect())
    model = stored(kneser_ney(counts), "model")
    rows = docs.select(doc_id.alias("doc_id"), text.alias("text"), lang.alias("lang"), F.coalesce(told & calibrate, F.lit(False)).alias("calibrates"),
                       F.array().cast("array<double>").alias("sums"))
    rows = cross_entropies(rows, model, langs, pass_entries)

    names = F.array(*[F.lit(x) for x in langs]).cast("array<string>")
    best = F.array_max("sums")
    second = F.array_max(F.filter("sums", lambda x: x < best))
    sure = (F.col("n_letters") > 0) & (F.size("sums") > 0)
    rows = rows.withColumns({"best": best, "at": F.array_position("sums", best)})
    ties = F.size(F.filter("sums", lambda x: x == F.col("best"))) > 1
    margin = F.when(ties, 0.0).otherwise(F.coalesce(F.col("best") - second, F.lit(1e9)))
    rows = rows.withColumns({
        "lang_pred": F.when(sure, F.get(names, (F.col("at") - 1).cast("int"))).otherwise("und"),
        "bin": F.when(sure, F.least(F.floor(4 * F.log2(1 + margin)), F.lit(BINS - 1)).cast("int"))})
    seen = rows.where(F.col("calibrates") & F.col("bin").isNotNull()).groupBy("bin").agg(F.count("*").alias("n"), F.sum((F.col("lang") == F.col("lang_pred")).cast("long")).alias("right"))
    right, total = np.zeros(BINS), np.zeros(BINS)
    for r in seen.collect():  # at most BINS rows
        right[r.bin], total[r.bin] = r.right, r.n
    shares = F.array(*[F.lit(float(x)) for x in rising(right, total)])
    score = F.coalesce(F.get(shares, F.col("bin")), F.lit(0.0))
    return rows.select("doc_id", "lang_pred", score.alias("score"), (score < reject_below).alias("rejected"),
                       F.when(sure, -F.col("best") / F.col("n_signs")).alias("cross_entropy"), "n_letters")
