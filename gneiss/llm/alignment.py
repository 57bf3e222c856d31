"""Align the tokens of two tokenizers by pointer jumping, and count linked id pairs over the corpus.

Every token points to the farthest-right token of the other tokenizer that overlaps it; the token
that ends where its partner ends points to itself. Successor doubling (``succ = succ[succ]``, for all
documents of a batch at once) leads every token to the last one of its group, which labels the group.

Counts of id pairs are corpus-wide, but no document is sent to them: documents lie in blocks, a block's
distinct pairs fetch their counts, and the block's documents, kept as compressed lists of pairs, meet
those. A block is a stretch of one task's documents with a bounded number of characters.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from gneiss.llm.common import stored
from gneiss.llm.packing import Encoder

#: Characters aligned at once, and characters of a block.
BATCH_CHARS, BLOCK_CHARS = 1 << 19, 1 << 24
#: Bits of a B id within a pair's code, and of a code.
B_BITS, CODE_BITS = 20, 40
#: Texts with such characters are encoded word by word, see ``packing.Encoder``.
ODD = re.compile("[^\x00-\u024f]")
#: Pairs spelled out at once.
PAIRS = 1 << 22

ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, block long")
COUNTED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class Tokenizers:
    """Ids of a text by both tokenizers, and the bytes of each id."""

    def __init__(self, a_file: str, a_ranks: str, a_pattern: str, b_file: str):
        from sentencepiece import SentencePieceProcessor

        self.words = Encoder(a_file, a_ranks, a_pattern)
        self.words.tokenizer.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b_file)
        signs = self._byte_signs()
        vocabulary = self.words.tokenizer.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(signs[c] for c in token) if all(c in signs for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)

    @staticmethod
    def _byte_signs() -> dict[str, int]:
        """The sign that stands for each byte in a byte-level vocabulary: itself if it prints, else the next from U+0100."""
        printing = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in printing]
        return {chr(b): b for b in printing} | {chr(0x100 + i): b for i, b in enumerate(rest)}

    def encode_a(self, text: str) -> np.ndarray:
        if not ODD.search(text):
            return np.array(self.words.ranked(text), np.int64)
        return np.frombuffer(self.words.encode(text), "<u4").astype(np.int64)

    def encode(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        """Both id arrays of each text; None if it is null or empty, or if a tokenizer changes its bytes."""
        full = [t for t in texts if t]
        b_ids = iter(self.b.encode(full, num_threads=1, out_type=int))
        for text in texts:
            if not text:
                yield None
                continue
            a, b, raw = self.encode_a(" " + text), next(b_ids), (" " + text).encode()
            same = b"".join(map(self.a_bytes.__getitem__, a.tolist())) == raw == b"".join(map(self.b_bytes.__getitem__, b))
            yield (a, np.array(b, np.int64)) if same else None


@lru_cache(maxsize=1)
def tokenizers(*files: str) -> Tokenizers:
    """One pair of tokenizers for each Python worker."""
    return Tokenizers(*files)


def labels(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every A and B token the B token that ends its group, by pointer jumping over byte ends."""
    n, b_own = len(a_end), np.arange(len(b_end))
    over_a, over_b = np.searchsorted(b_end, a_end), np.searchsorted(a_end, b_end)
    succ = np.concatenate([n + over_a, np.where(a_end[over_b] > b_end, over_b, n + b_own)])
    while True:
        further = succ[succ]
        if np.array_equal(further, succ):
            return succ[:n] - n, succ[n:] - n
        succ = further


def _spelled(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The decimal ids, each followed by its end sign, as one array of bytes, and the size of each."""
    digits = np.empty((len(ids), 8), np.uint8)
    rest = ids.copy()
    for k in range(6, -1, -1):
        digits[:, k] = rest % 10 + 48
        rest //= 10
    digits[:, 7] = ends
    size = np.ones(len(ids), np.int64)
    for k in range(1, 7):
        size += ids >= 10**k
    shown = np.arange(8) >= (7 - size)[:, None]
    return digits[shown], size + 1


def _pairs(doc: np.ndarray, group_a, ids_a, group_b, ids_b, n_groups: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document, code, links) of the distinct id pairs of each document, in order, some documents at a time."""
    a_keys, a_n = np.unique((group_a << np.int64(B_BITS)) | ids_a, return_counts=True)
    b_keys, b_n = np.unique((group_b << np.int64(B_BITS)) | ids_b, return_counts=True)
    mask = (1 << B_BITS) - 1
    ga, gb = a_keys >> B_BITS, b_keys >> B_BITS
    first = np.searchsorted(gb, np.arange(n_groups + 1))
    width = first[ga + 1] - first[ga]
    # Cut between documents so that about PAIRS pairs are spelled out at a time.
    a_doc, total = doc[ga], np.cumsum(width)
    lo = 0
    while lo < len(a_keys):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] - width[lo] + PAIRS, "right")))
        hi = int(np.searchsorted(a_doc, a_doc[hi - 1], "left")) if hi < len(a_keys) and a_doc[hi] == a_doc[hi - 1] else hi
        hi = hi if hi > lo else int(np.searchsorted(a_doc, a_doc[lo], "right"))
        w = width[lo:hi]
        a_at = np.repeat(np.arange(lo, hi), w)
        b_at = first[ga[a_at]] + np.arange(len(a_at)) - np.repeat(np.cumsum(w) - w, w)
        code = ((a_keys[a_at] & mask) << B_BITS) | (b_keys[b_at] & mask)
        key = (a_doc[a_at] << CODE_BITS) | code
        order = np.argsort(key)
        key, n = key[order], (a_n[a_at] * b_n[b_at])[order]
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        yield key[new] >> CODE_BITS, key[new] & ((1 << CODE_BITS) - 1), np.add.reduceat(n, new)
        lo = hi


def pack_pairs(codes: np.ndarray, links: np.ndarray) -> bytes:
    """Sorted codes as differences, and their links, byte plane by byte plane and compressed."""
    planes = [np.diff(codes, prepend=0), links]
    return zlib.compress(b"".join(x.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes() for x in planes), 1)


def unpack_pairs(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(2, 8, -1)
    steps, links = (np.ascontiguousarray(x.T).view("<u8").reshape(-1).astype(np.int64) for x in planes)
    return np.cumsum(steps), links


def align(tokens: list[tuple[np.ndarray, np.ndarray]], a_size: np.ndarray, b_size: np.ndarray) -> list[tuple]:
    """(n_a, n_b, n_groups, n_links, groups, packed pairs) of each document; groups are spelled as bytes."""
    a, b = (np.concatenate(x) for x in zip(*tokens))
    n_a, n_b = (np.array([len(x) for x in side]) for side in zip(*tokens))
    group_a, group_b = labels(np.cumsum(a_size[a]), np.cumsum(b_size[b]))
    last, group_b = np.unique(group_b, return_inverse=True)
    group_a = np.searchsorted(last, group_a)
    doc = np.repeat(np.arange(len(tokens)), n_b)[last]
    in_a, in_b = np.bincount(group_a), np.bincount(group_b)
    n_groups = np.bincount(doc, minlength=len(tokens))
    n_links = np.bincount(doc, weights=in_a * in_b, minlength=len(tokens)).astype(np.int64)
    # A tokens of a group come before its B tokens; the sign after a token tells what follows.
    order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
    ends = np.full(len(a) + len(b), ord(","), np.uint8)
    ends[np.cumsum(in_a) - 1], ends[len(a) + np.cumsum(in_b) - 1] = ord("|"), ord(";")
    spelled, size = _spelled(np.concatenate([a, b])[order], ends[order])
    cuts = np.cumsum(size)[np.cumsum(n_a + n_b) - 1]
    packed = [b""] * len(tokens)
    for d, code, n in _pairs(doc, group_a, a, group_b, b, len(last)):
        at = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
        for i, j in zip(at, [*at[1:], len(d)]):
            packed[d[i]] = pack_pairs(code[i:j], n[i:j])
    return [(int(x), int(y), int(g), int(k), spelled[i:j - 1].tobytes(), p)
            for x, y, g, k, i, j, p in zip(n_a, n_b, n_groups, n_links, [0, *cuts[:-1]], cuts, packed)]


def aligned(docs: DataFrame, files: tuple[str, str, str, str]) -> DataFrame:
    """Per document its alignment, the compressed list of its linked id pairs, and its block."""

    def rows(ids: list, texts: list, block: int) -> pa.RecordBatch:
        own = tokenizers(*files)
        tokens = list(own.encode(texts))
        found = iter(align([t for t in tokens if t], own.a_size, own.b_size) if any(tokens) else ())
        full = [next(found) if t else (0, 0, 0, 0, None, None) for t in tokens]
        a, b, g, k, groups, packed = zip(*full)
        digests = ["" if x is None else hashlib.sha256(x).hexdigest() for x in groups]
        kinds = [pa.int64()] * 5 + [pa.string(), pa.binary(), pa.int64()]
        columns = [ids, a, b, g, k, digests, packed, [block] * len(ids)]
        names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "block"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, of_block, ids, texts, chars = TaskContext.get().partitionId() << 32, 0, [], [], 0
        for batch in batches:
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids.append(i)
                texts.append(text)
                chars += len(text or "") + 1
                if chars >= BATCH_CHARS:
                    yield rows(ids, texts, block)
                    of_block += chars
                    ids, texts, chars = [], [], 0
                    if of_block >= BLOCK_CHARS:
                        block, of_block = block + 1, 0
        if ids:
            yield rows(ids, texts, block)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, ALIGNED)


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, code, n): the distinct pairs of each block and in how many of its documents they stand."""

    def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
        codes, back = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
        return codes, np.bincount(back, np.concatenate([n for _, n in parts])).astype(np.int64)

    def out(block: int, parts: list) -> pa.RecordBatch:
        codes, n = merged(parts)
        return pa.RecordBatch.from_pydict({"block": np.full(len(codes), block), "code": codes, "n": n})

    at, parts, held = None, [], 0
    for batch in batches:
        for block, packed in zip(batch.column("block").to_pylist(), batch.column("pairs").to_pylist()):
            if block != at and parts:
                yield out(at, parts)
                parts, held = [], 0
            at = block
            codes = unpack_pairs(packed)[0]
            parts.append((codes, np.ones(len(codes), np.int64)))
            held += len(codes)
            if held > PAIRS:
                parts = [merged(parts)]
                held = 0
    if parts:
        yield out(at, parts)


def _counted(documents: pa.Table, counts: pa.Table) -> pa.Table:
    """The sums over the links of a block's documents."""
    order = np.argsort(codes := counts.column("code").to_numpy())
    codes, n, best = codes[order], counts.column("n").to_numpy()[order], counts.column("best").to_numpy(zero_copy_only=False)[order]
    n_best, count_sum = [], []
    for packed in documents.column("pairs").to_pylist():
        own, links = unpack_pairs(packed)
        at = np.searchsorted(codes, own)
        n_best.append(int(links[best[at]].sum()))
        count_sum.append(int((links * n[at]).sum()))
    done = documents.drop_columns(["pairs", "block"])
    done = done.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64()))
    return done.select([c.split()[0] for c in COUNTED.split(", ")])


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(code, n, best) from (block, code, n): the documents that hold a pair, and whether no pair of its A id is in more."""
    counts = pairs.groupBy("code").agg(F.sum("n").alias("n"))
    of_a = Window.partitionBy(F.shiftright("code", B_BITS))  # at most as many rows as B has ids
    return counts.withColumn("best", F.col("n") == F.max("n").over(of_a))


def align_tokenizers(docs: DataFrame, a_file: str, a_ranks: str, a_pattern: str, b_file: str) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    A encodes a space and the text, B the text, to which it adds the space; strings of special tokens
    are plain text. Texts that are null or empty, or that a tokenizer doesn't give back byte by byte, have
    no tokens: zeros and an empty digest. Null ids and repeated rows are documents like others, and every
    one counts. Very long texts are aligned whole. An empty table gives no rows; other columns are ignored.
    """
    rows = stored(aligned(docs, (a_file, a_ranks, a_pattern, b_file)), "aligned")
    full, bare = rows.where("pairs IS NOT NULL"), rows.where("pairs IS NULL")
    pairs = stored(full.select("block", "pairs").mapInArrow(_block_pairs, "block long, code long, n long"), "pairs")
    asked = pairs.select("block", "code").distinct().join(pair_counts(pairs), "code")
    done = full.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(_counted, COUNTED)
    none = F.lit(0).cast("long")
    return done.unionByName(bare.select("doc_id", "n_a", "n_b", "n_groups", "n_links", none.alias("n_best"), none.alias("count_sum"), "groups_sha256"))
