"""Pack tokenised documents into sequences, first-fit decreasing with a tournament tree.

Documents are dealt to randomised groups by a hash, and each group is packed by itself: its
documents are tokenised, split into full sequences and a remainder, and the remainders go by
decreasing length into the first bin with room. A tournament tree over the bins' capacities
finds that bin in a logarithmic number of steps. Gaps that stay are filled by cutting the
pieces of the emptiest bins, and what is left of the last bin is cut at powers of two, which
need no padding.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from gneiss.llm.common import row_key

LENGTH = 2048
#: Documents in a group, on average.
GROUP_DOCS = 1024
END_ID = 1
#: Entries of a worker's memory of encoded words.
CACHED = 400_000

#: Rows of a stretch of the training order, whose documents are dealt to so many groups at random.
STRETCH_DOCS, LOTS = 2 * GROUP_DOCS, 2
#: Bits of a sequence's number within its group.
SEQUENCE_BITS = 20

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


class Encoder(dict):
    """Token ids of a text as little-endian bytes, encoded word by word and remembered.

    A byte-level BPE never joins a white-space character to what stands before it, if that is
    none itself, so a text may be cut there. New words are encoded by the rank file of the same
    vocabulary, which is faster; words beyond Latin letters and words with a special token's
    string go to the tokenizer itself.
    """

    # Unicode's White_Space property.
    space = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
    words = re.compile(rf"[{space}]*[^{space}]+|[{space}]+\Z").findall
    odd = re.compile(r"[^\x00-ɏ]|<\|")

    def __init__(self, tokenizer_file: str, ranks_file: str | None, pattern: str | None):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.ranked = Tokenizer.from_file(tokenizer_file), None
        if ranks_file:
            import tiktoken

            with open(ranks_file, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.ranked = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHED:
            self.clear()
        plain = self.ranked and not self.odd.search(word)
        ids = self.ranked(word) if plain else self.tokenizer.encode(word, add_special_tokens=False).ids
        self[word] = out = np.array(ids, "<u4").tobytes()
        return out

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.words(text)))


@lru_cache(maxsize=1)
def encoder(tokenizer_file: str, ranks_file: str | None, pattern: str | None) -> Encoder:
    """One encoder for each Python worker."""
    return Encoder(tokenizer_file, ranks_file, pattern)


class Tournament:
    """Capacities of bins; each inner node knows the larger of its children."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.best = [capacity] * (2 * self.leaves)

    def first_fit(self, size: int) -> int:
        """The first bin with room for ``size``, which is then taken from it."""
        best, at = self.best, 1
        while at < self.leaves:
            at *= 2
            if best[at] < size:
                at += 1
        found = at - self.leaves
        best[at] -= size
        while at > 1:
            at //= 2
            best[at] = max(best[2 * at], best[2 * at + 1])
        return found


def pack(lengths: list[int], capacity: int = LENGTH) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length) for documents of the given lengths.

    All sequences are full, but for the last few, whose lengths are different powers of two.
    """
    full = [[(d, s, capacity)] for d, n in enumerate(lengths) for s in range(0, n - capacity + 1, capacity)]
    rest = sorted(((n % capacity, d) for d, n in enumerate(lengths) if n % capacity), key=lambda x: (-x[0], x[1]))
    tree, bins = Tournament(len(rest), capacity), [[] for _ in rest]
    for size, d in rest:
        bins[tree.first_fit(size)].append((d, lengths[d] - size, size))
    room = {b: tree.best[tree.leaves + b] for b in range(len(bins)) if bins[b]}
    open_bins = sorted((b for b in room if room[b]), key=lambda b: (room[b], b))
    while len(open_bins) > 1:
        takes, gives = open_bins[0], open_bins[-1]
        d, start, size = bins[gives].pop()
        moved = min(size, room[takes])
        # The end of a piece moves; its beginning stays where it is.
        bins[takes].append((d, start + size - moved, moved))
        if moved < size:
            bins[gives].append((d, start, size - moved))
        room[takes] -= moved
        room[gives] += moved
        if not room[takes]:
            open_bins.pop(0)
        if not bins[gives]:
            open_bins.remove(gives)
    tail = []
    for b in open_bins:
        left, pieces = capacity - room[b], bins[b][::-1]
        bins[b] = []
        while left:
            size = wanted = 1 << (left.bit_length() - 1)
            tail.append([])
            while wanted:
                d, start, n = pieces.pop()
                used = min(n, wanted)
                tail[-1].append((d, start, used))
                if used < n:
                    pieces.append((d, start + used, n - used))
                wanted -= used
            left -= size
    return full + [b for b in bins if b] + tail


def order_group(docs: DataFrame) -> Column | None:
    """The group of each row of a table read from files, such that groups follow the order the files were written in.

    A writer numbers its files by partition, and rows keep their order within a file. A group is a random lot of a
    stretch of consecutive rows. None if the rows don't come straight from files.
    """
    row, name = F.col("_metadata.row_index"), F.col("_metadata.file_name")
    try:
        docs.select(row, name)
    except AnalysisException:
        return None
    number = F.coalesce(F.regexp_extract(name, r"^part-(\d+)", 1).try_cast("long"), F.pmod(F.xxhash64(name), F.lit(1 << 20)))
    stretch = F.floor(row / STRETCH_DOCS)
    lot = F.pmod(F.xxhash64(name, row), F.lit(LOTS))
    return ((number * (1 << 20) + stretch) * LOTS + lot).cast("long")


def pack_documents(docs: DataFrame, tokenizer_file: str, ranks_file: str | None = None, pattern: str | None = None,
                   group_docs: int = GROUP_DOCS, in_order: bool = False) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset.

    A document is its ids and the end id 1; a null text is empty, so only the end id. Null ids
    and repeated rows are documents like others. An empty table gives no rows. A group depends
    on the rows' contents only, so a repeated task gives the same sequences. With ``in_order`` groups are random lots
    of stretches of the order in which ``docs`` lies in its files, and sequences are numbered along it; rows that don't
    come from files have no order and are dealt by content.
    """
    order = order_group(docs) if in_order else None
    if order is None:
        groups = max(1, -(-docs.count() // group_docs))
        order = F.pmod(F.xxhash64(row_key()), F.lit(groups))

    def run(table: pa.Table) -> pa.Table:
        encode = encoder(tokenizer_file, ranks_file, pattern).encode
        table = table.sort_by([("key", "ascending"), ("doc_id", "ascending")])
        ids = [(encode(text.as_py()) if text.is_valid else b"") + END_ID.to_bytes(4, "little") for text in table.column("text")]
        sequences = pack([len(x) // 4 for x in ids])
        rows = [(d, s, n, index, offset) for index, pieces in enumerate(sequences)
                for (d, s, n), offset in zip(pieces, accumulate((p[2] for p in pieces), initial=0))]
        d, s, n, index, offset = np.array(rows, np.int64).reshape(-1, 5).T
        first = table.column("group")[0].as_py() << SEQUENCE_BITS
        return pa.table({
            "doc_id": table.column("doc_id").take(pa.array(d)), "start": s, "length": n,
            "ids_crc32": pa.array([zlib.crc32(ids[a][4 * b : 4 * (b + c)]) for a, b, c, _, _ in rows], pa.int64()),
            "doc_tokens": np.array([len(x) // 4 for x in ids], np.int64)[d], "sequence_id": first + index, "offset": offset})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", row_key().alias("key"), order.alias("group"))
    return rows.groupBy("group").applyInArrow(run, PIECES)
