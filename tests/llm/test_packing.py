"""Exact round trips: pieces give the documents' ids again, sequences are full or powers of two."""

import random
import zlib

import numpy as np
import pytest

from gneiss.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")


def files():
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def test_encoder_equals_the_tokenizer():
    encoder = packing.Encoder(*files())
    rng = random.Random(4)
    signs = [*" \n\t\r\x0b\x1c\x85\xa0 　", "a", "B", "1", "!", "'s", "é", "ß", "中", "ٳ", "😀", "<|endoftext|>", "don't", " the", "  "]
    for _ in range(1500):
        text = "".join(rng.choices(signs, k=rng.randint(0, 40)))
        want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want, repr(text)


@pytest.mark.parametrize("seed", range(20))
def test_pack_cuts_everything_once_without_padding(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([1, 5, 100, 700, 2047, 2048, 2049, 4096, rng.randint(1, 9000)]) for _ in range(rng.randint(0, 120))]
    seen, cuts = {}, 0
    for pieces in packing.pack(lengths):
        size = sum(n for _, _, n in pieces)
        assert size == 2048 or size < 2048 and size & (size - 1) == 0
        for d, start, n in pieces:
            assert n > 0
            seen.setdefault(d, []).append((start, n))
    for d, n in enumerate(lengths):
        at = 0
        for start, size in sorted(seen[d]):
            assert start == at
            at += size
        assert at == n
        cuts += len(seen[d]) - 1 - n // 2048
    assert cuts <= len(lengths) // 2 + 14


def test_first_fit_equals_a_scan():
    rng = random.Random(2)
    tree, room = packing.Tournament(50, 100), [100] * 64
    for _ in range(120):
        size = rng.randint(1, 40)
        want = next(i for i, r in enumerate(room) if r >= size)
        room[want] -= size
        assert tree.first_fit(size) == want


def test_documents_round_trip(documents, odd):
    encoder = packing.Encoder(*files())
    rows = documents([(i, f"Document {i}: " + "lorem ipsum dolor " * (i * 37 % 400)) for i in range(60)]).union(odd)
    got = packing.pack_documents(rows, *files(), group_docs=16).collect()
    want = {}
    for r in rows.collect():
        ids = np.frombuffer(encoder.encode(r.text or ""), "<u4").tolist() + [1]
        want.setdefault(r.doc_id, []).append(np.array(ids, "<u4").tobytes())
    for r in got:
        assert any(len(x) == 4 * r.doc_tokens and zlib.crc32(x[4 * r.start:4 * (r.start + r.length)]) == r.ids_crc32 for x in want[r.doc_id])
    assert sum(r.length for r in got) == sum(len(x) // 4 for group in want.values() for x in group)
    for sequence in {r.sequence_id for r in got}:
        at = 0
        for r in sorted((r for r in got if r.sequence_id == sequence), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert packing.pack_documents(odd.limit(0), *files()).count() == 0


def test_sequences_follow_the_order_of_the_files(spark, documents, tmp_path, monkeypatch):
    monkeypatch.setattr(packing, "STRETCH_DOCS", 40)
    rows = documents([(i, f"Text {i} " + "more words " * (i * 31 % 90)) for i in range(400)])
    rows.repartitionByRange(3, "doc_id").sortWithinPartitions("doc_id").write.parquet(str(tmp_path / "d"))
    stored = spark.read.parquet(str(tmp_path / "d"))
    got = packing.pack_documents(stored, *files(), in_order=True).collect()
    assert {r.doc_id for r in got} == set(range(400))
    spans = {}
    for r in got:
        spans.setdefault(r.sequence_id, []).append(r.doc_id)
    assert all(max(d) - min(d) < 40 for d in spans.values())
    ordered = [spans[k] for k in sorted(spans)]
    # No sequence comes before one of an earlier stretch.
    assert all(max(a) < min(b) + 40 for a, b in zip(ordered, ordered[1:]))
    again = packing.pack_documents(stored, *files(), in_order=True).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))
    # Copies of a document that lie apart don't meet in a sequence; rows that come from no file are dealt by content.
    assert packing.pack_documents(rows, *files(), in_order=True).select("doc_id").distinct().count() == 400
