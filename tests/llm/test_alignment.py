"""The alignment equals one that walks over byte offsets and spells out all pairs."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from gneiss.llm import alignment

public_tokenizers = pytest.importorskip("public_tokenizers")


def files():
    path = public_tokenizers.path
    return path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, path("piece_bpe_32k.model")


def brute(texts):
    """Rows without doc_id for a list of texts, by whole encodings and loops."""
    own = alignment.Tokenizers(*files())
    out, held = [], Counter()
    for text in texts:
        a = own.words.tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
        b = own.b.encode(text) if text else []
        raw = (" " + text).encode() if text else b""
        if not text or b"".join(own.a_bytes[i] for i in a) != raw or b"".join(own.b_bytes[i] for i in b) != raw:
            out.append(None)
            continue
        a_end, b_end = np.cumsum([len(own.a_bytes[i]) for i in a]).tolist(), np.cumsum([len(own.b_bytes[i]) for i in b]).tolist()
        cuts = sorted(set(a_end) & set(b_end))
        groups, i, j = [], 0, 0
        for cut in cuts:
            k, m = a_end.index(cut, i) + 1, b_end.index(cut, j) + 1
            groups.append((a[i:k], b[j:m]))
            i, j = k, m
        links = Counter((x, y) for ga, gb in groups for x in ga for y in gb)
        held.update(links.keys())
        out.append((len(a), len(b), groups, links))
    best = {}
    for (x, _), n in held.items():
        best[x] = max(best.get(x, 0), n)
    rows = []
    for o in out:
        if o is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = o
        spelled = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append((n_a, n_b, len(groups), sum(links.values()), sum(n for p, n in links.items() if held[p] == best[p[0]]),
                     sum(n * held[p] for p, n in links.items()), hashlib.sha256(spelled.encode()).hexdigest()))
    return rows


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
SIGNS = [*" \n\t\r\x0b\x1c\x1f\x85\xa0 　\0", "a", "B", "12", "!", "'s", "é", "é", "ß", "中文", "ٳ", "😀", "👩‍👩‍👧", "▁", "ﬁ", "<|endoftext|>", "<s>", "<0x41>",
         "don't", " the", "  ", "tion", "ing", "erst", "﻿", "----", "xyzzy"]


def test_random_texts_equal_brute_force(documents, rows):
    rng = random.Random(11)
    texts = ["".join(rng.choices(SIGNS, k=rng.randint(0, 60))) for _ in range(250)] + ["the cat sat on the mat"] * 5
    got = rows(alignment.align_tokenizers(documents(list(enumerate(texts))), *files()), "doc_id", *COLUMNS)
    assert got == sorted(((i, *r) for i, r in enumerate(brute(texts))), key=repr)
    assert any(r[1] == 0 for r in got) and max(r[5] for r in got) > 5


def test_odd_rows(odd, rows, monkeypatch):
    monkeypatch.setattr(alignment, "PAIRS", 50)
    clashing = odd.withColumnsRenamed({"lang": "block", "source": "pairs"})
    got = rows(alignment.align_tokenizers(clashing, *files()), "doc_id", *COLUMNS)
    source = odd.collect()
    want = sorted(((r.doc_id, *x) for r, x in zip(source, brute([r.text for r in source]))), key=repr)
    assert got == want
    assert alignment.align_tokenizers(odd.limit(0), *files()).count() == 0


def test_whole_texts_equal_the_tokenizer():
    own = alignment.Tokenizers(*files())
    rng = random.Random(5)
    for _ in range(3000):
        text = " " + "".join(rng.choices(SIGNS, k=rng.randint(1, 30)))
        assert own.encode_a(text).tolist() == own.words.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_pointer_jumping_equals_common_ends():
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randint(1, 60)
        a = sorted({*rng.sample(range(1, n + 1), rng.randint(1, n)), n})
        b = sorted({*rng.sample(range(1, n + 1), rng.randint(1, n)), n})
        of_a, of_b = alignment.labels(np.array(a), np.array(b))
        common = sorted(set(a) & set(b))
        group = lambda end: next(c for c in common if c >= end)
        assert [b[x] for x in of_a] == [group(e) for e in a] and [b[x] for x in of_b] == [group(e) for e in b]


def test_pairs_are_packed_without_loss():
    codes = np.array([0, 5, 1 << 33, (1 << 35) + 1], np.int64)
    links = np.array([1, 300, 1 << 40, 2], np.int64)
    assert [x.tolist() for x in alignment.unpack_pairs(alignment.pack_pairs(codes, links))] == [codes.tolist(), links.tolist()]
