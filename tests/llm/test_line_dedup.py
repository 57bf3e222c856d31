"""Chunks and removals against plain Python; only multi-line chunks go, and one copy stays."""

import random

from gneiss.llm import line_dedup


def plain_kept(rows):
    """Kept lines per (id, text) from the operator's own chunks, which are tested apart."""
    seen, out = {}, {}
    for doc_id, text, chunks in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        lines, gone = text.split("\n"), set()
        for start, size in chunks:
            body = "\n".join(lines[start:start + size])
            if size >= 2 and seen.setdefault(body, (doc_id, start)) != (doc_id, start):
                gone |= set(range(start, start + size))
        out[doc_id] = "\n".join(line for i, line in enumerate(lines) if i not in gone)
    return out


def corpus():
    rng = random.Random(7)
    passage = [f"shared line {i} {rng.random()}" for i in range(12)]
    rows = []
    for i in range(40):
        lines = [f"own {i} {j} {rng.random()}" for j in range(rng.randint(1, 15))]
        if i % 2:
            at = rng.randint(0, len(lines))
            lines[at:at] = passage
        rows.append((i, "\n".join(lines)))
    return rows


def test_chunks_cover_the_lines_and_have_two_or_more(documents, odd):
    for r in line_dedup.with_chunks(documents(corpus()).union(odd)).collect():
        if r.text is None:
            assert r["__chunks"] is None
            continue
        n, at = len(r.text.split("\n")), 0
        for c in r["__chunks"]:
            assert c.start == at and (c.len >= 2 or n == 1)
            at += c.len
        assert at == n


def test_boundaries_survive_shifts(documents):
    rng = random.Random(3)
    body = [f"{rng.random()}" for _ in range(60)]
    rows = line_dedup.with_chunks(documents([(1, "\n".join(body)), (2, "\n".join([f"new {i}" for i in range(5)] + body))])).collect()
    chunks = [{"\n".join(r.text.split("\n")[c.start:c.start + c.len]) for c in r["__chunks"]} for r in sorted(rows)]
    assert len(chunks[0] & chunks[1]) >= len(chunks[0]) - 2


def test_removals_equal_plain_python(documents):
    docs = documents(corpus())
    chunked = [(r.doc_id, r.text, [(c.start, c.len) for c in r["__chunks"]]) for r in line_dedup.with_chunks(docs).collect()]
    want = plain_kept(chunked)
    got = {r.doc_id: r for r in line_dedup.line_dedup(docs).collect()}
    assert {i: r.text for i, r in got.items()} == want
    texts = dict(corpus())
    for i, r in got.items():
        assert r.n_lines == len(texts[i].split("\n"))
        assert r.n_removed == r.n_lines - (len(r.text.split("\n")) if r.text or r.n_lines > r.n_removed else 0)
    assert sum(r.n_removed for r in got.values()) > 100
    assert all(f"own {i} " in got[i].text for i in got)


def test_odd_rows(spark, odd):
    extra = odd.selectExpr("*", "1 AS start", "2 AS chunk", "3 AS digest")
    out = line_dedup.line_dedup(extra)
    assert out.columns == [*extra.columns, "n_lines", "n_removed"]
    got = {(r.doc_id, r.text, r.n_lines, r.n_removed) for r in out.collect()}
    assert out.count() == odd.count()
    assert (1, None, 0, 0) in got and (2, "", 1, 0) in got
    # Long texts of one line are no multi-line chunks.
    assert {r[0] for r in got if r[3]} <= {8}
    assert line_dedup.line_dedup(odd.limit(0)).count() == 0


def test_whole_runs_equal_all_pairs(documents):
    rng = random.Random(11)
    passages = [[f"run {k} {i} {rng.random()}" for i in range(2 + k % 4)] for k in range(12)]
    rows = []
    for i in range(80):
        lines = [f"own {i} {j} {rng.random()}" for j in range(rng.randint(2, 9))]
        at = rng.randint(0, len(lines))
        lines[at:at] = passages[i % 12]
        rows.append((i, "\n".join(lines)))
    seen, want = set(), {}
    for i, text in rows:
        lines, gone = text.split("\n"), set()
        for j, pair in enumerate(zip(lines, lines[1:])):
            gone |= {j, j + 1} if pair in seen else set()
            seen.add(pair)
        want[i] = "\n".join(line for j, line in enumerate(lines) if j not in gone)
    got = line_dedup.line_dedup(documents(rows), whole_runs=True).collect()
    assert {r.doc_id: r.text for r in got} == want
    assert all(not (i >= 12 and f"run {i % 12} " in want[i]) and f"own {i} " in want[i] for i in want)
    assert {r.doc_id: r.n_removed for r in got} == {i: 0 if i < 12 else len(passages[i % 12]) for i in want}


def grown_by_hand(rows):
    """Kept texts by the definition of anchored chunks and their growth, in plain Python."""
    rows = sorted(rows)
    pieces, gone = {}, {i: set() for i, _, _ in rows}
    for turn in ("note", "cut"):
        for i, text, chunks in rows:
            lines = text.split("\n")
            for start, size, low, high in chunks:
                spans = [(-1, start, start + size - 1, range(start, start + size))]
                spans += [(0, k, start + size - 1, [k]) for k in range(start - 1, low - 1, -1)] + [(1, start, k, [k]) for k in range(start + size, high + 1)]
                for side, a, b, new in spans:
                    piece = (side, size, "\n".join(lines[a:b + 1]), "\n".join(lines[start:start + size]))
                    if turn == "note":
                        pieces.setdefault(piece, (i, start))
                    elif pieces[piece] != (i, start):
                        gone[i] |= set(new)
    return {i: "\n".join(line for k, line in enumerate(text.split("\n")) if k not in gone[i]) for i, text, _ in rows}


def runs(seed, lengths):
    rng = random.Random(seed)
    passages = [[f"run {k} {i} {rng.random()}" for i in range(lengths[k % len(lengths)])] for k in range(30)]
    rows = []
    for i in range(150):
        lines = [f"own {i} {j} {rng.random()}" for j in range(rng.randint(2, 9))]
        at = rng.randint(0, len(lines))
        lines[at:at] = passages[i % 30]
        rows.append((i, "\n".join(lines)))
    return rows


def test_grown_chunks_equal_plain_python(documents):
    rows = runs(12, [2, 3, 4, 9]) + [(900, "\n".join(["same"] * 40)), (901, "\n".join(["same"] * 30 + ["end"])), (902, "one"), (903, "")]
    docs = documents(rows)
    chunked = [(r.doc_id, r.text, [tuple(c) for c in r["__chunks"]]) for r in line_dedup.anchored_chunks(docs).collect()]
    for _, text, chunks in chunked:
        n = len(text.split("\n"))
        assert all(size >= 2 and 0 <= low <= start and start + size - 1 <= high < n for start, size, low, high in chunks) or n == 1
    got = {r.doc_id: r for r in line_dedup.line_dedup(docs, grown=True).collect()}
    assert {i: r.text for i, r in got.items()} == grown_by_hand(chunked)
    assert all(r.n_lines == len(dict(rows)[i].split("\n")) for i, r in got.items())


def test_grown_chunks_find_most_lines_of_runs_and_no_others(documents):
    rows = runs(13, [2, 3, 4, 6, 9, 12])
    whole = {r.doc_id: set(r.text.split("\n")) for r in line_dedup.line_dedup(documents(rows), whole_runs=True).collect()}
    grown = {r.doc_id: set(r.text.split("\n")) for r in line_dedup.line_dedup(documents(rows), grown=True).collect()}
    texts = {i: set(t.split("\n")) for i, t in rows}
    assert all(whole[i] <= grown[i] for i in whole)
    found, there = sum(len(texts[i] - grown[i]) for i in texts), sum(len(texts[i] - whole[i]) for i in texts)
    assert found >= 0.9 * there > 500


def test_grown_needs_chunks(documents, monkeypatch):
    """Without chunks nothing goes: no other path decides."""
    docs = documents(runs(14, [6]))
    assert sum(r.n_removed for r in line_dedup.line_dedup(docs, grown=True).collect()) > 500
    anchored = line_dedup.anchored_chunks
    monkeypatch.setattr(line_dedup, "anchored_chunks", lambda d: anchored(d).selectExpr("* EXCEPT (__chunks)", "slice(__chunks, 1, 0) AS __chunks"))
    assert sum(r.n_removed for r in line_dedup.line_dedup(docs, grown=True).collect()) == 0


def test_odd_rows_grown(odd):
    extra = odd.selectExpr("*", "1 AS start", "2 AS chunk", "3 AS digest", "4 AS first", "5 AS side", "6 AS n_removed")
    out = line_dedup.line_dedup(extra, grown=True)
    got = {(r.doc_id, r.text, r.n_lines, r.n_removed) for r in out.collect()}
    assert out.count() == odd.count() and (1, None, 0, 0) in got and (2, "", 1, 0) in got
    assert line_dedup.line_dedup(odd.limit(0), grown=True).count() == 0
