"""Hard negatives, vector codes and repeated strings against plain versions."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from corvane.llm import hard_negatives, suffix_dedup, vector_codes

NAN, INF = float("nan"), float("inf")


def plain_statistics(text: bytes) -> list[int]:
    def common(i, j):
        k = 0
        while max(i, j) + k < len(text) and text[i + k] == text[j + k]:
            k += 1
        return k

    return [max((common(i, j) for j in range(len(text)) if j != i), default=0) for i in range(len(text))]


@pytest.mark.parametrize("seed", range(6))
def test_matching_statistics_stream_from_run_ends(seed):
    draw = random.Random(seed)
    text = bytes(draw.choice(b"ab" if seed % 2 else b"abcd\xff") for _ in range(draw.randint(1, 160))) + b"\xff"
    index = suffix_dedup.RunLengthIndex(np.frombuffer(text, np.uint8))
    assert int(index.lengths.sum()) == len(text) and len(index.below_at) == len(index.heads)
    order = sorted(range(len(text)), key=lambda k: text[k:])
    assert np.repeat(index.heads, index.lengths).tolist() == [text[k - 1] if k else 256 for k in order]
    for stretch in (7, 1 << 20):
        assert np.concatenate(list(index.matching_statistics(stretch))).tolist() == plain_statistics(text)


def test_repetitive_texts_have_few_runs():
    unit = bytes(random.Random(3).choice(b"abcdefgh") for _ in range(500))
    index = suffix_dedup.RunLengthIndex(np.frombuffer(unit * 40 + b"\xff", np.uint8))
    assert len(index.heads) < 600


def plain_repeats(texts: list[bytes], size: int = 200) -> list[tuple]:
    seen = Counter(t[k : k + size] for t in texts for k in range(len(t) - size + 1))
    found = []
    for t in texts:
        gone = [False] * len(t)
        for k in range(len(t) - size + 1):
            if seen[t[k : k + size]] > 1:
                gone[k : k + size] = [True] * size
        spans = sum(g and not before for g, before in zip(gone, [False, *gone], strict=False))
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        found.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return found


def repeat_cases() -> list[str | None]:
    draw = random.Random(5)
    prose = lambda n: " ".join("".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randint(2, 9))) for _ in range(n))
    passage, short, edge = prose(70), prose(10), prose(200)[:200]
    texts = [None, "", "a", "x" * 199, "y" * 200, "z" * 900, "é" * 300, edge, f"{edge}!", f"?{edge[:199]}", prose(90), prose(90)]
    texts += [f"{prose(draw.randint(0, 60))} {passage} {prose(draw.randint(0, 60))}" for _ in range(12)]
    texts += [f"{prose(3)}{passage[:203]}{prose(3)}" for _ in range(9)] + [passage] * 3 + [f"{short} {prose(40)}" for _ in range(4)]
    base = prose(400).split()
    for _ in range(8):
        words = list(base)
        for _ in range(4):
            words[draw.randrange(len(words))] = prose(1)
        texts.append(" ".join(words))
    inner = prose(60)
    return [*texts, f"{inner} {prose(20)} {inner}", "ab\0" * 150, "ab\0" * 90 + "c" + "ab\0" * 90, "𝔘nicode ß " * 40]


@pytest.mark.parametrize("group", [suffix_dedup.GROUP, 1])
def test_repeats_equal_a_plain_count(spark, group):
    texts = repeat_cases()
    rows = [(k if k % 7 else None, t, "x", k, 1) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, h string, digest long, id int").repartition(5)
    got = suffix_dedup.without_repeats(docs, group).collect()
    expected = plain_repeats([(t or "").encode() for t in texts])
    assert Counter((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == Counter(expected)
    by_id = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got if r.doc_id is not None}
    assert by_id == {k: expected[k] for k in range(len(texts)) if k % 7}


def test_repeats_of_nothing_and_of_megabytes(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.without_repeats(empty).count() == 0
    draw = random.Random(8)
    long = "".join(draw.choice("abcdefghijkl mnopq") for _ in range(1_500_000))
    docs = spark.createDataFrame([(1, long), (2, long[700_000:700_450]), (3, "q" * 2_000_000)], "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in suffix_dedup.without_repeats(docs).collect()}
    assert got == {1: (450, 1), 2: (450, 1), 3: (2_000_000, 1)}


def embedding_rows() -> list[tuple]:
    draw = random.Random(11)
    centres = [[draw.gauss(0, 0.2) for _ in range(7)] for _ in range(4)]
    rows = []
    for k in range(420):
        centre = draw.choice(centres)
        rows.append((k, [c + draw.gauss(0, 0.1) for c in centre], draw.choice([0, 1, 1, 2, 9])))
    same = [0.25, -0.5, 0.125, 0.0, 0.75, -0.25, 0.5]
    rows += [(500 + k, same, k % 3) for k in range(40)]
    rows += [(600, same[:3], 1), (601, [], 2), (602, None, 1), (603, [0.1, None], 1), (604, [NAN] * 7, 0), (605, [0.5, INF], 1), (606, same, None)]
    return [*rows, (500, same, 1), (700, [-x for x in same], 3), (800, [0.0] * 7, 1), (None, same, 1)]


def plain_vectors(rows, factor):
    found = []
    for name, vector, label in rows:
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            found.append((name, [math.floor(factor * float(np.float32(x))) for x in vector] + [0] * (7 - len(vector)), label))
    return found


def plain_negatives(rows):
    kept = [(i, v, (c + 1) % 10 if i % 7 == 0 else c) for i, v, c in plain_vectors(rows, 256) if i is not None and c is not None]
    out = []
    anchors = sorted({(i, c, tuple(v)) for i, v, c in kept if i % 100 == 0})
    for i, c, v in anchors:
        scored = [(sum(a * b for a, b in zip(v, w, strict=True)), j, d) for j, w, d in kept if j != i]
        for ps, p, _ in sorted((x for x in scored if x[2] == c), key=lambda x: (-x[0], x[1]))[:5]:
            fit = [x for x in scored if x[2] != c and 80 * ps <= 100 * x[0] <= 100 * ps]
            for rank, (ns, n, _) in enumerate(sorted(fit, key=lambda x: (-x[0], x[1]))[:5], 1):
                out.append((i, p, rank, n, ps, ns))
    return sorted(out)


@pytest.mark.parametrize(("block", "fit"), [(3000, 4096), (2, 9)])
def test_hard_negatives_equal_all_scores(spark, monkeypatch, block, fit):
    rows = embedding_rows()
    frame = spark.createDataFrame([(*r, "x", 0) for r in rows], "vec_id long, embedding array<float>, label int, code string, anchor int").repartition(3)
    stored = hard_negatives.stored_rows
    monkeypatch.setattr(hard_negatives, "stored_rows", lambda e, f: stored(e, f, fit))
    got = hard_negatives.hard_negatives(frame, block=block)
    assert got.dtypes[2] == ("rank", "int")
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows)


def test_quantised_bounds_hold():
    draw = np.random.default_rng(2)
    vectors = draw.integers(-900, 900, (500, 13))
    quantiser = hard_negatives.Quantiser(vectors[:60])
    codes, residual = quantiser.encode(vectors)
    for anchor in vectors[:20]:
        apart = np.abs(vectors @ anchor - hard_negatives.scores(quantiser.table(anchor), np.ascontiguousarray(codes.T)))
        assert (apart <= np.sqrt((anchor**2).sum()) * residual + 1e-6).all()


def test_windows_of_negatives():
    assert hard_negatives.window_of(10) == (8, 10) and hard_negatives.window_of(11) == (9, 11) and hard_negatives.window_of(0) == (0, 0)


def plain_codes(rows, parts, entries, rounds):
    kept = plain_vectors(rows, 1024)
    size = -(-7 // parts)
    cut = [[(v + [0] * parts)[p * size : (p + 1) * size] for p in range(parts)] for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, cut[k]))
    books = [[cut[k][p] for k in order[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda p, v: min((far(v, e), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        moved = []
        for p in range(parts):
            members = [[] for _ in books[p]]
            for v in cut:
                members[near(p, v[p])[1]].append(v[p])
            moved.append([[sum(x) // len(m) for x in zip(*m, strict=True)] if m else e for m, e in zip(members, books[p], strict=True)])
        books = moved
    found = [[near(p, v[p]) for p in range(parts)] for v in cut]
    errors = [sum(d for d, _ in f) for f in found]
    of_label = Counter()
    for (_, _, label), e in zip(kept, errors, strict=True):
        of_label[label] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return Counter((n, "".join(f"{k:02x}" for _, k in f), e, of_label[c], digest) for (n, _, c), f, e in zip(kept, found, errors, strict=True))


@pytest.mark.parametrize(("parts", "entries", "rounds", "labels"), [(4, 256, 2, 10_000), (2, 5, 4, 1), (4, 600, 1, 10_000)])
def test_codes_equal_plain_rounds(spark, monkeypatch, parts, entries, rounds, labels):
    rows = embedding_rows()
    entries = min(entries, 256)
    monkeypatch.setattr(vector_codes, "BROADCAST_LABELS", labels)
    frame = spark.createDataFrame([(*r, "x", 0) for r in rows], "vec_id long, embedding array<float>, label int, error string, of int").repartition(3)
    got = vector_codes.encode(frame, parts, entries, rounds).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
    assert Counter(map(tuple, got.collect())) == plain_codes(rows, parts, entries, rounds)


def test_segment_mean_bounds_lose_no_entry():
    draw = np.random.default_rng(4)
    for size in (1, 2, 3, 16):
        rows = draw.integers(-(1 << 20), 1 << 20, (300, size)) // draw.integers(1, 1 << 18, (300, 1))
        entries = np.concatenate((rows[:40], rows[:5], draw.integers(-50, 50, (9, size))))
        far = ((rows[:, None] - entries[None]) ** 2).sum(axis=2)
        index, distance = vector_codes.nearest(rows, entries)
        assert (index == far.argmin(axis=1)).all() and (distance == far.min(axis=1)).all()


def test_vector_operators_on_empty_tables(spark):
    for rows in ([], [(1, None, 1), (2, [NAN], 2)]):
        frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
        assert hard_negatives.hard_negatives(frame).count() == 0 and vector_codes.encode(frame).count() == 0
