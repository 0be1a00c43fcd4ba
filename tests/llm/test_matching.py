import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quillspark.llm import repeated_lines, shared_spans, similar_vectors

SCHEMA = "id string, doc_id string, domain string, text string, ocr_confidence double, item string, pattern string"


def test_repeated_lines_equal_brute_force(spark):
    rng = random.Random(3)
    pool = ["Menu  of pages 12", "menu of pages 7", "Terms apply", "12 34", "", "Share!"]
    rows = []
    for i in range(60):
        lines = [rng.choice([*pool, f"own line {chr(97 + i % 26)}"]) for _ in range(rng.randint(0, 5))]
        rows.append((f"c{i}", f"d{i % 20}", "a" if i % 3 else "b", "\n".join(lines), 0.5 if i % 17 == 0 else None, "clash", "clash"))
    rows += [("n", "d0", "a", None, None, "", ""), (None, "d1", "a", "Terms apply", None, "", ""), ("m", None, "a", "Terms apply", None, "", ""), rows[1]]
    frame = spark.createDataFrame(rows, SCHEMA)
    import re

    norm = lambda x: re.sub(r"\d+", "0", re.sub(r"\s+", " ", x.lower())).strip()
    docs = {}
    seen = [(i, d, g, n, norm(x)) for i, d, g, t, o, *_ in rows if None not in (i, d, t) and o is None for n, x in enumerate(t.split("\n")) if re.search(r"[^\W\d_]", x)]
    for _, d, g, _, x in seen:
        docs.setdefault((g, x), set()).add(d)
    expected = {(i, n) for i, _, g, n, x in seen if len(docs[g, x]) >= 6}
    assert {(r.id, r.line_no) for r in repeated_lines.repeated_lines(frame).collect()} == expected
    cleaned = {r.id: r.text for r in repeated_lines.without_repeated_lines(frame).collect()}
    for i, _, _, t, o, *_ in rows:
        if i and t is not None:
            assert cleaned[i] == "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in expected)
    assert cleaned["n"] is None and repeated_lines.repeated_lines(frame.limit(0)).count() == 0


def test_sequences_need_support_too(spark):
    rows = [(f"c{i}", f"d{i}", "a", "x line\nown\ny line" if i < 6 else "y line\nx line", None, "", "") for i in range(12)]
    patterns = repeated_lines.frequent_sequences(spark.createDataFrame([*rows, rows[0]], SCHEMA))
    got = sorted((list(r.lines), r.n_documents) for r in patterns.collect())
    assert got == [(["own"], 6), (["own", "y line"], 6), (["x line"], 12), (["x line", "own"], 6), (["x line", "own", "y line"], 6), (["y line"], 12), (["y line", "x line"], 6)]


def test_sequences_of_any_length_are_found(spark):
    rows = [(f"c{i}", f"d{i % 7}", "a", "\n".join(f"line {chr(97 + n)}" for n in range(12)) + f"\nown {chr(97 + i)}", None, "", "") for i in range(14)]
    patterns = repeated_lines.frequent_sequences(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(patterns) == 12 * 13 // 2 and max(r.length for r in patterns) == 12
    assert repeated_lines.frequent_sequences(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repeated_lines_are_those_that_grown_sequences_cover(spark, monkeypatch):
    rng = random.Random(5)
    menu = [f"menu {chr(97 + n)}" for n in range(7)]
    rows = []
    for i in range(60):
        a, b = sorted(rng.sample(range(8), 2))
        lines = [*menu[a:b], f"own {chr(97 + i % 26)} {chr(97 + i // 26)}", *rng.sample(["terms", "share", *menu], rng.randint(0, 3))]
        rows.append((f"c{i}", f"d{i % 25}", "a" if i % 3 else "b", "\n".join(lines), None, "", ""))
    rows += [(f"e{i}", f"e{i}", "a", "\n".join(menu), None, "", "") for i in range(6)] + [rows[2]]
    frame = spark.createDataFrame(rows, SCHEMA)

    def supports(sequences):
        docs = {}
        for (_, d, g), s in sequences.items():
            for i in range(len(s)):
                for j in range(i + 1, len(s) + 1):
                    docs.setdefault((g, *(x for _, x in s[i:j])), set()).add(d)
        return {p for p, v in docs.items() if len(v) >= 6}

    lines = {(i, d, g): list(enumerate(t.split("\n"))) for i, d, g, t, *_ in rows}
    single = supports({(f"{i}.{n}", d, g): [(n, x)] for (i, d, g), s in lines.items() for n, x in s})
    sequences = {k: [x for x in s if (k[2], x[1]) in single] for k, s in lines.items()}
    frequent = supports(sequences)
    expected = set()
    for (i, _, g), s in sequences.items():
        places = {(a, b) for a in range(len(s)) for b in range(a + 1, len(s) + 1) if (g, *(x for _, x in s[a:b])) in frequent}
        expected |= {(i, tuple(n for n, _ in s[a:b])) for a, b in places if not any((c <= a and b <= d) and (c, d) != (a, b) for c, d in places)}
    assert {len(n) for _, n in expected} >= {1, 2, 3, 7}
    for ahead in (32, 2):
        monkeypatch.setattr(repeated_lines, "AHEAD", ahead)
        assert {(r.id, tuple(r.line_nos)) for r in repeated_lines.occurrences(frame).collect()} == expected
    # a line is deleted because an occurrence covers it: with the longer ones only, others stay
    whole = repeated_lines.occurrences
    monkeypatch.setattr(repeated_lines, "occurrences", lambda *a: whole(*a).where("size(line_nos) > 1"))
    assert {(r.id, r.line_no) for r in repeated_lines.repeated_lines(frame).collect()} == {(i, n) for i, ns in expected if len(ns) > 1 for n in ns}


def brute_pairs(ids, x, k, least):
    x = x / np.linalg.norm(x, axis=1)[:, None]
    s = x @ x.T
    out = set()
    for i in range(len(ids)):
        others = [j for j in range(len(ids)) if j != i]
        for j in others:
            if s[i, j] >= least and sum(s[i, o] > s[i, j] + 1e-6 for o in others) < k:
                out.add(tuple(sorted((ids[i], ids[j]))))
    return out


def test_nearest_vectors_recall(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((60, 32))
    x = np.repeat(centres, 10, axis=0) + 0.35 * rng.standard_normal((600, 32))
    x[7] = x[8] = x[9]
    ids = [f"v{i}" for i in range(600)]
    rows = [(i, v.tolist(), "clash") for i, v in zip(ids, x.astype(np.float32))]
    rows += [rows[0], (None, rows[0][1], ""), ("z", [0.0] * 32, ""), ("n", None, ""), ("e", [], ""), ("s", [1.0] * 5, ""), ("h", [float("nan")] * 32, "")]
    frame = spark.createDataFrame(rows, "id string, embedding array<float>, cell string")
    truth = brute_pairs(ids, x.astype(np.float32).astype(float), 5, 0.75)
    for block in (16_384, 40):
        got = {(r.id_a, r.id_b) for r in similar_vectors.similar_pairs(similar_vectors.nearest(frame, dim=32, least=0.75, block=block), similar_vectors.members(frame, dim=32), 0.75).collect()}
        assert len(got & truth) >= 0.95 * len(truth) and len(got - truth) <= 0.02 * len(truth)
    assert similar_vectors.nearest(frame.limit(0), dim=32).count() == 0


def test_all_five_nearest_are_found_without_a_least_similarity(spark, tmp_path):
    from quillspark.llm import queries

    x = np.random.default_rng(8).standard_normal((2000, 128)).astype(np.float32)
    frame = spark.createDataFrame([(f"v{i}", v.tolist(), "vec-small-2") for i, v in enumerate(x)], "id string, embedding array<float>, embedding_model string")
    frame.write.parquet(str(tmp_path / "chunk_vectors.parquet"))
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    similar = unit @ unit.T
    np.fill_diagonal(similar, -9)
    truth = {(f"v{i}", f"v{j}") for i, row in enumerate(similar) for j in np.argsort(-row)[:5]}
    got = {(r.id, r.neighbour) for r in queries.p3_nearest(spark, str(tmp_path)).collect()}
    assert len(got & truth) >= 0.9 * len(truth)


def test_equal_vectors_are_one_class_with_all_links(spark):
    rows = [(f"v{i:03}", [1.0, 2.0, 0.5, -1.0]) for i in range(400)]
    frame = spark.createDataFrame(rows, "id string, embedding array<float>").repartition(7)
    links, records = similar_vectors.nearest(frame, dim=4), similar_vectors.members(frame, dim=4)
    assert [tuple(r) for r in similar_vectors.class_links(links, records).collect()] == [("v000", 400, 159_600)]
    assert similar_vectors.similar_pairs(links, records, 0.75).count() == 79_800
    assert {r.class_id for r in similar_vectors.class_members(records).collect()} == {"v000"}


def test_copies_count_among_the_nearest(spark):
    x = np.random.default_rng(3).standard_normal((300, 16)).astype(np.float32)
    for n in (4, 9):  # with 4 copies two others are still among the five nearest, with 9 none
        rows = [(f"v{i}", v.tolist()) for i, v in enumerate(x)] + [(f"c{i}", x[0].tolist()) for i in range(n - 1)] + [("v1", x[1].tolist())]
        frame = spark.createDataFrame(rows, "id string, embedding array<float>")
        ids, vectors = [r[0] for r in rows[:-1]], np.array([r[1] for r in rows[:-1]], np.float32).astype(float)
        for most in (500_000, 0):
            links = similar_vectors.nearest(frame, dim=16, cells=1, broadcast_rows=most)
            assert {(r.id_a, r.id_b) for r in similar_vectors.similar_pairs(links, similar_vectors.members(frame, dim=16), -1).collect()} == brute_pairs(ids, vectors, 5, -1)


def test_bounds_hold():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((300, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    codes = similar_vectors.Codes(x, x[:50].mean(0), similar_vectors.rotation(64))
    estimate, off = codes.bounds(np.arange(40), 2.5)
    assert (np.abs(estimate - x[:40] @ x.T) <= off).mean() > 0.97


def brute_shared(texts, least):
    where = {}
    for d, t in texts.items():
        for i in range(len(t) - least + 1):
            where.setdefault(t[i : i + least], set()).add(d)
    several = {w: d for w, d in where.items() if len(d) > 1}
    pairs = {(a, b) for d in several.values() for a in d for b in d if a < b}
    covered = {}
    for d, t in texts.items():
        mark = np.zeros(len(t), bool)
        for i in range(len(t) - least + 1):
            if t[i : i + least] in several:
                mark[i : i + least] = True
        covered[d] = int(mark.sum())
    return pairs, covered


def test_shared_spans_equal_brute_force(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdé漢🙂 ") for _ in range(rng.randint(20, 80)))
    pool = [word() for _ in range(12)] + ["a" * 90, "ab" * 50]
    texts = {i: "".join(rng.choice(pool) if rng.random() < 0.5 else word() for _ in range(rng.randint(0, 6))) for i in range(60)}
    texts[60] = texts[61] = texts[3] + texts[4]
    texts[62] = "z" * 39
    frame = spark.createDataFrame([*[(i, t, 1, "c") for i, t in texts.items()], (63, None, 1, "c"), (61, texts[61], 1, "c"), (None, texts[61], 1, "c")], "doc_id bigint, text string, number int, same string")
    pairs, covered = brute_shared(texts, 40)
    assert {(r.doc_id_a, r.doc_id_b) for r in shared_spans.shared_pairs(frame, least=40, k=21).collect()} == pairs
    got = {r.doc_id: r for r in shared_spans.shared_share(frame, least=40, k=21).collect()}
    assert {d: got[d].shared_chars for d in texts} == covered and got[63].shared_share == 0
    assert shared_spans.shared_pairs(frame.limit(0)).count() == 0


def test_hot_nodes_change_nothing(spark, monkeypatch):
    rng = random.Random(9)
    common = "".join(rng.choice("abcdefg ") for _ in range(90))
    texts = {i: "".join(rng.choice("abcdefgh ") for _ in range(60)) + (common if i % 3 else "") for i in range(40)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    pairs, _ = brute_shared(texts, 40)
    every = lambda nodes: [r.h for r in nodes.groupBy("h").count().where("count > 5").collect()]
    monkeypatch.setattr(shared_spans, "_hot_nodes", every)
    assert {(r.doc_id_a, r.doc_id_b) for r in shared_spans.shared_pairs(frame, least=40, k=21).collect()} == pairs
    spans = shared_spans.span_members(frame, least=40, k=21).collect()
    by_span = {}
    for r in spans:
        by_span.setdefault(r.span, set()).add((r.class_id, texts[r.class_id][r.char_start : r.char_start + r.n_chars]))
    assert all(len({t for _, t in rows}) == 1 and len(rows) > 1 for rows in by_span.values())
    assert {(a[0], b[0]) for rows in by_span.values() for a in rows for b in rows if a[0] < b[0]} == pairs
    copies = spark.createDataFrame([(1, "x" * 50), (2, "x" * 50), (3, "y" * 50), (4, "x"), (2, "x" * 50)], "doc_id bigint, text string")
    assert sorted(map(tuple, shared_spans.text_classes(copies, least=40).collect())) == [(1, 1, 2), (2, 1, 2), (3, 3, 1)]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abc", max_size=120), st.integers(1, 40))
def test_window_hashes_follow_the_text(text, length):
    points = shared_spans._points(text)
    got = shared_spans.window_hashes(points, length)
    windows = [text[i : i + length] for i in range(len(text) - length + 1)]
    assert len(got) == len(windows) and len({(w, h) for w, h in zip(windows, got.tolist())}) == len(set(windows)) == len(set(got.tolist()))
