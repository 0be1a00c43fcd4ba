import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillspark.llm import corpus_encoding, packing, pieces, token_budget

TEXTS = [None, "", " ", "\n\n \t x", "Hello world's   best", "naïve été 漢字 🙂🙂", "<|endoftext|> is text", "a" * 5000, "it's 12345 _-_  ​\r\n end ", "Hello world's   best"]


def frame(spark):
    return spark.createDataFrame([(i, t, "clash", "clash", 1) for i, t in enumerate(TEXTS)], "doc_id bigint, text string, word string, _block string, ids int")


def test_encoding_equals_direct_encoding(spark):
    encode = pieces.encoding().encode_ordinary
    got = {r.doc_id: list(r.ids) for r in corpus_encoding.encode_corpus(frame(spark)).collect()}
    assert got == {i: encode(t or "") for i, t in enumerate(TEXTS)}
    assert corpus_encoding.encode_corpus(frame(spark).limit(0)).count() == 0


def test_round_trip(spark):
    encoded = corpus_encoding.encode_corpus(frame(spark))
    assert {r.doc_id: r.text for r in corpus_encoding.decode_corpus(encoded).collect()} == {i: t or "" for i, t in enumerate(TEXTS)}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=12), max_size=8))
def test_prefix_counter_equals_encoder(texts):
    counter, one = token_budget.PrefixCounter(), pieces.encoding()._encode_single_piece
    words = sorted({t.encode() for t in texts if t} | {b" the", b" then", b" thesis", b"\xe6\xbc"})
    assert [counter.tokens(w) for w in words] == [len(one(w)) for w in words]


def test_counter_on_all_pieces_of_the_vocabulary():
    counter, one = token_budget.PrefixCounter(), pieces.encoding()._encode_single_piece
    some = sorted(random.Random(1).sample(sorted(pieces.ranks()), 4000))
    words = sorted({a + b for a, b in zip(some, reversed(some))})
    assert all(counter.tokens(w) == len(one(w)) for w in words)


def test_settled_tokens(spark):
    rows = [("a", 1, 5, "word " * 40, "news"), ("a", 2, None, "word " * 40, "news"), ("b", 1, 41, "word " * 40, "NEWS"), ("c", 1, 1, "short", None), ("d", 1, 1, None, "x"), ("e", 1, None, " " * 200, "x"), (None, 1, 1, "word " * 40, "x")]
    chunks = spark.createDataFrame([(i, t, n, x, s, "l", "d") for i, t, n, x, s in rows], "id string, crawl_ts int, tokens int, text string, source_type string, lang string, domain string")
    settled = token_budget.settled_tokens(chunks)
    assert {r.id for r in token_budget.badly_stated(settled).collect()} == {"a"}
    assert settled.count() == 5
    totals = {r.source_type: r.n_chunks for r in token_budget.token_totals(settled).collect()}
    assert totals == {"news": 2, "unknown": 1, "x": 2}
    assert token_budget.settled_tokens(chunks.limit(0)).count() == 0


def plain_best_fit(sizes, capacity):
    gaps = []
    for s in sorted(sizes, reverse=True):
        fit = [g for g in gaps if g >= s]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - s)
        else:
            gaps.append(capacity - s)
    return sorted(gaps)


@settings(max_examples=120, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=80))
def test_rounds_equal_one_by_one_best_fit(sizes):
    counts = {s: sizes.count(s) for s in set(sizes)}
    slots, opened = packing.best_fit_rounds(counts, 30)
    used, ranks = [0] * opened, {s: [] for s in counts}
    slots.sort(key=lambda s: (s[0], s[1]))
    for i, (size, rank, first, each) in enumerate(slots):
        after = [s[1] for s in slots[i + 1 :] if s[0] == size][:1] or [counts[size]]
        for r in range(rank, after[0]):
            used[first + (r - rank) // each] += size
            ranks[size].append(r)
    assert all(sorted(v) == list(range(counts[s])) for s, v in ranks.items())
    assert sorted(30 - u for u in used) == plain_best_fit(sizes, 30)


def test_repeated_and_null_keys_never_share_a_full_container(spark):
    rows = [(1, 250), (1, 250), (None, 250), (None, 100), (2, 30), (2, 30), (3, None)]
    frame = spark.createDataFrame(rows, "doc_id int, n_tokens int")
    packed = packing.pack(frame, {"a": 100, "b": 1000})
    fill = {}
    for r in packed.collect():
        if r.container_id:
            fill[r.container_id] = fill.get(r.container_id, 0) + r.n_tokens
    assert max(v for k, v in fill.items() if k[0] == "a") <= 100 and sum(v for k, v in fill.items() if k[0] == "a") == 910
    assert {(r.pack_kind, r.n_items, r.n_overfull, r.n_misplaced) for r in packing.faults(packed, frame, {"a": 100, "b": 1000}).collect()} == {("a", 7, 0, 0), ("b", 7, 0, 0)}
    lost = packed.where("container_id is null or not container_id like 'a-%' or doc_id <> 2 or doc_id is null")
    assert {(r.pack_kind, r.n_misplaced) for r in packing.faults(lost, frame, {"a": 100, "b": 1000}).collect()} == {("a", 1), ("b", 0)}


def test_blocks_are_bounded(spark):
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"x": pa.array([["a"] * n if n is not None else None for n in (3, None, 0, 9, 1, 1, 30, 2)])})
    got = [b.column("x").to_pylist() for b in pieces._of_bounded_size(iter([batch]), "x", 10)]
    assert sum(got, []) == batch.column("x").to_pylist() and all(len(b) == 1 or sum(len(x or ()) for x in b) <= 20 for b in got) and len(got) > 2
    coded = pieces.coded_blocks(frame(spark), ["doc_id"], "text", most=5)[0]
    assert coded.count() == len(TEXTS) and coded.select("_block").distinct().count() > 2


def test_packing_keeps_every_item_whole(spark):
    rng = random.Random(2)
    sizes = [(i, rng.choice([0, None, 7, 7, 7, rng.randint(1, 25)])) for i in range(400)]
    rows = packing.pack(spark.createDataFrame(sizes, "doc_id int, n_tokens int"), {"s": 10, "l": 40}).collect()
    for kind, cap in (("s", 10), ("l", 40)):
        mine = [r for r in rows if r.pack_kind == kind]
        fill, total = {}, {}
        for r in mine:
            total[r.doc_id] = total.get(r.doc_id, 0) + r.n_tokens
            if r.container_id:
                fill[r.container_id] = fill.get(r.container_id, 0) + r.n_tokens
        assert total == {i: n or 0 for i, n in sizes} and max(fill.values()) <= cap
        parts = {}
        for r in mine:
            parts.setdefault(r.doc_id, []).append((r.first_token, r.n_tokens))
        assert all(len(p) == 1 or dict(sizes)[d] > cap for d, p in parts.items())
        assert len(fill) <= 1.25 * sum(total.values()) / cap + 1
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame(sizes, "doc_id int, n_tokens int"), {"s": 0})
