import io
import zipfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspark.operators import chunking, dedup, extraction, html, reports, routing, state, vectors
from quillspark.plans import pipeline
from quillspark.sources import fetching, lists, sinks


def test_windows_match_a_plain_loop(spark):
    options = chunking.ChunkOptions(10, 3, 2)
    texts = {i: " ".join(map(str, range(i))) for i in (0, 1, 2, 9, 10, 11, 17, 18, 24, 25, 40)}
    rows = chunking.window_chunks(spark.createDataFrame(list(texts.items()), "doc_id int, text string"), options=options).collect()

    def plain(text):
        w = text.split()
        if len(w) <= 10:
            return [w] if len(w) >= 2 else []
        out, at = [], 0
        while True:
            if len(w[at : at + 10]) >= 2:
                out.append(w[at : at + 10])
            if at + 10 >= len(w):
                return out
            at += 7

    got = {i: [r.text.split() for r in sorted(rows, key=lambda r: r.chunk_index) if r.doc_id == i] for i in texts}
    assert got == {i: plain(t) for i, t in texts.items()}
    with pytest.raises(ValueError):
        chunking.ChunkOptions(10, 10)


_SAMPLE = st.lists(st.sampled_from(["# Head", "## Sub", "#### Deep", "", "word " * 5, "Some sentence here. Another one follows now! " * 6, "x" * 30 + " " + "y " * 80]), max_size=12)


@settings(max_examples=60, deadline=None)
@given(_SAMPLE, st.booleans())
def test_structure_chunks_keep_limits_and_words(lines, strict):
    chunker = chunking.StructureChunker(chunking.ChunkOptions(40, 8, 3, strict))
    for c in chunker.chunks("\n".join(lines), "Title"):
        assert 3 <= c["tokens"] <= 40 and c["title"].startswith("Title")


def test_kept_chunks_and_vectors_come_back(spark, tmp_path):
    at = F.lit("2024-06-30 00:00:00").cast("timestamp_ntz")
    sources = spark.createDataFrame([("a", "u", "t", "{}"), ("b", None, "t", None)], "id string, url string, title string, tags string")
    named = state.sources_hash(sources)
    assert named == state.sources_hash(sources.orderBy(F.desc("id"))) != state.sources_hash(sources.withColumn("title", F.lit("x"))) and named != state.sources_hash(sources.limit(1))
    chunks = spark.createDataFrame([("1", "x", [1.0], "m", 1), ("2", "y", None, None, None)], "id string, text string, embedding array<float>, embedding_model string, embedding_dim int")
    folder = str(tmp_path / "kept")
    state.keep_chunks(chunks, folder, "s1", named, at)
    state.keep_chunks(chunks.limit(1), folder, "s2", named, at)
    state.keep_chunks(chunks, folder, "s1", named, at)
    assert {r.id for r in state.kept_chunks(spark, folder, "s1", named, at).collect()} == {"1", "2"} and state.kept_chunks(spark, folder, "s1", named, at).count() == 2
    assert state.kept_chunks(spark, folder, "s1", "other", at).count() == 0 and state.kept_chunks(spark, folder, "s1", named, at + F.expr("interval 2 days")).count() == 0
    vectors_at = str(tmp_path / "vectors")
    state.keep_embeddings(chunks, vectors_at)
    state.keep_embeddings(chunks, vectors_at)
    assert [(r.id, r.embedding) for r in state.reuse_embeddings(chunks, spark.read.parquet(vectors_at), "m").orderBy("id").collect()] == [("1", [1.0]), ("2", None)]
    sinks.write_chunks(chunks.withColumn("category", F.lit("News")), str(tmp_path / "out"), per="id")
    assert (tmp_path / "out/chunks/category=news/subcategory=documents/file=1").exists()
    assert {(r.id, r.text, None if r.embedding is None else tuple(r.embedding)) for r in sinks.read_chunks(spark, str(tmp_path / "out")).collect()} == {("1", "x", (1.0,)), ("2", "y", None)}


def test_repeated_rows_and_urls_keep_their_own_chunks(spark):
    from datetime import datetime

    text = "# Head\n" + "good words go on here and there. " * 60
    rows = [("https://a.example/x", text), ("https://a.example/x", text), ("https://a.example/x", "other words stand in this one. " * 40), (None, text)]
    options = chunking.ChunkOptions(60, 10, 5)
    one = pipeline.to_chunks(spark.createDataFrame(rows[:1], "url string, text string"), datetime(2024, 6, 30), options).count()
    other = pipeline.to_chunks(spark.createDataFrame(rows[2:3], "url string, text string"), datetime(2024, 6, 30), options).count()
    every = pipeline.to_chunks(spark.createDataFrame(rows, "url string, text string"), datetime(2024, 6, 30), options)
    assert every.count() == 3 * one + other and one > 1


def test_dates_of_metadata(spark):
    from quillspark.functions import rights

    rows = [({"datePublished": "2024-05-06", "validFrom": "May 7, 2024", "end_date": "2025-01-01T10:00:00"},), ({"effective_date": "soon"},), (None,)]
    got = [tuple(None if x is None else str(x) for x in r.t) for r in spark.createDataFrame(rows, "m map<string,string>").select(rights.temporal(F.col("m")).alias("t")).collect()]
    assert got == [("2024-05-06 00:00:00", None, "2024-05-07 00:00:00", "2025-01-01 10:00:00"), (None,) * 4, (None,) * 4]


def test_near_duplicates_equal_brute_force(spark):
    from quillspark.functions import hashing

    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
    rows = [(i, " ".join(words[: 12 + i % 3] + [f"w{i // 4}"] * (i % 2) + words[14:])) for i in range(60)] + [(60, None), (61, "")]
    frame = spark.createDataFrame(rows, "doc_id int, text string")
    prints = {}
    for r in frame.select("doc_id", hashing.simhash(F.col("text")).alias("p")).collect():
        if r.p:
            prints.setdefault(r.p & (2**64 - 1), r.doc_id)
    expected = {(min(a, b), max(a, b), bin(x ^ y).count("1")) for x, a in prints.items() for y, b in prints.items() if x < y and bin(x ^ y).count("1") <= 3}
    assert {tuple(r) for r in dedup.near_duplicate_classes(frame).collect()} == expected


def test_headings_clear_deeper_ones():
    s = chunking.sections_of("# A\n## B\ntext\n# C\nmore", "T")
    assert [(x.heading, x.parents) for x in s if x.heading] == [("T", []), ("A", []), ("B", ["A"]), ("C", [])]
    assert s[-1].parents == ["C"] and chunking.sections_of("") == []


def test_structure_chunks_of_dirty_rows(spark):
    rows = spark.createDataFrame([(1, None, None, 5), (2, "  \n", "t", 6), (3, "word " * 60, None, 7), (4, "# H\n" + "good words go on here. " * 20, "T", 8)], "doc_id int, text string, title string, tokens int")
    got = chunking.structure_chunks(rows, options=chunking.ChunkOptions(50, 10, 5)).collect()
    assert {r.doc_id for r in got} == {3, 4} and all(r.tokens <= 50 for r in got)
    for d in (3, 4):
        mine = [r for r in got if r.doc_id == d]
        assert sorted(r.chunk_index for r in mine) == list(range(mine[0].total_chunks))
    assert chunking.structure_chunks(rows.limit(0)).count() == 0


def test_first_of_each(spark):
    rows = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, None, "x"), (4, None, "x"), (5, "a", "x")], "k int, text string, g string")
    assert sorted(r.k for r in dedup.first_of_each(rows, "text", "k").collect()) == [1, 3]
    assert sorted(r.k for r in dedup.first_of_each(rows, "text", "k", "g").collect()) == [1, 2, 3]


def test_near_duplicates_match_all_pairs(spark):
    base = "the quick brown fox jumps over the lazy dog and runs through many green fields every single day " * 4
    texts = [base, base + "x", base.replace("fox", "cat"), "entirely different words stand here", base, None, ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    from quillspark.functions.hashing import simhash

    prints = {r.doc_id: r.p for r in rows.select("doc_id", simhash(F.col("text")).alias("p")).collect()}
    first = {}
    for d in sorted(prints):
        if prints[d]:
            first.setdefault(prints[d], d)
    expected = {(a, b) for a in first.values() for b in first.values() if a < b and bin((prints[a] ^ prints[b]) & (2**64 - 1)).count("1") <= 3}
    assert {(r.doc_id_a, r.doc_id_b) for r in dedup.near_duplicate_classes(rows).collect()} == expected


def test_routing(spark):
    rows = spark.createDataFrame([("a", "http://x/a.pdf", None), ("b", "http://x/b", "text/html; charset=utf-8"), ("c", "http://x/c.png", "image/png"), ("d", "http://x/d.zzz", None), ("e", None, "application/json")], "id string, url string, content_type string")
    got = {r.id: (r.kind, r.method, r.processing) for r in routing.routed(rows).collect()}
    assert got == {"a": ("pdf", "extract_pdf", "pdf"), "b": ("html", "extract_html", "html"), "e": ("json", "extract_json", "data")}
    assert routing.routed(rows, ocr=True).where("id = 'c'").first().method == "extract_image_ocr"


def _zip(**files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in files.items():
            z.writestr(name.replace("__", "/").replace("_xml", ".xml"), text)
    return out.getvalue()


W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
A = 'xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:p="http://schemas.openxmlformats.org/presentationml/2006/main"'
S = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def test_extractors(spark):
    docx = _zip(word__document_xml=f"<w:document {W}><w:body><w:p><w:r><w:t>One</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>a</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>b</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>")
    pptx = _zip(ppt__slides__slide1_xml=f"<p:sld {A}><p:txBody><a:p><a:r><a:t>Hi</a:t></a:r></a:p></p:txBody></p:sld>", ppt__slides__slide2_xml=f"<p:sld {A}><p:txBody><a:p><a:r><a:t>Yo</a:t></a:r></a:p></p:txBody></p:sld>")
    xlsx = _zip(xl__workbook_xml=f'<workbook {S}><sheets><sheet name="S"/></sheets></workbook>', xl__worksheets__sheet1_xml=f'<worksheet {S}><sheetData><row><c r="A1" t="inlineStr"><is><t>n</t></is></c><c r="C1"><v>12</v></c></row></sheetData></worksheet>')
    cases = [
        ("extract_docx", docx, "One\n\na | b"), ("extract_pptx", pptx, "Hi\n\n---\n\nYo"), ("extract_xlsx", xlsx, "## Sheet: S\nn    12"), ("extract_json", b'{"a":"\xc3\xa9"}', '{\n  "a": "é"\n}'),
        ("extract_json", b"{bad", "{bad"), ("extract_csv", b"a,bb\n1,2\n", "a  bb\n1   2"), ("extract_text", b"a\xffb", "ab"), ("extract_html", b"<article><p>Hello</p></article>", "Hello"), ("extract_docx", b"broken", None), ("extract_pdf", b"x", None), ("extract_text", None, None),
    ]
    rows = spark.createDataFrame([(i, m, bytearray(c) if c is not None else None, "clash") for i, (m, c, _) in enumerate(cases)], "i int, method string, content binary, text string")
    got = {r.i: (r.text, r.error) for r in extraction.with_text(rows).collect()}
    assert {i: got[i][0] for i in got} == {i: t for i, (_, _, t) in enumerate(cases)}
    assert got[8][1] and got[9][1] == "no extractor extract_pdf" and got[10][1] is None


def test_html_text_and_metadata():
    page = """<html lang="de"><head><title> T </title><meta property="og:title" content="O"><meta name="author" content="Me"><script type="application/ld+json">{"@type":"Article","headline":"H","author":{"name":"N"}}</script></head>
    <body><nav><p>Nav</p></nav><div class="cookie-x"><p>Cookies</p></div><main><h1>Head</h1><p>Read more</p><ul><li>one<li><p>two</p></ul><!-- note --><table><tr><td>cell</td></tr></table></main><footer>F</footer></body></html>"""
    got = html.extracted(page)
    assert got["text"] == "Head one two two cell"
    m = got["metadata"]
    assert (m["title"], m["language"], m["author"], m["open_graph"], m["schema_org"]["author"]) == ("T", "de", "Me", {"og_title": "O"}, "N")
    assert html.extracted(None)["text"] == html.extracted("")["text"] == "" and html.extracted("<p>a</b><p>b")["text"] == "a b"


def test_reports_on_dirty_and_empty_tables(spark):
    checks = spark.createDataFrame([("a", True, 200, None, None, 1, 1), ("a", False, None, None, "refused", 2, 2), ("a", False, None, None, "refused", 2, 2), (None, True, 200, None, None, 3, 3), ("b", True, 200, None, None, 1, 1)], "id string, accessible boolean, status_code int, content_type string, error string, checked_at int, arrived_at int")
    sources = spark.createDataFrame([("a", "u", "t", '{"category": "x"}'), ("a", "u", "t", '{"category": "x"}'), ("b", "u", None, "broken"), (None, None, None, None)], "id string, url string, title string, tags string")
    assert {(r.category, r.sources, r.accessible, r.success_rate) for r in reports.accessibility(sources, checks).collect()} == {("x", 1, 0, 0.0), ("general", 1, 1, 100.0)}
    assert [(r.reason, r.n) for r in reports.failure_reasons(checks).collect()] == [("refused", 1)]
    assert reports.accessibility(sources.limit(0), checks.limit(0)).count() == 0


def test_state(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "id string")
    known = spark.createDataFrame([("a",), ("a",), (None,)], "id string")
    assert {r.id for r in state.not_yet_known(rows, known, "id").collect()} == {"b", None} and {r.id for r in state.already_known(rows, known, "id").collect()} == {"a"}
    assert state.settings_hash({"a": 1, "b": 2}) == state.settings_hash({"b": 2, "a": 1}) != state.settings_hash({"a": 2, "b": 2})
    vectors_ = spark.createDataFrame([("a", [1.0], "m"), ("a", [1.0], "m"), ("b", [], "m"), ("b", [2.0], "old")], "id string, embedding array<float>, embedding_model string")
    assert {(r.id, r.embedding is None) for r in state.reuse_embeddings(rows, vectors_, "m").collect()} == {("a", False), ("b", True)}


def test_embedding_failures_are_null(spark):
    def embed(texts):
        if any("bad" in t for t in texts):
            raise RuntimeError
        return vectors.hashing_embedder(8)(texts)

    rows = spark.createDataFrame([(i, t) for i, t in enumerate(["good one", "bad", None, "good two"])], "i int, text string").coalesce(1)
    got = {r.i: r for r in vectors.with_embeddings(rows, embed, "m", batch=1).collect()}
    assert [got[i].embedding is None for i in range(4)] == [False, True, True, False] and got[0].embedding_dim == 8 and got[1].embedding_model is None


def test_most_similar_matches_brute_force(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [1.0])], "k int, embedding array<float>")
    assert [r.k for r in vectors.most_similar(rows, [1.0, 0.1], "k", k=3).collect()] == [1, 3, 2]


def test_sources_fetching_and_sinks(spark, tmp_path):
    listed = tmp_path / "s.yaml"
    listed.write_text("- {id: a, url: http://a, title: A, tags: {category: X, n: [1, 2]}}\n- {url: http://b, title: B}\n- text\n- {id: c, url: http://c, title: C}\n")
    sources = lists.read_source_list(spark, str(listed))
    assert [(r.id, r.tags) for r in sources.orderBy("id").collect()] == [("a", '{"category": "X", "n": [1, 2]}'), ("c", "{}")]

    def fetch(url, timeout):
        if url.endswith("c"):
            raise OSError("down")
        return b"<article><p>" + b"Some words of a page go on. " * 30 + b"</p></article>", "text/html"

    got = {r.id: r for r in fetching.fetched(sources, fetch, retries=2, delay=0, tasks=2).collect()}
    assert got["a"].error is None and got["c"].content is None and "down" in got["c"].error
    assert [(r.id, r.accessible) for r in fetching.verified(sources, lambda u, t: (200 if u.endswith("a") else 404, ""), tasks=2).collect()] == [("a", True), ("c", False)]
    kept = spark.createDataFrame([("http://a",)], "url string").select(state.url_key(F.col("url")).alias("url_key"))
    assert [r.id for r in fetching.to_fetch(sources, kept).collect()] == ["c"]

    files = fetching.fetched(sources, fetch, retries=1, delay=0, tasks=1)
    from datetime import datetime

    chunks = pipeline.to_chunks(pipeline.to_documents(files), datetime(2024, 1, 1), chunking.ChunkOptions(60, 10, 5), "full").withColumn("category", F.lit("Big"))
    assert chunks.count() > 1 and chunks.where("not is_valid").count() == 0
    out = str(tmp_path / "out")
    sinks.write_chunks(chunks, out)
    sinks.write_chunks(chunks.withColumn("category", F.lit("small")), out)
    assert {r.category for r in spark.read.json(f"{out}/chunks").select("category").distinct().collect()} == {"big", "small"}


def test_streaming(spark, tmp_path):
    from quillspark.streaming import ingest

    folder = str(tmp_path / "in")
    rows = spark.createDataFrame([("a", "x", 0), ("a", "x", 1), ("b", "x", 2), (None, "y", 3)], "text string, domain string, s int").withColumn("crawl_ts", F.timestamp_seconds(F.col("s"))).drop("s")
    rows.write.parquet(folder)
    stream = ingest.first_deliveries(ingest.document_stream(spark, folder, rows.schema))
    seen = []
    ingest.run_available(stream, lambda df, n: seen.extend(df.collect()), str(tmp_path / "cp")).awaitTermination(120)
    assert sorted(str(r.text) for r in seen) == ["None", "a", "b"]
    assert ingest.arrivals(ingest.document_stream(spark, folder, rows.schema)).isStreaming
