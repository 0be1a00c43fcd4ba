import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspark.functions import chunk_model, cleaning, hashing, pii, rights, semantics, signals, urls


def one(spark, values, expression, schema="x string"):
    """Results of an expression for single values, nulls included."""
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, " + schema)
    return [r.y for r in rows.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_canonical_url(spark):
    given_ = ["HTTP://EX.org:80/A/?b=2&a=1#f", "https://ex.org", "https://Ex.org:443/x//", "http://ex.org:8080/", "", None, "not a url"]
    assert one(spark, given_, urls.canonical_url) == ["http://ex.org/a?a=1&b=2", "https://ex.org/", "https://ex.org/x", "http://ex.org80/", "/", None, "not a url"]


@settings(max_examples=5, suppress_health_check=[HealthCheck.function_scoped_fixture], deadline=None)
@given(st.lists(st.text(alphabet="abA/?&=#:.é", max_size=30), min_size=20, max_size=40))
def test_canonical_url_is_stable(spark, texts):
    once = one(spark, [f"https://a.example/{t}" for t in texts], urls.canonical_url)
    assert one(spark, once, urls.canonical_url) == once


def test_url_parts_and_identifiers(spark):
    parts = one(spark, ["https://www.Ex.org/a/b#top", "https://ex.org"], urls.url_components)
    assert [(p.domain, p.path, p.ref_fragment) for p in parts] == [("Ex.org", "/a/b", "top"), ("ex.org", "/", None)]
    assert one(spark, ["https://ex.org/", "https://ex.org"], urls.doc_id)[0] == one(spark, ["https://ex.org"], urls.doc_id)[0]
    assert one(spark, ["a.PDF", "b", None], urls.detect_format) == ["pdf", "html", None]


def test_chunk_ids_keep_large_indices(spark):
    assert one(spark, [7, 123456], lambda x: hashing.chunk_id(F.lit("d"), x, F.lit("t")), "x int") == ["d#00007-" + "8efd86fb", "d#123456-8efd86fb"]


def test_source_type_and_confidence(spark):
    told = one(spark, ["https://github.com/x", "https://a.edu/flaw", "https://x.example/law", "https://x.example/docs/a", None], lambda x: urls.source_type(x, F.lit("plain")))
    assert told == ["code", "academic", "legal", "official_docs", None]
    assert one(spark, ["official_docs", "log", "strange", None], lambda x: urls.source_confidence(F.lit("a.org"), x)) == pytest.approx([1.0, 0.66, 0.88, 0.88])


def test_simhash_is_stable_and_ignores_case(spark):
    a, b, empty, null = one(spark, ["Some words here", "some WORDS here", "", None], hashing.simhash)
    assert a == b != 0 and empty == null == 0


@pytest.mark.parametrize("text, reason", [(None, "empty"), ("few words", "too_short"), ("word " * 60, "few_sentences"), ("one two. " * 30, "short_sentences"), ("see https://a.b/c now and then we go on with it. " * 9, "urls"), ("a fine sentence has many words in it. " * 9 + "Intro ... 5", "toc"), ("a fine sentence has many words in it. " * 9, "")])
def test_document_signal(spark, text, reason):
    assert one(spark, [text], signals.document_signal)[0].reason == reason


def test_chunk_signal_order(spark):
    given_ = ["Main menu", "Copyright. All rights reserved.", "Contents of it", "sponsored", "short", "12 34 !! " * 9, "a fine sentence has many words in it and goes on for long", None]
    assert [r.reason for r in one(spark, given_, signals.chunk_signal)] == ["nav", "footer", "toc", "ads", "too_short", "non_text", "", "too_short"]


def test_retrieval_weight_bounds(spark):
    assert one(spark, ["x" * 99, "x" * 100, "x" * 2000, "x" * 2001], lambda x: signals.retrieval_weight(x, F.lit(None), F.lit("simple"))) == pytest.approx([0.7, 1.0, 1.0, 1.05])
    assert one(spark, ["x" * 3000], lambda x: signals.retrieval_weight(x, F.lit("FAQ"), F.lit("structured")))[0] <= 1.5


def test_features_and_modality(spark):
    f = one(spark, ["# A\n## B\n# A\n```\nx\n```\n- one\nwww.a.b", None], signals.content_features)
    assert f[0].headings == ["A", "B"] and f[0].has_code and f[0].has_list and not f[0].has_table and f[0].links_out == 1
    assert f[1].headings == [] and f[1].links_out == 0
    kinds = one(spark, ['{"a": 1}', "{broken", "$a$ $b$ $c$", "plain", None], lambda x: signals.modality(x, F.lit(False), F.lit(False)))
    assert kinds == ["metadata", "text", "equation", "text", "text"]


def test_validation_rules(spark):
    rows = one(spark, [None, " \n", "short", "same line\n" * 8, "https://a " * 11 + "x" * 50, "[CODE]" + "x" * 100 + "[/CODE]", "Chapter . . . 12 " + "x" * 60], signals.validation)
    assert [r.issues for r in rows] == [["empty"], ["empty"], ["too_short"], [], [], [], []]
    assert [r.section_type for r in rows] == [None, None, None, None, "references", "code", "toc"]
    assert rows[3].warnings == ["line_repetition"] and rows[4].is_low_signal


def test_warnings_need_three_terms(spark):
    assert one(spark, ["diagnosis and treatment", "diagnosis, treatment, symptom", None], signals.content_warnings) == [[], ["medical"], []]


def test_semantics(spark):
    assert one(spark, ["sql query index api html css", None], semantics.topics) == [["database", "web_development"], []]
    assert one(spark, ["def f(x):", "```python\nimport os\n```", None], semantics.code_languages)[0] == ["python"]
    assert one(spark, ["5 kg, 10 MB and 3 days", None], semantics.units) == [["kg", "MB", "days"], []]
    cited = one(spark, ['doi:10.1/x.y [Smith et al., 2020]\nReferences\n"A title of some length" (2019)'], semantics.citations)[0]
    assert [(c.doi, c.year, c.title) for c in cited] == [("10.1/x.y", None, None), (None, 2020, None), (None, 2019, "A title of some length")]
    table = one(spark, ["|a|b|\n|-|-|\n|1|2|", "<table><tr><th>h</th></tr><tr><td>1</td></tr></table>", "a | b"], semantics.table_schema)
    assert [c.name for c in table[0].columns] == ["a", "b"] and table[0].rows == 1 and table[1].rows == 1 and table[2] is None
    found = semantics.entities_of("On 2020-01-02 John Smith of Acme Corp paid 5 USD")
    assert [e["type"] for e in found][0] == "DATE" and all(a["end"] <= b["start"] for a, b in zip(found, found[1:]))
    assert one(spark, ["Jane Roe met John Smith", None, ""], semantics.entities)[0][0].text == "Jane Roe"


def test_pii_flags_and_masks(spark):
    text = "Write to a.b@c.org or (555) 123-4567, card 4111 1111 1111 1111, ip 8.8.8.8 and 127.0.0.1"
    flags = one(spark, [text, None, "ip 10.0.0.1"], pii.pii_flags)
    assert (flags[0].email, flags[0].phone, flags[0].credit_card, flags[0].ip_address) == (True, True, True, True)
    assert not any(flags[1].asDict().values()) and not flags[2].ip_address
    masked = one(spark, [text, None], pii.redact_pii)
    assert "[EMAIL_REDACTED]" in masked[0] and "[IP_REDACTED]" in masked[0] and "127.0.0.1" in masked[0] and masked[1] is None
    assert not any(x.email for x in one(spark, masked, pii.pii_flags))


def test_rights(spark):
    assert [r.license for r in one(spark, ["Creative Commons Attribution", "All rights reserved", "", None], rights.detect_license)] == ["CC-BY-4.0", "proprietary", "", ""]
    assert one(spark, ["CC-BY-SA-4.0", "MIT", None], rights.requires_attribution) == [True, False, False]
    r = one(spark, ['<meta name="robots" content="NoIndex, nofollow">', "", None], rights.robots)
    assert (r[0].noindex, r[0].nofollow, r[1].noindex, r[2].nofollow) == (True, True, False, False)
    dates = one(spark, ["2020-01-02T03:04:05", "March 5, 2021", "nothing", None], lambda x: rights.metadata_date(F.create_map(F.lit("created_at"), x), rights.PUBLISHED))
    assert dates == [datetime.datetime(2020, 1, 2, 3, 4, 5), datetime.datetime(2021, 3, 5), None, None]


def test_chunk_rules(spark):
    rows = spark.createDataFrame([("d#0-a", "d", "t", "text", "html", "news", 0.5, 0, 1), (None, "", None, "x", "y", None, 2.0, 3, 2)], "id string, doc_id string, text string, modality string, format string, source_type string, retrieval_weight double, chunk_index int, total_chunks int")
    got = [r.i for r in rows.select(chunk_model.chunk_issues(set(rows.columns)).alias("i")).collect()]
    assert got[0] == [] and got[1] == ["missing_id", "missing_doc_id", "retrieval_weight", "chunk_index", "source_type", "modality", "format"]
    assert one(spark, ["the cat and the dog", "der Hund und die Katze", "", None], chunk_model.detect_language) == ["en", "de", "en", "en"]


def test_cleaning_steps(spark):
    assert one(spark, ["infor-\nmation", "youcan", "read - only", "end.Next", "a • b", None], cleaning.fix_hyphenation) == ["information", "you can", "read-only", "end. Next", "a - b", None]
    assert one(spark, ["Page 3 of 9\nCopyright Acme 2020 text\n12\nbody"], cleaning.strip_headers_footers) == ["text\nbody"]
    assert one(spark, ["---\ntitle: x\n---\nBody", "Skip to main content Body", "author: me\nBody"], cleaning.strip_frontmatter) == ["Body"] * 3
    assert one(spark, ["a ,b:c"], cleaning.polish_sentences) == ["a, b: c"]
    assert one(spark, ["```py\nx\n```"], cleaning.clean_special_sections) == ["\n[CODE]\nx\n\n[/CODE]\n"]


def test_technical_content_survives(spark):
    text = "See https://a.example/x-y?z=1,2;3 and me@a.example, /usr/lib/x.so or one-two-three."
    held, kept = cleaning.preserved(text)
    assert "https" not in held and cleaning.restored(held, kept) == text
    rows = cleaning.cleaned(spark.createDataFrame([(text * 3,), (None,), ("",)], "text string")).select("_clean.*").collect()
    assert "https://a.example/x-y?z=1,2;3" in rows[0].text and rows[0].is_valid
    assert rows[1].text == rows[2].text == "" and not rows[1].is_valid
