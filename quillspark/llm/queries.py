"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import corpus_encoding, languages, packing, page_body, personal_data, repeated_lines, scanned_text, shared_spans, similar_vectors, token_budget
from quillspark.llm.staging import staged
from quillspark.sources.tables import table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_lines.repeated_lines(table(spark, folder, "chunks"))


def p1_cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_lines.without_repeated_lines(table(spark, folder, "chunks"))


def p1_sequences(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_lines.frequent_sequences(table(spark, folder, "chunks"))


def _personal(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data.personal_data(table(spark, folder, "chunks"), table(spark, folder, "pii_kinds"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data.found_data(_personal(spark, folder))


def p2_redacted(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data.redacted(_personal(spark, folder))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return page_body.boilerplate_lines(table(spark, folder, "chunks"))


def p4_body(spark: SparkSession, folder: str) -> DataFrame:
    return page_body.main_body(table(spark, folder, "chunks"))


def _languages(spark: SparkSession, folder: str) -> DataFrame:
    return languages.languages(table(spark, folder, "chunks"), table(spark, folder, "lang_samples"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return languages.wrongly_labelled(_languages(spark, folder))


def p6_languages(spark: SparkSession, folder: str) -> DataFrame:
    return _languages(spark, folder).select("id", "label", "lang", "language_confidence")


def p6_segments(spark: SparkSession, folder: str) -> DataFrame:
    return languages.segments(_languages(spark, folder))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return scanned_text.faulty_lines(scanned_text.repaired(table(spark, folder, "chunks")))


def p7_text(spark: SparkSession, folder: str) -> DataFrame:
    return scanned_text.repaired(table(spark, folder, "chunks")).select("id", "text")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return token_budget.badly_stated(token_budget.settled_tokens(table(spark, folder, "chunks")))


def p5_totals(spark: SparkSession, folder: str) -> DataFrame:
    return token_budget.token_totals(token_budget.settled_tokens(table(spark, folder, "chunks")))


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_encoding.encode_corpus(table(spark, folder, "documents"))


def p8_decoded(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_encoding.decode_corpus(p8_ids(spark, folder))


def _kinds(spark: SparkSession, folder: str) -> dict[str, int]:
    rows = table(spark, folder, "pack_sizes").where("pack_kind is not null and capacity_tokens > 0").limit(1001).collect()
    if len(rows) > 1000:
        raise ValueError("pack_sizes must have at most 1000 rows")
    return {r.pack_kind: r.capacity_tokens for r in rows}


def _sizes(spark: SparkSession, folder: str) -> DataFrame:
    return staged(token_budget.token_counts(table(spark, folder, "documents"), ["doc_id"]), "sizes")


def p9_containers(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_sizes(spark, folder), _kinds(spark, folder))


def p9_fill(spark: SparkSession, folder: str) -> DataFrame:
    return packing.fill(p9_containers(spark, folder), _kinds(spark, folder))


def p9_faults(spark: SparkSession, folder: str) -> DataFrame:
    sizes, kinds = _sizes(spark, folder), _kinds(spark, folder)
    return packing.faults(packing.pack(sizes, kinds), sizes, kinds)


def _records(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "chunk_vectors").where(F.col("embedding_model") == "vec-small-2")


def _links(spark: SparkSession, folder: str) -> DataFrame:
    # neighbours of any similarity: few large cells, as unlike ones seldom share a small cell
    return similar_vectors.nearest(_records(spark, folder), dim=128, k=5, coarser=20, overlap=None, block=32_768)


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    records = _records(spark, folder)
    return similar_vectors.similar_pairs(similar_vectors.nearest(records, dim=128, k=5, least=0.75), similar_vectors.members(records), 0.75)


def p3_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return similar_vectors.named_links(_links(spark, folder), similar_vectors.members(_records(spark, folder)))


def p3_classes(spark: SparkSession, folder: str) -> DataFrame:
    return similar_vectors.class_links(_links(spark, folder), similar_vectors.members(_records(spark, folder)))


def p3_members(spark: SparkSession, folder: str) -> DataFrame:
    return similar_vectors.class_members(similar_vectors.members(_records(spark, folder)))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return shared_spans.shared_pairs(table(spark, folder, "documents"))


def p10_spans(spark: SparkSession, folder: str) -> DataFrame:
    return shared_spans.span_members(table(spark, folder, "documents"))


def p10_members(spark: SparkSession, folder: str) -> DataFrame:
    return shared_spans.text_classes(table(spark, folder, "documents"))


def p10_share(spark: SparkSession, folder: str) -> DataFrame:
    return shared_spans.shared_share(table(spark, folder, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_found": p1_found,
        "p1_cleaned": p1_cleaned,
        "p1_sequences": p1_sequences,
        "p2_found": p2_found,
        "p2_redacted": p2_redacted,
        "p3_found": p3_found,
        "p3_nearest": p3_nearest,
        "p3_classes": p3_classes,
        "p3_members": p3_members,
        "p4_found": p4_found,
        "p4_body": p4_body,
        "p5_found": p5_found,
        "p5_totals": p5_totals,
        "p6_found": p6_found,
        "p6_languages": p6_languages,
        "p6_segments": p6_segments,
        "p7_found": p7_found,
        "p7_text": p7_text,
        "p8_ids": p8_ids,
        "p8_decoded": p8_decoded,
        "p9_containers": p9_containers,
        "p9_fill": p9_fill,
        "p9_faults": p9_faults,
        "p10_found": p10_found,
        "p10_share": p10_share,
        "p10_spans": p10_spans,
        "p10_members": p10_members,
    }


# White space of any script, as both dialects' classes differ.
_SPACE = r"[\s\x{000B}\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
_LINES = rf"""WITH l AS (SELECT id, doc_id, domain, unnest(range(0, len(ls))) AS line_no, ls FROM (SELECT id, doc_id, domain, string_split(text, chr(10)) AS ls FROM chunks
  WHERE id IS NOT NULL AND doc_id IS NOT NULL AND domain IS NOT NULL AND text IS NOT NULL AND ocr_confidence IS NULL)),
n AS (SELECT id, doc_id, domain, line_no::INT AS line_no, trim(regexp_replace(regexp_replace(lower(ls[line_no + 1]), '{_SPACE}', ' ', 'g'), '\p{{Nd}}+', '0', 'g')) AS item FROM l WHERE regexp_matches(ls[line_no + 1], '\p{{L}}')),
f AS (SELECT domain, item FROM n GROUP BY domain, item HAVING count(DISTINCT doc_id) >= 6), r AS (SELECT DISTINCT id, line_no FROM n JOIN f USING (domain, item))"""
_VECTORS = """WITH r AS (SELECT DISTINCT id, list_transform(embedding::FLOAT[], lambda x: x + 0) AS v FROM chunk_vectors
  WHERE id IS NOT NULL AND embedding_model = 'vec-small-2' AND len(embedding) = 128 AND list_sum(list_transform(embedding, lambda x: x::DOUBLE * x)) > 0 AND isfinite(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x))))"""
_SQL = {
    "p1_found": f"{_LINES} SELECT id, line_no FROM r",
    "p1_cleaned": f"""{_LINES}, g AS (SELECT id, list(line_no) AS gone FROM r GROUP BY id), c AS (SELECT id, max(text) AS text FROM chunks WHERE id IS NOT NULL GROUP BY id),
x AS (SELECT id, text, coalesce(gone, []) AS gone, string_split(text, chr(10)) AS ls FROM c LEFT JOIN g USING (id))
SELECT id, CASE WHEN text IS NOT NULL THEN array_to_string(list_transform(list_filter(range(0, len(ls)), lambda i: NOT list_contains(gone, i)), lambda i: ls[i + 1]), chr(10)) END AS text FROM x""",
    "p1_sequences": f"""{_LINES}, d AS (SELECT DISTINCT id, doc_id, domain, line_no, item FROM n JOIN f USING (domain, item)),
s AS (SELECT doc_id, domain, list(item ORDER BY line_no) AS s FROM d GROUP BY id, doc_id, domain), i AS (SELECT doc_id, domain, s, unnest(range(1, len(s) + 1)) AS a FROM s),
j AS (SELECT doc_id, domain, s, a, unnest(range(a, len(s) + 1)) AS b FROM i)
SELECT domain, s[a:b] AS lines, (b - a + 1)::INT AS length, count(DISTINCT doc_id) AS n_documents FROM j GROUP BY ALL HAVING count(DISTINCT doc_id) >= 6""",
    # equal vectors have equal lists of numbers; all-zero and broken ones have no class
    "p3_members": f"""{_VECTORS} SELECT DISTINCT id, first_value(id) OVER (PARTITION BY v ORDER BY id) AS class_id FROM r""",
    # no container above its capacity, every document with all of its tokens placed once
    "p9_faults": "SELECT pack_kind, (SELECT count(*) FROM documents) AS n_items, 0::BIGINT AS n_overfull, 0::BIGINT AS n_misplaced FROM pack_sizes",
    "p10_members": "SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS class_id, count(*) OVER (PARTITION BY text) AS n_members FROM documents WHERE length(text) >= 240",
    "p10_share": """WITH w AS (SELECT doc_id, i, md5(substr(text, i::BIGINT, 240)) AS h FROM (SELECT doc_id, text, unnest(range(1, length(text) - 238)) AS i FROM documents WHERE length(text) >= 240)),
s AS (SELECT h FROM w GROUP BY h HAVING min(doc_id) < max(doc_id)), k AS (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS j FROM w JOIN s USING (h)),
n AS (SELECT doc_id, sum(least(240, coalesce(j - i, 240)))::BIGINT AS shared FROM k GROUP BY doc_id)
SELECT doc_id, coalesce(length(text), 0)::BIGINT AS n_chars, coalesce(shared, 0)::BIGINT AS shared_chars, CASE WHEN length(text) > 0 THEN coalesce(shared, 0) / length(text) ELSE 0.0 END AS shared_share FROM documents LEFT JOIN n USING (doc_id)""",
    "p10_found": """WITH w AS (SELECT DISTINCT doc_id, md5(substr(text, i::BIGINT, 240)) AS h FROM (SELECT doc_id, text, unnest(range(1, length(text) - 238)) AS i FROM documents WHERE length(text) >= 240)),
s AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1), k AS (SELECT doc_id, h FROM w JOIN s USING (h))
SELECT DISTINCT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM k a JOIN k b ON a.h = b.h AND a.doc_id < b.doc_id""",
}


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that it can express; the others are tested against brute force or round trips."""
    return dict(_SQL)
