"""Lines that come back in document after document of one site, found by PrefixSpan and removed.

The sequence database has one sequence of line identifiers a chunk. The first scan finds the frequent
lines, those of enough different documents of a site; others leave the sequences. Then every frequent
pattern's projected database, the suffixes behind its occurrences, is scanned for lines that extend it,
until no pattern has support any more. The gap rule is that a pattern goes on with the next line of the
suffix, so infrequent lines may lie between two lines of a pattern and frequent ones may not.

Every occurrence of a frequent sequence is deleted: growth leaves at each place the longest pattern that
starts there, and the lines these cover go.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.staging import staged

#: Lines of its suffix that a place carries from round to round.
AHEAD = 32


def normal_line(line: Column) -> Column:
    """Lower case, white space of any kind as one space, digits as one ``0``, trimmed."""
    spaced = F.regexp_replace(F.lower(line), r"(?U)\s+", " ")
    return F.trim(F.regexp_replace(spaced, r"\p{Nd}+", "0"))


def _lines(chunks: DataFrame) -> DataFrame:
    kept = chunks.where("id is not null and doc_id is not null and domain is not null and text is not null and ocr_confidence is null")
    lines = kept.select("id", "doc_id", "domain", F.posexplode(F.split("text", "\n")).alias("line_no", "_line"))
    return lines.where(F.regexp_like("_line", F.lit(r"\p{L}"))).select("id", "doc_id", "domain", "line_no", normal_line(F.col("_line")).alias("line"))


def line_rows(chunks: DataFrame) -> DataFrame:
    """``id, doc_id, domain, line_no, item``: one row per line with a letter, ``item`` its identifier.

    Chunks with a null id, document, domain or text have no lines; scanned chunks don't count.
    Identifiers are of a site: the same line has another one elsewhere.
    """
    return _lines(chunks).withColumn("item", F.xxhash64("domain", "line")).drop("line")


def _supported(rows: DataFrame, pattern: str, support: int, *same: str) -> DataFrame:
    """``pattern, n_documents`` and the columns ``same``, equal in all rows of a pattern, of what ``support`` different documents have.

    Supports are counted per pattern and document before they are summed up, so a site, or a line, with a
    third of all rows is spread over all tasks.
    """
    once = rows.groupBy(pattern, "doc_id").agg(F.lit(1).alias("_one"), *(F.min(c).alias(c) for c in same))
    return once.groupBy(pattern).agg(F.count("*").alias("n_documents"), *(F.min(c).alias(c) for c in same)).where(F.col("n_documents") >= support)


def _grown(chunks: DataFrame, support: int) -> tuple[list[DataFrame], DataFrame]:
    """Frequent patterns by length, and the longest one that starts at each frequent line.

    Patterns are ``pattern, n_documents, parent, item``: the identifier, that of the pattern without its last
    line, and this line; of those of one line the identifier is the line's. Places are ``seq, id, start, line_no,
    length``, ``start`` counted in the frequent lines of the sequence ``seq``.

    A projected database holds a row a place: a pointer to it and the next ``AHEAD`` lines of its suffix, which
    are read anew from the sequences when they are used up, so long sequences aren't copied for every place.
    """
    rows = staged(line_rows(chunks), "lines")
    first = staged(_supported(rows, "item", support), "patterns")
    kept = rows.join(first.select("item"), "item", "left_semi")
    sequences = kept.groupBy("id", "doc_id", "domain").agg(F.array_sort(F.collect_set(F.struct("line_no", "item"))).alias("_s"))
    sequences = staged(sequences.select(F.monotonically_increasing_id().alias("seq"), "id", "doc_id", "_s"), "sequences")
    items = F.col("_s")["item"]
    places = sequences.select("seq", "id", "doc_id", "_s", F.posexplode("_s").alias("start", "_l"))
    projected = places.select(
        "seq", "id", "doc_id", "start", F.col("_l")["line_no"].alias("line_no"), F.col("_l")["item"].alias("pattern"), F.slice(items, F.col("start") + 2, AHEAD).alias("ahead")
    )
    more, length = F.size("ahead") > 0, 1
    patterns, ends = [first.withColumnRenamed("item", "pattern")], [projected.where(~more).withColumn("length", F.lit(1))]
    while True:
        grown = projected.where(more).select(
            "seq", "id", "doc_id", "start", "line_no", F.col("pattern").alias("parent"), F.get("ahead", F.lit(0)).alias("item"), F.slice("ahead", 2, AHEAD).alias("ahead")
        )
        grown = grown.withColumn("pattern", F.xxhash64("parent", "item"))
        alive = staged(_supported(grown, "pattern", support, "parent", "item"), "patterns")
        if alive.isEmpty():
            ends.append(projected.where(more).withColumn("length", F.lit(length)))
            break
        patterns.append(alive)
        placed = grown.drop("parent", "item").join(alive.select("pattern", F.lit(True).alias("alive")), "pattern", "left")
        length += 1
        if (length - 1) % AHEAD == 0:
            placed = placed.drop("ahead").join(sequences.select("seq", "_s"), "seq").withColumn("ahead", F.slice(items, F.col("start") + length + 1, AHEAD)).drop("_s")
        placed = staged(placed, "projected")
        # a place ends with the pattern before if the grown one has no support, or with its sequence
        ends.append(placed.where(F.col("alive").isNull() | ~more).withColumn("length", F.when(F.col("alive"), length).otherwise(length - 1)))
        projected = placed.where("alive")
    return patterns, reduce(DataFrame.unionByName, [x.select("seq", "id", "start", "line_no", "length") for x in ends])


def frequent_sequences(chunks: DataFrame, support: int = 6) -> DataFrame:
    """``domain, lines, length, n_documents`` of all line sequences that ``support`` documents of a site have.

    ``lines`` are in their compared form. A chunk delivered twice counts once. Patterns of any length come
    out: rounds end when no projected database has a line with support.
    """
    first, *longer = _grown(chunks, support)[0]
    found = [first.select("pattern", F.array("pattern").alias("items"), "n_documents")]
    for alive in longer:
        before = found[-1].select(F.col("pattern").alias("parent"), "items")
        found.append(staged(alive.join(before, "parent").select("pattern", F.array_append("items", F.col("item")).alias("items"), "n_documents"), "patterns"))
    patterns = reduce(DataFrame.unionByName, found)
    # line identifiers as their lines
    named = _lines(chunks).select(F.xxhash64("domain", "line").alias("item"), "domain", "line").join(first.select(F.col("pattern").alias("item")), "item", "left_semi")
    named = named.groupBy("item").agg(F.min("domain").alias("domain"), F.min("line").alias("line"))
    placed = patterns.select("items", "n_documents", F.posexplode("items").alias("_i", "item")).join(named, "item")
    whole = placed.groupBy("domain", "items", "n_documents").agg(F.array_sort(F.collect_list(F.struct("_i", "line"))).alias("_l"))
    return whole.select("domain", F.transform("_l", lambda x: x["line"]).alias("lines"), F.size("items").alias("length"), "n_documents")


def occurrences(chunks: DataFrame, support: int = 6) -> DataFrame:
    """``id, line_nos`` of the occurrences of frequent sequences that lie in no longer occurrence.

    At each line the longest frequent sequence that starts there is taken; one that the line before has too,
    longer by this line, is part of that.
    """
    ends = _grown(chunks, support)[1]
    whole = ends.groupBy("seq", "id").agg(F.array_sort(F.collect_list(F.struct("start", "line_no", "length"))).alias("_e"))
    each = whole.select("id", "_e", F.posexplode("_e").alias("_i", "_x")).where(F.coalesce(F.get(F.col("_e")["length"], F.col("_i") - 1) <= F.col("_x")["length"], F.lit(True)))
    return each.select("id", F.slice(F.col("_e")["line_no"], F.col("_i") + 1, F.col("_x")["length"]).alias("line_nos"))


def repeated_lines(chunks: DataFrame, support: int = 6) -> DataFrame:
    """``id, line_no`` of the lines that an occurrence of a frequent sequence covers, each once."""
    return occurrences(chunks, support).select("id", F.explode("line_nos").alias("line_no")).distinct()


def without_repeated_lines(chunks: DataFrame, support: int = 6) -> DataFrame:
    """``id, text``: chunks with the lines of frequent sequences removed, other lines as they are.

    One row per id; ids delivered more than once have one text. Null texts stay null, and a text of
    which every line is removed becomes empty.
    """
    gone = repeated_lines(chunks, support).groupBy("id").agg(F.collect_list("line_no").alias("_gone")).withColumnRenamed("id", "_id")
    one = chunks.where("id is not null").groupBy("id").agg(F.max("text").alias("text"))
    left = F.filter(F.split("text", "\n"), lambda line, i: ~F.array_contains(F.coalesce("_gone", F.array().cast("array<int>")), i))
    return one.join(gone, F.col("id") == F.col("_id"), "left").select("id", F.when(F.col("text").isNotNull(), F.array_join(left, "\n")).alias("text"))
