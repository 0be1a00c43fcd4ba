"""Languages of documents and of the parts of mixed ones, with confidence, by Bayesian evidence fusion.

Text likelihoods come from a naive Bayes model of words (and of character trigrams for words it has not
seen) fitted on labelled samples. They are fused with how often each declared label goes with each
language, and with priors of the host, which are smoothed towards its address suffix and that towards
all chunks; labels and priors are counted by grouped aggregation over all rows.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.staging import staged

# Three-letter codes of the two-letter ones in use.
CODES = {"eng": "en", "fra": "fr", "fre": "fr", "deu": "de", "ger": "de", "spa": "es", "por": "pt", "ita": "it", "nld": "nl", "dut": "nl"}
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
# Mail addresses, also with their signs in words, are no words of a language.
_ADDRESS = re.compile(r"\S*@\S*|\S+ ?[(\[](?:at|arroba)[)\]] ?\S+(?: ?[(\[](?:dot|punto|point|ponto)[)\]] ?\S+)*")
# Forms of address and the like, whose full stop ends no sentence.
_ABBREVIATIONS = ["Dr", "Mr", "Ms", "Mrs", "Sr", "Sra", "Dra", "M", "Mme", "Prof", "Hr", "Fr", "St", "Ave", "Vol", "No", "Nr", "tél", "Tel", "[A-ZÀ-Þ]"]
_SENTENCE_END = re.compile(r"[.!?]" + "".join(rf"(?<!\b{a}\.)" for a in _ABBREVIATIONS) + r"(?<!str\.)[.!?]*[\"”»)\]]*(?=\s+[\"“«(\[¿¡]*[A-ZÀ-Þ0-9]|\s*$)")


def label_code(label: Column) -> Column:
    """Two-letter code that a label names in any spelling, or null: ``EN``, ``eng``, ``es_ES`` are right."""
    first = F.regexp_extract(F.lower(F.trim(F.coalesce(label, F.lit("")))), r"^([a-z]{2,3})(?:$|[-_])", 1)
    three = F.create_map(*[F.lit(x) for pair in CODES.items() for x in pair])
    named = F.when(F.length(first) == 3, three[first]).when(F.length(first) == 2, first)
    return F.when(named.isin("xx", "un", "zz"), None).otherwise(named)


class Likelihoods:
    """Log-likelihoods of words in every language, from labelled samples."""

    def __init__(self, samples: list[tuple[str, str]]):
        self.languages = sorted({lang for lang, _ in samples})
        n = len(self.languages)
        words, grams = defaultdict(lambda: np.zeros(n)), defaultdict(lambda: np.zeros(n))
        for lang, text in samples:
            at = self.languages.index(lang)
            for word, times in Counter(_WORD.findall(text or "")).items():
                words[word.lower()][at] += times
                for g in self._grams(word.lower()):
                    grams[g][at] += times
        total = np.sum(list(words.values()), axis=0) + 0.1 * len(words) if words else np.ones(n)
        self.words = {w: np.log((c + 0.1) / total) for w, c in words.items()}
        gram_total = np.sum(list(grams.values()), axis=0) + 0.5 * len(grams) if grams else np.ones(n)
        self.grams = {g: np.log((c + 0.5) / gram_total) for g, c in grams.items()}
        self.unseen = np.log(0.5 / gram_total)
        self.rows: dict[str, int] = {}
        self.table = np.zeros((1024, n))

    @staticmethod
    def _grams(word: str) -> list[str]:
        padded = f"^{word}$"
        return [padded[i : i + 3] for i in range(len(padded) - 2)]

    def _score(self, word: str) -> np.ndarray:
        """Centred log-likelihoods; a capitalised word that no sample has is taken for a name."""
        low = word.lower()
        if low in self.words:
            found = self.words[low]
        elif word[:1].isupper():
            return np.zeros(len(self.languages))
        else:
            found = sum((self.grams.get(g, self.unseen) for g in self._grams(low)), np.zeros(len(self.languages))) / 3
        return np.clip(found - found.mean(), -6, 6)

    def _row(self, word: str) -> int:
        at = self.rows[word] = len(self.rows)
        if at == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[at] = self._score(word)
        return at

    def texts(self, texts: list[str]) -> np.ndarray:
        """Summed scores of many texts; each different word is scored once."""
        ids, ends = [], []
        if len(self.rows) > 500_000:
            self.rows.clear()
        known, new = self.rows.get, self._row
        for text in texts:
            for w in _WORD.findall(_ADDRESS.sub(" ", text) if "@" in text or "[" in text or "(" in text else text):
                at = known(w)
                ids.append(new(w) if at is None else at)
            ends.append(len(ids))
        sums = np.concatenate([np.zeros((1, len(self.languages))), np.cumsum(self.table[ids], axis=0)]) if ids else np.zeros((1, len(self.languages)))
        bounds = np.array([0, *ends])
        return sums[bounds[1:]] - sums[bounds[:-1]]


def sentences(text: str, scanned: bool) -> Iterator[tuple[int, int, bool]]:
    """``(start, end, whole)`` of the pieces of a text; a whole one starts and ends as a sentence does.

    Line ends end a piece, but in scanned text only blank lines do.
    """
    for line in re.finditer(r"(?:[^\n]|\n(?!\s*\n))+" if scanned else r"[^\n]+", text):
        begin = line.start()
        for end in [m.end() for m in _SENTENCE_END.finditer(text, line.start(), line.end())] + [line.end()]:
            start = begin
            while start < end and text[start].isspace():
                start += 1
            if start < end:
                body = text[start:end].rstrip()
                whole = body[-1] in ".!?" and (body[0].isupper() or body[0] in "¿¡\"“«(" or body[0].isdigit())
                yield start, start + len(body), whole
            begin = end


def _evidence(model_samples: list[tuple[str, str]], least_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Likelihoods(model_samples)
        k = len(model.languages)
        for batch in batches:
            texts, scans = batch.column("text").to_pylist(), batch.column("scanned").to_pylist()
            score, told = [], []
            pieces = [list(sentences(text or "", scanned)) for text, scanned in zip(texts, scans)]
            scores = model.texts([text[a:b] for text, spans in zip(texts, pieces) for a, b, _ in spans])
            at = 0
            for found in pieces:
                score.append(scores[at : at + len(found)].sum(0).tolist())
                told.append([{"start": a, "end": b, "score": scores[i].tolist()} for i, (a, b, whole) in enumerate(found, at) if whole and b - a >= least_chars])
                at += len(found)
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.list_(pa.float32()))]))
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in ("id", "domain", "label")} | {"score": pa.array(score, pa.list_(pa.float64())), "told": pa.array(told, kind)})

    return run


def _decided(names: list[str]):
    """Each whole sentence's language by its text and the other evidence on its chunk (``bias``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole_chars, parts = [], []
            for told, bias in zip(batch.column("told").to_pylist(), batch.column("bias").to_pylist()):
                chars, spans, other = np.zeros(len(names), np.int64), [], np.array(bias)
                tops = (np.array([s["score"] for s in told]) + other).argmax(1).tolist() if told else []
                for s, top in zip(told, tops):
                    chars[top] += s["end"] - s["start"]
                    if spans and spans[-1]["lang"] == names[top]:
                        spans[-1]["end"] = s["end"]
                        spans[-1]["score"] = spans[-1]["score"] + np.array(s["score"])
                    else:
                        spans.append({"lang": names[top], "start": s["start"], "end": s["end"], "score": np.array(s["score"]) + other})
                for span in spans:
                    e = np.exp(span["score"] - span["score"].max())
                    span["confidence"] = float(e.max() / e.sum())
                    del span["score"]
                whole_chars.append(chars.tolist()), parts.append(spans)
            kind = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("confidence", pa.float64())]))
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in ("id", "label", "post")} | {"chars": pa.array(whole_chars, pa.list_(pa.int64())), "parts": pa.array(parts, kind)})

    return run


def _probabilities(scores: Column, k: int) -> Column:
    """Array of ``k`` log scores as probabilities."""
    top = F.array_max(scores)
    powers = F.transform(scores, lambda x: F.exp(F.greatest(x - top, F.lit(-700.0))))
    return F.transform(powers, lambda x: x / F.aggregate(powers, F.lit(0.0), lambda a, b: a + b))


def languages(chunks: DataFrame, samples: DataFrame, least_chars: int = 60, smoothing: float = 20.0, most_samples: int = 20_000) -> DataFrame:
    """One row per chunk id: ``id, label, lang, language_confidence, main, whole, parts``.

    ``lang`` is the language of the whole chunk after fusion of all evidence; ``label`` the code that the
    declared label names, or null; ``main`` the language in which most characters of whole sentences are
    (null without any), each decided by text, label and host together; ``whole`` all languages that have a whole sentence of ``least_chars``; ``parts``
    the mixed-language segments. Null and blank texts are judged by label and host alone. Only
    ``most_samples`` labelled samples fit the text model. Rows without id are left out; an id delivered
    several times has one row. Evidence of a host is summed up before it is joined, so a host with a
    third of all rows is one row on that side.
    """
    rows = samples.where("lang is not null and text is not null").select("lang", "text").limit(most_samples).collect()
    fitted = [(r.lang, r.text) for r in rows]
    names = sorted({lang for lang, _ in fitted})
    k = len(names)
    if not k:
        raise ValueError("no labelled samples")
    narrow = chunks.where("id is not null").select("id", F.coalesce("domain", F.lit("")).alias("domain"), label_code(F.col("lang")).alias("label"), "text", F.col("ocr_confidence").isNotNull().alias("scanned"))
    schema = "id string, domain string, label string, score array<double>, told array<struct<start:int,end:int,score:array<float>>>"
    read = narrow.mapInArrow(_evidence(fitted, least_chars), schema)
    # one row an id: deliveries have the same text; of different labels the first that names a language
    read = staged(read, "evidence").groupBy("id").agg(F.max(F.struct(F.size("told").alias("n"), "label", "domain", "score", "told")).alias("r")).select("id", "r.*").drop("n")
    suffix = F.regexp_extract("domain", r"([^.]*)$", 1)
    likely = read.select("id", "domain", suffix.alias("suffix"), "label", "score", "told", _probabilities(F.transform("score", lambda x: x * 0.5), k).alias("p"))
    likely = likely.withColumn("sure", F.array_max("p") > 0.9)

    # what labels say, for each language of the text: at most k * (k + 1) rows
    column = F.when(F.col("label").isin(names), F.col("label")).otherwise(F.when(F.col("label").isNull(), "").otherwise("?"))
    counted = likely.where("sure").groupBy(column.alias("label")).agg(*[F.sum(F.col("p")[i]).alias(f"p{i}") for i in range(k)]).collect()
    by_label = {r.label: np.array([r[f"p{i}"] for i in range(k)]) for r in counted}
    totals = np.sum(list(by_label.values()), axis=0) if by_label else np.zeros(k)
    says = {x: np.log((by_label.get(x, np.zeros(k)) + 1) / (totals + k + 2)) for x in [*names, "", "?"]}
    overall = (totals + 1) / (totals.sum() + k)
    label_scores = F.create_map(*[e for x, v in says.items() for e in (F.lit(x), F.array(*[F.lit(float(y)) for y in v]))])[column]

    # priors of hosts, smoothed towards their suffix and that towards all
    sums = [F.sum(F.when(F.col("sure"), F.col("p")[i]).otherwise(F.lit(0.0))).alias(f"n{i}") for i in range(k)]
    hosts = likely.groupBy("domain", "suffix").agg(*sums)
    ends = hosts.groupBy(F.col("suffix").alias("_suffix")).agg(*[F.sum(f"n{i}").alias(f"s{i}") for i in range(k)])
    of = lambda c: sum((F.col(f"{c}{i}") for i in range(k)), F.lit(0.0))
    hosts = hosts.join(ends, F.col("suffix") == F.col("_suffix"))
    smooth = F.lit(smoothing)
    ended = [(F.col(f"s{i}") + smooth * F.lit(float(overall[i]))) / (of("s") + smooth) for i in range(k)]
    hosts = hosts.select(F.col("domain").alias("_domain"), F.array(*[F.log((F.col(f"n{i}") + smooth * ended[i]) / (of("n") + smooth)) for i in range(k)]).alias("prior"))

    joined = likely.join(hosts, F.col("domain") == F.col("_domain"), "left").withColumn("_label", label_scores)
    joined = joined.withColumn("bias", F.zip_with("_label", "prior", lambda a, b: a + b))
    fused = F.zip_with("score", "bias", lambda a, b: a * 0.5 + b)
    decided = joined.select("id", "label", "told", "bias", _probabilities(fused, k).alias("post"))
    posterior = decided.mapInArrow(_decided(names), "id string, label string, post array<double>, chars array<bigint>, parts array<struct<lang:string,start:int,end:int,confidence:double>>")
    named = F.array(*[F.lit(n) for n in names])
    best = F.array_position("post", F.array_max("post")).cast("int")
    most = F.array_position("chars", F.array_max("chars")).cast("int")
    return posterior.select(
        "id", "label", F.element_at(named, best).alias("lang"), F.array_max("post").alias("language_confidence"),
        F.when(F.array_max("chars") > 0, F.element_at(named, most)).alias("main"),
        F.filter(named, lambda x, i: F.get("chars", i) > 0).alias("whole"), "parts",
    )


def wrongly_labelled(found: DataFrame) -> DataFrame:
    """``id, lang`` for each language of chunks that are mixed, or labelled with none or a wrong one."""
    wrong = F.col("label").isNull() | (F.col("label") != F.col("main")) | (F.size("whole") > 1)
    return found.where(F.col("main").isNotNull() & wrong).select("id", F.explode("whole").alias("lang"))


def segments(found: DataFrame) -> DataFrame:
    """``id, part, start, end, lang, language_confidence`` of every part of every chunk."""
    return found.select("id", F.posexplode("parts").alias("part", "_p")).select("id", "part", F.col("_p.start").alias("char_start"), F.col("_p.end").alias("char_end"), F.col("_p.lang").alias("lang"), F.col("_p.confidence").alias("language_confidence"))
