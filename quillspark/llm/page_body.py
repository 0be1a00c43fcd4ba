"""The main body of web pages: a recurrent labeller reads all blocks of a page and classifies each.

Blocks are a text's lines. What is left of a block's place in the page is how its line is marked up
(heading, bullet, quote, cell, trail, arrow ...), which stands for the tag path; words are hashed. A
bidirectional LSTM sees the whole page. It is trained on a bounded sample of pages whose lines are
labelled by rules about wording, marks, the site's own name and whether a line shares its rare words
with the sentences around; rules that say nothing leave a line to the context.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.bilstm import BiLstm

BUCKETS = 4096
_WORD = re.compile(r"[^\W\d_]+")
_MARKS = ["#", "*", "-", "•", "»", "[", "←", "→", "|", "©", "“", ">"]
_NUMBERED = re.compile(r"\d+[.)]\s")
_LISTED = re.compile(r"#|\*|•|\d+\)")  # marks that only an article's own headings and lists have
_CODE = re.compile(r"^\w+\.\w+\(.*\)$|[{};=]\s*$|^\s*(?:def|class|import|return)\b")
_CONTACT = re.compile(r"@|\(at\)|\[at\]|\+\d{1,3}[ (]|(?:\d[ ()/.-]{0,2}){8,}")
_TABLE = re.compile(r"^\s*\|.*\|\s*$")
_TRAIL = re.compile(r"^[^.|·]{2,40} [/»>›] [^|·]+$")
_SHAPES = len(_MARKS) + 22

# Openings and wordings of page furniture in the five languages in use.
_FURNITURE = re.compile(
    r"©|^(?:ad|advertisement|anzeige|annonce|anuncio|anúncio|publicidad|publicidade|sponsored)\s*:"
    r"|, staff writer$|^(?:last updated|updated|published|mis à jour|publié|stand:|aktualisiert|veröffentlicht|actualizado|publicado|atualizado)\b"
    r"|^(?:tags|mots-clés|schlagworte|etiquetas|keywords|palavras-chave)\s*:"
    r"|^(?:read next|more like this|see also|related|à lire ensuite|dans le même esprit|weiterlesen|mehr davon|lesen sie auch|siga leyendo|más como esto|leia a seguir|mais como este)\b"
    r"|^(?:share|follow|subscribe|join \d|partager|partagez|suivez|recevez|diese seite|folgen|comparta|comparte|siga|reciba|partilhe|receba)\b"
    r"|^(?:popular this week|editors also read|most read|les plus lus|meistgelesen|lo más leído|mais lidos|os mais lidos)"
    r"|\d+ (?:min read|min\. de|min de|comments?|commentaires?|kommentare?|comentarios?|comentários?)\b|^viewed \d|^lecture : \d|^lesezeit \d",
    re.IGNORECASE,
)

# Openings of author lines.
_BYLINE = re.compile(r"^(?:by|par|por|von|text:|texto de|written by|rédigé par|escrito por)\s[^,;:!?]{3,40}$", re.IGNORECASE)


def brand(domain: str | None) -> str:
    """The site's own name, from its address."""
    parts = (domain or "").lower().split(":")[0].split(".")
    return parts[-2] if len(parts) > 1 else ""


class Page:
    """Words and shape features of one page's non-blank lines."""

    def __init__(self, text: str, domain: str | None, common: frozenset[str]):
        self.numbers = [i for i, line in enumerate(text.split("\n")) if line.strip()]
        lines = text.split("\n")
        self.lines = [lines[i].strip() for i in self.numbers]
        own = brand(domain)
        self.words = [_WORD.findall(line.lower()) for line in self.lines]
        self.branded = [own in words if own else False for words in self.words]
        self.rare = [{w for w in words if w not in common and w != own and len(w) > 3} for words in self.words]
        told: dict[str, set[int]] = defaultdict(set)
        self.prose = [len(line) > 60 and line[-1] in ".!?" and not b for line, b in zip(self.lines, self.branded)]
        bare = [re.sub(r"^[\s»•·*\-←→>\[(]+|[\s›\])↑]+$", "", line) for line in self.lines]
        for i, names in enumerate(self.rare):
            if not self.branded[i] and (self.prose[i] or not (_FURNITURE.search(bare[i]) or _BYLINE.search(bare[i]))):
                for w in names:
                    told[w].add(i)
        self.support = [max((len(told[w] - {i}) for w in names if w in told), default=0) for i, names in enumerate(self.rare)]
        self.longest = max((len(x) for x in self.lines), default=1)

    def shape(self, i: int, last: int) -> list[float]:
        line, words = self.lines[i], self.words[i]
        upper = sum(c.isupper() for c in line) / max(1, sum(c.isalpha() for c in line))
        return [float(line.startswith(m)) for m in _MARKS] + [
            float(line.startswith("##")), float(bool(_NUMBERED.match(line))), float(line[-1] in ".!?"), float(line[-1] in "›]↑"), float(line[-1] == ":"),
            float("|" in line[1:-1]), float("·" in line), float("  " in line), float(bool(_TABLE.match(line))), float(bool(_CODE.search(line))), float(bool(_CONTACT.search(line))),
            float(bool(_TRAIL.match(line))), min(len(line), 240) / 240, min(len(words), 12) / 12, upper, float(any(c.isdigit() for c in line)),
            float(self.branded[i]), float(bool(self.rare[i])), min(self.support[i], 3) / 3, float(self.support[i] > 0), i / max(1, last), float(self.prose[i]),
        ]

    def weak(self, i: int) -> tuple[float, float]:
        """Label (1: furniture) and weight that the rules give a line."""
        line, words = self.lines[i], self.words[i]
        bare = re.sub(r"^[\s»•·*\-←→>\[(]+|[\s›\])↑]+$", "", line)
        if not self.prose[i] and (line.startswith(("←", "→", "©")) or _FURNITURE.search(bare) or _BYLINE.search(bare)):
            return 1.0, 1.0
        if _CODE.search(line) or (_TABLE.match(line) and (any(c.isdigit() for c in line) or self.rare[i])) or _CONTACT.search(line):
            return 0.0, 1.0
        if self.branded[i]:
            return 1.0, 1.0
        if _TRAIL.match(bare) and not self.prose[i]:
            return 1.0, 1.0
        if self.support[i] > 0 or (self.rare[i] and _LISTED.match(line)):
            return 0.0, 1.0
        if self.prose[i] and self.rare[i]:
            return 0.0, 1.0
        if not self.rare[i] and (len(bare) < 60 or not self.prose[i]):
            return 1.0, 1.0
        if self.rare[i] and not line[-1] in ".!?" and len(self.lines) > 1:
            return 1.0, 0.7  # names a page that this one says nothing about
        return 0.0, 0.3


def _bucket(word: str, memo: dict[str, int]) -> int:
    found = memo.get(word)
    if found is None:
        found = zlib.crc32(word.encode()) % BUCKETS
        if len(memo) < 1_000_000:
            memo[word] = found
    return found


def _arrays(pages: list[Page], common: frozenset[str], memo: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    words, ends, shapes, n = [], [], [], 0
    for page in pages:
        for i, tokens in enumerate(page.words):
            known = [_bucket(w, memo) for w in tokens if w in common]  # names say nothing by themselves
            words += known
            n += len(known)
            ends.append(n)
            shapes.append(page.shape(i, len(page.lines) - 1))
    return np.array(words, np.int64), np.array(ends, np.int64), np.array(shapes, np.float32).reshape(-1, _SHAPES), np.array([len(p.lines) for p in pages], np.int64)


def common_words(pages: DataFrame) -> frozenset[str]:
    """Words common enough to be read: those of enough pages and sites, counted over all pages.

    Counts are summed up per batch and site before they move.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = pc.split_pattern_regex(pc.utf8_lower(batch.column("text")), r"\P{L}+")
            row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(tokens).to_numpy(zero_copy_only=False))
            words, sites = tokens.flatten().dictionary_encode(), batch.column("domain").dictionary_encode()
            once = np.unique(words.indices.to_numpy().astype(np.int64) * batch.num_rows + row)  # a word once a page
            site = sites.indices.to_numpy().astype(np.int64)[once % batch.num_rows]
            pair, n = np.unique(once // batch.num_rows * len(sites.dictionary) + site, return_counts=True)
            word, domain = words.dictionary.take(pa.array(pair // len(sites.dictionary))), sites.dictionary.take(pa.array(pair % len(sites.dictionary)))
            yield pa.RecordBatch.from_pydict({"word": word, "domain": domain, "n": pa.array(n, pa.int64())})

    counted = pages.select("text", "domain").mapInArrow(count, "word string, domain string, n bigint").where("word <> ''").groupBy("word", "domain").agg(F.sum("n").alias("n"))
    words = counted.groupBy("word").agg(F.sum("n").alias("n"), F.count("*").alias("sites"))
    often = (F.col("n") >= 6) & ((F.col("sites") >= 3) | (F.col("n") >= 40)) | (F.length("word") < 4)
    return frozenset(words.where(often).select("word").toArrow().column("word").to_pylist())


def train(pages: list[tuple[str, str | None]], common: frozenset[str], rounds: int = 5) -> BiLstm:
    """A labeller fitted on sampled pages."""
    read = [Page(text, domain, common) for text, domain in pages]
    words, ends, shapes, sizes = _arrays(read, common, {})
    labels = np.array([p.weak(i) for p in read for i in range(len(p.lines))], np.float32).reshape(-1, 2)
    model = BiLstm(BUCKETS, _SHAPES)
    if len(labels):
        model.fit(words, ends, shapes, sizes, labels[:, 0], labels[:, 1], rounds)
    return model


def furniture(chunks: DataFrame, sample: int = 2500) -> DataFrame:
    """``id, line_no, furniture``: the probability, for each non-blank line of a page, of not being body.

    Pages are chunks of format html with a text and an id; others have no rows. A page delivered twice
    comes out once. At most ``sample`` pages, picked by hash, train the labeller; every line of every
    page is labelled by it. Which words are common is counted over all pages.
    """
    pages = chunks.where("id is not null and text is not null and format = 'html'").select("id", F.coalesce("domain", F.lit("")).alias("domain"), "text")
    rows = pages.select("id").count()
    every = max(1, rows // sample)
    picked = pages.where(F.pmod(F.xxhash64("id"), F.lit(every)) == 0).orderBy(F.xxhash64("id"), "domain").limit(sample).toArrow().to_pydict()
    common = common_words(pages)
    model = train(list(zip(picked["text"], picked["domain"])), common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, int] = {}
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                part = batch.slice(low, 1000)
                read = [Page(t, d, common) for t, d in zip(part.column("text").to_pylist(), part.column("domain").to_pylist())]
                words, ends, shapes, sizes = _arrays(read, common, memo)
                if not len(ends):
                    continue
                p = model.label(model.inputs(words, ends, shapes), sizes)
                ids = part.column("id").take(pa.array(np.repeat(np.arange(len(read)), sizes)))
                numbers = pa.array(np.concatenate([np.array(x.numbers, np.int32) for x in read]), pa.int32())
                yield pa.RecordBatch.from_pydict({"id": ids, "line_no": numbers, "furniture": pa.array(p.astype(np.float64))})

    return pages.mapInArrow(run, "id string, line_no int, furniture double")


def boilerplate_lines(chunks: DataFrame, sample: int = 2500, threshold: float = 0.5) -> DataFrame:
    """``id, line_no`` of the lines that are not part of the body."""
    return furniture(chunks, sample).where(F.col("furniture") > threshold).select("id", "line_no").distinct()


def main_body(chunks: DataFrame, sample: int = 2500, threshold: float = 0.5) -> DataFrame:
    """``id, text`` of the pages, only with the lines of the main body; blank lines are kept.

    A page of furniture only becomes an empty text.
    """
    gone = boilerplate_lines(chunks, sample, threshold).groupBy("id").agg(F.collect_list("line_no").alias("_gone")).withColumnRenamed("id", "_id")
    pages = chunks.where("id is not null and text is not null and format = 'html'").groupBy("id").agg(F.max("text").alias("text"))
    kept = F.filter(F.split("text", "\n"), lambda line, i: ~F.array_contains(F.coalesce("_gone", F.array().cast("array<int>")), i))
    return pages.join(gone, F.col("id") == F.col("_id"), "left").select("id", F.array_join(kept, "\n").alias("text"))
