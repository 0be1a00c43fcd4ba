"""Repair of text from scanned pages: furniture, words cut at line ends and misread characters.

Words that the corpus does not know are looked up in a trie of those it does, by intersecting it with
each word's Levenshtein automaton, which finds every known word within the distance. Candidates are
ranked by how well known readings of scanners explain the difference, by their frequency and by the
document around. Then page furniture goes, halves of words are joined and lines flow into paragraphs.

What a document tells about its lines and words (which lines come back, how often it has a spelling) is
counted by grouped aggregation over all its chunks and joined back, so chunks are mended one by one.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.staging import staged

# What scanners read (right) for what is printed (left).
READINGS = [
    ("m", "rn"), ("rn", "m"), ("w", "vv"), ("d", "cl"), ("cl", "d"), ("ü", "ii"), ("h", "b"), ("e", "c"), ("c", "e"), ("li", "h"), ("h", "li"), ("n", "ri"), ("ri", "n"),
    ("a", "@"), ("t", "+"), ("s", "5"), ("s", "$"), ("i", "1"), ("l", "1"), ("o", "0"), ("g", "9"), ("b", "8"), ("é", "6"), ("b", "6"), ("i", "|"), ("l", "|"), ("i", "!"), ("l", "i"), ("i", "l"), ("t", "l"), ("u", "ii"), ("b", "h"), ("nn", "m"), ("m", "nn"), ("fi", "ﬁ"), ("fl", "ﬂ"), ("ff", "ﬀ"),
]
_CUT = "-‐¬\xad"
_SPLIT = re.compile(r"[\s.,;:()\[\]“”„\"'’‘—–/!?<>«»=" + re.escape(_CUT) + "]+")
_WORDS = re.compile(r"[^\W\d_]+")
_HYPHENED = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)+")
_ODD = re.compile(r"[^\W\d_]{2}[0-9@+$|]|[0-9@+$|][^\W\d_]{2}|[^\W\d_][0-9@+$|][^\W\d_]|[^\W\d_]{2,}[0-9@+$|]$")
_ORDINAL = re.compile(r"\d+(?:st|nd|rd|th|er|ère|e|a|o|º|ª)?$|[A-Z]{1,2}\d+$|\d+[a-z]$", re.IGNORECASE)
_PAGE = re.compile(r"(?:-|–|—) ?\d{1,5} ?(?:-|–|—)|\[\d{1,5}\]|· ?\d{1,5}(?: ?·)?|\d{1,5} ?·|(?:p|pp|S|pág|pag)\. ?\d{1,5}|(?:Page|Seite|Página|Pagina|Página|Pag) \d{1,5}(?: (?:of|von|sur|de) \d{1,5})?|\d{1,5} ?/ ?\d{1,5}|\d{1,5}", re.IGNORECASE)
_DOTTED_PAGE = re.compile(r"\d{1,5}\.")
_LEADS_TO_NUMBER = re.compile(r"\b(?:von|of|than|section|abschnitt|sección|secção|nummer|number|numéro|número|de|no|nr|mit|with|avec|con|com|au|bis|to)\.?$", re.IGNORECASE)
_OPEN_WORD = re.compile(r"\b(?:the|a|an|of|in|and|whether|for|to|der|die|das|den|dem|von|und|mit|le|la|les|de|du|des|et|que|el|los|las|del|y|o|os|as|da|do|e|em|na|no)$", re.IGNORECASE)
_NUMBERED_HEADER = re.compile(r"(?:\d{1,5}(?: {3,}|\t+).*[^\W\d_]{2}.*|.*[^\W\d_]{2}.*(?: {3,}|\t+)\d{1,5})")
_SITE_TITLE = re.compile(r"[A-ZÀ-Þ]\w+(?: [A-ZÀ-Þ]\w+)?, [A-ZÀ-Þ]")
_ISSUE = re.compile(r".{2,60} [—–-] ?(?:No|Nr|N[º°]|Vol|V0l|N0|Núm|Num|Heft|Bd)\.? ?\S{1,6}", re.IGNORECASE)


_READ_BY_PRINTED: dict[str, list[tuple[str, str]]] = defaultdict(list)
for _printed, _read in READINGS:
    _READ_BY_PRINTED[_printed[0]].append((_printed[1:], _read))


class LevenshteinAutomaton:
    """Accepts the words that become ``word`` by at most ``distance`` edits, which are the known readings.

    It is a Levenshtein automaton whose edits, besides exchanging a character, merge and split two. A
    state is a set of places: position in ``word``, what must come next of a printed pair, edits so far.
    """

    def __init__(self, word: str, distance: int):
        self.word, self.distance = word, distance
        self.start = frozenset({(0, "", 0)})

    def step(self, state: frozenset, c: str) -> frozenset:
        new = set()
        for at, due, edits in state:
            if due:
                if due == c:
                    new.add((at, "", edits))
                continue
            if self.word.startswith(c, at):
                new.add((at + 1, "", edits))
            if edits < self.distance:
                for rest, read in _READ_BY_PRINTED.get(c, ()):
                    if self.word.startswith(read, at):
                        new.add((at + len(read), rest, edits + 1))
        return frozenset(new)

    def first_characters(self, state: frozenset) -> set[str]:
        """Characters that lead on from a state."""
        out = set()
        for at, due, edits in state:
            if due:
                out.add(due)
            else:
                out.update(self.word[at : at + 1])
                if edits < self.distance:
                    out.update(printed[0] for printed, read in READINGS if self.word.startswith(read, at))
        return out

    def prefixes(self, length: int) -> set[str]:
        """First ``length`` characters of all accepted words, and shorter accepted words."""
        out, reached = set(), {"": self.start}
        for _ in range(length):
            out.update(p for p, state in reached.items() if p and self.accepts(state))
            reached = {p + c: after for p, state in reached.items() for c in self.first_characters(state) if (after := self.step(state, c))}
        return out | set(reached)

    def accepts(self, state: frozenset) -> bool:
        return any(at == len(self.word) and not due for at, due, _ in state)


class Trie:
    """Words by their characters; a word's own entry is under ``""``."""

    def __init__(self, words: Iterator[tuple[str, int]]):
        self.root: dict = {}
        for word, n in words:
            node = self.root
            for c in word:
                node = node.setdefault(c, {})
            node[""] = (word, n)

    def near(self, word: str, distance: int) -> list[tuple[str, int]]:
        """All words within ``distance`` of ``word``, by intersection with its automaton."""
        automaton = LevenshteinAutomaton(word, distance)
        found, stack = [], [(self.root, automaton.start)]
        while stack:
            node, state = stack.pop()
            for c, below in node.items():
                if c == "":
                    if automaton.accepts(state):
                        found.append(below)
                elif after := automaton.step(state, c):
                    stack.append((below, after))
        return found


def readings_between(printed: str, read: str, most: int = 2) -> int | None:
    """How many known readings turn ``printed`` into ``read``; None if more than ``most`` or others."""
    if printed == read:
        return 0
    if not most:
        return None
    i = 0
    while i < min(len(printed), len(read)) and printed[i] == read[i]:
        i += 1
    best = None
    # the first difference is inside a reading that begins at most one character before it
    for at in range(max(0, i - 1), i + 1):
        for a, b in READINGS:
            if printed.startswith(a, at) and read.startswith(b, at):
                rest = readings_between(printed[at + len(a) :], read[at + len(b) :], most - 1)
                if rest is not None and (best is None or rest + 1 < best):
                    best = rest + 1
    return best


def skeleton(word: str) -> str:
    """The same for words that differ by known readings of single places."""
    out = word.lower()
    for a, b in (("rn", "m"), ("nn", "m"), ("vv", "w"), ("cl", "d"), ("ii", "u"), ("ü", "u"), ("li", "h"), ("ri", "n"), ("@", "a"), ("+", "t"), ("5", "s"), ("$", "s"), ("0", "o"), ("9", "g"), ("8", "h"), ("6", "h"), ("b", "h"), ("e", "c"), ("é", "h"), ("1", "i"), ("|", "i"), ("!", "i"), ("l", "i")):
        out = out.replace(a, b)
    return out


def parts(line: str) -> list[str]:
    return [w for w in _SPLIT.split(line) if w]


def _odd(part: str) -> bool:
    return bool(_ODD.search(part)) and not _ORDINAL.fullmatch(part)


def _key(line: str) -> str:
    return skeleton(re.sub(r"[\d\W_]+", "", line))


def _counted(line: str) -> bool:
    """Whether a line, trimmed, may be a header that comes back; lines of running text mostly may not."""
    return bool(line) and len(line) < 110 and line[-1] not in ".,;" and not line[0].islower()


def _lone_number(s: str, before: str) -> bool:
    return bool(_PAGE.fullmatch(s)) or (bool(_DOTTED_PAGE.fullmatch(s)) and not (before and _LEADS_TO_NUMBER.search(before)))


def layout(text: str, again: set[str] | None = None, sure: set[str] | None = None) -> tuple[list[str], dict[str, tuple[bool, bool]]]:
    """``header``, ``page_number``, ``blank`` or ``text`` for every line of a chunk.

    ``again`` are the keys of lines that the document has more than once, ``sure`` of lines that are
    headers somewhere in it. Lines that come back (but for digits and misreadings), stand beside a page
    number, have one in a column of their own, are all in capitals or name an issue are headers. A line
    that could as well begin a sentence is one only if its wording is a header elsewhere. Also given: keys
    of lines that are surely headers, and of those that are if they come back. Without ``again`` lines that
    might come back are taken for neither text nor headers when the next ones are judged.
    """
    lines = [line.strip() for line in text.split("\n")]
    width = max(map(len, lines), default=0)
    kinds: list[str] = []
    unsure: list[tuple[int, str]] = []
    told: dict[str, tuple[bool, bool]] = {}
    said = ""  # the last line of text so far
    for i, s in enumerate(lines):
        before = lines[i - 1] if i else ""
        after = lines[i + 1] if i + 1 < len(lines) else ""
        if not s:
            kinds.append("blank")
        elif _lone_number(s, before):
            kinds.append("page_number")
        elif len(s) < 120 and _NUMBERED_HEADER.fullmatch(s) or _ISSUE.fullmatch(s):
            kinds.append("header")
            told[_key(s)] = (True, True)
        else:
            letters = [c for c in s if c.isalpha()]
            capitals = len(letters) > 5 and sum(c.isupper() for c in letters) > 0.8 * len(letters)
            titled = not s[0].islower() and s[-1] not in ".,;" + _CUT and (s[0].isupper() or not s[0].isalpha()) and not _OPEN_WORD.search(s)
            if not capitals and not titled:  # most lines
                kinds.append("text")
                said = s
                continue
            key = _key(s)
            near = [x for x in (before, after, lines[i - 2] if not before and i > 1 else "") if x]
            beside = any(_PAGE.fullmatch(x) or _DOTTED_PAGE.fullmatch(x) for x in near)
            follows = next((x for x in lines[i + 1 :] if x and not _PAGE.fullmatch(x)), "")
            # as a line of text it would begin a sentence that the next line goes on with
            fits = (not said or said[-1] in ".!?") and follows[:1].islower()
            alone = capitals or (titled and not fits and beside and (len(s) < 0.72 * width or bool(_SITE_TITLE.match(s))))
            returning = titled and not fits and len(key) > 4
            was = told.get(key, (False, False))
            told[key] = (was[0] or alone, was[1] or returning)
            if alone or (returning and again and key in again):
                kinds.append("header")
            else:
                kinds.append("text")
                if titled and len(key) > 4 and (beside or (again and key in again)):
                    unsure.append((i, key))
                if again is not None or not returning:
                    said = s
    for i, key in unsure:
        if sure and key in sure:
            kinds[i] = "header"
    return kinds, told


def joints(lines: list[str], kinds: list[str]) -> Iterator[tuple[int, int, str, str]]:
    """``(line, next line, first half, second half)`` of words cut at the end of a line of text.

    The second half is on the next line of text, past any page furniture; it is empty if there is none.
    """
    texts = [i for i, k in enumerate(kinds) if k == "text"]
    for at, i in enumerate(texts):
        s = lines[i].rstrip()
        if len(s) > 1 and s[-1] in _CUT and not s[-2].isspace():
            j = texts[at + 1] if at + 1 < len(texts) else -1
            first = re.split(r"[\s(“\"'’]", s[:-1])[-1]
            tail = lines[j].split() if j >= 0 else []
            second = re.match(r"[^\s.,;:!?)”\"]*", tail[0]).group() if tail else ""
            yield i, j, first, second


def _words_of(text: str) -> tuple[Counter, set[str]]:
    """Words of a chunk as they are written, and, in lower case, those that halves at line ends may make.

    Which lines are page furniture is not known yet, so a half is tried with each of the next lines.
    """
    lines = text.split("\n")
    whole: set[str] = set()
    for i, line in enumerate(lines):
        s = line.rstrip()
        if len(s) > 1 and s[-1] in _CUT and not s[-2].isspace():
            following = [x for x in lines[i + 1 : i + 9] if x.strip()]
            for later in [*following[:5], ""]:
                _, _, a, b = next(joints([line, later], ["text", "text" if later else "blank"]))
                whole.update((f"{a}-{b}".lower(), re.split(f"[{_CUT}]", a)[-1].lower() + re.split(f"[{_CUT}]", b)[0].lower()))
    return Counter(w for w in _SPLIT.split(text) if len(w) > 1), whole


def _right(word: str, near: dict[str, list[dict] | None], alike: dict[str, list[dict]]) -> str | None:
    """What an unknown word should be, or None if it stands as it is.

    ``near`` has the unknown words in lower case and their candidates, ``alike`` the document's
    spellings that look like each of its unknown words, with how often it has them.
    """
    low = word.lower()
    if low not in near or (len(word) < 3 and not word.islower()):
        return None
    odd = _odd(word)
    options = []
    for c in near[low] or ():
        cost = readings_between(c["word"], low)
        if cost:
            options.append((cost, -c["n"], c["word"]))
    if len(word) < 3:
        return min(options)[2] if options else None
    said = {a["word"]: a["n"] for a in alike.get(low, ())}
    mine = said.get(word, 0)
    for other, n in said.items():
        if other != word and len(other) > 3 and not _odd(other) and (odd or n > mine) and (cost := readings_between(other.lower(), low)):
            options.append((cost, -1e9 * n, other.lower()))
    if options and (odd or mine < 4):
        best = min(options)[2]
        return best[:1].upper() + best[1:] if word[:1].isupper() else best
    if odd and "@" not in word[:-1].replace(word.strip("@"), ""):
        return word
    return None


def _repair(text: str, kind: list[str], near: dict[str, list[dict] | None], alike: dict[str, list[dict]]) -> tuple[str, list[dict]]:
    """Repaired text of a chunk, whose lines are of these kinds, and what is wrong with each line."""
    right = lambda word: _right(word, near, alike)
    lines = text.split("\n")
    wrong: dict[int, set[str]] = defaultdict(set)
    cut: dict[int, tuple[int, str, bool]] = {}
    skip: dict[int, list[str]] = defaultdict(list)  # halves not to be judged alone
    for i, j, a, b in joints(lines, kind):
        head, tail = re.split(f"[{_CUT}]", a)[-1], re.split(f"[{_CUT}]", b)[0]
        whole = f"{a}-{b}".lower()
        hyphened = b and (whole not in near or any(readings_between(c["word"], whole, 2) is not None for c in near[whole] or () if "-" in c["word"]))
        if hyphened:
            cut[i] = (j, "-", True)
            continue
        wrong[i].add("hyphen")
        cut[i] = (j, "", True)
        skip[i].append(head)
        if j >= 0:
            skip[j].append(tail)
            fixed = right(head + tail)
            if fixed is None and _odd(head + tail):
                fixed = ""
            if fixed is not None:
                ok_head = fixed.lower().startswith(head.lower())
                ok_tail = fixed.lower().endswith(tail.lower())
                if not ok_head or (ok_head and ok_tail):
                    wrong[i].add("misread")
                if not ok_tail:
                    wrong[j].add("misread")
        elif _odd(head):
            wrong[i].add("misread")
    out: list[str] = []
    fixed_lines: dict[int, str] = {}
    for i, (line, k) in enumerate(zip(lines, kind)):
        if k in ("header", "page_number"):
            wrong[i].add(k)
            continue
        if k != "text":
            continue
        tokens = line.split()
        if any(w.lower() in near for w in parts(line)):  # most lines have nothing to look at
            for t, token in enumerate(tokens):
                if "@" in token and re.search(r"@[\w-]+\.|@\w+$", token) and not _WORDS.fullmatch(token.replace("@", "")) or "://" in token:
                    continue
                for w in parts(token):
                    if w in skip[i] and (t in (0, len(tokens) - 1)):
                        continue
                    better = right(w)
                    if better is not None:
                        wrong[i].add("misread")
                        tokens[t] = tokens[t].replace(w, better)
        fixed_lines[i] = " ".join(tokens)
    order = sorted(fixed_lines)
    glue = ""
    for at, i in enumerate(order):
        s = fixed_lines[i]
        if i in cut:
            s = s[:-1] + ("-" if cut[i][1] else "")
        new = out and glue == " " and any(k == "blank" for k in kind[order[at - 1] + 1 : i]) and out[-1].rstrip().endswith((".", "!", "?", ":"))
        if out and not new:
            out[-1] += glue + s
        else:
            out.append(s)
        glue = "" if i in cut else " "
    return "\n\n".join(out), [{"line_no": i, "kind": k} for i in sorted(wrong) for k in sorted(wrong[i])]


def vocabulary(chunks: DataFrame, least: int = 8) -> DataFrame:
    """``word, n``: words and hyphened words, in lower case, that ``least`` chunks of two sites have.

    Only chunks that were not scanned count; counts are summed up per batch before they move.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = pc.split_pattern_regex(pc.utf8_lower(batch.column("text")), r"[^\p{L}-]+")
            row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(tokens).to_numpy(zero_copy_only=False))
            coded = tokens.flatten().dictionary_encode()
            # what each different token counts for: itself, or with hyphens its parts and the whole
            words: dict[str, int] = {}
            of, sizes = [], []
            for token in coded.dictionary.to_pylist():
                found = ([token] if token else []) if "-" not in token else [*_WORDS.findall(token), *_HYPHENED.findall(token)]
                of += [words.setdefault(w, len(words)) for w in found]
                sizes.append(len(found))
            if not words:
                continue
            of, sizes = np.array(of), np.array(sizes)
            codes = coded.indices.to_numpy(zero_copy_only=False)
            first, times = (np.cumsum(sizes) - sizes)[codes], sizes[codes]
            place = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(first, times)
            once = np.unique(of[place].astype(np.int64) * batch.num_rows + np.repeat(row, times))  # a word once a chunk
            word, row = once // batch.num_rows, once % batch.num_rows
            sites = batch.column("domain").to_pylist()
            names = sorted(set(sites))
            ranks = {name: i for i, name in enumerate(names)}
            site = np.array([ranks[x] for x in sites])[row]
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            at = lambda ranks: pa.array(names, pa.string()).take(pa.array(ranks))
            said = pa.array(list(words), pa.string()).take(pa.array(word[starts]))
            yield pa.RecordBatch.from_pydict({"word": said, "n": pa.array(np.diff(np.append(starts, len(word)))), "low": at(np.minimum.reduceat(site, starts)), "high": at(np.maximum.reduceat(site, starts))})

    clean = chunks.where("text is not null and ocr_confidence is null").select("text", F.coalesce("domain", F.lit("")).alias("domain"))
    counted = clean.mapInArrow(count, "word string, n bigint, low string, high string").groupBy("word").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    return counted.where((F.col("n") >= least) & ((F.col("low") < F.col("high")) | (F.col("n") >= 8 * least))).select("word", "n")


def candidates(unknown: DataFrame, words: DataFrame, length: int = 2) -> DataFrame:
    """``word, near``: all known words within two readings of every unknown word.

    Known words with the same first ``length`` characters make a trie; an unknown word visits those tries
    whose prefix its automaton accepts the beginnings of.
    """

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(w, p) for w in batch.column("word").to_pylist() for p in LevenshteinAutomaton(w, 2).prefixes(length)]
            yield pa.RecordBatch.from_pydict({"word": pa.array([w for w, _ in rows], pa.string()), "prefix": pa.array([p for _, p in rows], pa.string())})

    known = words.select(F.col("word").alias("known"), "n", F.substring("word", 1, length).alias("kprefix"))
    asked = unknown.select("word").mapInArrow(begin, "word string, prefix string")
    asked = asked.join(known.select(F.col("kprefix").alias("prefix")).distinct(), "prefix", "left_semi")
    struct = pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())]))

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        trie = Trie(zip(right.column("known").to_pylist(), right.column("n").to_pylist()))
        found: dict[str, list] = {}
        for w in left.column("word").to_pylist():
            if near := trie.near(w, 2):
                found[w] = [{"word": a, "n": n} for a, n in near]
        return pa.table({"word": pa.array(list(found), pa.string()), "near": pa.array(list(found.values()), struct)})

    pairs = asked.groupBy("prefix").cogroup(known.groupBy("kprefix")).applyInArrow(look, "word string, near array<struct<word:string,n:bigint>>")
    return pairs.groupBy("word").agg(F.flatten(F.collect_list("near")).alias("near"))


_TOLD = "block int, doc_id string, what string, word string, n bigint, sure boolean, returning boolean"


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What chunks say about their documents: keys of lines that may be headers, words, words made of halves."""
    for batch in batches:
        rows: dict[tuple, list] = {}
        for block, doc, text in zip(*(batch.column(c).to_pylist() for c in ("block", "doc_id", "text"))):
            for line in map(str.strip, text.split("\n")):
                if _counted(line):
                    rows.setdefault((block, doc, "line", _key(line)), [0, False, False])[0] += 1
            for key, (sure, returning) in layout(text)[1].items():
                row = rows.setdefault((block, doc, "line", key), [0, False, False])
                row[1] |= sure
                row[2] |= returning
            words, whole = _words_of(text)
            for w, n in words.items():
                rows.setdefault((block, doc, "word", w), [0, False, False])[0] += n
            for w in whole:
                rows.setdefault((block, doc, "half", w), [0, False, False])
        keys, values = list(rows), list(rows.values())
        columns = [pa.array([k[0] for k in keys], pa.int32()), *(pa.array([k[i] for k in keys], pa.string()) for i in (1, 2, 3)), pa.array([v[0] for v in values], pa.int64()), *(pa.array([v[i] for v in values], pa.bool_()) for i in (1, 2))]
        yield pa.RecordBatch.from_arrays(columns, ["block", "doc_id", "what", "word", "n", "sure", "returning"])


def _with_skeletons(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        coded = batch.column("low").dictionary_encode()
        made = pa.array([skeleton(w) for w in coded.dictionary.to_pylist()], pa.string()).take(coded.indices)
        yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in batch.schema.names} | {"skeleton": made})


def repaired(chunks: DataFrame, least: int = 8, per_block: int = 400) -> DataFrame:
    """``id, text, lines``: scanned chunks in continuous paragraphs, and what was wrong with their lines.

    ``lines`` has structs ``line_no, kind`` (header, page_number, hyphen, misread). Chunks without an
    ``ocr_confidence``, an id or any but white space in their text have no row; a chunk delivered twice
    has one. Lines and words are counted over whole documents; a document, however long, is spread over
    as many blocks as its chunks fall into.
    """
    words = staged(vocabulary(chunks, least), "vocabulary")
    scanned = chunks.where("ocr_confidence is not null and id is not null").where(F.regexp_like(F.coalesce("text", F.lit("")), F.lit(r"(?U)\S")))
    one = staged(scanned.groupBy("id").agg(F.max(F.struct(F.coalesce("doc_id", "id").alias("doc_id"), "text")).alias("_r")).select("id", "_r.*"), "scanned")
    blocks = max(1, one.count() // per_block)  # from the files' footers
    rows = one.select("id", "doc_id", "text", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"))
    told = staged(rows.select("block", "doc_id", "text").mapInArrow(_told, _TOLD), "told")

    # lines that come back in their document, or are headers somewhere in it
    lines = told.where("what = 'line'")
    of_doc = lines.groupBy(F.col("doc_id").alias("_doc"), F.col("word").alias("_word")).agg(F.sum("n").alias("_n"), F.max("sure").alias("_sure"), F.max("returning").alias("_returning"))
    of_doc = of_doc.select("_doc", "_word", (F.col("_n") > 1).alias("again"), (F.col("_sure") | ((F.col("_n") > 1) & F.col("_returning"))).alias("sure")).where("again or sure")
    on = (F.col("doc_id") == F.col("_doc")) & (F.col("word") == F.col("_word"))
    headers = lines.select("block", "doc_id", "word").distinct().join(of_doc, on).select("block", "doc_id", "word", "again", "sure")

    # unknown words, their candidates, and the document's spellings that look like them
    unknown = told.where("what <> 'line'").withColumn("low", F.lower("word")).join(words.select(F.col("word").alias("low")), "low", "left_anti")
    unknown = unknown.select("block", "doc_id", "what", "word", "low", "n").mapInArrow(_with_skeletons, "block int, doc_id string, what string, word string, low string, n bigint, skeleton string")
    unknown = staged(unknown, "unknown")
    near = candidates(unknown.select(F.col("low").alias("word")).distinct(), words).withColumnRenamed("word", "_low")
    spelled = unknown.where("what = 'word'").groupBy("doc_id", "skeleton", "word").agg(F.sum("n").alias("n"))
    alike = spelled.groupBy(F.col("doc_id").alias("_doc"), F.col("skeleton").alias("_skeleton")).agg(F.collect_list(F.struct("word", "n")).alias("alike"))
    resolved = unknown.join(near, F.col("low") == F.col("_low"), "left").join(alike, (F.col("doc_id") == F.col("_doc")) & (F.col("skeleton") == F.col("_skeleton")), "left")
    resolved = resolved.select("block", "doc_id", "word", "low", "near", "alike").dropDuplicates(["block", "doc_id", "low"])
    none = lambda kind: F.lit(None).cast(kind)
    known = resolved.select(F.col("block").alias("of"), "doc_id", "word", "low", "near", "alike", none("boolean").alias("again"), none("boolean").alias("sure")).unionByName(
        headers.select(F.col("block").alias("of"), "doc_id", "word", none("string").alias("low"), none("array<struct<word:string,n:bigint>>").alias("near"), none("array<struct<word:string,n:bigint>>").alias("alike"), "again", "sure")
    )

    def mend(left: pa.Table, right: pa.Table) -> pa.Table:
        near: dict[str, list | None] = {}
        alike: dict[str, dict[str, list]] = defaultdict(dict)
        again, sure = defaultdict(set), defaultdict(set)
        for doc, word, low, options, same, comes_back, header in zip(*(right.column(c).to_pylist() for c in ("doc_id", "word", "low", "near", "alike", "again", "sure"))):
            if low is None:
                if comes_back:
                    again[doc].add(word)
                if header:
                    sure[doc].add(word)
            else:
                near[low] = options
                if same is not None:
                    alike[doc][low] = same
        out = []
        for name, doc, text in zip(*(left.column(c).to_pylist() for c in ("id", "doc_id", "text"))):
            out.append((name, *_repair(text, layout(text, again[doc], sure[doc])[0], near, alike[doc])))
        kind = pa.list_(pa.struct([("line_no", pa.int32()), ("kind", pa.string())]))
        return pa.table({"id": pa.array([r[0] for r in out], pa.string()), "text": pa.array([r[1] for r in out], pa.string()), "lines": pa.array([r[2] for r in out], kind)})

    return rows.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(mend, "id string, text string, lines array<struct<line_no:int,kind:string>>")


def faulty_lines(mended: DataFrame) -> DataFrame:
    """``id, line_no, kind`` of all that was wrong."""
    return mended.select("id", F.explode("lines").alias("l")).select("id", "l.line_no", "l.kind").distinct()
