"""Personal data in free text: weak labelers vote on candidate spans, a classifier decides.

Candidates come from triggers (signs, capitalised pairs, forms of address, street words, runs of digits).
Labelers of three sorts vote on each: patterns, gazetteers of first and last words of names counted over
the whole corpus, and the words around. Expectation-maximisation estimates how reliable each labeler is on
a bounded sample; a logistic classifier over votes, shapes and hashed context words, trained on the
resulting probabilities, makes the final decision for every span.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.staging import staged

KINDS = ("email", "phone", "id_number", "address", "person_name")

# Wordings of the five languages in use.
TITLES = ["Dr.", "Dr", "Prof.", "Mr.", "Mr", "Mrs.", "Mrs", "Ms.", "Ms", "Herr", "Herrn", "Frau", "Mme", "Mlle", "M.", "Monsieur", "Madame", "Sr.", "Sra.", "Srta.", "Dra.", "Don", "Doña", "Dña.", "Señor", "Señora", "Senhor", "Senhora", "Dona"]
STREETS_BEFORE = ["Calle", "Avenida", "Avda.", "Paseo", "Plaza", "Camino", "Ronda", "Travesía", "Carretera", "Rua", "Largo", "Travessa", "Praça", "Alameda", "Estrada", "Calçada", "Beco", "C/", "Av.", "R."]
STREETS_FRENCH = ["rue", "avenue", "boulevard", "impasse", "place", "chemin", "quai", "allée", "route", "cours", "passage", "square", "Rue", "Avenue", "Boulevard", "Impasse", "Place", "Chemin", "Quai", "Allée"]
STREETS_AFTER = ["Street", "St", "Road", "Rd", "Lane", "Ln", "Avenue", "Ave", "Crescent", "Quay", "Terrace", "Drive", "Court", "Close", "Way", "Place", "Square", "Boulevard", "Blvd", "Row", "Walk", "Gardens", "Hill", "Parade", "Mews"]
STREETS_GERMAN = ["straße", "strasse", "str.", "weg", "gasse", "platz", "allee", "ring", "ufer", "damm", "steig", "pfad", "markt", "Straße", "Weg", "Platz", "Gasse", "Allee"]
_MAIL = re.compile(r"[\w.+-]*\w[\w.+-]*(?: ?(?:\(at\)|\[at\]|\(arroba\)) ?| AT |@)[\w-]+(?:(?:\.| ?(?:\(dot\)|\[dot\]|\(punto\)|\(ponto\)) ?| DOT )[\w-]+)+", re.UNICODE)
_RUN = re.compile(r"(?<![\w@.,/+-])(?:\(?\+|\()?\d[\d ()./–-]{4,}\d(?![\w@])(?:,? (?:ext\.?|x|Durchwahl|Dw\.?|poste|extensión|ramal) ?\d{1,5})?")
_NUMBERED = re.compile(r"(?<![\w@.-])(?:(?!DNI|NIF|NIE|NSS|ID\b)[A-Z]{1,3}[ -]?)?\d(?:[ ./-]?[\dA-Z]){5,19}(?![\w@])")
_PARTICLE = r"(?:(?:de la|de|du|van der|van|von|zu|da|do|dos|del|la|DE|DU|VAN|VON|ZU|DA|DO)\s{1,2})?"
_LAST = r"[A-ZÀ-Þ](?:'[A-ZÀ-Þ])?[\wÀ-ÿ]+(?:-[A-ZÀ-Þ][\wÀ-ÿ]+)?"
# A first name, initials, a particle and a last name; or the last name before a comma and the first.
_NAME = re.compile(rf"(?<![\w@.+'-])(?=([A-ZÀ-Þ][\wÀ-ÿ-]+(?:\s{{1,2}}(?:[A-ZÀ-Þ]\.)){{0,2}}\s{{1,2}}{_PARTICLE}{_LAST}|{_PARTICLE}{_LAST},\s{{1,2}}[A-ZÀ-Þ][\wÀ-ÿ-]+(?! ?\d))(?![\w@]))")
_TITLED = re.compile(rf"[A-ZÀ-Þ](?:\.|[\wÀ-ÿ-]+)(?:\s{{1,2}}[A-ZÀ-Þ]\.){{0,2}}(?:\s{{1,2}}{_PARTICLE}{_LAST})?")
_WORD = re.compile(r"[^\W\d_]+")
_INITIAL = re.compile(r"(?<![\w.&-])(?:[A-ZÀ-Þ]\. ?){1,2}(?:(?:de|van|von|zu|da|do|dos|del) )?([A-ZÀ-Þ](?:'[A-ZÀ-Þ])?[a-zß-ÿ]+(?:-[A-ZÀ-Þ][a-zß-ÿ]+)?)")
# After street and number: a floor or flat, then postcode and town in either order.
_TOWN = re.compile(r"\.?(?:,? (?:Floor|Apt|Flat|Unit|Suite|piso|andar|étage|Etage|bâtiment) ?\w{1,4})?(?:, (?:\d{4,5}(?:-\d{3})? [A-ZÀ-Þ][\w-]+|[A-ZÀ-Þ][\w-]+(?: \d{5})?))?")
_FRENCH = re.compile(r"\b(?:le|la|les|de|du|par|rappelle|demande|notes)\s+$", re.IGNORECASE)
_CALL = re.compile(r"(?:call|phone(?: on| at)?|tel\.?|tél\.?|telephone|fon|mobile|anrufen|appelez(?: le)?|llame al|llamar al|ligue para|teléfono|telefone|téléphone|\bau|\bal|\bhas|\bhat|\ba le|\btem|\btiene|number is|unter|erreichbar|bitte|\|)[\s:]*$", re.IGNORECASE)
_CALL_AFTER = re.compile(r"^\s*(?:anrufen|if \w+ stays|si \w+ (?:ne|no)|se a \w+ não|\|)", re.IGNORECASE)
_ID_WORDS = re.compile(r"(?:national id|passport|social security|security number|\bid=|id card|Ausweisnummer|Ausweis|Personalausweis|Steuer-?ID|Sozialversicherungs\w*|sécurité sociale|numéro de sécu|carte d'identité|\bDNI|\bNIE|\bNIF|\bNSS|seguridad social|contribuinte|cidadão|segurança social|documento)[^|;\n]{0,14}$", re.IGNORECASE)
_ID_WORDS_BEFORE = re.compile(_ID_WORDS.pattern.replace("{0,14}", "*"), re.IGNORECASE)
# Forms of address and words of bylines, contacts and applications in the five languages.
_PERSON_LEFT = re.compile(r"(?:(?:^|\n)[^\w\n]*(?:by|por|von|par)\s+|\b(?:written by|rédigé par|escrito por|contact|kontakt|contacto|contato|text|texto de|applicant|antragsteller|demandeur|solicitante|requerente|name|dr|prof|mr|ms|mrs|herrn?|frau|mme|mlle|m|sr|sra|dra|don|doña))\.?\s?[:=]?\s*$", re.IGNORECASE)
# Articles, after which a capitalised word is no name of a person.
_ARTICLE = re.compile(r"\b(?:the|a|an|der|die|das|den|dem|des|ein|eine|le|la|les|un|une|el|los|las|una|o|os|as|um|uma)\s+$", re.IGNORECASE)
_BEGINS_OTHERWISE = re.compile(_ARTICLE.pattern.replace("(?:the", "(?:by|por|von|par|the").removesuffix("$"), re.IGNORECASE)

BUCKETS = 1 << 20
WEIGHTS = 1 << 15
_TOKEN = re.compile(r"\w+|[^\w\s]")


def _bucket(word: str, size: int) -> int:
    return zlib.crc32(word.encode()) % size


class Gazetteer:
    """For every word, how much likelier than others it begins (or ends) a name where persons are named.

    A table of fixed size, whatever the corpus: words fall into buckets, of which each has one signed byte.
    """

    def __init__(self, counts: np.ndarray, seen: np.ndarray):
        usual = (counts.sum() + 0.5) / (seen.sum() + 1)
        rate = (counts + 4 * usual) / (seen + 4)
        odds = np.log(rate / np.maximum(1 - rate, 1e-3)) - np.log(usual / max(1 - usual, 1e-3))
        self.table = np.clip(np.rint(odds * 16), -127, 127).astype(np.int8)
        self.memo: dict[str, float] = {}

    def __call__(self, word: str) -> float:
        known = self.memo.get(word)
        if known is None:
            known = float(self.table[_bucket(word.lower(), BUCKETS)]) / 16
            if len(self.memo) < 300_000:
                self.memo[word] = known
        return known


def _mail_nearby(span: str, after: str) -> bool:
    """Whether a mail address behind a name has its first or last word."""
    if "@" not in after and "(at)" not in after and "[at]" not in after:
        return False
    last = [w.lower() for w in _WORD.findall(span) if len(w) > 3]
    return bool(last) and any(re.search(rf"{w}[\w.+-]* ?(?:@|\(at\)|\[at\])", after.lower()) for w in (last[0], last[-1]))


def labelers(kind: str, first: Gazetteer, last: Gazetteer) -> list[Callable[[str, str, str], int]]:
    """Functions of a span and the text on its left and right: 1 for, -1 against, 0 silent."""
    digits = lambda s: sum(c.isdigit() for c in s)
    lean = lambda x: 1 if x > 1 else -1 if x < -1 else 0
    if kind == "email":
        return [
            lambda s, a, b: 1 if re.search(r"(?:\.|DOT|\(dot\)|\[dot\]|\(punto\)|\(ponto\)) ?[A-Za-z]{2,}$", s) else -1,
            lambda s, a, b: -1 if re.search(r"@\d", s) else 1,
            lambda s, a, b: 1 if re.search(r"(?:write to|schreiben an|écrire à|escriba a|escreva para|mail|<|=|contact\w*|adresse|\|)\s*$", a, re.IGNORECASE) else 0,
            lambda s, a, b: -1 if re.search(r"(?:run|aufruf|lancer|ejecutar|executar|import)\s*$", a, re.IGNORECASE) else 0,
            lambda s, a, b: -1 if re.match(r"\s*\w+ @\w", b) else 0,
            lambda s, a, b: 1 if re.match(r"[\w.+-]{2,}", s) else -1,
        ]
    if kind == "phone":
        return [
            lambda s, a, b: 1 if s[0] in "+(" else 0,
            lambda s, a, b: 1 if re.match(r"\(?0\d|00\d", s) else 0,
            lambda s, a, b: 1 if re.match(r"(?:1[-. ])?\(?\d{3}\)?[-. ]+\d{3}[-. ]+\d{3,4}\b", s) or re.match(r"[29]00\d{6}$|[29]00[ -]", s) else 0,
            lambda s, a, b: 1 if _CALL.search(a) else 0,
            lambda s, a, b: 1 if _CALL_AFTER.search(b) else 0,
            lambda s, a, b: -1 if _ID_WORDS.search(a) else 0,
            lambda s, a, b: 0 if 9 <= digits(s) <= 15 else -1,
            lambda s, a, b: 1 if re.search(r"(?:@|\(at\)|\[at\])[^\n]*[^\w\n]$", a) else 0,
            lambda s, a, b: -1 if re.match(r"\d{3}-\d{2}-\d{4}$|\d{1,2}-\d{1,2}-\d{4}$|(\d{4})\1$|\d{4}-\d{2}-\d{2}|\d{5} \d{4} \d{2}$", s) else 0,
        ]
    if kind == "id_number":
        return [
            lambda s, a, b: 1 if _ID_WORDS.search(a) else -1,
            lambda s, a, b: 1 if _ID_WORDS_BEFORE.search(a) else -1,
            lambda s, a, b: 1 if re.match(r"\d{3}[- ]\d{2}[- ]\d{4}$", s) else 0,
            lambda s, a, b: 1 if re.match(r"[A-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-Z]$|[XYZL]\d{2}", s) else 0,
            lambda s, a, b: -1 if _CALL.search(a) or _CALL_AFTER.search(b) else 0,
        ]
    if kind == "address":
        return [
            lambda s, a, b: 1 if re.search(r"\d", s) else -1,
            lambda s, a, b: 1 if re.search(r"(?:to|at|an|in|in der|à|habite(?: au)?|wohnhaft|en|a|em|para|vive en|reside en|,|:|\|)\s*$", a) else 0,
            lambda s, a, b: 1 if re.match(r"\.?,? ?(?:Floor \d+, |[^,\n]{0,16}, )?(?:\d{4,5}(?:-\d{3})? [A-ZÀ-Þ]|[A-ZÀ-Þ][a-zß-ÿ]+)", b) else 0,
            lambda s, a, b: -1 if re.search(r"(?:section|number|version|Nummer|numéro|número)\s*$", a) else 0,
            lambda s, a, b: 1 if re.search(r"[A-ZÀ-Þ]", s) else -1,
        ]
    return [
        lambda s, a, b: lean(first(_ends(s)[0])),
        lambda s, a, b: lean(last(_ends(s)[1])),
        lambda s, a, b: 1 if _PERSON_LEFT.search(a) and not s.isupper() else 0,
        lambda s, a, b: 1 if _mail_nearby(s, b) else 0,
        lambda s, a, b: 1 if re.search(r"\b[A-ZÀ-Þ]\.\s", s) else 0,
        lambda s, a, b: -1 if _ARTICLE.search(a) or _BEGINS_OTHERWISE.match(s) else 0,
        lambda s, a, b: -1 if re.search(r"\d|@", s) or re.match(r"[\w.]*@|\.\w", b) or a.endswith(("@", "/")) else 0,
        lambda s, a, b: -1 if "\n" in s else 0,
        lambda s, a, b: -1 if s.isupper() and first(_ends(s)[0]) <= 0 else 0,
    ]


@functools.lru_cache(maxsize=200_000)
def _ends(name: str) -> tuple[str, str]:
    """First and last word of a name, whichever comes first in the text."""
    words = _WORD.findall(name.split(",")[-1] + " " + name.split(",")[0] if "," in name else name)
    return (words[0], words[-1]) if words else ("", "")


class Finder:
    """Candidate spans of a text."""

    def __init__(self, first: Gazetteer, last: Gazetteer):
        import ahocorasick

        self.first, self.last = first, last
        words: dict[str, str] = {w + " ": "title" for w in TITLES}
        words |= {w + " ": "before" for w in STREETS_BEFORE} | {w + " ": "french" for w in STREETS_FRENCH}
        words |= {w + " ": "german" for w in STREETS_GERMAN}
        words |= {" " + w: "after" for w in STREETS_AFTER}
        words |= {x: "mail" for x in ("@", "(at)", "[at]", " AT ", "(arroba)")}
        self.automaton = ahocorasick.Automaton()
        for w, kind in words.items():
            self.automaton.add_word(w, (kind, len(w)))
        self.automaton.make_automaton()
        self.memo: dict[tuple, list[int]] = {}

    def __reduce__(self):
        return Finder, (self.first, self.last)

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        found: list[tuple[str, int, int]] = []
        for end, (kind, size) in self.automaton.iter(text):
            start, end = end - size + 1, end + 1
            if kind == "title":
                if start and (text[start - 1].isalnum() or text[start - 1] in "._-"):
                    continue
                if size == 3 and text.startswith("M.", start) and not _FRENCH.search(text, max(0, start - 14), start):
                    continue  # an initial
                name = _TITLED.match(text, end)
                if name and name.group() not in _TITLES and not name.group().endswith("."):
                    found.append(("person_name", end, name.end()))
            elif kind == "mail":
                low = start
                while low and start - low < 64 and (text[low - 1].isalnum() or text[low - 1] in "._+-" or (text[low - 1] == " " and low == start and kind == "mail" and text[start] in "([")):
                    low -= 1
                while low < start and text[low] in ".-+ ":
                    low += 1
                m = _MAIL.match(text, low)
                if m and m.end() > end and low < start:
                    found.append(("email", low, m.end()))
            elif kind == "before":
                m = re.compile(r"(?:(?:de la|del|de los|de las|de|do|da|dos|das) )?[A-ZÀ-Þ][\wÀ-ÿ'-]+(?: [A-ZÀ-Þ][\wÀ-ÿ'-]+)?,? (?:n\.?º ?|núm\. ?|n\. ?)?\d{1,4}").match(text, end)
                if m and not (start and text[start - 1].isalnum()):
                    found.append(("address", start, m.end()))
            elif kind == "french":
                number = re.search(r"(?<![\w.,-])\d{1,4}(?: ?(?:bis|ter))?,? $", text[max(0, start - 14) : start])
                m = re.compile(r"(?:(?:de la|du|des|de|de l'|d') ?)?[A-ZÀ-Þ][\wÀ-ÿ'-]+").match(text, end)
                if number and m:
                    found.append(("address", max(0, start - 14) + number.start(), m.end()))
            elif kind == "german":
                m = re.compile(r"\d{1,4} ?[a-z]?\b(?! \w*\d)").match(text, end)
                if m:
                    low = start
                    while low and (text[low - 1].isalpha() or text[low - 1] == "-"):
                        low -= 1
                    if low == start:  # a street word of its own after the name
                        before = re.search(r"(?:(?:Am|An der|Im|In der|Zum|Zur) )?[A-ZÄÖÜ][\wäöüß-]+ $", text[max(0, start - 30) : start])
                        low = max(0, start - 30) + before.start() if before else -1
                    if low >= 0 and text[low].isupper():
                        found.append(("address", low, m.end()))
            elif kind == "after":
                if end < len(text) and (text[end].isalnum() or text[end] in "'-"):
                    continue
                m = re.search(r"(?<![\w.,-])\d{1,4}[A-Za-z]?(?: [A-ZÀ-Þ][\wÀ-ÿ'-]+){1,3}$", text[max(0, start - 48) : start])
                if m:
                    found.append(("address", max(0, start - 48) + m.start(), end))
        found += names_in(text)
        for m in _INITIAL.finditer(text):
            french = m.group().startswith("M. ") and _FRENCH.search(text, max(0, m.start() - 14), m.start())
            if not french:
                found.append(("person_name", m.start(), m.end()))
        for m in _RUN.finditer(text):
            n = sum(c.isdigit() for c in m.group())
            if 7 <= n <= 20 and "  " not in m.group() and m.group().count("(") == m.group().count(")"):
                found.append(("phone", m.start(), m.end()))
        for m in _NUMBERED.finditer(text):
            if sum(c.isdigit() for c in m.group()) >= 6:
                found.append(("id_number", m.start(), m.end()))
        return list(dict.fromkeys(found))

    def votes(self, text: str, span: tuple[str, int, int]) -> list[int]:
        kind, start, end = span
        a, b = text[max(0, start - (24 if kind == "person_name" else 56)) : start], text[end : end + 56]
        return [vote(text[start:end], a, b) for vote in self.by_kind[kind]]

    @property
    def by_kind(self) -> dict[str, list]:
        if not hasattr(self, "_by_kind"):
            self._by_kind = {k: labelers(k, self.first, self.last) for k in KINDS}
        return self._by_kind

    def features(self, text: str, span: tuple[str, int, int]) -> tuple[list[int], list[int]]:
        """A span's votes, and the buckets of its features: votes, shape and the words around."""
        kind, start, end = span
        votes = self.votes(text, span)
        said = text[start:end]
        left = _TOKEN.findall(text[max(0, start - 30) : start].lower())[-3:]
        right = _TOKEN.findall(text[end : end + 24].lower())[:2]
        mark, memo = kind[0], self.memo
        known = memo.get((mark, *votes))
        if known is None:
            known = self._remember((mark, *votes), [f"v{j}{v}" for j, v in enumerate(votes)] + ["b"])
        out = [*known, *[at for i, w in enumerate(reversed(left)) for at in self._one(mark, "l", i, w)], *[at for i, w in enumerate(right) for at in self._one(mark, "r", i, w)], *self._one(mark, "l", "", " ".join(left[-2:]))]
        if kind in ("phone", "id_number", "person_name"):
            shaped = memo.get((mark, said))
            if shaped is None:
                shaped = self._remember((mark, said), self._shape(kind, said))
            out += shaped
        return votes, out

    def _shape(self, kind: str, said: str) -> list[str]:
        if kind != "person_name":
            return ["s" + re.sub(r"\d+", lambda m: str(len(m.group())), said)]
        one, two = (g(w) for g, w in zip((self.first, self.last), _ends(said)))
        return ["s" + re.sub(r"[A-ZÀ-Þ]", "A", re.sub(r"[^\W\d_A-ZÀ-Þ]+", "a", said)), f"f{round(one)}", f"g{round(two)}", f"fg{round(one / 2)}{round(two / 2)}"]

    def _one(self, mark: str, side: str, place: int | str, word: str) -> list[int]:
        key = (mark, side, place, word)
        return self.memo.get(key) or self._remember(key, [f"{side}{place}{word}"])

    def _remember(self, key: tuple, named: list[str]) -> list[int]:
        """Buckets of features, kept so that each is hashed once as long as there is room."""
        made = [_bucket(key[0] + f, WEIGHTS) for f in named]
        if len(self.memo) < 300_000:
            self.memo[key] = made
        return made


_DIGIT = re.compile(r"\d")
_TITLES = frozenset(t.rstrip(".") for t in TITLES)


def names_in(text: str) -> list[tuple[str, int, int]]:
    """Capitalised pairs that may be names of persons."""
    out = []
    for m in _NAME.finditer(text):
        low, high = m.span(1)
        words = text[low:high].split()
        if words[0].rstrip(".") not in _TITLES and words[-1] not in _TITLES and not _DIGIT.search(text, low, high):
            out.append(("person_name", low, high))
    return out


def estimate(votes: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Probability that each span is one, by expectation-maximisation over the labelers' reliabilities.

    A labeler has, for true and for false spans, a chance of each vote; more rounds sharpen these, and its
    silence says nothing. It begins with the labelers' majority.
    """
    p = 1 / (1 + np.exp(-1.5 * votes.sum(1)))
    for _ in range(rounds):
        prior = np.clip(p.mean(), 0.02, 0.98)
        score = np.full(len(votes), np.log(prior / (1 - prior)))
        for j in range(votes.shape[1]):
            for v in (-1, 1):
                at = votes[:, j] == v
                yes = (p[at].sum() + 1) / (p.sum() + 3)
                no = ((1 - p[at]).sum() + 1) / ((1 - p).sum() + 3)
                # a vote for is never taken as one against, nor the other way round
                weight = np.log(yes / no)
                score[at] += max(weight, 0) if v == 1 else min(weight, 0)
        p = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
    return p


def logistic(features: np.ndarray, y: np.ndarray, rounds: int = 300, rate: float = 2.0, decay: float = 1e-4) -> np.ndarray:
    """Weights of a logistic classifier; each row of ``features`` has the buckets that are set in it."""
    n, width = features.shape
    w = np.zeros(WEIGHTS)
    seen, at = np.unique(features, return_inverse=True)
    at, v, squares = at.reshape(n, width), np.zeros(len(seen)), np.full(len(seen), 1e-8)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(v[at].sum(1), -30, 30)))
        grad = np.bincount(at.reshape(-1), np.repeat((p - y) / n, width), len(seen)) + decay * v
        squares += grad * grad
        v -= rate * grad / np.sqrt(squares) / width
    w[seen] = v
    return w


class Classifier:
    """The final span classifier: weights over votes, shapes and context words, of each kind."""

    def __init__(self, finder: Finder, texts: list[str], most: int = 60_000):
        rows: dict[str, list] = defaultdict(list)
        for text in texts:
            for span in finder.spans(text):
                if len(rows[span[0]]) < most:
                    rows[span[0]].append(finder.features(text, span))
        self.weights: dict[str, list[float]] = {}
        for kind in KINDS:
            if rows[kind]:
                width = max(len(f) for _, f in rows[kind])
                padded = np.array([f + f[-1:] * (width - len(f)) for _, f in rows[kind]])
                self.weights[kind] = logistic(padded, estimate(np.array([v for v, _ in rows[kind]], np.int8))).tolist()
            else:
                self.weights[kind] = [0.0] * WEIGHTS

    def score(self, kind: str, features: list[int]) -> float:
        w = self.weights[kind]
        return sum(w[i] for i in features)

    def found(self, finder: Finder, text: str) -> list[tuple[int, int, str]]:
        """Spans judged to be personal data; of overlapping ones the surest, the longest of those that are sure."""
        scored = []
        for span in finder.spans(text):
            s = self.score(span[0], finder.features(text, span)[1])
            if s > 0:
                plain = "," not in text[span[1] : span[2]] or span[0] != "person_name"  # rather first and last name than last and first
                scored.append((span[0] == "email", min(s, 2.0), plain, span[2] - span[1], span))
        kept: list[tuple[int, int, str]] = []
        for *_, (kind, start, end) in sorted(scored, key=lambda x: x[:4], reverse=True):
            if kind == "address":
                end = _TOWN.match(text, end).end()
            if all(end <= a or start >= b for a, b, _ in kept):
                kept.append((start, end, kind))
        return sorted(kept)


def gazetteers(texts: DataFrame) -> tuple[Gazetteer, Gazetteer]:
    """Gazetteers of first and last words of names, by all capitalised pairs of the corpus.

    First words are judged by how often a cue is before the name, last words also by their first words.
    Counts are summed up per batch before they move; what comes to the driver is at most ``BUCKETS`` rows
    of three numbers for each, whatever the corpus.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, named = [], []
            for text in batch.column("text").to_pylist():
                for _, low, high in names_in(text):
                    if text[low:high].isupper():
                        continue  # headings in capitals say nothing about words
                    one, two = _ends(text[low:high])
                    pairs.append(_bucket(one.lower(), BUCKETS) * BUCKETS + _bucket(two.lower(), BUCKETS))
                    named.append(bool(_PERSON_LEFT.search(text, max(0, low - 24), low)) and "\n" not in text[low:high])
            pair, of = np.unique(np.array(pairs, np.int64), return_inverse=True)
            n, persons = np.bincount(of.reshape(-1), minlength=len(pair)), np.bincount(of.reshape(-1), np.array(named, np.float64), len(pair)).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"one": pa.array(pair // BUCKETS), "two": pa.array(pair % BUCKETS), "n": pa.array(n, pa.int64()), "persons": pa.array(persons, pa.int64())})

    def table(counts: DataFrame, column: str) -> Gazetteer:
        rows = counts.groupBy(column).agg(F.sum("n").alias("n"), F.sum("persons").alias("persons")).toArrow()
        seen, persons = np.zeros(BUCKETS), np.zeros(BUCKETS)
        at = rows.column(column).to_numpy()
        seen[at], persons[at] = rows.column("n").to_numpy(), rows.column("persons").to_numpy()
        return Gazetteer(persons, seen)

    pairs = texts.where("text is not null").select("text").mapInArrow(count, "one bigint, two bigint, n bigint, persons bigint")
    pairs = staged(pairs.groupBy("one", "two").agg(F.sum("n").alias("n"), F.sum("persons").alias("persons")), "pairs")
    first = table(pairs, "one")

    def by_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # a known first name makes a name wherever it stands
            n, persons = batch.column("n").to_numpy(), batch.column("persons").to_numpy()
            known = first.table[batch.column("one").to_numpy()] > 16
            yield pa.RecordBatch.from_pydict({"two": batch.column("two"), "n": batch.column("n"), "persons": pa.array(np.where(known, n, persons))})

    return first, table(pairs.mapInArrow(by_first, "two bigint, n bigint, persons bigint"), "two")


def personal_data(chunks: DataFrame, kinds: DataFrame, sample: int = 4000) -> DataFrame:
    """``id, text, pii, pii_types, spans``: every chunk with placeholders in place of personal data.

    ``kinds`` gives the placeholders (at most 1000 rows); ``spans`` are structs ``kind, start, end`` in
    code points of the old text. A chunk delivered twice has one row; rows without id are left out; a null
    text stays null and has none. At most ``sample`` chunks, picked by hash, train the classifier.
    """
    rows = kinds.where("kind is not null and placeholder is not null").limit(1001).collect()
    if len(rows) > 1000:
        raise ValueError("more than 1000 kinds")
    placeholders = {k: f"[{k.upper()}]" for k in KINDS} | {r.kind: r.placeholder for r in rows}
    texts = chunks.where("id is not null").select("id", "text")
    names = gazetteers(texts)
    every = max(1, texts.select("id").count() // sample)
    picked = texts.where(F.col("text").isNotNull() & (F.pmod(F.xxhash64("id"), F.lit(every)) == 0)).orderBy(F.xxhash64("id")).limit(sample).toArrow()
    model = Classifier(Finder(*names), picked.column("text").to_pylist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(*names)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            out, spans, types = [], [], []
            for text in batch.column("text").to_pylist():
                found = model.found(finder, text) if text else []
                if found:
                    pieces, at = [], 0
                    for start, end, k in found:
                        pieces += [text[at:start], placeholders[k]]
                        at = end
                    out.append("".join([*pieces, text[at:]]))
                else:
                    out.append(text)
                spans.append([{"kind": k, "start": a, "end": b} for a, b, k in found])
                types.append(sorted({k for _, _, k in found}))
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "text": pa.array(out, pa.string()), "pii": pa.array([bool(t) for t in types]), "pii_types": pa.array(types, pa.list_(pa.string())), "spans": pa.array(spans, kind)})

    return texts.mapInArrow(run, "id string, text string, pii boolean, pii_types array<string>, spans array<struct<kind:string,start:int,end:int>>")


def found_data(marked: DataFrame) -> DataFrame:
    """``id, kind, char_start`` of every datum."""
    return marked.select("id", F.explode("spans").alias("s")).select("id", F.col("s.kind").alias("kind"), F.col("s.start").alias("char_start")).distinct()


def redacted(marked: DataFrame) -> DataFrame:
    """``id, text, pii, pii_types``, a row an id."""
    return marked.groupBy("id").agg(F.max(F.struct("text", "pii", "pii_types")).alias("r")).select("id", "r.*")
