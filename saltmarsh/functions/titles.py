"""Titles and descriptions of catalogue records, where a callback per word is needed: Arrow batches, never row by row."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .text import MOJIBAKE_MARKS

# Words that stay small inside a title, words with one spelling, signs, and words whose accents are restored.
STOPWORDS = {"a", "al", "con", "de", "del", "el", "en", "la", "las", "los", "para", "por", "y"}
PROTECTED = ("ADN", "AHA's", "BE", "CICABOOST", "DMAE", "DNA", "EXOS+", "FPS", "INCI", "PDRN+", "PERT+", "Q10", "TCA", "ZN")
SIGNS = ("&", "+", "/", "P/")
CORRECTIONS = {
    "acido": "Ácido",
    "acidos": "Ácidos",
    "argan": "Argán",
    "colageno": "Colágeno",
    "emulsion": "Emulsión",
    "emulsiones": "Emulsiones",
    "glicolico": "Glicólico",
    "hialuronico": "Hialurónico",
    "locion": "Loción",
    "lociones": "Lociones",
    "mascara": "Máscara",
    "mascaras": "Máscaras",
    "prebioica": "Prebiótica",
    "salicilico": "Salicílico",
    "tonico": "Tónico",
}
# Section names of a description, each of which opens a paragraph.
HEADINGS = (
    "activos",
    "ingredientes",
    "ingredientes clave",
    "inci",
    "puede contener",
    "advertencias",
    "biotipos",
    "modo de uso",
    "sugerencia de uso",
    "presentación",
    "presentaciones",
    "presentaciónes",
    "presentacion",
    "almacenamiento",
    "guardado",
    "protección solar",
    "proteccion solar",
    "características y beneficios",
    "caracteristicas y beneficios",
    "piel radiante y vitalizada",
    "corrección de tono",
    "correccion de tono",
    "frescura y suavidad",
)
# What scanning leaves of badges and columns; whole lines of it; and reviewed corrections, in this order.
NOISE_LINES = r"(?im)^\s*(?:vaya|wyy|dy vena|sede lea paca)\s*[.!,:;]?\s*$"
NOISE = (
    r"(?<!\w)ocrojojo[,:;.!]?\s*",
    r"(?<!\w)aono[,:;.!]?\s*",
    r"(?<!t)\bodo tipo de piel\b",
    r"\bfragance mineral cruelty\b",
    r"\bparaben free\b",
    r"\boil free\b",
    r"\bfree free\b",
    r"(?<!\w)ono(?!\w)",
    r"(?<!\w)precios(?!\w)",
    r"(?m)^\s*crema,?\s*[‘'\"]?gel ligera\s*$",
    r"\bhidra\s*-\s*protect\s+hidrataci[oó]n profunda todo tipo de peles\b",
    r"\bindustra argentina\b",
    r"\bcont neto:\s*\d+(?:[.,]\d+)?\s*g\b",
)
REVIEWED = (
    (r"\bcrema\s+gel,\s*es\s+ideal\s+para\s+todo\s+tipo\s+de\s+pieles\b", "Crema gel, es ideal para todo tipo de pieles"),
    (r"\bpor\s+sus\s+caracter[ií]sticas\b", "Por sus características"),
    (r"\bmetabolizarse\s+convirti[eé]ndose\b", "metabolizarse, convirtiéndose"),
    (r"\bde agua,\s*tal motivo lo convierte en un componente esencial\b", "de agua; por tal motivo, se convierte en un componente esencial"),
    (r"\bLas proteínas de trigo hidrolizadas, posee\b", "Las proteínas de trigo hidrolizadas poseen"),
    (r"\bduradera\s+(?=el\s+sodio\b)", "duradera. "),
    (r"\bpiel\)\s+(?=la\s+hidroxiprolina\b)", "piel). "),
    (r"\ba\s+a\s+la\s+piel\b", "a la piel"),
    (r"\babsorver\b", "absorber"),
    (r"(?m)^\s*guardado\s+(?=guardar\b)", "Guardado: "),
    (r"(?m)^\s*(?:almacenamiento|guardado)\s*:\s*$", ""),
    (r"(?m)^\s*[.\-,:;]+\s*$", ""),
)

_SPELLINGS = {w.casefold(): w for w in PROTECTED}
_OPENINGS = re.compile(rf"(?i)(?=(?:{'|'.join(sorted(HEADINGS, key=len, reverse=True))})\s*:)")
_DROPPED = [re.compile(rf"(?i){p}") for p in NOISE]
_CHANGED = [(re.compile(rf"(?i){p}"), new) for p, new in REVIEWED]
_SENTENCE = re.compile(r"(^|[.!?]\s+)([a-záéíóúñ])")
_LONG_WORD = re.compile(r"\b\w{3,}\b")


_MARK = re.compile(MOJIBAKE_MARKS)


def _marks(text: str) -> int:
    return len(_MARK.findall(text))


def repaired(text: str, rounds: int = 3) -> str:
    """UTF-8 that was read as a legacy code page, read again, while fewer marks of that remain."""
    if text.isascii() or not _MARK.search(text):
        return text
    for _ in range(rounds):
        again = []
        for page in ("cp1252", "latin1"):
            try:
                again.append(text.encode(page).decode())
            except UnicodeError:
                pass
        best = min(again, key=_marks, default=text)
        if _marks(best) >= _marks(text):
            break
        text = best
    return text


def key_of(text: str) -> str:
    """The match key of a word, as functions.text.match_key gives it."""
    folded = unicodedata.normalize("NFKD", repaired(html.unescape(text)).casefold())
    return re.sub("[^a-z0-9]+", "", folded)


def spelled(word: str, opens: bool) -> str:
    """A title's word. Parts of a compound are words of their own; only the title's first part counts as opening it."""
    compound = ["-"] * ("-" in word and word[0] != "-") + ["/"] * ("/" in word and word != "/")
    if compound:
        return compound[0].join(spelled(part, opens and not i) for i, part in enumerate(word.split(compound[0])))
    key = key_of(word)
    known = CORRECTIONS.get(key) or _SPELLINGS.get(word.casefold()) or (word if word in SIGNS else None)
    if known:
        return known
    if key in STOPWORDS and not opens:
        return key
    mixed = not (word.isupper() or word.islower() or word[:1].isupper())
    return word if mixed else word[:1].upper() + word[1:].lower()


def title_text(text: str | None) -> str | None:
    """Title case: small words inside, known spellings, numbers as ``N°3``; bars are spaces, outer dashes go."""
    if text is None:
        return None
    text = " ".join(repaired(html.unescape(text)).replace("|", " ").split()).strip(" -\t")
    text = re.sub(r"(?i)\bN\s*[º°o]?\s*(\d+)\b", r"N°\1", text)
    return " ".join(spelled(w, i == 0) for i, w in enumerate(text.split()))


def _sentences(text: str) -> str:
    return _SENTENCE.sub(lambda m: m[1] + m[2].upper(), text)


def _paragraph(text: str) -> str:
    """Capitals where sentences begin; shouted text, shouted labels and words of mixed case calmed."""
    if text.isupper() and len(text) > 2:
        text = text.lower()
    label, colon, rest = text.partition(":")
    if colon and len(label) >= 2 and label.isupper():
        text = _sentences(label.lower()) + colon + rest

    def calm(m: re.Match) -> str:
        word = m[0]
        return word if word.isupper() or not any(map(str.isupper, word[1:])) else word[:1].upper() + word[1:].lower()

    return _sentences(_LONG_WORD.sub(calm, text))


def description_text(text: str | None) -> str | None:
    """Paragraphs with sentence case: badges and orphan lines go, reviewed phrases are mended, section names open paragraphs."""
    if text is None:
        return None
    text = repaired(html.unescape(text)).replace("\u00a0", " ").replace("\ufb02", "fl")
    text = re.sub(r"[ \t]+", " ", re.sub(r"\r\n?", "\n", text))
    text = re.sub(NOISE_LINES, "", text)
    for pattern in _DROPPED:
        text = pattern.sub(" ", text)
    for pattern, new in _CHANGED:
        text = pattern.sub(new, text)
    paragraphs = (" ".join(p.split()) for p in re.split(r"\n\s*\n+", _OPENINGS.sub("\n\n", text)))
    return "\n\n".join(_paragraph(p) for p in paragraphs if p)


def _mapped(fn: Callable[[str | None], str | None]):
    @F.pandas_udf(StringType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(fn, na_action="ignore")

    return run


def title_case(c: Column) -> Column:
    return _mapped(title_text)(c)


def format_description(c: Column) -> Column:
    return _mapped(description_text)(c)
