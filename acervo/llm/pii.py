"""Personal information inside free text: finding and replacing it.

Method: anchor expansion. One Aho-Corasick automaton over the folded text finds at-signs, number marks, identifier cues,
street cues, titles and given names; deterministic local parsers expand each anchor and validate what they find (mail
syntax, digits of a telephone, check digit of an identity number, house number, shape of a name). A text is read once, and
a parser looks only at the surroundings of its anchor, so the time is linear in the text however long it is.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acervo.llm.lexicon import ACCENTED, FOLD, GIVEN, NICKNAMES

KINDS = ("correo", "telefono", "identidad", "direccion", "nombre")
GIVEN_SET = frozenset(GIVEN) | frozenset(k.translate(FOLD) for k in NICKNAMES)

#: Spellings of given names and nicknames that are anchors.
GIVEN_ANCHORS = frozenset(GIVEN) | frozenset(ACCENTED) | frozenset(NICKNAMES)

# Cues in lower case; those with an accent are looked for without it too.
MAIL = ("@", "(arroba)", "[arroba]", "[at]", "(at)", "{at}", " arroba ")
IDENTITY = ("rut", "r.u.t", "run", "r.u.n", "c.i", "identidad", "pasaporte", "passport")
PHONE = (
    "fono", "cel.", "celular", "contacto", "también", "desde el", "o al", "enquiries", "whatsapp", "tel.", "tel:", "llamar al", "phone", "móvil",
    "+56", "(56", "0056", "(02)", "(09)",
)
PLOT = ("parcela", "lote", "sitio", "kilómetro", " km")
NAME_CUES = (
    "sr.", "sra.", "srta.", "don", "doña", "señor", "señora", "señorita", "vecino", "vecina", "suscribe,", "nombre es", "atte.,", "saluda,", "gracias,", "attention", "contact",
    "asisten:", "firma:", "propiedad de", "solicitado por", "encargo de", "notifíquese a", "ud.,",
)
#: Cues behind which a name needs no known given name, and words of companies, which are no names.
STRONG = frozenset(x for w in ("don", "doña", "señor", "señora", "señorita", "suscribe,", "nombre es", "asisten:", "firma:") for x in (w, w.translate(FOLD)))
COMPANY = frozenset("constructora sociedad comercial empresa empresas inmobiliaria inversiones consultora corporacion fundacion asociacion junta comite banco servicios transportes agricola ferreteria clinica hospital universidad".split())
TITLE = r"(?:(?:el|la|los|las)\s+)?(?:sra?\.|srta\.|don|doña|señor(?:a|ita)?|vecin[oa]|ing\.|arq\.|abog\.|dra?\.|prof\.)"

UP, LOW = "A-ZÁÉÍÓÚÑÜÀÈÌÒÙÂÊÎÔÛ", "a-záéíóúñüàèìòùâêîôû"
_T = f"[{UP}][{LOW}]+(?:['’-][{UP}]?[{LOW}]+)*"
_C = f"[{UP}]{{2,}}(?:['’-][{UP}]+)*"
_L = f"[{LOW}]{{2,}}(?:['’-][{LOW}]+)*"
_PART = r"(?:de\s+(?:la|las|los)|del|de)"

# Words that begin with a capital and belong to no name.
NOT_NAME = frozenset(
    """jefe jefa secretario secretaria subsecretario subsecretaria director directora ministro ministra division departamento alcalde alcaldesa distribucion circular ordenanza
    decreto supremo ley general saluda gracias atte atentamente estimados estimado estimada buenas senores region seremi dom ord ddu ref asisten acta minuta sr sra sres srta don dona
    senor senora vecino vecina inmobiliaria limitada empresa comuna santiago rut run pasaporte cedula avenida av calle pasaje pje camino parcela lote sitio fono cel tel mi quien consulto
    escribo pueden agradecere notifiquese el la los las en y e al por para con que se lo no si de del consulta senala presenta solicita vive soy please contact deliver attention the at and
    correo profesora profesor capitan aviador mirador biblioteca oficina colegio camara contralora gobernaciones mesa sindicato consejo instituto auditoria centro sin tratandose""".split()
)
NOT_STREET = frozenset("del enero febrero marzo abril mayo junio julio agosto septiembre setiembre octubre noviembre diciembre ddu ord supremo ley circular n articulo numeral decreto lamina anexo piso santiago figura cuadro tabla folio codigo dfl ds ud de y a en la el los las pagina pag rol".split())

_MAIL_AT = r"\s?(?:@|\(arroba\)|\[arroba\]|\[at\]|\(at\)|\{at\}|\barroba\b)\s?"
_MAIL_DOT = r"(?:\.|\s?(?:\[dot\]|\(dot\)|\[punto\]|\(punto\)|\bpunto\b)\s?)"
LOCAL = re.compile(rf"[a-z0-9_%+-]+(?:{_MAIL_DOT}[a-z0-9_%+-]+)*$", re.I)
DOMAIN = re.compile(rf"{_MAIL_AT}([a-z0-9-]+(?:{_MAIL_DOT}[a-z0-9-]+)+)", re.I)
AT = re.compile(r"\s?(?:@|\(arroba\)|\[arroba\]|\[at\]|\(at\)|\{at\}|arroba\b)", re.I)
RUT = re.compile(r"(?:[.:\s]|n[°ºo]|n[uú]mero)*?(?<![0-9])([0-9]{1,2}[. ]?[0-9]{3}[. ]?[0-9]{3}\s?[-–‐]?\s?[0-9k])(?![0-9a-z])", re.I)
PASS = re.compile(r"(?:[.:\s]|n[°ºo]|no\.|number|n[uú]mero)*?([a-z]{1,2}\s?[0-9]{6,8})(?![0-9a-z])", re.I)
TEL = re.compile(
    r"(?:\+\s?56|0056|\(\+?56(?:[- ]?[0-9]{1,2})?\)|\(0?[0-9]{1,2}\)|56|0)?[\s.-]*[0-9](?:[\s.-]?[0-9]){6,10}(?![0-9])"
)
#: A mobile number in its usual groups, which needs no cue.
MOBILE = re.compile(r"9[ \xa0-]?[0-9]{4}[ \xa0-][0-9]{4}(?![0-9]|[.,-][0-9kK])")
NUMBER = re.compile(r"(?:,\s*|\s+)?(?:n[°º]\s*|nro\.?\s*|n[uú]mero\s+|#\s*)?([0-9]{1,2}\.[0-9]{3}|[0-9]{1,5})(?![0-9]|[.,][0-9]|\s*(?:%|m2|m²|m\b|d[ií]as|de\s+(?:enero|febrero|marzo|abril|mayo|junio|julio|agosto|se[pt]+iembre|octubre|noviembre|diciembre)\b))", re.I)
UNIT = re.compile(r"(?:,?\s*(?:of(?:icina)?\.?|dep(?:arta?men)?to\.?|dpto\.?|block|torre|piso|local|casa|bodega)\s*(?:n[°º]\s*)?(?:[0-9]+(?:-?[a-z]\b)?|[a-z]\b))+", re.I)
SEPARATORS, NUMBER_MARKS = " \n\r\t\xa0,#°º", ("n", "nro", "nro.", "número", "numero")
TYPE_WORDS = r"(?:[Aa][Vv](?:[Dd][Aa])?\.|[Aa]venida|AVENIDA|[Cc]alle|CALLE|[Pp]asaje|PASAJE|[Pp]je\.|PJE\.|[Cc]amino|CAMINO)"
_SW = rf"(?:[{UP}][{LOW}]+|[{UP}]{{2,}})"
_SJ = r"(?:(?:de|del|la|las|los|el|y|DE|DEL|LA|LAS|LOS|EL|Y)\s+)*"
#: A street before its number, read from the left: an optional street word and up to five capitalised words.
STREET_LEFT = re.compile(rf"(?<![\w.])((?:{TYPE_WORDS}\s+)?(?:{_SW}\s+{_SJ}){{0,4}}{_SW})$")
KM_LEFT = re.compile(rf"(?<!\w)([Cc]amino|CAMINO|[Rr]uta|RUTA)\s+(?:a\s+|A\s+|al?\s+)?{_SJ}{_SW}(?:\s+{_SJ}{_SW}){{0,3}},?\s+$")
KM = re.compile(r"(?:km|kil[oó]metro)\.?\s*[0-9]{1,4}(?:[.,][0-9]{1,3})?", re.I)
PLOT_FULL = re.compile(rf"(?i:parcela|lote|sitio)\s+(?:[Nn][°º]\s*)?[0-9]{{1,4}}(?:-?[a-zA-Z])?\s*,\s*((?:{TYPE_WORDS}\s+)?(?:{_SW}\s+{_SJ}){{0,4}}{_SW})")


def _parts(word: str, part: str, initial: str) -> tuple[re.Pattern, re.Pattern, re.Pattern]:
    part = rf"(?:{part}\s+)"
    surname = rf"{part}?{word}"
    return (
        re.compile(rf"(?:{word}|{initial})"),
        re.compile(rf"\s+({surname})"),
        re.compile(rf"\s+(?:viuda|vda\.|VIUDA|VDA\.)\s+(?:de|DE)\s+{surname}"),
    )


MODES = {
    "T": (re.compile(_T), *_parts(_T, _PART, rf"[{UP}]\.")),
    "C": (re.compile(_C), *_parts(_C, _PART.replace("de", "DE").replace("la", "LA").replace("las", "LAS").replace("los", "LOS").replace("l)", "L)").replace("del", "DEL").replace("DEl", "DEL").replace("LAs", "LAS"), rf"[{UP}]\.")),
    "L": (re.compile(_L), *_parts(_L, _PART, rf"[{LOW}]\.")),
}
INITIAL = re.compile(rf"[{UP}{LOW}]\.")
LEAD = re.compile(rf"\s*(?:(?:{TITLE}\s+)|(?:el|la)\s+)*", re.I)
BEFORE_COMMA = {
    "T": re.compile(rf"(?<![\w-])((?:{_PART}\s+)?{_T}(?:\s+(?:{_PART}\s+)?{_T})?),\s+$"),
    "C": re.compile(rf"(?<![\w-])((?:DE(?:L|\s+LA|\s+LAS|\s+LOS)?\s+)?{_C}(?:\s+(?:DE(?:L|\s+LA|\s+LAS|\s+LOS)?\s+)?{_C})?),\s+$"),
    "L": re.compile(rf"(?<![\w-])((?:{_PART}\s+)?{_L}(?:\s+(?:{_PART}\s+)?{_L})?),\s+$"),
}
NAME_BEFORE = re.compile(rf"(?<![\w-])([{UP}]\.\s+(?:{_T}|{_C})(?:\s+(?:{_T}|{_C}))?|(?:{_T}|{_C})(?:\s+(?:{_T}|{_C}))?,\s+[{UP}]\.)\s*[,(]\s*$")

#: Two to four capitalised words right before the label of an identity number.
BEARER = re.compile(rf"(?<![\w.-])((?:{_T}|{_C})(?:\s+(?:{_PART}\s+)?(?:{_T}|{_C})){{1,3}})\s*[,(]\s*(?:(?i:c[eé]dula(?:\s+de)?|con)\s+)?$")


def valid_rut(text: str) -> bool:
    """Check digit (module 11) of an identity number; the body has 7 or 8 digits."""
    s = re.sub(r"[^0-9kK]", "", text)
    body, check = s[:-1], s[-1:].upper()
    if not 7 <= len(body) <= 8 or not body.isdigit():
        return False
    total = sum(int(d) * (2 + i % 6) for i, d in enumerate(reversed(body)))
    return check == {11: "0", 10: "K"}.get(11 - total % 11, str(11 - total % 11))


def valid_phone(text: str) -> bool:
    """Nine national digits that begin with a mobile or area digit, with or without country and trunk prefix."""
    d = re.sub(r"[^0-9]", "", text)
    for p in ("0056", "56", "0"):
        if d.startswith(p) and len(d) - len(p) >= 9:
            d = d[len(p) :]
            break
    if len(d) == 10 and d[0] in "02":  # trunk or area prefix before the nine digits
        d = d[1:]
    return len(d) == 9 and d[0] in "2345679"


_LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_%+-.")
_DOT_BEFORE = re.compile(r"(?:\s?(?:\[dot\]|\(dot\)|\[punto\]|\(punto\)|\bpunto\b)\s?)$", re.I)


def local_part(t: str, at: int) -> int:
    """Where the local part of a mail address begins that ends before ``at``; ``at`` itself if there is none. It is read to its border, however far."""
    start = at
    while True:
        while start and t[start - 1] in _LOCAL_CHARS:
            start -= 1
        dot = _DOT_BEFORE.search(t, max(0, start - 12), start) if start < at else None
        if not dot or not dot.start() or t[dot.start() - 1] not in _LOCAL_CHARS:
            break
        start = dot.start()
    while start < at and t[start] == ".":  # marks before an address are no part of it
        start += 1
    return at if t[at - 1 : at] == "." or ".." in t[start:at] else start


def back(t: str, at: int, words: int) -> int:
    """Start of the so many words before ``at``."""
    while words and at:
        while at and t[at - 1].isspace():
            at -= 1
        while at and not t[at - 1].isspace():
            at -= 1
        words -= 1
    return at


def fold(text: str) -> str:
    """Lower case without accents, character by character."""
    return text.lower().translate(FOLD)


def known_given(word: str) -> bool:
    """True if a word, or its part before a hyphen, is a given name or nickname."""
    return fold(word.split("-")[0]) in GIVEN_SET


class Finder:
    """Finds the personal information of a text."""

    def __init__(self) -> None:
        self.automaton = ahocorasick.Automaton()
        anchors: dict[str, str] = {}
        for kind, words in (("n", GIVEN_ANCHORS), ("c", NAME_CUES), ("k", PLOT), ("p", PHONE), ("i", IDENTITY), ("m", MAIL)):
            for w in {y for w in words for x in (w, fold(w)) for y in (x, x.replace(" ", "  "))}:
                anchors[w] = anchors.get(w, "") + kind
        for w in [f"{b}{d}" for b in " \t#°º" for d in "123456789"]:
            anchors[w] = anchors.get(w, "") + "#"
        for w, kinds in anchors.items():
            self.automaton.add_word(w, (len(w), kinds))
        self.automaton.make_automaton()

    # -- local parsers: each returns (start, end) or None

    @staticmethod
    def mail(t: str, at: int, end: int) -> tuple[int, int] | None:
        if at > 0 and t[at - 1].isspace():
            at -= 1
        m = AT.match(t, at)
        if not m:
            return None
        right = DOMAIN.match(t, at)
        start = local_part(t, at) if right else at
        return (start, right.end()) if start < at else None

    @staticmethod
    def identity(t: str, end: int, cue: str) -> tuple[int, int] | None:
        m = (PASS if cue.startswith("pas") else RUT).match(t, end)
        if not m or (m.re is RUT and not valid_rut(m[1])):
            return None
        return m.span(1)

    @staticmethod
    def phone(t: str, start: int, end: int, cue: str) -> tuple[int, int] | None:
        if cue[0] in "+(0":
            at = start
            if at and (t[at - 1].isalnum() or t[at - 1] in "+("):
                return None
        else:
            at = end
            while at < len(t) and not (t[at].isdigit() or t[at] in "+("):
                if t[at] in ";,\n.@#" and not (t[at] in ".\n" and at < end + 3):  # a number belongs to a cue of its own clause
                    return None
                at += 1
        m = TEL.match(t, at)
        return m.span() if m and valid_phone(m[0]) else None

    @staticmethod
    def street(t: str, digit: int) -> tuple[int, int] | None:
        """A street whose house number begins at ``digit``."""
        j = digit
        for _ in range(2):
            while j > 0 and t[j - 1] in SEPARATORS:
                j -= 1
            k = j
            while k > 0 and not t[k - 1].isspace() and j - k < 40:
                k -= 1
            if t[k:j].lower() not in NUMBER_MARKS:
                break
            j = k
        word = t[k:j]
        if not word[:1].isupper() or fold(word.strip(".")) in NOT_STREET:
            return None
        base = j
        m = NUMBER.match(t, base)
        if not m or m.start(1) != digit:
            return None
        s = STREET_LEFT.search(t, back(t, base, 14), base)
        if not s:
            return None
        words = s[1].split()
        has_type = re.fullmatch(TYPE_WORDS, words[0]) is not None
        if not has_type:
            k = 0
            for i, x in enumerate(words):
                if fold(x.strip(".,")) in ("ddu", "ord", "circular", "supremo", "ley", "decreto", "articulo", "numeral"):
                    return None
                if fold(x) in ("en", "notifiquese"):
                    k = i + 1
            if len(words[k:]) < 2:
                return None
        start = base - len(s[1])
        end = m.end()
        u = UNIT.match(t, end)
        return start, (u.end() if u else end)

    @staticmethod
    def plot(t: str, start: int, word: str) -> tuple[int, int] | None:
        if word.strip() in ("km", "kilometro"):
            at = start + (len(word) - len(word.lstrip()))
            m = KM.match(t, at)
            s = m and KM_LEFT.search(t, back(t, at, 16), at)
            return (s.start(), m.end()) if s else None
        if start and (t[start - 1].isalnum()):
            return None
        m = PLOT_FULL.match(t, start)
        if not m:
            return None
        u = UNIT.match(t, m.end())
        return start, (u.end() if u else m.end())

    def shaped(self, t: str, f: str, at: int, mode: str) -> tuple[int, int] | None:
        """A name that only its cue and its shape tell: two to four words that begin with capitals, none of which is a word of offices, companies or places."""
        if mode == "L":
            return None
        first, end = MODES[mode][0].match(t, at), at
        if not first or fold(first[0]) in NOT_NAME or fold(first[0]) in COMPANY:
            return None
        end, n = first.end(), 0
        while n < 3:
            m = MODES[mode][2].match(t, end)
            if not m or "\n" in t[end : m.start(1)] and n or fold(m[1]).split()[-1] in NOT_NAME | COMPANY:
                break
            n, end = n + 1, m.end()
        rest = t[end : end + 12].lower()
        return (at, end) if n and not re.match(r"\s*(?:s\.?\s?a\.?|ltda|limitada|e\.?i\.?r\.?l|spa)\b", rest) else None

    def name(self, t: str, f: str, at: int, cued: bool, strong: bool = False) -> tuple[int, int] | None:
        """A name that begins at ``at``; ``f`` is the folded text in lower case."""
        first = t[at : at + 1]
        if not first.isalpha():
            return None
        mode = "T" if first.isupper() and t[at + 1 : at + 2].islower() else "C" if first.isupper() and t[at + 1 : at + 2].isupper() else "L" if first.islower() else "I"
        if mode == "I":  # an initial and surnames
            if not cued or t[at + 1 : at + 2] != ".":
                return None
            m = re.compile(rf"[{UP}]\.(?:\s?[{UP}]\.)?").match(t, at)
            if not m:
                return None
            nxt = re.compile(r"\s+").match(t, m.end())
            if not nxt:
                return None
            c = t[nxt.end() : nxt.end() + 2]
            mode = "C" if len(c) == 2 and c.isupper() else "T"
            end, n = self.surnames(t, f, m.end(), mode)
            return (at, end) if n else None
        word, given, _, _ = MODES[mode]
        w = word.match(t, at)
        if not w:
            return None
        end, is_given = w.end(), known_given(f[at : w.end()])
        if not is_given:
            return (self.reversed(t, f, at, mode) or (self.shaped(t, f, at, mode) if strong else None)) if cued else None
        for _ in range(2):  # further given names and initials
            m = re.compile(r"\s+").match(t, end)
            if not m:
                break
            g = given.match(t, m.end())
            if not g or not (INITIAL.fullmatch(g[0]) or known_given(g[0])):
                break
            end = g.end()
        stop, n = self.surnames(t, f, end, mode)
        if not n:
            return None
        if mode == "L" and not cued and not (whole_line(t, at, stop)):
            return None
        return at, stop

    @staticmethod
    def surnames(t: str, f: str, at: int, mode: str) -> tuple[int, int]:
        """End of up to two surnames after ``at``, and their number."""
        _, _, surname, widow = MODES[mode]
        n, end = 0, at
        while n < 2:
            m = surname.match(t, end)
            if not m:
                break
            parts = fold(m[1]).split()
            last, first = parts[-1], parts[0]
            if last.split("-")[0] in NOT_NAME or (mode == "L" and first in STOP_LOWER):
                break
            gap = t[end : m.start(1)]
            if n and "\n" in gap and mode == "T" and re.match(r"\s*\n\s*\n", gap):
                break
            n, end = n + 1, m.end()
        if n:
            m = widow.match(t, end)
            if m:
                end = m.end()
        return end, n

    def reversed(self, t: str, f: str, at: int, mode: str) -> tuple[int, int] | None:
        """Surnames, a comma and given names or an initial, from ``at`` on."""
        end, n = self.surnames(t, f, at - 1, mode) if at and t[at - 1].isspace() else (at, 0)
        if not n or t[end : end + 1] != ",":
            return None
        m = re.compile(r",\s+").match(t, end)
        if not m:
            return None
        _, given, _, _ = MODES[mode]
        g = given.match(t, m.end())
        if not g or not (INITIAL.fullmatch(g[0]) or known_given(g[0])):
            return None
        end = g.end()
        m = re.compile(r"\s+").match(t, end)
        g = m and given.match(t, m.end())
        if g and (INITIAL.fullmatch(g[0]) or known_given(g[0])):
            end = g.end()
        return at, end

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """``(start, end, kind)`` of each item, in order and without overlap."""
        t = text
        f = t.lower()
        if len(f) != len(t):  # a few letters have a lower case of two characters
            f = "".join(c.lower() if len(c.lower()) == 1 else c for c in t)
        f = f.replace("\n", " ").replace("\r", " ").replace("\xa0", " ")  # cues of several words may be wrapped
        found: list[tuple[int, int, str]] = []
        names: list[tuple[int, bool, bool]] = []
        befores: list[int] = []
        bearers: list[int] = []
        hits = [(e - n + 1, e + 1, kinds) for e, (n, kinds) in self.automaton.iter(f)]
        phones: list[tuple[int, int]] = []
        listed = 0
        for start, end, kinds in hits:
            for k in kinds:
                if k == "#":
                    if t[end - 2] in " \n\t\xa0" and t[start - 1 : start].isdigit():
                        continue
                    s = MOBILE.match(t, end - 1)
                    if s:
                        phones.append(s.span())
                    s = self.street(t, end - 1)
                    if s:
                        found.append((*s, "direccion"))
                        befores.append(s[0])
                elif k == "n" or k == "c":
                    prev = f[start - 1] if start else " "
                    nxt = f[end] if end < len(f) else " "
                    if prev.isalnum() or prev in "@_" or (nxt.isalnum() and f[end - 1].isalpha()) or nxt in "@_":
                        continue
                    if k == "n":
                        names.append((start, False, False))
                    else:
                        m = LEAD.match(t, end)
                        names.append((m.end(), True, f[start:end] in STRONG))
                        if f[start:end] == "asisten:" and end > listed:  # a cue within a list adds nothing to it
                            stop = SENTENCE_END.search(t, end)
                            listed = stop.start() if stop else len(t)
                            names += [(m.end(), True, True) for m in LIST_NAME.finditer(t, end, listed)]
                elif k == "m":
                    s = self.mail(t, start, end)
                    if s:
                        found.append((*s, "correo"))
                elif k == "i":
                    if start and f[start - 1].isalnum():
                        continue
                    s = self.identity(t, end, f[start:end])
                    if s:
                        found.append((*s, "identidad"))
                        befores.append(start)
                        bearers.append(start)
                elif k == "p":
                    s = self.phone(t, start, end, f[start:end])
                    if s:
                        phones.append(s)
                elif k == "k":
                    s = self.plot(t, start, f[start:end])
                    if s:
                        found.append((*s, "direccion"))
                        befores.append(s[0])
        found += [(*s, "telefono") for s in phones]
        taken = merged(found)
        got: list[tuple[int, int, str]] = []
        for at, cued, strong in names:
            s = self.name(t, f, at, cued, strong)
            if not s and not cued:
                s = self.backwards(t, f, at)
            if s:
                got.append((*s, "nombre"))
        for at in befores:
            m = NAME_BEFORE.search(t, back(t, at, 8), at)
            if m and not any(fold(x.strip(".,")) in NOT_NAME for x in m[1].split()):
                got.append((*m.span(1), "nombre"))
        for at in bearers:  # whoever bears an identity number is a person, whatever the name
            m = BEARER.search(t, back(t, at, 8), at)
            if m and not any(fold(x.strip(".,")) in NOT_NAME | COMPANY for x in m[1].split()):
                got.append((*m.span(1), "nombre"))
        ends = [e for _, e, _ in taken]
        return merged(taken + [g for g in got if not overlaps(taken, ends, g)])

    def backwards(self, t: str, f: str, at: int) -> tuple[int, int] | None:
        """Surnames and a comma before a given name at ``at`` that no surname follows."""
        first = t[at]
        mode = "L" if first.islower() else "C" if t[at + 1 : at + 2].isupper() else "T"
        m = BEFORE_COMMA[mode].search(t, back(t, at, 8), at)
        if not m or any(x.split("-")[0] in NOT_NAME or (mode == "L" and x in STOP_LOWER) for x in fold(m[1]).split() if x not in ("de", "del", "la", "las", "los")):
            return None
        if mode == "L":
            return None
        word, given, _, _ = MODES[mode]
        end = word.match(t, at).end()
        g = re.compile(r"\s+").match(t, end)
        g = g and given.match(t, g.end())
        if g and (INITIAL.fullmatch(g[0]) or known_given(g[0])):
            end = g.end()
        first = m.start(1)
        if re.match(r"de\s+(?!la\b|las\b|los\b)", m[1], re.I):  # the word before a name, not a part of it
            first += re.match(r"de\s+", m[1], re.I).end()
        return first, end


#: End of a sentence (not the stop of an initial), and what stands before a name in a list.
SENTENCE_END, LIST_NAME = re.compile(r"(?<=\w\w)\.(?=\s|$)"), re.compile(rf";\s*(?:{TITLE}\s+)*", re.I)

# Lower-case words that end a name written in lower case.
STOP_LOWER = frozenset(
    """senala consulta en y e al a con por para que de rut run cedula pasaporte vive fono cel at the jefe jefa se solicita presenta expone pide ha es fue no si o ni como su sus lo le
    indica manifiesta attention and or to of""".split()
)


def whole_line(t: str, start: int, end: int) -> bool:
    """True if a span, but for marks around it, is all of its line."""
    a, b = t.rfind("\n", 0, start) + 1, t.find("\n", end)
    return not re.search(r"\w", t[a:start]) and not re.search(r"\w", t[end : b if b >= 0 else len(t)])


def overlaps(spans: list[tuple[int, int, str]], ends: list[int], one: tuple[int, int, str]) -> bool:
    """True if a span overlaps one of the others, which are in order and apart; ``ends`` are their ends."""
    k = bisect_right(ends, one[0])
    return k < len(spans) and spans[k][0] < one[1]


def merged(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Spans in order; of overlapping ones the longer stays, of equal ones the kind named first in :data:`KINDS`."""
    out: list[tuple[int, int, str]] = []
    for s in sorted(set(spans), key=lambda x: (x[0], -x[1], KINDS.index(x[2]))):
        if out and s[0] < out[-1][1]:
            if s[1] - s[0] > out[-1][1] - out[-1][0]:
                out[-1] = s
        else:
            out.append(s)
    return out


COMBINING = re.compile("[\u0300-\u036f]")


def composed(text: str) -> tuple[str, list[int] | None]:
    """The text with combining accents composed, and for each of its characters the place in the original."""
    if text.isascii() or not COMBINING.search(text):
        return text, None
    out, at = [], []
    i = 0
    while i < len(text):
        j = i + 1
        while j < len(text) and "̀" <= text[j] <= "ͯ":
            j += 1
        c = unicodedata.normalize("NFC", text[i:j])
        out.append(c)
        at += [i] + [i + 1] * (len(c) - 1)
        i = j
    return "".join(out), [*at, len(text)]


@lru_cache(maxsize=1)
def finder() -> Finder:
    """The worker's finder."""
    return Finder()


def find(text: str | None) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of each item of a text, in its own characters."""
    if not text:
        return []
    t, at = composed(text)
    spans = finder().spans(t)
    return [(at[s], at[e], k) for s, e, k in spans] if at else spans


def found_items(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, tipo, valor)``: one row for each different item of a text, as written, with each run of blanks as one.

    Null, empty and blank texts give no row. Items of one text are made distinct inside the pass, so nothing is shuffled;
    a repeated key repeats its items.
    """
    source = df.select(key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, kinds, values = [], [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                for kind, v in dict.fromkeys((k, " ".join(t[s:e].split())) for s, e, k in find(t)):
                    row.append(i)
                    kinds.append(kind)
                    values.append(v)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row, pa.int64())), pa.array(kinds, pa.string()), pa.array(values, pa.string())], names=[key, "tipo", "valor"])

    return source.mapInArrow(run, f"{key} {source.schema[key].dataType.simpleString()}, tipo string, valor string")


def redacted(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, text)`` with each item replaced by a placeholder of its type, as ``[CORREO]``; null stays null."""
    source = df.select(key, text)

    def one(t: str | None) -> str | None:
        if not t:
            return t
        out, last = [], 0
        for s, e, k in find(t):
            out += [t[last:s], f"[{k.upper()}]"]
            last = e
        return "".join([*out, t[last:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([one(t) for t in b.column(1).to_pylist()], pa.string())], names=[key, text])

    return source.mapInArrow(run, f"{key} {source.schema[key].dataType.simpleString()}, {text} string")


def item_counts(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Items and texts per type."""
    return found_items(df, key, text).groupBy("tipo").agg(F.count("*").alias("elementos"), F.countDistinct(key).alias("textos"))
