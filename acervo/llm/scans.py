"""Text of scanned pages: finding page furniture, words broken at line ends and misread words, and repairing them.

Method: an averaged-perceptron character editor reads a word, a pair of neighbouring words or the two pieces of a word around a line
end, and predicts for each character whether to keep, replace or delete it or to insert another one after it; at a line end it predicts
whether the pieces join, join as a compound or stay apart, and at a blank whether it tears a word. Its margin over keeping everything
proposes and ranks the repairs; counts over the whole corpus only validate them: a repair must be much more frequent than what is
written. Running headers, footers, page numbers, stamps and dirt are told from text by a second averaged perceptron over the position
of a line in the page (how it fills the width of the block, what stands before and after it), its characters, and how like it is to
line forms that intrude into open sentences all over the corpus.

How it is spread out: one pass counts words and line forms; the editor and the line perceptron are fitted on bounded samples
(:data:`WORDS`, :data:`LINES`); a second pass labels the lines and names the doubtful terms on them; each *different* term is judged
once, its repairs being validated by joins with the whole table of counts; the verdicts are joined back to the lines. What is broadcast
is bounded by shares: a word as frequent as :data:`UNKNOWN` of all words (at most ``1 / UNKNOWN`` of them), a line form as frequent as
:data:`FORM` of all forms. Rarer words are never broadcast and never left out: they meet their counts in the joins, and no key of
these joins can be hot, as frequent words are settled by the broadcast.
"""

from __future__ import annotations

import math
import random
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acervo.session import cut, spread

#: Labelled lines and damaged words on which the perceptrons are fitted.
LINES, WORDS = 12_000, 14_000
#: A repair must be this many times as frequent as an unknown word or one with a mark inside, and this many times as frequent as a known word.
TIMES, KNOWN_TIMES = 8, 20
#: Shares of all words: a word is known, and may teach the editor, from UNKNOWN on, and one as frequent as WHOLE is no piece of a torn
#: word; share of all line forms from which a form is broadcast. As shares they mean the same at every size.
UNKNOWN, WHOLE, FORM = 2.3e-5, 1.2e-3, 2e-5
#: Margin below keeping at which the editor still proposes an operation.
FLOOR = -30.0
#: Weights below this are forgotten.
SLIGHT = 0.15
#: Likeness of a line to a form that intrudes, from which on the line may be furniture although it leaves no room.
LIKE = 0.6
#: A form is furniture if the share of its lines that intrude is surely above this (the lower bound of Wilson's interval, one error in 20),
#: or from a lower share on if it is not so many times rarer than the most frequent one.
CLEAR, LEAST_CLEAR, RARE = 0.55, 0.3, 20

# Marks that break a word at a line end, and usual misreadings (what is printed, what is read).
BREAKS = "-‐‑¬­"
MISREAD = (
    ("m", "rn"), ("n", "ri"), ("u", "ii"), ("d", "cl"), ("v", "\\/"), ("ñ", "fi"), ("h", "li"), ("i", "1"), ("l", "1"), ("i", "l"), ("l", "I"), ("o", "0"), ("e", "€"),
    ("a", "@"), ("s", "5"), ("g", "9"), ("b", "6"), ("z", "2"), ("ó", "�"), ("í", "�"), ("á", "�"), ("é", "�"), ("ú", "�"), ("ñ", "�"), ("ó", "o"), ("i", "í"),
    ("í", "1"), ("e", "c"), ("c", "e"), ("ó", "6"), ("i", "."), ("a", "~"), ("o", "~"), ("t", "f"), ("i", "!"), ("l", "|"), ("é", "€"), ("á", "@"), ("ó", "0"),
)
DIRT = "'.`~·"
_WORD = re.compile(r"[^\s|]+")
_OUTER = "\"'«»“”()[]{},;:.¿?¡!|…*•"
_LETTER = re.compile(r"[^\W\d_]")
_ENDS = frozenset(BREAKS + " \t\r")
_DIGITS = re.compile("[0-9]+")
_NOT_WORD = re.compile(r"[a-z]{1,2}-?[0-9]+[a-z]?|[0-9.,]+[a-zº°]{0,2}|.*(?:www|@.*\.).*")
_CLOSED_END = re.compile(r"[.:;)\]\"»]\s*$")


# -- averaged perceptrons


class Perceptron:
    """A multi-class averaged perceptron over sparse features that are 64-bit hashes.

    Fitted in small batches: the guesses of a batch are made with the weights before it. A class without any weight is never
    preferred to the first one, so a perceptron without weights always answers with its first class.
    """

    def __init__(self, classes: list[str]) -> None:
        self.classes = classes
        self.keys = np.zeros(0, np.uint64)
        self.weights = np.zeros((1, len(classes)), np.float32)  # the last row stands for features never seen

    def rows(self, features: np.ndarray) -> np.ndarray:
        """Rows of the weights for an array of features."""
        if not len(self.keys):
            return np.zeros(features.shape, np.int64)
        at = np.minimum(np.searchsorted(self.keys, features), len(self.keys) - 1)
        return np.where(self.keys[at] == features, at, len(self.keys))

    def scores(self, features: np.ndarray) -> np.ndarray:
        """``(samples, classes)`` for features ``(samples, templates)``."""
        rows = self.rows(features)
        total = self.weights[rows[:, 0]].copy() if rows.shape[1] else np.zeros((len(rows), len(self.classes)), np.float32)
        for t in range(1, rows.shape[1]):
            total += self.weights[rows[:, t]]
        return total

    def fit(self, features: np.ndarray, labels: np.ndarray, epochs: int, batch: int = 64, seed: int = 7) -> Perceptron:
        self.keys = np.unique(features)
        n, c = len(self.keys), len(self.classes)
        if not len(labels):
            return self
        ids = np.searchsorted(self.keys, features)
        w, u = np.zeros((n + 1, c), np.float32), np.zeros((n + 1, c), np.float32)
        rng, step = np.random.default_rng(seed), 0
        for _ in range(epochs):
            order = rng.permutation(len(labels))
            for a in range(0, len(order), batch):
                step += 1
                at = order[a : a + batch]
                x, y = ids[at], labels[at]
                guess = w[x].sum(1).argmax(1)
                wrong = np.flatnonzero(guess != y)
                if len(wrong):
                    f = x[wrong].ravel()
                    for classes, d in ((y[wrong], 1.0), (guess[wrong], -1.0)):
                        cls = np.repeat(classes, x.shape[1])
                        np.add.at(w, (f, cls), d)
                        np.add.at(u, (f, cls), d * step)
        w -= u / np.float32(step + 1)
        told = np.abs(w[:-1]).max(1) >= SLIGHT  # features that hardly say anything are forgotten
        self.keys, self.weights = self.keys[told], w[np.append(told, True)]
        return self


def mixed(parts: list[np.ndarray], kind: int) -> np.ndarray:
    """One 64-bit hash of several integer columns and a number of the template."""
    h = np.full(parts[0].shape if parts else (), 0x9E3779B97F4A7C15 * (kind + 1) & 0xFFFFFFFFFFFFFFFF, np.uint64)
    with np.errstate(over="ignore"):
        for p in parts:
            h = (h ^ p.astype(np.uint64)) * np.uint64(0xFF51AFD7ED558CCD)
            h ^= h >> np.uint64(32)
    return h


# -- the character editor

#: Windows of characters around the one that is edited: so many to the left, so many to the right.
WINDOWS = ((0, 0), (1, 0), (0, 1), (1, 1), (2, 0), (0, 2), (2, 1), (1, 2), (2, 2), (3, 1), (1, 3), (3, 3), (5, 1), (1, 5))
_PAD = 6


def characters(words: list[str], only: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Features of all characters of some words (or of ``only`` some), one word after the other, and where each word begins."""
    joined = "\0" * _PAD + ("\0" * _PAD).join(words) + "\0" * _PAD
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    begins = np.concatenate([[0], np.cumsum(lengths)])
    at = np.arange(begins[-1]) + np.repeat(np.arange(1, len(words) + 1) * _PAD, lengths)
    at = at if only is None else at[only]
    return np.stack([mixed([codes[at + k] for k in range(-a, b + 1)], i) for i, (a, b) in enumerate(WINDOWS)], 1), begins


def damage(word: str, rng: random.Random) -> list[tuple[str, str]]:
    """``(read character, operation)`` of a word damaged in one place: K keep, D delete, R replace, I keep and insert after."""
    ops = [(c, "K") for c in word]
    kind = rng.random()
    if kind < 0.7:
        fits = [(p, r) for p, r in MISREAD if p in word]
        if not fits:
            return ops
        printed, read = rng.choice(fits)
        i = rng.choice([k for k, c in enumerate(word) if c == printed])
        return ops[:i] + [(read[0], f"R{printed}")] + [(c, "D") for c in read[1:]] + ops[i + 1 :]
    i = rng.randrange(1, len(word))
    if kind < 0.78:  # a lost character
        return ops[: i - 1] + [(word[i - 1], f"I{word[i]}")] + ops[i + 1 :]
    if kind < 0.86:  # dirt between two characters
        return ops[:i] + [(rng.choice(DIRT), "D")] + ops[i:]
    return ops[:i] + [(rng.choice(DIRT), f"R{word[i]}")] + ops[i + 1 :]  # dirt on a character


def torn(word: str, rng: random.Random) -> list[tuple[str, str]]:
    """A word torn by a blank, which is to be deleted."""
    i = rng.randrange(1, len(word))
    return [(c, "K") for c in word[:i]] + [(" ", "D")] + [(c, "K") for c in word[i:]]


def line_end(head: str, rest: str, op: str) -> list[tuple[str, str]]:
    """Two pieces around a line end: J joined without the mark, C joined with it, K not joined."""
    return [(c, "K") for c in head] + [("-", "K"), ("\n", op)] + [(c, "K") for c in rest]


class Editor(Perceptron):
    """The character editor. ``ops`` are its classes, the first of them being K."""

    def best_edits(self, words: list[str], size: int = 4000) -> Iterator[tuple[str, dict[str, float]]]:
        """Each word with the words that it may stand for and their margins over the word as it is."""
        drop = self.classes.index("D")
        usable = np.array([c == "D" or c[0] in "RI" for c in self.classes])
        for a in range(0, len(words), size):
            part = words[a : a + size]
            features, begins = characters(part)
            s = self.scores(features)
            m = s - s[:, :1]
            allowed = usable & (m > FLOOR) & (s != 0)
            which = np.argpartition(-np.where(allowed, m, -1e9), min(6, m.shape[1] - 1), 1)[:, :6] if len(m) else np.zeros((0, 4), int)
            good = np.take_along_axis(allowed, which, 1)
            for k, w in enumerate(part):
                lo, hi = begins[k], begins[k + 1]
                found: dict[str, float] = {}
                if good[lo:hi].any():
                    options = [[(self.classes[c], float(m[i, c])) for c, g in zip(which[i], good[i]) if g] for i in range(lo, hi)]
                    drops = [float(x) if ok else None for x, ok in zip(m[lo:hi, drop], allowed[lo:hi, drop])]
                    found = proposals(w, options, drops)
                yield w, found

    def joins(self, pairs: list[tuple[str, str]]) -> list[str]:
        """For the pieces of each pair: J, C or K."""
        if not pairs:
            return []
        features, begins = characters([f"{a}-\n{b}" for a, b in pairs])
        at = begins[:-1] + np.fromiter((len(a) + 1 for a, _ in pairs), np.int64, len(pairs))
        allowed = np.array([c in "KJC" for c in self.classes])
        s = np.where(allowed, self.scores(features[at]), -1e9)
        return [self.classes[c] for c in s.argmax(1)]

    def tears(self, pairs: list[tuple[str, str]]) -> list[float]:
        """Margin of deleting the blank between two words over keeping it; minus infinity if the editor knows nothing of it."""
        if not pairs:
            return []
        features, begins = characters([f"{a} {b}" for a, b in pairs])
        at = begins[:-1] + np.fromiter((len(a) for a, _ in pairs), np.int64, len(pairs))
        s = self.scores(features[at])
        d = s[:, self.classes.index("D")]
        return np.where(d != 0, d - s[:, 0], -np.inf).tolist()


def applied(word: str, edits: dict[int, str]) -> str:
    out = []
    for i, c in enumerate(word):
        op = edits.get(i, "K")
        out.append(c if op == "K" else "" if op == "D" else op[1:] if op[0] == "R" else c + op[1:])
    return "".join(out)


def proposals(w: str, options: list[list[tuple[str, float]]], drops: list[float | None]) -> dict[str, float]:
    """Words that one operation, one replacement with a deletion behind it, or all operations with a margin above 0 make of a word."""
    found: dict[str, float] = {}

    def add(edits: dict[int, str], margin: float) -> None:
        got = applied(w, edits)
        if got != w and margin > found.get(got, FLOOR):
            found[got] = margin

    base, total = {}, 0.0
    for i, o in enumerate(options):
        if o:
            op, x = max(o, key=lambda t: t[1])
            if x > 0:
                base[i] = op
                total += x
    if base:
        add(base, total)
    for i, o in enumerate(options):
        for op, x in o:
            add({i: op}, x)
            if op[0] == "R" and i + 1 < len(w) and drops[i + 1] is not None:
                add({i: op, i + 1: "D"}, x + drops[i + 1])
            if len(base) > (i in base):
                add({**base, i: op}, total - max([0.0, *[y for o2, y in o if base.get(i) == o2]]) + x)
    return found


def fit_editor(words: dict[str, int], compounds: dict[str, int]) -> Editor:
    """An editor trained on frequent words, whole and damaged, torn by blanks and broken at line ends, and on neighbouring words.

    ``words`` are frequent words; those that an usual misreading makes of a much more frequent word teach nothing.
    """
    rng = random.Random(11)
    sound = [w for w, n in words.items() if len(w) > 3 and w.isalpha() and not any(words.get(x, 0) >= KNOWN_TIMES * n for x in misread_of(w))]
    frequent = sorted(sound, key=lambda w: (-words[w], w))[:WORDS]
    taught = set(frequent)
    mates = [w for w in sorted(words, key=lambda w: (-words[w], w)) if w.isalpha() and (len(w) < 4 or w in taught)][:2000]
    pieces = sorted((c for c in compounds if re.fullmatch(r"[^\W\d_]{3,}-[^\W\d_]{3,}", c)), key=lambda c: (-compounds[c], c))[: WORDS // 10]
    samples: list[list[tuple[str, str]]] = []
    for k in range(min(WORDS, 60 * len(frequent))):
        w = frequent[k % len(frequent)]
        samples.append(damage(w, rng))
        i = rng.randrange(1, len(w))
        samples.append(line_end(w[:i], w[i:], "J"))
        if k % 3 == 0:
            samples.append(torn(w, rng))
            samples.append([(c, "K") for c in f"{rng.choice(mates)} {rng.choice(mates)}"])
        if k % 8 == 0 and pieces:
            head, rest = pieces[k // 8 % len(pieces)].split("-")
            samples.append(line_end(head, rest, "C"))
    classes = ["K", "D", "J", "C", *sorted({o for s in samples for _, o in s} - {"K", "D", "J", "C"})]
    if not samples:
        return Editor(classes)
    place = {c: i for i, c in enumerate(classes)}
    labels = np.array([place[o] for s in samples for _, o in s])
    # Of a sample with a blank or line end only the character that stands for it teaches.
    tells = np.array([not gap or c in " \n" for s in samples for gap in (any(c in " \n" for c, _ in s),) for c, _ in s])
    features, _ = characters(["".join(c for c, _ in s) for s in samples], tells)
    return Editor(classes).fit(features, labels[tells], 4)


def misread_of(w: str) -> set[str]:
    """The words that a word may stand for by one usual misreading with a telling form (several letters, a digit or a sign)."""
    return {w[: m.start()] + p + w[m.end() :] for p, r in MISREAD if len(r) > 1 or not r.isalpha() for m in re.finditer(re.escape(r), w)}


# -- lines


def line_form(line: str) -> str:
    """A line without differences of case, digits and blanks."""
    return " ".join(_DIGITS.sub("9", line.lower()).split())


def trigrams(form: str) -> frozenset[str]:
    t = f"^{form}$"
    return frozenset(t[i : i + 3] for i in range(len(t) - 2))


def bare(line: str) -> bool:
    """A line without letters that cannot be the end of a sentence, or of single letters and marks only."""
    s = line.strip()
    if not re.search(r"[^\W\d_]{2}|[0-9]", s):
        return True
    return not _LETTER.search(s) and not re.fullmatch(r"[^\w]*[0-9][0-9.,°]*[.;,)]+", s)


#: Position of a line in its value: it leaves room for the next word; nothing follows or precedes it; blank lines before and after;
#: it is closed by a mark; the next line begins in lower case; the line before is open.
Place = tuple[bool, bool, bool, bool, bool, bool, bool, bool]


def layout(lines: list[str]) -> list[Place | None]:
    """The place of each line; None for a blank line and for one that begins in lower case, which is text."""
    ends = [x.rstrip() for x in lines]
    # Lines on which two packed values meet are longer than the block is wide.
    width = max((len(x) for x in ends if "|" not in x), default=0) or max(map(len, ends), default=0)
    out: list[Place | None] = [None] * len(lines)
    full = [i for i, x in enumerate(ends) if x]
    full = [i for i in full if ends[i].strip()]
    for k, i in enumerate(full):
        s = ends[i].lstrip()
        if s[0].islower() and (" " in s or s[-1] in ".:;,") and not (len(s) < 12 and bare(s)):
            continue
        nxt = ends[full[k + 1]].lstrip() if k + 1 < len(full) else ""
        prv = ends[full[k - 1]] if k else ""
        out[i] = (
            bool(nxt) and len(ends[i]) + 1 + len(nxt.split(" ", 1)[0]) <= width - 6, not nxt, not prv, i > 0 and not ends[i - 1], i + 1 < len(ends) and not ends[i + 1],
            s[-1] in ".:;" or s.endswith(".)"), nxt[:1].islower(), bool(prv) and prv[-1] not in ".:;|",
        )
    return out


def intrudes(line: str, p: Place) -> bool:
    """True if a line leaves room amid an open sentence and is not closed."""
    return p[0] and p[7] and not p[5] and line.rstrip()[-1] not in BREAKS + ","


def surely(share: float, n: int, z: float = 1.645) -> float:
    """Lower bound of Wilson's interval of a share seen in n cases."""
    return (share + z * z / (2 * n) - z * math.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)


class Furniture:
    """Line forms that intrude all over the corpus, and how like them a line is."""

    def __init__(self, forms: dict[str, tuple[int, float]]) -> None:
        self.forms = forms
        often = {f: v for f, v in forms.items() if v[1] >= LEAST_CLEAR and _LETTER.search(f)}
        most = max((n for n, _ in often.values()), default=0)
        # Rare forms that intrude only now and then are text that recurs by chance.
        self.known = [trigrams(f) for f, (n, share) in sorted(often.items()) if surely(share, n) >= CLEAR or n * RARE >= most]
        self.places: dict[str, list[int]] = defaultdict(list)  # the furniture forms that have a trigram
        for k, f in enumerate(self.known):
            for g in f:
                self.places[g].append(k)
        self.grams = frozenset(self.places)
        self.alike: dict[str, float] = {}

    def likeness(self, form: str) -> float:
        """Dice's share of common trigrams with the most like furniture form, if it is LIKE or more, else 0."""
        got = self.alike.get(form)
        if got is None:
            if len(self.alike) > 200_000:
                self.alike.clear()
            own = trigrams(form)
            seen = own & self.grams
            got, need = 0.0, (3 * len(own) + 6) // 7
            if len(seen) >= need:
                # A form is that like this one only if they share 3 of 7 of its trigrams, so one of the rarest of them.
                rare = sorted(seen, key=lambda g: len(self.places[g]))[: len(seen) - need + 1]
                near = {k for g in rare for k in self.places[g]}
                got = max((2 * len(own & self.known[k]) / (len(own) + len(self.known[k])) for k in near), default=0.0)
                got = got if got >= LIKE else 0.0
            self.alike[form] = got
        return got

    def features(self, line: str, form: str, p: Place) -> tuple[int, ...]:
        """Features of a line: its place, its characters, and how it recurs."""
        s = line.strip()
        n, share = self.forms.get(form, (0, 0.0))
        like = self.likeness(form)
        letters = sum(map(str.isalpha, s))
        room, last, first, before, after, closed, low, opened = p
        near, short, plain = int(like * 10), min(letters // 4, 6), bare(line)
        parts = (
            (room, closed, opened), (room, opened, low), (last, first), (before, after), (near, room), (near, closed, opened), (near, int(share * 4)), (min(n, 64).bit_length(), int(share * 4)),
            (short, room), (short, near), (plain, room, last), (plain, letters > 0), (int(4 * letters / len(s)), room), (len(s) // 12, room), (s.isupper(), room, near), ("|" in s, near),
            (ord(s[-1]) if not s[-1].isalnum() else 0, room), (near, n > 0, room, short), (before, after, near, short), (last, room, near, short), (plain, near, short, room),
        )
        return tuple(hash((i, *map(int, x))) & 0xFFFFFFFFFFFFFFFF for i, x in enumerate(parts))

    def candidate(self, line: str, form: str, p: Place) -> bool:
        """True if a line may be furniture: it leaves room and is not closed, is bare, or is like a form that intrudes."""
        return (p[0] or p[1]) and not p[5] or self.likeness(form) > 0 or bare(line)


def fit_lines(texts: list[str], furniture: Furniture) -> Perceptron:
    """A perceptron for lines that intrude, on labels that the corpus gives itself.

    Noise: bare lines, and lines of a form that intrudes all over the corpus, also with a character misread. Text: lines that are closed or
    open a sentence after a closed one, lines that fill the width, and long lines like no furniture. Other lines teach nothing.
    """
    rng = random.Random(5)
    features, labels = [], []
    for t in texts:
        lines = t.split("\n")
        for x, p in zip(lines, layout(lines)):
            if p is None or len(labels) >= LINES:
                continue
            form = line_form(x)
            like = furniture.likeness(form)
            letters = len(_LETTER.findall(x))
            if bare(x) or (like >= 0.9 and not p[5]):
                labels.append(1)
            elif not like and (p[5] or not p[0] or letters >= 16):
                labels.append(0)
            else:
                continue
            features.append(furniture.features(x, form, p))
            if labels[-1]:  # the same line misread: its count is lost, its letters nearly the same
                y = list(x)
                for _ in range(1 + len(y) // 20):
                    y[rng.randrange(len(y))] = rng.choice("1~.Iao")
                if "".join(y).strip():
                    features.append(furniture.features("".join(y), line_form("".join(y)), p))
                    labels.append(1)
    width = len(features[0]) if features else 1
    return Perceptron(["t", "r"]).fit(np.array(features, np.uint64).reshape(len(features), width), np.array(labels, np.int64), 5, 16)


# -- words of a line


def words_of(line: str) -> list[tuple[int, int, str]]:
    """``(start, end, word)`` of the words of a line without outer marks."""
    out = []
    for m in _WORD.finditer(line):
        w = m[0]
        a = len(w) - len(w.lstrip(_OUTER))
        b = len(w.rstrip(_OUTER))
        if a < b:
            out.append((m.start() + a, m.start() + b, w[a:b]))
    return out


def readable(w: str) -> bool:
    """True for a lower-case word that can be judged: three characters or more with a letter, and no code, number or address."""
    return len(w) >= 3 and bool(_LETTER.search(w)) and not _NOT_WORD.fullmatch(w)


def cased(fix: str, written: str) -> str:
    return fix.upper() if written.isupper() and len(written) > 1 else fix.capitalize() if written[:1].isupper() else fix


class Reader:
    """Labels the lines of values: furniture, broken line ends, and the terms on them that are to be judged."""

    def __init__(self, common: dict[str, int], total: int, furniture: Furniture, lines: Perceptron, editor: Editor) -> None:
        self.common, self.total, self.furniture, self.lines, self.editor = common, total, furniture, lines, editor
        self.unknown, self.whole = total * UNKNOWN, total * WHOLE
        self.known: dict[str, str] = {}  # frequent words that are misreadings of much more frequent ones
        for w, found in editor.best_edits([w for w in sorted(common) if readable(w)]):
            n = common[w]
            fits = [(m, common[g], g) for g, m in found.items() if common.get(g, 0) > n * (TIMES if not w.isalpha() else KNOWN_TIMES) and (m > 0 or not w.isalpha())]
            if fits:
                self.known[w] = max(fits)[2]
        #: Frequent words that may be pieces of a torn word.
        self.pieces = {x for v, n in common.items() for i in range(1, len(v)) for x in (v[:i], v[i:]) if common.get(x, self.whole) < min(self.whole, n / TIMES + 1)}
        self.fine: set[str] = set()

    def is_fine(self, token: str) -> bool:
        w = token.strip(_OUTER).lower()
        if w in self.common:
            return w not in self.known and w not in self.pieces
        return not _LETTER.search(w) or bool(_NOT_WORD.fullmatch(w))

    def noise(self, values: list[list[str]]) -> list[list[bool]]:
        """Which lines of the values are no part of the text."""
        out = [[False] * len(v) for v in values]
        at, rows = [], []
        for k, lines in enumerate(values):
            if len(lines) > 1:
                for i, p in enumerate(layout(lines)):
                    if p is not None and self.furniture.candidate(lines[i], form := line_form(lines[i]), p):
                        at.append((k, i))
                        rows.append(self.furniture.features(lines[i], form, p))
        if rows:
            for (k, i), best in zip(at, self.lines.scores(np.array(rows, np.uint64)).argmax(1)):
                out[k][i] = best == 1
        return out

    def findings(self, texts: list[str]) -> Iterator[tuple]:
        """``(text number, line, line after, kind, term, start, end, fix)`` of everything to be found or judged in some texts.

        Kinds: ``ruido``, ``corte`` and ``lectura`` are found; ``w`` (a rare word), ``t`` (two pieces of a torn word) and ``j`` (two pieces
        around a line end) are terms to be judged.
        """
        values = [t.split("\n") for t in texts]
        noise = self.noise(values)
        bodies = [[i for i, x in enumerate(v) if not z[i] and x and not x.isspace()] for v, z in zip(values, noise)]
        ends, pairs = [], []
        for k, (lines, body) in enumerate(zip(values, bodies)):
            yield from ((k, i, i, "ruido", None, 0, 0, None) for i, x in enumerate(noise[k]) if x)
            for i, j in zip(body, body[1:]):
                end = lines[i].rstrip()
                if end[-1] in BREAKS and len(end) > 1 and end[-2].isalpha():
                    nxt = words_of(lines[j])
                    if nxt and lines[j].lstrip()[:1] == nxt[0][2][:1]:
                        head = re.search(r"\S+$", end[:-1])[0].lstrip(_OUTER)
                        ends.append((k, i, j))
                        pairs.append((head.lower(), nxt[0][2].lower(), nxt[0][2][:1].islower()))
        rests: set[tuple[int, int]] = set()  # lines whose first word is the rest of one
        for (k, i, j), (head, rest, low), op in zip(ends, pairs, self.editor.joins([p[:2] for p in pairs])):
            if op == "K":
                continue
            rests.add((k, j))
            if op == "J":
                whole = head + rest
                n = self.common.get(whole, 0)
                if n and n > self.common.get(f"{head}-{rest}", 0):
                    yield k, i, j, "corte", whole, 0, 0, None
                    fix = self.known.get(whole)
                    if fix:
                        yield k, i if differs(head, fix) else j, j, "lectura", None, 0, 0, None
                else:
                    yield k, i, j, "j", f"{head}\n{rest}" if low else f"{head}\n{rest}\n", len(head), 0, None
        tears, torn_pairs = [], []
        fine = self.fine
        for k, (lines, body) in enumerate(zip(values, bodies)):
            last = body[-1] if body else -1
            for i in body:
                line = lines[i]
                tokens = line.split()
                if line.rstrip()[-1] in BREAKS:
                    tokens.pop()
                if (k, i) in rests:
                    del tokens[:1]
                if not fine.issuperset(tokens):
                    new = {t for t in tokens if t not in fine and self.is_fine(t)}
                    if len(fine) > 400_000:
                        fine.clear()
                    fine |= new
                    if "|" in line or not fine.issuperset(tokens):
                        yield from self.line_terms(k, i, line, i == last, (k, i) in rests, tears, torn_pairs)
        for (k, i, a, b, fix, term), m in zip(tears, self.editor.tears(torn_pairs)):
            if m > FLOOR:
                yield k, i, i, "lectura" if term is None else "t", term, a, b, fix

    def line_terms(self, k: int, i: int, line: str, last: bool, rest: bool, tears: list, torn_pairs: list) -> Iterator[tuple]:
        words = words_of(line)
        end = line.rstrip()
        if words and end[-1] in BREAKS and words[-1][1] >= len(end) - 1:
            words = words[:-1]
        if last and words and words[-1][2].isalpha() and not _CLOSED_END.search(line) or end.endswith("..."):
            words = words[:-1]  # the last word of a value that nothing closes may have lost its end, which is no misreading
        if rest:
            words = words[1:]
        low = [w.lower() for _, _, w in words]
        for x, (a, b, w) in enumerate(words):
            n = self.common.get(low[x], 0)
            if n:
                fix = self.known.get(low[x])
                if fix:
                    yield k, i, i, "lectura", None, a, b, cased(fix, w)
            elif readable(low[x]):
                yield k, i, i, "w", low[x], a, b, None
            if x + 1 < len(words):
                c, d, v = words[x + 1]
                m = self.common.get(low[x + 1], 0)
                both = low[x] + low[x + 1]
                least = min(n, m)
                if least < self.whole and len(both) > 3 and v[0].isalpha() and _LETTER.search(w) and not line[b:c].strip():
                    if least:  # both are frequent, so is the whole if it is so much more frequent
                        if low[x] in self.pieces or low[x + 1] in self.pieces:
                            if self.common.get(both, 0) >= TIMES * least:
                                tears.append((k, i, a, d, w + v, None))
                                torn_pairs.append((low[x], low[x + 1]))
                    else:
                        tears.append((k, i, a, d, w + v, f"{low[x]} {low[x + 1]}"))
                        torn_pairs.append((low[x], low[x + 1]))


def differs(head: str, fix: str) -> bool:
    """True if a repaired word differs from the written one within its head."""
    return not fix.startswith(head)


# -- over tables

FIELDS = ("cuerpo", "notas_al_pie", "antecedentes")
_FOUND = "campo string, linea int, sigue int, clase string, termino string, desde int, hasta int, arreglo string"


def without_broken(line: str) -> str:
    """A line without its last word if that is broken."""
    end = line.rstrip(" \t\r")
    return end[: max(end.rfind(" "), end.rfind("\t")) + 1] if end[-1:] in BREAKS and end else line


def statistics(df: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """``(clase, forma, n, raras)`` over all values: words (``p``), and line forms (``r``) with how often they intrude."""
    source = df.select(*fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw: Counter = Counter()
            seen, strange = Counter(), Counter()
            for column in b.columns:
                for text in column.to_pylist():
                    if not text:
                        continue
                    text = unicodedata.normalize("NFC", text)
                    lines = text.split("\n")
                    whole = text if len(lines) == 1 else " ".join([x if x[-1:] not in _ENDS else without_broken(x) for x in lines])
                    raw.update(whole.lower().replace("|", " ").split())
                    if len(lines) > 1:
                        for x, p in zip(lines, layout(lines)):
                            if p is not None and not p[5]:
                                k = line_form(x)
                                seen[k] += 1
                                if intrudes(x, p):
                                    strange[k] += 1
            count: Counter = Counter()
            for w, n in raw.items():
                count[w.strip(_OUTER)] += n
            count.pop("", None)
            rows = [("p", w, n, 0) for w, n in count.items()] + [("r", k, n, strange.get(k, 0)) for k, n in seen.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.int64()))], names=["clase", "forma", "n", "raras"])

    return source.mapInArrow(run, "clase string, forma string, n bigint, raras bigint").groupBy("clase", "forma").agg(F.sum("n").alias("n"), F.sum("raras").alias("raras"))


def fit(df: DataFrame, fields: tuple[str, ...]) -> tuple[Reader, DataFrame]:
    """The reader and the whole table of word counts ``(forma, n)``."""
    counts = cut(statistics(spread(df.select(*fields)), fields))
    totals = {r["clase"]: r["n"] for r in counts.groupBy("clase").agg(F.sum("n").alias("n")).collect()}
    words, forms = totals.get("p", 0), totals.get("r", 0)
    frequent = counts.where((F.col("clase") == "p") & (F.col("n") >= words * UNKNOWN)).select("forma", "n").collect()  # at most 1 / UNKNOWN rows
    often = counts.where((F.col("clase") == "r") & (F.col("n") >= max(2.0, forms * FORM)) & (F.col("forma") != "")).select("forma", "n", "raras").collect()  # at most 1 / FORM rows
    furniture = Furniture({r["forma"]: (r["n"], r["raras"] / r["n"]) for r in often})
    # A bounded sample of values to label: in the order of a hash, so that runs agree.
    several = df.select(F.explode(F.array(*fields)).alias("t")).where("t like '%\n%'")
    texts = [r["t"] for r in several.withColumn("h", F.xxhash64("t")).orderBy("h").limit(LINES // 12).select("t").collect()]
    common = {r["forma"]: r["n"] for r in frequent}
    editor = fit_editor(common, {w: n for w, n in common.items() if "-" in w})
    return Reader(common, words, furniture, fit_lines(texts, furniture), editor), counts.where("clase = 'p'").select("forma", "n")


def found_terms(df: DataFrame, held, key: str, fields: tuple[str, ...]) -> DataFrame:
    """``(key, huella, huella2, campo, ...)``: what :meth:`Reader.findings` says of all values; the two hashes name the row."""
    named = df.select(key, F.xxhash64(key, *fields).alias("_a"), F.hash(key, *fields).alias("_b"), *fields)
    types = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = held.value
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                b = whole.slice(start, 500)
                texts, places = [], []
                for name, column in zip(fields, b.columns[3:]):
                    for row, text in enumerate(column.to_pylist()):
                        if text and not text.isspace():
                            texts.append(text)
                            places.append((row, name))
                got = list(reader.findings(texts))
                at = pa.array([places[g[0]][0] for g in got], pa.int64())
                columns = [[places[g[0]][1] for g in got], [g[1] + 1 for g in got], [g[2] + 1 for g in got], *[[g[i] for g in got] for i in range(3, 8)]]
                yield pa.RecordBatch.from_arrays(
                    [*[c.take(at) for c in b.columns[:3]], *map(pa.array, columns, types)], names=[key, "_a", "_b", "campo", "linea", "sigue", "clase", "termino", "desde", "hasta", "arreglo"]
                )

    return named.mapInArrow(run, f"{key} {df.schema[key].dataType.simpleString()}, _a bigint, _b int, {_FOUND}")


def verdicts(terms: DataFrame, words: DataFrame, held) -> DataFrame:
    """``(clase, termino, vale, arreglo)`` of different terms: whether it is a finding, and the repaired word if it is misread.

    The editor names the repairs of a term; each word that no broadcast count settles meets its count in one join on the word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = held.value
        names, types = ["clase", "termino", "papel", "forma", "n", "margen", "arreglo"], [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.float64(), pa.string()]
        for b in batches:
            rows: list[tuple] = []

            def ask(kind, term, role, word, margin=None, fix=None, rows=rows):
                n = reader.common.get(word)
                rows.append((kind, term, role, None if n else word, n, margin, fix))

            asked: dict[str, list[tuple[str, str]]] = defaultdict(list)
            for kind, term in zip(*(c.to_pylist() for c in b.columns)):
                if kind == "t":
                    x, y = term.split(" ")
                    for role, w in (("a", x), ("b", y), ("propia", x + y)):
                        ask(kind, term, role, w)
                else:
                    word = term if kind == "w" else "".join(term.split("\n"))
                    ask(kind, term, "propia", word)
                    if kind == "j":
                        ask(kind, term, "compuesta", "-".join(term.split("\n")[:2]))
                    if readable(word):
                        asked[word].append((kind, term))
            for word, found in reader.editor.best_edits(list(asked)):
                for kind, term in asked[word]:
                    for fix, margin in found.items():
                        ask(kind, term, "arreglo", fix, margin, fix)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    schema = "clase string, termino string, papel string, forma string, n bigint, margen double, arreglo string"
    asked = cut(terms.mapInArrow(run, schema))
    settled = asked.where("forma is null").drop("forma")
    joined = asked.where("forma is not null").drop("n").join(words, "forma", "left").drop("forma").select(*settled.columns)
    count = lambda role: F.coalesce(F.max(F.when(F.col("papel") == role, F.col("n"))), F.lit(0))
    whole = held.value.whole
    per = settled.unionByName(joined).groupBy("clase", "termino").agg(
        count("propia").alias("propia"), count("compuesta").alias("compuesta"), count("a").alias("a"), count("b").alias("b"),
        F.collect_list(F.when((F.col("papel") == "arreglo") & (F.col("n") > 0), F.struct("margen", "n", "arreglo"))).alias("x"),
    )
    valid = F.filter("x", lambda e: e["n"] > F.greatest(F.col("propia"), F.lit(1)) * TIMES)
    least = F.least("a", "b")
    per = per.withColumn("arreglo", F.array_max(valid)["arreglo"])
    rest_low = ~F.col("termino").endswith("\n")
    return per.select(
        "clase", "termino", "arreglo",
        F.when(F.col("clase") == "w", F.col("arreglo").isNotNull())
        .when(F.col("clase") == "t", (least < whole) & (F.col("propia") >= F.greatest(least, F.lit(1)) * TIMES))
        .otherwise(~((F.col("compuesta") > 0) & (F.col("propia") <= F.col("compuesta"))) & ((F.col("propia") > 0) | F.col("arreglo").isNotNull() | rest_low)).alias("vale"),
    )


def judged(df: DataFrame, key: str, fields: tuple[str, ...]) -> DataFrame:
    """The findings of all values, with those terms that are found out to be misread, torn or broken words."""
    reader, words = fit(df, fields)
    held = df.sparkSession.sparkContext.broadcast(reader)
    found = cut(found_terms(spread(df.select(key, *fields)), held, key, fields))
    sure = found.where("clase not in ('w', 't', 'j')")
    doubtful = found.where("clase in ('w', 't', 'j')").withColumnRenamed("arreglo", "escrita")
    verdict = verdicts(doubtful.select("clase", "termino").distinct(), words, held).where("vale").drop("vale")
    told = doubtful.join(verdict, ["clase", "termino"])
    one = told.where("clase in ('w', 't')").select(
        key, "_a", "_b", "campo", "linea", "sigue", F.lit("lectura").alias("clase"), "termino", "desde", "hasta", F.coalesce("escrita", "arreglo").alias("arreglo")
    )
    broken = told.where("clase = 'j'")
    whole = F.coalesce("arreglo", F.replace("termino", F.lit("\n"), F.lit("")))
    ends = broken.select(key, "_a", "_b", "campo", "linea", "sigue", F.lit("corte").alias("clase"), "termino", "desde", "hasta", F.lit(None).cast("string").alias("arreglo"))
    head = F.substring_index("termino", "\n", 1)
    misread = broken.where("arreglo is not null").select(
        key, "_a", "_b", "campo", F.when(F.startswith("arreglo", head), F.col("sigue")).otherwise(F.col("linea")).alias("linea"), "sigue", F.lit("lectura").alias("clase"), "termino",
        F.lit(0).alias("desde"), F.lit(0).alias("hasta"), F.lit(None).cast("string").alias("arreglo"),
    )
    return sure.unionByName(one).unionByName(ends).unionByName(misread)


def noisy_lines(df: DataFrame, key: str = "circular_id", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """``(key, campo, linea, clase)``: one row per different finding in a line; lines count from 1 over the value split at line feeds.

    ``ruido``: a non-blank line that is no part of the text; ``corte``: the last word goes on in the next line of text;
    ``lectura``: a misread or torn word. Null, empty and blank values give no row; rows repeated exactly give their findings once.
    """
    return judged(df, key, fields).select(key, "campo", "linea", "clase").distinct()


def paragraphs(text: str, found: list[dict]) -> str:
    """The value as continuous paragraphs: noise left out, broken words joined, misread words replaced."""
    lines = text.split("\n")
    noise, broken = {f["linea"] for f in found if f["clase"] == "ruido"}, {f["linea"]: f for f in found if f["clase"] == "corte"}
    fixes: dict[int, list[tuple[int, int, str]]] = defaultdict(list)
    for f in found:
        if f["clase"] == "lectura" and f["arreglo"] is not None:
            fixes[f["linea"]].append((f["desde"], f["hasta"], f["arreglo"]))
    out, glue = "", ""
    for i, x in enumerate(lines, 1):
        if i in noise or not x.strip():
            continue
        pieces, last = [], 0
        for a, b, w in sorted(fixes[i], key=lambda t: (t[0], -t[1])):  # of two repairs of one place the longer one holds
            if a >= last:
                pieces += [x[last:a], cased(w, x[a:b].replace(" ", "")) if w.islower() else w]
                last = b
        repaired = "".join([*pieces, x[last:]])
        if len(lines) == 1:
            return repaired
        t = " ".join(repaired.split())
        opens = re.match(r"(?:\(?[0-9]{1,3}[.)]|\[[0-9]+\]|[-•])\s", t) and (not out or out.rstrip()[-1:] in ".:;")
        out += ("\n" if out and opens and glue == " " else glue if out else "") + t
        glue = " "
        if i in broken:
            out, glue = out.rstrip()[:-1], ""
        elif out[-1:] == "-" and i < len(lines):
            glue = ""
    return out


def repaired(df: DataFrame, key: str = "circular_id", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """``(key, *fields)`` with each value as continuous readable paragraphs; null and blank values stay as they are.

    The findings of a row are gathered under its hashes, a group no larger than the row itself, and joined to it.
    """
    found = judged(df, key, fields)
    group = found.groupBy("_a", "_b").agg(F.collect_set(F.struct("campo", "linea", "clase", "desde", "hasta", "arreglo")).alias("_f"))
    rows = df.select(key, F.xxhash64(key, *fields).alias("_a"), F.hash(key, *fields).alias("_b"), *fields).join(group, ["_a", "_b"], "left").select(key, *fields, "_f")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            notes = b.column(len(fields) + 1).to_pylist()
            columns = []
            for name, c in zip(fields, b.columns[1:]):
                columns.append(pa.array([paragraphs(t, [f for f in n or () if f["campo"] == name]) if t and not t.isspace() else t for t, n in zip(c.to_pylist(), notes)], pa.string()))
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=[key, *fields])

    return rows.mapInArrow(run, ", ".join([f"{key} {df.schema[key].dataType.simpleString()}", *[f"{f} string" for f in fields]]))
