"""Toxicity by a support vector machine over a string-subsequence kernel.

A text is read through windows of its sentences: single words, two short neighbours
without the blank between them, spelt-out words without their blanks, and stretches of
long runs. Two windows are alike by the three-character subsequences they share; a
subsequence may skip up to four characters, each skipped one weighing ``DECAY``, so an
insult with inserted or missing characters stays near the plain one. Landmarks span the
kernel space (Nyström); a linear machine with squared hinge loss is trained on the
windows of labelled sentences: every window of the clean ones, each counting as one
document, as any single one would mark it, against the telling words of the toxic ones
and, for the most telling, forms of them with inserted, doubled and missing characters.
A document's score is that of its most toxic window; half is where few clean documents
of the sample are above. Windows are scored once for each task while they are known.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsift.llm.common import map_texts

#: Labelled documents of each class that are learnt from, about.
FIT_TOXIC, FIT_CLEAN = 1500, 3000
TELLING_LANDMARKS, FORM_LANDMARKS, CLEAN_LANDMARKS = 128, 160, 96
#: A telling word of that many toxic documents counts as toxic in each of them.
SURE_DOCUMENTS = 4
#: Words that tell that part as much as the most telling one are also learnt in changed forms, and what those weigh together.
STRONG_SHARE, FORMS_WEIGHT = 0.25, 2.0
#: Share of the sample's clean documents above one half.
CLEAN_SHARE = 0.032
DECAY = 0.5
#: Offsets of the second and third character of a subsequence: up to four characters are skipped.
GAPS = tuple((i, j) for j in range(2, 7) for i in range(1, j))
PENALTY = 1e-4
#: Steps of the solver, at most.
STEPS = 12
#: Lengths of two neighbouring words that are read as one: of each, and together.
PART, JOINED = (2, 6), (5, 11)
#: Longer strings are read in windows of that many characters, half of one apart.
WORD_CHARS = 32
MEMO_WORDS = 300_000
#: Words whose subsequences are held at once.
BLOCK_WORDS = 5_000
#: Words whose points in the kernel space are held at once.
POINT_WORDS = 5_000

#: Characters of a word that is spelt out: single ones between blanks, three or more.
SPELT = re.compile(r"(?<!\S)\S(?:[ \t]\S){2,}(?!\S)")
EDGES = "".join(chr(i) for i in range(33, 127) if not chr(i).isalnum())


def sentences(text: str) -> list[str]:
    return [s for s in re.split(r"(?<=[.!?])\s+|\n", text) if s.strip()]


def candidates(text: str) -> list[str]:
    """Windows of a text in lower case: words without marks around them, short neighbours joined, spelt-out words joined."""
    text = text.lower()
    words = [w.strip(EDGES) for w in text.split()]
    sizes = list(map(len, words))
    (least, most), (short, long) = PART, JOINED
    part = [least <= n <= most for n in sizes]
    joined = [words[i] + words[i + 1] for i in range(len(words) - 1) if part[i] and part[i + 1] and short <= sizes[i] + sizes[i + 1] <= long]
    return words + joined + [re.sub(r"\s", "", m) for m in SPELT.findall(text)]


def readings(word: str) -> list[str]:
    """The strings a word is compared as: itself, without inserted marks, and windows of long ones."""
    if word.isalnum() and len(word) <= WORD_CHARS:
        return [word]
    plain = "".join(c for c in word if c.isalnum())
    out = [word] if plain == word else [word, plain]
    short = [w for w in out if w and len(w) <= WORD_CHARS]
    for w in out:
        if len(w) > WORD_CHARS:
            short += [w[i : i + WORD_CHARS] for i in range(0, len(w) - WORD_CHARS // 2, WORD_CHARS // 2)]
    return short


def char_class(points: np.ndarray) -> np.ndarray:
    """64 classes: letters a-z, digits, one for other ASCII, the rest by code; 0 and 63 are the word's edges."""
    out = 38 + points % 25
    ascii_ = points < 128
    out[ascii_] = 37
    lower = (points >= 97) & (points <= 122)
    digit = (points >= 48) & (points <= 57)
    out[lower] = points[lower] - 96
    out[digit] = points[digit] - 21
    return out


def classes_of(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The character classes of all words with their edges, the word of each, and the scale of each word.

    A word is scaled by the length a word of as many characters has that repeats none.
    """
    text = "".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    ends = np.cumsum(lengths + 2)
    starts = ends - lengths - 2
    chars = np.zeros(ends[-1] if len(words) else 0, np.int64)
    chars[ends - 1] = 63
    inner = np.ones(len(chars), bool)
    inner[starts] = inner[ends - 1] = False
    chars[inner] = char_class(points)
    owner = np.repeat(np.arange(len(words)), lengths + 2)
    norm = sum(DECAY ** (2 * (j - 2)) * np.maximum(0, lengths + 2 - j) for _, j in GAPS)
    return chars, owner, 1 / np.sqrt(np.maximum(norm, 1e-9))


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word index, subsequence code below 2^18, scaled weight), sorted by word and code."""
    chars, owner, scale = classes_of(words)
    keys, weights = [np.zeros(0, np.int64)], [np.zeros(0)]
    for i, j in GAPS:
        if len(chars) <= j:
            continue
        fits = owner[:-j] == owner[j:]
        code = chars[: len(chars) - j] << 12 | chars[i : len(chars) - j + i] << 6 | chars[j:]
        keys.append((owner[: len(chars) - j] << 18 | code)[fits])
        weights.append(np.full(len(keys[-1]), DECAY ** (j - 2)))
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    word = key >> 18
    return word, key & (1 << 18) - 1, np.bincount(at, np.concatenate(weights), len(key)) * scale[word]


def kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Scaled subsequence kernel between words and landmarks."""
    row, code, weight = subsequences(words)
    column, other, share = subsequences(landmarks)
    codes, at = np.unique(other, return_inverse=True)
    table = np.zeros((len(codes) + 1, len(landmarks)), np.float32)  # the last row: no landmark has it
    table[at, column] = share
    place = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
    place = np.where(codes[place] == code, place, len(codes))
    out = np.zeros((len(words), len(landmarks)), np.float64)
    edges = np.searchsorted(row, np.arange(len(words) + 1))
    for i in range(len(words)):
        a, b = edges[i], edges[i + 1]
        out[i] = weight[a:b] @ table[place[a:b]]
    return out


def sigmoid_fit(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve from margins to labels, by damped Newton steps."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = np.array([((p - label) * margin).sum() + 0.01 * a, (p - label).sum()])
        h = p * (1 - p)
        hess = np.array([[(h * margin**2).sum() + 0.01, (h * margin).sum()], [(h * margin).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(hess + 1e-6 * np.eye(2), g)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
    return float(max(a, 1e-3)), float(b)


@dataclass
class ToxicityModel:
    """Margin of a word = sum of its subsequences' weights times ``table``, plus ``bias``."""

    table: np.ndarray
    bias: float
    slope: float
    shift: float
    base: float  # score without any word

    def margins(self, words: list[str]) -> np.ndarray:
        out, table = np.full(len(words), self.bias), self.table.astype(np.float32)
        for at in range(0, len(words), BLOCK_WORDS):
            part = words[at : at + BLOCK_WORDS]
            chars, owner, scale = classes_of(part)
            total, chars, n = np.zeros(len(chars), np.float32), chars.astype(np.int32), len(chars)
            first, second = chars << 12, chars << 6
            for j in range(2, min(n, GAPS[-1][1] + 1)):
                reach = np.zeros(n - j, np.float32)
                for i in range(1, j):
                    reach += table[first[: n - j] | second[i : n - j + i] | chars[j:]]
                reach *= owner[:-j] == owner[j:]
                total[: n - j] += DECAY ** (j - 2) * reach
            out[at : at + len(part)] += np.bincount(owner, total, len(part)) * scale
        return out

    def score(self, margin: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30))))


class WordScores:
    """Margins of words, kept for those met lately."""

    def __init__(self, model: ToxicityModel):
        self.model, self.known = model, {}

    def learn(self, words: set[str]) -> None:
        parts = [(w, r) for w in words for r in readings(w)]
        margins = self.model.margins([r for _, r in parts]).tolist() if parts else []
        known = self.known
        known.update(dict.fromkeys(words, -np.inf))
        for (w, _), m in zip(parts, margins, strict=True):
            if m > known[w]:
                known[w] = m

    def scores(self, texts: list[str]) -> list[float]:
        windows = [candidates(t) for t in texts]
        held = set().union(*windows)
        missing = held.difference(self.known)
        if missing:
            if len(self.known) + len(missing) > MEMO_WORDS:
                self.known, missing = {}, held
            self.learn(missing)
        best = [max(map(self.known.__getitem__, w), default=-np.inf) for w in windows]
        return [self.model.base if m == -np.inf else self.model.score(m) for m in best]


def changed_forms(word: str) -> list[str]:
    """A word with one or two letters inserted, one doubled, or one missing; which letters follows from the word."""
    letters, out = "abcdefghijklmnopqrstuvwxyz", set()
    for k in range(1, len(word)):
        draw = zlib.crc32(f"{word} {k}".encode())
        a, b, c = letters[draw % 26], letters[draw // 26 % 26], letters[draw // 676 % 26]
        out |= {word[:k] + a + word[k:], word[:k] + b + c + word[k:], word[:k] + word[k - 1] + word[k:]}
        if len(word) > 4 and k < len(word) - 1:
            out.add(word[:k] + word[k + 1 :])
    return sorted(out - {word})


def fit_machine(positives: list[tuple[str, float]], negatives: list[str], cost: float, landmarks: list[str], base: float) -> ToxicityModel:
    """Squared hinge loss over weighted positive strings and negative ones of equal cost, by Newton steps.

    A step looks at every negative through the table of subsequences, which is cheap, and
    maps only those inside the margin into the kernel space, a block at a time; the others
    do not count in the loss. It ends when these stay the same.
    """
    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks))
    good = values > 1e-6
    root = vectors[:, good] / np.sqrt(values[good])
    column, code, part = subsequences(landmarks)
    size = root.shape[1]
    model = ToxicityModel(np.zeros(1 << 18), 0.0, 1.0, 0.0, base)
    strings, costs = [w for w, _ in positives], np.array([c for _, c in positives])
    w, last = np.zeros(size + 1), None
    for _ in range(STEPS):
        sides = []
        for words, sign, each in ((strings, 1.0, costs), (negatives, -1.0, np.full(len(negatives), cost))):
            inside = np.flatnonzero(sign * model.margins(words) < 1)
            sides.append((words, sign, each, inside))
        if last is not None and all(map(np.array_equal, last, (s[3] for s in sides))):
            break
        last = [s[3] for s in sides]
        left, right = PENALTY * np.eye(size + 1), np.zeros(size + 1)
        left[-1, -1] = 1e-9
        for words, sign, each, inside in sides:
            for at in range(0, len(inside), POINT_WORDS):
                some = inside[at : at + POINT_WORDS]
                x = np.column_stack([kernel([words[i] for i in some.tolist()], landmarks) @ root, np.ones(len(some))])
                weighed = each[some, None] * x
                left += x.T @ weighed
                right += sign * weighed.sum(axis=0)
        w = np.linalg.solve(left, right)
        model.table = np.bincount(code, part * (root @ w[:-1])[column], 1 << 18)
        model.bias = float(w[-1])
    return model


def spread(words: list[str], n: int) -> list[str]:
    return words[:: max(1, len(words) // n)][:n]


def fit_rows(rows: list[tuple[str, int]]) -> ToxicityModel:
    """Model of (text, label) rows; with one class only, every score is that class's share."""
    labels = np.array([y for _, y in rows], float)
    share = float(labels.mean()) if rows else 0.0
    blank = ToxicityModel(np.zeros(1 << 18), 0.0, 1.0, float(np.log((share + 1e-3) / (1 - share + 1e-3))), share)
    if not rows or labels.min() == labels.max():
        return blank
    one: dict[str, str] = {}  # a single object for each window
    bags = [sorted({one.setdefault(r, r) for s in sentences(t) for w in candidates(s) for r in readings(w)}) for t, _ in rows]
    one.clear()
    toxic, clean = {}, {}
    for bag, y in zip(bags, labels, strict=True):
        side = toxic if y else clean
        for w in bag:
            side[w] = side.get(w, 0) + 1
    n_toxic, n_clean = labels.sum(), (1 - labels).sum()
    rate = lambda w: np.log((toxic.get(w, 0) + 0.5) / (n_toxic + 1)) - np.log((clean.get(w, 0) + 0.5) / (n_clean + 1))
    worth = {w: toxic[w] * rate(w) for w in toxic if rate(w) > 1.5}
    telling = sorted(worth, key=lambda w: (-worth[w], w))
    common = sorted(clean, key=lambda w: (-clean[w], w))
    if not telling or not common:
        return blank
    strong = [w for w in telling if worth[w] >= STRONG_SHARE * worth[telling[0]] and len(w) >= 4]
    sure = {w for w in telling if toxic[w] >= min(SURE_DOCUMENTS, n_toxic) and rate(w) > 2 and len(w) >= 4} or set(telling[:1])
    forms = {w: [f for f in changed_forms(w) if f not in clean] for w in strong}
    total = float(sum(toxic[w] for w in sure))
    positives = [(w, toxic[w] / total) for w in sorted(sure)]
    positives += [(f, FORMS_WEIGHT / len(strong) / len(fs)) for w, fs in forms.items() for f in fs]
    every = sorted({f for fs in forms.values() for f in fs})
    landmarks = list(dict.fromkeys(telling[:TELLING_LANDMARKS] + spread(every, FORM_LANDMARKS) + spread(common, CLEAN_LANDMARKS)))
    model = fit_machine(positives, [w for w in common if w not in sure], 1 / n_clean, landmarks, blank.base)
    windows = sorted({*toxic, *clean})
    margin = dict(zip(windows, model.margins(windows).tolist(), strict=True))
    best = np.array([max((margin[w] for w in bag), default=-1.0) for bag in bags])
    model.slope, _ = sigmoid_fit(best, labels)
    model.shift = -model.slope * float(np.quantile(best[labels == 0], 1 - CLEAN_SHARE))
    return model


def fit(learn: DataFrame, text: str = "text", label: str = "toxic", key: str = "doc_id") -> ToxicityModel:
    """Model of the labelled rows of ``learn``: about ``FIT_TOXIC`` and ``FIT_CLEAN`` of them, chosen by a hash of ``key``."""
    known = learn.where(F.col(label).isin(0, 1) & F.col(text).isNotNull())
    sizes = {r["y"]: r["n"] for r in known.groupBy(F.col(label).alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    draw = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 20)) / float(1 << 20)
    part = lambda y, n: (F.col(label) == y) & (draw < min(1.0, n / max(1, sizes.get(y, 0))))
    sample = known.where(part(1, FIT_TOXIC) | part(0, FIT_CLEAN)).select(F.col(text).alias("t"), F.col(label).alias("y"))
    return fit_rows(sorted((r["t"], int(r["y"])) for r in sample.toLocalIterator()))


def score_toxicity(docs: DataFrame, model: ToxicityModel, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` with ``score`` (0 to 1), that of the most toxic word of the whole text.

    Null and empty texts, and texts of marks only, get the score that the share of
    toxic documents gives. Repeated rows get the same score.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        words = WordScores(shared.value)
        return lambda texts: {"score": words.scores([t.decode("utf-8", "replace") for t in texts])}

    return map_texts(docs, text, keep, "score double", make)
