"""Language of whole texts: nearest of several TF-IDF centroids per language.

Texts become counts of hashed letter n-grams (1 to 3 letters, words padded by a
blank), weighted by the logarithm of their rarity over all learning documents and
scaled to length 1. The vectors of each language are clustered, all of them, in passes
over their written counts; a text takes the language of the centroid with the largest cosine, and is rejected
where that cosine is below what texts of that length have with their own language.
Whole texts and passages of all lengths tell how near that is, for each centroid.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starsift.llm.common import ARRAY_ROWS, array_rows, array_sums, give_back, map_texts, slices, small_batches
from starsift.staging import stage, stage_path

BUCKET_BITS = 12
BUCKETS = 1 << BUCKET_BITS
CENTROIDS = 4
ROUNDS = 12
#: A text is rejected if it is less similar than this share of texts of its language and length.
REJECT_QUANTILE = 0.005
#: Texts of a length and a centroid that its own limit takes, at least; else all centroids share one.
LIMIT_TEXTS = 200
#: Lengths are told apart by the binary logarithm of the number of n-grams, up to this one.
LENGTHS = 18
#: With too few texts of a length: this share of what the 1 in 1000 least similar learnt text has.
REJECT_SHARE = 0.5
#: Cosines are counted in this many bins, vectors are added up in this part of their length, and so many at once.
BINS, UNITS, CHUNK = 1 << 13, 1 << 20, 256

#: Letters of the basic plane; rarer planes are looked up where they occur.
LETTER = np.frompyfunc(lambda c: chr(c).isalpha(), 1, 1)(np.arange(0x10000)).astype(bool)


def folded(lowered: str) -> np.ndarray:
    """Code points of a lower-cased text, other characters than letters as blanks."""
    points = np.frombuffer(lowered.encode("utf-32-le", "replace"), np.uint32)
    is_letter = LETTER[np.minimum(points, 0xFFFF)]
    high = points > 0xFFFF
    if high.any():
        is_letter = np.where(high, [chr(c).isalpha() if c > 0xFFFF else False for c in points.tolist()], is_letter)
    return np.where(is_letter, points, 32).astype(np.uint32)


def spaced(points: np.ndarray) -> np.ndarray:
    """Every run of blanks as one, blanks around."""
    out = np.concatenate(([32], points, [32])).astype(np.uint32)
    blank = out == 32
    return out[~(blank & np.concatenate(([False], blank[:-1])))]


def letters(text: bytes) -> np.ndarray:
    """Code points of the lower-cased text, every run of other characters as one blank, blanks around."""
    return spaced(folded(text.decode("utf-8", "replace").lower()))


def gram_codes(c: np.ndarray) -> np.ndarray:
    """Bucket of each n-gram of ``letters``; none without a letter."""
    if len(c) < 3:
        return np.zeros(0, np.uint32)
    one = c * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ c[1:]) * np.uint32(0x85EBCA6B)
    three = (two[:-1] ^ c[2:]) * np.uint32(0xC2B2AE35)
    return np.concatenate((one[c != 32], two, three)) >> np.uint32(32 - BUCKET_BITS)


def gram_counts(text: bytes) -> np.ndarray:
    """How often each bucket of n-grams occurs; all 0 without a letter."""
    return np.bincount(gram_codes(letters(text)), minlength=BUCKETS)


def unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=-1, keepdims=True)
    return np.divide(rows, length, out=np.zeros_like(rows), where=length > 0)


def length_class(counts: np.ndarray) -> np.ndarray:
    """``class_of`` the number of n-grams of each row."""
    return class_of(counts.sum(axis=-1))


def class_of(n_grams: np.ndarray) -> np.ndarray:
    """Binary logarithm, rounded down."""
    return np.clip(np.log2(np.maximum(n_grams, 1)).astype(int), 0, LENGTHS - 1)


def places(text: bytes, n_chars: int) -> list[tuple[int, int]]:
    """Start and length of a passage of each length class below the text's own, from places that its checksum gives."""
    out, place = [], zlib.crc32(text)
    for k in range(3, LENGTHS):
        n = (3 << k) // 6  # about 3 n-grams a letter
        if n * 2 > n_chars:
            break
        out.append((place % (n_chars - n), n))
    return out


def passages(text: bytes) -> list[bytes]:
    """The text and its passages."""
    chars = text.decode("utf-8", "replace")
    return [text] + [chars[at : at + n].encode("utf-8", "replace") for at, n in places(text, len(chars))]


def passage_codes(text: bytes) -> list[np.ndarray]:
    """``gram_codes`` of all ``passages``; letters are looked up once for all of them."""
    chars = text.decode("utf-8", "replace")
    lowered, at_all = chars.lower(), places(text, len(chars))
    whole = folded(lowered)
    # A sigma is lowered by what follows it, and some letters become two.
    alone = len(lowered) != len(chars) or "\u03a3" in chars
    parts = [folded(chars[at : at + n].lower()) if alone else whole[at : at + n] for at, n in at_all]
    return [gram_codes(spaced(p)) for p in [whole, *parts]]


def length_limits(found: dict[tuple[int, int], tuple[int, float]], n_centroids: int, least: float) -> np.ndarray:
    """(centroids, lengths): least cosine that is not rejected, from texts of known language.

    ``found`` has the number of texts and their limit by (centroid, length), and by (-1, length) for all
    centroids. A length with too few texts takes the limit of the next shorter one, ``least`` if there is none.
    """
    out = np.full((n_centroids, LENGTHS), least)
    for k in range(LENGTHS):
        n, limit = found.get((-1, k), (0, least))
        if n < LIMIT_TEXTS:
            out[:, k] = out[:, k - 1] if k else least
            continue
        for c in range(n_centroids):
            own, own_limit = found.get((c, k), (0, limit))
            out[c, k] = own_limit if own >= LIMIT_TEXTS else limit
    return out


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # of the buckets
    centroids: np.ndarray  # rows of length 1
    owners: np.ndarray  # language index of each centroid
    reject_below: np.ndarray  # by centroid and length class

    def nearness(self, texts: list[bytes], language: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(centroid, length class, cosine) of texts with a letter: the nearest centroid of their language."""
        counts = np.stack([gram_counts(t) for t in texts])
        counts = counts[counts.any(axis=1)]
        own = np.flatnonzero(self.owners == self.languages.index(language))
        near = unit((counts * self.weights).astype(np.float32)) @ self.centroids[own].T
        best = near.argmax(axis=1)
        return own[best], length_class(counts), near[np.arange(len(counts)), best]

    def predict(self, texts: list[bytes]) -> tuple[list[str], list[float], list[bool]]:
        """Language, cosine (0 to 1) and rejection of each text."""
        counts = np.stack([gram_counts(t) for t in texts]) if texts else np.zeros((0, BUCKETS))
        spoken = counts.any(axis=1)
        if not self.languages:
            return ["und"] * len(texts), [0.0] * len(texts), [True] * len(texts)
        near = unit((counts * self.weights).astype(np.float32)) @ self.centroids.T
        best = near.argmax(axis=1) if len(texts) else np.zeros(0, int)
        score = np.clip(near[np.arange(len(texts)), best], 0, 1)
        names = [self.languages[self.owners[b]] if s else "und" for b, s in zip(best.tolist(), spoken, strict=True)]
        return names, score.astype(float).tolist(), (~spoken | (score < self.reject_below[best, length_class(counts)])).tolist()


def counted_grams(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(l, gaps, counts) of every row, written: which buckets occur, as steps from the one before, and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "t"):
                gaps, counts = [], []
                for t in part.column("t").to_pylist():
                    all_counts = gram_counts(t or b"")
                    found = np.flatnonzero(all_counts)
                    gaps.append(np.diff(found, prepend=0).astype(np.uint16).tobytes())
                    counts.append(all_counts[found].astype(np.uint32).tobytes())
                yield pa.RecordBatch.from_arrays([part.column("l"), pa.array(gaps, pa.binary()), pa.array(counts, pa.binary())], ["l", "gaps", "counts"])
        give_back()

    small_batches(docs.sparkSession)
    source = docs.select(F.col(f"`{lang}`").cast("string").alias("l"), F.col(f"`{text}`").cast("binary").alias("t"))
    path = stage_path(docs.sparkSession, "language-grams")
    source.mapInArrow(run, "l string, gaps binary, counts binary").write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema("l string, gaps binary, counts binary").parquet(path)


def starts_of(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


@dataclass
class Vectors:
    """Weighted counts of texts with a letter: the buckets that occur in each, row after row, and their weights."""

    sizes: np.ndarray  # buckets of each row
    buckets: np.ndarray
    weights: np.ndarray

    def spread(self) -> np.ndarray:
        """Rows with all buckets, as weighted."""
        out = np.zeros((len(self.sizes), BUCKETS), np.float32)
        out[np.repeat(np.arange(len(self.sizes)), self.sizes), self.buckets] = self.weights
        return out

    def dense(self) -> np.ndarray:
        """Rows of length 1 with all buckets."""
        return unit(self.spread())

    def scaled(self) -> np.ndarray:
        """Weights of rows of length 1; lengths are those of whole rows, to the last digit."""
        return self.weights / np.repeat(np.linalg.norm(self.spread(), axis=-1), self.sizes)

    def nearest(self, scaled: np.ndarray, speaker: np.ndarray, table: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, cosine) of the nearest centroid among those of each row's language, see ``side_by_side``."""
        k = table.shape[1]
        met = table.take(np.repeat(speaker * BUCKETS, self.sizes) + self.buckets, axis=0) * scaled[:, None]
        near = np.where(np.arange(k) < known[speaker][:, None], np.add.reduceat(met, starts_of(self.sizes), axis=0), -np.inf)
        best = near.argmax(axis=1)
        return best, near[np.arange(len(best)), best]


def side_by_side(centers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(languages * buckets, centroids) weights of the centroids of each language, and how many it has."""
    known = np.array([len(c) for c in centers])
    table = np.zeros((len(centers), BUCKETS, max(known.max(), 1)), np.float32)
    for i, own in enumerate(centers):
        table[i, :, : len(own)] = own.T
    return table.reshape(-1, table.shape[2]), known


def written_counts(gaps: list[bytes], counts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets of each row, buckets, counts) of rows of ``counted_grams``."""
    sizes = np.array([len(g) // 2 for g in gaps], np.int64)
    run = np.cumsum(np.frombuffer(b"".join(gaps), np.uint16), dtype=np.int64)
    before = np.concatenate(([0], run))[starts_of(sizes)]
    return sizes, run - np.repeat(before, sizes), np.frombuffer(b"".join(counts), np.uint32)


def gram_rarity(grams: DataFrame) -> np.ndarray:
    """Weight of each bucket: log of (documents + 1) / (documents with it + 1), over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS + 1, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                total[:-1] += np.bincount(written_counts(part.column(0).to_pylist(), [])[1], minlength=BUCKETS)
                total[-1] += part.num_rows
        yield array_rows({0: total})

    seen = array_sums(grams.select("gaps", "counts").mapInArrow(count, ARRAY_ROWS)).get(0, np.zeros(BUCKETS + 1))
    return np.log((seen[-1] + 1) / (seen[:-1] + 1)) + 0.05


def each_language(grams: DataFrame, languages: list[str], weights: np.ndarray, held: object, schema: str, make: Callable) -> DataFrame:
    """One pass over all vectors: ``make(held)`` is (take, done); ``take`` gets the language index of each row
    and the ``Vectors``, ``done`` returns the batches of the task. Rows without a letter are left out."""
    spark = grams.sparkSession
    shared = spark.sparkContext.broadcast((languages, weights, held))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, rarity, own = shared.value
        at_name = {name: i for i, name in enumerate(names)}
        take, done = make(own)
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                rows = [r for r in zip(*(c.to_pylist() for c in part.columns), strict=True) if r[1] and r[0] in at_name]
                if rows:
                    sizes, buckets, counts = written_counts([r[1] for r in rows], [r[2] for r in rows])
                    weighted = (counts.astype(np.float32) * rarity[buckets]).astype(np.float32)
                    take(np.array([at_name[r[0]] for r in rows]), Vectors(sizes, buckets, weighted))
        yield from done()

    return grams.select("l", "gaps", "counts").mapInArrow(run, schema)


def nearest_sums(held: tuple[list[np.ndarray], list[int]]) -> tuple[Callable, Callable]:
    """Sums of the vectors nearest to each centroid of their language, in whole units, so that no order of adding matters."""
    centers, first = held
    first, (table, known) = np.array(first), side_by_side(centers)
    sums: dict[int, np.ndarray] = {}

    def take(speaker: np.ndarray, rows: Vectors) -> None:
        scaled = rows.scaled()
        own = first[speaker] + rows.nearest(scaled, speaker, table, known)[0]
        met, at = np.unique(own, return_inverse=True)
        spots = np.repeat(at * BUCKETS, rows.sizes) + rows.buckets
        added = np.bincount(spots, np.rint(scaled * UNITS), len(met) * BUCKETS).reshape(-1, BUCKETS).astype(np.int64)
        for c, whole in zip(met.tolist(), added, strict=True):
            sums[c] = sums.get(c, 0) + whole

    return take, lambda: [array_rows(sums)]


def next_starts(held: list[np.ndarray]) -> tuple[Callable, Callable]:
    """The vector of each language whose draw, by its distance from the starts so far, comes first."""
    import xxhash

    best: dict[int, tuple[float, bytes]] = {}

    def take(speaker: np.ndarray, vectors: Vectors) -> None:
        dense = vectors.dense()
        for i in np.unique(speaker).tolist():
            race_of(i, dense[speaker == i])

    def race_of(i: int, rows: np.ndarray) -> None:
        far = 1 - (rows @ held[i].T).max(axis=1).astype(float)
        draws = np.array([(xxhash.xxh64_intdigest(r.tobytes(), 42) + 0.5) / 2.0**64 for r in rows])
        race = np.where(far > 1e-5, -np.log(draws) / np.maximum(far, 1e-5), np.inf)
        at = int(race.argmin())
        if np.isfinite(race[at]):
            best[i] = min(best.get(i, (np.inf, b"")), (float(race[at]), rows[at].tobytes()))

    def done() -> list[pa.RecordBatch]:
        arrays = [pa.array(list(best), pa.int32()), pa.array([r for r, _ in best.values()], pa.float64()), pa.array([v for _, v in best.values()], pa.binary())]
        return [pa.RecordBatch.from_arrays(arrays, ["i", "race", "v"])]

    return take, done


def near_bins(held: list[np.ndarray]) -> tuple[Callable, Callable]:
    """How many vectors have which cosine with the nearest centroid of their language."""
    total, (table, known) = np.zeros(BINS + 1, np.int64), side_by_side(held)

    def take(speaker: np.ndarray, rows: Vectors) -> None:
        total[:] += np.bincount(bin_of(rows.nearest(rows.scaled(), speaker, table, known)[1]), minlength=BINS + 1)

    return take, lambda: [array_rows({0: total})]


def bin_of(cosine: np.ndarray) -> np.ndarray:
    return (np.clip(cosine, 0, 1) * BINS).astype(np.int64)


def spherical_clusters(grams: DataFrame, languages: list[str], weights: np.ndarray, k: int, rounds: int = ROUNDS) -> list[np.ndarray]:
    """Up to ``k`` centroids of length 1 for each language, from all its vectors; empty for one without a letter.

    The first start is the mean, the others are drawn with a chance that grows with the
    distance from those before; the draw is a hash of the vector, so the same rows always
    give the same centroids. Only sums and starts reach the driver.
    """
    centers = [np.zeros((1, BUCKETS), np.float32) for _ in languages]

    def summed() -> list[np.ndarray]:
        first = np.concatenate(([0], np.cumsum([len(c) for c in centers]))).astype(int).tolist()
        sums = array_sums(each_language(grams, languages, weights, (centers, first), ARRAY_ROWS, nearest_sums))
        moved = [[sums.get(first[i] + c) for c in range(len(own))] for i, own in enumerate(centers)]
        return [np.stack([unit(s.astype(float)).astype(np.float32) if s is not None else o for s, o in zip(m, own, strict=True)]) for m, own in zip(moved, centers, strict=True)]

    centers = summed()
    for _ in range(k - 1):
        drawn = each_language(grams, languages, weights, centers, "i int, race double, v binary", next_starts)
        rows = drawn.groupBy("i").agg(F.min(F.struct("race", "v")).alias("best")).select("i", "best.v").collect()
        for r in rows:
            centers[r["i"]] = np.concatenate((centers[r["i"]], np.frombuffer(bytes(r["v"]), np.float32)[None]))
    for _ in range(rounds):
        before, centers = centers, summed()
        if all(np.array_equal(a, b) for a, b in zip(before, centers, strict=True)):
            break
    return [c[c.any(axis=1)] for c in centers]


def calibrated(docs: DataFrame, model: LanguageModel, text: str, lang: str, least: float) -> np.ndarray:
    """Limits of rejection from the passages of ``docs``, whose languages the model knows.

    Cosines are counted in bins, so every passage has its part and no group holds more than the bins.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = shared.value
        at_name = {name: i for i, name in enumerate(told.languages)}
        owned = [np.flatnonzero(told.owners == i) for i in range(len(at_name))]
        table, known = side_by_side([told.centroids[own] for own in owned])
        first = np.array([own[0] if len(own) else 0 for own in owned])

        def bins_of(speaker: list[int], codes: list[np.ndarray]) -> np.ndarray:
            """(centroid, length class, bin) of passages, as one number each."""
            of = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
            n = np.bincount(of * BUCKETS + np.concatenate(codes), minlength=len(codes) * BUCKETS)
            spots = np.flatnonzero(n)
            sizes, buckets = np.bincount(spots // BUCKETS, minlength=len(codes)), spots % BUCKETS
            rows, who = Vectors(sizes, buckets, (n[spots] * told.weights[buckets]).astype(np.float32)), np.array(speaker)
            place, cosine = rows.nearest(rows.scaled(), who, table, known)
            return ((first[who] + place) * LENGTHS + class_of(np.array([len(c) for c in codes]))) * (BINS + 1) + bin_of(cosine)

        for batch in batches:
            found, speaker, codes = [np.zeros(0, np.int64)], [], []
            for part in slices(batch, "t"):
                for name, t in zip(part.column("l").to_pylist(), part.column("t").to_pylist(), strict=True):
                    if t and name in at_name:
                        own = [c for c in passage_codes(t) if len(c)]
                        speaker, codes = speaker + [at_name[name]] * len(own), codes + own
                    if len(codes) >= CHUNK // 4:
                        found.append(bins_of(speaker, codes))
                        speaker, codes = [], []
            if codes:
                found.append(bins_of(speaker, codes))
            keys, n = np.unique(np.concatenate(found), return_counts=True)
            group, low = keys // (BINS + 1), keys % (BINS + 1)
            arrays = [pa.array(group // LENGTHS, pa.int32()), pa.array(group % LENGTHS, pa.int32()), pa.array(low, pa.int32()), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["centroid", "length", "bin", "n"])
        give_back()

    small_batches(docs.sparkSession)
    source = docs.select(F.col(f"`{lang}`").cast("string").alias("l"), F.col(f"`{text}`").cast("binary").alias("t"))
    told = source.mapInArrow(run, "centroid int, length int, bin int, n long")
    counts = told.groupBy("centroid", "length", "bin").agg(F.sum("n").alias("n"))
    own = stage(counts, "language-bins")
    both = own.unionByName(own.groupBy(F.lit(-1).alias("centroid"), "length", "bin").agg(F.sum("n").alias("n")))
    group = Window.partitionBy("centroid", "length")
    upto = both.select("centroid", "length", "bin", F.sum("n").over(group).alias("total"), F.sum("n").over(group.orderBy("bin")).alias("upto"))
    low = upto.where(F.col("upto") >= F.floor(REJECT_QUANTILE * (F.col("total") - 1)) + 1)
    rows = low.groupBy("centroid", "length").agg(F.min("bin").alias("bin"), F.first("total").alias("total")).collect()
    return length_limits({(r["centroid"], r["length"]): (r["total"], r["bin"] / BINS) for r in rows}, len(model.owners), least)


def fit(learn: DataFrame, text: str = "text", lang: str = "lang", centroids: int = CENTROIDS) -> LanguageModel:
    """Model of the rows of ``learn`` with a language and a letter; none: a model that knows no language.

    Every such row has its part in the weights, the clusters and the limits of
    rejection; nothing but text and language is learnt.
    """
    known = learn.where(F.col(f"`{lang}`").isNotNull())
    grams = counted_grams(known, text, lang)
    weights = gram_rarity(grams)
    spoken = grams.where(F.length("gaps") > 0)
    names = sorted(r["l"] for r in spoken.select("l").distinct().collect())
    found = spherical_clusters(spoken, names, weights, centroids) if names else []
    languages = [name for name, c in zip(names, found, strict=True) if len(c)]
    centers = [c for c in found if len(c)]
    if not languages:
        return LanguageModel([], weights, np.zeros((0, BUCKETS), np.float32), np.zeros(0, int), np.zeros((0, LENGTHS)))
    bins = array_sums(each_language(spoken, languages, weights, centers, ARRAY_ROWS, near_bins))[0]
    least = REJECT_SHARE * int(np.searchsorted(np.cumsum(bins), np.floor(0.001 * (bins.sum() - 1)) + 1)) / BINS
    owners = np.repeat(np.arange(len(languages)), [len(c) for c in centers])
    model = LanguageModel(languages, weights, np.concatenate(centers), owners, np.full((len(owners), LENGTHS), least))
    model.reject_below = calibrated(known, model, text, lang, least)
    return model


def identify(docs: DataFrame, model: LanguageModel, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` with ``lang_pred``, ``score`` (cosine, 0 to 1) and ``rejected``.

    Null texts and texts without a letter are ``und`` with score 0 and rejected.
    Texts too far from every centroid keep the nearest language and are rejected.
    Of equally near centroids the first language by name wins.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def rows(texts: list[bytes]) -> dict[str, list]:
            names, scores, rejected = [], [], []
            for at in range(0, len(texts), 256):
                n, s, r = shared.value.predict(texts[at : at + 256])
                names, scores, rejected = names + n, scores + s, rejected + r
            return {"lang_pred": names, "score": scores, "rejected": rejected}

        return rows

    return map_texts(docs, text, keep, "lang_pred string, score double, rejected boolean", make)
