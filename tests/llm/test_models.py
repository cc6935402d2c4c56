"""Language ID and toxicity on texts that are held out, and their edge cases."""

import zlib

import numpy as np
import pytest

from starsift.llm import language_id, queries, toxicity

SF = "/root/testdata/sf0.01"
CLEAN = ["the weather is fine today", "we walk to the river", "bread and milk for breakfast", "a quiet evening at home", "books on the table"]


def test_language_query(spark):
    rows = queries.op5_language_id(spark, SF).collect()
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(truth)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["lang_pred"] in {"en", "de", "fr", "es", "und"}
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.95
    assert np.mean([r["rejected"] for r in rows]) < 0.02


def test_language_edge_cases(spark, docs_of, odd_texts):
    learn = docs_of([(i, t, "en") for i, t in enumerate(CLEAN)] + [(9, "der die das und nicht", "de"), (10, "null", None), (11, None, "fr")])
    model = language_id.fit(learn)
    assert model.languages == ["de", "en"]
    docs = docs_of([*odd_texts, (60, "123 !!! 456"), (61, "nicht und die")]).withColumnRenamed("lang", "score")
    rows = {r["doc_id"]: r for r in language_id.identify(docs, model, ["doc_id"]).collect()}
    assert len(rows) == len({r[0] for r in odd_texts}) + 2
    assert all(rows[i]["lang_pred"] == "und" and rows[i]["rejected"] and rows[i]["score"] == 0 for i in (1, 2, 3, 60))
    assert rows[61]["lang_pred"] == "de" and not rows[61]["rejected"]
    none = language_id.fit(docs_of([]))
    assert all(r["lang_pred"] == "und" for r in language_id.identify(docs, none, ["doc_id"]).collect())
    assert language_id.identify(docs_of([]), model, ["doc_id"]).collect() == []


UNSEEN = {
    "pl": "Wczoraj wieczorem poszliśmy na spacer nad rzekę i rozmawialiśmy o tym, co będziemy robić w przyszłym roku, kiedy dzieci pójdą już do szkoły. ",
    "it": "Ieri sera siamo andati a fare una passeggiata lungo il fiume e abbiamo parlato di quello che faremo l'anno prossimo, quando i bambini andranno a scuola. ",
    "hu": "Tegnap este sétálni mentünk a folyóhoz, és arról beszélgettünk, hogy mit fogunk csinálni jövőre, amikor a gyerekek már iskolába járnak. ",
    "tr": "Dün akşam nehir kıyısında yürüyüşe çıktık ve gelecek yıl çocuklar okula başladığında ne yapacağımızı konuştuk. ",
    "fi": "Eilen illalla menimme kävelylle joen rannalle ja puhuimme siitä, mitä teemme ensi vuonna, kun lapset menevät kouluun. ",
    "vi": "Tối hôm qua chúng tôi đi dạo bên bờ sông và nói về những gì chúng tôi sẽ làm vào năm tới khi bọn trẻ bắt đầu đi học. ",
    "gibberish": "xqzv kjwq zzxv wqpl bnmx tyqz hhgf vbzx plkq jwvx qqzt mnbv cxzq lkjh gfdq wzyx ",
}


def test_whole_texts_of_unseen_languages_are_rejected(spark, docs_of):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    held = docs.where("crc32(cast(cast(doc_id as string) as binary)) % 4 = 2")
    model = language_id.fit(docs.where("crc32(cast(cast(doc_id as string) as binary)) % 4 <> 2"))
    unseen = docs_of([(i, t * 4, None) for i, t in enumerate(UNSEEN.values())])
    assert all(r["rejected"] for r in language_id.identify(unseen, model, ["doc_id"]).collect())
    own = language_id.identify(held, model, ["doc_id"]).collect()
    assert np.mean([r["rejected"] for r in own]) < 0.01


def auc(scores, labels):
    order = np.argsort(scores)
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(len(scores))
    for v in np.unique(scores):
        ranks[scores == v] = ranks[scores == v].mean()
    pos = labels == 1
    return (ranks[pos].sum() - pos.sum() * (pos.sum() - 1) / 2) / (pos.sum() * (~pos).sum())


def test_toxicity_query(spark):
    rows = queries.op8_toxicity(spark, "/root/testdata/sf0.1").collect()
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    held = [r for r in rows if r["held_out"] and truth.get(r["doc_id"]) is not None]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    scores = np.array([r["score"] for r in held])
    labels = np.array([truth[r["doc_id"]] for r in held])
    assert auc(scores, labels) > 0.9
    assert (scores[labels == 0] >= 0.5).mean() <= 0.04 and (scores[labels == 1] >= 0.5).mean() > 0.88


def test_changed_insults_in_a_plain_sentence(spark):
    """Of the ten English words that tell most, changed in the middle of a sentence, and of none in a plain one."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    learn = docs.where("crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0").join(labels.select("doc_id", "toxic"), "doc_id")
    words = "trash pathetic worthless idiot disgusting loser scum moron clown stupid".split()
    scores = toxicity.WordScores(toxicity.fit(learn))
    found = lambda change: sum(s >= 0.5 for s in scores.scores([f"the weather near the river {change(w)} is fine today" for w in words]))
    half = lambda w: len(w) // 2
    assert found(lambda w: w) == 10 and found(lambda w: "bridge") == 0
    assert found(lambda w: w[: half(w)] + "x" + w[half(w) :]) >= 7
    assert found(lambda w: w[: half(w)] + " " + w[half(w) :]) >= 8
    assert found(lambda w: w[: half(w)] + w[half(w)] + w[half(w) :]) >= 9
    assert found(lambda w: w[: half(w)] + w[half(w) + 1 :]) >= 7


@pytest.fixture(scope="module")
def insults():
    rows = [(f"{a} and {b}. you are an early bird they said.", 0) for a in CLEAN for b in CLEAN] * 2
    rows += [(f"{a}. you are an {x} they said. {b}", 1) for a in CLEAN[:3] for b in CLEAN[3:] for x in ("idiot", "moron")]
    return toxicity.fit_rows(rows)


@pytest.mark.parametrize("word", ["idiot", "IDIOT!", "i.d.i.o.t", "id-iot", "idiiot", "i d i o t", "m*oron", "idxiot", "mozron", "id iot", "mor on", "idot"])
def test_gapped_and_inserted_characters(insults, word):
    plain, insult = toxicity.WordScores(insults).scores([CLEAN[0], f"the {word} is at home"])
    assert insult > 0.5 > plain


def test_machine_minimizes_the_loss_over_every_negative():
    """The gradient of the whole loss, inactive strings included, is zero in the kernel space."""
    letters = "bcdfghjklmnprstvwz"
    negatives = sorted({f"{a}{v}{b}{w}{c}" for a in letters for v in "ae" for b in letters[:9] for w in "ao" for c in letters[:3]})
    positives = [("idiot", 0.5), ("moron", 0.3), ("idiiot", 0.2)]
    landmarks = ["idiot", "moron", *negatives[::200]]
    model = toxicity.fit_machine(positives, negatives, 0.002, landmarks, 0.1)
    values, vectors = np.linalg.eigh(toxicity.kernel(landmarks, landmarks))
    root = vectors[:, values > 1e-6] / np.sqrt(values[values > 1e-6])
    strings = [w for w, _ in positives] + negatives
    y = np.array([1.0] * 3 + [-1.0] * len(negatives))
    cost = np.array([c for _, c in positives] + [0.002] * len(negatives))
    x = np.column_stack([toxicity.kernel(strings, landmarks) @ root, np.ones(len(strings))])
    w = np.linalg.lstsq(x, model.margins(strings), rcond=None)[0]
    assert np.allclose(x @ w, model.margins(strings), atol=1e-3)
    slack = np.maximum(0, 1 - y * (x @ w))
    slope = np.concatenate([toxicity.PENALTY * w[:-1], [0]]) - x.T @ (cost * slack * y)
    assert np.abs(slope).max() < 1e-3


def test_kernel_is_the_subsequence_kernel():
    words = ["cat", "caat", "dog", "concatenate"]
    k = toxicity.kernel(words, words)
    feats = []
    for w in words:
        chars = [0, *toxicity.char_class(np.array([ord(c) for c in w])).tolist(), 63]
        f = {}
        for i in range(len(chars)):
            for a, b in toxicity.GAPS:
                if i + b < len(chars):
                    g = (chars[i], chars[i + a], chars[i + b])
                    f[g] = f.get(g, 0) + toxicity.DECAY ** (b - 2)
        feats.append(f)
    dot = lambda a, b: sum(v * b.get(g, 0) for g, v in a.items())
    size = lambda w: sum(toxicity.DECAY ** (2 * (b - 2)) * max(0, len(w) + 2 - b) for _, b in toxicity.GAPS)
    want = [[dot(a, b) / np.sqrt(size(v) * size(w)) for b, w in zip(feats, words, strict=True)] for a, v in zip(feats, words, strict=True)]
    assert np.allclose(k, want, atol=1e-6)


def test_toxicity_edge_cases(docs_of, odd_texts, labels_of, insults):
    docs = docs_of(odd_texts).withColumnRenamed("lang", "score")
    rows = toxicity.score_toxicity(docs, insults, ["doc_id"]).collect()
    assert len(rows) == len(odd_texts) and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score_toxicity(docs_of([]), insults, ["doc_id"]).collect() == []
    nothing = toxicity.fit(docs_of([]).join(labels_of([]), "doc_id"))
    one = toxicity.fit(docs_of([(1, "fine"), (2, None)]).join(labels_of([(1, 0), (2, 1)]), "doc_id"))
    for model in (nothing, one):
        assert all(r["score"] < 0.5 for r in toxicity.score_toxicity(docs_of(odd_texts), model, ["doc_id"]).collect())


def test_scores_are_those_of_the_most_toxic_window(insults):
    """Every window's margin summed subsequence by subsequence, as the docstring says."""

    def margin(word):
        chars = [0, *toxicity.char_class(np.array([ord(c) for c in word])).tolist(), 63]
        total, size = 0.0, 0.0
        for i, j in toxicity.GAPS:
            for at in range(len(chars) - j):
                total += toxicity.DECAY ** (j - 2) * insults.table[chars[at] << 12 | chars[at + i] << 6 | chars[at + j]]
                size += toxicity.DECAY ** (2 * (j - 2))
        return insults.bias + total / np.sqrt(size)

    for text in [*CLEAN, "you id iot", "an i d i o t!", "the-moron " * 3, "a" * 90, "x"]:
        windows = {r for w in toxicity.candidates(text) for r in toxicity.readings(w)}
        best = max(map(margin, windows))
        want = 1 / (1 + np.exp(-np.clip(insults.slope * best + insults.shift, -30, 30)))
        assert toxicity.WordScores(insults).scores([text])[0] == pytest.approx(want, abs=1e-4)
    assert toxicity.WordScores(insults).scores(["", "..."]) == [insults.base] * 2


def test_language_is_learnt_from_every_row(docs_of):
    """More rows than a sample would have: weights, the one centroid and the limits are those of all of them."""
    rng = np.random.default_rng(1)
    words = {"en": "the river bread house walk".split(), "de": "der fluss brot haus gehen und".split()}
    rows = [(i, " ".join(rng.choice(words[n], 4)) + f" {chr(97 + i % 26) * 2}", n) for i, n in enumerate(["en"] * 1100 + ["de"] * 150)]
    model = language_id.fit(docs_of(rows), centroids=1)
    counts = np.stack([language_id.gram_counts(t.encode()) for _, t, _ in rows])
    weights = np.log((len(rows) + 1) / ((counts > 0).sum(axis=0) + 1)) + 0.05
    assert np.allclose(model.weights, weights)
    vectors = language_id.unit(counts * weights)
    lang = np.array([r[2] for r in rows])
    for i, name in enumerate(model.languages):
        assert np.allclose(model.centroids[i], language_id.unit(vectors[lang == name].mean(axis=0)), atol=1e-5)
    found = language_id.calibrated(docs_of(rows), model, "text", "lang", 0.0)
    near = {name: np.concatenate([model.nearness(language_id.passages(t.encode()), name)[2] for _, t, n in rows if n == name]) for name in words}
    lengths = np.concatenate([model.nearness(language_id.passages(t.encode()), "en")[1] for _, t, n in rows if n == "en"])
    k = int(np.bincount(lengths).argmax())
    limit = np.sort(near["en"][lengths == k])[int(language_id.REJECT_QUANTILE * ((lengths == k).sum() - 1))]
    assert abs(found[model.languages.index("en"), k] - limit) <= 2 / language_id.BINS
    assert np.array_equal(found, model.reject_below) or np.array_equal(found[found > 0], model.reject_below[found > 0])


def test_language_clusters_are_settled(docs_of):
    """Centroids are the means of the vectors nearest to them."""
    rows = [(i, f"{a} {b}", "en") for i, (a, b) in enumerate((a, b) for a in CLEAN for b in CLEAN)]
    model = language_id.fit(docs_of(rows))
    vectors = language_id.unit((np.stack([language_id.gram_counts(t.encode()) for _, t, _ in rows]) * model.weights).astype(np.float32))
    own = (vectors @ model.centroids.T).argmax(axis=1)
    assert len(model.centroids) == language_id.CENTROIDS == len(set(own))
    for c in range(len(model.centroids)):
        assert np.allclose(language_id.unit(vectors[own == c].mean(axis=0)), model.centroids[c], atol=1e-4)


def test_language_is_that_of_the_nearest_centroid(docs_of):
    """Cosines, centroids and limits by plain loops over n-grams."""
    texts = {"en": CLEAN, "de": ["der hund und die katze", "ein brot und milch", "das wetter ist heute gut", "wir gehen an den fluss"]}
    learn = docs_of([(i, t, name) for i, (name, t) in enumerate((n, t) for n, ts in texts.items() for t in ts)])
    model = language_id.fit(learn)

    def vector(text):
        chars = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
        v = np.zeros(language_id.BUCKETS)
        for n in (1, 2, 3):
            for i in range(len(chars) - n + 1):
                if n == 1 and chars[i] == " ":
                    continue
                code = ord(chars[i]) * 0x9E3779B1 % 2**32
                if n > 1:
                    code = (code ^ ord(chars[i + 1])) * 0x85EBCA6B % 2**32
                if n > 2:
                    code = (code ^ ord(chars[i + 2])) * 0xC2B2AE35 % 2**32
                v[code >> 32 - language_id.BUCKET_BITS] += 1
        return v

    for text in ["the dog and the cat", "milch und brot", "heute an home", "Xylophon QUIZ"]:
        counts = vector(text)
        weighed = counts * model.weights
        cosines = [float(weighed @ c) / (np.linalg.norm(weighed) * np.linalg.norm(c)) for c in model.centroids]
        best = int(np.argmax(cosines))
        limit = model.reject_below[best][int(np.log2(counts.sum()))]
        name, score, rejected = (x[0] for x in model.predict([text.encode()]))
        assert name == model.languages[model.owners[best]] and score == pytest.approx(cosines[best], abs=1e-5)
        assert rejected == (cosines[best] < limit)


def test_passages_are_counted_from_one_look_at_the_letters():
    """Also where lower-casing depends on the neighbours or lengthens the text; cosines are those of dense rows."""
    texts = ["Plain words, 12 of them -- and more. " * 40, "ΟΔΟΣ ΟΔΟΣ, σας ΣΑΣ " * 30, "İstanbul İzmir çok güzel " * 30, "𝒜bc déf 😀 " * 50, "a", "12", ""]
    for text in (t.encode() for t in texts):
        got, want = language_id.passage_codes(text), language_id.passages(text)
        assert len(got) == len(want) == len(language_id.places(text, len(text.decode()))) + 1
        for codes, passage in zip(got, want, strict=True):
            assert (np.bincount(codes, minlength=language_id.BUCKETS) == language_id.gram_counts(passage)).all()
    counts = np.stack([language_id.gram_counts(t.encode()) for t in texts[:4]])
    rows, at = np.nonzero(counts)
    vectors = language_id.Vectors(np.bincount(rows), at, counts[rows, at].astype(np.float32))
    dense = language_id.unit(counts.astype(np.float32))
    assert np.array_equal(vectors.dense(), dense)
    centers = [dense[:1], dense[1:4]]
    place, cosine = vectors.nearest(vectors.scaled(), np.array([0, 1, 1, 0]), *language_id.side_by_side(centers))
    assert place.tolist() == [0, 0, 1, 0] and np.allclose(cosine, [1, 1, 1, dense[3] @ dense[0]], atol=1e-5)
