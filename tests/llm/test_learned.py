import random
import zlib

import numpy as np
import pytest

from boardlake.llm import language, toxicity


def crc(i, n):
    return zlib.crc32(str(i).encode()) % n


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(8)
    vocab = ["".join(rng.choice("bcdfgaeiou") for _ in range(5)) for _ in range(300)]
    bad = ["grubby", "vile", "nasty"]
    docs, labels = [], []
    for i in range(900):
        words = [rng.choice(vocab) for _ in range(rng.randint(20, 60))]
        toxic = i % 5 == 0
        if toxic:
            for w in bad:
                words.insert(rng.randrange(len(words)), w.upper() + "!")
        docs.append((i, " ".join(words)))
        if i % 3 == 0:
            labels.append((i, int(toxic)))
    docs += [(1000, None), (1001, ""), (None, "vile"), docs[4], docs[4]]
    labels += [(None, 1), (1000, 1), (5000, 0), (3, None)]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as score", "2 as y", "3 as rank")
    return d, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_on_held_out_rows(labelled):
    docs, labels = labelled
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == docs.count()
    assert {r.predicted for r in got} == {0, 1}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    known = [r for r in got if r.doc_id is not None and r.doc_id < 900]
    assert all(r.held_out == (crc(r.doc_id, 3) == 1) for r in known)
    held = [r for r in known if r.held_out]
    right = sum(r.predicted == int(r.doc_id % 5 == 0) for r in held) / len(held)
    assert right > 0.95
    again = toxicity.toxicity(docs, labels).collect()
    key = lambda r: (str(r.doc_id), r.score)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_toxicity_without_labels(spark, labelled, empty):
    docs, labels = labelled
    model = toxicity.train(docs, labels.where("false"))
    assert [r.score for r in toxicity.score(docs, model).limit(3).collect()] == [0.5] * 3
    assert toxicity.toxicity(empty, labels).count() == 0


def test_ftrl_is_sparse():
    rng = np.random.default_rng(1)
    rows = []
    for i in range(600):
        x = np.unique(rng.integers(100, 4000, 60))
        rows.append((i % 2, np.append(np.array([7] if i % 2 else [], np.int64), x)))
    w = toxicity.ftrl(rows, alpha=1.0, beta=1.0, l1=6.0, l2=0.0, epochs=5, min_texts=3)
    assert w[7] > 1 and len(w) < 400


def plain_ftrl(rows, alpha, beta, l1, l2, epochs):
    """FTRL-proximal one coordinate at a time; the bias has no L1."""
    z, n = {}, {}

    def weight(k):
        if k == "bias":
            return -z.get(k, 0.0) / ((beta + n.get(k, 0.0) ** 0.5) / alpha + l2)
        if abs(z.get(k, 0.0)) <= l1:
            return 0.0
        return -(z[k] - (l1 if z[k] > 0 else -l1)) / ((beta + n[k] ** 0.5) / alpha + l2)

    for _ in range(epochs):
        for y, x in rows:
            keys = ["bias", *x.tolist()]
            w = {k: weight(k) for k in keys}
            g = 1 / (1 + np.exp(-sum(w.values()))) - y
            for k in keys:
                old = n.get(k, 0.0)
                sigma = ((old + g * g) ** 0.5 - old**0.5) / alpha
                z[k] = z.get(k, 0.0) + g - sigma * w[k]
                n[k] = old + g * g
    return {k: weight(k) for k in z if k == "bias" or weight(k)}


@pytest.mark.parametrize(("alpha", "l1", "l2"), [(1.0, 0.0, 0.0), (0.5, 0.3, 0.0), (2.0, 1.0, 0.1)])
def test_ftrl_equals_plain_loops(alpha, l1, l2):
    rng = np.random.default_rng(2)
    rows = [(int(rng.random() < 0.4), np.unique(rng.integers(1, 15, 5))) for _ in range(40)]
    got = toxicity.ftrl(rows, alpha=alpha, beta=1.0, l1=l1, l2=l2, epochs=3, min_texts=1)
    want = plain_ftrl(rows, alpha, 1.0, l1, l2, 3)
    assert set(got) - {toxicity.BIAS} == set(want) - {"bias"}
    assert all(np.isclose(v, want["bias" if k == toxicity.BIAS else k]) for k, v in got.items())


def brute_marginals(emit, trans):
    a, e = np.exp(trans), np.exp(emit)
    f, b = [np.full(emit.shape[1], 1 / emit.shape[1])], [np.ones(emit.shape[1])]
    for x in e:
        y = (f[-1] @ a) * x
        f.append(y / y.sum())
    for x in e[:0:-1]:
        y = a @ (x * b[-1])
        b.append(y / y.sum())
    g = np.array(f[1:]) * np.array(b[::-1])
    return g / g.sum(1, keepdims=True)


def test_marginals_across_blocks():
    rng = np.random.default_rng(0)
    sizes = [5, 130, 64, 65, 1]
    emit, trans = rng.normal(size=(sum(sizes), 3)), rng.normal(size=(3, 3))
    doc = np.repeat([0, 2, 3, 7, 9], sizes)
    got = language.marginals(emit, doc, trans)
    for d in set(doc):
        assert np.allclose(got[doc == d], brute_marginals(emit[doc == d], trans))


@pytest.fixture(scope="module")
def tongues(spark):
    rng = random.Random(9)
    parts = {"aa": ["tion", "ing", "the", "wh", "er"], "bb": ["sch", "ung", "ei", "ß", "pf"], "cc": ["ción", "os", "ll", "ñ", "ra"]}
    rows = []
    for i in range(240):
        lang = rng.choice(sorted(parts))
        words = ["".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(3, 150))]
        rows.append((i, " ".join(words).capitalize() + ".", lang))
    rows += [(900, None, "aa"), (901, "", "bb"), (902, "12 34 !! …", "cc"), (903, "schung", None), (None, "losción", "cc"), rows[0], rows[0]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 as score", "2 as rank")


def test_language_on_held_out_rows(tongues):
    got = {r.doc_id: r for r in language.language(tongues).collect()}
    truth = {r.doc_id: r.lang for r in tongues.collect()}
    held = [i for i in range(240) if crc(i, 5) == 0]
    assert held and all(got[i].held_out for i in held)
    assert sum(got[i].lang_pred == truth[i] for i in held) / len(held) > 0.97
    assert [got[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3
    assert got[903].lang_pred == "bb" and 0 <= got[903].score <= 1


def test_code_switched_words(tongues):
    model = language.train(tongues)
    got = language.label_words("thetioning whering schungei pfeiung cióncios llosra", model)
    assert [x[1] for x in got] == ["aa", "aa", "bb", "bb", "cc", "cc"]


def test_null_texts_and_copies_take_no_place_in_the_sample(spark, tongues):
    """Nine in ten rows of a language without text, and one row in very many copies."""
    some = tongues.select("doc_id", "text", "lang").where("text is not null and doc_id is not null")
    nulls = spark.range(3000).selectExpr("id + 10000 as doc_id", "cast(null as string) as text", "'bb' as lang")
    copies = spark.range(2000).selectExpr("cast(77777 as long) as doc_id", "'thetion wher' as text", "'aa' as lang")
    model = language.train(some.unionByName(nulls).unionByName(copies), per_lang=40)
    assert model.langs == ["aa", "bb", "cc"]
    got = language.label_words("thetioning whering schungei pfeiung cióncios llosra", model)
    assert [x[1] for x in got] == ["aa", "aa", "bb", "bb", "cc", "cc"]


def test_number_of_languages_is_bounded(tongues):
    model = language.train(tongues, max_langs=2)
    assert len(model.langs) == 2


def test_the_sample_does_not_depend_on_the_order_of_rows(spark):
    rows = [(i % 9, f"{w} und {w}", lang) for i, (w, lang) in enumerate([("haus", "de"), ("the", "en"), ("schön", "de"), ("house", "en")] * 9)]
    models = [language.train(spark.createDataFrame(r, "doc_id long, text string, lang string"), per_lang=3) for r in (rows, rows[::-1])]
    assert all(np.array_equal(getattr(models[0], k), getattr(models[1], k)) for k in ("emit", "trans", "lexicon"))


def test_words_of_joined_passages(tongues):
    """Runs of five words of held-out texts in turn: words are labelled, not the whole."""
    model = language.train(tongues.where("doc_id < 180"))
    held = {}
    for r in tongues.where("doc_id >= 180 and doc_id < 240").collect():
        held.setdefault(r.lang, []).extend(r.text.strip(".").lower().split())
    right = total = 0
    for k in range(40):
        truth, words = [], []
        for lang in ("aa", "bb", "cc", "aa"):
            own = held[lang][5 * k : 5 * k + 5]
            words += own
            truth += [lang] * len(own)
        got = [x[1] for x in language.label_words(" ".join(words), model)]
        assert len(got) == len(truth)
        right += sum(a == b for a, b in zip(got, truth, strict=True))
        total += len(truth)
    assert total > 400 and right / total > 0.95, right / total


def test_language_without_training_rows(spark, empty, tongues):
    assert language.train(empty) is None
    assert language.language(empty).count() == 0
    none = tongues.withColumn("lang", tongues.lang.substr(100, 1).try_cast("int").cast("string"))
    assert {r.lang_pred for r in language.language(none).collect()} == {"und"}
