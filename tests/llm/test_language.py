import random
import tracemalloc

from shelfstack.llm import language

WORDS = {"aa": "walo mipe tuko rana besi", "bb": "schrung kratz pfleng dorst wicht", "cc": "éàlo ùmbré çatèl ôniré"}


def documents(spark, n=90):
    rows = []
    for i in range(n):
        lang = ("aa", "bb", "cc")[i % 3]
        vocabulary = WORDS[lang].split()
        rows.append((i, " ".join(vocabulary[(i * j + j) % len(vocabulary)] for j in range(3, 40)), lang, 1.5))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")


def test_names_the_language_and_does_not_look_at_labels(spark):
    docs = documents(spark)
    model = language.fit(docs.where("doc_id < 60"))
    got = language.identify(docs.drop("score"), model).collect()
    assert all(r.lang == r.lang_pred and 0 < r.score <= 1 and not r.rejected for r in got)
    wrong = docs.drop("score").selectExpr("doc_id", "text", "'bb' AS lang")
    assert {r.doc_id: r.lang_pred for r in language.identify(wrong, model).collect()} == {r.doc_id: r.lang_pred for r in got}


def test_odd_rows(spark):
    model = language.fit(documents(spark))
    rows = [(1, None), (2, ""), (3, "12 -- 34\n"), (4, "walo mipe " * 50_000), (5, "walo tuko"), (5, "walo tuko"), (None, "漢字漢字" * 20),
            (6, "İstanbul walo"), (7, "İ" * 5), (8, "😀 12 ♥")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS lang_pred", "doc_id AS score")
    got = language.identify(docs, model, "doc_id").collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 and by[i].rejected for i in (1, 2, 3, 8))
    assert by[4].lang_pred == by[5].lang_pred == "aa"
    assert by[None].rejected  # other letters than any fitted text
    assert language.identify(docs.limit(0), model, "doc_id").count() == 0


def test_empty_model(spark):
    model = language.fit(spark.createDataFrame([(1, None, "aa"), (2, "walo", None)], "doc_id long, text string, lang string"))
    got = language.identify(documents(spark, 3), model, "doc_id").collect()
    assert {(r.lang_pred, r.score, r.rejected) for r in got} == {("und", 0.0, True)}


def test_rows_do_not_leak_into_each_other():
    texts = ["abc", None, "İx", "", "de"]
    counts, letters = language.trigram_counts(texts)
    for i, t in enumerate(texts):
        alone, n = language.trigram_counts([t])
        assert (alone[0] == counts[i]).all() and n[0] == letters[i]


def test_long_texts_far_from_every_language_go_and_clean_ones_stay(spark):
    rng = random.Random(1)
    syllables = {lang: [a + b for a in first for b in second] for lang, first, second in (
        ("aa", ("w", "l", "m", "t", "k", "r"), "aeiou"), ("bb", ("sch", "kr", "pfl", "d", "w", "st"), ("un", "atz", "eng", "ors", "icht")))}
    unlearned = [a + b for a in ("zh", "g", "v", "q", "dz", "ny") for b in ("ya", "yu", "oi", "ei", "y")]
    text = lambda parts, n: " ".join("".join(rng.choices(parts, k=rng.randint(2, 4))) for _ in range(n))
    rows = [(i, text(syllables[lang], rng.randint(20, 400)), lang) for i, lang in enumerate(["aa", "bb"] * 150)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    letters = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz      ", k=n))
    rows = [(i, text(syllables[lang], n)) for i, (lang, n) in enumerate((lang, n) for lang in syllables for n in (5, 20, 400, 3000) for _ in range(10))]
    rows += [(1000 + i, text(unlearned, n)) for i, n in enumerate((200, 1000, 5000))] + [(2000 + i, letters(n)) for i, n in enumerate((2000, 20_000, 200_000))]
    got = language.identify(spark.createDataFrame(rows, "doc_id long, text string"), model, "doc_id").collect()
    assert {r.doc_id for r in got if r.rejected} == {r[0] for r in rows if r[0] >= 1000}


def test_the_driver_holds_no_whole_vectors_of_the_sample(spark):
    rng = random.Random(11)
    rows = [(i, " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(30)), "xx") for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    tracemalloc.start()
    model = language.fit(docs)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert model.centroids.shape == (language.CENTROIDS, language.BINS)
    assert peak < 700 * language.BINS * 4  # the vectors of the sample, without copies of them
