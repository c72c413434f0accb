import random
from collections import Counter

from pyspark.sql import functions as F

from squall.llm import langid, queries

DATA = "/root/testdata/sf0.01"


def brute_counts(text):
    words = "".join(c if langid._letters()[ord(c)] else " " for c in (text or "").lower()).split()
    out = Counter()
    for w in words:
        p = f" {w} "
        out.update(w)
        out.update(p[i:i + 2] for i in range(len(p) - 1))
        out.update(p[i:i + 3] for i in range(len(p) - 2))
    return out


def test_ngrams_match_brute_force():
    for text in (None, "", "123 !!", "a", "ab", "Été, l'été 2 fois!", "x1y  zz\n\nzz"):
        g, c = langid.ngram_counts(text)
        want = brute_counts(text)
        assert sum(c.tolist()) == sum(want.values()), text
        assert sorted(c.tolist()) == sorted(want.values())


def test_out_of_place_distance():
    g, c = langid.ngram_counts("abab cab")
    own = langid.top(g, c, 50)
    p = langid.Profiles({"same": own.tolist(), "other": [int(x) for x in langid.top(*langid.ngram_counts("zzz yyy"), 50)]}, 50)
    assert p.guess("abab cab") == ("same", 1.0)
    assert p.guess(None) == p.guess("12 ..") == ("und", 0.0)
    name, score = p.guess("zzz")
    assert name == "other" and 0 < score < 1


def test_held_out_accuracy_and_columns(spark):
    out = queries.op2_language_id(spark, DATA)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang")
    both = out.join(docs, "doc_id").where("held_out")
    right, n = both.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 150 and right / n > 0.97
    assert out.where("score < 0 or score > 1 or lang_pred is null").count() == 0


def test_defined_cases(spark, documents):
    rows = [(1, "the cat and the dog", "en"), (2, "el gato y el perro", "es"), (3, None, "en"), (4, "the bird", None), (None, "la casa", "es"), (1, "the cat and the dog", "en")]
    docs = documents(rows)
    profiles = langid.train(docs)
    got = [tuple(r["g"]) for r in docs.select(langid.predictor(profiles).alias("g")).collect()]
    assert got[2] == ("und", 0.0) and got[0][0] == "en" and got[1][0] == "es" and len(got) == 6
    none = langid.train(docs.where("false"))
    assert {r["g"]["lang_pred"] for r in docs.select(langid.predictor(none).alias("g")).collect()} == {"und"}
    assert docs.where("false").select(langid.predictor(profiles)).count() == 0


def test_languages_in_blocks_give_the_answer_of_one_block(spark, documents):
    g = random.Random(11)
    alphabet = "abcdefghijklmnopqrstuvwxyzäöüßéèñçåø"
    own = {f"l{k:02d}": g.sample(alphabet, 9) for k in range(23)}

    def text(lang, n):
        return " ".join("".join(g.choice(own[lang]) for _ in range(g.randint(2, 7))) for _ in range(n))

    rows = [(100 * k + i, text(lang, g.randint(1, 30)), lang) for k, lang in enumerate(own) for i in range(12)]
    rows += [(9001, None, "l03"), (9002, "", "l04"), (9003, "12 !", None), (9004, "zz", None), (9005, "q", None)]
    docs = documents(rows)
    one, many = langid.train(docs), langid.train(docs, block=4)
    assert len(one) == 1 and len(many) > 5 and sorted(n for p in many for n in p.names) == sorted(own)

    def guesses(blocks):
        return {r["doc_id"]: tuple(r["g"]) for r in docs.select("doc_id", langid.predictor(blocks).alias("g")).collect()}

    first = guesses(one)
    assert guesses(many) == first == {d: one[0].guess(t) for d, t, _ in rows}
    assert first[9001] == first[9002] == first[9003] == ("und", 0.0)
