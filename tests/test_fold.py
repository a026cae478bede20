"""The JVM folds against Python's Unicode data: every character, and random texts."""
import random

from pyspark.sql import functions as F

from quarry.functions import fold as X


def _texts(spark, texts, fn):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    return [r[0] for r in df.select("i", fn(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


def test_every_character(spark):
    points = [*range(1, 0xD800), *range(0xE000, 0x30000), *range(0xE0100, 0xE01F0), 0x10FFFF]
    texts = ["|".join(map(chr, points[i:i + 64])) for i in range(0, len(points), 64)]
    assert _texts(spark, texts, X.fold) == [X.folded_form(t) for t in texts]
    assert _texts(spark, texts, X.fold_to_ascii) == [X.ascii_form(t) for t in texts]


def test_random_texts(spark):
    rng = random.Random(8)
    alphabet = "aZ09 |éÉÀßœ…½ﬁ한글각힣ᄀ́̈Σςİıẞΐ中文か゛ｶﾞ𝐀𝔸𐐀😀ǅ"
    texts = [None, "", *["".join(rng.choices(alphabet, k=rng.randrange(40))) for _ in range(3000)]]
    same = lambda rule: [t if t is None else rule(t) for t in texts]
    assert _texts(spark, texts, X.fold) == same(X.folded_form)
    assert _texts(spark, texts, X.fold_to_ascii) == same(X.ascii_form)


def test_no_python_in_the_plan(spark):
    from quarry.functions.keys import canonical_key
    from quarry.functions.text import fold_text
    df = spark.createDataFrame([("é",)], "x string")
    plan = df.select(fold_text("x"), canonical_key(F.col("x")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
