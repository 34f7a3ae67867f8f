from pyspark.sql import functions as F

from codexlake.operators import assist


def test_cascade_asks_the_uncertain(spark):
    rows = [("A", "one", "UNCERTAIN", 0.5), ("A", "one", "UNCERTAIN", 0.5), ("B", "two", "MENTION", 0.7), ("C", "x", "ARTICLE_START", 0.9)]
    c = spark.createDataFrame(rows, "headword string, context string, label string, confidence double")
    model = lambda prompts: ["ARTICLE_START\nbecause" if "article A" in p else "no idea" for p in prompts]
    got = sorted((r.headword, r.label, r.confidence) for r in assist.cascade(c, model).collect())
    assert got == [("A", "ARTICLE_START", 0.9), ("A", "ARTICLE_START", 0.9), ("B", "UNCERTAIN", 0.5), ("C", "ARTICLE_START", 0.9)]
    assert sum(r.confidence == 0.9 for r in assist.cascade(c, model, budget=0).collect()) == 1
    assert assist.cascade(c).collect() == c.collect()


def test_sections_from_answers(spark):
    text = "intro " * 200 + "Of the eye and its parts, " + "x" * 900 + "Of light, " + "y" * 100
    answer = 'Sure: [{"title": "Eye", "starts_with": "Of the eye and its parts", "marker": null, "level": 1}, {"title": "Light", "starts_with": null, "marker": "Of light, yyy", "level": 2}] done'
    df = spark.createDataFrame([(text, answer)], "text string, answer string").withColumn("s", assist.answered_sections(F.col("answer")))
    got = df.select(F.transform("s", lambda s: assist.locate(F.col("text"), s)).alias("p")).first().p
    assert got == [1200, 1200 + 26 + 900]
    assert df.select(assist.spaced(F.array(F.lit(900), F.lit(0), F.lit(100), F.lit(1300), F.lit(1500))).alias("p")).first().p == [0, 900, 1500]


def test_samples(spark):
    df = spark.createDataFrame([("a" * 31000,), ("b" * 40000,)], "text string")
    got = [[s.start for s in r.s] for r in df.select(assist.samples(F.col("text")).alias("s")).collect()]
    assert got == [[0, 15000, 30000], [0, 15000, 30000, 37000]]
