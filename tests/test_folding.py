import random
import unicodedata

from pyspark.sql import functions as F

from signalloom.functions.text import fold

SURROGATES = range(0xD800, 0xE000)


def exact(text):
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).lower()


def check(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", fold(F.col("t")).alias("folded")).collect()
    assert len(rows) == len(texts)
    assert [(r.t, r.folded, exact(r.t)) for r in rows if r.folded != exact(r.t)][:3] == []


def test_every_code_point(spark):
    """All that are assigned; Spark's lower case may know letters that are newer than Python's tables."""
    points = [p for p in range(1, 0x110000) if p not in SURROGATES and unicodedata.category(chr(p)) != "Cn"]
    check(spark, [" ".join(map(chr, points[i : i + 200])) for i in range(0, len(points), 200)])


def test_mixed_texts(spark):
    draw = random.Random(1)
    pools = ["abcXYZ 019-", "áéíÑüßøÅçİ", "ĳŉ½ªº¨ﬁﬀＡＢＣ①㍿㎏ﷺ", "ΑΒΓΣσςάΏᾳ", "가각힣한국어", "がぎｶﾞ日本語", "а́йЁїЖ", "אָבּ", "ä̧̀ ́", "𝚺𝐀𝔸", "\n\t "]
    texts = ["".join(draw.choice(draw.choice(pools)) for _ in range(draw.randint(0, 40))) for _ in range(3000)]
    texts += ["", "plain", "ΟΔΥΣΣΕΥΣ ΣΑΣ", "ΑΣ.", "Σ", "𝚺𝚺", "naïve ﬁancée", "Crème Brûlée — “quoted”"]
    check(spark, texts)


def test_null_stays_null(spark):
    assert spark.sql("SELECT CAST(NULL AS STRING) AS t").select(fold(F.col("t"))).first()[0] is None
