import re
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from signalloom.functions import extract, keys, lexicon, pages, text
from signalloom.functions import vocabulary as v


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'timestamp' if isinstance(x, datetime) else 'string'}" for k, x in values.items()))
    return df.select(column.alias("x")).first().x


AMOUNTS = [
    ("The works cost $12.5 million in all", 12.5e6), ("a US$1.2 billion plan", 1.2e9), ("3,400 millones de dólares", 3.4e9), ("2 mil millones USD", 2e9), ("5 million dollars and $7 million", 7e6),
    ("paid $1,250,000 in May", 1.25e6), ("paid $4500.75", 4500.75), ("€5 million", None), ("£9 million", None), ("7 million people", None), ("$250", None), ("", None), (None, None), ("$2B", None),
]


@pytest.mark.parametrize(("said", "amount"), AMOUNTS)
def test_amounts(spark, said, amount):
    assert one(spark, extract.headline_amount(F.col("t")), t=said) == amount


@pytest.mark.parametrize(
    ("said", "labels"),
    [
        ("Rockets seen over the bay", ["MILITARY_AEROSPACE"]), ("A second look at the warehouse", []), ("SEC opens inquiry", ["FINANCIAL"]), ("Sequía y apagón", ["ENVIRONMENTAL"]),
        ("sanctions after the election", ["FINANCIAL", "POLITICAL"]), ("Tsunami and flood, then war", ["GEO_GEOLOGY", "ENVIRONMENTAL", "POLITICAL"]), (None, []),
    ],
)
def test_labels(spark, said, labels):
    assert one(spark, lexicon.tags(F.col("t"), v.DOMAINS), t=said) == labels


def test_tags_flags_agencies_stages(spark):
    said = "Aviso: hervir el agua en el embalse; PRASA y la Guardia Nacional"
    assert one(spark, lexicon.tags(F.col("t"), v.WATER_TAGS), t=said) == ["potable_water", "boil_water", "reservoir_drought"]
    assert one(spark, lexicon.is_critical(F.col("t")), t=said) is True
    assert one(spark, lexicon.is_critical(F.col("t")), t="a calm day") is False
    assert one(spark, lexicon.agencies(F.col("t")), t=said) == ["Puerto Rico National Guard", "PRASA"]
    assert one(spark, extract.stage(F.col("t")), t="Adjudicación tras la subasta") == "award_announced"
    assert one(spark, extract.stage(F.col("t")), t="new RFP") == "rfp_open"
    assert one(spark, extract.beat(F.col("t")), t="contrato firmado") == "procurement" and one(spark, extract.beat(F.col("t")), t="contracts") is None


@pytest.mark.parametrize(
    ("title", "body", "source", "names"),
    [
        ("Norte Build gets contract", "a contract", "Norte Build", ["Norte Build"]),
        ("news", "Del Sur Group announces its plan. It was awarded to Del Sur Group", "x", ["Del Sur Group"]),
        ("news", "adjudicado a Obras Mar y Sol; 9Works JV", "", ["Obras Mar y Sol", "9Works JV"]),
        ("news", "awarded to FEMA", "", []),
        (None, None, None, []),
    ],
)
def test_recipients(spark, title, body, source, names):
    assert one(spark, extract.recipients(F.col("a"), F.col("b"), F.col("c")), a=title, b=body, c=source) == names


def test_pages(spark):
    html = '<html><head><meta property="og:title" content=" Best "><title>Other</title></head><body><p>out</p><div class="my-article"><p>One <b>bold</b><p>Two &amp; three</div><script>var p="<p>no</p>"</script></body></html>'
    assert tuple(one(spark, pages.page_texts(F.col("h")), h=html)) == ("Best", "One bold Two & three")
    assert tuple(one(spark, pages.page_texts(F.col("h")), h="<title> T </title><p>a</p><p>b</p>")) == ("T", "a b")
    assert tuple(one(spark, pages.page_texts(F.col("h")), h="")) == ("", "")


def test_text(spark):
    t = F.col("t")
    assert one(spark, text.fold(t), t="ÁRBOL Ñandú ßé́") == "arbol nandu ße"
    assert one(spark, text.fold(t), t="ﬁn ½") == "fin 1⁄2"
    assert one(spark, text.slug(t), t=" Río  Grande -- #2! ") == "rio-grande-2" and one(spark, text.slug(t), t=None) == ""
    assert one(spark, text.strip(t), t=" \t\n a b  \n").strip() == "a b"
    assert one(spark, text.filled(t, F.lit("y")), t="") == "y"
    assert one(spark, text.upper_slug(t, "P-"), t="The Drive: War/Zone!") == "P-THE-DRIVE-WAR-ZONE"
    assert one(spark, text.title_of_id(t, ("P-",)), t="P-THE-DRIVE") == "The Drive" and one(spark, text.title_of_id(t, ("P-",)), t="P-") == "P-"
    assert one(spark, text.truncated(t, 3, "~"), t="abcd") == "abc~" and one(spark, text.truncated(t, 4, "~"), t="abcd") == "abcd"


def test_keys(spark):
    import hashlib

    whole, part = datetime(2026, 1, 2, 3, 4, 5, tzinfo=timezone.utc), datetime(2026, 1, 2, 3, 4, 5, 60, tzinfo=timezone.utc)
    for ts in (whole, part):
        assert one(spark, keys.item_id(F.col("u"), F.col("ts")), u="http://a", ts=ts) == hashlib.sha256(f"http://a|{ts.isoformat()}".encode()).hexdigest()[:16]
    matter = keys.matter_id(F.col("t"), F.col("n"), F.col("d"))
    assert one(spark, matter, t="law", n="Ley de Añasco", d="2026-03-04T00:00") == "PR-LAW-20260304-ley-de-anasco"
    assert one(spark, matter, t=None, n=None, d=None) == "PR-MATTER-undated-untitled"
    assert one(spark, keys.record_key(F.col("m"), F.lit(None).cast("string"), F.lit(""), F.col("t")), m="M1", t="A b") == "M1::official-record::a-b"
    assert one(spark, keys.record_type(F.col("t")), t="audit") == "audit_record" and one(spark, keys.record_type(F.col("t")), t="x") == "contract_record"
    assert [one(spark, keys.band(F.col("s").cast("double")), s=s) for s in ("95", "94.9", "70", "50", "30", "0", None)] == [v.BANDS[i][1] for i in (0, 1, 2, 3, 4, 5, 5)]


def test_terms_tried_by_their_first_character(spark):
    texts = ["boil water", "boils", "a boil-water", "reboil", "#tag here", "x#tag", "e. coli", "e  coli", "rfps", "rfpx", "café rfp", "", "rf", "p rfp"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for terms in (["boil", "boil-water", "rfp"], ["#tag", "e. coli"], ["Café", "request for proposal", "rfp"], ["r", "rf", "rfp"], []):
        for plural in (True, False):
            plain = r"\b(?:" + "|".join(re.escape(lexicon.folded_term(t)) for t in terms) + ")" + ("s?" if plural else "") + r"\b"
            got = rows.select(F.col("t").rlike(lexicon.pattern(terms, plural)).alias("got"), F.col("t").rlike(plain).alias("want")).collect()
            assert [r.got for r in got] == [r.want for r in got], terms


def test_amounts_where_only_a_word_tells_of_dollars(spark):
    assert one(spark, extract.headline_amount(F.col("t")), t="3 millones de dólares") == 3e6
    assert one(spark, extract.headline_amount(F.col("t")), t="2 BILLION USD") == 2e9
    assert one(spark, extract.amounts(F.col("t")), t="3 millones de euros, 12,000") == []
