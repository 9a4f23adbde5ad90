import random
import re

import pytest

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = {"en": "the ing and tion of re".split(), "de": "der ung sch ein ß zu".split()}


@pytest.fixture(scope="module")
def stages(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        lang = rng.choice(list(SYLLABLES))
        rows.append((i, " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(rng.randint(20, 150))), lang, f"src{i % 3}"))
    passage = "shared " + "".join(rng.choices("abcdefgh ", k=700))
    rows += [(500 + i, rows[i][1] + " " + passage + " " + rows[i + 50][1], "en", "src0") for i in range(5)]
    near = rows[7][1].split(" ")
    rows += [(600 + i, " ".join([*near[: len(near) - 1], f"other{i}"]), rows[7][2], "src1") for i in range(20)]
    rows += [(700, rows[9][1], rows[9][2], "src2"), (701, "123 456 !", "en", "src0"), (702, None, "en", None)]
    docs, out = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], SCHEMA), {}
    for name, f in corpus_pipeline.STAGES:
        out[name] = (docs, f(spark, docs, ""))
        docs = out[name][1].persist()
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns(stages):
    for before, after in list(stages.values())[:-1]:
        assert after.columns == corpus_pipeline.COLUMNS and after.dtypes == before.dtypes


def test_languages(stages):
    before, after = stages["language identification"]
    assert set(ids(before)) - set(ids(after)) == {701, 702}


def test_near_copies(stages):
    before, after = stages["near copies"]
    assert set(ids(before)) - set(ids(after)) == {700, *range(600, 620)}


def test_passages_go_whole(stages):
    _, after = stages["repeated passages"]
    assert not [r.doc_id for r in after.collect() if "shared " in r.text]


def test_mix_and_encoding(stages):
    before, after = stages["mixing"]
    words = lambda df: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in df.collect())
    assert abs(words(after) / words(before) - 1) < 0.05
    _, last = stages["byte-pair encoding"]
    assert ids(last) == ids(after)
    assert all(r.n_tokens == len(r.ids) for r in last.collect())


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, f in corpus_pipeline.STAGES:
        docs = f(spark, docs, "")
    assert docs.collect() == []


def test_run_works_out_each_stage_once(spark, tmp_path, monkeypatch):
    """A stage behind that reads its input twice doesn't have the stages before it work twice."""
    seen = spark.sparkContext.accumulator(0)

    def counted(spark, docs, sf_dir):
        def each(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        return docs.mapInArrow(each, docs.schema)

    twice = lambda spark, docs, sf_dir: docs.join(docs.groupBy("source").count(), "source").select(docs.columns)
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("counted", counted), ("twice", twice), ("again", twice), ("mixing", twice)])
    rows = [(i, f"text {i}", "en", f"src{i % 3}", 6) for i in range(100)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())) == rows
    assert seen.value == 100
