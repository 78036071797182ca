"""The pipeline, stage by stage, against brute force on its own input."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from tests_llm_helpers import classes, prose
from tierloom.llm import secret_cnn


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    """Input and output of every stage, as the pipeline writes and rereads them."""
    root = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(f"{root}/{k}")
        after = spark.read.parquet(f"{root}/{k}")
        out.append((name, docs.toPandas(), after.toPandas()))
        docs = after
    return {name: (before, after) for name, before, after in out}


def test_stage_names_and_columns(stages):
    assert list(stages) == ["toxicity", "simhash_bk", "decontamination", "secrets", "bpe_codec"]
    for before, after in list(stages.values())[:-1]:
        assert list(before.columns) == list(after.columns) == ["doc_id", "text", "lang", "source", "n_chars"]


def shingles(text):
    words = text.encode().lower().split()
    return frozenset(b" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def test_near_duplicates(stages):
    before, after = stages["simhash_bk"]
    sets = {d: shingles(t) for d, t in zip(before.doc_id, before.text, strict=True)}
    want = classes(sets, lambda a, b: sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    assert set(after.doc_id) == set(want.values())


def test_decontamination(stages, spark, sf):
    before, after = stages["decontamination"]
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    held = {d for d, t in zip(before.doc_id, before.text, strict=True) if any(x in t for x in items)}
    assert not held & set(after.doc_id) and len(before) - len(after) <= len(held) + 2


def test_secrets(stages):
    before, after = stages["secrets"]
    old = dict(zip(before.doc_id, before.text, strict=True))
    assert set(after.doc_id) == set(before.doc_id)
    for d, text, n in zip(after.doc_id, after.text, after.n_chars, strict=True):
        assert not secret_cnn.find(text)[0] and n == len(text)
        if not secret_cnn.find(old[d])[0] and "[secret]" not in text:
            assert text == old[d]


def test_encoding(stages):
    before, after = stages["bpe_codec"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = dict(zip(before.doc_id, before.text, strict=True))
    assert {d: n for d, n in zip(after.doc_id, after.n_tokens, strict=True)} == {
        d: len(library.encode(t, add_special_tokens=False).ids) for d, t in texts.items()}


def test_whole_run(spark, sf, stages):
    got = __spark_entry__.queries()["pipeline"](spark, sf).toPandas()
    want = stages["bpe_codec"][1]
    key = ["doc_id"]
    assert got.sort_values(key).reset_index(drop=True).equals(want.sort_values(key).reset_index(drop=True))


def test_odd_rows_pass_every_stage(spark, odd, none, tmp_path_factory):
    root = tmp_path_factory.mktemp("odd")
    items = [(1, " ".join(f"item{i}" for i in range(20))), (2, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    labels = [(i, 1, int(i % 5 == 1)) for i in range(14)] + [(None, None, 1), (3, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    for k, source in enumerate((odd, none)):
        docs = source
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, str(root)).write.parquet(f"{root}/{k}-{i}")
            docs = spark.read.parquet(f"{root}/{k}-{i}")
            if i < len(corpus_pipeline.STAGES) - 1:
                assert docs.columns == odd.columns
        assert docs.count() >= 3 if k == 0 else docs.count() == 0


def test_planted_cases(spark, tmp_path_factory):
    """Toxic, copied and benchmark documents go; the clean ones stay."""
    root, r = str(tmp_path_factory.mktemp("planted")), random.Random(3)
    items = [prose(9000 + i, 40) + f" key{i}" for i in range(5)]
    bad = "idiot moron loser worthless pathetic".split()
    docs, labels = [], []
    for i in range(300):
        words = [*prose(i, 80).split(), f"unique{i}"]
        toxic = i % 3 == 0
        if toxic:
            for _ in range(6):
                words.insert(r.randrange(len(words)), r.choice(bad))
        docs.append((i, " ".join(words)))
        if i < 250:
            labels.append((i, 1, int(toxic)))
    docs += [(1000 + i, docs[i][1]) for i in range(1, 40, 3)]
    docs += [(2000 + i, prose(700 + i, 60) + " " + items[i] + " " + prose(800 + i, 30)) for i in range(5)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    kept = {x.doc_id for x in corpus_pipeline.run(spark, root).collect()}
    assert kept == {i for i in range(300) if i % 3}
