"""The stages one after the other, each against a plain computation on its input."""

from pathlib import Path

import __spark_entry__ as entry_points
import corpus_pipeline
import pytest
from paddock.llm import decontaminate, secrets, simhash

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    bench = [decontaminate.words(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == columns
        docs = docs.checkpoint()
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= set(before)
        if name == "toxicity":
            assert len(after) > 0.7 * len(before)
        if name == "simhash":
            prints = {i: simhash.fingerprint(r.text) for i, r in before.items()}
            gone = set(before) - set(after)
            assert all(any((prints[i] ^ prints[j]).bit_count() <= 3 for j in before if j != i) for i in gone)
            left = sorted(after)
            assert not any((prints[i] ^ prints[j]).bit_count() <= 3 for i in left for j in left if j < i)
        if name == "decontamination":
            inside = lambda item, words: any(words[k : k + len(item)] == item for k in range(len(words)))
            dirty = {i for i, r in before.items() if any(inside(b, decontaminate.words(r.text)) for b in bench)}
            assert dirty and not dirty & set(after)
            assert len(set(before) - set(after) - dirty) <= 2  # items with a changed word
        if name == "secrets":
            assert set(after) == set(before)
            scan = secrets.scanner(secrets.RULES).scan
            for i, r in after.items():
                spans = scan([before[i].text.encode()])[0]
                assert r.text == (secrets._replaced(before[i].text, spans, "[SECRET]") if spans else before[i].text)
                assert r.n_chars == len(r.text)
        before = after
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert {r.doc_id for r in last.collect()} == set(before)


def test_registered():
    names = set(entry_points.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 11)}
    assert "pipeline" in names and [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "decontamination", "secrets", "bpe"]


@pytest.fixture
def small(spark, tmp_path):
    """A folder of tables with odd documents and extra columns, and an empty one."""
    odd = [None, "", " \t", "é ß Ω", "password = \"hunter2hunter2\"", "word " * 3000, "word " * 3000, "日本語 テキスト", "you and me"]
    rows = [(i, t, "en", "s", None if t is None else len(t), "x", i) for i, t in enumerate(odd)]
    rows += [rows[4], (None, "no id", "en", "s", 5, "x", 0), (3, "again", "en", "s", 5, "x", 0)]
    columns = "doc_id long, text string, lang string, source string, n_chars long, spans string, score long"
    item = "the first second third fourth fifth words of an item"
    rows.append((50, f"before {item} behind", "en", "s", 60, "x", 1))

    def build(name, documents):
        folder = tmp_path / name
        spark.createDataFrame(documents, columns).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(i, 1, i % 2) for i in range(9)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        return str(folder)

    return build, rows


def test_odd_documents_and_clashing_names(spark, small):
    build, rows = small
    folder = build("odd", rows)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[1:-1]:  # the labels say nothing about toxic texts
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        docs = docs.checkpoint()
    kept = [(r.doc_id, r.text) for r in docs.collect()]
    assert 50 not in {i for i, _ in kept} and len({t for _, t in kept if t}) == len([t for _, t in kept if t])
    assert not any("hunter2hunter2" in (t or "") for _, t in kept)
    assert corpus_pipeline.run(spark, folder).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_empty_table(spark, small):
    build, _ = small
    folder = build("empty", [])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0
    assert corpus_pipeline.run(spark, folder).count() == 0
