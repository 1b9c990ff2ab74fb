"""The pipeline's stages against plain versions, on a table with planted cases."""

import pytest
from conftest import SF_SMALL
from odd import no_documents, odd_documents, saved

import corpus_pipeline as cp


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    leak = bench.where("text is not null").orderBy("item_id").first().text
    secret = 'token = "0cab398dc11d1a2a11dc6572c8df8bd228c864f3"'
    words = max((r.text for r in docs.where("lang = 'en'").collect()), key=len).split()[100:400]
    group = [" ".join([*words[: 40 * i], "the", *words[40 * i + 1 :]]) for i in range(1, 7)]
    rows = [(10_000 + i, t, "en", "planted", len(t)) for i, t in enumerate(
        [f"some words before {leak} and after", f"prose with {secret} inside it and nothing else", "1234 ... 99", *group])]
    folder = tmp_path_factory.mktemp("planted")
    more = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    return saved(more, folder, benchmark=bench), more, rows


def test_names_and_order():
    assert [n for n, _ in cp.STAGES] == [
        "language_id", "ngram_jaccard_join", "benchmark_decontamination", "secret_scan", "lexical_packing"]


def test_stages_take_effect(spark, planted, tmp_path):
    folder, docs, rows = planted
    held, tables = docs, {}
    for name, stage in cp.STAGES:
        out = stage(spark, held, folder)
        if name != "lexical_packing":
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        held = tables[name] = spark.read.parquet(str(tmp_path / name))
    ids = {n: [r.doc_id for r in t.select("doc_id").collect()] for n, t in tables.items()}
    every = {r.doc_id for r in docs.select("doc_id").collect()}
    assert every - set(ids["language_id"]) == {10_002}  # no letters
    group = {r[0] for r in rows[3:]}
    assert group & set(ids["ngram_jaccard_join"]) == {min(group)}
    from tablewright.llm import near_duplicates as nd

    found, sets = nd.classes(tables["language_id"])
    assert sorted(ids["ngram_jaccard_join"]) == sorted({r.class_id for r in nd.join_rows(found, sets).collect()})
    from tablewright.llm import decontam

    bench = spark.read.parquet(f"{folder}/benchmark.parquet")
    hits = decontam.scan_windows(tables["ngram_jaccard_join"], bench).collect()
    assert sorted(ids["benchmark_decontamination"]) == sorted(r.doc_id for r in hits if not r.hit_spans)
    assert 10_000 not in ids["benchmark_decontamination"]
    before = {r.doc_id: r for r in tables["benchmark_decontamination"].collect()}
    after = {r.doc_id: r for r in tables["secret_scan"].collect()}
    assert set(after) == set(before) and "[SECRET]" in after[10_001].text and "0cab398" not in after[10_001].text
    for i, r in after.items():
        assert "[SECRET]" in r.text and r.n_chars == len(r.text) or r == before[i]
    assert set(ids["lexical_packing"]) == set(after)


def test_run_over_odd_and_empty_tables(spark, tmp_path):
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    odd = cp.run(spark, saved(odd_documents(spark), tmp_path / "odd", benchmark=bench)).collect()
    assert {r.doc_id for r in odd} <= {1, 2, None, 6, 8, 9, 10, 11, 12} and {1, 8} <= {r.doc_id for r in odd}
    none = cp.run(spark, saved(no_documents(spark), tmp_path / "none", benchmark=bench.limit(0)))
    assert none.count() == 0
