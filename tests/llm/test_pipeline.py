"""The stages one after another against plain versions, and the guard of the registry."""

from __future__ import annotations

import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
import corpus_pipeline as cp
from coursetide.llm import quality
from coursetide.llm.inputs import cut_lineage, in_fold, read

from ..conftest import ROOT, TESTDATA
from ..oracle import assert_same, duckdb_on
from .data import awkward, documents, prose
from .test_decontaminate import plain as plain_contaminated
from .test_simhash import plain_components, plain_fingerprint

FOLDER = str(TESTDATA / "sf0.001")
SQL = registry.training_data.oracle_sql()


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage makes of the one before, as rows by id."""
    docs, out = read(spark, FOLDER, "documents"), []
    for name, stage in cp.STAGES:
        docs = cut_lineage(stage(spark, docs, FOLDER))
        out.append((name, docs.columns, {r.doc_id: r for r in docs.collect()}))
    return {r.doc_id: r for r in read(spark, FOLDER, "documents").collect()}, out


def test_columns_and_shrinking(stages):
    before, out = stages
    assert [name for name, _, _ in out] == ["quality", "near_duplicates", "decontamination", "pii", "bpe"]
    for name, columns, rows in out:
        assert rows.keys() <= before.keys() and rows
        assert (columns == list(cp.COLUMNS)) == (name != "bpe")
        before = rows
    assert len(out[2][2]) == len(out[3][2]) == len(out[4][2])


def test_quality_follows_the_score(spark, stages):
    before, out = stages
    labels = read(spark, FOLDER, "labels")
    ranking = quality.learn(read(spark, FOLDER, "documents"), labels.where(~in_fold("doc_id", 3, 1)))
    rows = [quality.features(r.text or "") for r in before.values()]
    want = {i for i, s in zip(before, ranking.scores(rows), strict=True) if s >= 0.5}
    assert out[0][2].keys() == want
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    assert len(good & before.keys() & want) >= 0.97 * len(good & before.keys())


def test_one_of_each_group_stays(stages):
    _, out = stages
    prints = [(i, plain_fingerprint(r.text)) for i, r in sorted(out[0][2].items())]
    want = {i for (i, _), c in zip(prints, plain_components(prints), strict=True) if i == c}
    assert out[1][2].keys() == want


def test_contaminated_documents_go(spark, stages):
    _, out = stages
    items = [(r.item_id, r.text) for r in read(spark, FOLDER, "benchmark").collect()]
    bad = {i for i, *_ in plain_contaminated([(i, r.text) for i, r in out[1][2].items()], items)}
    assert out[2][2].keys() == out[1][2].keys() - bad


def test_the_last_two(stages):
    _, out = stages
    for i, r in out[3][2].items():
        assert r.n_chars == len(r.text)
        assert ("@" in r.text) == ("@" in out[2][2][i].text)
    changed = [i for i, r in out[3][2].items() if r.text != out[2][2][i].text]
    assert 0 < len(changed) < len(out[3][2])
    import hashlib

    for i, r in out[4][2].items():
        assert r.decoded_sha256 == hashlib.sha256(out[3][2][i].text.encode()).hexdigest()
        assert len(r.ids) == 4 * r.n_tokens


def test_awkward_rows(spark, tmp_path):
    """Nulls, repeated rows and ids, ties, long texts, columns of other names, and no rows."""
    folder = str(tmp_path)
    rows = [*awkward(), (80, prose(500, 40)), (81, "AB " * 9), (81, "CD " * 9)]
    documents(spark, rows, clash=True).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, prose(500, 40)), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = read(spark, folder, "documents")
    good = cut_lineage(cp.keep_good(spark, docs, folder))
    assert good.count() == len(rows)  # nothing was learned, so nothing is rejected
    one = cut_lineage(cp.one_of_each(spark, good, folder))
    kept = sorted(str(r.doc_id) for r in one.collect())
    # of equal texts the smallest id stays, and of repeated rows one
    assert kept == sorted(["1", "3", "6", "8", "9", "10", "11", "80", "81", "81"])
    clean = cut_lineage(cp.without_benchmark(spark, one, folder))
    assert {str(r.doc_id) for r in clean.collect()} == set(kept) - {"80"}
    last = cp.token_ids(spark, cut_lineage(cp.pseudonyms(spark, clean, folder)), folder)
    assert last.count() == clean.count()
    nothing = docs.where("false")
    for _, stage in cp.STAGES:
        nothing = cut_lineage(stage(spark, nothing, folder))
    assert nothing.count() == 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    folder = TESTDATA / "sf0.01"
    assert assert_same(registry.queries()[name](spark, str(folder)), duckdb_on(folder), SQL[name]) > 0


@pytest.mark.parametrize("number", range(1, 14))
def test_every_operator_has_one_query(number):
    assert len([name for name in registry.queries() if name.startswith(f"op{number}_")]) == 1


def test_registry_without_this_part():
    """As if the folders were deleted: the rest imports and keeps its queries."""
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name in ('coursetide.llm', 'corpus_pipeline'): raise ModuleNotFoundError(name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert e.queries().keys() == e.oracle_sql().keys() == e.analytics_queries().keys()\n"
        "assert len(e.queries()) > 25 and 'pipeline' not in e.queries()\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_nothing_else_imports_this_part():
    for path in (ROOT / "coursetide").rglob("*.py"):
        if "llm" not in path.parts:
            assert "llm" not in path.read_text(), path


def test_local_checkpoints_are_not_used():
    for path in [ROOT / "corpus_pipeline.py", *(ROOT / "coursetide").rglob("*.py")]:
        assert "localCheckpoint" not in path.read_text()


def test_fold_is_the_agreed_remainder(spark):
    import zlib

    rows = spark.range(200).select("id", in_fold("id", 3, 1).alias("held"), in_fold("id", 4, 2).alias("other")).collect()
    for r in rows:
        code = zlib.crc32(str(r.id).encode())
        assert (r.held, r.other) == (code % 3 == 1, code % 4 == 2)
    assert spark.sql("SELECT CAST(null AS long) AS id").select(in_fold("id", 3, 1)).first()[0] is False


def test_recomputed_partitions_keep_row_numbers(spark):
    """The near-duplicate stage tells rows apart by their place in the stored table."""
    docs = read(spark, FOLDER, "documents")
    placed = docs.select("doc_id", F.monotonically_increasing_id().alias("row"))
    wide = docs.select("*", F.monotonically_increasing_id().alias("row"))
    assert {tuple(r) for r in placed.collect()} == {(r.doc_id, r.row) for r in wide.collect()}


