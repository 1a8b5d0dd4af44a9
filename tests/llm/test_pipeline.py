import subprocess
import sys
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from check_oracle import canon, spark_type_name
from lakestrata.llm import common, exact_dedup, mixing, simhash
from lakestrata.llm.common import save
from lakestrata.llm.oracle import ORACLE
from tests.conftest import ROOT
from tests.llm import test_exact_dedup, test_mixing, test_packing, test_simhash
from tests.llm.conftest import AWKWARD, frame, with_clashes

SF = "/root/testdata/sf0.001"


def as_rows(df):
    return [(r.doc_id, r.text, r.lang, r.source) for r in df.collect()]


def test_stages_match_brute_force_on_their_own_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        given = as_rows(docs)
        docs = stage(spark, docs, SF)
        docs = corpus_pipeline.save(docs, f"test-{name}")
        seen[name] = (given, docs)
    for name in list(seen)[:-1]:
        assert seen[name][1].columns == columns
    given, kept = seen["language_id"]
    assert set(as_rows(kept)) <= set(given) and len(as_rows(kept)) > 0.97 * len(given)
    given, kept = seen["exact_dedup"]
    want = {test_exact_dedup.norm(r[1]) for r in given}
    assert Counter(test_exact_dedup.norm(r[1]) for r in as_rows(kept)) == Counter(dict.fromkeys(want, 1))
    assert {r[0] for r in as_rows(kept)} == {k for _, k, *_ in test_exact_dedup.brute(given)}
    given, kept = seen["simhash_near_dedup"]
    prints = {r[0]: test_simhash.plain_fingerprint(r[1]) for r in given}
    comp = test_simhash.plain_components(prints.values(), 2)
    first = {}
    for k in sorted(prints):
        first.setdefault(comp[prints[k]], k)
    assert sorted(r[0] for r in as_rows(kept)) == sorted(first.values())
    given, kept = seen["mixing"]
    want = {k: taken // size for k, size, _, _, taken in test_mixing.plain_mix(given) if taken}
    assert Counter(r[0] for r in as_rows(kept)) == Counter(want)
    assert set(as_rows(kept)) <= set(given)
    given, packed = seen["packing"]
    test_packing.check(given, packed)


def test_run_equals_the_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.save(stage(spark, docs, SF), "test")
    want = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    got = corpus_pipeline.run(spark, SF)
    assert Counter(map(tuple, got.select(*columns).collect())) == Counter(map(tuple, want.select(*columns).collect()))


def test_tables_made_on_the_way_are_deleted(spark):
    """A lake of its own: what run() leaves is the last stage's, which its lazy result still reads."""
    import os

    from lakestrata.session import shared_dir
    folder = shared_dir(spark, "llm").removeprefix("file:")
    before = set(os.listdir(folder))
    got = corpus_pipeline.run(spark, SF)
    left = {n.rsplit("-", 1)[0] for n in set(os.listdir(folder)) - before}
    assert "pipeline-mixing" in left and not {"pipeline-language_id", "pipeline-exact_dedup", "rows"} & left
    assert got.count() > 0


@pytest.mark.parametrize("rows", [AWKWARD, []])
def test_awkward_tables_pass_every_stage(spark, rows):
    docs = with_clashes(frame(spark, rows))
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = corpus_pipeline.save(stage(spark, docs, SF), f"test-{name}")
        assert name == "packing" or docs.columns == columns
    assert rows or docs.count() == 0


@pytest.mark.parametrize("module, stage", [(exact_dedup, "exact_dedup"), (simhash, "simhash_near_dedup"),
                                           (mixing, "mixing")])
def test_scans_that_are_split_anew_between_two_jobs(spark, tmp_path, monkeypatch, module, stage):
    path, size, stages = str(tmp_path / "docs"), "spark.sql.files.maxPartitionBytes", dict(corpus_pipeline.STAGES)
    spark.read.parquet(f"{SF}/documents.parquet").repartition(6, "doc_id").write.parquet(path)
    want = Counter(as_rows(stages[stage](spark, spark.read.parquet(path), SF)))
    before = spark.conf.get(size)

    def then_smaller_splits(df, *args, **options):
        out = save(df, *args, **options)
        spark.conf.set(size, "100k")
        return out

    for place in {module, common}:
        monkeypatch.setattr(place, "save", then_smaller_splits)
    try:
        got = Counter(as_rows(stages[stage](spark, spark.read.parquet(path), SF)))
    finally:
        spark.conf.set(size, before)
    assert got == want and got


def test_exact_dedup_with_weak_hashes_and_scans_split_anew(spark, tmp_path, monkeypatch):
    path, size = str(tmp_path / "docs"), "spark.sql.files.maxPartitionBytes"
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs.repartition(6, "doc_id").write.parquet(path)
    before = spark.conf.get(size)

    def then_smaller_splits(df, *args, **options):
        out = save(df, *args, **options)
        spark.conf.set(size, "100k")
        return out

    monkeypatch.setattr(exact_dedup, "save", then_smaller_splits)
    try:
        got = exact_dedup.exact_dedup(spark.read.parquet(path), hash_bits=3).where("kept").collect()
    finally:
        spark.conf.set(size, before)
    assert {r.doc_id for r in got} == {k for _, k, *_ in test_exact_dedup.brute(as_rows(docs))}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    df = entry.queries()[name](spark, SF)
    rows = df.collect()
    cur = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    kinds = {r[0]: r[1] for r in con.execute(f"DESCRIBE {entry.oracle_sql()[name]}").fetchall()}
    assert {f.name: spark_type_name(f.dataType) for f in df.schema.fields} == kinds
    assert canon(rows, df.columns) == canon(con.execute(entry.oracle_sql()[name]).fetchall(), columns)


def test_every_operator_is_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


def test_the_rest_imports_without_this_subpackage():
    code = ("import sys; sys.modules['lakestrata.llm'] = None; sys.modules['corpus_pipeline'] = None; "
            "import __spark_entry__ as e; q = e.queries(); assert 'margin_invoice' in q; "
            "assert not [n for n in q if n.startswith('op') or n == 'pipeline']")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=ROOT)
