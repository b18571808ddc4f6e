"""Registration, SQL counterparts and the pipeline."""

import glob
import os
import subprocess
import sys

import duckdb
import pytest

from delayhouse.llm import queries

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = queries.queries()[name](spark, SF)
    result = duck.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    order = sorted(columns)
    assert sorted(got.columns) == order
    plain = lambda rows, names: sorted(tuple(r[names.index(c)] for c in order) for r in rows)
    assert plain(got.collect(), got.columns) == plain(result.fetchall(), columns)


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))


def test_stages_return_documents_and_take_effect(spark):
    import corpus_pipeline
    from delayhouse.llm import secrets
    from delayhouse.llm.common import staged
    from delayhouse.session import scratch_path

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, SF), name)
        assert docs.columns == columns
        kept.append(docs.count())
    assert kept[0] > kept[1] == kept[2] > 0
    left = secrets.digests(secrets.scan(spark, docs, scratch_path(spark, "ledger"))).filter("spans <> ''")
    assert left.count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_the_rest_works_without_this_package():
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith(('delayhouse.llm', 'corpus_pipeline')):\n"
        "            raise ModuleNotFoundError(name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert 'legs_ready' in e.queries() and not any(k.startswith('op') for k in e.queries())\n"
        "assert 'pipeline' not in e.queries() and 'legs_ready' in e.oracle_sql()\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
