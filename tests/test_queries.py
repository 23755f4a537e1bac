"""Registered queries against their SQL in DuckDB on the smallest data folder.

A part of every group runs by default; set PLENARIA_ALL=1 to run all.
"""

import os
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from plenaria.queries import TABLE_NAMES, registry

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
from check_queries import KINDS, digest  # noqa: E402

FOLDER = os.environ.get("PLENARIA_DATA", "/root/testdata/sf0.001")
SAMPLE = ["d1_latest_version", "d3_conform_entity", "d4_conform_bridge", "j3_fk_null", "j6_interval_join", "j12_active_count", "f6_iqr", "g4_median_p90", "w4_global_row_number",
          "w6_previous_event", "t1_partial_date_end", "x7_fold_key", "k4_merge", "k5_cascade", "q8_profile", "m2_semantic_query", "a4_against_majority", "a7_agreement",
          "a10_components", "a19_lead_time", "a29_place_match", "z_contacts_fact", "z_seats_fact", "a30_person_dim"]

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLE_NAMES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", [n for n, q in registry().items() if q.sql] if os.environ.get("PLENARIA_ALL") else SAMPLE)
def test_query_equals_sql(spark, con, name):
    q = registry()[name]
    df = q(spark, FOLDER)
    result = con.execute(q.sql)
    columns = [d[0] for d in result.description]
    assert {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in result.description} == dict(df.dtypes)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(columns, result.fetchall())[0]


def test_entry_points(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert all(q.sql is None or q.sql.strip() for q in registry().values())


def test_other_queries_import_without_the_text_operators():
    """A text library that is missing, or the subpackage itself, leaves only the text queries out."""
    import subprocess
    root = str(Path(__file__).resolve().parents[1])
    code = (f"import sys; sys.path.insert(0, {root!r}); sys.modules['xxhash'] = sys.modules['tokenizers'] = sys.modules['plenaria.llm'] = None; import __spark_entry__ as e; "
            "print(len(e.queries()), any(n.startswith('op') or n == 'pipeline' for n in e.queries()), set(e.oracle_sql()) <= set(e.queries()))")
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert done.stdout.split()[1:] == ["False", "True"] and int(done.stdout.split()[0]) == len(registry()), done.stderr[-1000:]


def test_queries_run_from_a_foreign_folder(tmp_path):
    import subprocess
    root = str(Path(__file__).resolve().parents[1])
    code = (f"import sys; sys.path.insert(0, {root!r}); import __spark_entry__ as e; from plenaria.session import local_session; s = local_session('far', 2); q = e.queries(); "
            f"print('rows', *[q[n](s, {FOLDER!r}).count() > 0 for n in ('j15_pairs', 'a10_edges', 's1_source_resume')])")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300, env=env)
    assert "rows True True True" in done.stdout, done.stderr[-2000:]


def test_members_do_not_gather_by_faction(spark, tmp_path):
    """Members meet their faction without a shuffle by faction, so later groups of faction and person spread over the tasks."""
    from plenaria.plans.seats import with_faction

    members = spark.createDataFrame([(p, "ab"[p % 2]) for p in range(50)], "persoon_id long, fractie_id string")
    factions = spark.createDataFrame([("a", 1), ("b", 2)], "fractie_id string, n int").groupBy("fractie_id").agg({"n": "max"})
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = with_faction(members, factions)
        assert "SortMergeJoin" not in joined._jdf.queryExecution().executedPlan().toString()
        assert {(r.persoon_id, r["max(n)"]) for r in joined.collect()} == {(p, 1 + p % 2) for p in range(50)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_place_keys_of_different_words(spark, tmp_path):
    """Words are counted before keys are made of them, with the same counts as one by one."""
    from plenaria.queries import registry

    texts = ["Ommen ommen OMMEN. (x) - geen", "Ommen Zuid", None, "", "Ommen"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = registry()["x7_place_key"](spark, str(tmp_path))
    assert {r.sleutel: r.aantal for r in found.collect()} == {"ommen": 5, "zuid": 1}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 2
