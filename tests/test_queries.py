import importlib.util

import duckdb
import pytest

import __spark_entry__ as entry
from quillon.catalog import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
CHECKED = ["assign_ids", "dedupe_mapping", "reconcile_labels", "coverage", "version_as_of", "similar_pairs", "split_deterministic", "fold_jaccard", "auroc", "performance_row", "threshold_kappa", "pool", "bag_scaling", "spearman", "output_table", "collapse_phase"]
CHECKED += ["cutoffs", "select_folds", "bag_weighting", "bag_model", "isotonic", "pool_raw", "featurize_whole", "dedupe_store", "pooled_stream", "saved_transformer", "label_variants", "run_summary", "hooks", "retention"]
CHECKED += ["read_table", "remap", "read_through", "contribute", "featurize", "store_size", "smooth_repeats", "set_classes", "heldout_metrics", "signals_present", "performance_table", "session_stream", "telemetry_stream", "dedupe_stream"]


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def same(spark, con, sf_dir, name):
    got = QUERIES[name](spark, sf_dir)
    columns = sorted(got.columns)
    cursor = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted(str(tuple(r[names.index(c)] for c in columns)) for r in cursor.fetchall())
    assert sorted(str(tuple(r[c] for c in columns)) for r in got.collect()) == want


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, con, sf_dir, name):
    same(spark, con, sf_dir, name)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_names_are_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    if importlib.util.find_spec("quillon.llm"):
        assert sum(n.startswith("op") and n[2].isdigit() for n in entry.queries()) >= 13


def test_streams(spark, sf_dir):
    assert QUERIES["session_stream"](spark, sf_dir).count() > 0
    assert QUERIES["score_stream"](spark, sf_dir).count() == 200
