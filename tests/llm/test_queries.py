"""The registered queries: columns, types and one row per input row; the guard around the subpackage."""

import subprocess
import sys

import pytest

import __spark_entry__ as entry
from conftest import ROOT, SF_SMALL

CONTRACT = {
    "op1_toxicity": ("documents", "doc_id bigint, held_out boolean, score double, predicted int"),
    "op2_minhash_near_dedup": ("documents", "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean"),
    "op3_separator_scan": ("documents", "doc_id bigint, n_tokens bigint"),
    "op4_warc_normaliser": ("pages", "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
                                     "refers_to bigint"),
    "op5_backoff_automaton": ("documents", "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
                                           "base_score double, score double"),
    "op6_quality_rules": ("documents", "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
                                       "n_repeat_words bigint, base_failed boolean, kept boolean"),
    "op7_wrapper_induction": ("pages", "page_id bigint, url string, text string, n_chars bigint"),
    "op8_best_fit_packing": (None, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, "
                                   "offset bigint"),
    "op9_mixing": ("documents", "doc_id bigint, size bigint, source_size bigint, target double, taken bigint"),
    "op10_cross_polytope": ("embeddings", "vec_id bigint, n_links bigint, component_id bigint, kept boolean"),
    "op11_token_alignment": ("documents", "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
                                          "count_sum bigint, groups_sha256 string"),
    "op12_longest_previous_factor": ("documents", "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, "
                                                  "kept_sha256 string"),
    "op13_lookup_tables": ("embeddings", "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, "
                                         "centroid_sha256 string"),
}


@pytest.mark.parametrize("name", list(CONTRACT))
def test_contract(spark, name):
    table, columns = CONTRACT[name]
    df = entry.queries()[name](spark, SF_SMALL)
    types = dict(df.dtypes)
    for c in columns.split(", "):
        k, t = c.split(" ")
        assert types[k] == t, k
    rows = df.count()
    if table:
        assert rows == spark.read.parquet(f"{SF_SMALL}/{table}.parquet").count()


def test_one_query_per_operator():
    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names


def test_the_rest_works_without_the_subpackage():
    code = ("import sys, importlib.abc\n"
            "class Gone(importlib.abc.MetaPathFinder):\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name in ('corpus_pipeline', 'strandline.llm'):\n"
            "            raise ModuleNotFoundError(name, name=name)\n"
            "sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as e\n"
            "assert 'select_strand' in e.queries() and not any(n.startswith('op') and n[2].isdigit() for n in e.queries())\n"
            "assert e.oracle_sql()\n")
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT).returncode == 0
