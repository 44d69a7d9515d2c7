"""Physical plans: what is read is pruned, no cross products, no row-at-a-time Python, no window over all rows in one task."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry

QUERIES = entry.queries()


def plan(spark, sf, name):
    return QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()


NO_PYTHON = "win_w1_multi_scale win_w2_by_lang win_w9_sliding agg_a7_a8_vocabulary agg_a11_prefix_dedup agg_a12_ngram_signature agg_a13_keep_best join_j7_related_files col_p21_change_type col_p30_p31_complexity txt_g16_commit_block lin_n2_n5_matmul lin_n10_quantise agg_a1_author_stats".split()


@pytest.mark.parametrize("name", NO_PYTHON)
def test_stays_in_the_jvm(spark, sf, name):
    p = plan(spark, sf, name)
    assert not re.search("Python|Pandas|MapInArrow|BatchEval", p)
    assert "CartesianProduct" not in p


@pytest.mark.parametrize("name,columns", [("col_p21_change_type", "chunk_id,new_code,patch"), ("agg_a2_t3_hotspots", "filename,change_type"), ("win_w10_pad_mask", "example_id,target"), ("agg_a27_norms", "user_id,value")])
def test_reads_only_what_it_needs(spark, sf, name, columns):
    read = re.findall(r"ReadSchema: struct<(.*?)>(?:\n|$)", plan(spark, sf, name))
    assert read
    names = set(re.findall(r"(\w+):", read[0]))
    assert names <= set(columns.split(","))


@pytest.mark.parametrize("name", ["agg_a2_t3_hotspots", "win_w2_by_lang", "sig_wf3_wf4_wf5_wf7", "flt_f7_binary"])
def test_filters_reach_the_scan(spark, sf, name):
    p = plan(spark, sf, name)
    assert re.search(r"PushedFilters: \[\w+", p) or "DataFilters: [" in p


@pytest.mark.parametrize("name", ["agg_a1_author_stats", "agg_a13_keep_best", "src_s1_so5_unique_commits", "src_s6_s12_branches"])
def test_choices_per_key_combine_before_the_shuffle(spark, sf, name):
    p = plan(spark, sf, name)
    assert "partial_" in p and "Window" not in p


@pytest.mark.parametrize("name", ["win_w3_w4_stream", "win_w5_concat_cut", "smp_x6_t7_shuffle_split", "smp_x7_temporal", "src_s11_wf1_numbered", "join_j12_wf2_neighbours"])
def test_global_orders_have_no_single_task(spark, sf, name):
    """A window without a partition key may only run over one total per partition."""
    p = plan(spark, sf, name)
    for m in re.finditer(r"Window \[(.*?)\], \[(.*)", p):
        spec = m[0]
        if "windowspecdefinition(part_" in spec and "SinglePartition" in p:
            continue
        assert "part_" in spec or "before_" in spec


def test_no_cross_products_anywhere(spark, sf):
    for name in QUERIES:
        if name.startswith(("col_", "agg_", "join_", "smp_", "set_", "sig_", "win_", "txt_")):
            assert "CartesianProduct" not in plan(spark, sf, name), name
