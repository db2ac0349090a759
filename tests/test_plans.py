"""Physical-plan properties of every registered query."""

import pytest

from seqscore.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairs_no_row_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"


def test_scan_reads_only_needed_columns(spark):
    plan = QUERIES["composite_score"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    # lineitem has 11 columns; the scorer needs 8 (no flags, no ship date)
    assert "l_shipdate" not in plan and "l_returnflag" not in plan


def test_global_rank_has_no_single_partition_sort_of_rows(spark):
    plan = QUERIES["global_rank"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    # rows come from the pinned range-partitioned copy; the only
    # single-partition exchange is the P-row offsets table
    assert "ExistingRDD" in plan
    assert plan.count("SinglePartition") == 1


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("all_atoms", [False, True])
def test_a_record_is_parsed_once(spark, tmp_path, all_atoms):
    """No filter on the parsed atoms holds a copy of the parser."""
    from seqscore.operators.structure import structure_metrics_array
    from seqscore.sources.files import explode_all_atoms, explode_atoms, read_pdb
    (tmp_path / "a.pdb").write_text("HEADER    a\nEND\n")
    s = read_pdb(spark, str(tmp_path), all_atoms=all_atoms)
    plans = [_plan(explode_all_atoms(s))] if all_atoms else [_plan(explode_atoms(s)), _plan(structure_metrics_array(s))]
    for plan in plans:
        assert plan.count("regexp_extract_all") == 1


def test_ranks_behind_pairs_are_pinned(spark):
    """A report on the pairs does not rank again."""
    plan = _plan(QUERIES["preference_pairs"](spark, SF))
    assert "ExistingRDD" in plan and "Window" not in plan and "Exchange" not in plan


def test_positions_of_all_atoms_are_pinned(spark):
    """Every count and write of the atoms would number them again."""
    from seqscore.sources.fixtures import all_atoms
    plan = _plan(all_atoms(spark, SF))
    assert "ExistingRDD" in plan and "Window" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("name", ["rmsd", "validation_report"])
def test_both_sides_share_the_numbered_atoms(spark, name):
    """The atoms are numbered once: the second side reads the first one's exchange."""
    df = QUERIES[name](spark, SF)
    df.collect()
    plan = _plan(df)
    final = plan[:plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    assert "ReusedExchange" in final
    assert sum("Window [row_number()" in line and "ord_key" in line for line in final.splitlines()) == 1
