from pathlib import Path

import pytest

from ledgerline import registry as R
from ledgerline.plans import quality as G
from ledgerline.plans.load import load_star

SF = "/root/testdata/sf0.001"


def test_a_bad_load_is_kept_apart_and_a_clean_one_is_whole(spark, tmp_path):
    clean, dirty = R.star(spark, SF), R.dirty_star(spark, SF)
    with pytest.raises(ValueError, match="dim.customer: null key"):
        load_star(dirty, str(tmp_path / "stop"), "stop")
    assert not (tmp_path / "stop").exists()
    loaded = load_star(dirty, str(tmp_path / "some"))
    assert [p.name for p in (tmp_path / "some").iterdir()] == [Path(loaded.folder).name]
    kept_out = {(r["table_name"]): r["count"] for r in loaded.quarantine.groupBy("table_name").count().collect()}
    assert kept_out["fact.sales"] + loaded.star.fact.count() == dirty.fact.count()
    assert kept_out["dim.customer"] + loaded.star.customer.count() == dirty.customer.count()
    left = G.pk_violations(loaded.star).selectExpr("sum(null_keys)", "sum(duplicated_keys)").first()
    assert tuple(left) == (0, 0) and all(r["orphan_rows"] == 0 for r in G.fk_violations(loaded.star).collect())
    whole = load_star(clean, str(tmp_path / "all"), "stop")
    assert whole.quarantine.count() == 0 and whole.star.fact.count() == clean.fact.count()
    with pytest.raises(ValueError):
        load_star(clean, str(tmp_path / "x"), "ignore")


def test_view_counts_compute_no_running_total(spark):
    plan = G.view_row_counts(R.star(spark, SF))._jdf.queryExecution().optimizedPlan().toString()
    assert "running" not in plan.lower() and "Window" not in plan and "profit_margin" not in plan
