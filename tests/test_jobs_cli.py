"""Job entry points over a Bronze folder laid out like the capture process."""

import json
import os

import pytest

from changelake.__main__ import main
from changelake.config import Paths, RunConfig
from changelake.plans.gold_job import MARTS, run_gold
from changelake.plans.metrics import GateError
from changelake.plans.silver_job import run_all, run_table
from changelake.plans.specs import FIXTURE_SPECS, SPECS
from changelake.sinks.parquet import read_table
from changelake.sources import fixtures as fx
from changelake.sources.fixtures import write_change_log

SF = "/root/testdata/sf0.001"


@pytest.fixture
def bronze_root(spark, tmp_root):
    paths = Paths.under(tmp_root)
    for source in ("customers", "products", "orders", "order_items", "payments", "shipments"):
        write_change_log(fx.bronze(spark, SF, source), paths.bronze_table(source), folders="month")
    return tmp_root


def test_cli_runs_silver_tables(spark, bronze_root, capsys):
    p = Paths.under(bronze_root)
    rc = main(["--BRONZE_PATH", p.bronze_root, "--SILVER_PATH", p.silver_root,
               "--QUARANTINE_PATH", p.quarantine_root, "--TABLE", "fact_orders",
               "--TABLE", "dim_customer", "--JOB_NAME", "proj-dev-silver"])
    assert rc == 0
    out = [json.loads(line) for line in capsys.readouterr().out.splitlines() if line.startswith("{")]
    got = {o["table"]: o for o in out}
    assert got["fact_orders"]["valid_rows"] == 1301
    assert got["fact_orders"]["quarantined_rows"] == 62
    assert got["dim_customer"]["valid_rows"] == 130


def test_cli_takes_in_new_files_only(spark, bronze_root, capsys):
    p = Paths.under(bronze_root)
    args = ["--BRONZE_PATH", p.bronze_root, "--SILVER_PATH", p.silver_root, "--QUARANTINE_PATH", p.quarantine_root,
            "--TABLE", "fact_orders", "--INCREMENTAL"]

    def run():
        assert main(args) == 0
        return [json.loads(line) for line in capsys.readouterr().out.splitlines() if line.startswith("{")][0]
    first = run()
    assert first["valid_rows"] == 1301 and first["files"] > 1
    assert run()["files"] == 0
    assert read_table(spark, p.silver_table("fact_orders")).count() == 1301


def test_broadcast_of_measured_parents_gives_the_same_rows(spark, bronze_root):
    raws = {s: fx.bronze(spark, SF, s) for s in ("orders", "order_items")}
    spec = FIXTURE_SPECS["fact_order_items"]
    rows = []
    for n, bound in enumerate((None, 0, 1 << 25)):
        cfg = RunConfig(Paths.under(os.path.join(bronze_root, f"b{n}")))
        res = run_table(spark, spec, cfg, raw=raws["order_items"], raw_parents={"orders": raws["orders"]},
                        parent_specs=FIXTURE_SPECS, broadcast_parents_up_to=bound)
        rows.append(sorted(tuple(r) for r in read_table(spark, res.silver_path).collect()))
    assert rows[0] == rows[1] == rows[2] and len(rows[0]) == 2645


def _gold_config(root, run_id, **kw):
    return RunConfig(Paths.under(root), run_id=run_id, environment="dev",
                     metrics_path=os.path.join(root, "metrics"), **kw)


def test_gold_runs_apart_from_silver(spark, bronze_root):
    from datetime import datetime, timezone
    then = datetime(2024, 1, 5, tzinfo=timezone.utc)   # a day after the youngest change
    silver = _gold_config(bronze_root, "s1", reference_time=then)
    with pytest.raises(Exception):                     # nothing recorded yet
        run_gold(spark, _gold_config(bronze_root, "g0"), os.path.join(bronze_root, "gold"))
    runs = run_all(spark, silver, SPECS)
    assert set(runs) == set(SPECS)
    gold = _gold_config(bronze_root, "g1")             # another run id
    with pytest.raises(GateError, match="stale"):      # 1990s capture times are stale
        run_gold(spark, gold, os.path.join(bronze_root, "gold"))
    report = run_gold(spark, gold, os.path.join(bronze_root, "gold"), check_fresh=False)
    rows = {r.table_name: r for r in report.collect()}
    assert all(not r.exceeds and r.upper_rows == r.lower_rows for r in rows.values())
    assert rows["mart_fulfilment"].upper_rows == runs["fact_shipments"].valid_rows
    for name in MARTS:
        assert read_table(spark, os.path.join(bronze_root, "gold", name)).count() > 0


def test_gold_fails_on_missing_metrics_and_on_a_mart_that_loses_rows(spark, bronze_root):
    from changelake.plans import marts
    cfg = _gold_config(bronze_root, "s1")
    run_all(spark, cfg, {"fact_shipments": SPECS["fact_shipments"]})
    one = {"mart_delivery_days": MARTS["mart_delivery_days"]}
    gold_root = os.path.join(bronze_root, "gold")
    with pytest.raises(GateError, match="fact_payments .missing"):
        run_gold(spark, cfg, gold_root, {**one, "mart_revenue_by_method": MARTS["mart_revenue_by_method"]})
    assert run_gold(spark, cfg, gold_root, one, check_fresh=False).count() == 1
    lossy = {"mart_delivery_days": (lambda t: marts.delivery_days_by_carrier(
        t["fact_shipments"].filter("carrier <> 'DHL'")), ("fact_shipments",))}
    with pytest.raises(GateError, match="divergence"):
        run_gold(spark, cfg, gold_root, lossy, check_fresh=False)
    with pytest.raises(GateError, match="nothing to compare"):   # points too old to count
        run_gold(spark, cfg, gold_root, one, check_fresh=False, window_hours=0.0)
