import dataclasses

import pytest

from changelake.config import Paths, RunConfig, environment_from_job_name, resolve_paths


def test_table_paths():
    p = Paths("s3://b/bronze", "s3://b/silver", "s3://b/q")
    assert p.bronze_table("orders") == "s3://b/bronze/raw/public/orders"
    assert p.silver_table("fact_orders") == "s3://b/silver/fact_orders"
    assert p.quarantine_table("fact_orders") == "s3://b/q/fact_orders"


def test_trailing_slash_ignored():
    p = Paths("s3://b/", "file:///x/silver/", "/q/")
    assert p.bronze_table("t") == "s3://b/raw/public/t"
    assert p.silver_table("t") == "file:///x/silver/t"
    assert p.quarantine_table("t") == "/q/t"


def test_frozen():
    p = Paths("a", "b", "c")
    with pytest.raises(dataclasses.FrozenInstanceError):
        p.bronze_root = "x"


def test_resolve_paths():
    p = resolve_paths({"BRONZE_PATH": "a", "SILVER_PATH": "b", "QUARANTINE_PATH": "c", "JOB": "x"})
    assert (p.bronze_root, p.silver_root, p.quarantine_root) == ("a", "b", "c")
    with pytest.raises(KeyError):
        resolve_paths({"BRONZE_PATH": "a"})


def test_environment_from_job_name():
    assert environment_from_job_name("proj-dev-dim_customer") == "dev"
    assert environment_from_job_name("standalone") == "unknown"


def test_run_config_defaults():
    c = RunConfig(Paths.under("/tmp/x"))
    assert c.paths.silver_table("t") == "/tmp/x/silver/t"
    assert c.run_id and c.stale_after_hours == 24.0
